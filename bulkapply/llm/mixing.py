"""Mixing overlapping sources to target weights by a minimum-cost flow.

A text may occur in several sources. Documents are added up by membership pattern, the set of sources their text occurs in, and
the words of a pattern are routed to its sources' quotas. A pattern's first pass over its distinct texts is free, each
further pass costs more (convex costs), so the flow repeats what has been used least; a source gets at most
``MOST`` times the words its own documents of a pattern have. The flow covers every quota exactly, because a
quota never exceeds ``MOST`` times its source. Every pattern takes part, those of texts in one source only too. The flow is
found on the driver; its size depends on the numbers of sources and patterns, not on documents.

Within a pattern and source every document is repeated the same whole number of times, and the rest of the quota is filled
with further documents in a seeded order, the last one in part. Ranges of that order are added up first, so only documents
of the range in which the quota ends are ordered, and no task gathers a source.

Quotas: sources by code point, null last, weigh ``WEIGHTS`` in turn and share all words; a quota stops at ``MOST`` times the
source's words, and what it loses is shared again by weight.

Defined cases: a null or empty text has size 0 and is taken 0 times; a source without words has target 0. Null source is a source
of its own. Rows that repeat are documents of their own; ties in the seeded order are broken by id and hash, and rows equal in
all of these share what is taken in turn. Only doc_id, text and source are read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bulkapply.llm.common import WORD, join_counted
from bulkapply.storage import materialize

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 20240317
# Ranges of the seeded order per source and pattern.
RANGES = 4096
_FREE_PASSES = 4


def quotas(sizes: dict[str | None, int], weights: tuple = WEIGHTS, most: int = MOST) -> dict[str | None, float]:
    """The target of each source from the words of each."""
    # Code points order as UTF-8 bytes do; null comes last.
    ordered = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8", "surrogatepass")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ordered)}
    left, free, target = float(sum(sizes.values())), list(ordered), {}
    while free:
        each = left / sum(weight[s] for s in free)
        full = [s for s in free if each * weight[s] > most * sizes[s]]
        if not full:
            return target | {s: each * weight[s] for s in free}
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free = [s for s in free if s not in target]
    return target


def _whole(target: dict, total: int) -> dict:
    """Targets as whole words that still add up: the largest remainders are rounded up."""
    out = {s: int(t) for s, t in target.items()}
    short = total - sum(out.values())
    for s in sorted(target, key=lambda s: (out[s] - target[s], str(s)))[: max(0, short)]:
        out[s] += 1
    return out


def min_cost_flow(supply: dict, edges: list[tuple], demand: dict) -> dict:
    """Words on each edge (pattern, source) at least cost.

    ``supply``: pattern to (words, cost) steps of rising cost; ``edges``: (pattern, source, capacity); ``demand``: source to
    words. Only the steps cost anything, and a path from the patterns to the sources never takes back words of a step, so
    the least cost is found by as much flow as fits at the lowest cost, then at the next (shortest layered paths, Dinic).
    """
    patterns, sources = list(supply), list(demand)
    of_pattern, of_source = [[] for _ in patterns], [[] for _ in sources]
    number = {p: i for i, p in enumerate(patterns)}, {s: i for i, s in enumerate(sources)}
    tail, head, room, flow = [], [], [], [0] * len(edges)
    for e, (pattern, source, words) in enumerate(edges):
        tail.append(number[0][pattern])
        head.append(number[1][source])
        room.append(words)
        of_pattern[tail[e]].append(e)
        of_source[head[e]].append(e)
    left, want = [0] * len(patterns), [demand[s] for s in sources]

    def layers() -> tuple[list, list] | None:
        """The distance of each pattern and source from the patterns with words left; none if no source in want is reached."""
        layer = [p for p, words in enumerate(left) if words > 0]
        depth = [-1] * len(patterns), [-1] * len(sources)
        for p in layer:
            depth[0][p] = 0
        at = 0
        while layer:
            at, reached = at + 1, []
            for p in layer:
                for e in of_pattern[p]:
                    if room[e] > 0 and depth[1][head[e]] < 0:
                        depth[1][head[e]] = at
                        reached.append(head[e])
            if any(want[s] > 0 for s in reached):
                return depth
            at, layer = at + 1, []
            for s in reached:
                for e in of_source[s]:
                    if flow[e] > 0 and depth[0][tail[e]] < 0:
                        depth[0][tail[e]] = at
                        layer.append(tail[e])
        return None

    def push(start: int, depth: tuple[list, list], following: tuple[list, list]) -> bool:
        """Move words along one path from ``start``; False if there is none among the layers."""
        path, at, is_source = [], start, False
        while True:
            if is_source and want[at] > 0:
                words = min(left[start], want[at], *(room[e] if forward else flow[e] for e, forward in path))
                for e, forward in path:
                    room[e] -= words if forward else -words
                    flow[e] += words if forward else -words
                left[start] -= words
                want[at] -= words
                return True
            near, other, able = (of_source, tail, flow) if is_source else (of_pattern, head, room)
            mine, i = near[at], following[is_source][at]
            while i < len(mine) and not (able[mine[i]] > 0 and depth[not is_source][other[mine[i]]] == depth[is_source][at] + 1):
                i += 1
            following[is_source][at] = i
            if i < len(mine):
                path.append((mine[i], not is_source))
                at, is_source = other[mine[i]], not is_source
            elif path:
                e, forward = path.pop()
                at, is_source = (tail[e], False) if forward else (head[e], True)
                following[is_source][at] += 1
            else:
                return False

    for cost in sorted({cost for steps in supply.values() for _, cost in steps}):
        for p, pattern in enumerate(patterns):
            left[p] += sum(words for words, c in supply[pattern] if c == cost)
        while depth := layers():
            following = [0] * len(patterns), [0] * len(sources)
            for p in range(len(patterns)):
                while left[p] > 0 and push(p, depth, following):
                    pass
    return {(pattern, source): flow[e] for e, (pattern, source, _) in enumerate(edges)}


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """``doc_id, size, source_size, target, taken``, a row for each row of ``docs``."""
    spark = docs.sparkSession
    size = F.size(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD), F.lit(0))).cast("long")
    rows = materialize(
        docs.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("h1"), F.hash("text").alias("h2")), "sizes")

    # Which sources have a text, and so its pattern; a text in one source only needs no join to know it.
    texts = rows.where("size > 0").groupBy("h1", "h2", "size").agg(
        F.count(F.lit(1)).alias("copies"), F.sort_array(F.collect_set(F.struct("source"))).alias("pattern"))
    shared = F.size("pattern") > 1
    texts = materialize(texts.select(
        F.struct("h1", "h2", "size").alias("text"), "copies",
        F.struct(F.when(~shared, F.col("pattern")[0]["source"]).alias("own"),
                 F.when(shared, F.xxhash64(F.to_json("pattern"))).alias("route")).alias("route")), "texts")
    routed = texts.where("route.route is not null").select("text", "copies", "route.route")
    placed = join_counted(rows.withColumn("text", F.struct("h1", "h2", "size")), routed, "text", "copies")
    own = F.struct(F.when(F.col("route").isNull(), F.col("source")).alias("own"), "route")
    placed = materialize(placed.select("doc_id", "source", "size", "h1", "h2", own.alias("route")), "routes")

    # The flow, on rows per pattern and source.
    flows = placed.groupBy("source", "route").agg(F.sum("size").alias("words")).collect()
    flows = sorted(flows, key=lambda f: (f.route.route or 0, *((s is None, s or "") for s in (f.route.own, f.source))))
    distinct = dict(texts.groupBy("route").agg(F.sum("text.size")).collect())
    sizes: dict = defaultdict(int)
    capacity: dict = defaultdict(int)
    for source, route, words in flows:
        sizes[source] += words
        capacity[route] += words
    target = quotas(dict(sizes), weights, most)
    supply = {}
    for route, words in capacity.items():
        once = distinct.get(route, 0)
        left, steps = most * words, []
        for cost in range(_FREE_PASSES):
            steps.append((min(once, left), cost))
            left -= steps[-1][0]
        supply[route] = [*steps, (left, _FREE_PASSES)]
    used = min_cost_flow(supply, [(route, source, most * words) for source, route, words in flows],
                         _whole(target, sum(sizes.values())))
    given = [
        (source, route.own, route.route, words, used[route, source], sizes[source], target[source])
        for source, route, words in flows
    ]
    given = spark.createDataFrame(
        given, "source string, own string, route long, words long, flow long, source_size long, target double")
    given = given.select("source", F.struct("own", "route").alias("route"), "words", "flow", "source_size", "target")
    taken = _taken(placed, given)
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def _taken(placed: DataFrame, given: DataFrame) -> DataFrame:
    """``placed`` with the words taken of each document, for the flow of each source and route."""
    # A source and a pattern are told apart by number from here on; there is a row for each in ``given``.
    given = given.withColumn("group", F.xxhash64(F.to_json(F.struct("source", "route"))))
    order = F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("h1"))
    rows = placed.withColumn("group", F.xxhash64(F.to_json(F.struct("source", "route"))))
    rows = rows.withColumn("order", order).withColumn("range", F.pmod(F.col("order"), F.lit(RANGES)).cast("int"))
    ranges = rows.groupBy("group", "range").agg(F.sum("size").alias("in_range"))
    before = F.sum("in_range").over(Window.partitionBy("group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.withColumn("before", F.coalesce(before, F.lit(0)))
    rest = given.where("words > 0").withColumns(
        {"whole": F.expr("flow div words"), "rest": F.expr("flow % words")}).drop("words", "flow", "source", "route")
    ranges = materialize(ranges.join(F.broadcast(rest.select("group", "rest")), "group").select(
        "group", "range", "before", "rest", (F.col("before") + F.col("in_range") <= F.col("rest")).alias("all"),
        (F.col("before") >= F.col("rest")).alias("none")), "ranges")
    split = ranges.where("not all and not none").select("group", "range", "before")
    rows = rows.join(F.broadcast(rest), "group", "left")
    # A group has one range in which its quota ends, so there is at most one row per group of ``given`` to broadcast.
    marks = rows.join(F.broadcast(split), ["group", "range"], "left")
    cut = marks.where("before is not null")
    already = F.sum("size").over(
        Window.partitionBy("group", "range").orderBy("order", "doc_id", "h1", "h2").rowsBetween(Window.unboundedPreceding, -1))
    cut = cut.withColumn("extra", F.least(F.col("size"), F.greatest(F.lit(0), F.col("rest") - F.col("before") - F.coalesce(already, F.lit(0)))))
    ends = split.select("group", F.col("range").alias("end"))
    whole = marks.where("before is null").join(F.broadcast(ends), "group", "left")
    # Without such a range the quota ends between two ranges: the first one that is not used tells where.
    first_unused = ranges.where("none").groupBy("group").agg(F.min("range").alias("unused"))
    whole = whole.join(F.broadcast(first_unused), "group", "left")
    use = (F.col("range") < F.coalesce("end", "unused", F.lit(RANGES))) & (F.col("rest") > 0)
    whole = whole.withColumn("extra", F.when(use, F.col("size")).otherwise(0)).drop("end", "unused")
    every = whole.unionByName(cut)
    known = F.coalesce(F.col("whole") * F.col("size") + F.col("extra"), F.lit(0)).cast("long").alias("taken")
    sizes = given.select("group", F.col("source_size"), F.col("target"))
    return every.drop("source_size", "target").join(F.broadcast(sizes), "group", "left").select(
        "doc_id", "size", "source_size", "target", known)
