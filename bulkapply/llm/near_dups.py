"""Near-duplicate groups by a multi-index Hamming join of b-bit MinHash signatures, confirmed on the full shingle sets.

A document's signature has ``SYMBOLS`` MinHash values of 8 bits each. Two documents are candidates if their signatures
differ in at most ``DISTANCE`` symbols. The signature is cut into 16 chunks of five symbols; with at most 31 differing symbols
at least one chunk has at most one (pigeonhole), so every chunk is entered five times, each time with another symbol left
out. Every pair within the distance shares one of these 80 keys. A pair of similarity 0.8 differs in 16 symbols on
average and exceeds 31 with a probability of about 2 in 100,000; candidates are then confirmed on the full sets.

Copies share one node, a number of their own. Pairs of a bucket are not all written out: first every member meets one leader of its buckets,
confirmed links merge into components, and only members of *different* components of a bucket are then compared, in parts
of bounded size: by signature, and those near enough by their sets cut to 32-bit hashes, so only links are written out,
to be confirmed on the full sets too. Shingle sets are made again from the texts of candidates only. Components come from label propagation with pointer jumping on written tables.

Defined cases: a null or empty text or one of blanks has an empty set, is linked with nothing and kept. Fewer words than a
shingle make one shingle. A row without doc_id has no component and is kept. Rows that share a doc_id are one
document, also with different texts: it is linked through any of them, and all its rows have one component. Only doc_id and text are read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bulkapply.llm.common import in_arrow, join_counted, restrict
from bulkapply.storage import materialize

CHUNKS, CHUNK = 16, 5
SYMBOLS = CHUNKS * CHUNK
DISTANCE = 2 * CHUNKS - 1
LONGS = SYMBOLS // 8
# So many nodes, some 60 bytes each, are broadcast to find their texts; more are joined by a shuffle.
BROADCAST_NODES = 500_000
# Members of a bucket that meet in one go.
MEETING = 1024
_CACHED_WORDS = 500_000
_BLOCK = 1024
_SEED = 20240229


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _CACHED_WORDS:
            self.clear()
        self[word] = hashed = xxhash.xxh3_64_intdigest(word)
        return hashed


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, size: int, hashes: dict) -> np.ndarray:
    """The sorted hashes of the distinct shingles of ``size`` words; A-Z lower-cased."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([hashes[b" ".join(words) + b" %d" % len(words)]], np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    rolled = each[:n].copy()
    for i in range(1, size):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + each[i : i + n]
    return np.unique(_mixed(rolled))


def signature(hashes: np.ndarray, multipliers: np.ndarray, offsets: np.ndarray) -> bytes:
    """The low 8 bits of a mix of each minimum under the hash functions."""
    short = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    least = np.full(len(multipliers), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), _BLOCK):
        block = short[at : at + _BLOCK, None] * multipliers + offsets
        np.minimum(least, block.min(axis=0), out=least)
    return (((least ^ (least >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(24)).astype(np.uint8).tobytes()


def _functions(symbols: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(_SEED + symbols)
    return (random.integers(0, 2**32, symbols, np.uint32) | np.uint32(1)), random.integers(0, 2**32, symbols, np.uint32)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, set_hash, s0 .. s9``: the number of shingles, a hash of the whole set, the signature."""

    def sketch(batches):
        import xxhash

        cache, (multipliers, offsets) = _WordHashes(), _functions(SYMBOLS)
        for batch in batches:
            sizes, hashed, signed = [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), size, cache)
                sizes.append(len(found))
                hashed.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signed.append(signature(found, multipliers, offsets) if len(found) else bytes(SYMBOLS))
            signs = np.frombuffer(b"".join(signed), np.int64).reshape(-1, LONGS)
            yield [batch.column(0), sizes, hashed, *np.ascontiguousarray(signs.T)]

    longs = ", ".join(f"s{i} long" for i in range(LONGS))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return in_arrow(rows, sketch, f"doc_id long, n_shingles long, set_hash binary, {longs}")


def _keys(nodes: DataFrame) -> DataFrame:
    """``key, node``: for each chunk and each symbol of it that may differ, the other symbols with their place."""

    def enumerate_keys(batches):
        for batch in batches:
            node = batch.column(0).to_numpy()
            signs = np.ascontiguousarray(np.stack([batch.column(i + 1).to_numpy() for i in range(LONGS)], axis=1))
            symbols = signs.view(np.uint8).reshape(-1, CHUNKS, CHUNK).astype(np.int64)
            for chunk in range(CHUNKS):
                for out in range(CHUNK):
                    key = np.full(len(node), chunk * CHUNK + out, np.int64)
                    for i in range(CHUNK):
                        if i != out:
                            key = key << 8 | symbols[:, chunk, i]
                    yield [key, node]

    return in_arrow(nodes.select("node", *(f"s{i}" for i in range(LONGS))), enumerate_keys, "key long, node long")


def _buckets(keys: DataFrame) -> DataFrame:
    """The rows of keys that several nodes have, each with the key's smallest node; streamed in key order."""

    def runs(batches):
        last, first, told = None, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            lengths = np.diff(np.r_[starts, len(key)])
            leaders = node[starts].copy()
            several = lengths > 1
            if key[0] == last:
                leaders[0], several[0] = first, True
                if not told:
                    yield [[last], [first], [first]]
                    told = True
            keep = np.repeat(several, lengths)
            yield [key[keep], node[keep], np.repeat(leaders, lengths)[keep]]
            if len(starts) > 1 or key[0] != last:
                told = bool(several[-1])
            last, first = key[-1], leaders[-1]

    dealt = keys.repartition("key").sortWithinPartitions("key", "node")
    return in_arrow(dealt, runs, "key long, node long, leader long")


def _distance(a: str, b: str) -> str:
    """SQL for the number of symbols in which the signatures of two rows differ."""
    terms = []
    for i in range(LONGS):
        x = f"({a}.s{i} ^ {b}.s{i})"
        folded = " | ".join([x, *(f"shiftrightunsigned({x}, {k})" for k in range(1, 8))])
        terms.append(f"bit_count(({folded}) & {0x0101010101010101}L)")
    return " + ".join(terms)


def _near(a: str, b: str, percent: int) -> str:
    """SQL for what two rows must meet before their sets are compared: signature distance and ratio of set sizes."""
    sizes = f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n)"
    return f"{sizes} and {_distance(a, b)} <= {DISTANCE}"


def _sets_of(docs: DataFrame, nodes: DataFrame, classes: DataFrame, size: int, make, schema: str) -> DataFrame:
    """``node`` and the columns that ``make`` gives for its shingles, of each of ``nodes``; repeated rows give a row each.

    A node's text is that of its smallest doc_id; where an id has several texts, the hash of the set tells which. Texts stay where
    they are while the nodes are few enough to broadcast, which is counted.
    """
    wanted = materialize(nodes.select("node").distinct().join(classes.select("node", "doc_id", "set_hash"), "node"), "wanted")
    few = wanted.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows = rows.join(F.broadcast(wanted) if few else wanted, "doc_id").select("node", "text", "set_hash")

    def sets(batches):
        import xxhash

        cache = _WordHashes()
        for batch in batches:
            found = [shingles(text.as_py(), size, cache) for text in batch.column(1)]
            own = [i for i, each in enumerate(found) if xxhash.xxh3_128_digest(each.tobytes()) == batch.column(2)[i].as_py()]
            yield [batch.column(0).take(own) if own else [], *make([found[i] for i in own])]

    return in_arrow(rows, sets, f"node long, {schema}")


def _short_sets(docs: DataFrame, rows: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """``node, n, sign, members`` of each node of ``rows``: how many shingles, the signature, and their hashes cut to 32 bits."""
    functions = _functions(SYMBOLS)

    def cut(found):
        return [[len(each) for each in found], [signature(each, *functions) for each in found],
                [np.unique(each.astype(np.uint32)).tobytes() for each in found]]

    found = _sets_of(docs, rows, classes, size, cut, "n long, sign binary, members binary")
    return materialize(found.groupBy("node").agg(*(F.first(c).alias(c) for c in ("n", "sign", "members"))), "short-sets")


def _crossing(rows: DataFrame, percent: int) -> DataFrame:
    """``a, b``: pairs of a bucket in different components, near by set size, signature and sets of short hashes.

    A bucket of more than ``MEETING`` members is cut into parts, and each two of them meet in a group of their own, so neither
    memory nor a task's rows grow with a bucket.
    """
    parts = F.ceil(F.col("n_members") / MEETING)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node", "key"), parts).cast("int"))
    rows = rows.select("key", "node", "component", "n", "sign", "members", "part", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))).alias("other"))
    rows = rows.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")}).drop("other")
    dealt = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    dealt = dealt.select("node", "component", "n", "part", "sign", "members", "key", "low", "high")

    def first_shared(equal: np.ndarray) -> np.ndarray:
        """The number of the first key that pairs share, from which of their symbols are equal."""
        chunks = equal.reshape(-1, CHUNKS, CHUNK)
        chunk = (chunks.sum(axis=2) >= CHUNK - 1).argmax(axis=1)
        return chunk * CHUNK + (~chunks[np.arange(len(chunks)), chunk]).argmax(axis=1)

    def near(group, key: int) -> tuple[np.ndarray, np.ndarray]:
        node, component, n, part, sign, members = group
        members = [np.frombuffer(each, np.uint32) for each in members]
        found_a, found_b = [], []
        inside = part.min() == part.max()
        for i in range(len(node) - 1):
            rest = slice(i + 1, None)
            meets = component[rest] != component[i]
            meets &= 100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i])
            if not inside:
                meets &= part[rest] != part[i]
            at = i + 1 + np.flatnonzero(meets)
            if len(at):
                # A pair meets in every bucket it shares and is compared in the first.
                equal = sign[at] == sign[i]
                at = at[(equal.sum(axis=1) >= SYMBOLS - DISTANCE) & (first_shared(equal) == key >> 8 * (CHUNK - 1))]
            if len(at):
                others = [members[j] for j in at]
                every, mine = np.concatenate(others), members[i]
                hits = mine[np.minimum(np.searchsorted(mine, every), len(mine) - 1)] == every
                # Of the common shingles no more are lost in the cut than of either set.
                slack = np.minimum(n[i] - len(mine), n[at] - np.array([*map(len, others)]))
                common = slack + np.add.reduceat(hits, np.cumsum([0, *map(len, others[:-1])]), dtype=np.int64)
                at = at[100 * common >= percent * (n[at] + n[i] - common)]
                found_a.append(np.minimum(node[at], node[i]))
                found_b.append(np.maximum(node[at], node[i]))
        none = np.empty(0, np.int64)
        return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])

    def meet(batches):
        held, last = [], None

        def group():
            return near([np.concatenate(c) for c in zip(*held)], last[0])

        for batch in batches:
            if not batch.num_rows:
                continue
            node, component, n, part = (batch.column(i).to_numpy() for i in range(4))
            sign = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, SYMBOLS)
            members = np.array([*batch.column(5).to_pylist(), None], object)[:-1]
            ids = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in (6, 7, 8)])
            edges = [0, *(1 + np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0))).tolist(), len(node)]
            out_a, out_b = [], []
            for x, y in zip(edges, edges[1:]):
                this = tuple(ids[:, x])
                if this != last and held:
                    for out, pairs in zip((out_a, out_b), group()):
                        out.append(pairs)
                    held = []
                last = this
                held.append([node[x:y], component[x:y], n[x:y], part[x:y], sign[x:y], members[x:y]])
            if out_a:
                yield [np.concatenate(out_a), np.concatenate(out_b)]
        if held:
            yield list(group())

    return in_arrow(dealt, meet, "a long, b long")


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Those written ``a, b`` whose full shingle sets have the similarity asked for."""

    def full(found):
        import pyarrow as pa

        ends = np.cumsum([0, *map(len, found)])
        values = np.concatenate([np.empty(0, np.int64), *(each.view(np.int64) for each in found)])
        return [pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(values)).cast(pa.list_(pa.int64()))]

    asked = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    sets = materialize(_sets_of(docs, asked, classes, size, full, "members array<long>"), "sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("of_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("members").alias("of_b")), "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return both.where(100 * common >= percent * union).select("a", "b").distinct()


def _same_id(sketched: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, set_hash`` of documents with several texts, and ``a, b``: links between the nodes of each of them."""
    short = F.when(F.col("set_hash").isNotNull(), F.xxhash64("set_hash"))
    several = sketched.where("doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min(short).alias("low"), F.max(short).alias("high"), F.count(short).alias("full"))
    several = several.where("rows > 1 and (low <> high or full between 1 and rows - 1)").select("doc_id")
    texts = materialize(sketched.select("doc_id", "set_hash").join(several, "doc_id").distinct(), "texts-of-one-id")
    nodes = texts.join(classes.select("set_hash", "node"), "set_hash").select("doc_id", "node")
    first = nodes.groupBy("doc_id").agg(F.min("node").alias("a"))
    return texts, nodes.join(first, "doc_id").where("a <> node").select("a", F.col("node").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node that each node of the written ``edges`` (a, b) reaches.

    Each round takes the smallest label among the neighbours and then the label's own label; both are aggregations and
    joins of rows of two numbers, and each round's labels are written, so a lost executor costs one round at most.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("label"))
    labels = materialize(least.select(F.col("a").alias("node"), F.least("a", "label").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        now = materialize(
            nearer.join(jump, "label").select("node", "before", F.least("label", "further").alias("label")), "labels")
        labels = now.select("node", "label")
        if now.where("label <> before").isEmpty():
            return labels.withColumnRenamed("label", "component")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, a row for each row of ``docs``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of shingles of ``size`` words.
    """
    sketched = materialize(sketches(docs, size), "sketches")
    numbers = [f"s{i}" for i in range(LONGS)]
    # Numbered in the order of their ids: what is copied is mostly older than its copies and more like each of them than they are
    # among themselves, so it should lead its buckets. Written, so that the numbers are the same whenever they are read.
    classes = materialize(
        sketched.where("set_hash is not null and doc_id is not null").groupBy("set_hash").agg(
            F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n"),
            *(F.first(c).alias(c) for c in numbers)).orderBy("doc_id", "set_hash").withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    texts, same_id = _same_id(sketched, classes)
    bucketed = materialize(_buckets(_keys(classes)), "buckets")

    # Every node meets the leader with which it shares most keys.
    shared = bucketed.where("node <> leader").groupBy("node", "leader").count()
    best = shared.groupBy("node").agg(F.max_by("leader", F.struct("count", -F.col("leader"))).alias("leader"))
    signed = classes.select("node", "n", *numbers)
    x = best.join(signed, "node").select(F.struct("node", "n", *numbers).alias("x"), F.col("leader").alias("node"))
    met = x.join(signed.select("node", F.struct("n", *numbers).alias("y")), "node")
    met = materialize(
        met.where(_near("x", "y", percent)).select(F.col("node").alias("a"), F.col("x.node").alias("b")).distinct(), "met")
    links = materialize(_confirmed(met, docs, classes, size, percent).union(same_id), "links")
    groups = components(links)

    # Then the members of different components within a bucket.
    member = bucketed.select("key", "node").join(groups, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    member = materialize(member, "members")
    apart = member.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n_members"))
    apart = apart.where("low <> high").select("key", "n_members")
    open_rows = materialize(member.join(apart, "key"), "open")
    sets = _short_sets(docs, open_rows, classes, size)
    pairs = materialize(_crossing(open_rows.join(sets, "node"), percent).distinct(), "pairs")
    more = _confirmed(pairs, docs, classes, size, percent)
    labels = components(materialize(links.union(more), "links"))

    # A component is named by the smallest doc_id of all its texts.
    labelled = classes.select("set_hash", "node", "doc_id", "copies").join(labels, "node", "left").select(
        "set_hash", "doc_id", "copies", F.coalesce("component", "node").alias("label"))
    labelled = materialize(labelled, "labelled")
    named = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n_classes"))
    of_class = join_counted(labelled.drop("doc_id"), materialize(named, "components"), "label", "n_classes").drop("label")
    of_class = materialize(of_class, "class-components")
    rows = join_counted(sketched.select("doc_id", "n_shingles", "set_hash"), of_class, "set_hash", "copies")
    # A row without words goes with the other texts of its id.
    of_id = texts.join(of_class, "set_hash").groupBy("doc_id").agg(F.min("component_id").alias("of_id"))
    rows = rows.join(materialize(of_id, "components-of-ids"), "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "of_id", "doc_id")).alias("component_id")
    return rows.select("doc_id", "n_shingles", component).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without those that a near duplicate of smaller id stands for."""
    found = near_duplicates(docs, size, percent)
    dropped = materialize(found.where("not kept").select("doc_id").distinct(), "dropped")
    return restrict(docs, dropped, ["doc_id"], "left_anti")
