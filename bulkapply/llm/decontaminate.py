"""Benchmark passages in documents: SimHash fingerprints of item-sized windows, a multi-index Hamming join, exact similarity.

Texts are cut into shingles of ``SHINGLE`` lower-cased words of letters and digits. A shingle weighs the more, the fewer items have
it, as ln(1 + items / items with it). A window of 0.8 weighted Jaccard similarity with an item holds 0.8 of the item's
weight, wherever in the window, so three bounds leave out only what cannot be as alike:

1. A document is looked at for an item if it has one of the item's rarest shingles, as many as hold more than 0.2 of its weight.
2. It stays if what it has of the item's shingles, at any place, weighs 0.8 of the item.
3. Its windows of the item's size are fingerprinted if the item's shingles inside weigh as much. Where these windows begin follows from
   running sums over the places of the item's shingles.

A fingerprint has 64 bits; each is the sign of a sum over the window's shingles, which vote by their hash with the square root of their
weight, so that the angle between two bags follows their weighted similarity. Fingerprints have four blocks of 16 bits; two
within ``RADIUS`` = 19 bits agree in some block up to 4 bits (pigeonhole), and the items are entered under all values that near, so the
join finds every pair within the radius. Windows of similarity 0.8 lie 10 bits from their item on average, and beyond 19 about once in
a thousand; more alike ones hardly ever. Candidates are confirmed by the weighted Jaccard similarity of the shingle multisets.

Everything is DataFrame expressions. Texts are not shuffled, but for those of documents that pass the first bound.

Defined cases: null and empty texts and texts shorter than a shingle contain nothing; such items are never found. A window is
clipped at the edges of the text, so a passage that lacks a little of its beginning or end there is found; a passage in another
order is found as well as one in its own. Rows are told apart by id and text, so null and repeated ids are judged by their own text;
repeated rows give one result. Only doc_id, text and item_id, text of the benchmark are read, so other columns may have any name.
Empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bulkapply.llm.common import restrict
from bulkapply.storage import materialize

SHINGLE = 5
RADIUS = 19
BLOCKS, BLOCK_BITS = 4, 16
SIMILAR = 0.8
# The items' rarest shingles are broadcast in blocks of at most this many rows, some 30 bytes each.
BROADCAST_SHINGLES = 1_000_000
# Votes are whole numbers, so that sums do not depend on their order.
_VOTE = 1000
_SLACK = 1e-9
_WORD = r"[\p{L}\p{N}]+"


def _shingles(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the hashes of the shingles of a column in ``shingles``, in order."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(_WORD), F.lit(0))
    rows = rows.withColumn("_words", words).drop(text)
    starts = F.sequence(F.lit(0), F.size("_words") - SHINGLE)
    hashed = F.transform(starts, lambda i: F.xxhash64(*(F.get("_words", i + k) for k in range(SHINGLE))))
    none = F.array().cast("array<bigint>")
    return rows.withColumn("shingles", F.when(F.size("_words") >= SHINGLE, hashed).otherwise(none)).drop("_words")


def _votes(shingle: Column, vote: Column) -> list[Column]:
    """Per bit the sum of votes: for if a shingle's hash has the bit, against if not."""
    bit = lambda b: F.call_function("shiftrightunsigned", shingle, F.lit(b)).bitwiseAND(F.lit(1))
    return [F.sum(vote * (2 * bit(b) - 1)).alias(f"_bit_{b}") for b in range(64)]


def _fingerprint() -> Column:
    """The signs of ``_votes``; a tie counts as against."""
    one = lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(b))
    zero = F.lit(0).cast("long")
    return reduce(Column.bitwiseOR, [F.when(F.col(f"_bit_{b}") > 0, one(b)).otherwise(zero) for b in range(64)])


def _vote(weight: Column) -> Column:
    return F.round(F.sqrt(weight) * _VOTE).cast("long")


def _block(fingerprint: Column, block: Column) -> Column:
    return F.call_function("shiftrightunsigned", fingerprint, (block * BLOCK_BITS).cast("int")).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")


def _suspects(docs: DataFrame, rare: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with a rare shingle of an item (``doc, doc_id, text_hash, shingles``), and which items (``doc, item``)."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    # The outer form: for the plain one Spark would test the size of the array below, making the words anew for each shingle.
    each = _shingles(rows, "text").select("doc_id", "text_hash", F.explode_outer("shingles").alias("shingle"))
    n_blocks = -(-rare.count() // BROADCAST_SHINGLES) or 1
    blocks = [rare.where(F.pmod(F.hash("shingle"), F.lit(n_blocks)) == block) for block in range(n_blocks)]
    found = [each.join(F.broadcast(block), "shingle").select("doc_id", "text_hash", "item") for block in blocks]
    met = materialize(reduce(DataFrame.union, found).distinct(), "met")
    named = materialize(met.select("doc_id", "text_hash").distinct(), "suspect-ids")
    texts = _shingles(restrict(rows, named, ["doc_id", "text_hash"], "left_semi"), "text").dropDuplicates(["doc_id", "text_hash"])
    texts = materialize(texts.withColumn("doc", F.monotonically_increasing_id()), "suspects")
    same = met["doc_id"].eqNullSafe(texts["doc_id"]) & (met["text_hash"] == texts["text_hash"])
    return texts, materialize(met.join(texts, same).select("doc", "item"), "suspect-items")


def _held(texts: DataFrame, pairs: DataFrame, bags: DataFrame, items: DataFrame) -> DataFrame:
    """Those ``doc, item`` of which the document has shingles of ``SIMILAR`` of the item's weight, at any place."""
    here = texts.select("doc", F.explode("shingles").alias("shingle")).groupBy("doc", "shingle").agg(F.count(F.lit(1)).alias("here"))
    shared = here.join(bags, "shingle").join(pairs, ["doc", "item"])
    held = shared.groupBy("doc", "item").agg(F.sum(F.least("here", "times") * F.col("weight")).alias("held"))
    return held.join(items, "item").where(F.col("held") >= F.col("total") * SIMILAR - _SLACK).select("doc", "item", "m", "total")


def _within(frame: str) -> Column:
    """The weight of an item's shingles in a frame of a window's length; Column frames take no fractions."""
    return F.expr(f"sum(weight) OVER (PARTITION BY doc, item ORDER BY x RANGE BETWEEN {frame})")


def _starts(texts: DataFrame, held: DataFrame, bags: DataFrame) -> DataFrame:
    """``doc, m, start`` of the windows whose shingles of an item weigh ``SIMILAR`` of it.

    A window's first shingle of the item is one from which as much weighs within a window's length, and it reaches at
    least to the next one up to which as much does. Places are divided by the window's length, so one frame serves all lengths.
    """
    places = texts.select("doc", F.posexplode("shingles").alias("at", "shingle"))
    hits = places.join(bags.select("item", "shingle", "weight"), "shingle").join(held, ["doc", "item"])
    enough = F.col("total") * SIMILAR - _SLACK
    by = Window.partitionBy("doc", "item").orderBy("x")
    hits = hits.withColumn("x", F.col("at") / F.col("m"))
    hits = hits.select(
        "doc", "item", "m", "at", "x",
        (_within("CURRENT ROW AND 0.999999999D FOLLOWING") >= enough).alias("begins"),
        (_within("0.999999999D PRECEDING AND CURRENT ROW") >= enough).alias("ends"),
        F.lag("at").over(by).alias("before"))
    reach = F.min(F.when(F.col("ends"), F.col("at"))).over(by.rowsBetween(0, Window.unboundedFollowing))
    hits = hits.select("doc", "m", "at", "before", "begins", reach.alias("reach"))
    first = F.greatest(F.coalesce(F.col("before") + 1, F.col("at") - F.col("m") + 1), F.col("reach") - F.col("m") + 1)
    starts = hits.where("begins and reach is not null").select("doc", "m", first.cast("int").alias("first"), "at").where("first <= at")
    return starts.select("doc", "m", F.explode(F.sequence("first", "at")).alias("start")).distinct()


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, text_hash, item_id, similarity, start``: the best window of each item in each document, 0.8 or more alike.

    ``start`` counts words from the beginning of the text and is negative if the window begins before it.
    """
    listed = _shingles(benchmark.select("item_id", "text").where("item_id is not null"), "text")
    listed = materialize(listed.distinct().withColumn("item", F.xxhash64("item_id", "shingles")), "items")
    listed = listed.where(F.size("shingles") > 0)
    n_items = float(listed.count())
    heaviest = F.log1p(F.lit(n_items))
    placed = listed.select("item", F.explode("shingles").alias("shingle"))
    weights = materialize(
        placed.groupBy("shingle").agg(F.log1p(F.lit(n_items) / F.count_distinct("item")).alias("weight")), "weights")
    bags = placed.groupBy("item", "shingle").agg(F.count(F.lit(1)).alias("times"))
    bags = materialize(bags.join(weights, "shingle"), "item-bags")
    weight = F.sum(F.col("times") * F.col("weight"))
    items = materialize(bags.groupBy("item").agg(
        F.sum("times").alias("m"), weight.alias("total"), *_votes(F.col("shingle"), F.col("times") * _vote(F.col("weight")))
    ).select("item", "m", "total", _fingerprint().alias("of_item")), "item-fingerprints")
    sizes = items.select("item", "m", "total")

    # The rarest shingles of each item, until they hold more than a window may lack.
    rarest = Window.partitionBy("item").orderBy(F.desc("weight"), "shingle").rowsBetween(Window.unboundedPreceding, -1)
    rare = bags.withColumn("before", F.coalesce(F.sum(F.col("times") * F.col("weight")).over(rarest), F.lit(0.0))).join(sizes, "item")
    rare = rare.where(F.col("before") <= F.col("total") * (1 - SIMILAR) + _SLACK)
    texts, pairs = _suspects(docs, materialize(rare.select("shingle", "item"), "rare-shingles"))
    held = materialize(_held(texts, pairs, bags, sizes), "held")
    starts = materialize(_starts(texts, held, bags).withColumn("window", F.monotonically_increasing_id()), "starts")

    first = F.greatest(F.col("start"), F.lit(0))
    inside = F.slice("shingles", first + 1, (F.least(F.col("start") + F.col("m"), F.size("shingles")) - first).cast("int"))
    shingles = starts.join(texts.select("doc", "shingles"), "doc").select("window", F.explode(inside).alias("shingle"))
    weighed = shingles.join(weights, "shingle", "left").select("window", "shingle", F.coalesce("weight", heaviest).alias("weight"))
    windows = materialize(weighed.groupBy("window").agg(
        F.sum("weight").alias("here"), *_votes(F.col("shingle"), _vote(F.col("weight")))
    ).select("window", "here", _fingerprint().alias("fingerprint")), "windows")

    # Every item under every value of a block that differs from its own in few enough bits.
    errors = RADIUS // BLOCKS
    block = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))
    masks = F.filter(F.sequence(F.lit(0), F.lit((1 << BLOCK_BITS) - 1)), lambda mask: F.bit_count(mask) <= errors)
    entries = items.select("item", "of_item", block.alias("block"))
    entries = entries.select("item", "of_item", "block", F.explode(masks).alias("mask"))
    entries = entries.select("item", "of_item", "block", _block(F.col("of_item"), F.col("block")).bitwiseXOR(F.col("mask")).alias("value"))
    asked = windows.select("window", "fingerprint", block.alias("block"))
    asked = asked.withColumn("value", _block(F.col("fingerprint"), F.col("block")))
    # Sorted, not broadcast: the entries grow with the benchmark.
    near = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("of_item"))) <= RADIUS
    candidates = materialize(asked.join(entries.hint("merge"), ["block", "value"]).where(near).select("window", "item").distinct(), "candidates")

    # Weighted Jaccard similarity: common weight against both weights less the common one.
    there = bags.withColumnRenamed("times", "there")
    common = shingles.join(candidates, "window").join(there, ["item", "shingle"])
    common = common.groupBy("window", "item", "shingle").agg(
        F.least(F.count(F.lit(1)), F.first("there")).alias("times"), F.first("weight").alias("weight"))
    common = common.groupBy("window", "item").agg(weight.alias("common"))
    scored = common.join(windows.select("window", "here"), "window").join(sizes, "item")
    similarity = F.col("common") / (F.col("here") + F.col("total") - F.col("common"))
    alike = scored.select("window", "item", similarity.alias("similarity")).where(F.col("similarity") >= SIMILAR - _SLACK)
    hits = alike.join(starts.select("window", "doc", "start"), "window").join(texts.select("doc", "doc_id", "text_hash"), "doc")
    hits = hits.join(listed.select("item", "item_id"), "item")
    best = F.max(F.struct("similarity", -F.col("start"))).alias("best")
    return hits.groupBy("doc_id", "text_hash", "item_id").agg(best).select(
        "doc_id", "text_hash", "item_id", "best.similarity", (-F.col("best.col2")).alias("start"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a passage of the benchmark."""
    found = materialize(find(docs, benchmark).select("doc_id", "text_hash").distinct(), "contaminated")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct(*(docs[c] for c in docs.columns)).alias("doc"))
    return restrict(rows, found, ["doc_id", "text_hash"], "left_anti").select("doc.*")
