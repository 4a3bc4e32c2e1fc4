"""Language-model scores: prediction by partial matching over bytes, beside a smoothed word-count model.

The contexts of up to ``ORDER`` bytes before every byte of the training texts are counted, the end of a text being a symbol of
its own (byte 0). A context's symbols get c / (C + q), the escape q / (C + q), with C occurrences of q symbols (method C);
what escapes goes to the next shorter context without the symbols already offered (exclusion). A pretrained trie gives
fixed probabilities, so each context's whole row of symbols is worked out once per worker, and scoring a text is three table
look-ups per byte. The trie keeps all contexts of one byte and, of longer ones, the ``CONTEXTS`` most frequent per order. Their
counts are gathered and broadcast; the tables, at most 240 megabytes if all 256 bytes occur, some 100 for texts of a few scripts,
are made of them by the workers and never by the driver. The trie only saves work: a byte behind ``ORDER``
bytes that are not in it is looked up as a piece with them, in the broadcast values of the ``VALUES`` most frequent such pieces, else
by a join with the written values of all pieces, summed per document. Pieces that only held-out texts have get their value by
joins with the counts of each order. So all counted contexts take part in every score, however many there are.

The word model takes the counts of all words. The ``FREQUENT`` most frequent are broadcast; the other words of a text meet their
counts in a join on the word, so every word counts however many there are.

Defined cases: a null text is empty, one end symbol. Documents without an id are trained on and not held out. Without
training texts the trie is uniform and the word counts are 0. Repeated rows are scored alike. Only doc_id and text are read,
so other columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

import ctypes
import math
from collections import Counter
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkapply.llm.common import held_out, in_arrow
from bulkapply.storage import materialize

ORDER = 5
SHORT = 3
CONTEXTS = {2: 16_000, 3: 32_000, 4: 40_000, 5: 40_000}
VALUES = 2_000_000
FREQUENT = 100_000
FOLDS, HELD_OUT = 10, 0
ADDED = 0.1
_END = b""
_PAD = bytes(ORDER)
# Bytes of text counted and scored at once; scoring holds some 40 bytes of arrays for each.
_CHUNK = 1 << 19
_SCORE_CHUNK = 1 << 17
_TEXTS = 1 << 15
# Texts scored at once, so that a worker holds few of them beside the tables.
_SCORED = 500
_ROWS = 1024
# Words and pieces that a worker counts before it hands them over, and pieces that come before they are merged with the others.
_WORDS_AT_ONCE = 400_000
_GRAMS_AT_ONCE = 1_200_000
_GRAMS_MERGED = 400_000
# Bytes in an Arrow batch that a worker gets, and rows of counts in one that it hands over.
_BATCH = "4m"
_TOLD = 1 << 16


def words(text: bytes) -> list[bytes]:
    """The words of a text, A-Z lower-cased."""
    return text.lower().split()


def _stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts, each behind ``ORDER`` zero bytes and before its end symbol, and where each begins."""
    joined = np.frombuffer(_PAD + _PAD.join(texts) + b"\0", np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return joined, ORDER + np.r_[0, np.cumsum(lengths + ORDER)[:-1]]


def _chunks(texts, wanted: int):
    """Lists of texts of about ``wanted`` bytes, at most ``_TEXTS``."""
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size >= wanted or len(block) == _TEXTS:
            yield block
            block, size = [], 0
    if block:
        yield block


@contextmanager
def _small_batches(spark: SparkSession):
    """Arrow batches of at most some megabytes in the queries run meanwhile, unless the session sets a limit itself.

    By default one holds a whole partition's texts, in the JVM's own memory, beside the heap, and again in the worker.
    """
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    unset = spark.conf.get(limit, None) is None
    if unset:
        spark.conf.set(limit, _BATCH)
    try:
        yield
    finally:
        if unset:
            spark.conf.unset(limit)


def _release() -> None:
    """Give freed memory back to the system: workers live on after a task, and beside them the JVM needs it."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.pythonapi, "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def _slices(batches):
    """Arrow batches of at most ``_SCORED`` rows."""
    for whole in batches:
        for at in range(0, whole.num_rows, _SCORED):
            yield whole.slice(at, _SCORED)


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pieces of ``ORDER`` bytes and the following symbol, as numbers, and how often each occurs."""
    stream, starts = _stream(texts)
    n = len(stream) - ORDER
    number = stream[:n].astype(np.int64)
    for i in range(1, ORDER + 1):
        number <<= 8
        number |= stream[i : n + i]
    wanted = np.ones(n, bool)
    for i in range(1, ORDER):
        wanted[starts[1:] - ORDER - i] = False
    return np.unique(number[wanted], return_counts=True)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sums by number, sorted. Empties the list, so that the parts are not held beside their sums."""
    numbers, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    parts.clear()
    order = np.argsort(numbers, kind="stable")
    numbers, counts = numbers[order], counts[order]
    del order
    first = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]])
    return numbers[first], np.add.reduceat(counts, first)


def _count(batches):
    """Columns of ``counted`` from Arrow batches of texts; a word or piece may come more than once, to be summed."""
    import pyarrow as pa

    def told(seen: Counter):
        found, counts = list(seen), np.fromiter(seen.values(), np.int64, len(seen))
        for at in range(0, len(found), _TOLD):
            some = found[at : at + _TOLD]
            yield [pa.array(some, pa.binary()), pa.nulls(len(some), pa.int64()), counts[at : at + _TOLD]]

    def told_grams(parts):
        numbers, counts = _merged(parts)
        for at in range(0, len(numbers), _TOLD):
            some = numbers[at : at + _TOLD]
            yield [pa.nulls(len(some), pa.binary()), some, counts[at : at + _TOLD].astype(np.int64)]

    seen, parts, held = Counter(), [], 0
    for batch in _slices(batches):
        texts = [text.as_py() or b"" for text in batch.column(0)]
        for text in texts:
            seen.update(words(text))
            if len(seen) >= _WORDS_AT_ONCE:
                yield from told(seen)
                seen = Counter()
        seen[_END] += len(texts)
        for block in _chunks(texts, _CHUNK):
            parts.append(_grams(block))
            held += len(parts[-1][0])
            if held >= _GRAMS_AT_ONCE + _GRAMS_MERGED:
                parts.append(_merged(parts))
                held = len(parts[0][0])
                if held >= _GRAMS_AT_ONCE:
                    yield from told_grams(parts)
                    held = 0
    if seen:
        yield from told(seen)
        seen.clear()
    if parts:
        yield from told_grams(parts)
    _release()


def counted(docs: DataFrame) -> DataFrame:
    """``word, gram, n`` of the training texts: the words (the end as an empty word) and the pieces of ``ORDER + 1`` bytes."""
    taught = docs.where(~held_out(F.col("doc_id"), FOLDS, HELD_OUT)).select(F.col("text").cast("binary").alias("text"))
    parts = in_arrow(taught, _count, "word binary, gram long, n long")
    with _small_batches(docs.sparkSession):
        return materialize(parts.groupBy("word", "gram").agg(F.sum("n").alias("n")), "counted")


def _frequent(rows: DataFrame, limit: int) -> DataFrame:
    """The rows of largest ``n``, at most ``limit``: those above the smallest step of a sixteenth of an octave that fits.

    The driver sees how many rows each step has, some hundreds of numbers.
    """
    step = F.floor(16 * F.log2("n"))
    threshold, kept = None, 0
    for found in sorted(rows.groupBy(step.alias("step")).count().collect(), reverse=True):
        kept += found["count"]
        if kept > limit:
            break
        threshold = found["step"]
    return rows.where(step >= threshold) if threshold is not None else rows.limit(0)


class Trie:
    """The kept contexts with the probabilities of all symbols, as tables.

    ``symbol`` maps bytes to columns; bytes that no training text has share the last column. ``short`` finds the row of the
    longest kept context among the last ``SHORT`` bytes, and each of ``steps`` extends a row of full length by one byte more.
    A context counts as kept only if its suffixes are. Rows from ``full`` on are those of ``ORDER`` bytes. ``grams`` are pieces,
    sorted, whose contexts are not kept, and ``values`` their probabilities.
    """

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray]]):
        """``orders[k]``: numbers of the pieces of k context bytes and a symbol, and their counts; sorted by number."""
        numbers, counts = orders[0]
        known = np.unique(np.r_[0, numbers])
        self.width = width = len(known) + 1
        self.symbol = np.full(256, width - 1, np.int64)
        self.symbol[known] = np.arange(len(known))
        unseen = 256 - len(known)
        uniform = np.r_[np.full(len(known), 1 / 256), unseen / 256]
        # Rows of probabilities, in order; filled block by block.
        size = 1 + sum(len(np.unique(numbers >> 8)) for numbers, _ in orders[1:])
        self.log10 = np.zeros((size, width), np.float32)
        self.log10[0] = uniform
        self._fill(0, np.zeros(1, np.int64), np.zeros(1, np.int64), numbers, counts)
        # The row of each suffix of up to three bytes, given by the columns of its bytes; then one step per longer order.
        rows, begun, short, self.steps = 1, 0, np.zeros(1, np.int32), []
        for k in range(1, ORDER + 1):
            numbers, counts = orders[k]
            context = np.unique(numbers >> 8)
            columns = [self.symbol[context >> 8 * (k - 1 - i) & 255] for i in range(k)]
            place = np.zeros(len(context), np.int64)
            for c in columns[-SHORT:]:
                place = place * width + c
            parent = short[place % width ** (k - 1)] if k <= SHORT else self._walk(short, columns[1:])
            fits = parent >= begun
            context, columns, parent, place = context[fits], [c[fits] for c in columns], parent[fits], place[fits]
            kept = np.isin(numbers >> 8, context)
            numbers, counts = numbers[kept], counts[kept]
            own = np.arange(rows, rows + len(context), dtype=np.int32)
            if k <= SHORT:
                short = np.tile(short, width)
                short[place] = own
            else:
                grown = np.full((rows - begun, width), -1, np.int32)
                grown[parent - begun, columns[0]] = own
                self.steps.append((begun, grown))
            begun = rows
            self._fill(rows, parent, context, numbers, counts)
            rows += len(context)
        self.short, self.full, self.log10 = short, begun, self.log10[:rows]
        self.grams, self.values = np.empty(0, np.int64), np.empty(0, np.float32)
        self.log10[:, -1] /= max(1, unseen)
        np.maximum(self.log10, 1e-30, out=self.log10)
        np.log10(self.log10, out=self.log10)

    def _walk(self, short: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
        """The row of the longest kept suffix of the contexts whose bytes have these columns, oldest byte first."""
        place = columns[-SHORT]
        for c in columns[len(columns) - SHORT + 1:]:
            place = place * self.width + c
        row = short[place]
        for (first, grown), c in zip(self.steps, columns[-SHORT - 1::-1]):
            can = row >= first
            further = grown[np.where(can, row - first, 0), c] if len(grown) else np.full(len(row), -1, np.int32)
            row = np.where(can & (further >= 0), further, row)
        return row

    def _fill(self, first: int, parent: np.ndarray, context: np.ndarray, numbers: np.ndarray, counts: np.ndarray) -> None:
        """Rows from ``first`` on: each context's own symbols by count, the escape spread over the others as its parent has them."""
        at, column = np.searchsorted(context, numbers >> 8), self.symbol[numbers & 255]
        for begin in range(0, len(context), _ROWS):
            end = min(begin + _ROWS, len(context))
            mine = slice(*np.searchsorted(at, [begin, end]))
            own = np.zeros((end - begin, self.width))
            own[at[mine] - begin, column[mine]] = counts[mine]
            total, kinds = own.sum(axis=1, keepdims=True), (own > 0).sum(axis=1, keepdims=True)
            rest = np.where(own > 0, 0.0, self.log10[parent[begin:end]])
            left = rest.sum(axis=1, keepdims=True)
            escape = np.where(total == 0, 1.0, np.where(left > 0, kinds / np.maximum(total + kinds, 1), 0.0))
            self.log10[first + begin : first + end] = own * ((1.0 - escape) / np.maximum(total, 1)) + rest * (
                escape / np.maximum(left, 1e-300))

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
        """The log10 probability of each text with its end, without the pieces that are not known here.

        Those are the second result: for each the number of its text, ascending, the piece, and how often the text has it.
        """
        out, others, before = [np.empty(0)], [[np.empty(0, np.int64)] * 3], 0
        for block in _chunks(texts, _SCORE_CHUNK):
            stream, starts = _stream(block)
            column = self.symbol[stream]
            n = len(column) - ORDER
            row = self._walk(self.short, [column[i : n + i] for i in range(ORDER)])
            each = self.log10[row, column[ORDER:]].astype(np.float64)
            cold = row < self.full
            for i in range(1, ORDER):
                each[starts[1:] - ORDER - i] = 0.0
                cold[starts[1:] - ORDER - i] = False
            cold = np.flatnonzero(cold)
            number = np.zeros(len(cold), np.int64)
            for i in range(ORDER + 1):
                number = number << 8 | stream[cold + i]
            distinct, which = np.unique(number, return_inverse=True)
            place = np.searchsorted(self.grams, distinct)
            known = place < len(self.grams)
            known[known] = self.grams[place[known]] == distinct[known]
            value = np.zeros(len(distinct))
            value[known] = self.values[place[known]]
            each[cold] = value[which]
            missing = ~known[which]
            text = np.searchsorted(starts - ORDER, cold[missing], "right") - 1
            pairs, times = np.unique(text << 8 * (ORDER + 1) | number[missing], return_counts=True)
            others.append([before + (pairs >> 8 * (ORDER + 1)), pairs & _mask(ORDER + 1), times])
            out.append(np.add.reduceat(each, starts - ORDER))
            before += len(block)
        return np.concatenate(out), [np.concatenate(column) for column in zip(*others)]


class Counts:
    """What the driver gathers for the trie: ``orders``, ``grams`` and ``values``. Each worker makes the tables of it, once."""

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray]], grams: np.ndarray, values: np.ndarray):
        self.orders, self.grams, self.values, self._trie = orders, grams, values, None

    def trie(self) -> Trie:
        if self._trie is None:
            self._trie, self.orders = Trie(self.orders), None
            self._trie.grams, self._trie.values = self.grams, self.values
            _release()
        return self._trie


def _mask(size: int) -> int:
    return (1 << 8 * size) - 1


def _context(gram: Column) -> Column:
    return F.call_function("shiftright", gram, F.lit(8))


def _last(gram: Column, size: int) -> Column:
    """The last ``size`` bytes of a piece."""
    return gram.bitwiseAND(F.lit(_mask(size)).cast("long"))


# What a context's counts are shared by: its occurrences and its escapes, of which there are none if it has every symbol.
_SHARES = "total + if(kinds < 256, kinds, 0)"


def levels_of(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order ``gram, n`` and ``context, total, kinds, below``, from ``counted``.

    ``below`` is how often the next shorter context has the symbols of this one; without any, each byte counts once.
    """
    levels = [counts.where("gram is not null").select("gram", "n")]
    for k in range(ORDER - 1, -1, -1):
        shorter = levels[0].groupBy(_last(F.col("gram"), k + 1).alias("gram")).agg(F.sum("n").alias("n"))
        levels.insert(0, materialize(shorter, f"order-{k}"))
    out = []
    for k, level in enumerate(levels):
        if k:
            lower = levels[k - 1].select(F.col("gram").alias("suffix"), F.col("n").alias("below"))
            grams = level.withColumn("suffix", _last(F.col("gram"), k)).join(lower, "suffix")
        else:
            grams = level.withColumn("below", F.lit(1))
        contexts = grams.groupBy(_context(F.col("gram")).alias("context")).agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.sum("below").alias("below"))
        out.append((level, materialize(contexts, f"contexts-{k}")))
    return out


def train(levels: list[tuple[DataFrame, DataFrame]], values: DataFrame) -> Counts:
    """For the trie the most frequent contexts of each order whose suffixes are kept, and the most frequent other pieces."""
    orders, kept = [], None
    for k, (level, contexts) in enumerate(levels):
        if k in CONTEXTS:
            candidates = contexts.select("context", F.col("total").alias("n"))
            if kept is not None:
                suffixes = F.broadcast(kept.select(F.col("context").alias("suffix")))
                candidates = candidates.withColumn("suffix", _last(F.col("context"), k - 1)).join(suffixes, "suffix", "left_semi")
            kept = materialize(_frequent(candidates, CONTEXTS[k]).select("context"), "kept")
            level = level.withColumn("context", _context(F.col("gram"))).join(F.broadcast(kept), "context", "left_semi")
        orders.append(_sorted(level.select("gram", "n")))
    if kept is not None:
        values = values.withColumn("context", _context(F.col("gram"))).join(F.broadcast(kept), "context", "left_anti")
    return Counts(orders, *_sorted(_frequent(values, VALUES).select("gram", F.col("value").cast("float"))))


def _sorted(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Two columns as arrays, by the first; the rows as they came are let go before."""
    import pyarrow as pa

    found = rows.toArrow()
    numbers, others = found.column(0).to_numpy(), found.column(1).to_numpy()
    del found
    order = np.argsort(numbers)
    numbers, others = numbers[order], others[order]
    pa.default_memory_pool().release_unused()
    return numbers, others


def values_of(levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``gram, n, value`` of all pieces of the training texts: the log10 probability of the symbol behind the context."""
    level, contexts = levels[ORDER]
    known = level.withColumn("context", _context(F.col("gram"))).join(contexts, "context")
    return materialize(known.select("gram", "n", F.log10(F.col("n") / F.expr(_SHARES)).alias("value")), "values")


def novel_values(grams: DataFrame, levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``gram, value`` of distinct pieces that no training text has.

    From the longest context down, what is escaped is spread over the next shorter one's symbols but those already offered:
    ``left`` is how often it has the latter, null while no longer context was known.
    """
    rows = grams.select(
        "gram", F.lit(0.0).alias("spent"), F.lit(None).cast("long").alias("left"), F.lit(None).cast("double").alias("value"))
    for k in range(ORDER, -1, -1):
        level, contexts = levels[k]
        rows = rows.withColumn("piece", _last(F.col("gram"), k + 1)).withColumn("context", _context(F.col("piece")))
        rows = rows.join(level.withColumnRenamed("gram", "piece"), "piece", "left").join(contexts, "context", "left")
        shares = F.expr(_SHARES)
        spent = F.col("spent") - F.when(F.col("left").isNull(), 0.0).otherwise(F.log10((shares - F.col("left")) / shares))
        escape = F.log10(F.col("kinds") / (F.col("total") + F.col("kinds")))
        known = F.col("total").isNotNull()
        rows = rows.select(
            "gram",
            F.when(known, spent + escape).otherwise(F.col("spent")).alias("spent"),
            F.when(known, F.col("below")).alias("left"),
            F.coalesce("value", F.when(F.col("n").isNotNull(), spent + F.log10(F.col("n") / shares))).alias("value"))
    uniform = F.col("spent") - F.log10(256 - F.coalesce("left", F.lit(0)))
    return rows.select("gram", F.coalesce("value", uniform).alias("value"))


def _scorer(shared, frequent):
    """The function of ``score`` over Arrow batches of ``row, doc_id, held_out, text``, from broadcast ``Counts`` and words' logs."""

    def scored(batches):
        import pyarrow as pa

        known, trie = frequent.value, shared.value.trie()

        def lists(offsets, fields):
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([*fields.values()], [*fields]))

        for batch in _slices(batches):
            texts = [text.as_py() or b"" for text in batch.column(3)]
            n_tokens, n_known, base, ends, rare, times = [], [], [], [0], [], []
            for text in texts:
                tokens = words(text)
                tokens.append(_END)
                found = list(map(known.get, tokens))
                others = Counter(token for token, log in zip(tokens, found) if log is None) if None in found else {}
                n_tokens.append(len(tokens))
                n_known.append(len(tokens) - sum(others.values()))
                base.append(sum(filter(None, found)))
                rare.extend(others.keys())
                times.extend(others.values())
                ends.append(len(rare))
            each, (text, gram, often) = trie.score(texts)
            pieces = lists(np.searchsorted(text, np.arange(len(texts) + 1)), {"gram": pa.array(gram), "times": pa.array(often, pa.int32())})
            others = lists(ends, {"word": pa.array(rare, pa.binary()), "times": pa.array(times, pa.int32())})
            yield [batch.column(0), batch.column(1), batch.column(2), n_tokens, n_known, base, each, pieces, others]

    return scored


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, a row for each row of ``docs``."""
    spark = docs.sparkSession
    counts = counted(docs)
    levels = levels_of(counts)
    values = values_of(levels)
    shared = spark.sparkContext.broadcast(train(levels, values))
    vocabulary = counts.where("word is not null").select("word", "n")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    floor = math.log10(total + ADDED * (distinct + 1))
    top = _frequent(vocabulary, FREQUENT).toArrow()
    logs = np.log10(top.column(1).to_numpy() + ADDED) - floor
    frequent = spark.sparkContext.broadcast(dict(zip(top.column(0).to_pylist(), logs.tolist())))

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), F.col("text").cast("binary").alias("text"))
    with _small_batches(spark):
        first = materialize(in_arrow(
            rows, _scorer(shared, frequent),
            "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
            "pieces array<struct<gram: long, times: int>>, rare array<struct<word: binary, times: int>>"), "scored")
    each = first.select("row", F.explode("rare").alias("of")).select("row", "of.word", "of.times")
    each = each.join(vocabulary, "word", "left")
    log = F.log10(F.coalesce("n", F.lit(0)) + ADDED) - floor
    each = each.select(
        "row", (F.col("times") * log).alias("more"), F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("known"),
        F.lit(0.0).alias("pieces"))

    # All pieces of training texts have a value; of held-out texts the others get theirs now.
    piece = first.select("row", "held_out", F.explode("pieces").alias("of")).select("row", "held_out", "of.gram", "of.times")
    novel = piece.where("held_out").select("gram").distinct().join(values, "gram", "left_anti")
    novel = materialize(novel_values(materialize(novel, "novel"), levels), "novel-values")
    piece = piece.join(values.select("gram", "value").unionByName(novel), "gram")
    piece = piece.select(
        "row", F.lit(0.0).alias("more"), F.lit(0).alias("known"), (F.col("times") * F.col("value")).alias("pieces"))

    others = each.unionByName(piece).groupBy("row").agg(
        F.sum("more").alias("more"), F.sum("known").alias("known"), F.sum("pieces").alias("of_pieces"))
    return first.drop("rare", "pieces").join(others, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("of_pieces", F.lit(0.0))).alias("score"))
