"""Lines that many documents share: two Bloom filters find suspected repeats, and only these are shuffled and confirmed.

A line's key is the line without blanks at its ends, A-Z lower-cased. Keys of at least ``LENGTH`` code points found in at least
``DOCUMENTS`` documents lose all their lines except in the largest doc_id that holds them.

Two Bloom filters hold keys seen once and keys seen twice. A filter is cut into segments of words of 64 bits, and a
key's bits lie in one word. A task sends, for its own rows, the words that it touched: once-seen bits, and twice-seen bits of
keys that two of its documents have. Segments are then merged by streaming: what two tasks have both seen is seen twice. So a key of
two documents has all its bits in the second filter, and a key of one document has them there only by chance (some 4 % at
``BITS_PER_KEY``). The second filter alone is broadcast. It has ``FILTER_BYTES`` at most; with more keys than fit it lets more
pass, and the result stays the same.

Keys that pass are shuffled as SHA-256 with their document, and confirmed by counting distinct documents. A key that a third of all
documents hold is counted in two steps and joined by a broadcast of the few hot keys. What a document drops comes back to
it as the numbers of its keys, and its text is cut where it stands.

Defined cases: a null or empty text is one empty line. Rows of one doc_id are one document, whatever their texts. A row without
doc_id takes no part: its lines count for nobody and all stay. Lines are cut at line feeds only, so a carriage return belongs to the
line's blanks. Very long texts and lines are read whole. Only doc_id and text are read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bulkapply.llm.common import in_arrow, join_counted
from bulkapply.storage import materialize

LENGTH, DOCUMENTS = 20, 3
BITS_PER_KEY = 12
FILTER_BYTES = 1 << 26
SEGMENT_WORDS = 1024
_HELD = 2_000_000


def lines_of(text: bytes | None) -> list[bytes]:
    return (text or b"").split(b"\n")


def keys_of(text: bytes | None, length: int = LENGTH) -> dict[bytes, int]:
    """The distinct keys of a text that are long enough, numbered in order."""
    found: dict[bytes, int] = {}
    for line in lines_of((text or b"").lower()):
        # strip() takes off exactly space, tab, line feed, vertical tab, form feed and carriage return.
        key = line.strip()
        if len(key) >= length and key not in found and (len(key) >= 4 * length or key.isascii() or len(key.decode(errors="replace")) >= length):
            found[key] = len(found)
    return found


def _masks(hashes: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` bits of a word for each key; two may coincide."""
    masks = np.zeros(len(hashes), np.uint64)
    for i in range(bits):
        masks |= np.uint64(1) << (hashes >> np.uint64(24 + 6 * i) & np.uint64(63))
    return masks


def _touched(hashes: np.ndarray, n_words: int, bits: int) -> list[list]:
    """``segment, places, once, twice``: the words that a task's keys touch, a row for each segment."""
    unique, times = np.unique(hashes, return_counts=True)
    words = (unique & np.uint64(n_words - 1)).astype(np.int64)
    order = np.argsort(words, kind="stable")
    words, masks = words[order], _masks(unique[order], bits)
    again = np.where(times[order] > 1, masks, np.uint64(0))
    begin = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
    words, once, twice = words[begin], np.bitwise_or.reduceat(masks, begin), np.bitwise_or.reduceat(again, begin)
    segments, places = words // SEGMENT_WORDS, (words % SEGMENT_WORDS).astype(np.uint16)
    cuts = np.flatnonzero(np.r_[True, segments[1:] != segments[:-1]]).tolist()
    spans = list(zip(cuts, [*cuts[1:], len(words)]))
    return [segments[cuts].astype(np.int32), [places[a:b].tobytes() for a, b in spans],
            [once[a:b].tobytes() for a, b in spans], [twice[a:b].tobytes() for a, b in spans]]


def _merged(touched: DataFrame) -> DataFrame:
    """``segment, twice``: each segment's bits that were seen twice; a segment's rows stream through one at a time."""

    def merge(batches):
        last, once, twice = None, None, None
        for batch in batches:
            out: list[list] = [[], []]
            for segment, places, seen, again in zip(*(c.to_pylist() for c in batch.columns)):
                if segment != last:
                    if last is not None:
                        out[0].append(last)
                        out[1].append(twice.tobytes())
                    last, once, twice = segment, np.zeros(SEGMENT_WORDS, np.uint64), np.zeros(SEGMENT_WORDS, np.uint64)
                at, seen = np.frombuffer(places, np.uint16), np.frombuffer(seen, np.uint64)
                before = once[at]
                twice[at] |= before & seen | np.frombuffer(again, np.uint64)
                once[at] = before | seen
            yield out
        if last is not None:
            yield [[last], [twice.tobytes()]]

    dealt = touched.repartition("segment").sortWithinPartitions("segment")
    return in_arrow(dealt, merge, "segment int, twice binary")


def _hashes(keys) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)


def seen_twice(docs: DataFrame, length: int = LENGTH) -> tuple[np.ndarray, int]:
    """The words of the second filter and the bits that a key has in it."""
    text = F.col("text")
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    most = docs.agg(F.sum(F.least(n_lines, F.length(text) / F.lit(length) + 1))).first()[0] or 1
    # Words are counted in powers of two, so that a key's word is the low bits of its hash.
    n_words = min(FILTER_BYTES // 8, max(SEGMENT_WORDS, 1 << int(BITS_PER_KEY * most / 64).bit_length()))
    bits = int(min(5, max(1, round(0.69 * 64 * n_words / most))))

    def touch(batches):
        held, n = [], 0
        for batch in batches:
            for each in batch.column(1):
                held.append(_hashes(keys_of(each.as_py(), length)))
                n += len(held[-1])
                if n >= _HELD:
                    yield _touched(np.concatenate(held), n_words, bits)
                    held, n = [], 0
        if n:
            yield _touched(np.concatenate(held), n_words, bits)

    touched = in_arrow(_texts(docs), touch, "segment int, places binary, once binary, twice binary")
    found = np.zeros((n_words // SEGMENT_WORDS, SEGMENT_WORDS), np.uint64)
    # At most FILTER_BYTES in all.
    for row in materialize(_merged(touched), "seen-twice").toLocalIterator():
        found[row.segment] = np.frombuffer(row.twice, np.uint64)
    return found.reshape(-1), bits


def _texts(docs: DataFrame) -> DataFrame:
    """``doc_id``, the bytes of ``text``, ``text_hash`` of the rows that have an id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                       F.xxhash64("text").alias("text_hash"))
    return rows.where("doc_id is not null")


def suspects(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``key, doc_id, text_hash, number``: the keys that the second filter has; ``number`` counts a text's own keys."""
    words, bits = seen_twice(docs, length)
    known = docs.sparkSession.sparkContext.broadcast(words.tobytes())

    def test(batches):
        twice = np.frombuffer(known.value, np.uint64)
        for batch in batches:
            found = [keys_of(each.as_py(), length) for each in batch.column(1)]
            keys = [key for each in found for key in each]
            hashes = _hashes(keys)
            masks = _masks(hashes, bits)
            passed = np.flatnonzero(twice[(hashes & np.uint64(len(twice) - 1)).astype(np.int64)] & masks == masks)
            sizes = np.array([*map(len, found)], np.int64)
            row = np.repeat(np.arange(len(found)), sizes)[passed]
            number = passed - np.repeat(np.cumsum(sizes) - sizes, sizes)[passed]
            yield [[hashlib.sha256(keys[i]).digest() for i in passed.tolist()], batch.column(0).take(_index(row)),
                   batch.column(2).take(_index(row)), number.astype(np.int32)]

    return in_arrow(_texts(docs), test, "key binary, doc_id long, text_hash long, number int")


def _index(rows: np.ndarray):
    import pyarrow as pa

    return pa.array(rows, pa.int64())


def repeated(found: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """``key, keeper, n_rows`` of the suspects that so many documents hold: the largest id keeps its lines."""
    counted = found.groupBy("key").agg(
        F.count_distinct("doc_id").alias("n_documents"), F.max("doc_id").alias("keeper"), F.count(F.lit(1)).alias("n_rows"))
    return counted.where(F.col("n_documents") >= documents).select("key", "keeper", "n_rows")


def dedup(docs: DataFrame, length: int = LENGTH, documents: int = DOCUMENTS) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` of every row: the lines that stay, and how many there were and went."""
    found = materialize(suspects(docs, length), "suspects")
    many = materialize(repeated(found, documents), "repeated")
    dropped = join_counted(found, many, "key", "n_rows", "inner").where(F.col("doc_id") != F.col("keeper"))
    dropped = materialize(dropped.groupBy("doc_id", "text_hash").agg(F.collect_set("number").alias("numbers")), "dropped")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                       F.xxhash64("text").alias("text_hash"))
    rows = rows.join(dropped, ["doc_id", "text_hash"], "left").select("doc_id", "text", "numbers")

    def cut(batches):
        for batch in batches:
            out: list[list] = [[], [], []]
            for text, numbers in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                lines = lines_of(text)
                stay = lines
                if numbers:
                    gone = set(numbers)
                    gone = {key for key, number in keys_of(text, length).items() if number in gone}
                    stay = [line for line in lines if line.lower().strip() not in gone]
                out[0].append(b"\n".join(stay).decode(errors="replace"))
                out[1].append(len(lines))
                out[2].append(len(lines) - len(stay))
            yield [batch.column(0), *out]

    return in_arrow(rows, cut, "doc_id long, text string, n_lines long, n_dropped long")
