"""Vector codes by product quantisation, each part's nearest codebook entry found by Orchard's search.

A vector becomes integers, floor(``SCALE`` * x), and is cut into ``PARTS`` equal parts. Every part position has a codebook, which
starts as that part of the vectors of the smallest ids and is moved ``ROUNDS`` times to the floored mean of the parts nearest to
each entry. A round is one pass: a task sums the parts of its own rows, Spark adds the sums up, and the driver gets a row
for each entry and component (``ENTRIES`` times the dimension, whatever the number of vectors). Codebooks are that small too.

Nearest entries come from Orchard's search: each entry has the list of all entries sorted by distance from it. From
a current entry its list is walked; a nearer entry becomes the current one and its list is walked from the start. Entries measured
are marked and not measured again, and the walk ends where the list is beyond twice the distance of the current entry, as by the
triangle inequality nothing nearer can follow. Distances are exact integers, so ties go to the lower index. All rows of a batch
walk at once, one step of each at a time.

Defined cases: rows whose vector is null or holds null, NaN or an infinity are dropped. A vector whose length differs from
that of the smallest kept id (the first that has ``PARTS`` equal parts) gets null code and error. A null id never starts a
codebook; equal ids are ordered by their vectors. With fewer than ``ENTRIES`` vectors the codebooks are as short. Entries that
nothing is nearest to stay. Repeated rows each count. Components too large for 64-bit distances end the job with an error. An
empty table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bulkapply.llm.common import in_arrow, join_counted
from bulkapply.storage import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096


class Orchard:
    """The entries of one codebook, an integer matrix, with the neighbour list of each."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = ((entries[:, None] - entries[None]) ** 2).sum(axis=2)
        self.lists = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.lists, axis=1)
        # The entry nearest to the others on the whole is where every search begins.
        self.first = int(apart.sum(axis=1, dtype=np.float64).argmin())

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point, of equally near ones the lowest, and its squared distance."""
        n, size = len(points), len(self.entries)
        at = np.full(n, self.first)
        best = ((points - self.entries[self.first]) ** 2).sum(axis=1)
        measured = np.zeros((n, size), bool)
        measured[:, self.first] = True
        step = np.zeros(n, np.int64)
        walking = np.arange(n)
        while len(walking):
            now, place = at[walking], step[walking]
            # Distances are squares: beyond twice the distance is beyond four times the square.
            going = place < size
            going &= self.apart[now, np.minimum(place, size - 1)] <= 4 * best[walking]
            walking, now, place = walking[going], now[going], place[going]
            other = self.lists[now, place]
            step[walking] = place + 1
            new = ~measured[walking, other]
            rows, other = walking[new], other[new]
            measured[rows, other] = True
            distance = ((points[rows] - self.entries[other]) ** 2).sum(axis=1)
            nearer = (distance < best[rows]) | (distance == best[rows]) & (other < at[rows])
            rows = rows[nearer]
            at[rows], best[rows], step[rows] = other[nearer], distance[nearer], 0
        return at, best


def _integers(values: np.ndarray, width: int) -> np.ndarray:
    """Components of vectors of length ``width`` as an integer matrix."""
    whole = np.floor(SCALE * values).reshape(-1, width)
    if whole.size and 16.0 * whole.shape[1] * np.abs(whole).max() ** 2 > 2.0**62:
        raise ValueError("a component of a vector is too large for 64-bit squared distances")
    return whole.astype(np.int64)


def _matrices(batches, width: int) -> Iterator[tuple]:
    """Each batch with the mask of its vectors of length ``width`` and these as an integer matrix."""
    for batch in batches:
        vectors = batch.column(1)
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        fits = lengths == width
        values = vectors.flatten().to_numpy(zero_copy_only=False)
        yield batch, fits, _integers(values[np.repeat(fits, lengths)], width)


def _parts(matrix: np.ndarray, parts: int) -> Iterator[np.ndarray]:
    return iter(np.split(matrix, parts, axis=1))


def kept_vectors(vectors: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, vector, label_key`` of the rows whose vector is whole and finite."""
    given = F.col(vector).cast("array<double>")
    broken = F.exists(given, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    label_key = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit(""))
    rows = vectors.where(given.isNotNull() & ~broken)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), given.alias("vector"), label_key.alias("label_key"))


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """The parts of the vectors of the smallest ids, as (part, entry, component); None without any vector that can be cut."""
    size = F.size("vector")
    ordered = rows.where(F.col("vec_id").isNotNull() & (size > 0) & (size % parts == 0)).orderBy("vec_id", "vector")
    first = ordered.select(size.alias("width")).first()
    if first is None:
        return None
    seeds = ordered.where(size == first.width).limit(entries).select("vector").collect()
    whole = _integers(np.array([row.vector for row in seeds], np.float64), first.width)
    return np.stack(list(_parts(whole, parts)))


def moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: entries at the floored means of the parts nearest to them."""
    parts, entries, each = books.shape

    def sums(batches):
        searches = [Orchard(book) for book in books]
        total = np.zeros((parts, entries, each), np.int64)
        times = np.zeros((parts, entries), np.int64)
        for _, _, matrix in _matrices(batches, parts * each):
            for p, points in enumerate(_parts(matrix, parts)):
                nearest, _ = searches[p].nearest(points)
                times[p] += np.bincount(nearest, minlength=entries)
                order = np.argsort(nearest, kind="stable")
                found, begin = np.unique(nearest[order], return_index=True)
                if len(found):
                    total[p, found] += np.add.reduceat(points[order], begin, axis=0)
        part, entry, place = np.nonzero(np.repeat(times[:, :, None], each, axis=2))
        yield [part.astype(np.int32), entry.astype(np.int32), place.astype(np.int32), times[part, entry], total[part, entry, place]]

    of_tasks = in_arrow(rows.select("vec_id", "vector"), sums, "part int, entry int, place int, times long, total long")
    found = of_tasks.groupBy("part", "entry", "place").agg(F.sum("times").alias("times"), F.sum("total").alias("total"))
    after = books.copy()
    for row in found.collect():
        after[row.part, row.entry, row.place] = row.total // row.times
    return after


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks of ``kept_vectors``, as (part, entry, component)."""
    books = first_codebooks(rows, parts, entries)
    for _ in range(rounds if books is not None else 0):
        books = moved(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray | None) -> DataFrame:
    """``vec_id, code, error, label_key`` of ``kept_vectors``: two hex digits for each part, and the sum of squared distances."""
    if books is None:
        return rows.select("vec_id", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"), "label_key")
    parts, _, each = books.shape

    def codes(batches):
        searches = [Orchard(book) for book in books]
        for batch, fits, matrix in _matrices(batches, parts * each):
            found = [search.nearest(points) for search, points in zip(searches, _parts(matrix, parts))]
            digits = np.stack([at for at, _ in found], axis=1).astype(np.uint8).tobytes().hex()
            code, error = np.full(len(fits), None, object), np.full(len(fits), None, object)
            code[fits] = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
            error[fits] = sum(distance for _, distance in found)
            yield [batch.column(0), code.tolist(), error.tolist(), batch.column(2)]

    return in_arrow(rows, codes, "vec_id long, code string, error long, label_key string")


def digest(books: np.ndarray | None) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and place."""
    numbers = [] if books is None else books.reshape(-1).tolist()
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def compress(vectors: DataFrame, vector: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray | None]:
    """``vec_id, code, error, label_error`` of every kept vector, and the codebooks.

    ``label_error`` is the error summed over the rows of a label. The label of a third of all rows is added up in each task first
    and joined by a broadcast of the few hot labels.
    """
    rows = kept_vectors(vectors, vector, label)
    books = fit(rows)
    encoded = materialize(encode(rows, books), "codes")
    of_label = encoded.groupBy("label_key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n_rows"))
    joined = join_counted(encoded, materialize(of_label, "label-errors"), "label_key", "n_rows")
    return joined.select("vec_id", "code", "error", "label_error"), books
