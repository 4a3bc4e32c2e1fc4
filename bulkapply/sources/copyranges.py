"""COPY files read by byte ranges, many tasks to a file, though texts hold newlines.

A line break ends a record only outside quotes, and whether a range starts inside them depends on all that stands before it. So the
ranges' quotes are counted first, a number for each range; running sums over a file's ranges say where each one starts. Then every range
is cut into records by itself. What a range holds of a record that began before it, or that goes on behind it, is sent on as a
piece; pieces of a record are put together by a shuffle of these alone, and records are decoded by Spark's CSV functions.

Ranges are those of Spark's text scan. Their starts are looked up, so a scan that cuts the file otherwise the second time ends with an
error and no wrong row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkapply.sources.copyfiles import CSV_OPTIONS, decoded, read_copy_files, text_fields
from bulkapply.storage import materialize

# Where the ranges start is broadcast, some 32 bytes each; files in more ranges are read a file to a task.
RANGES = 2_000_000


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines with the range they start in: the file, as a hash of its path, and the range's first byte."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def ranges(lines: DataFrame) -> DataFrame:
    """``file, start, inside, began, odd``: whether a range starts inside quotes, and where the record that it starts in began.

    ``odd`` is whether a file ends inside quotes, up to and with this range.
    """
    odd = (F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))) % 2
    counted = lines.groupBy("file", "start").agg(F.sum(odd).alias("n_odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    found = counted.withColumn("inside", F.coalesce(F.sum("n_odd").over(before), F.lit(0)) % 2)
    found = found.withColumn("odd", (F.col("inside") + F.col("n_odd")) % 2)
    # A record begins here and goes on: outside at the start, or the record of the start has ended.
    opens = (F.col("odd") == 1) & ((F.col("inside") == 0) | (F.col("n_odd") > 0))
    began = F.last(F.when(opens, F.col("start")), ignorenulls=True).over(before)
    return found.select("file", "start", "inside", F.coalesce(began, F.lit(-1)).alias("began"), "odd")


class RangeCutter:
    """Cuts the lines of one range after another into records; lines arrive in order, in Arrow arrays."""

    def __init__(self, known: dict):
        self.known, self.at = known, None
        self.pending: list[pa.Array] = []
        self.n_pending, self.parity, self.leading, self.began = 0, 0, False, -1

    def _joined(self, lines: pa.Array, ends: np.ndarray) -> pa.Array:
        """Records from the pending lines and these, each up to an end."""
        every = pa.concat_arrays([*self.pending, lines])
        cuts = np.r_[0, self.n_pending + ends + 1].astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), every), "\n")

    def enter(self, file: int, start: int) -> list[tuple]:
        """Begin a range; returns the piece that the one before leaves open."""
        left = self.leave()
        if (file, start) not in self.known:
            raise RuntimeError("the files were cut into other ranges than before; read them again")
        self.at = file, start
        self.parity, self.began = self.known[file, start]
        self.leading = self.parity == 1
        return left

    def leave(self) -> list[tuple]:
        if not self.n_pending:
            return []
        text = self._joined(self.pending[0].slice(0, 0), np.array([-1]))[0].as_py()
        began = self.began if self.leading else self.at[1]
        self.pending, self.n_pending = [], 0
        return [(self.at[0], began, self.at[1], text)]

    def add(self, lines: pa.Array) -> tuple[pa.Array, list[tuple]]:
        """The records that end in these lines, and the piece that ends a record of an earlier range."""
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        parity = (self.parity + np.cumsum(quotes)) % 2
        ends = np.flatnonzero(parity == 0)
        self.parity = int(parity[-1])
        if not len(ends):
            self.pending.append(lines)
            self.n_pending += len(lines)
            return lines.slice(0, 0), []
        records, pieces = self._joined(lines, ends), []
        rest = lines.slice(int(ends[-1]) + 1)
        self.pending, self.n_pending = ([rest] if len(rest) else []), len(rest)
        if self.leading:
            pieces.append((self.at[0], self.began, self.at[1], records[0].as_py()))
            records, self.leading = records.slice(1), False
        return records, pieces


def _cut(batches, known: dict, want_pieces: bool):
    cutter = RangeCutter(known)

    def told(pieces: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*pieces)) if pieces else [(), (), (), ()]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], ["file", "began", "start", "text"])

    for batch in batches:
        file, start = (batch.column(i).to_numpy() for i in (0, 1))
        edges = [0, *(1 + np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1]))).tolist(), len(file)]
        pieces: list[tuple] = []
        for x, y in zip(edges, edges[1:]):
            if x == y:
                continue
            if cutter.at != (file[x], start[x]):
                pieces += cutter.enter(int(file[x]), int(start[x]))
            records, closing = cutter.add(batch.column(2).slice(x, y - x))
            pieces += closing
            if not want_pieces:
                yield pa.RecordBatch.from_arrays([records], ["line"])
        if want_pieces:
            yield told(pieces)
    if want_pieces:
        yield told(cutter.leave())


def records(spark: SparkSession, path: str) -> DataFrame | None:
    """``line``: the encoded records of the files, newlines inside quotes included; None if there are too many ranges.

    The lines are read three times: for the quotes, for records within a range, and for the pieces of the others.
    """
    lines = _lines(spark, path)
    found = materialize(ranges(lines), "copy-ranges")
    if found.count() > RANGES:
        return None
    table = found.orderBy("file", "start").toArrow()
    file, start, inside, began, odd = (c.to_numpy() for c in table.columns)
    if len(file) and odd[np.r_[file[1:] != file[:-1], True]].any():
        raise ValueError(f"a file in {path} ends inside quotes")
    known = spark.sparkContext.broadcast(
        {(f, s): (i, b) for f, s, i, b in zip(*(c.tolist() for c in (file, start, inside, began)))})
    whole = lines.mapInArrow(lambda batches: _cut(batches, known.value, False), "line string")
    pieces = lines.mapInArrow(lambda batches: _cut(batches, known.value, True), "file long, began long, start long, text string")
    ordered = F.sort_array(F.collect_list(F.struct("start", "text")))
    put_together = pieces.groupBy("file", "began").agg(ordered.alias("parts")).select(
        F.array_join(F.transform("parts", lambda part: part["text"]), "\n").alias("line"))
    return whole.unionAll(put_together)


def read_copy_ranges(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``read_copy_files`` with as many tasks as the files have ranges."""
    if len(schema.fields) == 1:
        return read_copy_files(spark, path, schema)
    lines = records(spark, path)
    if lines is None:
        return read_copy_files(spark, path, schema)
    # Fields by place, so that names need no quoting in a declaration.
    texts = (T.CharType, T.VarcharType)
    kinds = ["string" if isinstance(f.dataType, texts) else f.dataType.simpleString() for f in text_fields(schema)]
    types = ", ".join(f"f{i} {kind}" for i, kind in enumerate(kinds))
    options = {name: str(value).lower() if isinstance(value, bool) else value for name, value in CSV_OPTIONS.items()}
    row = F.from_csv("line", types, options).alias("row")
    rows = lines.where(F.col("line") != "").select(row)
    fields = [(F.col(f"row.f{i}"), f) for i, f in enumerate(schema.fields)]
    return rows.select(*[
        (decoded(value, f.dataType) if isinstance(f.dataType, T.BinaryType) else value).alias(f.name) for value, f in fields
    ])
