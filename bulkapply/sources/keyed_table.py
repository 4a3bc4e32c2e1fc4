"""A keyed Parquet table in buckets, of which a change reads and writes only those that hold a changed key.

    <path>/data/<write>/bucket=<b>     rows of a bucket, one per key
    <path>/versions/<n>                which writes hold each bucket; a version is there when this file is

A version is a small list, so a new one shares every untouched bucket's files with the one before. Rows are written first and the
version last: a writer that dies in between leaves files that no version names. Of two writers at once the second fails, as
its version exists. Readers stay on the version they opened. Inserted rows are a write of their own beside the bucket's others, so
an insert rewrites nothing; the next change of that bucket makes them one again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkapply.functions.names import column, columns, free
from bulkapply.functions.schema import validate_schema
from bulkapply.operators.changelog import (
    OP,
    UPSERT,
    ChangelogError,
    asked_keys,
    check_keys,
    collapse,
    conform,
    is_upsert,
    latest,
    merge,
    with_checked_keys,
    with_target_keys,
)
from bulkapply.storage import create_text, delete, materialize, names_in, read_text


class DuplicateKeyError(ValueError):
    """Rows whose key the table already holds, or that share a key."""


@dataclass(frozen=True)
class Version:
    """``folders`` names the writes that hold each bucket; buckets without rows are missing. ``batch`` is the last one applied."""

    number: int = -1
    buckets: int = 0
    folders: dict[int, tuple[str, ...]] = field(default_factory=dict)
    batch: int | None = None

    def text(self) -> str:
        return json.dumps({"buckets": self.buckets, "folders": self.folders, "batch": self.batch, "whole": True})

    @classmethod
    def parsed(cls, number: int, text: str) -> Version | None:
        """None for a file whose writer died."""
        try:
            held = json.loads(text)
        except ValueError:
            return None
        return cls(number, held["buckets"], {int(b): tuple(w) for b, w in held["folders"].items()}, held["batch"])


class KeyedTable:
    """``schema`` describes the rows, without a kind column. ``buckets`` counts for a new table only; its default is the session's
    number of shuffle partitions."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int | None = None
    ):
        validate_schema(schema)
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)
        self.new_buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._bucket = free("bucket", schema.names)
        check_keys(self._empty(), self.keys)

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _numbers(self) -> list[int]:
        return sorted(int(name) for name in names_in(self.spark, f"{self.path}/versions") if name.isdigit())

    def version(self, number: int | None = None) -> Version:
        """The newest version, or the one asked for; number -1 is the empty table before any."""
        if number is not None and number < 0:
            return Version(buckets=self.new_buckets)
        for n in reversed([n for n in self._numbers() if number in (None, n)]):
            found = Version.parsed(n, read_text(self.spark, f"{self.path}/versions/{n}"))
            if found is not None:
                return found
        if number is not None:
            raise ValueError(f"{self.path} has no version {number}")
        return Version(buckets=self.new_buckets)

    def _in_bucket(self, buckets: int) -> Column:
        return F.pmod(F.hash(*columns(self.keys)), F.lit(buckets))

    def read(self, version: Version | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets; other buckets' files are not opened."""
        version = version or self.version()
        wanted = version.folders if buckets is None else {b: version.folders[b] for b in buckets if b in version.folders}
        paths = [f"{self.path}/data/{write}/{self._bucket}={b}" for b, writes in wanted.items() for write in writes]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self._empty()

    def of_keys(self, keyed: DataFrame, version: Version | None = None) -> DataFrame:
        """The rows whose key occurs in ``keyed``, which is read twice; only these keys' buckets are opened."""
        version = version or self.version()
        asked = keyed.select(*asked_keys(keyed, self._empty(), self.keys)).distinct()
        found = asked.select(self._in_bucket(version.buckets).alias(self._bucket)).distinct().collect()
        held = self.read(version, [row[0] for row in found])
        return held.join(asked, self.keys, "left_semi").select(*columns(self.schema.names))

    def upsert(self, rows: DataFrame, sequence_by: Sequence[str], batch_id: int | None = None) -> Version:
        """Insert or replace by key; the last row per key wins."""
        kind = free(OP, rows.columns)
        return self.apply(rows.withColumn(kind, F.lit("+U")), sequence_by, kind, batch_id)

    def apply(
        self, changes: DataFrame, sequence_by: Sequence[str], op_col: str = OP, batch_id: int | None = None
    ) -> Version:
        """The version after a changelog. A batch that is not later than the last one applied changes nothing.

        The last change per key is written first. The driver sees the numbers of the buckets that it touches, then those
        buckets alone are read, merged and written.
        """
        before = self.version()
        if batch_id is not None and before.batch is not None and batch_id <= before.batch:
            return before
        if op_col in self.schema.names:
            raise ChangelogError(f"the kind column {op_col} has the name of a column of the table")
        last = collapse(with_target_keys(changes, self._empty(), self.keys), self.keys, sequence_by, op_col)
        flag = free(UPSERT, self.schema.names)
        last = conform(last, self._empty(), keep=[op_col]).withColumn(flag, is_upsert(column(op_col))).drop(op_col)
        last = materialize(last.withColumn(self._bucket, self._in_bucket(before.buckets)), "changes")
        touched = [row[0] for row in last.select(self._bucket).distinct().collect()]
        if not touched:
            return self._publish(before, {}, [], batch_id)
        rows = merge(self.read(before, touched), last.drop(self._bucket), self.keys, flag=flag)
        return self._publish(before, self._write(rows, before.buckets), touched, batch_id)

    def insert(self, rows: DataFrame, batch_id: int | None = None) -> Version:
        """Append rows of new keys. A key that the table holds, or that comes twice, fails and nothing of the rows is seen.

        The rows are written where no version names them, checked there against each other and against the keys of their
        buckets, and shown by the next version.
        """
        before = self.version()
        if batch_id is not None and before.batch is not None and batch_id <= before.batch:
            return before
        written = self._write(self._checked(rows), before.buckets)
        added = self.read(Version(0, before.buckets, written))
        twice = added.groupBy(*columns(self.keys)).count().where("count > 1").select(*columns(self.keys))
        held = self.read(before, list(written)).select(*columns(self.keys)).join(added, self.keys, "left_semi")
        clash = twice.unionAll(held).first()
        if clash is not None:
            for write in {w for writes in written.values() for w in writes}:
                delete(self.spark, f"{self.path}/data/{write}")
            raise DuplicateKeyError(f"key {clash.asDict()} is present or comes twice")
        return self._publish(before, self._beside(before, written), list(written), batch_id)

    def insert_absent(self, rows: DataFrame, sequence_by: Sequence[str] = (), batch_id: int | None = None) -> Version:
        """Append the rows whose key the table does not hold, the last one of each; the others change nothing."""
        before = self.version()
        if batch_id is not None and before.batch is not None and batch_id <= before.batch:
            return before
        last = materialize(latest(self._checked(rows), self.keys, sequence_by), "inserts")
        held = self.of_keys(last, before).select(*columns(self.keys))
        new = last.join(held, self.keys, "left_anti").select(*columns(self.schema.names))
        written = self._write(new, before.buckets)
        return self._publish(before, self._beside(before, written), list(written), batch_id)

    def _checked(self, rows: DataFrame) -> DataFrame:
        """Rows with the table's columns and types; a null key fails the job."""
        flag = free("_keyed", self.schema.names)
        typed = conform(with_target_keys(rows, self._empty(), self.keys), self._empty())
        return with_checked_keys(typed, self.keys, F.lit(True), flag).where(column(flag)).drop(flag)

    @staticmethod
    def _beside(before: Version, written: dict[int, tuple[str, ...]]) -> dict[int, tuple[str, ...]]:
        return {b: before.folders.get(b, ()) + writes for b, writes in written.items()}

    def _write(self, rows: DataFrame, buckets: int) -> dict[int, tuple[str, ...]]:
        """Write rows by bucket, in key order; a bucket too large for one task is split over several files."""
        write = uuid.uuid4().hex
        placed = rows.withColumn(self._bucket, self._in_bucket(buckets)).hint("rebalance", self._bucket)
        placed = placed.sortWithinPartitions(column(self._bucket), *columns(self.keys))
        folder = f"{self.path}/data/{write}"
        placed.write.partitionBy(self._bucket).parquet(folder)
        mark = f"{self._bucket}="
        return {int(n.removeprefix(mark)): (write,) for n in names_in(self.spark, folder) if n.startswith(mark)}

    def _publish(self, before: Version, written: dict[int, tuple[str, ...]], touched: Sequence[int], batch_id: int | None) -> Version:
        gone = set(touched)
        folders = {b: w for b, w in before.folders.items() if b not in gone} | written
        number = max([before.number, *self._numbers()]) + 1
        after = Version(number, before.buckets, folders, before.batch if batch_id is None else batch_id)
        if self.version().number != before.number:
            raise RuntimeError(f"{self.path} was changed by another writer")
        create_text(self.spark, f"{self.path}/versions/{number}", after.text())
        return after

    def differences(self, before: Version, after: Version) -> DataFrame:
        """``before, after``: a row per key that differs between two versions, null where the key is absent.

        Only buckets that the versions hold in different files are read.
        """
        if before.buckets != after.buckets:
            raise ValueError("the versions have different buckets")
        every = before.folders.keys() | after.folders.keys()
        moved = [b for b in every if before.folders.get(b) != after.folders.get(b)]
        key_names = [f"key_{i}" for i in range(len(self.keys))]

        def side(version: Version, name: str) -> DataFrame:
            row = F.struct(*columns(self.schema.names)).alias(name)
            return self.read(version, moved).select(*[column(k).alias(n) for k, n in zip(self.keys, key_names)], row)

        both = side(before, "before").join(side(after, "after"), key_names, "full")
        return both.where(~F.col("before").eqNullSafe(F.col("after"))).select("before", "after")

    def remove_unreferenced(self, keep: int = 1) -> int:
        """Delete versions but the newest ``keep``, and writes that these do not name; returns how many writes.

        Call it while nobody writes and no reader of an older version is running.
        """
        if keep < 1:
            raise ValueError("the newest version must be kept")
        numbers = self._numbers()
        kept = [self.version(n) for n in numbers[-keep:]]
        named = {write for version in kept for writes in version.folders.values() for write in writes}
        old = [write for write in names_in(self.spark, f"{self.path}/data") if write not in named]
        for n in numbers[:-keep]:
            delete(self.spark, f"{self.path}/versions/{n}")
        for write in old:
            delete(self.spark, f"{self.path}/data/{write}")
        return len(old)
