"""A keyed Parquet target for streams: small change files now, a rewritten base later.

Rewriting a large table for each micro-batch would cost the whole table every few seconds. Here a batch writes only its
own collapsed changes, in a folder named by its batch id, and a repeated batch overwrites that folder. Reading merges
base and later batches; ``compact`` writes the merged rows as a new base.

With ``Tiers`` batches are first merged among themselves: ``fan_out`` neighbours of one size become one run of the next, so a
row is rewritten once per size, and readers merge few runs. The base is rewritten only when the runs have grown to a share of
it. It is bucketed by key: a merge with it shuffles the runs, not the base, whether for a reader or for the next base.

    <path>/checkpoint              offsets of the stream that feeds this table
    <path>/log/batch_id=<n>        changes of one micro-batch, last per key
    <path>/tiers/batches=<a>-<b>   changes of the batches a to b, last per key
    <path>/base/through=<n>        all changes up to batch n, last per key
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bulkapply.functions.names import column, columns, free, free_each
from bulkapply.functions.schema import validate_schema
from bulkapply.operators.changelog import OP, check_keys, collapse, is_upsert
from bulkapply.options import SinkOptions
from bulkapply.sources.tables import open_bucketed, write_bucketed
from bulkapply.storage import committed, committed_names, delete, exists, mark_committed, mark_of, size_of
from bulkapply.streaming.sink import apply_stream

BATCH = "batch_id"
_LOG, _TIER, _BASE = "batch_id=", "batches=", "through="


@dataclass(frozen=True)
class Tiers:
    """How batches are merged: ``fan_out`` runs of a size into one, and a new base when the runs have ``share`` of its bytes."""

    fan_out: int = 8
    share: float = 0.25

    def __post_init__(self) -> None:
        if self.fan_out < 2 or self.share <= 0:
            raise ValueError("tiers need a fan-out of at least two and a positive share")

    def level(self, n_batches: int) -> int:
        level = 0
        while n_batches >= self.fan_out:
            n_batches, level = n_batches // self.fan_out, level + 1
        return level


@dataclass(frozen=True)
class Run:
    """The collapsed changes of the batches ``first`` to ``last``."""

    first: int
    last: int
    path: str


class ChangelogTable:
    """``schema`` describes the change rows, kind column included.

    With ``arrival_order`` a later batch wins over an earlier one, and ``sequence_by`` orders changes inside a batch.
    Without it ``sequence_by`` alone decides, and late changes lose against newer ones already there.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        sequence_by: Sequence[str],
        arrival_order: bool = True,
        op_col: str = OP,
        buckets: int | None = None,
    ):
        validate_schema(schema)
        if op_col not in schema.names:
            raise ValueError(f"the change rows need the kind column {op_col}")
        if not arrival_order and not sequence_by:
            raise ValueError("without arrival order the changes need sequence columns")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.sequence_by = list(keys), list(sequence_by)
        self.arrival_order, self.op_col = arrival_order, op_col
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._order = [free(BATCH, schema.names), *self.sequence_by] if arrival_order else self.sequence_by

    def write_batch(self, changes: DataFrame, batch_id: int) -> None:
        """Replace this batch's folder with its last change per key."""
        check_keys(changes, self.keys)
        rows = collapse(changes.select(*columns(self.schema.names)), self.keys, self.sequence_by, self.op_col)
        self._write(rows, f"{self.path}/log/{_LOG}{batch_id}")

    def _write(self, rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").parquet(path)
        mark_committed(self.spark, path)

    def feed(
        self,
        stream: DataFrame,
        options: SinkOptions = SinkOptions(),
        output_mode: str = "append",
        available_now: bool = False,
        compact_every: int | None = None,
        keep_bases: int | None = None,
        tiers: Tiers | None = None,
    ) -> StreamingQuery:
        """Start the stream. Its checkpoint lies inside the table, because batch ids mean nothing without it.

        With ``compact_every`` the stream compacts after that many batches, which bounds what a reader merges; with ``keep_bases``
        it then deletes what the newest so many bases replace, which bounds the folders. Readers have that many compactions' time.
        With ``tiers`` each batch is followed by the merges that are due instead.
        """
        if compact_every is not None and compact_every <= 0:
            raise ValueError("compact_every must be positive")
        if compact_every is not None and tiers is not None:
            raise ValueError("either compact_every or tiers decides when the table is compacted")
        checkpoint = f"{self.path}/checkpoint"
        if self._written() and not exists(self.spark, checkpoint):
            raise ValueError(f"{self.path} holds batches but not the checkpoint they were numbered by")

        def flush(rows: DataFrame, batch_id: int) -> None:
            self.write_batch(rows, batch_id)
            due = compact_every is not None and (batch_id + 1) % compact_every == 0
            if due:
                self.compact()
            if tiers is not None:
                due = self.merge_tiers(tiers)
            if due and keep_bases is not None:
                self.remove_replaced(keep_bases)

        return apply_stream(stream, flush, checkpoint, options, output_mode, available_now)

    def _written(self) -> bool:
        return bool(
            committed(self.spark, f"{self.path}/log", _LOG) or committed(self.spark, f"{self.path}/base", _BASE)
        )

    def _base(self) -> tuple[int, int, DataFrame]:
        """The base, the last batch in it, and in how many buckets it lies."""
        bases = committed(self.spark, f"{self.path}/base", _BASE)
        if not bases:
            return -1, self.buckets, self.spark.createDataFrame([], self.schema)
        through = max(bases)
        layout = mark_of(self.spark, bases[through])
        if not layout:
            return through, self.buckets, self.spark.read.schema(self.schema).parquet(bases[through])
        held = json.loads(layout)
        base = open_bucketed(self.spark, held["table"], bases[through], self.schema, self.keys, held["buckets"])
        return through, held["buckets"], base.select(*columns(self.schema.names))

    def runs(self) -> list[Run]:
        """The runs that a reader merges with the base, in order of their batches: batches, or the widest run that holds them."""
        through = max(committed(self.spark, f"{self.path}/base", _BASE), default=-1)
        found = [Run(n, n, path) for n, path in committed(self.spark, f"{self.path}/log", _LOG).items()]
        for name, path in committed_names(self.spark, f"{self.path}/tiers", _TIER).items():
            first, last = map(int, name.split("-"))
            found.append(Run(first, last, path))
        live: list[Run] = []
        # Runs either hold one another or lie apart, so of each start the widest comes first.
        for run in sorted((r for r in found if r.last > through), key=lambda r: (r.first, -r.last)):
            if not live or run.first > live[-1].last:
                live.append(run)
        return live

    def _rows(self, runs: Sequence[Run]) -> DataFrame:
        """The rows of some runs, each with the number of its run's last batch, by which later runs win."""
        batch = free(BATCH, self.schema.names)
        reader = self.spark.read.schema(self.schema)
        return reduce(
            DataFrame.unionAll,
            [reader.parquet(run.path).withColumn(batch, F.lit(run.last).cast("long")) for run in runs],
        )

    def _last(self, rows: DataFrame) -> DataFrame:
        """Last change per key, removals included."""
        return collapse(rows, self.keys, self._order, self.op_col).select(*columns(self.schema.names))

    def _merged(self) -> tuple[int, DataFrame]:
        """Last change per key over base and runs, removals included.

        Without runs the base is the answer. With arrival order base rows whose key did not change pass by; without it the later
        of the two rows of a key is taken. Either way the runs are dealt out as the base is bucketed, so the base is read in
        place.
        """
        through, buckets, base = self._base()
        runs = self.runs()
        if not runs:
            return through, base
        rows = self._rows(runs)
        last = self._last(rows)
        if through < 0:
            return runs[-1].last, last
        if self.arrival_order:
            changed = rows.select(*columns(self.keys)).repartition(buckets, *columns(self.keys))
            kept = base.join(changed, self.keys, "left_anti").select(*columns(self.schema.names))
            return runs[-1].last, kept.unionByName(last)
        return runs[-1].last, self._later(base, last, buckets)

    def _later(self, base: DataFrame, last: DataFrame, buckets: int) -> DataFrame:
        """Of the two rows of a key the later one: by sequence, a write before a removal, then by the remaining columns."""
        rest = [c for c in self.schema.names if c not in self.keys]
        ties = [c for c in rest if c not in self.sequence_by]
        given = free_each("_new_", rest, self.schema.names)
        new = last.select(*columns(self.keys), *[column(c).alias(n) for c, n in given.items()])
        both = base.join(new.repartition(buckets, *columns(self.keys)), self.keys, "full")

        def rank(of: dict[str, str]) -> Column:
            order = [column(of[c]) for c in self.sequence_by if c in of]
            kind = F.when(column(of[self.op_col]).isNotNull(), is_upsert(column(of[self.op_col])))
            return F.struct(*order, kind, *[column(of[c]) for c in ties])

        held, came = column(self.op_col).isNotNull(), column(given[self.op_col]).isNotNull()
        newer = came & (~held | (rank(given) > rank({c: c for c in rest})))
        return both.select(*[
            column(c) if c in self.keys else F.when(newer, column(given[c])).otherwise(column(c)).alias(c)
            for c in self.schema.names
        ])

    def state(self) -> DataFrame:
        """The table's current rows."""
        _, merged = self._merged()
        return merged.filter(is_upsert(column(self.op_col))).drop(self.op_col)

    def merge_tiers(self, tiers: Tiers = Tiers()) -> bool:
        """Merge runs of one size while there are ``fan_out`` of them; returns whether a new base was written.

        A merged run is seen when its write finished, and hides the runs that it holds.
        """
        merged = False
        while True:
            runs = self.runs()
            newest = runs[-tiers.fan_out:]
            if len(newest) < tiers.fan_out or len({tiers.level(r.last - r.first + 1) for r in newest}) > 1:
                break
            self._write(self._last(self._rows(newest)), f"{self.path}/tiers/{_TIER}{newest[0].first}-{newest[-1].last}")
            merged = True
        if not merged:
            return False
        bases = committed(self.spark, f"{self.path}/base", _BASE)
        held = size_of(self.spark, bases[max(bases)]) if bases else 0
        if sum(size_of(self.spark, run.path) for run in runs) < tiers.share * held:
            return False
        self.compact()
        return True

    def compact(self) -> int:
        """Write base and log as one new base and return the last batch in it.

        Readers take the newest base whose write finished, so the change is seen at once or not at all.
        """
        through, merged = self._merged()
        if through >= 0 and through not in committed(self.spark, f"{self.path}/base", _BASE):
            kept = merged.filter(is_upsert(column(self.op_col))) if self.arrival_order else merged
            table, path = f"base_{uuid.uuid4().hex}", f"{self.path}/base/{_BASE}{through}"
            write_bucketed(kept, table, path, self.keys, self.buckets)
            mark_committed(self.spark, path, json.dumps({"table": table, "buckets": self.buckets}))
        return through

    def remove_replaced(self, keep: int = 1) -> int:
        """Delete bases, runs and batches that the newest ``keep`` bases replace; returns how many folders.

        Call it when no reader started before the oldest of these compactions is still running. The newest batch is kept,
        because a restarted stream may repeat it.
        """
        if keep < 1:
            raise ValueError("the newest base must be kept")
        bases = committed(self.spark, f"{self.path}/base", _BASE)
        if not bases:
            return 0
        newest = sorted(bases)[-keep:][0]
        log = committed(self.spark, f"{self.path}/log", _LOG)
        tiers = committed_names(self.spark, f"{self.path}/tiers", _TIER)
        replaced = [p for n, p in bases.items() if n < newest]
        for layout in filter(None, (mark_of(self.spark, p) for p in replaced)):
            self.spark.sql(f"DROP TABLE IF EXISTS {json.loads(layout)['table']}")
        old = replaced + [p for n, p in log.items() if n < newest]
        old += [p for name, p in tiers.items() if int(name.split("-")[1]) <= newest]
        for path in old:
            delete(self.spark, path)
        return len(old)
