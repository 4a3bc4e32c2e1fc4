"""Aggregates of a keyed table, kept up to date from what changes in it, removals included.

A change takes the row before it out of its group and puts the row after it in: counts and sums move by signed differences. A
minimum or maximum can only be lost by a removal; groups that lose one and get none at least as extreme are computed
anew from the table, and no others. The aggregate is a keyed table of its own and remembers the table version that it shows, so a
refresh that died is simply done again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkapply.functions.names import column, columns
from bulkapply.operators.changelog import OP
from bulkapply.sources.keyed_table import KeyedTable, Version
from bulkapply.storage import materialize

GROUP, ROWS = "group_key", "n_rows"
_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)


class KeptAggregate:
    """``n_rows`` of each group, and sums, least and greatest values of columns, as ``sum_x``, ``min_x`` and ``max_x``.

    Null values are left out as SQL does, and null is a group of its own. Sums need whole numbers or decimals: sums of
    floating-point numbers cannot be moved by differences without drifting.
    """

    def __init__(
        self, table: KeyedTable, path: str, group_by: Sequence[str],
        sums: Sequence[str] = (), mins: Sequence[str] = (), maxs: Sequence[str] = (), buckets: int | None = None,
    ):
        self.table, self.group_by = table, list(group_by)
        self.sums, self.mins, self.maxs = list(sums), list(mins), list(maxs)
        for c in self.sums:
            if not isinstance(table.schema[c].dataType, _EXACT):
                raise ValueError(f"the sum of {c} cannot be kept: it is {table.schema[c].dataType.simpleString()}, cast it to a decimal")
        self.outputs = [ROWS, *(f"sum_{c}" for c in self.sums), *(f"min_{c}" for c in self.mins), *(f"max_{c}" for c in self.maxs)]
        if set(self.outputs) & set(self.group_by):
            raise ValueError(f"group columns may not be named like aggregates: {self.outputs}")
        shape = self._aggregated(table._empty()).schema
        self.kept = KeyedTable(table.spark, path, shape, [GROUP], buckets)

    def _with_group(self, rows: DataFrame) -> DataFrame:
        """The group as a text, so that null is a group like others."""
        return rows.withColumn(GROUP, F.to_json(F.struct(*columns(self.group_by)), {"ignoreNullFields": "false"}))

    def _aggregated(self, rows: DataFrame) -> DataFrame:
        """Groups from scratch. ``set_x`` counts the values of a sum, which is null without any."""
        return self._with_group(rows).groupBy(GROUP).agg(
            *[F.first(column(c)).alias(c) for c in self.group_by],
            F.count(F.lit(1)).alias(ROWS),
            *[F.sum(column(c)).alias(f"sum_{c}") for c in self.sums],
            *[F.count(column(c)).alias(f"set_{c}") for c in self.sums],
            *self._extremes(lambda x: x),
        )

    def _extremes(self, of: Callable[[Column], Column]) -> list[Column]:
        return [*[F.min(of(column(c))).alias(f"min_{c}") for c in self.mins],
                *[F.max(of(column(c))).alias(f"max_{c}") for c in self.maxs]]

    def read(self) -> DataFrame:
        """The groups as of the last refresh."""
        return self.kept.read().select(*columns(self.group_by), *columns(self.outputs))

    def refresh(self) -> int:
        """Bring the aggregate to the table's newest version; returns its number."""
        shown, now = self.kept.version().batch, self.table.version()
        before = self.table.version(-1 if shown is None else shown)
        if before.number == now.number or now.number < 0:
            return now.number
        if before.number < 0:
            self.kept.upsert(self._aggregated(self.table.read(now)), [], now.number)
            return now.number
        moved = materialize(self._moved(before, now), "moved-groups")
        self.kept.apply(self._with_extremes(moved, now), [], OP, now.number)
        return now.number

    def _moved(self, before: Version, now: Version) -> DataFrame:
        """Each group that a change touches: its held values, the differences, and whether an extreme is lost."""
        changed = self.table.differences(before, now)
        sides = F.array(F.struct(F.lit(-1).alias("sign"), F.col("before").alias("row")),
                        F.struct(F.lit(1).alias("sign"), F.col("after").alias("row")))
        rows = changed.select(F.explode(sides).alias("side")).where("side.row is not null")
        rows = self._with_group(rows.select(F.col("side.sign").alias("_sign"), "side.row.*"))
        sign, added, gone = F.col("_sign"), F.col("_sign") > 0, F.col("_sign") < 0
        delta = rows.groupBy(GROUP).agg(
            *[F.first(column(c)).alias(c) for c in self.group_by],
            F.sum(sign).alias("_d_rows"),
            *[F.sum(column(c) * sign).alias(f"_d_sum_{c}") for c in self.sums],
            *[F.sum(F.when(column(c).isNotNull(), sign).otherwise(0)).alias(f"_d_set_{c}") for c in self.sums],
            *[e.alias(f"_in_{n}") for n, e in zip(self._extreme_names(), self._extremes(lambda x: F.when(added, x)))],
            *[e.alias(f"_out_{n}") for n, e in zip(self._extreme_names(), self._extremes(lambda x: F.when(gone, x)))],
        )
        delta = materialize(delta, "deltas")
        held = self.kept.of_keys(delta.select(GROUP)).select(GROUP, *[column(c) for c in self.kept.schema.names if c not in (GROUP, *self.group_by)])
        return delta.join(held, GROUP, "left").withColumn("_lost", self._lost())

    def _extreme_names(self) -> list[str]:
        return [*(f"min_{c}" for c in self.mins), *(f"max_{c}" for c in self.maxs)]

    def _lost(self) -> Column:
        """Whether a group gave up a value as extreme as its extreme and got none as extreme."""
        lost = F.lit(False)
        for name in self._extreme_names():
            held, came, went = column(name), column(f"_in_{name}"), column(f"_out_{name}")
            as_extreme = (lambda x: x <= held) if name.startswith("min_") else (lambda x: x >= held)  # noqa: B023
            lost = lost | F.coalesce(as_extreme(went) & ~F.coalesce(as_extreme(came), F.lit(False)), F.lit(False))
        return lost

    def recomputed(self, moved: DataFrame, now: Version) -> DataFrame:
        """The extremes of the groups that lost one, from the table."""
        wanted = moved.where("_lost").select(GROUP)
        rows = self._with_group(self.table.read(now)).join(wanted, GROUP, "left_semi")
        names = self._extreme_names()
        return rows.groupBy(GROUP).agg(*[e.alias(f"_new_{n}") for n, e in zip(names, self._extremes(lambda x: x))])

    def _with_extremes(self, moved: DataFrame, now: Version) -> DataFrame:
        """The touched groups as changes of the kept table."""
        names = self._extreme_names()
        types = {f.name: f.dataType for f in self.kept.schema.fields}
        if names and not moved.where("_lost").isEmpty():
            moved = moved.join(self.recomputed(moved, now), GROUP, "left")
        else:
            moved = moved.withColumns({f"_new_{n}": F.lit(None).cast(types[n]) for n in names})

        def plus(held: str, delta: str) -> Column:
            zero = F.lit(0)
            return (F.coalesce(column(held), zero) + F.coalesce(column(delta), zero)).cast(types[held])

        n_rows = plus(ROWS, "_d_rows")
        values = {f"set_{c}": plus(f"set_{c}", f"_d_set_{c}") for c in self.sums}
        values |= {f"sum_{c}": F.when(values[f"set_{c}"] > 0, plus(f"sum_{c}", f"_d_sum_{c}")) for c in self.sums}
        for name in names:
            pick = F.least if name.startswith("min_") else F.greatest
            values[name] = F.when(F.col("_lost"), column(f"_new_{name}")).otherwise(pick(column(name), column(f"_in_{name}")))
        return moved.select(
            GROUP, *columns(self.group_by), n_rows.alias(ROWS), *[v.alias(n) for n, v in values.items()],
            F.when(n_rows > 0, F.lit("+U")).otherwise(F.lit("-D")).alias(OP),
        )

