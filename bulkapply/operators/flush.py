"""Flush batches as data: which flush a row belongs to, per writer and per time interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkapply.functions.names import column, columns, free, free_each, quoted
from bulkapply.storage import materialize

# Fixed value: monotonically_increasing_id keeps the partition number above this bit.
_PARTITION_BIT = 33


def total_order(df: DataFrame, order_by: Sequence[str], group: Sequence[str]) -> list[str]:
    """``order_by`` and then every other column that can be ordered, so that equal runs number alike."""
    rest = [f.name for f in df.schema.fields if not _holds_map(f.dataType)]
    return [*order_by, *[c for c in rest if c not in order_by and c not in group]]


def _holds_map(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return any(_holds_map(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _holds_map(data_type.elementType)
    return isinstance(data_type, (T.MapType, T.VariantType))


def number_in_order(
    df: DataFrame, writer: Sequence[str], order_by: Sequence[str], name: str, most: int | None = None
) -> DataFrame:
    """Number each writer's rows from 1 in ``order_by`` order, also where one writer holds most of the rows.

    Ties are settled by the remaining columns. With ``most`` only that many rows of each sorted range are kept, which serves
    whoever wants the first rows of all.

    A window over the writer would put all its rows into one task. Instead the rows are range-sorted by writer and
    order, so a hot writer spans many partitions; each partition numbers its own rows by position, and the small table
    of rows per (writer, partition) supplies what came before. The sorted rows are written once, because positions must
    not change between the two readings.
    """
    position, part = free(f"_{name}_position", df.columns), free(f"_{name}_part", df.columns)
    ordered = df.sort(*columns(writer), *columns(total_order(df, order_by, writer)))
    ordered = ordered.withColumn(position, F.monotonically_increasing_id())
    if most is not None:
        ordered = ordered.filter(column(position).bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1)) < most)
    placed = materialize(ordered, "numbered").withColumn(part, F.shiftright(column(position), _PARTITION_BIT))

    group = [*writer, part]
    run_of = free_each("_run_", group, placed.columns)
    first, n_rows, shift = (free(x, placed.columns, run_of.values()) for x in ("_first", "_rows", "_shift"))
    runs = placed.groupBy(*columns(group)).agg(F.min(column(position)).alias(first), F.count(F.lit(1)).alias(n_rows))
    before = Window.partitionBy(*columns(writer)).orderBy(column(part)).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *[column(c).alias(run_of[c]) for c in group],
        (F.coalesce(F.sum(column(n_rows)).over(before), F.lit(0)) - column(first) + 1).alias(shift),
    )
    # Written, so Spark knows how small the table of runs is and does not shuffle the rows again to meet it.
    runs = materialize(runs, "runs")
    same = F.lit(True)
    for c in group:
        same = same & column(c).eqNullSafe(column(run_of[c]))
    return placed.join(runs, same).select(*columns(df.columns), (column(position) + column(shift)).alias(name))


def flush_batches(
    df: DataFrame, writer: Sequence[str], order_by: Sequence[str], max_rows: int, name: str = "flush_id"
) -> DataFrame:
    """Count-triggered flush: the number (from 0) of the batch of ``max_rows`` rows in which its writer sends a row."""
    if max_rows <= 0:
        raise ValueError("max_rows must be positive")
    number = free("_number", df.columns)
    numbered = number_in_order(df, writer, order_by, number)
    return numbered.withColumn(name, F.expr(f"({quoted(number)} - 1) div {int(max_rows)}")).drop(number)


def distinct_keys(df: DataFrame, flush: Sequence[str], keys: dict[str, Column]) -> DataFrame:
    """Each key once per flush; ``keys`` maps a name to the expression that extracts it."""
    return df.select(*columns(flush), *[expr.alias(name) for name, expr in keys.items()]).distinct()


def flush_windows(df: DataFrame, time_col: str, interval: str, writer: Sequence[str] = ()) -> DataFrame:
    """Time-triggered flush: rows per interval, and per ``writer`` where each has a timer of its own, as ``flush_start``
    and ``n_rows``."""
    window = free("_window", df.columns)
    return (
        df.groupBy(*columns(writer), F.window(column(time_col), interval).alias(window))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(*columns(writer), column(window)["start"].alias("flush_start"), "n_rows")
    )
