"""Split reads: one select per parameter row, done as one pruned scan that tags each row with its split."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkapply.functions.names import column as named
from bulkapply.functions.names import columns, free, quoted
from bulkapply.operators.flush import number_in_order
from bulkapply.storage import materialize


def even_ranges(lower: int, upper: int, n: int) -> list[tuple[int, int]]:
    """``n`` adjoining closed ranges that cover ``lower..upper``."""
    if n <= 0 or upper < lower:
        raise ValueError("need at least one split and lower <= upper")
    stride = -(-(upper - lower + 1) // n)
    starts = range(lower, upper + 1, stride)
    return [(start, min(start + stride - 1, upper)) for start in starts]


def split_evenly(df: DataFrame, column: str, lower: int, upper: int, n: int, name: str = "split", rest: int = -1) -> DataFrame:
    """The rows with the number of the even range of a whole-number column they fall in: one division, however many ranges.

    Nulls and values outside ``lower..upper`` are in the split ``rest``, so no row is lost.
    """
    if n <= 0 or upper is None or lower is None or upper < lower:
        raise ValueError("need at least one split and lower <= upper")
    stride = -(-(upper - lower + 1) // n)
    number = F.expr(f"cast(({quoted(column)} - {int(lower)}) div {stride} as int)")
    return df.withColumn(name, F.when(named(column).between(lower, upper), number).otherwise(F.lit(rest)))


def balanced_bounds(df: DataFrame, column: str, n: int, accuracy: int = 10_000) -> list:
    """Values that cut a number or time column into ``n`` parts of about as many rows, from a quantile sketch in one pass.

    Values are distinct and in order; a value that holds more than a part of the rows leaves fewer parts.
    """
    if n <= 0:
        raise ValueError("need at least one split")
    if n == 1:
        return []
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    found = df.agg(F.percentile_approx(named(column), shares, accuracy)).first()[0]
    return sorted(set(found or []))


def split_balanced(df: DataFrame, column: str, bounds: Sequence, name: str = "split", rest: int = -1) -> DataFrame:
    """Rows with the number of the part that ``balanced_bounds`` puts them in: how many bounds lie below the value.

    The first and the last part are open, and nulls are in the split ``rest``, so every row is in one split, also of a table that
    has grown since. The bounds are searched by halves, as nested conditions.
    """
    value = named(column)

    def place(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value <= F.lit(bounds[middle]), place(low, middle)).otherwise(place(middle + 1, high))

    return df.withColumn(name, F.when(value.isNull(), F.lit(rest)).otherwise(place(0, len(bounds))))


def balanced_predicates(column: str, bounds: Sequence) -> list[str]:
    """The same parts as SQL conditions, one JDBC partition each; the last one takes the nulls."""
    limits = [_literal(b) for b in bounds]
    low = [None, *limits]
    high = [*limits, None]
    parts = [" AND ".join([f"{column} > {a}"] * (a is not None) + [f"{column} <= {b}"] * (b is not None)) for a, b in zip(low, high)]
    return [part or f"{column} IS NOT NULL" for part in parts] + [f"{column} IS NULL"]


def _literal(value) -> str:
    """A number, text or time as the SQL of databases writes it."""
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal)):
        return f"'{str(value).replace(chr(39), chr(39) * 2)}'"
    return str(value)


def _tagged(df: DataFrame, conditions: list[Column], name: str) -> DataFrame:
    if not conditions:
        raise ValueError("a split read needs at least one parameter row")
    wanted = df.filter(reduce(lambda a, b: a | b, conditions))
    tags = F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(conditions)]))
    return wanted.withColumn(name, F.explode(tags))


def split_by_ranges(df: DataFrame, column: str, ranges: Sequence[tuple], name: str = "split") -> DataFrame:
    """Rows with ``column`` between each pair of bounds. A row in two overlapping ranges belongs to both splits."""
    return _tagged(df, [named(column).between(lo, hi) for lo, hi in ranges], name)


def split_by_values(
    df: DataFrame, column: str, values: Sequence, name: str = "split", rest: int | None = None
) -> DataFrame:
    """Rows with ``column`` equal to each value, by one look-up per row. A value given twice names two splits.

    Other rows and nulls are left out, or are in the split ``rest`` where that is given.
    """
    if not values:
        raise ValueError("a split read needs at least one parameter row")
    places: dict = {}
    for i, value in enumerate(values):
        places.setdefault(value, []).append(i)
    pairs = [F.lit(x) for value, found in places.items() for x in (value, found)]
    found = F.try_element_at(F.create_map(*pairs).cast(f"map<{df.schema[column].dataType.simpleString()},array<int>>"), named(column))
    if rest is None:
        return df.filter(named(column).isin(*places)).withColumn(name, F.explode(found))
    return df.withColumn(name, F.explode(F.coalesce(found, F.array(F.lit(rest)))))


def split_each_value(df: DataFrame, column: str, name: str = "split", rest: int = -1) -> DataFrame:
    """A split for every value that the column has, numbered from 0 in their order; nulls are in the split ``rest``.

    The values are numbered as a written table and joined, so neither the driver nor a plan holds them, however many there are.
    """
    number = free("_number", df.columns)
    value = free("_value", df.columns)
    distinct = df.select(named(column).alias(value)).where(named(value).isNotNull()).distinct()
    numbered = materialize(number_in_order(distinct, [], [value], number), "split-values")
    joined = df.join(numbered, named(column) == named(value), "left")
    split = F.coalesce((named(number) - 1).cast("int"), F.lit(rest)).alias(name)
    return joined.select(*columns(df.columns), split)


def range_predicates(column: str, ranges: Sequence[tuple[int, int]], rest: bool = False) -> list[str]:
    """The same splits as SQL conditions, one JDBC partition each; with ``rest`` one more for nulls and values in no range."""
    inside = [f"{column} BETWEEN {int(lo)} AND {int(hi)}" for lo, hi in ranges]
    return inside + _remainder(column, inside, rest)


def value_predicates(column: str, values: Sequence[str], rest: bool = False) -> list[str]:
    """A split per value; with ``rest`` one more for nulls and other values."""
    equal = [f"{column} = '{str(v).replace(chr(39), chr(39) * 2)}'" for v in values]
    return equal + _remainder(column, equal, rest)


def _remainder(column: str, conditions: Sequence[str], rest: bool) -> list[str]:
    return [f"{column} IS NULL OR NOT ({' OR '.join(conditions)})"] if rest and conditions else []
