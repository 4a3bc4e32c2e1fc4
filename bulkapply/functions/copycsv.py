"""Rows as text for ``COPY … FROM … WITH (FORMAT CSV)``: one encoded line per row.

A null is an empty field, an empty string is ``""``, and every string is quoted, so the two stay apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkapply.functions.names import column as named
from bulkapply.functions.names import columns as all_named
from bulkapply.functions.schema import validate_schema

LINE = "line"
_TEXT = (T.StringType, T.CharType, T.VarcharType)
_PLAIN = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
)


# Names of the session zone that have no daylight saving.
_UNSHIFTED = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def encode(column: Column, data_type: T.DataType, timestamp_digits: int = 6, zone: str = "UTC") -> Column:
    """One field, without the null rule. ``zone`` is the session's zone."""
    if isinstance(data_type, _TEXT):
        return F.concat(F.lit('"'), F.replace(column, F.lit('"'), F.lit('""')), F.lit('"'))
    if isinstance(data_type, _PLAIN):
        return column.cast("string")
    if isinstance(data_type, T.DateType):
        return _unsigned_year(column.cast("string"))
    if isinstance(data_type, T.BinaryType):
        return F.concat(F.lit("\\x"), F.lower(F.hex(column)))
    if isinstance(data_type, T.TimeType):
        return F.substring(column.cast("string"), 1, 8)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return _unsigned_year(_timestamp(column, timestamp_digits, zone in _UNSHIFTED))
    raise TypeError(f"no text form for {data_type.simpleString()}")


def _unsigned_year(text: Column) -> Column:
    """Years beyond 9999 print with a plus sign, which the target does not take."""
    return F.ltrim(text, F.lit("+"))


def _timestamp(column: Column, digits: int, unshifted: bool) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` and ``digits`` of the fraction.

    Formatting goes through an instant of the session's zone, where some local times do not exist; so it serves only
    zones without daylight saving. Elsewhere the printed form is cut or filled, which is exact but slower.
    """
    if unshifted:
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss" + ("." + "S" * digits if digits else ""))
    text = column.cast("string")
    whole = F.substring_index(text, ".", 1)
    if digits == 0:
        return whole
    return F.concat(whole, F.lit("."), F.rpad(F.split_part(text, F.lit("."), F.lit(2)), digits, "0"))


def encoded_line(schema: T.StructType, timestamp_digits: int = 6, zone: str = "UTC") -> Column:
    fields = [
        F.coalesce(encode(named(f.name), f.dataType, timestamp_digits, zone), F.lit("")) for f in schema.fields
    ]
    return F.concat_ws(",", *fields)


def encode_lines(
    df: DataFrame, columns: Sequence[str] | None = None, timestamp_digits: int = 6, keep: Sequence[str] = ()
) -> DataFrame:
    """The named columns of each row as one ``line``; columns in ``keep`` stay beside it."""
    columns = list(columns or df.columns)
    schema = T.StructType([df.schema[c] for c in columns])
    validate_schema(schema)
    if df.sparkSession.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("spark.sql.ansi.enabled must be true: without it small decimals print in scientific form")
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    return df.select(*all_named(keep), encoded_line(schema, timestamp_digits, zone).alias(LINE))
