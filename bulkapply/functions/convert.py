"""Column conversion to what a target takes, as casts that stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkapply.functions.names import column
from bulkapply.functions.schema import validate_schema


def to_declared(df: DataFrame, declared: Mapping[str, T.DataType]) -> DataFrame:
    """Exactly the declared columns, in that order, cast to the declared types; a value that does not fit fails."""
    validate_schema(T.StructType([T.StructField(c, t) for c, t in declared.items()]))
    return df.select(*[column(c).cast(t).alias(c) for c, t in declared.items()])


def to_sql_types(df: DataFrame, instants: bool = False) -> DataFrame:
    """Columns as writers accept them: TIME as ``HH:mm:ss``, instants as local time of the session's zone.

    Targets that hold ``instants``, as Parquet does, get them as they are.
    """
    validate_schema(df.schema)
    return df.select(*[_at_edge(f, instants).alias(f.name) for f in df.schema.fields])


def _at_edge(field: T.StructField, instants: bool):
    value = column(field.name)
    if isinstance(field.dataType, T.TimeType):
        return F.substring(value.cast("string"), 1, 8)
    if isinstance(field.dataType, T.TimestampType) and not instants:
        return value.cast("timestamp_ntz")
    return value
