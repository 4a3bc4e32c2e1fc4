"""Which Spark types a target can hold, under what SQL name, and whether the data fits a declared schema."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaError(ValueError):
    """A schema the target cannot hold."""


# SQL type names of the types without parameters.
SQL_NAMES = {
    "boolean": "BOOLEAN",
    "tinyint": "TINYINT",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "REAL",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "binary": "VARBINARY",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}
# PostgreSQL spells these differently in column definitions.
POSTGRES_NAMES = {"TINYINT": "SMALLINT", "DOUBLE": "DOUBLE PRECISION", "VARCHAR": "TEXT", "VARBINARY": "BYTEA"}
# Precision ranges of the target.
DECIMAL_PRECISION = range(1, 1001)



def sql_type(data_type: T.DataType) -> str | None:
    """SQL type name, or None where the target has no such type."""
    if isinstance(data_type, T.DecimalType):
        return f"DECIMAL({data_type.precision},{data_type.scale})" if data_type.precision in DECIMAL_PRECISION else None
    if isinstance(data_type, T.CharType):
        return f"CHAR({data_type.length})"
    if isinstance(data_type, T.VarcharType):
        return f"VARCHAR({data_type.length})"
    if isinstance(data_type, T.TimeType):
        return "TIME"
    return SQL_NAMES.get(data_type.simpleString())


def column_definition(data_type: T.DataType) -> str:
    """The type as PostgreSQL's CREATE TABLE takes it."""
    name = sql_type(data_type)
    if name is None:
        raise SchemaError(f"the target has no type for {data_type.simpleString()}")
    return POSTGRES_NAMES.get(name, name)


def validate_schema(schema: T.StructType) -> None:
    """Refuse, before any job runs, columns whose type the target cannot hold."""
    refused = [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields if sql_type(f.dataType) is None]
    if refused:
        raise SchemaError(f"the target has no type for: {', '.join(refused)}")


def schema_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column: its SQL type if the target has one, and how many of its values are set.

    One aggregate per table; only counts leave the scan.
    """
    return reduce(DataFrame.unionByName, [_table_report(name, df) for name, df in tables.items()])


def _table_report(table: str, df: DataFrame) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"_n_{c}") for c in df.columns])
    lines = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(sql_type(f.dataType) is not None).alias("supported"),
            F.coalesce(F.lit(sql_type(f.dataType)), F.lit("none")).alias("sql_type"),
            (F.col("_rows") - F.col(f"_n_{f.name}")).alias("null_count"),
        )
        for f in df.schema.fields
    ]
    return counted.select(
        F.lit(table).alias("table_name"), F.col("_rows").alias("row_count"), F.explode(F.array(*lines)).alias("_line")
    ).select("table_name", "row_count", "_line.*")


# How many bits the whole-number types have.
WHOLE_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}
# Texts that a cast takes, blanks and control characters around them aside.
_AROUND = r"[\x00-\x20\x7f]*"
TEXT_FORMS = {
    "whole": rf"\A{_AROUND}[+-]?[0-9]+{_AROUND}\z",
    "boolean": rf"(?i)\A{_AROUND}(?:t|true|y|yes|1|f|false|n|no|0){_AROUND}\z",
}


def _whole_range(data_type: T.DataType) -> tuple[int, int] | None:
    """Whole numbers the type can hold, lowest and highest."""
    if isinstance(data_type, T.DecimalType):
        highest = 10 ** (data_type.precision - data_type.scale) - 1
        return -highest, highest
    bits = WHOLE_BITS.get(data_type.simpleString())
    return None if bits is None else (-(2 ** (bits - 1)), 2 ** (bits - 1) - 1)


def misfit(column: Column, actual: T.DataType, declared: T.DataType) -> Column:
    """True where a set value cannot be stored as the declared type.

    Numbers are compared with the range of the type; only values at its very edge, where rounding decides, are cast.
    Texts are first matched with the form the type is written in. A cast that fails costs far more than a comparison,
    and a bad load can hold many.
    """
    if isinstance(declared, (T.CharType, T.VarcharType)):
        return column.isNotNull() & (F.char_length(column.cast("string")) > declared.length)
    by_cast = column.isNotNull() & column.try_cast(declared).isNull()
    form = "whole" if declared.simpleString() in WHOLE_BITS else declared.simpleString()
    if isinstance(actual, T.StringType) and form in TEXT_FORMS:
        return F.when(~column.rlike(TEXT_FORMS[form]), F.lit(True)).otherwise(by_cast)
    bounds = _whole_range(declared)
    if bounds is None or not isinstance(actual, T.NumericType):
        return by_cast
    lowest, highest = bounds
    held = _whole_range(actual)
    if held is not None and held[0] >= lowest and held[1] <= highest and not isinstance(actual, T.DecimalType):
        return F.lit(False)
    if held is None:
        inside = (column > float(lowest)) & (column < float(highest))
        outside = (column < float(lowest - 1)) | (column > float(highest + 1))
    else:
        kind = actual if isinstance(actual, T.DecimalType) else T.DecimalType(20, 0)
        number = column if isinstance(actual, T.DecimalType) else column.cast(kind)
        inside = number.between(F.lit(Decimal(lowest)), F.lit(Decimal(highest)))
        # Beyond the edge by less than one, rounding decides, so the cast does; 38 digits have no number beyond.
        wide = len(str(highest + 1)) > 38
        outside = F.lit(False) if wide else (number <= F.lit(Decimal(lowest - 1))) | (number >= F.lit(Decimal(highest + 1)))
    return F.when(inside, F.lit(False)).when(outside, F.lit(True)).otherwise(by_cast)


def conformance(df: DataFrame, declared: Mapping[str, T.DataType]) -> DataFrame:
    """One row: ``n_rows`` and, per declared column, the number of values that do not fit. One pass."""
    validate_schema(T.StructType([T.StructField(c, t) for c, t in declared.items()]))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(misfit(F.col(c), df.schema[c].dataType, t)).alias(f"{c}_misfits") for c, t in declared.items()],
    )
