"""Load-ready COPY files: one text file per writer, and reading them back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkapply.functions.copycsv import encode_lines
from bulkapply.functions.names import column

# Fixed value: no text of the target can hold this character, so no string is mistaken for a null.
_NO_VALUE = "\u0000"
CSV_OPTIONS = {
    "multiLine": True,
    "lineSep": "\n",
    "escape": '"',
    "nullValue": _NO_VALUE,
    "emptyValue": "",
    "mode": "FAILFAST",
}


def copy_statement(table: str, columns: Sequence[str]) -> str:
    """The statement that loads one of the files."""
    return f"COPY {table}({', '.join(columns)}) FROM STDIN WITH (FORMAT CSV)"


def write_copy_files(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    timestamp_digits: int = 6,
    max_rows_per_file: int = 0,
    mode: str = "errorifexists",
) -> None:
    """Encode and write without a shuffle. The files appear together when the job commits, so a retry leaves no copies."""
    lines = encode_lines(df, columns, timestamp_digits)
    lines.write.mode(mode).option("maxRecordsPerFile", max_rows_per_file).text(path)


def read_copy_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Decode files of ``write_copy_files``; strings may hold newlines, so a file is read by one task. ``read_copy_ranges``
    has many tasks read a file.

    In a file of one column a null is an empty line, which the CSV reader would skip, so such files are read as lines. Of one
    text column, whose values may hold newlines, a null could not be told from part of a value: that shape is refused.
    """
    if len(schema.fields) == 1:
        only = schema.fields[0]
        if isinstance(only.dataType, (T.StringType, T.CharType, T.VarcharType)):
            raise ValueError("files of a single text column cannot be read back: a null and a newline in a text look alike")
        value = F.when(F.col("value") != "", F.col("value"))
        lines = spark.read.option("lineSep", "\n").text(path)
        return lines.select(decoded(value, only.dataType).alias(only.name))
    rows = spark.read.schema(T.StructType(text_fields(schema))).options(**CSV_OPTIONS).csv(path)
    return rows.withColumns({
        f.name: decoded(column(f.name), f.dataType) for f in schema.fields if isinstance(f.dataType, T.BinaryType)
    })


def text_fields(schema: T.StructType) -> list[T.StructField]:
    """The fields as the CSV functions read them: bytes as their hexadecimal text."""
    return [T.StructField(f.name, T.StringType()) if isinstance(f.dataType, T.BinaryType) else f for f in schema.fields]


def decoded(text: Column, data_type: T.DataType) -> Column:
    """A field's value: bytes from their hexadecimal form, anything else by a cast."""
    if isinstance(data_type, T.BinaryType):
        return F.unhex(F.substr(text, F.lit(3)))
    return text.cast(data_type)
