import glob

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkapply.functions import copycsv
from bulkapply.functions.schema import SchemaError
from bulkapply.sources import copyfiles


def line(spark, sql, **more):
    return copycsv.encode_lines(spark.sql(sql), **more).first()["line"]


@pytest.mark.parametrize(
    "value,text",
    [
        ("true", "true"), ("CAST(-7 AS TINYINT)", "-7"), ("9223372036854775807", "9223372036854775807"),
        ("1.0E10D", "1.0E10"), ("1.0E-7D", "1.0E-7"), ("CAST(0.5 AS FLOAT)", "0.5"), ("CAST('NaN' AS DOUBLE)", "NaN"),
        ("CAST(0 AS DECIMAL(20,10))", "0.0000000000"), ("CAST(0.00000001 AS DECIMAL(20,10))", "0.0000000100"),
        ("''", '""'), ("'say \"hi\"'", '"say ""hi"""'), ("'a,b\nc'", '"a,b\nc"'), ("'\\\\N'", '"\\N"'),
        ("x'00FFab'", "\\x00ffab"), ("date'2024-02-29'", "2024-02-29"), ("date'+12024-02-29'", "12024-02-29"),
        ("time'01:02:03.9'", "01:02:03"), ("CAST(NULL AS STRING)", ""), ("CAST(NULL AS INT)", ""),
        ("timestamp_ntz'2024-01-02 03:04:05'", "2024-01-02 03:04:05.000000"),
        ("timestamp_ntz'2024-01-02 03:04:05.0123'", "2024-01-02 03:04:05.012300"),
        ("timestamp'2024-01-02 03:04:05.9'", "2024-01-02 03:04:05.900000"),
    ],
)
def test_values(spark, value, text):
    assert line(spark, f"SELECT {value} AS c") == text


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_digits_and_missing_local_times(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moment = "SELECT timestamp_ntz'2024-03-31 02:30:00.123456' AS c"
        for digits, text in [(0, ""), (1, ".1"), (3, ".123"), (6, ".123456")]:
            assert line(spark, moment, timestamp_digits=digits) == "2024-03-31 02:30:00" + text
        assert line(spark, "SELECT timestamp_ntz'1999-12-31 23:59:59.5' AS c", timestamp_digits=3) == "1999-12-31 23:59:59.500"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_record(spark):
    assert line(spark, "SELECT 1 AS a, CAST(NULL AS STRING) AS b, '' AS c, CAST(NULL AS INT) AS d") == '1,,"",'
    df = spark.sql("SELECT 1 AS a, 'x' AS b")
    assert copycsv.encode_lines(df, ["b", "a"], keep=["a"]).first().asDict() == {"a": 1, "line": '"x",1'}


def test_refusals(spark):
    with pytest.raises(SchemaError):
        copycsv.encode_lines(spark.sql("SELECT array(1) AS a"))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            copycsv.encode_lines(spark.sql("SELECT 1 AS a"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


HARD = ["plain", "", None, '"', '""', "a,b", "line\nbreak", "cr\rlf\r\n", "\\N", "\\", "é漢😀", " lead", "trail ", "#c", "\t", "null"]


def test_files_read_back(spark, folder):
    schema = T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("s", T.StringType()), T.StructField("n", T.DecimalType(12, 4)),
        T.StructField("t", T.TimestampNTZType()),
    ])
    df = (
        spark.createDataFrame([(i, s) for i, s in enumerate(HARD)], "id int, s string")
        .withColumn("n", F.when(F.col("id") > 2, (F.col("id") / 7).cast("decimal(12,4)")))
        .withColumn("t", F.when(F.col("id") > 3, F.timestamp_seconds(F.col("id") * 1.25).cast("timestamp_ntz")))
    )
    path = f"{folder}/files"
    copyfiles.write_copy_files(df.repartition(3), path)
    back = copyfiles.read_copy_files(spark, path, schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))

    read = (
        "SELECT * FROM read_csv(?, header=false, delim=',', quote='\"', escape='\"', new_line='\\n', "
        "allow_quoted_nulls=false, nullstr='', "
        "columns={'id': 'INTEGER', 's': 'VARCHAR', 'n': 'DECIMAL(12,4)', 't': 'TIMESTAMP'})"
    )
    plain = df.filter(~F.coalesce(F.col("s").contains("\r"), F.lit(False)))
    path = f"{folder}/plain"
    copyfiles.write_copy_files(plain.coalesce(1), path)
    loaded = duckdb.execute(read, [glob.glob(f"{path}/*.txt")]).fetchall()
    assert sorted(loaded) == sorted(map(tuple, plain.collect()))


def test_whole_documents_read_back(spark, folder):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    copyfiles.write_copy_files(documents, f"{folder}/d", max_rows_per_file=50)
    back = copyfiles.read_copy_files(spark, f"{folder}/d", documents.schema)
    assert back.exceptAll(documents).count() == 0 and documents.exceptAll(back).count() == 0
    assert len(glob.glob(f"{folder}/d/part-*")) >= 4


def test_statement():
    assert copyfiles.copy_statement("t", ["a", "b"]) == "COPY t(a, b) FROM STDIN WITH (FORMAT CSV)"
