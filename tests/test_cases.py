"""End-to-end cases with Parquet targets and COPY files."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bulkapply import SinkOptions
from bulkapply.sources import copyfiles, dml, tables
from bulkapply.storage import clear_scratch, committed, mark_committed, materialize, scratch_path

BOOKS = [
    (1, "Stream Processing", "Ada", Decimal("55.00"), 3), (2, "Tables", "Ben", Decimal("25.50"), 0),
    (3, "It's \"quoted\"", "Cy", None, 7), (4, "", "Di", Decimal("0.99"), 1), (5, "Last", "Ed", Decimal("10.00"), 2),
]
BOOK_SCHEMA = "id int, title string, author string, price decimal(10,2), quantity int"


def test_books_through_a_bound_statement(spark, folder):
    spark.sql(f"CREATE TABLE books ({BOOK_SCHEMA}) USING parquet LOCATION '{folder}/books'")
    records = spark.createDataFrame(BOOKS, BOOK_SCHEMA)
    bound = dml.bind(records, {f"p{n}": F.col(c) for n, c in enumerate(records.columns, 1)})
    dml.run_statement(
        spark, "INSERT INTO books (id, title, author, price, quantity) SELECT p1, p2, p3, p4, p5 FROM {batch}", bound
    )
    assert sorted(map(tuple, spark.table("books").collect())) == BOOKS
    spark.sql("DROP TABLE books")


def test_append_keeps_duplicates(spark, folder):
    rows = spark.createDataFrame(BOOKS, BOOK_SCHEMA)
    for _ in range(2):
        tables.append(rows, f"{folder}/t", SinkOptions(parallelism=3))
    assert sorted(map(str, tables.read_table(spark, f"{folder}/t").collect())) == sorted(map(str, rows.union(rows).collect()))


def test_counts_per_group(spark, folder):
    seen = spark.createDataFrame([(bird,) for bird in "wren heron wren kestrel wren heron".split()], "bird string")
    tables.append(seen.groupBy("bird").agg(F.count(F.lit(1)).alias("n")), f"{folder}/t")
    assert sorted(map(tuple, tables.read_table(spark, f"{folder}/t").collect())) == [("heron", 2), ("kestrel", 1), ("wren", 3)]


def test_copy_files_keep_every_value(spark, folder):
    schema = "berth int, ship string, containers int, fee decimal(11,2), docked timestamp_ntz, seal binary"
    rows = [
        (40 - 3 * n, ship, None if n == 2 else n * n, Decimal("7310.45") / (n + 1), dt.datetime(2029, 11, 3 + n, 22, 5 * n, n), seal)
        for n, (ship, seal) in enumerate([("Alma, of Riga", b"\x01\xff"), ('The "Tern"', b""), ("", None), ("two\nlines", b"\\x")])
    ]
    rows = [(*r[:3], r[3].quantize(Decimal("0.01")), *r[4:]) for r in rows]
    df = spark.createDataFrame(rows, schema)
    copyfiles.write_copy_files(df, f"{folder}/t", timestamp_digits=3)
    back = copyfiles.read_copy_files(spark, f"{folder}/t", df.schema)
    assert [tuple(r) for r in back.orderBy(F.desc("berth")).collect()] == rows


def test_copy_files_of_one_column(spark, folder):
    df = spark.createDataFrame([(1,), (None,), (3,), (None,)], "k int")
    copyfiles.write_copy_files(df, f"{folder}/t")
    assert sorted(str(r.k) for r in copyfiles.read_copy_files(spark, f"{folder}/t", df.schema).collect()) == ["1", "3", "None", "None"]
    with pytest.raises(ValueError, match="single text column"):
        copyfiles.read_copy_files(spark, f"{folder}/t", df.select(F.lit("x").alias("v")).schema)


def test_writer_folders(spark, folder):
    df = spark.range(0, 900).select("id", F.when(F.col("id") < 300, "hot").otherwise((F.col("id") % 5).cast("string")).alias("w"))
    tables.append_by_writer(df, f"{folder}/t", "w")
    back = spark.read.schema("id bigint, w string").parquet(f"{folder}/t")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_scratch_is_shared_unique_and_clearable(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))
    df = materialize(spark.range(3).withColumn("c", F.lit(None).cast("string")), "m")
    assert df.schema.simpleString() == "struct<id:bigint,c:string>" and df.count() == 3
    for n in (7, 8):
        spark.range(1).write.parquet(f"{one}/n={n}")
    mark_committed(spark, f"{one}/n=7")
    assert list(committed(spark, one, "n=")) == [7]
    assert committed(spark, f"{one}/none", "n=") == {}
    assert clear_scratch(spark)
