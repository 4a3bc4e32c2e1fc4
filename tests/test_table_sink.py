import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bulkapply.functions.schema import SchemaError
from bulkapply.operators.changelog import ChangelogError
from bulkapply.sources.table_sink import TableSink
from test_jdbc import Warehouse

OPTIONS = {"url": "jdbc:none", "table-name": "t", "sink.max-retries": "1", "sink.retry.interval": "1ms"}


def sink_to(db, schema, keys=(), **more):
    return TableSink.declare(OPTIONS | more, schema, keys, save=db.save, execute=db.execute)


def test_declaration_is_checked(spark):
    with pytest.raises(ValueError, match="table-name"):
        TableSink.declare({"url": "x"}, "a int")
    with pytest.raises(SchemaError):
        TableSink.declare(OPTIONS, "a array<int>")
    with pytest.raises(ValueError, match="key"):
        TableSink.declare(OPTIONS, "a int", ["b"])
    with pytest.raises(ValueError, match="bulk"):
        TableSink.declare(OPTIONS | {"sink.use-copy-protocol": "true"}, "a int", ["a"], connect="m:f")
    with pytest.raises(ValueError, match="connect"):
        TableSink.declare(OPTIONS | {"sink.use-copy-protocol": "true"}, "a int")


def test_append_casts_to_the_declared_types(spark):
    db = Warehouse("CREATE TABLE t (order_id INTEGER, amount DECIMAL(10,2), order_time TIMESTAMP)")
    target = sink_to(db, "order_id int, amount decimal(10,2), order_time timestamp_ntz")
    df = spark.createDataFrame([("2024-01-01 10:00:00", 1, 9.5, "ignored")], "order_time string, order_id bigint, amount double, x string")
    target.write(df, batch_id=1)
    assert db.rows("t") == [(1, Decimal("9.50"), dt.datetime(2024, 1, 1, 10))]
    with pytest.raises(ChangelogError, match="no key"):
        target.write(df, op_col="x")


def test_keyed_rows_without_kinds_are_writes(spark):
    db = Warehouse("CREATE TABLE t (k INTEGER PRIMARY KEY, v VARCHAR)")
    target = sink_to(db, "k int, v string", ["k"])
    target.write(spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k int, v string, seq int"), ["seq"])
    assert db.rows("t") == [(1, "b")]
    target.write(spark.createDataFrame([(1, None, "-D"), (2, "c", "+I")], "k int, v string, kind string"), op_col="kind")
    assert db.rows("t") == [(2, "c")]


def test_keyed_stream_with_a_failing_flush(spark, folder):
    db = Warehouse("CREATE TABLE t (product VARCHAR PRIMARY KEY, sales_count BIGINT)")
    target = sink_to(db, "product string, sales_count bigint", ["product"])
    for product in ("Laptop", "Mouse", "Laptop"):
        spark.createDataFrame([(product,)], "product string").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema("product string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    counts = stream.groupBy("product").agg(F.count(F.lit(1)).alias("sales_count"))
    db.broken = 1
    target.write_stream(counts, f"{folder}/cp", output_mode="update", available_now=True).awaitTermination()
    assert db.rows("t") == [("Laptop", 2), ("Mouse", 1)]
    assert db.tables() == ["t"]


def test_stream_of_updates_needs_a_key(spark, folder):
    target = sink_to(Warehouse("CREATE TABLE t (a BIGINT)"), "a bigint")
    stream = spark.readStream.format("rate").load().select(F.col("value").alias("a"))
    for bad in ({"output_mode": "update"}, {"op_col": "a"}):
        with pytest.raises(ChangelogError, match="no key"):
            target.write_stream(stream, folder, **bad)


def test_append_stream(spark, folder):
    db = Warehouse("CREATE TABLE t (a BIGINT)")
    spark.range(5).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("id bigint").parquet(f"{folder}/in").withColumnRenamed("id", "a")
    for _ in range(2):
        sink_to(db, "a bigint").write_stream(stream, f"{folder}/cp", available_now=True).awaitTermination()
    assert db.rows("t") == [(n,) for n in range(5)]
