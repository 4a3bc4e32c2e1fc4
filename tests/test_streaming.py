import datetime as dt
import glob
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bulkapply import SinkOptions
from bulkapply.functions.schema import SchemaError
from bulkapply.operators.changelog import ChangelogError
from bulkapply.sources import copyfiles
from bulkapply.streaming import sink
from bulkapply.streaming.changelog_table import ChangelogTable

SCHEMA = "k int, seq int, v string, _op string"


def land(spark, rows, path, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, path, schema=SCHEMA):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def table_at(spark, folder, arrival_order=True, sequence_by=("seq",)):
    empty = spark.createDataFrame([], SCHEMA)
    return ChangelogTable(spark, f"{folder}/table", empty.schema, ["k"], list(sequence_by), arrival_order)


def state(table):
    return sorted((r["k"], r["v"]) for r in table.state().collect())


def feed(spark, folder, table):
    table.feed(stream_of(spark, f"{folder}/in"), available_now=True).awaitTermination()


def test_restart_goes_on_where_it_stopped(spark, folder):
    table = table_at(spark, folder)
    land(spark, [(1, 1, "a", "+I"), (2, 1, "b", "+I"), (1, 2, "a2", "+U")], f"{folder}/in")
    feed(spark, folder, table)
    assert state(table) == [(1, "a2"), (2, "b")]
    land(spark, [(2, 2, None, "-D"), (3, 1, "c", "+I")], f"{folder}/in")
    feed(spark, folder, table)
    assert state(table) == [(1, "a2"), (3, "c")]
    assert sorted(os.listdir(f"{folder}/table/log")) == ["batch_id=0", "batch_id=1"]


@pytest.mark.parametrize("arrival_order,expected", [(True, [(1, "late"), (2, "back")]), (False, [(1, "new")])])
@pytest.mark.parametrize("compact", [False, True])
def test_late_changes(spark, folder, arrival_order, expected, compact):
    table = table_at(spark, folder, arrival_order)
    table.write_batch(spark.createDataFrame([(1, 9, "new", "+U"), (2, 9, None, "-D")], SCHEMA), 0)
    if compact:
        assert table.compact() == 0
        table.remove_replaced()
    table.write_batch(spark.createDataFrame([(1, 5, "late", "+U"), (2, 5, "back", "+I")], SCHEMA), 1)
    assert state(table) == expected


def test_repeated_batch_changes_nothing(spark, folder):
    table = table_at(spark, folder)
    first = spark.createDataFrame([(1, 1, "a", "+I"), (2, 1, "b", "+I")], SCHEMA)
    second = spark.createDataFrame([(1, 2, None, "-D"), (2, 2, "B", "+U")], SCHEMA)
    for n, rows in [(0, first), (1, second), (1, second)]:
        table.write_batch(rows, n)
    assert state(table) == [(2, "B")]
    table.compact()
    table.write_batch(second, 1)
    assert state(table) == [(2, "B")]


def test_crash_between_write_and_checkpoint(spark, folder):
    """The batch is written, the query dies before its offsets are committed, the restart writes it again."""
    table = table_at(spark, folder)
    land(spark, [(1, 1, "a", "+I"), (2, 1, "b", "+I")], f"{folder}/in")

    def write_and_die(rows, batch_id):
        table.write_batch(rows, batch_id)
        raise RuntimeError("killed")

    checkpoint = f"{folder}/table/checkpoint"
    query = sink.apply_stream(
        stream_of(spark, f"{folder}/in"), write_and_die, checkpoint, SinkOptions(max_retries=0), available_now=True
    )
    with pytest.raises(Exception, match="killed"):
        query.awaitTermination()
    assert not glob.glob(f"{checkpoint}/commits/0")
    feed(spark, folder, table)
    assert state(table) == [(1, "a"), (2, "b")]
    assert os.listdir(f"{folder}/table/log") == ["batch_id=0"]


def test_unfinished_batch_is_not_read(spark, folder):
    table = table_at(spark, folder)
    table.write_batch(spark.createDataFrame([(1, 1, "a", "+I")], SCHEMA), 0)
    table.write_batch(spark.createDataFrame([(1, 2, "half", "+U")], SCHEMA), 1)
    os.remove(f"{folder}/table/log/batch_id=1/_committed")
    assert state(table) == [(1, "a")]


def test_compaction_and_clearing(spark, folder):
    table = table_at(spark, folder)
    assert table.compact() == -1 and state(table) == []
    for n in range(3):
        table.write_batch(spark.createDataFrame([(n, 1, "v", "+I"), (0, n, f"v{n}", "+U")], SCHEMA), n)
    before = state(table)
    assert table.compact() == 2 and state(table) == before
    assert table.compact() == 2
    assert table.remove_replaced() == 2
    assert os.listdir(f"{folder}/table/log") == ["batch_id=2"]
    table.write_batch(spark.createDataFrame([(1, 2, None, "-D")], SCHEMA), 3)
    assert state(table) == [row for row in before if row[0] != 1]
    assert table.compact() == 3
    assert state(table) == [row for row in before if row[0] != 1]
    assert table.remove_replaced() == 2


def test_stream_that_compacts_itself(spark, folder):
    table = table_at(spark, folder)
    for n in range(5):
        land(spark, [(n, n, f"v{n}", "+I"), (0, n, None if n == 4 else f"w{n}", "-D" if n == 4 else "+U")], f"{folder}/in")
    table.feed(stream_of(spark, f"{folder}/in"), available_now=True, compact_every=2).awaitTermination()
    assert sorted(os.listdir(f"{folder}/table/base")) == ["through=1", "through=3"]
    expected = [(n, f"v{n}") for n in range(1, 5)]
    assert state(table) == expected
    assert table.remove_replaced() == 4
    assert state(table) == expected
    with pytest.raises(ValueError, match="positive"):
        table.feed(stream_of(spark, f"{folder}/in"), compact_every=0)


def test_batches_without_their_checkpoint_are_refused(spark, folder):
    table = table_at(spark, folder)
    table.write_batch(spark.createDataFrame([(1, 1, "a", "+I")], SCHEMA), 0)
    land(spark, [(2, 1, "b", "+I")], f"{folder}/in")
    with pytest.raises(ValueError, match="checkpoint"):
        feed(spark, folder, table)


def test_table_rules(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    with pytest.raises(ValueError, match="sequence"):
        ChangelogTable(spark, folder, schema, ["k"], [], arrival_order=False)
    with pytest.raises(ValueError, match="kind"):
        ChangelogTable(spark, folder, spark.range(1).schema, ["id"], ["id"])
    with pytest.raises(SchemaError):
        ChangelogTable(spark, folder, spark.sql("SELECT 1 k, array(1) a, '' _op").schema, ["k"], ["k"])
    with pytest.raises(ChangelogError):
        ChangelogTable(spark, folder, schema, [], ["seq"]).write_batch(spark.createDataFrame([], SCHEMA), 0)


def test_running_aggregate(spark, folder):
    """Counts per product grow over several micro-batches; the table holds the last count of each."""
    for product in ["Laptop", "Mouse", "Laptop", "Keyboard", "Mouse"]:
        land(spark, [(product, 10)], f"{folder}/in", "product string, amount int")
    sales = (
        stream_of(spark, f"{folder}/in", "product string, amount int")
        .groupBy("product").agg(F.count(F.lit(1)).alias("sales_count"), F.sum("amount").alias("total"))
        .withColumn("_op", F.lit("+U"))
    )
    table = ChangelogTable(spark, f"{folder}/table", sales.schema, ["product"], [])
    table.feed(sales, output_mode="update", available_now=True).awaitTermination()
    assert sorted(map(tuple, table.state().collect())) == [("Keyboard", 1, 10), ("Laptop", 2, 20), ("Mouse", 2, 20)]
    assert len(os.listdir(f"{folder}/table/log")) >= 5


def test_append_stream(spark, folder):
    """Three orders in, three orders out, also after a restart with nothing new."""
    schema = "order_id int, user_name string, amount decimal(10,2), order_time timestamp_ntz"
    rows = [(n, f"user{n}", Decimal("10.50") * n, dt.datetime(2024, 1, 1, n)) for n in (1, 2, 3)]
    land(spark, rows, f"{folder}/in", schema)
    for _ in range(2):
        sink.append_stream(
            stream_of(spark, f"{folder}/in", schema), f"{folder}/out", f"{folder}/cp",
            SinkOptions(parallelism=2), available_now=True,
        ).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(f"{folder}/out").collect())) == rows


def test_interval_trigger_flushes(spark, folder):
    land(spark, [(1, 1, "a", "+I")], f"{folder}/in")
    query = sink.append_stream(
        stream_of(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/cp", SinkOptions(interval=0.2)
    )
    try:
        query.processAllAvailable()
        land(spark, [(2, 1, "b", "+I")], f"{folder}/in")
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_copy_stream(spark, folder):
    schema = "order_id int, product_name string, quantity int, total_price decimal(10,2), order_date timestamp_ntz"
    rows = [(1000 + n, name, n, Decimal("9.99"), dt.datetime(2024, 1, n)) for n, name in enumerate(["Laptop", 'Mo"use', ""], 1)]
    land(spark, rows, f"{folder}/in", schema)
    stream = stream_of(spark, f"{folder}/in", schema)
    sink.copy_stream(stream, f"{folder}/out", f"{folder}/cp", available_now=True).awaitTermination()
    back = copyfiles.read_copy_files(spark, f"{folder}/out/batch_id=0", stream.schema)
    assert sorted(map(tuple, back.collect())) == rows


def test_failing_flush_is_retried(spark, folder):
    land(spark, [(1, 1, "a", "+I")], f"{folder}/in")
    calls = []

    def twice(rows, batch_id):
        calls.append(rows.count())
        if len(calls) < 3:
            raise OSError("not yet")

    sink.apply_stream(
        stream_of(spark, f"{folder}/in"), twice, f"{folder}/cp", SinkOptions(retry_interval=0.01), available_now=True
    ).awaitTermination()
    assert calls == [1, 1, 1]


def test_batches_count_without_the_committer_s_own_marker(spark, folder):
    table = table_at(spark, folder)
    table.write_batch(spark.createDataFrame([(1, 1, "a", "+I")], SCHEMA), 0)
    os.remove(f"{folder}/table/log/batch_id=0/_SUCCESS")
    assert state(table) == [(1, "a")]
    table.compact()
    assert state(table) == [(1, "a")]
    assert "FileScan" in plan_of(table) and "Exchange" not in plan_of(table)


def plan_of(table):
    return table.state()._jdf.queryExecution().executedPlan().toString()


def test_older_bases_are_kept_as_asked(spark, folder):
    table = table_at(spark, folder)
    for n in range(4):
        table.write_batch(spark.createDataFrame([(n, n, "v", "+I")], SCHEMA), n)
        table.compact()
    table.remove_replaced(keep=2)
    assert sorted(p for p in os.listdir(f"{folder}/table/base") if p.startswith("through")) == ["through=2", "through=3"]
    assert len(state(table)) == 4
    with pytest.raises(ValueError):
        table.remove_replaced(keep=0)
