"""One writer per key, writers as even as the keys allow."""

import glob

import pytest
from pyspark.sql import functions as F

from bulkapply.sources import tables


def loads(df):
    return {r.writer: r["count"] for r in df.groupBy("writer").count().collect()}


def test_a_third_of_the_rows_on_three_keys(spark):
    n, writers = 30_000, 8
    key = F.when(F.col("id") % 3 == 0, F.col("id") % 9 / 3).otherwise(F.col("id"))
    df = spark.range(n).select(key.cast("int").alias("k"), F.col("id"))
    placed = tables.writer_of_keys(df, ["k"], writers)
    assert placed.groupBy("k").agg(F.count_distinct("writer").alias("n")).where("n > 1").isEmpty()
    found = loads(placed)
    best = max(n / writers, n / 9)
    assert sum(found.values()) == n and max(found.values()) <= 1.5 * best


def test_one_key_with_half_of_the_rows_is_alone(spark):
    df = spark.range(10_000).selectExpr("if(id % 2 = 0, null, id % 40) k", "string(id % 5) j")
    placed = tables.writer_of_keys(df, ["k"], 4)
    hot = placed.where("k is null").select("writer").distinct().collect()
    assert len(hot) == 1
    found = loads(placed)
    assert found[hot[0].writer] == 5000 and max(n for w, n in found.items() if w != hot[0].writer) <= 1.5 * 5000 / 3
    both = tables.writer_of_keys(df, ["k", "j"], 3)
    assert both.groupBy("k", "j").agg(F.count_distinct("writer").alias("n")).where("n > 1").isEmpty()


def test_a_writer_is_one_task_with_one_file(spark, folder):
    df = spark.range(4000).selectExpr("id % 50 `a.k`", "id", "7 _writer").repartition(6)
    tables.append_keyed(df, f"{folder}/t", ["a.k"], 5)
    for path in glob.glob(f"{folder}/t/writer=*"):
        assert len(glob.glob(f"{path}/*.parquet")) == 1
    back = spark.read.parquet(f"{folder}/t")
    assert back.count() == 4000 and back.groupBy("`a.k`").agg(F.count_distinct("writer").alias("n")).where("n > 1").isEmpty()


def test_rules(spark):
    with pytest.raises(ValueError, match="writer"):
        tables.writer_of_keys(spark.range(3), ["id"], 0)
    assert tables.writer_of_keys(spark.range(0), ["id"], 3).count() == 0
