import pytest
from pyspark.sql import functions as F

from bulkapply.operators import keyed


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "k int, v string, n int")


def test_upsert_replaces_every_column(spark, target):
    changes = spark.createDataFrame(
        [(2, None, None, 1), (4, "d", 40, 1), (4, "e", 50, 2)], "k int, v string, n int, seq int"
    )
    assert rows(keyed.upsert(target, changes, ["k"], ["seq"])) == [(1, "a", 10), (2, None, None), (3, "c", 30), (4, "e", 50)]


def test_upsert_refuses_null_keys(spark, target):
    changes = spark.createDataFrame([(None, "x", 1)], "k int, v string, n int")
    with pytest.raises(Exception, match="null in key columns"):
        keyed.upsert(target, changes, ["k"], ["n"]).collect()


def test_upsert_into_empty(spark, target):
    assert rows(keyed.upsert(target.limit(0), target, ["k"], ["n"])) == rows(target)


def test_insert_if_absent(spark):
    have = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (3, "c")], "k int, v string")
    assert rows(keyed.insert_if_absent(have, new)) == [(1, "a"), (1, "b"), (2, "b"), (3, "c")]
    with pytest.raises(Exception, match="null in key columns"):
        keyed.insert_if_absent(have, spark.createDataFrame([(1, None)], "k int, v string")).collect()


def test_delete_by_key(spark, target):
    gone = spark.createDataFrame([(1,), (1,), (9,), (None,)], "k bigint")
    assert rows(keyed.delete_by_key(target, gone, ["k"])) == [(2, "b", 20), (3, "c", 30)]


def test_delete_with_part_of_the_key_null(spark):
    target = spark.createDataFrame([(1, None), (1, 2)], "a int, b int")
    gone = spark.createDataFrame([(1, None), (1, 2)], "a int, b int")
    assert rows(keyed.delete_by_key(target, gone, ["a", "b"])) == [(1, None)]


def test_update_sets_given_columns_only_and_inserts_nothing(spark, target):
    changes = spark.createDataFrame(
        [(1, "x", 0), (1, None, 1), (7, "y", 0), (None, "z", 0)], "k int, v string, seq int"
    )
    assert rows(keyed.update_by_key(target, changes, ["k"], ["v"], ["seq"])) == [(1, None, 10), (2, "b", 20), (3, "c", 30)]


def test_lookup(spark, target):
    asked = spark.createDataFrame([(1,), (3,), (3,), (None,), (8,)], "k int")
    assert rows(keyed.lookup_by_key(target, asked, ["k"], ["v"])) == [("a",), ("c",)]
    assert rows(keyed.lookup_by_key(target, None, [], ["k"])) == [(1,), (2,), (3,)]


def test_row_exists_keeps_every_question(spark, target):
    asked = spark.createDataFrame([("p", 1), ("q", 1), ("r", 9), ("s", None)], "who string, k bigint")
    answered = keyed.row_exists(asked, target, ["k"])
    assert rows(answered) == [("p", 1, True), ("q", 1, True), ("r", 9, False), ("s", None, False)]
    assert answered.columns == ["who", "k", "row_exists"]


def test_key_rows(spark, target):
    assert rows(keyed.key_rows(target, ["k"])) == [(1,), (2,), (3,)]


def test_limit(spark):
    df = spark.range(0, 1000, numPartitions=6).withColumn("v", 1000 - F.col("id"))
    for n in (0, 3, 700, 2000):
        assert sorted(r["v"] for r in keyed.limit_rows(df, n, ["v"]).collect()) == list(range(1, min(n, 1000) + 1))
    with pytest.raises(ValueError):
        keyed.limit_rows(df, -1, ["v"])



def test_same_answer_without_broadcast(spark, target):
    asked = spark.createDataFrame([(1,), (3,)], "k int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(keyed.lookup_by_key(target, asked, ["k"], ["k"])) == [(1,), (3,)]
        assert rows(keyed.delete_by_key(target, asked, ["k"]).select("k")) == [(2,)]
        assert rows(keyed.row_exists(asked, target.filter("k = 1"), ["k"])) == [(1, True), (3, False)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
