"""Keys that arrive in another type than the target's: no key may become another one, and none may be doubled."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bulkapply.operators import changelog, keyed
from bulkapply.operators.changelog import ChangelogError


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a"), (5, "b"), (6, "c")], "k int, v string")


def rows(df):
    return sorted(map(tuple, df.collect()))


FRACTIONS = [(Decimal("5.20"), "x", 1), (Decimal("5.40"), "y", 2)]


def test_lossy_keys_are_refused(spark, target):
    given = spark.createDataFrame(FRACTIONS, "k decimal(10,2), v string, seq int")
    with pytest.raises(ChangelogError, match="exactly"):
        keyed.upsert(target, given, ["k"], ["seq"])
    with pytest.raises(ChangelogError, match="exactly"):
        keyed.insert_if_absent(target.select("k"), given.select("k"))
    with pytest.raises(ChangelogError, match="exactly"):
        changelog.apply_changes(target, given.withColumn("_op", F.lit("+U")), ["k"], ["seq"])
    days = spark.createDataFrame([(dt.date(2024, 1, 1), "a")], "k date, v string")
    times = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), "x", 1), (dt.datetime(2024, 1, 1, 6), "y", 2)], "k timestamp_ntz, v string, seq int")
    with pytest.raises(ChangelogError, match="exactly"):
        keyed.upsert(days, times, ["k"], ["seq"])


def test_texts_and_decimals_that_name_one_key_are_one_row(spark, target):
    texts = spark.createDataFrame([("5", "x", 1), ("05", "y", 2), ("7", "z", 1)], "k string, v string, seq int")
    assert rows(keyed.upsert(target, texts, ["k"], ["seq"])) == [(1, "a"), (5, "y"), (6, "c"), (7, "z")]
    whole = spark.createDataFrame([(Decimal(5), "x", 1), (Decimal(5), "y", 2)], "k decimal(20,0), v string, seq int")
    assert rows(keyed.upsert(target, whole, ["k"], ["seq"])) == [(1, "a"), (5, "y"), (6, "c")]
    changes = texts.withColumn("_op", F.when(F.col("seq") == 2, "-D").otherwise("+U"))
    assert rows(changelog.apply_changes(target, changes, ["k"], ["seq"])) == [(1, "a"), (6, "c"), (7, "z")]


def test_update_matches_equal_values_only(spark, target):
    given = spark.createDataFrame([*FRACTIONS, (Decimal("6.00"), "new", 1), (Decimal("6.00"), "newer", 2), (None, "n", 1)], "k decimal(10,2), v string, seq int")
    assert rows(keyed.update_by_key(target, given, ["k"], ["v"], ["seq"])) == [(1, "a"), (5, "b"), (6, "newer")]


@pytest.mark.parametrize("kind", ["double", "decimal(10,2)"])
def test_delete_lookup_and_exists_compare_values(spark, target, kind):
    asked = spark.sql(f"SELECT cast(x AS {kind}) AS k FROM VALUES (1.5), (5.0), (null), (9.0) AS t(x)")
    assert rows(keyed.delete_by_key(target, asked, ["k"])) == [(1, "a"), (6, "c")]
    assert rows(keyed.lookup_by_key(target, asked, ["k"], ["v"])) == [("b",)]
    found = keyed.row_exists(asked, target, ["k"])
    assert found.schema["k"].dataType == asked.schema["k"].dataType
    assert {(None if r.k is None else float(r.k)): r.row_exists for r in found.collect()} == {1.5: False, 5.0: True, None: False, 9.0: False}


def test_numbers_beyond_the_target_do_not_exist(spark, target):
    asked = spark.createDataFrame([(2**40,), (1,)], "k long")
    assert rows(keyed.delete_by_key(target, asked, ["k"])) == [(5, "b"), (6, "c")]
    assert rows(keyed.row_exists(asked, target, ["k"])) == [(1, True), (2**40, False)]


def test_settled_in_another_type_is_refused(spark, target):
    changes = spark.createDataFrame([("5", "x", "+U")], "k string, v string, _op string")
    with pytest.raises(ChangelogError, match="settled"):
        changelog.apply_settled(target, changelog.settle(changes, ["k"], []), ["k"])
    settled = keyed.settle_rows(target, changes.drop("_op"), ["k"], [])
    assert rows(keyed.upsert_settled(target, settled, ["k"])) == [(1, "a"), (5, "x"), (6, "c")]
    assert rows(keyed.update_settled(target, settled, ["k"], ["v"])) == [(1, "a"), (5, "x"), (6, "c")]


def test_limit_with_ties_is_the_same_in_any_layout(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("a"), "id", F.lit("x").alias("b"))
    wanted = sorted((i % 3, i) for i in range(500))[:200]
    for n in (1, 4, 9):
        assert sorted((r.a, r.id) for r in keyed.limit_rows(df.repartition(n), 200, ["a"]).collect()) == wanted
    assert keyed.limit_rows(df, 0, ["a"]).count() == 0
