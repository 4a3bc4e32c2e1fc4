"""The first rows: only those near the bound are sorted, whatever their order, types and ties."""

import datetime as dt
import random

import pytest

from bulkapply.operators import flush, keyed


@pytest.fixture
def sorted_rows(monkeypatch):
    """How many rows each range sort of the test got."""
    seen = []
    number = flush.number_in_order
    monkeypatch.setattr(keyed, "number_in_order", lambda df, *a, **k: seen.append(df.count()) or number(df, *a, **k))
    return seen


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_only_rows_up_to_the_bound_are_sorted(spark, sorted_rows, monkeypatch):
    monkeypatch.setattr(keyed, "_SAMPLE", 4000)
    df = spark.range(0, 60_000, 1, 7).selectExpr("(id * 7919) % 60000 k", "id % 3 g")
    assert {r.k for r in keyed.limit_rows(df, 200, ["k"]).collect()} == set(range(200))
    assert sorted_rows[0] < 5000
    # Ties of the first column are cut by the others, so the bound lies inside them.
    ties = keyed.limit_rows(df, 300, ["g"])
    assert {tuple(r) for r in ties.collect()} == {(k, 0) for k in sorted(r.k for r in df.where("g = 0").collect())[:300]}
    assert sorted_rows[1] < 5000


def test_nulls_texts_and_times(spark):
    rng = random.Random(1)
    values = [(rng.choice([None, "b", "a", "é"]), rng.choice([None, dt.datetime(2024, 1, 1), dt.datetime(2023, 1, 1)]), i) for i in range(300)]
    df = spark.createDataFrame(values, "s string, t timestamp_ntz, i int").repartition(5)
    first = lambda v: tuple((x is not None, x) for x in v)
    for n in (0, 1, 40, 290, 300, 1000):
        assert rows(keyed.limit_rows(df, n, ["s", "t"])) == sorted(sorted(values, key=first)[:n], key=str)


def test_a_bound_too_low_is_widened_or_dropped(spark, sorted_rows, monkeypatch):
    """A sample that misleads costs another pass, and no row."""
    monkeypatch.setattr(keyed, "_SAMPLE", 2000)
    df = spark.range(0, 20_000, 1, 4).selectExpr("id k")
    real = type(df).sample
    monkeypatch.setattr(type(df), "sample", lambda self, *a, **k: real(self, *a, **k).where("k < 10"))
    assert {r.k for r in keyed.limit_rows(df, 100, ["k"]).collect()} == set(range(100))
    assert sorted_rows == [20_000]
