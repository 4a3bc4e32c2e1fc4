"""Columns whose names the operators would use themselves, or that hold a dot: none is lost, none is mistaken."""

import pytest
from pyspark.sql import functions as F

from bulkapply.functions.names import free, free_each, quoted
from bulkapply.operators import changelog, flush, keyed

NAMES = ["a.b", "_nth", "_upsert", "_matched", "_new_a.b", "_held_a.b", "_found", "_number", "_keyed", "_first", "_rows", "_shift", "_window"]


@pytest.fixture(scope="module")
def target(spark):
    rows = [(i, *(f"{name}{i}" for name in NAMES[1:])) for i in range(4)]
    return spark.createDataFrame(rows, ", ".join(f"{quoted(n)} {'int' if n == 'a.b' else 'string'}" for n in NAMES))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_free_names():
    assert free("x", ["X", "x_"]) == "x__" and free("x", ["y"]) == "x"
    assert free_each("_", ["a", "A"], ["_b"]) == {"a": "_a", "A": "_A_"}


def test_keyed_operators(target):
    changed = target.where("`a.b` < 2").withColumn("_nth", F.lit("new"))
    after = rows(target.where("`a.b` >= 2").union(changed))
    key, others = ["a.b"], rows(target.where("`a.b` >= 2"))
    assert rows(keyed.upsert(target, changed, key, ["_nth"])) == after
    assert rows(keyed.upsert_settled(target, keyed.settle_rows(target, changed, key, []), key)) == after
    assert rows(keyed.update_by_key(target, changed, key, ["_nth"], [])) == after
    assert rows(keyed.update_settled(target, keyed.settle_rows(target, changed, key, []), key, ["_nth"])) == after
    assert rows(keyed.insert_settled(target, keyed.settle_rows(target, changed, key, []), key)) == rows(target)
    assert rows(keyed.insert_if_absent(target, target.where("`a.b` = 1"))) == rows(target)
    assert rows(keyed.delete_by_key(target, changed, key)) == others
    assert rows(keyed.lookup_by_key(target, changed, key, ["_held_a.b", "a.b"])) == [("_held_a.b0", 0), ("_held_a.b1", 1)]
    exists = keyed.row_exists(target, changed, key, "there")
    assert exists.columns == [*NAMES, "there"] and {r["a.b"] for r in exists.where("there").collect()} == {0, 1}
    assert rows(keyed.limit_rows(target, 2, key)) == rows(target.where("`a.b` < 2"))
    assert keyed.key_rows(target, key).columns == key


def test_changelog_operators(target):
    changes = target.withColumn("_op", F.when(F.col("`a.b`") == 0, "-D").otherwise("+U"))
    last = changelog.collapse(changes.union(changes), ["a.b"], ["_upsert"])
    assert last.columns == [*NAMES, "_op"] and rows(last) == rows(changes)
    kept = rows(target.where("`a.b` > 0"))
    assert rows(changelog.apply_changes(target, changes, ["a.b"], ["_nth"])) == kept
    assert rows(changelog.apply_settled(target, changelog.settle(changes, ["a.b"], []), ["a.b"])) == kept
    assert changelog.violations(changes, ["a.b"]).first()["null_key"] == 0
    assert changelog.latest(target, ["a.b"], []).columns == NAMES


def test_flush_operators(target):
    numbered = flush.number_in_order(target, ["_first"], ["a.b"], "n")
    assert numbered.columns == [*NAMES, "n"] and {r.n for r in numbered.collect()} == {1}
    flushed = flush.flush_batches(target, [], ["a.b"], 3)
    assert flushed.columns == [*NAMES, "flush_id"] and sorted(r.flush_id for r in flushed.collect()) == [0, 0, 0, 1]
    timed = target.withColumn("t.s", F.lit("2024-01-01 00:10:00").cast("timestamp_ntz"))
    assert [tuple(r)[2] for r in flush.flush_windows(timed, "t.s", "1 hour", ["a.b"]).collect()] == [1] * 4
