"""What the plans must look like for a cluster: where rows are cut, what is shuffled, what is read."""

import re
from contextlib import contextmanager

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as contract
from bulkapply.operators import changelog, keyed
from bulkapply.plans import queries as registered
from bulkapply.sources import tables
from conftest import SMALL


@contextmanager
def setting(spark, name, value):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange (?:hash|range|Round|Single|SinglePartition)", text))


@pytest.fixture
def large(spark):
    """Plans as for tables too large to broadcast."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        yield


def test_collapse_cuts_before_its_only_shuffle(spark):
    text = plan(contract.queries()["changelog_collapse_lines"](spark, SMALL))
    assert shuffles(text) == 1
    before, after = text.split("Exchange hashpartitioning(l_orderkey", 1)
    assert "Final" in before.rsplit("WindowGroupLimit", 1)[1]
    assert "Partial" in after.split("WindowGroupLimit", 1)[1]


def test_apply_shuffles_target_and_changes_once_each(spark, large):
    lines = registered.line_changes(registered.load(spark, SMALL, "lineitem"))
    text = plan(changelog.apply_changes(lines.drop("_op"), lines, registered.LINE_KEY, ["l_shipdate"]))
    assert shuffles(text) == 2
    assert text.count("FileScan") == 2


def test_small_change_set_leaves_the_target_in_place(spark, folder):
    lines = registered.load(spark, SMALL, "lineitem")
    first = registered.line_changes(lines).filter("l_orderkey < 20")
    settled = changelog.settle(first, registered.LINE_KEY, ["l_shipdate"])
    text = plan(changelog.apply_settled(lines, settled, registered.LINE_KEY))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text
    assert shuffles(text) == 0


@pytest.mark.parametrize("buckets", [4, 32])
def test_keyed_layout_is_read_in_place(spark, folder, large, buckets):
    lines = registered.load(spark, SMALL, "lineitem")
    target = keyed.upsert(lines.limit(0), lines, registered.LINE_KEY, ["l_shipdate"])
    tables.save_keyed(target, "in_place", f"{folder}/t", registered.LINE_KEY, buckets)
    text = plan(keyed.upsert(spark.table("in_place"), lines, registered.LINE_KEY, ["l_shipdate"], buckets))
    assert "Bucketed: true" in text
    table_side = text.split("FullOuter", 1)[1].split("FileScan", 1)[0]
    assert "Exchange" not in table_side
    spark.sql("DROP TABLE in_place")


def test_existence_sends_distinct_keys(spark, large):
    text = plan(contract.queries()["row_exists"](spark, SMALL))
    for exchange in re.findall(r"Exchange hashpartitioning[^\n]*\n([^\n]*)", text):
        assert "HashAggregate" in exchange or "c_name" in exchange
    assert shuffles(text) == 2 and text.count("FileScan") == 2


def test_insert_if_absent_reads_each_side_once(spark, large):
    text = plan(contract.queries()["insert_if_absent"](spark, SMALL))
    assert text.count("FileScan") == 2 and shuffles(text) <= 2 and "Join" not in text


@pytest.mark.parametrize("name", ["upsert_settled", "update_settled"])
def test_settled_rows_leave_the_target_in_place(spark, name):
    target = registered.load(spark, SMALL, "orders")
    rows = target.limit(5).withColumn("_order", F.lit(1))
    settled = keyed.settle_rows(target, rows, ["o_orderkey"], ["_order"])
    if name == "upsert_settled":
        text = plan(keyed.upsert_settled(target, settled, ["o_orderkey"]))
    else:
        text = plan(keyed.update_settled(target, settled, ["o_orderkey"], ["o_orderstatus"]))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_numbering_never_gathers_a_writer(spark, large):
    """Rows meet the written counts per writer and partition without a shuffle by writer."""
    text = plan(contract.queries()["flush_batches"](spark, SMALL))
    alone = re.findall(r"Exchange hashpartitioning\(event_type#\d+, \d+\)[^\n]*\n([^\n]*)", text)
    assert not alone, "the counts are written, so nothing is dealt out by the writer any more"


def test_lookup_prunes_columns(spark):
    text = plan(contract.queries()["lookup_by_key"](spark, SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int>" in text


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_no_python_rows_and_no_cross_joins(spark, name):
    text = plan(contract.queries()[name](spark, SMALL))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups|CartesianProduct|NestedLoop", text)
