import numpy as np
import pytest
from pyspark.sql import functions as F

from bulkapply.llm import queries, url_filters
from bulkapply.llm.oracles import oracle_sql
from compare import assert_same, connection
from conftest import CHECKED

URLS = [
    None, "", "no scheme/en/", "http://A.example.COM/en/x?q", "https://www.example.com/en/", "http://www.example.com", "ftp://net/fr/a#b",
    "http://x.y.net/es/", "http://annet/es/", "http://com", "http://com/", "http://a://b/en/", "http://É.net/fr/?", "http://h\nx.org/p",
    "http://h.org/EN/?a://b", "://", "http:///only/path",
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, None, "x", True) for i, u in enumerate(URLS)] + [(None, "http://h.org/a", None, "y", False)] * 2
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, listed boolean")


def test_rules_and_lists_as_sql(spark, pages, tmp_path):
    pages.drop("host", "listed").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert_same(queries.op2_url_filters(spark, str(tmp_path)), con, oracle_sql()["op2_url_filters"])


def test_query_as_sql(spark):
    assert_same(queries.op2_url_filters(spark, CHECKED), connection(CHECKED), oracle_sql()["op2_url_filters"])


def test_cascade_is_exact():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, (2, 40_000)).astype(np.uint64)
    for n in (0, 1, 500, 39_999, 40_000):
        levels = url_filters.build_cascade((keys[0, :n], keys[1, :n]), (keys[0, n:], keys[1, n:]))
        assert (url_filters.in_cascade(levels, *keys) == (np.arange(40_000) < n)).all()
        assert n not in (500,) or sum(map(len, levels)) < 4 * n


def test_keys_with_equal_hashes_are_refused():
    same = np.array([1], np.uint64)
    with pytest.raises(ValueError, match="same hashes"):
        url_filters.build_cascade((same, same), (same, same))


def test_keys_equal_in_one_hash_are_told_apart(spark, monkeypatch):
    keys = spark.range(40).select(F.concat(F.lit("h.org/"), "id").alias("key"))
    pages = keys.select(F.lit(1).alias("page_id"), F.concat(F.lit("http://"), "key").alias("url"))
    listed = keys.where("key like '%3'")
    monkeypatch.setattr(url_filters.F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    found = url_filters.judge(pages, [], listed)
    assert found.count() == 40 and found.where("listed != (path like '%3')").isEmpty()
    monkeypatch.setattr(url_filters.F, "md5", lambda column: F.lit("0" * 32))
    with pytest.raises(Exception, match="same hashes"):
        url_filters.cascades(keys, listed)


def test_with_and_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(url_filters, "SHARD_KEYS", 50)
    pages = spark.range(600).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.org/"), F.expr("id % 400")).alias("url"))
    listed = spark.range(0, 500, 3).select(F.concat(F.lit("h.org/"), "id").alias("key"))
    one = url_filters.judge(pages, [], listed)
    two = url_filters.judge(pages, [], listed, broadcast_bytes=0)
    assert one.exceptAll(two).isEmpty() and two.count() == 600
    assert one.where((F.expr("page_id % 400 % 3 = 0")) != F.col("listed")).isEmpty()


def test_empty_tables(spark, pages):
    assert url_filters.judge(pages.limit(0), queries.RULES, pages.select(F.col("url").alias("key")).limit(0)).count() == 0
    found = url_filters.judge(pages, [], pages.select(F.col("url").alias("key")).limit(0))
    assert found.where("verdict <> 'allow'").isEmpty() and found.count() == pages.count()
