import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from bulkapply.operators import flush


def brute(data, size):
    by_writer = defaultdict(list)
    for w, s in data:
        by_writer[w].append(s)
    return sorted(
        (str(w), s, n // size) for w, seqs in by_writer.items() for n, s in enumerate(sorted(seqs))
    )


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_hot_and_null_writers(spark, size):
    dice = random.Random(size)
    data = [(None if dice.random() < 0.1 else 1 if dice.random() < 0.4 else dice.randrange(40), s) for s in range(3000)]
    dice.shuffle(data)
    df = spark.createDataFrame(data, "w int, seq int").repartition(8)
    got = flush.flush_batches(df, ["w"], ["seq"], size)
    assert got.columns == ["w", "seq", "flush_id"]
    assert sorted((str(r["w"]), r["seq"], r["flush_id"]) for r in got.collect()) == brute(data, size)


def test_one_writer_spans_partitions(spark):
    df = spark.range(0, 20000, numPartitions=8).withColumn("w", F.lit("only"))
    got = flush.flush_batches(df, ["w"], ["id"], 3000)
    assert got.filter("flush_id != id div 3000").count() == 0
    sizes = {r["flush_id"]: r["count"] for r in got.groupBy("flush_id").count().collect()}
    assert sizes == {0: 3000, 1: 3000, 2: 3000, 3: 3000, 4: 3000, 5: 3000, 6: 2000}


def test_no_writer_column_numbers_everything(spark):
    df = spark.range(0, 5000, numPartitions=5)
    assert flush.number_in_order(df, [], ["id"], "n").filter("n != id + 1").count() == 0


def test_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        flush.flush_batches(spark.range(1), [], ["id"], 0)


def test_distinct_keys(spark):
    df = spark.createDataFrame([(0, "a"), (0, "A"), (1, "a"), (0, "b")], "f int, k string")
    got = flush.distinct_keys(df, ["f"], {"key": F.lower("k")})
    assert sorted(map(tuple, got.collect())) == [(0, "a"), (0, "b"), (1, "a")]


def test_windows(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:04.999' AS t UNION ALL SELECT timestamp_ntz'2024-01-01 00:00:05'")
    got = {str(r["flush_start"]): r["n_rows"] for r in flush.flush_windows(df, "t", "5 seconds").collect()}
    assert got == {"2024-01-01 00:00:00": 1, "2024-01-01 00:00:05": 1}
