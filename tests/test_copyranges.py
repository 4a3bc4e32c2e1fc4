"""COPY files cut into byte ranges: every cut gives what one task for the whole file gives."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from bulkapply.sources import copyfiles, copyranges
from test_plans import setting

SCHEMA = "id int, text string, raw binary, more string"


def written(spark, folder, rows, n_files=1):
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1).repartition(n_files) if n_files > 1 else spark.createDataFrame(rows, SCHEMA).coalesce(1)
    copyfiles.write_copy_files(df, f"{folder}/copy")
    assert len(glob.glob(f"{folder}/copy/*.txt")) == n_files
    return df


def as_set(df):
    return sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in row) for row in df.collect()), key=str)


def odd_texts(rng, n):
    parts = ['"', '""', "\n", "\n\n", ",", "a", "word", "\r\n", "\r", ' "x" ', "é", "\\x", "\t"]
    for i in range(n):
        text = rng.choice([None, "", '"', "\n", "".join(rng.choices(parts, k=rng.randint(0, 12)))])
        yield i, text, rng.choice([None, b"", b"\x00\xff"]), rng.choice([None, "", "plain", "l1\nl2"])


@pytest.mark.parametrize("size", [1, 7, 16, 33, 100, 5000])
def test_one_file_in_many_ranges(spark, folder, size):
    df = written(spark, folder, list(odd_texts(random.Random(size), 120 if size > 1 else 15)))
    whole = copyfiles.read_copy_files(spark, f"{folder}/copy", df.schema)
    with setting(spark, "spark.sql.files.maxPartitionBytes", str(size)):
        lines = copyranges._lines(spark, f"{folder}/copy")
        assert lines.select("start").distinct().count() > (1 if size < 5000 else 0)
        cut = copyranges.read_copy_ranges(spark, f"{folder}/copy", df.schema)
        assert as_set(cut) == as_set(whole) == as_set(df)
        assert [f.dataType for f in cut.schema.fields] == [f.dataType for f in df.schema.fields]


def test_a_record_over_many_ranges(spark, folder):
    long = "\n".join(f'line "{i}", of one text' for i in range(300))
    df = written(spark, folder, [(1, "before", None, None), (2, long, b"\x01", long), (3, "after\n", None, "")])
    with setting(spark, "spark.sql.files.maxPartitionBytes", "200"):
        assert as_set(copyranges.read_copy_ranges(spark, f"{folder}/copy", df.schema)) == as_set(df)


def test_several_files_packed_into_tasks(spark, folder):
    df = written(spark, folder, list(odd_texts(random.Random(3), 200)), n_files=5)
    for size in ("50", "1000000"):
        with setting(spark, "spark.sql.files.maxPartitionBytes", size):
            assert as_set(copyranges.read_copy_ranges(spark, f"{folder}/copy", df.schema)) == as_set(df)


def test_ranges_share_the_work(spark, folder):
    """Each range is a task of its own, and only pieces of records are shuffled."""
    df = written(spark, folder, [(i, f"text {i}\nof two lines", None, "x" * 50) for i in range(2000)])
    with setting(spark, "spark.sql.files.maxPartitionBytes", "20000"):
        lines = copyranges._lines(spark, f"{folder}/copy")
        assert lines.rdd.getNumPartitions() >= 8
        found = copyranges.ranges(lines).collect()
        assert len(found) == lines.select("start").distinct().count()
        table = {(r.file, r.start): (r.inside, r.began) for r in found}
        pieces = lines.mapInArrow(lambda b: copyranges._cut(b, table, True), "file long, began long, start long, text string")
        assert pieces.count() <= 2 * len(found)
        assert copyranges.read_copy_ranges(spark, f"{folder}/copy", df.schema).count() == 2000


def test_other_ranges_than_counted_end_with_an_error(spark, folder):
    df = written(spark, folder, [(i, "text", None, None) for i in range(100)])
    with setting(spark, "spark.sql.files.maxPartitionBytes", "100"):
        cut = copyranges.read_copy_ranges(spark, f"{folder}/copy", df.schema)
    with setting(spark, "spark.sql.files.maxPartitionBytes", "90"), pytest.raises(Exception, match="other ranges"):
        cut.collect()


def test_rules(spark, folder, monkeypatch):
    df = written(spark, folder, [])
    assert copyranges.read_copy_ranges(spark, f"{folder}/copy", df.schema).count() == 0
    with open(f"{folder}/copy/broken.txt", "w", encoding="utf-8") as file:
        file.write('1,"never closed\n')
    with pytest.raises(ValueError, match="inside quotes"):
        copyranges.read_copy_ranges(spark, f"{folder}/copy", df.schema)
    numbers = spark.range(50).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("n"))
    copyfiles.write_copy_files(numbers, f"{folder}/one")
    assert as_set(copyranges.read_copy_ranges(spark, f"{folder}/one", numbers.schema)) == as_set(numbers)
    good = spark.createDataFrame([(1, "a\nb", None, "")], SCHEMA)
    copyfiles.write_copy_files(good, f"{folder}/few")
    monkeypatch.setattr(copyranges, "RANGES", 0)
    assert as_set(copyranges.read_copy_ranges(spark, f"{folder}/few", good.schema)) == as_set(good)
