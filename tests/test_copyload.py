"""The COPY data source against a driver that writes files, as no database is started here."""

import glob
import os
import re
import subprocess
import sys

import pyarrow as pa
import pytest

from bulkapply import SinkOptions, TargetSpec
from bulkapply.sources import copyload
from conftest import ROOT

SCRIPT = """
import sys
from pyspark.sql import SparkSession
from bulkapply import TargetSpec
from bulkapply.sources.copyload import copy_load
spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.driver.host", "127.0.0.1").config("spark.driver.bindAddress", "127.0.0.1").getOrCreate())
df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
copy_load(df, TargetSpec("docs", ["doc_id", "text"]), "filedb:connect", "b7")
"""


def load(folder, **env):
    paths = os.pathsep.join([ROOT, os.path.join(ROOT, "tests")])
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], timeout=240, capture_output=True, text=True,
        env={**os.environ, "PYTHONPATH": paths, "FILEDB_FOLDER": folder, **env},
    )
    assert done.returncode == 0, done.stderr[-3000:]
    with open(f"{folder}/statements", encoding="utf-8") as log:
        return log.read().splitlines()


def copied(folder):
    texts = []
    for name in glob.glob(f"{folder}/copied-*"):
        with open(name, encoding="utf-8", newline="") as file:
            texts.append(file.read())
    return texts


def accepted(statements):
    return {int(n) for s in statements if "IN (" in s for n in re.search(r"IN \(([\d, ]+)\)", s)[1].split(",")}


@pytest.mark.parametrize("fail", [False, True])
def test_only_reported_attempts_are_moved(spark, folder, fail):
    statements = load(folder, **({"FILEDB_FAIL_ONCE": "1"} if fail else {}))
    assert statements[:2] == [
        "DROP TABLE IF EXISTS docs_load_b7",
        "CREATE TABLE docs_load_b7 AS SELECT CAST(0 AS BIGINT) AS load_attempt, doc_id, text FROM docs WHERE false",
    ]
    assert statements[-1] == "DROP TABLE IF EXISTS docs_load_b7"
    texts = copied(folder)
    assert len(texts) == (4 if fail else 3)

    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    expected = sorted(f'{r["doc_id"]},"{r["text"].replace(chr(34), chr(34) * 2)}"\n' for r in documents)
    attempts = accepted(statements)
    got = []
    for text in texts:
        attempt = int(text.split(",", 1)[0])
        if attempt in attempts:
            got.append("".join(re.split(rf'^{attempt},(?=\d+,")', text, flags=re.M)))
    assert len(attempts) == 3
    assert sorted("".join(got)) == sorted("".join(expected))


def test_bulk_load_appends_only(spark):
    with pytest.raises(ValueError, match="bulk"):
        copyload.copy_load(spark.range(1), TargetSpec("t", ["id"], ["id"]), "filedb:connect", "1", SinkOptions(bulk=True))


def test_a_failed_load_is_repeated_with_a_fresh_stage(spark, folder):
    """The commit fails once: the stage is dropped and filled anew, and only the second attempt's rows are moved."""
    statements = load(folder, FILEDB_FAIL_STATEMENT="INSERT INTO docs")
    made = [i for i, s in enumerate(statements) if s.startswith("CREATE TABLE docs_load_b7")]
    moved = [i for i, s in enumerate(statements) if s.startswith("INSERT INTO docs")]
    assert len(made) == 2 and len(moved) == 2 and made[0] < moved[0] < made[1] < moved[1]
    assert "DROP TABLE IF EXISTS docs_load_b7" in statements[moved[0]:made[1]]
    first, second = (accepted([statements[i]]) for i in moved)
    assert len(first) == len(second) == 3 and not first & second
    assert len(copied(folder)) == 6


def test_lines_get_their_attempt_in_one_buffer():
    lines = ["1,\"a\nb\"", "", "é,", "x" * 100]
    batches = [pa.record_batch([pa.array(lines)], ["line"]), pa.record_batch([pa.array([], pa.string())], ["line"]),
               pa.record_batch([pa.array(["skip", *lines])], ["line"]).slice(1)]
    for size in (1, 7, 65536, -1):
        reader, text = copyload.LineReader(iter(batches), 17), b""
        while piece := reader.read(size):
            assert size < 0 or len(piece) <= size
            text += piece
        assert text.decode() == "".join(f"17,{line}\n" for line in lines * 2) and reader.rows == 8
