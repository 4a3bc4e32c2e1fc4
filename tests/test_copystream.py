"""Streams through COPY against a driver that writes journals; the test replays them in the SQL engine of the checks."""

import csv
import io
import os
import subprocess
import sys

import duckdb
import pytest

import txdb
from bulkapply.sources.copyload import CopyStreamWriter, LoadedEpoch
from bulkapply.streaming.sink import feed_name
from conftest import ROOT

DOCUMENTS = "/root/testdata/sf0.001/documents.parquet"
SCRIPT = """
import sys
from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from bulkapply import SinkOptions, TargetSpec
from bulkapply.sources.table_sink import TableSink
from bulkapply.streaming.sink import copy_load_stream
source, checkpoint, retries, declared = sys.argv[1:]
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
         .config("spark.driver.host", "127.0.0.1").config("spark.driver.bindAddress", "127.0.0.1").getOrCreate())
stream = spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", 2).parquet(source)
for start in range(1, 9):
    if declared == "yes":
        sink = TableSink.declare(
            {"url": "jdbc:postgresql://h/d", "table-name": "docs", "sink.use-copy-protocol": "true", "sink.max-retries": retries},
            "doc_id bigint, text string", connect="txdb:connect")
        query = sink.write_stream(stream, checkpoint, available_now=True)
    else:
        options = SinkOptions(bulk=True, max_retries=int(retries), retry_interval=0.1)
        query = copy_load_stream(stream, TargetSpec("docs", ["doc_id", "text"]), "txdb:connect", checkpoint, options, True)
    try:
        query.awaitTermination()
        break
    except StreamingQueryException:
        pass
print("starts", start)
"""


def run(source, folder, checkpoint, retries=0, fail="", declared="no"):
    """How often the query was started until it had read all."""
    paths = os.pathsep.join([ROOT, os.path.join(ROOT, "tests")])
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, source, checkpoint, str(retries), declared], timeout=240, capture_output=True, text=True,
        env={**os.environ, "PYTHONPATH": paths, txdb.FOLDER: folder, txdb.FAIL: fail},
    )
    assert done.returncode == 0, done.stderr[-3000:]
    return int(done.stdout.split("starts ")[1])


def replayed(folder, checkpoint):
    """What the target holds after every transaction of the journal, and how many rows the stage has."""
    con = duckdb.connect()
    con.execute("CREATE TABLE docs (doc_id BIGINT, text VARCHAR)")
    stage = f"docs_load_{feed_name(checkpoint)}"
    for steps in txdb.journal(folder):
        con.execute("BEGIN")
        for statement, text in steps:
            if text is None:
                con.execute(statement)
            elif text:
                assert statement.startswith(f"COPY {stage}")
                con.executemany(f"INSERT INTO {stage} VALUES (?, ?, ?)", list(csv.reader(io.StringIO(text, newline=""))))
        con.execute("COMMIT")
    return sorted(con.execute("SELECT doc_id, text FROM docs").fetchall()), con.execute(f"SELECT count(*) FROM {stage}").fetchone()[0]


@pytest.fixture
def source(spark, folder):
    """Six files, so three epochs of two."""
    spark.read.parquet(DOCUMENTS).select("doc_id", "text").repartition(6).write.parquet(f"{folder}/in")
    os.makedirs(f"{folder}/journal")
    return f"{folder}/in", f"{folder}/journal", f"{folder}/checkpoint"


def documents(spark):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(DOCUMENTS).select("doc_id", "text").collect())


def test_lost_attempts_failed_and_repeated_epochs_leave_each_row_once(spark, source):
    """A task is lost after it sent its rows, one commit is lost, and the next is kept but reported as lost."""
    fail = "after COPY,before INSERT INTO docs(,after INSERT INTO docs("
    assert run(*source, fail=fail) == 3
    rows, staged = replayed(*source[1:])
    assert rows == documents(spark) and staged == 0
    sent = [text for steps in txdb.journal(source[1]) for s, text in steps if text]
    assert len(sent) > 6


def test_a_commit_is_retried_within_its_epoch(spark, source):
    assert run(*source, retries=2, fail="before INSERT INTO docs(,after INSERT INTO docs(") == 1
    assert replayed(*source[1:]) == (documents(spark), 0)


def test_a_declared_sink_streams_and_goes_on_from_its_checkpoint(spark, source):
    assert run(*source, declared="yes") == 1
    spark.createDataFrame([(-1, 'a "quoted"\nline')], "doc_id long, text string").coalesce(1).write.mode("append").parquet(source[0])
    assert run(*source, declared="yes") == 1
    rows, staged = replayed(*source[1:])
    assert rows == sorted([(-1, 'a "quoted"\nline'), *documents(spark)]) and staged == 0
    assert sum(s.startswith("INSERT INTO docs_load_epochs") for steps in txdb.journal(source[1]) for s, _ in steps) == 4


def test_epochs_are_noted_by_the_query_of_their_checkpoint(folder, monkeypatch):
    """A query with a new checkpoint counts from 0 again: another id, so its epochs are shown; the same ones again are not."""
    monkeypatch.setenv(txdb.FOLDER, folder)
    options = {"connect": "txdb:connect", "dbtable": "docs", "columns": "doc_id,text", "batch": "b", "retries": "0", "retry_interval": "1"}
    writer = CopyStreamWriter(options)
    for query, epoch, mark in (("q1", 0, "a"), ("q1", 0, "b"), ("q2", 0, "c"), ("q1", 1, "d"), ("q1", 0, "e")):
        writer.commit([LoadedEpoch(mark, 5, query), None, LoadedEpoch("empty", 0, query)], epoch)
    writer.commit([], 2)
    moved = [s.split("'")[1] for steps in txdb.journal(folder) for s, _ in steps if s.startswith("INSERT INTO docs(")]
    assert moved == ["a", "c", "d"]
