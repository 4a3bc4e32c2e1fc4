"""Where intermediate results live: one shared folder, named by the session.

A cluster names the folder in ``spark.checkpoint.dir``. Everything written between two stages goes there, so it survives
the loss of any executor. Only a ``local`` master may fall back to a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_MARK = "_committed"


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder; set for this session only where it is unset and the master is local."""
    root = spark.conf.get(_CONF, None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError(f"set {_CONF} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set(_CONF, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; two calls never return the same one."""
    return f"{shared_dir(spark)}/bulkapply/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete everything ``scratch_path`` handed out in this application; call it when no result is read any more."""
    return delete(spark, f"{shared_dir(spark)}/bulkapply/{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage at a table that outlives executors, and keeps column pruning for the readers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def committed(spark: SparkSession, parent: str, prefix: str) -> dict[int, str]:
    """``{n: path}`` for each ``parent/<prefix><n>`` that ``mark_committed`` marked.

    Lists directory names only: one entry per write, never per row or per data file.
    """
    return {int(name): path for name, path in committed_names(spark, parent, prefix).items()}


def committed_names(spark: SparkSession, parent: str, prefix: str) -> dict[str, str]:
    """The same by what follows the prefix, whatever it is."""
    fs, _ = _hadoop(spark, parent)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{parent}/{prefix}*/{_MARK}"))
    paths = [status.getPath().getParent() for status in (found or [])]
    return {p.getName()[len(prefix):]: p.toString() for p in paths}


def mark_committed(spark: SparkSession, path: str, text: str = "") -> None:
    """Mark a folder as completely written; committers need not leave a marker of their own. ``text`` is kept in the mark."""
    fs, _ = _hadoop(spark, path)
    out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_MARK}"), True)
    out.write(bytearray(text.encode()))
    out.close()


def mark_of(spark: SparkSession, path: str) -> str:
    """What ``mark_committed`` kept."""
    return read_text(spark, f"{path}/{_MARK}")


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet, so of two writers one fails."""
    fs, jpath = _hadoop(spark, path)
    out = fs.create(jpath, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's content."""
    fs, jpath = _hadoop(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def names_in(spark: SparkSession, parent: str) -> list[str]:
    """Names of the files and folders directly in a folder; none if it does not exist."""
    fs, jpath = _hadoop(spark, parent)
    return [status.getPath().getName() for status in fs.listStatus(jpath)] if fs.exists(jpath) else []


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path."""
    fs, jpath = _hadoop(spark, path)
    return fs.getContentSummary(jpath).getLength()


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop(spark, path)
    return fs.exists(jpath)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop(spark, path)
    return fs.getFileStatus(jpath).isDirectory()


def delete(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop(spark, path)
    return fs.delete(jpath, True)
