"""Parquet targets: append, append with a chosen number of writers, and a keyed layout that upserts without a shuffle."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkapply.functions.convert import to_sql_types
from bulkapply.functions.names import column, columns, free, free_each, quoted
from bulkapply.options import SinkOptions
from bulkapply.storage import materialize


def append(df: DataFrame, path: str, options: SinkOptions = SinkOptions()) -> None:
    """Append rows, duplicates included. The files of a job become visible together."""
    rows = to_sql_types(df, instants=True)
    if options.parallelism is not None:
        rows = rows.repartition(options.parallelism)
    rows.write.mode("append").parquet(path)


def append_by_writer(df: DataFrame, path: str, writer: str) -> None:
    """Append into one folder per writer.

    The rebalance hint brings a writer's rows together, but adaptive execution splits a writer that is too large for one
    task over several files, and joins small ones.
    """
    to_sql_types(df, instants=True).hint("rebalance", writer).write.mode("append").partitionBy(writer).parquet(path)


# Keys with more than this part of a writer's fair share are placed one by one; the others in so many groups per writer.
_HEAVY, _SLOTS = 0.1, 16


def writer_of_keys(df: DataFrame, keys: Sequence[str], n_writers: int, name: str = "writer") -> DataFrame:
    """Each row with the number of its key's writer: one writer per key, and writers as even as the keys allow.

    Keys are counted. Heavy ones, at most ``n_writers / _HEAVY``, are packed one after another onto the writer with the fewest rows,
    the heaviest first; then the groups into which the hash deals all other keys, ``_SLOTS`` for each writer. The driver
    sees a row for each of these and no more.
    """
    if n_writers <= 0:
        raise ValueError("need at least one writer")
    n_rows, slot, writer = free("_n_rows", keys), free("_slot", df.columns), free("_writer", df.columns)
    by_hash = F.pmod(F.hash(*columns(keys)), F.lit(n_writers * _SLOTS))
    counted = materialize(df.groupBy(*columns(keys)).agg(F.count(F.lit(1)).alias(n_rows)), "key-counts")
    total = counted.agg(F.sum(column(n_rows))).first()[0] or 0
    heavy = column(n_rows) > max(1.0, total / n_writers * _HEAVY)
    lone = sorted(counted.where(heavy).collect(), key=lambda r: (-r[n_rows], str(r)))
    slots = counted.where(~heavy).groupBy(by_hash.alias(slot)).agg(F.sum(column(n_rows)).alias(n_rows)).collect()
    loads = [(0, w) for w in range(n_writers)]

    def least_loaded(more: int) -> int:
        load, w = heapq.heappop(loads)
        heapq.heappush(loads, (load + more, w))
        return w

    of_keys = [(*(row[k] for k in keys), least_loaded(row[n_rows])) for row in lone]
    of_slots = [(row[slot], least_loaded(row[n_rows])) for row in sorted(slots, key=lambda r: (-r[n_rows], r[slot]))]
    spark, heavy_as = df.sparkSession, free_each("_heavy_", keys, df.columns, [writer, slot])
    own, dealt = free("_own", df.columns, heavy_as.values()), free("_dealt", df.columns, heavy_as.values())
    schema = T.StructType([*(T.StructField(heavy_as[k], df.schema[k].dataType) for k in keys), T.StructField(own, T.IntegerType())])
    same = F.lit(True)
    for k in keys:
        same = same & column(k).eqNullSafe(column(heavy_as[k]))
    rows = df.withColumn(slot, by_hash).join(F.broadcast(spark.createDataFrame(of_keys, schema)), same, "left")
    rows = rows.join(F.broadcast(spark.createDataFrame(of_slots, f"{slot} int, {dealt} int")), slot, "left")
    return rows.select(*columns(df.columns), F.coalesce(column(own), column(dealt)).alias(name))


def append_keyed(df: DataFrame, path: str, keys: Sequence[str], n_writers: int, name: str = "writer") -> None:
    """Append with one task per writer and one writer per key, into a folder per writer."""
    rows = writer_of_keys(to_sql_types(df, instants=True), keys, n_writers, name)
    rows.repartitionById(n_writers, column(name)).write.mode("append").partitionBy(name).parquet(path)


def save_keyed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Save a keyed table bucketed and sorted by its key, as an external table of the session's catalog.

    Later joins on the key read it in place: an upsert then shuffles the changes, never the table.
    """
    (
        to_sql_types(df, instants=True)
        .repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )


def write_bucketed(rows: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write rows bucketed and sorted by key, as an external table of the session's catalog; columns stay as they are."""
    (
        rows.repartition(buckets, *columns(keys))
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )


def open_bucketed(
    spark: SparkSession, table: str, path: str, schema: T.StructType, keys: Sequence[str], buckets: int
) -> DataFrame:
    """A table of ``write_bucketed``, also in a session that did not write it; only its layout is declared, nothing is read."""
    if not spark.catalog.tableExists(table):
        names = ", ".join(map(quoted, keys))
        declared = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({declared}) USING parquet "
            f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
        )
    return spark.table(table)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
