"""What several of the operators share: words, held-out rows, and joins on keys that may be hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word: anything but the blanks space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
# A key is hot when it holds more than this share of the rows, so there are at most a thousand of them.
HOT_SHARE = 0.001
# Lists of at most this many keys (16 bytes each) are broadcast; longer ones are joined by a shuffle.
BROADCAST_KEYS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; none for a null text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id written as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held_out(doc_id: Column, folds: int, fold_no: int) -> Column:
    """Whether a document is held out; one without an id never is."""
    return F.coalesce(fold(doc_id, folds) == fold_no, F.lit(False))


def join_counted(rows: DataFrame, keyed: DataFrame, key: str, count: str, how: str = "left") -> DataFrame:
    """Join ``rows`` with ``keyed``, which has one row per key and how many of ``rows`` have it in column ``count``.

    Keys with more than ``HOT_SHARE`` of all rows are joined by a broadcast of at most ``1 / HOT_SHARE`` rows, so no task
    gathers a hot key; the others go through an ordinary join. ``keyed`` should be a written table, as it is read thrice.
    """
    total = keyed.agg(F.sum(count)).first()[0] or 0
    hot = keyed.where(F.col(count) > total * HOT_SHARE)
    cold = keyed.where(F.col(count) <= total * HOT_SHARE)
    known = rows.join(F.broadcast(hot.select(key, F.lit(True).alias("_is_hot"))), key, "left")
    on_hot = known.where("_is_hot").drop("_is_hot").join(F.broadcast(hot.drop(count)), key, "inner")
    on_cold = known.where("_is_hot is null").drop("_is_hot").join(cold.drop(count), key, how)
    return on_hot.unionByName(on_cold)


def restrict(rows: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """``rows`` with (``left_semi``) or without (``left_anti``) a match in ``keys``, a written table; nulls match nulls.

    Texts stay where they are as long as the keys are few enough to broadcast, which is counted first.
    """
    keys = keys.select(*(F.col(c).alias(f"_key_{i}") for i, c in enumerate(on)))
    same = F.lit(True)
    for i, c in enumerate(on):
        same = same & rows[c].eqNullSafe(keys[f"_key_{i}"])
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if few else keys, same, how)


def in_arrow(rows: DataFrame, function, schema: str) -> DataFrame:
    """Stream the partitions of ``rows`` through ``function``, an iterator of Arrow batches to an iterator of lists of columns."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        import pyarrow as pa

        for columns in function(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)
