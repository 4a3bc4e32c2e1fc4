"""Keyed statements as set operations: upsert, insert-if-absent, delete, update, select and exists by key."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bulkapply.functions.names import column, columns, free, free_each
from bulkapply.operators.changelog import (
    UPSERT,
    ChangelogError,
    asked_keys,
    check_keys,
    conform,
    latest,
    merge,
    with_checked_keys,
    with_target_keys,
    without_keys,
)
from bulkapply.operators.flush import number_in_order, total_order
from bulkapply.storage import materialize


def key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row's key, in key order."""
    check_keys(df, keys)
    return df.select(*columns(keys))


def upsert(
    target: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    buckets: int | None = None,
) -> DataFrame:
    """Insert or replace by key. The last row per key wins and replaces every column; a null key fails the job.

    ``buckets`` as in ``merge``, for a target saved by these keys.
    """
    check_keys(target, keys)
    flag = free(UPSERT, rows.columns, target.columns)
    checked = with_checked_keys(with_target_keys(rows, target, keys), keys, F.lit(True), flag)
    return merge(target, latest(checked, keys, [flag, *sequence_by]), keys, buckets, flag)


def insert_if_absent(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Upsert where every column is part of the key: add the rows the target does not have.

    A table that is all key holds no row twice, so this is a union without repeats: each side is read once, and rows are
    made distinct inside each task before they are shuffled.
    """
    keys = target.columns
    check_keys(target, keys)
    new = conform(with_target_keys(rows, target, keys), target)
    flag = free("_keyed", new.columns)
    new = with_checked_keys(new, keys, F.lit(True), flag).filter(column(flag)).drop(flag)
    return target.unionByName(new).distinct()


def insert_settled(target: DataFrame, settled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the rows of ``settle_rows`` whose key the target does not hold: few rows, and a target that is not shuffled.

    The target is read for the keys that it has of the few, and these are then taken out of the few.
    """
    check_keys(target, keys)
    for key in keys:
        if settled.schema[key].dataType != target.schema[key].dataType:
            raise ChangelogError(f"key column {key} was settled in another type than the target's")
    asked = settled.select(*columns(keys))
    held = materialize(target.select(*columns(keys)).join(asked, list(keys), "left_semi").distinct(), "held-keys")
    return target.unionByName(conform(settled.join(held, list(keys), "left_anti"), target))


def delete_by_key(target: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the rows whose key occurs in ``keyed``. A null in a key equals nothing, so it deletes nothing."""
    check_keys(target, keys)
    return without_keys(target, keyed, keys)


def update_by_key(
    target: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    changed: Sequence[str],
    sequence_by: Sequence[str],
) -> DataFrame:
    """Set the columns ``changed`` from the last row per key where the key exists; insert nothing. A null key matches nothing."""
    check_keys(target, keys)
    new, matched = free_each("_new_", changed, target.columns), free("_matched", target.columns)
    joined = target.join(_replacements(target, rows, keys, new, matched, sequence_by), list(keys), "left")
    return joined.select(
        *[
            F.when(column(matched), column(new[c])).otherwise(column(c)).alias(c) if c in new else column(c)
            for c in target.columns
        ]
    )


def update_settled(target: DataFrame, settled: DataFrame, keys: Sequence[str], changed: Sequence[str]) -> DataFrame:
    """``update_by_key`` with the result of ``settle_rows``: few rows, and a target that is then not shuffled."""
    check_keys(target, keys)
    return update_by_key(target, settled, keys, changed, [])


def settle_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str], sequence_by: Sequence[str]) -> DataFrame:
    """The last row per key, keys in the target's types, written to the shared folder; for ``upsert_settled`` and
    ``update_settled``. A null key fails the job.

    Spark knows the size of what is written: below ``spark.sql.autoBroadcastJoinThreshold`` it broadcasts it and leaves the
    target where it is, above it shuffles both.
    """
    check_keys(target, keys)
    flag = free(UPSERT, rows.columns)
    checked = with_checked_keys(with_target_keys(rows, target, keys), keys, F.lit(True), flag)
    return materialize(latest(checked, keys, [flag, *sequence_by]).drop(flag), "settled")


def upsert_settled(target: DataFrame, settled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``upsert`` with the result of ``settle_rows``."""
    check_keys(target, keys)
    for key in keys:
        if settled.schema[key].dataType != target.schema[key].dataType:
            raise ChangelogError(f"key column {key} was settled in another type than the target's")
    return without_keys(target, settled, keys).unionByName(conform(settled, target))


def _replacements(
    target: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    new: dict[str, str],
    matched: str,
    sequence_by: Sequence[str],
) -> DataFrame:
    """The last row per key that the target can hold: its keys, the new values under the names in ``new``, and a mark."""
    asked = dict(zip(keys, asked_keys(rows, target, keys)))
    wanted = list(dict.fromkeys([*keys, *new, *sequence_by]))
    matching = rows.select(*[asked[c] if c in asked else column(c) for c in wanted])
    for key in keys:
        matching = matching.filter(column(key).isNotNull())
    last = conform(latest(matching, keys, sequence_by), target, [*keys, *new])
    return last.select(*columns(keys), *[column(c).alias(name) for c, name in new.items()], F.lit(True).alias(matched))


def lookup_by_key(
    target: DataFrame, keyed: DataFrame | None, keys: Sequence[str], chosen: Sequence[str]
) -> DataFrame:
    """The columns ``chosen`` of the target rows whose key occurs in ``keyed``; without conditions, of every row.

    ``keyed`` is reduced to distinct keys. Spark broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffles by key beyond.
    """
    if keyed is None or not keys:
        return target.select(*columns(chosen))
    wanted = keyed.select(*asked_keys(keyed, target, keys)).distinct()
    return target.join(wanted, list(keys), "left_semi").select(*columns(chosen))


def row_exists(keyed: DataFrame, target: DataFrame, keys: Sequence[str], name: str = "row_exists") -> DataFrame:
    """Each row of ``keyed`` with a flag: does the target hold its key?

    The target's keys are made distinct inside each task before they travel, so a hot key sends one row per task. The rows
    asked for come back as they are; a key that the target's type cannot hold does not exist.
    """
    check_keys(target, keys)
    asked_as = free_each("_asked_", keys, keyed.columns)
    held_as = free_each("_held_", keys, keyed.columns, asked_as.values())
    found = free("_found", keyed.columns, asked_as.values(), held_as.values())
    held = target.select(*[column(k).alias(held_as[k]) for k in keys]).distinct().withColumn(found, F.lit(True))
    asked = keyed.withColumns({asked_as[k]: c for k, c in zip(keys, asked_keys(keyed, target, keys))})
    same = F.lit(True)
    for k in keys:
        same = same & (column(asked_as[k]) == column(held_as[k]))
    exists = F.coalesce(column(found), F.lit(False)).alias(name)
    return asked.join(held, same, "left").select(*columns(keyed.columns), exists)


# How many rows are drawn to guess where the first n rows end.
_SAMPLE = 100_000


def limit_rows(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in the given order; ties are settled by the remaining columns.

    A sorted sample gives a row that at least ``n`` rows should not lie behind. The rows up to it are written and counted; if
    they are enough, only they are range-sorted and numbered, else a larger part or in the end the whole table is. Nothing is gathered
    in one task, whatever ``n`` is.
    """
    if n < 0:
        raise ValueError("limit must not be negative")
    number = free("_number", df.columns)
    first = number_in_order(_rows_up_to(df, n, order_by), [], order_by, number, most=n)
    return first.filter(column(number) <= n).drop(number)


def _rows_up_to(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """At least the first ``n`` rows of ``df``, and hardly more."""
    total = df.count()
    fraction = min(1.0, _SAMPLE / max(1, total))
    order = F.struct(*columns(total_order(df, order_by, [])))
    drawn = n * fraction
    for slack in (5, 50):
        rank = math.ceil(drawn + slack * math.sqrt(drawn) + slack)
        if rank >= total * fraction / 2:
            break
        sample = df.sample(fraction, seed=11) if fraction < 1 else df
        bound = sample.select(order.alias("bound")).orderBy("bound").limit(rank).agg(F.max("bound"))
        # Looked up once as a scalar subquery, whatever its type; nulls come first in both orders.
        found = materialize(df.where(order <= bound.scalar()), "first-rows")
        if found.count() >= n:
            return found
    return df
