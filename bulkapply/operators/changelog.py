"""Changelog rows: classify, check, keep the last change per key, apply to a target.

A change is a row with a kind column (``+I``, ``-U``, ``+U``, ``-D``). ``+I`` and ``+U`` put the row into the target,
``-U`` and ``-D`` take the row with that key out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkapply.functions.names import column, columns, free, free_each
from bulkapply.storage import materialize

OP = "_op"
UPSERT = "_upsert"
# The four row kinds, by what they do to the target.
UPSERT_KINDS = ("+I", "+U")
DELETE_KINDS = ("-U", "-D")


class ChangelogError(ValueError):
    """A changelog that cannot be applied."""


def is_upsert(op: Column) -> Column:
    """True for kinds that write a row, false for kinds that remove one; any other value fails the job."""
    return (
        F.when(op.isin(*UPSERT_KINDS), F.lit(True))
        .when(op.isin(*DELETE_KINDS), F.lit(False))
        .otherwise(F.raise_error(F.concat(F.lit("unknown row kind: "), F.coalesce(op, F.lit("null")))).cast("boolean"))
    )


def check_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Keys are required, present and of a type whose equality is exact."""
    if not keys:
        raise ChangelogError("updates and deletes need key columns")
    for key in keys:
        if key not in df.columns:
            raise ChangelogError(f"key column {key} is missing")
        if isinstance(df.schema[key].dataType, (T.FloatType, T.DoubleType)):
            raise ChangelogError(f"key column {key} is a floating-point number")


def _any_null(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | column(key).isNull()
    return missing


def with_checked_keys(df: DataFrame, keys: Sequence[str], flag: Column, name: str) -> DataFrame:
    """Add ``flag`` as ``name``; a null key fails the job when the flag is computed, without a job of its own."""
    guard = F.raise_error(F.lit(f"null in key columns {list(keys)}")).cast("boolean")
    return df.withColumn(name, F.when(_any_null(keys), guard).otherwise(flag))


def violations(df: DataFrame, keys: Sequence[str], op_col: str = OP) -> DataFrame:
    """One row counting what would make the changelog unusable. One pass, partial counts before the shuffle."""
    known = F.coalesce(column(op_col).isin(*UPSERT_KINDS, *DELETE_KINDS), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~known).alias("unknown_kind"),
        F.count_if(_any_null(keys)).alias("null_key"),
    )


def check(df: DataFrame, keys: Sequence[str], op_col: str = OP) -> None:
    """Raise if the changelog holds unknown kinds or null keys."""
    check_keys(df, keys)
    found = violations(df, keys, op_col).first()
    if found["unknown_kind"] or found["null_key"]:
        raise ChangelogError(f"{found['unknown_kind']} rows of unknown kind, {found['null_key']} rows with a null key")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """The row per key that is greatest in ``order``, ties settled by the remaining columns.

    Spark plans this as a group limit before the shuffle, so each task sends one row per key however hot the key is.
    The full ordering makes the pick the same when a lost task is run again.
    """
    group = [*within, *keys]
    ties = [c for c in df.columns if c not in group and c not in order]
    window = Window.partitionBy(*columns(group)).orderBy(*[column(c).desc() for c in [*order, *ties]])
    nth = free("_nth", df.columns)
    return df.withColumn(nth, F.row_number().over(window)).filter(column(nth) == 1).drop(nth)


def _flagged_last(
    df: DataFrame, keys: Sequence[str], sequence_by: Sequence[str], op_col: str, flag: str, within: Sequence[str] = ()
) -> DataFrame:
    check_keys(df, keys)
    flagged = with_checked_keys(df, keys, is_upsert(column(op_col)), flag)
    return latest(flagged, keys, [*sequence_by, flag], within)


def collapse(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    op_col: str = OP,
    within: Sequence[str] = (),
) -> DataFrame:
    """Last change per key (per group of ``within``, such as a flush), kind column kept.

    ``sequence_by`` gives the order of changes, which a DataFrame does not have by itself. Where a removal and a write
    carry the same sequence, the write is the later one.
    """
    flag = free(UPSERT, df.columns)
    return _flagged_last(df, keys, sequence_by, op_col, flag, within).drop(flag)


def conform(
    df: DataFrame, target: DataFrame, names: Sequence[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """``df`` with the target's columns (or those named), in its order and of its types; those in ``keep`` stay beside them."""
    names = target.columns if names is None else names
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ChangelogError(f"columns {missing} of the target are missing from the rows")
    return df.select(
        *[
            column(n) if df.schema[n].dataType == target.schema[n].dataType
            else column(n).cast(target.schema[n].dataType).alias(n)
            for n in names
        ],
        *columns(keep),
    )


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _keeps_values_apart(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether casting keeps different values different, or fails the job: no fraction or time is cut off.

    A text is taken as the number that it names, so the texts 5 and 05 name one key of a whole-number target.
    """
    if given == wanted:
        return True
    if isinstance(wanted, T.DecimalType) and isinstance(given, (T.DecimalType, *_WHOLE)):
        return wanted.scale >= (given.scale if isinstance(given, T.DecimalType) else 0)
    if isinstance(wanted, _WHOLE):
        return isinstance(given, (*_WHOLE, T.StringType)) or isinstance(given, T.DecimalType) and given.scale == 0
    if isinstance(wanted, T.StringType):
        return isinstance(given, (T.StringType, T.DateType, *_WHOLE))
    return isinstance(given, T.DateType) and isinstance(wanted, (T.TimestampType, T.TimestampNTZType))


def with_target_keys(rows: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with its keys in the target's types, before any row is chosen by key.

    A cast that could make two keys one, such as 5.2 and 5.4 into a whole number or two times into their day, is refused.
    A whole number too large for the target's type, or a text that is no number, fails the job. Texts that name one number are
    one key of a whole-number target, and the row of the latest is taken.
    """
    check_keys(rows, keys)
    for key in keys:
        given, wanted = rows.schema[key].dataType, target.schema[key].dataType
        if not _keeps_values_apart(given, wanted):
            raise ChangelogError(f"key column {key} is {given.simpleString()}, which {wanted.simpleString()} cannot hold exactly")
    return rows.withColumns({
        k: column(k).cast(target.schema[k].dataType) for k in keys if rows.schema[k].dataType != target.schema[k].dataType
    })


def asked_keys(keyed: DataFrame, target: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The keys of ``keyed`` in the target's types, null where the target can hold no equal value, so 1.5 does not meet 1."""
    asked = []
    for key in keys:
        if key not in keyed.columns:
            raise ChangelogError(f"key column {key} is missing")
        given, wanted = keyed.schema[key].dataType, target.schema[key].dataType
        value = column(key)
        if given != wanted:
            held = value.try_cast(wanted)
            same = F.lit(True) if isinstance(given, T.StringType) else held.try_cast(given) == value
            value = F.when(same, held)
        asked.append(value.alias(key))
    return asked


def without_keys(target: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in ``keyed``. Only the distinct key columns of ``keyed`` travel."""
    touched = keyed.select(*asked_keys(keyed, target, keys)).distinct()
    return target.join(touched, list(keys), "left_anti").select(*columns(target.columns))


def merge(
    target: DataFrame, last: DataFrame, keys: Sequence[str], buckets: int | None = None, flag: str = UPSERT
) -> DataFrame:
    """Target and changes side by side, each read and shuffled once: replaced, removed, added and untouched rows.

    Both sides hold a key once; ``last`` says in the column ``flag``, a name free in both, whether a row is written.
    ``buckets`` is the number of buckets of a target saved by these keys. The changes are then dealt out the same way; left to itself, Spark would shuffle the
    target when it has fewer buckets than there are shuffle partitions.
    """
    given = free_each("_new_", [c for c in target.columns if c not in keys], target.columns, [flag])
    new = conform(last, target, keep=[flag])
    new = new.select(*columns(keys), *[column(c).alias(name) for c, name in given.items()], column(flag))
    if buckets is not None:
        new = new.repartition(buckets, *columns(keys))
    kept = target.join(new, list(keys), "full").filter(F.coalesce(column(flag), F.lit(True)))
    return kept.select(
        *[
            column(c) if c in keys else F.when(column(flag), column(given[c])).otherwise(column(c)).alias(c)
            for c in target.columns
        ]
    )


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    op_col: str = OP,
    buckets: int | None = None,
) -> DataFrame:
    """The target after all changes: untouched rows, plus the last written row of each changed key.

    The form for many changes: nothing is read twice. For few changes and a large target see ``settle``.
    """
    check_keys(target, keys)
    changes = with_target_keys(changes, target, keys)
    flag = free(UPSERT, changes.columns, target.columns)
    return merge(target, _flagged_last(changes, keys, sequence_by, op_col, flag), keys, buckets, flag)


def _check_settled(target: DataFrame, settled: DataFrame, keys: Sequence[str]) -> None:
    for key in keys:
        if settled.schema[key].dataType != target.schema[key].dataType:
            raise ChangelogError(f"key column {key} was settled in another type than the target's")


def settle(changes: DataFrame, keys: Sequence[str], sequence_by: Sequence[str], op_col: str = OP) -> DataFrame:
    """Collapse a changelog and write the result to the shared folder, for ``apply_settled``."""
    return materialize(collapse(changes, keys, sequence_by, op_col), "settled")


def apply_settled(target: DataFrame, settled: DataFrame, keys: Sequence[str], op_col: str = OP) -> DataFrame:
    """``apply_changes`` with the result of ``settle``: the form for few changes on a large target.

    Spark knows the size of the written changes when it plans. Below ``spark.sql.autoBroadcastJoinThreshold`` it
    broadcasts their keys and the target is not shuffled; above, both sides are shuffled by key. The changes must have been
    settled with keys of the target's types, as a cast now could make two of them one.
    """
    check_keys(target, keys)
    _check_settled(target, settled, keys)
    written = conform(settled.filter(is_upsert(column(op_col))), target)
    kept = target.join(conform(settled, target, keys), list(keys), "left_anti").select(*columns(target.columns))
    return kept.unionByName(written)
