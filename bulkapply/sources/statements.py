"""SQL text for a PostgreSQL-family target. Names are not quoted, so the target folds them as it does its own."""

from __future__ import annotations

from collections.abc import Sequence


def _matching(left: str, right: str, keys: Sequence[str]) -> str:
    return " AND ".join(f"{left}.{k} = {right}.{k}" for k in keys)


def on_conflict(columns: Sequence[str], keys: Sequence[str]) -> str:
    """What happens to a row whose key is there: replace every other column, or nothing if there is none."""
    replaced = ", ".join(f"{c}=EXCLUDED.{c}" for c in columns if c not in keys)
    return f" ON CONFLICT ({', '.join(keys)}) DO " + (f"UPDATE SET {replaced}" if replaced else "NOTHING")


def insert_staged(table: str, stage: str, columns: Sequence[str], where: str = "") -> str:
    names = ", ".join(columns)
    return f"INSERT INTO {table}({names}) SELECT {names} FROM {stage}" + (f" WHERE {where}" if where else "")


def upsert_staged(table: str, stage: str, columns: Sequence[str], keys: Sequence[str], where: str = "true") -> str:
    return insert_staged(table, stage, columns, where) + on_conflict(columns, keys)


def delete_staged(table: str, stage: str, keys: Sequence[str], where: str = "") -> str:
    matched = _matching(table, stage, keys)
    return f"DELETE FROM {table} USING {stage} WHERE {matched}" + (f" AND {where}" if where else "")


def drop(table: str) -> str:
    return f"DROP TABLE IF EXISTS {table}"
