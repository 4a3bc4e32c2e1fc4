"""Column names as they are: quoted where an expression would read a dot in them, and free where a helper column is added."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """The column of exactly this name."""
    return F.col(quoted(name))


def columns(names: Iterable[str]) -> list[Column]:
    return [column(name) for name in names]


def free(wanted: str, *taken: Iterable[str]) -> str:
    """``wanted``, with underscores added until none of the names in ``taken`` is equal to it in any case."""
    used = {name.lower() for names in taken for name in names}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def free_each(prefix: str, names: Iterable[str], *taken: Iterable[str]) -> dict[str, str]:
    """A free name for each of ``names``, none equal to another."""
    found: dict[str, str] = {}
    for name in names:
        found[name] = free(prefix + name, found.values(), *taken)
    return found
