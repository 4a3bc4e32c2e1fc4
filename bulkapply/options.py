"""Target description and delivery options, checked when they are made."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields

NONE, AT_LEAST_ONCE, EXACTLY_ONCE = "NONE", "AT_LEAST_ONCE", "EXACTLY_ONCE"

# Option names as users of the table API write them, and the field each one sets.
OPTION_NAMES = {
    "sink.buffer-flush.max-rows": "max_rows",
    "sink.buffer-flush.interval": "interval",
    "sink.max-retries": "max_retries",
    "sink.retry.interval": "retry_interval",
    "sink.delivery-guarantee": "guarantee",
    "sink.parallelism": "parallelism",
    "sink.use-copy-protocol": "bulk",
}
TARGET_NAMES = ("connector", "url", "table-name", "username", "password")

# Duration units, in seconds.
UNITS = {
    "ms": 0.001, "s": 1.0, "sec": 1.0, "second": 1.0, "seconds": 1.0,
    "min": 60.0, "minute": 60.0, "minutes": 60.0, "h": 3600.0, "hour": 3600.0, "hours": 3600.0,
}


def seconds(value: str | int | float) -> float:
    """``'500ms'``, ``'5s'``, ``'1 min'`` or a number of seconds."""
    if isinstance(value, (int, float)):
        return float(value)
    found = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([a-z]+)\s*", value.lower())
    if not found or found[2] not in UNITS:
        raise ValueError(f"not a duration: {value!r}")
    return float(found[1]) * UNITS[found[2]]


@dataclass(frozen=True)
class TargetSpec:
    """One target table. A non-empty ``keys`` switches from append to upsert."""

    table: str
    columns: Sequence[str]
    keys: Sequence[str] = ()

    def __post_init__(self):
        if not self.table:
            raise ValueError("a target needs a table name")
        missing = [k for k in self.keys if k not in self.columns]
        if missing:
            raise ValueError(f"key columns {missing} are not columns of {self.table}")

    @property
    def mode(self) -> str:
        return "upsert" if self.keys else "append"


@dataclass(frozen=True)
class SinkOptions:
    """How rows are delivered.

    ``interval=None`` means as fast as batches arrive; ``parallelism=None`` leaves the number of writers to Spark.
    """

    # The defaults users of the options rely on.
    max_rows: int = 1000
    interval: float | None = 5.0
    max_retries: int = 3
    retry_interval: float = 1.0
    guarantee: str = AT_LEAST_ONCE
    parallelism: int | None = None
    bulk: bool = False
    timestamp_digits: int = field(default=6)

    def __post_init__(self):
        if self.max_rows <= 0:
            raise ValueError("max_rows must be positive")
        if self.interval is not None and self.interval <= 0:
            raise ValueError("interval must be positive, or None for no interval")
        if self.max_retries < 0:
            raise ValueError("max_retries must not be negative")
        if self.retry_interval <= 0:
            raise ValueError("retry_interval must be positive")
        if self.guarantee == EXACTLY_ONCE:
            raise ValueError("a database target cannot be written exactly once; use AT_LEAST_ONCE")
        if self.guarantee not in (NONE, AT_LEAST_ONCE):
            raise ValueError(f"unknown delivery guarantee {self.guarantee!r}")
        if self.parallelism is not None and self.parallelism <= 0:
            raise ValueError("parallelism must be positive")
        if not 0 <= self.timestamp_digits <= 6:
            raise ValueError("timestamp_digits must be between 0 and 6")

    def check_target(self, spec: TargetSpec) -> None:
        if self.bulk and spec.keys:
            raise ValueError(f"bulk load appends; {spec.table} declares the key {list(spec.keys)}")

    @classmethod
    def from_map(cls, options: Mapping[str, object]) -> SinkOptions:
        """Build from table options such as ``{'sink.max-retries': '3'}``; unknown names are refused."""
        unknown = [k for k in options if k not in OPTION_NAMES and k not in TARGET_NAMES]
        if unknown:
            raise ValueError(f"unknown options: {sorted(unknown)}")
        if ("username" in options) != ("password" in options):
            raise ValueError("give both username and password, or neither")
        types = {f.name: f.type for f in fields(cls)}
        values: dict[str, object] = {}
        for name, raw in options.items():
            if name not in OPTION_NAMES:
                continue
            target = OPTION_NAMES[name]
            if target in ("interval", "retry_interval"):
                length = seconds(raw)
                values[target] = None if target == "interval" and length == 0 else length
            elif types[target] == "bool":
                values[target] = str(raw).lower() == "true"
            elif target == "guarantee":
                values[target] = str(raw).upper().replace("-", "_")
            else:
                values[target] = int(raw)
        return cls(**values)
