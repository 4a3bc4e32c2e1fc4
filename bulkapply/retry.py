"""Bounded retry of one batch. The retried function must be safe to repeat."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException, PySparkException

from bulkapply.options import SinkOptions


def _raised_by_user(error: Exception) -> bool:
    """Whether ``raise_error`` in a query made it."""
    return isinstance(error, PySparkException) and "USER_RAISED_EXCEPTION" in str(error)


def _cannot_be_planned(error: Exception) -> bool:
    """An error of the query itself; what a data source written in Python raises comes under the same class and is none."""
    return isinstance(error, AnalysisException) and "PYTHON_DATA_SOURCE_ERROR" not in str(error)


def with_retry(attempt: Callable[[], None], options: SinkOptions, sleep: Callable[[float], None] = time.sleep) -> int:
    """Call until it succeeds, at most ``max_retries`` times more; returns the number of calls.

    Waits 0, 1, 2 … retry intervals between calls. The last error is passed on, and one that trying again cannot heal is passed on
    at once: a wrong argument, a query that cannot be planned, or data that the query itself refuses.
    """
    for n in range(options.max_retries + 1):
        try:
            attempt()
            return n + 1
        except Exception as error:
            if n == options.max_retries or isinstance(error, ValueError) or _cannot_be_planned(error) or _raised_by_user(error):
                raise
            sleep(options.retry_interval * n)
    raise AssertionError("unreachable")
