"""Byte n-gram features of whole texts, made with numpy inside tasks."""

from __future__ import annotations

import numpy as np


def codes(text: bytes, n: int) -> np.ndarray:
    """The ``n``-grams of the bytes of a text as numbers below 256 ** n."""
    each = np.frombuffer(text, np.uint8).astype(np.int32)
    out = each[: max(0, len(each) - n + 1)]
    for i in range(1, n):
        out = out << 8 | each[i : len(each) - n + 1 + i]
    return out


def hashed_counts(text: bytes, dims_log2: int) -> np.ndarray:
    """How often each hashed byte trigram occurs."""
    mixed = codes(text, 3).astype(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(32 - dims_log2)
    return np.bincount(mixed, minlength=1 << dims_log2)
