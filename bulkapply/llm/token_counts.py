"""Token counts that follow edits: a segment tree per document, re-encoding only what an edit touches.

A text is cut into segments before spaces that follow a visible character. There a pre-token always ends, whatever stands on
either side, so a text's tokens are the sum over its segments. The leaves of a document's tree hold the
characters and tokens of its segments, inner nodes the sums. An edit descends to the segments it touches, takes in the
neighbours whose boundary it may have changed, encodes that region alone, and updates the sums on the way up.

The tokenizer is a public byte-level vocabulary in a file named by a parameter; the driver reads it and broadcasts its
ranks, about a megabyte. Nothing is shuffled; trees and counts are made where the text is.

Defined cases: a null text is empty and has no tokens; null edits are none. Edits name characters of the text before any of them
is made; they are applied in order, an edit beyond the end is cut to it, and one that overlaps an earlier one is an error. Rows
are treated each on its own, so repeated rows and null ids need no care. Only the columns named are read and written.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkapply.llm.common import in_arrow

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern that belongs to this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEGMENT = 384
_CUT = re.compile(r"(?<=\S) ")


def cut(text: str, least: int = SEGMENT) -> list[str]:
    """Segments of at least ``least`` characters but the last; ``[""]`` for an empty text."""
    out, begin = [], 0
    while found := _CUT.search(text, begin + least):
        out.append(text[begin : found.start()])
        begin = found.start()
    out.append(text[begin:])
    return out


class Tree:
    """Sums of characters and tokens over the segments of a text; node 1 is the root, leaves start at ``size``."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.size = len(chars) // 2

    @classmethod
    def of(cls, segments: list[str], count: Callable[[str], int]) -> Tree:
        size = 1 << max(0, len(segments) - 1).bit_length()
        chars, tokens = np.zeros(2 * size, np.int64), np.zeros(2 * size, np.int64)
        chars[size : size + len(segments)] = [len(s) for s in segments]
        tokens[size : size + len(segments)] = [count(s) for s in segments]
        tree = cls(chars, tokens)
        for node in range(size - 1, 0, -1):
            tree._add(node)
        return tree

    def _add(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at``, or the last one that holds any, and where it starts."""
        node, start = 1, 0
        at = min(at, max(0, int(self.chars[1]) - 1))
        while node < self.size:
            node *= 2
            if at - start >= self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node, start

    def put(self, first: int, segments: list[str], counts: list[int]) -> None:
        """New contents for the leaves from ``first`` on, and the sums above them."""
        for i, (segment, n) in enumerate(zip(segments, counts)):
            self.chars[first + i], self.tokens[first + i] = len(segment), n
        low, high = first // 2, (first + len(segments) - 1) // 2
        while low:
            for node in range(low, high + 1):
                self._add(node)
            low, high = low // 2, high // 2

    def edit(self, text: str, start: int, stop: int, replacement: str, count: Callable[[str], int]) -> tuple[str, int]:
        """The edited text, and how many characters were encoded anew."""
        total = len(text)
        start, stop = min(start, total), min(max(start, stop), total)
        first, begin = self.find(start)
        if start == begin and begin:
            # The space in front of this segment may go: its boundary is in question.
            first, begin = self.find(begin - 1)
        last, at = self.find(max(start, stop - 1))
        end = at + int(self.chars[last])
        region = text[begin:start] + replacement + text[stop:end]
        # A segment must end in a visible character for the next one to stand alone.
        while end < total and (not region or region[-1].isspace()):
            last, _ = self.find(end)
            further = end + int(self.chars[last])
            region += text[end:further]
            end = further
        room = last - first + 1
        segments = cut(region)
        segments = [*segments[: room - 1], "".join(segments[room - 1 :])]
        segments += [""] * (room - len(segments))
        self.put(first, segments, [count(s) for s in segments])
        return text[:start] + replacement + text[stop:], len(region)


def _counter(ranks: dict[bytes, int], pattern: str) -> Callable[[str], int]:
    import tiktoken

    encoding = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


def vocabulary(spark: SparkSession, path: str = VOCABULARY):
    """The ranks of a vocabulary file, broadcast."""
    with open(path, "rb") as lines:
        return spark.sparkContext.broadcast({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


def build(docs: DataFrame, ranks, pattern: str = PATTERN) -> DataFrame:
    """``doc_id, text, edits`` of ``docs`` with ``chars`` and ``tokens``, the nodes of each document's tree."""

    def index(batches):
        count = _counter(ranks.value, pattern)
        for batch in batches:
            trees = [Tree.of(cut(text or ""), count) for text in batch.column(1).to_pylist()]
            yield [*batch.columns, [t.chars for t in trees], [t.tokens for t in trees]]

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "edits"), index, f"{_DOC}, {_TREE}")


def apply_edits(indexed: DataFrame, ranks, pattern: str = PATTERN) -> DataFrame:
    """The edited texts with their updated trees, token counts before and after, and what was encoded anew."""

    def change(batches):
        count = _counter(ranks.value, pattern)
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for doc_id, text, edits, chars, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                tree = Tree(np.array(chars, np.int64), np.array(tokens, np.int64))
                now, again, before, reached = text or "", 0, int(tree.tokens[1]), None
                edits = sorted(edits or [], key=lambda e: (e["start"], e["stop"]))
                # From the end backwards, so the places of the others stay as they are named.
                for edit in reversed(edits):
                    if reached is not None and edit["stop"] > reached:
                        raise ValueError(f"edits of document {doc_id} overlap at {edit['stop']}")
                    reached = edit["start"]
                    now, more = tree.edit(now, edit["start"], edit["stop"], edit["replacement"], count)
                    again += more
                row = (doc_id, now, before, int(tree.tokens[1]), len(edits), len(text or ""), again, tree.chars, tree.tokens)
                for column, value in zip(out, row):
                    column.append(value)
            yield out

    return in_arrow(
        indexed, change,
        f"doc_id long, text string, tokens_before long, tokens_after long, n_edits long, n_chars long, chars_encoded long, {_TREE}")


_DOC = "doc_id long, text string, edits array<struct<start: int, stop: int, replacement: string>>"
_TREE = "chars array<long>, tokens array<long>"
# What is taken out of texts before training, and what stands in its place.
_MAIL = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+")
_NUMBER = re.compile(r"\+?\(?\d[\d ()-]{7,}\d")


def redactions(text: Column) -> Column:
    """Edits that replace mail addresses and long numbers."""

    @F.pandas_udf("array<struct<start: int, stop: int, replacement: string>>")
    def found(texts):
        import pandas as pd

        out = []
        for each in texts:
            each = each or ""
            edits = [(m.start(), m.end(), "[mail]") for m in _MAIL.finditer(each)] if "@" in each else []
            taken = [range(a, b) for a, b, _ in edits]
            edits += [(m.start(), m.end(), "[number]") for m in _NUMBER.finditer(each)
                      if not any(m.start() < r.stop and r.start < m.end() for r in taken)]
            out.append([{"start": a, "stop": b, "replacement": r} for a, b, r in sorted(edits)])
        return pd.Series(out)

    return found(text)


def recount(docs: DataFrame, edits: Column, path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Trees of all of ``docs``, then the counts that follow ``edits``, a column of them."""
    ranks = vocabulary(docs.sparkSession, path)
    return apply_edits(build(docs.select("doc_id", "text", edits.alias("edits")), ranks, pattern), ranks, pattern)
