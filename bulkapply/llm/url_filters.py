"""URL verdicts: host and path rules, and exact list membership by a cascade of Bloom filters.

The complete key universe is known: the distinct keys of the table judged and those of the list. Level 0 of a cascade encodes the listed keys;
level 1 the unlisted keys that level 0 lets through, level 2 the listed keys that level 1 lets through, and so on until
nothing passes wrongly. The first level that lacks a key decides, so membership is exact on the universe, and a url is
judged by a few bit tests, without a join to the list.

Keys are spread over shards by hash; each shard of some ``SHARD_KEYS`` distinct keys builds its own cascade in one task. The
shards are bounded and even however hot a host is, since a key counts once. Cascades of up to ``BROADCAST_BYTES`` in
all are broadcast. Beyond that, urls meet their shard's cascade by streaming: cascades are dealt out together with the
salted urls and sorted in front of them.

Keys are compared by two 64-bit hashes; keys that agree in both cannot be told apart and stop the build with an error.

Defined cases: a url without ``://`` and a null url have empty host and path and the empty key. The empty list lets everything
pass. Rows that repeat are judged alike. Only page_id and url are read; other columns may have any name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkapply.llm.common import ascii_lower, in_arrow
from bulkapply.storage import materialize

ALLOW, BLOCK = "allow", "block"
SHARD_KEYS = 100_000
BROADCAST_BYTES = 32_000_000
SALTS = 64
_LEVELS = 64


@dataclass(frozen=True)
class Rule:
    """Fits its host with all subdomains if the path starts with its own."""

    verdict: str
    host: str
    path: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://(.*)\z", 1)
    host = ascii_lower(F.regexp_extract(rest, r"\A([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``; null if none does."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r.host, r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """The bits of each key at a level, by double hashing."""
    with np.errstate(over="ignore"):
        a = (h1 + np.uint64(level) * h2) * np.uint64(0x9E3779B97F4A7C15)
        b = (h2 ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)
        steps = np.arange(hashes, dtype=np.uint64)[:, None]
        return ((a ^ (a >> np.uint64(32))) + steps * b >> np.uint64(16)) % np.uint64(bits)


def _passes(filter_: bytes, h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    bits = np.frombuffer(filter_, np.uint8, offset=1)
    at = _positions(h1, h2, level, 8 * len(bits), filter_[0])
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(axis=0)


def build_cascade(listed: tuple[np.ndarray, np.ndarray], others: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """The levels for keys given by two hashes each: the number of hash functions in a byte, then the bits.

    A level is sized to let some 0.7 keys pass wrongly per key that it encodes, so it is the larger the more keys are outside.
    """
    levels, inside, outside = [], listed, others
    while len(inside[0]):
        if len(levels) == _LEVELS:
            raise ValueError("two keys of a url filter have the same hashes")
        each = max(2.0, 1.44 * math.log2(max(1.0, len(outside[0]) / len(inside[0]) / 0.7)))
        hashes = max(1, round(0.69 * each))
        bits = np.zeros(max(8, math.ceil(len(inside[0]) * each / 8)), np.uint8)
        at = _positions(*inside, len(levels), 8 * len(bits), hashes).reshape(-1)
        np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        levels.append(bytes([hashes]) + bits.tobytes())
        wrong = _passes(levels[-1], *outside, len(levels) - 1)
        inside, outside = (outside[0][wrong], outside[1][wrong]), inside
    return levels


def in_cascade(levels: list[bytes], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key is listed: the number of the first level that lacks it is odd."""
    depth = np.full(len(h1), len(levels))
    open_ = np.arange(len(h1))
    for level, bits in enumerate(levels):
        passed = _passes(bits, h1[open_], h2[open_], level)
        depth[open_[~passed]] = level
        open_ = open_[passed]
    return depth % 2 == 1


def _hashed(keys: DataFrame) -> DataFrame:
    # A seeded xxhash64 would follow the first hash, so the second is the front half of the md5.
    front, back = (F.conv(F.substring(F.md5(F.col("key").cast("binary")), at, 8), 16, 10).cast("long") for at in (1, 9))
    second = F.coalesce(F.call_function("shiftleft", front, F.lit(32)).bitwiseOR(back), F.lit(0).cast("long"))
    return keys.withColumns({"h1": F.xxhash64("key"), "h2": second})


def _shard(n_shards: int) -> Column:
    return F.pmod(F.xxhash64("h1", F.lit("shard")), F.lit(n_shards)).cast("int")


def cascades(universe: DataFrame, listed: DataFrame) -> tuple[DataFrame, int]:
    """``shard, levels`` for the ``key`` columns of both tables, and the number of shards."""
    every = _hashed(universe.select("key", F.lit(0).alias("listed")).union(listed.select("key", F.lit(1).alias("listed"))))
    every = every.groupBy("h1", "h2").agg(
        F.max("listed").alias("listed"), F.min("key").alias("least"), F.max("key").alias("most"))
    clash = F.raise_error(F.lit("different keys have the same hashes")).cast("int")
    every = materialize(every.select(
        "h1", "h2", F.when(F.col("least") != F.col("most"), clash).otherwise(F.col("listed")).alias("listed")), "keys")
    n_shards = every.count() // SHARD_KEYS + 1

    def build(shard: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (shard[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        mine = shard["listed"].to_numpy() == 1
        levels = build_cascade((h1[mine], h2[mine]), (h1[~mine], h2[~mine]))
        return pd.DataFrame({"shard": [shard["shard"].iloc[0]], "levels": [levels]})

    sharded = every.withColumn("shard", _shard(n_shards)).groupBy("shard")
    return materialize(sharded.applyInPandas(build, "shard int, levels array<binary>"), "cascades"), n_shards


def membership(rows: DataFrame, filters: DataFrame, n_shards: int, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows``, which has a ``key``, with ``listed``: whether the filters' list has it."""
    rows = _hashed(rows).withColumn("shard", _shard(n_shards))
    size = filters.select(F.explode("levels").alias("bits")).agg(F.sum(F.length("bits"))).first()[0] or 0
    if size > broadcast_bytes:
        return _streamed(rows, filters)
    known = rows.sparkSession.sparkContext.broadcast({r.shard: [bytes(x) for x in r.levels] for r in filters.collect()})

    @F.pandas_udf("boolean")
    def listed(shard: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.Series:
        out = np.zeros(len(shard), bool)
        a, b = h1.to_numpy(np.int64).view(np.uint64), h2.to_numpy(np.int64).view(np.uint64)
        for number in shard.unique():
            at = np.flatnonzero(shard.to_numpy() == number)
            out[at] = in_cascade(known.value.get(number, []), a[at], b[at])
        return pd.Series(out)

    return rows.withColumn("listed", listed("shard", "h1", "h2")).drop("h1", "h2", "shard")


def _streamed(rows: DataFrame, filters: DataFrame) -> DataFrame:
    """The same without a broadcast: every salted shard is streamed behind its cascade, so a task holds one cascade."""
    carried = F.struct(*(rows[c] for c in rows.columns if c not in ("h1", "h2", "shard")))
    kind = rows.select(carried.alias("x")).schema["x"].dataType.simpleString()
    urls = rows.select(F.col("shard"), F.pmod(F.hash("h1", F.monotonically_increasing_id()), F.lit(SALTS)).alias("salt"),
                       F.lit(None).cast("array<binary>").alias("levels"), "h1", "h2", carried.alias("carried"))
    heads = filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "levels",
                           F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), F.lit(None).cast(kind).alias("carried"))
    dealt = urls.union(heads).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.isnull("levels"))

    def judge(batches):
        levels: list[bytes] = []
        for batch in batches:
            head = batch.column("levels").is_valid().to_numpy(zero_copy_only=False)
            h1, h2 = (batch.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
            edges = [0, *np.flatnonzero(head).tolist(), len(head)]
            for a, b in zip(edges, edges[1:]):
                if a < len(head) and head[a]:
                    levels = batch.column("levels")[a].as_py()
                    a += 1
                if a < b:
                    yield [in_cascade(levels, h1[a:b], h2[a:b]), batch.column("carried")[a:b].cast(batch.column("carried").type)]

    return in_arrow(dealt, judge, f"listed boolean, carried {kind}").select("carried.*", "listed")


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` of every page; ``listed`` has a ``key`` column, host and path together."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("key", F.concat("host", "path"))
    filters, n_shards = cascades(rows.select("key").distinct(), listed)
    found = membership(rows, filters, n_shards, broadcast_bytes).withColumn("by_rule", ruled(F.col("host"), F.col("path"), rules))
    method = F.when(F.col("listed"), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return found.select("page_id", "host", "path", F.col("by_rule.rule").alias("rule"),
                        F.coalesce("by_rule.verdict", method).alias("verdict"), "listed")
