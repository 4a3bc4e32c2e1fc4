import random
import re

import numpy as np
import pytest

from bulkapply.llm import line_dedup
from cases import documents, none, odd_documents, rows, sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return re.sub(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line).translate(LOWER)


def brute_force(docs):
    """``doc_id, text, n_lines, n_dropped`` of (doc_id, text) rows."""
    holders = {}
    for doc_id, text in docs:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= 20:
                    holders.setdefault(key(line), set()).add(doc_id)
    keeper = {k: max(ids) for k, ids in holders.items() if len(ids) >= 3}
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        stay = [line for line in lines if doc_id is None or keeper.get(key(line), doc_id) == doc_id]
        out.append((doc_id, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def texts(rng, n):
    shared = [sentence(rng, k) for k in (2, 3, 4, 5, 6, 9, 40)] + ["x" * 19, "y" * 20, "é" * 19, "ß" * 20, "İ" + "q" * 19]
    for _ in range(n):
        lines = [rng.choice([str.upper, str.title, str.lower])(rng.choice(shared)) for _ in range(rng.randint(0, 3))]
        lines = [rng.choice(["", " ", "\t", "\r", "\x0b\x0c", " "]) + line + rng.choice(["", "  ", "\r"]) for line in lines]
        lines += [sentence(rng, rng.randint(0, 8)) for _ in range(rng.randint(0, 3))] + [""] * rng.randint(0, 2)
        rng.shuffle(lines)
        yield "\n".join(lines)


@pytest.mark.parametrize("seed", range(3))
def test_as_brute_force(spark, seed):
    rng = random.Random(seed)
    given = list(texts(rng, 150))
    docs = documents(spark, given).repartition(6)
    assert rows(line_dedup.dedup(docs)) == brute_force(list(enumerate(given)))


@pytest.mark.parametrize("filter_bytes,held", [(8192, 50), (1 << 16, 1)])
def test_a_filter_too_small_gives_the_same(spark, monkeypatch, filter_bytes, held):
    rng = random.Random(9)
    given = list(texts(rng, 120)) + [f"{i} {sentence(rng, 30)}" for i in range(4000)]
    docs = documents(spark, given).repartition(4)
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", filter_bytes)
    monkeypatch.setattr(line_dedup, "_HELD", held)
    assert rows(line_dedup.dedup(docs)) == brute_force(list(enumerate(given)))


def test_only_suspects_travel(spark):
    rng = random.Random(4)
    again = [sentence(rng, 12) for _ in range(50)]
    given = ["\n".join([f"{i} {sentence(rng, 9)}" for _ in range(10)] + [again[i % 50]]) for i in range(1000)]
    found = line_dedup.suspects(documents(spark, given).repartition(7)).collect()
    assert len({r.key for r in found}) >= 50
    assert 1000 <= len(found) < 1000 + 0.15 * 10_000


def test_second_filter_has_every_key_of_two_tasks():
    hashes = np.random.default_rng(1).integers(0, 2**64, 5000, np.uint64)
    n_words, bits = 1 << 14, 5
    once, twice = {}, {}
    for part in (hashes[:3000], hashes[2000:], np.r_[hashes[:10], hashes[:10]]):
        for segment, places, seen, again in zip(*line_dedup._touched(part, n_words, bits)):
            for place, s, t in zip(np.frombuffer(places, np.uint16), np.frombuffer(seen, np.uint64), np.frombuffer(again, np.uint64)):
                at = int(segment) * line_dedup.SEGMENT_WORDS + int(place)
                twice[at] = twice.get(at, 0) | once.get(at, 0) & int(s) | int(t)
                once[at] = once.get(at, 0) | int(s)
    masks = line_dedup._masks(hashes, bits)
    passed = [twice.get(int(h) & n_words - 1, 0) & int(m) == int(m) for h, m in zip(hashes, masks)]
    assert all(passed[2000:3000]) and all(passed[:10])
    assert sum(passed) < 1010 + 0.05 * 4000


def test_repeated_ids_hot_lines_and_odd_rows(spark):
    line = "a line that everybody has"
    docs = documents(spark, [line] * 3000 + [line + "\nown " + line])
    out = {r.doc_id: r for r in line_dedup.dedup(docs).collect()}
    assert sum(r.n_dropped for r in out.values()) == 3000
    assert out[3000].text == line + "\nown " + line
    odd = odd_documents(spark)
    other = odd.limit(1)
    for doc_id in ("1L", "cast(null as long)", "2L", "2L", "3L"):
        extra = other.selectExpr(f"{doc_id} doc_id", f"concat('{line}\\n', {doc_id}) text", "lang", "source", "n_chars", "score", "kept", "size", "words")
        odd = odd.union(extra)
    assert rows(line_dedup.dedup(odd)) == brute_force([(r.doc_id, r.text) for r in odd.collect()])
    assert line_dedup.dedup(none(spark)).count() == 0
