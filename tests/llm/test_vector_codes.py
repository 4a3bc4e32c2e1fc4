import hashlib
import math
import random

import numpy as np
import pytest

from bulkapply.llm import vector_codes
from cases import rows

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, part int"


def brute_force(kept, parts=8, entries=16, rounds=6):
    """Codebooks, and code and error of each vector, by plain loops over all entries; ``kept`` is ordered by id."""
    whole = [[math.floor(4096 * float(np.float32(x))) for x in v] for _, v, _ in kept]
    each = len(whole[0]) // parts
    cut = [[v[p * each : (p + 1) * each] for p in range(parts)] for v in whole]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, entry)), i) for i, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of_entry = {}
            for v in cut:
                of_entry.setdefault(nearest(v[p], books[p])[1], []).append(v[p])
            books[p] = [[sum(c) // len(of_entry[i]) for c in zip(*of_entry[i])] if i in of_entry else entry
                        for i, entry in enumerate(books[p])]
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    codes = ["".join(f"{i:02x}" for _, i in each) for each in found]
    numbers = ",".join(str(x) for book in books for entry in book for x in entry)
    return codes, [sum(d for d, _ in each) for each in found], hashlib.sha256(numbers.encode()).hexdigest()


def vectors(rng, n, width=16, values=(-1.0, -0.5, 0.0, 0.25, 0.5)):
    """Few values, so that distances tie and parts repeat."""
    return [[rng.choice(values) for _ in range(width)] for _ in range(n)]


@pytest.mark.parametrize("n,width", [(200, 16), (5, 24), (16, 8)])
def test_as_brute_force(spark, n, width):
    rng = random.Random(n)
    given = [(3 * i, v, rng.choice([None, 0, 1])) for i, v in enumerate(vectors(rng, n, width))]
    given += [(1, given[0][1], 0), (1, given[0][1], 0)]
    broken = [(-1, None, 0), (-2, [None] * width, 0), (-3, [float("nan")] * width, 1), (-4, [float("-inf")] * width, None)]
    mixed = [(*row, "x", -1, 7) for row in broken + given]
    rng.shuffle(mixed)
    coded, books = vector_codes.compress(spark.createDataFrame(mixed, SCHEMA).repartition(5))
    kept = sorted(given, key=lambda row: (row[0], row[1]))
    codes, errors, digest = brute_force(kept)
    of_label = {}
    for (_, _, label), error in zip(kept, errors):
        of_label[label] = of_label.get(label, 0) + error
    wanted = [(i, c, e, of_label[label]) for (i, _, label), c, e in zip(kept, codes, errors)]
    assert rows(coded) == sorted(wanted, key=str)
    assert vector_codes.digest(books) == digest


def test_orchard_finds_the_lowest_of_the_nearest():
    rng = np.random.default_rng(3)
    for size in (1, 2, 16, 40):
        entries = rng.integers(-3, 4, (size, 3))
        points = rng.integers(-6, 7, (500, 3))
        at, best = vector_codes.Orchard(entries).nearest(points)
        apart = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (at == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()


def test_odd_vectors(spark):
    given = [(1, [0.5] * 8, 0), (None, [0.25] * 8, 1), (2, [], None), (3, [0.5] * 7, None), (4, [0.5] * 16, 0), (5, [1.0] * 8, 1)]
    table = spark.createDataFrame([(*row, "x", 0, 0) for row in given], SCHEMA)
    coded, books = vector_codes.compress(table)
    got = {r.vec_id: (r.code, r.error) for r in coded.collect()}
    assert books.shape == (8, 2, 1)
    assert {i for i, (code, _) in got.items() if code is None} == {2, 3, 4}
    # The entry nearest to 2048 and 1024 moves to their mean.
    assert len(got) == 6 and got[1] == got[None] == ("00" * 8, 8 * 512**2)
    empty, books = vector_codes.compress(table.limit(0))
    assert empty.count() == 0 and books is None and vector_codes.digest(None) == hashlib.sha256(b"").hexdigest()


def test_too_large_components_are_refused(spark):
    table = spark.createDataFrame([(1, [1e30] * 8, 0, "x", 0, 0)], SCHEMA)
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(table)[0].collect()
