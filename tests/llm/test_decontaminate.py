import math
import random
from collections import Counter

import pytest

from bulkapply.llm import decontaminate
from cases import documents, none, odd_documents, rows, sentence

rng = random.Random(11)
ITEMS = [sentence(rng, n) for n in (7, 20, 40, 60, 60, 5)] + ["too short", "", None]
ITEMS[4] = " ".join(ITEMS[3].split()[:30] + ITEMS[4].split()[:30])


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(ITEMS)] + [(None, ITEMS[1], "x"), (0, ITEMS[0], "x")],
                                 "item_id long, text string, shingles string")


def similar(text, item, weights, top):
    """The best weighted Jaccard similarity of the item with any window of its size, clipped at the edges of the text."""
    cut = lambda t: [tuple(w[i : i + 5]) for w in [t.lower().replace(",", " ").replace("!", " ").split()] for i in range(len(w) - 4)]
    x, y = cut(text), cut(item)
    best, weigh = 0.0, lambda bag: sum(n * weights.get(s, top) for s, n in bag.items())
    of_item = Counter(y)
    for start in range(1 - len(y), len(x)):
        window = Counter(x[max(0, start) : max(0, start + len(y))])
        common = weigh(window & of_item)
        best = max(best, common / (weigh(window) + weigh(of_item) - common))
    return best


def test_as_brute_force(spark, benchmark):
    texts = []
    for item in ITEMS[:6]:
        w = item.split()
        for k in range(0, len(w) // 2, max(1, len(w) // 8)):
            texts.append(sentence(rng, 50) + " " + " ".join(w[k:]) + " " + sentence(rng, 10))
            texts.append(" ".join(w[: len(w) - k]).upper() + "!")
            texts.append(sentence(rng, 30) + ", " + " ".join(w[:k] + ["other"] + w[k:]))
            texts.append(sentence(rng, 20) + " " + " ".join(w[k:] + w[:k]) + " " + sentence(rng, 20))
    texts += [sentence(rng, 300) for _ in range(20)]
    cut = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    items = {i: t for i, t in enumerate(ITEMS) if t and cut(t.split())}
    times = Counter(s for t in items.values() for s in set(cut(t.split())))
    weights = {s: math.log1p(len(items) / n) for s, n in times.items()}
    wanted = {(d, i) for d, t in enumerate(texts) for i, item in items.items()
              if similar(t, item, weights, math.log1p(len(items))) >= 0.8}
    docs = documents(spark, texts)
    assert {(r.doc_id, r.item_id) for r in decontaminate.find(docs, benchmark).collect()} == wanted
    assert len(wanted) > 20
    kept = decontaminate.keep_clean(docs, benchmark)
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in wanted}
    assert kept.columns == docs.columns


def test_passages_in_another_order(spark):
    """Swapped halves, rotations and interleaved parts of a long item are found wherever they are 0.8 alike."""
    item = [f"word{i}" for i in range(200)]
    thirds = item[:70], item[70:140], item[140:]
    texts = [" ".join(item[100:] + item[:100]), "x y z " + " ".join(item[150:] + item[:150]) + " end of it", " ".join(thirds[2] + thirds[0] + thirds[1]),
             " ".join(x for i in range(0, 200, 4) for x in item[i : i + 4][::-1]), " ".join(item[50:150]), sentence(rng, 500)]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    weights = {}
    wanted = {d: similar(t, " ".join(item), weights, math.log1p(1)) for d, t in enumerate(texts)}
    found = {r.doc_id: r.similarity for r in decontaminate.find(documents(spark, texts), benchmark).collect()}
    assert found.keys() == {d for d, x in wanted.items() if x >= 0.8} == {0, 1, 2}
    assert all(abs(found[d] - wanted[d]) < 1e-9 for d in found)


def test_a_shingle_that_all_items_and_documents_share(spark):
    same = "this is the text that everybody has"
    items = [f"{same} {sentence(random.Random(i), 12)}" for i in range(40)]
    texts = [f"{same} {sentence(random.Random(1000 + i), 30)}" for i in range(300)] + [sentence(rng, 9) + " " + items[7], items[8].upper()]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find(documents(spark, texts), benchmark).collect()}
    assert found == {(300, 7), (301, 8)}


def test_blocks_of_the_benchmark_give_the_same(spark, benchmark, monkeypatch):
    docs = documents(spark, [sentence(rng, 9) + " " + ITEMS[2], ITEMS[3], "clean"])
    whole = rows(decontaminate.find(docs, benchmark))
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 30)
    assert rows(decontaminate.find(docs, benchmark)) == whole


def test_odd_and_empty_tables(spark, benchmark):
    docs = odd_documents(spark)
    planted = docs.limit(1).selectExpr("cast(null as long) doc_id", f"'{ITEMS[2]}' text", "lang", "source", "n_chars", "score", "kept", "size", "words")
    both = docs.union(planted)
    assert rows(decontaminate.keep_clean(both, benchmark)) == rows(docs)
    assert [r.item_id for r in decontaminate.find(both, benchmark).collect()] == [2]
    assert decontaminate.find(none(spark), benchmark).count() == 0
    assert decontaminate.keep_clean(docs, benchmark.limit(0)).count() == docs.count()


def test_no_python_in_the_plan(spark, benchmark):
    plan = decontaminate.find(odd_documents(spark), benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
