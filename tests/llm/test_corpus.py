"""Mixing, language-model scores, near duplicates and quality rules against brute force."""

import collections
import math
import pickle
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bulkapply.llm import mixing, near_dups, ppm, quality_rules
from cases import documents, none, odd_documents, rows, sentence

rng = random.Random(4)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Mixing

def test_quotas_stop_and_are_shared_again():
    found = mixing.quotas({"a": 10, "b": 1000, None: 100, "c": 0})
    assert found["a"] == 30 and found["c"] == 0
    assert found["b"] + found[None] == pytest.approx(1110 - 30)
    assert found["b"] / found[None] == pytest.approx(2 / 5) or found[None] == 300
    assert sum(found.values()) == pytest.approx(1110)


def test_flow_costs_least():
    supply = {"p": [(10, 0), (10, 1), (10, 2)], "q": [(5, 0), (5, 1)]}
    used = mixing.min_cost_flow(supply, [("p", "s", 30), ("p", "t", 30), ("q", "t", 15)], {"s": 9, "t": 8})
    assert sum(used.values()) == 17 and used["p", "s"] == 9
    # The free words are 1 left of p and 5 of q, so two more words cost 1 each wherever they come from.
    cost = sum(max(0, n - 10) for n in [used["p", "s"] + used["p", "t"]]) + max(0, used["q", "t"] - 5)
    assert cost == 2


def test_mix_meets_quotas(spark):
    texts = [sentence(rng, rng.randint(1, 60)) for _ in range(200)]
    texts += [texts[i % 7] for i in range(60)] + [None, "", " "]
    docs = documents(spark, texts, sources=("a", "b", "a", "c", None, "a"))
    found = mixing.mix(docs).collect()
    sources = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken = collections.Counter(), collections.Counter()
    for r in found:
        assert r.size == len(words(texts[r.doc_id])) and 0 <= r.taken <= 3 * r.size
        sizes[sources[r.doc_id]] += r.size
        taken[sources[r.doc_id]] += r.taken
    target = mixing.quotas(dict(sizes))
    for r in found:
        assert r.source_size == sizes[sources[r.doc_id]] and r.target == pytest.approx(target[sources[r.doc_id]])
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    assert rows(mixing.mix(docs.repartition(3))) == rows(mixing.mix(docs))


def test_copies_in_one_source_are_no_distinct_texts(spark):
    own, both = sentence(rng, 10), [sentence(rng, 10) for _ in range(10)]
    texts = [(own, "a")] * 9 + [(t, s) for t in both for s in "ab"]
    docs = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc_id long, text string, source string")
    found = mixing.mix(docs).collect()
    # Of 290 words, 220 are a first and a second pass over all texts, the rest a third over 110.
    assert 20 <= sum(r.taken for r in found if r.doc_id < 9) <= 30 and sum(r.taken for r in found) == 290


def test_mix_costs_least_with_many_patterns(spark):
    texts, sources, rows = [], "abcdefgh", []
    for mask in range(1, 256):
        texts.append(f"t{mask} " + sentence(rng, rng.randint(1, 40)))
        rows += [(texts[-1], s) for i, s in enumerate(sources) if mask >> i & 1 for _ in range(rng.choice([1, 1, 3]))]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, source string")
    taken, demand, has = collections.Counter(), collections.Counter(), collections.Counter()
    for r in mixing.mix(docs).collect():
        taken[rows[r.doc_id][0]] += r.taken
        demand[rows[r.doc_id][1]] += r.taken
        has[rows[r.doc_id]] += r.size
    once = {t: len(words(t)) for t in texts}
    all_of = {t: 3 * sum(has[t, s] for s in sources) for t in texts}
    steps = [{t: min(once[t] * (c + 1), all_of[t]) for t in texts} for c in range(4)] + [all_of]

    def least_cut(most):
        return min(
            sum(demand[s] for i, s in enumerate(sources) if cut >> i & 1)
            + sum(min(most[t], 3 * sum(has[t, s] for i, s in enumerate(sources) if not cut >> i & 1)) for t in texts)
            for cut in range(256))

    # What fits at a cost of at most c, by the least cut; the words beyond it cost more.
    fits = [least_cut(most) for most in steps]
    assert fits[-1] == sum(taken.values())
    for most, fit in zip(steps, fits):
        assert sum(min(taken[t], most[t]) for t in texts) == fit


def test_mix_of_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    found = mixing.mix(odd).collect()
    assert len(found) == odd.count() and all(r.taken <= 3 * r.size for r in found)
    assert sum(r.taken for r in found) == sum(r.size for r in found)
    assert mixing.mix(none(spark)).count() == 0


# Language-model scores

def ppm_by_hand(training, texts, order):
    """Probabilities by recursion over plain dictionaries of contexts, every context kept."""
    counts = collections.defaultdict(collections.Counter)
    for text in training:
        data = bytes(order) + text + b"\0"
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts[data[i - k : i]][data[i]] += 1
    memo = {}

    def row(context):
        if context not in memo:
            longer = row(context[1:]) if context else [1 / 256] * 256
            seen = counts[context]
            total, kinds = sum(seen.values()), len(seen)
            rest = sum(p for s, p in enumerate(longer) if s not in seen)
            escape = kinds / (total + kinds) if rest > 0 else 0.0
            memo[context] = [seen[s] / total * (1 - escape) if s in seen else p * escape / rest for s, p in enumerate(longer)]
        return memo[context]

    out = []
    for text in texts:
        data, total = bytes(order) + text + b"\0", 0.0
        for i in range(order, len(data)):
            k = order
            # The longest context whose suffixes were all seen.
            while k and data[i - k : i] not in counts:
                k -= 1
            total += math.log10(row(data[i - k : i])[data[i]])
        out.append(total)
    return out


def test_scores_as_brute_force(spark):
    texts = [sentence(rng, rng.randint(0, 30)) + rng.choice(["", " É x\n", " YZ"]) for _ in range(120)] + [None, "", "ünseen ☃ byte"]
    docs = documents(spark, texts)
    out = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    training = [(t or "").encode() for t, o in zip(texts, out) if not o]
    tokens = collections.Counter(w for t in training for w in [*t.lower().split(), b""])
    total, kinds = sum(tokens.values()), len(tokens)
    scores = ppm_by_hand(training, [(t or "").encode() for t in texts], ppm.ORDER)
    for r in ppm.score(docs).collect():
        mine = [*(texts[r.doc_id] or "").encode().lower().split(), b""]
        base = sum(math.log10((tokens[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in mine)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[r.doc_id], len(mine), total)
        assert r.n_known == sum(tokens[w] > 0 for w in mine)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(scores[r.doc_id], rel=1e-4)


def test_rare_words_and_flushed_counts_do_not_matter(spark, monkeypatch):
    docs = documents(spark, [sentence(rng, 40) for _ in range(60)])
    whole = {r.doc_id: r for r in ppm.score(docs).collect()}
    monkeypatch.setattr(ppm, "FREQUENT", 3)
    for r in ppm.score(docs).collect():
        assert r.n_known == whole[r.doc_id].n_known and r.base_score == pytest.approx(whole[r.doc_id].base_score)


@pytest.mark.parametrize("contexts, values", [(4, 0), (60, 50), (0, 0)])
def test_contexts_outside_the_broadcast_take_part(spark, monkeypatch, contexts, values):
    monkeypatch.setattr(ppm, "CONTEXTS", {k: contexts for k in ppm.CONTEXTS})
    monkeypatch.setattr(ppm, "VALUES", values)
    texts = [sentence(rng, rng.randint(0, 30)) + rng.choice(["", " É x\n", " YZ"]) for _ in range(120)] + [None, "", "ünseen ☃ byte"]
    # A held-out text with contexts and bytes of its own.
    own = next(i for i in range(len(texts), 300) if zlib.crc32(str(i).encode()) % 10 == 0)
    texts += ["ab"] * (own - len(texts)) + ["q\x01zqj " + sentence(rng, 5)[::-1] + " ☂"]
    training = [(t or "").encode() for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 10]
    scores = ppm_by_hand(training, [(t or "").encode() for t in texts], ppm.ORDER)
    found = ppm.score(documents(spark, texts)).collect()
    assert len(found) == len(texts)
    assert all(r.score == pytest.approx(scores[r.doc_id], rel=1e-4) for r in found)


def test_probabilities_of_a_context_add_up():
    texts = [sentence(rng, 20).encode() for _ in range(30)]
    numbers, counts = ppm._grams(texts)
    orders = []
    for k in range(ppm.ORDER + 1):
        low, where = np.unique(numbers & (1 << 8 * (k + 1)) - 1, return_inverse=True)
        orders.append((low, np.bincount(where, counts).astype(int)))
    trie = ppm.Trie(orders)
    weight = np.ones(trie.width)
    weight[-1] = 256 - trie.width + 1
    assert np.allclose((10.0 ** trie.log10 * weight).sum(axis=1), 1, atol=1e-4)


def test_the_driver_gathers_counts_and_no_tables(spark):
    """The driver made, held and pickled the tables before; each worker makes them of the counts, once."""
    levels = ppm.levels_of(ppm.counted(documents(spark, [sentence(rng, 30) for _ in range(60)])))
    gathered = ppm.train(levels, ppm.values_of(levels))
    size = len(pickle.dumps(gathered))
    trie = gathered.trie()
    tables = trie.log10.nbytes + trie.short.nbytes + sum(grown.nbytes for _, grown in trie.steps)
    assert size < tables / 4 and gathered.trie() is trie
    assert np.all(np.diff(trie.grams) > 0) and len(trie.grams) == len(trie.values)


def test_workers_get_few_megabytes_of_texts_at_once(spark, monkeypatch):
    """A whole partition came in one batch before, however long its texts."""
    real = ppm.in_arrow

    def in_arrow(rows, function, schema):
        def watched(batches):
            def small():
                for batch in batches:
                    assert batch.nbytes < 8 << 20
                    yield batch

            yield from function(small())

        return real(rows, watched, schema)

    monkeypatch.setattr(ppm, "in_arrow", in_arrow)
    docs = documents(spark, [sentence(rng, 30) for _ in range(300)]).withColumn("text", F.expr("repeat(text, 400)")).coalesce(1)
    assert ppm.score(docs).count() == 300
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None


def test_memory_of_counting_and_scoring():
    """Scoring held some 40 MB of arrays for a block of a megabyte before, counting the parts beside their sums."""
    texts = [b" ".join(sentence(rng, 30).encode() for _ in range(300)) for _ in range(40)]
    orders = [ppm._merged([(numbers & ppm._mask(k + 1), counts)]) for numbers, counts in [ppm._grams(texts)] for k in range(6)]
    trie = ppm.Trie(orders)
    whole = trie.score(texts)
    tracemalloc.start()
    try:
        again = trie.score(texts)
        assert tracemalloc.get_traced_memory()[1] < 16 << 20
    finally:
        tracemalloc.stop()
    assert all(np.array_equal(a, b) for a, b in zip([whole[0], *whole[1]], [again[0], *again[1]]))
    parts = [ppm._grams([text]) for text in texts]
    numbers, counts = ppm._merged(parts)
    assert not parts and all(np.array_equal(a, b) for a, b in zip((numbers, counts), ppm._grams(texts)))


def test_scores_of_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    found = ppm.score(odd).collect()
    assert len(found) == odd.count() and all(r.score < 0 and r.base_score < 0 for r in found)
    assert ppm.score(none(spark)).count() == 0
    held_out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    untrained = ppm.score(documents(spark, ["ab"] * 200).where(F.col("doc_id").isin(held_out))).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == pytest.approx(3 * math.log10(1 / 256)) for r in untrained)


# Near duplicates

def groups(texts, size, percent):
    sets, parent = [], list(range(len(texts)))
    for t in texts:
        w = [x.encode().lower() for x in words(t)]
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, x in enumerate(sets):
        for j in range(i):
            common = len(x & sets[j])
            if common and 100 * common >= percent * (len(x) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def test_near_duplicates_as_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "MEETING", 8)
    texts, passage = [], sentence(rng, 90)
    for i in range(12):
        base = sentence(rng, 120).split()
        for k in range(8):
            copy = list(base)
            for _ in range(k):
                copy[rng.randrange(len(copy))] = "new"
            texts.append(" ".join(copy))
    for k in range(40):  # one passage in many texts of little else
        texts.append(passage + " " + sentence(rng, rng.randint(10, 40)))
    texts += [texts[0]] * 5 + ["a", "A", "a b c", "a b c d", None, "", " "]
    rng.shuffle(texts)
    for size, percent in ((4, 80), (5, 80)):
        found = sorted(near_dups.near_duplicates(documents(spark, texts), size, percent).collect())
        assert [(r.n_shingles, r.component_id) for r in found] == groups(texts, size, percent)
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_an_id_with_several_texts_is_one_document(spark):
    """Linked through either text, and with rows that have no words."""
    base = [sentence(rng, 60) for _ in range(6)]
    near = lambda i: base[i] + " end"
    given = [(10, base[0]), (11, base[1]), (12, near(0)), (12, near(1)), (13, base[2]), (13, base[3]), (13, ""), (14, near(3)),
             (5, near(2)), (5, None), (20, base[4]), (20, base[4]), (21, base[5]), (21, None), (22, ""), (22, " ")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in given], "doc_id long, text string, node string, component int").repartition(4)
    found = near_dups.near_duplicates(docs).collect()
    assert len(found) == len(given)
    components = {}
    for r in found:
        components.setdefault(r.doc_id, set()).add((r.component_id, r.kept))
    assert components == {i: {(c, i == c)} for i, c in {10: 10, 11: 10, 12: 10, 13: 5, 14: 5, 5: 5, 20: 20, 21: 21, 22: 22}.items()}
    kept = near_dups.keep_one_of_each(docs)
    assert sorted({r.doc_id for r in kept.collect()}) == [5, 10, 20, 21, 22]
    for _ in range(2):
        shuffled = near_dups.near_duplicates(docs.repartition(3)).collect()
        assert {(r.doc_id, r.component_id) for r in shuffled} == {(r.doc_id, r.component_id) for r in found}


def test_all_links_of_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id")
    rows = docs.select("doc_id", "text").collect()
    assert [r.doc_id for r in rows] == list(range(len(rows)))
    found = near_dups.near_duplicates(docs, 4, 80).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in found] == groups([r.text for r in rows], 4, 80)


def test_shingles_lost_in_the_cut_drop_no_pair(spark):
    # Two sets of 100, 89 of them common and 10 of these lost in the cut of either.
    common = list(range(79))
    sets = [np.array(common + list(range(k, k + 11)), np.uint32).tobytes() for k in (1000, 2000)]
    pairs = [(0, i, i, 100, 2, bytearray(near_dups.SYMBOLS), bytearray(s)) for i, s in enumerate(sets)]
    each = spark.createDataFrame(
        pairs, "key long, node long, component long, n long, n_members long, sign binary, members binary")
    assert [tuple(r) for r in near_dups._crossing(each, 80).collect()] == [(0, 1)]


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(100, 101), (103, 102), (101, 103)], "a long, b long")
    found = {r.node: r.component for r in near_dups.components(edges).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100, 103: 100}


def test_near_duplicates_of_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    found = near_dups.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    assert {r.component_id for r in found if r.doc_id in (4, 10)} == {4}
    assert all(r.kept and r.component_id == r.doc_id for r in found if r.doc_id in (1, 2, 3, None))
    kept = near_dups.keep_one_of_each(odd)
    assert kept.columns == odd.columns and 10 not in {r.doc_id for r in kept.collect()}
    assert near_dups.near_duplicates(none(spark)).count() == 0


# Quality rules

def measured(text):
    text = text or ""
    w = words(text)
    times = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if times[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_as_brute_force(spark):
    bits = ["a", "b", "é", " ", "\n", "\t", "#", "a b a", "\x0b", "x|y", "\r\n", " "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 200))) for _ in range(150)] + [None, "", "a b", "a a a a", "x\nx\nx"]
    for r in quality_rules.judge(documents(spark, texts)).collect():
        n, chars, symbols, lines, repeats = measured(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert not (r.kept and r.base_failed)


def test_windows_of_one_hash_are_told_apart_by_their_words(spark, monkeypatch):
    monkeypatch.setattr(quality_rules.F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    texts = ["a b c d e f", "a b c x a b c y b c x", "a a a a", "a b", None]
    for r in quality_rules.measures(documents(spark, texts)).collect():
        assert r.n_repeat_words == measured(texts[r.doc_id])[-1]


def test_thresholds_are_those_of_the_group_or_what_contains_it(spark):
    texts = [sentence(rng, 60) for _ in range(300)] + [" ".join(w + "#" for w in sentence(rng, 60).split()) for _ in range(12)]
    docs = documents(spark, texts, langs=("en",), sources=("a",)).union(documents(spark, texts[:5], langs=("xx",), sources=("rare",)))
    found = quality_rules.judge(docs).collect()
    assert {r.doc_id for r in found if not r.kept} == set(range(300, 312))
    assert {tuple(r.broken) for r in found if not r.kept} <= {("symbol_ratio",), ("symbol_ratio", "mean_word")}
    limit = quality_rules.thresholds(quality_rules.measures(docs)).collect()
    assert {(r.lang, r.source) for r in limit} == {("en", "a"), ("xx", "rare")}
    values = sorted(m[1] / m[0] for m in map(measured, texts))
    (own,) = [r for r in limit if r.lang == "en"]
    low, high = values[len(values) // 4 - 1 : len(values) // 4 + 1], values[3 * len(values) // 4 - 1 : 3 * len(values) // 4 + 1]
    assert any(own.high_mean_word == pytest.approx(h + 6 * max(h - a, 0.75)) for h in high for a in low)


def test_rules_on_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    found = quality_rules.judge(odd)
    assert found.count() == odd.count() and found.where("kept is null or base_failed is null").isEmpty()
    assert quality_rules.judge(none(spark)).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
