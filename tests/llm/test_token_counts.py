import random

import pytest
from pyspark.sql import functions as F

from bulkapply.llm import token_counts as tc
from cases import documents, none, odd_documents


@pytest.fixture(scope="module")
def count():
    with open(tc.VOCABULARY, "rb") as lines:
        return tc._counter({tc.base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, tc.PATTERN)


def test_random_edits_count_as_encoding_anew(count, monkeypatch):
    rng, plain = random.Random(1), tc.cut
    monkeypatch.setattr(tc, "cut", lambda text: plain(text, 8))
    bits = [" ", "  ", "\n", "a", " word", "?!", "é", "12", "\t", " 's", "'s", "\x1c"]
    for _ in range(500):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 120)))
        tree = tc.Tree.of(tc.cut(text), count)
        for _ in range(4):
            a = rng.randint(0, len(text))
            b = rng.randint(a, min(len(text), a + 30))
            new = rng.choice(["", " ", "x", "  y ", " [n]", "\n\n"])
            wanted = text[:a] + new + text[b:]
            text, _ = tree.edit(text, a, b, new, count)
            assert text == wanted
            assert tree.tokens[1] == count(text) and tree.chars[1] == len(text)


def test_only_the_touched_region_is_encoded(count):
    text = " ".join(["word"] * 10_000)
    tree = tc.Tree.of(tc.cut(text), count)
    _, again = tree.edit(text, 20_000, 20_004, "other", count)
    assert again < 3 * tc.SEGMENT


def test_documents(spark, count):
    docs = documents(spark, ["mail me at some.one@example.com or +1 (706) 555-3138 now", "nothing here", None, ""])
    found = tc.recount(docs, tc.redactions(F.col("text"))).orderBy("doc_id").collect()
    assert found[0].text == "mail me at [mail] or [number] now"
    assert [r.n_edits for r in found] == [2, 0, 0, 0]
    assert all(r.tokens_after == count(r.text) for r in found)
    assert [r.tokens_before for r in found][2:] == [0, 0]


def test_odd_and_empty_tables(spark, count):
    docs = odd_documents(spark)
    edits = F.array(F.struct(F.lit(3).alias("start"), F.lit(9).alias("stop"), F.lit("  ").alias("replacement")))
    found = tc.recount(docs, edits).collect()
    assert len(found) == docs.count()
    assert all(r.tokens_after == count(r.text) for r in found)
    assert tc.recount(none(spark), edits).count() == 0


def test_overlapping_edits_are_refused(spark):
    one = F.struct(F.lit(0).alias("start"), F.lit(5).alias("stop"), F.lit("").alias("replacement"))
    two = F.struct(F.lit(4).alias("start"), F.lit(6).alias("stop"), F.lit("").alias("replacement"))
    with pytest.raises(Exception, match="overlap"):
        tc.recount(documents(spark, ["some words here"]), F.array(one, two)).collect()
