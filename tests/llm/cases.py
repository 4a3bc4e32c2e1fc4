"""Small tables that hold what real ones do: nulls, empty and long texts, copies, repeated rows, columns with clashing names."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, size int, words string"
WORDS = [a + b for a in ("ba", "ke", "lo", "mi", "nu", "pra", "sto") for b in ("n", "rt", "ssel", "ve", "x", "ding", "l")]


def sentence(rng, n, words=WORDS):
    return " ".join(rng.choice(words) for _ in range(n))


def documents(spark, texts, langs=("en",), sources=("a", "b", None)):
    """Documents 0, 1, ... with these texts, and columns whose names the operators use themselves."""
    rows = [
        (i, text, langs[i % len(langs)], sources[i % len(sources)], len(text or ""), -1.0, None, 7, "x")
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def odd_documents(spark):
    """Null id, null text, null language and source, empty and blank texts, a repeated row, one very long text."""
    rng = random.Random(5)
    long = sentence(rng, 30_000)
    rows = [
        (1, None, "en", "a"), (2, "", None, None), (3, " \n\t ", "de", "b"), (4, long, "en", None),
        (5, sentence(rng, 80), None, "a"), (5, sentence(rng, 80), None, "a"), (None, sentence(rng, 90), "en", "a"),
        (None, None, None, None), (6, "###", "en", "c"), (7, "1 2 3", "de", "c"), (8, "a", "de", "c"),
        (9, "é" * 50_000, "fr", "a"), (10, long, "en", "b"), (10, long, "en", "b"),
    ]
    return spark.createDataFrame([(*row, 0, 0.5, True, 1, "w") for row in rows], DOCS)


def none(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
