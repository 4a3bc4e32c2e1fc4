"""Language of a text by a string kernel: shared byte n-grams, Nyström landmarks, one ridge regression per language.

The kernel of two texts is the number of n-grams of one to three bytes that both contain (blended spectrum, presence only),
divided by the geometric mean of their numbers. Only the n-grams of the landmarks count, at most ``GRAMS`` of them. A text is
described by its kernel values with ``LANDMARKS`` landmark texts, whitened by the landmarks' own kernel matrix (Nyström),
and one kernel ridge regression per language, fitted on a sample, gives the scores. Scoring a block of texts is two
matrix products: presence by landmarks, then kernel values by coefficients. The model is a few megabytes.

The sample has at most ``SAMPLE`` distinct texts, the same quota for every language, drawn in the order of a hash of the text.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is any text when nothing could be learned. Null
languages and null ids teach nothing; of copies under several languages the last by name counts. Repeated rows are
judged alike. Only doc_id, text and lang are read, lang only for learning; other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkapply.llm.common import held_out, in_arrow
from bulkapply.llm.text_vectors import codes
from bulkapply.storage import materialize

SAMPLE = 4096
LANDMARKS = 160
GRAMS = 6144
RIDGE = 1e-2
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
CONFIDENT = 0.5
_ORDERS = (1, 2, 3)
_BLOCK = 512
_STEEPNESS = 6.0


def _grams(text: bytes) -> np.ndarray:
    """The distinct n-grams of a text; the order is in the bits above the bytes."""
    text = text.lower()
    return np.concatenate([np.unique(codes(text, n)) | n << 24 for n in _ORDERS])


def _sample(docs: DataFrame) -> DataFrame:
    """At most ``SAMPLE`` rows of ``text`` and ``lang``."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), FOLDS, HELD_OUT))
    known = known.where(F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", F.xxhash64("text").alias("hash"))
    distinct = materialize(known.groupBy("hash").agg(F.max("lang").alias("lang"), F.min("doc_id").alias("doc_id")), "languages")
    counts = distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    quota = SAMPLE / max(1, counts.count())
    # Hashes are spread evenly over the longs, so this share of them is the quota.
    share = F.least(F.lit(1.0), F.lit(quota) / F.col("n")) * 2.0**64 - 2.0**63
    drawn = distinct.join(counts, "lang").where(F.col("hash").cast("double") <= share)
    drawn = materialize(drawn.orderBy("hash", "doc_id").limit(SAMPLE).select("hash", "doc_id", "lang"), "sample")
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("hash"))
    return texts.join(F.broadcast(drawn), ["doc_id", "hash"]).dropDuplicates(["hash"]).select("text", "lang")


class Model:
    def __init__(self, grams: list[np.ndarray], langs: list[str]):
        self.langs = sorted(set(langs))
        self._places = None
        if not self.langs:
            return
        # Landmarks: the sample in its order, language by language in turn.
        of_lang = [[i for i, lang in enumerate(langs) if lang == wanted] for wanted in self.langs]
        turns = [group[k] for k in range(max(map(len, of_lang))) for group in of_lang if k < len(group)]
        chosen = turns[:LANDMARKS]
        found, times = np.unique(np.concatenate([grams[i] for i in chosen]), return_counts=True)
        self.grams = np.sort(found[np.lexsort((found, -times))[:GRAMS]])
        self.landmarks = self._unit(self._present([grams[i] for i in chosen])).T.copy()
        every = np.concatenate([self._kernel(grams[at : at + _BLOCK]) for at in range(0, len(grams), _BLOCK)])
        values, vectors = np.linalg.eigh(every[chosen].astype(np.float64))
        values = np.maximum(values, 1e-6)
        whiten = vectors / np.sqrt(values)
        z = np.c_[every @ whiten, np.ones(len(every))]
        wanted = np.where(np.array(langs)[:, None] == np.array(self.langs), 1.0, -1.0)
        weight = np.ones(len(langs))
        for group in of_lang:
            weight[group] = len(langs) / len(self.langs) / len(group)
        fitted = np.linalg.solve(z.T @ (z * weight[:, None]) + RIDGE * np.eye(z.shape[1]), z.T @ (wanted * weight[:, None]))
        self.coefficients = (whiten @ fitted[:-1]).astype(np.float32)
        self.constant = fitted[-1].astype(np.float32)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1.0))

    def _columns(self, order: int, codes: np.ndarray) -> np.ndarray:
        """The column of each n-gram of an order, or the spare last column.

        A row of columns by the last byte for each beginning that the model's n-grams have, and a spare one for all others:
        some megabytes, built once per process.
        """
        if self._places is None:
            self._places = {}
            for n in _ORDERS:
                mine = np.flatnonzero(self.grams >> 24 == n)
                numbers = self.grams[mine] & 0xFFFFFF
                beginnings, row = np.unique(numbers >> 8, return_inverse=True)
                rows = np.zeros(256 ** (n - 1), np.int16)
                rows[beginnings] = np.arange(1, len(beginnings) + 1)
                columns = np.full((len(beginnings) + 1, 256), len(self.grams), np.int16)
                columns[row + 1, numbers & 255] = mine
                self._places[n] = rows, columns
        rows, columns = self._places[order]
        return columns[rows[codes >> 8], codes & 255]

    def _present(self, grams: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(grams), len(self.grams)), np.float32)
        for row, each in enumerate(grams):
            at = np.searchsorted(self.grams, each)
            at[at == len(self.grams)] = 0
            out[row, at[self.grams[at] == each]] = 1.0
        return out

    def _kernel(self, grams: list[np.ndarray]) -> np.ndarray:
        return self._unit(self._present(grams)) @ self.landmarks

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """One row of scores per text, in the order of ``langs``."""
        out = np.empty((len(texts), len(self.langs)), np.float32)
        # One block is held at a time, without the spare column scaled in place.
        room = np.empty((min(_BLOCK, len(texts)), len(self.grams) + 1), np.float32)
        for at in range(0, len(texts), _BLOCK):
            block = texts[at : at + _BLOCK]
            present = room[: len(block)]
            present[:] = 0.0
            for row, text in enumerate(block):
                text = text.lower()
                for n in _ORDERS:
                    present[row, self._columns(n, codes(text, n))] = 1.0
            known = present[:, :-1]
            known /= np.sqrt(np.maximum(known.sum(axis=1, keepdims=True), 1.0))
            out[at : at + _BLOCK] = known @ self.landmarks @ self.coefficients + self.constant
        return out


def fit(docs: DataFrame) -> Model:
    def rows(batches):
        for batch in batches:
            yield [[_grams(text.as_py()).astype(np.int32).tobytes() for text in batch.column(0)], batch.column(1)]

    found = in_arrow(_sample(docs), rows, "grams binary, lang string").toArrow()
    # The order of the rows must not decide anything.
    pairs = sorted(zip(found.column(1).to_pylist(), found.column(0).to_pylist()))
    return Model([np.frombuffer(grams, np.int32) for _, grams in pairs], [lang for lang, _ in pairs])


def predict(docs: DataFrame, model: Model) -> Column:
    """A column of ``lang_pred`` and ``score`` for ``text`` of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        raw = model.scores([text or b"" for text in texts]).astype(np.float64)
        likely = np.exp(_STEEPNESS * (raw - raw.max(axis=1, keepdims=True)))
        best = raw.argmax(axis=1)
        return pd.DataFrame({"lang_pred": [model.langs[i] for i in best], "score": 1.0 / likely.sum(axis=1)})

    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if not model.langs:
        return unknown
    return F.when(docs["text"].rlike(r"\p{L}"), predicted(docs["text"].cast("binary"))).otherwise(unknown)


def classify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, a row for each row of ``docs``."""
    return docs.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
                       predict(docs, fit(docs)).alias("_found")).select("doc_id", "held_out", "_found.*")


def keep_recognised(docs: DataFrame) -> DataFrame:
    """``docs`` without those whose language is unknown or less likely than not."""
    found = predict(docs, fit(docs))
    columns = [docs[c] for c in docs.columns]
    return docs.select(F.struct(*columns).alias("doc"), found.alias("found")).where(
        (F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= CONFIDENT)).select("doc.*")
