"""Quality by votes of the nearest labelled texts in a latent-semantic space.

A text becomes a vector of hashed byte-trigram frequencies (whole text, log-scaled, weighted by rarity), extended by two
measures of repetition, and is projected on the leading singular directions of a labelled sample. The vectors of the sample, at most
``SAMPLE`` rows of ``RANK`` numbers, are broadcast; every text is compared with all of them by exact cosines, one
matrix product per block of texts, and the ``NEIGHBOURS`` most similar vote with their similarity. Votes are divided by
how strongly each label was sampled, so the score follows the labels' real shares.

The sample is drawn from all distinct labelled texts in the order of a hash of the text, half of it per label; copies count
once. Labels, language, source and id never enter a score.

Defined cases: a null or empty text has no direction, so its score is the share of label 1; without any label every score is 0.5.
Labels other than 0 and 1 and null ids teach nothing; repeated labels of an id are averaged. Repeated rows are scored
alike. Only doc_id and text, and doc_id and quality of the labels, are read, so other columns may have any name.
"""

from __future__ import annotations

import operator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkapply.llm.common import held_out, in_arrow
from bulkapply.llm.text_vectors import hashed_counts
from bulkapply.storage import materialize

SAMPLE = 4096
DIMS_LOG2 = 11
RANK = 64
NEIGHBOURS = 15
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
_BLOCK = 512
_SHARPNESS = 4
# Weights of the two measures of repetition beside the trigrams.
_VARIETY, _REPETITION = 20.0, 80.0


def _features(text: bytes | None) -> np.ndarray:
    """Log frequencies per thousand trigrams, then how varied the trigrams are and how many words repeat the one before."""
    text = text or b""
    counts = hashed_counts(text, DIMS_LOG2)
    total = counts.sum()
    scaled = np.log1p(counts * (1000.0 / max(total, 50)))
    spread = np.count_nonzero(counts) / max(1.0, float(total)) ** 0.6
    words = text.split()
    repeated = sum(map(operator.eq, words[1:], words)) / max(1, len(words))
    return np.r_[scaled, _VARIETY * spread, _REPETITION * repeated].astype(np.float32)


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most ``SAMPLE`` rows of ``text``, ``label`` and ``weight``, how many distinct texts of its label a row stands for."""
    taught = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), FOLDS, HELD_OUT))
    taught = taught.groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    hashed = docs.select("doc_id", F.xxhash64("text").alias("hash")).where("doc_id is not null")
    distinct = hashed.join(taught, "doc_id").groupBy("hash").agg(
        F.min("doc_id").alias("doc_id"), (F.avg("quality") >= 0.5).cast("int").alias("label"))
    distinct = materialize(distinct, "labelled")
    chosen = None
    for label in (0, 1):
        of_label = distinct.where(F.col("label") == label)
        drawn = of_label.orderBy("hash", "doc_id").limit(SAMPLE // 2)
        n = of_label.count()
        drawn = drawn.withColumn("weight", F.lit(max(1.0, n / (SAMPLE // 2))))
        chosen = drawn if chosen is None else chosen.union(drawn)
    chosen = materialize(chosen, "sample")
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("hash"))
    return texts.join(F.broadcast(chosen), ["doc_id", "hash"]).dropDuplicates(["hash"]).select("text", "label", "weight", "hash")


class Model:
    """Rarity weights, projection, and the labelled vectors; about two megabytes."""

    def __init__(self, features: np.ndarray, labels: np.ndarray, weights: np.ndarray):
        self.prior = float(np.average(labels, weights=weights)) if len(labels) else 0.5
        self.labels, self.weights = labels.astype(np.float32), weights.astype(np.float32)
        if not len(labels):
            return
        present = np.count_nonzero(features, axis=0) / len(features)
        self.rarity = (np.log((1.0 + 1e-3) / (present + 1e-3)) + 0.1).astype(np.float32)
        features *= self.rarity
        features /= np.maximum(np.linalg.norm(features, axis=1, keepdims=True), 1e-9)
        self.projection = self._leading(features.T @ features)
        self.vectors = self._unit(features @ self.projection)

    @staticmethod
    def _leading(products: np.ndarray) -> np.ndarray:
        """The leading directions of a symmetric matrix, by subspace iteration; takes little more memory than the matrix."""
        rank = min(RANK, len(products))
        basis = np.random.default_rng(1).standard_normal((len(products), min(len(products), 2 * rank))).astype(np.float32)
        for _ in range(12):
            basis, _ = np.linalg.qr(products @ basis)
        values, turned = np.linalg.eigh(basis.T @ products @ basis)
        return np.ascontiguousarray(basis @ turned[:, ::-1][:, :rank]).astype(np.float32)

    def _scaled(self, features: np.ndarray) -> np.ndarray:
        return self._unit(features * self.rarity)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        for at in range(0, len(texts), _BLOCK):
            features = np.stack([_features(text) for text in texts[at : at + _BLOCK]])
            cosines = self._unit(self._scaled(features) @ self.projection) @ self.vectors.T
            k = min(NEIGHBOURS, cosines.shape[1])
            near = np.argpartition(cosines, -k, axis=1)[:, -k:]
            votes = np.maximum(np.take_along_axis(cosines, near, axis=1), 0.0) ** _SHARPNESS * self.weights[near]
            given = votes.sum(axis=1)
            known = given > 1e-6
            out[at : at + _BLOCK][known] = ((votes * self.labels[near]).sum(axis=1) / np.maximum(given, 1e-6))[known]
        return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    def rows(batches):
        for batch in batches:
            features = [_features(text.as_py()).tobytes() for text in batch.column(0)]
            yield [features, batch.column(1), batch.column(2), batch.column(3)]

    sample = in_arrow(_sample(docs, labels), rows, "features binary, label int, weight double, hash long").toArrow()
    # The order of the rows must not decide anything, the sum over them included. One copy only is made on the driver.
    order = np.argsort(sample.column(3).to_numpy())
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    features, at = np.empty((len(order), (1 << DIMS_LOG2) + 2), np.float32), 0
    for chunk in sample.column(0).chunks:
        for row in chunk:
            features[place[at]] = np.frombuffer(row.as_buffer(), np.float32)
            at += 1
    label, weight = sample.column(1).to_numpy()[order], sample.column(2).to_numpy()[order]
    del sample
    return Model(features, label, weight)


def score(docs: DataFrame, model: Model) -> Column:
    """A column with the score of ``text`` of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(texts.tolist()))

    return scored(docs["text"].cast("binary"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``, a row for each row of ``docs``."""
    found = docs.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
                        score(docs, fit(docs, labels)).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those predicted to be of low quality."""
    return docs.where(score(docs, fit(docs, labels)) >= THRESHOLD)
