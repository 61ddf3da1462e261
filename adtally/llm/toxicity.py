"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and
skip-grams.

Features of a text are the distinct hashes (``2^BITS`` places) of its words,
word pairs and pairs with one word between; words are runs of letters, digits
and non-ASCII characters, A-Z lower-cased. Each place has its own learning rate
alpha / (beta + sqrt(sum of squared gradients)); the L1 term keeps weights of
rare and uninformative places at zero, so the model is a short list (at most
2^BITS entries of 8 bytes, which bounds the broadcast).

The model is fitted in one task on a bounded sample: about ``train_docs``
labelled documents, chosen by a seeded hash of their id. Scoring runs over all
documents and all their words, map-side, without a shuffle.

Defined results: rows with a null label or id are not learned from; a label on
several rows counts once if the rows agree, and not at all if they don't;
repeated documents are learned from each time and all scored; null and empty
texts get the score of the bias alone; without labelled rows every score is
0.5; an empty table gives no rows. Extra columns are ignored by ``fit`` and
kept by ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (WordHashes, bounded_sample, crc_mod, materialize, mix64, read_table, shingle_hashes,
                     small_batches, text_slices, words_of)

BITS = 20
TRAIN_DOCS = 30_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 1.0
THRESHOLD = 0.3
SEED = 9


def features(words: np.ndarray) -> np.ndarray:
    """Hashed places of word hashes: unigrams, bigrams, skip-bigrams (with repeats)."""
    shift = np.uint64(64 - BITS)
    skip = mix64(words[:-2] * np.uint64(0x9E3779B97F4A7C15) + mix64(words[2:]) + np.uint64(3))
    return np.concatenate([mix64(words), shingle_hashes(words, 2), skip]) >> shift


def _featurize(batches):
    hashes = WordHashes()
    for rows, texts in text_slices(batches):
        found = [np.unique(features(hashes.of(words_of(t)))).astype(np.uint32).tobytes() for t in texts]
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, pa.binary())], ["label", "places"])


class Ftrl:
    """FTRL-proximal state over hashed places and a bias (the last place)."""

    def __init__(self, bits: int = BITS, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        size = (1 << bits) + 1
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        old = self.n[at]
        new = old + g * g
        self.z[at] += g - (np.sqrt(new) - np.sqrt(old)) / self.alpha * w
        self.n[at] = new


def _train(batches):
    rows = [(label, np.frombuffer(p, np.uint32).astype(np.int64)) for b in batches
            for label, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    model = Ftrl()
    bias = np.array([len(model.z) - 1])
    rng = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            model.learn(np.concatenate([rows[i][1], bias]), rows[i][0])
    every = np.arange(len(model.z))
    w = model.weights(every)
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w[at])], ["place", "weight"])


def labelled(docs: DataFrame, labels: DataFrame, label: str, keep=None, most: int | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, text, label) of documents with one agreed, non-null label.
    ``keep``: a condition on doc_id; ``most``: sample about so many labels, a
    number that is then broadcast, so that no text is shuffled."""
    y = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id")
         .agg(F.min(label).cast("long").alias("label"), F.max(label).cast("long").alias("__hi")).where(F.col("label") == F.col("__hi")))
    y = y.where(keep) if keep is not None else y
    y = F.broadcast(bounded_sample(y, most, seed)) if most else y
    d = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return d.join(y, "doc_id").select("doc_id", "text", "label")


def fit(rows: DataFrame, train_docs: int = TRAIN_DOCS) -> np.ndarray:
    """Weights of all places, the bias last, from (doc_id, text, label 0/1)."""
    small_batches(rows.sparkSession)
    sample = bounded_sample(rows, train_docs, SEED)
    places = sample.select("label", "text").mapInArrow(_featurize, "label long, places binary")
    places = materialize(places, "toxic-places")
    # bounded by train_docs; sorted, so that the result does not depend on the order of tasks
    found = (places.repartition(1).sortWithinPartitions("places", "label")
             .mapInArrow(_train, "place long, weight double").collect())  # at most 2^BITS + 1 pairs
    w = np.zeros((1 << BITS) + 1, np.float32)
    for place, weight in found:
        w[place] = weight
    return w


def score(docs: DataFrame, weights: np.ndarray, column: str = "score") -> DataFrame:
    """``docs`` with all columns and ``column``, the probability of label 1."""
    at = np.flatnonzero(weights)
    some, bias = weights[at], float(weights[-1])

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        w = np.zeros(1 << BITS, np.float32)
        w[at[at < len(w)]] = some[at < len(w)]
        for texts in series:
            out = np.empty(len(texts))
            for i, t in enumerate(texts):
                p = features(hashes.of(words_of(t.encode() if t else b""))).astype(np.int64)
                hit = np.unique(p[w[p] != 0])
                out[i] = 1 / (1 + np.exp(-np.clip(w[hit].sum(dtype=np.float64) + bias, -30, 30)))
            yield pd.Series(out)

    small_batches(docs.sparkSession)
    return docs.withColumn(column, F.pandas_udf(run, "double")(F.col("text").cast("string")))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    train = labelled(docs, read_table(spark, sf_dir, "labels"), "toxic", crc_mod("doc_id", 4) != 2, TRAIN_DOCS)
    out = score(docs, fit(train))
    return out.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
