"""Quality: ordinal cumulative-link (proportional odds) regression.

Grades 0 < 1 < ... < K-1 share one weight vector over hashed text features:
P(grade >= k | x) = sigmoid(w.x - t_k) with ordered thresholds t_1 < ... <
t_{K-1} (kept in order as t_1 plus positive steps). Output per document: the
tail probability P(grade >= ``select_grade``), the expected grade (the sum of
all tails) and whether the tail reaches ``select_tail``.

Features: hashed white-space words, word pairs and word shapes (letters as a or
A, digits as 0, other bytes as they are, runs once) in ``2^BITS`` places, each
by the square root of its share of the text, so that a text's length does not
matter.

Fitted in one task on a bounded sample (about ``train_docs`` graded documents
chosen by a seeded hash of their id) with per-coordinate AdaGrad steps; the
weights (2^BITS floats, 1 MB) are all that is broadcast. Scoring is map-side
over whole texts, without a shuffle.

Defined results: null grades and ids are not learned from; rows with
disagreeing grades for one id are left out; null and empty texts have no
features and are judged by the thresholds alone; with no or only one grade
learned, every document gets that grade (0 without any); repeated rows are
scored each; an empty table gives no rows; extra columns are kept by ``score``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (WordHashes, bounded_sample, crc_mod, materialize, mix64, read_table, shingle_hashes,
                     small_batches, text_slices)
from .toxicity import labelled

BITS = 18
TRAIN_DOCS = 20_000
EPOCHS = 5
RATE = 0.3
L2 = 1e-6
SCALE = 2.0
SELECT_GRADE = 2
SELECT_TAIL = 0.5
SEED = 5
SHAPE = bytes(48 if 48 <= b <= 57 else 65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 0x80 else b for b in range(256))
RUNS = re.compile(rb"(.)\1+", re.S)


class Shapes(WordHashes):
    """word -> hash of its shape."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(RUNS.sub(rb"\1", word.translate(SHAPE)), seed=1)
        return value


class Features:
    def __init__(self):
        self.words, self.shapes = WordHashes(), Shapes()

    def of(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """(places, values) of one text."""
        words = (text or b"").split()
        h = self.words.of(words)
        places = np.concatenate([mix64(h), shingle_hashes(h, 2), mix64(self.shapes.of(words))]) >> np.uint64(64 - BITS)
        at, n = np.unique(places.astype(np.int64), return_counts=True)
        return at, SCALE * np.sqrt(n / max(1, len(words)))


def _featurize(batches):
    features = Features()
    for rows, texts in text_slices(batches):
        found = [features.of(t) for t in texts]
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([a.astype(np.int32).tobytes() for a, _ in found], pa.binary()),
                                          pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary())],
                                         ["label", "places", "values"])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(rows: list, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) from (grade, places, values) rows."""
    w, seen = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6)
    # thresholds start at the grades' own log odds
    share = np.clip([np.mean([g >= k for g, _, _ in rows]) for k in range(1, grades)], 1e-3, 1 - 1e-3)
    t = np.log((1 - share) / share)
    t = np.maximum.accumulate(t + np.arange(len(t)) * 1e-3)
    t_seen = np.full(len(t), 1.0)
    rng = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            g, at, v = rows[i]
            s = w[at] @ v
            # likelihood of the interval between the two thresholds around grade g
            hi = sigmoid(s - t[g - 1]) if g else 1.0
            lo = sigmoid(s - t[g]) if g < len(t) else 0.0
            p = max(hi - lo, 1e-9)
            dhi, dlo = hi * (1 - hi), lo * (1 - lo)
            grad = -(dhi - dlo) / p
            gw = grad * v + L2 * w[at]
            seen[at] += gw * gw
            w[at] -= RATE * gw / np.sqrt(seen[at])
            for k, d in ((g - 1, dhi / p), (g, -dlo / p)):
                if 0 <= k < len(t):
                    t_seen[k] += d * d
                    t[k] -= 0.1 * d / np.sqrt(t_seen[k])
            np.maximum.accumulate(t, out=t)  # ordered
    return w, t


def fit(rows: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) from (doc_id, text, label: grade 0, 1, ...)."""
    small_batches(rows.sparkSession)
    sample = bounded_sample(rows, train_docs, SEED)
    places = materialize(sample.select("label", "text").mapInArrow(_featurize, "label long, places binary, values binary"), "quality-places")
    top = places.agg(F.max("label")).first()[0]
    if not top:  # nothing graded, or grade 0 alone
        return np.zeros(1 << BITS, np.float32), np.empty(0)

    def run(batches):
        held = [(g, np.frombuffer(p, np.int32).astype(np.int64), np.frombuffer(v, np.float32).astype(float)) for b in batches
                for g, p, v in zip(*(b.column(i).to_pylist() for i in range(3)))]
        w, t = train(held, top + 1)
        yield pa.RecordBatch.from_arrays([pa.array([w.astype(np.float32).tobytes()]), pa.array([t.tobytes()])], ["w", "t"])

    # bounded by train_docs; sorted, so that the order of tasks does not matter
    w, t = places.repartition(1).sortWithinPartitions("places", "values", "label").mapInArrow(run, "w binary, t binary").first()
    return np.frombuffer(w, np.float32), np.frombuffer(t)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], select_grade: int = SELECT_GRADE, select_tail: float = SELECT_TAIL) -> DataFrame:
    """``docs`` with all columns, expected_grade, tail_prob and selected."""
    small_batches(docs.sparkSession)
    weights, thresholds = model

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        features = Features()
        for texts in series:
            out = []
            for text in texts:
                at, v = features.of(text.encode() if text else None)
                tails = sigmoid(float(weights[at] @ v) - thresholds)
                out.append((float(tails.sum()), float(tails[select_grade - 1]) if select_grade <= len(tails) else 0.0))
            yield pd.DataFrame(out, columns=["grade", "tail"])

    found = F.pandas_udf(run, "grade double, tail double")(F.col("text").cast("string"))
    return (docs.withColumn("__graded", found).withColumn("expected_grade", F.col("__graded.grade"))
            .withColumn("tail_prob", F.col("__graded.tail")).drop("__graded")
            .withColumn("selected", F.col("tail_prob") >= select_tail))


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 low quality, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2)
    return labels.select("doc_id", F.when(F.col("quality").isNotNull(), grade).alias("grade"))


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """Every document's expected grade and tail probability; learned from graded
    rows whose id is not 3 modulo 4 in its crc32 (``held_out``)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = labelled(docs, graded(read_table(spark, sf_dir, "labels")), "grade", crc_mod("doc_id", 4) != 3, TRAIN_DOCS, SEED)
    out = score(docs, fit(rows))
    return out.select("doc_id", (crc_mod("doc_id", 4) == 3).alias("held_out"), "expected_grade", "tail_prob", "selected")
