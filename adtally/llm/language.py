"""Language identification by words first, backing off to character n-grams.

A known word scores its log frequency in each language; any other word scores
by its characters: at each place the longest known n-gram that ends there (4
characters, then 3, 2, 1; word edges count as characters) gives its log
frequency, and a word's score is the mean over its places times
``ngram_weight``. A text sums the scores of all its words; the highest language
wins (ties: the smaller name), and ``score`` is its share after a softmax over
scores scaled to at most ``SHARP`` words.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.

A frequency is (1 - FLOOR) n / N of the language plus FLOOR times that of all
languages together, so what a language has not seen costs every language the
same, however few rows it has.

The model is fitted on a bounded sample, about ``train_docs`` documents of each
language chosen by a seeded hash of their id (all of a language with no more);
counting is a Spark aggregation. The ``max_words`` words and ``max_grams``
n-grams most frequent in all are kept from 3 occurrences on, and besides those
at most the ``own`` most frequent words and n-grams of each length of every language,
which bounds the broadcast (8 bytes and one float per language each, some 45 MB
at 16 languages). With many languages (29 or more) both numbers shrink so that no
kind of key has more than twice ``MODEL_CELLS`` floats: 170 MB for all five kinds. Prediction is map-side over whole texts, without a shuffle.

Defined results: documents with a null id, text or language are not learned
from; a text that is null or has no letter is ``und`` with score 0; with
nothing learned every text is ``und``; repeated rows are counted and predicted
each time; an empty table gives no rows; extra columns are kept by ``predict``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (WordHashes, bounded_sample, crc_mod, materialize, mix64, read_table, small_batches, text_slices,
                     words_of)

TRAIN_DOCS = 20_000
MAX_WORDS = 100_000
MAX_GRAMS = 100_000
OWN_KEYS = 5_000
# Most (key, language) cells of a kind's common keys, and of its own ones.
MODEL_CELLS = 1 << 22
FLOOR = 0.01
MIN_COUNT = 3
LONGEST = 4
NGRAM_WEIGHT = 1.0
SHARP = 10
CACHE = 200_000
SEED = 10
LETTER = re.compile(r"[^\W\d_]")


def gram_hashes(words: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each character place of the words, spelled with an edge mark on both
    sides: its word's number, and the hash of the n-gram that ends there for n
    = 1..LONGEST (0 where it would leave the word)."""
    marked = [f" {w.decode(errors='replace')} " for w in words]
    chars = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    word = np.repeat(np.arange(len(marked)), sizes)
    place = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found, h = [], np.zeros(len(chars), np.uint64)
    for n in range(1, LONGEST + 1):
        back = np.zeros(len(chars), np.uint64)
        back[n - 1:] = chars[:len(chars) - n + 1]
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + back + np.uint64(n))
        found.append(np.where(place >= n - 1, h, np.uint64(0)))
    inner = place > 0  # the leading mark alone says nothing
    return word[inner], [x[inner] for x in found]


def _count(batches):
    """(lang, kind, key, n): kind 0 for words, n for n-grams, summed per slice."""
    hashes = WordHashes()
    for rows, texts in text_slices(batches):
        per: dict[str, Counter] = {}
        for lang, text in zip(rows.column(0).to_pylist(), texts):
            per.setdefault(lang, Counter()).update(words_of(text))
        out: dict[str, list] = {"lang": [], "kind": [], "key": [], "n": []}

        def put(lang, kind, keys, n):
            out["lang"].extend([lang] * len(keys))
            out["kind"].extend([kind] * len(keys))
            out["key"].append(keys.view(np.int64))
            out["n"].append(n)

        for lang, counts in per.items():
            words, n = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
            put(lang, 0, hashes.of(words), n)
            word, grams = gram_hashes(words)
            for size, g in enumerate(grams, 1):
                there = g != 0
                keys, at = np.unique(g[there], return_inverse=True)
                put(lang, size, keys, np.bincount(at, n[word[there]], len(keys)).astype(np.int64))
        cat = lambda x: np.concatenate([*x, np.empty(0, np.int64)])
        yield pa.RecordBatch.from_pydict({"lang": out["lang"], "kind": out["kind"], "key": cat(out["key"]), "n": cat(out["n"])},
                                         schema=pa.schema([("lang", pa.string()), ("kind", pa.int64()), ("key", pa.int64()), ("n", pa.int64())]))


class Model:
    """Sorted keys per kind (0: words, 1..: n-grams) with a row of log
    frequencies, one per language."""

    def __init__(self, langs: list[str], tables: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.langs, self.tables = langs, tables

    def rows(self, words: list[bytes], hashes: WordHashes) -> np.ndarray:
        """Score of each word in each language."""
        keys, table = self.tables[0]
        h = hashes.of(words)
        out = np.zeros((len(words), len(self.langs)), np.float32)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        known = keys[at] == h
        out[known] = table[at[known]]
        unseen = np.flatnonzero(~known)
        if len(unseen):
            word, grams = gram_hashes([words[i] for i in unseen])
            score, open_ = np.zeros((len(word), len(self.langs)), np.float32), np.ones(len(word), bool)
            for n in range(LONGEST, 0, -1):
                keys, table = self.tables[n]
                if not len(keys):
                    continue
                at = np.minimum(np.searchsorted(keys, grams[n - 1]), len(keys) - 1)
                hit = open_ & (keys[at] == grams[n - 1])
                score[hit] = table[at[hit]]
                open_ &= ~hit
            size = np.bincount(word, minlength=len(unseen))[:, None]
            sums = np.stack([np.bincount(word, score[:, j], len(unseen)) for j in range(len(self.langs))], 1)
            out[unseen] = NGRAM_WEIGHT * sums / size
        return out


def fit(rows: DataFrame, train_docs: int = TRAIN_DOCS, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS,
        own: int = OWN_KEYS) -> Model | None:
    """Model from (doc_id, text, lang); None if there is nothing to learn."""
    small_batches(rows.sparkSession)
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sample = bounded_sample(rows.select("doc_id", "text", "lang"), train_docs, SEED, "lang")
    counts = (sample.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
              .mapInArrow(_count, "lang string, kind long, key long, n long")
              .groupBy("kind", "key", "lang").agg(F.sum("n").alias("n")))
    counts = materialize(counts, "lang-counts")
    totals = {(r["kind"], r["lang"]): r["n"] for r in counts.groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted({lang for _, lang in totals})
    if not langs:
        return None
    # at most MODEL_CELLS cells of a kind for the common keys and as many for the languages' own
    own = max(1, min(own, MODEL_CELLS // len(langs) ** 2))
    common = max(1, MODEL_CELLS // len(langs))
    # the most frequent keys of each language and kind: where a histogram of (count, 1/64 of the keys) reaches ``own``
    place = F.struct((-F.col("n")).alias("n"), F.pmod("key", F.lit(64)).alias("part"))
    steps = counts.select("kind", "lang", place.alias("place")).groupBy("kind", "lang", "place").agg(F.count(F.lit(1)).alias("k"))
    so_far = F.sum("k").over(Window.partitionBy("kind", "lang").orderBy("place"))
    last = steps.withColumn("k", so_far).where(F.col("k") <= own).groupBy("kind", "lang").agg(F.max("place").alias("last"))
    last = materialize(last, "lang-own")  # a row for each language and kind
    mine = counts.join(F.broadcast(last), ["kind", "lang"], "left").withColumn("own", F.coalesce(place <= F.col("last"), F.lit(False)))
    keys = materialize(mine.groupBy("kind", "key").agg(F.sum("n").alias("all"), F.max("own").alias("own"),
                                                       F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
                       .where((F.col("all") >= MIN_COUNT) | F.col("own")), "lang-keys")
    columns = ["key", "all", *[F.coalesce(F.col("by")[lang], F.lit(0)).alias(f"n{i}") for i, lang in enumerate(langs)]]
    tables = {}
    for kind in range(LONGEST + 1):
        most = min(common, max_words if kind == 0 else max_grams // LONGEST)
        there = keys.where(F.col("kind") == kind)
        kept = pd.concat([there.where(F.col("all") >= MIN_COUNT).orderBy(F.desc("all"), "key").limit(most).select(*columns).toPandas(),
                          there.where("own").select(*columns).toPandas()]).drop_duplicates("key")
        k = kept["key"].to_numpy(np.int64).view(np.uint64)
        n = kept[[f"n{i}" for i in range(len(langs))]].to_numpy(np.float64)
        total = np.array([totals.get((kind, lang), 0) for lang in langs], float)
        share = kept["all"].to_numpy(np.float64)[:, None] / max(1.0, total.sum())
        order = np.argsort(k)
        tables[kind] = (k[order], np.log((1 - FLOOR) * n / np.maximum(total, 1) + FLOOR * share).astype(np.float32)[order])
    return Model(langs, tables) if any(len(k) for k, _ in tables.values()) else None


class WordScores:
    """Rows of ``model`` by word, kept in one growing table and started afresh
    when it holds ``CACHE`` words."""

    def __init__(self, model: Model):
        self.model, self.hashes, self.at = model, WordHashes(), {}
        self.table = np.zeros((1024, len(model.langs)), np.float32)

    def of(self, words: list[bytes]) -> np.ndarray:
        new = list({w for w in words if w not in self.at})
        if len(self.at) + len(new) > CACHE:
            self.at, new = {}, list(set(words))
        used, need = len(self.at), len(self.at) + len(new)
        if need > len(self.table):
            self.table = np.concatenate([self.table[:used], np.zeros((max(need, 2 * used) - used, self.table.shape[1]), np.float32)])
        if new:
            self.table[used:need] = self.model.rows(new, self.hashes)
            self.at.update(zip(new, range(used, need)))
        return self.table[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))]


def predict(docs: DataFrame, model: Model | None, column: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with all columns, the predicted language and its share."""
    small_batches(docs.sparkSession)

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scores = WordScores(model) if model else None
        for texts in series:
            out = []
            for text in texts:
                words = words_of(text.encode()) if scores and text and LETTER.search(text) else []
                if not words:
                    out.append(("und", 0.0))
                    continue
                total = scores.of(words).sum(0, dtype=np.float64) * min(1.0, SHARP / len(words))
                best = int(np.argmax(total))
                out.append((model.langs[best], float(1 / np.exp(total - total[best]).sum())))
            yield pd.DataFrame(out, columns=["name", "share"])

    found = F.pandas_udf(run, "name string, share double")(F.col("text").cast("string"))
    return (docs.withColumn("__lang", found).withColumn(column, F.col("__lang.name"))
            .withColumn(score, F.col("__lang.share")).drop("__lang"))


def op10_language(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(crc_mod("doc_id", 5) != 0))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
