"""Benchmark decontamination by a prefix-filtered set join.

Words are the runs of ASCII letters and digits and non-ASCII characters, A-Z
lower-cased. A window is ``window`` (10) consecutive item words; an item with
fewer words, but not none, is one window. Containment must be exact, so a
document that holds a window holds each of its shingles (5 words; the whole
window if it is shorter), and the rarest of them alone is a complete prefix.

1. One pass over the documents finds every place of a benchmark shingle. The
   shingle set and the benchmark's words are broadcast while there are at most
   ``broadcast_limit`` shingles (8 bytes each, five words at most); a larger
   set is joined with the exploded shingles instead.
2. Shingles are counted over all documents; each window's prefix is its rarest
   shingle (ties: smaller offset).
3. Prefix places join the windows; the shingle's offset fixes the only
   possible start, which must leave room for the window (position and length
   bounds).
4. The rest of the window's shingles are looked up at their places: a window
   occurs where all of them stand in order.

Defined results: null and empty texts have no words and are clean; items
without words are no windows; a null item_id is written as "null"; repeated
rows are judged one by one; an empty benchmark marks nothing; extra columns
are ignored by ``find`` and kept by ``clean``.
"""

from __future__ import annotations

from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, by_ids, materialize, read_table, shingle_hashes, small_batches, text_slices, words_of

WINDOW = 10
SHINGLE = 5
BROADCAST_LIMIT = 1 << 20


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """benchmark -> (item_id string, win, n_words, width, shingles array<long>)."""
    def run(batches):
        hashes = WordHashes()
        for rows, texts in text_slices(batches):
            out = {k: [] for k in ("item_id", "win", "n_words", "width", "shingles")}
            for item, text in zip(rows.column(0).to_pylist(), texts):
                words = hashes.of(words_of(text))
                if not len(words):
                    continue
                n = min(window, len(words))
                width = min(shingle, n)
                found = shingle_hashes(words, width).view(np.int64)
                for at in range(len(words) - n + 1):
                    out["item_id"].append(item)
                    out["win"].append(at)
                    out["n_words"].append(n)
                    out["width"].append(width)
                    out["shingles"].append(found[at:at + n - width + 1])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("item_id", pa.string()), ("win", pa.int64()), ("n_words", pa.int64()), ("width", pa.int64()),
                        ("shingles", pa.list_(pa.int64()))])
    b = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.col("text").cast("string").alias("text"))
    return (b.mapInArrow(run, "item_id string, win long, n_words long, width long, shingles array<long>")
            .dropDuplicates(["item_id", "width", "n_words", "shingles"])
            .withColumn("window_id", F.xxhash64("item_id", "width", "n_words", "shingles", "win")))


def benchmark_words(benchmark: DataFrame) -> DataFrame:
    """Distinct words of all items."""
    def run(batches):
        for _, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(list(set().union(*map(words_of, texts))), pa.binary())], ["word"])

    return benchmark.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word binary").distinct()


def _scan(docs: DataFrame, widths: list[int], known: dict[bytes, int] | None, wanted: np.ndarray | None) -> DataFrame:
    """documents -> (doc_id, n_words, hits array<struct<pos, width, shingle>>).

    With ``known`` (hash of each benchmark word) and ``wanted`` (sorted shingle
    hashes) only their places, looked for where enough known words follow each
    other; else all places."""
    ids = docs.schema["doc_id"].dataType

    def run(batches):
        hashes = WordHashes()
        for rows, texts in text_slices(batches):
            split = [words_of(t) for t in texts]
            counts = np.fromiter(map(len, split), np.int64, len(split))
            first = np.cumsum(counts) - counts
            total = int(counts.sum())
            if known is None:
                h = np.concatenate([*(hashes.of(w) for w in split), np.empty(0, np.uint64)])
            else:
                h = np.fromiter(chain.from_iterable(map(known.get, w, repeat(0)) for w in split), np.uint64, total)
            doc = np.repeat(np.arange(len(split)), counts)
            pos, wid, val = [], [], []
            for width in widths:
                if total < width:
                    continue
                at = np.arange(total - width + 1)
                at = at[doc[at] == doc[at + width - 1]]
                if known is not None:
                    strange = np.concatenate([[0], np.cumsum(h == 0)])
                    at = at[strange[at + width] == strange[at]]
                    parts = h[at[:, None] + np.arange(width)]
                    value = shingle_hashes(parts.reshape(-1), width)[::width] if len(at) else np.empty(0, np.uint64)
                    keep = np.isin(value, wanted)
                    at, value = at[keep], value[keep]
                else:
                    value = shingle_hashes(h, width)[at]
                pos.append(at)
                wid.append(np.full(len(at), width))
                val.append(value.view(np.int64))
            cat = lambda x: np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64)
            pos, wid, val = cat(pos), cat(wid), cat(val)
            order = np.argsort(pos, kind="stable")
            pos, wid, val = pos[order], wid[order], val[order]
            hits = pa.StructArray.from_arrays([pa.array(pos - first[doc[pos]]), pa.array(wid), pa.array(val)], ["pos", "width", "shingle"])
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc[pos], minlength=len(split)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(counts), pa.ListArray.from_arrays(pa.array(ends), hits)],
                                             ["doc_id", "n_words", "hits"])

    return (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {ids.simpleString()}, n_words long, hits array<struct<pos:long,width:long,shingle:long>>"))


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
         broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """One row per document: (doc_id, n_words, spans array<struct<start, stop>>
    of benchmark windows in it, item_ids array<string>, sorted)."""
    small_batches(docs.sparkSession)
    windows = materialize(benchmark_windows(benchmark, window, shingle), "decon-windows")
    needed = windows.select("width", F.explode("shingles").alias("shingle")).distinct()
    widths = sorted(r[0] for r in needed.select("width").distinct().collect())  # 1 to 5
    small = needed.limit(broadcast_limit + 1).count() <= broadcast_limit
    wanted = np.sort(np.array([r[0] for r in needed.select("shingle").distinct().collect()], np.int64).view(np.uint64)) if small else None
    # at most five words a shingle
    words = [bytes(r[0]) for r in benchmark_words(benchmark).collect()] if small else []
    known = dict(zip(words, WordHashes().of(words).tolist())) if small else None
    scanned = _scan(docs, widths, known, wanted).withColumn("row", F.monotonically_increasing_id())
    scanned = materialize(scanned, "decon-scan")
    hits = scanned.select("row", "n_words", F.explode("hits").alias("h")).select("row", "n_words", "h.*")
    if not small:
        hits = materialize(hits.join(needed, ["width", "shingle"], "left_semi"), "decon-hits")
    counts = hits.groupBy("width", "shingle").agg(F.count(F.lit(1)).alias("seen"))
    placed = windows.select("window_id", "item_id", F.col("n_words").alias("w_words"), "width", F.posexplode("shingles").alias("offset", "shingle"))
    # a window with a shingle that no document has cannot occur: the inner join drops
    # that shingle's row, and the window goes when rows are missing
    ranked = placed.join(counts, ["width", "shingle"])
    prefix = (ranked.groupBy("window_id", "item_id", "w_words", "width")
              .agg(F.min(F.struct("seen", "offset", "shingle")).alias("p"), F.count(F.lit(1)).alias("n"))
              .where(F.col("n") == F.col("w_words") - F.col("width") + 1)
              .select("window_id", "item_id", "w_words", "width", "n", F.col("p.offset").alias("offset"), F.col("p.shingle").alias("shingle")))
    starts = (hits.join(prefix, ["width", "shingle"])
              .withColumn("start", F.col("pos") - F.col("offset"))
              .where((F.col("start") >= 0) & (F.col("start") + F.col("w_words") <= F.col("n_words"))))
    # verification: each shingle of the window at its place; most windows hold several
    rest = (starts.join(placed.select(F.col("window_id").alias("_w"), F.col("offset").alias("_o"), F.col("shingle").alias("_s")),
                        F.col("window_id") == F.col("_w"))
            .select("row", "start", "window_id", "item_id", "w_words", "n", (F.col("start") + F.col("_o")).alias("pos"),
                    "width", F.col("_s").alias("shingle")))
    held = (rest.join(hits.select("row", "pos", "width", "shingle"), ["row", "pos", "width", "shingle"])
            .groupBy("row", "start", "window_id", "item_id", "w_words", "n").agg(F.count(F.lit(1)).alias("there"))
            .where(F.col("there") == F.col("n")))
    per_doc = held.groupBy(F.col("row").alias("_row")).agg(
        F.sort_array(F.collect_set(F.struct(F.col("start"), (F.col("start") + F.col("w_words")).alias("stop")))).alias("spans"),
        F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    none = F.array().cast("array<struct<start:long,stop:long>>")
    return (scanned.select("row", "doc_id", "n_words").join(per_doc, F.col("row") == F.col("_row"), "left")
            .select("doc_id", "n_words", F.coalesce("spans", none).alias("spans"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))


def covered(spans):
    """Words inside the union of sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("n"))
    step = lambda a, s: F.struct(F.greatest(a["to"], s["stop"]).alias("to"),
                                 (a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(a["to"], s["start"]))).alias("n"))
    return F.aggregate(spans, start, step, lambda a: a["n"])


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, all columns kept, that hold no benchmark window. Each row
    is judged by its own text (matched by a 64-bit hash), whatever its id."""
    text = F.xxhash64(F.col("text").cast("string"))
    bad = find(docs.select(text.alias("doc_id"), "text"), benchmark, **options).where(F.size("item_ids") > 0).select("doc_id").distinct()
    return by_ids(docs.withColumn("__text_hash", text), materialize(bad, "decon-bad"), "left_anti", on="__text_hash").select(*docs.columns)


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    found = find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    n_hit = covered(F.col("spans"))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


_WORDS = r"regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH doc_words AS (SELECT doc_id, {_WORDS} AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM doc_words),
doc_windows AS (
  SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS g FROM w
),
items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, words[k + 1:k + least(10, len(words))] AS g, least(10, len(words)) AS n
  FROM items, range(100000) t(k) WHERE len(words) > 0 AND k <= greatest(len(words) - 10, 0)
),
lengths AS (SELECT DISTINCT n FROM item_windows),
found AS (
  SELECT d.doc_id, d.i, x.n, x.item_id
  FROM (SELECT doc_id, i, n, g[1:n] AS g FROM doc_windows, lengths WHERE len(g) >= n) d
  JOIN item_windows x ON x.n = d.n AND x.g = d.g
),
hits AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, range(10) t(k) WHERE k < n GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit, CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items,
       sha256(COALESCE(items, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""
