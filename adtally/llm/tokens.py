"""Token-id output: Parquet files with list columns, and selective reads.

``write`` range-partitions the documents by id and a hash of the text, tokenizes
each part and writes one row per document in ascending id order (null first;
equal ids by that hash, then by text):

    doc_id, part, at, n_tokens, ids list<int32>

Layout: token ids are dictionary-encoded (at most the vocabulary's 49,408
values, so about 2 bytes each before zstd), ``doc_id`` and the counts are
delta-encoded (Parquet v2 pages, no dictionary), row groups and pages have set
sizes, and Parquet's column and page indexes let a reader fetch some columns
of some ids only. ``at`` is the number of ids before the row in its part;
``start`` (ids of all documents before) is ``at`` and the sizes of the parts
before, which the metadata columns give without touching the ids.

The tokenizer normalises, splits and merges inside white-space-separated words
only, and there inside the pieces of its own split, so ids do not depend on
neighbours: they are cached, within bounds, by piece in plain Latin texts and by
word in all others.

Defined results: a null or empty text has only the end id; repeated rows are
documents of their own; an empty table gives an empty file set; extra columns
are ignored by ``write`` and carried by ``keep``.
"""

from __future__ import annotations

import re
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import shared_dir
from .common import CACHE_WORDS, SLICE_BYTES, per_worker, read_table, small_batches, text_slices

END_ID = 1
# Pieces whose ids a worker remembers; the same, and bytes of text that a step
# holds, where nothing is kept between tasks.
CACHE_PIECES = 500_000
TASK_PIECES = 100_000
TASK_BYTES = 1 << 20
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
# A plain text: printable ASCII, ASCII white space and the letters of Latin-1.
# There NFC changes nothing, lower case is per character, and the tokenizer's
# own split (fixed value, below, for lower case) is the same in ``re``.
ODD = re.compile(r"[^\t-\r -~À-ÖØ-öø-ÿ]")
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


class WordIds:
    """Token ids of texts, cached by piece (plain texts) or by word (others),
    of each about ``most``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, at in vocabulary.items():
            self.last[at] = token.endswith("</w>")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.most = CACHE_PIECES
        self.forget()

    def forget(self) -> None:
        self.pieces: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def learn_pieces(self, used: list[list[str]]) -> None:
        if len(self.pieces) > self.most:  # frequent pieces are learned early: half of these stay
            self.pieces = dict(islice(self.pieces.items(), self.most // 2))
        need = list(set().union(*used) - self.pieces.keys())
        for at in range(0, len(need), 4096):  # many in one string: each ends with its first end-of-word token
            some = need[at:at + 4096]
            # without the offsets, which nothing here reads
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
            if len(ends) == len(some):
                raw = ids.tobytes()
                self.pieces.update(zip(some, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends))))
            else:
                self.pieces.update((piece, self.whole(piece)) for piece in some)

    def by_words(self, text: bytes) -> bytes:
        if len(self.words) > min(self.most, CACHE_WORDS):
            self.words.clear()
        words = text.split()
        for word in set(words):
            if word not in self.words:
                self.words[word] = self.whole(word.decode())
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        found: list = []
        for t in texts:
            text = (t or b"").decode()
            plain = not ODD.search(text) and not any(s in text for s in self.special)
            found.append(PIECE.findall(text.lower()) if plain else t)
        self.learn_pieces([f for f in found if isinstance(f, list)])
        end = np.uint32(END_ID).tobytes()
        get = self.pieces.__getitem__
        return [np.frombuffer((b"".join(map(get, f)) if isinstance(f, list) else self.by_words(f)) + end, np.uint32) for f in found]


def encoder(tokenizer_path: str, kept: list[str], reuse: bool):
    """What a task of ``write`` does with its (doc_id, part, text, *kept) rows."""
    def run(batches):
        coder = per_worker(("ids", tokenizer_path), lambda: WordIds(tokenizer_path))
        coder.most = CACHE_PIECES if reuse else TASK_PIECES
        before = 0  # a task writes one part
        for rows, texts in text_slices(batches, limit=SLICE_BYTES if reuse else TASK_BYTES):
            found = coder.encode(texts)
            sizes = np.fromiter(map(len, found), np.int32, len(found))
            ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
            values = pa.array(np.concatenate([*found, np.empty(0, np.uint32)]).view(np.int32))
            at = pa.array(before + ends[:-1].astype(np.int64))
            before += int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), at, pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends), values),
                 *[rows.column(3 + i) for i in range(len(kept))]], ["doc_id", "part", "at", "n_tokens", "ids", *kept])
        if not reuse:
            coder.forget()
    return run


def write(docs: DataFrame, path: str, tokenizer_path: str, parts: int | None = None, keep: tuple[str, ...] = (),
          reuse: bool = False) -> None:
    """Tokenize ``docs`` into ``path`` in ascending doc_id order. ``parts``:
    how many files; by default as many as adaptive execution finds fit.
    ``reuse``: Python workers keep the cached ids from task to task, which
    saves CPU and costs some 150 MB a worker until it ends; else they keep the
    tokenizer only, cache fewer ids and hold less text at a time."""
    small_batches(docs.sparkSession)
    ids = docs.schema["doc_id"].dataType.simpleString()
    kept = [f"k_{k}" for k in keep]
    schema = f"doc_id {ids}, part int, at long, n_tokens int, ids array<int>" + "".join(
        f", {n} {docs.schema[k].dataType.simpleString()}" for n, k in zip(kept, keep))

    x = docs.select("doc_id", F.col("text").cast("string").alias("text"), *[F.col(k).alias(n) for n, k in zip(kept, keep)])
    by = ["doc_id", F.xxhash64("text")]
    x = x.repartitionByRange(parts, *by) if parts else x.repartitionByRange(*by)
    x = (x.sortWithinPartitions(*by, "text", *kept)
         .select("doc_id", F.spark_partition_id().alias("part"), "text", *kept))
    (x.mapInArrow(encoder(tokenizer_path, kept, reuse), schema).write
     .option("compression", "zstd")
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", "false")
     .option("parquet.enable.dictionary#ids.list.element", "true")
     .option("parquet.dictionary.page.size", str(1 << 20))
     .option("parquet.block.size", str(ROW_GROUP_BYTES))
     .option("parquet.page.size", str(PAGE_BYTES))
     .option("parquet.page.row.count.limit", str(PAGE_ROWS))
     .parquet(path))


def read(spark: SparkSession, path: str, columns: list[str] | None = None, first: int | None = None,
         last: int | None = None) -> DataFrame:
    """Token rows, only ``columns`` and only ids from ``first`` to ``last``:
    both reach the scan (column pruning, row-group and page indexes)."""
    df = spark.read.parquet(path)
    if first is not None:
        df = df.where(F.col("doc_id") >= first)
    if last is not None:
        df = df.where(F.col("doc_id") <= last)
    return df.select(*columns) if columns else df


def offsets(spark: SparkSession, path: str) -> DataFrame:
    """(part, offset): ids in all parts before, one row per part, from the
    metadata columns alone."""
    sums = spark.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("offset"))


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, part, n_tokens, start) from the metadata columns alone."""
    meta = spark.read.parquet(path).select("doc_id", "part", "at", "n_tokens")
    return meta.join(offsets(spark, path), "part").select("doc_id", "part", "n_tokens", (F.col("at") + F.col("offset")).alias("start"))


def digest(df: DataFrame) -> DataFrame:
    """Adds ids_crc32 of each row's ids as little-endian unsigned 32-bit integers."""
    def run(batches):
        for b in batches:
            col = b.column(b.schema.get_field_index("ids"))
            ends, values = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            raw, crcs = memoryview(np.ascontiguousarray(values)).cast("B"), []
            for i in range(b.num_rows):
                crcs.append(zlib.crc32(raw[4 * int(ends[i]):4 * int(ends[i + 1])]))
            keep = [i for i, f in enumerate(b.schema) if f.name != "ids"]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in keep], pa.array(crcs, pa.int64())],
                                             [*[b.schema.names[i] for i in keep], "ids_crc32"])

    fields = [f for f in df.schema.fields if f.name != "ids"]
    return df.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", ids_crc32 long")


def with_starts(spark: SparkSession, path: str, extra: list[str] | None = None) -> DataFrame:
    """The files' rows as (doc_id, start, n_tokens, ids_crc32, *extra); the ids
    are read once."""
    rows = digest(read(spark, path, ["doc_id", "part", "at", "n_tokens", "ids", *(extra or [])]))
    return (rows.join(F.broadcast(offsets(spark, path)), "part")  # a row per file
            .select("doc_id", (F.col("at") + F.col("offset")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32", *(extra or [])))


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_output(spark, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "llm-tokens")
    write(read_table(spark, sf_dir, "documents"), path, tokenizer_file(), reuse=True)
    return with_starts(spark, path)
