"""Cross-tokenizer alignment: which tokens of tokenizer A and of tokenizer B
cover the same bytes of a text, and how often an id pair does so corpus-wide.

Both tokenizations of a text are cut from the same bytes (a space and the
text). A token-byte incidence matrix has a row per token and a column per
byte; it is held in compressed rows (``Csr``, built by hand from the tokens'
byte lengths). ``product`` is Gustavson's row-by-row product: row i of A picks
the rows of Bᵀ its bytes name and sums them, so A·Bᵀ has an entry, the number
of shared bytes, for every overlapping token pair: the links. Offsets at which
both tokenizations end a token cut the text into groups; the product of the
group incidences gives the pairs that share a group (``shared_links``, row
blocks at a time, so a long group is never expanded whole).

Plan: one map pass encodes slices of texts and keeps, per slice, the distinct
id pairs with their number of documents, and per document which of them it
holds how often. Pairs are counted by one shuffle of the slices' distinct
pairs; the counts return to the slices. An id pair of every document is so one
row per slice. The highest count of an A id is a table of at most the
vocabulary's 50,257 rows, which is broadcast.

Defined results: null or empty texts, and texts that a tokenizer does not give
back byte for byte, have no tokens: zeros, an empty string, a shared-link
count of 0. Repeated rows and null or repeated ids are documents of their own
(no step is keyed by doc_id). An empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import CACHE_WORDS, discard, materialize, per_worker, read_table, small_batches, text_slices
from .tokens import tokenizer_file

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Bytes of text in a slice.
SLICE = 2 << 20
# A plain text: printable ASCII, ASCII white space and the letters of Latin-1.
ODD = re.compile(r"[^\t-\r -~À-ÖØ-öø-ÿ]")
# A's own split (fixed value) for plain texts.
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\s+(?!\S)|\s+")
RUN = re.compile(" +[^ ]*")
# Entries of a product that ``shared_links`` expands at a time.
BLOCK_LINKS = 1 << 20


class Csr:
    """A 0/1 matrix in compressed rows: row i has the columns
    ``cols[ptr[i]:ptr[i + 1]]``."""

    def __init__(self, ptr: np.ndarray, cols: np.ndarray, n_cols: int):
        self.ptr, self.cols, self.n_cols = ptr, cols, n_cols

    @classmethod
    def runs(cls, lengths: np.ndarray) -> "Csr":
        """Row i has the next ``lengths[i]`` columns."""
        ptr = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        return cls(ptr, np.arange(ptr[-1], dtype=np.int32), int(ptr[-1]))

    def transposed(self) -> "Csr":
        rows = np.repeat(np.arange(len(self.ptr) - 1, dtype=np.int32), np.diff(self.ptr))
        if (self.cols[1:] < self.cols[:-1]).any():
            rows = rows[np.argsort(self.cols, kind="stable")]
        ptr = np.concatenate([[0], np.cumsum(np.bincount(self.cols, minlength=self.n_cols))])
        return Csr(ptr, rows, len(self.ptr) - 1)

    def rows(self, lo: int, hi: int) -> "Csr":
        return Csr(self.ptr[lo:hi + 1] - self.ptr[lo], self.cols[self.ptr[lo]:self.ptr[hi]], self.n_cols)


def product(a: Csr, bt: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gustavson's product: (row, column, value) of A·Bᵀ's entries in order."""
    owner = np.repeat(np.arange(len(a.ptr) - 1), np.diff(a.ptr))
    if len(bt.cols) == len(bt.ptr) - 1 and (np.diff(bt.ptr) == 1).all():  # one entry in each row of Bᵀ
        row, col = owner, bt.cols[a.cols]
    else:
        width = bt.ptr[a.cols + 1] - bt.ptr[a.cols]
        row = np.repeat(owner, width)
        first = np.repeat(bt.ptr[a.cols] - (np.cumsum(width) - width), width)
        col = bt.cols[first + np.arange(len(row))]
    key = row * max(bt.n_cols, 1) + col
    if len(key) and (key[1:] < key[:-1]).any():
        key.sort()
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    value = np.diff(np.append(new, len(key)))
    return key[new] // max(bt.n_cols, 1), key[new] % max(bt.n_cols, 1), value


def group_of(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group number of each A and of each B token."""
    a_end, b_end = np.cumsum(a_len, dtype=np.int64), np.cumsum(b_len, dtype=np.int64)
    cuts = np.intersect1d(a_end, b_end, assume_unique=True)
    return np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)


def shared_links(a_group: np.ndarray, b_group: np.ndarray, block: int = BLOCK_LINKS):
    """Yields blocks (A token, B token) of the pairs that share a group."""
    n = int(max([-1, *a_group[-1:], *b_group[-1:]])) + 1
    one = lambda g: Csr(np.arange(len(g) + 1), g, n)
    a, bt = one(a_group), one(b_group).transposed()
    ends = np.cumsum(np.diff(bt.ptr)[a_group]) if len(a_group) else np.empty(0, np.int64)
    at = 0
    while at < len(a_group):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + block, "right")))
        row, col, _ = product(a.rows(at, to), bt)
        yield row + at, col
        at = to


def arrays(ids: list[bytes | None]) -> list[np.ndarray | None]:
    return [None if x is None else np.frombuffer(x, np.int32) for x in ids]


class Pair:
    """Both tokenizers, and the bytes of their entries.

    Neither merges across the borders of its own split, so ids are cached: A's
    by the pieces of its split (in texts of plain Latin characters, where the
    split is the same in ``re``), B's by runs of spaces with what follows (if no
    entry has a space behind another character). A cached string's tokens are
    checked to give its bytes back; texts with others are encoded whole."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        # the byte-level alphabet: printable Latin-1 stands for itself, all other bytes for U+0100 onward
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(plain))}
        size = self.a.get_vocab_size()
        self.a_bytes = [b""] * size
        for token, at in self.a.get_vocab().items():
            self.a_bytes[at] = bytes(shown[c] for c in token) if all(c in shown for c in token) else token.encode()
        b = self.b
        self.b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(b.get_piece_size())]
        self.split_b = not any(b" " in t.lstrip(b" ") for t in self.b_bytes)
        self.a_len, self.b_len = (np.fromiter(map(len, t), np.int32, len(t)) for t in (self.a_bytes, self.b_bytes))
        # an id as text behind each of the marks that may stand before it
        text = lambda n, marks: np.array([m + b"%d" % i for m in marks for i in range(n)], object)
        self.a_text, self.b_text = text(size, (b"", b",", b";")), text(len(self.b_bytes), (b"|", b","))
        self.a_known: dict[str, bytes | None] = {}
        self.b_known: dict[str, bytes | None] = {}

    def bytes_a(self, texts: list[str]) -> list[bytes | None]:
        """The ids of each text as 32-bit integers, None if they don't give its bytes back."""
        out = []
        for t, e in zip(texts, self.a.encode_batch_fast(texts, add_special_tokens=False)):
            ids = e.ids
            out.append(array("i", ids).tobytes() if b"".join([self.a_bytes[i] for i in ids]) == t.encode() else None)
        return out

    def bytes_b(self, texts: list[str]) -> list[bytes | None]:
        """The same; texts start with the space that B puts before them itself."""
        return [array("i", ids).tobytes() if b"".join([self.b_bytes[i] for i in ids]) == t.encode() else None
                for t, ids in zip(texts, self.b.encode([t[1:] for t in texts], num_threads=1))]

    def whole_a(self, texts: list[str]) -> list[np.ndarray | None]:
        return arrays(self.bytes_a(texts))

    def whole_b(self, texts: list[str]) -> list[np.ndarray | None]:
        return arrays(self.bytes_b(texts))

    def by_parts(self, texts: list[str], parts: list[list[str] | None], known: dict, whole) -> list[np.ndarray | None]:
        if len(known) > CACHE_WORDS:  # the half learned first stays: it has the frequent ones
            for p in list(islice(known, CACHE_WORDS // 2, None)):
                del known[p]
        need = list(set().union(*[p for p in parts if p is not None]).difference(known))
        for at in range(0, len(need), 4096):
            some = need[at:at + 4096]
            known.update(zip(some, whole(some)))
        out: list = [None] * len(texts)
        rest = []
        for i, p in enumerate(parts):
            try:
                out[i] = None if p is None else b"".join(map(known.__getitem__, p))
            except TypeError:  # a part that has no tokens
                pass
            if out[i] is None:
                rest.append(i)
        for i, ids in zip(rest, whole([texts[i] for i in rest]) if rest else ()):
            out[i] = ids
        return arrays(out)

    def encode(self, texts: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """(A ids, B ids) of each text, None without tokens."""
        out: list = [None] * len(texts)
        full = [i for i, t in enumerate(texts) if t]
        plain = [" " + texts[i].decode() for i in full]
        a = self.by_parts(plain, [None if ODD.search(t) else SPLIT.findall(t) for t in plain], self.a_known, self.bytes_a)
        b = self.by_parts(plain, [RUN.findall(t) if self.split_b else None for t in plain], self.b_known, self.bytes_b)
        for i, x, y in zip(full, a, b):
            if x is not None and y is not None:
                out[i] = x, y
        return out


def align(pair: Pair, texts: list[bytes | None]) -> dict:
    """Links, groups and digests of a slice of texts. Texts lie behind one
    another in one byte range: each starts and ends a group."""
    found = pair.encode(texts)
    n = len(texts)
    a_n, b_n = (np.array([len(f[k]) if f else 0 for f in found], np.int64) for k in (0, 1))
    a, b = (np.concatenate([np.empty(0, np.int32), *[f[k] for f in found if f]]) for k in (0, 1))
    a_len, b_len = pair.a_len[a], pair.b_len[b]
    a_group, b_group = group_of(a_len, b_len)
    row, col, _ = product(Csr.runs(a_len), Csr.runs(b_len).transposed())
    doc_a = np.repeat(np.arange(n), a_n)
    groups = int(a_group[-1]) + 1 if len(a) else 0
    a_in, b_in = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    group_doc = doc_a[np.cumsum(a_in) - 1] if groups else np.empty(0, np.int64)
    # the digests' texts: tokens with the mark before them, in the order group, side
    new = lambda x: np.concatenate([[True], x[1:] != x[:-1]])[:len(x)]
    a_mark = new(a_group).astype(np.int64) + 1 - 2 * new(doc_a)
    merged = np.empty(len(a) + len(b), object)
    merged[np.arange(len(a)) + (np.cumsum(b_in) - b_in)[a_group]] = pair.a_text[a + a_mark * len(pair.a_bytes)]
    merged[np.arange(len(b)) + np.cumsum(a_in)[b_group]] = pair.b_text[b + (~new(b_group)) * len(pair.b_bytes)]
    ends = np.concatenate([[0], np.cumsum(a_n + b_n)])
    digests = [hashlib.sha256(b"".join(merged[ends[i]:ends[i + 1]].tolist())).hexdigest() if found[i] else "" for i in range(n)]
    link_doc = doc_a[row]
    return {"n_a": a_n, "n_b": b_n, "n_groups": np.bincount(group_doc, minlength=n), "n_links": np.bincount(link_doc, minlength=n),
            "n_shared": np.bincount(group_doc, a_in * b_in, minlength=n).astype(np.int64) if groups else np.zeros(n, np.int64),
            "groups_sha256": digests, "link_doc": link_doc, "pair": a[row].astype(np.int64) << 32 | b[col]}


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_shared")


def _slices(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document its numbers and (``idx``, ``times``) into its slice's
    distinct pairs; per slice a row with those pairs and their documents."""
    ids = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {ids}, slice long, {', '.join(f'{c} long' for c in NUMBERS)}, groups_sha256 string, "
              "idx array<int>, times array<int>, pairs array<long>, pair_docs array<int>")

    def run(batches):
        at = 0
        for rows, texts in text_slices(batches, limit=SLICE):
            x = align(per_worker(("pair", a_path, b_path), lambda: Pair(a_path, b_path)), texts)
            n = rows.num_rows
            pairs, inverse = np.unique(x["pair"], return_inverse=True)
            held, times = np.unique(x["link_doc"] * max(len(pairs), 1) + inverse, return_counts=True)
            doc, idx = held // max(len(pairs), 1), (held % max(len(pairs), 1)).astype(np.int32)
            cut = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
            number = rows.column(1)[0].as_py() << 32 | at
            at += 1
            ints = lambda v, t=pa.int64(): pa.array(v, t)
            lists = lambda v: pa.ListArray.from_arrays(pa.array(cut), pa.array(v.astype(np.int32)))
            names = ["doc_id", "slice", *NUMBERS, "groups_sha256", "idx", "times", "pairs", "pair_docs"]
            none = lambda kind: pa.nulls(n, pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), ints([number] * n), *[ints(x[c]) for c in NUMBERS], pa.array(x["groups_sha256"], pa.string()),
                 lists(idx), lists(times), none(pa.int64()), none(pa.int32())], names)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, rows.column(0).type), ints([number]), *[pa.nulls(1, pa.int64()) for _ in NUMBERS], pa.nulls(1, pa.string()),
                 pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int32())), pa.array([pairs], pa.list_(pa.int64())),
                 pa.array([np.bincount(idx, minlength=len(pairs)).astype(np.int32)], pa.list_(pa.int32()))], names)

    x = docs.select("doc_id", F.spark_partition_id().cast("long").alias("part"), F.col("text").cast("string").alias("text"))
    return x.mapInArrow(run, schema)


def pair_counts(slices: DataFrame) -> DataFrame:
    """(slice, at, pair, count): the slices' pairs with the number of documents
    of all slices that hold them."""
    each = (slices.where(F.col("pairs").isNotNull())
            .select("slice", F.explode(F.arrays_zip("pairs", "pair_docs")).alias("p"), )
            .select("slice", F.col("p.pairs").alias("pair"), F.col("p.pair_docs").cast("long").alias("n")))
    return each.select("slice", "pair", F.sum("n").over(Window.partitionBy("pair")).alias("count"))


def alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of ``docs``: doc_id, the numbers of tokens, groups, links and
    same-group pairs, ``n_best``, ``count_sum`` and ``groups_sha256``."""
    small_batches(docs.sparkSession)
    slices = materialize(_slices(docs, a_path, b_path), "align-slices")
    counts = materialize(pair_counts(slices), "align-counts")
    # at most one row for each entry of A's vocabulary
    highest = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("count").alias("most"))
    marked = (counts.join(F.broadcast(highest), F.shiftright("pair", 32) == F.col("a"))
              .select("slice", "pair", (F.col("count") * 2 + (F.col("count") == F.col("most")).cast("long")).alias("value")))
    # pairs of a slice are distinct and were numbered in ascending order
    answers = (marked.groupBy("slice").agg(F.array_sort(F.collect_list(F.struct("pair", "value"))).alias("v"))
               .select("slice", F.lit(0).alias("kind"), F.col("v.value").alias("answer")))
    own = slices.where(F.col("pairs").isNull()).drop("pairs", "pair_docs").withColumn("kind", F.lit(1))
    both = own.unionByName(answers, allowMissingColumns=True).repartition("slice").sortWithinPartitions("slice", "kind")
    keep = ["doc_id", *NUMBERS, "groups_sha256"]
    schema = ", ".join(f"{c} {own.schema[c].dataType.simpleString()}" for c in keep) + ", n_best long, count_sum long"

    def run(batches):
        here, value = None, None
        for batch in batches:
            col = lambda name, b=batch: b.column(b.schema.get_field_index(name))
            slice_of, answer, idx, times = col("slice").to_numpy(), col("answer"), col("idx"), col("times")
            best, total, rows = [], [], []
            for i, (s, kind) in enumerate(zip(slice_of.tolist(), col("kind").to_pylist())):
                if kind == 0:
                    here, value = s, answer[i].values.to_numpy(zero_copy_only=False)
                    continue
                at, n = idx[i].values.to_numpy(zero_copy_only=False), times[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                mine = value[at] if s == here and len(at) else np.zeros(len(at), np.int64)
                rows.append(i)
                best.append(int((n * (mine & 1)).sum()))
                total.append(int((n * (mine >> 1)).sum()))
            part = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in keep], pa.array(best, pa.int64()),
                                              pa.array(total, pa.int64())], [*keep, "n_best", "count_sum"])

    out = materialize(both.mapInArrow(run, schema), "align")
    discard(slices, counts)
    return out


def op11_alignment(spark, sf_dir: str) -> DataFrame:
    return alignment(read_table(spark, sf_dir, "documents"), tokenizer_file(A_FILE), tokenizer_file(B_FILE))
