"""Substring dedup: repeated passages by de Bruijn compaction.

A *window* is ``k`` consecutive words of one document: an edge of the de Bruijn
graph from the node of its first k - 1 words to that of its last k - 1. A window
is a repeat when the same words also start earlier (smaller doc_id, or the same
document and an earlier word); every word of a repeat is cut.

1. **Candidates.** Two equal windows have the same anchor: the least hash of
   their runs of k / 2 words. Anchors, about one in six words, are counted
   over the corpus; only windows with an anchor at two places or more go on.
2. **Graph.** Each candidate window visits its node with the word before and the
   word behind it (none at the ends of a document). Joined on the node, visits
   tell whether it branches: other words before or behind, or an end.
3. **Compaction.** Between two branching nodes every document that is on the
   path follows it from its first edge to its last, so only a path's first edge
   is looked up: its earliest place is the path's source, and it decides for all
   of the path. Edges inside a path never travel back.
4. **Verification.** Each copy of a path carries a 128-bit digest of its words;
   the digests of all copies are compared with that of the source, grouped by
   the source's coordinates. Copies that differ (a collision of 64-bit node
   hashes) are refused and the cut is done again without them.

Texts are read in slices; a slice sends each distinct anchor or visit once, with
its first place, so a passage in a third of all documents is one row per slice
and no pair of copies is ever made. Answers return to the slices.

Defined results: null, empty and short texts have no windows; null ids come
first; rows of one doc_id are ordered by a hash of their texts; of identical
rows one comes first and the others are repeats from end to end; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, mix64, read_table, small_batches, text_slices

WINDOW = 20
SLICE = 2 << 20
# Shares of the nodes that are joined one after the other.
PASSES = 4
# Bytes that word hashing takes at a time.
HASH_BYTES = 1 << 20
FACTOR = np.uint64(0x9E3779B97F4A7C15)
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * FACTOR)
VALUE[SPACES] = 0


class Slice:
    """The words of some texts: their bytes with one space behind each word,
    the words' starts and ends, and per text its first word and word count."""

    def __init__(self, texts: list[bytes | None]):
        raw = np.frombuffer(b"".join(x for t in texts for x in (t or b"", b" ")), np.uint8)
        space = SPACES[raw]
        last = np.flatnonzero(~space[:-1] & space[1:]) + 1 if len(raw) else np.empty(0, np.int64)  # the space behind each word
        keep = ~space
        keep[last] = True
        at = np.cumsum(keep) - 1
        self.bytes = np.where(space, 32, raw)[keep].astype(np.uint8)
        self.end = at[last]
        self.start = np.concatenate([[0], self.end[:-1] + 1]) if len(last) else np.empty(0, np.int64)
        edges = np.cumsum([len(t or b"") + 1 for t in texts])
        self.first = np.searchsorted(last, np.concatenate([[0], edges[:-1]]))
        self.count = np.diff(np.append(self.first, len(last)))

    def text(self, lo: int, hi: int) -> bytes:
        """Words lo to hi - 1, joined by a space."""
        return self.bytes[self.start[lo]:self.end[hi - 1]].tobytes() if hi > lo else b""

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word: a polynomial of its bytes, finalised."""
        out, at, n = np.empty(len(self.start), np.uint64), 0, len(self.start)
        while at < n:
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + HASH_BYTES, "right")))
            starts, size = self.start[at:to] - self.start[at], self.end[at:to] - self.start[at:to]
            power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(size.max()), FACTOR, np.uint64)]))
            value = VALUE[self.bytes[self.start[at]:self.end[to - 1]]]
            value *= power[np.arange(len(value)) - np.repeat(starts, np.diff(np.append(starts, len(value))))]
            out[at:to] = mix64(np.add.reduceat(value, starts) + size.astype(np.uint64) * VALUE[0])
            at = to
        return np.maximum(out, 1)  # 0 stands for no word

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, first word) of every window."""
        n = np.maximum(self.count - k + 1, 0)
        text = np.repeat(np.arange(len(n)), n)
        return text, np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n) + self.first[text]


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes, by doubling."""
    out, width, power = None, 0, words
    step = 1
    while n:
        if n & step:
            if out is None:
                out, width = power, step
            else:
                size = max(len(out) - step, 0)
                out, width = mix64(out[:size] * FACTOR + power[width:width + size]), width + step
            n -= step
        if n:
            size = max(len(power) - step, 0)
            power = mix64(power[:size] * FACTOR + power[step:step + size])
            step *= 2
    return out


def sliding(best, x: np.ndarray, n: int) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``n`` consecutive values."""
    width = 1
    while width < n:
        step = min(width, n - width)
        x = best(x[:max(len(x) - step, 0)], x[step:])
        width += step
    return x


def rows_of(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, copies, text) with distinct (doc_id, tie)."""
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    odd = x.groupBy("doc_id").count().where((F.col("count") > 1) | F.col("doc_id").isNull())
    if not odd.take(1):
        return x.select("doc_id", F.lit(0).cast("long").alias("tie"), F.lit(1).cast("long").alias("copies"), "text")
    tie = F.xxhash64(F.col("doc_id").isNull(), F.col("text"))
    return (x.withColumn("tie", tie).groupBy("doc_id", "tie").agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
            .select("doc_id", "tie", "copies", "text"))


def _lists(cut: np.ndarray, values: np.ndarray, kind=np.int32) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(values.astype(kind)))


def _batch(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    """A batch of ``schema``: the named columns, null elsewhere."""
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, f.type) if columns.get(f.name) is None else pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array)
         else columns[f.name].cast(f.type) for f in schema], schema=schema)


LONGS, INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
BASE = [("slice", pa.int64()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("copies", pa.int64())]
BASE_DDL = "slice long, seq int, doc_id long, tie long, copies long"


def anchors(rows: DataFrame, k: int) -> DataFrame:
    """Per document: words, digest of them all, and its windows as runs
    (``at``: first window, ``idx``: anchor of the slice); per slice its distinct
    anchors (``keys``) and whether it has each at one place or more."""
    gram = k // 2
    schema = pa.schema([*BASE, ("n_words", pa.int64()), ("sha", pa.string()), ("at", INTS), ("idx", INTS), ("keys", LONGS), ("times", INTS)])

    def run(batches):
        number = 0
        for batch, texts in text_slices(batches, limit=SLICE):
            x = Slice(texts)
            text, at = x.windows(k)
            least = found = np.empty(0, np.uint64)
            if len(at):
                grams = runs(x.hashes(), gram)
                least = np.zeros(len(grams) - (k - gram), np.uint64)
                least[at] = sliding(np.minimum, grams, k - gram + 1)[at]
                pad = np.zeros(k - gram, np.uint64)
                found = grams[sliding(np.maximum, np.concatenate([pad, least, pad]), k - gram + 1) == grams]
                least = least[at]
            keys, times = np.unique(found, return_counts=True)
            new = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])])) if len(at) else np.empty(0, np.int64)
            cut = np.searchsorted(text[new], np.arange(len(texts) + 1))
            name = batch.column(batch.schema.get_field_index("part"))[0].as_py() << 32 | number
            number += 1
            n = batch.num_rows
            col = lambda c, b=batch: b.column(b.schema.get_field_index(c))
            digests = [hashlib.sha256(x.text(f, f + c)).hexdigest() for f, c in zip(x.first.tolist(), x.count.tolist())]
            yield _batch(schema, n, slice=[name] * n, seq=np.arange(n), doc_id=col("doc_id"), tie=col("tie"), copies=col("copies"), n_words=x.count,
                         sha=digests, at=_lists(cut, at[new] - x.first[text[new]]), idx=_lists(cut, np.searchsorted(keys, least[new])))
            if len(keys):
                yield _batch(schema, 1, slice=[name], keys=[keys.view(np.int64)], times=[np.minimum(times, 2)])

    x = rows.select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "tie", "copies", "text")
    return x.mapInArrow(run, f"{BASE_DDL}, n_words long, sha string, at array<int>, idx array<int>, keys array<long>, times array<int>")


def candidates(found: DataFrame, k: int) -> DataFrame:
    """The documents of ``anchors`` with ``ranges``: [from, to) of windows
    whose anchor is at two places of the corpus or more (flat list)."""
    keys = (found.where(F.col("keys").isNotNull()).select("slice", F.posexplode(F.arrays_zip("keys", "times")).alias("i", "a"))
            .select("slice", "i", F.col("a.keys").alias("key"), F.col("a.times").cast("long").alias("n")))
    again = keys.select("slice", "i", (F.sum("n").over(Window.partitionBy("key")) > 1).alias("again")).where("again")
    answers = again.groupBy("slice").agg(F.collect_list("i").alias("answer")).select("slice", F.lit(-1).alias("seq"), "answer")
    docs = found.where(F.col("keys").isNull()).drop("keys", "times")
    both = docs.unionByName(answers, allowMissingColumns=True).repartition("slice").sortWithinPartitions("slice", "seq")
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("copies", pa.int64()), ("n_words", pa.int64()), ("sha", pa.string()), ("ranges", INTS)])

    def run(batches):
        here, good = None, None
        for batch in batches:
            col = lambda c, b=batch: b.column(b.schema.get_field_index(c))
            at, idx, answer, rows, ranges = col("at"), col("idx"), col("answer"), [], []
            for i, (s, seq, n) in enumerate(zip(col("slice").to_pylist(), col("seq").to_pylist(), col("n_words").to_pylist())):
                if seq < 0:
                    here, good = s, np.sort(answer[i].values.to_numpy(zero_copy_only=False))
                    continue
                rows.append(i)
                own = idx[i].values.to_numpy(zero_copy_only=False)
                yes = np.isin(own, good) if s == here and len(own) else np.zeros(len(own), bool)
                edge = np.diff(np.concatenate([[False], yes, [False]]).astype(np.int8))
                lo = np.append(at[i].values.to_numpy(zero_copy_only=False), max(n - k + 1, 0))
                ranges.append(np.stack([lo[np.flatnonzero(edge > 0)], lo[np.flatnonzero(edge < 0)]], 1).ravel().astype(np.int32))
            part = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(f.name)) for f in list(schema)[:-1]],
                                              pa.array(ranges, INTS)], schema=schema)

    return both.mapInArrow(run, "doc_id long, tie long, copies long, n_words long, sha string, ranges array<int>")


VISIT = ("node", "before", "behind", "flag", "of", "place")


def visits(texts: DataFrame, k: int, passes: int = PASSES) -> DataFrame:
    """Per document its text, its first word's place in the slice (``base``)
    and, for each candidate window, the place of the slice's first visit like
    it (``idx``). Per slice and ``pass`` (share of the nodes) its distinct
    visits: ``place``, text ``of`` the slice, and ``flag``: 1 if a window goes on
    from the node, 2 if the slice has the visit more than once."""
    schema = pa.schema([*BASE, ("base", pa.int64()), ("text", pa.binary()), ("ranges", INTS), ("idx", INTS), ("pass", pa.int32()),
                        *[(v, LONGS) for v in VISIT], ("ids", LONGS), ("ties", LONGS)])

    def run(batches):
        number = 0
        for batch, raw in text_slices(batches, limit=SLICE):
            col = lambda c, b=batch: b.column(b.schema.get_field_index(c))
            x, n = Slice(raw), batch.num_rows
            words = x.hashes()
            ranges = [r.values.to_numpy(zero_copy_only=False) for r in col("ranges")]
            doc = np.repeat(np.arange(n), [len(r) // 2 for r in ranges])
            both = np.concatenate(ranges).astype(np.int64).reshape(-1, 2)
            size = both[:, 1] - both[:, 0] + 1  # the windows and the node behind the last
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(both[:, 0], size)
            owner = np.repeat(doc, size)
            place = at + x.first[owner]
            edge = np.ones(len(at), bool)
            edge[np.cumsum(size) - 1] = False
            padded = np.concatenate([[np.uint64(0)], words, [np.uint64(0)]])
            node = runs(words, k - 1)[place]
            before = np.where(at > 0, padded[place], np.uint64(0))
            behind = np.where(at + k <= x.count[owner], padded[np.minimum(place + k, len(words) + 1)], np.uint64(0))
            same = np.lexsort((edge, behind, before, node))  # stable: equal visits stay in order of place
            new = np.concatenate([[True], (node[same][1:] != node[same][:-1]) | (before[same][1:] != before[same][:-1])
                                  | (behind[same][1:] != behind[same][:-1]) | (edge[same][1:] != edge[same][:-1])])
            first, group = same[new], np.cumsum(new) - 1
            idx = np.empty(len(node), np.int64)
            idx[same] = place[first][group]
            cut = np.searchsorted(owner[edge], np.arange(n + 1))
            name = col("part")[0].as_py() << 32 | number
            number += 1
            yield _batch(schema, n, slice=[name] * n, seq=np.arange(n), doc_id=col("doc_id"), tie=col("tie"), copies=col("copies"), base=x.first,
                         text=col("text").cast(pa.binary()), ranges=col("ranges"), idx=_lists(cut, idx[edge]))
            flags = np.zeros(len(node), np.int64)
            flags[first] = edge[first] + 2 * (np.bincount(group) > 1)
            share = node[first] % np.uint64(passes)
            for p in range(passes):
                some = np.sort(first[share == p])
                columns = dict(zip(VISIT, (node[some], before[some], behind[some], flags[some], owner[some], place[some])))
                yield _batch(schema, 1, slice=[name], ids=[col("doc_id").to_pylist()], ties=[col("tie").to_pylist()], **{"pass": [p]},
                             **{c: [v.view(np.int64) if v.dtype == np.uint64 else v.astype(np.int64)] for c, v in columns.items()})

    x = texts.select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "tie", "copies", "text", "ranges")
    ddl = f"{BASE_DDL}, base long, text binary, ranges array<int>, idx array<int>, pass int, " + ", ".join(f"{v} array<long>" for v in (*VISIT, "ids", "ties"))
    return x.mapInArrow(run, ddl)


def paths(seen: DataFrame, refused: DataFrame | None = None) -> DataFrame:
    """Per slice its visits that start a path: their places, the place of the
    path's source (slice, word) and whether the path has other copies. A path
    starts where its node branches."""
    each = (seen.where(F.col("node").isNotNull())
            .select("slice", "ids", "ties", F.explode(F.arrays_zip(*VISIT)).alias("v"))
            .select("slice", *[F.col(f"v.{c}").alias(c) for c in VISIT if c != "of"],
                    F.col("ids")[F.col("v.of").cast("int")].alias("doc_id"), F.col("ties")[F.col("v.of").cast("int")].alias("tie")))
    each = each.repartition("node")  # the one shuffle; both windows are inside a node
    at = Window.partitionBy("node")
    edge = Window.partitionBy("node", "behind", F.col("flag").bitwiseAND(1))
    earliest = edge.orderBy(F.col("doc_id").asc_nulls_first(), "tie", "place")
    branches = ((F.min("before").over(at) != F.max("before").over(at)) | (F.min("behind").over(at) != F.max("behind").over(at))
                | (F.col("before") == 0) | (F.col("behind") == 0))
    many = (F.count(F.lit(1)).over(edge) > 1) | (F.max("flag").over(edge) > 1)
    starts = (each.select("slice", "place", "flag", branches.alias("branches"), many.alias("many"), F.first("slice").over(earliest).alias("s_slice"),
                          F.first("place").over(earliest).alias("s_place"))
              .where(F.col("branches") & (F.col("flag").bitwiseAND(1) == 1)))
    if refused is not None:
        no = refused.select(F.col("s_slice").alias("_s"), F.col("s_place").alias("_p"))
        starts = starts.join(no, (F.col("s_slice") == F.col("_s")) & (F.col("s_place") == F.col("_p")), "left")
        starts = starts.withColumn("many", F.col("many") & F.col("_s").isNull())
    fields = ("place", "s_slice", "s_place", "many")
    return (starts.groupBy("slice").agg(F.collect_list(F.struct(*fields)).alias("p"))
            .select("slice", F.lit(-1).alias("seq"), *[F.col(f"p.{c}").alias(f"p_{c}") for c in fields]))


def all_paths(seen: DataFrame, refused: DataFrame | None = None, passes: int = PASSES) -> DataFrame:
    """``paths`` in several passes, each over its share of the nodes and written
    before the next, so that shuffle files hold one share at a time."""
    out = None
    for p in range(passes):
        some = materialize(paths(seen.where(F.col("pass") == p), refused), "repeats-paths")
        out = some if out is None else out.unionByName(some)
    return out


RESULT = ("doc_id long, tie long, copies long, n_words long, n_removed long, kept_sha256 string, removed array<int>, "
          "sources array<struct<s_slice: long, s_place: long, low: long, high: long>>")
SOURCE = ("s_slice", "s_place", "low", "high")


def cut(seen: DataFrame, starts: DataFrame, k: int) -> DataFrame:
    """The candidate documents without their repeats: ``removed`` are the
    [from, to) of cut words (flat list), ``sources`` the digests of the copies
    of paths, of the source's own too."""
    docs = seen.where(F.col("node").isNull()).drop(*VISIT, "ids", "ties", "pass")
    both = docs.unionByName(starts, allowMissingColumns=True).repartition("slice").sortWithinPartitions("slice", "seq")
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("copies", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept_sha256", pa.string()), ("removed", INTS), ("sources", pa.list_(pa.struct([(c, pa.int64()) for c in SOURCE])))])

    def one(slice_of, base, text, ranges, idx, known) -> dict:
        x = Slice([text])
        n = len(x.start)
        windows = np.concatenate([np.arange(a, b) for a, b in ranges.reshape(-1, 2).tolist()])
        at, is_start = np.zeros(len(idx), np.int64), np.zeros(len(idx), bool)
        if known is not None:
            at = np.minimum(np.searchsorted(known["place"], idx), len(known["place"]) - 1)
            is_start = known["place"][at] == idx
        # a path goes on until the next start or the end of the candidates
        new = np.flatnonzero(is_start | np.concatenate([[True], windows[1:] != windows[:-1] + 1]))
        gone, sources = np.zeros(n + 1, np.int64), []
        for a, b in zip(new.tolist(), np.append(new[1:], len(windows)).tolist()):
            if not is_start[a] or not known["many"][at[a]]:
                continue
            lo, hi = int(windows[a]), int(windows[b - 1]) + k
            source = int(known["s_slice"][at[a]]), int(known["s_place"][at[a]])
            digest = hashlib.blake2b(x.text(lo, hi), digest_size=16).digest()
            sources.append(dict(zip(SOURCE, (*source, *(int.from_bytes(digest[i:i + 8], "little", signed=True) for i in (0, 8))))))
            if source != (slice_of, base + lo):
                gone[lo] += 1
                gone[hi] -= 1
        cut_off = np.cumsum(gone[:n]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], cut_off, [False]]).astype(np.int8)))
        kept, before = [], 0
        for a, b in [*edges.reshape(-1, 2).tolist(), (n, n)]:
            if a > before:
                kept.append(x.text(before, a))
            before = b
        return {"n_words": n, "n_removed": int(cut_off.sum()), "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest(),
                "removed": edges.tolist(), "sources": sources}

    def run(batches):
        here, parts, known = None, [], None
        for batch in batches:
            col = lambda c, b=batch: b.column(b.schema.get_field_index(c))
            out = []
            for i, (s, seq) in enumerate(zip(col("slice").to_pylist(), col("seq").to_pylist())):
                if seq < 0:
                    parts = [*(parts if s == here else []), {c: col(f"p_{c}")[i].values.to_numpy(zero_copy_only=False) for c in ("place", "s_slice", "s_place", "many")}]
                    here, known = s, None
                    continue
                if s == here and known is None:
                    known = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
                    order = np.argsort(known["place"])
                    known = {c: v[order] for c, v in known.items()}
                row = {c: col(c)[i].as_py() for c in ("doc_id", "tie", "copies")}
                own = [col(c)[i].values.to_numpy(zero_copy_only=False) for c in ("ranges", "idx")]
                out.append(row | one(s, col("base")[i].as_py(), col("text")[i].as_py(), *own, known if s == here else None))
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return both.mapInArrow(run, RESULT)


def refused(done: DataFrame) -> DataFrame:
    """Sources of paths whose copies' words are not all the same."""
    each = done.select(F.explode("sources").alias("s")).select("s.*")
    return (each.groupBy("s_slice", "s_place").agg(*[f(c).alias(f"{n}_{c}") for n, f in (("a", F.min), ("b", F.max)) for c in ("low", "high")])
            .where("a_low <> b_low OR a_high <> b_high").select("s_slice", "s_place"))


def without_repeats(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and
    ``removed``, the [from, to) of the cut words as a flat list."""
    small_batches(docs.sparkSession)
    rows = rows_of(docs)
    found = materialize(anchors(rows, k), "repeats-anchors")
    marked = materialize(candidates(found, k), "repeats-candidates")
    discard(found)
    some = F.size("ranges") > 0
    ranges = marked.where(some).select(F.col("doc_id").alias("_d"), F.col("tie").alias("_t"), "ranges")
    texts = (rows.join(ranges, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tie") == F.col("_t"))).drop("_d", "_t")
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie"))
    seen = materialize(visits(texts, k), "repeats-visits")
    starts = all_paths(seen)
    done = materialize(cut(seen, starts, k), "repeats-cut")
    bad = materialize(refused(done), "repeats-refused")
    if bad.take(1):
        done = materialize(cut(seen, all_paths(seen, bad), k), "repeats-cut")
    discard(seen, starts)
    plain = marked.where(~some).select("doc_id", "copies", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"),
                                       F.array().cast("array<int>").alias("removed"))
    every = plain.unionByName(done.select(*plain.columns)).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    again = (F.col("copy") > 1) & (F.col("n_words") >= k)
    empty = hashlib.sha256(b"").hexdigest()
    return every.select("doc_id", "n_words", F.when(again, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
                        F.when(again, F.lit(empty)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
                        F.when(again, F.array(F.lit(0), F.col("n_words").cast("int"))).otherwise(F.col("removed")).alias("removed"))


def op13_repeats(spark, sf_dir: str) -> DataFrame:
    return without_repeats(read_table(spark, sf_dir, "documents")).drop("removed")


ORACLE_SQL = """
WITH lists AS (
  SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM lists),
windows AS (
  SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS g FROM w
),
repeats AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM windows WHERE len(g) = 20
  ) WHERE n > 1
),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM repeats, range(20) t(k)),
judged AS (SELECT w.doc_id, w.word, w.i, g.i IS NOT NULL AS cut FROM w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i),
per AS (
  SELECT doc_id, CAST(count(*) AS BIGINT) AS n_words, CAST(count(*) FILTER (WHERE cut) AS BIGINT) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT cut) AS kept
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, COALESCE(n_words, 0) AS n_words, COALESCE(n_removed, 0) AS n_removed, sha256(COALESCE(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN per USING (doc_id)
"""
