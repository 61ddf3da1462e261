"""LM scoring with a probabilistic suffix tree over words.

Tokens are the white-space-separated words (A-Z lower-cased) and one end per
text. c(x) is a token's count in the training texts, N their number, V the
number of distinct ones.

Root: P0(x) = (c(x) - d0) / N for a known token, d0 V / N for an unknown one,
d0 = n1 / (n1 + 2 n2) from the numbers of words seen once and twice.

Symbols of the tree are all words and the end; with ``hot_words`` given, only
the most frequent words, the end, and one class for every other word. A context
is the last 1 to ``DEPTH`` symbols of the same text. It is a candidate while it
occurs ``MIN_COUNT`` times or more (or makes up ``p_min`` of all tokens, if that
is more) and its own suffix is retained; it is retained if its next-symbol
distribution diverges from that of its suffix: the gain in training
log-likelihood, sum over x of N(sx) ln P(x|s) / P(x|suffix), is at least
``MIN_GAIN`` nats per occurrence and ``MIN_TOTAL`` in all. Distributions are
smoothed by absolute discounting into the suffix: P(x|s) = max(N(sx) - D, 0) /
N(s) + g(s) P(x|suffix) over the next symbols that occur as often as a context
must; g(s) is the mass left. Each position is scored by its longest suffix in
the tree; a word of the class "other" by the class times P0(x) / P0(other).

The tree grows with the input and is never gathered. Texts are handled in slices
of some 4 MB, each a row of compressed token codes. At each depth a slice asks,
for its distinct grams (a context and its next symbol) behind contexts that can
be retained, how often all training texts hold them: sorted gram hashes, packed
by bucket of hashes, go through one shuffle, in ``SHARES`` turns, and the numbers
come back in the order asked; the slices take them in ``TURNS`` turns. Then a
slice asks in the same way for the contexts it holds, and adds the frequent
grams that it speaks for (one slice does for each): the bucket of a context has
all that decides whether it is retained. Contexts that occur more often than a
bucket has tokens are left out there and decided by a distributed grouping. A
slice walks its positions down the tree with the answers it has; between depths
it keeps them with P in single precision. A gram is one entry per slice and its
bucket goes by its own hash, so neither a frequent word nor a frequent context is
one task's load. Nothing is broadcast but the totals (and ``hot_words``, if given).

Defined results: null and empty texts are the end token alone; repeated rows
count each; with no training text every token is unknown and the score is the
base score; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, discard, materialize, mix64, read_table, small_batches, text_slices

HOT_WORDS = None  # every word is a symbol
DEPTH = 3
P_MIN = 0.0
MIN_COUNT = 2
MIN_GAIN = 0.02
MIN_TOTAL = 10.0
DISCOUNT = 0.75
# Bytes of text in a slice, the unit that names a gram once and gets its answers.
SLICE = 4 << 20
# Tokens of all slices to one bucket of hashes.
BUCKET = 1 << 20
# Turns in which a level's grams are counted.
SHARES = 2
# Turns in which slices take their answers and ask.
TURNS = 4
END, OTHER = 0, 1  # symbols; a word is its hash with the top bit set
TOP = np.uint64(1 << 63)
# Positions that are hashed at a time.
BLOCK = 1 << 15


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted key in the sorted keys, -1 if absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def pack(a: np.ndarray) -> bytes:
    """Numbers as planes of equal bytes, compressed."""
    return zstandard.compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if len(a) else b"", 3)


def unpack(packed: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel() if len(raw) else np.empty(0, kind)


def pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, np.uint64), dtype=np.uint64)


class _Codes(dict):
    """word -> code; a new word gets the next one."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self) + 2
        return code


def _symbolise(spell: bool):
    """One row per slice: its rows' ids and sizes, its tokens as codes (the end,
    then the slice's words as they come), and of those words the hashes, the
    numbers in training texts and, if asked for, the spellings."""
    def run(batches):
        import xxhash

        ids, held, sizes, parts, codes, read, made = [], [], [], [], _Codes(), 0, 0

        def row():
            n = sum(map(len, ids))
            list_of = lambda x: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), x)
            tokens = np.concatenate(parts)
            learn = ~pa.concat_arrays(held).to_numpy(zero_copy_only=False).astype(bool)
            times = np.bincount(tokens[np.repeat(learn, sizes)], minlength=len(codes) + 2)[2:]
            of_words = lambda x: pa.ListArray.from_arrays(pa.array([0, len(codes)], pa.int32()), x)
            words = list(codes)
            return pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() << 24 | made], pa.int64()), pa.array([len(tokens)], pa.int64()),
                 pa.array([int(learn.sum())], pa.int64()), list_of(pa.concat_arrays(ids)), list_of(pa.concat_arrays(held)),
                 list_of(pa.array(sizes, pa.int32())), pa.array([pack(tokens)], pa.binary()),
                 of_words(pa.array(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64))), of_words(pa.array(times, pa.int32())),
                 of_words(pa.array(words if spell else [None] * len(words), pa.binary()))],
                ["slice", "tokens", "learned", "doc_id", "held_out", "sizes", "codes", "words", "times", "spelled"])

        for rows, texts in text_slices(batches, limit=SLICE // 2):
            ids.append(rows.column(0))
            held.append(rows.column(1))
            for text in texts:
                words = _words(text)
                parts.append(np.fromiter(map(codes.__getitem__, words), np.uint32, len(words)))
                parts.append(np.zeros(1, np.uint32))
                sizes.append(len(words) + 1)
                read += len(text or b"")
            if read >= SLICE:
                yield row()
                ids, held, sizes, parts, codes, read, made = [], [], [], [], _Codes(), 0, made + 1
        if sizes:
            yield row()
    return run


def pair_keys(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Hash of the gram that ``symbol`` makes of ``context``; 0 is the empty one."""
    out = np.empty(len(context), np.uint64)
    for at in range(0, len(out), BLOCK):
        some = slice(at, at + BLOCK)
        mixed = mix64(context[some] + np.uint64(1))
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed += symbol[some] * np.uint64(0xD6E8FEB86659FD93)
        mixed += np.uint64(1)
        out[some] = mix64(mixed)
    return out


def _before(x: np.ndarray) -> np.ndarray:
    """What the position before has; 0 at the first."""
    return np.concatenate([np.zeros(min(1, len(x)), x.dtype), x[:-1]])


@dataclass(frozen=True)
class Root:
    """What all slices share: the number of training texts, the sorted hashes and
    the numbers of the hot words, if only these are symbols; the totals; the
    rules of the tree."""

    ends: int
    hot: np.ndarray | None
    hot_times: np.ndarray | None
    total: int
    distinct: int
    d0: float
    least: float
    discount: float
    depth: int
    buckets: int
    heavy: int

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 0.1) / (self.total + 0.1 * (self.distinct + 1)))

    def p0(self, n: np.ndarray) -> np.ndarray:
        if not self.total:  # one kind of token, unknown
            return np.ones(len(n))
        return np.where(n > 0, np.maximum(n - self.d0, 1e-9), self.d0 * self.distinct) / self.total


def order_of(keys: np.ndarray) -> np.ndarray:
    """The stable order of 64-bit keys: sorted as numbers that end in the key's
    place; keys that differ in those last bits only are put right after."""
    bits = np.uint64(len(keys).bit_length())
    both = keys >> bits << bits
    both |= np.arange(len(keys), dtype=np.uint64)
    both.sort()
    order = (both & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    ahead = keys[order]
    wrong = np.flatnonzero(ahead[1:] < ahead[:-1])
    if len(wrong):
        ahead >>= bits
        tied = np.flatnonzero(np.isin(ahead, np.unique(ahead[wrong])))
        some = np.sort(order[tied])
        order[tied] = some[np.argsort(keys[some], kind="stable")]
    return order


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the place of one of each, and each key's number among them."""
    order = order_of(keys)
    ahead = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(ahead[1:], ahead[:-1], out=new[1:])
    inverse = np.empty(len(keys), np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - 1
    first = np.flatnonzero(new)
    return ahead[first], order[first], inverse


class Slice:
    """A slice's positions on their way down the tree. ``at`` are those whose
    context of ``d`` symbols may be retained, with ``p``, P(symbol | longest
    retained suffix so far), and ``occurs``, how often training texts hold the
    context; all others have their final log10 P in ``sums`` of their text."""

    def __init__(self, row: pa.Table, answers: pa.Table, root: Root):
        self.root, self.answers = root, {}
        for d, what, bucket, answer in zip(*(answers[c].to_pylist() for c in ("d", "what", "bucket", "answer"))):
            self.answers.setdefault((d, what), {})[bucket] = answer
        self.codes = unpack(row["codes"][0].as_py(), np.uint32)
        self.sizes, held, words = (row[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("sizes", "held_out", "words"))
        self.begin = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        self.learn = np.repeat(~held.astype(bool), self.sizes)
        self.text = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        self.place = np.arange(len(self.codes), dtype=np.int32) - self.begin.astype(np.int32)[self.text]
        self.hashes = words.view(np.uint64)
        self.order = order_of(self.hashes)
        self.reached = None

    def answer(self, d: int, what: str, kind) -> np.ndarray:
        """The answers for the sorted distinct keys asked for as (d, what)."""
        known = self.answers.get((d, what), {})
        return np.concatenate([unpack(known[b], kind) for b in sorted(known)] + [np.empty(0, kind)])

    def words(self) -> None:
        """Counts and P0 of the slice's codes, from the answers for its words."""
        root, n = self.root, np.zeros(len(self.hashes))
        n[self.order] = np.maximum(self.answer(0, "words", np.float64), 0)
        self.n = np.concatenate([[root.ends, 0], n])
        self.symbol = np.concatenate([np.array([END, OTHER], np.uint64), self.hashes | TOP])
        self.p0 = root.p0(self.n)
        self.parent, self.times = self.p0.copy(), self.n.copy()  # of the symbols
        if root.hot is not None:
            other = np.concatenate([[False, True], _find(root.hot, self.hashes) < 0])
            known = np.append(root.hot_times, root.ends)
            self.symbol[other] = OTHER
            self.parent[other] = max(1e-12, 1 - root.p0(known)[known > 0].sum())
            self.times[other] = root.total - known.sum()

    def load(self, d: int) -> None:
        """The positions of depth ``d``: as ``state`` had them, or all at first."""
        if (d, "at") in self.answers:
            self.at = np.cumsum(self.answer(d, "at", np.uint32), dtype=np.int64)
            self.p, self.occurs = self.answer(d, "p", np.float32).astype(float), self.answer(d, "occurs", np.int64)
            self.sums = self.answer(d, "sums", np.float64)
            return
        self.at, self.sums = np.arange(len(self.codes)), np.zeros(len(self.sizes))
        self.p = self.parent[self.codes]
        occurs = _before(self.times[self.codes]) if self.root.total else np.zeros(len(self.codes))
        self.keep((self.place >= 1) & (occurs >= self.root.least), occurs)

    def keep(self, can: np.ndarray, occurs: np.ndarray) -> None:
        """Go on with the positions ``can``; the others are final."""
        self.sums = self.sums + np.bincount(self.text[self.at[~can]], np.log10(np.maximum(self.p[~can], 1e-300)), len(self.sums))
        self.at, self.p, self.occurs = self.at[can], self.p[can], occurs[can]

    def state(self) -> list[tuple[str, np.ndarray]]:
        # every slice rounds P of a gram alike, from the same numbers
        return [("at", np.diff(self.at, prepend=0).astype(np.uint32)), ("p", self.p.astype(np.float32)),
                ("occurs", self.occurs.astype(np.int64)), ("sums", self.sums)]

    def grams(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct grams of a context of ``d`` symbols and its next, where
        the context may be retained or the gram may be a context of the next
        depth, and their numbers in training texts."""
        if self.reached is None or self.reached >= d:
            self.reached, self.gram = 0, pair_keys(np.zeros(len(self.symbol), np.uint64), self.symbol)[self.codes]
        symbols = self.symbol[self.codes]
        for _ in range(self.reached, d):
            self.context = _before(self.gram)
            self.gram = pair_keys(self.context, symbols)
        self.reached = d
        mask = np.zeros(len(self.codes), bool)
        mask[self.at] = True
        if d < self.root.depth:
            before = self.at - 1
            mask[before[self.place[before] >= d]] = True
        self.counted = np.flatnonzero(mask)
        keys, self.first, self.inverse = distinct(self.gram[self.counted])
        return keys, np.bincount(self.inverse, self.learn[self.counted], len(keys)).astype(np.int64)

    def contexts(self, d: int) -> np.ndarray:
        """Sorted distinct contexts; the numbers of ``grams`` are known."""
        self.grams(d)
        found = self.answer(d, "grams", np.int64)
        self.number, self.mine = found >> 1, (found & 1).astype(bool)
        self.seen = np.zeros(len(self.codes))
        self.seen[self.counted] = self.number[self.inverse]
        keys, _, self.of = distinct(self.context[self.at])
        return keys

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        """Frequent grams that this slice speaks for: rows of (context's place in
        ``contexts``, its occurrences, the gram's, P of its symbol after the
        context's suffix) by context; for heavy contexts apart, with the context."""
        chosen = np.flatnonzero(self.mine & (self.number >= self.root.least))
        where = np.full(len(self.codes), -1)
        where[self.at] = np.arange(len(self.at))
        i = where[self.counted[self.first[chosen]]]
        chosen, i = chosen[i >= 0], i[i >= 0]
        heavy = self.occurs[i] > self.root.heavy
        rows = lambda context, some: np.stack([context, self.occurs[i[some]].astype(float), self.number[chosen[some]].astype(float), self.p[i[some]]])
        light = np.flatnonzero(~heavy)
        light = light[np.argsort(self.of[i[light]], kind="stable")]
        return rows(self.of[i[light]].astype(float), light), rows(self.context[self.at[i[heavy]]].view(np.float64), heavy)

    def descend(self, d: int) -> None:
        """From depth ``d`` to the next: the mass that contexts leave is known."""
        self.contexts(d)
        left = self.answer(d, "contexts", np.float64)[self.of]
        hold, n = left >= 0, self.seen[self.at]
        own = np.where(n >= self.root.least, np.maximum(n - self.root.discount, 0), 0) / self.occurs
        self.p = np.where(hold, own + left * self.p, self.p)
        before = self.at - 1
        occurs = self.seen[before]
        self.keep(hold & (self.place[self.at] > d) & (occurs >= self.root.least) & (d < self.root.depth), occurs)


ANSWERS = "slice long, d int, what string, bucket long, answer binary"
ASKS = "slice long, d int, what string, bucket long, keys binary, numbers binary, told binary"


def _asks(slice_of: int, d: int, asked: list, told: list = ()) -> pa.Table:
    """``ASKS`` rows of asked (what, bucket, keys, numbers) and of what is told
    unasked, (what, packed): a column of its own, to be read alone."""
    parts = [(*x, None) for x in asked] + [(what, 0, None, None, packed) for what, packed in told]
    columns = zip(*parts) if parts else ((),) * 5
    kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array([slice_of] * len(parts), pa.int64()), pa.array([d] * len(parts), pa.int32()), *map(pa.array, columns, kinds)],
                    ["slice", "d", "what", "bucket", "keys", "numbers", "told"])


def _buckets(keys: np.ndarray, root: Root) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted keys in buckets of equal ranges."""
    bucket = (keys >> np.uint64(32)) * np.uint64(root.buckets) >> np.uint64(32)
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else np.empty(0, np.int64)
    return [(int(bucket[lo]), lo, hi) for lo, hi in zip(cuts, np.append(cuts[1:], len(keys)))]


def _by_bucket(what: str, keys: np.ndarray, numbers: np.ndarray, root: Root) -> list:
    return [(what, b, pack_keys(keys[lo:hi]), pack(numbers[lo:hi])) for b, lo, hi in _buckets(keys, root)]


def _contexts_by_bucket(keys: np.ndarray, found: np.ndarray, root: Root) -> list:
    """As ``_by_bucket``, with the frequent grams ``found`` behind the contexts."""
    def part(lo, hi):
        some = found[:, np.searchsorted(found[0], lo):np.searchsorted(found[0], hi)].copy()
        some[0] -= lo
        return pack(some.ravel())

    return [("contexts", b, pack_keys(keys[lo:hi]), part(lo, hi)) for b, lo, hi in _buckets(keys, root)]


def _per_slice(table: DataFrame, answers: DataFrame, root: Root, make, schema: str = ASKS) -> DataFrame:
    """``make(Slice, row)`` of each slice with the answers it has so far."""
    def run(row, found):
        return make(Slice(row, found, root), row)

    return table.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(run, schema)


def _in_turns(table: DataFrame, answers: DataFrame, root: Root, make) -> DataFrame:
    """``_per_slice``, written: only a share of the slices, with its answers, lies
    in shuffle files at a time."""
    out = None
    for turn in range(TURNS):
        some = lambda x: x.where(F.pmod(F.xxhash64("slice"), F.lit(TURNS)) == turn)
        part = materialize(_per_slice(some(table), some(answers), root, make), "pst-asks")
        out = part if out is None else out.unionByName(part)
    return out


def _chosen(told: list, places: list, n: int, root: Root, min_gain: float, min_total: float) -> np.ndarray:
    """The mass that each of ``n`` contexts leaves to its suffix, -1 where it is
    not retained; ``told``: its frequent grams as slices told them, ``places``:
    the contexts' numbers."""
    context = np.concatenate([p[f[0].astype(np.int64)] for p, f in zip(places, told)])
    occurs, times, parent = np.concatenate([f[1:] for f in told], 1)
    part, every = np.maximum(times - root.discount, 0), np.zeros(n)
    every[context] = occurs
    held, seen = every > 0, np.bincount(context, times, n)
    left = 1 - np.bincount(context, part, n) / np.maximum(every, 1)
    gain = np.bincount(context, times * np.log((part / occurs + left[context] * parent) / parent), n).astype(float)  # whole numbers of none
    # symbols without a part of their own are all left * parent
    rest = held & (every > seen) & (left > 0)
    gain[rest] += (every - seen)[rest] * np.log(left[rest])
    return np.where(held & (gain >= min_total) & (gain >= min_gain * every), left, -1.0)


def answered(asks: DataFrame, root: Root, what: str, values: DataFrame | None = None, shares: int = 1, rules: tuple | None = None) -> DataFrame:
    """Answers to what slices ask: one shuffle by buckets of keys, in ``shares``
    turns. With ``values`` (key, value) the value of each key, -1 without one, or,
    with ``rules``, what ``_chosen`` finds; else how often training texts hold the
    key, and which slice speaks for it."""
    def reply(rows, asked, out):
        cuts = np.cumsum([0, *map(len, asked)])
        packed = pa.array([pack(out[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:])], pa.binary())
        return pa.table([rows["slice"], rows["d"], rows["what"], rows["bucket"], packed], ["slice", "d", "what", "bucket", "answer"])

    def count(rows):
        asked = [unpack_keys(k) for k in rows["keys"].to_pylist()]
        numbers = np.concatenate([unpack(n, np.int64) for n in rows["numbers"].to_pylist()])
        _, first, inverse = distinct(np.concatenate(asked))
        out = np.bincount(inverse, numbers).astype(np.int64)[inverse] << 1
        out[first] |= 1
        return reply(rows, asked, out)

    def look_up(rows, found):
        if not rows.num_rows:
            return pa.table([rows[c] for c in ("slice", "d", "what", "bucket", "keys")], ["slice", "d", "what", "bucket", "answer"])
        asked = [unpack_keys(k) for k in rows["keys"].to_pylist()]
        keys, _, inverse = distinct(np.concatenate(asked))
        value = np.full(len(keys), -1.0)
        if rules:
            told = [unpack(n, np.float64).reshape(4, -1) for n in rows["numbers"].to_pylist()]
            value = _chosen(told, np.split(inverse, np.cumsum([len(k) for k in asked])[:-1]), len(keys), root, *rules)
        at = _find(keys, found["key"].to_numpy().view(np.uint64))
        value[at[at >= 0]] = found["value"].to_numpy()[at >= 0]
        return reply(rows, asked, value[inverse])

    out = None
    for share in range(shares):
        asked = asks.where((F.col("what") == what) & (F.col("bucket") % shares == share)).drop("told")
        if values is None:
            part = asked.groupBy("bucket").applyInArrow(count, ANSWERS)
        else:
            bucket = F.shiftright(F.shiftrightunsigned("key", 32) * F.lit(root.buckets).cast("long"), 32)
            keyed = values.select("key", F.col("value").cast("double").alias("value"), bucket.alias("bucket"))
            part = asked.groupBy("bucket").cogroup(keyed.groupBy("bucket")).applyInArrow(look_up, ANSWERS)
        part = materialize(part, "pst-answers")
        out = part if out is None else out.unionByName(part)
    return out


def retained_contexts(asks: DataFrame, root: Root, min_gain: float, min_total: float) -> DataFrame:
    """(key, value): heavy contexts that diverge from their suffix, with the mass
    left to it; from the frequent grams that slices tell. As ``_chosen``, over all tasks."""
    def tell(batches):
        for b in batches:
            for packed in b.column(0).to_pylist():
                found = unpack(packed, np.float64).reshape(4, -1)
                yield pa.RecordBatch.from_arrays([pa.array(found[0].view(np.int64)), *map(pa.array, found[1:])], ["context", "all", "n", "parent"])

    kept = asks.where("what = 'heavy'").select("told").mapInArrow(tell, "context long, all double, n double, parent double")
    kept = materialize(kept.withColumn("part", F.greatest(F.col("n") - root.discount, F.lit(0.0))), "pst-pairs")
    mass = (kept.groupBy("context").agg(F.sum("part").alias("own"), F.sum("n").alias("seen"), F.first("all").alias("all"))
            .withColumn("left", 1 - F.col("own") / F.col("all")))
    p = F.col("part") / F.col("all") + F.col("left") * F.col("parent")
    gain = (kept.join(mass.select("context", "left"), "context")
            .groupBy("context").agg(F.sum(F.col("n") * F.log(p / F.col("parent"))).alias("gain")))
    # symbols without a part of their own are all left * parent
    rest = (F.col("all") - F.col("seen")) * F.log("left")
    chosen = (mass.join(gain, "context").withColumn("gain", F.col("gain") + F.coalesce(F.when(F.col("all") > F.col("seen"), rest), F.lit(0.0)))
              .where((F.col("gain") >= min_total) & (F.col("gain") >= min_gain * F.col("all"))))
    chosen = materialize(chosen.select(F.col("context").alias("key"), F.col("left").alias("value")), "pst-contexts")
    discard(kept)
    return chosen


def score(docs: DataFrame, train, hot_words: int | None = HOT_WORDS, depth: int = DEPTH, p_min: float = P_MIN,
          min_gain: float = MIN_GAIN, min_total: float = MIN_TOTAL, discount: float = DISCOUNT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    for every row; ``train`` (a boolean column) marks the rows to learn from."""
    spark = docs.sparkSession
    small_batches(spark)
    ids = docs.schema["doc_id"].dataType.simpleString()
    x = docs.select("doc_id", (~train).alias("held_out"), F.col("text").cast("string").alias("text"))
    table = materialize(x.mapInArrow(_symbolise(hot_words is not None), f"slice long, tokens long, learned long, doc_id array<{ids}>, "
                                     "held_out array<boolean>, sizes array<int>, codes binary, words array<long>, times array<int>, spelled array<binary>"),
                        "pst-slices")
    word = F.explode(F.arrays_zip("words", "times", *(["spelled"] if hot_words is not None else []))).alias("w")
    vocabulary = (table.select(word).select("w.*").where("times > 0").groupBy(F.col("words").alias("key"))
                  .agg(F.sum("times").alias("value"), *([F.first("spelled").alias("word")] if hot_words is not None else [])))
    vocabulary = materialize(vocabulary, "pst-words")
    n = F.col("value")
    facts = vocabulary.agg(F.sum(n), F.count(F.lit(1)), F.count(F.when(n == 1, 1)), F.count(F.when(n == 2, 1))).first()
    tokens, ends = (v or 0 for v in table.agg(F.sum("tokens"), F.sum("learned")).first())
    hot = None
    if hot_words is not None:  # at most hot_words rows
        hot = vocabulary.orderBy(F.desc("value"), "word").limit(hot_words).select("key", "value").toPandas().sort_values("key", key=lambda k: k.astype("uint64"))
    root = Root(ends, None if hot is None else hot["key"].to_numpy().view(np.uint64), None if hot is None else hot["value"].to_numpy(float),
                (facts[0] or 0) + ends, facts[1] + (ends > 0), facts[2] / max(1, facts[2] + 2 * facts[3]) or 0.5,
                max(MIN_COUNT, p_min * ((facts[0] or 0) + ends)), discount, depth, tokens // BUCKET + 1, BUCKET)
    total = root.total
    table = table.drop("tokens", "learned", "times", "spelled")
    slice_of = lambda row: row["slice"][0].as_py()

    def ask_words(s, row):
        return _asks(slice_of(row), 0, _by_bucket("words", s.hashes[s.order], np.zeros(len(s.order), np.int64), root))

    def ask_grams(s, row):
        s.words()
        s.load(max(1, d - 1))
        kept = []
        if d > 1:
            s.descend(d - 1)
            kept = [(what, pack(a)) for what, a in s.state()]
        return _asks(slice_of(row), d, _by_bucket("grams", *s.grams(d), root), kept)

    def ask_contexts(s, row):
        s.words()
        s.load(d)
        keys = s.contexts(d)
        light, heavy = s.found()
        return _asks(slice_of(row), d, _contexts_by_bucket(keys, light, root), [("heavy", pack(heavy.ravel()))] if heavy.size else [])

    asks = _per_slice(table, spark.createDataFrame([], ANSWERS), root, ask_words)
    words = answers = answered(asks, root, "words", vocabulary)
    discard(vocabulary)
    past: list[DataFrame] = []
    for d in range(1, depth + 1 if total else 1):
        asks = _in_turns(table, answers, root, ask_grams)
        discard(*past)
        counts = answered(asks, root, "grams", shares=SHARES)
        state = asks.where(F.col("what").isin("at", "p", "occurs", "sums")).select("slice", "d", "what", "bucket", F.col("told").alias("answer"))
        state = materialize(state, "pst-state")
        discard(asks)
        answers = words.unionByName(state).unionByName(counts)
        further = _in_turns(table, answers, root, ask_contexts)
        left = answered(further, root, "contexts", retained_contexts(further, root, min_gain, min_total), SHARES, (min_gain, min_total))
        answers = answers.unionByName(left)
        discard(further)
        past = [state, counts, left]

    def tell(s, row):
        flat = lambda c: row[c].combine_chunks().flatten()
        s.words()
        s.load(depth)
        if total:
            s.descend(depth)
        adjust = np.log10(s.p0) - np.log10(s.parent)  # a word of the class "other"
        s.sums = s.sums + np.add.reduceat(adjust[s.codes], s.begin)
        n, base = s.n[s.codes], root.base(s.n)[s.codes]
        sums = lambda v: pa.array(np.add.reduceat(v, s.begin))
        return pa.table([flat("doc_id"), flat("held_out"), pa.array(flat("sizes").to_numpy(zero_copy_only=False).astype(np.int64)),
                         sums((n > 0).astype(np.int64)), pa.array(np.full(len(s.begin), total, np.int64)), sums(base), pa.array(s.sums)],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return _per_slice(table, answers, root, tell, f"doc_id {ids}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op2_suffix_tree(spark, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"), crc_mod("doc_id", 10) != 0)
