"""Document fingerprints from closed syncmers, with DataFrame functions only.

A closed syncmer is a k-mer (``K`` code points) one of whose two outermost
s-mers (``S`` code points) has the smallest hash of all its s-mers. Whether a
k-mer is one depends on the k-mer alone, so shared passages give the same
anchors at shifted places. Texts too short for the window guarantee (fewer than
2 K - S + 1 code points) take all their k-mers, and texts shorter than K are
one anchor as a whole.

``anchors`` lists (position, hash) of every anchor. A fingerprint keeps the
smallest anchor hash of each of ``SLOTS`` slots, 8 hex digits each ("." where
empty); ``likeness`` is the share of slots, filled in either, that agree: an
estimate of the anchor sets' Jaccard similarity. It is 1 for equal
fingerprints, also empty ones.

``matches`` is the positional matching: each anchor of a document is joined with
the first place that has it (smallest doc_id, then position), and anchors of one
document, source and shift that lie within K of each other make a span. So every
passage that also stands earlier is covered by spans, and a passage in n
documents costs n rows, not pairs of documents. Anchors that make up more than
1 / ``HOT`` of all are at most HOT; these are broadcast, the others joined by a shuffle.

A text is cut into blocks of ``BLOCK`` starts that overlap by K - 1, so the
cost is linear in its length. The s-mer hashes of a block are computed once, in
compiled code, from pieces of ``PIECE`` starts: a place in a string is found by
walking to it, and in a piece the walk is short.

Defined results: null counts as empty; an empty text has no anchors and the
fingerprint of dots alone; repeated rows (also of one id) are documents of
their own, ordered by text hash; a null id stands before all others; an empty
table gives no rows; one document is its own next. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, read_table

K = 16
S = 8
SLOTS = 64
BLOCK = 64
PIECE = 8
# Range parts per shuffle partition.
PARTS = 4
# Most anchors that ``matches`` treats as hot.
HOT = 1024


def anchors(texts: DataFrame, key: list[str], text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """(*key, pos, anchor) of each anchor of ``text``; one row with nulls for a
    text without any."""
    w = k - s + 1
    n = F.length(F.col(text))
    inside = range(BLOCK + k - s)  # places of s-mers; past the end of a short block they are of no use
    piece = lambda i: F.substring(F.col("_t"), F.lit(i - i % PIECE + 1), F.lit(PIECE + s - 1))
    smers = F.array(*[F.hash(F.substring(piece(i), F.lit(i % PIECE + 1), F.lit(s))) for i in inside])
    # a block is the next BLOCK starts with what the last of them needs
    cut = f"(?s)(?=(.{{1,{BLOCK + k - 1}}})).{{1,{BLOCK}}}"
    blocks = (texts.select(*key, n.alias("_n"), F.posexplode_outer(F.regexp_extract_all(F.col(text), F.lit(cut), F.lit(1))).alias("_b", "_t"))
              .withColumn("_starts", F.least(F.lit(BLOCK), F.length("_t") - (k - 1)))
              .withColumn("_h", smers))
    at = F.when((F.col("_n") > 0) & (F.col("_n") < k), F.array(F.lit(0))).when(F.col("_b").isNotNull() & (F.col("_starts") > 0), F.sequence(F.lit(0), F.col("_starts") - 1))
    placed = blocks.select(*key, "_n", "_b", "_t", "_h", F.explode_outer(at).alias("_i"))
    inner = [F.get(F.col("_h"), F.col("_i") + j) for j in range(w)]
    closed = F.least(inner[0], inner[-1]) == F.least(*inner)
    chosen = (F.col("_n") < 2 * k - s + 1) | closed
    hits = placed.where(F.col("_b").isNull() | (F.col("_i").isNotNull() & chosen))  # no block: an empty text
    return hits.select(*key, (F.col("_b") * BLOCK + F.col("_i")).alias("pos"),
                       F.when(F.col("_i").isNotNull(), F.xxhash64(F.substring(F.col("_t"), F.col("_i") + 1, F.lit(k)))).alias("anchor"))


def slot_minima(found: DataFrame, key: list[str], slots: int = SLOTS) -> DataFrame:
    """Smallest anchor per (key, slot); partial sums before any shuffle."""
    return (found.withColumn("slot", F.pmod(F.col("anchor"), F.lit(slots)).cast("int"))
            .groupBy(*key, "slot").agg(F.min("anchor").alias("low")))


def written(minima, slots: int = SLOTS):
    """Array of (slot, low) -> the fingerprint string."""
    by = F.map_from_entries(minima)
    cell = lambda i: F.coalesce(F.lpad(F.lower(F.hex(F.shiftrightunsigned(F.element_at(by, i), 32))), 8, "0"), F.lit("." * 8))
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), cell), "")


def likeness(a, b, slots: int = SLOTS):
    """Share of slots filled in either fingerprint that agree."""
    places = F.sequence(F.lit(0), F.lit(slots - 1))
    part = lambda x, i: F.substring(x, i * 8 + 1, F.lit(8))
    empty = F.lit("." * 8)
    either = F.size(F.filter(places, lambda i: (part(a, i) != empty) | (part(b, i) != empty)))
    same = F.size(F.filter(places, lambda i: (part(a, i) != empty) & (part(a, i) == part(b, i))))
    return F.when(a == b, F.lit(1.0)).when(either == 0, F.lit(0.0)).otherwise(same / either)


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """Each row with the text of the next one in descending (doc_id, text)
    order, the first following the last: (part, place, ghost, doc_id, text,
    next_text). The table is cut into id ranges; each range also gets, as a
    ghost row at its head, the last row of the range below it (the highest of
    all for the lowest range), so that neighbours always stand in one range."""
    # read_docs: null texts are empty; the hash orders rows of one id
    x = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    x = x.withColumn("_o", F.xxhash64("text"))
    cuts = x.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10_000)).first()[0] or [] if parts > 1 else []
    cuts = sorted(set(cuts))  # at most parts - 1
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("doc_id"))) if cuts else F.lit(0)
    x = x.withColumn("part", F.when(F.col("doc_id").isNull(), 0).otherwise(above).cast("int"))
    last = x.groupBy("part").agg(F.max(F.struct(F.coalesce(F.col("doc_id").isNotNull(), F.lit(False)).alias("there"), "doc_id", "_o")).alias("k")).collect()
    if not last:
        return x.select("part", F.lit(1).alias("place"), F.lit(False).alias("ghost"), "doc_id", "text", F.lit("").alias("next_text")).limit(0)
    last = sorted((r["part"], r["k"]["doc_id"], r["k"]["_o"]) for r in last)  # one row a range
    heads = [(last[(i + 1) % len(last)][0], doc, o) for i, (_, doc, o) in enumerate(last)]
    head = docs.sparkSession.createDataFrame(heads, f"to int, _d {x.schema['doc_id'].dataType.simpleString()}, _p long")
    ghosts = (x.join(F.broadcast(head), x["doc_id"].eqNullSafe(head["_d"]) & (x["_o"] == head["_p"]))
              .select("doc_id", "text", "_o", F.col("to").alias("part"), F.lit(True).alias("ghost")))
    both = x.select("doc_id", "text", "_o", "part", F.lit(False).alias("ghost")).union(ghosts)
    order = Window.partitionBy("part").orderBy(F.desc("ghost"), F.asc_nulls_first("doc_id"), "_o")
    return both.select("part", F.row_number().over(order).alias("place"), "ghost", "doc_id", "text",
                       F.lag("text").over(order).alias("next_text"))


def matches(docs: DataFrame, k: int = K, s: int = S, hot: int = HOT) -> DataFrame:
    """(doc_id, start, end, source_id, source_start, n_anchors): spans of code
    points [start, end) of documents that also stand at ``source_start`` of an
    earlier place, be it in the same document. Texts of fewer than K code points
    match as a whole. Rows of one id are told apart by their texts; equal rows
    are matched once."""
    x = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).dropDuplicates()
    x = x.withColumn("_o", F.xxhash64("text")).withColumn("_len", F.length("text"))
    found = materialize(anchors(x, ["doc_id", "_o", "_len"], k=k, s=s).where(F.col("anchor").isNotNull()), "syncmer-anchors")
    place = F.struct(F.col("doc_id").isNotNull().alias("there"), "doc_id", "_o", "pos")
    per = found.groupBy("anchor").agg(F.min(place).alias("source"), F.count(F.lit(1)).alias("n"))
    per = materialize(per.where(F.col("n") > 1), "syncmer-sources")
    most = per.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") > most / hot  # of at most ``hot`` anchors
    named = lambda side, name: side.select("anchor", F.col("source").alias(name))
    y = found.join(F.broadcast(named(per.where(often), "_hot")), "anchor", "left")
    # hot anchors are done: a key of their own spreads them past the shuffled join
    y = y.withColumn("_key", F.when(F.col("_hot").isNull(), F.col("anchor")).otherwise(F.xxhash64("doc_id", "_o", "pos")))
    rest = named(per.where(~often), "_cold").withColumnRenamed("anchor", "_key")
    y = y.join(rest, "_key", "left").withColumn("source", F.coalesce("_hot", "_cold")).where(F.col("source").isNotNull())
    y = y.where(~(F.col("source.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("source._o") == F.col("_o")) & (F.col("source.pos") == F.col("pos"))))
    y = y.select("doc_id", "_o", "_len", "pos", F.col("source.doc_id").alias("source_id"), F.col("source._o").alias("_so"),
                 (F.col("pos") - F.col("source.pos")).alias("_shift"))
    line = ["doc_id", "_o", "_len", "source_id", "_so", "_shift"]
    along = Window.partitionBy(*line).orderBy("pos")
    y = y.withColumn("_new", (F.col("pos") - F.coalesce(F.lag("pos").over(along), F.lit(-k - 1)) > k).cast("int"))
    y = y.withColumn("_span", F.sum("_new").over(along))
    out = y.groupBy(*line, "_span").agg(F.min("pos").alias("start"), F.least(F.max("pos") + k, F.max("_len")).alias("end"), F.count(F.lit(1)).alias("n_anchors"))
    return out.select("doc_id", "start", "end", "source_id", (F.col("start") - F.col("_shift")).alias("source_start"), "n_anchors")


def op6_syncmers(spark, sf_dir: str) -> DataFrame:
    parts = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    x = with_next(read_table(spark, sf_dir, "documents"), parts)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    # own text, and the edited one where a neighbour is known
    own = F.struct(F.lit(0).alias("which"), F.col("text").alias("t"))
    variants = F.when(F.col("ghost"), F.array(own)).otherwise(F.array(own, F.struct(F.lit(1).alias("which"), edited.alias("t"))))
    both = (x.select("part", "place", "ghost", "doc_id", F.explode(variants).alias("v"))
            .select("part", "place", "ghost", "doc_id", F.col("v.which").alias("which"), F.col("v.t").alias("text"))
            .withColumn("sha", F.when(F.col("which") == 1, F.sha2(F.col("text").cast("binary"), 256)))
            .withColumn("chars", F.length("text")))
    key = ["part", "place", "ghost", "doc_id", "which", "sha", "chars"]
    low = slot_minima(anchors(both, key), key)
    # all groupings contain ``part``, by which the rows already lie: no further shuffle
    entry = F.when(F.col("slot").isNotNull(), F.struct("slot", "low"))
    prints = (low.groupBy(*key).agg(F.collect_list(entry).alias("minima"))
              .select(*key, written(F.col("minima")).alias("print")))
    one = prints.groupBy("part", "place", "ghost", "doc_id").agg(
        F.max(F.when(F.col("which") == 0, F.col("chars"))).cast("long").alias("n_chars"), F.max("sha").alias("edited_sha256"),
        F.max(F.when(F.col("which") == 0, F.col("print"))).alias("fingerprint"),
        F.max(F.when(F.col("which") == 1, F.col("print"))).alias("edited_fingerprint"))
    after = F.lag("fingerprint").over(Window.partitionBy("part").orderBy("place"))
    out = one.withColumn("_next", after).where(~F.col("ghost"))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                      likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"))
