"""Near-duplicate classes: one-permutation hashing with optimal densification,
banded buckets and star-shaped candidate edges, confirmed on full sets.

Set of a document: its distinct word shingles (A-Z lower-cased, words split at
ASCII white space; fewer words than the shingle: the whole sequence as one;
none: empty, linked with nothing). Shingles are 64-bit hashes.

1. Equal sets collapse into one node. Each node gets a signature of ``bins``
   values (minimum hash per bin; an empty bin copies the first non-empty bin
   in its own fixed random order) and ``bands`` bucket keys.
2. Stars: in each bucket, every member is paired with the bucket's smallest
   node only. Pairs are confirmed on full sets and linked.
3. Rest, exact: buckets whose members still lie in several components. Shingles
   in fewer than ``RARE`` of their nodes are rare. A second star goes out from
   each bucket's member with the smallest share of rare shingles. Then every
   pair across components is either
   - one that shares a rare shingle: listed by shingle (fewer than RARE nodes
     each), with the number shared; or
   - one that doesn't: then only frequent shingles can be common, which with
     the sizes bounds the similarity; a parity sketch (each shingle flips one of
     ``SKETCH`` bits) bounds it again, as sets differ in at least as many shingles
     as their sketches in bits. What remains is listed by bucket, from
     the members outside its largest component, ``slice_pairs`` at a time, with
     components merged in between.
   Pairs within the bounds are confirmed on full sets. No cap on partners: a
   link between two nodes that share a bucket is found or implied by others.
4. Components by minimum-label propagation with pointer jumping.

Two sets of similarity 0.8 share no bucket with probability (1 - 0.8^rows)^bands
= 8e-6 at 7 rows and 50 bands; that is the method's only approximation.

Defined results: null, empty and blank texts are classes of their own; a null
doc_id is a document without id (its class takes the smallest other id);
repeated rows are copies; an empty table gives no rows; extra columns are
ignored by ``classes`` and kept by ``keep_one``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, by_ids, materialize, mix64, read_table, shingle_hashes, small_batches, text_slices

SHINGLE = 5
SIMILARITY = 0.8
ROWS = 7
BANDS = 50
SLICE_PAIRS = 20_000_000
RARE = 32
SKETCH = 1024
SEED = 7
# Rows of a thin table that one file holds at least: a small table in few files is
# read by few tasks, and broadcast by the planner while its files are small.
FILE_ROWS = 1 << 13
# The same of a table with sets or band keys.
NODE_ROWS = 1 << 11
# Pairs of sets that one task compares at least.
TASK_PAIRS = 1 << 10


def few_files(df: DataFrame, most: int, rows: int = FILE_ROWS) -> DataFrame:
    """``df``, fresh from a shuffle and of at most ``most`` rows, in no more
    partitions than one for each ``rows`` of them."""
    return df.coalesce(1 + most // rows)


def set_of(text: bytes | None, hashes: WordHashes, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(shingle_hashes(hashes.of(words), min(width, len(words))))


def donors(bins: int, seed: int = SEED) -> np.ndarray:
    """Row i: the order in which empty bin i looks for a value."""
    rng = np.random.default_rng(seed)
    return np.argsort(rng.random((bins, bins)), axis=1)


def signature(values: np.ndarray, bins: int, order: np.ndarray) -> np.ndarray:
    """Densified one-permutation signature of sorted distinct hashes."""
    sig, there = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    at = (values % np.uint64(bins)).astype(np.int64)
    sig[at[::-1]] = values[::-1]  # the smallest value of a bin is written last
    there[at] = True
    empty = np.flatnonzero(~there)
    if len(empty):
        sig[empty] = sig[order[empty, np.argmax(there[order[empty]], axis=1)]]
    return sig


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    cells = sig.reshape(-1, rows)
    out = np.arange(1, len(cells) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(rows):
        out = mix64(out ^ cells[:, j]) + np.uint64(j)
    return out.view(np.int64)


def parity(values: np.ndarray) -> np.ndarray:
    """Sketch of a set: for each of SKETCH bits whether an odd number of members hash to it."""
    odd = np.bincount(((values >> np.uint64(40)) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def shingle_sets(docs: DataFrame, width: int, bands: int = 0, rows: int = ROWS) -> DataFrame:
    """(doc_id, n, digest binary(16), bands array<long>, sketch array<long>) or,
    without bands, (doc_id, n, digest, members binary: the sorted hashes, 8 bytes each)."""
    ids = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        hashes, order = WordHashes(), donors(bands * rows) if bands else None
        for rows_, texts in text_slices(batches):
            counts, digests, last, sketches = [], [], [], []
            for text in texts:
                s = set_of(text, hashes, width)
                counts.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                last.append((band_keys(signature(s, bands * rows, order), rows) if len(s) else np.empty(0, np.int64)) if bands else s.tobytes())
                sketches.append(parity(s) if bands else None)
            yield pa.RecordBatch.from_arrays(
                [rows_.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(last, pa.list_(pa.int64()) if bands else pa.binary()), pa.array(sketches, pa.list_(pa.int64()))],
                ["doc_id", "n", "digest", "last", "sketch"])

    out = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {ids}, n long, digest binary, last {'array<long>' if bands else 'binary'}, sketch array<long>")
    return out.withColumnRenamed("last", "bands") if bands else out.withColumnRenamed("last", "members").drop("sketch")


def confirm(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes whose sets are ``similarity`` alike or more; ``pairs`` are distinct."""
    top = round(similarity * 1000)
    pairs = materialize(pairs, "dup-pairs")
    n = pairs.count()

    def run(batches):
        for rows in batches:
            keep = np.zeros(rows.num_rows, bool)
            for i, (p, q) in enumerate(zip(rows.column(2).to_pylist(), rows.column(3).to_pylist())):
                left, right = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                at = np.searchsorted(left, right)
                both = int(np.count_nonzero(left[np.minimum(at, len(left) - 1)] == right))
                keep[i] = 1000 * both >= top * (len(left) + len(right) - both)
            yield pa.RecordBatch.from_arrays([rows.column(0).filter(pa.array(keep)), rows.column(1).filter(pa.array(keep))], ["a", "b"])

    sa, sb = (sets.select(F.col("node").alias(k), F.col("members").alias(f"m{k}")) for k in "ab")
    both = pairs.join(sb, "b").join(sa, "a").select("a", "b", "ma", "mb")
    tasks = 1 + n // TASK_PAIRS + sets.count() // NODE_ROWS  # a task reads its share of all sets
    return materialize(both.coalesce(tasks).mapInArrow(run, "a long, b long"), "dup-links") if n else pairs


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, comp): the smallest node reachable, for every node with a link.
    With ``known``, the components of earlier links, ``links`` are the new ones,
    and only the components that they join are labelled, as one node each."""
    if known is not None:
        of = lambda k: known.select(F.col("node").alias(k), F.col("comp").alias(f"_{k}"))
        links = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
                 .select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).where("a <> b"))
    size = 2 * links.count()
    if known is not None and not size:
        return known
    edges = materialize(few_files(links.select("a", "b").union(links.select("b", "a")).distinct(), size), "dup-edges")
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp"))
    labels = materialize(few_files(labels, size), "dup-labels")
    while True:
        seen = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("near"))
        step = labels.join(seen, labels["node"] == seen["a"]).select("node", F.least("comp", "near").alias("comp"), F.col("comp").alias("old"))
        jump = labels.select(F.col("node").alias("_n"), F.col("comp").alias("_c"))
        step = (step.join(jump, step["comp"] == jump["_n"], "left")
                .select("node", F.least("comp", F.coalesce("_c", "comp")).alias("comp"), "old"))
        step = materialize(few_files(step, size), "dup-labels")
        if step.where("comp <> old").isEmpty():
            break
        labels = step.select("node", "comp")
    labels = step.select("node", "comp")
    if known is None:
        return labels
    of = labels.select(F.col("node").alias("_n"), F.col("comp").alias("_c"))
    more = labels.join(known.select("node"), "node", "left_anti")
    return materialize(known.join(of, known["comp"] == of["_n"], "left").select("node", F.coalesce("_c", "comp").alias("comp")).union(more),
                       "dup-components")


def may_reach(n, private, m, other_private, similarity: float):
    """Whether sets of n and m members can be ``similarity`` alike when so many
    of each are in no other set."""
    both = F.least(n - private, m - other_private)
    return both >= similarity * (n + m - both) - 1e-9


def sketches_allow(n, sketch: str, m, other_sketch: str, similarity: float):
    """Whether sets of n and m members can be ``similarity`` alike: at least as
    many members are in one set only as their sketches have differing bits."""
    differing = sum((F.bit_count(F.col(sketch)[i].bitwiseXOR(F.col(other_sketch)[i])) for i in range(1, SKETCH // 64)),
                    F.bit_count(F.col(sketch)[0].bitwiseXOR(F.col(other_sketch)[0])))
    return differing * (1 + similarity) <= (n + m) * (1 - similarity) + 1e-6


def classes(docs: DataFrame, width: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS,
            rows: int = ROWS, slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    per_doc = materialize(shingle_sets(docs, width, bands, rows), "dup-docs")
    nodes = (per_doc.where(F.col("n") > 0).groupBy("digest")
             .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    nodes = materialize(few_files(nodes, per_doc.count(), NODE_ROWS).withColumn("node", F.monotonically_increasing_id()), "dup-nodes")
    keyed = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("center")).where("size > 1")
    members = materialize(keyed.join(shared.select("bucket", "center"), "bucket"), "dup-members")

    wanted = materialize(few_files(members.select("node").distinct(), members.count()), "dup-wanted")
    chosen = nodes.select("node", "doc_id", "digest").join(wanted, "node", "left_semi")
    chosen = materialize(chosen, "dup-chosen")
    # the sets of those nodes only, made again from their texts
    again = shingle_sets(by_ids(docs, chosen.select("doc_id"), "left_semi"), width).drop("n")
    again = again.join(chosen.select("node", "digest"), "digest").dropDuplicates(["node"]).select("node", "members")
    sets = materialize(few_files(again, wanted.count(), NODE_ROWS), "dup-sets")

    fits = lambda n, m: F.least(n, m) >= similarity * F.greatest(n, m) - 1e-9
    size = nodes.select(F.col("node").alias("_c"), F.col("n").alias("_m"))
    stars = (members.where("node <> center").select("center", "node", "n").distinct()
             .join(size, F.col("center") == F.col("_c")).where(fits(F.col("n"), F.col("_m")))
             .select(F.col("center").alias("a"), F.col("node").alias("b")))
    comp = components(confirm(stars, sets, similarity))
    comp = _rest(members, wanted.count(), sets, nodes.select("node", "sketch"), comp, similarity, slice_pairs)

    label = nodes.join(comp, "node", "left").select("node", "digest", "doc_id", F.coalesce("comp", "node").alias("comp"))
    smallest = label.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = label.join(smallest, "comp").select(F.col("digest").alias("_d"), "component_id")
    out = per_doc.select("doc_id", "n", "digest").join(named, (F.col("digest") == F.col("_d")) & (F.col("n") > 0), "left")
    component = F.coalesce("component_id", F.when(F.col("n") == 0, F.col("doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def _rest(members: DataFrame, n_nodes: int, sets: DataFrame, sketches: DataFrame, comp: DataFrame, similarity: float, slice_pairs: int):
    """Step 3: the components after links across components, exactly; ``members``
    are of ``n_nodes`` nodes."""
    n_members = members.count()

    def labelled(x):
        return x.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    def open_members():
        x = labelled(members.select("bucket", "node", "n"))
        several = x.groupBy("bucket").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo <> _hi").select("bucket")
        return materialize(few_files(x.join(several, "bucket"), n_members), "dup-open")

    left = open_members()
    if left.isEmpty():
        return comp
    nodes = materialize(few_files(left.select("node", "n", "comp").distinct(), n_nodes), "dup-open-nodes")
    # nodes by shingle, for the shingles of fewer than RARE of them
    spread = (sets.join(nodes.select("node", "comp"), "node").select("node", "comp", "members")
              .mapInArrow(_explode_sets, "node long, comp long, h long"))
    rare = spread.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") < RARE).select("h")
    lists = materialize(spread.join(rare, "h").groupBy("h").agg(F.collect_list(F.struct("comp", "node")).alias("held")).select("held"), "dup-rare")
    few = lists.select(F.explode("held.node").alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("private"))
    info = nodes.join(few, "node", "left").select("node", "n", F.coalesce("private", F.lit(0)).alias("private"))
    info = materialize(few_files(info, n_nodes), "dup-info")
    known = lambda x: x.join(info.select("node", "private"), "node")

    # second star: from the member with the smallest share of rare shingles
    left = materialize(known(left), "dup-left")
    best = left.groupBy("bucket").agg(F.min(F.struct((F.col("private") / F.col("n")).alias("share"), "node", "n", "comp")).alias("c"))
    star = (left.join(best, "bucket").where(F.col("comp") != F.col("c.comp"))
            .where(F.least(F.col("n"), F.col("c.n")) >= similarity * F.greatest(F.col("n"), F.col("c.n")) - 1e-9)
            .select(F.col("c.node").alias("a"), F.col("node").alias("b")).distinct())
    comp = components(confirm(star, sets, similarity), comp)

    # pairs that share a rare shingle, with the number of rare ones they share: lists
    # that mix components, once more with the components of now
    mixed = (lists.where(F.size(F.array_distinct("held.comp")) > 1).withColumn("list", F.monotonically_increasing_id())
             .select("list", F.explode("held.node").alias("node")))
    held = labelled(mixed.join(info, "node")).groupBy("list").agg(F.collect_list(F.struct("comp", "node", "n", "private")).alias("held"))
    sharing = (held.where(F.size(F.array_distinct("held.comp")) > 1).select("held", F.explode("held").alias("x"))
               .select("x", F.explode(F.filter("held", lambda y: (F.col("x.node") < y["node"]) & (F.col("x.comp") != y["comp"]))).alias("y"))
               .groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b"),
                        F.col("x.private").alias("p_a"), F.col("y.private").alias("p_b")).agg(F.count(F.lit(1)).alias("shared")))
    common = F.least(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b")) + F.col("shared")
    near = sharing.where(common >= similarity * (F.col("n_a") + F.col("n_b") - common) - 1e-9).select("a", "b")
    comp = components(confirm(near, sets, similarity), comp)

    # pairs that share none: rare shingles count for neither. The largest component of
    # each bucket waits, the others' members go out; chosen once, as components only grow
    left = known(open_members())
    per = left.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    top = per.groupBy("bucket").agg(F.max(F.struct("k", "comp")).alias("_t"), F.sum("k").alias("size"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    rest = left.join(top, "bucket").where(F.col("comp") != F.col("_t.comp"))
    # the best partner a member can have: as many members as it can share, within the bucket's sizes
    ideal = F.greatest(F.col("lo"), F.least(F.col("hi"), F.col("n") - F.col("private")))
    rest = rest.where(may_reach(F.col("n"), F.col("private"), ideal, F.lit(0), similarity)).select("bucket", "node", "size")
    rest = materialize(few_files(rest, n_members), "dup-rest")
    total = rest.agg(F.sum("size")).first()[0] or 0
    slices = -(-total // slice_pairs)
    for turn in range(slices):
        left = known(open_members()) if turn else left
        part = rest.where(F.pmod(F.xxhash64("node"), F.lit(slices)) == turn).select("bucket", "node")
        drawn = left.join(sketches, "node")
        other = drawn.select("bucket", F.col("node").alias("b"), F.col("n").alias("m"), F.col("private").alias("q"), F.col("comp").alias("d"),
                             F.col("sketch").alias("other_sketch"))
        pairs = (drawn.join(part, ["bucket", "node"]).select("bucket", F.col("node").alias("a"), "n", "private", "comp", "sketch")
                 .join(other, "bucket").where(F.col("comp") != F.col("d"))
                 .where(may_reach(F.col("n"), F.col("private"), F.col("m"), F.col("q"), similarity)
                        & sketches_allow(F.col("n"), "sketch", F.col("m"), "other_sketch", similarity))
                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        comp = components(confirm(pairs, sets, similarity), comp)
    return comp


def _explode_sets(batches):
    for rows in batches:
        found = [np.frombuffer(x, np.int64) for x in rows.column(2).to_pylist()]
        sizes = [len(x) for x in found]
        repeat = lambda i: pa.array(np.repeat(rows.column(i).to_numpy(), sizes))
        yield pa.RecordBatch.from_arrays([repeat(0), repeat(1), pa.array(np.concatenate([*found, np.empty(0, np.int64)]))],
                                         ["node", "comp", "h"])


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with all its columns, one row of each class: one of its smallest
    doc_id, a null id last. Rows are told apart by a 64-bit hash of id and text;
    of rows equal in both any one stays. Texts without words all stay."""
    key = F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").cast("string"))
    named = docs.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), key.alias("key")).alias("doc_id"), "text")
    found = materialize(classes(named, **options).select(F.col("doc_id.key").alias("key"), "kept", "n_shingles"), "dup-found")
    gone = materialize(found.where("not kept").select("key").distinct(), "dup-gone")
    out = by_ids(docs.withColumn("__key", key), gone, "left_anti", on="__key")
    again = materialize(found.where("kept and n_shingles > 0").groupBy("key").count().where("count > 1").select("key"), "dup-again")
    if not again.isEmpty():
        out = by_ids(out, again, "left_anti", on="__key").union(by_ids(out, again, "left_semi", on="__key").dropDuplicates(["__key"]))
    return out.select(*docs.columns)


def op7_minhash(spark, sf_dir: str) -> DataFrame:
    return classes(read_table(spark, sf_dir, "documents"), width=2)


ORACLE_SQL = r"""
WITH RECURSIVE lists AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 1 THEN [words[1]]
                                      ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS s
  FROM lists WHERE len(words) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""
