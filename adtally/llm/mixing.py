"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets: the sources, in code-point order with null last, weigh 5, 2, 1,
repeating, and share ``budget`` (150 %) of all words; a target stops at
``repeat_cap`` (2) times its source's words and the excess is reshared by
weight until none is above (water filling).

Blocks: every (source, shard) has a claim, its share of the source's target.
``floor(total / block_words)`` equal blocks are dealt to the claims by highest
quotient claim / (2 * seats + 1), which is the same as seats = round(claim /
divisor) for one divisor; the quotients around the divisor are ranked, so no
loop over blocks is needed. Inside a shard the documents stand in a seeded
order; the shard's quota of blocks covers that word stream from its start,
whole passes first, so each document is taken ``passes`` times plus the part
of it that the last, partial pass reaches.

Null and empty texts have size 0 and are never taken. Repeated rows are
documents of their own (ties in the seeded order are broken by id and text
hash; equal rows get consecutive places). An empty table gives no rows. Extra
columns are ignored. The result does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, materialize, read_table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
REPEAT_CAP = 2.0
BLOCK_WORDS = 16
SHARD_DOCS = 4096
SEED = 20240


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET,
                   repeat_cap: float = REPEAT_CAP) -> DataFrame:
    """(source, source_size, n_docs) -> the same with ``target``; one row per
    source comes in, so this is a small table however many documents there are."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    # sources reach their cap in the order of cap / weight: water filling by prefix sums
    fill = (F.col("source_size") * repeat_cap) / F.col("_w")
    by_fill = Window.orderBy("_fill", F.col("source").isNull(), F.col("source"))
    up_to = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    x = (weighed.withColumn("_fill", fill)
         .withColumn("_total", F.sum("source_size").over(everything) * budget)
         .withColumn("_capped", F.coalesce(F.sum(F.col("source_size") * repeat_cap).over(up_to), F.lit(0.0)))
         .withColumn("_open", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(up_to), F.lit(0.0)))
         .withColumn("_level", (F.col("_total") - F.col("_capped")) / F.col("_open"))
         # the level at the first source that stays below its cap holds for all later ones
         .withColumn("_at", F.when(F.col("_fill") > F.col("_level"), F.struct("_fill", F.col("source").isNull(), "source", "_level")))
         .withColumn("_stop", F.min("_at").over(everything)["_level"]))
    target = F.when(F.col("_stop").isNull() | (F.col("_fill") <= F.col("_stop")),
                    F.col("source_size") * F.lit(repeat_cap)).otherwise(F.col("_stop") * F.col("_w"))
    return x.withColumn("target", target.cast("double")).drop("_w", "_fill", "_total", "_capped", "_open", "_level", "_at", "_stop")


def apportion(claims: DataFrame, key: list[str], claim: str, seats_in_all) -> DataFrame:
    """Sainte-Lague seats for each row of ``claims`` (``key`` unique):
    ``seats_in_all`` (a column, the same on each row) seats by highest quotient.

    With divisor d = sum(claims) / seats, round(claim / d) misses the total by
    at most half a seat per row; only quotients that such a miss can move are
    listed, and the best of them are taken. Ties go to the smaller key."""
    everything = Window.partitionBy(F.lit(1))
    x = (claims.withColumn("_all", F.sum(claim).over(everything)).withColumn("_rows", F.count(F.lit(1)).over(everything))
         .withColumn("_seats", seats_in_all.cast("long"))
         .withColumn("_ideal", F.when(F.col("_all") > 0, F.col(claim) / F.col("_all") * F.col("_seats")).otherwise(0.0))
         .withColumn("_reach", F.ceil(F.col("_ideal") / F.greatest(F.col("_seats"), F.lit(1)) * F.col("_rows")) + 2)
         .withColumn("_sure", F.when(F.col(claim) > 0, F.greatest(F.lit(0), F.round("_ideal").cast("long") - F.col("_reach"))).otherwise(0))
         .withColumn("_dealt", F.sum("_sure").over(everything)))
    open_seats = (x.where(F.col(claim) > 0)
                  .withColumn("_seat", F.explode(F.sequence(F.col("_sure"), F.col("_sure") + 2 * F.col("_reach") + 1)))
                  .withColumn("_quotient", F.col(claim) / (2 * F.col("_seat") + 1)))
    best = Window.orderBy(F.desc("_quotient"), *[F.asc(k) for k in key])
    won = (open_seats.withColumn("_rank", F.row_number().over(best))
           .where(F.col("_rank") <= F.col("_seats") - F.col("_dealt"))
           .groupBy(*key).agg(F.count(F.lit(1)).alias("_won")))
    on = [F.col(f"x.{k}").eqNullSafe(F.col(f"won.{k}")) for k in key]
    return (x.alias("x").join(won.alias("won"), on, "left")
            .select("x.*", F.when(F.col(claim) > 0, F.col("_sure") + F.coalesce("_won", F.lit(0)))
                    .otherwise(0).cast("long").alias("quota"))
            .drop("_all", "_rows", "_seats", "_ideal", "_reach", "_sure", "_dealt"))


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, repeat_cap: float = REPEAT_CAP,
        block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS, seed: int = SEED,
        keep: tuple[str, ...] = ()) -> DataFrame:
    """documents -> (doc_id, size, source, source_size, target, shard, quota,
    start, taken, *keep); ``start`` is the document's place in its shard's
    word stream, ``keep`` names further columns to carry (given as ``k_name``)."""
    text_hash = F.xxhash64(F.col("text"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                    word_count(F.col("text")).alias("size"),
                    F.xxhash64(F.lit(seed), F.col("doc_id"), text_hash).alias("_place"),
                    *[F.col(k).alias(f"k_{k}") for k in keep])
    d = materialize(d, "mix-sizes")  # the texts are read once
    # about shard_docs documents a shard, by the seeded hash: a hot source has many shards
    counts = d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = (source_targets(counts, weights, budget, repeat_cap)
               .withColumn("n_shards", F.ceil(F.col("n_docs") / shard_docs).cast("long")))
    targets = materialize(targets, "mix-targets").withColumnRenamed("source", "t_source")
    placed = (d.join(targets, F.col("source").eqNullSafe(F.col("t_source")))
              .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("_place")), F.col("n_shards"))))
    shards = (placed.groupBy("source", "shard")
              .agg(F.sum("size").alias("shard_size"), F.first("source_size").alias("_ss"), F.first("target").alias("_t"))
              .withColumn("claim", F.when(F.col("_ss") > 0, F.col("_t") * F.col("shard_size") / F.col("_ss")).otherwise(0.0)))
    total = F.sum("claim").over(Window.partitionBy(F.lit(1)))
    shards = shards.withColumn("_blocks", F.round(total / block_words))
    quotas = apportion(shards, ["source", "shard"], "claim", F.col("_blocks"))
    # no shard gives more than its documents may: whole passes of repeat_cap at most
    quotas = materialize(quotas.select(F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "shard_size",
                                       "quota", F.least(F.col("quota") * block_words,
                                                        F.floor(F.col("shard_size") * repeat_cap)).alias("words")), "mix-quotas")
    order = Window.partitionBy("source", "shard").orderBy("_place", "doc_id")
    start = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    p = (placed.withColumn("start", start)
         .join(quotas, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard"))))
    passes = F.when(F.col("shard_size") > 0, F.floor(F.col("words") / F.col("shard_size"))).otherwise(0)
    rest = F.col("words") - passes * F.col("shard_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return p.select("doc_id", "size", "source", "source_size", "target", "shard", "quota", "start",
                    (passes * F.col("size") + part).cast("long").alias("taken"), *[f"k_{k}" for k in keep])


def cut_words(text, words):
    """``text`` up to the end of its first ``words`` words."""
    ends = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"  # a piece is a word with the space before it
    return F.array_join(F.slice(F.split(text, ends), F.lit(1), words.cast("int")), "")


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus, columns as in ``docs``: a document stands there once
    for each whole pass, and once more, cut after the words taken, for a partial
    one (``n_chars``, if there, is then the cut text's length)."""
    columns = docs.columns
    rows = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "mix-rows")
    found = mix(rows, keep=("__row",), **options).where(F.col("taken") > 0)
    found = materialize(found.select(F.col("k___row").alias("__r"), F.floor(F.col("taken") / F.col("size")).cast("int").alias("__whole"),
                                     (F.col("taken") % F.col("size")).alias("__rest")), "mix-taken")
    side = F.broadcast(found) if found.count() <= BROADCAST_IDS else found
    copies = F.concat(F.array_repeat(F.lit(0).cast("long"), F.col("__whole")),
                      F.when(F.col("__rest") > 0, F.array(F.col("__rest"))).otherwise(F.array().cast("array<bigint>")))
    out = (rows.join(side, rows["__row"] == side["__r"]).withColumn("__words", F.explode(copies))
           .withColumn("text", F.when(F.col("__words") > 0, cut_words(F.col("text"), F.greatest(F.col("__words"), F.lit(0)))).otherwise(F.col("text"))))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col("__words") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*columns)


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
