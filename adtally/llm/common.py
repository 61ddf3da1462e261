"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import shared_dir

# Bytes of text that one step of a Python task holds at a time.
SLICE_BYTES = 4 << 20
# Entries a task-local word cache holds before it starts afresh.
CACHE_WORDS = 400_000


def per_worker(key: tuple, make):
    """``make()``, kept as long as the Python worker lives (one value for the
    first part of ``key``). Functions of this package are pickled by value, so a
    module's globals would last for a task only."""
    held = sys.modules.setdefault("adtally_worker_values", types.ModuleType("adtally_worker_values")).__dict__
    if held.get(key[0], (None,))[0] != key:
        held[key[0]] = key, make()
    return held[key[0]][1]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts
    the lineage with files that survive a lost executor. The write's own
    shuffle files are deleted with its end, not at some later garbage collection."""
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{purpose}")
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(name, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*written: DataFrame) -> None:
    """Delete the files of ``materialize`` results that no later step reads."""
    for df in written:
        spark = df.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# Rows that one Arrow batch carries into a Python task (Spark's default: 10,000).
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Long texts: hand fewer rows at a time to Python tasks, unless the
    session already asks for fewer. Like the time zone of the other plans, a
    session setting."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


# lower case for A-Z; everything that is no letter, digit or non-ASCII byte is a gap
FOLD = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def crc_mod(col: str, n: int):
    """crc32 of the id written as text, modulo n; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cut Arrow batches so that each holds about ``limit`` bytes of text (one
    row at least); yields (rows, their texts as bytes, null as None)."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        if pa.types.is_string(col.type):
            col = col.cast(pa.binary())
        elif pa.types.is_large_string(col.type):
            col = col.cast(pa.large_binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at, n = 0, batch.num_rows
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at), col.slice(at, to - at).to_pylist()
            at = to


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, filled on demand and kept small."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x.copy()
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(33)
    return x


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive word hashes (order matters)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for j in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n]
        out ^= out >> np.uint64(29)
    return mix64(out)


def with_global_offset(parts: DataFrame, part: str, order: list, value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` over rows that lie range-ordered in
    the partitions numbered ``part``: sums per partition, offsets over that
    short table, running sums inside each partition."""
    from pyspark.sql import Window

    sums = parts.groupBy(part).agg(F.sum(value).alias("_sum"))
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col(part).alias("_part"), F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (parts.withColumn("_before", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(offsets, F.col(part) == F.col("_part"), "left")
            .withColumn(out, (F.col("_before") + F.col("_offset")).cast("long"))
            .drop("_part", "_before", "_offset"))


# Ids that may be broadcast to filter a table (8 bytes each, some 50 MB hashed).
BROADCAST_IDS = 1 << 20


def by_ids(df: DataFrame, ids: DataFrame, how: str, limit: int = BROADCAST_IDS, on: str = "doc_id") -> DataFrame:
    """``left_semi`` or ``left_anti`` of ``df`` by the one column of ``ids``
    against the column ``on`` (null equals null). ``ids`` must be materialised;
    it is broadcast while it has at most ``limit`` rows, else both sides shuffle."""
    key = ids.columns[0]
    side = ids.select(F.col(key).alias("__ids_key"))
    if ids.count() <= limit:
        side = F.broadcast(side)
    return df.join(side, df[on].eqNullSafe(side["__ids_key"]), how)


def bounded_sample(rows: DataFrame, most: int, seed: int, by: str | None = None) -> DataFrame:
    """Rows whose seeded hash of doc_id is low, about ``most`` of them in all,
    or of each value of ``by`` (every row while there are no more).
    Deterministic. Where ids repeat, in more rows than ``most`` or with ``by``, equal
    rows count once, whole rows are hashed instead, and the lowest ``most`` hashes stay."""
    n = 0 if by else rows.count()
    if not by and n <= most:
        return rows
    limit = 1 << 30
    place = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(limit))
    repeated = bool(rows.groupBy("doc_id").count().where("count > 1").take(1))
    if repeated:
        rows = rows.dropDuplicates()
        place = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in rows.columns]), F.lit(limit))
    lowest = lambda some, n: some.where(place < int(min(1.0, 1.2 * most / n) * limit)).orderBy(place).limit(most)
    if by:
        large = rows.groupBy(by).count().where(F.col("count") > most).collect()
        if repeated:
            out = rows
            for r in large:
                mine = F.col(by).eqNullSafe(F.lit(r[0]))
                out = out.where(~mine).unionByName(lowest(rows.where(mine), r[1]))
            return out
        for r in large:
            rows = rows.where(~F.col(by).eqNullSafe(F.lit(r[0])) | (place < int(most / r[1] * limit)))
        return rows
    if not repeated:
        return rows.where(place < int(most / n * limit))
    n = rows.count()
    return lowest(rows, n) if n > most else rows
