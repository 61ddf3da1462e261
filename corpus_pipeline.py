"""Corpus pipeline: raw documents -> filtered, deduplicated, decontaminated and
mixed documents -> token files.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``docs``. Cases (nulls,
empty texts, repeated rows, empty tables, extra columns) are those of the
operators, stated in their modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.config import shared_dir
from adtally.llm import decontaminate, minhash, mixing, tokens, toxicity
from adtally.llm.common import materialize, read_table

# No SQL: tokenizer, classifier and hashed signatures.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by a model of the labelled ones."""
    weights = toxicity.fit(toxicity.labelled(docs, read_table(spark, sf_dir, "labels"), "toxic", most=toxicity.TRAIN_DOCS))
    scored = toxicity.score(docs, weights, "__toxicity")
    return scored.where(F.col("__toxicity") < toxicity.THRESHOLD).drop("__toxicity")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the smallest doc_id."""
    return minhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents at their sources' target weights, repeats included."""
    return mixing.apply_mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; a row per document row, read from the files."""
    path = shared_dir(spark, "llm-tokens")
    tokens.write(docs, path, tokens.tokenizer_file(), keep=("source",))
    return tokens.with_starts(spark, path, ["k_source"]).withColumnRenamed("k_source", "source")


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
