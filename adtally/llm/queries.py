"""Registry of the operators' queries: name -> function(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversations, crosstoken, debruijn, decontaminate, language, minhash, mixing, quality, revisits, suffix_tree, syncmers, tokens, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_token_output": tokens.op1_token_output,
        "op2_suffix_tree": suffix_tree.op2_suffix_tree,
        "op3_revisits": revisits.op3_revisits,
        "op4_decontamination": decontaminate.op4_decontamination,
        "op5_quality": quality.op5_quality,
        "op6_syncmers": syncmers.op6_syncmers,
        "op7_minhash": minhash.op7_minhash,
        "op8_mixing": mixing.op8_mixing,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_language": language.op10_language,
        "op11_alignment": crosstoken.op11_alignment,
        "op12_conversations": conversations.op12_conversations,
        "op13_repeats": debruijn.op13_repeats,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_revisits": revisits.ORACLE_SQL,
        "op4_decontamination": decontaminate.ORACLE_SQL,
        "op7_minhash": minhash.ORACLE_SQL,
        "op13_repeats": debruijn.ORACLE_SQL,
    }
