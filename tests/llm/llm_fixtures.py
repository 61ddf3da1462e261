from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """documents from (doc_id, text[, lang, source]) rows, in several partitions."""
    def make(rows, extra=""):
        full = [(r + (None,) * 5)[:4] + (len(r[1]) if r[1] is not None else None,) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)
    return make


@pytest.fixture
def table(spark, tmp_path):
    """Writes named tables into a folder shaped like the given ones."""
    def write(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write
