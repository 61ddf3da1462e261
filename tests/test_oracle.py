"""Every registered query against its DuckDB SQL on the given tables
(row count, column names, order-insensitive values)."""

from __future__ import annotations

import importlib.util
import os

import pytest

from adtally.catalog import queries
from adtally.oracle import oracle_sql

SF_DIR = os.environ.get("ADTALLY_TEST_SF", "/root/testdata/sf0.001")
_spec = importlib.util.spec_from_file_location(
    "compare_oracle", os.path.join(os.path.dirname(__file__), "..", "scripts", "compare_oracle.py"))
cmp = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(cmp)


@pytest.fixture(scope="module")
def con():
    return cmp.duck(SF_DIR)


def test_every_query_has_oracle():
    assert set(queries()) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    got = queries()[name](spark, SF_DIR).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert cmp.normalise(got).equals(cmp.normalise(want))


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["partner_id", "aggregated_amount", "fraudulent_amount",
                          "total_billing_amount", "window_start", "window_end"]
