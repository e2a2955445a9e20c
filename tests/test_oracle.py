"""Every driver query against its DuckDB oracle on the smallest tables (the driver runs sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import compare  # noqa: E402

from matchbook.plans import oracle, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(queries.QUERIES) == set(oracle.ORACLE)
    assert set(queries.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["symbol", "fills", "volume", "notional"]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_matches_oracle(spark, name):
    rec = compare(spark, SF, [name])[name]
    assert rec["schema_match"], rec
    assert rec["spark_rows"] == rec["oracle_rows"], rec
    assert rec["value_match"], rec
