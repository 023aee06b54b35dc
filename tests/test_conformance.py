"""Every registered query against its DuckDB oracle at sf0.01 (order-insensitive)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare  # noqa: E402

from strata.plans.conformance import QUERIES  # noqa: E402

# The corpus operators have tests of their own.
NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) and set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf01, name):
    status, detail = compare(spark, sf01, [name], verbose=False)[name]
    assert status == "ok", detail


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "victoires" in df.columns
