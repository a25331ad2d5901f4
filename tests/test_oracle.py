"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import compare  # noqa: E402

from flightmarts.plans.queries import QUERIES  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res[0] == "ok", res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["month_start", "carrier_code", "carrier_name"]
    assert df.count() > 0
