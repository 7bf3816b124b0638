"""Every registered query against its DuckDB oracle on the smallest test tables,
plus the driver's smoke entry."""

import os

import pytest

import __spark_entry__ as se
from tests.oracle_check import check

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_every_query_has_an_oracle():
    assert set(se.own_queries()) == set(se.own_oracle_sql())


def test_queries_match_oracle(spark):
    res = check(spark, SF, names=sorted(se.own_queries()), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] is not True}
    assert not bad, bad


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "channel_name" in df.columns
