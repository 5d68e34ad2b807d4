"""Every registered query with an oracle equals DuckDB on the smallest data."""

import os

import pytest

import oracle_harness

SF = os.environ.get("TOKSCOPE_TEST_SF", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_all_queries_match_oracle(spark):
    from tokscope.plans.catalog import queries
    res = oracle_harness.run(SF, names=list(queries()), spark=spark, verbose=False)
    bad = {k: v for k, v in res.items() if v.get("hash_ok") is False or v.get("cols_ok") is False}
    assert not bad, bad
    assert all(v["rows"] >= 0 for v in res.values())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
