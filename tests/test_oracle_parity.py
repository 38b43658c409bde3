"""Every registered query against its DuckDB twin (the driver's correctness gate), at sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from conftest import SF_SMALL  # noqa: E402


def _registry():
    from aerolith.plans.registry import load_all
    return load_all()


@pytest.fixture(scope="module")
def duck():
    import parity
    return parity.duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(_registry()))
def test_query_matches_oracle(spark, duck, name):
    import parity
    fn, oracle = _registry()[name]
    res = parity.compare(name, spark, duck, SF_SMALL, fn, oracle)
    assert res["status"] in ("OK", "rows-only"), res
    if oracle is None:
        assert res["spark_rows"] >= 0


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
