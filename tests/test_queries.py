"""Every registered query against its SQL in DuckDB."""

import checker
import pytest

from riskscan.plans import load

SF_DIR = "/root/testdata/sf0.001"
REGISTRY = load()


@pytest.fixture(scope="module")
def duck():
    return checker.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY.QUERIES))
def test_query(spark, duck, name):
    df = REGISTRY.QUERIES[name](spark, SF_DIR)
    if name in REGISTRY.ORACLES:
        assert checker.compare(df, duck, REGISTRY.ORACLES[name]) is None
    else:
        assert df.count() > 0
