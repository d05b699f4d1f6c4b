"""Every query of the telemetry part against its SQL counterpart."""

import os

import pytest

from compare import TESTDATA, compare, duck

import __spark_entry__ as entry
from weighline.plans.queries import REGISTRY

SF = os.environ.get("WEIGHLINE_ORACLE_SF", f"{TESTDATA}/sf0.001")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    assert compare(con, ORACLE[name], QUERIES[name](spark, SF)) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "batch_instance_id" in df.columns
    assert set(REGISTRY) <= set(QUERIES) and set(REGISTRY) <= set(ORACLE) <= set(QUERIES)
