"""Every registered query against its DuckDB statement (the driver's check) at sf0.001."""

import importlib.util
import os

import pytest

from compare import compare, duck
from hourmill.plans.queries import REGISTRY

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


ENTRY = _entry()
NAMES = sorted(REGISTRY)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(ENTRY.queries())
    assert set(REGISTRY) <= set(ENTRY.oracle_sql()) <= set(ENTRY.queries())


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0 and df.columns[0] == "timestamp"


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(ENTRY.queries()[name](spark, SF), con, ENTRY.oracle_sql()[name])
    assert res["ok"], res


@pytest.mark.parametrize("name", ["zip_rows_ragged", "explode_records"])
def test_line_documents_bounded_and_exact(spark, con, monkeypatch, name):
    """With tiny blocks an order's lines spread over many documents; the
    result still equals the oracle and no document exceeds the block."""
    from pyspark.sql import functions as F

    from hourmill.plans import queries as q
    from hourmill.plans import testbed as tb

    monkeypatch.setattr(q, "DOC_BLOCK_ROWS", 3)
    res = compare(q.REGISTRY[name](spark, SF), con, ENTRY.oracle_sql()[name])
    assert res["ok"], res
    li = q._line_blocks(tb.load(spark, SF, "lineitem"), ["l_orderkey"])
    sizes = li.groupBy("l_orderkey", "_file", "_block").count()
    assert sizes.agg(F.max("count")).first()[0] <= 3
    assert sizes.select("l_orderkey").distinct().count() < sizes.count()  # orders really are split
