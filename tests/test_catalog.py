"""Every catalogued query against its DuckDB twin on the smallest tables."""

import decimal
from pathlib import Path

import duckdb
import pytest

from tidelog.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        db.execute(f"create view {p.stem} as select * from '{p}'")
    return db


def rows(names, got):
    plain = lambda v: float(v) if isinstance(v, decimal.Decimal) else v
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in got), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_the_oracle(spark, db, name):
    df = QUERIES[name](spark, SF)
    want = db.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(names, want.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 25
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["filter_compare"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), IsNotNull(o_orderstatus), GreaterThanOrEqual(o_totalprice,20" in plan  # the plan's text is cut there
    assert "o_custkey" not in plan
    assert "TakeOrderedAndProject" in QUERIES["topk_orders"](spark, SF)._jdf.queryExecution().executedPlan().toString()
