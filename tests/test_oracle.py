"""Every registered query against its SQL on the same tables."""

import importlib.util
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
from registry import catalog  # noqa: E402

_spec = importlib.util.spec_from_file_location("check", Path(__file__).resolve().parent.parent / "tools" / "check.py")
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)


@pytest.fixture(scope="session")
def con(sf):
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


NAMES = [n for n in catalog.QUERIES]


@pytest.mark.parametrize("name", NAMES)
def test_query(name, spark, sf, con):
    df = catalog.QUERIES[name](spark, sf)
    if name not in catalog.ORACLES:
        assert df.count() > 0
        return
    problem, _ = check.compare(df, con, catalog.ORACLES[name])
    assert problem is None, problem


def test_every_query_reads_a_given_table(spark, sf):
    """Plans reach the stored tables, so work grows with the data."""
    for name in NAMES:
        if name.startswith(("src", "snk", "str")):
            continue  # these read back what they wrote from a given table
        plan = catalog.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert "parquet" in plan.lower() or "Relation" in plan


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
