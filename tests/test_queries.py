"""Every registered query against its DuckDB oracle on the smallest tables."""
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from rastertab.plans.registry import REGISTRY

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    sql = entry.oracle_sql().get(name)
    assert sql is not None, "every query of the library has an oracle"
    o = duck.execute(sql).fetchdf()
    assert sorted(o.columns) == cols
    o = o[cols].astype(object).where(o[cols].notna(), None)
    want = sorted((tuple(_norm(x) for x in r) for r in o.itertuples(index=False)), key=repr)
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0


def test_queries_are_repeatable_in_one_session(spark):
    """Building and running every query again in the same session gives the
    same row count (no state leaks between calls: cached scans, tables, streams)."""
    for name, fn in sorted((n, q.build) for n, q in REGISTRY.items()):
        first = fn(spark, SF_SMALL).count()
        assert fn(spark, SF_SMALL).count() == first, name


def test_queries_leave_no_table_names(spark):
    for name in ("slice_replace_time", "job_forecast_cycle", "job_population_slice", "stream_slices"):
        REGISTRY[name].build(spark, SF_SMALL).count()
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("rt_")] == []
