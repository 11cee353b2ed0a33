"""The operators' queries against their SQL, on whole small tables."""
import duckdb
import pytest

from conftest import SF_SMALL
from rastertab import llm


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = llm.QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    done = con.execute(llm.ORACLES[name])
    names = [d[0] for d in done.description]
    assert sorted(names) == cols
    want = sorted(tuple(repr(r[names.index(c)]) for c in cols) for r in done.fetchall())
    got = sorted(tuple(repr(r[c]) for c in cols) for r in df.collect())
    assert got == want and got
