"""Registered queries against their SQL, and the pipeline against its stages."""

import duckdb
import pytest

from tracewise.llm import queries

SF = "/root/testdata/sf0.001"


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(str(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    rel = con.execute(queries.ORACLES[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(cols, rel.fetchall())


def test_thirteen_queries_and_the_pipeline():
    import __spark_entry__ as entry
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLES) <= set(entry.oracle_sql())
