"""Driver contract and a subset of the DuckDB oracles at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "supplier", "events"]
SUBSET = ["top2_worst_services", "det2_features", "det4_sigma3_multi", "pql3_histogram_quantile",
          "pql9_mesh_health", "cor1_corr_matrix", "cor5_lagged_corr_edges", "det5_iqr_anomalies",
          "rca7_downstream_root_cause", "det11_performance_features", "det15_edge_anomalies",
          "agg14_degrees", "src9_wide_to_long"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 4) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return str(v)


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["service_id", "sigma_rate"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SUBSET)
def test_oracle_subset(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    rel = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(df.columns)
    a = sorted(tuple(_norm(r[c]) for c in order) for r in df.collect())
    drows = [dict(zip(dcols, r)) for r in rel.fetchall()]
    b = sorted(tuple(_norm(r[c]) for c in order) for r in drows)
    assert a == b
