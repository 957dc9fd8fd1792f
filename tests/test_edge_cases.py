"""Edge-RCA chain fixture (C5) and edge cases."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tracewise.functions.columns import pearson
from tracewise.operators.features import add_features
from tracewise.operators.normalize import baseline_stats, zscore
from tracewise.plans import edge_rca


def _series(spark, edges, n=30, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=n)
    rows = []
    t0 = dt.datetime(2024, 1, 1)
    for (s, d) in edges:
        noise = rng.normal(scale=0.05, size=n)
        for i in range(n):
            rows.append((t0 + dt.timedelta(hours=3 * i), s, d, float(100 + 10 * base[i] + noise[i]),
                         0.0, 1.0, True, i >= n // 2))
    return spark.createDataFrame(rows, "ts timestamp_ntz, src string, dst string, rt double, error double, "
                                       "qps double, in_base boolean, in_cur boolean")


def test_chain_search_follows_correlated_anomalies_and_stops_on_cycles(spark):
    # E -> f -> g with correlated latency; g -> e closes a cycle
    edges = [("e", "f"), ("f", "g"), ("g", "e")]
    w = _series(spark, edges)
    anomalies = spark.createDataFrame([(s, d, "performance") for s, d in edges], "src string, dst string, kind string")
    entry = spark.createDataFrame([("e",)], "entry string")
    out = {r["chain"]: r["root"] for r in edge_rca.root_cause_chains(anomalies, w, entry).collect()}
    assert out == {"e -> f -> g": "g"}


def test_chain_search_prunes_uncorrelated_edges(spark):
    w1 = _series(spark, [("e", "f")], seed=1)
    w2 = _series(spark, [("f", "g")], seed=2)      # independent latency
    anomalies = spark.createDataFrame([("e", "f", "performance"), ("f", "g", "performance")],
                                      "src string, dst string, kind string")
    entry = spark.createDataFrame([("e",)], "entry string")
    out = [r["chain"] for r in edge_rca.root_cause_chains(anomalies, w1.unionByName(w2), entry).collect()]
    assert out == ["e -> f"]


def test_degenerate_inputs(spark):
    # Constant series, one-row key, zero previous value: no exception
    t0 = dt.datetime(2024, 1, 1)
    rows = [("c", t0 + dt.timedelta(hours=i), 5.0) for i in range(12)] + [("one", t0, 3.0)] + \
           [("z", t0 + dt.timedelta(hours=i), float(v)) for i, v in enumerate([0, 4, 0, 2])]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double")
    st = baseline_stats(df, ["k"], ["x"])
    z = {r["k"]: r["z_x"] for r in zscore(df, st, ["k"], ["x"]).collect()}
    assert z["one"] == 0.0 and z["c"] == 0.0
    r = df.filter(F.col("k") == "c").select(pearson("x", "x").alias("r")).first()["r"]
    assert r is None
    f = add_features(df, ["k"], ["x"], naming="plain", calendar=False).filter(F.col("k") == "z").orderBy("ts")
    rc = [row["rate_change"] for row in f.collect()]
    assert rc[1] == 0.0        # previous value 0 -> undefined -> 0
    assert rc[2] == -1.0


def test_unseen_key_scores_zero_and_is_marked(spark):
    t0 = dt.datetime(2024, 1, 1)
    base = spark.createDataFrame([("a", t0, 1.0), ("a", t0 + dt.timedelta(hours=1), 3.0)],
                                 "k string, ts timestamp_ntz, x double")
    scored = spark.createDataFrame([("a", t0, 2.0), ("new", t0, 7.0)], "k string, ts timestamp_ntz, x double")
    st = baseline_stats(base, ["k"], ["x"])
    got = {r["k"]: (r["z_x"], r["is_new_key"]) for r in zscore(scored, st, ["k"], ["x"]).collect()}
    assert got["new"] == (0.0, True)
    assert got["a"] == (0.0, False)       # (2 - 2) / std


def test_stream_drops_duplicates_within_watermark(spark, tmp_path):
    import pandas as pd
    from tracewise.streaming import jobs
    t0 = dt.datetime(2024, 1, 1)
    pdf = pd.DataFrame({"event_id": [1, 2, 2, 3], "ts": [t0, t0 + dt.timedelta(minutes=1),
                                                         t0 + dt.timedelta(minutes=1), t0 + dt.timedelta(minutes=2)],
                        "user_id": [0, 0, 0, 0], "event_type": ["view"] * 4, "value": [1.0, 2.0, 2.0, 3.0],
                        "props": ['{"k": 1}'] * 4})
    pdf["ts"] = pdf["ts"].astype("datetime64[us]")
    spark.createDataFrame(pdf, jobs.EVENTS_SCHEMA).coalesce(1).write.parquet(str(tmp_path / "events_a.parquet"))
    ev = jobs.read_events(spark, str(tmp_path / "events_a.parquet"), pattern="*.parquet")
    out = jobs.run_upsert_log(jobs.bucket_means(ev), ["ip_port", "server_name", "w"], "dedup").collect()
    assert len(out) == 1 and out[0]["connection_count"] == 3.0


def test_min_rows_guard(spark):
    from tracewise.operators.detect import min_rows
    rows = [("a", i) for i in range(5)] + [("b", i) for i in range(4)]
    df = spark.createDataFrame(rows, "k string, i int")
    assert sorted({r["k"] for r in min_rows(df, ["k"], 5).collect()}) == ["a"]
    counted = min_rows(df, ["k"], 4, count_col="n").collect()
    assert {(r["k"], r["n"]) for r in counted} == {("a", 5), ("b", 4)}
