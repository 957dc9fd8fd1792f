"""Numerics, sampling without a pool, exact ranks, streams over several
micro-batches, stored state."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tracewise.operators import correlate, forest
from tracewise.operators.ranks import exact_quantile
from tracewise.plans import graph
from tracewise.streaming import jobs

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)


def _long(spark, series):
    rows = [(k, T0 + timedelta(seconds=30 * i), float(v)) for k, x in series.items() for i, v in enumerate(x)
            if v is not None]
    return spark.createDataFrame(rows, "id string, ts timestamp_ntz, x double")


def test_correlation_of_constants_and_offsets(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(size=84)
    series = {"c1": [0.1] * 84, "c2": [0.7] * 84, "far": 1e9 + a, "far2": 1e9 + 0.6 * a + 0.8 * rng.normal(size=84), "a": a}
    df = _long(spark, series)
    got = {(r["a"], r["b"]): r["r"] for r in correlate.corr_matrix(df, "id", "ts", "x", 30).collect()}
    want = pd.DataFrame(series).corr()
    assert len(got) == 10
    for (x, y), r in got.items():
        if "c" in x[0] or "c" in y[0]:
            assert r is None
        else:
            assert abs(r - want.loc[x, y]) < 1e-5 and abs(r) <= 1
    edges = correlate.lagged_corr_edges(df, "id", "ts", "x", 30, threshold=-1.0).collect()
    assert all(abs(r["r"]) <= 1 and not {"c1", "c2"} & {r["caller"], r["callee"]} for r in edges)
    assert len(edges) == 6


@pytest.mark.parametrize("block,chunk", [(512, 1024), (3, 16)])
def test_blocks_do_not_change_the_matrix(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(correlate, "BLOCK", block)
    monkeypatch.setattr(correlate, "CHUNK", chunk)
    rng = np.random.default_rng(6)
    series = {f"s{k}": [v if rng.random() > 0.2 else None for v in rng.normal(3, 1, 60)] for k in range(11)}
    got = {(r["a"], r["b"]): r["r"] for r in correlate.corr_matrix(_long(spark, series), "id", "ts", "x", 30).collect()}
    want = pd.DataFrame(series).astype(float).fillna(0).corr()
    assert len(got) == 55 and all(a < b for a, b in got)
    assert max(abs(r - want.loc[k]) for k, r in got.items()) < 1e-9


def test_unequal_lengths_are_not_correlated(spark):
    rows = [(T0 + timedelta(minutes=i), "a", "b", float(i)) for i in range(16)]
    rows += [(T0 + timedelta(minutes=i), "b", "c", float(i)) for i in range(3)]
    s = spark.createDataFrame(rows, "ts timestamp_ntz, src string, dst string, v double")
    assert correlate.edge_pair_corr(s, "v").first()["r"] == 0.0


def test_trees_sample_from_all_rows(spark):
    n = 150_000
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 97).cast("double").alias("x"))
    samples = forest.tree_samples(df, ["k"], ["x"], 20, 64, 42, n)
    assert {r["count"] for r in samples.groupBy("tree").count().collect()} == {64}
    # exactly the rows with the smallest hash, wherever they lie
    key = F.xxhash64(F.col("k").cast("string"), F.lit(42))
    order = F.xxhash64(key, F.lit(7), F.lit(42))
    best = sorted(r["x"] for r in df.orderBy(order, key).limit(64).collect())
    assert sorted(r["x"] for r in samples.where("tree = 7").collect()) == best
    tight = forest.tree_samples(df, ["k"], ["x"], 20, 64, 42, n, oversample=0.01)  # the bound has to be widened
    assert sorted(map(tuple, tight.collect())) == sorted(map(tuple, samples.collect()))
    nodes = [sorted(map(tuple, forest.fit(df.repartition(p), ["k"], ["x"], n_trees=5, max_samples=64).collect()))
             for p in (1, 16)]
    assert nodes[0] == nodes[1]


def test_exact_quantile(spark):
    rng = np.random.default_rng(3)
    for x in (rng.normal(size=20_000), np.r_[np.zeros(9000), 1e-300, 1e300], np.ones(7), rng.integers(0, 5, 9000),
              1.0 + np.arange(6000) % 3 * 2.0 ** -52, [4.0]):
        df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "v double")
        for q in (0.0, 0.01, 0.5, 0.99, 1.0):
            assert exact_quantile(df, "v", q) == pytest.approx(np.quantile(np.asarray(x, float), q), rel=1e-12)
    assert exact_quantile(spark.createDataFrame([], "v double"), "v", 0.5) is None


def test_pagerank_raises_when_not_converged(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")], "src string, dst string")
    with pytest.raises(ArithmeticError):
        graph.pagerank(e, max_iter=2, tol=1e-12)


def test_streams_of_several_batches_equal_the_batch(spark):
    folder, width = jobs.stage_events(spark, SF)
    events = jobs.read_events(spark, folder, watermark=f"{width + 86400} seconds", max_files=jobs.STAGE_FILES)
    log = jobs._run_versions(jobs.bucket_means(events), "t-log")
    assert log.select("batch").distinct().count() >= 4
    got = jobs.newest_versions(log, ["ip_port", "server_name", "w"])
    from tracewise.sources.bindings import metric_points
    want = {(r["ip_port"], r["server_name"], r["ts"]): r["connection_count"] for r in metric_points(spark, SF).collect()}
    rows = got.select("ip_port", "server_name", jobs.to_naive("w.start").alias("ts"), "connection_count").collect()
    assert {(r["ip_port"], r["server_name"], r["ts"]): r["connection_count"] for r in rows} == want
    assert len(rows) == len(want)


def test_prediction_from_stored_state_equals_the_fitted_flow(spark):
    from tracewise.plans.queries_models import det7_forest_score
    from tracewise.plans.queries_tables import job2_predict
    a = sorted(map(tuple, job2_predict(spark, SF).collect()))
    b = sorted(map(tuple, det7_forest_score(spark, SF).collect()))
    assert len(a) == len(b) > 0
    for x, y in zip(a, b, strict=True):
        assert x[:3] == y[:3] and x[3] == pytest.approx(y[3], abs=1e-9) and x[5:] == y[5:]


def test_session_keeps_what_is_set(spark):
    from tracewise.session import get_session
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        s = get_session()
        assert s.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert s.conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_one_class_does_not_depend_on_partitioning(spark):
    from tracewise.operators import oneclass
    x = np.random.default_rng(0).normal(size=(1500, 4))
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")))
    flags = []
    for parts in (1, 8, 64):
        m = oneclass.fit(df.repartition(parts), list("abcd"), nu=0.05, rounds=6)
        flags.append(m.decision(x) < -1e-9)
    assert (flags[0] == flags[1]).all() and (flags[0] == flags[2]).all()
    assert 0.03 < flags[0].mean() < 0.07


def test_linked_series_give_edges_and_directions(spark):
    from tracewise.plans.queries_graph import cor2_linked_graph, cor3_linked_directions, cor5_linked_edges
    sf = "/root/testdata/sf0.01"
    edges = {(r["caller"], r["callee"]): r["lag"] for r in cor5_linked_edges(spark, sf).collect()}
    assert all(edges[f"link_{k}", f"link_{j}"] == k - j for k in range(5) for j in range(k))
    assert not any("constant" in e for pair in edges for e in [pair[0], pair[1]])
    assert {("link_0", "shifted"), ("shifted", "link_0")} <= {(r["a"], r["b"]) for r in cor2_linked_graph(spark, sf).collect()}
    causes = {(r["a"], r["b"]): r["causes"] for r in cor3_linked_directions(spark, sf).collect()}
    assert any(causes.values())


def test_extrapolated_rate(spark):
    from tracewise.operators.promql import increase_and_rate
    at = [40, 100, 160, 220, 280]  # seconds; the counter restarts at 220
    v = [30.0, 60.0, 90.0, 5.0, 35.0]
    rows = [("s", T0 + timedelta(seconds=t), x) for t, x in zip(at, v, strict=True)]
    df = spark.createDataFrame(rows, "s string, ts timestamp_ntz, value double")
    got = {r["ts"]: r for r in increase_and_rate(df, ["s"], "300 seconds", "300 seconds", extrapolate=True).collect()}
    r = got[T0 + timedelta(seconds=300)]
    # increase 30 + 30 + 5 + 30 = 95 over 240 s; 40 s to the start and 20 s to the end are both within 66 s
    assert r["increase"] == pytest.approx(95 * 300 / 240) and r["rate"] == pytest.approx(95 / 240)
    plain = increase_and_rate(df, ["s"], "300 seconds", "300 seconds").filter(F.col("ts") == T0 + timedelta(seconds=300)).first()
    assert plain["increase"] == 95 and plain["rate"] == pytest.approx(95 / 240)
