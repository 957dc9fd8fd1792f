"""Planted-fault and numeric tests (the reference's own checks are seeded
simulations with planted faults; these rebuild them as tiny fixtures)."""

import datetime as dt
import math

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tracewise.operators import correlate, forest, granger, promql
from tracewise.operators.series import previous_row
from tracewise.plans import graph, service


def _ts(i, step_s=30):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=step_s * i)


def test_counter_reset_increase(spark):
    # 5, 8, 2, 4 -> increases 3 + 2 + 2 = 7 (reset at 2)
    rows = [("s", _ts(i, 60), float(v)) for i, v in enumerate([5, 8, 2, 4])]
    c = spark.createDataFrame(rows, "sid string, ts timestamp_ntz, value double")
    inc = promql.total_increase(c, ["sid"], ["sid"]).collect()[0]["increase"]
    assert inc == 7.0


def test_histogram_quantile(spark):
    # Buckets 10:4, 20:8, +Inf:10 -> q0.5 = 12.5, q0.95 = 20
    t = _ts(0)
    rows = [(t, "a", 10.0, 4.0), (t, "a", 20.0, 8.0), (t, "a", float("inf"), 10.0)]
    b = spark.createDataFrame(rows, "ts timestamp_ntz, e string, le double, rate double")
    q50 = promql.histogram_quantile(b, 0.5, ["e"]).collect()[0]["quantile"]
    q95 = promql.histogram_quantile(b, 0.95, ["e"]).collect()[0]["quantile"]
    q10 = promql.histogram_quantile(b, 0.1, ["e"]).collect()[0]["quantile"]
    assert math.isclose(q50, 12.5)
    assert q95 == 20.0
    assert math.isclose(q10, 2.5)


def test_rate_window_semantics(spark):
    # samples every hour, counter +1 per hour; rate over 6h windows = 1/3600
    rows = [("s", _ts(i, 3600), float(i)) for i in range(1, 25)]
    c = spark.createDataFrame(rows, "sid string, ts timestamp_ntz, value double")
    r = promql.increase_and_rate(c, ["sid"], "6 hours", "3 hours").collect()
    assert r and all(math.isclose(x["rate"], 1 / 3600) for x in r)


def test_f_tail_numerics():
    # printed 5% critical values of the F distribution
    assert abs(granger.f_sf(4.96, 1, 10) - 0.05) < 1e-3
    assert abs(granger.f_sf(2.53, 5, 30) - 0.05) < 1e-3
    assert abs(granger.f_sf(3.10, 3, 20) - 0.05) < 2e-3
    assert granger.f_sf(0.0, 2, 10) == 1.0


def test_granger_direction(spark):
    # B leads a by one step -> b causes a, not the reverse
    rng = np.random.default_rng(7)
    n = 200
    b = rng.normal(size=n)
    a = np.zeros(n)
    for t in range(1, n):
        a[t] = 0.8 * b[t - 1] + 0.1 * rng.normal()
    rows = [("a", t, float(a[t])) for t in range(n)] + [("b", t, float(b[t])) for t in range(n)]
    s = spark.createDataFrame(rows, "id string, step long, x double")
    pairs = spark.createDataFrame([("a", "b"), ("b", "a")], "a string, b string")
    res = {(r["a"], r["b"]): r["causes"] for r in granger.granger(s, pairs).collect()}
    assert res[("a", "b")] is True
    assert res[("b", "a")] is False


def test_granger_too_short_is_false(spark):
    rows = [("a", t, float(t % 3)) for t in range(10)] + [("b", t, float(t % 2)) for t in range(10)]
    s = spark.createDataFrame(rows, "id string, step long, x double")
    pairs = spark.createDataFrame([("a", "b")], "a string, b string")
    assert granger.granger(s, pairs).collect()[0]["causes"] is False


def test_lagged_corr_edges(spark):
    # B = 0.5 * C lagged 1, A = 0.4 * B lagged 1; D, E independent
    rng = np.random.default_rng(3)
    n = 100
    c = rng.normal(size=n)
    b = np.r_[0, 0.5 * c[:-1]] + 0.05 * rng.normal(size=n)
    a = np.r_[0, 0.4 * b[:-1]] + 0.05 * rng.normal(size=n)
    d, e = rng.normal(size=n), rng.normal(size=n)
    rows = []
    for name, v in zip("ABCDE", [a, b, c, d, e]):
        rows += [(name, _ts(i), float(v[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, ts timestamp_ntz, x double")
    edges = correlate.lagged_corr_edges(df, "id", "ts", "x", 30, lag_max=5, threshold=0.5).collect()
    got = {(r["caller"], r["callee"]): r["lag"] for r in edges}
    assert got.get(("A", "B")) == 1
    assert got.get(("B", "C")) == 1
    assert not any("D" in k or "E" in k for k in got)


def test_corr_matrix_matches_pandas_zero_fill(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(40):
        for s in "abc":
            if not (s == "c" and i % 4 == 0):          # c has gaps -> zero-filled
                rows.append((s, _ts(i), float(rng.normal() + (i if s != "b" else -i))))
    df = spark.createDataFrame(rows, "id string, ts timestamp_ntz, x double")
    got = {(r["a"], r["b"]): r["r"] for r in correlate.corr_matrix(df, "id", "ts", "x", 30).collect()}
    p = pd.DataFrame(rows, columns=["id", "ts", "x"]).pivot(index="ts", columns="id", values="x").fillna(0).corr()
    for (a, b), r in got.items():
        assert abs(r - p.loc[a, b]) < 1e-9


def test_pagerank_small_graph(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("d", "c")]
    e = spark.createDataFrame(edges, "src string, dst string")
    got = {r["id"]: r["pagerank"] for r in graph.pagerank(e, tol=1e-10).collect()}
    nodes = sorted({x for ed in edges for x in ed})
    n, idx = len(nodes), {v: i for i, v in enumerate(nodes)}
    outdeg = {v: sum(1 for s, _ in edges if s == v) for v in nodes}
    x = np.full(n, 1 / n)
    for _ in range(200):
        nx_ = np.zeros(n)
        for s, d in edges:
            nx_[idx[d]] += 0.85 * x[idx[s]] / outdeg[s]
        dangling = sum(x[idx[v]] for v in nodes if outdeg[v] == 0)
        x = nx_ + (0.85 * dangling + 0.15) / n
    for v in nodes:
        assert abs(got[v] - x[idx[v]]) < 1e-6


def test_dag_longest_path_and_cycle(spark):
    e = spark.createDataFrame([("r", "n1"), ("r", "n2"), ("n1", "s1"), ("s1", "t")], "src string, dst string")
    assert graph.is_acyclic(e)
    path = [r["id"] for r in graph.longest_path(e).orderBy("pos").collect()]
    assert path == ["r", "n1", "s1", "t"]
    cyc = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    assert not graph.is_acyclic(cyc)


def test_downstream_root_cause(spark):
    # C is the anomalous leaf, B (calls C) is a symptom
    e = spark.createDataFrame([("A", "B"), ("B", "C"), ("A", "D")], "src string, dst string")
    anom = spark.createDataFrame([("B",), ("C",)], "id string")
    assert graph.downstream_root_cause(anom, e).collect()[0]["root_cause"] == "C"
    none = spark.createDataFrame([], "id string")
    assert graph.downstream_root_cause(none, e).collect()[0]["root_cause"] == "Not Found"


def test_previous_row_equals_plain_lag(spark):
    rng = np.random.default_rng(5)
    rows = [(int(u), _ts(int(t), 600), int(i), f"t{int(k)}")
            for i, (u, t, k) in enumerate(zip(rng.integers(0, 3, 400), rng.integers(0, 2000, 400),
                                              rng.integers(0, 4, 400)))]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_id long, event_type string")
    got = previous_row(df, ["user_id"], ["ts", "event_id"], F.date_trunc("day", "ts"), ["event_type"])
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ref = df.withColumn("ref", F.lag("event_type").over(w))
    j = got.join(ref, ["user_id", "ts", "event_id"])
    bad = j.filter(~F.col("prev_event_type").eqNullSafe(F.col("ref"))).count()
    assert bad == 0


def test_forest_flags_planted_outlier_and_is_deterministic(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(600, 3))
    X[0] = [8, 8, 8]
    pdf = pd.DataFrame(X, columns=["f0", "f1", "f2"])
    pdf["k"] = np.arange(len(pdf)).astype(str)
    df = spark.createDataFrame(pdf)
    nodes = forest.fit(df, ["k"], ["f0", "f1", "f2"], n_trees=50, seed=42)
    s1 = forest.score(df, nodes, ["f0", "f1", "f2"]).orderBy(F.col("anomaly_score").desc()).first()
    assert s1["k"] == "0" and s1["anomaly_score"] > 0.7
    nodes2 = forest.fit(df.repartition(7), ["k"], ["f0", "f1", "f2"], n_trees=50, seed=42)
    a = sorted(tuple(r) for r in nodes.collect())
    b = sorted(tuple(r) for r in nodes2.collect())
    assert a == b


def test_c_factor():
    assert forest.c_factor(np.array([2.0]))[0] == 1.0
    assert abs(forest.c_factor(np.array([256.0]))[0] - 10.2448) < 1e-3


def test_planted_service_ranks_first(spark):
    # serviceA +200 ms and +5 eps in the problem window
    rng = np.random.default_rng(42)
    rows = []
    for phase, off in (("normal", 0), ("problem", 100)):
        for i in range(100):
            for s in ("serviceA", "serviceB", "serviceC"):
                rt = rng.normal(100, 20) + (200 if (phase == "problem" and s == "serviceA") else 0)
                eps = max(float(rng.normal(1, 0.5)), 0.0) + (5 if (phase == "problem" and s == "serviceA") else 0)
                rows.append(("p", s, _ts(off + i), rt, rng.normal(50, 10), eps))
    df = spark.createDataFrame(rows, "ip_port string, server_name string, ts timestamp_ntz, "
                                     "response_time double, qps double, eps double")
    split = _ts(100)
    base, prob = df.filter(F.col("ts") < F.lit(split)), df.filter(F.col("ts") >= F.lit(split))
    from tracewise.operators.detect import flag_3sigma, flag_rates
    from tracewise.operators.normalize import baseline_stats
    keys, ms = ["ip_port", "server_name"], ["response_time", "qps", "eps"]
    st = baseline_stats(base, keys, ms, floor=None)
    fl = flag_3sigma(service.with_diffs(prob, keys, ms), st, keys, ms)
    r = flag_rates(fl, "server_name", {"sigma3": "rate"}).orderBy(F.col("rate").desc()).first()
    assert r["server_name"] == "serviceA" and r["rate"] > 0.9
