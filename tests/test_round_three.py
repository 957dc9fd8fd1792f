"""Streams with state, series that never meet, lagged products, several ranks,
grouped forests, cycles, folded baselines and stored generations."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
import test_entry
from pyspark.sql import functions as F

from tracewise.operators import baseline, correlate, forest, granger, oneclass, ranks, sequence
from tracewise.operators.series import previous_row
from tracewise.plans import edge_rca, graph, train

SF = "/root/testdata/sf0.001"
NEW = ["str3_stateful_features", "str4_sliding_rates", "cor2_standby_graph", "cor4_corr_diff", "cor3_linked_lag1_f",
       "det12_reliability_features", "det15_planted_anomalies", "rca6_rule_candidates", "rca6_planted_candidates",
       "gra3_acyclic", "gra3_cycle_detected", "gra3_strong_components", "gra4_cycle_members", "job1_baseline_folded",
       "job2_corr_change", "flt5_planted_services", "rca3_planted_services", "rca7_planted_root_cause",
       "viz4_planted_labels", "viz4_edge_widths"]
test_entry.TABLES.extend(t for t in ("customer", "orders", "lineitem") if t not in test_entry.TABLES)


@pytest.mark.parametrize("name", NEW)
def test_new_oracles(spark, name):
    test_entry.test_oracle_subset(spark, name)


# -- streams ----------------------------------------------------------------------
def _stream(spark, tmp_path, batches, schema, delay="1 day"):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")) \
        .withWatermark("ts", delay)


T0 = dt.datetime(2024, 1, 1)


def test_trailing_features_across_batches_equal_the_batch(spark, tmp_path):
    from tracewise.operators.features import FEATURES, add_features
    from tracewise.streaming import jobs, stateful
    rng = np.random.default_rng(1)
    rows = [(k, T0 + dt.timedelta(hours=int(h)), float(v)) for k in ("a", "b")
            for h, v in zip(np.sort(rng.choice(120, 64, replace=False)), rng.normal(50, 10, 64), strict=True)]
    batches = [[] for _ in range(6)]
    for k, ts, v in rows:
        at = int((ts - T0).total_seconds() // 86400)
        batches[min(5, at + (v % 1 < 0.2))].append((k, ts, v))  # some come one batch late
    batches.append([("end", T0 + dt.timedelta(days=60), 0.0)])
    points = _stream(spark, tmp_path, [b for b in batches if b], "k string, ts timestamp, v double", "2 days")
    hours = points.groupBy("k", F.window("ts", "1 hour").alias("w")).agg(F.avg("v").alias("x")) \
        .select("k", F.window_time("w").alias("ts"), "x")
    got = jobs.run_appended(stateful.trailing_features(hours, ["k"], "x", "10 days"), "t").where("k <> 'end'").toPandas()
    want = add_features(spark.createDataFrame(rows, "k string, ts timestamp, x double"), ["k"], ["x"], naming="plain",
                        log1p=True).toPandas()
    got["ts"] = got["ts"].dt.floor("h")
    got, want = (x.sort_values(["k", "ts"]).reset_index(drop=True) for x in (got, want))
    assert len(got) == len(want) == len(rows)
    for c in ["x", *FEATURES, "conn_log", "hour", "day_of_week"]:
        assert np.allclose(got[c].astype(float), want[c].astype(float)), c


def test_trailing_state_is_bounded_and_blocks_are_closed_by_a_timer(spark, tmp_path):
    from tracewise.streaming import stateful
    p = stateful.TrailingFeatures(["k"], window=10, short=5)

    class State:
        v = None

        def exists(self):
            return self.v is not None

        def get(self):
            return self.v

        def update(self, v):
            self.v = v

    class Handle:
        timers = []

        def getValueState(self, *_):
            return State()

        def listTimers(self):
            return list(self.timers)

        def deleteTimer(self, t):
            self.timers.remove(t)

        def registerTimer(self, t):
            self.timers.append(t)
    p.init(Handle())
    out = []
    for i in range(203):
        out += list(p.handleInputRows(("a",), [{"us": i, "v": float(i)}], None))
    assert len(out) == 200 and len(p.state.v[1]) == 20 and len(p.state.v[4]) == 3 and len(Handle.timers) == 1
    assert len(list(p.handleExpiredTimer(("a",), None, None))) == 3 and p.state.v[4] == []


def test_stateful_features_across_batches(spark, tmp_path):
    # one micro-batch a file: state carries the trailing points
    from tracewise.streaming import jobs, stateful
    vals = [float(v) for v in range(1, 21)]
    batches = [[("a", T0 + dt.timedelta(minutes=i), vals[i]) for i in range(p * 5, p * 5 + 5)] for p in range(4)]
    pts = _stream(spark, tmp_path, [*batches, [("end", T0 + dt.timedelta(days=9), 0.0)]], "k string, ts timestamp, v double",
                  "1 hour").groupBy("k", F.window("ts", "1 minute").alias("w")).agg(F.max("v").alias("x")) \
        .select("k", F.window_time("w").alias("ts"), "x")
    out = jobs.run_appended(stateful.trailing_features(pts, ["k"], "x", "1 day"), "t").where("k = 'a'").orderBy("ts").collect()
    assert len(out) == 20
    # value i has rolling mean of the last 5 = i - 2 from the 5th point on, diff 1 from the 2nd
    assert all(abs(r["rolling_mean"] - (r["x"] - 2)) < 1e-9 for r in out[4:])
    assert all(abs(r["diff"] - 1.0) < 1e-9 for r in out[1:])


def test_sliding_rates_with_late_repeated_and_reset_samples(spark, tmp_path):
    from tracewise.operators.promql import increase_and_rate
    from tracewise.streaming import jobs, stateful
    rows = [("s", T0 + dt.timedelta(hours=h), float((h % 17) * 3 + h // 17)) for h in range(60)]
    batches = [rows[:15], rows[20:30] + rows[10:20], rows[30:45] + rows[25:30], rows[46:] + rows[44:48],
               [("end", T0 + dt.timedelta(days=30), 0.0)]]
    s = _stream(spark, tmp_path, batches, "id string, ts timestamp, value double")
    got = jobs.run_appended(stateful.sliding_rates(s, ["id"], "6 hours", "3 hours"), "t").where("id = 's'").collect()
    sent = sorted({r for b in batches[:-1] for r in b})
    want = increase_and_rate(spark.createDataFrame(sent, "id string, ts timestamp_ntz, value double"), ["id"],
                             "6 hours", "3 hours").collect()
    assert len(got) == len(want) > 15
    assert {(r["ts"], round(r["increase"], 6), round(r["rate"], 9)) for r in got} \
        == {(r["ts"], round(r["increase"], 6), round(r["rate"], 9)) for r in want}


# -- correlation -------------------------------------------------------------------
def _pandas_corr(rows):
    wide = pd.DataFrame(rows, columns=["id", "ts", "x"]).pivot(index="ts", columns="id", values="x").fillna(0)
    return wide.corr()


def test_series_that_never_meet(spark):
    rng = np.random.default_rng(3)
    rows = []
    for t in range(200):
        ts = T0 + dt.timedelta(hours=t)
        rows.append(("active" if t % 2 else "standby", ts, 5.0))
        rows.append(("odd", ts, float(1 + t % 2)))
        if t % 2:
            rows.append(("noisy", ts, float(5 + rng.normal(0, 0.5))))
        if t % 7 == 0:
            rows.append(("rare", ts, 1.0))
        if t < 100:
            rows.append(("first_half", ts, 3.0 + t % 3))
        elif t < 195:
            rows.append(("second_half", ts, 4.0))
    want = _pandas_corr(rows)
    df = spark.createDataFrame(rows, "id string, ts timestamp_ntz, x double")
    got = {(r["a"], r["b"]): r["r"] for r in correlate.corr_matrix(df, "id", "ts", "x", 3600).collect()}
    for a, b in got:
        assert a < b and abs(got[a, b] - want.loc[a, b]) < 1e-9
    over = {(a, b) for a in want for b in want if a < b and abs(want.loc[a, b]) > 0.7}
    assert over <= set(got) and {("active", "standby"), ("first_half", "second_half"), ("noisy", "standby")} <= over
    assert abs(got["active", "standby"] + 1) < 1e-12
    edges = {(r["a"], r["b"]) for r in correlate.corr_graph(correlate.corr_matrix(df, "id", "ts", "x", 3600), 0.7).collect()}
    assert ("active", "standby") in edges and ("standby", "active") in edges


def test_corr_change_of_series_that_do_not_meet_on_one_side(spark):
    def side(period):
        rows = [(n, T0 + dt.timedelta(hours=t), float(2 + t % 3)) for t in range(60)
                for n, on in (("a", t % 3 == 0), ("b", t % period == 1), ("c", True)) if on]
        st = correlate.corr_state(spark.createDataFrame(rows, "id string, ts timestamp_ntz, x double"), "id", "ts", "x", 3600)
        return _pandas_corr(rows), st
    (wp, (pp, ps)), (wn, (nn, ns)) = side(2), side(6)
    got = {(r["a"], r["b"]): (r["r_problem"], r["r_normal"], r["diff"]) for r in correlate.corr_diff(pp, nn, ps, ns).collect()}
    assert ("a", "b") in got
    for (a, b), (x, y, d) in got.items():
        assert abs(x - wp.loc[a, b]) < 1e-9 and abs(y - wn.loc[a, b]) < 1e-9 and abs(d - (x - y)) < 1e-12


def _ols_f(a, b, L):
    t = np.arange(L, len(a))
    past_a = np.column_stack([a[t - i] for i in range(1, L + 1)])
    past_b = np.column_stack([b[t - i] for i in range(1, L + 1)])
    def ssr(X):
        return float(((a[t] - X @ np.linalg.lstsq(X, a[t], rcond=None)[0]) ** 2).sum())
    one = np.ones((len(t), 1))
    full, part = ssr(np.hstack([one, past_a, past_b])), ssr(np.hstack([one, past_a]))
    return ((part - full) / L) / (full / (len(t) - 2 * L - 1))


def test_granger_from_lagged_products_equals_least_squares(spark):
    rng = np.random.default_rng(9)
    n = 1500  # more than one chunk of steps
    b = rng.normal(size=n).cumsum() * 0.1 + 1e6
    a = np.concatenate([rng.normal(size=2), 0.4 * b[:-2] + 0.3 * rng.normal(size=n - 2)])
    c = rng.normal(size=n)
    series = {"a": a, "b": b, "c": c, "flat": np.full(n, 2.0)}
    df = spark.createDataFrame([(k, t, float(v)) for k, x in series.items() for t, v in enumerate(x)],
                               "id string, step long, x double")
    pairs = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "c"), ("a", "flat"), ("a", "b")], "a string, b string")
    got = {(r["a"], r["b"], r["lag"]): r for r in granger.granger_tests(df, pairs).collect()}
    assert len(got) == 15  # a series without variance has no test
    for (x, y, L), r in got.items():
        f = _ols_f(series[x] - series[x].mean(), series[y] - series[y].mean(), L)
        assert abs(r["f"] - f) < 1e-5 * max(1, abs(f)), (x, y, L)
        assert abs(r["p"] - granger.f_sf(f, L, n - 3 * L - 1)) < 1e-5
    causes = {(r["a"], r["b"]): r["causes"] for r in granger.granger(df, pairs).collect()}
    assert causes["a", "b"] and not causes["a", "flat"] and len(causes) == 4
    short = granger.granger(df.where("step < 12"), pairs).collect()
    assert len(short) == 4 and not any(r["causes"] for r in short)


# -- ranks and models --------------------------------------------------------------
def test_several_ranks_are_narrowed_together(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 1, 30_000), np.full(5000, 0.25), [1e12, -1e12, np.nan]])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double").repartition(3)
    good = x[~np.isnan(x)]
    qs = [0.0, 0.01, 0.5, 0.503, 0.99, 1.0]
    assert np.allclose(ranks.exact_quantiles(df, "x", qs), np.quantile(good, qs))
    calls = []
    narrow = ranks._narrow
    monkeypatch.setattr(ranks, "_narrow", lambda *a: calls.append(1) or narrow(*a))
    flat = spark.range(100_000).select(F.col("id").cast("double").alias("x"))
    assert ranks.exact_quantile(flat, "x", 0.333) == pytest.approx(0.333 * 99_999)
    assert len(calls) == 1  # range, one histogram, one fetch
    assert ranks.exact_quantile(df.where("x IS NULL"), "x", 0.5) is None
    assert ranks.exact_quantile(spark.range(9000).select(F.lit(3.5).alias("x")), "x", 0.7) == 3.5


def test_one_class_rounds_equal_a_direct_fit(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(3000, 4))
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double, c double, d double").repartition(5)
    nu, rounds = 0.05, 6
    model = oneclass.fit(df, ["a", "b", "c", "d"], nu=nu, D=64, rounds=rounds, seed=1)
    P = model.phi(X)
    w, rho = np.zeros(64), 1.0
    for t in range(1, rounds + 1):
        w = w - (w - P[P @ w < rho].sum(axis=0) / (nu * len(X))) / t
        rho = np.quantile(P @ w, nu)
    assert np.allclose(model.w, w) and abs(model.rho - rho) < 1e-9


def test_forests_of_several_groups_in_one_fit(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "u", [float(v) for v in rng.normal(size=2)]) for i in range(600)]
    rows += [(i, "v", [float(v) for v in rng.normal(50, 5, size=3)]) for i in range(40)]
    df = spark.createDataFrame(rows, "i long, g string, x array<double>")
    nodes = forest.fit_groups(df, "g", ["i"], "x", n_trees=20, seed=3)
    again = forest.fit_groups(df.repartition(7), "g", ["i"], "x", n_trees=20, seed=3)
    key = ["grp", "tree", "node"]
    a, b = (n.toPandas().sort_values(key).reset_index(drop=True) for n in (nodes, again))
    pd.testing.assert_frame_equal(a[sorted(a)], b[sorted(b)])
    assert {r["grp"]: r["n_samples"] for r in nodes.select("grp", "n_samples").distinct().collect()} == {"u": 256, "v": 40}
    probe = spark.createDataFrame([("u", [0.0, 0.0]), ("u", [9.0, 9.0]), ("v", [50.0, 50.0, 50.0]), ("v", [0.0, 0.0, 0.0]),
                                   ("w", [1.0])], "g string, x array<double>")
    s = [r["anomaly_score"] for r in forest.score_groups(probe, "g", nodes, "x").collect()]
    assert s[1] > 0.6 > s[0] and s[3] > s[2] and s[4] is None


def test_components_of_all_groups_come_from_one_aggregate(spark):
    rng = np.random.default_rng(6)
    data = {g: rng.normal(size=(200, 3)) @ rng.normal(size=(3, 6)) + k for k, g in enumerate("xy")}
    df = spark.createDataFrame([(g, [float(v) for v in r]) for g, X in data.items() for r in X], "g string, flat array<double>")
    got = sequence.components(df, "g", 2)
    for g, X in data.items():
        mu, P = got[g]
        assert np.allclose(mu, X.mean(axis=0))
        _, _, vt = np.linalg.svd(X - X.mean(axis=0), full_matrices=False)
        assert np.allclose(P @ P.T, vt[:2].T @ vt[:2], atol=1e-8)


# -- reliability -------------------------------------------------------------------
def _mesh(spark, burst):
    rng = np.random.default_rng(8)
    rows = []
    for h in range(24 * 10):
        ts = T0 + dt.timedelta(hours=h)
        for src, dst in (("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "z"), ("p", "q"), ("q", "r"), ("s", "t")):
            on = burst and h >= 24 * 10 - 20 and (src, dst) in (("a", "b"), ("b", "c"))
            n500 = 30 + 3 * (h % 5) if on else int(rng.integers(1, 4))
            n = [100.0 - n500, float(n500)]
            rows.append((src, dst, ts, *n, 10.0, 40.0, 60.0, 90.0, 100.0, 100.0, 3000.0))
    cols = "src string, dst string, ts timestamp_ntz, n200 double, n500 double, " \
        + ", ".join(f"c{i} double" for i in range(6)) + ", rt_sum double"
    return spark.createDataFrame(rows, cols)


@pytest.mark.parametrize("judge", ["rule", "forest"])
def test_an_error_burst_is_a_reliability_anomaly(spark, judge):
    def found(burst):
        w = edge_rca.prepared_windows(_mesh(spark, burst))
        a = edge_rca.edge_anomalies(w, reliability=judge)
        return w, a, {(r["src"], r["dst"]) for r in a.where("kind = 'reliability'").collect()}
    w, a, hit = found(True)
    burst = {("a", "b"), ("b", "c")}
    chains = edge_rca.root_cause_chains(a, w, spark.createDataFrame([("a",)], "entry string")).where("type = 'reliability'")
    assert [(r["chain"], r["length"]) for r in chains.collect()] == [("a -> b -> c", 3)]
    quiet = found(False)[2]
    if judge == "rule":
        assert hit == burst and quiet == set()
    else:  # a forest's offset lets single quiet windows through
        top = edge_rca.reliability_scores(w).orderBy(F.desc("anomaly_score")).limit(2).collect()
        assert {(r["src"], r["dst"]) for r in top} == burst <= hit and len(hit) <= 3 and len(quiet) <= 2


# -- lag, graphs --------------------------------------------------------------------
def test_lag_over_a_key_that_holds_everything(spark):
    n = 4000
    rows = [(i, 7, T0 + dt.timedelta(seconds=i // 900), f"e{i % 5}") for i in range(n)]  # a few instants
    rows += [(n + i, 8 + i % 50, T0 + dt.timedelta(seconds=i), "x") for i in range(200)] + [(9000 + i, None, T0, "n") for i in range(3)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string").repartition(5)
    want = {}
    for u in {r[1] for r in rows}:
        prev = None
        for r in sorted((r for r in rows if r[1] == u), key=lambda r: (r[2], r[0])):
            want[r[0]], prev = prev, r[3]
    for share in (1.0, 0.01, 2.0 ** -14):
        out = previous_row(df, ["user_id"], ["ts", "event_id"], cols=["event_type"], heavy_share=share)
        assert {r["event_id"]: r["prev_event_type"] for r in out.collect()} == want
    merge = "spark.sql.adaptive.coalescePartitions.enabled"  # few rows would else be read by one task
    before = spark.conf.get(merge)
    try:
        spark.conf.set(merge, "false")
        tasks = previous_row(df, ["user_id"], ["ts", "event_id"], cols=["event_type"], heavy_share=0.5).where("user_id = 7") \
            .groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(merge, before)
    assert len(tasks) > 2 and max(r["count"] for r in tasks) < 0.7 * n


@pytest.mark.parametrize("seed,m", [(1, 25), (2, 45), (3, 70)])
def test_strong_components_equal_brute_force(spark, seed, m):
    rng = np.random.default_rng(seed)
    e = sorted({(f"v{a:02d}", f"v{b:02d}") for a, b in rng.integers(0, 30, (m, 2))})
    v = sorted({x for p in e for x in p})
    reach = {x: {x} for x in v}
    for _ in v:
        for a, b in e:
            reach[a] |= reach[b]
    comp = {x: min(y for y in v if y in reach[x] and x in reach[y]) for x in v}
    df = spark.createDataFrame(e, "src string, dst string")
    got = {r["id"]: (r["component"], r["size"]) for r in graph.strong_components(df).collect()}
    assert got == {x: (comp[x], sum(c == comp[x] for c in comp.values())) for x in v}
    loops = {a for a, b in e if a == b}
    on = {(r["component"], r["id"]) for r in graph.cycle_members(df).collect()}
    assert on == {(comp[x], x) for x in v if got[x][1] > 1 or x in loops}
    assert graph.is_acyclic(df) == (not on)


# -- stored state -------------------------------------------------------------------
def test_folded_days_equal_all_points(spark):
    rng = np.random.default_rng(7)
    rows = [("k1" if i % 3 else "k2", f"d{i % 6}", float(rng.gamma(2.0) + 1e4)) for i in range(900)]
    rows += [("one", "d0", 5.0), ("flat", "d0", 2.0), ("flat", "d1", 2.0), ("none", "d0", None)]
    df = spark.createDataFrame(rows, "k string, day string, x double")
    state = baseline.period_state(df, ["k"], ["x"], "day")
    got = {r["k"]: r for r in baseline.statistics(baseline.merged(state, ["k"]), ["k"]).collect()}
    assert set(got) == {"k1", "k2", "one", "flat"}
    for k in ("k1", "k2"):
        x = np.array([r[2] for r in rows if r[0] == k])
        d = x - x.mean()
        assert abs(got[k]["mean"] - x.mean()) < 1e-6 and abs(got[k]["std"] - x.std(ddof=1)) < 1e-8
        assert abs(got[k]["skew"] - (d ** 3).mean() / x.std() ** 3) < 1e-6
        assert abs(got[k]["kurt"] - ((d ** 4).mean() / x.std() ** 4 - 3)) < 1e-6
        q = baseline.quantiles(state.where(F.col("k") == k), ["k"], [0.25, 0.5, 0.9]).first()
        rank = [(x < q[f"q{p}"]).mean() for p in (25, 50, 90)]
        assert np.allclose(rank, [0.25, 0.5, 0.9], atol=0.03)
    assert got["one"]["std"] is None and got["flat"]["std"] == 1e-6 and got["flat"]["skew"] is None
    wide = baseline.wide_statistics(baseline.merged(state, ["k"]), ["k"], ["x"])
    assert set(wide.columns) == {"k", "x_mean", "x_std"}


def test_a_predict_reads_one_whole_generation(spark):
    root = train.train(spark, SF, ["feature_stats", "forest_nodes", "offset"])
    first = train.newest(spark, root)
    # a second train dies before its manifest row: nothing changes for readers
    spark.range(1).write.parquet(f"{root}/generation-dead/offset")
    assert train.newest(spark, root) == first
    before = train.predict(spark, SF, root).count()
    train.train(spark, SF, ["feature_stats", "forest_nodes", "offset"], root)
    second = train.newest(spark, root)
    assert second != first and train.predict(spark, SF, root, first).count() == before
    assert train.newest(spark, train.new_root(spark)) is None


def test_a_cycle_from_stored_state_equals_the_direct_one(spark):
    import __spark_entry__ as entry
    out = train.cycle(spark, SF, train.train(spark, SF))
    q = entry.queries()

    def rows(df):
        return sorted((tuple(str(round(v, 6) if isinstance(v, float) else v) for v in (r[c] for c in sorted(df.columns)))
                       for r in df.collect()))
    assert rows(out["worst"]) == rows(q["rca3_worst_services"](spark, SF)) or [
        r["service_id"] for r in out["worst"].collect()] == [r["service_id"] for r in q["rca3_worst_services"](spark, SF).collect()]
    assert rows(out["bars"]) and out["scatter"].count() == out["scores"].count() > 0
    assert out["flags"].where("sigma3 IS NULL").count() == 0 and out["corr_change"].count() > 0
