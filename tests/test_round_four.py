"""Error shares over steps without a 5xx point."""

import datetime as dt

import numpy as np

from tracewise.plans import edge_rca

T0 = dt.datetime(2024, 1, 1)


def test_error_and_latency_correlate_over_all_steps(spark):
    # a -> b fails in every third step only, b -> c in every step, c -> d never
    rows, want = [], {}
    for src, dst, every in (("a", "b", 3), ("b", "c", 1), ("c", "d", 0)):
        rt = [40.0 + (k * 7) % 11 for k in range(16)]
        share = [0.1 + 0.02 * (k % 5) if every and k % every == 0 else 0.0 for k in range(16)]
        rows += [(T0 + dt.timedelta(hours=3 * k), src, dst, rt[k], share[k], 1.0, share[k] > 0) for k in range(16)]
        if every:
            want[src, dst] = (float(np.corrcoef(share, rt)[0, 1]), max(share))
    series = spark.createDataFrame(rows, "ts timestamp_ntz, src string, dst string, rt double, error double, qps double, "
                                         "has_error boolean")
    got = {(r["src"], r["dst"]): (r["corr_rt_error"], r["max_error"])
           for r in edge_rca.reliability_features(edge_rca.windows(series)).collect()}
    assert got.keys() == want.keys()
    for edge, values in want.items():
        assert np.allclose(got[edge], values) and abs(values[0]) > 0.01
