"""Operators on streams against pandas and numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoweave.operators import asof, events, grid, islands, lag, repair, roles, smooth, stats, timebase


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_asof_matches_pandas_with_ties(spark):
    rng = np.random.RandomState(0)
    left = pd.DataFrame({"k": rng.randint(0, 3, 200), "t": np.sort(rng.randint(0, 400, 200))})
    right = pd.DataFrame({"k": rng.randint(0, 3, 120), "t": np.sort(rng.randint(0, 400, 120))}).drop_duplicates(["k", "t"])
    right["v"] = np.arange(len(right), dtype=float)
    left["row"] = np.arange(len(left))
    for direction in ("backward", "forward", "nearest"):
        want = pd.merge_asof(left, right, on="t", by="k", direction=direction, tolerance=20).sort_values("row")["v"]
        got = asof.asof_join(spark.createDataFrame(left), spark.createDataFrame(right), ["k"], "t", "t", ["v"], direction, tolerance=20).toPandas().sort_values("row")["v"]
        assert np.allclose(want.to_numpy(float), got.to_numpy(float), equal_nan=True), direction


def test_asof_later_tie_and_plan(spark):
    left, right = frame(spark, [(1, 10)], "k int, t int"), frame(spark, [(1, 8, 1.0), (1, 12, 2.0)], "k int, t int, v double")
    assert asof.asof_join(left, right, ["k"], "t", "t", ["v"], tie="later").first()["v"] == 2.0
    assert asof.asof_join(left, right, ["k"], "t", "t", ["v"], tie="earlier").first()["v"] == 1.0
    plan = asof.asof_join(left, right, ["k"], "t", "t", ["v"])._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("outside,edge", [("clamp", 1.0), ("zero", 0.0), ("null", None)])
def test_interpolation_edges(spark, outside, edge):
    s = frame(spark, [("a", 0, 1.0), ("a", 10, 3.0)], "k string, t int, value double")
    p = frame(spark, [("a", -5), ("a", 5), ("a", 10)], "k string, t int")
    got = [r["value"] for r in grid.interpolate(s, p, ["k"], outside=outside).orderBy("t").collect()]
    assert got == [edge, 2.0, 3.0]


def test_gaps_segments_and_runs(spark):
    t = [0, 16, 32, 332, 348, 1000]
    df = frame(spark, [("s", x, i, float(i % 3)) for i, x in enumerate(t)], "k string, t int, i int, v double")
    assert islands.gaps(df, ["k"], "t", 60).count() == 2
    assert islands.gaps(df, ["k"], "t", 700).count() == 0
    best = islands.best_segment(islands.segments(df, ["k"], ["i"], "t", 60), ["k"]).first()
    assert (best["start"], best["end"]) == (0, 32)
    runs = islands.flag_runs(df, ["k"], "t", F.col("v") > 0).orderBy("start").collect()
    assert [(r["start"], r["end"]) for r in runs] == [(16, 32), (348, 1000)]


def test_static_gap_fill_and_extension(spark):
    df = frame(spark, [("s", float(t), 5.0) for t in (0, 17, 34, 51, 251, 268)], "k string, t double, v double")
    out = islands.static_gap_fill(df, ["k"], "t", "v", nominal=17.0)
    made = out.where("synthetic").orderBy("t").collect()
    assert len(made) == 11 and all(51 < r["t"] < 251 and r["v"] == 5.0 for r in made)
    ext = islands.extend_backward(df, ["k"], "t", "v", frame(spark, [("s", -40.0)], "k string, z double"), "z", 17.0, 200.0)
    assert sorted(r["t"] for r in ext.where("synthetic").collect()) == [-40.0, -23.0, -6.0]


def test_gaussian_matches_mirrored_convolution(spark):
    x = np.random.RandomState(1).randn(40)
    df = spark.createDataFrame(pd.DataFrame({"k": "s", "i": range(40), "x": x}))
    got = smooth.gaussian(df, ["k"], "i", "x", 2.0, "y").orderBy("i").toPandas()["y"].to_numpy()
    r = 8
    w = np.exp(-0.5 * (np.arange(-r, r + 1) / 2.0) ** 2)
    want = np.convolve(np.pad(x, r, mode="symmetric"), w / w.sum(), "valid")
    assert np.allclose(got, want)


def test_short_gaussian_mirrors_more_than_once(spark):
    df = spark.createDataFrame(pd.DataFrame({"k": "s", "i": range(3), "x": [1.0, 2.0, 4.0]}))
    got = smooth.gaussian(df, ["k"], "i", "x", 2.0, "y").orderBy("i").toPandas()["y"].to_numpy()
    w = np.exp(-0.5 * (np.arange(-8, 9) / 2.0) ** 2)
    assert np.allclose(got, np.convolve(np.pad([1.0, 2.0, 4.0], 8, mode="symmetric"), w / w.sum(), "valid"))


def test_quaternion_repair(spark):
    half = float(np.sqrt(0.5))
    rows = [("s", 0, [1.0, 0.0, 0.0, 0.0]), ("s", 1, [0.0, 0.0, 0.0, 0.0]), ("s", 2, [-half, 0.0, 0.0, -half]), ("s", 3, [float("nan")] * 4)]
    out = repair.repair_quaternions(frame(spark, rows, "k string, i int, q array<double>"), ["k"], "i", "q").orderBy("i").collect()
    middle = np.array(out[1]["q"])
    assert np.isclose(np.linalg.norm(middle), 1) and np.allclose(middle, [np.cos(np.pi / 8), 0, 0, np.sin(np.pi / 8)])
    assert [r["repaired"] for r in out] == [False, True, False, True] and out[3]["q"] == out[2]["q"]


def test_offset_is_found_and_shift_is_added(spark):
    t = np.arange(0, 6000, 20.0)
    signal = np.sin(t / 170) + 0.5 * np.sin(t / 61 + 1)
    a = spark.createDataFrame(pd.DataFrame({"k": "s", "t": t, "value": signal}))
    b = timebase.shift(a, frame(spark, [("s", 100.0)], "k string, shift_ms double"), ["k"], "t")
    best = lag.coarse_to_fine(a, b, ["k"], 20.0, 300.0, 60.0, 10.0).first()
    assert abs(best["lag"] + 100) <= 10 and best["score"] > 0.99


def test_drift_recovered(spark):
    x = np.arange(0, 100000, 500.0)
    df = spark.createDataFrame(pd.DataFrame({"k": "s", "x": x, "y": 3 + x * 150e-6}))
    fit = stats.clock_fit(df, ["k"], "x", "y").first()
    assert abs(fit["drift_ppm"] - 150) < 1e-6 and fit["n"] == 200


def test_hysteresis_peaks_and_matching(spark):
    x = [0, 9, 9, 5, 1, 9, 0]
    df = frame(spark, [("s", float(i), float(v)) for i, v in enumerate(x)], "k string, t double, v double")
    got = events.hysteresis_events(df, ["k"], "t", "v", 8, 2, 0.0).orderBy("t").collect()
    assert [(r["t"], r["kind"]) for r in got] == [(1, "rise"), (4, "fall"), (5, "rise"), (6, "fall")]
    assert events.peak_positions(np.array([0, 2, 2, 0, 5, 0, 4, 0]), distance=3).tolist() == [1, 4]
    pairs = frame(spark, [("s", 1.0, 1.2), ("s", 1.1, 1.2), ("s", 1.1, 1.9)], "k string, a double, b double")
    assert sorted((r["a"], r["b"]) for r in events.greedy_match(pairs, ["k"], "a", "b").collect()) == [(1.0, 1.2), (1.1, 1.9)]


def test_savgol_keeps_parabolas(spark):
    t = np.arange(15.0)
    df = spark.createDataFrame(pd.DataFrame({"k": "s", "t": t, "v": 1 + t - 0.3 * t * t}))
    got = events.savgol(df, ["k"], "t", "v", 7, 2).orderBy("t").toPandas()["smooth"].to_numpy()
    assert np.allclose(got, 1 + t - 0.3 * t * t)


def test_degenerate_alignment(spark):
    df = spark.createDataFrame(pd.DataFrame({"k": "s", "i": range(30), "x": 1.0, "y": 2.0}))
    assert tuple(events.alignment_report(df, ["k"], "i", "x", "y", 20, 400).first())[2:4] == (0.0, 999.0)


def test_camera_permutation(spark):
    names = ("head", "left", "right")
    for perm in ((0, 1, 2), (1, 2, 0), (2, 1, 0)):
        rows = [("s", names[c], names[n], 0.9 if perm[c] == n else 0.1) for c in range(3) for n in range(3)]
        got = roles.best_permutation(frame(spark, rows, "session string, camera string, sensor string, r double"), "session", names).first()
        assert got["assignment"] == {names[c]: names[perm[c]] for c in range(3)} and got["confidence"] == "high"


def test_leave_one_out_equals_direct(spark):
    rng = np.random.RandomState(2)
    votes = pd.DataFrame([(s, q, int(rng.randint(0, 2))) for s in range(12) for q in range(4)], columns=["session", "rule_id", "right_block"])
    truth = pd.DataFrame({"session": range(12), "true_right": rng.randint(0, 2, 12)})
    got = {r["session"]: (r["rule_id"], r["correct"]) for r in roles.leave_one_out(spark.createDataFrame(votes), spark.createDataFrame(truth), "session").collect()}
    m = votes.merge(truth)
    m["ok"] = (m.right_block == m.true_right).astype(int)
    for s in range(12):
        rest = m[m.session != s].groupby("rule_id").ok.sum()
        best = rest.index[rest.to_numpy().argmax()]
        assert got[s] == (best, bool(m[(m.session == s) & (m.rule_id == best)].ok.iloc[0]))


def test_tracker_gap_repair(spark):
    q = [1.0, 0.0, 0.0, 0.0]
    t = [*range(0, 400, 16), *range(600, 1000, 16)]
    df = frame(spark, [("s", float(x), [float(x), 0.0, 0.0], q) for x in t], "k string, t double, pos array<double>, quat array<double>")
    out = repair.repair_tracker_gaps(df, ["k"], "t", "pos", "quat")
    made = out.where("synthetic").collect()
    assert len(made) > 8 and all(abs(r["pos"][0] - r["t"]) < 1e-6 for r in made)
    t = [*range(0, 3200, 16), *range(4000, 4200, 16)]
    df = frame(spark, [("s", float(x), [0.0, 0.0, 0.0], q) for x in t], "k string, t double, pos array<double>, quat array<double>")
    assert repair.repair_tracker_gaps(df, ["k"], "t", "pos", "quat").agg(F.max("t")).first()[0] < 3200


def test_lags_of_equal_correlation_tie(spark):
    # three points on a line at every lag: all correlations are 1, whatever the rounding, so the smallest lag is the best
    a = spark.createDataFrame([("k", 0.1 * i, 0.1 + 0.7 * i) for i in range(40)], "k string, t double, value double")
    b = spark.createDataFrame([("k", 0.1 * i, 0.3 + 1.1 * i) for i in range(40)], "k string, t double, value double")
    scores = lag.pearson_at(a, b, ["k"], lag.steps(-0.9, 0.9, 0.1), 0.1)
    assert {r["score"] for r in scores.collect()} == {1.0}
    best = lag.best_lag(scores, ["k"]).first()
    assert best["lag"] == -0.9 and best["margin"] == 0.0


def test_streams_reach_python_packed_and_frames_stay_linear(spark):
    from chronoweave.operators import grid

    rng = np.random.default_rng(5)
    rows = [(k, i, float(a), float(b)) for k in range(40) for i, (a, b) in enumerate(rng.normal(size=(25 + k, 2)))]
    d = spark.createDataFrame(rows, "k int, i int, x double, y double").repartition(3)
    report = events.alignment_report(d, ["k"], "i", "x", "y", 20, 120)
    points = spark.range(40).select(F.col("id").cast("int").alias("k"), F.lit(3.5).alias("t"))
    inter = grid.interpolate(d.select("k", F.col("i").cast("double").alias("t"), F.col("x").alias("value")), points, ["k"])
    for df in (report, inter):  # no data frame a key, no frame that is read anew for every row
        plan = df._jdf.queryExecution().toString()
        assert "FlatMapGroupsInPandas" not in plan and "UNBOUNDED FOLLOWING" not in plan.upper() and "unboundedfollowing" not in plan
    pdf = pd.DataFrame(rows, columns=["k", "i", "x", "y"])
    for r in report.collect():
        p = pdf[pdf.k == r["k"]]
        assert r["n"] == 25 + r["k"] and abs(r["pearson"] - np.corrcoef(p.x, p.y)[0, 1]) < 1e-9
    got = {r["k"]: r["value"] for r in inter.collect()}
    for k, p in pdf.groupby("k"):
        assert abs(got[k] - np.interp(3.5, p.i, p.x)) < 1e-12


def test_lag_scan_copies_no_rows(spark):
    x, y = np.sin(np.arange(30) / 3), np.cos(np.arange(30) / 4)
    a = spark.createDataFrame([("k", i, float(v)) for i, v in enumerate(x) if i != 7], "k string, i int, x double")
    b = spark.createDataFrame([("k", i, float(v)) for i, v in enumerate(y) if i != 11], "k string, i int, y double")
    s = lag.lag_scores(a, b, ["k"], "x", "y", 4, 2)
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    got = {r["lag"]: (r["score"], r["n"]) for r in s.collect()}
    norm = np.sqrt(sum(v * v for i, v in enumerate(x) if i != 7) * sum(v * v for i, v in enumerate(y) if i != 11))
    for k in (-4, -2, 0, 2, 4):
        both = [x[i] * y[i + k] for i in range(30) if i != 7 and 0 <= i + k < 30 and i + k != 11]
        assert got.pop(k)[1] == len(both)
    assert not got and norm > 0
    assert abs({r["lag"]: r["score"] for r in s.collect()}[2] - sum(x[i] * y[i + 2] for i in range(28) if i not in (7, 9)) / norm) < 1e-12


def test_best_lag_of_a_scan_without_joins(spark):
    x = np.random.default_rng(3).normal(size=60)
    d = spark.createDataFrame([("k", i, float(x[i]), float(x[i - 3])) for i in range(60)], "k string, i int, x double, y double")
    best = lag.best_lag(lag.lag_scores(d, d, ["k"], "x", "y", 6), ["k"])
    assert "Join" not in best._jdf.queryExecution().optimizedPlan().toString() and best.first()["lag"] == 3
