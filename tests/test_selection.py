"""Distributed selection, numbering and samples; role inference and the session check on built cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.operators import roles, selection, session as ses, stats
from chronoweave.plans import session_check as sc


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(5)
    rows = [("wide", float(v)) for v in rng.lognormal(0, 6, 5000)] + [("ties", float(v)) for v in rng.integers(0, 3, 3000)] + [("one", 7.0)] * 400
    rows += [("few", v) for v in (3.0, 1.0)] + [("wide", None), ("wide", float("nan")), ("wide", float("inf")), ("none", None), (None, 2.0)]
    return spark.createDataFrame(rows, "k string, v double").repartition(7)


@pytest.mark.parametrize(("last", "bins"), [(50_000, 1024), (10, 4)])
def test_percentiles_are_exact(spark, values, last, bins):
    shares = [0.0, 0.01, 0.5, 0.75, 0.999, 1.0]
    keyed = values.where("k is not null")
    got = {r["k"]: r for r in selection.exact_percentiles(keyed, ["k"], "v", shares, last, bins).collect()}
    own = {}
    for r in keyed.collect():
        if r["v"] is not None and math.isfinite(r["v"]):
            own.setdefault(r["k"], []).append(r["v"])
    assert set(got) == set(own)
    for k, vs in own.items():
        assert got[k]["n"] == len(vs) and [got[k][f"p{i}"] for i in range(6)] == pytest.approx(np.quantile(vs, shares).tolist(), rel=1e-12)
    whole = selection.exact_percentiles(values, [], "v", [0.5], last, bins).first()
    every = [v for vs in own.values() for v in vs] + [2.0]
    assert whole["p0"] == pytest.approx(np.median(every)) and whole["n"] == len(every)
    mm = lambda df: sorted((r["k"], r["median"], r["mad"], r["n"]) for r in df.collect())
    assert mm(selection.exact_median_mad(keyed, ["k"], "v", 0.1, last, bins)) == mm(stats.median_mad(keyed, ["k"], "v", 0.1))
    assert selection.exact_percentiles(values.where("false"), ["k"], "v", [0.5]).count() == 0


def test_selection_never_orders_a_whole_key(spark, values):
    """The plan orders only values within the last bin, which the join with the bounds leaves."""
    plan = selection.select_ranks(values.where("k is not null"), ["k"], "v", {("wide",): [2500]}, 10, 4)._jdf.queryExecution().executedPlan().toString()
    at = plan.index("Window")
    assert "Join" in plan[at:] and "lo" in plan[at:] and "SinglePartition" not in plan


def test_numbers_and_sums_by_ranges(spark):
    rng = np.random.default_rng(3)
    ids = rng.permutation(5000).tolist()
    df = spark.createDataFrame([(f"e{i:05d}", i % 7) for i in ids], "e string, n long").repartition(5)
    got = selection.number_rows(df, "e", parts=6).orderBy("number").collect()
    assert [r["number"] for r in got] == list(range(5000)) and [r["e"] for r in got] == sorted(r["e"] for r in got)
    sums = {r["number"]: r["s"] for r in selection.running_sums(selection.number_rows(df, "e"), "number", "n", "s", block=300).collect()}
    assert [sums[i] for i in range(5000)] == np.concatenate(([0], np.cumsum([r["n"] for r in got])))[:-1].tolist()
    assert selection.number_rows(df.where("false"), "e").count() == 0


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(900)] + [(9, 1)], "k long, i long")
    take = lambda d: sorted(map(tuple, selection.keyed_sample(d, ["k"], 20, ["k", "i"]).collect()))
    one = take(df.repartition(1))
    assert one == take(df.repartition(9)) and len(one) == 61
    least = lambda d, k: sorted(map(tuple, selection.least_hashes(d, k).collect()))
    assert least(df.repartition(1), 100) == least(df.repartition(8), 100) and len(least(df, 100)) == 100
    assert len(least(df, 5000)) == 901 and least(df, 0) == []
    x = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1000)], "i long, label long")
    counts = {r["label"]: r["count"] for r in stats.rebalance(x, "label", 3, 10_000).groupBy("label").count().collect()}
    assert counts == {0: 300, 1: 100} and stats.rebalance(x, "label", 3, 120).count() == 120


def turned(yaw):
    return [math.cos(yaw / 2), 0.0, 0.0, math.sin(yaw / 2)]


def people(swap, n=40, seed=1):
    """Rows of a head that turns about the vertical, with hands to its left and right; ``swap`` exchanges the hands' blocks."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        yaw = 2 * math.pi * i / n
        right = np.array([math.cos(yaw), math.sin(yaw), 0.0])
        head = np.array([0.1 * i, 0.0, 1.7]) + rng.normal(0, 0.01, 3)
        hands = [head + s * 0.3 * right + [0, 0, -0.6] + rng.normal(0, 0.02, 3) for s in (1, -1)]
        blocks = [head, *(hands[::-1] if swap else hands)]
        rows += [(i, b, p.tolist(), turned(yaw) if b == 0 else turned(0.3)) for b, p in enumerate(blocks)]
    return rows


def test_roles_of_a_turning_head(spark):
    rows = [("plain", *r) for r in people(False)] + [("swapped", *r) for r in people(True, seed=2)] + [("short", *r) for r in people(False, n=5)]
    rows += [("plain", 99, 0, [0.0, 0.0, 0.0], turned(0.0))]  # a row without its hands does not count
    df = spark.createDataFrame(rows, "s string, i long, block long, pos array<double>, quat array<double>").withColumn("head", F.lit(1)).drop("head")
    hints = spark.createDataFrame([(s, b, r) for s in ("plain", "swapped", "short") for b, r in enumerate(("head", "right", "left"))], "s string, block long, role string")
    got = {r["s"]: r for r in roles.infer_roles(df, "s", "block", "i", hints).collect()}
    assert (got["plain"]["head"], got["plain"]["right"], got["plain"]["left"]) == (0, 1, 2) and not got["plain"]["swapped"] and got["plain"]["swaps"] == []
    assert (got["swapped"]["head"], got["swapped"]["right"], got["swapped"]["left"]) == (0, 2, 1) and got["swapped"]["swaps"] == ["right>left", "left>right"]
    assert (got["plain"]["axis"], got["plain"]["sign"], got["plain"]["n_rows"]) == (2, 1, 40) and got["plain"]["confidence"] > 0.9
    assert got["short"]["error"] == "too few rows" and got["short"]["confidence"] == 0.0 and not got["short"]["swapped"]
    sides = {r["s"]: r for r in roles.infer_left_right(df, roles.infer_head(df, "s", "block", "i"), "s", "block", "i").collect()}
    assert sides["plain"]["up_local"] == 2 and sides["plain"]["right_local"] == 0 and sides["plain"]["vertical_penalty"] < 0.05
    assert roles.infer_roles(df.where("false"), "s", "block", "i").count() == 0


LAYOUT = sc.Layout(step=20.0, least_rows=20)


def stream(session, name, start, n, signal, step=33.0, valid=True):
    return [(session, name, start + i * step, float(signal(start + i * step)), valid) for i in range(n)]


def wave(t):
    return math.sin(t / 200) + 0.5 * math.sin(t / 71)


def test_session_check_from_raw_streams(spark):
    whole = lambda s: [r for name in LAYOUT.required for r in stream(s, name, 0.0, 200, wave)]
    without = lambda s, name: [r for r in whole(s) if r[1] != name]
    rows = whole("good") + whole("late") + whole("no_metadata") + without("no_camera", "cam_left") + without("no_tracker", "tracker")
    rows += without("one_frame", "cam_right") + stream("one_frame", "cam_right", 10.0, 1, wave)
    rows += without("corrupt", "tracker") + stream("corrupt", "tracker", 0.0, 200, wave, valid=False)
    rows += [r for r in whole("gaps") if r[1] != "tracker" or int(r[2] / 33) % 20 > 4]
    rows += without("short_camera", "cam_head") + stream("short_camera", "cam_head", 0.0, 60, wave)
    rows += [r for r in whole("unlike") if r[1] == "tracker"] + [r for c in LAYOUT.cameras for r in stream("unlike", c, 0.0, 200, lambda t: (t * 7919) % 13)]
    names = ["good", "late", "no_metadata", "no_camera", "no_tracker", "one_frame", "corrupt", "gaps", "short_camera", "unlike", "nothing"]
    sessions = spark.createDataFrame([(s, s != "no_metadata" or None, -5000.0 if s == "late" else None) for s in names], "session_id string, metadata_ok boolean, trigger double")
    streams = spark.createDataFrame(rows + [("stranger", "tracker", 0.0, 0.0, True), ("good", "tracker", None, 1.0, True)], "session_id string, stream string, t double, value double, valid boolean")
    got = {r["session_id"]: r for r in sc.check_sessions(sessions, streams, "session_id", LAYOUT).collect()}
    assert {s: r["blocked_by"] for s, r in got.items()} == {"good": None, "late": None, "no_metadata": "metadata", "no_camera": "structure", "no_tracker": "structure", "one_frame": "camera_coverage", "corrupt": "quaternions", "gaps": "tracker_continuity", "short_camera": "camera_coverage", "unlike": None, "nothing": "structure"}
    assert got["good"]["score"] == 100.0 and got["good"]["n_pairs"] == 3 and got["unlike"]["score"] < 40
    assert got["late"]["penalty"] == pytest.approx(1 - 4750 / 10_000) and got["late"]["score"] == pytest.approx(52.5)
    assert [g["name"] for g in got["no_camera"]["gates"]] == ["structure"] and got["no_camera"]["camera_coverage"] == 0.0
    assert len(got["good"]["gates"]) == 6 and got["nothing"]["n_missing_files"] == 4
    assert all(r["score"] == 0 and r["alignment"] is None for r in got.values() if r["blocked_by"])


def test_gates_see_absent_cameras(spark):
    rows = [(s, k, 33.0 * i) for s in ("three", "two", "none") for k in ("tracker", "a", "b", "c")[: {"three": 4, "two": 3, "none": 1}[s]] for i in range(50)]
    got = {r["s"]: r for r in ses.gate_metrics(spark.createDataFrame(rows, "s string, k string, t double"), "s", "k", "t", "tracker", ["a", "b", "c"]).collect()}
    assert {s: r["camera_coverage"] for s, r in got.items()} == {"three": 1.0, "two": 0.0, "none": 0.0} and got["none"]["n_camera_gaps"] == 0


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_iso_shifts_know_no_zone(spark, zone):
    rows = [("2026-03-29T02:30:00+00:00", 0.0, "2026-03-29T02:30:00.000000+00:00"), ("2026-03-08T02:30:00.5Z", 1.5, "2026-03-08T02:30:00.501500+00:00"), ("2026-10-25T00:30:00.123456", 3_600_000.0, "2026-10-25T01:30:00.123456+00:00"), ("2024-02-29T23:59:59.999999+00:00", 0.001, "2024-03-01T00:00:00.000000+00:00"), (None, 1.0, None)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = spark.createDataFrame(rows, "a string, m double, want string").select("want", ses.shift_iso(F.col("a"), F.col("m")).alias("got")).collect()
        assert all(r["got"] == r["want"] for r in got)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_full_check_leaves_out_what_is_missing(spark):
    from chronoweave.plans import full_check as fc

    def dims(*rows):
        return spark.createDataFrame([(*r, []) if len(r) < 7 else r for r in rows], f"s string, {fc.DIMENSION}")

    rows = dims(
        ("whole", "gripper_ts", 80.0, 0.9, False, None, ["trim", "shift"]), ("whole", "video_tracker_sync", 90.0, 0.9, False, None, ["shift"]), ("whole", "video_quality", 100.0, 0.8, False, None), ("whole", "gripper_frame_sync", 50.0, 0.6, False, None),
        ("vague", "gripper_ts", 100.0, 1.0, False, None), ("vague", "gripper_frame_sync", 50.4, 0.3, False, None), ("vague", "video_quality", None, 0.9, False, None),
        ("stopped", "video_orientation", 0.0, 0.9, True, "upside down"), ("stopped", "gripper_health", 50.0, 0.1, True, "dead"), ("stopped", "video_quality", 100.0, 0.9, False, None),
        ("low", "gripper_ts", 59.0, 0.9, False, None), ("low", "gripper_frame_sync", 44.0, 0.9, False, None),
    )
    ids = spark.createDataFrame([(x,) for x in ("whole", "vague", "stopped", "low", "none")], "s string")
    got = {r["s"]: r for r in fc.full_check(ids, [rows.where("name < 'm'"), rows.where("name >= 'm'")], "s").collect()}
    assert got["whole"]["score"] == pytest.approx(0.25 * 80 + 0.30 * 90 + 0.15 * 100 + 0.30 * 50) and got["whole"]["verdict"] == "ACCEPTABLE"
    assert got["whole"]["repairs"] == ["trim", "shift"] and got["whole"]["missing"] == ["video_orientation", "gripper_health"]
    assert got["vague"]["score"] == 100.0 and got["vague"]["verdict"] == "PERFECT" and got["vague"]["inconclusive"] == ["gripper_frame_sync"]
    assert got["vague"]["confidence"] == pytest.approx(0.25 + 0.3 * 0.3) and "video_quality" in got["vague"]["missing"]
    assert got["stopped"]["blocking_reason"] == "[video_orientation] upside down" and got["stopped"]["verdict"] == "BLOCKED"
    assert got["low"]["blocking_reason"] == "too low: gripper_ts=59, gripper_frame_sync=44"
    assert (got["none"]["score"], got["none"]["blocked"], got["none"]["grade"], len(got["none"]["missing"])) == (50.0, False, "D", 6)


def test_closed_positions_give_the_offset(spark):
    from chronoweave.operators import frame_sync

    shut = np.random.default_rng(4).random(60) < 0.45

    def opening(t):
        return 5.0 if shut[int(t // 370) % 60] else 60.0

    rows = [("ahead", 20.0 * i, opening(20.0 * i), opening(20.0 * i - 300)) for i in range(1000)] + [("level", 20.0 * i, opening(20.0 * i), opening(20.0 * i)) for i in range(1000)] + [("still", 20.0 * i, 40.0, opening(20.0 * i)) for i in range(1000)]
    d = spark.createDataFrame(rows, "s string, t double, o double, v double")
    got = {r["s"]: r for r in frame_sync.closed_offset(d.select("s", "t", F.col("o").alias("value")), d.select("s", "t", (F.col("v") / 60).alias("value")), ["s"]).collect()}
    assert got["ahead"]["offset_ms"] == pytest.approx(300, abs=30) and got["ahead"]["status"] == "shifted" and got["ahead"]["peak"] > 0.9
    assert abs(got["level"]["offset_ms"]) < 30 and got["level"]["status"] == "ok" and got["still"]["status"] == "no_data"


def test_calibration_leaves_bad_frames_out(spark):
    from chronoweave.operators import frame_sync

    rng = np.random.default_rng(8)
    sensor = [("s", 10.0 * i, 30 + 25 * math.sin(i / 15)) for i in range(400)]
    frames = [("s", i, 33.0 * i + 5, 4 * (30 + 25 * math.sin((33.0 * i + 5) / 150)) + 7 + rng.normal(0, 1) + (400 if i in (20, 21, 70) else 0)) for i in range(118)]
    c = frame_sync.gap_calibration(spark.createDataFrame(frames, "k string, frame long, t double, gap double"), spark.createDataFrame(sensor, "k string, t double, value double"), ["k"])
    rows = {r["frame"]: r for r in c.collect()}
    assert {f for f, r in rows.items() if r["anomaly"]} == {20, 21, 70} == {f for f, r in rows.items() if not r["used"]} and sum(r["in_sync"] for r in rows.values()) == len(rows) - 3
    got = frame_sync.gap_report(c, ["k"]).first()
    assert got["px_per_mm"] == pytest.approx(4, rel=0.01) and got["n_anomalies"] == 3 and got["score"] > 95


def test_flat_windows_correlate_with_nothing(spark):
    from chronoweave.operators import smooth, stats

    rows = [("a", i, float(i), 5.0 if i < 6 else float(i % 4)) for i in range(12)] + [("b", 0, 1.0, 1.0), ("b", 1, 2.0, None)]
    d = spark.createDataFrame(rows, "k string, i int, x double, y double")
    w = smooth.sliding_windows(d, ["k"], "i", 6, 3).groupBy("k", "window_id").agg(stats.safe_corr("x", "y").alias("c"), stats.pearson("x", "y").alias("p"))
    got = {r["window_id"]: (r["c"], r["p"]) for r in w.collect()}
    x, y = np.arange(12.0), np.array([r[3] for r in rows[:12]])
    assert got[0] == (0.0, None)
    for k in (1, 2):
        assert abs(got[k][0] - np.corrcoef(x[3 * k : 3 * k + 6], y[3 * k : 3 * k + 6])[0, 1]) < 1e-12 and got[k][0] == got[k][1]
    assert d.where("k = 'b'").agg(stats.pearson("x", "y")).first()[0] is None


def test_rolling_correlation_with_a_flat_window(spark):
    from chronoweave.operators import lag, signals

    x = [20.0 * (i % 3) for i in range(24)]
    y = [7.0] * 12 + [float(i * i % 11) for i in range(12)]
    d = spark.createDataFrame([("a", i, a, b) for i, (a, b) in enumerate(zip(x, y, strict=True))], "k string, i int, x double, y double")
    s = signals.rolling_correlation(d, ["k"], "i", "x", "y", 12, 6, 10.0).first()
    want = sorted([0.0, *[np.corrcoef(x[k : k + 12], y[k : k + 12])[0, 1] for k in (6, 12)]])
    assert s["n_windows"] == 3 and abs(s["median_r"] - want[1]) < 1e-12 and abs(s["min_r"] - want[0]) < 1e-12
    scores = lag.lag_scores(d.where("i < 12"), d.where("i < 12"), ["k"], "x", "y", 2, scorer="pearson").collect()
    assert len(scores) == 5 and {r["score"] for r in scores} == {0.0}
    assert stats.error_metrics(d.where("i < 12"), ["k"], "x", "y").first()["corr"] is None


def test_gate_metrics_of_a_tracker_without_length(spark):
    rows = [("one", "tracker", 5.0), ("one", "a", 4.0), ("one", "a", 9.0), ("one", "b", 5.0), ("two", "tracker", 0.0), ("two", "tracker", 10.0), ("two", "a", 5.0), ("two", "a", 12.0), ("two", "b", 0.0), ("two", "b", 9.0)]
    got = {r["s"]: r for r in ses.gate_metrics(spark.createDataFrame(rows, "s string, k string, t double"), "s", "k", "t", "tracker", ["a", "b"]).collect()}
    assert got["one"]["camera_coverage"] is None and got["one"]["n_tracker_gaps"] == 0 and got["one"]["start_spread_ms"] == 1.0
    assert abs(got["two"]["camera_coverage"] - 0.5) < 1e-12


def test_session_check_of_a_tracker_without_length(spark, tmp_path):
    from datetime import datetime

    import duckdb

    from chronoweave.plans.queries import QUERIES, SQL

    rows = [(0, 3, "view", 1), (1, 3, "click", 2), (2, 3, "click", 9), (3, 3, "purchase", 1), (4, 7, "view", 1), (5, 7, "view", 8), (6, 7, "click", 1), (7, 7, "click", 6), (8, 7, "purchase", 2), (9, 7, "purchase", 9)]
    events = [(i, datetime(2024, 1, day), u, k, 1.0, "{}") for i, u, k, day in rows]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    got = sorted(tuple(r) for r in QUERIES["session_check"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.sql(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    assert got == sorted(con.sql(SQL["session_check"]).fetchall()) and [r[0] for r in got] == [3, 7] and got[0][4] == 0.0 < got[1][4]


def test_a_sample_on_the_closed_limit_counts_as_closed(spark):
    from chronoweave.operators import frame_sync

    # quartiles 5.595 and 9.495: the limit is 6.57, which floating point puts just below
    d = spark.createDataFrame([("a", float(i), v) for i, v in enumerate([6.57, 10.27, 11.97, 7.17, 4.97, 5.27])], "k string, t double, value double")
    got = {r["t"]: r["value"] for r in frame_sync._closed(d, ["k"], "t", "value", 3.9).collect()}
    assert got == {0.0: 1.0, 1.0: 0.0, 2.0: 0.0, 3.0: 0.0, 4.0: 1.0, 5.0: 1.0}


def test_full_check_checks_the_sessions_once(spark):
    from chronoweave.plans.session_queries import full_check

    plan = full_check(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
