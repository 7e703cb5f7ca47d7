"""Files, datasets, checks and streaming."""

import json
import os

import pytest
from pyspark.sql import functions as F

from chronoweave.plans import checks, dataset, tiers
from chronoweave.sources import readers, sinks
from chronoweave.streaming import ingest, windows


@pytest.fixture
def session(tmp_path):
    root = tmp_path / "inbox"
    s = root / "session_20260101_000000"
    (s / "videos").mkdir(parents=True)
    (s / "videos/head.jsonl").write_bytes(b'{"index": 127, "capture_time": 1000}\r\n{"index": 128, "capture_time": 1033.5}\r\nbroken\r\n{"index": 128, "capture_time": 1034}\r\n')
    (s / "gripper_left_data.csv").write_text("timestamp_ns;opening_mm;angle_deg;sw\n2000000000;5;1;ON\n1000000000;x;1;ON\n3000000000;7;;OFF\n")
    head = "time_seconds,timestamp,timestamp_ns," + ",".join(f"tracker_{r}_{k}" for r in ("head", "left", "right") for k in ("x", "y", "z", "qw", "qx", "qy", "qz"))
    (s / "tracker_positions.csv").write_text(head + "\n" + "0,,1000000000," + ",".join(["1"] * 20) + ",nan\n")
    (s / "metadata.json").write_text(json.dumps({"session_id": "session_20260101_000000", "scenario": "Kitchen", "duration_seconds": 3.5, "cameras": {"0": {"name": "a", "position": "head", "serial": "x"}}}))
    return str(root), str(s)


def test_readers(spark, session):
    root, s = session
    frames = readers.read_frames(spark, f"{s}/videos/head.jsonl")
    assert [(r["index"], r["t_ms"]) for r in frames.orderBy("row_id").collect()] == [(127, 1000.0), (128, 1033.5), (128, 1034.0)]
    assert frames.first()["session_id"] == "session_20260101_000000"
    assert readers.last_per_index(frames).where("index = 128").first()["t_ms"] == 1034.0
    g = readers.read_gripper(spark, f"{s}/gripper_left_data.csv").orderBy("t_ms").collect()
    assert [(r["side"], r["t_ms"], r["opening_mm"], r["sw"]) for r in g] == [("left", 2000.0, 5.0, "ON"), ("left", 3000.0, 7.0, "OFF")]
    t = {r["block"]: r for r in readers.read_tracker(spark, f"{s}/tracker_positions.csv").collect()}
    assert t["head"]["pos"] == [1.0, 1.0, 1.0] and t["right"]["quat"][3] is None and t["left"]["t_ms"] == 1000.0
    m = readers.read_metadata(spark, f"{s}/metadata.json").first()
    assert m["scenario"] == "Kitchen" and m["cameras"]["0"]["position"] == "head"
    assert [r["session_id"] for r in readers.list_sessions(spark, root).collect()] == ["session_20260101_000000"]
    with pytest.raises(ValueError, match="missing"):
        readers.read_csv(spark, f"{s}/gripper_left_data.csv", required=["nope"])
    lost = readers.missing_files(readers.list_files(spark, root), ["metadata.json", "videos/left.jsonl"], readers.list_sessions(spark, root))
    assert [r["name"] for r in lost.collect()] == ["videos/left.jsonl"]


def test_episode_dataset_resumes(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1.0, None), ("b", 2.0, 4.0), ("a", 5.0, float("nan"))], "session string, t double, v double")
    e = dataset.episode_rows(rows, "session", "t")
    got = {(r["session"], r["frame_index"]): (r["episode_index"], r["index"], r["timestamp"], r["v"]) for r in e.collect()}
    assert got == {("a", 0): (0, 0, 0.0, 0.0), ("b", 0): (1, 1, 0.0, 0.0), ("b", 1): (1, 2, 1.0, 4.0)}
    root = str(tmp_path / "ds")
    dataset.write_episodes(e, root)
    dataset.write_episodes(e, root)
    assert spark.read.parquet(f"{root}/data").count() == 3 and spark.read.parquet(f"{root}/meta/episodes").count() == 2
    assert {r["n_rows"] for r in readers.read_episodes(spark, root).collect()} == {1, 2}


def test_registry_and_versions(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "session string, x int")
    reg = str(tmp_path / "reg")
    assert sinks.not_yet(df, spark, reg, "session").count() == 2
    sinks.register(df.where("x = 1"), reg, "session")
    assert [r["session"] for r in sinks.not_yet(df, spark, reg, "session").collect()] == ["b"]
    path = sinks.write_version(df, str(tmp_path / "t"), "1")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        sinks.write_version(df, str(tmp_path / "t"), "1")


def test_dimensions_and_blocking(spark):
    rows = [("s", "gripper_ts", 90.0, 0.9, False), ("s", "video_quality", 50.0, 0.3, False), ("s", "gripper_frame_sync", 44.0, 0.9, False), ("t", "video_quality", 95.0, 1.0, False), ("t", "gripper_health", 0.0, 1.0, True)]
    got = {r["session"]: r for r in checks.combine_dimensions(spark.createDataFrame(rows, "session string, name string, score double, confidence double, blocking boolean"), "session", checks.DIMENSIONS).collect()}
    assert abs(got["s"]["score"] - (0.25 * 90 + 0.30 * 44) / 0.55) < 1e-9 and got["s"]["blocked"] and got["s"]["n_used"] == 2
    assert got["t"]["grade"] == "A" and got["t"]["verdict"] == "BLOCKED"


def test_side_score(spark):
    sides = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    al = spark.createDataFrame([("a", "X", "ERROR"), ("a", "Y", "ERROR"), ("b", "Z", "WARNING")], "k string, code string, level string")
    assert {r["k"]: r["score"] for r in checks.side_score(al, ["k"], sides).collect()} == {"a": 45.0, "b": 90.0, "c": 100.0}


def test_repair_loop_keeps_only_improvements(spark):
    rows = spark.createDataFrame([("a", 50.0), ("b", 50.0)], "k string, q double")
    fix = lambda d: d.withColumn("q", F.when(F.col("k") == "a", F.col("q") + 30).otherwise(F.col("q") - 30))
    score = lambda d: d.groupBy("k").agg(F.avg("q").alias("score"))
    out, log = tiers.repair_loop(rows, score, [("boost", fix)], ["k"], lambda d: d)
    assert {r["k"]: r["q"] for r in out.collect()} == {"a": 80.0, "b": 50.0}
    assert {r["k"]: r["accepted"] for r in log.collect()} == {"a": True, "b": False}


def test_watcher_lands_each_session_once(spark, session, tmp_path):
    root, _ = session
    target, check = str(tmp_path / "bronze"), str(tmp_path / "check")
    for _ in range(2):
        q = ingest.watch_sessions(spark, root, ingest.land_once(target), check, once=True)
        q.awaitTermination(60)
    assert [r["session_id"] for r in spark.read.parquet(target).collect()] == ["session_20260101_000000"]


def test_a_young_file_lands_later(spark, session, tmp_path, monkeypatch):
    root, s = session
    target, check = str(tmp_path / "bronze"), str(tmp_path / "check")
    real = ingest._now()
    landed = lambda: [r["session_id"] for r in spark.read.parquet(target).collect()]
    monkeypatch.setattr(ingest, "_now", lambda: real)
    ingest.watch_sessions(spark, root, ingest.land_once(target), check, quiet_seconds=3600, once=True).awaitTermination(60)
    assert landed() == []
    # another file arrives two hours later: the first has ripened, the new one waits
    other = tmp_path / "inbox/session_20260102_000000"
    other.mkdir()
    (other / "metadata.json").write_text(json.dumps({"session_id": "session_20260102_000000"}))
    os.utime(other / "metadata.json", (real + 7200, real + 7200))
    monkeypatch.setattr(ingest, "_now", lambda: real + 7300)
    ingest.watch_sessions(spark, root, ingest.land_once(target), check, quiet_seconds=3600, once=True).awaitTermination(60)
    assert landed() == ["session_20260101_000000"]
    # no new file: a later start hands over what has ripened since
    monkeypatch.setattr(ingest, "_now", lambda: real + 20000)
    for _ in range(2):
        ingest.watch_sessions(spark, root, ingest.land_once(target), check, quiet_seconds=3600, once=True).awaitTermination(60)
    assert sorted(landed()) == ["session_20260101_000000", "session_20260102_000000"]


def test_each_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "s1").mkdir()
    (tmp_path / "s2").mkdir()
    (tmp_path / "s1/gripper_left_data.csv").write_text("timestamp_ns,opening_mm,sw\n1000000,5,ON\n")
    (tmp_path / "s2/gripper_left_data.csv").write_text("\nopening_mm;timestamp_ns\n7;2000000\n")
    rows = readers.read_csv(spark, f"{tmp_path}/*/gripper_left_data.csv", required=["opening_mm"]).collect()
    assert {(r["session_id"], r["timestamp_ns"], r["opening_mm"], r["sw"]) for r in rows} == {("s1", "1000000", "5", "ON"), ("s2", "2000000", "7", None)}
    with pytest.raises(ValueError, match="missing columns: sw"):
        readers.read_csv(spark, f"{tmp_path}/*/gripper_left_data.csv", required=["sw"])


def test_header_truth_and_confidence(spark):
    from chronoweave.operators import roles, session as ses

    names = ["a", "b", "c"] + [f"tracker_{r}_{k}" for r in ("left", "head", "right") for k in range(7)]
    assert ses.header_truth(names) == {"left": 0, "head": 1, "right": 2}
    with pytest.raises(ValueError, match="no unique label"):
        ses.header_truth(["a", "b", "c"] + [f"x{k}" for k in range(21)])
    got = spark.createDataFrame([(4.0, 2.5), (60.0, 60.0)], "h double, s double").select(roles.global_confidence("h", "s").alias("c")).collect()
    assert abs(got[0]["c"] - 0.5) < 1e-9 and got[1]["c"] > 0.999
    c = spark.createDataFrame([(0.5, 2.0, 20.0, float("nan")), (1.0, 4.0, 40.0, -1.0)], "q double, e double, r double, p double")
    assert [round(r["c"], 3) for r in c.select(ses.vision_confidence(*map(F.col, "qerp")).alias("c")).collect()] == [0.55, 1.0]


def test_sensor_fixes_fill_and_extend(spark):
    from chronoweave.operators import session as ses

    rows = [("s", float(t), 5.0) for t in (100, 117, 134, 219, 236)]
    starts = spark.createDataFrame([("s", 49.0)], "k string, start double")
    out = ses.sensor_fixes(spark.createDataFrame(rows, "k string, t double, v double"), ["k"], "t", "v", starts, "start").orderBy("t").collect()
    assert [r["t"] for r in out] == [49.0, 66.0, 83.0, 100.0, 117.0, 134.0, 151.0, 168.0, 185.0, 202.0, 219.0, 236.0]
    assert [r["synthetic"] for r in out].count(True) == 7 and out[0]["dt_ms"] == 0 and {r["dt_ms"] for r in out[1:]} == {17.0}


def test_streaming_windows_equal_batch(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(src).withColumn("ts", F.col("ts").cast("timestamp"))
    folder = str(tmp_path / "in")
    batch.repartition(3).write.parquet(folder)
    stream = spark.readStream.schema(batch.schema).parquet(folder)
    out = windows.time_windows(stream, ["event_type"], "ts", "1 day", None, [F.count("*").alias("n")], delay="60 days")
    q = out.writeStream.outputMode("complete").format("memory").queryName("win").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = windows.time_windows(batch, ["event_type"], "ts", "1 day", None, [F.count("*").alias("n")])
    assert sorted(map(tuple, spark.table("win").collect())) == sorted(map(tuple, want.collect()))


def test_headers_may_hold_the_separator_and_change_from_file_to_file(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"s{i}").mkdir()
    (tmp_path / "s0/a.csv").write_text('"speed, mm",t\n"1,5",2\n\n3,4\n')
    (tmp_path / "s1/a.csv").write_text("t\tw\r\n5\t6\r\n")
    (tmp_path / "s2/a.csv").write_text("  \nw;t\n7;8\n9\n")
    (tmp_path / "s3/a.csv").write_text("t\n10\n")
    (tmp_path / "s4/a.csv").write_text("")
    (tmp_path / "s5/a.csv").write_text("t,w\n")
    rows = readers.read_csv(spark, f"{tmp_path}/*/a.csv")
    got = {(r["session_id"], r["row_id"], r["t"], r["w"], r["speed, mm"]) for r in rows.collect()}
    assert got == {("s0", 1, "2", None, "1,5"), ("s0", 3, "4", None, "3"), ("s1", 1, "5", "6", None), ("s2", 2, "8", "7", None), ("s2", 3, None, "9", None), ("s3", 1, "10", None, None)}
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="no rows"):
        readers.read_csv(spark, f"{tmp_path}/s4/a.csv")


def test_a_retry_promotes_and_registers_nothing_twice(spark, tmp_path):
    from chronoweave.sources import sinks

    rows = spark.createDataFrame([("a", "x"), ("b", None)], "session_id string, scenario string")
    for _ in range(2):
        path = sinks.promote(rows, str(tmp_path), "gold")
        sinks.register(rows, str(tmp_path / "sent"), "session_id")
    assert spark.read.parquet(path).count() == 2 and spark.read.parquet(str(tmp_path / "sent")).count() == 2
