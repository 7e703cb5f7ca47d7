"""Shared state: ledgers, claims, resumable runs, quiet sessions, progress of streams."""

import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from chronoweave.plans.runner import Runner, Step, claim, claims, release
from chronoweave.sources.ledger import Ledger
from chronoweave.streaming import ingest
from chronoweave.streaming.progress import ProgressTable, latest_progress, read_progress


def count_files(path):
    return sum(len(names) for _, _, names in os.walk(path))


def sessions(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "session_id string")


def test_two_writers_never_lose_rows(spark, tmp_path):
    ledgers = [Ledger(spark, str(tmp_path / "l"), "k long, who long") for _ in range(2)]
    spark.range(1).count()

    def write(who):
        for _ in range(4):
            # the next number after all that are there: two writers on one state would take the same one
            ledgers[who].append(lambda rows: rows.agg((F.coalesce(F.max("k"), F.lit(-1)) + 1).alias("k")).withColumn("who", F.lit(who).cast("long")))

    threads = [threading.Thread(target=write, args=(w,)) for w in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(r["k"] for r in ledgers[0].read().collect()) == list(range(8))


def test_a_ledger_stays_bounded(spark, tmp_path):
    root = str(tmp_path / "l")
    ledger = Ledger(spark, root, "k string, v long", squash=lambda rows: rows.groupBy("k").agg(F.max("v").alias("v")), compact_every=4)
    sizes = []
    for v in range(24):
        ledger.append(lambda rows: spark.createDataFrame([("a", v)], "k string, v long").coalesce(1))
        sizes.append(count_files(root))
    assert ledger.read().agg(F.max("v")).first()[0] == 23 and max(sizes[12:]) <= max(sizes[:12]) + 2
    assert ledger.append(lambda rows: rows.where("false")).count() == 0


def test_claims_are_exclusive_and_expire(spark, tmp_path):
    ledger = claims(spark, str(tmp_path / "claims"))
    got = lambda df: sorted(r["session_id"] for r in df.collect())
    assert got(claim(ledger, sessions(spark, "a", "b", "a"), "one", 600)) == ["a", "b"]
    assert got(claim(ledger, sessions(spark, "b", "c"), "two", 1.0)) == ["c"]
    release(ledger, sessions(spark, "a"), "one")
    time.sleep(1.2)
    assert got(claim(ledger, sessions(spark, "a", "b", "c"), "three", 600)) == ["a", "c"]
    assert got(claim(ledger, sessions(spark, "b"), "one", 600)) == ["b"]


class Killed(BaseException):
    pass


def steps(calls, fail=(), kill=None):
    def step(name):
        def run(due):
            ids = sorted(r["session_id"] for r in due.collect())
            calls.append((name, ids))
            if kill == name:
                raise Killed
            bad = F.col("session_id").isin(*[s for n, s in fail if n == name])
            return due.select("session_id", (~bad).alias("ok"), F.lit(name).alias("detail"), F.when(bad, "broken").alias("error"))

        return run

    return [Step("detect", step("detect"), 0), Step("tracker", step("tracker"), 1), Step("video", step("video"), 1), Step("rotate", step("rotate"), 1, when=False), Step("store", step("store"), 2)]


def test_a_killed_run_goes_on_at_its_step(spark, tmp_path):
    root, calls = str(tmp_path / "run"), []
    with pytest.raises(Killed):
        Runner(spark, root, steps(calls, kill="video")).run(sessions(spark, "a", "b"))
    assert [n for n, _ in calls] == ["detect", "tracker", "video"]
    calls.clear()
    got = Runner(spark, root, steps(calls)).run(sessions(spark, "a", "b"))
    assert calls == [("video", ["a", "b"]), ("store", ["a", "b"])]
    assert {(r["session_id"], r["next_step"], r["n_done"]) for r in got.collect()} == {("a", None, 5), ("b", None, 5)}
    calls.clear()
    Runner(spark, root, steps(calls)).run(sessions(spark, "a", "b"))
    assert calls == []


def test_a_failed_session_stops_alone_and_is_tried_again(spark, tmp_path):
    root, calls = str(tmp_path / "run"), []
    got = Runner(spark, root, steps(calls, fail=[("tracker", "b")])).run(sessions(spark, "a", "b"))
    assert {(r["session_id"], r["next_step"], r["failed"], r["error"]) for r in got.collect()} == {("a", None, False, None), ("b", "tracker", True, "broken")}
    assert ("video", ["a", "b"]) in calls and calls[-1] == ("store", ["a"])
    calls.clear()
    Runner(spark, root, steps(calls)).run(sessions(spark, "a", "b", "c"))
    assert calls == [("detect", ["c"]), ("tracker", ["b", "c"]), ("video", ["c"]), ("store", ["b", "c"])]
    calls.clear()
    Runner(spark, root, steps(calls)).run(sessions(spark, "a"), only=["tracker"], force=["tracker"])
    assert calls == [("tracker", ["a"])]
    assert Runner(spark, root, steps(calls)).run(sessions(spark)).count() == 0


def test_a_step_without_a_result_fails(spark, tmp_path):
    run = Runner(spark, str(tmp_path / "run"), [Step("detect", lambda due: due.where("session_id <> 'b'").select("session_id", F.lit(True).alias("ok"), F.lit("").alias("detail"), F.lit(None).cast("string").alias("error")), 0)])
    assert {(r["session_id"], r["failed"], r["error"]) for r in run.run(sessions(spark, "a", "b")).collect()} == {("a", False, None), ("b", True, "no result")}


def test_claimed_sessions_are_left_to_their_run(spark, tmp_path):
    root, calls = str(tmp_path / "run"), []
    claim(claims(spark, f"{root}/claims"), sessions(spark, "a"), "another", 600)
    Runner(spark, root, steps(calls)).run(sessions(spark, "a", "b"))
    assert all(ids == ["b"] for _, ids in calls) and len(calls) == 4


def put(folder, name, at, text="x"):
    (folder / name).parent.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    os.utime(folder / name, (at, at))


def test_a_session_waits_for_its_last_file(spark, tmp_path, monkeypatch):
    inbox, target, check = tmp_path / "inbox", str(tmp_path / "bronze"), str(tmp_path / "check")
    one, two = inbox / "session_one", inbox / "session_two"
    now = time.time()

    def watch(ahead):
        monkeypatch.setattr(ingest, "_now", lambda: time.time() + ahead)
        ingest.watch_sessions(spark, str(inbox), ingest.land_once(target), check, quiet_seconds=100, once=True).awaitTermination(60)
        return sorted(r["session_id"] for r in spark.read.parquet(target).collect()) if os.path.isdir(target) else []

    put(one, "metadata.json", now - 1000, json.dumps({"session_id": "one", "operator": "o"}))
    put(one, "videos/head.mp4", now - 10)
    put(two, "metadata.json", now - 1000, json.dumps({"session_id": "two"}))
    put(two, "videos/head.mp4.part", now - 1000)
    put(inbox / "session_three", "tracker_positions.csv", now - 1000)
    assert watch(0) == []
    put(two, "videos/head.mp4", now - 900)
    assert watch(0) == ["session_two"]
    assert watch(200) == ["session_one", "session_two"]
    put(inbox / "session_three", "metadata.json", now, "{}")
    assert watch(200) == ["session_one", "session_three", "session_two"]


def test_waiting_sessions_leave_bounded_files_and_progress_is_a_table(spark, tmp_path):
    inbox, check, table = tmp_path / "inbox", str(tmp_path / "check"), str(tmp_path / "progress")
    put(inbox / "session_one", "metadata.json", time.time(), "{}")
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "3")
    spark.conf.set("spark.sql.streaming.stateStore.maintenanceInterval", "500ms")
    sizes, seen = {}, []
    try:
        with ProgressTable(spark, table, seconds=1.0) as progress:
            q = ingest.watch_sessions(spark, str(inbox), lambda df, i: seen.append((i, df.count())), check, every="0 seconds", quiet_seconds=3600)
            end = time.time() + 90
            while time.time() < end and (q.lastProgress is None or q.lastProgress["batchId"] < 24):
                if q.lastProgress is not None:
                    sizes[q.lastProgress["batchId"]] = count_files(check)
                time.sleep(0.2)
            progress.flush()
            running = latest_progress(read_progress(spark, table)).first()
            q.stop()
    finally:
        spark.conf.unset("spark.sql.streaming.minBatchesToRetain")
        spark.conf.unset("spark.sql.streaming.stateStore.maintenanceInterval")
    assert running["running"] and running["batch_id"] >= 3 and running["state_rows"] == 1 and running["input_rows"] >= 1
    assert sum(n for _, n in seen) == 0 and len(sizes) > 3
    batches = sorted(sizes)
    late = [sizes[b] for b in batches if b >= batches[len(batches) // 2]]
    assert max(late) <= 2 * min(late)
    last = latest_progress(read_progress(spark, table)).first()
    assert not last["running"]
