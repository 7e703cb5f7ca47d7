"""Gates, alerts, dimensions and grades of sessions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import grade


@dataclass(frozen=True)
class Gate:
    """``fails`` is SQL over one row of session metrics; ``position`` orders the short circuit."""

    name: str
    fails: str
    position: int
    blocking: bool = True


#: Gates of the session check in their order; metrics: see ``run_gates``.
SESSION_GATES = [
    Gate("structure", "n_missing_files > 0", 0),
    Gate("metadata", "not has_metadata", 1),
    Gate("quaternions", "invalid_quaternion_share > 0.05", 2),
    Gate("tracker_continuity", "n_tracker_gaps >= 3", 3),
    Gate("camera_continuity", "n_camera_gaps >= 5", 4),
    Gate("camera_coverage", "camera_coverage < 0.65", 5),
    Gate("stream_alignment", "start_spread_ms > 1000", 6, blocking=False),
]


def run_gates(metrics: DataFrame, session: str, gates: Sequence[Gate] = SESSION_GATES) -> DataFrame:
    """One row per session and gate: gate, position, passed, blocking. A null metric passes."""
    rows = F.array(*[F.struct(F.lit(g.name).alias("gate"), F.lit(g.position).alias("position"), (~F.coalesce(F.expr(g.fails), F.lit(False))).alias("passed"), F.lit(g.blocking).alias("blocking")) for g in gates])
    return metrics.select(session, F.explode(rows).alias("g")).select(session, "g.*")


def first_failed_gate(gates: DataFrame, session: str) -> DataFrame:
    """The first gate that stops each session (null if none), how many failed, and whether one blocks."""
    failed = ~F.col("passed")
    return gates.groupBy(session).agg(
        F.min_by(F.when(failed & F.col("blocking"), F.col("gate")), F.when(failed & F.col("blocking"), F.col("position"))).alias("first_failed"),
        F.count_if(failed).alias("n_failed"),
        F.bool_or(failed & F.col("blocking")).alias("blocked"),
    )


@dataclass(frozen=True)
class Alert:
    code: str
    level: str
    when: str


#: Gripper and video alerts; thresholds of the side check.
SIDE_ALERTS = [
    Alert("VIDEO_DROPS", "WARNING", "n_drops > 0"),
    Alert("VIDEO_MISSING_INDEX", "ERROR", "n_missing > 0"),
    Alert("VIDEO_JITTER", "WARNING", "jitter > 5"),
    Alert("SENSOR_UNSORTED", "ERROR", "n_back_steps > 0"),
    Alert("SENSOR_GAP", "ERROR", "dt_max > 200"),
    Alert("SENSOR_FAST", "WARNING", "n_fast > 0"),
    Alert("SENSOR_FLAT", "WARNING", "value_range < 1"),
    Alert("LATENCY_MAX", "ERROR", "latency_max > 50"),
    Alert("LATENCY_MEAN", "WARNING", "latency_mean > 10"),
    Alert("COVERAGE", "ERROR", "coverage < 0.95"),
    Alert("OFFSET", "ERROR", "abs(offset_ms) > 200"),
]


def alerts(metrics: DataFrame, keys: Sequence[str], rules: Sequence[Alert] = SIDE_ALERTS) -> DataFrame:
    """One row for each alert that fires."""
    every = F.array(*[F.when(F.expr(a.when), F.struct(F.lit(a.code).alias("code"), F.lit(a.level).alias("level"))) for a in rules if all(w in metrics.columns for w in _names(a.when))])
    return metrics.select(*keys, F.explode(F.filter(every, lambda x: x.isNotNull())).alias("a")).select(*keys, "a.*")


def _names(sql: str) -> list[str]:
    return [w for w in re.findall(r"[a-z_]+", sql) if w != "abs"]


def side_score(alert_rows: DataFrame, keys: Sequence[str], sides: DataFrame) -> DataFrame:
    """100 less min(25 e + 5 (e - 1), 65) for e errors, else at least 55 after 10 for each warning."""
    counts = alert_rows.groupBy(*keys).agg(F.count_if(F.col("level") == "ERROR").alias("errors"), F.count_if(F.col("level") == "WARNING").alias("warnings"))
    s = sides.select(*keys).join(counts, list(keys), "left").fillna(0, ["errors", "warnings"])
    e = F.col("errors")
    return s.withColumn("score", F.when(e > 0, 100.0 - F.least(25 * e + 5 * (e - 1), F.lit(65))).otherwise(F.greatest(F.lit(55.0), 100.0 - 10 * F.col("warnings"))))


#: Weight of each dimension of the full check.
DIMENSIONS = {"gripper_ts": 0.25, "video_tracker_sync": 0.30, "video_quality": 0.15, "gripper_frame_sync": 0.30, "video_orientation": 0.0, "gripper_health": 0.0}


def combine_dimensions(dims: DataFrame, session: str, weights: dict[str, float] | None = None, low: float = 60.0, low_sync: float = 45.0) -> DataFrame:
    """Weighted score over the conclusive dimensions, confidence, blocking, grade and verdict of each session.

    ``dims``: session, name, score, confidence, blocking and, without ``weights``, weight. A neutral dimension (score 50,
    confidence under 0.5, not blocking) does not count. A dimension under ``low`` (``low_sync`` for frame sync) blocks."""
    if weights is not None:
        w = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        dims = dims.withColumn("weight", F.coalesce(w[F.col("name")], F.lit(0.0)))
    neutral = (F.col("score") == 50) & (F.col("confidence") < 0.5) & ~F.col("blocking")
    use = F.when(~neutral & F.col("score").isNotNull(), F.col("weight")).otherwise(0.0)
    bad = F.col("blocking") | ((use > 0) & (F.col("score") < F.when(F.col("name") == "gripper_frame_sync", low_sync).otherwise(low)))
    d = dims.withColumn("_w", use).withColumn("_bad", F.coalesce(bad, F.lit(False)))
    total = F.nullif(F.sum("_w"), F.lit(0.0))
    s = d.groupBy(session).agg((F.sum(F.col("_w") * F.col("score")) / total).alias("score"), (F.sum(F.col("_w") * F.col("confidence")) / total).alias("confidence"), F.bool_or("_bad").alias("blocked"), F.count_if(F.col("_w") > 0).alias("n_used"))
    verdict = F.when(F.col("score").isNull(), "UNKNOWN").when(F.col("blocked"), "BLOCKED").when(F.col("score") >= 75, "GOOD").when(F.col("score") >= 60, "ACCEPTABLE").otherwise("BAD")
    return s.withColumn("grade", grade(F.col("score"))).withColumn("verdict", verdict)


def video_quality(metrics: DataFrame, camera_keys: Sequence[str], session: str) -> DataFrame:
    """Mean over the cameras of 100 less penalties for drops, missing frames, jitter and an odd rate."""
    p = F.least(F.lit(40.0), 4.0 * F.col("n_drops")) + F.least(F.lit(30.0), 2.0 * F.col("n_missing")) + F.when(F.col("jitter") > 5, 15.0).when(F.col("jitter") > 2, 5.0).otherwise(0.0) + F.when(~F.col("dt_mean").between(30, 37), 15.0).otherwise(0.0)
    each = metrics.withColumn("_s", F.greatest(F.lit(0.0), 100 - p))
    return each.groupBy(session).agg(F.avg("_s").alias("score"), F.min("_s").alias("worst"), F.count("*").alias("n_cameras"))


def penalty_product(df: DataFrame, by: Sequence[str], factor: str) -> DataFrame:
    """Product of the factors of each key (0 if one is 0)."""
    return df.groupBy(*by).agg(F.when(F.min(factor) <= 0, 0.0).otherwise(F.exp(F.sum(F.log(F.nullif(F.greatest(F.col(factor), F.lit(0.0)), F.lit(0.0)))))).alias("penalty"))


def stuck(df: DataFrame, by: Sequence[str], value: str, share: float = 0.95) -> DataFrame:
    """Sensors whose values are almost all zero, and dead ones whose mean is exactly zero."""
    z = F.avg(F.when(F.col(value) == 0, 1.0).otherwise(0.0))
    return df.groupBy(*by).agg(z.alias("zero_share"), (z > share).alias("stuck"), (F.avg(value) == 0.0).alias("dead"))


#: Problems by the gate or check that reveals them, with the repair that answers them; lower priority first.
PROBLEMS = [
    ("quaternions", "corrupt_quaternions", "repair_quaternions", 1),
    ("tracker_continuity", "tracker_gaps", "repair_tracker_gaps", 2),
    ("camera_continuity", "camera_gaps", "repair_camera_gaps", 3),
    ("camera_coverage", "camera_offset", "shift_and_window", 4),
    ("stream_alignment", "start_misaligned", "trim_to_common_start", 5),
    ("tracker_placement", "tracker_labels_swapped", "relabel", 6),
    ("camera_labels", "camera_labels_swapped", "relabel", 7),
    ("clock_drift", "clock_drift", "undo_drift", 8),
    ("sync_lag", "residual_lag", "shift", 9),
    ("gripper_sync", "gripper_offset", "shift", 10),
]


def diagnose(gates: DataFrame, session: str) -> DataFrame:
    """Problems of each session by priority, from its failed gates."""
    table = gates.sparkSession.createDataFrame(PROBLEMS, "gate string, problem string, repair string, priority int")
    return gates.where("not passed").join(F.broadcast(table), "gate").select(session, "problem", "repair", "priority", "gate").orderBy(session, "priority")


def ingress(checks: DataFrame, session: str) -> DataFrame:
    """All-or-nothing over the checks of a session: ok, and the names that failed."""
    return checks.groupBy(session).agg(F.every("ok").alias("accepted"), F.array_sort(F.collect_set(F.when(~F.col("ok"), F.col("check")))).alias("failed"))


def fuse_scores(visual: DataFrame, proprio: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Visual and proprioceptive scores to one: a weak visual result leaves the proprioceptive one (or a neutral 50), a good
    visual one takes only a bonus from it, else the confidence-weighted mean."""
    v = visual.select(*keys, F.col("score").alias("_v"), F.col("confidence").alias("_vc"), "invalid_share", "rolling_r")
    p = proprio.select(*keys, F.col("score").alias("_p"), F.col("confidence").alias("_pc"))
    weak = F.col("_v").isNull() | (F.col("_vc") < 0.75) | (F.col("invalid_share") > 0.40) | (F.col("rolling_r") < 0.50)
    blend = (F.col("_v") * F.col("_vc") + F.col("_p") * F.col("_pc")) / F.nullif(F.col("_vc") + F.col("_pc"), F.lit(0.0))
    score = F.when(weak, F.coalesce("_p", F.lit(50.0))).when(F.col("_p").isNull(), F.col("_v")).when(F.col("_v") >= 60, F.greatest("_v", F.coalesce(blend, F.col("_v")))).otherwise(F.coalesce(blend, F.col("_v")))
    conf = F.when(weak, F.coalesce("_pc", F.lit(0.3))).otherwise(F.greatest("_vc", F.coalesce("_pc", F.lit(0.0))))
    return v.join(p, list(keys), "full").select(*keys, score.alias("score"), conf.alias("confidence"), weak.alias("visual_weak"))


def training_eligible(states: DataFrame, checks: DataFrame, session: str, steps: Sequence[str] = ("tracker", "video", "verify_labels"), least: float = 0.90) -> DataFrame:
    """Sessions whose steps are all done and whose label check is ok with confidence."""
    done = states.where(F.col("step").isin(*steps) & (F.col("status") == "done")).groupBy(session).agg(F.count_distinct("step").alias("_n")).where(F.col("_n") == len(steps))
    good = checks.where(F.col("ok") & (F.col("confidence") >= least))
    return done.select(session).join(good.select(session).distinct(), session, "left_semi")


def decided(score: Column, high: float, low: float) -> Column:
    """1, 0 or null for the middle band, for pseudo labels."""
    return F.when(score >= high, 1).when(score <= low, 0)
