"""Repairs of streams; every repair returns a new version of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.pose import invalid_quaternion, quaternion, slerp
from .islands import best_segment, segments, with_segments
from .timebase import ordered, renumber


def repair_quaternions(df: DataFrame, by: Sequence[str], order: str, quat: str, reach: int = 50) -> DataFrame:
    """Invalid rows by slerp between the nearest valid rows at most ``reach`` rows away, else the nearer side's value, else
    null; column ``repaired``."""
    w = W.partitionBy(*by).orderBy(order)
    bad = invalid_quaternion(quaternion(F.col(quat)))
    d = df.withColumn("_i", F.row_number().over(w)).withColumn("repaired", bad)
    d = d.withColumn("_ok", F.when(~F.col("repaired"), F.struct(F.col("_i").alias("i"), F.col(quat).alias("q"))))
    d = d.withColumn("_a", F.last("_ok", True).over(w.rowsBetween(-reach, -1))).withColumn("_b", F.first("_ok", True).over(w.rowsBetween(1, reach)))
    a, b = F.col("_a"), F.col("_b")
    share = (F.col("_i") - a["i"]) / (b["i"] - a["i"])
    fixed = F.when(~F.col("repaired"), F.col(quat)).when(a.isNotNull() & b.isNotNull(), slerp(a["q"], b["q"], share)).otherwise(F.coalesce(a["q"], b["q"]))
    return d.withColumn(quat, fixed).drop("_i", "_ok", "_a", "_b")


def repair_tracker_gaps(df: DataFrame, by: Sequence[str], time: str, pos: str, quat: str, threshold: float = 60.0, interpolate_below: float = 300.0, least_coverage: float = 0.70, least_duration: float = 1000.0) -> DataFrame:
    """Gaps under ``interpolate_below`` get linear positions and slerped orientations at the median step; a stream with a
    wider gap keeps only its longest segment if that covers ``least_coverage`` of it, else it stays as it is."""
    by = list(by)
    w = ordered(by, time)
    d = df.withColumn("_t", F.lead(time).over(w)).withColumn("_p", F.lead(pos).over(w)).withColumn("_q", F.lead(quat).over(w))
    step = d.groupBy(*by).agg(F.median(F.col("_t") - F.col(time)).alias("_dt"), F.max(F.col("_t") - F.col(time)).alias("_widest"), (F.max(time) - F.min(time)).alias("_span"))
    d = d.join(step, by)
    gap = F.col("_t") - F.col(time)
    n = F.round(gap / F.col("_dt")).cast("int") - 1
    holes = d.where((gap > threshold) & (gap < interpolate_below)).withColumn("_n", n).where("_n > 0").withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    share = F.col("_k") / (F.col("_n") + 1)
    made = holes.select(*by, (F.col(time) + share * gap).cast(df.schema[time].dataType).alias(time), F.zip_with(pos, "_p", lambda a, b: a + share * (b - a)).alias(pos), slerp(F.col(quat), F.col("_q"), share).alias(quat), F.lit(True).alias("synthetic"))
    main = best_segment(segments(df, by, [time], time, interpolate_below), by, least_duration=least_duration).select(*by, F.col("segment").alias("_main"), F.col("duration").alias("_kept"))
    whole = with_segments(df, by, [time], time, interpolate_below).join(step, by).join(main, by, "left")
    cut = (F.col("_widest") >= interpolate_below) & (F.col("_kept") >= least_coverage * F.col("_span"))
    kept = whole.where(~F.coalesce(cut, F.lit(False)) | (F.col("segment") == F.col("_main"))).select(*df.columns).withColumn("synthetic", F.lit(False))
    return kept.unionByName(made, allowMissingColumns=True)


def repair_camera_gaps(df: DataFrame, by: Sequence[str], order: str, time: str, window: DataFrame, threshold: float = 120.0, least_duration: float = 500.0, least_coverage: float = 0.60) -> DataFrame:
    """Keeps the segment (file order) that covers most of the tracker window and renumbers its frames; streams without a
    good segment stay as they are."""
    by = list(by)
    seg = with_segments(df, by, [order], time, threshold)
    best = best_segment(segments(df, by, [order], time, threshold), by, window, least_duration, least_coverage).select(*by, F.col("segment").alias("_best"))
    kept = seg.join(best, by, "left").where(F.col("_best").isNull() | (F.col("_best") == F.col("segment"))).drop("segment", "_best")
    return renumber(kept, by, time, order)


def shift_and_window(df: DataFrame, by: Sequence[str], time: str, offsets: DataFrame, offset: str, window: DataFrame, margin: float = 50.0) -> DataFrame:
    """Adds each stream's offset, keeps rows in the tracker window with a margin, renumbers."""
    by = list(by)
    d = df.join(offsets, by, "left").withColumn(time, F.col(time) + F.coalesce(F.col(offset), F.lit(0.0))).drop(offset)
    d = d.join(window, by, "left").where(F.col("w0").isNull() | F.col(time).between(F.col("w0") - margin, F.col("w1") + margin)).drop("w0", "w1")
    return renumber(d, by, time)


def first_frames_offset(frames: DataFrame, trackers: DataFrame, by: Sequence[str], order: str, time: str, n: int = 3) -> DataFrame:
    """Tracker start less the median of the first ``n`` frame times."""
    first = frames.where(F.col(time).isNotNull()).withColumn("_r", F.row_number().over(W.partitionBy(*by).orderBy(order))).where(F.col("_r") <= n)
    return first.groupBy(*by).agg(F.median(time).alias("_f")).join(trackers.groupBy(*by).agg(F.min(time).alias("_t")), list(by)).select(*by, (F.col("_t") - F.col("_f")).alias("shift_ms"))


def drift_points(ref: DataFrame, tgt: DataFrame, by: Sequence[str], time: str, n: int = 30) -> DataFrame:
    """``n`` evenly spaced probe times of the reference and the nearest target time (the earlier on a tie)."""
    from .asof import asof_join

    by = list(by)
    span = ref.groupBy(*by).agg(F.min(time).cast("double").alias("_a"), F.max(time).cast("double").alias("_z"))
    probes = span.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select(*by, "k", (F.col("_a") + (F.col("_z") - F.col("_a")) * F.col("k") / (n - 1)).alias("probe"))
    right = tgt.select(*by, F.col(time).cast("double").alias("_tt"))
    hit = asof_join(probes, right, by, "probe", "_tt", ["_tt"])
    return hit.select(*by, "k", "probe", (F.col("_tt") - F.col("probe")).alias("offset"))


def undo_drift(df: DataFrame, by: Sequence[str], time: str, fit: DataFrame, least_ppm: float = 50.0) -> DataFrame:
    """Subtracts slope x (t - first t) of each stream's fitted drift when it is at least ``least_ppm``."""
    by = list(by)
    zero = df.groupBy(*by).agg(F.min(time).alias("_t0"))
    d = df.join(zero, by).join(fit.select(*by, "slope"), by, "left")
    use = F.when(F.abs(F.col("slope") * 1e6) >= least_ppm, F.col("slope")).otherwise(0.0)
    return d.withColumn(time, F.col(time) - F.coalesce(use, F.lit(0.0)) * (F.col(time) - F.col("_t0"))).drop("_t0", "slope")


def accept_if_improved(before: DataFrame, after: DataFrame, by: Sequence[str], score: str, tolerance: float = 2.0) -> DataFrame:
    """Which version each key keeps: the repaired one unless its score fell by more than ``tolerance``."""
    b = before.select(*by, F.col(score).alias("score_before"))
    a = after.select(*by, F.col(score).alias("score_after"))
    good = F.col("score_after").isNotNull() & (F.col("score_after") >= F.col("score_before") - tolerance)
    return b.join(a, list(by), "left").withColumn("accepted", good).withColumn("score", F.when(good, F.col("score_after")).otherwise(F.col("score_before")))


def desync(df: DataFrame, by: Sequence[str], time: str, offsets: Sequence[float]) -> DataFrame:
    """A copy of the stream for each offset, its times less the offset: negative examples for training."""
    return df.withColumn("offset_ms", F.explode(F.array(*[F.lit(float(o)) for o in offsets]))).withColumn(time, F.col(time) - F.col("offset_ms"))


def baseline_flags(df: DataFrame, by: Sequence[str], error: str, speed: str, reference: DataFrame, mad_factor: float = 8.0, speed_factor: float = 3.0) -> DataFrame:
    """Marks rows whose error is over ``mad_factor`` MADs of the reference median while the speed is over ``speed_factor``
    x its p95. ``reference``: keys, median, mad, speed_p95."""
    d = df.join(F.broadcast(reference), list(by), "left") if by else df.crossJoin(F.broadcast(reference))  # one reference row
    far = F.abs(F.col(error) - F.col("median")) / F.greatest(F.col("mad"), F.lit(1e-4)) > mad_factor
    return d.withColumn("bad", F.coalesce(far & (F.col(speed) > speed_factor * F.col("speed_p95")), F.lit(False))).drop("median", "mad", "speed_p95")
