"""Pair alignment of sessions: estimates, reliability, validation before and after a shift."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.lag import best_lag, coarse_to_fine
from ..operators.timebase import shift

#: Reference and target of the pairs that are aligned, in order.
PAIRS = [("tracker_head", "cam_head"), ("tracker_left", "cam_left"), ("tracker_right", "cam_right"), ("tracker_left", "gripper_left"), ("tracker_right", "gripper_right")]


def flux_pairs(flux: DataFrame, pairs: list[tuple[str, str]] = PAIRS) -> DataFrame:
    """Pair table joined with both streams' presence: session_id, pair, ref, tgt for sessions that have both."""
    spark = flux.sparkSession
    table = F.broadcast(spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pair int, ref string, tgt string"))
    names = flux.select("session_id", "flux").distinct()
    return names.withColumnRenamed("flux", "ref").join(table, "ref").join(names.withColumnRenamed("flux", "tgt"), ["session_id", "tgt"]).select("session_id", "pair", "ref", "tgt")


def estimate_pairs(flux: DataFrame, pairs: DataFrame, step: float = 20.0, max_lag: float = 400.0, coarse: float = 40.0, fine: float = 10.0, least_score: float = 0.5, least_margin: float = 0.02) -> DataFrame:
    """Lag, score, margin and reliability of each pair; ``shift_to_apply`` is added to target times (ms)."""
    a = flux.join(pairs.select("session_id", "pair", F.col("ref").alias("flux")), ["session_id", "flux"]).select("session_id", "pair", "t", "value")
    b = flux.join(pairs.select("session_id", "pair", F.col("tgt").alias("flux")), ["session_id", "flux"]).select("session_id", "pair", "t", "value")
    best = coarse_to_fine(a, b, ["session_id", "pair"], step, max_lag, coarse, fine)
    reliable = (F.col("score") >= least_score) & (F.coalesce(F.col("margin"), F.lit(0.0)) >= least_margin)
    return pairs.join(best, ["session_id", "pair"]).withColumn("reliable", reliable).withColumn("shift_to_apply", F.col("fine_lag"))


def shifts_to_apply(estimates: DataFrame, most: float = 800.0) -> DataFrame:
    """One shift per target: its first reliable pair within the bound."""
    ok = estimates.where(F.col("reliable") & (F.abs("shift_to_apply") <= most))
    return ok.groupBy("session_id", "tgt").agg(F.min_by("shift_to_apply", "pair").alias("shift_ms"))


def apply_shifts(flux: DataFrame, shifts: DataFrame, time: str = "t") -> DataFrame:
    return shift(flux, shifts.withColumnRenamed("tgt", "flux"), ["session_id", "flux"], time)


def validate(scores: DataFrame, least_mean: float = 50.0, most_spread: float = 200.0) -> DataFrame:
    """Mean pair score and dispersion of the camera shifts of each session, and whether both are in bounds."""
    s = scores.groupBy("session_id").agg(F.avg("score_100").alias("mean_score"), F.min("score_100").alias("worst_score"), F.min_by("pair", "score_100").alias("worst_pair"), F.stddev_pop("shift_ms").alias("shift_spread"))
    return s.withColumn("valid", (F.col("mean_score") >= least_mean) & (F.coalesce("shift_spread", F.lit(0.0)) <= most_spread))


def session_score(pair_scores: DataFrame) -> DataFrame:
    """Worst, mean, median and best pair of a session; the worst one is the session's score."""
    return pair_scores.groupBy("session_id").agg(F.min("score_100").alias("score"), F.avg("score_100").alias("mean"), F.median("score_100").alias("median"), F.max("score_100").alias("best"), F.min_by("pair", "score_100").alias("worst_pair"), F.max_by("pair", "score_100").alias("best_pair"))


def lag_summary(window_scores: DataFrame, by: list[str]) -> DataFrame:
    """0.65 p75 + 0.35 mean of the window scores at each lag, then the best lag."""
    per = window_scores.groupBy(*by, "lag").agg((0.65 * F.percentile("score", 0.75) + 0.35 * F.avg("score")).alias("score"))
    return best_lag(per, by)
