"""Smoothers, differences, windows over samples."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def window(by: Sequence[str], order: Sequence[str] | str) -> W:
    return W.partitionBy(*by).orderBy(*([order] if isinstance(order, str) else order))


def moving_average(x: str, w: W, size: int) -> Column:
    """Centred mean over the rows there are (the frame shrinks at the ends)."""
    return F.avg(x).over(w.rowsBetween(-((size - 1) // 2), size // 2))


def padded_average(x: str, w: W, size: int) -> Column:
    """Centred sum / size: beyond the ends counts as zero."""
    return F.sum(x).over(w.rowsBetween(-((size - 1) // 2), size // 2)) / size


def rolling_median(x: str, w: W, size: int) -> Column:
    return F.percentile(x, 0.5).over(w.rowsBetween(-((size - 1) // 2), size // 2))


def difference(x: str, w: W) -> Column:
    """x minus the row before; 0 first."""
    return F.col(x) - F.coalesce(F.lag(x).over(w), F.col(x))


def gradient(x: str, w: W) -> Column:
    """Central difference for each row, one-sided at the ends."""
    before, after = F.lag(x).over(w), F.lead(x).over(w)
    return F.when(before.isNull() & after.isNull(), 0.0).when(before.isNull(), after - F.col(x)).when(after.isNull(), F.col(x) - before).otherwise((after - before) / 2)


def gradient_over(x: str, t: str, w: W) -> Column:
    """Second-order difference quotient on uneven times, one-sided at the ends."""
    x0, x1, x2 = F.lag(x).over(w), F.col(x), F.lead(x).over(w)
    a, b = F.col(t) - F.lag(t).over(w), F.lead(t).over(w) - F.col(t)
    mid = (a * a * x2 + (b * b - a * a) * x1 - b * b * x0) / (a * b * (a + b))
    return F.when(x0.isNull(), (x2 - x1) / b).when(x2.isNull(), (x1 - x0) / a).otherwise(mid)


def gaussian(df: DataFrame, by: Sequence[str], order: str, x: str, sigma: float, out: str) -> DataFrame:
    """Gaussian weights to 4 sigma, the signal mirrored at its ends (edge sample repeated).

    The frame's samples come as one array each row, so the weights are a constant and the plan stays one window."""
    r = int(4 * sigma + 0.5)
    k = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-r, r + 1)]
    weights = F.array(*[F.lit(v / sum(k)) for v in k])
    w = window(by, order)
    whole = W.partitionBy(*by)
    d = df.withColumn("_i", F.row_number().over(w) - 1).withColumn("_n", F.count("*").over(whole))
    d = d.withColumn("_near", F.collect_list(x).over(w.rowsBetween(-2 * r - 1, 2 * r + 1))).withColumn("_lo", F.greatest(F.col("_i") - (2 * r + 1), F.lit(0)))

    def mirrored(j: Column) -> Column:
        m = F.pmod(j, 2 * F.col("_n"))
        return F.when(m >= F.col("_n"), 2 * F.col("_n") - 1 - m).otherwise(m)

    at = F.transform(F.sequence(F.lit(-r), F.lit(r)), lambda o: F.try_element_at("_near", (mirrored(F.col("_i") + o) - F.col("_lo") + 1).cast("int")))
    return d.withColumn(out, F.aggregate(F.zip_with(at, weights, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)).drop("_i", "_n", "_near", "_lo")


def sliding_windows(df: DataFrame, by: Sequence[str], order: str, size: int, stride: int) -> DataFrame:
    """Each row once for every whole window of ``size`` rows that holds it: window_id, pos. A last partial window goes."""
    w = window(by, order)
    d = df.withColumn("_i", F.row_number().over(w) - 1).withColumn("_n", F.count("*").over(W.partitionBy(*by)))
    first = F.greatest(F.ceil((F.col("_i") - size + 1) / stride), F.lit(0))
    last = F.least(F.floor(F.col("_i") / stride), F.floor((F.col("_n") - size) / stride))
    d = d.where((F.col("_n") >= size) & (first <= last)).withColumn("window_id", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    return d.withColumn("pos", F.col("_i") - F.col("window_id") * stride).drop("_i", "_n")


def motion_signal(df: DataFrame, by: Sequence[str], order: str, xyz: Sequence[str], dt_ms: float, weights: tuple[float, float, float] = (0.55, 0.30, 0.15), out: str = "motion") -> DataFrame:
    """Weighted speed, acceleration and jerk of a position, each z-scored over its stream."""
    w, whole = window(by, order), W.partitionBy(*by)
    step = F.sqrt(sum(((F.col(c) - F.coalesce(F.lag(c).over(w), F.col(c))) ** 2 for c in xyz[1:]), (F.col(xyz[0]) - F.coalesce(F.lag(xyz[0]).over(w), F.col(xyz[0]))) ** 2))
    d = df.withColumn("_speed", step / dt_ms)
    d = d.withColumn("_accel", F.abs(difference("_speed", w)) / dt_ms)
    d = d.withColumn("_jerk", F.abs(difference("_accel", w)) / dt_ms)
    z = lambda c: F.when(F.stddev_pop(c).over(whole) < 1e-8, F.col(c) - F.avg(c).over(whole)).otherwise((F.col(c) - F.avg(c).over(whole)) / F.stddev_pop(c).over(whole))
    return d.withColumn(out, weights[0] * z("_speed") + weights[1] * z("_accel") + weights[2] * z("_jerk")).drop("_speed", "_accel", "_jerk")


def fill_linear(df: DataFrame, by: Sequence[str], order: str, x: str, out: str | None = None) -> DataFrame:
    """Nulls by linear interpolation over the row number; the nearest value at the ends."""
    w = window(by, order)
    d = df.withColumn("_i", F.row_number().over(w))
    s = F.when(F.col(x).isNotNull(), F.struct(F.col("_i").alias("i"), F.col(x).alias("v")))
    d = d.withColumn("_s", s).withColumn("_a", F.last("_s", True).over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("_b", F.first("_s", True).over(w.rowsBetween(0, W.unboundedFollowing)))
    a, b = F.col("_a"), F.col("_b")
    v = F.when(F.col(x).isNotNull(), F.col(x)).when(a.isNull(), b["v"]).when(b.isNull(), a["v"]).otherwise(a["v"] + (b["v"] - a["v"]) * (F.col("_i") - a["i"]) / (b["i"] - a["i"]))
    return d.withColumn(out or x, v).drop("_i", "_s", "_a", "_b")


def double_integral(df: DataFrame, by: Sequence[str], t: str, accel: str, out: str = "position") -> DataFrame:
    """Position from acceleration by two running sums, the linear drift of each taken out."""
    w = window(by, t)
    run = w.rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy(*by)
    d = df.withColumn("_dt", F.coalesce(F.col(t) - F.lag(t).over(w), F.lit(0.0)))
    for src, dst in ((accel, "_v"), ("_v", out)):
        d = d.withColumn(dst, F.sum(F.col(src) * F.col("_dt")).over(run))
        slope, mid, mean = F.covar_pop(dst, t).over(whole) / F.nullif(F.var_pop(t).over(whole), F.lit(0.0)), F.avg(t).over(whole), F.avg(dst).over(whole)
        d = d.withColumn(dst, F.col(dst) - mean - F.coalesce(slope, F.lit(0.0)) * (F.col(t) - mid))
    return d.drop("_dt", "_v")
