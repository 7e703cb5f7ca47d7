"""A gripper's opening against what its camera shows, from a table of decoded visual gaps: no pixels are read here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.scalars import clamp
from .grid import interpolate
from .lag import on_common_grid
from .stats import pearson

#: Share of the quartile range above the lower quartile up to which a signal counts as closed; least quartile ranges of the
#: sensor (mm) and of the visual signal, and least closed samples. Fixed values.
CLOSED_FRAC, LEAST_SENSOR, LEAST_VISUAL, LEAST_CLOSED = 0.25, 3.0, 0.03, 10


def _closed(df: DataFrame, by: Sequence[str], time: str, value: str, least: float) -> DataFrame:
    """(by, t, value): 1 where the stream is closed, else 0; a stream whose quartiles are too near gives nothing."""
    d = df.where(F.col(time).isNotNull() & F.col(value).isNotNull()).select(*by, F.col(time).cast("double").alias("t"), F.col(value).cast("double").alias("_v"))
    q = d.groupBy(*by).agg(F.percentile("_v", 0.25).alias("_a"), F.percentile("_v", 0.75).alias("_b"))
    # rounded, so that a sample on the limit counts as closed however the quartiles were interpolated
    width, limit = (F.round(c, 9) for c in (F.col("_b") - F.col("_a"), F.col("_a") + (F.col("_b") - F.col("_a")) * CLOSED_FRAC))
    q = q.select(*by, limit.alias("_limit"), width.alias("_width")).where(F.col("_width") >= least)
    return d.join(q, list(by)).select(*by, "t", F.when(F.round("_v", 9) <= F.col("_limit"), 1.0).otherwise(0.0).alias("value"))


def closed_offset(sensor: DataFrame, visual: DataFrame, by: Sequence[str], time: str = "t", value: str = "value", step: float = 50.0, max_lag: float = 2000.0, least_overlap: float = 2000.0, zone: int = 5, significant: float = 50.0, least_visual: float = LEAST_VISUAL) -> DataFrame:
    """How far the sensor runs ahead of the camera (ms, positive: ahead), from when both are closed.

    Both signals become closed or not by their own quartiles and meet on a grid; the overlap of closed samples is counted at
    every lag. Returns by, n_closed_sensor, n_closed_visual, peak (share of the smaller count), offset_ms (vertex of the
    parabola through the peak), snr (peak over the mean of the lags outside ``zone`` samples around it) and status: no_data,
    weak (too few closed samples, or snr under 2), shifted, ok. Keys whose signals hardly move, or that overlap too little,
    are no_data; keys of ``sensor`` alone too. Work grows with closed samples x lags of a small range.
    """
    by = list(by)
    k = int(max_lag / step)
    both = on_common_grid(_closed(sensor, by, time, value, LEAST_SENSOR), _closed(visual, by, time, value, least_visual), by, step)
    both = both.withColumn("_span", (F.max("t").over(W.partitionBy(*by)) - F.min("t").over(W.partitionBy(*by)))).where(F.col("_span") >= least_overlap - step)
    both = both.select(*by, "i", (F.col("x") >= 0.5).alias("_s"), (F.col("y") >= 0.5).alias("_v"))
    counts = both.groupBy(*by).agg(F.count_if("_s").alias("n_closed_sensor"), F.count_if("_v").alias("n_closed_visual"))
    lags = F.sequence(F.lit(-k), F.lit(k))
    moved = both.where("_s").select(*by, "i", F.explode(lags).alias("lag")).select(*by, "lag", (F.col("i") + F.col("lag")).alias("i"))
    hits = moved.join(both.where("_v").select(*by, "i"), [*by, "i"]).groupBy(*by, "lag").agg(F.count("*").alias("n"))
    curve = counts.where(f"n_closed_sensor >= {LEAST_CLOSED} and n_closed_visual >= {LEAST_CLOSED}").select(*by, F.explode(lags).alias("lag")).join(hits, [*by, "lag"], "left").fillna(0, ["n"])
    near = W.partitionBy(*by).orderBy("lag")
    curve = curve.withColumns({"_p": F.lag("n").over(near), "_q": F.lead("n").over(near)})
    top = curve.groupBy(*by).agg(F.min_by(F.struct("lag", "n", "_p", "_q"), F.struct(-F.col("n"), "lag")).alias("_t"))
    rest = curve.join(top, by).where(F.abs(F.col("lag") - F.col("_t.lag")) > zone).groupBy(*by).agg(F.avg("n").alias("_noise"))
    peak = top.join(rest, by, "left").join(counts, by, "right")
    bend = F.col("_t._p") - 2 * F.col("_t.n") + F.col("_t._q")
    vertex = F.when(F.abs(bend) > 1e-10, F.greatest(F.lit(-0.5), F.least(F.lit(0.5), 0.5 * (F.col("_t._p") - F.col("_t._q")) / bend))).otherwise(0.0)
    out = sensor.select(*by).distinct().join(peak, by, "left")
    out = out.withColumns({"offset_ms": (F.col("_t.lag") + F.coalesce(vertex, F.lit(0.0))) * step, "peak": F.col("_t.n") / F.least("n_closed_sensor", "n_closed_visual"), "snr": F.col("_t.n") / (F.coalesce("_noise", F.lit(0.0)) + 1e-8)})
    status = F.when(F.col("n_closed_sensor").isNull(), "no_data").when(F.col("_t").isNull() | (F.col("snr") < 2), "weak").when(F.abs("offset_ms") > significant, "shifted").otherwise("ok")
    return out.select(*by, F.coalesce("n_closed_sensor", F.lit(0)).alias("n_closed_sensor"), F.coalesce("n_closed_visual", F.lit(0)).alias("n_closed_visual"), "peak", "offset_ms", "snr", status.alias("status"))


def gap_calibration(frames: DataFrame, sensor: DataFrame, by: Sequence[str], frame: str = "frame", time: str = "t", gap: str = "gap", value: str = "value", sigmas: float = 3.0, floor: float = 15.0, rounds: int = 2, least: int = 30) -> DataFrame:
    """One row a frame: sensor, predicted, residual, used, in_sync, anomaly - the visual gap explained by the opening.

    The sensor is interpolated at every frame (frames outside its span do not count); a line is fitted by least squares,
    frames further than ``sigmas`` deviations from it are left out and the line is fitted again, ``rounds`` times. A frame is
    in sync within max(floor, sigmas x deviation) of the last line and an anomaly beyond three times that. Keys with fewer
    than ``least`` frames give nothing. Windows hold one camera of one session."""
    by = list(by)
    d = interpolate(sensor, frames.where(F.col(gap).isNotNull()).select(*by, frame, F.col(time).alias("t"), F.col(gap).cast("double").alias("gap")), by, "t", value, "null", "sensor")
    d = d.where(F.col("sensor").isNotNull()).withColumn("_n", F.count("*").over(W.partitionBy(*by))).where(F.col("_n") >= least).drop("_n").withColumn("used", F.lit(True))
    w = W.partitionBy(*by)
    for last in [False] * rounds + [True]:
        y, x = F.when(F.col("used"), F.col("gap")), F.when(F.col("used"), F.col("sensor"))
        d = d.withColumns({"_a": F.coalesce(F.regr_slope(y, x).over(w), F.lit(0.0)), "_b": F.coalesce(F.regr_intercept(y, x).over(w), F.avg(y).over(w))})
        d = d.withColumn("residual", F.col("gap") - F.col("_a") * F.col("sensor") - F.col("_b"))
        d = d.withColumn("_s", F.stddev_pop(F.when(F.col("used"), F.col("residual"))).over(w))
        if not last:
            d = d.withColumn("used", F.abs("residual") <= F.greatest(sigmas * F.col("_s"), F.lit(1e-9)))
    tolerance = F.greatest(F.lit(floor), sigmas * F.col("_s"))
    return d.select(*by, frame, "t", "gap", "sensor", (F.col("_a") * F.col("sensor") + F.col("_b")).alias("predicted"), "residual", "used", (F.abs("residual") <= tolerance).alias("in_sync"), (F.abs("residual") > 3 * tolerance).alias("anomaly"))


def gap_report(calibrated: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, n_frames, n_used, px_per_mm, r, residual_std, in_sync share, n_anomalies, score (0-100) of each camera."""
    used = F.col("used")
    s = calibrated.groupBy(*by).agg(F.count("*").alias("n_frames"), F.count_if("used").alias("n_used"), F.abs(F.regr_slope(F.when(used, F.col("gap")), F.when(used, F.col("sensor")))).alias("px_per_mm"), pearson(F.when(used, F.col("gap")), F.when(used, F.col("sensor"))).alias("r"), F.stddev_pop(F.when(used, F.col("residual"))).alias("residual_std"), F.avg(F.col("in_sync").cast("double")).alias("in_sync"), F.count_if("anomaly").alias("n_anomalies"))
    r = F.abs(F.coalesce(F.when(~F.isnan("r"), F.col("r")), F.lit(0.0)))
    return s.withColumn("score", 100 * (0.6 * clamp((r - 0.3) / 0.7) + 0.4 * F.col("in_sync")))
