"""Gaps, segments and flag runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .timebase import ordered


def gaps(df: DataFrame, by: Sequence[str], time: str, threshold: float, row: str | None = None) -> DataFrame:
    """One row for each step longer than ``threshold``: start, end, gap."""
    nxt = df.where(F.col(time).isNotNull()).withColumn("_n", F.lead(time).over(ordered(by, time, row)))
    return nxt.where(F.col("_n") - F.col(time) > threshold).select(*by, F.col(time).alias("gap_start"), F.col("_n").alias("gap_end"), (F.col("_n") - F.col(time)).alias("gap"))


def with_segments(df: DataFrame, by: Sequence[str], order: Sequence[str], time: str, threshold: float, out: str = "segment") -> DataFrame:
    """Segment number, one more after each step longer than ``threshold``, in the given order."""
    w = W.partitionBy(*by).orderBy(*order)
    new = F.when(F.col(time) - F.lag(time).over(w) > threshold, 1).otherwise(0)
    return df.withColumn("_new", new).withColumn(out, F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def segments(df: DataFrame, by: Sequence[str], order: Sequence[str], time: str, threshold: float) -> DataFrame:
    s = with_segments(df, by, order, time, threshold)
    return s.groupBy(*by, "segment").agg(F.count("*").alias("n_rows"), F.min(time).alias("start"), F.max(time).alias("end")).withColumn("duration", F.col("end") - F.col("start"))


def best_segment(segs: DataFrame, by: Sequence[str], window: DataFrame | None = None, least_duration: float = 0.0, least_coverage: float = 0.0) -> DataFrame:
    """The segment of each key that covers most of ``window`` (by, w0, w1), else the longest; ties: the earliest."""
    if window is not None:
        cover = F.greatest(F.lit(0.0), F.least("end", "w1") - F.greatest("start", "w0")) / F.nullif(F.col("w1") - F.col("w0"), F.lit(0))
        segs = segs.join(window, list(by)).withColumn("coverage", F.coalesce(cover, F.lit(0.0))).drop("w0", "w1").where(F.col("coverage") >= least_coverage)
        best = F.struct(-F.col("coverage"), "segment")
    else:
        best = F.struct(-F.col("duration"), "segment")
    segs = segs.where(F.col("duration") >= least_duration)
    row = F.struct(*[c for c in segs.columns if c not in by])
    return segs.groupBy(*by).agg(F.min_by(row, best).alias("_s")).select(*by, "_s.*")


def flag_runs(df: DataFrame, by: Sequence[str], time: str, flag: Column, row: str | None = None, reasons: dict[str, Column] | None = None, least: float = 0.0) -> DataFrame:
    """Intervals of consecutive flagged rows of at least ``least``, with which reasons occurred in them."""
    w = ordered(by, time, row)
    x = df.withColumn("_f", F.coalesce(flag, F.lit(False)))
    for name, c in (reasons or {}).items():
        x = x.withColumn(f"_r_{name}", F.coalesce(c, F.lit(False)))
    x = x.withColumn("_i", F.row_number().over(w))
    x = x.where("_f").withColumn("_island", F.col("_i") - F.row_number().over(w))
    out = x.groupBy(*by, "_island").agg(F.min(time).alias("start"), F.max(time).alias("end"), F.count("*").alias("n_rows"), *[F.bool_or(f"_r_{n}").alias(n) for n in reasons or {}])
    return out.where(F.col("end") - F.col("start") >= least).drop("_island")


def missing_numbers(df: DataFrame, by: Sequence[str], index: str) -> DataFrame:
    """How many numbers between the smallest and largest are absent."""
    return df.groupBy(*by).agg((F.max(index) - F.min(index) + 1 - F.count_distinct(index)).alias("n_missing"))


def missing_list(df: DataFrame, by: Sequence[str], index: str) -> DataFrame:
    """The absent numbers themselves, from the steps over one."""
    step = df.select(*by, index).distinct().withColumn("_n", F.lead(index).over(W.partitionBy(*by).orderBy(index)))
    return step.where(F.col("_n") - F.col(index) > 1).select(*by, F.explode(F.sequence(F.col(index) + 1, F.col("_n") - 1)).alias(index))


def static_gap_fill(df: DataFrame, by: Sequence[str], time: str, value: str, factor: float = 4.0, most: float = 1500.0, most_change: float = 2.0, nominal: float | None = None) -> DataFrame:
    """Rows of df plus linear rows in gaps longer than ``factor`` x the step, at most ``most``, whose ends differ by at most
    ``most_change``. The step is ``nominal`` or each stream's median. Column ``synthetic`` tells them apart."""
    by = list(by)
    w = W.partitionBy(*by).orderBy(time)
    x = df.select(*by, time, value).withColumn("_t", F.lead(time).over(w)).withColumn("_v", F.lead(value).over(w))
    if nominal is None:
        x = x.join(x.groupBy(*by).agg(F.median(F.col("_t") - F.col(time)).alias("_dt")), by)
    else:
        x = x.withColumn("_dt", F.lit(float(nominal)))
    gap = F.col("_t") - F.col(time)
    wide = x.where((gap > factor * F.col("_dt")) & (gap <= most) & (F.abs(F.col("_v") - F.col(value)) <= most_change))
    n = F.greatest(F.round(gap / F.col("_dt")).cast("long") - 1, F.lit(0))
    wide = wide.withColumn("_n", n).where("_n > 0").withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    share = F.col("_k") / (F.col("_n") + 1)
    made = wide.select(*by, (F.col(time) + share * gap).cast(df.schema[time].dataType).alias(time), (F.col(value) + share * (F.col("_v") - F.col(value))).alias(value), F.lit(True).alias("synthetic"))
    return df.withColumn("synthetic", F.lit(False)).unionByName(made, allowMissingColumns=True)


def extend_backward(df: DataFrame, by: Sequence[str], time: str, value: str, starts: DataFrame, start: str, step: float, most: float) -> DataFrame:
    """Rows of df plus copies of each stream's first value at start, start + step, ... before its first time, if that is at
    most ``most`` later."""
    by = list(by)
    first = df.groupBy(*by).agg(F.min(time).alias("_t0"), F.min_by(value, time).alias("_v0")).join(starts, by)
    room = F.col("_t0") - F.col(start)
    made = first.where((room > 0) & (room <= most)).withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), (F.ceil(room / step) - 1).cast("long"))))
    made = made.select(*by, (F.col(start) + F.col("_k") * F.lit(step)).cast(df.schema[time].dataType).alias(time), F.col("_v0").alias(value), F.lit(True).alias("synthetic"))
    base = df if "synthetic" in df.columns else df.withColumn("synthetic", F.lit(False))
    return base.unionByName(made, allowMissingColumns=True)
