"""Common grids and interpolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def grid(bounds: DataFrame, by: Sequence[str], start: str, end: str, step: float) -> DataFrame:
    """Points start, start + step, ... not after end; a null or reversed range gives none."""
    n = F.floor((F.col(end) - F.col(start)) / step)
    points = bounds.where(n >= 0).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long"))))
    return points.select(*by, "i", (F.col(start) + F.col("i") * F.lit(step)).alias("t"))


def overlap_bounds(a: DataFrame, b: DataFrame, by: Sequence[str], time: str = "t") -> DataFrame:
    """Common range of two streams of each key."""
    lo = lambda d, s: d.groupBy(*by).agg(F.min(time).alias(f"{s}0"), F.max(time).alias(f"{s}1"))
    both = lo(a, "a").join(lo(b, "b"), list(by))
    return both.select(*by, F.greatest("a0", "b0").alias("start"), F.least("a1", "b1").alias("end"))


def interpolate(samples: DataFrame, points: DataFrame, by: Sequence[str], time: str = "t", value: str = "value", outside: str = "clamp", out: str | None = None) -> DataFrame:
    """``points`` with the linear interpolation of ``samples``; ``outside`` the samples' range: clamp, zero or null.

    Samples of equal time count as their mean; null times or values are ignored. One union and one shuffle by key.
    """
    by, out = list(by), out or value
    s = samples.where(F.col(time).isNotNull() & F.col(value).isNotNull()).groupBy(*by, F.col(time).alias("_at")).agg(F.avg(value).alias("_v")).withColumn("_s", F.struct(F.col("_at").cast("double").alias("t"), F.col("_v").alias("v"))).drop("_v")
    p = points.select(*by, F.struct(*points.columns).alias("_l"), F.col(time).alias("_at")).withColumn("_is", F.lit(1))
    both = p.unionByName(s.withColumn("_is", F.lit(0)), allowMissingColumns=True)
    w = W.partitionBy(*by).orderBy("_at", "_is")
    # the next sample is the last one of the reverse order: a frame to the end of the key would be read anew for every row
    back = W.partitionBy(*by).orderBy(F.desc("_at"), F.desc("_is"))
    both = both.withColumn("_a", F.last("_s", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("_b", F.last("_s", ignorenulls=True).over(back.rowsBetween(W.unboundedPreceding, 0)))
    a, b, t = F.col("_a"), F.col("_b"), F.col("_at").cast("double")
    edge = {"clamp": F.coalesce(a["v"], b["v"]), "zero": F.lit(0.0), "null": F.lit(None).cast("double")}[outside]
    v = F.when(a["t"] == t, a["v"]).when(a.isNull() | b.isNull(), edge).otherwise(a["v"] + (b["v"] - a["v"]) * (t - a["t"]) / (b["t"] - a["t"]))
    return both.where("_is = 1").select(*[F.col(f"_l.{c}").alias(c) for c in points.columns], v.alias(out))


def lerp(a: Column, b: Column, share: Column) -> Column:
    return a + (b - a) * share
