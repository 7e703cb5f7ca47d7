"""As-of joins as one union, one shuffle by key and running last/first values: linear in both sides, no Cartesian product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, values: Sequence[str], direction: str = "nearest", tie: str = "earlier", tolerance: float | None = None, prefix: str = "", match_time: str | None = None) -> DataFrame:
    """Left rows with ``values`` of the matching right row (null without one).

    ``direction``: backward (latest at or before), forward (earliest at or after), nearest; ``tie`` earlier or later settles
    equal distances; ``tolerance`` is the largest distance allowed. Among right rows of one time the one of the largest
    values matches. Left rows keep their number; null times match nothing.
    """
    by = list(by)
    side = F.struct(F.col(right_on).alias("_t"), *[F.col(v).alias(v) for v in values])
    r = right.where(F.col(right_on).isNotNull()).select(*by, F.col(right_on).alias("_at"), side.alias("_r")).groupBy(*by, "_at").agg(F.max("_r").alias("_r"))
    rows = left.select(*by, F.struct(*left.columns).alias("_l"), F.col(left_on).alias("_at")).withColumn("_is", F.lit(1))
    both = rows.unionByName(r.withColumn("_is", F.lit(0)), allowMissingColumns=True)
    w = W.partitionBy(*by).orderBy("_at", "_is")
    back = F.last("_r", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    ahead = F.first("_r", ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))
    both = both.withColumn("_b", back)
    if direction != "backward":
        both = both.withColumn("_f", ahead)
    at = both.where("_is = 1")
    db, here = F.col("_at") - F.col("_b._t"), F.col("_b._t") == F.col("_at")
    if direction == "backward":
        pick = F.col("_b")
    elif direction == "forward":
        pick = F.when(here, F.col("_b")).otherwise(F.col("_f"))
    else:
        df = F.col("_f._t") - F.col("_at")
        later = (df < db) if tie == "earlier" else (df <= db)
        pick = F.when(F.col("_b").isNull(), F.col("_f")).when(F.col("_f").isNull() | here, F.col("_b")).when(later, F.col("_f")).otherwise(F.col("_b"))
    if tolerance is not None:
        pick = F.when(F.abs(F.col("_at") - pick["_t"]) <= tolerance, pick)
    at = at.withColumn("_m", F.when(F.col("_at").isNotNull(), pick))
    out = [F.col(f"_l.{c}").alias(c) for c in left.columns] + [F.col(f"_m.{v}").alias(prefix + v) for v in values]
    return at.select(*out, *([F.col("_m._t").alias(match_time)] if match_time else []))


def match_within(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, tolerance: float) -> DataFrame:
    """All pairs at most ``tolerance`` apart, as an equi-join on time buckets of that width (each left row looks in three)."""
    by = list(by)
    a = left.withColumn("_bucket", F.explode(F.sequence(F.floor((F.col(left_on) - tolerance) / tolerance), F.floor((F.col(left_on) + tolerance) / tolerance))))
    b = right.withColumn("_bucket", F.floor(F.col(right_on) / tolerance))
    return a.join(b, [*by, "_bucket"]).where(F.abs(F.col(left_on) - F.col(right_on)) <= tolerance).drop("_bucket")


def positional_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_order: str, right_order: str) -> DataFrame:
    """Rows of equal ordinal within a key."""
    n = lambda d, o: d.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(o)))
    return n(left, left_order).join(n(right, right_order), [*by, "_n"]).drop("_n")
