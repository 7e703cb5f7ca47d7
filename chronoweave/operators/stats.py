"""Stream statistics, robust statistics, fits and correlations; aggregates pre-combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.scalars import clamp
from .timebase import ordered


def stream_stats(df: DataFrame, by: Sequence[str], time: str, gap: float, row: str | None = None, per_second: float = 1000.0, bad_gaps: int = 5) -> DataFrame:
    """n, start, end, median and largest step, gaps, rate and a status for each stream."""
    x = df.where(F.col(time).isNotNull()).withColumn("_dt", F.col(time) - F.lag(time).over(ordered(by, time, row)))
    s = x.groupBy(*by).agg(F.count("*").alias("n"), F.min(time).alias("start"), F.max(time).alias("end"), F.median("_dt").alias("median_dt"), F.max("_dt").alias("max_gap"), F.count_if(F.col("_dt") > gap).alias("n_gaps"))
    rate = (F.col("n") - 1) * per_second / F.nullif(F.col("end") - F.col("start"), F.lit(0))
    status = F.when(F.col("n") < 2, "EMPTY").when(F.col("n_gaps") >= bad_gaps, "BAD").when(F.col("n_gaps") > 0, "WARN").otherwise("OK")
    return s.withColumn("rate_hz", rate).withColumn("status", status)


def median_mad(df: DataFrame, by: Sequence[str], value: str, floor: float = 0.0) -> DataFrame:
    """Exact median and median absolute deviation of each group (two passes); NaN and infinite values do not count."""
    x = df.where(F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(F.col(value)) != float("inf")))
    med = x.groupBy(*by).agg(F.median(value).alias("median"), F.count("*").alias("n"))
    dev = x.join(med, list(by)) if by else x.crossJoin(F.broadcast(med))  # without keys, med is one row
    return dev.groupBy(*by).agg(F.first("median").alias("median"), F.greatest(F.median(F.abs(F.col(value) - F.col("median"))), F.lit(floor)).alias("mad"), F.first("n").alias("n"))


def robust_zscore(df: DataFrame, by: Sequence[str], value: str, out: str = "z") -> DataFrame:
    """(x - median) / (1.4826 MAD); 0 where the group is flat."""
    mm = median_mad(df, by, value).drop("n")
    z = F.when(F.col("mad") > 1e-12, (F.col(value) - F.col("median")) / (1.4826 * F.col("mad"))).otherwise(0.0)
    return df.join(mm, list(by), "left").withColumn(out, z).drop("median", "mad")


def zscore(df: DataFrame, by: Sequence[str], value: str, out: str = "z", flat: float = 1e-8, eps: float = 0.0) -> DataFrame:
    """(x - mean) / (population std + eps), only centred if the std is under ``flat``; invalid values give 0."""
    ok = F.when(~F.isnan(value) & (F.abs(F.col(value)) != float("inf")), F.col(value))
    m = df.groupBy(*by).agg(F.avg(ok).alias("_m"), F.stddev_pop(ok).alias("_s"))
    z = F.when(F.col("_s") < flat, ok - F.col("_m")).otherwise((ok - F.col("_m")) / (F.col("_s") + eps))
    return df.join(m, list(by), "left").withColumn(out, F.coalesce(z, F.lit(0.0))).drop("_m", "_s")


def percentile_clip(df: DataFrame, by: Sequence[str], value: str, low: float | None = None, high: float = 0.99, out: str = "clipped") -> DataFrame:
    """Clips to +-percentile of the absolute value, or to the percentiles low and high if ``low`` is given."""
    if low is None:
        q = df.groupBy(*by).agg(F.percentile(F.abs(F.col(value)), high).alias("_hi")).withColumn("_lo", -F.col("_hi"))
    else:
        q = df.groupBy(*by).agg(F.percentile(value, low).alias("_lo"), F.percentile(value, high).alias("_hi"))
    return df.join(q, list(by), "left").withColumn(out, F.greatest("_lo", F.least("_hi", value))).drop("_lo", "_hi")


def percentile_scale(df: DataFrame, by: Sequence[str], value: str, low: float = 0.02, high: float = 0.98, out: str = "scaled") -> DataFrame:
    q = df.groupBy(*by).agg(F.percentile(value, low).alias("_lo"), F.percentile(value, high).alias("_hi"))
    width = F.col("_hi") - F.col("_lo")
    return df.join(q, list(by), "left").withColumn(out, F.when(width > 1e-12, clamp((F.col(value) - F.col("_lo")) / width)).otherwise(0.0)).drop("_lo", "_hi")


def clock_fit(df: DataFrame, by: Sequence[str], x: str, y: str, least: int = 10, sigmas: float | None = None) -> DataFrame:
    """slope, intercept, r2, drift in ppm of y over x; with ``sigmas``, rows further than that from the mean of y go first."""
    if sigmas is not None:
        w = W.partitionBy(*by)
        far = F.abs(F.col(y) - F.avg(y).over(w)) > sigmas * F.stddev_pop(y).over(w)
        df = df.withColumn("_far", far).where(~F.coalesce("_far", F.lit(False))).drop("_far")
    fit = df.groupBy(*by).agg(F.count_if(F.col(x).isNotNull() & F.col(y).isNotNull()).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))
    return fit.where(F.col("n") >= least).withColumn("drift_ppm", F.col("slope") * 1e6)


def residuals(df: DataFrame, by: Sequence[str], x: str, y: str, out: str = "residual") -> DataFrame:
    fit = df.groupBy(*by).agg(F.regr_slope(y, x).alias("_b"), F.regr_intercept(y, x).alias("_a"))
    return df.join(fit, list(by), "left").withColumn(out, F.col(y) - F.col("_b") * F.col(x) - F.col("_a")).drop("_a", "_b")


def pearson(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation as an aggregate over the rows that have both; null where a side is flat (``F.corr`` divides by 0 there)."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0))


def safe_corr(a: str, b: str, least: int = 3, flat: float = 1e-8) -> Column:
    """Pearson correlation as an aggregate; 0 for few rows or a flat side."""
    return F.when((F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()) < least) | (F.stddev_pop(a) < flat) | (F.stddev_pop(b) < flat), 0.0).otherwise(F.coalesce(pearson(a, b), F.lit(0.0)))


def cosine(a: str, b: str) -> Column:
    return F.sum(F.col(a) * F.col(b)) / F.nullif(F.sqrt(F.sum(F.col(a) * F.col(a)) * F.sum(F.col(b) * F.col(b))), F.lit(0.0))


def error_metrics(df: DataFrame, by: Sequence[str], a: str, b: str) -> DataFrame:
    e = F.col(a) - F.col(b)
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.max(F.abs(e)).alias("max_error"), pearson(a, b).alias("corr"))


def mutual_information(df: DataFrame, by: Sequence[str], a: str, b: str, bins: int = 20) -> DataFrame:
    """Normalised mutual information 2 I / (H(a) + H(b)) over a bins x bins histogram of each group's range."""
    by = list(by)
    r = df.groupBy(*by).agg(*[f(c).alias(f"_{n}_{c}") for c in (a, b) for n, f in (("lo", F.min), ("hi", F.max))])
    bin_of = lambda c: F.least(F.floor((F.col(c) - F.col(f"_lo_{c}")) * bins / F.nullif(F.col(f"_hi_{c}") - F.col(f"_lo_{c}"), F.lit(0.0))), F.lit(bins - 1))
    x = (df.join(r, by) if by else df.crossJoin(F.broadcast(r))).select(*by, F.coalesce(bin_of(a), F.lit(0)).alias("_a"), F.coalesce(bin_of(b), F.lit(0)).alias("_b"))
    cells = x.groupBy(*by, "_a", "_b").agg(F.count("*").alias("n"))
    # at most bins x bins cells a group
    w = W.partitionBy(*by)
    p = F.col("n") / F.sum("n").over(w)
    pa, pb = F.sum("n").over(W.partitionBy(*by, "_a")) / F.sum("n").over(w), F.sum("n").over(W.partitionBy(*by, "_b")) / F.sum("n").over(w)
    cells = cells.select(*by, p.alias("p"), pa.alias("pa"), pb.alias("pb"))
    mi = F.sum(F.col("p") * F.log(F.col("p") / (F.col("pa") * F.col("pb"))))
    h = -F.sum(F.col("p") * F.log("pa")) - F.sum(F.col("p") * F.log("pb"))
    return cells.groupBy(*by).agg(F.when(h > 1e-12, 2 * mi / h).otherwise(0.0).alias("nmi"))


def video_metrics(df: DataFrame, by: Sequence[str], index: str, t_ns: str, drop_ms: float = 83.3) -> DataFrame:
    """Frame clock: n, duration, step mean/std/min/max, drops, missing numbers and MAD jitter (x 1.4826), in ms."""
    by = list(by)
    x = df.withColumn("_dt", (F.col(t_ns) - F.lag(t_ns).over(W.partitionBy(*by).orderBy(index))) / 1e6)
    s = x.groupBy(*by).agg(F.count("*").alias("n"), ((F.max(t_ns) - F.min(t_ns)) / 1e9).alias("duration_s"), F.avg("_dt").alias("dt_mean"), F.stddev_pop("_dt").alias("dt_std"), F.min("_dt").alias("dt_min"), F.max("_dt").alias("dt_max"), F.count_if(F.col("_dt") > drop_ms).alias("n_drops"), (F.max(index) - F.min(index) + 1 - F.count("*")).alias("n_missing"))
    return s.join(median_mad(x, by, "_dt").select(*by, (1.4826 * F.col("mad")).alias("jitter")), by, "left")


def sensor_metrics(df: DataFrame, by: Sequence[str], t_ns: str, value: str, row: str, max_velocity: float) -> DataFrame:
    """Steps in file order (negative ones counted), speed of the value per second, its p99 and anomalies, and its range."""
    by = list(by)
    w, f = W.partitionBy(*by).orderBy(t_ns, row), W.partitionBy(*by).orderBy(row)
    x = df.withColumn("_dt", (F.col(t_ns) - F.lag(t_ns).over(w)) / 1e6).withColumn("_back", F.col(t_ns) < F.lag(t_ns).over(f))
    x = x.withColumn("_v", F.when(F.col("_dt") > 0, F.abs(F.col(value) - F.lag(value).over(w)) / (F.col("_dt") / 1e3)))
    return x.groupBy(*by).agg(F.count("*").alias("n"), F.avg("_dt").alias("dt_mean"), F.max("_dt").alias("dt_max"), F.count_if("_back").alias("n_back_steps"), F.max("_v").alias("v_max"), F.percentile("_v", 0.99).alias("v_p99"), F.count_if(F.col("_v") > max_velocity).alias("n_fast"), (F.max(value) - F.min(value)).alias("value_range"))


def majority(df: DataFrame, by: Sequence[str], vote: str, order: str) -> DataFrame:
    """Most frequent vote, first seen on a tie, with its count and share."""
    c = df.where(F.col(vote).isNotNull()).groupBy(*by, vote).agg(F.count("*").alias("_n"), F.min(order).alias("_o"))
    best = F.struct(-F.col("_n"), "_o")
    return c.groupBy(*by).agg(F.min_by(vote, best).alias("winner"), F.max("_n").alias("votes"), (F.max("_n") / F.sum("_n")).alias("share"))


def totals(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], label: str = "TOTAL") -> DataFrame:
    """Groups with subtotals and a grand total, labelled."""
    out = df.rollup(*keys).agg(*aggs, *[F.grouping(k).alias(f"_g_{k}") for k in keys])
    return out.select(*[F.when(F.col(f"_g_{k}") == 1, label).otherwise(F.col(k)).alias(k) for k in keys], *[c for c in out.columns if c not in keys and not c.startswith("_g_")])


def rebalance(df: DataFrame, label: str, ratio: int = 3, most: int = 120_000, seed: int = 42) -> DataFrame:
    """At most ``ratio`` negatives (label 0) for each positive and ``most`` rows, those of least seeded hash; the thresholds are
    selected by counts, so nothing is ordered as a whole. Rows equal in all columns stay or go together.

    A feature of training-set preparation: the cap is what it is for."""
    from .selection import least_hashes

    positives = df.where(F.col(label) == 1)
    negatives = least_hashes(df.where(F.col(label) == 0), ratio * positives.count(), seed)
    return least_hashes(positives.unionByName(negatives), most, seed)
