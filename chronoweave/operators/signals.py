"""Composite signal operators: plateaus, crossings, activity votes, feature fusion, model windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .asof import asof_join
from .grid import interpolate
from .islands import flag_runs
from .lag import lag_scores, on_common_grid
from .smooth import gradient, gradient_over, sliding_windows, window
from .stats import pearson, safe_corr


def plateaus(df: DataFrame, by: Sequence[str], time: str, value: str, most_speed: float, least: float) -> DataFrame:
    """Runs of at least ``least`` in which the value moves slower than ``most_speed``, with level, spread and drift."""
    by = list(by)
    d = df.withColumn("_v", gradient_over(value, time, window(by, time)))
    runs = flag_runs(d, by, time, F.abs("_v") < most_speed, least=least).withColumnRenamed("n_rows", "n")
    inside = d.join(runs.select(*by, "start", "end"), by).where(F.col(time).between(F.col("start"), F.col("end")))
    return inside.groupBy(*by, "start", "end").agg(F.count("*").alias("n"), F.avg(value).alias("level"), F.stddev_pop(value).alias("jitter"), (F.max_by(value, time) - F.min_by(value, time)).alias("drift"))


def crossing(df: DataFrame, by: Sequence[str], time: str, value: str, level: Column, rising: bool = False) -> DataFrame:
    """First time the value crosses ``level``, linear between samples; without a crossing, the time of its extreme."""
    by = list(by)
    w = window(by, time)
    d = df.withColumn("_l", level).withColumn("_v2", F.lead(value).over(w)).withColumn("_t2", F.lead(time).over(w))
    a, b = (F.col(value), F.col("_v2")) if rising else (F.col("_v2"), F.col(value))
    hit = (a <= F.col("_l")) & (b >= F.col("_l")) & (F.col(value) != F.col("_v2"))
    at = F.col(time) + (F.col("_l") - F.col(value)) / F.nullif(F.col("_v2") - F.col(value), F.lit(0.0)) * (F.col("_t2") - F.col(time))
    extreme = F.max_by(time, F.struct(value, -F.col(time))) if rising else F.min_by(time, F.struct(F.col(value), F.col(time)))
    return d.groupBy(*by).agg(F.min(F.when(hit, at)).alias("_at"), extreme.alias("_ext")).select(*by, F.coalesce("_at", F.col("_ext").cast("double")).alias("t"), F.col("_at").isNotNull().alias("crossed"))


def closure_residuals(video: DataFrame, sensor: DataFrame, windows: DataFrame, by: Sequence[str], time: str = "t", value: str = "value") -> DataFrame:
    """For each closing window (by, event, start, end): both signals' half-way crossing times and their difference."""
    by = list(by)
    keys = [*by, "event"]

    def half(df: DataFrame) -> DataFrame:
        own = df.join(windows.select(*keys, "start", "end"), by).where(F.col(time).between(F.col("start"), F.col("end")))
        mid = own.groupBy(*keys).agg(((F.max(value) + F.min(value)) / 2).alias("_mid"))
        return crossing(own.join(mid, keys), keys, time, value, F.col("_mid"))

    v, s = half(video), half(sensor)
    return v.select(*keys, F.col("t").alias("t_video")).join(s.select(*keys, F.col("t").alias("t_sensor")), keys).withColumn("residual", F.col("t_video") - F.col("t_sensor"))


def asymmetric_moments(left: DataFrame, right: DataFrame, by: Sequence[str], step: float, closed: float = 6.0, opened: float = 14.0) -> DataFrame:
    """Grid points where one gripper is closed while the other is open; greedy choice is ``events.greedy_topk`` on ``gap``."""
    both = on_common_grid(left, right, by, step)
    which = F.when((F.col("x") <= closed) & (F.col("y") >= opened), "left_closed").when((F.col("y") <= closed) & (F.col("x") >= opened), "right_closed")
    return both.withColumn("state", which).where("state is not null").withColumn("gap", F.abs(F.col("x") - F.col("y")))


def activity_votes(camera: DataFrame, a: DataFrame, b: DataFrame, by: Sequence[str], ratio: float = 2.0, time: str = "t", value: str = "value") -> DataFrame:
    """Mean camera activity while hand a moves ``ratio`` times as fast as b, and the other way round; the larger one votes."""
    by = list(by)
    x = interpolate(a, camera, by, time, value, out="_a")
    x = interpolate(b, x, by, time, value, out="_b")
    m = x.groupBy(*by).agg(F.avg(F.when(F.col("_a") > ratio * F.col("_b"), F.col(value))).alias("with_a"), F.avg(F.when(F.col("_b") > ratio * F.col("_a"), F.col(value))).alias("with_b"), F.count_if(F.col("_a") > ratio * F.col("_b")).alias("n_a"), F.count_if(F.col("_b") > ratio * F.col("_a")).alias("n_b"))
    known = F.least("n_a", "n_b") > 0
    return m.withColumn("vote", F.when(known & (F.col("with_a") > F.col("with_b")), "a").when(known & (F.col("with_b") > F.col("with_a")), "b"))


def assign_two(scores: DataFrame, session: str, camera: str, side: str, score: str) -> DataFrame:
    """Two cameras to two sides by the larger diagonal of the 2 x 2 score table; ``swap`` when the crossed one wins."""
    s = scores.groupBy(session).agg(*[F.max(F.when((F.col(camera) == c) & (F.col(side) == d), F.col(score))).alias(f"_{c}_{d}") for c in ("left", "right") for d in ("left", "right")])
    straight, crossed = F.col("_left_left") + F.col("_right_right"), F.col("_left_right") + F.col("_right_left")
    return s.select(session, straight.alias("straight"), crossed.alias("crossed"), (crossed > straight).alias("swap"), F.abs(straight - crossed).alias("margin"))


def rolling_correlation(df: DataFrame, by: Sequence[str], order: str, x: str, y: str, size: int, stride: int, active: float) -> DataFrame:
    """Pearson of each sliding window whose x moves by a spread of ``active`` or more; summary of each key."""
    by = list(by)
    w = sliding_windows(df, by, order, size, stride).groupBy(*by, "window_id").agg(safe_corr(x, y).alias("r"), F.stddev_pop(x).alias("_s")).where(F.col("_s") >= active)
    return w.groupBy(*by).agg(F.count("*").alias("n_windows"), F.median("r").alias("median_r"), F.min("r").alias("min_r"))


def best_combination(signals: DataFrame, targets: DataFrame, by: Sequence[str], max_lag: int, index: str = "i", value: str = "value") -> DataFrame:
    """The signal, target and lag of the largest absolute Pearson. ``signals``: by, signal, i, value; ``targets``: by, target, i, value."""
    by = list(by)
    names = signals.select(*by, "signal").distinct().join(targets.select(*by, "target").distinct(), by)
    a, b = signals.join(names, [*by, "signal"]), targets.join(names, [*by, "target"])
    s = lag_scores(a, b, [*by, "signal", "target"], value, value, max_lag, scorer="pearson", index=index)
    order = F.struct(-F.abs("score"), "signal", "target", "lag")
    return s.groupBy(*by).agg(F.min_by(F.struct("signal", "target", "lag", "score", "n"), order).alias("b")).select(*by, "b.*")


def adaptive_weights(features: DataFrame, by: Sequence[str], feature: str, value: str, base: dict[str, float]) -> DataFrame:
    """Base weight x variance / coefficient of variation of each feature, scaled to sum 1 over the key's features."""
    by = list(by)
    w = F.create_map(*[F.lit(x) for kv in base.items() for x in kv])
    s = features.groupBy(*by, feature).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    raw = F.coalesce(w[F.col(feature)], F.lit(0.0)) * F.col("_s") * F.abs("_m")
    s = s.withColumn("_w", F.when(F.col("_s") > 1e-9, raw).otherwise(0.0))
    total = F.sum("_w").over(W.partitionBy(*by))
    return s.select(*by, feature, F.when(total > 0, F.col("_w") / total).otherwise(1.0 / F.count("*").over(W.partitionBy(*by))).alias("weight"))


def fuse(features: DataFrame, weights: DataFrame, by: Sequence[str], at: str, feature: str, value: str) -> DataFrame:
    """Weighted sum of the features at each point."""
    return features.join(weights, [*by, feature]).groupBy(*by, at).agg(F.sum(F.col("weight") * F.col(value)).alias(value))


def agreeing_top(scores: DataFrame, by: Sequence[str], feature: str, lag: str, score: str, tolerance: float, k: int = 8) -> DataFrame:
    """Among each key's ``k`` best features, the pair whose lags agree within the tolerance and whose scores sum highest."""
    by = list(by)
    top = scores.withColumn("_r", F.row_number().over(W.partitionBy(*by).orderBy(F.desc(score), feature))).where(F.col("_r") <= k)
    a = top.select(*by, F.col(feature).alias("first"), F.col(lag).alias("_la"), F.col(score).alias("_sa"), F.col("_r").alias("_ra"))
    b = top.select(*by, F.col(feature).alias("second"), F.col(lag).alias("_lb"), F.col(score).alias("_sb"), F.col("_r").alias("_rb"))
    pairs = a.join(b, by).where((F.col("_ra") < F.col("_rb")) & (F.abs(F.col("_la") - F.col("_lb")) <= tolerance))
    best = F.struct(-(F.col("_sa") + F.col("_sb")), "_ra", "_rb")
    return pairs.groupBy(*by).agg(F.min_by(F.struct("first", "second", ((F.col("_la") + F.col("_lb")) / 2).alias("lag"), (F.col("_sa") + F.col("_sb")).alias("total")), best).alias("p")).select(*by, "p.*")


def calibrate(samples: DataFrame, params: DataFrame, by: Sequence[str], predict: Column, truth: str) -> DataFrame:
    """The parameter row (few, broadcast) whose prediction correlates best with the truth; ties: the smaller param_id."""
    x = samples.crossJoin(F.broadcast(params)).withColumn("_p", predict)  # a literal grid of parameters
    s = x.groupBy(*by, "param_id").agg(F.coalesce(pearson("_p", truth), F.lit(0.0)).alias("r"))
    return s.groupBy(*by).agg(F.min_by(F.struct("param_id", "r"), F.struct(-F.col("r"), "param_id")).alias("b")).select(*by, "b.*")


def model_windows(df: DataFrame, by: Sequence[str], order: str, value: str, size: int, stride: int) -> DataFrame:
    """Three channels of each window for a model: z-scored value, its gradient, its energy, each array<float>."""
    by = list(by)
    w = sliding_windows(df, by, order, size, stride)
    key = W.partitionBy(*by, "window_id")
    z = F.when(F.stddev_pop(value).over(key) < 1e-8, F.col(value) - F.avg(value).over(key)).otherwise((F.col(value) - F.avg(value).over(key)) / F.stddev_pop(value).over(key))
    d = w.withColumn("_z", z)
    d = d.withColumn("_g", gradient("_z", W.partitionBy(*by, "window_id").orderBy("pos")))
    row = F.struct("pos", F.col("_z").cast("float").alias("z"), F.col("_g").cast("float").alias("g"))
    out = d.groupBy(*by, "window_id").agg(F.sort_array(F.collect_list(row)).alias("r"))
    return out.select(*by, "window_id", F.col("r.z").alias("value"), F.col("r.g").alias("gradient"), F.transform("r.z", lambda v: v * v).alias("energy"))


def score_windows(windows: DataFrame, by: Sequence[str], model, a: str = "a", b: str = "b") -> DataFrame:
    """Scores of window pairs by a model in Arrow batches; ``model(a, b)`` takes two lists of arrays and gives floats."""
    import pandas as pd

    @F.pandas_udf("double")
    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(model(list(x), list(y)))

    return windows.select(*by, "window_id", score(F.col(a), F.col(b)).alias("score"))


def placement(rows: DataFrame, session: str, block: str, pos: str = "pos", least_height: float = 0.30, least_side: float = 0.05) -> DataFrame:
    """Whether the tracker called head is the highest (by a share of the range) and right is right of left, by medians."""
    m = rows.groupBy(session, block).agg(F.median(F.col(pos)[2]).alias("_z"), F.median(F.col(pos)[0]).alias("_x"))
    p = m.groupBy(session).agg(*[F.max(F.when(F.col(block) == b, F.col(c))).alias(f"_{b}{c}") for b in ("head", "left", "right") for c in ("_z", "_x")], F.max("_z").alias("_top"), F.min("_z").alias("_low"))
    below = (F.col("_top") - F.col("_head_z")) / F.nullif(F.col("_top") - F.col("_low"), F.lit(0.0))
    return p.select(session, (F.coalesce(below, F.lit(0.0)) > least_height).alias("head_not_highest"), (F.col("_left_x") - F.col("_right_x") > least_side).alias("sides_crossed"))


def interval_signal(df: DataFrame, by: Sequence[str], time: str, size: int = 5, out: str = "value") -> DataFrame:
    """Frame-interval signal of a camera: deviation of each step from the median step, smoothed."""
    by = list(by)
    w = window(by, time)
    d = df.withColumn("_dt", F.col(time) - F.lag(time).over(w))
    d = d.join(d.groupBy(*by).agg(F.median("_dt").alias("_m")), by)
    return d.withColumn("_d", F.coalesce(F.col("_dt") - F.col("_m"), F.lit(0.0))).withColumn(out, F.avg("_d").over(w.rowsBetween(-(size // 2), size // 2))).drop("_dt", "_m", "_d")


def closed_state_offset(sensor: DataFrame, video: DataFrame, by: Sequence[str], step: float, max_lag: int, low: float = 0.2) -> DataFrame:
    """Lag scores of both signals' closed states (under the ``low`` percentile point of their range) on a grid."""
    by = list(by)
    both = on_common_grid(sensor, video, by, step)
    q = both.groupBy(*by).agg(*[F.percentile(c, p).alias(f"_{c}{n}") for c in ("x", "y") for p, n in ((0.05, "a"), (0.95, "z"))])
    d = both.join(q, by)
    for c in ("x", "y"):
        d = d.withColumn(c, F.when(F.col(c) <= F.col(f"_{c}a") + low * (F.col(f"_{c}z") - F.col(f"_{c}a")), 1.0).otherwise(0.0))
    return lag_scores(d, d, by, "x", "y", max_lag, scorer="pearson")


def sample_at(df: DataFrame, points: DataFrame, by: Sequence[str], time: str, values: Sequence[str], tolerance: float | None = None) -> DataFrame:
    """Nearest sample at each point, the later one on a tie - frame numbers for timestamps, replay at a fixed rate."""
    return asof_join(points, df, by, time, time, values, "nearest", "later", tolerance)
