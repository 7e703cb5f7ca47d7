"""Lag search between two streams: lags as frames of one window by key, coarse to fine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .grid import grid, interpolate
from .stats import pearson


def lag_scores(a: DataFrame, b: DataFrame, by: Sequence[str], x: str, y: str, max_lag: int, step: int = 1, scorer: str = "norm", index: str = "i") -> DataFrame:
    """(by, lag, score, n): y shifted by ``lag`` samples against x, both on one grid (``index``).

    scorer norm: sum of products over the norms of the whole signals; pearson: correlation of each overlap. A key has one row
    of each signal at an index. Both meet in one window by key, where each lag is a frame of one index: rows are not copied
    for the lags, so the shuffle does not grow with them. The lags are columns until the end, so scan coarsely first.
    """
    by = list(by)
    lags = range(-max_lag, max_lag + 1, step)
    if a is b:
        both = a.select(*by, F.col(index).cast("long").alias("_i"), F.col(x).alias("_x"), F.col(y).alias("_y"), F.lit(1).alias("_a"), F.lit(1).alias("_b"))
    else:
        both = a.select(*by, F.col(index).cast("long").alias("_i"), F.col(x).alias("_x"), F.lit(1).alias("_a")).unionByName(b.select(*by, F.col(index).cast("long").alias("_i"), F.col(y).alias("_y"), F.lit(1).alias("_b")), allowMissingColumns=True)
    near = W.partitionBy(*by).orderBy("_i")
    at = lambda c, k: F.max(c).over(near.rangeBetween(k, k))
    d = both.select(*by, "_a", "_x", "_y", *[f(c, k).alias(f"{c}{j}") for j, k in enumerate(lags) for f, c in ((at, "_y"), (at, "_b"))])
    cells = []
    for j, k in enumerate(lags):
        pair = F.col("_a").isNotNull() & F.col(f"_b{j}").isNotNull()
        u, v = F.when(pair, F.col("_x")), F.when(pair, F.col(f"_y{j}"))
        n = F.count_if(pair)
        if scorer == "pearson":
            flat = (F.stddev_pop(u) < 1e-8) | (F.stddev_pop(v) < 1e-8) | (n < 3)
            score = F.when(flat, 0.0).otherwise(pearson(u, v))
        else:
            score = F.sum(u * v)
        cells.append(F.struct(F.lit(k).alias("lag"), score.alias("_s"), n.alias("n")))
    norms = [] if scorer == "pearson" else [F.sum(F.col("_x") * F.col("_x")).alias("_nx"), F.sum(F.col("_y") * F.col("_y")).alias("_ny")]
    s = d.groupBy(*by).agg(*[c.alias(f"_c{j}") for j, c in enumerate(cells)], *norms)
    s = s.select(*by, *[n for n in ("_nx", "_ny") if norms], F.explode(F.array(*[f"_c{j}" for j in range(len(cells))])).alias("_c"))
    s = s.select(*by, *[n for n in ("_nx", "_ny") if norms], "_c.*").where("n > 0")
    if scorer == "pearson":
        return s.select(*by, "lag", F.col("_s").alias("score"), "n")
    norm = F.sqrt(F.col("_nx") * F.col("_ny"))
    return s.select(*by, "lag", F.when(norm > 1e-12, F.col("_s") / F.nullif(norm, F.lit(0.0))).otherwise(0.0).alias("score"), "n")


def best_lag(scores: DataFrame, by: Sequence[str], absolute: bool = False) -> DataFrame:
    """Lag of the highest score (the smaller lag on a tie), the runner-up, the margin, the vertex of the parabola through
    the peak and its neighbours, and the peak's height over the spread of the other scores."""
    by = list(by)
    s = scores.withColumn("_k", F.abs("score") if absolute else F.col("score"))
    near = W.partitionBy(*by).orderBy("lag")
    s = s.withColumn("_p", F.lag("_k").over(near)).withColumn("_q", F.lead("_k").over(near)).withColumn("_step", F.lead("lag").over(near) - F.col("lag"))
    r = s.withColumn("_r", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("_k"), "lag")))
    top = r.groupBy(*by).agg(*[F.max(F.when(F.col("_r") == 1, F.col(c))).alias(n) for c, n in (("lag", "lag"), ("score", "score"), ("_k", "_k"), ("_p", "_p"), ("_q", "_q"), ("_step", "_step"))], F.max(F.when(F.col("_r") == 2, F.col("_k"))).alias("second"), F.stddev_pop(F.when(F.col("_r") > 1, F.col("_k"))).alias("_spread"))
    curve = F.col("_p") - 2 * F.col("_k") + F.col("_q")
    vertex = F.when(F.abs(curve) > 1e-12, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 0.5 * (F.col("_p") - F.col("_q")) / curve))).otherwise(0.0)
    return top.select(*by, "lag", "score", "second", (F.col("_k") - F.col("second")).alias("margin"), (F.col("lag") + F.coalesce(vertex, F.lit(0.0)) * F.coalesce("_step", F.lit(0))).alias("fine_lag"), (F.abs("score") / F.nullif(F.col("_spread"), F.lit(0.0))).alias("snr"))


def on_common_grid(a: DataFrame, b: DataFrame, by: Sequence[str], step: float, outside: str = "clamp", least: int = 0, time: str = "t", value: str = "value") -> DataFrame:
    """(by, i, t, x, y): both streams interpolated on the grid of their overlap; keys with fewer than ``least`` points go."""
    from .grid import overlap_bounds

    points = grid(overlap_bounds(a, b, by, time), by, "start", "end", step)
    if least:
        points = points.withColumn("_n", F.count("*").over(W.partitionBy(*by))).where(F.col("_n") >= least).drop("_n")
    x = interpolate(a, points, by, time, value, outside, "x")
    return interpolate(b, x, by, time, value, outside, "y")


def steps(low: float, high: float, step: float) -> Column:
    """array<double> low, low + step, ... up to high: the candidates of one search, a constant of the plan."""
    return F.array(*[F.lit(low + i * step) for i in range(int((high - low) / step + 1e-9) + 1)])


def coarse_to_fine(a: DataFrame, b: DataFrame, by: Sequence[str], step: float, max_lag: float, coarse: float, fine: float) -> DataFrame:
    """Offset of b against a by Pearson: a scan of the lag grid ``coarse``, then of ``fine`` around each key's best."""
    by = list(by)
    first = pearson_at(a, b, by, steps(-max_lag, max_lag, coarse), step)
    centre = best_lag(first, by).select(*by, F.col("lag").alias("_c"))
    around = steps(-coarse, coarse, fine)
    return best_lag(pearson_at(a, b, by, F.transform(around, lambda d: d + F.col("_c")), step, centre), by)


def pearson_at(a: DataFrame, b: DataFrame, by: Sequence[str], lags: Column, step: float, centre: DataFrame | None = None, time: str = "t", value: str = "value") -> DataFrame:
    """Pearson of a and b moved by each lag (ms), both interpolated on the grid of the overlap that this lag leaves.

    Rounded to 9 digits, so that lags of equal correlation tie instead of being ranked by rounding errors."""
    by = list(by)
    keys = b.select(*by).distinct() if centre is None else centre
    moves = keys.withColumn("lag", F.explode(lags)).select(*by, "lag")
    moved = b.join(moves, by).select(*by, "lag", (F.col(time) + F.col("lag")).alias(time), value)
    fixed = a.join(moves, by).select(*by, "lag", time, value)
    both = on_common_grid(fixed, moved, [*by, "lag"], step, time=time, value=value)
    flat = (F.stddev_pop("x") < 1e-8) | (F.stddev_pop("y") < 1e-8) | (F.count("*") < 3)
    return both.groupBy(*by, "lag").agg(F.when(flat, 0.0).otherwise(F.round(pearson("x", "y"), 9)).alias("score"), F.count("*").alias("n"))
