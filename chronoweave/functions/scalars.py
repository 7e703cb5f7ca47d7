"""Scalar column expressions; nothing here shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def number(c: Column | str) -> Column:
    """Text to double; what is no number, NaN or infinite becomes null."""
    return finite((F.col(c) if isinstance(c, str) else c).try_cast("double"))


def finite(x: Column) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def falling_score(x: Column, good: float, bad: float) -> Column:
    """1 up to ``good``, 0 from ``bad`` on, linear between."""
    return clamp((F.lit(bad) - x) / F.lit(bad - good))


def rising_score(x: Column, bad: float, good: float) -> Column:
    """0 up to ``bad``, 1 from ``good`` on, linear between."""
    return clamp((x - F.lit(bad)) / F.lit(good - bad))


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


#: Grade cut-offs and letters, fixed values.
GRADES = ((90.0, "A"), (75.0, "B"), (60.0, "C"), (45.0, "D"))


def grade(score: Column, cuts: Sequence[tuple[float, str]] = GRADES, lowest: str = "F", missing: str | None = None) -> Column:
    """Letter of a 0-100 score; ``missing`` for a null score."""
    out = F.when(score.isNull(), F.lit(missing))
    for low, letter in cuts:
        out = out.when(score >= low, F.lit(letter))
    return out.otherwise(F.lit(lowest))


def hms(seconds: Column) -> Column:
    """HH:MM:SS of a duration, rounded half to even."""
    s = F.bround(seconds, 0).cast("long")
    return F.format_string("%02d:%02d:%02d", (s / 3600).cast("long"), ((s % 3600) / 60).cast("long"), s % 60)


def epoch_unit(median: Column) -> Column:
    """Unit of a time column from its median magnitude."""
    return (
        F.when(median > 1e16, "ns").when(median > 1e13, "us").when(median > 1e10, "ms").when(median > 1e7, "s").when(median > 0.5, "rel_ms").otherwise("rel_s")
    )


def to_ms(t: Column, unit: Column) -> Column:
    return F.when(unit == "ns", t / 1e6).when(unit == "us", t / 1e3).when(unit.isin("s", "rel_s"), t * 1e3).otherwise(t)


def nominal_level(x: Column, levels: Sequence[float] = (2.0, 5.0, 10.0, 30.0)) -> Column:
    """The nearest of the levels; the smaller one on a tie."""
    return F.array_min(F.array(*[F.struct(F.abs(x - v).alias("d"), F.lit(float(v)).alias("level")) for v in levels]))["level"]


def norm(*xs: Column) -> Column:
    total = xs[0] * xs[0]
    for x in xs[1:]:
        total = total + x * x
    return F.sqrt(total)


def composite_vision_score(pearson: Column, ncc: Column, lag_ms: Column, confidence: Column, scale_ms: float = 150.0) -> Column:
    """0-100: correlation parts damped by an exponential lag penalty and by confidence."""
    part = 0.5 * clamp(F.abs(pearson)) + 0.5 * clamp(F.abs(ncc))
    return 100 * part * F.exp(-F.abs(lag_ms) / scale_ms) * (0.5 + 0.5 * clamp(confidence))
