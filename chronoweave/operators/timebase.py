"""Time units, first-row semantics, shifts and trims."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.scalars import epoch_unit, to_ms


def ordered(by: Sequence[str], time: str = "t", row: str | None = None) -> W:
    """Window in time order; ``row`` breaks ties by file order."""
    return W.partitionBy(*by).orderBy(time, *([row] if row else []))


def micros(ts: str) -> Column:
    """Epoch microseconds of a timestamp with or without a zone."""
    return F.unix_micros(F.col(ts).cast("timestamp"))


def relative_ms(df: DataFrame, by: Sequence[str], time: str, row: str, scale: float = 1.0, out: str = "t_ms_rel") -> DataFrame:
    """Time since the first valid value in row order; streams with fewer than two valid values give nulls."""
    w = W.partitionBy(*by).orderBy(row).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    first = F.first(time, ignorenulls=True).over(w)
    return df.withColumn(out, F.when(F.count(time).over(w) >= 2, (F.col(time) - first) * scale))


def stream_starts(df: DataFrame, by: Sequence[str], time: str, row: str) -> DataFrame:
    """First and last time of each stream in row order, and its smallest time."""
    valid = df.where(F.col(time).isNotNull())
    return valid.groupBy(*by).agg(F.min_by(time, row).alias("first_t"), F.max_by(time, row).alias("last_t"), F.min(time).alias("min_t"))


def session_zero(df: DataFrame, session: str, stream: str, time: str, row: str) -> DataFrame:
    """Smallest first time over all streams of a session."""
    return stream_starts(df, [session, stream], time, row).groupBy(session).agg(F.min("first_t").alias("t0"))


def detect_unit(df: DataFrame, by: Sequence[str], time: str) -> DataFrame:
    """Each stream's unit by the median magnitude, and its times in milliseconds."""
    units = df.groupBy(*by).agg(F.median(time).alias("_m")).select(*by, epoch_unit(F.col("_m")).alias("unit"))
    return df.join(units, list(by)).withColumn("t_ms", to_ms(F.col(time), F.col("unit")))


def shift(df: DataFrame, offsets: DataFrame, on: Sequence[str], time: str, shift_col: str = "shift_ms", per_ms: float = 1.0) -> DataFrame:
    """Adds each stream's shift in ms (0 without one); ``per_ms``: ticks of ``time`` in a millisecond."""
    move = F.coalesce(F.col(shift_col), F.lit(0.0)) * per_ms
    kind = df.schema[time].dataType
    return df.join(offsets, list(on), "left").withColumn(time, F.col(time) + (F.bround(move, 0).cast(kind) if kind.typeName() in ("long", "integer") else move)).drop(shift_col)


def trim_to_common_start(df: DataFrame, session: str, stream: str, time: str, row: str, least: float = 5.0) -> DataFrame:
    """Drops rows before the latest first time of the session's streams; unchanged if no stream loses ``least`` or more.

    Rows with a null time go if the session is trimmed."""
    starts = stream_starts(df, [session, stream], time, row).groupBy(session).agg(F.max("first_t").alias("_from"), (F.max("first_t") - F.min("first_t")).alias("_cut"))
    return df.join(starts, session, "left").where(F.col("_from").isNull() | (F.col("_cut") < least) | (F.col(time) >= F.col("_from"))).drop("_from", "_cut")


def trim_by_switch(df: DataFrame, by: Sequence[str], time: str, row: str, switch: Column, on: str = "ON", off: str = "OFF") -> DataFrame:
    """Keeps the closed window from the first ``on`` to the last ``off`` row in file order; no window, no rows."""
    marks = df.groupBy(*by).agg(F.min_by(F.when(switch == on, F.col(time)), F.when(switch == on, F.col(row))).alias("_a"), F.max_by(F.when(switch == off, F.col(time)), F.when(switch == off, F.col(row))).alias("_z"))
    return df.join(marks, list(by)).where(F.col(time).between(F.col("_a"), F.col("_z"))).drop("_a", "_z")


def renumber(df: DataFrame, by: Sequence[str], time: str, row: str | None = None, out: str = "index") -> DataFrame:
    return df.withColumn(out, F.row_number().over(ordered(by, time, row)) - 1)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def relabel(df: DataFrame, mapping: dict[str, str], prefix: str = "", suffixes: Sequence[str] = ()) -> DataFrame:
    """Swaps column families at once: ``{prefix}{old}_{suffix}`` becomes ``{prefix}{new}_{suffix}``."""
    names = {f"{prefix}{a}_{s}": f"{prefix}{b}_{s}" for a, b in mapping.items() for s in suffixes}
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])
