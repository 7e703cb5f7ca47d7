"""Event-time windows; the same functions run on batch and streaming frames. The watermark is this engine's choice: late
rows beyond it are dropped in a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _late(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    return df.withWatermark(ts, delay) if delay and df.isStreaming else df


def gap_sessions(df: DataFrame, by: Sequence[str], ts: str, gap: str, aggs: Sequence[Column], delay: str | None = "10 minutes") -> DataFrame:
    """Segments that end after ``gap`` without a row: the event-time form of gap segmentation."""
    g = _late(df, ts, delay).groupBy(*by, F.session_window(ts, gap).alias("w")).agg(*aggs)
    return g.select(*by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), *[c for c in g.columns if c not in (*by, "w")])


def time_windows(df: DataFrame, by: Sequence[str], ts: str, size: str, slide: str | None, aggs: Sequence[Column], delay: str | None = "10 minutes") -> DataFrame:
    """Tumbling (no slide) or sliding windows."""
    win = F.window(ts, size, slide) if slide else F.window(ts, size)
    g = _late(df, ts, delay).groupBy(*by, win.alias("w")).agg(*aggs)
    return g.select(*by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), *[c for c in g.columns if c not in (*by, "w")])


def dedup_arrivals(df: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Each key once; a stream forgets keys older than the watermark."""
    return _late(df, ts, delay).dropDuplicatesWithinWatermark(list(keys)) if df.isStreaming else df.dropDuplicates(list(keys))
