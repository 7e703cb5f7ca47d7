"""Frame tables and episode datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.errors import AnalysisException

from ..operators.asof import asof_join
from ..operators.selection import number_rows, running_sums
from ..sources.readers import numeric_columns


def prefixed(df: DataFrame, stem: str, keep: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c in keep else f"{stem}_{c}") for c in df.columns])


def frame_table(frames: DataFrame, sensors: dict[str, DataFrame], by: Sequence[str], time: str, tolerance: float = 500.0) -> DataFrame:
    """Camera frames with the nearest sample of every sensor within the tolerance: numeric columns that are not there yet,
    prefixed by the sensor's name."""
    out = frames
    for stem, df in sensors.items():
        values = [c for c in numeric_columns(df) if c not in (*by, time) and f"{stem}_{c}" not in out.columns]
        out = asof_join(out, df, by, time, time, values, "nearest", "earlier", tolerance, prefix=f"{stem}_")
    return out


def episode_rows(frames: DataFrame, episode: str, time: str, task: str | None = None, fill: float | None = 0.0, ties: Sequence[str] = ()) -> DataFrame:
    """frame_index, episode_index, global index and task_index of dataset rows; missing numbers become ``fill``;
    frames of one time are ordered by ``ties``.

    Episodes are numbered by name; their offsets are running sums of their lengths, by ranges."""
    w = W.partitionBy(episode).orderBy(time, *ties)
    lengths = frames.groupBy(episode, *([task] if task else [])).agg(F.count("*").alias("_len"))
    # numbers and offsets by ranges of names: no task sees all episodes
    numbered = number_rows(lengths, episode, "episode_index")
    episodes = numbered.join(running_sums(numbered, "episode_index", "_len", "_from"), "episode_index")
    tasks = number_rows(lengths.select(task).distinct(), task, "task_index") if task else None
    episodes = episodes.join(tasks, task) if task else episodes.withColumn("task_index", F.lit(0))
    d = frames.withColumn("frame_index", F.row_number().over(w) - 1).join(episodes.select(episode, "episode_index", "_from", "task_index"), episode)
    d = d.withColumn("index", F.col("_from") + F.col("frame_index")).withColumn("timestamp", F.col(time) - F.min(time).over(W.partitionBy(episode))).drop("_from")
    if fill is not None:
        d = d.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(fill)), F.lit(fill)) for c in numeric_columns(frames) if c not in (episode, time)})
    return d


def write_episodes(rows: DataFrame, root: str, per_chunk: int = 1000) -> None:
    """data/chunk_index=N/episode_index=M Parquet and meta/episodes; episodes that are there already are left alone."""
    spark = rows.sparkSession
    new = rows.join(_done(spark, root), "episode_index", "left_anti") if _done(spark, root) is not None else rows
    chunked = new.withColumn("chunk_index", (F.col("episode_index") / per_chunk).cast("int"))
    chunked.repartition("episode_index").sortWithinPartitions("episode_index", "frame_index").write.mode("append").partitionBy("chunk_index", "episode_index").parquet(f"{root}/data")
    meta = new.groupBy("episode_index", "task_index").agg(F.count("*").alias("length"), F.min("index").alias("dataset_from_index"), (F.max("index") + 1).alias("dataset_to_index"))
    meta.write.mode("append").parquet(f"{root}/meta/episodes")


def _done(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{root}/meta/episodes").select("episode_index")
    except AnalysisException:
        return None


def column_stats(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """min, max, mean, std of each column in long form: one pass."""
    one = rows.agg(*[F.struct(F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}.min").cast("double").alias("min"), F.col(f"{c}.max").cast("double").alias("max"), F.col(f"{c}.mean").alias("mean"), F.col(f"{c}.std").alias("std")) for c in columns])).alias("s")).select("s.*")


def timeline(parts: dict[str, DataFrame], session: str = "session_id", time: str = "t_ms") -> DataFrame:
    """All numeric columns of all streams as session, stream, column, t, value."""
    out = None
    for name, df in parts.items():
        cols = [c for c in numeric_columns(df) if c not in (session, time, "row_id")]
        p = df.select(session, F.lit(name).alias("stream"), F.col(time).alias("t"), *[F.col(c).cast("double") for c in cols]).unpivot([session, "stream", "t"], cols, "column", "value")
        out = p if out is None else out.unionByName(p)
    return out


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.withColumn("phase", F.lit("before")).unionByName(after.withColumn("phase", F.lit("after")))
