"""Watching a landing zone: each new session is handed over once it has been quiet for a while."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.readers import METADATA, SESSION

SCHEMAS = {"text": "value string", "binaryFile": "path string, modificationTime timestamp, length long, content binary"}
ARRIVAL = f"path string, session_id string, modified timestamp, metadata {METADATA}"
_WAITING = "path string, modified double, metadata string, names string"


def _now() -> float:
    return time.time()


def _ripen(quiet_seconds: float, ahead: float):
    """State of one session: its metadata file, the time of its newest file and the names of its files. A timer looks at it in
    every batch until nothing came for long enough; an unfinished file (``name.part``) keeps it waiting until ``name`` is
    there. ``ahead``: the driver's clock less the machine's."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        path, modified, metadata, names = state.get if state.exists else (None, 0.0, None, "")
        have = set(filter(None, names.split("\n")))
        for f in frames:
            modified = max(modified, float(f["modified"].max()))
            have |= set(f["path"])
            for p, text in f.loc[f["text"].notna(), ["path", "text"]].itertuples(index=False):
                path, metadata = p, text
        young = modified + quiet_seconds > time.time() + ahead
        unfinished = any(x.endswith(".part") and x[:-5] not in have for x in have)
        if path is None or unfinished or young:
            state.update((path, modified, metadata, "\n".join(sorted(have))))
            if path is not None and not unfinished:
                state.setTimeoutDuration(1)
            return
        state.remove()
        yield pd.DataFrame({"path": [path], "session_id": [key[0]], "modified": [modified], "text": [metadata]})

    return run


def watch_sessions(spark: SparkSession, root: str, handle: Callable[[DataFrame, int], None], checkpoint: str, every: str = "10 seconds", quiet_seconds: float = 0.0, max_files: int = 1000, once: bool = False) -> StreamingQuery:
    """Runs ``handle(sessions, batch_id)`` on sessions (path, session_id, modified, metadata) that have arrived.

    The source's checkpoint is the seen set: a file comes once. With ``quiet_seconds`` all of a session's files count: it is
    handed over when its metadata is there, no ``.part`` file is left and the newest file is old enough. What waits lives in
    the query's state store, one small row a session, with a timer for each; Spark keeps a bounded number of state versions,
    however many batches there are, and a new start goes on from them and hands over what has ripened since. ``modified`` is
    then the newest file's time. With ``once`` young sessions wait for the next start. A checkpoint belongs to one setting of
    ``quiet_seconds`` on or off; Spark refuses the other. A crash repeats a batch with the same ``batch_id`` and rows, so
    ``handle`` must ignore what it has had before (``land_once`` does); two watchers share sessions by ``plans.runner.claim``.
    """
    def source(kind: str, **options) -> DataFrame:
        reader = spark.readStream.format(kind).option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files)
        return reader.options(**options).schema(SCHEMAS[kind]).load(root)

    lines = source("text", wholetext=True, pathGlobFilter="metadata.json").select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"), "value")
    session = F.regexp_extract("path", SESSION, 1).alias("session_id")
    if quiet_seconds:
        # names and times of all files, contents of the metadata alone
        files = source("binaryFile").select("path", F.col("modificationTime").alias("modified"), F.lit(None).cast("string").alias("value"))
        # ticks make batches, and so timers, also when no file arrives; they hold no session
        tick = spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.lit("").alias("path"), F.col("timestamp").alias("modified"), F.lit(None).cast("string").alias("value"))
        rows = files.unionByName(lines).unionByName(tick).select(session, "path", F.col("modified").cast("double").alias("modified"), F.col("value").alias("text")).where("session_id <> ''")
        rows = rows.groupBy("session_id").applyInPandasWithState(_ripen(quiet_seconds, _now() - time.time()), "path string, session_id string, modified double, text string", _WAITING, "append", GroupStateTimeout.ProcessingTimeTimeout)
        rows = rows.select("path", "session_id", F.timestamp_seconds("modified").alias("modified"), F.from_json("text", METADATA).alias("metadata"))
    else:
        rows = lines.select("path", session, "modified", F.from_json("value", METADATA).alias("metadata"))

    def batch(df: DataFrame, batch_id: int) -> None:
        handle(df.dropDuplicates(["session_id"]), batch_id)

    w = rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=every)).start()


def land_once(target: str, key: str = "session_id") -> Callable[[DataFrame, int], None]:
    """A handler that appends sessions not yet in the target table; the first call makes the table, empty calls write nothing."""

    def handle(df: DataFrame, batch_id: int) -> None:
        rows = df.withColumn("batch_id", F.lit(batch_id))
        try:
            seen = df.sparkSession.read.parquet(target).select(key)
        except AnalysisException:
            rows.write.mode("append").parquet(target)
            return
        new = rows.join(seen, key, "left_anti")
        if not new.isEmpty():
            new.write.mode("append").parquet(target)

    return handle
