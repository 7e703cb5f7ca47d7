"""Writers: new versions instead of changes in place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException


def write_version(df: DataFrame, root: str, version: str, partition_by: Sequence[str] = ()) -> str:
    """Writes a version of a table; an existing one raises. Readers choose the version, so nothing is rolled back."""
    path = f"{root}/version={version}"
    df.write.partitionBy(*partition_by).parquet(path)
    return path


def write_json_results(df: DataFrame, path: str) -> None:
    """One JSON document a row, as a new folder; an existing one raises."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A CSV table with a header, as a new folder; an existing one raises."""
    df.write.option("header", True).csv(path)


def promote(df: DataFrame, root: str, tier: str, scenario: str = "scenario", key: str = "session_id") -> str:
    """Adds sessions to a tier, partitioned by scenario; rows without one go to ``unknown``. Sessions that the tier has already
    are left out, so a retry adds nothing twice (rows without a ``key`` column are always added)."""
    path = f"{root}/tier={tier}"
    new = not_yet(df, df.sparkSession, path, key) if key in df.columns else df
    new.withColumn(scenario, F.coalesce(F.nullif(F.trim(scenario), F.lit("")), F.lit("unknown"))).write.mode("append").partitionBy(scenario).parquet(path)
    return path


def not_yet(df: DataFrame, spark: SparkSession, registry: str, key: str) -> DataFrame:
    """Rows whose key the registry table does not hold; no registry yet means all rows."""
    try:
        seen = spark.read.parquet(registry).select(key)
    except AnalysisException:
        return df
    return df.join(seen, key, "left_anti")


def register(df: DataFrame, registry: str, key: str) -> None:
    """Enters keys once; those that are there stay as they are."""
    not_yet(df.select(key).distinct(), df.sparkSession, registry, key).withColumn("at", F.current_timestamp()).write.mode("append").parquet(registry)


def merge_reports(metadata: DataFrame, reports: DataFrame, key: str, into: str = "report") -> DataFrame:
    """Metadata with each key's report as JSON; keys without one keep theirs."""
    r = reports.select(key, F.to_json(F.struct(*[c for c in reports.columns if c != key])).alias("_r"))
    out = metadata.join(r, key, "left")
    return out.withColumn(into, F.coalesce("_r", into) if into in metadata.columns else F.col("_r")).drop("_r")
