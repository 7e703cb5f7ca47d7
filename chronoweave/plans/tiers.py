"""Catalogue of sessions: statistics, look-ups, pipeline state, repair loop."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.repair import accept_if_improved
from ..operators.stats import totals

#: Steps of the session pipeline, in order.
STEPS = ["detect", "check_sync", "verify", "rotate", "tracker", "video", "verify_labels", "flux", "align", "validate", "store", "test"]


def tier_stats(sessions: DataFrame, tier: str, scenario: str, seconds: str, missing: str = "unknown") -> DataFrame:
    """Sessions and duration by tier and scenario with subtotals and a total."""
    s = sessions.withColumn(scenario, F.coalesce(F.nullif(F.trim(scenario), F.lit("")), F.lit(missing)))
    return totals(s, [tier, scenario], [F.count("*").alias("n_sessions"), F.sum(seconds).alias("seconds")])


def lookup_by_priority(left: DataFrame, dim: DataFrame, key: str, fields: Sequence[str], value: str) -> DataFrame:
    """``value`` of the first field of the dimension (by priority, then value) whose text equals the key, case and outer
    blanks aside; one pass over the dimension's fields, one join."""
    rows = dim.select(F.posexplode(F.array(*[F.lower(F.trim(F.col(f).cast("string"))) for f in fields])).alias("_p", "_k"), value).where("_k is not null and _k <> ''")
    best = rows.groupBy("_k").agg(F.min_by(value, F.struct("_p", value)).alias(value), F.min("_p").alias("priority"))
    return left.withColumn("_k", F.lower(F.trim(key))).join(best, "_k", "left").drop("_k")


def triage(scored: DataFrame, score: str = "score", grade: str = "grade", blocked: str = "blocked") -> DataFrame:
    """Bucket of each session: AB ships, CDF is rejected, blocked waits for repair."""
    bucket = F.when(F.col(blocked), "blocked").when(F.col(grade).isin("A", "B"), "AB").otherwise("CDF")
    return scored.withColumn("bucket", bucket)


def duplicate_positions(cameras: DataFrame, session: str, position: str) -> DataFrame:
    """Camera positions that several cameras of a session claim."""
    return cameras.groupBy(session, position).agg(F.count("*").alias("n")).where("n > 1")


def next_step(states: DataFrame, session: str = "session_id") -> DataFrame:
    """First step of each session that is not done, and whether a failed one stops it."""
    order = F.array(*map(F.lit, STEPS))
    s = states.withColumn("_o", F.array_position(order, F.col("step")))
    latest = s.groupBy(session, "step", "_o").agg(F.max_by("status", "ended_at").alias("status"))
    done = latest.groupBy(session).agg(F.collect_set(F.when(F.col("status") == "done", F.col("step"))).alias("done"), F.bool_or(F.col("status") == "failed").alias("failed"))
    left = F.filter(order, lambda x: ~F.array_contains("done", x))
    return done.select(session, F.try_element_at(left, F.lit(1)).alias("next_step"), "failed")


def repair_loop(rows: DataFrame, score: Callable[[DataFrame], DataFrame], repairs: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]], by: Sequence[str], save: Callable[[DataFrame], DataFrame], most: int = 4, tolerance: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """Tries repairs in order on all sessions at once; each session keeps a repair unless its score falls by more than
    ``tolerance``. Returns the rows and the log (keys, repair, scores, accepted). ``save`` cuts the lineage of versions."""
    log = None
    for name, fix in list(repairs)[:most]:
        fixed = save(fix(rows))
        verdict = save(accept_if_improved(score(rows), score(fixed), by, "score", tolerance))
        good = verdict.where("accepted").select(*by)
        rows = save(fixed.join(good, list(by), "left_semi").unionByName(rows.join(good, list(by), "left_anti"), allowMissingColumns=True))
        entry = verdict.withColumn("repair", F.lit(name))
        log = entry if log is None else log.unionByName(entry)
    return rows, log


def ship_decision(grades: DataFrame, sent: DataFrame, session: str, score: Column, least: float) -> DataFrame:
    """Sessions to send: grade A or B, score high enough, not sent before."""
    return grades.where(F.col("grade").isin("A", "B") & (score >= least)).join(sent.select(session), session, "left_anti")
