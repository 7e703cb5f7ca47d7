"""The full check of a session: six dimensions from its own streams, some of which may be missing or say nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import grade
from .checks import DIMENSIONS

DIMENSION = "name string, score double, confidence double, blocking boolean, reason string, repairs array<string>"
#: Score from which a session without a fault is perfect; least scores of a dimension, fixed values.
PERFECT, LOW, LOW_SYNC = 95.0, 60.0, 45.0
#: Order in which dimensions are asked for a blocking reason, as they stand in ``checks.DIMENSIONS`` after the two that only block.
ORDER = ["video_orientation", "gripper_health", "gripper_ts", "video_tracker_sync", "video_quality", "gripper_frame_sync"]


def dimension_of(name: str, score: Column, confidence: Column | float = 0.9, blocking: Column | None = None, reason: Column | None = None, repair: Column | None = None) -> Column:
    """One dimension of a row, a struct of ``DIMENSION``. A null score says that it could not be measured; ``repair`` (null:
    none) names what would help."""
    conf = confidence if isinstance(confidence, Column) else F.lit(float(confidence))
    none = F.lit(None).cast("string")
    repairs = F.filter(F.array(repair if repair is not None else none), lambda x: x.isNotNull())
    return F.struct(F.lit(name).alias("name"), score.cast("double").alias("score"), conf.cast("double").alias("confidence"), F.coalesce(blocking if blocking is not None else F.lit(False), F.lit(False)).alias("blocking"), (reason if reason is not None else none).alias("reason"), repairs.alias("repairs"))


def dimensions(df: DataFrame, session: str, *every: Column) -> DataFrame:
    """Rows of several dimensions (``dimension_of``) of the same rows, which are made once for all of them."""
    return df.select(session, F.inline(F.array(*every)))


def dimension(df: DataFrame, session: str, name: str, score: Column, confidence: Column | float = 0.9, blocking: Column | None = None, reason: Column | None = None, repair: Column | None = None) -> DataFrame:
    """Rows of one dimension, see ``dimension_of``."""
    return df.select(session, dimension_of(name, score, confidence, blocking, reason, repair).alias("_d")).select(session, "_d.*")


def full_check(sessions: DataFrame, dims: Sequence[DataFrame], session: str, weights: dict[str, float] = DIMENSIONS) -> DataFrame:
    """One row for each session: score, grade, verdict, blocked, blocking_reason, confidence, inconclusive, missing, repairs.

    ``dims``: session and ``DIMENSION``, at most one row of each name a session. A dimension without a row or a score is
    missing; one whose score is 50 (within 1) with a confidence under 0.5 is inconclusive. Neither counts nor blocks unless it
    is marked as blocking, and the weights of the others are renormalised; where none is left, missing ones count as 50.
    The first blocking dimension gives the reason; without one, conclusive dimensions that are too low (LOW, LOW_SYNC for
    frame sync) do. Confidence is weighed over all dimensions, missing ones as 0. Repairs come once each, in the order of the
    dimensions. One shuffle by session; a session without any dimension is blocked by nothing and has score 50.
    """
    every = dims[0]
    for d in dims[1:]:
        every = every.unionByName(d)
    own = every.groupBy(session).agg(F.collect_list(F.struct("name", "score", "confidence", "blocking", "reason", "repairs")).alias("_all"))
    known = sessions.select(session).distinct().join(own, session, "left")

    def slot(name: str) -> Column:
        at = F.try_element_at(F.filter("_all", lambda x: x["name"] == name), F.lit(1))
        score = F.coalesce(at["score"], F.lit(50.0))
        missing = at["score"].isNull()
        blocking = F.coalesce(at["blocking"], F.lit(False))
        confidence = F.when(missing, 0.0).otherwise(F.coalesce(at["confidence"], F.lit(0.0)))
        vague = ~blocking & (missing | ((F.abs(score - 50) < 1) & (confidence < 0.5)))
        low = ~vague & (score < (LOW_SYNC if name == "gripper_frame_sync" else LOW))
        return F.struct(F.lit(name).alias("name"), score.alias("score"), confidence.alias("confidence"), F.lit(float(weights.get(name, 0.0))).alias("weight"), missing.alias("missing"), vague.alias("vague"), blocking.alias("blocking"), low.alias("low"), at["reason"].alias("reason"), F.coalesce(at["repairs"], F.array().cast("array<string>")).alias("repairs"))

    d = known.select(session, F.array(*[slot(n) for n in ORDER]).alias("_d"))
    used = F.filter("_d", lambda x: ~x["vague"] & (x["weight"] > 0))
    d = d.withColumn("_u", F.when(F.size(used) > 0, used).otherwise(F.col("_d")))
    total = lambda c, f: F.aggregate(c, F.lit(0.0), lambda s, x: s + f(x))
    score = total("_u", lambda x: x["weight"] * x["score"]) / F.greatest(total("_u", lambda x: x["weight"]), F.lit(1e-6))
    d = d.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)))
    stop = F.try_element_at(F.filter("_d", lambda x: x["blocking"]), F.lit(1))
    low = F.filter("_d", lambda x: x["low"])
    text = F.when(stop.isNotNull(), F.concat(F.lit("["), stop["name"], F.lit("] "), F.coalesce(stop["reason"], F.lit("")))).when(F.size(low) > 0, F.concat(F.lit("too low: "), F.array_join(F.transform(low, lambda x: F.concat(x["name"], F.lit("="), F.bround(x["score"], 0).cast("int").cast("string"))), ", ")))
    d = d.withColumn("blocking_reason", text).withColumn("blocked", F.col("blocking_reason").isNotNull())
    verdict = F.when(F.col("blocked"), "BLOCKED").when(F.col("score") >= PERFECT, "PERFECT").when(F.col("score") >= 75, "ACCEPTABLE").when(F.col("score") >= 45, "ISSUES").otherwise("FAILED")
    weight = sum(weights.get(n, 0.0) for n in ORDER)
    names = lambda f: F.transform(F.filter("_d", f), lambda x: x["name"])
    return d.select(
        session,
        "score",
        grade(F.col("score")).alias("grade"),
        verdict.alias("verdict"),
        "blocked",
        "blocking_reason",
        (total("_d", lambda x: x["weight"] * x["confidence"]) / F.lit(max(weight, 1e-6))).alias("confidence"),
        names(lambda x: x["vague"] & ~x["missing"]).alias("inconclusive"),
        names(lambda x: x["missing"]).alias("missing"),
        F.array_distinct(F.flatten(F.transform("_d", lambda x: x["repairs"]))).alias("repairs"),
    )
