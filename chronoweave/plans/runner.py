"""Steps of sessions as a resumable run: every session goes as far as its steps let it, and a killed run goes on there."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.ledger import Ledger

STATE = "session_id string, step string, status string, detail string, error string, run_id string, at timestamp"
CLAIM = "session_id string, owner string, expires timestamp, at timestamp"


@dataclass(frozen=True)
class Step:
    """``run`` takes the sessions that are due and returns session_id, ok, detail, error - one row for each that it judged.

    Steps with the same ``stage`` wait for the same ones and do not wait for each other. ``when`` false: the step is skipped.
    """

    name: str
    run: Callable[[DataFrame], DataFrame]
    stage: int
    when: bool = True


def _latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row of each key by ``at``."""
    names = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*names), F.struct("at", "status" if "status" in rows.columns else "owner")).alias("s"))
    return best.select(*keys, "s.*")


def claims(spark: SparkSession, root: str) -> Ledger:
    return Ledger(spark, root, CLAIM, squash=lambda rows: _latest(rows, ["session_id"]))


def claim(ledger: Ledger, sessions: DataFrame, owner: str, seconds: float) -> DataFrame:
    """The sessions that ``owner`` gets: those without a claim, or whose claim has run out. A claim ends by itself after
    ``seconds``, so a lost owner blocks nobody for longer; the owner's own claims are renewed."""
    until = F.expr(f"current_timestamp() + make_dt_interval(0, 0, 0, {float(seconds)})")

    def free(rows: DataFrame) -> DataFrame:
        held = _latest(rows, ["session_id"]).where((F.col("expires") > F.current_timestamp()) & (F.col("owner") != owner))
        return sessions.select("session_id").distinct().join(held, "session_id", "left_anti").select("session_id", F.lit(owner).alias("owner"), until.alias("expires"), F.current_timestamp().alias("at"))

    return ledger.append(free).select("session_id")


def release(ledger: Ledger, sessions: DataFrame, owner: str) -> None:
    """Ends the owner's claims on ``sessions``."""

    def ended(rows: DataFrame) -> DataFrame:
        own = _latest(rows, ["session_id"]).where(F.col("owner") == owner)
        return own.join(sessions.select("session_id"), "session_id", "left_semi").select("session_id", "owner", F.current_timestamp().alias("expires"), F.current_timestamp().alias("at"))

    ledger.append(ended)


class Runner:
    """Runs ``steps`` over sessions; the state is a ledger of one row for each step that ended.

    A step is committed as a whole when its result is written: if a run is killed, what was committed stays, and the next run
    starts every session at its first step that is not done. A session that fails a step stops there and is tried again by a
    later run; other sessions go on. Sessions claimed by another living run are left to it.
    """

    def __init__(self, spark: SparkSession, root: str, steps: Sequence[Step], claim_seconds: float = 3600.0) -> None:
        self.spark, self.root = spark, root
        self.steps, self.claim_seconds = sorted(steps, key=lambda s: s.stage), claim_seconds
        self.state = Ledger(spark, f"{root}/state", STATE, squash=lambda rows: _latest(rows, ["session_id", "step"]))
        self.claims = claims(spark, f"{root}/claims")

    def status(self) -> DataFrame:
        """session_id, next_step (null: all done), failed, error, n_done for every session that the state knows."""
        order = F.array(*[F.lit(s.name) for s in self.steps])
        s = _latest(self.state.read(), ["session_id", "step"]).where(F.array_contains(order, F.col("step")))
        ended = F.col("status").isin("done", "skipped")
        g = s.groupBy("session_id").agg(F.collect_set(F.when(ended, F.col("step"))).alias("_d"), F.max(F.when(~ended, F.col("error"))).alias("error"), F.bool_or(~ended).alias("failed"))
        return g.select("session_id", F.try_element_at(F.filter(order, lambda x: ~F.array_contains("_d", x)), F.lit(1)).alias("next_step"), "failed", "error", F.size("_d").alias("n_done"))

    def _due(self, mine: DataFrame, step: Step, only: Sequence[str] | None) -> DataFrame:
        """Claimed sessions whose steps of earlier stages have all ended well and whose own step has not."""
        before = [s.name for s in self.steps if s.stage < step.stage and (only is None or s.name in only)]
        good = _latest(self.state.read(), ["session_id", "step"]).where(F.col("status").isin("done", "skipped"))
        due = mine.join(good.where(F.col("step") == step.name), "session_id", "left_anti")
        if before:
            ready = good.where(F.col("step").isin(*before)).groupBy("session_id").agg(F.count("*").alias("_n")).where(F.col("_n") == len(before))
            due = due.join(ready, "session_id", "left_semi")
        return due

    def run(self, sessions: DataFrame, only: Sequence[str] | None = None, force: Sequence[str] = (), run_id: str | None = None) -> DataFrame:
        """All steps (or ``only`` those named) over ``sessions`` (session_id and what the steps need); ``force`` repeats steps
        that are done. Returns ``status()`` of the claimed sessions.

        A step's row missing for a due session counts as failed ("no result"). An exception of a step leaves it uncommitted,
        ends the claims and is raised: the next run repeats that step alone. No sessions run nothing.
        """
        run_id = run_id or uuid.uuid4().hex
        got = claim(self.claims, sessions, run_id, self.claim_seconds)
        sessions.join(got, "session_id", "left_semi").write.parquet(f"{self.root}/runs/{run_id}")  # what this run works on
        rows = self.spark.read.parquet(f"{self.root}/runs/{run_id}")
        mine = rows.select("session_id").distinct()
        if force:
            self._again(mine, force, run_id)
        try:
            for step in self.steps:
                if only is not None and step.name not in only:
                    continue
                self._commit(step, self._due(rows, step, only), run_id)
                claim(self.claims, mine, run_id, self.claim_seconds)  # a long run keeps its claims
        finally:
            release(self.claims, mine, run_id)
        return self.status().join(mine, "session_id", "left_semi")

    def _again(self, mine: DataFrame, names: Sequence[str], run_id: str) -> None:
        self.state.append(lambda rows: _latest(rows, ["session_id", "step"]).where(F.col("step").isin(*names)).join(mine, "session_id", "left_semi").select("session_id", "step", F.lit("forced").alias("status"), F.lit(None).cast("string").alias("detail"), F.lit(None).cast("string").alias("error"), F.lit(f"{run_id}-force").alias("run_id"), F.current_timestamp().alias("at")))

    def _commit(self, step: Step, due: DataFrame, run_id: str) -> None:
        if due.isEmpty():
            return
        if step.when:
            got = step.run(due).select("session_id", F.col("ok"), F.col("detail").cast("string").alias("detail"), F.col("error").cast("string").alias("error"))
            rows = due.select("session_id").join(got, "session_id", "left")
            ok = F.coalesce("ok", F.lit(False))
            rows = rows.select("session_id", F.lit(step.name).alias("step"), F.when(ok, "done").otherwise("failed").alias("status"), "detail", F.when(~ok, F.coalesce("error", F.lit("no result"))).alias("error"))
        else:
            rows = due.select("session_id", F.lit(step.name).alias("step"), F.lit("skipped").alias("status"), F.lit(None).cast("string").alias("detail"), F.lit(None).cast("string").alias("error"))
        rows = rows.withColumn("run_id", F.lit(run_id)).withColumn("at", F.current_timestamp())
        self.state.append(lambda _: rows)
