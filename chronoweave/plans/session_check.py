"""The session check: raw streams to gates, alignment score, penalty and a score of 0 to 100.

Facts of all required streams first, one row a session; a session that a gate blocks goes no further, so signals are put on
common grids only for the others.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.events import peak_positions, per_stream
from ..operators.grid import grid, interpolate
from ..operators.session import session_penalty, session_score
from ..operators.stats import percentile_clip
from ..operators.timebase import ordered
from .checks import SESSION_GATES, Gate


@dataclass(frozen=True)
class Layout:
    """Streams of a session: the tracker, its cameras, and the pairs (reference, target) whose alignment counts."""

    tracker: str = "tracker"
    cameras: tuple[str, ...] = ("cam_head", "cam_left", "cam_right")
    pairs: tuple[tuple[str, str], ...] = (("tracker", "cam_head"), ("tracker", "cam_left"), ("tracker", "cam_right"))
    tracker_gap: float = 60.0
    camera_gap: float = 120.0
    #: Common grid in ms, the overlap and the samples that a pair needs.
    step: float = 10.0
    least_overlap: float = 800.0
    least_samples: int = 16
    #: Samples that a stream needs to have a signal.
    least_rows: int = 20

    @property
    def required(self) -> tuple[str, ...]:
        return (self.tracker, *self.cameras)


#: The blocking gates of the check.
GATES = [g for g in SESSION_GATES if g.blocking]


def session_facts(sessions: DataFrame, streams: DataFrame, session: str, layout: Layout, stream: str = "stream", time: str = "t", valid: str = "valid") -> DataFrame:
    """One row for each session of ``sessions`` (session, metadata_ok, trigger): what the gates and the penalty look at.

    ``streams``: session, stream, time in ms, valid (false for a corrupt quaternion; null counts as valid). Every required
    stream counts, with or without rows: n_missing_files, the tracker's share of invalid rows and its gaps, the most gaps of a
    camera, the least share of the tracker's span that a camera covers (none with fewer than two frames; null without two
    tracker rows apart), and the latest or earliest first frame against the trigger. One shuffle by stream, one by session.
    """
    own = streams.where(F.col(time).isNotNull() & F.col(stream).isin(*layout.required))
    d = own.withColumn("_dt", F.col(time) - F.lag(time).over(ordered([session, stream], time)))
    limit = F.when(F.col(stream) == layout.tracker, layout.tracker_gap).otherwise(layout.camera_gap)
    s = d.groupBy(session, stream).agg(F.count("*").alias("n"), F.min(time).alias("a"), F.max(time).alias("z"), F.count_if(F.col("_dt") > limit).alias("g"), F.avg((~F.coalesce(F.col(valid), F.lit(True))).cast("double")).alias("bad"))
    want = sessions.select(session, "metadata_ok", "trigger", F.explode(F.array(*map(F.lit, layout.required))).alias(stream)).join(s, [session, stream], "left")
    ref = F.col(stream) == layout.tracker
    of_ref = lambda c: F.max(F.when(ref & (F.col("n") >= 2), F.col(c)))
    rows = want.groupBy(session).agg(
        F.bool_and(F.coalesce("metadata_ok", F.lit(False))).alias("has_metadata"),
        F.count_if(F.col("n").isNull()).alias("n_missing_files"),
        F.coalesce(F.max(F.when(ref, F.col("bad"))), F.lit(0.0)).alias("invalid_quaternion_share"),
        F.coalesce(of_ref("g"), F.lit(0)).alias("n_tracker_gaps"),
        F.coalesce(F.max(F.when(~ref, F.col("g"))), F.lit(0)).alias("n_camera_gaps"),
        of_ref("a").alias("_a"),
        of_ref("z").alias("_z"),
        F.collect_list(F.when(~ref, F.struct(F.coalesce("n", F.lit(0)).alias("n"), "a", "z"))).alias("_cams"),
        F.coalesce(F.max(F.when(~ref, F.abs(F.col("a") - F.col("trigger")))), F.lit(0.0)).alias("trigger_offset"),
    )
    span = F.col("_z") - F.col("_a")
    cover = F.transform("_cams", lambda c: F.when(c["n"] < 2, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(c["z"], F.col("_z")) - F.greatest(c["a"], F.col("_a"))) / (span + 1e-6)))
    return rows.withColumn("camera_coverage", F.when(span > 0, F.least(F.lit(1.0), F.array_min(cover)))).drop("_a", "_z", "_cams")


def short_circuit(facts: DataFrame, gates: Sequence[Gate] = GATES) -> DataFrame:
    """Adds ``gates`` (name, passed), in order up to the first that fails, and ``blocked_by`` (null if none does).

    A null fact passes. No shuffle: the gates are expressions over the session's one row."""
    rows = F.array(*[F.struct(F.lit(g.name).alias("name"), (~F.coalesce(F.expr(g.fails), F.lit(False))).alias("passed")) for g in sorted(gates, key=lambda g: g.position)])
    at = F.array_position(F.transform("_g", lambda g: g["passed"]), False)
    d = facts.withColumn("_g", rows).withColumn("_at", at.cast("int"))
    return d.withColumn("gates", F.when(F.col("_at") > 0, F.slice("_g", F.lit(1), F.col("_at"))).otherwise(F.col("_g"))).withColumn("blocked_by", F.try_element_at("_g", F.nullif("_at", F.lit(0)))["name"]).drop("_g", "_at")


def alignment_parts(a: np.ndarray, b: np.ndarray, sigma: float, percentile: float = 75.0, near: int = 4) -> tuple[float, float, float, float]:
    """Correlation of two signals, of their smoothed energies and of their spectra, and how many peaks of each have one of the
    other within ``near`` samples (mean of both directions)."""
    z = [(x - x.mean()) / (x.std() + 1e-8) for x in (a, b)]

    def corr(u: np.ndarray, v: np.ndarray) -> float:
        if len(u) < 4:
            return 0.0
        u, v = u - u.mean(), v - v.mean()
        uu, vv = float(u @ u), float(v @ v)
        if not (uu / len(u) >= 1e-16 and vv / len(v) >= 1e-16):
            return 0.0
        c = float(u @ v) / (math.sqrt(uu) * math.sqrt(vv))
        return min(1.0, max(-1.0, c)) if math.isfinite(c) else 0.0

    r = int(4 * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    energy = [np.convolve(np.pad(x * x, r, "symmetric"), k / k.sum(), "valid") for x in z]
    peaks = [peak_positions(x, float(h)) for x, h in zip(z, np.percentile(np.stack(z), percentile, axis=1), strict=True)]
    match = 0.0
    if all(map(len, peaks)):
        gap = np.abs(peaks[0][:, None] - peaks[1][None, :])
        match = float(((gap.min(1) <= near).mean() + (gap.min(0) <= near).mean()) / 2)
    return corr(*z), corr(*energy), match, corr(*(np.abs(np.fft.rfft(x)) for x in z))


def alignment_scores(rows: DataFrame, by: Sequence[str], order: str, x: str, y: str, step: float, sigma_ms: float = 2.0) -> DataFrame:
    """(by, n, corr, energy, peaks, spectrum, alignment) of two signals on one grid: 0.42 correlation, 0.28 energies, 0.20
    peaks, 0.10 spectra, negative parts as 0. Fewer than eight samples score 0. A group is one pair of one session."""

    def run(u: np.ndarray, v: np.ndarray) -> tuple:
        parts = alignment_parts(u, v, max(sigma_ms / step, 0.1)) if len(u) >= 8 else (0.0,) * 4
        return (len(u), *parts, min(1.0, sum(w * max(p, 0.0) for w, p in zip((0.42, 0.28, 0.20, 0.10), parts, strict=True))))

    return per_stream(rows, by, order, [x, y], run, "n long, corr double, energy double, peaks double, spectrum double, alignment double")


def pair_grids(streams: DataFrame, session: str, layout: Layout, stream: str = "stream", time: str = "t", value: str = "value") -> DataFrame:
    """session, pair, i, t, x, y: both signals of every pair that both are there, clipped to their 1st and 99th percentile,
    on the grid of their overlap (its end not included). Pairs with too little overlap, too few samples or a stream without
    ``least_rows`` values give nothing."""
    own = streams.where(F.col(time).isNotNull() & F.col(value).isNotNull()).select(session, stream, F.col(time).cast("double").alias("t"), F.col(value).cast("double").alias("value"))
    enough = own.groupBy(session, stream).agg(F.count("*").alias("_n"), F.min("t").alias("a"), F.max("t").alias("z")).where(F.col("_n") >= layout.least_rows).drop("_n")
    pairs = F.array(*[F.struct(F.lit(k).alias("pair"), F.lit(a).alias("ref"), F.lit(b).alias("tgt")) for k, (a, b) in enumerate(layout.pairs)])
    side = lambda name: enough.select(session, F.explode(pairs).alias("p"), stream, "a", "z").where(F.col(stream) == F.col(f"p.{name}"))
    both = side("ref").select(session, "p.pair", "p.ref", "p.tgt", F.col("a").alias("a0"), F.col("z").alias("z0")).join(side("tgt").select(session, "p.pair", F.col("a").alias("a1"), F.col("z").alias("z1")), [session, "pair"])
    both = both.select(session, "pair", "ref", "tgt", F.greatest("a0", "a1").alias("start"), F.least("z0", "z1").alias("stop"))
    n = F.ceil((F.col("stop") - F.col("start")) / layout.step)
    both = both.where((F.col("stop") - F.col("start") >= layout.least_overlap) & (n >= layout.least_samples)).withColumn("last", F.col("start") + (n - 1) * F.lit(layout.step))
    points = grid(both, [session, "pair"], "start", "last", layout.step)
    clipped = percentile_clip(own.join(enough.select(session, stream), [session, stream], "left_semi"), [session, stream], "value", 0.01, 0.99, "value")
    of = lambda name: clipped.join(both.select(session, "pair", F.col(name).alias(stream)), [session, stream]).select(session, "pair", "t", "value")
    x = interpolate(of("ref"), points, [session, "pair"], out="x")
    return interpolate(of("tgt"), x, [session, "pair"], out="y")


def check_sessions(sessions: DataFrame, streams: DataFrame, session: str, layout: Layout, gates: Sequence[Gate] = GATES, stream: str = "stream", time: str = "t", value: str = "value", valid: str = "valid") -> DataFrame:
    """Every session of ``sessions`` (session, metadata_ok, trigger in ms or null) checked from its raw ``streams``.

    Returns session, gates, blocked_by, the facts, n_pairs, alignment, penalty, score. The first gate that fails blocks: score
    0, alignment null, later gates not reported. Else score = mean alignment of the pairs (0 without any) x penalty x 100.
    Streams of sessions that are not in ``sessions`` are ignored; repeated rows of a stream count as samples.
    """
    facts = short_circuit(session_facts(sessions, streams, session, layout, stream, time, valid), gates)
    open_ = facts.where("blocked_by is null").select(session)
    grids = pair_grids(streams.where(F.col(stream).isin(*{s for p in layout.pairs for s in p})).join(open_, session, "left_semi"), session, layout, stream, time, value)
    scores = alignment_scores(grids, [session, "pair"], "i", "x", "y", layout.step)
    mean = scores.groupBy(session).agg(F.avg("alignment").alias("alignment"), F.count("*").alias("n_pairs"))
    out = facts.join(mean, session, "left")
    blocked = F.col("blocked_by").isNotNull()
    alignment = F.when(~blocked, F.coalesce("alignment", F.lit(0.0)))
    penalty: Column = session_penalty(F.col("trigger_offset"), F.col("n_tracker_gaps"))
    return out.withColumn("alignment", alignment).withColumn("n_pairs", F.coalesce("n_pairs", F.lit(0)).cast("long")).withColumn("penalty", penalty).withColumn("score", F.round(session_score(blocked, F.col("alignment"), F.col("penalty")), 1))
