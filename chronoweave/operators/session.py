"""Whole-session reports from raw streams: stream status, continuity, completeness, gate metrics, scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.scalars import clamp, nominal_level
from .islands import extend_backward, static_gap_fill
from .smooth import gradient, window
from .timebase import ordered

#: Limits of the stream report in ms and ppm, fixed values: start offset (fair, bad), least coverage, drift (fair, bad) of cameras
#: and of sensors.
START_LIMITS, LEAST_COVERAGE = (500.0, 2000.0), 0.70
DRIFT_LIMITS = {"camera": (30_000.0, 80_000.0), "sensor": (2_000.0, 10_000.0)}
STATUS = ("ok", "warn", "error")


def _status(rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, STATUS)), rank + 1)


def stream_report(df: DataFrame, session: str, stream: str, time: str, reference: str, gap: float, cameras: Sequence[str] = (), drift_limits: dict[str, tuple[float, float]] = DRIFT_LIMITS, start_limits: tuple[float, float] = START_LIMITS) -> DataFrame:
    """Each stream of each session against the session's reference stream: size, span, rate, gaps, drift, coverage, start
    offset, status and number of issues.

    A gap is longer than ``gap`` and than three median steps. Without a reference stream the comparisons are null and do not
    count. One shuffle by stream, one by session."""
    by = [session, stream]
    d = df.where(F.col(time).isNotNull()).withColumn("_dt", F.col(time) - F.lag(time).over(ordered(by, time)))
    whole = W.partitionBy(*by)
    d = d.withColumn("_wide", F.col("_dt") > F.greatest(F.lit(gap), 3 * F.median("_dt").over(whole)))
    s = d.groupBy(*by).agg(F.count("*").alias("n"), F.min(time).alias("start"), F.max(time).alias("end"), F.median("_dt").alias("median_dt"), F.count_if("_wide").alias("n_gaps"), F.coalesce(F.sum(F.when(F.col("_wide"), F.col("_dt"))), F.lit(0.0)).alias("gap_total"))
    s = s.withColumn("duration", F.col("end") - F.col("start"))
    own = W.partitionBy(session)
    at = lambda c: F.max(F.when(F.col(stream) == reference, F.col(c))).over(own)
    s = s.withColumns({"_r0": at("start"), "_r1": at("end")}).withColumn("_rd", F.nullif(F.col("_r1") - F.col("_r0"), F.lit(0.0)))
    other = F.col(stream) != reference
    s = s.withColumn("drift_ppm", F.when(other, (F.col("duration") - F.col("_rd")) / F.col("_rd") * 1e6))
    s = s.withColumn("coverage", F.when(other, F.greatest(F.lit(0.0), (F.least("_r1", "end") - F.greatest("_r0", "start")) / F.col("_rd"))))
    s = s.withColumn("start_offset", F.when(other, F.col("start") - F.col("_r0")))
    kind = lambda i: F.when(F.col(stream).isin(*cameras), drift_limits["camera"][i]).otherwise(drift_limits["sensor"][i]) if cameras else F.lit(drift_limits["sensor"][i])
    share = F.col("gap_total") / (F.col("duration") + 1e-6)
    gaps = F.when((F.col("n_gaps") > 0) & ((share > 0.05) | (F.col("n_gaps") > 3)), F.when(share < 0.10, 1).otherwise(2)).otherwise(0)
    graded = lambda x, fair, bad: F.when(F.abs(x) > bad, 2).when(F.abs(x) > fair, 1).otherwise(0)
    parts = [gaps, graded(F.col("drift_ppm"), kind(0), kind(1)), F.when(F.col("coverage") < LEAST_COVERAGE, 2).otherwise(0), graded(F.col("start_offset"), *map(F.lit, start_limits))]
    s = s.withColumns({f"_i{k}": p for k, p in enumerate(parts)})
    issues = sum((F.when(F.col(f"_i{k}") > 0, 1).otherwise(0) for k in range(1, 4)), F.when(F.col("_i0") > 0, 1).otherwise(0))
    rate = F.coalesce(1000.0 / F.nullif("median_dt", F.lit(0.0)), F.lit(0.0))
    return s.select(*by, "n", "start", "end", "duration", rate.alias("rate_hz"), "n_gaps", "gap_total", "drift_ppm", "coverage", "start_offset", _status(F.greatest(*[f"_i{k}" for k in range(4)])).alias("status"), issues.alias("n_issues"))


def session_status(report: DataFrame, session: str) -> DataFrame:
    """The worst status of a session's streams, its issues and streams."""
    rank = F.array_position(F.array(*map(F.lit, STATUS)), F.col("status"))
    s = report.groupBy(session).agg(F.max(rank).alias("_r"), F.sum("n_issues").alias("n_issues"), F.count("*").alias("n_streams"))
    return s.select(session, F.element_at(F.array(*map(F.lit, STATUS)), F.col("_r").cast("int")).alias("status"), "n_issues", "n_streams")


def sensor_continuity(df: DataFrame, by: Sequence[str], time: str, value: str, factor: float = 4.0, most_change: float = 2.0, most: float = 1500.0) -> DataFrame:
    """Gaps longer than ``factor`` median steps of each stream: fixable (short and with the value at rest) or not.

    Streams with fewer than three samples or no forward step are ``skipped`` and pass."""
    by = list(by)
    w = ordered(by, time)
    d = df.where(F.col(time).isNotNull() & F.col(value).isNotNull()).withColumn("_dt", F.lead(time).over(w) - F.col(time)).withColumn("_dv", F.abs(F.lead(value).over(w) - F.col(value)))
    d = d.withColumn("_m", F.median("_dt").over(W.partitionBy(*by)))
    gap = F.col("_dt") > factor * F.col("_m")
    calm = (F.col("_dt") <= most) & (F.col("_dv") <= most_change)
    s = d.groupBy(*by).agg(F.count("*").alias("n"), F.first("_m").alias("nominal"), F.count_if(gap & calm).alias("n_fixable"), F.count_if(gap & ~calm).alias("n_unfixable"), F.max(F.when(gap, F.col("_dt"))).alias("worst_gap"))
    skip = (F.col("n") < 3) | (F.coalesce("nominal", F.lit(0.0)) <= 0)
    zero = lambda c: F.when(skip, F.lit(0).cast("long")).otherwise(F.col(c)).alias(c)
    return s.select(*by, "n", "nominal", zero("n_fixable"), zero("n_unfixable"), F.when(~skip, F.col("worst_gap")).alias("worst_gap"), F.when(skip, "skipped").when(F.col("n_unfixable") > 0, "unfixable").when(F.col("n_fixable") > 0, "fixable").otherwise("none").alias("gap_class"), (skip | (F.col("n_unfixable") == 0)).alias("ok"))


def completeness(lines: DataFrame, sessions: DataFrame, session: str, file: str, line: str, required: Sequence[str], least: int = 5) -> DataFrame:
    """Valid JSON lines of each required file of each session; a session is complete if all hold ``least`` or more."""
    # the parser stops at the end of a value; within brackets, what follows must be one value and nothing else
    one = F.expr(f"try_parse_json(concat('[', {line}, ']'))")
    ok = one.isNotNull() & F.try_variant_get(one, "$[0]", "variant").isNotNull() & F.try_variant_get(one, "$[1]", "variant").isNull()
    valid = lines.where(F.col(file).isin(*required)).groupBy(session, file).agg(F.count_if(ok).alias("n"))
    want = sessions.select(session).distinct().withColumn(file, F.explode(F.array(*map(F.lit, required))))
    got = want.join(valid, [session, file], "left").fillna(0, ["n"])
    return got.groupBy(session).agg(F.min("n").alias("least_lines"), F.count_if(F.col("n") < least).alias("n_short"), (F.min("n") >= least).alias("complete"))


def trigger_delay(frames: DataFrame, triggers: DataFrame, session: str, camera: str, time: str, row: str, trigger: str, most: float = 500.0) -> DataFrame:
    """How long after the trigger each session's cameras began: the largest delay and a status (ok, shifted, skipped)."""
    first = frames.where(F.col(time).isNotNull()).groupBy(session, camera).agg(F.min_by(time, row).alias("_t"))
    s = triggers.select(session, trigger).join(first, session, "left").groupBy(session).agg(F.max(F.col("_t") - F.col(trigger)).alias("max_delay"), F.count("_t").alias("n_cameras"))
    return s.withColumn("status", F.when(F.col("max_delay").isNull(), "skipped").when(F.col("max_delay") <= most, "ok").otherwise("shifted"))


def gate_metrics(df: DataFrame, session: str, stream: str, time: str, tracker: str, cameras: Sequence[str], tracker_gap: float = 60.0, camera_gap: float = 120.0) -> DataFrame:
    """Metrics of the session gates from the raw streams: tracker gaps, most gaps of a camera, least share of the tracker's
    span that a camera covers, and the spread of the streams' first times.

    Every one of ``cameras`` is required: one without rows, or with a single one, covers nothing. Without a tracker of some
    length the coverage is null. Sessions without any row are not in ``df``; ``plans.session_check`` knows those."""
    by = [session, stream]
    d = df.where(F.col(time).isNotNull() & F.col(stream).isin(tracker, *cameras)).withColumn("_dt", F.col(time) - F.lag(time).over(ordered(by, time)))
    limit = F.when(F.col(stream) == tracker, tracker_gap).otherwise(camera_gap)
    s = d.groupBy(*by).agg(F.min(time).alias("a"), F.max(time).alias("z"), F.count_if(F.col("_dt") > limit).alias("g"))
    own = W.partitionBy(session)
    ref = F.col(stream) == tracker
    s = s.withColumns({"_a": F.max(F.when(ref, F.col("a"))).over(own), "_z": F.max(F.when(ref, F.col("z"))).over(own)})
    span = F.col("_z") - F.col("_a")
    cover = F.greatest(F.lit(0.0), F.least("z", "_z") - F.greatest("a", "_a")) / F.nullif(span, F.lit(0.0))
    # a camera without rows has no row here: fewer cameras than required cover nothing
    least = F.when(F.count_if(~ref) < len(cameras), 0.0).otherwise(F.min(F.when(~ref, cover)))
    return s.withColumn("_s", span).groupBy(session).agg(F.max(F.when(ref, F.col("g"))).alias("n_tracker_gaps"), F.coalesce(F.max(F.when(~ref, F.col("g"))), F.lit(0)).alias("n_camera_gaps"), F.when(F.max("_s") > 0, least).alias("camera_coverage"), (F.max("a") - F.min("a")).alias("start_spread_ms"))


def session_penalty(offset: Column, tracker_gaps: Column, limit: float = 250.0) -> Column:
    """0.5 to 1 for defects that do not block: a late camera start, a few tracker gaps."""
    late = F.when(offset >= limit, F.greatest(F.lit(0.0), 1 - (offset - limit) / 10000.0)).otherwise(1.0)
    holes = F.when(tracker_gaps > 0, F.greatest(F.lit(0.90), 1 - tracker_gaps * 0.03)).otherwise(1.0)
    return clamp(late * holes, 0.5, 1.0)


def session_score(blocked: Column, alignment: Column, penalty: Column) -> Column:
    """0-100: nothing if a gate blocks, else alignment x penalty."""
    return F.when(blocked, 0.0).otherwise(clamp(F.coalesce(alignment, F.lit(0.0)) * penalty * 100.0, 0.0, 100.0))


def physical_coherence(df: DataFrame, by: Sequence[str], time: str, value: str, most_speed: float) -> DataFrame:
    """Opening and its speed over the rows that have one; speeds over ``most_speed`` a second cannot be. ``time`` in ms."""
    by = list(by)
    n = df.groupBy(*by).agg(F.count(value).alias("n_ok"), F.count_if(F.col(value).isNull()).alias("n_missing"))
    w = ordered(by, time)
    d = df.where(F.col(value).isNotNull()).withColumn("_s", F.abs(F.col(value) - F.lag(value).over(w)) / F.greatest((F.col(time) - F.lag(time).over(w)) / 1000.0, F.lit(1e-6)))
    s = d.groupBy(*by).agg(F.count("*").alias("_n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("spread"), F.min(value).alias("low"), F.max(value).alias("high"), F.max("_s").alias("speed_max"), F.percentile("_s", 0.99).alias("speed_p99"), F.count_if(F.col("_s") > most_speed).alias("impossible_jumps"))
    only = lambda c: F.when(F.col("_n") >= 2, F.col(c)).alias(c)
    return n.join(s, by, "left").select(*by, "n_ok", "n_missing", *[only(c) for c in ("mean", "spread", "low", "high", "speed_max", "speed_p99")], F.coalesce("impossible_jumps", F.lit(0)).alias("impossible_jumps"))


def sensor_fixes(df: DataFrame, by: Sequence[str], time: str, value: str, starts: DataFrame, start: str, step: float = 17.0, most_lead: float = 1500.0) -> DataFrame:
    """Static gaps filled, then the stream's beginning extended back to ``start``; steps in ``dt_ms`` (0 first)."""
    out = extend_backward(static_gap_fill(df, by, time, value, nominal=step), by, time, value, starts, start, step, most_lead)
    return out.withColumn("dt_ms", F.coalesce(F.col(time) - F.lag(time).over(ordered(by, time)), F.lit(0.0)))


def timing_level(sensor: DataFrame, camera: DataFrame, by: Sequence[str], time: str) -> DataFrame:
    """Start offset and overlap of a sensor and its camera, and a status."""
    by = list(by)
    span = lambda d, p: d.where(F.col(time).isNotNull()).groupBy(*by).agg(F.count("*").alias(f"n_{p}"), F.min(time).alias(f"_{p}0"), F.max(time).alias(f"_{p}1"))
    d = span(sensor, "sensor").join(span(camera, "camera"), by)
    d = d.withColumn("delta_start", F.col("_camera0") - F.col("_sensor0")).withColumn("overlap", F.greatest(F.lit(0.0), F.least("_sensor1", "_camera1") - F.greatest("_sensor0", "_camera0")))
    far = F.abs("delta_start")
    status = F.when((far > 2000) | (F.col("overlap") < 3000), "error").when(far > 500, "warn").otherwise("ok")
    return d.select(*by, "n_sensor", "n_camera", "delta_start", "overlap", ((far < 2000) & (F.col("overlap") > 5000)).alias("aligned"), status.alias("status"))


def shift_iso(text: Column, milliseconds: Column) -> Column:
    """An ISO-8601 text in UTC (no zone, Z or +00:00) moved by milliseconds, to the microsecond, whatever the session's zone."""
    # local date-times without a zone: their difference and sum know no change of clocks
    utc = F.regexp_replace(text, r"(Z|[+-]00:?00)$", "").cast("timestamp_ntz")
    zero = F.lit("1970-01-01T00:00:00").cast("timestamp_ntz")
    moved = zero + F.make_dt_interval(secs=(F.round(milliseconds * 1000) / 1000000).cast("decimal(18,6)")) + (utc - zero)
    shown = moved.cast("string")
    return F.concat(F.replace(F.substring(shown, 1, 19), F.lit(" "), F.lit("T")), F.lit("."), F.rpad(F.substring(shown, 21, 6), 6, "0"), F.lit("+00:00"))


def header_truth(columns: Sequence[str], meta: int = 3, size: int = 7, labels: Sequence[str] = ("head", "left", "right")) -> dict[str, int]:
    """Which block of a tracker table has which label, by its column names; raises unless each label has one block."""
    names = [c.lower() for c in columns[meta:]]
    blocks = [names[i * size : (i + 1) * size] for i in range(len(names) // size)]
    found = [[x for x in labels if any(x in c for c in b)] for b in blocks]
    if len(blocks) != len(labels) or any(len(f) != 1 for f in found) or {f[0] for f in found} != set(labels):
        raise ValueError(f"no unique label for each block: {found}")
    return {f[0]: i for i, f in enumerate(found)}


def robust_normalize(df: DataFrame, by: Sequence[str], value: str, out: str = "z") -> DataFrame:
    """(x - median) / (1.4826 MAD); without spread around the median the plain z-score, without any spread 0."""
    own = W.partitionBy(*by)
    d = df.withColumn("_m", F.median(value).over(own)).withColumn("_d", F.abs(F.col(value) - F.col("_m")))
    d = d.withColumns({"_mad": F.median("_d").over(own), "_s": F.stddev_pop(value).over(own), "_a": F.avg(value).over(own)})
    z = F.when(F.col("_mad") >= 1e-12, (F.col(value) - F.col("_m")) / (1.4826 * F.col("_mad"))).when(F.col("_s") >= 1e-12, (F.col(value) - F.col("_a")) / F.col("_s")).otherwise(0.0)
    return d.withColumn(out, F.when(F.col(value).isNotNull(), z)).drop("_m", "_d", "_mad", "_s", "_a")


def state_columns(df: DataFrame, video: str, sensor: str, tolerance: float) -> DataFrame:
    """Nearest nominal level of both openings, whether each is near enough, and whether they agree."""
    d = df
    for name, c in (("video", video), ("sensor", sensor)):
        d = d.withColumn(f"{name}_state", nominal_level(F.col(c)))
        d = d.withColumn(f"{name}_valid", F.abs(F.col(c) - F.col(f"{name}_state")) <= tolerance)
    return d.withColumn("same_state", F.coalesce(F.col("video_valid") & F.col("sensor_valid") & (F.col("video_state") == F.col("sensor_state")), F.lit(False)))


def signal_quality(df: DataFrame, by: Sequence[str], order: str, value: str) -> DataFrame:
    """0-1 from a normalised signal's variance and its steep steps."""
    by = list(by)
    d = df.withColumn("_g", F.abs(gradient(value, window(by, order))))
    part = lambda x: F.least(x / 0.05, F.lit(1.0))
    return d.groupBy(*by).agg((0.6 * part(F.var_pop(value)) + 0.4 * part(F.percentile("_g", 0.95))).alias("quality"))


def vision_confidence(quality: Column, events: Column, sensor_range: Column, peak: Column) -> Column:
    """0-1 blend of signal quality, events, sensor range and correlation peak."""
    peak = F.when(F.isnan(peak), 0.0).otherwise(F.coalesce(F.least(F.abs(peak), F.lit(1.0)), F.lit(0.0)))
    return 0.40 * quality + 0.15 * F.least(events / 2.0, F.lit(1.0)) + 0.20 * F.least(sensor_range / 20.0, F.lit(1.0)) + 0.25 * peak


def camera_verdicts(cameras: DataFrame, session: str, label: str = "label", tracker: str = "tracker_label", fisheye: str = "is_fisheye") -> DataFrame:
    """Agreement of declared camera labels with the tracker's assignment and with the fisheye test (only the head's is one).

    A null tracker label or fisheye result is no check. ``confidence`` is the share of checks that agree (0 without any)."""
    head = F.col(label) == "head"
    seen = F.when(F.col(tracker).isNotNull(), 1).otherwise(0) + F.when(F.col(fisheye).isNotNull(), 1).otherwise(0)
    agree = F.when(F.col(tracker) == F.col(label), 1).otherwise(0) + F.when(F.col(fisheye) == head, 1).otherwise(0)
    return cameras.groupBy(session).agg(F.sum(seen).alias("n_checks"), F.sum(agree).alias("n_agree"), F.count_if(F.col(fisheye) != head).alias("n_warnings")).withColumn("confidence", F.coalesce(F.col("n_agree") / F.nullif("n_checks", F.lit(0)), F.lit(0.0)))


def distinct_repairs(log: DataFrame, session: str, order: str, repair: str) -> DataFrame:
    """Repairs of each session without repeats, in the order in which they first came."""
    first = log.groupBy(session, repair).agg(F.min(order).alias("_o"))
    return first.groupBy(session).agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", repair))), lambda x: x[repair]).alias("repairs"))


def guarded_steps(df: DataFrame, by: Sequence[str], time: str, out: str = "dt") -> DataFrame:
    """Step from the row before in time order; the first is the median step, and a step of at most 1e-9 is null."""
    w = ordered(list(by), time)
    d = df.withColumn("_d", F.col(time) - F.lag(time).over(w))
    d = d.withColumn("_d", F.coalesce("_d", F.median("_d").over(W.partitionBy(*by))))
    return d.withColumn(out, F.when(F.col("_d") > 1e-9, F.col("_d"))).drop("_d")


def oversample(df: DataFrame, label: str, seed: int = 42) -> DataFrame:
    """Rows of the rarer label (0 or 1) repeated until both labels are about as frequent: whole copies, and one more for a
    seeded hash share of the rows. The copies are what the operator is for."""
    n = {r[label]: r["count"] for r in df.where(F.col(label).isin(0, 1)).groupBy(label).count().collect()}
    if len(n) < 2 or n[0] == n[1]:
        return df
    rare = 0 if n[0] < n[1] else 1
    copies, share = divmod(n[1 - rare], n[rare])
    more = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in df.columns], F.lit(seed)), F.lit(1_000_000)) < share / n[rare] * 1_000_000
    times = F.when(F.col(label) == rare, F.lit(copies) + F.when(more, 1).otherwise(0)).otherwise(1)
    return df.withColumn("_c", F.explode(F.sequence(F.lit(1), times))).drop("_c")


def text_report(rows: DataFrame, title: str, columns: Sequence[str]) -> DataFrame:
    """One line of text for each row: title, then name=value pairs."""
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("-"))) for c in columns]
    return rows.select(F.concat_ws("  ", F.lit(title), *parts).alias("value"))
