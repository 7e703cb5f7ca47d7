"""Registered queries of the whole-session operators and role tests; ``plans.queries`` imports them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import frame_sync, roles, session, stats
from . import checks, full_check as fc, session_check as sc
from .queries import events, query, r, table

#: Events as streams in milliseconds: users are sessions, event types streams.
MS = "WITH e AS (SELECT event_id, user_id, event_type, epoch_us(ts) / 1000.0 AS t, value, props FROM events)"
DAY = 86_400_000.0


def _ms(spark, d):
    return events(spark, d).withColumn("t", F.col("us") / 1000.0)


STREAMS = MS + """, d AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id, event_type ORDER BY t) AS dt FROM e),
m AS (SELECT *, median(dt) OVER (PARTITION BY user_id, event_type) AS med FROM d), w AS (SELECT *, dt > greatest(86400000.0, 3 * med) AS wide FROM m),
s AS (SELECT user_id, event_type, count(*) AS n, min(t) AS a, max(t) AS z, max(t) - min(t) AS duration, max(med) AS med, count(*) FILTER (wide) AS n_gaps, coalesce(sum(dt) FILTER (wide), 0.0) AS gap_total FROM w GROUP BY 1, 2),
f AS (SELECT s.*, v.a AS ra, v.z AS rz, nullif(v.z - v.a, 0.0) AS rd FROM s LEFT JOIN (SELECT * FROM s WHERE event_type = 'view') v USING (user_id)),
g AS (SELECT *, CASE WHEN event_type <> 'view' THEN (duration - rd) / rd * 1e6 END AS drift_ppm, CASE WHEN event_type <> 'view' THEN greatest(0.0, (least(rz, z) - greatest(ra, a)) / rd) END AS coverage, CASE WHEN event_type <> 'view' THEN a - ra END AS start_offset, gap_total / (duration + 1e-6) AS share FROM f),
i AS (SELECT *, CASE WHEN n_gaps > 0 AND (share > 0.05 OR n_gaps > 3) THEN CASE WHEN share < 0.10 THEN 1 ELSE 2 END ELSE 0 END AS i0,
  CASE WHEN abs(drift_ppm) > CASE WHEN event_type = 'click' THEN 80000.0 ELSE 10000.0 END THEN 2 WHEN abs(drift_ppm) > CASE WHEN event_type = 'click' THEN 30000.0 ELSE 2000.0 END THEN 1 ELSE 0 END AS i1,
  CASE WHEN coverage < 0.70 THEN 2 ELSE 0 END AS i2, CASE WHEN abs(start_offset) > 172800000.0 THEN 2 WHEN abs(start_offset) > 43200000.0 THEN 1 ELSE 0 END AS i3 FROM g),
k AS (SELECT *, greatest(i0, i1, i2, i3) AS rank, CAST(i0 > 0 AS INTEGER) + CAST(i1 > 0 AS INTEGER) + CAST(i2 > 0 AS INTEGER) + CAST(i3 > 0 AS INTEGER) AS n_issues FROM i)"""


def _report(spark, d):
    return session.stream_report(_ms(spark, d), "user_id", "event_type", "t", "view", DAY, ["click"], start_limits=(DAY / 2, 2 * DAY))


@query(STREAMS + """ SELECT user_id, event_type, n, round(duration, 3) AS duration, n_gaps, round(gap_total, 3) AS gap_total, round(drift_ppm, 3) AS drift_ppm, round(coverage, 6) AS coverage, round(start_offset, 3) AS start_offset, round(coalesce(1000.0 / nullif(med, 0), 0.0), 9) AS rate_hz, CASE rank WHEN 0 THEN 'ok' WHEN 1 THEN 'warn' ELSE 'error' END AS status, n_issues FROM k""")
def stream_report(spark, d):
    s = _report(spark, d)
    return s.select("user_id", "event_type", "n", r("duration", 3).alias("duration"), "n_gaps", r("gap_total", 3).alias("gap_total"), r("drift_ppm", 3).alias("drift_ppm"), r("coverage").alias("coverage"), r("start_offset", 3).alias("start_offset"), r("rate_hz", 9).alias("rate_hz"), "status", "n_issues")


@query(STREAMS + """ SELECT user_id, CASE max(rank) WHEN 0 THEN 'ok' WHEN 1 THEN 'warn' ELSE 'error' END AS status, CAST(sum(n_issues) AS BIGINT) AS n_issues, count(*) AS n_streams FROM k GROUP BY 1""")
def session_status(spark, d):
    return session.session_status(_report(spark, d), "user_id")


@query(MS + """, d AS (SELECT *, lead(t) OVER w - t AS dt, abs(lead(value) OVER w - value) AS dv FROM e WHERE value IS NOT NULL WINDOW w AS (PARTITION BY user_id, event_type ORDER BY t)),
m AS (SELECT *, median(dt) OVER (PARTITION BY user_id, event_type) AS med FROM d),
s AS (SELECT user_id, event_type, count(*) AS n, max(med) AS nominal, count(*) FILTER (dt > 2 * med AND dt <= 864000000.0 AND dv <= 20.0) AS fix, count(*) FILTER (dt > 2 * med AND NOT (dt <= 864000000.0 AND dv <= 20.0)) AS unfix, max(dt) FILTER (dt > 2 * med) AS worst FROM m GROUP BY 1, 2)
SELECT user_id, event_type, n, round(nominal, 3) AS nominal, CASE WHEN n < 3 THEN 0 ELSE fix END AS n_fixable, CASE WHEN n < 3 THEN 0 ELSE unfix END AS n_unfixable, round(CASE WHEN n >= 3 THEN worst END, 3) AS worst_gap, CASE WHEN n < 3 THEN 'skipped' WHEN unfix > 0 THEN 'unfixable' WHEN fix > 0 THEN 'fixable' ELSE 'none' END AS gap_class, n < 3 OR unfix = 0 AS ok FROM s""")
def sensor_continuity(spark, d):
    s = session.sensor_continuity(_ms(spark, d), ["user_id", "event_type"], "t", "value", 2.0, 20.0, 10 * DAY)
    return s.withColumn("nominal", r("nominal", 3)).withColumn("worst_gap", r("worst_gap", 3))


@query(MS + """, l AS (SELECT user_id, event_type, CASE WHEN event_id % 7 = 0 THEN substr(props, 2) ELSE props END AS line FROM e), v AS (SELECT user_id, event_type, count(*) FILTER (json_valid(line)) AS n FROM l GROUP BY 1, 2),
w AS (SELECT user_id, unnest(['view', 'click', 'purchase']) AS event_type FROM (SELECT DISTINCT user_id FROM e)), g AS (SELECT w.user_id, coalesce(n, 0) AS n FROM w LEFT JOIN v USING (user_id, event_type))
SELECT user_id, min(n) AS least_lines, count(*) FILTER (n < 5) AS n_short, min(n) >= 5 AS complete FROM g GROUP BY 1""")
def completeness(spark, d):
    e = events(spark, d)
    lines = e.select("user_id", "event_type", F.when(F.col("event_id") % 7 == 0, F.expr("substr(props, 2)")).otherwise(F.col("props")).alias("line"))
    return session.completeness(lines, e, "user_id", "event_type", "line", ["view", "click", "purchase"])


@query(MS + """, f AS (SELECT user_id, event_type, arg_min(t, event_id) AS t FROM e WHERE event_type IN ('view', 'click') GROUP BY 1, 2), g AS (SELECT user_id, min(t) AS t0 FROM e GROUP BY 1)
SELECT g.user_id, round(max(f.t - t0), 3) AS max_delay, count(f.t) AS n_cameras, CASE WHEN max(f.t - t0) IS NULL THEN 'skipped' WHEN max(f.t - t0) <= 86400000.0 THEN 'ok' ELSE 'shifted' END AS status FROM g LEFT JOIN f USING (user_id) GROUP BY 1""")
def trigger_delay(spark, d):
    e = _ms(spark, d)
    frames, triggers = e.where(F.col("event_type").isin("view", "click")), e.groupBy("user_id").agg(F.min("t").alias("t0"))
    return session.trigger_delay(frames, triggers, "user_id", "event_type", "t", "event_id", "t0", DAY).withColumn("max_delay", r("max_delay", 3))


GATES = MS + """, d AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id, event_type ORDER BY t) AS dt FROM e WHERE event_type IN ('view', 'click', 'purchase')),
s AS (SELECT user_id, event_type, min(t) AS a, max(t) AS z, count(*) FILTER (dt > CASE WHEN event_type = 'view' THEN 432000000.0 ELSE 518400000.0 END) AS g FROM d GROUP BY 1, 2),
f AS (SELECT s.*, v.a AS ra, v.z AS rz FROM s LEFT JOIN (SELECT * FROM s WHERE event_type = 'view') v USING (user_id)),
m AS (SELECT user_id, max(g) FILTER (event_type = 'view') AS n_tracker_gaps, coalesce(max(g) FILTER (event_type <> 'view'), 0) AS n_camera_gaps, CASE WHEN max(rz - ra) > 0 THEN CASE WHEN count(*) FILTER (event_type <> 'view') < 2 THEN 0.0 ELSE min(greatest(0.0, least(z, rz) - greatest(a, ra)) / (rz - ra)) FILTER (event_type <> 'view') END END AS camera_coverage, max(a) - min(a) AS start_spread_ms FROM f GROUP BY 1)"""


def _gates(spark, d):
    return session.gate_metrics(_ms(spark, d), "user_id", "event_type", "t", "view", ["click", "purchase"], 5 * DAY, 6 * DAY)


@query(GATES + " SELECT user_id, n_tracker_gaps, n_camera_gaps, round(camera_coverage, 6) AS camera_coverage, round(start_spread_ms, 3) AS start_spread_ms FROM m")
def gate_metrics(spark, d):
    return _gates(spark, d).withColumn("camera_coverage", r("camera_coverage")).withColumn("start_spread_ms", r("start_spread_ms", 3))


@query(GATES + """, x AS (SELECT *, coalesce(n_tracker_gaps >= 3, false) AS f1, coalesce(n_camera_gaps >= 5, false) AS f2, coalesce(camera_coverage < 0.65, false) AS f3, coalesce(start_spread_ms > 1000, false) AS f4,
least(1.0, greatest(0.5, CASE WHEN start_spread_ms / 100000.0 >= 250 THEN greatest(0.0, 1 - (start_spread_ms / 100000.0 - 250) / 10000.0) ELSE 1.0 END * CASE WHEN n_tracker_gaps > 0 THEN greatest(0.90, 1 - n_tracker_gaps * 0.03) ELSE 1.0 END)) AS penalty FROM m)
SELECT user_id, CASE WHEN f1 THEN 'tracker_continuity' WHEN f2 THEN 'camera_continuity' WHEN f3 THEN 'camera_coverage' END AS first_failed, CAST(f1 AS BIGINT) + CAST(f2 AS BIGINT) + CAST(f3 AS BIGINT) + CAST(f4 AS BIGINT) AS n_failed, round(penalty, 6) AS penalty,
round(CASE WHEN f1 OR f2 OR f3 THEN 0.0 ELSE least(100.0, greatest(0.0, coalesce(camera_coverage, 0.0) * penalty * 100.0)) END, 4) AS score FROM x""")
def session_check(spark, d):
    """Raw streams to gate metrics, gates, penalty and score."""
    m = _gates(spark, d)
    gates = [g for g in checks.SESSION_GATES if g.name in ("tracker_continuity", "camera_continuity", "camera_coverage", "stream_alignment")]
    failed = checks.first_failed_gate(checks.run_gates(m, "user_id", gates), "user_id")
    p = session.session_penalty(F.col("start_spread_ms") / 100000.0, F.col("n_tracker_gaps"))
    out = m.withColumn("penalty", p).join(failed, "user_id")
    return out.select("user_id", "first_failed", F.col("n_failed").cast("bigint").alias("n_failed"), r("penalty").alias("penalty"), r(session.session_score(F.col("blocked"), F.col("camera_coverage"), F.col("penalty")), 4).alias("score"))


@query(MS + """, o AS (SELECT user_id, t, CASE WHEN event_id % 5 <> 0 THEN value END AS v FROM e), n AS (SELECT user_id, count(v) AS n_ok, count(*) - count(v) AS n_missing FROM o GROUP BY 1),
d AS (SELECT *, abs(v - lag(v) OVER w) / greatest((t - lag(t) OVER w) / 1000.0, 1e-6) AS s FROM o WHERE v IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY t)),
s AS (SELECT user_id, avg(v) AS mean, stddev_pop(v) AS spread, min(v) AS low, max(v) AS high, max(s) AS speed_max, quantile_cont(s, 0.99) AS speed_p99, count(*) FILTER (s > 0.01) AS impossible_jumps FROM d GROUP BY 1 HAVING count(*) >= 2)
SELECT n.user_id, n_ok, n_missing, round(mean, 6) AS mean, round(spread, 6) AS spread, low, high, round(speed_max, 6) AS speed_max, round(speed_p99, 6) AS speed_p99, coalesce(impossible_jumps, 0) AS impossible_jumps FROM n LEFT JOIN s USING (user_id)""")
def physical_coherence(spark, d):
    e = _ms(spark, d).select("user_id", "t", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("v"))
    s = session.physical_coherence(e, ["user_id"], "t", "v", 0.01)
    return s.withColumns({c: r(c) for c in ("mean", "spread", "speed_max", "speed_p99")})


@query(MS + """, s AS (SELECT user_id, event_type, count(*) AS n, min(t) AS a, max(t) AS z FROM e GROUP BY 1, 2), j AS (SELECT v.user_id, v.n AS n_sensor, c.n AS n_camera, c.a - v.a AS delta, greatest(0.0, least(v.z, c.z) - greatest(v.a, c.a)) AS overlap FROM s v JOIN s c USING (user_id) WHERE v.event_type = 'view' AND c.event_type = 'click')
SELECT user_id, n_sensor, n_camera, round(delta, 3) AS delta_start, round(overlap, 3) AS overlap, abs(delta) < 2000 AND overlap > 5000 AS aligned, CASE WHEN abs(delta) > 2000 OR overlap < 3000 THEN 'error' WHEN abs(delta) > 500 THEN 'warn' ELSE 'ok' END AS status FROM j""")
def timing_level(spark, d):
    e = _ms(spark, d)
    s = session.timing_level(e.where("event_type = 'view'"), e.where("event_type = 'click'"), ["user_id"], "t")
    return s.withColumn("delta_start", r("delta_start", 3)).withColumn("overlap", r("overlap", 3))


@query("""SELECT event_id, strftime(ts + to_microseconds(CAST(round(value * 1000) AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso FROM events""")
def shift_iso(spark, d):
    e = table(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("iso"), "value")
    return e.select("event_id", session.shift_iso(F.col("iso"), F.col("value")).alias("iso"))


@query("""WITH m AS (SELECT *, median(value) OVER (PARTITION BY user_id) AS m FROM events), d AS (SELECT *, median(abs(value - m)) OVER (PARTITION BY user_id) AS mad, stddev_pop(value) OVER (PARTITION BY user_id) AS s, avg(value) OVER (PARTITION BY user_id) AS a FROM m)
SELECT event_id, round(CASE WHEN mad >= 1e-12 THEN (value - m) / (1.4826 * mad) WHEN s >= 1e-12 THEN (value - a) / s ELSE 0.0 END, 6) AS z FROM d WHERE value IS NOT NULL""")
def robust_normalize(spark, d):
    return session.robust_normalize(events(spark, d).where("value is not null"), ["user_id"], "value").select("event_id", r("z").alias("z"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity AS v, l_discount * 500 AS s FROM lineitem), n AS (SELECT *, CASE WHEN abs(v - 2) <= abs(v - 5) THEN 2.0 WHEN abs(v - 5) <= abs(v - 10) THEN 5.0 WHEN abs(v - 10) <= abs(v - 30) THEN 10.0 ELSE 30.0 END AS vs,
CASE WHEN abs(s - 2) <= abs(s - 5) THEN 2.0 WHEN abs(s - 5) <= abs(s - 10) THEN 5.0 WHEN abs(s - 10) <= abs(s - 30) THEN 10.0 ELSE 30.0 END AS ss FROM l)
SELECT l_orderkey, l_linenumber, CAST(vs AS DOUBLE) AS video_state, CAST(ss AS DOUBLE) AS sensor_state, abs(v - vs) <= 4.0001 AND abs(s - ss) <= 4.0001 AND vs = ss AS same_state FROM n""")
def state_columns(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("v"), (F.col("l_discount") * 500).alias("s"))
    return session.state_columns(x, "v", "s", 4.0001).select("l_orderkey", "l_linenumber", "video_state", "sensor_state", "same_state")


@query(MS + """, x AS (SELECT user_id, event_id, value / 1000.0 AS v FROM e), g AS (SELECT *, lag(v) OVER w AS b, lead(v) OVER w AS n FROM x WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
h AS (SELECT user_id, v, abs(CASE WHEN b IS NULL AND n IS NULL THEN 0.0 WHEN b IS NULL THEN n - v WHEN n IS NULL THEN v - b ELSE (n - b) / 2 END) AS s FROM g)
SELECT user_id, round(0.6 * least(var_pop(v) / 0.05, 1.0) + 0.4 * least(quantile_cont(s, 0.95) / 0.05, 1.0), 6) AS quality FROM h GROUP BY 1""")
def signal_quality(spark, d):
    e = events(spark, d).select("user_id", "event_id", (F.col("value") / 1000.0).alias("v"))
    return session.signal_quality(e, ["user_id"], "event_id", "v").withColumn("quality", r("quality"))


@query("""WITH c AS (SELECT o_custkey, CASE o_orderkey % 3 WHEN 0 THEN 'head' WHEN 1 THEN 'left' ELSE 'right' END AS label, CASE WHEN o_orderstatus <> 'P' THEN CASE o_orderkey % 4 WHEN 0 THEN 'head' WHEN 1 THEN 'left' ELSE 'right' END END AS tl, CASE WHEN o_orderpriority < '4' THEN o_orderkey % 3 = 0 AND o_orderpriority < '3' END AS fi FROM orders)
SELECT o_custkey, CAST(sum(CAST(tl IS NOT NULL AS INTEGER) + CAST(fi IS NOT NULL AS INTEGER)) AS BIGINT) AS n_checks, CAST(sum(CAST(coalesce(tl = label, false) AS INTEGER) + CAST(coalesce(fi = (label = 'head'), false) AS INTEGER)) AS BIGINT) AS n_agree, count(*) FILTER (fi <> (label = 'head')) AS n_warnings,
round(coalesce(sum(CAST(coalesce(tl = label, false) AS INTEGER) + CAST(coalesce(fi = (label = 'head'), false) AS INTEGER)) / nullif(sum(CAST(tl IS NOT NULL AS INTEGER) + CAST(fi IS NOT NULL AS INTEGER)), 0), 0.0), 6) AS confidence FROM c GROUP BY 1""")
def camera_verdicts(spark, d):
    k = F.col("o_orderkey")
    name = lambda x: F.when(x == 0, "head").when(x == 1, "left").otherwise("right")
    c = table(spark, d, "orders").select("o_custkey", name(k % 3).alias("label"), F.when(F.col("o_orderstatus") != "P", name(k % 4)).alias("tracker_label"), F.when(F.col("o_orderpriority") < "4", (k % 3 == 0) & (F.col("o_orderpriority") < "3")).alias("is_fisheye"))
    return session.camera_verdicts(c, "o_custkey").withColumn("confidence", r("confidence"))


@query("""SELECT o_custkey, string_agg(o_orderpriority, ',' ORDER BY o) AS repairs FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS o FROM orders GROUP BY 1, 2) GROUP BY 1""")
def distinct_repairs(spark, d):
    x = session.distinct_repairs(table(spark, d, "orders"), "o_custkey", "o_orderkey", "o_orderpriority")
    return x.select("o_custkey", F.array_join("repairs", ",").alias("repairs"))


@query(MS + """, s AS (SELECT user_id, event_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS dt FROM e), m AS (SELECT *, coalesce(dt, median(dt) OVER (PARTITION BY user_id)) AS d FROM s) SELECT event_id, round(CASE WHEN d > 1e-9 THEN d END, 3) AS dt FROM m""")
def guarded_steps(spark, d):
    return session.guarded_steps(_ms(spark, d), ["user_id"], "t").select("event_id", r("dt", 3).alias("dt"))


#: Embeddings as tracker rows: ten rows of blocks 0, 1, 2 a session.
BLOCKS = """WITH b AS (SELECT vec_id // 40 AS session, vec_id % 4 AS block, (vec_id % 40) // 4 AS row, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z, CAST(embedding[4] AS DOUBLE) AS w0, CAST(embedding[5] AS DOUBLE) AS x0, CAST(embedding[6] AS DOUBLE) AS y0, CAST(embedding[7] AS DOUBLE) AS z0 FROM embeddings WHERE vec_id % 4 < 3)"""


def _blocks(spark, d):
    e = table(spark, d, "embeddings").where("vec_id % 4 < 3").withColumn("e", F.col("embedding").cast("array<double>"))
    return e.select((F.col("vec_id") / 40).cast("bigint").alias("session"), (F.col("vec_id") % 4).alias("block"), F.floor(F.col("vec_id") % 40 / 4).alias("row"), F.slice("e", 1, 3).alias("pos"), F.slice("e", 4, 4).alias("quat"))


TESTS = BLOCKS + """, st AS (SELECT *, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2 + (z - lag(z) OVER w) ** 2) AS step FROM b WINDOW w AS (PARTITION BY session, block ORDER BY row)),
own AS (SELECT session, block, median(y) AS height, stddev_pop(y) AS spread, median(step) AS mobility FROM st GROUP BY 1, 2),
pr AS (SELECT p.session, p.block, q.block AS other, median(sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2 + (p.z - q.z) ** 2)) AS d FROM b p JOIN b q ON p.session = q.session AND p.row = q.row AND p.block <> q.block GROUP BY 1, 2, 3),
far AS (SELECT session, block, avg(d) AS far FROM pr GROUP BY 1, 2),
hh AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY height DESC, block) AS k, count(*) OVER (PARTITION BY session) AS c FROM own),
ht AS (SELECT session, max(block) FILTER (k = 1) AS v, (max(height) FILTER (k = 1) - max(height) FILTER (k = 2)) / greatest(max(spread) FILTER (k = 1), max(spread) FILTER (k = 2), 1e-6) AS z FROM hh WHERE c = 3 GROUP BY 1),
low AS (SELECT session, test, block, val, row_number() OVER (PARTITION BY session, test ORDER BY val, block) AS k, count(*) OVER (PARTITION BY session, test) AS c FROM (SELECT session, 'centrality' AS test, block, far AS val FROM far UNION ALL SELECT session, 'mobility', block, mobility FROM own)),
tests AS (SELECT session, 'height' AS test, v AS head_vote, least(1.0, greatest(0.0, z / 10.0)) AS confidence, z AS zscore FROM ht UNION ALL
SELECT session, test, max(block) FILTER (k = 1), least(1.0, greatest(0.0, (max(val) FILTER (k = 2) - max(val) FILTER (k = 1)) / (max(val) - min(val) + 1e-9))), NULL FROM low WHERE c = 3 GROUP BY 1, 2)"""


@query(TESTS + " SELECT session, test, head_vote, round(confidence, 6) AS confidence, round(zscore, 6) AS zscore FROM tests")
def head_tests(spark, d):
    return roles.head_tests(_blocks(spark, d), "session", "block", "row").withColumn("confidence", r("confidence")).withColumn("zscore", r("zscore"))


@query(TESTS + """, vt AS (SELECT session, head_vote, count(*) AS n, min(CASE test WHEN 'height' THEN 0 WHEN 'centrality' THEN 1 ELSE 2 END) AS o FROM tests GROUP BY 1, 2), hd AS (SELECT session, head_vote AS head, n FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY n DESC, o) AS k FROM vt) WHERE k = 1),
hb AS (SELECT b.*, sqrt(w0 ** 2 + x0 ** 2 + y0 ** 2 + z0 ** 2) AS nn FROM b JOIN hd ON b.session = hd.session AND b.block = hd.head),
ax AS (SELECT session, avg(1 - 2 * ((y0 / nn) ** 2 + (z0 / nn) ** 2)) AS a0, avg(2 * (x0 * y0 + w0 * z0) / nn ** 2) AS a1, avg(2 * (x0 * z0 - w0 * y0) / nn ** 2) AS a2 FROM hb GROUP BY 1),
rl AS (SELECT b.session, b.block, avg(b.x - hb.x) AS d0, avg(b.y - hb.y) AS d1, avg(b.z - hb.z) AS d2, min(b.x) AS lo, max(b.x) AS hi FROM b JOIN hb ON b.session = hb.session AND b.row = hb.row AND b.block <> hb.block GROUP BY 1, 2),
pj AS (SELECT rl.session, block, lo, hi, (d0 * a0 + d1 * a1 + d2 * a2) / (sqrt(a0 ** 2 + a1 ** 2 + a2 ** 2) + 1e-12) AS p FROM rl JOIN ax USING (session)),
lt AS (SELECT session, arg_max(block, p) AS r, arg_min(block, p) AS l, least(1.0, greatest(0.0, (max(p) - min(p)) / (max(hi) - min(lo) + 1e-6))) AS c FROM pj GROUP BY 1)
SELECT session, head, lt.r AS "right", lt.l AS "left", n + 1 AS n_agree, (z >= 5.0 AND n + 1 >= 3) OR (z >= 2.0 AND n + 1 >= 4) AS certain, round(c, 6) AS confidence FROM hd JOIN ht USING (session) JOIN lt USING (session)""")
def role_consensus(spark, d):
    return roles.role_consensus(_blocks(spark, d), "session", "block", "row").drop("zscore").withColumn("confidence", r("confidence"))


@query(BLOCKS + """, v AS (SELECT session, row, block, unnest([0, 0, 1, 1, 2, 2]) AS axis, unnest([-1, 1, -1, 1, -1, 1]) AS sign, unnest([-x, x, -y, y, -z, z]) AS v FROM b),
g AS (SELECT *, count(*) OVER w AS n, v - (sum(v) OVER w - v) / (count(*) OVER w - 1) AS gap, row_number() OVER (PARTITION BY session, row, axis, sign ORDER BY v DESC, block) = 1 AS won FROM v WINDOW w AS (PARTITION BY session, row, axis, sign)),
m AS (SELECT session, block, axis, sign, median(gap) AS med, avg(CAST(won AS INTEGER)) AS win, avg(CAST(gap > 0 AS INTEGER)) AS above FROM g WHERE n = 3 GROUP BY 1, 2, 3, 4),
a AS (SELECT g.session, g.block, g.axis, g.sign, median(abs(gap - med)) + 1e-9 AS mad FROM g JOIN m ON g.session = m.session AND g.block = m.block AND g.axis = m.axis AND g.sign = m.sign WHERE n = 3 GROUP BY 1, 2, 3, 4),
s AS (SELECT session, block, axis, sign, win, 2.5 * win + 2.0 * above + 1.5 * greatest(0.0, least(50.0, greatest(-50.0, med / mad))) AS score FROM m JOIN a USING (session, block, axis, sign))
SELECT session, block AS head, axis, sign, round(score, 6) AS score, round(win, 6) AS win_rate FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY round(score, 9) DESC, axis, sign, block) AS k FROM s) WHERE k = 1""")
def infer_head(spark, d):
    return roles.infer_head(_blocks(spark, d), "session", "block", "row").withColumn("score", r("score")).withColumn("win_rate", r("win_rate"))


#: Embeddings as tracker rows, all of them: twenty rows of blocks 0, 1, 2 a session; a last row without its blocks does not count.
TRIPLES = """WITH b0 AS (SELECT vec_id // 60 AS session, vec_id % 3 AS block, (vec_id % 60) // 3 AS row, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z, CAST(embedding[4] AS DOUBLE) AS w0, CAST(embedding[5] AS DOUBLE) AS x0, CAST(embedding[6] AS DOUBLE) AS y0, CAST(embedding[7] AS DOUBLE) AS z0 FROM embeddings),
b AS (SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY session, row) AS n FROM b0) WHERE n = 3),
hv AS (SELECT session, row, block, unnest([0, 0, 1, 1, 2, 2]) AS axis, unnest([-1, 1, -1, 1, -1, 1]) AS sign, unnest([-x, x, -y, y, -z, z]) AS v FROM b),
hg AS (SELECT *, v - (sum(v) OVER w - v) / 2 AS gap, row_number() OVER (PARTITION BY session, row, axis, sign ORDER BY v DESC, block) = 1 AS won FROM hv WINDOW w AS (PARTITION BY session, row, axis, sign)),
hm AS (SELECT session, block, axis, sign, median(gap) AS med, avg(CAST(won AS INTEGER)) AS win, avg(CAST(gap > 0 AS INTEGER)) AS above FROM hg GROUP BY 1, 2, 3, 4),
ha AS (SELECT hg.session, hg.block, hg.axis, hg.sign, median(abs(gap - med)) + 1e-9 AS mad FROM hg JOIN hm USING (session, block, axis, sign) GROUP BY 1, 2, 3, 4),
hs AS (SELECT session, block, axis, sign, 2.5 * win + 2.0 * above + 1.5 * greatest(0.0, least(50.0, greatest(-50.0, med / mad))) AS score FROM hm JOIN ha USING (session, block, axis, sign)),
hd AS (SELECT session, block AS head, axis, sign, score FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY score DESC, axis, sign, block) AS k FROM hs) WHERE k = 1),
hq AS (SELECT b.session, b.row, hd.axis AS up, x AS hx, y AS hy, z AS hz, w0 / nn AS w, x0 / nn AS i, y0 / nn AS j, z0 / nn AS k FROM (SELECT *, sqrt(w0 ** 2 + x0 ** 2 + y0 ** 2 + z0 ** 2) AS nn FROM b) b JOIN hd ON b.session = hd.session AND b.block = hd.head),
ax AS (SELECT session, row, up, hx, hy, hz, unnest([0, 1, 2]) AS l, unnest([1 - 2 * (j * j + k * k), 2 * (i * j - w * k), 2 * (i * k + w * j)]) AS ux, unnest([2 * (i * j + w * k), 1 - 2 * (i * i + k * k), 2 * (j * k - w * i)]) AS uy, unnest([2 * (i * k - w * j), 2 * (j * k + w * i), 1 - 2 * (i * i + j * j)]) AS uz FROM hq),
pr AS (SELECT ax.session, ax.row, l, b.block, abs(CASE up WHEN 0 THEN ux WHEN 1 THEN uy ELSE uz END) / sqrt(ux * ux + uy * uy + uz * uz) AS align, ux * (x - hx) + uy * (y - hy) + uz * (z - hz) AS p FROM ax JOIN b USING (session, row) JOIN hd ON hd.session = ax.session AND b.block <> hd.head),
df AS (SELECT session, row, l, min(block) AS a, max(block) AS o, any_value(align) AS align, arg_min(p, block) - arg_max(p, block) AS d FROM pr GROUP BY 1, 2, 3),
lm AS (SELECT session, l, any_value(a) AS a, any_value(o) AS o, avg(align) AS align, median(d) AS med, median(abs(d)) AS far FROM df GROUP BY 1, 2),
ls AS (SELECT df.session, df.l, median(abs(d - med)) + 1e-9 AS mad, avg(CAST(abs(d) > 0.25 * far + 1e-9 AS INTEGER)) AS apart FROM df JOIN lm USING (session, l) GROUP BY 1, 2),
lu AS (SELECT lm.*, mad, apart, greatest(0.0, least(50.0, far / mad)) AS sep, first_value(lm.l) OVER (PARTITION BY session ORDER BY lm.align DESC, lm.l) AS ul, max(lm.align) OVER (PARTITION BY session) AS us FROM lm JOIN ls USING (session, l)),
lc AS (SELECT *, 2 * sep + apart + 0.5 * us - 2 * align AS score FROM lu WHERE l <> ul),
lr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY score DESC, l) AS k FROM lc) WHERE k = 1)"""


def _triples(spark, d):
    e = table(spark, d, "embeddings").withColumn("e", F.col("embedding").cast("array<double>"))
    return e.select((F.col("vec_id") / 60).cast("bigint").alias("session"), (F.col("vec_id") % 3).alias("block"), F.floor(F.col("vec_id") % 60 / 3).alias("row"), F.slice("e", 1, 3).alias("pos"), F.slice("e", 4, 4).alias("quat"))


@query(TRIPLES + """ SELECT session, CASE WHEN med >= 0 THEN o ELSE a END AS "left", CASE WHEN med >= 0 THEN a ELSE o END AS "right", ul AS up_local, l AS right_local, round(score, 6) AS score, round(sep, 6) AS separation, round(apart, 6) AS consistency, round(align, 6) AS vertical_penalty FROM lr""")
def infer_left_right(spark, d):
    x = _triples(spark, d)
    s = roles.infer_left_right(x, roles.infer_head(x, "session", "block", "row"), "session", "block", "row")
    return s.withColumns({c: r(c) for c in ("score", "separation", "consistency", "vertical_penalty")})


@query(TRIPLES + """, n AS (SELECT session, count(DISTINCT row) FILTER (c = 3) AS n_rows FROM (SELECT session, row, count(*) OVER (PARTITION BY session, row) AS c FROM b0) GROUP BY 1),
g AS (SELECT n.session, n_rows, head, CASE WHEN med >= 0 THEN o ELSE a END AS lf, CASE WHEN med >= 0 THEN a ELSE o END AS rt, axis, sign, 0.55 / (1 + exp(4.0 - greatest(-50.0, least(50.0, hd.score)))) + 0.45 / (1 + exp(2.5 - greatest(-50.0, least(50.0, lr.score)))) AS c FROM n LEFT JOIN (hd JOIN lr USING (session)) USING (session)),
v AS (SELECT session, string_agg(CASE WHEN role <> now THEN role || '>' || now END, ',' ORDER BY block) AS swaps, count(*) FILTER (role = now) AS same FROM (SELECT session, block, ['head', 'left', 'right'][block + 1] AS role, CASE block WHEN head THEN 'head' WHEN lf THEN 'left' ELSE 'right' END AS now FROM (SELECT *, unnest([0, 1, 2]) AS block FROM g) WHERE n_rows >= 10) GROUP BY 1)
SELECT session, CASE WHEN n_rows >= 10 THEN head END AS head, CASE WHEN n_rows >= 10 THEN lf END AS "left", CASE WHEN n_rows >= 10 THEN rt END AS "right", round(CASE WHEN n_rows >= 10 THEN c ELSE 0.0 END, 6) AS confidence, CASE WHEN n_rows >= 10 THEN axis END AS axis, CASE WHEN n_rows >= 10 THEN sign END AS sign, n_rows, n_rows >= 10 AND same < 3 AS swapped, coalesce(swaps, '') AS swaps, CASE WHEN n_rows < 10 THEN 'too few rows' END AS error FROM g LEFT JOIN v USING (session)""")
def infer_roles(spark, d):
    x = _triples(spark, d)
    hints = x.select("session", "block").distinct().withColumn("role", F.element_at(F.array(*map(F.lit, ("head", "left", "right"))), (F.col("block") + 1).cast("int")))
    s = roles.infer_roles(x, "session", "block", "row", hints)
    return s.withColumn("confidence", r("confidence")).withColumn("swaps", F.array_join("swaps", ",")).withColumn("swapped", F.coalesce("swapped", F.lit(False)))


#: Users as sessions, minutes as the time: views are the tracker, clicks, errors and sign-ups the cameras. The customer of the
#: same number is the metadata; sign-ups of some segments are no camera, so that those sessions lack one.
SESSION_STREAMS = """WITH e AS (SELECT user_id AS u, epoch_us(ts) / 6e7 AS t, value, value >= 0.3 AS valid, c_acctbal, c_mktsegment, CASE event_type WHEN 'view' THEN 'tracker' WHEN 'click' THEN 'cam_head' WHEN 'error' THEN 'cam_left' WHEN 'signup' THEN CASE WHEN c_mktsegment = 'MACHINERY' THEN 'spare' ELSE 'cam_right' END ELSE 'spare' END AS stream FROM events LEFT JOIN customer ON c_custkey = user_id),
ss AS (SELECT u, coalesce(max(c_acctbal) >= -700, false) AS metadata_ok, CASE WHEN max(c_mktsegment) <> 'FURNITURE' THEN min(t) FILTER (stream = 'tracker') - abs(max(c_acctbal)) / 10 END AS trigger FROM e GROUP BY 1),
d AS (SELECT *, t - lag(t) OVER (PARTITION BY u, stream ORDER BY t) AS dt FROM e WHERE stream <> 'spare'),
s AS (SELECT u, stream, count(*) AS n, min(t) AS a, max(t) AS z, count(*) FILTER (dt > CASE WHEN stream = 'tracker' THEN 7200.0 ELSE 10080.0 END) AS g, avg(CAST(NOT valid AS INTEGER)) AS bad FROM d GROUP BY 1, 2),
w AS (SELECT ss.*, st.stream, n, a, z, g, bad FROM ss CROSS JOIN (VALUES ('tracker'), ('cam_head'), ('cam_left'), ('cam_right')) st(stream) LEFT JOIN s ON s.u = ss.u AND s.stream = st.stream),
f0 AS (SELECT u, bool_and(metadata_ok) AS has_metadata, count(*) FILTER (n IS NULL) AS n_missing_files, coalesce(max(bad) FILTER (stream = 'tracker'), 0.0) AS inv, coalesce(max(g) FILTER (stream = 'tracker' AND n >= 2), 0) AS ntg, coalesce(max(g) FILTER (stream <> 'tracker'), 0) AS ncg,
  max(a) FILTER (stream = 'tracker' AND n >= 2) AS ra, max(z) FILTER (stream = 'tracker' AND n >= 2) AS rz, coalesce(max(abs(a - trigger)) FILTER (stream <> 'tracker'), 0.0) AS off FROM w GROUP BY 1),
cv AS (SELECT w.u, min(CASE WHEN coalesce(n, 0) < 2 THEN 0.0 ELSE greatest(0.0, least(z, rz) - greatest(a, ra)) / (rz - ra + 1e-6) END) AS cov FROM w JOIN f0 USING (u) WHERE stream <> 'tracker' GROUP BY 1),
f AS (SELECT f0.*, CASE WHEN rz - ra > 0 THEN least(1.0, cov) END AS coverage FROM f0 JOIN cv USING (u)),
b AS (SELECT *, CASE WHEN n_missing_files > 0 THEN 0 WHEN NOT has_metadata THEN 1 WHEN inv > 0.05 THEN 2 WHEN ntg >= 3 THEN 3 WHEN ncg >= 5 THEN 4 WHEN coverage < 0.65 THEN 5 END AS gate,
  least(1.0, greatest(0.5, CASE WHEN off >= 250 THEN greatest(0.0, 1 - (off - 250) / 10000.0) ELSE 1.0 END * CASE WHEN ntg > 0 THEN greatest(0.90, 1 - ntg * 0.03) ELSE 1.0 END)) AS penalty FROM f)"""
CHECK = SESSION_STREAMS + """,
v AS (SELECT e.u, stream, t, value FROM e JOIN b ON b.u = e.u AND gate IS NULL WHERE stream <> 'spare' AND value IS NOT NULL),
en AS (SELECT u, stream, min(t) AS a, max(t) AS z, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM v GROUP BY 1, 2 HAVING count(*) >= 6),
p AS (SELECT a.u, b.stream AS tgt, greatest(a.a, b.a) AS st, least(a.z, b.z) AS sp FROM en a JOIN en b ON a.u = b.u AND a.stream = 'tracker' AND b.stream <> 'tracker'),
gt AS (SELECT u, tgt, i, st + i * 360.0 AS t, 'tracker' AS ref FROM (SELECT *, unnest(range(0, CAST(ceil((sp - st) / 360) AS BIGINT))) AS i FROM p WHERE sp - st >= 7200 AND ceil((sp - st) / 360) >= 16)),
iv AS (SELECT u, stream, t, c AS v, lead(t) OVER w AS t2, lead(c) OVER w AS v2 FROM (SELECT v.*, least(hi, greatest(lo, value)) AS c FROM v JOIN en USING (u, stream)) WINDOW w AS (PARTITION BY u, stream ORDER BY t)),
xx AS (SELECT gt.*, CASE WHEN iv.t = gt.t OR t2 IS NULL THEN v ELSE v + (v2 - v) * (gt.t - iv.t) / (t2 - iv.t) END AS x FROM gt ASOF JOIN iv ON gt.u = iv.u AND gt.ref = iv.stream AND gt.t >= iv.t),
xy AS (SELECT xx.u, xx.tgt, i, x, CASE WHEN iv.t = xx.t OR t2 IS NULL THEN v ELSE v + (v2 - v) * (xx.t - iv.t) / (t2 - iv.t) END AS y FROM xx ASOF JOIN iv ON xx.u = iv.u AND xx.tgt = iv.stream AND xx.t >= iv.t),
zs AS (SELECT u, tgt, i, count(*) OVER w AS n, (x - avg(x) OVER w) / (stddev_pop(x) OVER w + 1e-8) AS x, (y - avg(y) OVER w) / (stddev_pop(y) OVER w + 1e-8) AS y FROM xy WINDOW w AS (PARTITION BY u, tgt)),
c1 AS (SELECT u, tgt, CASE WHEN stddev_pop(x) < 1e-8 OR stddev_pop(y) < 1e-8 THEN 0.0 ELSE corr(x, y) END AS c, CASE WHEN stddev_pop(x * x) < 1e-8 OR stddev_pop(y * y) < 1e-8 THEN 0.0 ELSE corr(x * x, y * y) END AS ec FROM zs GROUP BY 1, 2),
ft AS (SELECT u, tgt, k, sqrt(sum(x * cos(2 * pi() * i * k / n)) ** 2 + sum(x * sin(2 * pi() * i * k / n)) ** 2) AS fx, sqrt(sum(y * cos(2 * pi() * i * k / n)) ** 2 + sum(y * sin(2 * pi() * i * k / n)) ** 2) AS fy FROM (SELECT *, unnest(range(0, n // 2 + 1)) AS k FROM zs) GROUP BY 1, 2, 3),
c2 AS (SELECT u, tgt, CASE WHEN stddev_pop(fx) < 1e-8 OR stddev_pop(fy) < 1e-8 THEN 0.0 ELSE corr(fx, fy) END AS sc FROM ft GROUP BY 1, 2),
ls AS (SELECT u, tgt, i, x AS v, 'x' AS side FROM zs UNION ALL SELECT u, tgt, i, y, 'y' FROM zs),
ch AS (SELECT *, CASE WHEN v = lag(v) OVER w THEN 0 ELSE 1 END AS new, quantile_cont(v, 0.75) OVER (PARTITION BY u, tgt, side) AS q FROM ls WINDOW w AS (PARTITION BY u, tgt, side ORDER BY i)),
il AS (SELECT *, sum(new) OVER (PARTITION BY u, tgt, side ORDER BY i) AS k FROM ch),
ie AS (SELECT u, tgt, side, k, min(i) AS i0, max(i) AS i1, max(v) AS v, max(q) AS q FROM il GROUP BY 1, 2, 3, 4),
pk AS (SELECT u, tgt, side, (i0 + i1) // 2 AS i FROM (SELECT *, lag(v) OVER w AS before, lead(v) OVER w AS after FROM ie WINDOW w AS (PARTITION BY u, tgt, side ORDER BY k)) WHERE before < v AND after < v AND v >= q),
mt AS (SELECT a.u, a.tgt, a.side, a.i, bool_or(coalesce(abs(b.i - a.i) <= 4, false)) AS hit FROM pk a LEFT JOIN pk b ON a.u = b.u AND a.tgt = b.tgt AND a.side <> b.side GROUP BY 1, 2, 3, 4),
mr AS (SELECT u, tgt, CASE WHEN count(DISTINCT side) = 2 THEN (avg(CAST(hit AS INTEGER)) FILTER (side = 'x') + avg(CAST(hit AS INTEGER)) FILTER (side = 'y')) / 2 ELSE 0.0 END AS m FROM mt GROUP BY 1, 2),
al AS (SELECT u, count(*) AS n_pairs, avg(least(1.0, 0.42 * greatest(c, 0.0) + 0.28 * greatest(ec, 0.0) + 0.20 * coalesce(m, 0.0) + 0.10 * greatest(sc, 0.0))) AS a FROM c1 JOIN c2 USING (u, tgt) LEFT JOIN mr USING (u, tgt) GROUP BY 1)
SELECT b.u AS user_id, (['structure', 'metadata', 'quaternions', 'tracker_continuity', 'camera_continuity', 'camera_coverage'])[gate + 1] AS blocked_by, CAST(coalesce(gate + 1, 6) AS INTEGER) AS n_gates, n_missing_files, ncg AS n_camera_gaps, round(coverage, 6) AS camera_coverage, coalesce(n_pairs, 0) AS n_pairs,
round(CASE WHEN gate IS NULL THEN coalesce(a, 0.0) END, 6) AS alignment, round(penalty, 6) AS penalty, CASE WHEN gate IS NULL THEN round(least(100.0, greatest(0.0, coalesce(a, 0.0) * penalty * 100)), 1) ELSE 0.0 END AS score FROM b LEFT JOIN al USING (u)"""
LAYOUT = sc.Layout(tracker_gap=7200.0, camera_gap=10_080.0, step=360.0, least_overlap=7200.0, least_rows=6)


def _raw_sessions(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_acctbal", "c_mktsegment")
    e = events(spark, d).join(c, "user_id", "left")
    kind = F.col("event_type")
    stream = F.when(kind == "view", "tracker").when(kind == "click", "cam_head").when(kind == "error", "cam_left").when((kind == "signup") & ~F.coalesce(F.col("c_mktsegment") == "MACHINERY", F.lit(False)), "cam_right").otherwise("spare")
    e = e.select("user_id", stream.alias("stream"), (F.col("us") / 6e7).alias("t"), "value", (F.col("value") >= 0.3).alias("valid"), "c_acctbal", "c_mktsegment")
    trigger = F.when(F.max("c_mktsegment") != "FURNITURE", F.min(F.when(F.col("stream") == "tracker", F.col("t"))) - F.abs(F.max("c_acctbal")) / 10)
    sessions = e.groupBy("user_id").agg(F.coalesce(F.max("c_acctbal") >= -700, F.lit(False)).alias("metadata_ok"), trigger.alias("trigger"))
    return sessions, e.select("user_id", "stream", "t", "value", "valid")


@query(CHECK)
def check_sessions(spark, d):
    """Raw streams to gates in order, alignment of the pairs on common grids, penalty and score; a session without a camera is blocked."""
    x = sc.check_sessions(*_raw_sessions(spark, d), "user_id", LAYOUT)
    return x.select("user_id", "blocked_by", F.size("gates").alias("n_gates"), "n_missing_files", "n_camera_gaps", r("camera_coverage").alias("camera_coverage"), "n_pairs", r("alignment").alias("alignment"), r("penalty").alias("penalty"), "score")


#: Six dimensions of users as sessions: orientation from the metadata, health and clock of the purchases as the gripper, the
#: session check, gaps of the cameras, and how purchases follow clicks by day. Each is missing where its streams are.
FULL = "WITH ck AS (" + CHECK + """),
e AS (SELECT user_id AS u, epoch_us(ts) / 6e7 AS t, event_type AS k, value FROM events), ids AS (SELECT DISTINCT u FROM e),
ori AS (SELECT u, 'video_orientation' AS name, CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 2000 THEN 0.0 ELSE 100.0 END AS score, 0.95 AS confidence, c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 2000 AS blocking, CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 2000 THEN 'upside down' END AS reason, CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 2000 THEN 'rotate' END AS repair FROM ids JOIN customer ON c_custkey = u WHERE c_mktsegment <> 'BUILDING'),
hz AS (SELECT u, avg(CASE WHEN floor(value / 20) = 0 THEN 1.0 ELSE 0.0 END) AS z FROM e WHERE k = 'purchase' GROUP BY 1),
hea AS (SELECT u, 'gripper_health' AS name, 100.0 AS score, 0.9 AS confidence, z > 0.80 AS blocking, CASE WHEN z > 0.80 THEN 'stuck' END AS reason, CASE WHEN z > 0.80 THEN 'replace' END AS repair FROM hz),
sp AS (SELECT u, k, min(t) AS a, max(t) AS z FROM e WHERE k IN ('purchase', 'click') GROUP BY 1, 2),
tl AS (SELECT p.u, abs(c.a - p.a) AS far, greatest(0.0, least(p.z, c.z) - greatest(p.a, c.a)) AS overlap FROM sp p JOIN sp c ON p.u = c.u AND p.k = 'purchase' AND c.k = 'click'),
tim AS (SELECT u, 'gripper_ts' AS name, CASE WHEN far > 2000 OR overlap < 3000 THEN 40.0 WHEN far > 500 THEN 80.0 ELSE 100.0 END AS score, 0.9 AS confidence, false AS blocking, NULL AS reason, CASE WHEN far > 2000 OR overlap < 3000 THEN 'trim' END AS repair FROM tl),
syn AS (SELECT user_id AS u, 'video_tracker_sync' AS name, score, 0.9 AS confidence, blocked_by IS NOT NULL AS blocking, blocked_by AS reason, CASE WHEN blocked_by IS NOT NULL THEN CASE WHEN blocked_by LIKE 'camera%' THEN 'shift_and_window' END END AS repair FROM ck),
qua AS (SELECT user_id AS u, 'video_quality' AS name, 100.0 - least(40.0, 15.0 * n_camera_gaps) AS score, 0.85 AS confidence, false AS blocking, NULL AS reason, CASE WHEN n_camera_gaps > 0 THEN 'repair_camera_gaps' END AS repair FROM ck),
dy AS (SELECT u, floor(t / 1440) AS d, avg(value) FILTER (k = 'purchase') AS x, avg(value) FILTER (k = 'click') AS y FROM e GROUP BY 1, 2 HAVING x IS NOT NULL AND y IS NOT NULL),
fr AS (SELECT u, count(*) AS n, CASE WHEN count(*) < 3 OR stddev_pop(x) < 1e-8 OR stddev_pop(y) < 1e-8 THEN 0.0 ELSE corr(x, y) END AS r FROM dy GROUP BY 1),
fra AS (SELECT u, 'gripper_frame_sync' AS name, CASE WHEN n < 4 THEN 50.0 ELSE round(50 + 50 * r, 3) END AS score, least(0.9, 0.1 * n) AS confidence, false AS blocking, NULL AS reason, CASE WHEN n >= 4 AND r < 0 THEN 'shift' END AS repair FROM fr),
al AS (SELECT * FROM ori UNION ALL SELECT * FROM hea UNION ALL SELECT * FROM tim UNION ALL SELECT * FROM syn UNION ALL SELECT * FROM qua UNION ALL SELECT * FROM fra),
sl AS (SELECT ids.u, o.name, o.w, o.o, coalesce(al.score, 50.0) AS score, al.score IS NULL AS missing, CASE WHEN al.score IS NULL THEN 0.0 ELSE al.confidence END AS confidence, coalesce(al.blocking, false) AS blocking, al.reason, al.repair
  FROM ids CROSS JOIN (VALUES ('video_orientation', 0.0, 0), ('gripper_health', 0.0, 1), ('gripper_ts', 0.25, 2), ('video_tracker_sync', 0.30, 3), ('video_quality', 0.15, 4), ('gripper_frame_sync', 0.30, 5)) o(name, w, o) LEFT JOIN al ON al.u = ids.u AND al.name = o.name),
vg AS (SELECT *, NOT blocking AND (missing OR (abs(score - 50) < 1 AND confidence < 0.5)) AS vague FROM sl), lw AS (SELECT *, NOT vague AND score < CASE WHEN name = 'gripper_frame_sync' THEN 45 ELSE 60 END AS low FROM vg),
gg AS (SELECT u, sum(w * score) FILTER (NOT vague AND w > 0) / sum(w) FILTER (NOT vague AND w > 0) AS s1, sum(w * score) / sum(w) AS s2, sum(w * confidence) / sum(w) AS confidence, arg_min('[' || name || '] ' || coalesce(reason, ''), o) FILTER (blocking) AS stop, 'too low: ' || string_agg(name || '=' || CAST(round_even(score, 0) AS INTEGER), ', ' ORDER BY o) FILTER (low) AS lows,
  coalesce(string_agg(name, ',' ORDER BY o) FILTER (vague AND NOT missing), '') AS inconclusive, coalesce(string_agg(name, ',' ORDER BY o) FILTER (missing), '') AS missing, coalesce(string_agg(repair, ',' ORDER BY o), '') AS repairs FROM lw GROUP BY 1),
fs AS (SELECT *, least(100.0, greatest(0.0, coalesce(s1, s2))) AS score, coalesce(stop, lows) AS blocking_reason FROM gg)
SELECT u AS user_id, round(score, 4) AS score, CASE WHEN score >= 90 THEN 'A' WHEN score >= 75 THEN 'B' WHEN score >= 60 THEN 'C' WHEN score >= 45 THEN 'D' ELSE 'F' END AS grade, CASE WHEN blocking_reason IS NOT NULL THEN 'BLOCKED' WHEN score >= 95 THEN 'PERFECT' WHEN score >= 75 THEN 'ACCEPTABLE' WHEN score >= 45 THEN 'ISSUES' ELSE 'FAILED' END AS verdict, blocking_reason IS NOT NULL AS blocked, blocking_reason, round(confidence, 6) AS confidence, inconclusive, missing, repairs FROM fs"""


@query(FULL)
def full_check(spark, d):
    """Six dimensions over the sessions' own streams; missing and inconclusive ones do not count."""
    e = _ms(spark, d).select("user_id", (F.col("us") / 6e7).alias("t"), "event_type", "value")
    ids = e.select("user_id").distinct()
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_acctbal", "c_mktsegment").where("c_mktsegment <> 'BUILDING'")
    down = (F.col("c_mktsegment") == "HOUSEHOLD") & (F.col("c_acctbal") < 2000)
    orientation = fc.dimension(ids.join(c, "user_id"), "user_id", "video_orientation", F.when(down, 0.0).otherwise(100.0), 0.95, down, F.when(down, "upside down"), F.when(down, "rotate"))
    stuck = checks.stuck(e.where("event_type = 'purchase'").withColumn("level", F.floor(F.col("value") / 20)), ["user_id"], "level", 0.80)
    health = fc.dimension(stuck, "user_id", "gripper_health", F.lit(100.0), 0.9, F.col("stuck"), F.when(F.col("stuck"), "stuck"), F.when(F.col("stuck"), "replace"))
    level = session.timing_level(e.where("event_type = 'purchase'"), e.where("event_type = 'click'"), ["user_id"], "t")
    clock = fc.dimension(level, "user_id", "gripper_ts", F.when(F.col("status") == "error", 40.0).when(F.col("status") == "warn", 80.0).otherwise(100.0), repair=F.when(F.col("status") == "error", "trim"))
    checked = sc.check_sessions(*_raw_sessions(spark, d), "user_id", LAYOUT)
    stop = F.col("blocked_by")
    sync = fc.dimension_of("video_tracker_sync", F.col("score"), 0.9, stop.isNotNull(), stop, F.when(stop.startswith("camera"), "shift_and_window"))
    quality = fc.dimension_of("video_quality", 100.0 - F.least(F.lit(40.0), 15.0 * F.col("n_camera_gaps")), 0.85, repair=F.when(F.col("n_camera_gaps") > 0, "repair_camera_gaps"))
    days = e.groupBy("user_id", F.floor(F.col("t") / 1440).alias("day")).agg(*[F.avg(F.when(F.col("event_type") == k, F.col("value"))).alias(n) for n, k in (("x", "purchase"), ("y", "click"))]).where("x is not null and y is not null")
    follow = days.groupBy("user_id").agg(F.count("*").alias("n"), stats.safe_corr("x", "y").alias("r"))
    frames = fc.dimension(follow, "user_id", "gripper_frame_sync", F.when(F.col("n") < 4, 50.0).otherwise(F.round(50 + 50 * F.col("r"), 3)), F.least(F.lit(0.9), 0.1 * F.col("n")), repair=F.when((F.col("n") >= 4) & (F.col("r") < 0), "shift"))
    out = fc.full_check(ids, [orientation, health, clock, fc.dimensions(checked, "user_id", sync, quality), frames], "user_id")
    return out.withColumns({"score": r("score", 4), "confidence": r("confidence"), **{c: F.array_join(c, ",") for c in ("inconclusive", "missing", "repairs")}})


#: Purchases as a gripper's sensor, clicks as what its camera shows; hours as time.
HOURLY = """WITH h AS (SELECT user_id, event_type, epoch_us(ts) / 3.6e9 AS t, avg(value) AS v FROM events WHERE event_type IN ('purchase', 'click') GROUP BY 1, 2, 3)"""


@query(HOURLY + """, q AS (SELECT user_id, event_type, quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.75) AS b FROM h GROUP BY 1, 2), c AS (SELECT h.user_id, h.event_type, t, CASE WHEN round(v, 9) <= round(a + (b - a) * 0.25, 9) THEN 1.0 ELSE 0.0 END AS v FROM h JOIN q USING (user_id, event_type) WHERE round(b - a, 9) >= 3),
bd AS (SELECT s.user_id, greatest(min(s.t), min(w.t)) AS a, least(max(s.t), max(w.t)) AS z FROM c s JOIN c w ON s.user_id = w.user_id AND s.event_type = 'purchase' AND w.event_type = 'click' GROUP BY 1),
g0 AS (SELECT user_id, i, a + i * 6.0 AS t FROM (SELECT *, unnest(range(0, CAST(floor((z - a) / 6.0) AS BIGINT) + 1)) AS i FROM bd WHERE z >= a)), g AS (SELECT * EXCLUDE (span) FROM (SELECT *, max(t) OVER (PARTITION BY user_id) - min(t) OVER (PARTITION BY user_id) AS span FROM g0) WHERE span >= 120 - 6),
n AS (SELECT *, lead(t) OVER w AS t2, lead(v) OVER w AS v2 FROM c WINDOW w AS (PARTITION BY user_id, event_type ORDER BY t)),
k AS (SELECT g.*, unnest(['purchase', 'click']) AS et FROM g), y AS (SELECT k.user_id, i, et, CASE WHEN n.t = k.t OR t2 IS NULL THEN v ELSE v + (v2 - v) * (k.t - n.t) / (t2 - n.t) END >= 0.5 AS closed FROM k ASOF JOIN n ON k.user_id = n.user_id AND k.et = n.event_type AND k.t >= n.t),
cn AS (SELECT user_id, count(*) FILTER (et = 'purchase' AND closed) AS ns, count(*) FILTER (et = 'click' AND closed) AS nv FROM y GROUP BY 1),
hit AS (SELECT s.user_id, w.i - s.i AS lag, count(*) AS n FROM y s JOIN y w ON s.user_id = w.user_id AND s.et = 'purchase' AND w.et = 'click' AND s.closed AND w.closed AND w.i - s.i BETWEEN -8 AND 8 GROUP BY 1, 2),
cv AS (SELECT l.user_id, l.lag, coalesce(n, 0) AS n FROM (SELECT user_id, unnest(range(-8, 9)) AS lag FROM cn WHERE ns >= 10 AND nv >= 10) l LEFT JOIN hit USING (user_id, lag)),
cw AS (SELECT *, lag(n) OVER w AS p, lead(n) OVER w AS q, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, lag) AS k FROM cv WINDOW w AS (PARTITION BY user_id ORDER BY lag)),
tp AS (SELECT * FROM cw WHERE k = 1), rs AS (SELECT cv.user_id, avg(cv.n) AS noise FROM cv JOIN tp USING (user_id) WHERE abs(cv.lag - tp.lag) > 2 GROUP BY 1),
o AS (SELECT u.user_id, ns, nv, tp.n, n / least(ns, nv) AS peak, (lag + coalesce(CASE WHEN p - 2 * n + q <> 0 THEN greatest(-0.5, least(0.5, 0.5 * (p - q) / (p - 2 * n + q))) ELSE 0.0 END, 0.0)) * 6.0 AS off, n / (coalesce(noise, 0.0) + 1e-8) AS snr FROM (SELECT DISTINCT user_id FROM h WHERE event_type = 'purchase') u LEFT JOIN cn USING (user_id) LEFT JOIN tp USING (user_id) LEFT JOIN rs USING (user_id))
SELECT user_id, coalesce(ns, 0) AS n_closed_sensor, coalesce(nv, 0) AS n_closed_visual, round(peak, 6) AS peak, round(off, 6) AS offset_ms, round(snr, 4) AS snr, CASE WHEN ns IS NULL THEN 'no_data' WHEN n IS NULL OR snr < 2 THEN 'weak' WHEN abs(off) > 24 THEN 'shifted' ELSE 'ok' END AS status FROM o""")
def closed_offset(spark, d):
    e = events(spark, d).select("user_id", "event_type", (F.col("us") / 3.6e9).alias("t"), "value")
    s = frame_sync.closed_offset(e.where("event_type = 'purchase'"), e.where("event_type = 'click'"), ["user_id"], step=6.0, max_lag=48.0, least_overlap=120.0, zone=2, significant=24.0, least_visual=3.0)
    return s.withColumns({"peak": r("peak"), "offset_ms": r("offset_ms"), "snr": r("snr", 4)})


@query(HOURLY + """, n AS (SELECT *, lead(t) OVER w AS t2, lead(v) OVER w AS v2 FROM h WHERE event_type = 'purchase' WINDOW w AS (PARTITION BY user_id ORDER BY t)),
f AS (SELECT user_id, event_id, epoch_us(ts) / 3.6e9 AS t, value AS gap FROM events WHERE event_type = 'click'),
j AS (SELECT f.*, CASE WHEN n.t = f.t THEN v ELSE v + (v2 - v) * (f.t - n.t) / (t2 - n.t) END AS x FROM f ASOF JOIN n ON f.user_id = n.user_id AND f.t >= n.t WHERE n.t = f.t OR t2 IS NOT NULL),
d0 AS (SELECT * EXCLUDE (c), true AS used FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS c FROM j) WHERE c >= 8),
""" + "".join(f"""m{k} AS (SELECT user_id, coalesce(regr_slope(gap, x) FILTER (used), 0.0) AS a, coalesce(regr_intercept(gap, x) FILTER (used), avg(gap) FILTER (used)) AS b FROM d{k} GROUP BY 1), e{k} AS (SELECT d{k}.*, gap - a * x - b AS res FROM d{k} JOIN m{k} USING (user_id)), z{k} AS (SELECT user_id, stddev_pop(res) FILTER (used) AS s FROM e{k} GROUP BY 1), d{k + 1} AS (SELECT e{k}.user_id, event_id, t, gap, x, abs(res) <= greatest(2.0 * s, 1e-9) AS used FROM e{k} JOIN z{k} USING (user_id)),
""" for k in range(2)) + """m AS (SELECT user_id, coalesce(regr_slope(gap, x) FILTER (used), 0.0) AS a, coalesce(regr_intercept(gap, x) FILTER (used), avg(gap) FILTER (used)) AS b FROM d2 GROUP BY 1), e AS (SELECT d2.*, gap - a * x - b AS res FROM d2 JOIN m USING (user_id)), z AS (SELECT user_id, greatest(10.0, 2.0 * stddev_pop(res) FILTER (used)) AS tol FROM e GROUP BY 1)
SELECT user_id, count(*) AS n_frames, count(*) FILTER (used) AS n_used, round(abs(regr_slope(gap, x) FILTER (used)), 6) AS px_per_mm, round(corr(gap, x) FILTER (used), 6) AS r, round(stddev_pop(res) FILTER (used), 6) AS residual_std, round(avg(CAST(abs(res) <= tol AS INTEGER)), 6) AS in_sync, count(*) FILTER (abs(res) > 3 * tol) AS n_anomalies,
round(100 * (0.6 * least(1.0, greatest(0.0, (abs(coalesce(corr(gap, x) FILTER (used), 0.0)) - 0.3) / 0.7)) + 0.4 * avg(CAST(abs(res) <= tol AS INTEGER))), 4) AS score FROM e JOIN z USING (user_id) GROUP BY 1""")
def gap_report(spark, d):
    e = events(spark, d).select("user_id", "event_id", "event_type", (F.col("us") / 3.6e9).alias("t"), "value")
    frames = e.where("event_type = 'click'").select("user_id", "event_id", "t", F.col("value").alias("gap"))
    c = frame_sync.gap_calibration(frames, e.where("event_type = 'purchase'"), ["user_id"], "event_id", sigmas=2.0, floor=10.0, least=8)
    s = frame_sync.gap_report(c, ["user_id"])
    return s.withColumns({**{c: r(c) for c in ("px_per_mm", "r", "residual_std", "in_sync")}, "score": r("score", 4)})


@query()
def oversampled_examples(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return session.oversample(x, "label").groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("l_orderkey", "l_linenumber").alias("n_rows"))


@query("""SELECT 'side  o_orderkey=' || o_orderkey || '  o_orderstatus=' || o_orderstatus AS value FROM orders""")
def text_report(spark, d):
    return session.text_report(table(spark, d, "orders"), "side", ["o_orderkey", "o_orderstatus"])


@query(MS + """, x AS (SELECT user_id, event_id, value, t, lead(t) OVER w AS t2, lead(value) OVER w AS v2 FROM e WHERE event_type = 'click' WINDOW w AS (PARTITION BY user_id ORDER BY t)),
k AS (SELECT user_id, t, t2, value, v2, greatest(CAST(round((t2 - t) / 86400000.0) AS BIGINT) - 1, 0) AS n FROM x WHERE t2 - t > 345600000.0 AND t2 - t <= 864000000.0 AND abs(v2 - value) <= 30.0),
f AS (SELECT user_id, t, value FROM x UNION ALL SELECT user_id, t + i / (n + 1) * (t2 - t), value + i / (n + 1) * (v2 - value) FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM k))
SELECT user_id, count(*) AS n, round(avg(value), 4) AS mean FROM f GROUP BY 1""")
def filled_sensor(spark, d):
    from ..operators.islands import static_gap_fill

    e = _ms(spark, d).where("event_type = 'click'").select("user_id", "t", "value")
    return static_gap_fill(e, ["user_id"], "t", "value", 4.0, 10 * DAY, 30.0, nominal=DAY).groupBy("user_id").agg(F.count("*").alias("n"), r(F.avg("value"), 4).alias("mean"))


