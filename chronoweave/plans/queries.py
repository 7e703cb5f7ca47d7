"""Registered queries: every operator over the driver's tables, each with equivalent SQL where SQL can say it.

Streams are ``events``: the user is the session, the event type the stream, microseconds the time base.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions.pose import quaternion, rotate, unit
from ..functions.scalars import falling_score, grade, hms, nominal_level, rising_score
from ..operators import asof, events as ev, grid, islands, lag, repair, roles, selection, signals, smooth, stats, timebase
from ..session import ship_package
from ..streaming import windows
from . import checks, dataset, sync, tiers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
BY = ["user_id", "event_type"]
E_SQL = "WITH e AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS us, value, props FROM events)"
#: Ten minutes and six hours in microseconds.
MINUTES, HOURS = 600_000_000, 21_600_000_000


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return f(spark, sf_dir)

        key = name or f.__name__
        QUERIES[key] = run
        if sql:
            SQL[key] = sql
        return f

    return add


def events(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "event_type", timebase.micros("ts").alias("us"), "value", "props")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def r(c: Column | str, n: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, n)


# catalogue

@query("""SELECT CASE WHEN GROUPING(o_orderstatus) = 1 THEN 'TOTAL' ELSE o_orderstatus END AS tier, CASE WHEN GROUPING(o_orderpriority) = 1 THEN 'TOTAL' ELSE o_orderpriority END AS scenario,
count(*) AS n_sessions, round(sum(o_totalprice), 2) AS seconds FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""")
def tier_stats(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderstatus").alias("tier"), F.col("o_orderpriority").alias("scenario"), "o_totalprice")
    return tiers.tier_stats(o, "tier", "scenario", "o_totalprice").withColumn("seconds", r("seconds", 2))


@query("""SELECT CASE WHEN GROUPING(l_shipmode_) = 1 THEN 'TOTAL' ELSE l_shipmode_ END AS bucket, count(*) AS n_files, CAST(sum(l_quantity) AS DOUBLE) AS bytes, count(DISTINCT l_orderkey) AS n_sessions
FROM (SELECT l_returnflag || l_linestatus AS l_shipmode_, l_quantity, l_orderkey FROM lineitem) GROUP BY ROLLUP (l_shipmode_)""")
def bucket_report(spark, d):
    li = table(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("bucket"), "l_quantity", "l_orderkey")
    return stats.totals(li, ["bucket"], [F.count("*").alias("n_files"), F.sum("l_quantity").alias("bytes"), F.count_distinct("l_orderkey").alias("n_sessions")])


@query("""SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_name LIKE '%1%' ORDER BY c_name DESC, c_custkey LIMIT 50 OFFSET 20""")
def page_desc(spark, d):
    c = table(spark, d, "customer").where(F.col("c_name").contains("1")).select("c_custkey", "c_name", "c_acctbal")
    return c.orderBy(F.desc("c_name"), "c_custkey").offset(20).limit(50)


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def not_yet_sent(spark, d):
    sent = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(sent, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("""WITH dim AS (SELECT lower(trim(n_name)) AS k, 0 AS p, n_nationkey AS v FROM nation UNION ALL SELECT lower(trim(CAST(n_nationkey AS VARCHAR))), 1, n_nationkey FROM nation),
best AS (SELECT k, arg_min(v, p * 1000 + v) AS v, min(p) AS p FROM dim GROUP BY k)
SELECT s_suppkey, b.v AS n_nationkey, b.p AS priority FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) ELSE ' ' || upper(coalesce((SELECT n_name FROM nation WHERE n_nationkey = s_nationkey), '')) END AS key FROM supplier) s LEFT JOIN best b ON lower(trim(s.key)) = b.k""")
def scenario_lookup(spark, d):
    n = table(spark, d, "nation")
    s = table(spark, d, "supplier").join(F.broadcast(n.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")), "s_nationkey", "left")  # 25 nations
    s = s.select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey").cast("string")).otherwise(F.concat(F.lit(" "), F.upper(F.coalesce("n_name", F.lit(""))))).alias("key"))
    return tiers.lookup_by_priority(s, n, "key", ["n_name", "n_nationkey"], "n_nationkey").select("s_suppkey", "n_nationkey", "priority")


@query("""SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_positions(spark, d):
    return tiers.duplicate_positions(table(spark, d, "customer"), "c_nationkey", "c_mktsegment")


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE json_valid(props) AND json_extract(props, '$.k') IS NOT NULL""")
def json_lines(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint").alias("p")).select("event_id", "p.k").where("k is not null")


@query("""SELECT o_orderkey, printf('%02d:%02d:%02d', CAST(floor(s / 3600) AS BIGINT), CAST(floor((s % 3600) / 60) AS BIGINT), s % 60) AS hms FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS s FROM orders)""")
def duration_format(spark, d):
    return table(spark, d, "orders").select("o_orderkey", hms(F.floor("o_totalprice")).alias("hms"))


# gaps and segments

@query(E_SQL + """, x AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id, event_type ORDER BY us, event_id) AS dt FROM e)
SELECT user_id, event_type, count(*) AS n, min(us) AS start, max(us) AS "end", round(median(dt), 1) AS median_dt, max(dt) AS max_gap, count(*) FILTER (dt > 86400000000) AS n_gaps,
round((count(*) - 1) * 3600000000.0 / nullif(max(us) - min(us), 0), 6) AS rate_hz,
CASE WHEN count(*) < 2 THEN 'EMPTY' WHEN count(*) FILTER (dt > 86400000000) >= 5 THEN 'BAD' WHEN count(*) FILTER (dt > 86400000000) > 0 THEN 'WARN' ELSE 'OK' END AS status FROM x GROUP BY 1, 2""")
def stream_stats(spark, d):
    s = stats.stream_stats(events(spark, d), BY, "us", 86_400_000_000, "event_id", per_second=3.6e9)
    return s.withColumn("median_dt", r("median_dt", 1)).withColumn("rate_hz", r("rate_hz"))


@query(E_SQL + """ SELECT user_id, us AS gap_start, nx AS gap_end, nx - us AS gap FROM (SELECT *, lead(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS nx FROM e) WHERE nx - us > 21600000000""")
def gap_list(spark, d):
    return islands.gaps(events(spark, d), ["user_id"], "us", HOURS, "event_id")


SEG_SQL = E_SQL + """, s AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS segment FROM (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) > 21600000000 THEN 1 ELSE 0 END AS nw FROM e)),
g AS (SELECT user_id, CAST(segment AS BIGINT) AS segment, count(*) AS n_rows, min(us) AS start, max(us) AS "end", max(us) - min(us) AS duration FROM s GROUP BY user_id, segment)"""


@query(SEG_SQL + " SELECT * FROM g")
def gap_segments(spark, d):
    return islands.segments(events(spark, d), ["user_id"], ["us", "event_id"], "us", HOURS)


@query(SEG_SQL + """ SELECT user_id, segment, n_rows, start, "end", duration FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY duration DESC, segment) AS k FROM g) WHERE k = 1""")
def longest_segment(spark, d):
    return islands.best_segment(islands.segments(events(spark, d), ["user_id"], ["us", "event_id"], "us", HOURS), ["user_id"])


@query(E_SQL + """, i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS i FROM e),
f AS (SELECT *, i - row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS g FROM i WHERE value > 50)
SELECT user_id, min(us) AS start, max(us) AS "end", count(*) AS n_rows, bool_or(value > 100) AS high, bool_or(event_type = 'error') AS error FROM f GROUP BY user_id, g HAVING max(us) - min(us) >= 600000000""")
def bad_intervals(spark, d):
    e = events(spark, d)
    return islands.flag_runs(e, ["user_id"], "us", F.col("value") > 50, "event_id", {"high": F.col("value") > 100, "error": F.col("event_type") == "error"}, least=MINUTES)


@query("""WITH k AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_orderkey + l_linenumber) % 3 <> 0),
x AS (SELECT *, lead(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS nx FROM (SELECT DISTINCT * FROM k)) SELECT l_orderkey, unnest(range(l_linenumber + 1, nx)) AS l_linenumber FROM x WHERE nx - l_linenumber > 1""")
def missing_numbers(spark, d):
    li = table(spark, d, "lineitem").where((F.col("l_orderkey") + F.col("l_linenumber")) % 3 != 0).select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"))
    return islands.missing_list(li, ["l_orderkey"], "l_linenumber")


@query(E_SQL + """, x AS (SELECT user_id, us, value, lead(us) OVER w AS t2, lead(value) OVER w AS v2 FROM (SELECT user_id, us, avg(value) AS value FROM e GROUP BY 1, 2) WINDOW w AS (PARTITION BY user_id ORDER BY us)),
m AS (SELECT user_id, median(t2 - us) AS dt FROM x GROUP BY 1), wide AS (SELECT x.*, CAST(greatest(round((t2 - us) / dt) - 1, 0) AS BIGINT) AS n FROM x JOIN m USING (user_id) WHERE t2 - us > 3 * dt AND t2 - us <= 20 * dt AND abs(v2 - value) <= 40),
made AS (SELECT user_id, CAST(floor(us + k / (n + 1) * (t2 - us)) AS BIGINT) AS us, value + k / (n + 1) * (v2 - value) AS value FROM (SELECT *, unnest(range(1, n + 1)) AS k FROM wide))
SELECT user_id, count(*) AS n_made, round(sum(value), 3) AS value_sum FROM made GROUP BY 1""")
def static_gap_fill(spark, d):
    e = events(spark, d).groupBy("user_id", "us").agg(F.avg("value").alias("value"))
    dt = e.withColumn("_d", F.lead("us").over(W.partitionBy("user_id").orderBy("us")) - F.col("us")).groupBy("user_id").agg(F.median("_d").alias("_m"))
    # at most 20 median steps: the bound is each stream's own, so time is scaled by it
    scaled = e.join(dt, "user_id").select("user_id", (F.col("us") / F.col("_m")).alias("t"), "value", "_m")
    filled = islands.static_gap_fill(scaled.select("user_id", "t", "value"), ["user_id"], "t", "value", factor=3.0, most=20.0, most_change=40.0, nominal=1.0).where("synthetic").join(dt, "user_id")
    return filled.groupBy("user_id").agg(F.count("*").alias("n_made"), r(F.sum("value"), 3).alias("value_sum"))


@query(E_SQL + """, b AS (SELECT user_id, min(us) AS z FROM e GROUP BY 1), s AS (SELECT user_id, event_type, min(us) AS t0, arg_min(value, us) AS v0 FROM e GROUP BY 1, 2)
SELECT user_id, event_type, z + k * 3600000000 AS us, v0 AS value FROM (SELECT s.*, z, unnest(range(0, CAST(ceil((t0 - z) / 3600000000.0) AS BIGINT))) AS k FROM s JOIN b USING (user_id) WHERE t0 > z AND t0 - z <= 172800000000)""")
def backward_extend(spark, d):
    e = events(spark, d).select("user_id", "event_type", "us", "value")
    zero = e.groupBy("user_id").agg(F.min("us").alias("z"))
    starts = e.select(*BY).distinct().join(zero, "user_id")
    out = islands.extend_backward(e, BY, "us", "value", starts, "z", 3_600_000_000, 172_800_000_000)
    return out.where("synthetic").select(*BY, "us", "value")


# time base

@query(E_SQL + """, f AS (SELECT user_id, event_type, arg_min(us, event_id) AS t FROM e GROUP BY 1, 2), c AS (SELECT user_id, max(t) AS a, max(t) - min(t) AS cut FROM f GROUP BY 1)
SELECT event_id, e.user_id, us FROM e JOIN c USING (user_id) WHERE cut < 5 OR us >= a""")
def trim_to_common_start(spark, d):
    return timebase.trim_to_common_start(events(spark, d), "user_id", "event_type", "us", "event_id").select("event_id", "user_id", "us")


@query(E_SQL + """, w AS (SELECT user_id, arg_min(us, event_id) FILTER (event_type = 'signup') AS a, arg_max(us, event_id) FILTER (event_type = 'error') AS z FROM e GROUP BY 1) SELECT event_id, e.user_id, us FROM e JOIN w USING (user_id) WHERE us BETWEEN a AND z""")
def trim_window_by_switch(spark, d):
    return timebase.trim_by_switch(events(spark, d), ["user_id"], "us", "event_id", F.col("event_type"), "signup", "error").select("event_id", "user_id", "us")


@query(E_SQL + """ SELECT event_id, us + CASE WHEN event_type = 'click' THEN 100500 WHEN event_type = 'view' THEN -250000 ELSE 0 END AS us FROM e""")
def shift_apply(spark, d):
    offsets = spark.createDataFrame([("click", 100.5), ("view", -250.0)], "event_type string, shift_ms double")
    return timebase.shift(events(spark, d), F.broadcast(offsets), ["event_type"], "us", per_ms=1000.0).select("event_id", "us")


@query("""SELECT vec_id, embedding[1] AS tracker_left_x, embedding[2] AS tracker_left_y, embedding[3] AS tracker_right_x, embedding[4] AS tracker_right_y FROM (SELECT vec_id, [embedding[3], embedding[4], embedding[1], embedding[2]] AS embedding FROM embeddings)""")
def relabel(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", *[F.col("embedding")[i].alias(f"tracker_{s}_{k}") for i, (s, k) in enumerate((a, b) for a in ("left", "right") for b in ("x", "y"))])
    return timebase.relabel(v, {"left": "right", "right": "left"}, "tracker_", ("x", "y"))


@query(E_SQL + """ SELECT user_id, us, arg_min(event_id, event_id) AS event_id, arg_min(value, event_id) AS value FROM (SELECT *, us // 3600000000 * 3600000000 AS h FROM e) GROUP BY user_id, us""")
def dedup_first(spark, d):
    return timebase.dedup_first(events(spark, d), ["user_id", "us"], ["event_id"]).select("user_id", "us", "event_id", "value")


@query(E_SQL + """, f AS (SELECT user_id, event_type, arg_min(us, event_id) AS t FROM e GROUP BY 1, 2) SELECT user_id, min(t) AS t0 FROM f GROUP BY 1""")
def session_zero(spark, d):
    return timebase.session_zero(events(spark, d), "user_id", "event_type", "us", "event_id")


@query("""SELECT event_type, CASE WHEN m > 1e16 THEN 'ns' WHEN m > 1e13 THEN 'us' WHEN m > 1e10 THEN 'ms' WHEN m > 1e7 THEN 's' WHEN m > 0.5 THEN 'rel_ms' ELSE 'rel_s' END AS unit, count(*) AS n FROM (SELECT event_type, median(t) OVER (PARTITION BY event_type) AS m FROM (SELECT event_type,
CASE event_type WHEN 'click' THEN epoch_us(ts) * 1000.0 WHEN 'view' THEN epoch_us(ts) * 1.0 WHEN 'error' THEN epoch_us(ts) / 1000.0 WHEN 'signup' THEN epoch_us(ts) / 1000000.0 ELSE value END AS t FROM events)) GROUP BY 1, 2""")
def unit_detection(spark, d):
    e = events(spark, d)
    k = F.col("event_type")
    t = F.when(k == "click", F.col("us") * 1000.0).when(k == "view", F.col("us") * 1.0).when(k == "error", F.col("us") / 1000.0).when(k == "signup", F.col("us") / 1e6).otherwise(F.col("value"))
    return timebase.detect_unit(e.select("event_type", t.alias("t")), ["event_type"], "t").groupBy("event_type", "unit").agg(F.count("*").alias("n"))


@query(E_SQL + """ SELECT user_id, event_type, arg_min(us, event_id) AS first_t, arg_max(us, event_id) AS last_t, min(us) AS min_t FROM e GROUP BY 1, 2""")
def stream_bounds(spark, d):
    return timebase.stream_starts(events(spark, d), BY, "us", "event_id")


# robust statistics

@query("""WITH m AS (SELECT event_type, median(value) AS med, count(value) AS n FROM events GROUP BY 1) SELECT e.event_type, round(any_value(med), 6) AS median, round(median(abs(value - med)), 6) AS mad, any_value(n) AS n FROM events e JOIN m USING (event_type) GROUP BY 1""")
def median_mad(spark, d):
    return selection.exact_median_mad(events(spark, d), ["event_type"], "value").withColumn("median", r("median")).withColumn("mad", r("mad"))


@query("""WITH m AS (SELECT event_type, median(value) AS med FROM events GROUP BY 1), d AS (SELECT event_type, any_value(med) AS med, median(abs(value - med)) AS mad FROM events JOIN m USING (event_type) GROUP BY 1)
SELECT event_id, round(CASE WHEN mad > 1e-12 THEN (value - med) / (1.4826 * mad) ELSE 0 END, 6) AS z FROM events JOIN d USING (event_type)""")
def robust_zscore(spark, d):
    return stats.robust_zscore(events(spark, d), ["event_type"], "value").select("event_id", r("z").alias("z"))


@query("""WITH q AS (SELECT event_type, quantile_cont(abs(value), 0.99) AS hi FROM events GROUP BY 1) SELECT event_id, round(greatest(-hi, least(hi, value)), 6) AS clipped FROM events JOIN q USING (event_type)""")
def percentile_clip(spark, d):
    return stats.percentile_clip(events(spark, d), ["event_type"], "value").select("event_id", r("clipped").alias("clipped"))


@query("""WITH q AS (SELECT event_type, quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi FROM events GROUP BY 1) SELECT event_id, round(CASE WHEN hi - lo > 1e-12 THEN greatest(0, least(1, (value - lo) / (hi - lo))) ELSE 0 END, 6) AS scaled FROM events JOIN q USING (event_type)""")
def percentile_scale(spark, d):
    return stats.percentile_scale(events(spark, d), ["event_type"], "value").select("event_id", r("scaled").alias("scaled"))


@query("""WITH m AS (SELECT user_id, avg(value) AS a, stddev_pop(value) AS s FROM events GROUP BY 1) SELECT event_id, round(CASE WHEN s < 1e-8 THEN value - a ELSE (value - a) / s END, 6) AS z FROM events JOIN m USING (user_id)""")
def zscore_pop(spark, d):
    return stats.zscore(events(spark, d), ["user_id"], "value").select("event_id", r("z").alias("z"))


@query(E_SQL + """, x AS (SELECT user_id, event_id, us, (us - lag(us) OVER (PARTITION BY user_id ORDER BY event_id)) / 1000000.0 AS dt FROM e), m AS (SELECT user_id, median(dt) AS md FROM x GROUP BY 1), j AS (SELECT x.user_id, median(abs(dt - md)) * 1.4826 AS jitter FROM x JOIN m USING (user_id) GROUP BY 1)
SELECT user_id, count(*) AS n, round((max(us) - min(us)) / 1e9, 6) AS duration_s, round(avg(dt), 4) AS dt_mean, round(stddev_pop(dt), 4) AS dt_std, round(min(dt), 4) AS dt_min, round(max(dt), 4) AS dt_max, count(*) FILTER (dt > 83.3) AS n_drops, max(event_id) - min(event_id) + 1 - count(*) AS n_missing, round(any_value(jitter), 4) AS jitter FROM x JOIN j USING (user_id) GROUP BY 1""")
def video_metrics(spark, d):
    m = stats.video_metrics(events(spark, d), ["user_id"], "event_id", "us")
    return m.withColumns({c: r(c, 4) for c in ("dt_mean", "dt_std", "dt_min", "dt_max", "jitter")}).withColumn("duration_s", r("duration_s"))


@query(E_SQL + """, x AS (SELECT user_id, value, (us - lag(us) OVER w) / 1e6 AS dt, value - lag(value) OVER w AS dv, us < lag(us) OVER (PARTITION BY user_id ORDER BY event_id) AS bk FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)), v AS (SELECT *, CASE WHEN dt > 0 THEN abs(dv) / (dt / 1e3) END AS v FROM x)
SELECT user_id, count(*) AS n, round(avg(dt), 4) AS dt_mean, round(max(dt), 4) AS dt_max, count(*) FILTER (bk) AS n_back_steps, round(max(v), 4) AS v_max, round(quantile_cont(v, 0.99), 4) AS v_p99, count(*) FILTER (v > 10) AS n_fast, round(max(value) - min(value), 4) AS value_range FROM v GROUP BY 1""")
def sensor_metrics(spark, d):
    m = stats.sensor_metrics(events(spark, d), ["user_id"], "us", "value", "event_id", 10.0)
    return m.withColumns({c: r(c, 4) for c in ("dt_mean", "dt_max", "v_max", "v_p99", "value_range")})


@query("""SELECT l_returnflag, avg(CASE WHEN l_discount = 0 THEN 1.0 ELSE 0.0 END) > 0.05 AS stuck, round(avg(CASE WHEN l_discount = 0 THEN 1.0 ELSE 0.0 END), 6) AS zero_share, avg(l_discount) = 0 AS dead FROM lineitem GROUP BY 1""")
def stuck_sensors(spark, d):
    return checks.stuck(table(spark, d, "lineitem"), ["l_returnflag"], "l_discount", 0.05).withColumn("zero_share", r("zero_share"))


# as-of joins and grids

ASOF = E_SQL + """, l AS (SELECT event_id, user_id, us FROM e WHERE event_type = 'click'), v AS (SELECT user_id, us, max(value) AS value FROM e WHERE event_type = 'view' GROUP BY 1, 2),
b AS (SELECT l.event_id, v.us AS t, v.value FROM l ASOF JOIN v ON l.user_id = v.user_id AND l.us >= v.us), f AS (SELECT l.event_id, v.us AS t, v.value FROM l ASOF JOIN v ON l.user_id = v.user_id AND l.us <= v.us)"""


def _asof(spark, d, **kw):
    e = events(spark, d)
    left = e.where("event_type = 'click'").select("event_id", "user_id", "us")
    right = e.where("event_type = 'view'").select("user_id", "us", "value")
    return asof.asof_join(left, right, ["user_id"], "us", "us", ["value"], match_time="match_us", **kw)


@query(ASOF + " SELECT l.event_id, b.value, b.t AS match_us FROM l LEFT JOIN b USING (event_id)")
def asof_backward(spark, d):
    return _asof(spark, d, direction="backward").select("event_id", "value", "match_us")


@query(ASOF + " SELECT l.event_id, f.value, f.t AS match_us FROM l LEFT JOIN f USING (event_id)")
def asof_forward(spark, d):
    return _asof(spark, d, direction="forward").select("event_id", "value", "match_us")


@query(ASOF + """ SELECT event_id, CASE WHEN ok THEN value END AS value, CASE WHEN ok THEN t END AS match_us FROM (SELECT l.event_id, CASE WHEN f.t IS NULL OR l.us - b.t <= f.t - l.us THEN b.value ELSE f.value END AS value, CASE WHEN f.t IS NULL OR l.us - b.t <= f.t - l.us THEN b.t ELSE f.t END AS t,
abs(l.us - CASE WHEN f.t IS NULL OR l.us - b.t <= f.t - l.us THEN b.t ELSE f.t END) <= 7200000000 AS ok FROM l LEFT JOIN b USING (event_id) LEFT JOIN f USING (event_id))""")
def asof_nearest_tolerance(spark, d):
    return _asof(spark, d, tolerance=7_200_000_000).select("event_id", "value", "match_us")


@query(ASOF + """ SELECT user_id, count(*) AS n, round(avg(x), 2) AS latency_mean, round(quantile_cont(x, 0.95), 2) AS latency_p95, max(x) AS latency_max FROM (SELECT l.user_id, least(coalesce(l.us - b.t, f.t - l.us), coalesce(f.t - l.us, l.us - b.t)) AS x FROM l LEFT JOIN b USING (event_id) LEFT JOIN f USING (event_id)) WHERE x IS NOT NULL GROUP BY 1""")
def latency_stats(spark, d):
    x = _asof(spark, d, tie="later").withColumn("x", F.abs(F.col("us") - F.col("match_us"))).where("x is not null")
    return x.groupBy("user_id").agg(F.count("*").alias("n"), r(F.avg("x"), 2).alias("latency_mean"), r(F.percentile("x", 0.95), 2).alias("latency_p95"), F.max("x").alias("latency_max"))


GRID = E_SQL + """, b AS (SELECT user_id, greatest(min(us) FILTER (event_type = 'click'), min(us) FILTER (event_type = 'view')) AS a, least(max(us) FILTER (event_type = 'click'), max(us) FILTER (event_type = 'view')) AS z FROM e GROUP BY 1),
g AS (SELECT user_id, i, CAST(a AS BIGINT) + i * 21600000000 AS t FROM (SELECT *, unnest(range(0, CAST(floor((z - a) / 21600000000.0) AS BIGINT) + 1)) AS i FROM b WHERE z >= a)),
s AS (SELECT user_id, event_type, us, avg(value) AS v FROM e GROUP BY 1, 2, 3),
k AS (SELECT g.*, et, s.us AS t1, s.v AS v1 FROM (SELECT g.*, unnest(['click', 'view']) AS et FROM g) g ASOF JOIN s ON g.user_id = s.user_id AND g.et = s.event_type AND g.t >= s.us),
m AS (SELECT k.*, s.us AS t2, s.v AS v2 FROM k ASOF LEFT JOIN s ON k.user_id = s.user_id AND k.et = s.event_type AND k.t <= s.us),
p AS (SELECT user_id, i, et, CASE WHEN t1 = t OR t2 IS NULL THEN v1 ELSE v1 + (v2 - v1) * (t - t1) / (t2 - t1) END AS v FROM m),
xy AS (SELECT user_id, i, max(v) FILTER (et = 'click') AS x, max(v) FILTER (et = 'view') AS y FROM p GROUP BY 1, 2)"""


def _grid(spark, d):
    e = events(spark, d)
    part = lambda k: e.where(F.col("event_type") == k).select("user_id", F.col("us").alias("t"), "value")
    return lag.on_common_grid(part("click"), part("view"), ["user_id"], HOURS)


@query(GRID + " SELECT user_id, i, round(x, 6) AS x, round(y, 6) AS y FROM xy")
def grid_interp(spark, d):
    return _grid(spark, d).select("user_id", "i", r("x").alias("x"), r("y").alias("y"))


@query(E_SQL + """, g AS (SELECT user_id, min(us) AS z FROM e GROUP BY 1), v AS (SELECT user_id, min(us) AS a, max(us) AS b FROM e WHERE event_type = 'signup' GROUP BY 1)
SELECT user_id, count(*) AS n, count(*) FILTER (z + k * 86400000000 < a OR z + k * 86400000000 > b) AS n_outside FROM (SELECT g.*, a, b, unnest(range(0, 40)) AS k FROM g JOIN v USING (user_id)) GROUP BY 1""")
def grid_outside(spark, d):
    e = events(spark, d)
    zero = e.groupBy("user_id").agg(F.min("us").alias("z"))
    points = zero.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(39)))).select("user_id", (F.col("z") + F.col("k") * F.lit(86_400_000_000)).alias("t"))
    signup = e.where("event_type = 'signup'").select("user_id", F.col("us").alias("t"), "value")
    out = grid.interpolate(signup, points.join(signup.select("user_id").distinct(), "user_id"), ["user_id"], outside="null", out="v")
    return out.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("v").isNull()).alias("n_outside"))


@query(E_SQL + """, s AS (SELECT user_id, event_type, min(us) AS a, max(us) AS z FROM e GROUP BY 1, 2) SELECT x.user_id, x.event_type AS stream, round(greatest(0, least(x.z, y.z) - greatest(x.a, y.a)) / nullif(y.z - y.a, 0), 6) AS coverage FROM s x JOIN s y ON x.user_id = y.user_id AND y.event_type = 'view' AND x.event_type <> 'view'""")
def overlap_coverage(spark, d):
    s = events(spark, d).groupBy(*BY).agg(F.min("us").alias("a"), F.max("us").alias("z"))
    ref = s.where("event_type = 'view'").select("user_id", F.col("a").alias("ra"), F.col("z").alias("rz"))
    cover = F.greatest(F.lit(0), F.least("z", "rz") - F.greatest("a", "ra")) / F.nullif(F.col("rz") - F.col("ra"), F.lit(0))
    return s.where("event_type <> 'view'").join(ref, "user_id").select("user_id", F.col("event_type").alias("stream"), r(cover).alias("coverage"))


@query(E_SQL + """, c AS (SELECT user_id, us AS a FROM e WHERE event_type = 'purchase'), v AS (SELECT user_id, us AS b FROM e WHERE event_type = 'view') SELECT c.user_id, count(*) AS n_pairs, sum(abs(a - b))::BIGINT AS total FROM c JOIN v ON c.user_id = v.user_id AND abs(a - b) <= 1800000000 GROUP BY 1""")
def match_candidates(spark, d):
    e = events(spark, d)
    pairs = asof.match_within(e.where("event_type = 'purchase'").select("user_id", F.col("us").alias("a")), e.where("event_type = 'view'").select("user_id", F.col("us").alias("b")), ["user_id"], "a", "b", 1_800_000_000)
    return pairs.groupBy("user_id").agg(F.count("*").alias("n_pairs"), F.sum(F.abs(F.col("a") - F.col("b"))).alias("total"))


# fits and correlations

@query(E_SQL + """, o AS (SELECT user_id, us / 1e6 AS y, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS x FROM e) SELECT user_id, count(*) AS n, round(regr_slope(y, x), 4) AS slope, round(regr_r2(y, x), 6) AS r2 FROM o GROUP BY 1 HAVING count(*) >= 10""")
def clock_regression(spark, d):
    o = events(spark, d).withColumn("x", F.row_number().over(timebase.ordered(["user_id"], "us", "event_id")) - 1).withColumn("y", F.col("us") / 1e6)
    return stats.clock_fit(o, ["user_id"], "x", "y").select("user_id", "n", r("slope", 4).alias("slope"), r("r2").alias("r2"))


@query(E_SQL + """, o AS (SELECT user_id, (us - min(us) OVER (PARTITION BY user_id)) / 3.6e9 AS x, value AS y FROM e), k AS (SELECT * FROM (SELECT *, avg(y) OVER (PARTITION BY user_id) AS m, stddev_pop(y) OVER (PARTITION BY user_id) AS s FROM o) WHERE NOT abs(y - m) > 3 * s)
SELECT user_id, count(*) AS n, round(regr_slope(y, x) * 1e6, 2) AS drift_ppm FROM k GROUP BY 1 HAVING count(*) >= 10""")
def drift_ppm(spark, d):
    o = events(spark, d).withColumn("x", (F.col("us") - F.min("us").over(W.partitionBy("user_id"))) / 3.6e9)
    return stats.clock_fit(o, ["user_id"], "x", "value", sigmas=3.0).select("user_id", "n", r("drift_ppm", 2).alias("drift_ppm"))


@query(E_SQL + """, span AS (SELECT user_id, min(us) AS a, max(us) AS z FROM e WHERE event_type = 'view' GROUP BY 1), p AS (SELECT user_id, k, a + (z - a) * CAST(k AS DOUBLE) / 29 AS probe FROM (SELECT *, unnest(range(0, 30)) AS k FROM span)),
c AS (SELECT user_id, CAST(us AS DOUBLE) AS t FROM e WHERE event_type = 'click'), b AS (SELECT p.user_id, k, c.t FROM p ASOF JOIN c ON p.user_id = c.user_id AND p.probe >= c.t), f AS (SELECT p.user_id, k, c.t FROM p ASOF JOIN c ON p.user_id = c.user_id AND p.probe <= c.t)
SELECT p.user_id, CAST(k AS INTEGER) AS k, CAST(round(CASE WHEN b.t IS NULL THEN f.t WHEN f.t IS NULL OR probe - b.t <= f.t - probe THEN b.t ELSE f.t END - probe) AS BIGINT) AS offset_us FROM p LEFT JOIN b USING (user_id, k) LEFT JOIN f USING (user_id, k) WHERE b.t IS NOT NULL OR f.t IS NOT NULL""")
def drift_points(spark, d):
    e = events(spark, d)
    p = repair.drift_points(e.where("event_type = 'view'"), e.where("event_type = 'click'"), ["user_id"], "us")
    return p.where("offset is not null").select("user_id", "k", F.round("offset").cast("bigint").alias("offset_us"))


@query(GRID + """ SELECT user_id, count(*) AS n, round(CASE WHEN count(*) < 3 OR stddev_pop(x) < 1e-8 OR stddev_pop(y) < 1e-8 THEN 0 ELSE corr(x, y) END, 6) AS r, round(sum(x * y) / nullif(sqrt(sum(x * x) * sum(y * y)), 0), 6) AS cosine FROM xy GROUP BY 1""")
def pair_corr(spark, d):
    return _grid(spark, d).groupBy("user_id").agg(F.count("*").alias("n"), r(stats.safe_corr("x", "y")).alias("r"), r(stats.cosine("x", "y")).alias("cosine"))


@query("""SELECT l_returnflag, count(*) AS n, round(avg(abs(a - b)), 4) AS mae, round(sqrt(avg((a - b) * (a - b))), 4) AS rmse, round(max(abs(a - b)), 4) AS max_error, round(corr(a, b), 6) AS corr FROM (SELECT l_returnflag, l_extendedprice AS a, p_retailprice * l_quantity AS b FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1""")
def error_metrics(spark, d):
    j = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select("l_returnflag", F.col("l_extendedprice").alias("a"), (F.col("p_retailprice") * F.col("l_quantity")).alias("b"))
    return stats.error_metrics(j, ["l_returnflag"], "a", "b").withColumns({c: r(c, 4) for c in ("mae", "rmse", "max_error")}).withColumn("corr", r("corr"))


@query("""WITH r AS (SELECT l_returnflag, min(l_quantity) AS la, max(l_quantity) AS ha, min(l_extendedprice) AS lb, max(l_extendedprice) AS hb FROM lineitem GROUP BY 1),
c AS (SELECT l_returnflag, least(floor((l_quantity - la) * 20 / nullif(ha - la, 0)), 19) AS a, least(floor((l_extendedprice - lb) * 20 / nullif(hb - lb, 0)), 19) AS b, count(*) AS n FROM lineitem JOIN r USING (l_returnflag) GROUP BY 1, 2, 3),
p AS (SELECT l_returnflag, n / sum(n) OVER (PARTITION BY l_returnflag) AS p, sum(n) OVER (PARTITION BY l_returnflag, a) / sum(n) OVER (PARTITION BY l_returnflag) AS pa, sum(n) OVER (PARTITION BY l_returnflag, b) / sum(n) OVER (PARTITION BY l_returnflag) AS pb FROM c)
SELECT l_returnflag, round(2 * sum(p * ln(p / (pa * pb))) / (-sum(p * ln(pa)) - sum(p * ln(pb))), 6) AS nmi FROM p GROUP BY 1""")
def mutual_information(spark, d):
    return stats.mutual_information(table(spark, d, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice"), ["l_returnflag"], "l_quantity", "l_extendedprice").withColumn("nmi", r("nmi"))


@query("""WITH f AS (SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem GROUP BY 1) SELECT l_returnflag, round(stddev_pop(l_extendedprice - b * l_quantity - a), 4) AS spread, round(max(abs(l_extendedprice - b * l_quantity - a)), 4) AS worst FROM lineitem JOIN f USING (l_returnflag) GROUP BY 1""")
def residual_spread(spark, d):
    x = stats.residuals(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")
    return x.groupBy("l_returnflag").agg(r(F.stddev_pop("residual"), 4).alias("spread"), r(F.max(F.abs("residual")), 4).alias("worst"))


# lag search

LAG = GRID + """, ls AS (SELECT unnest(range(-6, 7)) AS lag), nx AS (SELECT user_id, sqrt(sum(x * x) * sum(y * y)) AS n FROM xy GROUP BY 1), sc AS (SELECT a.user_id, lag, CASE WHEN any_value(nx.n) > 1e-12 THEN sum(a.x * b.y) / any_value(nx.n) ELSE 0 END AS score, count(*) AS n FROM xy a JOIN ls ON true JOIN xy b ON a.user_id = b.user_id AND b.i = a.i + lag JOIN nx ON nx.user_id = a.user_id GROUP BY 1, 2)"""


def _scores(spark, d):
    g = _grid(spark, d)
    return lag.lag_scores(g, g, ["user_id"], "x", "y", 6)


@query(LAG + " SELECT user_id, CAST(lag AS INTEGER) AS lag, round(score, 6) AS score, n FROM sc")
def lag_scan(spark, d):
    return _scores(spark, d).withColumn("score", r("score"))


@query(LAG + """, w AS (SELECT *, lag(score) OVER (PARTITION BY user_id ORDER BY lag) AS p, lead(score) OVER (PARTITION BY user_id ORDER BY lag) AS q, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, lag) AS k FROM (SELECT user_id, lag, score, n FROM sc))
SELECT user_id, CAST(max(lag) FILTER (k = 1) AS INTEGER) AS lag, round(max(score) FILTER (k = 1), 6) AS score, round(max(score) FILTER (k = 1) - max(score) FILTER (k = 2), 6) AS margin,
round(max(lag + CASE WHEN q IS NOT NULL AND p IS NOT NULL AND abs(p - 2 * score + q) > 1e-12 THEN greatest(-1, least(1, 0.5 * (p - q) / (p - 2 * score + q))) ELSE 0 END) FILTER (k = 1), 5) AS fine_lag FROM w GROUP BY 1""")
def best_lag(spark, d):
    return lag.best_lag(_scores(spark, d), ["user_id"]).select("user_id", "lag", r("score").alias("score"), r("margin").alias("margin"), r("fine_lag", 5).alias("fine_lag"))


# smoothers and windows

@query("""SELECT event_id, round(avg(value) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS centred, round(sum(value) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5, 6) AS padded, round(median(value) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS med,
round(value - coalesce(lag(value) OVER w, value), 6) AS diff, round(CASE WHEN lag(value) OVER w IS NULL AND lead(value) OVER w IS NULL THEN 0 WHEN lag(value) OVER w IS NULL THEN lead(value) OVER w - value WHEN lead(value) OVER w IS NULL THEN value - lag(value) OVER w ELSE (lead(value) OVER w - lag(value) OVER w) / 2 END, 6) AS grad FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def smoothers(spark, d):
    w = smooth.window(["user_id"], ["us", "event_id"])
    return events(spark, d).select("event_id", r(smooth.moving_average("value", w, 5)).alias("centred"), r(smooth.padded_average("value", w, 5)).alias("padded"), r(smooth.rolling_median("value", w, 5)).alias("med"), r(smooth.difference("value", w)).alias("diff"), r(smooth.gradient("value", w)).alias("grad"))


@query("""WITH i AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events), w AS (SELECT user_id, unnest(range(0, CAST(floor((n - 20) / 10.0) AS BIGINT) + 1)) AS k FROM (SELECT DISTINCT user_id, n FROM i) WHERE n >= 20)
SELECT i.user_id, k AS window_id, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS spread FROM i JOIN w ON i.user_id = w.user_id AND i.i BETWEEN k * 10 AND k * 10 + 19 GROUP BY 1, 2""")
def sliding_windows(spark, d):
    x = events(spark, d).withColumn("o", F.row_number().over(timebase.ordered(["user_id"], "us", "event_id")))
    return smooth.sliding_windows(x, ["user_id"], "o", 20, 10).groupBy("user_id", "window_id").agg(F.count("*").alias("n"), r(F.avg("value")).alias("mean"), r(F.stddev_pop("value")).alias("spread"))


@query("""WITH w AS (SELECT event_id, user_id, event_type, ts, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events), k AS (SELECT user_id, i, v FROM w WHERE v IS NOT NULL),
a AS (SELECT w.event_id, k.i AS i1, k.v AS v1 FROM w ASOF JOIN k ON w.user_id = k.user_id AND w.i >= k.i), b AS (SELECT w.event_id, k.i AS i2, k.v AS v2 FROM w ASOF JOIN k ON w.user_id = k.user_id AND w.i <= k.i)
SELECT w.event_id, round(CASE WHEN v IS NOT NULL THEN v WHEN v1 IS NULL THEN v2 WHEN v2 IS NULL THEN v1 ELSE v1 + (v2 - v1) * (i - i1) / (i2 - i1) END, 6) AS value FROM w LEFT JOIN a USING (event_id) LEFT JOIN b USING (event_id)""")
def fill_linear(spark, d):
    x = events(spark, d).withColumn("value", F.when(F.col("event_type") != "error", F.col("value"))).withColumn("o", F.row_number().over(timebase.ordered(["user_id"], "us", "event_id")))
    return smooth.fill_linear(x, ["user_id"], "o", "value").select("event_id", r("value").alias("value"))


# pose

@query("""SELECT vec_id, round(n, 6) AS norm, round((1 - 2 * (y * y + z * z)) * a + 2 * (x * y - w * z) * b + 2 * (x * z + w * y) * c, 5) AS rx, round(2 * (x * y + w * z) * a + (1 - 2 * (x * x + z * z)) * b + 2 * (y * z - w * x) * c, 5) AS ry, round(2 * (x * z - w * y) * a + 2 * (y * z + w * x) * b + (1 - 2 * (x * x + y * y)) * c, 5) AS rz
FROM (SELECT vec_id, n, w / n AS w, x / n AS x, y / n AS y, z / n AS z, a, b, c FROM (SELECT vec_id, e[1]::DOUBLE AS w, e[2]::DOUBLE AS x, e[3]::DOUBLE AS y, e[4]::DOUBLE AS z, e[5]::DOUBLE AS a, e[6]::DOUBLE AS b, e[7]::DOUBLE AS c, sqrt(e[1]::DOUBLE * e[1] + e[2]::DOUBLE * e[2] + e[3]::DOUBLE * e[3] + e[4]::DOUBLE * e[4]) AS n FROM (SELECT vec_id, embedding AS e FROM embeddings))) WHERE n >= 0.1""")
def quat_rotate(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    q = quaternion(F.col("e"))
    n = F.sqrt(q[0] * q[0] + q[1] * q[1] + q[2] * q[2] + q[3] * q[3])
    v = rotate(unit(q), tuple(F.col("e")[k] for k in (4, 5, 6)))
    return e.where(n >= 0.1).select("vec_id", r(n).alias("norm"), *[r(c, 5).alias(k) for c, k in zip(v, ("rx", "ry", "rz"), strict=True)])


@query("""WITH s AS (SELECT label, vec_id, sqrt((e[1] - lag(e[1]) OVER w) ** 2 + (e[2] - lag(e[2]) OVER w) ** 2 + (e[3] - lag(e[3]) OVER w) ** 2) AS step FROM (SELECT label, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings) WINDOW w AS (PARTITION BY label ORDER BY vec_id))
SELECT label, count(*) AS n, round(sum(step), 4) AS travelled, count(*) FILTER (step > 0.5) AS n_jumps, coalesce(sum(step), 0) < 0.05 AS frozen FROM s GROUP BY 1""")
def displacement(spark, d):
    e = table(spark, d, "embeddings").select("label", "vec_id", F.col("embedding").cast("array<double>").alias("e"))
    w = W.partitionBy("label").orderBy("vec_id")
    step = F.sqrt(sum(((F.col("e")[k] - F.lag(F.col("e")[k]).over(w)) ** 2 for k in (1, 2)), (F.col("e")[0] - F.lag(F.col("e")[0]).over(w)) ** 2))
    s = e.withColumn("step", step)
    return s.groupBy("label").agg(F.count("*").alias("n"), r(F.sum("step"), 4).alias("travelled"), F.count_if(F.col("step") > 0.5).alias("n_jumps"), (F.coalesce(F.sum("step"), F.lit(0.0)) < 0.05).alias("frozen"))


@query("""SELECT vec_id, CASE WHEN sqrt(list_sum(list_transform(embedding[1:4], lambda x: x::DOUBLE * x))) < 0.15 THEN true ELSE false END AS invalid FROM embeddings""")
def invalid_quaternions(spark, d):
    from ..functions.pose import invalid_quaternion

    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    return e.select("vec_id", invalid_quaternion(quaternion(F.col("e")), 0.15).alias("invalid"))


@query()
def slerp_fill(spark, d):
    e = table(spark, d, "embeddings").select("label", "vec_id", F.slice(F.col("embedding").cast("array<double>"), 1, 4).alias("q"))
    e = e.withColumn("q", F.when(F.col("vec_id") % 7 == 3, F.array(*[F.lit(0.0)] * 4)).otherwise(F.col("q")))
    return repair.repair_quaternions(e, ["label"], "vec_id", "q").select("vec_id", "q", "repaired")


# roles

@query("""WITH f AS (SELECT l_orderkey % 50 AS s, l_linenumber AS b, avg(l_extendedprice) AS height, avg(l_quantity) AS mobility, avg(l_discount) AS centrality FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1, 2),
p AS (SELECT s, b, 3.0 * greatest(3 - row_number() OVER (PARTITION BY s ORDER BY height DESC, b), 0) + 1.0 * greatest(3 - row_number() OVER (PARTITION BY s ORDER BY mobility, b), 0) + 2.0 * greatest(3 - row_number() OVER (PARTITION BY s ORDER BY centrality, b), 0) AS points FROM f)
SELECT s, b, CAST(points AS DOUBLE) AS points, row_number() OVER (PARTITION BY s ORDER BY points DESC, b) = 1 AS is_head FROM p""")
def head_rank_points(spark, d):
    f = table(spark, d, "lineitem").where("l_linenumber <= 3").groupBy((F.col("l_orderkey") % 50).alias("s"), F.col("l_linenumber").alias("b")).agg(F.avg("l_extendedprice").alias("height"), F.avg("l_quantity").alias("mobility"), F.avg("l_discount").alias("centrality"))
    return roles.rank_points(f, "s", "b").select("s", "b", "points", "is_head")


@query("""WITH c AS (SELECT o_custkey % 100 AS s, o_orderpriority AS v, count(*) AS n, min(o_orderkey) AS o FROM orders GROUP BY 1, 2) SELECT s, arg_min(v, -n * 1000000000 + o) AS winner, max(n) AS votes, round(max(n) / sum(n), 6) AS share FROM c GROUP BY 1""")
def majority_vote(spark, d):
    o = table(spark, d, "orders").select((F.col("o_custkey") % 100).alias("s"), "o_orderpriority", "o_orderkey")
    return stats.majority(o, ["s"], "o_orderpriority", "o_orderkey").withColumn("share", r("share"))


VOTES = """WITH v AS (SELECT CAST(o_orderkey % 200 AS BIGINT) AS session, CAST(o_custkey % 12 AS INTEGER) AS rule_id, max(CAST(o_orderpriority < '3' AS INTEGER)) AS vote FROM orders GROUP BY 1, 2), t AS (SELECT DISTINCT session, CAST(session % 2 AS INTEGER) AS truth FROM v), j AS (SELECT v.session, rule_id, CAST(vote = truth AS INTEGER) AS ok FROM v JOIN t USING (session))"""


def _votes(spark, d):
    v = table(spark, d, "orders").groupBy((F.col("o_orderkey") % 200).cast("bigint").alias("session"), (F.col("o_custkey") % 12).cast("int").alias("rule_id")).agg(F.max((F.col("o_orderpriority") < "3").cast("int")).alias("right_block"))
    return v, v.select("session", (F.col("session") % 2).cast("int").alias("true_right")).distinct()


@query(VOTES + " SELECT rule_id, round(avg(ok), 6) AS accuracy, count(*) AS n FROM j GROUP BY 1 ORDER BY avg(ok) DESC, rule_id LIMIT 1")
def best_rule(spark, d):
    return roles.best_rule(*_votes(spark, d), "session").withColumn("accuracy", r("accuracy"))


@query(VOTES + """, s AS (SELECT rule_id, sum(ok) AS total FROM j GROUP BY 1) SELECT session, rule_id, ok = 1 AS correct FROM (SELECT j.session, j.rule_id, ok, row_number() OVER (PARTITION BY session ORDER BY total - ok DESC, j.rule_id) AS k FROM j JOIN s USING (rule_id)) WHERE k = 1""")
def leave_one_out(spark, d):
    return roles.leave_one_out(*_votes(spark, d), "session")


@query("""WITH c AS (SELECT l_orderkey % 20 AS session, CASE l_linenumber WHEN 1 THEN 'head' WHEN 2 THEN 'left' ELSE 'right' END AS camera, abs(corr(l_quantity, l_extendedprice)) AS h, abs(corr(l_quantity, l_discount)) AS l, abs(corr(l_quantity, l_tax)) AS r FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1, 2),
p(perm, a, b, d) AS (VALUES (0, 'h', 'l', 'r'), (1, 'h', 'r', 'l'), (2, 'l', 'h', 'r'), (3, 'l', 'r', 'h'), (4, 'r', 'h', 'l'), (5, 'r', 'l', 'h')),
s AS (SELECT session, perm, sum(CASE CASE camera WHEN 'head' THEN a WHEN 'left' THEN b ELSE d END WHEN 'h' THEN h WHEN 'l' THEN l ELSE r END) AS total FROM c, p GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY total DESC, perm) AS k FROM s),
m AS (SELECT session, max(total) FILTER (k = 1) AS total, max(total) FILTER (k = 1) - max(total) FILTER (k = 2) AS margin FROM k GROUP BY 1)
SELECT session, round(total, 6) AS total, round(margin, 6) AS margin, CASE WHEN margin >= 0.3 THEN 'high' WHEN margin >= 0.1 THEN 'medium' ELSE 'low' END AS confidence FROM m""")
def best_permutation(spark, d):
    c = table(spark, d, "lineitem").where("l_linenumber <= 3").groupBy((F.col("l_orderkey") % 20).alias("session"), F.element_at(F.array(*map(F.lit, ("head", "left", "right"))), F.col("l_linenumber")).alias("camera")).agg(F.corr("l_quantity", "l_extendedprice").alias("head"), F.corr("l_quantity", "l_discount").alias("left"), F.corr("l_quantity", "l_tax").alias("right"))
    c = c.unpivot(["session", "camera"], ["head", "left", "right"], "sensor", "r")
    return roles.best_permutation(c, "session", ("head", "left", "right")).select("session", r("total").alias("total"), r("margin").alias("margin"), "confidence")


# checks and scores

METRICS = """WITH m AS (SELECT o_custkey AS session_id, count(*) AS n, avg(o_totalprice) AS price, count(*) FILTER (o_orderstatus = 'F') AS n_tracker_gaps, count(*) FILTER (o_orderpriority LIKE '1%') AS n_camera_gaps, count(*) FILTER (o_orderstatus = 'P') / count(*) AS invalid_share FROM orders GROUP BY 1)"""


def _metrics(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy(F.col("o_custkey").alias("session_id")).agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("price"), F.count_if(F.col("o_orderstatus") == "F").alias("n_tracker_gaps"), F.count_if(F.col("o_orderpriority").startswith("1")).alias("n_camera_gaps"), (F.count_if(F.col("o_orderstatus") == "P") / F.count("*")).alias("invalid_quaternion_share"))


GATES = [checks.Gate("quaternions", "invalid_quaternion_share > 0.05", 2), checks.Gate("tracker_continuity", "n_tracker_gaps >= 5", 3), checks.Gate("camera_continuity", "n_camera_gaps >= 3", 4), checks.Gate("size", "n < 5", 6, blocking=False)]


@query(METRICS + """ SELECT session_id, CASE WHEN invalid_share > 0.05 THEN 'quaternions' WHEN n_tracker_gaps >= 5 THEN 'tracker_continuity' WHEN n_camera_gaps >= 3 THEN 'camera_continuity' END AS first_failed,
CAST(invalid_share > 0.05 AS BIGINT) + CAST(n_tracker_gaps >= 5 AS BIGINT) + CAST(n_camera_gaps >= 3 AS BIGINT) + CAST(n < 5 AS BIGINT) AS n_failed, invalid_share > 0.05 OR n_tracker_gaps >= 5 OR n_camera_gaps >= 3 AS blocked FROM m""")
def first_failed_gate(spark, d):
    return checks.first_failed_gate(checks.run_gates(_metrics(spark, d), "session_id", GATES), "session_id")


@query(METRICS + """ SELECT session_id, g.gate AS gate, g.problem AS problem, g.priority AS priority FROM m, (VALUES ('quaternions', 'corrupt_quaternions', 1), ('tracker_continuity', 'tracker_gaps', 2), ('camera_continuity', 'camera_gaps', 3)) g(gate, problem, priority)
WHERE (g.gate = 'quaternions' AND invalid_share > 0.05) OR (g.gate = 'tracker_continuity' AND n_tracker_gaps >= 5) OR (g.gate = 'camera_continuity' AND n_camera_gaps >= 3)""")
def diagnosis(spark, d):
    return checks.diagnose(checks.run_gates(_metrics(spark, d), "session_id", GATES), "session_id").select("session_id", "gate", "problem", "priority")


ALERTS = [checks.Alert("GAPS", "ERROR", "n_tracker_gaps > 6"), checks.Alert("CAMERA", "WARNING", "n_camera_gaps > 2"), checks.Alert("PRICE", "WARNING", "price > 180000")]


@query(METRICS + """ SELECT session_id, a.code AS code, a.level AS level FROM m, (VALUES ('GAPS', 'ERROR'), ('CAMERA', 'WARNING'), ('PRICE', 'WARNING')) a(code, level) WHERE (code = 'GAPS' AND n_tracker_gaps > 6) OR (code = 'CAMERA' AND n_camera_gaps > 2) OR (code = 'PRICE' AND price > 180000)""")
def alerts(spark, d):
    return checks.alerts(_metrics(spark, d), ["session_id"], ALERTS)


@query(METRICS + """, c AS (SELECT session_id, CAST(n_tracker_gaps > 6 AS INTEGER) AS e, CAST(n_camera_gaps > 2 AS INTEGER) + CAST(price > 180000 AS INTEGER) AS w FROM m) SELECT session_id, CAST(e AS BIGINT) AS errors, CAST(w AS BIGINT) AS warnings, CASE WHEN e > 0 THEN 100.0 - least(25 * e + 5 * (e - 1), 65) ELSE greatest(55.0, 100.0 - 10 * w) END::DOUBLE AS score FROM c""")
def side_score(spark, d):
    m = _metrics(spark, d)
    return checks.side_score(checks.alerts(m, ["session_id"], ALERTS), ["session_id"], m)


DIMS = """WITH x AS (SELECT l_suppkey AS session_id, l_linenumber AS k, 40 + avg(l_quantity) AS score, 1 - avg(l_discount) * 6 AS confidence FROM lineitem GROUP BY 1, 2),
d AS (SELECT session_id, CASE k WHEN 1 THEN 'gripper_ts' WHEN 2 THEN 'video_tracker_sync' WHEN 3 THEN 'video_quality' ELSE 'gripper_frame_sync' END AS name, score, confidence, confidence < 0.55 AS blocking FROM x WHERE k <= 4),
u AS (SELECT *, CASE WHEN NOT (score = 50 AND confidence < 0.5 AND NOT blocking) THEN CASE name WHEN 'gripper_ts' THEN 0.25 WHEN 'video_tracker_sync' THEN 0.30 WHEN 'video_quality' THEN 0.15 ELSE 0.30 END ELSE 0 END AS w FROM d),
s AS (SELECT session_id, sum(w * score) / nullif(sum(w), 0) AS score, sum(w * confidence) / nullif(sum(w), 0) AS confidence, bool_or(blocking OR (w > 0 AND score < CASE WHEN name = 'gripper_frame_sync' THEN 45 ELSE 60 END)) AS blocked, count(*) FILTER (w > 0) AS n_used FROM u GROUP BY 1),
g AS (SELECT session_id, round(score, 6) AS score, round(confidence, 6) AS confidence, blocked, n_used, CASE WHEN score >= 90 THEN 'A' WHEN score >= 75 THEN 'B' WHEN score >= 60 THEN 'C' WHEN score >= 45 THEN 'D' ELSE 'F' END AS grade, CASE WHEN blocked THEN 'BLOCKED' WHEN score >= 75 THEN 'GOOD' WHEN score >= 60 THEN 'ACCEPTABLE' ELSE 'BAD' END AS verdict FROM s)"""


def _graded(spark, d):
    x = table(spark, d, "lineitem").where("l_linenumber <= 4").groupBy(F.col("l_suppkey").alias("session_id"), "l_linenumber").agg((40 + F.avg("l_quantity")).alias("score"), (1 - F.avg("l_discount") * 6).alias("confidence"))
    names = F.element_at(F.array(*map(F.lit, ("gripper_ts", "video_tracker_sync", "video_quality", "gripper_frame_sync"))), F.col("l_linenumber"))
    dims = x.select("session_id", names.alias("name"), "score", "confidence", (F.col("confidence") < 0.55).alias("blocking"))
    return checks.combine_dimensions(dims, "session_id", checks.DIMENSIONS)


@query(DIMS + " SELECT * FROM g")
def weighted_score(spark, d):
    return _graded(spark, d).withColumn("score", r("score")).withColumn("confidence", r("confidence"))


@query(DIMS + """ SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN blocked THEN 'blocked' WHEN grade IN ('A', 'B') THEN 'AB' ELSE 'CDF' END AS bucket FROM g) GROUP BY 1""")
def triage_ab(spark, d):
    return tiers.triage(_graded(spark, d)).groupBy("bucket").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, round(greatest(0, least(1, (200000 - o_totalprice) / 150000)), 6) AS falling, round(greatest(0, least(1, (o_totalprice - 50000) / 150000)), 6) AS rising, CASE WHEN o_totalprice / 4000 >= 90 THEN 'A' WHEN o_totalprice / 4000 >= 75 THEN 'B' WHEN o_totalprice / 4000 >= 60 THEN 'C' WHEN o_totalprice / 4000 >= 45 THEN 'D' ELSE 'F' END AS grade FROM orders""")
def piecewise_scores(spark, d):
    x = F.col("o_totalprice")
    return table(spark, d, "orders").select("o_orderkey", r(falling_score(x, 50000, 200000)).alias("falling"), r(rising_score(x, 50000, 200000)).alias("rising"), grade(x / 4000).alias("grade"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN abs(q - 2) <= abs(q - 5) THEN 2.0 WHEN abs(q - 5) <= abs(q - 10) THEN 5.0 WHEN abs(q - 10) <= abs(q - 30) THEN 10.0 ELSE 30.0 END::DOUBLE AS level FROM (SELECT l_orderkey, l_linenumber, l_quantity AS q FROM lineitem)""")
def nominal_levels(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", nominal_level(F.col("l_quantity")).alias("level"))


@query("""SELECT l_returnflag, round(exp(sum(ln(1 - l_discount / 100))), 9) AS penalty FROM lineitem GROUP BY 1""")
def penalty_product(spark, d):
    li = table(spark, d, "lineitem").select("l_returnflag", (1 - F.col("l_discount") / 100).alias("f"))
    return checks.penalty_product(li, ["l_returnflag"], "f").withColumn("penalty", r("penalty", 9))


@query(METRICS + """, b AS (SELECT session_id, price / 3000 AS s FROM m), a AS (SELECT session_id, price / 3000 + (session_id % 7) - 4 AS s FROM m WHERE session_id % 5 > 0) SELECT b.session_id, round(b.s, 6) AS score_before, round(a.s, 6) AS score_after, coalesce(a.s >= b.s - 2, false) AS accepted, round(CASE WHEN a.s >= b.s - 2 THEN a.s ELSE b.s END, 6) AS score FROM b LEFT JOIN a USING (session_id)""")
def accept_if_improved(spark, d):
    m = _metrics(spark, d)
    before = m.select("session_id", (F.col("price") / 3000).alias("score"))
    after = m.where("session_id % 5 > 0").select("session_id", (F.col("price") / 3000 + F.col("session_id") % 7 - 4).alias("score"))
    return repair.accept_if_improved(before, after, ["session_id"], "score").withColumns({c: r(c) for c in ("score_before", "score_after", "score")})


@query("""WITH q AS (SELECT median(l_extendedprice) AS med, quantile_cont(l_quantity, 0.95) AS p FROM lineitem), m AS (SELECT greatest(median(abs(l_extendedprice - med)), 1e-4) AS mad FROM lineitem, q) SELECT l_orderkey, l_linenumber, abs(l_extendedprice - med) / mad > 1.5 AND l_quantity > 0.9 * p AS bad FROM lineitem, q, m""")
def tracker_baseline_flags(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    mm = selection.exact_median_mad(li, [], "l_extendedprice", floor=1e-4).drop("n")
    ref = mm.crossJoin(F.broadcast(li.agg(F.percentile("l_quantity", 0.95).alias("speed_p95"))))  # one row each
    return repair.baseline_flags(li, [], "l_extendedprice", "l_quantity", ref, 1.5, 0.9).select("l_orderkey", "l_linenumber", "bad")


# datasets

@query("""WITH l AS (SELECT l_orderkey AS episode, count(*) AS n FROM lineitem GROUP BY 1), o AS (SELECT episode, row_number() OVER (ORDER BY episode) - 1 AS episode_index, sum(n) OVER (ORDER BY episode) - n AS f FROM l)
SELECT episode, episode_index, row_number() OVER (PARTITION BY episode ORDER BY l_linenumber, l_quantity) - 1 AS frame_index, CAST(f AS BIGINT) + row_number() OVER (PARTITION BY episode ORDER BY l_linenumber, l_quantity) - 1 AS "index", l_quantity FROM (SELECT l_orderkey AS episode, l_linenumber, l_quantity FROM lineitem) JOIN o USING (episode)""")
def episode_index(spark, d):
    f = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("episode"), "l_linenumber", "l_quantity")
    out = dataset.episode_rows(f, "episode", "l_linenumber", ties=["l_quantity"])
    return out.select("episode", F.col("episode_index").cast("bigint").alias("episode_index"), F.col("frame_index").cast("bigint").alias("frame_index"), F.col("index").cast("bigint").alias("index"), "l_quantity")


def _near(kind: str) -> str:
    return f"""SELECT l.event_id, CASE WHEN b.us IS NULL OR f.us - l.us < l.us - b.us THEN f.us ELSE b.us END AS t, CASE WHEN b.us IS NULL OR f.us - l.us < l.us - b.us THEN f.value ELSE b.value END AS value FROM l
LEFT JOIN (SELECT l.event_id, v.us, v.value FROM l ASOF JOIN (SELECT user_id, us, max(value) AS value FROM e WHERE event_type = '{kind}' GROUP BY 1, 2) v ON l.user_id = v.user_id AND l.us >= v.us) b USING (event_id)
LEFT JOIN (SELECT l.event_id, v.us, v.value FROM l ASOF JOIN (SELECT user_id, us, max(value) AS value FROM e WHERE event_type = '{kind}' GROUP BY 1, 2) v ON l.user_id = v.user_id AND l.us <= v.us) f USING (event_id)"""


@query(E_SQL + f""", l AS (SELECT event_id, user_id, us FROM e WHERE event_type = 'click'), v AS ({_near('view')}), p AS ({_near('purchase')})
SELECT l.event_id, CASE WHEN abs(v.t - l.us) <= 43200000000 THEN v.value END AS view_value, CASE WHEN abs(p.t - l.us) <= 43200000000 THEN p.value END AS purchase_value FROM l LEFT JOIN v USING (event_id) LEFT JOIN p USING (event_id)""")
def frame_table(spark, d):
    e = events(spark, d)
    part = lambda k: e.where(F.col("event_type") == k).select("user_id", "us", "value")
    frames = e.where("event_type = 'click'").select("event_id", "user_id", "us")
    return dataset.frame_table(frames, {"view": part("view"), "purchase": part("purchase")}, ["user_id"], "us", 43_200_000_000).select("event_id", "view_value", "purchase_value")


@query("""SELECT 'l_quantity' AS "column", min(l_quantity) AS min, max(l_quantity) AS max, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std FROM lineitem UNION ALL SELECT 'l_extendedprice', min(l_extendedprice), max(l_extendedprice), round(avg(l_extendedprice), 6), round(stddev_pop(l_extendedprice), 6) FROM lineitem""")
def column_stats(spark, d):
    return dataset.column_stats(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"]).withColumn("mean", r("mean")).withColumn("std", r("std"))


@query("""SELECT event_id, u.o AS offset_ms, epoch_us(ts) - CAST(u.o * 1000 AS BIGINT) AS us FROM events, (VALUES (-200.0::DOUBLE), (0.0), (350.0)) u(o)""")
def desync_copies(spark, d):
    e = events(spark, d).select("event_id", (F.col("us") / 1000).alias("t"))
    return repair.desync(e, ["event_id"], "t", [-200.0, 0.0, 350.0]).select("event_id", "offset_ms", F.round(F.col("t") * 1000).cast("bigint").alias("us"))


@query()
def rebalanced_examples(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return stats.rebalance(x, "label", ratio=1, most=20_000)


# event time and sequential scans

@query(E_SQL + """, s AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) >= 21600000000 THEN 1 ELSE 0 END AS nw FROM e)) SELECT user_id, min(us) AS start_us, max(us) + 21600000000 AS end_us, count(*) AS n FROM s GROUP BY user_id, g""")
def gap_sessions(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    s = windows.gap_sessions(e, ["user_id"], "ts", "6 hours", [F.count("*").alias("n")])
    return s.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


@query(E_SQL + """ SELECT event_type, us // 3600000000 * 3600000000 AS start_us, count(*) AS n, round(sum(value), 4) AS total FROM e GROUP BY 1, 2""")
def tumbling_windows(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    s = windows.time_windows(e, ["event_type"], "ts", "1 hour", None, [F.count("*").alias("n"), F.sum("value").alias("total")])
    return s.select("event_type", F.unix_micros("start").alias("start_us"), "n", r("total", 4).alias("total"))


@query(E_SQL + """ SELECT event_type, (us // 1800000000 - k) * 1800000000 AS start_us, count(*) AS n FROM e, range(0, 2) r(k) GROUP BY 1, 2""")
def sliding_time_windows(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    s = windows.time_windows(e, ["event_type"], "ts", "1 hour", "30 minutes", [F.count("*").alias("n")])
    return s.select("event_type", F.unix_micros("start").alias("start_us"), "n")


def _seconds(spark, d):
    return events(spark, d).select("user_id", (F.col("us") / 1e6).alias("t"), "value")


@query("""WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS t, CASE WHEN value >= 60 THEN 1 WHEN value <= 40 THEN 0 END AS s FROM events),
f AS (SELECT user_id, t, event_id, last_value(s IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM e),
c AS (SELECT user_id, t, CASE WHEN s = 1 THEN 'rise' ELSE 'fall' END AS kind FROM (SELECT *, lag(s) OVER (PARTITION BY user_id ORDER BY t, event_id) AS p FROM f) WHERE s <> p),
n AS (SELECT a.user_id, a.t, a.kind, b.t AS nx FROM c a ASOF LEFT JOIN c b ON a.user_id = b.user_id AND a.t + 3600.0 <= b.t),
k AS (SELECT n.* FROM n JOIN (SELECT user_id, min(t) AS t FROM c GROUP BY 1) USING (user_id, t) UNION ALL SELECT n.* FROM k JOIN n ON n.user_id = k.user_id AND n.t = k.nx)
SELECT user_id, t, kind FROM k""")
def hysteresis_events(spark, d):
    return ev.hysteresis_events(_seconds(spark, d), ["user_id"], "t", "value", 60.0, 40.0, 3600.0)


@query()
def closure_events(spark, d):
    scaled = events(spark, d).withColumn("t", F.row_number().over(timebase.ordered(["user_id"], "us", "event_id")).cast("double"))
    return ev.closures(scaled, ["user_id"], "t", "value", -20.0, -5.0)


@query()
def signal_peaks(spark, d):
    return ev.peaks(_seconds(spark, d), ["user_id"], "t", "value", 75.0, 3, 5.0)


@query()
def greedy_matches(spark, d):
    e = events(spark, d)
    s = lambda k, n: e.where(F.col("event_type") == k).select("user_id", (F.col("us") / 1e6).alias(n))
    return ev.greedy_match(asof.match_within(s("purchase", "a"), s("view", "b"), ["user_id"], "a", "b", 1800.0), ["user_id"], "a", "b")


@query()
def greedy_topk(spark, d):
    return ev.greedy_topk(_seconds(spark, d), ["user_id"], "t", "value", 5, 86400.0)


#: Least-squares parabola over eleven samples, by orthogonal polynomials: 1, i and i * i - 10 with sums of squares 11, 110, 858.
@query("""WITH e AS (SELECT user_id, epoch_us(ts) / 1e6 AS t, value AS v, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
m AS (SELECT *, least(greatest(k, 5), n - 6) AS mid FROM e), o AS (SELECT unnest(range(-5, 6)) AS i)
SELECT m.user_id, m.t, round(CASE WHEN max(m.n) < 11 THEN max(m.v) ELSE sum(x.v * (1.0 / 11 + (m.k - mid) * i / 110.0 + (i * i - 10) * ((m.k - mid) ** 2 - 10) / 858.0)) END, 6) AS smooth
FROM m CROSS JOIN o JOIN e x ON x.user_id = m.user_id AND x.k = CASE WHEN m.n < 11 THEN m.k ELSE m.mid + i END GROUP BY m.user_id, m.t, m.k""")
def savgol(spark, d):
    return ev.savgol(_seconds(spark, d), ["user_id"], "t", "value").select("user_id", "t", r("smooth").alias("smooth"))


@query(GRID + """, zs AS (SELECT user_id, i, count(*) OVER w AS n, x - avg(x) OVER w AS u, y - avg(y) OVER w AS v FROM xy WINDOW w AS (PARTITION BY user_id)),
ft AS (SELECT user_id, n, f, sqrt(sum(u * cos(2 * pi() * i * f / n)) ** 2 + sum(u * sin(2 * pi() * i * f / n)) ** 2) AS fu, sqrt(sum(v * cos(2 * pi() * i * f / n)) ** 2 + sum(v * sin(2 * pi() * i * f / n)) ** 2) AS fv FROM (SELECT *, unnest(range(1, n // 2 + 1)) AS f FROM zs) GROUP BY 1, 2, 3),
sp AS (SELECT user_id, CASE WHEN count(*) > 2 AND stddev_pop(fu) > 1e-12 AND stddev_pop(fv) > 1e-12 THEN greatest(0.0, corr(fu, fv)) ELSE 0.0 END AS spectral FROM ft GROUP BY 1)
SELECT user_id, round(coalesce(spectral, 0.0), 6) AS spectral FROM (SELECT DISTINCT user_id FROM zs) LEFT JOIN sp USING (user_id)""")
def spectral_similarity(spark, d):
    return ev.spectral_similarity(_grid(spark, d), ["user_id"], "i", "x", "y").withColumn("spectral", r("spectral"))


@query(GRID + """, zs AS (SELECT user_id, i, count(*) OVER w AS n, count(*) OVER w >= 20 AND stddev_pop(x) OVER w >= 1e-8 AND stddev_pop(y) OVER w >= 1e-8 AS ok, (x - avg(x) OVER w) / nullif(stddev_pop(x) OVER w, 0) AS u, (y - avg(y) OVER w) / nullif(stddev_pop(y) OVER w, 0) AS v FROM xy WINDOW w AS (PARTITION BY user_id)),
gd AS (SELECT user_id, max(n) AS n, bool_and(ok) AS ok FROM zs GROUP BY 1), zk AS (SELECT * FROM zs WHERE ok),
cc AS (SELECT a.user_id, b.i - a.i AS lag, sum(a.u * b.v) / max(a.n) AS c FROM zk a JOIN zk b ON a.user_id = b.user_id AND b.i - a.i BETWEEN -6 AND 6 GROUP BY 1, 2),
bl AS (SELECT user_id, CAST(arg_max(lag, c) * 20 AS DOUBLE) AS lag_ms, max(c) AS ncc FROM cc GROUP BY 1), pe AS (SELECT user_id, avg(u * v) AS pearson FROM zk GROUP BY 1),
ft AS (SELECT user_id, f, sqrt(sum(u * cos(2 * pi() * i * f / n)) ** 2 + sum(u * sin(2 * pi() * i * f / n)) ** 2) AS fu, sqrt(sum(v * cos(2 * pi() * i * f / n)) ** 2 + sum(v * sin(2 * pi() * i * f / n)) ** 2) AS fv FROM (SELECT *, unnest(range(1, n // 2 + 1)) AS f FROM zk) GROUP BY 1, 2),
sp AS (SELECT user_id, greatest(0.0, corr(fu, fv)) AS spectral FROM ft GROUP BY 1),
al AS (SELECT user_id, lag_ms, ncc, pearson, spectral, least(1.0, greatest(0.0, (200 - abs(lag_ms)) / 180.0)) AS lag_score FROM bl JOIN pe USING (user_id) JOIN sp USING (user_id)),
sc AS (SELECT gd.user_id, n, coalesce(100 * (0.4 * greatest(0.0, ncc) + 0.25 * greatest(0.0, pearson) + 0.2 * lag_score + 0.15 * spectral), 0.0) AS score, coalesce(lag_ms, CAST(999 AS DOUBLE)) AS lag_ms, coalesce(ncc, 0.0) AS ncc, coalesce(pearson, 0.0) AS pearson, coalesce(spectral, 0.0) AS spectral, coalesce(lag_score, 0.0) AS lag_score, ok FROM gd LEFT JOIN al USING (user_id))
SELECT user_id, n, round(score, 6) AS score_100, lag_ms, round(ncc, 6) AS ncc, round(pearson, 6) AS pearson, round(spectral, 6) AS spectral, round(lag_score, 6) AS lag_score, CASE WHEN NOT ok THEN 'UNUSABLE' WHEN score >= 75 THEN 'GOOD' WHEN score >= 50 THEN 'FAIR' ELSE 'POOR' END AS verdict FROM sc""")
def alignment_report(spark, d):
    a = ev.alignment_report(_grid(spark, d), ["user_id"], "i", "x", "y", 20.0, 120.0)
    return a.withColumns({c: r(c) for c in ("score_100", "ncc", "pearson", "spectral", "lag_score")})


@query("""WITH e AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events), k AS (SELECT o, exp(-0.5 * (o / 1.5) ** 2) AS w FROM (SELECT unnest(range(-6, 7)) AS o)),
j AS (SELECT event_id, user_id, w, n, ((i + o) % (2 * n) + 2 * n) % (2 * n) AS m FROM e, k), p AS (SELECT event_id, user_id, w, CASE WHEN m >= n THEN 2 * n - 1 - m ELSE m END AS i FROM j)
SELECT p.event_id, round(sum(w * value) / (SELECT sum(w) FROM k), 6) AS smooth FROM p JOIN e ON e.user_id = p.user_id AND e.i = p.i GROUP BY 1""")
def gaussian_smooth(spark, d):
    x = events(spark, d).withColumn("o", F.row_number().over(timebase.ordered(["user_id"], "us", "event_id")))
    return smooth.gaussian(x, ["user_id"], "o", "value", 1.5, "smooth").select("event_id", r("smooth").alias("smooth"))


@query("""WITH h AS (SELECT user_id, event_type, epoch_us(ts) / 3.6e9 AS t, avg(value) AS v FROM events WHERE value IS NOT NULL GROUP BY 1, 2, 3),
a0 AS (SELECT user_id, t, v FROM h WHERE event_type = 'view'), b0 AS (SELECT user_id, t, v FROM h WHERE event_type = 'click'),
m1 AS (SELECT user_id, unnest([-48.0::DOUBLE, -24.0, 0.0, 24.0, 48.0]) AS lag FROM (SELECT DISTINCT user_id FROM b0)), bs1 AS (SELECT b0.user_id, lag, t + lag AS t, v FROM b0 JOIN m1 USING (user_id)),
g1 AS (SELECT user_id, lag, s + i * 12.0 AS t FROM (SELECT *, unnest(range(0, CAST(floor((z - s) / 12.0) AS BIGINT) + 1)) AS i FROM (SELECT b.user_id, lag, greatest(min(b.t), max(a.lo)) AS s, least(max(b.t), max(a.hi)) AS z FROM bs1 b JOIN (SELECT user_id, min(t) AS lo, max(t) AS hi FROM a0 GROUP BY 1) a USING (user_id) GROUP BY 1, 2) WHERE z >= s)),
x1 AS (SELECT g.user_id, lag, g.t, CASE WHEN n.t = g.t OR t2 IS NULL THEN v ELSE v + (v2 - v) * (g.t - n.t) / (t2 - n.t) END AS x FROM g1 g ASOF JOIN (SELECT *, lead(t) OVER w AS t2, lead(v) OVER w AS v2 FROM a0 WINDOW w AS (PARTITION BY user_id ORDER BY t)) n ON g.user_id = n.user_id AND g.t >= n.t),
y1 AS (SELECT g.user_id, g.lag, x, CASE WHEN n.t = g.t OR t2 IS NULL THEN v ELSE v + (v2 - v) * (g.t - n.t) / (t2 - n.t) END AS y FROM x1 g ASOF JOIN (SELECT *, lead(t) OVER w AS t2, lead(v) OVER w AS v2 FROM bs1 WINDOW w AS (PARTITION BY user_id, lag ORDER BY t)) n ON g.user_id = n.user_id AND g.lag = n.lag AND g.t >= n.t),
s1 AS (SELECT user_id, lag, CASE WHEN stddev_pop(x) < 1e-8 OR stddev_pop(y) < 1e-8 OR count(*) < 3 THEN 0.0 ELSE round(corr(x, y), 9) END AS score FROM y1 GROUP BY 1, 2),
r1 AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, lag) AS k, lead(score) OVER (PARTITION BY user_id ORDER BY score DESC, lag) AS second FROM s1),
m2 AS (SELECT user_id, lag + unnest([-24.0::DOUBLE, -18.0, -12.0, -6.0, 0.0, 6.0, 12.0, 18.0, 24.0]) AS lag FROM r1 WHERE k = 1), bs2 AS (SELECT b0.user_id, lag, t + lag AS t, v FROM b0 JOIN m2 USING (user_id)),
g2 AS (SELECT user_id, lag, s + i * 12.0 AS t FROM (SELECT *, unnest(range(0, CAST(floor((z - s) / 12.0) AS BIGINT) + 1)) AS i FROM (SELECT b.user_id, lag, greatest(min(b.t), max(a.lo)) AS s, least(max(b.t), max(a.hi)) AS z FROM bs2 b JOIN (SELECT user_id, min(t) AS lo, max(t) AS hi FROM a0 GROUP BY 1) a USING (user_id) GROUP BY 1, 2) WHERE z >= s)),
x2 AS (SELECT g.user_id, lag, g.t, CASE WHEN n.t = g.t OR t2 IS NULL THEN v ELSE v + (v2 - v) * (g.t - n.t) / (t2 - n.t) END AS x FROM g2 g ASOF JOIN (SELECT *, lead(t) OVER w AS t2, lead(v) OVER w AS v2 FROM a0 WINDOW w AS (PARTITION BY user_id ORDER BY t)) n ON g.user_id = n.user_id AND g.t >= n.t),
y2 AS (SELECT g.user_id, g.lag, x, CASE WHEN n.t = g.t OR t2 IS NULL THEN v ELSE v + (v2 - v) * (g.t - n.t) / (t2 - n.t) END AS y FROM x2 g ASOF JOIN (SELECT *, lead(t) OVER w AS t2, lead(v) OVER w AS v2 FROM bs2 WINDOW w AS (PARTITION BY user_id, lag ORDER BY t)) n ON g.user_id = n.user_id AND g.lag = n.lag AND g.t >= n.t),
s2 AS (SELECT user_id, lag, CASE WHEN stddev_pop(x) < 1e-8 OR stddev_pop(y) < 1e-8 OR count(*) < 3 THEN 0.0 ELSE round(corr(x, y), 9) END AS score FROM y2 GROUP BY 1, 2),
r2 AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, lag) AS k, lead(score) OVER (PARTITION BY user_id ORDER BY score DESC, lag) AS second FROM s2)
SELECT user_id AS session_id, 0 AS pair, lag, round(score, 6) AS score, score >= 0.5 AND coalesce(score - second, 0.0) >= 0.02 AS reliable FROM r2 WHERE k = 1""")
def pair_estimates(spark, d):
    e = events(spark, d)
    flux = e.select(F.col("user_id").alias("session_id"), F.col("event_type").alias("flux"), (F.col("us") / 3.6e9).alias("t"), "value")
    pairs = sync.flux_pairs(flux, [("view", "click")])
    return sync.estimate_pairs(flux, pairs, step=12.0, max_lag=48.0, coarse=24.0, fine=6.0).select("session_id", "pair", "lag", r("score").alias("score"), "reliable")


@query("""WITH q AS (SELECT o_orderpriority, o_totalprice AS v FROM orders) SELECT o_orderpriority, count(*) AS n, round(quantile_cont(v, 0.02), 4) AS p02, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.98), 4) AS p98 FROM q GROUP BY 1""")
def selected_percentiles(spark, d):
    o = table(spark, d, "orders").select("o_orderpriority", F.col("o_totalprice").cast("double").alias("v"))
    s = selection.exact_percentiles(o, ["o_orderpriority"], "v", [0.02, 0.5, 0.98], last=200, bins=16)
    return s.select("o_orderpriority", "n", *[r(f"p{i}", 4).alias(n) for i, n in enumerate(("p02", "p50", "p98"))])


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS number FROM orders""")
def numbered_episodes(spark, d):
    return selection.number_rows(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", parts=8)


#: Windows of six grid points as examples of a session: label 1 for like signals, 0 for unlike ones, none between.
EXAMPLES = """, xw AS (SELECT xy.user_id, w, corr(x, y) AS c, stddev_pop(x) AS sx, stddev_pop(y) AS sy FROM xy JOIN (SELECT user_id, unnest(range(0, CAST(floor((count(*) - 6) / 3.0) AS BIGINT) + 1)) AS w FROM xy GROUP BY user_id HAVING count(*) >= 6) o ON o.user_id = xy.user_id AND xy.i BETWEEN w * 3 AND w * 3 + 5 GROUP BY 1, 2),
xs AS (SELECT user_id, w, CASE WHEN sx < 1e-8 OR sy < 1e-8 THEN 0.0 ELSE c END AS c FROM xw), xl AS (SELECT user_id, w, c, CASE WHEN c >= 0.72 THEN 1 WHEN c <= 0.22 THEN 0 END AS label FROM xs)"""


@query(GRID + EXAMPLES + """ SELECT user_id, w AS window_id, label, round(c, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY user_id, label ORDER BY md5(user_id || '|' || w || '|42')) AS o FROM xl WHERE label IS NOT NULL) WHERE o <= 2""")
def pseudo_examples(spark, d):
    """Labelled windows of every session, at most two of each label, by least hash."""
    w = smooth.sliding_windows(_grid(spark, d), ["user_id"], "i", 6, 3).groupBy("user_id", "window_id").agg(stats.safe_corr("x", "y").alias("c"))
    labelled = w.select("user_id", "window_id", checks.decided(F.col("c"), 0.72, 0.22).alias("label"), r("c").alias("score")).where("label is not null")
    return selection.keyed_sample(labelled, ["user_id", "label"], 2, ["user_id", "window_id"])


# composite signals

@query(GRID + """, w AS (SELECT xy.user_id, k, x, y FROM xy JOIN (SELECT user_id, unnest(range(0, CAST(floor((count(*) - 12) / 6.0) AS BIGINT) + 1)) AS k FROM xy GROUP BY user_id HAVING count(*) >= 12) g ON g.user_id = xy.user_id AND xy.i BETWEEN k * 6 AND k * 6 + 11),
c AS (SELECT user_id, k, CASE WHEN stddev_pop(x) < 1e-8 OR stddev_pop(y) < 1e-8 THEN 0 ELSE corr(x, y) END AS r FROM w GROUP BY 1, 2 HAVING stddev_pop(x) >= 10) SELECT user_id, count(*) AS n_windows, round(median(r), 6) AS median_r, round(min(r), 6) AS min_r FROM c GROUP BY 1""")
def rolling_correlation(spark, d):
    s = signals.rolling_correlation(_grid(spark, d), ["user_id"], "i", "x", "y", 12, 6, 10.0)
    return s.withColumn("median_r", r("median_r")).withColumn("min_r", r("min_r"))


@query(GRID + """ SELECT user_id, i, CASE WHEN x <= 20 THEN 'left_closed' ELSE 'right_closed' END AS state, round(abs(x - y), 6) AS gap FROM xy WHERE (x <= 20 AND y >= 60) OR (y <= 20 AND x >= 60)""")
def asymmetric_moments(spark, d):
    e = events(spark, d)
    part = lambda k: e.where(F.col("event_type") == k).select("user_id", F.col("us").alias("t"), "value")
    return signals.asymmetric_moments(part("click"), part("view"), ["user_id"], HOURS, 20.0, 60.0).select("user_id", "i", "state", r("gap").alias("gap"))


@query("""WITH s AS (SELECT user_id, event_type, avg(value) AS m, stddev_pop(value) AS s FROM events GROUP BY 1, 2), w AS (SELECT *, CASE WHEN s > 1e-9 THEN CASE event_type WHEN 'view' THEN 0.5 WHEN 'click' THEN 0.3 WHEN 'purchase' THEN 0.2 ELSE 0 END * s * abs(m) ELSE 0 END AS w FROM s)
SELECT user_id, event_type, round(CASE WHEN sum(w) OVER (PARTITION BY user_id) > 0 THEN w / sum(w) OVER (PARTITION BY user_id) ELSE 1.0 / count(*) OVER (PARTITION BY user_id) END, 6) AS weight FROM w""")
def adaptive_weights(spark, d):
    return signals.adaptive_weights(events(spark, d), ["user_id"], "event_type", "value", {"view": 0.5, "click": 0.3, "purchase": 0.2}).withColumn("weight", r("weight"))


@query("""WITH t AS (SELECT user_id, value, epoch_us(ts) / 1e6 AS t, lead(value) OVER w AS v2, lead(epoch_us(ts) / 1e6) OVER w AS t2 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT user_id, count(*) FILTER (value >= 50 AND v2 <= 50 AND value <> v2) > 0 AS crossed, round(coalesce(min(t + (50 - value) / nullif(v2 - value, 0) * (t2 - t)) FILTER (value >= 50 AND v2 <= 50 AND value <> v2), arg_min(t, value)), 2) AS t FROM t GROUP BY 1""")
def level_crossings(spark, d):
    return signals.crossing(_seconds(spark, d), ["user_id"], "t", "value", F.lit(50.0)).select("user_id", "crossed", r("t", 2).alias("t"))


@query("""WITH x AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS t FROM events), g AS (SELECT *, lag(value) OVER w AS a, lead(value) OVER w AS b FROM x WINDOW w AS (PARTITION BY user_id ORDER BY t)),
f AS (SELECT user_id, t, value, t - row_number() OVER (PARTITION BY user_id ORDER BY t) AS k FROM g WHERE abs(CASE WHEN a IS NULL THEN b - value WHEN b IS NULL THEN value - a ELSE (b - a) / 2 END) < 10.0)
SELECT user_id, CAST(min(t) AS DOUBLE) AS start, CAST(max(t) AS DOUBLE) AS "end", count(*) AS n, round(avg(value), 6) AS level, round(stddev_pop(value), 6) AS jitter, round(arg_max(value, t) - arg_min(value, t), 6) AS drift FROM f GROUP BY user_id, k HAVING max(t) - min(t) >= 2""")
def plateau_segments(spark, d):
    x = events(spark, d).withColumn("t", F.row_number().over(timebase.ordered(["user_id"], "us", "event_id")).cast("double"))
    return signals.plateaus(x, ["user_id"], "t", "value", 10.0, 2.0).withColumns({c: r(c) for c in ("level", "jitter", "drift")})


@query()
def model_windows(spark, d):
    return signals.model_windows(_grid(spark, d), ["user_id"], "i", "x", 16, 8)


# more checks, sync and roles

@query("""WITH t AS (SELECT o_custkey % 50 AS s, o_orderpriority AS v, o_orderkey AS o FROM orders WHERE o_orderkey % 40 < 3), c AS (SELECT s, v, count(*) AS n, min(o) AS o FROM t GROUP BY 1, 2), m AS (SELECT s, arg_min(v, -n * 1000000000 + o) AS winner, max(n) AS votes, CAST(sum(n) AS BIGINT) AS n_tests FROM c GROUP BY 1)
SELECT s, winner, votes, n_tests, CAST(CASE WHEN votes = n_tests AND votes >= 3 THEN 1.0 WHEN votes >= 3 THEN 0.85 WHEN votes = 2 AND n_tests = 2 THEN 0.8 ELSE 0.55 END AS DOUBLE) AS confidence FROM m""")
def consensus_votes(spark, d):
    t = table(spark, d, "orders").where("o_orderkey % 40 < 3").select((F.col("o_custkey") % 50).alias("s"), F.col("o_orderpriority").alias("vote"), F.col("o_orderkey").alias("ord"))
    return roles.consensus(t, "s").select("s", "winner", "votes", "n_tests", "confidence")


@query("""WITH v AS (SELECT l_suppkey AS k, 40 + avg(l_quantity) AS vs, 1 - avg(l_discount) * 4 AS vc, avg(l_tax) * 8 AS inv, 0.4 + avg(l_discount) * 4 AS rr FROM lineitem WHERE l_linenumber = 1 GROUP BY 1), p AS (SELECT l_suppkey AS k, 35 + avg(l_quantity) AS ps, 0.5 + avg(l_tax) AS pc FROM lineitem WHERE l_linenumber = 2 GROUP BY 1),
j AS (SELECT k, vs, vc, ps, pc, (vs IS NULL OR vc < 0.75 OR inv > 0.40 OR rr < 0.50) AS weak, (vs * vc + ps * pc) / nullif(vc + pc, 0) AS blend FROM v FULL JOIN p USING (k))
SELECT k, coalesce(weak, false) AS visual_weak, round(CASE WHEN weak THEN coalesce(ps, 50) WHEN ps IS NULL THEN vs WHEN vs >= 60 THEN greatest(vs, coalesce(blend, vs)) ELSE coalesce(blend, vs) END, 6) AS score, round(CASE WHEN weak THEN coalesce(pc, 0.3) ELSE greatest(vc, coalesce(pc, 0)) END, 6) AS confidence FROM j""")
def fused_scores(spark, d):
    li = table(spark, d, "lineitem")
    v = li.where("l_linenumber = 1").groupBy(F.col("l_suppkey").alias("k")).agg((40 + F.avg("l_quantity")).alias("score"), (1 - F.avg("l_discount") * 4).alias("confidence"), (F.avg("l_tax") * 8).alias("invalid_share"), (0.4 + F.avg("l_discount") * 4).alias("rolling_r"))
    p = li.where("l_linenumber = 2").groupBy(F.col("l_suppkey").alias("k")).agg((35 + F.avg("l_quantity")).alias("score"), (0.5 + F.avg("l_tax")).alias("confidence"))
    return checks.fuse_scores(v, p, ["k"]).select("k", F.coalesce("visual_weak", F.lit(False)).alias("visual_weak"), r("score").alias("score"), r("confidence").alias("confidence"))


@query("""WITH m AS (SELECT user_id, event_type, count(*) % 7 AS nd, count(*) % 11 AS nm, (count(*) % 5) * 1.5 AS j, 28.0 + count(*) % 12 AS dt FROM events GROUP BY 1, 2), s AS (SELECT user_id, greatest(0, 100 - (least(40.0, 4.0 * nd) + least(30.0, 2.0 * nm) + CASE WHEN j > 5 THEN 15.0 WHEN j > 2 THEN 5.0 ELSE 0 END + CASE WHEN NOT dt BETWEEN 30 AND 37 THEN 15.0 ELSE 0 END)) AS s FROM m)
SELECT user_id, round(avg(s), 6) AS score, CAST(min(s) AS DOUBLE) AS worst, count(*) AS n_cameras FROM s GROUP BY 1""")
def video_quality(spark, d):
    n = F.count("*")
    m = events(spark, d).groupBy(*BY).agg((n % 7).alias("n_drops"), (n % 11).alias("n_missing"), ((n % 5) * 1.5).alias("jitter"), (28.0 + n % 12).alias("dt_mean"))
    return checks.video_quality(m, BY, "user_id").withColumn("score", r("score"))


@query("""SELECT o_custkey AS session_id, bool_and(o_totalprice < 300000) AS accepted, coalesce(list_sort(list(DISTINCT o_orderpriority) FILTER (o_totalprice >= 300000)), [])::VARCHAR AS failed FROM orders GROUP BY 1""")
def ingress(spark, d):
    c = table(spark, d, "orders").select(F.col("o_custkey").alias("session_id"), F.col("o_orderpriority").alias("check"), (F.col("o_totalprice") < 300000).alias("ok"))
    out = checks.ingress(c, "session_id")
    return out.select("session_id", "accepted", F.concat(F.lit("["), F.array_join("failed", ", "), F.lit("]")).alias("failed"))


@query("""WITH p AS (SELECT o_custkey AS session_id, o_orderpriority AS pair, o_totalprice / 4999 AS s FROM (SELECT o_custkey, o_orderpriority, avg(o_totalprice) AS o_totalprice FROM orders GROUP BY 1, 2))
SELECT session_id, round(min(s), 6) AS score, round(avg(s), 6) AS mean, round(median(s), 6) AS median, round(max(s), 6) AS best, arg_min(pair, s) AS worst_pair, arg_max(pair, s) AS best_pair FROM p GROUP BY 1""")
def session_score(spark, d):
    p = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("session_id"), F.col("o_orderpriority").alias("pair")).agg((F.avg("o_totalprice") / 4999).alias("score_100"))
    return sync.session_score(p).withColumns({c: r(c) for c in ("score", "mean", "median", "best")})


@query("""WITH p AS (SELECT o_custkey AS session_id, avg(o_totalprice) / 2999 AS s, stddev_pop(o_shippriority_) AS sp FROM (SELECT o_custkey, o_totalprice, o_orderkey % 997 AS o_shippriority_ FROM orders) GROUP BY 1) SELECT session_id, round(s, 6) AS mean_score, round(sp, 6) AS shift_spread, s >= 50 AND coalesce(sp, 0) <= 200 AS valid FROM p""")
def sync_validation(spark, d):
    s = table(spark, d, "orders").select(F.col("o_custkey").alias("session_id"), F.col("o_orderpriority").alias("pair"), (F.col("o_totalprice") / 2999).alias("score_100"), (F.col("o_orderkey") % 997).alias("shift_ms"))
    return sync.validate(s).select("session_id", r("mean_score").alias("mean_score"), r("shift_spread").alias("shift_spread"), "valid")


@query("""WITH x AS (SELECT c_custkey AS session, c_acctbal / 100 AS score, CASE WHEN c_acctbal / 100 >= 90 THEN 'A' WHEN c_acctbal / 100 >= 75 THEN 'B' WHEN c_acctbal / 100 >= 60 THEN 'C' WHEN c_acctbal / 100 >= 45 THEN 'D' ELSE 'F' END AS grade FROM customer)
SELECT session, grade FROM x WHERE grade IN ('A', 'B') AND score >= 80 AND session NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def ship_decision(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("session"), (F.col("c_acctbal") / 100).alias("score"))
    c = c.withColumn("grade", grade(F.col("score")))
    sent = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("session"))
    return tiers.ship_decision(c, sent, "session", F.col("score"), 80.0).select("session", "grade")


@query(E_SQL + """, s AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY event_id) > 864000000000 THEN 1 ELSE 0 END AS nw FROM e)), w AS (SELECT user_id, min(us) AS w0, max(us) AS w1 FROM e WHERE event_type = 'view' GROUP BY 1),
b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, g) AS k FROM (SELECT s.user_id, g, greatest(0.0, least(max(us), any_value(w1)) - greatest(min(us), any_value(w0))) / nullif(any_value(w1) - any_value(w0), 0) AS c FROM s JOIN w USING (user_id) GROUP BY 1, 2) WHERE c >= 0.1)
SELECT s.user_id, event_id, row_number() OVER (PARTITION BY s.user_id ORDER BY us, event_id) - 1 AS "index" FROM s LEFT JOIN (SELECT user_id, g AS bg FROM b WHERE k = 1) b ON s.user_id = b.user_id WHERE bg IS NULL OR g = bg""")
def camera_gap_repair(spark, d):
    e = events(spark, d)
    w = e.where("event_type = 'view'").groupBy("user_id").agg(F.min("us").alias("w0"), F.max("us").alias("w1"))
    out = repair.repair_camera_gaps(e, ["user_id"], "event_id", "us", w, threshold=864_000_000_000, least_duration=0.0, least_coverage=0.1)
    return out.select("user_id", "event_id", F.col("index").cast("bigint").alias("index"))


@query(E_SQL + """, a AS (SELECT user_id, min(us) AS t FROM e WHERE event_type = 'view' GROUP BY 1), f AS (SELECT user_id, median(us) AS f FROM (SELECT user_id, us, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM e WHERE event_type = 'click') WHERE k <= 3 GROUP BY 1) SELECT user_id, CAST(a.t - f.f AS DOUBLE) AS shift_ms FROM a JOIN f USING (user_id)""")
def first_frames_offset(spark, d):
    e = events(spark, d)
    return repair.first_frames_offset(e.where("event_type = 'click'"), e.where("event_type = 'view'"), ["user_id"], "event_id", "us")


@query("""SELECT session_id, next_step, failed FROM (WITH s AS (SELECT o_custkey % 200 AS session_id, (['detect', 'check_sync', 'verify', 'rotate', 'tracker', 'video', 'verify_labels', 'flux', 'align', 'validate', 'store', 'test'])[o_orderkey % 12 + 1] AS step, o_orderkey AS e, CASE o_orderstatus WHEN 'F' THEN 'failed' ELSE 'done' END AS status FROM orders),
l AS (SELECT session_id, step, arg_max(status, e) AS status FROM s GROUP BY 1, 2), d AS (SELECT session_id, coalesce(list(step) FILTER (status = 'done'), []) AS done, bool_or(status = 'failed') AS failed FROM l GROUP BY 1)
SELECT session_id, list_filter(['detect', 'check_sync', 'verify', 'rotate', 'tracker', 'video', 'verify_labels', 'flux', 'align', 'validate', 'store', 'test'], lambda x: NOT list_contains(done, x))[1] AS next_step, failed FROM d)""")
def next_step(spark, d):
    step = F.element_at(F.array(*map(F.lit, tiers.STEPS)), (F.col("o_orderkey") % 12 + 1).cast("int"))
    s = table(spark, d, "orders").select((F.col("o_custkey") % 200).alias("session_id"), step.alias("step"), F.col("o_orderkey").alias("ended_at"), F.when(F.col("o_orderstatus") == "F", "failed").otherwise("done").alias("status"))
    return tiers.next_step(s)


@query(E_SQL + """ SELECT user_id, 'events' AS stream, col AS "column", count(*) AS n, round(sum(v), 3) AS total FROM (SELECT user_id, unnest(['event_id', 'value']) AS col, unnest([CAST(event_id AS DOUBLE), value]) AS v FROM e) WHERE v IS NOT NULL GROUP BY 1, 3""")
def timeline(spark, d):
    e = events(spark, d).select(F.col("user_id").alias("session_id"), F.col("us").alias("t_ms"), "event_id", "value")
    return dataset.timeline({"events": e}).where("value is not null").groupBy(F.col("session_id").alias("user_id"), "stream", "column").agg(F.count("*").alias("n"), r(F.sum("value"), 3).alias("total"))


@query("""WITH e AS (SELECT label, vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings), s AS (SELECT label, vec_id, sqrt((x - coalesce(lag(x) OVER w, x)) ** 2 + (y - coalesce(lag(y) OVER w, y)) ** 2 + (z - coalesce(lag(z) OVER w, z)) ** 2) / 16.0 AS s FROM e WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
a AS (SELECT *, abs(s - coalesce(lag(s) OVER (PARTITION BY label ORDER BY vec_id), s)) / 16.0 AS a FROM s), j AS (SELECT *, abs(a - coalesce(lag(a) OVER (PARTITION BY label ORDER BY vec_id), a)) / 16.0 AS j FROM a),
m AS (SELECT label, vec_id, s - avg(s) OVER o AS s, stddev_pop(s) OVER o AS ss, a - avg(a) OVER o AS a, stddev_pop(a) OVER o AS sa, j - avg(j) OVER o AS j, stddev_pop(j) OVER o AS sj FROM j WINDOW o AS (PARTITION BY label))
SELECT label, vec_id, round(0.55 * CASE WHEN ss < 1e-8 THEN s ELSE s / ss END + 0.30 * CASE WHEN sa < 1e-8 THEN a ELSE a / sa END + 0.15 * CASE WHEN sj < 1e-8 THEN j ELSE j / sj END, 6) AS motion FROM m""")
def motion_signal(spark, d):
    e = table(spark, d, "embeddings").select("label", "vec_id", *[F.col("embedding")[k].cast("double").alias(c) for k, c in enumerate("xyz")])
    return smooth.motion_signal(e, ["label"], "vec_id", ("x", "y", "z"), 16.0).select("label", "vec_id", r("motion").alias("motion"))


@query("""WITH e AS (SELECT user_id, epoch_us(ts) / 1e6 AS t, value AS a FROM events), d AS (SELECT *, coalesce(t - lag(t) OVER (PARTITION BY user_id ORDER BY t), 0.0) AS dt FROM e), v AS (SELECT *, sum(a * dt) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS v FROM d),
w AS (SELECT user_id, t, dt, v - avg(v) OVER o - coalesce(covar_pop(v, t) OVER o / nullif(var_pop(t) OVER o, 0), 0) * (t - avg(t) OVER o) AS v FROM v WINDOW o AS (PARTITION BY user_id)), p AS (SELECT *, sum(v * dt) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS p FROM w),
q AS (SELECT user_id, t, p - avg(p) OVER o - coalesce(covar_pop(p, t) OVER o / nullif(var_pop(t) OVER o, 0), 0) * (t - avg(t) OVER o) AS p FROM p WINDOW o AS (PARTITION BY user_id))
SELECT user_id, t, round(p / 1e6, 0) AS position FROM q""")
def double_integral(spark, d):
    return smooth.double_integral(_seconds(spark, d), ["user_id"], "t", "value").select("user_id", "t", r(F.col("position") / 1e6, 0).alias("position"))


@query("""WITH b AS (SELECT vec_id // 40 AS session, vec_id % 4 AS block, (vec_id % 40) // 4 AS row, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings WHERE vec_id % 4 < 3),
st AS (SELECT *, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2 + (z - lag(z) OVER w) ** 2) AS step FROM b WINDOW w AS (PARTITION BY session, block ORDER BY row)), own AS (SELECT session, block, median(z) AS height, median(step) AS mobility FROM st GROUP BY 1, 2),
far AS (SELECT p.session, p.block, avg(sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2 + (p.z - q.z) ** 2)) AS centrality FROM b p JOIN b q ON p.session = q.session AND p.row = q.row AND p.block <> q.block GROUP BY 1, 2), f AS (SELECT * FROM own LEFT JOIN far USING (session, block)),
pt AS (SELECT session, block, 3.0 * greatest(3 - row_number() OVER (PARTITION BY session ORDER BY height DESC, block), 0) + 1.0 * greatest(3 - row_number() OVER (PARTITION BY session ORDER BY mobility, block), 0) + 2.0 * greatest(3 - row_number() OVER (PARTITION BY session ORDER BY centrality, block), 0) AS points FROM f)
SELECT session, block, CAST(points AS DOUBLE) AS points, row_number() OVER (PARTITION BY session ORDER BY points DESC, block) = 1 AS is_head FROM pt""")
def head_features(spark, d):
    e = table(spark, d, "embeddings").where("vec_id % 4 < 3").select((F.col("vec_id") / 40).cast("bigint").alias("session"), (F.col("vec_id") % 4).alias("block"), F.floor(F.col("vec_id") % 40 / 4).alias("row"), F.slice(F.col("embedding").cast("array<double>"), 1, 3).alias("pos"))
    return roles.rank_points(roles.block_features(e, "session", "block", "row"), "session", "block").select("session", "block", "points", "is_head")


@query("""WITH b AS (SELECT vec_id // 40 AS session, vec_id % 4 AS block, (vec_id % 40) // 4 AS row, CAST(embedding[1] AS DOUBLE) AS px, CAST(embedding[2] AS DOUBLE) AS py, CAST(embedding[3] AS DOUBLE) AS pz, CAST(embedding[4] AS DOUBLE) AS q0, CAST(embedding[5] AS DOUBLE) AS q1, CAST(embedding[6] AS DOUBLE) AS q2, CAST(embedding[7] AS DOUBLE) AS q3 FROM embeddings),
h AS (SELECT *, sqrt(q0 ** 2 + q1 ** 2 + q2 ** 2 + q3 ** 2) AS n FROM b WHERE block = 0), m AS (SELECT session, row, px, py, pz, 0 AS mode, q0 / n AS w, q1 / n AS x, q2 / n AS y, q3 / n AS z FROM h UNION ALL SELECT session, row, px, py, pz, 1, q3 / n, q0 / n, q1 / n, q2 / n FROM h),
c AS (SELECT session, row, px, py, pz, mode, unnest([0, 1, 2]) AS axis, unnest([1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)]) AS cx, unnest([2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)]) AS cy, unnest([2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]) AS cz FROM m),
s AS (SELECT c.session, b.block, mode, axis, median((b.px - c.px) * cx + (b.py - c.py) * cy + (b.pz - c.pz) * cz) AS side FROM c JOIN b ON b.session = c.session AND b.row = c.row AND b.block IN (1, 2) GROUP BY 1, 2, 3, 4)
SELECT session, CAST(mode * 6 + axis * 2 + CASE WHEN sign < 0 THEN 1 ELSE 0 END AS INTEGER) AS rule_id, arg_max(block, side * sign) AS right_block, round(max(side) - min(side), 6) AS separation FROM s, (VALUES (1), (-1)) v(sign) GROUP BY 1, 2""")
def hand_rules(spark, d):
    e = table(spark, d, "embeddings").select((F.col("vec_id") / 40).cast("bigint").alias("session"), (F.col("vec_id") % 4).alias("block"), F.floor(F.col("vec_id") % 40 / 4).alias("row"), F.slice(F.col("embedding").cast("array<double>"), 1, 3).alias("pos"), F.slice(F.col("embedding").cast("array<double>"), 4, 4).alias("quat"))
    votes = roles.rule_votes(e.where("block = 0").select("session", "row", "pos", "quat"), e.where("block in (1, 2)").select("session", "row", "block", "pos"), roles.candidate_rules(spark), "session", "row")
    return votes.select("session", "rule_id", "right_block", r("separation").alias("separation"))


from . import session_queries  # noqa: E402, F401  registers more queries
