"""Which tracker is the head, which hand is left: rank points, geometric rules, votes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..functions.pose import dot, quaternion, rotation_column
from ..functions.scalars import clamp, logistic


def block_features(rows: DataFrame, session: str, block: str, order: str, pos: str = "pos") -> DataFrame:
    """Median height, spread, step length and mean distance to the other blocks of each tracker block."""
    step = F.sqrt(sum(((F.col(pos)[k] - F.lag(F.col(pos)[k]).over(W.partitionBy(session, block).orderBy(order))) ** 2 for k in (1, 2)), (F.col(pos)[0] - F.lag(F.col(pos)[0]).over(W.partitionBy(session, block).orderBy(order))) ** 2))
    own = rows.withColumn("_step", step).groupBy(session, block).agg(F.median(F.col(pos)[2]).alias("height"), F.stddev_pop(F.col(pos)[2]).alias("spread"), F.median("_step").alias("mobility"))
    a, b = rows.alias("a"), rows.alias("b")
    far = F.sqrt(sum(((F.col(f"a.{pos}")[k] - F.col(f"b.{pos}")[k]) ** 2 for k in (1, 2)), (F.col(f"a.{pos}")[0] - F.col(f"b.{pos}")[0]) ** 2))
    # three blocks a session: each row meets its two peers
    centre = a.join(b, (F.col(f"a.{session}") == F.col(f"b.{session}")) & (F.col(f"a.{order}") == F.col(f"b.{order}")) & (F.col(f"a.{block}") != F.col(f"b.{block}"))).groupBy(F.col(f"a.{session}").alias(session), F.col(f"a.{block}").alias(block)).agg(F.avg(far).alias("centrality"))
    return own.join(centre, [session, block], "left")


#: Weights of the rank points of each feature, and whether more of it speaks for the head.
HEAD_FEATURES = {"height": (3.0, True), "mobility": (1.0, False), "centrality": (2.0, False)}


def rank_points(features: DataFrame, session: str, block: str, weights: dict[str, tuple[float, bool]] = HEAD_FEATURES) -> DataFrame:
    """2, 1, 0 points by rank within the session for each feature, weighted and summed; the best block is the head."""
    total = F.lit(0.0)
    for name, (weight, more) in weights.items():
        w = W.partitionBy(session).orderBy(F.desc(name) if more else F.asc(name), block)
        total = total + weight * F.greatest(F.lit(3) - F.row_number().over(w), F.lit(0))
    points = features.withColumn("points", total)
    best = W.partitionBy(session).orderBy(F.desc("points"), block)
    return points.withColumn("place", F.row_number().over(best)).withColumn("is_head", F.col("place") == 1)


def candidate_rules(spark: SparkSession) -> DataFrame:
    """Two quaternion orders x three axes x two signs, numbered in a fixed order."""
    rules = [(i, *r) for i, r in enumerate((m, a, s) for m in ("wxyz", "xyzw") for a in range(3) for s in (1, -1))]
    return spark.createDataFrame(rules, "rule_id int, quat_order string, axis int, sign int")


def rule_votes(heads: DataFrame, hands: DataFrame, rules: DataFrame, session: str, order: str) -> DataFrame:
    """For each session and rule, the block to the right: the larger median projection on the head's rotated axis.

    ``heads``: session, order, pos, quat; ``hands``: session, order, block, pos - two blocks a session.
    """
    both = hands.alias("h").join(heads.select(session, order, F.col("pos").alias("_hp"), F.col("quat").alias("_hq")), [session, order])
    # lambda variables bind the unit quaternion and the relative position once for all axes, which keeps the code small
    norm = lambda q: F.sqrt(F.aggregate(q, F.lit(0.0), lambda s, x: s + x * x))
    rel = F.zip_with("pos", "_hp", lambda x, y: x - y)

    def sides(v):
        made = []
        for mode in ("wxyz", "xyzw"):
            q = quaternion(v["u"], mode)
            made += [F.struct(F.lit(mode).alias("quat_order"), F.lit(k).alias("axis"), dot(rotation_column(q, k), tuple(v["d"][i] for i in range(3))).alias("side")) for k in range(3)]
        return F.array(*made)

    bound = F.array(F.struct(F.transform("_hq", lambda x: x / norm(F.col("_hq"))).alias("u"), rel.alias("d")))
    rows = both.select(session, "block", F.explode(F.flatten(F.transform(bound, sides))).alias("p")).select(session, "block", "p.*")
    med = rows.groupBy(session, "block", "quat_order", "axis").agg(F.median("side").alias("side"))
    each = med.join(F.broadcast(rules), ["quat_order", "axis"])  # twelve rules
    return each.groupBy(session, "rule_id").agg(F.max_by("block", F.col("side") * F.col("sign")).alias("right_block"), (F.max("side") - F.min("side")).alias("separation"))


def best_rule(votes: DataFrame, truth: DataFrame, session: str) -> DataFrame:
    """Accuracy of each rule on labelled sessions and the best one, the first on a tie."""
    acc = votes.join(truth, session).groupBy("rule_id").agg(F.avg((F.col("right_block") == F.col("true_right")).cast("double")).alias("accuracy"), F.count("*").alias("n"))
    return acc.orderBy(F.desc("accuracy"), "rule_id").limit(1)


def leave_one_out(votes: DataFrame, truth: DataFrame, session: str) -> DataFrame:
    """Each session judged by the rule that is best on all others.

    The others' sum is the total less its own, so no session meets another one."""
    right = votes.join(truth, session).withColumn("_ok", (F.col("right_block") == F.col("true_right")).cast("int"))
    totals = right.groupBy("rule_id").agg(F.sum("_ok").alias("_sum"))
    others = right.join(F.broadcast(totals), "rule_id").withColumn("_rest", F.col("_sum") - F.col("_ok"))
    pick = F.min_by(F.struct("rule_id", "_ok"), F.struct(-F.col("_rest"), "rule_id"))
    return others.groupBy(session).agg(pick.alias("_p")).select(session, F.col("_p.rule_id").alias("rule_id"), (F.col("_p._ok") == 1).alias("correct"))


def consensus(tests: DataFrame, session: str, test: str = "test", vote: str = "vote", order: str = "ord") -> DataFrame:
    """Majority of the tests' votes with the confidence ladder: 1.0 for all of three or more, 0.85 three, 0.8 two of two, else 0.55."""
    from .stats import majority

    m = majority(tests, [session], vote, order).join(tests.where(F.col(vote).isNotNull()).groupBy(session).agg(F.count("*").alias("n_tests")), session)
    conf = F.when((F.col("votes") == F.col("n_tests")) & (F.col("votes") >= 3), 1.0).when(F.col("votes") >= 3, 0.85).when((F.col("votes") == 2) & (F.col("n_tests") == 2), 0.80).otherwise(0.55)
    return m.withColumn("confidence", conf)


def global_confidence(head_score: str, side_score: str):
    """0-1: two logistic confidences of the (clipped) scores of the head and side searches, weighted."""
    c = lambda x, at: logistic(F.greatest(F.lit(-50.0), F.least(F.lit(50.0), F.col(x))) - at)
    return 0.55 * c(head_score, 4.0) + 0.45 * c(side_score, 2.5)


#: Separation in deviations that makes the height test certain or likely, and the tests that must agree; fixed values.
Z_CERTAIN, Z_LIKELY, AGREE_LEAST, AGREE_ALL = 5.0, 2.0, 3, 4


def _ranked(df: DataFrame, session: str, block: str, value: str, most: bool) -> DataFrame:
    """The block with the most (least) of a value, its value and the next ones, for each session of three blocks."""
    key = F.struct((-F.col(value) if most else F.col(value)).alias("k"), F.col(block).alias("b"))
    return df.groupBy(session).agg(F.array_sort(F.collect_list(key)).alias("o"), (F.max(value) - F.min(value)).alias("range")).where(F.size("o") == 3)


def head_tests(rows: DataFrame, session: str, block: str, order: str, pos: str = "pos", up: int = 1) -> DataFrame:
    """session, test, head_vote, confidence, zscore of the height, centrality and mobility tests of three blocks a session.

    The head is highest (the z-score is of its lead over the next block), nearest to the others, and moves least."""
    p = lambda k: F.col(pos)[k]
    w = W.partitionBy(session, block).orderBy(order)
    step = F.sqrt(sum(((p(k) - F.lag(p(k)).over(w)) ** 2 for k in (1, 2)), (p(0) - F.lag(p(0)).over(w)) ** 2))
    own = rows.withColumn("_step", step).groupBy(session, block).agg(F.median(p(up)).alias("height"), F.stddev_pop(p(up)).alias("spread"), F.median("_step").alias("mobility"))
    # the blocks of a row meet in one array: three rows a key
    met = rows.groupBy(session, order).agg(F.collect_list(F.struct(F.col(block).alias("b"), F.col(pos).alias("p"))).alias("all"))
    pair = met.select(session, F.explode(F.flatten(F.transform("all", lambda x: F.transform(F.filter("all", lambda y: y["b"] != x["b"]), lambda y: F.struct(x["b"].alias("x"), y["b"].alias("y"), F.sqrt(sum(((x["p"][k] - y["p"][k]) ** 2 for k in (1, 2)), (x["p"][0] - y["p"][0]) ** 2)).alias("d")))))).alias("e")).select(session, "e.*")
    far = pair.groupBy(session, "x", "y").agg(F.median("d").alias("d")).groupBy(session, F.col("x").alias(block)).agg(F.avg("d").alias("far"))
    top = own.groupBy(session).agg(F.array_sort(F.collect_list(F.struct((-F.col("height")).alias("k"), F.col(block).alias("b"), F.col("spread").alias("s")))).alias("o")).where(F.size("o") == 3)
    z = (F.col("o")[1]["k"] - F.col("o")[0]["k"]) / F.greatest(F.col("o")[0]["s"], F.col("o")[1]["s"], F.lit(1e-6))
    clip = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    out = top.select(session, F.lit("height").alias("test"), F.col("o")[0]["b"].alias("head_vote"), clip(z / (2 * Z_CERTAIN)).alias("confidence"), z.alias("zscore"))
    for name, df, value in (("centrality", far, "far"), ("mobility", own, "mobility")):
        d = _ranked(df, session, block, value, False)
        out = out.unionByName(d.select(session, F.lit(name).alias("test"), F.col("o")[0]["b"].alias("head_vote"), clip((F.col("o")[1]["k"] - F.col("o")[0]["k"]) / (F.col("range") + 1e-9)).alias("confidence"), F.lit(None).cast("double").alias("zscore")))
    return out


def lateral_test(rows: DataFrame, heads: DataFrame, session: str, block: str, order: str, pos: str = "pos", quat: str = "quat") -> DataFrame:
    """session, right_vote, left_vote, confidence: the hands' mean positions on the head's mean first axis.

    ``heads``: session, head. Confidence is the projections' distance over the range of the hands' first coordinate."""
    h = rows.join(heads, session).where(F.col(block) == F.col("head")).select(session, order, F.col(pos).alias("_hp"), F.col(quat).alias("_hq"))
    norm = F.sqrt(F.aggregate("_hq", F.lit(0.0), lambda s, x: s + x * x))
    axis = rotation_column(quaternion(F.transform("_hq", lambda x: x / norm)), 0)
    mean = h.select(session, *[a.alias(f"_a{k}") for k, a in enumerate(axis)]).groupBy(session).agg(*[F.avg(f"_a{k}").alias(f"_a{k}") for k in range(3)])
    hands = rows.join(heads, session).where(F.col(block) != F.col("head")).join(h, [session, order])
    rel = hands.groupBy(session, block).agg(*[F.avg(F.col(pos)[k] - F.col("_hp")[k]).alias(f"_d{k}") for k in range(3)], F.min(F.col(pos)[0]).alias("_lo"), F.max(F.col(pos)[0]).alias("_hi")).join(mean, session)
    size = F.sqrt(F.col("_a0") ** 2 + F.col("_a1") ** 2 + F.col("_a2") ** 2) + 1e-12
    proj = rel.withColumn("_p", sum((F.col(f"_d{k}") * F.col(f"_a{k}") for k in (1, 2)), F.col("_d0") * F.col("_a0")) / size)
    out = proj.groupBy(session).agg(F.max_by(block, F.struct("_p", -F.col(block).cast("double"))).alias("right_vote"), F.min_by(block, F.struct("_p", -F.col(block).cast("double"))).alias("left_vote"), ((F.max("_p") - F.min("_p")) / (F.max("_hi") - F.min("_lo") + 1e-6)).alias("_c"))
    return out.select(session, "right_vote", "left_vote", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "_c")).alias("confidence"))


def role_consensus(rows: DataFrame, session: str, block: str, order: str) -> DataFrame:
    """session, head, right, left, n_agree, certain from the four tests; rows: block positions and quaternions.

    The head is the majority's (ties: the earlier test's); the sides come from the lateral test alone, which adds its vote to
    the head. Certain if the height test is, with AGREE_LEAST tests, or is likely with all."""
    tests = head_tests(rows, session, block, order)
    at = F.when(F.col("test") == "height", 0).when(F.col("test") == "centrality", 1).otherwise(2)
    votes = tests.groupBy(session, "head_vote").agg(F.count("*").alias("n"), F.min(at).alias("o"))
    head = votes.groupBy(session).agg(F.min_by(F.struct("head_vote", "n"), F.struct(-F.col("n"), "o")).alias("h")).select(session, F.col("h.head_vote").alias("head"), F.col("h.n").alias("n"))
    z = tests.where("test = 'height'").select(session, "zscore")
    side = lateral_test(rows, head.select(session, "head"), session, block, order)
    out = head.join(z, session).join(side, session)
    agree = F.col("n") + 1
    certain = ((F.col("zscore") >= Z_CERTAIN) & (agree >= AGREE_LEAST)) | ((F.col("zscore") >= Z_LIKELY) & (agree >= AGREE_ALL))
    return out.select(session, "head", F.col("right_vote").alias("right"), F.col("left_vote").alias("left"), agree.alias("n_agree"), certain.alias("certain"), "zscore", "confidence")


def infer_head(rows: DataFrame, session: str, block: str, order: str, pos: str = "pos") -> DataFrame:
    """session, head, axis, sign, score, win_rate: the block that is most clearly on top, over three axes and two signs.

    For each candidate direction: how often a block is the topmost, how often above the others' mean, and its median lead in
    deviations; ties go to the first axis, then the negative sign."""
    met = rows.groupBy(session, order).agg(F.array_sort(F.collect_list(F.struct(F.col(block).alias("b"), F.col(pos).alias("p")))).alias("all"))
    n = F.size("all")

    def candidates(axis: int, sign: int):
        v = lambda x: sign * x["p"][axis]
        values = F.transform("all", v)
        total, first = F.aggregate(values, F.lit(0.0), lambda s, x: s + x), F.array_position(values, F.array_max(values))
        return F.transform("all", lambda x, i: F.struct(x["b"].alias("b"), F.lit(axis).alias("axis"), F.lit(sign).alias("sign"), (first == i + 1).alias("won"), (v(x) - (total - v(x)) / (n - 1)).alias("gap")))

    made = [candidates(axis, sign) for axis in range(3) for sign in (-1, 1)]
    d = met.where(n == 3).select(session, F.explode(F.concat(*made)).alias("e")).select(session, "e.*")
    by = [session, "b", "axis", "sign"]
    med = d.groupBy(*by).agg(F.median("gap").alias("_m"), F.avg(F.col("won").cast("double")).alias("win_rate"), F.avg((F.col("gap") > 0).cast("double")).alias("_above"))
    mad = d.join(med, by).groupBy(*by).agg((F.median(F.abs(F.col("gap") - F.col("_m"))) + 1e-9).alias("_mad"))
    lead = F.greatest(F.lit(-50.0), F.least(F.lit(50.0), F.col("_m") / F.col("_mad")))
    s = med.join(mad, by).withColumn("score", 2.5 * F.col("win_rate") + 2.0 * F.col("_above") + 1.5 * F.greatest(F.lit(0.0), lead))
    best = F.min_by(F.struct("b", "axis", "sign", "score", "win_rate"), F.struct(-F.col("score"), "axis", "sign", "b"))
    return s.groupBy(session).agg(best.alias("_s")).select(session, F.col("_s.b").alias("head"), "_s.axis", "_s.sign", "_s.score", "_s.win_rate")


def infer_left_right(rows: DataFrame, heads: DataFrame, session: str, block: str, order: str, pos: str = "pos", quat: str = "quat", eps: float = 1e-9) -> DataFrame:
    """session, left, right, up_local, right_local, score and its parts: sides of the two hands in the head's own frame.

    ``heads``: session, head, axis, sign, score as ``infer_head`` gives them. Hands are seen from the head and turned into its
    frame row by row. The local axis that is most parallel to the world's vertical is the head's own vertical; each of the
    other two is tried as the axis to the right: twice the hands' separation (median distance in deviations, at most 50), the
    share of rows that are clearly apart, half the vertical's alignment, less twice the axis's own alignment with the
    vertical. Ties: the first axis. Only rows with three blocks and a head quaternion count; other sessions give no row.
    """
    met = rows.groupBy(session, order).agg(F.array_sort(F.collect_list(F.struct(F.col(block).alias("b"), F.col(pos).alias("p"), F.col(quat).alias("q")))).alias("all")).where(F.size("all") == 3)
    met = met.join(heads.select(session, "head", F.col("axis").alias("_up")), session)
    # lambda variables bind the head, its unit quaternion and the hands once for all axes, which keeps the code small
    size = lambda v: F.greatest(F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)), F.lit(eps))
    seen = lambda x, h: F.zip_with(x["p"], h["p"], lambda y, z: y - z)
    split = F.array(F.struct(F.filter("all", lambda x: x["b"] == F.col("head"))[0].alias("h"), F.filter("all", lambda x: x["b"] != F.col("head")).alias("o")))
    placed = F.transform(split, lambda v: F.struct(F.transform(v["h"]["q"], lambda x: x / size(v["h"]["q"])).alias("u"), v["o"][0]["b"].alias("a"), v["o"][1]["b"].alias("b"), F.zip_with(seen(v["o"][0], v["h"]), seen(v["o"][1], v["h"]), lambda y, z: y - z).alias("d")))

    def axes(v):
        made = []
        for j in range(3):
            w = rotation_column(quaternion(v["u"]), j)
            made.append(F.struct(v["a"].alias("a"), v["b"].alias("b"), F.lit(j).alias("j"), F.array(*w).alias("w"), dot(w, tuple(v["d"][k] for k in range(3))).alias("d")))
        return F.array(*made)

    each = met.select(session, "head", "_up", F.explode(F.flatten(F.transform(placed, axes))).alias("e")).where(F.col("e.d").isNotNull())
    each = each.select(session, "head", "e.a", "e.b", "e.j", F.abs(F.element_at("e.w", F.col("_up") + 1) / size(F.col("e.w"))).alias("up"), "e.d")
    by = [session, "head", "a", "b", "j"]
    m = each.groupBy(*by).agg(F.avg("up").alias("align"), F.median("d").alias("med"), F.median(F.abs("d")).alias("far"))
    d = each.join(m.select(session, "j", "med", "far"), [session, "j"])
    s = d.groupBy(session, "j").agg((F.median(F.abs(F.col("d") - F.col("med"))) + eps).alias("mad"), F.avg((F.abs("d") > 0.25 * F.col("far") + eps).cast("double")).alias("apart"))
    s = m.join(s, [session, "j"]).withColumn("separation", F.greatest(F.lit(0.0), F.least(F.lit(50.0), F.col("far") / F.col("mad"))))
    own = W.partitionBy(session)
    s = s.withColumn("up_local", F.min_by("j", F.struct(-F.col("align"), "j")).over(own)).withColumn("up_score", F.max("align").over(own)).where(F.col("j") != F.col("up_local"))
    s = s.withColumn("score", 2 * F.col("separation") + F.col("apart") + 0.5 * F.col("up_score") - 2 * F.col("align"))
    best = s.groupBy(session).agg(F.min_by(F.struct("a", "b", "j", "med", "score", "separation", "apart", "align", "up_local", "up_score"), F.struct(-F.col("score"), "j")).alias("_s"))
    right = lambda yes, no: F.when(F.col("_s.med") >= 0, F.col(f"_s.{yes}")).otherwise(F.col(f"_s.{no}"))
    return best.select(session, right("b", "a").alias("left"), right("a", "b").alias("right"), "_s.up_local", F.col("_s.j").alias("right_local"), "_s.score", "_s.separation", F.col("_s.apart").alias("consistency"), F.col("_s.align").alias("vertical_penalty"))


def infer_roles(rows: DataFrame, session: str, block: str, order: str, hints: DataFrame | None = None, least: int = 10) -> DataFrame:
    """session, head, left, right, confidence, axis, sign, n_rows, swapped, swaps, error for every session of ``rows``.

    ``hints``: session, block, role as the file names them; ``swaps`` lists the blocks whose role is another one as
    "role>role", in block order, and ``swapped`` tells whether any is or a role is not named. A session without ``least`` rows
    of three blocks has roles null, confidence 0 and the error "too few rows".
    """
    whole = rows.groupBy(session, order).agg(F.count_distinct(block).alias("n")).groupBy(session).agg(F.count_if(F.col("n") == 3).alias("n_rows"))
    enough = rows.join(whole.where(F.col("n_rows") >= least).select(session), session, "left_semi")
    heads = infer_head(enough, session, block, order)
    sides = infer_left_right(enough, heads, session, block, order).select(session, "left", "right", F.col("score").alias("_side"))
    got = heads.select(session, "head", "axis", "sign", F.col("score").alias("_head")).join(sides, session)
    out = whole.join(got, session, "left").withColumn("confidence", F.when(F.col("head").isNull(), 0.0).otherwise(clamp(global_confidence("_head", "_side"))))
    if hints is None:
        out = out.withColumns({"swapped": F.col("head").isNotNull(), "swaps": F.array().cast("array<string>")})
    else:
        role = F.when(F.col(block) == F.col("head"), "head").when(F.col(block) == F.col("left"), "left").when(F.col(block) == F.col("right"), "right")
        h = hints.join(out.select(session, "head", "left", "right").where("head is not null"), session).withColumn("_r", role).where("_r is not null")
        h = h.groupBy(session).agg(F.count_if(F.col("role") == F.col("_r")).alias("_same"), F.transform(F.array_sort(F.collect_list(F.when(F.col("role") != F.col("_r"), F.struct(F.col(block).alias("b"), F.concat("role", F.lit(">"), "_r").alias("t"))))), lambda x: x["t"]).alias("swaps"))
        out = out.join(h, session, "left").withColumn("swapped", F.col("head").isNotNull() & (F.coalesce("_same", F.lit(0)) < 3)).withColumn("swaps", F.coalesce("swaps", F.array().cast("array<string>")))
    return out.select(session, "head", "left", "right", "confidence", "axis", "sign", "n_rows", "swapped", "swaps", F.when(F.col("head").isNull(), "too few rows").alias("error"))


PERMUTATIONS = [(0, 1, 2), (0, 2, 1), (1, 0, 2), (1, 2, 0), (2, 0, 1), (2, 1, 0)]


def best_permutation(corr: DataFrame, session: str, names: Sequence[str], a: str = "camera", b: str = "sensor", r: str = "r") -> DataFrame:
    """The assignment of three cameras to three names with the largest sum of absolute correlations, and its margin."""
    spark = corr.sparkSession
    table = spark.createDataFrame([(i, names[c], names[p[c]]) for i, p in enumerate(PERMUTATIONS) for c in range(3)], f"perm int, {a} string, {b} string")
    s = corr.join(F.broadcast(table), [a, b]).groupBy(session, "perm").agg(F.sum(F.abs(F.col(r))).alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(a, b)))).alias("assignment"))
    top = s.withColumn("_r", F.row_number().over(W.partitionBy(session).orderBy(F.desc("total"), "perm")))
    out = top.groupBy(session).agg(F.max(F.when(F.col("_r") == 1, F.col("total"))).alias("total"), F.first(F.when(F.col("_r") == 1, F.col("assignment")), ignorenulls=True).alias("assignment"), F.max(F.when(F.col("_r") == 2, F.col("total"))).alias("second"))
    margin = F.col("total") - F.col("second")
    return out.withColumn("margin", margin).withColumn("confidence", F.when(margin >= 0.3, "high").when(margin >= 0.1, "medium").otherwise("low"))
