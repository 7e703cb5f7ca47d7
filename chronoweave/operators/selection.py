"""Exact ranks, percentiles, numbering and samples of few keys with many rows: no task holds or orders a key's values."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

#: Values that one task orders at the end, and the bins of a round.
LAST, BINS = 50_000, 1024
#: Keys for which the bounds of each round travel through the driver; groups that are many are small, and have aggregates.
MOST_KEYS = 10_000


def select_ranks(df: DataFrame, by: Sequence[str], value: str, ranks: dict[tuple, list[int]], last: int = LAST, bins: int = BINS) -> DataFrame:
    """(by, rank, value): the values at 0-based ``ranks`` of each key's ascending values.

    A round counts the values in bins between the bounds of each rank and goes on inside the bin that holds it, until the bin
    holds ``last`` values or a single one; only then are its values ordered. Counts are partial aggregates; ``ranks`` and
    bounds are small rows on the driver. ``df`` is read once a round: cut its lineage if it is dear."""
    spark, by = df.sparkSession, list(by)
    x = df.where(F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(F.col(value)) != float("inf"))).select(*[F.col(c) for c in by], F.col(value).cast("double").alias("_v"))
    kinds = ", ".join([*[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by], "lo double", "hi double"])
    ends = x.groupBy(*by).agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count("*").alias("n")).collect()
    # (key, rank) -> bounds, values below them, values within
    open_ = {(k, r): (e["lo"], e["hi"], 0, e["n"]) for e in ends for k in [tuple(e[c] for c in by)] for r in ranks.get(k, []) if r < e["n"]}
    found: dict[tuple, float] = {}

    def settle() -> None:
        for at, (lo, hi, _, _) in list(open_.items()):
            if lo == hi:
                found[at] = lo
                del open_[at]

    def within(cells: list[tuple]) -> DataFrame:
        bounds = spark.createDataFrame(cells, kinds)
        return x.join(F.broadcast(bounds), by) .where("_v >= lo and _v <= hi") if by else x.join(F.broadcast(bounds), F.expr("_v >= lo and _v <= hi"))

    settle()
    while big := sorted({(*k, lo, hi) for (k, _), (lo, hi, _, n) in open_.items() if n > last}, key=str):
        cell = F.least(F.floor((F.col("_v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
        got = within(big).groupBy(*by, "lo", "hi", cell.alias("bin")).agg(F.count("*").alias("n"), F.min("_v").alias("a"), F.max("_v").alias("z")).collect()
        hist: dict[tuple, list] = {}
        for g in sorted(got, key=lambda g: g["bin"]):
            hist.setdefault((tuple(g[c] for c in by), g["lo"], g["hi"]), []).append(g)
        for (k, r), (lo, hi, below, n) in list(open_.items()):
            if n > last:
                for g in hist[k, lo, hi]:
                    if r < below + g["n"]:
                        open_[k, r] = (g["a"], g["z"], below, g["n"])
                        break
                    below += g["n"]
        settle()
    rows = spark.createDataFrame([(*k, r, v) for (k, r), v in found.items()], ", ".join([*kinds.split(", ")[: len(by)], "rank long", "value double"]))
    if open_:
        cells = sorted({(*k, lo, hi) for (k, _), (lo, hi, _, _) in open_.items()}, key=str)
        w = W.partitionBy(*by, "lo", "hi").orderBy("_v")
        placed = within(cells).withColumn("_r", F.row_number().over(w) - 1)
        want = spark.createDataFrame([(*k, lo, hi, r, r - below) for (k, r), (lo, hi, below, _) in open_.items()], kinds + ", rank long, _r int")
        rows = rows.unionByName(placed.join(F.broadcast(want), [*by, "lo", "hi", "_r"]).select(*by, "rank", F.col("_v").alias("value")))
    return rows


def exact_percentiles(df: DataFrame, by: Sequence[str], value: str, shares: Sequence[float], last: int = LAST, bins: int = BINS) -> DataFrame:
    """(by, n, p0, p1, ...): interpolated percentiles (as ``percentile``) of at most MOST_KEYS keys, by selection.

    Nulls, NaN and infinite values do not count; a key without values gives no row. More keys raise."""
    by, names = list(by), [f"p{i}" for i in range(len(shares))]
    ok = F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(F.col(value)) != float("inf"))
    counts = df.where(ok).groupBy(*by).agg(F.count("*").alias("n")).limit(MOST_KEYS + 1).collect()
    counts = [c for c in counts if c["n"]]
    if len(counts) > MOST_KEYS:
        raise ValueError(f"more than {MOST_KEYS} keys: use percentile aggregates")
    at = {tuple(c[b] for b in by): [s * (c["n"] - 1) for s in shares] for c in counts}
    ranks = {k: sorted({r for p in ps for r in (math.floor(p), math.ceil(p))}) for k, ps in at.items()}
    kinds = ", ".join([*[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by], "n long", *[f"{x} double" for p in names for x in (f"_{p}",)]])
    places = df.sparkSession.createDataFrame([(*k, next(c["n"] for c in counts if tuple(c[b] for b in by) == k), *ps) for k, ps in at.items()], kinds)
    values = select_ranks(df, by, value, ranks, last, bins)
    got = values.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_m"))  # two ranks a share
    both = F.broadcast(places).join(got, by) if by else places.join(F.broadcast(got))  # one row each without keys
    low = lambda p: F.element_at("_m", F.floor(f"_{p}"))
    high = lambda p: F.element_at("_m", F.ceil(f"_{p}"))
    return both.select(*by, "n", *[(low(p) + (high(p) - low(p)) * (F.col(f"_{p}") - F.floor(f"_{p}"))).alias(p) for p in names])


def exact_median_mad(df: DataFrame, by: Sequence[str], value: str, floor: float = 0.0, last: int = LAST, bins: int = BINS) -> DataFrame:
    """(by, median, mad, n) of few keys by selection: the same rows as ``stats.median_mad``."""
    by = list(by)
    med = exact_percentiles(df, by, value, [0.5], last, bins).select(*by, "n", F.col("p0").alias("median"))
    med = df.sparkSession.createDataFrame(med.collect(), med.schema)  # at most MOST_KEYS rows, read twice
    far = (df.join(F.broadcast(med), by) if by else df.join(F.broadcast(med))).select(*by, F.abs(F.col(value) - F.col("median")).alias("_d"))
    mad = exact_percentiles(far, by, "_d", [0.5], last, bins).select(*by, F.greatest(F.col("p0"), F.lit(floor)).alias("mad"))
    return F.broadcast(med).join(mad, by).select(*by, "median", "mad", "n") if by else med.join(F.broadcast(mad)).select("median", "mad", "n")


def number_rows(df: DataFrame, order: str, out: str = "number", parts: int | None = None) -> DataFrame:
    """0-based numbers in the order of ``order`` (distinct values): ranges of a sorted exchange, each numbered on its own, and
    offsets from the ranges' counts - one row a range on the driver, not one task for all rows. Rows of a null order go."""
    ranged = (df.repartitionByRange(parts, order) if parts else df.repartitionByRange(order)).sortWithinPartitions(order)
    # the range of a row is told by its value, so a retry that cuts elsewhere cannot mix numbers
    bounds = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min(order).alias("lo"), F.max(order).alias("hi"), F.count(order).alias("n")).where("n > 0").orderBy("lo").collect()
    kind = df.schema[order].dataType.simpleString()
    edges = df.sparkSession.createDataFrame([(i, b["lo"], b["hi"]) for i, b in enumerate(bounds)], f"_p int, _lo {kind}, _hi {kind}")
    placed = df.join(F.broadcast(edges), (F.col(order) >= F.col("_lo")) & (F.col(order) <= F.col("_hi")))
    offsets, total = [], 0
    for i, b in enumerate(bounds):
        offsets.append((i, total))
        total += b["n"]
    start = df.sparkSession.createDataFrame(offsets, "_p int, _start long")
    rows = placed.join(F.broadcast(start), "_p")
    return rows.withColumn(out, F.col("_start") + F.row_number().over(W.partitionBy("_p").orderBy(order)) - 1).drop("_p", "_lo", "_hi", "_start")


def running_sums(df: DataFrame, number: str, value: str, out: str, block: int = 100_000) -> DataFrame:
    """(number, out): the sum of ``value`` over all smaller numbers (0-based, as of ``number_rows``): blocks of numbers are
    summed on their own and start from the sum of the blocks before, of which the driver sees one row each."""
    d = df.select(number, F.col(value).alias("_v"), (F.col(number) / block).cast("long").alias("_b"))
    sums, start, total = sorted((r["_b"], r["s"]) for r in d.groupBy("_b").agg(F.sum("_v").alias("s")).collect()), [], 0
    for b, s in sums:
        start.append((b, total))
        total += s
    d = d.join(F.broadcast(df.sparkSession.createDataFrame(start, "_b long, _s long")), "_b")
    w = W.partitionBy("_b").orderBy(number).rowsBetween(W.unboundedPreceding, W.currentRow)
    return d.select(number, (F.col("_s") + F.sum("_v").over(w) - F.col("_v")).alias(out))


def keyed_sample(df: DataFrame, keys: Sequence[str], k: int, hash_of: Sequence[str], seed: int = 42, salts: int = 16) -> DataFrame:
    """At most ``k`` rows of each key: those of least hash of ``hash_of`` and the seed, whatever the partitioning.

    The least k of parts of a key are taken first, then the least k of those, so no task sees more than salts x k rows of a
    key; rows of equal hash go by the columns themselves. The cap is what the operator is for."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in hash_of], F.lit(str(seed)))
    d = df.withColumn("_h", F.md5(text)).withColumn("_s", F.pmod(F.xxhash64(*hash_of), F.lit(salts)))
    order = ["_h", *[F.col(c) for c in hash_of]]
    d = d.withColumn("_r", F.row_number().over(W.partitionBy(*keys, "_s").orderBy(*order))).where(F.col("_r") <= k)
    d = d.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= k)
    return d.drop("_h", "_s", "_r")


def least_hashes(df: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """At most ``k`` rows, those of least hash of all their columns: the threshold is selected by counts, nothing is ordered
    as a whole. Rows of one hash stay or go together, so repeated rows may leave fewer than ``k``."""
    bits = 53  # whole numbers that a double holds
    d = df.withColumn("_k", F.shiftrightunsigned(F.xxhash64(*[F.col(c).cast("string") for c in df.columns], F.lit(seed)), 64 - bits).cast("double"))
    if d.count() <= k:
        return df
    if k <= 0:
        return df.limit(0)
    above = select_ranks(d, [], "_k", {(): [k]}).first()["value"]  # the first hash that is too many
    return d.where(F.col("_k") < above).drop("_k")
