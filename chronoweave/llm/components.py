"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 50) -> DataFrame:
    """(node, component) for each node of ``edges`` (src, dst bigint); component is its smallest reachable node.

    Every round is a pre-aggregated minimum for each node and a join back to its edges, so a hub's edges stay spread;
    rounds end when the star forest no longer changes, after about log2 of the longest path. Self-links and nulls count
    for nothing; no edges give no rows.
    """
    e = edges.select(F.col("src").cast("long").alias("u"), F.col("dst").cast("long").alias("v")).where("u <> v")
    e = scratch.save(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = state(e)
    for _ in range(max_rounds):
        if not now[0]:
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("s"))
        small = scratch.save(small.select("s.u", "s.v").where("u <> v").distinct())
        scratch.drop(e)
        e, before, now = small, now, state(small)
        if now == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
