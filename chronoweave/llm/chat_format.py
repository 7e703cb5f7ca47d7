"""Chat formatting: reply trees to one training conversation for each chosen root-to-leaf path.

Pointer doubling (iterative self-joins of node ids) gives every node's ancestors 1, 2, 4, ... turns up; leaves are ranked
by the mean score of their path, and the chosen leaves' paths are enumerated by joining those tables from the longest
jump down. Texts join only once, for the chosen paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .scratch import Scratch

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that chat templates use as control marks; after the first character, one more backslash for each escape.
CONTROL = r"(\|[A-Za-z0-9_]+\|>|/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, "$1$2$3")


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    marked = F.replace(role, F.lit("\\\\"), F.lit("\0"))
    return unescape(F.replace(F.replace(marked, F.lit("\\n"), F.lit("\n")), F.lit("\0"), F.lit("\\")))


def reply_paths(nodes: DataFrame, scratch: Scratch, paths_per_tree: int | None = None, max_doublings: int = 40) -> DataFrame:
    """(tree, leaf, node, up) for the chosen paths; ``up`` is the distance from the leaf.

    ``nodes``: tree, node (unique), parent (null for a root), score. Leaves of a tree are ranked by the mean score along
    their path, ties by node; ``paths_per_tree`` None keeps all. A parent that is no node makes its child a root. Depth is
    bounded only by 2**max_doublings; a cycle raises.
    """
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("_known"))
    base = nodes.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")).join(known, "parent", "left")
    step = scratch.save(base.select("tree", "node", F.expr("if(_known, parent, null)").alias("anc"), F.col("score").alias("sum"), F.lit(1).cast("long").alias("n")))
    parents = step.where("anc is not null").select(F.col("anc").alias("node")).distinct()
    leaves = scratch.save(step.join(parents, "node", "left_anti").select("tree", "node"))
    jumps = []
    while step.where("anc is not null").limit(1).count():
        if len(jumps) == max_doublings:
            raise ValueError("the reply links hold a cycle")
        jumps.append(step.where("anc is not null").select("node", "anc"))
        up = step.select(F.col("node").alias("anc"), F.col("anc").alias("anc2"), F.col("sum").alias("sum2"), F.col("n").alias("n2"))
        live = step.where("anc is not null").join(up, "anc").select("tree", "node", F.col("anc2").alias("anc"), (F.col("sum") + F.col("sum2")).alias("sum"), (F.col("n") + F.col("n2")).alias("n"))
        step = scratch.save(live.union(step.where("anc is null")))
    if paths_per_tree is not None:
        rank = F.row_number().over(W.partitionBy("tree").orderBy(F.desc(F.col("sum") / F.col("n")), "node"))
        leaves = scratch.save(step.join(leaves.select("node"), "node", "left_semi").withColumn("_r", rank).where(F.col("_r") <= paths_per_tree).select("tree", "node"))
    path = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    for k, jump in reversed(list(enumerate(jumps))):
        # saved each time: a plan that reads itself twice would double at every jump
        path = scratch.save(path.union(path.join(jump, "node").select("tree", "leaf", F.col("anc").alias("node"), (F.col("up") + (1 << k)).alias("up"))))
    return path


def format_paths(path: DataFrame, texts: DataFrame) -> DataFrame:
    """(tree, leaf, formatted, loss_spans) for paths joined with ``texts`` (node, role, text).

    Turns run from the root to the leaf: ``<|im_start|>role``, line feed, text, ``<|im_end|>``, line feed, with control
    strings in role and text escaped. ``loss_spans`` holds 0-based (start, length) in code points of every assistant text.
    """
    turn = F.struct((-F.col("up")).alias("order"), "role", "text")
    rows = path.join(texts, "node").groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    head = lambda t: F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n"))
    parts = F.transform("turns", lambda t: F.struct(head(t).alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("loss")))
    rows = rows.select("tree", "leaf", parts.alias("parts"))
    tail = END + "\n"
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "")
    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    spans = F.aggregate(
        "parts",
        F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + len(tail)).alias("at"),
            F.when(p["loss"], F.array_append(acc["spans"], F.struct((acc["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).cast("long").alias("length")))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return rows.select("tree", "leaf", text.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    return F.transform(pieces, lambda p: F.struct(_unescape_role(F.substring(F.substring_index(p, "\n", 1), len(START) + 1, 2147483647)).alias("role"), unescape(F.substring(p, F.instr(p, "\n") + 1, F.lit(2147483647))).alias("text")))


def linear_nodes(turns: DataFrame) -> DataFrame:
    """Nodes of plain conversations: each turn replies to the turn before it (by turn, role, text; repeated rows stay)."""
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    at = turns.withColumn("_i", F.row_number().over(order))
    key = F.struct("conv_id", "_i")
    return at.select(F.col("conv_id").alias("tree"), key.alias("node"), F.when(F.col("_i") > 1, F.struct("conv_id", (F.col("_i") - 1).alias("_i"))).alias("parent"), F.length("text").cast("double").alias("score"), "role", "text")


def format_conversations(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, formatted, loss_spans), one row for each conv_id, null included.

    A null role or text is empty; a null turn comes first, equal turns go by role and text; repeated rows are turns of their
    own; other columns are ignored, whatever their names; no rows give no rows. A conversation has one path, so equal scores
    cannot meet here (``reply_paths`` takes the smaller leaf). One conversation, with texts of any length, is one row.
    """
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    nodes = scratch.save(linear_nodes(turns))
    out = format_paths(reply_paths(nodes, scratch), nodes.select("node", "role", "text"))
    return out.select(F.col("tree").alias("conv_id"), "formatted", "loss_spans")


EXTRA = "</s>[INST] ok [/INST]"
ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
t AS (SELECT *, regexp_replace(text, '([<\[])(\\*)(\|[A-Za-z0-9_]+\|>|/?s>|/?INST\])', '\1\\\2\3', 'g') AS safe FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + length(safe) + 24) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def op10(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", EXTRA), (-1, 1, "assistant", EXTRA)], "conv_id long, turn long, role string, text string")
    out = format_conversations(rows.union(extra), Scratch(spark))
    turns = read_back(F.col("formatted"))
    out = out.withColumn("turns", turns).withColumn("loss", F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int")))), ""))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
