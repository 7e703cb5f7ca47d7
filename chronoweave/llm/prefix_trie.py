"""Conversation prefix trie: one node for each distinct sequence of first turns.

Every partition folds its conversations into a trie of its own (nodes keyed by a 128-bit chain hash) and emits it as a node
table; tables are merged by node hash in rounds of ``FAN_IN`` partitions, adding members and joining end lists. End lists
travel in pieces of ``PIECE`` consecutive ids, so none grows beyond that. The rollup goes bottom-up: the nodes with the same
smallest member are one chain, chains hang below chains, and subtree sums climb in doubling jumps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .scratch import Scratch

#: Partial node tables that one merge takes together.
FAN_IN = 64
#: Conversation ids that one piece of an end list can hold: ids with the same value of ``id >> PIECE_BITS``.
PIECE_BITS = 14
#: Nodes and ends that a partition's trie holds before it is emitted; a partition may emit several.
LOCAL = 200_000
ROOT = bytes(16)

PARTIAL = "node binary, slot int, piece long, depth int, parent binary, bytes long, n long, low long, ids array<long>"


class LocalTrie:
    """A partition's trie: counters for each node and ids that end at it."""

    def __init__(self, slot: int) -> None:
        self.slot, self.nodes, self.ends, self.held = slot, {}, {}, 0

    def visit(self, conv: int, node: bytes, depth: int, parent: bytes | None, size: int) -> None:
        """Conversation ``conv`` passes the node; ``size``: bytes of its last text."""
        if (own := self.nodes.get(node)) is None:
            self.nodes[node] = [depth, parent, size, 1, conv]
            self.held += 1
        else:
            own[3] += 1
            own[4] = min(own[4], conv)

    def end(self, conv: int, node: bytes) -> None:
        self.ends.setdefault((node, conv >> PIECE_BITS), []).append(conv)
        self.held += 1

    def emit(self) -> Iterator[pa.RecordBatch]:
        rows = [(k, self.slot, None, *v, None) for k, v in self.nodes.items()]
        rows += [(k, self.slot, piece, None, None, None, None, None, ids) for (k, piece), ids in self.ends.items()]
        self.nodes, self.ends, self.held = {}, {}, 0
        kinds = [pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        names = [x.split()[0] for x in PARTIAL.split(", ")]
        for at in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at : at + 10_000], strict=True), kinds, strict=True)], names)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by family, its first conversation ahead, then by conversation and turn: rebuilds and folds them.

    Only the family's first eight turns are held, whatever the length of a conversation.
    """
    from pyspark import TaskContext

    trie = LocalTrie(TaskContext.get().partitionId())
    family, head, conv, node, depth, at = None, [], None, ROOT, 0, 0

    def step(digest: bytes, size: int) -> tuple[bytes, int]:
        below = hashlib.blake2b(node + digest, digest_size=16).digest()
        trie.visit(conv, below, depth + 1, node, size)
        return below, depth + 1

    for b in batches:
        for fam, c, keep, digest, size in zip(*(b[x].to_pylist() for x in ("family", "conv", "keep", "digest", "bytes")), strict=True):
            if c != conv:
                if conv is not None:
                    trie.end(conv, node)
                if fam != family:
                    family, head = fam, []
                conv, node, depth, at = c, ROOT, 0, 0
                trie.visit(conv, ROOT, 0, None, 0)
                for turn in head[:keep]:
                    node, depth = step(*turn)
            if c == fam and at < 8:
                head.append((digest, size))
            if c == fam or at >= keep:
                node, depth = step(digest, size)
            at += 1
            if trie.held >= LOCAL:
                yield from trie.emit()
    if conv is not None:
        trie.end(conv, node)
    yield from trie.emit()


def partial_tries(conversations: DataFrame) -> DataFrame:
    """Node tables of the partitions' tries (``PARTIAL``): counters where ``piece`` is null, else ends of one piece.

    Texts leave the scan as 128-bit digests. A family (ids with the same ``c - c % 5``) shares a partition, so the rebuilt
    conversations need no join.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    conv = F.col("conv_id").cast("long")
    rows = conversations.where("conv_id is not null").select(
        (conv - conv % 5).alias("family"),
        conv.alias("conv"),
        (F.expr("crc32(encode(cast(cast(conv_id as long) as string), 'UTF-8'))") % 9).cast("int").alias("keep"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit("\n"), role, text))).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    first = F.when(F.col("conv") == F.col("family"), 0).otherwise(1)
    rows = rows.repartition("family").sortWithinPartitions("family", first, "conv", F.col("turn").asc_nulls_first(), "role", "digest")
    return rows.select("family", "conv", "keep", "digest", "bytes").mapInArrow(_fold, PARTIAL)


def merge_tries(partials: DataFrame, scratch: Scratch, fan_in: int = FAN_IN) -> tuple[DataFrame, DataFrame]:
    """Merges saved partial tries by node hash: (nodes: node, depth, parent, bytes, n, low), (ends: node, piece, ids).

    One round joins the tables of ``fan_in`` slots at most; rounds go on until one table is left. Every list stays within
    its piece of 2**PIECE_BITS ids.
    """
    slots = (partials.agg(F.max("slot")).first()[0] or 0) + 1
    while True:
        slots = -(-slots // fan_in)
        keys = ["node", *([(F.col("slot") / fan_in).cast("int").alias("slot")] if slots > 1 else [])]
        counts = partials.where("piece is null").groupBy(*keys).agg(F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("bytes").alias("bytes"), F.sum("n").alias("n"), F.min("low").alias("low"))
        ends = partials.where("piece is not null").groupBy(*keys, "piece").agg(F.array_sort(F.flatten(F.collect_list("ids"))).alias("ids"))
        if slots == 1:
            return scratch.save(counts), scratch.save(ends)
        merged = scratch.save(counts.withColumns({"piece": F.lit(None).cast("long"), "ids": F.lit(None).cast("array<long>")}).unionByName(ends, allowMissingColumns=True))
        scratch.drop(partials)
        partials = merged


def _digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each node's pieces, which come in order."""
    node, sha = None, None
    for b in batches:
        done = []
        for key, ids in zip(b["node"].to_pylist(), b["ids"].to_pylist(), strict=True):
            text = ",".join(map(str, ids)).encode()
            if key == node:
                sha.update(b"," + text)
            else:
                if node is not None:
                    done.append((node, sha.hexdigest()))
                node, sha = key, hashlib.sha256(text)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.binary()), pa.array([x for _, x in done], pa.string())], ["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()], pa.string())], ["node", "ends_sha256"])


def climb(chains: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """Subtree sums of a forest: ``chains`` (conv, anc: parent or null, saved, leaves) gets total_saved, total_leaves.

    After round k a chain holds the sums of everything less than 2**k below it and its 2**k-th ancestor.
    """
    state = scratch.save(chains.select("conv", "anc", F.col("anc").alias("up"), F.col("at"), "saved", "leaves"))
    for _ in range(max_rounds):
        if not state.where("up is not null").limit(1).count():
            return state
        adds = state.where("up is not null").groupBy(F.col("up").alias("conv")).agg(F.sum("saved").alias("more"), F.sum("leaves").alias("more_leaves"))
        # few chains have others below them: the ancestors' ancestors are looked up among those alone
        jumps = state.where("up is not null").select(F.col("conv").alias("up"), F.col("up").alias("next"))
        new = state.join(adds, "conv", "left").join(jumps.join(adds.select(F.col("conv").alias("up")), "up", "left_semi"), "up", "left")
        total = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
        new = scratch.save(new.select("conv", "anc", F.col("next").alias("up"), "at", total("saved", "more"), total("leaves", "more_leaves")))
        scratch.drop(state)
        state = new
    raise RuntimeError("the chains hold a cycle")


def conversation_trie(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """One row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Conversation c counts as the first h turns of conversation c - c % 5 and its own turns after its first h, h being
    crc32(c as text) % 9. Turns go by number, null first; equal numbers by role, then by a hash of the text; repeated rows
    are turns of their own. Null roles and texts are empty. Rows without conv_id belong to no conversation; no
    conversations give no rows, not even a root. Other columns are ignored, whatever their names. A conversation's turns
    (digests of 16 bytes) are held by one task; texts of any length leave the scan as digests.
    """
    partials = scratch.save(partial_tries(conversations))
    counts, ends = merge_tries(partials, scratch)
    ordered = ends.select("node", "piece", "ids").repartition("node").sortWithinPartitions("node", "piece")
    digests = ordered.select("node", "ids").mapInArrow(_digest_ends, "node binary, ends_sha256 string")
    parents = counts.select(F.col("node").alias("parent"), F.col("low").alias("parent_conv"))
    none = hashlib.sha256(b"").hexdigest()
    nodes = counts.join(digests, "node", "left").join(parents, "parent", "left")
    nodes = scratch.save(nodes.select(F.col("low").alias("conv"), "depth", "parent_conv", F.col("n").alias("n_convs"), ((F.col("n") - 1) * F.col("bytes")).alias("own"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"), F.expr("parent_conv is null or parent_conv <> low").alias("top")))
    scratch.drop(counts, ends)

    below = F.col("depth").desc()
    lowest = F.lead("depth").over(W.partitionBy("conv").orderBy("depth")).isNull()
    kids = nodes.where("top and parent_conv is not null").groupBy(F.col("parent_conv").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("kids"))
    shaped = scratch.save(nodes.join(kids, ["conv", "depth"], "left").withColumn("lowest", lowest))
    leaf = F.expr("if(lowest and kids is null, 1L, 0L)")
    chains = shaped.groupBy("conv").agg(F.max(F.expr("if(top, parent_conv, null)")).alias("anc"), F.max(F.expr("if(top, depth - 1, null)")).alias("at"), F.sum("own").alias("saved"), F.sum(leaf).alias("leaves"))
    totals = climb(chains, scratch)
    hung = totals.where("anc is not null").groupBy(F.col("anc").alias("conv"), F.col("at").alias("depth")).agg(F.sum("saved").alias("hung_saved"), F.sum("leaves").alias("hung_leaves"))
    rows = shaped.join(hung, ["conv", "depth"], "left")
    down = W.partitionBy("conv").orderBy(below)
    plus = lambda a, b: F.sum(a + F.coalesce(F.col(b), F.lit(0))).over(down)
    return rows.select(
        F.col("conv").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        (F.coalesce("kids", F.lit(0)) + F.expr("if(lowest, 0, 1)")).cast("long").alias("n_children"),
        plus(leaf, "hung_leaves").alias("n_leaves"),
        plus(F.col("own"), "hung_saved").alias("saved_tokens"),
        "ends_sha256",
    )


#: CRC-32 bit by bit, the reflected polynomial 0xEDB88320.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(8 * strlen({0})), lambda k: ((ord({0}[(k // 8 + 1)::INT]) >> (k % 8)::INT) & 1)::BIGINT)),
  lambda a, x: xor(a >> 1, 3988292384::BIGINT * (xor(a, x) & 1))), 4294967295::BIGINT)"""
ORACLE = f"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, r, x, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, r, md5(strlen(r)::VARCHAR || chr(10) || r || x)) AS i FROM t),
ids AS (SELECT c, c::VARCHAR AS s FROM (SELECT DISTINCT c FROM t)),
h AS (SELECT c, {CRC32.format("s")} % 9 AS h FROM ids),
b AS (SELECT h.c, o.i, o.r, o.x FROM h JOIN o ON o.c = h.c - h.c % 5 AND o.i <= h.h UNION ALL SELECT h.c, o.i, o.r, o.x FROM h JOIN o ON o.c = h.c AND o.i > h.h),
q AS (SELECT c, strlen(x) AS size, row_number() OVER (PARTITION BY c ORDER BY i) AS d, md5(strlen(r)::VARCHAR || chr(10) || r || x) AS m FROM b),
p AS (SELECT c, d, size, string_agg(m, '') OVER (PARTITION BY c ORDER BY d) AS k FROM q UNION ALL SELECT c, 0, 0, '' FROM ids),
e AS (SELECT c, max(d) AS last FROM p GROUP BY c),
n AS (SELECT k, d, min(p.c) AS conv_id, count(*) AS n, max(size) AS size, sha256(coalesce(string_agg(p.c::VARCHAR, ',' ORDER BY p.c) FILTER (last = d), '')) AS ends FROM p JOIN e USING (c) GROUP BY k, d),
f AS (SELECT n.*, (SELECT count(*) FROM n m WHERE m.d = n.d + 1 AND starts_with(m.k, n.k)) AS kids FROM n),
a AS (SELECT n.k, sum(CASE WHEN f.kids = 0 THEN 1 ELSE 0 END) AS leaves, sum((f.n - 1) * f.size) AS saved FROM n JOIN f ON f.d >= n.d AND starts_with(f.k, n.k) GROUP BY n.k)
SELECT f.conv_id, f.d::BIGINT AS depth, u.conv_id AS parent_conv_id, f.n::BIGINT AS n_convs, f.kids::BIGINT AS n_children, a.leaves::BIGINT AS n_leaves, a.saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
FROM f JOIN a USING (k) LEFT JOIN n u ON u.d = f.d - 1 AND u.k = left(f.k, (32 * (f.d - 1))::BIGINT) AND f.d > 0
"""


def op13(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return conversation_trie(rows, Scratch(spark))
