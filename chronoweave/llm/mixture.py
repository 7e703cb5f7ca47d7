"""Mixing sources to target weights.

A source's documents fall into segments by hash, in id order within each; a segment's words are packed into fixed-length
blocks, and a source's blocks are numbered through its segments. Each output shard draws multinomial source counts for its
slots from what the sources still owe. A source's slots run through a pseudorandom permutation of its block numbers, again
and again with another key; the permutation is inverted, so that a block finds its slots, and by them its shards, by index.
So the text moves once, from the documents to the shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .scratch import Scratch, sendable
from .words import _SPACE, mix

#: Words in a block and the most often a word can be taken.
BLOCK, MOST = 256, 3
#: Words of a segment, about: the part of a source that one task lays out. Words of an output shard, and the least shards.
SEGMENT, SHARD_WORDS, SHARDS = 1 << 22, 1 << 26, 64
#: Rows of document places that are sent to every task at most.
SEND_PLACES = 500_000


def default_weights(n: int) -> list[float]:
    """1, 2, 3, repeating, for sources by code point, null last."""
    return [float(i % 3 + 1) for i in range(n)]


def targets(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """Shares of all words by weight, none above ``most`` times its source; the excess is shared again by weight."""
    out, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / total > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(most * sizes[i])
        free -= set(over)
        left -= sum(out[i] for i in over)
    return out


def draw_shards(owed: list[int], shards: int = SHARDS, seed: int = 3) -> list[list[int]]:
    """Slots of each source in each shard: multinomial by what is owed, never more than that; all is paid in the end."""
    left, rng, out = np.array(owed, np.int64), np.random.RandomState(seed), []
    for s in range(shards):
        slots, counts = int(left.sum()) // (shards - s), np.zeros(len(left), np.int64)
        while slots and (rest := left - counts).sum():
            got = np.minimum(rng.multinomial(slots, rest / rest.sum()), rest)
            counts += got
            slots -= int(got.sum())
        left -= counts
        out.append(counts.tolist())
    return out


def permute(i: np.ndarray, n: int, key: int, inverse: bool = False, rounds: int = 12) -> np.ndarray:
    """Pseudorandom permutation of 0..n-1 by swap-or-not rounds: i meets its partner (k - i) mod n, and both move or stay by
    one keyed bit of the larger. A round is its own inverse, so the rounds backwards invert the whole."""
    x = np.array(i, np.uint64)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) + mix(np.array([key], np.uint64)))
    for k in keys[::-1] if inverse else keys:
        partner = (k % np.uint64(n) + np.uint64(n) - x) % np.uint64(n)
        move = mix(np.maximum(x, partner) ^ k) & np.uint64(1) == 0
        x = np.where(move, partner, x)
    return x.astype(np.int64)


def _turn_key(source: int, turn: int, seed: int) -> int:
    return (source * 4 + turn) * 1_000_003 + seed


class Layout:
    """Blocks, slots and shards of every source, from the sources' targets and the segments' words.

    ``segments``: (source, segment, words) in order. A segment's blocks hold ``block`` words but for its last one."""

    def __init__(self, sizes: list[int], goals: list[float], segments: list[tuple[int, int, int]], block: int, shards: int, seed: int) -> None:
        self.block, self.seed, self.sizes = block, seed, sizes
        self.base: dict[tuple[int, int], tuple[int, int]] = {}
        self.blocks = [0] * len(sizes)
        short: list[list[tuple[int, int]]] = [[] for _ in sizes]
        for i, g, n in segments:
            self.base[i, g] = (self.blocks[i], n)
            self.blocks[i] += -(-n // block)
            if n % block:
                short[i].append((self.blocks[i] - 1, block - n % block))
        # whole turns take every word once each; the last turn takes some slots, and one more slot its leading words
        self.turns, self.rest, self.lead = [], [], []
        for i, (n, g) in enumerate(zip(sizes, goals, strict=True)):
            want = min(round(g), MOST * n)
            turns = want // n if n else 0
            rest = want - turns * n
            slots, lead = self._last_turn(i, turns, rest, short[i])
            self.turns.append(turns)
            self.rest.append(slots)
            self.lead.append(lead)
        self.slots = [t * b + r + (w > 0) for t, b, r, w in zip(self.turns, self.blocks, self.rest, self.lead, strict=True)]
        drawn = np.array(draw_shards(self.slots, shards, seed), np.int64).reshape(shards, len(sizes))
        self.ends = np.cumsum(drawn, axis=0).T.copy()  # slots of each source up to each shard

    def _last_turn(self, i: int, turn: int, rest: int, short: list[tuple[int, int]]) -> tuple[int, int]:
        """(whole slots, leading words of the next one) that give ``rest`` words in this turn."""
        if not rest:
            return 0, 0
        at = permute(np.array([b for b, _ in short], np.int64), self.blocks[i], _turn_key(i, turn, self.seed), True)
        lack = sorted(zip(at.tolist(), (d for _, d in short), strict=True))
        slots, words, done = 0, 0, 0
        for place, missing in [*lack, (self.blocks[i], 0)]:
            upto = min(place, slots + (rest - words) // self.block)
            words += (upto - slots) * self.block
            slots = upto
            if slots < place:
                break
            if words + self.block - missing > rest:
                break
            if place < self.blocks[i]:
                words += self.block - missing
                slots += 1
            done += 1
        return slots, rest - words

    def places(self, i: int, number: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """(which of the blocks, their shards, words they give at most, turn) for the blocks ``number`` of a source."""
        out = []
        for turn in range(self.turns[i] + 1):
            if turn == self.turns[i] and not (self.rest[i] or self.lead[i]):
                continue
            slot = permute(number, self.blocks[i], _turn_key(i, turn, self.seed), True)
            if turn == self.turns[i]:
                own = np.flatnonzero(slot < self.rest[i] + (self.lead[i] > 0))
                words = np.where(slot[own] < self.rest[i], self.block, self.lead[i])
            else:
                own, words = np.arange(len(slot)), np.full(len(slot), self.block)
            shard = np.searchsorted(self.ends[i], slot[own] + turn * self.blocks[i], "right")
            out.append((own, shard, words, turn))
        return out


def row_keys() -> list:
    """Two hashes of id, source and text, by which equal rows are one."""
    part = [F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text")]
    return [F.xxhash64(F.lit(k), *part, *[p.isNull() for p in part]).alias(f"r{k}") for k in (1, 2)]


def light_rows(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, r1, r2 and m (how many rows are equal) of the documents."""
    n = F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(n, F.lit(0)).cast("long").alias("size"), *row_keys())
    return rows.groupBy("r1", "r2", "doc_id", "source", "size").agg(F.count("*").alias("m"))


def mix_sources(docs: DataFrame, scratch: Scratch, weights: list[float] | None = None, block: int = BLOCK, shards: int | None = None, seed: int = 3) -> tuple[DataFrame, DataFrame]:
    """(documents, mix) of the mix of ``docs`` (doc_id, text, source).

    documents: doc_id, source, size, source_size, target, taken for each row, counted from what was written. mix, read from
    the written files: shard, source_index, block, turn, at, words, segment, place, text - in each shard the parts of its
    blocks, in order; a part is what one document (at ``place`` words of its segment) gives to the block, its white space kept.
    A block is taken at most 3 times and so is each of its words; the last slot of a source takes only as many leading words
    as its target still needs. Null and empty texts have size 0 and are never taken; a null source is a source of its own;
    repeated rows and ids are documents of their own; very long texts spread over blocks like any other; equal input gives
    equal output at any partitioning; other columns are ignored; no rows give no rows. The numbers of sources and of segments
    (one for each SEGMENT words and source) reach the driver and every task.
    """
    spark = docs.sparkSession
    light = scratch.save(light_rows(docs))
    totals = light.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("n")).collect()
    totals = sorted(((r["source"], r["n"]) for r in totals), key=lambda x: (x[0] is None, (x[0] or "").encode()))
    sizes = [n for _, n in totals]
    goals = targets(sizes, weights or default_weights(len(sizes)))
    shards = shards or max(SHARDS, -(-sum(sizes) // SHARD_WORDS))
    table = F.broadcast(spark.createDataFrame([(i, s, n, float(g), max(1, -(-n // SEGMENT))) for i, ((s, n), g) in enumerate(zip(totals, goals, strict=True))], "source_index int, source string, source_size long, target double, _parts long"))
    rows = light.withColumnRenamed("source", "_s").join(table, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    rows = rows.withColumn("segment", F.pmod("r1", "_parts"))
    # places: the words before a document in its segment
    here = W.partitionBy("source_index", "segment").orderBy("doc_id", "r1", "r2").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.where("size > 0").withColumn("place", F.coalesce(F.sum(F.col("size") * F.col("m")).over(here), F.lit(0)))
    placed = scratch.save(placed.select("r1", "r2", "doc_id", "source_index", "size", "m", "segment", "place"))
    parts = placed.groupBy("source_index", "segment").agg(F.sum(F.col("size") * F.col("m")).alias("n")).collect()
    layout = Layout(sizes, goals, sorted((r["source_index"], r["segment"], r["n"]) for r in parts), block, shards, seed)

    find = sendable(placed.select("r1", "r2", "source_index", "segment", "place", "size", "m"), SEND_PLACES)
    texts = docs.select("text", *row_keys()).join(find, ["r1", "r2"])
    if placed.where("m > 1").limit(1).count():
        # equal rows lie one after another: one of them stands for all
        again = texts.where("m > 1").dropDuplicates(["r1", "r2"]).withColumn("place", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("m") - 1), lambda c: F.col("place") + c * F.col("size"))))
        texts = texts.where("m = 1").unionByName(again)
    made = _parts(texts.select("text", "source_index", "segment", "place"), layout)
    made = scratch.save(made.repartition(shards, "shard").sortWithinPartitions("shard", "source_index", "block", "turn", "at"), compression="zstd")
    got = made.groupBy("source_index", "segment", "place").agg(F.sum("words").alias("taken"))
    one = placed.withColumn("place", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("m") - 1), lambda c: F.col("place") + c * F.col("size"))))
    one = one.select("source_index", "doc_id", "size", "segment", "place").join(got, ["source_index", "segment", "place"], "left").select("source_index", "doc_id", "size", "taken")
    empty = rows.where("size = 0").select("source_index", "doc_id", "size", F.lit(None).cast("long").alias("taken"), F.explode(F.sequence(F.lit(1).cast("long"), "m")).alias("_c")).drop("_c")
    out = one.union(empty).join(table, "source_index")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")), made


MIX = "shard int, source_index int, block long, turn int, at int, words int, segment long, place long, text string"


def _parts(texts: DataFrame, layout: Layout) -> DataFrame:
    """The parts of blocks that the documents give, once for each slot of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first in range(0, b.num_rows, 256):
                yield from _cut(b.slice(first, 256), layout)

    return texts.mapInArrow(run, MIX)


def _cut(own: pa.RecordBatch, layout: Layout) -> Iterator[pa.RecordBatch]:
    size = layout.block
    blobs = own["text"].cast(pa.binary()).to_pylist()
    source, segment, place = (own[c].to_numpy().astype(np.int64) for c in ("source_index", "segment", "place"))
    joined = b"\n".join(blobs)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[np.frombuffer(joined, np.uint8)], [True])).astype(np.int8)))
    begin, stop = edge[::2], edge[1::2]
    before = np.searchsorted(begin, np.cumsum([0] + [len(x) + 1 for x in blobs]))
    count = np.diff(before)
    row = np.repeat(np.arange(len(blobs)), count)
    spot = np.arange(len(begin)) - np.repeat(before[:-1], count) + place[row]  # word of the segment
    heads = np.flatnonzero((spot % size == 0) | np.concatenate(([True], row[1:] != row[:-1])))
    tails = np.append(heads[1:], len(begin))
    r = row[heads]
    base = np.array([layout.base[i, g][0] for i, g in zip(source.tolist(), segment.tolist(), strict=True)], np.int64)
    number, at, words = base[r] + spot[heads] // size, spot[heads] % size, tails - heads
    for i in np.unique(source[r]).tolist():
        mine = np.flatnonzero(source[r] == i)
        for which, shard, most, turn in layout.places(i, number[mine]):
            k = mine[which]
            n = np.minimum(words[k], most - at[k])
            k, shard, n = k[n > 0], shard[n > 0], n[n > 0]
            if len(k):
                text = [joined[a:z] for a, z in zip(begin[heads[k]].tolist(), stop[heads[k] + n - 1].tolist(), strict=True)]
                cols = [shard.astype(np.int32), np.full(len(k), i, np.int32), number[k], np.full(len(k), turn, np.int32), at[k].astype(np.int32), n.astype(np.int32), segment[r[k]], place[r[k]]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(text, pa.binary()).cast(pa.string())], ["shard", "source_index", "block", "turn", "at", "words", "segment", "place", "text"])


def op3(spark, sf_dir: str) -> DataFrame:
    out, _ = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"), Scratch(spark))
    return out.select("doc_id", "size", "source_size", "target", "taken")
