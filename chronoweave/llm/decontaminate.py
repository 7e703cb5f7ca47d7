"""Benchmark decontamination by SimHash of item-sized windows.

A window of a document and a window of a benchmark item have 64-bit SimHash fingerprints of their words. Four 16-bit
blocks index the items' fingerprints with all values one bit away, so every pair within RADIUS differing bits (at most
one of them in some block) is found; exact weighted-shingle similarity of the item and the document's region decides.
One map over the documents; the benchmark's index is bounded and sent in parts if there are many items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch
from .words import chunks, shingle_hashes

RADIUS = 7
SHINGLE, SIMILARITY = 5, 0.8
#: Benchmark words in one index; a larger benchmark takes several passes.
PART_WORDS = 400_000
#: Windows from this size on take wider counts.
WIDE = 256
_SPREAD = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)
_ONE = np.concatenate(([0], 1 << np.arange(16))).astype(np.uint16)


def window_of(n: int) -> tuple[int, int]:
    """Window size and stride for an item of n words, at any length: the largest size of a geometric grid (53 to 67 % of the
    item) of which any run of 80 % of the item holds ``stride`` whole windows, one of which starts at a multiple of the stride."""
    size, found = 8, None
    while size + (stride := max(2, size // 5)) - 1 <= 0.8 * n:
        found = (size, stride)
        size = size * 5 // 4
    return found or (max(1, min(n, 6)), 1)


def bit_counts(h: np.ndarray) -> np.ndarray:
    """Running counts of the hashes' 64 bits, eight to a 64-bit number (a byte each), one column more than words.

    The numbers wrap, but the difference of two columns at most 255 words apart is exact in every byte."""
    out = np.zeros((8, len(h) + 1), np.uint64)
    parts = h.view(np.uint8).reshape(-1, 8)
    for j in range(8):
        np.cumsum(_SPREAD[parts[:, j]], out=out[j, 1:])
    return out


def wide_fingerprints(h: np.ndarray, size: int, stride: int) -> np.ndarray:
    """SimHash of windows of any size, a byte of the hashes at a time."""
    parts = h.view(np.uint8).reshape(-1, 8)
    out = np.zeros(len(range(0, len(h) + 1 - size, stride)), np.uint64)
    for j in range(8):
        c = np.zeros((len(h) + 1, 8), np.int32)
        np.cumsum(np.unpackbits(parts[:, j : j + 1], axis=1, bitorder="little"), axis=0, out=c[1:])
        more = c[size::stride] - c[:-size:stride] > size // 2
        out |= np.packbits(more, axis=1, bitorder="little")[:, 0].astype(np.uint64) << np.uint64(8 * j)
    return out


def fingerprints(h: np.ndarray, bits: np.ndarray, size: int, stride: int) -> np.ndarray:
    """SimHash of the windows at multiples of stride: a bit is set if more than half of the words have it."""
    if size >= WIDE:
        return wide_fingerprints(h, size, stride)
    out = np.zeros(len(range(0, bits.shape[1] - size, stride)), np.uint64)
    lift = np.uint64(0x0101010101010101 * (127 - size // 2))
    for j in range(8):
        d = bits[j, size::stride] - bits[j, :-size:stride]
        d += lift
        d >>= np.uint64(7)
        d &= np.uint64(0x0101010101010101)
        d *= np.uint64(0x0102040810204080)  # gathers the eight bits in the top byte
        d >>= np.uint64(56)
        out |= d << np.uint64(8 * j)
    return out


class BenchIndex:
    """Fingerprints of all windows of the items by window size, their block tables, and the items' weighted shingles."""

    def __init__(self, items: list[tuple[int, np.ndarray]], shared: dict[int, int], total: int) -> None:
        """``shared``: in how many items of the whole benchmark a shingle of several stands; ``total``: all its items."""
        self.items = items
        self.top = float(np.log(1 + total))
        self.weights = [{x: float(np.log(1 + total / shared.get(x, 1))) for x in shingle_hashes(h, SHINGLE).tolist()} for _, h in items]
        by: dict[tuple[int, int], list[tuple[int, int, np.uint64]]] = {}
        for i, (_, h) in enumerate(items):
            if len(h):
                size, stride = window_of(len(h))
                for at, fp in enumerate(fingerprints(h, bit_counts(h), size, 1)):
                    by.setdefault((size, stride), []).append((i, at, fp))
        self.classes = {}
        for key, rows in by.items():
            fp = np.array([r[2] for r in rows], np.uint64)
            tables = []
            for k in range(4):
                near = ((fp >> np.uint64(16 * k)).astype(np.uint16)[:, None] ^ _ONE).ravel()
                order = np.argsort(near, kind="stable")
                start = np.searchsorted(near[order], np.arange(65537)).astype(np.int32)
                tables.append((np.diff(start) > 0, start, np.repeat(np.arange(len(fp)), 17)[order]))
            self.classes[key] = (fp, np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), tables)

    def hits(self, w: np.ndarray, key: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs (window, fingerprint, differing bits) within RADIUS."""
        fp, _, _, tables = self.classes[key]
        found = []
        blocks = w.view(np.uint16).reshape(-1, 4)
        for k, (full, start, ids) in enumerate(tables):
            at = np.flatnonzero(full[blocks[:, k]])
            for cut in range(0, len(at), 1 << 15):
                own = at[cut : cut + (1 << 15)]
                v = blocks[own, k].astype(np.int32)
                n = start[v + 1] - start[v]
                win = np.repeat(own, n)
                cand = ids[np.repeat(start[v] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
                d = np.bitwise_count(w[win] ^ fp[cand])
                ok = d <= RADIUS
                found.append(np.stack((win[ok], cand[ok], d[ok].astype(np.int64))))
        got = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((3, 0), np.int64)
        return got[0], got[1], got[2]

    def similarity(self, item: int, region: np.ndarray) -> float:
        """Weighted Jaccard of the shingles; a shingle of no item has the largest weight."""
        own = self.weights[item]
        other = set(shingle_hashes(region, SHINGLE).tolist())
        both = sum(own[x] for x in other if x in own)
        return both / (sum(own.values()) + sum(self.top for x in other if x not in own))


_DROP = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def plain_words(texts: pa.Array) -> pa.Array:
    """Lower-cased texts with every ASCII character that is no letter or digit as a blank."""
    return pa.array([None if t is None else t.lower().encode("utf-8", "replace").translate(_DROP) for t in texts.to_pylist()], pa.binary())


def scan(texts: pa.Array, index: BenchIndex) -> list[tuple[int, int, float, int, int, int]]:
    """(row, item position, similarity, first word, end word, differing bits): the best region of each row and item."""
    best: dict[tuple[int, int], tuple[float, int, int, int]] = {}
    for first, h, _, _, before, _ in chunks(plain_words(texts)):
        bits = bit_counts(h)
        for key in index.classes:
            size, stride = key
            if len(h) < size:
                continue
            pos = np.arange(0, len(h) - size + 1, stride)
            row = np.searchsorted(before, pos, "right") - 1
            inside = pos + size <= before[row + 1]
            win, cand, dist = index.hits(fingerprints(h, bits, size, stride)[inside], key)
            pos, row = pos[inside], row[inside]
            _, owner, offset, _ = index.classes[key]
            seen = set()
            for w, c, d in sorted(zip(win.tolist(), cand.tolist(), dist.tolist(), strict=True), key=lambda x: x[2]):
                r, i = int(row[w]), int(owner[c])
                n = len(index.items[i][1])
                start = int(min(max(pos[w] - offset[c], before[r]), max(before[r], before[r + 1] - n)))
                if (r, i, start) in seen:
                    continue
                seen.add((r, i, start))
                end = min(start + n, int(before[r + 1]))
                s = index.similarity(i, h[start:end])
                if s >= SIMILARITY and s > best.get((first + r, i), (0.0,))[0]:
                    best[first + r, i] = (s, start - int(before[r]), end - int(before[r]), d)
    return [(r, i, *v) for (r, i), v in sorted(best.items())]


def item_counts(items: DataFrame) -> tuple[dict[int, int], int]:
    """Items of each shingle that stands in several, and the number of items, over the whole benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [np.zeros(0, np.int64)]
            for _, h, _, _, before, _ in chunks(plain_words(b["text"])):
                got += [np.unique(shingle_hashes(h[a:z], SHINGLE)).view(np.int64) for a, z in zip(before[:-1], before[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(got))], ["h"])

    several = items.select("text").mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").toArrow()
    return dict(zip(several["h"].to_numpy().view(np.uint64).tolist(), several["n"].to_pylist(), strict=True)), items.count()


def build_indexes(benchmark: DataFrame, scratch: Scratch) -> Iterator[BenchIndex]:
    """Indexes of the items, each of at most PART_WORDS words (or one item), read one after another."""
    # one item text at a time reaches the driver; identical texts are one item, of the smallest id
    items = scratch.save(benchmark.where("text is not null").groupBy("text").agg(F.min("item_id").cast("long").alias("item_id")))
    shared, total = item_counts(items)
    part, size = [], 0
    for r in items.orderBy("item_id").toLocalIterator():
        for _, h, *_ in chunks(plain_words(pa.array([r["text"]]))):
            if len(h):
                part.append((r["item_id"], h))
                size += len(h)
        if size >= PART_WORDS:
            yield BenchIndex(part, shared, total)
            part, size = [], 0
    if part:
        yield BenchIndex(part, shared, total)


OUT = "doc_id long, item_id long, similarity double, first_word long, end_word long, differing_bits int"


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, first_word, end_word, differing_bits: each document row and benchmark item that share a
    region of weighted-shingle similarity 0.8 or more (five words; the whole text if it has fewer).

    Case and ASCII punctuation do not count. Null and empty texts and items match nothing; equal item texts count as the
    smallest id; repeated document rows give repeated results; the best region wins, ties by fewest differing bits; other
    columns are ignored; very long texts are hashed a piece at a time; no documents or no items give no rows.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    done, held = [], None
    for index in build_indexes(benchmark, scratch):
        if held is not None:  # several parts: each is a pass of its own, and its index goes before the next is sent
            done.append(scratch.save(_pass(rows, held)))
            held.unpersist()
        held = spark.sparkContext.broadcast(index)
    if held is None:
        return spark.createDataFrame([], OUT)
    out = _pass(rows, held)
    for x in done:
        out = out.union(x)
    return out


def _pass(rows: DataFrame, held) -> DataFrame:
    """One map over all documents with one part of the benchmark's index, sent once to each executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for b in batches:
            for at in range(0, b.num_rows, 256):
                own = b.slice(at, 256)
                got = scan(own["text"], index)
                cols = list(zip(*got, strict=True)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [own["doc_id"].take(pa.array(cols[0], pa.int64())), pa.array([index.items[i][0] for i in cols[1]], pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int32())],
                    ["doc_id", "item_id", "similarity", "first_word", "end_word", "differing_bits"],
                )

    return rows.mapInArrow(run, OUT)


def op1(spark, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
