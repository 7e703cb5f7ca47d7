"""Substring dedup: repeated passages of documents by MinHash bands of paragraphs.

A paragraph is a run of LENGTH words. It begins where the five-word shingle has the least hash of some WINDOW places in a
row, so a passage has the same paragraphs wherever it stands, and every run of WINDOW + LENGTH - 1 = 49 words that two
documents share holds at least one of them. What is left of a removed passage are less than WINDOW words at either end.
Bands of MinHash values join paragraphs; equal sets are one class, all other classes of a bucket are compared by exact
Jaccard; connected classes are one cluster. The first paragraph of a cluster stays, the rest is removed.

Most band keys stand in one document only. A first pass over the texts sends the keys alone, as packed arrays by key range,
and finds those of several documents; the second pass writes only paragraphs that have one, as a filter of bounded size tells.

What goes to every task is bounded by its size, as a few rows may hold long lists; anything larger is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from .components import connected_components
from .overlap import common, flat_sets, roots
from .scratch import Scratch, row_id, sendable
from .words import chunks, mix, shingle_hashes, signed

WINDOW, LENGTH, SHINGLE, PERCENT = 20, 30, 5, 80
SPAN = LENGTH - SHINGLE + 1
#: Classes of one bucket that are compared as one array.
BLOCK = 512
#: Classes of one bucket that are compared set by set.
FEW = 12
#: Keys packed at once.
GATHER = 1 << 21
#: Shared keys up to which the filter that is sent to every task has KEY_BITS bits for each (16 MB); it grows no further.
SEND_KEYS, KEY_BITS = 8_000_000, 16
#: Narrow rows, places of paragraphs (28 bytes) and of removed words (32 bytes) that are sent to every task at most.
SEND, SEND_PLACES, SEND_SPANS = 100_000, 500_000, 100_000
#: Bits of the filter of row ids (2 MB) by which only texts that may have a partner are shuffled.
MARKS = 1 << 24
LAST = np.uint64(2**64 - 1)


def tune_bands(similarity: float = PERCENT / 100, recall: float = 0.95, least_rows: int = 2, most_rows: int = 4) -> tuple[int, int]:
    """(bands, rows): the fewest bands, then the most rows, that join a pair of paragraphs of the similarity with the
    recall; more rows join fewer unlike pairs, and a single one joins too many."""
    for b in range(1, 65):
        fits = [r for r in range(least_rows, most_rows + 1) if 1 - (1 - similarity**r) ** b >= recall]
        if fits:
            return b, max(fits)
    raise ValueError("no banding reaches the recall")


BANDS, ROWS = tune_bands()
KEYS = [f"k{k}" for k in range(BANDS)]
_TIMES = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def _least(x: np.ndarray, n: int, op: np.ufunc = np.minimum) -> np.ndarray:
    """Least (or largest) of each n values in a row, in log n steps."""
    done = 1
    while done < n:
        step = min(done, n - done)
        x = op(x[:-step], x[step:])
        done += step
    return x


def _shingles(h: np.ndarray) -> np.ndarray:
    """Hashes of all SHINGLE-word runs of a word sequence, LAST where none is left."""
    out = np.full(len(h), LAST)
    if len(h) >= SHINGLE:
        out[: len(h) - SHINGLE + 1] = np.minimum(shingle_hashes(h, SHINGLE), LAST - np.uint64(1))
    return out


def paragraph_starts(s: np.ndarray, before: np.ndarray) -> np.ndarray:
    """First words of the paragraphs of several documents in one word sequence; ``s``: shingle hashes at every word,
    ``before``: first word of each document, and the end. A document of fewer than LENGTH words has none; one of fewer
    places than WINDOW has at least one."""
    size = np.diff(before)
    place = np.maximum(size - LENGTH + 1, 0)
    first = np.repeat(before[:-1], size)
    valid = np.arange(len(s)) - first < np.repeat(place, size)
    x = np.where(valid, s, LAST)
    if not valid.any():
        return np.zeros(0, np.int64)
    low = np.zeros(len(s), np.uint64)
    if len(s) >= WINDOW:
        whole = np.concatenate(([0], np.cumsum(valid)))
        full = whole[WINDOW:] - whole[:-WINDOW] == WINDOW
        low[: len(s) - WINDOW + 1] = np.where(full, _least(x, WINDOW), 0)
    for r in np.flatnonzero((place > 0) & (place < WINDOW)):
        low[before[r]] = x[before[r] : before[r] + place[r]].min()
    # a place begins a paragraph if it has the least hash of a window that holds it
    best = _least(np.concatenate((np.zeros(WINDOW - 1, np.uint64), low)), WINDOW, np.maximum)
    return np.flatnonzero(valid & (best == x))


def _paragraphs(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row of each paragraph, its first word, its place in s, s) for a few documents at once."""
    for first, h, _, _, before, _ in chunks(texts):
        s = _shingles(h)
        at = paragraph_starts(s, before)
        if len(at):
            row = np.searchsorted(before, at, "right") - 1
            yield first, row, at - before[row], at, s


def _keys(s: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Band keys of the paragraphs at the places ``at``."""
    out = []
    for k in range(BANDS):
        key = np.full(len(at), k, np.uint64)
        for j in range(ROWS):
            key = mix(key + _least(s * _TIMES[k * ROWS + j], SPAN)[at])
        out.append(key)
    return out


def _classes(s: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit fingerprints of the paragraphs' shingles."""
    total = []
    for x in (s, s ^ np.uint64(0x5851F42D4C957F2D)):
        c = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(x))))
        total.append(signed(mix(c[at + SPAN] - c[at])))
    return tuple(total)


def shared_keys(docs: DataFrame, ranges: int) -> DataFrame:
    """range, keys: the band keys that stand in several documents, packed by the leading bits of the key.

    Only packed keys are shuffled: 32 bits behind the range's, one for each key and GATHER keys, so a frequent key weighs as
    much as any other. Keys that agree in all those bits count as one, which lets a few single ones pass."""
    bits = np.uint64(ranges.bit_length() - 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[np.ndarray]) -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held) >> (np.uint64(32) - bits), return_counts=True)
            part = (key >> np.uint64(32)).astype(np.int64)
            cols = []
            for own in (n == 1, n > 1):
                cuts = np.searchsorted(part[own], np.arange(ranges + 1))
                low = key[own].astype(np.uint32)
                cols.append([low[a:z].tobytes() for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)])
            return pa.RecordBatch.from_arrays([pa.array(np.arange(ranges, dtype=np.int32)), *(pa.array(c, pa.binary()) for c in cols)], ["range", "once", "more"])

        held, size = [], 0
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                for _, row, _, places, s in _paragraphs(b.slice(at, 1024)["text"]):
                    key, row = np.concatenate(_keys(s, places)), np.tile(row, BANDS)
                    order = np.lexsort((row, key))
                    key, row = key[order], row[order]
                    held.append(key[np.concatenate(([True], (key[1:] != key[:-1]) | (row[1:] != row[:-1])))])
                    size += len(held[-1])
                    if size >= GATHER:
                        yield flush(held)
                        held, size = [], 0
        if held:
            yield flush(held)

    def meet(t: pa.Table) -> pa.Table:
        once, more = (np.frombuffer(b"".join(t[c].to_pylist()), np.uint32) for c in ("once", "more"))
        key, n = np.unique(np.concatenate((once, np.unique(more), np.unique(more))), return_counts=True)
        return pa.table({"range": t["range"].slice(0, 1), "keys": pa.array([key[n > 1].tobytes()], pa.binary())})

    return docs.select("text").mapInArrow(pack, "range int, once binary, more binary").groupBy("range").applyInArrow(meet, "range int, keys binary")


def _filter_places(short: np.ndarray, slots: int, times: int) -> list[np.ndarray]:
    """Bits that a filter of ``slots`` bits (a power of two) for each range has for keys of range and 32 bits."""
    hashed = mix(short)
    step = hashed >> np.uint64(32) | np.uint64(1)
    return [(short >> np.uint64(32)) * np.uint64(slots) + (hashed + np.uint64(k) * step & np.uint64(slots - 1)) for k in range(times)]


def key_filter(shared: DataFrame, ranges: int, total: int) -> tuple[np.ndarray, int, int]:
    """(bytes, slots, times): the ``total`` shared keys as a Bloom filter, built range by range in the tasks. Its size is
    bounded; with more than SEND_KEYS keys a larger part of the others passes."""
    size = max(8 * ranges, KEY_BITS * min(total, SEND_KEYS))
    slots = max(8, 1 << (size // ranges - 1).bit_length())
    times = min(4, max(1, round(0.69 * slots * ranges / max(1, total))))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, keys in zip(b["range"].to_pylist(), b["keys"].to_pylist(), strict=True):
                flags = np.zeros(slots, bool)
                for at in _filter_places((np.uint64(part) << np.uint64(32)) | np.frombuffer(keys, np.uint32).astype(np.uint64), slots, times):
                    flags[at & np.uint64(slots - 1)] = True
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())], ["range", "bits"])

    known = np.zeros((ranges, slots // 8), np.uint8)
    got = shared.mapInArrow(build, "range int, bits binary").toArrow()
    for part, bits in zip(got["range"].to_pylist(), got["bits"], strict=True):
        known[part] = np.frombuffer(bits.as_buffer(), np.uint8)
    return known.ravel(), slots, times


def paragraph_table(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """rid, doc_id, p, c1, c2 (fingerprint of the shingles) and band keys k0, k1, ... of every paragraph that shares a key
    with another document; keys that the filter of shared keys leaves out are null. A few keys of one document pass it."""
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = 1 << max(6, (4 * parts - 1).bit_length())
    bits = np.uint64(ranges.bit_length() - 1)
    shared = scratch.save(shared_keys(docs, ranges))
    total = (shared.agg(F.sum(F.length("keys"))).first()[0] or 0) // 4
    known, slots, times = key_filter(shared, ranges, total)

    def passes(keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in _filter_places(keys >> (np.uint64(32) - bits), slots, times):
            out &= known[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1) == 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                own = b.slice(at, 1024)
                found = []
                for first, row, p, places, s in _paragraphs(own["text"]):
                    keys = _keys(s, places)
                    met = [passes(k) for k in keys]
                    some = np.logical_or.reduce(met)
                    if some.any():
                        found.append([(first + row)[some], p[some], *(c[some] for c in _classes(s, places)), *(k[some] for k in keys), *(m[some] for m in met)])
                if found:
                    cols = [np.concatenate(c) for c in zip(*found, strict=True)]
                    r = pa.array(cols[0])
                    keys = [pa.array(signed(k), mask=~m) for k, m in zip(cols[4 : 4 + BANDS], cols[4 + BANDS :], strict=True)]
                    yield pa.RecordBatch.from_arrays([own["rid"].take(r), own["doc_id"].take(r), pa.array(cols[1].astype(np.int32)), pa.array(cols[2]), pa.array(cols[3]), *keys], ["rid", "doc_id", "p", "c1", "c2", *KEYS])

    rows = docs.select("rid", "doc_id", "text").mapInArrow(run, "rid long, doc_id long, p int, c1 long, c2 long" + "".join(f", {k} long" for k in KEYS))
    out = scratch.save(rows)
    scratch.drop(shared)
    return out


def row_marks(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """One row, _marks: a bit for every rid of ``rows``, as an array of MARKS / 64 numbers."""
    bit = F.pmod("rid", F.lit(MARKS))
    own = rows.select(F.shiftright(bit, 6).alias("_word"), F.expr(f"shiftleft(1L, cast(pmod(rid, {MARKS}) % 64 as int))").alias("_bits"))
    every = own.union(rows.sparkSession.range(MARKS // 64).select("id", F.lit(0).cast("long")))
    words = every.groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    return scratch.save(words.agg(F.sort_array(F.collect_list(F.struct("_word", "_bits"))).alias("_w")).select(F.col("_w._bits").alias("_marks")))


def by_marks(rows: DataFrame, marks: DataFrame, marked: bool = True) -> DataFrame:
    """The rows whose rid is marked, which a few others are too; or the rest."""
    bit = F.pmod("rid", F.lit(MARKS))
    there = F.getbit(F.col("_marks")[F.shiftright(bit, 6).cast("int")], (bit % 64).cast("int")) == 1
    return rows.join(F.broadcast(marks), there if marked else ~there, "left_semi")


def bucket_sets(places: DataFrame, classes: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """key, i, j, block, cid, comp, set (sorted distinct shingles) of each row of ``places``: cid, key, block, and other (block
    it is compared with) and comp if they are not the block itself and cid.

    ``classes``: cid, c1, rid of a row that holds the class. The places travel to the texts, as arrays for each row, so that
    the sets move once, to their buckets. Too many places to send meet the texts of their rows in a shuffle.
    """
    more = [c for c in ("other", "comp") if c in places.columns]
    names = ["c1", "cid", "key", "block", *more]
    own = places.join(classes.select("cid", "c1", "rid"), "cid").groupBy("rid").agg(F.collect_list(F.struct(*names)).alias("_p"))
    lists = scratch.save(own.select("rid", *[F.col(f"_p.{c}").alias(c) for c in names]))
    rows, total = lists.agg(F.count("*"), F.sum(F.size("c1"))).first()
    if few := (total or 0) + 4 * rows <= SEND_PLACES:
        lists = F.broadcast(lists)
    else:
        # Spark would still send what is small on disk
        docs, lists = by_marks(docs, row_marks(lists, scratch)), lists.hint("merge")
    texts = docs.join(lists, "rid").select("rid", "text", *names)
    ids = lists.select("rid")
    if docs.select("rid").join(F.broadcast(ids) if few else ids, "rid").count() > rows:
        # a row that is there twice would bring its sets twice
        texts = texts.dropDuplicates(["rid"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                t = b.slice(at, 256)
                flat = {c: t[c].flatten().to_numpy() for c in names}
                ends = t["c1"].value_lengths().to_numpy().cumsum()
                # one document's paragraphs are told apart by half of the fingerprint
                want = [{} for _ in ends]
                for k, (r, c) in enumerate(zip(np.searchsorted(ends, np.arange(len(flat["c1"])), "right").tolist(), flat["c1"].tolist(), strict=True)):
                    want[r].setdefault(c, []).append(k)
                take, sets = [], []
                for first, row, _, places, s in _paragraphs(t["text"]):
                    for r, i, c in zip((first + row).tolist(), places.tolist(), _classes(s, places)[0].tolist(), strict=True):
                        if (found := want[r].pop(c, None)) is not None:
                            take += found
                            sets += [signed(np.unique(s[i : i + SPAN])).tobytes()] * len(found)
                got = {c: v[np.array(take, np.int64)] for c, v in flat.items()}
                block, other = got["block"], got.get("other", got["block"])
                cols = [got["key"], np.minimum(block, other), np.maximum(block, other), block, got["cid"], got.get("comp", got["cid"])]
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(sets, pa.binary())], ["key", "i", "j", "block", "cid", "comp", "set"])

    return texts.select("text", *names).mapInArrow(run, "key long, i int, j int, block int, cid long, comp long, set binary")


def bucket_links(cid: list[int], block: list[int], comp: list[int], sets: pa.ChunkedArray) -> list[tuple[int, int]]:
    """(class, root) for the classes of one bucket that exact Jaccard connects: all pairs, or those of unlike blocks.

    Pairs that lie in one component (``comp``) already count as linked."""
    cross, n = min(block) != max(block), len(cid)
    linked = np.zeros((n, n), bool)
    if n <= FEW:
        own = [set(np.frombuffer(x.as_buffer(), np.int64).tolist()) for x in sets]
        for x in range(n):
            for y in range(x):
                if comp[x] == comp[y]:
                    linked[x, y] = True
                elif not cross or block[x] != block[y]:
                    both = len(own[x] & own[y])
                    linked[x, y] = 100 * both >= PERCENT * (len(own[x]) + len(own[y]) - both)
        linked |= linked.T | np.eye(n, dtype=bool)
    else:
        flat, size = flat_sets(sets)
        both = common(flat, size, flat, size)
        linked = 100 * both >= PERCENT * (size[:, None] + size - both)
        if cross:
            linked &= np.array(block)[:, None] != np.array(block)
        linked |= np.array(comp)[:, None] == np.array(comp)
    low = roots(linked)[0].tolist()
    return [(cid[x], cid[r]) for x, r in enumerate(low) if x != r and comp[x] != comp[r]]


def _compare(rows: DataFrame) -> DataFrame:
    """(src, dst): links among the classes of each bucket and pair of blocks; ``rows``: key, i, j, block, cid, comp, set."""

    def links(t: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
        cid, comp, block = (t[c].to_pylist() for c in ("cid", "comp", "block"))
        out = []
        for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if z - a > 1:
                out += bucket_links(cid[a:z], block[a:z], comp[a:z], t["set"].slice(a, z - a))
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            if not t.num_rows:
                continue
            group = np.stack([t[c].to_numpy() for c in ("key", "i", "j")])
            bounds = np.concatenate(([0], np.flatnonzero((group[:, 1:] != group[:, :-1]).any(0)) + 1))
            # the last group may go on in the next batch
            yield links(t, bounds)
            held = t.slice(bounds[-1])
        if held is not None:
            yield links(held, np.array([0, held.num_rows]))

    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return rows.mapInArrow(run, "src long, dst long").distinct()


def with_row_id(docs: DataFrame) -> DataFrame:
    """rid (see scratch.row_id), doc_id and text of each row."""
    return docs.select(row_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def class_links(held: DataFrame, classes: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(src, dst): links of exact Jaccard that join all classes which similar pairs within a bucket connect.

    ``held``: key, cid of the buckets of several classes; ``classes``: cid, c1, c2, rid of a row. A bucket's classes fall
    into blocks of about BLOCK by hash. Each block is compared as a whole; then pairs of blocks of the buckets that still lie
    in several components are.
    """
    # near copies share several bands: buckets of the same classes are compared once
    bucket = held.groupBy("key").agg(F.count("*").alias("c"), F.sum(F.xxhash64("cid").cast("decimal(38,0)")).alias("h1"), F.bit_xor(F.xxhash64("cid", F.lit(2))).alias("h2"))
    once = scratch.save(bucket.groupBy("c", "h1", "h2").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("c") / BLOCK).cast("int").alias("n")))
    sized = held.join(sendable(once, SEND), "key").withColumn("block", F.pmod(F.xxhash64("cid", F.lit(1)), F.col("n")).cast("int"))
    sized = scratch.save(sized)
    links = scratch.save(_compare(bucket_sets(sized.select("cid", "key", "block"), classes, docs, scratch)))
    scratch.free_shuffles()
    if once.where("n > 1").limit(1).count():
        comp = connected_components(links, scratch).select(F.col("node").alias("cid"), F.col("component").alias("comp"))
        now = scratch.save(sized.where("n > 1").join(comp, "cid", "left").withColumn("comp", F.coalesce("comp", "cid")))
        apart = now.join(now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key"), "key")
        pairs = apart.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).where("other <> block")
        links = links.union(scratch.save(_compare(bucket_sets(pairs.select("cid", "key", "block", "other", "comp"), classes, docs, scratch))))
    scratch.drop(sized, once)
    return links


def repeated_paragraphs(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """rid, doc_id, p, q, cluster, first_doc, kept for each paragraph whose cluster spans several documents.

    ``docs``: rid, doc_id, text. The row of the smallest (doc_id, rid) of a cluster keeps its paragraphs (neighbours in one
    text may be alike); a null doc_id comes last. Words are
    counted from 0. Null and empty texts and those of fewer than LENGTH words have no paragraphs; very long ones are hashed a
    piece at a time; repeats within one document alone do not count; rows equal in id and text are one occurrence. No rows
    give no rows.
    """
    table = paragraph_table(docs, scratch)
    scratch.free_shuffles()
    own = table.groupBy("c1", "c2").agg(F.min("rid").alias("lo"), F.max("rid").alias("hi"), *[F.max(k).alias(k) for k in KEYS])
    classes = scratch.save(own.withColumn("cid", F.monotonically_increasing_id()))
    keyed = classes.select("cid", "lo", "hi", F.explode(F.array(*KEYS)).alias("key")).where("key is not null")
    # neighbours in one document overlap and often share a key; only keys of several rows and classes matter
    mixed = scratch.save(keyed.groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("c")).where("c > 1 and lo < hi").select("key"))
    held = scratch.save(keyed.select("key", "cid").join(sendable(mixed, SEND), "key"))
    links = class_links(held, classes.select("cid", "c1", "c2", F.col("lo").alias("rid")), docs, scratch)
    comp = scratch.save(connected_components(links, scratch).select(F.col("node").alias("cid"), F.col("component").alias("comp")))
    cluster = scratch.save(classes.join(comp, "cid", "left").where("comp is not null or lo < hi").select("c1", "c2", F.coalesce("comp", "cid").alias("cluster")))
    scratch.free_shuffles()
    rows = scratch.save(table.select("rid", "doc_id", "p", "c1", "c2").join(sendable(cluster, SEND), ["c1", "c2"]).select("rid", "doc_id", "p", "cluster"))
    scratch.drop(table, classes, held, mixed)
    scratch.free_shuffles()
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid", "p")
    first = rows.groupBy("cluster").agg(F.min(place).alias("first"), F.max("rid").alias("_hi"), F.min("rid").alias("_lo")).where("_lo < _hi").drop("_lo", "_hi")
    out = rows.join(sendable(scratch.save(first), SEND), "cluster")
    return out.select("rid", "doc_id", "p", (F.col("p") + LENGTH).alias("q"), "cluster", F.col("first.doc_id").alias("first_doc"), (F.col("first.rid") == F.col("rid")).alias("kept"))


def removal_spans(found: DataFrame) -> DataFrame:
    """rid, spans: merged word ranges that go from each row."""
    spans = found.where("not kept").groupBy("rid").agg(F.sort_array(F.collect_set(F.struct("p", "q"))).alias("s"))
    merged = F.aggregate(
        "s",
        F.array().cast("array<struct<p:int,q:int>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["q"] >= x["p"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["p"].alias("p"), F.greatest(F.element_at(acc, -1)["q"], x["q"]).alias("q"))))).otherwise(F.array_append(acc, x)),
    )
    return spans.select("rid", F.when(F.size("s") > 0, merged).alias("spans"))


def remove_passages(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any other columns) without the removed passages; n_chars, if there, follows.

    A row that loses all its words goes. Rows without a repeated passage are unchanged, among them null, empty and short
    texts; equal rows are treated alike; other columns pass through, whatever their names.
    """
    names = docs.columns
    spans = scratch.save(removal_spans(repeated_paragraphs(with_row_id(docs), scratch)))
    # the caller's columns travel in one struct, so that no name can clash
    rows = docs.select(row_id().alias("rid"), F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"))
    few = spans.agg(F.sum(F.size("spans") + 4)).first()[0] or 0
    if few <= SEND_SPANS:
        joined = rows.join(F.broadcast(spans), "rid", "left")
        same, near = joined.where("spans is null"), joined.where("spans is not null")
    else:
        # only rows that may have spans are shuffled
        marks = row_marks(spans, scratch)
        same, near = by_marks(rows, marks, False), by_marks(rows, marks).join(spans.hint("merge"), "rid", "left")
    at = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            row, spans = b["row"].flatten(), b["spans"].to_pylist()
            for t, s in zip(row[at].to_pylist(), spans, strict=True):
                if s is None:
                    out.append(t)
                    continue
                blob = t.encode("utf-8", "surrogatepass")
                _, _, starts, ends, _, _ = next(chunks(pa.array([t])))
                keep, done = [], 0
                for x in s:
                    keep.append(blob[done : starts[x["p"]]])
                    done = ends[x["q"] - 1]
                out.append(b"".join([*keep, blob[done:]]).strip(b" \t\r\n\x0b\x0c").decode("utf-8", "surrogatepass"))
            new = pa.StructArray.from_arrays([pa.array(out, pa.string()) if i == at else x for i, x in enumerate(row)], fields=list(b.schema.field("row").type))
            yield pa.RecordBatch.from_arrays([new, pa.array([s is not None for s in spans])], ["row", "cut"])

    kind = StructType([StructField("row", docs.schema), StructField("cut", BooleanType())])
    changed = near.select("row", "spans").mapInArrow(cut, kind).where("not cut or row.text <> ''")
    values = [F.col(f"row.`{n}`") for n in names]
    if "n_chars" in names:
        n = names.index("n_chars")
        values[n] = F.when(F.col("cut"), F.length("row.text").cast(docs.schema["n_chars"].dataType)).otherwise(values[n]).alias("n_chars")
    return same.select("row.*").union(changed.select(*values))


def op9(spark, sf_dir: str) -> DataFrame:
    """One row for each document with a repeated passage: class_id is the smallest doc_id of the documents that repeated
    passages connect."""
    scratch = Scratch(spark)
    docs = with_row_id(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = scratch.save(repeated_paragraphs(docs, scratch))
    comp = connected_components(found.where("doc_id is not null and first_doc is not null").select(F.col("doc_id").alias("src"), F.col("first_doc").alias("dst")).distinct(), scratch)
    own = found.groupBy("rid", "doc_id").agg(F.size(F.collect_set("p")).alias("n_passages"), F.size(F.collect_set(F.when(~F.col("kept"), F.col("p")))).alias("n_removed"))
    spans = removal_spans(found)
    out = own.join(spans, "rid", "left").join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    words = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["q"] - x["p"])
    return out.select("doc_id", F.coalesce("component", "doc_id").alias("class_id"), "n_passages", "n_removed", F.coalesce(words, F.lit(0)).alias("removed_words"), "spans")
