"""N-gram Jaccard self-join: documents whose sets of word shingles overlap, their links and the components of the links.

Shingles have one global order, rare first (the most frequent ones, counted over all documents, come last). Two sets of
Jaccard >= t share a shingle among their first n - ceil(t n) + 1, their prefixes; length, positional and suffix filters
thin the candidates, which are verified once. Documents with equal sets are one class from the start, and only classes meet.

Pairs of a shingle that few classes share become rows. A shingle that many classes share (the prefix of a large group of
near copies) would give the square of their number in rows, so its classes are dealt out to pairs of blocks, and each pair
of blocks is compared as arrays: every link is counted, and only a number of links and one edge to the block's root for
each class become rows. A pair that shares several such shingles counts at the first of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import connected_components
from .overlap import common, flat_sets, roots
from .scratch import Scratch, row_id, sendable
from .words import chunks, mix, shingle_hashes, signed

#: Most frequent shingles that get a rank of their own in the order (bounds what is sent to every task).
FREQUENT = 1 << 20
#: A shingle of a chunk of texts counts towards the order from so many documents of the chunk on.
LOCAL_MIN = 3
#: Classes of one shingle up to which its pairs become rows.
SMALL = 64
SIGNATURE = 64
#: Classes, and shingles of theirs, that one side of a comparison holds as arrays.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: Lists of such shingles that are sent to every task at most.
SEND_LISTS = 50_000
#: Shingles of several classes that are sent to every task at most, with their counts (20 bytes each).
SEND_KEYS = 2_000_000
#: Shingle hashes gathered before a count.
GATHER = 1 << 21


def distinct_shingles(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text of a batch."""
    for first, h, _, _, before, _ in chunks(batch["text"]):
        for r in range(len(before) - 1):
            yield first + r, np.unique(shingle_hashes(h[before[r] : before[r + 1]], k))


def frequent_shingles(docs: DataFrame, k: int, scratch: Scratch, limit: int = FREQUENT) -> np.ndarray:
    """The most frequent shingles, at most ``limit``, rarest first, by counts over all documents.

    Every chunk of documents counts its own shingles and passes on those that LOCAL_MIN or more of its documents hold, so a
    count is low by less than LOCAL_MIN for each chunk. The order only has to be the same everywhere; counts set speed alone.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[np.ndarray]) -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= LOCAL_MIN
            return pa.RecordBatch.from_arrays([pa.array(signed(h[often])), pa.array(n[often])], ["h", "n"])

        held, size = [], 0
        for b in batches:
            for _, s in distinct_shingles(b, k):
                held.append(s)
                size += len(s)
                if size >= GATHER:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    rows = scratch.save(docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))
    # the least count of which all shingles fit; its histogram has one row for each count, at most the documents' number
    least, total = 1 << 62, 0
    for r in rows.groupBy("n").agg(F.count("*").alias("c")).orderBy(F.desc("n")).toLocalIterator():
        total += r["c"]
        if total > limit:
            break
        least = r["n"]
    got = rows.where(F.col("n") >= least).toArrow()
    order = np.lexsort((got["h"].to_numpy(), got["n"].to_numpy()))
    scratch.drop(rows)
    return got["h"].to_numpy()[order].astype(np.int64).view(np.uint64)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def class_of(s: np.ndarray) -> tuple[int, int]:
    """128-bit fingerprint of a set: equal sets are one class."""
    both = mix(np.array([x.sum(dtype=np.uint64) + np.uint64(len(s)) for x in (mix(s), mix(s ^ np.uint64(0x5851F42D4C957F2D)))], np.uint64))
    return tuple(signed(both).tolist())


def doc_records(docs: DataFrame, k: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """doc_id, rid, n (set size), c1, c2 (fingerprint of the set), prefix (shingles in the global order) and sig, for each row."""
    order = np.argsort(frequent)
    known, rank = frequent[order], (order + 1).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                n, cls, prefix, sig = [], [], [], []
                for _, s in distinct_shingles(b, k):
                    n.append(len(s))
                    cls.append(class_of(s))
                    if not len(s):
                        prefix.append(np.zeros(0, np.int64))
                        sig.append(b"")
                        continue
                    m = prefix_length(len(s), percent)
                    sig.append(np.minimum(np.bincount((s & np.uint64(SIGNATURE - 1)).astype(np.int64), minlength=SIGNATURE), 255).astype(np.uint8).tobytes())
                    if len(known):
                        i = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        r = np.where(known[i] == s, rank[i], 0)
                        s = s[np.argsort(r, kind="stable")]
                    prefix.append(signed(s[:m]))
                offsets = np.cumsum([0] + [len(p) for p in prefix])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(prefix) if prefix else np.zeros(0, np.int64)))
                arrays = [b["doc_id"], b["rid"], pa.array(n, pa.int32()), *(pa.array([c[i] for c in cls], pa.int64()) for i in (0, 1)), lists, pa.array(sig, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "rid", "n", "c1", "c2", "prefix", "sig"])

    return docs.select("doc_id", "rid", "text").mapInArrow(run, "doc_id long, rid long, n int, c1 long, c2 long, prefix array<long>, sig binary")


def shared_postings(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """cid, n, pos, key, c, size: places of prefix shingles that several classes hold, with the number of those classes and
    the sum of their sizes. Up to SEND_KEYS such shingles go to every task, which leaves the others' places out at once; more
    meet the places in a shuffle."""
    postings = classes.select("cid", "n", F.posexplode("prefix").alias("pos", "key"))
    shared = scratch.save(postings.groupBy("key").agg(F.count("*").alias("c"), F.sum("n").alias("size")).where("c > 1"))
    scratch.free_shuffles()
    if shared.count() > SEND_KEYS:
        held = scratch.save(postings.join(shared, "key"))
        scratch.drop(shared)
        return held
    got = shared.toArrow()
    key, c, size = (got[x].to_numpy() for x in ("key", "c", "size"))
    order = np.argsort(key)
    key, c, size = key[order], c[order].astype(np.int32), size[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches if len(key) else ():
            lists = b["prefix"]
            h, length = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            at = np.minimum(np.searchsorted(key, h), len(key) - 1)
            met = key[at] == h
            row = np.repeat(np.arange(b.num_rows), length)
            pos = np.arange(len(h)) - np.repeat(np.cumsum(length) - length, length)
            at, own = at[met], pa.array(row[met])
            arrays = [b["cid"].take(own), b["n"].take(own), pa.array(pos[met].astype(np.int32)), pa.array(h[met]), pa.array(c[at].astype(np.int64)), pa.array(size[at])]
            yield pa.RecordBatch.from_arrays(arrays, ["cid", "n", "pos", "key", "c", "size"])

    held = scratch.save(classes.select("cid", "n", "prefix").mapInArrow(run, "cid long, n int, pos int, key long, c long, size long"))
    scratch.drop(shared)
    return held


def _may_overlap(a: str, b: str, percent: int) -> str:
    """Length and positional filters for postings a and b of one shingle, as SQL.

    Before the shared shingle at most min(pos) shingles are common, from it on at most min(n - pos).
    """
    best = f"(least({a}.pos, {b}.pos) + least({a}.n - {a}.pos, {b}.n - {b}.pos))"
    return f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n) and {100 + percent} * {best} >= {percent} * ({a}.n + {b}.n)"


def suffix_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Keeps pairs (a, b) whose sets may differ little enough: shingles fall into SIGNATURE parts by hash, and the sets
    differ in at least the sum of the differences of their counts (each up to 255). Pairs that share a shingle of many
    classes go: the blocks find them."""
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("sig").alias(f"s{x}"), F.col("n").alias(f"n{x}"), F.col("hot").alias(f"h{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where("not coalesce(arrays_overlap(ha, hb), false)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for at in range(0, t.num_rows, 4096):
                own = t.slice(at, 4096)
                x, y = (np.frombuffer(b"".join(own[c].to_pylist()), np.uint8).reshape(-1, SIGNATURE).astype(np.int16) for c in ("sa", "sb"))
                n = own["na"].to_numpy().astype(np.int64) + own["nb"].to_numpy()
                apart = np.abs(x - y).sum(1, dtype=np.int64)
                ok = pa.array(100 * (n - apart) >= percent * (n + apart))
                yield pa.RecordBatch.from_arrays([own["a"].filter(ok), own["b"].filter(ok)], ["a", "b"])

    return both.select("a", "b", "sa", "sb", "na", "nb").mapInArrow(run, "a long, b long")


def class_sets(wanted: DataFrame, docs: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """cid, paired, dense, set (sorted shingles) of each class of ``wanted``: cid, c1, c2, doc_id of a member, paired, dense
    (whether pairs or blocks ask for it)."""
    texts = docs.join(sendable(wanted), "doc_id").select("text", "cid", "c1", "c2", "paired", "dense")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                own = b.slice(at, 256)
                want = list(zip(own["c1"].to_pylist(), own["c2"].to_pylist(), strict=True))
                # an id may stand on rows of several texts
                got = [(r, s) for r, s in distinct_shingles(own, k) if class_of(s) == want[r]]
                rows = pa.array([r for r, _ in got], pa.int64())
                yield pa.RecordBatch.from_arrays([*(own[c].take(rows) for c in ("cid", "paired", "dense")), pa.array([signed(s).tobytes() for _, s in got], pa.binary())], ["cid", "paired", "dense", "set"])

    sets = scratch.save(texts.mapInArrow(run, "cid long, paired boolean, dense boolean, set binary"))
    # a row that is there twice brings its class twice
    return scratch.save(sets.dropDuplicates(["cid"])) if sets.count() > wanted.count() else sets


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs of classes (a, b) whose exact Jaccard is at least percent / 100."""
    both = pairs.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("cid").alias("b"), F.col("set").alias("y")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ok = []
            for x, y in zip(t["x"], t["y"], strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(p, q), len(p) - 1)
                n = int((p[at] == q).sum())
                ok.append(100 * n >= percent * (len(p) + len(q) - n))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([t["a"].filter(keep), t["b"].filter(keep)], ["a", "b"])

    return both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _earlier(hot: pa.ChunkedArray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys of all classes, number of each class) of those shingles of many classes that come before the class's ``pos``."""
    lists = hot.combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    places, keys = (lists.flatten().field(c).to_numpy() for c in ("pos", "key"))
    row = np.repeat(np.arange(len(size)), size)
    own = places < pos[row]
    return keys[own], np.bincount(row[own], minlength=len(size))


def compare_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """(cid, root, links): links found in each pair of blocks of one shingle, for each class that has any.

    ``rows``: key, i, j, block, cid, n, pos, w (documents), hot (array of pos, key: all such shingles of the class), set. A
    pair is left to the first such shingle that it shares. ``links`` counts documents of linked classes; ``root`` is a class
    that links connect with ``cid``.
    """

    def run(t: pa.Table) -> pa.Table:
        block = t["block"].to_numpy()
        same = block.min() == block.max()
        left = t if same else t.filter(pa.array(block == block.min()))
        right = t if same else t.filter(pa.array(block == block.max()))
        numbers = lambda t: [t[c].to_numpy().astype(np.int64) for c in ("cid", "n", "pos", "w")]
        (ca, na, pa_, wa), (cb, nb, pb, wb) = numbers(left), numbers(right)
        best = np.minimum(pa_[:, None], pb) + np.minimum((na - pa_)[:, None], nb - pb)
        both = na[:, None] + nb
        may = (100 * np.minimum(na[:, None], nb) >= percent * np.maximum(na[:, None], nb)) & ((100 + percent) * best >= percent * both)
        before = _earlier(left["hot"], pa_)
        may &= common(*before, *(before if same else _earlier(right["hot"], pb))) == 0
        linked = np.zeros(may.shape, bool)
        x, y = np.flatnonzero(may.any(1)), np.flatnonzero(may.any(0))
        if len(x) and len(y):
            own = flat_sets(left["set"].take(pa.array(x)))
            n = common(*own, *(own if same else flat_sets(right["set"].take(pa.array(y)))))
            linked[np.ix_(x, y)] = 100 * n >= percent * (both[np.ix_(x, y)] - n)
            linked &= may
        if same:
            np.fill_diagonal(linked, False)
        ra, rb = roots(linked | np.eye(len(ca), dtype=bool) if same else linked)
        every = np.concatenate((ca, cb))
        parts = [(ca, every[ra], linked @ wb)]
        if not same:
            parts.append((cb, every[rb], wa @ linked))
        cid, root, links = (np.concatenate([p[i] for p in parts]) for i in range(3))
        return pa.table({"cid": cid[links > 0], "root": root[links > 0], "links": links[links > 0]})

    return rows.groupBy("key", "i", "j").applyInArrow(run, "cid long, root long, links long")


def similar_documents(docs: DataFrame, scratch: Scratch, k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, rid (see scratch.row_id), n_shingles, component_id, n_links for each row of ``docs`` (doc_id, text).

    A set holds the distinct k-word shingles of the whole text, A-Z lower-cased; fewer words make one shingle; a null text
    or one without words has an empty set and links to nothing. Rows link when 100 * intersection >= percent * union;
    component_id is the smallest doc_id reachable by links, itself included; n_links the number of rows that a row links
    with. Rows that share a doc_id are documents of their own; a row without a doc_id links to nothing and has a null
    component. Very long texts are hashed a piece at a time; equal counts in the order of shingles go by hash. Columns other
    than doc_id and text are ignored, whatever their names. No rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_id().alias("rid"), "text")
    records = scratch.save(doc_records(docs, k, percent, frequent_shingles(docs, k, scratch)))
    first = [F.first(c).alias(c) for c in ("n", "prefix", "sig")]
    one = records.where("n > 0 and doc_id is not null").groupBy("c1", "c2").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("w"), *first)
    classes = scratch.save(one.withColumn("cid", F.monotonically_increasing_id()))
    # prefixes and signatures are the classes' from now on
    records, wide = scratch.save(records.select("doc_id", "rid", "n", "c1", "c2")), records
    scratch.drop(wide)
    scratch.free_shuffles()
    held = shared_postings(classes, scratch)

    hot = held.where(F.col("c") > SMALL)
    hot_keys = scratch.save(hot.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("pos", "key"))).alias("hot")))
    small = held.where(F.col("c") <= SMALL).select("key", "cid", "n", "pos")
    near = small.alias("a").join(small.alias("b"), F.expr(f"a.key = b.key and a.cid < b.cid and {_may_overlap('a', 'b', percent)}")).select(F.col("a.cid").alias("a"), F.col("b.cid").alias("b"))
    marks = classes.select("cid", "n", "sig").join(sendable(hot_keys.select("cid", F.col("hot.key").alias("hot")), SEND_LISTS), "cid", "left")
    pairs = scratch.save(suffix_filter(near.distinct(), marks, percent))
    classes, wide = scratch.save(classes.select("cid", "c1", "c2", "doc_id", "w")), classes
    scratch.drop(wide)
    scratch.free_shuffles()

    use = lambda cids, paired: cids.select("cid", F.lit(paired).alias("paired"), F.lit(not paired).alias("dense"))
    wanted = use(pairs.select(F.explode(F.array("a", "b")).alias("cid")), True).union(use(hot_keys, False))
    wanted = wanted.groupBy("cid").agg(F.max("paired").alias("paired"), F.max("dense").alias("dense"))
    wanted = scratch.save(wanted.join(classes.select("cid", "c1", "c2", "doc_id"), "cid"))
    sets = class_sets(wanted, docs, k, scratch)
    links = scratch.save(verify(pairs, sets.where("paired"), percent))
    scratch.drop(pairs)
    # the classes of one shingle fall into blocks by hash; every pair of blocks is one comparison
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("int")
    places = scratch.save(hot.select("key", "cid", "n", "pos", blocks.alias("_n")).join(hot_keys, "cid").join(classes.select("cid", "w"), "cid"))
    rows = sets.where("dense").select("cid", "set").join(sendable(places, SEND_LISTS), "cid")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cid", "key"), F.col("_n")).cast("int")).withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    rows = rows.select("key", F.least("block", "_j").alias("i"), F.greatest("block", "_j").alias("j"), "block", "cid", "n", "pos", "w", "hot", "set")
    dense = scratch.save(compare_blocks(rows, percent))
    scratch.drop(held, hot_keys, places, sets, wanted)
    scratch.free_shuffles()

    edges = links.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(dense.where("cid <> root").select("cid", "root").distinct())
    comp = scratch.save(connected_components(edges, scratch).select(F.col("node").alias("cid"), F.col("component").alias("comp")))
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("cid"), F.col("b").alias("other")), F.struct(F.col("b").alias("cid"), F.col("a").alias("other")))).alias("e")).select("e.*")
    weight = classes.select(F.col("cid").alias("other"), "w")
    counts = ends.join(weight, "other").select("cid", F.col("w").alias("links")).union(dense.select("cid", "links")).groupBy("cid").agg(F.sum("links").alias("links"))
    group = classes.select("cid", "c1", "c2", "doc_id", "w").join(comp, "cid", "left").join(counts, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    low = group.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    by_class = group.join(low, "comp").select("c1", "c2", "component_id", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    own = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    out = records.select("doc_id", "rid", "n", *[F.when(own, F.col(c)).alias(c) for c in ("c1", "c2")]).join(by_class, ["c1", "c2"], "left")
    return out.select("doc_id", "rid", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def op4(spark, sf_dir: str) -> DataFrame:
    return similar_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), Scratch(spark)).drop("rid")
