"""Toxicity by nearest labelled examples.

Examples are TF-IDF vectors over all features (words and word beginnings) that go with the label by a chi-square test on
the labelled sample; a block-max inverted index finds the exact nearest ones by cosine; their distance-weighted votes are
calibrated by leave-one-out isotonic regression. Document frequencies count every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .langid import held_out
from .scratch import Scratch
from .words import CHUNK, _SPACE, _VALUE, _tables, mix, signed

#: Labelled rows that the examples are drawn from at most (expected number, half of them toxic if there are enough).
FIT_ROWS = 6000
MIN_DOCS, MIN_CHI2, PURITY = 6, 12.0, 0.6
NEIGHBOURS, BLOCK, PRIOR = 15, 64, 0.5
PREFIXES = (4, 5, 6, 7, 8, 9, 10)
_PUNCT = np.zeros(256, bool)
_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature hashes of a whole text and how often each occurs: words without punctuation around them, and
    their first 4 to 10 bytes."""
    blob, parts, at = (text or "").lower().encode("utf-8", "replace"), [], 0
    while at < len(blob):
        end = min(len(blob), at + CHUNK)
        while end < len(blob) and not _SPACE[blob[end]]:
            end += 1
        parts += _word_features(np.frombuffer(blob[at:end], np.uint8))
        at = end
    return np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _word_features(buf: np.ndarray) -> list[np.ndarray]:
    out = _SPACE[buf] | _PUNCT[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], out, [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return []
    up, down = _tables(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_VALUE[buf] * up[: len(buf)], out=total[1:])
    found = [mix((total[ends] - total[starts]) * down[starts])]
    for p in PREFIXES:
        s = starts[ends - starts >= p]
        found.append(mix((total[s + p] - total[s]) * down[s] + np.uint64(p)))
    return found


class Index:
    """Labelled TF-IDF examples in blocks, postings by block and feature, and the largest weight of each block."""

    def __init__(self, vocabulary: np.ndarray, df: np.ndarray, n_docs: int, examples: list[tuple[int, int, float, np.ndarray, np.ndarray]]) -> None:
        """examples: (doc_id, toxic, weight, vocabulary positions, counts)."""
        self.vocabulary = vocabulary
        self.idf = np.log((n_docs + 1) / (df + 1)) + 0.1
        self.table = np.zeros(1 << 16, bool)
        self.table[(vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        kept = [(d, y, w, *self.weigh(f, c)) for d, y, w, f, c in examples if len(f)]
        empty = [(y, w) for _, y, w, f, _ in examples if not len(f)]
        kept.sort(key=lambda e: (int(e[3][np.argmax(e[4])]), e[0]))
        self.ids = np.array([e[0] for e in kept], np.int64)
        self.toxic = np.array([e[1] for e in kept], np.float64)
        self.weight = np.array([e[2] for e in kept], np.float64)
        blocks, n = -(-len(kept) // BLOCK), len(vocabulary)
        self.top = np.zeros((blocks, n), np.float32)
        self.postings: list[dict[int, tuple[np.ndarray, np.ndarray]]] = []
        for b in range(blocks):
            lists: dict[int, list[tuple[int, float]]] = {}
            for i, e in enumerate(kept[b * BLOCK : (b + 1) * BLOCK]):
                for f, v in zip(e[3], e[4], strict=True):
                    lists.setdefault(int(f), []).append((i, v))
            self.postings.append({f: (np.array([i for i, _ in x]), np.array([v for _, v in x])) for f, x in lists.items()})
            for f, (_, v) in self.postings[-1].items():
                self.top[b, f] = v.max() * (1 + 1e-6)
        total = sum(e[2] for e in examples) or 1.0
        self.prior = sum(y * w for _, y, w, *_ in examples) / total
        raw, truth, weight = [], [], []
        for e in kept:
            raw.append(self._vote(*self.search(e[3], e[4], skip=e[0])))
            truth.append(e[1])
            weight.append(e[2])
        self.knots = _isotonic(np.array(raw), np.array(truth, np.float64), np.array(weight))
        none = sum(w for _, w in empty)
        self.no_evidence = (sum(y * w for y, w in empty) + self.prior) / (none + 1.0)

    def weigh(self, f: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = (1 + np.log(c)) * self.idf[f]
        return f, v / np.sqrt((v * v).sum())

    def find(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vocabulary positions of the hashes that are in it, with their counts."""
        if not len(self.vocabulary):
            return np.zeros(0, np.int64), counts[:0]
        near = self.table[(hashes & np.uint64(0xFFFF)).astype(np.int64)]
        h, c = hashes[near], counts[near]
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        hit = self.vocabulary[at] == h
        return at[hit], c[hit]

    def search(self, f: np.ndarray, v: np.ndarray, skip: int | None = None, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Exact k nearest examples: blocks by falling upper bound, until no bound exceeds the k-th cosine."""
        bound = self.top[:, f] @ v
        best_s, best_i = np.zeros(0), np.zeros(0, np.int64)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(best_s) >= k and bound[b] < best_s[-1]):
                break
            s, lists = np.zeros(BLOCK), self.postings[b]
            for x, q in zip(f, v, strict=True):
                if (p := lists.get(int(x))) is not None:
                    s[p[0]] += q * p[1]
            at = np.flatnonzero(s > 0)
            i = at + b * BLOCK
            if skip is not None:
                at, i = at[self.ids[i] != skip], i[self.ids[i] != skip]
            best_s, best_i = np.concatenate((best_s, s[at])), np.concatenate((best_i, i))
            order = np.lexsort((self.ids[best_i], -best_s))[:k]
            best_s, best_i = best_s[order], best_i[order]
        return best_i, best_s

    def _vote(self, i: np.ndarray, s: np.ndarray) -> float:
        w = s**3 * self.weight[i] / self.weight.mean() if len(i) else s
        return float(((w * self.toxic[i]).sum() + PRIOR * self.prior) / (w.sum() + PRIOR))

    def score(self, text: str | None) -> tuple[float, list[dict]]:
        f, c = self.find(*features(text))
        if not len(f):
            return self.no_evidence, []
        i, s = self.search(*self.weigh(f, c))
        raw = self._vote(i, s)
        x, y = self.knots
        # a document's own vote breaks ties between equally calibrated scores
        calibrated = float(np.interp(raw, x, y)) if len(x) else raw
        return min(1.0, 0.98 * calibrated + 0.02 * raw), [{"doc_id": int(self.ids[j]), "cosine": float(v), "toxic": int(self.toxic[j])} for j, v in zip(i[:5], s[:5], strict=True)]


def _isotonic(raw: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the weighted isotonic regression of truth on raw."""
    blocks: list[list[float]] = []
    for j in np.argsort(raw, kind="stable"):
        blocks.append([truth[j] * weight[j], weight[j], raw[j], raw[j]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            y, w, _, hi = blocks.pop()
            blocks[-1] = [blocks[-1][0] + y, blocks[-1][1] + w, blocks[-1][2], hi]
    x = [v for b in blocks for v in (b[2], b[3])]
    y = [b[0] / b[1] for b in blocks for _ in range(2)]
    return np.array(x), np.array(y)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Index:
    """Examples from about ``rows`` labelled documents whose crc32(doc_id) mod 4 is not 2.

    Repeated labels of a document: toxic if one says so. Null labels and labels without a document are ignored; copies of
    a text give one example (its smallest id; toxic if one is). Without labels the index is empty and every score is the same.
    """
    scratch = Scratch(docs.sparkSession)
    train = labels.where("doc_id is not null and toxic is not null").where(~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    toxic = min(n.get(1, 0), rows // 2)
    share = {1: toxic / max(n.get(1, 0), 1), 0: min(1.0, (rows - toxic) / max(n.get(0, 0), 1))}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1_000_000)) < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]) * 1_000_000
    sample = train.where(draw).where("toxic in (0, 1)")
    both = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")  # at most about `rows` ids
    both = both.groupBy(F.coalesce("text", F.lit("")).alias("text")).agg(F.min(F.struct((-F.col("toxic")).alias("t"), "doc_id")).alias("s"))
    once = scratch.save(both.select("text", "s.doc_id", (-F.col("s.t")).alias("toxic")))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for y, t in zip(b["toxic"].to_pylist(), b["text"].to_pylist(), strict=True):
                h = signed(features(t)[0])
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(len(h), y, np.int32))], ["h", "toxic"])

    totals = once.groupBy("toxic").count().collect()
    n1, n0 = (next((r["count"] for r in totals if r["toxic"] == y), 0) for y in (1, 0))
    per = once.select("toxic", "text").mapInArrow(explode, "h long, toxic int").groupBy("h").agg(F.sum("toxic").cast("double").alias("a"), F.count("*").cast("double").alias("n")).where(F.col("n") >= MIN_DOCS)
    a, m, rest1, rest0 = F.col("a"), F.col("n"), F.lit(float(max(n1, 1))), F.lit(float(max(n0, 1)))
    # the toxic share among all labelled documents with the feature; the sample holds more toxic ones
    prior = n.get(1, 0) / max(n.get(1, 0) + n.get(0, 0), 1)
    of_toxic, of_clean = a / rest1 * prior, (m - a) / rest0 * (1 - prior)
    chi2 = (rest1 + rest0) * F.pow(a * (rest0 - (m - a)) - (m - a) * (rest1 - a), 2) / F.greatest(rest1 * rest0 * m * (rest1 + rest0 - m), F.lit(1.0))
    chosen = per.where(of_toxic >= PURITY * (of_toxic + of_clean)).select("h", chi2.alias("chi2")).where(F.col("chi2") >= MIN_CHI2).collect()
    vocabulary = np.sort(np.array([r["h"] for r in chosen], np.int64).view(np.uint64))
    probe = Index(vocabulary, np.ones(len(vocabulary)), 1, [])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_rows = np.zeros(len(vocabulary) + 1, np.int64), 0
        for b in batches:
            n_rows += b.num_rows
            for t in b["text"]:
                df[probe.find(*features(t.as_py()))[0]] += 1
        df[-1] = n_rows
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["f", "n"])

    df = np.zeros(len(vocabulary) + 1)
    for r in docs.select("text").mapInArrow(counted, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect():
        df[r["f"]] = r["n"]

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [probe.find(*features(t)) for t in b["text"].to_pylist()]
            lists = [pa.array([x[i].tolist() for x in got], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["toxic"], *lists], ["doc_id", "toxic", "f", "c"])

    rows_ = once.select("doc_id", "toxic", "text").mapInArrow(located, "doc_id long, toxic int, f array<long>, c array<long>").collect()
    scratch.drop(once)
    examples = [(r["doc_id"], r["toxic"], 1.0 / max(share[r["toxic"]], 1e-9), np.array(r["f"], np.int64), np.array(r["c"], np.float64)) for r in rows_]
    examples.sort(key=lambda e: e[0])
    return Index(vocabulary, df[:-1], int(df[-1]), examples)


def score_toxicity(docs: DataFrame, index: Index) -> DataFrame:
    """doc_id, score and evidence (up to five nearest examples) for each row of ``docs`` (doc_id, text).

    A null or empty text, or one without a feature of the index, scores the rate of such examples. Equal texts score
    equally, and equal cosines go by the smaller id; a very long text is read a piece at a time; repeated rows and null ids
    stay; other columns are ignored; no rows give no rows.
    """
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [index.score(t.as_py()) for t in b["text"]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([s for s, _ in got], pa.float64()), pa.array([e for _, e in got], evidence)], ["doc_id", "score", "evidence"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, evidence array<struct<doc_id:long,cosine:double,toxic:int>>")


THRESHOLD = 0.3


def op5(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = score_toxicity(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")


def keep_clean(docs: DataFrame, index: Index, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, all columns; one map, no shuffle.

    Null and empty texts score like texts without evidence; equal texts go or stay together; texts of any length are scored
    whole; columns pass whatever their names; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([index.score(t.as_py())[0] < threshold for t in b["text"]], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
