"""Language ID by error-correcting output codes.

Each language has a codeword; one linear classifier of hashed character n-grams (1 to 3) predicts each bit. Decoding
takes the codeword of least exponential loss, the bits weighted by their accuracy, and flags close calls. The fit uses a
bounded sample; prediction is one map over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

DIMS = 4096
#: Documents that the fit collects at most (expected number, spread evenly over the languages), as vectors of DIMS floats.
FIT_ROWS = 1600
RIDGE = 0.05
#: Characters turned into n-grams at once.
CHUNK = 1 << 20
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)], bool))
    return _letters[0]


def _grams(codes: np.ndarray) -> list[np.ndarray]:
    """Hashed 1-, 2- and 3-grams of code points, non-letters as single blanks."""
    letter = _letter_table()[codes]
    codes = np.where(letter, codes, 32).astype(np.uint32)
    codes = codes[letter | np.concatenate(([True], letter[:-1]))]
    m, out, h = np.uint32(2654435761), [], codes
    for k in range(3):
        if k:
            h = h[:-1] * np.uint32(31013) + codes[k:]
        out.append((h * m + np.uint32(k)) >> np.uint32(20))
    return out


def vector(text: str | None) -> np.ndarray | None:
    """Square roots of n-gram shares over the whole text, or None without a letter."""
    if not text:
        return None
    counts = np.zeros(DIMS, np.int64)
    for at in range(0, len(text), CHUNK):
        codes = np.frombuffer(text[at : at + CHUNK].lower().encode("utf-32-le", "replace"), np.uint32)
        if _letter_table()[codes].any():
            for g in _grams(codes):
                counts += np.bincount(g, minlength=DIMS)
    total = counts.sum()
    return np.sqrt(counts / total).astype(np.float32) if total else None


def codewords(k: int, seed: int = 5) -> np.ndarray:
    """k codewords of +-1: all distinct splits up to six languages, else the random code with the largest least distance."""
    if k <= 6:
        return np.array([[1 if i == 0 or (s >> (i - 1)) & 1 else -1 for s in range(max(0, 2 ** (k - 1) - 1))] for i in range(k)], np.int8).reshape(k, max(0, 2 ** max(k - 1, 0) - 1))
    rng, best = np.random.RandomState(seed), None
    size = int(np.ceil(10 * np.log2(k)))
    for _ in range(50):
        c = rng.choice(np.array([-1, 1], np.int8), (k, size))
        d = (size - c.astype(int) @ c.T.astype(int)) // 2 + size * np.eye(k, dtype=int)
        if best is None or d.min() > best[0]:
            best = (d.min(), c)
    return best[1]


class Model:
    """Languages, codewords, bit weights and the linear classifiers."""

    def __init__(self, x: np.ndarray, langs: list[str]) -> None:
        self.langs = sorted(set(langs))
        y = np.array([self.langs.index(g) for g in langs], np.int64)
        self.code = codewords(len(self.langs))
        share = np.bincount(y, minlength=len(self.langs))
        w = (1.0 / share[y] / len(self.langs) * len(y)) if len(y) else np.zeros(0)
        self.mean = x.mean(0) if len(x) else np.zeros(DIMS, np.float32)
        xc, bits = x - self.mean, self.code[y].astype(np.float64) if len(y) else np.zeros((0, self.code.shape[1]))
        gram = (xc @ xc.T).astype(np.float64) + 1.0
        alpha = np.linalg.solve(gram + RIDGE * np.diag(1.0 / np.maximum(w, 1e-9)), bits) if len(y) else bits
        self.weights = (xc.T @ alpha).astype(np.float32)
        self.bias = alpha.sum(0)
        right = (np.sign(gram @ alpha) == bits).mean(0) if len(y) else np.zeros(0)
        self.bit_weight = np.clip(2 * right - 1, 0.05, 1)

    def predict(self, x: np.ndarray, margin: float = 0.2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, its probability, and whether the runner-up is within ``margin``."""
        f = (x - self.mean) @ self.weights + self.bias
        loss = (np.exp(-3 * f[:, None, :] * self.code[None]) * self.bit_weight).sum(2) / max(self.bit_weight.sum(), 1e-9)
        z = -4 * np.log(loss + 1e-9)
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        top = np.sort(p, 1)
        close = top[:, -1] - top[:, -2] < margin if p.shape[1] > 1 else np.zeros(len(p), bool)
        return p.argmax(1), p.max(1), close


def held_out():
    return F.coalesce(F.expr("crc32(encode(cast(doc_id as string), 'UTF-8')) % 4 = 2"), F.lit(False))


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Fits on about ``rows`` documents whose crc32(doc_id) mod 4 is not 2 and whose lang is not null, evenly by language."""
    train = docs.where(F.expr("crc32(encode(cast(doc_id as string), 'UTF-8')) % 4 <> 2 and lang is not null"))
    counts = {r["lang"]: r["count"] for r in train.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(rows).collect()}
    if not counts:
        return Model(np.zeros((0, DIMS), np.float32), [])
    each = rows / len(counts)
    share = F.create_map(*[x for g, n in counts.items() for x in (F.lit(g), F.lit(min(1.0, each / n)))])
    sample = train.where(F.pmod(F.xxhash64("doc_id", F.lit(42)), F.lit(1_000_000)) < 1_000_000 * share[F.col("lang")]).select("lang", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(g, v.tobytes()) for g, t in zip(b["lang"].to_pylist(), b["text"].to_pylist(), strict=True) if (v := vector(t)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in got], pa.string()), pa.array([v for _, v in got], pa.binary())], ["lang", "v"])

    got = sample.mapInArrow(vectors, "lang string, v binary").toArrow()
    order = sorted(zip(got["lang"].to_pylist(), got["v"].to_pylist(), strict=True))
    x = np.frombuffer(b"".join(v for _, v in order), np.float32).reshape(-1, DIMS)
    return Model(x, [g for g, _ in order])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous for each row of ``docs`` (doc_id, text).

    ``und`` with score 0 if the text is null, empty or has no letter, or if nothing was learned. Equal texts get equal
    results; repeated rows and null ids stay; other columns are ignored. Texts of any length are read whole, a piece at a
    time; of languages with equal losses the first by name is taken and the row is ambiguous; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vs = [vector(t.as_py()) if model.langs else None for t in b["text"]]
            lang, score, close = ["und"] * len(vs), np.zeros(len(vs)), np.zeros(len(vs), bool)
            at = [i for i, v in enumerate(vs) if v is not None]
            for k in range(0, len(at), 256):
                own = at[k : k + 256]
                i, p, c = model.predict(np.stack([vs[j] for j in own]))
                score[own], close[own] = p, c
                for j, g in zip(own, i, strict=True):
                    lang[j] = model.langs[g]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(lang), pa.array(score), pa.array(close)], ["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def op6(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = identify(docs, fit(docs))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
