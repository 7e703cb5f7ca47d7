"""Order-dependent scans over one stream (applyInPandas, or packed Arrow batches): event detection, matching, peaks, greedy top-k, spectra.

Each group is one stream of one session, so a task holds minutes to hours of samples, never a corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def _schema(df: DataFrame, by: Sequence[str], more: str) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by) + ", " + more


def _keys(pdf: pd.DataFrame, by: Sequence[str], rows: pd.DataFrame) -> pd.DataFrame:
    for i, c in enumerate(by):
        rows.insert(i, c, [pdf[c].iloc[0]] * len(rows))
    return rows


def per_stream(df: DataFrame, by: Sequence[str], order: str, columns: Sequence[str], run: Callable[..., tuple], more: str) -> DataFrame:
    """One row a key: ``run`` of its columns as float arrays in ``order``. Keys reach Python packed, many in one Arrow batch, so
    a key costs no data frame of its own. ``more``: names and types (long, double, string) of what ``run`` returns."""
    by, names = list(by), [f"_{i}" for i in range(len(columns))]
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("_o"), *[F.col(c).cast("double").alias(n) for c, n in zip(columns, names, strict=True)])))
    packed = df.groupBy(*by).agg(rows.alias("_g")).select(*by, *[F.col(f"_g.{n}").alias(n) for n in names])
    out = [tuple(f.split()) for f in more.split(", ")]
    kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            ends = [b.column(n).offsets.to_numpy() for n in names]
            flat = [b.column(n).values.to_numpy(zero_copy_only=False) for n in names]
            got = [run(*[v[e[k] : e[k + 1]] for e, v in zip(ends, flat, strict=True)]) for k in range(b.num_rows)]
            cells = [pa.array([g[j] for g in got], kinds[kind]) for j, (_, kind) in enumerate(out)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in by], *cells], names=[*by, *[n for n, _ in out]])

    return packed.mapInArrow(batches, _schema(df, by, more))


def hysteresis_events(df: DataFrame, by: Sequence[str], time: str, value: str, high: float, low: float, min_gap: float) -> DataFrame:
    """Rising and falling events of a two-threshold switch; an event closer than ``min_gap`` to the one before is dropped."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values(time, kind="stable")
        on, last, out = None, -np.inf, []
        for t, v in zip(p[time].to_numpy(), p[value].to_numpy(float), strict=True):
            now = True if v >= high else False if v <= low else on
            if on is not None and now != on and t - last >= min_gap:
                out.append((t, "rise" if now else "fall"))
                last = t
            on = now
        return _keys(pdf, by, pd.DataFrame(out, columns=["t", "kind"]))

    return df.groupBy(*by).applyInPandas(run, _schema(df, by, "t double, kind string"))


def closures(df: DataFrame, by: Sequence[str], time: str, value: str, start: float = -30.0, stop: float = -5.0, least_drop: float = 5.0) -> DataFrame:
    """Closing moves: from a speed under ``start`` until it is over ``stop``, dropping by ``least_drop`` or more."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values(time, kind="stable")
        t, x = p[time].to_numpy(float), p[value].to_numpy(float)
        v = np.gradient(x, t) if len(t) > 1 else np.zeros(len(t))
        out, i = [], 0
        while i < len(t):
            if v[i] < start:
                j = i
                while j + 1 < len(t) and v[j + 1] <= stop:
                    j += 1
                if x[i] - x[j] >= least_drop:
                    out.append((t[i], t[j], x[i], x[j]))
                i = j
            i += 1
        return _keys(pdf, by, pd.DataFrame(out, columns=["start", "end", "from_value", "to_value"]))

    return df.groupBy(*by).applyInPandas(run, _schema(df, by, "start double, end double, from_value double, to_value double"))


def peak_positions(x: np.ndarray, height: float | None = None, distance: int = 1, prominence: float | None = None) -> np.ndarray:
    """Local maxima (middle of a plateau) by height, then highest first at least ``distance`` samples apart, then prominence."""
    first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, int)
    last, v = np.r_[first[1:], len(x)][: len(first)] - 1, x[first]
    up = np.flatnonzero((v[:-2] < v[1:-1]) & (v[2:] < v[1:-1])) + 1
    at = (first[up] + last[up]) // 2
    if height is not None:
        at = at[x[at] >= height]
    if distance > 1 and len(at):
        keep = np.ones(len(at), bool)
        for k in np.argsort(x[at], kind="stable")[::-1]:
            if keep[k]:
                near = np.abs(at - at[k]) < distance
                near[k] = False
                keep &= ~near
        at = at[keep]
    if prominence is not None:
        good = []
        for p in at:
            higher = np.flatnonzero(x[:p] > x[p])
            left = x[(higher[-1] if len(higher) else 0) : p + 1].min()
            higher = np.flatnonzero(x[p + 1 :] > x[p])
            right = x[p : (p + 1 + higher[0] if len(higher) else len(x))].min()
            good.append(x[p] - max(left, right) >= prominence)
        at = at[np.array(good, bool)] if len(at) else at
    return at


def peaks(df: DataFrame, by: Sequence[str], time: str, value: str, height_percentile: float | None = None, distance: int = 1, prominence: float | None = None) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values(time, kind="stable")
        x = p[value].to_numpy(float)
        at = peak_positions(x, np.percentile(x, height_percentile) if height_percentile is not None else None, distance, prominence)
        return _keys(pdf, by, pd.DataFrame({"t": p[time].to_numpy(float)[at], "height": x[at]}))

    return df.groupBy(*by).applyInPandas(run, _schema(df, by, "t double, height double"))


def greedy_match(pairs: DataFrame, by: Sequence[str], a: str, b: str) -> DataFrame:
    """One-to-one matches among candidate pairs: in the order of a, each takes the nearest b that is still free.

    Candidates come from ``asof.match_within``, so a group holds only pairs within the tolerance."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        used, done, out = set(), set(), []
        p = pdf.assign(_d=(pdf[a] - pdf[b]).abs()).sort_values([a, "_d", b], kind="stable")
        for x, y in zip(p[a], p[b], strict=True):
            if x not in done and y not in used:
                done.add(x)
                used.add(y)
                out.append((x, y))
        return _keys(pdf, by, pd.DataFrame(out, columns=["a", "b"]))

    return pairs.groupBy(*by).applyInPandas(run, _schema(pairs, by, "a double, b double"))


def greedy_topk(df: DataFrame, by: Sequence[str], time: str, score: str, k: int, radius: float) -> DataFrame:
    """The k best rows by score, none within ``radius`` of a better one; ties: the earlier."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[float, float]] = []
        for t, s in pdf.sort_values([score, time], ascending=[False, True], kind="stable")[[time, score]].itertuples(index=False):
            if len(out) < k and all(abs(t - u) > radius for u, _ in out):
                out.append((t, s))
        return _keys(pdf, by, pd.DataFrame(out, columns=["t", "score"]))

    return df.groupBy(*by).applyInPandas(run, _schema(df, by, "t double, score double"))


def savgol_kernel(size: int, degree: int, at: float = 0.0) -> np.ndarray:
    """Weights of the least-squares polynomial's value at offset ``at`` from the window's middle."""
    i = np.arange(size) - (size - 1) / 2
    return np.array([at**k for k in range(degree + 1)]) @ np.linalg.pinv(np.vander(i, degree + 1, increasing=True))


def savgol(df: DataFrame, by: Sequence[str], time: str, value: str, size: int = 11, degree: int = 2) -> DataFrame:
    """Savitzky-Golay smoothing; the ends take the polynomial of the first or last window; short streams stay as they are."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values(time, kind="stable")
        x = p[value].to_numpy(float)
        y = x.copy()
        if len(x) >= size:
            h = size // 2
            y[h : len(x) - h] = np.convolve(x, savgol_kernel(size, degree)[::-1], "valid")
            for k in range(h):
                y[k] = savgol_kernel(size, degree, k - h) @ x[:size]
                y[len(x) - 1 - k] = savgol_kernel(size, degree, h - k) @ x[-size:]
        return _keys(pdf, by, pd.DataFrame({"t": p[time].to_numpy(float), "smooth": y}))

    return df.groupBy(*by).applyInPandas(run, _schema(df, by, "t double, smooth double"))


def spectral_similarity(df: DataFrame, by: Sequence[str], order: str, a: str, b: str) -> DataFrame:
    """Correlation of the magnitudes of both signals' Fourier spectra without the constant; 0 for flat or short signals."""

    def run(*signals: np.ndarray) -> tuple:
        x, y = (np.abs(np.fft.rfft(s - s.mean()))[1:] for s in signals)
        ok = len(x) > 2 and x.std() > 1e-12 and y.std() > 1e-12
        return (max(0.0, float(np.corrcoef(x, y)[0, 1])) if ok else 0.0,)

    return per_stream(df, by, order, [a, b], run, "spectral double")


def alignment_report(df: DataFrame, by: Sequence[str], order: str, x: str, y: str, step_ms: float, max_lag_ms: float, lag_good: float = 20.0, lag_bad: float = 200.0) -> DataFrame:
    """Score 0-100 of two signals on one grid: best normalised lag correlation, zero-lag Pearson, spectral similarity,
    lag penalty, and a verdict. Fewer than 20 points or a flat signal: score 0, lag 999, verdict UNUSABLE."""

    def run(u: np.ndarray, v: np.ndarray) -> tuple:
        if len(u) < 20 or u.std() < 1e-8 or v.std() < 1e-8:
            return (len(u), 0.0, 999.0, 0.0, 0.0, 0.0, 0.0, "UNUSABLE")
        u, v = (u - u.mean()) / u.std(), (v - v.mean()) / v.std()
        k, n = min(int(max_lag_ms / step_ms), len(u) - 1), 1 << (2 * len(u) - 1).bit_length()
        c = np.fft.irfft(np.fft.rfft(v, n) * np.conj(np.fft.rfft(u, n)), n) / len(u)
        lags = np.arange(-k, k + 1)
        c = c[lags % n]
        at = int(np.argmax(c))
        lag = lags[at] * step_ms
        pearson = float((u * v).mean())
        a, b = (np.abs(np.fft.rfft(s))[1:] for s in (u, v))
        spectral = max(0.0, float(np.corrcoef(a, b)[0, 1])) if a.std() > 0 and b.std() > 0 else 0.0
        lag_score = float(np.clip((lag_bad - abs(lag)) / (lag_bad - lag_good), 0, 1))
        score = 100 * (0.4 * max(0.0, c[at]) + 0.25 * max(0.0, pearson) + 0.2 * lag_score + 0.15 * spectral)
        verdict = "GOOD" if score >= 75 else "FAIR" if score >= 50 else "POOR"
        return (len(u), float(score), float(lag), float(c[at]), pearson, spectral, lag_score, verdict)

    return per_stream(df, by, order, [x, y], run, "n long, score_100 double, lag_ms double, ncc double, pearson double, spectral double, lag_score double, verdict string")
