"""Exact intersections of many sets at once, as arrays of one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Columns of one dense product, and pairs counted one by one at a time.
COLUMNS, PAIRS = 4096, 1 << 20
#: A value that stands in so small a share of all pairs of sets is cheaper to count pair by pair.
SPARSE = 200


def flat_sets(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values of all sets, size of each) of a binary column of int64 values."""
    parts = [(b"" if x is None else x) for x in column.to_pylist()]
    return np.frombuffer(b"".join(parts), np.int64), np.array([len(x) // 8 for x in parts], np.int64)


def rows_of(sizes: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(sizes)), sizes)


def common(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Matrix of intersection sizes of the sets (a, na) with the sets (b, nb); a set's values are distinct.

    Values of few pairs are counted pair by pair, the others by products of 0/1 matrices, COLUMNS values at a time. Values of
    one side alone go first, and places are 32-bit numbers, as the arrays may fill a task's memory.
    """
    out = np.zeros((len(na), len(nb)), np.float32)
    if not len(a) or not len(b):
        return out.astype(np.int64)
    x, y, n = _numbered(a, b)
    rx, ry = rows_of(na).astype(np.int32), rows_of(nb).astype(np.int32)
    rx, x = rx[x >= 0], x[x >= 0]
    ry, y = (rx, x) if b is a else (ry[y >= 0], y[y >= 0])
    cx, cy = np.bincount(x, minlength=n), np.bincount(y, minlength=n)
    pairs = cx * cy
    dense = pairs * SPARSE > out.size
    few = np.flatnonzero(~dense)
    if len(few):
        # the rows of each value, one value after the other
        ox, oy = rx[np.argsort(x, kind="stable")], ry[np.argsort(y, kind="stable")]
        sx, sy = np.cumsum(cx) - cx, np.cumsum(cy) - cy
        ends = np.cumsum(pairs[few])
        first = 0
        while first < len(few):
            upto = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PAIRS, "right")))
            v = few[first:upto]
            n_v = pairs[v]
            k = np.arange(n_v.sum(), dtype=np.int32) - np.repeat((np.cumsum(n_v) - n_v).astype(np.int32), n_v)
            w = np.repeat(cy[v].astype(np.int32), n_v)
            at = ox[np.repeat(sx[v].astype(np.int32), n_v) + k // w].astype(np.int64) * len(nb)
            at += oy[np.repeat(sy[v].astype(np.int32), n_v) + k % w]
            out += np.bincount(at, minlength=out.size).reshape(out.shape)
            first = upto
    column = np.cumsum(dense) - 1
    kx, ky = dense[x], dense[y]
    rx, x, ry, y = rx[kx], column[x[kx]], ry[ky], column[y[ky]]
    for lo in range(0, int(dense.sum()), COLUMNS):
        p, q = np.zeros((len(na), COLUMNS), np.float32), np.zeros((len(nb), COLUMNS), np.float32)
        own, other = (x >= lo) & (x < lo + COLUMNS), (y >= lo) & (y < lo + COLUMNS)
        p[rx[own], x[own] - lo] = 1
        q[ry[other], y[other] - lo] = 1
        out += p @ q.T
    return out.astype(np.int64)


def _numbered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers of the values that stand in both, for each place of a and of b (-1: in one alone), and how many there are."""
    values = np.unique(a)
    if b is not a:
        values = values[np.isin(values, b)]
    number = lambda x: np.searchsorted(values, x).astype(np.int32)
    x = number(a)
    if b is a:
        return x, x, len(values)
    y, last = number(b), max(len(values) - 1, 0)
    if not len(values):
        return np.full(len(a), -1, np.int32), np.full(len(b), -1, np.int32), 0
    x[values[np.minimum(x, last)] != a] = -1
    y[values[np.minimum(y, last)] != b] = -1
    return x, y, len(values)


def roots(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest number of the connected nodes for each row and each column of a matrix of links; rows are numbered first,
    then columns, and a node without a link has its own number. If both sides are the same sets, the diagonal must be set."""
    n, m = linked.shape
    rows, columns, none = np.arange(n), np.arange(n, n + m), n + m
    while True:
        low = np.minimum(columns, np.where(linked, rows[:, None], none).min(0, initial=none))
        new = np.minimum(rows, np.where(linked, low[None, :], none).min(1, initial=none))
        if (low == columns).all() and (new == rows).all():
            return rows, columns
        rows, columns = new, low
