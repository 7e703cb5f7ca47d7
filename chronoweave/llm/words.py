"""Words of whole texts as 64-bit hashes, a piece at a time.

A word is a run of ``[^\\x20\\x09-\\x0D]``; A-Z are lower-cased. Hashes are the same on every machine and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once, so that the arrays stay in a core's cache; a longer text is cut at white space.
CHUNK = 1 << 17
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.random.RandomState(7).randint(1, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64)
_powers: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least n."""
    if len(_powers.get("up", ())) < n:
        size = max(CHUNK + 1, n)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, b in (("up", BASE), ("down", inverse)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _piece(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    buf = np.frombuffer(blob, np.uint8)
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    up, down = _tables(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_VALUE[buf] * up[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts, ends


def hash_words(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word of a lower-cased UTF-8 text."""
    if len(blob) <= CHUNK:
        return _piece(blob)
    parts, at = [], 0
    while at < len(blob):
        end = min(len(blob), at + CHUNK)
        while end < len(blob) and not _SPACE[blob[end]]:
            end += 1
        h, s, e = _piece(blob[at:end])
        parts.append((h, s + at, e + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def chunks(texts: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """Yields (first row, word hashes, starts, ends, words before each row, joined text) for a few rows at once.

    Rows are joined by a line feed; a null text has no words.
    """
    blobs = [(b or b"").lower() for b in texts.cast(pa.binary()).to_pylist()]
    i = 0
    while i < len(blobs):
        j, size = i, 0
        while j < len(blobs) and (j == i or size + len(blobs[j]) < CHUNK):
            size += len(blobs[j]) + 1
            j += 1
        joined = b"\n".join(blobs[i:j])
        h, s, e = hash_words(joined)
        offsets = np.cumsum([0] + [len(b) + 1 for b in blobs[i:j]])
        yield i, h, s, e, np.searchsorted(s, offsets), joined
        i = j


_MULT = np.random.RandomState(11).randint(1, 2**62, 64, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word runs of one word sequence; fewer words than k count as one run, none as no run."""
    n = len(h)
    if n == 0:
        return h
    if n < k:
        out = np.array([n], np.uint64)
        for i in range(n):
            out = mix(out * _MULT[63] + h[i : i + 1])
        return out
    out = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        out += h[i : n - k + 1 + i] * _MULT[i]
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
