"""Vectorised kernels over Arrow string buffers: word hashes, shingle sets and one-permutation signatures.

Hashes are 64-bit polynomials in numpy's wrapping arithmetic, finished by an avalanche mix, and depend on the
text alone, so that retried tasks give the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 21
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of uint64 values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, _PIECE) + 1
        _powers["up"] = np.cumprod(np.concatenate(([U(1)], np.full(size, U(_BASE), dtype=U))), dtype=U)
        _powers["down"] = np.cumprod(np.concatenate(([U(1)], np.full(size, U(_INVERSE), dtype=U))), dtype=U)
    return _powers["up"], _powers["down"]


def _words(raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words in ``raw``; no word crosses a position in ``breaks``."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, U)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    upper = (raw >= 65) & (raw <= 90)
    low = np.where(upper, raw + 32, raw).astype(U) + U(1)
    first = ~space
    first[1:] &= space[:-1]
    last = ~space
    last[:-1] &= space[1:]
    inner = breaks[(breaks > 0) & (breaks < n)]
    first[inner] = ~space[inner]
    last[inner - 1] = ~space[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _tables(n)
    total = np.zeros(n + 1, U)
    np.cumsum(low * up[:n], out=total[1:])
    return start, mix((total[end] - total[start]) * down[start] + (end - start).astype(U))


def spans(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the stretches of ``codes`` (one for each byte, above 0) from ``start`` to ``end``."""
    up, down = _tables(len(codes))
    total = np.zeros(len(codes) + 1, U)
    np.cumsum(codes * up[: len(codes)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(U))


def _pieces(values: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about two million bytes together; a longer text is a run of its own."""
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _PIECE, "right")) - 1)
        yield a, b
        a = b


def _long_words(raw: np.ndarray) -> np.ndarray:
    """Word hashes of one text, in slices that end at white space."""
    out, a, n = [], 0, len(raw)
    while a < n:
        b = min(n, a + _PIECE)
        while b < n:
            tail = raw[a:b]
            cut = np.flatnonzero((tail == 32) | ((tail >= 9) & (tail <= 13)))
            if len(cut):
                b = a + int(cut[-1]) + 1
                break
            b = min(n, b + _PIECE)
        out.append(_words(raw[a:b], np.zeros(0, np.int64))[1])
        a = b
    return np.concatenate(out) if out else np.zeros(0, U)


def text_words(column: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes of each text of a string column, in order; a null text has none."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    for a, b in _pieces(raw, offsets):
        base, end = int(offsets[a]), int(offsets[b])
        if b == a + 1 and end - base > _PIECE:
            yield _long_words(raw[base:end])
            continue
        at = offsets[a : b + 1] - base
        start, hashes = _words(raw[base:end], at)
        cut = np.searchsorted(start, at)
        for i in range(b - a):
            yield hashes[cut[i] : cut[i + 1]]


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of ``k``-word shingles; fewer words make one shingle, none make none."""
    n = len(words)
    if not n:
        return words
    span = min(n, k)
    h = np.full(n - span + 1, U(span))
    for i in range(span):
        h = h * U(_BASE) + words[i : n - span + 1 + i]
    return np.unique(mix(h))


def fingerprint(values: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a sorted set of hashes."""
    import hashlib

    d = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


class OnePermutation:
    """One-permutation signatures with optimal densification, cut into bands.

    The top bits of a hash name its bin and a bin keeps its least hash. An empty bin takes the value of the first
    filled bin in its own fixed random order, the same order for all sets, so that every bin agrees with the
    probability of the sets' similarity.
    """

    def __init__(self, bands: int, rows: int) -> None:
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        if self.bins & (self.bins - 1):
            raise ValueError("bands * rows must be a power of two")
        self.shift = U(64 - (self.bins.bit_length() - 1))
        order = np.random.default_rng(20_240_607)
        self.order = np.stack([order.permutation(self.bins) for _ in range(self.bins)]).astype(np.int32)
        self.salt = mix(np.arange(1, bands + 1, dtype=U) * U(0xD1B54A32D192ED03))

    def keys(self, sets: list[np.ndarray]) -> np.ndarray:
        """Band keys (int64, one row a set); the sets are sorted and not empty."""
        d = len(sets)
        sig, filled = np.zeros((d, self.bins), U), np.zeros((d, self.bins), bool)
        for i, s in enumerate(sets):
            at = (s >> self.shift).astype(np.int64)
            lead = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
            sig[i, at[lead]] = s[lead]
            filled[i, at[lead]] = True
        row, col = np.nonzero(~filled)
        for t in range(24):
            if not len(row):
                break
            src = self.order[col, t]
            ok = filled[row, src]
            sig[row[ok], col[ok]] = sig[row[ok], src[ok]]
            row, col = row[~ok], col[~ok]
        for a in range(0, len(row), 2048):
            r, c = row[a : a + 2048], col[a : a + 2048]
            src = self.order[c]
            hit = src[np.arange(len(r)), filled[r[:, None], src].argmax(axis=1)]
            sig[r, c] = sig[r, hit]
        h = np.zeros((d, self.bands), U)
        for j in range(self.rows):
            h = h * U(_BASE) + sig[:, j :: self.rows]
        return mix(h + self.salt).view(np.int64)
