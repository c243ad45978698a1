"""Runs of bytes of given kinds (words, terms) in Arrow string buffers, with their places and hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tempoframe.llm import kernels

U = kernels.U
_PIECE = 1 << 21
_BYTES = np.arange(256)
#: Bytes of words: all but white space. Bytes of terms: ASCII letters and digits and all bytes of other characters.
WORDS = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
TERMS = (_BYTES >= 128) | np.isin(_BYTES, np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8))
_AS_IS, _FOLDED = _BYTES.astype(U) + U(1), np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(U) + U(1)


def runs(raw: np.ndarray, inside: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the maximal runs of ``inside`` bytes; ``fold`` takes A-Z as a-z.

    A long text is read in slices that end outside of runs.
    """
    parts, at, n = [], 0, len(raw)
    while at < n:
        end = min(n, at + _PIECE)
        while end < n:
            cut = np.flatnonzero(~inside[raw[at:end]])
            if len(cut):
                end = at + int(cut[-1]) + 1
                break
            end = min(n, end + _PIECE)
        start, stop, h = _slice(raw[at:end], inside, fold)
        parts.append((start + at, stop + at, h))
        at = end
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _slice(raw: np.ndarray, inside: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kept = np.concatenate(([False], inside[raw], [False]))
    edges = np.flatnonzero(kept[1:] != kept[:-1])
    start, end = edges[::2], edges[1::2]
    return start, end, kernels.spans((_FOLDED if fold else _AS_IS)[raw], start, end)


def texts(column: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text; a null text has none."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield raw[offsets[i] : offsets[i + 1]] if valid[i] else raw[:0]
