"""Vectorised word splitting and hashing of Arrow text columns.

A word is a maximal run of bytes outside space and 0x09-0x0D; these are
ASCII, so splitting UTF-8 bytes equals splitting code points. Words get a
64-bit hash (a polynomial over random byte values, taken from prefix sums
modulo 2**64), computed for a slice of documents at once.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLANKS = b" \t\n\x0b\x0c\r"
SLICE_BYTES = 1 << 21
SLICE_ROWS = 20_000
_M = 0x9E3779B97F4A7C15 | 1


def _state() -> dict:
    """Tables of this process. They hang on ``sys``, which is pickled by name,
    so they never travel with a job and outlive a worker's single task."""
    return sys.__dict__.setdefault("_blotter_textbatch", {})


def _tables() -> dict:
    """Byte tables, built once per process."""
    state = _state()
    if "blank" not in state:
        rng = np.random.default_rng(20240607)
        blank = np.zeros(256, bool)
        blank[list(BLANKS)] = True
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        value = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        state.update(blank=blank, lower=lower, value=value, low_value=value[lower])
    return state


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse modulo 2**64."""
    have = _state().get("powers")
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + (1 << 17))
        out = []
        for base in (_M, pow(_M, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _state()["powers"] = have = (out[0], out[1])
    return have


def release_memory() -> None:
    """Give freed memory back to the system, as an idle worker would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only where the C library has it
    if trim is not None:
        trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; spreads every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def packed(x: np.ndarray) -> bytes:
    """The bytes of ``x``, first bytes first, behind their number; compressed if
    that is shorter."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes()
    small = pa.compress(raw, codec="zstd", asbytes=True)
    return len(raw).to_bytes(4, "little") + (small if len(small) < len(raw) else raw)


def unpacked(data: pa.Buffer, kind: type) -> np.ndarray:
    size, rest = int.from_bytes(data[:4].to_pybytes(), "little"), data[4:]
    raw = np.frombuffer(rest if rest.size == size else pa.decompress(rest, size, codec="zstd"), np.uint8)
    return raw.reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


class Words:
    """Words of consecutive documents: hashes in text order and, for document
    i, the positions ``first[i]:first[i + 1]`` of its words."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray):
        self.hashes = hashes
        self.first = first

    def documents(self) -> np.ndarray:
        """The document number of every word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word windows and the documents' bounds in them."""
        h, first = self.hashes, self.first
        counts = np.maximum(np.diff(first) - (n - 1), 0)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        if len(h) < n or bounds[-1] == 0:
            return np.zeros(0, np.uint64), bounds
        m = len(h) - n + 1
        out = h[:m].copy()
        for k in range(1, n):
            out *= np.uint64(0xD6E8FEB86659FD93)
            out += h[k : k + m]
        keep = np.ones(m, bool)
        short = np.minimum(np.diff(first), n - 1)
        for k in range(1, n):  # the last n-1 words of a document start no window
            last = first[1:][short >= k] - k
            keep[last[last < m]] = False
        return mix(out[keep]), bounds


def text_slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into slices of about ``size`` bytes, SLICE_ROWS rows at most: yields (first
    row, end row, bytes, offsets of rows in them). Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, off_buf, data_buf = column.buffers()
    offsets = np.frombuffer(off_buf, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        end = min(max(end, at + 1), at + SLICE_ROWS, len(column))
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    """Words of the documents that ``offsets`` cuts out of ``data``."""
    t = _tables()
    if not len(data):
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    inside = ~t["blank"][data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begin[edges] = inside[edges]
    ends = offsets[1:][offsets[1:] > 0] - 1
    finish[ends] = inside[ends]
    starts, stops = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((t["low_value"] if lower else t["value"])[data] * power[: len(data)], out=sums[1:])
    hashes = mix((sums[stops] - sums[starts]) * inverse[starts] + (stops - starts).astype(np.uint64))
    return Words(hashes, np.searchsorted(starts, offsets))
