"""Texts as byte arrays: words, substring hashes and per-word tables, for whole batches at once.

The functions here run inside Spark tasks. They work on a few megabytes of text at a time, so
that their memory doesn't depend on the size of a partition.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 21  # bytes of text handled at once; a longer document is handled alone
SIDE = 1 << 11  # powers in each of a hash's tables

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Texts:
    """Some documents' texts: their bytes one after another, and where each begins."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def of(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def tidy(run: Callable) -> Callable:
    """`run`, a generator for mapInArrow, which gives memory back to the system when it ends.

    Python workers live on from task to task, and an executor has several.
    """

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def release() -> None:
    """Gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def texts(column: pa.Array | pa.ChunkedArray) -> Texts:
    """A column of strings or binaries without copying; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(offsets):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def pieces(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The rows of a batch in runs of about PIECE bytes, with their texts."""
    every = texts(batch.column(name))
    at = 0
    while at < len(every):
        to = int(np.searchsorted(every.offsets, every.offsets[at] + PIECE, "right")) - 1
        to = min(max(to, at + 1), len(every))
        offsets = every.offsets[at : to + 1]
        yield batch.slice(at, to - at), Texts(every.data[offsets[0] : offsets[-1]], offsets - offsets[0])
        at = to


class Words:
    """Maximal runs of bytes other than white space, or of a given set: starts, ends, each document's first."""

    def __init__(self, t: Texts, letters: np.ndarray | None = None):
        ink = ~SPACE[t.data] if letters is None else letters[t.data]
        edge = np.zeros(len(ink) + 1, bool)
        edge[t.offsets] = True
        opens = ink.copy()
        opens[1:] &= ~ink[:-1] | edge[1:-1]
        closes = ink
        closes[:-1] &= ~ink[1:] | edge[1:-1]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, t.offsets)

    def __len__(self) -> int:
        return len(self.starts)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Rolling:
    """A polynomial hash modulo 2**64 with a random value for each byte.

    `sums` makes prefix sums; `of` then hashes any substring in constant time. Equal
    substrings have equal hashes wherever they stand. Powers of the base are products of two from short
    tables, so that nothing long is kept between calls.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + rng.integers(0, 2, 256, np.uint64)
        self.base = int(rng.integers(1 << 40, 1 << 60)) * 8 + 5
        self.low, self.high = _powers(self.base, SIDE), pow(self.base, SIDE, 1 << 64)
        inverse = pow(self.base, -1, 1 << 64)
        self.low_inverse, self.high_inverse = _powers(inverse, SIDE), pow(inverse, SIDE, 1 << 64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        return self.sums_of(self.values[data])

    def sums_of(self, values: np.ndarray) -> np.ndarray:
        """The same for a sequence of 64-bit numbers instead of bytes."""
        n = len(values)
        powers = np.multiply.outer(_powers(self.high, -(-n // SIDE)), self.low).ravel()[:n]
        powers *= values
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(powers, out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        high = _powers(self.high_inverse, len(sums) // SIDE + 1)
        inverse = high[starts // SIDE] * self.low_inverse[starts % SIDE]
        return mixed((sums[ends] - sums[starts]) * inverse + (ends - starts).astype(np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[0], starts[0]+1, ... of each run, run after run."""
    total = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=total[1:])
    return np.arange(total[-1]) + np.repeat(starts - total[:-1], lengths)


class Memory:
    """For each distinct key, an array that is expensive to make; kept from batch to batch.

    `make` gets some distinct substrings and gives their values, one after another, and the length
    of each. Values lie one after another in `pool`. It is emptied when it holds more than `most` keys,
    so its memory is bounded; nothing but time depends on what it holds.
    """

    def __init__(self, make: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], dtype, most: int = 1_000_000):
        self.make, self.dtype, self.most = make, dtype, most
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros((0, 2), np.int64)
        self.pool = np.zeros(0, self.dtype)

    def look_up(self, t: Texts, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in `pool` the value of each substring begins, and its length."""
        own, first, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > self.most:
            self._clear()
        place = np.searchsorted(self.keys, own)
        known = np.zeros(len(own), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == own[inside]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            raw = t.data.tobytes()
            at = first[fresh]
            made, lengths = self.make([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            begin = len(self.pool) + np.cumsum(lengths) - lengths
            self.pool = np.concatenate([self.pool, made.astype(self.dtype, copy=False)])
            keys_, at_ = np.concatenate([self.keys, own[fresh]]), np.concatenate([self.at, np.stack([begin, lengths], 1)])
            order = np.argsort(keys_, kind="stable")
            self.keys, self.at = keys_[order], at_[order]
            place = np.searchsorted(self.keys, own)
        found = self.at[place][back]
        return found[:, 0], found[:, 1]
