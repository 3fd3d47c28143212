"""Windows of one length that occur more than once, found by way of anchors.

All windows of a text with the same anchor form a class: consecutive starts whose windows share one
stretch of text that their own content picks (the place of the least hash in the window's first,
and for two-ended anchors also its last, part). Equal windows have equal anchors at equal offsets.
So a class whose anchor's text occurs nowhere else holds no repeated window; a class whose whole
span occurs elsewhere holds only repeated ones. What is left is looked at window by window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from claimweave.llm.blocks import buckets, packed, unpacked

NONE, SOME, ALL, WITNESS = 0, 1, 2, 3  # what is known of a class's windows; a witness is ALL and compared to SOME


def least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each start, the place of the least (the first of equal) hash among `width` from there on."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.int64)
    rows = -(-n // width)
    v = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    v[:n] = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    grid = v.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


class Classes:
    """first and last start of each class, and the hashes of its anchor (key) and span."""

    def __init__(self, starts: np.ndarray, *anchors: np.ndarray):
        new = np.ones(len(starts), bool)
        new[1:] = starts[1:] != starts[:-1] + 1
        for a in anchors:
            new[1:] |= a[1:] != a[:-1]
        at = np.flatnonzero(new)
        self.first = starts[at]
        self.last = starts[np.append(at[1:], len(starts)) - 1] if len(at) else starts[:0]
        self.anchors = [a[at] for a in anchors]
        self.key = self.span = np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.first)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (key, span) in the order of keys, whether each occurs here more than once, and each class's."""
        order = np.lexsort((self.span, self.key))
        key, span = self.key[order], self.span[order]
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]) | (span[1:] != span[:-1])
        group = np.cumsum(new) - 1
        back = np.empty(len(order), np.int64)
        back[order] = group
        many = np.bincount(group, minlength=int(new.sum())) > 1
        return key[new], span[new], many, back


def ask_classes(c: Classes, n_buckets: int) -> Iterator[tuple[int, int, bytes]]:
    key, span, many, _ = c.distinct()
    owners, at = buckets(key, n_buckets)
    for i, owner in enumerate(owners.tolist()):
        run = slice(at[i], at[i + 1])
        yield owner, 0, packed(key[run], span[run], many[run].astype(np.uint8))


def judge_classes(came: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
    """What a bucket answers: one of NONE, SOME, ALL, WITNESS for each (key, span) of each block."""
    parts = [unpacked(blob, "u8", "u8", "u1") for _, _, blob in came]
    sizes = [len(p[0]) for p in parts]
    key, span, many = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.lexsort((span, key))
    k, s, m = key[order], span[order], many[order].astype(np.int64) + 1
    new_key = np.ones(len(k), bool)
    new_key[1:] = k[1:] != k[:-1]
    new_span = new_key.copy()
    new_span[1:] |= s[1:] != s[:-1]
    of_key, of_span = np.cumsum(new_key) - 1, np.cumsum(new_span) - 1
    whole = np.bincount(of_span, m)[of_span] > 1
    known = np.bincount(of_key, m)[of_key] > 1
    state = np.where(whole, ALL, np.where(known, SOME, NONE))
    open_ = np.bincount(of_key, state == SOME)[of_key] > 0
    state = np.where(whole & open_ & new_span, WITNESS, state).astype(np.uint8)
    out = np.empty(len(k), np.uint8)
    out[order] = state
    at = 0
    for (block, kind, _), size in zip(came, sizes, strict=True):
        yield block, kind, out[at : at + size].tobytes()
        at += size


def read_states(c: Classes, came: list[tuple[int, int, bytes]]) -> np.ndarray:
    """Each class's state from a block's answers, which come in the order of the keys."""
    _, _, _, back = c.distinct()
    got = np.frombuffer(b"".join(blob for _, kind, blob in came if kind == 0), np.uint8)
    return got[back]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the given spans."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step)[:n] > 0
