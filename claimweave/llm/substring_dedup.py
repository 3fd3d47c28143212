"""Substring deduplication by level-wise doubling.

A repeated window of `length` words can only stand where windows of half, a quarter ... of that length
repeat. The levels go from a length of SHORTEST to 2 * SHORTEST words up to `length`, each twice the one
before (9, 18 and 35 words by default). At each level below the last every window that is still a
candidate picks the shorter window with the least hash inside it, and equal windows pick equal ones.
Those whose pick occurs once are dropped; a run of windows with one pick that repeats as a whole is
settled; the others are extended to twice the length, at the next level. The last level counts them one
by one. Where no candidate survives a level, nothing is sent to the next.

Words are maximal runs of bytes other than ASCII white space. A word goes if some window that covers
it occurs anywhere else too, in the same document or another. A null text counts as empty, and texts
shorter than a window keep all their words. Repeated rows count as further occurrences. An empty
table gives no rows. Other columns come back inside `row`, whatever their names are.

Windows are compared by hashes: 128 bits for a run and its pick (anchor), 96 for a single window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimweave.llm.blocks import Blocks, answered, buckets, packed, unpacked
from claimweave.llm.repeats import (
    ALL,
    SOME,
    WITNESS,
    Classes,
    ask_classes,
    covered,
    judge_classes,
    least_places,
    read_states,
)
from claimweave.llm.text import Rolling, Words, ragged, texts

LENGTH = 35
SHORTEST = 8
NOTE = 16  # kinds from here on are what a block notes for itself, one for each level done

_bytes, _words, _check = Rolling(11), Rolling(12), Rolling(13)


def levels(length: int) -> list[int]:
    """The lengths that are looked at, each at most twice the one before, `length` last."""
    found = [length]
    while found[0] > 1 and (len(found) < 2 or -(-found[0] // 2) >= SHORTEST):
        found.insert(0, -(-found[0] // 2))
    return found


class _View:
    """A block's words, the hashes of word sequences, and the windows that are still candidates.

    `starts` are the candidates and `sure` says which of them are known to repeat and stand for the
    repeats that were settled; `settled` are spans of words to remove.
    """

    def __init__(self, table: pa.Table, length: int):
        self.t = texts(table.column("text"))
        self.w = w = Words(self.t)
        word = _bytes.of(_bytes.sums(self.t.data), w.starts, w.ends)
        self.sums, self.checks = _words.sums_of(word), _check.sums_of(word)
        self.length = length
        starts = np.arange(len(w))
        self.starts = starts[starts + length <= np.repeat(w.first[1:], np.diff(w.first))]
        self.sure = np.zeros(len(self.starts), np.int64)
        self.settled = [(starts[:0], starts[:0])]

    def classes(self, short: int) -> Classes:
        """The candidates in classes by their picks of `short` words."""
        places = np.arange(max(len(self.w) - short + 1, 0))
        least = least_places(_words.of(self.sums, places, places + short), self.length - short + 1)
        picks = least[self.starts] if len(self.starts) else self.starts
        return Classes(self.starts, picks, self.sure)

    def hashed(self, short: int) -> Classes:
        c = self.classes(short)
        c.key = _words.of(self.sums, c.anchors[0], c.anchors[0] + short)
        c.span = _words.of(self.sums, c.first, c.last + self.length)
        return c

    def take(self, c: Classes, states: np.ndarray) -> None:
        """Settles the classes that repeat as a whole and keeps the candidates that are left."""
        whole = (states == ALL) | (states == WITNESS)
        self.settled.append((c.first[whole], c.last[whole] + self.length))
        picked = np.flatnonzero((states == SOME) | (states == WITNESS))
        size = c.last[picked] - c.first[picked] + 1
        self.starts = ragged(c.first[picked], size)
        # a witness stands for a span that occurs elsewhere too
        self.sure = np.repeat(np.maximum(c.anchors[1][picked], states[picked] == WITNESS), size)

    def replay(self, lengths: list[int], came: list) -> None:
        """Takes the states of the levels done so far from the block's own notes."""
        for level, short in enumerate(lengths):
            blobs = [blob for _, kind, blob in came if kind == NOTE + level]
            self.take(self.classes(short), np.frombuffer(blobs[0] if blobs else b"", np.uint8))

    def windows(self) -> tuple[np.ndarray, ...]:
        """The candidates' distinct hashes in order, whether each occurs more than once, and which each start has."""
        starts = self.starts
        key = _words.of(self.sums, starts, starts + self.length)
        check = (_check.of(self.checks, starts, starts + self.length) >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((check, key))
        k, x = key[order], check[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (x[1:] != x[:-1])
        group = np.cumsum(new) - 1
        back = np.empty(len(k), np.int64)
        back[order] = group
        many = np.bincount(group, minlength=int(new.sum())) > 1
        many |= np.bincount(group, self.sure[order], minlength=len(many)) > 0
        return k[new], x[new], many, back


def _judge_again(came: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
    """Answers about the classes of a level; a block's own notes go back to it."""
    yield from (x for x in came if x[1] >= NOTE)
    asked = [x for x in came if x[1] == 0]
    if asked:
        yield from judge_classes(asked)


def _judge_windows(came: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
    asked = [x for x in came if x[1] == 1]
    yield from (x for x in came if x[1] >= NOTE)
    if not asked:
        return
    parts = [unpacked(blob, "u8", "u4", "u1") for _, _, blob in asked]
    key, check, many = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.lexsort((check, key))
    k, x = key[order], check[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (x[1:] != x[:-1])
    group = np.cumsum(new) - 1
    twice = np.bincount(group, many[order].astype(np.int64) + 1)[group] > 1
    out = np.empty(len(k), np.uint8)
    out[order] = twice
    at = 0
    for (block, kind, _), p in zip(asked, parts, strict=True):
        yield block, kind, out[at : at + len(p[0])].tobytes()
        at += len(p[0])


def find(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """row (all columns but text), n_words, n_removed, spans of removed words, and the kept words.

    The kept words are joined by one space. spans: first word and the word after the last.
    """
    if length < 2:
        raise ValueError("a window needs two words or more")
    blocks = Blocks(docs)
    n = blocks.n

    *short, _ = levels(length)

    def noted(block: int, view: _View, done: int, came: list):
        """Replays the levels before the last one that was answered, takes its states, and notes all of them."""
        view.replay(short[: done - 1], came)
        c = view.hashed(short[done - 1])
        states = read_states(c, came)
        view.take(c, states)
        yield from ((block % n, kind, blob) for _, kind, blob in came if kind >= NOTE)
        yield block % n, NOTE + done - 1, states.tobytes()

    def ask(block: int, table: pa.Table):
        return ask_classes(_View(table, length).hashed(short[0]), n)

    def ask_level(level: int):
        def run(block: int, table: pa.Table, came: list):
            view = _View(table, length)
            yield from noted(block, view, level, came)
            yield from ask_classes(view.hashed(short[level]), n)

        return run

    def ask_windows(block: int, table: pa.Table, came: list):
        view = _View(table, length)
        yield from noted(block, view, len(short), came)
        key, check, many, _ = view.windows()
        owners, at = buckets(key, n)
        for i, owner in enumerate(owners.tolist()):
            run = slice(at[i], at[i + 1])
            yield owner, 1, packed(key[run], check[run], many[run].astype(np.uint8))

    def keep(table: pa.Table, came: list) -> pa.Table:
        view = _View(table, length)
        w, t = view.w, view.t
        view.replay(short, came)
        back = view.windows()[-1]
        got = np.frombuffer(b"".join(blob for _, kind, blob in came if kind == 1), np.uint8)
        again = view.starts[got[back] > 0]
        firsts, ends = zip(*view.settled, (again, again + length), strict=True)
        gone = covered(len(w), np.concatenate(firsts), np.concatenate(ends))
        raw = t.data.tobytes()
        begin, end, first = w.starts.tolist(), w.ends.tolist(), w.first.tolist()
        kept, spans = [], []
        for i in range(len(t)):
            mask = gone[first[i] : first[i + 1]]
            stays = (np.flatnonzero(~mask) + first[i]).tolist()
            kept.append(b" ".join([raw[begin[j] : end[j]] for j in stays]))
            edge = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
            spans.append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
        total = np.concatenate([[0], np.cumsum(gone)])[w.first]
        return pa.table(
            {
                "row": table.column("row"),
                "n_words": pa.array(np.diff(w.first), pa.int64()),
                "n_removed": pa.array(np.diff(total), pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    found = answered(blocks.ask(ask), judge_classes)
    for level in range(1, len(short)):
        found = answered(blocks.ask_again(found, ask_level(level)), _judge_again)
    found = answered(blocks.ask_again(found, ask_windows), _judge_windows)
    schema = (
        f"row {blocks.row_type}, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string"
    )
    return blocks.finish(found, keep, schema)
