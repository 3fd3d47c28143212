"""Suffix-array deduplication by prefix-free parsing.

Triggers cut each text into phrases: a place is a trigger if its rolling hash over TRIGGER bytes is
the least of some WIDTH consecutive places. So no phrase is longer than WIDTH, whatever the text
looks like. A text's parse is the sequence of its phrases. Every window of `length` bytes is a part
of a phrase, a run of whole phrases between the first and the last trigger that the window itself
determines (its core), and a part of a phrase again. Equal windows have equal cores at equal places.

First the parse is brought into order, by its phrases' hashes: cores that occur once can't lie in a
repeat, and a class of windows (all with one core) whose whole span recurs is repeated as a whole.
What is left are the ends of repeats. For these the phrases around the core are sent as they are,
each distinct context once: this is the dictionary. Its suffixes are ranked by prefix doubling, the
ranks at two overlapping depths compare the parts of two windows around their cores, and together
with the core's place in the parse's order they put the windows into corpus order, where equal
windows are neighbours.

A byte goes if some window that covers it starts anywhere else too, in the same document or
another; windows never cross documents. A null text counts as empty, and texts shorter than a
window keep all their bytes. Repeated rows count as further occurrences. An empty table gives no
rows. Other columns come back inside `row`, whatever their names are.

Cores and spans are compared by hashes (128 bits for a span and its core), the dictionary by its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

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
from claimweave.llm.text import Rolling, mixed, ragged, texts, tidy

LENGTH = 400
TRIGGER = 8

_bytes, _parse = Rolling(21), Rolling(22)


def width_of(length: int) -> int:
    """The longest phrase: two fifths of a window, so that each window holds a core."""
    return max(1, (length - TRIGGER) * 2 // 5)


class _View:
    """A block's parse and the classes of its windows."""

    def __init__(self, table: pa.Table, length: int):
        self.t = t = texts(table.column("text"))
        self.length, width = length, width_of(length)
        n = len(t.data)
        sums = _bytes.sums(t.data)
        places = np.arange(max(n - TRIGGER + 1, 0))
        rolling = _bytes.of(sums, places, places + TRIGGER)
        least = least_places(rolling, width)
        room = np.maximum(np.diff(t.offsets) - length + 1, 0)
        starts = ragged(t.offsets[:-1], room)
        far = length - width - TRIGGER + 1
        self.c = c = Classes(starts, least[starts], least[starts + far])
        self.front, self.back = c.anchors[0], c.anchors[1] + TRIGGER
        triggers = np.unique(least)
        phrases = np.append(_bytes.of(sums, triggers[:-1], triggers[1:]), np.uint64(0)) if len(triggers) else rolling[:0]
        parse = _parse.sums_of(phrases)
        from_, to = np.searchsorted(triggers, c.anchors[0]), np.searchsorted(triggers, c.anchors[1])
        c.key = mixed(_parse.of(parse, from_, to) ^ rolling[c.anchors[1]])
        c.span = _bytes.of(sums, c.first, c.last + length)

    def dictionary(self, states: np.ndarray) -> tuple[np.ndarray, ...]:
        """The distinct unsettled classes and witnesses in the order of their keys, one of each; each class's."""
        key, _, _, back = self.c.distinct()
        one = np.empty(len(key), np.int64)
        one[back[::-1]] = np.arange(len(back))[::-1]
        state = states[one]
        open_ = (state == SOME) | (state == WITNESS)
        number = np.cumsum(open_) - 1
        number[~open_] = -1
        return one[open_], number[back]

    def contexts(self, picked: np.ndarray) -> tuple[np.ndarray, ...]:
        """For classes: bytes before the core, bytes after it, windows, core's length; then all the bytes."""
        c, data = self.c, self.t.data
        before = self.front[picked] - c.first[picked]
        after = c.last[picked] + self.length - self.back[picked]
        starts = np.stack([c.first[picked], self.back[picked]], 1).ravel()
        lengths = np.stack([before, after], 1).ravel()
        windows = c.last[picked] - c.first[picked] + 1
        core = self.back[picked] - self.front[picked]
        return before, after, windows, core, data[ragged(starts, lengths)]


def suffix_ranks(data: np.ndarray) -> Iterator[np.ndarray]:
    """The order of all suffixes by their first 1, 2, 4, ... bytes; beyond the end comes first."""
    rank = data.astype(np.int64) + 1
    size = 1
    while True:
        yield rank
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-size] = rank[size:]
        rank = np.unique((rank << 32) | ahead, return_inverse=True)[1].astype(np.int64) + 1
        size *= 2
        if size > len(data):
            return


def _judge_contexts(length: int):
    def judge(came: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
        yield from (x for x in came if x[1] == 0)
        asked = [x for x in came if x[1] == 1]
        if not asked:
            return
        heads, bodies = [], []
        for _, _, blob in asked:
            n = int.from_bytes(blob[:8], "little")
            heads.append(unpacked(blob[8 : 8 + 16 * n], "u8", "u2", "u2", "u2", "u2"))
            bodies.append(np.frombuffer(blob, np.uint8, offset=8 + 16 * n))
        key, before, after, windows, core = (np.concatenate([h[i] for h in heads]) for i in range(5))
        before, after, windows, core = (x.astype(np.int64) for x in (before, after, windows, core))
        data = np.concatenate(bodies)
        begin = np.cumsum(before + after) - before - after
        which = np.repeat(np.arange(len(key)), windows)
        shift = ragged(np.zeros(len(key), np.int64), windows)
        start, left, size = begin[which] + shift, before[which] - shift, (length - core)[which]
        head, tail = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        # a window's part around its core: two overlapping runs of the longest power of two that fits
        for level, rank in enumerate(suffix_ranks(data)):
            depth = 1 << level
            now = (size >= depth) & (size < 2 * depth)
            head[now], tail[now] = rank[start[now]], rank[start[now] + size[now] - depth]
            if depth * 2 > size.max(initial=0):
                break
        order = np.lexsort((tail, head, size, left, key[which]))
        same = np.ones(max(len(order) - 1, 0), bool)
        for x in (key[which], left, size, head, tail):
            same &= x[order][1:] == x[order][:-1]
        twice = np.zeros(len(order), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        at = 0
        for (block, kind, _), h in zip(asked, heads, strict=True):
            to = at + int(h[3].sum(dtype=np.int64))
            yield block, kind, np.packbits(twice[at:to]).tobytes()
            at = to

    return judge


def find(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """row (all columns but text), n_bytes, n_removed, spans of removed bytes, and the kept bytes."""
    if length < 4 * TRIGGER:
        raise ValueError(f"a window needs {4 * TRIGGER} bytes or more")
    if length > 60_000:
        raise ValueError("a window may have 60000 bytes at most")
    blocks = Blocks(docs)
    n = blocks.n

    def ask(block: int, table: pa.Table):
        return ask_classes(_View(table, length).c, n)

    def ask_contexts(block: int, table: pa.Table, came: list):
        view = _View(table, length)
        states = read_states(view.c, came)
        yield block % n, 0, states.tobytes()  # the block's own note, for the last step
        picked, _ = view.dictionary(states)
        before, after, windows, core, data = view.contexts(picked)
        ends = np.concatenate([[0], np.cumsum(before + after)])
        key = view.c.key[picked]
        owners, at = buckets(key, n)
        for i, owner in enumerate(owners.tolist()):
            run = slice(at[i], at[i + 1])
            head = packed(key[run], *(x[run].astype(np.uint16) for x in (before, after, windows, core)))
            count = int(at[i + 1] - at[i])
            yield owner, 1, count.to_bytes(8, "little") + head + data[ends[at[i]] : ends[at[i + 1]]].tobytes()

    def keep(table: pa.Table, came: list) -> pa.Table:
        view = _View(table, length)
        c, t = view.c, view.t
        states = np.frombuffer(next((blob for _, kind, blob in came if kind == 0), b""), np.uint8)
        picked, number = view.dictionary(states)
        size = c.last[picked] - c.first[picked] + 1
        owners, at = buckets(c.key[picked], n)
        bits = [np.zeros(0, bool)]
        got = [blob for _, kind, blob in came if kind == 1]
        for i, blob in enumerate(got):
            count = int(size[at[i] : at[i + 1]].sum())
            bits.append(np.unpackbits(np.frombuffer(blob, np.uint8), count=count).astype(bool))
        bits = np.concatenate(bits)
        begin = np.cumsum(size) - size
        open_ = np.flatnonzero(number >= 0)
        windows = size[number[open_]]
        starts = ragged(c.first[open_], windows)
        again = starts[bits[ragged(begin[number[open_]], windows)]]
        whole = np.flatnonzero((states == ALL) | (states == WITNESS))
        gone = covered(
            len(t.data),
            np.concatenate([c.first[whole], again]),
            np.concatenate([c.last[whole], again]) + length,
        )
        kept, spans = [], []
        bounds = t.offsets.tolist()
        for i in range(len(t)):
            mask = gone[bounds[i] : bounds[i + 1]]
            kept.append(t.data[bounds[i] : bounds[i + 1]][~mask].tobytes())
            edge = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
            spans.append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
        total = np.concatenate([[0], np.cumsum(gone)])[t.offsets]
        return pa.table(
            {
                "row": table.column("row"),
                "n_bytes": pa.array(np.diff(t.offsets), pa.int64()),
                "n_removed": pa.array(np.diff(total), pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    first = answered(blocks.ask(ask), judge_classes)
    second = answered(blocks.ask_again(first, ask_contexts), _judge_contexts(length))
    schema = (
        f"row {blocks.row_type}, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
    )
    return blocks.finish(second, keep, schema)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of `docs`, all columns, with the repeated bytes taken out of `text`.

    Where a removed run begins or ends inside a character, the rest of that character goes too. Rows
    stay, even if nothing of their text does; a null text becomes empty.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = pa.array([b.decode(errors="ignore") for b in batch.column("kept").to_pylist()], pa.string())
            yield pa.record_batch([batch.column("row"), kept], ["row", "kept"])

    found = find(docs, length)
    text = found.select("row", "kept").mapInArrow(tidy(decode), f"row {dict(found.dtypes)['row']}, kept string")
    columns = [F.col("kept").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return text.select(*columns)
