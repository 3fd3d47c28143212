"""Benchmark decontamination with suffix arrays of the training documents.

Words are maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. A task
holds a shard of the documents, some megabytes of text, as one sequence of word numbers and orders
its suffixes (`suffix_array`). Every suffix of every benchmark item is searched for in it by binary
search, word after word (`search`): where the interval of the array runs empty, its longest verbatim
match ends, and the interval before holds the places of that match. A window is `window` consecutive
words of an item; an item of fewer words, but not none, is one window. Where an interval outlasts a
window, its places are occurrences of the window.

Documents are not shuffled. Words that no item has become the number 0, which ends every suffix
before it, so only suffixes of words that the items share are ordered, by as many words as the longest
item has. Items are sent to the tasks in blocks of at most `BLOCK` bytes (one longer item is a block of
its own); where there are several, the documents pass them one after another.

Words are told apart by 64-bit hashes. A null text has no words. An item without words has no window.
Repeated items count once. An item without an id marks words, but no list of items names it. Documents
may repeat and lack ids: every row gives a row. Empty tables are fine: without items nothing is hit.
Other columns of the documents, whatever their names, are kept in `row`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.blocks import schema_of
from claimweave.llm.shared import stored
from claimweave.llm.text import LOWER, Rolling, Texts, Words, pieces, ragged, texts, tidy

WINDOW = 10
BLOCK = 1 << 22

LETTERS = np.zeros(256, bool)
LETTERS[48:58] = LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True

_words = Rolling(41)


def word_hashes(t: Texts) -> tuple[Words, np.ndarray]:
    """The words of some texts and a hash of each."""
    lower = Texts(LOWER[t.data], t.offsets)
    w = Words(lower, LETTERS)
    return w, _words.of(_words.sums(lower.data), w.starts, w.ends)


def numbered(w: Words, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents' word numbers, one document after another with a 0 behind each, and the first place of each."""
    n = np.diff(w.first)
    first = w.first[:-1] + np.arange(len(n))
    out = np.zeros(len(ids) + len(n) + 1, np.int64)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
    return out, first


class Items:
    """Some benchmark items: their words as numbers from 1, all suffixes, and the distinct windows."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        column = pa.array([text for _, text in items], pa.string())
        w, hashes = word_hashes(texts(column))
        self.names = [None if name is None else str(name) for name, _ in items]
        self.vocabulary, number = np.unique(hashes, return_inverse=True)
        self.ids, first = numbered(w, number + 1)
        n = np.diff(w.first)
        self.longest = int(n.max(initial=0))
        self.item = np.repeat(np.arange(len(n)), n)
        self.starts = ragged(first, n)  # of each suffix
        self.offset = ragged(np.zeros(len(n), np.int64), n)
        self.left = np.repeat(n, n) - self.offset
        size = np.minimum(window, np.repeat(n, n))
        own = np.flatnonzero(self.left >= size)  # the suffixes that begin with a window
        self.size = np.where(self.left >= size, size, 0)
        self.window = np.full(len(size), -1)
        if len(own):
            columns = np.arange(int(size.max()))
            words = np.where(columns < size[own, None], self.ids[np.minimum(self.starts[own, None] + columns, len(self.ids) - 1)], 0)
            _, one, which = np.unique(words, axis=0, return_index=True, return_inverse=True)
            self.window[own] = which.ravel()
            self.stands = own[one]  # a suffix for each window
        else:
            self.stands = own
        owners = np.unique(np.stack([self.window[own], self.item[own]], 1), axis=0)
        self.owners = owners[:, 1]
        self.owned = np.searchsorted(owners[:, 0], np.arange(len(self.stands) + 1))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of words, 0 for those that no item has."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[place] == hashes, place + 1, 0)

    def items_of(self, windows: np.ndarray) -> list[str]:
        """Ids of the items that have some of the windows, sorted as strings."""
        places = ragged(self.owned[windows], self.owned[windows + 1] - self.owned[windows])
        found = (self.names[i] for i in np.unique(self.owners[places]).tolist())
        return sorted({x for x in found if x is not None})


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of numbers other than 0, ordered by what follows up to the next 0, `depth` numbers at least.

    Prefix doubling: suffixes that agree in `step` numbers are ordered by the rank of what follows
    those. Only suffixes that still agree, and whose run of numbers goes on, are ordered again.
    """
    n = len(ids)
    zeros = np.append(np.flatnonzero(ids == 0), n)
    runs = np.diff(zeros, prepend=-1)
    reach = (np.repeat(zeros, runs)[:n] - np.arange(n)).astype(np.int64)
    order = np.flatnonzero(ids)
    order = order[np.argsort(ids[order], kind="stable")]
    rank = np.zeros(n + 1, np.int64)
    key = ids[order]
    todo, step = np.arange(len(order)), 1
    while True:
        # `todo` are slots of `order` in rising order, `key` what tells their suffixes apart
        new = np.ones(len(todo), bool)
        new[1:] = key[1:] != key[:-1]
        head = np.maximum.accumulate(np.where(new, np.arange(len(todo)), 0))
        rank[order[todo]] = todo[head] + 1
        if step >= depth or not len(todo):
            return order
        many = np.bincount(head, minlength=len(todo))[head] > 1
        # those of a group whose run ends sooner all end at the same place and are equal
        todo = todo[many & (reach[order[todo]] >= step)]
        group = rank[order[todo]]
        key = group * (n + 2) + rank[order[todo] + step]
        again = np.argsort(key, kind="stable")
        order[todo], key = order[todo][again], key[again]
        step *= 2


def search(ids: np.ndarray, order: np.ndarray, tests: Items) -> tuple[np.ndarray, ...]:
    """For each test suffix the length of its longest match and the interval of `order` that has it; for
    each window the interval of its occurrences. Intervals are firsts and ends."""
    n = len(tests.starts)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    window_lo, window_hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
    length, alive, depth = np.zeros(n, np.int64), np.arange(n), 0
    while len(alive) and len(order):
        word = tests.ids[tests.starts[alive] + depth]
        a = _bound(ids, order, depth, lo[alive], hi[alive], word, False)
        b = _bound(ids, order, depth, a, hi[alive], word, True)
        on = (a < b) & (word > 0)
        alive, depth = alive[on], depth + 1
        lo[alive], hi[alive], length[alive] = a[on], b[on], depth
        whole = alive[tests.size[alive] == depth]
        window_lo[whole], window_hi[whole] = lo[whole], hi[whole]
    return length, lo, hi, window_lo[tests.stands], window_hi[tests.stands]


def _bound(ids, order, depth, lo, hi, word, after: bool) -> np.ndarray:
    """The first slot from lo to hi whose suffix has, at `depth`, no less than `word` (or more, if `after`)."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = np.where(open_, (lo + hi) >> 1, 0)
        at = ids[np.minimum(order[mid] + depth, len(ids) - 1)]
        right = open_ & ((at <= word) if after else (at < word))
        lo, hi = np.where(right, mid + 1, lo), np.where(open_ & ~right, mid, hi)
    return lo


class Shard:
    """Some documents against some items."""

    def __init__(self, t: Texts, tests: Items):
        self.tests = tests
        self.w, hashes = word_hashes(t)
        self.ids, self.first = numbered(self.w, tests.numbers(hashes))
        self.order = suffix_array(self.ids, tests.longest)
        self.length, self.lo, self.hi, *self.found = search(self.ids, self.order, tests)

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, "right") - 1

    def hits(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Which words are hit, and the windows of each document."""
        lo, hi = self.found
        places = self.order[ragged(lo, hi - lo)]
        windows = np.repeat(np.arange(len(lo)), hi - lo)
        size = self.tests.size[self.tests.stands][windows]
        edges = np.bincount(places, minlength=len(self.ids) + 1) - np.bincount(places + size, minlength=len(self.ids) + 1)
        n = np.diff(self.w.first)
        hit = np.cumsum(edges)[np.arange(len(self.w)) + np.repeat(np.arange(len(n)), n)] > 0
        pairs = np.unique(self.document(places) * max(len(lo), 1) + windows)
        document, window = np.divmod(pairs, max(len(lo), 1))
        return hit, np.split(window, np.searchsorted(document, np.arange(1, len(n))))

    def matches(self) -> tuple[np.ndarray, ...]:
        """Suffix, document and first word of each place of a longest match of a window or more.

        A suffix whose match is the rest of the one before is left out.
        """
        t = self.tests
        inner = np.zeros(len(t.starts), bool)
        inner[1:] = (t.offset[1:] > 0) & (self.length[:-1] == self.length[1:] + 1)
        own = np.flatnonzero((t.size > 0) & (self.length >= t.size) & ~inner)
        places = self.order[ragged(self.lo[own], self.hi[own] - self.lo[own])]
        document = self.document(places)
        return np.repeat(own, self.hi[own] - self.lo[own]), document, places - self.first[document]


def item_blocks(benchmark: DataFrame, window: int = WINDOW) -> list[Items]:
    """The distinct items, in blocks of about BLOCK bytes; at least one block."""
    items = stored(benchmark.select("item_id", F.col("text").cast("string").alias("text")).distinct(), "items")
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-int(size) // BLOCK))
    if n == 1:
        return [Items(_items(items), window)]
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [Items(_items(items.filter(block == i)), window) for i in range(n)]


def _items(items: DataFrame) -> list[tuple[object, str | None]]:
    return sorted(((r["item_id"], r["text"]) for r in items.collect()), key=repr)


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """row (all columns but text), n_words, n_hit and items: the ids, as sorted strings, of items with a window in it."""
    others = [c for c in docs.columns if c != "text"]
    kept = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    frame = docs.select(kept.alias("row"), F.col("text").cast("string").alias("text"))
    row = frame.schema["row"].dataType.simpleString()
    blocks = item_blocks(benchmark, window)
    for i, tests in enumerate(blocks):
        last = i == len(blocks) - 1
        schema = f"row {row}, n_words long, n_hit long, items array<string>" + ("" if last else ", text string, hit binary")
        frame = frame.mapInArrow(tidy(_marker(tests, schema_of(schema), not last)), schema)
        frame = frame if last else stored(frame, "passed")
    return frame


def _marker(tests: Items, schema: pa.Schema, more: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, t in pieces(batch):
                shard = Shard(t, tests)
                hit, windows = shard.hits()
                at = shard.w.first
                items = [tests.items_of(w) if len(w) else [] for w in windows]
                if "hit" in part.schema.names:  # of earlier blocks of items
                    for i, (bits, names) in enumerate(zip(part.column("hit").to_pylist(), part.column("items").to_pylist(), strict=True)):
                        own = slice(at[i], at[i + 1])
                        hit[own] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=at[i + 1] - at[i]).astype(bool)
                        items[i] = sorted({*items[i], *names})
                total = np.concatenate([[0], np.cumsum(hit)])
                columns = [part.column("row"), pa.array(np.diff(at)), pa.array(np.diff(total[at])), pa.array(items, pa.list_(pa.string()))]
                if more:
                    bits = [np.packbits(hit[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                    columns += [part.column("text"), pa.array(bits, pa.binary())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Where items stand verbatim: row, item_id (as a string), item_start, doc_start and n_words.

    For every item suffix that begins with a window: its longest match in each shard, at every place,
    unless that is the rest of the match of the suffix before.
    """
    others = [c for c in docs.columns if c != "text"]
    kept = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    frame = docs.select(kept.alias("row"), F.col("text").cast("string").alias("text"))
    schema = f"row {frame.schema['row'].dataType.simpleString()}, item_id string, item_start long, doc_start long, n_words long"
    out = None
    for tests in item_blocks(benchmark, window):
        one = frame.mapInArrow(tidy(_matcher(tests, schema_of(schema))), schema)
        out = one if out is None else out.unionByName(one)
    return out


def _matcher(tests: Items, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, t in pieces(batch):
                shard = Shard(t, tests)
                suffix, document, start = shard.matches()
                columns = [
                    part.column("row").take(pa.array(document)),
                    pa.array([tests.names[i] for i in tests.item[suffix].tolist()], pa.string()),
                    pa.array(tests.offset[suffix]),
                    pa.array(start),
                    pa.array(shard.length[suffix]),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that no window occurs in, with the columns of `docs`."""
    kept = docs
    for tests in item_blocks(benchmark, window):
        kept = kept.mapInArrow(tidy(_cleaner(tests)), docs.schema)
    return kept


def _cleaner(tests: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, t in pieces(batch):
                clean = [not len(w) for w in Shard(t, tests).hits()[1]]
                yield part.filter(pa.array(clean, pa.bool_()))

    return run
