"""Sum-of-squares packing of tokenized documents into windows of a fixed length.

Each document's last, shorter part is one item. It goes whole into the open window whose fill
level changes the sum of squares of the level counts the least, a new window being level 0. The
counts of partly filled windows stand in one array, indexed by level. When a task ends, or holds
`MOST_OPEN` open windows, their parts are joined and cut at window boundaries; what remains at the
end of a task is cut into sequences whose lengths are powers of two, which need no padding. So no
sequence is padded.

A null text counts as empty and yields the end token alone. Repeated rows are packed as often as
they occur. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from claimweave.llm.text import SPACE, Memory, Rolling, Texts, Words, pieces, ragged, tidy

WINDOW = 2048
END = 1
MOST_OPEN = 2048
VOCABULARY = "byte_bpe_50k.tiktoken"

PACKED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class ByteTokens:
    """Ids of byte-level BPE for whole batches; each distinct word is encoded once.

    Words are cut where the tokenizer's own pattern always cuts: before a single space that
    precedes a word, and around other white space. A text with white space outside ASCII or with
    the text of a special token goes through the tokenizers library whole.
    """

    SPECIAL = b"<|endoftext|>"
    UNSURE = frozenset([*range(33), 0x7F, 0xC2, 0xE1, 0xE2, 0xE3])  # may begin white space

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.memory = Memory(self._encode, np.uint32)
        self.hash = Rolling(3)
        self.library = None
        self.path = path

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # A word behind one space or a newline begins a piece of the pattern wherever it stands,
        # so that all of them are encoded as one text; the newline is a piece of its own.
        joined, rest = [], []
        for i, w in enumerate(words):
            spaced = w[:1] == b" "
            if len(w) > spaced and w[spaced] not in self.UNSURE:
                joined.append((i, spaced, w if spaced else b"\n" + w))
            else:
                rest.append(i)
        ids = np.array(self.bpe.encode_ordinary(b"".join(w for _, _, w in joined).decode()), np.uint32)
        cuts = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(w) for _, _, w in joined]), "left") + 1
        lengths, starts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        if joined:
            which = np.array([i for i, _, _ in joined])
            skip = np.array([not spaced for _, spaced, _ in joined], np.int64)
            from_ = np.concatenate([[0], cuts[:-1]]) + skip
            starts[which], lengths[which] = from_, cuts - from_
        pool = [ids]
        at = len(ids)
        for i in rest:
            own = np.array(self.bpe.encode_ordinary(words[i].decode()), np.uint32)
            pool.append(own)
            starts[i], lengths[i] = at, len(own)
            at += len(own)
        return np.concatenate(pool)[ragged(starts, lengths)], lengths

    def _whole(self, text: bytes) -> np.ndarray:
        if self.library is None:
            import public_tokenizers
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        return np.array(self.library.encode(text.decode(), add_special_tokens=False).ids, np.uint32)

    def odd(self, t: Texts) -> np.ndarray:
        """Documents that hold white space outside ASCII or the special token's text."""
        d = t.data
        hits = []
        if len(d) > 1:
            c2 = np.flatnonzero(d[:-1] == 0xC2)
            hits.append(c2[np.isin(d[c2 + 1], (0x85, 0xA0))])
            e = np.flatnonzero((d[:-2] == 0xE1) | (d[:-2] == 0xE2) | (d[:-2] == 0xE3))
            three = (d[e].astype(int) << 16) | (d[e + 1].astype(int) << 8) | d[e + 2]
            spaces = [0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080]
            hits.append(e[np.isin(three, spaces)])
            bar = np.flatnonzero((d[:-1] == ord("<")) & (d[1:] == ord("|")))
            hits.append(np.array([b for b in bar if d[b : b + len(self.SPECIAL)].tobytes() == self.SPECIAL], np.int64))
        hit = np.concatenate(hits).astype(np.int64) if hits else np.zeros(0, np.int64)
        return np.unique(np.searchsorted(t.offsets, hit, "right") - 1)

    def __call__(self, t: Texts) -> list[np.ndarray]:
        """The ids of every text."""
        w = Words(t)
        starts, ends = w.starts, w.ends
        # the space runs before each word and at the end of each text
        before = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        doc = np.searchsorted(t.offsets, starts, "right") - 1
        before = np.maximum(before, t.offsets[doc])
        spaced = (starts > before) & (t.data[np.maximum(starts - 1, 0)] == 32)
        last = starts - (starts > before)  # the run's last byte stands alone or joins the word
        own = starts - spaced
        alone = (starts > before) & ~spaced
        tails_from = np.where(w.first[1:] > w.first[:-1], ends[np.maximum(w.first[1:] - 1, 0)] if len(ends) else 0, t.offsets[:-1])
        tails_to = t.offsets[1:]
        u_start = np.concatenate([own, before[last > before], last[alone], tails_from[tails_to > tails_from]])
        u_end = np.concatenate([ends, last[last > before], starts[alone], tails_to[tails_to > tails_from]])
        order = np.argsort(u_start, kind="stable")
        u_start, u_end = u_start[order], u_end[order]
        keys = self.hash.of(self.hash.sums(t.data), u_start, u_end)
        at, length = self.memory.look_up(t, keys, u_start, u_end)
        ids = self.memory.pool[ragged(at, length)]
        ends_of = np.concatenate([[0], np.cumsum(length)])[np.searchsorted(u_start, t.offsets)]
        found = [ids[a:b] for a, b in zip(ends_of[:-1].tolist(), ends_of[1:].tolist(), strict=True)]
        for i in self.odd(t):
            found[i] = self._whole(t.of(i))
        return found


class Packer:
    """Open windows by fill level. `closed` collects finished windows as lists of parts."""

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list] = [[] for _ in range(window)]
        self.n_open = 0
        self.closed: list[list] = []
        self.levels = np.arange(window + 1)

    def add(self, part: tuple) -> None:
        """part: (document, start, ids, tokens of the document), shorter than a window."""
        size = len(part[2])
        counts = self.counts
        room = self.window - size
        gain = np.full(room + 1, np.iinfo(np.int64).max)
        held = np.flatnonzero(counts[: room + 1])
        gain[held] = 2 * (counts[held + size] - counts[held]) + 2
        gain[0] = 2 * counts[size] + 1
        if counts[room]:
            gain[room] = 1 - 2 * counts[room]  # it closes a window
        level = room - int(np.argmin(gain[::-1]))
        parts = self.open[level].pop() if level else []
        if level:
            counts[level] -= 1
            self.n_open -= 1
        parts.append(part)
        if level + size == self.window:
            self.closed.append(parts)
        else:
            self.open[level + size].append(parts)
            counts[level + size] += 1
            self.n_open += 1

    def join(self, finish: bool) -> None:
        """Joins all open windows; at the end cuts what is left into powers of two."""
        parts = [p for windows in self.open[::-1] for w in windows for p in w]
        self.counts[:] = 0
        self.open = [[] for _ in range(self.window)]
        self.n_open = 0
        left = sum(len(p[2]) for p in parts)
        lengths = [self.window] * (left // self.window)
        rest = left % self.window
        if finish:
            lengths += [1 << b for b in range(self.window.bit_length(), -1, -1) if rest >> b & 1]
            rest = 0
        queue = iter(parts)
        doc, start, ids, total = next(queue, (None, 0, (), 0))
        for want in [*lengths, *([rest] if rest else [])]:
            mine = []
            while want:
                if not len(ids):
                    doc, start, ids, total = next(queue)
                take = min(want, len(ids))
                mine.append((doc, start, ids[:take], total))
                start, ids, want = start + take, ids[take:], want - take
            size = sum(len(p[2]) for p in mine)
            if size == rest and not finish and rest:
                self.open[size].append(mine)
                self.counts[size] += 1
                self.n_open += 1
            else:
                self.closed.append(mine)


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end: int = END) -> DataFrame:
    """One row for each piece of a document, see PACKED. `vocabulary`: the ranks of the byte-level BPE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens_of(vocabulary)
        packer = Packer(window)
        sequence = TaskContext.get().partitionId() << 40

        def rows() -> pa.RecordBatch:
            nonlocal sequence
            out = []
            for parts in packer.closed:
                at = 0
                for doc, start, ids, total in parts:
                    out.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, at))
                    at += len(ids)
                sequence += 1
            packer.closed = []
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], list(names))

        for batch in batches:
            for part, t in pieces(batch):
                for doc, ids in zip(part.column("doc_id").to_pylist(), encode(t), strict=True):
                    ids = np.append(ids, np.uint32(end))
                    whole = len(ids) // window * window
                    for at in range(0, whole, window):
                        packer.closed.append([(doc, at, ids[at : at + window], len(ids))])
                    if whole < len(ids):
                        packer.add((doc, whole, ids[whole:], len(ids)))
                    if packer.n_open > MOST_OPEN:
                        packer.join(finish=False)
                yield rows()
        packer.join(finish=True)
        yield rows()

    return docs.select("doc_id", "text").mapInArrow(tidy(run), PACKED)


_tokens: dict[str, ByteTokens] = {}


def tokens_of(vocabulary: str | None) -> ByteTokens:
    """One tokenizer for each Python worker, with its memory of words."""
    import public_tokenizers

    path = vocabulary or public_tokenizers.path(VOCABULARY)
    if path not in _tokens:
        _tokens[path] = ByteTokens(path)
    return _tokens[path]
