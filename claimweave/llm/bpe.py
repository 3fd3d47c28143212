"""Byte-pair encoding by an automaton over tokens, and decoding by its arc labels.

The automaton's states are the tokens; an arc leads from u to v if v may follow u inside a word,
and its label is v's text. At first the base symbols follow each other freely. Each merge x+y adds
a gadget: the new token gets x's incoming and y's outgoing arcs, and the arcs from x to y are cut.
An arc u -> v is therefore cut by the merge of x and y if x is a right end of u and y a left end of
v at the time of that merge: u's part x isn't yet merged to the left and v's part y isn't yet
merged to the right. `Automaton.follows` evaluates this for a pair when it is first met and keeps
the outcome in a transition table, as the full table has a few billion places.

Every word has exactly one path, and so has every beginning of a word; `word` finds the last token
of each beginning from left to right.

A null text counts as empty: no tokens, and the empty text decoded. Repeated rows give repeated
results, an empty table none. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from unicodedata import is_normalized, normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimweave.llm.text import Memory, Rolling, Texts, Words, pieces, ragged, tidy

TOKENIZER = "word_bpe_49k.json"
END = "</w>"
NEVER = 1 << 60

DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


class Automaton:
    """Transitions between the tokens of a vocabulary with merges and an end-of-word mark."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str = END):
        self.ids, self.end = vocabulary, end
        self.labels = [""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.labels[i] = token
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (x, y) in enumerate(merges):
            x_id, y_id, both = vocabulary[x], vocabulary[y], vocabulary[x + y]
            self.rank.setdefault((x_id, y_id), rank)
            self.parts.setdefault(both, (x_id, y_id, rank))
        self.table: dict[tuple[int, int], bool] = {}
        self.right: dict[int, list] = {}
        self.left: dict[int, list] = {}
        # tokens by text, inside a word and at its end; a vocabulary entry that its own letters
        # don't merge to has no arc
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        self.beginnings: set[str] = set()
        for token, i in vocabulary.items():
            last = token.endswith(end) and len(token) > len(end)
            text = token.removesuffix(end) if last else token
            if len(text) == 1 or i in self.parts and self._stand(*self.parts[i]):
                (self.final if last else self.inner)[text] = i
                self.beginnings.update(text[:k] for k in range(1, len(text) + 1))

    def _ends(self, token: int, side: int, seen: dict[int, list]) -> list[tuple[int, int]]:
        """The parts at one end of a token, each with the merge that takes it in."""
        if token not in seen:
            out, part, until = [], token, NEVER
            while True:
                out.append((part, until))
                if part not in self.parts:
                    break
                until, part = self.parts[part][2], self.parts[part][side]
            seen[token] = out
        return seen[token]

    def _stand(self, u: int, v: int, rank: int) -> bool:
        """Whether u and v stay side by side until the merge of that rank."""
        for x, x_until in self._ends(u, 1, self.right):
            for y, y_until in self._ends(v, 0, self.left):
                # of two overlapping occurrences of one merge the left one is taken
                merge = self.rank.get((x, y), NEVER)
                if merge < rank and merge < x_until and merge <= y_until:
                    return False
        return True

    def follows(self, u: int, v: int) -> bool:
        """Whether the arc from u to v outlives all merges."""
        known = self.table.get((u, v))
        if known is None:
            if len(self.table) > 500_000:
                self.table.clear()
            known = self.table[u, v] = self._stand(u, v, NEVER)
        return known

    def word(self, letters: str) -> list[int]:
        """The tokens of one word, given in the letters that stand for its bytes."""
        whole = self.final.get(letters)
        if whole is not None:
            return [whole]
        n, inner, beginnings, follows = len(letters), self.inner, self.beginnings, self.follows
        last, size = [-1] * (n + 1), [0] * (n + 1)
        for start in range(n):
            before = last[start]
            for to in range(start + 1, n + 1):
                text = letters[start:to]
                if text not in beginnings:
                    break
                token = inner.get(text) if to < n else self.final.get(text)
                if token is not None and last[to] < 0 and (not start or follows(before, token)):
                    last[to], size[to] = token, to - start
        out, at = [], n
        while at:
            out.append(last[at])
            at -= size[at]
        return out[::-1]


class WordTokens:
    """Ids of the lower-casing word tokenizer for whole batches; each distinct word is encoded once.

    The text is cut at ASCII white space, which the tokenizer drops; each part is normalised, split
    by the tokenizer's pattern and run through the automaton.
    """

    #: The tokenizer's split pattern.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["model"]["merges"]]
        self.automaton = Automaton(model["model"]["vocab"], pairs, model["model"]["end_of_word_suffix"])
        self.labels = list(self.automaton.labels)
        for content, i in self.special.items():
            self.labels.extend([""] * (i + 1 - len(self.labels)))
            self.labels[i] = content
        self.letters = byte_letters()
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        # the library's \s is Unicode's White_Space; Python's adds four control characters to it
        self.pattern = regex.compile(self.PATTERN.replace(r"\s", r"\p{White_Space}"))
        self.memory = Memory(self._encode, np.uint32)
        self.hash = Rolling(10)
        self.path, self.library = path, None

    def _split(self, text: str) -> list[str]:
        """Normalised words, in the letters of their bytes.

        Beyond Latin letters, where Unicode versions differ, the library's own normaliser and
        splitter are asked.
        """
        if max(text, default="") >= "\u0250":
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.path)
            text = self.library.normalizer.normalize_str(text)
            return [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        if not is_normalized("NFC", text):
            text = normalize("NFC", text)
        letters = self.letters
        return ["".join([letters[b] for b in word.encode()]) for word in self.pattern.findall(text.lower())]

    def part(self, text: str) -> list[int]:
        """The ids of a text."""
        out: list[int] = []
        for piece in self.cut_special.split(text):
            if piece in self.special:
                out.append(self.special[piece])
            else:
                for word in self._split(piece):
                    out += self.automaton.word(word)
        return out

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self.part(w.decode()) for w in words]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for one in ids for i in one), np.uint32, int(lengths.sum())), lengths

    def __call__(self, t: Texts) -> list[np.ndarray]:
        w = Words(t)
        keys = self.hash.of(self.hash.sums(t.data), w.starts, w.ends)
        at, length = self.memory.look_up(t, keys, w.starts, w.ends)
        ids = self.memory.pool[ragged(at, length)]
        ends = np.concatenate([[0], np.cumsum(length)])[w.first]
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        """The labels of the path's arcs; the tokenizer has no decoder, so spaces separate them."""
        return " ".join(map(self.labels.__getitem__, ids.tolist()))


_tokens: dict[str, WordTokens] = {}


def tokens_of(tokenizer: str | None) -> WordTokens:
    """One automaton for each Python worker, with its tables."""
    import public_tokenizers

    path = tokenizer or public_tokenizers.path(TOKENIZER)
    if path not in _tokens:
        _tokens[path] = WordTokens(path)
    return _tokens[path]


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and the ids of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer)
        for batch in batches:
            for part, t in pieces(batch):
                ids = pa.array([x.astype(np.int32) for x in tokens(t)], pa.list_(pa.int32()))
                yield pa.record_batch([part.column("doc_id"), ids], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and the text of its ids; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer)
        for batch in batches:
            made = [tokens.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(made, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(tidy(run), "doc_id long, text string")


def digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Encodes and decodes every text; hashes of both, see DIGESTS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer)
        for batch in batches:
            for part, t in pieces(batch):
                ids = tokens(t)
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(tokens.decode(x).encode()).hexdigest() for x in ids]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(tidy(run), DIGESTS)
