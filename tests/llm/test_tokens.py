"""Packing and the token automaton against the tokenizers library."""

import collections
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimweave.llm import bpe, packing


@pytest.fixture(scope="module")
def byte_level():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_level():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check_pieces(rows, ids_of):
    """rows: dictionaries of packing.PACKED; ids_of: each document's ids, by doc_id."""
    places, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0), "neither full nor a power of two"
    assert set(pieces) == set(ids_of)
    for doc, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            ids = np.array(ids_of[doc][at : at + r["length"]], "<u4")
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids.tobytes())
            assert r["doc_tokens"] == len(ids_of[doc])
            at += r["length"]
        assert at == len(ids_of[doc])


def test_op3_holds_every_id_once(result, documents, byte_level):
    check_pieces(result("op3_packing"), {i: [*byte_level.encode(t, add_special_tokens=False).ids, 1] for i, t in documents})


def test_odd_documents_are_packed(odd, nothing, byte_level):
    unique = odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    ids = {r.doc_id: [*byte_level.encode(r.text or "", add_special_tokens=False).ids, 1] for r in unique.collect()}
    check_pieces([r.asDict() for r in packing.pack(unique).collect()], ids)
    assert packing.pack(nothing).isEmpty()
    assert packing.pack(odd).groupBy("doc_id").count().count() == 15


def test_sum_of_squares_picks_the_level_that_evens_the_counts():
    packer = packing.Packer(10)
    ids = np.zeros(10, np.uint32)
    packer.add(("a", 0, ids[:6], 6))
    packer.add(("b", 0, ids[:6], 6))
    assert packer.counts[6] == 2
    packer.add(("c", 0, ids[:4], 4))  # closing one of two windows takes most off the sum
    assert packer.counts[6] == 1 and len(packer.closed) == 1
    packer.join(finish=True)
    assert sorted(sum(len(p[2]) for p in w) for w in packer.closed) == [2, 4, 10]


def test_many_open_windows_are_joined(spark, monkeypatch, byte_level):
    monkeypatch.setattr(packing, "MOST_OPEN", 3)
    packer = packing.Packer(16)
    rng = np.random.default_rng(0)
    total = 0
    for i in range(500):
        size = int(rng.integers(1, 16))
        total += size
        packer.add((i, 0, np.full(size, i, np.uint32), size))
        if packer.n_open > packing.MOST_OPEN:
            packer.join(finish=False)
            assert packer.n_open <= 1
    packer.join(finish=True)
    sizes = [sum(len(p[2]) for p in w) for w in packer.closed]
    assert sum(sizes) == total and all(s == 16 or s & (s - 1) == 0 for s in sizes)


def test_op10_equals_the_library(result, documents, word_level):
    expected = {}
    for i, t in documents:
        ids = word_level.encode(t, add_special_tokens=False).ids
        text = word_level.decode(ids, skip_special_tokens=False)
        expected[i] = (
            len(ids),
            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        )
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in result("op10_bpe")} == expected


def test_odd_documents_encode_and_decode(spark, odd, nothing, word_level):
    texts = [r.text or "" for r in odd.select("text").collect()]
    texts += ["ΣΑΣ ΑΣ", "İI ǅ ß ﬁ", "\x1cA \x1d b", "it's 'S we'LL 12345 ½", "á é", "՘ x", "aaaaaaaaaaaaa " * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = bpe.encode(docs)
    got = {r.doc_id: r.ids for r in encoded.collect()}
    for i, t in enumerate(texts):
        assert got[i] == word_level.encode(t, add_special_tokens=False).ids, t[:50]
    decoded = {r.doc_id: r.text for r in bpe.decode(encoded).collect()}
    assert decoded == {i: word_level.decode(ids, skip_special_tokens=False) for i, ids in got.items()}
    assert bpe.digests(odd).count() == odd.count() and bpe.digests(nothing).isEmpty()


def test_automaton_is_the_merges_outcome():
    """Against merging pair by pair, on words of few letters, where overlaps abound."""
    merges = [("a", "a"), ("a", "b"), ("aa", "a"), ("b", "b</w>"), ("ab", "a"), ("aa", "aa"), ("b", "a</w>")]
    symbols = ["a", "b", "a</w>", "b</w>", *("".join(m) for m in merges)]
    machine = bpe.Automaton({s: i for i, s in enumerate(symbols)}, merges)
    ranks = {m: i for i, m in enumerate(merges)}

    def merged(word):
        parts = [*word[:-1], word[-1] + "</w>"]
        while True:
            pairs = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
            if not pairs:
                return parts
            best = min(pairs)[0]
            i, out = 0, []
            while i < len(parts):
                if i + 1 < len(parts) and ranks.get((parts[i], parts[i + 1])) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out

    for n in range(1, 9):
        for code in range(2**n):
            word = "".join("ab"[code >> k & 1] for k in range(n))
            assert [symbols[i] for i in machine.word(word)] == merged(word), word
