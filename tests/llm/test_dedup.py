"""Substring and suffix-array deduplication and the n-gram Jaccard join against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimweave.llm import jaccard_join, substring_dedup, suffix_dedup
from claimweave.llm.repeats import least_places
from claimweave.llm.suffix_dedup import suffix_ranks

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def removed(sequences, length):
    """For each sequence, which places lie in a window that stands elsewhere too."""
    windows = collections.Counter(tuple(s[i : i + length]) for s in sequences for i in range(len(s) - length + 1))
    out = []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - length + 1):
            if windows[tuple(s[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append(gone)
    return out


def by_text(pairs):
    return sorted(pairs, key=repr)


def test_op1_equals_brute_force(result, documents):
    words = [WORD.findall(t.encode()) for _, t in documents]
    expected = {}
    for (i, _), w, gone in zip(documents, words, removed(words, 35), strict=True):
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        expected[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in result("op1_substring")}
    assert got == expected and sum(v[1] for v in got.values()) > 0


def test_op2_equals_brute_force(result, documents):
    raw = [t.encode() for _, t in documents]
    windows = collections.Counter(b[i : i + 400] for b in raw for i in range(len(b) - 399))
    expected = {}
    for (i, _), b in zip(documents, raw, strict=True):
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - 399):
            if windows[b[p : p + 400]] > 1:
                gone[p] += 1
                gone[p + 400] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        expected[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in result("op2_suffix")}
    assert got == expected and sum(v[1] for v in got.values()) > 0


def test_short_windows_equal_brute_force(spark, odd):
    """Many overlaps, repeats inside a document, runs of one letter; every odd row, whose ids aren't unique."""
    rows = [(r.doc_id, (r.text or "").encode()) for r in odd.collect()]
    words = [WORD.findall(b) for _, b in rows]
    for length in (2, 3, 8):
        got = substring_dedup.find(odd, length).select("row.doc_id", "n_words", "n_removed", "kept").collect()
        expected = [
            (i, len(w), sum(g), b" ".join(x for x, y in zip(w, g, strict=True) if not y).decode())
            for (i, _), w, g in zip(rows, words, removed(words, length), strict=True)
        ]
        assert by_text(tuple(r) for r in got) == by_text(expected)
    few = [(i, b) for i, b in rows if len(b) < 5000]
    small = odd.filter("text IS NULL OR octet_length(text) < 5000")
    for length in (32, 75):
        got = suffix_dedup.find(small, length).select("row.doc_id", "n_removed", "kept").collect()
        expected = [
            (i, sum(g), bytes(x for x, y in zip(b, g, strict=True) if not y))
            for (i, b), g in zip(few, removed([b for _, b in few], length), strict=True)
        ]
        assert by_text((r[0], r[1], bytes(r[2])) for r in got) == by_text(expected)


def test_levels_double_and_equal_brute_force(spark, monkeypatch):
    """Few words, passages copied in part, whole rows repeated: candidates survive to every level."""
    assert substring_dedup.levels(35) == [9, 18, 35] and substring_dedup.levels(2) == [1, 2]
    draw = random.Random(5)
    base = [draw.choice("abc") for _ in range(60)]
    texts = []
    for i in range(120):
        a, b = sorted(draw.sample(range(61), 2))
        tail = [draw.choice("abcd") for _ in range(draw.randrange(12))]
        texts.append(" ".join(tail + base[a:b] + tail[::-1] if i % 3 else tail))
    texts += texts[:9] + [" ".join("x" * 50), "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    words = [WORD.findall((t or "").encode()) for t in texts]
    for shortest, length in ((2, 9), (1, 13), (2, 35)):
        monkeypatch.setattr(substring_dedup, "SHORTEST", shortest)
        lengths = substring_dedup.levels(length)
        assert len(lengths) >= 4 and all(a < b <= 2 * a for a, b in zip(lengths, lengths[1:], strict=False))
        got = substring_dedup.find(docs, length).select("row.doc_id", "n_removed", "kept").collect()
        expected = [
            (i, sum(g), b" ".join(x for x, y in zip(w, g, strict=True) if not y).decode())
            for i, (w, g) in enumerate(zip(words, removed(words, length), strict=True))
        ]
        assert by_text(tuple(r) for r in got) == by_text(expected) and any(r[1] for r in got)


def test_no_documents_and_clashing_columns(odd, nothing):
    assert substring_dedup.find(nothing).isEmpty() and suffix_dedup.find(nothing).isEmpty()
    assert suffix_dedup.without_repeats(odd).columns == odd.columns
    assert suffix_dedup.without_repeats(odd).count() == odd.count()
    assert jaccard_join.link(nothing).isEmpty() and jaccard_join.first_of_each(nothing).isEmpty()


@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.integers(1, 7))
@settings(deadline=None, max_examples=60)
def test_least_places(values, width):
    hashes = np.array(values, np.uint64) << np.uint64(40)
    expected = [i + int(np.argmin(values[i : i + width])) for i in range(len(values) - width + 1)]
    assert least_places(hashes, width).tolist() == expected


@given(st.binary(min_size=1, max_size=60))
@settings(deadline=None, max_examples=60)
def test_suffix_ranks_order_suffixes(data):
    for level, rank in enumerate(suffix_ranks(np.frombuffer(data, np.uint8))):
        keys = [data[i : i + (1 << level)] for i in range(len(data))]
        for i in range(len(data)):
            for j in range(i):
                assert (rank[i] < rank[j]) == (keys[i] < keys[j])


def shingles(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)])


def components(sets, percent=80):
    """The first index of each set's component, by comparing all pairs."""
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(sets))]


def test_op5_equals_brute_force(result, documents):
    sets = [shingles(t) for _, t in documents]
    expected = {
        i: (len(s), documents[c][0]) for (i, _), s, c in zip(documents, sets, components(sets), strict=True)
    }
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result("op5_jaccard")}
    assert got == expected and len({c for _, c in got.values()}) < len(got)


def test_chains_of_near_copies_are_one_component(spark):
    """Neighbours are linked, ends are not; leaders alone wouldn't find every link."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 4 : i * 4 + 100])) for i in range(60)]
    rows += [(100 + i, " ".join(f"v{(i * 37 + k) % 500}" for k in range(50))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [shingles(t) for _, t in rows]
    expected = {i: rows[c][0] for (i, _), c in zip(rows, components(sets), strict=True)}
    assert {r.doc_id: r.component_id for r in jaccard_join.link(docs).collect()} == expected
    assert expected[59] == 0


def test_odd_documents_are_linked_with_copies_only(odd):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.link(odd).collect()), key=repr)
    by_id = {g[0]: g for g in got if g[0] is not None}
    assert len(got) == odd.count()
    assert by_id[9][2] == by_id[8][2] == 8 and by_id[6][2] == 6 and by_id[7][2] == by_id[14][2] == 6
    assert by_id[3][1:] == (0, 3) and by_id[2][1:] == (0, 2) and by_id[5][1:] == (1, 5)
    kept = jaccard_join.first_of_each(odd)
    assert kept.columns == odd.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 2, 3, 4, 5, 6, 8, 10, 11, 12, 13] and kept.filter("doc_id IS NULL").count() == 2


def test_tree_finds_the_links_of_sorted_sets():
    rng = np.random.default_rng(1)
    counts = np.zeros(jaccard_join.CELLS, np.int64)
    base = np.unique(rng.integers(0, 1 << 63, 60, np.uint64))
    members = [np.unique(np.concatenate([base[: 60 - k], rng.integers(0, 1 << 63, k, np.uint64)])) for k in range(30)]
    for percent in (50, 80):
        linked = jaccard_join.tree_overlaps(base, members, counts, percent)
        for yes, m in zip(linked, members, strict=True):
            both = len(np.intersect1d(base, m))
            assert yes == (100 * both >= percent * (len(base) + len(m) - both))


def brute_links(sets, percent=80):
    """(i, j, overlap) of all linked sets, by comparing all pairs."""
    out = []
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                out.append((j, i, both))
    return out


def test_every_link_of_a_family_is_listed_and_counted(spark):
    """Near copies that all share groups, in more than one block, a chain, copies, and rows without an id."""
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(330):
        own = list(base)
        for at in rng.integers(0, 90, i % 5):
            own[at] = f"x{rng.integers(0, 40)}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(f"c{k}" for k in range(i * 4, i * 4 + 100))) for i in range(40)]
    rows += [(2000, rows[3][1]), (2000, rows[3][1]), (None, rows[3][1].upper()), (2001, ""), (2002, ""), (2003, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sets = [shingles(t) for _, t in rows]
    links = brute_links(sets)
    count = collections.Counter(x for i, j, _ in links for x in (i, j))
    got = [(r.doc_id, r.n_links) for r in jaccard_join.link(docs).collect()]
    assert by_text(got) == by_text((i, count[k]) for k, (i, _) in enumerate(rows))
    pairs, members = jaccard_join.join(docs)
    by_doc = {r.doc_id: r.set_id for r in members.collect()}
    of = {s: by_doc[i] for (i, _), s in zip(rows, sets, strict=True) if i is not None}
    expected = {(*sorted((of[sets[i]], of[sets[j]])), both) for i, j, both in links if sets[i] != sets[j]}
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == expected and members.count() == len(rows)


def test_hot_elements_are_spread_over_buckets_and_blocks(spark, monkeypatch):
    cell = np.zeros(jaccard_join.CELLS, np.int64)
    cell[5], cell[9] = 40 * jaccard_join.HOT, 100
    spread = jaccard_join.hot_cells(cell, 64)
    sid = np.arange(10_000)
    for at, least, most in ((5, 30, 40), (9, 1, 1)):
        element = np.full(len(sid), (at << 44) + 77, np.uint64)
        n = len(np.unique(jaccard_join.bucket_of(element, sid, spread, 64)))
        assert least <= n <= most
    assert jaccard_join.bucket_count(np.full(10, 10**9), 80, 12) > 1000 and jaccard_join.bucket_count(cell, 100, 12) == 12

    monkeypatch.setattr(jaccard_join, "HOT", 1)
    rows = [(i, " ".join([f"w{k}" for k in range(100)] + [f"x{i}"])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.n_links, r.component_id) for r in jaccard_join.link(docs).collect()} == {(599, 0)}
    docs = docs.withColumn("text_id", F.xxhash64("text"))
    census, counts = jaccard_join._census(docs, 5)
    groups = jaccard_join._groups(docs, counts, 5, 80)
    nodes = census.groupBy("set_id").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    found = jaccard_join._candidates(groups, nodes, 80)
    work = found.groupBy("element", "i", "j").count().collect()
    assert len(work) >= 6 and max(r["count"] for r in work) < 3 * jaccard_join.BLOCK


def test_elements_has_one_row_for_each_wanted_set(spark):
    """Also with repeated rows in several partitions, copies, and documents that share a wanted one's mark."""
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text)] * 40 + [(i, text) for i in range(2, 30)] + [(None, text.replace("w7", "v"))] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    docs = docs.withColumn("text_id", F.xxhash64("text"))
    census, counts = jaccard_join._census(docs, 5)
    wanted = census.groupBy("set_id").agg(F.min(F.struct("doc_id", "text_id")).alias("one"), F.count("*").alias("copies"))
    got = jaccard_join._elements(docs, wanted.select("set_id", "copies", "one.*"), counts, 5).collect()
    assert sorted(r.copies for r in got) == [20, 68] and {len(r.elements) for r in got} == {26 * 8}
