"""Language model, classifiers, search and fingerprints: brute force where there is one, else held-out accuracy."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimweave.llm import fingerprints, lm, quality, topk, toxicity

SF_DIR = "/root/testdata/sf0.001"
TRAINED = "/root/testdata/sf0.01"  # classifiers need more labels than the smallest table has
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def tokens(text):
    return [*WORD.findall((text or "").encode().translate(LOWER)), None]


def test_op4_base_score_and_gain(result, documents):
    own = {i: tokens(t) for i, t in documents}
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in own}
    count = collections.Counter(t for i, ts in own.items() if not out[i] for t in ts)
    n, v = sum(count.values()), len(count)
    gain = 0
    for r in result("op4_lm"):
        ts = own[r["doc_id"]]
        base = sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)
        assert r["held_out"] == out[r["doc_id"]] and r["train_tokens"] == n
        assert r["n_tokens"] == len(ts) and r["n_known"] == sum(count[t] > 0 for t in ts)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        gain += (r["score"] - r["base_score"]) if r["held_out"] else 0
    assert gain > 0


def test_op4_score_is_the_mixture(spark, documents, monkeypatch):
    """With given weights: every token's chance from brute-force counts, in float precision of the counts."""
    rng = np.random.default_rng(4)
    weights = rng.dirichlet([1, 2, 2], 64)
    monkeypatch.setattr(lm, "learn_weights", lambda *_: weights)
    small = documents[:60]
    own = {i: tokens(t) for i, t in small}
    taught = [ts for i, ts in own.items() if not lm.held_out(i)]
    word = collections.Counter(t for ts in taught for t in ts)
    pair = collections.Counter(p for ts in taught for p in zip([None, *ts[:-1]], ts, strict=True))
    n, v = sum(word.values()), len(word)
    docs = spark.createDataFrame(small, "doc_id long, text string")
    for r in lm.score(docs).collect():
        total = 0.0
        for before, t in zip([None, *own[r.doc_id][:-1]], own[r.doc_id], strict=True):
            w = weights[1 + int(math.log2(word[before])) if word[before] else 0]
            p = w[0] / (v + 1) + w[1] * word[t] / n + w[2] * pair[before, t] / max(word[before], 1)
            total += math.log10(p)
        assert r.score == pytest.approx(total, rel=1e-9)


def test_chances_add_up_to_one():
    """Over the known words and one unknown word, for a context that was seen and for one that wasn't."""
    word, pair = np.array([5, 3, 2]), np.array([2, 1, 0])  # counts, and counts after a context seen 3 times
    weights = lm.learn_weights(np.array([lm._bin(np.array([5]))[0] * lm.RATIOS]), np.array([7.0]), 10, 3)
    for bucket, before, after in ((2, 3, pair), (0, 0, pair * 0)):
        w = weights[bucket]
        p = w[0] / 4 + w[1] * word / 10 + w[2] * after / max(before, 1)
        assert p.sum() + w[0] / 4 == pytest.approx(1.0)


def test_weights_follow_the_evidence():
    """Where bigrams foretell the next word they get the weight, where they don't the words do."""
    def cells(ratio, bucket):
        return (bucket * 1024 + lm._bin(np.array([8]))[0]) * lm.RATIOS + ratio

    cell = np.array([cells(1, 5), cells(0, 9)])
    w = lm.learn_weights(cell, np.array([1000.0, 1000.0]), 10_000, 500)
    assert w[5, 2] > 0.95 and w[9, 2] < 0.01 and np.allclose(w.sum(1), 1)


def test_odd_documents_are_scored(odd, nothing):
    got = [r.asDict() for r in lm.score(odd).collect()]
    assert len(got) == odd.count() and all(r["score"] < 0 and r["base_score"] < 0 for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (2, 3, 4)} == {1}
    assert lm.score(nothing).isEmpty()
    alone = odd.filter(F.col("doc_id") == next(i for i in range(1, 15) if lm.held_out(i))) if any(
        lm.held_out(i) for i in range(1, 15)
    ) else nothing
    assert all(r.train_tokens == 0 for r in lm.score(alone).collect())


def auc(good, score):
    order = np.argsort(score, kind="stable")
    _, back, count = np.unique(np.asarray(score)[order], return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[back]
    good = np.asarray(good, bool)[order]
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{TRAINED}/documents.parquet"), spark.read.parquet(f"{TRAINED}/labels.parquet")


def test_op6_agrees_with_labels_it_never_sees(tables):
    docs, labels = tables
    model = quality.fit(docs)
    scored = quality.score(docs, model).join(labels, "doc_id").collect()
    assert auc([r.quality == 1 for r in scored], [r.score for r in scored]) > 0.98
    kept = [r for r in scored if r.score >= 0.5]
    assert sum(r.quality == 1 for r in kept) > 0.97 * sum(r.quality == 1 for r in scored)
    assert 0.7 < model.labels.good < 0.97


def test_em_finds_the_labellers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    knows = np.array([0.45, 0.4, 0.3, 0.5, 0.35, 0.45, 0.4])
    errs = np.array([0.01, 0.005, 0.01, 0.002, 0.01, 0.01, 0.005])
    bad = rng.random((20_000, 7)) < np.where(truth[:, None], errs, knows)
    v = np.where(rng.random((20_000, 7)) < 0.1, 0, np.where(bad, -1, 1))
    patterns, count = np.unique(v, axis=0, return_counts=True)
    model = quality.expectation_maximisation(patterns, count.astype(float))
    assert abs(model.good - 0.8) < 0.04
    assert np.abs(model.chances[0, :, 0] - knows).max() < 0.1
    assert np.abs(model.chances[1, :, 0] - errs).max() < 0.015
    assert ((model.posterior(v) > 0.5) == truth).mean() > 0.93


def test_odd_documents_are_judged(odd, nothing):
    model = quality.fit(odd)
    got = {r.doc_id: r.score for r in quality.score(odd, model).collect()}
    assert got[2] == got[3] == got[4] == 0.0 and all(0 <= s <= 1 for s in got.values())
    assert quality.keep_good(odd, model).columns == odd.columns
    assert quality.score(nothing, quality.fit(nothing)).isEmpty()


def test_op7_on_held_out_documents(tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels.filter(toxicity.learnable(F.col("doc_id"))))
    scored = toxicity.score(docs, model).join(labels, "doc_id").filter(~toxicity.learnable(F.col("doc_id"))).collect()
    assert auc([r.toxic == 1 for r in scored], [r.score for r in scored]) > 0.8
    clean = [r.score for r in scored if r.toxic == 0]
    assert np.mean(np.array(clean) >= 0.5) < 0.05
    found = toxicity.passages(docs, model).limit(5).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    for p in found:
        assert text[p.doc_id].encode()[p.start : p.end].decode() == p.passage


def test_op7_learns_from_nothing_else(spark, tables):
    """Labels of held-out documents, and lang or source of any, don't change a score."""
    docs, labels = tables
    small = docs.filter("doc_id < 300")
    taught = labels.filter(toxicity.learnable(F.col("doc_id")))
    a = {r.doc_id: r.score for r in toxicity.score(small, toxicity.fit(small, taught)).collect()}
    other = small.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    b = {r.doc_id: r.score for r in toxicity.score(other, toxicity.fit(other, taught)).collect()}
    assert a == b


def maximal(scores):
    """Maximal segments by their definition: all proper subsegments score less, and none that holds it is such."""
    n, total = len(scores), np.concatenate([[0.0], np.cumsum(scores)])
    good = []
    for i in range(n):
        for j in range(i + 1, n + 1):
            inner = total[i + 1 : j]
            if total[j] > total[i] and all(total[i] < x < total[j] for x in inner):
                good.append((i, j))
    return sorted(g for g in good if not any(o != g and o[0] <= g[0] and g[1] <= o[1] for o in good))


def test_segments_are_the_maximal_ones():
    rng = np.random.default_rng(5)
    for _ in range(200):
        scores = rng.integers(-4, 5, rng.integers(1, 14)).astype(float) + rng.random() * 1e-3
        assert [(a, b) for _, a, b in toxicity.segments(scores)] == maximal(scores)


def test_odd_documents_and_labels(spark, odd, nothing):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 1), (None, 0, 1), (5, 1, None), (6, 1, 0), (999, 1, 1)], "doc_id long, quality int, toxic int"
    )
    model = toxicity.fit(odd, labels)
    got = [r.score for r in toxicity.score(odd, model).collect()]
    assert len(got) == odd.count() and all(0 <= s <= 1 for s in got)
    assert toxicity.without_toxic(odd, model).columns == odd.columns
    none = toxicity.fit(odd, labels.limit(0))
    assert {round(r.score, 6) for r in toxicity.score(odd, none).collect()} == {0.1}
    assert toxicity.score(nothing, toxicity.fit(nothing, labels)).isEmpty()


def brute(rows, k=5, every=50):
    found = []
    use = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    for q, x in use:
        if q % every == 0:
            scores = sorted((-int(x @ y), i) for i, y in use if i != q and len(y) == len(x))
            found += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(found)


def test_op8_equals_brute_force(spark, result):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in result("op8_topk")) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (50, [0.5, -0.5]), (100, []),
            (150, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), *((i, [1.0, 1.0]) for i in (5, 6, 7, 8, 9, 10)), (11, [-0.001, 0.0])]
    schema = "vec_id long, embedding array<float>, cell int, salt int"
    vectors = spark.createDataFrame([(i, v, None, None) for i, v in rows], schema)
    got = topk.top_k(vectors, F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == brute(rows)
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).isEmpty()


def rows_found(spark, rows, every):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % every == 0).collect())


@pytest.mark.parametrize("group", [4, 512])
def test_voronoi_bounds_lose_nothing(spark, monkeypatch, group):
    monkeypatch.setattr(topk, "GROUP", group)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    rows = [(int(i), (centres[i % 6] + 0.05 * rng.normal(size=8)).tolist()) for i in range(600)]
    assert rows_found(spark, rows, 20) == brute(rows, every=20)


def test_negative_scores_lose_nothing(spark):
    rows = [(0, [1.0, 0.0]), *((i, [-1.0, 0.0]) for i in range(1, 11)), (20, [1.0, 0.0])]
    assert rows_found(spark, rows, 20) == brute(rows, every=20) and len(brute(rows, every=20)) == 10
    rng = np.random.default_rng(4)
    rows = [(i, [-1.0 - rng.random(), *rng.normal(size=3).tolist()] if i % 50 else [5.0, 0.0, 0.0, 0.0]) for i in range(400)]
    assert rows_found(spark, rows, 50) == brute(rows)


def test_repeated_queries_ask_once(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(60)]
    again = [(50, [1.0, 1.0]), (50, [1.0, 1.0]), (50, [float("nan"), 1.0]), (3, [3.0, 1.0])]
    got = rows_found(spark, rows + again, 50)
    # the least vector of id 50 asks; row 3 is a candidate twice
    assert [r for r in got if r[0] == 50] == brute([r for r in rows if r[0] != 50] + again[:1] + again[3:])[-5:]
    assert len(got) == 10


def test_cells_that_need_not_meet_do_not(spark):
    """Of far clusters nearly all rows stay away from nearly all cells of queries."""
    rng = np.random.default_rng(7)
    centres = 40 * rng.normal(size=(12, 16))
    rows = [(int(i), (centres[i % 12] + rng.normal(size=16)).tolist()) for i in range(2400)]
    vectors = topk.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    cells, _, groups = topk._cells(vectors, vectors.filter("vec_id % 10 = 0"), 16, 5)
    wanted = cells.wanted(np.array([r["v"] for r in vectors.select("v").collect()], np.int64))
    assert len(cells.used) >= 12 and wanted.mean() < 0.2 and not cells.meet.all()
    assert rows_found(spark, rows, 50) == brute(rows)


def test_queries_are_not_broadcast(spark):
    """Each slice of rows gets the queries by shuffle, however few Spark takes them for."""
    rows = [(i, [float(i % 7), 1.0]) for i in range(120)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("every", "distinct"), [(1, 600), (3, 5)])
def test_many_slices_and_bands_lose_nothing(spark, monkeypatch, every, distinct):
    """Bands of a few queries; where rows repeat, one cell's queries are dealt over several."""
    for name, value in (("GROUP", 16), ("MEET", 1024), ("BLOCK", 32)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(3)
    kinds = rng.normal(size=(distinct, 8))
    rows = [(int(i), kinds[i % distinct].tolist()) for i in range(600)]
    vectors = topk.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    cells, _, _ = topk._cells(vectors, vectors.filter(F.col("vec_id") % every == 0), 8, 5)
    assert cells.slices(1) > 4 and (cells.band + cells.dealt).max() > 3 and (every == 1 or cells.dealt.max() > 1)
    assert rows_found(spark, rows, every) == brute(rows, every=every)


def generalised_jaccard(a, b):
    a, b = collections.Counter(a.split()), collections.Counter(b.split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_op9_edits_and_likeness(result, documents):
    rows = {r["doc_id"]: r for r in result("op9_fingerprints")}
    backwards = documents[::-1]
    errors = []
    for k, (i, text) in enumerate(backwards):
        after = backwards[(k + 1) % len(backwards)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        r = rows[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == fingerprints.likeness(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == fingerprints.likeness(r["fingerprint"], rows[backwards[(k + 1) % len(backwards)][0]]["fingerprint"])
        errors.append(r["near_edited"] - generalised_jaccard(text, edited))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06
    by_text = collections.defaultdict(set)
    for i, text in documents:
        by_text[text].add(rows[i]["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())


def test_weights_matter():
    from claimweave.llm.fingerprints import _joined, signatures

    pairs = [("a " * 8 + "b", "a " * 4 + "b"), ("a b c d", "a b c d " * 2), ("x y", "y x")]
    for a, b in pairs:
        likeness = []
        for k in range(40):  # other words, other samples
            s = signatures(_joined([a.replace("a", f"a{k}").replace("b", f"b{k}"), b.replace("a", f"a{k}").replace("b", f"b{k}")]))
            likeness.append((s[0] == s[1]).mean())
        assert abs(np.mean(likeness) - generalised_jaccard(a, b)) < 0.03


def test_odd_documents_have_fingerprints(odd, nothing):
    got = [r.asDict() for r in fingerprints.compare(odd).collect()]
    assert len(got) == odd.count()
    empty = {r["fingerprint"] for r in got if r["doc_id"] in (2, 3, 4)}
    assert empty == {"0" * 4 * fingerprints.SAMPLES}
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (8, 9)}) == 1
    assert fingerprints.compare(nothing).isEmpty()
    assert fingerprints.fingerprints(odd).count() == odd.count()
    one = odd.filter("doc_id = 1")
    row = fingerprints.compare(one).first()
    assert row.near_next == 1.0, "a lone document is followed by itself"
