"""The pipeline's stages, each against what its operator says, and all in a row."""

import collections
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import corpus_pipeline
from claimweave.llm import jaccard_join, quality, toxicity
from claimweave.llm.shared import stored

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before the first stage and after each."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name)
        out.append(docs)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns and df.dtypes == steps[0].dtypes


def test_filters_drop_what_their_models_reject(spark, steps):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = toxicity.fit(steps[0], labels.filter(toxicity.learnable(F.col("doc_id"))))
    assert ids(steps[1]) == ids(toxicity.score(steps[0], model).filter("score < 0.5"))
    judged = quality.score(steps[1], quality.fit(steps[1]))
    assert ids(steps[2]) == ids(judged.filter("score >= 0.5"))


def test_one_of_each_component_stays(steps):
    links = jaccard_join.link(steps[2]).collect()
    firsts = sorted({r.component_id for r in links if r.n_shingles} | {r.doc_id for r in links if not r.n_shingles})
    assert ids(steps[3]) == firsts


def test_no_repeat_of_400_bytes_is_left_out(steps):
    """Brute force over the texts before the stage; the bytes of a cut character go too."""
    raw = {r.doc_id: r.text.encode() for r in steps[3].collect()}
    windows = collections.Counter(b[i : i + 400] for b in raw.values() for i in range(len(b) - 399))
    after = {r.doc_id: r for r in steps[4].collect()}
    assert set(after) == set(raw)
    for i, b in raw.items():
        gone = bytearray(len(b))
        for p in range(len(b) - 399):
            if windows[b[p : p + 400]] > 1:
                gone[p : p + 400] = b"\1" * 400
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g).decode(errors="ignore")
        assert after[i].text == kept and after[i].n_chars == len(kept)


def test_packing_holds_all_that_is_left(spark, steps):
    assert {r.doc_id for r in steps[5].collect()} == set(ids(steps[4]))
    again = corpus_pipeline.run(spark, SF_DIR)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert again.groupBy("doc_id").agg(F.sum("length").alias("n")).orderBy("doc_id").collect() == (
        steps[5].groupBy("doc_id").agg(F.sum("length").alias("n")).orderBy("doc_id").collect()
    )
    assert set(columns) <= set(again.columns)


def test_stages_take_odd_and_no_documents(spark, odd, nothing):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_DIR)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
        assert isinstance(corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).schema, StructType)


def test_stages_are_in_the_order_asked_for():
    assert [re.sub("_.*", "", n) for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near", "repeats", "packing"]
    assert "pipeline" in corpus_pipeline.queries()
