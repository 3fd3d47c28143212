"""A training corpus from raw documents: STAGES in order, each over all that the one before kept.

toxicity drops documents whose passages are significantly toxic, quality those that the weak-label
classifier takes for bad, near_duplicates all but the first document of each component of linked
n-gram sets, repeats the bytes of passages of 400 bytes or more that stand elsewhere too, and
packing cuts the rest into sequences of 2048 tokens.

All but packing return the columns of `documents`, n_chars brought up to date where text changes.
A document without text has no words to judge: toxicity keeps it, quality drops it. A null doc_id
has no place in a component's order and stays; copies of a row are dropped with their component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm import jaccard_join, packing, quality, suffix_dedup, toxicity
from claimweave.llm.shared import stored

#: No SQL expresses the stages; tests compare them with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of the documents that may be learned from, drops what scores 0.5 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.filter(toxicity.learnable(F.col("doc_id"))))
    return toxicity.without_toxic(docs, model)


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of the smallest doc_id of each component."""
    return jaccard_join.first_of_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated bytes; a character that is cut in two goes as a whole."""
    kept = suffix_dedup.without_repeats(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_bad),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", drop_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
