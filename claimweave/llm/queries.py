"""The registered queries of these operators over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm import (
    bpe,
    decontaminate,
    fingerprints,
    jaccard_join,
    lm,
    packing,
    prefix_trie,
    quality,
    repair,
    substring_dedup,
    suffix_dedup,
    topk,
    toxicity,
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.find(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.find(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "row.doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = quality.score(docs, quality.fit(docs))
    return scored.withColumn("keep", (F.col("score") >= 0.5).cast("int"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.filter(toxicity.learnable(F.col("doc_id"))))
    return toxicity.score(docs, model).select(
        "doc_id",
        (~toxicity.learnable(F.col("doc_id"))).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, 5)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(documents(spark, sf_dir))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie.trie(prefix_trie.rebuilt(conversations)).drop("name", "parent")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damaged_and_repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES = (
    op1_substring,
    op2_suffix,
    op3_packing,
    op4_lm,
    op5_jaccard,
    op6_quality,
    op7_toxicity,
    op8_topk,
    op9_fingerprints,
    op10_bpe,
    op11_prefix_trie,
    op12_repair,
    op13_decontaminate,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


OP8 = """
WITH v AS (
  SELECT vec_id, embedding AS e, vec_id % 50 = 0 AS asks
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), w AS (
  SELECT vec_id, asks, list_transform(e, lambda x: floor(256 * x::DOUBLE)) AS e FROM v
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM w q JOIN w c ON q.asks AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


OP11 = """
WITH own AS (
  SELECT conv_id, list({r: coalesce(role, ''), x: coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS seq
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), hashed AS (
  SELECT conv_id, seq, xor(list_reduce(
    flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END,
    4294967295::BIGINT), 4294967295) % 6 AS h
  FROM own
), built AS (
  SELECT c.conv_id, list_concat(coalesce(b.seq, [])[1:c.h], c.seq[c.h + 1:]) AS seq
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), paths AS (
  SELECT conv_id, d, seq[1:d] AS path, len(seq) = d AS ends FROM built, unnest(range(0, len(seq) + 1)) t(d)
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM paths GROUP BY path, d
), children AS (
  SELECT path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), own_values AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children, CASE WHEN n.d = 0 THEN 0 ELSE (n_convs - 1) * length(n.path[n.d].x) END AS saved
  FROM nodes n LEFT JOIN children k ON n.path = k.path
), totals AS (
  SELECT path[1:a] AS path, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM own_values, unnest(range(0, d + 1)) t(a) GROUP BY 1
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves, t.saved_tokens, n.ends_sha256
FROM own_values n JOIN totals t ON n.path = t.path LEFT JOIN nodes p ON p.d = n.d - 1 AND p.path = n.path[1:n.d - 1]
"""

OP13 = r"""
WITH low AS (
  SELECT row_number() OVER () AS r, doc_id, lower_ascii.w
  FROM documents, LATERAL (SELECT coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w) lower_ascii
), items AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) WHERE len(w) > 0
), runs AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM low, (SELECT DISTINCT n FROM windows) s, unnest(range(1, len(w) - n + 2)) t(i)
), found AS (
  SELECT r, i, n, item_id FROM runs JOIN windows USING (n, g)
), hits AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT DISTINCT r, i, n FROM found), unnest(range(i, i + n)) t(p) GROUP BY r
), named AS (
  SELECT r, count(*) AS n, sha256(string_agg(x, ',' ORDER BY x)) AS sha
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(m.n, 0) AS n_items,
  coalesce(m.sha, sha256('')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM low LEFT JOIN hits h USING (r) LEFT JOIN named m USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_topk": OP8, "op11_prefix_trie": OP11, "op13_decontaminate": OP13}
