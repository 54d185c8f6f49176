"""The queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir import tune

from . import (
    crossparse,
    dart_minhash,
    mixing,
    neighbours,
    packing,
    periodic,
    pii,
    secret_scan,
    segments,
    sharding,
    spans,
    suffixes,
    topk,
    toxicity,
)

TOXIC_FROM = 0.7

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(tune(spark), sf_dir)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score",
                         (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


@query
def op2_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


@query
def op3_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


ORACLES["op3_norm_buckets"] = """
WITH whole AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.vec, v.vec) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM whole WHERE vec_id % 20 = 0) q
  JOIN (SELECT DISTINCT * FROM whole) v ON q.vec_id <> v.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20"""


@query
def op4_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def _digest(found: DataFrame, kinds: list[str]) -> DataFrame:
    """The counts of the base kinds, their digest and the list of all spans."""
    base, both = F.col("base"), F.concat("base", "added")
    return found.select(
        "doc_id", *[spans.count_of(base, k).alias(f"n_{kind}") for k, kind in enumerate(kinds[:-1])],
        F.sha2(F.encode(spans.listed(base, kinds), "UTF-8"), 256).alias("base_sha256"),
        spans.listed(both, kinds).alias("spans"))


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(secret_scan.scan(table(spark, sf_dir, "documents")), secret_scan.KINDS)


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(pii.find_personal(table(spark, sf_dir, "documents")), pii.KINDS)


@query
def op7_lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.lpt_shards(table(spark, sf_dir, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("size"))
    return mixing.mix(docs, size=F.col("size")).select("doc_id", "source", "size", "mix.*")


@query
def op9_suffix_radix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op11_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = crossparse.identify(docs, crossparse.learn(docs))
    return found.select("doc_id", crossparse.held_out().alias("held_out"), "lang_pred", "score")


@query
def op12_segment_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return segments.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=moved)


ORACLES["op12_segment_negatives"] = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
    CAST(list_inner_product(a.vec, v.vec) AS BIGINT) AS score
  FROM (SELECT * FROM whole WHERE vec_id % 100 = 0) a JOIN whole v ON a.vec_id <> v.vec_id),
positives AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same)
  WHERE place <= 5),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 5"""


@query
def op13_suffix_tree_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(periodic.repeat_tails(table(spark, sf_dir, "documents")))
    return found.select("doc_id", *periodic.digest())
