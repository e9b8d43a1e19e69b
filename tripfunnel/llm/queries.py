"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfunnel.llm import (
    centroids,
    fertility,
    hard_negatives,
    language,
    line_dedup,
    packing,
    pieces,
    pu_quality,
    sharding,
    simhash,
    toxicity,
    vector_dedup,
    word_score,
)
from tripfunnel.llm.common import documents, held_out
from tripfunnel.llm.twins import TWINS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: What SQL can say as a whole; tests compare the other queries with direct versions.
ORACLE: dict[str, str] = {
    "op3_vector_dedup": """
    WITH RECURSIVE vectors AS (
      SELECT row_number() OVER () AS n, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    sound AS (
      SELECT n, label, v, list_dot_product(v, v) AS square FROM vectors
      WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(v, lambda x: x <> 0)) > 0),
    links AS (
      SELECT a.n AS a, b.n AS b FROM sound a JOIN sound b ON a.label = b.label AND a.n <> b.n AND len(a.v) = len(b.v)
      WHERE list_dot_product(a.v, b.v) / (sqrt(a.square) * sqrt(b.square)) >= 0.98::DOUBLE),
    reach AS (
      SELECT n AS a, n AS b FROM vectors UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
    named AS (SELECT r.a, min(v.vec_id) AS component_id FROM reach r JOIN vectors v ON v.n = r.b GROUP BY r.a)
    SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.n) AS n_links, named.component_id,
      v.vec_id IS NOT DISTINCT FROM named.component_id AS kept
    FROM vectors v JOIN named ON named.a = v.n""",
}

ORACLE |= TWINS

#: Score from which a text counts as class 1.
LEAST = 0.7


def register(build):
    QUERIES[build.__name__] = build
    return build


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@register
def op1_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the passages of ``benchmark``; background of a document: all other documents."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored, losses = word_score.score(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return scored.select("doc_id", f"{losses}.*")


@register
def op2_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, verdict = fertility.judge(documents(spark, sf_dir))
    return judged.select("doc_id", f"{verdict}.*")


def quality_model(docs: DataFrame, marks: DataFrame) -> pu_quality.Model:
    """Trusted positives: labelled good. Nothing is learned from the held-out fold."""
    return pu_quality.fit(docs, marks.filter("quality = 1").select("doc_id"), ~held_out("doc_id", 4, 2))


@register
def op4_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored, score = pu_quality.score(docs.select("doc_id", "text"), quality_model(docs, labels(spark, sf_dir)))
    return scored.select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), F.col(score).alias("score"),
        (F.col(score) >= LEAST).cast("int").alias("predicted"),
    )


@register
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit(docs, ~held_out("doc_id", 5, 0))
    found, name = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), f"{name}.*")


@register
def op6_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


@register
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


@register
def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, labels(spark, sf_dir), ~held_out("doc_id", 3, 1))
    scored, score = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), F.col(score).alias("score"),
        (F.col(score) >= LEAST).cast("int").alias("predicted"),
    )


@register
def op3_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@register
def op7_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir)).drop("row")


@register
def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(documents(spark, sf_dir))


@register
def op11_threshold_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(*centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


@register
def op12_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(documents(spark, sf_dir))


@register
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row's label is moved by one first, as its contract has it."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label=label)
