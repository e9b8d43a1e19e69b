"""Matrix-factorisation, content and hybrid recommenders over a rating table."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Normalizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripfunnel.models.blocks import top_items
from tripfunnel.operators.rows import top_n_per_group
from tripfunnel.session import scratch_path

# Implicit ratings per event kind.
SEARCH_RATING, CLICK_RATING, CONVERSION_RATING = 1.0, 3.0, 5.0


def interactions(searches: DataFrame, clicks: DataFrame, conversions: DataFrame) -> DataFrame:
    """``(user_id, item_id, rating)`` per event: queries searched, destinations clicked
    and destinations booked (found through the click behind the conversion).
    """
    known = F.col("user_id").isNotNull()
    searched = searches.filter(known).select(
        "user_id", F.col("search_query").alias("item_id"), F.lit(SEARCH_RATING).alias("rating")
    )
    clicked = clicks.filter(known).select(
        "user_id", F.col("result_destination").alias("item_id"), F.lit(CLICK_RATING).alias("rating")
    )
    booked = conversions.filter(F.col("click_event_id").isNotNull()).select("click_event_id")
    converted = (
        clicks.filter(known)
        .join(booked, F.col("event_id") == F.col("click_event_id"))
        .select(
            "user_id",
            F.col("result_destination").alias("item_id"),
            F.lit(CONVERSION_RATING).alias("rating"),
        )
    )
    return (
        searched.unionByName(clicked)
        .unionByName(converted)
        .filter(F.col("item_id").isNotNull())
    )


def ratings(interaction_rows: DataFrame) -> DataFrame:
    """One rating per user and item: the strongest signal."""
    return interaction_rows.groupBy("user_id", "item_id").agg(F.max("rating").alias("rating"))


def user_history(interaction_rows: DataFrame) -> DataFrame:
    """The items each user touched, a row for each."""
    return interaction_rows.select("user_id", "item_id").distinct()


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _weighted_sums(rating_rows: DataFrame, vectors: DataFrame, given: str, wanted: str) -> DataFrame:
    """Per ``wanted`` id the sum of rating times vector over its ``given`` ids."""
    scaled = F.transform("v", lambda x: x * F.col("rating"))
    summed = rating_rows.join(vectors, given).groupBy(wanted).agg(Summarizer.sum(array_to_vector(scaled)).alias("v"))
    return summed.select(wanted, vector_to_array("v").alias("v"))


def _gram(vectors: DataFrame) -> np.ndarray:
    """Sum of the vectors' outer products: width times width numbers, added up in Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            rows = np.array(batch.column(0).to_pylist(), dtype=float)
            if len(rows):
                total = rows.T @ rows + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], names=["g"])

    parts = vectors.select("v").mapInArrow(partial, "g array<double>")
    sums = parts.select(F.posexplode("g").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()
    flat = np.array([r["x"] for r in sorted(sums, key=lambda r: r["at"])])
    return flat.reshape(math.isqrt(len(flat)), -1)


def _turned(vectors: DataFrame, key: str, matrix: np.ndarray) -> DataFrame:
    """Every vector times a small matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column(1).to_pylist(), dtype=float).reshape(batch.num_rows, matrix.shape[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((rows @ matrix).tolist(), pa.list_(pa.float64()))], names=[key, "v"])

    return vectors.select(key, "v").mapInArrow(run, f"{key} string, v array<double>")


def _orthonormal(vectors: DataFrame, key: str) -> DataFrame:
    """The vectors' columns made orthonormal, dependent ones left out; twice, for accuracy."""
    for _ in range(2):
        values, basis = np.linalg.eigh(_gram(vectors))
        some = values > 1e-14 * values.max(initial=0.0)
        vectors = _stored(_turned(vectors, key, basis[:, some] / np.sqrt(values[some])), "basis")
    return vectors


class SvdRecommender:
    """Truncated SVD of the user × item matrix (missing = 0); seen items stay in.

    Randomised subspace iteration on the rating rows: a random basis of ``k + oversample`` columns over the
    items is multiplied by the matrix and its transpose, each a join and a sum, and made orthonormal by
    its Gram matrix. Ids stay as they are, and only matrices of that small width pass through the driver.
    With as many columns as items the basis is complete and the result exact without iterating.
    """

    def __init__(self, k: int = 50, oversample: int = 10, iterations: int = 8):
        self.k, self.oversample, self.iterations = k, oversample, iterations
        self.factors: DataFrame | None = None  # item_id and v, one column of V per number
        self.singular_values = np.zeros(0)

    def fit(self, rating_rows: DataFrame) -> SvdRecommender:
        rows = _stored(rating_rows.select(F.col("user_id"), F.col("item_id").cast("string").alias("item_id"), "rating"), "ratings")
        items = _stored(rows.select("item_id").distinct(), "items")
        n = items.count()
        width = min(self.k + self.oversample, n)
        hashed = lambda j: F.pmod(F.xxhash64("item_id", j), F.lit(1 << 52)) / float(1 << 51) - 1.0
        basis = items.withColumn("v", F.transform(F.sequence(F.lit(1), F.lit(max(1, width))), hashed))
        if n:
            basis = _orthonormal(basis, "item_id")
            for _ in range(self.iterations if width < n else 0):
                by_user = _weighted_sums(rows, basis, "item_id", "user_id")
                basis = _orthonormal(_stored(_weighted_sums(rows, by_user, "user_id", "item_id"), "basis"), "item_id")
            values, turn = np.linalg.eigh(_gram(_weighted_sums(rows, basis, "item_id", "user_id")))
            best = np.argsort(-values)[: self.k]
            self.singular_values = np.sqrt(np.maximum(values[best], 0.0))
            basis = _stored(_turned(basis, "item_id", turn[:, best]), "factors")
        self.factors = basis
        return self

    def item_factors(self) -> DataFrame:
        return self.factors.select("item_id", F.col("v").alias("item_vector"))

    def user_factors(self, rating_rows: DataFrame) -> DataFrame:
        """Each user's row times V."""
        summed = _weighted_sums(rating_rows, self.factors, "item_id", "user_id")
        return summed.select("user_id", F.col("v").alias("user_vector"))

    def recommend(self, rating_rows: DataFrame, top_n: int = 10) -> DataFrame:
        return top_items(self.user_factors(rating_rows), self.item_factors(), top_n)

    def save(self, spark: SparkSession, path: str) -> None:
        self.factors.write.mode("overwrite").parquet(f"{path}/items")
        meta = json.dumps({"k": self.k, "s": self.singular_values.tolist()})
        spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SvdRecommender:
        meta = json.loads(spark.read.schema("meta string").json(f"{path}/meta").first()[0])
        model = cls(meta["k"])
        model.factors = spark.read.parquet(f"{path}/items")
        model.singular_values = np.array(meta["s"])
        return model


def number_ids(df: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct ``key`` values with a dense integer, the same on every run.

    Values are ranked inside 4096 digest buckets; only the bucket sizes are added up in
    one place.
    """
    ids = df.select(key).distinct().withColumn("_digest", F.md5(F.col(key).cast("binary")))
    ids = ids.withColumn("_bucket", F.substring("_digest", 1, 3))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ids.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    nth = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", key)) - 1
    return ids.withColumn("_nth", nth).join(offsets, "_bucket").select(
        key, (F.col("_offset") + F.col("_nth")).alias(name)
    )


class AlsRecommender:
    """Alternating least squares on implicit ratings, for catalogues beyond the SVD's bound."""

    def __init__(self, rank: int = 50, max_iter: int = 10, reg: float = 0.1, seed: int = 42):
        self.als = ALS(
            rank=rank, maxIter=max_iter, regParam=reg, seed=seed, implicitPrefs=True,
            userCol="_user", itemCol="_item", ratingCol="rating",
        )

    def fit(self, rating_rows: DataFrame) -> AlsRecommender:
        self.users = number_ids(rating_rows, "user_id", "_user")
        self.items = number_ids(rating_rows, "item_id", "_item")
        numbered = rating_rows.join(self.users, "user_id").join(self.items, "item_id")
        self.model = self.als.fit(numbered.select("_user", "_item", "rating"))
        return self

    def recommend(self, top_n: int = 10) -> DataFrame:
        """``(user_id, item_id, score, rank)`` for every user; seen items stay in."""
        best = self.model.recommendForAllUsers(top_n).select(
            "_user", F.posexplode("recommendations").alias("_pos", "_best")
        )
        return (
            best.select("_user", "_best.*", (F.col("_pos") + 1).alias("rank"))
            .join(self.users, "_user")
            .join(self.items, "_item")
            .select("user_id", "item_id", F.col("rating").cast("double").alias("score"), "rank")
        )


class ContentRecommender:
    """Mean cosine similarity to the liked items over standardised item features.

    The mean of cosines is the dot product with the mean unit vector, so no item-item
    matrix is needed: a user is one vector, whatever the size of the history.
    """

    def __init__(self, features: Sequence[str]):
        self.features = tuple(features)
        self.vectors: DataFrame | None = None

    def fit(self, items: DataFrame) -> ContentRecommender:
        """Z-scores (population deviation, 0 counts as 1), then unit length."""
        stats = items.agg(
            *[F.avg(c).alias(f"m_{c}") for c in self.features],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in self.features],
        ).first()
        scaled = items.select(
            "item_id",
            *[
                ((F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0)).alias(c)
                for c in self.features
            ],
        )
        raw = VectorAssembler(inputCols=list(self.features), outputCol="_z").transform(scaled)
        unit = Normalizer(inputCol="_z", outputCol="unit").transform(raw)
        self.vectors = unit.select("item_id", "unit")
        return self

    def profiles(self, pairs: DataFrame) -> DataFrame:
        """Per user the mean of the liked items' unit vectors, and how many they are (``extra``)."""
        return (
            pairs.join(self.vectors, "item_id")
            .groupBy("user_id")
            .agg(Summarizer.mean(F.col("unit")).alias("_mean"), F.count(F.lit(1)).alias("extra"))
            .select("user_id", vector_to_array("_mean").alias("user_vector"), "extra")
        )

    def item_vectors(self) -> DataFrame:
        return self.vectors.select("item_id", vector_to_array("unit").alias("item_vector"))

    def recommend(self, likes: DataFrame, top_n: int = 10) -> DataFrame:
        """Top items for every user in ``likes (user_id, item_id)``; liked items score -1."""
        pairs = likes.select("user_id", "item_id").distinct()
        return top_items(self.profiles(pairs), self.item_vectors(), top_n, pairs)

    def save(self, path: str) -> None:
        self.vectors.select(
            "item_id", vector_to_array("unit").alias("unit"), F.lit(",".join(self.features)).alias("f")
        ).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ContentRecommender:
        stored = spark.read.parquet(path)
        model = cls(stored.select("f").first()[0].split(","))
        model.vectors = stored.select("item_id", array_to_vector("unit").alias("unit"))
        return model


def blend(
    collaborative: DataFrame, content: DataFrame, top_n: int = 10,
    collaborative_weight: float = 0.6, content_weight: float = 0.4,
) -> DataFrame:
    """Weighted sum of two scored lists; an item missing on one side scores 0 there."""
    left = collaborative.select("user_id", "item_id", F.col("score").alias("_cf"))
    right = content.select("user_id", "item_id", F.col("score").alias("_content"))
    score = (
        F.coalesce("_cf", F.lit(0.0)) * collaborative_weight
        + F.coalesce("_content", F.lit(0.0)) * content_weight
    )
    mixed = left.join(right, ["user_id", "item_id"], "full_outer").select(
        "user_id", "item_id", score.alias("score")
    )
    return top_n_per_group(
        mixed, ["user_id"], [F.col("score").desc_nulls_last(), F.col("item_id").asc()], top_n
    )


class HybridRecommender:
    """Blends both recommenders over all items.

    A blended score is one dot product: of the user's factors and mean liked vector, weighted and put end
    to end, with the item's factors and unit vector. So users are scored in place, as for either list alone,
    and neither list is built. Liked items, whose content score is -1, are scored by pair.
    """

    def __init__(
        self, features: Sequence[str], k: int = 50, collaborative_weight: float = 0.6, content_weight: float = 0.4
    ):
        self.svd = SvdRecommender(k)
        self.content = ContentRecommender(features)
        self.weights = (collaborative_weight, content_weight)

    def fit(self, rating_rows: DataFrame, items: DataFrame) -> HybridRecommender:
        self.svd.fit(rating_rows)
        self.content.fit(items)
        return self

    def recommend(self, rating_rows: DataFrame, top_n: int = 10) -> DataFrame:
        collaborative, content = self.weights
        pairs = rating_rows.select("user_id", "item_id").distinct()
        factors = _stored(self.svd.item_factors().select("item_id", F.col("item_vector").alias("_cf")), "items")
        units = _stored(self.content.item_vectors().select("item_id", F.col("item_vector").alias("_content")), "items")
        widths = [(t.agg(F.max(F.size(c))).first()[0] or 0) for t, c in ((factors, "_cf"), (units, "_content"))]

        def joined(cf: DataFrame, other: DataFrame, key: str, *more: Column) -> DataFrame:
            """Both sides' vectors end to end; a side that is missing counts as zeros."""
            sides = [F.coalesce(c, F.array_repeat(F.lit(0.0), w)) for c, w in zip(("_cf", "_content"), widths)]
            return cf.join(other, key, "full_outer").select(key, F.concat(*sides).alias("_v"), *more)

        scaled = lambda c, w: F.transform(c, lambda x: x * w)
        by_factor = self.svd.user_factors(rating_rows).select("user_id", scaled("user_vector", collaborative).alias("_cf"))
        by_taste = self.content.profiles(pairs).select("user_id", scaled("user_vector", content).alias("_content"), "extra")
        users = joined(by_factor, by_taste, "user_id", F.coalesce("extra", F.lit(0)).alias("extra"))
        items = joined(factors, units, "item_id").withColumnRenamed("_v", "item_vector")
        # What a liked item with features scores: its collaborative part, and -1 for its content.
        part = F.aggregate(F.zip_with("_u", "_cf", lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)
        liked = (
            pairs.join(units.select("item_id"), "item_id")
            .join(factors, "item_id", "left")
            .join(by_factor.select("user_id", F.col("_cf").alias("_u")), "user_id", "left")
            .select("user_id", "item_id", (F.coalesce(part, F.lit(0.0)) - content).alias("score"))
        )
        return top_items(users.withColumnRenamed("_v", "user_vector"), items, top_n, liked)

    def recommendations(self, rating_rows: DataFrame, top_n: int = 10) -> DataFrame:
        """One row per user: ranked items with scores, and the algorithm's name."""
        entry = F.struct("rank", "item_id", F.col("item_id").alias("destination"), "score")
        return (
            self.recommend(rating_rows, top_n)
            .groupBy("user_id")
            .agg(F.array_sort(F.collect_list(entry)).alias("recommendations"))
            .withColumn("scores", F.col("recommendations.score"))
            .withColumn("algorithm", F.lit("hybrid"))
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.svd.save(spark, f"{path}/collaborative")
        self.content.save(f"{path}/content")
        meta = json.dumps({"weights": self.weights})
        spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> HybridRecommender:
        meta = json.loads(spark.read.schema("meta string").json(f"{path}/meta").first()[0])
        content = ContentRecommender.load(spark, f"{path}/content")
        model = cls(content.features, 50, *meta["weights"])
        model.svd = SvdRecommender.load(spark, f"{path}/collaborative")
        model.content = content
        return model
