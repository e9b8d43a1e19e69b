"""Churn: features, labels, boosted trees, scores with explanations."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfunnel.functions.scalar import clock, days_between, minutes_between, risk_level
from tripfunnel.models.explain import read_trees, tree_attributions
from tripfunnel.session import scratch_path

# The model's features, in order.
FEATURES = (
    "sessions_7d",
    "sessions_30d",
    "sessions_90d",
    "searches_total",
    "clicks_total",
    "conversions_total",
    "search_to_click_ratio",
    "click_to_conversion_ratio",
    "avg_session_duration_mins",
    "days_since_last_activity",
    "lifetime_value",
    "unique_destinations_searched",
    "mobile_session_ratio",
    "weekend_session_ratio",
)
PLACEHOLDER_MINUTES = 15.0


def churn_events(searches: DataFrame, clicks: DataFrame, conversions: DataFrame) -> DataFrame:
    """All events of known users in one narrow table."""

    def part(df: DataFrame, kind: str, **extra) -> DataFrame:
        empty = {"query": "string", "platform": "string", "booking_value": "decimal(10,2)"}
        return df.filter(F.col("user_id").isNotNull()).select(
            "user_id",
            "session_id",
            F.lit(kind).alias("event_type"),
            "event_timestamp",
            *[
                (F.col(extra[c]) if c in extra else F.lit(None)).cast(t).alias(c)
                for c, t in empty.items()
            ],
        )

    return (
        part(searches, "search", query="search_query", platform="platform")
        .unionByName(part(clicks, "click"))
        .unionByName(part(conversions, "conversion", booking_value="booking_value"))
    )


def churn_features(events: DataFrame, as_of=None, placeholder_duration: bool = False) -> DataFrame:
    """One row of features per user.

    Events are rolled up per user and session first, which turns "sessions with an event
    in the last n days" into a test on the session's newest event: no distinct counts.
    ``placeholder_duration`` sets the constant 15 minutes instead of the real average.
    """
    now = clock(as_of)
    at = F.col("event_timestamp")
    kind = F.col("event_type")
    per_session = events.groupBy("user_id", "session_id").agg(
        F.min(at).alias("_first"),
        F.max(at).alias("_last"),
        F.count(F.lit(1)).alias("_events"),
        F.count_if(kind == "search").alias("_searches"),
        F.count_if(kind == "click").alias("_clicks"),
        F.count_if(kind == "conversion").alias("_conversions"),
        F.sum("booking_value").alias("_value"),
        F.count_if(F.col("platform").isin("ios", "android")).alias("_mobile"),
        F.count_if(F.weekday(at).isin(5, 6)).alias("_weekend"),
    )
    queries = (
        events.filter(F.col("query").isNotNull())
        .select("user_id", "query")
        .distinct()
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("_queries"))
    )

    def sessions_since(days: int):
        fresh = F.col("_last") > now - F.make_dt_interval(days=F.lit(days))
        return F.count_if(F.col("session_id").isNotNull() & fresh)

    minutes = minutes_between(F.col("_last"), F.col("_first"))
    per_user = per_session.groupBy("user_id").agg(
        sessions_since(7).alias("sessions_7d"),
        sessions_since(30).alias("sessions_30d"),
        sessions_since(90).alias("sessions_90d"),
        F.sum("_searches").alias("searches_total"),
        F.sum("_clicks").alias("clicks_total"),
        F.sum("_conversions").alias("conversions_total"),
        F.avg(F.when(F.col("session_id").isNotNull(), minutes)).alias("_minutes"),
        F.max("_last").alias("_last"),
        F.sum("_value").alias("_value"),
        F.sum("_events").alias("_events"),
        F.sum("_mobile").alias("_mobile"),
        F.sum("_weekend").alias("_weekend"),
    )

    def share(numerator: str, denominator: Column) -> Column:
        return F.col(numerator).cast("double") / denominator

    duration = (
        F.lit(PLACEHOLDER_MINUTES) if placeholder_duration else F.coalesce("_minutes", F.lit(0.0))
    )
    return per_user.join(queries, "user_id", "left").select(
        "user_id",
        "sessions_7d",
        "sessions_30d",
        "sessions_90d",
        "searches_total",
        "clicks_total",
        "conversions_total",
        share("clicks_total", F.greatest("searches_total", F.lit(1))).alias("search_to_click_ratio"),
        share("conversions_total", F.greatest("clicks_total", F.lit(1))).alias(
            "click_to_conversion_ratio"
        ),
        duration.alias("avg_session_duration_mins"),
        F.floor(days_between(now, F.col("_last"))).alias("days_since_last_activity"),
        F.coalesce(F.col("_value").cast("double"), F.lit(0.0)).alias("lifetime_value"),
        F.coalesce("_queries", F.lit(0)).alias("unique_destinations_searched"),
        share("_mobile", F.col("_events")).alias("mobile_session_ratio"),
        share("_weekend", F.col("_events")).alias("weekend_session_ratio"),
    )


def churn_training_set(
    events: DataFrame, cutoff, horizon_days: float, placeholder_duration: bool = False
) -> DataFrame:
    """Features as of ``cutoff`` and ``churned`` = 1 for users without any event in the
    ``horizon_days`` after it.
    """
    at = F.col("event_timestamp")
    moment = clock(cutoff)
    until = moment + F.make_dt_interval(secs=F.lit(horizon_days * 86400))
    features = churn_features(events.filter(at < moment), cutoff, placeholder_duration)
    returned = (
        events.filter((at >= moment) & (at < until))
        .select("user_id")
        .distinct()
        .withColumn("_back", F.lit(0))
    )
    return (
        features.join(returned, "user_id", "left")
        .withColumn("churned", F.coalesce("_back", F.lit(1)))
        .drop("_back")
    )


class ChurnModel:
    """Gradient-boosted trees over z-scored features, with per-user explanations."""

    def __init__(
        self, max_iter: int = 100, max_depth: int = 6, step_size: float = 0.1, seed: int = 42,
        features: Sequence[str] = FEATURES, label: str = "churned",
    ):
        self.params = {
            "max_iter": max_iter, "max_depth": max_depth, "step_size": step_size, "seed": seed,
            "features": list(features), "label": label,
        }
        self.features = tuple(features)
        self.label = label
        self.pipeline: PipelineModel | None = None

    def fit(self, training: DataFrame) -> ChurnModel:
        p = self.params
        self.pipeline = Pipeline(
            stages=[
                VectorAssembler(inputCols=list(self.features), outputCol="_raw"),
                StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
                GBTClassifier(
                    featuresCol="_scaled", labelCol=self.label, maxIter=p["max_iter"],
                    maxDepth=p["max_depth"], stepSize=p["step_size"], seed=p["seed"],
                ),
            ]
        ).fit(training)
        return self

    @property
    def trees(self):
        return self.pipeline.stages[-1]

    def score(self, users: DataFrame) -> DataFrame:
        """Adds ``churn_probability``, ``prediction`` and ``risk_level``."""
        chance = vector_to_array("probability")[1]
        scored = self.pipeline.transform(users).withColumn("churn_probability", chance)
        return scored.select(
            *users.columns,
            "churn_probability",
            "prediction",
            risk_level(F.col("churn_probability")).alias("risk_level"),
        )

    def explain(self, users: DataFrame, top: int = 5, key: str = "user_id") -> DataFrame:
        """Scores with ``top_factors``: the features that moved the margin most, with
        signed impact, direction and raw value; ``base_margin`` + all impacts = margin.
        """
        spark = users.sparkSession
        path = scratch_path(spark, "trees")
        self.trees.write().save(path)
        trees = read_trees(spark, path, list(self.trees.treeWeights))
        attribute = tree_attributions(trees, len(self.features))
        base = float(trees.base)

        @F.pandas_udf("array<double>")
        def impacts(vectors: pd.Series) -> pd.Series:
            import numpy as np

            return pd.Series(list(attribute(np.stack(vectors.to_numpy()))))

        prepared = self.pipeline.transform(users).withColumn(
            "_impacts", impacts(vector_to_array("_scaled"))
        )
        factors = F.array(
            *[
                F.struct(
                    F.lit(name).alias("feature"),
                    F.col("_impacts")[i].alias("impact"),
                    F.when(F.col("_impacts")[i] > 0, "increases").otherwise("decreases")
                    .alias("direction"),
                    F.col(name).cast("double").alias("value"),
                )
                for i, name in enumerate(self.features)
            ]
        )
        strongest = F.array_sort(
            factors,
            lambda a, b: F.when(F.abs(a["impact"]) > F.abs(b["impact"]), -1)
            .when(F.abs(a["impact"]) < F.abs(b["impact"]), 1)
            .when(a["feature"] < b["feature"], -1)
            .when(a["feature"] > b["feature"], 1)
            .otherwise(0),
        )
        chance = vector_to_array("probability")[1]
        return prepared.select(
            key,
            chance.alias("churn_probability"),
            risk_level(chance).alias("risk_level"),
            F.slice(strongest, 1, top).alias("top_factors"),
            F.lit(base).alias("base_margin"),
            F.aggregate("_impacts", F.lit(0.0), lambda acc, v: acc + v).alias("impact_sum"),
            (vector_to_array("rawPrediction")[1]).alias("margin"),
        )

    def feature_importance(self, spark: SparkSession) -> DataFrame:
        rows = [(n, float(v)) for n, v in zip(self.features, self.trees.featureImportances.toArray())]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(
            F.col("importance").desc(), "feature"
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark.createDataFrame([(json.dumps(self.params),)], "meta string").write.mode(
            "overwrite"
        ).json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ChurnModel:
        meta = json.loads(spark.read.schema("meta string").json(f"{path}/meta").first()[0])
        model = cls(**meta)
        model.pipeline = PipelineModel.load(f"{path}/pipeline")
        return model
