"""What SQL can state about fitted models: sums, orders, bands and labels that hold row by row."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import inputs, sql
from registry.more_queries import CHURN_EVENTS, _churn, _today
from registry.queries import ABANDONED, EV, _recommendations, register
from registry.sql import AS_OF, select
from tripfunnel.models import churn, sentiment
from tripfunnel.operators import activation
from tripfunnel.session import scratch_path
from tripfunnel.sources.events_adapter import read_table

NEAR = 1e-6


@register(
    "abandoned_newest",
    sql.query(
        EV, ABANDONED,
        final="SELECT * FROM (" + select("user_id last_search_query last_search_time:ts search_count", "abandoned") +
        ") ORDER BY last_search_time DESC, user_id, last_search_query NULLS LAST LIMIT 1000",
    ),
)
def abandoned_newest(spark, sf_dir):
    """The extract of the newest 1,000, as the mail run asks for it."""
    searches, _, conversions = inputs.all_staged(spark, sf_dir)
    return activation.abandoned_searches(searches, conversions, AS_OF, limit=1000)


@register(
    "reco_extract",
    sql.query(
        EV, *sql.CF,
        final="""SELECT user_id, recommended_destination, recommendation_score, rank,
        row_number() OVER (ORDER BY user_id, rank) AS position FROM recommendations""",
    ),
)
def reco_extract(spark, sf_dir):
    """Recommendations as the sync reads them: by user and rank. ``position`` is counted over the stored files."""
    path = scratch_path(spark, "reco-extract")
    activation.reco_extract(_recommendations(spark, sf_dir)).write.parquet(path)
    stored = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at"))
    # A file is a range of users: rows before it are those of the files before.
    sizes = {r["file"]: r["rows"] for r in stored.groupBy("file").agg(F.count(F.lit(1)).alias("rows")).collect()}
    before, total = [], 0
    for file in sorted(sizes):
        before.append((file, total))
        total += sizes[file]
    offsets = spark.createDataFrame(before, "file string, before long")
    first = stored.groupBy("file").agg(F.min("at").alias("first"))
    placed = stored.join(F.broadcast(first.join(offsets, "file")), "file")
    return placed.select(
        "user_id", "recommended_destination", "recommendation_score", "rank",
        (F.col("at") - F.col("first") + F.col("before") + 1).alias("position"),
    )


@register(
    "churn_margins",
    sql.query(
        EV, CHURN_EVENTS,
        final="SELECT DISTINCT user_id, TRUE AS impacts_add_up, TRUE AS chance_of_margin, TRUE AS band_of_chance FROM acts",
    ),
)
def churn_margins(spark, sf_dir):
    """Base and impacts add up to the margin, whose logistic is the probability, which lies in its band."""
    explained = _churn(spark, sf_dir).explain(_today(spark, sf_dir), 5)
    chance, band = F.col("churn_probability"), F.col("risk_level")
    return explained.select(
        "user_id",
        (F.abs(F.col("base_margin") + F.col("impact_sum") - F.col("margin")) < NEAR).alias("impacts_add_up"),
        (F.abs(1 / (1 + F.exp(-2 * F.col("margin"))) - chance) < NEAR).alias("chance_of_margin"),
        (
            ((band == "low") & (chance < 0.3)) | ((band == "medium") & (chance >= 0.3) & (chance < 0.7))
            | ((band == "high") & (chance >= 0.7))
        ).alias("band_of_chance"),
    )


@register(
    "churn_top_factors",
    sql.query(
        EV, CHURN_EVENTS,
        final="SELECT DISTINCT user_id, 5 AS factors, TRUE AS strongest_first, TRUE AS direction_of_sign, TRUE AS values_of_user FROM acts",
    ),
)
def churn_top_factors(spark, sf_dir):
    """Five different features, the strongest first, with the direction of their sign and the user's own value."""
    users = _today(spark, sf_dir)
    own = F.create_map(*[x for f in churn.FEATURES for x in (F.lit(f), F.col(f).cast("double"))])
    explained = _churn(spark, sf_dir).explain(users, 5).join(users.select("user_id", own.alias("own")), "user_id")
    top = F.col("top_factors")
    strength = F.transform(top, lambda t: F.abs(t["impact"]))
    return explained.select(
        "user_id",
        F.size(F.array_distinct(F.transform(top, lambda t: t["feature"]))).alias("factors"),
        (strength == F.reverse(F.array_sort(strength))).alias("strongest_first"),
        F.forall(top, lambda t: (t["direction"] == "increases") == (t["impact"] > 0)).alias("direction_of_sign"),
        F.forall(top, lambda t: t["value"] == F.col("own")[t["feature"]]).alias("values_of_user"),
    )


@register(
    "churn_importance_total",
    f"SELECT CAST({len(churn.FEATURES)} AS BIGINT) AS features, 1.0::DOUBLE AS total, TRUE AS within_bounds",
)
def churn_importance_total(spark, sf_dir):
    return _churn(spark, sf_dir).feature_importance(spark).agg(
        F.countDistinct("feature").alias("features"),
        F.round(F.sum("importance"), 6).alias("total"),
        F.bool_and(F.col("importance").between(0, 1)).alias("within_bounds"),
    )


@register(
    "churn_reloaded",
    sql.query(EV, CHURN_EVENTS, final="SELECT DISTINCT user_id, TRUE AS same_score, TRUE AS same_band FROM acts"),
)
def churn_reloaded(spark, sf_dir):
    """A saved model scores as the one it was saved from."""
    model, path = _churn(spark, sf_dir), scratch_path(spark, "churn-model")
    model.save(spark, path)
    users = _today(spark, sf_dir)
    kept = model.score(users).select("user_id", F.col("churn_probability").alias("p"), F.col("risk_level").alias("band"))
    again = churn.ChurnModel.load(spark, path).score(users)
    return kept.join(again, "user_id").select(
        "user_id", (F.col("p") == F.col("churn_probability")).alias("same_score"), (F.col("band") == F.col("risk_level")).alias("same_band")
    )


@register(
    "sentiment_labels",
    """SELECT doc_id, TRUE AS likeliest, TRUE AS confidence_of_label, TRUE AS chances_add_up,
      (SELECT string_agg(q, ',' ORDER BY q) FROM (SELECT DISTINCT CAST(quality AS VARCHAR) AS q
        FROM labels JOIN documents USING (doc_id) WHERE quality IS NOT NULL)) AS labels FROM documents""",
)
def sentiment_labels(spark, sf_dir):
    """The label of every document is the likeliest of those learnt, its confidence that label's probability."""
    documents = read_table(spark, sf_dir, "documents")
    labelled = documents.join(read_table(spark, sf_dir, "labels"), "doc_id").select(
        "text", F.col("quality").cast("string").alias("sentiment")
    )
    scored = sentiment.SentimentModel(max_iter=20).fit(labelled).transform(documents.select("doc_id", "text"))
    chances = F.map_values("probabilities")
    return scored.select(
        "doc_id",
        (F.col("probabilities")[F.col("predicted_sentiment")] == F.array_max(chances)).alias("likeliest"),
        (F.col("confidence") == F.col("probabilities")[F.col("predicted_sentiment")]).alias("confidence_of_label"),
        (F.abs(F.aggregate(chances, F.lit(0.0), lambda a, c: a + c) - 1) < NEAR).alias("chances_add_up"),
        F.array_join(F.array_sort(F.map_keys("probabilities")), ",").alias("labels"),
    )
