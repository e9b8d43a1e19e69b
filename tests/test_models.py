import random
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripfunnel.models import churn, recommender, sentiment, splits
from tripfunnel.models.blocks import top_items
from tripfunnel.models.evaluation import classifier_metrics
from tripfunnel.models.explain import read_trees


def rating_rows(spark, seed=1, users=12, items=6):
    rng = random.Random(seed)
    rows = [
        (f"u{u}", f"i{i}", float(rng.choice([1, 3, 5])))
        for u in range(users) for i in rng.sample(range(items), rng.randint(1, items - 2))
    ]
    return spark.createDataFrame(rows, "user_id string, item_id string, rating double"), rows


def matrix_of(rows):
    users, items = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    m = np.zeros((len(users), len(items)))
    for u, i, x in rows:
        m[users.index(u), items.index(i)] = x
    return users, items, m


def test_svd_scores_equal_the_rank_k_reconstruction(spark, tmp_path):
    df, rows = rating_rows(spark)
    users, items, m = matrix_of(rows)
    model = recommender.SvdRecommender(k=3).fit(df)
    model.save(spark, str(tmp_path / "svd"))
    u, s, vt = np.linalg.svd(m, full_matrices=False)
    want = (u[:, :3] * s[:3]) @ vt[:3]
    for fitted in (model, recommender.SvdRecommender.load(spark, str(tmp_path / "svd"))):
        for r in fitted.recommend(df, len(items)).collect():
            assert r["score"] == pytest.approx(want[users.index(r["user_id"]), items.index(r["item_id"])], abs=1e-8)
    assert model.singular_values == pytest.approx(s[:3])


def test_svd_at_full_width_gives_the_ratings_back(spark):
    df, rows = rating_rows(spark, seed=5, users=9, items=8)
    model = recommender.SvdRecommender(k=50).fit(df)
    ratings = {(u, i): x for u, i, x in rows}
    best = {}
    for r in model.recommend(df, 4).collect():
        assert r["score"] == ratings.get((r["user_id"], r["item_id"]), 0.0)
        best.setdefault(r["user_id"], []).append((-r["score"], r["item_id"]))
    for user, found in best.items():
        items = {i for _, i, _ in rows}
        assert sorted(found) == sorted((-ratings.get((user, i), 0.0), i) for i in items)[:4]
    empty = recommender.SvdRecommender(k=3).fit(df.limit(0))
    assert empty.recommend(df.limit(0)).count() == 0


def test_svd_finds_the_leading_space_of_a_larger_matrix(spark):
    pick = np.random.default_rng(2)
    m = pick.normal(size=(80, 4)) @ pick.normal(size=(4, 60)) + 0.05 * pick.normal(size=(80, 60))
    rows = [(f"u{u:02d}", f"i{i:02d}", float(m[u, i])) for u in range(80) for i in range(60)]
    model = recommender.SvdRecommender(k=4, oversample=4, iterations=4).fit(spark.createDataFrame(rows, "user_id string, item_id string, rating double"))
    _, s, vt = np.linalg.svd(m)
    assert model.singular_values == pytest.approx(s[:4], rel=1e-6)
    v = np.array([r["v"] for r in model.factors.orderBy("item_id").collect()])
    assert v.T @ v == pytest.approx(np.eye(4), abs=1e-9)
    assert v @ v.T == pytest.approx(vt[:4].T @ vt[:4], abs=1e-4)


def test_als_ranks_what_similar_users_took(spark):
    rows = [(f"a{u}", f"x{i}", 5.0) for u in range(8) for i in range(5) if (u + i) % 5]
    rows += [(f"b{u}", f"y{i}", 5.0) for u in range(8) for i in range(5) if (u + i) % 5]
    df = spark.createDataFrame(rows, "user_id string, item_id string, rating double")
    numbered = recommender.number_ids(df, "user_id", "n")
    assert sorted(r["n"] for r in numbered.collect()) == list(range(16))
    best = recommender.AlsRecommender(rank=2, max_iter=8).fit(df).recommend(5).collect()
    assert len(best) == 80
    assert all({"a": "x", "b": "y"}[r["user_id"][0]] == r["item_id"][0] for r in best)


FEATURES = ["price", "beach", "same"]


def item_table(spark, n=6):
    rng = random.Random(3)
    rows = [(f"i{i}", rng.random(), rng.random(), 1.0) for i in range(n)]
    return spark.createDataFrame(rows, "item_id string, price double, beach double, same double"), rows


def test_content_scores_equal_the_mean_of_cosines(spark):
    items, rows = item_table(spark)
    x = np.array([r[1:] for r in rows])
    std = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(std == 0, 1, std)
    unit = z / np.linalg.norm(z, axis=1, keepdims=True)
    cosine = unit @ unit.T
    likes = spark.createDataFrame([("u", "i0"), ("u", "i2"), ("u", "i2"), ("v", "i5"), ("v", "unknown")], "user_id string, item_id string")
    got = {(r["user_id"], r["item_id"]): r["score"] for r in recommender.ContentRecommender(FEATURES).fit(items).recommend(likes, 6).collect()}
    for user, liked in (("u", [0, 2]), ("v", [5])):
        for i in range(6):
            want = -1.0 if i in liked else cosine[liked, i].mean()
            assert got[user, f"i{i}"] == pytest.approx(want)


def test_block_size_does_not_change_the_winners(spark):
    rng = np.random.default_rng(4)
    users = spark.createDataFrame([(f"u{i}", rng.normal(size=3).tolist(), i % 7) for i in range(25)], "user_id string, user_vector array<double>, extra long")
    items = spark.createDataFrame([(f"i{i:02d}", rng.normal(size=3).tolist()) for i in range(17)], "item_id string, item_vector array<double>")
    one = top_items(users, items, 5).collect()
    many = top_items(users, items, 5, block=4, most=0).collect()
    # A user who likes a third of the items: what is left comes first, then the liked ones at -1.
    liked = spark.createDataFrame([(f"u{i}", f"i{j:02d}") for i in range(25) for j in range(i % 7)], "user_id string, item_id string")
    for options in ({}, {"block": 4, "most": 0}):
        masked = top_items(users, items, 17, liked, -9.0, **options).collect()
        assert len(masked) == 25 * 17 and sum(r["score"] == -9.0 for r in masked) == liked.count()
    key = lambda rows: sorted((r["user_id"], r["rank"], r["item_id"], round(r["score"], 9)) for r in rows)
    assert key(one) == key(many) and len(one) == 125


def test_hybrid_blends_and_survives_saving(spark, tmp_path):
    df, _ = rating_rows(spark)
    items, _ = item_table(spark, 8)  # two that nobody rated
    items = items.filter("item_id <> 'i2'")  # and one without features
    model = recommender.HybridRecommender(FEATURES, k=3).fit(df, items)
    whole = recommender.blend(model.svd.recommend(df, 99), model.content.recommend(df, 99), 4).collect()
    blended = lambda rows: sorted((r["user_id"], r["rank"], r["item_id"], round(r["score"], 6)) for r in rows)
    assert blended(model.recommend(df, 4).collect()) == blended(whole)
    cf = {(r["user_id"], r["item_id"]): r["score"] for r in model.svd.recommend(df, 99).collect()}
    content = {(r["user_id"], r["item_id"]): r["score"] for r in model.content.recommend(df, 99).collect()}
    got = {(r["user_id"], r["item_id"]): r["score"] for r in model.recommend(df, 2).collect()}
    for pair, score in got.items():
        assert score == pytest.approx(0.6 * cf.get(pair, 0) + 0.4 * content.get(pair, 0))
    model.save(spark, str(tmp_path / "h"))
    again = recommender.HybridRecommender.load(spark, str(tmp_path / "h"))
    rows = {r["user_id"]: r for r in again.recommendations(df, 2).collect()}
    assert rows["u0"]["algorithm"] == "hybrid" and len(rows["u0"]["scores"]) == 2


def churn_table(spark, n=120):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        x = [rng.random() for _ in range(3)]
        rows.append((f"u{i}", *x, int(x[0] + 0.5 * x[1] * x[2] > 0.7)))
    return spark.createDataFrame(rows, "user_id string, a double, b double, c double, churned int")


def shapley_by_definition(tree, x, weight):
    """All subsets; a feature outside the subset follows the cover of the children."""
    used = sorted({n["feature"] for n in tree.values() if n["left"] >= 0})

    def pay(at, known):
        n = tree[at]
        if n["left"] < 0:
            return n["prediction"]
        left, right = tree[n["left"]], tree[n["right"]]
        if n["feature"] in known:
            return pay(n["left"] if x[n["feature"]] <= n["threshold"] else n["right"], known)
        return (left["cover"] * pay(n["left"], known) + right["cover"] * pay(n["right"], known)) / n["cover"]

    out = np.zeros(len(x))
    k = len(used)
    for f in used:
        for size in range(k):
            for some in combinations([g for g in used if g != f], size):
                share = factorial(size) * factorial(k - size - 1) / factorial(k)
                out[f] += share * weight * (pay(0, {*some, f}) - pay(0, set(some)))
    return out


def test_explanations_are_shapley_values_and_add_up(spark, tmp_path):
    table = churn_table(spark)
    model = churn.ChurnModel(max_iter=4, max_depth=3, features=["a", "b", "c"]).fit(table)
    explained = {r["user_id"]: r for r in model.explain(table, 3).collect()}
    for r in explained.values():
        assert r["base_margin"] + r["impact_sum"] == pytest.approx(r["margin"])
        sizes = [abs(f["impact"]) for f in r["top_factors"]]
        assert sizes == sorted(sizes, reverse=True)
    path = str(tmp_path / "trees")
    model.trees.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", F.col("nodeData.rawCount").alias("cover"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    ).collect()
    trees = {}
    for n in nodes:
        trees.setdefault(n["treeID"], {})[n["id"]] = n
    scaled = model.pipeline.transform(table.limit(5)).select("user_id", "_scaled").collect()
    for row in scaled:
        want = sum(shapley_by_definition(t, row["_scaled"].toArray(), model.trees.treeWeights[i]) for i, t in trees.items())
        got = {f["feature"]: f["impact"] for f in explained[row["user_id"]]["top_factors"]}
        assert [got[n] for n in "abc"] == pytest.approx(list(want))
    assert read_trees(spark, path, list(model.trees.treeWeights)).leaves


def test_churn_scores_importance_and_reload(spark, tmp_path):
    table = churn_table(spark)
    model = churn.ChurnModel(max_iter=5, max_depth=3, features=["a", "b", "c"]).fit(table)
    scored = model.score(table)
    metrics = classifier_metrics(scored, "churned", "prediction", "churn_probability").first()
    assert metrics["auc"] > 0.9 and metrics["accuracy"] > 0.85
    assert model.feature_importance(spark).first()["feature"] == "a"
    model.save(spark, str(tmp_path / "churn"))
    again = churn.ChurnModel.load(spark, str(tmp_path / "churn")).score(table)
    assert again.exceptAll(scored).count() == 0


def test_churn_features_of_one_user(spark):
    rows = [
        ("u", "s1", "search", "2024-01-27 10:00:00", "q1", "ios", None),
        ("u", "s1", "click", "2024-01-27 10:10:00", None, None, None),
        ("u", "s2", "search", "2024-01-01 10:00:00", "q1", "web", None),
        ("u", None, "conversion", "2023-12-01 10:00:00", None, None, 50.0),
    ]
    events = spark.createDataFrame(rows, "user_id string, session_id string, event_type string, t string, query string, platform string, booking_value double")
    events = events.withColumn("event_timestamp", F.col("t").cast("timestamp"))
    r = churn.churn_features(events, "2024-01-30 09:59:59").first()
    assert (r["sessions_7d"], r["sessions_30d"], r["sessions_90d"]) == (1, 2, 2)
    assert r["days_since_last_activity"] == 2 and r["unique_destinations_searched"] == 1
    assert r["avg_session_duration_mins"] == 5.0 and r["mobile_session_ratio"] == 0.25
    assert r["weekend_session_ratio"] == 0.5 and r["lifetime_value"] == 50.0
    assert churn.churn_features(events, "2024-01-30 09:59:59", True).first()["avg_session_duration_mins"] == 15.0


def test_sentiment_chances_are_of_the_labels_alone(spark):
    """They add up to one, whatever the number of labels; rows without a label teach nothing."""
    for labels in (["a"], ["a", "b"], ["a", "b", "c"]):
        rows = [(f"word{x} thing{x} more{i}", x) for i in range(20) for x in labels] + [("nothing here", None)]
        df = spark.createDataFrame(rows, "text string, sentiment string")
        scored = sentiment.SentimentModel(max_terms=100, max_iter=20, stop_words=()).fit(df).transform(df).collect()
        for r in scored:
            assert sorted(r["probabilities"]) == labels
            assert abs(sum(r["probabilities"].values()) - 1) < 1e-9
            assert r["sentiment"] in (r["predicted_sentiment"], None)


def test_sentiment_learns_three_labels_and_reloads(spark, tmp_path):
    good, bad, so = "amazing lovely stay", "terrible rude staff", "okay average room"
    rows = [(f"{text} number{i}", label) for i in range(12) for text, label in ((good, "positive"), (bad, "negative"), (so, "neutral"))]
    rows += [(good, "positive")] * 10
    df = spark.createDataFrame(rows, "text string, sentiment string")
    model = sentiment.SentimentModel(max_terms=200, max_iter=50).fit(df)
    scored = model.transform(df)
    assert scored.filter("predicted_sentiment != sentiment").count() == 0
    row = scored.first()
    assert sum(row["probabilities"].values()) == pytest.approx(1.0) and set(row["probabilities"]) == {"positive", "negative", "neutral"}
    model.save(spark, str(tmp_path / "s"))
    again = sentiment.SentimentModel.load(spark, str(tmp_path / "s")).transform(df)
    assert again.select("text", "predicted_sentiment").exceptAll(scored.select("text", "predicted_sentiment")).count() == 0


def test_terms_are_words_and_pairs_without_stop_words(spark):
    df = spark.createDataFrame([("The Été, a big_room!",), ("x",), ("",)], "text string")
    rows = [r["terms"] for r in sentiment.with_terms(df, "text", ["the"]).collect()]
    assert sorted(rows, key=len, reverse=True)[0] == ["été", "big_room", "été big_room"] and [] in rows


def test_frequent_terms_are_those_of_the_full_count(spark):
    """Whatever was guessed and however few buckets there are; ties in alphabetical order."""
    rng = random.Random(5)
    rows = [([f"t{min(int(rng.paretovariate(0.7)), 400)}" for _ in range(rng.randint(0, 30))],) for _ in range(600)]
    df = spark.createDataFrame([*rows, ([],), (["hot"] * 4000,), *[(["copy", "copy", "rare"],)] * 200], "terms array<string>")
    full = sorted(sentiment.vocabulary(df).collect(), key=lambda r: (-r["tf"], r["term"]))
    for size in (1, 150, 5000):
        for buckets, guess_rows in ((1, 30), (64, 5), (2**20, 10_000)):
            found = sentiment.frequent_terms(df, size, buckets, guess_rows).collect()
            assert sorted(found, key=lambda r: (-r["tf"], r["term"])) == full[:size]
    assert sentiment.frequent_terms(df.limit(0), 5).count() == 0


def test_terms_of_all_documents_are_not_listed_when_the_guess_is_good(spark, monkeypatch):
    """Only the sampled documents' terms are sorted and counted by term."""
    calls = []
    occurrences = sentiment._occurrences
    rows = [([f"t{j}" for j in range(i % 20)],) for i in range(300)]
    df = spark.createDataFrame(rows, "terms array<string>")
    full = sorted(sentiment.vocabulary(df).collect(), key=lambda r: (-r["tf"], r["term"]))
    monkeypatch.setattr(sentiment, "_occurrences", lambda d: calls.append(d) or occurrences(d))
    found = sentiment.frequent_terms(df, 4, guess_rows=200).collect()
    assert sorted(found, key=lambda r: (-r["tf"], r["term"])) == full[:4]
    assert len(calls) == 1


def test_splits_are_exact_stable_and_by_user(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 2)).alias("label"))
    split = splits.stratified_split(df, "label", "k")
    shares = {r["label"]: (r["n"], r["t"]) for r in split.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert all(t == int(n * 0.2 + 0.5) for n, t in shares.values()) and split.count() == 1000
    other = splits.stratified_split(df.repartition(7), "label", "k")
    assert split.exceptAll(other).count() == 0
    held = splits.user_holdout(df.withColumn("user_id", F.col("k") % 50))
    assert held.groupBy("user_id").agg(F.countDistinct("is_test").alias("n")).filter("n > 1").count() == 0
