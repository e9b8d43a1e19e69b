import random

import pytest

from tripfunnel.plans import recommendations as cf


def affinity(spark, weights):
    return spark.createDataFrame(
        [(u, d, w) for u, row in weights.items() for d, w in row.items()],
        "user_id string, destination string, signal_strength double",
    )


def brute_force(weights, min_shared=2):
    scores, similar = {}, {}
    for a, wa in weights.items():
        for b, wb in weights.items():
            shared = wa.keys() & wb.keys()
            if a == b or len(shared) < min_shared:
                continue
            likeness = sum(wa[d] * wb[d] for d in shared)
            n, total = similar.get(a, (0, 0.0))
            similar[a] = (n + 1, total + likeness)
            for d in wb.keys() - wa.keys():
                raw, users = scores.get((a, d), (0.0, 0))
                scores[a, d] = (raw + likeness * wb[d], users + 1)
    return scores, similar


def random_weights(seed, users, places, most):
    rng = random.Random(seed)
    return {
        f"u{i}": {f"d{p}": rng.choice([0.5, 1.0]) for p in rng.sample(range(places), rng.randint(1, most))}
        for i in range(users)
    }


@pytest.mark.parametrize("block, min_shared", [(2, 2), (5, 3), (4096, 1), (4096, 2)])
def test_set_products_equal_all_user_pairs(spark, block, min_shared):
    weights = random_weights(block, 60, 9, 6)
    want, similar = brute_force(weights, min_shared)
    table = affinity(spark, weights)
    got = {
        (r["user_id"], r["destination"]): (r["raw_score"], r["supporting_users"])
        for r in cf.recommendation_candidates(table, min_shared, block).collect()
    }
    assert got == want
    stats = {
        r["user_id"]: (r["similar_users"], r["similarity_total"])
        for r in cf.user_similarity(table, min_shared, block).collect()
    }
    assert stats == similar


def test_a_third_of_all_users_with_one_profile(spark):
    weights = random_weights(11, 40, 6, 4)
    weights.update({f"same{i}": {"d0": 1.0, "d1": 0.5, "d2": 0.5} for i in range(20)})
    want, _ = brute_force(weights)
    got = {
        (r["user_id"], r["destination"]): (r["raw_score"], r["supporting_users"])
        for r in cf.recommendation_candidates(affinity(spark, weights), 2, 3).collect()
    }
    assert got == want


def test_threshold_top_n_and_normalisation(spark):
    rows = [("u", "a", 4.0, 2), ("u", "b", 2.0, 1), ("u", "c", 1.0, 1), ("u", "d", 2.0, 3), ("w", "a", 1.0, 1)]
    candidates = spark.createDataFrame(
        rows, "user_id string, destination string, raw_score double, supporting_users long"
    )
    ranked = cf.rank_candidates(candidates, "2024-01-01 00:00:00", top_n=2).orderBy("rank").collect()
    assert [(r["recommended_destination"], r["recommendation_score"]) for r in ranked] == [("a", 1.0), ("b", 0.5)]


def test_nobody_shares_enough(spark):
    table = affinity(spark, {"a": {"x": 1.0, "y": 1.0}, "b": {"x": 0.5, "z": 1.0}, "c": {"q": 1.0}})
    assert cf.recommendation_candidates(table).count() == 0
    assert cf.user_similarity(table).count() == 0


def test_thousands_of_destinations_and_no_two_users_alike(spark):
    rng = random.Random(21)
    weights = {}
    for i in range(1500):
        places = {min(4999, int(rng.paretovariate(0.35))) for _ in range(rng.randint(3, 9))}
        weights[f"u{i}"] = {f"d{p}": rng.choice([0.5, 1.0]) for p in places}
    assert len({tuple(sorted(w)) for w in weights.values()}) > 1200
    want, similar = brute_force(weights)
    table = affinity(spark, weights)
    got = {
        (r["user_id"], r["destination"]): (r["raw_score"], r["supporting_users"])
        for r in cf.recommendation_candidates(table, 2, 200).collect()
    }
    assert got == want
    stats = {r["user_id"]: (r["similar_users"], r["similarity_total"]) for r in cf.user_similarity(table).collect()}
    assert stats == similar


def test_the_plan_has_few_shuffles(spark):
    table = affinity(spark, random_weights(1, 20, 6, 4))
    ranked = cf.rank_candidates(cf.recommendation_candidates(table), "2024-01-01 00:00:00")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") < 10


@pytest.mark.parametrize("most_popular, min_shared", [(0, 2), (2, 2), (3, 1), (3, 3), (5, 2), (16, 3)])
def test_masks_and_pairs_together_equal_all_user_pairs(spark, monkeypatch, most_popular, min_shared):
    monkeypatch.setattr(cf, "PAIR_COST", 10**9)  # as many bits as allowed
    weights = random_weights(100 + most_popular, 50, 8, 6)
    want, similar = brute_force(weights, min_shared)
    table = affinity(spark, weights)
    got = {
        (r["user_id"], r["destination"]): (r["raw_score"], r["supporting_users"])
        for r in cf.recommendation_candidates(table, min_shared, 7, most_popular).collect()
    }
    assert got == want
    stats = {
        r["user_id"]: (r["similar_users"], r["similarity_total"])
        for r in cf.user_similarity(table, min_shared, 7, most_popular).collect()
    }
    assert stats == similar


def test_a_small_catalogue_makes_no_pairs_of_sets(spark, monkeypatch):
    """However many users there are and however their profiles differ."""

    def no_pairs(*_):
        raise AssertionError("pairs of sets were built")

    monkeypatch.setattr(cf, "set_meetings", no_pairs)
    weights = random_weights(31, 600, 13, 12)
    want, similar = brute_force(weights)
    table = affinity(spark, weights)
    got = {
        (r["user_id"], r["destination"]): (r["raw_score"], r["supporting_users"])
        for r in cf.recommendation_candidates(table).collect()
    }
    assert got == want
    stats = {r["user_id"]: (r["similar_users"], r["similarity_total"]) for r in cf.user_similarity(table).collect()}
    assert stats == similar
