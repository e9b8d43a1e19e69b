"""Word-bigram cross-entropy difference against a direct version."""

import math
import random
from collections import Counter

import pytest

from tripfunnel.llm import queries, word_score

PLAIN = "the house by a river is old and green water runs over stones while people walk home at night".split()


def direct(target, background, texts):
    """-log P(word | before) of both models by the recursive definition, from plain dictionaries.

    The vocabulary is that of all ``texts``.
    """
    split = lambda t: word_score.TOKEN.findall(t or "")
    often = Counter(w for t in texts for w in split(t))
    known = {w for w, n in often.items() if n > 1}
    size = len(known) + 2
    bigrams = lambda t: list(zip(*[(s := ["<>", *[w if w in known else "?" for w in split(t)], "<>"])[:-1], s[1:]]))

    def model(texts):
        pairs = Counter(p for t in texts for p in bigrams(t))
        single, follows, kinds = Counter(), Counter(), Counter()
        for (a, b), n in pairs.items():
            single[b] += n
            follows[a] += n
            kinds[a] += 1
        total = sum(single.values())

        def p(a, b):
            low = (single[b] + len(single) / size) / (total + len(single)) if total else 1 / size
            return (pairs[a, b] + kinds[a] * low) / (follows[a] + kinds[a]) if follows[a] else low

        return p

    return bigrams, model(target), model(background)


@pytest.mark.parametrize("limits", [{}, {"HOT": 20, "BUCKET": 50, "SLICE": 300}])
@pytest.mark.parametrize("own", [True, False])
def test_word_score_equals_definition(spark, odd, small, monkeypatch, limits, own):
    """With the documents as background each is judged by a model of the others."""
    for name, value in limits.items():
        monkeypatch.setattr(word_score, name, value)
    docs = odd.unionByName(small.limit(30))
    target = spark.createDataFrame([("a mark of the end",), ("the same end",), ("日本",), (None,)], "text string")
    background = None if own else small.limit(50)
    told = docs.withColumn("own", docs["text"])
    rows = [r["text"] for r in docs.collect()]
    targets = [r["text"] for r in target.collect()]
    scored, name = word_score.score(told, target, background)
    found = scored.select("own", f"{name}.*").collect()
    assert sorted(map(str, (r["own"] for r in found))) == sorted(map(str, rows))
    whole = rows if own else [r["text"] for r in background.collect()]
    for r in found:
        others = list(whole)
        if own:
            others.remove(r["own"])
        bigrams, a, b = direct(targets, others, targets + whole)
        tokens = bigrams(r["own"])
        assert r["n_tokens"] == len(tokens)
        for p, loss in ((a, r["target_loss"]), (b, r["background_loss"])):
            assert loss == pytest.approx(sum(-math.log(p(*g)) for g in tokens) / len(tokens), abs=1e-5)
        assert r["score"] == pytest.approx(r["target_loss"] - r["background_loss"], abs=2e-6)


def test_a_copy_vouches_for_its_twin(spark):
    pick = random.Random(1)
    once = [" ".join(pick.choice(PLAIN) + str(pick.randrange(50)) for _ in range(60)) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(once + once[:5])), "doc_id long, text string")
    scored, name = word_score.score(docs, docs.limit(0))
    loss = {r["doc_id"]: r["loss"] for r in scored.select("doc_id", f"{name}.background_loss").withColumnRenamed("background_loss", "loss").collect()}
    twins = [*range(5), *range(30, 35)]
    assert max(loss[i] for i in twins) + 1 < min(loss[i] for i in loss if i not in twins)


def test_word_order_tells_the_target(spark, tmp_path):
    """The same words in another order: nearly the same byte trigrams, other bigrams."""
    one, other = " ".join(PLAIN), " ".join(PLAIN[::-1])
    spark.createDataFrame([(i, one) for i in range(5)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = [(1, one), (2, other)] + [(i, one if i % 2 else other) for i in range(3, 41)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    score = {r["doc_id"]: r["score"] for r in queries.op1_cross_entropy(spark, str(tmp_path)).collect()}
    assert len(score) == 40
    assert score[2] - score[1] > 1.0


def test_word_score_of_odd_tables(spark, clashing, none):
    scored, name = word_score.score(clashing, none, none)
    assert scored.count() == clashing.count() and name not in clashing.columns
    assert scored.columns == [c for c in clashing.columns if c != "text"] + [name]
    assert word_score.score(none, clashing, clashing)[0].count() == 0
    assert word_score.score(none, none)[0].count() == 0
    only, name = word_score.score(clashing.select("text"), clashing)
    assert only.columns == [name] and only.count() == clashing.count()
