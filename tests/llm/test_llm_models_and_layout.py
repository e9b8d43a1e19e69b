"""Classifiers by held-out accuracy; packing, sharding and the pipeline against direct versions."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tripfunnel.llm import fertility, language, packing, pu_quality, queries, sharding, simhash, toxicity
from tripfunnel.llm.common import held_out

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def scored(spark, name, mark, folds, out):
    """Held-out rows of a registered query: scores, predictions and true marks."""
    rows = __spark_entry__.queries()[name](spark, MEDIUM).collect()
    assert len(rows) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    assert all(r["held_out"] == (fold(r["doc_id"], folds) == out) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    true = {r["doc_id"]: r[mark] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    held = [r for r in rows if r["held_out"] and true.get(r["doc_id"]) is not None]
    return np.array([r["score"] for r in held]), np.array([r["predicted"] for r in held]), np.array([true[r["doc_id"]] for r in held])


def auc(score, mark):
    a, b = score[mark == 1], score[mark == 0]
    return np.mean([(a > x).mean() + 0.5 * (a == x).mean() for x in b])


def test_quality_on_held_out_rows(spark):
    score, predicted, true = scored(spark, "op4_pu_quality", "quality", 4, 2)
    assert auc(score, true) > 0.97 and (predicted == true).mean() > 0.95


def test_toxicity_on_held_out_rows(spark):
    score, predicted, true = scored(spark, "op9_kneser_ney", "toxic", 3, 1)
    assert auc(score, true) > 0.8 and (predicted == true).mean() > 0.9 and (predicted[true == 0] == 0).mean() > 0.98


def test_language_on_held_out_rows(spark):
    rows = __spark_entry__.queries()["op5_language"](spark, MEDIUM).collect()
    true = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(true) and all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in rows)
    assert np.mean([r["lang_pred"] == true[r["doc_id"]] for r in held]) > 0.98


def test_prior_estimate_and_non_negative_risk():
    pick = np.random.default_rng(1)
    good, bad = pick.normal(1.5, 1, (2000, pu_quality.SIZE)), pick.normal(-1.5, 1, (600, pu_quality.SIZE))
    model = pu_quality.fit_rows(good[:1000].astype(np.float32), np.concatenate([good[1000:], bad[:500]]).astype(np.float32), steps=150)
    assert abs(model.prior - 2 / 3) < 0.08
    assert (model.scores(good) > 0.5).mean() > 0.98 and (model.scores(bad) < 0.5).mean() > 0.95


def test_risk_gradient_equals_differences_of_the_risk():
    """The gradient against the risk as its formula says, on both sides of the turning point."""
    pick = np.random.default_rng(12)
    p, u = pick.normal(0.4, 1, (60, 5)), pick.normal(-0.2, 1, (90, 5))
    for prior in (0.3, 0.95):
        w, b = pick.normal(size=5), 0.3
        up = lambda x, w, b: np.logaddexp(0, -(x @ w + b)).mean()
        down = lambda x, w, b: np.logaddexp(0, x @ w + b).mean()
        rest = lambda w, b: down(u, w, b) - prior * down(p, w, b)
        sign = 1.0 if rest(w, b) >= 0 else -1.0
        risk = lambda v: prior * up(p, v[:5], v[5]) + sign * rest(v[:5], v[5])
        v = np.append(w, b)
        slope = [(risk(v + h) - risk(v - h)) / 2e-6 for h in np.eye(6) * 1e-6]
        assert pu_quality.risk_gradient(p, u, prior, w, b) == pytest.approx(slope, abs=1e-6)


def test_moments_and_prior_cover_all_rows(spark, small, monkeypatch):
    """A sample of 30 rows teaches, yet the means, deviations and prior are those of all."""
    marks = queries.labels(spark, SMALL).filter("quality = 1").select("doc_id")
    model = pu_quality.fit(small, marks, F.lit(True), most=30)
    rows = pu_quality.features([r["text"] for r in small.collect()]).astype(np.float64)
    assert model.mean == pytest.approx(rows.mean(axis=0), abs=1e-9)
    assert model.scale == pytest.approx(rows.std(axis=0) + 1e-3, abs=1e-6)
    seen = []
    whole = pu_quality.estimate_prior
    monkeypatch.setattr(pu_quality, "estimate_prior", lambda p, u: seen.append((p.sum(), u.sum())) or whole(p, u))
    pu_quality.fit(small, marks, F.lit(True), most=30)
    assert seen == [(small.join(marks.distinct(), "doc_id").count(), small.count())]


def test_kneser_ney_is_a_distribution():
    pick = random.Random(4)
    kinds = [[" ".join(pick.choice(words) for _ in range(30)) for _ in range(80)] for words in ("ab c d e".split(), "ab c f".split())]
    model = toxicity.learn(*kinds, least_word=2, least_pair=3)
    assert model.single.sum(axis=0) == pytest.approx([1, 1])
    size = len(model.number) + 1
    for context in range(size):
        p = np.array([model.spread[context] * model.single[w] for w in range(size)])
        for key, direct in zip(model.pairs, model.direct):
            if key >> 32 == context:
                p[key & 0xFFFFFFFF] += direct
        assert p.sum(axis=0) == pytest.approx([1, 1])
    value = model.evidence(np.array([-1, model.number["d"], -1, model.number["f"], -1, len(model.number)]))
    assert value[1] > 0 > value[3] and value[[0, 2, 4]].tolist() == [0, 0, 0]


def test_classifiers_of_odd_rows(spark, odd, clashing, none):
    marks = spark.createDataFrame([(1, 1, 0), (4, 1, 1), (5, 0, 0), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    every = F.lit(True)
    quality = pu_quality.fit(odd, marks.filter("quality = 1").select("doc_id"), every)
    toxic = toxicity.fit(odd, marks, every)
    spoken = language.fit(odd, every)
    for docs in (odd, clashing, none):
        for frame, name in (pu_quality.score(docs, quality), toxicity.score(docs, toxic)):
            rows = frame.select("doc_id", F.col(name).alias("s")).collect()
            assert len(rows) == docs.count() and all(0 <= r["s"] <= 1 for r in rows)
            assert len({r["s"] for r in rows if r["doc_id"] == 5}) <= 1
        frame, name = language.predict(docs, spoken)
        rows = frame.select("doc_id", f"{name}.*").collect()
        assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 7)} <= {"und"}
        assert all(r["lang_pred"] != "und" for r in rows if r["doc_id"] in (4, 5, 6))
    assert pu_quality.keep(clashing, quality).columns == clashing.columns
    share = toxicity.score(odd, toxicity.fit(none, marks.limit(0), every))[0].collect()
    assert {r[-1] for r in share} == {0.5}
    assert {r[-1] for r in pu_quality.score(odd, pu_quality.fit(none, marks.limit(0).select("doc_id"), every))[0].collect()} == {0.5}
    assert {r[-1]["lang_pred"] for r in language.predict(odd, language.fit(none, every))[0].collect()} == {"und"}
    fitted = spark.createDataFrame([(i,) for i in (1, 2, None)], "doc_id long").select(held_out("doc_id", 4, 2).alias("h")).collect()
    assert [r["h"] for r in fitted] == [fold(1, 4) == 2, fold(2, 4) == 2, True]


def padding(lengths, counts, boundaries):
    return sum(n * (min(b for b in boundaries if b >= x) - x) for x, n in zip(lengths, counts))


def test_boundaries_are_optimal():
    pick = random.Random(6)
    for _ in range(60):
        lengths = sorted(pick.sample(range(0, 40), pick.randint(1, 8)))
        counts = [pick.randint(1, 9) for _ in lengths]
        for buckets in (1, 2, 3, 8):
            ours = packing.choose_boundaries(lengths, counts, buckets)
            assert len(ours) <= buckets and ours[-1] == lengths[-1]
            best = min(
                padding(lengths, counts, [*c, lengths[-1]])
                for k in range(min(buckets, len(lengths)))
                for c in itertools.combinations(lengths[:-1], k)
            )
            assert padding(lengths, counts, ours) == best
    assert packing.choose_boundaries([], [], 4) == []


def check_packed(rows, lengths, budget, most):
    """Every word in one piece; batches full, gapless and within the budget."""
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
    expected = {}
    for doc, n in lengths:
        pieces = [(k, k * most, min(most, n - k * most)) for k in range(max(1, -(-n // most)))]
        expected.setdefault(doc, []).extend(pieces)
    assert {d: sorted(p) for d, p in by_doc.items()} == {d: sorted(p) for d, p in expected.items()}
    for bucket in {r["bucket"] for r in rows}:
        inside = [r for r in rows if r["bucket"] == bucket]
        boundary = {r["boundary"] for r in inside}
        assert len(boundary) == 1 and all(r["length"] <= min(boundary) for r in inside)
        size = max(1, budget // max(1, boundary.pop()))
        places = sorted(r["batch"] * size + r["slot"] for r in inside)
        assert places == list(range(len(inside))) and all(0 <= r["slot"] < size for r in inside)


def words_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_packing(spark, small, odd, none):
    docs = small.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    lengths = [(r["doc_id"], words_of(r["text"])) for r in docs.collect()]
    for options in ({}, {"buckets": 3, "budget": 500, "max_length": 300, "cell_rows": 7}):
        rows = packing.pack(docs, **options).collect()
        check_packed(rows, lengths, options.get("budget", 16384), options.get("max_length", 2048))
        pieces = [r["length"] for r in rows]
        distinct = sorted(set(pieces))
        chosen = packing.choose_boundaries(distinct, [pieces.count(x) for x in distinct], options.get("buckets", 8))
        assert {r["boundary"] for r in rows} == set(chosen)
    assert packing.pack(none).count() == 0
    named = odd.select(F.concat(F.lit("id "), F.col("doc_id").cast("string")).alias("doc_id"), "text")
    check_packed(packing.pack(named).collect(), [(r["doc_id"], words_of(r["text"])) for r in named.collect()], 16384, 2048)


def test_sharding(spark, small, odd, none, tmp_path):
    copies = spark.range(300).select((F.col("id") + 70000).alias("doc_id"), F.lit("one text " * 40).alias("text"))
    docs = small.select("doc_id", "text").unionByName(odd.filter("doc_id is null or doc_id <> 4").select("doc_id", "text")).unionByName(copies)
    texts = sorted((r["text"] or "").encode() for r in docs.collect())
    rows = sharding.assign(docs).collect()
    assert sorted(zip((r["size"] for r in rows), (r["text_crc32"] for r in rows))) == sorted((len(t) + 1, zlib.crc32(t)) for t in texts)
    total = sum(r["size"] for r in rows)
    for shard in range(8):
        inside = [r for r in rows if r["shard"] == shard]
        assert sorted(r["slot"] for r in inside) == list(range(len(inside)))
        assert abs(sum(r["size"] for r in inside) - total / 8) <= 0.02 * total / 8 + max(r["size"] for r in rows)
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
    few = sharding.assign(docs, ranges_per_shard=2, draws=2).collect()  # ranges overfull by chance
    assert len(few) == len(rows) and {r["shard"] for r in few} <= set(range(8))
    sizes = [sum(r["size"] for r in few if r["shard"] == s) for s in range(8)]
    assert max(sizes) < 1.1 * total / 8
    written = sharding.write_shards(odd, str(tmp_path / "shards"), shards=3)
    assert sorted(map(str, (r["text"] for r in written.collect()))) == sorted(map(str, (r["text"] for r in odd.collect())))
    assert sharding.assign(none).count() == 0


def test_pipeline_stages_against_direct_versions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    marks = queries.labels(spark, SMALL)
    model = queries.quality_model(docs, marks)
    ruled = corpus_pipeline.quality_rules(spark, docs, SMALL)
    judged, verdict = fertility.judge(docs)
    expected = {r["doc_id"] for r in judged.filter(F.col(verdict)["kept"]).collect()}
    assert ruled.columns == columns and {r["doc_id"] for r in ruled.collect()} == expected
    good = corpus_pipeline.quality_classifier(spark, ruled, SMALL)
    texts = [(r["doc_id"], r["text"]) for r in ruled.collect()]
    direct = model.scores(pu_quality.features([t for _, t in texts]))
    expected = {i for (i, _), s in zip(texts, np.round(direct, 9)) if s >= 0.7}
    assert good.columns == columns and {r["doc_id"] for r in good.collect()} == expected
    unique = corpus_pipeline.near_duplicates(spark, good, SMALL)
    rows = sorted((r["doc_id"], simhash.fingerprint(r["text"])) for r in good.collect())
    kept = []
    left = dict(rows)
    while left:  # the least id left and all that it reaches
        first = min(left)
        kept.append(first)
        reach = [left.pop(first)]
        while reach:
            f = reach.pop()
            near = [i for i, g in left.items() if (f ^ g).bit_count() <= 3]
            reach += [left.pop(i) for i in near]
    assert unique.columns == columns and sorted(r["doc_id"] for r in unique.collect()) == kept
    packed = corpus_pipeline.pack(spark, unique, SMALL).collect()
    check_packed(packed, [(r["doc_id"], words_of(r["text"])) for r in unique.collect()], 16384, 2048)
    ran = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(map(tuple, ran)) == sorted(map(tuple, packed))


def test_every_operator_is_registered(spark):
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_covers_its_whole_table(spark, name):
    rows = queries.QUERIES[name](spark, SMALL)
    table, key = ("embeddings", "vec_id") if name.startswith(("op3_", "op11_")) else ("documents", "doc_id")
    ids = spark.read.parquet(f"{SMALL}/{table}.parquet").select(key)
    if name.startswith("op13_"):  # anchors with a window that is not empty
        table, key = "embeddings", "anchor_id"
        ids = spark.read.parquet(f"{SMALL}/{table}.parquet").filter("vec_id % 100 = 0").select(F.col("vec_id").alias(key))
        rows = rows.select(key).distinct()
    found = rows.select(key)
    assert ids.exceptAll(found).count() == 0
    if not name.startswith("op6_"):
        assert found.exceptAll(ids).count() == 0
