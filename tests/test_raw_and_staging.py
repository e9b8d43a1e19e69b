import json

import pytest

from builders import raw_table, search
from pyspark.sql import functions as F

from tripfunnel.operators import staging
from tripfunnel.sources import raw, reviews
from tripfunnel.sources.catalog import Catalog
from tripfunnel.sources.id_index import IdIndex


def lines_of(spark, texts):
    return spark.createDataFrame([(t, "f.jsonl") for t in texts], "line string, source_file string")


def test_jsonl_drops_blank_lines_and_tolerates_a_missing_path(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"event_id":"a"}\n   \n\n{"event_id":"b"}\n')
    read = raw.read_jsonl(spark, str(tmp_path / "x.jsonl"))
    assert sorted(r["line"] for r in read.collect()) == ['{"event_id":"a"}', '{"event_id":"b"}']
    missing = raw.read_jsonl(spark, str(tmp_path / "none.jsonl"))
    assert missing.columns == read.columns and missing.count() == 0


def test_ingest_sorts_lines_into_new_known_and_rejected(spark):
    existing = spark.createDataFrame([("a",)], "event_id string")
    texts = ['{"event_id":"a"}', '{"event_id":"b"}', '{"event_id":"b"}', "{broken", '{"x":1}', '{"event_id":null}', "[1]"]
    result = raw.ingest_incremental(lines_of(spark, texts), existing, "b1", "2024-01-01 00:00:00")
    assert [r["event_id"] for r in result.new_rows.collect()] == ["b"]
    reasons = sorted(r["reason"] for r in result.rejects.collect())
    assert reasons == ["malformed_json", "malformed_json", "missing_event_id", "missing_event_id"]
    m = result.metrics.first()
    assert (m["lines_read"], m["inserted"], m["already_known"]) == (7, 1, 2)


def test_ingesting_twice_adds_nothing(spark):
    lines = lines_of(spark, [json.dumps(search(str(i), "2024-01-01T00:00:00Z")) for i in range(20)])
    empty = spark.createDataFrame([], "event_id string")
    first = raw.ingest_incremental(lines, empty, "b1").new_rows
    again = raw.ingest_incremental(lines, first, "b2").new_rows
    assert (first.count(), again.count()) == (20, 0)


def test_staging_types_trims_and_keeps_nulls(spark):
    doc = search("a", "2024-01-01T10:00:00.250000Z", user=None, query="  Hotels In MIAMI ")
    row = staging.stage_search(raw_table(spark, [doc])).first()
    assert row["user_id"] is None and row["search_query"] == "hotels in miami"
    assert row["results_count"] == 10 and row["geo_country"] == "CA" and row["utm_medium"] is None
    assert row["event_timestamp"].microsecond == 250000


def test_dedupe_keeps_the_latest_version_and_is_idempotent(spark):
    old = raw_table(spark, [search("a", "2024-01-01T00:00:00Z", query="old")])
    new = raw_table(spark, [search("a", "2024-01-01T00:00:00Z", query="new")], "2024-01-02 00:00:00")
    staged = staging.stage_search(old.unionByName(new).unionByName(new))
    assert [r["search_query"] for r in staged.collect()] == ["new"]


def test_dedupe_tie_gives_the_same_winner_in_any_order(spark):
    docs = [search("a", "2024-01-01T00:00:00Z", query=f"q{i}") for i in range(8)]
    winners = {
        staging.stage_search(raw_table(spark, order).repartition(n)).first()["search_query"]
        for order, n in ((docs, 1), (docs[::-1], 3), (docs[3:] + docs[:3], 5))
    }
    assert len(winners) == 1


def test_bad_values_go_to_rejects_and_do_not_hide_a_good_version(spark):
    good = raw_table(spark, [search("a", "2024-01-01T00:00:00Z")])
    bad = raw_table(spark, [search("a", "2024-01-01T00:00:00Z", results_count="many")], "2024-01-02 00:00:00")
    both = good.unionByName(bad)
    assert staging.stage_search(both).first()["results_count"] == 10
    rejected = staging.staging_rejects(both, "search").collect()
    assert [r["bad_fields"] for r in rejected] == ["results_count"]


def test_staging_of_nothing_has_the_full_schema(spark):
    empty = raw_table(spark, [search("a", "2024-01-01T00:00:00Z")]).filter(F.lit(False))
    staged = staging.stage_search(empty)
    assert staged.count() == 0 and len(staged.columns) == 16


def test_reviews_survive_quotes_commas_and_line_breaks(spark, tmp_path):
    texts = ['plain', 'a "quoted", text', 'two\nlines', '  padded  ']
    df = spark.createDataFrame([(t, "positive") for t in texts], "text string, sentiment string")
    reviews.write_reviews(df, str(tmp_path / "r"))
    back = reviews.read_reviews(spark, str(tmp_path / "r"))
    assert sorted(r["text"] for r in back.collect()) == sorted(texts)


def test_catalog_resolves_names_and_overrides(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path), {"raw.other": str(tmp_path / "elsewhere")})
    assert catalog.resolve("raw.events").endswith("/raw/events")
    assert catalog.resolve("raw.other").endswith("/elsewhere")
    assert catalog.materialize(spark.range(3).toDF("n"), "marts.numbers").count() == 3


BROKEN = (
    '{"event_id": "a", "query": "cut', "no event", '[{"event_id": "a"}]', "tru", "NaN", '{"event_id": "a"} tail',
    '{"event_id": "a"} {"event_id": "b"}', '{"event_id": "a"}, {"event_id": "b"}', '{"event_id": "a"}}', '{"event_id": "a"}}, {',
    '{"event_id": "a"}], [{"event_id": "b"}', "{'event_id': 'a'}", '{"event_id": "a"}}{', "",
)


def test_only_one_whole_object_is_an_event(spark):
    good = ('{"event_id": "a"}', '  {"event_id": "a", "x": [1, {"y": "}"}]}  ', '{"event_id": "a]}"}')
    df = spark.createDataFrame([(t,) for t in (*BROKEN, *good)], "line string")
    found = {r["line"]: r["ok"] for r in df.select("line", raw.is_json_object(F.col("line")).alias("ok")).collect()}
    assert found == {**dict.fromkeys(BROKEN, False), **dict.fromkeys(good, True)}


def test_load_refuses_or_sets_aside_what_is_no_event(spark, tmp_path):
    lines = [*BROKEN[:-1], '{"event_id": "good"}', '{"event_id": ""}', "{}"]
    spark.createDataFrame([(t,) for t in lines], "value string").coalesce(1).write.text(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        raw.load_raw(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    loaded = raw.load_raw(spark, str(tmp_path / "in"), str(tmp_path / "out"), rejects=str(tmp_path / "rejects"))
    assert [r["event_id"] for r in loaded.collect()] == ["good"]
    reasons = [r["reason"] for r in spark.read.parquet(str(tmp_path / "rejects")).collect()]
    assert sorted(reasons) == ["malformed_json"] * (len(BROKEN) - 1) + ["missing_event_id"] * 2


def test_one_strict_rule_for_a_line(spark):
    good = ['{"event_id":"a"}', ' {"a":{"b":[1,2]}} ', '{}', '{"a":"}],5"}']
    bad = ['{"a":1},{"b":2}', '{"a":1},"b":2', '{"a":1}} x', '{"a":1}] x', '{"a":1},5] x', "[1]", "5", "", "{", '{"a":1}{"b":2}', "{'a':1}", '{"a":01}']
    rows = spark.createDataFrame([(t, True) for t in good] + [(t, False) for t in bad] + [(None, False)], "line string, ok boolean")
    assert rows.filter(raw.is_json_object(F.col("line")) != F.col("ok")).collect() == []


def leaves(df):
    found = df._jdf.queryExecution().sparkPlan().collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def ids_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "event_id string")


def test_an_index_reads_the_buckets_of_a_small_batch_and_shuffles_only_the_batch(spark, tmp_path):
    index = IdIndex(spark, str(tmp_path / "ids"), ids_per_bucket=500)
    assert not index.whole() and index.ids().count() == 0
    index.rebuild(ids_of(spark, [f"e{i}" for i in range(8000)] + [None, "e1"]))
    assert index.whole() and index.ids().count() == 8000
    small = index.among(ids_of(spark, ["e5", "x", None]))
    assert [r["event_id"] for r in small.collect()] == ["e5"]
    (scan,) = [leaf for leaf in leaves(small) if leaf.nodeName().startswith("Scan parquet")]
    assert scan.optionalBucketSet().get().cardinality() <= 2 and scan.relation().bucketSpec().get().numBuckets() == 32
    lines = lines_of(spark, [json.dumps({"event_id": f"e{i}"}) for i in range(7000, 9500)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        new = raw.ingest_incremental(lines, index, "b").new_rows
        plan = new._jdf.queryExecution().executedPlan().toString()
        table_side = plan[plan.rindex("LeftSemi"):]
        scan = next(line for line in table_side.splitlines() if "FileScan parquet" in line)
        before = table_side[:table_side.index(scan)]
        assert "Bucketed: true" in scan and "Exchange" not in before, plan
        assert sorted(r["event_id"] for r in new.collect()) == sorted(f"e{i}" for i in range(8000, 9500))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_an_index_grows_merges_and_notices_a_lost_run(spark, tmp_path):
    index = IdIndex(spark, str(tmp_path / "ids"), ids_per_bucket=50, most_files=3)
    index.rebuild(ids_of(spark, []))
    for batch in range(8):
        with index.adding(ids_of(spark, [f"{batch}-{i}" for i in range(300)])):
            pass
    assert index.whole() and index.ids().count() == index.ids().distinct().count() == 2400
    (generation,) = [p.name for p in (tmp_path / "ids").iterdir()]
    assert int(generation.split("-")[0]) > 1 and int(generation.split("-")[1]) > 8
    with pytest.raises(ValueError):
        with index.adding(ids_of(spark, ["lost"])):
            raise ValueError("the executor of the raw write")
    assert not index.whole()
    index.rebuild(ids_of(spark, ["lost"]))
    assert index.whole() and [r["event_id"] for r in index.ids().collect()] == ["lost"]
