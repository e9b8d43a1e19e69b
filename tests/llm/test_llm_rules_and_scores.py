"""Fertility rules and SentencePiece codec against direct versions."""

import math
import random
import re
from collections import Counter

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripfunnel.llm import fertility, pieces

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """The base columns as their definition says."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_fertility_equals_direct_measures(small, odd):
    docs = small.unionByName(odd)
    judged, verdict = fertility.judge(docs)
    encoder = sentencepiece.SentencePieceProcessor(model_file=fertility.VOCABULARY)
    rows = judged.select("text", f"{verdict}.*").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert tuple(r[c] for c in BASE) == base(r["text"])
        ids = [i for w in WORD.findall(r["text"] or "") for i in encoder.encode(w)]
        assert r["n_tokens"] == len(ids)
        assert r["n_bytes"] == sum(encoder.is_byte(i) for i in ids)
        if len(ids) > 1:
            p = [n / len(ids) for n in Counter(ids).values()]
            assert r["entropy"] == pytest.approx(-sum(x * math.log(x) for x in p) / math.log(len(ids)), abs=1e-8)
        assert not (r["base_failed"] and r["kept"])


def test_bands_reject_what_is_unlike_its_language(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType())])
    pick = random.Random(1)
    plain = "the house by a river is old and green water runs over stones while people walk home at night".split()
    good = [(i, " ".join(pick.choice(plain) for _ in range(120)), "en") for i in range(300)]
    bad = [(1000, " ".join(f"ꙮ{k}дꙮ" for k in range(80)), "en"), (1001, "spam " * 80, "en"), (1002, good[0][1], "xx")]
    docs = spark.createDataFrame(good + bad, schema)
    kept = {r["doc_id"] for r in fertility.keep(docs).collect()}
    assert kept == set(range(300)) | {1002}  # a language with one text goes by the band of all texts
    by_script = {r["doc_id"] for r in fertility.keep(docs, language=None).collect()}
    assert 1000 not in by_script and 1002 in by_script


def test_fertility_passes_other_columns(clashing, none):
    kept, name = fertility.judge(clashing)
    assert kept.columns[:-1] == clashing.columns and name not in clashing.columns
    assert kept.count() == clashing.count()
    assert fertility.keep(clashing).columns == clashing.columns
    assert fertility.keep(none).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces.read(pieces._read(pieces.VOCABULARY))


def best_split(p, word):
    """Largest sum of scores over all splits, straight from the definition."""
    best = [0.0]
    for end in range(1, len(word) + 1):
        options = [best[s] + p.scores[word[s:end]] for s in range(end) if word[s:end] in p.scores]
        best.append(max([*options, best[end - 1] + p.unknown]))
    return best[-1]


def cost(p, word, ids):
    text_of = {i: t for t, i in p.ids.items()}
    known = [i for i in ids if i in text_of]
    covered = sum(len(text_of[i]) for i in known)
    return sum(p.scores[text_of[i]] for i in known) + (len(word) - covered) * p.unknown


def test_shared_prefixes_change_nothing(vocabulary, small):
    words = sorted({w for r in small.limit(40).collect() for w in pieces.marked_words(r["text"])})[:4000]
    together = vocabulary.encode_words(words)
    for word, ids in zip(words[::7], together[::7]):
        assert vocabulary.encode_words([word]) == [ids]
        assert cost(vocabulary, word, ids) == pytest.approx(best_split(vocabulary, word))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=30), min_size=1, max_size=5))
def test_every_text_comes_back(texts):
    p = pieces.Pieces.read(pieces._read(pieces.VOCABULARY))
    codec = pieces.Codec(p)
    ids, sizes, _ = codec.encode(texts)
    at = 0
    for text, size in zip(texts, sizes):
        assert (codec.decode(ids[at : at + size]) if size else "") == text
        at += size


def test_encoding_round_trip(spark, odd, clashing, none):
    for docs in (odd, clashing):
        encoded = pieces.encode(docs)
        rows = encoded.collect()
        assert len(rows) == docs.count()
        assert all(r["round_trip"] is None if r["ids"] is None else r["round_trip"] for r in rows)
        assert sum(r["ids"] is None for r in rows) == 1
    back = pieces.decode(pieces.encode(odd.filter("text <> ''").dropDuplicates(["doc_id"])))
    there = {r["doc_id"]: r["text"] for r in odd.collect()}
    assert all(r["text"] == there[r["doc_id"]] for r in back.collect())
    assert pieces.encode(none).count() == 0
    total = pieces.encode(odd).agg(F.sum("n_tokens")).first()[0]
    assert total == sum(len(r["ids"] or []) for r in pieces.encode(odd).collect())


def test_no_worse_than_the_public_library(small):
    """The library's own unigram search on the same pieces: nearly always the same split, never a better one."""
    pytest.importorskip("google.protobuf")
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(pieces._read(pieces.VOCABULARY))
    model.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    p = pieces.Pieces.read(pieces._read(pieces.VOCABULARY))
    words = sorted({w for r in small.limit(30).collect() for w in pieces.marked_words(r["text"]) if "\n" not in w})
    same = 0
    for word, own in zip(words, p.encode_words(words)):
        theirs = library.encode(word[1:])
        same += own == theirs
        assert cost(p, word, own) >= cost(p, word, theirs) - 1e-6
    assert same > 0.95 * len(words)
