"""Bands that depend neither on the length of a text nor on the size of its group."""

import random

from tripfunnel.llm import fertility

PLAIN = "the house by a river is old and green water runs over stones while people walk home at night".split()
MANY = [a + b + c for a in ("ba", "ke", "lo", "mi", "su", "ta", "ve") for b in ("n", "r", "st", "l", "d", "m") for c in ("a", "en", "io", "or", "us", "y", "ing")]
SCHEMA = "doc_id long, text string, lang string"


def sentences(words, n, seed, size=120):
    pick = random.Random(seed)
    return [" ".join(pick.choice(words) for _ in range(size)) for _ in range(n)]


def test_long_clean_text_stays(spark):
    texts = sentences(MANY, 300, 1) + sentences(MANY, 1, 2, 100_000) + ["home " * 40 + "by " * 40]
    kept = {r["doc_id"] for r in fertility.keep(spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], SCHEMA)).collect()}
    assert kept == set(range(301))


def test_windows_cover_the_text():
    with open(fertility.VOCABULARY, "rb") as file:
        meter = fertility.Meter(file.read())
    clean, same = sentences(PLAIN, 1, 3, 200)[0], " home" * 200
    texts = [clean, clean + same, same + clean, "", "home", None]
    found = [m["window_entropy"] for m in meter(texts)]
    assert found[1] < 0.7 * found[0] and abs(found[1] - found[2]) < 0.05
    assert found[3:] == [0.0, 1.0, 0.0]
    assert [m["window_entropy"] for m in meter(texts[:1])] == found[:1]


def test_small_groups_of_another_script_stay(spark):
    """Thirty clean Georgian texts among English ones, and a language of one broken text."""
    georgian = "სახლი მდინარის პირას ძველია და მწვანე წყალი მიედინება ქვებზე როცა ხალხი ღამით შინ მიდის".split()
    for n in (30, 199, 200):
        rows = [(i, t, "en") for i, t in enumerate(sentences(PLAIN, 300, 1))]
        rows += [(1000 + i, t, "ka") for i, t in enumerate(sentences(georgian, n, 4))]
        rows += [(5000, " ".join(f"க{k}ꙮ" for k in range(80)), "xx")]
        kept = {r["doc_id"] for r in fertility.keep(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert kept == set(range(300)) | {1000 + i for i in range(n)}


def test_script_of_most_letters():
    assert [fertility.script_of(t) for t in ("", "a µ-wave is α", "ქვა a", "日本の山", "é 12")] == ["LATIN", "LATIN", "GEORGIAN", "CJK", "LATIN"]
