"""Very long texts: the same results as whole, in bounded memory."""

import random
import subprocess
import sys

import numpy as np
import xxhash

from tripfunnel.llm import fertility, pu_quality, simhash, words


def text_of(n, seed=1):
    rng = random.Random(seed)
    known = ["".join(rng.choices("abcdefgßé中", k=rng.randint(1, 9))) for _ in range(3000)]
    return "".join(rng.choice(known) + rng.choice([" ", "  ", "\n", " \t", ". ", " ", "\x0b"]) for _ in range(n))


ODD = ["", "   ", "a", "a ", " a", "one two", "a b c d", "\n\n", "x" * 50, " ".join(["same"] * 40), text_of(500), text_of(3000, 2)]


def test_parts_hold_all_words_in_order():
    for text in ODD:
        data = text.encode()
        for size in (1, 2, 3, 7, 64, 10_000):
            assert [w for part in words.parts(data, size) for w in part] == data.split()
            numbers, kinds = words.numbered(data, size)
            assert len(numbers) == len(data.split()) and kinds == len(set(data.split()))


def test_features_in_parts_equal_those_of_the_whole(monkeypatch):
    whole = pu_quality.features(ODD)
    monkeypatch.setattr(pu_quality, "LONG", 5)
    monkeypatch.setattr(pu_quality, "spans", lambda sizes, most: [(i, i + 1) for i in range(len(sizes))])
    assert np.array_equal(pu_quality.features(ODD), whole)


def direct(text, shingle):
    found = text.encode().lower().split()
    grams = [b" ".join(found[i : i + shingle]) for i in range(max(1, len(found) - shingle + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_in_parts_equal_those_of_the_whole(monkeypatch):
    for shingle in (1, 3, 5):
        expected = [direct(t, shingle) for t in ODD]
        assert [simhash.fingerprint(t, shingle) for t in ODD] == expected
        for size in (1, 5, 100):
            monkeypatch.setattr(simhash, "parts", lambda data, size=size: words.parts(data, size))
            assert [simhash.fingerprint(t, shingle) for t in ODD] == expected
        monkeypatch.setattr(simhash, "parts", words.parts)


def test_measures_in_parts_equal_those_of_the_whole(monkeypatch):
    with open(fertility.VOCABULARY, "rb") as file:
        model = file.read()
    texts = [*ODD, None, "a b c a b c d", "l m n\nl m n\n\nx\n", "ა中" * 40 + " é 中文"]
    whole = fertility.Meter(model)(texts)
    monkeypatch.setattr(fertility, "LONG", -1)
    monkeypatch.setattr(fertility, "TOKENS", 50)
    monkeypatch.setattr(fertility, "spans", lambda sizes, most: [(i, i + 1) for i in range(len(sizes))])
    for size in (3, 64, 10_000):
        monkeypatch.setattr(fertility, "parts", lambda data, size=size: words.parts(data, size))
        assert fertility.Meter(model)(texts) == whole


def test_a_word_of_any_length_is_encoded_in_runs(monkeypatch):
    with open(fertility.VOCABULARY, "rb") as file:
        meter = fertility.Meter(file.read())
    monkeypatch.setattr(fertility, "RUN", 6)
    ids = [list(i) for i in meter.encode([b"river", b"riverriver", "中文字".encode(), b"home"])]
    one = [meter.encoder.encode(w) for w in ("river", "riverr", "iver", "中文字", "home")]
    assert ids == [one[0], one[1] + one[2], one[3], one[4]]


def test_a_text_of_100_mb_takes_about_a_gigabyte():
    """Measured in a process of its own: what the text itself and the libraries take is in it."""
    script = (
        "import resource, sys\n"
        "from tripfunnel.llm import fertility, pu_quality, simhash\n"
        "measure = {'simhash': simhash.fingerprint, 'quality': lambda t: pu_quality.features([t]),\n"
        "           'rules': lambda t: fertility.Meter(open(fertility.VOCABULARY, 'rb').read())([t])}\n"
        "text = ''.join(f'w{i * i % 4999} and so{chr(10) if i % 9 == 0 else chr(32)}' for i in range(7_500_000))\n"
        "assert len(text) > 90_000_000\n"
        "measure[sys.argv[1]](text)\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)\n"
    )
    for operator in ("simhash", "quality", "rules"):
        done = subprocess.run([sys.executable, "-c", script, operator], capture_output=True, text=True, timeout=600)
        assert done.returncode == 0, done.stderr[-2000:]
        assert int(done.stdout) < 1300
