"""Word pairs of the Kneser-Ney classes and short toxic passages."""

import random

import numpy as np

from tripfunnel.llm import toxicity

PLAIN = "the house by a river is old and green water runs over stones while people walk home at night".split()


def texts(phrase, n, seed, words=60):
    pick = random.Random(seed)
    out = []
    for _ in range(n):
        w = [pick.choice(PLAIN) for _ in range(words)]
        for _ in range(3):
            w.insert(pick.randrange(len(w)), phrase)
        out.append(" ".join(w))
    return out


def test_pairs_tell_what_words_do_not():
    """Both classes have the same words; only their order inside a pair differs."""
    model = toxicity.fit_texts(texts("blue lamp", 40, 1), texts("lamp blue", 80, 2), 1 / 3)
    assert len(model.difference.pairs)
    toxic, ordinary = model.scores(texts("blue lamp", 40, 3)), model.scores(texts("lamp blue", 40, 4))
    assert (toxic >= 0.7).mean() > 0.9 and (ordinary < 0.7).mean() > 0.9


def test_a_short_passage_in_a_very_long_text():
    """Some insults in one place among 50,000 clean words are found; clean texts of that length are not."""
    pick = random.Random(6)
    insults = ["orre", "vask", "plim", "drot", "quez"]
    plain = [f"{w}{pick.randrange(40)}" for w in PLAIN for _ in range(12)]

    def clean(n):
        return [pick.choice(plain) for _ in range(n)]

    def toxic(n):
        w = clean(n)
        for _ in range(max(3, n // 40)):
            w.insert(pick.randrange(len(w)), pick.choice(insults))
        return w

    join = " ".join
    model = toxicity.fit_texts([join(toxic(pick.randrange(40, 400))) for _ in range(150)], [join(clean(pick.randrange(40, 400))) for _ in range(600)], 0.2)
    whole = [clean(50_000) for _ in range(8)]
    at = [pick.randrange(50_000) for _ in whole]
    planted = [join(w[:i] + toxic(120) + w[i:]) for w, i in zip(whole, at)]
    assert (model.scores(planted) >= 0.7).all() and (model.scores([join(w) for w in whole]) < 0.7).all()


def test_strongest_window_by_definition():
    pick = np.random.default_rng(3)
    for n in (1, 3, 127, 128, 129, 256, 257, 1000):
        v = pick.normal(size=n)
        padded = np.zeros(max(2, -(-n // 128)) * 128)
        padded[:n] = v
        best = max(np.sort(padded[s : s + 256])[-4:].mean() for s in range(0, len(padded) - 128, 128))
        assert abs(toxicity.strongest_window(v) - best) < 1e-12


def test_repetition_inside_a_text_counts_once():
    once, often = ["orre orre and more"], ["orre " * 600 + "orre and more"]
    a, b = toxicity.learn(once, ["plain words"]), toxicity.learn(often, ["plain words"])
    assert np.array_equal(a.pairs, b.pairs) and np.array_equal(a.direct, b.direct)
