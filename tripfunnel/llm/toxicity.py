"""Toxicity from class-conditional Kneser-Ney models.

Two bigram models, one of toxic and one of ordinary text, interpolate in three steps: the bigram count
of the class, the word count of the class, and a distribution that both classes share, built from the
pooled continuation counts (in how many different contexts a word follows). An expression too rare for
either class falls back on the same shared probability in both, so it hardly speaks for one of them.
A pair counts once for each text that has it, so repetition inside one text carries no weight, with modified
Kneser-Ney discounts for one, two and more texts. How many texts a pair needs is read from the data: of the
powers of two, the smallest whose log loss on unseen halves lies within one standard error of the least. So is
the number of contexts a word needs for a count of its own: the power of two of least log loss.

A text is judged by the difference of the two log-likelihoods per word: over the whole text, and over
the ``telling`` share of its words (two at least) that speak most for toxic text. A logistic regression on
these two, fitted on rows that the scored model has not seen, turns them into a probability at the labelled
share of toxic text. A long text dilutes a passage in both, so its strongest window of ``WINDOW`` words
(half overlapping, the whole text covered; by the ``STRONGEST`` words in it) is judged by a regression of its
own, and the larger of the two probabilities counts.

The fit takes at most ``most`` labelled rows of each class, chosen by hash of the id. Scoring reads
whole texts in place, without a shuffle.

Defined cases: null, empty and wordless texts carry no evidence (both differences 0); rows without an
id or label are never learned from; equal rows get equal scores; without rows of both classes every
score is the labelled share (0.5 without labels); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfunnel.llm.common import annotate, free_name, sample_by_hash, sigmoid, spans

LETTERS = re.compile(r"[^\W\d_]+")
DISCOUNT = 0.75
WINDOW, STRONGEST = 256, 4
#: Contexts a word needs while the pairs' limit is chosen.
LEAST_WORD = 4


def words(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


@dataclass(frozen=True)
class Difference:
    """Per-word evidence: log P(word | previous, toxic) - log P(word | previous, ordinary)."""

    number: dict[str, int]
    single: np.ndarray  # of each word, both classes: P_c(word); the last stands for unknown words
    spread: np.ndarray  # of each context, both classes: the share left to P_c(word); contexts are numbered from 1
    pairs: np.ndarray  # sorted (context << 32) + word
    direct: np.ndarray  # of each pair, both classes: the discounted share

    def evidence(self, ids: np.ndarray) -> np.ndarray:
        """One value for each word of one or more texts (before each text stands the number -1)."""
        context = np.concatenate([[-1], ids[:-1]]) + 1
        p = self.spread[context] * self.single[ids]
        if len(self.pairs):
            key = context << 32 | ids
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            hit = np.flatnonzero((self.pairs[at] == key) & (ids >= 0))
            p[hit] += self.direct[at[hit]]
        out = np.log(p[:, 0]) - np.log(p[:, 1])
        out[ids < 0] = 0.0
        return out

    def measures(self, texts: list[str | None], share: float) -> np.ndarray:
        """Three columns: evidence per word of the whole text, of the ``share`` of words that tells most, and of
        the strongest window.
        """
        out = [np.zeros((0, 3))]
        for start, end in spans([len(t or "") for t in texts], 500_000):
            out.append(self.measures_of(numbered(texts[start:end], self.number), share))
        return np.concatenate(out)

    def measures_of(self, split: list[np.ndarray], share: float) -> np.ndarray:
        """The same of texts whose words are numbered."""
        out = np.zeros((len(split), 3))
        sizes = [len(w) for w in split]
        value = self.evidence(np.concatenate([x for w in split for x in (START, w)])) if split else np.zeros(0)
        at = 1
        for i, n in enumerate(sizes):
            if n:
                own = value[at : at + n]
                many = min(n, max(2, int(n * share)))
                out[i] = own.mean(), np.partition(own, n - many)[n - many :].mean(), strongest_window(own)
            at += n + 1
        return out


def strongest_window(evidence: np.ndarray) -> float:
    """The largest mean evidence of the ``STRONGEST`` words of any window."""
    step = WINDOW // 2
    steps = max(2, -(-len(evidence) // step))
    halves = np.zeros(steps * step)
    halves[: len(evidence)] = evidence
    # The best words of a window are among the best of its halves.
    halves = np.partition(halves.reshape(steps, step), step - STRONGEST, axis=1)[:, step - STRONGEST :]
    both = np.concatenate([halves[:-1], halves[1:]], axis=1)
    return float(np.partition(both, STRONGEST, axis=1)[:, STRONGEST:].mean(axis=1).max())


START = np.array([-1], dtype=np.int64)


def numbered(texts: list[str | None], number: dict[str, int]) -> list[np.ndarray]:
    """The numbers of each text's words; unknown ones get the number after the last."""
    unknown = len(number)
    return [np.array([number.get(x, unknown) for x in words(t)], dtype=np.int64) for t in texts]


@dataclass(frozen=True)
class Counts:
    """In how many texts of either class each pair (context << 32) + word occurs; context 0 is the start."""

    number: dict[str, int]
    pairs: np.ndarray
    table: np.ndarray

    @staticmethod
    def of(toxic: list[str | None], ordinary: list[str | None]) -> Counts:
        number: dict[str, int] = {}
        found = []
        for kind in (toxic, ordinary):
            keys = [np.zeros(0, dtype=np.int64)]
            for t in kind:
                ids = np.array([-1, *[number.setdefault(w, len(number)) for w in words(t)]], dtype=np.int64)
                keys.append(np.unique((ids[:-1] + 1) << 32 | ids[1:]))
            found.append(np.unique(np.concatenate(keys), return_counts=True))
        pairs = np.unique(np.concatenate([keys for keys, _ in found]))
        table = np.zeros((len(pairs), 2))
        for c, (keys, n) in enumerate(found):
            table[np.searchsorted(pairs, keys), c] = n
        return Counts(number, pairs, table)


def discounts(counts: np.ndarray) -> np.ndarray:
    """What modified Kneser-Ney takes from counts of 0, 1, 2 and more; ``DISCOUNT`` where too few counts tell."""
    n = np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].astype(float)
    if not n.all():
        return np.array([0.0, DISCOUNT, DISCOUNT, DISCOUNT])
    y = n[0] / (n[0] + 2 * n[1])
    return np.array([0.0, *[np.clip(k - (k + 1) * y * n[k] / n[k - 1], 0.1, k) for k in (1, 2, 3)]])


def learn(toxic: list[str | None], ordinary: list[str | None], least_word: int = LEAST_WORD, least_pair: int = 1) -> Difference:
    """Both models of the texts of either class."""
    return models(Counts.of(toxic, ordinary), least_word, least_pair)


def models(counts: Counts, least_word: int = LEAST_WORD, least_pair: int = 1) -> Difference:
    """Both models.

    As in Kneser-Ney smoothing, the word step counts contexts (different previous words). What is rarer
    than ``least_word`` contexts or ``least_pair`` texts in both classes together leaves its mass to the
    step below.
    """
    pairs, table = counts.pairs, counts.table
    size = len(counts.number) + 1
    context, follower = pairs >> 32, pairs & 0xFFFFFFFF
    single = np.stack([np.bincount(follower, weights=table[:, c] > 0, minlength=size) for c in range(2)], axis=1)
    seen = np.stack([np.bincount(context, weights=table[:, c], minlength=size + 1) for c in range(2)], axis=1)
    # Shared by both classes: contexts in all; an unknown word gets the mass of one more context.
    contexts = np.bincount(follower, minlength=size).astype(float)
    shared = (contexts + (np.arange(size) == size - 1)) / (contexts.sum() + 1)
    total = np.maximum(single.sum(axis=0), 1.0)
    single[contexts < least_word] = 0.0
    kept = np.maximum(single - DISCOUNT, 0) / total
    word = kept + (1.0 - kept.sum(axis=0)) * shared[:, None]
    taken_off = np.stack([discounts(table[:, c])[np.minimum(table[:, c], 3).astype(np.int64)] for c in range(2)], axis=1)
    held = table.sum(axis=1) >= least_pair
    pairs, table, context, taken_off = pairs[held], table[held], context[held], taken_off[held]
    direct = np.maximum(table - taken_off, 0) / np.maximum(seen[context], 1)
    taken = np.stack([np.bincount(context, weights=direct[:, c], minlength=size + 1) for c in range(2)], axis=1)
    return Difference(counts.number, word, 1.0 - taken, pairs, direct)


@dataclass(frozen=True)
class Model:
    difference: Difference
    judges: Judges
    telling: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return sigmoid(self.judges(self.difference.measures(texts, self.telling)))


@dataclass(frozen=True)
class Judges:
    """Weights and bias for the measures of the whole text, and for its strongest window."""

    whole: tuple[np.ndarray, float]
    window: tuple[np.ndarray, float]

    def __call__(self, measures: np.ndarray) -> np.ndarray:
        (a, b), (c, d) = self.whole, self.window
        return np.maximum(measures[:, :2] @ a + b, measures[:, 2:] @ c + d)

    @staticmethod
    def fit(measures: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> Judges:
        return Judges(calibrate(measures[:, :2], toxic, weight), calibrate(measures[:, 2:], toxic, weight))


def calibrate(measures: np.ndarray, toxic: np.ndarray, weight: np.ndarray, decay: float = 1e-3):
    """Weighted logistic regression by Newton steps."""
    x = np.column_stack([measures, np.ones(len(measures))])
    w = np.zeros(x.shape[1])
    ridge = decay * np.diag([1.0] * (x.shape[1] - 1) + [0.0]) + 1e-9 * np.eye(x.shape[1])
    for _ in range(50):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - toxic)) / weight.sum() + ridge @ w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x / weight.sum() + ridge
        step = np.linalg.solve(curve, gradient)
        w = w - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit_texts(toxic: list[str | None], ordinary: list[str | None], share: float, telling: float = 0.02) -> Model:
    """Both models and the calibration. Each half is measured by models of the other half."""
    if not toxic or not ordinary:
        empty = learn([], [])
        logit = float(np.log(share / (1 - share))) if 0 < share < 1 else 0.0
        return Model(empty, Judges((np.zeros(2), logit), (np.zeros(1), logit)), telling)
    halves = []
    for out in (0, 1):
        counts = Counts.of([t for i, t in enumerate(toxic) if i % 2 != out] or toxic, [t for i, t in enumerate(ordinary) if i % 2 != out] or ordinary)
        halves.append((counts, numbered(toxic[out::2] + ordinary[out::2], counts.number)))
    marks = np.concatenate([np.repeat([1.0, 0.0], [len(toxic[out::2]), len(ordinary[out::2])]) for out in (0, 1)])
    share = min(max(share, 1e-3), 1 - 1e-3)
    weight = np.where(marks == 1, share / marks.sum(), (1 - share) / (1 - marks).sum())

    def tried(least_word: int, least_pair: int) -> tuple[float, float, Judges]:
        """Mean log loss on the unseen halves, its standard error, and the judges."""
        measures = np.concatenate([models(counts, least_word, least_pair).measures_of(split, telling) for counts, split in halves])
        judges = Judges.fit(measures, marks, weight)
        z = judges(measures)
        loss = np.logaddexp(0.0, np.where(marks == 1, -z, z))
        mean = weight @ loss
        return float(mean), float(np.sqrt(weight**2 @ (loss - mean) ** 2)), judges

    most = max(counts.table.sum(axis=1).max(initial=1) for counts, _ in halves)
    by_pair = {int(n): tried(LEAST_WORD, int(n)) for n in 2 ** np.arange(int(np.log2(most)) + 2)}  # the last keeps no pair
    best = min(by_pair.values(), key=lambda x: x[0])
    least_pair = next(n for n, x in by_pair.items() if x[0] <= best[0] + best[1])
    by_word = {n: by_pair[least_pair] if n == LEAST_WORD else tried(n, least_pair) for n in (1, 2, 4, 8, 16)}
    least_word = min(by_word, key=lambda n: by_word[n][0])
    return Model(learn(toxic, ordinary, least_word, least_pair), by_word[least_word][2], telling)


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, text: str = "text", id_column: str = "doc_id",
    mark: str = "toxic", most: int = 3000, telling: float = 0.02,
) -> Model:
    """The model from at most ``most`` labelled rows of each class; ``usable`` says which ids may teach."""
    marked = labels.filter(usable & F.col(id_column).isNotNull() & F.col(mark).isin(0, 1)).select(id_column, mark).distinct()
    totals = {r[mark]: r["n"] for r in marked.groupBy(mark).agg(F.count("*").alias("n")).collect()}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    kinds = [sample_by_hash(marked.filter(F.col(mark) == k), id_column, most) for k in (1, 0)]
    # At most 2 * most ids, so the broadcast is bounded; the texts are not shuffled.
    rows = docs.select(id_column, text).join(F.broadcast(kinds[0].unionByName(kinds[1])), id_column)
    table = rows.select(id_column, mark, text).orderBy(id_column, mark, text).toArrow().to_pydict()
    both = {k: [t for t, m in zip(table[text], table[mark]) if m == k] for k in (1, 0)}
    return fit_texts(both[1], both[0], share if totals else 0.5, telling)


def score(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with the probability that a text is toxic, and that column's name."""
    name = free_name(docs, "score")
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # its size is bounded by 2 * most texts

    def work():
        return lambda texts: np.round(shipped.value.scores(texts), 9)

    return annotate(docs, text, work, name, T.DoubleType()), name
