"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; runs of anything but letters become one blank, and the n-grams of 1 to 4
characters that remain are hashed into ``BUCKETS`` features. A feature weighs ``(1 + log tf) * idf``,
each text has length 1. The document frequencies come from all texts that may teach, counted where
they lie and summed by feature. The regression is fitted by follow-the-regularised-leader steps with
L1 and L2 penalties, so most weights are exactly zero; a part of the rows is set aside, and one
temperature is chosen there so that the probabilities match how often the prediction is right.

The fit takes at most ``most`` rows of each language, chosen by hash of the id; scoring reads whole
texts in place, without a shuffle.

Defined cases: a null text, or one without any letter, is ``und`` with score 0; rows without an id or
language teach nothing; equal rows get equal results; without teaching rows all texts are ``und``; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfunnel.llm.common import annotate, free_name, slices, spans, stored, texts_of

BUCKETS = 1 << 15
SIZES = (1, 2, 3, 4)
NO_LETTER = re.compile(r"[\W\d_]+")
UNKNOWN = "und"
#: Rows (an id and a language) that are sent to every executor at most.
MOST_BROADCAST = 200_000
RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def term_counts(texts: list[str | None]):
    """For each text its features and their counts; None for a text without letters."""
    clean = [NO_LETTER.sub(" ", t.lower()).strip() if t else "" for t in texts]
    for start, end in spans([len(c) for c in clean], 500_000):
        part = clean[start:end]
        points = np.frombuffer("".join(f" {c} " for c in part).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        ends = np.cumsum([len(c) + 2 for c in part])
        codes = np.zeros((len(SIZES), len(points)), dtype=np.int64)
        running = np.zeros(len(points), dtype=np.uint64)
        for n in range(1, max(SIZES) + 1):
            fits = len(points) - n + 1
            if fits < 1:
                break
            running = running[:fits] * np.uint64(0x100000001B3) + points[n - 1 :] + np.uint64(1)
            if n in SIZES:
                mixed = (running ^ (running >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
                codes[SIZES.index(n), :fits] = (mixed >> np.uint64(64 - 15)).astype(np.int64)
        for i, c in enumerate(part):
            if not c:
                yield None
                continue
            first, last = ends[i] - len(c) - 2, ends[i]
            held = [codes[k, first : max(first, last - n + 1)] for k, n in enumerate(SIZES)]
            count = np.bincount(np.concatenate(held), minlength=BUCKETS)
            features = np.flatnonzero(count)
            yield features, count[features]


def weighed(found, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    features, count = found
    x = (1.0 + np.log(count)) * idf[features]
    return features, x / max(np.linalg.norm(x), 1e-12)


def document_frequencies(docs: DataFrame, text: str) -> tuple[int, np.ndarray]:
    """Number of texts with a letter and, for each feature, the number of those that have it."""

    def count(batches):
        total, number = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for part in slices(batch, text):
                for found in term_counts(texts_of(part, text)):
                    if found:
                        total[found[0]] += 1
                        number += 1
        features = np.append(np.flatnonzero(total), -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(features), pa.array(np.append(total[features[:-1]], number))], names=["feature", "n"]
        )

    # One row per feature at most reaches the driver.
    rows = docs.select(text).mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    table = rows.toArrow()
    feature, n = table.column("feature").to_numpy(), table.column("n").to_numpy()
    out = np.zeros(BUCKETS, dtype=np.int64)
    out[feature[feature >= 0]] = n[feature >= 0]
    return int(n[feature < 0].sum()), out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features by languages, mostly zero
    bias: np.ndarray
    temperature: float

    def logits(self, found) -> np.ndarray:
        features, x = weighed(found, self.idf)
        return x @ self.weights[features] + self.bias

    def __call__(self, texts: list[str | None]) -> list[dict]:
        out = []
        for found in term_counts(texts):
            if found is None or not self.languages:
                out.append({"lang_pred": UNKNOWN, "score": 0.0})
                continue
            z = self.logits(found) / self.temperature
            best = int(np.argmax(z))
            out.append({"lang_pred": self.languages[best], "score": round(float(1 / np.exp(z - z[best]).sum()), 9)})
        return out


def follow_leader(
    rows: list[tuple[np.ndarray, np.ndarray]], marks: np.ndarray, kinds: int, epochs: int, alpha: float = 0.5,
    beta: float = 1.0, l1: float = 0.05, l2: float = 0.01,
) -> tuple[np.ndarray, np.ndarray]:
    """Follow-the-regularised-leader with elastic net; one step per row and epoch. Weights and bias."""
    z, n = np.zeros((BUCKETS + 1, kinds)), np.zeros((BUCKETS + 1, kinds))

    def solved(z, n):
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
        return -shrunk / ((beta + np.sqrt(n)) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            features, x = np.append(rows[i][0], BUCKETS), np.append(rows[i][1], 1.0)
            old_z, old_n = z[features], n[features]
            w = solved(old_z, old_n)
            logit = x @ w
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[marks[i]] -= 1.0
            g = x[:, None] * p
            step = (np.sqrt(old_n + g * g) - np.sqrt(old_n)) / alpha
            z[features] = old_z + g - step * w
            n[features] = old_n + g * g
    w = solved(z, n)
    return w[:BUCKETS], w[BUCKETS]


def choose_temperature(logits: np.ndarray, marks: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section on its logarithm."""
    if not len(marks):
        return 1.0

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(marks)), marks]).mean())

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit_texts(texts: list[str | None], languages: list[str], number: int, frequency: np.ndarray, epochs: int = 3) -> Model:
    """The model from teaching texts; every fifth row of the shuffled sample is set aside for the temperature."""
    idf = np.log((1.0 + number) / (1.0 + frequency)) + 1.0
    names = sorted(set(languages))
    pairs = [(f, names.index(k)) for f, k in zip(term_counts(texts), languages) if f is not None]
    rows = [weighed(f, idf) for f, _ in pairs]
    marks = np.array([k for _, k in pairs], dtype=np.int64)
    if not rows:
        return Model([], idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    aside = np.random.default_rng(11).permutation(len(rows))[: len(rows) // 5]
    fitted = np.setdiff1d(np.arange(len(rows)), aside)
    weights, bias = follow_leader([rows[i] for i in fitted], marks[fitted], len(names), epochs)
    logits = np.array([rows[i][1] @ weights[rows[i][0]] + bias for i in aside]).reshape(len(aside), len(names))
    return Model(names, idf, weights, bias, choose_temperature(logits, marks[aside]))


def fit(
    docs: DataFrame, usable: Column, text: str = "text", id_column: str = "doc_id", language: str = "lang", most: int = 1200,
) -> Model:
    """The model from ``docs``; ``usable`` says which ids may teach."""
    teaching = docs.filter(usable & F.col(id_column).isNotNull() & F.col(language).isNotNull() & F.col(text).isNotNull())
    ids = teaching.select(F.col(id_column).alias("id"), F.col(language).alias("mark")).distinct()
    first = Window.partitionBy("mark").orderBy(F.xxhash64(F.col("id").cast("string")), "id")
    # The rank limit runs in every task before the shuffle, so a common language costs no more than a rare one.
    chosen = ids.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= most)
    rows = teaching.select(F.col(id_column).alias("id"), F.col(language).alias("mark"), F.col(text).alias("text"))
    chosen = stored(chosen.select("id", "mark"), "teaching-rows")
    if chosen.count() <= MOST_BROADCAST:  # so that the texts need not be shuffled
        chosen = F.broadcast(chosen)
    table = rows.join(chosen, ["id", "mark"], "left_semi").orderBy("id", "mark", "text").toArrow().to_pydict()
    number, frequency = document_frequencies(teaching, text)
    return fit_texts(table["text"], table["mark"], number, frequency)


def predict(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct of ``lang_pred`` and ``score``, and that column's name."""
    name = free_name(docs, "language")
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows of one weight per language
    return annotate(docs, text, lambda: lambda texts: shipped.value(texts), name, RESULT), name
