"""Quality classifier by positive-unlabelled learning: non-negative unbiased risk, linear in style features.

Trusted positives and unlabelled web text are all that is learned from; labels of bad text are never
read. A first classifier (positive against unlabelled) gives the class prior: the share of positives
among the unlabelled is at most the ratio of unlabelled to positive rows above any score, so the
smallest such ratio, each with its sampling error added, estimates it. The second classifier minimises
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` with the logistic loss; where the negative part
falls below zero, its gradient is turned around, so that a flexible model cannot drive it down.

Features are language-blind: how often classes of characters (lower, upper, digit, space, line end,
each kind of mark, other) follow each other, and how much of a text repeats itself. They are computed
over whole texts. Means, deviations and the class prior come from all rows that may teach; gradient
steps use at most ``most`` rows of each kind, chosen by hash of the id.

Defined cases: null, empty and blank texts have all-zero shares and get the score of that point; rows
without an id are never learned from; equal rows get equal scores; without positives or unlabelled
rows, every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfunnel.llm.common import BLANK, annotate, free_name, sample_by_hash, sigmoid, spans, stored
from tripfunnel.llm.words import numbered

#: Character classes; every byte has one, and bytes of longer characters are one class.
CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\x0b\x0c", "\n",
           ".,;:'\"-?", "!", "#*$%&", "|", "<>=/\\{}[]()@_+~^`")
OTHER, BEYOND = len(CLASSES), len(CLASSES) + 1
KINDS = len(CLASSES) + 2
CLASS_OF = np.full(256, OTHER, dtype=np.int32)
for _number, _chars in enumerate(CLASSES):
    CLASS_OF[list(_chars.encode())] = _number
CLASS_OF[128:] = BEYOND
REPEATS = 8
SIZE = KINDS * KINDS + KINDS + REPEATS


#: Texts of more bytes are counted in parts and as numbered words; the results are the same.
LONG = 4_000_000


def _distinct(numbers: np.ndarray) -> int:
    numbers = np.sort(numbers)
    return 1 + int(np.count_nonzero(numbers[1:] != numbers[:-1]))


def _counts(text: str) -> tuple[int, ...]:
    """Words, different ones, different pairs, different windows, pairs of equals, lines with a word, different ones."""
    data = text.encode()
    if len(data) <= LONG:
        words = data.split()
        lines = [line for line in text.split("\n") if line.strip(BLANK)]
        return (
            len(words), len(set(words)), len(set(zip(words, words[1:]))), len(set(zip(words, words[1:], words[2:]))),
            sum(map(eq, words, words[1:])), len(lines), len(set(lines)),
        )
    words, kinds = numbered(data)
    pairs, windows = 0, 0
    double = int(np.count_nonzero(words[1:] == words[:-1]))
    if len(words) > 1:
        two = words[:-1] * kinds + words[1:]
        pairs = _distinct(two)
        if len(words) > 2:
            # Pairs by rank, so that a window fits 64 bits.
            two = np.searchsorted(np.unique(two), two)
            windows = _distinct(two[:-1] * kinds + words[2:])
    lines, seen, start = 0, set(), 0
    while start <= len(data):
        end = data.find(b"\n", start)
        line = data[start : end if end >= 0 else len(data)]
        if line.strip():
            lines += 1
            seen.add(line)
        start = end + 1 if end >= 0 else len(data) + 1
    return len(words), kinds, pairs, windows, double, lines, len(seen)


def repetition(text: str) -> list[float]:
    """Length, and how much of the words, word pairs, windows and lines repeats earlier ones."""
    n, kinds, pairs, windows, double, lines, different = _counts(text)
    if not n:
        return [0.0] * REPEATS
    return [
        float(np.log1p(n)),
        kinds / n,
        1.0 - pairs / (n - 1) if n > 1 else 0.0,
        1.0 - windows / (n - 2) if n > 2 else 0.0,
        double / (n - 1) if n > 1 else 0.0,
        1.0 - different / lines,
        float(np.log1p(lines)),
        (len(text) - n) / n / 10.0,
    ]


def _classes(joined: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each text has each class, and each pair of neighbouring classes."""
    classes = CLASS_OF[np.frombuffer(joined, dtype=np.uint8)]
    text = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    single = np.bincount(text * KINDS + classes, minlength=len(lengths) * KINDS)
    inside = text[1:] == text[:-1]
    code = (text[1:] * KINDS + classes[:-1]) * KINDS + classes[1:]
    double = np.bincount(code[inside], minlength=len(lengths) * KINDS * KINDS)
    return single, double


def features(texts: list[str | None]) -> np.ndarray:
    """A row for each text: shares of class pairs and classes, square roots, then ``repetition``."""
    raw = [(t or "").encode() for t in texts]
    out = np.zeros((len(texts), SIZE), dtype=np.float32)
    for start, end in spans([len(b) for b in raw], 1_000_000):
        lengths = np.array([len(b) for b in raw[start:end]])
        if end - start == 1 and lengths[0] > LONG:
            single, double = 0, 0
            for at in range(0, int(lengths[0]), LONG):
                # One byte more, so that the pair across the cut is counted, and its class taken off again.
                part = raw[start][at : at + LONG + 1]
                more, pairs = _classes(part, np.array([len(part)]))
                single, double = single + more, double + pairs
                if len(part) > LONG:
                    single[CLASS_OF[part[-1]]] -= 1
        else:
            single, double = _classes(b"".join(raw[start:end]), lengths)
        total = np.maximum(lengths, 1)[:, None]
        out[start:end, : KINDS * KINDS] = np.sqrt(double.reshape(end - start, -1) / total)
        out[start:end, KINDS * KINDS : -REPEATS] = np.sqrt(single.reshape(end - start, -1) / total)
    del raw
    out[:, -REPEATS:] = [repetition(t or "") for t in texts] if texts else np.zeros((0, REPEATS))
    return out


@dataclass(frozen=True)
class Model:
    """Weights of the standardised features; ``prior`` is the estimated share of good text."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(standard(rows, self.mean, self.scale) @ self.weights + self.bias)


def standard(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised and held within six deviations, so that one odd feature does not decide alone."""
    return np.clip((rows - mean) / scale, -6.0, 6.0)


def _descend(gradient, size: int, steps: int, rate: float) -> tuple[np.ndarray, float]:
    """Adam over full batches."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        g = gradient(w[:-1], w[-1])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def _gradients(x: np.ndarray, w: np.ndarray, b: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradient of the mean logistic loss as if all rows were positive, as if negative, and the latter loss."""
    z = x @ w + b
    p = sigmoid(z)
    up, down = (p - 1) / len(x), p / len(x)
    as_positive = np.append(x.T @ up, up.sum())
    as_negative = np.append(x.T @ down, down.sum())
    return as_positive, as_negative, float(np.logaddexp(0.0, z).mean())


#: Logits of the first classifier are counted in hundredths, from -60 to 60.
BINS, MIDDLE = 12_001, 6_000


def binned(logits: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(logits * 100) + MIDDLE, 0, BINS - 1).astype(np.int64)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, error: float = 0.1) -> float:
    """Share of positives among the unlabelled, from how many rows of either have a logit in each bin.

    For every threshold the share is at most (unlabelled above) / (positives above); a bound on the
    sampling error is added to the first before the least ratio is chosen, and left out of the result.
    """
    total = positive.sum(), unlabelled.sum()
    below = np.cumsum(positive) / total[0]
    steps = np.unique(np.searchsorted(below, np.linspace(0.0, 0.95, 96), side="right"))
    p, u = (np.cumsum(counts[::-1])[::-1][steps] / n for counts, n in zip((positive, unlabelled), total))
    slack = np.sqrt(np.log(4 / error) / 2) * (total[0] ** -0.5 + total[1] ** -0.5)
    best = np.argmin((u + slack) / np.maximum(p, 1e-9))
    return float(np.clip(u[best] / p[best], 0.01, 0.99))


def fit_plain(p: np.ndarray, u: np.ndarray, steps: int, decay: float) -> tuple[np.ndarray, float]:
    """The first classifier: positive against unlabelled."""

    def gradient(w, b):
        return _gradients(p, w, b)[0] + _gradients(u, w, b)[1] + np.append(10 * decay * w, 0.0)

    return _descend(gradient, p.shape[1], steps // 3, 0.05)


def risk_gradient(p: np.ndarray, u: np.ndarray, prior: float, w: np.ndarray, b: float) -> np.ndarray:
    """Gradient of the non-negative risk; where its negative part is below zero, that part's is turned around."""
    p_up, p_down, p_loss = _gradients(p, w, b)
    _, u_down, u_loss = _gradients(u, w, b)
    sign = 1.0 if u_loss - prior * p_loss >= 0 else -1.0
    return prior * p_up + sign * (u_down - prior * p_down)


def fit_non_negative(p: np.ndarray, u: np.ndarray, prior: float, steps: int, decay: float) -> tuple[np.ndarray, float]:
    return _descend(lambda w, b: risk_gradient(p, u, prior, w, b) + np.append(decay * w, 0.0), p.shape[1], steps, 0.05)


def untaught() -> Model:
    zero = np.zeros(SIZE)
    return Model(zero, zero + 1, zero, 0.0, 0.5)


def fit_rows(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 600, decay: float = 1e-4) -> Model:
    """The non-negative PU fit on feature rows that are all in memory."""
    if not len(positive) or not len(unlabelled):
        return untaught()
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    p, u = standard(positive, mean, scale).astype(np.float64), standard(unlabelled, mean, scale).astype(np.float64)
    counts = np.zeros((2, BINS), dtype=np.int64)
    for out in (0, 1):  # scores for the prior come from the half that was not fitted
        a, c = p[np.arange(len(p)) % 2 != out], u[np.arange(len(u)) % 2 != out]
        w, b = fit_plain(a if len(a) else p, c if len(c) else u, steps, decay)
        for kind, rows in enumerate((p, u)):
            counts[kind] += np.bincount(binned(rows[out::2] @ w + b), minlength=BINS)
    prior = estimate_prior(*counts)
    return Model(mean, scale, *fit_non_negative(p, u, prior, steps, decay), prior)


def training_rows(
    docs: DataFrame, positives: DataFrame, id_column: str, usable: Column, most: int
) -> DataFrame:
    """Ids to learn from, at most ``2 * most``: ``positive`` true for trusted ones, false for unlabelled."""
    good = sample_by_hash(positives.select(id_column).filter(usable).distinct(), id_column, most)
    web = sample_by_hash(docs.select(id_column).filter(usable).distinct(), id_column, most)
    return good.withColumn("positive", F.lit(True)).unionByName(web.withColumn("positive", F.lit(False)))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("f"))
    return column.flatten().to_numpy().reshape(batch.num_rows, SIZE).astype(np.float64)


def _moments(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every feature over all rows; one row of sums leaves each task."""

    def run(batches):
        sums = np.zeros(2 * SIZE + 1)
        for batch in batches:
            rows = _matrix(batch)
            sums += np.concatenate([rows.sum(axis=0), (rows * rows).sum(axis=0), [len(rows)]])
        yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64()))], names=["s"])

    parts = found.select("f").mapInArrow(run, "s array<double>").select(F.posexplode("s").alias("at", "x"))
    sums = np.array([r["x"] for r in parts.groupBy("at").agg(F.sum("x").alias("x")).orderBy("at").collect()])
    n = max(sums[-1], 1.0) if len(sums) else 1.0
    sums = sums if len(sums) else np.zeros(2 * SIZE + 1)
    mean = sums[:SIZE] / n
    return mean, np.sqrt(np.maximum(sums[SIZE:-1] / n - mean * mean, 0.0)) + 1e-3


def _bins(mean: np.ndarray, scale: np.ndarray, halves: list[tuple[np.ndarray, float]]):
    """The bin of every row's logit under the classifier that its half has not taught."""

    def run(batches):
        for batch in batches:
            rows = standard(_matrix(batch), mean, scale)
            half = batch.column(batch.schema.get_field_index("half")).to_numpy()
            logits = np.where(half == 0, *[rows @ w + b for w, b in halves])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(binned(logits), pa.int64())], names=["id", "bin"])

    return run


def fit(
    docs: DataFrame, positives: DataFrame, usable: Column, text: str = "text", id_column: str = "doc_id", most: int = 8000,
    steps: int = 600, decay: float = 1e-4,
) -> Model:
    """The model from trusted ids in ``positives`` and unlabelled rows of ``docs``; ``usable`` says which ids may teach.

    Features of all usable rows are computed once and stored; their means, deviations and the logits behind the
    prior cover all of them. Gradient steps use at most ``most`` rows of each kind.
    """
    usable = usable & F.col(id_column).isNotNull()
    kind = T.ArrayType(T.FloatType())
    texts = docs.filter(usable).select(id_column, text)
    id_type = docs.schema[id_column].dataType
    half = F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit("half")), F.lit(2)).cast("int")
    found = stored(
        annotate(texts, text, lambda: lambda texts: list(features(texts)), "f", kind).select(
            F.col(id_column).alias("id"), half.alias("half"), "f"
        ),
        "features",
    )
    # At most 2 * most ids, so the broadcast is bounded.
    chosen = training_rows(docs, positives, id_column, usable, most).withColumnRenamed(id_column, "id")
    table = found.join(F.broadcast(chosen), "id").dropDuplicates(["id", "positive"]).orderBy("id").toArrow()
    positive = np.array(table.column("positive").to_pylist(), dtype=bool)
    if not positive.any() or positive.all():
        return untaught()
    mean, scale = _moments(found)
    rows = standard(np.array(table.column("f").to_pylist(), dtype=np.float64).reshape(-1, SIZE), mean, scale)
    parity = table.column("half").to_numpy()
    halves = []
    for out in (0, 1):
        a, c = rows[positive & (parity != out)], rows[~positive & (parity != out)]
        halves.append(fit_plain(a if len(a) else rows[positive], c if len(c) else rows[~positive], steps, decay))
    schema = T.StructType([T.StructField("id", id_type), T.StructField("bin", T.LongType())])
    scored = stored(found.select("id", "half", "f").mapInArrow(_bins(mean, scale, halves), schema), "logits")
    trusted = positives.select(F.col(id_column).alias("id")).distinct()
    counts = np.zeros((2, BINS), dtype=np.int64)
    for row, logits in enumerate((scored.join(trusted, "id", "left_semi"), scored)):
        for r in logits.groupBy("bin").count().collect():  # at most BINS rows
            counts[row, r["bin"]] = r["count"]
    prior = estimate_prior(*counts)
    return Model(mean, scale, *fit_non_negative(rows[positive], rows[~positive], prior, steps, decay), prior)


def score(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with the probability that a text is good, and that column's name."""
    name = free_name(docs, "score")

    def work():
        return lambda texts: np.round(model.scores(features(texts)), 9)

    return annotate(docs, text, work, name, T.DoubleType()), name


def keep(docs: DataFrame, model: Model, text: str = "text", least: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with the same columns."""
    scored, name = score(docs, model, text)
    return scored.filter(F.col(name) >= least).select(*[F.col(f"`{c}`") for c in docs.columns])
