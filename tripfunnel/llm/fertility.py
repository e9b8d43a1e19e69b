"""Quality rules from tokeniser fertility: characters per token, byte-fallback share, token entropy.

A public SentencePiece vocabulary with byte fallback encodes each word of a text by itself, with the
word-start mark. Three ratios follow per text:

* ``chars_per_token``: code points in words per token; low for text unlike what the vocabulary knows
* ``byte_share``: share of tokens that are single bytes; high for unknown scripts and broken text
* ``window_entropy``: Shannon entropy of the tokens in a window of ``WINDOW`` tokens, divided by the logarithm
  of that number (0 for one token over and over, 1 when no token repeats), the mean over windows that
  cover the whole text. Texts of any length are compared at the same length: every text that passes
  the base rule has a window.

``entropy``, the same for the whole text at once, is reported, but falls with length and rejects nothing.

A word of more than ``RUN`` characters is encoded in runs of that many, each with the word-start mark. Texts of
more than ``LONG`` characters are measured in parts, with the same results.

Rejection bands are per language, or per script: all texts of one group form a band between the median
minus and plus ``width`` interquartile ranges. Median and range of a group are drawn towards those of its
most frequent script, and those of a script towards those of all texts, with the weight ``prior / (n + prior)``
for ``n`` texts. What lies between both medians widens the band, as it does the spread of a mixture:
by ``sqrt(w * (1 - w))`` times their distance. Nothing switches at any number of texts, and from ``prior``
texts on a group's own median is always inside.

Defined cases: a null or blank text has no words and fails the base rule; a null language is the group
``und``; equal rows get equal results and all stay; an empty table gives an empty result. Columns that
the operator does not name pass through ``annotate``; a clash of names is avoided by underscores.
"""

from __future__ import annotations

import os
import unicodedata
from collections import Counter
from functools import cache

import numpy as np
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfunnel.llm.common import BLANK, annotate, free_name, spans, stored
from tripfunnel.llm.words import Remembered, numbered, parts

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SYMBOLS = "#*$%&|<>"
WINDOW = 50
#: Characters of a word that are encoded at once: what that takes grows with them.
RUN = 10_000
#: Texts of more characters are measured in parts.
LONG = 4_000_000
#: Tokens remembered from one text to the next.
TOKENS = 10_000_000
FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("entropy", T.DoubleType()),
        T.StructField("window_entropy", T.DoubleType()),
        T.StructField("script", T.StringType()),
    ]
)


def repeat_words(words: list) -> int:
    """Words that lie in a 3-word window which the text has at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = np.zeros(len(words), dtype=bool)
    starts = np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=len(windows))
    for shift in range(3):
        covered[shift : shift + len(starts)] |= starts
    return int(covered.sum())


def repeat_numbers(words: np.ndarray, kinds: int) -> int:
    """``repeat_words`` of words numbered below ``kinds``."""
    if len(words) < 3:
        return 0
    pairs = words[:-1] * kinds + words[1:]
    # Pairs by rank, so that a window fits 64 bits.
    pairs = np.searchsorted(_distinct(pairs), pairs)
    windows = pairs[:-1] * kinds + words[2:]
    del pairs
    ordered = np.sort(windows)
    again = _distinct(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered
    covered = np.zeros(len(words), dtype=bool)
    if len(again):
        at = np.minimum(np.searchsorted(again, windows), len(again) - 1)
        starts = again[at] == windows
        for shift in range(3):
            covered[shift : shift + len(starts)] |= starts
    return int(covered.sum())


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """The different numbers in order; ``np.unique`` would keep them in a larger table."""
    numbers = np.sort(numbers)
    return numbers[np.append(True, numbers[1:] != numbers[:-1])] if len(numbers) else numbers


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if len(text) > LONG:
        lines, seen, start = 0, set(), 0
        while start <= len(text):
            end = text.find("\n", start)
            end = len(text) if end < 0 else end
            line = text[start:end]
            if line.strip(BLANK):
                lines += 1
                seen.add(line)
            start = end + 1
        return lines - len(seen)
    lines = [line for line in text.split("\n") if line.strip(BLANK)]
    return len(lines) - len(set(lines))


@cache
def script_of_letter(letter: str) -> str:
    """The first word of a letter's Unicode name, such as LATIN, THAI, CJK; empty for what is no letter."""
    return unicodedata.name(letter, "").split(" ")[0].split("-")[0] if letter.isalpha() else ""


def script_of(text: str) -> str:
    """The script of most letters of a text, ``LATIN`` without letters."""
    if text.isascii():
        return "LATIN"
    found: Counter = Counter()
    for letter, n in Counter(text).items():
        found[script_of_letter(letter)] += n
    del found[""]
    return max(found, key=lambda k: (found[k], k), default="LATIN")


class Meter:
    """Measures texts."""

    def __init__(self, model: bytes):
        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = self.encoder.get_piece_size()
        self.is_byte = np.array([self.encoder.is_byte(i) for i in range(self.size)])
        self.words = Remembered(self.encode)

    def encode(self, words: list[bytes]) -> list:
        """The tokens of each word."""
        ids = self.encoder.encode([w.decode() if len(w) <= RUN else "" for w in words], num_threads=1)
        for i, word in enumerate(words):
            if len(word) > RUN:
                ids[i] = self.encode_runs(word.decode())
        return ids

    def encode_runs(self, word: str) -> np.ndarray:
        runs = (self.encoder.encode(word[i : i + RUN]) for i in range(0, len(word), RUN))
        return np.concatenate([np.array(r, dtype=np.int32) for r in runs])

    def entropies(self, of: np.ndarray, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Entropy over the logarithm of the token count of each of ``len(n)`` groups of ``n`` tokens."""
        pairs = np.sort(of * self.size + ids)
        edges = np.flatnonzero(np.diff(pairs, prepend=-1, append=-1))
        times = np.diff(edges)
        spent = np.bincount(pairs[edges[:-1]] // self.size, weights=times * np.log(times), minlength=len(n))
        some = np.maximum(n, 2)
        return np.where(n > 1, (np.log(some) - spent / some) / np.log(some), np.where(n == 1, 1.0, 0.0))

    def token_measures(self, split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: tokens, byte tokens, entropy over the logarithm of the token count, mean of windows."""
        texts = len(split)
        ids, length = self.words.tokens_of([w for words in split for w in words])
        text = np.repeat(np.repeat(np.arange(texts), [len(words) for words in split]), length)
        n = np.bincount(text, minlength=texts)
        n_bytes = np.bincount(text[self.is_byte[ids]], minlength=texts)
        # Windows are spread evenly from the first token to the last and overlap where they must.
        windows = np.maximum(-(-n // WINDOW), 1)
        owner = np.repeat(np.arange(texts), windows)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        size = np.minimum(n, WINDOW)[owner]
        first = (np.cumsum(n) - n)[owner] + nth * (n[owner] - size) // np.maximum(windows[owner] - 1, 1)
        at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        each = self.entropies(np.repeat(np.arange(len(owner)), size), ids[at], size)
        mean = np.bincount(owner, weights=each, minlength=texts) / windows
        return n, n_bytes, np.round(self.entropies(text, ids, n), 9), np.round(mean, 9)

    def long_measures(self, data: bytes) -> tuple[int, int, float, float]:
        """``token_measures`` of one text, some megabytes of it at a time."""
        found = []
        for words in parts(data):
            found.append(self.words.tokens_of(words)[0])
            self.forget_many()
        ids = np.concatenate(found)
        del found
        n = len(ids)
        times = np.bincount(ids, minlength=self.size)
        n_bytes = int(times[self.is_byte].sum())
        times = times[times > 0]
        spent = np.bincount(np.zeros(len(times), dtype=np.int64), weights=times * np.log(times), minlength=1)[0]
        some = max(n, 2)
        entropy = (np.log(some) - spent / some) / np.log(some) if n > 1 else float(n)
        windows, size = max(-(-n // WINDOW), 1), min(n, WINDOW)
        first = np.arange(windows) * (n - size) // max(windows - 1, 1)
        each = []
        for i in range(0, windows, 10_000):
            start = first[i : i + 10_000]
            at = np.repeat(start, size) + np.tile(np.arange(size), len(start))
            owner = np.repeat(np.arange(len(start)), size)
            each.append(self.entropies(owner, ids[at], np.full(len(start), size)))
        weights = np.concatenate(each)
        mean = np.bincount(np.zeros(windows, dtype=np.int64), weights=weights, minlength=1)[0] / windows
        return n, n_bytes, float(np.round(entropy, 9)), float(np.round(mean, 9))

    def forget_many(self) -> None:
        if len(self.words.tokens) > TOKENS:
            self.words.forget()

    def long_text(self, text: str) -> dict:
        """The measures of a text of more than ``LONG`` characters."""
        data = text.encode()
        words, kinds = numbered(data)
        n_words, repeated = len(words), repeat_numbers(words, kinds)
        del words
        n, n_bytes, entropy, mean = self.long_measures(data)
        del data
        return self._row(text, n_words, repeated, n, n_bytes, entropy, mean)

    @staticmethod
    def _row(text: str, n_words: int, repeated: int, n: int, n_bytes: int, entropy: float, mean: float) -> dict:
        return {
            "n_words": n_words,
            "word_chars": len(text) - sum(map(text.count, BLANK)),
            "n_symbols": sum(map(text.count, SYMBOLS)),
            "n_dup_lines": duplicate_lines(text),
            "n_repeat_words": repeated,
            "n_tokens": n,
            "n_bytes": n_bytes,
            "entropy": entropy,
            "window_entropy": mean,
            "script": script_of(text),
        }

    def __call__(self, texts: list[str | None]) -> list[dict]:
        out = []
        for start, end in spans([len(t or "") for t in texts], 500_000):
            part = [t or "" for t in texts[start:end]]
            if len(part[0]) > LONG:
                out.append(self.long_text(part[0]))  # such a text stands alone
                continue
            self.forget_many()
            split = [t.encode().split() for t in part]
            for text, words, n, n_bytes, entropy, mean in zip(part, split, *map(np.ndarray.tolist, self.token_measures(split))):
                out.append(self._row(text, len(words), repeat_words(words), n, n_bytes, entropy, mean))
        return out


def measure(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> tuple[DataFrame, str]:
    """``docs`` with one struct column of the measures (``FIELDS``), and that column's name.

    The vocabulary's bytes travel with the task, so executors need no file.
    """
    with open(os.fspath(vocabulary), "rb") as file:
        model = file.read()
    name = free_name(docs, "measures")
    return annotate(docs, text, lambda: Meter(model), name, FIELDS), name


def base_failed(measures: Column) -> Column:
    """Too short, or more than half of its words inside repeated windows."""
    n_words, repeated = measures["n_words"], measures["n_repeat_words"]
    return (n_words < 50) | (100 * repeated > 50 * n_words)


def ratios(measures: Column) -> list[Column]:
    """The three measures that bands hold; null without tokens."""
    n = measures["n_tokens"]
    return [
        (measures["word_chars"] / F.nullif(n, F.lit(0))).alias("chars_per_token"),
        (measures["n_bytes"] / F.nullif(n, F.lit(0))).alias("byte_share"),
        F.when(n > 0, measures["window_entropy"]).alias("window_entropy"),
    ]


RATIOS = ("chars_per_token", "byte_share", "window_entropy")
#: Which ends of a band reject: text is not rejected for few byte tokens or for high entropy.
ENDS = {"chars_per_token": "both", "byte_share": "high", "window_entropy": "low"}
#: Least half width of a band, so that a group of near-equal texts does not reject small differences.
SLACK = {"chars_per_token": 0.25, "byte_share": 0.02, "window_entropy": 0.15}


def drawn(own: Column, parent: Column, n: Column, prior: float) -> Column:
    """Median, range and widening of each ratio: ``own`` quartiles of ``n`` texts, drawn towards ``parent``."""
    w = n / (n + F.lit(prior))
    out = []
    for r in RATIOS:
        mid, spread = own[r][1], own[r][2] - own[r][0]
        above = parent[r]
        out.append(
            F.struct(
                (w * mid + (1 - w) * above["mid"]).alias("mid"),
                (w * spread + (1 - w) * above["spread"]).alias("spread"),
                ((1 - w) * above["more"] + F.sqrt(w * (1 - w)) * F.abs(mid - above["mid"])).alias("more"),
            ).alias(r)
        )
    return F.struct(*out)


def fit_bands(ratios_by_group: DataFrame, width: float = 4.0, prior: float = 20.0) -> DataFrame:
    """Low and high end of each ratio per ``group``, from all texts that pass the base rule.

    The quantiles are sketches that each task builds over its own rows, so a group with a third of
    all rows costs no more than any other.
    """
    quartiles = F.struct(*[F.percentile_approx(r, [0.25, 0.5, 0.75], 10000).alias(r) for r in RATIOS]).alias("own")
    mid_of = [F.struct(F.col("own")[r][1].alias("mid"), (F.col("own")[r][2] - F.col("own")[r][0]).alias("spread"), F.lit(0.0).alias("more")).alias(r) for r in RATIOS]
    whole = ratios_by_group.agg(quartiles).select(F.struct(*mid_of).alias("parent"))  # one row
    scripts = ratios_by_group.groupBy("script").agg(F.count("*").alias("n"), quartiles).crossJoin(F.broadcast(whole))
    scripts = scripts.select("script", drawn(F.col("own"), F.col("parent"), F.col("n"), prior).alias("parent"))
    main = ratios_by_group.groupBy("group", "script").agg(F.count("*").alias("n")).groupBy("group").agg(
        F.max_by("script", F.struct("n", "script")).alias("script")
    )
    by_group = ratios_by_group.groupBy("group").agg(F.count("*").alias("n"), quartiles)
    # Scripts are a closed list of Unicode, a few hundred.
    bands = by_group.join(main, "group").join(F.broadcast(scripts), "script")
    bands = bands.select("group", drawn(F.col("own"), F.col("parent"), F.col("n"), prior).alias("b"))
    for r in RATIOS:
        reach = F.greatest(F.col("b")[r]["spread"] * width, F.lit(SLACK[r])) + F.col("b")[r]["more"]
        low = F.col("b")[r]["mid"] - reach if ENDS[r] in ("both", "low") else F.lit(None).cast("double")
        high = F.col("b")[r]["mid"] + reach if ENDS[r] in ("both", "high") else F.lit(None).cast("double")
        bands = bands.withColumn(f"{r}_low", low).withColumn(f"{r}_high", high)
    return bands.select("group", *[f"{r}_{end}" for r in RATIOS for end in ("low", "high")])


def judge(
    docs: DataFrame, text: str = "text", language: str | None = "lang", vocabulary: str = VOCABULARY,
    width: float = 4.0, prior: float = 20.0,
) -> tuple[DataFrame, str]:
    """``docs`` with one struct column ``verdict``: the measures, ratios, ``base_failed`` and ``kept``.

    ``language`` names the column that bands go by; None takes the script of the text. The measured
    rows are written once to the shared folder; bands and verdicts both read them, so no text is
    encoded twice and no text is shuffled.
    """
    measured, m = measure(docs, text, vocabulary)
    group = free_name(measured, "group")
    by = F.coalesce(F.col(language).cast("string"), F.lit("und")) if language else F.col(m)["script"]
    measured = stored(measured.withColumn(group, by), "fertility")
    passed = measured.filter(~base_failed(F.col(m))).select(F.col(group).alias("group"), F.col(m)["script"].alias("script"), *ratios(F.col(m)))
    bands = stored(fit_bands(passed, width, prior), "bands")  # a row for each language
    ends = [c for c in bands.columns if c != "group"]
    own = bands.select(F.col("group").alias("__group"), F.struct(*ends).alias("__band"))
    joined = measured.join(own, F.col(group) == F.col("__group"), "left")

    within = F.lit(True)
    for value, r in zip(ratios(F.col(m)), RATIOS):
        for outside in (value < F.col("__band")[f"{r}_low"], value > F.col("__band")[f"{r}_high"]):
            within = within & ~F.coalesce(outside, F.lit(False))
    failed = base_failed(F.col(m))
    verdict = F.struct(
        *[F.col(m)[f.name].alias(f.name) for f in FIELDS if f.name not in ("entropy", "script", *RATIOS)], *ratios(F.col(m)),
        F.when(F.col(m)["n_tokens"] > 0, F.col(m)["entropy"]).alias("entropy"),
        failed.alias("base_failed"), (~failed & within).alias("kept"),
    )
    name = free_name(docs, "verdict")
    return joined.select(*[joined[f"`{c}`"] for c in docs.columns], verdict.alias(name)), name


def keep(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the same columns."""
    judged, verdict = judge(docs, **options)
    return judged.filter(F.col(verdict)["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])
