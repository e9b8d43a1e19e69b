"""Cross-entropy difference of two matched word-bigram models.

Tokens are words: runs of letters and digits, single characters of scripts that write no blanks, and runs
of marks. Both models share one vocabulary, all words that occur twice or more in both corpora together,
one unknown token for the others, and one mark before and after a text. They are matched: same order,
vocabulary and smoothing (interpolated Witten-Bell; below the single word lies the uniform distribution).
A text's tokens are its words and the end mark; the score is the mean over tokens of
``loss(target) - loss(background)`` in nats: negative for text more like the target.

Where the documents themselves are the background, each is scored by the model of all *other* documents:
what it adds to counts, kinds and totals is taken off exactly. Otherwise a text would vouch for itself, and
the more so the rarer its words are. The vocabulary is that of all texts.

Texts are split into words once. They are kept as slices of about ``SLICE`` bytes of text: numbers of the
slice's own words, and the hashes (64 bits) and counts of those. Slices then ask twice, with packed blocks:

* words, dealt out by hash: what number a word has, and how often it occurs in either corpus;
* bigrams, dealt out by the word before: how often each occurs, and how many different words follow.

A bucket sums what all slices sent and answers every slice in its own order, so that all that a text's losses
need comes back to its slice. Nothing is broadcast but the few words so frequent (more than ``HOT`` times)
that the bigrams behind one are spread over buckets, and the number of their followers. Neither words nor
bigrams are bounded. Buckets grow in number with what is counted, so none grows with the input.

Defined cases: a null text is like an empty one: its only token is the end mark; equal rows get equal
scores and are counted as often as they occur (so they vouch for each other); models of empty tables are
uniform; an empty table of documents gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfunnel.llm.common import free_name, slices, spans, stored, texts_of

#: Thai to Myanmar, Khmer, Kana, Han: each character is a word.
SINGLE = "฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff"
TOKEN = re.compile(rf"[{SINGLE}]|[^\W{SINGLE}]+|[^\w\s]+")
UNKNOWN, MARK = 0, 1
#: Bytes and rows of text in a slice.
SLICE, SLICE_ROWS = 8_000_000, 200_000
#: Words or bigrams that all slices together send to one bucket, about.
BUCKET = 4_000_000
#: Occurrences from which the bigrams behind a word are spread over buckets.
HOT = 1_000_000
#: Tokens whose losses are worked out together.
TOKENS = 400_000
TARGET, BACKGROUND, ASKS_ONLY = 0, 1, 2

LOSSES = T.StructType(
    [T.StructField("n_tokens", T.LongType()), *[T.StructField(n, T.DoubleType()) for n in ("target_loss", "background_loss", "score")]]
)
_SLICE = "slice long, side int, head binary, sizes binary, tokens binary, texts int, words int, n_tokens long"


def parts_of(text: str | None, most: int = 1_000_000) -> Iterator[list[str]]:
    """The words of a text, some megabytes at a time."""
    text, at = text or "", 0
    while len(text) - at > most:
        end = text.find(" ", at + most)
        if end < 0:
            break
        yield TOKEN.findall(text[at:end])
        at = end
    yield TOKEN.findall(text[at:] if at else text)


def pack(values: np.ndarray) -> bytes:
    """Integers with like bytes side by side, compressed; their number and width go ahead."""
    values = np.asarray(values, dtype=np.int64)
    if not len(values):
        return b""
    wide = values.astype(np.int32) if -(2**31) <= values.min() and values.max() < 2**31 else values
    size = wide.dtype.itemsize
    body = pa.compress(np.ascontiguousarray(wide.view(np.uint8).reshape(-1, size).T).tobytes(), codec="zstd", asbytes=True)
    return np.array([len(values), size], dtype=np.int64).tobytes() + body


def unpack(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, dtype=np.int64)
    n, size = np.frombuffer(raw[:16], dtype=np.int64).tolist()
    planes = np.frombuffer(pa.decompress(raw[16:], n * size, codec="zstd", asbytes=True), dtype=np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(np.int32 if size == 4 else np.int64).reshape(-1).astype(np.int64)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int16 if buckets < 1 << 15 else np.int32)


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs, and the places of its keys in their order."""
    bucket = bucket_of(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(bucket[order[start]]), order[start:end]


def rows_of(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def arrow_schema(spec: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in spec.split(", "))])


# ---- slices ----------------------------------------------------------------------------------------------


def _read(text: str, side: int, asked: bool):
    schema = arrow_schema(f"{_SLICE}, hashes binary, counts binary")

    def run(batches):
        at = (side << 60) + (TaskContext.get().partitionId() << 28)
        number: dict = defaultdict(count().__next__)
        heads, sizes, tokens, length = [], [], [], 0

        def made():
            nonlocal at, number, heads, sizes, tokens, length
            ids = np.concatenate(tokens) if tokens else np.zeros(0, dtype=np.int32)
            hashes = np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in number], dtype=np.uint64)
            head = None
            if asked:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, heads[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    for h in heads:
                        writer.write_batch(h)
                head = sink.getvalue().to_pybytes()
            counts = pack(np.bincount(ids, minlength=len(number)))
            row = (at, side, head, pack(sizes), pack(ids), len(sizes), len(number), len(ids) + len(sizes), pack(hashes.view(np.int64)), counts)
            at += 1
            number, heads, sizes, tokens, length = defaultdict(count().__next__), [], [], [], 0
            return rows_of(schema, [row])

        for batch in batches:
            for part in slices(batch, text):
                for t in texts_of(part, text):
                    size = 0
                    for words in parts_of(t):
                        tokens.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                        size += len(words)
                    sizes.append(size)
                    length += len(t or "")
                if asked:
                    heads.append(part.drop_columns([text]))
                if length >= SLICE or len(sizes) >= SLICE_ROWS:
                    yield made()
        if sizes:
            yield made()

    return run


def read(texts: DataFrame, text: str, side: int, asked: bool) -> DataFrame:
    """One row per slice: its words by number, their hashes and counts, and the other columns of its texts."""
    return texts.mapInArrow(_read(text, side, asked), f"{_SLICE}, hashes binary, counts binary")


# ---- words -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Corpora:
    """What holds for both corpora as wholes; pairs are target, background."""

    size: int  # of the vocabulary, the unknown token and the mark included
    total: tuple[int, int]  # tokens
    kinds: tuple[int, int]  # different tokens
    unknown: tuple[int, int]
    texts: tuple[int, int]
    hot: np.ndarray  # numbers of the hot words, in order


_TOLD = "slice long, bucket int, ids binary, a binary, b binary"


def _ask_words(buckets: int):
    schema = arrow_schema("bucket int, slice long, side int, hashes binary, counts binary")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                hashes, counts = unpack(row["hashes"]), unpack(row["counts"])
                yield rows_of(schema, [
                    (b, row["slice"], row["side"], pack(hashes[at]), pack(counts[at])) for b, at in by_bucket(hashes, buckets)
                ])

    return run


def _tell_words(buckets: int, hot: int):
    """A bucket's answers to all slices, and two rows on itself: sums (slice -1), hot words (slice -2).

    The k-th most frequent word of a bucket gets a number that no other bucket gives, smaller the more frequent.
    """
    schema = arrow_schema(_TOLD)

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        hashes = [unpack(r["hashes"]) for r in rows]
        lengths = [len(h) for h in hashes]
        known, place = np.unique(np.concatenate(hashes), return_inverse=True)
        side = np.repeat([r["side"] for r in rows], lengths)
        counts = np.concatenate([unpack(r["counts"]) for r in rows])
        n = [np.bincount(place[side == s], weights=counts[side == s], minlength=len(known)).astype(np.int64) for s in (TARGET, BACKGROUND)]
        both = n[0] + n[1]
        often = both > 1
        order = np.argsort(-both, kind="stable")
        ids = np.empty(len(known), dtype=np.int64)
        ids[order] = np.arange(len(known)) * buckets + rows[0]["bucket"] + MARK + 1
        ids[~often] = UNKNOWN
        sums = [often.sum(), *[(often & (x > 0)).sum() for x in n], *[x[~often].sum() for x in n], *[x.sum() for x in n]]
        out = [(-1, rows[0]["bucket"], pack(sums), None, None)]
        if (both > hot).any():
            out.append((-2, rows[0]["bucket"], pack(np.sort(ids[both > hot])), None, None))
        ends = np.cumsum(lengths)
        for row, start, end in zip(rows, ends - lengths, ends):
            at = place[start:end]
            out.append((row["slice"], row["bucket"], pack(ids[at]), pack(n[0][at]), pack(n[1][at])))
        return pa.Table.from_batches([rows_of(schema, out)])

    return run


def corpora_of(told: DataFrame, texts: dict[int, int], hot: int) -> Corpora:
    """From the buckets' rows on themselves: a few numbers each."""
    sums, often = np.zeros(7, dtype=np.int64), [np.zeros(0, dtype=np.int64)]
    for row in told.filter("slice < 0").select("slice", "ids").toLocalIterator():
        if row["slice"] == -1:
            sums += unpack(row["ids"])
        else:
            often.append(unpack(row["ids"]))
    known, kinds, unknown, words = int(sums[0]), sums[1:3], sums[3:5], sums[5:7]
    marks = np.array([texts.get(TARGET, 0), texts.get(BACKGROUND, 0)])
    special = [i for i, n in ((UNKNOWN, unknown.sum()), (MARK, marks.sum())) if n > hot]
    pair = lambda x: tuple(map(int, x))
    return Corpora(
        known + MARK + 1, pair(words + marks), pair(kinds + (unknown > 0) + (marks > 0)), pair(unknown), pair(marks),
        np.sort(np.concatenate([*often, np.array(special, dtype=np.int64)])),
    )


_NUMBERED = f"{_SLICE}, ids binary, a binary, b binary"


def _number(buckets: int):
    """Puts the answers on a slice's words into the order of its words."""
    schema = arrow_schema(_NUMBERED)

    def run(own: pa.Table, told: pa.Table) -> pa.Table:
        (row,) = own.to_pylist()
        hashes = unpack(row["hashes"])
        found = np.zeros((3, len(hashes)), dtype=np.int64)
        places = dict(by_bucket(hashes, buckets))
        for answer in told.to_pylist():
            found[:, places[answer["bucket"]]] = [unpack(answer[c]) for c in ("ids", "a", "b")]
        return pa.Table.from_batches([rows_of(schema, [tuple(row[c] for c in schema.names[:8]) + tuple(map(pack, found))])])

    return run


# ---- bigrams ---------------------------------------------------------------------------------------------


class Bigrams:
    """The bigrams of one slice: their codes in order, and the bucket each is dealt to."""

    def __init__(self, row: dict, corpora: Corpora, buckets: int):
        self.row, self.buckets = row, buckets
        self.codes, self.counts = np.unique(self.read(), return_counts=True)
        context = self.codes >> 32
        key = np.where(np.isin(context, corpora.hot), self.codes, context << 32)
        self.key = key ^ (key >> 31)

    def read(self) -> np.ndarray:
        """The bigrams as they stand in the texts, with a mark before and after each text."""
        ids = unpack(self.row["ids"])
        self.sizes = unpack(self.row["sizes"])
        ends = np.concatenate([[0], np.cumsum(self.sizes)])
        tokens = unpack(self.row["tokens"])
        text = np.insert(ids[tokens] if len(ids) else tokens, ends, MARK)
        place = text[:-1] << 32
        place |= text[1:]
        return place

    def dealt(self) -> Iterator[tuple[int, np.ndarray]]:
        return by_bucket(self.key, self.buckets)


def _ask_bigrams(corpora: Corpora, buckets: int, asked_side: int):
    schema = arrow_schema("bucket int, slice long, side int, asks boolean, codes binary, counts binary")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own, asks = Bigrams(row, corpora, buckets), row["side"] == asked_side
                rows = []
                for b, at in own.dealt():
                    rows.append((b, row["slice"], row["side"], asks, pack(np.diff(own.codes[at], prepend=0)), pack(own.counts[at])))
                yield rows_of(schema, rows)

    return run


_ANSWERS = "slice long, bucket int, a binary, b binary, ka binary, kb binary"


def _tell_bigrams(hot: np.ndarray):
    """To every slice that asks: counts of its bigrams, and for each word before (in order) how many follow it.

    For hot words that is a part; the parts of all buckets are in one more row (slice -1).
    """
    schema = arrow_schema(_ANSWERS)

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = [np.cumsum(unpack(r["codes"])) for r in rows]
        lengths = [len(p) for p in parts]
        codes, place = np.unique(np.concatenate(parts), return_inverse=True)
        side = np.repeat([r["side"] for r in rows], lengths)
        counts = np.concatenate([unpack(r["counts"]) for r in rows])
        n = [np.bincount(place[side == s], weights=counts[side == s], minlength=len(codes)).astype(np.int64) for s in (TARGET, BACKGROUND)]
        context, of = np.unique(codes >> 32, return_inverse=True)
        kinds = [np.bincount(of[x > 0], minlength=len(context)) for x in n]
        bucket, out = rows[0]["bucket"], []
        spread = np.isin(context, hot)
        if spread.any():
            out.append((-1, bucket, pack(context[spread]), None, *[pack(k[spread]) for k in kinds]))
        ends = np.cumsum(lengths)
        for row, start, end in zip(rows, ends - lengths, ends):
            if row["asks"]:
                at = place[start:end]
                before = np.unique(of[at])
                out.append((row["slice"], bucket, pack(n[0][at]), pack(n[1][at]), *[pack(k[before]) for k in kinds]))
        return pa.Table.from_batches([rows_of(schema, out)])

    return run


def hot_kinds(answers: DataFrame, hot: np.ndarray) -> np.ndarray:
    """How many different words follow each hot word, in either corpus; one row a bucket holds some of them."""
    kinds = np.zeros((2, len(hot)), dtype=np.int64)
    for row in answers.filter("slice = -1").toLocalIterator():
        at = np.searchsorted(hot, unpack(row["a"]))
        kinds[0, at] += unpack(row["ka"])
        kinds[1, at] += unpack(row["kb"])
    return kinds


# ---- losses ----------------------------------------------------------------------------------------------


def loss(n, follows, kinds, single) -> np.ndarray:
    """-log P(word | word before): Witten-Bell between the bigram's share and the single word's."""
    seen = follows + kinds
    return -np.log(np.where(seen > 0, (n + kinds * single) / np.maximum(seen, 1), single))


def single(n, total, kinds, size) -> np.ndarray:
    """P(word), drawn towards the uniform distribution."""
    return np.where(total > 0, (n + kinds / size) / np.maximum(total + kinds, 1), 1 / size)


def _finish(corpora: Corpora, kinds_of_hot: np.ndarray, buckets: int, own_background: bool, name: str):
    """Losses of the texts of a slice, some texts at a time."""

    def run(numbered: pa.Table, answers: pa.Table) -> pa.Table:
        (row,) = numbered.to_pylist()
        own = Bigrams(row, corpora, buckets)
        context, word = own.codes >> 32, own.codes & 0xFFFFFFFF
        places = dict(own.dealt())
        n, kinds = np.zeros((2, len(context)), dtype=np.int64), np.zeros((2, len(context)), dtype=np.int64)
        for answer in answers.to_pylist():
            at = places.pop(answer["bucket"])
            n[0, at], n[1, at] = unpack(answer["a"]), unpack(answer["b"])
            _, of = np.unique(context[at], return_inverse=True)
            kinds[0, at], kinds[1, at] = unpack(answer["ka"])[of], unpack(answer["kb"])[of]
        if len(corpora.hot):
            spread = np.isin(context, corpora.hot)
            kinds[:, spread] = kinds_of_hot[:, np.searchsorted(corpora.hot, context[spread])]
        # How often each token of the slice occurs in the corpora.
        ids, first = np.unique(np.concatenate([[UNKNOWN, MARK], unpack(row["ids"])]), return_index=True)
        often = [np.concatenate([[corpora.unknown[s], corpora.texts[s]], unpack(row[c])])[first] for s, c in enumerate("ab")]
        before, after = np.searchsorted(ids, context), np.searchsorted(ids, word)
        place, weight = own.read(), own.sizes + 1
        edges = np.concatenate([[0], np.cumsum(weight)])

        def sums(start: int, end: int) -> list[np.ndarray]:
            """Both losses of texts ``start`` to ``end``, summed over their tokens."""
            docs, w = end - start, weight[start:end]
            found, of = np.unique(place[edges[start] : edges[end]], return_inverse=True)
            pair, times = np.unique(of * docs + np.repeat(np.arange(docs), w), return_counts=True)
            code, doc = np.divmod(pair, docs)
            code = np.searchsorted(own.codes, found)[code]
            a, b = before[code], after[code]
            follows, kind, here = [x[a] for x in often], [k[code] for k in kinds], [x[code] for x in n]
            alone, total, some = [x[b] for x in often], list(corpora.total), list(corpora.kinds)
            if own_background:  # take off what the text itself has added
                token, of = np.unique(a * docs + doc, return_inverse=True)
                mine = np.bincount(of, weights=times).astype(np.int64)  # occurrences of a token in a text
                gone = np.bincount(of, weights=here[1] == times).astype(np.int64)  # followers that only the text has
                last = often[1][token // docs] == mine
                total[1] = total[1] - w[doc]
                some[1] = some[1] - np.bincount(token[last] % docs, minlength=docs)[doc]
                here[1], follows[1], kind[1] = here[1] - times, follows[1] - mine[of], kind[1] - gone[of]
                alone[1] = alone[1] - mine[np.searchsorted(token, b * docs + doc)]
            return [
                np.bincount(doc, weights=times * loss(
                    here[s], follows[s], kind[s], single(alone[s], np.asarray(total[s]), some[s], corpora.size)
                ), minlength=docs)
                for s in (TARGET, BACKGROUND)
            ]

        parts = [sums(start, end) for start, end in spans(weight.tolist(), TOKENS)]
        a, b = (np.concatenate(x) / weight for x in zip(*parts))
        made = [pa.array(weight), *[pa.array(np.round(x, 6)) for x in (a, b, a - b)]]
        head = pa.ipc.open_stream(row["head"]).read_all()
        return pa.Table.from_arrays([*head.columns, pa.StructArray.from_arrays(made, names=LOSSES.names)], names=[*head.column_names, name])

    return run


def score(docs: DataFrame, target: DataFrame, background: DataFrame | None = None, text: str = "text") -> tuple[DataFrame, str]:
    """The columns of ``docs`` without the text, a struct of token count, losses and score, and its name.

    ``target`` and ``background`` are tables with a ``text`` column; all their texts are counted. Without a
    ``background``, the documents are it, each scored by the others.
    """
    name = free_name(docs, "losses")
    asked_side = BACKGROUND if background is None else ASKS_ONLY
    parts = [read(target.select(text), text, TARGET, False), read(docs, text, asked_side, True)]
    if background is not None:
        parts.append(read(background.select(text), text, BACKGROUND, False))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    kept = stored(whole, "slices")
    sums = kept.groupBy("side").agg(*[F.sum(c).alias(c) for c in ("texts", "words", "n_tokens")]).collect()
    buckets = max(12, -(-sum(r["words"] for r in sums) // BUCKET))

    hot = HOT
    asked = kept.select("slice", "side", "hashes", "counts").mapInArrow(
        _ask_words(buckets), "bucket int, slice long, side int, hashes binary, counts binary"
    )
    told = stored(asked.groupBy("bucket").applyInArrow(_tell_words(buckets, hot), _TOLD), "words")
    corpora = corpora_of(told, {r["side"]: r["texts"] for r in sums}, hot)
    numbered = stored(
        kept.groupBy("slice").cogroup(told.filter("slice >= 0").groupBy("slice")).applyInArrow(_number(buckets), _NUMBERED), "numbered"
    )

    buckets = max(12, -(-sum(r["n_tokens"] for r in sums) // BUCKET))
    sent = numbered.drop("head").mapInArrow(
        _ask_bigrams(corpora, buckets, asked_side), "bucket int, slice long, side int, asks boolean, codes binary, counts binary"
    )
    answers = stored(sent.groupBy("bucket").applyInArrow(_tell_bigrams(corpora.hot), _ANSWERS), "answers")
    kinds = hot_kinds(answers, corpora.hot)

    others = [f for f in docs.schema.fields if f.name != text]
    finish = _finish(corpora, kinds, buckets, background is None, name)
    asking = numbered.filter(F.col("side") == asked_side).groupBy("slice")
    found = asking.cogroup(answers.filter("slice >= 0").groupBy("slice")).applyInArrow(
        finish, T.StructType([*others, T.StructField(name, LOSSES)])
    )
    return found, name
