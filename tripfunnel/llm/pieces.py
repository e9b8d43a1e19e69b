"""SentencePiece encoding and decoding by Viterbi over a trie of words.

A text is cut before every run of blanks, after one blank is put in front (the word-start mark): no
piece holds a mark behind another character, so the best split of a text is that of its marked words.
Each task sorts the distinct marked words it has not met, which is the depth-first order of their trie:
the forward scores of a prefix are computed once and used by all words that share it. At a node, pieces
that end there are tried from short to long, as long as the letters are the end of some piece. Pieces
and scores are those of a public vocabulary; the best split has the largest sum of scores, of equal
sums the one whose last piece is longest.

A character that no piece covers costs ``unknown`` and is written as its UTF-8 bytes (byte fallback);
so is a mark character that was in the text itself. Decoding joins the pieces and gives back every
text exactly.

Defined cases: a null text has null ids and decodes to null; an empty text has no ids; ids of equal rows
are equal; an empty table gives an empty result. A vocabulary must have the 256 byte pieces.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripfunnel.llm.common import slices, texts_of
from tripfunnel.llm.words import Remembered

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MARKED = re.compile(" +[^ ]*")


@dataclass
class Pieces:
    """A vocabulary: ids and scores by text (blank for the mark), and the ids of the 256 bytes."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    spelled: list[bytes]  # of every id
    unknown: float
    #: Every end of a piece; its score, or None if it is no piece itself.
    ends: dict[str, float | None] = field(default_factory=dict)

    def __post_init__(self):
        for piece in self.ids:
            for i in range(1, len(piece)):
                self.ends.setdefault(piece[i:], None)
        self.ends.update(self.scores)

    @staticmethod
    def read(model: bytes) -> Pieces:
        vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids, scores, spelled, byte_ids = {}, {}, [], [-1] * 256
        for i in range(vocabulary.get_piece_size()):
            piece = vocabulary.id_to_piece(i)
            if vocabulary.is_byte(i):
                value = int(piece[3:-1], 16)
                byte_ids[value] = i
                spelled.append(bytes([value]))
            elif vocabulary.is_control(i) or vocabulary.is_unknown(i) or vocabulary.is_unused(i):
                spelled.append(b"")
            else:
                text = piece.replace(MARK, " ")
                ids[text], scores[text] = i, vocabulary.get_score(i)
                spelled.append(text.encode())
        if -1 in byte_ids:
            raise ValueError("the vocabulary has no byte fallback")
        return Pieces(ids, scores, byte_ids, spelled, min(scores.values(), default=0.0) - 10.0)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each marked word, in the order given."""
        out: dict[str, list[int]] = {}
        ends, unknown = self.ends, self.unknown
        best, back, before = [0.0], [0], ""  # by position: score of the best split up to there, start of its last piece
        for word in sorted(words):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del best[shared + 1 :], back[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                top, at = best[end - 1] + unknown, end - 1
                start = end - 1
                while start >= 0:
                    letters = word[start:end]
                    if letters not in ends:
                        break
                    score = ends[letters]
                    if score is not None and best[start] + score >= top:
                        top, at = best[start] + score, start
                    start -= 1
                best.append(top)
                back.append(at)
            out[word] = self._path(word, back)
            before = word
        return [out[w] for w in words]

    def _path(self, word: str, back: list[int]) -> list[int]:
        path, end = [], len(word)
        while end:
            start = back[end]
            found = self.ids.get(word[start:end])
            if found is None:
                path.extend(self.byte_ids[b] for b in reversed(word[start:end].encode()))
            else:
                path.append(found)
            end = start
        return path[::-1]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.spelled.__getitem__, ids)).decode()[1:]


def marked_words(text: str) -> list[str]:
    return MARKED.findall(f" {text}") if text else []


class Codec:
    """Encodes and decodes texts of one task."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.words = Remembered(pieces.encode_words)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """The ids of all texts in a row, how many each text has, and its number of marked words."""
        split = [marked_words(t) if t else [] for t in texts]
        ids, lengths = self.words.tokens_of([w for words in split for w in words])
        many = [len(words) for words in split]
        of = np.repeat(np.arange(len(split)), many)
        return ids, np.bincount(of, weights=lengths, minlength=len(split)).astype(np.int64), many

    def decode(self, ids: np.ndarray) -> str:
        return self.pieces.decode(ids.tolist())


def _list_array(ids: np.ndarray, sizes: np.ndarray, null: list[bool]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    masked = pa.array(offsets, pa.int32(), mask=np.append(null, False))  # a null offset is a null list
    return pa.ListArray.from_arrays(masked, pa.array(ids, pa.int32()))


def _read(vocabulary: str) -> bytes:
    with open(vocabulary, "rb") as file:
        return file.read()


def encode(docs: DataFrame, text: str = "text", id_column: str = "doc_id", vocabulary: str = VOCABULARY) -> DataFrame:
    """Id, ``n_words``, ``n_tokens``, ``ids`` and ``round_trip`` (whether decoding gives the text back).

    The vocabulary's bytes travel with the task, so executors need no file. Texts are not shuffled.
    """
    model = _read(vocabulary)
    chosen = docs.select(id_column, text)
    kind = chosen.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField(id_column, kind), T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType()),
        ]
    )

    def run(batches):
        codec = Codec(Pieces.read(model))
        for batch in batches:
            for rows in slices(batch, text, 500_000):
                part = texts_of(rows, text)
                ids, sizes, many = codec.encode(part)
                stops = np.cumsum(sizes)
                same = [
                    None if t is None else codec.decode(ids[stop - size : stop]) == t if size else t == ""
                    for t, stop, size in zip(part, stops, sizes)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0), pa.array(many, pa.int64()), pa.array(sizes),
                        _list_array(ids, sizes, [t is None for t in part]), pa.array(same, pa.bool_()),
                    ],
                    names=schema.names,
                )

    return chosen.mapInArrow(run, schema)


def decode(encoded: DataFrame, ids: str = "ids", id_column: str = "doc_id", vocabulary: str = VOCABULARY) -> DataFrame:
    """Id and ``text`` of every row of ``encoded``."""
    model = _read(vocabulary)
    chosen = encoded.select(id_column, ids)
    schema = T.StructType([chosen.schema[id_column], T.StructField("text", T.StringType())])

    def run(batches):
        pieces = Pieces.read(model)
        for batch in batches:
            texts = [None if i is None else pieces.decode(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=schema.names)

    return chosen.mapInArrow(run, schema)
