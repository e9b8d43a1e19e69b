"""Words of long texts in parts; words and their tokens, remembered per task."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count, islice

import numpy as np


#: Bytes of a text that are split at a time.
PART = 4_000_000


def parts(data: bytes, size: int = PART) -> Iterator[list[bytes]]:
    """The words of a text, some megabytes of it at a time, cut between words."""
    if len(data) <= size:
        yield data.split()
        return
    rest = b""
    for start in range(0, len(data), size):
        words = (rest + data[start : start + size]).split()
        # The last word may go on in the next part.
        rest = b"" if data[start + size - 1 : start + size].isspace() or not words else words.pop()
        yield words
    yield rest.split()


def numbered(data: bytes, size: int = PART) -> tuple[np.ndarray, int]:
    """The words of a text as numbers in order of first sight, and how many differ."""
    known: dict = defaultdict(count().__next__)
    found = [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for words in parts(data, size)]
    return np.concatenate(found), len(known)


class Remembered:
    """Numbers words and keeps the tokens of each in one array; forgets all beyond ``most`` words."""

    def __init__(self, encode: Callable[[list], list[list[int]]], most: int = 300_000):
        self.encode, self.most = encode, most
        self.forget()

    def forget(self) -> None:
        self.known: dict = defaultdict(count().__next__)  # a new word gets the next number
        self.tokens = np.empty(0, dtype=np.int32)
        self.starts = np.zeros(1, dtype=np.int64)  # of each word, and the end of the last

    def tokens_of(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words in a row, and how many each word has. New words are encoded."""
        if len(self.known) > self.most:
            self.forget()
        first = len(self.known)
        number = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if len(self.known) > first:
            ids = self.encode(list(islice(self.known, first, None)))
            ends = self.starts[-1] + np.cumsum([len(i) for i in ids], dtype=np.int64)
            self.starts = np.concatenate([self.starts, ends])
            self.tokens = np.concatenate([self.tokens, np.fromiter(chain.from_iterable(ids), np.int32)])
        length = self.starts[number + 1] - self.starts[number]
        before = np.cumsum(length) - length
        return self.tokens[np.repeat(self.starts[number] - before, length) + np.arange(length.sum())], length
