"""Subword ids of texts by way of a table of words, each of which is encoded once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

EncodeWords = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


class WordTable(dict):
    """Numbers words as they are met; one flat array holds the ids of all of them.

    ``encode`` turns words into (all their ids, how many each has). It must be right to
    encode a text word by word. Looking a word up numbers it, if it is new.
    """

    def __init__(self, encode: EncodeWords):
        super().__init__()
        self.encode = encode
        self.words: list[bytes] = []
        self.forget()

    def __missing__(self, word: bytes) -> int:
        self[word] = row = len(self.words)
        self.words.append(word)
        return row

    def forget(self) -> None:
        self.clear()
        self.words.clear()
        self.flat, self.start = np.empty(0, np.int32), np.zeros(1, np.int64)

    def rows(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def settle(self) -> None:
        """Encode the words met since the last call."""
        fresh = self.words[len(self.start) - 1 :]
        if fresh:
            ids, sizes = self.encode(fresh)
            self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])

    def tokens(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in ``rows`` one after another, and how many each has."""
        sizes = self.start[rows + 1] - self.start[rows]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.start[rows] - (ends - sizes), sizes)
        return self.flat[at], sizes

    def sequences(self, texts: list[bytes], end: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word rows of all texts, words of each; ids of all texts with the end after each, ids of each."""
        split = [t.split() for t in texts]
        n = np.fromiter(map(len, split), np.int64, len(split))
        rows = np.concatenate([np.empty(0, np.int64), *map(self.rows, split)])
        self.settle()
        ids, sizes = self.tokens(rows)
        edge = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(np.concatenate([[0], n]))]
        if end is None:
            return rows, n, ids, np.diff(edge)
        return rows, n, np.insert(ids, edge[1:], end), np.diff(edge) + 1
