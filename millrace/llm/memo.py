"""What a task remembers of the words it met, in columns of numbers."""

from __future__ import annotations

from itertools import repeat

import numpy as np

from millrace.llm.texts import gather, running


class Memo:
    """Rows of numbers for distinct words, at most ``limit`` (and those of one batch).

    ``fixed`` columns have one number a word, ``ragged`` ones a run of them (``starts``, ``counts``,
    ``data``). When it is full, the half that was used least recently is forgotten, so that frequent
    words stay.
    """

    def __init__(self, limit: int, ragged: dict[str, np.ndarray], fixed: tuple[str, ...] = ()):
        self.limit = limit
        self.data = dict(ragged)  # empty arrays of the right type and shape
        self.empty = dict(ragged)
        self.starts = {name: np.zeros(0, np.int64) for name in ragged}
        self.counts = {name: np.zeros(0, np.int64) for name in ragged}
        self.fixed = {name: np.zeros(0, np.int64) for name in fixed}
        self.place: dict[str, int] = {}
        self.used, self.now = np.zeros(0, np.int64), 0

    def slots(self, words: list[str]) -> np.ndarray:
        """The row of every word, -1 for new ones. Rows found before are no longer valid."""
        self.now += 1
        if len(self.place) > self.limit:
            self._forget()
        found = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        self.used[found[found >= 0]] = self.now
        return found

    def add(self, words: list[str], ragged: dict[str, tuple[np.ndarray, np.ndarray]], **fixed: np.ndarray) -> np.ndarray:
        """Remember new words: of each ragged column its data and counts. Gives their rows."""
        first = len(self.used)
        self.place.update(zip(words, range(first, first + len(words))))
        for name, (data, counts) in ragged.items():
            begin = len(self.data[name]) + running(counts)[:-1]
            self.starts[name] = np.concatenate([self.starts[name], begin])
            self.counts[name] = np.concatenate([self.counts[name], counts])
            self.data[name] = np.concatenate([self.data[name], data])
        for name, values in fixed.items():
            self.fixed[name] = np.concatenate([self.fixed[name], values])
        self.used = np.concatenate([self.used, np.full(len(words), self.now)])
        return np.arange(first, first + len(words))

    def _forget(self) -> None:
        kept = np.sort(np.argsort(-self.used, kind="stable")[: self.limit // 2])
        names = list(self.place)  # words are in the order of their rows
        self.place = dict(zip([names[k] for k in kept.tolist()], range(len(kept))))
        for name in self.data:
            self.data[name] = self.data[name][gather(self.starts[name][kept], self.counts[name][kept])]
            self.counts[name] = self.counts[name][kept]
            self.starts[name] = running(self.counts[name])[:-1]
        self.fixed = {name: values[kept] for name, values in self.fixed.items()}
        self.used = self.used[kept]
