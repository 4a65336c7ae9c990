"""What both tokenizers share: the ids of pieces of text that a worker has met, and whole batches of texts put together from them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa


def take(ids: np.ndarray, first: np.ndarray, end: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``ids[first:end]`` of the entries ``which`` one after the other, and where each one's end."""
    first = first[which]
    n = end[which] - first
    ends = np.cumsum(n)
    at = np.repeat(first - ends + n, n)
    at += np.arange(len(at))
    return ids[at], ends


def per_list(lists: pa.ListArray, ends: np.ndarray) -> np.ndarray:
    """How many ids each list has; ends: where the ids of each of all lists' items end."""
    return np.diff(np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))])


class Store:
    """Names and their ids. When there would be more than ``most`` names or ``most_ids`` ids, all are forgotten."""

    def __init__(self, most: int, most_ids: int = 1 << 24) -> None:
        self.most, self.most_ids = most, most_ids
        self.forget()

    def forget(self) -> None:
        #: name -> its number; where a number's ids start and end; all ids
        self.known: dict[str, int] = {"": 0}
        self.first, self.end, self.n = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 1
        self.ids, self.used = np.zeros(1 << 18, np.int32), 0

    def add(self, names: list[str], ids: np.ndarray, ends: np.ndarray, longest: int = 64) -> np.ndarray:
        """The numbers of new entries; ends: where each one's ids end among ``ids``. Names beyond ``longest`` characters aren't kept."""
        n = self.n
        while n + len(names) > len(self.first):
            self.first, self.end = (np.concatenate((x, np.zeros_like(x))) for x in (self.first, self.end))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.used : self.used + len(ids)] = ids
        self.first[n : n + len(names)] = self.used + np.concatenate(([0], ends[:-1]))[: len(names)]
        self.end[n : n + len(names)] = self.used + ends
        self.used += len(ids)
        self.n += len(names)
        self.known.update((c, i) for c, i in zip(names, range(n, self.n)) if len(c) <= longest)
        return np.arange(n, self.n)

    def numbers(self, names: list[str], learn: Callable[[list[str]], np.ndarray]) -> np.ndarray:
        """The number of each name; ``learn`` adds new ones, and gives theirs."""
        if len(self.known) + 2 * len(names) > self.most or self.used > self.most_ids:
            self.forget()
        get = self.known.get
        number = np.array([get(c, -1) for c in names], np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = learn([names[i] for i in new.tolist()])
        return number

    def take(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return take(self.ids, self.first, self.end, number)
