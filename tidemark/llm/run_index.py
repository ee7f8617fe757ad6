"""A run-compressed Burrows-Wheeler index over a batch of short texts, and matching statistics from its run ends."""

from __future__ import annotations

import numpy as np

#: Bytes packed into one word, nine bits each: byte + 1, or 0 after a text's end.
PACK = 7


class RunIndex:
    """Index of the texts data[start:end], each followed by an end mark of its own.

    Suffixes are sorted by prefix doubling. Of the Burrows-Wheeler transform only the runs are kept: for
    each run its first and last row's text position (the samples) and the common prefix of the run's
    first row with the row before, and of its last row with the row after. Inside a run a row and its
    neighbour have the same symbol before them, so their common prefix follows from the position before.
    """

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        size = end - start
        n = int(size.sum())
        self.size, self.base = size, np.cumsum(size) - size
        at = np.repeat(start - self.base, size) + np.arange(n)
        self.text = data[at].astype(np.uint64) + np.uint64(1)
        self.owner = np.repeat(np.arange(len(size)), size)
        self.left = self.base[self.owner] + size[self.owner] - np.arange(n)  # to the text's end
        word = np.zeros(n, np.uint64)
        for k in range(PACK):
            symbol = np.zeros(n, np.uint64)
            symbol[: max(n - k, 0)] = self.text[k:]
            symbol[self.left <= k] = 0
            word = (word << np.uint64(9)) | symbol
        self.word = word
        order = self._sorted()
        before = np.where(order == self.base[self.owner[order]], -1 - self.owner[order].astype(np.int64), self.text[order - 1].astype(np.int64))
        new = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        last = np.r_[new[1:], n] - 1
        self.run_symbol = before[new]
        self.first_sample, self.last_sample = order[new], order[last]
        self.before_first = self._common(order[new], order[new - 1]) * (new > 0)
        self.after_last = self._common(order[last], order[(last + 1) % n]) * (last < n - 1)

    def _sorted(self) -> np.ndarray:
        n, texts = len(self.word), len(self.size)
        order = np.argsort(self.word, kind="stable")
        rank = self._ranks(order, self.word[order])
        k = PACK
        while True:
            tied = self._tied(order, rank)
            if not len(tied):
                return order
            item = order[tied]
            next_at = np.minimum(item + k, n - 1)
            second = np.where(self.left[item] > k, texts + rank[next_at], self.owner[item])
            key = rank[item].astype(np.uint64) * np.uint64(n + texts + 1) + second.astype(np.uint64)
            by = np.argsort(key, kind="stable")
            order[tied] = item[by]
            key = key[by]
            fresh = np.r_[True, key[1:] != key[:-1]]
            head = np.maximum.accumulate(np.where(fresh, tied, 0))
            rank = rank.copy()
            rank[item[by]] = head
            k *= 2

    @staticmethod
    def _ranks(order: np.ndarray, key: np.ndarray) -> np.ndarray:
        head = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(len(key)), 0))
        rank = np.empty(len(key), np.int64)
        rank[order] = head
        return rank

    @staticmethod
    def _tied(order: np.ndarray, rank: np.ndarray) -> np.ndarray:
        r = rank[order]
        same = r[1:] == r[:-1]
        return np.flatnonzero(np.r_[same, False] | np.r_[False, same])

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of the suffixes a[i] and b[i]."""
        most = np.minimum(self.left[a], self.left[b])
        length = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        while len(live):
            x = self.word[a[live] + length[live]] ^ self.word[b[live] + length[live]]
            differs = x != 0
            d, bits = live[differs], x[differs]
            same = np.zeros(len(d), np.int64)
            for k in range(1, PACK):
                same += bits < (np.uint64(1) << np.uint64(9 * (PACK - k)))
            length[d] += same
            live = live[~differs]
            length[live] += PACK
            live = live[length[live] < most[live]]
        return np.minimum(length, most)

    def matching(self) -> np.ndarray:
        """For each position, the length of the longest match that starts there and at another position."""
        n = len(self.word)
        best = np.zeros(n, np.int64)
        for sample, value in ((self.first_sample, self.before_first), (self.last_sample, self.after_last)):
            known = np.full(n, -1, np.int64)
            known[sample] = value + sample
            # a position without a sample has one less than the position before it
            at = np.maximum.accumulate(np.where(known >= 0, np.arange(n), 0))
            best = np.maximum(best, known[at] - np.arange(n))
        return np.minimum(best, self.left)
