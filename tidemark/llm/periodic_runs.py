"""Operator 13, periodic runs: a suffix automaton whose link tree is recoloured with last occurrences by link-cut access."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import covered, finish, slices, split_words, table, windows

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class RunFinder:
    """A suffix automaton of words, with its link tree kept as preferred paths in splay trees.

    State 1 is the empty word and 0 is none. All nodes of one splay tree ended last at the same place, which is
    kept at the tree's root (`ended`). Appending a word makes the whole path from the empty word to the new
    state one such tree; each piece that this takes its nodes from gives the place at which the words of its
    deepest node on the path ended before. The distance to that place is the period of a square if those words are
    as long at least, and the common words before it reach back to where the repetition starts.
    """

    def __init__(self, words: list[int]):
        self.words = words
        room = 2 * len(words) + 2
        zeros = lambda: array("i", bytes(4 * room))
        self.length, self.link, self.word, self.to = zeros(), zeros(), zeros(), zeros()
        self.left, self.right, self.up, self.ended = zeros(), zeros(), zeros(), array("i", b"\xff" * (4 * room))
        self.others: dict[int, dict[int, int]] = {}  # steps of a state after its first
        self.states, self.last = 1, 1

    def step(self, state: int, word: int) -> int:
        if self.to[state] and self.word[state] == word:
            return self.to[state]
        others = self.others.get(state)
        return others.get(word, 0) if others else 0

    def set_step(self, state: int, word: int, to: int) -> None:
        if not self.to[state] or self.word[state] == word:
            self.word[state], self.to[state] = word, to
        else:
            self.others.setdefault(state, {})[word] = to

    def splay(self, x: int) -> None:
        left, right, up, ended = self.left, self.right, self.up, self.ended
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                turns = (p, x) if (left[g] == p) == (left[p] == x) else (x, x)
            else:
                turns = (x,)
            for y in turns:
                p = up[y]
                g = up[p]
                if left[p] == y:
                    b = left[p] = right[y]
                    right[y] = p
                else:
                    b = right[p] = left[y]
                    left[y] = p
                if b:
                    up[b] = p
                up[p], up[y] = y, g
                if g and left[g] == p:
                    left[g] = y
                elif g and right[g] == p:
                    right[g] = y
                else:
                    ended[y] = ended[p]  # p was the root

    def split(self, q: int, longest: int, word: int, p: int) -> int:
        """A state for the words of q up to a length, put between q and its link; p and its links step there."""
        self.states += 1
        new = self.states
        self.length[new], self.link[new], self.word[new], self.to[new] = longest, self.link[q], self.word[q], self.to[q]
        if q in self.others:
            self.others[new] = dict(self.others[q])
        while p and self.step(p, word) == q:
            self.set_step(p, word, new)
            p = self.link[p]
        self.splay(q)
        above = self.left[q]
        if above:  # shorter words that ended last at the same place stay together
            self.up[above], self.ended[above], self.left[q] = self.up[q], self.ended[q], 0
        self.up[new], self.ended[new], self.up[q] = self.link[q], self.ended[q], new
        self.link[q] = new
        return new

    def append(self, word: int) -> int:
        """The state of all words so far with this one."""
        self.states += 1
        new, p = self.states, self.last
        self.length[new] = self.length[p] + 1
        while p and not self.step(p, word):
            self.set_step(p, word, new)
            p = self.link[p]
        link = 1
        if p:
            link = self.step(p, word)
            if self.length[p] + 1 != self.length[link]:
                link = self.split(link, self.length[p] + 1, word, p)
        self.link[new] = self.up[new] = link
        self.last = new
        return new

    def access(self, x: int, at: int) -> Iterator[tuple[int, int]]:
        """Colours the path from x to the empty word with `at`; gives (place before, words of the deepest node that ended there)."""
        right, up, ended, length = self.right, self.up, self.ended, self.length
        below, before = 0, -1
        while x:
            self.splay(x)
            place = ended[x]
            if place != before and place >= 0:
                before = place
                yield place, length[x]
            if right[x]:
                ended[right[x]] = place
            right[x] = below
            below, x = x, up[x]
        ended[below] = at

    def runs(self, least: int, times: int) -> list[tuple[int, int, int]]:
        """(start, length, period) of all maximal runs of at least `least` words and `times` periods, by start and period."""
        words, out = self.words, []
        end = len(words) - 1
        for i, word in enumerate(words):
            for place, common in self.access(self.append(word), i):
                period = i - place
                if common >= (times - 1) * period and common + period >= least and (i == end or words[i + 1] != words[i + 1 - period]):
                    out.append((i + 1 - common - period, common + period, period))
        return sorted(out, key=lambda r: (r[0], r[2]))


def shortest_repeat(least: int, times: int) -> int:
    """Words that any run has twice one after the other, at least: its length less its period."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def repeated_stretches(words: np.ndarray, count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches start and end whose words all lie in windows of `size` words that occur twice in the same text.

    A run is made of such windows, so it lies in one stretch and can't be extended beyond it. Windows are
    told apart by hashes; equal hashes of different ones make a stretch longer, not shorter.
    """
    text = np.repeat(np.arange(len(count)), count)
    h = windows(finish(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), size)
    whole = np.flatnonzero(text[: len(h)] == text[len(text) - len(h) :]) if len(h) else np.zeros(0, np.int64)
    key = h[whole] ^ finish(text[whole].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = whole[twice]
    inside = covered(len(words), at, at + size)
    new_text = np.diff(text, prepend=-1) != 0
    start = np.flatnonzero(inside & (new_text | ~np.r_[False, inside[:-1]]))
    end = np.flatnonzero(inside & np.r_[new_text[1:], True] | inside & ~np.r_[inside[1:], False]) + 1
    return start, end


def _runs(least: int, times: int):
    size = shortest_repeat(least, times)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            words, _, count = split_words(texts)
            first = np.cumsum(count) - count
            found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for a, z in zip(*(x.tolist() for x in repeated_stretches(words, count, size)), strict=True):
                if z - a >= least:
                    t = int(np.searchsorted(first, a, "right")) - 1
                    found[t] += [(int(a - first[t]) + s, n, q) for s, n, q in RunFinder(words[a:z].tolist()).runs(least, times)]
            collapsed = []
            for t, runs in zip(texts, found, strict=True):
                own = t.split()
                if runs:
                    drop = covered(len(own), np.array([s + q for s, _, q in runs]), np.array([s + n for s, n, _ in runs]))
                    own = [w for w, d in zip(own, drop.tolist(), strict=True) if not d]
                collapsed.append(b" ".join(own))
            flat = [r for runs in found for r in runs]
            each = pa.StructArray.from_arrays([pa.array([r[k] for r in flat], pa.int64()) for k in range(3)], ["start", "length", "period"])
            ends = pa.array(np.r_[0, np.cumsum([len(runs) for runs in found])].astype(np.int32))
            yield pa.record_batch([batch.column("doc_id"), pa.array(count.astype(np.int64)), pa.ListArray.from_arrays(ends, each), pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(documents: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """One row per row of `documents`: doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    A run is a longest stretch of words in which words `period` apart are equal, that being the smallest
    such number, with at least `least` words and `times` (two or more) periods. collapsed is the text's words, joined by
    one space, without those that a run has after its first period. Words are compared as they are.

    Null, empty and blank texts have no words, no runs and an empty collapsed text. Rows are judged
    each by itself, so null ids and repeated rows are kept as they are. An empty table gives no rows; columns
    other than doc_id and text are not read.

    Nothing is shuffled. Only stretches whose windows repeat within their text go through the automaton, which is all
    that runs can lie in; a stretch of n words takes O(n log n) steps and about 100 bytes a word.
    """
    if times < 2 or least < times:
        raise ValueError("times must be 2 or more and least as many")
    return documents.select("doc_id", "text").mapInArrow(_runs(least, times), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def longest(runs):
    """The run with the greatest length / period, the first of equal ones; null without runs."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in which words from one on repeat, by a row's number h: see the contract of op13."""
    for batch, texts in slices(batches):
        out = []
        for t, h in zip(texts, batch.column("h").to_pylist(), strict=True):
            words = t.split()
            if h is not None and h % 10 == 0 and words:
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                again = words[a : a + p]
                t = b" ".join(words[:a] + (again * -(-(n - a) // len(again)))[: n - a])
            out.append(t)
        yield pa.record_batch([batch.column("doc_id"), pa.array(out, pa.binary()).cast(pa.string())], ["doc_id", "text"])


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    out = periodic_runs(docs.mapInArrow(planted, "doc_id long, text string")).withColumn("best", longest(F.col("runs")))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[k].cast("string") for k in ("start", "length", "period"))), F.lit("\n"))))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: SQL can't walk an automaton; tests compare with brute force.
SQL = {}
QUERIES = {"op13_periodic_runs": op13_periodic_runs}
