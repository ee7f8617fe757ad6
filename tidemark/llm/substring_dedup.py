"""Operator 10, substring dedup over words: level-wise doubling of repeated windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import covered, joined, minimizers, ranges, table, windows
from tidemark.llm.exchange import beside_chunks, bucket_count, exchange, fold, grouped, told_of, unpacked, word_chunks

#: Words of a window; the levels are WINDOW / 4, / 2 and the whole, rounded up.
WINDOW = 50
#: Lowest bit of a key of level 2: set for a block, else a doubled seed.
BLOCK = np.uint64(1)


def _levels(window: int) -> tuple[int, int]:
    half = -(-window // 2)
    return -(-half // 2), half


class _Chunk:
    """A chunk's windows, and what is known of them after each level; each level's keys go to an exchange."""

    def __init__(self, row: dict, window: int):
        self.row, self.window = row, window
        self.quarter, self.half = _levels(window)
        self.more = self.half - self.quarter
        self.words, self.tokens = row["words"].split(), unpacked(row["tokens"], np.uint32)
        self.n = np.frombuffer(row["lengths"], np.int32).astype(np.int64)
        self.base = np.cumsum(self.n) - self.n
        has_id = np.array([i is not None for i in row["doc_ids"]], bool)
        ids = np.array([i or 0 for i in row["doc_ids"]], np.int64)
        hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.words)), np.uint64).reshape(-1, 2)
        self.h, self.h2 = (np.ascontiguousarray(hashes[:, k])[self.tokens] for k in (0, 1))
        owner = np.repeat(np.arange(len(self.n)), self.n)
        span = max(len(owner) - window + 1, 0)
        whole = (owner[:span] == owner[len(owner) - span :]) & has_id[owner[:span]]
        seeds = windows(self.h, self.quarter)
        self.at, self.first, self.last = minimizers(seeds, window - self.quarter + 1, whole)
        self.seed, self.own = seeds[self.at], owner[self.at]
        self.doc = ids[self.own]

    def seeds(self) -> tuple[np.ndarray, ...]:
        """Level 1: the different seeds, with the least and the greatest document that has each."""
        order, start, self.seed_number = grouped(self.seed)
        doc = self.doc[order]
        return self.seed[order[start]], fold(np.minimum, doc, start), fold(np.maximum, doc, start)

    def doubled(self) -> tuple[np.ndarray, ...]:
        """Level 2: of the seeds that lie in two documents, the doubled seeds with their least and greatest
        document and block, and the blocks with their least document."""
        self.seeds()
        keep = told_of(self.row["in_two"], np.bool_)[self.seed_number]
        self.at, self.first, self.last, self.own, self.doc = (v[keep] for v in (self.at, self.first, self.last, self.own, self.doc))
        base, end = self.base[self.own], self.base[self.own] + self.n[self.own]
        doubled, self.full, self.full2 = windows(self.h, self.half), windows(self.h, self.window), windows(self.h2, self.window)
        extent = (self.last - self.first).astype(np.uint64) + ((self.at - self.first) << 8).astype(np.uint64)
        block, block2 = (joined(f[self.first], f[self.last] + extent) for f in (self.full, self.full2))
        block |= BLOCK
        self.sides, keys = [], []
        for at in (self.at - self.more, self.at):
            fits = np.flatnonzero((at >= base) & (at + self.half <= end))
            self.sides.append(fits)
            keys.append(doubled[at[fits]] & ~BLOCK)
        which = np.concatenate([*self.sides, np.arange(len(self.at))])
        key = np.concatenate([*keys, block])
        also = np.concatenate([np.zeros(len(key) - len(block), np.uint64), block2])
        order, start, self.doubled_number = grouped(key, also)
        doc, block = self.doc[which][order], block[which][order]
        return key[order[start]], also[order[start]], *(fold(how, v, start) for v in (doc, block) for how in (np.minimum, np.maximum))

    def whole(self) -> tuple[np.ndarray, ...]:
        """Level 3: blocks that a smaller document has go whole. Of the others, the different windows around
        doubled seeds that survive, each by two hashes, with the least document that has it."""
        self.doubled()
        told = told_of(self.row["repeats"], np.int64)[self.doubled_number]
        left, right = np.zeros((2, len(self.at)), bool)
        left[self.sides[0]] = told[: len(self.sides[0])] > 0
        right[self.sides[1]] = told[len(self.sides[0]) : len(told) - len(self.at)] > 0
        smaller = told[len(told) - len(self.at) :] < self.doc
        self.gone = self.first[smaller], self.last[smaller] + self.window
        i = np.flatnonzero(~smaller & (left | right))
        count = self.last[i] - self.first[i] + 1
        start, i = ranges(self.first[i], count), np.repeat(i, count)
        use = np.where(self.at[i] - start >= self.more, left[i], right[i])
        self.start, self.start_doc = start[use], self.doc[i[use]]
        key, also = self.full[self.start], self.full2[self.start]
        order, first, self.window_number = grouped(key, also)
        return key[order[first]], also[order[first]], fold(np.minimum, self.start_doc[order], first)

    def removed(self) -> np.ndarray:
        """Which of the chunk's words go."""
        self.whole()
        hit = self.start[told_of(self.row["least"], np.int64)[self.window_number] < self.start_doc]
        return covered(len(self.tokens), np.r_[self.gone[0], hit], np.r_[self.gone[1], hit + self.window])


def _asks(level: Callable, window: int) -> Callable:
    return lambda row: level(_Chunk(row, window))


def _in_two(keys: np.ndarray, start: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    return fold(np.minimum, least, start) < fold(np.maximum, most, start)


def _repeats(keys: np.ndarray, start: np.ndarray, also: np.ndarray, least: np.ndarray, most: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For a block its least document; for a doubled seed whether it lies in two documents and in two different blocks."""
    least = fold(np.minimum, least, start)
    again = (least < fold(np.maximum, most, start)) & (fold(np.minimum, low, start) < fold(np.maximum, high, start))
    return np.where(keys & BLOCK > 0, least, again)


def _least(keys: np.ndarray, start: np.ndarray, also: np.ndarray, least: np.ndarray) -> np.ndarray:
    return fold(np.minimum, least, start)


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = _Chunk(row, window)
                gone = chunk.removed()
                upto = np.r_[0, np.cumsum(gone)][np.r_[0, np.cumsum(chunk.n)]]
                kept = np.array(chunk.words, object)[chunk.tokens[~gone]]
                ends = (np.r_[0, np.cumsum(chunk.n)] - upto).tolist()
                text = [b" ".join(kept[a:z]) for a, z in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.record_batch(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(chunk.n), pa.array(np.diff(upto)), pa.array(text, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept_text"],
                )

    return run


def substring_dedup(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space) for every row of `documents`.

    A word goes if a window of `window` consecutive words that covers it also starts in a document with
    a smaller doc_id; all is judged on the input. Words are compared as bytes. Null and empty texts have
    no words. Rows with a null id are returned whole and not compared; rows of one id are not compared
    with each other. An empty table gives no rows; columns other than doc_id and text are not read.

    Level 1: every window of the full length has one seed, the least-hashed of its quarter-length windows,
    which depends on its words alone, so equal windows have equal seeds at equal places and no other
    quarter-length windows need be compared. Level 2: the seeds that lie in two documents are extended to
    twice their length, to the left and to the right; each full window contains one of the two. The windows
    that share a seed's place are a block, and blocks that a smaller document has too are settled here.
    Level 3: around doubled seeds that lie in two documents, in blocks that differ, windows of the full
    length are compared; of equal blocks only those of the least document are left to take part.

    Texts are read once, into chunks of word numbers. In each level a chunk asks for its different keys and
    is told what all chunks know of them, so a passage that many documents share is one key a chunk. Seeds
    are 64-bit hashes, which can only add candidates; blocks and windows are compared by 127 and 128 bits.
    """
    chunks = word_chunks(documents)
    buckets = bucket_count(chunks)
    told = {}
    for name, level, answer, kinds in (
        ("in_two", _Chunk.seeds, _in_two, (np.int64, np.int64)),
        ("repeats", _Chunk.doubled, _repeats, (np.uint64, np.int64, np.int64, np.uint64, np.uint64)),
        ("least", _Chunk.whole, _least, (np.uint64, np.int64)),
    ):
        told[name] = exchange(beside_chunks(chunks, buckets, **told), buckets, _asks(level, window), answer, kinds, pairs=name != "in_two")
    return beside_chunks(chunks, buckets, **told).mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept_text string")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = {
    "op10_substring_dedup": f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {WINDOW - 2}, 1))) AS i FROM w)),
m AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS least FROM p) WHERE least < doc_id),
g AS (SELECT DISTINCT doc_id, i + k AS i FROM m, unnest(range({WINDOW})) AS u(k)),
n AS (SELECT doc_id, len(ws)::BIGINT AS n_words, unnest(ws || ['']) AS word, generate_subscripts(ws || [''], 1) AS i FROM w)
SELECT n.doc_id, any_value(n_words) AS n_words, count(g.i)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY n.i) FILTER (g.i IS NULL AND n.i <= n_words), '')) AS kept_sha256
FROM n LEFT JOIN g ON g.doc_id = n.doc_id AND g.i = n.i GROUP BY n.doc_id"""
}
QUERIES = {"op10_substring_dedup": op10_substring_dedup}
