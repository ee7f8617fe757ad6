"""Helpers that several operators share: shared-folder tables, word hashing, window hashes, minimizers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text of about this many bytes is worked on at a time inside a task.
SLICE_BYTES = 2_000_000
#: Largest side, in bytes as estimated from counted rows and list items, that is ever broadcast.
BROADCAST_BYTES = 16 << 20
#: Entries that a task's word cache may hold before it starts anew.
CACHE_WORDS = 400_000

#: The six ASCII white-space characters.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

MIX_A = np.uint64(0x9E3779B97F4A7C15)
MIX_B = np.uint64(0xBF58476D1CE4E5B9)


def shared_dir(spark: SparkSession) -> str:
    """A new folder in the place all executors share, spark.checkpoint.dir. On a cluster that has to be set."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "/tmp/checkpoints"  # one machine, as in tests
    return f"{shared}/{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """df written to the shared folder as Parquet and read back: cuts lineage and survives the loss of executors."""
    path = shared_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, bytes_per_row: int, items: str | None = None, bytes_per_item: int = 0) -> bool:
    """Whether a staged table's counted rows, and the items of its list column, fit BROADCAST_BYTES."""
    n = df.agg(F.count("*").alias("n"), (F.coalesce(F.sum(F.size(items)), F.lit(0)) if items else F.lit(0)).alias("m")).collect()[0]
    return n["n"] * bytes_per_row + n["m"] * bytes_per_item <= BROADCAST_BYTES


def small_side(df: DataFrame, bytes_per_row: int) -> DataFrame:
    """df with a broadcast hint if it fits, else as it is, for a shuffled join. df should be a staged table, as it is counted."""
    return F.broadcast(df) if fits(df, bytes_per_row) else df


def beside(texts: DataFrame, side: DataFrame, keys: list[str], items: str, bytes_per_item: int, every: bool) -> DataFrame:
    """texts with the list column `items` of a staged side table; every=True keeps texts without a row there.

    The side is broadcast if it fits. Else, if its keys alone fit, only the texts that it has rows for are
    shuffled to it and the others stay where they are. Else it is a shuffled join of all.
    """
    if fits(side, 64, items, bytes_per_item):
        return texts.join(F.broadcast(side), keys, "left" if every else "inner")
    ids = side.select(*keys)
    if not fits(ids, 40):
        return texts.join(side, keys, "left" if every else "inner")
    out = texts.join(F.broadcast(ids), keys, "left_semi").join(side.hint("merge"), keys)
    if every:
        rest = texts.join(F.broadcast(ids), keys, "left_anti")
        out = out.unionByName(rest.withColumn(items, F.lit(None).cast(side.schema[items].dataType)))
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class WordHashes(dict):
    """Word (bytes) -> 64-bit xxh3, kept until CACHE_WORDS are held."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split_words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Words of the texts as numbers in a list of different words, that list, and the number of words of each text."""
    text = b" ".join(texts)
    data = np.frombuffer(text.lower() if lower else text, np.uint8)
    inside = ~SPACES[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    offset = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offset[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offset), pa.py_buffer(data[inside])]).dictionary_encode()
    upto = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    different = words.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist is ten times slower
    return words.indices.to_numpy(zero_copy_only=False), different, np.diff(np.searchsorted(start, upto), prepend=0)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Record batches cut so that each has about `size` bytes of text, with the texts as UTF-8 (null: empty)."""
    for batch in batches:
        texts = batch.column(text)
        if texts.type != pa.binary() and texts.type != pa.large_binary():
            texts = texts.cast(pa.large_binary())
        start, held, part = 0, 0, []
        for i in range(batch.num_rows):
            b = texts[i].as_py() or b""
            part.append(b)
            held += len(b)
            if held >= size:
                yield batch.slice(start, i + 1 - start), part
                start, held, part = i + 1, 0, []
        if part:
            yield batch.slice(start), part


def finish(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of the result depends on all of h."""
    h = h ^ (h >> np.uint64(30))
    h *= MIX_B
    h ^= h >> np.uint64(27)
    h *= MIX_A
    return h ^ (h >> np.uint64(31))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of two adjoining windows' concatenation from those of the halves."""
    return finish(left * MIX_A + (right ^ (right >> np.uint64(32))) * MIX_B)


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of `size` consecutive items, by doubling (two halves that may overlap)."""
    have = 1
    while have < size:
        step = min(have, size - have)
        if len(h) <= step:
            return h[:0]
        h = joined(h[:-step], h[step:])
        have += step
    return h


def lowest(v: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each `span` consecutive values."""
    have = 1
    while have < span:
        step = min(have, span - have)
        if len(v) <= step:
            return v[:0]
        v = np.minimum(v[:-step], v[step:])
        have += step
    return v


def minimizers(h: np.ndarray, span: int, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions in h, hashes of seeds, that are the least of some `span` neighbours.

    whole[i] says that the window of `span` seeds from i on lies within one text; other windows are
    left out. Returns (positions, first, last): the windows that start in first..last have that
    position as their least one, and every window is in exactly one such range. Which position it is
    depends on the window's own hashes alone, so equal windows have it at the same place; of equal
    hashes the last counts.
    """
    count = len(h) - span + 1
    if count < 1:
        e = np.zeros(0, np.int64)
        return e, e, e
    at, low, stretch = np.empty(count, np.int64), np.uint64((1 << 22) - 1), 1 << 17
    for a in range(0, count, stretch):  # positions fit the low bits, and the arrays a CPU's cache
        z = min(len(h), a + stretch + span - 1)
        key = (h[a:z] & ~low) | (low - np.arange(z - a, dtype=np.uint64))
        at[a : z - span + 1] = a + (low - (lowest(key, span) & low)).astype(np.int64)
    i = np.flatnonzero(whole[:count])
    if not len(i):
        return i, i, i
    at = at[i]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (i[1:] != i[:-1] + 1)])
    return at[new], i[new], i[np.r_[new[1:], len(i)] - 1]


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] numbers), first[1], ..."""
    before = np.cumsum(count) - count
    return np.repeat(first - before, count) + np.arange(count.sum())


def lists(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Lengths and flattened fields of a list<struct> column; a null list counts as empty, a null number as 0."""
    length = np.array(pa.compute.fill_null(pa.compute.list_value_length(column), 0))
    flat = pa.compute.list_flatten(column)
    # nulls would turn integers into floats, which can't hold 64 bits
    value = lambda f: pa.compute.fill_null(flat.field(f.name), False if pa.types.is_boolean(f.type) else 0)
    return length, {f.name: value(f).to_numpy(zero_copy_only=False) for f in flat.type}


def covered(size: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which of 0..size-1 lie in one of the ranges first..last - 1."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, last, -1)
    return np.cumsum(step[:-1]) > 0
