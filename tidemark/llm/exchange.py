"""Chunks of documents, and a shuffle in which chunks ask about keys of their own and are told a number for each.

A chunk asks for each of its different keys once, however often it has it, so no key brings more rows to
a task than there are chunks, and what is counted is pre-aggregated. Keys and numbers travel as packed
columns; buckets of keys are ranges of their hashes, so they are even, and there are as many as the chunks
need: a bucket holds about as many keys as CHUNKS_PER_BUCKET chunks ask for, whatever the input's size.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shared_dir, slices, split_words, staged

#: Bytes of text of a chunk, about, and chunks to a bucket of keys.
CHUNK_BYTES, CHUNKS_PER_BUCKET = 8_000_000, 4


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes: the low bytes of all, then the next."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True) if raw else b""


def unpacked(data: bytes, kind: type) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def grouped(key: np.ndarray, also: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that sorts key (and `also` where keys are equal), where in it each different key starts, and the number of each item's key."""
    order = np.argsort(key) if also is None else np.lexsort((also, key))
    new = np.ones(len(key), bool)
    changed = None
    for values in (key,) if also is None else (key, also):
        values = values[order]
        differs = values[1:] != values[:-1]
        changed = differs if changed is None else changed | differs
    new[1:] = changed
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), number


def fold(how: np.ufunc, values: np.ndarray, start: np.ndarray) -> np.ndarray:
    return how.reduceat(values, start) if len(start) else values[:0]


def bucketed(chunks: DataFrame, parts: int) -> DataFrame:
    """chunks as a table in the shared folder whose files are dealt by chunk to `parts` buckets, so that joins by chunk leave them where they are."""
    spark, name = chunks.sparkSession, f"chunks_{uuid.uuid4().hex}"
    chunks.write.format("parquet").option("compression", "zstd").option("path", shared_dir(spark)).bucketBy(parts, "chunk").sortBy("chunk").saveAsTable(name)
    return spark.table(name)


def word_chunks(rows: DataFrame, size: int = CHUNK_BYTES) -> DataFrame:
    """chunk, doc_ids, lengths, words, tokens of rows (doc_id, text): the different words of about `size` bytes of text,
    joined by spaces, and the texts' words as packed numbers in them; staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, ids, texts, held = TaskContext.get().partitionId(), 0, [], [], 0

        def chunk() -> pa.RecordBatch:
            tokens, words, n = split_words(texts)
            columns = (n.astype(np.int32).tobytes(), b" ".join(words), packed(tokens.astype(np.uint32)))
            return pa.record_batch([pa.array([task << 24 | number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), *(pa.array([c], pa.binary()) for c in columns)], ["chunk", "doc_ids", "lengths", "words", "tokens"])

        for batch, some in slices(batches):
            ids += batch.column("doc_id").to_pylist()
            texts += some
            held += sum(map(len, some))
            if held >= size:
                yield chunk()
                ids, texts, held, number = [], [], 0, number + 1
        if ids:
            yield chunk()

    return staged(rows.select("doc_id", "text").mapInArrow(run, "chunk long, doc_ids array<long>, lengths binary, words binary, tokens binary"))


def _asked(ask: Callable, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                keys, *values = ask(row)
                ends = np.searchsorted(keys, np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << 64) // buckets)) if buckets > 1 else np.zeros(0, np.int64)
                ends = np.r_[0, ends, len(keys)]
                some = np.flatnonzero(np.diff(ends))
                if not len(some):
                    continue
                parts = [slice(ends[k], ends[k + 1]) for k in some]
                yield pa.record_batch(
                    [
                        pa.array([row["chunk"]] * len(some), pa.int64()),
                        pa.array(some, pa.int64()),
                        pa.array([packed(np.diff(keys[p], prepend=np.uint64(0))) for p in parts], pa.binary()),
                        pa.array([[packed(v[p]) for v in values] for p in parts], pa.list_(pa.binary())),
                    ],
                    ["chunk", "bucket", "asked", "values"],
                )

    return run


def _answered(answer: Callable, kinds: tuple, pairs: bool, summary: Callable | None):
    def told(bucket: int, rows: list[dict]) -> pa.RecordBatch:
        keys = [np.cumsum(unpacked(r["asked"], np.uint64)) for r in rows]
        values = [np.concatenate([unpacked(r["values"][k], kind) for r in rows]) for k, kind in enumerate(kinds)]
        every = np.concatenate(keys)
        order, start, number = grouped(every, values[0] if pairs else None)
        values = [v[order] for v in values]
        result = answer(every[order[start]], start, *values)
        out, ends, to = result[number], np.cumsum([0, *map(len, keys)]), [r["chunk"] for r in rows]
        parts = [packed(out[a:z]) for a, z in zip(ends[:-1], ends[1:], strict=True)]
        if summary:
            to.append(-1 - bucket)
            parts.append(packed(summary(result, start, *values)))
        return pa.record_batch([pa.array(to, pa.int64()), pa.array([bucket] * len(to), pa.int64()), pa.array(parts, pa.binary())], ["chunk", "bucket", "told"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["bucket"] != bucket:
                    if rows:
                        yield told(bucket, rows)
                    bucket, rows = r["bucket"], []
                rows.append(r)
        if rows:
            yield told(bucket, rows)

    return run


def exchange(chunks: DataFrame, buckets: int, ask: Callable, answer: Callable, kinds: tuple = (), pairs: bool = False, summary: Callable | None = None) -> DataFrame:
    """chunk, told: what every chunk with keys is told about them; staged.

    ask(row of chunks) returns ascending 64-bit keys and arrays of values, of the types `kinds`, for them.
    answer(keys, start, values...) gets a bucket's different keys, where each starts, and the values in the
    order of the keys, and returns a number for each different key; with `pairs` the first values are part
    of the key. summary(numbers, start, values...) may return an array for each bucket, which comes as a row
    with a negative chunk. told_of() unpacks what a chunk was told in the order in which it asked.
    """
    rows = chunks.mapInArrow(_asked(ask, buckets), "chunk long, bucket long, asked binary, values array<binary>")
    rows = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "chunk")
    rows = rows.mapInArrow(_answered(answer, kinds, pairs, summary), "chunk long, bucket long, told binary")
    return staged(rows.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "told")).alias("told")))


def told_of(told: list | None, kind: type) -> np.ndarray:
    parts = sorted((p["bucket"], p["told"]) for p in told or [])
    return np.concatenate([np.zeros(0, kind), *(unpacked(b, kind) for _, b in parts)])


def beside_chunks(chunks: DataFrame, parts: int | None, **told: DataFrame) -> DataFrame:
    """chunks, dealt to `parts` partitions (None: left as they are bucketed), with what exchanges told them, under the given names; null for chunks that asked nothing."""
    if told and parts:
        chunks = chunks.repartition(parts, "chunk")
    for name, answers in told.items():
        chunks = chunks.join(answers.withColumnRenamed("told", name).hint("merge"), "chunk", "left")
    return chunks


def bucket_count(chunks: DataFrame) -> int:
    return max(1, chunks.count() // CHUNKS_PER_BUCKET)
