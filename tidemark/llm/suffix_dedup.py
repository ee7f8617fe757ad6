"""Operator 5, suffix-array dedup over bytes: run-compressed indexes of the passages that may repeat."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import beside, covered, finish, joined, lists, minimizers, slices, staged, table
from tidemark.llm.run_index import RunIndex

#: Bytes of a match.
MATCH = 200
#: Bytes of text that one index is built over, and positions hashed at a time.
INDEX_BYTES, STRETCH = 400_000, 1 << 16
#: Parts that may share one key in an index; keys with more are compared by hashes of whole matches.
MOST_PARTS = 20_000
ODD = np.uint64(0xD6E8FEB86659FD93)


def _levels(match: int) -> tuple[int, int]:
    return -(-match // 4), -(-match // 2)


class _Rolling:
    """Hashes of byte strings of any length from prefix sums over hashed eight-byte grams (lengths above 8)."""

    def __init__(self, data: np.ndarray):
        gram = data.astype(np.uint64)
        for k in (1, 2, 4):
            gram = (gram[:-k] << np.uint64(8 * k)) | gram[k:]
        power = np.full(len(gram) + 1, ODD)
        power[0] = 1
        self.power = np.multiply.accumulate(power)
        self.sums = np.r_[np.uint64(0), np.cumsum(finish(gram) * self.power[:-1])]
        back = np.full(len(gram) + 1, np.uint64(pow(int(ODD), -1, 1 << 64)))
        back[0] = 1
        self.back = np.multiply.accumulate(back)

    def of(self, start, size: int) -> np.ndarray:
        return finish((self.sums[start + (size - 7)] - self.sums[start]) * self.back[start])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - (size - 7)
        return finish((self.sums[size - 7 :] - self.sums[:n]) * self.back[:n]) if n > 0 else self.sums[:0]


def _seeds(match: int):
    quarter, half = _levels(match)
    more = half - quarter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            n = np.array([len(t) for t in texts], np.int64)
            everything, base = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(n) - n
            owners = np.repeat(np.arange(len(n), dtype=np.int32), n)
            uid = batch.column("uid")
            for a in range(0, len(everything) - match + 1, STRETCH):
                z = min(len(everything), a + STRETCH + match - 1)
                owner = owners[a:z]
                whole = owner[: z - a - match + 1] == owner[match - 1 :]
                rolling = _Rolling(everything[a:z])
                pos, first, last = minimizers(rolling.all(quarter), match - quarter + 1, whole)
                if not len(pos):
                    continue
                own = owner[pos]
                start = base[own] - a
                left, right = (pos - more >= start) & (pos >= more), (pos + half <= start + n[own]) & (pos + half <= z - a)
                block = joined(rolling.of(first, match), rolling.of(last, match) + (last - first).astype(np.uint64) + ((pos - first) << 10).astype(np.uint64))
                value = lambda at, ok: pa.array(rolling.of(np.where(ok, at, 0), half).view(np.int64), mask=~ok)
                yield pa.record_batch(
                    [
                        uid.take(pa.array(own)),
                        pa.array(rolling.of(pos, quarter).view(np.int64)),
                        value(pos - more, left),
                        value(pos, right),
                        pa.array(block.view(np.int64)),
                        pa.array((first - start).astype(np.int32)),
                        pa.array((last - first).astype(np.int16)),
                        pa.array((pos - first).astype(np.int16)),
                    ],
                    ["uid", "seed", "left", "right", "block", "first", "more", "at"],
                )

    return run


def _parts(match: int):
    """Cuts each block at its seed into the part whose matches hold the left doubled seed, and the part for the right one."""
    quarter, half = _levels(match)
    more = half - quarter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            count, b = lists(batch.column("blocks"))
            own = np.repeat(np.arange(len(texts)), count)
            first, last = b["first"].astype(np.int64), b["first"].astype(np.int64) + b["more"]
            middle = first + b["at"] - more  # the last start that has room for the left one
            out = []
            for key, use, lo, hi in (("left", b["in_left"].astype(bool) & (middle >= first), first, np.minimum(middle, last)), ("right", b["in_right"].astype(bool) & (middle < last), np.maximum(middle + 1, first), last)):
                i = np.flatnonzero(use)
                out.append((own[i], b[key][i], lo[i], hi[i]))
            own, key, lo, hi = (np.concatenate(x) for x in zip(*out, strict=True))
            piece = [texts[o][a : z + match] for o, a, z in zip(own.tolist(), lo.tolist(), hi.tolist(), strict=True)]
            yield pa.record_batch(
                [batch.column("uid").take(pa.array(own)), pa.array(key.astype(np.int64)), pa.array(lo.astype(np.int32)), pa.array(piece, pa.binary())],
                ["uid", "key", "first", "piece"],
            )

    return run


def _indexed(match: int):
    """Rows sorted by key: builds an index over whole keys, about INDEX_BYTES at a time, and returns the starts of long matches."""

    def marked(uid: list, first: list, piece: list) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(piece), np.uint8)
        size = np.array([len(p) for p in piece], np.int64)
        end = np.cumsum(size)
        index = RunIndex(data, end - size, end)
        hit = np.flatnonzero(index.matching() >= match)
        own = index.owner[hit]
        at = np.array(first, np.int64)[own] + hit - index.base[own]
        new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)]) if len(hit) else hit
        final = np.r_[new[1:], len(hit)] - 1 if len(hit) else hit
        return pa.record_batch(
            [pa.array(np.array(uid, np.int64)[own[new]]), pa.array(at[new].astype(np.int32)), pa.array((at[final] + match).astype(np.int32))],
            ["uid", "first", "last"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, first, piece, held, last_key = [], [], [], 0, None
        for batch in batches:
            for u, k, f, p in zip(*(batch.column(c).to_pylist() for c in ("uid", "key", "first", "piece")), strict=True):
                if k != last_key and held >= INDEX_BYTES:
                    yield marked(uid, first, piece)
                    uid, first, piece, held = [], [], [], 0
                last_key = k
                uid.append(u)
                first.append(f)
                piece.append(p)
                held += len(p)
        if piece:
            yield marked(uid, first, piece)

    return run


def _hashes(match: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for u, f, p in zip(*(batch.column(c).to_pylist() for c in ("uid", "first", "piece")), strict=True):
                h = _Rolling(np.frombuffer(p, np.uint8)).all(match)
                yield pa.record_batch([pa.array(np.full(len(h), u)), pa.array((f + np.arange(len(h))).astype(np.int32)), pa.array(h.view(np.int64))], ["uid", "first", "hash"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        count, s = lists(batch.column("spans"))
        upto, out = np.cumsum(count), []
        for i, t in enumerate(texts):
            removed, spans, kept = 0, 0, t
            if count[i]:
                mine = slice(upto[i] - count[i], upto[i])
                gone = covered(len(t), s["first"][mine], s["last"][mine])
                removed, spans = int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]]).sum())
                kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
            out.append((len(t), removed, spans, kept))
        n, removed, spans, kept = zip(*out, strict=True)
        yield pa.record_batch(
            [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, removed, spans)), pa.array(kept, pa.large_binary()).cast(pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def suffix_dedup(documents: DataFrame, match: int = MATCH, most_parts: int = MOST_PARTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that are left) for every row of `documents`.

    A byte goes if it is covered by a string of `match` bytes that also starts at another place, of any
    row, the same one included; matches never cross rows and are judged on the input. A null text is
    empty. Repeated rows are two places, so both lose all that is `match` bytes or longer. Ids may be
    null or repeat. An empty table gives no rows; columns other than doc_id and text are not read.

    One index over all texts can't be built in one task. Passages that may repeat are found first: each
    string of `match` bytes has one seed, the least-hashed of its quarter-length strings, so equal strings
    have equal seeds at equal places, and seeds that occur once are left out; so are seeds that occur
    once when doubled to the left and to the right. All strings that share a seed are one block, and of
    equal blocks one goes on. The blocks, cut into the part left of the seed's middle and the part right
    of it, meet by their doubled seed in a task that builds run-compressed Burrows-Wheeler indexes of
    them, streams the matching statistics off the sampled run ends, and marks matches of `match` bytes.
    A doubled seed with more than `most_parts` different surroundings would make too large an index;
    its strings are compared by pre-aggregated hashes instead.
    """
    rows = documents.select("doc_id", F.col("text"), F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("uid"))
    kinds = "uid long, seed long, left long, right long, block long, first int, more short, at short"
    seeds = staged(rows.select("uid", "text").mapInArrow(_seeds(match), kinds))
    several = lambda df, *keys: staged(df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys))
    found = staged(seeds.join(several(seeds, "seed"), "seed"))
    for side in ("left", "right"):
        again = several(found.filter(f"{side} is not null"), side).withColumn(f"in_{side}", F.lit(True))
        found = found.join(again, side, "left")
    found = staged(found.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("in_left", "in_right")}).filter("in_left or in_right"))
    fields = F.struct("uid", "first", "more", "at", "left", "right", "in_left", "in_right")
    blocks = staged(found.groupBy("seed", "block").agg(F.count("*").alias("n"), F.min(fields).alias("one")))
    equal = found.join(staged(blocks.filter("n > 1").select("seed", "block")), ["seed", "block"])
    equal = equal.select("uid", "first", (F.col("first") + F.col("more") + match).cast("int").alias("last"))
    mixed = blocks.groupBy("seed").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("seed")
    ones = blocks.join(mixed, "seed").select("one.*")
    ones = staged(ones.groupBy("uid").agg(F.collect_list(F.struct(*(c for c in ones.columns if c != "uid"))).alias("blocks")))
    text = rows.select("uid", "text")
    pieces = beside(text, ones, ["uid"], "blocks", 56, every=False).mapInArrow(_parts(match), "uid long, key long, first int, piece binary")
    pieces = staged(pieces.dropDuplicates(["uid", "key", "first"]))
    counts = staged(pieces.groupBy("key").agg(F.count("*").alias("parts")).filter("parts > 1"))
    usual = pieces.join(counts.filter(F.col("parts") <= most_parts), "key")
    usual = usual.repartition("key").sortWithinPartitions("key").select("uid", "key", "first", "piece")
    spans = equal.unionByName(usual.mapInArrow(_indexed(match), "uid long, first int, last int"))
    if not counts.filter(F.col("parts") > most_parts).isEmpty():
        hashed = staged(pieces.join(counts.filter(F.col("parts") > most_parts), "key").select("uid", "first", "piece").mapInArrow(_hashes(match), "uid long, first int, hash long"))
        again = hashed.join(several(hashed, "hash"), "hash")
        spans = spans.unionByName(again.select("uid", "first", (F.col("first") + match).cast("int").alias("last")))
    spans = staged(spans.groupBy("uid").agg(F.collect_list(F.struct("first", "last")).alias("spans")))
    marked = beside(rows, spans, ["uid"], "spans", 24, every=True).select("doc_id", "text", "spans")
    return marked.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL: dict[str, str] = {}
QUERIES = {"op5_suffix_dedup": op5_suffix_dedup}
