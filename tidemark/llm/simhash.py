"""Operator 12, SimHash near-dedup: fingerprints split into blocks, close pairs share one, candidates are verified by Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ranges, slices, small_side, staged, table
from tidemark.llm.components import components

BITS = 64
#: A block's value that more fingerprints share is split by further blocks.
BLOCK_MEMBERS = 1024
_LANES = np.uint64(0x0101010101010101)


def majority(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A fingerprint of each run of count[i] hashes: bits that are set in over half of them; 0 for none.

    Eight bits are counted at once in the bytes of a word, over at most 255 hashes before they are added up.
    """
    full = np.flatnonzero(count)
    out = np.zeros(len(count), np.uint64)
    if not len(full):
        return out
    n = count[full]
    pieces = -(-n // 255)
    first = np.cumsum(n) - n
    at = np.repeat(first, pieces) + 255 * ranges(np.zeros(len(n), np.int64), pieces)
    of_text = np.cumsum(pieces) - pieces
    for b in range(8):
        lanes = np.add.reduceat((h >> np.uint64(b)) & _LANES, at)
        set_in = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), of_text, axis=0)
        more = (2 * set_in > n[:, None]).astype(np.uint8)
        out[full] |= np.ascontiguousarray(more).view(np.uint64).ravel() << np.uint64(b)
    return out


def shingle_hashes(text: bytes, size: int, seed: int = 42) -> list[int]:
    """XXH64 of each window of `size` words, joined by spaces; of the whole sequence if it is shorter; none without words."""
    words = text.lower().split()  # bytes: A-Z, and the six ASCII spaces
    if not words:
        return []
    whole, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(whole, seed)]
    end = list(accumulate(len(w) + 1 for w in words))
    return [digest(whole[a : z - 1], seed) for a, z in zip([0, *end], end[size - 1 :], strict=False)]


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            each = [np.array(shingle_hashes(t, size), np.uint64) for t in texts]
            prints = majority(np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "bits"])

    return run


def parts_of(mask: int, count: int) -> list[int]:
    """The bits of mask dealt to `count` blocks of bits that follow each other, as even as can be; empty ones are left out."""
    bits = [i for i in range(BITS) if mask >> i & 1]
    cut = [len(bits) * k // count for k in range(count + 1)]
    return [sum(1 << i for i in bits[a:z]) for a, z in zip(cut, cut[1:], strict=False) if z > a]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def near_links(prints: DataFrame, distance: int = 2, members: int = BLOCK_MEMBERS) -> DataFrame:
    """(a, b) of different fingerprints, a < b, that differ in at most `distance` bits; prints is a staged table of different `bits`.

    Of distance + 1 blocks of bits, close fingerprints have one in common, so they meet on (block, value).
    A value that more than `members` fingerprints share isn't paired: its fingerprints agree in that block, so what
    differs lies in the other bits, which are split into as many blocks anew, and so on. A pair is never lost:
    splitting goes on until values are rare, at the latest where 2 ** (bits left) is no more than `members`, and
    where no more than `distance` bits are left all that share the value are close.
    """
    found = None
    here = [(0, m) for m in parts_of((1 << BITS) - 1, distance + 1)]  # (bits agreed on before, block)
    rows = prints.select("bits", F.lit(0).cast("long").alias("agreed"))
    while here:
        blocks = {}
        for agreed, block in here:
            blocks.setdefault(agreed, []).append(agreed | block)
        masks = F.create_map(*(x for agreed, own in blocks.items() for x in (F.lit(signed(agreed)).cast("long"), F.array(*(F.lit(signed(m)).cast("long") for m in own)))))
        keyed = rows.select("bits", F.explode(masks[F.col("agreed")]).alias("mask")).withColumn("value", F.col("bits").bitwiseAND(F.col("mask")))
        often = staged(keyed.groupBy("mask", "value").agg(F.count("*").alias("n")).filter((F.col("n") > members) & (F.bit_count("mask") < BITS - distance)).select("mask", "value"))
        split = not often.isEmpty()
        few = keyed.join(small_side(often, 48), ["mask", "value"], "left_anti") if split else keyed
        a, b = few.withColumnRenamed("bits", "a"), few.withColumnRenamed("bits", "b")
        pairs = a.join(b, ["mask", "value"]).filter("a < b").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).select("a", "b")
        pairs = staged(pairs.distinct())
        found = pairs if found is None else found.unionByName(pairs)
        if not split:
            break
        rows = staged(keyed.join(small_side(often, 48), ["mask", "value"], "left_semi").select("bits", F.col("mask").alias("agreed")))
        agreed = sorted({r["mask"] for r in often.select("mask").distinct().collect()})  # as many as there are blocks at most
        left = {m: (1 << BITS) - 1 - (m % (1 << BITS)) for m in agreed}
        here = [(m % (1 << BITS), part) for m in agreed for part in parts_of(left[m], distance + 1)]
    return found


def simhash(documents: DataFrame, size: int = 3, distance: int = 2, members: int = BLOCK_MEMBERS) -> DataFrame:
    """One row per row of `documents`: doc_id, bits (the fingerprint as a signed 64-bit number), component_id.

    The fingerprint is over a text's word shingles, repeats included, after lower-casing A-Z. A text with
    fewer words counts as one shingle; null, empty and blank texts have the fingerprint 0. Fingerprints
    link at `distance` or fewer bits, and component_id is the least doc_id that links lead to; null ids
    are no such id, and a component with null ids alone has a null one. Repeated rows have equal
    fingerprints. An empty table gives no rows; columns other than doc_id and text are not read.

    Equal fingerprints are one node with its least id, pre-aggregated, so copies are never paired; what
    meets in blocks are different fingerprints of eight bytes.
    """
    if not 0 <= distance < BITS:
        raise ValueError("distance must be between 0 and 63")
    rows = staged(documents.select("doc_id", "text").mapInArrow(_fingerprints(size), "doc_id long, bits long"))
    prints = staged(rows.groupBy("bits").agg(F.min("doc_id").alias("least")))
    linked = components(near_links(prints.select("bits"), distance, members))
    of = prints.join(linked.withColumnRenamed("node", "bits"), "bits", "left").withColumn("component", F.coalesce("component", "bits"))
    of = staged(of)
    ids = of.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = staged(of.join(ids, "component").select("bits", "component_id"))
    return rows.join(small_side(labels, 32), "bits").select("doc_id", "bits", "component_id")


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


#: DuckDB has no XXH64 with a seed; tests compare with brute force.
SQL = {}
QUERIES = {"op12_simhash_dedup": op12_simhash_dedup}
