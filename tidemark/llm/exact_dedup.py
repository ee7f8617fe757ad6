"""Operator 6, exact dedup: group by a 128-bit content hash, keep one stable id, compare bytes inside groups."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices, small_side, staged, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _hashes(hash_bytes: int, with_text: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            low = [t.lower() for t in texts]  # bytes: A-Z only
            hashed = pa.array([xxhash.xxh3_128_digest(t)[:hash_bytes] for t in low], pa.binary())
            if with_text:
                yield pa.record_batch([hashed, pa.array(low, pa.large_binary()).cast(pa.binary()).cast(pa.string())], ["content_hash", "norm"])
            else:
                yield pa.record_batch([batch.column("doc_id"), hashed, pa.array([hashlib.sha256(t).hexdigest() for t in low], pa.string())], ["doc_id", "content_hash", "text_sha256"])

    return run


def exact_dedup(documents: DataFrame, keep: str = "max", hash_bytes: int = 16) -> DataFrame:
    """One row per row of `documents`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are after lower-casing A-Z; a null text counts as empty, and empty
    texts are equal to each other. Of equal texts the row with the least id in the stable order stays
    (keep="min": ascending doc_id, "max": descending), null ids last; of rows that also repeat the id one
    stays, any. If all ids of a group are null, keep_id is null. Every row counts in group_size. An empty
    table gives no rows; columns other than doc_id and text are not read.

    The hash alone is shuffled, pre-aggregated; only texts of groups of two or more travel, for the
    comparison of bytes as least and greatest text of each hash, which pre-aggregates too. A hash whose
    texts differ is grouped anew by the texts' sha256.
    """
    rows = documents.select("doc_id", F.col("text"))
    hashed = staged(rows.mapInArrow(_hashes(hash_bytes), "doc_id long, content_hash binary, text_sha256 string").withColumn("row", F.monotonically_increasing_id()))
    has_id = F.col("doc_id").isNotNull()
    one = {"min": F.min(F.struct(~has_id, "doc_id", "row")), "max": F.max(F.struct(has_id, "doc_id", "row"))}[keep]
    groups = hashed.groupBy("content_hash").agg(one.alias("one"), F.count("*").alias("group_size"))
    several = staged(groups.filter("group_size > 1").select("content_hash", F.col("one.doc_id").alias("keep_id"), F.col("one.row").alias("keep_row"), "group_size"))
    pairs = hashed.join(small_side(several, 64), "content_hash")
    ids = staged(pairs.filter(has_id).select("doc_id", "content_hash").distinct())
    norm = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    texts = rows.join(small_side(ids, 64), "doc_id").select("content_hash", norm.alias("norm"))
    without_id = rows.filter(~has_id).mapInArrow(_hashes(hash_bytes, True), "content_hash binary, norm string")
    texts = texts.unionByName(without_id.join(several.select("content_hash"), "content_hash"))
    clash = staged(texts.groupBy("content_hash").agg(F.min("norm").alias("a"), F.max("norm").alias("z")).filter("a <> z").select("content_hash"))
    out = hashed.join(small_side(several, 64), "content_hash", "left")
    if not clash.isEmpty():
        own = hashed.join(clash, "content_hash").groupBy("content_hash", "text_sha256")
        own = own.agg(one.alias("one"), F.count("*").alias("own_size")).select("content_hash", "text_sha256", "one", "own_size")
        out = out.join(own, ["content_hash", "text_sha256"], "left")
        is_own = F.col("own_size").isNotNull()
        out = out.withColumns({"keep_id": F.when(is_own, F.col("one.doc_id")).otherwise(F.col("keep_id")), "keep_row": F.when(is_own, F.col("one.row")).otherwise(F.col("keep_row")), "group_size": F.coalesce("own_size", "group_size")})
    alone = F.col("group_size").isNull()
    return out.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), "text_sha256",
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = {
    "op6_exact_dedup": f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t"""
}
QUERIES = {"op6_exact_dedup": op6_exact_dedup}
