"""Corpus pipeline: documents -> quality rules -> exact dedup -> n-gram join -> source mixing -> piece ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. Verdicts are by
row, also where ids are null or repeat. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import small_side, staged, table
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.mixing import pareto_mix
from tidemark.llm.ngram_join import ngram_join
from tidemark.llm.quality import quality_rules
from tidemark.llm.sentencepieces import encode


#: Column that a row is told apart by inside a stage.
ROW = "__row"


def numbered(docs: DataFrame, nulls_last: bool = False) -> DataFrame:
    """docs with ROW, a number that no other row has and that sorts as doc_id, null ids first or last.

    The id itself where all are different and none is null. Else rows are sorted by id, a 128-bit hash
    of the text and a hash of the other columns, and numbered; only rows equal in all of these can change
    places, so chance may deal them out.
    """
    n = docs.agg(F.count("*").alias("rows"), F.countDistinct("doc_id").alias("ids")).first()
    if n["rows"] == n["ids"]:
        return docs.withColumn(ROW, F.col("doc_id"))
    first = F.col("doc_id").asc_nulls_last() if nulls_last else F.col("doc_id").asc_nulls_first()
    order = (first, F.md5(F.coalesce("text", F.lit(""))), F.col("text").isNull(), F.xxhash64(*(c for c in docs.columns if c != "text")), F.rand(7))
    return staged(docs.orderBy(*order).withColumn(ROW, F.monotonically_increasing_id()))


def by_row(rows: DataFrame) -> DataFrame:
    """rows with ROW in place of doc_id, for operators that ask no more of an id than its order."""
    return rows.withColumn("doc_id", F.col(ROW)).drop(ROW)


def without(rows: DataFrame, out: DataFrame) -> DataFrame:
    """rows but those whose number is a doc_id of `out`, which is the short side, broadcast if that is small."""
    return rows.join(small_side(staged(out.select(F.col("doc_id").alias(ROW))), 24), ROW, "left_anti").select(*(c for c in rows.columns if c != ROW))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep."""
    rows = numbered(docs)
    return without(rows, quality_rules(by_row(rows)).filter(~F.col("kept")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of those with equal texts: one with the greatest id."""
    rows = numbered(docs)
    return without(rows, exact_dedup(by_row(rows)).filter(~F.col("kept")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least row of each component of the n-gram join, near copies being those that share 0.8 of their 5-word shingles."""
    rows = numbered(docs, nulls_last=True)
    return without(rows, ngram_join(by_row(rows), size=5, percent=80).filter("doc_id <> component_id"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as the mix takes it."""
    rows = numbered(docs)
    copies = staged(pareto_mix(rows, row=ROW).filter("copies <> 1").select(ROW, "copies"))
    out = rows.join(small_side(copies, 32), ROW, "left")
    times = F.coalesce(F.col("copies").cast("int"), F.lit(1))
    return out.withColumn("copies", F.explode(F.array_repeat(F.lit(1), times))).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids of each row."""
    import public_tokenizers

    return encode(docs, public_tokenizers.path("piece_bpe_32k.model")).select("doc_id", "n_tokens", "ids")


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram join", near), ("source mixing", mix), ("sentence pieces", pieces)]

#: SQL can't merge pieces by score; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
