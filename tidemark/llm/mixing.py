"""Operator 9, mixing sources to target weights: Pareto order sampling after whole copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_side, staged, table

WORD = "[^\\x20\\x09-\\x0D]+"
#: Stretches of the order in which a source's running sum is taken; each is one small sorted group.
STRETCHES = 1 << 14


def source_targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_copies: int = 3) -> DataFrame:
    """source, source_size, target from rows (source, size).

    Sources in code-point order, null last, weigh `weights`, repeating. They share the sum of all
    sizes by weight; no target exceeds max_copies times its source's size, and what is over goes to
    the others by weight. That is the level at which water fills tubes of width weight and height
    max_copies * size / weight: sources are capped in the order of that height. One row per source.
    """
    by_source = sized.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(order) - 1) % len(weights)
    w = F.element_at(F.array(*map(F.lit, weights)), (k + 1).cast("int")).cast("long")
    t = by_source.select("*", w.alias("w"), (F.col("source_size") * max_copies).alias("cap"))
    total, before = Window.partitionBy(), Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(total) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    wide = F.sum("w").over(total) - F.coalesce(F.sum("w").over(before), F.lit(0))
    t = t.select("*", (left / wide).alias("level"))
    t = t.withColumn("capped", F.col("cap") / F.col("w") <= F.col("level"))
    free = Window.partitionBy()
    level = F.min(F.when(~F.col("capped"), F.struct((F.col("cap") / F.col("w")).alias("h"), F.col("level").alias("level")))).over(free)["level"]
    return t.select("source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("w") * level).alias("target"))


def inclusion_levels(sized: DataFrame, targets: DataFrame, max_copies: int = 3) -> DataFrame:
    """s (the source), level, certain, mean for rows (source, size, weight) and targets (its_source, target): a document
    of weight w is expected min(max_copies, level * w) times, and these times its size add up to its source's target.

    Weights that reach max_copies are found from the greatest one down, over one row a source and weight. level is null
    where all weights reach max_copies or all sizes are 0. certain counts the words of whole copies. mean is the
    chance of a word beyond whole copies, by which the stretches of the order are laid out.
    """
    by = sized.groupBy("source", "weight").agg(F.sum("size").alias("held"))
    by = by.join(targets.select("its_source", "target"), F.col("source").eqNullSafe(F.col("its_source")))
    above = Window.partitionBy("its_source").orderBy(F.col("weight").desc()).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy("its_source").orderBy("weight").rowsBetween(Window.unboundedPreceding, 0)
    left = F.col("target") - F.coalesce(F.sum("held").over(above), F.lit(0)) * max_copies
    weighed = F.sum(F.col("held") * F.col("weight")).over(below)
    by = by.select("its_source", "weight", "held", F.when(weighed > 0, left / weighed).alias("reach"))
    by = by.withColumn("reach", F.when(F.col("reach") * F.col("weight") < max_copies, F.col("reach")))
    # the first weight from the top that stays below max_copies has the level of all below it
    level = F.max_by("reach", F.when(F.col("reach").isNotNull(), F.col("weight"))).over(Window.partitionBy("its_source"))
    times = F.least(F.lit(float(max_copies)), level * F.col("weight"))
    by = by.select(F.col("its_source").alias("s"), "held", level.alias("level"), F.floor(times).alias("whole"), (times - F.floor(times)).alias("p"))
    mean = F.sum(F.col("p") * F.col("held")) / F.sum(F.when((F.col("p") > 0) & (F.col("held") > 0), F.col("held")))
    return by.groupBy("s").agg(F.first("level").alias("level"), F.sum(F.col("whole") * F.col("held")).alias("certain"), F.coalesce(mean, F.lit(0.5)).alias("mean"))


def pareto_mix(
    documents: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_copies: int = 3, seed: str = "mix", row: str | None = None, weight: Column | None = None
) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken for every row of `documents`; with its column `row`, if named.

    size is the number of words, 0 for a null or empty text. `weight`, a positive whole number of few different
    values, says how much a document is wanted within its source; by default the number of binary digits of
    size, so that long texts come somewhat oftener than short ones. A document is expected min(max_copies, level * weight)
    times, where the source's level makes expected words equal its target. The whole part is certain copies;
    the fraction p that is left is the document's own inclusion probability and is sampled in Pareto order: with u uniform
    from a hash of (seed, doc_id, text, row), documents come in the order of their random odds u / (1 - u)
    divided by their inclusion odds p / (1 - p), and are taken while that brings the source's words nearer
    to its target, so the sample's size is fixed and its distance from the target is at most half a
    document. A null source is a source of its own; a null id is hashed as the word null. Rows with equal ids and texts
    stand side by side, in the order of `row`, if named. An empty table gives no rows.

    A running sum over a whole source would put it into one task: the order is cut in STRETCHES, by a growing
    function of the odds that is near uniform (uniform, if all documents of the source have one p); the stretches' sums
    are added up first, and each stretch is summed on its own. Documents with p = 0 are outside the order.
    """
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    own = [row] if row else []
    marks = [F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit(""))), *(F.col(c).cast("string") for c in own)]
    sized = documents.select("doc_id", "source", *own, size.alias("size"), F.md5(F.concat_ws("|", *marks)).alias("mark"), *([weight.cast("long").alias("weight")] if weight is not None else []))
    sized = staged(sized if weight is not None else sized.withColumn("weight", F.length(F.bin("size")).cast("long")))
    targets = staged(source_targets(sized, weights, max_copies)).withColumnRenamed("source", "its_source")
    targets = staged(targets.join(inclusion_levels(sized, targets, max_copies), F.col("its_source").eqNullSafe(F.col("s"))).drop("s"))
    u = (F.conv(F.substring("mark", 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)
    odds = u / (1 - u)
    d = sized.join(small_side(targets, 80), F.col("source").eqNullSafe(F.col("its_source")))
    times = F.when(F.col("source_size") > 0, F.least(F.lit(float(max_copies)), F.col("level") * F.col("weight"))).otherwise(0.0)
    d = d.withColumn("times", times).withColumn("whole", F.floor("times").cast("long")).withColumn("p", F.col("times") - F.col("whole"))
    d = d.withColumn("q", F.when(F.col("p") > 0, odds / (F.col("p") / (1 - F.col("p")))))
    even = F.col("q") * F.col("mean")
    d = d.withColumn("stretch", F.when(F.col("p") > 0, F.floor(even / (1 - F.col("mean") + even) * STRETCHES)))
    key, sampled = ["its_source", "stretch"], d.filter("p > 0")
    sums = sampled.groupBy(*key).agg(F.sum("size").alias("held"))
    before = Window.partitionBy("its_source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("its_source").alias("s"), F.col("stretch").alias("b"), F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    sampled = sampled.join(sums, F.col("its_source").eqNullSafe(F.col("s")) & (F.col("stretch") == F.col("b")))
    inside = Window.partitionBy(*key).orderBy("q", "mark", *own).rowsBetween(Window.unboundedPreceding, -1)
    cum = F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    rest = F.col("target") - F.col("certain")
    more = (rest > 0) & (cum + F.col("size") / 2 <= rest)
    columns = lambda copies: ["doc_id", *own, "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")]
    return sampled.select(*columns(F.col("whole") + more.cast("long"))).unionByName(d.filter("p = 0").select(*columns(F.col("whole"))))


def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_mix(table(spark, sf_dir, "documents"))


def mix_sql(documents: str, seed: str = "mix", row: str | None = None) -> str:
    """DuckDB SQL of pareto_mix with its default weights over a table expression."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, size, length(bin(size))::BIGINT AS weight, md5(mark) AS mark, ('0x' || substr(md5(mark), 1, 13))::BIGINT + 0.5::DOUBLE AS v FROM (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
           concat_ws('|', '{seed}', coalesce(doc_id::VARCHAR, 'null'), md5(coalesce(text, '')){f", {row}::VARCHAR" if row else ""}) AS mark FROM {documents})),
sources AS (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source),
heights AS (SELECT source, s AS source_size, 3 * s AS cap, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS w FROM sources),
water AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::BIGINT / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::BIGINT AS level FROM heights
  WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE w * min(CASE WHEN NOT capped THEN {{'h': cap / w, 'l': level}} END) OVER ().l END AS target
  FROM (SELECT *, cap / w <= level AS capped FROM water)),
classes AS (
  SELECT t.source, t.target, c.weight, (t.target - coalesce(sum(c.held) OVER (PARTITION BY t.source ORDER BY c.weight DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT * 3)
         / nullif(sum(c.held * c.weight) OVER (PARTITION BY t.source ORDER BY c.weight), 0)::BIGINT AS reach
  FROM (SELECT source, weight, sum(size)::BIGINT AS held FROM sized GROUP BY source, weight) c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source),
levels AS (SELECT source, max_by(reach, weight) FILTER (WHERE reach * weight < 3) AS level FROM classes GROUP BY source),
expected AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN least(3.0::DOUBLE, coalesce(l.level * d.weight, 3.0::DOUBLE)) ELSE 0.0::DOUBLE END AS times, d.v / 4503599627370496.0::DOUBLE AS u
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source JOIN levels l ON d.source IS NOT DISTINCT FROM l.source),
odds AS (SELECT *, floor(times)::BIGINT AS whole, times - floor(times) AS p FROM expected),
ranked AS (
  SELECT *, target - sum(whole * size) OVER (PARTITION BY source)::BIGINT AS rest,
         coalesce(sum(CASE WHEN p > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY CASE WHEN p > 0 THEN u / (1 - u) / (p / (1 - p)) END NULLS LAST, mark ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS cum
  FROM odds)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken
FROM (SELECT *, whole + CASE WHEN p > 0 AND rest > 0 AND cum + size / 2 <= rest THEN 1 ELSE 0 END AS copies FROM ranked)"""


SQL = {"op9_pareto_mix": mix_sql("documents")}
QUERIES = {"op9_pareto_mix": op9_pareto_mix}
