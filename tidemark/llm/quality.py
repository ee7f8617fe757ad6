"""Operator 2, quality rules: thresholds per language and source from mergeable quantile sketches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, finish, joined, slices, small_side, staged, table, windows

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
#: metric -> numerator and denominator; metrics are integers, per 10,000.
METRICS = {"symbols": ("n_symbols", "word_chars"), "repeats": ("n_repeat_words", "n_words"), "dup_lines": ("n_dup_lines", "n_words"), "word_length": ("word_chars", "n_words")}
#: What a fence is measured from: percentiles a and b of each metric and a factor, for a + factor * (a - b). a is high where clean
#: texts have the metric now and then, lower where junk alone does.
MEASURES = {"symbols": (85, 50, 6), "repeats": (95, 50, 6), "dup_lines": (98, 50, 6), "word_length": (70, 50, 6)}
#: A fence lies at least this many units above the median, a unit being what one item makes in a text of its group's median size.
UNITS = 6
#: A fence lies no further above its group's median than this many times what is usual among the language's sources.
USUAL = 2
#: Documents that the sketches of the language, and of all rows, each weigh in a (lang, source) group's; 1 / PARTS is the least part of one.
PRIOR, PARTS = 100, 1000


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch, texts in slices(batches):
        lists = [t.split() for t in texts]
        n = np.array([len(x) for x in lists])
        owner = np.repeat(np.arange(len(texts)), n)
        h = hashes.of([w for x in lists for w in x])
        # words of 3-word windows found twice or more in their text
        repeated = np.zeros(len(h), bool)
        three = windows(h, 3)
        if len(three):
            inside = np.flatnonzero(owner[: len(three)] == owner[2:])
            key = joined(three[inside], finish(owner[inside].astype(np.uint64) + np.uint64(1)))
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            twice = inside[order[np.r_[same, False] | np.r_[False, same]]] if len(order) else inside
            for k in range(3):
                repeated[twice + k] = True
        data = np.frombuffer(b"".join(texts), np.uint8)
        size = np.array([len(t) for t in texts])
        of = np.repeat(np.arange(len(texts)), size)
        count = lambda mask: np.bincount(of[mask], minlength=len(texts))
        dup = []
        for t in texts:
            lines = [x for x in t.split(b"\n") if x and not x.isspace()]
            dup.append(len(lines) - len(set(lines)))
        columns = {
            "n_words": n,
            "word_chars": count(~SPACES[data] & ((data & 0xC0) != 0x80)),
            "n_symbols": count(SYMBOLS[data]),
            "n_dup_lines": np.array(dup),
            "n_repeat_words": np.bincount(owner[repeated], minlength=len(texts)),
        }
        ids = [batch.column(c) for c in ("doc_id", "lang", "source")]
        yield pa.record_batch([*ids, *(pa.array(v, pa.int64()) for v in columns.values())], ["doc_id", "lang", "source", *columns])


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts of each whole text, and base_failed; staged."""
    rows = documents.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), "text")
    kinds = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    bad = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return staged(rows.mapInArrow(_features, kinds).withColumn("base_failed", bad))


def bucket(v: Column) -> Column:
    """Bucket of a non-negative integer in a quantile sketch: exact below 32, then 16 buckets to each power of two."""
    e = F.greatest(F.length(F.bin(v)) - 5, F.lit(0))
    return F.when(v < 32, v).otherwise(e * 16 + F.floor(v / F.pow(F.lit(2), e))).cast("long")


def floor_of(b: Column) -> Column:
    """Least value of a bucket."""
    e = F.floor(b / 16) - 1
    return F.when(b < 32, b).otherwise((b - e * 16) * F.pow(F.lit(2), e)).cast("long")


def sketches(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Quantile sketches of each metric and of the sizes of `rows`: (keys, metric, bucket, n). Adding n up merges sketches."""
    value = lambda m: F.expr(f"10000 * {METRICS[m][0]} div greatest({METRICS[m][1]}, 1)")
    sizes = {size: F.col(size) for size in ("n_words", "word_chars")}
    long = rows.select(*keys, F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), bucket(v).alias("bucket")) for m, v in ({m: value(m) for m in METRICS} | sizes).items()))).alias("x"))
    return long.groupBy(*keys, "x.metric", "x.bucket").agg(F.count("*").alias("n"))


def fences(sketch: DataFrame) -> DataFrame:
    """lang, source, metric, fence from the sketches of (lang, source) groups: the value above which a document is out of its group.

    Each group's sketch is merged with its language's and with that of all rows, each scaled to PRIOR
    documents, so that a small group leans on these and a large one on itself. The fence is the least of three bounds, of which
    a source with much junk can't lift all:

    * by MEASURES, from percentiles; junk lifts it once it has more than the share above the percentile;
    * the first gap of the upper half: above a value v that half of the texts don't exceed, nothing up to 2 v and UNITS units;
    * the group's median and USUAL times what the language's median source allows above its own by the first bound.

    It is UNITS units above the median at least. What is told apart in no way: junk that is a third of a language's only source
    and goes on from its clean texts without a gap.
    """
    groups = sketch.select("lang", "source", "metric").distinct()

    def prior(*keys: str) -> DataFrame:
        held = sketch.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
        whole = sketch.groupBy(*keys).agg(F.sum("n").alias("total"))
        names = {k: f"_{k}" for k in keys}
        same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
        share = held.alias("h").join(whole.alias("t"), same("h", "t")).select(*(F.col(f"h.{k}").alias(names[k]) for k in keys), "bucket", F.expr(f"{PRIOR * PARTS} * n div total").alias("n"))
        return groups.join(share, [F.col(k).eqNullSafe(F.col(names[k])) for k in keys]).select("lang", "source", "metric", "bucket", "n")

    own = sketch.select("lang", "source", "metric", "bucket", (F.col("n") * PARTS).alias("n"))
    merged = own.unionByName(prior("lang", "metric")).unionByName(prior("metric")).groupBy("lang", "source", "metric", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy("lang", "source")
    w = Window.partitionBy("lang", "source", "metric")
    up_to = F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    q = merged.filter("n > 0").withColumns({"total": F.sum("n").over(w), "up_to": up_to, "next": F.lead("bucket").over(w.orderBy("bucket"))})
    upper = F.col("up_to") * 2 >= F.col("total")
    size = lambda name: F.greatest(F.min(F.when((F.col("metric") == name) & upper, floor_of(F.col("bucket")))).over(group), F.lit(1))
    of = F.when(F.col("metric").isin(*(m for m, (_, b) in METRICS.items() if b == "n_words")), size("n_words")).otherwise(size("word_chars"))
    q = q.withColumn("units", F.floor(UNITS * 10_000 / of)).filter(F.col("metric").isin(*METRICS))
    gap = F.min(F.when(upper & (floor_of(F.col("next")) > 2 * floor_of(F.col("bucket")) + F.col("units")), 2 * floor_of(F.col("bucket")) + F.col("units")))
    at = lambda p: F.min(F.when(F.col("up_to") * 100 >= F.col("total") * p, F.col("bucket")))
    from_map = lambda k: F.create_map(*(F.lit(x) for m, v in MEASURES.items() for x in (m, v[k])))[F.col("metric")]
    # the upper percentile is the end of its bucket and the lower one the start of its own, so the spread is no less than the sketch can tell
    q = q.groupBy("lang", "source", "metric").agg(floor_of(at(50)).alias("half"), (floor_of(at(from_map(0)) + 1) - 1).alias("a"), floor_of(at(from_map(1))).alias("b"), gap.alias("gap"), F.max("units").alias("units"))
    q = q.withColumn("first", F.greatest(F.col("a") + from_map(2) * (F.col("a") - F.col("b")), F.col("half") + F.col("units")))
    usual = q.groupBy(F.col("lang").alias("of_lang"), F.col("metric").alias("of_metric")).agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY first - half)").cast("long").alias("usual"))
    q = q.join(usual, F.col("lang").eqNullSafe(F.col("of_lang")) & (F.col("metric") == F.col("of_metric")))
    return q.select("lang", "source", "metric", F.greatest(F.least("first", "gap", F.col("half") + USUAL * F.col("usual")), F.col("half") + F.col("units")).alias("fence"))


def quality_rules(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept; one row per row of `documents`.

    Words are runs of anything but the six ASCII white-space characters; a null text has none. Documents
    that fail the base rule are rejected. The others set the thresholds: each (lang, source) group has a
    sketch of each metric, merged with its language's and that of all rows at the weight of PRIOR
    documents each, and a document is rejected if a metric exceeds its group's fence, which fences() sets. A null lang or source is a value like any other. Repeated rows are judged alike;
    an empty table gives no rows; columns other than doc_id, text, lang and source are not read.
    """
    d = measured(documents)
    limits = fences(staged(sketches(d.filter(~F.col("base_failed")), ["lang", "source"])))
    limits = limits.groupBy(F.col("lang").alias("l"), F.col("source").alias("s")).agg(F.map_from_entries(F.collect_list(F.struct("metric", "fence"))).alias("fences"))
    limits = staged(limits)
    out = d.join(small_side(limits, 400), F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
    ok = ~F.col("base_failed")
    for m, (a, b) in METRICS.items():
        ok &= F.expr(f"10000 * {a} div greatest({b}, 1)") <= F.col("fences")[m]
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.coalesce(ok, F.lit(False)).alias("kept"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def quality_sql(documents: str) -> str:
    """DuckDB SQL of quality_rules over a table expression."""
    words = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
    value = {m: f"(10000 * {a} // greatest({b}, 1))" for m, (a, b) in METRICS.items()}
    e = "greatest(length(bin(v)) - 5, 0)"
    metrics = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS metric, {v} AS v FROM d WHERE NOT base_failed" for m, v in (value | {"n_words": "n_words", "word_chars": "word_chars"}).items())
    low = lambda b: f"CASE WHEN {b} < 32 THEN {b} ELSE ({b} - ({b} // 16 - 1) * 16) * (1::BIGINT << ({b} // 16 - 1)) END"
    case = lambda k: "CASE metric " + " ".join(f"WHEN '{m}' THEN {v[k]}" for m, v in MEASURES.items()) + " END"
    at = lambda p: f"min(CASE WHEN up_to * 100 >= total * {p} THEN b END)"
    size = lambda m: f"greatest(min(CASE WHEN metric = '{m}' AND up_to * 2 >= total THEN {low('b')} END) OVER (PARTITION BY lang, source), 1)"
    by_words = ", ".join(f"'{m}'" for m, (_, b) in METRICS.items() if b == "n_words")
    return f"""
WITH w AS (SELECT doc_id, lang, source, text, {words} AS ws FROM {documents}),
x AS (SELECT doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls, ws FROM w),
p AS (SELECT doc_id, i, md5(ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS t FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM w WHERE len(ws) > 2)),
r AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS c FROM p), unnest([0, 1, 2]) AS u(k) WHERE c > 1 GROUP BY doc_id),
d AS (SELECT x.doc_id, lang, source, n_words, word_chars, n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
        n_words < 50 OR 100 * coalesce(r.n, 0) > 50 * n_words AS base_failed FROM x LEFT JOIN r USING (doc_id)),
m AS (SELECT lang, source, metric, CASE WHEN v < 32 THEN v ELSE ({e}) * 16 + (v >> ({e})::INT) END AS b FROM ({metrics})),
k AS (SELECT lang, source, metric, b, count(*) AS n FROM m GROUP BY ALL),
g AS (SELECT DISTINCT lang, source, metric FROM k),
l AS (SELECT lang, metric, b, ({PRIOR * PARTS} * sum(n) // sum(sum(n)) OVER (PARTITION BY lang, metric))::BIGINT AS n FROM k GROUP BY lang, metric, b),
a AS (SELECT metric, b, ({PRIOR * PARTS} * sum(n) // sum(sum(n)) OVER (PARTITION BY metric))::BIGINT AS n FROM k GROUP BY metric, b),
e AS (SELECT lang, source, metric, b, sum(n) AS n FROM (
        SELECT lang, source, metric, b, n * {PARTS} AS n FROM k UNION ALL SELECT g.*, l.b, l.n FROM g JOIN l ON g.lang IS NOT DISTINCT FROM l.lang AND g.metric = l.metric
        UNION ALL SELECT g.*, a.b, a.n FROM g JOIN a ON g.metric = a.metric) GROUP BY ALL),
q AS (SELECT *, ({UNITS} * 10000) // CASE WHEN metric IN ({by_words}) THEN {size("n_words")} ELSE {size("word_chars")} END AS units FROM (
        SELECT *, sum(n) OVER (PARTITION BY lang, source, metric) AS total, lead(b) OVER (PARTITION BY lang, source, metric ORDER BY b) AS nb,
          sum(n) OVER (PARTITION BY lang, source, metric ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS up_to FROM e WHERE n > 0)),
h AS (SELECT lang, source, metric, {at(50)} AS half, {at(case(0))} + 1 AS a, {at(case(1))} AS lo, max(units) AS units,
        min(CASE WHEN up_to * 2 >= total AND {low("nb")} > 2 * ({low("b")}) + units THEN 2 * ({low("b")}) + units END) AS gap FROM q WHERE metric NOT IN ('n_words', 'word_chars') GROUP BY lang, source, metric),
i AS (SELECT lang, source, metric, {low("half")} AS half, units, gap, greatest(({low("a")}) - 1 + {case(2)} * (({low("a")}) - 1 - ({low("lo")})), ({low("half")}) + units) AS first FROM h),
u AS (SELECT lang, metric, quantile_disc(first - half, 0.5) AS usual FROM i GROUP BY lang, metric),
f AS (SELECT i.lang, source, i.metric, greatest(least(first, gap, half + {USUAL} * usual), half + units) AS fence FROM i JOIN u ON i.lang IS NOT DISTINCT FROM u.lang AND i.metric = u.metric),
o AS (SELECT d.doc_id, bool_and(v.x <= f.fence) AS fine FROM d, LATERAL (VALUES {", ".join(f"('{m}', {v})" for m, v in value.items())}) AS v(metric, x)
      JOIN f ON f.lang IS NOT DISTINCT FROM d.lang AND f.source IS NOT DISTINCT FROM d.source AND f.metric = v.metric GROUP BY d.doc_id)
SELECT d.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(fine, FALSE) AS kept FROM d LEFT JOIN o USING (doc_id)"""


SQL = {"op2_quality_rules": quality_sql("documents")}
QUERIES = {"op2_quality_rules": op2_quality_rules}
