"""Held-out evaluation: splits, baselines, hit rates, recall, bootstrap, guards."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.aggregates import top


def day_slice(events: DataFrame, start: float, days: float) -> DataFrame:
    """Events of [start, start + days) in days after the table's first event; column `at` is epoch seconds."""
    first = events.agg(F.min("at")).scalar()
    return events.filter((F.col("at") >= first + start * 86400) & (F.col("at") < first + (start + days) * 86400))


def bestsellers(events: DataFrame, k: int) -> DataFrame:
    """item, n, rank of the most viewed items."""
    n = events.filter("event_type = 'view'").groupBy("item").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "item").limit(k)
    return n.withColumn("rank", F.row_number().over(Window.orderBy(F.col("n").desc(), "item")) - 1)


def category_bestsellers(events: DataFrame, catalog: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query, item, rank: the k + 1 most viewed of the query's category, else of all items."""
    n = events.filter("event_type = 'view'").groupBy("item").agg(F.count("*").alias("n"))
    c = catalog.filter("category is not null and category <> 'uncategorised'").select(F.col("id").alias("item"), "category")
    own = top(n.join(c, "item"), [F.col("n").desc(), "item"], ["category"], k + 1).select("category", "item", "rank")
    known = queries.join(c.select(F.col("item").alias("query"), "category"), "query", "left")
    mine = known.join(own, "category").select("query", "item", "rank")
    rest = queries.join(mine.select("query").distinct(), "query", "left_anti")
    return mine.unionByName(rest.crossJoin(F.broadcast(bestsellers(events, k + 1).select("item", "rank"))))


def hits(cases: DataFrame, answers: DataFrame, k: int = 10) -> DataFrame:
    """Per case: hit, any_hit, answered. The query is dropped from its answer (query, item, rank) before the cut to k."""
    a = answers.filter("item <> query")
    a = top(a, ["rank", "item"], ["query"], k, "place").groupBy("query").agg(F.collect_list("item").alias("items"))
    j = cases.join(a, "query", "left").withColumn("items", F.coalesce("items", F.expr("cast(array() as array<long>)")))
    return j.select("case", F.array_contains("items", F.col("target")).alias("hit"), F.arrays_overlap("items", "later").alias("any_hit"), (F.size("items") > 0).alias("answered"))


def hit_rate(per_case: DataFrame, name: str) -> DataFrame:
    share = lambda c: F.round(F.avg(F.col(c).cast("int")), 6).alias(c)
    return per_case.agg(F.count("*").alias("cases"), share("hit"), share("any_hit"), share("answered")).select(F.lit(name).alias("name"), "cases", "hit", "any_hit", "answered")


def model_lift(model: DataFrame, baseline: DataFrame) -> DataFrame:
    """Ratio of hit rates; null without a baseline hit."""
    j = model.select(F.col("name").alias("model"), F.col("hit").alias("a")).crossJoin(baseline.select(F.col("name").alias("baseline"), F.col("hit").alias("b")))
    return j.select("model", "baseline", F.round(F.when(F.col("b") > 0, F.col("a") / F.col("b")), 6).alias("lift"))


def candidate_recall(cases: DataFrame, pool: DataFrame, sources: int) -> DataFrame:
    """source, recall, mean_pool as sources are added; pool is (query, item, source ordinal)."""
    first = pool.groupBy("query", "item").agg(F.min("source").alias("source"))
    found = cases.join(first.withColumnRenamed("item", "target"), ["query", "target"], "left").select("case", "source")
    sizes = cases.select("case", "query").join(first.select("query", F.col("source").alias("s")), "query", "left").groupBy("case")
    sizes = sizes.agg(*(F.count_if(F.col("s") <= i).alias(f"s{i}") for i in range(sources)))
    wide = found.join(sizes, "case").agg(*(F.struct(F.round(F.avg((F.coalesce("source", F.lit(99)) <= i).cast("int")), 6).alias("recall"), F.round(F.avg(f"s{i}"), 6).alias("mean_pool")).alias(f"r{i}") for i in range(sources)))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(i).alias("source"), f"r{i}.recall", f"r{i}.mean_pool") for i in range(sources)))).alias("x")).select("x.*")


def cold_start_share(cases: DataFrame, train: DataFrame) -> DataFrame:
    seen = train.select("item").distinct().withColumn("seen", F.lit(1))
    j = cases.join(seen.select(F.col("item").alias("query"), F.col("seen").alias("q")), "query", "left").join(seen.select(F.col("item").alias("target"), F.col("seen").alias("t")), "target", "left")
    return j.agg(F.round(100 * F.avg(F.coalesce("q", F.lit(0))), 3).alias("queries_seen"), F.round(100 * F.avg(F.coalesce("t", F.lit(0))), 3).alias("targets_seen"))


def sample_cases(cases: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """n cases in the order of a seeded hash; the same for any partitioning."""
    return cases.withColumn("h", F.md5(F.concat_ws(":", F.col("case").cast("string"), F.lit(seed).cast("string")))).orderBy("h", "case").limit(n).drop("h")


def hit_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """d, n: how many cases the first answers hit and the second missed (1), the other way round (-1), or neither (0)."""
    d = a.select("case", F.col("hit").cast("int").alias("x")).join(b.select("case", F.col("hit").cast("int").alias("y")), "case").select((F.col("x") - F.col("y")).alias("d"))
    return d.filter("d is not null").groupBy("d").agg(F.count("*").alias("n"))


def paired_bootstrap(a: DataFrame, b: DataFrame, draws: int = 1000, seed: int = 7) -> DataFrame:
    """mean difference of hits and a 95 % interval over draws that resample the cases with replacement.

    A case's difference is -1, 0 or 1, so a draw of as many cases is a multinomial draw of the three counts:
    the cases themselves are only counted, and the draws are made from one row.
    """
    held = {r["d"]: r["n"] for r in hit_differences(a, b).collect()}  # three rows
    counts = np.array([held.get(k, 0) for k in (-1, 0, 1)])
    n, row = int(counts.sum()), (None, None, None)
    if n:
        drawn = np.random.default_rng(seed).multinomial(n, counts / n, draws)
        means = np.sort((drawn[:, 2] - drawn[:, 0]) / n)
        row = (float(counts[2] - counts[0]) / n, float(means[int(0.025 * draws)]), float(means[max(int(0.975 * draws) - 1, 0)]))
    return a.sparkSession.createDataFrame([row], "mean double, low double, high double")


def folds(events: DataFrame, starts: tuple[float, ...], train_days: float, label_days: float, test_days: float) -> DataFrame:
    """Events with fold and part (train, label, test) of each fold that they are in."""
    first = events.agg(F.min("at")).scalar()
    day = (F.col("at") - first) / 86400
    out = events.withColumns({"day": day, "fold": F.explode(F.array(*map(F.lit, range(len(starts)))))})
    begin = F.element_at(F.array(*(F.lit(float(s)) for s in starts)), F.col("fold") + 1)
    off = F.col("day") - begin
    part = F.when((off >= 0) & (off < train_days), "train").when((off >= train_days) & (off < train_days + label_days), "label").when((off >= train_days + label_days) & (off < train_days + label_days + test_days), "test")
    return out.withColumn("part", part).filter("part is not null").drop("day")


def window_mismatch(manifest: DataFrame, start_day: str, days: float) -> str | None:
    """Why an evaluation must be refused: the newest run covers other days than those asked for; None without a run."""
    run = manifest.orderBy(F.col("finished_at").desc()).first()
    if run is None or (run["start_day"], run["days"]) == (start_day, days):
        return None
    return f"the table holds {run['days']} days from {run['start_day']}, not {days} from {start_day}"


def check_answers(queries: int, unknown: int, answered: int) -> None:
    """Refuses results that say more about the set-up than about the model."""
    if queries and unknown * 2 > queries:
        raise ValueError(f"{unknown} of {queries} queries are unknown to the catalogue")
    if queries and answered * 2 < queries:
        raise ValueError(f"only {answered} of {queries} queries were answered")


def evaluated(cases: DataFrame, answers: DataFrame, catalog: DataFrame, k: int = 10) -> DataFrame:
    """hits(), after a check that the queries are mostly known to the catalogue and mostly answered."""
    asked = cases.select("query").distinct()
    known = catalog.select(F.col("id").alias("query"), F.lit(1).alias("known"))
    got = answers.select("query").distinct().withColumn("got", F.lit(1))
    n = asked.join(known, "query", "left").join(got, "query", "left").agg(F.count("*").alias("asked"), F.count_if(F.col("known").isNull()).alias("unknown"), F.count("got").alias("answered")).first()
    check_answers(n["asked"], n["unknown"], n["answered"])
    return hits(cases, answers, k)
