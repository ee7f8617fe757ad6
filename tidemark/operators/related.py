"""Related products for all products at once: affinity, lift, PMI, fills, anchored lookbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import lift, pmi
from tidemark.operators.aggregates import since, top


def summed_pairs(pairs: DataFrame, cutoff: Column | None = None, min_pairs: int = 3) -> DataFrame:
    """product_id, related_product_id, affinity, pair_count, peak users over the lookback, with the least support."""
    g = since(pairs, cutoff).groupBy("product_id", "related_product_id")
    g = g.agg(F.round(F.sum("affinity"), 3).alias("affinity"), F.sum("pair_count").alias("pair_count"), F.max("unique_users").alias("peak_users_per_window"))
    return g.filter(F.col("pair_count") >= min_pairs)


def anchored_pairs(pairs: DataFrame, as_of: Column, minutes: int) -> DataFrame:
    """Each product's pairs of its lookback, with `window` (recent or latest_available).

    The lookback ends at as_of; a product without pairs in it gets the same lookback back from its own
    newest window start.
    """
    span = F.expr(f"INTERVAL {minutes} MINUTES")
    newest = F.max("window_start").over(Window.partitionBy("product_id"))
    recent = newest >= as_of - span
    start = F.when(recent, as_of - span).otherwise(newest - span)
    return pairs.withColumns({"window": F.when(recent, "recent").otherwise("latest_available"), "_from": start}).filter("window_start >= _from").drop("_from")


def scored(pairs: DataFrame, counts: DataFrame, method: str = "affinity") -> DataFrame:
    """Adds lift, pmi, score, undefined; undefined scores fall back to affinity and say so.

    counts is (product_id, events, total); a product it lacks has no events.
    """
    own = counts.select(F.col("product_id"), F.col("events").alias("n_a"), F.col("total").alias("n_all"))
    other = counts.select(F.col("product_id").alias("related_product_id"), F.col("events").alias("n_b"))
    j = pairs.join(own, "product_id", "left").join(other, "related_product_id", "left")
    j = j.withColumn("lift", lift(F.col("pair_count"), F.coalesce("n_a", F.lit(0)), F.coalesce("n_b", F.lit(0)), F.coalesce("n_all", F.lit(0))))
    j = j.withColumn("pmi", pmi(F.col("lift")))
    value = F.col("affinity") if method == "affinity" else F.col(method)
    j = j.withColumns({"undefined": value.isNull(), "score": F.round(F.coalesce(value, "affinity"), 4)})
    return j.drop("n_a", "n_b", "n_all")


def related(pairs: DataFrame, counts: DataFrame, method: str = "affinity", limit: int = 10) -> DataFrame:
    """The first `limit` related products of every product, from max(4 * limit, 20) by affinity, ranked by the method."""
    pool = top(pairs, [F.col("affinity").desc(), "related_product_id"], ["product_id"], max(4 * limit, 20), "by_affinity")
    order = ["undefined", F.col("score").desc(), F.col("affinity").desc(), "related_product_id"]
    return top(scored(pool, counts, method), order, ["product_id"], limit).drop("by_affinity")


def by_category(counts: DataFrame, catalog: DataFrame, limit: int) -> DataFrame:
    """product_id, events, category, rank of each category's most active products; uncategorised ones in none."""
    c = catalog.filter("category is not null and category <> 'uncategorised'").select(F.col("id").alias("product_id"), "category")
    return top(counts.join(c, "product_id"), [F.col("events").desc(), "product_id"], ["category"], limit)


def related_with_fill(pairs: DataFrame, counts: DataFrame, catalog: DataFrame, newest_trending: DataFrame, limit: int = 10, method: str = "affinity") -> DataFrame:
    """product_id, item, source, place for every catalogue product.

    Co-occurrence first, then the product's category; products without any pairs get what is left from
    the newest trending window. Items already chosen and the product itself are skipped.
    """
    queries = catalog.select(F.col("id").alias("product_id"), "category")
    first = related(pairs, counts, method, limit).select("product_id", F.col("related_product_id").alias("item"), F.lit(0).alias("tier"), F.col("rank").alias("at"))
    has = first.select("product_id").distinct().withColumn("has_pairs", F.lit(True))
    best = by_category(counts, catalog, 2 * limit + 1).select("category", F.col("product_id").alias("item"), F.col("rank").alias("at"))
    second = queries.join(best, "category").select("product_id", "item", F.lit(1).alias("tier"), "at")
    hot = newest_trending.orderBy(F.col("score").desc(), "product_id").limit(2 * limit + 1)
    hot = hot.withColumn("at", F.row_number().over(Window.orderBy(F.col("score").desc(), "product_id")) - 1)
    third = queries.join(has, "product_id", "left_anti").crossJoin(F.broadcast(hot.select(F.col("product_id").alias("item"), "at")))
    third = third.select("product_id", "item", F.lit(2).alias("tier"), "at")
    every = first.unionByName(second).unionByName(third).filter("item <> product_id")
    names = F.element_at(F.array(*map(F.lit, ("co_occurrence", "category_bestsellers", "trending"))), F.col("tier") + 1)
    chosen = top(every, ["tier", "at"], ["product_id", "item"], 1, "seen")
    return top(chosen, ["tier", "at"], ["product_id"], limit, "place").select("product_id", "item", names.alias("source"), "place")


def answer_sources(answers: DataFrame) -> DataFrame:
    """source, products: queries by what answered them, co-occurrence with a fill counted on its own."""
    kinds = answers.groupBy("product_id").agg(F.collect_set("source").alias("s"))
    has = lambda x: F.array_contains("s", x)
    name = F.when(has("co_occurrence") & (F.size("s") > 1), "co_occurrence_filled").when(has("co_occurrence"), "co_occurrence").when(has("category_bestsellers"), "category_fallback").otherwise("trending_fallback")
    return kinds.select(name.alias("source")).groupBy("source").agg(F.count("*").alias("products"))


def related_retained(pairs: DataFrame, cutoff: Column, limit: int, min_pairs: int = 3) -> DataFrame:
    """By pair_count: from the lookback, or for products without any there from all that is retained."""
    order = [F.col("pair_count").desc(), "related_product_id"]
    recent = summed_pairs(pairs, cutoff, min_pairs)
    rest = summed_pairs(pairs, None, min_pairs).join(recent.select("product_id").distinct(), "product_id", "left_anti")
    both = recent.withColumn("window", F.lit("recent")).unionByName(rest.withColumn("window", F.lit("all")))
    return top(both, order, ["product_id"], limit).select("product_id", "related_product_id", "pair_count", "window", "rank")
