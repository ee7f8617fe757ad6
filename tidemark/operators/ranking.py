"""Candidates from six sources, 19 features, labels, and models for a learned order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import cart_rate, dot, unit_vector
from tidemark.operators.aggregates import top
from tidemark.schema import Params

# The model's columns, in this order.
FEATURES = (
    "pair_n", "log_pair_n", "pair_over_q", "log_lift", "co_rank", "i2v_rank", "i2v_cos", "same_cat", "same_parent", "cat_rank",
    "log_views", "log_recent", "cart_rate", "log_buys", "log_q_views", "passes_min_pairs", "log_two_hop", "two_hop_rank", "parent_rank",
)
SOURCES = ("co_occurrence", "category", "item2vec", "parent_category", "two_hop", "bestsellers")


def snapshot(trending: DataFrame, params: Params = Params()) -> DataFrame:  # noqa: B008
    """id, views, recent, carts, buys; recent is the last share of the span of window starts, its start included."""
    views = F.coalesce("views", "event_count")
    ends = trending.agg(F.min("window_start").alias("a"), F.max("window_start").alias("z"))
    span = F.expr("timestampdiff(MICROSECOND, a, z)")
    start = ends.select((F.col("z") - F.make_dt_interval(secs=(span * params.recent_share / 1e6).cast("decimal(18,6)"))).alias("x")).scalar()
    return trending.groupBy(F.col("product_id").alias("id")).agg(
        F.sum(views).cast("double").alias("views"), F.sum(F.when(F.col("window_start") >= start, views).otherwise(0)).cast("double").alias("recent"),
        F.sum(F.coalesce("carts", F.lit(0))).cast("double").alias("carts"), F.sum(F.coalesce("purchases", F.lit(0))).cast("double").alias("buys"),
    )


def neighbours(pairs: DataFrame) -> DataFrame:
    """query, item, n over mirrored pairs, without a least count."""
    return pairs.filter("product_id <> related_product_id").groupBy(F.col("product_id").alias("query"), F.col("related_product_id").alias("item")).agg(F.sum("pair_count").cast("double").alias("n"))


def item_pairs(pairs: DataFrame) -> DataFrame:
    """id, mass, total: an item's share of mirrored pairs, and half of all, 1 if there are none."""
    mass = pairs.groupBy(F.col("product_id").alias("id")).agg(F.sum("pair_count").cast("double").alias("mass"))
    total = mass.agg(F.coalesce(F.nullif(F.sum("mass") / 2, F.lit(0.0)), F.lit(1.0)).alias("total"))
    return mass.crossJoin(F.broadcast(total))


def two_hop(near: DataFrame, params: Params = Params()) -> DataFrame:  # noqa: B008
    """query, item, score: paths over the strongest neighbours and theirs; the query itself costs a slot on the way."""
    order = [F.col("n").desc(), "item"]
    via = top(near, order, ["query"], params.two_hop_via).select("query", F.col("item").alias("mid"), F.col("n").alias("n1"))
    onward = top(near, order, ["query"], params.two_hop_each).select(F.col("query").alias("mid"), "item", F.col("n").alias("n2"))
    return via.join(onward, "mid").filter("item <> query").groupBy("query", "item").agg(F.sum(F.col("n1") * F.col("n2")).alias("score"))


def category_top(snap: DataFrame, catalog: DataFrame, level: str = "category", n: int = 30) -> DataFrame:
    """group, item, rank: the most viewed items of each category (or parent), ties by id."""
    c = catalog.select("id", F.col(level).alias("group")).filter("`group` is not null and `group` <> 'uncategorised'")
    return top(snap.join(c, "id"), [F.col("views").desc(), "id"], ["group"], n).select("group", F.col("id").alias("item"), "rank")


def blend(recommenders: list[DataFrame], limit: int) -> DataFrame:
    """query, item, source, place of several (query, item, rank): the first recommender's items, then the next one's, each item once."""
    every = None
    for i, df in enumerate(recommenders):
        rows = df.select("query", "item", "rank", F.lit(i).alias("source"))
        every = rows if every is None else every.unionByName(rows)
    first = top(every, ["source", "rank"], ["query", "item"], 1, "seen")
    return top(first, ["source", "rank"], ["query"], limit, "place").select("query", "item", "source", "place")


def with_fallback(queries: DataFrame, learned: DataFrame, affinity: DataFrame, unusable: str | None = None) -> DataFrame:
    """query, item, rank, scored_by, learned_unavailable: the learned answer (query, item, rank) of each query, or the affinity
    answer and why: `unusable`, if the model can't be used at all, else that it has no answer for the query."""
    use = learned.filter(F.lit(unusable is None)).join(queries.select("query").distinct(), "query", "left_semi")
    rest = queries.select("query").distinct().join(use.select("query").distinct(), "query", "left_anti")
    answer = lambda df, by, why: df.select("query", "item", "rank", F.lit(by).alias("scored_by"), F.lit(why).cast("string").alias("learned_unavailable"))
    return answer(use, "learned", None).unionByName(answer(affinity.join(rest, "query", "left_semi"), "affinity", unusable or "no learned answer for the item"))


def candidates(queries: DataFrame, near: DataFrame, snap: DataFrame, catalog: DataFrame, similar: DataFrame, hops: DataFrame, params: Params = Params()) -> DataFrame:  # noqa: B008
    """query, item, origin, place: the union of six ranked sources, each item from the first that has it.

    queries is (query); lists are cut before the query is taken out, but for similar items and hops.
    """
    k = params.per_source
    groups = queries.join(catalog.select(F.col("id").alias("query"), "category", "parent"), "query", "left")
    co = top(near, [F.col("n").desc(), "item"], ["query"], k)
    cat = groups.select("query", F.col("category").alias("group")).join(category_top(snap, catalog, "category", k), "group")
    up = groups.select("query", F.col("parent").alias("group")).join(category_top(snap, catalog, "parent", k), "group")
    hop = top(hops, [F.col("score").desc(), "item"], ["query"], k)
    best = snap.orderBy(F.col("views").desc(), "id").limit(params.global_top)
    best = best.select(F.col("id").alias("item"), (F.row_number().over(Window.orderBy(F.col("views").desc(), "id")) - 1).alias("rank"))
    sources = (co, cat, similar.filter(F.col("rank") < k), up, hop, queries.crossJoin(F.broadcast(best)))
    every = reduce(DataFrame.unionByName, (s.select("query", "item", "rank", F.lit(i).alias("source")) for i, s in enumerate(sources)))
    every = every.join(queries, "query", "left_semi").filter("item <> query")
    first = top(every, ["source", "rank"], ["query", "item"], 1, "seen")
    place = F.row_number().over(Window.partitionBy("query").orderBy("source", "rank")) - 1
    origin = F.element_at(F.array(*map(F.lit, SOURCES)), F.col("source") + 1)
    return first.select("query", "item", origin.alias("origin"), F.col("source"), place.alias("place"))


def features(cands: DataFrame, near: DataFrame, snap: DataFrame, mass: DataFrame, catalog: DataFrame, similar: DataFrame, vectors: DataFrame, hops: DataFrame, params: Params = Params()) -> DataFrame:  # noqa: B008
    """query, item, origin and the 19 features of each candidate."""
    k, absent = params.per_source, params.absent_rank
    key = ["query", "item"]
    ranked = lambda df, by, name: top(df, [F.col(by).desc(), "item"], ["query"], k, name).select(*key, name)
    facts = snap.join(mass.select("id", "mass"), "id", "full").join(catalog.select("id", "category", "parent"), "id", "full")
    unit = vectors.select("id", unit_vector(F.col("vector")).alias("v"))
    facts = facts.join(unit, "id", "full")
    side = lambda p: facts.select(*(F.col(c).alias(f"{p}_{c}") for c in facts.columns))
    x = cands.join(near, key, "left").join(ranked(near, "n", "co_rank"), key, "left").join(similar.filter(F.col("rank") < k).select(*key, F.col("rank").alias("i2v_rank")), key, "left")
    x = x.join(hops, key, "left").join(ranked(hops, "score", "two_hop_rank"), key, "left")
    x = x.join(side("q"), F.col("query") == F.col("q_id"), "left").join(side("c"), F.col("item") == F.col("c_id"), "left")
    by = lambda level, name: category_top(snap, catalog, level, k).select(F.col("group").alias(f"{name}_group"), "item", F.col("rank").alias(name))
    ranks_c, ranks_p = by("category", "in_cat"), by("parent", "in_parent")
    x = x.join(ranks_c, (F.col("q_category") == F.col("in_cat_group")) & (x["item"] == ranks_c["item"]), "left").drop(ranks_c["item"])
    x = x.join(ranks_p, (F.col("q_parent") == F.col("in_parent_group")) & (x["item"] == ranks_p["item"]), "left").drop(ranks_p["item"])
    total = F.coalesce(mass.agg(F.max("total")).scalar(), F.lit(1.0))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    rank = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(float(absent)))
    n, mq, mc = zero("n"), zero("q_mass"), zero("c_mass")
    lifted = F.when((n > 0) & (mq > 0) & (mc > 0), n * total / (mq * mc)).otherwise(0.0)
    same_cat = F.coalesce(F.col("c_category") == F.col("q_category"), F.lit(False))
    values = {
        "pair_n": n, "log_pair_n": F.log1p(n), "pair_over_q": n / (mq + 1), "log_lift": F.log1p(lifted), "co_rank": rank("co_rank"), "i2v_rank": rank("i2v_rank"),
        "i2v_cos": F.coalesce(dot(F.col("q_v"), F.col("c_v")), F.lit(0.0)), "same_cat": same_cat.cast("double"), "same_parent": F.coalesce(F.col("c_parent") == F.col("q_parent"), F.lit(False)).cast("double"),
        "cat_rank": F.when(same_cat, rank("in_cat")).otherwise(float(absent)), "log_views": F.log1p(zero("c_views")), "log_recent": F.log1p(zero("c_recent")),
        "cart_rate": cart_rate(zero("c_carts"), zero("c_views")), "log_buys": F.log1p(zero("c_buys")), "log_q_views": F.log1p(zero("q_views")),
        "passes_min_pairs": (n >= params.min_pairs).cast("double"), "log_two_hop": F.log1p(zero("score")), "two_hop_rank": rank("two_hop_rank"), "parent_rank": rank("in_parent"),
    }
    return x.select("query", "item", "origin", *(F.round(values[f], 6).alias(f) for f in FEATURES))


def training_rows(cases: DataFrame, rows: DataFrame) -> DataFrame:
    """Candidates of each case (case, query, target) with label 1 for its target; cases whose target isn't among them go."""
    j = cases.select("case", "query", "target").join(rows, "query").withColumn("label", (F.col("item") == F.col("target")).cast("int"))
    return j.join(j.filter("label = 1").select("case"), "case", "left_semi")


def training_lists(cases: DataFrame, rows: DataFrame) -> DataFrame:
    """Candidates of each query once, as one list (case, item, label, features) for all its cases: label is how many have the item as target.

    A case's rows depend on its query alone, so lists grow with queries and not with cases. Queries without a target among their candidates go.
    """
    times = cases.groupBy("query", F.col("target").alias("item")).agg(F.count("*").alias("label"))
    j = rows.join(times, ["query", "item"], "left").select(F.col("query").alias("case"), "item", F.coalesce("label", F.lit(0)).alias("label"), *FEATURES)
    return j.join(j.filter("label > 0").select("case").distinct(), "case", "left_semi")


def feature_difference(model: DataFrame, code: DataFrame) -> DataFrame:
    """missing, unexpected, same_order between two tables of (position, name)."""
    names = lambda df: df.agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "name"))), lambda s: s["name"]).alias("names"))
    a, b = names(model).select(F.col("names").alias("a")), names(code).select(F.col("names").alias("b"))
    return a.crossJoin(b).select(F.concat_ws(",", F.array_sort(F.array_except("b", "a"))).alias("missing"), F.concat_ws(",", F.array_sort(F.array_except("a", "b"))).alias("unexpected"), (F.col("a") == F.col("b")).alias("same"))


def train_ranker(rows: DataFrame):
    """A pointwise logistic model over the 19 features, to hold boosted trees against."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    stages = [VectorAssembler(inputCols=list(FEATURES), outputCol="x"), LogisticRegression(featuresCol="x", labelCol="label", maxIter=30, regParam=1e-4)]
    return Pipeline(stages=stages).fit(rows)


def ranked(model, rows: DataFrame, limit: int = 10) -> DataFrame:
    """query, item, score, origin, rank by a model's score."""
    from pyspark.ml.functions import vector_to_array

    s = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    return top(s.select("query", "item", "origin", "score"), [F.col("score").desc(), "item"], ["query"], limit)
