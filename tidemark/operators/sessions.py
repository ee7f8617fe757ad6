"""Visits: cutting at an inactivity gap, ids, item lists, test cases, visit pairs and profiles.

Events here are (visitor, at in epoch seconds, item, event_type, event_id as tie-break).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import visit_id
from tidemark.operators.aggregates import nearby


def sessionise(events: DataFrame, gap_minutes: float = 30, stretch_minutes: float = 7 * 24 * 60) -> DataFrame:
    """Adds visit (number within the visitor), started_at, session and seq; a gap of exactly gap_minutes doesn't cut.

    Events are cut and numbered within stretches of time, so that a visitor's whole history is never one task's. What a
    stretch needs of those before it - whether its first event goes on with a visit, that visit's start and events so
    far, and how many visits there were - comes from one row a stretch.
    """
    gap = gap_minutes * 60
    rows = events.withColumn("__stretch", F.floor(F.col("at") / (stretch_minutes * 60)))
    here = Window.partitionBy("visitor", "__stretch").orderBy("at", "event_id")
    new = F.coalesce(F.col("at") - F.lag("at").over(here) > gap, F.lit(False))
    rows = rows.withColumns({"__new": new, "__row": F.row_number().over(here)})
    k = F.sum(F.col("__new").cast("int")).over(here)
    rows = rows.withColumns({"__k": k, "__from": F.last(F.when(F.col("__new"), F.struct("at", "__row")), ignorenulls=True).over(here)})
    one = rows.groupBy("visitor", "__stretch").agg(
        F.min("at").alias("head"), F.max("at").alias("tail"), F.count("*").alias("n"), F.max("__k").alias("cuts"), F.max(F.struct("__row", "__from"))["__from"].alias("open"),
    )
    past = Window.partitionBy("visitor").orderBy("__stretch")
    starts = F.coalesce(F.col("head") - F.lag("tail").over(past) > gap, F.lit(True))
    one = one.withColumn("starts", starts)
    one = one.withColumn("begun", F.when(F.col("cuts") > 0, F.col("open.at")).when(F.col("starts"), F.col("head")))
    one = one.withColumns({"begun_at": F.last("begun", ignorenulls=True).over(past), "run": F.count("begun").over(past)})
    held = F.sum(F.when(F.col("cuts") > 0, F.col("n") - F.col("open.__row") + 1).otherwise(F.col("n"))).over(Window.partitionBy("visitor", "run").orderBy("__stretch"))
    one = one.withColumn("held", held)
    visits = F.sum(F.col("cuts") + F.col("starts").cast("int")).over(past) - F.col("cuts")  # the one that the stretch's first event is in
    carried = one.select(
        F.col("visitor").alias("__visitor"), F.col("__stretch").alias("__of"), visits.alias("__visits"),
        F.when(F.col("starts"), F.col("head")).otherwise(F.lag("begun_at").over(past)).alias("__begun"), F.when(F.col("starts"), 0).otherwise(F.lag("held").over(past)).alias("__held"),
    )
    out = rows.join(carried, F.col("visitor").eqNullSafe(F.col("__visitor")) & F.col("__stretch").eqNullSafe(F.col("__of")))
    inside = F.col("__k") > 0
    return out.select(
        *events.columns, (F.col("__visits") + F.col("__k")).cast("long").alias("visit"), F.when(inside, F.col("__from.at")).otherwise(F.col("__begun")).alias("started_at"),
        F.when(inside, F.col("__row") - F.col("__from.__row")).otherwise(F.col("__row") - 1 + F.col("__held")).cast("int").alias("seq"),
    ).withColumn("session", visit_id(F.col("visitor"), F.col("started_at")))


def visit_items(visits: DataFrame) -> DataFrame:
    """visitor, visit, items: different items in the order of first sight."""
    first = visits.groupBy("visitor", "visit", "item").agg(F.min("seq").alias("seq"))
    lists = first.groupBy("visitor", "visit").agg(F.array_sort(F.collect_list(F.struct("seq", "item"))).alias("x"))
    return lists.select("visitor", "visit", F.col("x.item").alias("items"))


def test_cases(items: DataFrame) -> DataFrame:
    """visitor, visit, query, target, later of visits with two items or more."""
    i = F.col("items")
    return items.filter(F.size("items") > 1).select("visitor", "visit", i[0].alias("query"), i[1].alias("target"), F.slice(i, F.lit(2), F.size(i) - 1).alias("later"))


def visit_pairs(visits: DataFrame, seconds: int = 120, stretch_rows: int | None = None) -> DataFrame:
    """item_a < item_b, n: pairs of views of one visit at most so many seconds apart; views meet by visit and stretch of so many seconds."""
    rows = visits.select("visitor", "visit", "item", "at").filter("visitor is not null and visit is not null and item is not null and at is not null")
    met = nearby(rows, ["visitor", "visit"], F.floor(F.col("at") / max(seconds, 1)).cast("long"), "at", stretch_rows)
    near = met.filter(f"then_at <= first_at + {seconds} and (first_at < then_at and first_item <> then_item or first_at = then_at and first_item < then_item)")
    return near.groupBy(F.least("first_item", "then_item").alias("item_a"), F.greatest("first_item", "then_item").alias("item_b")).agg(F.count("*").alias("n"))


def visitor_pairs(events: DataFrame, most_items: int = 30, least: int = 2) -> DataFrame:
    """item_a < item_b, n: visitors of 2..most_items items who saw both, seen at least `least` times."""
    own = events.select("visitor", "item").distinct()
    few = own.groupBy("visitor").agg(F.count("*").alias("k")).filter(F.col("k").between(2, most_items)).select("visitor")
    own = own.join(few, "visitor")
    j = own.withColumnRenamed("item", "item_a").join(own.withColumnRenamed("item", "item_b"), "visitor").filter("item_a < item_b")
    return j.groupBy("item_a", "item_b").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def heavy_visitors(events: DataFrame, least: int) -> DataFrame:
    return events.groupBy("visitor").agg(F.count("*").alias("events")).filter(F.col("events") >= least)


def visit_profile(visits: DataFrame, heavy: int = 100) -> DataFrame:
    """One row of visit shares in percent, rounded to 3 places."""
    v = visits.groupBy("visitor", "visit").agg(F.countDistinct("item").alias("k"), F.count("*").alias("n"), F.max((F.col("event_type") == "add_to_cart").cast("int")).alias("cart"), F.max((F.col("event_type") == "purchase").cast("int")).alias("buy"))
    share = lambda c: F.round(100 * F.avg(c.cast("int")), 3)
    by_visit = v.agg(share(F.col("k") == 1).alias("one_item"), share(F.col("k") >= 2).alias("two_items"), share(F.col("k") >= 3).alias("three_items"), share(F.col("k") >= 5).alias("five_items"), share(F.col("cart") == 1).alias("cart_visits"), share(F.col("buy") == 1).alias("purchase_visits"))
    p = v.groupBy("visitor").agg(F.count("*").alias("visits"), F.sum("n").alias("events"))
    by_visitor = p.agg(share(F.col("visits") > 1).alias("returning"), F.round(100 * F.sum(F.when(F.col("events") >= heavy, F.col("events")).otherwise(0)) / F.sum("events"), 3).alias("heavy_share"))
    return by_visit.crossJoin(F.broadcast(by_visitor))


def intent_rows(visits: DataFrame, first: int = 3) -> DataFrame:
    """Purchase-intent rows of visits whose first events are all views and that go on after them: eight features and a label."""
    head = F.col("seq") < first
    g = visits.groupBy("visitor", "visit").agg(
        F.count_if(head & (F.col("event_type") == "view")).alias("head_views"), F.count_if(head).alias("head_events"),
        F.countDistinct(F.when(head, F.col("item"))).alias("head_items"), F.max(F.when(head, F.col("at"))).alias("head_end"), F.min("at").alias("started_at"),
        F.min(F.when(F.col("seq") == 1, F.col("at"))).alias("second_at"),
        F.min(F.when(F.col("seq") == 0, F.col("item"))).alias("item_0"), F.min(F.when(F.col("seq") == first - 1, F.col("item"))).alias("item_last"),
        F.count_if(~head).alias("tail"), F.max((~head & F.col("event_type").isin("add_to_cart", "purchase")).cast("int")).alias("label"),
    ).filter(F.col("tail") > 0).filter(F.col("head_views") == first)
    hour = F.floor(F.col("started_at") / 3600) % 24
    return g.select(
        "visitor", "visit", "head_items", F.round(F.col("head_end") - F.col("started_at"), 3).alias("head_seconds"), F.round(F.col("second_at") - F.col("started_at"), 3).alias("first_gap"),
        (F.col("item_0") == F.col("item_last")).cast("int").alias("returns"), hour.alias("hour"), (F.floor(F.col("started_at") / 86400) % 7).alias("weekday"),
        (first - F.col("head_items")).alias("repeats"), (F.col("visit") - 1).alias("visits_before"), "label",
    )
