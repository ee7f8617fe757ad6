"""Windowed trending and co-occurrence, mirrored pairs, and the read-side sums over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tidemark.functions.expressions import session_key
from tidemark.shared import stored


def users(column: str, exact: bool) -> Column:
    return F.countDistinct(column) if exact else F.approx_count_distinct(column)


def trending(events: DataFrame, window: str = "1 minute", slide: str | None = None, exact: bool = False) -> DataFrame:
    """Per event-time window and product: events, score, users, views, carts, purchases."""
    w = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    kind = lambda t: F.count_if(F.col("event_type") == t)
    return (
        events.groupBy(w.alias("w"), "product_id")
        .agg(F.count("*").alias("event_count"), F.round(F.sum("weight"), 3).alias("score"), users("user_id", exact).alias("unique_users"), kind("view").alias("views"), kind("add_to_cart").alias("carts"), kind("purchase").alias("purchases"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "product_id", "event_count", "unique_users", "views", "carts", "purchases", "score")
    )


#: Rows of one (key, stretch) that a task pairs on one side; more are dealt to several tasks.
STRETCH_ROWS = 20_000


def nearby(rows: DataFrame, keys: list[str], stretch: Column, order: str, stretch_rows: int | None = None) -> DataFrame:
    """Pairs of rows of equal `keys` whose `stretch` numbers are equal or follow each other: the columns of both, first_ and then_.

    The earlier row by `order` goes to its own stretch and the next one, the later row to its own alone: three rows
    a row. Callers tell the earlier from the later and bound the distance; stretches are as wide as that bound, so
    no pair is missed. Keys with more than stretch_rows rows in one stretch are counted first: their later rows are dealt
    to as many salts as it takes, and the earlier rows go to each of them.
    """
    most = stretch_rows or STRETCH_ROWS
    own = rows.withColumn("stretch", stretch)
    named = lambda df, p: df.select(*(F.col(c).alias(c if c in (*keys, "stretch", "salt") else f"{p}_{c}") for c in df.columns))
    hot = own.groupBy(*keys, "stretch").agg(F.count("*").alias("n")).filter(F.col("n") > most)
    first = own.withColumn("stretch", F.explode(F.array("stretch", F.col("stretch") + 1)))
    if hot.isEmpty():
        return named(first, "first").join(named(own, "then"), [*keys, "stretch"]).drop("stretch")
    hot = stored(hot.select(*keys, "stretch", F.ceil(F.col("n") / most).cast("int").alias("salts")))  # few: each has over `most` rows
    salts = F.coalesce("salts", F.lit(1))
    first = first.join(hot, [*keys, "stretch"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    then = own.join(hot, [*keys, "stretch"], "left").withColumn("salt", F.pmod(F.xxhash64(order, *(c for c in rows.columns if c not in keys)), salts).cast("int")).drop("salts")
    return named(first, "first").join(named(then, "then"), [*keys, "stretch", "salt"]).drop("stretch", "salt")


def co_views(events: DataFrame, gap: str, stretch_rows: int | None = None) -> DataFrame:
    """Pairs of events of one session, lower product first, at most `gap` apart, bounds included: session and the columns of both, low_ and high_.

    In a table, events meet by session and stretch of time, so a long session is not paired as a whole. Streams keep
    what the gap needs as state instead.
    """
    own = events.select(session_key(F.col("session_id"), F.col("user_id")).alias("session"), F.col("event_time").alias("time"), F.col("product_id").alias("product"), "weight", F.col("user_id").alias("user"))
    if events.isStreaming:
        named = lambda p: own.select(*(F.col(c).alias(f"{p}_{c}") for c in own.columns))
        within = F.expr(f"low_session = high_session AND low_product < high_product AND high_time BETWEEN low_time - INTERVAL {gap} AND low_time + INTERVAL {gap}")
        return named("low").join(named("high"), within).drop("high_session")
    width = F.greatest(F.expr(f"ceil(unix_micros(timestamp_seconds(0) + INTERVAL {gap}) / 1000000)"), F.lit(1))
    ntz = isinstance(own.schema["time"].dataType, TimestampNTZType)
    seconds = F.expr("cast(cast(time - timestamp_ntz'1970-01-01' as interval second) as bigint)") if ntz else F.unix_seconds("time")
    known = own.filter("session is not null and time is not null and product is not null").withColumn("stretch", F.floor(seconds / width))
    met = nearby(known, ["session"], F.col("stretch"), "time", stretch_rows)
    met = met.filter(F.expr(f"then_time <= first_time + INTERVAL {gap} AND (first_time < then_time AND first_product <> then_product OR first_time = then_time AND first_product < then_product)"))
    lower = F.col("first_product") < F.col("then_product")
    pick = lambda a, b, c, p: F.when(lower, F.col(f"{a}_{c}")).otherwise(F.col(f"{b}_{c}")).alias(f"{p}_{c}")
    kinds = [c for c in own.columns if c != "session"]
    return met.select(F.col("session").alias("low_session"), *(pick("first", "then", c, "low") for c in kinds), *(pick("then", "first", c, "high") for c in kinds))


def co_occurrence(events: DataFrame, gap: str = "2 minutes", window: str = "1 minute", exact: bool = False) -> DataFrame:
    """Per window of the lower product's time and product pair: pairs of events, affinity, users."""
    found = co_views(events, gap).groupBy(F.window("low_time", window).alias("w"), F.col("low_product").alias("product_id"), F.col("high_product").alias("related_product_id"))
    counted = found.agg(F.count("*").alias("pair_count"), F.round(F.sum(F.sqrt(F.col("low_weight") * F.col("high_weight"))), 3).alias("affinity"), users("low_user", exact).alias("unique_users"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *counted.columns[1:])


def mirror_pairs(pairs: DataFrame) -> DataFrame:
    """Both directions of each pair; for tables and batches, not inside a streaming plan."""
    flipped = pairs.withColumns({"product_id": F.col("related_product_id"), "related_product_id": F.col("product_id")})
    return pairs.unionByName(flipped)


def since(rows: DataFrame, cutoff: Column | None) -> DataFrame:
    return rows if cutoff is None else rows.filter(F.col("window_start") >= cutoff)


def back(newest: DataFrame, minutes: int) -> Column:
    """The start of a lookback from a one-row, one-column table, as a scalar."""
    return newest.scalar() - F.expr(f"INTERVAL {minutes} MINUTES")


def newest_end(rows: DataFrame) -> DataFrame:
    return rows.agg(F.max("window_end").alias("newest"))


def trending_lookback(rows: DataFrame, cutoff: Column | None, limit: int) -> DataFrame:
    out = since(rows, cutoff).groupBy("product_id").agg(
        F.sum("event_count").alias("event_count"), F.round(F.sum("score"), 3).alias("score"), F.max("unique_users").alias("peak_users_per_window"),
        F.count("*").alias("windows"), F.min("window_start").alias("first_window"), F.max("window_end").alias("last_window"),
    )
    return out.orderBy(F.col("score").desc(), "product_id").limit(limit)


def enriched(rows: DataFrame, catalog: DataFrame, key: str = "product_id") -> DataFrame:
    """Catalogue columns beside a product id; nulls for unknown products."""
    return rows.join(catalog.select(F.col("id").alias(key), "name", "price", "category"), key, "left")


def product_counts(rows: DataFrame, cutoff: Column | None = None) -> DataFrame:
    """product_id, events, total (of all products)."""
    counts = since(rows, cutoff).groupBy("product_id").agg(F.sum("event_count").alias("events"))
    return counts.crossJoin(F.broadcast(since(rows, cutoff).agg(F.sum("event_count").alias("total"))))


def throughput(rows: DataFrame, windows: int) -> DataFrame:
    """The newest windows, oldest first: events, score, products, events per second."""
    w = rows.groupBy("window_start", "window_end").agg(F.sum("event_count").alias("events"), F.round(F.sum("score"), 3).alias("score"), F.countDistinct("product_id").alias("products"))
    seconds = F.expr("timestampdiff(SECOND, window_start, window_end)")
    rate = F.when(seconds > 0, F.round(F.col("events") / seconds, 6))
    return w.orderBy(F.col("window_start").desc()).limit(windows).withColumn("events_per_second", rate).orderBy("window_start")


def graph_edges(pairs: DataFrame, cutoff: Column | None, limit: int, min_affinity: float = 0, min_pairs: int = 3) -> DataFrame:
    """source, target, affinity, pair_count of the strongest pairs, each once."""
    e = since(pairs, cutoff).filter("product_id < related_product_id").groupBy(F.col("product_id").alias("source"), F.col("related_product_id").alias("target"))
    e = e.agg(F.round(F.sum("affinity"), 3).alias("affinity"), F.sum("pair_count").alias("pair_count"))
    return e.filter((F.col("affinity") >= min_affinity) & (F.col("pair_count") >= min_pairs)).orderBy(F.col("affinity").desc(), "source", "target").limit(limit)


def graph_nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("source", "target")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))


def cross_category(edges: DataFrame, catalog: DataFrame) -> DataFrame:
    """Edges with the categories of both ends and whether they differ."""
    c = catalog.select("id", "category")
    out = edges.join(c.toDF("source", "source_category"), "source", "left").join(c.toDF("target", "target_category"), "target", "left")
    return out.withColumn("crosses", F.col("source_category") != F.col("target_category"))


def user_sketches(events: DataFrame, window: str) -> DataFrame:
    """Mergeable sketches of different users per window and product."""
    g = events.groupBy(F.window("event_time", window).alias("w"), "product_id").agg(F.hll_sketch_agg("user_id").alias("users"))
    return g.select(F.col("w.start").alias("window_start"), "product_id", "users")


def merged_users(sketches: DataFrame) -> DataFrame:
    """Different users of each product over all windows, estimated from the merged sketches."""
    return sketches.groupBy("product_id").agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("unique_users"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def top(rows: DataFrame, by: list, keys: list[str], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each key in an order, with a 0-based rank."""
    w = Window.partitionBy(*keys).orderBy(*by)
    return rows.withColumn(rank, F.row_number().over(w) - 1).filter(F.col(rank) < n)
