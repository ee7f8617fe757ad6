"""Streaming queries over the given events, fed file by file, and read back from their tables."""

from __future__ import annotations

import time
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.health import reconcile
from tidemark.plans import views as v
from tidemark.plans.views import EPOCH
from tidemark.schema import Params
from tidemark.shared import shared_folder, stored
from tidemark.sources.events import parse_events, text_events, valid_events
from tidemark.streaming import accounting, jobs

#: The watermark spans the events, as the files of a folder come in any order.
PARAMS = Params(watermark="60 days", window="1 day", gap="2 hours")


def fed(spark: SparkSession, d: str, root: str, parts: int = 4, copies: int = 1) -> DataFrame:
    """The wire events as a stream of text files, in time order, and an event far past the end that closes all windows. Each line comes `copies` times."""
    w = v.wire(spark, d).join(v.raw_clicks(spark, d).select("event_id", "event_time"), "event_id")
    lines = w.select(F.col("value").cast("string").alias("value"), "event_time").filter("value is not null")
    lines = lines.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("copy")
    order = lines.repartitionByRange(parts, "event_time").sortWithinPartitions("event_time").select("value")
    order.write.text(f"{root}/in/events")
    last = lines.agg(F.max(F.expr(f"timestampdiff(SECOND, {EPOCH}, event_time)")).alias("t")).collect()[0]["t"] or 0
    spark.createDataFrame([(x,) for x in jobs.flush_events(last + 120 * 86400, 3)], "value string").coalesce(1).write.text(f"{root}/in/flush")
    return text_events(spark, f"{root}/in/*")


def run(spark: SparkSession, d: str, name: str) -> str:
    root = shared_folder(spark)
    for q in jobs.start(fed(spark, d, root), root, PARAMS, once=True, only=(name,)).values():
        q.awaitTermination()
        if q.exception():
            raise RuntimeError(str(q.exception()))
    return root


def trending_rate(spark: SparkSession, d: str) -> dict:
    """Events a second of the trending query alone, over an input written before, and its state rows at the end."""
    root = shared_folder(spark)
    stream = fed(spark, d, root)
    events = v.wire(spark, d).count()
    began = time.time()
    query = jobs.start(stream, root, PARAMS, once=True, only=("trending",))["trending"]
    query.awaitTermination()
    seconds = time.time() - began
    states = [sum(o.numRowsTotal for o in p.stateOperators) for p in query.recentProgress if p.stateOperators]
    return {"events": events, "seconds": round(seconds, 3), "events_per_second": round(events / seconds), "most_state_rows": max(states, default=0)}


def _seconds(c: str):
    return F.unix_seconds(c).alias(c)


def stream_trending(spark: SparkSession, d: str) -> DataFrame:
    rows = jobs.KeyedTable(f"{run(spark, d, "trending")}/trending", tuple(jobs.TRENDING_KEYS)).read(spark)
    return rows.filter("product_id >= 0").select(_seconds("window_start"), F.col("product_id").cast("long").alias("product_id"), "event_count", "views", "carts", "purchases", "score")


def stream_trending_days(spark: SparkSession, d: str) -> DataFrame:
    """Trending of the stream's last week, from a table partitioned by day of which the other days are not read."""
    root = shared_folder(spark)
    jobs.start(fed(spark, d, root), root, PARAMS, once=True, only=("trending",), by_day=True)["trending"].awaitTermination()
    table = jobs.DayTable(f"{root}/trending", tuple(jobs.TRENDING_KEYS))
    last = v.clicks(spark, d).agg(F.max("event_time").cast("date").alias("day")).first()["day"]
    rows = table.read(spark, str(last - timedelta(days=6)), str(last))
    return rows.select(_seconds("window_start"), F.col("product_id").cast("long").alias("product_id"), "event_count", "score")


def stream_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = jobs.KeyedTable(f"{run(spark, d, "pairs")}/pairs", tuple(jobs.PAIR_KEYS)).read(spark)
    return rows.filter("product_id >= 0 and related_product_id >= 0").select(_seconds("window_start"), F.col("product_id").cast("long").alias("product_id"), F.col("related_product_id").cast("long").alias("related_product_id"), "pair_count", "affinity")


def stream_dead_letter(spark: SparkSession, d: str) -> DataFrame:
    rows = jobs.KeyedTable(f"{run(spark, d, "dead_letter")}/dead_letter", ()).read(spark)
    return rows.groupBy("invalid_reason").agg(F.count("*").alias("n"))


def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Session windows over the stream: visits that end within its time."""
    root = shared_folder(spark)
    events = valid_events(parse_events(fed(spark, d, root))).withWatermark("event_time", PARAMS.watermark)
    out = events.groupBy(F.session_window("event_time", "30 minutes").alias("w"), "user_id").agg(F.count("*").alias("events"))
    table = jobs.KeyedTable(f"{root}/sessions", ())
    query = out.select("user_id", F.col("w.start").alias("started"), "events").writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoints/sessions").foreachBatch(table.writer()).trigger(availableNow=True).start()
    query.awaitTermination()
    return table.read(spark).filter("user_id >= 0").select(F.col("user_id").cast("long").alias("user_id"), _seconds("started"), "events")


def stream_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """The valid events of a stream that has each line twice, once by event id."""
    root = shared_folder(spark)
    events = jobs.deduplicated(jobs.watermarked(valid_events(parse_events(fed(spark, d, root, copies=2))), PARAMS.watermark))
    table = jobs.KeyedTable(f"{root}/events", ())
    query = events.select("event_id", "user_id").writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoints/events").foreachBatch(table.writer()).trigger(availableNow=True).start()
    query.awaitTermination()
    return table.read(spark).filter("user_id >= 0").select("event_id", F.col("user_id").cast("long").alias("user_id"))


#: A watermark that events do miss.
SHORT = Params(watermark="1 day", window="1 day")
PARTS, FILES = 4, 4


def fed_late(spark: SparkSession, d: str, root: str) -> DataFrame:
    """The wire events as a stream of PARTS + 2 batches by time, of which every tenth event comes two batches late."""
    w = v.wire(spark, d).join(v.raw_clicks(spark, d).select("event_id", "event_time"), "event_id")
    t = F.expr(f"timestampdiff(SECOND, {EPOCH}, event_time)")
    ends = w.agg(F.min(t).alias("a"), F.max(t).alias("z"))
    part = F.floor((t - F.col("a")) * PARTS / (F.col("z") - F.col("a") + 1)) + F.when(F.col("event_id") % 10 == 3, 2).otherwise(0)
    lines = stored(w.crossJoin(F.broadcast(ends)).select(F.col("value").cast("string").alias("value"), part.alias("part")).filter("value is not null"))
    for i in range(PARTS + 2):  # one after the other, as the source takes files by time
        lines.filter(F.col("part") == i).select("value").repartition(FILES).write.text(f"{root}/in/part={i}")
    return text_events(spark, f"{root}/in/*", FILES).select("value")


def stream_accounting(spark: SparkSession, d: str) -> DataFrame:
    """One row: events that are valid, counted, late and invalid, and what counting missed or had too much."""
    root = shared_folder(spark)
    query = accounting.start_accounted(fed_late(spark, d, root), root, SHORT, once=True)
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))
    n = lambda c: F.count_if(c)
    letters = accounting.dead_letter(spark, root)
    late = F.col("invalid_reason") == accounting.LATE
    counted = accounting.counted(spark, root)
    valid = parse_events(v.wire(spark, d)).filter("is_valid")
    by_product = lambda df: df.groupBy("product_id").agg(F.sum("n").alias("n"))
    told = counted.select("product_id", F.col("event_count").alias("n")).unionByName(parse_events(letters.filter(late).select(F.col("raw_value").alias("value"))).select("product_id", F.lit(1).cast("long").alias("n")))
    off = reconcile(by_product(valid.select("product_id", F.lit(1).cast("long").alias("n"))), by_product(told))
    out = letters.agg(n(late).alias("late"), n(~late).alias("invalid")).crossJoin(counted.agg(F.sum("event_count").alias("counted"))).crossJoin(valid.agg(F.count("*").alias("valid"))).crossJoin(off)
    return out.select("valid", "counted", "late", "invalid", "missing", "extra")


def stream_late_windows(spark: SparkSession, d: str) -> DataFrame:
    """The windows that a stream with late events counts."""
    root = shared_folder(spark)
    accounting.start_accounted(fed_late(spark, d, root), root, SHORT, once=True).awaitTermination()
    return accounting.counted(spark, root).select(_seconds("window_start"), F.col("product_id").cast("long").alias("product_id"), *accounting.SUMS, "score")


# The wire view in SQL: events that survive validation.
_GOOD = f"""(SELECT *, epoch(date_trunc('second', event_time))::BIGINT AS t FROM raw_clicks WHERE event_id % 23 <> 0 AND event_id % 31 <> 0 AND event_id % 29 <> 0 AND event_id % 37 <> 0 AND event_id % 41 <> 0 AND event_type IN ({v.TYPES}))"""
REASON = f"""CASE WHEN event_id % 23 = 0 THEN 'not_json_or_empty' WHEN event_id % 31 = 0 THEN 'unsupported_schema_version:99' WHEN event_id % 29 = 0 THEN 'missing_or_invalid:user_id'
 WHEN event_id % 37 = 0 THEN 'missing_or_invalid:product_id' WHEN event_id % 41 = 0 THEN 'missing_or_invalid:timestamp' WHEN event_type NOT IN ({v.TYPES}) THEN 'unknown_event_type:' || event_type END"""

# Each event's batch, and the newest valid event of the batches before it.
_LATE = f"""WITH ends AS (SELECT min(t) AS a, max(t) AS z FROM (SELECT epoch(date_trunc('second', event_time))::BIGINT AS t FROM raw_clicks)),
dealt AS (SELECT g.*, (t - a) * {PARTS} // (z - a + 1) + CASE WHEN event_id % 10 = 3 THEN 2 ELSE 0 END AS part FROM {_GOOD} g, ends),
seen_before AS (SELECT part, max(max(t)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM dealt GROUP BY part),
judged AS (SELECT d.*, coalesce((t // 86400 + 1) * 86400 <= seen - 86400, FALSE) AS late FROM dealt d JOIN seen_before USING (part))"""

QUERIES = {"stream_trending_days": stream_trending_days, "stream_accounting": stream_accounting, "stream_late_windows": stream_late_windows, "stream_trending": stream_trending, "stream_pairs": stream_pairs, "stream_dead_letter": stream_dead_letter, "stream_sessions": stream_sessions, "stream_dedupe": stream_dedupe}
SQL = {
    "stream_trending": v.sql(f"SELECT t // 86400 * 86400 AS window_start, product_id, count(*) AS event_count, count(*) FILTER (event_type = 'view') AS views, 0::BIGINT AS carts, count(*) FILTER (event_type = 'purchase') AS purchases, round(sum(weight), 3) AS score FROM {_GOOD} GROUP BY 1, 2"),
    "stream_pairs": v.sql(f"""SELECT window_start, unnest([a, b]) AS product_id, unnest([b, a]) AS related_product_id, pair_count, affinity FROM (
  SELECT l.t // 86400 * 86400 AS window_start, l.product_id AS a, r.product_id AS b, count(*) AS pair_count, round(sum(sqrt(l.weight * r.weight)), 3) AS affinity
  FROM {_GOOD} l JOIN {_GOOD} r ON l.user_id = r.user_id AND l.product_id < r.product_id AND abs(l.t - r.t) <= 7200 GROUP BY ALL)"""),
    "stream_sessions": v.sql(f"""SELECT user_id, min(t) AS started, count(*) AS events FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY t, event_id) AS visit FROM (
  SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) <= 1800 THEN 0 ELSE 1 END AS new FROM {_GOOD})) GROUP BY user_id, visit"""),
    "stream_dedupe": v.sql(f"SELECT event_id::VARCHAR AS event_id, user_id FROM {_GOOD}"),
    "stream_trending_days": v.sql(f"SELECT t // 86400 * 86400 AS window_start, product_id, count(*) AS event_count, round(sum(weight), 3) AS score FROM {_GOOD}, (SELECT max(event_time)::DATE AS last_day FROM clicks) WHERE t // 86400 >= epoch(last_day)::BIGINT // 86400 - 6 GROUP BY 1, 2"),
    "stream_accounting": v.sql(f"{_LATE} SELECT count(*) AS valid, count(*) FILTER (NOT late) AS counted, count(*) FILTER (late) AS late, (SELECT count(*) FROM raw_clicks) - count(*) AS invalid, 0 AS missing, 0 AS extra FROM judged"),
    "stream_late_windows": v.sql(f"{_LATE} SELECT t // 86400 * 86400 AS window_start, product_id, count(*) AS event_count, count(*) FILTER (event_type = 'view') AS views, 0::BIGINT AS carts, count(*) FILTER (event_type = 'purchase') AS purchases, round(sum(weight), 3) AS score FROM judged WHERE NOT late GROUP BY 1, 2"),
    "stream_dead_letter": v.sql(f"SELECT invalid_reason, count(*) AS n FROM (SELECT {REASON} AS invalid_reason FROM raw_clicks) WHERE invalid_reason IS NOT NULL GROUP BY 1"),
}
