"""A stream in which every valid event is either counted or set aside as late, and what is in its state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.schema import Params
from tidemark.shared import path_exists
from tidemark.sources.events import parse_events

LATE = "late:window_closed"
SUMS = ("event_count", "views", "carts", "purchases")


def _mark(spark: SparkSession, root: str, epoch: int) -> DataFrame | None:
    """One row: the newest event time of all batches up to `epoch`."""
    path = f"{root}/marks/epoch={epoch}"
    return spark.read.schema("newest timestamp").parquet(path) if epoch >= 0 and path_exists(spark, f"{path}/_SUCCESS") else None


def sorted_events(batch: DataFrame, newest: Column | None, params: Params) -> DataFrame:
    """Parsed events with outcome: accepted, or rejected with a reason, LATE for those whose windows have all closed.

    A window is closed once its end is no later than the newest event time of earlier batches less the watermark's
    delay, which is when Spark's own windowed aggregation drops rows.
    """
    parsed = parse_events(batch).drop("is_valid")
    if newest is not None:
        last_end = F.window("event_time", params.window).getField("end")
        if params.slide:
            last_end = F.window("event_time", params.slide).getField("start") + F.expr(f"INTERVAL {params.window}")
        # window() keeps rows with a time only, so the others are added again
        timed = parsed.filter("event_time is not null").withColumn("closes", last_end)
        timed = timed.unionByName(parsed.filter("event_time is null").withColumn("closes", F.lit(None).cast("timestamp")))
        late = F.col("invalid_reason").isNull() & (F.col("closes") <= newest - F.expr(f"INTERVAL {params.watermark}"))
        parsed = timed.withColumn("invalid_reason", F.when(late, F.lit(LATE)).otherwise(F.col("invalid_reason"))).drop("closes")
    return parsed.withColumn("outcome", F.when(F.col("invalid_reason").isNull(), "accepted").otherwise("rejected"))


def partial_counts(events: DataFrame, params: Params) -> DataFrame:
    """What a batch adds to each window and product: sums, and a mergeable sketch of its users."""
    w = F.window("event_time", params.window, params.slide) if params.slide else F.window("event_time", params.window)
    kind = lambda t: F.count_if(F.col("event_type") == t)
    g = events.groupBy(w.alias("w"), "product_id").agg(F.count("*").alias("event_count"), F.sum("weight").alias("score"), kind("view").alias("views"), kind("add_to_cart").alias("carts"), kind("purchase").alias("purchases"), F.hll_sketch_agg("user_id").alias("users"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "product_id", *SUMS, "score", "users")


def start_accounted(raw: DataFrame, root: str, params: Params = Params(), once: bool = False) -> StreamingQuery:  # noqa: B008
    """Starts a query over a stream of (value) that sorts each batch into accepted and rejected rows and counts the accepted ones.

    Below `root`, batch N is events/epoch=N (by outcome), counts/epoch=N and marks/epoch=N. All three follow from the batch
    and the mark of the one before, so a batch that is tried again writes the same: valid events are the counted
    and the late ones, whatever failed in between. Counts are added up by counted(); no state store is kept.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = _mark(spark, root, epoch - 1)
        newest = before.first()["newest"] if before is not None else None  # one row
        folder = f"{root}/events/epoch={epoch}"
        sorted_events(batch, F.lit(newest) if newest else None, params).write.mode("overwrite").partitionBy("outcome").parquet(folder)
        found = read_events(spark, root, epoch)
        partial_counts(found.filter("outcome = 'accepted'"), params).write.mode("overwrite").parquet(f"{root}/counts/epoch={epoch}")
        known = F.col("outcome").eqNullSafe("accepted") | (F.col("invalid_reason") == LATE)
        mark = found.filter(known).agg(F.max("event_time").alias("newest")).select(F.greatest("newest", F.lit(newest).cast("timestamp")).alias("newest"))
        mark.write.mode("overwrite").parquet(f"{root}/marks/epoch={epoch}")

    writer = raw.writeStream.queryName("accounted").option("checkpointLocation", f"{root}/checkpoints/accounted").foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=params.trigger)).start()


_EVENTS = "raw_value string, schema_version int, event_id string, session_id string, user_id int, product_id int, event_type string, channel string, timestamp double, event_time timestamp, invalid_reason string, weight double, outcome string"


def read_events(spark: SparkSession, root: str, epoch: int | None = None) -> DataFrame:
    """The sorted events of all batches, or of one; outcome is a partition column."""
    reader = spark.read.schema(_EVENTS)
    return reader.parquet(f"{root}/events/epoch={epoch}") if epoch is not None else reader.option("basePath", f"{root}/events").parquet(f"{root}/events/epoch=*")


def dead_letter(spark: SparkSession, root: str) -> DataFrame:
    """raw_value, invalid_reason, event_time of the rejected rows, late ones among them."""
    return read_events(spark, root).filter("outcome = 'rejected'").select("raw_value", "invalid_reason", "event_time")


def counted(spark: SparkSession, root: str) -> DataFrame:
    """Trending windows added up over all batches, with the number of users estimated from merged sketches."""
    parts = spark.read.option("basePath", f"{root}/counts").parquet(f"{root}/counts/epoch=*")
    g = parts.groupBy("window_start", "window_end", "product_id")
    return g.agg(*(F.sum(c).alias(c) for c in SUMS), F.round(F.sum("score"), 3).alias("score"), F.hll_sketch_estimate(F.hll_union_agg("users")).alias("unique_users"))


# ---- state


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """operator, name, store of the stateful operators that a query's checkpoint holds."""
    m = spark.read.format("state-metadata").load(checkpoint)
    return m.select(F.col("operatorId").alias("operator"), F.col("operatorName").alias("name"), F.col("stateStoreName").alias("store"))


def join_state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """side, key (as JSON), rows: what a stream-stream join holds for each of its keys after a batch, the last one by default."""
    operators = state_operators(spark, checkpoint).filter("name = 'symmetricHashJoin'").select("operator").distinct().collect()  # as many as the plan has joins
    out = None
    for r in operators:
        for side in ("left", "right"):
            reader = spark.read.format("statestore").option("operatorId", r["operator"]).option("joinSide", side)
            if batch is not None:
                reader = reader.option("batchId", batch)
            rows = reader.load(checkpoint).groupBy(F.to_json("key").alias("key")).agg(F.count("*").alias("rows")).select(F.lit(side).alias("side"), "key", "rows")
            out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError(f"no stream-stream join has state in {checkpoint}")
    return out


def hottest_keys(state: DataFrame, limit: int = 10) -> DataFrame:
    """key, rows of both sides, share: the keys with most rows."""
    by_key = state.groupBy("key").agg(F.sum("rows").alias("rows"))
    total = by_key.agg(F.sum("rows").alias("total"))
    return by_key.crossJoin(F.broadcast(total)).select("key", "rows", F.round(F.col("rows") / F.col("total"), 6).alias("share")).orderBy(F.col("rows").desc(), "key").limit(limit)


def join_state_growth(spark: SparkSession, checkpoint: str, batches: list[int]) -> DataFrame:
    """rows_first, rows_last, slope (rows a batch, by least squares) of a join's state over the batches that are read."""
    out = None
    for b in batches:
        n = join_state(spark, checkpoint, b).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).select(F.lit(b).alias("batch"), "rows")
        out = n if out is None else out.unionByName(n)
    return out.agg(F.min_by("rows", "batch").alias("rows_first"), F.max_by("rows", "batch").alias("rows_last"), F.round(F.regr_slope(F.col("rows").cast("double"), F.col("batch").cast("double")), 6).alias("slope"))
