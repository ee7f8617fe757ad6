"""Structured Streaming jobs: sources, the three queries, keyed Parquet sinks, progress records."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.operators.aggregates import co_occurrence, mirror_pairs, trending
from tidemark.operators.maintain import latest
from tidemark.schema import Params
from tidemark.shared import path_exists, stored
from tidemark.sources.events import invalid_events, parse_events, valid_events

TRENDING_KEYS = ["window_start", "product_id"]
PAIR_KEYS = ["window_start", "product_id", "related_product_id"]


@dataclass(frozen=True)
class KeyedTable:
    """A folder of run=<run>/epoch=<epoch> parts. A batch that is tried again overwrites its own part, and the newest part of a key counts."""

    path: str
    keys: tuple[str, ...]

    def writer(self, run: int = 0, change: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
        def write(batch: DataFrame, epoch: int) -> None:
            change(batch).withColumn("updated_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{self.path}/run={run}/epoch={epoch}")

        return write

    def read(self, spark: SparkSession) -> DataFrame:
        rows = spark.read.option("basePath", self.path).parquet(self.path)
        return latest(rows, list(self.keys), ["run", "epoch"]) if self.keys else rows

    def compact(self, spark: SparkSession, target: str) -> None:
        """The table as one part at a new path; readers are pointed there afterwards."""
        rows = self.read(spark)
        rows.drop("run", "epoch").write.mode("overwrite").parquet(f"{target}/run=0/epoch=0")


@dataclass(frozen=True)
class DayTable:
    """A Parquet table partitioned by the day of `at`, in which a row replaces the one of its keys.

    A batch is written down, joined with the days that it has rows of, and those days are overwritten by Spark's dynamic
    partition overwrite. The keys' values are the same after a batch is tried again. Readers filter `day`.
    """

    path: str
    keys: tuple[str, ...]
    at: str = "window_start"

    def writer(self, change: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
        def write(batch: DataFrame, epoch: int) -> None:
            spark = batch.sparkSession
            new = stored(change(batch).withColumns({"updated_at": F.current_timestamp(), "day": F.to_date(self.at)}))
            days = [r["day"] for r in new.select("day").distinct().collect()]  # days of one batch
            if not days:
                return
            rows = new
            if path_exists(spark, self.path):
                old = spark.read.schema(new.schema).parquet(self.path).filter(F.col("day").isin(days))
                rows = stored(new.unionByName(old.join(new.select(*self.keys), list(self.keys), "left_anti")))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(self.path)

        return write

    def read(self, spark: SparkSession, first: str | None = None, last: str | None = None) -> DataFrame:
        """Rows of the days first..last, both included; other days are not read."""
        rows = spark.read.parquet(self.path)
        for bound, test in ((first, F.col("day").__ge__), (last, F.col("day").__le__)):
            rows = rows if bound is None else rows.filter(test(F.lit(bound).cast("date")))
        return rows.drop("day")


def watermarked(events: DataFrame, delay: str) -> DataFrame:
    return events.withWatermark("event_time", delay)


def deduplicated(events: DataFrame) -> DataFrame:
    """One event per event_id within the watermark (an option; the queries themselves count every event)."""
    return events.dropDuplicatesWithinWatermark(["event_id"])


def start(raw: DataFrame, root: str, params: Params = Params(), run: int = 0, once: bool = False, only: tuple[str, ...] = ("trending", "pairs", "dead_letter"), by_day: bool = False) -> dict[str, StreamingQuery]:  # noqa: B008
    """Starts the trending (update), pairs (append) and dead-letter (append) queries, or some, over a stream of (value).

    by_day writes trending and pairs as DayTables, which suits many batches a day and readers that look back some days.

    Each has its own checkpoint and table below `root`; once=True takes what there is and ends.
    """
    parsed = parse_events(raw)
    events = watermarked(valid_events(parsed), params.watermark)
    plans = {
        "trending": (trending(events, params.window, params.slide), "update", DayTable(f"{root}/trending", tuple(TRENDING_KEYS)).writer() if by_day else KeyedTable(f"{root}/trending", tuple(TRENDING_KEYS)).writer(run)),
        "pairs": (co_occurrence(events, params.gap, params.window), "append", DayTable(f"{root}/pairs", tuple(PAIR_KEYS)).writer(mirror_pairs) if by_day else KeyedTable(f"{root}/pairs", tuple(PAIR_KEYS)).writer(run, mirror_pairs)),
        "dead_letter": (invalid_events(parsed), "append", KeyedTable(f"{root}/dead_letter", ()).writer(run)),
    }
    out = {}
    for name, (plan, mode, write) in ((n, plans[n]) for n in only):
        writer = plan.writeStream.outputMode(mode).queryName(name).option("checkpointLocation", f"{root}/checkpoints/{name}").foreachBatch(write)
        out[name] = (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=params.trigger)).start()
    return out


def state_settings() -> dict[str, str]:
    """Session settings for large state: RocksDB with changelog checkpoints."""
    prefix = "spark.sql.streaming.stateStore"
    return {f"{prefix}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", f"{prefix}.rocksdb.changelogCheckpointing.enabled": "true"}


def emission_delay_minutes(window: float, gap: float, watermark: float) -> float:
    """How long after its first event a closed pair window comes out, at most."""
    return window + gap + watermark


def flush_events(after: float, minutes: int, product: int = -1) -> list[str]:
    """JSON events past the end, one a minute, each in a session of its own, that close all windows; purge their product afterwards."""
    return [json.dumps({"event_id": f"flush-{i}", "session_id": f"flush-{i}", "user_id": -1, "product_id": product, "event_type": "view", "timestamp": after + 60 * i}) for i in range(1, minutes + 1)]


class ProgressRecorder(StreamingQueryListener):
    """Appends a row for each micro-batch to a Parquet table; unknown lag and state are null, not 0."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        lag = []
        for s in p.sources:
            try:
                lag.append(float(dict(s.metrics or {}).get("maxOffsetsBehindLatest")))
            except (TypeError, ValueError):
                lag.append(None)
        row = (p.timestamp, p.name, p.batchId, p.numInputRows, p.inputRowsPerSecond, p.processedRowsPerSecond, p.batchDuration, [s.numRowsTotal for s in p.stateOperators], lag)
        kinds = "recorded_at string, query string, batch_id long, input_rows long, input_rows_per_second double, processed_rows_per_second double, batch_duration_ms long, state_rows array<long>, kafka_lag array<double>"
        self.spark.createDataFrame([row], kinds).withColumn("recorded_at", F.to_timestamp("recorded_at")).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
