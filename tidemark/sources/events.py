"""Wire events: decoding, version folding, validation, weights; works on tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import event_weight
from tidemark.schema import VERSIONS, WEIGHTS, WIRE


def parse_events(raw: DataFrame) -> DataFrame:
    """Typed events from (value binary or string), with raw_value, invalid_reason, is_valid, event_time, weight."""
    read = raw.select(F.col("value").cast("string").alias("raw_value"))
    # a generator's output stays whole: filters on it don't repeat the decoding for each field they use
    read = read.select("raw_value", F.inline(F.array(F.from_json("raw_value", WIRE))))
    nothing = F.coalesce(*(F.col(f.name).cast("string") for f in WIRE.fields)).isNull()
    folded = read.withColumn("nothing", nothing).withColumns(
        {"schema_version": F.coalesce("schema_version", F.lit(1)), "event_type": F.coalesce("event_type", "action"), "channel": F.coalesce("channel", F.lit("unknown")), "event_time": F.col("timestamp").try_cast("timestamp")}
    )
    reason = F.when(F.col("nothing"), "not_json_or_empty").when(~F.col("schema_version").isin(*VERSIONS), F.concat(F.lit("unsupported_schema_version:"), F.col("schema_version").cast("string")))
    for column in ("user_id", "product_id", "event_type"):
        reason = reason.when(F.col(column).isNull(), f"missing_or_invalid:{column}")
    reason = reason.when(F.col("event_time").isNull(), "missing_or_invalid:timestamp").when(~F.col("event_type").isin(*WEIGHTS), F.concat(F.lit("unknown_event_type:"), F.col("event_type")))
    out = folded.withColumn("invalid_reason", reason).drop("action", "nothing")
    return out.withColumns({"is_valid": F.col("invalid_reason").isNull(), "weight": event_weight(F.col("event_type"))})


def valid_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter("is_valid").drop("raw_value", "invalid_reason")


def invalid_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter("not is_valid").select("raw_value", "invalid_reason", F.current_timestamp().alias("rejected_at"))


def kafka_events(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None) -> DataFrame:
    """The topic as a stream of (value); needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", "earliest").option("failOnDataLoss", "false")
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select("value")


def text_events(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder of JSON-lines files as a stream of (value), some files a trigger, oldest first."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
