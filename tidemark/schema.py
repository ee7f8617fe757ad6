"""Schemas, event weights and parameters that define results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

#: Superset of the two wire versions; version 2 says `action` for `event_type` and adds `channel`.
WIRE = T.StructType(
    [
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("timestamp", T.DoubleType()),
    ]
)
VERSIONS = (1, 2)
# What an event of each type counts for.
WEIGHTS = {"view": 1.0, "search": 0.5, "click": 1.5, "add_to_cart": 3.0, "purchase": 5.0}
# Names of the click log's events.
LOG_EVENTS = {"view": "view", "addtocart": "add_to_cart", "transaction": "purchase"}


@dataclass(frozen=True)
class Params:
    """Settings; durations are Spark interval texts or minutes."""

    watermark: str = "2 minutes"
    window: str = "1 minute"
    slide: str | None = None
    gap: str = "2 minutes"
    trigger: str = "10 seconds"
    lookback_minutes: int = 30
    min_pairs: int = 3
    retention_hours: int = 48
    session_gap_minutes: int = 30
    per_source: int = 30
    two_hop_via: int = 10
    two_hop_each: int = 10
    global_top: int = 10
    absent_rank: int = 99
    recent_share: float = 0.1
