"""Table upkeep: retention, purges, uniqueness, latest row per key, compaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def retained(rows: DataFrame, now: Column, hours: int, at: str = "updated_at") -> DataFrame:
    return rows.filter(F.col(at) >= now - F.expr(f"INTERVAL {hours} HOURS"))


def purged(rows: DataFrame, first: int, last: int, columns: tuple[str, ...]) -> DataFrame:
    """Rows but those with a reserved id (first..last) in one of the columns."""
    hit = F.lit(False)
    for c in columns:
        hit |= F.coalesce(F.col(c).between(first, last), F.lit(False))
    return rows.filter(~hit)


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row; none in a table that upserts keep right."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def latest(rows: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row with the greatest version of each key."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("r")).select(*keys, "r.*")
