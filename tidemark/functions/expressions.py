"""Column expressions: weights, lift and PMI, durations, clocks, lag, array readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import WEIGHTS


def event_weight(event_type: Column) -> Column:
    """What an event counts for; 0 for unknown types."""
    out = F.lit(0.0)
    for name, w in WEIGHTS.items():
        out = F.when(event_type == name, w).otherwise(out)
    return out


def session_key(session_id: Column, user_id: Column) -> Column:
    return F.coalesce(session_id, F.concat(F.lit("u"), user_id.cast("string")))


def lift(pair: Column, a: Column, b: Column, total: Column) -> Column:
    """(pair / total) / ((a / total) * (b / total)); null where it is undefined."""
    total = total.cast("double")
    return F.when((total > 0) & (a > 0) & (b > 0), (pair / total) / ((a / total) * (b / total)))


def pmi(lifted: Column) -> Column:
    return F.when(lifted > 0, F.log2(lifted))


def cart_rate(carts: Column, views: Column) -> Column:
    return (carts + 1) / (views + 20)


def duration_seconds(text: Column) -> Column:
    """Seconds in a text such as '2 minutes'; 0 for anything else."""
    n = F.try_to_number(F.regexp_extract(text, r"^\s*(\d+)", 1), F.lit("999999999"))
    unit = F.regexp_extract(text, r"^\s*\d+\s*(second|minute|hour|day)s?\s*$", 1)
    size = F.when(unit == "second", 1).when(unit == "minute", 60).when(unit == "hour", 3600).when(unit == "day", 86400)
    return F.coalesce((n * size).cast("long"), F.lit(0).cast("long"))


def reclock(at: Column, first: Column, starts_at: float, speedup: float) -> Column:
    """A dataset time on a clock that starts at starts_at and runs speedup times as fast."""
    if speedup <= 0:
        raise ValueError("speedup must be above 0")
    return F.lit(float(starts_at)) + (at - first) / speedup


def visit_id(visitor: Column, started_at: Column) -> Column:
    """'rr-' and 16 hex digits of a hash of visitor and start, rounded half to even."""
    return F.concat(F.lit("rr-"), F.substring(F.sha1(F.concat_ws(":", visitor.cast("string"), F.bround(started_at).cast("long").cast("string"))), 1, 16))


def known_sum(values: Column) -> Column:
    """Sum of an array's known elements; null if none is known."""
    known = F.filter(values, lambda x: x.isNotNull())
    return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda s, x: s + x))


def known_max(values: Column) -> Column:
    return F.array_max(F.filter(values, lambda x: x.isNotNull()))


def offsets_behind(done: Column, latest: Column, topic: str) -> Column:
    """Messages not yet read: sum over partitions of max(latest - done, 0); null if a partition is unknown.

    done is {topic: {partition: offset}} and latest {partition: offset}, both as JSON text.
    """
    d = F.from_json(done, "map<string, map<string, long>>")[topic]
    n = F.from_json(latest, "map<string, long>")
    gaps = F.transform(F.map_entries(n), lambda e: F.greatest(e["value"] - F.try_element_at(d, e["key"]), F.lit(0).cast("long")) + F.try_element_at(d, e["key"]) * 0)
    unknown = F.exists(gaps, lambda g: g.isNull())
    return F.when(d.isNotNull() & n.isNotNull() & ~unknown, F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g))


def model_time(version: Column) -> Column:
    """The time in a model version such as 20240131T235959Z, else null."""
    return F.try_to_timestamp(F.regexp_replace(version, r"^(\d{4})(\d\d)(\d\d)T(\d\d)(\d\d)(\d\d)Z$", "$1-$2-$3 $4:$5:$6"), F.lit("yyyy-MM-dd HH:mm:ss"))


def unit_vector(vector: Column) -> Column:
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    over = lambda n: F.transform(v, lambda x: x / F.when(n == 0, 1.0).otherwise(n))
    return F.get(F.transform(F.array(norm), over), F.lit(0))  # the norm is worked out once a vector, not once a part


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
