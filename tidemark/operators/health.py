"""Pipeline health from the metrics table: percentiles, rising floors, drain, freshness, alerts, reconciliation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import known_max, known_sum
from tidemark.shared import stored


def nearest_ranks(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """keys, and for each name its share's nearest-rank percentile of `value`, nulls left out; null for keys without a value.

    Equal values are counted first; the different ones are sorted in ranges of (keys, value), however many a key has, and a
    range's first rank comes from the counts of the ranges before it. What remains are the rows that hold a rank.
    """
    counted = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    ranged = stored(counted.repartitionByRange(*keys, value).withColumn("__part", F.spark_partition_id()))
    part = ranged.groupBy(*keys, "__part").agg(F.sum("__n").alias("__rows"))
    of = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("__rows").over(of.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = part.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("__part").alias("__in"), before.alias("__before"), F.sum("__rows").over(of).alias("__total"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys] + [F.col("__part") == F.col("__in")]
    upto = F.sum("__n").over(Window.partitionBy("__part", *keys).orderBy(value))
    r = ranged.withColumn("__upto", upto).join(part, same).withColumn("__upto", F.col("__upto") + F.col("__before"))
    holds = lambda p: (F.greatest(F.ceil(F.lit(p) * F.col("__total")), F.lit(1)) <= F.col("__upto")) & (F.greatest(F.ceil(F.lit(p) * F.col("__total")), F.lit(1)) > F.col("__upto") - F.col("__n"))
    found = r.groupBy(*keys).agg(*(F.max(F.when(holds(p), F.col(value))).alias(name) for name, p in shares.items()))
    every = rows.select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct() if keys else None
    if every is None:
        return found
    return every.join(found, same[:-1], "left").select(*(F.col(f"__{k}").alias(k) for k in keys), *shares)


def percentiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Nearest-rank percentiles, nulls left out."""
    return nearest_ranks(rows, keys, value, shares)


def step_metrics(metrics: DataFrame, keys: list[str]) -> DataFrame:
    m = metrics.withColumns({"lag": known_max(F.col("kafka_lag")), "state": known_sum(F.col("state_rows"))})
    out = m.groupBy(*keys).agg(F.round(F.avg("input_rows"), 3).alias("mean_rows"), F.max("lag").alias("max_lag"), F.max("batch_duration_ms").alias("max_ms"), F.max("state").alias("max_state"))
    half = nearest_ranks(metrics, keys, "batch_duration_ms", {"p50_ms": 0.5})
    half = half.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("p50_ms").cast("long").alias("p50_ms"))
    return out.join(half, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]).select(*keys, "mean_rows", "max_lag", "p50_ms", "max_ms", "max_state")


def rising_floor(samples: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """keys, rising: least of the later half above the greatest of the earlier; null below four; the middle of an odd series counts for neither."""
    w = Window.partitionBy(*keys)
    s = samples.filter(F.col(value).isNotNull()).withColumns({"i": F.row_number().over(w.orderBy(at)), "n": F.count("*").over(w)})
    half = F.floor(F.col("n") / 2)
    g = s.groupBy(*keys).agg(F.max("n").alias("n"), F.max(F.when(F.col("i") <= half, F.col(value))).alias("before"), F.min(F.when(F.col("i") > F.col("n") - half, F.col(value))).alias("after"))
    return g.select(*keys, F.when(F.col("n") >= 4, F.col("after") > F.col("before")).alias("rising"))


def lag_growing(metrics: DataFrame, minutes: float = 5, floor: float = 1000) -> DataFrame:
    """recorded_at, query, growing: least lag of the last minutes above the greatest of those before, and above floor."""
    m = metrics.select("query", "recorded_at", known_max(F.col("kafka_lag")).alias("lag"), F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01', recorded_at)").alias("t"))
    w, s = Window.partitionBy("query").orderBy("t"), int(60 * minutes)
    now, before = F.min("lag").over(w.rangeBetween(1 - s, 0)), F.max("lag").over(w.rangeBetween(1 - 2 * s, -s))
    return m.select("query", "recorded_at", F.coalesce((now > before) & (now > floor), F.lit(False)).alias("growing"))


def state_slope(metrics: DataFrame) -> DataFrame:
    """query, slope: state rows per second by least squares."""
    m = metrics.select("query", known_sum(F.col("state_rows")).alias("rows"), F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01', recorded_at)").cast("double").alias("t"))
    return m.groupBy("query").agg(F.round(F.regr_slope("rows", "t"), 9).alias("slope"))


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """Newest row of each query: batch, rows, greatest known lag, sum of known state rows."""
    last = metrics.groupBy("query").agg(F.max_by(F.struct(*(c for c in metrics.columns if c != "query")), "recorded_at").alias("m")).select("query", "m.*")
    return last.select("query", "recorded_at", "batch_id", "input_rows", "batch_duration_ms", known_max(F.col("kafka_lag")).alias("lag"), known_sum(F.col("state_rows")).alias("state"))


def keeping_up(rising: Column, drain_seconds: Column, trigger_seconds: float, read_rate: Column | None = None, sent_rate: Column | None = None) -> Column:
    """Whether a pipeline keeps up: drains within two triggers and 5 s, reads nine tenths of what is sent, floor not rising; null if unknown."""
    out = F.when(rising.isNull() | drain_seconds.isNull(), F.lit(None).cast("boolean"))
    rate = F.lit(True) if read_rate is None or sent_rate is None else F.coalesce(read_rate >= 0.9 * sent_rate, F.lit(True))
    return out.otherwise((drain_seconds <= 2 * trigger_seconds + 5) & rate & ~rising)


def drain_time(metrics: DataFrame, after: Column, threshold: float, queries: int) -> DataFrame:
    """seconds until the last of `queries` queries had a lag at or below the threshold; null unless all had."""
    m = metrics.withColumn("lag", known_max(F.col("kafka_lag"))).filter((F.col("recorded_at") >= after) & (F.col("lag") <= threshold))
    first = m.groupBy("query").agg(F.min("recorded_at").alias("at"))
    seconds = F.timestamp_diff("SECOND", after, F.max("at"))
    return first.agg(F.when(F.count("*") >= queries, seconds).alias("seconds"), F.count("*").alias("drained"))


def probe_latency(sent: DataFrame, written: DataFrame) -> DataFrame:
    """probes, lost, p50, p95 seconds from send (id, sent_at) to the first write (id, updated_at)."""
    first = written.groupBy("id").agg(F.min("updated_at").alias("seen"))
    j = sent.join(first, "id", "left").withColumn("s", F.expr("timestampdiff(SECOND, sent_at, seen)"))
    counts = j.agg(F.count("*").alias("probes"), F.count_if(F.col("s").isNull()).alias("lost"))
    return counts.crossJoin(F.broadcast(nearest_ranks(j, [], "s", {"p50": 0.5, "p95": 0.95})))


def reconcile(expected: DataFrame, counted: DataFrame) -> DataFrame:
    """missing, extra over products, from (product_id, n) each."""
    j = expected.withColumnRenamed("n", "e").join(counted.withColumnRenamed("n", "c"), "product_id", "full_outer")
    d = F.coalesce("e", F.lit(0)) - F.coalesce("c", F.lit(0))
    return j.agg(F.sum(F.greatest(d, F.lit(0))).alias("missing"), F.sum(F.greatest(-d, F.lit(0))).alias("extra"), F.count_if(d != 0).alias("products_off"))


def minute_gaps(windows: DataFrame, seconds: int = 60) -> DataFrame:
    """Window starts that come more than `seconds` after the one before.

    Days are taken first, so that neighbours meet in one task per day and only each day's first and last
    start is compared over all.
    """
    day = F.date_trunc("DAY", F.col("window_start"))
    d = windows.select("window_start").distinct().withColumn("day", day)
    before = F.lag("window_start").over(Window.partitionBy("day").orderBy("window_start"))
    ends = d.groupBy("day").agg(F.max("window_start").alias("last"))
    ends = ends.select("day", F.lag("last").over(Window.orderBy("day")).alias("day_before"))
    j = d.withColumn("before", before).join(ends, "day").withColumn("before", F.coalesce("before", "day_before"))
    return j.withColumn("gap", F.expr("timestampdiff(SECOND, before, window_start)")).filter(F.col("gap") > seconds).select("before", "window_start", "gap")


def status(trending: DataFrame, now: Column) -> DataFrame:
    """status, window_end, lag_seconds on the newest closed window, staleness_seconds; rows have updated_at."""
    closed = F.max_by(F.struct("window_end", "updated_at"), F.when(F.col("updated_at") >= F.col("window_end"), F.struct("window_end", "updated_at")))
    s = trending.agg(F.max("updated_at").alias("written"), closed.alias("c")).withColumn("now", now)
    stale = F.timestamp_diff("SECOND", F.col("written"), F.col("now"))
    name = F.when(F.col("written").isNull(), "warming_up").when(stale < 120, "ok").otherwise("stale")
    return s.select(name.alias("status"), F.col("c.window_end").alias("window_end"), F.timestamp_diff("SECOND", F.col("c.window_end"), F.col("c.updated_at")).alias("lag_seconds"), stale.alias("staleness_seconds"))


def alerts(latest: DataFrame, slopes: DataFrame, growing: DataFrame, now: Column, slow_ms: float, slope: float, stale_seconds: int = 120) -> DataFrame:
    """query, stale, slow_batch, lag_growing, state_growing from the latest rows, slopes and newest lag verdicts."""
    g = growing.groupBy("query").agg(F.max_by("growing", "recorded_at").alias("lag_growing"))
    j = latest.join(slopes, "query", "left").join(g, "query", "left")
    return j.select("query", (F.timestamp_diff("SECOND", F.col("recorded_at"), now) > stale_seconds).alias("stale"), (F.col("batch_duration_ms") > slow_ms).alias("slow_batch"), F.coalesce("lag_growing", F.lit(False)).alias("lag_growing"), F.coalesce(F.col("slope") > slope, F.lit(False)).alias("state_growing"))


def seconds_of(at: Column) -> Column:
    return F.unix_seconds(at.cast("timestamp"))


def counter_steps(samples: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """samples with step: by how much a counter rose since the sample before; after a restart, where it falls, what it holds. 0 at first."""
    before = F.lag(value, 1).over(Window.partitionBy(*keys).orderBy(at))
    step = F.when(before.isNull(), 0).when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before)
    return samples.filter(F.col(value).isNotNull()).withColumn("step", step)


def increase(samples: DataFrame, keys: list[str], at: str, value: str, seconds: int) -> DataFrame:
    """samples with increase: how much a counter rose in the last `seconds` up to each sample, restarts not counted as falls."""
    recent = Window.partitionBy(*keys).orderBy(seconds_of(F.col(at))).rangeBetween(1 - seconds, 0)
    return counter_steps(samples, keys, at, value).withColumn("increase", F.sum("step").over(recent)).drop("step")


def held(rows: DataFrame, keys: list[str], at: str, breached: str, seconds: int, gap: int | None = None) -> DataFrame:
    """rows with since, when the present stretch of breached rows began, and firing: that is `seconds` ago or more.

    A row that isn't breached (or unknown) ends a stretch, and so do more than `gap` seconds without a row. since is null
    for rows that aren't breached.
    """
    order = Window.partitionBy(*keys).orderBy(at)
    t = seconds_of(F.col(at))
    bad = F.coalesce(F.col(breached), F.lit(False))
    apart = F.lit(False) if gap is None else t - F.lag(t).over(order) > gap
    begins = bad & F.coalesce(~F.lag(bad).over(order) | apart, F.lit(True))
    out = rows.withColumns({"__bad": bad, "__from": F.when(begins, F.col(at))})
    since = F.when(F.col("__bad"), F.last("__from", ignorenulls=True).over(order))
    out = out.withColumn("since", since).drop("__bad", "__from")
    return out.withColumn("firing", F.coalesce(t - seconds_of(F.col("since")) >= seconds, F.lit(False)))


@dataclass(frozen=True)
class AlertRules:
    """Bounds, how far back they look and for how long they must be passed; all times in seconds."""

    stale_after: int = 120
    stale_for: int = 60
    lag_floor: float = 1000
    lag_back: int = 300
    lag_for: int = 120
    slow_ms: float = 10_000
    slow_for: int = 300
    state_slope: float = 5
    state_back: int = 900
    state_for: int = 900
    model_age: int = 7 * 86400
    model_for: int = 3600
    unusable_for: int = 300
    fallback_back: int = 300
    fallback_for: int = 600
    gap: int | None = 300


def alert_states(metrics: DataFrame, ranker: DataFrame, writes: DataFrame, now: Column, rules: AlertRules = AlertRules()) -> DataFrame:  # noqa: B008
    """alert, series, breached, since, firing at each series' newest record: all seven alerts with their hold times.

    metrics is (query, recorded_at, kafka_lag, batch_duration_ms, state_rows), ranker (recorded_at, model_at, loaded, usable,
    replay_recorded, fallbacks) and writes (updated_at). A series without a record has no row; one that is silent
    for longer than rules.gap doesn't carry a stretch over.
    """
    r = rules
    m = metrics.select("query", "recorded_at", "kafka_lag", "batch_duration_ms", known_sum(F.col("state_rows")).alias("rows"), seconds_of(F.col("recorded_at")).alias("t"))
    back = Window.partitionBy("query").orderBy("t").rangeBetween(1 - r.state_back, 0)
    slope = F.regr_slope(F.col("rows").cast("double"), F.col("t").cast("double")).over(back)
    growing = lag_growing(metrics, r.lag_back / 60, r.lag_floor).withColumnRenamed("growing", "breached")
    model = ranker.withColumns({"series": F.lit("ranker"), "age": seconds_of(F.col("recorded_at")) - seconds_of(F.col("model_at"))})
    per_query = lambda df, bad: df.select(F.col("query").alias("series"), "recorded_at", bad.alias("breached"))
    of_model = lambda df, bad: df.select("series", "recorded_at", bad.alias("breached"))
    fell = increase(model, ["series"], "recorded_at", "fallbacks", r.fallback_back)
    found = {
        "lag_growing": (per_query(growing, F.col("breached")), r.lag_for),
        "slow_batch": (per_query(m, F.col("batch_duration_ms") > r.slow_ms), r.slow_for),
        "state_growing": (per_query(m, slope > r.state_slope), r.state_for),
        "model_stale": (of_model(model, F.col("age") > r.model_age), r.model_for),
        "model_unusable": (of_model(model, F.col("loaded") & ~F.col("usable") & F.col("replay_recorded")), r.unusable_for),
        "model_falling_back": (of_model(fell, (F.col("increase") > 0) & F.col("usable")), r.fallback_for),
    }
    # staleness is known between records too: it began stale_after seconds after the last write
    last = writes.agg(F.max("updated_at").alias("w")).filter("w is not null").select(F.lit("pipeline").alias("series"), (seconds_of(now) - seconds_of(F.col("w"))).alias("s"), "w")
    begun = F.col("w") + F.make_dt_interval(secs=F.lit(r.stale_after))
    bad = F.col("s") > r.stale_after
    out = last.select(F.lit("pipeline_stale").alias("alert"), "series", bad.alias("breached"), F.when(bad, begun).alias("since"), (bad & (F.col("s") >= r.stale_after + r.stale_for)).alias("firing"))
    for name, (rows, seconds) in found.items():
        states = held(rows, ["series"], "recorded_at", "breached", seconds, r.gap)
        newest = states.groupBy("series").agg(F.max_by(F.struct("breached", "since", "firing"), "recorded_at").alias("x"))
        out = out.unionByName(newest.select(F.lit(name).alias("alert"), "series", F.coalesce("x.breached", F.lit(False)).alias("breached"), "x.since", "x.firing"))
    return out


def model_alerts(ranker: DataFrame, now: Column, days: float = 7, minutes: float = 5) -> DataFrame:
    """model_stale, unusable, falling_back from rows (recorded_at, model_at, usable, fallbacks) of a ranker, the newest counting, without hold times.

    Stale: the model is older than so many days. Unusable: no model can be used. Falling back: the number of
    fallbacks has risen in the last minutes, restarts left out, although a model can be used. One row; nulls without rows.
    """
    last = lambda c: F.max_by(c, "recorded_at")
    steps = counter_steps(ranker.withColumn("__one", F.lit(0)), ["__one"], "recorded_at", "fallbacks")
    lately = seconds_of(F.col("recorded_at")) >= seconds_of(now) - int(60 * minutes)
    grown = steps.agg(F.coalesce(F.sum(F.when(lately, F.col("step"))), F.lit(0)).alias("grown"))
    r = ranker.agg(last("model_at").alias("model_at"), last("usable").alias("usable")).crossJoin(F.broadcast(grown))
    old = F.timestamp_diff("SECOND", F.col("model_at"), now) > days * 86400
    return r.select(old.alias("model_stale"), (~F.col("usable")).alias("unusable"), ((F.col("grown") > 0) & F.col("usable")).alias("falling_back"))


def last_full_window(rows: DataFrame, now: Column) -> DataFrame:
    return rows.filter(F.col("window_end") <= now).agg(F.max("window_start").alias("window_start"), F.max("window_end").alias("window_end"))
