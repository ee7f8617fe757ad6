"""Golden cases of single operators."""

import inspect
import json
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import expressions as x
from tidemark.operators import aggregates, evaluation, health, maintain, ranking, related, sessions, vectors
from tidemark.plans import queries
from tidemark.schema import Params
from tidemark.sources import click_log
from tidemark.sources.events import invalid_events, kafka_events, parse_events, text_events, valid_events
from tidemark.streaming import jobs

T0 = 1_709_251_200.0


def wire(spark, *events):
    lines = [(e if isinstance(e, str) else json.dumps(e),) for e in events]
    return spark.createDataFrame(lines, "value string").select(F.col("value").cast("binary").alias("value"))


def event(user, product, at=0.0, kind="view", session=None, **more):
    e = {"user_id": user, "product_id": product, "event_type": kind, "timestamp": T0 + at} | more
    return e | ({"session_id": session} if session else {})


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_reasons_in_order(spark):
    lines = {
        "[1, 2": "not_json_or_empty", "": "not_json_or_empty", '{"unrelated": true}': "not_json_or_empty",
        json.dumps(event(None, None, kind="?", schema_version=7)): "unsupported_schema_version:7",
        json.dumps(event(None, None, kind="?")): "missing_or_invalid:user_id", json.dumps(event(44, None, kind="?")): "missing_or_invalid:product_id",
        '{"user_id":44,"product_id":8,"event_type":"?","timestamp":"NaN"}': "missing_or_invalid:timestamp", json.dumps(event(44, 8, kind="?")): "unknown_event_type:?", json.dumps(event(44, 8)): None,
    }
    p = parse_events(wire(spark, *lines))
    assert {bytes(r["raw_value"]).decode(): r["invalid_reason"] for r in p.select(F.col("raw_value").cast("binary").alias("raw_value"), "invalid_reason").collect()} == lines
    assert invalid_events(p).columns == ["raw_value", "invalid_reason", "rejected_at"]


def test_versions_fold(spark):
    v2 = {"schema_version": 2, "user_id": 1, "product_id": 2, "action": "purchase", "channel": "android", "timestamp": T0}
    got = valid_events(parse_events(wire(spark, event(1, 2), v2))).select("schema_version", "event_type", "channel", "weight").collect()
    assert [tuple(r) for r in got] == [(1, "view", "unknown", 1.0), (2, "purchase", "android", 5.0)]


def test_trending_counts(spark):
    kinds = ("view", "purchase", "add_to_cart", "view", "view", "purchase", "view")
    e = [event(70 + i % 3, 12, 40 * i, k) for i, k in enumerate(kinds)] + [event(70, 13, 601)]
    got = {r["product_id"]: r for r in aggregates.trending(valid_events(parse_events(wire(spark, *e))), "1 hour", exact=True).collect()}
    assert [got[12][c] for c in ("event_count", "unique_users", "views", "carts", "purchases", "score")] == [7, 3, 4, 1, 2, 17.0] and got[13]["event_count"] == 1


def test_pairs_and_mirror(spark):
    """Two visitors see both products within five minutes, a third just too late, and a fourth exactly in time over a bound of stretches."""
    e = [event(71, 20, 10), event(71, 21, 200, "purchase"), event(72, 21, 50), event(72, 20, 349), event(73, 20, 0), event(73, 21, 301), event(74, 20, 290), event(74, 21, 590)]
    pairs = aggregates.co_occurrence(valid_events(parse_events(wire(spark, *e))), "5 MINUTES", "1 day", exact=True)
    r = pairs.first()
    assert pairs.count() == 1 and (r["product_id"], r["related_product_id"], r["pair_count"], r["unique_users"]) == (20, 21, 3, 3)
    assert r["affinity"] == round(math.sqrt(5) + 2, 3)
    assert {(x["product_id"], x["related_product_id"]) for x in aggregates.mirror_pairs(pairs).collect()} == {(20, 21), (21, 20)}


def test_pairs_meet_by_stretch(spark):
    plan = aggregates.co_views(valid_events(parse_events(wire(spark, event(1, 2)))), "5 MINUTES")._jdf.queryExecution().optimizedPlan().toString()
    assert "stretch" in plan.split("Join Inner, ")[1].split("\n")[0]


def test_sessions_keep_pairs_apart(spark):
    e = [event(1, 5, 0, session="a"), event(1, 6, 1, session="b"), event(2, 7, 0, session="c"), event(2, 8, 1, session="c")]
    got = aggregates.co_occurrence(valid_events(parse_events(wire(spark, *e)))).collect()
    assert [(r["product_id"], r["related_product_id"]) for r in got] == [(7, 8)]


@pytest.mark.parametrize("args, want", [((100, 1000, 1000, 10000), 1.0), ((5, 0, 100, 1000), None), ((5, 10, 10, 0), None)])
def test_lift(spark, args, want):
    got = value(spark, x.lift(*(F.lit(a) for a in args)))
    assert got is None if want is None else got == pytest.approx(want)


def test_undefined_scores_rank_last(spark):
    pairs = spark.createDataFrame([(1, 2, 9.0, 5, 1), (1, 3, 1.0, 5, 1)], "product_id long, related_product_id long, affinity double, pair_count long, peak_users_per_window long")
    counts = spark.createDataFrame([(1, 10, 100), (3, 10, 100)], "product_id long, events long, total long")
    got = related.related(pairs, counts, "lift").orderBy("rank").collect()
    assert [(r["related_product_id"], r["undefined"]) for r in got] == [(3, False), (2, True)]


def test_two_hop_scores(spark):
    near = spark.createDataFrame([(1, 2, 5.0), (1, 3, 2.0), (2, 4, 3.0), (3, 4, 4.0), (2, 1, 5.0)], "query long, item long, n double")
    assert {(r["item"], r["score"]) for r in ranking.two_hop(near).filter("query = 1").collect()} == {(4, 23.0)}


def test_sessionise_gap_is_strict(spark):
    log = spark.createDataFrame([(1, 0.0, 10, "view", 1), (1, 1800.0, 20, "view", 2), (1, 3601.0, 30, "view", 3), (2, 0.0, 10, "view", 4)], "visitor long, at double, item long, event_type string, event_id long")
    v = sessions.sessionise(log)
    assert {(r["event_id"], r["visit"], r["seq"]) for r in v.collect()} == {(1, 1, 0), (2, 1, 1), (3, 2, 0), (4, 1, 0)}
    c = sessions.test_cases(sessions.visit_items(v)).collect()
    assert [(r["query"], r["target"], r["later"]) for r in c] == [(10, 20, [20])]


def test_hits_count_no_answer_as_a_miss(spark):
    cases = spark.createDataFrame([("a", 10, 20, [20, 30]), ("b", 11, 21, [21])], "case string, query long, target long, later array<long>")
    answers = spark.createDataFrame([(10, 10, 0), (10, 30, 1)], "query long, item long, rank int")
    r = evaluation.hit_rate(evaluation.hits(cases, answers, 1), "m").first()
    assert (r["cases"], r["hit"], r["any_hit"], r["answered"]) == (2, 0.0, 0.5, 0.5)


def test_bootstrap_covers_the_mean(spark):
    a = spark.range(200).select(F.col("id").cast("string").alias("case"), (F.col("id") % 2 == 0).alias("hit"))
    b = a.withColumn("hit", F.lit(False))
    r = evaluation.paired_bootstrap(a, b, 200).first()
    assert r["mean"] == 0.5 and 0.38 < r["low"] < 0.5 < r["high"] < 0.62


@pytest.mark.parametrize("series, want", [([1, 9, 2, 8, 1, 9], False), ([1, 2, 3, 4, 5], True), ([1, 2, 3], None)])
def test_rising_floor(spark, series, want):
    s = spark.createDataFrame([("q", i, float(v)) for i, v in enumerate(series)], "query string, at int, v double")
    assert health.rising_floor(s, ["query"], "at", "v").first()["rising"] is want


def test_nearest_rank(spark):
    s = spark.range(1, 21).withColumn("k", F.lit(1))
    assert health.percentiles(s, ["k"], "id", {"p95": 0.95}).first()["p95"] == 19


@pytest.mark.parametrize("done, want", [('{"clickstream":{"0":4,"1":7,"2":3}}', 8.0), ('{"clickstream":{"0":10,"1":7,"2":9}}', 0.0), ('{"clickstream":{"0":4}}', None), (None, None)])
def test_offsets(spark, done, want):
    assert value(spark, x.offsets_behind(F.lit(done).cast("string"), F.lit('{"0":10,"1":7,"2":5}'), "clickstream")) == want


@pytest.mark.parametrize("text, want", [("2 minutes", 120), ("10 seconds", 10), ("1 hour", 3600), ("soon", 0), ("", 0)])
def test_durations(spark, text, want):
    assert value(spark, x.duration_seconds(F.lit(text))) == want


def test_log_reader_refuses_missing_columns(spark, tmp_path):
    (tmp_path / "log.csv").write_text("timestamp,visitorid\n1,2\n")
    with pytest.raises(ValueError, match="event"):
        click_log.read_csv(spark, str(tmp_path / "log.csv"), click_log.EVENT_COLUMNS)


def test_manifest_guard(spark):
    runs = spark.createDataFrame([("2015-06-01", 10.0, 1), ("2015-06-01", 30.0, 2)], "start_day string, days double, finished_at int")
    assert evaluation.window_mismatch(runs, "2015-06-01", 30.0) is None
    assert "30.0 days" in evaluation.window_mismatch(runs, "2015-06-01", 2.0)
    assert evaluation.window_mismatch(runs.limit(0), "x", 1) is None


def test_keyed_table_is_idempotent(spark, tmp_path):
    table = jobs.KeyedTable(str(tmp_path / "t"), ("k",))
    rows = lambda *r: spark.createDataFrame(r, "k long, v long")
    write = table.writer()
    write(rows((1, 1), (2, 1)), 0)
    write(rows((1, 5)), 1)
    write(rows((1, 6)), 1)  # the same batch again
    assert {(r["k"], r["v"]) for r in table.read(spark).collect()} == {(1, 6), (2, 1)}
    table.compact(spark, str(tmp_path / "u"))
    assert jobs.KeyedTable(str(tmp_path / "u"), ("k",)).read(spark).count() == 2
    assert maintain.repeated_keys(table.read(spark), ["k"]).count() == 0


def test_pair_state_is_given_back(spark, tmp_path):
    """Shoppers come in waves an hour apart; what a wave leaves in state goes with the next ones, and all but the last wave's pairs are out."""
    folder = tmp_path / "waves"
    folder.mkdir()
    events = jobs.watermarked(valid_events(parse_events(text_events(spark, str(folder)))), "90 seconds")
    sink = aggregates.co_occurrence(events, "3 MINUTES", "15 minutes").writeStream.format("memory").queryName("wave_pairs").outputMode("append")
    stream = sink.option("checkpointLocation", str(tmp_path / "kept")).start()
    held, baskets = [], {"tea": (31, 58), "ink": (58, 44), "all": (31, 44, 58)}
    try:
        for wave in range(6):
            rows = [event(100 * wave + n, p, 3600 * wave + 37 * k, session=f"{name}{wave}") for n, (name, items) in enumerate(baskets.items()) for k, p in enumerate(items)]
            (folder / f"wave-{wave}.json").write_text("\n".join(map(json.dumps, rows)))
            stream.processAllAvailable()
            held.append(sum(o.numRowsTotal for o in stream.lastProgress.stateOperators))
    finally:
        stream.stop()
    got = {}
    for r in spark.table("wave_pairs").collect():
        pair = (r["product_id"], r["related_product_id"])
        got[pair] = got.get(pair, 0) + r["pair_count"]
    assert got == {(31, 58): 10, (44, 58): 10, (31, 44): 5}
    assert max(held[2:]) <= max(held[:2])


def test_files_of_a_batch_are_bounded(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.json").write_text(json.dumps(event(1, i)))
    q = text_events(spark, str(tmp_path), 2).writeStream.format("memory").queryName("bounded_out").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == [2, 2, 1]


def test_kafka_options():
    """The connector isn't here; what it is asked for is."""

    class Reader:
        def __init__(self):
            self.readStream, self.given = self, {}

        def format(self, name):
            self.given["format"] = name
            return self

        def option(self, key, value):
            self.given[key] = value
            return self

        def load(self):
            return self

        def select(self, *columns):
            return self.given | {"columns": columns}

    plain = {"format": "kafka", "kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "earliest", "failOnDataLoss": "false", "columns": ("value",)}
    assert kafka_events(Reader(), "b:1", "t") == plain
    assert kafka_events(Reader(), "b:1", "t", 500) == plain | {"maxOffsetsPerTrigger": 500}


def test_day_table(spark, tmp_path):
    """A batch again changes nothing, a key's later row replaces it, and readers open only the days they ask for."""
    t = jobs.DayTable(str(tmp_path / "days"), ("window_start", "k"))
    rows = lambda *r: spark.createDataFrame(r, "w string, k long, v long").select(F.to_timestamp("w").alias("window_start"), "k", "v")
    first, second = rows(("2024-05-01 01:00:00", 1, 1), ("2024-05-02 01:00:00", 1, 2), ("2024-05-02 01:00:00", 2, 3)), rows(("2024-05-02 01:00:00", 1, 9), ("2024-05-03 01:00:00", 1, 4))
    write = t.writer()
    got = lambda *days: {(str(r["window_start"]), r["k"], r["v"]) for r in t.read(spark, *days).collect()}
    want = {("2024-05-01 01:00:00", 1, 1), ("2024-05-02 01:00:00", 1, 9), ("2024-05-02 01:00:00", 2, 3), ("2024-05-03 01:00:00", 1, 4)}
    write(first, 0)
    write(second, 1)
    assert got() == want
    write(second, 1)
    write(rows(), 2)
    assert got() == want and got("2024-05-02", "2024-05-02") == {x for x in want if x[0].startswith("2024-05-02")}
    plan = t.read(spark, "2024-05-03")._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_ranks_of_a_key_with_many_values(spark):
    """Ten million different values of one key are sorted in several ranges; keys that are null, or have nulls alone, have a row."""
    big = spark.range(10_000_000).select(F.lit("big").alias("k"), (F.col("id") * 7919 % 10_000_019).alias("x"))
    small = spark.createDataFrame([("s", 3), ("s", 1), ("s", None), (None, 5), ("none", None)], "k string, x long")
    got = {r["k"]: (r["half"], r["most"]) for r in health.nearest_ranks(big.unionByName(small), ["k"], "x", {"half": 0.5, "most": 0.99}).collect()}
    values = (np.arange(10_000_000) * 7919) % 10_000_019
    want = np.partition(values, [4_999_999, 9_899_999])
    assert got == {"big": (want[4_999_999], want[9_899_999]), "s": (1, 3), None: (5, 5), "none": (None, None)}


def test_late_events_are_dropped(spark, tmp_path):
    """With RocksDB state: an event below the watermark changes nothing, one above it counts; repeats of an id count once; progress is recorded."""
    source, before = tmp_path / "in", {k: spark.conf.get(k, None) for k in jobs.state_settings()}
    source.mkdir()
    for k, v in jobs.state_settings().items():
        spark.conf.set(k, v)
    recorder = jobs.ProgressRecorder(spark, str(tmp_path / "progress"))
    spark.streams.addListener(recorder)
    events = jobs.deduplicated(jobs.watermarked(valid_events(parse_events(text_events(spark, str(source)))), "1 minute"))
    plan = aggregates.trending(events, "1 minute")
    q = plan.writeStream.format("memory").queryName("late_out").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).start()
    at = lambda second, i: json.dumps(event(5, 30, second, event_id=i))
    try:
        for n, lines in enumerate(([at(0, "a"), at(5, "b"), at(5, "b")], [at(600, "c")], [at(10, "too-late"), at(545, "in-time"), at(600, "c")])):
            (source / f"{n}.json").write_text("\n".join(lines))
            q.processAllAvailable()
        recorded = lambda: spark.read.schema("input_rows long, query string").parquet(str(tmp_path / "progress")).agg(F.sum("input_rows")).first()[0]
        for _ in range(60):  # the listener is told later
            if (tmp_path / "progress").exists() and recorded() == 7:
                break
            time.sleep(0.5)
        provider = q.lastProgress.stateOperators[0].customMetrics
    finally:
        q.stop()
        spark.streams.removeListener(recorder)
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)
    counts = {}
    for r in spark.sql("SELECT window_start, event_count FROM late_out").collect():
        counts[r["window_start"]] = max(r["event_count"], counts.get(r["window_start"], 0))
    assert sorted(counts.values()) == [1, 1, 2] and any("rocksdb" in k for k in provider)
    written = spark.read.parquet(str(tmp_path / "progress"))
    assert written.agg(F.sum("input_rows")).first()[0] == 7 and written.filter("query = 'late_out'").count() == written.count()


def test_fallback_says_why(spark):
    answers = lambda *r: spark.createDataFrame(r, "query long, item long, rank int")
    queries = spark.createDataFrame([(1,), (2,)], "query long")
    learned, affinity = answers((1, 5, 0), (9, 5, 0)), answers((1, 6, 0), (2, 7, 0), (2, 8, 1))
    seen = lambda df: sorted(tuple(r) for r in df.collect())
    assert [r[3] for r in seen(ranking.with_fallback(queries, learned, affinity))] == ["learned", "affinity", "affinity"]
    out = seen(ranking.with_fallback(queries, learned, affinity, "feature list differs"))
    assert [r[:2] for r in out] == [(1, 6), (2, 7), (2, 8)] and {r[3:] for r in out} == {("affinity", "feature list differs")}


def test_model_alerts(spark):
    rows = lambda *r: spark.createDataFrame(r, "recorded_at string, model_at string, usable boolean, fallbacks long").selectExpr("timestamp(recorded_at) recorded_at", "timestamp(model_at) model_at", "usable", "fallbacks")
    now = F.lit("2024-03-10 12:00:00").cast("timestamp")
    found = lambda *r: tuple(health.model_alerts(rows(*r), now).first())
    assert found(("2024-03-10 11:00:00", "2024-03-01 00:00:00", True, 3), ("2024-03-10 11:59:00", "2024-03-09 00:00:00", True, 9)) == (False, False, True)  # since the record before
    assert found(("2024-03-10 11:57:00", "2024-03-09 00:00:00", True, 9), ("2024-03-10 11:59:00", "2024-03-09 00:00:00", True, 0)) == (False, False, False)  # a restart
    assert found(("2024-03-10 11:57:00", "2024-03-01 00:00:00", True, 3), ("2024-03-10 11:59:00", "2024-03-01 00:00:00", True, 4)) == (True, False, True)
    assert found(("2024-03-10 11:57:00", None, False, 3), ("2024-03-10 11:59:00", None, False, 4)) == (None, True, False)


def test_manifest_and_export(spark, tmp_path):
    for day, finished in (("2015-06-01", "2024-01-01T00:00:00"), ("2015-07-01", "2024-01-02T00:00:00")):
        click_log.append_run(spark, str(tmp_path / "runs"), day, 30, finished)
    runs = spark.read.parquet(str(tmp_path / "runs"))
    assert runs.count() == 2 and click_log.newest_first(runs).first()["start_day"] == "2015-07-01"
    for kind in ("csv", "json"):
        click_log.write_summary(runs, str(tmp_path / kind), kind)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == spark.read.json(str(tmp_path / "json")).count() == 2


@pytest.mark.parametrize("args", [(10, 6, 10), (10, 0, 4)])
def test_answers_that_show_a_wrong_set_up(args):
    evaluation.check_answers(10, 5, 5)
    with pytest.raises(ValueError, match="of 10 queries"):
        evaluation.check_answers(*args)


def test_emission_delay():
    p = Params()
    assert jobs.emission_delay_minutes(1, 2, 2) == 5 and p.min_pairs == 3


@pytest.mark.parametrize("name, module, operator, want", [("item2vec", vectors, "item_vectors", {"size": 64, "window": 5}), ("bootstrap", evaluation, "paired_bootstrap", {"draws": 1000})])
def test_registered_at_full_size(spark, monkeypatch, name, module, operator, want):
    class Called(Exception):
        pass

    signature = inspect.signature(getattr(module, operator))

    def called(*a, **b):
        bound = signature.bind(*a, **b)
        bound.apply_defaults()
        raise Called(bound.arguments)

    monkeypatch.setattr(module, operator, called)
    with pytest.raises(Called) as found:
        queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert want.items() <= found.value.args[0].items()
