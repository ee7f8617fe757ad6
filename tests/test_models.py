"""Boosted trees, item vectors, neighbours, pairs of hot keys, alerts, and streams with late events."""

import json
import math
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates, boosted, health, ranking, sessions, vectors
from tidemark.plans import queries
from tidemark.schema import Params
from tidemark.sources.events import text_events
from tidemark.streaming import accounting, jobs

# ---- boosted trees


def ranking_rows(spark, cases, seed, first=0):
    """Cases of ten items; the target is the one whose first two features are both high or both low, which no line separates."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(first, first + cases):
        xs = rng.random((10, 2))
        target = int(np.argmax(np.abs(xs[:, 0] + xs[:, 1] - 1) + rng.normal(0, 0.03, 10)))
        for i, (a, b) in enumerate(xs):
            rows.append((c, c, i, "category", int(i == target), float(a), float(b)))
    df = spark.createDataFrame(rows, "case int, query int, item int, origin string, label int, pair_n double, co_rank double")
    return df.select("case", "query", "item", "origin", "label", *(F.col(f) if f in ("pair_n", "co_rank") else F.lit(0.5).alias(f) for f in ranking.FEATURES))


def first_hits(order, rows):
    top = order.filter("rank = 0").select("query", "item")
    return top.join(rows.filter("label = 1").select("query", "item"), ["query", "item"]).count() / top.count()


def test_trees_beat_a_line_on_cases_held_out(spark):
    train, test = ranking_rows(spark, 300, 1), ranking_rows(spark, 200, 2, 1000)
    model = boosted.train(train, boosted.Boosting(rounds=12, depth=3, rate=0.3, bins=16, least_rows=20), "20240105T000000Z")
    listwise = first_hits(boosted.learned_order(model, test, 3), test)
    pointwise = first_hits(ranking.ranked(ranking.train_ranker(train), test, 3), test)
    assert listwise > 0.6 > 0.5 > pointwise
    order = boosted.learned_order(model, test, 3).collect()
    assert {(r["candidate_from"], r["model_version"]) for r in order} == {("category", "20240105T000000Z")} and {r["rank"] for r in order} == {0, 1, 2}
    assert {r["feature"] for r in boosted.feature_gain(model).collect()} == {"pair_n", "co_rank"}


def test_gradients_are_those_of_the_loss(spark):
    """g is the numeric derivative of the pairs' weighted logistic loss, with the weights held; sums of a case are 0."""
    scores = [0.3, -0.2, 1.1, 0.3, 0.0]
    label = [0, 0, 0, 1, 0]
    df = spark.createDataFrame([(7, i, y, s) for i, (y, s) in enumerate(zip(label, scores, strict=True))], "case int, item int, label int, score double")
    got = {r["item"]: r for r in boosted.lambdas(df).collect()}
    place = {i: p + 1 for p, i in enumerate(sorted(range(5), key=lambda i: (-scores[i], i)))}
    weight = {i: abs(1 / math.log2(1 + place[i]) - 1 / math.log2(1 + place[3])) for i in range(5)}
    loss = lambda s: sum(weight[i] * math.log(1 + math.exp(s[i] - s[3])) for i in range(5) if i != 3)
    for k in range(5):
        e = [1e-5 * (i == k) for i in range(5)]
        up, down = loss([s + d for s, d in zip(scores, e, strict=True)]), loss([s - d for s, d in zip(scores, e, strict=True)])
        assert abs(got[k]["g"] / boosted.UNIT - (up - down) / 2e-5) < 1e-5
        assert abs(got[k]["h"] / boosted.UNIT - (up - 2 * loss(scores) + down) / 1e-10) < 1e-3
    assert sum(r["g"] for r in got.values()) == 0


def test_model_table_scores_as_trained(spark, tmp_path):
    """Saved, loaded and scored row by row; values outside what training saw, and nulls, have a leaf too."""
    rows = ranking_rows(spark, 120, 3)
    p = boosted.Boosting(rounds=3, depth=2, rate=0.5, bins=8, least_rows=10)
    boosted.save_model(boosted.train(rows, p, "20240101T000000Z"), f"{tmp_path}/models")
    boosted.save_model(boosted.train(rows, p, "20240102T000000Z"), f"{tmp_path}/models")
    model = boosted.load_model(spark, f"{tmp_path}/models")
    assert {r["version"] for r in model.collect()} == {"20240102T000000Z"} and boosted.load_model(spark, f"{tmp_path}/models", "20240101T000000Z").count() == model.count()
    nodes = {(r["tree"], r["node"]): r for r in model.collect()}

    def score(r):
        total = 0.0
        for t in range(3):
            n = nodes[t, 0]
            while n["feature"]:
                x = r[n["feature"]]
                cell = math.floor((x - n["low"]) / n["width"]) if x is not None else 0
                n = nodes[t, 2 * n["node"] + (1 if cell <= n["bin"] else 2)]
            total += n["value"]
        return total

    odd = rows.limit(5).withColumn("pair_n", F.lit(9.0)).unionByName(rows.limit(5).withColumn("co_rank", F.lit(-9.0))).unionByName(rows.limit(5).withColumn("pair_n", F.lit(None).cast("double")))
    for r in rows.limit(60).unionByName(odd).withColumn("score", boosted.scorer(model)).collect():
        assert abs(r["score"] - score(r)) < 1e-12


def repeated_cases(spark, cases):
    """(cases, candidates): cases that share eight queries of ten candidates, some with a target that isn't among them."""
    rng = random.Random(5)
    rows = ranking_rows(spark, 8, 5).select("query", "item", "origin", *ranking.FEATURES)
    made = [(f"c{i}", rng.randrange(9), min(rng.randrange(12), rng.randrange(12))) for i in range(cases)]
    return spark.createDataFrame(made, "case string, query int, target int"), rows


def test_lists_train_as_their_cases(spark):
    """One list a query, whose labels count the targets, gives the nodes and gains that all cases give."""
    found, rows = repeated_cases(spark, 400)
    p = boosted.Boosting(rounds=2, depth=2, rate=0.3, bins=16, least_rows=20)
    nodes = lambda rows: sorted(boosted.train(rows, p).collect(), key=lambda r: (r["tree"], r["node"]))
    lists = ranking.training_lists(found, rows)
    got = nodes(lists)
    assert lists.count() == 80 and len(got) > 6
    assert got == nodes(ranking.training_rows(found, rows))


def test_gradients_of_cases_by_query_and_target(spark):
    """Worked out once for a query and target and given to its cases, they are those of each case by itself."""
    found, rows = repeated_cases(spark, 60)
    alone = boosted.lambdas(ranking.training_rows(found, rows).withColumn("score", F.lit(0.5)))
    pairs = boosted.case_lambdas(ranking.training_lists(found, rows).withColumn("score", F.lit(0.5)))
    given = found.join(pairs.withColumnRenamed("case", "query"), ["query", "target"])
    key = lambda df: sorted(map(tuple, df.select("case", "item", "label", "g", "h").collect()))
    assert key(given) == key(alone) and pairs.count() < given.count()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_ranker_model_trains_on_lists(spark, monkeypatch):
    """What the query trains on are the candidates of each query once, though there are more rows of cases, and it counts every case."""
    seen = {}
    monkeypatch.setattr(boosted, "train", lambda rows, p, version: seen.update(rows=rows) or spark.createDataFrame([], boosted.MODEL))
    folder = "/root/testdata/sf0.001"
    queries.QUERIES["ranker_model"](spark, folder)
    lists = seen["rows"].count()
    cases = queries.QUERIES["training_rows"](spark, folder)
    assert lists == cases.select("query", "item").distinct().count() < cases.count()
    assert seen["rows"].agg(F.sum("label")).first()[0] == cases.select("case").distinct().count()


def test_pairs_are_dealt_by_their_number(spark, monkeypatch):
    """Lists are small tables whose work grows with targets times rows: they go to as many tasks as that takes, with the same gradients."""
    found, rows = repeated_cases(spark, 400)
    lists = ranking.training_lists(found, rows).withColumn("score", F.lit(0.5))
    key = lambda df: sorted(map(tuple, df.select("case", "item", "g", "h", "n").collect()))
    one = key(boosted.lambdas(lists, 1))
    targets = {r["case"]: r["k"] for r in lists.groupBy("case").agg(F.count_if(F.col("label") > 0).alias("k")).collect()}
    monkeypatch.setattr(boosted, "PAIRS", 50)
    assert boosted.parts_of(lists) == -(-10 * sum(targets.values()) // 50) > 4
    assert boosted.pulls(lists).rdd.getNumPartitions() == boosted.parts_of(lists)
    assert key(boosted.lambdas(lists)) == one
    assert boosted.parts_of(lists.limit(0)) == 1 and boosted.lambdas(lists.limit(0)).isEmpty()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_ranker_inputs_count_no_users(spark, monkeypatch):
    """Tables written for the ranker have the columns that it reads, so different users, which cost a shuffle of all pairs, are not counted."""
    written = []
    monkeypatch.setattr(queries, "stored", lambda df: written.append(df) or df)
    queries.ranking_inputs(spark, "/root/testdata/sf0.001")
    assert {"pair_count", "window_start"} <= {c for df in written for c in df.columns} and not any("unique_users" in df.columns for df in written)
    assert not any("count(distinct" in df._jdf.queryExecution().optimizedPlan().toString() for df in written)


def test_models_that_do_not_fit(spark):
    rows = ranking_rows(spark, 5, 4)
    empty = boosted.train(rows.limit(0), boosted.Boosting(rounds=2))
    assert empty.count() == 0 and {r["score"] for r in boosted.learned_order(empty, rows).collect()} == {0.0}
    other = spark.createDataFrame([("v", 0, 0, "gone", 0.0, 1.0, 2, 1.0, None), ("v", 0, 1, None, None, None, None, None, 1.0), ("v", 0, 2, None, None, None, None, None, 2.0)], boosted.MODEL)
    with pytest.raises(ValueError, match="gone"):
        boosted.scorer(other)


# ---- vectors


def some_visits(spark):
    rng = random.Random(6)
    lists = [[rng.randrange(8) + 10 * (v % 4) for _ in range(rng.randint(1, 7))] for v in range(300)]
    return spark.createDataFrame([(list(dict.fromkeys(x)),) for x in lists], "items array<long>")


def test_singular_values_equal_numpy(spark):
    entries = vectors.stored(vectors.item_pmi(some_visits(spark)))
    ids = sorted({r["a"] for r in entries.collect()})
    m = np.zeros((len(ids), len(ids)))
    for r in entries.collect():
        m[ids.index(r["a"]), ids.index(r["b"])] = r["value"]
    assert np.allclose(m, m.T)
    found, values = vectors.factorised(entries, size=4, rounds=25, more=6)
    want = np.linalg.svd(m, compute_uv=False)[:4]
    assert np.allclose(values, want, rtol=1e-6)
    v = np.array([r["vector"] for r in found.orderBy("id").collect()])
    assert np.allclose(v.T @ v, np.diag(values), atol=1e-5)  # directions times the roots of their values
    again, _ = vectors.factorised(entries.repartition(5), size=4, rounds=25, more=6)
    assert np.allclose(v, np.array([r["vector"] for r in again.orderBy("id").collect()]), atol=1e-6)


def test_items_seen_together_are_neighbours(spark):
    near = vectors.similar_items(vectors.item_vectors(some_visits(spark), size=8), 3).collect()
    assert sum(r["query"] // 10 == r["item"] // 10 for r in near) >= 0.95 * len(near) > 0
    assert vectors.item_vectors(some_visits(spark).limit(0), size=4).count() == 0


def test_vectors_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [1.0, 0.5])], "id long, vector array<double>")
    vectors.save_vectors(df, f"{tmp_path}/v")
    got = {r["id"]: r["vector"] for r in vectors.load_vectors(spark, f"{tmp_path}/v").collect()}
    assert np.allclose(got[1], [0.6, 0.8]) and got[2] == [0.0, 0.0] and abs(np.linalg.norm(got[3]) - 1) < 1e-6


@pytest.mark.parametrize("clusters", [0, 12])
def test_neighbours_equal_brute_force(spark, clusters, monkeypatch):
    """Many chunks, half of all vectors equal; where vectors are clustered, most pairs of chunks are skipped."""
    monkeypatch.setattr(vectors, "chunk_rows", lambda count: 40)
    rng = np.random.default_rng(clusters)
    v = rng.normal(size=(600, 6)) if not clusters else np.repeat(rng.normal(size=(clusters, 6)), 50, 0) + rng.normal(size=(600, 6)) * 0.02
    if not clusters:
        v[:300] = v[0]
    rows = [(int(7 * i), x.tolist()) for i, x in enumerate(v)]
    found = {}
    got = vectors.similar_items(spark.createDataFrame(rows, "id long, vector array<double>").repartition(3), 5, "id % 3 = 0", found)
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    cos = np.round(unit @ unit.T, 6)
    want = set()
    for i in range(len(v)):
        if 7 * i % 3 == 0:
            order = sorted((j for j in range(len(v)) if j != i), key=lambda j: (-cos[i, j], j))[:5]
            want |= {(7 * i, 7 * j, k) for k, j in enumerate(order)}
    assert {(r["query"], r["item"], r["rank"]) for r in got.collect()} == want
    assert found["met"] < 0.3 * found["pairs"] if clusters else found["pairs"] > 100


def test_only_queries_are_sent_to_chunks(spark, monkeypatch):
    """Few queries, many chunks that nothing rules out: what is shuffled is a few times the vectors, not the vectors times the chunks."""
    monkeypatch.setattr(vectors, "chunk_rows", lambda count: 50)
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(2000, 32)))], "id long, vector array<double>")
    store = spark.sparkContext._jsc.sc().statusStore()

    def shuffled():
        time.sleep(1)  # the store is told with some delay
        found = store.executorList(True)
        return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))

    began, found = shuffled(), {}
    assert vectors.similar_items(rows, 5, "id % 50 = 0", found).count() == 200
    assert found["met"] > 500 and shuffled() - began < 10 * 2000 * 32 * 8


# ---- pairs


def test_hot_session_is_dealt_to_salts(spark):
    """Half of all events in one session and stretch: the pairs are the same, and no salt has more than its share."""
    rng = random.Random(9)
    rows = [("hot" if i % 2 else f"s{i % 40}", i, 1000.0 + rng.random() * (90 if i % 2 else 3000), rng.randrange(12)) for i in range(600)]
    df = spark.createDataFrame(rows, "session_id string, user_id int, at double, product_id int").withColumn("event_time", F.timestamp_seconds(F.floor("at"))).withColumn("weight", F.lit(1.0))
    key = lambda r: (r["low_session"], r["low_user"], r["high_user"])
    plain = sorted(key(r) for r in aggregates.co_views(df, "2 minutes").collect())
    salted = sorted(key(r) for r in aggregates.co_views(df, "2 minutes", stretch_rows=50).collect())
    want = sorted((a[0], a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[3] < b[3] and abs(int(a[2]) - int(b[2])) <= 120)
    assert plain == salted == want
    met = aggregates.nearby(df, ["session_id"], F.lit(0), "at", 50)
    assert "salt" in met._jdf.queryExecution().optimizedPlan().toString()


def test_visit_pairs_equal_brute_force(spark):
    rng = random.Random(10)
    rows = [(v, w, rng.randrange(6), float(rng.randrange(0, 600))) for v in range(3) for w in range(2) for _ in range(40)]
    df = spark.createDataFrame(rows, "visitor int, visit int, item int, at double")
    want = {}
    for a in rows:
        for b in rows:
            if a[:2] == b[:2] and a[2] < b[2] and abs(a[3] - b[3]) <= 60:
                want[a[2], b[2]] = want.get((a[2], b[2]), 0) + 1
    for most in (None, 5):
        assert {(r["item_a"], r["item_b"]): r["n"] for r in sessions.visit_pairs(df, 60, most).collect()} == want


@pytest.mark.parametrize("stretch", [0.7, 5, 60, 100_000])
def test_visits_are_the_same_for_any_stretch(spark, stretch):
    """Visits over many stretches, stretches without a cut, equal times, and a visitor with half of all events."""
    rng = random.Random(12)
    rows = [(rng.choice(["robot", "robot", "robot", "a", "b", "c"]), float(t), rng.randrange(5), i) for i, t in enumerate(sorted(rng.choice([rng.randrange(0, 40_000), 60 * rng.randrange(0, 600)]) for _ in range(500)))]
    want, last = {}, {}
    for v, t, _, i in sorted(rows, key=lambda r: (r[0], r[1], r[3])):
        visit, begun, seq, before = last.get(v, (0, t, -1, None))
        last[v] = (visit, begun, seq + 1, t) if before is not None and t - before <= 120 else (visit + 1, t, 0, t)
        want[i] = last[v][:3]
    df = spark.createDataFrame(rows, "visitor string, at double, item int, event_id int").withColumn("extra", F.lit("x"))
    got = sessions.sessionise(df, 2, stretch)
    assert got.columns == [*df.columns, "visit", "started_at", "seq", "session"]
    assert {r["event_id"]: (r["visit"], r["started_at"], r["seq"]) for r in got.collect()} == want


# ---- alerts


def at(minute):
    return f"2024-03-10 {12 + minute // 60:02d}:{minute % 60:02d}:00"


def counter(spark, values):
    return spark.createDataFrame([(at(i), v) for i, v in enumerate(values)], "recorded_at string, n long").selectExpr("timestamp(recorded_at) recorded_at", "n", "'x' s")


def test_increase_survives_restarts(spark):
    got = health.increase(counter(spark, [5, 5, 9, 0, 0, 2, 2, None, 3]), ["s"], "recorded_at", "n", 180).orderBy("recorded_at").collect()
    assert [r["increase"] for r in got] == [0, 0, 4, 4, 4, 2, 2, 1]
    assert [r["increase"] for r in health.increase(counter(spark, [9, 0]), ["s"], "recorded_at", "n", 300).orderBy("recorded_at").collect()] == [0, 0]


def test_holds_start_anew_after_a_break(spark):
    bad = [True, True, False, True, True, None, True, True, True]
    rows = spark.createDataFrame([(at(i + 30 * (i > 7)), b) for i, b in enumerate(bad)], "recorded_at string, bad boolean").selectExpr("timestamp(recorded_at) recorded_at", "bad", "'x' s")
    got = health.held(rows, ["s"], "recorded_at", "bad", 60).orderBy("recorded_at").collect()
    assert [r["since"] and r["since"].minute for r in got] == [0, 0, None, 3, 3, None, 6, 6, 6]
    assert [r["firing"] for r in got] == [False, True, False, False, True, False, False, True, True]
    assert [r["firing"] for r in health.held(rows, ["s"], "recorded_at", "bad", 60, 120).orderBy("recorded_at").collect()][-1] is False


def test_seven_alerts_with_holds(spark):
    def metrics(minutes, lag, ms, state):
        rows = [("q", at(m), [float(lag(m))], ms(m), [state(m)]) for m in range(minutes)]
        return spark.createDataFrame(rows, "query string, recorded_at string, kafka_lag array<double>, batch_duration_ms long, state_rows array<long>").withColumn("recorded_at", F.to_timestamp("recorded_at"))

    def ranker(minutes, age_days=0, usable=True, fallbacks=lambda m: 0, loaded=True, replay=True):
        rows = [(at(m), loaded, usable, replay, fallbacks(m)) for m in range(minutes)]
        df = spark.createDataFrame(rows, "recorded_at string, loaded boolean, usable boolean, replay_recorded boolean, fallbacks long").withColumn("recorded_at", F.to_timestamp("recorded_at"))
        return df.withColumn("model_at", F.expr(f"timestamp('2024-03-10 12:00:00') - interval {age_days} days"))

    def states(m, r, seconds):
        writes = spark.createDataFrame([(at(10),)], "t string").select(F.to_timestamp("t").alias("updated_at"))
        now = F.timestamp_seconds(F.unix_seconds(F.lit(at(10)).cast("timestamp")) + seconds)
        found = health.alert_states(m, r, writes, now).collect()
        return {x["alert"] for x in found if x["breached"]}, {x["alert"] for x in found if x["firing"]}, len(found)

    calm = metrics(70, lambda m: 0, lambda m: 10, lambda m: 100)
    assert states(calm, ranker(70), 100) == (set(), set(), 7)
    bad = metrics(70, lambda m: 2000 * m, lambda m: 20_000, lambda m: 1000 * m)
    all_but_model = {"lag_growing", "slow_batch", "state_growing", "pipeline_stale"}
    assert states(bad, ranker(70), 181)[1] == all_but_model and states(bad, ranker(70), 150)[1] == all_but_model - {"pipeline_stale"}
    assert states(bad, ranker(70), 150)[0] == all_but_model
    assert states(metrics(4, lambda m: 0, lambda m: 20_000, lambda m: 5), ranker(4), 0)[:2] == ({"slow_batch"}, set())
    old = ranker(70, 8, True, lambda m: m)
    assert states(calm, old, 0)[1] == {"model_stale", "model_falling_back"}
    assert states(calm, ranker(70, 0, True, lambda m: 9 if m < 69 else 0), 0)[0] == set()  # a restart
    assert states(calm, ranker(70, 0, False, lambda m: m), 0)[1] == {"model_unusable"}
    assert states(calm, ranker(70, 0, False, lambda m: m, replay=False), 0)[0] == states(calm, ranker(70, 0, False, lambda m: m, loaded=False), 0)[0] == set()
    assert states(calm.limit(0), old.limit(0), 0)[2] == 1


# ---- late events and state


def lines(rows):
    return [json.dumps({"event_id": f"e{k}", "session_id": s, "user_id": k % 5, "product_id": p, "event_type": "view", "timestamp": t}) for k, (s, p, t) in enumerate(rows)]


def fill(spark, folder, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame([(x,) for x in rows], "value string").coalesce(1).write.text(f"{folder}/in/{i}")
    return text_events(spark, f"{folder}/in/*")


SMALL = Params(watermark="60 seconds", window="1 minute")
BASE = 1_712_000_040.0  # a whole minute


def test_late_events_are_accounted(spark, tmp_path):
    root = f"{tmp_path}/acc"
    on_time, late = [("a", 5, BASE + 10), ("a", 6, BASE + 400)], [("b", 5, BASE + 20), ("b", 5, BASE + 350)]
    batches = [lines(on_time) + ["broken"], lines(late), lines([("c", 7, BASE + 900)])]
    query = accounting.start_accounted(fill(spark, root, batches), root, SMALL, once=True)
    query.awaitTermination()
    assert query.exception() is None
    counts = {(r["product_id"], r["window_start"].timestamp() - BASE): (r["event_count"], r["unique_users"]) for r in accounting.counted(spark, root).collect()}
    # the window of second 20 ended at 60, below 400 - 60; that of second 350 ends at 360
    assert counts == {(5, 0.0): (1, 1), (6, 360.0): (1, 1), (5, 300.0): (1, 1), (7, 900.0): (1, 1)}
    letters = {(r["invalid_reason"], json.loads(r["raw_value"])["timestamp"] if r["raw_value"] != "broken" else None) for r in accounting.dead_letter(spark, root).collect()}
    assert letters == {("not_json_or_empty", None), (accounting.LATE, BASE + 20)}


def test_a_batch_tried_again_counts_once(spark, tmp_path):
    """The last batch's commit is lost, so a restarted query runs it again."""
    import glob
    import os

    root = f"{tmp_path}/again"
    stream = fill(spark, root, [lines([("a", 1, BASE), ("a", 2, BASE + 500)]), lines([("b", 1, BASE + 5), ("b", 2, BASE + 501)])])
    accounting.start_accounted(stream, root, SMALL, once=True).awaitTermination()
    before = sorted(map(str, accounting.counted(spark, root).collect()))
    last = max(glob.glob(f"{root}/checkpoints/accounted/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    for crc in glob.glob(f"{root}/checkpoints/accounted/commits/.*.crc"):
        os.remove(crc)
    accounting.start_accounted(stream, root, SMALL, once=True).awaitTermination()
    assert sorted(map(str, accounting.counted(spark, root).collect())) == before
    assert accounting.dead_letter(spark, root).count() == 1


def test_state_is_read_by_key(spark, tmp_path):
    """One session has most of what the pair query's join holds, and its rows grow batch by batch."""
    root = f"{tmp_path}/state"
    batches = [lines([("busy", p, BASE + 30 * b + p) for p in range(12)] + [(f"quiet{b}", 1, BASE + 30 * b)]) for b in range(3)]
    queries = jobs.start(fill(spark, root, batches), root, Params(watermark="10 minutes", gap="5 minutes"), once=True, only=("pairs",))
    queries["pairs"].awaitTermination()
    checkpoint = f"{root}/checkpoints/pairs"
    assert "symmetricHashJoin" in {r["name"] for r in accounting.state_operators(spark, checkpoint).collect()}
    hot = accounting.hottest_keys(accounting.join_state(spark, checkpoint), 2).collect()
    assert "busy" in hot[0]["key"] and hot[0]["rows"] == 2 * 36 and hot[0]["share"] > 0.9
    growth = accounting.join_state_growth(spark, checkpoint, [0, 1, 2]).first()
    assert growth["rows_first"] == 26 and growth["rows_last"] == 78 and growth["slope"] == 26
