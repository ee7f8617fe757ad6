"""Registered queries of the engine over the given tables, each beside its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import expressions as x
from tidemark.operators import aggregates as a
from tidemark.operators import boosted as b
from tidemark.operators import evaluation as e
from tidemark.operators import health as h
from tidemark.operators import maintain, sessions
from tidemark.operators import ranking as r
from tidemark.operators import related as rel
from tidemark.operators import vectors as vec
from tidemark.plans import stream_queries
from tidemark.plans import views as v
from tidemark.plans.views import sql
from tidemark.shared import stored, together
from tidemark.sources import click_log
from tidemark.sources.events import invalid_events, parse_events, valid_events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
LIMIT = 10


def query(oracle: str | None, more: str = ""):
    def add(f):
        name = f.__name__.removeprefix("q_")
        QUERIES[name] = f
        if oracle:
            SQL[name] = sql(oracle, more)
        return f

    return add


def lookback(rows: DataFrame):
    return a.back(a.newest_end(rows), v.LOOKBACK)


def visits(s, d, gap=v.VISIT_GAP):
    return sessions.sessionise(v.log(s, d), gap)


def cases(s, d):
    return sessions.test_cases(sessions.visit_items(visits(s, d))).withColumn("case", F.concat_ws("-", "visitor", "visit"))


# ---- sources and table upkeep

@query("SELECT try_cast(vid AS BIGINT) AS visitor, item, CASE event_type WHEN 'click' THEN 'add_to_cart' ELSE event_type END AS event_type, at FROM (SELECT CASE WHEN event_id % 50 = 0 THEN 'x' ELSE user_id::VARCHAR END AS vid, product_id AS item, event_type, epoch(date_trunc('second', event_time))::BIGINT::DOUBLE AS at FROM raw_clicks) WHERE vid <> 'x' AND event_type IN ('view', 'click', 'purchase')")
def q_normalise_log(s, d):
    return click_log.normalise_log(v.log_csv(s, d))


@query("SELECT min(at) AS first_at, max(at) AS last_at FROM log")
def q_time_span(s, d):
    return click_log.time_span(v.log(s, d))


@query("SELECT item, arg_max(value, (at, -value)) AS value FROM (SELECT l_partkey AS item, epoch(l_shipdate)::BIGINT AS at, l_suppkey AS value FROM lineitem) GROUP BY 1")
def q_latest_property(s, d):
    p = v.table(s, d, "lineitem").select(F.col("l_partkey").alias("item"), F.col("l_shipdate").alias("at"), F.lit("categoryid").alias("property"), F.col("l_suppkey").alias("value"))
    return click_log.latest_property(p)


@query("""SELECT id, 'Item ' || id AS name, NULL::BIGINT AS price, coalesce('cat-' || c, 'uncategorised') AS category FROM (SELECT DISTINCT l_suppkey AS id FROM lineitem)
LEFT JOIN (SELECT s_suppkey AS id, s_nationkey AS c FROM supplier WHERE s_acctbal > 0) USING (id)""")
def q_build_catalog(s, d):
    items = v.table(s, d, "lineitem").select(F.col("l_suppkey").alias("item"))
    known = v.table(s, d, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("item"), F.col("s_nationkey").alias("value"))
    return click_log.build_catalog(items, known)


@query("SELECT DISTINCT product_id AS id FROM raw_clicks WHERE product_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def q_catalog_gap(s, d):
    return click_log.catalog_gap(v.raw_clicks(s, d).select(F.col("product_id").alias("item")), v.table(s, d, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("id")))


@query("""SELECT 'repeated_id' AS problem, (SELECT count(*) FROM (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)) AS n UNION ALL
SELECT 'missing_value', (SELECT count(*) FROM lineitem WHERE l_returnflag = 'N')""")
def q_catalog_dupes(s, d):
    c = v.table(s, d, "lineitem").select(F.col("l_suppkey").alias("id"), F.lit("x").alias("name"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("category"))
    return click_log.catalog_problems(c)


@query("SELECT 'cat-' || n_nationkey AS category, CASE WHEN n_regionkey > 0 THEN 'cat-' || n_regionkey END AS parent FROM nation")
def q_category_tree(s, d):
    n = v.table(s, d, "nation").select(F.col("n_nationkey").cast("string").alias("categoryid"), F.when(F.col("n_regionkey") > 0, F.col("n_regionkey").cast("string")).otherwise(" ").alias("parentid"))
    return click_log.category_tree(n)


@query("SELECT vec_id AS id, round(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y * y))), 6) AS norm, round(embedding[1] / sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y * y))), 6) AS first FROM embeddings")
def q_unit_vectors(s, d):
    t = v.table(s, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    u, raw = x.unit_vector(F.col("embedding")), F.transform("embedding", lambda y: y.cast("double"))
    return t.select("id", F.round(F.sqrt(x.dot(raw, raw)), 6).alias("norm"), F.round(u[0], 6).alias("first"))


@query("SELECT product_id, window_start FROM written, (SELECT max(updated_at) AS now FROM written) WHERE updated_at >= now - INTERVAL 48 HOUR")
def q_retention_filter(s, d):
    w = v.written_trending(s, d)
    return maintain.retained(w, w.agg(F.max("updated_at")).scalar(), 48).select("product_id", "window_start")


@query("SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q_key_uniqueness(s, d):
    return maintain.repeated_keys(v.table(s, d, "lineitem"), ["l_orderkey", "l_suppkey"])


@query("SELECT window_start, product_id, related_product_id, pair_count FROM pairs WHERE product_id NOT BETWEEN 90 AND 95 AND related_product_id NOT BETWEEN 90 AND 95")
def q_purge_reserved(s, d):
    return maintain.purged(v.pair_table(s, d), 90, 95, ("product_id", "related_product_id")).select("window_start", "product_id", "related_product_id", "pair_count")


@query("SELECT 'events' AS name, count(*) AS n, count(*) >= 1000 AS ok FROM events UNION ALL SELECT 'nation', count(*), FALSE FROM nation UNION ALL SELECT 'region', count(*), FALSE FROM region")
def q_dq_rowcounts(s, d):
    t = {n: v.table(s, d, n) for n in ("events", "nation", "region")}
    return click_log.row_counts(t, {"events": 1000, "nation": 100}, {"region": ("r_regionkey", "r_missing")})


@query("""SELECT count(*) AS events, count(DISTINCT visitor) AS visitors, count(DISTINCT item) AS items, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'add_to_cart') AS carts,
count(*) FILTER (event_type = 'purchase') AS purchases, min(at) AS first_at, max(at) AS last_at, round((max(at) - min(at)) / 86400, 1) AS days FROM log""")
def q_dataset_summary(s, d):
    return click_log.dataset_summary(v.log(s, d))


# ---- parsing and predicates

@query(f"""SELECT event_id::VARCHAR AS event_id, CASE WHEN event_id % 2 = 1 THEN 2 ELSE 1 END::INTEGER AS schema_version, user_id::INTEGER AS user_id, product_id::INTEGER AS product_id, event_type, CASE WHEN event_id % 2 = 1 THEN 'web' ELSE 'unknown' END AS channel,
t AS event_at, weight FROM {stream_queries._GOOD}""")
def q_valid_events(s, d):
    e = valid_events(parse_events(v.wire(s, d)))
    return e.select("event_id", "schema_version", "user_id", "product_id", "event_type", "channel", F.unix_seconds("event_time").alias("event_at"), "weight")


@query(f"SELECT event_id::VARCHAR AS event_id, {stream_queries.REASON} AS invalid_reason, {stream_queries.REASON} IS NULL AS is_valid FROM raw_clicks WHERE event_id % 23 <> 0")
def q_parse_events(s, d):
    return parse_events(v.wire(s, d)).filter("event_id is not null").select("event_id", "invalid_reason", "is_valid")


@query(f"SELECT invalid_reason, count(*) AS n FROM (SELECT {stream_queries.REASON} AS invalid_reason FROM raw_clicks) WHERE invalid_reason IS NOT NULL GROUP BY 1")
def q_reject_reasons(s, d):
    return parse_events(v.wire(s, d)).filter("not is_valid").groupBy("invalid_reason").agg(F.count("*").alias("n"))


@query(f"SELECT count(*) AS rejected, count(*) FILTER (event_id % 23 = 0) AS garbage FROM raw_clicks WHERE {stream_queries.REASON} IS NOT NULL")
def q_dead_letter(s, d):
    rows = invalid_events(parse_events(v.wire(s, d)))
    return rows.agg(F.count("*").alias("rejected"), F.count_if(F.col("raw_value") == "not json at all").alias("garbage"))


@query("SELECT event_type, count(*) AS n, sum(weight) AS weight FROM raw_clicks GROUP BY 1")
def q_event_weights(s, d):
    return v.raw_clicks(s, d).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))


@query("SELECT visitor, count(*) AS events FROM log GROUP BY 1 HAVING count(*) >= 50")
def q_heavy_visitors(s, d):
    return sessions.heavy_visitors(v.log(s, d), 50)


@query("SELECT l.* FROM log l ANTI JOIN (SELECT visitor FROM log GROUP BY 1 HAVING count(*) >= 50) USING (visitor)")
def q_light_events(s, d):
    log = v.log(s, d)
    return log.join(sessions.heavy_visitors(log, 50), "visitor", "left_anti").select("visitor", "at", "item", "event_type", "event_id")


# ---- windows, pairs and read-side sums

@query("SELECT * FROM trending")
def q_trending_window(s, d):
    return v.trending_table(s, d)


@query("""SELECT w AS window_start, w + INTERVAL 2 DAY AS window_end, product_id, count(*) AS event_count, round(sum(weight), 3) AS score FROM
(SELECT *, unnest([date_trunc('day', event_time)::TIMESTAMP, date_trunc('day', event_time)::TIMESTAMP - INTERVAL 1 DAY]) AS w FROM clicks) GROUP BY ALL""")
def q_trending_sliding(s, d):
    return a.trending(v.clicks(s, d), "2 days", "1 day", exact=True).select("window_start", "window_end", "product_id", "event_count", "score")


@query("SELECT * FROM edges")
def q_co_occurrence(s, d):
    return a.co_occurrence(v.clicks(s, d), v.GAP, v.WINDOW, exact=True)


@query("""SELECT date_trunc('day', l.event_time)::TIMESTAMP AS window_start, date_trunc('day', l.event_time)::TIMESTAMP + INTERVAL 1 DAY AS window_end, l.product_id, r.product_id AS related_product_id, count(*) AS pair_count,
round(sum(sqrt(l.weight * r.weight)), 3) AS affinity, count(DISTINCT l.user_id) AS unique_users FROM baskets l JOIN baskets r ON l.session = r.session AND l.product_id < r.product_id
AND r.event_time BETWEEN l.event_time - INTERVAL 30 DAY AND l.event_time + INTERVAL 30 DAY GROUP BY ALL""")
def q_basket_pairs(s, d):
    return a.co_occurrence(v.baskets(s, d), "30 DAYS", "1 day", exact=True)


@query("SELECT l.session, count(*) AS pairs FROM clicks l JOIN clicks r ON l.session = r.session AND l.product_id < r.product_id AND r.event_time BETWEEN l.event_time - INTERVAL 24 HOUR AND l.event_time + INTERVAL 24 HOUR GROUP BY 1")
def q_sessionless_pairs(s, d):
    return a.co_views(v.clicks(s, d), v.GAP).groupBy(F.col("low_session").alias("session")).agg(F.count("*").alias("pairs"))


@query("SELECT * FROM pairs")
def q_mirror_pairs(s, d):
    return v.pair_table(s, d)


@query("""SELECT product_id, sum(event_count)::BIGINT AS event_count, round(sum(score), 3) AS score, max(unique_users) AS peak_users_per_window, count(*) AS windows, min(window_start) AS first_window, max(window_end) AS last_window
FROM trending, cut WHERE window_start >= cutoff GROUP BY 1 ORDER BY score DESC, product_id LIMIT 10""")
def q_trending_lookback(s, d):
    t = v.trending_table(s, d)
    return a.trending_lookback(t, lookback(t), LIMIT)


@query("SELECT t.product_id, t.window_start, t.score, c.name, c.price, c.category FROM trending t LEFT JOIN (SELECT * FROM supplier_catalog WHERE id % 2 = 0) c ON c.id = t.product_id")
def q_trending_enriched(s, d):
    return a.enriched(v.trending_table(s, d).select("product_id", "window_start", "score"), v.supplier_catalog(s, d).filter("id % 2 = 0"))


@query("SELECT * FROM counts")
def q_product_counts(s, d):
    t = v.trending_table(s, d)
    return a.product_counts(t, lookback(t))


@query("""SELECT window_start, window_end, sum(event_count)::BIGINT AS events, round(sum(score), 3) AS score, count(DISTINCT product_id) AS products, round(sum(event_count) / 86400.0::DOUBLE, 6) AS events_per_second FROM trending
GROUP BY 1, 2 ORDER BY window_start DESC LIMIT 20""")
def q_throughput(s, d):
    return a.throughput(v.trending_table(s, d), 20)


EDGES = "SELECT product_id AS source, related_product_id AS target, round(sum(affinity), 3) AS affinity, sum(pair_count)::BIGINT AS pair_count FROM pairs, cut WHERE product_id < related_product_id AND window_start >= cutoff GROUP BY 1, 2 HAVING round(sum(affinity), 3) >= 2 AND sum(pair_count) >= 2 ORDER BY affinity DESC, source, target LIMIT 200"


def edges(s, d):
    t = v.trending_table(s, d)
    return a.graph_edges(v.pair_table(s, d), lookback(t), 200, 2, 2)


@query(EDGES)
def q_graph_edges(s, d):
    return edges(s, d)


@query(f"SELECT id, count(*) AS degree FROM (SELECT unnest([source, target]) AS id FROM ({EDGES})) GROUP BY 1")
def q_graph_nodes(s, d):
    return a.graph_nodes(edges(s, d))


@query(f"SELECT g.*, x.category AS source_category, y.category AS target_category, x.category <> y.category AS crosses FROM ({EDGES}) g LEFT JOIN click_catalog x ON x.id = source LEFT JOIN click_catalog y ON y.id = target")
def q_cross_category_edges(s, d):
    return a.cross_category(edges(s, d), v.click_catalog(s, d))


@query("SELECT 'trending' AS name, count(*) AS n FROM trending UNION ALL SELECT 'pairs', count(*) FROM pairs UNION ALL SELECT 'events', count(*) FROM events")
def q_table_counts(s, d):
    return a.table_counts({"trending": v.trending_table(s, d), "pairs": v.pair_table(s, d), "events": v.table(s, d, "events")})


@query(None)
def q_distinct_users_merged(s, d):
    return a.merged_users(a.user_sketches(v.clicks(s, d), v.WINDOW))


@query("SELECT (SELECT max(window_end) FROM trending) AS newest_end, (SELECT min(window_start) FROM trending) AS oldest_start, (SELECT max(window_start) FROM pairs) AS newest_pair")
def q_anchor_window(s, d):
    t, p = v.trending_table(s, d), v.pair_table(s, d)
    return t.agg(F.max("window_end").alias("newest_end"), F.min("window_start").alias("oldest_start")).withColumn("newest_pair", p.agg(F.max("window_start")).scalar())


# ---- related products

def summed(s, d):
    t = v.trending_table(s, d)
    return rel.summed_pairs(v.pair_table(s, d), lookback(t)), a.product_counts(t, lookback(t))


def _related(method: str):
    value = {"affinity": "affinity", "lift": "lift", "pmi": "CASE WHEN lift > 0 THEN log2(lift) END"}[method]
    body = f"""SELECT product_id, related_product_id, affinity, pair_count, peak_users_per_window, round(lift, 6) AS lift, undefined, score, row_number() OVER (PARTITION BY product_id ORDER BY undefined, score DESC, affinity DESC, related_product_id) - 1 AS rank
FROM (SELECT *, {value} IS NULL AS undefined, round(coalesce({value}, affinity), 4) AS score FROM scored WHERE by_affinity < 40) QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY undefined, score DESC, affinity DESC, related_product_id) <= 10"""

    def f(s, d):
        return rel.related(*summed(s, d), method, LIMIT).withColumn("lift", F.round("lift", 6)).drop("pmi")

    f.__name__ = f"related_{method}"
    return query(body)(f)


for _m in ("affinity", "lift", "pmi"):
    _related(_m)


FILL = """first AS (SELECT product_id, related_product_id AS item, 0 AS tier, row_number() OVER (PARTITION BY product_id ORDER BY affinity DESC, related_product_id) - 1 AS at FROM summed QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY affinity DESC, related_product_id) <= 10),
best AS (SELECT category, product_id AS item, row_number() OVER (PARTITION BY category ORDER BY events DESC, product_id) - 1 AS at FROM counts JOIN click_catalog ON id = product_id WHERE category <> 'uncategorised'),
hot AS (SELECT product_id AS item, row_number() OVER (ORDER BY score DESC, product_id) - 1 AS at FROM trending WHERE window_start = (SELECT max(window_start) FROM trending)),
every AS (SELECT * FROM first UNION ALL SELECT c.id, b.item, 1, b.at FROM click_catalog c JOIN best b USING (category) UNION ALL SELECT c.id, h.item, 2, h.at FROM click_catalog c, hot h WHERE c.id NOT IN (SELECT product_id FROM first)),
chosen AS (SELECT * FROM every WHERE item <> product_id QUALIFY row_number() OVER (PARTITION BY product_id, item ORDER BY tier, at) = 1),
answers AS (SELECT product_id, item, ['co_occurrence', 'category_bestsellers', 'trending'][tier + 1] AS source, row_number() OVER (PARTITION BY product_id ORDER BY tier, at) - 1 AS place FROM chosen QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY tier, at) <= 10)"""


def answers(s, d):
    t = v.trending_table(s, d)
    newest = t.filter(F.col("window_start") == t.agg(F.max("window_start")).scalar())
    return rel.related_with_fill(*summed(s, d), v.click_catalog(s, d), newest, LIMIT)


@query("SELECT * FROM answers", FILL)
def q_related_with_fill(s, d):
    return answers(s, d)


@query("""SELECT CASE WHEN co AND n > 1 THEN 'co_occurrence_filled' WHEN co THEN 'co_occurrence' WHEN cat THEN 'category_fallback' ELSE 'trending_fallback' END AS source, count(*) AS products
FROM (SELECT product_id, bool_or(source = 'co_occurrence') AS co, bool_or(source = 'category_bestsellers') AS cat, count(DISTINCT source) AS n FROM answers GROUP BY 1) GROUP BY 1""", FILL)
def q_answer_sources(s, d):
    return rel.answer_sources(answers(s, d))


@query("""SELECT product_id, related_product_id, win AS "window", sum(pair_count)::BIGINT AS pair_count, round(sum(affinity), 3) AS affinity FROM (
SELECT p.*, CASE WHEN newest_own >= as_of - INTERVAL 2 DAY THEN 'recent' ELSE 'latest_available' END AS win, CASE WHEN newest_own >= as_of - INTERVAL 2 DAY THEN as_of ELSE newest_own END - INTERVAL 2 DAY AS start
FROM (SELECT *, max(window_start) OVER (PARTITION BY product_id) AS newest_own FROM pairs) p, (SELECT newest AS as_of FROM newest)) WHERE window_start >= start GROUP BY ALL""")
def q_related_anchored(s, d):
    t = v.trending_table(s, d)
    rows = rel.anchored_pairs(v.pair_table(s, d), a.newest_end(t).scalar(), 2 * 24 * 60)
    return rows.groupBy("product_id", "related_product_id", "window").agg(F.sum("pair_count").alias("pair_count"), F.round(F.sum("affinity"), 3).alias("affinity"))


@query("""WITH z AS (SELECT product_id, related_product_id, sum(pair_count)::BIGINT AS pair_count FROM pairs GROUP BY 1, 2 HAVING sum(pair_count) >= 3),
y AS (SELECT product_id, related_product_id, pair_count, 'recent' AS win FROM summed UNION ALL SELECT *, 'all' FROM z WHERE product_id NOT IN (SELECT product_id FROM summed))
SELECT product_id, related_product_id, pair_count, win AS "window", row_number() OVER (PARTITION BY product_id ORDER BY pair_count DESC, related_product_id) - 1 AS rank FROM y QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY pair_count DESC, related_product_id) <= 10""")
def q_related_retained(s, d):
    t = v.trending_table(s, d)
    return rel.related_retained(v.pair_table(s, d), lookback(t), LIMIT)


# ---- visits

@query("SELECT visitor, event_id, visit, seq, started_at FROM visits")
def q_sessionise(s, d):
    return visits(s, d).select("visitor", "event_id", "visit", "seq", "started_at")


@query("SELECT DISTINCT visitor, visit, 'rr-' || substr(sha1(visitor || ':' || started_at::BIGINT), 1, 16) AS session FROM visits")
def q_session_ids(s, d):
    return visits(s, d).select("visitor", "visit", "session").distinct()


@query("SELECT event_id, 'rr-' || substr(sha1(visitor || ':' || started_at::BIGINT), 1, 16) || '-' || seq AS wire_id FROM visits")
def q_event_ids(s, d):
    return visits(s, d).select("event_id", F.concat_ws("-", "session", "seq").alias("wire_id"))


@query("SELECT * FROM items")
def q_visit_items(s, d):
    return sessions.visit_items(visits(s, d))


@query("SELECT * FROM cases")
def q_test_cases(s, d):
    return cases(s, d).select("case", "query", "target", "later")


@query("SELECT l.item AS item_a, r.item AS item_b, count(*) AS n FROM visits l JOIN visits r ON l.visitor = r.visitor AND l.visit = r.visit AND l.item < r.item AND abs(l.at - r.at) <= 14400 GROUP BY 1, 2")
def q_visit_pairs(s, d):
    return sessions.visit_pairs(visits(s, d), 14400)


@query("""WITH o AS (SELECT DISTINCT visitor, item FROM log), f AS (SELECT visitor FROM o GROUP BY 1 HAVING count(*) BETWEEN 2 AND 40)
SELECT l.item AS item_a, r.item AS item_b, count(*) AS n FROM o l JOIN o r ON l.visitor = r.visitor AND l.item < r.item WHERE l.visitor IN (SELECT visitor FROM f) GROUP BY 1, 2 HAVING count(*) >= 2""")
def q_visitor_pairs(s, d):
    return sessions.visitor_pairs(v.log(s, d), 40)


@query("""WITH w AS (SELECT visitor, visit, count(DISTINCT item) AS k, count(*) AS n, max((event_type = 'add_to_cart')::INT) AS cart, max((event_type = 'purchase')::INT) AS buy FROM visits GROUP BY 1, 2), p AS (SELECT visitor, count(*) AS vs, sum(n) AS ev FROM w GROUP BY 1)
SELECT * FROM (SELECT round(100 * avg((k = 1)::INT), 3) AS one_item, round(100 * avg((k >= 2)::INT), 3) AS two_items, round(100 * avg((k >= 3)::INT), 3) AS three_items, round(100 * avg((k >= 5)::INT), 3) AS five_items, round(100 * avg(cart), 3) AS cart_visits, round(100 * avg(buy), 3) AS purchase_visits FROM w),
(SELECT round(100 * avg((vs > 1)::INT), 3) AS returning, round(100 * sum(CASE WHEN ev >= 50 THEN ev ELSE 0 END)::BIGINT / sum(ev)::BIGINT, 3) AS heavy_share FROM p)""")
def q_visit_profile(s, d):
    return sessions.visit_profile(visits(s, d), 50)


@query("""SELECT visitor, visit, head_items, head_end - started_at AS head_seconds, second_at - started_at AS first_gap, (item_0 = item_last)::INT AS returns, floor(started_at / 3600)::BIGINT % 24 AS hour, floor(started_at / 86400)::BIGINT % 7 AS weekday, 2 - head_items AS repeats, visit - 1 AS visits_before, label FROM (
SELECT visitor, visit, count(*) FILTER (seq < 2 AND event_type = 'view') AS hv, count(DISTINCT item) FILTER (seq < 2) AS head_items, max(at) FILTER (seq < 2) AS head_end, min(at) AS started_at, min(at) FILTER (seq = 1) AS second_at, min(item) FILTER (seq = 0) AS item_0, min(item) FILTER (seq = 1) AS item_last,
count(*) FILTER (seq >= 2) AS tail, max((seq >= 2 AND event_type IN ('add_to_cart', 'purchase'))::INT) AS label FROM visits GROUP BY 1, 2) WHERE tail > 0 AND hv = 2""")
def q_intent_rows(s, d):
    return sessions.intent_rows(visits(s, d), 2)


@query("SELECT event_id, 1700000000.0::DOUBLE + (at - (SELECT min(at) FROM log)) / 100.0::DOUBLE AS at FROM log")
def q_reclock(s, d):
    log = v.log(s, d)
    return log.select("event_id", x.reclock(F.col("at"), log.agg(F.min("at")).scalar(), 1700000000.0, 100.0).alias("at"))


# ---- ranking

@query("SELECT * FROM snap")
def q_ranker_snapshot(s, d):
    return r.snapshot(v.trending_table(s, d))


@query("SELECT * FROM near")
def q_neighbours(s, d):
    return r.neighbours(v.pair_table(s, d))


@query("SELECT * FROM mass")
def q_item_pairs(s, d):
    return r.item_pairs(v.pair_table(s, d))


@query("SELECT * FROM hops")
def q_two_hop(s, d):
    return r.two_hop(r.neighbours(v.pair_table(s, d)))


@query("SELECT * FROM (SELECT grp AS \"group\", item, rank FROM cat_top)")
def q_category_top(s, d):
    return r.category_top(r.snapshot(v.trending_table(s, d)), v.click_catalog(s, d))


@query("SELECT grp AS \"group\", item, rank FROM up_top")
def q_parent_top(s, d):
    return r.category_top(r.snapshot(v.trending_table(s, d)), v.click_catalog(s, d), "parent")


def vectors(s, d):
    return v.table(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


@query("""WITH w AS (SELECT vec_id AS id, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y * y)))) AS v FROM embeddings)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY cos DESC, item) - 1 AS rank FROM (SELECT p.id AS query, q.id AS item, round(list_dot_product(p.v, q.v), 6) AS cos FROM w p JOIN w q ON p.id <> q.id WHERE p.id % 100 = 0)) WHERE rank < 30""")
def q_similar_items(s, d):
    return vec.similar_items(vectors(s, d), queries="id % 100 = 0")


def ranking_inputs(s, d):
    """Candidates and what they come from. Tables that several operators read are written once, independent ones beside each other,
    and only with the columns that these read: counting different users would shuffle every pair and event once more."""

    def of_pairs():
        pairs = stored(v.pair_table(s, d).select("product_id", "related_product_id", "pair_count"))
        near = stored(r.neighbours(pairs))
        return pairs, near, stored(r.two_hop(near))

    def of_items():
        catalog = stored(v.click_catalog(s, d))
        own = vectors(s, d).join(catalog.select("id"), "id", "left_semi")
        return catalog, own, stored(vec.similar_items(own))

    (pairs, near, hops), (catalog, own, similar), snap = together(of_pairs, of_items, lambda: stored(r.snapshot(stored(v.trending_table(s, d).select("product_id", "window_start", "event_count", "views", "carts", "purchases")))))
    found = r.candidates(catalog.select(F.col("id").alias("query")), near, snap, catalog, similar, hops)
    return found, near, snap, r.item_pairs(pairs), catalog, similar, own, hops


def feature_rows(s, d):
    return r.features(*ranking_inputs(s, d))


@query("SELECT query, item, ['co_occurrence', 'category', 'item2vec', 'parent_category', 'two_hop', 'bestsellers'][source + 1] AS origin, source, place FROM cands")
def q_candidates(s, d):
    return ranking_inputs(s, d)[0]


FEATURES = """SELECT c.query, c.item, ['co_occurrence', 'category', 'item2vec', 'parent_category', 'two_hop', 'bestsellers'][c.source + 1] AS origin,
coalesce(n.n, 0) AS pair_n, round(ln(1 + coalesce(n.n, 0)), 6) AS log_pair_n, round(coalesce(n.n, 0) / (coalesce(mq.mass, 0) + 1), 6) AS pair_over_q, round(ln(1 + CASE WHEN n.n > 0 AND mq.mass > 0 AND mc.mass > 0 THEN n.n * mq.total / (mq.mass * mc.mass) ELSE 0 END), 6) AS log_lift,
coalesce(n.rank, 99)::DOUBLE AS co_rank, coalesce(s.rank, 99)::DOUBLE AS i2v_rank, round(coalesce(list_dot_product(uq.v, uc.v), 0), 6) AS i2v_cos, (cc.category = cq.category)::INT::DOUBLE AS same_cat, coalesce(cc.parent = cq.parent, FALSE)::INT::DOUBLE AS same_parent,
CASE WHEN cc.category = cq.category THEN coalesce(ct.rank, 99) ELSE 99 END::DOUBLE AS cat_rank, round(ln(1 + coalesce(sc.views, 0)), 6) AS log_views, round(ln(1 + coalesce(sc.recent, 0)), 6) AS log_recent, round((coalesce(sc.carts, 0) + 1) / (coalesce(sc.views, 0) + 20), 6) AS cart_rate,
round(ln(1 + coalesce(sc.buys, 0)), 6) AS log_buys, round(ln(1 + coalesce(sq.views, 0)), 6) AS log_q_views, (coalesce(n.n, 0) >= 3)::INT::DOUBLE AS passes_min_pairs, round(ln(1 + coalesce(h.score, 0)), 6) AS log_two_hop, coalesce(h.rank, 99)::DOUBLE AS two_hop_rank, coalesce(pt.rank, 99)::DOUBLE AS parent_rank
FROM cands c LEFT JOIN (SELECT query, item, n, CASE WHEN rank < 30 THEN rank END AS rank FROM ranked_near) n ON n.query = c.query AND n.item = c.item LEFT JOIN alike s ON s.query = c.query AND s.item = c.item LEFT JOIN mass mq ON mq.id = c.query LEFT JOIN mass mc ON mc.id = c.item
LEFT JOIN (SELECT query, item, score, CASE WHEN row_number() OVER (PARTITION BY query ORDER BY score DESC, item) <= 30 THEN row_number() OVER (PARTITION BY query ORDER BY score DESC, item) - 1 END AS rank FROM hops) h ON h.query = c.query AND h.item = c.item
JOIN click_catalog cq ON cq.id = c.query JOIN click_catalog cc ON cc.id = c.item LEFT JOIN unit uq ON uq.id = c.query LEFT JOIN unit uc ON uc.id = c.item LEFT JOIN snap sq ON sq.id = c.query LEFT JOIN snap sc ON sc.id = c.item
LEFT JOIN cat_top ct ON ct.grp = cq.category AND ct.item = c.item LEFT JOIN up_top pt ON pt.grp = cq.parent AND pt.item = c.item"""


@query(FEATURES)
def q_features(s, d):
    return feature_rows(s, d)


@query("""SELECT k."case", k.query, c.item, (c.item = k.target)::INT AS label FROM cases k JOIN cands c USING (query) WHERE EXISTS (SELECT 1 FROM cands z WHERE z.query = k.query AND z.item = k.target)""")
def q_training_rows(s, d):
    return r.training_rows(cases(s, d), ranking_inputs(s, d)[0]).select("case", "query", "item", "label")


TREES = b.Boosting(rounds=4, depth=3, rate=0.3, bins=32, least_rows=20)
VERSION = "20240101T000000Z"


def boosting_sql(p: b.Boosting) -> str:
    """The training of boosted trees in SQL: gh<t> has the gradients of a round, best<t>_<d> the splits of a level, leaf<t> the leaves."""
    names = r.FEATURES
    fit = lambda cap: "[" + ", ".join(f"CASE WHEN hi{i} > lo{i} THEN " + cap.format(f"floor(({c} - lo{i}) / ((hi{i} - lo{i}) / {p.bins}))::INT") + " ELSE 0 END" for i, c in enumerate(names)) + "]"
    part = lambda g, h: f"({g} / 1000000) * ({g} / 1000000) / ({h} / 1000000 + {p.smoothing})"
    gain = f"round({part('lg', 'lh')} + {part('(ag - lg)', '(ah - lh)')} - {part('ag', 'ah')}, 6)"
    down = "CASE WHEN b.node IS NULL THEN n.node WHEN n.x[b.f + 1] <= b.bin THEN 2 * n.node + 1 ELSE 2 * n.node + 2 END"
    out = [f"feats AS MATERIALIZED ({FEATURES})"]
    out.append("""fit AS MATERIALIZED (SELECT k."case", f.item, (f.item = k.target)::INT AS label, f.* EXCLUDE (query, item) FROM cases k JOIN feats f USING (query) WHERE EXISTS (SELECT 1 FROM feats z WHERE z.query = k.query AND z.item = k.target))""")
    out.append("ends AS (SELECT " + ", ".join(f"min({c}) AS lo{i}, max({c}) AS hi{i}" for i, c in enumerate(names)) + " FROM fit)")
    out.append(f"""st0 AS MATERIALIZED (SELECT "case", item, label, {fit("least({}, " + str(p.bins - 1) + ")")} AS x, 0::DOUBLE AS score FROM fit, ends)""")
    out.append(f"pick0 AS MATERIALIZED (SELECT query, item, origin, {fit('{}')} AS x, 0::DOUBLE AS score FROM feats, ends)")
    for t in range(p.rounds):
        out.append(f"""pl{t} AS (SELECT *, row_number() OVER (PARTITION BY "case" ORDER BY score DESC, item) AS place FROM st{t})""")
        out.append(f"""pu{t} AS (SELECT p.*, 1 / (1 + exp(ts - p.score)) AS rho, abs(1 / log2(1 + tp) - 1 / log2(1 + place)) AS ch FROM pl{t} p JOIN (SELECT "case", score AS ts, place AS tp FROM pl{t} WHERE label = 1) USING ("case"))""")
        out.append(f"""gh{t} AS MATERIALIZED (SELECT "case", item, label, x, score, (CASE WHEN label = 0 THEN gg ELSE -sum(gg) OVER (PARTITION BY "case") END)::BIGINT AS g, (CASE WHEN label = 0 THEN hh ELSE sum(hh) OVER (PARTITION BY "case") END)::BIGINT AS h
          FROM (SELECT *, CASE WHEN label = 0 THEN round(rho * ch * 1000000)::BIGINT ELSE 0 END AS gg, CASE WHEN label = 0 THEN round(rho * (1 - rho) * ch * 1000000)::BIGINT ELSE 0 END AS hh FROM pu{t}))""")
        out.append(f"nd{t}_0 AS (SELECT *, 0 AS node FROM gh{t})")
        out.append(f"go{t}_0 AS (SELECT *, 0 AS node FROM pick{t})")
        for d in range(p.depth):
            out.append(f"hs{t}_{d} AS MATERIALIZED (SELECT node, f::INT AS f, x[f + 1] AS bin, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h, count(*) AS n FROM nd{t}_{d}, range({len(names)}) r(f) WHERE node >= {2**d - 1} GROUP BY ALL)")
            out.append(f"""best{t}_{d} AS MATERIALIZED (SELECT *, {gain} AS gain FROM (SELECT node, f, bin, sum(g) OVER u::BIGINT AS lg, sum(h) OVER u::BIGINT AS lh, sum(n) OVER u AS ln, sum(g) OVER a::BIGINT AS ag, sum(h) OVER a::BIGINT AS ah, sum(n) OVER a AS an FROM hs{t}_{d} WINDOW a AS (PARTITION BY node, f), u AS (PARTITION BY node, f ORDER BY bin))
          WHERE {gain} > 0 AND ln >= {p.least_rows} AND an - ln >= {p.least_rows} QUALIFY row_number() OVER (PARTITION BY node ORDER BY {gain} DESC, f, bin) = 1)""")
            out.append(f"nd{t}_{d + 1} AS MATERIALIZED (SELECT n.* REPLACE ({down} AS node) FROM nd{t}_{d} n LEFT JOIN best{t}_{d} b ON b.node = n.node)")
            out.append(f"go{t}_{d + 1} AS MATERIALIZED (SELECT n.* REPLACE ({down} AS node) FROM go{t}_{d} n LEFT JOIN best{t}_{d} b ON b.node = n.node)")
        out.append(f"leaf{t} AS MATERIALIZED (SELECT node, -{p.rate} * (sum(g)::BIGINT / 1000000) / (sum(h)::BIGINT / 1000000 + {p.smoothing}) AS value FROM nd{t}_{p.depth} GROUP BY node)")
        for rows, at in (("st", "nd"), ("pick", "go")):
            keep = '"case", item, label' if rows == "st" else "query, item, origin"
            out.append(f"{rows}{t + 1} AS MATERIALIZED (SELECT {keep}, x, score + value AS score FROM {at}{t}_{p.depth} JOIN leaf{t} USING (node))")
    return ",\n".join(out)


def fit_rows(s, d):
    """Features of all candidates, written once, the training lists among them, and the cases that these count."""
    rows, found = together(lambda: stored(feature_rows(s, d)), lambda: stored(cases(s, d).select("case", "query", "target")))
    return rows, stored(r.training_lists(found, rows)), found


@query('SELECT "case", item, label, g, h FROM gh0', boosting_sql(b.Boosting(rounds=1, depth=1, bins=TREES.bins)))
def q_ranker_lambdas(s, d):
    """List-wise gradients of the first round, where all scores are equal: worked out once for each query and target, then given to its cases."""
    _, lists, found = fit_rows(s, d)
    pairs = b.case_lambdas(lists.select("case", "item", "label", F.lit(0.0).alias("score"))).withColumnRenamed("case", "query")
    return found.join(pairs, ["query", "target"]).select("case", "item", "label", "g", "h")


NODES = " UNION ALL ".join(
    [f"SELECT {t} AS tree, node::INT AS node, f AS feature, bin::INT AS bin, gain, NULL::DOUBLE AS value FROM best{t}_{k}" for t in range(TREES.rounds) for k in range(TREES.depth)]
    + [f"SELECT {t}, node::INT, NULL, NULL, NULL, round(value, 9) FROM leaf{t} WHERE node > 0" for t in range(TREES.rounds)]
)


@query(f"SELECT tree, node, {list(r.FEATURES)!r}[feature + 1] AS feature, bin, gain, value FROM ({NODES})", boosting_sql(TREES))
def q_ranker_model(s, d):
    """The model's nodes: what every split and leaf of the trained trees is."""
    return b.train(fit_rows(s, d)[1], TREES, VERSION).select("tree", "node", "feature", "bin", "gain", F.round("value", 9).alias("value"))


@query(f"SELECT * FROM (SELECT query, item, round(score, 9) AS score, origin AS candidate_from, '{VERSION}' AS model_version, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, item) - 1 AS rank FROM pick{TREES.rounds}) WHERE rank < {LIMIT}", boosting_sql(TREES))
def q_learned_order(s, d):
    rows, train, _ = fit_rows(s, d)
    return b.learned_order(b.train(train, TREES, VERSION), rows, LIMIT)


@query("""WITH lists AS (SELECT items FROM items WHERE len(items) > 1), known AS (SELECT a FROM (SELECT unnest(items) AS a FROM lists) GROUP BY a HAVING count(*) >= 2),
met AS (SELECT least(items[i], items[j]) AS a, greatest(items[i], items[j]) AS b, count(*) AS n FROM lists, unnest(range(1, len(items) + 1)) t(i), unnest(range(i + 1, least(len(items), i + 5) + 1)) u(j) GROUP BY ALL),
both_ways AS (SELECT a, b, n FROM met WHERE a IN (SELECT a FROM known) AND b IN (SELECT a FROM known) UNION ALL SELECT b, a, n FROM met WHERE a IN (SELECT a FROM known) AND b IN (SELECT a FROM known)),
own AS (SELECT a, sum(n) AS own FROM both_ways GROUP BY a)
SELECT a, b, round(value, 6) AS value FROM (SELECT m.a, m.b, ln(m.n * (SELECT sum(own) FROM own)::DOUBLE / (x.own * y.own)) AS value FROM both_ways m JOIN own x ON x.a = m.a JOIN own y ON y.a = m.b) WHERE value > 0""")
def q_item_pmi(s, d):
    return vec.item_pmi(sessions.visit_items(visits(s, d))).withColumn("value", F.round("value", 6))


@query(None)
def q_item2vec(s, d):
    found = vec.item_vectors(sessions.visit_items(visits(s, d)))
    return vec.similar_items(found, 10).select("query", "item", "rank")


# ---- evaluation

TRAIN, TEST = (0.0, 20.0), (20.0, 10.0)


def split(s, d):
    log = v.log(s, d)
    train, test = e.day_slice(log, *TRAIN), e.day_slice(log, *TEST)
    found = sessions.test_cases(sessions.visit_items(sessions.sessionise(test, v.VISIT_GAP)))
    return train, found.withColumn("case", F.concat_ws("-", "visitor", "visit"))


SPLIT = """train AS (SELECT l.* FROM log l, (SELECT min(at) AS a FROM log) WHERE at < a + 20 * 86400), test AS (SELECT l.* FROM log l, (SELECT min(at) AS a FROM log) WHERE at >= a + 20 * 86400 AND at < a + 30 * 86400),
t0 AS (SELECT *, sum(new) OVER (PARTITION BY visitor ORDER BY at, event_id)::BIGINT AS visit FROM (SELECT *, CASE WHEN at - lag(at) OVER (PARTITION BY visitor ORDER BY at, event_id) <= 43200 THEN 0 ELSE 1 END AS new FROM test)),
t1 AS (SELECT *, row_number() OVER (PARTITION BY visitor, visit ORDER BY at, event_id) AS seq FROM t0),
t2 AS (SELECT visitor, visit, list(item ORDER BY seq) AS items FROM (SELECT visitor, visit, item, min(seq) AS seq FROM t1 GROUP BY ALL) GROUP BY ALL),
cs AS (SELECT visitor || '-' || visit AS k, items[1] AS query, items[2] AS target, items[2:] AS later FROM t2 WHERE len(items) > 1),
vc AS (SELECT item, count(*) AS n FROM train WHERE event_type = 'view' GROUP BY 1),
top_all AS (SELECT item, n, row_number() OVER (ORDER BY n DESC, item) - 1 AS rank FROM vc),
own AS (SELECT category, item, row_number() OVER (PARTITION BY category ORDER BY n DESC, item) - 1 AS rank FROM vc JOIN click_catalog ON id = item WHERE category <> 'uncategorised' QUALIFY row_number() OVER (PARTITION BY category ORDER BY n DESC, item) <= 11),
qs AS (SELECT DISTINCT query FROM cs), mine AS (SELECT query, o.item, o.rank FROM qs JOIN click_catalog ON id = query JOIN own o USING (category)),
cb AS (SELECT * FROM mine UNION ALL SELECT query, item, rank FROM qs, top_all WHERE rank < 11 AND query NOT IN (SELECT query FROM mine)),
ans AS (SELECT query, list(item) AS items FROM (SELECT * FROM cb WHERE item <> query QUALIFY row_number() OVER (PARTITION BY query ORDER BY rank, item) <= 10) GROUP BY 1),
gl AS (SELECT query, list(item) AS items FROM (SELECT query, item FROM qs, top_all WHERE rank < 10 AND item <> query) GROUP BY 1),
hit AS (SELECT k, coalesce(list_contains(items, target), FALSE) AS hit, coalesce(list_has_any(items, later), FALSE) AS any_hit, items IS NOT NULL AS answered FROM cs LEFT JOIN ans USING (query)),
ghit AS (SELECT k, coalesce(list_contains(items, target), FALSE) AS hit, coalesce(list_has_any(items, later), FALSE) AS any_hit, items IS NOT NULL AS answered FROM cs LEFT JOIN gl USING (query))"""


def split_query(body: str, more: str = ""):
    return query(body, SPLIT + (",\n" + more if more else ""))


@split_query("SELECT 'train' AS part, count(*) AS events FROM train UNION ALL SELECT 'test', count(*) FROM test")
def q_train_test_split(s, d):
    log = v.log(s, d)
    n = lambda df, name: df.agg(F.count("*").alias("events")).select(F.lit(name).alias("part"), "events")
    return n(e.day_slice(log, *TRAIN), "train").unionByName(n(e.day_slice(log, *TEST), "test"))


@split_query("SELECT item, n, rank FROM top_all WHERE rank < 10")
def q_bestsellers(s, d):
    return e.bestsellers(split(s, d)[0], LIMIT)


@split_query("""SELECT coalesce((SELECT string_agg(n, ',' ORDER BY n) FROM (SELECT item::VARCHAR AS n FROM al EXCEPT SELECT item::VARCHAR FROM top_all WHERE rank < 20)), '') AS missing,
coalesce((SELECT string_agg(n, ',' ORDER BY n) FROM (SELECT item::VARCHAR AS n FROM top_all WHERE rank < 20 EXCEPT SELECT item::VARCHAR FROM al)), '') AS unexpected,
(SELECT list(item ORDER BY rank) FROM al) = (SELECT list(item ORDER BY rank) FROM top_all WHERE rank < 20) AS same""", """al AS (SELECT item, row_number() OVER (ORDER BY count(*) DESC, item) - 1 AS rank FROM log WHERE event_type = 'view' GROUP BY item QUALIFY row_number() OVER (ORDER BY count(*) DESC, item) <= 20)""")
def q_feature_diff(s, d):
    """The ordered list that a model was made with against the list that holds now: the best sellers of the training days and of all."""
    names = lambda log: e.bestsellers(log, 20).select(F.col("rank").alias("position"), F.col("item").cast("string").alias("name"))
    return r.feature_difference(names(split(s, d)[0]), names(v.log(s, d)))


def written_split(s, d):
    """The split with its cases written once, for queries that evaluate several answers on them."""
    train, found = split(s, d)
    return train, stored(found)


def by_category(s, d, parts=None):
    train, found = parts or split(s, d)
    return found, e.category_bestsellers(train, v.click_catalog(s, d), found.select("query").distinct(), LIMIT)


def global_best(s, d, parts=None):
    train, found = parts or split(s, d)
    return found, found.select("query").distinct().crossJoin(F.broadcast(e.bestsellers(train, LIMIT).select("item", "rank")))


@split_query("SELECT query, item, rank FROM cb")
def q_category_bestsellers(s, d):
    return by_category(s, d)[1]


RATE = "SELECT '{0}' AS name, count(*) AS cases, round(avg(hit::INT), 6) AS hit, round(avg(any_hit::INT), 6) AS any_hit, round(avg(answered::INT), 6) AS answered FROM {1}"


@split_query(RATE.format("category", "hit") + " UNION ALL " + RATE.format("bestsellers", "ghit"))
def q_hit_rate(s, d):
    parts = written_split(s, d)
    return e.hit_rate(e.hits(*by_category(s, d, parts)), "category").unionByName(e.hit_rate(e.hits(*global_best(s, d, parts)), "bestsellers"))


@split_query("SELECT 'category' AS model, 'bestsellers' AS baseline, round(CASE WHEN b > 0 THEN a / b END, 6) AS lift FROM (SELECT round(avg(hit::INT), 6) AS a FROM hit), (SELECT round(avg(hit::INT), 6) AS b FROM ghit)")
def q_model_lift(s, d):
    parts = written_split(s, d)
    rate = lambda answers, name: e.hit_rate(e.evaluated(*answers, v.click_catalog(s, d)), name)
    return e.model_lift(rate(by_category(s, d, parts), "category"), rate(global_best(s, d, parts), "bestsellers"))


@split_query("SELECT hit.hit::INT - ghit.hit::INT AS d, count(*) AS n FROM hit JOIN ghit USING (k) GROUP BY 1")
def q_hit_differences(s, d):
    parts = written_split(s, d)
    return e.hit_differences(e.hits(*by_category(s, d, parts)), e.hits(*global_best(s, d, parts)))


@query(None)
def q_bootstrap(s, d):
    parts = written_split(s, d)
    return e.paired_bootstrap(e.hits(*by_category(s, d, parts)), e.hits(*global_best(s, d, parts)))


@split_query("SELECT round(100 * avg((query IN (SELECT item FROM train))::INT), 3) AS queries_seen, round(100 * avg((target IN (SELECT item FROM train))::INT), 3) AS targets_seen FROM cs")
def q_cold_start_share(s, d):
    train, found = split(s, d)
    return e.cold_start_share(found, train)


@split_query("SELECT k AS \"case\", query, target FROM cs ORDER BY md5(k || ':7'), k LIMIT 100")
def q_case_sample(s, d):
    return e.sample_cases(split(s, d)[1], 100).select("case", "query", "target")


@query("""WITH f AS (SELECT query, item, min(source) AS source FROM pool GROUP BY 1, 2), i AS (SELECT unnest(range(6))::INT AS source)
SELECT i.source, (SELECT round(avg(coalesce(f.source <= i.source, FALSE)::INT), 6) FROM cases c LEFT JOIN f ON f.query = c.query AND f.item = c.target) AS recall,
(SELECT round(avg(n), 6) FROM (SELECT c."case", count(f.item) FILTER (f.source <= i.source) AS n FROM cases c LEFT JOIN f ON f.query = c.query GROUP BY 1)) AS mean_pool FROM i""")
def q_candidate_recall(s, d):
    return e.candidate_recall(cases(s, d), ranking_inputs(s, d)[0], 6)


@query("""WITH m AS (SELECT min(at) AS a FROM log), g AS (SELECT l.*, f.fold, (at - a) / 86400 - f.start AS off FROM log l, m, (VALUES (0, 0.0), (1, 8.0)) f(fold, start))
SELECT fold, part, count(*) AS events, count(DISTINCT visitor) AS visitors FROM (SELECT *, CASE WHEN off >= 0 AND off < 10 THEN 'train' WHEN off >= 10 AND off < 15 THEN 'label' WHEN off >= 15 AND off < 20 THEN 'test' END AS part FROM g) WHERE part IS NOT NULL GROUP BY 1, 2""")
def q_folds(s, d):
    f = e.folds(v.log(s, d), (0.0, 8.0), 10, 5, 5)
    return f.groupBy("fold", "part").agg(F.count("*").alias("events"), F.countDistinct("visitor").alias("visitors"))


@query("""WITH b AS (SELECT query, item, rank, 0 AS src FROM ranked_near WHERE rank < 5 UNION ALL SELECT id, item, rank, 1 FROM click_catalog JOIN cat_top ON grp = category WHERE item <> id)
SELECT query, item, src AS source, row_number() OVER (PARTITION BY query ORDER BY src, rank) - 1 AS place FROM (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY query, item ORDER BY src, rank) = 1) QUALIFY row_number() OVER (PARTITION BY query ORDER BY src, rank) <= 10""")
def q_blend(s, d):
    pairs, catalog = v.pair_table(s, d), v.click_catalog(s, d)
    co = a.top(r.neighbours(pairs), [F.col("n").desc(), "item"], ["query"], 5)
    cat = catalog.select(F.col("id").alias("query"), F.col("category").alias("group")).join(r.category_top(r.snapshot(v.trending_table(s, d)), catalog), "group").filter("item <> query")
    return r.blend([co, cat], LIMIT)


# ---- health

@query("SELECT query, quantile_disc(ms, 0.5) AS p50, quantile_disc(ms, 0.95) AS p95 FROM lags GROUP BY 1")
def q_batch_percentiles(s, d):
    return h.percentiles(v.metrics(s, d), ["query"], "batch_duration_ms", {"p50": 0.5, "p95": 0.95})


@query("SELECT query, round(avg(input_rows), 3) AS mean_rows, max(lag) AS max_lag, quantile_disc(ms, 0.5) AS p50_ms, max(ms) AS max_ms, max(state) AS max_state FROM lags GROUP BY 1")
def q_step_metrics(s, d):
    return h.step_metrics(v.metrics(s, d), ["query"])


RISING = """SELECT query, CASE WHEN n >= 4 THEN after > before END AS rising FROM (SELECT query, max(n) AS n, max(lag) FILTER (i <= n // 2) AS before, min(lag) FILTER (i > n - n // 2) AS after
FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY recorded_at) AS i, count(*) OVER (PARTITION BY query) AS n FROM lags WHERE lag IS NOT NULL) GROUP BY 1)"""


def rising(s, d):
    m = v.metrics(s, d).withColumn("lag", x.known_max(F.col("kafka_lag")))
    return h.rising_floor(m, ["query"], "recorded_at", "lag")


@query(RISING)
def q_rising_floor(s, d):
    return rising(s, d)


@query("""SELECT query, recorded_at, coalesce(now > before AND now > 500, FALSE) AS growing FROM (SELECT *, min(lag) OVER (PARTITION BY query ORDER BY t RANGE BETWEEN 86399 PRECEDING AND CURRENT ROW) AS now,
max(lag) OVER (PARTITION BY query ORDER BY t RANGE BETWEEN 172799 PRECEDING AND 86400 PRECEDING) AS before FROM lags)""")
def q_lag_growing(s, d):
    return h.lag_growing(v.metrics(s, d), 24 * 60, 500)


@query("SELECT query, round(regr_slope(state, t::DOUBLE), 9) AS slope FROM lags GROUP BY 1")
def q_state_slope(s, d):
    return h.state_slope(v.metrics(s, d))


@query("SELECT query, recorded_at, t // 21600 AS batch_id, input_rows, ms AS batch_duration_ms, lag, state FROM lags QUALIFY row_number() OVER (PARTITION BY query ORDER BY recorded_at DESC) = 1")
def q_latest_metrics(s, d):
    return h.latest_metrics(v.metrics(s, d))


@query("SELECT CASE WHEN count(*) >= 5 THEN date_diff('second', (SELECT min(recorded_at) FROM lags), max(at)) END AS seconds, count(*) AS drained FROM (SELECT query, min(recorded_at) AS at FROM lags WHERE lag <= 400 GROUP BY 1)")
def q_drain_time(s, d):
    m = v.metrics(s, d)
    return h.drain_time(m, m.agg(F.min("recorded_at")).scalar(), 400, 5)


@query(f"SELECT query, CASE WHEN rising IS NOT NULL THEN 120 <= 2 * 60 + 5 AND rate >= 0.9 * 10 AND NOT rising END AS keeps_up FROM ({RISING}) JOIN (SELECT query, avg(input_rows) AS rate FROM lags GROUP BY 1) USING (query)")
def q_keeping_up(s, d):
    rate = v.metrics(s, d).groupBy("query").agg(F.avg("input_rows").alias("rate"))
    return rising(s, d).join(rate, "query").select("query", h.keeping_up(F.col("rising"), F.lit(120), 60, F.col("rate"), F.lit(10.0)).alias("keeps_up"))


@query("""SELECT count(*) AS probes, count(*) FILTER (s IS NULL) AS lost, quantile_disc(s, 0.5) AS p50, quantile_disc(s, 0.95) AS p95 FROM (SELECT o_orderkey, date_diff('second', o_orderdate, min(l_shipdate)) AS s FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_linenumber > 1) ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate)""")
def q_probe_latency(s, d):
    sent = v.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("sent_at"))
    seen = v.table(s, d, "lineitem").filter("l_linenumber > 1").select(F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("updated_at"))
    return h.probe_latency(sent, seen)


@query("""SELECT sum(greatest(x, 0))::BIGINT AS missing, sum(greatest(-x, 0))::BIGINT AS extra, count(*) FILTER (x <> 0) AS products_off FROM (SELECT coalesce(p.n, 0) - coalesce(q.n, 0) AS x
FROM (SELECT product_id, count(*) AS n FROM raw_clicks GROUP BY 1) p FULL JOIN (SELECT product_id, sum(event_count)::BIGINT AS n FROM trending GROUP BY 1) q USING (product_id))""")
def q_reconcile_counts(s, d):
    sent = v.raw_clicks(s, d).groupBy("product_id").agg(F.count("*").alias("n"))
    return h.reconcile(sent, v.trending_table(s, d).groupBy("product_id").agg(F.sum("event_count").alias("n")))


@query("""SELECT before, w AS window_start, gap FROM (SELECT *, date_diff('second', before, w) AS gap FROM (SELECT w, lag(w) OVER (ORDER BY w) AS before FROM (SELECT DISTINCT date_trunc('minute', event_time)::TIMESTAMP AS w FROM clicks))) WHERE gap > 600""")
def q_minute_gaps(s, d):
    w = v.clicks(s, d).select(F.date_trunc("MINUTE", F.col("event_time")).cast("timestamp_ntz").alias("window_start"))
    return h.minute_gaps(w, 600)


@query("""SELECT CASE WHEN date_diff('second', wr, wr + INTERVAL 60 SECOND) < 120 THEN 'ok' ELSE 'stale' END AS status, c.window_end AS window_end, date_diff('second', c.window_end, c.updated_at) AS lag_seconds, 60 AS staleness_seconds
FROM (SELECT max(updated_at) AS wr FROM written), (SELECT window_end, updated_at FROM written WHERE updated_at >= window_end ORDER BY 1 DESC, 2 DESC LIMIT 1) c""")
def q_pipeline_status(s, d):
    w = v.written_trending(s, d)
    return h.status(w, w.agg(F.max("updated_at") + F.expr("INTERVAL 60 SECONDS")).scalar()).withColumn("staleness_seconds", F.col("staleness_seconds").cast("int"))


@query("""WITH l AS (SELECT * FROM lags QUALIFY row_number() OVER (PARTITION BY query ORDER BY recorded_at DESC) = 1), n AS (SELECT max(recorded_at) AS now FROM lags),
g AS (SELECT query, coalesce(lag > 500 AND lag > before, FALSE) AS growing FROM (SELECT *, max(lag) OVER (PARTITION BY query ORDER BY t RANGE BETWEEN 43199 PRECEDING AND 21600 PRECEDING) AS before FROM lags) QUALIFY row_number() OVER (PARTITION BY query ORDER BY recorded_at DESC) = 1)
SELECT query, date_diff('second', recorded_at, now) > 120 AS stale, ms > 10000 AS slow_batch, growing AS lag_growing, (SELECT regr_slope(state, t::DOUBLE) FROM lags x WHERE x.query = l.query) > 0 AS state_growing FROM l JOIN g USING (query), n""")
def q_alerts(s, d):
    m = v.metrics(s, d)
    return h.alerts(h.latest_metrics(m), h.state_slope(m), h.lag_growing(m, 360, 500), m.agg(F.max("recorded_at")).scalar(), 10000, 0)


RULES = h.AlertRules(lag_floor=500, lag_back=21600, lag_for=21600, slow_for=43200, state_slope=0.0005, state_back=5 * 21600, state_for=21600, model_age=2 * 86400, model_for=86400, unusable_for=21600, fallback_back=43200, fallback_for=21600, gap=43200)


@query(f"""WITH newest_at AS (SELECT max(recorded_at) AS now FROM lags),
cond AS (SELECT 'lag_growing' AS alert, query AS series, t, coalesce(lag > {RULES.lag_floor} AND lag > before, FALSE) AS bad, {RULES.lag_for} AS hold FROM (SELECT *, max(lag) OVER (PARTITION BY query ORDER BY t RANGE BETWEEN {2 * RULES.lag_back - 1} PRECEDING AND {RULES.lag_back} PRECEDING) AS before FROM lags)
  UNION ALL SELECT 'slow_batch', query, t, ms > {RULES.slow_ms}, {RULES.slow_for} FROM lags
  UNION ALL SELECT 'state_growing', query, t, coalesce(slope > {RULES.state_slope}, FALSE), {RULES.state_for} FROM (SELECT query, t, regr_slope(state, t::DOUBLE) OVER (PARTITION BY query ORDER BY t RANGE BETWEEN {RULES.state_back - 1} PRECEDING AND CURRENT ROW) AS slope FROM lags)
  UNION ALL SELECT 'model_stale', 'ranker', i * 21600, epoch(recorded_at) - epoch(model_at) > {RULES.model_age}, {RULES.model_for} FROM ranker_log
  UNION ALL SELECT 'model_unusable', 'ranker', i * 21600, loaded AND NOT usable AND replay_recorded, {RULES.unusable_for} FROM ranker_log
  UNION ALL SELECT 'model_falling_back', 'ranker', t, usable AND sum(step) OVER (ORDER BY t RANGE BETWEEN {RULES.fallback_back - 1} PRECEDING AND CURRENT ROW) > 0, {RULES.fallback_for}
    FROM (SELECT usable, i * 21600 AS t, CASE WHEN lag(fallbacks) OVER (ORDER BY i) IS NULL THEN 0 WHEN fallbacks < lag(fallbacks) OVER (ORDER BY i) THEN fallbacks ELSE fallbacks - lag(fallbacks) OVER (ORDER BY i) END AS step FROM ranker_log)),
marked AS (SELECT *, CASE WHEN bad AND NOT coalesce(lag(bad) OVER w AND t - lag(t) OVER w <= {RULES.gap}, FALSE) THEN t END AS begun FROM cond WINDOW w AS (PARTITION BY alert, series ORDER BY t)),
states AS (SELECT *, CASE WHEN bad THEN max(begun) OVER (PARTITION BY alert, series ORDER BY t) END AS since FROM marked QUALIFY row_number() OVER (PARTITION BY alert, series ORDER BY t DESC) = 1)
SELECT alert, series, bad AS breached, make_timestamp(since::BIGINT * 1000000) AS since, coalesce(t - since >= hold, FALSE) AS firing FROM states
UNION ALL SELECT 'pipeline_stale', 'pipeline', s > {RULES.stale_after}, CASE WHEN s > {RULES.stale_after} THEN last_write + INTERVAL {RULES.stale_after} SECOND END, s >= {RULES.stale_after + RULES.stale_for} FROM (SELECT max(recorded_at) AS last_write, epoch(max(now))::BIGINT - epoch(max(recorded_at))::BIGINT AS s FROM lags, newest_at WHERE query = 'purchase')""")
def q_alert_states(s, d):
    """All seven alerts with hold times; the pipeline writes where the purchase query has a record."""
    m = v.metrics(s, d)
    writes = m.filter("query = 'purchase'").select(F.col("recorded_at").alias("updated_at"))
    return h.alert_states(m, v.ranker_log(s, d), writes, m.agg(F.max("recorded_at")).scalar(), RULES)


@query("SELECT max(window_start) AS window_start, max(window_end) AS window_end FROM trending, (SELECT max(event_time) AS now FROM clicks) WHERE window_end <= now")
def q_last_full_window(s, d):
    return h.last_full_window(v.trending_table(s, d), v.clicks(s, d).agg(F.max("event_time")).scalar())


# ---- scalar readings over real columns

@query("""SELECT event_id, (n * CASE unit WHEN 'seconds' THEN 1 WHEN 'minutes' THEN 60 WHEN 'hours' THEN 3600 ELSE 0 END)::BIGINT AS seconds FROM (SELECT event_id, product_id AS n, ['seconds', 'minutes', 'hours', 'fortnights'][event_id % 4 + 1] AS unit FROM raw_clicks)""")
def q_parse_duration(s, d):
    unit = F.element_at(F.array(*map(F.lit, ("seconds", "minutes", "hours", "fortnights"))), (F.col("event_id") % 4 + 1).cast("int"))
    return v.raw_clicks(s, d).select("event_id", x.duration_seconds(F.concat_ws(" ", "product_id", unit)).alias("seconds"))


@query("SELECT event_id, CASE WHEN product_id % 5 > 0 THEN (greatest(100 - product_id, 0) + greatest(50 - product_id, 0))::DOUBLE END AS behind FROM raw_clicks")
def q_offsets_behind(s, d):
    p = F.col("product_id").cast("string")
    done = F.when(F.col("product_id") % 5 > 0, F.concat(F.lit('{"t":{"0":'), p, F.lit(',"1":'), p, F.lit("}}"))).otherwise(F.concat(F.lit('{"t":{"0":'), p, F.lit("}}")))
    return v.raw_clicks(s, d).select("event_id", x.offsets_behind(done, F.lit('{"0":100,"1":50}'), "t").alias("behind"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN date_diff('second', o_orderdate, TIMESTAMP '2010-01-01 00:00:00') END AS age FROM orders")
def q_model_age(s, d):
    version = F.when(F.col("o_orderkey") % 3 > 0, F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss'Z'")).otherwise("v1")
    return v.table(s, d, "orders").select("o_orderkey", F.timestamp_diff("SECOND", x.model_time(version), F.lit("2010-01-01 00:00:00").cast("timestamp")).alias("age"))


QUERIES |= stream_queries.QUERIES
SQL |= stream_queries.SQL
