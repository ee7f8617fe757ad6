"""The engine's inputs over the given tables, and the same views as DuckDB SQL.

clicks: shop events without sessions; signup and error are unknown types. baskets: order lines as
sessions of supplier products. wire: events as JSON bytes in both versions, some of them damaged.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import event_weight
from tidemark.operators.aggregates import co_occurrence, mirror_pairs, trending
from tidemark.schema import WEIGHTS

GAP, WINDOW, LOOKBACK, VISIT_GAP = "24 HOURS", "1 day", 7 * 24 * 60, 720
EPOCH = "timestamp_ntz'1970-01-01'"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def raw_clicks(spark: SparkSession, d: str) -> DataFrame:
    k = F.regexp_extract("props", r'"k": (\d+)', 1).cast("long")
    return table(spark, d, "events").select("event_id", F.lit(None).cast("string").alias("session_id"), "user_id", k.alias("product_id"), "event_type", F.col("ts").alias("event_time"), event_weight(F.col("event_type")).alias("weight"))


def clicks(spark: SparkSession, d: str) -> DataFrame:
    return raw_clicks(spark, d).filter(F.col("event_type").isin(*WEIGHTS))


def baskets(spark: SparkSession, d: str, product: str = "l_suppkey") -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", product, "l_linenumber", "l_returnflag", "l_shipdate")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    kind = F.when(F.col("l_returnflag") == "N", "view").when(F.col("l_returnflag") == "A", "add_to_cart").otherwise("purchase")
    return lines.join(orders, "l_orderkey").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"), F.col("l_orderkey").cast("string").alias("session_id"), F.col("o_custkey").alias("user_id"),
        F.col(product).alias("product_id"), kind.alias("event_type"), F.col("l_shipdate").alias("event_time"), event_weight(kind).alias("weight"),
    )


def click_catalog(spark: SparkSession, d: str) -> DataFrame:
    """id, name, price, category, parent of the clicked products; one category is uncategorised."""
    ids = raw_clicks(spark, d).select(F.col("product_id").alias("id")).distinct()
    c = F.col("id") % 10
    category = F.when(c == 9, "uncategorised").otherwise(F.concat(F.lit("cat-"), c.cast("string")))
    parent = F.when(c < 9, F.concat(F.lit("up-"), (c % 3).cast("string")))
    return ids.select("id", F.concat(F.lit("Item "), F.col("id").cast("string")).alias("name"), F.lit(None).cast("long").alias("price"), category.alias("category"), parent.alias("parent"))


def supplier_catalog(spark: SparkSession, d: str) -> DataFrame:
    """id, name, price, category (nation), parent (region) of suppliers."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit(None).cast("long").alias("price"), F.col("n_name").alias("category"), F.col("r_name").alias("parent"))


def trending_table(spark: SparkSession, d: str) -> DataFrame:
    return trending(clicks(spark, d), WINDOW, exact=True)


def pair_table(spark: SparkSession, d: str) -> DataFrame:
    return mirror_pairs(co_occurrence(clicks(spark, d), GAP, WINDOW, exact=True))


def log(spark: SparkSession, d: str) -> DataFrame:
    """Clicks as a click log (visitor, at, item, event_type, event_id): searches and clicks count as views."""
    kind = F.when(F.col("event_type") == "click", "add_to_cart").otherwise(F.col("event_type"))
    return clicks(spark, d).select(F.col("user_id").alias("visitor"), F.expr(f"timestampdiff(SECOND, {EPOCH}, event_time)").cast("double").alias("at"), F.col("product_id").alias("item"), kind.alias("event_type"), "event_id")


def log_csv(spark: SparkSession, d: str) -> DataFrame:
    """The events as the string columns of a click-log file, with odd spellings."""
    e = raw_clicks(spark, d)
    name = F.when(F.col("event_type") == "click", " addtocart ").when(F.col("event_type") == "purchase", "transaction").otherwise(F.col("event_type"))
    at = F.expr(f"timestampdiff(SECOND, {EPOCH}, event_time) * 1000")
    visitor = F.when(F.col("event_id") % 50 == 0, "x").otherwise(F.col("user_id").cast("string"))
    return e.select(at.cast("string").alias("timestamp"), visitor.alias("visitorid"), name.alias("event"), F.col("product_id").cast("string").alias("itemid"), F.lit(None).cast("string").alias("transactionid"))


def wire(spark: SparkSession, d: str) -> DataFrame:
    """(value binary, event_id) of every event: odd ids in version 2, some damaged."""
    e = raw_clicks(spark, d).withColumn("timestamp", F.expr(f"cast(timestampdiff(SECOND, {EPOCH}, event_time) as double)"))
    i = F.col("event_id")
    version = F.when(i % 31 == 0, 99).when(i % 2 == 1, 2).cast("int")
    old = i % 2 == 0
    fields = F.struct(
        version.alias("schema_version"), i.cast("string").alias("event_id"), F.when(i % 29 != 0, F.col("user_id")).alias("user_id"), F.when(i % 37 != 0, F.col("product_id")).alias("product_id"),
        F.when(old, F.col("event_type")).alias("event_type"), F.when(~old, F.col("event_type")).alias("action"), F.when(~old, "web").alias("channel"), F.when(i % 41 != 0, F.col("timestamp")).alias("timestamp"),
    )
    return e.select(F.when(i % 23 == 0, "not json at all").otherwise(F.to_json(fields)).cast("binary").alias("value"), "event_id")


def metrics(spark: SparkSession, d: str) -> DataFrame:
    """A metrics table: each event type is a query and each six hours a batch; some lags are unknown."""
    e = raw_clicks(spark, d)
    at = F.expr(f"timestampadd(SECOND, timestampdiff(SECOND, {EPOCH}, event_time) div 21600 * 21600, {EPOCH})")
    g = e.groupBy(F.col("event_type").alias("query"), at.alias("recorded_at")).agg(F.count("*").alias("input_rows"), F.sum("product_id").alias("k"), F.countDistinct("user_id").alias("u"), F.max("product_id").alias("m"))
    lag = F.array((F.col("k") % 50 * 40).cast("double"), F.when(F.col("m") % 2 == 0, F.col("k").cast("double")))
    return g.select("query", "recorded_at", F.expr(f"timestampdiff(SECOND, {EPOCH}, recorded_at) div 21600").alias("batch_id"), "input_rows", (F.col("k") * 10).alias("batch_duration_ms"), F.array("input_rows", "u").alias("state_rows"), lag.alias("kafka_lag"))


def ranker_log(spark: SparkSession, d: str) -> DataFrame:
    """A ranker's records, one for each six hours of events: a model every tenth day, and a count of fallbacks (errors) that starts anew each day."""
    at = F.expr(f"timestampdiff(SECOND, {EPOCH}, event_time) div 21600")
    g = raw_clicks(spark, d).groupBy(at.alias("i")).agg(F.count_if(F.col("event_type") == "error").alias("errors"), F.sum("product_id").alias("k"))
    time = lambda i: F.expr(f"timestampadd(SECOND, ({i}) * 21600, {EPOCH})")
    day = Window.partitionBy(F.floor(F.col("i") / 4)).orderBy("i")
    return g.select(time("i").alias("recorded_at"), time("i div 40 * 40").alias("model_at"), (F.col("k") % 11 != 0).alias("loaded"), (F.floor(F.col("i") / 6) % 3 != 1).alias("usable"), (F.col("k") % 13 != 0).alias("replay_recorded"), F.sum("errors").over(day).alias("fallbacks"))


def written_trending(spark: SparkSession, d: str) -> DataFrame:
    """The trending table with write times: 4 s after a window's end, or before it for products that end in 7."""
    return trending_table(spark, d).withColumn("updated_at", F.expr("timestampadd(SECOND, if(product_id % 10 = 7, -30, 4), window_end)"))


K = "regexp_extract(props, '\"k\": (\\d+)', 1)::BIGINT"
W = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in WEIGHTS.items()) + " ELSE 0.0::DOUBLE END"
TYPES = ", ".join(f"'{k}'" for k in WEIGHTS)

CTES = {
    "raw_clicks": f"SELECT event_id, user_id, {K} AS product_id, event_type, ts AS event_time, {W} AS weight FROM events",
    "clicks": f"SELECT *, 'u' || user_id AS session FROM raw_clicks WHERE event_type IN ({TYPES})",
    "baskets": """SELECT l_orderkey || '-' || l_linenumber AS event_id, l_orderkey AS session, o_custkey AS user_id, l_suppkey AS product_id, l_partkey, l_shipdate AS event_time,
                  CASE l_returnflag WHEN 'N' THEN 'view' WHEN 'A' THEN 'add_to_cart' ELSE 'purchase' END AS event_type, CASE l_returnflag WHEN 'N' THEN 1.0::DOUBLE WHEN 'A' THEN 3.0::DOUBLE ELSE 5.0::DOUBLE END AS weight
                  FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "click_catalog": """SELECT DISTINCT product_id AS id, 'Item ' || product_id AS name, NULL::BIGINT AS price, CASE WHEN product_id % 10 = 9 THEN 'uncategorised' ELSE 'cat-' || (product_id % 10) END AS category,
                  CASE WHEN product_id % 10 < 9 THEN 'up-' || (product_id % 10 % 3) END AS parent FROM raw_clicks""",
    "supplier_catalog": "SELECT s_suppkey AS id, s_name AS name, NULL::BIGINT AS price, n_name AS category, r_name AS parent FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "trending": """SELECT date_trunc('day', event_time)::TIMESTAMP AS window_start, date_trunc('day', event_time)::TIMESTAMP + INTERVAL 1 DAY AS window_end, product_id, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
                  count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'add_to_cart') AS carts, count(*) FILTER (event_type = 'purchase') AS purchases, round(sum(weight), 3) AS score FROM clicks GROUP BY ALL""",
    "edges": """SELECT date_trunc('day', l.event_time)::TIMESTAMP AS window_start, date_trunc('day', l.event_time)::TIMESTAMP + INTERVAL 1 DAY AS window_end, l.product_id, r.product_id AS related_product_id, count(*) AS pair_count,
                  round(sum(sqrt(l.weight * r.weight)), 3) AS affinity, count(DISTINCT l.user_id) AS unique_users
                  FROM clicks l JOIN clicks r ON l.session = r.session AND l.product_id < r.product_id AND r.event_time BETWEEN l.event_time - INTERVAL 24 HOUR AND l.event_time + INTERVAL 24 HOUR GROUP BY ALL""",
    "pairs": "SELECT * FROM edges UNION ALL SELECT window_start, window_end, related_product_id, product_id, pair_count, affinity, unique_users FROM edges",
    "newest": "SELECT max(window_end) AS newest FROM trending",
    "cut": f"SELECT newest - INTERVAL {LOOKBACK} MINUTE AS cutoff FROM newest",
    "counts": "SELECT product_id, sum(event_count)::BIGINT AS events, (SELECT sum(event_count)::BIGINT FROM trending, cut WHERE window_start >= cutoff) AS total FROM trending, cut WHERE window_start >= cutoff GROUP BY 1",
    "summed": "SELECT product_id, related_product_id, round(sum(affinity), 3) AS affinity, sum(pair_count)::BIGINT AS pair_count, max(unique_users) AS peak_users_per_window FROM pairs, cut WHERE window_start >= cutoff GROUP BY 1, 2 HAVING sum(pair_count) >= 3",
    "scored": """SELECT s.*, CASE WHEN coalesce(a.total, 0) > 0 AND coalesce(a.events, 0) > 0 AND coalesce(b.events, 0) > 0 THEN (pair_count / a.total::DOUBLE) / ((a.events / a.total::DOUBLE) * (b.events / a.total::DOUBLE)) END AS lift,
                  row_number() OVER (PARTITION BY s.product_id ORDER BY affinity DESC, related_product_id) - 1 AS by_affinity FROM summed s LEFT JOIN counts a ON a.product_id = s.product_id LEFT JOIN counts b ON b.product_id = s.related_product_id""",
    "log": f"SELECT user_id AS visitor, epoch(date_trunc('second', event_time))::BIGINT::DOUBLE AS at, product_id AS item, CASE WHEN event_type = 'click' THEN 'add_to_cart' ELSE event_type END AS event_type, event_id FROM clicks",
    "visits0": f"SELECT *, sum(new) OVER (PARTITION BY visitor ORDER BY at, event_id)::BIGINT AS visit FROM (SELECT *, CASE WHEN at - lag(at) OVER (PARTITION BY visitor ORDER BY at, event_id) <= {VISIT_GAP * 60} THEN 0 ELSE 1 END AS new FROM log)",
    "visits": "SELECT * EXCLUDE (new), min(at) OVER (PARTITION BY visitor, visit) AS started_at, (row_number() OVER (PARTITION BY visitor, visit ORDER BY at, event_id) - 1)::BIGINT AS seq FROM visits0",
    "items": "SELECT visitor, visit, list(item ORDER BY seq) AS items FROM (SELECT visitor, visit, item, min(seq) AS seq FROM visits GROUP BY ALL) GROUP BY ALL",
    "cases": "SELECT visitor || '-' || visit AS \"case\", items[1] AS query, items[2] AS target, items[2:] AS later FROM items WHERE len(items) > 1",
    "near": "SELECT product_id AS query, related_product_id AS item, sum(pair_count)::DOUBLE AS n FROM pairs WHERE product_id <> related_product_id GROUP BY ALL",
    "ranked_near": "SELECT *, row_number() OVER (PARTITION BY query ORDER BY n DESC, item) - 1 AS rank FROM near",
    "hops": "SELECT a.query, b.item, sum(a.n * b.n) AS score FROM ranked_near a JOIN ranked_near b ON b.query = a.item WHERE a.rank < 10 AND b.rank < 10 AND b.item <> a.query GROUP BY ALL",
    "snap": """SELECT product_id AS id, sum(views)::DOUBLE AS views, sum(CASE WHEN window_start >= z - (z - a) * 0.1 THEN views ELSE 0 END)::DOUBLE AS recent, sum(carts)::DOUBLE AS carts, sum(purchases)::DOUBLE AS buys
                  FROM trending, (SELECT min(window_start) AS a, max(window_start) AS z FROM trending) GROUP BY 1""",
    "mass": "SELECT product_id AS id, sum(pair_count)::DOUBLE AS mass, (SELECT coalesce(nullif(sum(pair_count) / 2, 0), 1)::DOUBLE FROM pairs) AS total FROM pairs GROUP BY 1",
    "cat_top": "SELECT * FROM (SELECT category AS grp, id AS item, row_number() OVER (PARTITION BY category ORDER BY views DESC, id) - 1 AS rank FROM snap JOIN click_catalog USING (id) WHERE category <> 'uncategorised') WHERE rank < 30",
    "up_top": "SELECT * FROM (SELECT parent AS grp, id AS item, row_number() OVER (PARTITION BY parent ORDER BY views DESC, id) - 1 AS rank FROM snap JOIN click_catalog USING (id) WHERE parent IS NOT NULL) WHERE rank < 30",
    "unit": "SELECT vec_id AS id, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y * y)))) AS v FROM embeddings WHERE vec_id IN (SELECT id FROM click_catalog)",
    "alike": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY cos DESC, item) - 1 AS rank FROM (SELECT a.id AS query, b.id AS item, round(list_dot_product(a.v, b.v), 6) AS cos FROM unit a JOIN unit b ON a.id <> b.id)) WHERE rank < 30",
    "pool": """SELECT c.id AS query, x.item, x.rank, x.source FROM click_catalog c JOIN (
                  SELECT query, item, rank, 0 AS source FROM ranked_near WHERE rank < 30
                  UNION ALL SELECT id, item, rank, 1 FROM click_catalog JOIN cat_top ON grp = category
                  UNION ALL SELECT query, item, rank, 2 FROM alike
                  UNION ALL SELECT id, item, rank, 3 FROM click_catalog JOIN up_top ON grp = parent
                  UNION ALL SELECT query, item, row_number() OVER (PARTITION BY query ORDER BY score DESC, item) - 1, 4 FROM hops QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, item) <= 30
                  UNION ALL SELECT c.id, b.id, b.rank, 5 FROM click_catalog c, (SELECT id, row_number() OVER (ORDER BY views DESC, id) - 1 AS rank FROM snap QUALIFY row_number() OVER (ORDER BY views DESC, id) <= 10) b) x ON x.query = c.id WHERE x.item <> c.id""",
    "cands": "SELECT query, item, source, row_number() OVER (PARTITION BY query ORDER BY source, rank) - 1 AS place FROM (SELECT * FROM pool QUALIFY row_number() OVER (PARTITION BY query, item ORDER BY source, rank) = 1)",
    "metrics": """SELECT event_type AS query, make_timestamp((epoch(date_trunc('second', event_time))::BIGINT // 21600) * 21600 * 1000000) AS recorded_at, count(*) AS input_rows, sum(product_id)::BIGINT AS k, count(DISTINCT user_id) AS u, max(product_id) AS m FROM raw_clicks GROUP BY ALL""",
    "lags": "SELECT *, greatest((k % 50 * 40)::DOUBLE, CASE WHEN m % 2 = 0 THEN k::DOUBLE END) AS lag, (input_rows + u)::DOUBLE AS state, k * 10 AS ms, epoch(recorded_at)::BIGINT AS t FROM metrics",
    "ranker_log": """SELECT i, make_timestamp(i * 21600 * 1000000) AS recorded_at, make_timestamp(i // 40 * 40 * 21600 * 1000000) AS model_at, k % 11 <> 0 AS loaded, i // 6 % 3 <> 1 AS usable, k % 13 <> 0 AS replay_recorded, sum(errors) OVER (PARTITION BY i // 4 ORDER BY i)::BIGINT AS fallbacks
                  FROM (SELECT epoch(date_trunc('second', event_time))::BIGINT // 21600 AS i, count(*) FILTER (event_type = 'error') AS errors, sum(product_id)::BIGINT AS k FROM raw_clicks GROUP BY 1)""",
    "written": "SELECT *, window_end + CASE WHEN product_id % 10 = 7 THEN -30 ELSE 4 END * INTERVAL 1 SECOND AS updated_at FROM trending",
}
_USES = {name: [other for other in CTES if other != name and re.search(rf"\b{other}\b", sql)] for name, sql in CTES.items()}


def sql(body: str, more: str = "") -> str:
    """A query after the views that it and `more` (further WITH entries) use, in the order above."""
    wanted, todo = set(), [n for n in CTES if re.search(rf"\b{n}\b", body + more)]
    while todo:
        n = todo.pop()
        if n not in wanted:
            wanted.add(n)
            todo += _USES[n]
    views = [f"{n} AS ({CTES[n]})" for n in CTES if n in wanted] + [more] * bool(more)
    if body.startswith("WITH "):
        views.append(body[5:])
        body = ""
    out = ("WITH " + ",\n".join(views) + "\n" if views else "") + body
    return re.sub(r"\bat\b", '"at"', out)  # a keyword there
