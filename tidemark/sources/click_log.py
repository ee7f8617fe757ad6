"""Click-log files: reading, normalising, time span, latest attributes, catalogue, checks and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import LOG_EVENTS

EVENT_COLUMNS = ("timestamp", "visitorid", "event", "itemid", "transactionid")
PROPERTY_COLUMNS = ("timestamp", "itemid", "property", "value")


def read_csv(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """All columns as strings; refuses a file without one of `columns`."""
    df = spark.read.option("header", True).csv(path)
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return df


def normalise_log(log: DataFrame) -> DataFrame:
    """visitor, item, event_type, at (epoch seconds) from string columns; unknown names and unreadable rows go."""
    names = F.create_map(*(F.lit(x) for kv in LOG_EVENTS.items() for x in kv))
    out = log.select(
        F.col("visitorid").try_cast("long").alias("visitor"),
        F.col("itemid").try_cast("long").alias("item"),
        names[F.trim("event")].alias("event_type"),
        (F.col("timestamp").try_cast("long") / 1000).alias("at"),
    )
    return out.dropna()


def time_span(log: DataFrame) -> DataFrame:
    """First and last time in one scan; files are not in time order."""
    return log.agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))


def latest_property(properties: DataFrame, name: str = "categoryid") -> DataFrame:
    """item, value of the latest row of one property; of equal times the least value."""
    newest = F.max(F.struct("at", F.struct((-F.col("value")).alias("minus"), "value"))).alias("x")
    return properties.filter(F.col("property") == name).groupBy("item").agg(newest).select("item", F.col("x.col2.value").alias("value"))


def build_catalog(items: DataFrame, categories: DataFrame) -> DataFrame:
    """id, name, price, category for every different item; categories is (item, value)."""
    known = categories.select(F.col("item").alias("id"), F.col("value").alias("of"))
    return (
        items.select(F.col("item").alias("id")).distinct().join(known, "id", "left")
        .select("id", F.concat(F.lit("Item "), F.col("id").cast("string")).alias("name"), F.lit(None).cast("long").alias("price"), F.coalesce(F.concat(F.lit("cat-"), F.col("of").cast("string")), F.lit("uncategorised")).alias("category"))
    )


def catalog_gap(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """Items that the catalogue lacks; none means that it needn't be written again."""
    return items.select(F.col("item").alias("id")).distinct().join(catalog.select("id"), "id", "left_anti")


def catalog_problems(catalog: DataFrame) -> DataFrame:
    """problem, n: ids that repeat and rows that lack an id, name or category."""
    repeats = catalog.groupBy("id").count().filter("count > 1 and id is not null")
    lacking = catalog.filter("id is null or name is null or category is null")
    return repeats.agg(F.count("*").alias("n")).select(F.lit("repeated_id").alias("problem"), "n").unionByName(lacking.agg(F.count("*").alias("n")).select(F.lit("missing_value").alias("problem"), "n"))


def category_tree(rows: DataFrame) -> DataFrame:
    """category, parent as names; a blank parent is null."""
    name = lambda c: F.concat(F.lit("cat-"), F.nullif(F.trim(c), F.lit("")))
    return rows.select(name(F.col("categoryid")).alias("category"), name(F.col("parentid")).alias("parent"))


def dataset_summary(log: DataFrame) -> DataFrame:
    """One row: usable events, different visitors and items, events by type, first, last, days."""
    return log.agg(
        F.count("*").alias("events"), F.countDistinct("visitor").alias("visitors"), F.countDistinct("item").alias("items"),
        F.count_if(F.col("event_type") == "view").alias("views"), F.count_if(F.col("event_type") == "add_to_cart").alias("carts"), F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.round((F.max("at") - F.min("at")) / 86400, 1).alias("days"),
    )


def row_counts(tables: dict[str, DataFrame], least: dict[str, int], columns: dict[str, tuple[str, ...]]) -> DataFrame:
    """name, n, ok: whether each table has its columns and at least so many rows."""
    out = None
    for name, df in tables.items():
        has = not set(columns.get(name, ())) - set(df.columns)
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n", ((F.col("n") >= least.get(name, 1)) & F.lit(has)).alias("ok"))
        out = row if out is None else out.unionByName(row)
    return out


def write_summary(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A result as CSV with header or as JSON lines."""
    (df.write.option("header", True).csv if kind == "csv" else df.write.json)(path)


def append_run(spark: SparkSession, path: str, start_day: str, days: float, finished_at: str) -> None:
    """Adds a run to the manifest at `path`; runs are never changed."""
    kinds = "start_day string, days double, finished_at string"
    spark.createDataFrame([(start_day, float(days), finished_at)], kinds).coalesce(1).write.mode("append").parquet(path)


def newest_first(runs: DataFrame, by: str = "finished_at") -> DataFrame:
    """The latest run of a manifest, one row."""
    return runs.orderBy(F.col(by).desc()).limit(1)


