"""Prints one JSON line with the seconds of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]."""

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "parse_events", "reject_reasons", "trending_window", "trending_lookback", "co_occurrence", "basket_pairs", "related_affinity", "related_lift", "related_with_fill",
    "graph_edges", "sessionise", "visit_items", "visit_profile", "ranker_snapshot", "two_hop", "candidates", "similar_items", "hit_rate", "latest_metrics", "reconcile_counts", "stream_trending",
)


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    tmp = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    conf = {
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC",
        "spark.local.dir": tmp, "spark.checkpoint.dir": f"file://{tmp}/shared", "spark.sql.warehouse.dir": f"{tmp}/warehouse",
    }
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    from tidemark.plans.queries import QUERIES

    spark.read.parquet(f"{folder}/events.parquet").write.format("noop").mode("overwrite").save()  # starts the executors
    seconds = {}
    for name in HEADLINE:
        began = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    from tidemark.plans.stream_queries import trending_rate

    stream = trending_rate(spark, folder)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")), "stream": stream}))
    spark.stop()


if __name__ == "__main__":
    main()
