"""Connected components of a table of links, by least labels that jump."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that can be reached over links (a, b), for every node that has one.

    Each round a node takes the least label among its own and its neighbours', then that label's label;
    labels are staged, so a round depends on tables alone. It ends when no label changes. Links with a
    null end are left out; without links the result is empty.
    """
    ends = links.select("a", "b").filter("a is not null and b is not null and a <> b")
    ends = staged(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = staged(ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component"), F.lit(True).alias("changed")))
    while not labels.filter("changed").isEmpty():
        own = labels.select("node", "component")
        near = ends.join(own.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        nearer = own.join(near, "node").select("node", "component", F.least("component", "near").alias("label"))
        of_label = own.select(F.col("node").alias("label"), F.col("component").alias("beyond"))
        labels = nearer.join(of_label, "label").select("node", F.least("label", "beyond").alias("component"), (F.least("label", "beyond") < F.col("component")).alias("changed"))
        labels = staged(labels)
    return labels.select("node", "component")
