"""Tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir; /tmp/checkpoints in local mode where that is unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "/tmp/checkpoints"  # one machine, as in tests
    return f"{shared}/{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """df written as Parquet and read back, so that what follows depends on a table alone."""
    path = path or shared_folder(df.sparkSession)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def together(*makes: Callable[[], DataFrame]) -> list[DataFrame]:
    """What each of several functions returns; the jobs that they start run beside each other."""
    with ThreadPoolExecutor(len(makes)) as pool:
        return [f.result() for f in [pool.submit(make) for make in makes]]
