"""Tables that end a lineage, and rows dealt over range partitions that later steps can name."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side of a join is broadcast; such sides have one short row a key.
SMALL_ROWS = 100_000
#: For steps that end in files: what their shuffles wrote goes when the step is over, not when the driver happens to collect its garbage.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; set here only where it is unset and the session runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="ashlar-shared-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back."""
    path = f"{shared_dir(df.sparkSession)}/graph/{name}-{uuid.uuid4().hex}"
    with settings(df.sparkSession, TIDY):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows; else a shuffle joins it, whose skewed partitions Spark splits."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def ranged(df: DataFrame, keys: list[str | Column], name: str) -> DataFrame:
    """df as a table whose rows are dealt over range partitions of the keys; __part is the partition's number, in the keys' order.

    Rows of equal keys share a part."""
    return written(df.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()), name)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Inside, the session has these settings."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def spread(rows: DataFrame, key: str) -> DataFrame:
    """rows as they lie, or shuffled by a key where few tasks would hold most of them: a file of one block is read by one task."""
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    held = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("task")).count().collect()]  # a row a task; no column is read
    return rows if max(held, default=0) * tasks <= 4 * sum(held) else rows.repartition(tasks, key)
