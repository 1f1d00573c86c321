"""Incremental ingestion: only files that were not seen before are read, in one run that then ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def ingest_new(spark: SparkSession, landing: str, schema: str, target: str, checkpoint: str, transform=None) -> None:
    """Read what is new in a landing folder of JSON files into a Parquet table, exactly once."""
    rows: DataFrame = spark.readStream.schema(schema).option("multiLine", True).json(landing)
    rows = rows if transform is None else transform(rows)
    rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def skip_existing(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items that are not completed yet."""
    return items.join(done.where("status = 'COMPLETED'").select(key).distinct(), key, "left_anti")


def resume(pages: DataFrame, target: str, work, keys: tuple[str, ...] = ("book", "page"), again: bool = False) -> DataFrame:
    """The table at target, after work(pages) of those pages (by their keys, nulls included) that it lacks was appended to it; with `again`, a page whose rows
    have status FAILED counts as lacking, too, and its old rows stay beside the new ones. A run that was lost adds nothing, so the next one starts where the last whole one ended.

    work takes and returns rows with the keys; pages that it returns nothing for are tried again the next time."""
    from pyspark.errors import AnalysisException

    spark = pages.sparkSession
    try:
        done = spark.read.parquet(target)
    except AnalysisException:  # nothing there yet
        done = None
    left = pages
    if done is not None:
        kept = done.where("status IS NULL OR status <> 'FAILED'") if again else done
        named = kept.select(*[kept[k].alias(f"__{k}") for k in keys]).distinct()
        on = [pages[k].eqNullSafe(named[f"__{k}"]) for k in keys]
        left = pages.join(named, on, "left_anti")
    work(left).write.mode("append").parquet(target)
    return spark.read.parquet(target)
