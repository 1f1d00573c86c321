"""What the training-data operators share: the shared folder, written tables, size-checked
broadcasts, distributed row numbers and connected components."""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows up to which a side of a join is broadcast; rows are a few short columns each.
BROADCAST_ROWS = 200_000
#: A key is heavy if it has more rows than this, and more than such a part of all rows.
HEAVY_ROWS, HEAVY_SHARE = 1000, 20_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    It is set here only where it is unset and the session runs in one process (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="ashlar-shared-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


_scratch: list[list[str]] = []


def write_table(df: DataFrame, name: str, keep: bool = False, **options: str) -> tuple[DataFrame, str]:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor
    costs nothing that is in the table. Inside scratch() the table goes at its end, or, if kept, at that of the one around it."""
    spark, path = df.sparkSession, table_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    if len(_scratch) > keep:
        _scratch[-1 - keep].append(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def byte_batches(spark: SparkSession, size: str = "4m"):
    """Inside, rows go to Python in batches of about so many bytes (a longer row by itself); Spark's own limit of 10,000 rows is tens
    of MB of text, which the task's JVM and its Python both hold."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def drop_table(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession, *paths: str) -> None:
    """Delete tables, and let Spark's cleaner find the shuffle files of steps that are over: it waits for the driver's
    garbage collection, which a driver with little to do puts off."""
    for path in paths:
        drop_table(spark, path)
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def scratch(spark: SparkSession):
    """Tables that are written inside, and not kept, are deleted at the end."""
    paths: list[str] = []
    _scratch.append(paths)
    try:
        yield
    finally:
        _scratch.pop()
        release(spark, *paths)


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most so many rows."""
    return df.limit(rows + 1).count() <= rows


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows, else df itself (a shuffled join)."""
    return F.broadcast(df) if fits(df, rows) else df


def keyed_join(rows: DataFrame, side: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """rows joined with `side`, which has one row of a few short columns for each key, without a task that
    holds a key's rows. `how`: inner, left, left_semi or left_anti.

    A small side is broadcast. Else the keys that hold over HEAVY_ROWS and over a HEAVY_SHARE-th of all rows, of
    which there are fewer than HEAVY_SHARE, are broadcast, and only the rows of other keys are shuffled. `rows`
    is read several times, so it should be a table."""
    if fits(side):
        return rows.join(F.broadcast(side), key, how)
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    least = max(HEAVY_ROWS, rows.count() // HEAVY_SHARE)
    heavy, _ = write_table(counts.where(F.col("__n") > least).select(*key), "heavy")
    part = rows.join(F.broadcast(heavy.withColumn("__heavy", F.lit(True))), key, "left")
    few = side.join(F.broadcast(heavy), key, "left_semi")  # one row a heavy key at most
    rest = part.where("__heavy IS NULL").drop("__heavy").join(side, key, how)
    return rest.unionByName(part.where("__heavy").drop("__heavy").join(F.broadcast(few), key, how))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; texts of ASCII only take the fast way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def fold(column: str, modulus: int) -> Column:
    """crc32 of the id's text, modulo; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def numbered(df: DataFrame, groups: list[str], order: list[Column], name: str, buckets: int = 256) -> DataFrame:
    """A gapless number from 0 for the rows of each group, without a task that holds a whole group.

    The rows of a group are dealt to buckets by `__bucket` (a column of df, 0 to buckets - 1); each
    bucket is numbered by itself and shifted by the counts of the buckets before it, of which
    there are groups x buckets rows only. The columns in `groups` have a small, fixed number of values."""
    counts = df.groupBy(*groups, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*groups).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*groups, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    inside = Window.partitionBy(*groups, "__bucket").orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(inside).cast("long") - 1)
    return ranked.join(F.broadcast(shift), [*groups, "__bucket"]).withColumn(name, F.col("__rank") + F.col("__shift")).drop("__rank", "__shift")


def components(edges: DataFrame, a: str, b: str, rounds: int | None = None) -> DataFrame:
    """Connected components as (node, label): label is the smallest node of the component.

    Alternates large-star and small-star steps until nothing changes; every step is a grouped minimum and a
    join back, written to the shared folder, so neither links nor components reach the driver. A node with very
    many links is joined apart (keyed_join). With `rounds`, an error is raised where that many don't suffice."""
    spark = edges.sparkSession
    now, path = write_table(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges"
    )
    mark, done = None, 0
    while True:
        both, both_path = write_table(now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        low, low_path = write_table(low, "low")
        large = keyed_join(both.where("v > u"), low, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large_t, large_path = write_table(large, "large")
        low, low2_path = write_table(large_t.groupBy("u").agg(F.min("v").alias("m")), "low")
        linked = keyed_join(large_t, low, ["u"]).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        after, after_path = write_table(linked.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        for old in (path, both_path, low_path, large_path, low2_path):
            drop_table(spark, old)
        now, path = after, after_path
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        mark, done = seen, done + 1
        if rounds is not None and done > rounds:
            raise RuntimeError(f"components have not converged after {rounds} rounds")
