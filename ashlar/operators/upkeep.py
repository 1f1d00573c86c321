"""Checks of a graph that follow its changes: what each id counts is kept as signed rows, a change appends its own, and issues are derived from
sums. So a change costs its own size and that of the counts of its ids, not another check of the graph.

A row of counts is (id, nodes, unnamed, sources, targets): how many nodes have an id, how many of these no name, and how many edges begin and end at
it. Sums do not depend on the order of changes. Appending is one Parquet job, whose commit makes its rows seen; compact() writes sums into a new folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import small

SCHEMA = "id string, nodes long, unnamed long, sources long, targets long"
SUMS = ("nodes", "unnamed", "sources", "targets")


def counts(nodes: DataFrame, relations: DataFrame) -> DataFrame:
    """Counts by id of nodes (id, name) and relations (source_node, target_node); where these have a column `sign`, 1 adds and -1 takes away. Null ids count as one id."""
    sign = lambda df: F.col("sign").cast("long") if "sign" in df.columns else F.lit(1).cast("long")
    zero = F.lit(0).cast("long")
    bare = F.coalesce(F.col("name"), F.lit("")) == ""
    of_nodes = nodes.select("id", sign(nodes).alias("nodes"), F.when(bare, sign(nodes)).otherwise(zero).alias("unnamed"), zero.alias("sources"), zero.alias("targets"))
    ends = F.array(F.struct(F.col("source_node").alias("id"), F.lit(True).alias("first")), F.struct(F.col("target_node").alias("id"), F.lit(False).alias("first")))
    flat = relations.select(sign(relations).alias("n"), F.explode(ends).alias("e"))
    of_edges = flat.select("e.id", zero.alias("nodes"), zero.alias("unnamed"), F.when(F.col("e.first"), F.col("n")).otherwise(zero).alias("sources"), F.when(F.col("e.first"), zero).otherwise(F.col("n")).alias("targets"))
    return summed(of_nodes.unionByName(of_edges))


def summed(rows: DataFrame) -> DataFrame:
    """One row for each id that counts anything; added up before it is shuffled."""
    whole = rows.groupBy("id").agg(*[F.sum(c).alias(c) for c in SUMS])
    return whole.where(" OR ".join(f"{c} <> 0" for c in SUMS))


def issues(known: DataFrame) -> DataFrame:
    """(node_id, check, severity, n): how many rows break each rule of graph.validate(), and nodes that no edge has (orphan, a warning)."""
    rules = {
        "duplicate_id": ("error", F.greatest(F.col("nodes") - 1, F.lit(0))), "missing_name": ("error", F.col("unnamed")),
        "dangling_source": ("error", F.when(F.col("nodes") == 0, F.col("sources")).otherwise(0)), "dangling_target": ("error", F.when(F.col("nodes") == 0, F.col("targets")).otherwise(0)),
        "orphan": ("warning", F.when(F.col("sources") + F.col("targets") == 0, F.col("nodes")).otherwise(0)),
    }
    broken = F.array(*[F.struct(F.lit(k).alias("check"), F.lit(severity).alias("severity"), n.cast("long").alias("n")) for k, (severity, n) in rules.items()])
    return known.select(F.col("id").alias("node_id"), F.explode(broken).alias("x")).select("node_id", "x.*").where("n > 0")


class GraphCounts:
    """The counts of a graph in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, nodes: DataFrame, relations: DataFrame) -> DataFrame:
        """Append a graph, or signed changes of one; returns the counts that were appended."""
        change = counts(nodes, relations)
        change.write.mode("append").parquet(self.path)
        return change

    def counts(self, ids: DataFrame | None = None) -> DataFrame:
        """All counts, or those of some ids (one column)."""
        rows = self.spark.read.schema(SCHEMA).parquet(self.path)
        if ids is not None:
            asked = small(ids.toDF("asked").distinct())
            rows = rows.join(asked, F.col("id").eqNullSafe(F.col("asked")), "left_semi")
        return summed(rows)

    def issues(self, ids: DataFrame | None = None) -> DataFrame:
        """The issues of the whole graph, or those of the ids of a change: these replace what was known of them."""
        return issues(self.counts(ids))

    def compact(self, path: str) -> GraphCounts:
        """The same counts, one row an id, in a new folder."""
        self.counts().write.parquet(path)
        return GraphCounts(self.spark, path)
