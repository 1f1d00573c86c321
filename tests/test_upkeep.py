"""Counts that follow changes against a full check of the graph."""

import random

from pyspark.sql import functions as F

from ashlar.operators import graph as G
from ashlar.operators import upkeep as U

NODE, EDGE = "id string, name string, sign int, ord long", "source_node string, target_node string, sign int"


def whole(spark, nodes, edges):
    """The issues by the operators that read the whole graph, counted."""
    n = spark.createDataFrame([(*x, 1, i) for i, x in enumerate(nodes)], NODE)
    e = spark.createDataFrame([(*x, 1) for x in edges], EDGE)
    found = G.validate(n, e).unionByName(G.orphans(n, e).select(F.col("id").alias("node_id"), F.lit("orphan").alias("check"), F.lit("warning").alias("severity"), F.lit("").alias("message")))
    return sorted((r["node_id"], r["check"], r["severity"], r["n"]) for r in found.groupBy("node_id", "check", "severity").agg(F.count(F.lit(1)).alias("n")).collect())


def test_issues_follow_random_changes(spark, tmp_path):
    draw = random.Random(4)
    ids = [f"n{i}" for i in range(25)]
    nodes = [(draw.choice(ids), draw.choice(["x", "", None])) for _ in range(30)]
    edges = [(draw.choice(ids), draw.choice(ids)) for _ in range(40)] + [("hub", "n1")] * 30
    book = U.GraphCounts(spark, "file://" + str(tmp_path / "a"))
    row = lambda rows, sign: [(*x, sign) for x in rows]
    as_nodes = lambda rows: spark.createDataFrame([(*x, 0) for x in rows], NODE)
    book.add(as_nodes(row(nodes, 1)), spark.createDataFrame(row(edges, 1), EDGE))
    key = lambda df: sorted((r["node_id"], r["check"], r["severity"], r["n"]) for r in df.collect())
    known = key(book.issues())
    for _ in range(3):
        gone_n, gone_e = [nodes.pop(draw.randrange(len(nodes))) for _ in range(8)], [edges.pop(draw.randrange(len(edges))) for _ in range(15)]
        new_n, new_e = [(draw.choice(ids), draw.choice(["y", ""])) for _ in range(9)], [(draw.choice(ids), draw.choice(ids)) for _ in range(6)]
        nodes, edges = nodes + new_n, edges + new_e
        change = book.add(as_nodes(row(gone_n, -1) + row(new_n, 1)), spark.createDataFrame(row(gone_e, -1) + row(new_e, 1), EDGE))
        touched = change.select("id")
        ids_of = {r["id"] for r in touched.collect()}
        known = sorted([x for x in known if x[0] not in ids_of] + key(book.issues(touched)))  # what a change says replaces what was known
        assert known == key(book.issues()) == whole(spark, nodes, edges)
    again = book.compact("file://" + str(tmp_path / "b"))
    assert key(again.issues()) == known and again.counts().count() == spark.read.parquet(again.path).count()


def test_null_ids_and_empty_graphs(spark, tmp_path):
    book = U.GraphCounts(spark, "file://" + str(tmp_path / "c"))
    book.add(spark.createDataFrame([], NODE), spark.createDataFrame([], EDGE))
    assert book.issues().count() == 0
    change = book.add(spark.createDataFrame([(None, None, 1, 0), (None, "x", 1, 1)], NODE), spark.createDataFrame([(None, "b", 1)], EDGE))
    got = sorted(((r["node_id"], r["check"], r["n"]) for r in book.issues(change.select("id")).collect()), key=str)
    assert got == [("b", "dangling_target", 1), (None, "duplicate_id", 1), (None, "missing_name", 1)]
