"""What a published graph leaves on disk, and documents of rows that lie in no order."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from ashlar.operators import ranges as R
from ashlar.operators.shared import shared_dir
from ashlar.plans import graph_queries as Q
from ashlar.sources import export


def test_a_built_graph_leaves_less_than_four_times_its_input(spark):
    d, shared = Path("/root/testdata/sf0.01"), Path(shared_dir(spark).removeprefix("file://"))
    size = lambda: sum(f.stat().st_size for f in shared.rglob("part-*"))
    before = size()
    assert Q.built_graph(spark, str(d)).count() > 5
    assert size() - before < 4 * sum((d / f"{t}.parquet").stat().st_size for t in ("part", "lineitem"))


def test_lines_stand_in_order_however_rows_lie(spark, tmp_path):
    nodes = spark.range(3000).select(F.concat(F.lit("N"), "id").alias("id"), F.lit("a\nb é").alias("name"), (F.col("id") * 3 - F.when(F.col("id") > 2000, -7 * F.col("id")).otherwise(500)).alias("ord")).repartition(5)
    edges = spark.range(400).select(F.concat(F.lit("R"), "id").alias("id"), F.col("id").alias("ord")).repartition(3, F.hash("id"))
    for form in ("none", "gzip"):
        path = export.write_document(nodes, edges, str(tmp_path / form), form)
        parts = sorted(p.name for p in Path(path).glob("part-*"))
        text = "\n".join(r["value"] for p in parts for r in spark.read.text(f"{path}/{p}").coalesce(1).collect())
        whole = json.loads(text)
        assert [n["id"] for n in whole["nodes"]] == [r["id"] for r in nodes.orderBy("ord").collect()] and [e["id"] for e in whole["relations"]] == [f"R{i}" for i in range(400)]
        got = export.read_document(spark, path)
        assert [r["id"] for r in got[0].orderBy("ord").collect()] == [n["id"] for n in whole["nodes"]] and got[0].where("name = 'a\\nb é'").count() == 3000 and got[1].count() == 400
        assert len(parts) > 4 and all(p.endswith(".gz") == (form == "gzip") for p in parts)
    assert sum(f.stat().st_size for f in (tmp_path / "gzip").glob("part-*")) < sum(f.stat().st_size for f in (tmp_path / "none").glob("part-*")) / 4
    none = export.write_document(nodes.where("false"), edges.where("false"), str(tmp_path / "empty"), "gzip")
    assert [x.count() for x in export.read_document(spark, none)] == [0, 0]


def test_numbers_follow_keys_over_partitions(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.when(F.col("id") % 9 > 0, F.col("id")).alias("v")).repartition(6)
    got = R.numbered(rows, ["v", "k"], "n")
    expected = sorted(((r["v"], r["k"]) for r in rows.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert [(r["v"], r["k"]) for r in got.orderBy("n").collect()] == expected and sorted(r["n"] for r in got.collect()) == list(range(5000)) and set(got.columns) == {"k", "v", "n"}
