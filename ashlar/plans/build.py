"""A graph from its parts to its files: nodes and edges of what there is, checks as configured, a version and a document that are written and read back."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assemble as A
from ..operators import extract as E
from ..operators import graph as G
from ..operators.ranges import numbered
from ..operators.shared import small, written
from ..sources import export
from ..sources.config import Config

#: Diagram checks by the names that configurations give them.
FIGURE_CHECKS = {"empty_diagram": "empty_plantuml", "no_start_mark": "no_startuml"}


@dataclass
class Parts:
    """What extraction has found, as the node builders in assemble.py take it; what is None is left out."""

    tables: DataFrame | None = None
    figures: DataFrame | None = None
    chunks: DataFrame | None = None
    registers: DataFrame | None = None
    classes: DataFrame | None = None
    features: DataFrame | None = None
    sequences: DataFrame | None = None


def graph(parts: Parts, config: Config) -> tuple[DataFrame, DataFrame]:
    """Nodes and relations of all parts, in the order of Parts; ord numbers each of both from 0.

    Edges are CHILD_OF, from a section's first chunk to that of its parent, BELONGS_TO, DEFINED_BY, DESCRIBES, PART_OF and, to nodes that
    there are only, REFERENCES. At least one part must be given."""
    table_rules, figure_rules = config.rules("TABLE") or None, config.rules("FIGURE") or None
    made = [
        (parts.tables, lambda x: A.table_nodes(x, table_rules)), (parts.figures, lambda x: A.figure_nodes(x, figure_rules)), (parts.chunks, lambda x: A.chunk_nodes(x, config.page_offset)), (parts.registers, A.register_nodes),
        (parts.classes, A.class_nodes), (parts.features, A.feature_nodes), (parts.sequences, lambda x: A.feature_nodes(x, "HD_SEQUENCE", ("groups", "figures", "tables", "spec_sections", "uses_features"))),
    ]
    nodes, before = [], 0
    for rows, build in made:
        if rows is not None:
            placed = numbered(rows.withColumnRenamed("ord", "__ord"), ["__ord"], "ord")
            nodes.append(build(placed.withColumn("ord", F.col("ord") + before)))  # rows are moved before they become nodes, which are several times as long
            before += placed.count()
    nodes = A.union(nodes)
    relations = edges(parts, nodes)
    placed = numbered(relations, ["part", "id"], "ord").drop("part")
    return nodes, placed.withColumns({"description": F.lit(""), "bidirectional": F.lit(False)}).select("id", "type", "source_node", "target_node", "description", "bidirectional", "ord")


def edges(parts: Parts, nodes: DataFrame) -> DataFrame:
    """(part, id, type, source_node, target_node): the edges of all parts, each kind with running ids."""
    found = []
    running = lambda df, prefix, keys: numbered(df, keys, "n").withColumn("id", F.format_string(prefix + "%04d", F.col("n") + 1))
    if parts.chunks is not None:
        child = G.child_of(parts.chunks).withColumn("id", F.concat(F.lit("REL_CHILD_"), F.replace("section", F.lit("."), F.lit("_"))))
        found.append(child.withColumn("type", F.lit("CHILD_OF")))
    if parts.registers is not None:
        found.append(A.register_edges(parts.registers))
        if parts.chunks is not None:
            found.append(running(A.describes(parts.chunks, parts.registers), "REL_DESC_", ["source_node", "target_node"]))
    owned = [x.select("id", "ord", "parent_id") for x in (parts.features, parts.sequences) if x is not None]
    if owned:
        whole = E.merge_parts(owned).withColumnRenamed("ord", "at")
        found.append(A.part_of(numbered(whole, ["at"], "ord")))
    if parts.chunks is not None:
        named = G.reference_edges(parts.chunks, nodes).join(nodes.select(F.col("id").alias("source_node"), F.col("ord").alias("at")), "source_node")
        found.append(running(named, "REL_REF_", ["at", "pos"]).withColumn("type", F.lit("REFERENCES")))
    if not found:
        return nodes.sparkSession.createDataFrame([], "part int, id string, type string, source_node string, target_node string")
    kept = [x.select(F.lit(i).alias("part"), "id", "type", "source_node", "target_node") for i, x in enumerate(found)]
    whole = kept[0]
    for x in kept[1:]:
        whole = whole.unionByName(x)
    return written(whole, "edges")


def configured_checks(config: Config, parts: Parts, table_texts: DataFrame | None = None, figure_texts: DataFrame | None = None) -> DataFrame:
    """(part, node_id, check, severity): issues of registers, and of table and figure files (name, content), by the rules that the configuration
    has switched on, with its severities and limits; without a rule nothing is read."""
    spark = next(x for x in vars(parts).values() if x is not None).sparkSession
    found = [spark.createDataFrame([], "part string, node_id string, check string, severity string")]
    rules = config.validation_rules("registers")
    if rules and parts.registers is not None:
        fields = parts.registers.select(F.col("id").alias("register_id"), F.explode("fields").alias("f")).select("register_id", F.col("f.id").alias("field_id"), "f.name", "f.bits", "f.access")
        longest = int(rules.get("field_name_length", {}).get("max_chars", 80))
        found.append(A.check_registers(fields, parts.registers.select("id"), {k: v["severity"] for k, v in rules.items()}, longest).withColumn("part", F.lit("registers")))
    for part, texts, check, names in (("tables", table_texts, E.validate_tables, {}), ("figures", figure_texts, E.validate_figures, FIGURE_CHECKS)):
        rules = config.validation_rules(part)
        if rules and texts is not None:
            called = check(texts).replace(names, subset=["check"]) if names else check(texts)
            given = spark.createDataFrame([(k, v["severity"]) for k, v in rules.items()], "check string, severity string")
            found.append(called.drop("severity").join(small(given), "check").withColumn("part", F.lit(part)))  # a row a rule
    whole = found[0]
    for x in found[1:]:
        whole = whole.unionByName(x)
    return whole


def save(nodes: DataFrame, relations: DataFrame, root: str) -> str:
    """Publish a graph below root: nodes and relations as the current version, and the document of this version, whose path is returned."""
    version = time.time_ns()
    path = export.write_document(nodes, relations, f"{root}/documents/v={version}", "gzip")  # first, as its blocks are on disk meanwhile
    export.publish(nodes, f"{root}/nodes", version)
    export.publish(relations, f"{root}/relations", version)
    return path


def load(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and relations of the version that was published last."""
    return export.current(spark, f"{root}/nodes"), export.current(spark, f"{root}/relations")

