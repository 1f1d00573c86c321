"""Readers and writers: graph documents, table and diagram files, versioned tables."""

from __future__ import annotations

import csv
import io
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODE = (
    "_comment string, id string, type string, name string, description string, index_keywords array<string>, "
    "source struct<page:int,pdf_page:int,spec_reference:string,section_number:string,section_title:string,table:string,figure:string>, "
    "coverage struct<status:string,notes:string,implemented_in:string>, confidence double, validation_status string, extras map<string,string>"
)
RELATION = "_comment string, id string, type string, source_node string, target_node string, description string, bidirectional boolean"


def struct_of(fields: str) -> str:
    return "struct<" + ",".join(f.replace(" ", ":", 1) for f in fields.split(", ")) + ">"


DOCUMENT = f"metadata_version string, nodes array<{struct_of(NODE)}>, relations array<{struct_of(RELATION)}>"


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and relations of a graph document, with ord; rows that are comments are skipped."""
    doc = spark.read.schema(DOCUMENT).option("multiLine", True).json(path)
    nodes = doc.select(F.posexplode("nodes").alias("ord", "x")).select("x.*", F.col("ord").cast("long")).where("_comment IS NULL OR _comment = ''").drop("_comment")
    relations = doc.select(F.posexplode("relations").alias("ord", "x")).select("x.*", F.col("ord").cast("long")).where("_comment IS NULL OR _comment = ''").drop("_comment")
    return nodes, relations.withColumn("bidirectional", F.coalesce("bidirectional", F.lit(False)))


def stem() -> Column:
    """The name of the file that a row was read from, without its ending; separators of either kind."""
    named = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))  # as it stands in the folder
    return F.regexp_extract(F.regexp_replace(named, r"\\", "/"), r"([^/]+?)(?:\.[^./]*)?$", 1)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(name, content): whole files by their stem."""
    return spark.read.text(path, wholetext=True).select(stem().alias("name"), F.col("value").alias("content"))


def csv_rows(texts: DataFrame) -> DataFrame:
    """(name, row_no, cells) of CSV texts; ragged rows, quoted line ends and fences allowed."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for name, content in zip(pdf["name"], pdf["content"], strict=True):
                lines = (content or "").splitlines(keepends=True)
                if lines and lines[0].startswith("```"):
                    lines = lines[1:-1] if len(lines) > 1 and lines[-1].startswith("```") else lines[1:]
                rows = [r for r in csv.reader(io.StringIO("".join(lines), newline="")) if any(c.strip() for c in r)]
                out += [(name, i, [c.strip() for c in r]) for i, r in enumerate(rows)]
            yield pd.DataFrame(out, columns=["name", "row_no", "cells"])

    return texts.mapInPandas(run, "name string, row_no int, cells array<string>")


def write_version(df: DataFrame, root: str) -> str:
    """Write a new version beside the old ones; what is being read is never overwritten."""
    path = f"{root.rstrip('/')}/v={time.time_ns()}"
    df.write.parquet(path)
    return path


def update_coverage(nodes: DataFrame, node_id: str, status: str, notes: str = "", implemented_in: str = "") -> DataFrame:
    if status not in ("NOT_IMPLEMENTED", "PARTIAL", "IMPLEMENTED", "NOT_APPLICABLE"):
        raise ValueError("INVALID_STATUS: " + status)
    new = F.struct(F.lit(status).alias("status"), F.lit(notes).alias("notes"), F.lit(implemented_in).alias("implemented_in"))
    return nodes.withColumn("coverage", F.when(F.col("id") == node_id, new).otherwise(F.col("coverage")))
