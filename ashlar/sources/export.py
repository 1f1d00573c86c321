"""Sinks: a graph as one JSON document, reports, texts by entity, and versions of which a pointer names the current one."""

from __future__ import annotations

import time
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranges import numbered
from ..operators.shared import TIDY, settings
from .graph import NODE, RELATION, read_graph, update_coverage

#: The lines of a document that are no node and no edge.
START, RELATIONS, END = '{"metadata_version": "1.0", "nodes": [', '], "relations": [', "]}"


def files(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, length, modified) of the files below a path; none where it is missing. Contents are not read."""
    from pyspark.errors import AnalysisException

    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException:
        return spark.createDataFrame([], "path string, name string, length long, modified timestamp")
    return found.select("path", F.substring_index("path", "/", -1).alias("name"), "length", F.col("modificationTime").alias("modified"))


def document(nodes: DataFrame, relations: DataFrame) -> DataFrame:
    """(part, ord, text): the lines of a graph's JSON document: an opening line, one line for each node and each edge in
    order, and what joins and closes them. So the document is written by many tasks, in order of their lines."""
    spark = nodes.sparkSession
    last = lambda df: df.agg(F.max("ord")).first()[0]
    json = lambda df: F.to_json(F.struct(*[c for c in df.columns if c != "ord"]))
    fixed = lambda part, text: spark.range(1, numPartitions=1).select(F.lit(part).alias("part"), F.lit(0).cast("long").alias("ord"), F.lit(text).alias("text"))

    def lines(df: DataFrame, part: int) -> DataFrame:
        end = last(df)
        comma = F.when(F.col("ord") == F.lit(end), F.lit("")).otherwise(F.lit(",")) if end is not None else F.lit("")
        return df.select(F.lit(part).alias("part"), F.col("ord").cast("long").alias("ord"), F.concat(json(df), comma).alias("text"))

    whole = fixed(0, START)
    for x in (lines(nodes, 1), fixed(2, RELATIONS), lines(relations, 3), fixed(4, END)):
        whole = whole.unionByName(x)
    return whole


def write_document(nodes: DataFrame, relations: DataFrame, path: str, compression: str = "none") -> str:
    """Write a graph as JSON, cut at line ends into part files whose names sort as the document goes; read_document() reads them.

    `ord` numbers lines uniquely within nodes and within relations. Lines repeat their names and are many times as long as a table's rows, so they are
    shuffled in compressed blocks of lines that follow each other; the fewer gaps tasks find between their rows' numbers, the longer are the blocks."""
    spark = nodes.sparkSession
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [df.stat.approxQuantile("ord", [i / pieces for i in range(1, pieces)], 0.01) if pieces > 1 else [] for df in (nodes, relations)]
    with settings(spark, TIDY | {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}):
        dealt = document(nodes, relations).mapInArrow(blocks([np.unique(np.array(c, np.float64)) for c in cuts]), "piece int, part int, ord long, block binary")
        total = 3 + sum(len(set(c)) + 1 for c in cuts)
        held = dealt.repartitionById(total, F.col("piece")).sortWithinPartitions("part", "ord")
        held.select("block").mapInArrow(lines_of_blocks, "text string").write.text(path, compression=compression)
    return path


def blocks(cuts: list[np.ndarray]):
    """From lines (part, ord, text) to blocks of them, all of one piece; pieces follow each other as the document goes, and are cut at ord for nodes and for edges."""
    first = {0: 0, 1: 1, 2: 2 + len(cuts[0]), 3: 3 + len(cuts[0]), 4: 4 + len(cuts[0]) + len(cuts[1])}

    def run(batches):
        for batch in batches:
            part, ord_, text = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            piece = np.array([first[p] for p in range(5)])[part]
            for p in (1, 3):
                piece[part == p] += np.searchsorted(cuts[p // 2], ord_[part == p], side="left")
            begin = np.flatnonzero(np.r_[True, (piece[1:] != piece[:-1]) | (ord_[1:] != ord_[:-1] + 1)]) if len(part) else np.empty(0, np.int64)
            packed = [zlib.compress("\n".join(text.slice(a, b - a).to_pylist()).encode()) for a, b in zip(begin, [*begin[1:], len(part)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(piece[begin], pa.int32()), pa.array(part[begin], pa.int32()), pa.array(ord_[begin], pa.int64()), pa.array(packed, pa.binary())], names=["piece", "part", "ord", "block"])

    return run


def lines_of_blocks(batches):
    for batch in batches:
        for block in batch.column(0):
            yield pa.RecordBatch.from_arrays([pa.array(zlib.decompress(block.as_py()).decode().split("\n"), pa.string())], names=["text"])


def read_document(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A graph that write_document() wrote, so that no task holds the document. Lines are numbered over the files, in the order of their names and
    of their places in them; what stands before the line that begins the relations is a node, and ord is its place among nodes or edges."""
    at = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")]
    lines = numbered(spark.read.text(path).select(F.col("value").alias("line"), *at), ["file", "block", "row"], "n").drop("file", "block", "row")
    border = lines.where(F.col("line") == RELATIONS).agg(F.min("n")).first()[0]
    if border is None:
        raise ValueError(f"NOT_FOUND: no graph document below {path}")

    def parsed(first: int, rows: DataFrame, schema: str) -> DataFrame:
        read = rows.select(F.from_json(F.regexp_replace("line", r",$", ""), schema).alias("x"), (F.col("n") - first).alias("ord"))
        return read.select("x.*", "ord").where("_comment IS NULL OR _comment = ''").drop("_comment")

    edges = parsed(border + 1, lines.where((F.col("n") > border) & (F.col("line") != END)), RELATION)
    return parsed(1, lines.where(F.col("n").between(1, border - 1)), NODE), edges.withColumn("bidirectional", F.coalesce("bidirectional", F.lit(False)))


def write_single(nodes: DataFrame, relations: DataFrame, path: str) -> str:
    """Write a graph as one JSON file, for readers that want one; one task sorts its lines and writes them one by one."""
    document(nodes, relations).coalesce(1).sortWithinPartitions("part", "ord").select("text").write.text(path)
    return path


def read_single(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return read_graph(spark, path)


def publish(df: DataFrame, root: str, version: int | None = None) -> str:
    """Write df as a new version below root and make it the current one; older versions stay as backups, and what is
    being read is never overwritten."""
    root = root.rstrip("/")
    path = f"{root}/versions/v={version or time.time_ns()}"
    with settings(df.sparkSession, TIDY):
        df.write.parquet(path, compression="zstd")
    df.sparkSession.createDataFrame([(path, time.time_ns())], "path string, at long").coalesce(1).write.mode("append").json(f"{root}/current")
    return path


def current(spark: SparkSession, root: str) -> DataFrame:
    """The version that was published last."""
    at = spark.read.schema("path string, at long").json(f"{root.rstrip('/')}/current").orderBy(F.desc("at")).first()
    if at is None:
        raise LookupError(f"NOT_FOUND: no version below {root}")
    return spark.read.parquet(at["path"])


def set_coverage(spark: SparkSession, root: str, node_id: str, status: str, notes: str = "", implemented_in: str = "") -> str:
    """Set a node's coverage in the current version and publish the result."""
    nodes = current(spark, root)
    if nodes.where(F.col("id") == node_id).isEmpty():
        raise LookupError(f"NOT_FOUND: {node_id}")
    return publish(update_coverage(nodes, node_id, status, notes, implemented_in), root)


def write_texts(texts: DataFrame, path: str, ending: str = "csv") -> str:
    """One folder for each entity (name, content) with its text in it, written by the tasks that hold it."""
    kept = texts.select(F.concat("name", F.lit("." + ending)).alias("file"), F.coalesce("content", F.lit("")).alias("value"))
    kept.write.partitionBy("file").text(path)
    return path


def read_entity_texts(spark: SparkSession, path: str) -> DataFrame:
    """(name, content) of what write_texts() wrote."""
    read = spark.read.text(path, wholetext=True)
    return read.select(F.regexp_replace("file", r"\.[^.]*$", "").alias("name"), F.regexp_replace("value", r"\n$", "").alias("content"))


def write_report(lines: DataFrame, path: str) -> str:
    """A report's lines (column text) in their order, as a text file."""
    lines.coalesce(1).select("text").write.text(path)
    return path


def write_issues(found: DataFrame, path: str) -> str:
    """A validation report as lines of JSON."""
    found.write.json(path)
    return path


def failed_items(items: DataFrame, what: str) -> DataFrame:
    """(text): the items (id, status, error) that were not completed, as a list in Markdown."""
    open_ = items.where("status IS NULL OR status <> 'COMPLETED'")
    head = items.sparkSession.createDataFrame([(f"# {what} that are not complete",)], "text string").select(F.lit(0).alias("k"), F.lit("").alias("id"), "text")
    rows = open_.select(F.lit(1).alias("k"), "id", F.concat(F.lit("- "), "id", F.lit(": "), F.coalesce("status", F.lit("NOT_STARTED")), F.coalesce(F.concat(F.lit(" ("), "error", F.lit(")")), F.lit(""))).alias("text"))
    return head.unionByName(rows).orderBy("k", "id").select("text")


def add_raw_chunks(nodes: DataFrame, raw: DataFrame) -> DataFrame:
    """nodes with raw chapters (id, chapter, text, start) as RAW nodes at the end, in place of older ones."""
    old = nodes.where("type <> 'RAW_CONTENT'")
    last = F.lit(old.agg(F.coalesce(F.max("ord"), F.lit(-1))).first()[0]).cast("long")
    new = raw.select("id", F.lit("RAW_CONTENT").alias("type"), F.col("chapter").alias("name"), F.create_map(F.lit("full_text"), F.col("text")).alias("extras"), (last + F.regexp_extract("id", r"(\d+)$", 1).cast("long")).alias("ord"))
    return old.unionByName(new, allowMissingColumns=True)
