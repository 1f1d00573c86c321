"""CSV files and JSON documents of any size, each read by many tasks.

A file is read in pieces over its byte ranges. Whether a piece begins inside quotes, and how deep in brackets, depends on all pieces before
it; each piece says what it does to that state, these steps are composed over range partitions, and only then are records cut."""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranges import entered_state, running_count, running_sum
from ..operators.shared import small
from .graph import NODE, RELATION, stem


def place() -> Column:
    """Where a piece stands in its file."""
    return F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def read_csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """(name, row_no, cells) of the CSV files of a path, as csv_rows() of read_texts() gives them, but no task holds a file.

    row_no numbers the rows that have a cell which is not blank. Line ends inside cells become \\n. A quote that is never closed takes the rest
    of its file into one cell, as it does in csv_rows()."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), place().alias("at"), stem().alias("name"), F.col("value").alias("line"))
    ends = lines.groupBy("file").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.startswith(F.min_by("line", "at"), F.lit("```")).alias("fenced"))
    inner = lines.join(small(ends), "file")  # a row a file
    fence = F.col("fenced") & ((F.col("at") == F.col("first")) | ((F.col("at") == F.col("last")) & F.startswith("line", F.lit("```"))))
    kept = inner.where(~fence).select("file", "at", "name", "line")
    held = entered_state(kept, "file", "at", after_line(F.lit(False)), after_line(F.lit(True)), "quoted")
    counted = running_count(held, "file", "at", F.col("quoted") == 0, "record")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n")
    records = counted.groupBy("file", "record").agg(F.first("name").alias("name"), text.alias("text"))
    cells = records.mapInPandas(cut_cells, "file string, record long, name string, cells array<string>")
    numbered = running_count(cells, "file", "record", F.lit(True), "row_no")
    return numbered.select("name", (F.col("row_no") - 1).cast("int").alias("row_no"), "cells")


def after_line(quoted: Column) -> Column:
    """Whether a line (column line) that begins inside quotes, or not, ends inside them. A field is quoted if it begins with a quote; two
    quotes are one in it, and what follows its last quote is text."""
    closes = lambda p: F.contains(F.replace(p, F.lit('""'), F.lit("")), F.lit('"'))  # noqa: E731  a run of an odd number of quotes
    step = lambda s, p: F.when(s, ~closes(p)).otherwise(F.startswith(p, F.lit('"')) & ~closes(F.substring(p, 2, 2**31 - 1)))
    return F.when(F.contains("line", F.lit('"')), F.aggregate(F.split("line", ","), quoted, step)).otherwise(quoted)


def cut_cells(batches):
    """Records that have a cell which is not blank, cut into cells."""
    csv.field_size_limit(2**31 - 1)
    for batch in batches:
        batch["cells"] = [[c.strip() for row in csv.reader(io.StringIO(t, newline="")) for c in row] for t in batch["text"]]
        yield batch.loc[[any(x) for x in batch["cells"]], ["file", "record", "name", "cells"]]


def read_large_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and relations of one graph document, as read_graph() gives them, but no task holds the document, be it on one line or on many.

    ord is an element's place in its array. `nodes` and `relations` are arrays of objects at the top of the document; what else stands there
    is skipped. A document that is not JSON has no defined result."""
    found = elements(spark, path, ["nodes", "relations"])

    def rows(array: str, schema: str) -> DataFrame:
        return found.where(F.col("array") == array).select(F.from_json("text", schema).alias("x"), "ord").select("x.*", "ord").where("_comment IS NULL OR _comment = ''").drop("_comment")

    return rows("nodes", NODE), rows("relations", RELATION).withColumn("bidirectional", F.coalesce("bidirectional", F.lit(False)))


def elements(spark: SparkSession, path: str, arrays: list[str]) -> DataFrame:
    """(file, array, ord, text): the objects in the named arrays at the top of each JSON document of a path.

    Pieces end with a closing brace; they are joined to groups that end where one closes an object in an array or an object at the top, or the
    latter itself. Of the former, the first of an array has the array's key before it, with no other brace between, outside quotes, than
    the document's; those after it follow a comma."""
    pieces = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), place().alias("at"), F.col("value").alias("piece"))
    bare = F.when(F.contains("piece", F.lit("\\")), F.regexp_replace("piece", r"(?s)\\.", "")).otherwise(F.col("piece"))
    parts = pieces.withColumn("parts", F.split(bare, '"'))  # inside and outside quotes by turns
    depth = lambda i: opened(F.array_join(F.filter("parts", lambda x, n: n % 2 == i), ""))
    scanned = parts.withColumns({"quotes": F.size("parts") - 1, "d0": depth(0), "d1": depth(1)}).drop("parts")
    inside = running_sum(scanned, "file", "at", F.col("quotes"), "through")
    begins, ends = (F.col("through") - F.col("quotes")) % 2, F.col("through") % 2
    delta = F.when(begins == 0, F.col("d0")).otherwise(F.col("d1")) - F.when(ends == 0, 1).otherwise(0)
    deep = running_sum(inside.withColumns({"closes": ends == 0, "delta": delta}), "file", "at", F.col("delta"), "depth")
    last = F.col("closes") & (F.col("depth") <= 2)
    counted = running_count(deep.select("file", "at", "piece", "depth", (F.col("depth") - F.col("delta")).alias("from"), last.alias("last")), "file", "at", F.col("last"), "upto")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"]), "}")
    groups = counted.withColumn("no", F.col("upto") - F.col("last").cast("int")).groupBy("file", "no")
    whole = groups.agg(F.concat(text, F.lit("}")).alias("text"), F.min_by("from", "at").alias("from"), F.max(F.when(F.col("last"), F.col("depth"))).alias("to"))
    head = rf'(?s)^\s*\{{?(?:[^"{{}}]++|"(?:[^"\\]++|\\.)*+")*?"({"|".join(arrays)})"\s*:\s*\[\s*(?=\{{)'
    at_top = (F.col("to") == 2) & ((F.col("from") < 2) | F.rlike("text", F.lit(r"^\s*\]")))
    key = F.when(at_top, F.regexp_extract("text", head, 1)).otherwise("")
    opens = running_count(whole.withColumns({"new": ~F.rlike("text", F.lit(r"^\s*,\s*\{")), "key": key}), "file", "no", F.col("new"), "run")
    runs = opens.where("new AND key <> ''").select("file", "run", F.col("key").alias("array"), F.col("no").alias("first"))  # a row an array
    named = opens.join(small(runs), ["file", "run"])
    cut = F.regexp_replace("text", F.when(F.col("new"), F.lit(head)).otherwise(F.lit(r"^\s*,\s*")), "")
    return named.select("file", "array", (F.col("no") - F.col("first")).alias("ord"), cut.alias("text"))


def opened(x: Column) -> Column:
    """Brackets that a text opens, less those that it closes."""
    return F.length(F.translate(x, "]}", "")) - F.length(F.translate(x, "[{", ""))
