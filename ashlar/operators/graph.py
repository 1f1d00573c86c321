"""Graph operators over silver tables: lookups, joins, aggregates, search, window-style steps and checks.

Every table has `ord`, the position in its source, which decides "first", "last" and ties."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from ..functions import columns as C
from . import ranges as R
from . import substrings as T
from .shared import small

def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first in order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def by_id(nodes: DataFrame, node_id: str) -> DataFrame:
    """The node of an id; of several the last."""
    return nodes.where(F.col("id") == node_id).orderBy(F.desc("ord")).limit(1)


def registers_in_range(registers: DataFrame, start: str, end: str) -> DataFrame:
    """Registers between two offsets, inclusive; of equal offsets the last, in numeric order."""
    try:
        lo, hi = (int(x.lower().removeprefix("0x").rstrip("h") or "0", 16) for x in (start, end))
    except ValueError:
        raise ValueError("INVALID_PARAM: an offset is not hexadecimal") from None
    if lo > hi:
        raise ValueError("INVALID_PARAM: start is after end")
    last = first_by(registers.where(F.col("offset_int").between(lo, hi)), ["offset_norm"], [F.desc("ord")])
    return last.orderBy("offset_int")


def search_nodes(nodes: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """Nodes by how many of the query's words their name, description or keywords contain; ties in node order."""
    if limit < 0:
        raise ValueError("INVALID_PARAM: limit")
    terms = sorted(set(query.lower().split()))
    hay = F.lower(F.concat_ws(" ", "name", "description", F.array_join("index_keywords", " ")))
    score = sum((F.contains(hay, F.lit(t)).cast("int") for t in terms), F.lit(0))
    return nodes.withColumn("score", score).where("score > 0").orderBy(F.desc("score"), "ord").limit(limit)


def search_keywords(nodes: DataFrame, wanted: list[str]) -> DataFrame:
    """Nodes by the share of wanted keywords that they have exactly, without regard to case."""
    if not wanted:
        raise ValueError("INVALID_PARAM: no keywords")
    have = F.transform("index_keywords", lambda k: F.lower(k))
    hit = F.filter(F.array(*[F.lit(w) for w in wanted]), lambda w: F.array_contains(have, F.lower(w)))
    scored = nodes.withColumns({"matched": hit, "score": F.bround(F.size(hit) / F.lit(len(wanted)), 2)})
    return scored.where(F.size("matched") > 0).orderBy(F.desc("score"), "id")


def search_text(chunks: DataFrame, query: str, around: int = 50) -> DataFrame:
    """Chunks whose text contains the query, with its first position and what stands around it."""
    if len(query) < 2:
        raise ValueError("INVALID_PARAM: query")
    hit = chunks.where(F.contains(F.lower("full_text"), F.lit(query.lower())))
    return hit.select("id", "ord", (F.instr(F.lower("full_text"), query.lower()) - 1).alias("position"), C.excerpt(F.col("full_text"), query, around).alias("excerpt"))


def neighbours(relations: DataFrame, nodes: DataFrame, node_id: str, into: bool, node_type: str) -> DataFrame:
    """Neighbours of a type along edges into or out of a node, in edge order, duplicates kept."""
    here, there = ("target_node", "source_node") if into else ("source_node", "target_node")
    edges = relations.where(F.col(here) == node_id).select(F.col(there).alias("id"), F.col("ord").alias("edge"))
    return edges.join(nodes.where(F.col("type") == node_type).select("id"), "id", "left_semi").orderBy("edge").select("id")


def class_of_offset(registers: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, offset_int, class_id): the first class whose range holds the register's offset; null if none does."""
    own = registers.select("id", "offset_int").distinct()
    found = R.first_range(own, "offset_int", classes, "start_int", "end_int", "ord", "class_id")
    return R.placed(own, found, "offset_int").select("id", "offset_int", "class_id")


def section_of_page(pages: DataFrame, sections: DataFrame) -> DataFrame:
    """pages with the last section that starts on or before their page; of those that start together the last."""
    starts = sections.groupBy(F.col("start").cast(pages.schema["page"].dataType).alias("page")).agg(F.max_by("section", "ord").alias("section"))
    return R.placed(pages, R.last_start(pages.select("page"), "page", starts.where("page IS NOT NULL"), "section"), "page").select(*pages.columns, "section")


def title_match(registers: DataFrame, titles: DataFrame) -> DataFrame:
    """(id, title): the first title that contains a register's name, without regard to case; null if none does."""
    named = registers.select("id", F.lower(F.regexp_replace("name", r"(?i)\s+register$", "")).alias("needle"))
    found = T.first_holding(named, titles.select(F.lower("title").alias("text"), F.col("title").alias("what"), "ord"))
    hit = named.join(small(found), "needle", "left")
    return hit.groupBy("id").agg(F.min_by("what", "ord").alias("title"))


def child_of(chunks: DataFrame) -> DataFrame:
    """Edges from a section's first chunk to its parent section's first chunk."""
    first = chunks.groupBy("section_number").agg(F.min_by("id", F.struct("chunk_index", "ord")).alias("id"))
    child = first.where(C.parent_section(F.col("section_number")).isNotNull()).select(F.col("id").alias("source_node"), F.col("section_number").alias("section"), C.parent_section(F.col("section_number")).alias("parent"))
    return child.join(first.select(F.col("section_number").alias("parent"), F.col("id").alias("target_node")), "parent").select("source_node", "target_node", "section", "parent")


def sequence_next(chunks: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Edges between consecutive chunks of a group."""
    after = F.lead("id").over(Window.partitionBy(group).orderBy(*order))
    return chunks.select(F.col("id").alias("source_node"), after.alias("target_node")).where("target_node IS NOT NULL")


def merge_by_offset(fields: DataFrame) -> DataFrame:
    """Fields of registers that share an offset: all of the first register, then those of the others whose bits are new."""
    base = Window.partitionBy("offset_norm")
    marked = fields.withColumn("base", F.min("register_ord").over(base))
    own = marked.where("register_ord = base")
    more = first_by(marked.where("register_ord <> base").join(own.select("offset_norm", "bits").distinct(), ["offset_norm", "bits"], "left_anti"), ["offset_norm", "bits"], [F.col("register_ord"), F.col("pos")])
    return own.unionByName(more).drop("base")


def gap_fill(rows: DataFrame, group: str, order: str, opens: Column) -> DataFrame:
    """Numbers of groups that a row with `opens` begins and the rows after it join; rows before the first are dropped. A group may be
    as long as the table: see running_count()."""
    return R.running_count(rows, group, order, opens, "grp").where("grp > 0")


def chunk_paragraphs(pages: DataFrame, text: str, max_words: int, separator: str = "\n\n") -> DataFrame:
    """Greedy packing of a page's paragraphs: a chunk is closed before it would exceed max_words, unless it is empty.

    Words are counted once for each paragraph and a chunk is cut once, so that time grows with the page. The columns of pages but for the text,
    chunk_index, chunk_text and word_count; a null text has no chunks."""
    parts = F.filter(F.transform(F.split(F.col(text), separator), lambda p: F.trim(p)), lambda p: p != "")
    names = [c for c in pages.columns if c != text]
    marked = pages.select(*names, parts.alias("__p")).withColumn("__n", F.transform("__p", lambda p: C.count_words(p)))
    schema = T_.StructType([pages.schema[c] for c in names]).add("chunk_index", "integer").add("chunk_text", "string").add("word_count", "integer")

    def run(batches):
        for batch in batches:
            at, index, texts, words = [], [], [], []
            for row, (ps, ns) in enumerate(zip(batch.column(len(names)), batch.column(len(names) + 1), strict=True)):
                held, total, n = [], 0, 0
                for p, k in zip(ps.as_py() or [], ns.as_py() or [], strict=True):
                    if held and total + k > max_words:
                        at.append(row), index.append(n), texts.append(separator.join(held)), words.append(total)
                        held, total, n = [], 0, n + 1
                    held.append(p)
                    total += k
                if held:
                    at.append(row), index.append(n), texts.append(separator.join(held)), words.append(total)
            take = pa.array(at, pa.int64())
            columns = [batch.column(i).take(take) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(index, pa.int32()), pa.array(texts, pa.string()), pa.array(words, pa.int32())], names=[*names, "chunk_index", "chunk_text", "word_count"])

    return marked.mapInArrow(run, schema)


def reference_edges(chunks: DataFrame, nodes: DataFrame) -> DataFrame:
    """One edge for each mention of a node that there is, tables before figures."""
    mentions = F.concat(C.references(F.col("full_text"), "Table", "TABLE_"), C.references(F.col("full_text"), "Figure", "FIG_"))
    flat = chunks.select(F.col("id").alias("source_node"), F.posexplode(mentions).alias("pos", "target_node"))
    return flat.join(nodes.select(F.col("id").alias("target_node")).distinct(), "target_node", "left_semi")


def validate(nodes: DataFrame, relations: DataFrame) -> DataFrame:
    """Issues (node_id, check, severity, message): repeated ids, missing names and dangling edges."""
    again = nodes.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("ord"))).where("n > 1")
    known = nodes.select(F.col("id").alias("known")).distinct()
    issue = lambda df, node, check, message: df.select(F.col(node).alias("node_id"), F.lit(check).alias("check"), F.lit("error").alias("severity"), message.alias("message"))
    found = issue(again, "id", "duplicate_id", F.concat(F.lit("duplicate id "), F.col("id")))
    found = found.unionByName(issue(nodes.where("name IS NULL OR name = ''"), "id", "missing_name", F.lit("no name")))
    for end in ("source_node", "target_node"):
        loose = relations.join(known, F.col(end) == F.col("known"), "left_anti")
        found = found.unionByName(issue(loose, end, f"dangling_{end.split('_')[0]}", F.concat(F.lit("no node "), F.col(end))))
    return found


def orphans(nodes: DataFrame, relations: DataFrame) -> DataFrame:
    linked = relations.select(F.col("source_node").alias("id")).unionByName(relations.select(F.col("target_node").alias("id"))).distinct()
    return nodes.join(linked, "id", "left_anti")


def missing_numbers(present: DataFrame, column: str, first: int, last: int) -> DataFrame:
    every = present.sparkSession.range(first, last + 1).select(F.col("id").alias(column))
    return every.join(present.select(column).distinct(), column, "left_anti")
