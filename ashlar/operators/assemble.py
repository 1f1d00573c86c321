"""Assembling a graph: nodes of each type, edges between them, statistics, checks, and the merge of parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .extract import issues, merge_parts, number_edges
from .graph import first_by, orphans, validate

NODE_COLUMNS = ["id", "type", "name", "description", "index_keywords", "source", "coverage", "confidence", "validation_status", "extras", "ord"]
SOURCE = ("page", "pdf_page", "spec_reference", "section_number", "section_title", "table", "figure")


def node(rows: DataFrame, kind: str, name: Column, description: Column, keywords: Column, confidence: Column, extras: dict[str, Column], **source: Column) -> DataFrame:
    """Nodes of one type out of rows (id, ord and what the columns need)."""
    of = {"page": "int", "pdf_page": "int"}
    parts = [source.get(s, F.lit(None)).cast(of.get(s, "string")).alias(s) for s in SOURCE]
    new = F.struct(F.lit("NOT_IMPLEMENTED").alias("status"), F.lit("").alias("notes"), F.lit("").alias("implemented_in"))
    entries = [x for k, v in extras.items() for x in (F.lit(k), F.coalesce(v.cast("string"), F.lit("")))]
    held = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
    none = F.array().cast("array<string>")
    return rows.select("id", F.lit(kind).alias("type"), name.alias("name"), F.coalesce(description, F.lit("")).alias("description"), F.coalesce(keywords, none).alias("index_keywords"), F.struct(*parts).alias("source"), new.alias("coverage"), confidence.cast("double").alias("confidence"), F.lit("AUTO").alias("validation_status"), held.alias("extras"), F.col("ord").cast("long").alias("ord"))


def done(status: Column, yes: float, no: float) -> Column:
    return F.when(status == "COMPLETED", F.lit(yes)).otherwise(F.lit(no))


def table_nodes(rows: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """TABLE nodes of rows (id, ord, title, abstract, spec_reference, spec_page, definition_page, status, csv_file)."""
    title = F.coalesce("title", F.lit(""))
    text = F.concat(title, F.lit(" "), F.coalesce("abstract", F.lit("")))
    kind = C.first_rule(title, rules if rules is not None else C.TABLE_RULES)
    return node(rows, "TABLE", F.coalesce("title", "spec_reference"), F.col("abstract"), C.keywords(text), done(F.col("status"), 0.95, 0.7), {"table_number": F.col("spec_reference"), "csv_file": F.col("csv_file"), "table_type": kind}, page=F.coalesce("spec_page", F.lit(0)), pdf_page=F.coalesce("definition_page", F.lit(0)), spec_reference=F.col("spec_reference"))


def figure_nodes(rows: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """FIGURE nodes of rows (id, ord, title, abstract, spec_reference, spec_page, definition_page, status, diagram_file)."""
    title = F.coalesce("title", F.lit(""))
    text = F.concat(title, F.lit(" "), F.coalesce("abstract", F.lit("")))
    kind = C.first_rule(title, rules if rules is not None else C.FIGURE_RULES)
    return node(rows, "FIGURE", F.coalesce("title", "spec_reference"), F.col("abstract"), C.keywords(text), done(F.col("status"), 0.9, 0.7), {"figure_number": F.col("spec_reference"), "text_diagram_file": F.col("diagram_file"), "text_diagram_format": F.lit("plantuml"), "figure_type": kind}, page=F.coalesce("spec_page", F.lit(0)), pdf_page=F.coalesce("definition_page", F.lit(0)), spec_reference=F.col("spec_reference"))


def chunk_nodes(rows: DataFrame, page_offset: int = 0) -> DataFrame:
    """SPEC_CHUNK nodes of rows (id, ord, section_number, title, chunk_index, word_count, page, full_text, abstract, keywords)."""
    name = F.concat("title", F.lit(" (Chunk "), F.col("chunk_index").cast("string"), F.lit(")"))
    held = {"section_number": F.col("section_number"), "section_id": C.section_id(F.col("section_number")), "section_title": F.col("title"), "chunk_index": F.col("chunk_index"), "word_count": F.col("word_count"), "full_text": F.col("full_text")}
    return node(rows, "SPEC_CHUNK", name, F.col("abstract"), F.col("keywords"), F.lit(0.9), held, page=F.col("page"), pdf_page=F.col("page") + page_offset, section_number=F.col("section_number"))


def register_nodes(rows: DataFrame) -> DataFrame:
    """REGISTER nodes of rows (id, ord, name, offset, class_id, spec_section, spec_table, page, definition_page, fields)."""
    norm = F.concat(F.lit("0x"), C.norm_offset(F.coalesce("offset", F.lit(""))))
    keys = F.concat(C.keywords(F.col("name")), F.array(F.concat(F.lit("offset "), F.coalesce("offset", F.lit(""))), norm))
    bits = F.aggregate("fields", F.lit(0), lambda a, f: a + F.coalesce(f["width"], F.lit(0)))
    held = {"offset": norm, "offset_hex": F.col("offset"), "size_bits": F.coalesce(bits, F.lit(0)), "spec_section": F.col("spec_section"), "spec_table": F.col("spec_table"), "class_id": F.col("class_id"), "fields": F.to_json("fields")}
    return node(rows, "REGISTER", F.col("name"), F.concat(F.lit("Register at offset "), F.coalesce("offset", F.lit(""))), keys, F.lit(0.95), held, page=F.coalesce("page", F.lit(0)), pdf_page=F.coalesce("definition_page", F.lit(0)), section_number=F.coalesce("spec_section", F.lit("")))


def class_nodes(rows: DataFrame) -> DataFrame:
    """REG_CLASS nodes of rows (id, ord, name, address_start, address_end, version_support)."""
    text = F.concat(F.lit("Register class: "), "name", F.lit(" ("), "address_start", F.lit(" - "), "address_end", F.lit(")"))
    span = F.to_json(F.struct(F.col("address_start").alias("start"), F.col("address_end").alias("end")))
    return node(rows, "REG_CLASS", F.col("name"), text, C.keywords(F.col("name")), F.lit(1.0), {"address_range": span, "version_support": F.to_json("version_support")})


def feature_nodes(rows: DataFrame, kind: str = "FEATURE", lists: tuple[str, ...] = ("groups", "figures", "tables", "registers", "spec_sections")) -> DataFrame:
    """FEATURE or HD_SEQUENCE nodes of rows (id, ord, name, description, priority, parent_id and lists of ids)."""
    held = {"priority": F.coalesce("priority", F.lit("P0")), "parent_id": F.col("parent_id")} | {k: F.to_json(F.coalesce(k, F.array().cast("array<string>"))) for k in lists}
    return node(rows, kind, F.col("name"), F.col("description"), C.keywords(F.col("name")), F.lit(1.0), held)


# edges


def edge(rows: DataFrame, kind: str, source: str, target: str) -> DataFrame:
    return rows.select(F.lit(kind).alias("type"), F.col(source).alias("source_node"), F.col(target).alias("target_node"))


def register_edges(registers: DataFrame) -> DataFrame:
    """BELONGS_TO a class and DEFINED_BY a table, in register order, numbered by one counter; registers: (id, ord, class_id, spec_table)."""
    kinds = F.array(F.struct(F.lit("BELONGS_TO").alias("type"), F.lit("BELONGS").alias("word"), F.nullif("class_id", F.lit("")).alias("target_node")), F.struct(F.lit("DEFINED_BY").alias("type"), F.lit("DEFINED").alias("word"), F.nullif("spec_table", F.lit("")).alias("target_node")))
    flat = registers.select(F.col("id").alias("source_node"), "ord", F.posexplode(kinds).alias("pos", "x")).select("source_node", "ord", "pos", "x.*").where("target_node IS NOT NULL")
    numbered = number_edges(flat, "", ["ord", "pos"])
    number = F.format_string("%03d", F.col("id").cast("long"))
    return numbered.select(F.concat(F.lit("REL_"), "word", F.lit("_"), number).alias("id"), "type", "source_node", "target_node", "ord")


def describes(chunks: DataFrame, registers: DataFrame) -> DataFrame:
    """DESCRIBES edges from a section's chunks to the registers that name it."""
    r = registers.where("spec_section IS NOT NULL AND spec_section <> ''").select(F.col("id").alias("target_node"), F.col("spec_section").alias("section_number"))
    return edge(chunks.select(F.col("id").alias("source_node"), "section_number").join(r, "section_number"), "DESCRIBES", "source_node", "target_node")


def part_of(features: DataFrame) -> DataFrame:
    """PART_OF edges from a feature to its parent; features: (id, ord, parent_id)."""
    flat = features.where("parent_id IS NOT NULL AND parent_id <> ''").select("ord", F.col("id").alias("source_node"), F.col("parent_id").alias("target_node"))
    numbered = number_edges(flat, "", ["ord"])
    return numbered.select(F.concat(F.lit("REL_PART_OF_"), F.format_string("%03d", F.col("id").cast("long"))).alias("id"), F.lit("PART_OF").alias("type"), "source_node", "target_node")


def child_edges_of_all(chunks: DataFrame) -> DataFrame:
    """CHILD_OF edges from every chunk of a section to the first chunk of its parent section."""
    first = first_by(chunks, ["section_number"], [F.col("chunk_index"), F.col("ord")]).select(F.col("section_number").alias("parent"), F.col("id").alias("target_node"))
    flat = chunks.select(F.col("id").alias("source_node"), C.parent_section(F.col("section_number")).alias("parent"))
    return edge(flat.join(first, "parent"), "CHILD_OF", "source_node", "target_node")


# whole graphs


def merge(parts: list[DataFrame]) -> DataFrame:
    """All nodes in one table, in the order of the parts; ord is (part, ord)."""
    return merge_parts([p.select(*NODE_COLUMNS) for p in parts])


def union(parts: list[DataFrame]) -> DataFrame:
    """All nodes in one table; ord tells their order over all parts."""
    whole = parts[0].select(*NODE_COLUMNS)
    for p in parts[1:]:
        whole = whole.unionByName(p.select(*NODE_COLUMNS))
    return whole


def statistics(nodes: DataFrame, relations: DataFrame) -> DataFrame:
    """(what, type, count): nodes and relations by type, and all of them under ALL."""
    by = lambda df, what: df.rollup("type").agg(F.count(F.lit(1)).alias("count")).select(F.lit(what).alias("what"), F.coalesce("type", F.lit("ALL")).alias("type"), "count")
    return by(nodes, "nodes").unionByName(by(relations, "relations"))


def merge_registers(registers: DataFrame) -> DataFrame:
    """Registers that share an offset become one: the first, with its fields and those of the others whose bits are new, the highest
    bit first; merged_from lists the tables where there are several. Registers without an offset stay as they are, at the end.

    registers: id, name, offset_norm (null: none), offset_int, spec_table, ord, fields (array of structs with bits and bit_high)."""
    known, rest = registers.where("offset_norm IS NOT NULL"), registers.where("offset_norm IS NULL")
    flat = known.select("offset_norm", "ord", F.posexplode_outer("fields").alias("pos", "f")).withColumn("base", F.min("ord").over(Window.partitionBy("offset_norm")))
    own = flat.where("ord = base AND pos IS NOT NULL")
    seen = own.select("offset_norm", F.col("f.bits").alias("bits")).distinct()
    more = flat.where("ord <> base AND pos IS NOT NULL").withColumn("bits", F.col("f.bits")).join(seen, ["offset_norm", "bits"], "left_anti")
    kept = own.select("offset_norm", "ord", "pos", "f").unionByName(first_by(more, ["offset_norm", "bits"], [F.col("ord"), F.col("pos")]).select("offset_norm", "ord", "pos", "f"))
    high = lambda f: F.coalesce(f["bit_high"], F.regexp_extract(f["bits"], r"(\d+)", 1).try_cast("int"), F.lit(0))
    sorted_ = F.array_sort(F.collect_list(F.struct((-high(F.col("f"))).alias("down"), "ord", "pos", "f")))
    fields = kept.groupBy("offset_norm").agg(F.transform(sorted_, lambda x: x["f"]).alias("fields"))
    tables = known.groupBy("offset_norm").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("ord", "spec_table"))), lambda x: x["spec_table"])).alias("all"), F.count(F.lit(1)).alias("n"))
    first = first_by(known, ["offset_norm"], [F.col("ord")]).drop("fields")
    whole = first.join(fields, "offset_norm", "left").join(tables, "offset_norm").withColumn("merged_from", F.when(F.col("n") > 1, F.col("all"))).drop("all", "n")
    return whole.unionByName(rest.withColumn("merged_from", F.lit(None).cast("array<string>"))).orderBy(F.col("offset_int").asc_nulls_last(), "ord")


# checks


def check_graph(nodes: DataFrame, relations: DataFrame) -> DataFrame:
    """All issues (node_id, check, severity, message): errors of validate(), nodes without id or type, and as warnings nodes without
    keywords and nodes without an edge."""
    rest = issues(nodes.withColumn("key", F.coalesce("id", F.lit(""))), "key", {"missing_id": ("error", F.coalesce("id", F.lit("")) == ""), "missing_type": ("error", F.coalesce("type", F.lit("")) == ""), "no_keywords": ("warning", F.coalesce(F.size("index_keywords"), F.lit(0)) <= 0)})
    alone = orphans(nodes.where("id IS NOT NULL"), relations).select(F.col("id").alias("node_id"), F.lit("orphan").alias("check"), F.lit("warning").alias("severity"))
    rest = rest.unionByName(alone).withColumn("message", F.concat(F.col("check"), F.lit(" "), F.col("node_id")))
    return validate(nodes, relations).unionByName(rest)


def check_registers(fields: DataFrame, registers: DataFrame, rules: dict[str, str], longest: int = 80) -> DataFrame:
    """Issues of registers by configured rules (rule: severity); a rule that is not configured is not checked, and a field name that is too
    long is always an error. fields: (field_id, register_id, name, bits, access)."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    checks = {"field_name_length": ("error", F.length("name") > longest)} if "field_name_length" in rules else {}
    checks |= {k: (rules[k], cond) for k, cond in (("missing_bits", blank("bits")), ("missing_access", blank("access"))) if k in rules}
    found = issues(fields, "field_id", checks) if checks else issues(fields, "field_id", {"none": ("error", F.lit(False))})
    if "zero_fields" in rules:
        empty = registers.join(fields.select(F.col("register_id").alias("id")).distinct(), "id", "left_anti")
        found = found.unionByName(empty.select(F.col("id").alias("node_id"), F.lit("zero_fields").alias("check"), F.lit(rules["zero_fields"]).alias("severity")))
    return found


def severity_split(found: DataFrame) -> DataFrame:
    """One row (total, errors, warnings)."""
    return found.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))


def report(found: DataFrame, title: str) -> DataFrame:
    """(line, text): the issues as a list in Markdown, errors first."""
    ranked = found.withColumn("rank", F.when(F.col("severity") == "error", 0).otherwise(1))
    text = F.concat(F.lit("- **"), "severity", F.lit("** `"), "node_id", F.lit("`: "), F.col("check"))
    head = found.sparkSession.createDataFrame([(f"# {title}",)], "text string").select(F.lit(-1).alias("rank"), F.lit("").alias("node_id"), F.lit("").alias("check"), "text")
    return head.unionByName(ranked.select("rank", "node_id", "check", text.alias("text"))).orderBy("rank", "node_id", "check").select("text")
