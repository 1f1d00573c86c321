"""Typed tables of a graph (registers, fields, chunks, features) and lookups, lists and searches over them.

A lookup returns a plan; what is missing or of the wrong type is for the catalogue to report. `ord` is a node's position in its
source and decides what is first or last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .graph import first_by

FIELD = (
    "array<struct<id:string,name:string,bits:string,bit_high:int,bit_low:int,width:int,access:string,read_effect:string,write_effect:string,"
    "original_attrib:string,raw:string,abstract:string>>"
)
#: The access codes that a search may ask for.
SEARCHED_ACCESS = ("read-only", "read-write", "write-only", "reserved")


def extra(name: str) -> Column:
    return F.col("extras")[name]


def registers(nodes: DataFrame) -> DataFrame:
    """Registers with their offsets in all three forms; a register without an offset has the normal form 000."""
    offset = F.coalesce(extra("offset_hex"), extra("offset"), F.lit(""))
    fields = F.from_json(extra("fields"), FIELD)
    return nodes.where("type = 'REGISTER'").select(
        "id", "name", "description", F.nullif(offset, F.lit("")).alias("offset_hex"), C.norm_offset(offset).alias("offset_norm"), C.offset_int(F.nullif(offset, F.lit(""))).alias("offset_int"),
        F.nullif(extra("class_id"), F.lit("")).alias("class_id"), F.nullif(extra("spec_section"), F.lit("")).alias("spec_section"), F.nullif(extra("spec_table"), F.lit("")).alias("spec_table"), fields.alias("fields"), "ord",
    )


def write_registers(nodes: DataFrame, path: str) -> str:
    """Registers and their fields as typed tables, so that lookups parse no JSON: registers by offset with their number of fields and of bits, fields by
    register and place. Files and their parts tell what they hold, so that a lookup of one id reads little."""
    known = registers(nodes)
    sizes = F.aggregate(F.coalesce("fields", F.array().cast(FIELD)), F.lit(0), lambda a, f: a + F.coalesce(f["width"], F.lit(0)))
    counted = known.withColumns({"field_count": F.greatest(F.coalesce(F.size("fields"), F.lit(0)), F.lit(0)), "size_bits": sizes})
    counted.repartitionByRange("offset_norm", "ord").sortWithinPartitions("offset_norm", "ord").write.parquet(f"{path}/registers")
    fields(nodes.sparkSession.read.parquet(f"{path}/registers")).repartitionByRange("register_id", "pos").sortWithinPartitions("register_id", "pos").write.parquet(f"{path}/fields")
    return path


def read_registers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/registers")


def read_fields(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/fields")


def fields(regs: DataFrame) -> DataFrame:
    """One row for each field of each register, in order."""
    return regs.select(F.col("id").alias("register_id"), F.col("name").alias("register_name"), "ord", F.posexplode("fields").alias("pos", "f")).select("register_id", "register_name", "ord", "pos", "f.*")


def chunks(nodes: DataFrame) -> DataFrame:
    text = lambda x: F.coalesce(x, F.lit(""))
    return nodes.where("type = 'SPEC_CHUNK'").select(
        "id", "name", text(F.coalesce(extra("section_number"), F.col("source.section_number"))).alias("section_number"), text(F.coalesce(extra("section_title"), F.col("source.section_title"))).alias("section_title"),
        F.coalesce(extra("chunk_index").try_cast("int"), F.lit(0)).alias("chunk_index"), F.coalesce("source.page", F.lit(0)).alias("page"), F.coalesce(extra("word_count").try_cast("int"), F.lit(0)).alias("word_count"),
        text(extra("full_text")).alias("full_text"), "ord",
    )


def features(nodes: DataFrame) -> DataFrame:
    texts = lambda name: F.coalesce(F.from_json(extra(name), "array<string>"), F.array().cast("array<string>"))
    return nodes.where("type = 'FEATURE'").select(
        "id", "name", texts("groups").alias("groups"), texts("registers").alias("registers"), F.nullif(F.coalesce(extra("parent_id"), extra("parent")), F.lit("")).alias("parent_id"),
        F.coalesce(extra("not_implemented_in_linux_driver") == "true", F.lit(False)).alias("missing_in_driver"), F.coalesce(extra("driver_coverage"), F.col("coverage.status"), F.lit("NOT_IMPLEMENTED")).alias("driver_status"), "ord",
    )


# registers


def register_by_offset(regs: DataFrame, offset: str) -> DataFrame:
    """The register of an offset in any form; of several the last."""
    return regs.where(F.col("offset_norm") == C.norm_offset(F.lit(offset))).orderBy(F.desc("ord")).limit(1)


def offset_bounds(regs: DataFrame) -> DataFrame:
    """One row (low, high): the least and the greatest normal form, by string."""
    return regs.where("offset_hex IS NOT NULL").agg(F.min("offset_norm").alias("low"), F.max("offset_norm").alias("high"))


def registers_by_name(regs: DataFrame, name: str, exact: bool = False) -> DataFrame:
    """Registers whose name is the given one, or contains it, without regard to case; in node order."""
    low = F.lower("name")
    return regs.where(low == name.lower() if exact else F.contains(low, F.lit(name.lower()))).orderBy("ord")


def register_list(regs: DataFrame, class_id: str | None = None) -> DataFrame:
    """All registers, or those of a class, by the offset's normal form; those without one come last."""
    kept = regs if class_id is None else regs.where(F.col("class_id") == class_id)
    return kept.orderBy(F.when(F.col("offset_hex").isNull(), "ZZZ").otherwise(F.col("offset_norm")), "ord")


def register_summary(regs: DataFrame) -> DataFrame:
    count = F.col("field_count") if "field_count" in regs.columns else F.greatest(F.coalesce(F.size("fields"), F.lit(0)), F.lit(0))
    return regs.select("id", "name", F.col("offset_hex").alias("offset"), "class_id", count.alias("field_count"))


def register_sizes(regs: DataFrame) -> DataFrame:
    """(id, size_bits, field_count): the sum of the fields' widths."""
    if "size_bits" in regs.columns:
        return regs.select("id", "size_bits", "field_count")
    bits = F.aggregate(F.coalesce("fields", F.array().cast(FIELD)), F.lit(0), lambda a, f: a + F.coalesce(f["width"], F.lit(0)))
    return regs.select("id", bits.alias("size_bits"), F.greatest(F.size(F.coalesce("fields", F.array().cast(FIELD))), F.lit(0)).alias("field_count"))


def dump_totals(regs: DataFrame) -> DataFrame:
    """(register, fields): how many fields each register has, and all together under ALL."""
    return register_sizes(regs).rollup("id").agg(F.sum("field_count").alias("fields")).select(F.coalesce("id", F.lit("ALL")).alias("register"), F.coalesce("fields", F.lit(0)).alias("fields"))


# fields


def field_by_id(flds: DataFrame, field_id: str) -> DataFrame:
    return flds.where(F.col("id") == field_id).orderBy(F.desc("ord"), F.desc("pos")).limit(1)


def field_by_name(flds: DataFrame, register_id: str, name: str) -> DataFrame:
    """The first field of a register whose name contains a text."""
    return flds.where((F.col("register_id") == register_id) & F.contains(F.lower("name"), F.lit(name.lower()))).orderBy("pos").limit(1)


def fields_holding(flds: DataFrame, bit: int) -> DataFrame:
    """The first field of each register that holds a bit; missing bounds count as 0."""
    zero = F.lit(0)
    return first_by(flds.where(F.lit(bit).between(F.coalesce("bit_low", zero), F.coalesce("bit_high", zero))), ["register_id"], [F.col("pos")])


def fields_of(flds: DataFrame, register_id: str) -> DataFrame:
    return flds.where(F.col("register_id") == register_id).orderBy("pos")


def fields_with_access(flds: DataFrame, access: str, register_id: str | None = None) -> DataFrame:
    if access not in SEARCHED_ACCESS:
        raise ValueError(f"INVALID_PARAM: access must be one of {', '.join(SEARCHED_ACCESS)}")
    kept = flds.where(F.col("access") == access)
    return (kept if register_id is None else kept.where(F.col("register_id") == register_id)).orderBy("ord", "pos")


def fields_named(flds: DataFrame, pattern: str) -> DataFrame:
    return flds.where(F.contains(F.lower("name"), F.lit(pattern.lower()))).orderBy("ord", "pos")


def fields_with_text(flds: DataFrame, query: str, around: int = 30) -> DataFrame:
    """Fields whose raw text or abstract contains the query, with what stands around its first occurrence."""
    if len(query) < 2:
        raise ValueError("INVALID_PARAM: query")
    body = F.concat(F.coalesce("raw", F.lit("")), F.lit(" "), F.coalesce("abstract", F.lit("")))
    return flds.where(F.contains(F.lower(body), F.lit(query.lower()))).orderBy("ord", "pos").select("register_id", "register_name", "id", "name", C.excerpt(body, query, around).alias("excerpt"))


# sections


def section(chs: DataFrame, number: str | None = None) -> DataFrame:
    """(section_number, title, chunk_ids, page_start, page_end, text) of one section or of all: the first title in node order,
    chunks by index, texts that are not empty joined by a blank line."""
    kept = chs if number is None else chs.where(F.col("section_number") == number)
    rows = F.array_sort(F.collect_list(F.struct("chunk_index", "ord", "id", "full_text")))
    whole = kept.where("section_number <> ''").groupBy("section_number").agg(
        F.min_by(F.when(F.col("section_title") != "", F.col("section_title")), F.when(F.col("section_title") != "", F.col("ord"))).alias("title"), rows.alias("r"), F.min("page").alias("page_start"), F.max("page").alias("page_end")
    )
    texts = F.filter(F.transform("r", lambda x: x["full_text"]), lambda x: x != "")
    return whole.select("section_number", F.coalesce("title", F.lit("")).alias("title"), F.transform("r", lambda x: x["id"]).alias("chunk_ids"), "page_start", "page_end", F.array_join(texts, "\n\n").alias("text"))


def section_list(chs: DataFrame, parent: str | None = None) -> DataFrame:
    """(section_number, title, chunk_count, page) of all sections or of those under one, in numeric order; page 0 is none."""
    kept = chs.where("section_number <> ''")
    if parent is not None:
        kept = kept.where((F.col("section_number") == parent) | F.startswith("section_number", F.lit(parent + ".")))
    found = kept.groupBy("section_number").agg(F.min_by("section_title", "ord").alias("title"), F.count(F.lit(1)).alias("chunk_count"), F.min(F.when(F.col("page") != 0, F.col("page"))).alias("page"))
    return found.withColumn("page", F.coalesce("page", F.lit(0))).orderBy(C.section_key(F.col("section_number")), "section_number")


def chunks_with_text(chs: DataFrame, text: str, limit: int = 10) -> DataFrame:
    """The first chunks that contain a text, in node order; one at least."""
    return chs.where(F.contains(F.lower("full_text"), F.lit(text.lower()))).orderBy("ord").limit(max(limit, 1))


def chunk_positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows with chunk_index: the running number in their group, from 0."""
    return rows.withColumn("chunk_index", F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1)


def section_keywords(chs: DataFrame, limit: int = 20) -> DataFrame:
    """(section_number, keywords, technical_terms) of each section's whole text."""
    whole = chs.groupBy("section_number").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "ord", "full_text"))), lambda x: x["full_text"]), " ").alias("text"))
    return whole.select("section_number", C.keywords(F.col("text"), limit).alias("keywords"), C.technical_terms(F.col("text")).alias("technical_terms"))


# tables and figures


def by_reference(items: DataFrame, reference: str, column: Column) -> DataFrame:
    """The item of a reference such as 'Table 2-5': an exact match first, then one without regard to case; the first in order."""
    return items.where(F.lower(column) == reference.lower()).orderBy(F.desc(column == reference), "ord").limit(1)


def of_kind(items: DataFrame, kind: str | None, column: Column, kinds: tuple[str, ...]) -> DataFrame:
    """Items of a kind, by id as a string."""
    if kind is not None and kind not in kinds:
        raise ValueError(f"INVALID_PARAM: kind must be one of {', '.join(kinds)}")
    return (items if kind is None else items.where(column == kind)).orderBy("id")


def by_chapter(items: DataFrame, number: Column) -> DataFrame:
    """(chapter, ids): ids by chapter, in the order of their numbers (chapter-number)."""
    parts = F.transform(F.split(number, r"[-._]"), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
    rows = items.select("id", F.get(parts, F.lit(0)).alias("chapter"), F.coalesce(F.get(parts, F.lit(1)), F.lit(0)).alias("seq"))
    return rows.groupBy("chapter").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "id"))), lambda x: x["id"]).alias("ids")).orderBy("chapter")


def content_of(nodes: DataFrame, node_id: str, path: Column, texts: DataFrame) -> DataFrame:
    """(id, file, content) of a node whose extras name a file; separators of either kind, found by the file's stem."""
    stem = lambda c: F.regexp_extract(F.regexp_replace(c, r"\\", "/"), r"([^/]+?)(?:\.[^./]*)?$", 1)
    here = nodes.where(F.col("id") == node_id).select("id", path.alias("file")).withColumn("name", stem(F.col("file")))
    return here.join(texts, "name", "left").select("id", "file", "content")


# features


def feature_registers(feats: DataFrame, nodes: DataFrame, feature_id: str) -> DataFrame:
    """The registers that a feature lists, in its order; unknown ones are left out."""
    wanted = feats.where(F.col("id") == feature_id).select(F.posexplode("registers").alias("pos", "id"))
    return wanted.join(nodes, "id").orderBy("pos").drop("pos")


def feature_groups(feats: DataFrame) -> DataFrame:
    """(grp, features): the features (id, name) of each group, in node order."""
    flat = feats.select("ord", "id", "name", F.posexplode("groups").alias("pos", "grp"))
    return flat.groupBy("grp").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "pos", "id", "name"))), lambda x: F.struct(x["id"].alias("id"), x["name"].alias("name"))).alias("features"))


def features_by_driver(feats: DataFrame, status: str | None = None) -> DataFrame:
    kept = feats if status is None else feats.where(F.upper("driver_status") == status.upper())
    return kept.orderBy("ord").select("id", "name", "driver_status")
