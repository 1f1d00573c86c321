"""Extraction operators: headers and contents lists out of pages, fields out of table rows, nodes, edges and checks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from . import ranges as R
from . import substrings as T
from .graph import first_by, gap_fill
from .shared import small

# Forms of section headers, by kind, in order of precedence.
HEADERS = {
    "section": r"^([1-9]\d*(?:\.\d+)+)\s+([A-Z][a-zA-Z0-9].{3,80})$",
    "chapter": r"^([1-9])\.\s+([A-Z].{5,80})$",
    "appendix": r"^Appendix\s+([A-Z])\s*(?:\([^)]+\))?\s*[:\-]?\s*(.*)$",
    "appendix_section": r"^([A-Z](?:\.\d+)+)\s+([A-Z].{3,80})$",
}
# Forms of contents entries: number, title, leaders, page.
CONTENTS = {
    "section": r"(?m)^\s*(\d+(?:\.\d+)*)\s+(.+?)\s*\.{3,}\s*(\d+)\s*$",
    "table": r"(?m)^\s*Table\s+(\d+[-.]\d+)\s*:?\s*(.+?)\s*\.{3,}\s*(\d+)\s*$",
    "figure": r"(?m)^\s*Figure\s+(\d+[-.]\d+)\s*:?\s*(.+?)\s*\.{3,}\s*(\d+)\s*$",
}
# Words in a column's heading that tell its role; of roles that a heading could have the first here wins.
ROLES = {"bits": ("bit", "location", "position", "bits"), "access": ("access", "attrib", "type", "r/w", "attribute"), "description": ("description", "function", "explanation", "desc"), "name": ("field name", "signal name", "name", "field")}


def section_headers(pages: DataFrame, text: str = "text", keys: list[str] | None = None) -> DataFrame:
    """(page, line, kind, number, title): lines that look like a header; one row for each number, its first. With keys, as the book, these
    columns come first and a number is told apart by them."""
    keys = keys or []
    lines = pages.select(*keys, "page", F.posexplode(F.split(F.col(text), "\n")).alias("line", "body"))
    kinds = [F.when(F.col("body").rlike(p), F.lit(k)) for k, p in HEADERS.items()]
    found = lines.withColumn("kind", F.coalesce(*kinds)).where("kind IS NOT NULL")
    part = lambda n: F.coalesce(*[F.when(F.col("kind") == k, F.regexp_extract("body", p, n)) for k, p in HEADERS.items()])
    title = F.trim(part(2))
    number = F.when(F.col("kind") == "appendix", F.concat(F.lit("Appendix_"), part(1))).otherwise(part(1))
    noise = title.rlike(r"(?i)^(figure|table|note)\b") | title.rlike(r"(?i)\b(release|specification)\b") | title.rlike(r"\.{3,}") | number.rlike(r"^\d+\.0+$")
    found = found.select(*keys, "page", "line", "kind", number.alias("number"), title.alias("title")).where(~noise)
    return first_by(found, [*keys, "number"], [F.col("page"), F.col("line")])


def contents(pages: DataFrame, kind: str, text: str = "text") -> DataFrame:
    """(number, title, page) of a contents list's entries; of equal numbers the first."""
    p = CONTENTS[kind]
    hits = pages.select(F.col("page").alias("at"), F.posexplode(F.regexp_extract_all(F.col(text), F.lit(p), 0)).alias("pos", "hit"))
    flat = hits.select("at", "pos", F.regexp_extract("hit", p, 1).alias("number"), F.rtrim(F.trim(F.regexp_extract("hit", p, 2)), F.lit(".")).alias("title"), F.regexp_extract("hit", p, 3).try_cast("int").alias("page"))
    return first_by(flat, ["number"], [F.col("at"), F.col("pos")]).select("number", "title", "page")


def column_map(headings: list[str], hint: dict[str, list[str]] | None = None) -> dict[str, int]:
    """Where the columns of each role stand: headings that are a role's word take it first, then, in their order, those that
    contain one. A hint has other words for some roles. Without a name column the description holds both."""
    words = ROLES | {role: tuple(w.lower() for w in ws) for role, ws in (hint or {}).items() if role in ROLES}
    low, found = [h.strip().lower() for h in headings], {}
    for fits in (lambda h, ws: h in ws, lambda h, ws: any(w in h for w in ws)):
        for i, heading in enumerate(low):
            free = [role for role, ws in words.items() if i not in found.values() and role not in found and fits(heading, ws)]
            if free:
                found[free[0]] = i
    return found


def column_maps(rows: DataFrame, hints: DataFrame | None = None) -> DataFrame:
    """(table, bits, access, description, name): where the columns of each role stand, of every table by its own heading row; null: nowhere.

    rows: (name, row_no, cells), of which row 0 is the heading. hints: (table, role, words) has other words for some roles of some tables.
    As column_map(), in two folds over the headings; headings that repeat are one, which stands where the last of them does."""
    heads = rows.where("row_no = 0").select(F.col("name").alias("table"), F.col("cells").alias("raw"))
    if hints is not None:
        known = hints.where(F.col("role").isin(list(ROLES))).groupBy("table").agg(*[F.first(F.when(F.col("role") == r, F.transform("words", lambda w: F.lower(w))), ignorenulls=True).alias(f"w_{r}") for r in ROLES])
        heads = heads.join(known, "table", "left")
    words = {r: F.coalesce(*([F.col(f"w_{r}")] if hints is not None else []), F.array(*[F.lit(w) for w in ROLES[r]])) for r in ROLES}
    heads = heads.withColumn("low", F.transform("raw", lambda h: F.lower(F.trim(h))))
    none = F.struct(*[F.lit(None).cast("int").alias(r) for r in ROLES])
    one = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)  # noqa: E731  value is worked out once

    def fold(found: Column, fits) -> Column:
        def take(at: Column, i: Column) -> Column:
            heading, raw = F.get("low", i), F.get("raw", i)
            taken = F.exists(F.array(*[at[r] for r in ROLES]), lambda k: F.coalesce(F.get("raw", k) == raw, F.lit(False)))
            role = F.when(~taken, F.coalesce(*[F.when(at[r].isNull() & fits(heading, words[r]), F.lit(r)) for r in ROLES]))
            place = F.size("raw") - F.array_position(F.reverse("raw"), raw).cast("int")
            return one(role, lambda r: F.when(r.isNull(), at).otherwise(F.struct(*[F.when(r == k, place).otherwise(at[k]).alias(k) for k in ROLES])))

        return F.aggregate(F.sequence(F.lit(0), F.greatest(F.size("raw") - 1, F.lit(0))), found, take)

    exact = heads.withColumn("__at", fold(none, lambda h, ws: F.array_contains(ws, h)))
    both = exact.withColumn("__at", fold(F.col("__at"), lambda h, ws: F.exists(ws, lambda w: F.contains(h, w))))
    return both.select("table", *[F.col(f"__at.{r}").alias(r) for r in ROLES])


def hints_of_tables(tables: DataFrame, hints: DataFrame) -> DataFrame:
    """(table, role, words): the columns of the first hint whose pattern is found in a table's title, without regard to case.

    tables: (table_id, title); hints: (match_title, columns: role and names, ord), a configuration: one expression for each of them."""
    listed = [r for r in hints.orderBy("ord").collect() if r["match_title"]]
    place = F.coalesce(*[F.when(F.col("title").rlike("(?i)" + r["match_title"]), F.lit(r["ord"])) for r in listed], F.lit(None).cast("long"))
    chosen = tables.select(F.col("table_id").alias("table"), place.alias("ord")).where("ord IS NOT NULL")
    return chosen.join(F.broadcast(hints.select(F.col("ord"), F.explode("columns").alias("c"))), "ord").select("table", "c.role", F.col("c.names").alias("words"))


def csv_format(cells: Column) -> Column:
    """The layout of a heading row: format, and where location, attribute, name, text, value and meaning stand (null: nowhere)."""
    low = F.transform(cells, lambda h: F.trim(F.lower(h)))
    has = lambda w: F.array_contains(low, w)

    def layout(form: str, **at: int) -> Column:
        return F.struct(F.lit(form).alias("format"), *[F.lit(at.get(k)).cast("int").alias(k) for k in ("location", "attrib", "name", "text", "value", "meaning")])

    own = has("location") & has("attrib")
    five = own & (F.size(low) >= 5) & (has("value") | has("meaning"))
    plain = layout("3col", location=0, attrib=1, text=2)
    return F.when(five, layout("5col", location=0, attrib=1, text=2, value=3, meaning=4)).when(~own & has("address") & has("access"), layout("4col_alt", location=0, attrib=1, name=2, text=3)).otherwise(plain)


def class_versions(classes: DataFrame, rows: DataFrame, versions: list[str]) -> DataFrame:
    """(class_id, version_support): of the first name in a version table that contains a class's name or is contained in it; N/A where there is none.

    classes: (class_id, name); rows: (name, ord, one column for each version). Of equal names the first has the place and the last the values."""
    low = rows.select(F.lower(F.trim("name")).alias("key"), "ord", *[F.col(f"`{v}`") for v in versions]).where("key <> ''")
    last = low.groupBy("key").agg(F.min("ord").alias("ord"), *[F.max_by(F.trim(F.col(f"`{v}`")), "ord").alias(f"v{i}") for i, v in enumerate(versions)])
    titles = last.select(F.col("key").alias("text"), F.col("key").alias("what"), "ord")
    named = classes.select("class_id", F.lower("name").alias("text"))
    into = T.first_holding(named.select(F.col("text").alias("needle")), titles).withColumnRenamed("needle", "text")
    first = into.unionByName(T.first_held(named, titles)).groupBy("text").agg(F.min_by("what", "ord").alias("key"))
    hit = named.join(first, "text", "left").join(last.drop("ord"), "key", "left")
    pairs = [x for i, v in enumerate(versions) for x in (F.lit(v), F.coalesce(f"v{i}", F.lit("N/A")))]
    return hit.select("class_id", F.create_map(*pairs).alias("version_support"))


#: A field's name that begins with its bits, as `7:4 MODE`.
MERGED_BITS = r"^(\d+(?::\d+)?)\s+(.+)"


def field_rows(rows: DataFrame, columns: dict[str, int] | DataFrame, merged_bits: bool = False) -> DataFrame:
    """Fields of tables (name, row_no, cells), the heading row left out: rows without bits continue the field
    before them; reserved fields go, but keep their number, so that the ids have gaps.

    columns: where the roles stand, in all tables or, of column_maps(), in each. A name is the first line of its cell; where there is no
    name column, of the description's. With merged_bits, bits stand before the name in its cell; without a bits column, a row with a name begins a field."""
    body = rows.where("row_no > 0").withColumnRenamed("name", "table")
    if isinstance(columns, DataFrame):
        body = body.join(small(columns.select("table", *[F.col(r).alias(f"__{r}") for r in ROLES])), "table")
    else:
        body = body.withColumns({f"__{r}": F.lit(columns.get(r)).cast("int") for r in ROLES})
    cell = lambda role: F.trim(F.coalesce(F.get("cells", F.col(f"__{role}")), F.lit("")))
    both = F.col("both")
    flat = body.select("table", "row_no", F.col("__name").isNull().alias("both"), F.col("__bits").isNotNull().alias("has_bits"), *[cell(r).alias(r) for r in ROLES])
    flat = flat.withColumns({"name": F.when(both, F.col("description")).otherwise(F.col("name")), "description": F.when(both, "").otherwise(F.col("description"))})
    if merged_bits:
        hit = F.col("name").rlike(MERGED_BITS)
        flat = flat.withColumns({"bits": F.when(hit, F.regexp_extract("name", MERGED_BITS, 1)).otherwise(""), "name": F.when(hit, F.regexp_extract("name", MERGED_BITS, 2)).otherwise(F.col("name"))})
    opens = F.when(F.col("has_bits") | F.lit(merged_bits), F.col("bits") != "").otherwise(F.col("name") != "")
    grouped = gap_fill(flat, "table", "row_no", opens)
    lead = F.row_number().over(Window.partitionBy("table", "grp").orderBy("row_no")) == 1
    more = F.when(both, F.col("name")).otherwise(F.col("description"))
    grouped = grouped.withColumn("more", F.when(lead, F.col("description")).otherwise(more))
    texts = F.transform(F.filter(F.array_sort(F.collect_list(F.struct("row_no", "more"))), lambda x: x["more"] != ""), lambda x: x["more"])
    whole = grouped.groupBy("table", "grp").agg(*[F.min_by(c, "row_no").alias(c) for c in ("bits", "access", "name", "both")], texts.alias("texts"))
    first, rest = F.trim(F.substring_index("name", "\n", 1)), F.trim(F.regexp_replace("name", r"^[^\n]*\n?", ""))
    parts = F.concat(F.filter(F.array(rest), lambda x: x != ""), F.col("texts"))
    text = F.when(both, F.array_join(parts, "\n")).otherwise(F.array_join(parts, " "))
    out = whole.select("table", (F.col("grp") - 1).cast("int").alias("ordinal"), F.col("bits"), C.bit_range(F.col("bits")).alias("b"), first.alias("name"), C.access(F.col("access")).alias("access"), F.trim(text).alias("description"))
    out = out.where((F.col("name") != "") & ~F.lower("name").isin("reserved", "rsvd"))
    return out.select(F.concat_ws("_F", "table", F.format_string("%02d", "ordinal")).alias("field_id"), "table", "ordinal", "bits", "b.high", "b.low", "b.width", "name", "access", "description")


def reference_map(mentions: DataFrame, definitions: DataFrame) -> DataFrame:
    """(id, page, pages, reference_count): where each definition is mentioned, its own page left out."""
    hits = definitions.join(mentions.select("id", F.col("page").alias("at")), "id", "left")
    away = F.when(F.col("at") != F.col("page"), F.col("at"))
    return hits.groupBy("id", "page").agg(F.array_sort(F.collect_set(away)).alias("pages"), F.count(away).alias("reference_count"))


def items_of_sections(sections: DataFrame, items: DataFrame) -> DataFrame:
    """(section, items): ids of what stands on the pages of a section; none: an empty list."""
    held = R.pairs(items.select("page").distinct(), "page", sections.select("section", "start", "end"), "start", "end").select("section", "page").distinct()
    hit = items.join(held, "page").groupBy("section").agg(F.array_sort(F.collect_set("id")).alias("items"))
    return sections.select("section").join(hit, "section", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))


def page_content(nodes: DataFrame) -> DataFrame:
    """(page, one sorted list of ids for each type, text): what stands on a page; its chunks' texts in order."""
    of = lambda kind: F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.col("id"))))
    text = F.array_sort(F.collect_list(F.when(F.col("type") == "SPEC_CHUNK", F.struct("ord", "full_text"))))
    kinds = {"chunks": "SPEC_CHUNK", "tables": "TABLE", "figures": "FIGURE", "registers": "REGISTER"}
    return nodes.where("page IS NOT NULL").groupBy("page").agg(*[of(k).alias(n) for n, k in kinds.items()], F.array_join(F.transform(text, lambda x: x["full_text"]), "\n\n").alias("text"))


def class_members(classes: DataFrame, registers: DataFrame) -> DataFrame:
    """Classes with the ids of their registers in order, and how many they are."""
    listed = registers.groupBy("class_id").agg(F.array_sort(F.collect_list(F.struct("ord", "id"))).alias("m"))
    ids = F.coalesce(F.transform("m", lambda x: x["id"]), F.array().cast("array<string>"))
    return classes.join(listed, "class_id", "left").withColumns({"member_register_ids": ids, "member_count": F.size(ids)}).drop("m")


def fill_missing(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """All new rows, and the old ones whose keys no new row has."""
    return new.unionByName(old.join(new.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def chapter_parts(chapters: DataFrame, last_page: int, pages: int = 40) -> DataFrame:
    """Chapters cut into parts of a number of pages; a chapter ends before the next one of its book starts."""
    end = F.coalesce(F.lead("start").over(Window.partitionBy("book").orderBy("start", "chapter")) - 1, F.lit(last_page))
    held = chapters.withColumn("end", F.greatest(end, F.col("start")))
    parts = held.select("book", "chapter", "end", F.posexplode(F.sequence("start", "end", F.lit(pages))).alias("part", "start"))
    return parts.select("book", "chapter", "part", "start", F.least(F.col("start") + pages - 1, F.col("end")).alias("end"))


def table_pages(definitions: DataFrame, continued: DataFrame, span: int = 5) -> DataFrame:
    """(id, pages): the page that defines a table and those around it, up to span each way, that continue it; a page
    that defines a table or is not among the continued ones ends the run in its direction."""
    steps = definitions.select("id", "page", F.explode(F.expr("array(-1, 1)")).alias("way")).select("*", F.explode(F.sequence(F.lit(1), F.lit(span))).alias("step"))
    steps = steps.select("id", F.col("page").alias("home"), "way", "step", (F.col("page") + F.col("way") * F.col("step")).alias("page"))
    free = continued.select("page").distinct().join(definitions.select("page").distinct(), "page", "left_anti").withColumn("open", F.lit(True))
    marked = steps.join(free, "page", "left")
    held = marked.withColumn("stop", F.min(F.when(F.col("open").isNull(), F.col("step"))).over(Window.partitionBy("id", "home", "way"))).where("stop IS NULL OR step < stop")
    whole = definitions.select("id", "page").unionByName(held.select("id", "page"))
    return whole.groupBy("id").agg(F.array_sort(F.collect_set("page")).alias("pages"))


def build_nodes(rows: DataFrame, kind: str, name: Column, description: Column, text: Column, done: float = 0.95, open_: float = 0.7) -> DataFrame:
    """Nodes of a type out of rows (id, page, status, ord): keywords from the text, confidence by status."""
    keys = F.array_distinct(F.concat(C.keywords(text), C.technical_terms(text)))
    confidence = F.when(F.col("status") == "COMPLETED", F.lit(done)).otherwise(F.lit(open_))
    shown = F.when(F.trim(name) != "", F.trim(name)).otherwise(F.col("id"))
    return rows.select("id", F.lit(kind).alias("type"), F.coalesce(shown, F.col("id")).alias("name"), C.ellipsis(F.coalesce(description, F.lit(""))).alias("description"), F.coalesce(keys, F.array().cast("array<string>")).alias("index_keywords"), "page", confidence.alias("confidence"), "ord")


#: Ranges that number_edges() cuts its rows into at most, so that its plan stays short on large clusters.
MOST_CUTS = 200


def number_edges(edges: DataFrame, prefix: str, order: list[str]) -> DataFrame:
    """Edges with running ids such as REL_REF_0001, without one task for all rows.

    The order's first column is cut into ranges at its quantiles; a range's rows are numbered by themselves and shifted by the counts
    of the ranges before it. Both passes use the same cuts, so that the ranges can't differ; ties stay in one range."""
    spark = edges.sparkSession
    parts = min(spark.sparkContext.defaultParallelism, MOST_CUTS)
    rank, kind = F.col(order[0]), dict(edges.dtypes)[order[0]]
    if kind in ("date", "timestamp", "timestamp_ntz"):
        rank = F.unix_timestamp(rank.cast("timestamp"))
    elif kind == "string":  # by the first characters
        rank = F.conv(F.hex(F.rpad(F.left(rank, F.lit(6)), 6, " ").cast("binary").substr(1, 6)), 16, 10)
    keyed = edges.withColumn("__k", rank.cast("double"))
    cuts = sorted(set(keyed.stat.approxQuantile("__k", [i / parts for i in range(1, parts)], 0.01)))
    piece = F.coalesce(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: F.col("__k") > c)), F.lit(0)) if cuts else F.lit(0)
    ranged = keyed.withColumn("__p", piece)
    sizes = ranged.groupBy("__p").agg(F.count(F.lit(1)).alias("n"))
    before = F.broadcast(sizes.select("__p", (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("__before")))  # one row a range
    local = F.row_number().over(Window.partitionBy("__p").orderBy(*order))
    numbered = ranged.withColumn("__n", local).join(before, "__p")
    return numbered.withColumn("id", F.format_string(prefix + "%04d", F.col("__before") + F.col("__n"))).drop("__k", "__p", "__n", "__before")


def merge_parts(parts: list[DataFrame]) -> DataFrame:
    """One table of all parts, in their order: ord becomes (part, ord)."""
    ranked = [p.withColumn("ord", F.struct(F.lit(i).alias("part"), F.col("ord").cast("long").alias("at"))) for i, p in enumerate(parts)]
    whole = ranked[0]
    for p in ranked[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    return whole


def issues(rows: DataFrame, node: str, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """(node_id, check, severity): one row for each rule (severity, condition) that a row breaks."""
    broken = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(k).alias("check"), F.lit(sev).alias("severity"))) for k, (sev, cond) in rules.items()]))
    return rows.select(F.col(node).alias("node_id"), F.explode(broken).alias("x")).select("node_id", "x.check", "x.severity")


def validate_fields(fields: DataFrame, longest: int = 80) -> DataFrame:
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    return issues(fields, "field_id", {"field_name_length": ("error", F.length("name") > longest), "missing_bits": ("warning", blank("bits")), "missing_access": ("warning", blank("access"))})


def validate_tables(texts: DataFrame) -> DataFrame:
    """Table files that are empty or hold one line at most."""
    lines = F.size(F.filter(F.split("content", "\n"), lambda x: F.trim(x) != ""))
    empty = F.length(F.coalesce("content", F.lit(""))) < 10
    return issues(texts, "name", {"empty_csv": ("error", empty), "single_row": ("warning", ~empty & (lines <= 1))})


def validate_figures(texts: DataFrame) -> DataFrame:
    """Diagram files that are empty or have no start mark."""
    empty = F.length(F.coalesce("content", F.lit(""))) < 10
    return issues(texts, "name", {"empty_diagram": ("error", empty), "no_start_mark": ("warning", ~empty & ~F.contains(F.lower("content"), F.lit("@startuml")))})
