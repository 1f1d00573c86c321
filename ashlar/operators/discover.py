"""Discovery and composed extraction: contents by configured patterns, sections with their page ranges and chunks, registers
out of tables, raw content of long chapters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from . import extract as E
from . import graph as G
from . import grid as H
from . import lookups as L
from . import substrings as T


def contents_by(pages: DataFrame, pattern: str, id_format: str, groups: int = 3, text: str = "text") -> DataFrame:
    """(id, number, title, page) of a contents list by a configured pattern of three groups (number, title, page) or four (chapter,
    number, title, page), sought line by line and without regard to case. id_format has places for `{chapter}` and `{seq}`, or one, `%s`, for the
    number's parts joined by `_`. Of equal numbers the first."""
    form = "(?im)" + pattern
    hits = pages.select(F.col("page").alias("at"), F.posexplode(F.regexp_extract_all(F.col(text), F.lit(form), 0)).alias("pos", "hit"))
    part = lambda n: F.trim(F.regexp_extract("hit", form, n))
    number = part(1) if groups == 3 else F.concat_ws("-", part(1), part(2))
    flat = hits.select("at", "pos", number.alias("number"), F.rtrim(part(groups - 1), F.lit(".")).alias("title"), part(groups).try_cast("int").alias("page"))
    first = G.first_by(flat, ["number"], [F.col("at"), F.col("pos")])
    parts = F.split("number", r"[.\-]")
    rest = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), "_")
    named = F.replace(F.replace(F.replace(F.lit(id_format), F.lit("{chapter}"), parts[0]), F.lit("{seq}"), rest), F.lit("%s"), F.array_join(parts, "_"))
    return first.select(named.alias("id"), "number", F.trim("title").alias("title"), "page")


def headings_by_line(pages: DataFrame, pattern: str = r"^(\d+(?:\.\d+)+)\s*(.*)$", ahead: int = 3, text: str = "text") -> DataFrame:
    """(page, number, title): lines that begin with a number; a title that is missing there is the next of up to three lines with
    text; `(continued)` goes. Of equal numbers the first."""
    lines = pages.select("page", F.posexplode(F.split(F.col(text), "\n")).alias("line", "body")).withColumn("body", F.trim("body")).where("body <> ''")
    after = Window.partitionBy("page").orderBy("line")
    following = F.coalesce(*[F.lead("body", i).over(after) for i in range(1, ahead + 1)])
    marked = lines.withColumn("following", following).where(F.col("body").rlike(pattern))
    own = F.trim(F.regexp_extract("body", pattern, 2))
    title = F.trim(F.regexp_replace(F.when(own != "", own).otherwise(F.coalesce("following", F.lit(""))), r"(?i)\(continued\)", ""))
    flat = marked.select("page", "line", F.regexp_extract("body", pattern, 1).alias("number"), title.alias("title")).where("title <> ''")
    return G.first_by(flat, ["number"], [F.col("page"), F.col("line")]).select("page", "number", "title")


def section_ranges(sections: DataFrame, page_offset: int = 0) -> DataFrame:
    """Sections (number, title, page) with level, parent, id and their last page: where the next one starts, in the order of their
    numbers; the last one keeps its own page. One book has so few sections that its order fits one task (column `book`)."""
    order = Window.partitionBy("book").orderBy(C.appendix_key(F.col("number")))
    end = F.coalesce(F.lead("page").over(order), F.col("page"))
    made = sections.withColumns({"id": C.section_id(F.col("number")), "level": C.section_level(F.col("number")), "parent": C.parent_section(F.col("number")), "end": end})
    return made.withColumns({"spec_start": F.col("page") - page_offset, "spec_end": F.col("end") - page_offset})


def section_structure(pages: DataFrame, page_offset: int = 0) -> DataFrame:
    """The sections of whole books: headers of all pages, of a book's equal numbers the first, with their ranges and parents. pages: (book, page,
    text), or (page, text) of one book."""
    books = pages if "book" in pages.columns else pages.withColumn("book", F.lit(""))
    return section_ranges(E.section_headers(books, keys=["book"]), page_offset)


def chunks_of(pages: DataFrame, sections: DataFrame, max_words: int = 250) -> DataFrame:
    """Chunks of pages (page, text) with the section that a page belongs to, numbered in their section.

    sections: (start, section, title, ord)."""
    packed = G.chunk_paragraphs(pages.select("page", "text"), "text", max_words)
    placed = G.section_of_page(packed, sections.select("start", "section", "ord"))
    titled = placed.join(sections.groupBy("section").agg(F.min_by("title", "ord").alias("title")), "section", "left")
    numbered = L.chunk_positions(titled.withColumnRenamed("chunk_index", "on_page"), "section", ["page", "on_page"])
    name = F.concat(F.lit("CHUNK_"), F.replace(F.coalesce("section", F.lit("0")), F.lit("."), F.lit("_")), F.lit("_"), F.col("chunk_index").cast("string"))
    return numbered.select(name.alias("id"), F.col("section").alias("section_number"), "title", "chunk_index", "page", F.col("chunk_text").alias("full_text"), "word_count")


def sections_with_chunks(chunks: DataFrame) -> DataFrame:
    """(section_number, title, chunks, words, keywords, technical_terms, status): sections out of chunks of chunks_of()."""
    held = chunks.withColumn("ord", F.col("chunk_index").cast("long"))
    counts = held.groupBy("section_number").agg(F.min_by("title", "chunk_index").alias("title"), F.count(F.lit(1)).alias("chunks"), F.sum("word_count").alias("words"))
    return counts.join(L.section_keywords(held), "section_number").withColumn("status", F.when(F.col("chunks") > 0, "COMPLETED").otherwise("PENDING"))


def register_tables(tables: DataFrame, contents: DataFrame, excluded: list[str], also: str = "field descriptions") -> DataFrame:
    """Tables (id, title, ord) whose title speaks of registers, that are not excluded and whose content there is."""
    title = F.lower("title")
    kept = tables.where((F.contains(title, F.lit("register")) | F.contains(title, F.lit(also))) & ~F.col("id").isin(excluded or [""]))
    return kept.join(contents.select(F.col("name").alias("id")).distinct(), "id", "left_semi")


def table_of_register(registers: DataFrame, tables: DataFrame) -> DataFrame:
    """(id, table_id): the first table whose title is the register's name, contains it, or contains it without spaces, underscores and
    hyphens. registers: (id, name); tables: (table_id, title, ord)."""
    bare = lambda c: F.regexp_replace(F.lower(c), r"[\s_\-]", "")  # noqa: E731  a title that contains a name also does so without them
    named = registers.select("id", bare(F.trim(F.replace(F.lower("name"), F.lit(" register"), F.lit("")))).alias("needle"))
    own = bare(F.trim(F.replace(F.lower("title"), F.lit("field descriptions"), F.lit(""))))
    held = T.first_holding(named, tables.select(bare(F.col("title")).alias("text"), F.col("table_id").alias("what"), "ord"))
    same = tables.groupBy(own.alias("needle")).agg(F.min(F.struct("ord", F.col("table_id").alias("what"))).alias("x")).select("needle", "x.ord", "x.what")
    first = held.unionByName(same).groupBy("needle").agg(F.min_by("what", "ord").alias("table_id"), F.min("ord").alias("ord"))
    return named.join(first, "needle", "left").groupBy("id").agg(F.min_by("table_id", "ord").alias("table_id"))


def class_of_names(classes: DataFrame, tables: DataFrame) -> DataFrame:
    """(class_id, table_id): the first table whose name contains the class's name, or the other way round. classes: (class_id, name);
    tables: (table_id, title, ord)."""
    named = classes.select("class_id", F.lower("name").alias("text"))
    titles = tables.select(F.lower("title").alias("text"), F.col("table_id").alias("what"), "ord")
    into = T.first_holding(named.select(F.col("text").alias("needle")), titles).withColumnRenamed("needle", "text")
    first = into.unionByName(T.first_held(named, titles)).groupBy("text").agg(F.min_by("what", "ord").alias("table_id"), F.min("ord").alias("ord"))
    return named.join(first, "text", "left").groupBy("class_id").agg(F.min_by("table_id", "ord").alias("table_id"))


def offset_of_table(tables: DataFrame, known: DataFrame, titled: DataFrame) -> DataFrame:
    """(table_id, offset): the offset that is configured for a table, else that of a title which equals its cleaned title, else the
    one in its title. known: (table_id, offset), one row a key; titled: (title, offset), of titles that are equal once cleaned the least."""
    clean = lambda c: F.trim(F.regexp_replace(F.lower(c), r"\(offset[^)]*\)", ""))
    by_title = titled.groupBy(clean(F.col("title")).alias("key")).agg(F.min_by("offset", "title").alias("of_title"))
    both = tables.join(known.select("table_id", F.col("offset").alias("direct")), "table_id", "left").withColumn("key", clean(F.col("title"))).join(by_title, "key", "left")
    return both.select("table_id", F.coalesce("direct", "of_title", C.register_of_title(F.col("title"))["offset"]).alias("offset"))


def registers_of(config: DataFrame, tables: DataFrame, classes: DataFrame, cells: DataFrame, columns: dict[str, int] | None = None, hints: DataFrame | None = None) -> DataFrame:
    """Registers with class, table and fields. config: (offset, name, ord) and, where it is given, table_id, which goes before a table found by
    name; tables: (table_id, title, ord); classes as of class_of_offset(); cells: rows of the tables (name, row_no, cells). Without
    columns, each table's heading row tells where its roles stand, with the words of hints (match_title, columns, ord) where one fits its title."""
    if columns is None:
        columns = E.column_maps(cells, None if hints is None else E.hints_of_tables(tables, hints))
    made = config.select(F.concat(F.lit("REG_"), C.norm_offset(F.col("offset"))).alias("id"), "name", "offset", "ord", C.offset_int(F.col("offset")).alias("offset_int"), *(["table_id"] if "table_id" in config.columns else [F.lit(None).cast("string").alias("table_id")]))
    found = table_of_register(made.select("id", "name"), tables).withColumnRenamed("table_id", "by_name")
    placed = made.join(found, "id", "left").withColumn("spec_table", F.coalesce("table_id", "by_name")).drop("table_id", "by_name")
    placed = placed.join(G.class_of_offset(made.select("id", "offset_int"), classes).select("id", "class_id"), "id", "left")
    rows = E.field_rows(cells, columns)
    of = rows.groupBy(F.col("table").alias("spec_table")).agg(F.array_sort(F.collect_list(F.struct("ordinal", "name", "bits", F.col("high").alias("bit_high"), F.col("low").alias("bit_low"), "width", "access", F.col("description").alias("raw")))).alias("f"))
    joined = placed.join(of, "spec_table", "left")
    fields = F.transform(F.coalesce("f", F.array().cast(of.schema["f"].dataType)), lambda x: x.withField("id", F.concat("id", F.lit("_F"), x["ordinal"].cast("string"))))
    return joined.select("id", "name", "offset", "offset_int", "class_id", "spec_table", "ord", fields.alias("fields"))


def pages_with_items(items: DataFrame) -> DataFrame:
    """(page, ids): what stands on each page."""
    return items.groupBy("page").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def raw_content(bookmarks: DataFrame, pages: DataFrame, last_page: int, level: int = 1, part_pages: int = 40, words: int = 8000) -> DataFrame:
    """(id, book, chapter, part, start, end, text): the texts of long chapters in parts of so many pages, cut at a number of words.

    bookmarks: (book, level, title, page); pages: (book, page, text). Each page meets its part by the part's number in its chapter, an
    equi-join on (book, page)."""
    chapters = bookmarks.where(F.col("level") == level).select("book", F.col("title").alias("chapter"), F.col("page").alias("start"))
    parts = E.chapter_parts(chapters, last_page, part_pages)
    order = Window.partitionBy("book").orderBy("start", "chapter")
    named = parts.withColumn("id", F.format_string("RM_RAW_%03d", F.row_number().over(order)))
    flat = named.select("*", F.explode(F.sequence("start", "end")).alias("page")).join(pages, ["book", "page"], "left")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text")))), lambda x: x["text"]), "\n")
    return flat.groupBy("id", "book", "chapter", "part", "start", "end").agg(C.cap_words(text, words).alias("text"))


def discovery_counts(sections: DataFrame, tables: DataFrame, figures: DataFrame) -> DataFrame:
    """(what, n): how many entries discovery found."""
    one = lambda df, what: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")
    return one(sections, "sections").unionByName(one(tables, "tables")).unionByName(one(figures, "figures"))


def multipart(tables: DataFrame) -> DataFrame:
    """Tables whose title says that they are one of several parts."""
    return tables.where(F.contains("title", F.lit("Part")) | F.contains("title", F.lit("(")))


def edges_between(boxes: DataFrame, lines: DataFrame) -> DataFrame:
    """(source, target): lines whose ends lie in boxes, the last box that holds an end wins, and lines from a box to itself go.

    boxes: (drawing, id, x0, y0, x1, y1, ord); lines: (drawing, line, x0, y0, x1, y1)."""
    of = lambda n: F.struct(F.col(f"x{n}").alias("x"), F.col(f"y{n}").alias("y"))
    ends = lines.select("drawing", "line", F.posexplode(F.array(of(0), of(1))).alias("end", "e")).select("drawing", "line", "end", "e.x", "e.y")
    hit = H.holding(ends, boxes)
    found = hit.groupBy("drawing", "line").agg(*[F.max(F.when(F.col("end") == i, F.col("box"))).alias(name) for i, name in enumerate(("source", "target"))])
    return found.where("source IS NOT NULL AND target IS NOT NULL AND source <> target").select("drawing", "line", "source", "target")


def mermaid(boxes: DataFrame, edges: DataFrame) -> DataFrame:
    """(drawing, text): a flow chart of labelled boxes (drawing, id, label, x0, y0) in reading order, and of edges."""
    quoted = F.replace(F.col("label"), F.lit('"'), F.lit("'"))
    rows = boxes.select("drawing", "y0", "x0", "id", F.concat(F.lit("    "), "id", F.lit('["'), quoted, F.lit('"]')).alias("text"))
    nodes = rows.groupBy("drawing").agg(F.transform(F.array_sort(F.collect_list(F.struct("y0", "x0", "id", "text"))), lambda x: x["text"]).alias("n"))
    links = edges.groupBy("drawing").agg(F.array_sort(F.collect_set(F.concat(F.lit("    "), "source", F.lit(" --> "), "target"))).alias("e"))
    none = F.array().cast("array<string>")
    return nodes.join(links, "drawing", "left").select("drawing", F.array_join(F.concat(F.array(F.lit("flowchart TD")), F.col("n"), F.coalesce("e", none)), "\n").alias("text"))
