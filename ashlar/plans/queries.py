"""Registered queries of the graph operators over the driver's tables, each with its SQL.

Stand-ins: parts are registers, line items their fields and edges to suppliers, nations features under
regions, orders carry coverage, documents are text chunks, conversations sequences, events time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import extract as E
from ..operators import graph as G
from .catalog import GraphCatalog

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def registers(s, d):
    p = t(s, d, "part")
    hexed = F.hex("p_partkey")
    return p.select(F.concat(F.lit("REG_"), hexed).alias("id"), F.lit("REGISTER").alias("type"), F.col("p_name").alias("name"), F.col("p_type").alias("description"), F.split(F.lower("p_type"), " ").alias("index_keywords"),
                    F.concat(F.lower(hexed), F.lit("h")).alias("offset_hex"), F.concat(F.lit("REGCLASS_"), "p_brand").alias("class_id"), F.col("p_partkey").alias("ord")).withColumns({"offset_norm": C.norm_offset(F.col("offset_hex")), "offset_int": C.offset_int(F.col("offset_hex"))})


REG = "WITH reg AS (SELECT 'REG_' || printf('%X', p_partkey) AS id, p_name AS name, p_type AS description, lpad(printf('%X', p_partkey), greatest(3, length(printf('%X', p_partkey)))::INT, '0') AS offset_norm, p_partkey AS offset_int, 'REGCLASS_' || p_brand AS class_id, p_partkey AS ord, p_size FROM part) "


def fields(s, d):
    access = F.when(F.col("l_returnflag") == "A", "RO").when(F.col("l_returnflag") == "R", "WO").otherwise("RW")
    return t(s, d, "lineitem").select(F.concat(F.lit("REG_"), F.hex("l_partkey")).alias("register_id"), "l_partkey", "l_orderkey", "l_linenumber", (F.col("l_linenumber") * 4).alias("bit_low"), (F.col("l_linenumber") * 4 + 3).alias("bit_high"), C.access(access).alias("access"))


FLD = "WITH fld AS (SELECT 'REG_' || printf('%X', l_partkey) AS register_id, l_partkey, l_orderkey, l_linenumber, l_linenumber * 4 AS bit_low, l_linenumber * 4 + 3 AS bit_high, CASE l_returnflag WHEN 'A' THEN 'read-only' WHEN 'R' THEN 'write-only' ELSE 'read-write' END AS access FROM lineitem) "


def chunks(s, d):
    section = F.concat_ws(".", (1 + F.col("doc_id") % 7).cast("string"), (1 + F.col("doc_id") % 5).cast("string"))
    return t(s, d, "documents").select(F.concat(F.lit("CHUNK_"), "doc_id").alias("id"), F.col("text").alias("full_text"), section.alias("section_number"), F.col("doc_id").alias("ord"), F.col("doc_id").alias("chunk_index"), F.floor(F.col("doc_id") / 10).alias("page"), "source")


CHK = "WITH chk AS (SELECT 'CHUNK_' || doc_id AS id, text AS full_text, (1 + doc_id % 7) || '.' || (1 + doc_id % 5) AS section_number, doc_id AS ord, doc_id // 10 AS page, source FROM documents) "


@query(REG + "SELECT id, name, offset_norm FROM reg WHERE id = 'REG_2A' ORDER BY ord DESC LIMIT 1")
def node_by_id(s, d):
    return G.by_id(registers(s, d), "REG_2A").select("id", "name", "offset_norm")


@query(REG + "SELECT id, offset_norm || 'h' AS offset_hex FROM reg WHERE offset_norm = '02A'")
def register_by_offset(s, d):
    r = registers(s, d)
    return r.where(F.col("offset_norm") == C.norm_offset(F.lit("0x2ah"))).select("id", C.format_offset(F.col("offset_hex")).alias("offset_hex"))


@query(REG + "SELECT id, name, offset_int FROM reg WHERE offset_int BETWEEN 16 AND 255")
def registers_in_range(s, d):
    return G.registers_in_range(registers(s, d), "10h", "0xFF").select("id", "name", "offset_int")


@query(REG + "SELECT id, name, offset_norm, class_id FROM reg")
def register_map(s, d):
    return registers(s, d).orderBy("offset_int", "ord").select("id", "name", "offset_norm", "class_id")


@query(REG + "SELECT id, name FROM reg WHERE contains(lower(name), 're')")
def register_by_name_like(s, d):
    return registers(s, d).where(F.contains(F.lower("name"), F.lit("re"))).select("id", "name")


@query(FLD + "SELECT access, count(*) AS n FROM fld GROUP BY access")
def fields_by_access(s, d):
    return fields(s, d).groupBy("access").agg(F.count(F.lit(1)).alias("n"))  # codes by C.access()


@query(FLD + "SELECT register_id, min_by(l_orderkey, l_orderkey * 10 + l_linenumber) AS l_orderkey FROM fld WHERE 13 BETWEEN bit_low AND bit_high GROUP BY register_id")
def field_by_bit(s, d):
    return fields(s, d).where(F.lit(13).between(F.col("bit_low"), F.col("bit_high"))).groupBy("register_id").agg(F.min_by("l_orderkey", F.struct("l_orderkey", "l_linenumber")).alias("l_orderkey"))


@query(FLD + "SELECT register_id, l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY register_id ORDER BY l_orderkey, l_linenumber) - 1 AS INTEGER) AS pos FROM fld WHERE register_id = 'REG_2A'")
def fields_of_register(s, d):
    w = Window.partitionBy("register_id").orderBy("l_orderkey", "l_linenumber")
    return fields(s, d).where("register_id = 'REG_2A'").select("register_id", "l_orderkey", "l_linenumber", (F.row_number().over(w) - 1).alias("pos"))


@query("SELECT p_partkey, p_brand FROM part WHERE upper(p_brand) = 'BRAND#12' ORDER BY (p_brand = 'Brand#12') DESC, p_partkey LIMIT 1")
def table_by_reference(s, d):
    ref = "Brand#12"
    hit = t(s, d, "part").where(F.lower("p_brand") == ref.lower())
    return hit.orderBy(F.desc(F.col("p_brand") == ref), "p_partkey").limit(1).select("p_partkey", "p_brand")


@query("SELECT l_suppkey AS target, l_linestatus AS type, count(*) AS n FROM lineitem WHERE l_partkey = 42 GROUP BY ALL")
def relations_from(s, d):
    return t(s, d, "lineitem").where("l_partkey = 42").groupBy(F.col("l_suppkey").alias("target"), F.col("l_linestatus").alias("type")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_partkey AS id, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey = 3 AND l_linestatus = 'F'")
def neighbours_by_type(s, d):
    sup = t(s, d, "supplier").where("s_nationkey = 3").select("s_suppkey", "s_name")
    return t(s, d, "lineitem").where("l_linestatus = 'F'").join(sup, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_partkey").alias("id"), "s_name")


CLASSES = [(i, f"CLASS_{i}", 200 * i, 200 * i + 149) for i in range(8)]


@query(REG + ", cls AS (SELECT i AS ord, 'CLASS_' || i AS class_id, 200 * i AS lo, 200 * i + 149 AS hi FROM range(8) r(i)) SELECT id, min_by(cls.class_id, cls.ord) AS class_id FROM reg LEFT JOIN cls ON offset_int BETWEEN lo AND hi GROUP BY id")
def class_of_offset(s, d):
    classes = s.createDataFrame(CLASSES, "ord int, class_id string, start_int long, end_int long")
    return G.class_of_offset(registers(s, d).drop("class_id"), classes).select("id", "class_id")


@query(CHK + ", sec AS (SELECT 3 * i AS start, 'S' || i AS section FROM range(1, 12) r(i)) SELECT page, max_by(section, start) AS section FROM (SELECT DISTINCT page FROM chk) p LEFT JOIN sec ON start <= page GROUP BY page")
def section_of_page(s, d):
    sections = s.createDataFrame([(3 * i, f"S{i}", i) for i in range(1, 12)], "start int, section string, ord int")
    return G.section_of_page(chunks(s, d).select("page").distinct(), sections).select("page", "section")


@query("WITH ti AS (SELECT n_nationkey AS ord, n_name || ' offset table' AS title FROM nation) SELECT s_suppkey AS id, min_by(title, ord) AS title FROM supplier JOIN nation n ON s_nationkey = n.n_nationkey LEFT JOIN ti ON contains(lower(title), lower(n.n_name)) GROUP BY s_suppkey")
def title_match_first(s, d):
    n = t(s, d, "nation")
    names = t(s, d, "supplier").join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("id"), F.concat("n_name", F.lit(" Register")).alias("name"))  # 25 nations
    return G.title_match(names, n.select(F.concat("n_name", F.lit(" offset table")).alias("title"), F.col("n_nationkey").alias("ord")))


@query("SELECT r_name, string_agg(n_name, ',' ORDER BY n_nationkey) AS children, count(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def feature_tree(s, d):
    kids = t(s, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("k"))
    return t(s, d, "region").join(kids, F.col("r_regionkey") == F.col("n_regionkey")).select("r_name", F.array_join("k.n_name", ",").alias("children"), F.size("k").cast("long").alias("n"))


@query(CHK + ", f AS (SELECT section_number, min_by(id, ord) AS id FROM chk GROUP BY 1 UNION ALL SELECT CAST(1 + doc_id % 7 AS VARCHAR), 'TOP_' || min(doc_id) FROM documents GROUP BY 1) SELECT c.id AS source_node, p.id AS target_node FROM f c JOIN f p ON p.section_number = regexp_replace(c.section_number, '\\.[^.]*$', '') WHERE contains(c.section_number, '.')")
def child_of_edges(s, d):
    c = chunks(s, d).select("id", "section_number", "chunk_index", "ord")
    top = t(s, d, "documents").groupBy((1 + F.col("doc_id") % 7).cast("string").alias("section_number")).agg(F.min("doc_id").alias("ord")).select(F.concat(F.lit("TOP_"), "ord").alias("id"), "section_number", F.lit(0).cast("long").alias("chunk_index"), "ord")
    return G.child_of(c.unionByName(top)).select("source_node", "target_node")


@query("SELECT o_orderstatus AS status, o_orderpriority AS type, count(*) AS n FROM orders GROUP BY ALL")
def coverage_summary(s, d):
    nodes = t(s, d, "orders").select(F.struct(F.col("o_orderstatus").alias("status")).alias("coverage"), F.col("o_orderpriority").alias("type"))
    return GraphCatalog(nodes, None).get_coverage_summary().withColumnRenamed("count", "n")


@query("SELECT coalesce(p_brand, 'ALL') AS type, count(*) AS nodes, sum(p_size) AS size FROM part GROUP BY ROLLUP (p_brand)")
def graph_statistics(s, d):
    return t(s, d, "part").rollup("p_brand").agg(F.count(F.lit(1)).alias("nodes"), F.sum("p_size").alias("size")).select(F.coalesce("p_brand", F.lit("ALL")).alias("type"), "nodes", "size")


@query("SELECT w AS grp, count(*) AS n, min(p_partkey) AS first_id FROM (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS w FROM part) GROUP BY w")
def feature_groups(s, d):
    return t(s, d, "part").select("p_partkey", F.explode(F.split("p_type", " ")).alias("grp")).groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_id"))


@query(CHK + "SELECT section_number, count(*) AS n, min_by(id, ord) AS first_id, min(CASE WHEN page <> 0 THEN page END) AS page FROM chk GROUP BY section_number")
def section_summary(s, d):
    return chunks(s, d).groupBy("section_number").agg(F.count(F.lit(1)).alias("n"), F.min_by("id", "ord").alias("first_id"), F.min(F.when(F.col("page") != 0, F.col("page"))).alias("page"))


@query("SELECT l_partkey AS offset_norm, sum(CASE WHEN n = 1 OR l_orderkey = base THEN 1 ELSE 0 END)::BIGINT AS kept FROM (SELECT l_partkey, l_orderkey, l_linenumber, min(l_orderkey) OVER (PARTITION BY l_partkey) AS base, row_number() OVER (PARTITION BY l_partkey, l_linenumber ORDER BY l_orderkey) AS n FROM lineitem) GROUP BY l_partkey")
def merge_by_offset(s, d):
    f = t(s, d, "lineitem").select(F.col("l_partkey").alias("offset_norm"), F.col("l_orderkey").alias("register_ord"), F.col("l_linenumber").cast("string").alias("bits"), F.col("l_linenumber").alias("pos"))
    return G.merge_by_offset(f).groupBy("offset_norm").agg(F.count(F.lit(1)).alias("kept"))


@query("SELECT c_mktsegment, min(c_custkey) AS c_custkey FROM customer GROUP BY 1")
def first_seen_dedupe(s, d):
    return G.first_by(t(s, d, "customer").select("c_mktsegment", "c_custkey"), ["c_mktsegment"], [F.col("c_custkey")])


SCORE = "(CASE WHEN contains(h, 'brass') THEN 1 ELSE 0 END + CASE WHEN contains(h, 'a') THEN 1 ELSE 0 END + CASE WHEN contains(h, '12') THEN 1 ELSE 0 END)"


@query(REG + f", x AS (SELECT id, ord, lower(name || ' ' || description || ' ' || description) AS h FROM reg) SELECT id, {SCORE} AS score FROM x WHERE {SCORE} > 0 ORDER BY score DESC, ord LIMIT 20")
def search_nodes(s, d):
    return G.search_nodes(registers(s, d), "brass a 12 brass", 20).select("id", "score")


@query("WITH x AS (SELECT 'REG_' || printf('%X', p_partkey) AS id, string_split(lower(p_type), ' ') AS k FROM part), m AS (SELECT id, (CASE WHEN list_contains(k, 'brass') THEN 1 ELSE 0 END) + (CASE WHEN list_contains(k, 'small') THEN 1 ELSE 0 END) AS n FROM x) SELECT id, n / 2.0::DOUBLE AS score FROM m WHERE n > 0")
def search_keywords(s, d):
    return G.search_keywords(registers(s, d), ["Brass", "SMALL"]).select("id", "score")


@query(CHK + "SELECT id, instr(lower(full_text), 'ation') - 1 AS position, (CASE WHEN instr(lower(full_text), 'ation') > 51 THEN '...' ELSE '' END) || substr(full_text, greatest(instr(lower(full_text), 'ation') - 50, 1), least(instr(lower(full_text), 'ation') + 54, length(full_text)) - greatest(instr(lower(full_text), 'ation') - 50, 1) + 1) || (CASE WHEN instr(lower(full_text), 'ation') + 54 < length(full_text) THEN '...' ELSE '' END) AS excerpt FROM chk WHERE contains(lower(full_text), 'ation')")
def search_text_excerpt(s, d):
    return G.search_text(chunks(s, d), "ation").select("id", F.col("position").cast("long").alias("position"), "excerpt")


STOP = ", ".join(f"'{w}'" for w in C.STOP_WORDS)


@query(f"WITH tok AS (SELECT doc_id, i, w[i] AS k FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}\\p{{M}}_]+') AS w FROM documents), unnest(range(1, len(w) + 1)) u(i)), f AS (SELECT doc_id, k, min(i) AS i FROM tok WHERE regexp_full_match(k, '[a-z][a-z0-9_]{{2,}}') AND k NOT IN ({STOP}) GROUP BY ALL), r AS (SELECT doc_id, k, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM f) SELECT doc_id, string_agg(k, ' ' ORDER BY i) AS keywords FROM r WHERE n <= 20 GROUP BY doc_id")
def keywords(s, d):
    found = t(s, d, "documents").select("doc_id", F.array_join(C.keywords(F.col("text")), " ").alias("keywords"))
    return found.select("doc_id", F.explode(F.filter(F.array("keywords"), lambda k: k != "")).alias("keywords"))  # worked out once


@query("SELECT p_partkey, 'TABLE_' || p_size || '_' || (p_partkey % 9) || ',TABLE_1_2' AS refs FROM part")
def table_refs(s, d):
    text = F.concat(F.lit("see Table "), "p_size", F.lit("-"), F.col("p_partkey") % 9, F.lit(" and table 1-2, not Table x"))
    return t(s, d, "part").select("p_partkey", F.array_join(C.references(text), ",").alias("refs"))


@query("SELECT p_partkey, p_size + 3 AS high, p_size AS low, 4 AS width FROM part")
def bit_range(s, d):
    text = F.concat(F.lit("["), F.col("p_size") + 3, F.lit(":"), "p_size", F.lit("]"))
    return t(s, d, "part").select("p_partkey", C.bit_range(text).alias("b")).select("p_partkey", "b.high", "b.low", "b.width")


@query(CHK + "SELECT section_number, CAST(row_number() OVER (ORDER BY split_part(section_number, '.', 1)::INT, split_part(section_number, '.', 2)::INT) AS INTEGER) AS n FROM (SELECT DISTINCT section_number FROM chk)")
def section_sort(s, d):
    return chunks(s, d).select("section_number").distinct().select("section_number", F.row_number().over(Window.orderBy(C.section_key(F.col("section_number")))).alias("n"))  # 35 sections


@query("SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> ''))::INTEGER AS n FROM documents")
def word_counts(s, d):
    return t(s, d, "documents").select("doc_id", C.count_words(F.col("text")).alias("n"))


@query("SELECT 'C' || conv_id || '_' || turn AS source_node, 'C' || conv_id || '_' || nxt AS target_node FROM (SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM conversations) WHERE nxt IS NOT NULL")
def sequence_next(s, d):
    c = t(s, d, "conversations").select("conv_id", "turn", F.concat(F.lit("C"), "conv_id", F.lit("_"), "turn").alias("id"))
    return G.sequence_next(c, "conv_id", ["turn"])


@query("SELECT o_custkey, o_orderkey, coalesce(lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1, 1000000000) AS end_key FROM orders")
def section_page_end(s, d):
    after = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return t(s, d, "orders").select("o_custkey", "o_orderkey", F.coalesce(after - 1, F.lit(1000000000)).alias("end_key"))


@query("SELECT user_id, grp, count(*) AS n FROM (SELECT user_id, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS grp FROM events) WHERE grp > 0 GROUP BY ALL")
def gap_fill_groups(s, d):
    return G.gap_fill(t(s, d, "events"), "user_id", "event_id", F.col("event_type") == "click").groupBy("user_id", "grp").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, unnest(range(1, p_size + 1, 40))::INTEGER AS start FROM part")
def subchunk_ranges(s, d):
    return t(s, d, "part").select("p_partkey", F.explode(F.sequence(F.lit(1), "p_size", F.lit(40))).alias("start"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')")
def dangling_edges(s, d):
    known = t(s, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return t(s, d, "lineitem").select("l_orderkey", "l_linenumber").join(known, "l_orderkey", "left_anti")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def orphans(s, d):
    nodes = t(s, d, "customer").select(F.col("c_custkey").alias("id"))
    o = t(s, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("source_node"), F.col("o_custkey").alias("target_node"))
    return G.orphans(nodes, o).select(F.col("id").alias("c_custkey"))


@query("SELECT l_partkey, l_suppkey, count(*) - 1 AS repeats FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_ids(s, d):
    nodes = t(s, d, "lineitem").select(F.concat_ws("_", "l_partkey", "l_suppkey").alias("id"), F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate").alias("ord"), F.lit("n").alias("name"))
    none = nodes.where("false").select(F.col("id").alias("source_node"), F.col("id").alias("target_node"))
    again = G.validate(nodes, none).where("check = 'duplicate_id'").groupBy("node_id").agg(F.count(F.lit(1)).alias("repeats"))
    return again.select(F.substring_index("node_id", "_", 1).cast("long").alias("l_partkey"), F.substring_index("node_id", "_", -1).cast("long").alias("l_suppkey"), "repeats")


@query("SELECT i AS page FROM (SELECT max(o_custkey) AS m FROM orders), unnest(range(1, m + 1)) r(i) WHERE i NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def missing_pages(s, d):
    o = t(s, d, "orders")
    return G.missing_numbers(o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("page")), "page", 1, o.agg(F.max("o_custkey")).first()[0] or 0)


@query("SELECT p_partkey, CASE WHEN contains(lower(p_type), 'brass') THEN 'B' WHEN contains(lower(p_type), 'small') THEN 'S' ELSE 'OTHER' END AS kind FROM part")
def classify_first_rule(s, d):
    return t(s, d, "part").select("p_partkey", C.first_rule(F.col("p_type"), [("brass", "B"), ("small", "S")]).alias("kind"))


@query("SELECT node_id, severity, count(*) AS n FROM (SELECT p_partkey AS node_id, 'error' AS severity FROM part WHERE p_size < 3 UNION ALL SELECT p_partkey, 'warning' FROM part WHERE length(p_name) > 20) GROUP BY ALL")
def rule_issues(s, d):
    rules = {"small": ("error", F.col("p_size") < 3), "long": ("warning", F.length("p_name") > 20)}
    return E.issues(t(s, d, "part"), "p_partkey", rules).groupBy("node_id", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH RECURSIVE par AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k, n, trim(body) AS body FROM (SELECT doc_id, i, len(list_filter(regexp_split_to_array(p[i], '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '')) AS n, p[i] AS body FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents), unnest(range(1, len(p) + 1)) u(i)) WHERE trim(body) <> ''),
 w AS (SELECT doc_id, k, n, n AS held, 0 AS chunk, body FROM par WHERE k = 1 UNION ALL SELECT par.doc_id, par.k, par.n, CASE WHEN w.held + par.n <= 50 THEN w.held + par.n ELSE par.n END, CASE WHEN w.held + par.n <= 50 THEN w.chunk ELSE w.chunk + 1 END, par.body FROM w JOIN par ON par.doc_id = w.doc_id AND par.k = w.k + 1)
 SELECT doc_id, chunk::INTEGER AS chunk_index, sum(n)::INTEGER AS word_count, sha256(string_agg(body, chr(10) ORDER BY k)) AS text_sha256 FROM w GROUP BY doc_id, chunk""")
def chunk_pages(s, d):
    return G.chunk_paragraphs(t(s, d, "documents").select("doc_id", "text"), "text", 50, "\n").select("doc_id", "chunk_index", "word_count", F.sha2("chunk_text", 256).alias("text_sha256"))


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def events_by_day(s, d):
    return t(s, d, "events").groupBy(F.date_trunc("day", "ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(CHK + "SELECT d.id, d.page, count(CASE WHEN m.page <> d.page THEN 1 END) AS reference_count, coalesce(string_agg(DISTINCT CASE WHEN m.page <> d.page THEN m.page END::VARCHAR, ',' ORDER BY CASE WHEN m.page <> d.page THEN m.page END::VARCHAR), '') AS pages FROM (SELECT source AS id, min(page) AS page FROM chk GROUP BY 1) d LEFT JOIN chk m ON m.source = d.id GROUP BY ALL")
def reference_map(s, d):
    c = chunks(s, d).select(F.col("source").alias("id"), "page")
    found = E.reference_map(c, c.groupBy("id").agg(F.min("page").alias("page")))
    return found.select("id", "page", "reference_count", F.array_join(F.array_sort(F.col("pages").cast("array<string>")), ",").alias("pages"))


@query(REG + ", b AS (SELECT DISTINCT p_brand FROM part) SELECT 'REGCLASS_' || p_brand AS class_id, count(*)::INTEGER AS member_count, string_agg(id, ',' ORDER BY ord) AS members FROM b JOIN reg ON class_id = 'REGCLASS_' || p_brand GROUP BY ALL")
def class_members(s, d):
    r = registers(s, d)
    return E.class_members(r.select("class_id").distinct(), r).select("class_id", "member_count", F.array_join("member_register_ids", ",").alias("members"))


@query(REG + ", sec AS (SELECT i, 150 * i AS lo, 150 * i + 99 AS hi FROM (SELECT max(p_partkey) // 150 AS m FROM part), unnest(range(m + 1)) r(i)) SELECT 'S' || i AS section, coalesce(string_agg(id, ',' ORDER BY id), '') AS items FROM sec LEFT JOIN reg ON ord BETWEEN lo AND hi GROUP BY i")
def items_of_sections(s, d):
    items = registers(s, d).select("id", F.col("ord").alias("page"))
    last = items.agg(F.max("page")).first()[0] or 0
    sections = s.range(last // 150 + 1).select(F.concat(F.lit("S"), "id").alias("section"), (150 * F.col("id")).alias("start"), (150 * F.col("id") + 99).alias("end"))
    return E.items_of_sections(sections, items).select("section", F.array_join("items", ",").alias("items"))


@query(CHK + "SELECT page, count(*)::INTEGER AS n_chunks, sha256(string_agg(full_text, chr(10) || chr(10) ORDER BY ord)) AS text_sha256 FROM chk GROUP BY page")
def page_content(s, d):
    nodes = chunks(s, d).withColumn("type", F.lit("SPEC_CHUNK"))
    return E.page_content(nodes).select("page", F.size("chunks").alias("n_chunks"), F.sha2("text", 256).alias("text_sha256"))


@query("SELECT c_custkey, c_mktsegment, 'new' AS origin FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT c_custkey, c_mktsegment, 'old' FROM customer WHERE c_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey IS NOT NULL)")
def fill_missing(s, d):
    c = t(s, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    new = c.where("c_mktsegment = 'BUILDING'").withColumn("origin", F.lit("new"))
    return E.fill_missing(new, c.withColumn("origin", F.lit("old")), ["c_nationkey"]).drop("c_nationkey")


@query("WITH h AS (SELECT o_custkey AS book, o_orderkey AS start, greatest(o_orderkey, coalesce(lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1, 1000000)) AS stop FROM orders) SELECT book, start AS chapter, k::INTEGER AS part, start + k * 50000 AS start, least(start + k * 50000 + 49999, stop) AS \"end\" FROM h, unnest(range(0, (stop - start) // 50000 + 1)) u(k)")
def chapter_parts(s, d):
    o = t(s, d, "orders").select(F.col("o_custkey").alias("book"), F.col("o_orderkey").alias("chapter"), F.col("o_orderkey").alias("start"))
    return E.chapter_parts(o, 1_000_000, 50_000)


@query("SELECT p_partkey || '.' || (1 + p_size % 9) AS number, 'About ' || p_name AS title, p_size AS page FROM part")
def contents_entries(s, d):
    line = F.concat(F.lit("\n "), "p_partkey", F.lit("."), 1 + F.col("p_size") % 9, F.lit("  About "), "p_name", F.lit(" ....... "), "p_size", F.lit("\n"))
    return E.contents(t(s, d, "part").select(F.col("p_partkey").alias("page"), line.alias("text")), "section")


@query("SELECT p_partkey AS page, 'Appendix_' || chr(65 + (p_partkey % 26)::INT) AS number, 'About ' || p_name AS title FROM part QUALIFY row_number() OVER (PARTITION BY p_partkey % 26 ORDER BY p_partkey) = 1")
def section_headers(s, d):
    body = F.concat(F.lit("text\nAppendix "), F.char(65 + F.col("p_partkey") % 26), F.lit(" (Normative) : About "), "p_name", F.lit("\n3.0 Not A Header\n2.1 Table of things"))
    return E.section_headers(t(s, d, "part").select(F.col("p_partkey").alias("page"), body.alias("text"))).select("page", "number", "title")


@query("WITH x AS (SELECT p_partkey, 4 + p_size % 4 AS high FROM part) SELECT 'T' || p_partkey || '_F00' AS field_id, high::INTEGER AS high, 4 AS low, 'read-only' AS access, 'Part ' || p_partkey || ' more' AS description FROM x")
def field_rows(s, d):
    p = t(s, d, "part").select(F.concat(F.lit("T"), "p_partkey").alias("name"), "p_partkey", (4 + F.col("p_size") % 4).cast("string").alias("high"))
    cells = F.array(F.array(*map(F.lit, ("Bits", "Attribute", "Field name", "Description"))), F.array(F.concat("high", F.lit(":4")), F.lit("RO"), F.lit("Mode"), F.concat(F.lit("Part "), "p_partkey")),
                    F.array(F.lit(""), F.lit(""), F.lit(""), F.lit("more")), F.array(F.lit("3:0"), F.lit("RO"), F.lit("Reserved"), F.lit("")))
    rows = p.select("name", F.posexplode(cells).alias("row_no", "cells"))
    return E.field_rows(rows, E.column_map(["Bits", "Attribute", "Field name", "Description"])).select("field_id", "high", "low", "access", "description")


@query("SELECT p_partkey AS node_id, 'field_name_length' AS \"check\", 'error' AS severity FROM part WHERE length(p_name) > 18 UNION ALL SELECT p_partkey, 'missing_bits', 'warning' FROM part WHERE p_size % 5 = 0")
def field_issues(s, d):
    p = t(s, d, "part").select(F.col("p_partkey").alias("field_id"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 5 != 0, "7:0").alias("bits"), F.lit("RW").alias("access"))
    return E.validate_fields(p, 18)


@query("SELECT 'REL_' || lpad(CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS VARCHAR), greatest(4, length(CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS VARCHAR)))::INT, '0') AS id, o_orderkey FROM orders")
def numbered_edges(s, d):
    return E.number_edges(t(s, d, "orders").select("o_orderdate", "o_orderkey"), "REL_", ["o_orderdate", "o_orderkey"]).select("id", "o_orderkey")
