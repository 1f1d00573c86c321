"""More registered queries, over a graph that stands in for a document's: parts are registers, line items their fields, customers
tables, nations features, suppliers register classes, documents text chunks. Each has its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import assemble as A
from ..operators import discover as D
from ..operators import enrich as N
from ..operators import extract as E
from ..operators import graph as G
from ..operators import lookups as L
from ..operators import overlap
from ..operators import ranges as R
from ..operators import text_index as X
from ..operators import upkeep as U
from ..operators.shared import shared_dir, written
from ..sources import export, large
from ..sources.config import Config
from . import build as B
from . import queries as Q
from .catalog import GraphCatalog
from .queries import CHK, query, t

REG = (
    "WITH fl AS (SELECT l_partkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) - 1 AS pos, l_returnflag || l_linestatus || '_' || l_suppkey AS name, (4 * l_linenumber + 3) || ':' || (4 * l_linenumber) AS bits, "
    "4 * l_linenumber + 3 AS bit_high, 4 * l_linenumber AS bit_low, 4 AS width, CASE l_returnflag WHEN 'A' THEN 'read-only' WHEN 'R' THEN 'write-only' ELSE 'read-write' END AS access, 'quantity ' || CAST(l_quantity AS INTEGER) AS raw FROM lineitem), "
    "reg AS (SELECT 'REG_' || printf('%X', p_partkey) AS id, p_partkey, p_name AS name, printf('%x', p_partkey) || 'h' AS offset_hex, 'REGCLASS_' || p_brand AS class_id, p_partkey AS ord, (1 + p_partkey % 7) || '.' || (1 + p_partkey % 5) AS section, p_size FROM part), "
    "fld AS (SELECT reg.id AS register_id, reg.id || '_F' || pos AS id, reg.ord, fl.* EXCLUDE (l_partkey) FROM fl JOIN reg ON l_partkey = p_partkey) "
)


def register_rows(s, d) -> DataFrame:
    field = F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").cast("string").alias("quantity"))  # what a field is made of is shuffled, not the field
    of = t(s, d, "lineitem").groupBy("l_partkey").agg(F.array_sort(F.collect_list(field)).alias("f"))
    p = t(s, d, "part").join(of, F.col("p_partkey") == F.col("l_partkey"), "left")
    base = p.select(F.concat(F.lit("REG_"), F.hex("p_partkey")).alias("id"), F.col("p_partkey").alias("ord"), F.col("p_name").alias("name"), F.concat(F.lower(F.hex("p_partkey")), F.lit("h")).alias("offset"), F.concat(F.lit("REGCLASS_"), "p_brand").alias("class_id"),
                    F.concat_ws(".", 1 + F.col("p_partkey") % 7, 1 + F.col("p_partkey") % 5).alias("spec_section"), F.concat(F.lit("TABLE_"), "p_size").alias("spec_table"), F.col("p_size").alias("page"), F.lit(0).alias("definition_page"), "f")

    def made(x, i):
        n, flag = x["l_linenumber"], x["l_returnflag"]
        access = C.access(F.when(flag == "A", "RO").when(flag == "R", "WO").otherwise("RW"))
        return F.struct(
            F.concat("id", F.lit("_F"), i).alias("id"), F.concat(flag, x["l_linestatus"], F.lit("_"), x["l_suppkey"]).alias("name"), F.concat(4 * n + 3, F.lit(":"), 4 * n).alias("bits"), (4 * n + 3).alias("bit_high"), (4 * n).alias("bit_low"),
            F.lit(4).alias("width"), access.alias("access"), F.concat(F.lit("quantity "), x["quantity"]).alias("raw"),
        )

    return base.withColumn("fields", F.transform(F.coalesce("f", F.array().cast(base.schema["f"].dataType)), made)).drop("f")


def register_graph(s, d) -> DataFrame:
    return A.register_nodes(register_rows(s, d))


_stored: dict[tuple[str, str, str], str] = {}


def stored(s, d, name: str, write) -> str:
    """The path of what write(path) has written of these tables; written once in a session, by the first query that needs it."""
    key = (s.sparkContext.applicationId, d, name)
    if key not in _stored:
        path = f"{shared_dir(s)}/graph/{name}-{uuid.uuid4().hex}"
        write(path)
        _stored[key] = path
    return _stored[key]


def typed(s, d) -> str:
    return stored(s, d, "registers", lambda path: L.write_registers(register_graph(s, d), path))


def regs(s, d) -> DataFrame:
    return L.read_registers(s, typed(s, d))


def flds(s, d) -> DataFrame:
    return L.read_fields(s, typed(s, d))


def feature_graph(s, d) -> DataFrame:
    n = t(s, d, "nation").join(t(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = n.select(F.col("n_name").alias("id"), F.col("n_nationkey").alias("ord"), F.col("n_name").alias("name"), F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("priority"), F.when(F.col("n_nationkey") >= 5, F.concat(F.lit("NATION_"), "n_regionkey")).alias("parent_id"),
                    F.array("r_name", F.lit("ALL")).alias("groups"), *[F.array().cast("array<string>").alias(c) for c in ("figures", "tables", "spec_sections")], F.array(F.concat(F.lit("REG_"), F.hex("n_nationkey")), F.lit("REG_NONE"), F.lit("REG_1")).alias("registers"))
    return A.feature_nodes(rows)


FEAT = "WITH ft AS (SELECT n_name AS id, n_nationkey AS ord, CASE WHEN n_nationkey >= 5 THEN 'NATION_' || n_regionkey END AS parent, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) "


def table_rows(s, d) -> DataFrame:
    c = t(s, d, "customer")
    ref = F.concat(F.lit("Table "), "c_nationkey", F.lit("-"), "c_custkey")
    title = F.concat("c_mktsegment", F.when(F.col("c_custkey") % 3 == 0, " register field layout").when(F.col("c_custkey") % 3 == 1, " signal names").otherwise(" of things"))
    return c.select(F.concat_ws("_", F.lit("TABLE"), "c_nationkey", "c_custkey").alias("id"), F.col("c_custkey").alias("ord"), title.alias("title"), F.lit("").alias("abstract"), ref.alias("spec_reference"), (1 + F.col("c_custkey") % 50).cast("int").alias("spec_page"),
                    F.lit(0).alias("definition_page"), F.when(F.col("c_acctbal") > 0, "COMPLETED").otherwise("PENDING").alias("status"), F.concat(F.lit("csv\\"), "c_name", F.lit(".csv")).alias("csv_file"))


TAB = "WITH tab AS (SELECT 'TABLE_' || c_nationkey || '_' || c_custkey AS id, c_custkey AS ord, c_nationkey, 'Table ' || c_nationkey || '-' || c_custkey AS ref, CASE c_custkey % 3 WHEN 0 THEN 'REGISTER_FIELDS' WHEN 1 THEN 'SIGNAL_LIST' ELSE 'OTHER' END AS kind, CASE WHEN c_acctbal > 0 THEN 0.95 ELSE 0.7 END::DOUBLE AS confidence FROM customer) "


def chunk_graph(s, d) -> DataFrame:
    x = t(s, d, "documents")
    section = F.concat_ws(".", 1 + F.col("doc_id") % 7, 1 + F.col("doc_id") % 5)
    rows = x.select(F.concat(F.lit("CHUNK_"), "doc_id").alias("id"), F.col("doc_id").alias("ord"), section.alias("section_number"), F.concat(F.lit("About "), "source").alias("title"), F.col("doc_id").alias("chunk_index"), F.lit(1).alias("word_count"),
                    F.floor(F.col("doc_id") / 10).cast("int").alias("page"), F.col("text").alias("full_text"), F.lit("").alias("abstract"), F.array().cast("array<string>").alias("keywords"))
    return A.chunk_nodes(rows, 11)


# registers and fields


@query(REG + "SELECT id, name, offset_hex FROM reg WHERE p_partkey = 42")
def catalog_register_by_offset(s, d):
    return GraphCatalog(register_graph(s, d), None, typed=typed(s, d)).get_register_by_offset("0x2A").select("id", "name", "offset_hex")


@query(REG + "SELECT reg.id, reg.name, class_id, (SELECT count(*) FROM fld WHERE register_id = reg.id)::INTEGER AS field_count FROM reg WHERE contains(lower(reg.name), 'ring')")
def catalog_registers_by_name(s, d):
    return L.register_summary(L.registers_by_name(regs(s, d), "RING")).select("id", "name", "class_id", "field_count")


@query(REG + "SELECT reg.id, (SELECT count(*) FROM fld WHERE register_id = reg.id)::INTEGER AS field_count, CAST(row_number() OVER (ORDER BY lpad(upper(printf('%X', p_partkey)), greatest(3, length(printf('%X', p_partkey)))::INT, '0')) AS INTEGER) AS place FROM reg WHERE class_id = 'REGCLASS_Brand#2'")
def catalog_register_list(s, d):
    listed = L.register_list(regs(s, d), "REGCLASS_Brand#2")
    from pyspark.sql import Window

    return L.register_summary(listed).withColumn("place", F.row_number().over(Window.partitionBy("class_id").orderBy(C.norm_offset(F.col("offset"))))).select("id", "field_count", "place")


@query(REG + "SELECT id, name, bits, pos::INTEGER AS pos FROM fld WHERE register_id = 'REG_2A'")
def catalog_fields_of_register(s, d):
    return L.fields_of(flds(s, d), "REG_2A").select("id", "name", "bits", "pos")


@query(REG + "SELECT id, name, register_id FROM fld WHERE id = 'REG_2A_F3'")
def catalog_field_by_id(s, d):
    return L.field_by_id(flds(s, d), "REG_2A_F3").select("id", "name", "register_id")


@query(REG + "SELECT id, name FROM fld WHERE register_id = 'REG_2A' AND contains(lower(name), 'f_1') ORDER BY pos LIMIT 1")
def catalog_field_by_name(s, d):
    return GraphCatalog(register_graph(s, d), None, typed=typed(s, d)).get_field_by_name("REG_2A", "F_1").select("id", "name")


@query(REG + "SELECT register_id, min_by(id, pos) AS id FROM fld WHERE 13 BETWEEN bit_low AND bit_high GROUP BY register_id")
def catalog_field_by_bit(s, d):
    return L.fields_holding(flds(s, d), 13).select("register_id", "id")


@query(REG + "SELECT register_id, id FROM fld WHERE access = 'read-only'")
def catalog_fields_by_access(s, d):
    return L.fields_with_access(flds(s, d), "read-only").select("register_id", "id")


@query(REG + "SELECT register_id, id, name FROM fld WHERE contains(lower(name), 'af_1')")
def catalog_fields_by_name(s, d):
    return L.fields_named(flds(s, d), "AF_1").select("register_id", "id", "name")


@query(REG + "SELECT id, raw || ' ' AS excerpt FROM fld WHERE contains(raw, 'quantity 1')")
def catalog_fields_by_text(s, d):
    return L.fields_with_text(flds(s, d), "Quantity 1").select("id", "excerpt")


@query(REG + "SELECT reg.id, coalesce(sum(width), 0)::INTEGER AS size_bits, count(fld.id)::INTEGER AS field_count FROM reg LEFT JOIN fld ON register_id = reg.id GROUP BY reg.id")
def register_sizes(s, d):
    return L.register_sizes(regs(s, d))


@query(REG + "SELECT coalesce(reg.id, 'ALL') AS register, count(fld.id) AS fields FROM reg LEFT JOIN fld ON register_id = reg.id GROUP BY ROLLUP (reg.id)")
def register_dump_totals(s, d):
    return L.dump_totals(regs(s, d))


@query(REG + "SELECT class_id AS id, count(*)::INTEGER AS member_count, string_agg(id, ',' ORDER BY ord) AS members FROM reg GROUP BY class_id")
def catalog_register_classes(s, d):
    r = regs(s, d)
    classes = r.select(F.col("class_id").alias("id")).distinct().select("id", F.lit("REG_CLASS").alias("type"), F.col("id").alias("name"), F.lit(0).cast("long").alias("ord"))
    both = register_graph(s, d).unionByName(classes, allowMissingColumns=True)
    return GraphCatalog(both, None, typed=typed(s, d)).list_register_classes().select("id", "member_count", F.array_join("member_register_ids", ",").alias("members"))


# sections, tables, features


@query(CHK + "SELECT section_number, min_by('About ' || source, ord) AS title, string_agg(id, ',' ORDER BY ord) AS chunk_ids, min(page)::INTEGER AS page_start, max(page)::INTEGER AS page_end, sha256(coalesce(string_agg(full_text, chr(10) || chr(10) ORDER BY ord) FILTER (WHERE full_text <> ''), '')) AS text_sha256 FROM chk GROUP BY section_number")
def catalog_sections(s, d):
    found = L.section(L.chunks(chunk_graph(s, d)))
    return found.select("section_number", "title", F.array_join("chunk_ids", ",").alias("chunk_ids"), "page_start", "page_end", F.sha2("text", 256).alias("text_sha256"))


@query(CHK + "SELECT section_number, min_by('About ' || source, ord) AS title, count(*) AS chunk_count, coalesce(min(CASE WHEN page <> 0 THEN page END), 0)::INTEGER AS page FROM chk WHERE section_number = '3' OR starts_with(section_number, '3.') GROUP BY section_number")
def catalog_section_list(s, d):
    return L.section_list(L.chunks(chunk_graph(s, d)), "3").select("section_number", "title", "chunk_count", "page")


@query(CHK + "SELECT id, page::INTEGER AS page FROM chk WHERE contains(lower(full_text), 'the') ORDER BY ord LIMIT 7")
def catalog_chunks_with_text(s, d):
    return L.chunks_with_text(L.chunks(chunk_graph(s, d)), "The", 7).select("id", "page")


@query(TAB + "SELECT id, confidence FROM tab WHERE lower(ref) = 'table 2-0' ORDER BY ord LIMIT 1")
def catalog_table_by_reference(s, d):
    return GraphCatalog(A.table_nodes(table_rows(s, d)), None).get_table_by_reference("TABLE 2-0").select("id", "confidence")


@query(TAB + "SELECT id, kind, confidence FROM tab WHERE kind = 'SIGNAL_LIST'")
def catalog_tables_of_type(s, d):
    return GraphCatalog(A.table_nodes(table_rows(s, d)), None).list_tables("SIGNAL_LIST").select("id", L.extra("table_type").alias("kind"), "confidence")


@query(TAB + "SELECT c_nationkey AS chapter, string_agg(id, ',' ORDER BY ord) AS ids FROM tab GROUP BY c_nationkey")
def catalog_tables_by_chapter(s, d):
    return L.by_chapter(A.table_nodes(table_rows(s, d)), F.regexp_replace("id", "^TABLE_", "")).select("chapter", F.array_join("ids", ",").alias("ids"))


@query(TAB + ", x AS (SELECT c_custkey, c_name || ' holds ' || c_acctbal AS content FROM customer) SELECT tab.id, x.content FROM tab JOIN x ON c_custkey = ord WHERE ord = 7")
def catalog_table_content(s, d):
    texts = t(s, d, "customer").select(F.col("c_name").alias("name"), F.concat("c_name", F.lit(" holds "), "c_acctbal").alias("content"))
    nodes = A.table_nodes(table_rows(s, d))
    return L.content_of(nodes, nodes.where("ord = 7").first()["id"], L.extra("csv_file"), texts).select("id", "content")


@query(FEAT + "SELECT grp, string_agg(id, ',' ORDER BY ord) AS features FROM (SELECT r_name AS grp, id, ord FROM ft UNION ALL SELECT 'ALL', id, ord FROM ft) GROUP BY grp")
def catalog_feature_groups(s, d):
    return L.feature_groups(L.features(feature_graph(s, d))).select("grp", F.array_join("features.id", ",").alias("features"))


@query("SELECT 'REG_' || printf('%X', p_partkey) AS id, p_name AS name FROM part WHERE p_partkey IN (7, 1)")
def catalog_feature_registers(s, d):
    return L.feature_registers(L.features(feature_graph(s, d)), register_graph(s, d), "NATION_7").select("id", "name")


@query(FEAT + "SELECT a.id, string_agg(b.id, ',' ORDER BY b.ord) AS children FROM ft a LEFT JOIN ft b ON b.parent = a.id WHERE a.parent IS NULL GROUP BY a.id")
def catalog_feature_tree(s, d):
    return GraphCatalog(feature_graph(s, d), None).get_feature_tree().select("id", F.nullif(F.array_join("children", ","), F.lit("")).alias("children"))


@query(FEAT + "SELECT id, 'NOT_IMPLEMENTED' AS driver_status FROM ft")
def catalog_features_by_driver(s, d):
    return L.features_by_driver(L.features(feature_graph(s, d)), "not_implemented").select("id", "driver_status")


@query("WITH w AS (SELECT DISTINCT p_name, unnest(string_split(lower(p_name), ' ')) AS w FROM part) SELECT a.p_name AS left_id, b.p_name AS right_id, string_agg(a.w, ',' ORDER BY a.w) AS shared FROM w a JOIN w b USING (w) GROUP BY ALL HAVING count(*) >= 2")
def lookalike_names(s, d):
    names = t(s, d, "part").select(F.col("p_name").alias("id"), F.col("p_name").alias("name")).distinct()
    return overlap.lookalikes(names, names).select("left_id", "right_id", F.array_join("shared", ",").alias("shared"))


# assembly


def edges(s, d) -> DataFrame:
    o = t(s, d, "orders")
    return o.select(F.concat(F.lit("R"), "o_orderkey").alias("id"), F.col("o_orderpriority").alias("type"), F.concat(F.lit("N"), "o_orderkey").alias("source_node"), F.concat(F.lit("N"), "o_custkey").alias("target_node"), F.col("o_orderkey").alias("ord"))


@query("SELECT 'nodes' AS what, coalesce(c_mktsegment, 'ALL') AS type, count(*) AS count FROM customer GROUP BY ROLLUP (c_mktsegment) UNION ALL SELECT 'relations', coalesce(o_orderpriority, 'ALL'), count(*) FROM orders GROUP BY ROLLUP (o_orderpriority)")
def statistics_of_graph(s, d):
    nodes = t(s, d, "customer").select(F.col("c_mktsegment").alias("type"))
    return A.statistics(nodes, edges(s, d))


@query("SELECT o_orderpriority AS type, 'N' || o_custkey AS target_node FROM orders WHERE o_orderkey = 42")
def catalog_relations_from(s, d):
    return GraphCatalog(None, edges(s, d)).get_relations_from("N42").select("type", "target_node")


@query("SELECT 'REG_' || printf('%X', l_partkey) AS id FROM lineitem WHERE l_suppkey = 3 AND l_linestatus = 'F' AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 25)")
def catalog_neighbours(s, d):
    li = t(s, d, "lineitem").where("l_linestatus = 'F'")
    rel = li.select(F.concat(F.lit("REG_"), F.hex("l_partkey")).alias("source_node"), F.concat(F.lit("S"), "l_suppkey").alias("target_node"), F.col("l_orderkey").alias("ord"))
    nodes = t(s, d, "part").select(F.concat(F.lit("REG_"), F.hex("p_partkey")).alias("id"), F.when(F.col("p_size") < 25, "REGISTER").otherwise("OTHER").alias("type"))
    return G.neighbours(rel, nodes, "S3", True, "REGISTER")


@query("""WITH f AS (SELECT p_size AS off, p_partkey AS ord, (p_partkey % 4) * 4 + 4 * k AS low, k FROM part, range(2) r(k)), b AS (SELECT off, min(ord) AS base FROM f GROUP BY off),
    own AS (SELECT f.off, f.ord, f.k, low FROM f JOIN b ON f.off = b.off AND ord = base), more AS (SELECT f.off, f.ord, f.k, f.low FROM f JOIN b USING (off) WHERE ord <> base AND low NOT IN (SELECT low FROM own WHERE own.off = f.off)
    QUALIFY row_number() OVER (PARTITION BY f.off, f.low ORDER BY f.ord, f.k) = 1), a AS (SELECT * FROM own UNION ALL SELECT * FROM more)
    SELECT 'R' || base AS id, string_agg((low + 3) || ':' || low, ',' ORDER BY low DESC) AS bits, (SELECT CASE WHEN count(*) > 1 THEN count(DISTINCT p_brand) END FROM part WHERE p_size = off) AS tables FROM a JOIN b USING (off) GROUP BY off, base""")
def merged_registers(s, d):
    p = t(s, d, "part")
    low = (F.col("p_partkey") % 4 * 4).cast("int")
    fields = F.array(*[F.struct(F.concat(low + 4 * k + 3, F.lit(":"), low + 4 * k).alias("bits"), (low + 4 * k + 3).alias("bit_high")) for k in range(2)])
    rows = p.select(F.concat(F.lit("R"), "p_partkey").alias("id"), F.col("p_name").alias("name"), F.lpad(F.col("p_size").cast("string"), 3, "0").alias("offset_norm"), F.col("p_size").cast("long").alias("offset_int"), F.col("p_brand").alias("spec_table"), F.col("p_partkey").alias("ord"), fields.alias("fields"))
    return A.merge_registers(rows).select("id", F.array_join("fields.bits", ",").alias("bits"), F.size("merged_from").cast("long").alias("tables")).withColumn("tables", F.when(F.col("tables") > 0, F.col("tables")))


@query("SELECT CASE WHEN kind = 1 THEN 'REL_BELONGS_' ELSE 'REL_DEFINED_' END || lpad(n::VARCHAR, greatest(3, length(n::VARCHAR))::INT, '0') AS id, source_node, target_node FROM (SELECT *, row_number() OVER (ORDER BY p_partkey, kind) AS n FROM (SELECT p_partkey, 1 AS kind, 'REG_' || printf('%X', p_partkey) AS source_node, 'REGCLASS_' || p_brand AS target_node FROM part UNION ALL SELECT p_partkey, 2, 'REG_' || printf('%X', p_partkey), 'TABLE_' || p_size FROM part WHERE p_size > 10))")
def register_relations(s, d):
    rows = register_rows(s, d).withColumn("spec_table", F.when(F.col("page") > 10, F.col("spec_table")).otherwise(""))
    return A.register_edges(rows).select("id", "source_node", "target_node")


@query(CHK + ", rg AS (SELECT 'REG_' || printf('%X', p_partkey) AS id, (1 + p_partkey % 7) || '.' || (1 + p_partkey % 5) AS section FROM part WHERE p_size = 7) SELECT 'DESCRIBES' AS type, chk.id AS source_node, rg.id AS target_node FROM chk JOIN rg ON section = section_number")
def described_registers(s, d):
    r = register_rows(s, d).where("page = 7")
    return A.describes(L.chunks(chunk_graph(s, d)), r)


@query("SELECT 'REL_PART_OF_' || lpad(row_number() OVER (ORDER BY n_nationkey)::VARCHAR, 3, '0') AS id, n_name AS source_node, 'NATION_' || n_regionkey AS target_node FROM nation WHERE n_nationkey >= 5")
def feature_parents(s, d):
    return A.part_of(L.features(feature_graph(s, d)).select("id", "ord", "parent_id")).select("id", "source_node", "target_node")


@query(CHK + ", f AS (SELECT id, ord, section_number FROM chk UNION ALL SELECT 'TOP_' || (1 + doc_id % 7), min(doc_id), CAST(1 + doc_id % 7 AS VARCHAR) FROM documents GROUP BY 1 + doc_id % 7) SELECT c.id AS source_node, 'TOP_' || split_part(c.section_number, '.', 1) AS target_node FROM f c WHERE contains(c.section_number, '.')")
def child_edges_of_all(s, d):
    c = L.chunks(chunk_graph(s, d)).select("id", "section_number", "chunk_index", "ord")
    top = t(s, d, "documents").groupBy((1 + F.col("doc_id") % 7).cast("string").alias("section_number")).agg(F.min("doc_id").alias("ord")).select(F.concat(F.lit("TOP_"), "section_number").alias("id"), "section_number", F.lit(0).alias("chunk_index"), "ord")
    return A.child_edges_of_all(c.unionByName(top)).select("source_node", "target_node")


@query("""WITH n AS (SELECT 'N' || c_custkey AS id, c_name AS name, c_custkey FROM customer UNION ALL SELECT 'N' || c_custkey, '', c_custkey + 1000000000 FROM customer WHERE c_custkey % 100 = 0),
    r AS (SELECT 'N' || o_custkey AS a, 'N' || (o_custkey + 1) AS b FROM orders WHERE o_orderstatus = 'P')
    SELECT id AS node_id, 'duplicate_id' AS "check", 'error' AS severity FROM n WHERE c_custkey >= 1000000000 UNION ALL SELECT id, 'missing_name', 'error' FROM n WHERE name = ''
    UNION ALL SELECT a, 'dangling_source', 'error' FROM r WHERE a NOT IN (SELECT id FROM n) UNION ALL SELECT b, 'dangling_target', 'error' FROM r WHERE b NOT IN (SELECT id FROM n)
    UNION ALL SELECT id, 'no_keywords', 'warning' FROM n WHERE c_custkey % 7 = 0 UNION ALL SELECT id, 'orphan', 'warning' FROM n WHERE id NOT IN (SELECT a FROM r UNION SELECT b FROM r)""")
def graph_issues(s, d):
    c = t(s, d, "customer").select(F.col("c_custkey").alias("ord"), F.concat(F.lit("N"), "c_custkey").alias("id"), F.col("c_name").alias("name"))
    c = c.unionByName(c.where("ord % 100 = 0").select((F.col("ord") + 1_000_000_000).alias("ord"), "id", F.lit("").alias("name")))
    nodes = c.withColumns({"type": F.lit("T"), "index_keywords": F.when(F.col("ord") % 7 != 0, F.array(F.lit("k")))})
    r = t(s, d, "orders").where("o_orderstatus = 'P'").select(F.concat(F.lit("N"), "o_custkey").alias("source_node"), F.concat(F.lit("N"), F.col("o_custkey") + 1).alias("target_node"))
    return A.check_graph(nodes, r).select("node_id", "check", "severity")


@query("WITH p AS (SELECT p_partkey, p_size FROM part) SELECT count(*) AS total, count(*) FILTER (WHERE sev = 'error') AS errors, count(*) FILTER (WHERE sev = 'warning') AS warnings FROM (SELECT 'error' AS sev FROM lineitem WHERE l_linenumber = 1 AND l_partkey % 5 <> 0 UNION ALL SELECT 'warning' FROM p WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_partkey % 5 <> 0))")
def register_issue_counts(s, d):
    f = t(s, d, "lineitem").where("l_partkey % 5 <> 0").select(F.concat("l_orderkey", F.lit("_"), "l_linenumber").alias("field_id"), F.col("l_partkey").alias("register_id"), F.lit("n").alias("name"), F.when(F.col("l_linenumber") != 1, "7:0").alias("bits"), F.lit("RW").alias("access"))
    r = t(s, d, "part").select(F.col("p_partkey").alias("id"))
    found = A.check_registers(f, r, {"missing_bits": "error", "zero_fields": "warning"})
    return A.severity_split(found)


# discovery


@query("SELECT 'TABLE_' || p_partkey || '_' || p_size AS id, p_partkey || '-' || p_size AS number, 'About ' || p_name AS title, p_size AS page FROM part")
def contents_by_pattern(s, d):
    line = F.concat(F.lit("\nTable "), "p_partkey", F.lit("-"), "p_size", F.lit(": About "), "p_name", F.lit(" ........ "), "p_size", F.lit("\n"))
    return D.contents_by(t(s, d, "part").select(F.col("p_partkey").alias("page"), line.alias("text")), r"Table\s+(\d+)-(\d+)\s*:\s*(.+?)\s*\.{3,}\s*(\d+)", "TABLE_%s", 4)


@query("SELECT p_partkey AS page, p_partkey || '.1' AS number, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE 'Next line' END AS title FROM part")
def headings_without_contents(s, d):
    head = F.concat("p_partkey", F.lit(".1 "), F.when(F.col("p_partkey") % 2 == 0, F.concat("p_name", F.lit(" (Continued)"))).otherwise(""))
    return D.headings_by_line(t(s, d, "part").select(F.col("p_partkey").alias("page"), F.concat(F.lit("text\n"), head, F.lit("\n\n  Next line\nmore")).alias("text")))


@query("SELECT n_regionkey AS book, '1.' || n_nationkey AS number, 'SEC_1_' || n_nationkey AS id, '1' AS parent, 10 * n_nationkey AS page, coalesce(lead(10 * n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey), 10 * n_nationkey) AS \"end\" FROM nation")
def section_page_ranges(s, d):
    n = t(s, d, "nation").select(F.col("n_regionkey").alias("book"), F.concat(F.lit("1."), "n_nationkey").alias("number"), F.col("n_name").alias("title"), (10 * F.col("n_nationkey")).alias("page"))
    return D.section_ranges(n).select("book", "number", "id", "parent", "page", "end")


@query("SELECT id, section_number, page, word_count FROM (SELECT 'CHUNK_S' || least(p // 20, 4) || '_' || (row_number() OVER (PARTITION BY least(p // 20, 4) ORDER BY p) - 1) AS id, 'S' || least(p // 20, 4) AS section_number, p AS page, 2 AS word_count FROM (SELECT c_custkey::INTEGER AS p FROM customer))")
def chunks_of_sections(s, d):
    pages = t(s, d, "customer").select(F.col("c_custkey").cast("int").alias("page"), F.lit("two words").alias("text"))
    sections = s.createDataFrame([(20 * i, f"S{i}", f"T{i}", i) for i in range(5)], "start int, section string, title string, ord int")
    return D.chunks_of(pages, sections, 100).select("id", "section_number", "page", "word_count")


@query("WITH tt AS (SELECT n_nationkey AS ord, 'T' || n_nationkey AS table_id, n_name || ' field descriptions' AS title FROM nation) SELECT s_suppkey AS id, min_by(table_id, ord) AS table_id FROM supplier LEFT JOIN tt ON contains(replace(lower(title), '_', ''), 'nation' || (s_nationkey % 30)) GROUP BY s_suppkey")
def tables_of_registers(s, d):
    r = t(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.concat(F.lit("Nation-"), F.col("s_nationkey") % 30, F.lit(" Register")).alias("name"))
    tables = t(s, d, "nation").select(F.concat(F.lit("T"), "n_nationkey").alias("table_id"), F.concat("n_name", F.lit(" field descriptions")).alias("title"), F.col("n_nationkey").alias("ord"))
    return D.table_of_register(r, tables)


@query("SELECT c_custkey AS table_id, CASE WHEN c_custkey % 3 = 0 THEN 'direct' WHEN c_custkey % 3 = 1 THEN 'titled' ELSE printf('%X', c_custkey) END AS \"offset\" FROM customer")
def offsets_of_tables(s, d):
    c = t(s, d, "customer")
    title = F.when(F.col("c_custkey") % 3 == 1, F.concat("c_name", F.lit(" (Offset zz)"))).otherwise(F.concat("c_name", F.lit(" Register (Offset "), F.hex("c_custkey"), F.lit("h)")))
    known = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("table_id"), F.lit("direct").alias("offset"))
    titled = c.where("c_custkey % 3 = 1").select(F.upper("c_name").alias("title"), F.lit("titled").alias("offset"))
    return D.offset_of_table(c.select(F.col("c_custkey").alias("table_id"), title.alias("title")), known, titled)


@query("SELECT 'RM_RAW_' || lpad(row_number() OVER (PARTITION BY book ORDER BY start)::VARCHAR, 3, '0') AS id, book, start, least(start + 3, stop) AS \"end\", (SELECT string_agg('p' || i, chr(10) ORDER BY i) FROM range(start, least(start + 3, stop) + 1) r(i)) AS text FROM (SELECT book, unnest(range(start, stop + 1, 4)) AS start, stop FROM (SELECT n_regionkey AS book, 2 * n_nationkey AS start, coalesce(lead(2 * n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1, 60) AS stop FROM nation))")
def raw_chapters(s, d):
    n = t(s, d, "nation")
    marks = n.select(F.col("n_regionkey").alias("book"), F.lit(1).alias("level"), F.col("n_name").alias("title"), (2 * F.col("n_nationkey")).alias("page"))
    pages = n.select(F.col("n_regionkey").alias("book")).distinct().select("book", F.explode(F.sequence(F.lit(0), F.lit(60))).alias("page")).withColumn("text", F.concat(F.lit("p"), "page"))
    return D.raw_content(marks, pages, 60, part_pages=4).select("id", "book", "start", "end", "text")


@query("SELECT DISTINCT s_nationkey AS drawing, 'b' || (s_suppkey % 10) AS source, 'b' || ((s_suppkey + 3) % 10) AS target FROM supplier")
def drawn_edges(s, d):
    x = t(s, d, "supplier")
    boxes = x.select(F.col("s_nationkey").alias("drawing")).distinct().select("drawing", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i"), F.lit(0).alias("y0"), F.lit(5).alias("y1"))
    boxes = boxes.select("drawing", F.concat(F.lit("b"), "i").alias("id"), (F.col("i") * 10).alias("x0"), "y0", (F.col("i") * 10 + 8).alias("x1"), "y1", F.col("i").alias("ord"))
    lines = x.select(F.col("s_nationkey").alias("drawing"), F.col("s_suppkey").alias("line"), (F.col("s_suppkey") % 10 * 10 + 1).alias("x0"), F.lit(1).alias("y0"), ((F.col("s_suppkey") + 3) % 10 * 10 + 2).alias("x1"), F.lit(2).alias("y1"))
    return D.edges_between(boxes, lines).select("drawing", "source", "target").distinct()


@query("SELECT 0 AS drawing, 'flowchart TD' || chr(10) || string_agg('    n' || n_nationkey || '[\"' || n_name || '\"]', chr(10) ORDER BY n_nationkey) || chr(10) || '    n0 --> n1' AS text FROM nation")
def mermaid_of_boxes(s, d):
    n = t(s, d, "nation")
    boxes = n.select(F.lit(0).alias("drawing"), F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_name").alias("label"), F.lit(1).alias("x0"), F.col("n_nationkey").alias("y0"))
    links = s.createDataFrame([(0, "n0", "n1"), (0, "n0", "n1")], "drawing int, source string, target string")
    return D.mermaid(boxes, links)


@query("SELECT c_custkey AS page, c_custkey % 3 = 0 AS \"continues\" FROM customer")
def continued_pages(s, d):
    lines = "one two three\nfour five six\nseven eight nine\nten\neleven\n"
    text = F.when(F.col("c_custkey") % 3 == 1, F.lit("Table 9-9: Other\n" + lines)).when(F.col("c_custkey") % 3 == 2, F.lit(lines + "Figure 1-2: x")).otherwise(F.lit("Table 2-1: Same\n" + lines))
    return t(s, d, "customer").select(F.col("c_custkey").alias("page"), C.continues_table(text, F.lit("Table 2-1")).alias("continues"))


@query("SELECT p_size AS page, string_agg(DISTINCT 'REG_' || printf('%X', p_partkey), ',' ORDER BY 'REG_' || printf('%X', p_partkey)) AS ids FROM part GROUP BY p_size")
def items_by_page(s, d):
    items = t(s, d, "part").select(F.concat(F.lit("REG_"), F.hex("p_partkey")).alias("id"), F.col("p_size").alias("page"))
    return D.pages_with_items(items).select("page", F.array_join("ids", ",").alias("ids"))


# shapes of field tables


def shape(s, d, headings: list[str], row: list, more: list, **options) -> DataFrame:
    p = t(s, d, "part").select(F.concat(F.lit("T"), "p_partkey").alias("name"), "p_partkey", "p_size", "p_name")
    cells = F.array(F.array(*map(F.lit, headings)), F.array(*row), F.array(*more))
    return E.field_rows(p.select("name", F.posexplode(cells).alias("row_no", "cells")), E.column_map(headings), **options)


@query("SELECT 'T' || p_partkey || '_F00' AS field_id, 'Mode' AS name, 'read-only' AS access, p_name || chr(10) || 'more' AS description FROM part")
def fields_with_merged_description(s, d):
    found = shape(s, d, ["Location", "Attrib", "Register Field Explanation"], [F.lit("7:4"), F.lit("RO"), F.concat(F.lit("Mode\n"), "p_name")], [F.lit(""), F.lit(""), F.lit("more")])
    return found.select("field_id", "name", "access", "description")


@query("SELECT 'T' || p_partkey || '_F00' AS field_id, p_size AS high, 'MODE' AS name, p_name || ' more' AS description FROM part")
def fields_with_merged_bits(s, d):
    found = shape(s, d, ["Name", "Function"], [F.concat("p_size", F.lit(":0 MODE")), F.col("p_name")], [F.lit(""), F.lit("more")], merged_bits=True)
    return found.select("field_id", "high", "name", "description")


@query("SELECT 'T' || p_partkey || '_F0' || i AS field_id, CASE i WHEN 0 THEN p_name ELSE 'Second' END AS name, CASE i WHEN 0 THEN 'first' ELSE 'other' END AS description FROM part, range(2) r(i)")
def fields_without_bits(s, d):
    return shape(s, d, ["Signal Name", "Explanation"], [F.col("p_name"), F.lit("first")], [F.lit("Second"), F.lit("other")]).select("field_id", "name", "description")


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'reserved' WHEN p_partkey % 4 = 1 THEN 'read-only' ELSE 'read-write' END AS access, CASE WHEN p_size % 2 = 0 THEN p_size + 3 END AS high, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE 'Field_7_4' END AS name FROM part")
def field_fallbacks(s, d):
    k = F.col("p_partkey")
    attribute = F.when(k % 4 == 0, "Rsvd").when(k % 4 == 1, "HwInit").otherwise("RW1C")
    bits = F.when(F.col("p_size") % 2 == 0, F.concat(F.col("p_size") + 3, F.lit("-"), "p_size")).otherwise("x")
    text = F.when(k % 3 == 0, F.concat("p_name", F.lit("\nmore"))).otherwise("It is a sentence. And more.")
    return t(s, d, "part").select("p_partkey", C.access_of_attribute(attribute).alias("access"), C.bit_range_or_null(bits)["high"].alias("high"), C.field_name(text, F.lit("7-4")).alias("name"))


@query("SELECT count(*) AS calls, count(*) AS answered, 0 AS failed, 0 + 12 * count(*) AS tokens_out FROM (SELECT n_name FROM nation)")
def enrichment_usage(s, d):
    n = t(s, d, "nation")
    asked = N.enriched(n, N.field_prompt(F.col("n_name"), F.lit("a b c d e f g h i j k l")))
    return N.usage(asked).select("calls", "answered", "failed", "tokens_out")


# joins without a small side

@query("SELECT v, min_by(o_orderkey, o_orderkey) AS first_order FROM (SELECT DISTINCT l_partkey * 7 + l_linenumber AS v FROM lineitem) JOIN orders ON v BETWEEN o_custkey * 9 AND o_custkey * 9 + o_orderkey % 37 GROUP BY v")
def first_range_of_value(s, d):
    """Each value of all line items with the first of all orders' ranges that holds it."""
    points = t(s, d, "lineitem").select((F.col("l_partkey") * 7 + F.col("l_linenumber")).alias("v"))
    ranges = t(s, d, "orders").select((F.col("o_custkey") * 9).alias("lo"), (F.col("o_custkey") * 9 + F.col("o_orderkey") % 37).alias("hi"), "o_orderkey", F.col("o_orderkey").alias("first_order"))
    return R.first_range(points, "v", ranges, "lo", "hi", "o_orderkey", "first_order")


@query("SELECT v, o_orderkey FROM (SELECT DISTINCT l_partkey * 7 + l_linenumber AS v FROM lineitem) JOIN orders ON v BETWEEN o_custkey * 9 - 40 AND o_custkey * 9 - 40 + o_orderkey % 11 * 3 - 3")
def ranges_of_values(s, d):
    """All pairs of a value and a range that holds it; some ranges are empty, some begin below zero."""
    points = t(s, d, "lineitem").select((F.col("l_partkey") * 7 + F.col("l_linenumber")).alias("v")).distinct()
    lo = F.col("o_custkey") * 9 - 40
    ranges = t(s, d, "orders").select(lo.alias("lo"), (lo + F.col("o_orderkey") % 11 * 3 - 3).alias("hi"), "o_orderkey")
    return R.pairs(points, "v", ranges, "lo", "hi").select("v", "o_orderkey")


@query("WITH st AS (SELECT CAST(round(o_totalprice * 10) AS BIGINT) AS v, max(o_orderkey) AS section FROM orders GROUP BY 1) SELECT l_orderkey, l_linenumber, page, section FROM (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 10) AS BIGINT) AS page FROM lineitem) ASOF LEFT JOIN st ON page >= v")
def last_order_below_price(s, d):
    """Each line item with the last of all orders whose price is not above its own."""
    pages = t(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * 10).cast("long").alias("page"))
    starts = t(s, d, "orders").select(F.round(F.col("o_totalprice") * 10).cast("long").alias("start"), F.col("o_orderkey").alias("section"), F.col("o_orderkey").alias("ord"))
    return G.section_of_page(pages, starts)


@query("SELECT event_id, grp FROM (SELECT event_id, sum(CASE WHEN user_id % 5 = 0 AND event_type = 'click' THEN 1 ELSE 0 END) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS grp FROM events) WHERE grp > 0")
def gap_fill_of_all(s, d):
    """One group of all events: as long as the table."""
    e = t(s, d, "events").withColumn("table", F.lit("all"))
    return G.gap_fill(e, "table", "event_id", (F.col("user_id") % 5 == 0) & (F.col("event_type") == "click")).select("event_id", "grp")


@query("WITH n AS (SELECT p_partkey AS id, string_split(lower(p_name), ' ') AS w FROM part), q AS (SELECT id, CASE id % 11 WHEN 0 THEN w[1][1:2] ELSE w[1] || ' ' || w[2] END AS name FROM n), ti AS (SELECT p_partkey AS ord, p_name || ' ' || p_type AS title FROM part) SELECT id, min_by(title, ord) AS title FROM q LEFT JOIN ti ON contains(lower(title), name) GROUP BY id")
def titles_of_part_names(s, d):
    """The first of all parts' titles that contains the beginning of a part's name, of two characters or of two words."""
    p, w = t(s, d, "part"), F.split(F.lower("p_name"), " ")
    name = F.when(F.col("p_partkey") % 11 == 0, F.left(w[0], F.lit(2))).otherwise(F.concat_ws(" ", w[0], w[1]))
    return G.title_match(p.select(F.col("p_partkey").alias("id"), name.alias("name")), p.select(F.concat_ws(" ", "p_name", "p_type").alias("title"), F.col("p_partkey").alias("ord")))


@query("WITH c AS (SELECT p_partkey AS class_id, CASE WHEN p_partkey % 2 = 0 THEN lower(p_type) ELSE string_split(lower(p_type), ' ')[2] END AS name FROM part), tt AS (SELECT s_suppkey AS table_id, CASE s_suppkey % 4 WHEN 0 THEN 'plated' WHEN 1 THEN 'Anodized tables' WHEN 2 THEN 'st' ELSE s_name END AS title FROM supplier) SELECT class_id, min(table_id) AS table_id FROM c LEFT JOIN tt ON contains(lower(title), name) OR contains(name, lower(title)) GROUP BY class_id")
def tables_of_classes(s, d):
    """The first table whose title contains the class's name, or the other way round."""
    kind = F.lower("p_type")
    classes = t(s, d, "part").select(F.col("p_partkey").alias("class_id"), F.when(F.col("p_partkey") % 2 == 0, kind).otherwise(F.get(F.split(kind, " "), F.lit(1))).alias("name"))
    by = F.col("s_suppkey") % 4
    tables = t(s, d, "supplier").select(F.col("s_suppkey").alias("table_id"), F.when(by == 0, "plated").when(by == 1, "Anodized tables").when(by == 2, "st").otherwise(F.col("s_name")).alias("title"), F.col("s_suppkey").alias("ord"))
    return D.class_of_names(classes, tables)


@query("WITH b AS (SELECT p_partkey AS ord, 'b' || p_partkey AS id, p_partkey * 37 % 1000 AS x0, p_partkey * 91 % 1000 AS y0, p_size * (CASE WHEN p_partkey % 100 = 0 THEN 20 ELSE 1 END) AS w FROM part), l AS (SELECT o_orderkey AS line, o_custkey * 17 % 1000 AS x0, o_custkey * 29 % 1000 AS y0, o_orderkey * 13 % 1000 AS x1, o_orderkey * 7 % 1000 AS y1 FROM orders),"
       " f AS (SELECT line, max_by(s.id, s.ord) AS source FROM l JOIN b s ON l.x0 BETWEEN s.x0 AND s.x0 + s.w AND l.y0 BETWEEN s.y0 AND s.y0 + s.w GROUP BY line), g AS (SELECT line, max_by(s.id, s.ord) AS target FROM l JOIN b s ON l.x1 BETWEEN s.x0 AND s.x0 + s.w AND l.y1 BETWEEN s.y0 AND s.y0 + s.w GROUP BY line) SELECT line, source, target FROM f JOIN g USING (line) WHERE source <> target")
def edges_of_one_drawing(s, d):
    """All parts as boxes of one drawing, a hundredth of them large, and all orders as its lines."""
    p, o = t(s, d, "part"), t(s, d, "orders")
    wide = F.col("p_size") * F.when(F.col("p_partkey") % 100 == 0, 20).otherwise(1)
    x, y = F.col("p_partkey") * 37 % 1000, F.col("p_partkey") * 91 % 1000
    boxes = p.select(F.lit(0).alias("drawing"), F.concat(F.lit("b"), "p_partkey").alias("id"), x.alias("x0"), y.alias("y0"), (x + wide).alias("x1"), (y + wide).alias("y1"), F.col("p_partkey").alias("ord"))
    at = lambda c, k: F.col(c) * k % 1000
    lines = o.select(F.lit(0).alias("drawing"), F.col("o_orderkey").alias("line"), at("o_custkey", 17).alias("x0"), at("o_custkey", 29).alias("y0"), at("o_orderkey", 13).alias("x1"), at("o_orderkey", 7).alias("y1"))
    return D.edges_between(boxes, lines).select("line", "source", "target")


# registers out of tables of several shapes

SHAPES = [["Location", "Attrib", "Field Name", "Description"], ["Bit Position", "Description of function", "Type of access", "Name"], ["Bits", "R/W", "Description"], ["Span", "Kind", "Label", "Meaning"]]
MIXED = (
    "WITH f AS (SELECT l_partkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) - 1 AS ordinal, l_linenumber, (4 * l_linenumber + 3) || ':' || (4 * l_linenumber) AS bits, CASE WHEN l_suppkey % 9 = 0 THEN 'Reserved' ELSE 'F' || l_suppkey END AS name, "
    "CASE l_returnflag WHEN 'A' THEN 'read-only' WHEN 'R' THEN 'write-only' ELSE 'read-write' END AS access, 'q' || CAST(l_quantity AS INTEGER) || CASE WHEN l_quantity > 25 THEN (CASE WHEN l_partkey % 4 = 2 THEN chr(10) ELSE ' ' END) || 'more of it' ELSE '' END AS description FROM lineitem), "
    "m AS (SELECT l_partkey, CAST(ordinal AS INTEGER) AS ordinal, bits, 4 * l_linenumber + 3 AS high, 4 * l_linenumber AS low, name, access, description FROM f WHERE name <> 'Reserved') "
)


def mixed_cells(s, d) -> DataFrame:
    """Every part as a table whose heading has one of four shapes, the last of which only a hint tells; every line item is a field, and the rest of a long description stands in a row of its own."""
    n, key = F.col("l_linenumber"), ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    bits, access = F.concat(4 * n + 3, F.lit(":"), 4 * n), F.when(F.col("l_returnflag") == "A", "RO").when(F.col("l_returnflag") == "R", "WO").otherwise("RW")
    name, text = F.when(F.col("l_suppkey") % 9 == 0, "Reserved").otherwise(F.concat(F.lit("F"), "l_suppkey")), F.concat(F.lit("q"), F.col("l_quantity").cast("int"))
    shape = F.col("l_partkey") % 4
    row = lambda b, a, w, x: F.when(shape == 1, F.array(b, x, a, w)).when(shape == 2, F.array(b, a, F.when(w == "", x).otherwise(F.concat(w, F.lit("\n"), x)))).otherwise(F.array(b, a, w, x))
    no = F.lit("")
    rows = F.when(F.col("l_quantity") > 25, F.array(row(bits, access, name, text), row(no, no, no, F.lit("more of it")))).otherwise(F.array(row(bits, access, name, text)))
    fields = t(s, d, "lineitem").select("l_partkey", F.struct(*key).alias("k"), rows.alias("rows"))
    named = F.concat(F.lit("TABLE_"), "l_partkey")
    body = fields.groupBy("l_partkey").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "rows"))), lambda x: x["rows"])).alias("rows"))
    heads = F.element_at(F.array(*[F.array(*[F.lit(c) for c in x]) for x in SHAPES]), (shape + 1).cast("int"))
    return written(body.select(named.alias("name"), F.posexplode(F.concat(F.array(heads), "rows")).alias("row_no", "cells")), "cells")


def mixed_hints(s) -> DataFrame:
    words = [("bits", ["Span"]), ("access", ["Kind"]), ("name", ["Label"]), ("description", ["Meaning"])]
    return s.createDataFrame([("unusual", words, 0)], "match_title string, columns array<struct<role:string,names:array<string>>>, ord long")


@query(MIXED + "SELECT 'TABLE_' || l_partkey AS \"table\", ordinal, bits, high, low, name, access, description FROM m")
def fields_of_mixed_tables(s, d):
    """Fields of all tables at once, each with the columns that its own heading tells."""
    cells = mixed_cells(s, d)
    titles = cells.where("row_no = 0").select(F.col("name").alias("table_id"), F.concat(F.when(F.get("cells", F.lit(0)) == "Span", "unusual ").otherwise(""), "name").alias("title"))
    maps = E.column_maps(cells, E.hints_of_tables(titles, mixed_hints(s)))
    return E.field_rows(cells, maps).select("table", "ordinal", "bits", "high", "low", "name", "access", "description")


@query(MIXED + ", r AS (SELECT l_partkey, string_agg(ordinal || ' ' || bits || ' ' || name || ' ' || access || ' ' || description, '; ' ORDER BY ordinal) AS fields FROM m GROUP BY l_partkey) SELECT 'REG_' || lpad(printf('%X', p_partkey), greatest(3, length(printf('%X', p_partkey)))::INT, '0') AS id, p_name AS name, CASE WHEN p_partkey % 300 < 200 THEN 'CLASS_' || (p_partkey // 300) END AS class_id, CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem) THEN 'TABLE_' || p_partkey END AS spec_table, coalesce(fields, '') AS fields FROM part LEFT JOIN r ON l_partkey = p_partkey")
def registers_of_mixed_tables(s, d):
    """Registers with their class and fields: those of every third part name their table, the others are found by it in the title."""
    p, cells = t(s, d, "part"), mixed_cells(s, d)
    there = cells.where("row_no = 0").select(F.col("name").alias("table_id"))
    key = F.concat(F.lit("TABLE_"), "p_partkey")
    config = p.join(there, key == F.col("table_id"), "left").select(F.concat(F.hex("p_partkey"), F.lit("h")).alias("offset"), "p_name", F.concat(F.lit("no"), "p_partkey", F.lit("x Register")).alias("name"), F.col("p_partkey").alias("ord"), F.when(F.col("p_partkey") % 3 == 0, F.col("table_id")).alias("table_id"))
    tables = p.join(there, key == F.col("table_id")).select("table_id", F.concat(F.when(F.col("p_partkey") % 4 == 3, "unusual ").otherwise(""), F.lit("fields of no"), "p_partkey", F.lit("x")).alias("title"), F.col("p_partkey").alias("ord"))
    last = p.agg(F.max("p_partkey")).first()[0] or 0
    classes = s.range(last // 300 + 1).select(F.concat(F.lit("CLASS_"), "id").alias("class_id"), (300 * F.col("id")).alias("start_int"), (300 * F.col("id") + 199).alias("end_int"), F.col("id").alias("ord"))
    found = D.registers_of(config.drop("p_name"), tables, classes, cells, hints=mixed_hints(s))
    named = found.join(p.select(F.col("p_partkey").alias("ord"), "p_name"), "ord")
    one = F.transform("fields", lambda f: F.concat_ws(" ", f["ordinal"], f["bits"], f["name"], f["access"], f["raw"]))
    return named.select("id", F.col("p_name").alias("name"), "class_id", "spec_table", F.array_join(one, "; ").alias("fields"))


@query("SELECT format, count(*) AS n, CAST(sum(name) AS BIGINT) AS name, CAST(sum(value) AS BIGINT) AS value FROM (SELECT CASE p_partkey % 5 WHEN 0 THEN '5col' WHEN 1 THEN '3col' WHEN 2 THEN '4col_alt' ELSE '3col' END AS format, CASE p_partkey % 5 WHEN 2 THEN 2 END AS name, CASE p_partkey % 5 WHEN 0 THEN 3 END AS value FROM part) GROUP BY format")
def csv_formats(s, d):
    forms = [["Location", " ATTRIB ", "Text", "Value", "Meaning"], ["location", "attrib", "x", "y", "z"], ["Address", "Access", "Name", "Text"], ["x"], []]
    cells = F.element_at(F.array(*[F.array(*[F.lit(c) for c in x]).cast("array<string>") for x in forms]), (F.col("p_partkey") % 5 + 1).cast("int"))
    found = t(s, d, "part").select(E.csv_format(cells).alias("f")).groupBy("f.format")
    return found.agg(F.count(F.lit(1)).alias("n"), F.sum("f.name").alias("name"), F.sum("f.value").alias("value"))


@query("WITH v AS (SELECT lower(s_name) AS k, s_suppkey AS ord, s_nationkey AS one, s_suppkey % 7 AS two FROM supplier), c AS (SELECT p_partkey AS class_id, CASE p_partkey % 3 WHEN 0 THEN 'registers of supplier#' || lpad((p_partkey % 40)::VARCHAR, 9, '0') WHEN 1 THEN right(lpad((p_partkey % 90)::VARCHAR, 9, '0'), 2) ELSE 'none' END AS name FROM part), f AS (SELECT class_id, min(ord) AS ord FROM c JOIN v ON contains(k, name) OR contains(name, k) GROUP BY class_id) SELECT class_id, coalesce(one::VARCHAR, 'N/A') AS v1, coalesce(two::VARCHAR, 'N/A') AS v2 FROM c LEFT JOIN f USING (class_id) LEFT JOIN v USING (ord)")
def versions_of_classes(s, d):
    x = F.col("p_partkey")
    pad = lambda n: F.lpad((x % n).cast("string"), 9, "0")
    classes = t(s, d, "part").select(x.alias("class_id"), F.when(x % 3 == 0, F.concat(F.lit("Registers of Supplier#"), pad(40))).when(x % 3 == 1, F.right(pad(90), F.lit(2))).otherwise("none").alias("name"))
    rows = t(s, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("ord"), F.col("s_nationkey").cast("string").alias("1.00"), (F.col("s_suppkey") % 7).cast("string").alias("2.00"))
    found = E.class_versions(classes, rows, ["1.00", "2.00"])
    return found.select("class_id", F.col("version_support")["1.00"].alias("v1"), F.col("version_support")["2.00"].alias("v2"))


# searches by a persisted index

def indexed(s, d, name: str, rows: DataFrame, text, words=None) -> X.TextIndex:
    return X.TextIndex(s, stored(s, d, name, lambda path: X.write_index(rows, text, path, words)))


@query(Q.SQL["search_nodes"])
def indexed_search_nodes(s, d):
    nodes = Q.registers(s, d)
    index = indexed(s, d, "nodes", nodes, F.concat_ws(" ", "name", "description", F.array_join("index_keywords", " ")), F.col("index_keywords"))
    return X.search_nodes(index, nodes, "brass a 12 brass", 20).select("id", "score")


@query(Q.SQL["search_keywords"])
def indexed_search_keywords(s, d):
    nodes = Q.registers(s, d)
    index = indexed(s, d, "nodes", nodes, F.concat_ws(" ", "name", "description", F.array_join("index_keywords", " ")), F.col("index_keywords"))
    return X.search_keywords(index, nodes, ["Brass", "SMALL"]).select("id", "score")


@query(Q.SQL["search_text_excerpt"])
def indexed_search_text(s, d):
    c = Q.chunks(s, d)
    return X.search_text(indexed(s, d, "chunks", c, F.col("full_text")), c, "full_text", "ation").select("id", F.col("position").cast("long").alias("position"), "excerpt")


@query(CHK + "SELECT id FROM chk WHERE contains(lower(full_text), 'the ') ORDER BY ord LIMIT 7")
def indexed_first_chunks(s, d):
    c = Q.chunks(s, d)
    return X.first_with_text(indexed(s, d, "chunks", c, F.col("full_text")), c, "The ", 7).select("id")


# from parts to a published graph

@query(
    "WITH reg AS (SELECT p_partkey, p_brand, p_size FROM part), fld AS (SELECT l_returnflag || l_linestatus || '_' || l_suppkey AS name FROM lineitem JOIN reg ON l_partkey = p_partkey) "
    "SELECT 'nodes' AS what, 'REGISTER' AS kind, count(*) AS n FROM reg UNION ALL SELECT 'nodes', 'REG_CLASS', count(DISTINCT p_brand) FROM reg UNION ALL SELECT 'nodes', 'FEATURE', count(*) FROM nation UNION ALL SELECT 'nodes', 'ALL', (SELECT count(*) + count(DISTINCT p_brand) FROM reg) + (SELECT count(*) FROM nation) "
    "UNION ALL SELECT 'relations', 'BELONGS_TO', count(*) FROM reg UNION ALL SELECT 'relations', 'DEFINED_BY', count(*) FROM reg UNION ALL SELECT 'relations', 'PART_OF', count(*) FROM nation WHERE n_regionkey <> n_nationkey UNION ALL SELECT 'relations', 'ALL', (SELECT 2 * count(*) FROM reg) + (SELECT count(*) FROM nation WHERE n_regionkey <> n_nationkey) "
    "UNION ALL SELECT * FROM (SELECT 'error', 'zero_fields', count(*) AS n FROM reg WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey)) WHERE n > 0 UNION ALL SELECT * FROM (SELECT 'error', 'field_name_length', count(*) AS n FROM fld WHERE length(name) > 5) WHERE n > 0 UNION ALL SELECT * FROM (SELECT 'error', 'dangling_target', count(*) AS n FROM reg) WHERE n > 0"
)
def built_graph(s, d):
    """The graph of all parts as registers, brands as classes and nations as features, published and read back: its nodes and edges by type, the issues of
    configured rules, and edges to tables, which are none of its parts."""
    made = written(register_rows(s, d).withColumn("spec_section", F.lit(None).cast("string")), "registers")
    named = t(s, d, "part").groupBy("p_brand").agg(F.min("p_partkey").alias("ord"))
    span = [F.lit("0h").alias("address_start"), F.lit("FFh").alias("address_end"), F.create_map(F.lit("1.00"), F.lit("Yes")).alias("version_support")]
    classes = named.select(F.concat(F.lit("REGCLASS_"), "p_brand").alias("id"), "ord", F.col("p_brand").alias("name"), *span)
    key, none = F.col("n_nationkey"), F.array().cast("array<string>")
    owner = F.when(F.col("n_regionkey") != key, F.concat(F.lit("N"), "n_regionkey"))
    features = t(s, d, "nation").select(F.concat(F.lit("N"), key).alias("id"), key.alias("ord"), F.col("n_name").alias("name"), F.lit("").alias("description"), F.lit("P1").alias("priority"), owner.alias("parent_id"), *[none.alias(k) for k in ("groups", "figures", "tables", "registers", "spec_sections")])
    rules = [{"check": "zero_fields", "severity": "error"}, {"check": "field_name_length", "max_chars": 5}, {"check": "missing_bits", "severity": "warning"}]
    config = Config({"validation": {"enabled": True, "checks": {"registers": {"enabled": True, "rules": rules}}}})
    parts = B.Parts(registers=made, classes=classes, features=features)
    root = f"{shared_dir(s)}/graph/built-{uuid.uuid4().hex}"
    B.save(*B.graph(parts, config), root)
    nodes, relations = B.load(s, root)
    counts = A.statistics(nodes, relations).select("what", F.col("type").alias("kind"), F.col("count").alias("n"))
    found = B.configured_checks(config, parts).select("severity", "check").unionByName(G.validate(nodes, relations).select("severity", "check"))
    return counts.unionByName(found.groupBy(F.col("severity").alias("what"), F.col("check").alias("kind")).agg(F.count(F.lit(1)).alias("n")))


# files that no task holds

@query("SELECT doc_id, source, length(x) AS n_chars, md5(x) AS digest FROM (SELECT doc_id, source, regexp_replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), '^\\s+|\\s+$', '', 'g') AS x FROM documents)")
def documents_through_csv(s, d):
    """All documents, written as CSV with quoted line ends, read back."""
    rows = t(s, d, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    path = stored(s, d, "csv", lambda path: rows.write.options(quoteAll=True, escape='"').csv(path))
    cell = F.get("cells", F.lit(2))
    return large.read_csv_rows(s, path).select(F.get("cells", F.lit(0)).cast("long").alias("doc_id"), F.get("cells", F.lit(1)).alias("source"), F.length(cell).cast("long").alias("n_chars"), F.md5(cell).alias("digest"))


@query("SELECT 'node' AS kind, 'P' || p_partkey AS id, p_name AS text, CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS BIGINT) AS ord FROM part UNION ALL SELECT 'relation', 'O' || o_orderkey, 'P' || (o_orderkey % 1000), CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) FROM orders")
def graph_through_document(s, d):
    """A graph of all parts and orders, written as one JSON document, read back."""
    nodes = t(s, d, "part").select(F.concat(F.lit("P"), "p_partkey").alias("id"), F.lit("PART").alias("type"), F.col("p_name").alias("name"), F.create_map(F.lit("}"), F.col("p_brand")).alias("extras"), F.col("p_partkey").alias("ord"))
    edges = t(s, d, "orders").select(F.concat(F.lit("O"), "o_orderkey").alias("id"), F.lit("HAS").alias("type"), F.concat(F.lit("P"), F.col("o_orderkey") % 1000).alias("source_node"), F.col("o_orderkey").alias("ord"))
    got = large.read_large_graph(s, stored(s, d, "document", lambda path: export.write_single(nodes, edges, path)))
    return got[0].select(F.lit("node").alias("kind"), "id", F.col("name").alias("text"), "ord").unionByName(got[1].select(F.lit("relation").alias("kind"), "id", F.col("source_node").alias("text"), "ord"))


# checks that follow changes

@query(
    "WITH n AS (SELECT 'P' || p_partkey AS id, CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_name END AS name FROM part WHERE p_partkey % 97 <> 0 UNION ALL SELECT 'P' || p_partkey, '' FROM part WHERE p_partkey % 101 = 0 UNION ALL SELECT 'S' || s_suppkey, s_name FROM supplier WHERE s_suppkey % 40 <> 0), "
    "e AS (SELECT 'P' || l_partkey AS a, 'S' || l_suppkey AS b FROM lineitem WHERE l_orderkey % 13 <> 0 UNION ALL SELECT 'P' || (l_partkey + 3), 'S' || l_suppkey FROM lineitem WHERE l_orderkey % 17 = 0), "
    "c AS (SELECT id, sum(x) AS nodes, sum(u) AS unnamed, sum(s) AS sources, sum(t) AS targets FROM (SELECT id, 1 AS x, CASE WHEN coalesce(name, '') = '' THEN 1 ELSE 0 END AS u, 0 AS s, 0 AS t FROM n UNION ALL SELECT a, 0, 0, 1, 0 FROM e UNION ALL SELECT b, 0, 0, 0, 1 FROM e) GROUP BY id) "
    "SELECT * FROM (SELECT id AS node_id, 'duplicate_id' AS \"check\", CAST(nodes - 1 AS BIGINT) AS n FROM c WHERE nodes > 1 UNION ALL SELECT id, 'missing_name', CAST(unnamed AS BIGINT) FROM c WHERE unnamed > 0 UNION ALL SELECT id, 'dangling_source', CAST(sources AS BIGINT) FROM c WHERE nodes = 0 AND sources > 0 UNION ALL SELECT id, 'dangling_target', CAST(targets AS BIGINT) FROM c WHERE nodes = 0 AND targets > 0 UNION ALL SELECT id, 'orphan', CAST(nodes AS BIGINT) FROM c WHERE sources + targets = 0 AND nodes > 0)"
)
def issues_after_changes(s, d):
    """The issues of the graph of all parts, suppliers and line items, after nodes and edges have gone and come."""
    p, sup, x = t(s, d, "part"), t(s, d, "supplier"), t(s, d, "lineitem")
    key, node = F.col("p_partkey"), F.concat(F.lit("P"), "p_partkey").alias("id")
    parts = p.select(node, F.when(key % 50 != 0, F.col("p_name")).alias("name"), key.alias("k"))
    suppliers = sup.select(F.concat(F.lit("S"), "s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("k"))
    edges = x.select(F.concat(F.lit("P"), "l_partkey").alias("source_node"), F.concat(F.lit("S"), "l_suppkey").alias("target_node"), F.col("l_orderkey").alias("k"), F.concat(F.lit("P"), F.col("l_partkey") + 3).alias("other"))
    book = U.GraphCounts(s, f"{shared_dir(s)}/graph/counts-{uuid.uuid4().hex}")
    book.add(parts.unionByName(suppliers), edges)
    signed = lambda df, sign: df.withColumn("sign", F.lit(sign))
    gone = signed(parts.where("k % 97 = 0").unionByName(suppliers.where("k % 40 = 0")), -1)
    new = signed(p.where("p_partkey % 101 = 0").select(node, F.lit("").alias("name"), key.alias("k")), 1)
    moved = signed(edges.where("k % 13 = 0"), -1).unionByName(signed(edges.where("k % 17 = 0").withColumn("source_node", F.col("other")), 1))
    book.add(gone.unionByName(new), moved)
    return book.issues().select("node_id", "check", "n")
