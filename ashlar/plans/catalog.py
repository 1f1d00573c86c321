"""The query catalogue over one graph, with the uniform response envelope.

A method returns a lazy DataFrame; call() runs it and wraps what came."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import assemble as A
from ..operators import extract as E
from ..operators import graph as G
from ..operators import lookups as L
from ..sources.graph import update_coverage

MAX_RESULTS = 1000
STATUSES = ("NOT_IMPLEMENTED", "PARTIAL", "IMPLEMENTED", "NOT_APPLICABLE")
# The kinds of tables and figures, and the node types that a keyword search may name.
TABLE_TYPES = ("REGISTER_FIELDS", "REGISTER_MAP", "SIGNAL_LIST", "TIMING", "OTHER")
FIGURE_TYPES = ("STATE_DIAGRAM", "TIMING_DIAGRAM", "BLOCK_DIAGRAM", "REGISTER_LAYOUT", "FLOWCHART", "OTHER")
SEARCHED_TYPES = ("REGISTER", "SPEC_CHUNK", "TABLE", "FIGURE", "REG_CLASS")


def success(function: str, params: dict, rows: list | dict | str, truncated: bool = False) -> dict:
    """A list counts its rows; one thing counts as one."""
    return {"success": True, "function": function, "params": params, "count": len(rows) if isinstance(rows, list) else 1, "truncated": truncated, "results": rows, "error": None}


def failure(function: str, params: dict, error: str) -> dict:
    return {"success": False, "function": function, "params": params, "count": 0, "truncated": False, "results": [], "error": error}


class GraphCatalog:
    def __init__(self, nodes: DataFrame, relations: DataFrame, texts: DataFrame | None = None, spec: dict | None = None, typed: str | None = None):
        """texts: (name, content) of table and diagram files; spec: what is known of the document; typed: where write_registers() has written
        this graph's registers, from which lookups of registers and fields are answered."""
        self.typed = typed
        self.nodes, self.relations, self.texts, self.spec = nodes, relations, texts, spec or {}

    def functions(self) -> list[str]:
        """The names of all queries."""
        return sorted(n for n in dir(type(self)) if n.split("_")[0] in ("get", "list", "search", "set", "validate") and callable(getattr(type(self), n)) and n not in ("get_typed",))

    def call(self, function: str, **params) -> dict:
        """Run a query by name; errors come in the envelope, with their code first."""
        if function not in self.functions():
            return failure(function, params, f"INVALID_PARAM: no function {function}")
        try:
            found = getattr(self, function)(**params)
            rows = [r.asDict(True) for r in found.limit(MAX_RESULTS + 1).collect()]
        except (ValueError, LookupError, TypeError) as e:
            code = "INVALID_PARAM: " if isinstance(e, TypeError) else ""
            return failure(function, params, code + str(e).strip("'"))
        if not rows and function in self.must_find:
            return failure(function, params, f"NOT_FOUND: {params}{self._known(function)}")
        return success(function, params, rows[0] if function in self.single and rows else rows[:MAX_RESULTS], len(rows) > MAX_RESULTS)

    must_find = (
        "get_node_by_id", "search_by_keywords", "get_register_by_offset", "get_register_by_name", "get_field_by_id", "get_field_by_name", "get_field_by_bit", "search_fields_by_name", "get_section_by_number",
        "get_table_by_reference", "get_figure_by_reference", "get_table_csv", "get_figure_plantuml", "get_register_class_by_id", "get_feature_by_id", "get_hd_sequence_by_id",
    )
    #: Queries whose result is one thing.
    single = ("get_section_by_number", "get_spec_info")

    def _known(self, function: str) -> str:
        if function != "get_register_by_offset":
            return ""
        r = L.offset_bounds(self._registers()).first()
        return "" if r["low"] is None else f"; valid offsets are {r['low']}h to {r['high']}h"

    def _registers(self) -> DataFrame:
        return L.read_registers(self.nodes.sparkSession, self.typed) if self.typed else L.registers(self.nodes)

    def _fields(self) -> DataFrame:
        return L.read_fields(self.nodes.sparkSession, self.typed) if self.typed else L.fields(self._registers())

    def _chunks(self) -> DataFrame:
        return L.chunks(self.nodes)

    def _features(self) -> DataFrame:
        return L.features(self.nodes)

    def get_node_by_id(self, node_id: str) -> DataFrame:
        return G.by_id(self.nodes, node_id)

    def get_nodes_by_type(self, node_type: str) -> DataFrame:
        return self.nodes.where(F.col("type") == node_type.upper()).orderBy("ord")

    def get_typed(self, node_id: str, node_type: str) -> DataFrame:
        found = G.by_id(self.nodes, node_id)
        kinds = [r["type"] for r in found.select("type").collect()]
        if not kinds:
            raise LookupError(f"NOT_FOUND: {node_id}")
        if kinds[0] != node_type:
            raise ValueError(f"INVALID_TYPE: {node_id} is a {kinds[0]}")
        return found

    def get_register_by_id(self, register_id: str) -> DataFrame:
        return self.get_typed(register_id, "REGISTER")

    def get_table_by_id(self, table_id: str) -> DataFrame:
        return self.get_typed(table_id, "TABLE")

    def get_figure_by_id(self, figure_id: str) -> DataFrame:
        return self.get_typed(figure_id, "FIGURE")

    def get_chunk_by_id(self, chunk_id: str) -> DataFrame:
        return self.get_typed(chunk_id, "SPEC_CHUNK")

    def list_tables(self, table_type: str | None = None) -> DataFrame:
        return L.of_kind(self.nodes.where("type = 'TABLE'"), table_type, L.extra("table_type"), TABLE_TYPES)

    def list_figures(self, figure_type: str | None = None) -> DataFrame:
        return L.of_kind(self.nodes.where("type = 'FIGURE'"), figure_type, L.extra("figure_type"), FIGURE_TYPES)

    def list_chunks(self) -> DataFrame:
        return self.get_nodes_by_type("SPEC_CHUNK")

    def get_table(self, table_id: str) -> DataFrame:
        return self.get_node_by_id(table_id)

    def get_figure(self, figure_id: str) -> DataFrame:
        return self.get_node_by_id(figure_id)

    def get_chunk(self, chunk_id: str) -> DataFrame:
        return self.get_node_by_id(chunk_id)

    def get_feature_by_id(self, feature_id: str) -> DataFrame:
        return self.get_node_by_id(feature_id)

    def get_hd_sequence_by_id(self, sequence_id: str) -> DataFrame:
        return self.get_node_by_id(sequence_id)

    # registers and fields

    def get_register_by_offset(self, offset: str) -> DataFrame:
        return L.register_by_offset(self._registers(), offset)

    def get_register_by_name(self, name: str, exact: bool = False) -> DataFrame:
        return L.register_summary(L.registers_by_name(self._registers(), name, exact))

    def list_registers(self, class_id: str | None = None) -> DataFrame:
        if class_id is not None and self.nodes.where(F.col("id") == class_id).isEmpty():
            raise LookupError(f"NOT_FOUND: {class_id}")
        return L.register_summary(L.register_list(self._registers(), class_id))

    def get_registers_in_range(self, start: str, end: str) -> DataFrame:
        return L.register_summary(G.registers_in_range(self._registers(), start, end))

    def get_field_by_id(self, field_id: str) -> DataFrame:
        return L.field_by_id(self._fields(), field_id).drop("ord")

    def get_field_by_name(self, register_id: str, field_name: str) -> DataFrame:
        self.get_typed(register_id, "REGISTER")
        return L.field_by_name(self._fields(), register_id, field_name).drop("ord")

    def get_field_by_bit(self, register_id: str, bit: int) -> DataFrame:
        self.get_typed(register_id, "REGISTER")
        return L.fields_holding(self._fields().where(F.col("register_id") == register_id), int(bit)).drop("ord")

    def list_fields_in_register(self, register_id: str) -> DataFrame:
        self.get_typed(register_id, "REGISTER")
        return L.fields_of(self._fields(), register_id).select("id", "name", "bits", "width", "access")

    def search_fields_by_access(self, access: str, register_id: str | None = None) -> DataFrame:
        return L.fields_with_access(self._fields(), access, register_id).select("register_id", "register_name", "id", "name", "bits", "access")

    def search_fields_by_name(self, pattern: str) -> DataFrame:
        return L.fields_named(self._fields(), pattern).select("register_id", "register_name", "id", "name", "bits", "access")

    def search_fields_by_text(self, query: str) -> DataFrame:
        return L.fields_with_text(self._fields(), query)

    def get_register_class_by_id(self, class_id: str) -> DataFrame:
        return self.list_register_classes().where(F.col("id") == class_id)

    def list_register_classes(self) -> DataFrame:
        """Classes with the ids of their registers and how many they are."""
        classes = self.nodes.where("type = 'REG_CLASS'").select(F.col("id").alias("class_id"), "id", "name", F.col("ord").alias("class_ord"))
        return E.class_members(classes, self._registers()).orderBy("class_ord").select("id", "name", "member_register_ids", "member_count")

    def list_register_sizes(self) -> DataFrame:
        return L.register_sizes(self._registers())

    # sections and chunks

    def get_section_by_number(self, section_number: str) -> DataFrame:
        return L.section(self._chunks(), section_number)

    def list_sections(self, parent: str | None = None) -> DataFrame:
        return L.section_list(self._chunks(), parent)

    def search_chunks_by_text(self, query: str) -> DataFrame:
        return G.search_text(self._chunks(), query).orderBy("ord").drop("ord")

    def search_chunks(self, text: str, limit: int = 10) -> DataFrame:
        return L.chunks_with_text(self._chunks(), text, limit)

    # tables and figures

    def get_table_by_reference(self, reference: str) -> DataFrame:
        return L.by_reference(self.nodes.where("type = 'TABLE'"), reference, F.coalesce("source.spec_reference", L.extra("table_number")))

    def get_figure_by_reference(self, reference: str) -> DataFrame:
        return L.by_reference(self.nodes.where("type = 'FIGURE'"), reference, F.coalesce("source.spec_reference", L.extra("figure_number")))

    def get_table_csv(self, table_id: str) -> DataFrame:
        return self._content(table_id, "TABLE", "csv_file", "NO_CSV")

    def get_figure_plantuml(self, figure_id: str) -> DataFrame:
        return self._content(figure_id, "FIGURE", "text_diagram_file", "NO_PLANTUML")

    def _content(self, node_id: str, kind: str, key: str, none: str) -> DataFrame:
        found = self.get_typed(node_id, kind).select(L.extra(key).alias("file")).first()["file"]
        if not found:
            raise LookupError(f"{none}: {node_id} names no file")
        if self.texts is None:
            raise LookupError(f"FILE_NOT_FOUND: {found}")
        here = L.content_of(self.nodes, node_id, L.extra(key), self.texts)
        if here.where("content IS NOT NULL").isEmpty():
            raise LookupError(f"FILE_NOT_FOUND: {found}")
        return here

    def list_tables_by_chapter(self) -> DataFrame:
        return L.by_chapter(self.nodes.where("type = 'TABLE'"), F.regexp_replace("id", "^[A-Z]+_", ""))

    # features

    def get_feature_registers(self, feature_id: str) -> DataFrame:
        return L.feature_registers(self._features(), self.nodes, feature_id)

    def get_feature_groups(self) -> DataFrame:
        return L.feature_groups(self._features())

    def list_features_not_implemented_in_driver(self) -> DataFrame:
        return self._features().where("missing_in_driver").orderBy("ord").select("id", "name")

    def list_features_by_driver_coverage(self, status: str | None = None) -> DataFrame:
        return L.features_by_driver(self._features(), status)

    # the document

    def get_spec_info(self) -> DataFrame:
        return self.nodes.sparkSession.createDataFrame([tuple(str(v) for v in self.spec.values()) or ("",)], list(self.spec) or ["name"])

    def get_statistics(self) -> DataFrame:
        return A.statistics(self.nodes, self.relations)

    def set_node_coverage_status(self, node_id: str, status: str, notes: str = "", implemented_in: str = "") -> DataFrame:
        """Set a node's coverage in this catalogue; export.set_coverage() keeps it."""
        if status not in STATUSES:
            raise ValueError(f"INVALID_STATUS: {status}")
        if self.get_node_by_id(node_id).isEmpty():
            raise LookupError(f"NOT_FOUND: {node_id}")
        self.nodes = update_coverage(self.nodes, node_id, status, notes, implemented_in)
        return self.get_node_coverage_status(node_id)

    def list_features(self) -> DataFrame:
        return self.get_nodes_by_type("FEATURE")

    def list_hd_sequences(self) -> DataFrame:
        return self.get_nodes_by_type("HD_SEQUENCE")

    def list_all_types(self) -> DataFrame:
        return self.nodes.groupBy("type").agg(F.count(F.lit(1)).alias("count"), F.min("ord").alias("first")).orderBy("first").drop("first")

    def search_nodes(self, query: str, node_type: str | None = None, limit: int = 20) -> DataFrame:
        nodes = self.nodes if node_type is None else self.nodes.where(F.col("type") == node_type.upper())
        return G.search_nodes(nodes, query, limit).drop("score")

    def search_by_keywords(self, keywords: list[str] | str, node_types: list[str] | None = None) -> DataFrame:
        wanted = keywords.split(",") if isinstance(keywords, str) else keywords
        kinds = [k.upper() for k in node_types or []]
        if bad := [k for k in kinds if k not in SEARCHED_TYPES]:
            raise ValueError(f"INVALID_PARAM: no node type {bad[0]}")
        nodes = self.nodes.where(F.col("type").isin(kinds)) if kinds else self.nodes
        return G.search_keywords(nodes, [w.strip() for w in wanted if w.strip()]).select("id", "type", "name", "matched", "score")

    def get_relations_from(self, node_id: str, relation_type: str | None = None) -> DataFrame:
        return self._edges("source_node", node_id, relation_type)

    def get_relations_to(self, node_id: str, relation_type: str | None = None) -> DataFrame:
        return self._edges("target_node", node_id, relation_type)

    def _edges(self, end: str, node_id: str, relation_type: str | None) -> DataFrame:
        edges = self.relations.where(F.col(end) == node_id)
        return (edges if relation_type is None else edges.where(F.col("type") == relation_type.upper())).orderBy("ord")

    def get_tables_for_register(self, register_id: str) -> DataFrame:
        return G.neighbours(self.relations, self.nodes, register_id, True, "TABLE")

    def get_figures_for_register(self, register_id: str) -> DataFrame:
        return G.neighbours(self.relations, self.nodes, register_id, True, "FIGURE")

    def get_chunks_for_register(self, register_id: str) -> DataFrame:
        return G.neighbours(self.relations, self.nodes, register_id, True, "SPEC_CHUNK")

    def get_registers_for_table(self, table_id: str) -> DataFrame:
        return G.neighbours(self.relations, self.nodes, table_id, False, "REGISTER")

    def get_chunks_referencing(self, node_id: str) -> DataFrame:
        kind = [r["type"] for r in G.by_id(self.nodes, node_id).select("type").collect()]
        if not kind:
            raise LookupError(f"NOT_FOUND: {node_id}")
        if kind[0] not in ("TABLE", "FIGURE"):
            raise ValueError(f"INVALID_TYPE: {node_id} is a {kind[0]}")
        return G.neighbours(self.relations, self.nodes, node_id, True, "SPEC_CHUNK")

    def get_referenced_by(self, node_id: str) -> DataFrame:
        """Nodes of any type with a REFERENCES edge to a node, in edge order."""
        edges = self.relations.where((F.col("target_node") == node_id) & (F.col("type") == "REFERENCES")).select(F.col("source_node").alias("id"), F.col("ord").alias("edge"))
        return edges.join(self.nodes, "id").orderBy("edge").drop("edge")

    def get_node_coverage_status(self, node_id: str) -> DataFrame:
        return G.by_id(self.nodes, node_id).select("coverage.*")

    def list_nodes_by_coverage(self, status: str, node_type: str | None = None) -> DataFrame:
        found = self.nodes.where(F.col("coverage.status") == status)
        return (found if node_type is None else found.where(F.col("type") == node_type)).orderBy("ord").select("id", "type", "name")

    def get_coverage_summary(self) -> DataFrame:
        return self.nodes.groupBy("type", F.coalesce("coverage.status", F.lit("NOT_IMPLEMENTED")).alias("status")).count().orderBy("type", "status")

    def get_chunks_for_section(self, section_id: str) -> DataFrame:
        tail = F.substring_index("id", "_C", -1)
        return self.nodes.where(F.startswith("id", F.lit(section_id + "_C")) & tail.rlike(r"^\d+$")).orderBy(tail.try_cast("int"))

    def get_register_map(self) -> DataFrame:
        found = self.nodes.where("type = 'REGISTER'").withColumn("offset_hex", F.col("extras")["offset_hex"])
        return found.orderBy(C.offset_int(F.col("offset_hex")), "ord").select("id", "name", "offset_hex")

    def get_page_content(self, page: int) -> DataFrame:
        here = self.nodes.where(F.col("source.page") == page).select("id", "type", "ord", F.lit(page).alias("page"), F.col("extras")["full_text"].alias("full_text"))
        return E.page_content(here)

    def get_feature_tree(self) -> DataFrame:
        """Features without a parent, each with its direct children in order."""
        f = self._features().select("id", "name", "ord", F.coalesce("parent_id", F.lit("")).alias("parent"))
        kids = f.where("parent <> ''").groupBy(F.col("parent").alias("id")).agg(F.array_sort(F.collect_list(F.struct("ord", "id"))).alias("k"))
        ids = F.coalesce(F.transform("k", lambda x: x["id"]), F.array().cast("array<string>"))
        return f.where("parent = ''").join(kids, "id", "left").orderBy("ord").select("id", "name", ids.alias("children"))

    def validate(self) -> DataFrame:
        return A.check_graph(self.nodes, self.relations)
