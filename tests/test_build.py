"""A synthetic book from pages to a graph that is checked, written and read back, field by field."""

import pytest
from pyspark.sql import functions as F

from ashlar.operators import assemble as A
from ashlar.operators import discover as D
from ashlar.plans import build as B
from ashlar.plans.catalog import GraphCatalog
from ashlar.sources import config as K
from ashlar.sources import export

RULES = {"registers": ["field_name_length", "missing_bits", "zero_fields"], "tables": ["empty_csv", "single_row"], "figures": ["empty_plantuml", "no_startuml"]}


def settings(off=()):
    rules = lambda part: [{"check": k, "max_chars": 3} if k == "field_name_length" else {"check": k, "severity": "error" if k == "zero_fields" else "warning"} for k in RULES[part]]
    return K.Config({"spec": {"page_offset": 10}, "validation": {"enabled": True, "checks": {k: {"enabled": k not in off, "rules": rules(k)} for k in RULES}}})


@pytest.fixture(scope="module")
def parts(spark):
    item = "id string, ord int, title string, abstract string, spec_reference string, spec_page int, definition_page int, status string"
    tables = spark.createDataFrame([("TABLE_1_1", 0, "Block Register", "bits", "1-1", 2, 12, "COMPLETED"), ("TABLE_1_2", 1, None, None, "1-2", None, None, None)], item).withColumn("csv_file", F.lit("a.csv"))
    figures = spark.createDataFrame([("FIG_1_1", 0, "State machine", "flow", "1-1", 3, 13, "COMPLETED")], item).withColumn("diagram_file", F.lit("a.puml"))
    pages = spark.createDataFrame([(1, "Overview. See Table 1-1 and Figure 1-1."), (2, "Detail of Table 1-1.\n\nMore: Table 9-9 is not there."), (3, "End")], "page int, text string")
    sections = spark.createDataFrame([(1, "1", "One", 0), (2, "1.1", "One one", 1), (3, "1.2.1", "Deep", 2)], "start int, section string, title string, ord int")
    chunks = D.chunks_of(pages, sections, 4).withColumns({"ord": F.col("page").cast("long") * 1000 + F.col("chunk_index"), "abstract": F.lit("short"), "keywords": F.array(F.lit("k"))})
    config = spark.createDataFrame([("004h", "Block Register", 0, "TABLE_1_1"), ("104h", "Empty Register", 1, None)], "offset string, name string, ord long, table_id string")
    classes = spark.createDataFrame([("C1", 0, 255, 0)], "class_id string, start_int long, end_int long, ord int")
    cells = spark.createDataFrame([("TABLE_1_1", 0, ["Bits", "Name"]), ("TABLE_1_1", 1, ["7:4", "MODE"]), ("TABLE_1_1", 2, ["3", "GO"])], "name string, row_no int, cells array<string>")
    found = D.registers_of(config, tables.select(F.col("id").alias("table_id"), "title", "ord"), classes, cells)
    registers = found.withColumns({"spec_section": F.when(F.col("class_id").isNotNull(), F.lit("1.1")), "page": F.lit(2), "definition_page": F.lit(12)})
    named = spark.createDataFrame([("C1", 0, "Host", "000h", "0FFh", {"3.00": "Yes"})], "id string, ord int, name string, address_start string, address_end string, version_support map<string,string>")
    feature = "id string, ord int, name string, description string, priority string, parent_id string, groups array<string>, figures array<string>, tables array<string>, registers array<string>, spec_sections array<string>"
    features = spark.createDataFrame([("F1", 0, "DMA", "moves", None, None, ["g"], [], ["TABLE_1_1"], [], []), ("F2", 1, "ADMA", "more", "P1", "F1", None, None, None, None, None)], feature)
    return B.Parts(tables=tables, figures=figures, chunks=chunks, registers=registers, classes=named, features=features)


def test_graph_of_all_parts_written_and_read_back(spark, parts, tmp_path):
    nodes, relations = B.graph(parts, settings())
    held = nodes.orderBy("ord").collect()
    ids = [r["id"] for r in held]
    chunks = [r["id"] for r in parts.chunks.orderBy("ord").collect()]
    assert ids == ["TABLE_1_1", "TABLE_1_2", "FIG_1_1", *chunks, "REG_004", "REG_104", "C1", "F1", "F2"] and [r["ord"] for r in held] == list(range(len(ids)))
    first = {r["section_number"]: r["id"] for r in parts.chunks.where("chunk_index = 0 OR chunk_index = 1").orderBy(F.desc("chunk_index")).collect()}
    assert held[ids.index(first["1.1"])]["source"]["pdf_page"] == 12 and held[0]["extras"]["csv_file"] == "a.csv"
    got = [(r["id"], r["type"], r["source_node"], r["target_node"]) for r in relations.orderBy("ord").collect()]
    text = {r["id"]: r["full_text"] for r in parts.chunks.collect()}
    refs = [(c, t) for c in chunks for t, words in (("TABLE_1_1", "Table 1-1"), ("FIG_1_1", "Figure 1-1")) if words in text[c]]
    described = sorted((r["id"], "REG_004") for r in parts.chunks.where("section_number = '1.1'").collect())
    assert got == [
        ("REL_CHILD_1_1", "CHILD_OF", first["1.1"], first["1"]), ("REL_BELONGS_001", "BELONGS_TO", "REG_004", "C1"), ("REL_DEFINED_002", "DEFINED_BY", "REG_004", "TABLE_1_1"),
        *[(f"REL_DESC_{i:04d}", "DESCRIBES", *x) for i, x in enumerate(described, 1)], ("REL_PART_OF_001", "PART_OF", "F2", "F1"), *[(f"REL_REF_{i:04d}", "REFERENCES", *x) for i, x in enumerate(refs, 1)],
    ]
    assert len(refs) >= 3
    path = B.save(nodes, relations, str(tmp_path / "g"))
    again = B.load(spark, str(tmp_path / "g"))
    read = export.read_document(spark, path)
    for i, expected in enumerate((nodes, relations)):
        plain = sorted(str(r.asDict(True)) for r in expected.collect())
        assert sorted(str(r.asDict(True)) for r in again[i].select(expected.columns).collect()) == plain
        assert sorted(str(r.asDict(True)) for r in read[i].select(expected.columns).collect()) == plain
    assert GraphCatalog(*again).call("get_node_by_id", node_id="FIG_1_1")["success"]
    assert A.check_graph(*again).where("severity = 'error'").isEmpty()


def test_checks_as_configured(spark, parts):
    texts = spark.createDataFrame([("T1", ""), ("T2", "just one line"), ("T3", "two lines\nof it"), ("T4", None)], "name string, content string")
    drawn = spark.createDataFrame([("D1", "x"), ("D2", "some words here"), ("D3", "@STARTUML\na\n@enduml")], "name string, content string")
    every = {("registers", "REG_004_F0", "field_name_length", "error"), ("registers", "REG_104", "zero_fields", "error"), ("tables", "T1", "empty_csv", "warning"), ("tables", "T4", "empty_csv", "warning"), ("tables", "T2", "single_row", "warning"), ("figures", "D1", "empty_plantuml", "warning"), ("figures", "D2", "no_startuml", "warning")}
    for off in ((), ("registers",), ("tables", "figures"), tuple(RULES)):
        got = B.configured_checks(settings(off), parts, texts, drawn).select("part", "node_id", "check", "severity").collect()
        assert {tuple(r) for r in got} == {x for x in every if x[0] not in off} and len(got) == len(set(map(tuple, got)))


def test_part_of_the_parts(spark, parts):
    nodes, relations = B.graph(B.Parts(tables=parts.tables), settings())
    assert nodes.count() == 2 and relations.count() == 0 and relations.columns == ["id", "type", "source_node", "target_node", "description", "bidirectional", "ord"]
    assert B.configured_checks(K.Config({}), parts).count() == 0
