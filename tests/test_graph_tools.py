"""Catalogue with files, sinks, configuration, pages, enrichment and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from ashlar import cli
from ashlar.functions import columns as C
from ashlar.operators import assemble as A
from ashlar.operators import discover as D
from ashlar.operators import enrich as N
from ashlar.plans.catalog import GraphCatalog
from ashlar.sources import config, export, pages
from ashlar.sources import graph as S
from ashlar.streaming import ingest

FIELDS = [{"id": f"REG_028_F{i}", "name": n, "bits": b, "bit_high": h, "bit_low": w, "width": h - w + 1, "access": a, "raw": r} for i, (n, b, h, w, a, r) in enumerate([("Mode", "7:4", 7, 4, "read-write", "selects the mode"), ("Busy", "3", 3, 3, "read-only", "set while busy")])]
NODES = [
    {"id": "REG_028", "type": "REGISTER", "name": "Host Control", "index_keywords": ["host"], "extras": {"offset_hex": "028h", "class_id": "REGCLASS_1", "spec_section": "2.1", "fields": FIELDS}},
    {"id": "REG_004", "type": "REGISTER", "name": "Block Size", "index_keywords": ["block"], "extras": {"offset_hex": "0x004", "class_id": "REGCLASS_1"}},
    {"id": "REGCLASS_1", "type": "REG_CLASS", "name": "Host", "index_keywords": ["class"]},
    {"id": "TABLE_2_5", "type": "TABLE", "name": "Fields", "index_keywords": ["x"], "source": {"page": 7, "spec_reference": "Table 2-5"}, "extras": {"table_type": "REGISTER_FIELDS", "csv_file": "csv\\TABLE_2_5.csv"}},
    {"id": "SEC_2_1_C0", "type": "SPEC_CHUNK", "name": "c", "index_keywords": ["y"], "source": {"page": 7}, "extras": {"section_number": "2.1", "section_title": "Overview", "chunk_index": 0, "full_text": "The DMA engine, see Table 2-5."}},
    {"id": "F_1", "type": "FEATURE", "name": "DMA", "index_keywords": ["z"], "extras": {"groups": ["Core"], "registers": ["REG_004", "REG_X", "REG_028"], "not_implemented_in_linux_driver": "true"}},
]
RELATIONS = [{"id": "REL_1", "type": "REFERENCES", "source_node": "SEC_2_1_C0", "target_node": "TABLE_2_5"}, {"id": "REL_2", "type": "DESCRIBES", "source_node": "TABLE_2_5", "target_node": "REG_028"}]


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    at = tmp_path_factory.mktemp("doc") / "graph.json"
    at.write_text(json.dumps({"metadata_version": "1", "nodes": NODES, "relations": RELATIONS}))
    return str(at)


def test_catalogue(spark, path):
    texts = spark.createDataFrame([("TABLE_2_5", "a,b\n1,2")], "name string, content string")
    c = GraphCatalog(*S.read_graph(spark, path), texts, {"name": "Host", "version": "3.00"})
    ids = lambda f, **p: [r["id"] for r in c.call(f, **p)["results"]]
    assert ids("get_register_by_offset", offset="28H") == ["REG_028"] and "004h to 028h" in c.call("get_register_by_offset", offset="ff")["error"]
    assert ids("get_register_by_name", name="size") == ["REG_004"] and c.call("get_register_by_name", name="size", exact=True)["error"].startswith("NOT_FOUND")
    assert ids("list_registers", class_id="REGCLASS_1") == ["REG_004", "REG_028"] and c.call("list_registers", class_id="none")["error"].startswith("NOT_FOUND")
    assert ids("get_field_by_bit", register_id="REG_028", bit=5) == ["REG_028_F0"] and ids("get_field_by_name", register_id="REG_028", field_name="BUS") == ["REG_028_F1"]
    assert c.call("get_field_by_bit", register_id="TABLE_2_5", bit=5)["error"].startswith("INVALID_TYPE")
    assert c.call("list_fields_in_register", register_id="REG_028")["results"][0] == {"id": "REG_028_F0", "name": "Mode", "bits": "7:4", "width": 4, "access": "read-write"}
    assert ids("search_fields_by_access", access="read-only") == ["REG_028_F1"] and c.call("search_fields_by_access", access="no")["error"].startswith("INVALID_PARAM")
    assert c.call("search_fields_by_text", query="the mode")["results"][0]["excerpt"] == "selects the mode "
    assert c.call("get_register_class_by_id", class_id="REGCLASS_1")["results"][0]["member_count"] == 2
    one = c.call("get_section_by_number", section_number="2.1")
    assert one["count"] == 1 and one["results"]["title"] == "Overview" and one["results"]["chunk_ids"] == ["SEC_2_1_C0"]
    assert c.call("list_sections", parent="2")["results"][0]["chunk_count"] == 1
    assert ids("get_table_by_reference", reference="table 2-5") == ["TABLE_2_5"] and c.call("list_tables", table_type="BAD")["error"].startswith("INVALID_PARAM")
    assert c.call("get_table_csv", table_id="TABLE_2_5")["results"][0]["content"] == "a,b\n1,2" and c.call("get_figure_plantuml", figure_id="TABLE_2_5")["error"].startswith("INVALID_TYPE")
    assert ids("get_feature_registers", feature_id="F_1") == ["REG_004", "REG_028"] and ids("list_features_not_implemented_in_driver") == ["F_1"]
    assert ids("get_chunks_referencing", node_id="TABLE_2_5") == ["SEC_2_1_C0"] and ids("get_referenced_by", node_id="TABLE_2_5") == ["SEC_2_1_C0"]
    assert ids("get_chunks_for_section", section_id="SEC_2_1") == ["SEC_2_1_C0"] and c.call("get_spec_info")["results"]["version"] == "3.00"
    assert {r["what"]: r["count"] for r in c.call("get_statistics")["results"] if r["type"] == "ALL"} == {"nodes": 6, "relations": 2}
    assert c.call("set_node_coverage_status", node_id="F_1", status="PARTIAL")["results"][0]["status"] == "PARTIAL" and c.call("set_node_coverage_status", node_id="F_1", status="X")["error"].startswith("INVALID_STATUS")
    assert c.call("search_by_keywords", keywords="host", node_types=["BAD"])["error"].startswith("INVALID_PARAM") and c.call("get_node_by_id")["error"].startswith("INVALID_PARAM")


def test_cut_off_at_the_most_results(spark):
    nodes = spark.range(1200).select(F.concat(F.lit("N"), "id").alias("id"), F.lit("TABLE").alias("type"), F.col("id").alias("ord"))
    found = GraphCatalog(nodes, None).call("get_nodes_by_type", node_type="table")
    assert found["count"] == 1000 and found["truncated"]


def test_graph_is_written_and_read_back(spark, path, tmp_path):
    nodes, relations = S.read_graph(spark, path)
    wrote = export.write_document(nodes, relations, str(tmp_path / "out"))
    whole = json.loads("\n".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*"))))
    assert [n["id"] for n in whole["nodes"]] == [n["id"] for n in NODES] and len(whole["relations"]) == 2
    again, edges = export.read_document(spark, wrote)
    place = lambda df: [r.asDict(True) for r in df.orderBy("ord").drop("ord").collect()]
    assert place(again) == place(nodes) and place(edges) == place(relations)
    assert [r["ord"] for r in again.orderBy("ord").collect()] == list(range(nodes.count())) and GraphCatalog(again, edges).call("get_nodes_by_type", node_type="TABLE")["count"] == 1
    odd = spark.createDataFrame([(None, "TABLE", 0), ("x", None, 1), (None, None, 2)], "id string, type string, ord long")
    loose = spark.createDataFrame([(None, "b", 0), ("a", None, 1)], "source_node string, target_node string, ord long")
    odd, edges = export.read_document(spark, export.write_document(odd, loose, str(tmp_path / "odd")))
    assert [(r["id"], r["type"]) for r in odd.orderBy("ord").collect()] == [(None, "TABLE"), ("x", None), (None, None)]
    assert [(r["source_node"], r["target_node"]) for r in edges.orderBy("ord").collect()] == [(None, "b"), ("a", None)]
    assert json.loads(again.where("id = 'REG_028'").first()["extras"]["fields"])[0]["name"] == "Mode"
    export.write_single(nodes, relations, str(tmp_path / "single"))
    assert S.read_graph(spark, str(tmp_path / "single"))[0].count() == 6
    root = str(tmp_path / "graph")
    export.publish(nodes, root)
    export.set_coverage(spark, root, "F_1", "IMPLEMENTED", "done")
    assert export.current(spark, root).where("coverage.status = 'IMPLEMENTED'").count() == 1
    with pytest.raises(LookupError):
        export.set_coverage(spark, root, "none", "PARTIAL")


def test_texts_reports_and_files(spark, tmp_path):
    texts = spark.createDataFrame([("T1", "a,b\n1,2"), ("T2", None)], "name string, content string")
    at = export.write_texts(texts, str(tmp_path / "csv"))
    assert {(r["name"], r["content"]) for r in export.read_entity_texts(spark, at).collect()} == {("T1", "a,b\n1,2"), ("T2", "")}
    assert export.files(spark, at).where("length > 0").count() >= 1 and export.files(spark, str(tmp_path / "none")).count() == 0
    items = spark.createDataFrame([("A", "COMPLETED", None), ("B", "FAILED", "no rows")], "id string, status string, error string")
    assert [r["text"] for r in export.failed_items(items, "Tables").collect()] == ["# Tables that are not complete", "- B: FAILED (no rows)"]
    found = spark.createDataFrame([("n", "orphan", "warning"), ("m", "missing_name", "error")], "node_id string, check string, severity string")
    assert A.severity_split(found).first().asDict() == {"total": 2, "errors": 1, "warnings": 1}
    assert [r["text"] for r in A.report(found, "Issues").collect()][1].startswith("- **error** `m`")


CONFIG = {
    "spec": {"page_offset": 11},
    "node_types": {"TABLE": {"enabled": True, "classification_rules": [{"pattern": "timing", "type": "TIMING"}, {"pattern": ".*", "type": "OTHER"}]}},
    "toc": {"tables": {"pages": [3], "pattern": r"^Table\s+(\d+)[-.](\d+)\s*:?\s*(.+?)\s*\.{3,}\s*(\d+)", "id_format": "TABLE_{chapter}_{seq}"}},
    "domain": {
        "registers": {
            "classes": [{"id": "C1", "name": "Host", "address_start": "000h", "address_end": "0FFh"}, {"id": "C2", "name": "Slot", "address_start": "100h", "address_end": "1FFh"}],
            "register_offsets": {"004h": {"section": "2.1", "name": "Block Register", "table": "T9"}, "104h": {"name": "Slot Status Register"}},
            "exclude_tables": ["T1"],
        },
        "features": {"definitions": [{"id": "F", "name": "DMA", "groups": ["a"], "parent": None}, {"id": "G", "name": "ADMA", "parent": "F"}], "hd_sequences": [{"id": "H", "name": "Start", "primary_section": "4.2"}]},
    },
    "extraction": {"tables": {"multi_page": {"enabled": True, "max_pages_before": 2}, "hints": [{"name": "r", "match_title": "register", "expected_columns": [{"role": "bit_range", "names": ["Slice"]}, {"role": "field_name", "names": ["Label"]}]}]}},
    "validation": {"enabled": True, "checks": {"registers": {"enabled": True, "rules": [{"check": "field_name_length", "max_chars": 12}, {"check": "missing_bits", "severity": "warning"}, {"check": "zero_fields", "severity": "error"}]}, "tables": {"enabled": False, "rules": [{"check": "empty_csv"}]}}},
}


def test_configuration(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(CONFIG))
    c = config.load(spark, str(tmp_path / "c.json"))
    assert c.page_offset == 11 and c.rules("TABLE") == [("timing", "TIMING"), (".*", "OTHER")] and c.enabled("TABLE") and not c.enabled("FIGURE")
    assert c.hint_columns("A Register") == {"bits": ["Slice"], "name": ["Label"]} and c.hint("x") is None
    assert [tuple(r) for r in c.hints(spark).collect()] == [("register", [("bits", ["Slice"]), ("name", ["Label"])], 0)]
    assert [(r["id"], r["address_end"]) for r in c.classes(spark).orderBy("ord").collect()] == [("C1", "0FFh"), ("C2", "1FFh")]
    assert [tuple(r) for r in c.offsets(spark).orderBy("ord").collect()] == [("004h", "Block Register", "T9", "2.1", 0), ("104h", "Slot Status Register", None, "", 1)]
    assert [(r["id"], r["parent_id"], r["groups"]) for r in c.features(spark).orderBy("ord").collect()] == [("F", None, ["a"]), ("G", "F", None)]
    assert c.sequences(spark).first()["primary_section"] == "4.2" and c.exclude_tables == ["T1"] and c.multi_page() == {"enabled": True, "max_pages_before": 2, "max_pages_after": 0} and not c.multi_page("figures")["enabled"]
    assert c.validation_rules("registers") == {"field_name_length": {"severity": "error", "max_chars": 12}, "missing_bits": {"severity": "warning"}, "zero_fields": {"severity": "error"}} and c.validation_rules("tables") == {}
    toc = c.toc("tables")
    text = "Tables\n  x\nTable 2-5 : Block Size ..... 17\nTABLE 3-1 Other ..... 20"
    found = D.contents_by(spark.createDataFrame([(3, text)], "page int, text string"), toc["pattern"], toc["id_format"], 4)
    assert sorted((r["id"], r["title"], r["page"]) for r in found.collect()) == [("TABLE_2_5", "Block Size", 17), ("TABLE_3_1", "Other", 20)]
    (tmp_path / "bad.json").write_text("{}")
    with pytest.raises(ValueError, match="node_types"):
        config.load(spark, str(tmp_path / "bad.json"))
    with pytest.raises(FileNotFoundError):
        config.load(spark, str(tmp_path / "gone.json"))
    assert config.load(spark, str(tmp_path / "gone.json"), defaults={"a": 1}).get("a") == 1
    (tmp_path / ".keys").write_text('# x\nexport MY_TEST_KEY="abc"\n')
    assert config.env_value(spark, str(tmp_path / ".keys"), "MY_TEST_KEY") == "abc"


def test_pages_and_enrichment(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ftwo")
    (tmp_path / "b.txt").write_text("")
    read = pages.read_pages(spark, str(tmp_path))
    assert sorted(map(tuple, read.collect())) == [("a.txt", 1, "one"), ("a.txt", 2, "two")]
    wanted = spark.createDataFrame([("a.txt", 2), ("a.txt", 9)], "book string, page int")
    assert {r["page"]: r["text"] for r in pages.page_text(read, wanted).collect()} == {2: "two", 9: ""}

    def ask(prompt, attempt):
        if "bad" in prompt:
            raise RuntimeError("no answer")
        return "ok " + prompt if attempt or "not accepted" in prompt else ""

    rows = spark.createDataFrame([(1, "good", "x"), (2, "bad", "y"), (3, None, "z")], "id int, answer_of string, row string")
    got = {r["id"]: r for r in N.with_fallback(N.enriched(rows, F.col("answer_of"), ask), F.lit("none")).collect()}
    assert got[1]["attempts"] == 2 and got[1]["abstract"].startswith("ok good") and got[2]["answer"] is None and got[2]["abstract"] == "none" and "no answer" in got[2]["error"] and got[3]["row"] == "z"
    assert N.model_for(5, ("small", "large")) == "large" and N.stub("a\nb") == "b"
    replies = spark.createDataFrame([('{"score": 80, "valid": true}',), ('{"score": 60, "valid": true}',), ("x",)], "r string")
    assert [r[0] for r in replies.select(N.passed(F.col("r"))).collect()] == [True, False, False]


def test_command_line(spark, path):
    said = []
    assert cli.run(spark, [path, "get_node_by_id", "node_id=F_1"], said.append) == 0 and json.loads(said[-1])["results"][0]["name"] == "DMA"
    assert cli.run(spark, [path, "get_node_by_id", "node_id=none"], said.append) == 1
    assert cli.run(spark, [path, "search_by_keywords", "keywords=[host, block]"], said.append) == 0
    assert cli.run(spark, [path, "functions"], said.append) == 0 and "get_register_map" in said[-1]
    assert cli.run(spark, [path, "get_node_by_id", "x"], said.append) == 1 and cli.run(spark, [], said.append) == 1
    assert cli.value("TRUE") is True and cli.value("-3") == -3 and cli.value("a-3") == "a-3"


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()[0]
    assert one(C.section_id(F.lit("Appendix_A"))) == "SEC_A" and one(C.section_number(F.lit("SEC_2_1"))) == "2.1"
    assert one(C.section_references(F.lit("see section 2.1.3 and Section 4"))) == ["2.1.3", "4"]
    assert one(C.clean_text(F.lit("a\n\n\n\nb   c\nCopyright 2009 X"), ("copyright",))) == "a\n\nb c" and one(C.cap_words(F.lit("a b c"), 2)) == "a b ... [truncated]"
    assert one(C.fenced_block(F.lit("x\n```csv\na,b\n```\ny"), "csv")) == "a,b" and one(C.labelled_line(F.lit("t\nABSTRACT: it is"))) == "it is"
    assert one(C.is_section_number(F.lit("A.1"))) and not one(C.is_section_number(F.lit("x")))
    assert [one(C.duration(F.lit(s))) for s in (42, 185, 3720)] == ["42.0s", "3m 05s", "1h 02m"]
    assert one(C.mentions_enough(F.lit("bit field of reg"), ["bit", "reg", "x"])) and one(C.pdf_page(F.lit(3), 11)) == 14
    items = spark.createDataFrame([("a",), ("b",)], "id string")
    assert [r["id"] for r in ingest.skip_existing(items, spark.createDataFrame([("a", "COMPLETED"), ("b", "FAILED")], "id string, status string"), "id").collect()] == ["b"]
