"""Graph operators against plain Python, and registered queries against DuckDB."""

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ashlar.functions import columns as C
from ashlar.operators import extract as E
from ashlar.operators import graph as G
from ashlar.plans import graph_queries  # noqa: F401  registers its queries
from ashlar.plans import queries as Q
from ashlar.plans.catalog import GraphCatalog
from ashlar.sources import graph as S
from ashlar.streaming import ingest

TABLES = "region nation customer supplier part orders lineitem events documents conversations".split()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query_equals_sql(spark, sf_dir, oracle, name):
    df = Q.QUERIES[name](spark, sf_dir)
    got = oracle.execute(Q.SQL[name])
    columns = [d[0] for d in got.description]
    assert set(columns) == set(df.columns)
    assert sorted(map(str, got.fetchall())) == sorted(str(tuple(r[c] for c in columns)) for r in df.collect())


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "x string").select(build(F.col("x")).alias("y")).first()["y"]


def test_scalars(spark):
    assert [one(spark, x, C.norm_offset) for x in ("0x28", "28h", "", "1234h", " 0x0fC ")] == ["028", "028", "000", "1234", "0FC"]
    assert one(spark, "zz", C.offset_int) is None and one(spark, "0x10", C.offset_int) == 16
    assert [one(spark, x, C.parent_section) for x in ("2.2.10", "A.1", "C.3.2", "7")] == ["2.2", "Appendix_A", "Appendix_C", None]
    assert one(spark, "2.10.x", C.section_key) == [2, 10, 0]
    assert one(spark, "A.1", C.appendix_key)[:3] == [1000, 65, 1] and len(one(spark, "2.1", C.appendix_key)) == 10
    ranges = [tuple(one(spark, x, C.bit_range)) for x in ("07-04", "7:4", "[127:120]", "15", "x")]
    assert ranges == [(7, 4, 4), (7, 4, 4), (127, 120, 8), (15, 15, 1), (0, 0, 0)]
    assert [one(spark, x, C.access) for x in ("R/W", "roc", "Rsvd", "odd")] == ["read-write", "read-only-clear", "reserved", "odd"]
    assert one(spark, "see Table 2-5, table 12-1 and Table 2-5", C.references) == ["TABLE_2_5", "TABLE_12_1", "TABLE_2_5"]
    assert one(spark, "Table 7 here", lambda c: C.references(c, single=True)) == ["TABLE_7"]
    assert one(spark, "Block Size Register (Offset 004h)", C.register_of_title).asDict() == {"name": "Block Size", "offset": "004"}
    assert one(spark, "```csv\na,b\n```", C.strip_fences) == "a,b"
    assert one(spark, "x" * 130, C.ellipsis) == "x" * 117 + "..."
    assert one(spark, "the DMA engine moves data and the dma", C.keywords) == ["dma", "engine", "moves", "data"]
    text = "a" * 80 + "Needle" + "b" * 80
    assert one(spark, text, lambda c: C.excerpt(c, "needle", 50)) == "..." + "a" * 50 + "Needle" + "b" * 50 + "..."


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    nodes = [{"id": f"REG_{i}", "type": "REGISTER", "name": f"Reg {i}", "description": "dma control", "index_keywords": ["DMA", "ctl"], "coverage": {"status": "PARTIAL"}} for i in range(3)]
    nodes += [{"_comment": "skip"}, {"id": "TABLE_1", "type": "TABLE", "name": "Fields", "index_keywords": []}, {"id": "REG_0", "type": "REGISTER", "name": "Again", "index_keywords": ["x"]}]
    relations = [{"id": "R1", "type": "DESCRIBES", "source_node": "TABLE_1", "target_node": "REG_1"}, {"id": "R2", "type": "REFERENCES", "source_node": "GONE", "target_node": "REG_1"}]
    path = tmp_path_factory.mktemp("graph") / "metadata.json"
    path.write_text(json.dumps({"metadata_version": "2", "nodes": nodes, "relations": relations}, indent=1))
    return GraphCatalog(*S.read_graph(spark, str(path)))


def test_catalog(catalog):
    assert catalog.call("get_node_by_id", node_id="REG_0")["results"][0]["name"] == "Again"
    assert catalog.call("get_node_by_id", node_id="none")["error"].startswith("NOT_FOUND")
    assert catalog.call("get_register_by_id", register_id="TABLE_1")["error"].startswith("INVALID_TYPE")
    assert catalog.call("get_nodes_by_type", node_type="register")["count"] == 4
    assert catalog.call("get_tables_for_register", register_id="REG_1")["results"] == [{"id": "TABLE_1"}]
    assert catalog.call("search_by_keywords", keywords=["dma", "none"])["results"][0]["score"] == 0.5
    assert catalog.call("search_nodes", query="again dma", limit=2)["count"] == 2
    assert catalog.call("search_nodes", query="x", limit=-1)["error"].startswith("INVALID_PARAM")
    assert {r["check"] for r in catalog.call("validate")["results"]} == {"duplicate_id", "dangling_source", "no_keywords", "orphan"}
    assert S.update_coverage(catalog.nodes, "REG_1", "IMPLEMENTED").where("coverage.status = 'IMPLEMENTED'").count() == 1
    assert catalog.call("nothing")["success"] is False


def test_search_nodes_like_python(spark):
    rng = random.Random(4)
    vocabulary = "dma Block size reg bit offset table host a".split()
    rows = [(f"N{i}", " ".join(rng.choices(vocabulary, k=2)), " ".join(rng.choices(vocabulary, k=4)), rng.choices(vocabulary, k=2), i) for i in range(60)]
    nodes = spark.createDataFrame(rows, "id string, name string, description string, index_keywords array<string>, ord long")
    for query in ("dma size", "BLOCK a a", "", "zzz"):
        terms = set(query.lower().split())
        scored = [(sum(t in f"{n} {d} {' '.join(k)}".lower() for t in terms), -o, i) for i, n, d, k, o in rows]
        want = [i for s, _, i in sorted(scored, key=lambda x: (-x[0], -x[1])) if s > 0][:20]
        assert [r["id"] for r in G.search_nodes(nodes, query).collect()] == want


def test_chunks_like_python(spark):
    rng = random.Random(5)
    pages = [(p, "\n\n".join(" ".join("w" for _ in range(rng.randrange(0, 9))) for _ in range(8))) for p in range(6)]
    got = G.chunk_paragraphs(spark.createDataFrame(pages, "page int, text string"), "text", 10).orderBy("page", "chunk_index").collect()
    want = []
    for page, text in pages:
        held, n = [], 0
        for part in [x.strip() for x in text.split("\n\n") if x.strip()]:
            if held and n + len(part.split()) > 10:
                want.append((page, "\n\n".join(held), n))
                held, n = [], 0
            held, n = [*held, part], n + len(part.split())
        if held:
            want.append((page, "\n\n".join(held), n))
    assert [(r["page"], r["chunk_text"], r["word_count"]) for r in got] == want


def test_sources_and_streaming(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "TABLE_1_1.csv").write_text('```csv\nBit,Name\n7,"multi\nline ""q"""\n\n3\n```\n')
    rows = S.csv_rows(S.read_texts(spark, str(tmp_path / "csv"))).orderBy("row_no").collect()
    assert [(r["name"], r["cells"]) for r in rows] == [("TABLE_1_1", ["Bit", "Name"]), ("TABLE_1_1", ["7", 'multi\nline "q"']), ("TABLE_1_1", ["3"])]
    landing, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    for i in range(2):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps({"id": i}))
        ingest.ingest_new(spark, landing, "id long", target, check)
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [0, 1]


def test_headers_and_contents(spark):
    text = "2.1 Overview of host\n2. Scope of this\n3.0 Zero Heading\nFigure 1\nA.1 Sample Code\nAppendix B (Normative) : Timing\n2.1 Overview Again\n4.2 Intro ..... 7"
    got = {(r["number"], r["title"], r["kind"]) for r in E.section_headers(spark.createDataFrame([(1, text), (2, None)], "page int, text string")).collect()}
    assert got == {("2.1", "Overview of host", "section"), ("2", "Scope of this", "chapter"), ("A.1", "Sample Code", "appendix_section"), ("Appendix_B", "Timing", "appendix")}
    pages = spark.createDataFrame([(1, "Table 2-1 : Registers. ..... 9\nTable 2-2: Bits .... 10\nFigure 1-1 : Host .... 3"), (2, "Table 2-1 : Again .... 99")], "page int, text string")
    assert sorted(map(tuple, E.contents(pages, "table").collect())) == [("2-1", "Registers", 9), ("2-2", "Bits", 10)]
    assert [tuple(r) for r in E.contents(pages, "figure").collect()] == [("1-1", "Host", 3)]


def test_fields_of_a_table(spark):
    assert E.column_map(["Bit", "Attrib", "Register Field Explanation"]) == {"bits": 0, "access": 1, "description": 2}
    assert E.column_map(["Location", "Attrib", "Register Field Explanation"]) == {"bits": 0, "access": 1, "description": 2}
    assert E.column_map(["Position", "R/W", "Signal Name", "Function"]) == {"bits": 0, "access": 1, "name": 2, "description": 3}
    assert E.column_map(["Slice", "Name"], {"bits": ["slice"]}) == {"bits": 0, "name": 1}
    cells = [["Bit", "Attrib", "Name", "Description"], ["", "", "", "orphan"], ["15-08", "RSVD", "Reserved"], ["07:04", "R/W", "Mode\nwhat it does", "first"], ["", "", "", "second"], ["3", "ROC", "Done"]]
    rows = spark.createDataFrame([("T", i, c) for i, c in enumerate(cells)], "name string, row_no int, cells array<string>")
    got = [tuple(r) for r in E.field_rows(rows, E.column_map(cells[0])).orderBy("ordinal").collect()]
    assert got == [("T_F01", "T", 1, "07:04", 7, 4, 4, "Mode", "read-write", "what it does first second"), ("T_F02", "T", 2, "3", 3, 3, 1, "Done", "read-only-clear", "")]
    assert {(r["node_id"], r["check"]) for r in E.validate_fields(spark.createDataFrame([("a", "x" * 81, "7", "RW"), ("b", "n", "", None)], "field_id string, name string, bits string, access string")).collect()} == {("a", "field_name_length"), ("b", "missing_bits"), ("b", "missing_access")}


def test_nodes_edges_and_parts(spark):
    rows = spark.createDataFrame([("TABLE_1", 3, "COMPLETED", 0, "DMA mode table"), ("TABLE_2", None, "PENDING", 1, None)], "id string, page int, status string, ord long, title string")
    title = F.col("title")
    nodes = E.build_nodes(rows, "TABLE", title, title, title)
    assert [(r["name"], r["confidence"], r["index_keywords"]) for r in nodes.orderBy("ord").collect()] == [("DMA mode table", 0.95, ["dma", "mode", "table", "DMA"]), ("TABLE_2", 0.7, [])]
    both = E.merge_parts([nodes, nodes.withColumn("extra", F.lit(1))])
    assert [(r["ord"]["part"], r["ord"]["at"], r["extra"]) for r in both.orderBy("ord").collect()] == [(0, 0, None), (0, 1, None), (1, 0, 1), (1, 1, 1)]
    edges = E.number_edges(spark.range(50).withColumn("k", -F.col("id")).drop("id"), "REL_REF_", ["k"]).orderBy("id").collect()
    assert [r["k"] for r in edges] == list(range(-49, 1)) and edges[0]["id"] == "REL_REF_0001"
    files = spark.createDataFrame([("e", ""), ("n", None), ("one", "a,b,c,d,e,f\n\n"), ("ok", "a,b,c,d\n1,2,3,4\n@StartUML")], "name string, content string")
    assert {(r["node_id"], r["check"]) for r in E.validate_tables(files).collect()} == {("e", "empty_csv"), ("n", "empty_csv"), ("one", "single_row")}
    assert {(r["node_id"], r["check"]) for r in E.validate_figures(files).collect()} == {("e", "empty_diagram"), ("n", "empty_diagram"), ("one", "no_start_mark")}


def test_table_pages(spark):
    definitions = spark.createDataFrame([("A", 10), ("B", 13), ("C", 30)], "id string, page int")
    continued = spark.createDataFrame([(p,) for p in (8, 9, 11, 12, 13, 14, 16, 31, 31)], "page int")
    got = {r["id"]: r["pages"] for r in E.table_pages(definitions, continued, 3).collect()}
    assert got == {"A": [8, 9, 10, 11, 12], "B": [11, 12, 13, 14], "C": [30, 31]}


def test_catalog_maps_pages_and_features(spark, tmp_path):
    nodes = [{"id": f"REG_{i}", "type": "REGISTER", "name": f"R{i}", "source": {"page": 2}, "extras": {"offset_hex": o}} for i, o in enumerate(("100h", "0x2C", "04h"))]
    nodes += [{"id": f"C{i}", "type": "SPEC_CHUNK", "name": "c", "source": {"page": 2}, "extras": {"full_text": t}} for i, t in enumerate(("one", "two"))]
    nodes += [{"id": i, "type": "FEATURE", "name": i, "extras": {"parent": p}} for i, p in (("F1", ""), ("F2", "F1"), ("F3", "F1"), ("F4", ""))]
    (tmp_path / "g.json").write_text(json.dumps({"nodes": nodes, "relations": []}))
    c = GraphCatalog(*S.read_graph(spark, str(tmp_path / "g.json")))
    assert [r["id"] for r in c.call("get_register_map")["results"]] == ["REG_2", "REG_1", "REG_0"]
    page = c.call("get_page_content", page=2)["results"][0]
    assert (page["chunks"], page["registers"], page["text"]) == (["C0", "C1"], ["REG_0", "REG_1", "REG_2"], "one\n\ntwo")
    assert [(r["id"], r["children"]) for r in c.call("get_feature_tree")["results"]] == [("F1", ["F2", "F3"]), ("F4", [])]
