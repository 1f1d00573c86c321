"""Column roles of many tables, layouts, version support, sections of several books, names of files, numbering."""

import random

from pyspark.sql import functions as F

from ashlar.operators import discover as D
from ashlar.operators import extract as E
from ashlar.operators import ranges as R
from ashlar.sources import graph as S

WORDS = ["Bit", "bits", "Location", "Attrib", "Type", "Field Name", " NAME ", "Signal Name (x)", "Description", "Bit description", "Function", "odd", "", "Access type", "Explanation of bits"]


def test_roles_of_every_heading(spark):
    draw = random.Random(1)
    heads = [(f"t{i}", 0, draw.sample(WORDS, draw.randint(0, 6))) for i in range(200)]
    rows = [*heads, *[(name, 1, ["x"]) for name, _, _ in heads], ("no heading", 1, ["Bits"])]
    cells = spark.createDataFrame(rows, "name string, row_no int, cells array<string>")
    hint = {"bits": ["odd"], "name": ["Function"]}
    hints = spark.createDataFrame([(f"t{i}", role, words) for i in range(0, 200, 2) for role, words in [*hint.items(), ("argument", ["Bit"])]], "table string, role string, words array<string>")
    got = {r["table"]: {k: r[k] for k in E.ROLES if r[k] is not None} for r in E.column_maps(cells, hints).collect()}
    assert got == {name: E.column_map(words, hint if int(name[1:]) % 2 == 0 else None) for name, _, words in heads}
    same = spark.createDataFrame([("a", 0, ["bits", "name", "bits"])], "name string, row_no int, cells array<string>")
    assert E.column_maps(same).first().asDict() == {"table": "a", "bits": 2, "access": None, "description": None, "name": 1}  # the last of equal headings
    assert E.column_maps(cells.where("false")).count() == 0


def test_first_hint_of_a_title(spark):
    tables = spark.createDataFrame([("a", "Host REGISTER"), ("b", "command register"), ("c", "other"), ("d", None)], "table_id string, title string")
    hints = spark.createDataFrame([("^command", [("bits", ["B"])], 0), (None, [("bits", ["N"])], 1), ("register", [("bits", ["R"]), ("name", ["N"])], 2)], "match_title string, columns array<struct<role:string,names:array<string>>>, ord long")
    assert sorted((r["table"], r["role"], r["words"][0]) for r in E.hints_of_tables(tables, hints).collect()) == [("a", "bits", "R"), ("a", "name", "N"), ("b", "bits", "B")]


def test_registers_of_tables_of_different_shapes(spark):
    cells = [("T1", 0, ["Location", "Attrib", "Field Name", "Description"]), ("T1", 1, ["7:4", "RW", "MODE", "what"]), ("T1", 2, ["", "", "", "more"]), ("T1", 3, ["3:0", "RO", "Reserved", ""]), ("T2", 0, ["Bits", "Function"]), ("T2", 1, ["15", "STAT\nof it"])]
    config = spark.createDataFrame([("004h", "Block Size Register", 0, None), ("104h", "Slot Register", 1, "T2"), ("204h", "Gone", 2, None)], "offset string, name string, ord long, table_id string")
    tables = spark.createDataFrame([("T1", "Block Size fields", 0), ("T2", "excluded", 1)], "table_id string, title string, ord int")
    classes = spark.createDataFrame([("C1", 0, 255, 0), ("C2", 256, 511, 1)], "class_id string, start_int long, end_int long, ord int")
    got = {r["id"]: r for r in D.registers_of(config, tables, classes, spark.createDataFrame(cells, "name string, row_no int, cells array<string>")).collect()}
    assert [(r["class_id"], r["spec_table"]) for _, r in sorted(got.items())] == [("C1", "T1"), ("C2", "T2"), (None, None)]
    field = lambda x: (x["id"], x["name"], x["bits"], x["access"], x["raw"])
    assert [field(x) for x in got["REG_004"]["fields"]] == [("REG_004_F0", "MODE", "7:4", "read-write", "what more")]
    assert [field(x) for x in got["REG_104"]["fields"]] == [("REG_104_F0", "STAT", "15", "", "of it")] and got["REG_204"]["fields"] == []
    kept = D.register_tables(spark.createDataFrame([("T1", "Block Register", 0), ("T2", "A register", 1), ("T3", "Timing", 2), ("T4", "Register without file", 3)], "id string, title string, ord int"), spark.createDataFrame([("T1",), ("T2",), ("T3",)], "name string"), ["T2"])
    assert [r["id"] for r in kept.collect()] == ["T1"]


def test_layouts_and_versions(spark):
    heads = [["Location", "attrib ", "t", "VALUE", "x"], ["location", "attrib", "value"], ["address", "Access"], []]
    got = [r["f"] for r in spark.createDataFrame([(h, i) for i, h in enumerate(heads)], "h array<string>, i int").orderBy("i").select(E.csv_format(F.col("h")).alias("f")).collect()]
    assert [(f["format"], f["name"], f["text"], f["meaning"]) for f in got] == [("5col", None, 2, 4), ("3col", None, 2, None), ("4col_alt", 2, 3, None), ("3col", None, 2, None)]
    rows = spark.createDataFrame([("Host registers (all)", 0, "No"), ("slot", 1, "Maybe"), ("Slot ", 2, "Yes"), ("", 3, "never")], "name string, ord int, `3.00` string")
    classes = spark.createDataFrame([(1, "Host Registers"), (2, "the slot set"), (3, "none")], "class_id int, name string")
    assert {r["class_id"]: r["version_support"]["3.00"] for r in E.class_versions(classes, rows, ["3.00"]).collect()} == {1: "No", 2: "Yes", 3: "N/A"}


def test_sections_of_two_books(spark):
    pages = spark.createDataFrame([("a", 3, "1.1 Alpha title\n1.2 Beta title"), ("b", 5, "1.1 Gamma title\n1.1 Again title")], "book string, page int, text string")
    got = sorted((r["book"], r["number"], r["title"], r["spec_start"]) for r in D.section_structure(pages, 2).collect())
    assert got == [("a", "1.1", "Alpha title", 1), ("a", "1.2", "Beta title", 1), ("b", "1.1", "Gamma title", 3)]


def test_names_of_files_are_as_they_stand(spark, tmp_path):
    for name in ("My Table 1.csv", "a+b%20.txt", "Ö.x.csv"):
        (tmp_path / name).write_text("a")
    assert sorted(r["name"] for r in S.read_texts(spark, str(tmp_path)).collect()) == sorted(["My Table 1", "a+b%20", "Ö.x"])


def test_numbers_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(5000).select((F.xxhash64("id") % 1000).alias("a"), F.col("id").alias("b"))
        got = R.numbered(rows, ["a", "b"], "n").orderBy("n").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r["n"] for r in got] == list(range(5000)) and [(r["a"], r["b"]) for r in got] == sorted((r["a"], r["b"]) for r in got)
    edges = E.number_edges(rows.where("b < 300"), "REL_", ["b"]).collect()
    assert sorted((r["b"], r["id"]) for r in edges) == [(i, f"REL_{i + 1:04d}") for i in range(300)]
