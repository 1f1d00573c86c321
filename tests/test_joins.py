"""Joins and scans without a small side, against plain Python, with hot keys and odd values."""

import random

from pyspark.sql import functions as F

from ashlar.operators import discover as D
from ashlar.operators import graph as G
from ashlar.operators import grid, overlap, substrings
from ashlar.operators import ranges as R

NESTED = ("BroadcastNestedLoopJoin", "CartesianProduct")


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_ranges_and_points(spark):
    draw = random.Random(3)
    points = [draw.randint(-600, 600) for _ in range(300)] + [7] * 300 + [None, -(2**40), 2**40, 0]
    ranges = [(a, a + draw.choice([-3, 0, 1, 7, 8, 63, 500]), i) for i, a in enumerate(draw.randint(-600, 600) for _ in range(200))] + [(-(2**41), 2**41, 999), (5, 9, 998), (None, 4, 997), (3, None, 996)]
    p, r = spark.createDataFrame([(x,) for x in points], "v long"), spark.createDataFrame([(*x, f"r{x[2]}") for x in ranges], "lo long, hi long, ord int, name string")
    holds = lambda v: [(i, f"r{i}") for a, b, i in ranges if None not in (a, b, v) and a <= v <= b]
    got = R.pairs(p.distinct(), "v", r, "lo", "hi")
    assert not any(x in plan(got) for x in NESTED)
    assert sorted((x["v"], x["ord"]) for x in got.collect()) == sorted((v, i) for v in set(points) for i, _ in holds(v))
    first = {x["v"]: x["name"] for x in R.first_range(p, "v", r, "lo", "hi", "ord", "name").collect()}
    assert first == {v: min(holds(v))[1] for v in set(points) if holds(v)}
    assert R.pairs(p, "v", r.where("false"), "lo", "hi").count() == 0 and R.first_range(p.where("false"), "v", r, "lo", "hi", "ord", "name").count() == 0


def test_last_start_over_partition_borders(spark):
    draw = random.Random(5)
    starts = [(draw.randint(0, 400) * 5, f"s{i}", i) for i in range(150)] + [(30, None, 500)]
    pages = [(i, draw.randint(-20, 2100)) for i in range(900)] + [(1000 + i, 33) for i in range(400)] + [(9999, None)]
    last = {}
    for start, name, _ in sorted(starts, key=lambda x: x[2]):
        last[start] = name
    want = {i: last[max(s for s in last if s <= page)] if page is not None and any(s <= page for s in last) else None for i, page in pages}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that borders are met
    try:
        got = G.section_of_page(spark.createDataFrame(pages, "id int, page int"), spark.createDataFrame(starts, "start long, section string, ord int"))
        assert got.columns == ["id", "page", "section"] and {r["id"]: r["section"] for r in got.collect()} == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r["section"] for r in G.section_of_page(spark.createDataFrame(pages, "id int, page int"), spark.createDataFrame([], "start long, section string, ord int")).collect()} == {None}


def test_running_count_of_long_groups(spark):
    n = 200_000
    rows = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 3 - 1).cast("string").alias("table"), F.col("id").alias("row_no"), (F.xxhash64("id") % 10 == 0).alias("opens"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = R.running_count(rows, "table", "row_no", F.col("opens"), "grp")
        assert got.columns == ["table", "row_no", "opens", "grp"]
        want = rows.withColumn("grp", F.expr("sum(int(opens)) OVER (PARTITION BY table ORDER BY row_no)"))
        assert got.count() == n and got.exceptAll(want).isEmpty()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_texts_in_texts(spark):
    draw = random.Random(8)
    word = lambda: "".join(draw.choices("abc_ -", k=draw.randint(0, 9)))
    needles = [word() for _ in range(120)] + ["a"] * 200 + ["", None, "zz", "Ω", "aΩ", "%_"]
    texts = [(word() + word(), i) for i in range(150)] + [("xΩ aΩb", 200), (None, -5), ("100%_x", 201), ("dup", 203), ("dup", 202)]
    n, t = spark.createDataFrame([(x,) for x in needles], "needle string"), spark.createDataFrame([(x, f"t{i}", i) for x, i in texts], "text string, what string, ord int")
    found = substrings.first_holding(n, t)
    assert not any(x in plan(found.where("needle <> ''")) for x in ("CartesianProduct",))
    want = {x: min((i for text, i in texts if text is not None and x in text), default=None) for x in needles if x is not None}
    assert {r["needle"]: r["ord"] for r in found.collect()} == {x: i for x, i in want.items() if i is not None}
    back = {r["text"]: r["ord"] for r in substrings.first_held(t.select("text"), spark.createDataFrame([(x, f"n{i}", i) for i, x in enumerate(needles)], "text string, what string, ord int")).collect()}
    assert back == {x: min(i for i, y in enumerate(needles) if y is not None and y in x) for x, _ in texts if x is not None}
    none = spark.createDataFrame([], "text string, what string, ord int")
    assert substrings.first_holding(n, none).count() == 0 and substrings.first_held(t.select("text"), none).count() == 0


def test_tables_of_registers_and_classes(spark):
    tables = spark.createDataFrame([("T3", "Block-Size field descriptions (x)", 3), ("T1", "Other", 1), ("T2", "The Block Size table", 2), ("T0", "Foo field descriptions Bar", 0)], "table_id string, title string, ord int")
    regs = spark.createDataFrame([(1, "Block Size Register"), (2, "none such"), (3, "FooBar"), (4, None)], "id int, name string")
    assert {r["id"]: r["table_id"] for r in D.table_of_register(regs, tables).collect()} == {1: "T2", 2: None, 3: "T0", 4: None}
    classes = spark.createDataFrame([(1, "the other one"), (2, "BLOCK"), (3, "zzz")], "class_id int, name string")
    assert {r["class_id"]: r["table_id"] for r in D.class_of_names(classes, tables).collect()} == {1: "T1", 2: "T2", 3: None}


def test_last_box_wins(spark):
    draw = random.Random(6)
    boxes = [(draw.randint(0, 1), i, draw.uniform(-50, 50), draw.uniform(-50, 50), draw.choice([0.0, 0.3, 2.0, 16.0, 90.0])) for i in range(250)] + [(0, 1000 + i, 1.0, 1.0, 4.0) for i in range(150)]
    rows = [(d, f"b{i}", x, y, x + w, y + w / 2, i) for d, i, x, y, w in boxes]
    points = [(draw.randint(0, 2), draw.uniform(-60, 60), draw.uniform(-60, 60)) for _ in range(300)] + [(0, 1.0, 1.0), (0, 5.0, 3.0), (rows[0][0], rows[0][2], rows[0][3])]
    got = grid.holding(spark.createDataFrame([(*p, k) for k, p in enumerate(points)], "drawing int, x double, y double, k int"), spark.createDataFrame(rows, "drawing int, id string, x0 double, y0 double, x1 double, y1 double, ord int"))
    assert not any(x in plan(got) for x in NESTED)
    want = {}
    for k, (d, x, y) in enumerate(points):
        held = [(o, i) for dd, i, x0, y0, x1, y1, o in rows if dd == d and x0 <= x <= x1 and y0 <= y <= y1]
        if held:
            want[k] = max(held)[1]
    assert {r["k"]: r["box"] for r in got.collect()} == want


def test_names_that_share_words(spark):
    draw = random.Random(7)
    names = [(i, " ".join(["part", *draw.choices(["red", "blue", "green", "tiny", "huge", "odd", "Part"], k=draw.randint(0, 3))])) for i in range(150)] + [(900, "part"), (901, ""), (902, None)]
    df = spark.createDataFrame(names, "id int, name string")
    for least in (1, 2, 3):
        sets = [(i, set(n.lower().split())) for i, n in names if n]
        want = sorted((i, j, tuple(sorted(a & b))) for i, a in sets for j, b in sets if len(a & b) >= least)
        assert sorted((r["left_id"], r["right_id"], tuple(r["shared"])) for r in overlap.lookalikes(df, df, least).collect()) == want
    many = spark.range(30_000).select("id", F.concat(F.lit("part x"), "id").alias("name"))  # all share a word, none shares two
    assert overlap.lookalikes(many, many).count() == 30_000


def test_chunks_of_a_long_page(spark):
    pages = spark.createDataFrame([(1, "\n\n".join(f"paragraph number {i} of it" for i in range(100_000)), "x"), (2, None, "y"), (3, " \n\n ", "z"), (4, "one two three four\n\nfive\n\n\n\nsix", "w")], "page int, text string, chunk_text string").drop("chunk_text")
    got = G.chunk_paragraphs(pages, "text", 12).select("page", "chunk_index", "chunk_text", "word_count").collect()
    long = [r for r in got if r["page"] == 1]
    assert len(long) == 50_000 and {r["word_count"] for r in long} == {10} and [r["chunk_index"] for r in long] == list(range(50_000))
    assert "\n\n".join(r["chunk_text"] for r in long) == "\n\n".join(f"paragraph number {i} of it" for i in range(100_000))
    assert [(r["page"], r["chunk_text"]) for r in G.chunk_paragraphs(pages.where("page > 1"), "text", 3).collect()] == [(4, "one two three four"), (4, "five\n\nsix")]
