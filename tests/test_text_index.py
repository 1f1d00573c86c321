"""Searches by the persisted index against the scans, and typed registers against parsed ones."""

import random

import pytest
from pyspark.sql import functions as F

from ashlar.operators import graph as G
from ashlar.operators import lookups as L
from ashlar.operators import text_index as X
from ashlar.plans import graph_queries as Q


@pytest.fixture(scope="module")
def nodes(spark):
    draw = random.Random(12)
    word = lambda: "".join(draw.choices("abcé", k=draw.randint(1, 4)))
    rows = [(i, f"n{i}", " ".join(word() for _ in range(draw.randint(0, 5))), draw.choice([None, "Ab abc", "x"]), [word().upper() for _ in range(draw.randint(0, 3))]) for i in range(300)]
    rows += [(300 + i, f"n{300 + i}", "common Name", None, ["SAME", None]) for i in range(150)] + [(900, "n900", "\U0001f600b é" + "ab" * 3000 + "Z", None, None), (901, "n901", None, None, None), (902, "n902", "", "", [])]
    return spark.createDataFrame(rows, "ord long, id string, name string, description string, index_keywords array<string>")


@pytest.fixture(scope="module")
def index(spark, nodes, tmp_path_factory):
    hay = F.concat_ws(" ", "name", "description", F.array_join("index_keywords", " "))
    return X.write_index(nodes, hay, "file://" + str(tmp_path_factory.mktemp("index") / "i"), F.col("index_keywords"))


@pytest.mark.parametrize("query", ["a", "ab", "abc", "ABÉ c", "common name same", "zzz a", "\U0001f600b", "éabababab z", "", "abab"])
def test_word_search_is_that_of_the_scan(nodes, index, query):
    key = lambda df: [(r["id"], r["score"]) for r in df.collect()]
    assert key(X.search_nodes(index, nodes, query, 40)) == key(G.search_nodes(nodes, query, 40))


def test_keywords_and_texts(spark, nodes, index, tmp_path):
    for wanted in (["a"], ["AB", "ab", "same", "Ç"], ["none"]):
        key = lambda df: [(r["id"], r["matched"], r["score"]) for r in df.collect()]
        assert key(X.search_keywords(index, nodes, wanted)) == key(G.search_keywords(nodes, wanted))
    chunks = nodes.withColumn("full_text", F.col("name"))
    own = X.write_index(chunks, F.col("full_text"), "file://" + str(tmp_path / "t"))
    for query in ("ab", "AbAbA", "b a", "mmon n", "bz", "nowhere"):
        key = lambda df: sorted((r["id"], r["position"], r["excerpt"]) for r in df.collect())
        assert key(X.search_text(own, chunks, "full_text", query)) == key(G.search_text(chunks, query))
        assert [r["id"] for r in X.first_with_text(own, chunks, query, 7).collect()] == [r["id"] for r in L.chunks_with_text(chunks, query, 7).collect()]
    with pytest.raises(ValueError, match="INVALID_PARAM"):
        X.search_text(own, chunks, "full_text", "a")
    empty = X.write_index(chunks.where("false"), F.col("full_text"), "file://" + str(tmp_path / "e"), F.col("index_keywords"))
    assert empty.containing("abc").count() == 0 and empty.search_words("a b").count() == 0 and empty.search_keywords(["a"]).count() == 0


def test_plans_read_lists_by_gram(index):
    text = index.containing("ababz")._jdf.queryExecution().toString()
    assert "PushedFilters: [In(gram" in text or "In(gram, [" in text
    assert "StringStartsWith(gram,ab)" in index.containing("ab")._jdf.queryExecution().toString()


def test_typed_registers_are_those_parsed(spark, sf_dir, tmp_path):
    nodes = Q.register_graph(spark, sf_dir)
    path = L.write_registers(nodes, "file://" + str(tmp_path / "r"))
    parsed = L.registers(nodes)
    regs, flds = L.read_registers(spark, path), L.read_fields(spark, path)
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(regs.select(parsed.columns), parsed) and same(flds, L.fields(parsed))
    assert same(L.register_sizes(regs), L.register_sizes(parsed)) and same(L.register_summary(regs), L.register_summary(parsed)) and same(L.dump_totals(regs), L.dump_totals(parsed))
    assert "EqualTo(id,REG_2A_F3)" in L.field_by_id(flds, "REG_2A_F3")._jdf.queryExecution().toString()
