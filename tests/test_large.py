"""Readers that cut files of any size, against those that hold a whole file."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ashlar.operators import ranges as R
from ashlar.sources import graph as S
from ashlar.sources import large as B


@pytest.fixture()
def many_parts(spark):
    """Files in splits of 500 bytes, shuffles that keep their partitions."""
    changed = {"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_states_that_rows_are_entered_in(many_parts):
    draw = random.Random(3)
    rows = [(g, i, draw.choice([(0, 1), (0, 1), (1, 0), (0, 0), (1, 1)])) for g, n in (("a", 150), ("b", 1), ("c", 40)) for i in range(n)]
    df = many_parts.createDataFrame([(g, i, *t) for g, i, t in rows], "g string, i long, x int, y int")
    expected, state = {}, {}
    for g, i, t in rows:
        expected[g, i] = state.get(g, 0)
        state[g] = t[expected[g, i]]
    got = R.entered_state(df, "g", "i", F.col("x"), F.col("y"), "s")
    assert got.columns == ["g", "i", "x", "y", "s"]
    assert {(r["g"], r["i"]): r["s"] for r in got.collect()} == expected
    assert R.entered_state(df.where("false"), "g", "i", F.col("x"), F.col("y"), "s").count() == 0


def rows_of(df):
    return sorted((r["name"], r["row_no"], [c.replace("\r\n", "\n") for c in r["cells"]]) for r in df.collect())


def test_csv_rows_of_split_files(many_parts, tmp_path):
    draw = random.Random(5)
    texts = {
        "plain": "a,b\n1,2\n", "empty": "", "blank": "\n , \n\n", "open quote": 'a,"b\nc,d\n"e""f\n', "inch": '5" disk,"x"y"z\n', "crlf": 'a,"b\r\nc"\r\nd,e\r\n',
        "fence": '```csv\na,"b\n```\nc"\n```\n', "fence begun": "```\na,b\n", "fence only": "```", "Ü 1": 'é,"ü,\n""ö"""\n', "one cell": "x" * 500,
        "in quotes": '"' + "long, line\n" * 60 + '"\nnext,row\n', "feed": "a\x0bb,c\x1c\n",
    }
    texts |= {f"r{i}": "".join(draw.choice(['"', '"', ",", "\n", "a", " ", '""', 'b"']) for _ in range(draw.randint(0, 300))) for i in range(60)}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, newline="")
    whole = rows_of(S.csv_rows(S.read_texts(many_parts, str(tmp_path))))
    assert many_parts.read.text(str(tmp_path)).rdd.getNumPartitions() > 12
    assert rows_of(B.read_csv_rows(many_parts, str(tmp_path))) == whole and len(whole) > 100


@pytest.mark.parametrize("indent", [None, 1])
def test_graph_of_one_split_document(many_parts, tmp_path, indent):
    draw = random.Random(7)
    odd = ["}", "{", "]", "[", '"', "\\", "\n", "nodes", ': [{"', "é", ", {", '"nodes": [{']
    text = lambda: "".join(draw.choice(odd) for _ in range(draw.randint(0, 9)))
    nodes = [{"id": f"N{i}", "type": "T", "name": text(), "description": text(), "index_keywords": [text()], "source": {"page": i, "table": text()}, "extras": {"k": text(), "}": "{"}} for i in range(60)]
    nodes[3] = {"_comment": "a comment }"}
    relations = [{"id": f"R{i}", "type": "X", "source_node": f"N{i}", "target_node": text(), "bidirectional": None if i % 2 else True} for i in range(25)]
    other = {"metadata_version": "1.0 }{", "statistics": {"by": {"a": {"b": 1}}, "nodes": [{"id": "none"}], "last": {"c": {}}}}
    documents = [{**other, "nodes": nodes, "relations": relations}, {"relations": relations, **other, "nodes": nodes}, {"nodes": nodes[:1], "relations": []}, {"nodes": [], "relations": relations[:2], "statistics": {"x": {"y": {}}}}, {"nodes": [], "relations": []}]
    for i, document in enumerate(documents):
        path = tmp_path / f"d{i}.json"
        path.write_text(json.dumps(document, indent=indent))
        for got, expected in zip(B.read_large_graph(many_parts, str(path)), S.read_graph(many_parts, str(path)), strict=True):
            assert got.columns == expected.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect())), i
