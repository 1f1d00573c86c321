"""Columns of any name pass through, keys of any size are joined, and what must settle does."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ashlar.llm import common, decontam, pii, similar, simhash

NAMES = ["rid", "base", "cands", "spans", "more", "__t", "__text", "__row", "__id", "doc", "h1", "h2", "sid", "n", "h", "lang_pred", "score"]


@pytest.fixture(scope="module")
def clashing(spark):
    texts = ["the cat sat on the mat with the hat and the bat", "the cat sat on the mat with the hat and the bat", "write to a.b@c.de or +1 202 555 0123 now please", None, "", "x" * 5000, "numbers " + " ".join(f"{i:05d}" for i in range(3000))]
    rows = [(f"id{i:03d}", t, "en", *[f"{n}{i}" for n in NAMES]) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[2]], ", ".join(f"`{c}` string" for c in ("doc_id", "text", "lang", *NAMES)))


def same_columns(out, of):
    assert out.columns == of.columns
    for r in out.collect():
        k = int(r["doc_id"][2:])
        assert all(r[n] == f"{n}{k}" for n in NAMES)


def test_columns_pass_through(spark, clashing):
    bench = spark.createDataFrame([(1, "sat on the mat with the hat")], "item_id long, text string")
    for out in (simhash.keep_one(clashing), similar.keep_one(clashing), decontam.drop_contaminated(clashing, bench), pii.mask(clashing)):
        same_columns(out, clashing)
    assert {r["doc_id"] for r in simhash.keep_one(clashing).collect()} == {"id000", "id002", "id003", "id005", "id006"}
    assert {r["doc_id"] for r in decontam.drop_contaminated(clashing, bench).collect()} == {"id002", "id003", "id004", "id005", "id006"}
    assert "write to <EMAIL> or <PHONE> now please" in {r["text"] for r in pii.mask(clashing).collect()}


def test_pipeline_stages_on_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out, _ = common.write_table(stage(spark, docs, sf_dir), name)
        assert out.count() == 0
        docs = out if name != "sentencepiece" else docs


def test_long_identifiers_and_left_words(spark):
    word = "passport" + "y" * 60 + "-no:"
    rows = [(i, f"we wrote. {word} +1 (202) 555-01{i:02d} was given") for i in range(12)] + [(20, f"then {word} X{'9' * 80} came"), (21, f"then {word} 0049 301 2345 came")]
    got = {r["doc_id"]: r["s"] for r in pii.spans_of(spark.createDataFrame(rows, "doc_id long, text string"), "text", ["doc_id"]).select("doc_id", pii.joined(F.col("spans")).alias("s")).collect()}
    at = len(f"then {word} ")
    assert got[20] == f"phone:{at}:{at + 81}" and got[21] == f"phone:{at}:{at + 13}"


def test_components_settle_or_raise(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r["label"] for r in common.components(chain, "a", "b").collect()} == {0}
    with pytest.raises(RuntimeError):
        common.components(chain, "a", "b", rounds=1)


def test_heavy_keys_are_joined_whole(spark, monkeypatch):
    monkeypatch.setattr(common, "fits", lambda *a: False)
    monkeypatch.setattr(common, "HEAVY_ROWS", 50)
    rows, _ = common.write_table(spark.range(1000).select(F.when(F.col("id") < 700, 0).when(F.col("id") < 990, F.col("id")).alias("k"), F.col("id").alias("v")), "rows")
    side = spark.createDataFrame([(0, "zero"), (800, "x"), (5000, "none")], "k long, s string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(map(tuple, rows.join(side, "k", how).collect()), key=repr)
        assert sorted(map(tuple, common.keyed_join(rows, side, ["k"], how).collect()), key=repr) == want
