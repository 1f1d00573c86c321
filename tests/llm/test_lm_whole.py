"""The scores don't depend on which words and pairs the scoring tasks hold."""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ashlar.llm import lm_score


def test_words_and_pairs_that_are_not_held_score_as_counted(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("doc_id < 60")
    whole = lm_score.fit(docs.where("doc_id < 40"), "text", F.lit(2))
    want = {r["doc_id"]: r for r in lm_score.score(docs, whole).collect()}
    monkeypatch.setattr(lm_score, "HOT", 20)
    monkeypatch.setattr(lm_score, "PAIRS", 30)
    few = lm_score.fit(docs.where("doc_id < 40"), "text", F.lit(2))
    few["params"] = whole["params"]
    got = {r["doc_id"]: r for r in lm_score.score(docs, few).collect()}
    assert len(want) == len(got) > 0
    for i, r in want.items():
        assert got[i]["n_known"] == r["n_known"] and np.isclose(got[i]["base_score"], r["base_score"])
        assert np.isclose(got[i]["score"], r["score"], rtol=1e-5)


def test_every_training_document_reaches_the_layer(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some words and number {i}") for i in range(64)], "doc_id long, text string")
    seen, train = [], lm_score.train
    monkeypatch.setattr(lm_score, "train", lambda d, *a: (seen.extend(r["doc_id"] for r in d.collect()), train(d, *a))[1])
    slices = F.col("doc_id") % lm_score.SLICES
    lm_score.fit(docs, "text", slices)
    assert sorted(seen) == list(range(64))
    alone = lm_score.fit(docs.where("doc_id = 5"), "text", slices)["params"]
    assert not np.array_equal(alone["o"], lm_score.initial(alone["bigrams"], alone["inputs"])["o"])


def test_no_task_is_handed_a_table_of_texts_at_once(spark, monkeypatch, tmp_path):
    frame, seen = type(spark.range(0)), str(tmp_path)
    plain = frame.mapInArrow

    def watched(df, run, *args):
        def each(batches):
            def measured():
                for b in batches:
                    with open(f"{seen}/{uuid.uuid4().hex}", "w") as f:
                        f.write(str(b.nbytes))
                    yield b

            return run(measured())

        return plain(df, each, *args)

    monkeypatch.setattr(frame, "mapInArrow", watched)
    docs = spark.createDataFrame([(i, "some words and others " * 10_000) for i in range(40)], "doc_id long, text string").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    model = lm_score.fit(docs, "text", F.col("doc_id"))
    assert [r["n_tokens"] for r in lm_score.score(docs, model).collect()] == [40_001] * 40
    sizes = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert len(sizes) > 5 and max(sizes) < 6_000_000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_words_are_those_of_white_space_of_ascii():
    texts = [" A b  a\tÄX\n", None, "", "   ", "x\x0bY\x1cz\x85 q r\r", "a"]
    kinds, codes, counts = lm_score.split_words(pa.array(texts, pa.string()))
    words = [[*(t or "").encode().lower().split(), b""] for t in texts]
    assert counts.tolist() == [len(w) for w in words]
    assert [kinds[i].as_py().encode() for i in codes.tolist()] == [x for w in words for x in w]
