"""The size of a persisted index, and its searches over texts of many segments, of odd characters, and with more hits than a broadcast takes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ashlar.operators import graph as G
from ashlar.operators import text_index as X


def shuffled(spark) -> int:
    return sum(e.totalShuffleWrite() for e in (lambda x: [x.apply(i) for i in range(x.size())])(spark.sparkContext._jsc.sc().statusStore().executorList(False)))


def test_an_index_takes_less_than_two_bytes_a_character_and_no_shuffle(spark, tmp_path):
    draw = random.Random(4)
    words = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 9))) for _ in range(1500)]
    texts = spark.createDataFrame([(i, " ".join(draw.choices(words, k=400))) for i in range(400)], "ord long, t string").repartition(3).localCheckpoint()
    before = shuffled(spark)
    X.write_index(texts, F.col("t"), "file://" + str(tmp_path / "i"))
    assert shuffled(spark) - before < 100_000  # counts of rows only
    size = sum(f.stat().st_size for f in (tmp_path / "i" / "grams").rglob("*.parquet"))
    assert size < 2 * texts.agg(F.sum(F.length("t"))).first()[0]


def test_numbers_come_back():
    draw = np.random.default_rng(1)
    for gaps in (np.array([0]), np.array([127, 128, 16383, 16384, 1 << 21, (1 << 28) - 1, 1 << 28, 1 << 35, 0]), draw.integers(0, 1 << 20, 5000), np.empty(0, np.int64)):
        data, begin = X.packed(gaps)
        assert X.unpacked(data.tobytes()).tolist() == gaps.tolist() and len(begin) == len(gaps)


def test_many_segments_and_wide_alphabets(spark, tmp_path, monkeypatch):
    draw = random.Random(5)
    odd = "ab\0é\U0001f600İ\n"
    rows = [(7 * i - 50, f"c{i}", draw.choice([None, "", "".join(draw.choices(odd, k=draw.randint(1, 12)))])) for i in range(300)] + [(9000, "w", "".join(chr(c) for c in range(0x4E00, 0x9F00)) * 2), (9001, "l", "ab" * 3000 + "a\0b")]
    low = [(o, x.lower()) for o, _, x in rows if x]
    chunks = spark.createDataFrame(rows, "ord long, id string, full_text string").repartition(2)
    for name, size in (("one", X.SEGMENT), ("many", 200)):
        monkeypatch.setattr(X, "SEGMENT", size)
        index = X.write_index(chunks, F.col("full_text"), "file://" + str(tmp_path / name))
        parts = spark.read.parquet(index.path + "/grams").select("segment").distinct().count()
        assert parts <= 2 if name == "one" else parts > 10
        for query in ("a", "ab", "b\0", "bab", "é\U0001f600", "aba\0b", "i̇a", "倀倁倂倃", "\nab"):
            got = {(r["ord"], r["pos"]) for r in index.occurrences([query]).collect()}
            assert got == {(o, i) for o, x in low for i in range(len(x)) if x.startswith(query, i)}, query


def test_more_hits_than_a_broadcast_takes(spark, tmp_path):
    draw = random.Random(6)
    chunks = spark.createDataFrame([(i, f"c{i}", " ".join(draw.choices(["Nation", "ratio", "İx", "é"], k=4))) for i in range(200)] + [(300, "n", None)], "ord long, id string, full_text string")
    index = X.write_index(chunks, F.col("full_text"), "file://" + str(tmp_path / "i"))
    key = lambda df: sorted((r["id"], r["position"], r["excerpt"]) for r in df.select("id", "position", "excerpt").collect())
    few, many = (X.search_text(index, chunks, "full_text", "atio", 5, most) for most in (1000, 3))
    assert key(few) == key(many) == key(G.search_text(chunks, "atio", 5)) and few.count() > 100 and few.schema == many.schema
    assert "Exchange" not in many._jdf.queryExecution().executedPlan().toString()  # no text is shuffled
    with pytest.raises(ValueError, match="INVALID_PARAM"):
        X.search_text(index, chunks, "full_text", "a", most=3)


def test_first_chunks_leave_less_than_four_times_their_input(spark):
    from pathlib import Path

    from ashlar.plans import graph_queries as Q

    d = "/root/testdata/sf0.01"
    assert [r["id"] for r in Q.indexed_first_chunks(spark, d).collect()] == [f"CHUNK_{r['doc_id']}" for r in spark.read.parquet(f"{d}/documents.parquet").where("contains(lower(text), 'the ')").orderBy("doc_id").limit(7).collect()]
    kept = Path(Q._stored[spark.sparkContext.applicationId, d, "chunks"].removeprefix("file://"))
    assert sum(f.stat().st_size for f in kept.rglob("*.parquet")) < 4 * Path(f"{d}/documents.parquet").stat().st_size
