"""Near-dedup of the pipeline against all pairs."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ashlar.llm import similar, simhash


def groups_by_all_pairs(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {s: s for s in sets.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(list(parent), 2):
        if a and b and 10 * len(a & b) >= 8 * len(a | b):
            parent[root(b)] = root(a)
    low = {}
    for i, s in sets.items():
        low[root(s)] = min(low.get(root(s), i), i)
    return set(low.values())


@pytest.fixture(scope="module")
def changed():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(5000)}"
    line, texts = [word() for _ in range(12)], []
    for size in (3, 5, 7, 9, 14, 30, 80, 400):
        for _ in range(4):
            base = [word() for _ in range(size)]
            texts.append(base)
            for k in (1, 1, 2, 3, 5):
                near = list(base)
                for _ in range(k):
                    near[rng.randrange(size)] = word()
                texts += [near, near[:-1], [*base, *line], [*line, word()]]
    base = [word() for _ in range(60)]
    for _ in range(60):  # a crowd, and chains that leave it
        base = list(base)
        base[rng.randrange(60)] = word()
        texts.append(base)
    return [(i, " ".join(t)) for i, t in enumerate(texts)] + [(9990, None), (9991, "  "), (9992, "")]


@pytest.mark.parametrize("crowd", [1, 4, 64])
def test_every_link_of_changed_texts_is_found(spark, changed, crowd):
    docs = spark.createDataFrame(changed, "doc_id long, text string")
    assert {r["doc_id"] for r in similar.keep_one(docs, crowd=crowd).collect()} == groups_by_all_pairs(changed)


def test_stage_drops_near_copies_with_changed_words(spark, sf_dir):
    words = [f"w{i}" for i in range(200)]
    near = [*words[:50], "other", *words[51:120], "thing", *words[121:]]
    mine = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(reversed(words)))], "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, mine, sf_dir).collect()} == {1, 3}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where(F.col("doc_id").isNotNull())
    rows = [tuple(r) for r in docs.collect()]
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()} == groups_by_all_pairs(rows)


def test_stage_searches_by_fingerprints_first(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(similar, "fingerprint_links", lambda distinct, radius: seen.append((distinct.count(), radius)) or simhash.links(distinct, radius))
    texts = [" ".join(f"w{i}" for i in range(k, k + 100)) for k in (0, 1000)]
    docs = spark.createDataFrame([(1, texts[0]), (2, f"{texts[0]} more"), (3, texts[1]), (4, texts[1])], "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()} == {1, 3}
    assert seen == [(len({simhash.fingerprint(r["text"].encode(), 5) for r in docs.collect()}), 2)]


def test_a_task_gives_a_spanning_part_of_its_links():
    rng = random.Random(3)
    base = [rng.randrange(1 << 40) for _ in range(100)]
    sets = []
    for i in range(300):  # copies with up to 20 changed values, and sets of their own
        own = {base[j] if i % 5 else rng.randrange(1 << 40) for j in range(100)}
        for v in rng.sample(sorted(own), rng.randrange(20)):
            own = own - {v} | {rng.randrange(1 << 40)}
        sets.append(np.array(sorted(own)))
    table = pa.table({"sid": range(300), "n": [len(s) for s in sets], "label": [7 if i in (7, 12) else i for i in range(300)], "h": sets})
    parent = list(range(300))
    parent[12] = 7

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    found = similar.connecting(table).to_pylist()
    assert 0 < len(found) < 300
    for r in found:
        assert {r["a"], r["b"]} != {7, 12} and root(r["a"]) != root(r["b"])
        parent[root(r["b"])] = root(r["a"])
    for a, b in itertools.combinations(range(300), 2):
        if len(np.intersect1d(sets[a], sets[b])) * 9 >= 4 * (len(sets[a]) + len(sets[b])):
            assert root(a) == root(b)


def test_a_common_passage_makes_no_candidates(spark):
    passage = list(range(60))
    sets = spark.createDataFrame([(i, 100, [*passage, *range(1000 * (i + 1), 1000 * (i + 1) + 40)]) for i in range(200)], "sid long, n long, h array<long>")
    assert similar.rare_values(sets).isEmpty()
