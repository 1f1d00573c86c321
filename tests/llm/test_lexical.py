"""Ranked lexical search against all pairs."""

import math
import random
import re
from collections import Counter

from ashlar.llm import lexical

DOCS, ITEMS = "doc_id long, text string, score long, t long", "item_id long, text string, row long"


def brute(docs, items, k=lexical.TOP):
    """The ranking by its definition, over lists of (id, text)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (x or "").translate(lower))
    counted = [(i, Counter(terms(x))) for i, x in docs if terms(x)]
    total = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counted:
            m = 75 + (25 * sum(c.values()) * len(counted)) // total
            score = sum(n * math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, n in Counter(terms(text)).items() if c[t])
            scored += [(-score, doc is None, doc or 0, doc)] * (score > 0)
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], DOCS).repartition(5)
    rows = lexical.search(d, spark.createDataFrame([(i, t, 3) for i, t in items], ITEMS), **options).collect()
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows), key=str)


def test_ranking_is_that_of_all_pairs(spark):
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(draw.choices(vocabulary, [1 / (i + 1) for i in range(300)], k=n))
    docs = [(i, text(draw.randint(1, 60))) for i in range(500)]
    docs += [(1000 + i, docs[7][1]) for i in range(250)]  # a third are copies of one text
    items = [(i, text(draw.randint(1, 25))) for i in range(25)] + [(99, docs[7][1]), (99, docs[7][1]), (98, "w0 w0 W0 w299")]
    assert found(spark, docs, items, bucket=16) == brute(docs, items)
    assert found(spark, docs, items, bucket=64, block_terms=100, k=3) == brute(docs, items, 3)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,- "), (4, "One two"), (4, "One two"), (4, "One two"), (None, "one two"), (None, "one two"), (5, "ÀÉ Àé x" + " filler" * 40_000), (6, "a-b_c1\x00d")]
    items = [(1, "one"), (None, "TWO x"), (2, None), (3, "..."), (4, "Àé d c1"), (5, "unknown words")]
    assert found(spark, docs, items, bucket=2) == brute(docs, items)
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, None)], items) == []


def test_bounds_prune(spark):
    """Buckets and lists that can't reach a threshold are not opened, and what reaches it is found."""
    import numpy as np

    rows = [[(0, 100), (1, 5)], [(1, 90)], [(1, 3), (2, 2)]]
    length = np.array([math.sqrt(sum(p * p for _, p in r)) for r in rows])
    b = lexical.Bucket(length, np.array([len(r) for r in rows]), np.array([t for r in rows for t, _ in r]), np.array([p for r in rows for _, p in r]))
    query = (np.array([0, 1]), np.array([2, 1]))
    assert [x.tolist() for x in b.search(query, 1.0, 2)] == [[0, 1, 2], [205, 90, 3]]
    assert [x.tolist() for x in b.search(query, 150.0, 1)] == [[0], [205]]
    assert [x.tolist() for x in b.search(query, 205.0, 2)] == [[0], [205]]
