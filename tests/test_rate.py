"""Calls a second over all tasks of an enrichment, and waiting after calls that raise."""

import time

import pytest
from pyspark.sql import functions as F

from ashlar.operators import enrich as N


def calls(folder):
    return sorted(float(x) for p in folder.iterdir() for x in p.read_text().split())


def asker(folder, fails=0):
    def ask(prompt, attempt):
        import os
        import time as clock

        with open(f"{folder}/{os.getpid()}", "a") as f:
            f.write(f"{clock.time()}\n")
        if attempt < fails:
            raise RuntimeError("busy")
        return prompt.splitlines()[0]

    return ask


def test_tasks_share_one_rate(spark, tmp_path):
    rate, slots, n = 20.0, 4, 80
    found = N.enriched(spark.range(n).repartition(9), F.col("id").cast("string"), asker(tmp_path), rate=rate, slots=slots)
    began = time.time()
    assert sorted(int(r["answer"]) for r in found.collect()) == list(range(n))
    at = calls(tmp_path)
    assert len(at) == n and time.time() - began >= (n - slots) / rate * 0.9
    for i, t in enumerate(at):  # in any second no more than the rate, and a call that each slot may be late by
        assert sum(t <= x < t + 1 for x in at[i:]) <= rate + slots
    with pytest.raises(ValueError, match="INVALID_PARAM"):
        N.enriched(found, F.lit("x"), rate=0)


def test_waits_grow_after_calls_that_raise(spark, tmp_path):
    got = N.enriched(spark.range(1), F.lit("p"), asker(tmp_path, fails=2), backoff=0.2).first()
    assert (got["answer"], got["attempts"]) == ("p", 3)
    at = calls(tmp_path)
    assert at[1] - at[0] >= 0.2 and at[2] - at[1] >= 0.4
