"""Crowded keys at radius 1."""

import itertools

from ashlar.llm import simhash


def test_crowded_keys_lose_no_link_at_radius_1(spark):
    # 24 and 25 are one bit apart and meet only at each other, where 8 and 9 are smaller and two bits from one of them
    values = [8, 9, 16, 17, 24, 25, 7 << 40]
    pairs, _ = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), 1, crowd=0)
    got = {tuple(sorted((r["a"], r["b"]))) for r in pairs.collect()}
    assert got == {(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 1}
