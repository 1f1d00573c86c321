"""Pairs of names that share words, by a prefix filter: words from the rarest to the most common. Of two names that share k words, one of the
first n - k + 1 words of each, n being its number of words, is shared; common words stand last, and so are hardly ever joined on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .shared import small, written


def lookalikes(left: DataFrame, right: DataFrame, least: int = 2) -> DataFrame:
    """(left_id, right_id, shared): pairs of names with at least so many different words in common. Both sides: (id, name).

    Names of the same words are met once and their ids joined to them afterwards."""
    words = lambda df: df.select("id", F.array_sort(F.array_distinct(C.words(F.lower("name")))).alias("words")).where(F.size("words") >= least)
    sides = [written(words(df), "names") for df in (left, right)]
    counts = sides[0].select("words").unionByName(sides[1].select("words")).select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "counts")

    def prefix(side: DataFrame, name: str) -> DataFrame:
        sets = side.select("words").distinct()
        rated = sets.select("words", F.explode("words").alias("word")).join(small(counts), "word")
        by = rated.groupBy("words").agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("by"))  # as many as a name has words
        return by.select(F.col("words").alias(name), F.explode(F.slice("by", F.lit(1), F.size("by") - least + 1)).alias("x")).select(name, "x.word")

    met = prefix(sides[0], "a").join(prefix(sides[1], "b"), "word").select("a", "b", F.array_intersect("a", "b").alias("shared")).where(F.size("shared") >= least).distinct()
    ids = [side.select(F.col("words").alias(name), F.col("id").alias(f"{which}_id")) for side, name, which in zip(sides, "ab", ("left", "right"), strict=True)]
    return met.join(ids[0], "a").join(ids[1], "b").select("left_id", "right_id", "shared").distinct()
