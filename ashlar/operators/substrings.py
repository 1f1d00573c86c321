"""Joins of texts with the texts that contain them, over grams.

A text of the inner side is sought by one of its grams, the one that the fewest outer texts have; these are compared in whole. Grams
have the greatest of LENGTHS that the text is long, so that texts of one or two characters are sought as they are. Texts that repeat are sought once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import small, written

LENGTHS = (1, 2, 3, 6)


def grams(text: str, length: Column | int) -> Column:
    """The different substrings of a length."""
    n = F.lit(length) if isinstance(length, int) else length
    count = F.length(text) - n + 1
    return F.when(count > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.substring(F.col(text), i, n)))).otherwise(F.array().cast("array<string>"))


def contained(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """(needle, nx, hay, hx): all pairs where hay contains needle. inner: (needle, nx), outer: (hay, hx), different texts each; empty needles are left out."""
    length = F.coalesce(*[F.when(F.length("needle") >= n, F.lit(n)) for n in sorted(LENGTHS, reverse=True)])
    asked = written(inner.where("needle <> ''").withColumn("length", length).withColumn("gram", F.explode(grams("needle", F.col("length")))), "needles")
    used = [r["length"] for r in asked.select("length").distinct().collect()]  # of LENGTHS
    own = F.flatten(F.array(*[grams("hay", n) for n in used])) if used else F.array().cast("array<string>")
    lists = outer.select("hay", "hx", F.explode(own).alias("gram"))
    sizes = lists.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).join(asked.select("gram").distinct(), "gram", "left_semi")
    rated = asked.join(written(sizes, "sizes"), "gram", "left")  # a gram that no text has tells that its needle has no place
    rarest = rated.groupBy("needle").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram")).alias("best"), F.first("nx").alias("nx")).where("best.df > 0")
    rarest = written(rarest.select("needle", "nx", F.col("best.gram").alias("gram")), "rarest")
    kept = lists.join(small(rarest.select("gram").distinct()), "gram", "left_semi")
    return kept.join(rarest, "gram").where(F.contains("hay", F.col("needle"))).drop("gram")


def least(rows: DataFrame, text: str, named: str) -> DataFrame:
    """(named, x): the different texts, each with the first of its rows: x is struct(ord, what)."""
    return rows.where(F.col(text).isNotNull()).groupBy(F.col(text).alias(named)).agg(F.min(F.struct("ord", "what")).alias("x"))


def first_holding(needles: DataFrame, texts: DataFrame) -> DataFrame:
    """(needle, ord, what): for each needle the first text in order that contains it; an empty one is in every text. needles: (needle); texts: (text, what, ord)."""
    asked = needles.where(F.col("needle").isNotNull()).select("needle").distinct()
    outer = written(least(texts, "text", "hay").withColumnRenamed("x", "hx"), "texts")
    met = contained(asked.withColumn("nx", F.lit(None).cast("int")), outer).groupBy("needle").agg(F.min("hx").alias("hx"))
    every = asked.where("needle = ''").join(F.broadcast(outer.agg(F.min("hx").alias("hx"))))
    return met.unionByName(every).where("hx IS NOT NULL").select("needle", "hx.ord", "hx.what")


def first_held(texts: DataFrame, needles: DataFrame) -> DataFrame:
    """(text, ord, what): for each text the first needle in order that it contains. texts: (text); needles: (text, what, ord)."""
    asked = texts.where(F.col("text").isNotNull()).select(F.col("text").alias("hay")).distinct()
    inner = written(least(needles, "text", "needle").withColumnRenamed("x", "nx"), "needles")
    met = contained(inner, asked.withColumn("hx", F.lit(None).cast("int"))).groupBy("hay").agg(F.min("nx").alias("nx"))
    every = asked.join(F.broadcast(inner.where("needle = ''").select("nx")))
    return met.unionByName(every).groupBy("hay").agg(F.min("nx").alias("nx")).select(F.col("hay").alias("text"), "nx.ord", "nx.what")
