"""Work on pages that goes on where it ended."""

from pyspark.sql import functions as F

from ashlar.streaming import ingest


def test_only_missing_pages_are_worked_on(spark, tmp_path):
    pages = spark.createDataFrame([("a", 1, "x"), ("a", 2, "bad"), ("b", 1, "y"), (None, 1, "z"), ("b", 3, "")], "book string, page int, text string")
    status = F.when(F.col("text") == "bad", "FAILED").otherwise("COMPLETED")
    work = lambda round_: lambda df: df.where("text <> ''").select("book", "page", status.alias("status"), F.lit(round_).alias("round"))
    rows = lambda df: sorted((str(r["book"]), r["page"], r["status"], r["round"]) for r in df.collect())
    target = str(tmp_path / "done")
    assert rows(ingest.resume(pages.where("book = 'a'"), target, work(1))) == [("a", 1, "COMPLETED", 1), ("a", 2, "FAILED", 1)]
    second = rows(ingest.resume(pages, target, work(2)))
    assert second == [("None", 1, "COMPLETED", 2), ("a", 1, "COMPLETED", 1), ("a", 2, "FAILED", 1), ("b", 1, "COMPLETED", 2)]
    assert rows(ingest.resume(pages, target, work(3))) == second  # b 3 gives nothing, and is tried each time
    assert rows(ingest.resume(pages, target, work(4), again=True)) == sorted([*second, ("a", 2, "FAILED", 4)])
