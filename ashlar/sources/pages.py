"""Pages of books out of binary files: each file is parsed by a task, with a library where there is one, or an injected parser."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A file's bytes to (page from 1, text) of its pages.
Parser = Callable[[bytes], list[tuple[int, str]]]


def text_pages(data: bytes) -> list[tuple[int, str]]:
    """Pages of a plain text, cut at form feeds."""
    return list(enumerate(data.decode("utf-8", "replace").split("\f"), 1))


def pdf_pages(data: bytes) -> list[tuple[int, str]]:
    """Pages of a PDF; needs the optional library pypdf."""
    try:
        from pypdf import PdfReader
    except ImportError as e:
        raise RuntimeError("PDF files need the optional library pypdf, or a parser of your own") from e
    return [(i, page.extract_text() or "") for i, page in enumerate(PdfReader(io.BytesIO(data)).pages, 1)]


def read_pages(spark: SparkSession, path: str, parser: Parser = text_pages) -> DataFrame:
    """(book, page, text) of all files of a path; an empty file has no pages, null texts are empty."""
    import pyarrow as pa

    raw = spark.read.format("binaryFile").load(path).select(F.substring_index("path", "/", -1).alias("book"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pages = parser(data) if data else []
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(pages), pa.string()), pa.array([p for p, _ in pages], pa.int32()), pa.array([t or "" for _, t in pages], pa.string())], names=["book", "page", "text"])

    return raw.mapInArrow(run, "book string, page int, text string")


def page_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy("book").agg(F.max("page").alias("pages"))


def page_text(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """(book, page, text) of wanted pages; one that there is not has the empty text."""
    return wanted.join(pages, ["book", "page"], "left").withColumn("text", F.coalesce("text", F.lit("")))


def base64_of(images: DataFrame, content: str = "content") -> DataFrame:
    """images with their bytes as base64, as enrichment wants them."""
    return images.withColumn("base64", F.base64(content))
