"""A training corpus from raw documents, in five stages; each one works on all that its predecessor kept.

Language identification drops documents whose language is not recognised (no letter, or a score below
MIN_SCORE), near-dedup keeps one document of each group of texts that are linked by a Jaccard similarity
of five-word shingles of 0.8 or more (found by SimHash and generalised pigeonhole first, then exactly), decontamination drops documents that the benchmark covers, personal data
is masked in the text, and the last stage adds subword ids. All but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ashlar.llm import common, decontam, langid, pieces, pii, similar

MIN_SCORE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.select("doc_id", "text", "lang"), common.fold("doc_id", 5) != 0)
    names = {c: f"__{i}" for i, c in enumerate(docs.columns)}  # no name that predict() adds; texts go through Python once
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    found = langid.predict(rows, model, names["text"], carry=names["text"])
    kept = found.where((F.col("lang_pred") != langid.UND) & (F.col("score") >= MIN_SCORE))
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.mask(docs)
    if "n_chars" not in masked.columns:
        return masked
    return masked.select(*[F.length("text").cast(masked.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars" else F.col(c) for c in masked.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, carry_text=True)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("pii", mask_personal_data),
    ("sentencepiece", encode),
]

#: SQL can't express the trained classifier, so tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = common.write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
