"""From raw documents to packed training sequences, in five stages.

Each stage is written to the shared folder as Parquet and read again, so a lost executor costs a stage at most
and no stage recomputes another. Every stage but the last returns the columns of its input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.llm import curriculum, language, packing, parity_join, secrets
from formline.llm.queries import ship_package, small_batches, tokenizer_file
from formline.operators.layout import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# A document stays if one language has at least this share of its likelihood.
LEAST_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; the others go. A null ``lang`` gets the language found."""
    small_batches(spark)
    found = language.predict(docs, language.fit(docs))
    kept = found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    small_batches(spark)
    return parity_join.without_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; every secret in a text is replaced by a mark, and ``n_chars`` follows the text."""
    small_batches(spark)
    clean = secrets.secret_spans(docs, mark="<secret>")
    changed = F.when(F.size("secret_spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", changed).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, in training order."""
    plan = curriculum.curriculum_plan(docs.withColumn("_size", curriculum.word_count(F.col("text"))), size="_size")
    return curriculum.curriculum_rows(plan).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in training sequences of at most 4096 tokens."""
    small_batches(spark)
    packed = packing.pack_documents(docs, tokenizer_file(packing.TOKENIZER))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id), ("jaccard_join", jaccard_join), ("secret_scan", secret_scan), ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing)]
# The stages learn, compress and tokenise, which SQL cannot express: see tests/llm/test_pipeline.py.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents`` one after the other."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
