"""From raw documents to packed sequences: each stage reads what the one before wrote.

Language ID drops documents without a recognisable language; exact and near dedup keep one
document of each group; the secret scan masks what it finds; packing places the ids of what
is left into sequences. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelweave.llm import bag_minhash, exact_dedup, language_id, packing, secret_scans
from panelweave.llm.queries import tokenizer
from panelweave.llm.rows import from_files, located, without
from panelweave.llm.workers import ship
from panelweave.sources.scratch import materialize


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language; unknown and ambiguous ones go."""
    ship(spark)
    docs = from_files(docs)
    found = language_id.predict(located(docs, "text"), language_id.fit(docs), "file", "place")
    return without(docs, found.where(F.col("ambiguous") | (F.col("lang_pred") == language_id.UNKNOWN)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the row with the largest id stays."""
    ship(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of similar texts stays; texts of no words are alone."""
    ship(spark)
    return bag_minhash.drop_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with found secrets replaced in their texts and ``n_chars`` counted anew."""
    ship(spark)
    return secret_scans.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence; missing text is an end id alone."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scans", mask_secrets),
    ("packing", pack),
]

#: Classifiers, near duplicates and tokenizers are beyond SQL: see the tests instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
