"""A training corpus from raw documents: language, near-duplicates, secrets, mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame. Its rows are written as
Parquet and read again as the next stage's documents. All stages but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm.langid import known_language
from creditloom.llm.mixing import mixed_documents
from creditloom.llm.neardup import without_near_duplicates
from creditloom.llm.packing import pack
from creditloom.llm.secrets import mask_secrets
from creditloom.llm.tables import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with a posterior of at least one half.

    Those without a letter, or between languages, go; lang becomes the predicted one.
    """
    return known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return without_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return mask_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to three times."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with the digest of each piece's ids."""
    pieces = pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mix),
    ("packing", packing),
]

# the stages are trained models, graph iterations and hashes, which SQL does not express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", "snappy")
    return STAGES[-1][1](spark, docs, sf_dir)
