"""From raw documents to packed sequences: each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import written
from tablewright.llm.packing import pack
from tablewright.llm.secrets import redact_secrets
from tablewright.llm.simhash import one_of_each_group
from tablewright.llm.toxicity import clean_documents


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney models judge toxic go."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of the SimHash operator stays: three-word shingles, 3 of 64 bits or fewer."""
    return one_of_each_group(docs, shingle=3)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets and the parts linked to them are replaced in the texts; no document goes."""
    return redact_secrets(docs).withColumn(
        "n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    ).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, and where they are placed."""
    return pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", without_near_duplicates),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: A fitted model, sketches and a tokenizer take part: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
