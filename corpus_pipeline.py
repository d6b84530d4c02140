"""Corpus clean-up in stages: each works on all that the one before kept, and is written and read again as Parquet.

1. quality rules: documents that break a rule go
2. MinHash near-dedup: of each group of near-duplicates the document of the smallest doc_id stays
3. benchmark decontamination: documents that hold a window of a benchmark item go
4. secret scans: secrets are replaced by a mark, and n_chars is counted again
5. byte-level BPE: texts become token ids, with the columns of a document but its text

Nulls, empty and very long texts, ties, repeated rows and empty tables have the results that the operators' modules
define; a null text has no words, so the first stage rejects it. Extra columns of the input are carried through, whatever
their names, but the last stage's ``ids`` and ``n_tokens`` replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkquill.llm import bpe, decontaminate, near_dup, quality, secrets
from sparkquill.llm.columns import fresh
from sparkquill.shared import new_path, removed, scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (verdict,) = fresh(docs, "verdict")
    return quality.judge(docs, into=verdict).filter(f"{verdict}.kept").drop(verdict)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.kept(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.removed(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs).drop("text").withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]
#: The field of the secret scan and the merges of the encoder have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages. A stage's own tables, and the stage before it, are removed once it is written."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, name)
        with scratch(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if last:
            removed(spark, last)
        last = path
    return docs
