"""A training corpus from ``documents``: toxicity, line dedup, near duplicates, decontamination, tokens.

Every stage takes all rows its predecessor kept, as a DataFrame with the columns of ``documents``;
each stage's result is written as Parquet below the shared checkpoint folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, decontam, line_dedup, simhash, toxicity
from strata.llm.common import cut, table, text_id
from strata.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by the classifier learned from the labels."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.scorer(docs, model)(F.col("text")) < 0.5)


def dedup_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line passages; every document stays, ``n_chars`` follows the text."""
    doc = line_dedup.dedup_lines(docs).select("doc.*")
    if "n_chars" in doc.columns:
        doc = doc.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return doc


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the smallest id."""
    return simhash.near_duplicate_docs(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten consecutive words with a benchmark item."""
    found = cut(decontam.find_contamination(docs, table(spark, sf_dir, "benchmark")).filter(F.size("hits") > 0).select("id", "tid"), "contaminated")
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("d_id"), text_id(F.col("text")).alias("d_tid"))
    return rows.join(found, F.col("d_id").eqNullSafe(F.col("id")) & F.col("d_tid").eqNullSafe(F.col("tid")), "left_anti").select("doc.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of ids and decoded text."""
    got = bpe.encode_docs(docs, tokenizer_path(), with_ids=True)
    return got.select("doc.doc_id", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_passages),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", tokenize),
]

#: SQL can express neither the classifier nor fingerprints nor tokens; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
