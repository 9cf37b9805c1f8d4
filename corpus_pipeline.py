"""The corpus pipeline: documents that pass the quality rules, one of each group of near copies, without benchmark passages and secrets, as tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the next one. All but
the last return the columns of documents. No stage can be said in SQL as a whole (iterated estimates, seeded sampling, models, a
vocabulary file), so there is no oracle; tests hold every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftwork.llm import bpe, decontamination, jaccard_join, quality_rules, secret_scan
from siftwork.llm.common import staged, table, tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that they reject go."""
    return quality_rules.keep_good(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each class of near copies the document with the least id stays."""
    return jaccard_join.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold an item go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: secrets are replaced in the texts, all documents stay."""
    return secret_scan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding: adds token_ids and n_tokens."""
    return bpe.with_tokens(docs, tokenizer_path())


STAGES = [
    ("quality_rules", keep_good),
    ("jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("bpe_encoding", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
