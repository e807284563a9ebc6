"""A corpus pipeline: quality rules, near duplicates, benchmark leaks, secrets, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns the columns of
documents; the last one adds the token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from driftline.llm import bpe, decontamination, jaccard_join, quality, secrets
from driftline.llm.common import cut, table, unused


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the divergence of their distributions reject go."""
    verdict = unused(docs, "verdict")
    return quality.judge(spark, docs, out=verdict).where(F.col(f"{verdict}.kept")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays, once.

    A null doc_id counts as the greatest; of rows that share a doc_id but not the text, each is linked by its own text,
    and the one with the smaller hash of both stays if they link. Rows without words all stay.
    """
    return jaccard_join.one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.remove(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; all documents stay."""
    return secrets.mask(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents with `ids`, the token ids of each whole text, and their number `n_tokens`; columns of these names are replaced."""
    out = bpe.encode(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("secret scans", mask_secrets),
    ("BPE encoding", encode_tokens),
]

#: Stages 1 to 3 and 5 can't be expressed in SQL. Tests hold the operators against brute force; of the pipeline as a
#: whole they compare the near duplicates so, the other stages only by counts, patterns and the operators themselves.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
