"""A corpus pipeline: quality classifier, quality rules, near-duplicates, packing.

Each stage is (spark, docs, sf_dir) -> DataFrame and works on all rows that the stage before kept;
all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import near_dups, packing, quality, rules
from ledgerline.llm.frames import stored, table
from ledgerline.llm.queries import BYTE_BPE, tokenizer


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep_documents(docs, table(spark, sf_dir, "labels"))


def minhash_near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # 45 bands of 6 rows: two sets at 0.8 fail to meet with probability 1.2e-6.
    return near_dups.keep_first(docs, least=80, bands=45, rows=6)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer(BYTE_BPE))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("minhash_near_dups", minhash_near_dups),
    ("best_fit_packing", best_fit_packing),
]

#: Models and tokenizers are not SQL; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each stage's result stored once for the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
