"""The corpus pipeline: quality rules, toxicity, n-gram Jaccard join, benchmark
decontamination, then BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns the rows of ``docs``
that it keeps, with their columns; the last returns one row per document with
its number of ids and digests. Near-duplicates share word shingles of five at
a similarity of 0.8 or more; of each group the document with the smallest id
stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meridian.llm import bpe, decontaminate, ngram_join, quality, toxicity
from meridian.llm.common import WIDE_ROWS, batch_rows, load, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, max_line_docs=quality.MAX_LINE_DOCS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, load(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_first(docs, words=5, pct=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, load(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with batch_rows(spark, WIDE_ROWS):
        return staged(bpe.digests(bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))), "digests")


STAGES = [("quality rules", quality_rules), ("toxicity", drop_toxic), ("n-gram Jaccard join", drop_near_duplicates),
          ("benchmark decontamination", drop_benchmark), ("BPE", encode)]
ORACLE_SQL = None  # SQL can't express the string kernel, the latent space and the tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
