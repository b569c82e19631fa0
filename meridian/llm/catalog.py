"""The operators as queries on the driver's tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm import ann, bpe, collocations, decontaminate, html_text, ngram_join, quality, sharding, spelling, token_file, toolcalls, toxicity, urlfilter
from meridian.llm.common import load, shared_path

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(load(spark, sf_dir, "documents")).withColumnRenamed("_id", "doc_id")


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.hilbert_shards(load(spark, sf_dir, "documents")).select(
        F.col("_id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(load(spark, sf_dir, "pages")).withColumnRenamed("_id", "page_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        F.col("_id").alias("doc_id"), toxicity.held_out("_id").alias("held_out"), "score", "predicted")


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    token_file.write(load(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE))
    return token_file.read_index(spark, path)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")).withColumnRenamed("_id", "doc_id")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(load(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE)))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(load(spark, sf_dir, "pages")).withColumnRenamed("_id", "page_id")


def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.line_quality(load(spark, sf_dir, "documents")).select(
        F.col("_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "removed_words", "base_failed", "kept")


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = toolcalls.chat_calls(load(spark, sf_dir, "conversations"))
    return toolcalls.link(calls, results, toolcalls.CHAT_SCHEMAS).unionByName(toolcalls.refused_calls(calls))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(load(spark, sf_dir, "documents"))


def op12_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(load(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_hilbert_shards": op2_hilbert_shards,
    "op3_html_text": op3_html_text,
    "op4_toxicity": op4_toxicity,
    "op5_token_file": op5_token_file,
    "op6_decontaminate": op6_decontaminate,
    "op7_bpe": op7_bpe,
    "op8_url_filter": op8_url_filter,
    "op9_line_quality": op9_line_quality,
    "op10_tool_calls": op10_tool_calls,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_nearest_vectors": op12_nearest_vectors,
    "op13_collocations": op13_collocations,
}
ORACLE = {
    "op1_ngram_join": ngram_join.ORACLE,
    "op8_url_filter": urlfilter.ORACLE,
    "op9_line_quality": quality.ORACLE,
    "op10_tool_calls": toolcalls.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
