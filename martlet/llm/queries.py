"""The registered queries of the operators: production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm import (decontaminate, fracsketch, langid, lines, packing, pieces, prefix_trie, shared_queries, simhash, substrings,
                         subword_lm, toxicity, warc)
from martlet.llm.common import table
from martlet.llm.oracle import ORACLE  # noqa: F401  (the entry module reads it here)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_pages(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_fracsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fracsketch.compare_documents(table(spark, sf_dir, "documents"))


def op5_subword_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = subword_lm.held_out(F.col("doc_id"), 7, 2)
    return subword_lm.score_documents(table(spark, sf_dir, "documents"), held)


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = subword_lm.held_out(F.col("doc_id"), 4, 2)
    return langid.identify(table(spark, sf_dir, "documents"), held)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_distance=4)


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"), max_bits=2, similarity=0.8, shingles=8)


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeat_report(table(spark, sf_dir, "documents"), length=200)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_shared_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_queries.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=20)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.encoding_report(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_packing, op3_warc, op4_fracsketch, op5_subword_lm, op6_langid, op7_simhash, op8_lines, op9_substrings,
                                   op10_decontaminate, op11_shared_queries, op12_prefix_trie, op13_pieces)}
