"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.centroids import clustered, with_digests
from millrace.llm.context_mixing import mixed_scores
from millrace.llm.decontaminate import contaminated
from millrace.llm.licences import licence_scan
from millrace.llm.near_duplicates import near_duplicates
from millrace.llm.packing import packed
from millrace.llm.personal_data import personal_data, span_digests
from millrace.llm.quality_classifier import judged
from millrace.llm.quality_rules import judge_documents
from millrace.llm.texts import table
from millrace.llm.token_alignment import token_alignment
from millrace.llm.token_ids import written_and_read
from millrace.llm.toxicity import toxicity
from millrace.llm.warc import archive_and_read


def op1_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packed(table(spark, sf_dir, "documents"), *files)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(personal_data(table(spark, sf_dir, "documents")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(table(spark, sf_dir, "pages"))


def op10_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_scores(table(spark, sf_dir, "documents"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_digests(clustered(table(spark, sf_dir, "embeddings")))


def op12_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")
    return token_alignment(table(spark, sf_dir, "documents"), *map(public_tokenizers.path, files))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_host_quality_rules": op1_host_quality_rules,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_licence_scan": op5_licence_scan,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_personal_data": op7_personal_data,
    "op8_toxicity": op8_toxicity,
    "op9_warc_archive": op9_warc_archive,
    "op10_context_mixing": op10_context_mixing,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_token_id_files": op12_token_id_files,
    "op13_token_alignment": op13_token_alignment,
    "pipeline": corpus_pipeline.run,
}
