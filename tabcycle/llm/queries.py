"""The operators of this folder as queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabcycle.llm.bpe import encode_digests
from tabcycle.llm.common import documents
from tabcycle.llm.divergence import source_divergence
from tabcycle.llm.host_rules import judge_documents
from tabcycle.llm.language_id import held_out, identify
from tabcycle.llm.line_dedup import drop_repeated_lines
from tabcycle.llm.merkle import edited_neighbours
from tabcycle.llm.mixing import mix
from tabcycle.llm.near_docs import near_documents
from tabcycle.llm.private_data import KINDS, private_spans
from tabcycle.llm.spelling import spelling_groups
from tabcycle.llm.sql import SQL  # noqa: F401
from tabcycle.llm.suffix_dedup import drop_repeats
from tabcycle.llm.token_files import token_digests
from tabcycle.llm.vector_pairs import near_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@query
def op2_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_spans(documents(spark, sf_dir))
    counts = [f"n_{kind}" for kind in KINDS]
    base = F.sha2("base_spans", 256).alias("base_sha256")
    return found.select(F.col("id").alias("doc_id"), *counts, base, "spans", "n_disguised")


@query
def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_documents(documents(spark, sf_dir))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(F.col("id").alias("doc_id"), *counts, "base_failed", "kept")


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_digests(documents(spark, sf_dir), path, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


@query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


@query
def op6_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_documents(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), F.col("component").alias("class_id"), "kept", "copies_of")


@query
def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir), ["doc_id"]).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_digests(documents(spark, sf_dir), path, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


@query
def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(documents(spark, sf_dir))


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_neighbours(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(documents(spark, sf_dir))
