"""The corpus pipeline: stages over `documents`, each written as Parquet and read by the next.

Language ID drops texts of no language, line dedup takes repeated lines out of texts, near-dedup keeps one
document of each group, mixing repeats or leaves out documents, encoding gives token ids and checks that
they decode to the text.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabcycle.llm.bpe import encode_digests
from tabcycle.llm.common import documents, stored, work_folder
from tabcycle.llm.language_id import learn, learnable, predict
from tabcycle.llm.line_dedup import drop_repeated_lines
from tabcycle.llm.mixing import mixed_documents
from tabcycle.llm.near_docs import near_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text less alike to every language than this is none. Measured at sf0.01: texts of random letters of scripts that no
#: language has score 0.03 on average and up to 0.099; the lowest score of any document there is 0.113, at 18 characters.
LEAST_SCORE = 0.1
#: Texts with fewer letters than this say too little to be rejected.
LEAST_LETTERS = 20


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; null texts and texts without letters have none.

    Where no language was learned, because no labelled row has letters and is not held out, only texts without letters go.
    """
    names, profiles = learn(learnable(docs))
    found = predict(docs, names, profiles, COLUMNS)
    if names:
        short = F.length(F.regexp_replace("text", r"\P{L}", "")) < LEAST_LETTERS
        found = found.filter((F.col("lang_pred") != "und") & ((F.col("score") >= LEAST_SCORE) | short))
    else:
        found = found.filter(F.col("text").rlike(r"\p{L}"))
    return found.select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; n_chars follows the text."""
    freed = drop_repeated_lines(docs)
    return freed.select("doc_id", "text", "lang", "source", F.length("text").cast("bigint").alias("n_chars"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id. Repeated rows are one."""
    kept = near_documents(docs).filter("kept").select(F.col("id").alias("__id"))
    one = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    return one.withColumn("__text", F.xxhash64("text")).dropDuplicates(["doc_id", "__text"]).select(*COLUMNS)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_documents(docs).select(*COLUMNS)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with digests of the ids and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode_digests(docs, path, public_tokenizers.PATTERN, with_ids=True)
    return coded.withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("mix_sources", mix_stage),
    ("byte_bpe", encode_stage),
]

#: Language bundles, similarity of sampled sets and merges are beyond SQL; tests/llm/test_pipeline.py follows every stage in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark)
    docs = documents(spark, sf_dir)
    for nth, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if nth < len(STAGES) - 1:
            docs = stored(docs, f"{folder}/{name}")
    return docs
