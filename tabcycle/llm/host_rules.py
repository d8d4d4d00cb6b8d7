"""Host-level quality rules: failures by host, rates shrunk by an empirical beta prior, verdicts joined back."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabcycle.llm.common import SPACES, arrow_map, hex_slice, stored, texts_of, work_folder

SYMBOLS = "#*$%&|<>"
#: Rules of a document, in the order they are reported.
RULES = {
    "too_short": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "dup_lines": "n_dup_lines > 0 AND 2 * n_dup_lines >= n_lines",
}


def repeat_words(words: list) -> int:
    """Words that lie in a three-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    first: dict = {}
    covered = bytearray(len(words))
    for at, window in enumerate(windows):
        before = first.setdefault(window, at)
        if before != at:
            covered[at : at + 3] = b"\1\1\1"
            covered[before : before + 3] = b"\1\1\1"
    return covered.count(1)


def text_counts(text: str) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word)."""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in SPACES),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def document_counts(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.col(text_col).alias("text"))

    def each(batch: pa.RecordBatch) -> dict:
        counts = [text_counts(text) for text in texts_of(batch)]
        columns = dict(zip(COUNTS, zip(*counts, strict=True), strict=True))
        return {"id": batch.column(0), "host": batch.column(1)} | {c: list(v) for c, v in columns.items()}

    kinds = dict(rows.dtypes)
    fields = ", ".join(f"{c} bigint" for c in COUNTS)
    return arrow_map(rows, f"id {kinds['id']}, host {kinds['host']}, {fields}", each)


def host_verdicts(counted: DataFrame, most_failing: float = 0.5) -> DataFrame:
    """(host, docs, failed, per-rule failures, rate, rejected): one row per host.

    The share of failing documents of all hosts gives a beta prior by its mean and variance over hosts;
    a host's rate is (alpha + failed) / (alpha + beta + docs). Hosts that do not differ at all have no
    such prior: their rate is the common mean. A host is rejected when its rate is above `most_failing`.
    """
    failed = failing()
    per = counted.groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"),
        F.count_if(failed).alias("failed"),
        *[F.count_if(F.expr(rule)).alias(name) for name, rule in RULES.items()],
    )
    share = F.col("failed") / F.col("docs")
    prior = per.agg(F.avg(share).alias("mean"), F.var_pop(share).alias("var"))
    strength = F.col("mean") * (1 - F.col("mean")) / F.col("var") - 1
    rate = F.when((F.col("var") > 0) & (strength > 0), (
        F.col("mean") * strength + F.col("failed")) / (strength + F.col("docs"))).otherwise(
            F.when(F.col("var") > 0, share).otherwise(F.col("mean")))
    # The prior is one row.
    return per.join(F.broadcast(prior)).select(
        "host", "docs", "failed", *RULES, rate.alias("rate"), (rate > most_failing).alias("rejected")
    )


def failing() -> Column:
    out = F.lit(False)
    for rule in RULES.values():
        out = out | F.expr(rule)
    return out


def judge_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    most_failing: float = 0.5,
    salts: int = 32,
    folder: str | None = None,
) -> DataFrame:
    """(id, host, counts, base_failed, host_rate, kept) for every row.

    base_failed: under 50 words, or more than half of them in repeated three-word windows. kept: not
    base_failed, and the document's host is not rejected. A null text has no words and fails; a null
    host is a host of its own. Counts are stored once, then read for the hosts and for the verdict. Host
    rows go to the documents by host and slice of the id, so that a host with a third of all rows is
    spread over `salts` groups.
    """
    folder = folder or work_folder(docs.sparkSession)
    counted = stored(document_counts(docs, id_col, text_col, host_col), f"{folder}/counts")
    hosts = stored(host_verdicts(counted, most_failing), f"{folder}/hosts")
    spread = hosts.select(
        F.col("host").alias("h"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("s"),
        F.col("rate").alias("host_rate"),
        "rejected",
    )
    salted = counted.withColumn("salt", hex_slice(F.coalesce(F.col("id").cast("string"), F.lit("")), salts))
    base_failed = F.expr(f"{RULES['too_short']} OR {RULES['repetitive']}")
    joined = salted.join(spread, salted.host.eqNullSafe(spread.h) & (salted.salt == spread.s))
    return joined.select(
        "id", "host", *COUNTS, base_failed.alias("base_failed"), "host_rate", (~base_failed & ~F.col("rejected")).alias("kept")
    )
