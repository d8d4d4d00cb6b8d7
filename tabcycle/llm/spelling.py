"""Spelling variants: words one edit apart, found by PartEnum signatures of their letter multisets.

The letters of a word are a binary vector: one dimension per letter and how often it stood before. An inserted or deleted
letter changes one dimension and a replaced one two, so words one edit apart have vectors of Hamming distance two at
most. The dimensions are dealt to PARTS parts by a hash; a difference in two dimensions touches two parts at most, so
the vectors agree on all parts of at least one choice of PARTS - 2. Each word has a signature per choice
(a hash of the parts chosen), and equal signatures are an equi-join.

Words with the same letters in another order share all signatures. One edit also leaves the longer of the common start and the
common end with at least half of what is left of the shorter word: words of `least_chars` letters that are one edit apart agree
in their first or in their last ceil((least_chars - 1) / 2) code points. A signature is therefore
joined once with the start and once with the end. Pairs are then verified by edit distance, each at every
signature it meets at, and counted once.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabcycle.llm.common import arrow_map, stored, work_folder

PARTS = 6
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def misspelt(run: Column, draw: Column, one_in: int) -> Column:
    """The run without one code point where `one_in` divides the draw; which one hangs on the draw."""
    at = (draw % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(draw % one_in == 0, shorter).otherwise(run)


def word_counts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_chars: int = 6,
    least_count: int = 5,
    one_in: int = 199,
) -> DataFrame:
    """Rows (word, n): the letter runs of all texts, A-Z lower-cased, one in `one_in` of them with a letter lost.

    The draw is the crc32 of `<id>:<run>`, so it is the same for all of a document's occurrences. Words shorter than
    `least_chars` or rarer than `least_count` are left out; runs that short cannot become words, so they are not even
    cut out of the text. A null text has no runs; a null id counts as an empty one. Repeated rows count each.
    """
    run = F.translate(F.col("run"), UPPER, LOWER)
    pattern = f"[{LETTERS}]{{{least_chars},}}"
    runs = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text_column), F.lit(pattern), F.lit(0))).alias("run"),
    ).select("id", run.alias("run"))
    draw = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    words = runs.select(misspelt(F.col("run"), draw, one_in).alias("word")).filter(F.length("word") >= least_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number (the finaliser of splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def part_sums(words: list[str], parts: int = PARTS) -> np.ndarray:
    """Per word and part, the sum of the hashes of the word's dimensions in this part."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    of = np.repeat(np.arange(len(words)), [len(w) for w in words])
    order = np.lexsort((points, of))
    points, of = points[order], of[order]
    # How many equal letters of the same word come before.
    opens = np.ones(len(points), dtype=bool)
    opens[1:] = (points[1:] != points[:-1]) | (of[1:] != of[:-1])
    starts = np.flatnonzero(opens)
    nth = np.arange(len(points)) - np.repeat(starts, np.diff(np.append(starts, len(points))))
    dimension = _mixed((points << np.uint64(32)) | nth.astype(np.uint64))
    part = (dimension % np.uint64(parts)).astype(np.int64)
    sums = np.zeros((len(words), parts), dtype=np.uint64)
    np.add.at(sums, (of, part), _mixed(dimension))
    return sums


def signatures(words: list[str], least_chars: int, parts: int = PARTS) -> np.ndarray:
    """Per word, the keys it is joined on: one per choice of parts, with its start and with its end."""
    sums = part_sums(words, parts)
    edge = max(1, math.ceil((least_chars - 1) / 2))
    ends = np.array([[hash_text(w[:edge]), hash_text(w[-edge:])] for w in words], dtype=np.uint64)
    keys = []
    for nth, chosen in enumerate(itertools.combinations(range(parts), parts - 2)):
        signature = np.full(len(words), nth, dtype=np.uint64)
        for p in chosen:
            signature = _mixed(signature ^ sums[:, p])
        keys += [_mixed((signature ^ _mixed(ends[:, side])) + np.uint64(side)) for side in range(2)]
    return np.stack(keys, axis=1).view(np.int64)


def hash_text(text: str) -> int:
    """A short text as a number: its code points in base 2^21."""
    value = 0
    for c in text:
        value = (value * 2_097_152 + ord(c)) % 18_446_744_073_709_551_557
    return value


def near_words(words: DataFrame, folder: str, least_chars: int = 6) -> DataFrame:
    """Rows (word, n, other, other_n): all ordered pairs of words that differ by exactly one edit.

    Every pair of one edit shares a key, and every pair that shares a key is verified: none is capped or lost. Work
    per key is the product of its words; Spark splits the join of a frequent key over tasks. Words must be distinct and of
    `least_chars` code points or more.
    """

    def keyed(batch: pa.RecordBatch) -> dict:
        found = batch.column("word").to_pylist()
        keys = signatures(found, least_chars)
        width = keys.shape[1]
        return {
            "key": keys.reshape(-1),
            "word": pa.DictionaryArray.from_arrays(np.repeat(np.arange(len(found)), width), found).cast(pa.string()),
            "n": np.repeat(batch.column("n").to_numpy(), width),
        }

    rows = stored(arrow_map(words.select("word", "n"), "key long, word string, n long", keyed), f"{folder}/signatures")
    left, right = rows.alias("a"), rows.alias("b")
    met = left.join(right, (F.col("a.key") == F.col("b.key")) & (F.col("a.word") < F.col("b.word")))
    near = met.filter(F.levenshtein("a.word", "b.word", 1) == 1).select(
        F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("other"), F.col("b.n").alias("other_n")
    )
    once = stored(near.distinct(), f"{folder}/near")
    return once.union(once.select("other", "other_n", "word", "n"))


def roots(forms: DataFrame, folder: str, ratio: float) -> DataFrame:
    """Rows (word, root) for rows (word, form): where the chain of forms from a word ends.

    A form is `ratio` times as frequent as its word at least and counts stay below 2^63, so chains do not close and their length is
    bounded; each round doubles the steps a word has gone. Rounds are stored tables.
    """
    links = forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    walked = stored(links, f"{folder}/links-0")
    most = math.ceil(math.log2(63 / math.log2(ratio) + 1)) + 1
    for step in range(1, most + 1):
        further = walked.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        after = walked.join(further, walked.root == further.via, "left")
        after = after.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        after = stored(after, f"{folder}/links-{step}")
        moved = after.filter("moved").limit(1).count()
        walked = after.select("word", "root")
        if not moved:
            return walked
    raise RuntimeError(f"chains of forms did not end in {most} rounds")


def spelling_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_chars: int = 6,
    least_count: int = 5,
    one_in: int = 199,
    ratio: float = 5,
) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n), one per word of `word_counts`.

    Its form is the most frequent of the words one edit away (of equally frequent ones the first in code-point order) if that is at
    least `ratio` times as frequent; root is where the forms lead. A table without words gives no rows. `ratio` must be
    above 1, since forms would run in circles otherwise.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    folder = work_folder(docs.sparkSession)
    words = stored(word_counts(docs, id_column, text_column, least_chars, least_count, one_in), f"{folder}/words")
    near = near_words(words, folder, least_chars)
    # The largest count, then the first word: the least of (-count, word).
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    met = words.join(best, "word", "left")
    often = -F.col("best.less") >= ratio * F.col("n")
    forms = stored(
        met.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("best.other")).alias("form"),
            F.when(often, -F.col("best.less")).alias("form_n"),
        ),
        f"{folder}/forms",
    )
    led = roots(forms, folder, ratio).withColumnRenamed("word", "from")
    joined = forms.join(led, F.col("word") == F.col("from"), "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
