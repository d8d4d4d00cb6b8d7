"""Line dedup over levelled sorted runs of line hashes.

Lines of new batches are looked up in the runs by an anti-join: keys that no run holds become the
batch's own sorted run, keys that one holds are kept as repeats. So a key stands in exactly one run,
and a compaction is a merge without any summing. DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabcycle.llm.common import SPACES, hex_slice, stored, work_folder

KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), string.ascii_uppercase, string.ascii_lowercase)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """Sorted runs of keys in levels; `fanout` runs of a level are merged into one of the next."""

    def __init__(self, folder: str, fanout: int = 4):
        self.folder, self.fanout, self.made = folder, fanout, 0
        self.levels: list[list[DataFrame]] = []
        self.repeats: list[DataFrame] = []

    def _run(self, df: DataFrame) -> DataFrame:
        self.made += 1
        return stored(df.sortWithinPartitions(*KEY), f"{self.folder}/run-{self.made}")

    def rows(self) -> DataFrame | None:
        runs = [run for level in self.levels for run in level]
        out = runs[0] if runs else None
        for run in runs[1:]:
            out = out.union(run)
        return out

    def add(self, keys: DataFrame) -> None:
        """Add one batch of (h1, h2, docs, last), one row per key."""
        known = self.rows()
        if known is None:
            self._place(self._run(keys), 0)
            return
        marked = keys.join(known.select(*KEY, F.lit(True).alias("held")), KEY, "left")
        marked = stored(marked, f"{self.folder}/batch-{self.made}")
        self.repeats.append(marked.filter("held").drop("held"))
        # Partitioned by the key already, since it comes from a join on it.
        self._place(self._run(marked.filter("held is null").drop("held")), 0)

    def _place(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            merged = runs[0]
            for other in runs[1:]:
                merged = merged.union(other)
            self._place(self._run(merged.repartition(*KEY)), level + 1)

    def totals(self, least: int) -> DataFrame:
        """(h1, h2, docs, last) of the keys found in `least` documents or more."""
        runs = self.rows()
        if not self.repeats:
            return runs.filter(F.col("docs") >= least)
        again = self.repeats[0]
        for other in self.repeats[1:]:
            again = again.union(other)
        again = again.groupBy(*KEY).agg(F.sum("docs").alias("more"), F.max("last").alias("later"))
        return runs.join(again, KEY, "left").select(
            *KEY,
            (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"),
            F.greatest("last", "later").alias("last"),
        ).filter(F.col("docs") >= least)


def repeated_lines(
    docs: DataFrame, folder: str, id_col: str, text_col: str, least_chars: int, least_docs: int, batches: int
) -> DataFrame:
    """(id, version, dropped): positions of the lines that each text loses.

    `version` is the hash of the text, so that rows of one id with other texts stay apart.
    """
    keyed = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("version"),
        F.posexplode(F.transform(lines_of(F.col(text_col)), line_key)).alias("pos", "key"),
    ).filter(F.length("key") >= least_chars)
    hashed = stored(
        keyed.select(
            "id",
            "version",
            "pos",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), "key").alias("h2"),
            hex_slice(F.coalesce(F.col("id").cast("string"), F.lit("")), batches).alias("batch"),
        ),
        f"{folder}/lines",
    )
    runs = LineRuns(f"{folder}/runs")
    for batch in range(batches):
        part = hashed.filter(F.col("batch") == batch).select(*KEY, "id").distinct()
        runs.add(part.groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("last")))
    often = runs.totals(least_docs)
    return (
        hashed.join(often.select(*KEY, "last"), KEY)
        .filter(~F.col("id").eqNullSafe(F.col("last")))
        .groupBy("id", "version")
        .agg(F.collect_set("pos").alias("dropped"))
    )


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = 20,
    least_docs: int = 3,
    batches: int = 4,
    folder: str | None = None,
) -> DataFrame:
    """The documents with `text_col` freed of repeated lines, plus n_lines and n_dropped.

    A line's key is the line without white space at its ends and in lower case (A-Z). Keys of at least
    `least_chars` code points found in at least `least_docs` documents keep their lines in the
    document with the largest id only. A null text counts as empty: one empty line. Rows with equal id
    are one document; a null id is smaller than any other. Batches are cut by the hash of the id, so a
    document lies in one batch. Other columns pass through, whatever their names.
    """
    folder = folder or work_folder(docs.sparkSession)
    drops = repeated_lines(docs, folder, id_col, text_col, least_chars, least_docs, batches)
    gone = drops.select(
        F.col("id").alias("__id"), F.col("version").alias("__version"), F.col("dropped").alias("__dropped")
    )
    joined = docs.join(
        gone,
        F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__version")),
        "left",
    )
    lines = lines_of(F.col(text_col))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__dropped"))
    text = F.when(F.col("__dropped").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    )
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    return joined.select(
        *keep,
        text.alias(text_col),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("__dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
