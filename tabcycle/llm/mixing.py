"""Mixing sources to target weights by systematic sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabcycle.llm.common import WORD, hex_slice, stored, work_folder


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, most_copies: int = 3) -> DataFrame:
    """(source, source_size, docs, target, nth): one row per source, each a sum over all its rows.

    Sources in code point order, null last, weigh 1, 2, 3 and again. A target stops at `most_copies`
    times its source's size and the excess goes to the others by weight until none is above. That end
    is one water level: with sources in order of cap / weight the capped ones come first, and the level
    is what they leave over divided by the weights that follow. The windows see one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    everything = Window.partitionBy()
    ranked = per.withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.select(
        "*",
        (F.col("nth") % 3 + 1).alias("weight"),
        (F.lit(most_copies) * F.col("source_size")).alias("cap"),
        F.sum("source_size").over(everything).alias("total"),
    )
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "nth")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    behind = by_cap.rowsBetween(0, Window.unboundedFollowing)
    levels = ranked.select(
        "*",
        (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left_over"),
        F.sum("weight").over(behind).alias("weights"),
    )
    # The first source in that order that the level does not fill sets the level.
    open_ = F.col("left_over") * F.col("weight") <= F.col("cap") * F.col("weights")
    first = Window.orderBy(F.col("cap") / F.col("weight"), "nth").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    level = levels.select(
        "*",
        F.first(F.when(open_, F.col("left_over")), ignorenulls=True).over(first).alias("level"),
        F.first(F.when(open_, F.col("weights")), ignorenulls=True).over(first).alias("over"),
    )
    target = F.least(
        F.col("cap").cast("double"),
        F.col("level").cast("double") * F.col("weight").cast("double") / F.col("over").cast("double"),
    )
    return level.select("source", "source_size", "docs", "nth", F.coalesce(target, F.lit(0.0)).alias("target"))


def size_cell(size: Column) -> Column:
    """Sizes of as many digits with the same first digit."""
    digits = size.cast("string")
    return F.length(digits) * 10 + F.substring(digits, 1, 1).cast("int")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    most_copies: int = 3,
    seed: str = "mix",
    slices: int = 32,
    folder: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """(id, source, size, source_size, target, copies) for every row: how often the mix takes it.

    Within a source each document is expected target / source_size times. The expected copies are
    summed along the source, ordered by size, and shifted by one random offset of the source; a document
    is taken once for each integer that its own part of the sum crosses. So no document is taken more
    often than the expected number rounded up, and a source's words differ from its target by what one
    boundary can move. The offset comes from the md5 of seed and source: reruns agree.

    The sum is taken in two steps, so that a source with a third of all rows is no single group: counts
    per cell (size class and slice of the id), a running sum over those few cells, then row numbers
    inside a cell. A null text has size 0, an empty source table gives no rows, a source without words
    has target 0 and no copies. Repeated rows are rows of their own.
    """
    folder = folder or work_folder(docs.sparkSession)
    keep = keep or []
    sizes = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), *keep
    )
    by_id = hex_slice(F.coalesce(F.col("id").cast("string"), F.lit("")), slices)
    sizes = stored(
        sizes.select("*", size_cell(F.col("size")).alias("cell"), by_id.alias("slice")), f"{folder}/sizes"
    )
    targets = stored(source_targets(sizes, most_copies), f"{folder}/targets")
    order = Window.partitionBy("source").orderBy("cell", "slice").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        sizes.groupBy("source", "cell", "slice")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("source", "cell", "slice", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    )
    info = targets.select(F.col("source").alias("s"), "source_size", "target", "nth")
    cells = stored(cells.join(info, cells.source.eqNullSafe(info.s)).drop("s"), f"{folder}/cells")
    inside = Window.partitionBy("source", "cell", "slice").orderBy("size", F.col("id").asc_nulls_first())
    numbered = sizes.withColumn("row", F.row_number().over(inside))
    at = [
        numbered.source.eqNullSafe(cells.source),
        numbered.cell == cells.cell,
        numbered.slice == cells.slice,
    ]
    placed = numbered.join(cells, at).select(
        "id",
        numbered.source,
        "size",
        "source_size",
        "target",
        *keep,
        (F.col("before") + F.col("row")).cast("double").alias("nth_row"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
        offset(F.col("nth").cast("string"), seed).alias("offset"),
    )
    crossed = F.floor(F.col("nth_row") * F.col("rate") + F.col("offset")) - F.floor(
        (F.col("nth_row") - 1) * F.col("rate") + F.col("offset")
    )
    return placed.select(
        "id", "source", "size", "source_size", "target", *keep, crossed.cast("long").alias("copies")
    )


def offset(name: Column, seed: str) -> Column:
    """A number in [0, 1) from the md5 of the seed and a source's place."""
    text = F.concat(F.lit(f"{seed}:"), name)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents as the mix holds them: each row as many times as the mix takes it, columns as before.

    Rows that share id and text are told apart by a number; which of them has which number is all one.
    """
    version = F.xxhash64(text_col)
    taken = mix(docs.withColumn("__version", version), id_col, text_col, keep=["__version"], **options)
    same = Window.partitionBy("__id", "__version").orderBy("__copies")
    taken = taken.select(F.col("id").alias("__id"), "__version", F.col("copies").alias("__copies"))
    taken = taken.withColumn("__nth", F.row_number().over(same)).filter("__copies > 0")
    own = Window.partitionBy(F.col(id_col), F.col("__v")).orderBy(F.lit(1))
    rows = docs.withColumn("__v", version).withColumn("__n", F.row_number().over(own))
    at = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__v") == F.col("__version")) & (F.col("__n") == F.col("__nth"))
    again = F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))).alias("__copy")
    plain = [F.col(f"`{c}`") for c in docs.columns]
    return rows.join(taken, at).select(*plain, again).drop("__copy")
