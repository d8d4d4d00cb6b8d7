"""Document fingerprints: a Merkle tree over the sections and paragraphs of a text.

A text is split into paragraphs at `\\n`, a paragraph into phrases, and paragraphs are gathered into sections. All
borders hang on what stands there and not on where it stands: a phrase ends after a word whose md5 starts with 0 to 3,
a section after an empty paragraph or one whose digest starts with 0. So an edit changes the phrases, the paragraph
and the section it is in, and the path to the root, and leaves all other nodes as they are.

A phrase's digest is the sha256 of its text; that of a paragraph, section or root is the sha256 of its children's
digests in order. Two texts are equal if and only if their roots are (but for collisions of sha256); where roots
differ, `edited_paragraphs` goes down the differing branches only.

Everything here is built-in expressions. A null text is the empty text, which has one section with one empty
paragraph. Repeated rows are documents of their own. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of text in a bucket of neighbouring documents.
BUCKET_CHARS = 32 << 20


def _cut(joined: Column) -> Column:
    """The parts of a string in which each part ends with one separator; the last separator says nothing."""
    return F.split(F.substring(joined, F.lit(1), F.length(joined) - 1), "\n", -1)


def phrases(paragraph: Column) -> Column:
    """The phrases of a paragraph, at least one. Put together with blanks they are the paragraph again."""
    ended = F.transform(
        F.split(paragraph, " ", -1),
        lambda word: F.concat(word, F.when(F.substring(F.md5(word.cast("binary")), 1, 1) < "4", "\n").otherwise(" ")),
    )
    return _cut(F.array_join(ended, ""))


def text_tree(text: Column) -> Column:
    """The phrases of each paragraph: the leaves, array<array<string>>."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), phrases)


def paragraph_digests(tree: Column) -> Column:
    return F.transform(tree, lambda p: F.sha2(F.array_join(F.transform(p, lambda leaf: F.sha2(leaf, 256)), ""), 256))


def section_parts(digests: Column) -> Column:
    """One string per section: the digests of its paragraphs, with blanks between them."""
    empty = F.sha2(F.sha2(F.lit(""), 256), 256)
    ends = lambda d: (F.substring(d, 1, 1) == "0") | (d == empty)
    return _cut(F.array_join(F.transform(digests, lambda d: F.concat(d, F.when(ends(d), "\n").otherwise(" "))), ""))


def section_digests(parts: Column) -> Column:
    return F.transform(parts, lambda part: F.sha2(part, 256))


def with_tree(docs: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the tree of one column: <name>_leaves (distinct phrases), <name>_paragraphs, <name>_sections, <name>_root."""
    tree, digests, parts = f"__{name}_tree", f"{name}_paragraphs", f"__{name}_parts"
    return (
        docs.withColumn(tree, text_tree(F.col(text)))
        .withColumns({
            f"{name}_leaves": F.array_distinct(F.flatten(tree)),
            digests: paragraph_digests(F.col(tree)),
        })
        .withColumn(parts, section_parts(F.col(digests)))
        .withColumn(f"{name}_sections", section_digests(F.col(parts)))
        .withColumn(f"{name}_root", F.sha2(F.array_join(f"{name}_sections", ""), 256))
        .drop(tree, parts)
    )


def _weight(leaves: Column) -> Column:
    return F.aggregate(leaves, F.lit(0).cast("long"), lambda total, leaf: total + F.length(leaf) + 1)


def likeness(left: Column, right: Column) -> Column:
    """Share of two texts' distinct phrases that both hold, by length: 0 to 1, and 1 for equal texts."""
    common = _weight(F.array_intersect(left, right)).cast("double")
    return 2.0 * common / (_weight(left) + _weight(right))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (id, n_chars, fingerprint, n_sections, n_paragraphs): the root and the size of each document's tree."""
    own = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    own = with_tree(own, "text", "own")
    return own.select(
        "id",
        F.length("text").cast("long").alias("n_chars"),
        F.col("own_root").alias("fingerprint"),
        F.size("own_sections").alias("n_sections"),
        F.size("own_paragraphs").alias("n_paragraphs"),
    )


def edited_paragraphs(pairs: DataFrame, left: str, right: str, keep: list[str]) -> DataFrame:
    """Rows (<keep>, side, paragraph, start, length, text): the paragraphs that only one side has, nothing for equal roots.

    `paragraph` counts from 0, `start` in code points. A paragraph is looked at only if its section differs, that is
    if no section of the other side has the same digest. Of repeated equal paragraphs none differs.
    """
    both = pairs.select(
        *[F.col(c) for c in keep],
        F.coalesce(left, F.lit("")).alias("__l"),
        F.coalesce(right, F.lit("")).alias("__r"),
    )
    for side, text in (("l", "__l"), ("r", "__r")):
        both = both.withColumn(f"__{side}_digests", paragraph_digests(text_tree(F.col(text))))
        both = both.withColumn(f"__{side}_parts", section_parts(F.col(f"__{side}_digests")))
    both = both.filter(F.col("__l_parts") != F.col("__r_parts"))
    rows = []
    for nth, (side, other) in enumerate((("l", "r"), ("r", "l"))):
        # What stands in the other side's differing sections, and where this side's differ.
        odd = F.array_except(f"__{side}_parts", f"__{other}_parts")
        lost = F.array_except(
            F.flatten(F.transform(odd, lambda part: F.split(part, " "))), F.col(f"__{other}_digests")
        )
        sought = both.withColumn("__lost", lost).filter(F.size("__lost") > 0)
        paragraphs = F.split(f"__{side}", "\n", -1)
        listed = sought.select(
            *keep,
            "__lost",
            F.col(f"__{side}_digests").alias("__digests"),
            paragraphs.alias("__texts"),
            F.transform(paragraphs, lambda p: F.length(p) + 1).alias("__lengths"),
        )
        spread = listed.select(*keep, "__lost", "__lengths", F.posexplode(F.arrays_zip("__digests", "__texts")).alias("__nth", "__p"))
        found = spread.filter(F.array_contains("__lost", F.col("__p.__digests")))
        before = F.aggregate(F.slice("__lengths", F.lit(1), F.col("__nth")), F.lit(0).cast("long"), lambda a, n: a + n)
        rows.append(found.select(
            *keep,
            F.lit(("left", "right")[nth]).alias("side"),
            F.col("__nth").alias("paragraph"),
            before.alias("start"),
            F.length("__p.__texts").alias("length"),
            F.col("__p.__texts").alias("text"),
        ))
    return rows[0].unionByName(rows[1])


def _place(splitters: Column, key: Column) -> Column:
    """The number of the last splitter that is not above the key, by halving; 0 if there is none."""
    steps = F.sequence(F.lit(1), F.lit(32))
    found = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("low"), F.size(splitters).alias("high")),
        lambda at, _: F.when(
            at["high"] - at["low"] > 1,
            F.when(
                F.get(splitters, F.floor((at["low"] + at["high"]) / 2).cast("int")) <= key,
                F.struct(F.floor((at["low"] + at["high"]) / 2).cast("int").alias("low"), at["high"].alias("high")),
            ).otherwise(
                F.struct(at["low"].alias("low"), F.floor((at["low"] + at["high"]) / 2).cast("int").alias("high"))
            ),
        ).otherwise(at),
    )
    return found["low"]


def with_next(docs: DataFrame, id_column: str, text_column: str, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """Rows (id, text, own_*, next_text, next_leaves): each document beside the next one in descending order of ids.

    After the last comes the first. Null ids come last; rows with one id are ordered by a hash of their texts.

    Documents are dealt by ranges of ids into buckets of about `bucket_chars` characters, so one shuffle carries the texts
    and no task holds more than some buckets. Spark's range partitioner picks the borders: one key per range, 20 bytes, which
    every task gets. The first document of a bucket is also sent, as a guard, to the bucket before it, where it
    is the successor of the last. Rows that agree in id and text stay in one bucket.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text")).withColumn(
        "key",
        F.struct(
            F.col("id").isNull().alias("none"),
            F.bitwise_not(F.coalesce(F.col("id").cast("long"), F.lit(0))).alias("rank"),
            F.xxhash64("text").alias("hash"),
        ),
    )
    size = rows.agg(F.sum(F.length("text").cast("double") + 64)).first()[0] or 0.0
    ranges = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), int(size / bucket_chars) + 1)
    dealt = rows.select("key").repartitionByRange(ranges, "key")
    least = dealt.groupBy(F.spark_partition_id().alias("range")).agg(F.min("key").alias("key"))
    splitters = least.agg(F.array_sort(F.collect_list("key")).alias("splitters"))

    placed = rows.withColumn("splitters", splitters.scalar())
    placed = placed.withColumn("bucket", _place(F.col("splitters"), F.col("key")))
    first = F.get("splitters", F.col("bucket")) == F.col("key")
    before = F.when(F.col("bucket") == 0, F.size("splitters") - 1).otherwise(F.col("bucket") - 1)
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guard"))
    guard = F.struct(before.alias("bucket"), F.lit(True).alias("guard"))
    sent = placed.select("id", "text", "key", F.inline(F.when(first, F.array(own, guard)).otherwise(F.array(own))))
    sent = with_tree(sent.repartition("bucket"), "text", "own")
    along = Window.partitionBy("bucket").orderBy("guard", "key")
    beside = sent.withColumns({
        "next_text": F.lead("text").over(along),
        "next_leaves": F.lead("own_leaves").over(along),
    })
    return beside.filter(~F.col("guard")).drop("key", "bucket", "guard")


def edited_neighbours(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each document's fingerprint against that of an edited copy of itself and of the next document.

    The edited text has the last half of the code points (rounded down) replaced by as many from the start of the next
    document, descending ids. Rows (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_sections, n_paragraphs, same_sections, same_paragraphs); the last two count what the edit left as it was.
    """
    beside = with_next(docs, id_column, text_column)
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    beside = with_tree(beside.withColumn("edited", edited), "edited", "edited")
    same = lambda part: F.size(F.array_intersect(f"own_{part}", f"edited_{part}"))
    return beside.select(
        "id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("own_root").alias("fingerprint"),
        F.col("edited_root").alias("edited_fingerprint"),
        likeness(F.col("own_leaves"), F.col("edited_leaves")).alias("near_edited"),
        likeness(F.col("own_leaves"), F.col("next_leaves")).alias("near_next"),
        F.size("own_sections").alias("n_sections"),
        F.size("own_paragraphs").alias("n_paragraphs"),
        same("sections").alias("same_sections"),
        same("paragraphs").alias("same_paragraphs"),
    )
