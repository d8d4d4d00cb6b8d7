"""How the sources of a language differ in their words: an index built in blocks, merged into frequencies, compared in pairs.

1. Every task reads its documents once and counts terms in memory, per language, source and term (its occurrences and
   the documents it is in). When the block is full, it is spilled: a term-sorted run per hash shard.
2. Each shard's runs are merged with a heap into the frequencies of its terms, and terms of too few documents go.
3. Groups are compared pair by pair. A group's share of a term that it lacks depends on the group alone, so a pair's
   difference is found from the two groups by themselves, and the terms that both hold add a correction: these are
   streamed over the merged index, term by term.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabcycle.llm.common import AT_ONCE, arrow_fields, parts, stored, work_folder

#: Of UTF-8: letters A to Z in either case, and everything that is not ASCII.
IN_TERM = np.array([chr(byte).isalpha() if byte < 128 else True for byte in range(256)])
#: Lower-cases A to Z.
LOWER = np.array([byte + 32 if 65 <= byte <= 90 else byte for byte in range(256)], np.uint8)
#: Bytes of postings that a task holds before it spills a run.
BLOCK_BYTES = 64 << 20
#: Entries of a run in one row.
CHUNK = 20_000
#: Entries that a merge takes in before it sends on what is complete.
MERGED_AT_ONCE = 200_000
#: Entries of the matrix of pair corrections that a task holds.
MATRIX = 1 << 20

RUN = "shard int, run string, nth int, first binary, entries binary"
ENTRIES = pa.schema([("term", pa.large_binary()), ("group", pa.int32()), ("n", pa.int64()), ("docs", pa.int64())])
MERGED = "lang string, term string, sources array<struct<source: string, n: bigint>>"


class Entries(NamedTuple):
    """Entries of distinct terms and groups: `terms[code]` is an entry's term. Entries are in the order of code and group."""

    terms: pa.LargeBinaryArray
    code: np.ndarray
    group: np.ndarray
    n: np.ndarray
    docs: np.ndarray

    def table(self, kept: np.ndarray | slice = slice(None)) -> pa.Table:
        columns = [self.terms.take(pa.array(self.code[kept])), *(pa.array(c[kept]) for c in (self.group, self.n, self.docs))]
        return pa.table(columns, schema=ENTRIES)


def added_up(tables: list[pa.Table]) -> Entries:
    """The entries of several tables, those of the same term and group added up."""
    table = pa.concat_tables(tables)
    coded = table.column("term").combine_chunks().dictionary_encode()
    group = table.column("group").to_numpy().astype(np.int64)
    groups = int(group.max(initial=0)) + 1
    key, at = np.unique(coded.indices.to_numpy() * groups + group, return_inverse=True)
    # Sums of whole numbers, exact below 2^53.
    n, docs = (np.bincount(at, table.column(c).to_numpy(), len(key)).astype(np.int64) for c in ("n", "docs"))
    return Entries(coded.dictionary, key // groups, (key % groups).astype(np.int32), n, docs)


class Block:
    """Postings in memory: per term and group (lang, source) its occurrences and the documents it is in."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.tables: list[pa.Table] = []
        self.bytes = 0

    def add(self, langs: list[str], sources: list[str], texts: list[str]) -> None:
        raw = [text.encode() for text in texts]
        buffer = LOWER[np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)]
        within = IN_TERM[buffer]
        edge = np.flatnonzero(np.diff(within.view(np.int8), prepend=np.int8(0)))
        starts, ends = edge[::2], edge[1::2]
        own = np.array([self.groups.setdefault(group, len(self.groups)) for group in zip(langs, sources, strict=True)], np.int64)
        if not len(starts):
            return
        of = np.searchsorted(np.cumsum([len(one) + 1 for one in raw]), starts, side="right")
        offsets = np.concatenate([[0], np.cumsum(ends - starts)])
        found = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buffer[within])]
        ).dictionary_encode()
        size = len(found.dictionary)
        # Per document and term, then per group and term.
        in_doc, n = np.unique(of * size + found.indices.to_numpy(), return_counts=True)
        entries, at = np.unique(own[in_doc // size] * size + in_doc % size, return_inverse=True)
        columns = [
            found.dictionary.take(pa.array(entries % size)),
            pa.array(entries // size, pa.int32()),
            # Sums of whole numbers, exact below 2^53.
            pa.array(np.bincount(at, n).astype(np.int64)),
            pa.array(np.bincount(at).astype(np.int64)),
        ]
        self.tables.append(pa.table(columns, schema=ENTRIES))
        self.bytes += self.tables[-1].nbytes

    def full(self, most: int) -> bool:
        """Whether the postings, added up, take more than half of `most` bytes; they are added up when they take all."""
        if self.bytes > most:
            self.tables = [added_up(self.tables).table()]
            self.bytes = self.tables[0].nbytes
        return self.bytes > most // 2

    def runs(self, shards: int) -> Iterator[tuple[int, pa.Table]]:
        """Per shard its entries, sorted by term."""
        if not self.tables:
            return
        entries = added_up(self.tables)
        terms = entries.terms.to_pylist()
        shard_of = np.fromiter(map(crc32, terms), np.uint32, len(terms)) % np.uint32(shards)
        rank = np.empty(len(terms), np.int64)
        rank[np.array(sorted(range(len(terms)), key=terms.__getitem__))] = np.arange(len(terms))
        order = np.lexsort((rank[entries.code], shard_of[entries.code]))
        table, numbers = entries.table(order), shard_of[entries.code][order]
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        names = np.array(list(self.groups) + [None], dtype=object)[:-1]
        for low, high in zip(cuts, cuts[1:], strict=False):
            part = table.slice(low, high - low)
            used, at = np.unique(part.column("group").to_numpy(), return_inverse=True)
            part = part.set_column(1, "group", pa.array(at.astype(np.int32)))
            # The groups stand beside the entries, which have their numbers.
            yield int(numbers[low]), part.replace_schema_metadata({"groups": json.dumps([list(names[u]) for u in used])})


def spilled_runs(docs: DataFrame, shards: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One run per task, block and shard: rows (shard, run, nth, first, entries), up to CHUNK entries each, in the order of nth.

    `docs` has columns lang, source and text without nulls. Documents are counted some at a time and each whole, so a block can
    exceed `block_bytes` by what these add. Entries are sorted by term and packed as Arrow; `first` is the first term.
    """
    fields = arrow_fields(RUN)

    def spilled(block: Block, name: str) -> Iterator[pa.RecordBatch]:
        for shard, entries in block.runs(shards):
            for nth, low in enumerate(range(0, entries.num_rows, CHUNK)):
                some = entries.slice(low, CHUNK).combine_chunks()
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, some.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as packed:
                    packed.write_table(some)
                row = [[shard], [name], [nth], [some.column(0)[0].as_py()], [sink.getvalue().to_pybytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, fields, strict=True)], schema=fields)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, nth = TaskContext.get().partitionId(), Block(), 0
        for batch in batches:
            langs, sources, texts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("lang", "source", "text"))
            at = 0
            for some in parts(texts, min(AT_ONCE, block_bytes)):
                block.add(langs[at : at + len(some)], sources[at : at + len(some)], some)
                at += len(some)
                if block.full(block_bytes):
                    yield from spilled(block, f"{part}-{nth}")
                    block, nth = Block(), nth + 1
        yield from spilled(block, f"{part}-{nth}")

    return docs.select("lang", "source", "text").mapInArrow(index, RUN)


class Merge:
    """Runs of one shard merged by a heap of their rows: the row with the least first term is taken in next.

    What is taken in and lies below the first terms of all rows still in the heap is complete. It holds MERGED_AT_ONCE
    entries and, of rows that reach beyond, what does.
    """

    def __init__(self, least_docs: int):
        self.least_docs = least_docs
        self.groups: dict[tuple[str, str], int] = {}

    def taken_in(self, packed: bytes) -> pa.Table:
        with pa.ipc.open_stream(packed) as stream:
            names = [self.groups.setdefault(tuple(g), len(self.groups)) for g in json.loads(stream.schema.metadata[b"groups"])]
            table = stream.read_all().replace_schema_metadata(None)
        return table.set_column(1, "group", pa.array(np.array(names, np.int32)[table.column("group").to_numpy()]))

    def run(self, runs: list[list[tuple[bytes, bytes]]]) -> Iterator[Entries]:
        """Complete entries, from rows (first term, packed entries) of each run in order."""
        heap = [(rows[0][0], nth, 0) for nth, rows in enumerate(runs)]
        heapq.heapify(heap)
        held, size = [], 0
        while heap:
            _, nth, at = heapq.heappop(heap)
            held.append(self.taken_in(runs[nth][at][1]))
            size += held[-1].num_rows
            if at + 1 < len(runs[nth]):
                heapq.heappush(heap, (runs[nth][at + 1][0], nth, at + 1))
            if size >= MERGED_AT_ONCE or not heap:
                found = added_up(held)
                if heap:
                    done = pc.less(found.terms, pa.scalar(heap[0][0], pa.large_binary())).to_numpy(zero_copy_only=False)[found.code]
                    held = [found.table(~done)]
                    size = held[0].num_rows
                    found = Entries(found.terms, *(column[done] for column in found[1:]))
                if len(found.code):
                    yield found

    def frequencies(self, found: Entries) -> pa.RecordBatch:
        """(lang, term, sources) for terms in enough documents of their language, each of which stands whole in the entries."""
        names = list(self.groups)
        langs = sorted({lang for lang, _ in names})
        number = {lang: nth for nth, lang in enumerate(langs)}
        key = found.code * len(langs) + np.array([number[lang] for lang, _ in names])[found.group]
        order = np.argsort(key, kind="stable")
        key, group, n = key[order], found.group[order], found.n[order]
        opens = np.flatnonzero(np.diff(key, prepend=-1))
        enough = np.add.reduceat(found.docs[order], opens) >= self.least_docs
        sizes = np.diff(opens, append=len(key))
        kept = np.repeat(enough, sizes)
        key, sizes = key[opens[enough]], sizes[enough]
        listed = pa.StructArray.from_arrays(
            [pa.array([source for _, source in names], pa.string()).take(pa.array(group[kept])), pa.array(n[kept])],
            fields=[pa.field("source", pa.string()), pa.field("n", pa.int64())],
        )
        return pa.RecordBatch.from_arrays([
            pa.array(langs, pa.string()).take(pa.array(key % len(langs))),
            found.terms.take(pa.array(key // len(langs))).cast(pa.binary()).cast(pa.string()),
            pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), listed),
        ], names=["lang", "term", "sources"])


def merged_runs(runs: DataFrame, shards: int, least_docs: int) -> DataFrame:
    """Rows (lang, term, sources): the counts of each term in at least `least_docs` documents of its language.

    A task gets the runs of some shards and merges one shard after the other. It holds one shard's runs at
    a time, packed. How large a shard is hangs on the number of shards, which has to grow with the input.
    """

    def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list[tuple[bytes, bytes]]]]:
        """Per shard its runs, each as its rows. Rows come sorted by shard, run and nth."""
        shard, name, runs = None, None, []
        for batch in batches:
            for of, run, first, entries in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                if of != shard:
                    if runs:
                        yield runs
                    shard, name, runs = of, None, []
                if run != name:
                    name = run
                    runs.append([])
                runs[-1].append((first, entries))
        if runs:
            yield runs

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in by_shard(batches):
            merging = Merge(least_docs)
            for entries in merging.run(runs):
                found = merging.frequencies(entries)
                if found.num_rows:
                    yield found

    dealt = runs.repartition(shards, "shard").sortWithinPartitions("shard", "run", "nth")
    return dealt.mapInArrow(merge, MERGED)


def _share(n: str, total: str, terms: str) -> Column:
    """1 + floor(10^9 * (n + 5) / (total + 5 * terms)) in whole numbers: three digits of base 1,000 by long division.

    Exact while total + 5 * terms stays below 9 * 10^15. Where there are no terms, 0.
    """
    bottom = f"({total} + 5 * {terms})"
    rest, quotient = f"({n} + 5)", "0L"
    for _ in range(3):
        quotient = f"({quotient} * 1000 + ({rest} * 1000) div {bottom})"
        rest = f"(({rest} * 1000) % {bottom})"
    return F.expr(f"CASE WHEN {bottom} > 0 THEN {quotient} + 1 ELSE 0L END")


def pair_corrections(present: DataFrame) -> DataFrame:
    """Rows (lang, source, item, fix): what terms that both sources hold change in their difference, summed up.

    `present` has rows (lang, held: array<struct<source, p, p0>>), one per kept term: the shares p of the sources that hold
    it, and the share p0 that each gives a term it lacks. A task adds terms up in one matrix per language, and
    sends it on when it has MATRIX entries and when the language changes its sources too often to fit.
    """
    schema = "lang string, source string, item string, fix long"
    fields = arrow_fields(schema)

    def sent(lang: str, numbers: dict[str, int], matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
        names = np.array(list(numbers), dtype=object)
        for i, name in enumerate(names):
            row = matrix[i, : len(names)].copy()
            row[i] = 0
            at = np.flatnonzero(row)
            if len(at):
                yield pa.RecordBatch.from_pydict(
                    {"lang": [lang] * len(at), "source": [name] * len(at), "item": names[at], "fix": row[at]}, schema=fields
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[dict[str, int], np.ndarray]] = {}
        for batch in batches:
            langs, lists = batch.column(0).to_pylist(), batch.column(1)
            values, offsets = lists.values, lists.offsets.to_numpy()
            sources = values.field("source").to_pylist()
            shares, lacking = (values.field(c).to_numpy().astype(np.int64) for c in ("p", "p0"))
            for i, lang in enumerate(langs):
                low, high = offsets[i], offsets[i + 1]
                numbers, matrix = held.get(lang) or ({}, np.zeros((32, 32), dtype=np.int64))
                at = np.array([numbers.setdefault(s, len(numbers)) for s in sources[low:high]])
                if len(numbers) > len(matrix):
                    size = max(2 * len(matrix), len(numbers))
                    grown = np.zeros((size, size), dtype=np.int64)
                    grown[: len(matrix), : len(matrix)] = matrix
                    matrix = grown
                p, p0 = shares[low:high], lacking[low:high]
                one = np.abs(p[:, None] - p0[None, :])
                matrix[np.ix_(at, at)] += (
                    np.abs(p[:, None] - p[None, :]) - one - one.T + np.abs(p0[:, None] - p0[None, :])
                )
                held[lang] = (numbers, matrix)
                if sum(m.size for _, m in held.values()) > MATRIX:
                    for of, (n, m) in held.items():
                        yield from sent(of, n, m)
                    held = {}
        for of, (n, m) in held.items():
            yield from sent(of, n, m)

    parts = present.select("lang", "held").mapInArrow(add, schema)
    return parts.groupBy("lang", "source", "item").agg(F.sum("fix").alias("fix"))


def source_divergence(docs: DataFrame, least_docs: int = 30, most_terms: int = 50, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): how each source of a language differs from the others, and in which terms.

    `pair` rows compare a group (lang, source) with every other source of the language: the sum over the language's kept
    terms of the difference of shares. `term` rows list up to `most_terms` terms whose share in the group is above that in the
    whole language. Nulls in lang, source and text are the empty string; a group without terms still has its rows. Repeated rows count
    each. A table without rows gives none. There are four shards per shuffle partition of the session.
    """
    spark = docs.sparkSession
    folder = work_folder(spark)
    shards = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    clean = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = stored(merged_runs(spilled_runs(clean, shards, block_bytes), shards, least_docs), f"{folder}/kept")

    postings = kept.select("lang", "term", F.inline("sources"))
    totals = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    langs = kept.groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum(F.aggregate("sources", F.lit(0).cast("long"), lambda a, s: a + s["n"])).alias("all")
    )
    # One row per group, also of those without a kept term.
    groups = clean.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "held", "terms", "all")])
    groups = stored(groups.withColumn("p0", _share("0L", "total", "terms")), f"{folder}/groups")

    counted = kept.select(
        "lang", "term", F.aggregate("sources", F.lit(0).cast("long"), lambda a, s: a + s["n"]).alias("of_lang"), F.inline("sources")
    )
    shares = counted.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", "p0", _share("n", "total", "terms").alias("p"), _share("of_lang", "`all`", "terms").alias("q")
    )
    shares = stored(shares, f"{folder}/shares")

    term_rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    above = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = above.withColumn("rank", term_rank).filter(F.col("rank") <= most_terms)

    pairs = _pairs(groups, shares)
    pairs = pairs.withColumn("rank", term_rank)
    named = [
        part.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
        for name, part in (("pair", pairs), ("term", terms))
    ]
    return named[0].unionByName(named[1])


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value) of all ordered pairs of sources of a language."""
    # A share hangs on the count alone, so a group's shares are few numbers with multiplicities.
    spread = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("item_p0"))
    # How far a group's shares lie from what the other gives a term it lacks.
    away = spread.join(other, "lang").filter(F.col("source") != F.col("item"))
    away = away.groupBy("lang", "source", "item").agg(F.sum(F.col("m") * F.abs(F.col("p") - F.col("item_p0"))).alias("away"))
    back = away.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("away").alias("back"))

    held = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("held"))
    fixes = pair_corrections(held.filter(F.size("held") > 1))

    met = groups.join(
        groups.select("lang", F.col("source").alias("item"), F.col("held").alias("item_held"), F.col("p0").alias("item_p0")), "lang"
    ).filter(F.col("source") != F.col("item"))
    keys = ["lang", "source", "item"]
    zero = F.lit(0).cast("long")
    met = met.join(away, keys, "left").join(back, keys, "left").join(fixes, keys, "left")
    neither = (F.col("terms") - F.col("held") - F.col("item_held")) * F.abs(F.col("p0") - F.col("item_p0"))
    value = F.coalesce("away", zero) + F.coalesce("back", zero) + neither + F.coalesce("fix", zero)
    return met.select(*keys, value.alias("value"))
