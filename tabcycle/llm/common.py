"""Shared pieces: the stored tables of a job, Arrow maps, connected components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

#: The white space that separates words, as a Java and Python class.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new folder of one job, in the folder that all executors share.

    That is spark.checkpoint.dir. A local master without one uses the warehouse; a cluster without one is refused, since
    its warehouse may be anywhere. What a job writes there stays until the folder is cleared, since its result is read from it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """The rows, written as Parquet and read from there from now on."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, schema: str, each: Callable[[pa.RecordBatch], dict], by: str | None = None) -> DataFrame:
    """Rows made batch by batch; `each` gives the columns of the rows for one batch.

    With `by`, a column of texts, it gets a batch's rows some at a time: up to `AT_ONCE` characters and the text that goes
    beyond. What it makes of these is sent before the next are read, so its memory does not follow the size of a batch.
    """
    fields = arrow_fields(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in row_parts(batch, by) if by else [batch]:
                if rows.num_rows:
                    yield pa.RecordBatch.from_pydict(each(rows), schema=fields)
                if by:
                    give_back()
        batch = rows = None
        give_back()

    return df.mapInArrow(run, schema)


def arrow_fields(schema: str) -> pa.Schema:
    return to_arrow_schema(_parse_datatype_string(schema))


#: What this Python worker keeps between batches and tasks: the tables of one operator at a time.
_TABLES: dict[str, dict] = {}


def worker_tables(operator: str) -> dict:
    """The tables that an operator keeps in a Python worker.

    Spark reuses workers for whatever comes next. An operator that asks for its tables has those of all others
    dropped, so a worker holds what one operator needs, and not the sum over a job.
    """
    if operator not in _TABLES:
        _TABLES.clear()
        gc.collect()
        give_back()
        _TABLES[operator] = {}
    return _TABLES[operator]


def give_back() -> None:
    """Give freed memory back to the system.

    Allocators keep what a large batch took for the next one, and Spark keeps idle workers: beside a step that runs no
    Python, that memory would count against the executor all the same.
    """
    pa.default_memory_pool().release_unused()
    # Of the GNU C library; others have no such call.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


#: Characters of text that are in work at one time.
AT_ONCE = 1_000_000


def parts(texts: list[str], at_once: int = AT_ONCE) -> Iterator[list[str]]:
    """The texts, some at a time: up to `at_once` characters and the text that goes beyond."""
    first, size = 0, 0
    for nth, text in enumerate(texts):
        size += len(text)
        if size >= at_once or nth == len(texts) - 1:
            yield texts[first : nth + 1]
            first, size = nth + 1, 0


def row_parts(batch: pa.RecordBatch, by: str, at_once: int = AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The batch's rows, some at a time, with the borders that `parts` gives the texts in column `by`; nothing is copied."""
    sizes = pc.fill_null(pc.utf8_length(batch.column(by)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first, before = 0, 0
    while first < batch.num_rows:
        last = min(int(np.searchsorted(ends, before + at_once)), batch.num_rows - 1)
        yield batch.slice(first, last + 1 - first)
        first, before = last + 1, int(ends[last])


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def hex_slice(value: Column, slices: int) -> Column:
    """A slice number from the md5 of a value: the same in any engine."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 8), 16, 10).cast("long") % slices


def components(edges: DataFrame, folder: str, most: int = 60) -> DataFrame:
    """(node, component) of an undirected graph given as edges (a, b).

    A component is named after its smallest node. Every round each node takes the smallest name
    among its neighbours and its own, then the name of that name, so names travel twice as far each
    round. Rounds are stored tables, so a lost executor costs one round. It stops when a round
    changes nothing.
    """
    spark = edges.sparkSession
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{folder}/edges",
    )
    names = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")),
        f"{folder}/names-0",
    )
    for step in range(1, most + 1):
        heard = both.join(names, both.b == names.node).groupBy(F.col("a").alias("n")).agg(F.min("component").alias("m"))
        nearer = names.join(heard, names.node == heard.n, "left").select(
            "node", F.least("component", F.coalesce("m", "component")).alias("c"), F.col("component").alias("old")
        )
        via = names.select(F.col("node").alias("via"), F.col("component").alias("up"))
        after = nearer.join(via, nearer.c == via.via, "left").select(
            "node", F.least("c", F.coalesce("up", "c")).alias("component"), "old"
        )
        after = stored(after, f"{folder}/names-{step}")
        changed = after.filter("component <> old").limit(1).count()
        names = after.select("node", "component")
        if not changed:
            return names
    raise RuntimeError(f"components did not settle in {most} rounds")
