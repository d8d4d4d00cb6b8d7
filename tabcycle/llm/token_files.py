"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of many documents, one after the other, in blocks of 128. A block stores the
differences from its minimum at the width that 90 % of them fit in; the higher bits of the rest stand in an
exception list. An index holds where each block starts, so any block can be read alone.

Layout, little-endian: magic, then u64 documents, ids, blocks, bytes of block data; the documents' token
counts (u32); block starts (u64); block data. A block: u32 minimum, u8 width, u8 exceptions; packed
differences; u8 positions and u32 higher bits of the exceptions.
"""

from __future__ import annotations

import contextlib
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabcycle.llm.common import arrow_fields, arrow_map, stored, texts_of, work_folder, worker_tables
from tabcycle.llm.pretokens import PieceIds

MAGIC = b"PFORIDS1"
BLOCK = 128
PERCENTILE = 0.9


def bit_length(values: np.ndarray) -> np.ndarray:
    """Bits of each number below 2**32."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def pack(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows of 128 numbers below 2**width as rows of 2 * width 64-bit words."""
    columns = np.ascontiguousarray(rows.T).astype(np.uint64)
    words = np.zeros((BLOCK * width // 64 + 1, rows.shape[0]), np.uint64)
    for nth, column in enumerate(columns):
        word, shift = divmod(nth * width, 64)
        words[word] |= column << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= column >> np.uint64(64 - shift)
    return np.ascontiguousarray(words[:-1].T)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    columns = np.ascontiguousarray(words.T)
    out = np.zeros((BLOCK, words.shape[0]), np.uint64)
    for nth in range(BLOCK if width else 0):
        word, shift = divmod(nth * width, 64)
        out[nth] = columns[word] >> np.uint64(shift)
        if shift + width > 64:
            out[nth] |= columns[word + 1] << np.uint64(64 - shift)
    return (out & np.uint64((1 << width) - 1)).T.astype(np.uint32)


def block_bytes(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Where blocks start, and the blocks; the last one is filled up with its last id."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), b""
    rows = np.concatenate([ids, np.full(n * BLOCK - len(ids), ids[-1], np.uint32)]).reshape(n, BLOCK)
    least = rows.min(axis=1)
    rest = rows - least[:, None]
    at = int(np.ceil(PERCENTILE * BLOCK)) - 1
    widths = bit_length(np.partition(rest, at, axis=1)[:, at])
    high = rest >> widths[:, None].astype(np.uint32)
    high[widths == 32] = 0
    exceptions = (high > 0).sum(axis=1)
    sizes = 6 + 16 * widths + 5 * exceptions
    starts = np.concatenate([[0], np.cumsum(sizes)])
    data = np.zeros(int(starts[-1]), np.uint8)
    for width in np.unique(widths):
        some = np.flatnonzero(widths == width)
        head = np.zeros((len(some), 6 + 16 * width), np.uint8)
        head[:, :4] = least[some].astype("<u4")[:, None].view(np.uint8)
        head[:, 4], head[:, 5] = width, exceptions[some]
        low = rest[some] & np.uint32((1 << int(width)) - 1)
        if width:
            head[:, 6:] = pack(low, int(width)).astype("<u8").view(np.uint8)
        data[starts[some][:, None] + np.arange(head.shape[1])] = head
    for count in np.unique(exceptions[exceptions > 0]):
        some = np.flatnonzero(exceptions == count)
        row, position = np.nonzero(high[some])
        tail = np.zeros((len(some), 5 * count), np.uint8)
        tail[:, :count] = position.reshape(-1, count)
        tail[:, count:] = high[some][row, position].astype("<u4").reshape(-1, count).view(np.uint8)
        data[(starts[some + 1] - 5 * count)[:, None] + np.arange(5 * count)] = tail
    return starts[:-1].astype(np.uint64), data.tobytes()


def read_blocks(starts: np.ndarray, data: np.ndarray, ids: int) -> np.ndarray:
    """The ids of blocks that lie one after the other."""
    starts = starts.astype(np.int64)
    out = np.zeros((len(starts), BLOCK), np.uint32)
    widths, exceptions = data[starts + 4].astype(np.int64), data[starts + 5].astype(np.int64)
    least = data[starts[:, None] + np.arange(4)].view("<u4")[:, 0]
    for width in np.unique(widths):
        some = np.flatnonzero(widths == width)
        if width:
            body = data[(starts[some] + 6)[:, None] + np.arange(16 * width)]
            out[some] = unpack(body.view("<u8"), int(width))
    for count in np.unique(exceptions[exceptions > 0]):
        some = np.flatnonzero(exceptions == count)
        tail = data[(starts[some] + 6 + 16 * widths[some])[:, None] + np.arange(5 * count)]
        high = np.ascontiguousarray(tail[:, count:]).view("<u4")
        out[some[:, None], tail[:, :count]] |= high << widths[some][:, None].astype(np.uint32)
    return (out + least[:, None]).reshape(-1)[:ids]


def file_bytes(counts: np.ndarray, ids: np.ndarray) -> bytes:
    starts, data = block_bytes(ids)
    head = np.array([len(counts), len(ids), len(starts), len(data)], "<u8")
    return b"".join([MAGIC, head.tobytes(), counts.astype("<u4").tobytes(), starts.astype("<u8").tobytes(), data])


def parse(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The token counts of a file's documents, and all ids."""
    if content[:8] != MAGIC:
        raise ValueError("not a token file")
    documents, ids, blocks, size = (int(n) for n in np.frombuffer(content, "<u8", 4, 8))
    counts = np.frombuffer(content, "<u4", documents, 40)
    starts = np.frombuffer(content, "<u8", blocks, 40 + 4 * documents)
    data = np.frombuffer(content, np.uint8, size, 40 + 4 * documents + 8 * blocks)
    return counts, read_blocks(starts, data, ids)


def read_range(stream, first: int, last: int) -> np.ndarray:
    """Ids first to last (exclusive) of an open file, reading only the blocks that hold them."""
    stream.seek(8)
    documents, ids, blocks, size = (int(n) for n in np.frombuffer(stream.read(32), "<u8"))
    last = min(last, ids)
    if first >= last:
        return np.zeros(0, np.uint32)
    low, high = first // BLOCK, -(-last // BLOCK)
    stream.seek(40 + 4 * documents + 8 * low)
    starts = np.frombuffer(stream.read(8 * (min(high + 1, blocks) - low)), "<u8").astype(np.int64)
    end = size if high == blocks else int(starts[-1])
    stream.seek(40 + 4 * documents + 8 * blocks + int(starts[0]))
    data = np.frombuffer(stream.read(end - int(starts[0])), np.uint8)
    found = read_blocks(starts[: high - low] - starts[0], data, (high - low) * BLOCK)
    return found[first - low * BLOCK : last - low * BLOCK]


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


@contextlib.contextmanager
def written_whole(path: str, attempt: str) -> Iterator[pa.NativeFile]:
    """A stream into a file that is there whole or not at all, whatever attempt of a task writes it."""
    store, at = opened(path)
    store.create_dir(os.path.dirname(at), recursive=True)
    with store.open_output_stream(f"{at}.{attempt}") as out:
        yield out
    store.move(f"{at}.{attempt}", at)


def write_file(path: str, content: bytes, attempt: str) -> None:
    with written_whole(path, attempt) as out:
        out.write(content)


def pieces(path: str, pattern: str) -> PieceIds:
    """One per Python worker. The library gives the ids of every piece; texts are made of pieces.

    The strings of the file's added tokens are pieces too, as they are to the library: a text is cut at them first.
    """
    held = worker_tables("token_files")
    if (path, pattern) not in held:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = list(tokenizer.get_added_tokens_decoder().values())
        if any(token.lstrip or token.rstrip or token.single_word for token in added):
            raise ValueError("added tokens that take in their surroundings are not supported")

        def ids_of(strings: list[str]) -> list[bytes]:
            coded = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
            return [np.array(one.ids, "<u4").tobytes() for one in coded]

        held[path, pattern] = PieceIds(ids_of, pattern, whole=[token.content for token in added])
    return held[path, pattern]


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    pattern: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_ids: int = 8_000_000,
) -> DataFrame:
    """Write the ids of all documents, in ascending order of their ids, into files below `folder`.

    Returns (part, nth, path, keys, documents, tokens): one row per file. Documents are dealt by ranges of
    their id (null first; equal ids by their text), a task writes its range in files of at most about
    `most_ids` ids. A null or empty text is the end id alone; an empty table writes no file.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    parts = max(1, rows.rdd.getNumPartitions())
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    end = np.array([end_id], "<u4").tobytes()
    kind = dict(rows.dtypes)["id"]
    names = ["part", "nth", "path", "ids", "documents", "tokens"]
    schema = f"part int, nth int, path string, ids array<{kind}>, documents bigint, tokens bigint"
    fields = arrow_fields(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), f"try-{task.taskAttemptId()}"
        coder = pieces(tokenizer, pattern)
        held, keys, size, nth = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/ids-{part:06d}-{nth:04d}.pfor"
            counts = np.array([len(one) // 4 for one in held])
            write_file(path, file_bytes(counts, np.frombuffer(b"".join(held), "<u4")), attempt)
            row = (part, nth, path, keys, len(held), int(counts.sum()))
            return pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, row, strict=True)}, schema=fields)

        for batch in batches:
            own = batch.column(0).to_pylist()
            for key, ids in zip(own, coder.texts(texts_of(batch)), strict=True):
                held.append(ids + end)
                keys.append(key)
                size += len(ids) // 4 + 1
                if size >= most_ids:
                    yield flush()
                    held, keys, size, nth = [], [], 0, nth + 1
        if held:
            yield flush()

    return dealt.mapInArrow(run, schema)


def read_tokens(files: DataFrame, each: Callable[[np.ndarray], dict], fields: str) -> DataFrame:
    """(id, start, n_tokens, and what `each` makes of a document's ids) for the documents of the files.

    A file's place among all ids is the sum of the files before it; there is one row per file.
    """
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    # Three numbers per file pass this one task; the documents' ids do not.
    starts = files.select("part", "nth", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    placed = files.select("part", "nth", "path", "ids").join(starts, ["part", "nth"])
    tasks = placed.select("path", "ids", "start").repartition(max(1, files.count()), "path")
    kind = dict(files.dtypes)["ids"][len("array<") : -1]
    extra = [part.split()[0] for part in fields.split(",")]

    def read(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {name: [] for name in ["id", "start", "n_tokens", *extra]}
        for path, keys, start in zip(*[batch.column(n).to_pylist() for n in range(3)], strict=True):
            store, at = opened(path)
            with store.open_input_stream(at) as stream:
                counts, ids = parse(stream.read())
            ends = np.cumsum(counts.astype(np.int64))
            out["id"] += keys
            out["start"] += (start + ends - counts).tolist()
            out["n_tokens"] += counts.tolist()
            for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
                for name, value in each(ids[end - count : end]).items():
                    out[name].append(value)
        return out

    return arrow_map(tasks, f"id {kind}, start bigint, n_tokens bigint, {fields}", read)


def crc(ids: np.ndarray) -> dict:
    return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}


def token_digests(
    docs: DataFrame, tokenizer: str, pattern: str, end_id: int = 2, folder: str | None = None, **columns: str
) -> DataFrame:
    """(id, start, n_tokens, ids_crc32), read back from the files written for all documents."""
    folder = folder or work_folder(docs.sparkSession)
    files = stored(write_tokens(docs, f"{folder}/ids", tokenizer, pattern, end_id, **columns), f"{folder}/files")
    return read_tokens(files, crc, "ids_crc32 bigint")
