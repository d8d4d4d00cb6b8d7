"""Exact repeats of 50 bytes and more, by a sparse suffix array over all documents.

Suffixes are sorted by range: sampled splitters deal them by their leading tokens (8 bytes each) to buckets,
each bucket sorts its own by multikey quicksort, and groups that a splitter cuts are compared across the
border. Not every suffix is needed: of the 35 places in a 50-byte string where 16 bytes begin, those with
the least hash are the same in every copy of the string, so it is enough to sort the suffixes that begin at
such places. Suffixes whose first two tokens stand in one document alone are dropped; the others come back
with the bytes around them, are dealt and sorted again, and show for each 50-byte string the smallest document with
it. Splitters hold a salt of the document too, so a passage that many documents share is dealt over many buckets; for
such passages buckets tell each other the smallest document of each string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabcycle.llm.common import arrow_fields, stored, texts_of, work_folder

WINDOW, GRAM = 50, 16
#: Places in a window where a gram begins.
PLACES = WINDOW - GRAM + 1
LEFT = WINDOW - GRAM
AROUND = LEFT + WINDOW
U = np.uint64
#: Stands for a null id: smaller than any other.
NULL_ID = -(1 << 63)
#: Bytes of text per bucket, bytes in work at one time, and documents that the splitters are drawn from: so many at
#: least, and one for every second bucket, which gives a bucket some ten of the sampled suffixes however many there are.
BUCKET_BYTES, AT_ONCE, SAMPLE = 16_000_000, 400_000, 2_000
CODEC = pa.Codec("zstd", compression_level=1)


def blocks(raw: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first, texts) of about AT_ONCE bytes."""
    first, size = 0, 0
    for nth, one in enumerate(raw):
        size += len(one)
        if size >= AT_ONCE or nth == len(raw) - 1:
            yield first, raw[first : nth + 1]
            first, size = nth + 1, 0


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best of `width` values from each place on; shorter by width - 1."""
    out, have = values, 1
    while have * 2 <= width:
        out = best(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return best(out[:-rest], out[rest:]) if rest else out


def tokens(buffer: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as a number that sorts like them; shorter by 7."""
    out = buffer.astype(U)
    for half in (1, 2, 4):
        out = (out[:-half] << U(8 * half)) | out[half:]
    return out


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, first token, second token) of the suffixes that stand for all others."""
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(buffer) < WINDOW:
        return none, none, none.astype(U), none.astype(U)
    lengths = np.array([len(one) for one in texts])
    ends = np.cumsum(lengths)
    eight = tokens(buffer)
    first, second = eight[:-8], eight[8:]
    rank = first * U(0x9E3779B97F4A7C15) ^ second * U(0xC2B2AE3D27D4EB4F)
    rank = ((rank ^ (rank >> U(29))) * U(0xBF58476D1CE4E5B9)) | U(1)
    least = sliding(rank, PLACES, np.minimum)
    # Windows that reach over the end of a text count for nothing.
    for end in ends[:-1].tolist():
        least[max(0, end - WINDOW + 1) : end] = 0
    padded = np.zeros(len(rank) + PLACES - 1, U)
    padded[PLACES - 1 : PLACES - 1 + len(least)] = least
    at = np.flatnonzero(sliding(padded, PLACES, np.maximum)[: len(rank)] == rank)
    text = np.searchsorted(ends, at, side="right")
    return text, at - (ends - lengths)[text], first[at], second[at]


def salt(ids: np.ndarray) -> np.ndarray:
    """Spreads the documents of one gram."""
    return (ids.astype(U) * U(0x9E3779B97F4A7C15)) >> U(48)


def bucket_of(splitters: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """The range each suffix lies in; `splitters` are rows of (first token, second token, salt), in order."""
    low = np.searchsorted(splitters[:, 0], keys[0], "left")
    high = np.searchsorted(splitters[:, 0], keys[0], "right")
    out = low.copy()
    for nth in np.unique(np.concatenate([low[low < high], high[low < high] - 1])) if (low < high).any() else []:
        # All splitters that share their first token with this one.
        same = np.flatnonzero(splitters[:, 0] == splitters[nth, 0])
        rows = np.flatnonzero((low < high) & (keys[0] == splitters[nth, 0]))
        out[rows] = same[0]
        for one in same:
            beyond = keys[1][rows] > splitters[one, 1]
            if len(keys) > 2:
                beyond |= (keys[1][rows] == splitters[one, 1]) & (keys[2][rows] >= splitters[one, 2])
            else:
                beyond |= keys[1][rows] == splitters[one, 1]
            out[rows] += beyond
    return out


def multikey_order(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by their columns, and which row of the order begins a new group.

    Rows are sorted by the first column; only runs of equal rows are then sorted by the next one.
    """
    order = np.argsort(columns[0], kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = columns[0][order][1:] != columns[0][order][:-1]
    for column in columns[1:]:
        run = np.cumsum(new)
        open_ = np.flatnonzero(~new | np.append(~new[1:], False))
        if not len(open_):
            break
        values = column[order[open_]]
        inner = np.lexsort((values, run[open_]))
        order[open_] = order[open_][inner]
        values, groups = values[inner], run[open_]
        new[open_[1:]] |= (values[1:] != values[:-1]) & (groups[1:] == groups[:-1])
    return order, new


def pack_columns(*columns: np.ndarray) -> bytes:
    """Columns byte plane by byte plane, compressed."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns]
    raw = b"".join(planes)
    return len(raw).to_bytes(8, "little") + CODEC.compress(raw, asbytes=True)


def unpack_columns(blob: bytes, kinds: list) -> list[np.ndarray]:
    raw = CODEC.decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    kinds = [np.dtype(kind) for kind in kinds]
    n, at, out = len(raw) // sum(kind.itemsize for kind in kinds), 0, []
    for kind in kinds:
        size = n * kind.itemsize
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind)[:, 0])
        at += size
    return out


def dealt(part: np.ndarray, *columns: np.ndarray) -> dict:
    """Rows (part, blob): the columns' rows of each part."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else []
    ends = np.append(starts[1:], len(part)) if len(part) else []
    rows: dict[str, list] = {"part": [], "blob": []}
    for start, end in zip(starts, ends, strict=True):
        rows["part"].append(int(part[start]))
        rows["blob"].append(pack_columns(*[column[order[start:end]] for column in columns]))
    return rows


def ids_of(batch: pa.RecordBatch | pa.Table, name: str = "id") -> np.ndarray:
    return np.array([NULL_ID if i is None else i for i in batch.column(name).to_pylist()], np.int64)


def document_part(ids: np.ndarray, parts: int) -> np.ndarray:
    return ((ids.astype(U) * U(0xD6E8FEB86659FD93)) >> U(33)).astype(np.int64) % parts


SUFFIX = [U, U, np.int64, np.uint32]
DEALT = "part int, blob binary"
DEALT_FIELDS = pa.schema([("part", pa.int32()), ("blob", pa.binary())])


def splitters_of(rows: DataFrame, documents: int, buckets: int) -> np.ndarray:
    """Splitters from the anchors of a bounded sample of documents; they decide balance, not results."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raw = ids_of(batch), [text.encode() for text in texts_of(batch)]
            for first, some in blocks(raw):
                text, _, one, two = anchors(some)
                keep = np.flatnonzero((one * U(0x9E3779B97F4A7C15)) >> U(61) == 0)
                keys = np.stack([one[keep], two[keep], salt(ids[first + text[keep]])], axis=1)
                yield pa.RecordBatch.from_pydict({"keys": [keys.tobytes()]})

    share = min(1.0, max(SAMPLE, buckets / 2) / max(documents, 1))
    found = rows.sample(share, seed=1).mapInArrow(draw, "keys binary").collect()
    keys = np.concatenate([np.zeros((0, 3), U), *[np.frombuffer(r["keys"], U).reshape(-1, 3) for r in found]])
    keys = np.unique(keys[np.lexsort((keys[:, 2], keys[:, 1], keys[:, 0]))], axis=0)
    if not len(keys):
        return keys
    return np.unique(keys[(np.arange(1, buckets) * len(keys)) // buckets], axis=0)


def shared_suffixes(rows: DataFrame, splitters: np.ndarray, parts: int) -> DataFrame:
    """(bucket, part, blob, edge, first and last gram): suffixes whose gram stands in several documents.

    A bucket's first and last group, when one document alone holds it in that bucket, comes with `edge`
    set: the bucket beside it may hold the same gram of other documents.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raw = ids_of(batch), [text.encode() for text in texts_of(batch)]
            made = [(first, *anchors(some)) for first, some in blocks(raw)]
            owner = ids[np.concatenate([first + text for first, text, *_ in made]).astype(np.int64)]
            place = np.concatenate([place for _, _, place, _, _ in made]).astype(np.uint32)
            one, two = (np.concatenate([m[n] for m in made]) for n in (3, 4))
            order = np.argsort(one, kind="stable")
            owner, place, one, two = owner[order], place[order], one[order], two[order]
            bucket = bucket_of(splitters, one, two, salt(owner)) if len(splitters) else np.zeros(len(one), np.int64)
            if len(one):
                yield pa.RecordBatch.from_pydict(dealt(bucket, one, two, owner, place), schema=DEALT_FIELDS)

    fields = arrow_fields(
        "bucket int, part int, blob binary, edge int, low1 bigint, low2 bigint, high1 bigint, high2 bigint"
    )

    def group(table: pa.Table) -> pa.Table:
        bucket = table.column("part")[0].as_py()
        columns = zip(*[unpack_columns(blob, SUFFIX) for blob in table.column("blob").to_pylist()], strict=True)
        one, two, owner, place = (np.concatenate(c) for c in columns)
        order, new = multikey_order([one, two])
        one, two, owner, place = one[order], two[order], owner[order], place[order]
        starts = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        several = (np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts))[run]
        ends = (int(one[0]), int(two[0]), int(one[-1]), int(two[-1]))
        edge = np.where(several, 0, (run == 0) * 1 + (run == run[-1]) * 2)
        rows: dict[str, list] = {name: [] for name in fields.names}
        for kind in range(4):
            keep = np.flatnonzero(edge == kind) if kind else np.flatnonzero(several)
            out = dealt(document_part(owner[keep], parts), owner[keep], place[keep])
            for part, blob in zip(out["part"], out["blob"], strict=True):
                for name, value in zip(fields.names, (bucket, part, blob, kind, *map(signed, ends)), strict=True):
                    rows[name].append(value)
        if not rows["bucket"]:
            rows = {n: [v] for n, v in zip(fields.names, (bucket, -1, b"", 0, *map(signed, ends)), strict=True)}
        return pa.table(rows, schema=fields)

    schema = "bucket int, part int, blob binary, edge int, low1 long, low2 long, high1 long, high2 long"
    return rows.mapInArrow(find, DEALT).groupBy("part").applyInArrow(group, schema)


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def across_borders(found: DataFrame) -> DataFrame:
    """The suffixes of `found`, those at an edge only where the bucket beside it has the same gram.

    The table of borders has one row per bucket.
    """
    borders = {
        row["bucket"]: row
        for row in found.select("bucket", "low1", "low2", "high1", "high2").distinct().collect()
    }
    order = sorted(borders)
    keep = []
    for before, after in zip(order, order[1:], strict=False):
        low, high = borders[after], borders[before]
        if (low["low1"], low["low2"]) == (high["high1"], high["high2"]):
            # Documents of one gram lie in one bucket each, so two buckets are two documents.
            keep += [(before, 2), (before, 3), (after, 1), (after, 3)]
    kept = found.sparkSession.createDataFrame(sorted(set(keep)) or [(-1, -1)], "bucket int, edge int")
    inner = found.filter("edge = 0 AND part >= 0")
    edges = found.filter("edge > 0").join(F.broadcast(kept), ["bucket", "edge"], "left_semi")
    return inner.select("part", "blob").union(edges.select("part", "blob"))


AROUND_KIND = np.dtype((np.void, AROUND))


def surroundings(text: bytes, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes around suffixes, and how many of the LEFT ones before and WINDOW ones after are there."""
    buffer = np.zeros(len(text) + AROUND, np.uint8)
    buffer[LEFT : LEFT + len(text)] = np.frombuffer(text, np.uint8)
    cut = np.lib.stride_tricks.sliding_window_view(buffer, AROUND)[places]
    return cut, np.minimum(places, LEFT).astype(np.uint8), np.minimum(len(text) - places, WINDOW).astype(np.uint8)


def repeated_windows(around: np.ndarray, left: np.ndarray, right: np.ndarray, owner: np.ndarray) -> tuple:
    """For each row the first and last window (or -1) that a smaller document has too.

    Windows of one row overlap, so what they cover is one run of bytes. Hashes find equal windows, bytes
    confirm them.
    """
    n = len(around)
    base = U(0x100000001B3)
    sums = np.zeros((AROUND + 1, n), U)
    for nth in range(AROUND):
        sums[nth + 1] = sums[nth] * base + (around[:, nth].astype(U) + U(1))
    with np.errstate(over="ignore"):
        shift = U(1)
        for _ in range(WINDOW):
            shift = shift * base
    first, last = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    for nth in range(PLACES):
        rows = np.flatnonzero((left >= LEFT - nth) & (right >= WINDOW - LEFT + nth))
        if len(rows) < 2:
            continue
        window = sums[nth + WINDOW, rows] - sums[nth, rows] * shift
        order = np.lexsort((owner[rows], window))
        rows, window = rows[order], window[order]
        new = np.concatenate(([True], window[1:] != window[:-1]))
        starts = np.flatnonzero(new)
        head = rows[starts][np.cumsum(new) - 1]
        later = owner[rows] > owner[head]
        rows, head = rows[later], head[later]
        if len(rows):
            cut = slice(nth, nth + WINDOW)
            equal = np.concatenate([
                (around[a, cut] == around[b, cut]).all(axis=1)
                for a, b in zip(np.array_split(rows, len(rows) // 100_000 + 1), np.array_split(head, len(rows) // 100_000 + 1), strict=True)
            ])
            rows = rows[equal]
            first[rows] = np.where(first[rows] < 0, nth, first[rows])
            last[rows] = nth
    return first, last


def cut_grams(splitters: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Which rows have a gram that a splitter cuts, so that other buckets may have it too."""
    grams = np.ascontiguousarray(around[:, LEFT : LEFT + GRAM]).view(">u8").astype(U)
    if not len(splitters):
        return np.zeros(len(grams), bool)
    # Few rows share their first token with a splitter; only these are compared in full.
    out = np.isin(grams[:, 0], splitters[:, 0])
    cut = set(map(tuple, splitters[:, :2].tolist()))
    some = np.flatnonzero(out)
    out[some] = [pair in cut for pair in map(tuple, grams[some].tolist())]
    return out


def least_owners(around: np.ndarray, left: np.ndarray, right: np.ndarray, owner: np.ndarray) -> dict[str, list]:
    """Per place of a window around its gram and per window the smallest document: (nth, window, least)."""
    out: dict[str, list] = {"nth": [], "window": [], "least": []}
    for nth in range(PLACES):
        rows = np.flatnonzero((left >= LEFT - nth) & (right >= WINDOW - LEFT + nth))
        if len(rows):
            windows = np.ascontiguousarray(around[rows, nth : nth + WINDOW])
            # By document, then by window without changing that order: the first of a window is its smallest document.
            order = np.argsort(owner[rows], kind="stable")
            order = order[np.argsort(windows[order].view(np.dtype((np.void, WINDOW)))[:, 0], kind="stable")]
            rows, windows = rows[order], windows[order]
            new = np.ones(len(rows), bool)
            new[1:] = (windows[1:] != windows[:-1]).any(axis=1)
            out["nth"] += [nth] * int(new.sum())
            out["window"] += [window.tobytes() for window in windows[new]]
            out["least"] += owner[rows][new].tolist()
    return out


def told_rows(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Windows and their smallest documents elsewhere, as rows that hold this one window each."""
    nth = table.column("nth").to_numpy().astype(np.int64)
    around = np.zeros((len(nth), AROUND), np.uint8)
    windows = np.frombuffer(b"".join(table.column("window").to_pylist()), np.uint8).reshape(len(nth), WINDOW)
    around[np.arange(len(nth))[:, None], nth[:, None] + np.arange(WINDOW)] = windows
    return around, (LEFT - nth).astype(np.uint8), (WINDOW - LEFT + nth).astype(np.uint8), table.column("least").to_numpy()


def removal_runs(
    rows: DataFrame, shared: DataFrame, copies: DataFrame, splitters: np.ndarray, parts: int, folder: str
) -> DataFrame:
    """(part, blob): runs of bytes (document, start, end) that smaller documents have too; they may overlap."""
    tagged = with_part(rows, parts)
    extra = shared.select("part", "blob").union(copies_blobs(copies, parts))

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows or not left.num_rows:
            return pa.table({"part": [], "blob": []}, schema=DEALT_FIELDS)
        owner, place, copied = wanted(right)
        keep = ~np.isin(owner, copied)
        owner, place = owner[keep], place[keep]
        order = np.lexsort((place, owner))
        owner, place = owner[order], place[order]
        made = []
        for key, text in zip(ids_of(left), texts_of(left), strict=True):
            low, high = np.searchsorted(owner, key, "left"), np.searchsorted(owner, key, "right")
            if high > low:
                raw = text.encode()
                places = place[low:high][place[low:high] < len(raw)].astype(np.int64)
                made.append((np.full(len(places), key), places.astype(np.uint32), *surroundings(raw, places)))
        if not made:
            return pa.table({"part": [], "blob": []}, schema=DEALT_FIELDS)
        owner, place, around, before, after = (np.concatenate(c) for c in zip(*made, strict=True))
        grams = np.ascontiguousarray(around[:, LEFT : LEFT + GRAM]).view(">u8").astype(U)
        order, _ = multikey_order([grams[:, 0], grams[:, 1]])
        owner, place, before, after = owner[order], place[order], before[order], after[order]
        around, grams = np.ascontiguousarray(around[order]), grams[order]
        bucket = bucket_of(splitters, grams[:, 0], grams[:, 1], salt(owner)) if len(splitters) else np.zeros(len(owner), np.int64)
        # Byte planes would hide that rows in order begin alike, so these go row by row.
        packed = around.view(AROUND_KIND)[:, 0]
        return pa.table(dealt_around(bucket, packed, owner, place, before, after), schema=DEALT_FIELDS)

    around = tagged.groupBy("part").cogroup(extra.groupBy("part")).applyInArrow(cut, DEALT)

    def read_rows(table: pa.Table) -> tuple[np.ndarray, ...]:
        made = [read_around(blob) for blob in table.column("blob").to_pylist()]
        around, owner, place, before, after = (np.concatenate(c) for c in zip(*made, strict=True))
        return np.frombuffer(around.tobytes(), np.uint8).reshape(-1, AROUND), owner, place, before, after

    def runs_of(around: np.ndarray, owner: np.ndarray, place: np.ndarray, before: np.ndarray, after: np.ndarray, told: tuple | None = None) -> dict:
        n = len(owner)
        if told:
            around, before, after, owner = (np.concatenate(pair) for pair in zip((around, before, after, owner), told, strict=True))
        first, last = repeated_windows(around, before, after, owner)
        hit = np.flatnonzero(first[:n] >= 0)
        start = place[hit].astype(np.int64) - LEFT + first[hit]
        end = place[hit].astype(np.int64) - LEFT + last[hit] + WINDOW
        return dealt(document_part(owner[hit], parts), owner[hit], start.astype(np.uint32), end.astype(np.uint32))

    fields = arrow_fields("part int, blob binary, open boolean")

    def resolve(table: pa.Table) -> pa.Table:
        """Runs of grams that lie in this bucket alone; the rows of the others as they are, marked as open."""
        bucket = table.column("part")[0].as_py()
        around, *columns = read_rows(table)
        cut = cut_grams(splitters, around)
        out = runs_of(around[~cut], *[c[~cut] for c in columns])
        out["open"] = [False] * len(out["part"])
        if cut.any():
            rest = np.ascontiguousarray(around[cut]).view(AROUND_KIND)[:, 0]
            held = dealt_around(np.full(len(rest), bucket), rest, *[c[cut] for c in columns])
            out = {name: out[name] + held[name] for name in ("part", "blob")} | {"open": out["open"] + [True] * len(held["part"])}
        return pa.table(out, schema=fields)

    schema = "part int, blob binary, open boolean"
    first = stored(around.groupBy("part").applyInArrow(resolve, schema), f"{folder}/resolved")
    held = first.filter("open").select("part", "blob")

    def least(table: pa.Table) -> pa.Table:
        around, owner, _, before, after = read_rows(table)
        out = least_owners(around, before, after, owner)
        return pa.table({"part": [table.column("part")[0].as_py()] * len(out["nth"])} | out, schema=told_fields)

    told_schema = "part int, nth int, window binary, least bigint"
    told_fields = arrow_fields(told_schema)
    partial = stored(held.groupBy("part").applyInArrow(least, told_schema), f"{folder}/least")
    # One row per window and bucket that has it: far fewer than the places where it stands.
    minima = partial.groupBy("nth", "window").agg(F.min("least").alias("all"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    told = partial.join(minima, ["nth", "window"]).filter("least > all").select("part", "nth", "window", F.col("all").alias("least"))

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"part": [], "blob": []}, schema=DEALT_FIELDS)
        around, owner, place, before, after = read_rows(left)
        return pa.table(runs_of(around, owner, place, before, after, told_rows(right) if right.num_rows else None), schema=DEALT_FIELDS)

    settled = held.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(settle, DEALT)
    return first.filter("NOT open").select("part", "blob").union(settled)


def dealt_around(part: np.ndarray, around: np.ndarray, *columns: np.ndarray) -> dict:
    rows: dict[str, list] = {"part": [], "blob": []}
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    for start, end in zip(starts, np.append(starts[1:], len(part)), strict=True):
        some = order[start:end]
        raw = around[some].tobytes()
        rest = pack_columns(*[column[some] for column in columns])
        body = CODEC.compress(raw, asbytes=True)
        rows["part"].append(int(part[start]))
        rows["blob"].append(len(some).to_bytes(8, "little") + len(rest).to_bytes(8, "little") + rest + body)
    return rows


def read_around(blob: bytes) -> tuple:
    n, size = int.from_bytes(blob[:8], "little"), int.from_bytes(blob[8:16], "little")
    rest = unpack_columns(blob[16 : 16 + size], [np.int64, np.uint32, np.uint8, np.uint8])
    raw = CODEC.decompress(blob[16 + size :], n * AROUND, asbytes=True)
    return (np.frombuffer(raw, AROUND_KIND), *rest)


def with_part(rows: DataFrame, parts: int) -> DataFrame:
    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = document_part(ids_of(batch), parts).astype(np.int32)
            yield batch.append_column("part", pa.array(part))

    return rows.select("id", "text").mapInArrow(tag, "id bigint, text string, part int")


def copies_blobs(copies: DataFrame, parts: int) -> DataFrame:
    """Ids of the documents whose whole text a smaller document has, as blobs beside the suffixes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = ids_of(batch)
            if len(ids):
                made = dealt(document_part(ids, parts), ids)
                made["blob"] = [b"copy" + blob for blob in made["blob"]]
                yield pa.RecordBatch.from_pydict(made, schema=DEALT_FIELDS)

    return copies.select("id").mapInArrow(pack, DEALT)


def wanted(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    owner, place, copied = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for blob in table.column("blob").to_pylist():
        if blob[:4] == b"copy":
            copied += unpack_columns(blob[4:], [np.int64])
        else:
            a, b = unpack_columns(blob, [np.int64, np.uint32])
            owner.append(a)
            place.append(b)
    return np.concatenate(owner), np.concatenate(place), np.concatenate(copied)


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes; runs that touch are one."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order].astype(np.int64), np.maximum.accumulate(ends[order].astype(np.int64))
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    tops = np.append(np.flatnonzero(new)[1:], len(starts)) - 1
    return list(zip(starts[new].tolist(), ends[tops].tolist(), strict=True))


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, with_text: bool = False
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, spans, kept]) for every row.

    Every byte is removed that lies in a 50-byte string which also starts in a document with a smaller id.
    Strings are those of the input, overlaps count, and no string crosses documents. A null text is empty.
    Ids are whole numbers; a null id is smaller than any other. An id stands for one text: rows that repeat
    a document give the same result each. A document whose text a smaller one has is removed as a whole if it
    has 50 bytes, and takes no part in the sorting. `kept` is the rest as bytes, `spans` the removed runs.
    """
    folder = folder or work_folder(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keys = [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")]
    hashed = stored(rows.select("id", F.octet_length("text").alias("size"), *keys), f"{folder}/texts")
    total = hashed.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    parts = max(4, -(-(total["size"] or 0) // BUCKET_BYTES))
    filled = F.coalesce(F.col("id"), F.lit(NULL_ID))
    same = hashed.filter(F.col("size") >= WINDOW).groupBy("h1", "h2").agg(F.min(filled).alias("least"), F.count(F.lit(1)).alias("n"))
    copies = hashed.join(same.filter("n > 1"), ["h1", "h2"]).filter(filled > F.col("least")).select("id").distinct()
    copies = stored(copies, f"{folder}/copies")
    splitters = splitters_of(rows, total["n"], parts)
    found = stored(shared_suffixes(rows, splitters, parts), f"{folder}/shared")
    runs = stored(removal_runs(rows, across_borders(found), copies, splitters, parts, folder), f"{folder}/runs")
    extra = runs.union(copies_blobs(copies, parts))
    schema = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    if with_text:
        schema += ", spans array<struct<start: bigint, stop: bigint>>, kept binary"
    fields = arrow_fields(schema)

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        owner, starts, ends, copied = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)], set()
        for blob in right.column("blob").to_pylist():
            if blob[:4] == b"copy":
                copied.update(unpack_columns(blob[4:], [np.int64])[0].tolist())
            else:
                for held, column in zip((owner, starts, ends), unpack_columns(blob, [np.int64, np.uint32, np.uint32]), strict=True):
                    held.append(column)
        owner, starts, ends = np.concatenate(owner), np.concatenate(starts), np.concatenate(ends)
        order = np.argsort(owner, kind="stable")
        owner, starts, ends = owner[order], starts[order], ends[order]
        out: dict[str, list] = {name: [] for name in fields.names}
        for key, own, text in zip(ids_of(left).tolist(), left.column("id").to_pylist(), texts_of(left), strict=True):
            raw = text.encode()
            if key in copied:
                spans = [(0, len(raw))]
            else:
                low, high = np.searchsorted(owner, key, "left"), np.searchsorted(owner, key, "right")
                spans = merged(starts[low:high], ends[low:high])
            kept, at = [], 0
            for start, end in spans:
                kept.append(raw[at:start])
                at = end
            left_over = b"".join([*kept, raw[at:]])
            row = (own, len(raw), len(raw) - len(left_over), len(spans), hashlib.sha256(left_over).hexdigest())
            if with_text:
                row += ([{"start": start, "stop": end} for start, end in spans], left_over)
            for name, value in zip(fields.names, row, strict=True):
                out[name].append(value)
        return pa.table(out, schema=fields)

    return with_part(rows, parts).groupBy("part").cogroup(extra.groupBy("part")).applyInArrow(remove, schema)
