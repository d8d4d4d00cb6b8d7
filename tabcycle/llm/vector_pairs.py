"""Near-duplicate vectors: exact pairs above a cosine, by a dual traversal of a cover tree.

Vectors are scaled to length 1, so a cosine of at least c is a distance of at most sqrt(2 - 2c). The tree is
fitted on a bounded sample of vectors: nested levels whose radii halve, each node within its parent's radius.
All vectors are then assigned to its leaves, and every node gets its covering radius over all of them. Pairs
of nodes that lie further apart than their covering radii and the distance together are pruned, from the root
down; vectors of the leaf pairs that are left are compared in blocks. Every vector is written into the file of its
block once; a task reads the blocks that it compares from there, so no vector is sent to its partners.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabcycle.llm.common import arrow_fields, arrow_map, components, hex_slice, stored, work_folder
from tabcycle.llm.token_files import opened, written_whole

#: Vectors the tree is fitted on, at most.
SAMPLE = 1024
#: Leaves have this radius or less.
LEAF_RADIUS = 0.25
#: Vectors of one block.
BLOCK = 2048
#: Blocks on each side of one comparing task, at most.
STRIPE = 8
#: Between the two passes that assign vectors to leaves, distances may differ by their rounding.
SLACK = 1e-6


class CoverTree:
    """Centres of the leaves, and for each level the node that a leaf belongs to.

    Level k has radius 2 / 2**k. A node of a level is a sampled vector; it stays one in all finer levels.
    """

    def __init__(self, sample: np.ndarray, leaf_radius: float = LEAF_RADIUS):
        self.levels: list[np.ndarray] = []
        radius, chosen = 2.0, []
        nearest = np.full(len(sample), np.inf)
        while len(sample):
            while nearest.max() > radius:
                far = int(nearest.argmax())
                chosen.append(far)
                nearest = np.minimum(nearest, distances(sample, sample[far : far + 1])[:, 0])
                # Whatever rounding says: so every turn takes another vector, and there are only so many.
                nearest[far] = 0.0
            self.levels.append(np.array(chosen))
            if radius <= leaf_radius:
                break
            radius /= 2
        self.centres = sample[chosen] if len(sample) else sample
        #: By level: the node that each leaf descends from, as a number of that level's nodes. It is found parent by
        #: parent, as leaf_pairs descends, and need not be the level's nearest node to the leaf.
        self.above = [np.arange(len(self.centres))] if self.levels else []
        for level, finer in zip(self.levels[-2::-1], self.levels[:0:-1], strict=True):
            self.above.insert(0, self.assign(sample[level], sample[finer])[self.above[0]])

    @staticmethod
    def assign(nodes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        return distances(vectors, nodes).argmin(axis=1)

    def leaf_pairs(self, radii: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (a <= b) of leaves that may hold vectors within `reach`; `radii` cover the leaves' vectors."""
        a = b = np.zeros(min(1, len(self.centres)), np.int64)
        for level, above in enumerate(self.above):
            # Levels are nested: the nodes of a level are the first leaves.
            centres = self.centres[: len(self.levels[level])]
            cover = np.zeros(len(centres))
            np.maximum.at(cover, above, radii + np.linalg.norm(self.centres - centres[above], axis=1))
            near = [
                np.linalg.norm(centres[x] - centres[y], axis=1) <= cover[x] + cover[y] + reach + SLACK
                for x, y in zip(np.array_split(a, len(a) // 65_536 + 1), np.array_split(b, len(b) // 65_536 + 1), strict=True)
            ]
            near = np.concatenate(near)
            a, b = a[near], b[near]
            if level + 1 < len(self.above):
                # The node above a node of the next level is the one above the leaf with the same vector.
                a, b = children(above[: len(self.levels[level + 1])], a, b)
        return a, b


def children(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of children of pairs of nodes, each pair once."""
    order = np.argsort(parent, kind="stable")
    first = np.searchsorted(parent[order], np.arange(parent.max(initial=0) + 2))
    in_a, in_b = np.diff(first)[a], np.diff(first)[b]
    pair = np.repeat(np.arange(len(a)), in_a * in_b)
    nth = np.arange(len(pair)) - np.repeat(np.cumsum(in_a * in_b) - in_a * in_b, in_a * in_b)
    x, y = order[first[a[pair]] + nth // in_b[pair]], order[first[b[pair]] + nth % in_b[pair]]
    once = (a[pair] != b[pair]) | (x <= y)
    return x[once], y[once]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of unit vectors."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def unit_rows(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    return scaled(values.reshape(len(column), -1))


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows divided by their length. By their largest component first, whose square could over- or underflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def usable(vector: str):
    """Not null, not zero, without null or non-finite components."""
    column = F.col(vector)
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(column, lambda x: x != 0), F.lit(False))


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least_cosine: float = 0.95,
    sample: int = SAMPLE,
    block: int = BLOCK,
    folder: str | None = None,
) -> DataFrame:
    """(id, n_links, component, kept): one row per vector, links being all pairs with cosine >= least_cosine.

    Vectors that are null, zero or hold null or non-finite components link with nothing. Equal vectors are
    compared once: links count all of them. Vectors of several lengths are compared within their length.
    Pairs in doubt in single precision are decided in double precision. Rows need no id of their own: vectors are
    known by 128 bits of hash, and a component is named after its smallest id that is not null (null if it has none). Of
    rows that share this id all are kept.
    """
    folder = folder or work_folder(vectors.sparkSession)
    spark = vectors.sparkSession
    # Components of four bytes stay such wherever vectors are stored.
    number = "float" if dict(vectors.dtypes)[vector_col] == "array<float>" else "double"
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(f"array<{number}>").alias("vector"))
    # Zero has two signs, which hash apart.
    plain = F.transform("vector", lambda x: x + F.lit(0.0).cast(number))
    rows = rows.withColumn("vector", F.when(usable("vector"), plain))
    parts = [F.lpad(F.hex(F.xxhash64(F.lit(n), "vector")), 16, "0") for n in range(2)]
    rows = rows.withColumn("of", F.when(F.col("vector").isNotNull(), F.concat(*parts)))
    same = stored(
        rows.filter("of IS NOT NULL").groupBy(F.col("of").alias("rep")).agg(
            F.any_value("vector").alias("vector"), F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies")
        ),
        f"{folder}/distinct",
    )
    sizes = [row["size"] for row in same.select(F.size("vector").alias("size")).distinct().collect()]
    links, edges = [], []
    for size in sizes:
        some = same.filter(F.size("vector") == size)
        found = compared(some, size, least_cosine, sample, block, f"{folder}/size-{size}")
        links.append(found.select("rep", "links"))
        edges.append(found.select(F.explode("joined").alias("b"), F.col("rep").alias("a")))
    if not sizes:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"), F.lit(True).alias("kept"))
    counts = union(links).groupBy("rep").agg(F.sum("links").alias("links"))
    graph = components(union(edges).filter("a <> b").select("a", "b"), f"{folder}/graph")
    judged = (
        same.select("rep", "least_id", "copies").join(counts, "rep", "left")
        .join(graph.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            F.col("rep").alias("of"),
            "least_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("root"),
        )
    )
    judged = stored(judged, f"{folder}/judged")
    names = judged.groupBy("root").agg(F.min("least_id").alias("component"))
    out = rows.select("id", "of").join(judged.join(names, "root").select("of", "n_links", "component"), "of", "left")
    component = F.when(F.col("of").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def compared(same: DataFrame, size: int, least_cosine: float, sample: int, block: int, folder: str) -> DataFrame:
    """(rep, links, joined): per task and vector its links and, enough to connect them, vectors it hangs together with."""
    spark = same.sparkSession
    reach = float(np.sqrt(2.0 - 2.0 * least_cosine))
    # The sample is drawn by hash: the same vectors on every run.
    drawn = same.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("vector").collect()
    points = np.array([row["vector"] for row in drawn], np.float64)
    tree = CoverTree(scaled(points) if len(points) else points)
    centres = tree.centres

    def nearest(unit: np.ndarray) -> np.ndarray:
        return np.concatenate([tree.assign(centres, unit[i : i + 4096]) for i in range(0, len(unit), 4096)])

    def measure(batch: pa.RecordBatch) -> dict:
        unit = unit_rows(batch.column(0))
        leaves = nearest(unit)
        far = np.linalg.norm(unit - centres[leaves], axis=1)
        found, at, counts = np.unique(leaves, return_inverse=True, return_counts=True)
        radii = np.zeros(len(found))
        np.maximum.at(radii, at, far)
        return {"leaf": found.astype(np.int32), "radius": radii, "n": counts}

    def place(batch: pa.RecordBatch) -> dict:
        leaves = nearest(unit_rows(batch.column(1))).astype(np.int32)
        return {"rep": batch.column(0), "vector": batch.column(1), "copies": batch.column(2), "leaf": leaves}

    measured = arrow_map(same.select("vector"), "leaf int, radius double, n bigint", measure)
    per_leaf = measured.groupBy("leaf").agg(F.max("radius").alias("radius"), F.sum("n").alias("n")).collect()
    radii, counts = np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    for row in per_leaf:
        radii[row["leaf"]], counts[row["leaf"]] = row["radius"], row["n"]
    a, b = tree.leaf_pairs(radii, reach)
    # Leaves in the order of the tree fill groups of about one block; a large leaf is several blocks.
    group, pieces, held = np.zeros(len(centres), np.int64), [1], 0
    for leaf in np.lexsort(tuple(tree.above[::-1])):
        if held and held + counts[leaf] > block:
            pieces.append(1)
            held = 0
        group[leaf] = len(pieces) - 1
        held += int(counts[leaf])
        pieces[-1] = max(1, -(-held // block))
    starts = np.concatenate([[0], np.cumsum(pieces)])
    both = np.stack([np.minimum(group[a], group[b]), np.maximum(group[a], group[b])], axis=1)
    pairs = [tuple(pair) for pair in np.unique(both, axis=0).tolist()]
    near = spark.createDataFrame(pairs or [(-1, -1)], "g int, h int")
    shape = spark.createDataFrame(
        [(leaf, int(group[leaf]), int(starts[group[leaf]]), pieces[group[leaf]]) for leaf in range(len(centres))],
        "leaf int, g int, start long, pieces int",
    )
    vector = dict(same.dtypes)["vector"]
    placed = arrow_map(same.select("rep", "vector", "copies"), f"rep string, vector {vector}, copies bigint, leaf int", place)
    # One row per leaf of the bounded tree.
    blocks = (
        placed.join(F.broadcast(shape), "leaf")
        .withColumn("block", F.col("start") + hex_slice(F.col("rep"), 1 << 30) % F.col("pieces"))
        .select("block", "rep", "copies", "vector")
    )
    width = np.dtype("<f4" if vector == "array<float>" else "<f8")
    index = stored(write_blocks(blocks, f"{folder}/vectors", width), f"{folder}/blocks")
    # One row per block.
    where = {row["block"]: (row["path"], row["at"], row["n"]) for row in index.collect()}
    ends = shape.select("g", "start", "pieces").distinct()
    spread = lambda side, name: ends.select(
        F.col("g").alias(side), F.explode(F.sequence(F.col("start"), F.col("start") + F.col("pieces") - 1)).alias(name)
    )
    block_pairs = near.join(spread("g", "x"), "g").join(spread("h", "y"), "h").filter("x <= y").select("x", "y")
    # As many as 32 MB hold, and fewer of a small table, so that there are some tasks.
    stripe = max(1, min(STRIPE, (1 << 25) // (12 * size * block), int(starts[-1]) // STRIPE))
    s, t = (F.floor(F.col(side) / stripe) for side in ("x", "y"))
    tasks = block_pairs.groupBy(s.alias("s"), t.alias("t")).agg(F.collect_list(F.struct("y", "x")).alias("pairs"))
    n_stripes = -(-int(starts[-1]) // stripe)
    tasks = tasks.repartition(min(n_stripes * (n_stripes + 1) // 2, 2000), "s", "t").select("pairs")

    def compare(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"rep": [], "links": [], "joined": []}
        for told in batch.column(0).to_pylist():
            # Block by block of the one side, so that these are read once and one at a time.
            for rep, n, name in linked([(p["x"], p["y"]) for p in told], where, width, size, least_cosine):
                out["rep"].append(rep)
                out["links"].append(n)
                out["joined"].append(name)
        return out

    return stored(arrow_map(tasks, "rep string, links bigint, joined array<string>", compare), f"{folder}/links")


def write_blocks(rows: DataFrame, folder: str, width: np.dtype) -> DataFrame:
    """Write rows (block, rep, copies, vector) into files; gives (block, path, at, n), one row per block.

    A file holds whole blocks one after the other: the names of a block's vectors (16 bytes each), their copies (u64), and
    the vectors. Rows are in order, so any attempt of a task writes the same file.
    """
    dealt = rows.repartition("block").sortWithinPartitions("block", "rep")
    schema = "block bigint, path string, at bigint, n bigint"
    fields = arrow_fields(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        path, attempt = f"{folder}/blocks-{task.partitionId():06d}.bin", f"try-{task.taskAttemptId()}"
        written: list[tuple] = []
        with written_whole(path, attempt) as out:
            for block, parts in blocks_of(batches, width):
                at = out.tell()
                for part in zip(*parts, strict=True):
                    out.write(b"".join(part))
                written.append((block, path, at, sum(len(names) for names, *_ in parts) // 16))
        columns = [list(column) for column in zip(*written, strict=True)] or [[]] * len(fields)
        yield pa.RecordBatch.from_pydict(dict(zip(fields.names, columns, strict=True)), schema=fields)

    return dealt.mapInArrow(run, schema)


def blocks_of(batches: Iterator[pa.RecordBatch], width: np.dtype) -> Iterator[tuple[int, list[tuple]]]:
    """Block by block, from rows in their order: its number and the bytes of its names, copies and vectors, batch by batch."""
    block, parts = None, []
    for batch in batches:
        numbers = batch.column(0).to_numpy(zero_copy_only=False)
        borders = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for first, last in zip(borders, borders[1:], strict=False):
            if first == last:
                continue
            if parts and numbers[first] != block:
                yield block, parts
                parts = []
            block, some = int(numbers[first]), batch.slice(first, last - first)
            names = bytes.fromhex("".join(some.column(1).to_pylist()))
            copies = some.column(2).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
            parts.append((names, copies, some.column(3).flatten().to_numpy(zero_copy_only=False).astype(width).tobytes()))
    if parts:
        yield block, parts


def read_block(where: dict, block: int, width: np.dtype, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, copies and unit vectors of a block."""
    path, at, n = where[block]
    store, name = opened(path)
    with store.open_input_file(name) as stream:
        content = stream.read_at(n * (24 + size * width.itemsize), at)
    names = np.frombuffer(content, "V16", n)
    copies = np.frombuffer(content, "<i8", n, 16 * n)
    vectors = np.frombuffer(content, width, n * size, 24 * n).reshape(n, size)
    return names, copies, scaled(vectors.astype(np.float64))


def linked(pairs: list[tuple[int, int]], where: dict, width: np.dtype, size: int, least: float):
    """(rep, links, [name]) for the vectors of these pairs of blocks that have a link.

    A vector of each group that hangs together names it, and the others are joined with that one: no more than
    one join per vector, however many links there are.
    """
    pairs = sorted((y, x) for x, y in pairs if x in where and y in where)
    blocks = sorted({one for pair in pairs for one in pair})
    first = dict(zip(blocks, np.cumsum([0, *[where[one][2] for one in blocks]]).tolist(), strict=False))
    total = sum(where[one][2] for one in blocks)
    links, root, names = np.zeros(total, np.int64), np.arange(total), np.zeros(total, "V16")
    lefts = {x for _, x in pairs}
    kept: dict[int, tuple] = {}

    def block(one: int) -> tuple:
        if one not in kept:
            of, copies, unit = read_block(where, one, width, size)
            names[first[one] : first[one] + len(of)] = of
            kept[one] = (copies, unit, unit.astype(np.float32))
        return kept[one]

    for nth, (y, x) in enumerate(pairs):
        for i, j, copies, copies2 in block_links(block(x), block(y), x == y, least):
            i2, j2 = i + first[x], j + first[y]
            links += np.bincount(i2, copies2[j], total).astype(np.int64) + np.bincount(j2, copies[i], total).astype(np.int64)
            join(root, i2, j2)
        if y not in lefts and (nth + 1 == len(pairs) or pairs[nth + 1][0] != y):
            del kept[y]
    for at in np.flatnonzero(links).tolist():
        name = [] if root[at] == at else [names[root[at]].tobytes().hex().upper()]
        yield names[at].tobytes().hex().upper(), int(links[at]), name


def block_links(one: tuple, two: tuple, same: bool, least: float, strip: int = 512):
    """(i, j, copies, copies) strip by strip: the linked vectors of two blocks. Single precision tells all but those in doubt."""
    (copies, unit, small), (copies2, unit2, small2) = one, two
    for first in range(0, len(small), strip):
        part = small[first : first + strip] @ small2.T
        x, y = np.nonzero(part >= least - 1e-4)
        told = part[x, y]
        x += first
        if same:
            x, y, told = x[x < y], y[x < y], told[x < y]
        sure = told >= least + 1e-4
        doubt = np.flatnonzero(~sure)
        for some in np.array_split(doubt, len(doubt) // 65_536 + 1):
            sure[some] = np.einsum("ij,ij->i", unit[x[some]], unit2[y[some]]) >= least
        if sure.any():
            yield x[sure], y[sure], copies, copies2


def join(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Put the groups of x and y together, in place: every member's root is the group's least member."""
    while True:
        p, q = root[x], root[y]
        apart = p != q
        if not apart.any():
            return
        x, y, p, q = x[apart], y[apart], p[apart], q[apart]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while ((up := root[root]) != root).any():
            root[:] = up
