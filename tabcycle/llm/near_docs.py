"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its five-word shingles; a weight is the shingle's count times its inverse
document frequency. A sample of such a set is equal for two sets with a probability that is their weighted
Jaccard similarity. Samples are banded; documents that share a band are candidates, and candidates are
verified by their exact weighted Jaccard similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabcycle.llm.common import arrow_map, components, parts, stored, texts_of, work_folder, worker_tables

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 20, 5
#: Document frequencies are counted in this many slots that shingles are hashed to: a table of fixed size.
SLOTS, CHUNK = 1 << 18, 1 << 14
#: Bits that index the table of random draws.
DRAWS = 18
SEED = 77
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
U = np.uint64
#: Members of a group that are compared all with all.
FEW = 8


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64 bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> np.ndarray:
    held = worker_tables("near_docs")
    if len(held.get("powers", ())) < n:
        with np.errstate(over="ignore"):
            held["powers"] = np.cumprod(np.full(n, 0x9E3779B97F4A7C15, U), dtype=U)
    return held["powers"]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and the number of words of each text."""
    raw = [text.encode() for text in texts]
    buffer = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    within = ~SPACE[buffer]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], within)).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    limits = np.cumsum([0] + [len(one) + 1 for one in raw])
    counts = np.diff(np.searchsorted(starts, limits))
    if not len(starts):
        return np.zeros(0, U), counts
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    size = 1 << int(place.max()).bit_length()
    terms = (buffer[within].astype(U) + U(1)) * powers(max(size, 64))[place]
    return mix(np.add.reduceat(terms, first)), counts


def shingle_sets(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct shingles (sorted hashes) and their counts.

    A text of fewer than five words is one shingle; one without words has none.
    """
    hashes, counts = word_hashes(texts)
    at = 0
    for n in counts.tolist():
        own = hashes[at : at + n]
        at += n
        width = min(SHINGLE, n)
        if not n:
            yield own, np.zeros(0, np.int64)
            continue
        made = np.zeros(n - width + 1, U)
        for nth in range(width):
            made = made * U(0x100000001B3) + own[nth : nth + len(made)]
        yield np.unique(mix(made + U(width)), return_counts=True)


def slots(hashes: np.ndarray) -> np.ndarray:
    """Slots of hashes, in the order of the hashes."""
    return (hashes >> U(46)).astype(np.int64)


def document_frequencies(docs: DataFrame, folder: str) -> tuple[np.ndarray, int]:
    """Documents per slot, over all documents, and the number of documents.

    Every task counts its rows in a table of fixed size; Spark sums the tables piece by piece in two steps.
    """
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n = np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            for some in parts(texts_of(batch)):
                for hashes, _ in shingle_sets(some):
                    own = slots(hashes)
                    table[own[np.diff(own, prepend=-1) > 0]] += 1
            n += batch.num_rows
        if n:
            pieces = table.reshape(-1, CHUNK)
            yield pa.RecordBatch.from_pydict(
                {
                    "piece": pa.array(range(len(pieces)), pa.int32()),
                    "counts": [piece.tobytes() for piece in pieces],
                    "docs": pa.array([n] * len(pieces), pa.int64()),
                }
            )

    def add(batch: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, np.int64)
        for one in batch.column("counts").to_pylist():
            total += np.frombuffer(one, np.int64)
        piece = batch.column("piece")[0].as_py()
        n = sum(batch.column("docs").to_pylist())
        return pa.table({"piece": pa.array([piece], pa.int32()), "counts": [total.tobytes()], "docs": [n]})

    schema = "piece int, counts binary, docs bigint"
    made = docs.select("text").mapInArrow(count, schema)
    first = made.withColumn("slice", F.xxhash64("counts") % 256).groupBy("piece", "slice").applyInArrow(add, schema)
    summed = stored(first.groupBy("piece").applyInArrow(add, schema), f"{folder}/frequencies")
    # A table of fixed size: SLOTS counts.
    rows = {row["piece"]: row for row in summed.collect()}
    table = np.ones(SLOTS, np.int64)
    for piece, row in rows.items():
        table[piece * CHUNK : (piece + 1) * CHUNK] = np.frombuffer(row["counts"], np.int64)
    return np.maximum(table, 1), max([row["docs"] for row in rows.values()], default=0)


def idf_table(frequencies: np.ndarray, n: int) -> np.ndarray:
    """Between 1 (in every document) and 1.25 (in one): damped, so that copies of a text that many share stay near."""
    if n < 2:
        return np.ones(len(frequencies), np.float32)
    return (1.0 + 0.25 * np.log(n / np.minimum(frequencies, n)) / np.log(n)).astype(np.float32)


def variates() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Draws of r and c from Gamma(2, 1) that hashes index: r, log c, and log c - r, by which they are ordered."""
    held = worker_tables("near_docs")
    if "variates" not in held:
        rng = np.random.Generator(np.random.PCG64(SEED))
        r = np.maximum(rng.gamma(2.0, 1.0, 1 << DRAWS), 1e-6).astype(np.float32)
        log_c = np.log(rng.gamma(2.0, 1.0, 1 << DRAWS)).astype(np.float32)
        order = np.argsort(log_c - r, kind="stable")
        r, log_c = r[order], log_c[order]
        held["variates"] = r, log_c, log_c - r
    return held["variates"]


def draw(products: np.ndarray, mixed: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The step t and the log of the sampled value of elements, from their hashes under one function.

    The products index r and c; the uniform number comes from `mixed`.
    """
    gamma, log_gamma, _ = variates()
    at = products >> np.uint32(32 - DRAWS)
    r = gamma[at]
    uniform = ((mixed ^ (mixed >> U(32))) * U(0xBF58476D1CE4E5B9) >> U(40)).astype(np.float32) * np.float32(2**-24)
    t = np.floor(logs / r + uniform)
    return t, log_gamma[at] - r * (t - uniform + 1)


def band_keys(
    sets: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray, bands: int = BANDS, rows: int = ROWS, first: int = 1
) -> list[list[int] | None]:
    """Per set the keys of its bands; none for an empty set. `first` is the number of the first sample taken.

    The least value of a set of weight W is below log(8 / W) but for one draw in 3,000, and a value is never
    below log c - r - log w. So one comparison of hashes tells which elements can be the least one; only these
    are drawn. Where none of them is below the bound, the whole set is drawn: samples are the same either way.
    """
    filled = [nth for nth, (hashes, _) in enumerate(sets) if len(hashes)]
    out: list[list[int] | None] = [None] * len(sets)
    if not filled:
        return out
    hashes = np.concatenate([sets[nth][0] for nth in filled])
    counts = np.concatenate([sets[nth][1] for nth in filled])
    sizes = np.array([len(sets[nth][0]) for nth in filled])
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(filled)), sizes)
    weights = counts.astype(np.float32) * idf[slots(hashes)]
    logs = np.log(weights)
    bound = np.log(8.0 / np.add.reduceat(weights.astype(np.float64), starts)).astype(np.float32)
    # Single precision is good to less than the thousandth that is added.
    passed = np.searchsorted(variates()[2], bound[owner] + logs + np.float32(1e-3), side="right")
    limit = ((np.maximum(passed, 1) << (32 - DRAWS)) - 1).astype(np.uint32)
    factors = mix(np.arange(first, first + bands * rows, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)
    keys = np.zeros((len(filled), bands), U)
    high = (hashes >> U(32)).astype(np.uint32)
    products, possible = np.empty_like(high), np.empty(len(high), bool)
    for nth, factor in enumerate(factors):
        np.multiply(high, factor.astype(np.uint32), out=products)
        some = np.flatnonzero(np.less_equal(products, limit, out=possible))
        t, value = draw(products[some], hashes[some] * factor, logs[some])
        best, step = np.zeros(len(filled), np.int64), np.zeros(len(filled), np.float32)
        sure = np.zeros(len(filled), bool)
        if len(some):
            opens = np.concatenate(([True], np.diff(owner[some]) > 0))
            segment = np.cumsum(opens) - 1
            least = np.minimum.reduceat(value, np.flatnonzero(opens))
            hit = np.flatnonzero(value == least[segment])
            hit = hit[np.concatenate(([True], np.diff(segment[hit]) > 0))]
            whose = owner[some[hit]]
            best[whose], step[whose], sure[whose] = some[hit], t[hit], least <= bound[whose]
        for one in np.flatnonzero(~sure):
            own = slice(starts[one], starts[one] + sizes[one])
            t, value = draw(products[own], hashes[own] * factor, logs[own])
            at = int(np.argmin(value))
            best[one], step[one] = starts[one] + at, t[at]
        sample = mix(hashes[best] + step.astype(np.int64).astype(U) * U(0x9E3779B97F4A7C15))
        band = nth // rows
        keys[:, band] = mix(keys[:, band] * U(31) + sample + U(band))
    for nth, row in zip(filled, keys.view(np.int64).tolist(), strict=True):
        out[nth] = row
    return out


def similarity(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, idf: np.ndarray) -> float:
    """Weighted Jaccard of two sets of (sorted hashes, counts)."""
    _, x, y = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    weight = idf[slots(a[x])].astype(np.float64)
    both = float((np.minimum(na[x], nb[y]) * weight).sum())
    all_ = float((na * idf[slots(a)].astype(np.float64)).sum() + (nb * idf[slots(b)].astype(np.float64)).sum())
    return both / (all_ - both) if all_ > both else 1.0


def weight_class(hashes: np.ndarray, counts: np.ndarray, idf: np.ndarray, least: float) -> int:
    """Sets of classes more than one apart differ in weight by more than similar ones can."""
    weight = float((counts * idf[slots(hashes)].astype(np.float64)).sum())
    return int(np.floor(np.log(weight) / -np.log(min(least, 0.99)) + 1e-9)) if weight > 0 else 0


def near_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, folder: str | None = None
) -> DataFrame:
    """(id, component, kept, copies_of): one row per row of the documents.

    `component` is the smallest id that can be reached by links (weighted Jaccard of at least `least`), and
    the row with that id is kept. Equal texts are one class from the start, null and empty texts too; they
    are compared once, by their smallest id. Ids should be distinct and not null: rows of one id share a
    class only by their texts. Texts without words are linked by equality alone.

    A band is first cut by the weight of the sets: similar sets have weights in the same or in neighbouring
    classes, so each set is a member of its own class and the next. A group of few members is compared pair by pair. In
    a larger one all meet a pivot p, a member whose shingles are the most frequent ones. Let E(x) be the weight by which x
    and p differ (its edits) and W the weight of a set. x and y are linked if they differ by at most d * (W(x) + W(y)),
    d = (1 - least) / (1 + least). Both linked to p: they are in one component. If only x is linked to p, then E(y) > d * (W(y) +
    W(p)), and the edits that x and y have in common weigh at least (E(x) + E(y) - d * (W(x) + W(y))) / 2, which is more than
    (E(x) + d * (W(p) - W(x))) / 2. So one of them is among the leading edits of x, those before the rest weighs that
    little. Differences are a metric: E(y) - d * W(y) is at most E(x) + d * W(x), so a y farther away has no such x. If
    neither is linked to p, what x and y have in common weighs at least least * W(x) and least * W(y), so with the
    shingles in one order, seldom ones first, the first common one is where the rest of each still weighs that much. Pairs with such
    an edit or shingle in common, and enough weight from it on, are compared. So no link between components is lost, and those
    who only share samples are not compared.
    """
    folder = folder or work_folder(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["id"]
    idf = idf_table(*document_frequencies(rows, folder))

    def sign(batch: pa.RecordBatch) -> dict:
        keys: list = []
        classes: list = []
        for some in parts(texts_of(batch)):
            sets = list(shingle_sets(some))
            keys += band_keys(sets, idf)
            classes += [weight_class(hashes, counts, idf, least) for hashes, counts in sets]
        index = batch.schema.get_field_index
        return {n: batch.column(index(n)) for n in ("id", "h1", "h2")} | {"bands": keys, "class": classes}

    hashed = rows.select("id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text")
    signed = stored(
        arrow_map(hashed, f"id {kind}, h1 bigint, h2 bigint, bands array<bigint>, class int", sign, "text"), f"{folder}/signed"
    )
    classes = stored(
        signed.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("class").alias("class")),
        f"{folder}/classes",
    )
    members = stored(band_members(classes.select(F.col("rep").alias("id"), "bands", "class")), f"{folder}/members")
    links = linked(rows, members, idf, least, kind, folder)
    named = classes.select("h1", "h2", "rep")
    named = named.join(links, named.rep == links.node, "left").select(
        "h1", "h2", "rep", F.coalesce("component", "rep").alias("component")
    )
    out = signed.select("id", "h1", "h2").join(named, ["h1", "h2"])
    return out.select(
        "id", "component", F.col("id").eqNullSafe(F.col("component")).alias("kept"), F.col("rep").alias("copies_of")
    )


def band_members(banded: DataFrame) -> DataFrame:
    """Rows (key, id, n) of bands with several members, from (id, bands, class): the id stands in its class and the next."""
    near_classes = F.explode(F.array("class", F.col("class") + 1)).alias("class")
    banded = banded.select("id", "bands", near_classes).select("id", "class", F.explode("bands").alias("band"))
    banded = banded.select("id", F.xxhash64("band", "class").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return banded.join(shared, "key").select("key", "id", "n")


def edits(
    own: tuple[np.ndarray, np.ndarray], pivot: tuple[np.ndarray, np.ndarray], idf: np.ndarray, often: np.ndarray, least: float
) -> tuple[np.ndarray, np.ndarray, int, float, float]:
    """Tokens of what tells a set from a pivot, seldom ones first; the weight from each token on; how many tokens
    `near_documents` calls leading; E - d * W and E + d * W of the set.

    A token is a shingle and whether the set has more or less of it. More of a shingle that stands in one document alone
    can be no common edit: it counts in E and has no token. A set too far away to be linked to any that is linked to the
    pivot has no tokens.
    """
    hashes = np.union1d(own[0], pivot[0])
    weight = idf[slots(hashes)].astype(np.float64)
    more = np.zeros(len(hashes))
    more[np.searchsorted(hashes, own[0])] += own[1]
    of_own = float((more * weight).sum())
    more[np.searchsorted(hashes, pivot[0])] -= pivot[1]
    far = np.abs(more) * weight
    total, share = float(far.sum()), (1 - least) / (1 + least)
    of_pivot = of_own - float((more * weight).sum())
    # What rounding may take.
    spare = 1e-6 * (of_own + of_pivot)
    slack, reach = total - share * of_own - spare, total + share * of_own + spare
    if slack > share * (of_pivot + 2 * min(of_own, of_pivot) / least) + spare:
        return np.zeros(0, np.int64), np.zeros(0), 0, slack, reach
    changed = np.flatnonzero(more)
    count = often[slots(hashes[changed])]
    less = more[changed] < 0
    order = np.lexsort((hashes[changed], np.where(less, -count, count), less))
    changed, count, less = changed[order], count[order], less[order]
    common = (total + share * (of_pivot - of_own)) / 2 - spare
    leading = np.cumsum(far[changed][::-1])[::-1] > common
    shown = less | (count > 1)
    leading, changed, less = leading[shown], changed[shown], less[shown]
    tokens = mix(hashes[changed] ^ np.where(less, U(0x5851F42D4C957F2D), U(0)))
    rest = np.cumsum(far[changed][::-1])[::-1]
    return tokens.view(np.int64), rest, int(leading.sum()), slack, reach


def leading_shingles(
    hashes: np.ndarray, counts: np.ndarray, idf: np.ndarray, often: np.ndarray, least: float
) -> tuple[np.ndarray, np.ndarray, float]:
    """Shingles of a set, seldom ones first, while what it holds from there on weighs `least` of it; that weight; the set's.

    Shingles of one document alone weigh, but are not told.
    """
    own = counts * idf[slots(hashes)].astype(np.float64)
    count = often[slots(hashes)]
    order = np.lexsort((hashes, count))
    rest = np.cumsum(own[order][::-1])[::-1]
    total = float(own.sum())
    told = (rest >= least * total * (1 - 1e-6)) & (count[order] > 1)
    return hashes[order][told].view(np.int64), rest[told], total


def linked(rows: DataFrame, members: DataFrame, idf: np.ndarray, least: float, kind: str, folder: str) -> DataFrame:
    """(node, component) of the documents with links."""
    spark = rows.sparkSession
    some = rows.join(members.select("id").distinct(), "id", "left_semi")
    often, _ = document_frequencies(some, f"{folder}/often")

    def weigh(batch: pa.RecordBatch) -> dict:
        sets = [one for part in parts(texts_of(batch)) for one in shingle_sets(part)]
        weights = [counts * idf[slots(hashes)].astype(np.float64) for hashes, counts in sets]
        return {
            "id": batch.column(0),
            "hashes": [hashes.tobytes() for hashes, _ in sets],
            "counts": [counts.astype("<u4").tobytes() if counts.max(initial=0) > 1 else b"" for _, counts in sets],
            "central": [
                float((weight * np.log(often[slots(hashes)])).sum() / max(weight.sum(), 1e-9))
                for (hashes, _), weight in zip(sets, weights, strict=True)
            ],
        }

    vectors = stored(
        arrow_map(some.select("id", "text"), f"id {kind}, hashes binary, counts binary, central double", weigh, "text"),
        f"{folder}/vectors",
    )
    def verify(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"a": [], "b": [], "near": [], "tokens": [], "rest": [], "slack": [], "reach": []}
        columns = [batch.column(n).to_pylist() for n in range(7)]
        for a, b, star, ha, ca, hb, cb in zip(*columns, strict=True):
            x, y = np.frombuffer(ha, U), np.frombuffer(hb, U)
            nx = np.frombuffer(ca, "<u4") if ca else np.ones(len(x))
            ny = np.frombuffer(cb, "<u4") if cb else np.ones(len(y))
            near = similarity(x, nx, y, ny, idf) >= least
            if near or star:
                told = ([], [], None, None)
                if star:
                    tokens, rest, leading, *bounds = edits((y, ny), (x, nx), idf, often, least)
                    # Of those near the pivot only leading edits are asked for.
                    told = (tokens[:leading], rest[:leading], *bounds) if near else (tokens, rest, *bounds)
                for name, value in zip(out, (a, b, near, *told), strict=True):
                    out[name].append(value)
        return out

    def verified(pairs: DataFrame, at: str) -> DataFrame:
        """Links among pairs (a, b, star), and what every b of a star has that its pivot a has not."""
        pairs = stored(pairs, f"{at}/pairs")
        known = vectors.drop("central")
        if pairs.count() <= 20_000:
            # Few pairs, at most twice as many ids: reading their vectors needs no shuffle of the others.
            ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
            known = known.join(F.broadcast(ids), "id", "left_semi")
        left = known.select(F.col("id").alias("a"), F.col("hashes").alias("ha"), F.col("counts").alias("ca"))
        right = known.select(F.col("id").alias("b"), F.col("hashes").alias("hb"), F.col("counts").alias("cb"))
        full = pairs.join(right, "b").join(left, "a").select("a", "b", "star", "ha", "ca", "hb", "cb")
        schema = f"a {kind}, b {kind}, near boolean, tokens array<bigint>, rest array<double>, slack double, reach double"
        return stored(arrow_map(full, schema, verify), f"{at}/found")

    first = verified(star_pairs(members.join(vectors.select("id", "central"), "id")), f"{folder}/stars")
    links = first.filter("near").select("a", "b")
    named = components(links, f"{folder}/stars/graph")
    far = first.filter("NOT near").groupBy(F.col("b").alias("id")).agg(F.collect_set("a").alias("stars"))

    def lead(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"shingles": [], "rest": [], "weight": []}
        for held, many in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            hashes = np.frombuffer(held, U)
            counts = np.frombuffer(many, "<u4") if many else np.ones(len(hashes))
            for name, value in zip(out, leading_shingles(hashes, counts, idf, often, least), strict=True):
                out[name].append(value)
        return {"id": batch.column(0), "stars": batch.column(1)} | out

    sets = vectors.join(far, "id").select("id", "stars", "hashes", "counts")
    schema = f"id {kind}, stars array<{kind}>, shingles array<bigint>, rest array<double>, weight double"
    leads = stored(arrow_map(sets, schema, lead), f"{folder}/leads")
    pairs = edit_pairs(first, named).union(shingle_pairs(leads, named, least)).distinct().withColumn("star", F.lit(False))
    more = verified(pairs, f"{folder}/edits").filter("near").select("a", "b")
    if not more.limit(1).count():
        return named
    # What was joined before stands as stars, so the graph stays as small as its nodes and as shallow.
    joined = named.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(joined.union(more), f"{folder}/edits/graph")


def star_pairs(members: DataFrame) -> DataFrame:
    """(a, b, star) from (key, id, n, central): all pairs of small groups, and a pivot with each other member of large ones."""
    few, many = members.filter(F.col("n") <= FEW), members.filter(F.col("n") > FEW)
    one, other = few.select("key", F.col("id").alias("a")), few.select("key", F.col("id").alias("b"))
    direct = one.join(other, "key").filter("a < b").select("a", "b", F.lit(False).alias("star"))
    pivots = many.groupBy("key").agg(F.max(F.struct("central", "id")).alias("p")).select("key", F.col("p.id").alias("a"))
    stars = many.join(pivots, "key").filter("id <> a").select("a", F.col("id").alias("b"), F.lit(True).alias("star"))
    return direct.union(stars).distinct()


def edit_pairs(found: DataFrame, named: DataFrame) -> DataFrame:
    """(a, b) of different components, one linked to a pivot and one not, that can be linked by the edits they share.

    The edits that two documents share weigh no more than what either has from the first of these on, and that has to
    reach half of what their slacks add up to.
    """
    bounds = found.filter("near").groupBy("a").agg(F.max("reach").alias("farthest"), F.min("slack").alias("lowest"))
    far = found.filter("NOT near AND size(tokens) > 0").join(bounds, "a").filter("slack <= farthest")
    # All that are linked to a pivot are of its component.
    far = far.join(named.select(F.col("node").alias("a"), F.col("component").alias("of_a")), "a")
    far = far.join(named.select(F.col("node").alias("b"), F.col("component").alias("of_b")), "b", "left")
    far = far.filter("of_b IS NULL OR of_b <> of_a")
    shared = F.filter(F.arrays_zip("tokens", "rest"), lambda e: 2 * e["rest"] >= F.col("slack") + F.col("lowest"))

    def spread(rows: DataFrame, edit: Column, mark: str) -> DataFrame:
        rows = rows.select("a", "b", "slack", F.explode(edit).alias("e"))
        named = {"key": F.xxhash64("a", "e.tokens"), "id": F.col("b"), "slack": F.col("slack"), "rest": F.col("e.rest")}
        return rows.select(*[value.alias(f"{name}{mark}") for name, value in named.items()])

    near = found.filter("near").join(far.select("a").distinct(), "a", "left_semi")
    can = (F.col("key") == F.col("key2")) & (2 * F.least("rest", "rest2") >= F.col("slack") + F.col("slack2"))
    pairs = spread(near, F.arrays_zip("tokens", "rest"), "").join(spread(far, shared, "2"), can)
    return pairs.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"))


def shingle_pairs(leads: DataFrame, named: DataFrame, least: float) -> DataFrame:
    """(a, b) of different components, both not linked to a pivot that they met, with a leading shingle in common.

    What two linked sets have in common weighs no more than what either holds from the first common shingle on.
    """
    rows = leads.join(named, F.col("id") == F.col("node"), "left").select(
        "id", "stars", "weight", F.coalesce("component", "id").alias("c"), F.explode(F.arrays_zip("shingles", "rest")).alias("e")
    )
    rows = rows.select(F.col("e.shingles").alias("key"), "id", "stars", "weight", "c", F.col("e.rest").alias("rest"))
    # A shingle of one component alone makes no pair.
    asked = rows.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high").select("key")
    one = rows.join(asked, "key")
    other = one.select(*[F.col(n).alias(f"{n}2") for n in one.columns])
    can = (F.col("key") == F.col("key2")) & (F.col("id") < F.col("id2")) & (F.col("c") != F.col("c2"))
    can &= F.least("rest", "rest2") >= (F.col("weight") + F.col("weight2")) * (least / (1 + least) * (1 - 1e-6))
    can &= F.arrays_overlap("stars", "stars2")
    return one.join(other, can).select(F.col("id").alias("a"), F.col("id2").alias("b"))
