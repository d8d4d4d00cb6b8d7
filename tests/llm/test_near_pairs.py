"""What members of a band have in common: no link is lost, and few rows are made."""

import itertools
import random

import numpy as np
from test_text_operators import near_classes

from tabcycle.llm.near_docs import LEAST, edits, leading_shingles, near_documents, similarity, slots


def found_by(x, y, idf, often):
    """Whether two sets share a leading shingle of enough weight."""
    (a, ra, wa), (b, rb, wb) = leading_shingles(*x, idf, often, LEAST), leading_shingles(*y, idf, often, LEAST)
    _, i, j = np.intersect1d(a, b, return_indices=True)
    return bool((np.minimum(ra[i], rb[j]) >= (wa + wb) * LEAST / (1 + LEAST) * (1 - 1e-6)).any())


def met_by(x, y, pivot, idf, often):
    """Whether a set linked to the pivot and one that is not share an edit of enough weight, and lie near enough."""
    a, ra, leading, sa, reach = edits(x, pivot, idf, often, LEAST)
    b, rb, _, sb, _ = edits(y, pivot, idf, often, LEAST)
    _, i, j = np.intersect1d(a[:leading], b, return_indices=True)
    return bool((2 * np.minimum(ra[i], rb[j]) >= sa + sb).any()) and sb <= reach


def test_linked_sets_share_what_is_spread():
    rng = np.random.default_rng(11)
    idf = rng.uniform(1, 1.25, 1 << 18).astype(np.float32)
    seen = {"both": 0, "one": 0}
    for case in range(60):
        pool = np.unique(rng.integers(0, 2**64, 90, dtype=np.uint64))
        base = np.sort(rng.permutation(pool)[:50])
        usual = rng.choice([1, 1, 1, 2], len(pool))
        sets = []
        for _ in range(14):
            changed = rng.random(len(pool)) < rng.choice([0.01, 0.03, 0.06, 0.1])
            held = np.isin(pool, base) ^ changed
            sets.append((pool[held], (usual + (rng.random(len(pool)) < 0.03))[held]))
        often = np.zeros(1 << 18, np.int64)
        for hashes, _ in sets:
            often[slots(hashes)] += 1
        linked = {(i, j): similarity(*sets[i], *sets[j], idf) >= LEAST for i, j in itertools.permutations(range(14), 2)}
        for (i, j), near in linked.items():
            if not near:
                continue
            assert found_by(sets[i], sets[j], idf, often), case
            seen["both"] += 1
            for p in range(14):
                if p not in (i, j) and linked[i, p] and not linked[j, p]:
                    assert met_by(sets[i], sets[j], sets[p], idf, often), case
                    seen["one"] += 1
    assert min(seen.values()) > 100, seen


def test_documents_of_one_passage_spread_few_rows(spark, tmp_path):
    """A passage that all hold makes them members of large bands; what stands beside it tells most of them apart."""
    rng = random.Random(8)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(80))
    pieces = [" ".join(f"q{rng.randrange(10**6)}" for _ in range(20)) for _ in range(301)]
    rows = [(n, f"{passage} {pieces[n]} {pieces[n + 1]}") for n in range(300)]
    rows += [(300, f"{passage} {pieces[7]} {pieces[8]} end"), (301, f"{passage} {pieces[90]} {pieces[190]}")]
    rows += [(302, f"{passage} {pieces[90]} {pieces[190]} more words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.component for r in near_documents(docs, folder=str(tmp_path)).collect()}
    assert got == near_classes(rows) and got[300] == 7 and got[302] == 301
    spread = [("stars/found", "tokens"), ("leads", "shingles")]
    made = sum(
        spark.read.parquet(str(tmp_path / at)).selectExpr(f"coalesce(sum(size({column})), 0)").first()[0]
        for at, column in spread
        if (tmp_path / at).exists()
    )
    assert 0 < made < 20 * len(rows)
