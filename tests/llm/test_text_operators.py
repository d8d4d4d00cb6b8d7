"""Dedup, rules, mixing and language ID against brute force, on odd rows and on no rows."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from tabcycle.llm.host_rules import judge_documents, repeat_words
from tabcycle.llm.language_id import identify
from tabcycle.llm.line_dedup import drop_repeated_lines
from tabcycle.llm.mixing import mix, mixed_documents
from tabcycle.llm.near_docs import SLOTS, idf_table, near_documents, shingle_sets, similarity, slots
from tabcycle.llm.private_data import disguised, identifiers, masked, private_spans
from tabcycle.llm.suffix_dedup import drop_repeats, merged, multikey_order
from tabcycle.llm.vector_pairs import CoverTree, near_vectors

SF_DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


def covered(rows):
    """Bytes of each text that lie in 50 bytes of a smaller document."""
    first, out = {}, []
    for key, text in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        raw = (text or "").encode()
        key = -1 if key is None else key
        marks = bytearray(len(raw))
        for at in range(len(raw) - 49):
            if first.setdefault(raw[at : at + 50], key) < key:
                marks[at : at + 50] = b"\1" * 50
        out.append((key, bytes(b for b, m in zip(raw, marks, strict=True) if not m)))
    return Counter((key, hashlib.sha256(kept).hexdigest()) for key, kept in out)


def same_as_covered(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = Counter((-1 if r.id is None else r.id, r.kept_sha256) for r in drop_repeats(docs).collect())
    assert got == covered(rows)


def test_suffix_dedup_on_odd_rows(odd, none):
    same_as_covered(odd)
    assert drop_repeats(none).count() == 0


@tables
def test_suffix_dedup_equals_brute_force(spark):
    same_as_covered(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_a_passage_dealt_over_many_buckets(spark, monkeypatch):
    """A passage in most documents, cut by salted splitters; buckets of a few kilobytes."""
    import random

    from tabcycle.llm import suffix_dedup

    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    hot, warm = text(14), [text(12) for _ in range(4)]
    rows = [(i * 7 % 401, " ".join([text(rng.randint(0, 12)), hot if i % 3 else rng.choice(warm), text(rng.randint(0, 9))])) for i in range(400)]
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 2_000)
    dealt_out = []
    real = suffix_dedup.splitters_of
    monkeypatch.setattr(suffix_dedup, "splitters_of", lambda *a: dealt_out.append(real(*a)) or dealt_out[-1])
    same_as_covered(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    grams = Counter(map(tuple, dealt_out[0][:, :2].tolist()))
    assert grams.most_common(1)[0][1] > 1, "no gram was cut by two splitters"


def test_multikey_order_and_runs():
    rng = np.random.default_rng(3)
    columns = [rng.integers(0, 4, 500).astype(np.uint64) for _ in range(3)]
    order, new = multikey_order(columns)
    rows = list(zip(*[c.tolist() for c in columns], strict=True))
    assert [rows[i] for i in order] == sorted(rows)
    assert new.sum() == len(set(rows))
    assert merged(np.array([5, 0, 4]), np.array([9, 4, 6])) == [(0, 9)]


def near_classes(rows):
    sets = [*shingle_sets([text or "" for _, text in rows])]
    table = np.zeros(SLOTS, np.int64)
    for hashes, _ in sets:
        table[np.unique(slots(hashes))] += 1
    idf = idf_table(np.maximum(table, 1), len(rows))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            equal = (rows[i][1] or "") == (rows[j][1] or "")
            if equal or len(sets[i][0]) and len(sets[j][0]) and similarity(*sets[i], *sets[j], idf) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


@tables
def test_near_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert {r.id: r.component for r in near_documents(docs).collect()} == near_classes(rows)


def test_near_documents_on_odd_rows(odd, none):
    got = near_documents(odd).collect()
    assert len(got) == odd.count()
    named = {r.id: r.component for r in got}
    assert (named[5], named[7], named[8]) == (4, 6, 8)
    assert near_documents(none).count() == 0


def test_line_dedup_on_odd_rows(odd, none):
    kept = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in drop_repeated_lines(odd).collect()}
    assert kept[1][:2] == (2, 1) and kept[2][:2] == (2, 1) and kept[3][:2] == (3, 0)
    assert kept[4] == (1, 0, "") and kept[1][2].startswith("Alpha")
    assert drop_repeated_lines(none).count() == 0


def test_mix_hits_targets_and_repeats_itself(odd, none, spark):
    assert mix(none).count() == 0
    got = mix(odd).collect()
    assert len(got) == odd.count() and all(r.copies * r.size <= 3 * r.size for r in got)
    many = spark.range(4000).selectExpr(
        "id AS doc_id", "repeat('word ', cast(1 + id % 37 AS int)) AS text", "'en' AS lang",
        "if(id % 3 = 0, 'hot', concat('s', id % 7)) AS source",
    )
    first, again = mix(many).collect(), mix(many).collect()
    assert sorted(first) == sorted(again)
    taken, target = Counter(), {}
    for r in first:
        taken[r.source] += r.copies * r.size
        target[r.source] = (r.target, r.source_size)
    assert abs(sum(t for t, _ in target.values()) - sum(s for _, s in target.values())) < 1e-6
    assert all(abs(taken[s] - t) <= 0.03 * t for s, (t, _) in target.items())
    assert mixed_documents(many).count() == sum(r.copies for r in first)
    assert mixed_documents(odd).columns == odd.columns


def test_host_rules(odd, none):
    assert repeat_words("a b c a b c d".split()) == 6
    assert repeat_words(["a"] * 3) == 0
    judged = {r.id: r for r in judge_documents(odd).collect()}
    assert judged[4].base_failed and not judged[4].kept and judged[4].n_words == 0
    assert judged[6].base_failed and judged[3].n_dup_lines == 1
    assert judge_documents(odd).count() == odd.count()
    assert judge_documents(none).count() == 0


def test_a_bad_host_takes_its_documents_along(spark, tmp_path):
    import duckdb

    from tabcycle.llm.sql import SQL

    fine = " ".join(f"word{i}" for i in range(80))
    rows = [(i, "short", f"bad{i % 2}.org") for i in range(40)] + [(100 + i, fine + str(i), f"bad{i % 2}.org") for i in range(6)]
    rows += [(200 + i, fine + str(i), f"good{i % 9}.org") for i in range(90)] + [(300, "short", "good1.org"), (301, fine, "lone.org"), (302, "x", "lone2.org"), (303, fine, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.id: r.kept for r in judge_documents(docs).collect()}
    assert not any(got[100 + i] for i in range(6)) and got[200] and got[301] and not got[302]
    db = duckdb.connect()
    db.register("documents", docs.toPandas())
    names = [d[0] for d in db.execute(SQL["op3_host_rules"]).description]
    assert got == {row[names.index("doc_id")]: row[names.index("kept")] for row in db.execute(SQL["op3_host_rules"]).fetchall()}



@tables
def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = identify(docs, ["doc_id", "lang"]).filter("crc32(cast(doc_id AS string)) % 3 = 1").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_rows(odd, none):
    got = {r.doc_id: r.lang_pred for r in identify(odd, ["doc_id"]).collect()}
    assert got[4] == got[5] == got[9] == "und" and got[8] == "de"
    assert identify(none, ["doc_id"]).count() == 0
    assert {r.lang_pred for r in identify(odd.filter("lang IS NULL"), ["doc_id"]).collect()} == {"und"}


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("write john dot doe at mail dot example dot com now", "email", "john dot doe at mail dot example dot com"),
        ("write john.doe (at) example.com!", "email", "john.doe (at) example.com"),
        ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("at 192[.]168[.]1[.]7 now", "ip", "192[.]168[.]1[.]7"),
        ("plus four nine one five one two three four five six", "phone", "plus four nine one five one two three four five six"),
        ("pay 4539 one four eight eight zero three four three six four six seven", "card",
         "4539 one four eight eight zero three four three six four six seven"),
    ],
)
def test_disguised_identifiers(text, kind, found):
    spans = disguised(text, identifiers(text))
    assert [(k, text[s:e]) for s, e, k in spans] == [(kind, found)]
    assert masked(text, spans) == text.replace(found, f"<{kind}>")


def test_plain_identifiers_and_clean_text(odd, none):
    text = "a.b@c.d+1 x 999.1.1.1; 4111 1111 1111 1111; +49 151 2345678; 1.2.3.4"
    assert [k for *_, k in identifiers(text)] == ["email", "card", "phone", "ip"]
    for clean in ("One of them, at home. The two dots.", "seven eight", "Meet at noon. Dot com is over."):
        assert not identifiers(clean) and not disguised(clean, [])
    assert private_spans(odd).count() == odd.count() and private_spans(none).count() == 0


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 8))
    rows = np.concatenate([base, base[:30] + rng.normal(scale=0.1, size=(30, 8)), base[:5]])
    vectors = [(n, [float(x) for x in row]) for n, row in enumerate(rows)]
    odd = [None, [0.0] * 8, [float("nan")] * 8, [None] * 8, [], [float("inf")] * 8]
    vectors += [(100 + n, v) for n, v in enumerate(odd)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    got = {r.id: r for r in near_vectors(frame, block=16).collect()}
    assert [got[n].n_links for n in range(len(rows))] == (near.sum(1) - 1).tolist()
    names = np.arange(len(rows))
    for _ in range(10):
        names = np.array([names[near[n]].min() for n in range(len(rows))])
    assert [got[n].component for n in range(len(rows))] == names.tolist()
    assert all(got[100 + n].n_links == 0 and got[100 + n].kept for n in range(len(odd)))
    assert near_vectors(frame.limit(0)).count() == 0


def on_circle(degrees, plane):
    rows = np.zeros((len(degrees), 3))
    rows[:, 0], rows[:, plane] = np.cos(np.radians(degrees)), np.sin(np.radians(degrees))
    return rows


@pytest.mark.parametrize("case", ["angles", *range(5)])
def test_leaf_pairs_are_all_that_lie_near(case):
    if case == "angles":
        sample = np.concatenate([on_circle([-79, 79, -37, 37, -9, 9], 1), on_circle([40.2], 2)])
    else:
        sample = np.random.default_rng(case).normal(size=(400, 3))
        sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    tree = CoverTree(sample)
    radii, reach = np.full(len(tree.centres), 0.02), 0.316
    apart = np.linalg.norm(tree.centres[:, None] - tree.centres[None], axis=2)
    x, y = np.nonzero(np.triu(apart <= 2 * radii[0] + reach))
    a, b = tree.leaf_pairs(radii, reach)
    found = set(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True))
    assert found == set(zip(x.tolist(), y.tolist(), strict=True)) and len(found) == len(a)


def test_copies_below_the_limit_are_not_compared_pair_by_pair(spark, tmp_path):
    """A large group whose members share samples, and are mostly no links: as brute force, by few comparisons."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    rows = [(n, " ".join(f"x{rng.randrange(40)}" if rng.random() < 0.02 else word for word in base)) for n in range(400)]
    # Two far ones that are linked to each other alone: by words they both lack and by words they both have.
    odd = base[:20] + [f"y{n}" for n in range(9)] + base[35:]
    rows += [(400, " ".join(odd)), (401, " ".join([*odd, "z"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.component for r in near_documents(docs, folder=str(tmp_path)).collect()}
    assert got == near_classes(rows) and got[401] == 400
    compared = sum(spark.read.parquet(str(path)).count() for path in tmp_path.glob("*/pairs"))
    assert 0 < compared < 20 * len(rows)
