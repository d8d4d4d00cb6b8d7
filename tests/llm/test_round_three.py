"""Spelling groups, Merkle fingerprints and source divergence against plain Python."""

import hashlib
import json
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tabcycle.llm.divergence import ENTRIES, Block, Merge, source_divergence
from tabcycle.llm.merkle import edited_neighbours, edited_paragraphs, fingerprints
from tabcycle.llm.spelling import signatures, spelling_groups

SF_DIR = "/root/testdata/sf0.001"


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def spelling_by_hand(docs, least_chars=6, least_count=5, one_in=199, ratio=5):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_chars:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= least_count}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def spelling_rows(df):
    return [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def test_spelling_groups_of_the_test_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = spelling_rows(spelling_groups(docs))
    assert len(got) == len(set(got)) and set(got) == spelling_by_hand([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_spelling_chains_ties_and_odd_rows(spark, odd, none):
    words = ["grandly"] * 200 + ["grandle"] * 30 + ["grindle"] * 5 + ["grantly"] * 30 + ["ÉCLAIRÉ", "Éclairé"] * 5 + ["éclaire"] * 5
    words += ["stones!onsets", "tensor-tensors"] * 6 + ["a" * 30_000] * 5 + ["a" * 29_999] * 5
    rows = [(i % 7 if i % 5 else None, w) for i, w in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS word", "1 AS n", "'y' AS run")
    for one_in in (3, 10**9):
        got = spelling_rows(spelling_groups(docs, one_in=one_in))
        assert len(got) == len(set(got)) and set(got) == spelling_by_hand(rows, one_in=one_in)
    assert ("grindle", "grandle", "grandly", 5, 1, 30) in got
    assert spelling_rows(spelling_groups(none)) == []
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    assert set(spelling_rows(spelling_groups(odd))) == spelling_by_hand(texts)


def test_words_one_edit_apart_share_a_signature():
    import random

    rng = random.Random(7)
    for _ in range(2000):
        word = "".join(rng.choice("abcdeéß") for _ in range(rng.randint(6, 12)))
        i, letter = rng.randrange(len(word)), rng.choice("abcxyzé")
        other = rng.choice([word[:i] + letter + word[i:], word[:i] + letter + word[i + 1 :]])
        keys = signatures([word, other], 6)
        assert set(keys[0]) & set(keys[1]), (word, other)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tree_by_hand(text: str):
    leaves, digests, sections, section = set(), [], [], []
    for paragraph in text.split("\n"):
        phrases, open_words = [], []
        for word in paragraph.split(" "):
            open_words.append(word)
            if hashlib.md5(word.encode()).hexdigest()[0] < "4":
                phrases.append(" ".join(open_words))
                open_words = []
        if open_words:
            phrases.append(" ".join(open_words))
        leaves |= set(phrases)
        digests.append(sha("".join(map(sha, phrases))))
        section.append(digests[-1])
        if digests[-1][0] == "0" or paragraph == "":
            sections.append(sha(" ".join(section)))
            section = []
    if section:
        sections.append(sha(" ".join(section)))
    return leaves, digests, sections, sha("".join(sections))


def alike(a, b):
    weigh = lambda leaves: sum(len(x) + 1 for x in leaves)
    return 2 * weigh(a & b) / (weigh(a) + weigh(b))


def merkle_by_hand(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    found = []
    for (doc_id, text), (_, beside) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, beside = text or "", beside or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + beside[:half]
        own, other, next_tree = tree_by_hand(text), tree_by_hand(edited), tree_by_hand(beside)
        found.append((doc_id, len(text), sha(edited), own[3], other[3], alike(own[0], other[0]), alike(own[0], next_tree[0]),
                      len(own[2]), len(own[1]), len(set(own[2]) & set(other[2])), len(set(own[1]) & set(other[1]))))
    return found


@pytest.mark.parametrize("bucket_chars", [500, 1 << 25])
def test_fingerprints_of_neighbours(spark, odd, none, bucket_chars, monkeypatch):
    monkeypatch.setattr("tabcycle.llm.merkle.with_next.__defaults__", (bucket_chars,))
    rows = [(r.doc_id, r.text) for r in odd.dropDuplicates(["doc_id"]).collect()]
    rows += [(100, "a b c\n\nd e f\n" * 9_000), (101, "word " * 60_000), (102, "y" * 1_000_000), (103, "one"), (2**63 - 1, "z"), (-5, "q r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS key", "'x' AS bucket", "1 AS guard", "'x' AS next_text")
    got = [tuple(r) for r in edited_neighbours(docs).collect()]
    assert sorted(got, key=str) == sorted(merkle_by_hand(rows), key=str)
    assert edited_neighbours(none).count() == 0
    alone = edited_neighbours(spark.createDataFrame([(7, "only one here")], "doc_id long, text string")).first()
    assert alone.near_next == 1.0 and alone.n_chars == 13


def test_repeated_rows_stay_rows(spark, odd):
    assert edited_neighbours(odd).count() == odd.count()
    roots = {r.id: r.fingerprint for r in fingerprints(odd).collect()}
    assert roots[6] == roots[7] and roots[4] == roots[5] and len(set(roots.values())) == len(roots) - 2


def test_merkle_stays_in_the_jvm(spark, odd):
    plan = edited_neighbours(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and "SinglePartition" not in plan.split("Subquery")[0]


def test_edits_are_found_in_differing_branches(spark):
    paragraphs = [f"paragraph {i} with some words of its own, number {i * i}" for i in range(40)]
    changed = [*paragraphs[:11], "put in between", *paragraphs[11:25], paragraphs[25] + " more", *paragraphs[26:39]]
    pairs = spark.createDataFrame([(1, "\n".join(paragraphs), "\n".join(changed)), (2, "same", "same"), (3, None, "")], "k int, a string, b string")
    got = {(r.k, r.side, r.paragraph, r.text) for r in edited_paragraphs(pairs, "a", "b", ["k"]).collect()}
    assert got == {
        (1, "left", 25, paragraphs[25]), (1, "left", 39, paragraphs[39]),
        (1, "right", 11, changed[11]), (1, "right", 26, changed[26]),
    }
    for r in edited_paragraphs(pairs, "a", "b", ["k"]).collect():
        text = "\n".join(paragraphs if r.side == "left" else changed)
        assert text[r.start : r.start + r.length] == r.text


def divergence_by_hand(docs, least_docs, most_terms):
    counts, in_docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        lang, source, text = lang or "", source or "", text or ""
        found = ["".join(c.lower() if c.isascii() else c for c in t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        counts[lang, source].update(found)
        in_docs[lang].update(set(found))
    rows = set()
    for lang in in_docs:
        kept = [t for t, n in in_docs[lang].items() if n >= least_docs]
        groups = {s: c for (of, s), c in counts.items() if of == lang}

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s, c in groups.items():
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(q[t] - p[s][t], t) for t in kept if c[t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found = sorted(found, key=lambda x: (x[0], x[1].encode()))[: most_terms if part == "term" else None]
                rows |= {(lang, s, part, item, -less, i + 1) for i, (less, item) in enumerate(found)}
    return rows


@pytest.mark.parametrize(("least_docs", "most_terms", "block_bytes"), [(1, 3, 1), (2, 50, 4000), (30, 50, 1 << 30), (10**6, 5, 1 << 20)])
def test_source_divergence(spark, odd, none, least_docs, most_terms, block_bytes):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("lang", "source", "text").limit(60)
    more = [("en", "a", "Straße ÉTÉ été 日本 " * 3), ("en", "b", "x" * 1_000_000 + " alpha"), ("", None, None), (None, "", "lone")]
    docs = odd.select("lang", "source", "text").union(table).union(spark.createDataFrame(more, table.schema))
    docs = spark.createDataFrame(docs.collect(), docs.schema).selectExpr("*", "'x' AS term", "'x' AS item", "1 AS n", "'x' AS shard")
    got = [tuple(r) for r in source_divergence(docs, least_docs, most_terms, block_bytes).collect()]
    want = divergence_by_hand([(r.lang, r.source, r.text) for r in docs.collect()], least_docs, most_terms)
    assert len(got) == len(set(got)) and set(got) == want
    assert source_divergence(none).count() == 0


def test_blocks_deal_sorted_runs():
    block = Block()
    block.add(["en", "en", "en"], ["b", "a", "c"], ["Zebra apple apple", "apple zebra", "12 !"])
    block.add(["en"], ["b"], ["apple"])
    [(shard, entries)] = block.runs(1)
    groups = json.loads(entries.schema.metadata[b"groups"])
    rows = [(r["term"], *groups[r["group"]], r["n"], r["docs"]) for r in entries.to_pylist()]
    assert shard == 0 and [r[0] for r in rows] == sorted(r[0] for r in rows)
    assert sorted(rows) == [
        (b"apple", "en", "a", 1, 1), (b"apple", "en", "b", 3, 2), (b"zebra", "en", "a", 1, 1), (b"zebra", "en", "b", 1, 1)
    ]
    assert sum(t.num_rows for _, t in block.runs(7)) == 4 and list(Block().runs(3)) == []


def test_merge_sends_on_what_is_complete(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr("tabcycle.llm.divergence.MERGED_AT_ONCE", 3)

    def packed(rows):
        table = pa.table([list(c) for c in zip(*[(t, 0, n, 1) for t, n in rows])], schema=ENTRIES).replace_schema_metadata({"groups": '[["en", "a"]]'})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        return rows[0][0], sink.getvalue().to_pybytes()

    runs = [[packed([(b"a", 1), (b"c", 1)]), packed([(b"d", 1), (b"z", 1)])], [packed([(b"b", 2), (b"c", 2)]), packed([(b"c2", 2), (b"z", 2)])], [packed([(b"a", 4)])]]
    tables = list(Merge(1).run(runs))
    assert len(tables) > 1
    rows = [(r["term"], r["n"], r["docs"]) for t in tables for r in t.table().to_pylist()]
    assert sorted(rows) == [(b"a", 5, 2), (b"b", 2, 1), (b"c", 3, 2), (b"c2", 2, 1), (b"d", 1, 1), (b"z", 3, 2)]
