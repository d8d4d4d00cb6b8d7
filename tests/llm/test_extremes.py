"""Extreme vectors, wide and hostile private data, added tokens, copies that are alike but not near."""

import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from test_text_operators import near_classes
from tokenizers import Tokenizer

from tabcycle.llm.common import parts, worker_tables
from tabcycle.llm.near_docs import near_documents
from tabcycle.llm.private_data import disguised, identifiers, in_order, luhn, masked
from tabcycle.llm.token_files import token_digests
from tabcycle.llm.vector_pairs import near_vectors

SF_DIR = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")


def test_vectors_of_any_size_and_rows_of_any_id(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 4))
    rows = []
    for scale in (1.0, 1e200, 1e-200, 1e300, 1e-300):
        rows += [(len(rows) + i, [float(x) for x in v * scale]) for i, v in enumerate(base)]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (3, [float(-x) for x in base[0]]), (None, [0.0, 0.0, 0.0, 0.0]), (99, None)]
    rows += [(70, [0.0, 1.0, 0.0, 0.0]), (71, [-0.0, 1.0, 0.0, -0.0]), (72, [float("inf"), 1.0, 0.0, 0.0]), (73, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS rep", "1 AS of", "2 AS root")
    got = sorted([tuple(r) for r in near_vectors(frame).collect()], key=str)
    units = []
    for _, v in rows:
        fine = v is not None and np.isfinite(v).all() and np.any(v)
        units.append((np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max())) if fine else None)
    links = [
        [j for j, w in enumerate(units) if j != i and v is not None and w is not None and len(v) == len(w) and v @ w >= 0.95]
        for i, v in enumerate(units)
    ]
    want = []
    for i, (vec_id, _) in enumerate(rows):
        reached, open_ = {i}, [i]
        while open_:
            for j in links[open_.pop()]:
                if j not in reached:
                    reached.add(j)
                    open_.append(j)
        name = min((rows[j][0] for j in reached if rows[j][0] is not None), default=None)
        want.append((vec_id, len(links[i]), name, vec_id == name))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize(("text", "hidden"), [
    ("write to jоhn@example.com now", {"jоhn@example.com"}),
    ("john dot doe@example.com", {"john dot doe@example.com"}),
    ("at john@example.cоm.", {"john@example.cоm"}),
    ("call plus four 915 1234 5678 today", {"plus four 915 1234 5678"}),
    ("a.b (at) c [dot] org, x at y dot z", {"a.b (at) c [dot] org", "x at y dot z"}),
    ("met him at noon. dot com", set()),
    ("plain john.doe@example.com", set()),
])
def test_wider_spans_stand_beside_plain_ones(text, hidden):
    plain = identifiers(text)
    found = disguised(text, plain)
    assert {text[s:e] for s, e, _ in found} == hidden
    for part in hidden:
        assert part not in masked(text, in_order(plain + found))
        assert not any(text[s:e] in masked(text, in_order(plain + found)) for s, e, _ in plain)


def test_overlapping_spans_are_masked_as_one():
    assert masked("xx abcd yy", [(3, 6, "email"), (4, 7, "ip"), (8, 10, "card")]) == "xx <email> <card>"


@pytest.mark.parametrize("unit", ["a", "a.", "1", "1.", " ", "a dot ", "one ", "(", "+1", "@", " @ ", "a@", "one-", "0", "а", "[dot]", " at ", "\t", "4 5"])
def test_time_grows_with_the_text_alone(unit):
    text = unit * (100_000 // len(unit)) + " (at) x"
    began = time.process_time()
    disguised(text, identifiers(text[:-8]))
    disguised("one" + text + " one", [])
    assert time.process_time() - began < 8


def by_the_contract(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((*m.span(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((*m.span(), "phone"))
    return in_order(out)


def test_plain_identifiers_are_those_of_the_contract(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()]
    rng = random.Random(3)
    pieces = ["@", ".", "-", " ", "+", "(", ")", "a", "b.c", "1", "12", "255", "256", "4539", "1488 0343 6467", "_", "%", "x@y.z", "é", "\n", "00"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(20_000)]
    for text in texts:
        assert identifiers(text) == by_the_contract(text), text


def test_token_files_hold_the_ids_of_the_library(spark):
    library = Tokenizer.from_file(JSON)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    more = ["<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>\n", "x <|endoftext|", " <|endoftext|> ", "  two  <|endoftext|>  ", None, "日本 \t é"]
    docs = docs.union(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(more)], docs.schema))
    want, start = {}, 0
    for doc_id, text in sorted((r.doc_id, r.text or "") for r in docs.collect()):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want[doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = {r.id: (r.start, r.n_tokens, r.ids_crc32) for r in token_digests(docs, JSON, public_tokenizers.PATTERN).collect()}
    assert got == want


def test_copies_changed_in_places_of_their_own(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(5))
    rows = []
    for length, copies in ((30, 260), (200, 60)):
        base = [word() for _ in range(length)]
        for _ in range(copies):
            own = list(base)
            own[rng.randrange(length)] = word()
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows) + i, rows[i * 7][1]) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = near_classes(rows)
    assert {r.id: r.component for r in near_documents(docs).collect()} == want


def test_texts_are_worked_on_some_at_a_time():
    texts = ["a" * n for n in (3, 0, 5, 100, 1, 1)]
    assert [len(p) for p in parts(texts, 6)] == [3, 1, 2] and list(parts([], 6)) == []
    worker_tables("one")["x"] = 1
    assert worker_tables("one") == {"x": 1} and worker_tables("two") == {} and worker_tables("one") == {}
