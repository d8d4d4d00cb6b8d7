"""Every stage of the pipeline against plain Python, on the rows that the stage before it left."""

import hashlib
import string
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_text_operators import near_classes

import corpus_pipeline
from tabcycle.llm.bpe import read_ranks
from tabcycle.llm.language_id import DIMENSIONS, held_out, learn, letter_vector, predict
from tabcycle.llm.sql import MIX

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(folder / name))
        before, docs = docs, spark.read.parquet(str(folder / name))
        out[name] = before, docs
    return out


def bundle(text: str, dimensions: int) -> np.ndarray:
    """The sum of the bound vectors of all three-letter windows; what is no letter is a gap, gaps in a row are one."""
    letters = [0]
    for c in text.lower():
        code = ord(c) if c.isalpha() else 0
        if code or letters[-1]:
            letters.append(code)
    if letters[-1]:
        letters.append(0)
    total = np.zeros(dimensions)
    for (a, b, c), n in Counter(zip(letters, letters[1:], letters[2:])).items():
        total += n * (np.roll(letter_vector(a, dimensions), 2).astype(float) * np.roll(letter_vector(b, dimensions), 1) * letter_vector(c, dimensions))
    return total


def languages(learned, texts, dimensions):
    profiles = defaultdict(lambda: np.zeros(dimensions))
    for text, lang in learned:
        own = bundle(text, dimensions)
        if own.any():
            profiles[lang] += own / windows(text)
    names = sorted(profiles)
    table = np.array([profiles[n] / np.linalg.norm(profiles[n]) for n in names])
    out = []
    for text in texts:
        own = bundle(text or "", dimensions)
        if not own.any():
            out.append(("und", 0.0))
            continue
        cosines = table @ own / np.linalg.norm(own)
        out.append((names[int(cosines.argmax())], float(max(cosines.max(), 0.0))))
    return out


def windows(text: str) -> int:
    gapped = "".join(c if c.isalpha() else " " for c in text.lower())
    return max(len(" " + " ".join(gapped.split()) + " ") - 2, 1)


def test_language_stage(spark, steps):
    before, after = steps["language_id"]
    rows = before.select("doc_id", "text", "lang", held_out("doc_id").alias("out")).collect()
    learned = [(r.text, r.lang) for r in rows if not r.out and r.lang is not None and r.text is not None]
    found = languages(learned, [r.text for r in rows], DIMENSIONS)
    letters = [sum(c.isalpha() for c in r.text or "") for r in rows]
    kept = {
        r.doc_id for r, (lang, score), n in zip(rows, found, letters, strict=True)
        if lang != "und" and (score >= corpus_pipeline.LEAST_SCORE or n < corpus_pipeline.LEAST_LETTERS)
    }
    assert {r.doc_id for r in after.collect()} == kept
    names, profiles = learn(before.filter(~held_out("doc_id") & before.lang.isNotNull() & before.text.isNotNull()), 64)
    got = {r.doc_id: r for r in predict(before, names, profiles, ["doc_id"]).collect()}
    for r, (lang, score) in zip(rows, languages(learned, [r.text for r in rows], 64), strict=True):
        assert got[r.doc_id].score == pytest.approx(score, abs=1e-5) and (got[r.doc_id].lang_pred == lang or score < 1e-5)


def test_a_table_that_teaches_nothing_keeps_its_texts(spark, steps):
    before, _ = steps["language_id"]
    labelled = before.filter(held_out("doc_id"))
    assert corpus_pipeline.language_stage(spark, labelled, SF_DIR).count() == labelled.filter(labelled.text.rlike("[a-zA-Z]")).count()


def test_line_stage(steps):
    before, after = steps["line_dedup"]
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    rows = {r.doc_id: (r.text or "").split("\n") for r in before.collect()}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    holders = defaultdict(set)
    for doc_id, lines in rows.items():
        for line in lines:
            holders[key(line)].add(doc_id)
    want = {
        doc_id: "\n".join(x for x in lines if not (len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and max(holders[key(x)]) != doc_id))
        for doc_id, lines in rows.items()
    }
    assert {r.doc_id: r.text for r in after.collect()} == want
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_stage(steps):
    before, after = steps["near_dedup"]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    named = near_classes(rows)
    assert {(r.doc_id, r.text) for r in after.collect()} == {row for row in rows if named[row[0]] == row[0]}


def test_mix_stage(steps, tmp_path):
    before, after = steps["mix_sources"]
    rows = before.toPandas()
    db = duckdb.connect()
    db.register("docs_of_stage", rows)
    taken = dict(db.execute(f"WITH {MIX} SELECT doc_id, copies FROM mixed".replace("DOCS", "docs_of_stage")).fetchall())
    assert Counter(r.doc_id for r in after.collect()) == Counter({k: n for k, n in taken.items() if n})
    assert {r.doc_id: r.text for r in after.collect()}.items() <= dict(zip(rows.doc_id, rows.text)).items()


def test_encode_stage(steps):
    before, after = steps["byte_bpe"]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    want = Counter()
    for r in before.collect():
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4").tobytes()
        want[r.doc_id, len(ids) // 4, ids, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.ids_sha256, r.decoded_sha256) for r in after.collect()) == want
