"""A worker holds some rows of a batch at a time, however large the batch is."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import tiktoken

from tabcycle.llm import common
from tabcycle.llm.bpe import encode_digests, read_ranks

WORDS = "alpha beta gamma délta epsilon, zeta eta; theta 12 iota kappa".split()


class Frame:
    """Keeps what mapInArrow is given, and runs it on batches of its own."""

    dtypes = [("id", "bigint"), ("doc_id", "bigint"), ("text", "string")]

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def batch(texts):
    return pa.RecordBatch.from_pydict({"id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})


def test_borders_are_those_of_the_texts():
    rng = random.Random(3)
    for _ in range(200):
        texts = ["é" * rng.choice([0, 0, 1, 5, 9, 10, 11, 40]) for _ in range(rng.choice([1, 2, 7, 30]))]
        rows = batch([text if text or rng.random() < 0.5 else None for text in texts])
        made = [[t or "" for t in some.column(1).to_pylist()] for some in common.row_parts(rows, "text", 10)]
        assert made == list(common.parts(texts, 10))
    assert not list(common.row_parts(batch([]), "text"))


def test_encoding_sends_some_rows_at_a_time(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(WORDS, k=30_000)) for _ in range(30)] + [None, ""]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    run = encode_digests(Frame(), path, public_tokenizers.PATTERN, with_ids=True)
    made = list(run(iter([batch(texts)])))
    sizes = [sum(rows.column("decoded_chars").to_pylist()) for rows in made]
    assert max(sizes) <= common.AT_ONCE + max(len(text or "") for text in texts) and sum(sizes) == sum(len(text or "") for text in texts)
    assert [n for rows in made for n in rows.column("id").to_pylist()] == list(range(len(texts)))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    ids = [known.encode_ordinary(texts[nth] or "") for nth in (0, 31)]
    digests = [hashlib.sha256(b"".join(n.to_bytes(4, "little") for n in some)).hexdigest() for some in ids]
    found = [digest for rows in made for digest in rows.column("ids_sha256").to_pylist()]
    assert [found[0], found[31]] == digests and found[30] == found[31]
