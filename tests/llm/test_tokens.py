"""Encoding against the libraries, round trips of the file format and of streaming decode."""

import hashlib
import io

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tabcycle.llm.bpe import Transducer, Utf8Stream, codec, decode_bytes, decode_text, encode_documents, merge, read_ranks
from tabcycle.llm.token_files import file_bytes, parse, read_range, token_digests

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "\n", "a  b", " x y", "a\n\nb", "tab\tx", "日本語テキスト 中文", "a\x1cb", "it's we'll  'S", "x y ", "😀👨‍👩‍👧 ok",
    "́abc ½ ² Ⅷ 12３４", "end \n", "a \n b", "ÀÉ İı ß", "a b", "aaaaaaaaaaaaaaaaaaaaaaaa", "supercalifragilistic " * 50,
]


def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


def test_transducer_equals_the_library():
    cut, tokens = codec(PATH, public_tokenizers.PATTERN)
    expected = [library().encode_ordinary(text) for text in TEXTS]
    got = [np.frombuffer(ids, "<u4") for ids in cut.texts(TEXTS)]
    assert [g.tolist() for g in got] == expected
    for text, ids in zip(TEXTS, got, strict=True):
        assert "".join(decode_text(decode_bytes(ids, tokens, 3))) == text


def test_transducer_without_room_for_states():
    ranks = read_ranks(PATH)
    rng = np.random.default_rng(2)
    small, large = Transducer(ranks, 1), Transducer(ranks)
    for _ in range(300):
        piece = bytes(rng.choice(list(b"theinganouer "), rng.integers(1, 14)).tolist())
        expected = [ranks[t] for t in merge(piece, ranks)] if piece not in ranks else [ranks[piece]]
        assert np.frombuffer(small.encode(piece), "<u4").tolist() == expected
        assert np.frombuffer(large.encode(piece), "<u4").tolist() == expected


def test_stream_holds_cut_characters():
    data = "aé日😀z".encode()
    stream = Utf8Stream()
    assert "".join(stream.feed(data[i : i + 1]) for i in range(len(data))) + stream.close() == "aé日😀z"
    stream = Utf8Stream()
    assert stream.feed(b"a\xe6\x97") + stream.close() == "a�"


def test_stream_equals_the_library_on_any_bytes_and_cuts():
    rng = np.random.default_rng(9)
    some = [*b"ab \n", 0x80, 0x8F, 0x90, 0x9F, 0xA0, 0xBF, 0xC0, 0xC1, 0xC2, 0xDF, 0xE0, 0xE1, 0xED, 0xEF, 0xF0, 0xF1, 0xF4, 0xF5, 0xFF]
    texts = [bytes(rng.choice(some, rng.integers(0, 12)).tolist()) for _ in range(20_000)]
    texts += ["aé日😀z\uffff\U0010ffff߿ࠀ".encode(), bytes(range(256)) * 3]
    for data in texts:
        stream = Utf8Stream()
        cuts = sorted(rng.integers(0, len(data) + 1, 3).tolist())
        parts = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]
        assert "".join(map(stream.feed, parts)) + stream.close() == data.decode("utf-8", "replace"), data


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 50257, n), rng.integers(0, 1 << 32, n, dtype=np.uint64), rng.geometric(0.01, n), np.zeros(n)):
        ids = ids.astype(np.uint32)
        content = file_bytes(np.array([n]), ids)
        counts, back = parse(content)
        assert counts.tolist() == [n] and np.array_equal(back, ids)
        assert np.array_equal(read_range(io.BytesIO(content), 100, 300), ids[100:300])


def test_digests_of_odd_rows(odd, none):
    got = sorted(token_digests(odd, JSON, public_tokenizers.PATTERN).collect(), key=lambda r: r.start)
    assert len(got) == odd.count() and got[0].id is None
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert {r.id: r.n_tokens for r in got}[4] == 1
    assert token_digests(none, JSON, public_tokenizers.PATTERN).count() == 0
    coded = encode_documents(odd, PATH, public_tokenizers.PATTERN).collect()
    texts = [r.text or "" for r in odd.collect()]
    assert sorted(r.decoded for r in coded) == sorted(texts)
    assert encode_documents(none, PATH, public_tokenizers.PATTERN).count() == 0


def test_stages_on_odd_rows_and_no_rows(spark, odd, none, tmp_path):
    for name, docs in (("odd", odd), ("none", none.selectExpr("*", "0L AS n_chars"))):
        docs = docs.selectExpr("doc_id", "text", "lang", "source", "0L AS n_chars")
        for step, (stage, function) in enumerate(corpus_pipeline.STAGES):
            out = function(spark, docs, "")
            if step < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == corpus_pipeline.COLUMNS
            out.write.parquet(f"{tmp_path}/{name}-{stage}")
            docs = spark.read.parquet(f"{tmp_path}/{name}-{stage}")
        for row in docs.collect():
            assert len(row.ids) == 4 * row.n_tokens
            assert row.ids_sha256 == hashlib.sha256(row.ids).hexdigest()
