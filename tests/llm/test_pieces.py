"""Texts cut at bytes give the pieces of the pattern, and a word is one string whatever sign follows."""

import random

import numpy as np
from public_tokenizers import PATTERN

from tabcycle.llm.pretokens import UNEVEN, PieceIds, uneven

PARTS = ["word", " ", " ", "\n", "é", "ça", " don't", "'s", "12", ",", ".", "!!", " (", "<", "…", "日本", "¿", "×", "÷", " Ñ", "́", "_"]
ODD = ["  ", "\t", "\r\n", "\xa0", "\x85", " ", " ", " ", "　", "\x1c", "​", "<|end|>"]


def marked(pieces):
    return [piece.encode("utf-32-le") for piece in pieces]


def test_cut_texts_equal_the_pattern():
    rng = random.Random(4)
    pattern = PieceIds(marked, PATTERN).pattern
    for case in range(400):
        parts = PARTS + ODD * (case % 2)
        texts = ["".join(rng.choices(parts, k=rng.choice([0, 1, 2, 8, 40]))) for _ in range(rng.choice([1, 2, 20]))]
        raw = [text.encode() for text in texts]
        limits = np.cumsum([0] + [len(one) for one in raw])
        assert uneven(np.frombuffer(b"".join(raw), np.uint8), limits).tolist() == [bool(UNEVEN.search(text)) for text in texts]
        # Each piece with its length before it, so that other borders are seen.
        told = lambda pieces: [len(piece).to_bytes(4, "little") + piece.encode("utf-32-le") for piece in pieces]
        want = [b"".join(told(pattern.findall(text))) for text in texts]
        assert list(PieceIds(told, PATTERN).texts(texts, 60)) == want, texts


def test_added_tokens_are_pieces():
    texts = ["a<|end|>b, c", "<|end|>", "plain text.", ""]
    got = list(PieceIds(marked, PATTERN, whole=["<|end|>"]).texts(texts))
    assert [one.decode("utf-32-le") for one in got] == texts


def test_signs_make_no_words_of_their_own():
    words = ["".join(random.Random(n).choices("abcdefghé", k=6)) for n in range(200)]
    cut = PieceIds(marked, PATTERN)
    list(cut.texts([" ".join(word + sign for word in words) for sign in ["", ",", ".", "!!", ";", ")"]]))
    assert len(cut.kept) <= 2 * len(words) + 6
