"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

Ids of a prefix end in one certain token: a token that ends there, and that merges leave apart from the last
token of what stands before it. So reading byte by byte, the transducer finds the last token of every prefix
from those of shorter ones, without running merges over the text. Its state is what later bytes can still
change: the bytes that a longer token may reach back to, and the token before them. Everything before is
written at once; the vocabulary's longest token bounds how far that lags. States and their transitions are
made when first needed. Once there are too many of them, no more are made: bytes for which the machine has
no move are read by the same rule without storing it, so memory is bounded.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from struct import Struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabcycle.llm.common import arrow_map, texts_of, worker_tables
from tabcycle.llm.pretokens import PieceIds

START = -1
BYTES = [bytes([n]) for n in range(256)]
PACKED = Struct("<I").pack
#: What a worker keeps: characters of strings with known ids, states, pairs of tokens. It is all made anew where it does not
#: fit. With 2 million, 60,000 and 400,000 a worker took 37 MB more, and 14% less time.
KEPT, STATES, PAIRS = 1_000_000, 30_000, 150_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int], down_to: int = 1) -> list[bytes]:
    """The tokens of a piece by merging its best-ranked neighbours again and again, while more than `down_to`."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none = len(ranks) + 1
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while len(parts) > down_to and pairs and (best := min(pairs)) != none:
        at = pairs.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
    return parts


class Transducer:
    def __init__(self, ranks: dict[bytes, int], most_states: int = 60_000):
        self.ranks, self.most_states = ranks, most_states
        self.tokens = {rank: token for token, rank in ranks.items()}
        #: The two tokens that a token was last merged from.
        self.halves: dict[bytes, tuple[bytes, bytes]] = {}
        #: Tokens that merges can make; the others stand only for a whole piece.
        self.reached: dict[bytes, int] = {}
        #: Merges come in the order of their ranks if no token ranks before one that it is made of.
        self.ordered = True
        for token, rank in ranks.items():
            parts = merge(token, ranks, 2)
            if len(parts) == 1:
                self.reached[token] = rank
            elif len(parts) == 2 and parts[0] + parts[1] in ranks:
                self.reached[token], self.halves[token] = rank, (parts[0], parts[1])
                self.ordered &= all(ranks[part] < rank for part in parts if len(part) > 1)
        self.longest = max(map(len, self.reached))
        self.beginnings = {token[:n] for token in self.reached for n in range(len(token))}
        #: By left << 32 | right.
        self.apart: dict[int, bool] = {}
        self.edges: dict[tuple[int, int], list[tuple[bytes, float]]] = {}
        self.parts = self.beginnings | self.reached.keys()
        #: A state: the token before, the bytes that are still open, the last token of each prefix of these.
        self.states: list[tuple[int, bytes, tuple[int, ...]]] = [(START, b"", ())]
        self.numbers = {(START, b""): 0}
        #: By state * 256 + byte: the next state and the ids written on the way.
        self.moves: dict[int, tuple[int, bytes]] = {}
        self.ends: dict[int, bytes] = {}

    def edge(self, rank: int, side: int) -> list[tuple[bytes, float]]:
        """The tokens that stand at one end of a token while it is made, each with the rank that ends it."""
        known = self.edges.get((rank, side))
        if known is None:
            token, ended, known = self.tokens[rank], float("inf"), []
            while token is not None:
                known.append((token, ended))
                ended = self.ranks[token]
                token = self.halves[token][side] if token in self.halves else None
            self.edges[rank, side] = known
        return known

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether merges over both tokens' bytes give these two again.

        They do unless, while both are made, tokens meet at the border whose merge comes first; of equal
        merges the one further left does.
        """
        if left == START:
            return True
        key = left << 32 | right
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) > PAIRS:
                self.apart.clear()
            if self.ordered:
                rank = self.ranks.get
                known = not any(
                    (r := rank(a + b)) is not None and r < ends_a and r <= ends_b
                    for a, ends_a in self.edge(left, 1)
                    for b, ends_b in self.edge(right, 0)
                )
            else:
                a, b = self.tokens[left], self.tokens[right]
                known = merge(a + b, self.ranks) == [a, b]
            self.apart[key] = known
        return known

    def chain(self, lasts: Sequence[int], at: int) -> list[int]:
        """Where the tokens of the prefix of length `at` end, last first, 0 at the end."""
        ends = [at]
        while at > 0:
            at -= len(self.tokens[lasts[at - 1]])
            ends.append(at)
        return ends

    def move(self, state: int, byte: int) -> tuple[int, bytes]:
        """The next state and the ids written on the way."""
        left, open_bytes, lasts = self.states[state]
        text = open_bytes + BYTES[byte]
        n = len(text)
        reached = self.reached
        for start in range(max(0, n - self.longest), n):
            token = reached.get(text[start:])
            if token is not None and self.stay_apart(lasts[start - 1] if start else left, token):
                break
        else:
            raise ValueError(f"no token for {text!r}: the vocabulary lacks a byte")
        lasts = (*lasts, token)
        # What all prefixes share that a longer token may still end on is certain.
        cut, beginnings, ends = n, self.beginnings, None
        for at in range(n):
            if text[at:] in beginnings:
                if not at:
                    cut = 0
                    break
                ends = ends or self.chain(lasts, n)
                while at not in ends:
                    at -= len(self.tokens[lasts[at - 1]])
                if at < cut:
                    cut = at
                    if not cut:
                        break
        written = b""
        if cut:
            ends = ends or self.chain(lasts, n)
            written = b"".join([PACKED(lasts[end - 1]) for end in reversed(ends) if 0 < end <= cut])
            left, text, lasts = lasts[cut - 1], text[cut:], lasts[cut:]
        number = self.numbers.get((left, text))
        if number is None:
            number = self.numbers[left, text] = len(self.states)
            self.states.append((left, text, lasts))
        out = self.moves[state << 8 | byte] = (number, written)
        return out

    def simulate(self, state: int, more: bytes) -> bytes:
        """The ids of a state's open bytes and those to come, by the rule of `move`, without new states."""
        left, text, lasts = self.states[state]
        at, text, lasts = len(text), text + more, list(lasts)
        parts, reached, apart, low = self.parts, self.reached, self.apart, 0
        for end in range(at + 1, len(text) + 1):
            while text[low:end] not in parts:
                low += 1
            for start in range(low, end):
                token = reached.get(text[start:end])
                if token is not None:
                    before = lasts[start - 1] if start else left
                    fits = apart.get(before << 32 | token)
                    if fits or fits is None and self.stay_apart(before, token):
                        break
            else:
                raise ValueError(f"no token for {text!r}: the vocabulary lacks a byte")
            lasts.append(token)
        return b"".join([PACKED(lasts[end - 1]) for end in reversed(self.chain(lasts, len(text))) if end])

    def end(self, state: int) -> bytes:
        """The ids of the bytes that are still open."""
        _, text, lasts = self.states[state]
        ends = self.chain(lasts, len(text))
        out = self.ends[state] = b"".join([PACKED(lasts[end - 1]) for end in reversed(ends) if end])
        return out

    def encode(self, piece: bytes) -> bytes:
        """Packed ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return PACKED(whole)
        state, written, moves = 0, b"", self.moves
        full = len(self.states) >= self.most_states
        for at, byte in enumerate(piece):
            step = moves.get(state << 8 | byte)
            if step is None:
                if full:
                    return written + self.simulate(state, piece[at:])
                step = self.move(state, byte)
            state, more = step
            if more:
                written += more
        last = self.ends.get(state)
        return written + (self.end(state) if last is None else last)


def utf8_moves() -> list[list[int]]:
    """By state and byte the next state of the UTF-8 machine, BROKEN where no character goes on so.

    State 0 stands between characters and 1 to 3 wait for as many more bytes. After E0, ED, F0 and F4 the next byte has
    bounds of its own, which rule out overlong forms, surrogates and numbers above U+10FFFF: these are states 4 to 7.
    """
    moves = [[BROKEN] * 256 for _ in range(8)]
    moves[0][:0x80] = [0] * 0x80
    for lead in range(0xC2, 0xF5):
        moves[0][lead] = 1 if lead < 0xE0 else 2 if lead < 0xF0 else 3
    moves[0][0xE0], moves[0][0xED], moves[0][0xF0], moves[0][0xF4] = 4, 5, 6, 7
    bounds = {1: (0x80, 0xBF, 0), 2: (0x80, 0xBF, 1), 3: (0x80, 0xBF, 2), 4: (0xA0, 0xBF, 1), 5: (0x80, 0x9F, 1), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}
    for state, (low, high, after) in bounds.items():
        moves[state][low : high + 1] = [after] * (high - low + 1)
    return moves


BROKEN = -1
MOVES = utf8_moves()
NOT_ASCII = re.compile(rb"[\x80-\xff]+")


class Utf8Stream:
    """Bytes to text, piece by piece, by a machine that reads every byte once; a cut character waits for the next piece.

    It holds a state and the bits of the open character. What is no UTF-8 gives U+FFFD, one for each longest beginning
    of a character that does not go on. Between characters a run of ASCII leaves the state as it is and is taken whole.
    """

    def __init__(self) -> None:
        self.state, self.bits = 0, 0

    def feed(self, data: bytes) -> str:
        out, at = [], 0
        for run in NOT_ASCII.finditer(data):
            start, end = run.span()
            if start > at:
                out.append(self.close() + data[at:start].decode("ascii"))
            out.append(self.read(data[start:end]))
            at = end
        if at < len(data):
            out.append(self.close() + data[at:].decode("ascii"))
        return "".join(out)

    def read(self, data: bytes) -> str:
        state, bits, out, moves = self.state, self.bits, [], MOVES
        for byte in data:
            after = moves[state][byte]
            if after == BROKEN and state:
                out.append("\ufffd")
                state = 0
                after = moves[0][byte]
            if after == BROKEN:
                out.append("\ufffd")
                after = 0
            elif state:
                bits = bits << 6 | byte & 0x3F
                if not after:
                    out.append(chr(bits))
            else:
                bits = byte & (0x1F if byte < 0xE0 else 0x0F if byte < 0xF0 else 0x07)
            state = after
        self.state, self.bits = state, bits
        return "".join(out)

    def close(self) -> str:
        """The end of the text, or an ASCII byte: a character that is still open is broken."""
        state, self.state = self.state, 0
        return "\ufffd" if state else ""


def decode_bytes(ids: np.ndarray, tokens: list[bytes], at_once: int = 65_536) -> Iterator[bytes]:
    for first in range(0, len(ids), at_once):
        yield b"".join(map(tokens.__getitem__, ids[first : first + at_once].tolist()))


def decode_text(pieces: Iterable[bytes]) -> Iterator[str]:
    """Text from bytes that come in pieces."""
    stream = Utf8Stream()
    for piece in pieces:
        yield stream.feed(piece)
    yield stream.close()


def codec(path: str, pattern: str) -> tuple[PieceIds, list[bytes]]:
    """One per Python worker and vocabulary: its tables outlive a batch."""
    held = worker_tables("byte_bpe")
    if (path, pattern) not in held:
        ranks = read_ranks(path)
        machine = Transducer(ranks, STATES)
        cut = PieceIds(lambda pieces: [machine.encode(piece.encode()) for piece in pieces], pattern, KEPT)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        held[path, pattern] = cut, tokens
    return held[path, pattern]


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids, decoded) for every row: packed ids and the text they decode to.

    A null or empty text has no ids. Ids may repeat or be null; each row is its own.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def each(batch: pa.RecordBatch) -> dict:
        cut, tokens = codec(path, pattern)
        ids = list(cut.texts(texts_of(batch)))
        decoded = ["".join(decode_text(decode_bytes(np.frombuffer(i, "<u4"), tokens))) for i in ids]
        return {"id": batch.column(0), "ids": ids, "decoded": decoded}

    return arrow_map(rows, f"id {dict(rows.dtypes)['id']}, ids binary, decoded string", each, "text")


def encode_digests(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, decoded_chars[, ids]): the encoding without the decoded text."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["n_tokens", "ids_sha256", "decoded_sha256", "decoded_chars", "ids"][: 5 if with_ids else 4]

    def each(batch: pa.RecordBatch) -> dict:
        cut, tokens = codec(path, pattern)
        out: dict[str, list] = {name: [] for name in names}
        for ids in cut.texts(texts_of(batch)):
            digest, stream, chars = hashlib.sha256(), Utf8Stream(), 0
            for piece in decode_bytes(np.frombuffer(ids, "<u4"), tokens):
                digest.update(piece)
                chars += len(stream.feed(piece))
            chars += len(stream.close())
            row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), digest.hexdigest(), chars, ids)
            for name, value in zip(names, row, strict=False):
                out[name].append(value)
        return {"id": batch.column(0)} | out

    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, decoded_chars bigint"
    return arrow_map(rows, schema + ", ids binary" * with_ids, each, "text")
