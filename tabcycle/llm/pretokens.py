"""Texts cut into the pieces that byte-level vocabularies merge within, and a memory of their ids.

The pattern of such vocabularies puts a single space before a word into the word's piece. So a text
without other white space in a row can be cut at its spaces and line ends, byte by byte, many texts at a
time; what stands between two spaces is looked up as a whole. Any other text is cut by the pattern.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
import regex
from public_tokenizers import PATTERN

#: White space that the quick cut cannot take: all but space and line end, or two of them side by side.
UNEVEN = re.compile(
    "[\t\x0b\x0c\r\x1c-\x1f\x85\xa0  -     　]|[ \n][ \n]|[ ]\\Z"
)


#: The same white space in UTF-8: single bytes, and numbers of two or three bytes.
ALONE = np.zeros(256, bool)
ALONE[[9, 11, 12, 13, 28, 29, 30, 31]] = True
PAIRS = [0xC285, 0xC2A0]
TRIPLES = [0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080]
SPACE, LINE_END = 32, 10
#: ASCII letters and signs; U+00C0 to U+00FF are this byte and another, and letters but for two.
LETTER, SIGN = (np.array([n < 128 and test(chr(n)) for n in range(256)]) for test in (str.isalpha, lambda c: c.isprintable() and not c.isalnum() and c != " "))
LATIN, NO_LETTERS = 0xC3, (0x97, 0xB7)


def uneven(buffer: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Which of the texts that lie one after the other in UTF-8 hold white space that the quick cut cannot take."""
    space = (buffer == SPACE) | (buffer == LINE_END)
    bad = ALONE[buffer]
    beside = space[:-1] & space[1:]
    ends = limits[1:][np.diff(limits) > 0] - 1
    beside[ends[:-1]] = False
    bad[:-1] |= beside
    bad[ends] |= buffer[ends] == SPACE
    lead = np.flatnonzero((buffer == 0xC2) | ((buffer >= 0xE1) & (buffer <= 0xE3)))
    if len(lead):
        first, second, third = (np.take(buffer, lead + n, mode="clip").astype(np.int64) for n in range(3))
        two = first * 256 + second
        bad[lead] |= np.isin(two, PAIRS) | np.isin(two * 256 + third, TRIPLES)
    out = np.zeros(len(limits) - 1, bool)
    out[np.searchsorted(limits, np.flatnonzero(bad), side="right") - 1] = True
    return out


def even_strings(raw: list[bytes]) -> tuple[pa.StringArray, np.ndarray]:
    """The strings that the quick cut makes of texts in UTF-8, one text after the other, and how many of each.

    No piece holds a letter and a sign after it, so a string ends there too: words with and without signs are the same ones.
    """
    joined = b"".join(raw)
    buffer = np.frombuffer(joined, np.uint8)
    limits = np.cumsum([0] + [len(one) for one in raw])
    opens = (buffer == SPACE) | (buffer == LINE_END)
    opens[1:] |= buffer[:-1] == LINE_END
    letter = LETTER[buffer]
    letter[1:] |= (buffer[:-1] == LATIN) & (buffer[1:] != NO_LETTERS[0]) & (buffer[1:] != NO_LETTERS[1])
    opens[1:] |= SIGN[buffer[1:]] & letter[:-1]
    opens[limits[:-1][np.diff(limits) > 0]] = True
    starts = np.flatnonzero(opens)
    offsets = np.append(starts, len(buffer)).astype(np.int32)
    strings = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(joined))
    return strings, np.diff(np.searchsorted(starts, limits))


def packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, "<u4").tobytes()


class PieceIds:
    """Ids of texts, as little-endian 32-bit integers.

    `ids_of` takes distinct pieces of the pattern and gives the packed ids of each. What it gave is kept for
    up to `most` characters of strings, the first ones met; strings met later are worked out again, so memory is
    bounded. Strings in `whole` are pieces wherever they stand, the longest first.

    The quick cut holds for the one pattern it was written for; texts are cut by any other pattern itself.
    """

    def __init__(
        self, ids_of: Callable[[list[str]], list[bytes]], pattern: str, most: int = 4_000_000, whole: Sequence[str] = ()
    ):
        self.ids_of, self.most, self.pattern = ids_of, most, regex.compile(pattern)
        self.quick = pattern == PATTERN
        self.whole = frozenset(whole)
        self.marks = re.compile("|".join(map(re.escape, sorted(whole, key=len, reverse=True)))) if whole else None
        self.kept: dict[str, bytes] = {}
        self.size = 0

    def texts(self, texts: list[str], at_once: int = 4_000_000) -> Iterable[bytes]:
        """The ids of each text; strings not yet known are asked for together, some megabytes of text at a time."""
        first, size = 0, 0
        for nth, text in enumerate(texts):
            size += len(text)
            if size >= at_once or nth == len(texts) - 1:
                yield from self._block(texts[first : nth + 1])
                first, size = nth + 1, 0

    def _pieces(self, text: str) -> list[str]:
        if self.marks and self.marks.search(text):
            out, at = [], 0
            for mark in self.marks.finditer(text):
                out += [*self._uncut(text[at : mark.start()]), mark[0]]
                at = mark.end()
            return out + self._uncut(text[at:])
        return self._uncut(text)

    def _uncut(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.quick or UNEVEN.search(text):
            return self.pattern.findall(text)
        # The piece " word" is kept under " word"; a space that opens a line has a piece of its own only there.
        out = []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            if head:
                out.append(head)
            out += map(" ".__add__, rest)
            out.append("\n")
        out.pop()
        return out

    def _split(self, string: str) -> list[str]:
        """The pieces of the pattern in a string; a word with a sign at its end needs no search."""
        if string in self.whole:
            return [string]
        word = string[1:] if string[0] == " " else string
        if word.isalpha():
            return [string]
        if word[:-1].isalpha() and word[-1] in ",.":
            return [string[:-1], string[-1]]
        return self.pattern.findall(string)

    def _block(self, texts: list[str]) -> Iterable[bytes]:
        """The texts' strings are numbered, each distinct one is looked up once, and Arrow puts the ids together."""
        raw = [text.encode() for text in texts]
        odd = np.ones(len(raw), bool)
        if self.quick:
            odd = uneven(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(one) for one in raw]))
        if self.marks:
            odd |= [bool(self.marks.search(text)) for text in texts]
        cut = [self._pieces(texts[nth]) for nth in np.flatnonzero(odd)]
        strings, sizes = even_strings([raw[nth] for nth in np.flatnonzero(~odd)])
        rest = pa.array([string for one in cut for string in one], pa.string())
        numbered = pa.concat_arrays([strings, rest]).dictionary_encode()
        ids, ends = self._ids(numbered)
        pieces = np.zeros(len(raw) + 1, np.int64)
        pieces[1:] = np.cumsum([*sizes, *map(len, cut)])
        borders = ends[pieces].tolist()
        # Even texts first, then the odd ones.
        place = np.empty(len(raw), np.int64)
        place[np.argsort(odd, kind="stable")] = np.arange(len(raw))
        for nth in place.tolist():
            yield ids[borders[nth] : borders[nth + 1]]

    def _ids(self, numbered: pa.DictionaryArray) -> tuple[bytes, np.ndarray]:
        """The ids of all strings, one after the other, and where each string's ids start and end in bytes."""
        known = self.kept
        strings = numbered.dictionary.to_pylist()
        coded = list(map(known.get, strings))
        new = [string for string, ids in zip(strings, coded, strict=True) if ids is None]
        whole = [string for string in new if string.isalpha() or string[0] == " " and string[1:].isalpha()]
        new = {string: self._split(string) for string in set(new).difference(whole)}
        unknown = list({piece for pieces in new.values() for piece in pieces if piece not in known}.union(whole))
        found = Both(zip(unknown, self.ids_of(unknown), strict=True))
        found.known = known
        for string, pieces in new.items():
            if len(pieces) > 1:
                found[string] = b"".join([found[piece] for piece in pieces])
        coded = [found[string] if ids is None else ids for string, ids in zip(strings, coded, strict=True)]
        if self.size < self.most:
            self.size += sum(map(len, found))
            known.update(found)
        taken = pa.array(coded, pa.large_binary()).take(numbered.indices)
        _, ends, data = taken.buffers()
        return data.to_pybytes() if data else b"", np.frombuffer(ends, np.int64, len(taken) + 1)


class Both(dict):
    """New strings; it looks up what it does not hold in `known`."""

    known: dict

    def __missing__(self, key: str) -> bytes:
        return self.known[key]
