"""Personal data, also in disguise, with offsets in the source text.

Transducers rewrite a text (look-alike characters, spelled digits, at and dot in words or brackets) and
keep for each character they write the source characters it stands for. Identifiers found in the rewritten
text are mapped back to the source by that.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabcycle.llm.common import arrow_map, texts_of

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A number is begun at its first digit only, so that long ones are read once.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NO_DIGIT = re.compile(r"[^0-9]")

#: Characters that look like an ASCII one, by alphabet.
LOOK_ALIKES = {
    "Cyrillic": ("аеорсухіјѕԁһкмтвнгАВЕКМНОРСТХУІЈЅ", "aeopcyxijsdhkmtbhrABEKMHOPCTXYIJS"),
    "Greek": ("οαρνικτυχεΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "oapviktuxeABEZHIKMNOPTYX"),
    "signs": ("․﹒。．＠﹫‐‑‒–—−＋﹢    ", "....@@------++    "),
}
#: Characters without width.
WIDTHLESS = "­​‌‍⁠﻿"
#: Names of the digits.
DIGIT_NAMES = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7",
    "acht": "8", "neun": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9",
}

NAME = "(?:" + "|".join(sorted(DIGIT_NAMES, key=len, reverse=True)) + ")"
# Possessive repeats, begun where the white space begins: long runs of it are read once.
GAP = r"(?:[ \t\n]*+[-,./]?[ \t\n]*+)"
DOT_WORD = r"(?:dot|point|punkt|punto)"
#: A run that opens with the name of a digit, with three more names, numbers or dots.
SPELLED = re.compile(
    rf"(?:\bplus\b{GAP}|\+[ ]?)?\b{NAME}\b(?:{GAP}(?:\b{NAME}\b|[0-9]++|\b{DOT_WORD}\b)){{3,}}", re.IGNORECASE
)
#: Words that show a name of a digit, as white space cuts them.
NAME_WORDS = frozenset(name + end for name in DIGIT_NAMES for end in ("", ",", ".", "-", "/"))
JOINED = re.compile(r"[-,./]")
SPELLED_PART = re.compile(rf"\b(?:({NAME})|({DOT_WORD})|(plus))\b|([0-9+]+)|([^0-9+A-Za-zÀ-ÿ]+)", re.IGNORECASE)
OPEN, SHUT = r"[ \t]*+[\[({<][ \t]*+", r"[ \t]*+[\])}>][ \t]*+"
BOXED_AT = rf"{OPEN}(?:at|@|arroba|chez){SHUT}"
BOXED_DOT = rf"{OPEN}(?:{DOT_WORD}|\.){SHUT}"
WORD_AT, WORD_DOT = r"[ \t]++(?:at|arroba)[ \t]++", rf"[ \t]++{DOT_WORD}[ \t]++"
PLAIN_AT = r"[ \t]*+@[ \t]*+"
LABEL = r"[A-Za-z0-9-]++"
NAMED = r"[A-Za-z0-9_%+-]++"
AT = re.compile(rf"(?<![ \t])(?:({BOXED_AT}|{PLAIN_AT})|{WORD_AT})", re.IGNORECASE)
#: What follows an at: after one in words a dot in words or brackets must come, after any other a plain one will do.
DOMAIN_OF_MARK = re.compile(rf"{LABEL}(?:(?:\.|{BOXED_DOT}|{WORD_DOT}){LABEL})+", re.IGNORECASE)
DOMAIN_OF_WORD = re.compile(rf"{LABEL}(?:\.{LABEL})*+(?:(?:{BOXED_DOT}|{WORD_DOT}){LABEL}(?:\.{LABEL})*+)+", re.IGNORECASE)
#: What stands before an at, read from there backwards, in the text turned round.
NAME_BACK = re.compile(
    rf"{NAMED}(?:(?:\.|[ \t]*+[\])}}>][ \t]*+(?:{'|'.join(w[::-1] for w in ('dot', 'point', 'punkt', 'punto'))}|\.)[ \t]*+[\[({{<][ \t]*+"
    rf"|[ \t]++(?:{'|'.join(w[::-1] for w in ('dot', 'point', 'punkt', 'punto'))})[ \t]++){NAMED})*",
    re.IGNORECASE,
)
MAIL_HINT = re.compile(
    rf"[\[({{<][ \t]*+(?:at|@|arroba|chez)[ \t]*+[\])}}>]|[ \t]@|@[ \t]|@[A-Za-z0-9-]++(?:{BOXED_DOT}|{WORD_DOT})"
    rf"|(?<![ \t])(?:{BOXED_DOT}|{WORD_DOT})[A-Za-z0-9._%+-]++@"
    rf"|[ \t](?:at|arroba)[ \t]++[A-Za-z0-9.-]++(?:{BOXED_DOT}|{WORD_DOT})",
    re.IGNORECASE,
)
DISGUISE = re.compile(rf"(?<![ \t])(?:({BOXED_AT}|{WORD_AT}|{PLAIN_AT})|({BOXED_DOT}|{WORD_DOT}))", re.IGNORECASE)
DOTTED = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:(?:{BOXED_DOT}|{WORD_DOT}|\.)[0-9]{{1,3}}){{3}}", re.IGNORECASE)
DOTTED_HINT = re.compile(rf"[0-9](?:{BOXED_DOT}|{WORD_DOT})[0-9]", re.IGNORECASE)

Span = tuple[int, int, str]


@lru_cache(maxsize=1)
def look_alikes() -> dict[str, str]:
    table = {a: b for theirs, ours in LOOK_ALIKES.values() for a, b in zip(theirs, ours, strict=True)}
    table |= {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
    table |= {c: "" for c in WIDTHLESS}
    for code in range(0x80, 0x20000):
        if (digit := unicodedata.decimal(chr(code), None)) is not None:
            table[chr(code)] = str(digit)
    return table


def luhn(digits: str) -> bool:
    twice = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in twice)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: a local part is all the characters of its class before an @."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        after = at + 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            found.append((start, domain.end()))
            done = after = domain.end()
        at = text.find("@", after)
    return found


def identifiers(text: str) -> list[Span]:
    """Plain identifiers of a text: (start, end, kind), by start, then kind as in KINDS."""
    found = [(start, end, "email") for start, end in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(short := part.lstrip("0")) <= 3 and int(short or 0) <= 255 for part in m[0].split(".")):
                found.append((*m.span(), "ip"))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = NO_DIGIT.sub("", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((*m.span(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(NO_DIGIT.sub("", m[0])) <= 15:
                    found.append((*m.span(), "phone"))
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


class Tape:
    """A text as rewritten so far; `starts` and `ends` give the source characters of each of its own."""

    def __init__(self, text: str):
        self.text, self.changed = text, False
        self.starts: list[int] = []
        self.ends: list[int] = []

    def rewrite(self, parts: list[tuple[int, int, str]]) -> None:
        """Put new characters for each (start, end, new), in order and apart from each other."""
        if not parts:
            return
        if not self.changed:
            self.starts, self.ends = list(range(len(self.text))), list(range(1, len(self.text) + 1))
            self.changed = True
        text, starts, ends, at = [], [], [], 0
        for start, end, new in parts:
            text += [self.text[at:start], new]
            starts += self.starts[at:start] + [self.starts[start]] * len(new)
            ends += self.ends[at:start] + [self.ends[end - 1]] * len(new)
            at = end
        self.text = "".join([*text, self.text[at:]])
        self.starts, self.ends = starts + self.starts[at:], ends + self.ends[at:]

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]


def plain_characters(tape: Tape) -> None:
    if not tape.text.isascii():
        table = look_alikes()
        if found := table.keys() & set(tape.text):
            pattern = re.compile("[" + "".join(map(re.escape, sorted(found))) + "]")
            tape.rewrite([(m.start(), m.end(), table[m[0]]) for m in pattern.finditer(tape.text)])


def names_digits(text: str) -> bool:
    """Whether a text may hold the name of a digit."""
    words = text.lower().split()
    if not NAME_WORDS.isdisjoint(words):
        return True
    return any(not NAME_WORDS.isdisjoint(JOINED.split(w)) for w in words if "-" in w or "," in w[:-1] or "/" in w or "." in w[:-1])


def plain_digits(tape: Tape) -> None:
    if not names_digits(tape.text):
        return
    parts = []
    for run in SPELLED.finditer(tape.text):
        for m in SPELLED_PART.finditer(tape.text, *run.span()):
            name, dot, plus, digits, _ = m.groups()
            if digits is None:
                new = DIGIT_NAMES[name.lower()] if name else "." if dot or m[0].strip() == "." else "+" if plus else ""
                parts.append((m.start(), m.end(), new))
    tape.rewrite(parts)


def disguised_mails(text: str) -> list[tuple[int, int]]:
    """Addresses with any at and dots, found from the at outwards: each part of the text is read once."""
    found, done, turned = [], 0, text[::-1]
    for mark in AT.finditer(text):
        if mark.start() > done:
            name = NAME_BACK.match(turned, len(text) - mark.start(), len(text) - done)
            domain = (DOMAIN_OF_MARK if mark[1] else DOMAIN_OF_WORD).match(text, mark.end())
            if name and domain:
                done = domain.end()
                found.append((len(text) - name.end(), done))
    return found


def plain_marks(tape: Tape) -> None:
    parts = []
    runs = disguised_mails(tape.text) if MAIL_HINT.search(tape.text) else []
    if DOTTED_HINT.search(tape.text):
        runs += [m.span() for m in DOTTED.finditer(tape.text)]
    done = 0
    for start, end in sorted(runs):
        if start >= done:
            parts += [(*m.span(), "@" if m[1] else ".") for m in DISGUISE.finditer(tape.text, start, end)]
            done = end
    tape.rewrite([p for p in parts if tape.text[p[0] : p[1]] != p[2]])


def disguised(text: str, plain: list[Span]) -> list[Span]:
    """Identifiers that only the rewritten text shows whole, as spans of the source.

    Where the plain text shows a part of one, both spans stand; one that a plain span of its kind holds is not new.
    """
    tape = Tape(text)
    for transducer in (plain_characters, plain_digits, plain_marks):
        transducer(tape)
    if not tape.changed:
        return []
    found = []
    for start, end, kind in identifiers(tape.text):
        start, end = tape.source(start, end)
        if not any(s <= start and end <= e for s, e, k in plain if k == kind):
            found.append((start, end, kind))
    return found


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def private_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_spans, spans, n_disguised) for every row.

    Counts are of the plain identifiers; `spans` has the disguised ones too, both as kind:start:end in
    code points. A null text is empty and has none; ids may repeat or be null, each row is its own.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def each(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {f"n_{kind}": [] for kind in KINDS} | {"base_spans": [], "spans": [], "n_disguised": []}
        for text in texts_of(batch):
            plain = identifiers(text)
            hidden = disguised(text, plain)
            for kind in KINDS:
                out[f"n_{kind}"].append(sum(k == kind for _, _, k in plain))
            out["base_spans"].append(written(plain))
            out["spans"].append(written(in_order(plain + hidden)))
            out["n_disguised"].append(len(hidden))
        return {"id": batch.column(0)} | out

    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    schema = f"id {dict(rows.dtypes)['id']}, {counts}, base_spans string, spans string, n_disguised bigint"
    return arrow_map(rows, schema, each)


def masked(text: str, spans: list[Span], mask: str = "<{}>") -> str:
    """The text with its identifiers replaced by their kind. Overlapping spans are one, of the longest's kind (the first of equals)."""
    out, at, held = [], 0, []

    def close() -> None:
        kind = max(held, key=lambda s: s[1] - s[0])[2]
        out.append(mask.format(kind))

    for start, end, kind in in_order(spans):
        if held and start >= at:
            close()
            held.clear()
        if not held:
            out.append(text[at:start])
        held.append((start, end, kind))
        at = max(at, end)
    if held:
        close()
    return "".join([*out, text[at:]])
