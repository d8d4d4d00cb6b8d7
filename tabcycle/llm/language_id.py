"""Language ID with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A three-letter window binds them by product, the first
letter's vector permuted twice and the second's once. A text bundles (sums) its windows, a language
bundles the windows of its texts, and a text has the language whose bundle is nearest by cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabcycle.llm.common import arrow_map, parts, texts_of, worker_tables

DIMENSIONS = 1024
SEED = 20240
#: Rows of a count matrix, and its columns, at one time.
TEXTS, WINDOWS = 512, 8192


#: Letters whose vectors a worker keeps; beyond these they are drawn anew.
KEPT_LETTERS = 4096


def letter_table() -> np.ndarray:
    """Code point to itself where it is a letter, else to 0."""
    held = worker_tables("language_id")
    if "letters" not in held:
        table = np.zeros(0x110000, np.int32)
        letters = [c for c in range(0x110000) if chr(c).isalpha()]
        table[letters] = letters
        held["letters"] = table
    return held["letters"]


def letter_vector(code: int, dimensions: int) -> np.ndarray:
    held = worker_tables("language_id").setdefault("vectors", {})
    vector = held.get((code, dimensions))
    if vector is None:
        bits = np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, dimensions, np.int8)
        vector = bits * 2 - 1
        if len(held) < KEPT_LETTERS:
            held[code, dimensions] = vector
    return vector


def windows_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The letters of the texts, their number, and per text its distinct windows with counts.

    A window is a number to the base of the letters. Anything but a letter is a gap; gaps in a row are one.
    """
    joined = "\0".join(text.lower() for text in texts)
    codes = letter_table()[np.frombuffer(("\0" + joined + "\0").encode("utf-32-le", "surrogatepass"), "<u4")]
    lengths = np.array([len(text.lower()) for text in texts], np.int64)
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    seen[0] = True
    letters = np.flatnonzero(seen)
    rank = np.zeros(0x110000, np.int64)
    rank[letters] = np.arange(len(letters))
    base = len(letters)
    counted, at = [], 0
    for length in lengths:
        own = rank[codes[at : at + length + 2]]
        at += length + 1
        own = own[np.concatenate(([True], (own[1:] != 0) | (own[:-1] != 0)))]
        keys = (own[:-2] * base + own[1:-1]) * base + own[2:] if len(own) > 2 else own[:0]
        counted.append(np.unique(keys, return_counts=True))
    return letters, lengths, counted


def window_vectors(keys: np.ndarray, letters: np.ndarray, dimensions: int) -> np.ndarray:
    base = len(letters)
    parts = (keys // (base * base), keys // base % base, keys % base)
    out = None
    for shift, part in zip((2, 1, 0), parts, strict=True):
        used, at = np.unique(part, return_inverse=True)
        table = np.stack([np.roll(letter_vector(int(letters[u]), dimensions), shift) for u in used])
        out = table[at] if out is None else out * table[at]
    return out.astype(np.float32)


def bundles(rows: list[tuple[np.ndarray, np.ndarray]], letters: np.ndarray, dimensions: int) -> np.ndarray:
    """One bundle per row of (windows, weights)."""
    out = np.zeros((len(rows), dimensions), np.float32)
    if not rows:
        return out
    vocabulary = np.unique(np.concatenate([keys for keys, _ in rows]))
    for first in range(0, len(vocabulary), WINDOWS):
        part = vocabulary[first : first + WINDOWS]
        vectors = window_vectors(part, letters, dimensions)
        for top in range(0, len(rows), TEXTS):
            some = rows[top : top + TEXTS]
            counts = np.zeros((len(some), len(part)), np.float32)
            for nth, (keys, weights) in enumerate(some):
                low, high = np.searchsorted(keys, (part[0], part[-1] + 1))
                counts[nth, np.searchsorted(part, keys[low:high])] = weights[low:high]
            out[top : top + len(some)] += counts @ vectors
    return out


def learn(labelled: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages and their bundles from (text, lang); every text weighs the same.

    Tasks bundle their texts by language, the bundles are summed by Spark, and one vector per language
    comes to the driver.
    """

    def each(batch: pa.RecordBatch) -> dict:
        summed: dict[str, np.ndarray] = {}
        names = iter(batch.column(1).to_pylist())
        for some in parts(texts_of(batch)):
            letters, _, counted = windows_of(some)
            keys: dict[str, list] = {}
            for (own, n), name in zip(counted, names, strict=False):
                if len(own) and name is not None:
                    keys.setdefault(name, []).append((own, n / n.sum()))
            rows = []
            for found in keys.values():
                own, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                rows.append((own, np.bincount(at, np.concatenate([w for _, w in found]))))
            for name, bundle in zip(keys, bundles(rows, letters, dimensions).astype(float), strict=True):
                summed[name] = summed.get(name, 0.0) + bundle
        return {"lang": list(summed), "bundle": list(summed.values())}

    made = arrow_map(labelled.select("text", "lang"), "lang string, bundle array<double>", each)
    summed = (
        made.select("lang", F.posexplode("bundle").alias("at", "value"))
        .groupBy("lang", "at")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("bundle"))
        .select("lang", "bundle.value")
        .orderBy("lang")
        .collect()
    )
    if not summed:
        return [], np.zeros((0, dimensions))
    profiles = np.array([row["value"] for row in summed])
    return [row["lang"] for row in summed], profiles / np.linalg.norm(profiles, axis=1, keepdims=True)


def predict(docs: DataFrame, names: list[str], profiles: np.ndarray, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` with lang_pred and score, the cosine (0 where negative).

    A text that is null or has no letter is `und` with score 0, as is every text when no language was
    learned. Equal cosines give the first language by name.
    """
    dimensions = profiles.shape[1]
    rows = docs.select(F.col(text_col).alias("__text"), *[F.col(f"`{c}`") for c in keep])
    shared = profiles.astype(np.float32)

    def each(batch: pa.RecordBatch) -> dict:
        predicted: list[str] = []
        scores: list[float] = []
        for texts in parts(texts_of(batch, "__text")):
            letters, _, counted = windows_of(texts)
            some = [nth for nth, (keys, _) in enumerate(counted) if len(keys)] if names else []
            first = len(predicted)
            predicted += ["und"] * len(counted)
            scores += [0.0] * len(counted)
            if some:
                made = bundles([counted[nth] for nth in some], letters, dimensions)
                lengths = np.linalg.norm(made, axis=1)
                cosines = made @ shared.T / np.where(lengths > 0, lengths, 1)[:, None]
                for nth, best, row in zip(some, cosines.argmax(1), cosines, strict=True):
                    predicted[first + nth], scores[first + nth] = names[best], float(min(max(row[best], 0.0), 1.0))
        kept = {c: batch.column(1 + nth) for nth, c in enumerate(keep)}
        return kept | {"lang_pred": predicted, "score": scores}

    kinds = dict(docs.dtypes)
    fields = "".join(f"`{c}` {kinds[c]}, " for c in keep)
    return arrow_map(rows, f"{fields}lang_pred string, score double", each, "__text")


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def learnable(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows that are not held out and have a text and a lang."""
    return docs.filter(~held_out(id_col) & F.col("lang").isNotNull() & F.col("text").isNotNull())


def identify(docs: DataFrame, keep: list[str], id_col: str = "doc_id", dimensions: int = DIMENSIONS) -> DataFrame:
    """Learn from the rows that are not held out and have a lang; predict all rows."""
    return predict(docs, *learn(learnable(docs, id_col), dimensions), keep)
