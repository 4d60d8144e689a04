"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_fold

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMENSIONS = 1024
CODES = 1024           # letters below U+0300 have a code of their own, others share the rest by remainder
PLAIN = 0x300
ROWS_HELD = 16_384     # n-gram vectors that a task holds; more are made anew when they are met again
PART = 4_000_000       # characters worked on at once, so that a very long text stays within memory
UNKNOWN = "und"


def letter_vectors(dimensions: int = DIMENSIONS, seed: int = 11) -> np.ndarray:
    """One random vector of +1 and -1 per letter code; code 0 is the gap between words."""
    return (np.random.default_rng(seed).integers(0, 2, (CODES, dimensions), dtype=np.int8) * 2 - 1).astype(np.int8)


def _code_table() -> np.ndarray:
    table = np.zeros(sys.maxunicode + 1, dtype=np.uint16)
    for cp in range(PLAIN):
        if chr(cp).isalpha():
            table[cp] = cp + 1
    for cp in range(PLAIN, sys.maxunicode + 1):
        if chr(cp).isalpha():
            table[cp] = PLAIN + 1 + cp % (CODES - PLAIN - 1)
    return table


def _shared(name: str, make):
    """Made once per Python worker; functions that travel by value have no lasting globals."""
    held = sys.__dict__.setdefault("_orograd_language", {})
    if name not in held:
        held[name] = make()
    return held[name]


def trigrams(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigram numbers of the whole text and their counts; other characters are one gap between words."""
    found: dict[int, int] = {}
    before = np.zeros(1, dtype=np.int64)  # codes that the next part goes on from; a text begins with a gap
    parts = []
    for lo in range(0, len(text), PART):
        codes = table[np.frombuffer(text[lo:lo + PART].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].astype(np.int64)
        if lo + PART >= len(text):
            codes = np.concatenate([codes, [0]])
        codes = np.concatenate([before, codes])
        codes = codes[np.concatenate([[True], (codes[1:] > 0) | (codes[:-1] > 0)])]
        before = codes[-2:]
        if len(codes) > 2:
            parts.append(np.unique((codes[:-2] << 20) | (codes[1:-1] << 10) | codes[2:], return_counts=True))
    if len(parts) == 1:
        return parts[0]
    for g, n in parts:
        for k, m in zip(g.tolist(), n.tolist()):
            found[k] = found.get(k, 0) + m
    return np.array(list(found), dtype=np.int64), np.array(list(found.values()), dtype=np.int64)


class GramVectors:
    """Vectors of n-grams: each letter's vector is permuted by its place and the three are bound by multiplying."""

    def __init__(self, dimensions: int) -> None:
        letters = letter_vectors(dimensions)
        rng = np.random.default_rng(12)
        p1, p2 = rng.permutation(dimensions), rng.permutation(dimensions)
        self.last, self.middle, self.first = letters, letters[:, p1], letters[:, p1][:, p2]
        self.place: dict[int, int] = {}
        self.rows = np.empty((ROWS_HELD, dimensions), dtype=np.float32)

    def make(self, grams: np.ndarray) -> np.ndarray:
        return self.first[grams >> 20] * self.middle[(grams >> 10) & 1023] * self.last[grams & 1023]

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the n-grams' vectors, each as often as it occurs."""
        held = self.place
        at = np.array([held.get(g, -1) for g in grams.tolist()], dtype=np.int64)
        new = grams[at < 0]
        if len(new) and len(held) + len(new) <= ROWS_HELD:
            start = len(held)
            self.rows[start:start + len(new)] = self.make(new)
            held.update(zip(new.tolist(), range(start, start + len(new))))
            at[at < 0] = np.arange(start, start + len(new))
            new = new[:0]
        weights = counts.astype(np.float32)
        total = weights[at >= 0] @ self.rows[at[at >= 0]]
        rest, many = grams[at < 0], weights[at < 0]
        for lo in range(0, len(rest), 4096):
            total = total + many[lo:lo + 4096] @ self.make(rest[lo:lo + 4096]).astype(np.float32)
        return total


def profiles(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> DataFrame:
    """Language prototypes (lang, profile): the bundle of all n-gram vectors of its texts.

    Trigrams are counted per language in the tasks and summed; only sums leave them. Rows without
    a language or text teach nothing.
    """
    def count(batches):
        table, sums = _shared("codes", _code_table), {}
        vectors = _shared(f"grams{dimensions}", lambda: GramVectors(dimensions))
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                g, n = trigrams(text, table)
                own = sums.setdefault(lang, {})
                for k, m in zip(g.tolist(), n.tolist()):
                    own[k] = own.get(k, 0) + m
        for lang, own in sums.items():
            v = vectors.bundle(np.array(list(own), dtype=np.int64), np.array(list(own.values()), dtype=np.int64)).astype(np.float64)
            yield pd.DataFrame({"lang": lang, "k": np.arange(dimensions), "x": v})

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    parts = rows.mapInPandas(count, "lang string, k int, x double").groupBy("lang", "k").agg(F.sum("x").alias("x"))
    return parts.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "x"))), lambda s: s.x).alias("profile"))


def identify(docs: DataFrame, learned: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", dimensions: int = DIMENSIONS) -> DataFrame:
    """Add `lang_pred` and `score` to (id, text) rows by cosine with the prototypes.

    `learned` has one row per language, so it fits the driver. The score is the best cosine, at
    least 0. NULL texts and texts without a letter are `und` with score 0, as are all texts where
    nothing was learned. Ties go to the first language by name.
    """
    rows = sorted((r["lang"], r["profile"]) for r in learned.where("lang is not null").collect())
    names = [r[0] for r in rows]
    protos = np.array([r[1] for r in rows], dtype=np.float64).reshape(len(names), dimensions)
    protos /= np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-12)
    protos = protos.T.copy()

    def predict(batches):
        table = _shared("codes", _code_table)
        vectors = _shared(f"grams{dimensions}", lambda: GramVectors(dimensions))
        for pdf in batches:
            out, score = [], []
            for text in pdf["text"]:
                g, n = trigrams(text, table) if isinstance(text, str) and names else (np.zeros(0, dtype=np.int64),) * 2
                if not len(g):
                    out.append(UNKNOWN)
                    score.append(0.0)
                    continue
                v = vectors.bundle(g, n).astype(np.float64)
                cos = v @ protos / max(float(np.linalg.norm(v)), 1e-12)
                best = int(np.argmax(np.round(cos, 12)))
                out.append(names[best])
                score.append(float(min(max(cos[best], 0.0), 1.0)))
            yield pd.DataFrame({"id": pdf["id"], "lang_pred": pd.Series(out, dtype=object), "score": score})

    kind = docs.schema[id_col].dataType.simpleString()
    made = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInPandas(
        predict, f"id {kind}, lang_pred string, score double")
    return made.withColumnRenamed("id", id_col)


def held_out(id_col: str | Column, folds: int, fold: int) -> Column:
    return crc_fold(id_col, folds) == fold
