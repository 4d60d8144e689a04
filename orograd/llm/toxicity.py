"""Toxicity of texts after noisy-channel deobfuscation."""

from __future__ import annotations

import math
import re
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import some_rows, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What a written sign may stand for (fixed values).
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i",
        "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
FILLERS = "*_-.~·#^`'"                                       # signs written between letters
SIGN_COST, FILLER_COST, REPEAT_COST, KEEP_COST = 0.7, 0.4, 0.4, 3.0

WORD = re.compile(r"[^\W\d_]+")
EDGES = "\"',;:?.()[]{}<>"
# chunks between white space worth decoding: a sign beside a letter, or three equal letters
SIGN = re.compile(r"[\d@$!|+(€£*_\-.~·#^`'][^\W\d_]|^[^\W\d_][\d@$!|+(€£*_\-.~·#^`']|[^\W\d_][\d@$|(€£]|([^\W\d_])\1\1")
DOUBLED = re.compile(r"([^\W\d_])\1")
# single letters or signs in a row with white space between, for three or more; punctuation may follow the last
SPACED = re.compile(r"(?<=\s)(?:[^\W_]|[@$!|+(€£])(?:\s(?:[^\W_]|[@$!|+(€£])){2,}(?=[\s.,;:!?\"')\]}])")
MAYBE_SPACED = re.compile(r"\s\S\s\S\s\S[\s.,;:!?\"')\]}]")
LONG_TOKEN = 400      # a longer run without white space is decoded in stretches of so many signs
LONGEST_WORD = 40     # signs that stretches share, so that a word on a border is whole in one
PREFIXES = (4, 5)
MIN_ROWS, MIN_G2 = 4, 16.0
DOUBT = 2.0              # standard errors taken off a log-odds: rare words count for less
MAX_FEATURES = 4_000   # most telling words and beginnings, by significance: the bound of what the driver holds
FIT_ROWS = 20_000      # about so many labelled texts at most, by a hash of the id, teach words and weights
PENALTY, STEPS = 0.1, 600
UNTAUGHT = 0.25        # score of every text where labels of one kind at most are known
PRUNE = 100_000
MEMO_ENTRIES, LONG_CHUNK = 40_000, 80    # what a worker's dictionary holds: some MB
TEXT_CHARS = 1_000_000

# The letter model's alphabet has 128 symbols whatever the corpus: begin, a to z, end, and 100 that other letters share.
SYMBOLS, LATIN, END = 128, 26, 27
PLANE = 0x10000


def symbol(letter: str) -> int:
    k = ord(letter)
    return k - 96 if 97 <= k <= 122 else END + 1 + (k * 40503 >> 3) % (SYMBOLS - END - 1)


def symbol_table() -> np.ndarray:
    """Symbols of the code points of the basic plane; 0 where no letter is."""
    return np.array([symbol(c) if c.isalpha() else 0 for c in map(chr, range(PLANE))], dtype=np.int32)


def gram_numbers(text: str, table: np.ndarray) -> np.ndarray:
    """Numbers of the letter trigrams of all words of a lower-case text, their begins and ends included."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    s = table[np.minimum(points, PLANE - 1)]
    for k in np.flatnonzero(points >= PLANE).tolist():
        c = chr(points[k])
        s[k] = symbol(c) if c.isalpha() else 0
    a, b, c = np.concatenate([[0], s[:-2]]), s[:-1], s[1:]
    a = np.where(b > 0, a, 0)
    c = np.where((c == 0) & (b > 0), END, c)
    return ((a * SYMBOLS + b) * SYMBOLS + c)[c > 0]


def letter_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Letter trigrams inside the words of all texts: (gram, n), at most SYMBOLS ** 3 of them whatever the corpus."""
    def count(batches):
        table, sums = symbol_table(), np.zeros(SYMBOLS ** 3, dtype=np.int64)
        held, size = [], 0
        for batch in batches:
            for text in (t for part in some_rows(batch) for t in part.column(0).to_pylist()):
                for lo in range(0, len(text), TEXT_CHARS):  # at a cut within a very long text one word counts as two
                    held.append(text[lo:lo + TEXT_CHARS].lower())
                    size += len(held[-1])
                    if size >= TEXT_CHARS:
                        sums += np.bincount(gram_numbers(" ".join(held), table), minlength=len(sums))
                        held, size = [], 0
        sums += np.bincount(gram_numbers(" ".join(held), table), minlength=len(sums))
        own = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(own.astype(np.int32)), "n": pa.array(sums[own])})

    rows = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
    return rows.mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def letter_model(grams: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log-probabilities of a symbol after two others, backing off to one and to none, as a flat array."""
    counts = np.zeros(SYMBOLS ** 3)
    counts[grams] = n
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    pair = three.sum(axis=0)
    one = (pair.sum(axis=0) + 0.5) / (pair.sum() + 0.5 * SYMBOLS)
    two = (pair + 2.0 * one) / (pair.sum(axis=1, keepdims=True) + 2.0)
    return np.log((three + 2.0 * two) / (three.sum(axis=2, keepdims=True) + 2.0)).astype(np.float32).reshape(-1)


class Letters:
    """The letter model of a task: `at[(a * SYMBOLS + b) * SYMBOLS + c]`."""

    def __init__(self, flat: np.ndarray) -> None:
        self.at = memoryview(flat)
        self.symbols: dict[str, int] = {}

    def __call__(self, a: int, b: int, c: int) -> float:
        return self.at[(a * SYMBOLS + b) * SYMBOLS + c]

    def symbol(self, letter: str) -> int:
        k = self.symbols.get(letter)
        if k is None:
            k = self.symbols[letter] = symbol(letter)
        return k


def restore(token: str, model: Letters) -> str:
    """Most likely plain words behind a token: Viterbi over a lattice of signs, fillers and repeated letters.

    A state is the last two letters' symbols, so there are no more states than pairs of letters that the token's
    signs can stand for, and none is left out. A letter costs its log-probability after the two before; reading a sign as a
    letter, dropping a filler and dropping a repeat have fixed costs. At a filler or white space a word may also end,
    at the cost of an end there and of the next word's begin.
    """
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for ch in token.lower():
        new: dict[tuple[int, int], tuple[float, str]] = {}

        def put(key, score, word):
            if key not in new or score > new[key][0]:
                new[key] = (score, word)

        letters = [(ch, 0.0)] if ch.isalpha() else [(c, -SIGN_COST) for c in LEET.get(ch, "")]
        letters = [(c, model.symbol(c), cost) for c, cost in letters]
        filler = not letters or ch in FILLERS or ch.isspace()
        for (a, b), (score, word) in states.items():
            for c, s, cost in letters:
                put((b, s), score + cost + model(a, b, s), word + c)
                if s == b and word.endswith(c):
                    put((a, b), score + cost - REPEAT_COST, word)
            if filler:
                put((a, b), score - FILLER_COST, word)
                if b:
                    put((0, 0), score + model(a, b, END), word + " ")
            elif not ch.isalpha():
                put((a, b), score - KEEP_COST, word)
        states = new
    best = max(((s + (model(a, b, END) if b else 0.0), w) for (a, b), (s, w) in states.items()), default=(0.0, ""))
    return best[1]


def readings(token: str, model: Letters) -> list[str]:
    """Plain words that an odd token most likely stands for."""
    out = []
    for lo in range(0, max(len(token) - LONGEST_WORD, 1), LONG_TOKEN - LONGEST_WORD):
        out += WORD.findall(restore(token[lo:lo + LONG_TOKEN].strip(EDGES), model))
    return out


class _Chunks(dict):
    """Chunk between white space -> (plain words, restored words)."""

    def __init__(self, model: Letters) -> None:
        self.model = model

    def __missing__(self, chunk: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
        out = self.read(chunk)
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        if len(chunk) <= LONG_CHUNK:
            self[chunk] = out
        return out

    def read(self, chunk: str) -> tuple:
        core = chunk.strip(EDGES)
        odd = SIGN.search(core) if len(core) > 2 else None
        return tuple(WORD.findall(chunk)), tuple(readings(core, self.model)) if odd else ()


def spaced_runs(low: str) -> list[str]:
    padded = f" {low} "
    return [m[0] for m in SPACED.finditer(padded)] if MAYBE_SPACED.search(padded) else []


def _words(text: str, chunks: _Chunks) -> tuple[set[str], set[str]]:
    """Distinct plain words of the whole text, and words restored from its odd chunks and spaced-out letters."""
    low = text.lower()
    plain: set[str] = set()
    restored: set[str] = set()
    for chunk in set(low.split()):
        a, b = chunks[chunk]
        plain.update(a)
        if b:
            restored.update(b)
    for run in spaced_runs(low):
        restored.update(readings(run, chunks.model))
    return plain, restored


def _squeezed(word: str) -> str:
    return re.sub(r"(.)\1+", r"\1", word)


def _beginnings(word: str) -> list[str]:
    return [word, *[word[:n] + "*" for n in PREFIXES if len(word) > n]]


def _with_beginnings(words: set[str]) -> set[str]:
    return {f for w in words for f in _beginnings(w)}


class _Features(_Chunks):
    """Chunk between white space -> numbers of the features that its plain and restored words have; mostly none."""

    def __init__(self, model: Letters, names: list[str]) -> None:
        super().__init__(model)
        self.place = {f: k for k, f in enumerate(names)}
        self.words = [w for w in names if not w.endswith("*")]
        self.squeezed = {_squeezed(w): w for w in sorted(self.words)}

    def numbers(self, words, restored: bool = False) -> set[int]:
        if restored:  # a repeat may be one letter or two
            words = [self.squeezed.get(_squeezed(w), w) for w in words]
        return {self.place[f] for w in words for f in _beginnings(w) if f in self.place}

    def read(self, chunk: str) -> tuple:
        plain, restored = super().read(chunk)
        if not restored:  # doubled letters are opened where a telling word may be behind them
            restored = [w for w in plain if DOUBLED.search(w) and _squeezed(w) in self.squeezed]
        return tuple(self.numbers(plain) | self.numbers(restored, True))

    def of(self, text: str) -> set[int]:
        low = text.lower()
        own: set[int] = set()
        for chunk in set(low.split()):
            found = self[chunk]
            if found:
                own.update(found)
        for run in spaced_runs(low):
            own |= self.numbers(readings(run, self.model), True)
        return own


def _model(counts: DataFrame) -> np.ndarray:
    rows = counts.collect()  # bounded by the alphabet
    return letter_model(np.array([r["gram"] for r in rows], dtype=np.int64), np.array([r["n"] for r in rows], dtype=np.float64))


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> dict:
    """Letter model from all texts and the telling words and word beginnings from labelled texts.

    A feature is kept when it speaks for the label, MIN_ROWS texts hold it and its log-likelihood ratio
    is MIN_G2 or more; logistic regression weighs it. Both learn from all labelled texts, or from
    about FIT_ROWS of them chosen by a hash of the id where there are more. Rows without label or text teach nothing; where an id has several labels, the highest counts.
    """
    model = docs.sparkSession.sparkContext.broadcast(_model(letter_counts(docs, text_col)))  # of fixed size
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.col(label_col).cast("int")).alias("label"))
    known = written(known, "labels")
    share = int(1_000_000 * min(1.0, FIT_ROWS / max(known.count(), 1)))
    known = known.where(F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1_000_000)) < share)
    # about FIT_ROWS narrow rows at most whatever the corpus, so every task may have them and no text moves
    taught = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(known), "id")

    def count(batches):
        chunks = _Chunks(Letters(model.value))
        sums: dict[str, list[int]] = {}
        rows = [0, 0]
        for pdf in batches:
            for label, text in zip(pdf["label"], pdf["text"]):
                rows[label] += 1
                for f in _with_beginnings(set.union(*_words(text, chunks))):
                    s = sums.get(f)
                    if s is None:
                        s = sums[f] = [0, 0]
                    s[label] += 1
            if len(sums) > PRUNE:
                yield _counted(sums)
                sums = {}
        yield _counted(sums)
        yield pd.DataFrame({"f": [""], "n0": [rows[0]], "n1": [rows[1]]})

    sums = taught.mapInPandas(count, "f string, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    sums = written(sums.where(f"n1 > 0 and n0 + n1 >= {MIN_ROWS} or f = ''"), "toxic-words")
    rows = sums.where("f = ''").first()
    n0, n1 = (rows["n0"], rows["n1"]) if rows else (0, 0)
    a, b = F.col("n1").cast("double"), F.col("n0").cast("double")
    c, d, total = n1 - a, n0 - b, float(max(n0 + n1, 1))

    def part(seen, row, column):
        return F.when(seen > 0, seen * F.log(seen * total / (row * column))).otherwise(0.0)

    g2 = 2 * (part(a, a + b, F.lit(float(n1))) + part(b, a + b, F.lit(float(n0))) + part(c, c + d, F.lit(float(n1))) + part(d, c + d, F.lit(float(n0))))
    best = sums.where("f <> ''").select("f", g2.alias("g2")).where((F.col("g2") >= MIN_G2) & (a * (n0 + 0.5) > b * (n1 + 0.5)))
    names = [r["f"] for r in best.orderBy(F.desc("g2"), "f").limit(MAX_FEATURES).collect()]

    def features(batches):
        chunks = _Features(Letters(model.value), names)
        for pdf in batches:
            yield pd.DataFrame({"label": pdf["label"], "own": [sorted(chunks.of(t)) for t in pdf["text"]]})

    chosen = taught.mapInPandas(features, "label int, own array<int>")
    weights, bias = fit([(r["label"], r["own"]) for r in chosen.collect()], len(names))
    weights = {f: float(w) for f, w in zip(names, weights)}
    return {"model": model, "weights": weights, "prior": bias}


def fit(rows: list[tuple[int, list[int]]], n: int) -> tuple[np.ndarray, float]:
    """Logistic regression with a square penalty on few, sparse features, by accelerated gradient steps."""
    if not rows or len({r[0] for r in rows}) < 2:
        return np.zeros(n), math.log(UNTAUGHT / (1 - UNTAUGHT))
    y = np.array([r[0] for r in rows], dtype=np.float64)
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    col = np.array([k for r in rows for k in r[1]], dtype=np.int64)
    most = np.bincount(row, minlength=len(rows)).max() + 1
    # each weight has a step of its own, from the curvature that its rows can add at most
    rate = 1.0 / (PENALTY + 0.25 * np.bincount(col, weights=np.bincount(row, minlength=len(rows))[row] + 1.0, minlength=n))
    w, b = np.zeros(n), math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    v, vb, step = w.copy(), b, 1.0 / (0.25 * len(y) * max(most / 4, 1))
    for k in range(STEPS):
        p = 1.0 / (1.0 + np.exp(-np.clip(np.bincount(row, weights=v[col], minlength=len(y)) + vb, -30, 30)))
        r = p - y
        new = v - rate * (np.bincount(col, weights=r[row], minlength=n) + PENALTY * v)
        new_b = vb - step * r.sum()
        m = k / (k + 3)
        v, vb = new + m * (new - w), new_b + m * (new_b - b)
        w, b = new, new_b
    return w, float(b)


def _counted(sums: dict[str, list[int]]) -> pd.DataFrame:
    n = np.array(list(sums.values()), dtype=np.int64).reshape(-1, 2)
    return pd.DataFrame({"f": pd.Series(list(sums), dtype=object), "n0": n[:, 0], "n1": n[:, 1]})


def score(docs: DataFrame, learned: dict, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, score): probability that a text is toxic, from the telling words in its restored text.

    The weights of the telling words and beginnings that it holds add up, each once. NULL and empty texts have the
    prior's probability; without labels of both kinds every text has UNTAUGHT, so nothing is rejected.
    """
    def run(batches):
        weights = list(learned["weights"].values())
        chunks = _Features(Letters(learned["model"].value), list(learned["weights"]))
        for batch in batches:
            out = []
            for text in (t for part in some_rows(batch) for t in part.column(1).to_pylist()):
                s = learned["prior"]
                if isinstance(text, str):
                    s += sum(weights[k] for k in sorted(chunks.of(text)))
                out.append(1.0 / (1.0 + math.exp(-max(min(s, 30.0), -30.0))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    made = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, score double")
    return made.withColumnRenamed("id", id_col)
