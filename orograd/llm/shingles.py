"""Word shingles and MinHash signatures of whole texts."""

from __future__ import annotations

import re
import sys

import numpy as np
import xxhash
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = re.compile(r"\w+")
CHUNKS_KEPT = 200_000
LONG_CHUNK = 80
STEP = 512                       # shingles hashed at once
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Chunk between white space -> 64-bit hashes of its words, as bytes."""

    def __missing__(self, chunk: str) -> bytes:
        out = b"".join([xxhash.xxh64_intdigest(w).to_bytes(8, "little") for w in WORD.findall(chunk)])
        if len(self) >= CHUNKS_KEPT:
            self.clear()
        if len(chunk) <= LONG_CHUNK:
            self[chunk] = out
        return out


def word_hashes(text: str | None, chunks: WordHashes) -> np.ndarray:
    """Hashes of a text's words in order; words are runs of letters, digits and underscores in lower case."""
    return np.frombuffer(b"".join(map(chunks.__getitem__, text.lower().split())), dtype="<u8") if text else np.zeros(0, dtype="<u8")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * MULTIPLIER
    return h ^ (h >> np.uint64(32))


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `width` words; a shorter text is one shingle, one without words none."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    n = max(len(words) - width + 1, 1)
    h = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(width, len(words))):
            h = h * MULTIPLIER + _mixed(words[k:k + n])
        return np.unique(_mixed(h + np.uint64(min(width, len(words)))))


def bands_for(threshold: float, recall: float, hashes: int) -> tuple[int, int]:
    """(bands, rows): the longest rows, so the fewest false candidates, that find `recall` of pairs at `threshold`."""
    for rows in range(32, 0, -1):
        bands = hashes // rows
        if bands and 1 - (1 - threshold ** rows) ** bands >= recall:
            return bands, rows
    raise ValueError("no banding reaches that recall with so few hashes")


class MinHash:
    def __init__(self, bands: int, rows: int, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.shape = bands, rows
        self.a = (rng.integers(0, 1 << 31, bands * rows, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        """One 64-bit hash per band, its number included; equal sets have equal hashes."""
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.a), 0xFFFFFFFF, dtype=np.uint32)
        with np.errstate(over="ignore"):
            for k in range(0, len(x), STEP):
                np.minimum(low, (np.multiply.outer(x[k:k + STEP], self.a) + self.b).min(axis=0), out=low)
            m = low.reshape(self.shape).astype(np.uint64)
            h = np.arange(self.shape[0], dtype=np.uint64) * np.uint64(0x100000001B3)
            for k in range(self.shape[1]):
                h = _mixed(h * MULTIPLIER + m[:, k])
        return h.view(np.int64)
