"""Fuzzy line dedup: SimHash of blocks of words, pigeonhole join, edit similarity, one line kept per connected group.

A line's distinct words are dealt to blocks by their hash, and each block has a SimHash. A changed word touches two blocks at
most, so lines that differ in few words share a block whole. Parts of one SimHash over the whole line would not do: one word of
twenty exchanged turns bits all over it.
"""

from __future__ import annotations

import itertools
import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_pairs, components, forest, fresh, some_rows, tasks, written
from .shingles import MULTIPLIER, _mixed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIMILARITY = 0.9
FEW_WORDS = 14           # up to so many words a line is known by itself and by all its words but one
BLOCKS = ((24, 5), (50, 6), (100, 10), (200, 18))   # words of a line at most, and blocks; a twelfth of the words beyond
LEAST_WORDS = 4          # a block of fewer words takes in those after it: few common words alone would bring unlike lines together
LENGTH_STEP = 1.5        # lines meet within a class of lengths of this ratio
SHORT, NO_WORDS = 20, 40  # letters below which a line is known by all its letters but one; up to the second, lines of two words too
NEVER = 10               # letters below which lines within the similarity are equal
PLANE, PLACES = 0x10000, 4096  # code points looked up in a table, letters of a word that have multipliers of their own
HASHED_CHARS = 500_000   # letters hashed at once, or one longer line
LINES_MET = 200_000      # whose hashes a worker keeps
LEAST_BUCKETS = 256      # of keys, each matched in one call; two to a shuffle partition if that is more
BLOCK_ROWS = 2048        # texts are copied once per block of their group, so blocks are large
CROWD_BLOCKS = 16        # of a component at most, or it may be compared star by star
BATCH_ROWS = 8192        # lines that small groups bring together in one call
LONG_LINE = 4096         # letters beyond which pairs are compared one by one
SKIPS = sorted(((u, v) for u in range(5) for v in range(5) if u + v), key=lambda x: (sum(x), abs(x[0] - x[1])))  # words left out before the next equal one
PIVOTS = 64              # lines of a bucket that meet the others in one turn, at most
FEW_PAIRS = 8            # so do fewer pairs of near lengths
TABLE_CELLS = 500_000    # letters of the pairs compared at once
PROFILE_BITS = 9         # of the hash of two letters
FAR = 30_000             # a distance beyond any within
SCAN_CHARS = 4_000_000   # text worked on at once in a task, or one longer text
UNEVEN = ["  ", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")]  # a text without them has its words parted by one blank
LANES = 255              # words counted in one byte lane before it is full


def normal(line: str) -> str:
    """Lower case, white space collapsed: what counts as the same line."""
    return " ".join(line.lower().split())


# a byte's eight bits, each in a byte lane of its own
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64)[:, 0]


def simhashes(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit SimHash of each line from the hashes of its distinct words; a line without words has 0.

    Eight bits are counted at once in the byte lanes of one number, over stretches of at most 255 words.
    """
    out = np.zeros(len(lengths), dtype=np.uint64)
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    n = lengths[full]
    stretches = -(-n // LANES)
    first = np.cumsum(n) - n
    at = np.arange(stretches.sum()) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    starts = np.repeat(first, stretches) + at * LANES
    owner = np.cumsum(stretches) - stretches
    octets = np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8)
    short = len(starts) == len(full)
    half = (n // 2).astype(np.uint8 if short else np.int64)[:, None]
    most = np.empty((len(full), 64), dtype=bool)
    for k in range(8):
        lanes = np.add.reduceat(_SPREAD[octets[:, k]], starts).view(np.uint8).reshape(-1, 8)
        most[:, 8 * k:8 * k + 8] = (lanes if short else np.add.reduceat(lanes, owner, axis=0, dtype=np.int64)) > half
    out[full] = np.packbits(most, axis=1).view(np.uint64)[:, 0]
    return out


def blocks_of(n: np.ndarray) -> np.ndarray:
    """Blocks of a line of n distinct words; 0 for those known by all their words but one."""
    out = np.where(n > BLOCKS[-1][0], 1 << (np.ceil(np.log2(np.maximum(n, 1) / BLOCKS[-1][0])).astype(np.int64) + 4), 0)
    for most, blocks in reversed(BLOCKS):
        out = np.where(n <= most, blocks, out)
    return np.where(n <= FEW_WORDS, 0, out)


def _length_class(letters: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(letters, 1)) / np.log(LENGTH_STEP)).astype(np.int64)


def _block_sims(line: np.ndarray, words: np.ndarray, mixed: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, block, SimHash) of each block; one of fewer than LEAST_WORDS words with the line's next blocks."""
    width = int(blocks.max()) + 1
    at = line * width + (mixed % blocks.astype(np.uint64)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    at, words = at[order], words[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    size = np.diff(np.append(first, len(at)))
    of = at[first] // width
    begin = np.searchsorted(of, of)                       # first block of the line, and how many it has
    many = np.searchsorted(of, of, side="right") - begin
    me = np.arange(len(first))
    owner, source, total = [me], [me], size.copy()
    for k in range(1, int(many.max())):
        more = np.flatnonzero((total < LEAST_WORDS) & (k < many))
        if not len(more):
            break
        after = begin[more] + (more - begin[more] + k) % many[more]
        owner.append(more)
        source.append(after)
        total[more] += size[after]
    owner, source = np.concatenate(owner), np.concatenate(source)
    order = np.argsort(owner, kind="stable")
    source = source[order]
    n = size[source]
    places = np.arange(n.sum()) + np.repeat(first[source] - (np.cumsum(n) - n), n)
    return of, at[first] % width, simhashes(words[places], total)


def block_keys(words: np.ndarray, n: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of lines given as their distinct words' hashes in a row, n of each, and their lengths.

    Lines of up to FEW_WORDS have a key for all words and one for all but each. Longer ones have the SimHash of every block. A key counts
    within a class of lengths. Where a line a tenth longer would have other blocks or another class, it has those keys too,
    so lines on both sides of a limit meet.
    """
    line, mixed = np.repeat(np.arange(len(n)), n), _mixed(words)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    few = (n >= 3) & (n <= FEW_WORDS)
    with np.errstate(over="ignore"):
        if few.any():
            sums = np.zeros(len(n), dtype=np.uint64)
            full = np.flatnonzero(n)
            sums[full] = np.add.reduceat(mixed, (np.cumsum(n) - n)[full])
            own = np.flatnonzero(few[line])
            out += [(line[own], _mixed(sums[line[own]] - mixed[own])), (np.flatnonzero(few), _mixed(sums[few]))]
        here, above = blocks_of(n), blocks_of(np.ceil(1.1 * n).astype(np.int64) + 1)
        for blocks in (here, np.where((above != here) & (n >= 3), above, 0)):
            own = np.flatnonzero(blocks[line])
            if len(own):
                of, block, sims = _block_sims(line[own], words[own], mixed[own], blocks[line[own]])
                out.append((of, _mixed(sims + _mixed((block + (blocks[of] << 32)).astype(np.uint64) * MULTIPLIER))))
        if not out:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        of, key = (np.concatenate(x) for x in zip(*out))
        low, high = _length_class(letters), _length_class(np.ceil(letters / SIMILARITY).astype(np.int64) + 1)
        both = np.flatnonzero(low[of] != high[of])
        klass = np.concatenate([low[of], high[of[both]]]).astype(np.uint64)
        return np.concatenate([of, of[both]]), _mixed(np.concatenate([key, key[both]]) + _mixed(klass * MULTIPLIER))


class Words:
    """Hashes of the distinct words of many lines at once; a word is the letters and digits between white space, none for punctuation alone."""

    def __init__(self) -> None:
        self.letter = np.array([c.isalnum() or c == "_" for c in map(chr, range(PLANE))])
        self.own, self.gap = bytes(self.letter[:256].tolist()), bytes(c in b" \n" for c in range(256))
        self.weight = _mixed(np.arange(1, PLACES + 1, dtype=np.uint64) * MULTIPLIER) | np.uint64(1)

    def __call__(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, number of each line's hashes) of normalised lines."""
        hashes, numbers, lo, size = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)], 0, 0
        for hi, line in enumerate(lines, 1):  # some lines at a time: arrays by letter take memory here
            size += len(line)
            if size >= HASHED_CHARS or hi == len(lines):
                h, n = self._hashed(lines[lo:hi])
                hashes.append(h)
                numbers.append(n)
                lo, size = hi, 0
        return np.concatenate(hashes), np.concatenate(numbers)

    def _hashed(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "\n".join(lines)
        try:
            text = text.encode("latin-1")
            points = np.frombuffer(text, dtype=np.uint8)
            own, gap = (np.frombuffer(text.translate(x), dtype=bool) for x in (self.own, self.gap))
        except UnicodeEncodeError:
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            own, gap = self.letter[np.minimum(points, PLANE - 1)], (points == 32) | (points == 10)
            far = np.flatnonzero(points >= PLANE)
            if len(far):
                kinds, of = np.unique(points[far], return_inverse=True)
                own[far] = np.array([chr(c).isalnum() for c in kinds.tolist()])[of]
        word = np.cumsum(gap, dtype=np.int32)
        at = np.flatnonzero(own)
        if not len(at):
            return np.zeros(0, dtype=np.uint64), np.zeros(len(lines), dtype=np.int64)
        word = word[at]
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
        letters = points[at].astype(np.uint64)
        with np.errstate(over="ignore"):
            if place.max() >= PLACES:
                letters += (place // PLACES).astype(np.uint64) << np.uint64(21)
                place %= PLACES
            h = _mixed(_mixed(np.add.reduceat((letters + np.uint64(1)) * self.weight[place], starts)))
        line = np.searchsorted(np.flatnonzero(points == 10), at[starts])
        order = np.argsort((line.astype(np.uint64) << np.uint64(42)) | (h >> np.uint64(22)))
        line, h = line[order], h[order]
        new = np.ones(len(h), dtype=bool)  # distinct: else a few common words decide
        new[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
        return h[new], np.bincount(line[new], minlength=len(lines))


def letter_keys(line: str) -> list[int]:
    """Keys of a short line: itself and all its letters but one, exact for one letter changed, put in or left out."""
    return [xxhash.xxh64_intdigest(x) for x in {line, *(line[:k] + line[k + 1:] for k in range(len(line)))}]


def _pieces(line: str) -> list[str]:
    """Parts of a long run without white space, cut at letters that its text chooses."""
    c = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    cuts = [0, *(np.flatnonzero((c * np.uint32(40503) >> np.uint32(3)) % np.uint32(8) == 0) + 1).tolist(), len(line)]
    return [line[a:b] for a, b in itertools.pairwise(cuts) if a < b]


def distance_within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most `most`: bit-parallel columns over what differs between common ends."""
    if abs(len(a) - len(b)) > most:
        return False
    k = 0
    for x, y in zip(a, b):
        if x != y:
            break
        k += 1
    a, b = a[k:], b[k:]
    k = 0
    while k < min(len(a), len(b)) and a[-1 - k] == b[-1 - k]:
        k += 1
    a, b = a[:len(a) - k], b[:len(b) - k]
    if not a or not b:
        return max(len(a), len(b)) <= most
    if len(a) < len(b):
        a, b = b, a
    m, mask, top = len(b), (1 << len(b)) - 1, 1 << (len(b) - 1)
    at: dict[str, int] = {}
    for i, c in enumerate(b):
        at[c] = at.get(c, 0) | 1 << i
    up, down, d = mask, 0, m
    for left, c in zip(range(len(a) - 1, -1, -1), a):
        eq = at.get(c, 0)
        xv, xh = eq | down, (((eq & up) + up) ^ up) | eq
        hp, hm = down | (~(xh | up) & mask), up & xh
        if hp & top:
            d += 1
        elif hm & top:
            d -= 1
        if d - left > most:
            return False
        hp, hm = ((hp << 1) | 1) & mask, (hm << 1) & mask
        up, down = hm | (~(xv | hp) & mask), hp & xv
    return d <= most


def similar(a: str, b: str, threshold: float) -> bool:
    """Edit similarity 1 - distance / longer length, at least `threshold`."""
    longest = max(len(a), len(b))
    return distance_within(a, b, int((1 - threshold) * longest + 1e-9))


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        k = (lo + hi + 1) // 2
        lo, hi = (k, hi) if a[lo:k] == b[lo:k] else (lo, k - 1)
    return lo


def _near_by_words(a: str, b: str, most: int) -> bool:
    """Whether an alignment by words, the next equal ones met first, costs at most `most` edits; if not, the distance may still be less."""
    x, y = a.split(" "), b.split(" ")
    i = j = cost = 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            i, j = i + 1, j + 1
            continue
        for u, v in SKIPS:
            if i + u < len(x) and j + v < len(y) and x[i + u] == y[j + v]:
                break
        else:
            u, v = 1, 1
        cost += max(sum(map(len, x[i:i + u])) + u, sum(map(len, y[j:j + v])) + v) - (u == v)
        if cost > most:
            return False
        i, j = i + u, j + v
    return cost + max(sum(map(len, x[i:])) + len(x) - i, sum(map(len, y[j:])) + len(y) - j) <= most


def _grid(texts: list[str], backwards: bool) -> np.ndarray:
    """Code points by (place, text), padded behind the longest text's end, or before its begin if backwards."""
    sizes = np.array([len(t) for t in texts])
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    of = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((sizes.max(), len(texts)), dtype=np.uint16 if points.max() < PLANE else np.uint32)
    out[sizes.max() - 1 - place if backwards else place, of] = points
    return out


def _all_within(a: list[str], b: list[str], most: np.ndarray) -> np.ndarray:
    """`distance_within` of many pairs of similar lengths at once, a never shorter than b, none empty.

    The table of distances is filled by antidiagonals, all pairs together, on the diagonals that a path of `most` edits can touch.
    """
    n, m = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    low, high = int(((most - (n - m)) // 2).max()), int(((most + (n - m)) // 2).max())
    rows, cols = _grid(a, False), _grid(b, True)
    tall, wide, end = len(rows), len(cols), n + m
    table = np.full((3, tall + 3, len(a)), FAR, dtype=np.int16)  # row i + 1 has distances of a's first i letters
    out = np.zeros(len(a), dtype=np.int64)
    order = np.argsort(end)
    done = 0
    for s in range(int(end.max()) + 1):
        new, last, before = table[s % 3], table[(s - 1) % 3], table[(s - 2) % 3]
        lo, hi = max(0, s - wide, -((low - s) // 2)), min(s, tall, (s + high) // 2)
        if lo <= hi:
            new[lo] = new[hi + 2] = FAR
            x, y = max(lo, 1), min(hi, s - 1)
            if x <= y:
                near = np.minimum(last[x:y + 1], last[x + 1:y + 2])
                near += 1
                np.minimum(near, before[x:y + 1] + (rows[x - 1:y] != cols[wide - s + x:wide - s + y + 1]), out=new[x + 1:y + 2])
            if lo == 0:
                new[1] = s
            if hi == s:
                new[s + 1] = s
        while done < len(order) and end[order[done]] == s:
            k = order[done]
            out[k] = new[n[k] + 1, k]
            done += 1
    return out <= most


def _profiles(texts: list[str]) -> np.ndarray:
    """Counts of the pairs of neighbouring letters of each text, by a hash of the two."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    two = np.flatnonzero(of[1:] == of[:-1])
    code = (points[two] * np.uint32(0x9E3779B1) + points[two + 1] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - PROFILE_BITS)
    return np.bincount((of[two] << PROFILE_BITS) + code, minlength=len(texts) << PROFILE_BITS).reshape(len(texts), -1)


def _surely_far(a: list[str], b: list[str], most: list[int]) -> np.ndarray:
    """Whether pairs are beyond `most` edits by their profiles alone: an edit takes two pairs of letters and puts in two at most."""
    out, lo, size = [np.zeros(0, dtype=bool)], 0, 0
    for hi, x in enumerate(a, 1):
        size += len(x) + (1 << PROFILE_BITS)
        if size >= TABLE_CELLS or hi == len(a):
            out.append(np.abs(_profiles(a[lo:hi]) - _profiles(b[lo:hi])).sum(axis=1) > 4 * np.array(most[lo:hi]))
            lo, size = hi, 0
    return np.concatenate(out)


def all_similar(pairs: list[tuple[str, str]], threshold: float) -> np.ndarray:
    """`similar` of many pairs: what differs between their common ends, pairs of near lengths together."""
    out = np.zeros(len(pairs), dtype=bool)
    unsure, left = [], []
    for k, (a, b) in enumerate(pairs):
        most = int((1 - threshold) * max(len(a), len(b)) + 1e-9)
        if abs(len(a) - len(b)) > most:
            continue
        x = _common(a, b)
        a, b = a[x:], b[x:]
        x = _common(a[::-1], b[::-1])
        a, b = a[:len(a) - x], b[:len(b) - x]
        a, b = (a, b) if len(a) >= len(b) else (b, a)
        if len(a) <= most or not b:
            out[k] = len(a) <= most
        else:
            unsure.append((k, most, a, b))
    for (k, most, a, b), far in zip(unsure, _surely_far([x[2] for x in unsure], [x[3] for x in unsure], [x[1] for x in unsure]).tolist()):
        if far:
            continue
        if _near_by_words(a, b, most):
            out[k] = True
        elif len(a) > LONG_LINE:
            out[k] = distance_within(a, b, most)
        else:
            left.append((k, most, a, b))
    left.sort(key=lambda x: len(x[2]))
    lo = 0
    while lo < len(left):
        hi = lo + 1
        while hi < len(left) and len(left[hi][2]) * (hi - lo) < TABLE_CELLS and len(left[hi][2]) <= 1.25 * len(left[lo][2]) + 16:
            hi += 1
        k, most, a, b = zip(*left[lo:hi])
        if len(k) < FEW_PAIRS:
            out[list(k)] = [distance_within(*x) for x in zip(a, b, most)]
        else:
            out[list(k)] = _all_within(list(a), list(b), np.array(most))
        lo = hi
    return out


def _keyed(lines: list[str], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of normalised lines: those of their words, or of their pieces where they have few, or the letter keys of short ones."""
    hashes, n = words(lines)
    letters = np.array([len(x) for x in lines], dtype=np.int64)
    short = (letters < SHORT) | ((n <= 2) & (letters <= NO_WORDS))
    plain = ~short & (n > 2)
    by_words = np.repeat(plain, n)
    line, key = block_keys(hashes[by_words], np.where(plain, n, 0), letters)
    out = [(line, key)]
    cut = np.flatnonzero(~short & ~plain)
    if len(cut):
        pieces = [[xxhash.xxh64_intdigest(x) for x in set(_pieces(lines[k]))] for k in cut.tolist()]
        line, key = block_keys(np.array([x for own in pieces for x in own], dtype=np.uint64), np.array([len(x) for x in pieces], dtype=np.int64), letters[cut])
        out.append((cut[line], key))
    few = np.flatnonzero(short & (letters >= NEVER))
    if len(few):
        own = [letter_keys(lines[k]) for k in few.tolist()]
        out.append((np.repeat(few, [len(x) for x in own]), np.array([x for keys in own for x in keys], dtype=np.uint64)))
    line, key = zip(*out)
    return np.concatenate(line), np.concatenate(key)


def _linked(texts, group, second, crossed, words: Words, threshold: float) -> np.ndarray:
    """For each line the first line of its tree, over similar lines that share a key within their group.

    Of a group that is `crossed`, lines of its second block meet those of its first alone. Lines already connected are not compared.
    """
    line, key = _keyed(list(texts), words)
    order = np.lexsort((line, key, group[line]))
    line, key = line[order], key[order]
    change = np.ones(len(line), dtype=bool)
    change[1:] = (key[1:] != key[:-1]) | (group[line[1:]] != group[line[:-1]])
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(line))
    size, label = np.array([len(t) for t in texts]), np.arange(len(texts))
    two = starts[ends - starts == 2]
    a, b = line[two], line[two + 1]
    own = (a != b) & (~crossed[group[a]] | (second[a] != second[b]))
    met = [a[own] * len(texts) + b[own]]
    rows_of = {}  # lines that share many keys are one bucket
    for lo, hi in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist()):
        rows = np.unique(line[lo:hi])
        if len(rows) > 1:
            rows_of[rows.tobytes()] = rows
    buckets = [(rows[~second[rows]], rows[second[rows]]) if crossed[group[rows[0]]] else (rows, rows) for rows in rows_of.values()]
    failed: set[int] = set()
    lo, hi = 0, 1
    while buckets or lo == 0:  # in each turn some lines of every bucket, more and more, meet those that they aren't connected with yet
        left = []
        for pivots, others in buckets:
            if lo >= len(pivots) or not len(others):
                continue
            left.append((pivots, others))
            for k in range(lo, min(hi, len(pivots))):
                p, q = pivots[k], others[k + 1:] if pivots is others else others
                q = q[label[q] != label[p]]
                q = q[abs(size[q] - size[p]) <= ((1 - threshold) * np.maximum(size[p], size[q]) + 1e-9).astype(np.int64)]
                met.append(np.minimum(p, q) * len(texts) + np.maximum(p, q))
        pairs = np.array([x for x in np.unique(np.concatenate(met)).tolist() if x not in failed] if met else [], dtype=np.int64)
        a, b = np.divmod(pairs, len(texts))
        same = all_similar(list(zip(texts[a], texts[b])), threshold)
        failed.update(pairs[~same].tolist())
        label = forest(label[a[same]], label[b[same]], np.arange(len(texts)))[label]
        buckets = [x for x in left if (label[x[0]] != label[x[0][0]]).any() or (label[x[1]] != label[x[0][0]]).any()]
        met, lo, hi = [], hi, hi + min(hi + 1, PIVOTS)
    return label


def _lists(line: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """The values of each of n lines, `line` in any order."""
    order = np.argsort(line, kind="stable")
    ends = np.searchsorted(line[order], np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[order].view(np.int64)))


def _led(line: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(line, key) of the first line of every key, by key, and (line, first line) of the others, each once."""
    order = np.argsort(key)
    line, key = line[order], key[order]
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(first)
    least, again = line[at], np.flatnonzero(~first)
    of = np.searchsorted(at, again, side="right") - 1
    np.minimum.at(least, of, line[again])
    mixed = np.concatenate([again, at[np.unique(of)]])     # most keys have one line
    leader = least[np.searchsorted(at, mixed, side="right") - 1]
    led = np.unique(np.stack([line[mixed], leader])[:, line[mixed] != leader], axis=1)
    return least, key[at], led[0], led[1]


def _cut(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Stretches of an array as bytes."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((8 * ends).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _numbers(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def _stars(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): each line of a key with the key's least line, each once."""
    _, _, a, b = _led(owners, keys)
    return a, b


def _scanned(texts: list[str], words: Words, met: set[int], bits: int) -> tuple[list[int], list[pa.Array], list[pa.Array]]:
    """Places of the texts and (line, h, times, near) of their lines; (bucket, keys, owners) of the keys by their first `bits` bits."""
    of, at, hashes, times, unmet, lines = [], [], [], [], [], []
    for k, text in enumerate(texts):
        seen: dict[str, int] = {}
        text = text.lower()
        even = not any(x in text for x in UNEVEN)
        for place, line in enumerate(text.split("\n")):
            line = line.strip() if even else " ".join(line.split())
            if not line:
                continue
            if line in seen:
                times[seen[line]] += 1
                continue
            seen[line] = len(of)
            h = xxhash.xxh64_intdigest(line)
            if h not in met:  # an equal line's keys are the same
                if len(met) >= LINES_MET:
                    met.clear()
                met.add(h)
                unmet.append(len(of))
                lines.append(line)
            of.append(k)
            at.append(place)
            times.append(1)
            hashes.append(h)
    line, key = _keyed(lines, words)
    h = np.array(hashes, dtype=np.uint64)
    line, key, led, leader = _led(np.array(unmet, dtype=np.int64)[line], key)
    rows = [pa.array(at, pa.int32()), pa.array(h.view(np.int64)), pa.array(times, pa.int32()), _lists(led, h[leader], len(of))]
    bucket = (key >> np.uint64(64 - bits)).astype(np.int32)
    ends = np.concatenate([np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), [len(key)]]) if len(key) else np.zeros(1, dtype=np.int64)
    return of, rows, [pa.array(bucket[ends[:-1]]), _cut(key, ends), _cut(h[line], ends)]


def line_table(docs: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """(id, line, h, times, near) of the first occurrence in its document of every line that is not blank, and how often it is there.

    Rows with a bucket have none of these: they are the keys of a stretch of text that fall in the bucket, eight bytes each, and the
    hashes of their lines. One row a key would cost several times as much to write, deal out and sort.
    The keys of a line that a task met just before are left out, so a line of very many documents sends few. Of the lines
    of a stretch of text that share a key only the first has it; the others have that line's hash in `near`, so a key
    of very many lines comes once a stretch.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    bits = math.ceil(math.log2(max(LEAST_BUCKETS, 2 * tasks(docs.sparkSession))))
    names = ["id", "line", "h", "times", "near", "bucket", "keys", "owners"]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary()]

    def scan(batches):
        words, met = Words(), set()
        for batch in batches:
            ids, sizes = batch.column(0), np.cumsum(pc.utf8_length(batch.column(1)).to_numpy(zero_copy_only=False))
            cuts = np.flatnonzero(np.diff(sizes // SCAN_CHARS)) + 1  # some texts at a time: words take memory here
            for lo, hi in itertools.pairwise([0, *cuts.tolist(), len(sizes)]):
                of, rows, keys = _scanned(batch.column(1).slice(lo, hi - lo).to_pylist(), words, met, bits)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo).take(pa.array(of, pa.int64())), *rows, *(pa.nulls(len(of), k) for k in kinds[4:])], names)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(keys[0]), k) for k in (ids.type, *kinds[:4])] + keys, names)

    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scan, f"id {kind}, line int, h long, times int, near array<long>, bucket int, keys binary, owners binary")


def _only_lines(lines: DataFrame) -> DataFrame:
    return lines.where("bucket is null").drop("bucket", "keys", "owners")


def _scattered(near: DataFrame, stars: DataFrame, led: DataFrame) -> DataFrame:
    """Candidates by group (id, component_id): components, but those of many blocks by their stars if that deals out fewer lines.

    Chance meetings grow faster than the lines and join components, until most lines are one; its pairs of blocks would grow with
    its square, but its stars grow with the meetings. Lines that share a key are in the star of the key's least line:
    those led by another in their stretch of text go where that one goes.
    """
    dealt_out = F.col("n") * F.ceil(F.col("n") / BLOCK_ROWS)
    most = CROWD_BLOCKS * BLOCK_ROWS
    if near.count() <= most:
        return near
    large = written(near.groupBy("component_id").agg(F.count("*").alias("n")).where(F.col("n") > most), "line-crowds")
    if not large.count():
        return near
    inside = written(near.join(large, "component_id").select("id", "component_id"), "line-crowded")
    above = led.join(stars.select(F.col("a").alias("b"), F.col("b").alias("least")), "b").select("a", F.col("least").alias("b"))
    met = stars.unionByName(led).unionByName(above).join(inside, F.col("b") == F.col("id"))
    met = written(met.select("component_id", "b", F.explode(F.array("a", "b")).alias("a")).distinct(), "line-star-members")
    by_star = met.groupBy("component_id", "b").agg(F.count("*").alias("n")).groupBy("component_id").agg(F.sum(dealt_out).alias("by_star"))
    apart = written(large.join(by_star, "component_id").where(F.col("by_star") < dealt_out).select("component_id"), "line-scattered")
    return near.join(apart, "component_id", "left_anti").select("id", "component_id").unionByName(
        met.join(apart, "component_id").select(F.col("a").alias("id"), F.col("b").alias("component_id")))


def line_groups(lines: DataFrame, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """(id, line, times, h, group_id, kept) of the lines that occur again or resemble another; `lines` from `line_table`.

    Lines equal after normalising are one node. Nodes that share a key (`block_keys`, `letter_keys`) are candidates: surely those that differ in one
    word, or in a letter if short, and nearly all that differ in up to a twelfth of their words; candidates of edit
    similarity `threshold` or more are linked. The kept line of a connected group is the first, by id and then by place.
    Only lines that share a key are compared: chance meetings make groups of candidates large. A key of any number of lines is a star about
    its least, and groups of any size are compared block by block, or star by star.
    """
    packed, lines = lines.where("bucket is not null").select("bucket", "keys", "owners"), _only_lines(lines)
    nodes = written(lines.groupBy("h").agg(F.min("id").alias("witness"), F.min_by("line", "id").alias("place"), F.count("*").alias("k")), "line-nodes")

    def meet(bucket: pa.Table) -> pa.Table:
        a, b = _stars(_numbers(bucket["keys"], np.uint64), _numbers(bucket["owners"], np.int64))
        return pa.table({"a": a, "b": b})

    # a key comes once a stretch of text at most
    stars = written(packed.groupBy("bucket").applyInArrow(meet, "a long, b long"), "line-stars")
    led = lines.where(F.size("near") > 0).select(F.col("h").alias("a"), F.explode("near").alias("b")).distinct()
    near = components(stars.unionByName(led), "line-candidates")
    groups = _scattered(near, stars, led)
    members = groups.join(nodes, groups["id"] == nodes["h"]).select("h", "component_id", "witness", "place")
    dealt = written(block_pairs(members, "component_id", F.col("h"), BLOCK_ROWS), "line-blocks")
    # written, so that Spark knows how little it is before it plans to send all texts to meet it
    asked = written(dealt.select("witness", "place", "h").distinct().groupBy("witness").agg(F.collect_list(F.struct("place", "h")).alias("asked")), "line-asked")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(asked, F.col("id").eqNullSafe(F.col("witness"))).select("text", "asked")

    def fetch(batches):
        for batch in batches:
            h, s, size = [], [], 0
            for text, asked in zip(batch.column(0), batch.column(1)):  # one text at a time, so that few are held
                text = text.as_py()
                parts = text.split("\n") if text is not None else []
                asked = [(x["place"], x["h"]) for x in asked.as_py()]
                wanted = {h for _, h in asked}
                for place in range(len(parts)) if any(x is None for x, _ in asked) else sorted({x for x, _ in asked if x < len(parts)}):
                    line = normal(parts[place])
                    k = xxhash.xxh64_intdigest(line)
                    k -= (k >> 63) << 64
                    if k in wanted:  # not so in other rows of the id; rows without an id have no place and are searched
                        wanted.discard(k)
                        h.append(k)
                        s.append(line)
                        size += len(line)
                if size >= SCAN_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(s, pa.string())], ["h", "s"])
                    h, s, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(s, pa.string())], ["h", "s"])

    spoken = found.mapInArrow(fetch, "h long, s string")
    ready = dealt.join(spoken, "h").select("component_id", "block", "block_a", "block_b", "h", "s")

    def verify_all(pdf):
        """Many small groups, or one pair of blocks, at a time."""
        pdf = pdf.sort_values(["component_id", "block_a", "block_b"], kind="stable").drop_duplicates(["component_id", "block_a", "block_b", "block", "h"])
        marks = pdf[["component_id", "block_a", "block_b"]].to_numpy()
        new = (marks[1:] != marks[:-1]).any(axis=1)
        group = np.concatenate([[0], np.cumsum(new)]) if len(pdf) else np.zeros(0, dtype=np.int64)
        crossed = (marks[:, 1] != marks[:, 2])[np.flatnonzero(np.concatenate([[True], new]))] if len(pdf) else np.zeros(0, dtype=bool)
        h, texts = pdf["h"].to_numpy(), pdf["s"].to_numpy()
        label = _linked(texts, group, pdf["block"].to_numpy() != pdf["block_a"].to_numpy(), crossed, Words(), threshold)
        led = label != np.arange(len(h))
        return pd.DataFrame({"a": h[led], "b": h[label[led]]})

    # small groups share calls; a pair of blocks is a group of its own whatever its size
    batches = max(1, -(-dealt.count() // BATCH_ROWS))
    linked = ready.withColumn("batch", F.pmod(F.xxhash64("component_id", "block_a", "block_b"), F.lit(batches))).groupBy("batch").applyInPandas(verify_all, "a long, b long")
    groups = components(written(linked, "line-links"), "line-classes")
    some = nodes.select("h", "witness", "place", "k").join(groups.withColumnRenamed("id", "h"), "h", "left").where("k > 1 or component_id is not null")
    some = written(some.select("h", "component_id", "witness", "place"), "line-repeats")
    first = some.where("component_id is not null").groupBy("component_id").agg(F.min(F.struct("witness", "place")).alias("first"))
    fuzzy = some.join(first, "component_id").select("h", F.col("component_id").alias("group_id"), F.col("first.witness").alias("first_id"), F.col("first.place").alias("first_line"))
    equal = some.where("component_id is null").select("h", F.col("h").alias("group_id"), F.col("witness").alias("first_id"), F.col("place").alias("first_line"))
    kept = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("line") == F.col("first_line"))
    return lines.drop("near").join(fuzzy.unionByName(equal), "h").select("id", "line", "times", "h", "group_id", kept.alias("kept"))


def line_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row per document that has a line: (id, n_lines, n_kept, dropped): numbers of its lines that are dropped.

    `dropped` has the place, from 0, of each dropped line's first occurrence; a line repeated within a document
    stands for its repeats, of which at most the first is kept. Rows of one id count as one document. NULL
    and blank texts have no lines.
    """
    lines = written(line_table(docs, id_col=id_col, text_col=text_col), "lines")
    g = line_groups(lines, docs, id_col=id_col, text_col=text_col, threshold=threshold)
    gone = g.where(~F.col("kept")).groupBy(F.col("id").alias("of")).agg(F.sort_array(F.collect_list("line")).alias("dropped"))
    per = _only_lines(lines).groupBy("id").agg(F.sum("times").alias("n_lines"), F.count("*").alias("distinct_lines"))
    out = per.join(gone, F.col("id").eqNullSafe(F.col("of")), "left").withColumn("dropped", F.coalesce("dropped", F.array().cast("array<int>")))
    return out.select(F.col("id").alias(id_col), "n_lines", (F.col("distinct_lines") - F.size("dropped")).alias("n_kept"), "dropped")


def _without(text: str | None, lost: list[int] | None) -> str | None:
    """The text without lines of those hashes and without those that it had before."""
    if text is None:
        return None
    seen, keep, lines = set(lost or ()), [], text.split("\n")
    for line in lines:
        flat = normal(line)
        h = xxhash.xxh64_intdigest(flat) if flat else None
        h = h if h is None else h - ((h >> 63) << 64)
        if h is None or h not in seen:
            keep.append(line)
            if h is not None:
                seen.add(h)
    return "\n".join(keep) if len(keep) < len(lines) else text


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """The documents with one line kept per group of near-equal lines; blank lines and all columns stay.

    Of a repeated line only the first is kept. A NULL text stays NULL, a text may become empty.
    """
    lines = written(line_table(docs, id_col=id_col, text_col=text_col), "lines")
    g = line_groups(lines, docs, id_col=id_col, text_col=text_col, threshold=threshold)
    key, gone = fresh(docs, "gone_id"), fresh(docs, "gone_lines")
    lost = g.where(~F.col("kept")).select("id", "h").distinct().groupBy(F.col("id").alias(key)).agg(F.collect_list("h").alias(gone))

    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lost in batches:
            for part, own in zip(some_rows(texts), some_rows(lost)):
                yield pa.array([_without(*x) for x in zip(part.to_pylist(), own.to_pylist())], pa.string())

    joined = docs.join(lost, docs[id_col].eqNullSafe(F.col(key)), "left").drop(key)
    return joined.withColumn(text_col, cut(F.col(text_col).cast("string"), F.col(gone))).drop(gone)
