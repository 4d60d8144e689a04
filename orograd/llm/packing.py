"""Packing token pieces into sequences: best fit by size, then swap-based local search."""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, written
from .tokens import default_path, encoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 16_384   # pieces that one task packs
TEXT_ROWS = 200


def token_pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Token ids of every document and the end id, cut at `capacity` only where they are longer.

    Rows (id, piece, start, length, ids_crc32), with the ids as little-endian uint32 bytes on
    request. A NULL or empty text is the end id alone; repeated rows are pieces of their own.
    """
    path = path or default_path()
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches):
        encode = encoder(path)
        for pdf in batches:
            for lo in range(0, len(pdf), TEXT_ROWS):  # a few texts at a time, as some are very long
                rows = []
                part = pdf.iloc[lo:lo + TEXT_ROWS]
                for key, text in zip(part["id"].array, part["text"].array):
                    ids = encode(text if isinstance(text, str) else None) + end
                    for k in range(0, len(ids), 4 * capacity):
                        own = ids[k:k + 4 * capacity]
                        rows.append((key, k // (4 * capacity), k // 4, len(own) // 4, zlib.crc32(own), own if keep_ids else None))
                out = pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32", "ids"])
                out["id"] = out["id"].astype(pdf["id"].dtype)
                yield out

    made = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInPandas(
        cut, f"id {kind}, piece int, start long, length long, ids_crc32 long, ids binary")
    made = made.withColumnRenamed("id", id_col)
    return made if keep_ids else made.drop("ids")


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece: longest first, into the fullest bin that has room."""
    bin_of = np.zeros(len(lengths), dtype=np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_gaps, bins = 0, 0
    for k in np.argsort(-lengths, kind="stable"):
        n = int(lengths[k])
        room = open_gaps >> n
        if room:
            gap = n + (room & -room).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                open_gaps ^= 1 << gap
        else:
            gap, b, bins = capacity, bins, bins + 1
        bin_of[k] = b
        by_gap[gap - n].append(b)
        open_gaps |= 1 << (gap - n)
    return bin_of


class _Underfull:
    """Bins with room: pieces by size in every bin, bins by the sizes they hold, and the widest gap beside each size."""

    def __init__(self, lengths: np.ndarray, bin_of: np.ndarray, fill: np.ndarray, capacity: int) -> None:
        self.gap = (capacity - fill).tolist()
        self.pieces: dict[int, dict[int, list[int]]] = {b: {} for b, g in enumerate(self.gap) if g}
        for k in np.flatnonzero(fill[bin_of] < capacity).tolist():
            self.pieces[int(bin_of[k])].setdefault(int(lengths[k]), []).append(k)
        self.holders: list[set[int]] = [set() for _ in range(capacity + 1)]  # at 0: all bins, as a move takes nothing back
        self.beside = np.zeros(capacity + 1, dtype=np.int64)
        self.holders[0].update(self.pieces)
        for b, own in self.pieces.items():
            for s in own:
                self.holders[s].add(b)
        for s in range(capacity + 1):
            self._look(s)
        self.room = sum(self.gap[b] for b in self.pieces)

    def _look(self, s: int) -> None:
        self.beside[s] = max((self.gap[b] for b in self.holders[s]), default=0)

    def leave(self, b: int) -> None:
        """The bin takes no more part as a target."""
        if b in self.holders[0]:
            self.room -= self.gap[b]
            for s in (0, *self.pieces[b]):
                self.holders[s].discard(b)
                self._look(s)

    def put(self, b: int, given: list[int], taken: int | None, gain: int, lengths) -> int | None:
        """Give pieces to a target bin for one of size `taken`, which is returned."""
        own = self.pieces[b]
        back = None
        if taken:
            back = own[taken].pop()
            if not own[taken]:
                del own[taken]
                self.holders[taken].discard(b)
        for k in given:
            own.setdefault(lengths[k], []).append(k)
            self.holders[lengths[k]].add(b)
        self.gap[b] -= gain
        self.room -= gain
        if not self.gap[b]:
            for s in (0, *own):
                self.holders[s].discard(b)
        for s in {0, taken or 0, *own}:
            self._look(s)
        return back


def local_search(lengths: np.ndarray, bin_of: np.ndarray, capacity: int, tries: int = 64) -> np.ndarray:
    """Empty the least filled bins by moves, one-for-one and two-for-one exchanges with fuller underfull bins.

    Every step takes what shifts most tokens to a fuller bin, so the sum of squared fills grows with
    each and the search ends. Steps are looked up by size: a unit of x tokens may go to a bin for a piece of s where
    the widest gap beside pieces of that size is x - s or more. The search ends where the gaps that are left could not take a
    bin's tokens, after `tries` more bins whose pieces only fill up others.
    """
    bin_of = bin_of.copy()
    bins = int(bin_of.max()) + 1 if len(bin_of) else 0
    fill = np.bincount(bin_of, weights=lengths, minlength=bins).astype(np.int64)
    state, size = _Underfull(lengths, bin_of, fill, capacity), lengths.tolist()
    for a in np.argsort(fill, kind="stable").tolist():
        if a not in state.holders[0]:
            continue
        state.leave(a)
        left = capacity - state.gap[a]
        if state.room < left:
            if not tries:
                break
            tries -= 1
        own = state.pieces[a]
        while left:
            widest = int(state.beside[0])
            if not widest:
                break
            sizes = list(own)
            units = {x: (x,) for x in sizes}
            for i, x in enumerate(sizes):
                for y in sizes[i if len(own[x]) > 1 else i + 1:]:
                    units.setdefault(x + y, (x, y))
            sums = np.array(list(units))
            gains = np.arange(min(widest, int(sums.max())), 0, -1)
            back = sums[:, None] - gains
            ok = (back >= 0) & (state.beside[np.clip(back, 0, capacity)] >= gains)
            best = int(np.argmax(ok.any(axis=0)))
            if not ok[:, best].any():
                break
            row, gain = int(np.argmax(ok[:, best])), int(gains[best])
            x = int(sums[row])
            b = min(b for b in state.holders[x - gain] if state.gap[b] >= gain)
            given = []
            for s in units[x]:
                given.append(own[s].pop())
                if not own[s]:
                    del own[s]
            taken = state.put(b, given, x - gain or None, gain, size)
            bin_of[given] = b
            if taken is not None:
                bin_of[taken] = a
                own.setdefault(x - gain, []).append(taken)
            left -= gain
    return bin_of


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces with a `length` of 1 to `capacity`.

    Pieces are dealt evenly to groups that one task packs. The least filled bins of all groups, up to an eighth of a group's
    pieces or one bin, meet again in the next round's fewer groups, until one group is left. Offsets are gapless from 0 in a
    sequence. An empty table stays empty.
    """
    if group_pieces < 2 * capacity:
        raise ValueError("a group must take the pieces of two bins at least")
    columns = pieces.columns
    old_group, old_bin, group, place, meets = (fresh(pieces, k) for k in ("old_group", "old_bin", "group_no", "bin", "meets"))
    rest, done, rounds = written(pieces, "pieces"), None, 0
    rest = rest.withColumn(old_group, F.monotonically_increasing_id()).withColumn(old_bin, F.lit(None).cast("long"))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rest.schema.fields)}, `{group}` long, `{place}` long, offset long, `{meets}` boolean"
    while True:
        groups = max(1, -(-rest.count() // group_pieces))

        def solve(pdf):
            pdf = pdf.reset_index(drop=True)
            lengths = pdf["length"].to_numpy(dtype=np.int64)
            b = best_fit(lengths, capacity)
            if pdf[old_bin].notna().all():  # bins that met: as they came, unless a fresh start is better
                came = pdf.groupby([old_group, old_bin], sort=True).ngroup().to_numpy()
                b = came if len(came) and came.max() <= b.max() else b
            b = local_search(lengths, b, capacity)
            b = np.unique(b, return_inverse=True)[1].astype(np.int64)
            order = np.argsort(b, kind="stable")
            out = pdf.iloc[order].reset_index(drop=True)
            b, lengths = b[order], lengths[order]
            first = np.searchsorted(b, b)
            ends = np.cumsum(lengths)
            out[place], out["offset"] = b, ends - lengths - (ends - lengths)[first]
            fill = np.bincount(b, weights=lengths)
            emptiest = np.argsort(fill, kind="stable")
            held = np.cumsum(np.bincount(b)[emptiest])
            again = np.zeros(len(fill), dtype=bool)
            again[emptiest[(held <= len(b) // 8) | (np.arange(len(fill)) == 0)]] = True
            out[meets] = (again & (fill < capacity))[b]
            return out

        dealt = rest.withColumn(group, F.pmod(old_group, F.lit(groups)))
        solved = written(dealt.groupBy(group).applyInPandas(solve, schema), "packed")
        number = (F.lit(rounds).cast("long") * F.lit(1 << 56) + F.col(group) * F.lit(1 << 24) + F.col(place)).alias("sequence_id")
        sure = (solved if groups == 1 else solved.where(~F.col(meets))).select(*columns, number, "offset")
        done = sure if done is None else done.unionByName(sure)
        if groups == 1:
            return done
        rest, rounds = solved.where(F.col(meets)).select(*columns, F.col(group).alias(old_group), F.col(place).alias(old_bin)), rounds + 1


def packed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                     path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Every document's pieces with the sequence and place that each got; NULL and empty texts are one token."""
    return pack(token_pieces(docs, id_col=id_col, text_col=text_col, capacity=capacity, path=path, keep_ids=keep_ids), capacity=capacity)
