"""Removal of repeated passages with a sparse suffix array, sorted by a prefix-aware distributed merge."""

from __future__ import annotations

import pickle
import sys
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import tasks, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 200             # bytes of a string whose every repeat goes
GRAM = 16                # bytes of the grams that place anchors
CLASSES = 2              # classes of distances between a string's start and its anchor
CHUNK_BYTES = 4_000_000  # texts of one run, or one longer text
WORK = 1 << 18           # bytes hashed at once, so that the arrays stay in the cache
FAN_IN = 256             # runs that one merge takes
RANGE_ENTRIES = 60_000   # entries of a range, on average
SAMPLE_CHUNKS = 32       # chunks, about, of which some entries place the borders of ranges
SAMPLE_HEADS = 1024      # entries of each
CROWD = 200_000          # chunks that may share a content before it is compared string by string
PACK = 1 << 31           # a place is chunk * PACK + byte

_rng = np.random.default_rng(13)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_POWER = {1: np.uint64(0xD6E8FEB86659FD93)}


def _power(n: int) -> np.uint64:
    with np.errstate(over="ignore"):
        while n not in _POWER:
            top = max(k for k in _POWER if k <= n)
            if top == n:
                break
            _POWER[top * 2 if top * 2 <= n else n] = _POWER[top] * (_POWER[top] if top * 2 <= n else _power(n - top))
    return _POWER[n]


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * _MULTIPLY
        return h ^ (h >> np.uint64(29))


class Shape:
    """Sizes that follow from the length of a string: windows of grams, widths of classes, their common content."""

    def __init__(self, length: int = LENGTH, classes: int = CLASSES) -> None:
        self.length, self.gram = length, min(GRAM, length)
        self.grams = length - self.gram + 1                  # grams of a string
        self.width = -(-self.grams // classes)               # distances of a class
        self.content = length - self.width + 1               # bytes that all strings of a class and anchor share


def _hashes(a: np.ndarray, size: int) -> dict[int, np.ndarray]:
    """Hashes of all stretches of 1, 2, 4 ... bytes, up to `size`; h of u + v is h(u) * power(|v|) + h(v)."""
    out = {1: _BYTE[a]}
    k = 1
    with np.errstate(over="ignore"):
        while 2 * k <= min(size, len(a)):
            h = out[k]
            out[2 * k] = h[:-k] * _power(k) + h[k:]
            k *= 2
    return out


def _stretch(hashes: dict[int, np.ndarray], starts: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the stretches of `size` bytes from given starts."""
    h = np.zeros(len(starts), dtype=np.uint64)
    at = starts.copy()
    left = size
    with np.errstate(over="ignore"):
        while left:
            k = max(x for x in hashes if x <= left)
            h = h * _power(k) + hashes[k][at]
            at += k
            left -= k
    return h


def cells(buffer: np.ndarray, ends: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, least, most, content hash) of the suffixes that stand for all strings of `shape.length` bytes in the texts.

    The anchor of a string is its leftmost least gram, so equal strings have it at an equal distance.
    A cell is what one anchor and one class of distances bring together: the suffix at `place`, and the
    strings that begin `least` to `most` bytes before it. Strings of equal cells share the `content`.
    """
    parts, reach = [], shape.length - 1
    for lo in range(0, max(len(buffer) - reach, 0), WORK):
        a = buffer[lo:lo + WORK + reach]
        n = len(a) - reach
        hashes = _hashes(a, 32)
        grams = _mixed(_stretch(hashes, np.arange(len(a) - shape.gram + 1), shape.gram))
        m, w = len(grams), shape.grams
        packed = (grams & np.uint64(0xFFFFFFFFFFF00000)) | np.arange(m, dtype=np.uint64)    # leftmost of equal ones
        padded = np.full(-(-m // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[:m] = packed
        rows = padded.reshape(-1, w)
        forth = np.minimum.accumulate(rows, axis=1).reshape(-1)
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = np.minimum(back[:n], forth[w - 1:w - 1 + n])
        anchor = (least & np.uint64(0xFFFFF)).astype(np.int64)
        start = np.arange(n)
        own = np.searchsorted(ends, start + lo, side="right")
        start = start[start + lo + shape.length <= ends[own]]
        if not len(start):
            continue
        anchor = anchor[start]
        kind = (anchor - start) // shape.width
        new = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(kind) != 0) | (np.diff(start) != 1)])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        place = anchor[first] - kind[first] * shape.width
        content = _stretch(hashes, place, shape.content)
        with np.errstate(over="ignore"):
            content = _mixed(content + kind[first].astype(np.uint64) * _MULTIPLY)
        parts.append((place + lo, place - start[last], place - start[first], content))
    if not parts:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z.view(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def common(a: bytes, b: bytes, h: int) -> int:
    """Length of the common beginning, known to be at least h."""
    n, step = min(len(a), len(b)), 8
    while h < n and a[h:h + step] == b[h:h + step]:
        h += step
        step *= 2
    while step > 1:
        step //= 2
        if a[h:h + step] == b[h:h + step]:
            h += step
    return min(h, n)


class Run:
    """A sorted run of entries: (suffix, bytes before it, least distance, places; none where it is known to repeat)."""

    def __init__(self, entries: list[tuple], lcps: list[int] | None = None) -> None:
        self.entries = entries
        self.lcps = lcps if lcps is not None else [0] + [common(x[0], y[0], 0) for x, y in zip(entries, entries[1:])]

    def packed(self, lo: int = 0, hi: int | None = None) -> bytes:
        """Front-coded: of every suffix only what differs from the one before."""
        part, lcps = self.entries[lo:hi], list(self.lcps[lo:hi])
        if lcps:
            lcps[0] = 0
        tails = [e[0][h:] for e, h in zip(part, lcps)]
        arrays = (np.array(lcps, dtype="<u2"), np.array([len(t) for t in tails], dtype="<u2"), np.array([len(e[1]) for e in part], dtype="<u2"),
                  np.array([e[2] for e in part], dtype="<u2"), np.array([len(e[3]) for e in part], dtype="<u4"),
                  np.array([p for e in part for p in e[3]], dtype="<i8"))
        return zlib.compress(pickle.dumps((b"".join(tails), b"".join(e[1] for e in part), *[a.tobytes() for a in arrays])), 1)

    @classmethod
    def unpacked(cls, data: bytes) -> Run:
        tails, before, *arrays = pickle.loads(zlib.decompress(data))
        lcps, sizes, lefts, least, many, places = (np.frombuffer(a, dtype=t).tolist() for a, t in zip(arrays, ("<u2", "<u2", "<u2", "<u2", "<u4", "<i8")))
        entries, t, b, p, suffix = [], 0, 0, 0, b""
        for h, n, m, d, k in zip(lcps, sizes, lefts, least, many):
            suffix = suffix[:h] + tails[t:t + n]
            entries.append((suffix, before[b:b + m], d, tuple(places[p:p + k])))
            t, b, p = t + n, b + m, p + k
        return cls(entries, lcps)


class LoserTree:
    """Merge of sorted runs in which no comparison looks again at a beginning known to be common.

    Every run's head knows how much it shares with the last suffix given out, every loser how much
    it shares with the one that beat it. Of two heads the one that shares more with their common predecessor is
    smaller, without a look at a byte; only at a tie are bytes compared, from there on.
    """

    def __init__(self, runs: list[Run]) -> None:
        self.runs, self.size = runs, 1
        while self.size < len(runs):
            self.size *= 2
        self.at = [0] * self.size
        self.head = [r.entries[0][0] if r.entries else None for r in runs] + [None] * (self.size - len(runs))
        self.shared = [0] * self.size
        self.loser = [-1] * self.size
        self.winner = self._start(1)

    def _start(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, self.loser[node] = self._play(self._start(2 * node), self._start(2 * node + 1))
        return winner

    def _play(self, a: int, b: int) -> tuple[int, int]:
        x, y = self.head[a], self.head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        h = self.shared[a]
        if h != self.shared[b]:
            return (a, b) if h > self.shared[b] else (b, a)
        h = common(x, y, h)
        if x[h:h + 1] <= y[h:h + 1]:
            self.shared[b] = h
            return a, b
        self.shared[a] = h
        return b, a

    def __iter__(self):
        """Entries in order, each with what its suffix shares with the one before."""
        while True:
            run = self.winner
            if self.head[run] is None:
                return
            r, k = self.runs[run], self.at[run]
            yield r.entries[k], self.shared[run]
            self.at[run] = k = k + 1
            if k < len(r.entries):
                self.head[run], self.shared[run] = r.entries[k][0], r.lcps[k]
            else:
                self.head[run] = None
            node, winner = (run + self.size) // 2, run
            while node:
                winner, self.loser[node] = self._play(winner, self.loser[node])
                node //= 2
            self.winner = winner


def merged(runs: list[Run]) -> Run:
    """One run of all entries; equal ones are one entry with all their places."""
    entries: list[tuple] = []
    lcps: list[int] = []
    equal: dict[tuple, int] = {}      # entries of the present suffix
    for entry, h in LoserTree(runs):
        if not entries or h < len(entry[0]) or h < len(entries[-1][0]):
            equal = {}
        key = entry[1:3]
        k = equal.get(key)
        if k is None:
            equal[key] = len(entries)
            entries.append(entry)
            lcps.append(h)
        else:
            known = not entries[k][3] or not entry[3]
            entries[k] = (*entries[k][:3], entries[k][3] + entry[3], known or (len(entries[k]) > 4 and entries[k][4]))
    if lcps:
        lcps[0] = 0
    return Run(entries, lcps)


def _known(entry: tuple) -> bool:
    """Whether all strings of the entry are known to occur twice or more."""
    return len(entry[3]) != 1 or (len(entry) > 4 and entry[4])


def repeated(run: Run, shape: Shape) -> np.ndarray:
    """Entries x distances: which strings of a sorted run occur more than once.

    Two strings at distance d are equal where the suffixes share length - d bytes, so no smaller
    common beginning lies between them, and the d bytes before are equal.
    """
    n = len(run.entries)
    out = np.zeros((n, shape.width), dtype=bool)
    if not n:
        return out
    lcps = np.array(run.lcps, dtype=np.int64)
    lcps[0] = -1
    least = np.array([e[2] for e in run.entries])
    most = np.array([len(e[1]) for e in run.entries])
    known = np.array([_known(e) for e in run.entries])
    group = np.cumsum(lcps < shape.content)
    crowd = np.flatnonzero((np.bincount(group)[group] > 1) | known)
    before = np.zeros((n, shape.width), dtype=np.uint8)
    for k in crowd.tolist():
        left = run.entries[k][1]
        before[k, :len(left)] = np.frombuffer(left, dtype=np.uint8)[::-1]
    left = group.astype(np.int64)
    alive = crowd
    for d in range(shape.width):
        alive = alive[most[alive] >= d]
        if not len(alive):
            break
        if d:
            left[alive] = np.unique(left[alive] * 256 + before[alive, d - 1], return_inverse=True)[1]
        now = alive[least[alive] <= d]
        right = np.cumsum(lcps < shape.length - d)
        _, same, times = np.unique(left[now] * (n + 1) + right[now], return_inverse=True, return_counts=True)
        sure = np.bincount(same, weights=known[now], minlength=len(times)) > 0
        out[now, d] = (times[same] > 1) | sure[same]
    return out


def _spans(entries: list[tuple], found: np.ndarray, shape: Shape) -> pd.DataFrame:
    """(chunk, lo, hi): covered stretches of each chunk, joined where they meet."""
    edge = np.zeros((len(found), 1), dtype=np.int8)
    change = np.diff(np.concatenate([edge, found.astype(np.int8), edge], axis=1), axis=1)
    row, first = np.nonzero(change == 1)
    last = np.nonzero(change == -1)[1] - 1
    many = np.array([len(entries[r][3]) for r in row], dtype=np.int64)
    places = np.array([p for r in row for p in entries[r][3]], dtype=np.int64)
    lo = places - np.repeat(last, many)
    hi = places - np.repeat(first, many) + shape.length
    lo, hi = joined(lo, hi)
    chunk = lo // PACK
    cut = np.flatnonzero(np.diff(chunk)) + 1 if len(chunk) else []
    groups = zip(np.split(chunk, cut), np.split(lo % PACK, cut), np.split(hi - chunk * PACK, cut)) if len(chunk) else ()
    return pd.DataFrame([(int(c[0]), x.astype(np.int32), y.astype(np.int32)) for c, x, y in groups], columns=["chunk", "lo", "hi"])


def joined(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches in order, those that overlap or touch made one."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    return lo[new], hi[np.append(np.flatnonzero(new)[1:], len(lo)) - 1]


def text_chunks(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> DataFrame:
    """Texts in chunks that stay: rows (chunk, ids, ends, texts) with the texts' bytes joined and packed."""
    kind = docs.schema[id_col].dataType.simpleString()

    def pack(batches):
        from pyspark import TaskContext

        part, seq, ids, held, size = TaskContext.get().partitionId(), 0, [], [], 0

        def row():
            ends = np.cumsum([len(t) for t in held], dtype=np.int64)
            return pd.DataFrame({"chunk": [part << 12 | seq], "ids": [list(ids)], "ends": [ends], "texts": [zlib.compress(b"".join(held), 1)]})

        for pdf in batches:
            for key, text in zip(pdf["id"].astype(object), pdf["text"]):
                text = text if isinstance(text, bytes) else b""
                if held and size + len(text) > chunk_bytes:
                    yield row()
                    seq, size = seq + 1, 0
                    ids.clear()
                    held.clear()
                    if seq >= 1 << 12:
                        raise ValueError("a partition of more than 4,096 chunks: repartition the documents first")
                ids.append(None if pd.isna(key) else key)
                held.append(text)
                size += len(text)
        if held:
            yield row()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInPandas(pack, f"chunk long, ids array<{kind}>, ends array<long>, texts binary")


def _by_chunk(df: DataFrame, name: str) -> DataFrame:
    """The table in shared storage, in buckets by chunk: joins by chunk then move only their other side."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(tasks(spark), "chunk").option("path", scratch_folder(spark, name)).option("compression", "none").saveAsTable(table)
    return spark.table(table)


def _cells_of(row, shape: Shape):
    buffer = zlib.decompress(row.texts)
    ends = np.asarray(row.ends)
    return buffer, ends, cells(np.frombuffer(buffer, dtype=np.uint8), ends, shape)


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, chunk_bytes: int = CHUNK_BYTES,
                   fan_in: int = FAN_IN, range_entries: int = RANGE_ENTRIES, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """(chunks, spans): the texts in chunks, and per chunk the stretches that strings of `length` bytes cover which start twice or more.

    Sparse suffixes stand for all strings (`cells`). Those whose content occurs once can't repeat and go, counted by one
    shuffle of hashes. Each chunk's others are a sorted, front-coded run; runs are cut at borders of ranges and exchanged, and
    loser trees merge them, `fan_in` runs at a time in rounds, into the sorted array of each range, where neighbours tell repeats.
    Entries that are equal in a run are one entry from the start. A content that more than `crowd` chunks share is cut into its
    single strings, so that no range has to hold all that surrounds it.
    """
    shape = Shape(length)
    chunks = _by_chunk(text_chunks(docs, id_col, text_col, chunk_bytes), "chunks")

    def contents(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                h, n = np.unique(_cells_of(row, shape)[2][3], return_counts=True)
                for k in range(0, len(h), 50_000):
                    yield pd.DataFrame({"content": h[k:k + 50_000].view(np.int64), "own": row.chunk * 2 + (n[k:k + 50_000] > 1)})

    seen = chunks.select("chunk", "ends", "texts").mapInPandas(contents, "content long, own long")
    w = Window.partitionBy("content")
    seen = seen.withColumn("n", F.count("*").over(w)).withColumn("twice", F.max(F.col("own") % 2).over(w)).where("n > 1 or twice = 1")
    marks = written(seen.groupBy(F.expr("own div 2").alias("of")).agg(
        F.collect_list(F.when(F.col("n") <= crowd, F.col("content"))).alias("contents"), F.collect_list(F.when(F.col("n") > crowd, F.col("content"))).alias("crowded")), "marks")
    total = marks.agg(F.sum(F.size("contents") + F.size("crowded") * shape.width)).first()[0] or 0
    marked = chunks.join(marks, F.col("chunk") == F.col("of")).select("chunk", "ends", "texts", "contents", "crowded")

    def entries_of(row) -> list[tuple]:
        buffer, ends, (place, least, most, content) = _cells_of(row, shape)
        limits = ends[np.searchsorted(ends, place, side="right")] if len(place) else place
        held: dict[tuple, list[int]] = {}
        for wanted, single in ((row.contents, False), (row.crowded, True)):
            pick = np.flatnonzero(np.isin(content, np.asarray(wanted, dtype=np.int64).view(np.uint64))) if len(wanted) else ()
            for p, lo, hi, end in zip(*(x[pick].tolist() for x in (place, least, most, limits))) if len(pick) else ():
                for d in range(lo, hi + 1) if single else (None,):
                    key = (buffer[p:min(p + length - lo, end)], buffer[p - hi:p], lo) if d is None else (buffer[p - d:p - d + length], b"", 0)
                    held.setdefault(key, []).append(row.chunk * PACK + p - (d or 0))
        return sorted((*key, tuple(places)) for key, places in held.items())

    ranges = max(1, -(-total // range_entries))
    share = int(1_000_000 * min(1.0, SAMPLE_CHUNKS / max(marks.count(), 1)))
    size = shape.content

    def heads(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                own = entries_of(row)
                yield pd.DataFrame({"head": [e[0][:size] for e in own[::-(-len(own) // SAMPLE_HEADS) or 1]]})

    borders: list[bytes] = []
    if ranges > 1:  # evenly placed entries of some chunks; only the balance of ranges depends on them
        sample = marked.where(F.pmod(F.xxhash64("chunk"), F.lit(1_000_000)) < share).mapInPandas(heads, "head binary")
        known = sorted(bytes(r["head"]) for r in sample.collect())
        borders = [known[len(known) * k // ranges] for k in range(1, ranges)] if known else []

    def cut(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                run = Run(entries_of(row))
                at = [0, *_cuts(run, borders, size), len(run.entries)]
                for k in range(len(at) - 1):
                    if at[k] < at[k + 1]:
                        yield pd.DataFrame({"part": [k], "run": [row.chunk], "data": [run.packed(at[k], at[k + 1])]})

    runs, count = marked.mapInPandas(cut, "part int, run long, data binary"), marks.count()
    spans = None
    while count > fan_in:  # a round merges the runs of each range in groups
        groups = -(-count // fan_in)

        def step(pdf):
            run = merged([Run.unpacked(x) for x in pdf["data"]])
            known = [e for e in run.entries if _known(e) and e[3]]
            found = np.zeros((len(known), shape.width), dtype=bool)
            for k, e in enumerate(known):
                found[k, e[2]:len(e[1]) + 1] = True
            out = _spans(known, found, shape).assign(part=-1, run=-1, data=None)
            run.entries = [(*e[:3], () if _known(e) else e[3]) for e in run.entries]
            own = pd.DataFrame({"chunk": [None], "lo": [None], "hi": [None], "part": [pdf["part"].iloc[0]], "run": [pdf["group_no"].iloc[0]], "data": [run.packed()]})
            return pd.concat([out, own], ignore_index=True).astype({"chunk": "Int64"})

        dealt = runs.withColumn("group_no", F.pmod(F.xxhash64("run"), F.lit(groups)))
        made = written(dealt.groupBy("part", "group_no").applyInPandas(step, "chunk long, lo array<int>, hi array<int>, part int, run long, data binary"), "merged-runs")
        sure = made.where("part < 0").select("chunk", "lo", "hi")
        spans = sure if spans is None else spans.unionByName(sure)
        runs, count = made.where("part >= 0").select("part", "run", "data"), groups

    def last(pdf):
        run = merged([Run.unpacked(x) for x in pdf["data"]])
        return _spans(run.entries, repeated(run, shape), shape)

    final = runs.groupBy("part").applyInPandas(last, "chunk long, lo array<int>, hi array<int>")
    spans = final if spans is None else spans.unionByName(final)
    per = spans.groupBy(F.col("chunk").alias("of")).agg(F.flatten(F.collect_list("lo")).alias("lo"), F.flatten(F.collect_list("hi")).alias("hi"))
    return chunks, written(per, "spans")


def _cuts(run: Run, borders: list[bytes], size: int) -> list[int]:
    """Where a run is cut: entries that share `size` bytes stay in one range."""
    import bisect

    keys = [e[0][:size] for e in run.entries]
    return [bisect.bisect_left(keys, b) for b in borders]


def dedup_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **sizes) -> DataFrame:
    """Rows (id, n_bytes, kept, spans): every text as UTF-8 bytes without those that a repeated string of `length` bytes covers.

    `spans` are the removed stretches (from, to), to exclusive, in the whole text; `kept` the other bytes joined. A string counts
    as repeated when it also starts anywhere else, in the same text too; strings do not cross texts. Repeated rows are
    repeats of each other, whatever their ids. NULL and empty texts keep 0 bytes; texts shorter than `length` stay whole.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    chunks, spans = repeated_spans(docs, id_col=id_col, text_col=text_col, length=length, **sizes)
    both = chunks.join(spans, F.col("chunk") == F.col("of"), "left").select("ids", "ends", "texts", "lo", "hi")

    def cut(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                buffer, ends = zlib.decompress(row.texts), np.asarray(row.ends)
                none = row.lo is None or (isinstance(row.lo, float) and pd.isna(row.lo))
                lo, hi = joined(*(np.zeros(0, dtype=np.int64) if none else np.asarray(x, dtype=np.int64) for x in (row.lo, row.hi)))
                # stretches of two texts may touch, so they are cut at the texts' borders
                out, begin, k = [], 0, 0
                los, his = lo.tolist(), hi.tolist()
                for key, end in zip(row.ids, ends.tolist()):
                    at, kept, gone = begin, [], []
                    while k < len(los) and los[k] < end:
                        a, b = max(los[k], begin), min(his[k], end)
                        if a < b:
                            kept.append(buffer[at:a])
                            gone.append({"from": a - begin, "to": b - begin})
                            at = b
                        if his[k] > end:
                            break
                        k += 1
                    kept.append(buffer[at:end])
                    out.append((key, end - begin, b"".join(kept), gone))
                    begin = end
                for j in range(0, len(out), 2000):
                    yield pd.DataFrame(out[j:j + 2000], columns=["id", "n_bytes", "kept", "spans"]).astype({"id": object})

    made = both.mapInPandas(cut, f"id {kind}, n_bytes long, kept binary, spans array<struct<from: int, to: int>>")
    return made.withColumnRenamed("id", id_col)


def passage_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **sizes) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    made = dedup_passages(docs, id_col=id_col, text_col=text_col, length=length, **sizes)
    return made.select(id_col, "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))
