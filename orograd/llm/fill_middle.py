"""Fill-in-the-middle transformation: cuts found by a Fenwick tree over fixed blocks of a text."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
BLOCK = 512              # bytes of a block
PLAIN_FROM, SPM_BELOW = 90, 20   # of 100: from here on a text stays plain; below, suffix comes first

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


class BlockTree:
    """Fenwick tree over blocks of BLOCK bytes of a UTF-8 text: how many units and code points begin in them.

    A unit is a run of ASCII letters or one other code point. The tree's rows are summed by one
    vectorised pass per level; a descent by halving steps finds the block of a unit, and only that
    block is looked at byte by byte.
    """

    def __init__(self, text: bytes, block: int = BLOCK) -> None:
        a = np.frombuffer(text, dtype=np.uint8)
        self.size, self.block = len(a), block
        self.points = (a & 0xC0) != 0x80
        letter = _LETTER[a]
        self.units = self.points.copy()
        self.units[1:] &= ~(letter[1:] & letter[:-1])
        n = -(-self.size // block)
        tree = np.zeros((n + 1, 2), dtype=np.int64)
        if n:
            starts = np.arange(0, self.size, block)
            tree[1:, 0] = np.add.reduceat(self.units, starts, dtype=np.int64)
            tree[1:, 1] = np.add.reduceat(self.points, starts, dtype=np.int64)
        step = 1
        while step <= n:  # a node takes in its child `step` below, smaller steps first
            own = np.arange(2 * step, n + 1, 2 * step)
            tree[own] += tree[own - step]
            step *= 2
        self.tree, self.top = tree, step // 2
        self.n = self._before(n, 0)

    def _before(self, blocks: int, what: int) -> int:
        total = 0
        while blocks:
            total += int(self.tree[blocks, what])
            blocks &= blocks - 1
        return total

    def cut(self, k: int) -> tuple[int, int]:
        """(byte, code point) where unit number k, from 0, begins; the text's end for k = n."""
        if k >= self.n:
            return self.size, self._before(len(self.tree) - 1, 1)
        at, step, units, points = 0, self.top, 0, 0
        while step:
            if at + step < len(self.tree) and units + self.tree[at + step, 0] <= k:
                at += step
                units += int(self.tree[at, 0])
                points += int(self.tree[at, 1])
            step //= 2
        lo = at * self.block
        inside = int(np.flatnonzero(self.units[lo:lo + self.block])[k - units])
        return lo + inside, points + int(np.count_nonzero(self.points[lo:lo + inside]))


def _draw(seed: int, id_col: str, k: int) -> Column:
    """The k-th group of eight hex digits of the sha256 of `seed:id`."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 8 * k + 1, 8), 16, 10).cast("long")


def fill_middle(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """The documents, all columns, with `fim_output`, `fim_form`, `fim_units`, `fim_prefix_chars` and `fim_middle_chars`.

    Two units drawn by id and seed cut a text into prefix, middle and suffix. The form is `psm`
    (`<P>`prefix`<S>`suffix`<M>`middle), `spm` (`<S>`suffix`<P>`prefix`<M>`middle) or `plain`: by draw, where
    the text is empty, or holds one of the marks. Equal rows have equal results. A NULL text is
    an empty one, a NULL id counts as an empty id; names that the table already has get an underscore.
    Texts pass as UTF-8 bytes, each in one row; beside itself a text needs about five times its bytes in the task.
    """
    names = [fresh(docs, f"fim_{k}") for k in ("output", "form", "units", "prefix_chars", "middle_chars")]
    first, second, plain, order = [_draw(seed, id_col, k) for k in range(4)]

    @F.pandas_udf("output binary, form string, units long, prefix_chars long, middle_chars long")
    def cut(texts: pd.Series, h1: pd.Series, h2: pd.Series, h3: pd.Series, h4: pd.Series) -> pd.DataFrame:
        rows = []
        for text, a, b, c, d in zip(texts, h1, h2, h3, h4):
            tree = BlockTree(text)
            if not text or c % 100 >= PLAIN_FROM or PREFIX in text or SUFFIX in text or MIDDLE in text:
                rows.append((text, "plain", tree.n, None, None))
                continue
            lo, hi = sorted((int(a) % (tree.n + 1), int(b) % (tree.n + 1)))
            (i, i_points), (j, j_points) = tree.cut(lo), tree.cut(hi)
            head, middle, tail = text[:i], text[i:j], text[j:]
            if d % 100 < SPM_BELOW:
                out, form = b"".join((SUFFIX, tail, PREFIX, head, MIDDLE, middle)), "spm"
            else:
                out, form = b"".join((PREFIX, head, SUFFIX, tail, MIDDLE, middle)), "psm"
            rows.append((out, form, tree.n, i_points, j_points - i_points))
        out = pd.DataFrame(rows, columns=["output", "form", "units", "prefix_chars", "middle_chars"])
        return out.astype({"units": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    made = fresh(docs, "fim_made")
    out = docs.withColumn(made, cut(text, first, second, plain, order))
    parts = [F.col(made)["output"].cast("string"), *[F.col(made)[k] for k in ("form", "units", "prefix_chars", "middle_chars")]]
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *[p.alias(n) for p, n in zip(parts, names)])


def restored(output: Column, form: Column) -> Column:
    """The text again, from output and form alone, by Spark's string functions."""
    first, second, third = F.lit(PREFIX.decode()), F.lit(SUFFIX.decode()), F.lit(MIDDLE.decode())

    def split(a: Column, b: Column) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(4), F.length(output))
        at = F.position(b, body)
        rest = F.substring(body, at + 3, F.length(body))
        end = F.position(third, rest)
        return F.substring(body, F.lit(1), at - 1), F.substring(rest, F.lit(1), end - 1), F.substring(rest, end + 3, F.length(rest))

    p, s, m = split(first, second)
    s2, p2, m2 = split(second, first)
    return F.when(form == "psm", F.concat(p, m, s)).when(form == "spm", F.concat(p2, m2, s2)).otherwise(output)


def fill_middle_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """Digests per document: (id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)."""
    made = fill_middle(docs.select(F.col(id_col), F.col(text_col)), id_col=id_col, text_col=text_col, seed=seed)
    return made.select(id_col, F.col("fim_units").alias("n"), F.col("fim_form").alias("form"), F.col("fim_prefix_chars").alias("prefix_chars"),
                       F.col("fim_middle_chars").alias("middle_chars"), F.sha2(F.col("fim_output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored(F.col("fim_output"), F.col("fim_form")).cast("binary"), 256).alias("restored_sha256"))


def report_sql() -> str:
    """The same digests in SQL."""
    return """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
d AS (
  SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, array_to_string(units[1:lo], '') AS head, array_to_string(units[lo + 1:hi], '') AS mid, array_to_string(units[hi + 1:], '') AS tail FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(len(head) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(len(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || tail || '<P>' || head || '<M>' || mid
         ELSE '<P>' || head || '<S>' || tail || '<M>' || mid END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE head || mid || tail END) AS restored_sha256
FROM p"""
