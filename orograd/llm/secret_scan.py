"""Secret scans: a trigram index picks the texts in which a rule can match, then the rule runs there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, written
from .trigram_query import Query, query

# kind -> (pattern, group whose length counts, least length). Base kinds first; in runs, `+` and a least length
# are the same as a bounded run. Patterns are read alike by Java, Python and RE2.
BASE = {
    "assign": (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
MORE = {
    "github": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    "google": (r"AIza[0-9A-Za-z_-]{35,}", 0, 39),
    "slack": (r"xox[baprs]-[A-Za-z0-9-]{10,}", 0, 15),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 29),
    "pem": (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 27),
}
RULES = BASE | MORE
MASK_BITS = 62


def index(docs: DataFrame, queries: dict[str, Query], *, id_col: str, text_col: str) -> tuple[DataFrame, dict[str, int]]:
    """Postings (id, trigram number) of the trigrams that some rule needs, over whole texts in lower case."""
    numbers = {t: k for k, t in enumerate(sorted({t for q in queries.values() for c in q for a in c for t in a}))}
    low = docs.select(F.col(id_col).alias("id"), F.lower(F.col(text_col)).alias("low"))
    hits = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(k)) for t, k in numbers.items()])
    return low.select("id", hits.alias("hits")).select("id", F.explode(F.array_compact("hits")).alias("trigram")), numbers


def candidates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: dict = RULES) -> DataFrame:
    """(id, kinds): the rules whose trigram query each text satisfies; rules without mandatory trigrams are left out.

    The postings of an id are intersected as bits of one number per 62 trigrams, combined before the shuffle.
    """
    queries = {k: q for k, r in rules.items() if (q := query(r[0]))}
    postings, numbers = index(docs, queries, id_col=id_col, text_col=text_col)
    words = range(-(-len(numbers) // MASK_BITS))
    masks = postings.groupBy("id").agg(*[F.bit_or(F.when(F.floor(F.col("trigram") / MASK_BITS) == w, F.expr(
        f"shiftleft(1L, cast(pmod(trigram, {MASK_BITS}) as int))")).otherwise(F.lit(0).cast("long"))).alias(f"m{w}") for w in words])

    def holds(alternative) -> Column:
        out = F.lit(True)
        for w in words:
            bits = sum(1 << numbers[t] % MASK_BITS for t in alternative if numbers[t] // MASK_BITS == w)
            if bits:
                out = out & (F.col(f"m{w}").bitwiseAND(F.lit(bits)) == bits)
        return out

    def satisfied(q: Query) -> Column:
        out = F.lit(True)
        for clause in q:
            one = F.lit(False)
            for alternative in sorted(map(sorted, clause)):
                one = one | holds(alternative)
            out = out & one
        return out

    kinds = F.array_compact(F.array(*[F.when(satisfied(q), F.lit(k)) for k, q in queries.items()]))
    return masks.select("id", kinds.alias("kinds")).where(F.size("kinds") > 0)


def spans_of(text: Column, kind: str, rule: tuple[str, int, int]) -> Column:
    """Array of (at, order, kind, till) of a rule's leftmost matches, in code points.

    Splitting at the pattern gives the texts between the matches, whose lengths place them.
    """
    pattern, group, least = rule
    rx = F.lit(pattern)
    hits, gaps = F.regexp_extract_all(text, rx, F.lit(0)), F.split(text, pattern, -1)
    order = list(RULES).index(kind)
    steps = F.arrays_zip(F.transform(F.slice(gaps, F.lit(1), F.size(hits)), lambda g: F.length(g)).alias("g"), hits.alias("h"))
    empty = F.array().cast("array<struct<at:int,order:int,kind:string,till:int>>")
    start = F.struct(F.lit(0).alias("pos"), empty.alias("out"))

    def step(acc, x):
        at, till = acc["pos"] + x["g"], acc["pos"] + x["g"] + F.length(x["h"])
        long = F.length(x["h"]) >= least if not group else F.length(F.regexp_extract(x["h"], pattern, group)) >= least
        own = F.array(F.struct(at.alias("at"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), till.alias("till")))
        return F.struct(till.alias("pos"), F.when(long, F.concat(acc["out"], own)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(steps, start, step, lambda acc: acc["out"])


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: dict = RULES) -> DataFrame:
    """The documents (all columns) with `secrets`: array of (at, order, kind, till), ordered by place and kind.

    Rules with mandatory trigrams run only on texts that the index names; the others (`hex`) scan every text
    in full. NULL texts count as empty, rows of one id are searched one by one, NULL ids are rows like others.
    """
    found = written(candidates(docs, id_col=id_col, text_col=text_col, rules=rules), "secret-candidates")
    key, kinds, name = fresh(docs, "secret_id"), fresh(docs, "secret_kinds"), "secrets"
    joined = docs.join(found.select(F.col("id").alias(key), F.col("kinds").alias(kinds)), docs[id_col].eqNullSafe(F.col(key)), "left")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    none = F.array().cast("array<struct<at:int,order:int,kind:string,till:int>>")
    parts = []
    for kind, rule in rules.items():
        wanted = F.coalesce(F.array_contains(kinds, kind), F.lit(False)) if query(rule[0]) else F.lit(True)
        parts.append(F.when(wanted & F.rlike(text, F.lit(rule[0])), spans_of(text, kind, rule)).otherwise(none))
    return joined.withColumn(name, F.sort_array(F.concat(*parts))).drop(key, kinds)


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["at"].cast("string"), s["till"].cast("string"))))


def secret_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of every document, see `find_secrets`."""
    found = find_secrets(docs.select(id_col, text_col), id_col=id_col, text_col=text_col).select(id_col, "secrets")
    def number(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["order"] < len(BASE))
    return found.select(id_col, *map(number, BASE), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("secrets")).alias("spans"))


def report_sql() -> str:
    """DuckDB's way to the same rows: every rule on every text."""
    def part(order: int, kind: str, rule: tuple[str, int, int]) -> str:
        pattern, group, least = rule
        rx = "'" + pattern.replace("'", "''") + "'"
        long = f"len(h[i]) >= {least}" if not group else f"len(regexp_extract(h[i], {rx}, {group})) >= {least}"
        return (f"SELECT r, {order} AS o, '{kind}' AS k, p, p + len(h[i]) AS q FROM (SELECT r, h, i, {long} AS fits, "
                f"coalesce(list_sum(list_transform(g[1:i], lambda x: len(x))), 0) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: len(x))), 0) AS p "
                f"FROM (SELECT r, h, g, unnest(range(1, len(h) + 1)) AS i FROM (SELECT r, regexp_extract_all(t, {rx}) AS h, "
                f"string_split_regex(t, {rx}) AS g FROM d WHERE regexp_matches(t, {rx})))) WHERE fits")

    union = " UNION ALL ".join(part(k, *kv) for k, kv in enumerate(RULES.items()))
    line = "string_agg(k || ':' || p::bigint || ':' || q::bigint, ',' ORDER BY p, o)"
    return (f"WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), s AS ({union}), "
            f"a AS (SELECT r, {', '.join(f"count(*) FILTER (k = '{k}') AS n_{k}" for k in BASE)}, {line} FILTER (o < {len(BASE)}) AS base, {line} AS spans FROM s GROUP BY r) "
            f"SELECT d.doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, "
            f"coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (r)")
