"""Benchmark decontamination on canonical templates, also of re-parameterised questions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, written

WINDOW = 8            # tokens of a joined window
PASSAGE = 13          # every common run of so many tokens is found
PIECE = 4             # tokens of a piece that adds to a run beside it
NEAR = 8              # tokens that pieces of one copy may be put out of place by what was put in or left out
LEAST_TOKENS = 3      # shorter items cannot be told from common phrases
MARK = ""       # begins a placeholder; taken out of texts first
UNITS = ("km|cm|mm|m|kg|mg|g|ml|l|mi|lbs?|oz|ft|in|khz|mhz|ghz|hz|kb|mb|gb|tb|kwh?|mph|kph|usd|eur|gbp|percent|meters?|metres?|miles?|"
         "kilometers?|kilometres?|grams?|kilograms?|pounds?|ounces?|liters?|litres?|hours?|hrs?|minutes?|mins?|seconds?|days?|weeks?|"
         "months?|years?|degrees?|dollars?|euros?|cents?|feet|foot|inch(?:es)?|yards?")
# repeated groups are possessive: Java's matcher goes one call deeper per repeat of any other
NUMBER = r"[0-9]++(?:[.,:/-][0-9]++)*+"
NAMES = rf"(?<![\p{{L}}{MARK}])\p{{Lu}}\p{{Ll}}++(?!\p{{L}})(?:\s++\p{{Lu}}\p{{Ll}}++(?!\p{{L}}))*+"
INNER_NAMES = rf"[A-Z\p{{Lu}}](?<=[\p{{Ll}}0-9,;:{MARK}]\s.)[a-z\p{{Ll}}]++(?!\p{{L}})"   # what stands before is looked at for capitals alone
STRETCH = 4096        # tokens of a text whose windows are made at once


def _marked(text: Column, every_name: bool, values: bool) -> Column:
    """The text in lower case with a placeholder for each number, unit after a number and name; with `values`, the value in it."""
    with_digits = F.rlike(text, F.lit("[0-9]"))    # most texts have none, so nothing to look for
    s = F.when(F.contains(text, F.lit(MARK)), F.replace(text, F.lit(MARK), F.lit(" "))).otherwise(text)
    units = F.regexp_replace(s, rf"(?i)(?<=[0-9])(\s?)({UNITS})(?!\p{{L}})", f"$1{MARK}u$2{MARK}" if values else f"$1{MARK}u{MARK}")
    s = F.when(with_digits, units).otherwise(s)
    s = F.regexp_replace(s, NAMES if every_name else INNER_NAMES, f"{MARK}p$0{MARK}" if values else f"{MARK}p{MARK}")
    return F.lower(F.when(with_digits, F.regexp_replace(s, NUMBER, f"{MARK}n$0{MARK}" if values else f"{MARK}n{MARK}")).otherwise(s))


def raw_tokens(text: Column, every_name: bool = False) -> Column:
    """The tokens of `canonical_tokens`, placeholders with the value that they stand for."""
    return F.regexp_extract_all(_marked(text, every_name, True), F.lit(rf"{MARK}[^{MARK}]+{MARK}|\p{{L}}+"), F.lit(0))


def canonical_tokens(text: Column, every_name: bool = False) -> Column:
    """Tokens in lower case with numbers, units after numbers and names as typed placeholders.

    Names are capitalised words within sentences, each a token; with `every_name` all capitalised words, also where a
    sentence begins, and those in a row are one token. Tokens are as many as `raw_tokens` and stand in the same places.
    """
    return F.regexp_extract_all(_marked(text, every_name, False), F.lit(rf"{MARK}[nup]|\p{{L}}+"), F.lit(0))


def _forms(text: Column, canonical: str, raw: str | None = None) -> Column:
    """Array of both forms of a text: (form, canonical tokens, raw tokens if asked for)."""
    return F.array(*[F.struct(F.lit(k).alias("form"), canonical_tokens(text, bool(k)).alias(canonical), *([raw_tokens(text, bool(k)).alias(raw)] if raw else []))
                     for k in (0, 1)])


def _literals(tokens: Column) -> Column:
    return F.size(F.filter(tokens, lambda t: ~F.startswith(t, F.lit(MARK))))


def _windows(tokens: DataFrame, name: str, width: int, *keep: str) -> DataFrame:
    """Rows (keep, at, h) of every window of `width` tokens of an array: their hashes side by side, hashed in turn.

    Long arrays are cut into overlapping stretches first, so that a long text's windows are never all in memory.
    """
    hashed = tokens.select(*keep, F.transform(name, lambda t: F.xxhash64(t)).alias("hashes"))
    size = F.size("hashes")
    begins = F.when(size >= width, F.sequence(F.lit(0), size - width, F.lit(STRETCH))).otherwise(F.array().cast("array<int>"))
    cut = F.transform(begins, lambda s: F.struct(s.alias("s"), F.slice("hashes", s + 1, F.lit(STRETCH + width - 1)).alias("part")))
    parts = hashed.select(*keep, F.explode(cut).alias("x")).select(*keep, F.col("x.s").alias("s"), F.col("x.part").alias("part"))
    n = F.size("part") - (width - 1)
    beside = F.arrays_zip(*[F.slice("part", F.lit(k + 1), n).alias(f"t{k}") for k in range(width)])
    rows = parts.select(*keep, "s", F.posexplode(beside).alias("k", "w"))
    return rows.select(*keep, (F.col("s") + F.col("k")).alias("at"), F.xxhash64(*[F.col(f"w.t{k}") for k in range(width)], F.lit(width), F.col("form")).alias("h"))


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """Pairs (doc, item, run, item_tokens, verbatim): documents that hold a passage of a benchmark item or its template.

    Texts become canonical tokens in two forms, so a question whose numbers, names or units were exchanged keeps
    its template; items of fewer than WINDOW tokens have the first form only, as "Paris is the capital" is no copy of "What is the capital". Every window of WINDOW tokens of an item, at least half of them literal, is joined with every window of the
    documents. Items of fewer tokens are joined as one window of their own length. Windows that meet place the item in the document;
    there a common run, or a run with the pieces of PIECE tokens or more within NEAR places of it, must have PASSAGE tokens
    (or be the whole item), and each slot value of the item within them must stand for one value in the document;
    two values of the item may become the same one there.
    `run` counts the item's tokens found: divided by `item_tokens`, it is the coverage. `verbatim` tells whether all slot values found are equal.

    NULL and empty texts match nothing; neither do items of fewer than LEAST_TOKENS tokens or of placeholders mostly.
    Repeated rows of a document or item give one pair.
    """
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("t")).where("t is not null")
    items = items.select("item", F.inline(_forms(F.col("t"), "ict", "irt")))
    items = written(items.where(F.size("ict") >= F.when(F.col("form") == 0, LEAST_TOKENS).otherwise(WINDOW)).distinct(), "items")
    lengths = [r[0] for r in items.select(F.least(F.size("ict"), F.lit(PASSAGE))).distinct().collect()]  # at most PASSAGE values
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("t")).where("t is not null")
    tokens = texts.select("doc", F.inline(_forms(F.col("t"), "ct")))

    plans = [n for n in sorted(lengths) if n < WINDOW]
    if any(n >= WINDOW for n in lengths):
        plans.append(WINDOW)
    if not plans:
        return items.select(F.lit(None).cast(docs.schema[id_col].dataType).alias(id_col), F.col("item").alias(item_col), F.lit(0).alias("run"),
                            F.lit(0).alias("item_tokens"), F.lit(True).alias("verbatim")).limit(0)

    def asked(width: int) -> DataFrame:
        own = items.where(F.size("ict") == width if width < WINDOW else F.size("ict") >= WINDOW)
        found = _windows(own, "ict", width, "item", "form", "ict")
        return found.where(_literals(F.slice("ict", F.col("at") + 1, F.lit(width))) * 2 >= width).select("item", "form", F.col("at").alias("item_at"), "h")

    wanted = written(reduce(DataFrame.unionByName, map(asked, plans)), "item-windows")  # written, so that Spark knows its true size before it joins
    windows = reduce(DataFrame.unionByName, [_windows(tokens, "ct", w, "doc", "form") for w in plans]).drop("form")
    met = windows.join(wanted, "h")
    hits = written(met.select("doc", "item", "form", (F.col("at") - F.col("item_at")).alias("shift")).distinct(), "item-hits")

    key = "hit_doc"
    named = hits.select(F.col("doc").alias(key)).distinct()
    full = texts.join(named, F.col("doc").eqNullSafe(F.col(key)), "left_semi").select(
        "doc", F.inline(_forms(F.col("t"), "ct", "rt")))
    both = full.join(hits.withColumnRenamed("doc", key).withColumnRenamed("form", "hit_form"), F.col("doc").eqNullSafe(F.col(key)) & (F.col("form") == F.col("hit_form"))).join(
        items.withColumnRenamed("item", "of_item").withColumnRenamed("form", "of_form"), F.col("item").eqNullSafe(F.col("of_item")) & (F.col("form") == F.col("of_form")))
    start, n = F.greatest(F.lit(0), F.col("shift") - NEAR), F.size("ict")
    around = [F.slice(c, start + 1, n + 2 * NEAR) for c in ("ct", "rt")]
    placed = both.select("doc", "item", "ict", "irt", around[0].alias("dt"), around[1].alias("dv"), (F.col("shift") - start).alias("off"),
                         n.alias("item_tokens"), F.sequence(F.lit(0), n - 1).alias("places"))

    def common(move: Column) -> Column:
        """A sign for each token of the item: 1 where the document has the same."""
        same = F.transform("places", lambda i: F.when(F.get("ict", i) == F.get("dt", i + move + F.col("off")), "1").otherwise("0"))
        return F.array_join(same, "")

    def pieces(signs: Column) -> Column:
        for k in range(1, PIECE):
            signs = F.regexp_replace(signs, f"(?<!1){'1' * k}(?!1)", "0" * k)
        return signs

    def slots(found: Column) -> Column:
        """(type, item's value, document's value) at (place, move) pairs that hold a placeholder."""
        own = F.filter(found, lambda x: F.startswith(F.get("ict", x["i"]), F.lit(MARK)))
        return F.array_distinct(F.transform(own, lambda x: F.struct(
            F.get("ict", x["i"]).alias("kind"), F.lower(F.get("irt", x["i"])).alias("iv"), F.lower(F.get("dv", x["i"] + x["d"] + F.col("off"))).alias("dv"))))

    least = F.least(F.lit(PASSAGE), F.col("item_tokens"))
    straight = placed.withColumn("signs", common(F.lit(0)))
    begins = F.filter("places", lambda i: (F.substr("signs", i + 1, F.lit(1)) == "1") & ((i == 0) | (F.substr("signs", i, F.lit(1)) == "0")))
    runs = F.transform(begins, lambda i: F.struct(i.alias("i"), F.length(F.regexp_extract(F.substr("signs", i + 1), "^1+", 0)).alias("k")))
    straight = straight.withColumn("runs", F.filter(runs, lambda x: x["k"] >= least))
    moves = F.array(*[F.lit(d) for k in range(NEAR + 1) for d in ((k, -k) if k else (0,))])
    # pieces beside the run are looked for only where the run is not all of the item
    whole = F.exists("runs", lambda x: x["k"] == F.col("item_tokens"))
    straight = straight.withColumn("masks", F.when(~whole, F.transform(moves, lambda d: F.struct(d.alias("d"), pieces(common(d)).alias("signs")))))
    straight = straight.withColumn("joint", F.filter(F.transform("places", lambda i: F.struct(i.alias("i"), F.get(
        F.filter("masks", lambda m: F.substr(m["signs"], i + 1, F.lit(1)) == "1"), F.lit(0))["d"].alias("d"))), lambda x: x["d"].isNotNull()))
    straight = straight.withColumn("runs", F.transform("runs", lambda x: F.struct(x["k"].alias("k"), slots(F.transform(
        F.sequence(x["i"], x["i"] + x["k"] - 1), lambda i: F.struct(i.alias("i"), F.lit(0).alias("d")))).alias("slots"))))
    joint = F.when(F.size("joint") >= least, F.array(F.struct(F.size("joint").alias("k"), slots(F.col("joint")).alias("slots"))))
    found = straight.select("doc", "item", "item_tokens", F.explode(F.concat("runs", F.coalesce(joint, F.slice("runs", 1, 0)))).alias("x"))
    found = found.select("doc", "item", "item_tokens", F.col("x.k").alias("run"), F.col("x.slots").alias("slots"))
    values = F.array_distinct(F.transform("slots", lambda x: F.struct(x["kind"], x["iv"])))
    good = found.where(F.size(values) == F.size("slots")).withColumn("verbatim", F.forall("slots", lambda x: x["iv"] == x["dv"]))
    return good.groupBy("doc", "item").agg(F.max(F.struct(F.col("run") / F.col("item_tokens"), "run", "item_tokens")).alias("best"), F.max("verbatim").alias("verbatim")).select(
        F.col("doc").alias(id_col), F.col("item").alias(item_col), "best.run", "best.item_tokens", "verbatim")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, without those that hold a benchmark item; NULL and empty texts stay."""
    key = fresh(docs, "leaked")
    found = written(contaminated(docs, benchmark, id_col=id_col, text_col=text_col).select(F.col(id_col).alias(key)).distinct(), "leaked")
    return docs.join(found, docs[id_col].eqNullSafe(F.col(key)), "left_anti")
