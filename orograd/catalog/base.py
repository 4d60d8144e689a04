"""Registration of the catalogue queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, Callable[[], str]] = {}
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}  # name -> (SQL, names it needs)
DIGITS = 6


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (sql, needs)


def _ordered(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for m in CTES[n][1]:
            visit(m)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def query(name: str, sql: str | None = None, *, use: str = "", doubles: str = "", digits: int = DIGITS,
          recursive: bool = False):
    """Register a Spark query and its SQL.

    `doubles` names the columns rounded on both sides, as `name` or `name:digits`; means with few
    decimals need more digits, or the engines would break exact ties differently.
    """
    places = {k: int(n or digits) for k, _, n in (part.partition(":") for part in doubles.split())}

    def register(fn):
        QUERIES[name] = lambda spark, d: rounded(fn(spark, d), digits, places)
        if sql is not None:
            ORACLES[name] = lambda: _twin(sql, use, places, recursive)
        return fn
    return register


def _twin(sql: str, use: str, places: dict[str, int], recursive: bool) -> str:
    parts = [f"{n} AS ({CTES[n][0]})" for n in _ordered(tuple(use.split()))]
    head = f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} " if parts else ""
    replace = ", ".join(f"round({k}, {n}) + 0.0 AS {k}" for k, n in places.items())
    star = f"* REPLACE ({replace})" if replace else "*"
    return f"{head}SELECT {star} FROM ({sql}) AS q"


def rounded(df: DataFrame, digits: int = DIGITS, places: dict[str, int] | None = None) -> DataFrame:
    n = places or {}
    return df.select(*[(F.round(f.name, n.get(f.name, digits)) + 0.0).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f.name) for f in df.schema.fields])


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")
