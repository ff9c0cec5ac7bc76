"""Registry of queries. An output spec gives both sides the same names and types.

A spec lists "name:type" with i (bigint), d (double, 6 digits; the cut lies off the decimal tie so that both engines agree), s (string) or
b (boolean). It is applied to the Spark result and to the SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.binding import CTES, Binding


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Binding], DataFrame]
    out: tuple[tuple[str, str], ...]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return emit(self.build(Binding(spark, sf_dir)), self.out)

    def oracle(self) -> str | None:
        return None if self.sql is None else wrap_sql(self.sql, self.out)


QUERIES: dict[str, Query] = {}


def query(name: str, out: str, sql: str | None = None):
    spec = tuple(tuple(part.split(":")) for part in out.split())

    def register(fn: Callable[[Binding], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, fn, spec, sql)
        return fn

    return register


def emit(df: DataFrame, spec) -> DataFrame:
    cast = {
        "i": lambda c: F.col(c).cast("bigint"),
        "s": lambda c: F.col(c).cast("string"),
        "b": lambda c: F.col(c).cast("boolean"),
        "d": lambda c: F.floor(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) * F.lit(1e6) + F.lit(0.497)).cast("double") / F.lit(1e6),
    }
    return df.select(*[cast[t](n).alias(n) for n, t in spec])


def wrap_sql(sql: str, spec) -> str:
    cast = {
        "i": "CAST({0} AS BIGINT)",
        "s": "CAST({0} AS VARCHAR)",
        "b": "CAST({0} AS BOOLEAN)",
        "d": "CASE WHEN isnan(CAST({0} AS DOUBLE)) THEN NULL ELSE floor(CAST({0} AS DOUBLE) * 1e6 + 0.497::DOUBLE) / 1e6 + 0.0 END",
    }
    cols = ", ".join(cast[t].format(f'"{n}"') + f' AS "{n}"' for n, t in spec)
    return f"WITH {with_ctes(sql)} result AS ({sql}) SELECT {cols} FROM result"


def with_ctes(sql: str) -> str:
    """The common table expressions a statement names, in dependency order."""
    import re

    order: list[str] = []

    def visit(text: str):
        for word in dict.fromkeys(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text)):
            if word in CTES and word not in order:
                visit(CTES[word])
                order.append(word)

    visit(sql)
    return "".join(f"{name} AS MATERIALIZED ({CTES[name]}), " for name in order)
