"""Ordered-series primitives that do not depend on one task holding a series.

A window partitioned by the series key puts a whole series into one task, which
fails when one series holds a large share of the data. Here a series is cut in
chunks along its order column. The rows are dealt by (key, chunk) once; the
window runs on what was dealt, and so do the summaries, one row per chunk, that
carry what crosses a chunk border. Only the summaries are moved again.

Spark computes an exchange once for two readers if both ask for the same rows and
columns. Two things see to that. Rows are dealt by one struct of key and chunk: a
struct is never null, so joining the summaries to it puts no filter on one side
alone. And the summaries depend on a hash of every column, so that none is pruned
from their side. Callers pass the columns they need and no more.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackgrid.keys import LAP

CHUNK, PIECE = "_chunk", "_piece"


@dataclass(frozen=True)
class Axis:
    """A series: its key, the column that orders it and the width of a chunk."""

    keys: tuple[str, ...] = LAP
    order: str = "session_time"
    span: float = 60.0

    @property
    def chunk_keys(self) -> tuple[str, ...]:
        return self.keys + (CHUNK,)

    def cut(self, df: DataFrame) -> DataFrame:
        return df.withColumn(CHUNK, F.floor(F.col(self.order) / F.lit(self.span)))

    def deal(self, df: DataFrame) -> DataFrame:
        """The rows by chunk: the one exchange that windows and summaries share. Rows dealt before stay where they are."""
        if PIECE in df.columns:
            return df
        chunked = df if CHUNK in df.columns else self.cut(df)
        return chunked.withColumn(PIECE, F.struct(*self.chunk_keys)).drop(CHUNK).repartition(PIECE)

    def summaries(self, dealt: DataFrame, like: DataFrame, *aggregates: Column) -> DataFrame:
        """Aggregates per chunk of what ``deal`` returned, with the rows read as the other side reads them (see above)."""
        whole = F.min(F.xxhash64(*[F.col(c) for c in like.columns])).alias("_whole")
        return dealt.groupBy(PIECE).agg(*aggregates, whole).filter(F.col("_whole").isNotNull()).drop("_whole").select("*", f"{PIECE}.*")

    def within(self):
        return Window.partitionBy(PIECE).orderBy(self.order)

    def across(self):
        return Window.partitionBy(*self.keys).orderBy(CHUNK)


def neighbours(df: DataFrame, axis: Axis, cols: Sequence[str], prev: str = "prev", nxt: str = "next") -> DataFrame:
    """Add the previous and the next row of the series as structs of ``cols``."""
    chunked = axis.deal(df)
    body = F.struct(*[F.col(c) for c in cols])
    keyed = F.struct(F.col(axis.order).alias("_o"), body.alias("_b"))
    local = (
        chunked.withColumn("_p", F.lag(body).over(axis.within()))
        .withColumn("_n", F.lead(body).over(axis.within()))
    )
    edges = axis.summaries(chunked, chunked, F.min(keyed).alias("_lo"), F.max(keyed).alias("_hi"))
    edges = edges.select(
        PIECE,
        F.lag("_hi").over(axis.across()).getField("_b").alias("_cp"),
        F.lead("_lo").over(axis.across()).getField("_b").alias("_cn"),
    )
    return (
        local.join(edges, PIECE, "left")
        .withColumn(prev, F.coalesce("_p", "_cp"))
        .withColumn(nxt, F.coalesce("_n", "_cn"))
        .drop("_p", "_n", "_cp", "_cn", CHUNK, PIECE)
    )


def brackets(df: DataFrame, axis: Axis, samples: Sequence[str]) -> DataFrame:
    """For each struct column, the last one at or before and the first at or after each row.

    A struct that is null is no sample and is skipped; a null inside a struct is
    a value and is carried. Adds ``<name>_prev`` and ``<name>_next``.
    """
    chunked = axis.deal(df)
    upto = axis.within().rangeBetween(Window.unboundedPreceding, Window.currentRow)
    onward = axis.within().rangeBetween(Window.currentRow, Window.unboundedFollowing)
    before = axis.across().rowsBetween(Window.unboundedPreceding, -1)
    after = axis.across().rowsBetween(1, Window.unboundedFollowing)
    local = chunked.select(
        "*",
        *[F.last(s, ignorenulls=True).over(upto).alias(f"_lp_{s}") for s in samples],
        *[F.first(s, ignorenulls=True).over(onward).alias(f"_ln_{s}") for s in samples],
    )
    seen = {s: F.when(F.col(s).isNotNull(), F.struct(F.col(axis.order).alias("_o"), F.col(s).alias("_b"))) for s in samples}
    edges = axis.summaries(
        chunked, chunked, *[F.max(seen[s]).alias(f"_hi_{s}") for s in samples], *[F.min(seen[s]).alias(f"_lo_{s}") for s in samples]
    )
    edges = edges.select(
        PIECE,
        *[F.last(f"_hi_{s}", ignorenulls=True).over(before).getField("_b").alias(f"_cp_{s}") for s in samples],
        *[F.first(f"_lo_{s}", ignorenulls=True).over(after).getField("_b").alias(f"_cn_{s}") for s in samples],
    )
    out = local.join(edges, PIECE, "left")
    return out.select(
        *[c for c in df.columns if c not in (CHUNK, PIECE)],
        *[F.coalesce(f"_lp_{s}", f"_cp_{s}").alias(f"{s}_prev") for s in samples],
        *[F.coalesce(f"_ln_{s}", f"_cn_{s}").alias(f"{s}_next") for s in samples],
    )


def running(
    df: DataFrame, axis: Axis, sums: Mapping[str, Column] | None = None, maxima: Mapping[str, Column] | None = None
) -> DataFrame:
    """Running sums and running maxima, both including the current row."""
    sums, maxima = dict(sums or {}), dict(maxima or {})
    chunked = axis.deal(df)
    upto = axis.within().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = axis.across().rowsBetween(Window.unboundedPreceding, -1)
    local = chunked.select(
        "*",
        *[F.sum(c).over(upto).alias(f"_l_{n}") for n, c in sums.items()],
        *[F.max(c).over(upto).alias(f"_l_{n}") for n, c in maxima.items()],
    )
    edges = axis.summaries(
        chunked, chunked, *[F.sum(c).alias(f"_e_{n}") for n, c in sums.items()], *[F.max(c).alias(f"_e_{n}") for n, c in maxima.items()]
    )
    edges = edges.select(
        PIECE,
        *[F.sum(f"_e_{n}").over(before).alias(f"_c_{n}") for n in sums],
        *[F.max(f"_e_{n}").over(before).alias(f"_c_{n}") for n in maxima],
    )
    out = local.join(edges, PIECE, "left")
    zero = F.lit(0.0)
    return out.select(
        *[c for c in df.columns if c not in (CHUNK, PIECE)],
        *[(F.coalesce(f"_c_{n}", zero) + F.coalesce(f"_l_{n}", zero)).alias(n) for n in sums],
        *[F.greatest(f"_c_{n}", f"_l_{n}").alias(n) for n in maxima],
    )


def integrate(df: DataFrame, axis: Axis, cols: Sequence[str], step, name: str) -> DataFrame:
    """Running sum of ``step(previous, current)`` along the series, zero at its first row.

    ``step`` takes two structs of ``cols``. Steps inside a chunk are summed
    there; the steps between chunks are taken from the chunks' border rows.
    """
    chunked = axis.deal(df)
    body = F.struct(*[F.col(c) for c in cols])
    keyed = F.struct(F.col(axis.order).alias("_o"), body.alias("_b"))
    before = F.lag(body).over(axis.within())
    local = chunked.withColumn("_p", before).withColumn("_s", F.when(F.col("_p").isNotNull(), step(F.col("_p"), body)))
    upto = axis.within().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = local.withColumn("_l", F.coalesce(F.sum("_s").over(upto), F.lit(0.0))).drop("_p", "_s")
    edges = axis.summaries(local, chunked, F.sum("_s").alias("_in"), F.min(keyed).alias("_lo"), F.max(keyed).alias("_hi"))
    edges = edges.withColumn("_ph", F.lag("_hi").over(axis.across())).withColumn("_pi", F.lag("_in").over(axis.across()))
    jump = F.when(F.col("_ph").isNotNull(), step(F.col("_ph")["_b"], F.col("_lo")["_b"]))
    edges = edges.withColumn("_j", F.coalesce(jump, F.lit(0.0)) + F.coalesce("_pi", F.lit(0.0)))
    total = axis.across().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = edges.select(PIECE, F.sum("_j").over(total).alias("_c"))
    out = placed.join(edges, PIECE, "left")
    return out.select(*df.columns, (F.col("_c") + F.col("_l")).alias(name))
