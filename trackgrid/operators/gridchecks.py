"""Acceptance of a grid against the samples it was made from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackgrid.functions.columns import clean, lerp
from trackgrid.functions.ordered import Axis, brackets
from trackgrid.functions.quantiles import percentiles
from trackgrid.keys import DISCRETE, GRID_M, LAP, SESSION
from trackgrid.operators.series import TIME, grid_point_count, rising_edges

# Acceptance thresholds of the grid.
SPEED_P95_KMH = 2.0
SPEED_P99_KMH = 4.0
THROTTLE_P95_PCT = 6.0
RPM_P95 = 200.0
BRAKE_EDGE_P95_M = 10.0
ROUND_TRIP_CHANNELS = ("speed", "throttle", "rpm")


def structure(grid: DataFrame, lengths: DataFrame, spacing: float = GRID_M) -> DataFrame:
    """Per lap: exact point count, contiguous index, distance = index * spacing.

    ``lengths`` has the lap key and ``last_m``, the last sample's distance.
    """
    off = F.col("distance_m").cast("float") != (F.col("grid_index") * F.lit(float(spacing))).cast("float")
    stats = grid.groupBy(*LAP).agg(
        F.count(F.lit(1)).alias("n"), F.min("grid_index").alias("lo"), F.max("grid_index").alias("hi"), F.count_if(off).alias("off")
    )
    ok = (F.col("n") == grid_point_count(F.col("last_m"), spacing)) & (F.col("lo") == 0) & (F.col("hi") + 1 == F.col("n")) & (F.col("off") == 0)
    return lengths.join(stats, list(LAP), "left").select(*LAP, F.coalesce(ok, F.lit(False)).alias("structure_ok"))


def elapsed_increasing(grid: DataFrame, keys: Sequence[str] = LAP) -> DataFrame:
    """Per lap: time strictly increases along the grid; neighbours are met by index."""
    cur = grid.select(*keys, F.col("grid_index").cast("long").alias("_i"), F.col("elapsed_time").alias("_t"))
    nxt = cur.select(*keys, (F.col("_i") - 1).alias("_i"), F.col("_t").alias("_t1"))
    steps = cur.join(nxt, [*keys, "_i"], "left")
    return steps.groupBy(*keys).agg(F.coalesce(F.bool_and(F.col("_t1") > F.col("_t")), F.lit(True)).alias("increasing"))


def round_trip_errors(samples: DataFrame, grid: DataFrame, channels: Sequence[str] = ROUND_TRIP_CHANNELS, spacing: float = GRID_M, d: str = "distance_aligned") -> DataFrame:
    """Absolute error of the grid read back at each sample inside its range, one column per channel."""
    cell = F.floor(F.col(d) / F.lit(spacing)).cast("long")
    asked = samples.select(*LAP, F.col(d).alias("_x"), cell.alias("_i"), *[F.col(c).cast("double").alias(f"_s_{c}") for c in channels])
    low = grid.select(*LAP, F.col("grid_index").cast("long").alias("_i"), *[F.col(c).cast("double").alias(f"_a_{c}") for c in channels])
    high = grid.select(*LAP, (F.col("grid_index").cast("long") - 1).alias("_i"), *[F.col(c).cast("double").alias(f"_b_{c}") for c in channels])
    hit = asked.join(low, [*LAP, "_i"]).join(high, [*LAP, "_i"], "left")
    x0 = F.col("_i") * F.lit(float(spacing))
    exact = F.col("_x") == x0
    back = lambda c: F.when(exact, F.col(f"_a_{c}")).otherwise(lerp(F.col("_x"), x0, F.col(f"_a_{c}"), x0 + F.lit(float(spacing)), F.col(f"_b_{c}")))
    inside = exact | F.col(f"_b_{channels[0]}").isNotNull()
    return hit.filter(inside).select(*LAP, F.col("_x").alias(d), *[F.abs(back(c) - F.col(f"_s_{c}")).alias(c) for c in channels])


def invented_values(samples: DataFrame, grid: DataFrame, channels: Sequence[str] = DISCRETE) -> DataFrame:
    """Discrete grid values that the lap's samples never had, one row each."""

    def values(df: DataFrame) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).cast("int").alias("value")) for c in channels])
        return df.select(*LAP, F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()

    return values(grid).join(values(samples), [*LAP, "channel", "value"], "left_anti")


def nearest_on_line(points: DataFrame, marks: DataFrame, at: str, keys: Sequence[str] = LAP, span: float = 500.0) -> DataFrame:
    """For each point, the nearest mark of the same key on a line (ties: the lower); null without marks."""
    axis = Axis(tuple(keys), at, span)
    p = points.select(*keys, at, F.lit(1).alias("_ask"))
    m = marks.select(*keys, at, F.struct(F.col(at).alias("m")).alias("_mark"))
    both = brackets(axis.cut(p.unionByName(m, allowMissingColumns=True)), axis, ["_mark"]).filter("_ask = 1")
    lo, hi = F.col("_mark_prev")["m"], F.col("_mark_next")["m"]
    near = F.when(lo.isNull(), hi).when(hi.isNull(), lo).when(hi - F.col(at) < F.col(at) - lo, hi).otherwise(lo)
    return both.select(*keys, at, near.alias("nearest"), F.abs(F.col(at) - near).alias("gap"))


def brake_edge_displacement(samples: DataFrame, grid: DataFrame, channel: str = "brake", d: str = "distance_aligned", time_axis: Axis = TIME) -> DataFrame:
    """Distance from each source brake-on edge to the nearest grid edge of the lap."""
    source = rising_edges(samples, channel, time_axis, where=d)
    on = grid.select(*LAP, F.col("grid_index").cast("long").alias("_i"), F.col("distance_m").alias("edge_m"), F.coalesce(F.col(channel), F.lit(False)).alias("_on"))
    before = on.select(*LAP, (F.col("_i") + 1).alias("_i"), F.col("_on").alias("_was"))
    edges = on.filter("_on").join(before.filter("NOT _was"), [*LAP, "_i"]).select(*LAP, "edge_m")
    return nearest_on_line(source, edges, "edge_m").withColumnRenamed("gap", "displacement_m")


def empty_bins(samples: DataFrame, spacing: float = GRID_M, d: str = "distance_aligned", time: str = "session_time") -> DataFrame:
    """Share of grid bins of a lap that hold no sample."""
    cell = F.floor(F.col(d) / F.lit(spacing))
    occupied = samples.select(*LAP, cell.alias("_c")).filter("_c >= 0").distinct().groupBy(*LAP).agg(F.count(F.lit(1)).alias("_occ"), F.max("_c").alias("_top"))
    last = samples.groupBy(*LAP).agg(F.max_by(d, time).alias("_last"))
    n = grid_point_count(F.col("_last"), spacing)
    taken = F.coalesce(F.col("_occ"), F.lit(0))
    return last.join(occupied, list(LAP), "left").select(*LAP, (F.lit(1.0) - taken / n).alias("empty_bin_fraction"))


def channel_errors(df: DataFrame, column: Column | str, prefix: str, keys: Sequence[str] = SESSION) -> DataFrame:
    """p95, p99, max and count of the finite values per session."""
    return errors_of(df, {prefix: column}, keys)


def errors_of(df: DataFrame, columns: Mapping[str, Column | str], keys: Sequence[str] = SESSION, half: Mapping[str, Column] | None = None) -> DataFrame:
    """channel_errors of several columns by one plan; ``half``: columns of which the median is wanted too."""
    values = {prefix: clean(c) for prefix, c in columns.items()}
    asked = {prefix: (v, {f"{prefix}_p95": 0.95, f"{prefix}_p99": 0.99}) for prefix, v in values.items()}
    asked |= {f"_{name}": (c, {name: 0.5}) for name, c in (half or {}).items()}
    ranks = percentiles(df, keys, asked).drop(*[f"n_{name}" for name in asked])
    rest = [x for p, v in values.items() for x in (F.max(v).alias(f"{p}_max"), F.count(v).alias(f"{p}_n"))]
    return df.groupBy(*keys).agg(*rest).join(ranks, list(keys), "left")


def acceptance(samples: DataFrame, grid: DataFrame, spacing: float = GRID_M, d: str = "distance_aligned", time_axis: Axis = TIME) -> DataFrame:
    """One row per session: every grid check, its figures and the overall verdict."""
    lengths = samples.groupBy(*LAP).agg(F.max_by(d, time_axis.order).alias("last_m"))
    struct = structure(grid, lengths, spacing).groupBy(*SESSION).agg(F.count(F.lit(1)).alias("laps"), F.bool_and("structure_ok").alias("structure_ok"))
    rising = elapsed_increasing(grid).groupBy(*SESSION).agg(F.bool_and("increasing").alias("elapsed_ok"))
    errors = round_trip_errors(samples, grid, ROUND_TRIP_CHANNELS, spacing, d)
    parts = [errors_of(errors, {c: c for c in ROUND_TRIP_CHANNELS})]
    parts.append(channel_errors(brake_edge_displacement(samples, grid, d=d, time_axis=time_axis), "displacement_m", "brake_edge"))
    parts.append(errors_of(grid, {"source_gap": "source_gap_m"}, half={"source_gap_median_m": clean("source_gap_m")}))
    parts.append(invented_values(samples, grid).groupBy(*SESSION).agg(F.count(F.lit(1)).alias("invented")))
    parts.append(empty_bins(samples, spacing, d, time_axis.order).groupBy(*SESSION).agg(F.avg("empty_bin_fraction").alias("empty_bin_fraction")))
    out = reduce(lambda a, b: a.join(b, list(SESSION), "left"), parts, struct.join(rising, list(SESSION), "left"))
    ok: Mapping[str, Column] = {
        "speed_ok": (F.col("speed_p95") <= SPEED_P95_KMH) & (F.col("speed_p99") <= SPEED_P99_KMH),
        "throttle_ok": F.col("throttle_p95") <= THROTTLE_P95_PCT,
        "rpm_ok": F.col("rpm_p95") <= RPM_P95,
        "discrete_ok": F.coalesce(F.col("invented"), F.lit(0)) == 0,
        "brake_edge_ok": (F.coalesce(F.col("brake_edge_n"), F.lit(0)) == 0) | (F.col("brake_edge_p95") <= BRAKE_EDGE_P95_M),
    }
    out = out.withColumn("invented", F.coalesce("invented", F.lit(0))).withColumns({k: F.coalesce(v, F.lit(False)) for k, v in ok.items()})
    return out.withColumn("ok", reduce(lambda a, b: a & b, [F.col(c) for c in ("structure_ok", "elapsed_ok", *ok)]))
