"""Per-lap series: channel merge, distance axes, resampling on a uniform grid.

All laps of all sessions are processed in one plan. Series windows go through
``functions.ordered``, so no task has to hold a whole lap.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackgrid.functions.columns import lerp, positions_to_metres
from trackgrid.functions.ordered import PIECE, Axis, brackets, integrate, neighbours, running
from trackgrid.keys import (
    CONTINUOUS,
    DISCRETE,
    GRID_M,
    KMH_PER_MS,
    LAP,
    MERGE_CAR_LINEAR,
    MERGE_POS_LINEAR,
    SESSION,
)
from trackgrid.session import cut

TIME = Axis()
DISTANCE = Axis(order="distance_aligned", span=500.0)


# ---------------------------------------------------------------- channel merge

def overlap(car: DataFrame, pos: DataFrame, keys: Sequence[str] = LAP, time: str = "session_time") -> DataFrame:
    """Per lap: the time span both channel sets cover, and why a lap has none."""
    side = lambda df, p: df.groupBy(*keys).agg(
        F.min(time).alias(f"{p}_lo"), F.max(time).alias(f"{p}_hi"), F.count(F.lit(1)).alias(f"{p}_n")
    )
    both = side(car, "car").join(side(pos, "pos"), list(keys), "full")
    lo, hi = F.greatest("car_lo", "pos_lo"), F.least("car_hi", "pos_hi")
    reason = (
        F.when(F.col("car_n").isNull() | F.col("pos_n").isNull(), F.lit("no telemetry for this lap"))
        .when((F.col("car_n") < 2) | (F.col("pos_n") < 2), F.lit("merge failed: fewer than 2 samples in a channel set"))
        .when(~(hi > lo), F.lit("merge failed: car and position data do not overlap in time"))
    )
    return both.select(*keys, lo.alias("lo"), hi.alias("hi"), reason.alias("reason"))


def timebase(car: DataFrame, pos: DataFrame, keys: Sequence[str] = LAP, time: str = "session_time") -> DataFrame:
    """Union of both clocks, each instant once, clipped to the overlap."""
    spans = overlap(car, pos, keys, time).filter(F.col("reason").isNull()).drop("reason")
    instants = car.select(*keys, time).unionByName(pos.select(*keys, time)).distinct()
    return instants.join(spans, list(keys)).filter(F.col(time).between(F.col("lo"), F.col("hi"))).drop("lo", "hi")


def merge_channels(
    car: DataFrame,
    pos: DataFrame,
    axis: Axis = TIME,
    car_linear: Sequence[str] = MERGE_CAR_LINEAR,
    pos_linear: Sequence[str] = MERGE_POS_LINEAR,
    car_step: Sequence[str] = DISCRETE,
) -> DataFrame:
    """Both channel sets on the union timebase: linear for continuous channels, previous value for states."""
    t = axis.order
    car_cols, pos_cols = [*car_linear, *car_step], list(pos_linear)
    c = car.select(*axis.keys, t, F.struct(F.col(t).alias("t"), *car_cols).alias("car"))
    p = pos.select(*axis.keys, t, F.struct(F.col(t).alias("t"), *pos_cols).alias("pos"))
    rows = axis.deal(c.unionByName(p, allowMissingColumns=True))
    instants = rows.groupBy(PIECE, t).agg(F.max("car").alias("car"), F.max("pos").alias("pos")).select(PIECE, *[F.col(PIECE)[k].alias(k) for k in axis.keys], t, "car", "pos")
    seen = brackets(instants, axis, ["car", "pos"])
    spans = overlap(car, pos, axis.keys, t).filter(F.col("reason").isNull()).drop("reason")
    x = F.col(t)

    def linear(side: str, name: str) -> Column:
        a, b = F.col(f"{side}_prev"), F.col(f"{side}_next")
        y0, y1 = a[name].cast("double"), b[name].cast("double")
        return F.when(a["t"] == b["t"], y0).otherwise(lerp(x, a["t"], y0, b["t"], y1)).alias(name)

    merged = seen.join(spans, list(axis.keys)).filter(x.between(F.col("lo"), F.col("hi")))
    out = merged.select(
        *axis.keys,
        t,
        *[linear("car", n) for n in car_linear],
        *[F.col("car_prev")[n].alias(n) for n in car_step],
        *[linear("pos", n) for n in pos_linear],
    )
    return positions_to_metres(out, list(pos_linear))


def add_raw_distance(df: DataFrame, axis: Axis = TIME, speed: str = "speed", name: str = "distance_raw") -> DataFrame:
    """Trapezoid integral of speed (km/h) over time (s), zero at the first sample."""
    t = axis.order
    ms = lambda row: row[speed].cast("double") / KMH_PER_MS

    def step(a: Column, b: Column) -> Column:
        backwards = F.raise_error(F.lit("session_time decreases within a lap")).cast("double")
        return F.when(b[t] < a[t], backwards).otherwise(0.5 * (ms(a) + ms(b)) * (b[t] - a[t]))

    return integrate(df, axis, [t, speed], step, name)


def lap_frames(car: DataFrame, pos: DataFrame, axis: Axis = TIME) -> DataFrame:
    """Merged channels with the lap's own distance axis."""
    return add_raw_distance(merge_channels(car, pos, axis), axis)


# ---------------------------------------------------------------- distance axis

def enforce_monotonic(df: DataFrame, axis: Axis = TIME, column: str = "distance_aligned") -> DataFrame:
    """Running maximum of the axis, and which samples it moved."""
    d = F.col(column)
    out = running(df, axis, maxima={"_m": d})
    return out.withColumn("corrected", F.col("_m") != d).withColumn(column, F.col("_m")).drop("_m")


def extend_axis_ends(
    df: DataFrame, line: DataFrame, keys: Sequence[str] = LAP, time: str = "session_time", d: str = "distance_aligned", raw: str = "distance_raw"
) -> DataFrame:
    """Continue the axis with raw distance where it is clamped at either end of the line.

    ``line`` has one row per session with ``line_length_m``. Interior flat runs stay.
    """
    session = [k for k in keys if k in line.columns]
    first = df.groupBy(*keys).agg(
        F.min_by(d, time).alias("_d0"), F.max_by(d, time).alias("_d9"), F.count(F.lit(1)).alias("_n")
    )
    ends = df.join(first, list(keys)).groupBy(*keys).agg(
        F.first("_d0").alias("_d0"),
        F.first("_d9").alias("_d9"),
        F.min(F.when(F.col(d) > F.col("_d0"), F.struct(time, F.col(d).alias("d"), F.col(raw).alias("r")))).alias("_lo"),
        F.max(F.when(F.col(d) < F.col("_d9"), F.struct(time, F.col(d).alias("d"), F.col(raw).alias("r")))).alias("_hi"),
    )
    ends = ends.join(line.select(*session, "line_length_m"), session, "left")
    lead = (F.col("_d0") <= 1e-9) & F.col("_lo").isNotNull() & (F.col(time) < F.col("_lo")[time])
    trail = (F.col("_d9") >= F.col("line_length_m") - 1e-6) & F.col("_hi").isNotNull() & (F.col(time) > F.col("_hi")[time])
    moved = (
        F.when(trail, F.col("_hi")["d"] + (F.col(raw) - F.col("_hi")["r"]))
        .when(lead, F.col("_lo")["d"] - (F.col("_lo")["r"] - F.col(raw)))
        .otherwise(F.col(d))
    )
    return df.join(ends, list(keys)).withColumn(d, moved).select(*df.columns)


MAX_ORIGIN_SHIFT_M = 150.0  # fixed value


def place_axis_origin(
    df: DataFrame, keys: Sequence[str] = LAP, session: Sequence[str] = SESSION, time: str = "session_time", d: str = "distance_aligned",
    cap: float = MAX_ORIGIN_SHIFT_M,
) -> DataFrame:
    """Move distance zero to the latest opening of the session, at most ``cap``."""
    opened = df.groupBy(*keys).agg(F.min_by(d, time).alias("_first"))
    shift = opened.groupBy(*session).agg(F.least(F.max("_first"), F.lit(cap)).alias("_s"))
    shift = shift.withColumn("origin_shift_m", F.when(F.abs("_s") < 1e-9, 0.0).otherwise(F.col("_s"))).drop("_s")
    return df.join(shift, list(session)).withColumn(d, F.col(d) - F.col("origin_shift_m"))


# ---------------------------------------------------------------- resampling

def last_of_each_distance(df: DataFrame, axis: Axis = DISTANCE, time: str = "session_time", cols: Sequence[str] = ()) -> DataFrame:
    """One row per distance of a lap: the last sample in time.

    On a non-decreasing axis the samples of one distance are one run, so a
    grouping by distance is the run and needs no series order.
    """
    rows = axis.deal(df.select(*axis.keys, axis.order, time, *cols))
    body = F.struct(time, *cols)
    kept = rows.groupBy(PIECE, axis.order).agg(F.max(body).alias("_s"))
    return kept.select(PIECE, *[F.col(PIECE)[k].alias(k) for k in axis.keys], axis.order, "_s.*")


def grid_point_count(length: Column, spacing: float = GRID_M) -> Column:
    return F.floor(length / F.lit(spacing)) + 1


def make_grid(laps: DataFrame, length: str = "lap_length_m", spacing: float = GRID_M) -> DataFrame:
    """Uniform grid 0, spacing, ... up to each row's length."""
    if spacing <= 0:
        raise ValueError("grid spacing must be positive")
    ok = F.col(length).isNotNull() & (F.col(length) >= 0)
    return (
        laps.filter(ok)
        .withColumn("grid_index", F.explode(F.sequence(F.lit(0).cast("long"), grid_point_count(F.col(length), spacing) - 1)))
        .withColumn("distance_m", F.col("grid_index") * F.lit(float(spacing)))
    )


def lap_rejects(
    df: DataFrame, axis: Axis = TIME, d: str = "distance_aligned", required: Sequence[str] = ()
) -> DataFrame:
    """Laps that cannot be resampled, each with the first reason that holds."""
    missing = [c for c in (*axis.keys, axis.order, d, *required) if c not in df.columns]
    if missing:
        return df.select(*[k for k in axis.keys if k in df.columns]).distinct().withColumn(
            "reason", F.lit(f"lap is missing columns {missing}")
        )
    bad = lambda c: F.isnan(c) | c.isNull() | (F.abs(c) == F.lit(float("inf")))
    dist, time = F.col(d).cast("double"), F.col(axis.order).cast("double")
    # a lap without a time at some sample has no series order there: it is refused below
    steps = neighbours(df.select(*axis.keys, F.coalesce(time, F.lit(float("nan"))).alias(axis.order), dist.alias(d)), axis, [d, axis.order])
    stats = steps.groupBy(*axis.keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(bad(F.col(d))).alias("bad_d"),
        F.count_if(bad(F.col(axis.order))).alias("bad_t"),
        F.count_if(F.col(d) < F.col("prev")[d]).alias("back_d"),
        F.max(d).alias("hi"),
        F.min(d).alias("lo"),
    )
    reason = (
        F.when(F.col("n") < 2, F.concat(F.lit("need at least 2 samples, got "), F.col("n").cast("string")))
        .when(F.col("bad_d") > 0, F.lit("distance contains non-finite values"))
        .when(F.col("bad_t") > 0, F.lit("time contains non-finite values"))
        .when(F.col("back_d") > 0, F.lit("distance is not monotonically non-decreasing"))
        .when(F.col("hi") == F.col("lo"), F.lit("lap covers a single distance value"))
        .when(F.col("hi") < 0, F.lit("lap ends before distance zero"))
    )
    return stats.select(*axis.keys, reason.alias("reason")).filter(F.col("reason").isNotNull())


def resample(
    df: DataFrame,
    spacing: float = GRID_M,
    axis: Axis = DISTANCE,
    time: str = "session_time",
    continuous: Sequence[str] = CONTINUOUS,
    discrete: Sequence[str] = DISCRETE,
) -> DataFrame:
    """Laps on a uniform distance grid, without a per-lap worker.

    Every kept sample owns the grid points from itself up to the next sample,
    so each point is produced once, by its own segment. The first sample also
    owns the points before it, which take its values.
    """
    keys, d = list(axis.keys), axis.order
    origin = df.groupBy(*keys).agg(F.min(time).alias("_t0"))
    kept = last_of_each_distance(df, axis, time, [*continuous, *discrete])
    body = [d, time, *continuous, *discrete]
    seg = neighbours(kept, axis, body).join(origin, keys)
    x0, x1 = F.col(d), F.col("next")[d]
    step = F.lit(float(spacing))
    first = F.when(F.col("prev").isNull(), F.lit(0.0)).otherwise(F.greatest(F.ceil(x0 / step).cast("double"), F.lit(0.0)))
    last = F.when(x1.isNull(), F.floor(x0 / step)).otherwise(F.ceil(x1 / step) - 1)
    seg = seg.withColumn("_lo", first.cast("long")).withColumn("_hi", last.cast("long")).filter(F.col("_hi") >= F.col("_lo"))
    points = seg.withColumn("grid_index", F.explode(F.sequence("_lo", "_hi")))
    x = F.col("grid_index") * step

    def linear(y0: Column, y1: Column) -> Column:
        held = x1.isNull() | (x <= x0)
        return F.when(held, y0).otherwise(lerp(x, x0, y0, x1, y1))

    return points.select(
        *keys,
        "grid_index",
        x.alias("distance_m"),
        linear(F.col(time) - F.col("_t0"), F.col("next")[time] - F.col("_t0")).alias("elapsed_time"),
        *[linear(F.col(c).cast("double"), F.col("next")[c].cast("double")).alias(c) for c in continuous],
        *discrete,
        F.when(x < x0, F.lit(None).cast("double")).when(x == x0, F.lit(0.0)).otherwise(x1 - x0).alias("source_gap_m"),
    )


def resample_session(df: DataFrame, spacing: float = GRID_M, axis: Axis = DISTANCE, time_axis: Axis = TIME, **kw) -> tuple[DataFrame, DataFrame]:
    """(grid, rejected laps with reasons); one bad lap never stops the others."""
    rejected = lap_rejects(df, time_axis, axis.order)
    good = df.join(rejected.drop("reason"), list(axis.keys), "left_anti")
    return resample(good, spacing, axis, time_axis.order, **kw), rejected


# ---------------------------------------------------------------- time curves and deltas

class DeltaError(ValueError):
    """The grid cannot be turned into time curves."""


def time_curves(grid: DataFrame, keys: Sequence[str] = LAP, extra: Sequence[str] = ()) -> DataFrame:
    """t_s: time since the lap reached grid index 0. A lap without index 0 is an error."""
    zero = grid.filter(F.col("grid_index") == 0).select(*keys, F.col("elapsed_time").cast("double").alias("_t0"))
    t0 = F.coalesce(F.col("_t0"), F.raise_error(F.lit("lap without grid index 0")).cast("double"))
    joined = grid.join(zero, list(keys), "left")
    return joined.select(*keys, "grid_index", (F.col("elapsed_time").cast("double") - t0).alias("t_s"), *extra)


def curve_faults(grid: DataFrame, keys: Sequence[str] = LAP) -> DataFrame:
    """Laps without index 0 or with a hole in their grid."""
    stats = grid.groupBy(*keys).agg(
        F.min("grid_index").alias("lo"), F.max("grid_index").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    why = F.when(F.col("lo") != 0, F.lit("no grid index 0")).when(F.col("hi") + 1 != F.col("n"), F.lit("gap in the grid"))
    return stats.select(*keys, why.alias("reason")).filter(F.col("reason").isNotNull())


def lap_lengths(grid: DataFrame, keys: Sequence[str] = LAP) -> DataFrame:
    return grid.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_points"))


def reference_curves(curves: DataFrame, reference: DataFrame, session: Sequence[str] = SESSION) -> DataFrame:
    """The time curves of the laps that serve as a reference, keyed by reference lap."""
    wanted = reference.select(*session, "ref_driver", "ref_lap").distinct()
    on = [curves[k] == wanted[k] for k in session] + [
        curves["driver"] == wanted["ref_driver"], curves["lap_number"] == wanted["ref_lap"]
    ]
    hit = curves.join(wanted, reduce(lambda a, b: a & b, on), "left_semi")
    return hit.select(
        *session, F.col("driver").alias("ref_driver"), F.col("lap_number").alias("ref_lap"), "grid_index", F.col("t_s").alias("ref_t_s")
    )


def delta_t(curves: DataFrame, reference: DataFrame, kind: str) -> DataFrame:
    """t_s minus the reference lap's, at the same grid index; null past the reference's end."""
    keys = list(LAP)
    tagged = curves.join(reference.select(*keys, "ref_driver", "ref_lap"), keys)
    refs = reference_curves(curves, reference)
    joined = tagged.join(refs, [*SESSION, "ref_driver", "ref_lap", "grid_index"], "left")
    label = F.concat(F.col("ref_driver"), F.lit(" L"), F.col("ref_lap").cast("int").cast("string"))
    return joined.select(
        *keys, "grid_index", "t_s", (F.col("t_s") - F.col("ref_t_s")).alias("delta_t_s"),
        label.alias("reference"), F.lit(kind).alias("reference_kind"),
    )


def value_at_times(samples: DataFrame, instants: DataFrame, column: str, axis: Axis = TIME, at: str = "crossing_time_s", name: str = "distance_m") -> DataFrame:
    """A channel read linearly at given instants of each lap; instants outside the lap's samples are dropped."""
    t = axis.order
    s = samples.select(*axis.keys, t, F.struct(F.col(t).alias("t"), F.col(column).cast("double").alias("v")).alias("obs"))
    extra = [c for c in instants.columns if c not in axis.keys]
    q = instants.select(*axis.keys, F.col(at).alias(t), F.struct(*extra).alias("ask"))
    seen = brackets(axis.cut(s.unionByName(q, allowMissingColumns=True)), axis, ["obs"]).filter(F.col("ask").isNotNull())
    a, b, x = F.col("obs_prev"), F.col("obs_next"), F.col(t)
    val = F.when(a["t"] == b["t"], a["v"]).otherwise(lerp(x, a["t"], a["v"], b["t"], b["v"]))
    return seen.filter(a.isNotNull() & b.isNotNull()).select(*axis.keys, "ask.*", val.alias(name))


def raw_distance_at(samples: DataFrame, instants: DataFrame, axis: Axis = TIME, at: str = "at_s", raw: str = "distance_raw", speed: str = "speed") -> DataFrame:
    """Raw distance at an instant; outside the samples the end speed is held constant."""
    t = axis.order
    s = samples.select(
        *axis.keys, t,
        F.struct(F.col(t).alias("t"), F.col(raw).cast("double").alias("r"), (F.col(speed).cast("double") / KMH_PER_MS).alias("v")).alias("obs"),
    )
    extra = [c for c in instants.columns if c not in axis.keys]
    q = instants.select(*axis.keys, F.col(at).alias(t), F.struct(*extra).alias("ask"))
    seen = brackets(axis.cut(s.unionByName(q, allowMissingColumns=True)), axis, ["obs"]).filter(F.col("ask").isNotNull())
    a, b, x = F.col("obs_prev"), F.col("obs_next"), F.col(t)
    value = (
        F.when(a.isNull(), b["r"] - b["v"] * (b["t"] - x))
        .when(b.isNull(), a["r"] + a["v"] * (x - a["t"]))
        .when(a["t"] == b["t"], a["r"])
        .otherwise(lerp(x, a["t"], a["r"], b["t"], b["r"]))
    )
    return seen.select(*axis.keys, "ask.*", value.alias("raw_m"), (a.isNull() | b.isNull()).alias("extrapolated"))


def asked_points(points: DataFrame, asked: DataFrame, *indices: str) -> DataFrame:
    """Rows at a grid index that any lap of their session asks for, so that the other rows do not move for a join by lap and index.

    What a session asks for is bounded by its grid and goes to every task.
    """
    spots = asked.select(*SESSION, F.explode(F.array(*[F.col(i).cast("long") for i in indices])).alias("grid_index")).distinct()
    return points.join(F.broadcast(spots), [*SESSION, "grid_index"], "left_semi")


def time_at_distance(curves: DataFrame, targets: DataFrame, spacing: float = GRID_M, name: str = "at_time_s") -> DataFrame:
    """Curve time at a distance per lap; past either end the end speed is held constant.

    ``curves`` carries t_s and speed_ms; ``targets`` the lap key, any labels and ``target_m``.
    """
    keys = list(LAP)
    ends = curves.groupBy(*keys).agg(F.max("grid_index").alias("_last"))
    cell = F.greatest(F.lit(0), F.least(F.floor(F.col("target_m") / F.lit(spacing)), F.col("_last")))
    asked = cut(targets.join(ends, keys).withColumn("_i", cell.cast("long")), "asked-times")
    curves = asked_points(curves, asked.withColumn("_j", F.col("_i") + 1), "_i", "_j")
    low = curves.select(*keys, F.col("grid_index").cast("long").alias("_i"), F.col("t_s").alias("_t0"), F.col("speed_ms").alias("_v0"))
    high = curves.select(*keys, (F.col("grid_index").cast("long") - 1).alias("_i"), F.col("t_s").alias("_t1"))
    x, x0 = F.col("target_m"), F.col("_i") * F.lit(float(spacing))
    value = (
        F.when(x < 0, F.col("_t0") - (x0 - x) / F.col("_v0"))
        .when(F.col("_t1").isNull(), F.col("_t0") + (x - x0) / F.col("_v0"))
        .when(x == x0, F.col("_t0"))
        .otherwise(lerp(x, x0, F.col("_t0"), x0 + F.lit(float(spacing)), F.col("_t1")))
    )
    hit = asked.join(low, [*keys, "_i"]).join(high, [*keys, "_i"], "left")
    return hit.select(*targets.columns, value.alias(name))


def nearest_grid_point(targets: DataFrame, grid: DataFrame, columns: Sequence[str], spacing: float = GRID_M) -> DataFrame:
    """Grid values at the nearest index, half to even."""
    asked = targets.withColumn("grid_index", F.rint(F.col("target_m") / F.lit(spacing)).cast("long"))
    return asked.join(grid.select(*LAP, F.col("grid_index").cast("long").alias("grid_index"), *columns), [*LAP, "grid_index"], "left")


# ---------------------------------------------------------------- boolean channels

def rising_edges(df: DataFrame, state: str, axis: Axis = TIME, where: str | None = None) -> DataFrame:
    """Rows at which a state goes from off to on; the first row is never an edge."""
    at = where or axis.order
    steps = neighbours(df.select(*axis.keys, axis.order, *([at] if at != axis.order else []), F.coalesce(F.col(state), F.lit(False)).alias("_on")), axis, ["_on"])
    return steps.filter(F.col("_on") & (F.col("prev")["_on"] == F.lit(False))).select(*axis.keys, F.col(at).alias("edge_m"))


def boolean_runs(points: DataFrame, state: str = "brake", keys: Sequence[str] = LAP, index: str = "grid_index", at: str = "distance_m") -> DataFrame:
    """Runs of a true state over consecutive grid points: first and last distance of each.

    The points are first cut to a window by the caller. A run starts where the
    point before it is absent or off and ends where the one after it is; start
    and end of the same rank belong together. Neighbours are found by index, so
    the work is spread by grid point and not by lap.
    """
    on = points.filter(F.coalesce(F.col(state), F.lit(False))).select(*keys, F.col(index).cast("long").alias("_i"), F.col(at).alias("_d"))
    before = on.select(*keys, (F.col("_i") + 1).alias("_i"))
    after = on.select(*keys, (F.col("_i") - 1).alias("_i"))
    from pyspark.sql import Window

    rank = Window.partitionBy(*keys).orderBy("_i")
    starts = on.join(before, [*keys, "_i"], "left_anti").select(*keys, F.row_number().over(rank).alias("application"), F.col("_d").alias("on_m"))
    ends = on.join(after, [*keys, "_i"], "left_anti").select(*keys, F.row_number().over(rank).alias("application"), F.col("_d").alias("off_m"))
    return starts.join(ends, [*keys, "application"])


def trace_window(grid: DataFrame, a: DataFrame, b: DataFrame, start_m: Column, end_m: Column, channels: Sequence[str] = ("speed", "throttle", "n_gear", "brake", "source_gap_m")) -> DataFrame:
    """Two laps over a stretch, on shared grid points, the running delta zero at its start.

    ``a`` and ``b`` have one row per session naming a lap.
    """
    side = lambda pick, s: grid.join(pick.select(*LAP), list(LAP), "left_semi").select(
        *SESSION, "grid_index", F.col("distance_m").alias(f"d_{s}"), F.col("elapsed_time").cast("double").alias(f"t_{s}"),
        *[F.col(c).alias(f"{c}_{s}") for c in channels],
    )
    both = side(a, "a").join(side(b, "b"), [*SESSION, "grid_index"]).filter((F.col("d_a") >= start_m) & (F.col("d_a") <= end_m))
    opening = both.groupBy(*SESSION).agg(F.min_by(F.struct("t_a", "t_b"), "grid_index").alias("_o"))
    out = both.join(opening, list(SESSION))
    running_delta = (F.col("t_b") - F.col("_o")["t_b"]) - (F.col("t_a") - F.col("_o")["t_a"])
    return out.select(
        *SESSION, "grid_index", F.col("d_a").alias("distance_m"),
        *[f"{c}_{s}" for c in channels for s in ("a", "b")],
        (F.col("speed_b") - F.col("speed_a")).alias("d_speed_kmh"), running_delta.alias("cumulative_delta_s"),
    )
