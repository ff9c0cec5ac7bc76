"""Corner events and micro-sectors from the session's median trace.

A trace has one row per grid index, and the grid contract bounds the index
(keys.MAX_GRID_INDEX), so one session's trace is a few arrays in a task. Troughs
and boundaries are found there (see troughs) and leave it as a row of numbers per
event; indices are unwrapped, so an event across the start line is one event.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackgrid.functions.columns import (
    circular_gap,
    corner_label,
    flag,
    in_closed_window,
    in_half_open_window,
    parse_corner_label,
)
from trackgrid.functions.quantiles import exact_median, medians
from trackgrid.keys import GRID_M, LAP, MAX_GRID_INDEX, SESSION
from trackgrid.operators import troughs
from trackgrid.operators.series import asked_points
from trackgrid.session import cut, ship


@dataclass(frozen=True)
class EventParams:
    """The segmentation parameters and their defaults."""

    min_prominence_kmh: float = 8.0
    marginal_factor: float = 2.0
    apex_fraction: float = 0.05
    exit_recovery_fraction: float = 0.5
    brake_on_fraction: float = 0.5
    throttle_lift_pct: float = 90.0
    label_margin_m: float = 30.0
    fallback_margin_m: float = 60.0


# Windows and acceptance thresholds of the segmentation.
APEX_WINDOW_MARGIN_M = 30.0
BRAKE_LOOKBACK_M = 50.0
APEX_DEV_P95_M = 30.0
BRAKE_DEV_P95_M = 30.0
JACKKNIFE_SHIFT_P95_M = 10.0
CORNER_OFFSET_MAX_M = 10.0
FIXED_BIN_M = 100.0
GRAIN_PHASE = "corner_phase"
GRAIN_BINS = "fixed_100m"


# ---------------------------------------------------------------- median trace

def _covered(grid: DataFrame, min_lap_fraction: float, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Grid indices that enough laps reach, and per session the first of them and the last before a gap."""
    key = [*by, "grid_index"]
    laps = grid.select(*by, "driver", "lap_number").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("_laps"))
    stats = grid.groupBy(*key).agg(F.avg(F.col("brake").cast("double")).alias("brake"), F.count(F.lit(1)).alias("n_laps"))
    need = F.greatest(F.lit(1), F.ceil(F.lit(min_lap_fraction) * F.col("_laps")))
    kept = stats.join(laps, by).filter(F.col("n_laps") >= need).drop("_laps")
    after = kept.select(*by, (F.col("grid_index") - 1).alias("grid_index"))
    reach = kept.select(*key).join(after, key, "left_anti").groupBy(*by).agg(F.min("grid_index").cast("long").alias("_end"))
    opens = kept.groupBy(*by).agg(F.min("grid_index").alias("_open"))
    return kept, reach.join(opens, by)


def _trace_fault() -> Column:
    return F.when(F.col("_open") != 0, F.lit("median trace does not start at grid index 0")).when(
        F.col("_end") > MAX_GRID_INDEX, F.lit("grid index beyond the contract's bound")
    )


def trace_faults(grid: DataFrame, min_lap_fraction: float = 0.8, by: Sequence[str] = SESSION) -> DataFrame:
    """Sessions whose laps give no usable median trace, with the reason."""
    reach = _covered(grid, min_lap_fraction, list(by))[1]
    return reach.select(*by, _trace_fault().alias("reason")).filter(F.col("reason").isNotNull())


def median_traces(grid: DataFrame, min_lap_fraction: float = 0.8, by: Sequence[str] = SESSION, spacing: float = GRID_M) -> DataFrame:
    """Per grid index the median speed and throttle and the share of laps braking.

    Indices fewer than ``min_lap_fraction`` of the laps reach are dropped, and
    the trace ends before the first missing index. A session that
    ``trace_faults`` names is an error here; a batch leaves it out before.
    """
    by = list(by)
    key = [*by, "grid_index"]
    kept, reach = _covered(grid, min_lap_fraction, by)
    end = F.when(_trace_fault().isNotNull(), F.raise_error(_trace_fault()).cast("long")).otherwise(F.col("_end"))
    kept = kept.join(reach.select(*by, end.alias("_end")), by).filter(F.col("grid_index") <= F.col("_end")).drop("_end")
    kept = kept.join(medians(grid, key, {"speed": "speed", "throttle": "throttle"}, few=True), key, "left")
    return kept.withColumn("distance_m", F.col("grid_index") * F.lit(float(spacing)))


def lap_length(traces: DataFrame, by: Sequence[str] = SESSION, spacing: float = GRID_M) -> DataFrame:
    return traces.groupBy(*by).agg((F.count(F.lit(1)) * F.lit(float(spacing))).alias("lap_length_m"))


def _by_trace(traces: DataFrame, by: Sequence[str], do, out: str) -> DataFrame:
    """do(speed, brake, throttle) for each trace; a trace holds at most MAX_GRID_INDEX + 1 points."""
    by = list(by)
    kinds = dict(traces.dtypes)
    names = [f.split()[0] for f in out.split(", ")]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pd.DataFrame(do(*troughs.traces_of(pdf)), columns=names).convert_dtypes()
        return rows.assign(**{c: pdf[c].iloc[0] for c in by})[[*by, *names]]

    columns = [F.col(c).cast("double").alias(c) for c in ("speed", "brake", "throttle") if c in traces.columns]
    schema = ", ".join([f"{c} {kinds[c]}" for c in by] + [out])
    ship(traces.sparkSession)
    return traces.select(*by, "grid_index", *columns).groupBy(*by).applyInPandas(one, schema)


def find_troughs(traces: DataFrame, min_prominence: float = 8.0, by: Sequence[str] = SESSION) -> DataFrame:
    """Local minima of the circular trace with enough prominence; a flat floor reports its first point."""

    def found(speed, brake, throttle):
        spots, prominence = troughs.find(speed, min_prominence)
        return [(k, int(i), float(speed[i]), float(p)) for k, (i, p) in enumerate(zip(spots, prominence, strict=True))]

    return _by_trace(traces, by, found, "trough_id long, i long, v double, prominence double")


def raw_events(traces: DataFrame, params: EventParams = EventParams(), by: Sequence[str] = SESSION) -> DataFrame:
    """Event boundaries in unwrapped grid indices, one row per trough."""

    def events(speed, brake, throttle):
        return troughs.bounds(speed, brake, throttle, *troughs.find(speed, params.min_prominence_kmh), params)

    return _by_trace(traces, by, events, troughs.EVENT_FIELDS)


def label_events(raw: DataFrame, corners: DataFrame, params: EventParams = EventParams(), by: Sequence[str] = SESSION, spacing: float = GRID_M) -> DataFrame:
    """Corners of each event: its own window first, then unclaimed markers just before the apex band.

    ``corners`` carries distance_m, number and letter. A marker reachable by two
    unlabelled events goes to the first of them.
    """
    by = list(by)
    g = F.lit(float(spacing))
    length = F.col("n") * g
    c = corners.select(*by, F.col("distance_m").cast("double").alias("_d"), "number", F.coalesce("letter", F.lit("")).alias("letter"))
    pairs = raw.join(c, by)
    own = in_closed_window(F.col("_d"), F.col("start") * g - params.label_margin_m, F.col("exit_end") * g + params.label_margin_m, length)
    first = pairs.filter(own).select(*by, "event_id", "_d", "number", "letter")
    bare = raw.join(first.select(*by, "event_id").distinct(), [*by, "event_id"], "left_anti")
    free = c.join(first.select(*by, "_d", "number", "letter").distinct(), [*by, "_d", "number", "letter"], "left_anti")
    a0 = F.col("a0") * g
    near = bare.join(free, by).filter(in_closed_window(F.col("_d"), a0 - params.fallback_margin_m, a0, length))
    second = near.groupBy(*by, "_d", "number", "letter").agg(F.min("event_id").alias("event_id"))
    marks = first.unionByName(second)
    named = marks.groupBy(*by, "event_id").agg(F.array_sort(F.collect_list(F.struct("_d", "number", "letter"))).alias("_c"))
    return named.select(*by, "event_id", corner_label(F.col("_c")).alias("corners"))


def detect_events(traces: DataFrame, corners: DataFrame | None = None, params: EventParams = EventParams(), by: Sequence[str] = SESSION, spacing: float = GRID_M) -> DataFrame:
    """The event table of every session; a session without a trough has no rows."""
    missing = [c for c in ("speed", "brake", "throttle") if c not in traces.columns]
    if missing:
        raise ValueError(f"traces are missing {missing}")
    raw = raw_events(traces, params, by)
    metres = lambda c: F.pmod(F.col(c), F.col("n")) * F.lit(float(spacing))
    out = raw
    if corners is not None:
        out = raw.join(label_events(raw, corners, params, by, spacing), [*by, "event_id"], "left")
    else:
        out = raw.withColumn("corners", F.lit(None).cast("string"))
    return out.select(
        *by, "event_id", metres("i").alias("apex_m"), F.col("v").alias("v_min_kmh"), F.col("prominence").alias("prominence_kmh"),
        metres("left_max").alias("left_max_m"), metres("lift").alias("lift_m"), metres("brake_on").alias("brake_on_m"),
        metres("brake_off").alias("brake_off_m"), metres("a0").alias("apex_start_m"), metres("a1").alias("apex_end_m"),
        metres("exit_end").alias("exit_end_m"), F.col("brake_on").isNotNull().alias("has_braking"), "corners",
        (F.col("prominence") < params.marginal_factor * params.min_prominence_kmh).alias("marginal"),
    )


def corner_event_ids(corners: DataFrame, events: DataFrame, by: Sequence[str] = SESSION) -> DataFrame:
    """The first event naming each corner, null for the others."""
    named = events.select(*by, "event_id", F.explode(parse_corner_label("corners")).alias("number"))
    first = named.groupBy(*by, "number").agg(F.min("event_id").alias("event_id"))
    return corners.join(first, [*by, "number"], "left")


# ---------------------------------------------------------------- micro-sectors

def event_intervals(events: DataFrame, lengths: DataFrame, by: Sequence[str] = SESSION) -> DataFrame:
    """Non-empty phase intervals of every event, unwrapped around its apex."""
    e = events.join(lengths, list(by))
    length, apex = F.col("lap_length_m"), F.col("apex_m")

    def near(c: str) -> Column:
        x = F.col(c)
        return F.when(x - apex > length / 2, x - length).when(apex - x > length / 2, x + length).otherwise(x)

    a0, a1, off = near("apex_start_m"), near("apex_end_m"), near("brake_off_m")
    phase = lambda name, s, t: F.struct(F.lit(name).alias("phase"), s.alias("s"), t.alias("e"))
    braked = F.array(phase("braking", near("brake_on_m"), F.least(off, a0)), phase("entry", off, a0))
    lifted = F.array(phase("entry", near("lift_m"), a0))
    rest = F.array(phase("apex", a0, a1), phase("exit", a1, near("exit_end_m")))
    all_phases = F.concat(F.when(flag("has_braking"), braked).otherwise(lifted), rest)
    return e.select(*by, "event_id", "corners", "marginal", "lap_length_m", F.inline(all_phases)).filter(F.col("e") > F.col("s"))


def split_at_line(intervals: DataFrame) -> DataFrame:
    """Cut unwrapped intervals at the start line: start_m and end_m lie on one lap."""
    s, e, length = F.col("s"), F.col("e"), F.col("lap_length_m")
    piece = lambda a, b: F.struct(a.cast("double").alias("start_m"), b.cast("double").alias("end_m"))
    zero = F.lit(0.0)
    pieces = (
        F.when(s < 0, F.array(piece(s + length, F.least(e, zero) + length), piece(zero, e)))
        .when(e > length, F.array(piece(s, length), piece(zero, e - length)))
        .otherwise(F.array(piece(s, e)))
    )
    rest = [c for c in intervals.columns if c not in ("s", "e")]
    return intervals.select(*rest, F.inline(pieces)).filter(F.col("end_m") > F.col("start_m"))


def phase_overlaps(events: DataFrame, lengths: DataFrame, by: Sequence[str] = SESSION) -> DataFrame:
    """Sessions whose event phases overlap, which therefore have no partition, with the reason."""
    order = Window.partitionBy(*by).orderBy("start_m", "end_m")
    rows = split_at_line(event_intervals(events, lengths, by)).withColumn("_before", F.lag("end_m").over(order))
    bad = rows.filter(F.col("start_m") < F.col("_before") - 1e-6).groupBy(*by).agg(F.min("start_m").alias("_at"))
    return bad.select(*by, F.format_string("phases overlap at %.0f m", "_at").alias("reason"))


def corner_phases(events: DataFrame, lengths: DataFrame, by: Sequence[str] = SESSION, spacing: float = GRID_M) -> DataFrame:
    """Event phases with straights between them; overlapping phases are an error."""
    by = list(by)
    rows = split_at_line(event_intervals(events, lengths, by))
    order = Window.partitionBy(*by).orderBy("start_m")
    rows = rows.withColumn("_before", F.lag("end_m").over(order))
    overlap = F.col("start_m") < F.col("_before") - 1e-6
    start = F.when(overlap, F.raise_error(F.concat(F.lit("phases overlap at "), F.col("start_m").cast("string"), F.lit(" m"))).cast("double")).otherwise(F.col("start_m"))
    rows = rows.withColumn("start_m", start)
    cols = [*by, "phase", "event_id", "start_m", "end_m", "corners", "marginal"]

    def straight(df: DataFrame, s: Column, e: Column) -> DataFrame:
        return df.filter(e > s + 1e-6).select(
            *by, F.lit("straight").alias("phase"), F.lit(None).cast("int").alias("event_id"), s.alias("start_m"), e.alias("end_m"),
            F.lit(None).cast("string").alias("corners"), F.lit(False).alias("marginal"),
        )

    gaps = straight(rows, F.coalesce(F.col("_before"), F.lit(0.0)), F.col("start_m"))
    ends = lengths.join(rows.groupBy(*by).agg(F.max("end_m").alias("_last")), by, "left")
    tail = straight(ends, F.coalesce(F.col("_last"), F.lit(0.0)), F.col("lap_length_m"))
    return finish(rows.select(*cols).unionByName(gaps).unionByName(tail), GRAIN_PHASE, by, spacing)


def fixed_bins(lengths: DataFrame, bin_m: float = FIXED_BIN_M, by: Sequence[str] = SESSION, spacing: float = GRID_M) -> DataFrame:
    """Bins of one length from zero, the last one cut at the lap's end."""
    if bin_m <= 0:
        raise ValueError("bin size must be positive")
    length = F.col("lap_length_m")
    count = F.ceil(length / F.lit(bin_m) - 1e-9).cast("int")
    rows = lengths.filter(length > 0).withColumn("_i", F.explode(F.sequence(F.lit(0), count - 1)))
    rows = rows.select(
        *by, F.lit("bin").alias("phase"), F.lit(None).cast("int").alias("event_id"), (F.col("_i") * F.lit(bin_m)).alias("start_m"),
        F.least((F.col("_i") + 1) * F.lit(bin_m), length).alias("end_m"), F.lit(None).cast("string").alias("corners"), F.lit(False).alias("marginal"),
    )
    return finish(rows, GRAIN_BINS, by, spacing)


def finish(rows: DataFrame, grain: str, by: Sequence[str] = SESSION, spacing: float = GRID_M) -> DataFrame:
    """Grain, running id and index bounds."""
    order = Window.partitionBy(*by).orderBy("start_m")
    index = lambda c: F.rint(F.col(c) / F.lit(spacing)).cast("int")
    return rows.select(
        *by, F.lit(grain).alias("grain"), (F.row_number().over(order) - 1).alias("microsector_id"), "phase", "event_id", "start_m", "end_m",
        index("start_m").alias("start_index"), index("end_m").alias("end_index"), "corners", "marginal",
    )


def microsectors(events: DataFrame, lengths: DataFrame, by: Sequence[str] = SESSION, spacing: float = GRID_M) -> DataFrame:
    """Both grains; each covers the lap exactly."""
    return corner_phases(events, lengths, by, spacing).unionByName(fixed_bins(lengths, FIXED_BIN_M, by, spacing))


def check_partition(sectors: DataFrame, lengths: DataFrame, by: Sequence[str] = SESSION, spacing: float = GRID_M) -> DataFrame:
    """Per grain: does it cover [0, L) without gap or overlap, every sector at least one grid step?"""
    key = [*by, "grain"]
    order = Window.partitionBy(*key).orderBy("microsector_id")
    rows = sectors.withColumn("_before", F.lag("end_m").over(order))
    close = lambda a, b: F.abs(a - b) <= 1e-8 + 1e-5 * F.abs(b)
    checks = rows.groupBy(*key).agg(
        F.min_by("start_m", "microsector_id").alias("_open"), F.max_by("end_m", "microsector_id").alias("_close"), F.count(F.lit(1)).alias("sectors"),
        F.bool_and(F.col("_before").isNull() | close(F.col("start_m"), F.col("_before"))).alias("_joined"),
        F.bool_and(F.col("end_m") - F.col("start_m") >= spacing - 1e-6).alias("_long"),
    )
    ok = close(F.col("_open"), F.lit(0.0)) & close(F.col("_close"), F.col("lap_length_m")) & F.col("_joined") & F.col("_long")
    return checks.join(lengths, list(by)).select(*key, "sectors", ok.alias("partition_ok"))


# ---------------------------------------------------------------- per-lap readings

def _window_points(grid: DataFrame, windows: DataFrame, member: Column, cols: Sequence[str], spacing: float) -> DataFrame:
    """Grid rows inside each event's window, met by grid index so that no session is one task."""
    tops = grid.groupBy(*SESSION).agg(F.max("grid_index").alias("_top"))
    cells = windows.join(tops, list(SESSION)).withColumn("grid_index", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_top").cast("long"))))
    # written, so that Spark sees how small they are and leaves the grid where it lies
    cells = cut(cells.withColumn("_d", F.col("grid_index") * F.lit(float(spacing))).filter(member).drop("_top", "_d"), "window-cells")
    points = grid.select(*LAP, F.col("grid_index").cast("long").alias("grid_index"), F.col("distance_m").cast("double").alias("d"), *cols)
    return points.join(cells, [*SESSION, "grid_index"])


def per_lap_apex(grid: DataFrame, events: DataFrame, lengths: DataFrame, spacing: float = GRID_M) -> DataFrame:
    """Each lap's slowest point in every event window, as a signed distance from the session's apex."""
    w = events.join(lengths, list(SESSION)).select(*SESSION, "event_id", "apex_m", "apex_start_m", "apex_end_m", "lap_length_m")
    inside = in_half_open_window(F.col("_d"), F.col("apex_start_m") - APEX_WINDOW_MARGIN_M, F.col("apex_end_m") + APEX_WINDOW_MARGIN_M, F.col("lap_length_m"))
    hit = _window_points(grid, w, inside, ["speed"], spacing).filter(F.col("speed").isNotNull())
    best = hit.groupBy(*LAP, "event_id").agg(F.min(F.struct("speed", "d", "apex_m", "lap_length_m")).alias("_m"))
    return best.select(
        *LAP, "event_id", circular_gap(F.col("_m")["d"], F.col("_m")["apex_m"], F.col("_m")["lap_length_m"]).alias("apex_dev_m"), F.col("_m")["speed"].alias("v_min_kmh")
    )


def per_lap_brake(grid: DataFrame, events: DataFrame, lengths: DataFrame, spacing: float = GRID_M) -> DataFrame:
    """Each lap's first brake in every braked event's window; null where it has none."""
    w = events.filter(flag("has_braking")).join(lengths, list(SESSION)).select(*SESSION, "event_id", "brake_on_m", "apex_start_m", "lap_length_m")
    inside = in_half_open_window(F.col("_d"), F.col("brake_on_m") - BRAKE_LOOKBACK_M, F.col("apex_start_m"), F.col("lap_length_m"))
    hit = _window_points(grid.filter(flag("brake")), w, inside, [], spacing)
    first = hit.groupBy(*LAP, "event_id").agg(F.min(F.struct("d", "brake_on_m", "lap_length_m")).alias("_m"))
    dev = circular_gap(F.col("_m")["d"], F.col("_m")["brake_on_m"], F.col("_m")["lap_length_m"])
    laps = grid.select(*LAP).distinct().join(w.select(*SESSION, "event_id"), list(SESSION))
    return laps.join(first.select(*LAP, "event_id", dev.alias("brake_dev_m")), [*LAP, "event_id"], "left")


def corner_metrics(grid: DataFrame, events: DataFrame, lengths: DataFrame, spacing: float = GRID_M) -> DataFrame:
    """Per lap and event: minimum speed, braking point and the sample gap at that point."""
    apex, brake = per_lap_apex(grid, events, lengths, spacing), per_lap_brake(grid, events, lengths, spacing)
    e = events.join(lengths, list(SESSION)).select(
        *SESSION, "event_id", "corners", "marginal", F.col("apex_m").alias("_am"), F.col("brake_on_m").alias("_bm"), "lap_length_m"
    )
    out = apex.join(brake, [*LAP, "event_id"], "left").join(e, [*SESSION, "event_id"])
    out = out.withColumn("v_min_m", F.pmod(F.col("_am") + F.col("apex_dev_m"), F.col("lap_length_m")))
    out = out.withColumn("brake_on_m", F.pmod(F.col("_bm") + F.col("brake_dev_m"), F.col("lap_length_m")))
    out = cut(out.withColumn("grid_index", F.rint(F.col("brake_on_m") / F.lit(spacing)).cast("long")), "corner-readings")
    gap = asked_points(grid, out, "grid_index").select(*LAP, F.col("grid_index").cast("long").alias("grid_index"), F.col("source_gap_m").alias("brake_gap_m"))
    return out.join(gap, [*LAP, "grid_index"], "left").select(
        *LAP, "event_id", "corners", "marginal", "v_min_kmh", "v_min_m", "apex_dev_m", "brake_on_m", "brake_dev_m", "brake_gap_m"
    )


# ---------------------------------------------------------------- acceptance

def half_samples(laps: DataFrame, trials: int = 10, seed: int = 0, by: Sequence[str] = SESSION) -> DataFrame:
    """For each trial, half of each session's laps: those with the lowest hash of (seed, trial, lap).

    Ranks are counted per hash bucket, so no task orders a whole session.
    """
    key = [*by, "trial"]
    rows = laps.select(*by, "driver", "lap_number").distinct().withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1))))
    h = F.xxhash64(F.lit(seed), "trial", F.col("driver").cast("string"), F.col("lap_number").cast("long"))
    rows = rows.withColumn("_h", h).withColumn("_b", F.pmod(F.shiftright(h, 16), F.lit(256)))
    sizes = rows.groupBy(*key, "_b").agg(F.count(F.lit(1)).alias("_n"))
    below = Window.partitionBy(*key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(below), F.lit(0))).withColumn("_all", F.sum("_n").over(Window.partitionBy(*key)))
    place = Window.partitionBy(*key, "_b").orderBy("_h", "driver", "lap_number")
    ranked = rows.withColumn("_r", F.row_number().over(place)).join(sizes, [*key, "_b"])
    want = F.greatest(F.lit(1), F.floor(F.col("_all") / 2))
    return ranked.filter(F.col("_off") + F.col("_r") <= want).select(*key, "driver", "lap_number")


def jackknife(grid: DataFrame, events: DataFrame, params: EventParams = EventParams(), trials: int = 10, seed: int = 0, spacing: float = GRID_M) -> DataFrame:
    """Events found again on half-sessions: the shift of apex, brake-on and exit against the whole session.

    A trial that finds another number of events is one row without shifts. A lap
    moves once with the list of its trials, and what the trials find is written, as it is read twice.
    """
    by = [*SESSION, "trial"]
    picked = cut(half_samples(grid, trials, seed), "half-samples")
    of_lap = picked.groupBy(*LAP).agg(F.collect_list("trial").alias("_trials"))
    chosen = cut(grid.select(*LAP, "grid_index", "speed", "throttle", "brake").join(of_lap, list(LAP)), "half-laps")
    half = chosen.withColumn("trial", F.explode("_trials")).drop("_trials")
    found = cut(detect_events(median_traces(half, by=by, spacing=spacing), None, params, by, spacing), "half-events")
    counts = found.groupBy(*by).agg(F.count(F.lit(1)).alias("_f"))
    full = events.groupBy(*SESSION).agg(F.count(F.lit(1)).alias("_w"))
    verdict = picked.select(*by).distinct().join(counts, by, "left").join(full, list(SESSION), "left")
    verdict = verdict.withColumn("count_match", F.coalesce("_f", F.lit(0)) == F.coalesce("_w", F.lit(0))).drop("_f", "_w")
    base = events.select(*SESSION, "event_id", *[F.col(c).alias(f"_{c}") for c in ("apex_m", "brake_on_m", "exit_end_m")])
    both = verdict.filter("count_match").join(found, by).join(base, [*SESSION, "event_id"])
    shift = lambda c: (F.col(c) - F.col(f"_{c}")).alias(c.replace("_m", "_shift_m"))
    rows = both.select(*by, "event_id", "count_match", shift("apex_m"), shift("brake_on_m"), shift("exit_end_m"))
    return rows.unionByName(verdict.filter("NOT count_match"), allowMissingColumns=True)


def acceptance(grid: DataFrame, corners: DataFrame, events: DataFrame, sectors: DataFrame, lengths: DataFrame, trials: int = 10, spacing: float = GRID_M) -> DataFrame:
    """One row per session with every check of the segmentation and its figures."""
    from functools import reduce

    from trackgrid.operators.metrics import spread, spreads

    keys = list(SESSION)
    apex, brake = per_lap_apex(grid, events, lengths, spacing), per_lap_brake(grid, events, lengths, spacing)
    jack = jackknife(grid, events, trials=trials, spacing=spacing)
    match = jack.groupBy(*keys, "trial").agg(F.bool_and("count_match").alias("_m")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("jackknife_trials"), F.count_if("_m").alias("jackknife_matches")
    )
    good = jack.filter("count_match")
    parts = check_partition(sectors, lengths, SESSION, spacing).join(lengths, keys)
    bins = F.col("grain") == GRAIN_BINS
    parts = parts.groupBy(*keys).agg(
        F.bool_or(~bins & F.col("partition_ok")).alias("partition_ok"),
        F.bool_or(bins & F.col("partition_ok") & (F.col("sectors") == F.ceil(F.col("lap_length_m") / FIXED_BIN_M - 1e-9))).alias("fixed_bins_ok"),
        F.max(F.when(bins, F.col("sectors"))).alias("fixed_bins"),
    )
    named = events.select(*keys, F.explode(parse_corner_label("corners")).alias("number")).distinct()
    loose = corners.join(named, [*keys, "number"], "left_anti").groupBy(*keys).agg(F.count(F.lit(1)).alias("corners_without_event"))
    std_all = apex.groupBy(*keys, "event_id").agg(F.coalesce(F.stddev_samp("v_min_kmh"), F.lit(0.0)).alias("std"))
    own = apex.groupBy(*keys, "driver", "event_id").agg(F.stddev_samp("v_min_kmh").alias("_s"))
    within = exact_median(own, [*keys, "event_id"], "_s", "std")
    by_event = lambda df, name: df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("event_id", "std"))).alias(name))
    tables = [
        events.groupBy(*keys).agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("corners").isNull()).alias("events_without_corners")),
        parts, spread(apex, "apex_dev_m", "apex"), spread(brake, "brake_dev_m", "brake"), match,
        spreads(good, {f"{c}_shift": f"{c}_shift_m" for c in ("apex", "brake_on", "exit_end")}),
        corners.groupBy(*keys).agg(F.max("line_offset_m").alias("corner_offset_max_m")), loose,
        by_event(std_all, "v_min_std_all"), by_event(within, "v_min_std_within"),
    ]
    out = reduce(lambda a, b: a.join(b, keys, "left"), tables, lengths)
    low = lambda p, limit: (F.coalesce(F.col(f"{p}_n"), F.lit(0)) == 0) | (F.col(f"{p}_p95") <= limit)
    checks = {
        "apex_ok": F.col("apex_p95") <= APEX_DEV_P95_M,
        "brake_ok": low("brake", BRAKE_DEV_P95_M),
        "jackknife_ok": (F.col("jackknife_matches") == F.col("jackknife_trials"))
        & low("apex_shift", JACKKNIFE_SHIFT_P95_M) & low("brake_on_shift", JACKKNIFE_SHIFT_P95_M) & low("exit_end_shift", JACKKNIFE_SHIFT_P95_M),
        "corners_ok": (F.col("corner_offset_max_m") <= CORNER_OFFSET_MAX_M) & (F.col("events_without_corners") == 0),
    }
    out = out.withColumn("corners_without_event", F.coalesce("corners_without_event", F.lit(0)))
    out = out.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in checks.items()})
    return out.withColumn("ok", reduce(lambda a, b: a & b, [F.coalesce(F.col(c), F.lit(False)) for c in ("partition_ok", "fixed_bins_ok", *checks)]))
