"""Lap and sector times rebuilt from the grid and held against official timing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackgrid.functions.columns import clean, flag, lap_label, lerp
from trackgrid.functions.quantiles import exact_median, exact_percentiles, medians, percentiles
from trackgrid.keys import GRID_M, KMH_PER_MS, LAP, SESSION
from trackgrid.operators.metrics import spreads
from trackgrid.operators.series import TIME, raw_distance_at, time_at_distance
from trackgrid.operators.spatial import OFFICIAL_BAND_PCT
from trackgrid.session import cut

# Validation thresholds.
ANCHOR_MARGIN_M = 20.0
LAP_STD_MAX_S = 0.12
LAP_P95_MAX_S = 0.20
CLOSURE_P95_MAX_S = 0.35
SECTOR_MEDIAN_MAX_S = 0.03
ANOMALY_FRACTION_MAX = 0.10
LINE_POSITION_STD_MAX_M = 8.0
DISTANCE_STD_MAX_PCT = 0.25
V_MIN_STD_MEDIAN_MAX_KMH = 4.5
V_MIN_STD_P95_MAX_KMH = 10.0
COVERAGE_SLACK_S = 0.25
ANOMALY_S = 0.30
CANCEL_FRACTION = 0.5
PUSH_FRACTION = 1.07
MIN_STABILITY_LAPS = 3
SECTORS = ("s1", "s2", "s3")


# ---------------------------------------------------------------- timing line

def line_crossings(aligned: DataFrame, laps: DataFrame, line: DataFrame, margin: float = ANCHOR_MARGIN_M, axis=TIME) -> DataFrame:
    """Where each lap crosses the timing line at its start and end, on the aligned axis.

    ``line`` has line_length_m per session. A lap without official times, with
    fewer than two samples or none safely inside the line has no row.
    """
    t = axis.order
    timed = laps.filter(F.col("lap_start_time").isNotNull() & F.col("lap_time").isNotNull()).select(
        *LAP, F.col("lap_start_time").alias("_ts"), (F.col("lap_start_time") + F.col("lap_time")).alias("_te")
    )
    tagged = aligned.join(line.select(*SESSION, "line_length_m"), list(SESSION))
    d = F.col("distance_aligned")
    inside = d.between(F.lit(margin), F.col("line_length_m") - margin)
    body = F.struct(F.col(t).alias("t"), d.alias("d"), F.col("distance_raw").alias("r"), F.col("speed").cast("double").alias("v"))
    place = F.struct(d.alias("d"), F.col(t).alias("t"))
    stats = tagged.groupBy(*LAP).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.when(inside, body)).alias("_in"), F.max(F.when(inside, body)).alias("_out"),
        F.min(body).alias("_first"), F.max(body).alias("_last"), F.max(F.when(d <= 0, place)).alias("_z0"), F.min(F.when(d > 0, place)).alias("_z1"),
    ).filter((F.col("_n") >= 2) & F.col("_in").isNotNull())
    asks = timed.select(*LAP, F.inline(F.array(F.struct(F.lit("start").alias("which"), F.col("_ts").alias("at_s")), F.struct(F.lit("end").alias("which"), F.col("_te").alias("at_s")))))
    raw = raw_distance_at(aligned, asks, axis)
    pick = lambda w, c: F.max(F.when(F.col("which") == w, F.col(c)))
    ends = raw.groupBy(*LAP).agg(
        pick("start", "raw_m").alias("_rs"), pick("end", "raw_m").alias("_re"), pick("start", "extrapolated").alias("start_extrapolated"), pick("end", "extrapolated").alias("end_extrapolated")
    )
    out = stats.join(timed, list(LAP)).join(ends, list(LAP))
    z0, z1 = F.col("_z0"), F.col("_z1")
    zero = F.when(z0["d"] == 0, z0["t"]).otherwise(lerp(F.lit(0.0), z0["d"], z0["t"], z1["d"], z1["t"]))
    covered = (F.col("_first")["d"] <= 0) & (F.col("_last")["d"] >= 0)
    out = out.withColumn("t_zero_s", F.when(covered, zero))
    return out.select(
        *LAP,
        (F.col("_in")["d"] - (F.col("_in")["r"] - F.col("_rs"))).alias("line_start_m"),
        (F.col("_out")["d"] + (F.col("_re") - F.col("_out")["r"])).alias("line_end_m"),
        (F.col("_first")["t"] - F.col("_ts")).alias("window_open_s"),
        (F.col("_last")["t"] - F.col("_te")).alias("window_close_s"),
        (F.col("_re") - F.col("_rs")).alias("driven_m"),
        "start_extrapolated", "end_extrapolated", "t_zero_s",
        F.col("_first")["d"].alias("first_sample_m"), F.col("_first")["t"].alias("first_sample_s"), F.col("_first")["v"].alias("first_sample_kmh"),
        (F.col("t_zero_s") - F.col("_ts")).alias("start_offset_s"),
    )


def line_positions(crossings: DataFrame) -> DataFrame:
    """Session line positions: medians of the laps' own."""
    both = medians(crossings, SESSION, {"d_start": "line_start_m", "d_end": "line_end_m"})
    return both.filter(F.col("d_start").isNotNull() & F.col("d_end").isNotNull())


def start_stretch(crossings: DataFrame, positions: DataFrame) -> DataFrame:
    """Seconds from the timing line to distance zero, read from the lap's own samples."""
    v = F.col("first_sample_kmh") / KMH_PER_MS
    v = F.when(v > 0, v)
    at_line = F.col("first_sample_s") - (F.col("first_sample_m") - F.col("d_start")) / v
    return crossings.join(positions, list(SESSION)).select(*LAP, (F.col("t_zero_s") - at_line).alias("start_stretch_s"))


# ---------------------------------------------------------------- reconstruction

def reconstruct_laps(curves: DataFrame, laps: DataFrame, positions: DataFrame, boundaries: DataFrame, stretch: DataFrame | None = None, spacing: float = GRID_M) -> DataFrame:
    """Lap and sector times from the grid between the line positions, with residuals.

    ``curves``: t_s and speed (km/h) per grid point. ``positions``: d_start, d_end.
    ``boundaries``: s1_m, s2_m. The start comes from ``stretch`` where it is known.
    """
    speed = F.col("speed").cast("double") / KMH_PER_MS
    moving = curves.withColumn("speed_ms", F.when(speed > 0, speed))
    still = F.collect_set(F.when(F.col("speed_ms").isNull(), F.col("grid_index").cast("long")))
    n = cut(moving.groupBy(*LAP).agg(F.count(F.lit(1)).alias("n_points"), still.alias("_still")).filter("n_points >= 2"), "lap-points")
    stuck = n.filter(F.array_contains("_still", F.lit(0).cast("long")) | F.array_contains("_still", F.col("n_points") - 1)).select(*LAP)
    n = n.drop("_still")
    typical = cut(exact_median(moving.join(stuck, list(LAP), "left_semi"), LAP, "speed_ms", "_typical"), "typical-speeds")  # of few laps, if any
    filled = moving.join(typical, list(LAP), "left").withColumn("speed_ms", F.coalesce("speed_ms", "_typical", F.lit(1.0)))
    base = n.join(positions, list(SESSION)).join(boundaries, list(SESSION), "left")
    marks = F.array(*[F.struct(F.lit(k).alias("which"), F.col(c).alias("target_m")) for k, c in (("start", "d_start"), ("end", "d_end"), ("s1", "s1_m"), ("s2", "s2_m"))])
    asks = base.select(*LAP, F.inline(marks)).filter(F.col("target_m").isNotNull())
    at = time_at_distance(filled, asks, spacing)
    pick = lambda w: F.max(F.when(F.col("which") == w, F.col("at_time_s")))
    read = at.groupBy(*LAP).agg(*[pick(w).alias(f"_{w}") for w in ("start", "end", "s1", "s2")])
    out = base.join(read, list(LAP), "left")
    if stretch is not None:
        out = out.join(stretch, list(LAP), "left")
    else:
        out = out.withColumn("start_stretch_s", F.lit(None).cast("double"))
    official = laps.select(*LAP, F.col("lap_time").alias("lap_time_s"), *[F.col(f"sector{i}_time").alias(f"s{i}_official_s") for i in (1, 2, 3)])
    out = out.join(official, list(LAP), "left")
    t0 = F.coalesce(-clean("start_stretch_s"), F.col("_start"))
    last = (F.col("n_points") - 1) * F.lit(float(spacing))
    out = out.select(
        *LAP, (F.col("_end") - t0).alias("lap_grid_s"), (F.col("_s1") - t0).alias("s1_grid_s"), (F.col("_s2") - F.col("_s1")).alias("s2_grid_s"),
        (F.col("_end") - F.col("_s2")).alias("s3_grid_s"), "lap_time_s", "s1_official_s", "s2_official_s", "s3_official_s", "n_points",
        clean("start_stretch_s").isNotNull().alias("start_from_samples"), "start_stretch_s",
        F.greatest(F.lit(0.0), -F.col("d_start")).alias("start_extrap_m"), F.greatest(F.lit(0.0), F.col("d_end") - last).alias("end_extrap_m"),
    )
    out = out.withColumn("lap_residual_s", F.col("lap_grid_s") - F.col("lap_time_s"))
    return out.withColumns({f"{s}_residual_s": F.col(f"{s}_grid_s") - F.col(f"{s}_official_s") for s in SECTORS})


def closure_residuals(reconstructed: DataFrame, reference: DataFrame) -> DataFrame:
    """Grid difference to the reference lap minus the official one; null on a lap that is its own reference."""
    refs = reconstructed.select(*SESSION, F.col("driver").alias("ref_driver"), F.col("lap_number").alias("ref_lap"), F.col("lap_grid_s").alias("_rg"), F.col("lap_time_s").alias("_ro"))
    refs = refs.join(reference.select(*SESSION, "ref_driver", "ref_lap").distinct(), [*SESSION, "ref_driver", "ref_lap"], "left_semi")
    out = reconstructed.join(reference, list(LAP)).join(refs, [*SESSION, "ref_driver", "ref_lap"], "left")
    own = (F.col("driver") == F.col("ref_driver")) & (F.col("lap_number") == F.col("ref_lap"))
    residual = (F.col("lap_grid_s") - F.col("_rg")) - (F.col("lap_time_s") - F.col("_ro"))
    return out.withColumn("closure_residual_s", F.when(~own, residual)).withColumn("is_reference", own).drop("_rg", "_ro", "ref_driver", "ref_lap")


# ---------------------------------------------------------------- flags

def distance_excursion(pct: Column | str, band: tuple[float, float] = OFFICIAL_BAND_PCT) -> Column:
    v = F.col(pct) if isinstance(pct, str) else pct
    return F.coalesce((v < band[0]) | (v > band[1]), F.lit(False))


def sector_split_outlier() -> Column:
    """Two adjacent sector residuals that are large and cancel: the source split the lap elsewhere."""
    r = [F.col(f"{s}_residual_s") for s in SECTORS]
    cancels = lambda a, b: (F.abs(a) > ANOMALY_S) & (F.abs(a + b) < CANCEL_FRACTION * F.abs(a))
    pairs = [(r[0], r[1]), (r[1], r[0]), (r[1], r[2]), (r[2], r[1])]
    return reduce(lambda a, b: a | b, [F.coalesce(cancels(*p), F.lit(False)) for p in pairs])


def lap_outlier() -> Column:
    return F.coalesce(F.abs("lap_residual_s") > ANOMALY_S, F.lit(False))


def coverage_limits(table: DataFrame) -> DataFrame:
    """Per session: how late a window may open and how early it may close."""
    ends = percentiles(table, SESSION, {"open": ("window_open_s", {"_o": 0.95}), "close": ("window_close_s", {"_c": 0.05})})
    return ends.select(*SESSION, (F.col("_o") + COVERAGE_SLACK_S).alias("open_limit"), (F.col("_c") - COVERAGE_SLACK_S).alias("close_limit"))


def flag_laps(table: DataFrame) -> DataFrame:
    """Coverage, excursion and anomaly flags; flagged laps are reported, not gated on."""
    out = table.join(coverage_limits(table), list(SESSION), "left")
    return out.withColumns({
        "start_coverage_poor": F.coalesce(F.col("window_open_s") > F.col("open_limit"), F.lit(False)),
        "end_coverage_poor": F.coalesce(F.col("window_close_s") < F.col("close_limit"), F.lit(False)),
        "distance_excursion": distance_excursion("driven_pct_of_official"),
        "sector_split_outlier": sector_split_outlier(),
        "lap_outlier": lap_outlier(),
    }).drop("open_limit", "close_limit")


# ---------------------------------------------------------------- stability and registration

def push_laps(laps: DataFrame, factor: float = PUSH_FRACTION) -> DataFrame:
    """Laps within a factor of their driver's best in the session; a driver's best is one aggregate away."""
    timed = laps.filter(F.col("lap_time").isNotNull())
    best = timed.groupBy(*SESSION, "driver").agg(F.min("lap_time").alias("_best"))
    return timed.join(best, [*SESSION, "driver"]).filter(F.col("lap_time") <= F.lit(factor) * F.col("_best")).drop("_best")


def v_min_stability(corner_metrics: DataFrame, laps: DataFrame, min_laps: int = MIN_STABILITY_LAPS, factor: float = PUSH_FRACTION) -> DataFrame:
    """Spread of the minimum speed per driver, compound and event over push laps; no compound is a group too."""
    tyres = push_laps(laps, factor).select(*LAP, "compound")
    joined = corner_metrics.join(tyres, list(LAP))
    return (
        joined.groupBy(*SESSION, "driver", "compound", "event_id")
        .agg(F.first("corners", ignorenulls=True).alias("corners"), F.count(F.lit(1)).alias("n_laps"), F.avg("v_min_kmh").alias("v_min_mean_kmh"), F.stddev_samp("v_min_kmh").alias("v_min_std_kmh"))
        .filter(F.col("n_laps") >= min_laps)
    )


def sector_registration(grid: DataFrame, sector_std: DataFrame, boundaries: DataFrame, spacing: float = GRID_M) -> DataFrame:
    """Sector spreads as metres per line crossing, from the median speeds around the boundaries.

    ``sector_std``: s1, s2, s3 in seconds per session.
    """
    index = lambda c: F.rint(F.greatest(c, F.lit(0.0)) / F.lit(spacing)).cast("long")
    spots = boundaries.select(*SESSION, F.inline(F.array(
        F.struct(F.lit("line").alias("at"), index(F.lit(0.0)).alias("_i")), F.struct(F.lit("s1").alias("at"), index(F.col("s1_m")).alias("_i")), F.struct(F.lit("s2").alias("at"), index(F.col("s2_m")).alias("_i"))
    )))
    around = spots.select(*SESSION, "at", F.explode(F.sequence(F.col("_i") - 2, F.col("_i") + 2)).alias("grid_index"))
    points = grid.select(*SESSION, F.col("grid_index").cast("long").alias("grid_index"), "speed").join(around.select(*SESSION, "grid_index").distinct(), [*SESSION, "grid_index"], "left_semi")
    med = exact_median(points, [*SESSION, "grid_index"], "speed", "_m", few=True)
    speed = around.join(med, [*SESSION, "grid_index"]).groupBy(*SESSION, "at").agg((F.percentile("_m", F.lit(0.5)) / KMH_PER_MS).alias("v"))
    pick = lambda w: F.max(F.when(F.col("at") == w, F.col("v")))
    v = speed.groupBy(*SESSION).agg(pick("line").alias("_l"), pick("s1").alias("_1"), pick("s2").alias("_2"))
    both = sector_std.join(v, list(SESSION), "left")

    def metres(std: str, a: str, b: str) -> Column:
        x, y = F.col(a), F.col(b)
        return F.when((x > 0) & (y > 0), F.col(std) / F.sqrt(1.0 / (x * x) + 1.0 / (y * y)))

    return both.select(*SESSION, metres("s1", "_l", "_1").alias("s1_m"), metres("s2", "_1", "_2").alias("s2_m"), metres("s3", "_2", "_l").alias("s3_m"))


# ---------------------------------------------------------------- the whole validation

GROUND_TRUTH = (
    "compound", "lap_time_s", "lap_grid_s", "lap_residual_s", "s1_residual_s", "s2_residual_s", "s3_residual_s", "closure_residual_s",
    "driven_m", "driven_pct_of_official", "line_start_m", "line_end_m", "window_open_s", "window_close_s", "start_extrap_m", "end_extrap_m",
    "start_coverage_poor", "end_coverage_poor", "distance_excursion", "is_reference", "start_offset_s", "start_stretch_s", "start_from_samples",
    "sector_split_outlier", "lap_outlier",
)


def ground_truth(curves: DataFrame, laps: DataFrame, crossings: DataFrame, reference: DataFrame, boundaries: DataFrame, official: DataFrame, spacing: float = GRID_M) -> DataFrame:
    """One row per lap on the grid: rebuilt times, residuals and flags. ``official`` has official_m per session."""
    # each of these tables has a row per session or lap and is read several times below
    positions = cut(line_positions(crossings), "line-positions")
    rebuilt = cut(reconstruct_laps(curves, laps, positions, boundaries, start_stretch(crossings, positions), spacing), "rebuilt-laps")
    table = closure_residuals(rebuilt, reference).join(crossings.drop("start_extrapolated", "end_extrapolated"), list(LAP), "left")
    table = table.join(laps.select(*LAP, "compound"), list(LAP), "left").join(official.select(*SESSION, "official_m"), list(SESSION), "left")
    table = table.withColumn("driven_pct_of_official", 100.0 * (F.col("driven_m") - F.col("official_m")) / F.col("official_m"))
    return flag_laps(cut(table, "residuals")).select(*LAP, *GROUND_TRUTH)


def residual_spread(truth: DataFrame) -> DataFrame:
    """Per session the spread of each sector's residual over its undisturbed laps, as sector_registration reads it."""
    disturbed = flag("start_coverage_poor") | flag("end_coverage_poor") | F.col("distance_excursion") | F.col("sector_split_outlier") | F.col("lap_outlier")
    return truth.filter(~disturbed).groupBy(*SESSION).agg(*[F.stddev_samp(f"{s}_residual_s").alias(s) for s in SECTORS])


def report(truth: DataFrame, crossings: DataFrame, stability: DataFrame, laps: DataFrame, registration: DataFrame | None = None, official: DataFrame | None = None) -> DataFrame:
    """One row per session: gated statistics, the seven checks and the verdict."""
    keys = list(SESSION)
    anomaly = F.col("sector_split_outlier") | F.col("lap_outlier")
    coverage = flag("start_coverage_poor") | flag("end_coverage_poor")
    t = truth.withColumn("_anomaly", anomaly).withColumn("_coverage", coverage)
    gated = t.filter(~(F.col("_coverage") | F.col("distance_excursion") | F.col("_anomaly")))
    counts = t.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("laps"), F.count_if("_coverage").alias("flagged"), F.count_if("distance_excursion").alias("excursions"),
        F.count_if("_anomaly").alias("anomalies"), F.count_if(flag("start_from_samples")).alias("laps_from_samples"),
        F.max("start_extrap_m").alias("start_extrap_max_m"), F.max("end_extrap_m").alias("end_extrap_max_m"),
    ).withColumn("anomaly_fraction", F.col("anomalies") / F.col("laps"))
    stats = gated.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("laps_gated"), F.coalesce(F.stddev_samp("lap_residual_s"), F.lit(0.0)).alias("lap_residual_std_s"),
        *[F.stddev_samp(f"{s}_residual_s").alias(f"{s}_std_s") for s in SECTORS], F.stddev_samp("driven_m").alias("driven_std_m"),
        F.min("driven_pct_of_official").alias("driven_pct_min"), F.max("driven_pct_of_official").alias("driven_pct_max"),
        F.max(F.when(flag("is_reference"), F.col("lap_residual_s"))).alias("_ref"), F.coalesce(F.bool_or(flag("is_reference")), F.lit(False)).alias("_has_ref"),
    )
    line = crossings.groupBy(*keys).agg(F.stddev_samp("line_start_m").alias("line_start_std_m"), F.stddev_samp("line_end_m").alias("line_end_std_m"))
    half = {f"{s}_median_s": f"{s}_residual_s" for s in SECTORS} | {"lap_residual_median_s": "lap_residual_s", "driven_median_m": "driven_m"}
    ranks = [spreads(gated, {"lap_residual": "lap_residual_s", "closure": "closure_residual_s"}, keys, half)]
    ranks.append(medians(crossings, keys, {"d_start": "line_start_m", "d_end": "line_end_m", "window_open_median_s": "window_open_s", "window_close_median_s": "window_close_s"}))
    steady = exact_percentiles(stability, keys, "v_min_std_kmh", {"v_min_std_median_kmh": 0.5, "v_min_std_p95_kmh": 0.95}).drop("n")
    groups = stability.groupBy(*keys).agg(F.count(F.lit(1)).alias("v_min_groups"))
    pushes = push_laps(laps).groupBy(*keys).agg(F.count(F.lit(1)).alias("push_laps"))
    parts = [stats, line, *ranks, steady, groups, pushes]
    if registration is not None:
        parts.append(registration.select(*keys, *[F.col(f"{s}_m").alias(f"{s}_registration_m") for s in SECTORS]))
    if official is not None:
        parts.append(official.select(*keys, "official_m"))
    out = reduce(lambda a, b: a.join(b, keys, "left"), parts, counts)
    if official is None:
        out = out.withColumn("official_m", F.lit(None).cast("double"))
    out = out.withColumn("driven_std_pct", 100.0 * F.col("driven_std_m") / F.col("official_m"))
    out = out.withColumn("driven_pct_of_official", 100.0 * (F.col("driven_median_m") - F.col("official_m")) / F.col("official_m"))
    out = out.withColumn("reference_flagged", ~F.coalesce("_has_ref", F.lit(False))).withColumn("reference_offset_s", F.col("_ref") - F.col("lap_residual_median_s")).drop("_ref", "_has_ref")
    low, high = OFFICIAL_BAND_PCT
    checks = {
        "lap_ok": (F.col("lap_residual_std_s") <= LAP_STD_MAX_S) & (F.col("lap_residual_p95") <= LAP_P95_MAX_S),
        "closure_ok": (F.col("closure_p95") <= CLOSURE_P95_MAX_S) & (F.col("reference_flagged") | (F.abs("reference_offset_s") <= LAP_P95_MAX_S)),
        "sectors_ok": reduce(lambda a, b: a & b, [(F.abs(f"{s}_median_s") <= SECTOR_MEDIAN_MAX_S) & (F.col(f"{s}_std_s") <= LAP_STD_MAX_S) for s in SECTORS]),
        "distance_ok": (F.col("driven_std_pct") <= DISTANCE_STD_MAX_PCT) & (F.col("driven_pct_min") >= low) & (F.col("driven_pct_max") <= high),
        "stability_ok": (F.coalesce(F.col("v_min_groups"), F.lit(0)) == 0) | ((F.col("v_min_std_median_kmh") <= V_MIN_STD_MEDIAN_MAX_KMH) & (F.col("v_min_std_p95_kmh") <= V_MIN_STD_P95_MAX_KMH)),
        "line_ok": (F.col("line_start_std_m") <= LINE_POSITION_STD_MAX_M) & (F.col("line_end_std_m") <= LINE_POSITION_STD_MAX_M),
        "anomaly_ok": F.col("anomaly_fraction") <= ANOMALY_FRACTION_MAX,
    }
    out = out.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in checks.items()})
    return out.withColumn("ok", reduce(lambda a, b: a & b, [F.col(c) for c in checks]))


def by_circuit(season: DataFrame, circuit: str = "circuit") -> DataFrame:
    """Per circuit: sessions, how many pass, and the medians of their figures, widest residuals first."""
    counts = season.groupBy(circuit).agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if(flag("ok")).alias("passing"), F.sum("laps").alias("laps"),
        F.max("line_start_std_m").alias("line_start_std_m"),
    ).withColumn("all_sessions_pass", F.col("passing") == F.col("sessions"))
    figures = ("lap_residual_median_s", "lap_residual_std_s", "closure_p95", "driven_pct_of_official")
    med = medians(season, [circuit], {c: c for c in figures}).withColumnRenamed(circuit, "_k")
    counts = counts.join(med, F.col(circuit).eqNullSafe(F.col("_k")), "left").drop("_k")
    return counts.orderBy(F.col("lap_residual_std_s").desc_nulls_last(), F.col(circuit).asc_nulls_last())


def season_table(reports: DataFrame, sessions: DataFrame) -> DataFrame:
    """Session reports with their session's circuit and snapshot, in calendar order, unknown ones last."""
    known = sessions.select(*SESSION, F.col("location").alias("circuit"), "snapshot_date")
    return reports.join(known, list(SESSION), "left").orderBy(*[F.col(c).asc_nulls_last() for c in SESSION])
