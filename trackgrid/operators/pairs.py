"""Two laps taken apart: where the gap is, how sure it is, and what official timing says.

Pairs of laps are rows (session, pair, driver_a, lap_a, driver_b, lap_b); every
difference is B minus A. All pairs of a session are one plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackgrid.functions.columns import clean, flag, lap_label, quadrature
from trackgrid.functions.quantiles import exact_median
from trackgrid.keys import GRID_M, LAP, SESSION
from trackgrid.operators.metrics import quickest
from trackgrid.operators.segment import _window_points
from trackgrid.operators.series import boolean_runs

# Grain, braking window, significance and report bounds.
GRAIN = "corner_phase"
BRAKE_WINDOW_M = 20.0
SIGNIFICANT = 2.0
UNEXPLAINED_MAX_S = 0.005
QUICK_LAPS = 2
TRACE_PAD_M = 60.0

PAIR = (*SESSION, "pair")


def pair_label() -> Column:
    return F.concat(lap_label("driver_a", "lap_a"), F.lit(" vs "), lap_label("driver_b", "lap_b"))


def lap_pairs(lap_summary: DataFrame, duel: DataFrame, places: int | None = None) -> DataFrame:
    """Every timed lap of driver A with every timed lap of driver B, per session.

    ``duel``: session, driver_a, driver_b. The lap contract bounds a driver to 200
    laps, so a session has at most 200 x 200 pairs. ``places`` keeps each driver's quickest.
    """
    timed = quickest(lap_summary, places) if places else lap_summary.filter(F.col("lap_time_s").isNotNull())
    side = lambda s: timed.select(*SESSION, F.col("driver").alias(f"driver_{s}"), F.col("lap_number").alias(f"lap_{s}"), F.col("lap_time_s").alias(f"time_{s}")).join(
        duel.select(*SESSION, f"driver_{s}"), [*SESSION, f"driver_{s}"], "left_semi"
    )
    return side("a").join(side("b"), list(SESSION)).withColumn("pair", pair_label()).withColumn("gap_s", F.col("time_b") - F.col("time_a")).drop("time_a", "time_b")


def sector_frame(sectors: DataFrame, summary: DataFrame, grain: str = GRAIN) -> DataFrame:
    """Sector geometry with the noise of each sector."""
    geo = sectors.filter(F.col("grain") == grain).select(*SESSION, "microsector_id", "phase", "event_id", "corners", "start_m", "end_m", (F.col("end_m") - F.col("start_m")).alias("length_m"))
    noise = summary.filter(F.col("grain") == grain).select(*SESSION, "microsector_id", F.col("within_driver_std_s").alias("sigma_s"))
    return geo.join(noise, [*SESSION, "microsector_id"], "left")


def _ratio(delta: Column, sigma: Column) -> Column:
    return clean(F.try_divide(F.abs(delta), sigma))


def decompose(times: DataFrame, sectors: DataFrame, summary: DataFrame, pairs: DataFrame, grain: str = GRAIN) -> dict[str, DataFrame]:
    """Per pair: its sectors, and their sums per event, per phase and in total.

    A sector either lap did not complete is shown but counts in no sum.
    """
    t = times.filter(F.col("grain") == grain)
    side = lambda s: t.select(*SESSION, F.col("driver").alias(f"driver_{s}"), F.col("lap_number").alias(f"lap_{s}"), "microsector_id", F.col("time_s").alias(f"t_{s}"), F.coalesce(F.col("partial"), F.lit(True)).alias(f"p_{s}"))
    base = pairs.select(*PAIR, "driver_a", "lap_a", "driver_b", "lap_b").join(sector_frame(sectors, summary, grain), list(SESSION))
    rows = base.join(side("a"), [*SESSION, "driver_a", "lap_a", "microsector_id"], "left").join(side("b"), [*SESSION, "driver_b", "lap_b", "microsector_id"], "left")
    delta = F.col("t_b") - F.col("t_a")
    frame = rows.select(
        *PAIR, "microsector_id", "phase", "event_id", "corners", "start_m", "end_m", "length_m", "sigma_s", "t_a", "t_b",
        (F.coalesce("p_a", F.lit(True)) | F.coalesce("p_b", F.lit(True))).alias("partial"), delta.alias("delta_s"), _ratio(delta, F.col("sigma_s")).alias("ratio"),
    )
    full = frame.filter(~F.col("partial") & F.col("delta_s").isNotNull())
    sums = [F.count(F.lit(1)).alias("sectors"), F.sum("length_m").alias("length_m"), F.sum("delta_s").alias("delta_s"), quadrature("sigma_s").alias("sigma_s")]
    rate = lambda df: df.withColumn("ratio", _ratio(F.col("delta_s"), F.col("sigma_s")))
    events = full.filter(F.col("phase") != "straight").groupBy(*PAIR, "event_id").agg(F.first("corners", ignorenulls=True).alias("corners"), F.min("start_m").alias("start_m"), *sums)
    total = full.groupBy(*PAIR).agg(F.sum("delta_s").alias("total_s"), F.count(F.lit(1)).alias("complete"))
    count = frame.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("of"))
    return {
        "sectors": frame, "events": rate(events), "phases": rate(full.groupBy(*PAIR, "phase").agg(*sums)),
        "total": count.join(total, list(PAIR), "left").withColumn("complete", F.coalesce("complete", F.lit(0))),
    }


def above_noise(events: DataFrame) -> DataFrame:
    return events.filter(F.col("ratio") >= SIGNIFICANT)


def pairings(parts: dict[str, DataFrame], pairs: DataFrame) -> DataFrame:
    """One row per pair: official gap, decomposed total and the straights' share."""
    straight = parts["phases"].filter(F.col("phase") == "straight").select(*PAIR, F.col("delta_s").alias("straights_s"))
    return pairs.select(*PAIR, "lap_a", "lap_b", "gap_s").join(parts["total"].select(*PAIR, "total_s"), list(PAIR)).join(straight, list(PAIR), "left")


def pairings_wide(parts: dict[str, DataFrame], events: list[int] | None = None) -> DataFrame:
    """A row per pair with all its event deltas: a map from event to delta in order of the events, or a column for each listed one."""
    if events is not None:
        return parts["events"].groupBy(*PAIR).pivot("event_id", events).agg(F.first("delta_s"))
    entries = F.array_sort(F.collect_list(F.struct("event_id", "delta_s")))  # a session has as many events as its trace has troughs
    return parts["events"].groupBy(*PAIR).agg(F.map_from_entries(entries).alias("deltas"))


def event_noise(sectors: DataFrame, summary: DataFrame, grain: str = GRAIN) -> DataFrame:
    frame = sector_frame(sectors, summary, grain).filter(F.col("phase") != "straight")
    return frame.groupBy(*SESSION, "event_id").agg(F.first("corners", ignorenulls=True).alias("corners"), quadrature("sigma_s").alias("sigma_s"))


def consistency(events: DataFrame, noise: DataFrame) -> DataFrame:
    """Per event over all pairs: how often it points the same way, and by how much."""
    key = [*SESSION, "event_id"]
    rows = events.select(*PAIR, "event_id", "delta_s").join(noise, key).filter(F.col("delta_s").isNotNull())
    stats = rows.groupBy(*key).agg(
        F.first("corners", ignorenulls=True).alias("corners"), F.count(F.lit(1)).alias("pairings"), F.count_if(F.col("delta_s") > 0).alias("positive"),
        F.min("delta_s").alias("min_s"), F.max("delta_s").alias("max_s"), F.first("sigma_s").alias("sigma_s"), F.count_if(F.abs("delta_s") >= SIGNIFICANT * F.col("sigma_s")).alias("above_2_sigma"),
    )
    out = stats.join(exact_median(rows, key, "delta_s", "median_s"), key)
    return out.withColumn("always_same_sign", (F.col("positive") == F.col("pairings")) | (F.col("positive") == 0))


def choose_focus(agreement: DataFrame) -> DataFrame:
    """Per session the event with the largest median difference among those of one sign, else among all."""
    rank = F.struct(F.col("always_same_sign"), F.abs("median_s"), -F.col("event_id"))
    best = agreement.groupBy(*SESSION).agg(F.max_by(F.struct("event_id", "corners", "median_s", "sigma_s", "pairings", "positive"), rank).alias("f"))
    return best.select(*SESSION, "f.*")


def lap_row(df: DataFrame, laps: DataFrame, what: str) -> DataFrame:
    """The single row of each named lap; none or several is an error."""
    hit = laps.select(*LAP).join(df.groupBy(*LAP).agg(F.count(F.lit(1)).alias("_n")), list(LAP), "left")
    n = F.coalesce(F.col("_n"), F.lit(0))
    bad = F.raise_error(F.concat(F.lit(f"{what}: "), n.cast("string"), F.lit(" rows for "), lap_label())).cast("boolean")
    return df.join(hit.filter(F.when(n != 1, bad).otherwise(F.lit(True))).select(*LAP), list(LAP))


def side_of(pairs: DataFrame, s: str) -> DataFrame:
    return pairs.select(*PAIR, F.col(f"driver_{s}").alias("driver"), F.col(f"lap_{s}").alias("lap_number"))


def sector_reconciliation(lap_summary: DataFrame, truth: DataFrame, curves: DataFrame, boundaries: DataFrame, pairs: DataFrame, spacing: float = GRID_M) -> DataFrame:
    """Official sector gaps against grid sector gaps, and what explains the difference.

    Only S1 straddles the timing line, so only S1 is explained by the laps'
    start offsets; S2 and S3 repeat the laps' residuals.
    """
    point = lambda s: side_of(pairs, s).join(curves.select(*LAP, F.col("grid_index").cast("long").alias("grid_index"), F.col("t_s").alias(f"t_{s}")), list(LAP)).drop("driver", "lap_number")
    delta = point("a").join(point("b"), [*PAIR, "grid_index"]).withColumn("_d", F.col("t_b") - F.col("t_a"))
    last = delta.groupBy(*PAIR).agg(F.max("grid_index").alias("_i3"))
    edges = last.join(boundaries.select(*SESSION, "s1_m", "s2_m"), list(SESSION)).withColumn("_i1", F.rint(F.col("s1_m") / spacing).cast("long")).withColumn("_i2", F.rint(F.col("s2_m") / spacing).cast("long"))
    for n in (1, 2, 3):
        edges = edges.join(delta.select(*PAIR, F.col("grid_index").alias(f"_i{n}"), F.col("_d").alias(f"_c{n}")), [*PAIR, f"_i{n}"], "left")
    wanted = lambda df, cols, s: side_of(pairs, s).join(df.select(*LAP, *cols), list(LAP), "left").select(*PAIR, *[F.col(c).alias(f"{c}_{s}") for c in cols])
    official, resid = [f"s{n}_official_s" for n in (1, 2, 3)], [f"s{n}_residual_s" for n in (1, 2, 3)] + ["start_offset_s"]
    for df, cols in ((lap_summary, official), (truth, resid)):
        for s in ("a", "b"):
            edges = edges.join(wanted(df, cols, s), list(PAIR), "left")
    diff = lambda c: F.col(f"{c}_b") - F.col(f"{c}_a")
    gaps = [F.col("_c1"), F.col("_c2") - F.col("_c1"), F.col("_c3") - F.col("_c2")]
    bounds = [F.col("s1_m"), F.col("s2_m"), F.col("_i3") * F.lit(spacing)]
    rows = F.array(*[
        F.struct(
            F.lit(f"s{n}").alias("sector"), diff(f"s{n}_official_s").alias("official_gap_s"), gaps[n - 1].alias("grid_gap_s"), bounds[n - 1].alias("boundary_m"),
            diff(f"s{n}_residual_s").alias("identity_check_s"), (diff("start_offset_s") if n == 1 else F.lit(None).cast("double")).alias("start_offset_difference_s"),
            (-diff("start_offset_s") if n == 1 else diff(f"s{n}_residual_s")).alias("explained_s"),
        ) for n in (1, 2, 3)
    ])
    out = edges.select(*PAIR, F.inline(rows)).withColumn("difference_s", F.col("grid_gap_s") - F.col("official_gap_s"))
    return out.withColumn("unexplained_s", F.col("difference_s") - F.col("explained_s"))


def brake_applications(grid: DataFrame, events: DataFrame, laps: DataFrame, spacing: float = GRID_M) -> DataFrame:
    """Every brake application of the given laps between the last full-speed point and the apex; a row of nulls where none."""
    picked = grid.join(laps.select(*LAP).distinct(), list(LAP), "left_semi")
    w = events.select(*SESSION, "event_id", "corners", F.coalesce("left_max_m", "apex_m").alias("_s"), F.col("apex_m").alias("_e"))
    inside = (F.col("_d") >= F.col("_s")) & (F.col("_d") <= F.col("_e"))
    points = _window_points(picked, w, inside, ["brake"], spacing)
    key = (*LAP, "event_id")
    runs = boolean_runs(points, "brake", key, "grid_index", "d")
    counts = runs.groupBy(*key).agg(F.count(F.lit(1)).alias("of"))
    base = laps.select(*LAP).distinct().join(w.select(*SESSION, "event_id", "corners"), list(SESSION))
    out = base.join(counts, list(key), "left").join(runs, list(key), "left")
    return out.select(
        *key, "corners", F.coalesce("application", F.lit(0)).alias("application"), F.coalesce("of", F.lit(0)).alias("of"), "on_m", "off_m",
        (F.col("off_m") - F.col("on_m")).alias("length_m"), F.coalesce(F.col("application") == F.col("of"), F.lit(False)).alias("leads_into_apex"),
    )


def leading_application(applications: DataFrame) -> DataFrame:
    return applications.filter("leads_into_apex")


def braking_comparison(grid: DataFrame, events: DataFrame, metrics: DataFrame, pairs: DataFrame, window_m: float = BRAKE_WINDOW_M, spacing: float = GRID_M) -> DataFrame:
    """Braking points of both laps as the metric has them and as the applications before the apex show them."""
    laps = side_of(pairs, "a").unionByName(side_of(pairs, "b"))
    apps = brake_applications(grid, events, laps, spacing)
    per = apps.groupBy(*LAP, "event_id").agg(F.max("of").alias("n"), F.max(F.when(F.col("leads_into_apex"), F.col("on_m"))).alias("lead"))
    read = per.join(metrics.select(*LAP, "event_id", F.col("brake_on_m").alias("metric"), F.col("brake_gap_m").alias("gap")), [*LAP, "event_id"], "left")
    side = lambda s: side_of(pairs, s).join(read, list(LAP)).select(
        *PAIR, "event_id", F.col("n").alias(f"applications_{s}"), F.col("metric").alias(f"metric_on_{s}_m"), F.col("lead").alias(f"leading_on_{s}_m"), F.col("gap").alias(f"gap_{s}_m")
    )
    out = side("a").join(side("b"), [*PAIR, "event_id"]).join(events.select(*SESSION, "event_id", "corners", "has_braking"), [*SESSION, "event_id"])
    out = out.withColumn("metric_delta_m", F.col("metric_on_b_m") - F.col("metric_on_a_m")).withColumn("leading_delta_m", F.col("leading_on_b_m") - F.col("leading_on_a_m"))
    far = lambda c: F.coalesce(F.abs(F.col(c)) > window_m, F.lit(False))
    out = out.withColumns({
        "metric_outside_window": far("metric_delta_m"), "leading_outside_window": far("leading_delta_m"),
        "extra_dab": F.col("applications_a") != F.col("applications_b"), "multi_application": F.greatest("applications_a", "applications_b") > 1,
    })
    m, l = F.col("metric_outside_window"), F.col("leading_outside_window")
    verdict = (
        F.when(~flag("has_braking") | F.col("metric_delta_m").isNull() | F.col("leading_delta_m").isNull(), F.lit("no braking"))
        .when(~m & ~l, F.lit("agree")).when(m & l, F.lit("confirmed")).when(F.col("extra_dab"), F.lit("metric artefact")).otherwise(F.lit("definition-sensitive"))
    )
    return out.withColumn("verdict", verdict)


def braking_summary(frame: DataFrame) -> DataFrame:
    """Counts of the verdicts per pair; the corner lists hold at most one entry per event of the lap."""
    braked = frame.filter(flag("has_braking"))
    named = lambda v: F.array_sort(F.collect_list(F.when(F.col("verdict") == v, F.coalesce(F.col("corners"), F.lit("-")))))
    return braked.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("verdict") == "agree").alias("agree"), named("confirmed").alias("confirmed"), named("metric artefact").alias("metric_artefact"),
        named("definition-sensitive").alias("definition_sensitive"), F.count_if("multi_application").alias("multi_application"),
        F.count_if("metric_outside_window").alias("metric_outside_window"), F.count_if("leading_outside_window").alias("leading_outside_window"),
        F.coalesce(F.bool_and(F.when(F.col("metric_outside_window"), F.col("verdict").isin("confirmed", "metric artefact"))), F.lit(True)).alias("metric_outliers_explained"),
    )


def dab_prevalence(grid: DataFrame, windows: DataFrame) -> DataFrame:
    """Per lap: does it brake anywhere inside the session's window (low_m, high_m)?"""
    rows = grid.join(windows.select(*SESSION, "low_m", "high_m"), list(SESSION)).filter((F.col("distance_m") >= F.col("low_m")) & (F.col("distance_m") <= F.col("high_m")))
    return rows.groupBy(*LAP).agg(F.bool_or(flag("brake")).alias("dabbed"))


def speed_deficit(grid: DataFrame, pairs: DataFrame, windows: DataFrame) -> DataFrame:
    """Per pair: how much slower B is than A over the session's window, and at how many points."""
    inside = grid.join(windows.select(*SESSION, "start_m", "end_m"), list(SESSION)).filter((F.col("distance_m") >= F.col("start_m")) & (F.col("distance_m") <= F.col("end_m")))
    side = lambda s: side_of(pairs, s).join(inside.select(*LAP, "grid_index", F.col("speed").cast("double").alias(f"v_{s}")), list(LAP)).drop("driver", "lap_number")
    d = F.col("v_b") - F.col("v_a")
    out = side("a").join(side("b"), [*PAIR, "grid_index"]).groupBy(*PAIR).agg(
        F.avg(d).alias("mean_kmh"), F.min(d).alias("min_kmh"), F.max(d).alias("max_kmh"), F.count(F.lit(1)).alias("points"), F.count_if(d < 0).alias("slower_points")
    )
    return out.withColumn("share_slower", F.col("slower_points") / F.col("points")).withColumn("one_sided", (F.col("min_kmh") > 0) | (F.col("max_kmh") < 0))


def official_gap(lap_summary: DataFrame, pairs: DataFrame) -> DataFrame:
    side = lambda s: side_of(pairs, s).join(lap_summary.select(*LAP, F.col("lap_time_s").alias(f"_{s}")), list(LAP)).select(*PAIR, f"_{s}")
    return side("a").join(side("b"), list(PAIR)).select(*PAIR, (F.col("_b") - F.col("_a")).alias("official_gap_s"))
