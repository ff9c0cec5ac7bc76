"""Star schema: dimensions, facts and the queries that read them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackgrid.functions.columns import flag
from trackgrid.keys import LAP, SESSION

# Columns of the dimensions and facts.
DIM_LAP = (
    "code", "lap_number", "constructor_id", "team_alias", "compound", "stint", "tyre_life", "is_reference", "reference_lap", "n_points",
    "lap_time_s", "grid_time_s", "lap_grid_s", "lap_residual_s", "closure_residual_s", "s1_official_s", "s2_official_s", "s3_official_s",
    "s1_grid_s", "s2_grid_s", "s3_grid_s", "driven_m", "line_start_m", "line_end_m", "window_open_s", "window_close_s", "start_coverage_poor", "end_coverage_poor",
)
DIM_MICROSECTOR = ("grain", "microsector_id", "phase", "event_id", "corners", "marginal", "start_m", "end_m", "start_index", "end_index", "length_m")
DIM_CORNER_EVENT = (
    "event_id", "corners", "marginal", "has_braking", "apex_m", "v_min_kmh", "prominence_kmh", "lift_m", "brake_on_m", "brake_off_m", "apex_start_m", "apex_end_m", "exit_end_m",
)
FACT_GRID = ("lap_id", "grid_index", "distance_m", "t_s", "delta_t_s", "speed", "throttle", "rpm", "x", "y", "n_gear", "drs", "brake", "source_gap_m")
FACT_MICROSECTOR = ("lap_id", "grain", "microsector_id", "time_s", "delta_s", "partial")
FACT_CORNER = ("lap_id", "event_id", "v_min_kmh", "v_min_m", "apex_dev_m", "brake_on_m", "brake_dev_m", "brake_gap_m")


def pick(df: DataFrame, columns) -> DataFrame:
    """The listed columns in order, absent ones as null."""
    return df.select(*SESSION, *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns if c not in SESSION])


def session_id() -> Column:
    """Key of a session that is the same on every load."""
    return F.xxhash64(F.col("season").cast("int"), F.col("round").cast("int"), F.col("session_code"))


def lap_id(driver: str = "driver") -> Column:
    """Key of a lap that is the same on every load."""
    return F.xxhash64(F.col("season").cast("int"), F.col("round").cast("int"), F.col("session_code"), F.col(driver).cast("string"), F.col("lap_number").cast("int"))


def dim_session(meta: DataFrame, alignment: DataFrame | None = None, events: DataFrame | None = None, schedule: DataFrame | None = None) -> DataFrame:
    """One row per session. Reference data overrides the snapshot's own metadata; the start falls back on its date."""
    out = meta.select(
        F.col("season").cast("int").alias("season"), F.col("round_number").cast("int").alias("round"), F.col("session_requested").alias("session_code"),
        F.coalesce("session_name", "session_requested").alias("session_name"), F.coalesce("event_name", "event_requested", F.lit("")).alias("_event"),
        F.col("location").alias("_locality"), F.col("country").alias("_country"), F.col("session_date").alias("_date"),
    )
    if events is not None:
        out = out.join(events.select("season", "round", "event_name", "circuit_id", "circuit_name", "locality", "country"), ["season", "round"], "left")
    else:
        out = out.withColumns({c: F.lit(None).cast("string") for c in ("event_name", "circuit_id", "circuit_name", "locality", "country")})
    if schedule is not None:
        out = out.join(schedule.select("season", "round", F.col("session").alias("session_code"), F.col("session_start_utc").alias("_start")), list(SESSION), "left")
    else:
        out = out.withColumn("_start", F.lit(None).cast("timestamp"))
    if alignment is not None:
        out = out.join(alignment.select(*SESSION, *[c for c in ("official_lap_length_m", "reference_line_length_m", "alignment_method") if c in alignment.columns]), list(SESSION), "left")
    out = out.withColumns({
        "event_name": F.coalesce("event_name", "_event"), "locality": F.coalesce("locality", "_locality"), "country": F.coalesce("country", "_country"),
        "session_start_utc": F.coalesce("_start", F.try_to_timestamp("_date")), "session_id": session_id(),
    })
    return out.drop("_event", "_locality", "_country", "_date", "_start")


def dim_lap(lap_summary: DataFrame, truth: DataFrame | None = None, entries: DataFrame | None = None) -> DataFrame:
    """One row per lap on the grid; validation columns the summary lacks are added, the constructor comes by code."""
    out = lap_summary
    if truth is not None:
        new = [c for c in truth.columns if c not in out.columns]
        out = out.join(truth.select(*LAP, *new), list(LAP), "left")
    out = out.withColumn("code", F.col("driver"))
    if entries is not None:
        out = out.join(entries.select("season", "round", "code", "constructor_id"), ["season", "round", "code"], "left")
    if "team" in out.columns:
        out = out.withColumn("team_alias", F.col("team"))
    if "reference" in out.columns:
        out = out.withColumn("reference_lap", F.col("reference"))
    return pick(out, DIM_LAP).withColumn("session_id", session_id()).withColumn("lap_id", lap_id("code"))


def dim_microsector(sectors: DataFrame) -> DataFrame:
    out = sectors if "length_m" in sectors.columns else sectors.withColumn("length_m", F.col("end_m").cast("double") - F.col("start_m").cast("double"))
    return pick(out, DIM_MICROSECTOR).withColumn("session_id", session_id())


def dim_corner_event(events: DataFrame) -> DataFrame:
    return pick(events, DIM_CORNER_EVENT).withColumn("session_id", session_id())


def unknown_laps(df: DataFrame, laps: DataFrame) -> DataFrame:
    """Laps of a fact that the lap dimension does not hold."""
    known = laps.select(*SESSION, F.col("code").alias("driver"), "lap_number").distinct()
    return df.select(*LAP).distinct().join(known, list(LAP), "left_anti")


def with_lap_id(df: DataFrame, laps: DataFrame | None = None) -> DataFrame:
    """The lap's key on every row; a lap the dimension does not hold is an error."""
    if laps is None:
        return df.withColumn("lap_id", lap_id())
    lost = unknown_laps(df, laps).withColumn("_lost", F.lit(True))
    joined = df.join(lost, list(LAP), "left")
    refuse = F.raise_error(F.concat(F.lit("lap without lap_id: "), F.col("driver"))).cast("long")
    return joined.withColumn("lap_id", F.when(F.col("_lost"), refuse).otherwise(lap_id())).drop("_lost")


def fact_grid(grid: DataFrame, delta: DataFrame | None, laps: DataFrame | None = None) -> DataFrame:
    """Grid points with time and delta; without a delta table the elapsed time is the time. No time is an error."""
    if delta is not None:
        d = delta.select(*LAP, F.col("grid_index").cast("long").alias("grid_index"), "t_s", "delta_t_s")
        out = grid.withColumn("grid_index", F.col("grid_index").cast("long")).join(d, [*LAP, "grid_index"], "left")
    else:
        out = grid.withColumn("t_s", F.col("elapsed_time").cast("double")).withColumn("delta_t_s", F.lit(None).cast("double"))
    lost = F.raise_error(F.lit("grid row without t_s: delta and grid disagree")).cast("double")
    out = out.withColumn("t_s", F.when(F.col("t_s").isNull(), lost).otherwise(F.col("t_s")))
    return pick(with_lap_id(out, laps), FACT_GRID)


def fact_microsector(times: DataFrame, laps: DataFrame | None = None) -> DataFrame:
    return pick(with_lap_id(times, laps), FACT_MICROSECTOR)


def fact_corner_metric(metrics: DataFrame, laps: DataFrame | None = None) -> DataFrame:
    return pick(with_lap_id(metrics, laps), FACT_CORNER)


# ---------------------------------------------------------------- reading

def sessions(dim: DataFrame) -> DataFrame:
    """Loaded sessions with a label, newest first."""
    label = F.concat(F.col("season").cast("string"), F.lit(" R"), F.col("round").cast("string"), F.lit(" "), F.col("session_code"), F.lit(" — "), F.col("event_name"))
    return dim.select(*SESSION, label.alias("label")).orderBy(F.desc("season"), F.desc("round"), "session_code")


def drivers(laps: DataFrame) -> DataFrame:
    """Drivers of every session by their best lap; a driver without a time comes last."""
    return laps.groupBy(*SESSION, "code").agg(F.min("lap_time_s").alias("best_s")).orderBy(*SESSION, F.col("best_s").asc_nulls_last())


def fastest_lap(laps: DataFrame) -> DataFrame:
    """Each driver's default lap: the fastest, untimed laps last, then the lowest number."""
    rank = F.struct(F.col("lap_time_s").isNull(), F.col("lap_time_s"), F.col("lap_number"))
    best = laps.groupBy(*SESSION, "code").agg(F.min_by(F.struct("lap_id", "lap_number", "lap_time_s", "compound", "stint"), rank).alias("b"))
    return best.select(*SESSION, "code", "b.*")


def overlay(fact: DataFrame, season: int, round_: int, session_code: str, lap_a: int, lap_b: int) -> DataFrame:
    """Two laps on their shared grid points. The session's literals prune the partitions on both sides."""
    if lap_a == lap_b:
        raise ValueError("an overlay needs two different laps")
    leaf = fact.filter((F.col("season") == season) & (F.col("round") == round_) & (F.col("session_code") == session_code))
    return overlay_pairs(leaf, leaf.filter(F.col("lap_id") == lap_a).select(*SESSION).distinct().withColumn("lap_a", F.lit(lap_a)).withColumn("lap_b", F.lit(lap_b)))


def asked_laps(laps: DataFrame, asks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs of laps to lay over each other, refused asks with the reason).

    ``asks``: session, ask, driver_a, driver_b and optionally lap ids lap_a, lap_b; a
    driver asked for without a lap is shown by their default one (fastest_lap).
    ``laps``: the lap dimension. A lap id must be one of the driver's own.
    """
    given = [F.col(c).cast("long") if c in asks.columns else F.lit(None).cast("long") for c in ("lap_a", "lap_b")]
    rows = asks.select(*SESSION, "ask", "driver_a", "driver_b", given[0].alias("want_a"), given[1].alias("want_b"))
    best = fastest_lap(laps)
    for s in ("a", "b"):
        default = best.select(*SESSION, F.col("code").alias(f"driver_{s}"), F.col("lap_id").alias(f"best_{s}"))
        own = laps.select(*SESSION, F.col("code").alias(f"driver_{s}"), F.col("lap_id").alias(f"want_{s}"), F.lit(True).alias(f"own_{s}"))
        rows = rows.join(default, [*SESSION, f"driver_{s}"], "left").join(own, [*SESSION, f"driver_{s}", f"want_{s}"], "left")
    label = lambda s: F.col(f"driver_{s}")
    reason = F.when(F.col("driver_a") == F.col("driver_b"), F.lit("pick two different drivers"))
    for s in ("a", "b"):
        reason = reason.when(F.col(f"best_{s}").isNull(), F.concat(label(s), F.lit(" has no lap in the session")))
        reason = reason.when(F.col(f"want_{s}").isNotNull() & F.col(f"own_{s}").isNull(), F.concat(F.lit("the lap asked for is not "), label(s), F.lit("'s")))
    rows = rows.withColumn("reason", reason)
    lap = lambda s: F.coalesce(f"want_{s}", f"best_{s}").alias(f"lap_{s}")
    return rows.filter("reason IS NULL").select(*SESSION, "ask", "driver_a", "driver_b", lap("a"), lap("b")), rows.filter("reason IS NOT NULL").select(*SESSION, "ask", "reason")


def overlay_drivers(fact: DataFrame, laps: DataFrame, asks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(overlays of all asks by grid point, refused asks with the reason); laps that share no grid point are refused too."""
    pairs, refused = asked_laps(laps, asks)
    channels = ("t_s", "speed", "throttle", "brake", "n_gear", "drs")
    points = fact.select(*SESSION, "lap_id", "grid_index", "distance_m", *channels)
    side = lambda s: points.select(*SESSION, F.col("lap_id").alias(f"lap_{s}"), "grid_index", F.col("distance_m").alias(f"_d_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in channels])
    both = pairs.join(side("a"), [*SESSION, "lap_a"]).join(side("b"), [*SESSION, "lap_b", "grid_index"])
    shown = both.select(*SESSION, "ask", "driver_a", "driver_b", "grid_index", F.col("_d_a").alias("distance_m"), (F.col("t_s_b") - F.col("t_s_a")).alias("delta_t_s"), *[f"{c}_{s}" for c in channels[1:] for s in ("a", "b")])
    empty = pairs.join(shown.select(*SESSION, "ask").distinct(), [*SESSION, "ask"], "left_anti")
    none = empty.select(*SESSION, "ask", F.concat(F.lit("no shared grid points between "), "driver_a", F.lit(" and "), "driver_b").alias("reason"))
    return shown, refused.unionByName(none)


def overlay_pairs(fact: DataFrame, pairs: DataFrame) -> DataFrame:
    """Overlays of one pair of laps (lap_a, lap_b) per session."""
    channels = ("t_s", "speed", "throttle", "brake", "n_gear", "drs")
    side = lambda s: fact.join(pairs.select(*SESSION, F.col(f"lap_{s}").alias("lap_id")), [*SESSION, "lap_id"], "left_semi").select(
        *SESSION, "grid_index", F.col("distance_m").alias(f"_d_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in channels]
    )
    both = side("a").join(side("b"), [*SESSION, "grid_index"])
    return both.select(*SESSION, "grid_index", F.col("_d_a").alias("distance_m"), (F.col("t_s_b") - F.col("t_s_a")).alias("delta_t_s"), *[f"{c}_{s}" for c in channels[1:] for s in ("a", "b")])


MIN_RANKED_M = 30.0  # fixed value: shorter sectors are pooled


def loss_chart(fact: DataFrame, sectors: DataFrame, pairs: DataFrame, grain: str = "corner_phase", threshold: float = MIN_RANKED_M) -> DataFrame:
    """Time lost per sector both laps complete; sectors below the threshold are one pooled row."""
    side = lambda s: fact.filter(F.col("grain") == grain).join(pairs.select(*SESSION, F.col(f"lap_{s}").alias("lap_id")), [*SESSION, "lap_id"], "left_semi").select(
        *SESSION, "microsector_id", F.col("time_s").alias(f"t_{s}"), flag("partial").alias(f"p_{s}")
    )
    both = side("a").join(side("b"), [*SESSION, "microsector_id"]).filter("NOT p_a AND NOT p_b AND t_a IS NOT NULL AND t_b IS NOT NULL")
    geo = sectors.filter(F.col("grain") == grain).select(*SESSION, "microsector_id", "phase", "corners", (F.col("end_m") - F.col("start_m")).alias("length_m"))
    name = F.concat_ws(" ", F.col("microsector_id").cast("string"), F.coalesce(F.col("corners"), F.lit("")), F.col("phase"))
    label = F.when(F.col("length_m") >= threshold, name).otherwise(F.lit("pooled"))
    return both.join(geo, [*SESSION, "microsector_id"]).groupBy(*SESSION, label.alias("label")).agg(F.sum(F.col("t_b") - F.col("t_a")).alias("delta_s"), F.sum("length_m").alias("length_m"), F.count(F.lit(1)).alias("sectors"))


def corner_table(fact: DataFrame, events: DataFrame, laps: DataFrame) -> DataFrame:
    """Corners of each driver's fastest lap with the braking point and its own uncertainty."""
    best = fastest_lap(laps).select(*SESSION, "code", "lap_id")
    rows = fact.join(best, [*SESSION, "lap_id"]).join(events.select(*SESSION, "event_id", "corners"), [*SESSION, "event_id"])
    point = F.when(F.col("brake_on_m").isNotNull(), F.format_string("%.0f ± %.0f m", F.col("brake_on_m"), F.coalesce(F.col("brake_gap_m"), F.lit(0.0))))
    return rows.select(*SESSION, "code", "event_id", "corners", "v_min_kmh", point.alias("braking_point"))


def tyre_summary(fact: DataFrame, laps: DataFrame) -> DataFrame:
    """Sector time by compound and stint."""
    tagged = fact.filter(~flag("partial") & F.col("time_s").isNotNull()).join(laps.select(*SESSION, "lap_id", "compound", "stint"), [*SESSION, "lap_id"])
    return tagged.groupBy(*SESSION, "compound", "stint", "grain").agg(F.count(F.lit(1)).alias("sectors"), F.avg("time_s").alias("mean_s"), F.min("time_s").alias("best_s"))


def session_identity(dim: DataFrame, season: int, round_: int, session_code: str) -> DataFrame:
    return dim.filter((F.col("season") == season) & (F.col("round") == round_) & (F.col("session_code") == session_code))
