"""The contracts of every session and reference table.

Fixed values: keys, columns, bounds and tolerances below are given, not chosen.
"""

from __future__ import annotations

from trackgrid.operators import quality as q
from trackgrid.operators.quality import WARNING, AllowedValues, Contract, ForeignKey, Invariant, NotNull, Range, Unique

SESSION_CODES = ("FP1", "FP2", "FP3", "SQ", "S", "Q", "R")
DRS_CODES = tuple(range(16))
UNSHARED_GRID_FRACTION = 0.02
GLITCH_FRACTION = 1e-3
THROTTLE_MAX_PCT = 110.0
PHASES = ("braking", "entry", "apex", "exit", "straight", "bin")
GRAINS = ("corner_phase", "fixed_100m")
REFERENCE_KINDS = ("session_fastest", "lap", "driver_best")

SAMPLE = ("driver", "lap_number", "session_time")
LAP = ("driver", "lap_number")
POINT = ("driver", "lap_number", "grid_index")
SECTOR = ("grain", "microsector_id")


def within(column, low, high, glitch=False, unless=None):
    return Range(column=column, low=low, high=high, unless=unless, max_fraction=GLITCH_FRACTION if glitch else 0.0)


def channels(metres: bool = True):
    """Bounds of the live channels, each with room for the odd glitch."""
    return (
        within("speed", 0.0, 400.0, glitch=True),
        within("throttle", 0.0, THROTTLE_MAX_PCT, glitch=True),
        within("rpm", 0.0, 16000.0, glitch=True),
        within("n_gear", 0, 8, glitch=True),
        AllowedValues(column="drs", values=DRS_CODES),
    ) + ((within("x", -5000.0, 5000.0, glitch=True), within("y", -5000.0, 5000.0, glitch=True)) if metres else ())


def build(name, key, rules, parents=(), scope=q.SESSION):
    return Contract(name=name, key=tuple(key), rules=tuple(rules), parents=tuple(parents), scope=tuple(scope))


SESSION_CONTRACTS = (
    build("laps", LAP, (
        NotNull(check=("driver", "lap_number", "team", "stint", "compound", "is_accurate")),
        NotNull(check=("lap_time", "sector1_time", "sector2_time", "sector3_time", "lap_start_time"), unless=q.lap_not_accurate),
        Unique(key=LAP),
        within("lap_number", 1, 200),
        within("lap_time", 20.0, 600.0, unless=q.lap_not_accurate),
        *[within(f"sector{i}_time", 10.0, 200.0, unless=q.lap_not_accurate) for i in (1, 2, 3)],
        within("stint", 1, 50),
        within("tyre_life", 0, 200),
    )),
    build("car_telemetry", SAMPLE, (
        NotNull(check=(*SAMPLE, "speed", "throttle", "brake", "rpm", "n_gear", "drs")),
        Unique(key=SAMPLE), ForeignKey(key=LAP, parent="laps"), *channels(metres=False),
    ), ("laps",)),
    build("pos_data", SAMPLE, (
        NotNull(check=(*SAMPLE, "x", "y", "z")), Unique(key=SAMPLE), ForeignKey(key=LAP, parent="laps"),
        within("x", -50000.0, 50000.0, glitch=True), within("y", -50000.0, 50000.0, glitch=True),
    ), ("laps",)),
    build("weather", ("session_time",), (
        NotNull(check=("session_time", "air_temp", "track_temp", "humidity", "pressure", "rainfall")), Unique(key=("session_time",)),
        within("air_temp", -20.0, 60.0), within("track_temp", -20.0, 80.0), within("humidity", 0.0, 100.0),
        within("pressure", 700.0, 1100.0), within("wind_speed", 0.0, 60.0), within("wind_direction", 0, 360),
    )),
    build("circuit_corners", ("number",), (
        NotNull(check=("number", "x", "y", "distance")), Unique(key=("number", "letter")), within("number", 1, 40), within("distance", 0.0, 10000.0),
    )),
    build("telemetry_aligned", SAMPLE, (
        NotNull(check=(*SAMPLE, "speed", "throttle", "rpm", "n_gear", "brake", "drs", "x", "y", "distance_raw", "distance_aligned", "line_offset_m")),
        Unique(key=SAMPLE), ForeignKey(key=LAP, parent="laps"),
        Invariant(name="aligned_laps_are_accurate", holds=q.aligned_laps_are_accurate, about=LAP),
        Invariant(name="aligned_distance_non_decreasing", holds=q.aligned_distance_non_decreasing, about=("distance_aligned",)),
        *channels(),
        within("distance_raw", 0.0, 10000.0, glitch=True), within("distance_aligned", -200.0, 10000.0, glitch=True), within("line_offset_m", 0.0, 100.0, glitch=True),
    ), ("laps",)),
    build("grid", POINT, (
        NotNull(check=(*POINT, "distance_m", "elapsed_time", "speed", "throttle", "rpm", "x", "y", "n_gear", "brake", "drs")),
        NotNull(check=("source_gap_m",), unless=q.before_first_sample),
        Unique(key=POINT), ForeignKey(key=LAP, parent="telemetry_aligned"),
        Invariant(name="grid_distance_matches_index", holds=q.grid_distance_matches_index, about=("grid_index", "distance_m")),
        Invariant(name="grid_index_contiguous_per_lap", holds=q.grid_index_contiguous_per_lap, about=("grid_index",)),
        Invariant(name="elapsed_time_increasing_per_lap", holds=q.elapsed_time_increasing_per_lap, about=("elapsed_time",)),
        within("grid_index", 0, 10000), within("distance_m", 0.0, 100000.0), within("elapsed_time", 0.0, 300.0),
        *channels(), within("source_gap_m", 0.0, 500.0, glitch=True),
    ), ("telemetry_aligned",)),
    build("events", ("event_id",), (
        NotNull(check=("event_id", "apex_m", "v_min_kmh", "prominence_kmh", "lift_m", "apex_start_m", "apex_end_m", "exit_end_m", "has_braking", "marginal")),
        NotNull(check=("brake_on_m", "brake_off_m"), unless=q.event_has_no_braking), Unique(key=("event_id",)),
        Invariant(name="event_boundaries_are_ordered", holds=q.event_boundaries_are_ordered, about=("lift_m", "apex_start_m", "apex_end_m", "exit_end_m")),
        within("v_min_kmh", 0.0, 400.0), within("prominence_kmh", 0.0, 400.0), within("apex_m", 0.0, 100000.0),
    )),
    build("microsectors", SECTOR, (
        NotNull(check=(*SECTOR, "phase", "start_m", "end_m", "start_index", "end_index", "marginal")),
        NotNull(check=("event_id", "corners"), unless=q.sector_is_not_an_event), Unique(key=SECTOR),
        ForeignKey(key=("event_id",), parent="events", nullable=True), AllowedValues(column="grain", values=GRAINS), AllowedValues(column="phase", values=PHASES),
        Invariant(name="microsectors_partition_the_lap", holds=q.microsectors_partition_the_lap, about=("start_m", "end_m")),
        Invariant(name="sector_indices_match_distances", holds=q.sector_indices_match_distances, about=("start_index", "end_index")),
        within("start_m", 0.0, 100000.0), within("end_m", 0.0, 100000.0),
    ), ("events",)),
    build("corners_aligned", ("number",), (
        NotNull(check=("number", "distance_m", "line_offset_m", "raw_distance_m")), Unique(key=("number", "letter")),
        ForeignKey(key=("event_id",), parent="events", nullable=True), within("distance_m", 0.0, 100000.0), within("line_offset_m", 0.0, 100.0, glitch=True),
    ), ("events",)),
    build("delta_t", POINT, (
        NotNull(check=(*POINT, "t_s", "reference", "reference_kind")), NotNull(check=("delta_t_s",), max_fraction=UNSHARED_GRID_FRACTION),
        Unique(key=POINT), ForeignKey(key=POINT, parent="grid"), AllowedValues(column="reference_kind", values=REFERENCE_KINDS),
        Invariant(name="delta_is_zero_at_the_line", holds=q.delta_is_zero_at_the_line, about=("grid_index", "delta_t_s")),
        within("t_s", 0.0, 300.0), within("delta_t_s", -120.0, 120.0),
    ), ("grid",)),
    build("microsector_times", (*LAP, *SECTOR), (
        NotNull(check=(*LAP, *SECTOR, "partial", "length_m")), NotNull(check=("time_s", "delta_s"), unless=q.row_is_partial), Unique(key=(*LAP, *SECTOR)),
        ForeignKey(key=SECTOR, parent="microsectors"), ForeignKey(key=LAP, parent="grid"), AllowedValues(column="grain", values=GRAINS),
        within("time_s", 0.0, 300.0), within("delta_s", -120.0, 120.0), within("length_m", 0.0, 100000.0),
    ), ("microsectors", "grid")),
    build("microsector_summary", SECTOR, (
        NotNull(check=(*SECTOR, "phase", "length_m", "n_laps")), NotNull(check=("event_id", "corners"), unless=q.sector_is_not_an_event),
        NotNull(check=("mean_s", "std_s", "min_s", "p10_s"), unless=q.sector_has_no_laps), Unique(key=SECTOR), ForeignKey(key=SECTOR, parent="microsectors"),
        AllowedValues(column="grain", values=GRAINS), AllowedValues(column="phase", values=PHASES),
        within("n_laps", 0, 10000), within("mean_s", 0.0, 300.0), within("std_s", 0.0, 60.0),
    ), ("microsectors",)),
    build("corner_metrics", (*LAP, "event_id"), (
        NotNull(check=(*LAP, "event_id", "v_min_kmh", "v_min_m", "apex_dev_m")),
        NotNull(check=("brake_on_m", "brake_dev_m"), unless=q.corner_event_has_no_braking, severity=WARNING), Unique(key=(*LAP, "event_id")),
        ForeignKey(key=("event_id",), parent="events"), ForeignKey(key=LAP, parent="grid"),
        within("v_min_kmh", 0.0, 400.0), within("v_min_m", 0.0, 100000.0), within("apex_dev_m", -500.0, 500.0), within("brake_dev_m", -1000.0, 1000.0), within("brake_gap_m", 0.0, 500.0),
    ), ("events", "grid")),
    build("lap_summary", LAP, (
        NotNull(check=(*LAP, "lap_time_s", "grid_time_s", "n_points", "delta_t_end_s", "official_delta_s", "residual_s", "reference", "is_reference")),
        Unique(key=LAP), ForeignKey(key=LAP, parent="grid"),
        within("lap_time_s", 20.0, 600.0), within("grid_time_s", 20.0, 600.0), within("n_points", 2, 10000), within("residual_s", -10.0, 10.0),
    ), ("grid",)),
    build("ground_truth", LAP, (
        NotNull(check=(*LAP, "lap_time_s", "lap_grid_s", "lap_residual_s", "driven_m", "line_start_m", "line_end_m", "window_open_s", "window_close_s",
                       "start_coverage_poor", "end_coverage_poor", "is_reference")),
        NotNull(check=("closure_residual_s",), unless=q.is_the_reference_lap), Unique(key=LAP), ForeignKey(key=LAP, parent="grid"),
        within("lap_time_s", 20.0, 600.0), within("lap_grid_s", 20.0, 600.0), within("lap_residual_s", -10.0, 10.0), within("closure_residual_s", -10.0, 10.0),
        within("driven_m", 0.0, 100000.0), within("driven_pct_of_official", -10.0, 10.0),
    ), ("grid",)),
    build("v_min_stability", ("driver", "compound", "event_id"), (
        NotNull(check=("driver", "compound", "event_id", "n_laps", "v_min_mean_kmh", "v_min_std_kmh")), Unique(key=("driver", "compound", "event_id")),
        ForeignKey(key=("event_id",), parent="events"), within("n_laps", 1, 10000), within("v_min_mean_kmh", 0.0, 400.0), within("v_min_std_kmh", 0.0, 200.0),
    ), ("events",)),
)

REFERENCE_CONTRACTS = (
    build("dim_event", ("season", "round"), (
        NotNull(check=("season", "round", "event_name", "circuit_id", "circuit_name", "country", "lat", "lon", "race_date")), Unique(key=("season", "round")),
        within("round", 1, 30), within("lat", -90.0, 90.0), within("lon", -180.0, 180.0),
    ), scope=("season",)),
    build("dim_session_schedule", ("season", "round", "session"), (
        NotNull(check=("season", "round", "session", "session_start_utc", "has_time")), Unique(key=("season", "round", "session")),
        ForeignKey(key=("season", "round"), parent="dim_event"), AllowedValues(column="session", values=SESSION_CODES), within("round", 1, 30),
    ), ("dim_event",), ("season",)),
    build("dim_driver", ("season", "code"), (
        NotNull(check=("season", "code", "driver_id", "given_name", "family_name", "full_name")), Unique(key=("season", "code")), within("permanent_number", 0, 99),
    ), scope=("season",)),
    build("dim_constructor", ("season", "constructor_id"), (
        NotNull(check=("season", "constructor_id", "name")), Unique(key=("season", "constructor_id")),
    ), scope=("season",)),
    build("driver_entry", ("season", "round", "code"), (
        NotNull(check=("season", "round", "code", "driver_id", "constructor_id", "car_number")), Unique(key=("season", "round", "code")),
        ForeignKey(key=("season", "round"), parent="dim_event"), ForeignKey(key=("season", "code"), parent="dim_driver"),
        ForeignKey(key=("season", "constructor_id"), parent="dim_constructor"), within("car_number", 0, 99),
    ), ("dim_event", "dim_driver", "dim_constructor"), ("season",)),
)

CONTRACTS = {c.name: c for c in (*SESSION_CONTRACTS, *REFERENCE_CONTRACTS)}
SESSION_TABLES = frozenset(c.name for c in SESSION_CONTRACTS)
OPTIONAL_TABLES = frozenset({"weather", "corners_aligned", "v_min_stability", "ground_truth"})
REPORTED_RANGES = {
    "car_telemetry": ("speed", "throttle", "rpm"),
    "grid": ("speed", "elapsed_time", "source_gap_m"),
    "telemetry_aligned": ("distance_aligned", "line_offset_m"),
    "lap_summary": ("lap_time_s", "residual_s"),
    "ground_truth": ("lap_residual_s", "closure_residual_s", "driven_pct_of_official"),
    "corner_metrics": ("v_min_kmh", "brake_gap_m"),
}
