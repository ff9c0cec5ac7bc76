"""Official timing against rebuilt timing."""

from pyspark.sql import functions as F

from catalog import metrics as Q
from catalog import segment as C
from catalog.binding import CTES
from catalog.registry import query
from catalog.segment import KS, SS, US
from catalog.series import K, L, U, grid, reference, speed_curves, tele_raw
from trackgrid.keys import LAP, SESSION
from trackgrid.operators import series as S
from trackgrid.operators import spatial as P
from trackgrid.operators import validate as V

J = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in LAP)

# the axis of these queries opens before zero, as an aligned axis does
CTES["al"] = "SELECT * REPLACE (distance_aligned - 60.0 AS distance_aligned) FROM tele_raw"
CTES["timed"] = f"SELECT {K}, lap_start_time AS ts, lap_start_time + lap_time AS te FROM laps WHERE lap_time IS NOT NULL"


def _raw_at(which):
    return f"""SELECT {', '.join('q.' + k for k in LAP)}, a.session_time IS NULL OR z.session_time IS NULL AS ex,
 CASE WHEN a.session_time IS NULL THEN z.distance_raw - z.speed / 3.6 * (z.session_time - {which}) WHEN z.session_time IS NULL THEN a.distance_raw + a.speed / 3.6 * ({which} - a.session_time)
  WHEN a.session_time = z.session_time THEN a.distance_raw ELSE (z.distance_raw - a.distance_raw) / (z.session_time - a.session_time) * ({which} - a.session_time) + a.distance_raw END AS r
FROM timed q ASOF LEFT JOIN al a ON {J('q', 'a')} AND q.{which} >= a.session_time ASOF LEFT JOIN al z ON {J('q', 'z')} AND q.{which} <= z.session_time"""


CTES["raw_s"] = _raw_at("ts")
CTES["raw_e"] = _raw_at("te")
CTES["lstat"] = f"""
SELECT {K}, arg_min(distance_aligned, session_time) FILTER (WHERE ins) AS din, arg_min(distance_raw, session_time) FILTER (WHERE ins) AS rin,
 arg_max(distance_aligned, session_time) FILTER (WHERE ins) AS dout, arg_max(distance_raw, session_time) FILTER (WHERE ins) AS rout,
 min(session_time) AS tf, max(session_time) AS tl, arg_min(distance_aligned, session_time) AS df, arg_max(distance_aligned, session_time) AS dl, arg_min(speed, session_time) AS vf,
 max(distance_aligned) FILTER (WHERE distance_aligned <= 0) AS z0d, max(session_time) FILTER (WHERE distance_aligned <= 0) AS z0t,
 min(distance_aligned) FILTER (WHERE distance_aligned > 0) AS z1d, min(session_time) FILTER (WHERE distance_aligned > 0) AS z1t
FROM (SELECT *, distance_aligned BETWEEN 20.0 AND 1920.0 AS ins FROM al) GROUP BY ALL HAVING count(*) >= 2 AND bool_or(ins)"""
CTES["xing"] = f"""
SELECT *, t_zero_s - ts AS start_offset_s FROM (SELECT {K}, ts, din - (rin - s.r) AS line_start_m, dout + (e.r - rout) AS line_end_m, tf - ts AS window_open_s, tl - te AS window_close_s, e.r - s.r AS driven_m,
 s.ex AS start_extrapolated, e.ex AS end_extrapolated, CASE WHEN df <= 0 AND dl >= 0 THEN CASE WHEN z0d = 0 THEN z0t ELSE (z1t - z0t) / (z1d - z0d) * (0 - z0d) + z0t END END AS t_zero_s,
 df AS first_sample_m, tf AS first_sample_s, vf AS first_sample_kmh FROM lstat JOIN timed {U} JOIN raw_s s {U} JOIN raw_e e {U})"""
CTES["linepos"] = f"SELECT {KS}, median(line_start_m) AS d_start, median(line_end_m) AS d_end FROM xing GROUP BY ALL"
CTES["strt"] = f"SELECT {K}, t_zero_s - (first_sample_s - (first_sample_m - d_start) / (first_sample_kmh / 3.6)) AS start_stretch_s FROM xing JOIN linepos {US}"


def _time_at(x, name):
    i = f"greatest(0, least(CAST(floor({x} / 10.0) AS BIGINT), b.n_points - 1))"
    return f"""SELECT {', '.join('b.' + k for k in LAP)}, CASE WHEN {x} < 0 THEN a.t_s + {x} / a.speed_ms WHEN z.t_s IS NULL THEN a.t_s + ({x} - {i} * 10.0) / a.speed_ms
 ELSE (z.t_s - a.t_s) / 10.0 * ({x} - {i} * 10.0) + a.t_s END AS {name} FROM (SELECT * FROM lapn JOIN linepos {US} JOIN bnds {US}) b
 JOIN curves a ON {J('b', 'a')} AND a.grid_index = {i} LEFT JOIN curves z ON {J('b', 'z')} AND z.grid_index = {i} + 1"""


CTES["at_start"], CTES["at_end"] = _time_at("d_start", "t_a"), _time_at("d_end", "t_b")
CTES["at_s1"], CTES["at_s2"] = _time_at("s1_m", "t_1"), _time_at("s2_m", "t_2")
CTES["recon"] = f"""
SELECT *, lap_grid_s - lap_time_s AS lap_residual_s, s1_grid_s - s1o AS s1_residual_s, s2_grid_s - s2o AS s2_residual_s, s3_grid_s - s3o AS s3_residual_s FROM (
SELECT {K}, t_b - coalesce(-start_stretch_s, t_a) AS lap_grid_s, t_1 - coalesce(-start_stretch_s, t_a) AS s1_grid_s, t_2 - t_1 AS s2_grid_s, t_b - t_2 AS s3_grid_s,
 lap_time AS lap_time_s, sector1_time AS s1o, sector2_time AS s2o, sector3_time AS s3o, compound, start_stretch_s, start_stretch_s IS NOT NULL AS start_from_samples,
 greatest(0, -d_start) AS start_extrap_m, greatest(0, d_end - (n_points - 1) * 10.0) AS end_extrap_m
FROM lapn JOIN linepos {US} LEFT JOIN at_start {U} LEFT JOIN at_end {U} LEFT JOIN at_s1 {U} LEFT JOIN at_s2 {U} LEFT JOIN strt {U} LEFT JOIN laps {U})"""
CTES["clos"] = f"""
SELECT r.*, r.driver = m.ref_driver AND r.lap_number = m.ref_lap AS is_reference, CASE WHEN NOT (r.driver = m.ref_driver AND r.lap_number = m.ref_lap) THEN (r.lap_grid_s - x.lap_grid_s) - (r.lap_time_s - x.lap_time_s) END AS closure_residual_s
FROM recon r JOIN refmap m {U} LEFT JOIN recon x ON x.season = r.season AND x.round = r.round AND x.session_code = r.session_code AND x.driver = m.ref_driver AND x.lap_number = m.ref_lap"""
_C = lambda a, b: f"coalesce(abs({a}) > 0.3 AND abs({a} + {b}) < 0.5 * abs({a}), false)"
CTES["truth"] = f"""
SELECT *, coalesce(window_open_s > ol, false) AS start_coverage_poor, coalesce(window_close_s < cl, false) AS end_coverage_poor, coalesce(pct < -3.0 OR pct > 0.2, false) AS distance_excursion,
 {_C('s1_residual_s', 's2_residual_s')} OR {_C('s2_residual_s', 's1_residual_s')} OR {_C('s2_residual_s', 's3_residual_s')} OR {_C('s3_residual_s', 's2_residual_s')} AS sector_split_outlier,
 coalesce(abs(lap_residual_s) > 0.3, false) AS lap_outlier, pct AS driven_pct_of_official FROM (SELECT *, 100.0 * (driven_m - 2000.0) / 2000.0 AS pct FROM clos LEFT JOIN xing {U}
 LEFT JOIN (SELECT {KS}, quantile_cont(window_open_s, 0.95) + 0.25 AS ol, quantile_cont(window_close_s, 0.05) - 0.25 AS cl FROM clos LEFT JOIN xing {U} GROUP BY ALL) {US})"""
CTES["push"] = f"SELECT * FROM (SELECT *, min(lap_time) OVER (PARTITION BY {KS}, driver) AS best FROM laps WHERE lap_time IS NOT NULL) WHERE lap_time <= 1.07 * best"
CTES["stab"] = f"""
SELECT {KS}, driver, p.compound, event_id, min(corners) AS corners, count(*) AS n_laps, avg(v_min_kmh) AS v_min_mean_kmh, stddev_samp(v_min_kmh) AS v_min_std_kmh
FROM cm JOIN push p {U} GROUP BY ALL HAVING count(*) >= 3"""
CTES["gated"] = "SELECT * FROM truth WHERE NOT (start_coverage_poor OR end_coverage_poor OR distance_excursion OR sector_split_outlier OR lap_outlier)"


# ---- Spark stage tables ----------------------------------------------------

def aligned(b):
    return tele_raw(b).withColumn("distance_aligned", F.col("distance_aligned") - 60.0)


def line(b):
    return grid(b).select(*SESSION).distinct().withColumn("line_length_m", F.lit(1940.0))


def official(b):
    return grid(b).select(*SESSION).distinct().withColumn("official_m", F.lit(2000.0))


def crossings(b):
    return b.staged("line_crossings", lambda: V.line_crossings(aligned(b), b.laps(), line(b)))


def truth(b):
    return b.staged("ground_truth", lambda: V.ground_truth(speed_curves(b), b.laps(), crossings(b), reference(b), Q.boundaries(b), official(b)))


def stability(b):
    return b.staged("stability", lambda: V.v_min_stability(C.metrics(b), b.laps()))


def registration(b):
    return V.sector_registration(grid(b), V.residual_spread(truth(b)), Q.boundaries(b))


def report(b):
    return b.staged("report", lambda: V.report(truth(b), crossings(b), stability(b), b.laps(), registration(b), official(b)))


# ---- queries ---------------------------------------------------------------

XOUT = L + "line_start_m:d line_end_m:d window_open_s:d window_close_s:d driven_m:d start_extrapolated:b end_extrapolated:b t_zero_s:d first_sample_m:d first_sample_s:d first_sample_kmh:d start_offset_s:d"


@query("val01_line_crossings", XOUT, "SELECT * FROM xing")
def _(b):
    return V.line_crossings(aligned(b), b.laps(), line(b))


@query("val02_start_stretch", L + "start_stretch_s:d", "SELECT * FROM strt")
def _(b):
    return V.start_stretch(crossings(b), V.line_positions(crossings(b)))


@query("val03_line_positions", SS + "d_start:d d_end:d", "SELECT * FROM linepos")
def _(b):
    return V.line_positions(crossings(b))


@query("val04_reconstruct_laps", L + "lap_grid_s:d s1_grid_s:d s2_grid_s:d s3_grid_s:d lap_residual_s:d s1_residual_s:d s2_residual_s:d s3_residual_s:d start_from_samples:b start_extrap_m:d end_extrap_m:d", "SELECT * FROM recon")
def _(b):
    pos = V.line_positions(crossings(b))
    return V.reconstruct_laps(speed_curves(b), b.laps(), pos, Q.boundaries(b), V.start_stretch(crossings(b), pos))


@query("val05_closure_residuals", L + "closure_residual_s:d is_reference:b", "SELECT * FROM clos")
def _(b):
    pos = V.line_positions(crossings(b))
    return V.closure_residuals(V.reconstruct_laps(speed_curves(b), b.laps(), pos, Q.boundaries(b), V.start_stretch(crossings(b), pos)), reference(b))


TRUTH_OUT = L + "compound:s lap_time_s:d lap_grid_s:d lap_residual_s:d closure_residual_s:d driven_m:d driven_pct_of_official:d window_open_s:d start_coverage_poor:b end_coverage_poor:b distance_excursion:b is_reference:b sector_split_outlier:b lap_outlier:b"


@query("val06_ground_truth", TRUTH_OUT, "SELECT * FROM truth")
def _(b):
    return V.ground_truth(speed_curves(b), b.laps(), crossings(b), reference(b), Q.boundaries(b), official(b))


@query("val06_validation_report", SS + "laps:i laps_gated:d flagged:i excursions:i anomalies:i anomaly_fraction:d lap_residual_std_s:d lap_residual_median_s:d closure_p95:d s2_median_s:d driven_std_pct:d line_start_std_m:d v_min_groups:d v_min_std_p95_kmh:d push_laps:i line_ok:b anomaly_ok:b", f"""
SELECT *, coalesce(line_start_std_m <= 8 AND line_end_std_m <= 8, false) AS line_ok, anomalies / laps <= 0.1 AS anomaly_ok, anomalies / laps AS anomaly_fraction FROM
 (SELECT {KS}, count(*) AS laps, count(*) FILTER (WHERE start_coverage_poor OR end_coverage_poor) AS flagged, count(*) FILTER (WHERE distance_excursion) AS excursions, count(*) FILTER (WHERE sector_split_outlier OR lap_outlier) AS anomalies FROM truth GROUP BY ALL)
 LEFT JOIN (SELECT {KS}, count(*) AS laps_gated, coalesce(stddev_samp(lap_residual_s), 0) AS lap_residual_std_s, median(lap_residual_s) AS lap_residual_median_s, quantile_cont(abs(closure_residual_s), 0.95) AS closure_p95, median(s2_residual_s) AS s2_median_s, 100.0 * stddev_samp(driven_m) / 2000.0 AS driven_std_pct FROM gated GROUP BY ALL) {US}
 LEFT JOIN (SELECT {KS}, stddev_samp(line_start_m) AS line_start_std_m, stddev_samp(line_end_m) AS line_end_std_m FROM xing GROUP BY ALL) {US}
 LEFT JOIN (SELECT {KS}, count(*) AS v_min_groups, quantile_cont(v_min_std_kmh, 0.95) AS v_min_std_p95_kmh FROM stab GROUP BY ALL) {US}
 LEFT JOIN (SELECT {KS}, count(*) AS push_laps FROM push GROUP BY ALL) {US}""")
def _(b):
    return V.report(truth(b), crossings(b), stability(b), b.laps(), registration(b), official(b))


@query("val07_season_table", SS + "circuit:s snapshot_date:s laps:i anomalies:i", f"""
SELECT {KS}, n_name AS circuit, '2024-0' || round || '-01' AS snapshot_date, count(*) AS laps, count(*) FILTER (WHERE sector_split_outlier OR lap_outlier) AS anomalies FROM truth LEFT JOIN nation ON n_nationkey = round GROUP BY ALL""")
def _(b):
    return V.season_table(report(b), session_meta(b))


def session_meta(b):
    names = b.table("nation").select(F.col("n_nationkey").alias("round"), F.col("n_name").alias("location"))
    s = grid(b).select(*SESSION).distinct().join(names, "round", "left")
    return s.withColumn("snapshot_date", F.concat(F.lit("2024-0"), F.col("round").cast("string"), F.lit("-01")))


@query("agg20_by_circuit", "circuit:s sessions:i passing:i laps:i line_start_std_m:d all_sessions_pass:b lap_residual_std_s:d", f"""
SELECT circuit, count(*) AS sessions, 0 AS passing, sum(laps) AS laps, max(line_start_std_m) AS line_start_std_m, false AS all_sessions_pass, median(lap_residual_std_s) AS lap_residual_std_s FROM
 (SELECT {KS}, n_name AS circuit, count(*) AS laps FROM truth LEFT JOIN nation ON n_nationkey = round GROUP BY ALL)
 LEFT JOIN (SELECT {KS}, coalesce(stddev_samp(lap_residual_s), 0) AS lap_residual_std_s FROM gated GROUP BY ALL) {US}
 LEFT JOIN (SELECT {KS}, stddev_samp(line_start_m) AS line_start_std_m FROM xing GROUP BY ALL) {US} GROUP BY ALL""")
def _(b):
    return V.by_circuit(V.season_table(report(b), session_meta(b)))


@query("agg08_v_min_stability", SS + "driver:s compound:s event_id:i corners:s n_laps:i v_min_mean_kmh:d v_min_std_kmh:d", "SELECT * FROM stab")
def _(b):
    return V.v_min_stability(C.metrics(b), b.laps())


@query("agg18_sector_registration", SS + "s1_m:d s2_m:d s3_m:d", f"""
WITH sp AS (SELECT {KS}, grid_index, median(speed) AS m FROM grid GROUP BY ALL),
v AS (SELECT {KS}, (SELECT median(m) / 3.6 FROM sp WHERE sp.season = b.season AND sp.round = b.round AND sp.session_code = b.session_code AND grid_index BETWEEN -2 AND 2) AS vl,
 (SELECT median(m) / 3.6 FROM sp WHERE sp.season = b.season AND sp.round = b.round AND sp.session_code = b.session_code AND abs(grid_index - round_even(s1_m / 10.0, 0)) <= 2) AS v1,
 (SELECT median(m) / 3.6 FROM sp WHERE sp.season = b.season AND sp.round = b.round AND sp.session_code = b.session_code AND abs(grid_index - round_even(s2_m / 10.0, 0)) <= 2) AS v2 FROM bnds b),
s AS (SELECT {KS}, stddev_samp(s1_residual_s) AS a, stddev_samp(s2_residual_s) AS b, stddev_samp(s3_residual_s) AS c FROM truth GROUP BY ALL)
SELECT {KS}, a / sqrt(1 / (vl * vl) + 1 / (v1 * v1)) AS s1_m, b / sqrt(1 / (v1 * v1) + 1 / (v2 * v2)) AS s2_m, c / sqrt(1 / (v2 * v2) + 1 / (vl * vl)) AS s3_m FROM s JOIN v {US}""")
def _(b):
    std = truth(b).groupBy(*SESSION).agg(*[F.stddev_samp(f"{s}_residual_s").alias(s) for s in V.SECTORS])
    return V.sector_registration(grid(b), std, Q.boundaries(b))


@query("flt03_push_laps", L + "lap_time:d", "SELECT * FROM push")
def _(b):
    return V.push_laps(b.laps())


@query("flt07_official_band", L + "length_m:d inside:b", f"SELECT *, (length_m - 2000.0) / 2000.0 * 100.0 BETWEEN -3.0 AND 0.2 AS inside FROM (SELECT {K}, max(distance_raw) AS length_m FROM tele_raw GROUP BY ALL)")
def _(b):
    return tele_raw(b).groupBy(*LAP).agg(F.max("distance_raw").alias("length_m")).withColumn("inside", P.within_official_band(F.col("length_m"), F.lit(2000.0)))


@query("flt08_distance_excursions", L + "driven_pct_of_official:d", "SELECT * FROM truth WHERE distance_excursion")
def _(b):
    return truth(b).filter(V.distance_excursion("driven_pct_of_official"))


@query("flt09_sector_split_outliers", L + "s1_residual_s:d s2_residual_s:d s3_residual_s:d", "SELECT * FROM truth WHERE sector_split_outlier")
def _(b):
    return truth(b).filter(V.sector_split_outlier())


@query("flt10_lap_outliers", L + "lap_residual_s:d", "SELECT * FROM truth WHERE lap_outlier")
def _(b):
    return truth(b).filter(V.lap_outlier())


@query("flt11_coverage_flags", L + "start_coverage_poor:b end_coverage_poor:b", "SELECT * FROM truth WHERE start_coverage_poor OR end_coverage_poor")
def _(b):
    return V.flag_laps(truth(b).drop("start_coverage_poor", "end_coverage_poor")).filter("start_coverage_poor OR end_coverage_poor")
