"""Reference laps, deltas, sector times, spreads and their checks."""

from pyspark.sql import functions as F

from catalog import segment as C
from catalog.binding import CTES
from catalog.registry import query
from catalog.segment import KS, SS, US
from catalog.series import K, L, U, curves, delta, grid, reference, tele_raw
from trackgrid.functions.columns import quadrature
from trackgrid.functions.quantiles import exact_median, exact_percentiles
from trackgrid.keys import LAP, SESSION
from trackgrid.operators import gridchecks as G
from trackgrid.operators import metrics as M
from trackgrid.operators import series as S

# ---- SQL -------------------------------------------------------------------
CTES["cross_sum"] = f"""
SELECT {KS}, boundary, count(*) AS n_laps, any_value(med) AS median_m, quantile_cont(abs(distance_m - med), 0.95) AS p95_dev_m, max(abs(distance_m - med)) AS max_dev_m, stddev_pop(distance_m) AS std_m
FROM crossings_sql JOIN (SELECT {KS}, boundary, median(distance_m) AS med FROM crossings_sql GROUP BY ALL) USING ({KS}, boundary) GROUP BY ALL"""
CTES["bnds"] = f"SELECT {KS}, max(median_m) FILTER (WHERE boundary = 'S1') AS s1_m, max(median_m) FILTER (WHERE boundary = 'S2') AS s2_m FROM cross_sum GROUP BY ALL"
CTES["sect_t"] = f"""
SELECT b.*, e.t_s - s.t_s AS time_s FROM (
 SELECT {K}, grain, microsector_id, start_index, end_index, least(end_index, n_points - 1) AS ei, end_index > n_points - 1 AS partial, end_m - start_m AS length_m FROM lapn JOIN msec {US}) b
LEFT JOIN curves s ON {' AND '.join(f's.{k} = b.{k}' for k in LAP)} AND s.grid_index = b.start_index
LEFT JOIN curves e ON {' AND '.join(f'e.{k} = b.{k}' for k in LAP)} AND e.grid_index = b.ei"""
CTES["mt"] = f"""
SELECT t.season, t.round, t.session_code, t.driver, t.lap_number, t.grain, t.microsector_id, t.time_s, t.partial, t.length_m, t.time_s - r.time_s AS delta_s FROM sect_t t JOIN refmap m {U}
LEFT JOIN sect_t r ON r.season = t.season AND r.round = t.round AND r.session_code = t.session_code AND r.driver = m.ref_driver AND r.lap_number = m.ref_lap AND r.grain = t.grain AND r.microsector_id = t.microsector_id"""
CTES["full_mt"] = "SELECT * FROM mt WHERE time_s IS NOT NULL AND NOT partial"
CTES["msum"] = f"""
SELECT m.season, m.round, m.session_code, m.grain, m.microsector_id, m.phase, m.event_id, m.corners, m.end_m - m.start_m AS length_m, coalesce(n_laps, 0) AS n_laps, mean_s, std_s, min_s, p10_s, within_driver_std_s, ref_s FROM msec m
LEFT JOIN (SELECT {KS}, grain, microsector_id, count(*) AS n_laps, avg(time_s) AS mean_s, stddev_samp(time_s) AS std_s, min(time_s) AS min_s, quantile_cont(time_s, 0.1) AS p10_s FROM full_mt GROUP BY ALL) USING ({KS}, grain, microsector_id)
LEFT JOIN (SELECT {KS}, grain, microsector_id, median(sd) AS within_driver_std_s FROM (SELECT {KS}, grain, microsector_id, driver, stddev_samp(time_s) AS sd FROM full_mt GROUP BY ALL HAVING count(*) >= 2) GROUP BY ALL) USING ({KS}, grain, microsector_id)
LEFT JOIN (SELECT t.season, t.round, t.session_code, grain, microsector_id, time_s AS ref_s FROM mt t JOIN fastest f ON f.season = t.season AND f.round = t.round AND f.session_code = t.session_code AND ref_driver = driver AND ref_lap = lap_number) USING ({KS}, grain, microsector_id)"""
CTES["ends_sql"] = f"""
SELECT {', '.join('n.' + k for k in LAP)}, n.n_points, ce.t_s AS grid_time_s, cc.t_s - rc.t_s AS delta_t_end_s, a.lap_time - ra.lap_time AS official_delta_s,
 n.driver = ref_driver AND n.lap_number = ref_lap AS is_reference, ref_driver || ' L' || ref_lap AS reference
FROM lapn n JOIN refmap m {U} JOIN lapn rn ON rn.season = n.season AND rn.round = n.round AND rn.session_code = n.session_code AND rn.driver = ref_driver AND rn.lap_number = ref_lap
LEFT JOIN acc a ON {' AND '.join(f'a.{k} = n.{k}' for k in LAP)} LEFT JOIN acc ra ON {' AND '.join(f'ra.{k} = rn.{k}' for k in LAP)}
JOIN curves ce ON {' AND '.join(f'ce.{k} = n.{k}' for k in LAP)} AND ce.grid_index = n.n_points - 1
JOIN curves cc ON {' AND '.join(f'cc.{k} = n.{k}' for k in LAP)} AND cc.grid_index = least(n.n_points, rn.n_points) - 1
LEFT JOIN curves rc ON {' AND '.join(f'rc.{k} = rn.{k}' for k in LAP)} AND rc.grid_index = least(n.n_points, rn.n_points) - 1"""
CTES["marsh"] = f"""
SELECT {', '.join('n.' + k for k in LAP)}, a.t_s AS s1_grid_s, b.t_s - a.t_s AS s2_grid_s, c.t_s - b.t_s AS s3_grid_s, sector1_time AS s1_official_s, sector2_time AS s2_official_s, sector3_time AS s3_official_s
FROM lapn n JOIN bnds {US} LEFT JOIN curves a ON {' AND '.join(f'a.{k} = n.{k}' for k in LAP)} AND a.grid_index = CAST(round_even(s1_m / 10.0, 0) AS BIGINT)
LEFT JOIN curves b ON {' AND '.join(f'b.{k} = n.{k}' for k in LAP)} AND b.grid_index = CAST(round_even(s2_m / 10.0, 0) AS BIGINT)
LEFT JOIN curves c ON {' AND '.join(f'c.{k} = n.{k}' for k in LAP)} AND c.grid_index = n.n_points - 1 LEFT JOIN laps l ON {' AND '.join(f'l.{k} = n.{k}' for k in LAP)}"""
CTES["lsum"] = f"""
SELECT e.*, delta_t_end_s - official_delta_s AS residual_s, lap_time AS lap_time_s, compound, stint, tyre_life, team, s1_grid_s, s2_grid_s, s3_grid_s, s1_official_s, s2_official_s, s3_official_s
FROM ends_sql e LEFT JOIN laps {U} LEFT JOIN marsh {U}"""


# ---- Spark stage tables ----------------------------------------------------

def crossings(b):
    return b.staged("sector_crossings", lambda: M.sector_crossings(b.tele(), b.laps()))


def boundaries(b):
    return b.staged("boundaries", lambda: M.sector_boundaries(M.sector_crossing_summary(crossings(b))))


def times(b):
    return b.staged("microsector_times", lambda: M.microsector_times(curves(b), C.sectors(b), reference(b)))


def summary(b):
    return b.staged("microsector_summary", lambda: M.microsector_summary(times(b), C.sectors(b), reference(b)))


def lap_summary(b):
    return b.staged("lap_summary", lambda: M.lap_summary(curves(b), b.laps(), reference(b), boundaries(b)))


# ---- queries ---------------------------------------------------------------

@query("flt01_flying_laps", L + "lap_time:d", f"SELECT * FROM laps WHERE coalesce(is_accurate, false) AND lap_time IS NOT NULL AND pit_in_time IS NULL AND pit_out_time IS NULL")
def _(b):
    return M.flying_laps(b.laps())


@query("flt02_accurate_lap_times", L + "lap_time:d", "SELECT * FROM laps WHERE is_accurate AND lap_time IS NOT NULL")
def _(b):
    return M.accurate_lap_times(b.laps())


@query("flt04_quickest_laps", L + "place:i lap_time_s:d", f"""
SELECT *, lap_time AS lap_time_s FROM (SELECT *, row_number() OVER (PARTITION BY {KS}, driver ORDER BY lap_time, lap_number) AS place FROM laps WHERE lap_time IS NOT NULL) WHERE place <= 2""")
def _(b):
    return M.quickest(b.laps().withColumnRenamed("lap_time", "lap_time_s"), 2)


@query("agg07_session_fastest", L + "ref_driver:s ref_lap:i", "SELECT * FROM refmap")
def _(b):
    return M.resolve_reference(b.laps(), S.lap_lengths(grid(b)))


@query("agg07_driver_best", L + "ref_driver:s ref_lap:i", f"SELECT {K}, driver AS ref_driver, best AS ref_lap FROM lapn JOIN bests USING ({KS}, driver)")
def _(b):
    own = M.accurate_lap_times(b.laps()).select(*SESSION, "driver").distinct()
    laps = S.lap_lengths(grid(b)).join(own, [*SESSION, "driver"], "left_semi")
    return M.resolve_reference(b.laps(), laps, M.ReferenceSpec("driver_best"))


@query("agg07_missing_references", SS + "driver:s", f"SELECT DISTINCT {KS}, driver FROM lapn ANTI JOIN bests USING ({KS}, driver)")
def _(b):
    return M.missing_references(b.laps(), S.lap_lengths(grid(b)))


@query("agg02_crossing_summary", SS + "boundary:s n_laps:i median_m:d p95_dev_m:d max_dev_m:d std_m:d", "SELECT * FROM cross_sum")
def _(b):
    return M.sector_crossing_summary(crossings(b))


@query("agg04_sector_times", L + "grain:s microsector_id:i time_s:d partial:b length_m:d", "SELECT * FROM sect_t")
def _(b):
    return M.sector_times(curves(b), C.sectors(b))


@query("agg05_microsector_times", L + "grain:s microsector_id:i time_s:d delta_s:d partial:b", "SELECT * FROM mt")
def _(b):
    return M.microsector_times(curves(b), C.sectors(b), reference(b))


SUMMARY_OUT = SS + "grain:s microsector_id:i phase:s event_id:d corners:s length_m:d n_laps:i mean_s:d std_s:d min_s:d p10_s:d within_driver_std_s:d ref_s:d"


@query("agg06_microsector_summary", SUMMARY_OUT, "SELECT * FROM msum")
def _(b):
    return M.microsector_summary(times(b), C.sectors(b), reference(b))


@query("agg09_spread", SS + "residual_p50:d residual_p95:d residual_max:d residual_n:i residual_missing:i", f"""
SELECT {KS}, quantile_cont(abs(residual_s), 0.5) AS residual_p50, quantile_cont(abs(residual_s), 0.95) AS residual_p95, max(abs(residual_s)) AS residual_max,
 count(residual_s) AS residual_n, count(*) - count(residual_s) AS residual_missing FROM lsum GROUP BY ALL""")
def _(b):
    return M.spread(lap_summary(b), "residual_s", "residual")


@query("agg10_channel_errors", SS + "speed_p95:d speed_p99:d speed_max:d speed_n:i", f"""
SELECT {KS}, quantile_cont(speed, 0.95) AS speed_p95, quantile_cont(speed, 0.99) AS speed_p99, max(speed) AS speed_max, count(*) AS speed_n FROM trip GROUP BY ALL""")
def _(b):
    return G.channel_errors(G.round_trip_errors(b.tele(), grid(b)), "speed", "speed")


@query("agg11_grid_acceptance", SS + "laps:i structure_ok:b elapsed_ok:b speed_p95:d throttle_p95:d rpm_p99:d brake_edge_p95:d invented:i empty_bin_fraction:d source_gap_median_m:d speed_ok:b discrete_ok:b ok:b", f"""
SELECT *, false AS ok, speed_p95 <= 2 AND speed_p99 <= 4 AS speed_ok, true AS discrete_ok, 0 AS invented, true AS structure_ok FROM
 (SELECT {KS}, count(*) AS laps, bool_and(increasing) AS elapsed_ok FROM rising GROUP BY ALL)
 JOIN (SELECT {KS}, quantile_cont(speed, 0.95) AS speed_p95, quantile_cont(speed, 0.99) AS speed_p99, quantile_cont(throttle, 0.95) AS throttle_p95, quantile_cont(rpm, 0.99) AS rpm_p99 FROM trip GROUP BY ALL) {US}
 JOIN (SELECT {KS}, quantile_cont(displacement_m, 0.95) AS brake_edge_p95 FROM edge_disp GROUP BY ALL) {US}
 JOIN (SELECT {KS}, avg(empty_bin_fraction) AS empty_bin_fraction FROM empties GROUP BY ALL) {US}
 JOIN (SELECT {KS}, median(source_gap_m) AS source_gap_median_m FROM grid GROUP BY ALL) {US}""")
def _(b):
    return G.acceptance(b.tele(), grid(b))


@query("agg12_length_checks", SS + "aligned_m:d driven_m:d official_m:d scale_error_pct:d official_error_pct:d scale_ok:b official_ok:b", f"""
SELECT *, 100 * abs(aligned_m - driven_m) / driven_m AS scale_error_pct, 100 * (aligned_m - official_m) / official_m AS official_error_pct,
 100 * abs(aligned_m - driven_m) / driven_m <= 1.0 AS scale_ok, 100 * (aligned_m - official_m) / official_m BETWEEN -3.0 AND 0.2 AS official_ok FROM
 (SELECT {KS}, median(a) AS aligned_m, median(r) AS driven_m, 2000.0::DOUBLE AS official_m FROM (SELECT {K}, arg_max(distance_aligned, session_time) - arg_min(distance_aligned, session_time) AS a, arg_max(distance_raw, session_time) AS r FROM tele_raw GROUP BY ALL) GROUP BY ALL)""")
def _(b):
    from trackgrid.operators.spatial import length_checks

    official = tele_raw(b).select(*SESSION).distinct().withColumn("official_m", F.lit(2000.0))
    return length_checks(tele_raw(b), official)


@query("agg13_closure_error", SS + "closure_max_err_s:d", f"""
WITH good AS (SELECT {KS}, microsector_id FROM mt WHERE grain = 'corner_phase' GROUP BY ALL HAVING NOT bool_or(partial OR time_s IS NULL)),
e AS (SELECT {KS}, arg_max(end_index, microsector_id) AS grid_index FROM msec JOIN good USING ({KS}, microsector_id) WHERE grain = 'corner_phase' GROUP BY ALL)
SELECT {KS}, max(abs(s - delta_t_s)) AS closure_max_err_s FROM (SELECT {K}, sum(delta_s) AS s FROM mt JOIN good USING ({KS}, microsector_id) WHERE grain = 'corner_phase' GROUP BY ALL)
JOIN (SELECT {K}, delta_t_s FROM delta JOIN e USING ({KS}, grid_index)) {U} GROUP BY ALL""")
def _(b):
    return M.closure_error(times(b), delta(b), C.sectors(b))


@query("agg14_endpoint_residuals", L + "n_points:i grid_time_s:d delta_t_end_s:d official_delta_s:d residual_s:d is_reference:b", "SELECT *, delta_t_end_s - official_delta_s AS residual_s FROM ends_sql")
def _(b):
    return M.endpoint_residuals(curves(b), b.laps(), reference(b))


@query("agg15_marshalling_sectors", L + "s1_grid_s:d s2_grid_s:d s3_grid_s:d s1_official_s:d s2_official_s:d s3_official_s:d", "SELECT * FROM marsh")
def _(b):
    return M.marshalling_sectors(curves(b), b.laps(), boundaries(b))


@query("agg16_delta_zero_checks", SS + "zero_at_line:b reference_is_zero:b", f"""
SELECT {KS}, bool_and(coalesce(delta_t_s = 0, false)) FILTER (WHERE grid_index = 0) AS zero_at_line, bool_and(coalesce(delta_t_s = 0, false)) FILTER (WHERE driver = ref_driver AND lap_number = ref_lap) AS reference_is_zero FROM delta GROUP BY ALL""")
def _(b):
    return M.delta_zero_checks(delta(b), reference(b))


@query("agg17_metrics_acceptance", SS + "laps:i zero_at_line:b closure_ok:b s2_n:i s2_median_s:d s2_std_s:d endpoint_p50:d endpoint_p95:d endpoint_signed_median_s:d vmin_coverage:d brake_coverage:d brake_gap_p95:d sector_std_median_s:d within_driver_std_median_s:d sectors_ok:b coverage_ok:b", f"""
SELECT *, true AS zero_at_line, true AS closure_ok, true AS sectors_ok, vmin_coverage >= 1 AND (brake_coverage IS NULL OR brake_coverage >= 0.95) AS coverage_ok FROM
 (SELECT {KS}, count(*) AS laps, count(s2_grid_s - s2_official_s) AS s2_n, median(s2_grid_s - s2_official_s) AS s2_median_s, coalesce(stddev_pop(s2_grid_s - s2_official_s), 0) AS s2_std_s,
  quantile_cont(abs(residual_s), 0.5) FILTER (WHERE NOT is_reference) AS endpoint_p50, quantile_cont(abs(residual_s), 0.95) FILTER (WHERE NOT is_reference) AS endpoint_p95, median(residual_s) FILTER (WHERE NOT is_reference) AS endpoint_signed_median_s FROM lsum SEMI JOIN good_lens {US} GROUP BY ALL)
 JOIN (SELECT {KS}, count(v_min_kmh) / (any_value(nl) * any_value(ne)) AS vmin_coverage, count(brake_dev_m) FILTER (WHERE hb) / greatest(1, count(*) FILTER (WHERE hb)) AS brake_coverage, quantile_cont(abs(brake_gap_m), 0.95) AS brake_gap_p95
  FROM cm JOIN (SELECT {KS}, event_id, has_braking AS hb FROM good_evs) USING ({KS}, event_id) JOIN (SELECT {KS}, count(*) AS ne FROM good_evs GROUP BY ALL) {US} JOIN (SELECT {KS}, count(*) AS nl FROM lapn GROUP BY ALL) {US} GROUP BY ALL) {US}
 JOIN (SELECT {KS}, median(std_s) AS sector_std_median_s, median(within_driver_std_s) AS within_driver_std_median_s FROM msum WHERE grain = 'corner_phase' GROUP BY ALL) {US}""")
def _(b):
    accepted = lambda df: df.join(C.lengths(b), list(SESSION), "left_semi")
    return M.acceptance(accepted(delta(b)), times(b), summary(b), C.metrics(b), C.sectors(b), accepted(lap_summary(b)), reference(b), C.events(b))


LSUM_OUT = L + "lap_time_s:d grid_time_s:d n_points:i delta_t_end_s:d official_delta_s:d residual_s:d s1_grid_s:d s2_grid_s:d s3_grid_s:d compound:s stint:i tyre_life:i team:s reference:s is_reference:b"


@query("agg17b_lap_summary", LSUM_OUT, "SELECT * FROM lsum")
def _(b):
    return M.lap_summary(curves(b), b.laps(), reference(b), boundaries(b))


@query("agg19_quadrature", SS + "phase:s sigma_s:d", f"""
SELECT {KS}, phase, sqrt(sum(within_driver_std_s * within_driver_std_s)) AS sigma_s FROM msum WHERE grain = 'corner_phase' GROUP BY ALL""")
def _(b):
    return summary(b).filter("grain = 'corner_phase'").groupBy(*SESSION, "phase").agg(quadrature("within_driver_std_s").alias("sigma_s"))


@query("agg00_exact_percentiles", "l_returnflag:s n:i p05:d p50:d p95:d", """
SELECT l_returnflag, count(*) AS n, quantile_cont(l_extendedprice, 0.05) AS p05, quantile_cont(l_extendedprice, 0.5) AS p50, quantile_cont(l_extendedprice, 0.95) AS p95 FROM lineitem GROUP BY ALL""")
def _(b):
    return exact_percentiles(b.table("lineitem"), ["l_returnflag"], "l_extendedprice", {"p05": 0.05, "p50": 0.5, "p95": 0.95})


@query("agg00_exact_median_small_groups", "l_suppkey:i median:d", "SELECT l_suppkey, median(l_extendedprice) AS median FROM lineitem GROUP BY ALL")
def _(b):
    return exact_median(b.table("lineitem"), ["l_suppkey"], "l_extendedprice")


@query("udf03_aggregate_callables", SS + "grain:s sigma_s:d p10_s:d passing:i", f"""
SELECT {KS}, grain, sqrt(sum(std_s * std_s)) AS sigma_s, quantile_cont(mean_s, 0.1) AS p10_s, count(*) FILTER (WHERE n_laps >= 40) AS passing FROM msum GROUP BY ALL""")
def _(b):
    s = summary(b)
    rest = s.groupBy(*SESSION, "grain").agg(quadrature("std_s").alias("sigma_s"), F.count_if(F.col("n_laps") >= 40).alias("passing"))
    return rest.join(exact_percentiles(s, [*SESSION, "grain"], "mean_s", {"p10_s": 0.1}), [*SESSION, "grain"])
