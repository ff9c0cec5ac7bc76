"""Median traces, corner events and micro-sectors."""

from pyspark.sql import functions as F

from catalog.binding import CTES
from catalog.registry import query
from catalog.series import K, L, U, curves, grid, quick, reference
from trackgrid.functions.columns import corner_label, in_closed_window, in_half_open_window, parse_corner_label
from trackgrid.keys import LAP, SESSION
from trackgrid.operators import segment as E

SS = "season:i round:i session_code:s "
KS = "season, round, session_code"
US = f"USING ({KS})"

CTES["traces"] = f"""
SELECT {KS}, grid_index, speed, brake, throttle, n_laps FROM (SELECT *, row_number() OVER (PARTITION BY {KS} ORDER BY grid_index) AS rn FROM
 (SELECT {KS}, grid_index, median(speed) AS speed, avg(brake::INT::DOUBLE) AS brake, median(throttle) AS throttle, count(*) AS n_laps FROM grid GROUP BY ALL)
 JOIN (SELECT {KS}, count(*) AS laps FROM lapn GROUP BY ALL) {US} WHERE n_laps >= greatest(1, ceil(0.8 * laps))) WHERE rn - 1 = grid_index"""
CTES["lens"] = f"SELECT {KS}, count(*) AS n, count(*) * 10.0::DOUBLE AS lap_length_m FROM traces GROUP BY ALL"
CTES["unw"] = f"SELECT {KS}, n, grid_index + n * c AS j, speed, brake, throttle FROM traces JOIN lens {US} CROSS JOIN (VALUES (-1), (0), (1)) v(c)"
CTES["cand"] = f"""
SELECT b.season, b.round, b.session_code, b.n, b.j AS i, b.speed AS v FROM unw b
JOIN unw a ON a.season = b.season AND a.round = b.round AND a.session_code = b.session_code AND a.j = b.j - 1
JOIN unw c ON c.season = b.season AND c.round = b.round AND c.session_code = b.session_code AND c.j = b.j + 1
WHERE b.j BETWEEN 0 AND b.n - 1 AND b.speed < a.speed AND b.speed <= c.speed"""
CTES["troughs"] = f"""
SELECT *, row_number() OVER (PARTITION BY {KS} ORDER BY i) - 1 AS trough_id FROM (
 SELECT {KS}, n, i, v, least(max(u.speed) FILTER (WHERE u.j < i AND u.j > ls), max(u.speed) FILTER (WHERE u.j > i AND u.j < rs)) - v AS prominence FROM
  (SELECT {KS}, c.n, i, v, coalesce(max(u.j) FILTER (WHERE u.j < i AND u.speed < v), i - c.n) AS ls, coalesce(min(u.j) FILTER (WHERE u.j > i AND u.speed < v), i + c.n) AS rs
   FROM cand c JOIN unw u {US} WHERE u.j > i - c.n AND u.j < i + c.n GROUP BY {KS}, c.n, i, v)
  JOIN unw u USING ({KS}, n) WHERE u.j > i - n AND u.j < i + n GROUP BY {KS}, n, i, v) WHERE prominence >= 8.0"""
CTES["tro2"] = f"""
SELECT *, coalesce(lag(i) OVER w, max(i) OVER (PARTITION BY {KS}) - n) AS ip, coalesce(lead(i) OVER w, min(i) OVER (PARTITION BY {KS}) + n) AS nx
FROM troughs WINDOW w AS (PARTITION BY {KS} ORDER BY i)"""
CTES["ev1"] = f"""
SELECT {KS}, n, i, v, prominence, trough_id, ip, nx, coalesce(arg_min(u.j, (-u.speed, u.j)) FILTER (WHERE u.j > ip AND u.j < i), i) AS left_max,
 coalesce(max(u.j) FILTER (WHERE u.j > ip AND u.j < i AND u.speed > v + 0.05 * prominence), ip) + 1 AS a0,
 coalesce(min(u.j) FILTER (WHERE u.j > i AND u.j < nx AND u.speed > v + 0.05 * prominence), nx) AS a1
FROM tro2 t JOIN unw u USING ({KS}, n) GROUP BY {KS}, n, i, v, prominence, trough_id, ip, nx"""
CTES["ev2"] = f"""
SELECT {KS}, n, i, v, prominence, trough_id, ip, nx, left_max, a0, a1, min(u.j) FILTER (WHERE u.j BETWEEN left_max AND i AND u.brake >= 0.5) AS brake_on,
 max(u.j) FILTER (WHERE u.j BETWEEN left_max AND i AND u.brake >= 0.5) + 1 AS brake_off,
 least(coalesce(max(u.j) FILTER (WHERE u.j BETWEEN left_max AND a0 AND u.throttle >= 90) + 1, left_max), a0) AS lift,
 min(u.j) FILTER (WHERE u.j >= a1 AND u.j < nx AND u.speed >= v + 0.5 * prominence) AS hit
FROM ev1 e JOIN unw u USING ({KS}, n) GROUP BY {KS}, n, i, v, prominence, trough_id, ip, nx, left_max, a0, a1"""
CTES["ev3"] = f"""
SELECT *, greatest(least(coalesce(hit, nl), ns), a1) AS exit_end FROM
 (SELECT *, coalesce(lead(left_max) OVER w, first(left_max) OVER w2 + n) AS nl, coalesce(lead(st) OVER w, first(st) OVER w2 + n) AS ns FROM
  (SELECT *, least(lift, brake_on, a0) AS st FROM ev2) WINDOW w AS (PARTITION BY {KS} ORDER BY i), w2 AS (PARTITION BY {KS} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""
# corners: every nation is a corner of every session
CTES["corn"] = f"""
SELECT {KS}, n_nationkey + 1 AS number, CASE WHEN n_nationkey % 2 = 1 THEN 'a' ELSE '' END AS letter, floor((40.0 + 78.0 * n_nationkey) / 10.0) * 10.0::DOUBLE AS distance_m,
 (n_nationkey % 7)::DOUBLE AS line_offset_m, 40.0 + 78.0 * n_nationkey AS raw_distance_m
FROM nation CROSS JOIN (SELECT DISTINCT {KS} FROM tele)"""
CTES["lbl"] = f"""
SELECT {KS}, trough_id AS event_id, string_agg('T' || number || letter, '-' ORDER BY distance_m) AS corners FROM ev3 JOIN corn {US}
WHERE CASE WHEN pe >= ps THEN distance_m BETWEEN ps AND pe ELSE distance_m >= ps OR distance_m <= pe END GROUP BY ALL""".replace(
    "FROM ev3", f"FROM (SELECT *, ((st * 10.0 - 30) % (n * 10) + n * 10) % (n * 10) AS ps, ((exit_end * 10.0 + 30) % (n * 10) + n * 10) % (n * 10) AS pe FROM ev3)")
_M = lambda c, a: f"(({c} % n + n) % n) * 10.0::DOUBLE AS {a}"
CTES["evs"] = f"""
SELECT e.season, e.round, e.session_code, trough_id AS event_id, {_M('i', 'apex_m')}, v AS v_min_kmh, prominence AS prominence_kmh, {_M('left_max', 'left_max_m')},
 {_M('lift', 'lift_m')}, {_M('brake_on', 'brake_on_m')}, {_M('brake_off', 'brake_off_m')}, {_M('a0', 'apex_start_m')}, {_M('a1', 'apex_end_m')}, {_M('exit_end', 'exit_end_m')},
 brake_on IS NOT NULL AS has_braking, corners, prominence < 16.0 AS marginal FROM ev3 e LEFT JOIN lbl l ON l.season = e.season AND l.round = e.round AND l.session_code = e.session_code AND l.event_id = trough_id"""


def _unwrap(c):
    return f"CASE WHEN {c} - apex_m > lap_length_m / 2 THEN {c} - lap_length_m WHEN apex_m - {c} > lap_length_m / 2 THEN {c} + lap_length_m ELSE {c} END"


CTES["ivl"] = f"""
WITH b AS (SELECT *, {', '.join(_unwrap(c) + ' AS u_' + c for c in ('lift_m', 'brake_on_m', 'brake_off_m', 'apex_start_m', 'apex_end_m', 'exit_end_m'))} FROM evs JOIN lens {US})
SELECT * FROM (
 SELECT {KS}, event_id, corners, marginal, lap_length_m, 'braking' AS phase, u_brake_on_m AS s, least(u_brake_off_m, u_apex_start_m) AS e FROM b WHERE has_braking
 UNION ALL SELECT {KS}, event_id, corners, marginal, lap_length_m, 'entry', CASE WHEN has_braking THEN u_brake_off_m ELSE u_lift_m END, u_apex_start_m FROM b
 UNION ALL SELECT {KS}, event_id, corners, marginal, lap_length_m, 'apex', u_apex_start_m, u_apex_end_m FROM b
 UNION ALL SELECT {KS}, event_id, corners, marginal, lap_length_m, 'exit', u_apex_end_m, u_exit_end_m FROM b) WHERE e > s"""
CTES["pieces"] = f"""
SELECT * FROM (SELECT {KS}, event_id, corners, marginal, lap_length_m, phase, CASE WHEN s < 0 THEN s + lap_length_m ELSE s END AS start_m,
  CASE WHEN s < 0 THEN least(e, 0) + lap_length_m ELSE least(e, lap_length_m) END AS end_m FROM ivl
 UNION ALL SELECT {KS}, event_id, corners, marginal, lap_length_m, phase, 0, CASE WHEN s < 0 THEN e ELSE e - lap_length_m END FROM ivl WHERE (s < 0 AND e > 0) OR (s >= 0 AND e > lap_length_m)) WHERE end_m > start_m"""
CTES["ovl"] = f"""
SELECT {KS}, 'phases overlap at ' || CAST(round(min(start_m)) AS INT) || ' m' AS reason FROM
 (SELECT *, lag(end_m) OVER (PARTITION BY {KS} ORDER BY start_m, end_m) AS before FROM pieces) WHERE start_m < before - 1e-6 GROUP BY ALL"""
CTES["good_evs"] = f"SELECT e.* FROM evs e ANTI JOIN ovl {US}"
CTES["good_lens"] = f"SELECT l.* FROM lens l ANTI JOIN ovl {US}"
CTES["good_pieces"] = f"SELECT p.* FROM pieces p ANTI JOIN ovl {US}"
CTES["msec"] = f"""
WITH p AS (SELECT *, lag(end_m) OVER (PARTITION BY {KS} ORDER BY start_m) AS before FROM good_pieces),
r AS (SELECT {KS}, phase, event_id, start_m, end_m, corners, marginal FROM p
 UNION ALL SELECT {KS}, 'straight', NULL, coalesce(before, 0), start_m, NULL, false FROM p WHERE start_m > coalesce(before, 0) + 1e-6
 UNION ALL SELECT {KS}, 'straight', NULL, coalesce(le, 0), lap_length_m, NULL, false FROM good_lens LEFT JOIN (SELECT {KS}, max(end_m) AS le FROM p GROUP BY ALL) {US} WHERE lap_length_m > coalesce(le, 0) + 1e-6),
f AS (SELECT {KS}, 'bin', NULL::INT, i * 100.0::DOUBLE, least((i + 1) * 100.0::DOUBLE, lap_length_m), NULL::VARCHAR, false FROM
 (SELECT {KS}, lap_length_m, unnest(generate_series(0, CAST(ceil(lap_length_m / 100.0 - 1e-9) AS BIGINT) - 1)) AS i FROM good_lens)),
a AS (SELECT 'corner_phase' AS grain, * FROM r UNION ALL SELECT 'fixed_100m', * FROM f)
SELECT *, row_number() OVER (PARTITION BY {KS}, grain ORDER BY start_m) - 1 AS microsector_id, CAST(round_even(start_m / 10.0, 0) AS BIGINT) AS start_index, CAST(round_even(end_m / 10.0, 0) AS BIGINT) AS end_index FROM a"""


# ---- Spark stage tables ----------------------------------------------------

def traces(b):
    return b.staged("traces", lambda: E.median_traces(grid(b)))


def lengths(b):
    return E.lap_length(traces(b)).join(refused(b), list(SESSION), "left_anti")


def corners(b):
    n = F.col("n_nationkey")
    nations = b.table("nation").select(
        "n_nationkey",
        (n + 1).cast("int").alias("number"), F.when(n % 2 == 1, "a").otherwise("").alias("letter"),
        (F.floor((40.0 + 78.0 * n) / 10.0) * 10.0).alias("distance_m"), (n % 7).cast("double").alias("line_offset_m"), (40.0 + 78.0 * n).alias("raw_distance_m"),
    )
    # 25 places per session, whatever its season, each of which is one nation's
    places = grid(b).select(*SESSION).distinct().withColumn("n_nationkey", F.explode(F.sequence(F.lit(0), F.lit(24))))
    return b.staged("corners", lambda: places.join(nations, "n_nationkey").drop("n_nationkey"))


def all_events(b):
    return b.staged("events_found", lambda: E.detect_events(traces(b), corners(b)))


def refused(b):
    return b.staged("refused", lambda: E.phase_overlaps(all_events(b), E.lap_length(traces(b))))


def events(b):
    return all_events(b).join(refused(b), list(SESSION), "left_anti")


def sectors(b):
    return b.staged("sectors", lambda: E.microsectors(events(b), lengths(b)))


def metrics(b):
    return b.staged("corner_metrics", lambda: E.corner_metrics(grid(b), events(b), lengths(b)))


# ---- queries ---------------------------------------------------------------

@query("agg01_median_traces", SS + "grid_index:i speed:d brake:d throttle:d n_laps:i", "SELECT * FROM traces")
def _(b):
    return E.median_traces(grid(b))


@query("seg01_find_troughs", SS + "trough_id:i i:i v:d prominence:d", "SELECT * FROM troughs")
def _(b):
    return E.find_troughs(traces(b))


@query("seg02_left_max", SS + "event_id:i left_max:i", "SELECT *, trough_id AS event_id FROM ev1")
def _(b):
    return E.raw_events(traces(b))


@query("seg03_brake_zone", SS + "event_id:i brake_on:d brake_off:d", "SELECT *, trough_id AS event_id FROM ev2")
def _(b):
    return E.raw_events(traces(b))


@query("seg04_apex_band", SS + "event_id:i a0:i a1:i", "SELECT *, trough_id AS event_id FROM ev1")
def _(b):
    return E.raw_events(traces(b))


@query("seg05_lift", SS + "event_id:i lift:i", "SELECT *, trough_id AS event_id FROM ev2")
def _(b):
    return E.raw_events(traces(b))


@query("seg06_exit_end", SS + "event_id:i exit_end:i start_index:i", "SELECT *, trough_id AS event_id, st AS start_index FROM ev3")
def _(b):
    return E.raw_events(traces(b)).withColumnRenamed("start", "start_index")


EVENT_OUT = SS + "event_id:i apex_m:d v_min_kmh:d prominence_kmh:d left_max_m:d lift_m:d brake_on_m:d brake_off_m:d apex_start_m:d apex_end_m:d exit_end_m:d has_braking:b corners:s marginal:b"


@query("seg06b_detect_events", EVENT_OUT, "SELECT * FROM evs")
def _(b):
    return E.detect_events(traces(b), corners(b))


@query("seg07_event_rows", SS + "event_id:i apex_m:d marginal:b", "SELECT * FROM evs")
def _(b):
    return E.detect_events(traces(b))


@query("seg08_event_labels", SS + "event_id:i corners:s", "SELECT * FROM lbl")
def _(b):
    return E.label_events(E.raw_events(traces(b)), corners(b))


@query("seg09_corner_labels", SS + "label:s numbers:s", f"""
SELECT {KS}, string_agg('T' || number || letter, '-' ORDER BY distance_m) AS label, string_agg(number::VARCHAR, ',' ORDER BY distance_m) AS numbers FROM corn GROUP BY ALL""")
def _(b):
    packed = corners(b).groupBy(*SESSION).agg(F.array_sort(F.collect_list(F.struct("distance_m", "number", "letter"))).alias("c"))
    named = packed.select(*SESSION, corner_label(F.col("c")).alias("label"))
    return named.withColumn("numbers", F.array_join(parse_corner_label("label").cast("array<string>"), ","))


@query("seg10_corner_event_ids", SS + "number:i event_id:d", f"""
SELECT season, round, session_code, number, min(event_id) AS event_id FROM corn LEFT JOIN (SELECT {KS}, event_id, CAST(regexp_extract(unnest(string_split(corners, '-')), 'T(\\d+)', 1) AS INT) AS number FROM good_evs) e USING (season, round, session_code, number) GROUP BY ALL""")
def _(b):
    return E.corner_event_ids(corners(b), events(b))


@query("seg11_event_intervals", SS + "event_id:i phase:s s:d e:d", "SELECT * FROM ivl")
def _(b):
    return E.event_intervals(all_events(b), E.lap_length(traces(b)))


@query("seg12_split_at_line", SS + "event_id:i phase:s start_m:d end_m:d", "SELECT * FROM pieces")
def _(b):
    return E.split_at_line(E.event_intervals(all_events(b), E.lap_length(traces(b))))


@query("seg13_phase_overlaps", SS + "reason:s", "SELECT * FROM ovl")
def _(b):
    return E.phase_overlaps(all_events(b), E.lap_length(traces(b)))


SECTOR_OUT = SS + "grain:s microsector_id:i phase:s event_id:d start_m:d end_m:d start_index:i end_index:i corners:s marginal:b"


@query("seg13_corner_phases", SECTOR_OUT, "SELECT * FROM msec WHERE grain = 'corner_phase'")
def _(b):
    return E.corner_phases(events(b), lengths(b))


@query("seg14_fixed_bins", SECTOR_OUT, "SELECT * FROM msec WHERE grain = 'fixed_100m'")
def _(b):
    return E.fixed_bins(lengths(b))


@query("seg15_sector_index", SS + "grain:s microsector_id:i start_index:i end_index:i", "SELECT * FROM msec")
def _(b):
    return E.microsectors(events(b), lengths(b))


@query("seg16_check_partition", SS + "grain:s sectors:i partition_ok:b", f"""
SELECT {KS}, grain, count(*) AS sectors, min(start_m) = 0 AND max(end_m) = any_value(lap_length_m) AND sum(end_m - start_m) = any_value(lap_length_m) AND bool_and(end_m - start_m >= 10) AS partition_ok
FROM msec JOIN good_lens {US} GROUP BY ALL""")
def _(b):
    return E.check_partition(sectors(b), lengths(b))


CTES["wina"] = f"""
SELECT g.*, e.event_id, e.apex_m, n * 10.0::DOUBLE AS len FROM grid g JOIN
 (SELECT *, ((apex_start_m - 30) % lap_length_m + lap_length_m) % lap_length_m AS ws, ((apex_end_m + 30) % lap_length_m + lap_length_m) % lap_length_m AS we FROM good_evs JOIN good_lens {US}) e {US}
WHERE CASE WHEN we > ws THEN distance_m >= ws AND distance_m < we ELSE distance_m >= ws OR distance_m < we END"""
_DEV = "x - len * round_even(x / len, 0)"
CTES["apexes"] = f"""
SELECT {K}, event_id, {_DEV} AS apex_dev_m, v_min_kmh FROM (SELECT {K}, event_id, arg_min(distance_m, (speed, distance_m)) - any_value(apex_m) AS x, min(speed) AS v_min_kmh, any_value(len) AS len FROM wina GROUP BY ALL)"""
CTES["brakes"] = f"""
WITH w AS (SELECT *, ((brake_on_m - 50) % lap_length_m + lap_length_m) % lap_length_m AS ws, apex_start_m % lap_length_m AS we FROM good_evs JOIN good_lens {US} WHERE has_braking),
h AS (SELECT {K}, event_id, min(distance_m) AS d FROM grid g JOIN w {US} WHERE brake AND CASE WHEN we > ws THEN distance_m >= ws AND distance_m < we ELSE distance_m >= ws OR distance_m < we END GROUP BY ALL)
SELECT {K}, event_id, {_DEV} AS brake_dev_m FROM (SELECT {K}, event_id, d - brake_on_m AS x, lap_length_m AS len FROM lapn JOIN w {US} LEFT JOIN h USING ({K}, event_id))"""
CTES["cm"] = f"""
SELECT q.*, g.source_gap_m AS brake_gap_m FROM (
 SELECT {K}, event_id, corners, marginal, apexes.v_min_kmh, ((apex_m + apex_dev_m) % lap_length_m + lap_length_m) % lap_length_m AS v_min_m, apex_dev_m,
  ((e.brake_on_m + brake_dev_m) % lap_length_m + lap_length_m) % lap_length_m AS brake_on_m, brake_dev_m
 FROM apexes JOIN good_evs e USING ({KS}, event_id) JOIN good_lens {US} LEFT JOIN brakes USING ({K}, event_id)) q
LEFT JOIN grid g ON {' AND '.join(f'g.{k} = q.{k}' for k in LAP)} AND g.grid_index = CAST(round_even(q.brake_on_m / 10.0, 0) AS BIGINT)"""


@query("seg17_per_lap_apex", L + "event_id:i apex_dev_m:d v_min_kmh:d", "SELECT * FROM apexes")
def _(b):
    return E.per_lap_apex(grid(b), events(b), lengths(b))


@query("seg18_per_lap_brake", L + "event_id:i brake_dev_m:d", "SELECT * FROM brakes")
def _(b):
    return E.per_lap_brake(grid(b), events(b), lengths(b))


@query("seg19_corner_metrics", L + "event_id:i corners:s marginal:b v_min_kmh:d v_min_m:d apex_dev_m:d brake_on_m:d brake_dev_m:d brake_gap_m:d", "SELECT * FROM cm")
def _(b):
    return E.corner_metrics(grid(b), events(b), lengths(b))


@query("seg19b_segment_session", SS + "events:i phases:i bins:i labelled:i", f"""
SELECT {KS}, (SELECT count(*) FROM good_evs e WHERE e.season = l.season AND e.round = l.round AND e.session_code = l.session_code) AS events,
 (SELECT count(*) FROM msec m WHERE m.season = l.season AND m.round = l.round AND m.session_code = l.session_code AND grain = 'corner_phase') AS phases,
 (SELECT count(*) FROM msec m WHERE m.season = l.season AND m.round = l.round AND m.session_code = l.session_code AND grain = 'fixed_100m') AS bins,
 (SELECT count(corners) FROM good_evs e WHERE e.season = l.season AND e.round = l.round AND e.session_code = l.session_code) AS labelled FROM good_lens l""")
def _(b):
    from trackgrid.plans.session import segment_session

    out = segment_session(grid(b), corners(b))
    e = out["events"].groupBy(*SESSION).agg(F.count(F.lit(1)).alias("events"), F.count("corners").alias("labelled"))
    m = out["microsectors"].groupBy(*SESSION).agg(F.count_if(F.col("grain") == "corner_phase").alias("phases"), F.count_if(F.col("grain") == "fixed_100m").alias("bins"))
    return e.join(m, list(SESSION))


_SPREAD = lambda c, p: f"quantile_cont(abs({c}), 0.5) AS {p}_p50, quantile_cont(abs({c}), 0.95) AS {p}_p95, max(abs({c})) AS {p}_max, count({c}) AS {p}_n, count(*) - count({c}) AS {p}_missing"


@query("seg20_segmentation_spreads", SS + "apex_p50:d apex_p95:d apex_max:d apex_n:i brake_p50:d brake_p95:d brake_n:i brake_missing:i", f"""
SELECT * FROM (SELECT {KS}, {_SPREAD('apex_dev_m', 'apex')} FROM apexes GROUP BY ALL) JOIN (SELECT {KS}, {_SPREAD('brake_dev_m', 'brake')} FROM brakes GROUP BY ALL) {US}""")
def _(b):
    from trackgrid.operators.metrics import spread

    apex = spread(E.per_lap_apex(grid(b), events(b), lengths(b)), "apex_dev_m", "apex")
    return apex.join(spread(E.per_lap_brake(grid(b), events(b), lengths(b)), "brake_dev_m", "brake"), list(SESSION))


@query("seg20_segmentation_report", SS + "events:i partition_ok:b fixed_bins_ok:b fixed_bins:i apex_p95:d brake_p95:d corner_offset_max_m:d corners_without_event:i events_without_corners:i corners_ok:b")
def _(b):
    return E.acceptance(grid(b), corners(b), events(b), sectors(b), lengths(b), trials=4)


@query("agg24_jackknife", SS + "trial:i event_id:d count_match:b apex_shift_m:d brake_on_shift_m:d exit_end_shift_m:d")
def _(b):
    return E.jackknife(grid(b), events(b), trials=4)


@query("flt12_closed_window", SS + "event_id:i number:i", f"""
SELECT {KS}, event_id, number FROM good_evs JOIN good_lens {US} JOIN corn {US} WHERE CASE WHEN (exit_end_m + 30) % lap_length_m >= (left_max_m - 30 + lap_length_m) % lap_length_m
 THEN distance_m BETWEEN (left_max_m - 30 + lap_length_m) % lap_length_m AND (exit_end_m + 30) % lap_length_m ELSE distance_m >= (left_max_m - 30 + lap_length_m) % lap_length_m OR distance_m <= (exit_end_m + 30) % lap_length_m END""")
def _(b):
    e = events(b).join(lengths(b), list(SESSION)).join(corners(b).drop("letter").withColumnRenamed("distance_m", "cd"), list(SESSION))
    return e.filter(in_closed_window(F.col("cd"), F.col("left_max_m") - 30, F.col("exit_end_m") + 30, F.col("lap_length_m")))


@query("flt13_half_open_window", SS + "event_id:i number:i", f"""
SELECT {KS}, event_id, number FROM good_evs JOIN good_lens {US} JOIN corn {US} WHERE CASE WHEN apex_end_m % lap_length_m > (left_max_m - 500 + lap_length_m) % lap_length_m
 THEN distance_m >= (left_max_m - 500 + lap_length_m) % lap_length_m AND distance_m < apex_end_m ELSE distance_m >= (left_max_m - 500 + lap_length_m) % lap_length_m OR distance_m < apex_end_m END""")
def _(b):
    e = events(b).join(lengths(b), list(SESSION)).join(corners(b).drop("letter").withColumnRenamed("distance_m", "cd"), list(SESSION))
    return e.filter(in_half_open_window(F.col("cd"), F.col("left_max_m") - 500, F.col("apex_end_m"), F.col("lap_length_m")))
