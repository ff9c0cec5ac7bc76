"""Per-lap series operators on the sample stream."""

from pyspark.sql import functions as F

from catalog.binding import CTES, Binding
from catalog.registry import query
from trackgrid.functions.ordered import neighbours
from trackgrid.keys import LAP, SESSION
from trackgrid.operators import gridchecks as G
from trackgrid.operators import metrics as M
from trackgrid.operators import series as S

L = "season:i round:i session_code:s driver:s lap_number:i "
K = "season, round, session_code, driver, lap_number"
JOIN = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in LAP)
U = f"USING ({K})"

# ---- SQL building blocks ---------------------------------------------------
CTES["span_ok"] = f"""
SELECT {K}, greatest(car_lo, pos_lo) AS lo, least(car_hi, pos_hi) AS hi FROM
 (SELECT {K}, min(session_time) AS car_lo, max(session_time) AS car_hi, count(*) AS car_n FROM car GROUP BY ALL)
 JOIN (SELECT {K}, min(session_time) AS pos_lo, max(session_time) AS pos_hi, count(*) AS pos_n FROM pos GROUP BY ALL) {U}
WHERE car_n >= 2 AND pos_n >= 2 AND least(car_hi, pos_hi) > greatest(car_lo, pos_lo)"""
CTES["instants"] = f"""
SELECT t.* FROM (SELECT {K}, session_time FROM car UNION SELECT {K}, session_time FROM pos) t
JOIN span_ok {U} WHERE session_time BETWEEN lo AND hi"""


def _lin(c, src):
    return (f"CASE WHEN {src}0.session_time = {src}1.session_time THEN {src}0.{c} ELSE "
            f"({src}1.{c} - {src}0.{c}) / ({src}1.session_time - {src}0.session_time) * (i.session_time - {src}0.session_time) + {src}0.{c} END")


def _asof(name, src, op):
    return f"ASOF JOIN {src} {name} ON {JOIN('i', name)} AND i.session_time {op} {name}.session_time"


CTES["merged"] = f"""
SELECT {', '.join('i.' + k for k in LAP)}, i.session_time, {', '.join(_lin(c, 'c') + ' AS ' + c for c in ('speed', 'throttle', 'rpm'))},
  c0.n_gear, c0.brake, c0.drs, {', '.join('(' + _lin(c, 'p') + ') / 10.0 AS ' + c for c in ('x', 'y', 'z'))}
FROM instants i {_asof('c0', 'car', '>=')} {_asof('c1', 'car', '<=')} {_asof('p0', 'pos', '>=')} {_asof('p1', 'pos', '<=')}"""
CTES["merged_raw"] = f"""
SELECT *, coalesce(sum(0.5 * (speed / 3.6 + pv) * (session_time - pt)) OVER (PARTITION BY {K} ORDER BY session_time), 0) AS distance_raw
FROM (SELECT *, lag(speed / 3.6) OVER w AS pv, lag(session_time) OVER w AS pt FROM merged WINDOW w AS (PARTITION BY {K} ORDER BY session_time))"""
CTES["tele_raw"] = CTES["merged_raw"].replace("FROM merged WINDOW", "FROM tele WINDOW")
CTES["kept"] = "SELECT * FROM tele"
CTES["seg"] = f"""
SELECT *, lead(distance_aligned) OVER w AS d1, lead(session_time) OVER w AS t1, lead(speed) OVER w AS speed1, lead(throttle) OVER w AS throttle1,
  lead(rpm) OVER w AS rpm1, lead(x) OVER w AS x1, lead(y) OVER w AS y1, lag(distance_aligned) OVER w AS d_prev, min(session_time) OVER (PARTITION BY {K}) AS t0
FROM tele WINDOW w AS (PARTITION BY {K} ORDER BY distance_aligned)"""
_HELD = "(s.d1 IS NULL OR g.gi * 10.0 <= s.distance_aligned)"
_X = "(g.gi * 10.0)::DOUBLE"


def _gl(y0, y1):
    return f"CASE WHEN {_HELD} THEN {y0} ELSE (({y1} - {y0}) / (s.d1 - s.distance_aligned)) * ({_X} - s.distance_aligned) + {y0} END"


CTES["points"] = f"""
SELECT {K}, unnest(generate_series(0, CAST(floor(last_d / 10.0) AS BIGINT))) AS gi FROM
 (SELECT {K}, max(distance_aligned) AS last_d FROM tele GROUP BY ALL HAVING count(*) >= 2)"""
CTES["first_d"] = f"SELECT {K}, min(distance_aligned) AS fd FROM tele GROUP BY ALL"
CTES["grid"] = f"""
SELECT {', '.join('g.' + k for k in LAP)}, g.gi AS grid_index, {_X} AS distance_m, {_gl('(s.session_time - s.t0)', '(s.t1 - s.t0)')} AS elapsed_time,
  {', '.join(_gl('s.' + c, 's.' + c + '1') + ' AS ' + c for c in ('speed', 'throttle', 'rpm', 'x', 'y'))}, s.n_gear, s.brake, s.drs,
  CASE WHEN {_X} < s.distance_aligned THEN NULL WHEN {_X} = s.distance_aligned THEN 0 ELSE s.d1 - s.distance_aligned END AS source_gap_m
FROM (SELECT points.*, greatest(gi * 10.0::DOUBLE, fd) AS look FROM points JOIN first_d {U}) g
ASOF JOIN seg s ON {JOIN('g', 's')} AND g.look >= s.distance_aligned"""
CTES["curves"] = f"""
SELECT {K}, grid_index, elapsed_time - z AS t_s, speed / 3.6 AS speed_ms FROM grid
JOIN (SELECT {K}, elapsed_time AS z FROM grid WHERE grid_index = 0) {U}"""
CTES["lapn"] = f"SELECT {K}, count(*) AS n_points FROM grid GROUP BY ALL"
CTES["acc"] = f"SELECT {K}, lap_time FROM laps JOIN lapn {U} WHERE coalesce(is_accurate, false) AND lap_time IS NOT NULL"
CTES["fastest"] = """
SELECT season, round, session_code, driver AS ref_driver, lap_number AS ref_lap FROM
 (SELECT *, row_number() OVER (PARTITION BY season, round, session_code ORDER BY lap_time, driver, lap_number) AS rn FROM acc) WHERE rn = 1"""
CTES["refmap"] = f"SELECT {K}, ref_driver, ref_lap FROM lapn JOIN fastest USING (season, round, session_code)"
CTES["delta"] = f"""
SELECT c.*, r.t_s AS ref_t, c.t_s - r.t_s AS delta_t_s, ref_driver || ' L' || ref_lap AS reference, ref_driver, ref_lap
FROM curves c JOIN refmap m {U}
LEFT JOIN curves r ON r.season = c.season AND r.round = c.round AND r.session_code = c.session_code AND r.driver = m.ref_driver
 AND r.lap_number = m.ref_lap AND r.grid_index = c.grid_index"""


# ---- Spark stage tables ----------------------------------------------------

def grid(b: Binding):
    return b.staged("grid", lambda: S.resample(b.tele()))


def speed_curves(b: Binding):
    """Written, as many steps read a few points or counts of them and need not move the grid for it."""
    return b.staged("curves", lambda: S.time_curves(grid(b), extra=["speed"]))


def curves(b: Binding):
    return speed_curves(b).withColumn("speed_ms", F.col("speed") / 3.6).drop("speed")


def reference(b: Binding):
    return b.staged("reference", lambda: M.resolve_reference(b.laps(), S.lap_lengths(grid(b)), M.ReferenceSpec()))


def delta(b: Binding):
    return b.staged("delta", lambda: S.delta_t(curves(b), reference(b), "session_fastest"))


def merged(b: Binding):
    return b.staged("merged", lambda: S.merge_channels(b.car(), b.pos()))


def tele_raw(b: Binding):
    return b.staged("tele_raw", lambda: S.add_raw_distance(b.tele()))


# ---- channel merge ---------------------------------------------------------

@query("ser01_union_timebase", L + "session_time:d", "SELECT * FROM instants")
def _(b):
    return S.timebase(b.car(), b.pos())


@query("ser02_linear_channels", L + "session_time:d speed:d throttle:d rpm:d x:d y:d z:d", "SELECT * FROM merged")
def _(b):
    return S.merge_channels(b.car(), b.pos())


@query("ser03_step_channels", L + "session_time:d n_gear:i brake:b drs:i", f"""
SELECT i.*, c.n_gear, c.brake, c.drs FROM instants i ASOF JOIN car c ON {JOIN('i', 'c')} AND i.session_time >= c.session_time""")
def _(b):
    return S.merge_channels(b.car(), b.pos(), car_linear=(), pos_linear=("x",))


@query("ser04_raw_distance", L + "session_time:d distance_raw:d", "SELECT * FROM tele_raw")
def _(b):
    return S.add_raw_distance(b.tele())


@query("ser04b_lap_frame", L + "session_time:d speed:d x:d n_gear:i distance_raw:d", "SELECT * FROM merged_raw")
def _(b):
    return S.lap_frames(b.car(), b.pos())


# ---- distance axis ---------------------------------------------------------

CTES["noisy"] = "SELECT *, distance_aligned + (k - 50) * 2.0::DOUBLE AS dn FROM tele"


def noisy(b):
    return b.tele().withColumn("distance_aligned", F.col("distance_aligned") + (F.col("k") - 50) * F.lit(2.0))


@query("ser05_enforce_monotonic", L + "session_time:d distance_aligned:d corrected:b", f"""
SELECT {K}, session_time, dm AS distance_aligned, dm <> dn AS corrected FROM
 (SELECT *, max(dn) OVER (PARTITION BY {K} ORDER BY session_time) AS dm FROM noisy)""")
def _(b):
    return S.enforce_monotonic(noisy(b))


@query("ser05_corrected_samples", L + "corrected:i", f"""
SELECT {K}, count(*) FILTER (WHERE dm <> dn) AS corrected FROM
 (SELECT *, max(dn) OVER (PARTITION BY {K} ORDER BY session_time) AS dm FROM noisy) GROUP BY ALL""")
def _(b):
    return S.enforce_monotonic(noisy(b)).groupBy(*LAP).agg(F.count_if("corrected").alias("corrected"))


CTES["clamped"] = "SELECT *, least(greatest(distance_aligned - 100.0, 0.0), 1800.0)::DOUBLE AS dc FROM tele_raw"


@query("ser06_extend_axis_ends", L + "session_time:d distance_aligned:d", f"""
WITH e AS (SELECT {K}, arg_min(dc, session_time) AS d0, arg_max(dc, session_time) AS d9 FROM clamped GROUP BY ALL),
f AS (SELECT {K}, any_value(d0) AS d0, any_value(d9) AS d9, min(session_time) FILTER (WHERE dc > d0) AS tl, max(session_time) FILTER (WHERE dc < d9) AS th,
  arg_min(dc, session_time) FILTER (WHERE dc > d0) AS dl, arg_min(distance_raw, session_time) FILTER (WHERE dc > d0) AS rl,
  arg_max(dc, session_time) FILTER (WHERE dc < d9) AS dh, arg_max(distance_raw, session_time) FILTER (WHERE dc < d9) AS rh
  FROM clamped JOIN e {U} GROUP BY ALL)
SELECT {K}, session_time, CASE WHEN d9 >= 1800.0 - 1e-6 AND session_time > th THEN dh + (distance_raw - rh)
  WHEN d0 <= 1e-9 AND session_time < tl THEN dl - (rl - distance_raw) ELSE dc END AS distance_aligned FROM clamped JOIN f {U}""")
def _(b):
    clamp = F.least(F.greatest(F.col("distance_aligned") - 100.0, F.lit(0.0)), F.lit(1800.0))
    df = tele_raw(b).withColumn("distance_aligned", clamp)
    line = df.select(*SESSION).distinct().withColumn("line_length_m", F.lit(1800.0))
    return S.extend_axis_ends(df, line)


@query("ser07_axis_origin", L + "session_time:d distance_aligned:d origin_shift_m:d", f"""
WITH o AS (SELECT season, round, session_code, least(max(f), 150.0) AS s FROM
 (SELECT {K}, arg_min(distance_aligned, session_time) AS f FROM tele GROUP BY ALL) GROUP BY ALL)
SELECT {K}, session_time, distance_aligned - s AS distance_aligned, s AS origin_shift_m FROM tele JOIN o USING (season, round, session_code)""")
def _(b):
    return S.place_axis_origin(b.tele())


CTES["flat"] = "SELECT *, floor(distance_aligned / 60.0) * 60.0::DOUBLE AS df FROM tele"


@query("ser08_last_of_run", L + "distance_aligned:d session_time:d n_gear:i", f"""
SELECT {K}, df AS distance_aligned, session_time, n_gear FROM
 (SELECT *, lead(df) OVER (PARTITION BY {K} ORDER BY session_time) AS nd FROM flat) WHERE nd IS NULL OR nd <> df""")
def _(b):
    return S.last_of_each_distance(b.tele().withColumn("distance_aligned", F.floor(F.col("distance_aligned") / 60.0) * F.lit(60.0)), cols=["n_gear"])


@query("ser09_make_grid", L + "grid_index:i distance_m:d", f"""
SELECT {K}, gi AS grid_index, gi * 25.0 AS distance_m FROM (SELECT {K}, unnest(generate_series(0, CAST(floor(m / 25.0) AS BIGINT))) AS gi
 FROM (SELECT {K}, max(distance_aligned) AS m FROM tele GROUP BY ALL))""")
def _(b):
    return S.make_grid(b.tele().groupBy(*LAP).agg(F.max("distance_aligned").alias("lap_length_m")), spacing=25.0)


GRID_OUT = L + "grid_index:i distance_m:d elapsed_time:d speed:d throttle:d rpm:d x:d y:d n_gear:i brake:b drs:i source_gap_m:d"


@query("ser10_resample", GRID_OUT, "SELECT * FROM grid")
def _(b):
    return S.resample(b.tele())


@query("ser10_resample_flat_runs", L + "grid_index:i speed:d n_gear:i", f"""
WITH r AS (SELECT * FROM (SELECT *, lead(df) OVER (PARTITION BY {K} ORDER BY session_time) AS nd FROM flat) WHERE nd IS NULL OR nd <> df),
s AS (SELECT *, lead(df) OVER w AS d1, lead(speed) OVER w AS s1, min(df) OVER (PARTITION BY {K}) AS fd FROM r WINDOW w AS (PARTITION BY {K} ORDER BY df)),
p AS (SELECT {K}, any_value(fd) AS fd, CAST(floor(max(df) / 10.0) AS BIGINT) AS top FROM s GROUP BY ALL HAVING count(*) >= 2),
q AS (SELECT {K}, fd, unnest(generate_series(0, top)) AS gi FROM p)
SELECT {', '.join('g.' + k for k in LAP)}, g.gi AS grid_index, s.n_gear,
  CASE WHEN s.d1 IS NULL OR g.gi * 10.0 <= s.df THEN s.speed ELSE (s.s1 - s.speed) / (s.d1 - s.df) * (g.gi * 10.0 - s.df) + s.speed END AS speed
FROM (SELECT *, greatest(gi * 10.0::DOUBLE, fd) AS look FROM q) g ASOF JOIN s ON {JOIN('g', 's')} AND g.look >= s.df""")
def _(b):
    flat = b.tele().withColumn("distance_aligned", F.floor(F.col("distance_aligned") / 60.0) * F.lit(60.0))
    return S.resample_session(flat, continuous=["speed"], discrete=["n_gear"])[0]


@query("ser11_source_gap", L + "grid_index:i source_gap_m:d", "SELECT * FROM grid")
def _(b):
    return grid(b)


@query("ser12_elapsed_origin", L + "session_time:d elapsed:d", f"""
SELECT {K}, session_time, session_time - min(session_time) OVER (PARTITION BY {K}) AS elapsed FROM tele""")
def _(b):
    t = b.tele()
    return t.join(t.groupBy(*LAP).agg(F.min("session_time").alias("t0")), list(LAP)).withColumn("elapsed", F.col("session_time") - F.col("t0"))


_BROKEN = """SELECT season, round, session_code, driver, lap_number, session_time,
  CASE WHEN user_id % 10 = 1 AND k > 95 THEN 'NaN'::DOUBLE WHEN user_id % 10 = 2 THEN 2000.0 - distance_aligned WHEN user_id % 10 = 3 THEN 7.0 ELSE distance_aligned END AS d
  FROM tele WHERE user_id % 10 <> 4 OR k > 90"""


def broken(b):
    u = F.col("user_id") % 10
    d = F.when((u == 1) & (F.col("k") > 95), F.lit(float("nan"))).when(u == 2, 2000.0 - F.col("distance_aligned")).when(u == 3, 7.0).otherwise(F.col("distance_aligned"))
    return b.tele().filter((u != 4) | (F.col("k") > 90)).withColumn("distance_aligned", d)


_REJECT = f"""
SELECT * FROM (SELECT {K}, CASE WHEN n < 2 THEN 'need at least 2 samples, got ' || n WHEN bad > 0 THEN 'distance contains non-finite values'
  WHEN back > 0 THEN 'distance is not monotonically non-decreasing' WHEN hi = lo THEN 'lap covers a single distance value'
  WHEN hi < 0 THEN 'lap ends before distance zero' END AS reason FROM
 (SELECT {K}, count(*) AS n, count(*) FILTER (WHERE isnan(d)) AS bad, count(*) FILTER (WHERE d < pd) AS back, max(d) AS hi, min(d) AS lo FROM
  (SELECT *, lag(d) OVER (PARTITION BY {K} ORDER BY session_time) AS pd FROM ({_BROKEN})) GROUP BY ALL)) WHERE reason IS NOT NULL"""


@query("ser13_lap_rejects", L + "reason:s", _REJECT)
def _(b):
    return S.lap_rejects(broken(b))


@query("ser14_resample_session", L + "points:i last_m:d", f"""
SELECT {K}, CAST(floor(max(d) / 10.0) AS BIGINT) + 1 AS points, floor(max(d) / 10.0) * 10.0 AS last_m FROM ({_BROKEN}) b
WHERE NOT EXISTS (SELECT 1 FROM ({_REJECT}) r WHERE {JOIN('r', 'b')}) GROUP BY ALL""")
def _(b):
    good, _rejected = S.resample_session(broken(b))
    return good.groupBy(*LAP).agg(F.count(F.lit(1)).alias("points"), F.max("distance_m").alias("last_m"))


@query("ser14_duplicate_grid_keys", L + "grid_index:i n:i", f"SELECT {K}, grid_index, count(*) AS n FROM grid GROUP BY ALL HAVING count(*) > 1")
def _(b):
    return S.resample(b.tele()).groupBy(*LAP, "grid_index").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


# ---- curves ----------------------------------------------------------------

@query("ser15_time_curves", L + "grid_index:i t_s:d", "SELECT * FROM curves")
def _(b):
    return S.time_curves(grid(b))


@query("ser15_curve_faults", L + "reason:s", f"""
SELECT * FROM (SELECT {K}, CASE WHEN min(grid_index) <> 0 THEN 'no grid index 0' WHEN max(grid_index) + 1 <> count(*) THEN 'gap in the grid' END AS reason
 FROM grid WHERE n_gear <> 3 GROUP BY ALL) WHERE reason IS NOT NULL""")
def _(b):
    return S.curve_faults(grid(b).filter("n_gear <> 3"))


@query("ser16_lap_lengths", L + "n_points:i", "SELECT * FROM lapn")
def _(b):
    return S.lap_lengths(grid(b))


@query("ser17_delta_t", L + "grid_index:i t_s:d delta_t_s:d reference:s", "SELECT * FROM delta")
def _(b):
    return S.delta_t(curves(b), reference(b), "session_fastest")


CTES["bests"] = f"SELECT season, round, session_code, driver, arg_min(lap_number, (lap_time, lap_number)) AS best FROM acc GROUP BY ALL"


@query("ser17_delta_driver_best", L + "grid_index:i delta_t_s:d reference:s", f"""
WITH own AS MATERIALIZED (SELECT {K}, best, grid_index, t_s FROM curves JOIN bests USING (season, round, session_code, driver)),
ref AS MATERIALIZED (SELECT season, round, session_code, driver, lap_number AS best, grid_index, t_s AS ref_s FROM curves)
SELECT {K}, grid_index, t_s - ref_s AS delta_t_s, driver || ' L' || best AS reference FROM own LEFT JOIN ref USING (season, round, session_code, driver, best, grid_index)""")
def _(b):
    own = M.accurate_lap_times(b.laps()).select(*SESSION, "driver").distinct()
    laps = S.lap_lengths(grid(b)).join(own, [*SESSION, "driver"], "left_semi")
    return S.delta_t(curves(b), M.resolve_reference(b.laps(), laps, M.ReferenceSpec("driver_best")), "driver_best")


_CROSS = f"""
SELECT * FROM (SELECT {K}, 'S1' AS boundary, lap_start_time + sector1_time AS at_s FROM laps WHERE sector1_time IS NOT NULL
 UNION ALL SELECT {K}, 'S2', lap_start_time + sector1_time + sector2_time FROM laps WHERE sector1_time IS NOT NULL)"""
CTES["crossings_sql"] = f"""
SELECT {', '.join('q.' + k for k in LAP)}, boundary, at_s AS crossing_time_s,
  CASE WHEN a.session_time = z.session_time THEN a.distance_aligned ELSE (z.distance_aligned - a.distance_aligned) / (z.session_time - a.session_time) * (at_s - a.session_time) + a.distance_aligned END AS distance_m
FROM ({_CROSS}) q ASOF JOIN tele a ON {JOIN('q', 'a')} AND q.at_s >= a.session_time ASOF JOIN tele z ON {JOIN('q', 'z')} AND q.at_s <= z.session_time"""


@query("ser18_value_at_time", L + "boundary:s crossing_time_s:d distance_m:d", "SELECT * FROM crossings_sql")
def _(b):
    return M.sector_crossings(b.tele(), b.laps())


@query("ser19_raw_distance_at", L + "raw_m:d extrapolated:b", f"""
WITH q AS (SELECT {K}, lap_start_time AS at_s FROM laps)
SELECT {', '.join('q.' + k for k in LAP)}, a.session_time IS NULL OR z.session_time IS NULL AS extrapolated,
 CASE WHEN a.session_time IS NULL THEN z.distance_raw - z.speed / 3.6 * (z.session_time - at_s) WHEN z.session_time IS NULL THEN a.distance_raw + a.speed / 3.6 * (at_s - a.session_time)
  WHEN a.session_time = z.session_time THEN a.distance_raw ELSE (z.distance_raw - a.distance_raw) / (z.session_time - a.session_time) * (at_s - a.session_time) + a.distance_raw END AS raw_m
FROM q ASOF LEFT JOIN tele_raw a ON {JOIN('q', 'a')} AND q.at_s >= a.session_time ASOF LEFT JOIN tele_raw z ON {JOIN('q', 'z')} AND q.at_s <= z.session_time""")
def _(b):
    return S.raw_distance_at(tele_raw(b), b.laps().select(*LAP, F.col("lap_start_time").alias("at_s")))


CTES["targets"] = f"""
SELECT {K}, n_points, unnest([-25.0, 0.0, 333.3, 1500.0, 2100.0])::DOUBLE AS x FROM lapn"""


@query("ser20_time_at_distance", L + "target_m:d at_time_s:d", f"""
WITH q AS MATERIALIZED (SELECT *, i + 1 AS j FROM (SELECT *, greatest(0, least(CAST(floor(x / 10.0) AS BIGINT), n_points - 1)) AS i FROM targets)),
a AS MATERIALIZED (SELECT {K}, grid_index AS i, t_s, speed_ms FROM curves), z AS MATERIALIZED (SELECT {K}, grid_index AS j, t_s AS next_s FROM curves)
SELECT {K}, x AS target_m, CASE WHEN x < 0 THEN t_s - (0 - x) / speed_ms WHEN next_s IS NULL THEN t_s + (x - i * 10.0) / speed_ms
  ELSE (next_s - t_s) / 10.0 * (x - i * 10.0) + t_s END AS at_time_s
FROM q JOIN a USING ({K}, i) LEFT JOIN z USING ({K}, j)""")
def _(b):
    asked = S.lap_lengths(grid(b)).select(*LAP, F.explode(F.array(*[F.lit(x) for x in (-25.0, 0.0, 333.3, 1500.0, 2100.0)])).alias("target_m"))
    return S.time_at_distance(curves(b), asked)


@query("ser21_nearest_grid_point", L + "target_m:d grid_index:i t_s:d", f"""
SELECT t.*, x AS target_m, CAST(round_even(x / 10.0, 0) AS BIGINT) AS grid_index, c.t_s FROM targets t
LEFT JOIN curves c ON {JOIN('t', 'c')} AND c.grid_index = CAST(round_even(x / 10.0, 0) AS BIGINT)""")
def _(b):
    asked = S.lap_lengths(grid(b)).select(*LAP, F.explode(F.array(*[F.lit(x) for x in (-25.0, 0.0, 333.3, 1500.0, 2100.0)])).alias("target_m"))
    return S.nearest_grid_point(asked, curves(b), ["t_s"])


CTES["edges_src"] = f"SELECT {K}, distance_aligned AS edge_m FROM (SELECT *, lag(brake) OVER (PARTITION BY {K} ORDER BY session_time) AS was FROM tele) WHERE brake AND NOT was"
CTES["edges_grid"] = f"SELECT {K}, distance_m AS edge_m FROM (SELECT *, lag(brake) OVER (PARTITION BY {K} ORDER BY grid_index) AS was FROM grid) WHERE brake AND NOT was"


@query("ser22_rising_edges", L + "edge_m:d", "SELECT * FROM edges_src")
def _(b):
    return S.rising_edges(b.tele(), "brake", where="distance_aligned")


@query("ser23_boolean_runs", L + "application:i on_m:d off_m:d", f"""
WITH w AS (SELECT *, grid_index - row_number() OVER (PARTITION BY {K} ORDER BY grid_index) AS island FROM grid WHERE brake AND distance_m BETWEEN 100 AND 1500)
SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY on_m) AS application FROM (SELECT {K}, island, min(distance_m) AS on_m, max(distance_m) AS off_m FROM w GROUP BY ALL)""")
def _(b):
    return S.boolean_runs(grid(b).filter("distance_m BETWEEN 100 AND 1500"))


CTES["trip"] = f"""
SELECT {', '.join('t.' + k for k in LAP)}, t.distance_aligned, abs((z.speed - a.speed) / 10.0 * (t.distance_aligned - a.distance_m) + a.speed - t.speed) AS speed,
  abs((z.throttle - a.throttle) / 10.0 * (t.distance_aligned - a.distance_m) + a.throttle - t.throttle) AS throttle,
  abs((z.rpm - a.rpm) / 10.0 * (t.distance_aligned - a.distance_m) + a.rpm - t.rpm) AS rpm
FROM tele t JOIN grid a ON {JOIN('t', 'a')} AND a.grid_index = CAST(floor(t.distance_aligned / 10.0) AS BIGINT)
JOIN grid z ON {JOIN('t', 'z')} AND z.grid_index = a.grid_index + 1"""


@query("ser24_round_trip_error", L + "distance_aligned:d speed:d throttle:d rpm:d", "SELECT * FROM trip")
def _(b):
    return G.round_trip_errors(b.tele(), grid(b))


_INV = """SELECT DISTINCT season, round, session_code, driver, lap_number, 'n_gear' AS channel, n_gear + CASE WHEN grid_index % 50 = 7 THEN 20 ELSE 0 END AS value FROM grid
 EXCEPT SELECT season, round, session_code, driver, lap_number, 'n_gear', n_gear FROM tele"""


@query("ser25_invented_values", L + "channel:s value:i", _INV)
def _(b):
    spoiled = grid(b).withColumn("n_gear", F.col("n_gear") + F.when(F.col("grid_index") % 50 == 7, 20).otherwise(0))
    return G.invented_values(b.tele(), spoiled, ["n_gear"])


CTES["edge_disp"] = f"""
SELECT {', '.join('s.' + k for k in LAP)}, s.edge_m, min(abs(s.edge_m - g.edge_m)) AS displacement_m
FROM edges_src s LEFT JOIN edges_grid g ON {JOIN('s', 'g')} GROUP BY ALL"""


@query("ser26_brake_edge_displacement", L + "edge_m:d displacement_m:d", "SELECT * FROM edge_disp")
def _(b):
    return G.brake_edge_displacement(b.tele(), grid(b))


CTES["empties"] = f"""
SELECT {K}, 1.0 - count(DISTINCT floor(distance_aligned / 10.0)) / (floor(max(distance_aligned) / 10.0) + 1) AS empty_bin_fraction FROM tele GROUP BY ALL"""


@query("ser27_empty_bins", L + "empty_bin_fraction:d", "SELECT * FROM empties")
def _(b):
    return G.empty_bins(b.tele())


@query("ser28_grid_structure", L + "structure_ok:b", f"""
SELECT {K}, count(grid_index) = any_value(want) AND min(grid_index) = 0 AND max(grid_index) + 1 = count(*) AND bool_and(distance_m = grid_index * 10.0) AS structure_ok
FROM grid JOIN (SELECT {K}, floor(max(distance_aligned) / 10.0) + 1 AS want FROM tele GROUP BY ALL) {U} GROUP BY ALL""")
def _(b):
    return G.structure(grid(b), b.tele().groupBy(*LAP).agg(F.max_by("distance_aligned", "session_time").alias("last_m")))


CTES["rising"] = f"""
SELECT {K}, coalesce(bool_and(elapsed_time > pe) FILTER (WHERE pe IS NOT NULL), true) AS increasing FROM
 (SELECT *, lag(elapsed_time) OVER (PARTITION BY {K} ORDER BY grid_index) AS pe FROM grid) GROUP BY ALL"""


@query("ser29_elapsed_increasing", L + "increasing:b", "SELECT * FROM rising")
def _(b):
    return G.elapsed_increasing(grid(b))


CTES["quick"] = f"""
SELECT {K}, lap_time, row_number() OVER (PARTITION BY season, round, session_code, driver ORDER BY lap_time, lap_number) AS place,
  dense_rank() OVER (PARTITION BY season, round, session_code ORDER BY driver) AS seat FROM laps JOIN lapn {U} WHERE lap_time IS NOT NULL"""
CTES["lap_a"] = f"SELECT {K} FROM quick WHERE seat = 1 AND place = 1"
CTES["lap_b"] = f"SELECT {K} FROM quick WHERE seat = 2 AND place = 1"


def quick(b):
    return b.staged("quick", lambda: M.quickest(b.laps().join(S.lap_lengths(grid(b)), list(LAP), "left_semi").withColumnRenamed("lap_time", "lap_time_s"), 1000))


def pair(b):
    """First and second driver by code of every session, each with their quickest lap."""
    from pyspark.sql import Window

    best = quick(b).filter("place = 1")
    seats = best.groupBy(*SESSION).agg(F.min("driver").alias("first"))
    second = best.join(seats, list(SESSION)).filter("driver > first").groupBy(*SESSION).agg(F.min("driver").alias("second"))
    a = best.join(seats.withColumnRenamed("first", "driver"), [*SESSION, "driver"], "left_semi")
    z = best.join(second.withColumnRenamed("second", "driver"), [*SESSION, "driver"], "left_semi")
    return a, z


_PAIR = """FROM (SELECT g.* FROM grid g SEMI JOIN lap_a USING (season, round, session_code, driver, lap_number)) a
JOIN (SELECT g.* FROM grid g SEMI JOIN lap_b USING (season, round, session_code, driver, lap_number)) b USING (season, round, session_code, grid_index)"""


@query("ser30_trace_window", "season:i round:i session_code:s grid_index:i distance_m:d speed_a:d speed_b:d brake_a:b n_gear_b:i d_speed_kmh:d cumulative_delta_s:d", f"""
SELECT season, round, session_code, grid_index, a.distance_m, a.speed AS speed_a, b.speed AS speed_b, a.brake AS brake_a, b.n_gear AS n_gear_b, b.speed - a.speed AS d_speed_kmh,
 (b.elapsed_time - first(b.elapsed_time) OVER w) - (a.elapsed_time - first(a.elapsed_time) OVER w) AS cumulative_delta_s
{_PAIR} WHERE a.distance_m BETWEEN 300 AND 900 WINDOW w AS (PARTITION BY season, round, session_code ORDER BY grid_index)""")
def _(b):
    a, z = pair(b)
    return S.trace_window(grid(b), a, z, F.lit(300.0), F.lit(900.0))


@query("flagship_overlay", "season:i round:i session_code:s grid_index:i distance_m:d delta_t_s:d speed_a:d speed_b:d", f"""
SELECT season, round, session_code, grid_index, a.distance_m, tb.t_s - ta.t_s AS delta_t_s, a.speed AS speed_a, b.speed AS speed_b {_PAIR}
JOIN curves ta ON ta.season = a.season AND ta.round = a.round AND ta.session_code = a.session_code AND ta.driver = a.driver AND ta.lap_number = a.lap_number AND ta.grid_index = a.grid_index
JOIN curves tb ON tb.season = b.season AND tb.round = b.round AND tb.session_code = b.session_code AND tb.driver = b.driver AND tb.lap_number = b.lap_number AND tb.grid_index = b.grid_index""")
def _(b):
    a, z = pair(b)
    g = grid(b)
    c = S.time_curves(g, extra=["distance_m", "speed"])
    side = lambda pick, s: c.join(pick.select(*LAP), list(LAP), "left_semi").select(*SESSION, "grid_index", F.col("distance_m").alias(f"d_{s}"), F.col("t_s").alias(f"t_{s}"), F.col("speed").alias(f"speed_{s}"))
    both = side(a, "a").join(side(z, "b"), [*SESSION, "grid_index"])
    return both.withColumn("distance_m", F.col("d_a")).withColumn("delta_t_s", F.col("t_b") - F.col("t_a"))
