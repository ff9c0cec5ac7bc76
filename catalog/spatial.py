"""Reference lines, projection, registration and corner anchors."""

from pyspark.sql import functions as F

from catalog import segment as C
from catalog.binding import CTES, RADIUS
from catalog.registry import query
from catalog.segment import KS, SS, US
from catalog.series import K, L, U, grid, merged, tele_raw
from trackgrid.functions.columns import positions_to_metres
from trackgrid.keys import LAP, SESSION
from trackgrid.operators import series as S
from trackgrid.operators import spatial as P

# ---- SQL -------------------------------------------------------------------
# circuit corners in source units: every third nation, turned 0.01 rad and shifted
_TH = "raw_distance_m * 0.0031415926535897933"
_C, _S = f"{RADIUS} * cos({_TH})", f"{RADIUS} * sin({_TH})"
CTES["rawcorn"] = f"""
SELECT {KS}, number, letter, raw_distance_m AS distance, 10.0 * ({_C} * cos(0.01) - {_S} * sin(0.01) + 5.0) AS x, 10.0 * ({_C} * sin(0.01) + {_S} * cos(0.01) - 3.0) AS y FROM corn"""
CTES["seedlap"] = f"""
WITH f AS (SELECT {KS}, arg_min({{'d': driver, 'l': lap_number}}, (lap_time, driver, lap_number)) AS b FROM laps WHERE coalesce(is_accurate, false) AND lap_time IS NOT NULL AND pit_in_time IS NULL AND pit_out_time IS NULL GROUP BY ALL),
m AS (SELECT {KS}, min((driver, lap_number)) AS first_lap FROM merged GROUP BY ALL), h AS (SELECT DISTINCT {K} FROM merged)
SELECT f.season, f.round, f.session_code, coalesce(h.driver, m.first_lap[1]) AS driver, coalesce(h.lap_number, m.first_lap[2]) AS lap_number, b.d || ' L' || b.l AS reference_line_lap
FROM f JOIN m {US} LEFT JOIN h ON h.season = f.season AND h.round = f.round AND h.session_code = f.session_code AND h.driver = b.d AND h.lap_number = b.l"""
CTES["seedpath"] = f"SELECT {KS}, row_number() OVER (PARTITION BY {KS} ORDER BY session_time) - 1 AS rn, session_time, x, y FROM merged SEMI JOIN seedlap {U}"
CTES["patharc"] = f"""
SELECT *, coalesce(sum(hop) OVER (PARTITION BY {KS} ORDER BY rn), 0) AS arc_m FROM (SELECT *, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS hop FROM seedpath WINDOW w AS (PARTITION BY {KS} ORDER BY rn))"""
CTES["lead_pts"] = f"""
WITH e AS (SELECT {KS}, arg_min(x, rn) AS ax, arg_min(y, rn) AS ay, coalesce(arg_min(x, rn) FILTER (WHERE arc_m >= 20), arg_max(x, rn)) AS bx, coalesce(arg_min(y, rn) FILTER (WHERE arc_m >= 20), arg_max(y, rn)) AS by_ FROM patharc GROUP BY ALL)
SELECT {KS}, i - 30 AS v, ax - (60.0 - i * 2.0) * (bx - ax) / sqrt((bx - ax) ** 2 + (by_ - ay) ** 2) AS x, ay - (60.0 - i * 2.0) * (by_ - ay) / sqrt((bx - ax) ** 2 + (by_ - ay) ** 2) AS y FROM e, generate_series(0, 29) t(i)"""
CTES["extpath"] = f"""
SELECT *, coalesce(sum(hop) OVER (PARTITION BY {KS} ORDER BY v), 0) AS arc FROM (SELECT *, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS hop FROM
 (SELECT {KS}, v, x, y FROM lead_pts UNION ALL SELECT {KS}, rn, x, y FROM seedpath) WINDOW w AS (PARTITION BY {KS} ORDER BY v))"""
CTES["rline"] = f"""
WITH t AS (SELECT {KS}, max(arc) AS total, greatest(10, CAST(round_even(max(arc) / 2.0, 0) AS BIGINT) + 1) AS n FROM extpath GROUP BY ALL),
g AS (SELECT *, k * (total / (n - 1)) AS target FROM (SELECT *, unnest(generate_series(0, n - 1)) AS k FROM t)),
s AS (SELECT *, lead(arc) OVER w AS arc1, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM extpath WINDOW w AS (PARTITION BY {KS} ORDER BY v)),
p AS (SELECT g.season, g.round, g.session_code, k AS vertex, CASE WHEN arc1 IS NULL OR k = n - 1 THEN coalesce(x1, x) ELSE (x1 - x) / (arc1 - arc) * (target - arc) + x END AS x, CASE WHEN arc1 IS NULL OR k = n - 1 THEN coalesce(y1, y) ELSE (y1 - y) / (arc1 - arc) * (target - arc) + y END AS y
 FROM g ASOF JOIN s ON g.season = s.season AND g.round = s.round AND g.session_code = s.session_code AND g.target >= s.arc)
SELECT {KS}, vertex, x, y, coalesce(sum(hop) OVER (PARTITION BY {KS} ORDER BY vertex), 0) - 60.0 AS arc_m FROM (SELECT *, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS hop FROM p WINDOW w AS (PARTITION BY {KS} ORDER BY vertex))"""

# the search along a lap: from an eighth of the window behind the last vertex to the window ahead, the first in lead and window
CTES["follow"] = f"""
WITH RECURSIVE l AS MATERIALIZED (SELECT {KS}, vertex, x, y, CAST(round(150.0 / sp) AS BIGINT) AS ahead, CAST(round(210.0 / sp) AS BIGINT) AS first FROM rline JOIN
  (SELECT {KS}, (max(arc_m) - min(arc_m)) / (count(*) - 1) AS sp FROM rline GROUP BY ALL) {US}),
s AS MATERIALIZED (SELECT {K}, session_time, x, y, row_number() OVER (PARTITION BY {K} ORDER BY session_time) AS i FROM merged),
w AS (SELECT {K}, i, arg_min(vertex, ((l.x - s.x) ** 2 + (l.y - s.y) ** 2, vertex)) AS vertex FROM s JOIN l {US} WHERE i = 1 AND vertex < first GROUP BY ALL
 UNION ALL SELECT w.season, w.round, w.session_code, w.driver, w.lap_number, s.i, arg_min(l.vertex, ((l.x - s.x) ** 2 + (l.y - s.y) ** 2, l.vertex)) FROM w
 JOIN s ON s.season = w.season AND s.round = w.round AND s.session_code = w.session_code AND s.driver = w.driver AND s.lap_number = w.lap_number AND s.i = w.i + 1
 JOIN l ON l.season = w.season AND l.round = w.round AND l.session_code = w.session_code AND l.vertex >= w.vertex - ahead // 8 AND l.vertex < w.vertex + ahead GROUP BY ALL)
SELECT {K}, session_time, x, y, vertex FROM w JOIN s USING (season, round, session_code, driver, lap_number, i)"""
CTES["feet"] = f"""
WITH n AS (SELECT {KS}, vertex, x AS cx, y AS cy, arc_m AS ca, lag((x, y, arc_m)) OVER v AS a, lead((x, y, arc_m)) OVER v AS b FROM rline WINDOW v AS (PARTITION BY {KS} ORDER BY vertex)),
t AS (SELECT {K}, session_time, x, y, a, b, cx, cy, ca,
  least(1.0, greatest(0.0, ((x - a[1]) * (cx - a[1]) + (y - a[2]) * (cy - a[2])) / ((cx - a[1]) ** 2 + (cy - a[2]) ** 2))) AS ta,
  least(1.0, greatest(0.0, ((x - cx) * (b[1] - cx) + (y - cy) * (b[2] - cy)) / ((b[1] - cx) ** 2 + (b[2] - cy) ** 2))) AS tb FROM follow JOIN n USING (season, round, session_code, vertex)),
o AS (SELECT *, sqrt((x - a[1] - ta * (cx - a[1])) ** 2 + (y - a[2] - ta * (cy - a[2])) ** 2) AS oa, sqrt((x - cx - tb * (b[1] - cx)) ** 2 + (y - cy - tb * (b[2] - cy)) ** 2) AS ob FROM t)
SELECT {K}, session_time, CASE WHEN oa IS NULL OR ob < oa THEN ca + tb * (b[3] - ca) ELSE a[3] + ta * (ca - a[3]) END AS distance_aligned, CASE WHEN oa IS NULL OR ob < oa THEN ob ELSE oa END AS line_offset_m FROM o"""


# ---- Spark stage tables ----------------------------------------------------

def raw_corners(b):
    th = F.col("raw_distance_m") * 0.0031415926535897933
    x, y = F.cos(th) * RADIUS, F.sin(th) * RADIUS
    c, s = F.cos(F.lit(0.01)), F.sin(F.lit(0.01))
    return C.corners(b).select(
        *SESSION, "number", "letter", F.col("raw_distance_m").alias("distance"), (10.0 * (x * c - y * s + 5.0)).alias("x"), (10.0 * (x * s + y * c - 3.0)).alias("y")
    )


def seeds(b):
    return P.line_seed(b.laps(), merged(b))


def path(b):
    return b.staged("seed_path", lambda: P.seed_path(merged(b), seeds(b)))


def line(b):
    return b.staged("reference_line", lambda: P.reference_line(path(b), axis=P.PATH))


def merged_raw(b):
    return b.staged("merged_raw", lambda: S.add_raw_distance(merged(b)))


def projected(b):
    return b.staged("projected", lambda: P.project_laps(merged_raw(b), line(b)))


def frames(b):
    return b.staged("frames", lambda: P.calibrate(positions_to_metres(raw_corners(b)), merged(b))[1])


def placed_corners(b):
    return b.staged("placed_corners", lambda: P.apply_frame(positions_to_metres(raw_corners(b)), frames(b)))


def anchors(b):
    return b.staged("anchors", lambda: P.locate_anchors(merged_raw(b), placed_corners(b).filter("number % 2 = 1")))


# ---- queries ---------------------------------------------------------------

@query("spa00_track_reference", SS + "number:i x:d y:d length_m:d", "SELECT *  REPLACE (x / 10.0 AS x, y / 10.0 AS y), 2000.0 AS length_m FROM rawcorn WHERE number IN (1, 4, 7)")
def _(b):
    layouts = grid(b).select(*SESSION).distinct().withColumn("length_m", F.lit(2000.0))
    return P.track_reference(raw_corners(b), layouts, [1, 4, 7])


@query("spa01_arc_length", SS + "x:d y:d arc_m:d", "SELECT * FROM patharc")
def _(b):
    return P.arc_length(path(b), P.PATH)


@query("spa02_lead_in", SS + "x:d y:d", "SELECT * FROM extpath")
def _(b):
    return P.lead_in(path(b), axis=P.PATH)


@query("spa03_reference_line", SS + "vertex:i x:d y:d arc_m:d", "SELECT * FROM rline")
def _(b):
    return P.reference_line(path(b), axis=P.PATH)


@query("spa04_line_seed", L + "reference_line_lap:s", "SELECT * FROM seedlap")
def _(b):
    return P.line_seed(b.laps(), merged(b))


@query("spa05_nearest_sample", SS + "number:i event_id:i d2:d", f"""
SELECT {KS}, number, arg_min(event_id, ((c.x / 10.0 - t.x) ** 2 + (c.y / 10.0 - t.y) ** 2, event_id)) AS event_id, min((c.x / 10.0 - t.x) ** 2 + (c.y / 10.0 - t.y) ** 2) AS d2 FROM rawcorn c JOIN tele t {US} GROUP BY ALL""")
def _(b):
    pts = positions_to_metres(raw_corners(b)).select(*SESSION, "number", F.col("x").alias("px"), F.col("y").alias("py"))
    return P.nearest(pts, b.tele(), SESSION, ["number"], "event_id").withColumnRenamed("idx", "event_id")


@query("spa05_nearest_embedding", "vec_id:i label:i nearest_id:i d2:d", """
WITH e AS (SELECT vec_id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings)
SELECT a.vec_id, a.label, arg_min(b.vec_id, ((a.x - b.x) ** 2 + (a.y - b.y) ** 2, b.vec_id)) AS nearest_id, min((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d2
FROM (SELECT vec_id, label, x + 0.05::DOUBLE AS x, y FROM e) a JOIN e b ON a.label = b.label GROUP BY ALL""")
def _(b):
    e = b.table("embeddings").select("vec_id", "label", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    pts = e.select("vec_id", "label", (F.col("x") + 0.05).alias("px"), F.col("y").alias("py"))
    return P.nearest(pts, e.withColumnRenamed("vec_id", "other"), ["label"], ["vec_id"], "other").withColumnRenamed("idx", "nearest_id")


@query("spa06_ordered_nearest", L + "session_time:d vertex:i", "SELECT * FROM follow")
def _(b):
    return P.ordered_nearest(merged(b), line(b))


@query("spa07_project_on_segments", L + "session_time:d distance_aligned:d line_offset_m:d", "SELECT * FROM feet")
def _(b):
    m = merged(b)
    return P.project_on_segments(m.join(P.ordered_nearest(m, line(b)), [*LAP, "session_time"]), line(b))


@query("spa08_project_laps", L + "session_time:d distance_aligned:d line_offset_m:d")
def _(b):
    return P.project_laps(merged_raw(b), line(b))


@query("spa09_rigid_registration", SS + "rotation_rad:d tx:d ty:d median_residual_m:d iterations:i reason:s")
def _(b):
    return P.calibrate(positions_to_metres(raw_corners(b)), merged(b))[1]


@query("spa10_apply_transform", SS + "number:i x:d y:d", "SELECT *  REPLACE (cos(-0.01) * x / 10.0 - sin(-0.01) * y / 10.0 + 1.5 AS x, sin(-0.01) * x / 10.0 + cos(-0.01) * y / 10.0 - 2.5 AS y) FROM rawcorn")
def _(b):
    fixed = grid(b).select(*SESSION).distinct().withColumns({"rotation_rad": F.lit(-0.01), "tx": F.lit(1.5), "ty": F.lit(-2.5)})
    return P.apply_frame(positions_to_metres(raw_corners(b)), fixed)


@query("spa11_calibration_cloud", L + "session_time:d x:d", "SELECT * FROM merged")
def _(b):
    return P.first_laps(merged(b))


@query("spa11_first_laps", L + "session_time:d x:d", f"""
SELECT m.* FROM merged m SEMI JOIN (SELECT {K} FROM (SELECT *, row_number() OVER (PARTITION BY {KS} ORDER BY driver, lap_number) AS rn FROM (SELECT DISTINCT {K} FROM merged)) WHERE rn <= 8) {U}""")
def _(b):
    return P.first_laps(merged(b), 8)


@query("spa11_calibrated_corners", SS + "number:i x:d y:d")
def _(b):
    return P.apply_frame(positions_to_metres(raw_corners(b)), frames(b))


@query("spa12_locate_anchors", L + "corner_number:i session_time:d d_raw:d d_ref:d residual_m:d")
def _(b):
    return P.locate_anchors(merged_raw(b), placed_corners(b).filter("number % 2 = 1"))


CTES["marks"] = f"""
SELECT {K}, unnest([300.0, 700.0, 1300.0])::DOUBLE AS r, unnest([310.0, 690.0, 1340.0])::DOUBLE AS f FROM lapn"""


@query("spa13_map_distance", L + "session_time:d distance_aligned:d", f"""
SELECT {K}, session_time, CASE WHEN distance_raw < 300 THEN 310 + (distance_raw - 300) * 380 / 400.0 WHEN distance_raw <= 700 THEN 380 / 400.0 * (distance_raw - 300) + 310
 WHEN distance_raw <= 1300 THEN 650 / 600.0 * (distance_raw - 700) + 690 ELSE 1340 + (distance_raw - 1300) * 650 / 600.0 END AS distance_aligned FROM tele_raw""")
def _(b):
    at = F.array(*[F.struct(F.lit(r).alias("d_raw"), F.lit(f).alias("d_ref")) for r, f in ((300.0, 310.0), (700.0, 690.0), (1300.0, 1340.0))])
    marks = S.lap_lengths(grid(b)).select(*LAP, F.inline(at))
    return P.map_distance(tele_raw(b).drop("distance_aligned"), marks)


@query("spa14_align_with_anchors", L + "samples:i")
def _(b):
    good, _rejected = P.align_with_anchors(merged_raw(b), anchors(b), min_anchors=3)
    return good.groupBy(*LAP).agg(F.count(F.lit(1)).alias("samples"))


@query("spa14_anchor_rejects", L + "reason:s")
def _(b):
    return P.align_with_anchors(merged_raw(b), anchors(b), min_anchors=3)[1]


@query("spa15_align_session", L + "samples:i first_m:d last_m:d")
def _(b):
    from trackgrid.plans.align import align_session

    out = align_session(b.car(), b.pos(), b.laps(), raw_corners(b))
    return out["telemetry_aligned"].groupBy(*LAP).agg(F.count(F.lit(1)).alias("samples"), F.min("distance_aligned").alias("first_m"), F.max("distance_aligned").alias("last_m"))


CTES["reg"] = f"""
SELECT {K}, number AS corner_number, raw_distance_m AS d_ref, arg_min(distance_raw, ((cx - x) ** 2 + (cy - y) ** 2, session_time)) AS observed, sqrt(min((cx - x) ** 2 + (cy - y) ** 2)) AS xy_residual_m FROM tele_raw JOIN
 (SELECT {KS}, number, raw_distance_m, {_C} AS cx, {_S} AS cy FROM corn WHERE number % 2 = 0) {US} GROUP BY ALL"""


def _true_corners(b):
    th = F.col("raw_distance_m") * 0.0031415926535897933
    return C.corners(b).filter("number % 2 = 0").select(*SESSION, "number", F.col("raw_distance_m").alias("distance"), (F.cos(th) * RADIUS).alias("x"), (F.sin(th) * RADIUS).alias("y"))


@query("spa16_measure_registration", L + "corner_number:i d_ref:d observed:d error_m:d xy_residual_m:d", "SELECT *, observed - d_ref AS error_m FROM reg")
def _(b):
    return P.measure_registration(tele_raw(b), _true_corners(b), "distance_raw")


@query("agg03_registration_summary", SS + "corner_number:i n_laps:i max_abs_error_m:d spread_m:d std_m:d", f"""
SELECT {KS}, corner_number, count(*) AS n_laps, max(abs(observed - d_ref)) AS max_abs_error_m, max(observed) - min(observed) AS spread_m, stddev_pop(observed) AS std_m FROM reg GROUP BY ALL""")
def _(b):
    return P.registration_summary(P.measure_registration(tele_raw(b), _true_corners(b), "distance_raw"))


@query("spa17_corner_positions", SS + "number:i letter:s distance_m:d line_offset_m:d raw_distance_m:d", f"""
SELECT {KS}, number, letter, distance AS raw_distance_m, arg_min(distance_m, ((c.x / 10.0 - g.x) ** 2 + (c.y / 10.0 - g.y) ** 2, grid_index)) AS distance_m, sqrt(min((c.x / 10.0 - g.x) ** 2 + (c.y / 10.0 - g.y) ** 2)) AS line_offset_m
FROM rawcorn c JOIN (SELECT * FROM grid SEMI JOIN lap_a {U}) g {US} GROUP BY ALL""")
def _(b):
    from catalog.series import pair

    still = grid(b).select(*SESSION).distinct().withColumns({"rotation_rad": F.lit(0.0), "tx": F.lit(0.0), "ty": F.lit(0.0)})
    return P.corner_positions(grid(b), raw_corners(b), still, pair(b)[0])


@query("flt14_split_corners", SS + "number:i anchor:b", "SELECT *, number % 2 = 1 AS anchor FROM corn")
def _(b):
    return P.split_corners(C.corners(b))


@query("flt19_misprojected", L + "misprojected:i", f"SELECT {K}, count(*) FILTER (WHERE abs(radius_off) > 1.5) AS misprojected FROM (SELECT *, sqrt(x * x + y * y) - {RADIUS} AS radius_off FROM tele) GROUP BY ALL")
def _(b):
    return P.misprojected(b.tele().withColumn("line_offset_m", F.abs(F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y")) - RADIUS)), 1.5)
