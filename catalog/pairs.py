"""Pair analysis."""

from pyspark.sql import functions as F

from catalog import metrics as Q
from catalog import segment as C
from catalog import validation as VQ
from catalog.binding import CTES
from catalog.registry import query
from catalog.segment import KS, SS, US
from catalog.series import K, L, U, curves, grid, pair
from trackgrid.keys import LAP, SESSION
from trackgrid.operators import metrics as M
from trackgrid.operators import pairs as P
from trackgrid.plans.findings import build_findings

PP = SS + "pair:s "
KP = f"{KS}, pair"
CTES["duel"] = f"SELECT a.season, a.round, a.session_code, a.driver AS da, b.driver AS db, a.lap_number AS la, b.lap_number AS lb FROM lap_a a JOIN lap_b b {US} SEMI JOIN good_lens {US}"
CTES["onep"] = f"SELECT *, da || ' L' || la || ' vs ' || db || ' L' || lb AS pair FROM duel"
CTES["allp"] = f"""
SELECT d.season, d.round, d.session_code, da, x.lap_number AS la, db, y.lap_number AS lb, da || ' L' || x.lap_number || ' vs ' || db || ' L' || y.lap_number AS pair, y.lap_time_s - x.lap_time_s AS gap_s
FROM duel d JOIN lsum x ON x.season = d.season AND x.round = d.round AND x.session_code = d.session_code AND x.driver = da AND x.lap_time_s IS NOT NULL
JOIN lsum y ON y.season = d.season AND y.round = d.round AND y.session_code = d.session_code AND y.driver = db AND y.lap_time_s IS NOT NULL"""
CTES["secf"] = f"""
SELECT m.season, m.round, m.session_code, microsector_id, m.phase, m.event_id, m.corners, m.start_m, m.end_m, m.end_m - m.start_m AS length_m, within_driver_std_s AS sigma_s
FROM msec m LEFT JOIN (SELECT {KS}, grain, microsector_id, within_driver_std_s FROM msum) USING ({KS}, grain, microsector_id) WHERE grain = 'corner_phase'"""


def _dec(src):
    on = lambda t, s: f"{t}.season = p.season AND {t}.round = p.round AND {t}.session_code = p.session_code AND {t}.driver = p.d{s} AND {t}.lap_number = p.l{s} AND {t}.grain = 'corner_phase' AND {t}.microsector_id = f.microsector_id"
    return f"""SELECT p.season, p.round, p.session_code, p.pair, f.microsector_id, f.phase, f.event_id, f.corners, f.start_m, f.length_m, f.sigma_s, coalesce(a.partial, true) OR coalesce(b.partial, true) AS partial,
 b.time_s - a.time_s AS delta_s, CASE WHEN f.sigma_s > 0 THEN abs(b.time_s - a.time_s) / f.sigma_s END AS ratio FROM {src} p JOIN secf f ON f.season = p.season AND f.round = p.round AND f.session_code = p.session_code
 LEFT JOIN mt a ON {on('a', 'a')} LEFT JOIN mt b ON {on('b', 'b')}"""


CTES["dec1"], CTES["deca"] = _dec("onep"), _dec("allp")
_FULL = "NOT partial AND delta_s IS NOT NULL"
_SUMS = "count(*) AS sectors, sum(length_m) AS length_m, sum(delta_s) AS delta_s, sqrt(sum(sigma_s * sigma_s)) AS sigma_s, abs(sum(delta_s)) / nullif(sqrt(sum(sigma_s * sigma_s)), 0) AS ratio"
CTES["eva"] = f"SELECT {KP}, event_id, any_value(corners) AS corners, {_SUMS} FROM deca WHERE {_FULL} AND phase <> 'straight' GROUP BY {KP}, event_id"
CTES["agree_sql"] = f"""
SELECT *, positive = pairings OR positive = 0 AS always_same_sign FROM (SELECT {KS}, event_id, count(*) AS pairings, count(*) FILTER (WHERE delta_s > 0) AS positive, median(delta_s) AS median_s, min(delta_s) AS min_s, max(delta_s) AS max_s,
 any_value(n.sigma_s) AS sigma_s, count(*) FILTER (WHERE abs(delta_s) >= 2 * n.sigma_s) AS above_2_sigma FROM eva JOIN (SELECT {KS}, event_id, sqrt(sum(sigma_s * sigma_s)) AS sigma_s FROM secf WHERE phase <> 'straight' GROUP BY ALL) n USING ({KS}, event_id) GROUP BY ALL)"""


def one(b):
    a, z = pair(b)
    side = lambda df, s: df.select(*SESSION, F.col("driver").alias(f"driver_{s}"), F.col("lap_number").alias(f"lap_{s}"))
    both = side(a, "a").join(side(z, "b"), list(SESSION)).join(C.lengths(b), list(SESSION), "left_semi")
    return b.staged("one_pair", lambda: both.withColumn("pair", P.pair_label()))


def every(b):
    return b.staged("all_pairs", lambda: P.lap_pairs(Q.lap_summary(b), one(b).select(*SESSION, "driver_a", "driver_b")))


def split(b):
    return P.decompose(Q.times(b), C.sectors(b), Q.summary(b), one(b))


def split_all(b):
    return P.decompose(Q.times(b), C.sectors(b), Q.summary(b), every(b))


def agreement(b):
    return b.staged("agreement", lambda: P.consistency(split_all(b)["events"], P.event_noise(C.sectors(b), Q.summary(b))))


@query("par01_sector_frame", SS + "microsector_id:i phase:s event_id:d start_m:d length_m:d sigma_s:d", "SELECT * FROM secf")
def _(b):
    return P.sector_frame(C.sectors(b), Q.summary(b))


@query("par02_decompose_sectors", PP + "microsector_id:i phase:s partial:b delta_s:d ratio:d", "SELECT * FROM dec1")
def _(b):
    return split(b)["sectors"]


@query("par02_decompose_events", PP + "event_id:i sectors:i length_m:d delta_s:d sigma_s:d ratio:d", f"SELECT {KP}, event_id, {_SUMS} FROM dec1 WHERE {_FULL} AND phase <> 'straight' GROUP BY {KP}, event_id")
def _(b):
    return split(b)["events"]


@query("par02_decompose_phases", PP + "phase:s sectors:i length_m:d delta_s:d sigma_s:d ratio:d", f"SELECT {KP}, phase, {_SUMS} FROM dec1 WHERE {_FULL} GROUP BY {KP}, phase")
def _(b):
    return split(b)["phases"]


@query("par03_above_noise", PP + "event_id:i ratio:d", f"SELECT * FROM eva WHERE ratio >= 2")
def _(b):
    return P.above_noise(split_all(b)["events"])


@query("par04_pairings", PP + "lap_a:i lap_b:i gap_s:d total_s:d straights_s:d", f"""
SELECT p.season, p.round, p.session_code, p.pair, la AS lap_a, lb AS lap_b, gap_s, sum(delta_s) FILTER (WHERE {_FULL}) AS total_s, sum(delta_s) FILTER (WHERE {_FULL} AND phase = 'straight') AS straights_s
FROM allp p JOIN deca USING ({KP}) GROUP BY ALL""")
def _(b):
    return P.pairings(split_all(b), every(b))


@query("set06_pairings_wide", PP + "events:s first_s:d last_s:d sum_s:d", f"""
SELECT {KP}, string_agg(event_id::BIGINT, ',' ORDER BY event_id) AS events, arg_min(delta_s, event_id) AS first_s, arg_max(delta_s, event_id) AS last_s, sum(delta_s) AS sum_s FROM eva GROUP BY ALL""")
def _(b):
    wide = P.pairings_wide(split_all(b)).withColumns({"k": F.map_keys("deltas"), "v": F.map_values("deltas")})
    summed = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return wide.select(*P.PAIR, F.array_join(F.transform("k", lambda x: x.cast("long").cast("string")), ",").alias("events"), F.col("v")[0].alias("first_s"), F.element_at("v", -1).alias("last_s"), summed.alias("sum_s"))


@query("set06_pairings_columns", PP + "event_0:d event_1:d event_2:d", f"""
SELECT {KP}, max(delta_s) FILTER (WHERE event_id = 0) AS event_0, max(delta_s) FILTER (WHERE event_id = 1) AS event_1, max(delta_s) FILTER (WHERE event_id = 2) AS event_2 FROM eva GROUP BY ALL""")
def _(b):
    wide = P.pairings_wide(split_all(b), [0, 1, 2])
    return wide.select(*P.PAIR, *[F.col(str(i)).alias(f"event_{i}") for i in range(3)])


@query("par05_event_noise", SS + "event_id:i sigma_s:d", f"SELECT {KS}, event_id, sqrt(sum(sigma_s * sigma_s)) AS sigma_s FROM secf WHERE phase <> 'straight' GROUP BY ALL")
def _(b):
    return P.event_noise(C.sectors(b), Q.summary(b))


AGREE = SS + "event_id:i pairings:i positive:i median_s:d min_s:d max_s:d sigma_s:d above_2_sigma:i always_same_sign:b"


@query("agg25_consistency", AGREE, "SELECT * FROM agree_sql")
def _(b):
    return P.consistency(split_all(b)["events"], P.event_noise(C.sectors(b), Q.summary(b)))


@query("par05_control", SS + "event_id:i delta_s:d", f"""
WITH c AS (SELECT x.season, x.round, x.session_code, x.driver, x.lap_number AS la, y.lap_number AS lb FROM quick x JOIN quick y USING ({KS}, driver) WHERE x.place = 2 AND y.place = 1 AND x.seat = 1)
SELECT c.season, c.round, c.session_code, f.event_id, sum(b.time_s - a.time_s) AS delta_s FROM c JOIN secf f ON f.season = c.season AND f.round = c.round AND f.session_code = c.session_code
JOIN mt a ON a.season = c.season AND a.round = c.round AND a.session_code = c.session_code AND a.driver = c.driver AND a.lap_number = la AND a.grain = 'corner_phase' AND a.microsector_id = f.microsector_id AND NOT a.partial
JOIN mt b ON b.season = c.season AND b.round = c.round AND b.session_code = c.session_code AND b.driver = c.driver AND b.lap_number = lb AND b.grain = 'corner_phase' AND b.microsector_id = f.microsector_id AND NOT b.partial
WHERE f.phase <> 'straight' GROUP BY ALL""")
def _(b):
    first = one(b).select(*SESSION, F.col("driver_a").alias("driver"))
    best = M.quickest(Q.lap_summary(b), 2).join(first, [*SESSION, "driver"], "left_semi")
    side = lambda place, s: best.filter(F.col("place") == place).select(*SESSION, F.col("driver").alias(f"driver_{s}"), F.col("lap_number").alias(f"lap_{s}"))
    pairs = side(2, "a").join(side(1, "b"), list(SESSION)).withColumn("pair", P.pair_label())
    return P.decompose(Q.times(b), C.sectors(b), Q.summary(b), pairs)["events"]


@query("par06_choose_focus", SS + "event_id:i median_s:d", f"""
SELECT {KS}, event_id, median_s FROM (SELECT *, row_number() OVER (PARTITION BY {KS} ORDER BY always_same_sign DESC, abs(median_s) DESC, event_id) AS rn FROM agree_sql) WHERE rn = 1""")
def _(b):
    return P.choose_focus(agreement(b))


@query("par06b_official_gap", PP + "official_gap_s:d", f"""
SELECT p.season, p.round, p.session_code, p.pair, y.lap_time_s - x.lap_time_s AS official_gap_s FROM onep p JOIN lsum x ON x.season = p.season AND x.round = p.round AND x.session_code = p.session_code AND x.driver = da AND x.lap_number = la
JOIN lsum y ON y.season = p.season AND y.round = p.round AND y.session_code = p.session_code AND y.driver = db AND y.lap_number = lb""")
def _(b):
    P.lap_row(Q.lap_summary(b), P.side_of(one(b), "a"), "lap_summary")
    return P.official_gap(Q.lap_summary(b), one(b))


@query("par06b_single_lap", L + "lap_time_s:d", f"SELECT l.* FROM lsum l SEMI JOIN lap_a {U} SEMI JOIN good_lens {US}")
def _(b):
    return P.lap_row(Q.lap_summary(b), P.side_of(one(b), "a"), "lap_summary")


_PT = lambda s, i, n: f"JOIN curves {n} ON {n}.season = p.season AND {n}.round = p.round AND {n}.session_code = p.session_code AND {n}.driver = d{s} AND {n}.lap_number = l{s} AND {n}.grid_index = {i}"
CTES["recon_pair"] = f"""
WITH e AS (SELECT p.*, s1_m, s2_m, CAST(round_even(s1_m / 10.0, 0) AS BIGINT) AS i1, CAST(round_even(s2_m / 10.0, 0) AS BIGINT) AS i2, least(x.n_points, y.n_points) - 1 AS i3 FROM onep p JOIN bnds {US}
 JOIN lapn x ON x.season = p.season AND x.round = p.round AND x.session_code = p.session_code AND x.driver = da AND x.lap_number = la JOIN lapn y ON y.season = p.season AND y.round = p.round AND y.session_code = p.session_code AND y.driver = db AND y.lap_number = lb),
c AS (SELECT p.*, b1.t_s - a1.t_s AS c1, b2.t_s - a2.t_s AS c2, b3.t_s - a3.t_s AS c3 FROM e p {_PT('a', 'i1', 'a1')} {_PT('b', 'i1', 'b1')} {_PT('a', 'i2', 'a2')} {_PT('b', 'i2', 'b2')} {_PT('a', 'i3', 'a3')} {_PT('b', 'i3', 'b3')}),
w AS (SELECT c.*, y.s1_official_s - x.s1_official_s AS o1, y.s2_official_s - x.s2_official_s AS o2, y.s3_official_s - x.s3_official_s AS o3, v.s1_residual_s - u.s1_residual_s AS r1, v.s2_residual_s - u.s2_residual_s AS r2, v.s3_residual_s - u.s3_residual_s AS r3, v.start_offset_s - u.start_offset_s AS so FROM c
 JOIN lsum x ON x.season = c.season AND x.round = c.round AND x.session_code = c.session_code AND x.driver = da AND x.lap_number = la JOIN lsum y ON y.season = c.season AND y.round = c.round AND y.session_code = c.session_code AND y.driver = db AND y.lap_number = lb
 JOIN truth u ON u.season = c.season AND u.round = c.round AND u.session_code = c.session_code AND u.driver = da AND u.lap_number = la JOIN truth v ON v.season = c.season AND v.round = c.round AND v.session_code = c.session_code AND v.driver = db AND v.lap_number = lb)
SELECT {KP}, unnest(['s1', 's2', 's3']) AS sector, unnest([o1, o2, o3]) AS official_gap_s, unnest([c1, c2 - c1, c3 - c2]) AS grid_gap_s, unnest([s1_m, s2_m, i3 * 10.0::DOUBLE]) AS boundary_m, unnest([-so, r2, r3]) AS explained_s FROM w"""


@query("par07_sector_reconciliation", PP + "sector:s official_gap_s:d grid_gap_s:d boundary_m:d difference_s:d explained_s:d unexplained_s:d", "SELECT *, grid_gap_s - official_gap_s AS difference_s, grid_gap_s - official_gap_s - explained_s AS unexplained_s FROM recon_pair")
def _(b):
    return P.sector_reconciliation(Q.lap_summary(b), VQ.truth(b), curves(b), Q.boundaries(b), one(b))


CTES["apps"] = f"""
WITH w AS (SELECT g.season, g.round, g.session_code, g.driver, g.lap_number, e.event_id, distance_m, grid_index - row_number() OVER (PARTITION BY {', '.join('g.' + k for k in LAP)}, e.event_id ORDER BY grid_index) AS isl FROM grid g JOIN good_evs e {US} WHERE brake AND distance_m BETWEEN left_max_m AND apex_m),
r AS (SELECT {K}, event_id, isl, min(distance_m) AS on_m, max(distance_m) AS off_m FROM w GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY {K}, event_id ORDER BY on_m) AS application, count(*) OVER (PARTITION BY {K}, event_id) AS "of" FROM r)
SELECT {K}, event_id, coalesce(application, 0) AS application, coalesce("of", 0) AS "of", on_m, off_m, coalesce(application = "of", false) AS leads_into_apex FROM lapn JOIN (SELECT {KS}, event_id FROM good_evs) {US} LEFT JOIN o USING ({K}, event_id)"""


@query("par08_brake_applications", L + "event_id:i application:i of:i on_m:d off_m:d leads_into_apex:b", "SELECT * FROM apps")
def _(b):
    return P.brake_applications(grid(b), C.events(b), grid(b).select(*LAP).distinct())


@query("par09_leading_application", L + "event_id:i on_m:d", "SELECT * FROM apps WHERE leads_into_apex")
def _(b):
    return P.leading_application(P.brake_applications(grid(b), C.events(b), grid(b).select(*LAP).distinct()))


_AP = lambda s: f"(SELECT p.season, p.round, p.session_code, pair, a.event_id, max(\"of\") AS n, max(on_m) FILTER (WHERE leads_into_apex) AS lead_m, any_value(m.brake_on_m) AS metric FROM onep p JOIN apps a ON a.season = p.season AND a.round = p.round AND a.session_code = p.session_code AND a.driver = d{s} AND a.lap_number = l{s} LEFT JOIN cm m ON m.season = p.season AND m.round = p.round AND m.session_code = p.session_code AND m.driver = d{s} AND m.lap_number = l{s} AND m.event_id = a.event_id GROUP BY ALL)"
CTES["brk"] = f"""
SELECT *, CASE WHEN NOT has_braking OR metric_delta_m IS NULL OR leading_delta_m IS NULL THEN 'no braking' WHEN NOT m AND NOT l THEN 'agree' WHEN m AND l THEN 'confirmed' WHEN applications_a <> applications_b THEN 'metric artefact' ELSE 'definition-sensitive' END AS verdict FROM
 (SELECT *, coalesce(abs(metric_delta_m) > 20, false) AS m, coalesce(abs(leading_delta_m) > 20, false) AS l FROM (SELECT {KP}, event_id, has_braking, x.n AS applications_a, y.n AS applications_b, y.metric - x.metric AS metric_delta_m, y.lead_m - x.lead_m AS leading_delta_m
  FROM {_AP('a')} x JOIN {_AP('b')} y USING ({KP}, event_id) JOIN (SELECT {KS}, event_id, has_braking FROM good_evs) USING ({KS}, event_id)))"""


@query("par09_braking_comparison", PP + "event_id:i applications_a:i applications_b:i metric_delta_m:d leading_delta_m:d verdict:s", "SELECT * FROM brk")
def _(b):
    return P.braking_comparison(grid(b), C.events(b), C.metrics(b), one(b))


@query("par10_braking_summary", PP + "events:i agree:i multi_application:i metric_outside_window:i leading_outside_window:i", f"""
SELECT {KP}, count(*) AS events, count(*) FILTER (WHERE verdict = 'agree') AS agree, count(*) FILTER (WHERE greatest(applications_a, applications_b) > 1) AS multi_application,
 count(*) FILTER (WHERE m) AS metric_outside_window, count(*) FILTER (WHERE l) AS leading_outside_window FROM brk WHERE has_braking GROUP BY ALL""")
def _(b):
    return P.braking_summary(P.braking_comparison(grid(b), C.events(b), C.metrics(b), one(b)))


@query("agg22_dab_prevalence", L + "dabbed:b", f"SELECT {K}, bool_or(brake) AS dabbed FROM grid WHERE distance_m BETWEEN 300 AND 460 GROUP BY ALL")
def _(b):
    windows = grid(b).select(*SESSION).distinct().withColumns({"low_m": F.lit(300.0), "high_m": F.lit(460.0)})
    return P.dab_prevalence(grid(b), windows)


@query("par11_speed_deficit", PP + "mean_kmh:d min_kmh:d max_kmh:d points:i slower_points:i share_slower:d", f"""
SELECT p.season, p.round, p.session_code, pair, avg(b.speed - a.speed) AS mean_kmh, min(b.speed - a.speed) AS min_kmh, max(b.speed - a.speed) AS max_kmh, count(*) AS points, count(*) FILTER (WHERE b.speed < a.speed) AS slower_points, count(*) FILTER (WHERE b.speed < a.speed) / count(*) AS share_slower
FROM allp p JOIN grid a ON a.season = p.season AND a.round = p.round AND a.session_code = p.session_code AND a.driver = da AND a.lap_number = la
JOIN grid b ON b.season = p.season AND b.round = p.round AND b.session_code = p.session_code AND b.driver = db AND b.lap_number = lb AND b.grid_index = a.grid_index WHERE a.distance_m BETWEEN 500 AND 700 GROUP BY ALL""")
def _(b):
    windows = grid(b).select(*SESSION).distinct().withColumns({"start_m": F.lit(500.0), "end_m": F.lit(700.0)})
    return P.speed_deficit(grid(b), every(b), windows)


@query("par12_build_findings", PP + "total_s:d focus_event:i focus_pairings:i max_unexplained_s:d nothing_above_2_sigma:b focus_same_sign:b sectors_explained:b braking_explained:b", f"""
SELECT p.season, p.round, p.session_code, p.pair, total_s, focus_event, focus_pairings, max_unexplained_s, coalesce(mr < 2, true) AS nothing_above_2_sigma, always_same_sign AS focus_same_sign, coalesce(max_unexplained_s <= 0.005, false) AS sectors_explained, coalesce(be, true) AS braking_explained FROM onep p
JOIN (SELECT {KP}, sum(delta_s) AS total_s FROM dec1 WHERE {_FULL} GROUP BY ALL) USING ({KP})
LEFT JOIN (SELECT {KP}, max(ratio) AS mr FROM (SELECT {KP}, event_id, {_SUMS} FROM dec1 WHERE {_FULL} AND phase <> 'straight' GROUP BY {KP}, event_id) GROUP BY ALL) USING ({KP})
JOIN (SELECT {KS}, event_id AS focus_event, pairings AS focus_pairings, always_same_sign FROM (SELECT *, row_number() OVER (PARTITION BY {KS} ORDER BY always_same_sign DESC, abs(median_s) DESC, event_id) AS rn FROM agree_sql) WHERE rn = 1) {US}
LEFT JOIN (SELECT {KS}, max(abs(grid_gap_s - official_gap_s - explained_s)) AS max_unexplained_s FROM recon_pair GROUP BY ALL) {US}
LEFT JOIN (SELECT {KS}, bool_and(verdict IN ('confirmed', 'metric artefact')) FILTER (WHERE m) AS be FROM brk WHERE has_braking GROUP BY ALL) {US}""")
def _(b):
    tables = {
        "lap_summary": Q.lap_summary(b), "ground_truth": VQ.truth(b), "microsector_times": Q.times(b), "microsector_summary": Q.summary(b), "corner_metrics": C.metrics(b),
        "curves": curves(b), "grid": grid(b), "microsectors": C.sectors(b), "events": C.events(b), "boundaries": Q.boundaries(b),
    }
    return build_findings(tables, one(b).drop("pair"))["summary"]
