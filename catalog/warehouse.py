"""Reference tables, dimensions, facts and the queries that read them."""


import uuid

from pyspark.sql import functions as F

from catalog import metrics as Q
from catalog import pairs as PQ
from catalog import segment as C
from catalog import validation as VQ
from catalog.binding import CTES
from catalog.registry import query
from catalog.segment import KS, SS, US
from catalog.series import K, L, U, delta, grid
from trackgrid.functions.columns import flag
from trackgrid.keys import LAP, SESSION
from trackgrid.operators import calendar as R
from trackgrid.operators import layouts as Y
from trackgrid.plans import warehouse as W
from trackgrid.session import shared_dir
from trackgrid.sources import landing, tables

SR = "season:i round:i "

# ---- payloads made from orders, customers, suppliers and nations -------------
# a race per order month, its entries are the month's orders, split over pages of order keys


def race_pages(b):
    o = b.table("orders").join(b.table("customer"), F.col("o_custkey") == F.col("c_custkey")).join(b.table("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    o = o.withColumn("season", F.year("o_orderdate")).withColumn("round", F.month("o_orderdate"))
    text = lambda c: c.cast("string")
    driver = F.struct(
        F.concat(F.lit("d"), text(F.col("c_custkey"))).alias("driverId"), text(F.col("c_custkey") % 90).alias("permanentNumber"), F.when(F.col("c_custkey") % 10 != 0, F.concat(F.lit("C"), text(F.col("c_custkey")))).alias("code"),
        F.lit("u").alias("url"), F.col("c_mktsegment").alias("givenName"), F.col("c_name").alias("familyName"), F.lit("1990-01-01").alias("dateOfBirth"), F.col("n_name").alias("nationality"),
    )
    maker = F.struct(F.concat(F.lit("k"), text(F.col("o_orderkey") % 10)).alias("constructorId"), F.lit("u").alias("url"), F.concat(F.lit("K"), text(F.col("o_orderkey") % 10)).alias("name"), F.lit("n").alias("nationality"))
    entry = F.struct(F.when(F.col("o_orderkey") % 3 != 0, text(F.col("o_orderkey") % 99)).alias("number"), F.lit("1").alias("position"), driver.alias("Driver"), maker.alias("Constructor"))
    pages = o.withColumn("page", F.floor(F.col("o_orderkey") / 500)).groupBy("season", "round", "page").agg(
        F.array_sort(F.collect_list(F.struct("o_orderkey", entry.alias("e")))).alias("_e")
    )
    pages = pages.withColumn("_e", F.transform("_e", lambda s: s["e"]))
    moment = lambda day, clock: F.struct(F.format_string(f"%d-%02d-{day:02d}", "season", "round").alias("date"), F.lit(clock).alias("time"))
    circuit = F.struct(
        F.concat(F.lit("c"), text(F.col("round"))).alias("circuitId"), F.concat(F.lit("Circuit "), text(F.col("round"))).alias("circuitName"),
        F.struct(text(F.col("round") * 5.5).alias("lat"), text(F.col("round") * -10.25).alias("long"), F.lit("town").alias("locality"), F.lit("land").alias("country")).alias("Location"),
    )
    none = F.lit(None).cast(R.MOMENT)
    sprint = F.col("round") % 4 == 0
    return pages.select(
        F.to_json(F.struct(
            text(F.col("season")).alias("season"), text(F.col("round")).alias("round"), F.lit("url").alias("url"), F.concat(F.lit("Event "), text(F.col("round"))).alias("raceName"), circuit.alias("Circuit"),
            F.format_string("%d-%02d-07", "season", "round").alias("date"), F.when(F.col("season") > 1995, F.lit("14:00:00Z")).alias("time"),
            moment(5, "10:00:00Z").alias("FirstPractice"), F.when(sprint, none).otherwise(moment(5, "14:00:00Z")).alias("SecondPractice"), F.when(sprint, none).otherwise(moment(6, "10:00:00Z")).alias("ThirdPractice"),
            moment(6, "14:00:00Z").alias("Qualifying"), F.when(sprint, moment(5, "15:00:00Z")).otherwise(none).alias("SprintQualifying"), F.when(sprint, moment(6, "11:00:00Z")).otherwise(none).alias("Sprint"),
            F.when(F.col("round") % 2 == 0, F.col("_e")).alias("QualifyingResults"), F.when(F.col("round") % 5 != 0, F.col("_e")).otherwise(F.array().cast(f"array<{R.ENTRY}>")).alias("Results"),
        )).alias("payload"),
        "page",
    )


def races(b):
    return R.parse_races(b.staged("race_pages", lambda: race_pages(b)))


def schedule(b):
    return R.session_schedule(races(b))


CTES["rounds"] = "SELECT DISTINCT year(o_orderdate) AS season, month(o_orderdate) AS round FROM orders"
CTES["sched"] = """
SELECT season, round, session, strptime(d || ' ' || t, '%Y-%m-%d %H:%M:%S') AS session_start_utc, has_time FROM (
 SELECT season, round, unnest(['FP1', 'FP2', 'FP3', 'Q', 'SQ', 'S', 'R']) AS session, unnest([5, 5, 6, 6, 5, 6, 7]) AS dd, unnest(['10:00:00', '14:00:00', '10:00:00', '14:00:00', '15:00:00', '11:00:00', CASE WHEN season > 1995 THEN '14:00:00' ELSE '00:00:00' END]) AS t,
  unnest([true, true, true, true, true, true, season > 1995]) AS has_time, unnest([true, round % 4 <> 0, round % 4 <> 0, true, round % 4 = 0, round % 4 = 0, true]) AS ok, season || '-' || lpad(round::VARCHAR, 2, '0') || '-0' || dd AS d
 FROM rounds) WHERE ok"""
CTES["entr"] = """
SELECT season, round, 'C' || o_custkey AS code, 'd' || o_custkey AS driver_id, 'k' || (o_orderkey % 10) AS constructor_id, 'K' || (o_orderkey % 10) AS constructor_name, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 99 ELSE o_custkey % 90 END AS car_number FROM
 (SELECT *, year(o_orderdate) AS season, month(o_orderdate) AS round, row_number() OVER (PARTITION BY year(o_orderdate), month(o_orderdate), o_custkey ORDER BY o_orderkey) AS rn FROM orders WHERE o_custkey % 10 <> 0 AND (month(o_orderdate) % 2 = 0 OR month(o_orderdate) % 5 <> 0)) WHERE rn = 1"""


@query("ref01_event_table", SR + "event_name:s circuit_id:s lat:d lon:d race_date:s", "SELECT *, 'Event ' || round AS event_name, 'c' || round AS circuit_id, round * 5.5 AS lat, round * -10.25 AS lon, season || '-' || lpad(round::VARCHAR, 2, '0') || '-07' AS race_date FROM rounds")
def _(b):
    return R.event_table(races(b))


@query("ref02_session_schedule", SR + "session:s session_start:i has_time:b", "SELECT *, epoch(session_start_utc) AS session_start FROM sched")
def _(b):
    return schedule(b).withColumn("session_start", F.unix_timestamp("session_start_utc"))


@query("srt02_session_order", SR + "session:s place:i", "SELECT *, list_position(['FP1', 'FP2', 'FP3', 'SQ', 'S', 'Q', 'R'], session) - 1 AS place FROM sched")
def _(b):
    return R.in_session_order(schedule(b)).withColumn("place", R.session_rank())


@query("ref03_driver_table", "season:i code:s driver_id:s permanent_number:i full_name:s", "SELECT 2024 AS season, 'C' || c_custkey AS code, 'd' || c_custkey AS driver_id, c_custkey % 90 AS permanent_number, c_mktsegment || ' ' || c_name AS full_name FROM customer WHERE c_custkey % 10 <> 0")
def _(b):
    c = b.table("customer")
    key = F.col("c_custkey").cast("string")
    return R.driver_table(c.select(
        F.lit("2024").alias("season"), F.when(F.col("c_custkey") % 10 != 0, F.concat(F.lit("C"), key)).otherwise("").alias("code"), F.concat(F.lit("d"), key).alias("driverId"), (F.col("c_custkey") % 90).cast("string").alias("permanentNumber"),
        F.col("c_mktsegment").alias("givenName"), F.col("c_name").alias("familyName"), F.lit("1990-01-01").alias("dateOfBirth"), F.lit("x").alias("nationality"), F.lit("u").alias("url"),
    ))


@query("ref04_constructor_table", "season:i constructor_id:s name:s", "SELECT 2024 AS season, 's' || s_suppkey AS constructor_id, s_name AS name FROM supplier")
def _(b):
    return R.constructor_table(b.table("supplier").select(F.lit("2024").alias("season"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("constructorId"), F.col("s_name").alias("name"), F.lit("n").alias("nationality"), F.lit("u").alias("url")))


@query("ref05_driver_entries", SR + "code:s driver_id:s constructor_id:s constructor_name:s car_number:i", "SELECT * FROM entr")
def _(b):
    return R.driver_entries(races(b))


@query("ref06_resolve_constructor", SR + "code:s constructor_id:s", "SELECT season, round, code, constructor_id FROM (SELECT DISTINCT year(o_orderdate) AS season, month(o_orderdate) AS round, 'C' || o_custkey AS code FROM orders) LEFT JOIN entr USING (season, round, code)")
def _(b):
    rows = b.table("orders").select(F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("round"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("code")).distinct()
    return R.resolve_constructor(rows, R.driver_entries(races(b)))


@query("ref06b_load_reference", SR + "session:s", "SELECT * FROM sched WHERE season = 1997")
def _(b):
    return R.load_reference({"dim_session_schedule": schedule(b), "dim_event": R.event_table(races(b))}, 1997)["dim_session_schedule"]


@query("ref07_skipped_rounds", SR + "reason:s", "SELECT *, 'no qualifying or race result' AS reason FROM rounds WHERE round % 2 <> 0 AND round % 5 = 0")
def _(b):
    return R.skipped_rounds(races(b), R.driver_entries(races(b)))


def _season_people(b):
    """Drivers and constructors named by the entries of each season's races."""
    e = races(b).select("season", F.explode(F.concat(F.coalesce("QualifyingResults", F.array().cast(f"array<{R.ENTRY}>")), F.coalesce("Results", F.array().cast(f"array<{R.ENTRY}>")))).alias("e"))
    drivers = e.select("season", "e.Driver.*").distinct()
    return drivers, e.select("season", "e.Constructor.*").distinct()


@query("ref07_ingest_reference", "season:i table:s rows:i reason:s", """
WITH n AS (SELECT season, 'dim_event' AS "table", count(*) AS rows FROM rounds GROUP BY ALL UNION ALL SELECT season, 'dim_session_schedule', count(*) FROM sched GROUP BY ALL
 UNION ALL SELECT season, 'driver_entry', count(*) FROM entr GROUP BY ALL
 UNION ALL SELECT year(o_orderdate), 'dim_driver', count(DISTINCT o_custkey) FROM orders WHERE o_custkey % 10 <> 0 AND (month(o_orderdate) % 2 = 0 OR month(o_orderdate) % 5 <> 0) GROUP BY ALL
 UNION ALL SELECT year(o_orderdate), 'dim_constructor', count(DISTINCT o_orderkey % 10) FROM orders WHERE month(o_orderdate) % 2 = 0 OR month(o_orderdate) % 5 <> 0 GROUP BY ALL)
SELECT season, "table", rows, NULL AS reason FROM n WHERE season <> 1997 UNION ALL SELECT 1997, NULL, NULL, 'dim_event: NotNull (' || count(*) || ' rows)' FROM rounds WHERE season = 1997""")
def _(b):
    from trackgrid.plans.reference import ingest_reference

    nowhere = F.col("Circuit").withField("Location", F.col("Circuit.Location").withField("lat", F.lit("unknown")))
    rows = races(b).withColumn("Circuit", F.when(F.col("season") == "1997", nowhere).otherwise(F.col("Circuit")))
    drivers, makers = _season_people(b)
    found = ingest_reference(b.spark, _root(b, "reference"), rows, drivers, makers, "2024-01-01")
    return found.tables.unionByName(found.refused, allowMissingColumns=True)


_NOW = "TIMESTAMP '2001-06-06 16:59:59'"


@query("flt05_sessions_due", SR + "session_code:s event_name:s", f"SELECT season, round, session AS session_code, 'Event ' || round AS event_name FROM sched WHERE session IN ('Q', 'R') AND session_start_utc <= {_NOW} - INTERVAL 180 MINUTE")
def _(b):
    return R.sessions_due(schedule(b), R.event_table(races(b)), F.expr(_NOW))


@query("qry09_outstanding", SR + "session_code:s run_id:s", f"""
SELECT season, round, session AS session_code, 'session__' || season || '_' || round || '_' || lower(session) AS run_id FROM sched s WHERE session IN ('Q', 'R') AND session_start_utc <= {_NOW} - INTERVAL 180 MINUTE
AND NOT EXISTS (SELECT 1 FROM rounds r WHERE r.season = s.season AND r.round = s.round AND r.round < 4 AND session = 'R')""")
def _(b):
    due = R.sessions_due(schedule(b), R.event_table(races(b)), F.expr(_NOW))
    loaded = schedule(b).filter("session = 'R' AND round < 4").withColumnRenamed("session", "session_code")
    return R.not_yet_loaded(due, loaded).withColumn("run_id", R.run_id())


# every order is an event at the circuit of its customer's nation
_CIRC = "['suzuka', 'bahrain', 'albert_park', 'catalunya', 'marina_bay', 'yas_marina', 'losail', 'red_bull_ring', 'sochi', 'nowhere']"


_LAY = "VALUES " + ", ".join(f"('{l}', '{c}', {m}, {a}, {'NULL' if z is None else z})" for l, c, m, a, z in Y.LAYOUTS)


@query("flt06_resolve_layout", "session_key:i season:i circuit_id:s layout_id:s length_m:d resolved:b", f"""
WITH lay(l, c, m, a, z) AS ({_LAY}), s AS (SELECT o_orderkey AS session_key, year(o_orderdate) + 24 AS season, {_CIRC}[o_custkey % 10 + 1] AS circuit_id, o_orderkey % 2 = 0 AS sakhir FROM orders),
j AS (SELECT s.*, count(l) AS n, max(l) AS l, max(m) AS m FROM s LEFT JOIN lay ON c = circuit_id AND a <= season AND (z IS NULL OR season <= z) GROUP BY ALL)
SELECT session_key, season, circuit_id, CASE WHEN season = 2020 AND sakhir THEN 'bahrain_outer' WHEN n = 1 THEN l END AS layout_id, CASE WHEN season = 2020 AND sakhir THEN 3543 WHEN n = 1 THEN m END AS length_m, (season = 2020 AND sakhir) OR n = 1 AS resolved FROM j""")
def _(b):
    names = F.array(*[F.lit(c) for c in ("suzuka", "bahrain", "albert_park", "catalunya", "marina_bay", "yas_marina", "losail", "red_bull_ring", "sochi", "nowhere")])
    o = b.table("orders").select(
        F.col("o_orderkey").alias("session_key"), (F.year("o_orderdate") + 24).alias("season"), F.element_at(names, (F.col("o_custkey") % 10 + 1).cast("int")).alias("circuit_id"),
        F.when(F.col("o_orderkey") % 2 == 0, "Sakhir Grand Prix").otherwise("Other").alias("event_name"),
    )
    return Y.resolve_layouts(o, Y.layout_table(b.spark), Y.override_table(b.spark)).withColumn("resolved", F.col("reason").isNull())


@query("jon11_season_range", "o_orderkey:i band:s", "SELECT o_orderkey, CASE WHEN year(o_orderdate) <= 1996 THEN 'early' WHEN year(o_orderdate) <= 1998 THEN 'middle' ELSE 'late' END AS band FROM orders")
def _(b):
    bands = Y.layout_table(b.spark, (("early", "x", 1, 1900, 1996), ("middle", "x", 2, 1997, 1998), ("late", "x", 3, 1999, None)))
    o = b.table("orders").select(F.col("o_orderkey").alias("session_key"), F.year("o_orderdate").alias("season"), F.lit("x").alias("circuit_id"), F.lit("e").alias("event_name"))
    done = Y.resolve_layouts(o, bands, Y.override_table(b.spark))
    return done.select(F.col("session_key").alias("o_orderkey"), F.col("layout_id").alias("band"))


# ---- star schema -----------------------------------------------------------

def meta(b):
    s = grid(b).select(*SESSION).distinct()
    nations = b.table("nation").select(F.col("n_nationkey").alias("round"), "n_name")
    return s.join(nations, "round", "left").select(
        F.col("season"), F.concat(F.lit("Event "), F.col("round").cast("string")).alias("event_requested"), F.col("session_code").alias("session_requested"), F.lit(None).cast("string").alias("session_name"),
        F.format_string("2024-0%d-02", F.col("round").cast("int")).alias("session_date"), F.when(F.col("round") % 2 == 0, F.concat(F.lit("GP "), F.col("round").cast("string"))).alias("event_name"),
        F.col("n_name").alias("country"), F.lit("loc").alias("location"), F.col("round").alias("round_number"),
    )


def dim_lap(b):
    return b.staged("dim_lap", lambda: W.dim_lap(Q.lap_summary(b), VQ.truth(b), entries(b)))


def entries(b):
    return grid(b).select("season", "round", F.col("driver").alias("code")).distinct().withColumn("constructor_id", F.concat(F.lit("k"), F.length("code").cast("string")))


def fact_grid(b):
    return b.staged("fact_grid", lambda: W.fact_grid(grid(b), delta(b), dim_lap(b)))


def fact_micro(b):
    return b.staged("fact_micro", lambda: W.fact_microsector(Q.times(b), dim_lap(b)))


def one_pair(b):
    p = PQ.one(b)
    ids = lambda s: p.select(*SESSION, F.col(f"driver_{s}").alias("code"), F.col(f"lap_{s}").alias("lap_number")).join(dim_lap(b).select(*SESSION, "code", "lap_number", F.col("lap_id").alias(f"lap_{s}")), [*SESSION, "code", "lap_number"]).select(*SESSION, f"lap_{s}")
    return ids("a").join(ids("b"), list(SESSION))


@query("dim01_session", SS + "event_name:s circuit_id:s country:s start:i", f"""
SELECT {KS}, CASE WHEN round = 1 THEN 'Event 1' WHEN round % 2 = 0 THEN 'GP ' || round ELSE 'Event ' || round END AS event_name, CASE WHEN round = 1 THEN 'c1' END AS circuit_id, CASE WHEN round = 1 THEN 'land' ELSE n_name END AS country,
 CASE WHEN round = 1 AND session_code = 'Q' THEN epoch(TIMESTAMP '2024-03-09 15:00:00') ELSE epoch(strptime('2024-0' || round || '-02', '%Y-%m-%d')) END AS start FROM (SELECT DISTINCT {KS} FROM tele) LEFT JOIN nation ON n_nationkey = round""")
def _(b):
    first = meta(b).filter("round_number = 1").select("season", F.col("round_number").alias("round")).distinct()
    ev = first.select("season", "round", F.lit("Event 1").alias("event_name"), F.lit("c1").alias("circuit_id"), F.lit("Circuit").alias("circuit_name"), F.lit("town").alias("locality"), F.lit("land").alias("country"))
    sch = first.select("season", "round", F.lit("Q").alias("session"), F.lit("2024-03-09 15:00:00").cast("timestamp").alias("session_start_utc"))
    return W.dim_session(meta(b), None, ev, sch).withColumn("start", F.unix_timestamp("session_start_utc"))


@query("dim02_lap", SS + "code:s lap_number:i constructor_id:s team_alias:s lap_time_s:d lap_residual_s:d driven_m:d start_coverage_poor:b reference_lap:s", f"""
SELECT l.season, l.round, l.session_code, l.driver AS code, l.lap_number, 'k' || length(l.driver) AS constructor_id, team AS team_alias, l.lap_time_s, t.lap_residual_s, driven_m, start_coverage_poor, reference AS reference_lap FROM lsum l JOIN truth t {U}""")
def _(b):
    return W.dim_lap(Q.lap_summary(b), VQ.truth(b), entries(b))


@query("dim03_microsector", SS + "grain:s microsector_id:i phase:s length_m:d", "SELECT *, end_m - start_m AS length_m FROM msec")
def _(b):
    return W.dim_microsector(C.sectors(b))


@query("dim03_corner_event", SS + "event_id:i apex_m:d exit_end_m:d has_braking:b", "SELECT * FROM good_evs")
def _(b):
    return W.dim_corner_event(C.events(b))


@query("dim04_lap_ids", SS + "laps:i ids:i", f"SELECT {KS}, count(*) AS laps, count(*) AS ids FROM lapn GROUP BY ALL")
def _(b):
    return dim_lap(b).groupBy(*SESSION).agg(F.count(F.lit(1)).alias("laps"), F.countDistinct("lap_id").alias("ids"))


@query("dim04_unknown_laps", L[:-1], f"SELECT {K} FROM lapn WHERE lap_number = 2")
def _(b):
    return W.unknown_laps(grid(b), dim_lap(b).filter("lap_number <> 2"))


@query("fct01_fact_grid", SS + "code:s lap_number:i grid_index:i t_s:d delta_t_s:d speed:d brake:b", "SELECT d.season, d.round, d.session_code, d.driver AS code, d.lap_number, grid_index, t_s, delta_t_s, g.speed, g.brake FROM delta d JOIN grid g USING (season, round, session_code, driver, lap_number, grid_index)")
def _(b):
    return W.fact_grid(grid(b), delta(b), dim_lap(b)).join(dim_lap(b).select(*SESSION, "lap_id", "code", "lap_number"), [*SESSION, "lap_id"])


@query("fct02_fact_microsector", SS + "code:s lap_number:i grain:s microsector_id:i time_s:d partial:b", "SELECT *, driver AS code FROM mt")
def _(b):
    return W.fact_microsector(Q.times(b), dim_lap(b)).join(dim_lap(b).select(*SESSION, "lap_id", "code", "lap_number"), [*SESSION, "lap_id"])


@query("fct03_fact_corner_metric", SS + "code:s lap_number:i event_id:i v_min_kmh:d brake_on_m:d", "SELECT *, driver AS code FROM cm")
def _(b):
    return W.fact_corner_metric(C.metrics(b), dim_lap(b)).join(dim_lap(b).select(*SESSION, "lap_id", "code", "lap_number"), [*SESSION, "lap_id"])


# ---- read queries ----------------------------------------------------------

@query("qry01_sessions", SS + "label:s", f"SELECT *, season || ' R' || round || ' ' || session_code || ' — ' || CASE WHEN round % 2 = 0 THEN 'GP ' ELSE 'Event ' END || round AS label FROM (SELECT DISTINCT {KS} FROM tele)")
def _(b):
    return W.sessions(W.dim_session(meta(b)))


@query("qry02_drivers", SS + "code:s best_s:d", f"SELECT {KS}, driver AS code, min(lap_time_s) AS best_s FROM lsum GROUP BY ALL")
def _(b):
    return W.drivers(dim_lap(b))


_FAST = f"SELECT * FROM (SELECT *, driver AS code, row_number() OVER (PARTITION BY {KS}, driver ORDER BY lap_time_s NULLS LAST, lap_number) AS rn FROM lsum) WHERE rn = 1"


@query("qry03_fastest_lap", SS + "code:s lap_number:i lap_time_s:d compound:s stint:i", _FAST)
def _(b):
    return W.fastest_lap(dim_lap(b))


@query("srt01_nulls_last", SS + "code:s lap_number:i", _FAST)
def _(b):
    return W.fastest_lap(dim_lap(b))


_OVER = """FROM (SELECT g.*, t_s FROM grid g JOIN curves USING (season, round, session_code, driver, lap_number, grid_index) SEMI JOIN lap_a USING (season, round, session_code, driver, lap_number)) a
JOIN (SELECT g.*, t_s FROM grid g JOIN curves USING (season, round, session_code, driver, lap_number, grid_index) SEMI JOIN lap_b USING (season, round, session_code, driver, lap_number)) b USING (season, round, session_code, grid_index) SEMI JOIN good_lens USING (season, round, session_code)"""


@query("qry04_overlay", SS + "grid_index:i distance_m:d delta_t_s:d speed_a:d speed_b:d brake_a:b n_gear_b:i drs_a:i", f"SELECT {KS}, grid_index, a.distance_m, b.t_s - a.t_s AS delta_t_s, a.speed AS speed_a, b.speed AS speed_b, a.brake AS brake_a, b.n_gear AS n_gear_b, a.drs AS drs_a {_OVER}")
def _(b):
    return W.overlay_pairs(fact_grid(b), one_pair(b))


@query("qry04_overlay_pruned", "grid_index:i delta_t_s:d", f"SELECT grid_index, b.t_s - a.t_s AS delta_t_s {_OVER} WHERE season = 2024 AND round = 3 AND session_code = 'Q'")
def _(b):
    root = f"{shared_dir(b.spark)}/facts-{uuid.uuid4().hex}"
    tables.write_sessions(fact_grid(b), root)
    ids = one_pair(b).filter("season = 2024 AND round = 3 AND session_code = 'Q'").first()
    return W.overlay(b.spark.read.parquet(root), 2024, 3, "Q", ids["lap_a"], ids["lap_b"])


CTES["asks"] = f"""
WITH f AS (SELECT {KS}, driver, lap_number FROM ({_FAST})), top AS (SELECT {KS}, arg_min(driver, (lap_time_s IS NULL, lap_time_s, driver)) AS driver_a FROM lsum GROUP BY ALL)
SELECT top.*, f.driver AS driver_b, f.driver AS ask, f.lap_number AS lap_b FROM top JOIN f {US}"""


@query("qry04_overlay_by_driver", SS + "ask:s grid_index:i delta_t_s:d speed_a:d speed_b:d reason:s", f"""
WITH pts AS (SELECT g.*, t_s FROM grid g JOIN curves USING (season, round, session_code, driver, lap_number, grid_index)), fa AS (SELECT {KS}, driver AS driver_a, lap_number AS lap_a FROM ({_FAST}))
SELECT k.season, k.round, k.session_code, ask, x.grid_index, y.t_s - x.t_s AS delta_t_s, x.speed AS speed_a, y.speed AS speed_b, NULL AS reason FROM asks k JOIN fa ON fa.season = k.season AND fa.round = k.round AND fa.session_code = k.session_code AND fa.driver_a = k.driver_a
 JOIN pts x ON x.season = k.season AND x.round = k.round AND x.session_code = k.session_code AND x.driver = k.driver_a AND x.lap_number = lap_a
 JOIN pts y ON y.season = k.season AND y.round = k.round AND y.session_code = k.session_code AND y.driver = k.driver_b AND y.lap_number = lap_b AND y.grid_index = x.grid_index WHERE k.driver_a <> k.driver_b
UNION ALL SELECT {KS}, ask, NULL, NULL, NULL, NULL, 'pick two different drivers' FROM asks WHERE driver_a = driver_b
UNION ALL SELECT {KS}, ask || ' nobody', NULL, NULL, NULL, NULL, 'nobody has no lap in the session' FROM asks
UNION ALL SELECT {KS}, ask || ' other', NULL, NULL, NULL, NULL, 'the lap asked for is not ' || driver_a || chr(39) || 's' FROM asks WHERE driver_a <> driver_b""")
def _(b):
    laps = dim_lap(b)
    best = W.fastest_lap(laps)
    order = F.struct(F.col("lap_time_s").isNull(), "lap_time_s", "code")
    top = laps.groupBy(*SESSION).agg(F.min_by("code", order).alias("driver_a"))
    one = top.join(best.select(*SESSION, F.col("code").alias("driver_b"), "lap_id"), list(SESSION))
    none = F.lit(None).cast("long")
    plain = one.select(*SESSION, F.col("driver_b").alias("ask"), "driver_a", "driver_b", none.alias("lap_a"), F.col("lap_id").alias("lap_b"))
    nobody = plain.select(*SESSION, F.concat("ask", F.lit(" nobody")).alias("ask"), "driver_a", F.lit("nobody").alias("driver_b"), none.alias("lap_a"), none.alias("lap_b"))
    other = plain.filter("driver_a <> driver_b").select(*SESSION, F.concat("ask", F.lit(" other")).alias("ask"), "driver_a", "driver_b", F.col("lap_b").alias("lap_a"), none.alias("lap_b"))
    shown, refused = W.overlay_drivers(fact_grid(b), laps, plain.unionByName(nobody).unionByName(other))
    return shown.unionByName(refused, allowMissingColumns=True)


_LOSS = f"""
SELECT {KS}, CASE WHEN length_m >= 30 THEN concat_ws(' ', microsector_id::VARCHAR, coalesce(corners, ''), phase) ELSE 'pooled' END AS label, sum(delta_s) AS delta_s, sum(length_m) AS length_m, count(*) AS sectors FROM dec1 WHERE NOT partial AND delta_s IS NOT NULL GROUP BY ALL"""


@query("qry05_loss_chart", SS + "label:s delta_s:d length_m:d sectors:i", _LOSS)
def _(b):
    return W.loss_chart(fact_micro(b), C.sectors(b), one_pair(b))


@query("flt18_length_pooling", SS + "label:s sectors:i", f"SELECT {KS}, CASE WHEN end_m - start_m >= 30 THEN phase ELSE 'pooled' END AS label, count(*) AS sectors FROM msec GROUP BY ALL")
def _(b):
    label = F.when(F.col("end_m") - F.col("start_m") >= W.MIN_RANKED_M, F.col("phase")).otherwise("pooled")
    return C.sectors(b).groupBy(*SESSION, label.alias("label")).agg(F.count(F.lit(1)).alias("sectors"))


@query("qry06_corner_table", SS + "code:s event_id:i v_min_kmh:d braked:b", f"SELECT c.season, c.round, c.session_code, c.driver AS code, event_id, v_min_kmh, brake_on_m IS NOT NULL AS braked FROM cm c JOIN ({_FAST}) f {U}")
def _(b):
    return W.corner_table(W.fact_corner_metric(C.metrics(b)), C.events(b), dim_lap(b)).withColumn("braked", F.col("braking_point").isNotNull())


@query("qry07_gap_check", SS + "official_gap_s:d grid_gap_s:d", f"""
SELECT season, round, session_code, y.lap_time_s - x.lap_time_s AS official_gap_s, y.grid_time_s - x.grid_time_s AS grid_gap_s FROM (SELECT l.* FROM lsum l SEMI JOIN lap_a {U}) x JOIN (SELECT l.* FROM lsum l SEMI JOIN lap_b {U}) y {US} SEMI JOIN good_lens {US}""")
def _(b):
    laps = dim_lap(b)
    side = lambda s: one_pair(b).select(*SESSION, F.col(f"lap_{s}").alias("lap_id")).join(laps, [*SESSION, "lap_id"]).select(*SESSION, F.col("lap_time_s").alias(f"o_{s}"), F.col("grid_time_s").alias(f"g_{s}"))
    return side("a").join(side("b"), list(SESSION)).withColumn("official_gap_s", F.col("o_b") - F.col("o_a")).withColumn("grid_gap_s", F.col("g_b") - F.col("g_a"))


@query("qry08_tyre_summary", SS + "compound:s stint:i grain:s sectors:i mean_s:d best_s:d", f"SELECT t.season, t.round, t.session_code, compound, stint, grain, count(*) AS sectors, avg(time_s) AS mean_s, min(time_s) AS best_s FROM full_mt t JOIN lsum {U} GROUP BY ALL")
def _(b):
    return W.tyre_summary(fact_micro(b), dim_lap(b))


@query("qry10_session_identity", SS + "country:s", "SELECT DISTINCT 2024 AS season, 3 AS round, 'Q' AS session_code, n_name AS country FROM nation JOIN tele ON n_nationkey = 3 AND round = 3 AND session_code = 'Q'")
def _(b):
    return W.session_identity(W.dim_session(meta(b)), 2024, 3, "Q")


# ---- sinks -----------------------------------------------------------------

def _root(b, name):
    return f"{shared_dir(b.spark)}/{name}-{uuid.uuid4().hex}"


@query("snk01_idempotent_overwrite", SS + "rows:i", f"SELECT {KS}, count(*) AS rows FROM tele GROUP BY ALL")
def _(b):
    root = _root(b, "snk01")
    tables.write_sessions(b.tele(), root)
    tables.write_sessions(b.tele().filter("round = 2"), root)
    return b.spark.read.parquet(root).groupBy(*SESSION).agg(F.count(F.lit(1)).alias("rows"))


@query("snk02_nan_to_null", "rows:i nulls:i", "SELECT count(*) AS rows, count(*) FILTER (WHERE k = 3) AS nulls FROM tele")
def _(b):
    root = _root(b, "snk02")
    t = b.tele().withColumn("speed", F.when(F.col("k") == 3, F.lit(float("nan"))).otherwise(F.col("speed")))
    tables.write_sessions(tables.normalised(t), root)
    return b.spark.read.parquet(root).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("speed").isNull()).alias("nulls"))


@query("snk03_upsert", "c_custkey:i c_acctbal:d c_mktsegment:s", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer")
def _(b):
    root = _root(b, "snk03")
    c = b.table("customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    tables.upsert_table(c.filter("c_custkey % 2 = 0 OR c_custkey % 3 <> 0"), root, ["c_custkey"])
    tables.upsert_table(c.filter("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1), root, ["c_custkey"])
    return tables.read_table(b.spark, root)


def _loaded(b):
    def run():
        root = _root(b, "warehouse")
        facts = {"fact_telemetry_grid": fact_grid(b), "fact_microsector": fact_micro(b), "dim_lap": dim_lap(b)}
        tables.load(b.spark, root, {n: df.filter("round < 3") for n, df in facts.items()})
        return tables.load(b.spark, root, facts).audit

    return b.staged("load_audit", run)


_AUD = f"""SELECT {KS}, 'fact_telemetry_grid' AS "table", count(*) AS rows FROM grid GROUP BY ALL UNION ALL SELECT {KS}, 'dim_lap', count(*) FROM lapn GROUP BY ALL UNION ALL SELECT s.season, s.round, s.session_code, 'fact_microsector', coalesce(n, 0) FROM (SELECT DISTINCT {KS} FROM grid) s LEFT JOIN (SELECT {KS}, count(*) AS n FROM mt GROUP BY ALL) {US}"""


@query("snk04_session_partitions", SS + "table:s rows:i", _AUD)
def _(b):
    return _loaded(b)


@query("snk05_replace_dimension", SS + "rows:i", f"SELECT {KS}, count(*) - CASE WHEN round = 1 THEN 1 ELSE 0 END AS rows FROM good_evs GROUP BY season, round, session_code")
def _(b):
    root = _root(b, "snk05")
    tables.write_sessions(C.events(b), root)
    tables.write_sessions(C.events(b).filter("round = 1 AND event_id > 0"), root)
    return b.spark.read.parquet(root).groupBy(*SESSION).agg(F.count(F.lit(1)).alias("rows"))


@query("snk06_gate_before_write", SS + "rows:i reason:s", f"""
SELECT {KS}, CASE WHEN bad = 0 THEN n ELSE 0 END AS rows, CASE WHEN bad > 0 THEN 'laps: Range[20.0, 43.0] (' || bad || ' rows)' END AS reason FROM (SELECT {KS}, count(*) AS n, count(*) FILTER (WHERE lap_time > 43.0) AS bad FROM laps GROUP BY ALL)""")
def _(b):
    from trackgrid.operators.quality import Contract, Range

    root = _root(b, "snk06")
    contract = Contract("laps", ("driver", "lap_number"), (Range(column="lap_time", low=20.0, high=43.0),))
    loaded = tables.load(b.spark, root, {"laps": b.laps()}, {"laps": contract})
    rows = loaded.audit.select(*SESSION, "rows")
    return b.laps().select(*SESSION).distinct().join(rows, list(SESSION), "left").join(loaded.refused, list(SESSION), "left").fillna(0, ["rows"])


@query("snk07_row_reconciliation", SS + "rows:i speed:d reason:s", f"""
SELECT g.season, g.round, g.session_code, count(*) AS rows, sum(speed + CASE WHEN lost IS NULL THEN 1 ELSE 0 END) AS speed, any_value(CASE WHEN lost IS NOT NULL THEN 'fact_microsector: stored ' || (n - lost) || ' of ' || n || ' rows' END) AS reason
FROM grid g LEFT JOIN (SELECT {KS}, count(*) AS n, nullif(count(*) FILTER (WHERE round = 2 AND microsector_id = 1), 0) AS lost FROM mt GROUP BY ALL) {US} GROUP BY ALL""")
def _(b):
    root = _root(b, "snk07")
    source = {"fact_microsector": Q.times(b), "fact_telemetry_grid": grid(b)}
    tables.load(b.spark, root, {"fact_microsector": fact_micro(b), "fact_telemetry_grid": fact_grid(b)}, expect=source)
    lossy = {"fact_microsector": fact_micro(b).filter("NOT (round = 2 AND microsector_id = 1)"), "fact_telemetry_grid": fact_grid(b).withColumn("speed", F.col("speed") + 1)}
    loaded = tables.load(b.spark, root, lossy, expect=source)
    seen = tables.Versions(b.spark, root).read("fact_telemetry_grid").groupBy(*SESSION).agg(F.count(F.lit(1)).alias("rows"), F.sum("speed").alias("speed"))
    return seen.join(loaded.refused, list(SESSION), "left")


@query("snk08_load_audit", SS + "table:s rows:i warnings:i quality_ok:b named:b timed:b paths:s", f"""
SELECT a.*, CASE WHEN late THEN 1 ELSE 0 END AS warnings, true AS quality_ok, true AS named, true AS timed, '{{"landed": "laps"}}' AS paths
FROM ({_AUD} UNION ALL SELECT {KS}, 'laps', count(*) FROM laps GROUP BY ALL) a LEFT JOIN (SELECT {KS}, bool_or(coalesce(lap_time > 43.0, false)) AS late FROM laps GROUP BY ALL) {US}""")
def _(b):
    from trackgrid.operators.quality import WARNING, Contract, NotNull, Range

    root = _root(b, "snk08")
    contract = Contract("laps", ("driver", "lap_number"), (Range(column="lap_time", low=20.0, high=600.0), Range(column="lap_time", low=20.0, high=43.0, severity=WARNING)))
    facts = {"laps": b.laps(), "fact_telemetry_grid": fact_grid(b), "fact_microsector": fact_micro(b), "dim_lap": dim_lap(b)}
    contracts = {n: Contract(n, SESSION, (NotNull(check=SESSION),)) for n in facts} | {"laps": contract}
    tables.load(b.spark, root, facts, contracts, paths={"landed": "laps"})
    return tables.load_audit(b.spark, root).withColumns({"named": F.length("contract_version") > 0, "timed": F.col("elapsed_s") > 0})


@query("snk09_rejected_laps", L + "reason:s", "SELECT r.* FROM (" + __import__("catalog.series", fromlist=["_REJECT"])._REJECT + ") r")
def _(b):
    from catalog.series import broken
    from trackgrid.operators import series as S

    root = _root(b, "snk09")
    tables.write_sessions(S.resample_session(broken(b))[1], root)
    return b.spark.read.parquet(root)


@query("snk10_season_scan", SS + "laps:i", f"SELECT {KS}, count(*) AS laps FROM truth GROUP BY ALL")
def _(b):
    root = _root(b, "snk10")
    tables.write_sessions(VQ.report(b), root)
    return VQ.V.season_table(b.spark.read.parquet(root), VQ.session_meta(b))


@query("str01_incremental_load", SS + "driver:s laps:i points:i", f"SELECT {KS}, driver, count(DISTINCT lap_number) AS laps, count(*) AS points FROM grid GROUP BY ALL")
def _(b):
    from trackgrid.operators import series as S
    from trackgrid.streaming.incremental import load_new_snapshots

    root, source = _root(b, "stream"), _root(b, "landed")
    raw = b.tele()
    publish = lambda rows, day: rows.withColumn("snapshot_date", F.lit(day)).write.mode("append").parquet(source)
    schema = raw.withColumn("snapshot_date", F.lit("")).schema
    run = lambda: load_new_snapshots(b.spark, source, schema, S.resample, f"{root}/grid", f"{root}/checkpoint").awaitTermination()
    publish(raw, "2024-01-01")
    run()
    # every session is published again, one kind of them with a correction on the way
    publish(raw.withColumn("distance_aligned", F.col("distance_aligned") * 0.5), "2024-01-02")
    run()
    publish(raw, "2024-01-03")
    run()
    return b.spark.read.parquet(f"{root}/grid").groupBy(*SESSION, "driver").agg(F.countDistinct("lap_number").alias("laps"), F.count(F.lit(1)).alias("points"))


@query("run01_process_sessions", SS + "stage:s reason:s laps:i loaded:b")
def _(b):
    """The whole chain from landed tables to the warehouse: what became of each session."""
    from catalog.spatial import raw_corners
    from trackgrid.plans.run import process_sessions

    raw = {"laps": b.laps(), "car_telemetry": b.car(), "pos_data": b.pos(), "circuit_corners": raw_corners(b)}
    out = process_sessions(b.spark, raw, VQ.official(b), warehouse=_root(b, "run"), sessions=meta(b))
    loaded = out["load_audit"].filter("table = 'dim_lap'").select(*SESSION, F.lit(True).alias("loaded"))
    laps = out["lap_summary"].groupBy(*SESSION).agg(F.count(F.lit(1)).alias("laps"))
    every = b.laps().select(*SESSION).distinct()
    told = every.join(out["refused_sessions"], list(SESSION), "left").join(laps, list(SESSION), "left").join(loaded, list(SESSION), "left")
    return told.fillna(0, ["laps"]).fillna(False, ["loaded"])
