"""Projections, joins, windows, set operations and scalar functions, each on its own."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import metrics as Q
from catalog import segment as C
from catalog import validation as VQ
from catalog.binding import CTES
from catalog.registry import query
from catalog.segment import KS, SS, US
from catalog.series import K, L, U, curves, delta, grid
from trackgrid.functions import columns as X
from trackgrid.functions.ordered import Axis, brackets, neighbours, running
from trackgrid.keys import LAP, SESSION
from trackgrid.operators import gridchecks as G
from trackgrid.operators import metrics as M
from trackgrid.operators import pairs as P
from trackgrid.operators import quality as R
from trackgrid.operators import series as S
from trackgrid.operators import validate as V

J = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in LAP)


# ---- projections -----------------------------------------------------------

@query("flt15_complete_sectors", L + "grain:s microsector_id:i time_s:d", "SELECT * FROM full_mt")
def _(b):
    return M.complete(Q.times(b))


@query("flt16_units", L + "session_time:d x:d y:d speed_ms:d", "SELECT *  REPLACE (x * 10.0 / 10.0 AS x, y * 10.0 / 10.0 AS y), speed / 3.6 AS speed_ms FROM tele")
def _(b):
    t = b.tele().withColumns({"x": F.col("x") * 10.0, "y": F.col("y") * 10.0, "speed_ms": F.col("speed") / 3.6})
    return X.positions_to_metres(t)


@query("flt17_session_slug", "c_custkey:i slug:s", "SELECT c_custkey, '2024_' || trim(regexp_replace(c_name || ' (GP)', '[^\\p{L}\\p{N}]', '-', 'g'), '-') || '_' || trim(regexp_replace(c_mktsegment, '[^\\p{L}\\p{N}]', '-', 'g'), '-') AS slug FROM customer")
def _(b):
    return b.table("customer").withColumn("slug", X.session_slug(F.lit(2024), F.concat(F.col("c_name"), F.lit(" (GP)")), "c_mktsegment"))


@query("flt17b_lap_labels", L + "label:s parsed_driver:s parsed_lap:i", f"SELECT {K}, driver || ' L' || lap_number AS label, driver AS parsed_driver, lap_number AS parsed_lap FROM lapn")
def _(b):
    laps = S.lap_lengths(grid(b)).withColumn("label", X.lap_label())
    return laps.withColumn("p", X.parse_lap_label("label")).withColumns({"parsed_driver": F.col("p.driver"), "parsed_lap": F.col("p.lap_number")})


# ---- joins -----------------------------------------------------------------

@query("jon01_equi_inner", L + "event_id:i compound:s", f"SELECT cm.*, compound FROM cm JOIN push {U}")
def _(b):
    return C.metrics(b).join(V.push_laps(b.laps()).select(*LAP, "compound"), list(LAP))


@query("jon02_equi_left", L + "lap_residual_s:d", f"SELECT {K}, lap_residual_s FROM lsum LEFT JOIN (SELECT {K}, lap_residual_s FROM truth WHERE NOT lap_outlier) {U}")
def _(b):
    return Q.lap_summary(b).select(*LAP).join(VQ.truth(b).filter("NOT lap_outlier").select(*LAP, "lap_residual_s"), list(LAP), "left")


@query("jon03_dimension_lookup", "l_suppkey:i s_name:s revenue:d", "SELECT l_suppkey, s_name, sum(l_extendedprice) AS revenue FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL")
def _(b):
    # the sums are formed before the lookup, so the join sees one row per key
    sums = b.table("lineitem").groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("revenue"))
    return sums.join(b.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey", "left")


@query("jon04_left_anti", "o_orderkey:i", "SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")
def _(b):
    return b.table("orders").join(b.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("jon05_left_semi", "o_orderkey:i o_totalprice:d", "SELECT o_orderkey, o_totalprice FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_quantity > 45)")
def _(b):
    return b.table("orders").join(b.table("lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")


@query("jon06_asof_backward", L + "session_time:d k:d", f"SELECT {', '.join('p.' + k for k in LAP)}, p.session_time, e.k FROM pos p ASOF LEFT JOIN (SELECT * FROM tele WHERE event_type = 'view') e ON {J('p', 'e')} AND p.session_time >= e.session_time")
def _(b):
    marks = b.tele().filter("event_type = 'view'").select(*LAP, "session_time", F.struct("k").alias("obs"))
    asks = b.pos().select(*LAP, "session_time", F.lit(1).alias("ask"))
    rows = asks.unionByName(marks, allowMissingColumns=True)
    return brackets(S.TIME.cut(rows), S.TIME, ["obs"]).filter("ask = 1").withColumn("k", F.col("obs_prev.k"))


@query("jon07_asof_bracket", L + "session_time:d before:d after:d", f"""
SELECT {', '.join('p.' + k for k in LAP)}, p.session_time, e.session_time AS before, f.session_time AS after FROM pos p ASOF LEFT JOIN (SELECT * FROM tele WHERE event_type = 'view') e ON {J('p', 'e')} AND p.session_time >= e.session_time
ASOF LEFT JOIN (SELECT * FROM tele WHERE event_type = 'view') f ON {J('p', 'f')} AND p.session_time <= f.session_time""")
def _(b):
    marks = b.tele().filter("event_type = 'view'").select(*LAP, "session_time", F.struct(F.col("session_time").alias("t")).alias("obs"))
    rows = b.pos().select(*LAP, "session_time", F.lit(1).alias("ask")).unionByName(marks, allowMissingColumns=True)
    return brackets(S.TIME.cut(rows), S.TIME, ["obs"]).filter("ask = 1").withColumns({"before": F.col("obs_prev.t"), "after": F.col("obs_next.t")})


@query("jon08_nearest_in_cells", "vec_id:i nearest_id:i", """
WITH e AS (SELECT vec_id, label, embedding[3]::DOUBLE AS x, embedding[4]::DOUBLE AS y FROM embeddings)
SELECT a.vec_id, arg_min(b.vec_id, ((a.x - b.x) ** 2 + (a.y - b.y) ** 2, b.vec_id)) AS nearest_id FROM e a JOIN e b ON b.label = (a.label + 1) % (SELECT max(label) + 1 FROM e) GROUP BY ALL""")
def _(b):
    from trackgrid.operators.spatial import nearest

    e = b.table("embeddings").select("vec_id", "label", F.col("embedding")[2].cast("double").alias("x"), F.col("embedding")[3].cast("double").alias("y"))
    top = e.agg((F.max("label") + 1).alias("n"))
    pts = e.join(top, F.col("n") > F.col("label")).select("vec_id", ((F.col("label") + 1) % F.col("n")).alias("label"), F.col("x").alias("px"), F.col("y").alias("py"))
    return nearest(pts, e.withColumnRenamed("vec_id", "other"), ["label"], ["vec_id"], "other").withColumnRenamed("idx", "nearest_id")


@query("jon09_nearest_on_line", "l_orderkey:i p:d nearest:d", """
WITH a AS (SELECT DISTINCT l_orderkey, l_extendedprice AS p FROM lineitem WHERE l_linenumber = 1), b AS (SELECT DISTINCT l_orderkey, l_extendedprice AS m FROM lineitem WHERE l_linenumber > 4)
SELECT a.l_orderkey, p, arg_min(m, (abs(m - p), m)) AS nearest FROM a LEFT JOIN b USING (l_orderkey) GROUP BY ALL""")
def _(b):
    l = b.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("p"))
    pts, marks = l.filter("l_linenumber = 1").select("l_orderkey", "p").distinct(), l.filter("l_linenumber > 4").select("l_orderkey", "p").distinct()
    return G.nearest_on_line(pts, marks, "p", ["l_orderkey"], 20000.0)


@query("jon10_window_points", SS + "event_id:i points:i", f"SELECT {KS}, event_id, count(*) AS points FROM traces JOIN good_evs USING ({KS}) WHERE grid_index * 10.0 >= left_max_m AND grid_index * 10.0 < apex_m GROUP BY ALL")
def _(b):
    # the windows are cut into grid cells, so the join is an equality on the cell
    w = C.events(b).filter("apex_m > left_max_m").select(*SESSION, "event_id", F.explode(F.sequence((F.col("left_max_m") / 10).cast("long"), (F.col("apex_m") / 10).cast("long") - 1)).alias("grid_index"))
    return C.traces(b).join(w, [*SESSION, "grid_index"]).groupBy(*SESSION, "event_id").agg(F.count(F.lit(1)).alias("points"))


@query("jon12_lap_self_join", SS + "driver:s points:i speed_gap:d", f"""
SELECT {KS}, driver, count(*) AS points, avg(b.speed - a.speed) AS speed_gap FROM grid a JOIN (SELECT * REPLACE (lap_number - 1 AS lap_number) FROM grid) b USING ({KS}, driver, lap_number, grid_index) GROUP BY ALL""")
def _(b):
    lap = lambda n: grid(b).select(*SESSION, "driver", (F.col("lap_number") - (n - 1)).alias("lap_number"), "grid_index", F.col("speed").alias(f"v{n}"))
    return lap(1).join(lap(2), [*LAP, "grid_index"]).groupBy(*SESSION, "driver").agg(F.count(F.lit(1)).alias("points"), F.avg(F.col("v2") - F.col("v1")).alias("speed_gap"))


@query("jon13_lap_pairs", SS + "pair:s gap_s:d", f"SELECT season, round, session_code, pair, gap_s FROM allp")
def _(b):
    from catalog.pairs import one

    return P.lap_pairs(Q.lap_summary(b), one(b).select(*SESSION, "driver_a", "driver_b"))


@query("jon14_outer_by_key", L + "n_points:d lap_time:d", f"SELECT {K}, n_points, lap_time FROM lapn FULL JOIN (SELECT {K}, lap_time FROM laps WHERE pit_in_time IS NULL) {U}")
def _(b):
    return S.lap_lengths(grid(b)).join(b.laps().filter("pit_in_time IS NULL").select(*LAP, "lap_time"), list(LAP), "full")


@query("jon15_scalar_subquery", "o_orderkey:i", "SELECT o_orderkey FROM orders WHERE o_custkey = (SELECT min(c_custkey) FROM customer WHERE c_nationkey = 7)")
def _(b):
    b.table("orders").createOrReplaceTempView("tg_orders")
    b.table("customer").createOrReplaceTempView("tg_customer")
    return b.spark.sql("SELECT o_orderkey FROM tg_orders WHERE o_custkey = (SELECT min(c_custkey) FROM tg_customer WHERE c_nationkey = 7)")


# ---- windows ---------------------------------------------------------------

@query("win01_lag_lead", L + "session_time:d back:d ahead:d", f"SELECT {K}, session_time, session_time - lag(session_time) OVER w AS back, lead(session_time) OVER w - session_time AS ahead FROM tele WINDOW w AS (PARTITION BY {K} ORDER BY session_time)")
def _(b):
    t = neighbours(b.tele().select(*LAP, "session_time"), S.TIME, ["session_time"])
    return t.withColumns({"back": F.col("session_time") - F.col("prev.session_time"), "ahead": F.col("next.session_time") - F.col("session_time")})


@query("win02_running_max", L + "session_time:d top:d", f"SELECT {K}, session_time, max(value) OVER (PARTITION BY {K} ORDER BY session_time) AS top FROM tele")
def _(b):
    return running(b.tele(), S.TIME, maxima={"top": F.col("value")})


@query("win03_running_sum", L + "session_time:d total:i", f"SELECT {K}, session_time, sum(k) OVER (PARTITION BY {K} ORDER BY session_time) AS total FROM tele")
def _(b):
    return running(b.tele(), S.TIME, sums={"total": F.col("k")})


@query("win04_first_last", L + "first_k:i last_k:i", f"SELECT {K}, arg_min(k, session_time) AS first_k, arg_max(k, session_time) AS last_k FROM tele GROUP BY ALL")
def _(b):
    return b.tele().groupBy(*LAP).agg(F.min_by("k", "session_time").alias("first_k"), F.max_by("k", "session_time").alias("last_k"))


@query("win05_last_non_null", L + "session_time:d k:d", f"SELECT {K}, session_time, last_value(v IGNORE NULLS) OVER (PARTITION BY {K} ORDER BY session_time) AS k FROM (SELECT *, CASE WHEN event_type = 'click' THEN k END AS v FROM tele)")
def _(b):
    t = b.tele().select(*LAP, "session_time", F.when(F.col("event_type") == "click", F.struct("k")).alias("obs"))
    return brackets(S.TIME.cut(t), S.TIME, ["obs"]).withColumn("k", F.col("obs_prev.k"))


@query("win06_group_min", L + "lap_time:d best:d", f"SELECT {K}, lap_time, min(lap_time) OVER (PARTITION BY {KS}, driver) AS best FROM laps")
def _(b):
    laps = b.laps().select(*LAP, "lap_time")
    return laps.join(laps.groupBy(*SESSION, "driver").agg(F.min("lap_time").alias("best")), [*SESSION, "driver"])


@query("win07_arg_min", SS + "driver:s lap_number:i", f"SELECT {KS}, arg_min(driver, (speed, driver, lap_number, session_time)) AS driver, arg_min(lap_number, (speed, driver, lap_number, session_time)) AS lap_number FROM tele GROUP BY ALL")
def _(b):
    m = b.tele().groupBy(*SESSION).agg(F.min(F.struct("speed", "driver", "lap_number")).alias("m"))
    return m.select(*SESSION, "m.driver", "m.lap_number")


@query("win08_top_n", "l_suppkey:i l_extendedprice:d place:i", "SELECT * FROM (SELECT l_suppkey, l_extendedprice, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC) AS place FROM lineitem) WHERE place <= 3")
def _(b):
    # the limit on the rank lets Spark drop the rest of a group before it is shuffled
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"))
    return b.table("lineitem").withColumn("place", F.row_number().over(w)).filter("place <= 3")


@query("win09_islands", L + "runs:i longest:i", f"""
SELECT {K}, count(*) AS runs, max(n) AS longest FROM (SELECT {K}, i, count(*) AS n FROM (SELECT *, grid_index - row_number() OVER (PARTITION BY {K} ORDER BY grid_index) AS i FROM grid WHERE throttle > 99) GROUP BY ALL) GROUP BY ALL""")
def _(b):
    runs = S.boolean_runs(grid(b).withColumn("full", F.col("throttle") > 99), "full")
    n = (F.col("off_m") - F.col("on_m")) / 10 + 1
    return runs.groupBy(*LAP).agg(F.count(F.lit(1)).alias("runs"), F.max(n).alias("longest"))


@query("win10_circular_neighbours", SS + "event_id:i before_m:d after_m:d", f"""
SELECT {KS}, event_id, coalesce(lag(apex_m) OVER w, max(apex_m) OVER p - lap_length_m) AS before_m, coalesce(lead(apex_m) OVER w, min(apex_m) OVER p + lap_length_m) AS after_m FROM good_evs JOIN good_lens USING ({KS}) WINDOW w AS (PARTITION BY {KS} ORDER BY apex_m), p AS (PARTITION BY {KS})""")
def _(b):
    # a session's events are bounded by its grid, see keys.MAX_GRID_INDEX
    e = C.events(b).join(C.lengths(b), list(SESSION))
    w, p = Window.partitionBy(*SESSION).orderBy("apex_m"), Window.partitionBy(*SESSION)
    return e.withColumn("before_m", F.coalesce(F.lag("apex_m").over(w), F.max("apex_m").over(p) - F.col("lap_length_m"))).withColumn("after_m", F.coalesce(F.lead("apex_m").over(w), F.min("apex_m").over(p) + F.col("lap_length_m")))


# ---- sets ------------------------------------------------------------------

@query("set01_union_distinct", L + "session_time:d", f"SELECT {K}, session_time FROM car UNION SELECT {K}, session_time FROM pos")
def _(b):
    return b.car().select(*LAP, "session_time").unionByName(b.pos().select(*LAP, "session_time")).distinct()


@query("set02_union_all", "source:s rows:i", "SELECT 'car' AS source, count(*) AS rows FROM car UNION ALL SELECT 'pos', count(*) FROM pos")
def _(b):
    both = b.car().select(F.lit("car").alias("source")).unionByName(b.pos().select(F.lit("pos").alias("source")))
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))


@query("set03_intersect", L + "session_time:d", f"SELECT {K}, session_time FROM car INTERSECT SELECT {K}, session_time FROM pos")
def _(b):
    return b.car().select(*LAP, "session_time").intersect(b.pos().select(*LAP, "session_time"))


@query("set04_difference", L + "session_time:d", f"SELECT {K}, session_time FROM car EXCEPT SELECT {K}, session_time FROM pos")
def _(b):
    return b.car().select(*LAP, "session_time").subtract(b.pos().select(*LAP, "session_time"))


@query("set05_first_per_key", "o_custkey:i o_orderkey:i", "SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL")
def _(b):
    return b.table("orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"))


@query("set07_unpivot", L + "sector:s time_s:d", f"SELECT {K}, unnest(['s1', 's2', 's3']) AS sector, unnest([sector1_time, sector2_time, sector3_time]) AS time_s FROM laps")
def _(b):
    return b.laps().select(*LAP, F.col("sector1_time").alias("s1"), F.col("sector2_time").alias("s2"), F.col("sector3_time").alias("s3")).unpivot(list(LAP), ["s1", "s2", "s3"], "sector", "time_s")


# ---- scalar functions ------------------------------------------------------

@query("fun01_math", "event_id:i fl:i ce:i ri:d hy:d sq:d at:d md:d cl:d", "SELECT event_id, floor(value) AS fl, ceil(value) AS ce, round_even(value, 0) AS ri, sqrt(x * x + y * y) AS hy, sqrt(value) AS sq, atan2(y, x) AS at, ((value - 200) % 90 + 90) % 90 AS md, least(greatest(value, 10), 100) AS cl FROM tele")
def _(b):
    v = F.col("value")
    return b.tele().select("event_id", F.floor(v).alias("fl"), F.ceil(v).alias("ce"), F.rint(v).alias("ri"), F.hypot("x", "y").alias("hy"), F.sqrt(v).alias("sq"), F.atan2("y", "x").alias("at"), F.pmod(v - 200, F.lit(90.0)).alias("md"), F.least(F.greatest(v, F.lit(10.0)), F.lit(100.0)).alias("cl"))


@query("fun02_string", "c_custkey:i digits:s parts:i padded:s low:s matches:b", "SELECT c_custkey, regexp_extract(c_name, '(\\d+)', 1) AS digits, len(string_split(c_name, '#')) AS parts, lpad(c_custkey::VARCHAR, 6, '0') AS padded, lower(trim(c_mktsegment)) AS low, regexp_matches(c_name, '0$') AS matches FROM customer")
def _(b):
    return b.table("customer").select("c_custkey", F.regexp_extract("c_name", r"(\d+)", 1).alias("digits"), F.size(F.split("c_name", "#")).alias("parts"), F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("padded"), F.lower(F.trim("c_mktsegment")).alias("low"), F.col("c_name").rlike("0$").alias("matches"))


@query("fun03_datetime", "o_orderkey:i day:s settled:i bad:b", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, epoch(o_orderdate + INTERVAL 180 MINUTE) AS settled, TRY_CAST(o_orderpriority AS DATE) IS NULL AS bad FROM orders")
def _(b):
    at = F.col("o_orderdate").cast("timestamp")
    return b.table("orders").select("o_orderkey", F.date_format(at, "yyyy-MM-dd").alias("day"), F.unix_timestamp(at + F.expr("INTERVAL 180 MINUTES")).alias("settled"), F.col("o_orderpriority").try_cast("date").isNull().alias("bad"))


@query("fun04_array", "vec_id:i low:d at:i has:b", "SELECT vec_id, list_min(embedding) AS low, list_position(embedding, list_min(embedding)) - 1 AS at, list_contains([1, 3, 5], label) AS has FROM embeddings")
def _(b):
    e = F.col("embedding")
    return b.table("embeddings").select("vec_id", F.array_min(e).alias("low"), (F.array_position(e, F.array_min(e)) - 1).alias("at"), F.array_contains(F.array(*[F.lit(i) for i in (1, 3, 5)]), F.col("label")).alias("has"))


@query("fun05_json", "event_id:i k:i again:s", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, '{\"k\":' || json_extract_string(props, '$.k') || '}' AS again FROM events")
def _(b):
    e = b.table("events").withColumn("p", F.from_json("props", "k int"))
    return e.select("event_id", F.col("p.k").alias("k"), F.to_json("p").alias("again"))


@query("fun06_hash", "c_custkey:i h:s", "SELECT c_custkey, sha256(c_name) AS h FROM customer")
def _(b):
    return b.table("customer").select("c_custkey", F.sha2("c_name", 256).alias("h"))


@query("fun07_null_handling", "event_id:i a:d b:d finite:b", "SELECT event_id, CASE WHEN k <> 3 THEN value END AS a, CASE WHEN k <> 3 THEN value ELSE 0 END AS b, k <> 3 AS finite FROM tele")
def _(b):
    v = F.when(F.col("k") == 3, F.lit(float("nan"))).otherwise(F.col("value"))
    return b.tele().select("event_id", X.clean(v).alias("a"), F.coalesce(X.clean(v), F.lit(0.0)).alias("b"), X.clean(v).isNotNull().alias("finite"))


# ---- callables -------------------------------------------------------------

@query("udf01_grouped_resample", L + "grid_index:i elapsed_time:d speed:d y:d n_gear:i drs:i source_gap_m:d", "SELECT * FROM grid")
def _(b):
    from trackgrid.operators.grouped import resample_arrow
    from trackgrid.session import ship

    ship(b.spark)
    return resample_arrow(b.tele())


@query("udf02_rule_callables", SS + "rule:s count:i", f"SELECT {KS}, 'Invariant(view_samples)' AS rule, count(*) AS count FROM tele WHERE event_type = 'view' GROUP BY ALL")
def _(b):
    def view_samples(df, parents, scope):
        return df, F.col("event_type") == "view"

    return R.validate_table(b.tele(), R.Contract("tele", ("driver",), (R.Invariant(name="view_samples", holds=view_samples, about=("event_type",)),)))
