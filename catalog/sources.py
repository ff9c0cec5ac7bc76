"""Landing: coercion, gates, snapshots and paged payloads."""

import uuid

from pyspark.sql import functions as F

from catalog.binding import CTES
from catalog.registry import query
from catalog.segment import KS, SS, US
from catalog.series import K, L, U, grid
from trackgrid import schemas as D
from trackgrid.keys import LAP, SESSION
from trackgrid.session import shared_dir
from trackgrid.sources import landing as I
from trackgrid.sources import tables as W


def raw_car(b):
    """Samples in source names and source types: intervals, text flags, numbers as text."""
    t = b.tele()
    flags = F.array(*[F.lit(x) for x in ("TRUE", " 1", "false", "0", "", "maybe")])
    return t.select(
        *SESSION, "event_id", F.col("driver").alias("_driver"), F.col("lap_number").cast("double").alias("_lap_number"),
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("session_time").cast("decimal(18,6)")).alias("SessionTime"),
        F.col("speed").cast("string").alias("Speed"), F.when(F.col("k") % 13 == 0, "n/a").otherwise(F.col("throttle").cast("string")).alias("Throttle"),
        F.element_at(flags, (F.col("k") % 6 + 1).cast("int")).alias("Brake"), F.col("rpm").alias("RPM"), (F.col("k") / 2.0).alias("nGear"), F.col("drs").alias("DRS"), F.lit("car").alias("Source"), F.lit("x").alias("Extra"),
    )


@query("src01_read_tables", "table:s rows:i", "SELECT 'laps' AS \"table\", count(*) AS rows FROM laps")
def _(b):
    root = f"{shared_dir(b.spark)}/raw-{uuid.uuid4().hex}"
    typed = b.laps().select(*SESSION, *[F.col(t).cast(D.TYPES[k]) for t, _, k in D.LAPS.columns])
    W.write_sessions(typed, f"{root}/laps")
    out = None
    for name, df in I.read_tables(b.spark, root, D.RAW_TABLES).items():  # only laps is there
        row = df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"))
        out = row if out is None else out.unionByName(row)
    return out


@query("src02_coerce", "event_id:i driver:s lap_number:i session_time:d throttle:d drs:i", "SELECT event_id, driver, lap_number, floor(session_time * 1e6 + 0.5) / 1e6 AS session_time, CASE WHEN k % 13 <> 0 THEN throttle::FLOAT END AS throttle, drs FROM tele")
def _(b):
    return I.coerce(raw_car(b), D.CAR_TELEMETRY, keep=["event_id"])


@query("src02_all_null_columns", "column:s", "SELECT 'speed' AS \"column\" FROM tele LIMIT 1")
def _(b):
    return I.all_null(I.coerce(raw_car(b).withColumn("Speed", F.lit("n/a")), D.CAR_TELEMETRY), D.CAR_TELEMETRY)


@query("src03_half_even_integer", "event_id:i n_gear:i", "SELECT event_id, CAST(round_even(k / 2.0, 0) AS INT) AS n_gear FROM tele")
def _(b):
    return I.coerce(raw_car(b), D.CAR_TELEMETRY, keep=["event_id"])


@query("src03_overflow", "column:s n:i", "SELECT 'drs' AS \"column\", count(*) AS n FROM tele WHERE drs * 12 > 127")
def _(b):
    return I.overflowed(raw_car(b).withColumn("DRS", F.col("DRS") * 12), D.CAR_TELEMETRY)


@query("src04_nullable_bool", "event_id:i brake:b", "SELECT event_id, CASE k % 6 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false WHEN 4 THEN false END AS brake FROM tele")
def _(b):
    return I.coerce(raw_car(b), D.CAR_TELEMETRY, keep=["event_id"])


@query("src05_to_seconds", "event_id:i session_time:d", "SELECT event_id, floor(session_time * 1e6 + 0.5) / 1e6 AS session_time FROM tele")
def _(b):
    return I.coerce(raw_car(b), D.CAR_TELEMETRY, keep=["event_id"])


@query("src06_duplicate_keys", "l_orderkey:i l_linenumber:i n:i", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1 ORDER BY 1, 2 LIMIT 5")
def _(b):
    return I.duplicate_keys(b.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("src07_orphans", L[:-1], f"SELECT DISTINCT {K} FROM tele WHERE lap_number = 3")
def _(b):
    return I.orphans(b.tele(), b.laps().filter("lap_number <> 3"))


@query("src08_tagged_samples", "driver:s lap_number:i rows:i no_status:i", "SELECT 'A' || lap_number AS driver, lap_number, count(*) AS rows, count(*) AS no_status FROM tele GROUP BY ALL")
def _(b):
    rows = b.tele().select(F.col("session_time").alias("SessionTime"), F.col("speed").alias("Speed"), "lap_number")
    tagged = I.tag_samples(rows, F.concat(F.lit("A"), F.col("lap_number")), F.col("lap_number"))
    return tagged.groupBy(F.col("_driver").alias("driver"), F.col("_lap_number").alias("lap_number")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("Status").isNull()).alias("no_status"))


_U = "user_id % 9 = 0"


@query("src09_skipped", SS + "driver:s lap_number:d reason:s", f"""
SELECT {K}, 'lap has no telemetry' AS reason FROM (SELECT DISTINCT {K} FROM tele WHERE {_U})
UNION ALL SELECT {K}, 'telemetry without a time' FROM tele WHERE NOT ({_U}) GROUP BY ALL HAVING bool_or(k = 1)
UNION ALL SELECT {KS}, driver, NULL, 'driver has no usable lap' FROM (SELECT {K}, user_id, bool_or(k = 1) AS bad FROM tele GROUP BY ALL) GROUP BY {KS}, driver, user_id HAVING {_U} OR bool_and(bad)""")
def _(b):
    t = b.tele()
    asked = t.select(*SESSION, "driver").distinct()
    samples = t.filter("user_id % 9 <> 0").withColumn("session_time", F.when(F.col("k") != 1, F.col("session_time")))
    return I.usable_laps(asked, samples, b.laps())[1]


@query("src10_corner_rows", "number:i letter:s", "SELECT n_nationkey AS number, CASE WHEN n_nationkey % 2 = 1 THEN 'a' ELSE '' END AS letter FROM nation")
def _(b):
    n = b.table("nation").select(F.col("n_nationkey").alias("number"), F.when(F.col("n_nationkey") % 2 == 1, "a").alias("Letter"))
    return I.corner_rows(n).withColumnRenamed("Letter", "letter")


@query("src11_session_meta", "season:i round_number:i session_requested:s event_name:s", f"SELECT DISTINCT season, round AS round_number, session_code AS session_requested, CASE WHEN round % 2 = 0 THEN 'GP ' || round END AS event_name FROM tele")
def _(b):
    from catalog.warehouse import meta

    root = f"{shared_dir(b.spark)}/meta-{uuid.uuid4().hex}"
    meta(b).write.option("maxRecordsPerFile", 1).json(root)
    return I.read_session_meta(b.spark, root)


@query("src12_write_once", "first:s again:s intact:b rows:i", "SELECT 'written' AS first, 'unchanged' AS again, true AS intact, count(*) AS rows FROM laps")
def _(b):
    root = f"{shared_dir(b.spark)}/snap-{uuid.uuid4().hex}"
    first = I.write_snapshot(b.laps(), root, "laps", "2024-01-31")
    again = I.write_snapshot(b.laps(), root, "laps", "2024-01-31")
    stored = b.spark.read.parquet(f"{root}/laps/snapshot_date=2024-01-31")
    return stored.agg(F.lit(first).alias("first"), F.lit(again).alias("again"), F.lit(I.verify_snapshot(b.spark, root, "laps", "2024-01-31")).alias("intact"), F.count(F.lit(1)).alias("rows"))


@query("src13_manifest_stats", SS + "drivers:i rows:i least:i most:i", f"SELECT {KS}, count(*) AS drivers, sum(n) AS rows, min(n) AS least, max(n) AS most FROM (SELECT {KS}, driver, count(*) AS n FROM tele GROUP BY ALL) GROUP BY ALL")
def _(b):
    return I.manifest_stats(b.tele())


@query("src14_latest_snapshot", SS + "snapshot_date:s rows:i", f"SELECT {KS}, max(d) AS snapshot_date, count(*) FILTER (WHERE d = m) AS rows FROM (SELECT *, max(d) OVER (PARTITION BY {KS}) AS m FROM (SELECT *, '2024-01-0' || (k % 9 + 1) AS d FROM tele)) GROUP BY ALL")
def _(b):
    t = b.tele().withColumn("snapshot_date", F.concat(F.lit("2024-01-0"), (F.col("k") % 9 + 1).cast("string")))
    return I.latest_snapshot(t).groupBy(*SESSION, "snapshot_date").agg(F.count(F.lit(1)).alias("rows"))


@query("src15_merge_pages", "request:s items:i", "SELECT c_mktsegment AS request, count(*) AS items FROM customer GROUP BY ALL")
def _(b):
    c = b.table("customer")
    total = c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).cast("string").alias("total"))
    pages = c.withColumn("page", F.floor(F.col("c_custkey") / 30)).groupBy("c_mktsegment", "page").agg(F.collect_list("c_name").alias("items")).join(total, "c_mktsegment")
    return I.merge_pages(pages.withColumnRenamed("c_mktsegment", "request"), "items").groupBy("request").agg(F.count(F.lit(1)).alias("items"))


@query("src15_merge_nested", "season:i round:i entries:i", "SELECT year(o_orderdate) AS season, month(o_orderdate) AS round, count(*) AS entries FROM orders WHERE month(o_orderdate) % 2 = 0 GROUP BY ALL")
def _(b):
    from catalog.warehouse import races

    return I.merge_nested(races(b), "QualifyingResults").groupBy("season", "round").agg(F.count(F.lit(1)).alias("entries"))
