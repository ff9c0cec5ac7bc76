"""The given tables read as lap telemetry, in Spark and in SQL.

``events`` is the sample stream: a user is a driver, ten days are a lap, and
users are spread over ten sessions. Time runs 20,000 times faster, so a lap
takes 43.2 s. The position on a 2000 m circle is a monotone function of time
that differs per driver; speed has five troughs per lap plus the event's value
as noise. Everything else is derived from these rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackgrid.keys import LAP
from trackgrid.session import cut

EPOCH_US = 1704067200000000  # 2024-01-01 UTC
LAP_US = 864000000000
LAP_S = 43.2
RADIUS = 318.3098861837907

_STAGED: dict[tuple[str, str, str], DataFrame] = {}


class Binding:
    """Access to the given tables and to stage tables derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def staged(self, name: str, build) -> DataFrame:
        """A stage table, written once per application and folder, as the stages of a run are."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _STAGED:
            _STAGED[key] = cut(build(), f"stage-{name}", "zstd")
        return _STAGED[key]

    # -- samples ------------------------------------------------------------

    def tele(self) -> DataFrame:
        e = self.table("events")
        us = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(EPOCH_US)
        lap = F.floor((F.dayofmonth("ts") - 1) / 10) + 1
        base = e.select(
            "event_id", "user_id", "event_type", "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            us.alias("us"), lap.cast("int").alias("lap_number"), F.year("ts").alias("season"),
        )
        u = (F.col("us") - (F.col("lap_number") - 1) * F.lit(LAP_US)) / F.lit(864000000000.0)
        a = ((F.col("user_id") % 7) - 3) / F.lit(10.0)
        base = base.withColumn("u", u).withColumn("d", F.lit(2000.0) * (F.col("u") + a * F.col("u") * (F.lit(1.0) - F.col("u"))))
        m = F.col("d") - F.lit(400.0) * F.floor(F.col("d") / 400.0)
        radius = F.lit(RADIUS) + (F.col("k") - 50) / F.lit(25.0)
        theta = F.col("d") * F.lit(0.0031415926535897933)
        return base.withColumn("m", m).select(
            "season",
            (F.col("user_id") % 5 + 1).cast("int").alias("round"),
            F.when(F.floor(F.col("user_id") / 5) % 2 == 0, "Q").otherwise("R").alias("session_code"),
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("driver"),
            "lap_number",
            (F.col("us") / F.lit(2e10)).alias("session_time"),
            F.col("d").alias("distance_aligned"),
            (F.lit(90.0) + F.lit(140.0) * (F.abs(F.col("m") - 200.0) / 200.0) + F.col("value") * F.lit(0.1)).alias("speed"),
            F.when((F.col("m") >= 40.0) & (F.col("m") < 200.0), F.lit(20.0) + F.col("k") * F.lit(0.3)).otherwise(F.lit(100.0)).alias("throttle"),
            (F.lit(8000.0) + F.col("value") * F.lit(10.0)).alias("rpm"),
            (radius * F.cos(theta)).alias("x"),
            (radius * F.sin(theta)).alias("y"),
            (F.col("k") * F.lit(0.1)).alias("z"),
            (F.col("k") % 8 + 1).alias("n_gear"),
            (((F.col("m") >= 60.0) & (F.col("m") < 180.0) & (F.col("k") % 4 != 0)) | ((F.col("event_type") == "error") & (F.col("k") % 9 == 0))).alias("brake"),
            F.when(F.col("event_type") == "view", 12).otherwise(8).alias("drs"),
            "k", "value", "event_type", "event_id", "user_id",
        )

    def car(self) -> DataFrame:
        return self.tele().filter("event_id % 3 <> 0").select(*LAP, "session_time", "speed", "throttle", "rpm", "n_gear", "brake", "drs")

    def pos(self) -> DataFrame:
        t = self.tele().filter("event_id % 3 <> 1")
        return t.select(*LAP, "session_time", *[(F.col(c) * F.lit(10.0)).alias(c) for c in ("x", "y", "z")])

    def laps(self) -> DataFrame:
        g = self.tele().groupBy(*LAP, "user_id").agg(
            F.count(F.lit(1)).alias("n"), F.sum("k").alias("ks"), F.min("session_time").alias("t0"), F.max("session_time").alias("t1")
        )
        time = F.lit(42.2) + (F.col("ks") % 200) / F.lit(100.0)
        g = g.withColumn("lap_time", F.when(F.col("ks") % 23 != 0, time))
        return g.select(
            *LAP,
            F.col("user_id").cast("string").alias("driver_number"),
            F.concat(F.lit("T"), (F.col("user_id") % 10).cast("string")).alias("team"),
            "lap_time",
            (F.col("lap_time") * 0.3).alias("sector1_time"),
            (F.col("lap_time") * 0.4).alias("sector2_time"),
            (F.col("lap_time") * 0.3).alias("sector3_time"),
            ((F.col("lap_number") - 1) * F.lit(LAP_S) + F.lit(0.25)).alias("lap_start_time"),
            F.when(F.col("ks") % 17 == 0, F.col("t1")).alias("pit_in_time"),
            F.when(F.col("n") % 13 == 0, F.col("t0")).alias("pit_out_time"),
            F.col("lap_number").alias("stint"),
            F.when(F.col("user_id") % 11 != 0, F.element_at(F.array(F.lit("SOFT"), F.lit("MEDIUM"), F.lit("HARD")), (F.col("user_id") % 3 + 1).cast("int"))).alias("compound"),
            (F.col("n") % 30).alias("tyre_life"),
            (F.col("user_id") % 2 == 0).alias("fresh_tyre"),
            F.lit("1").alias("track_status"),
            F.when(F.col("ks") % 19 != 0, F.col("ks") % 11 != 0).alias("is_accurate"),
        )


_TELE = f"""
  SELECT *, d - 400.0 * floor(d / 400.0) AS m,
    {RADIUS} + (k - 50) / 25.0 AS radius, d * 0.0031415926535897933 AS theta
  FROM (
    SELECT *, 2000.0 * (u + ((user_id % 7) - 3) / 10.0 * u * (1.0 - u)) AS d FROM (
      SELECT *, (us - (lap_number - 1) * {LAP_US}) / 864000000000.0 AS u FROM (
        SELECT event_id, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
          epoch_us(ts) - {EPOCH_US} AS us, year(ts) AS season, (day(ts) - 1) // 10 + 1 AS lap_number FROM events)))
"""

CTES: dict[str, str] = {
    "tele": f"""
SELECT season, user_id % 5 + 1 AS round, CASE WHEN (user_id // 5) % 2 = 0 THEN 'Q' ELSE 'R' END AS session_code,
  'U' || user_id AS driver, lap_number, us / 2e10 AS session_time, d AS distance_aligned,
  90.0 + 140.0 * (abs(m - 200.0) / 200.0) + value * 0.1::DOUBLE AS speed,
  CASE WHEN m >= 40.0 AND m < 200.0 THEN 20.0::DOUBLE + k * 0.3::DOUBLE ELSE 100.0::DOUBLE END AS throttle,
  8000.0 + value * 10.0 AS rpm, radius * cos(theta) AS x, radius * sin(theta) AS y, k * 0.1::DOUBLE AS z,
  k % 8 + 1 AS n_gear,
  (m >= 60.0 AND m < 180.0 AND k % 4 <> 0) OR (event_type = 'error' AND k % 9 = 0) AS brake,
  CASE WHEN event_type = 'view' THEN 12 ELSE 8 END AS drs, k, value, event_type, event_id, user_id
FROM ({_TELE})""",
    "car": "SELECT season, round, session_code, driver, lap_number, session_time, speed, throttle, rpm, n_gear, brake, drs FROM tele WHERE event_id % 3 <> 0",
    "pos": "SELECT season, round, session_code, driver, lap_number, session_time, x * 10.0 AS x, y * 10.0 AS y, z * 10.0 AS z FROM tele WHERE event_id % 3 <> 1",
    "laps": f"""
SELECT season, round, session_code, driver, lap_number, CAST(user_id AS VARCHAR) AS driver_number, 'T' || (user_id % 10) AS team,
  lap_time, lap_time * 0.3::DOUBLE AS sector1_time, lap_time * 0.4::DOUBLE AS sector2_time, lap_time * 0.3::DOUBLE AS sector3_time,
  (lap_number - 1) * {LAP_S}::DOUBLE + 0.25::DOUBLE AS lap_start_time,
  CASE WHEN ks % 17 = 0 THEN t1 END AS pit_in_time, CASE WHEN n % 13 = 0 THEN t0 END AS pit_out_time,
  lap_number AS stint, CASE WHEN user_id % 11 <> 0 THEN ['SOFT', 'MEDIUM', 'HARD'][user_id % 3 + 1] END AS compound,
  n % 30 AS tyre_life, user_id % 2 = 0 AS fresh_tyre, '1' AS track_status,
  CASE WHEN ks % 19 <> 0 THEN ks % 11 <> 0 END AS is_accurate
FROM (SELECT *, CASE WHEN ks % 23 <> 0 THEN 42.2::DOUBLE + (ks % 200) / 100.0::DOUBLE END AS lap_time FROM (
  SELECT season, round, session_code, driver, lap_number, user_id, count(*) AS n, CAST(sum(k) AS BIGINT) AS ks,
    min(session_time) AS t0, max(session_time) AS t1 FROM tele GROUP BY ALL))""",
}
