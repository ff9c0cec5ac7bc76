"""Circuit layouts by season: which official length a session raced."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Layout, circuit, official length in metres, first season, last season (None while current).
LAYOUTS = (
    ("suzuka", "suzuka", 5807, 2003, None),
    ("bahrain", "bahrain", 5412, 2005, None),
    ("jeddah", "jeddah", 6174, 2021, None),
    ("shanghai", "shanghai", 5451, 2004, None),
    ("miami", "miami", 5412, 2022, None),
    ("imola", "imola", 4909, 2008, None),
    ("monaco", "monaco", 3337, 2015, None),
    ("villeneuve", "villeneuve", 4361, 2002, None),
    ("silverstone", "silverstone", 5891, 2011, None),
    ("hungaroring", "hungaroring", 4381, 2003, None),
    ("spa", "spa", 7004, 2007, None),
    ("zandvoort", "zandvoort", 4259, 2020, None),
    ("monza", "monza", 5793, 2000, None),
    ("baku", "baku", 6003, 2016, None),
    ("americas", "americas", 5513, 2012, None),
    ("rodriguez", "rodriguez", 4304, 2015, None),
    ("interlagos", "interlagos", 4309, 1999, None),
    ("vegas", "vegas", 6201, 2023, None),
    ("hockenheimring", "hockenheimring", 4574, 2002, None),
    ("istanbul", "istanbul", 5338, 2005, None),
    ("mugello", "mugello", 5245, 1974, None),
    ("nurburgring", "nurburgring", 5148, 2001, None),
    ("portimao", "portimao", 4653, 2020, None),
    ("ricard", "ricard", 5842, 2005, None),
    ("sochi", "sochi", 5848, 2014, 2023),
    ("albert_park_1996", "albert_park", 5303, 1996, 2020),
    ("albert_park", "albert_park", 5278, 2021, None),
    ("catalunya_2007", "catalunya", 4655, 2007, 2020),
    ("catalunya_chicane", "catalunya", 4675, 2021, 2022),
    ("catalunya", "catalunya", 4657, 2023, None),
    ("marina_bay_2018", "marina_bay", 5063, 2018, 2022),
    ("marina_bay_2023", "marina_bay", 4940, 2023, 2024),
    ("marina_bay", "marina_bay", 4927, 2025, None),
    ("yas_marina_2009", "yas_marina", 5554, 2009, 2020),
    ("yas_marina", "yas_marina", 5281, 2021, None),
    ("losail_2004", "losail", 5380, 2004, 2022),
    ("losail", "losail", 5419, 2023, None),
    ("red_bull_ring_2016", "red_bull_ring", 4318, 2016, 2024),
    ("red_bull_ring", "red_bull_ring", 4326, 2025, None),
)
# Season, event and layout where one event did not use its circuit's usual layout.
OVERRIDES = ((2020, "Sakhir Grand Prix", "bahrain_outer", "bahrain", 3543),)


def layout_table(spark: SparkSession, rows: tuple = LAYOUTS) -> DataFrame:
    data = [(layout, circuit, float(metres), first, last) for layout, circuit, metres, first, last in rows]
    return spark.createDataFrame(data, "layout_id string, circuit_id string, length_m double, first_season int, last_season int")


def override_table(spark: SparkSession) -> DataFrame:
    data = [(s, e, l, float(m)) for s, e, l, _, m in OVERRIDES]
    return spark.createDataFrame(data, "season int, event_name string, o_layout string, o_length double")


def resolve_layouts(sessions: DataFrame, layouts: DataFrame, overrides: DataFrame) -> DataFrame:
    """The layout each session raced: the event's override, else the one its season falls in.

    ``sessions`` needs a unique ``session_key``, season, circuit_id and event_name. A session
    with no or several candidates keeps a null layout and says why. The range meets within
    one circuit, so the join has an equality to run on.
    """
    named = sessions.join(overrides, ["season", "event_name"], "left")
    l = layouts.withColumnRenamed("circuit_id", "_circuit")
    covers = (F.col("circuit_id") == F.col("_circuit")) & (F.col("first_season") <= F.col("season")) & (F.col("last_season").isNull() | (F.col("season") <= F.col("last_season")))
    hit = named.join(l, covers, "left")
    found = hit.groupBy("session_key").agg(
        F.first("season").alias("season"), F.first("circuit_id").alias("circuit_id"), F.first("event_name").alias("event_name"), F.max("o_layout").alias("_o"), F.max("o_length").alias("_ol"),
        F.count("layout_id").alias("candidates"), F.array_join(F.array_sort(F.collect_set("layout_id")), ", ").alias("_names"), F.max("layout_id").alias("_l"), F.max("length_m").alias("_m"),
    )
    one = F.col("candidates") == 1
    reason = (
        F.when(F.col("_o").isNotNull() | one, F.lit(None).cast("string"))
        .when(F.col("candidates") == 0, F.format_string("no layout of %s in %s", F.col("circuit_id"), F.col("season").cast("string")))
        .otherwise(F.concat(F.col("candidates").cast("string"), F.lit(" layouts claim this season: "), F.col("_names")))
    )
    return found.select(
        "session_key", "season", "circuit_id", "event_name", F.coalesce("_o", F.when(one, F.col("_l"))).alias("layout_id"), F.coalesce("_ol", F.when(one, F.col("_m"))).alias("length_m"), reason.alias("reason")
    )


def require_layouts(resolved: DataFrame) -> DataFrame:
    ok = F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason")).cast("boolean")).otherwise(F.lit(True))
    return resolved.filter(ok)
