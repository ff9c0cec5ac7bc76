"""Reference tables from payloads, and which sessions are due."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackgrid.keys import SESSION

# Payload block and session code, and the order of the codes.
SESSION_BLOCKS = (
    ("FirstPractice", "FP1"), ("SecondPractice", "FP2"), ("ThirdPractice", "FP3"), ("Qualifying", "Q"),
    ("SprintQualifying", "SQ"), ("SprintShootout", "SQ"), ("Sprint", "S"),
)
SESSION_ORDER = ("FP1", "FP2", "FP3", "SQ", "S", "Q", "R")
DEFAULT_CODES = ("Q", "R")
SETTLE_MINUTES = 180

MOMENT = "struct<date:string,time:string>"
LOCATION = "struct<lat:string,long:string,locality:string,country:string>"
CIRCUIT = f"struct<circuitId:string,circuitName:string,Location:{LOCATION}>"
DRIVER = "struct<driverId:string,permanentNumber:string,code:string,url:string,givenName:string,familyName:string,dateOfBirth:string,nationality:string>"
CONSTRUCTOR = "struct<constructorId:string,url:string,name:string,nationality:string>"
ENTRY = f"struct<number:string,position:string,Driver:{DRIVER},Constructor:{CONSTRUCTOR}>"
RACE = (
    f"struct<season:string,round:string,url:string,raceName:string,Circuit:{CIRCUIT},date:string,time:string,"
    + ",".join(f"{b}:{MOMENT}" for b, _ in SESSION_BLOCKS) + f",QualifyingResults:array<{ENTRY}>,Results:array<{ENTRY}>>"
)


def parse_races(payloads: DataFrame, column: str = "payload") -> DataFrame:
    return payloads.select(F.from_json(column, RACE).alias("r"), *[c for c in payloads.columns if c != column]).select("r.*", *[c for c in payloads.columns if c != column])


def _start(date: Column, time: Column) -> Column:
    """UTC start; midnight when only the date is known. Bad text is null."""
    clock = F.coalesce(F.regexp_replace(time, "Z$", ""), F.lit("00:00:00"))
    return F.try_to_timestamp(F.concat_ws(" ", date, clock))


def event_table(races: DataFrame) -> DataFrame:
    """One row per round: the event and where it was held; of differing rows the smallest."""
    number = lambda c: c.try_cast("double")
    place = F.col("Circuit")["Location"]
    rows = races.select(
        F.col("season").cast("int").alias("season"), F.col("round").cast("int").alias("round"), F.col("raceName").alias("event_name"),
        F.col("Circuit")["circuitId"].alias("circuit_id"), F.col("Circuit")["circuitName"].alias("circuit_name"), place["locality"].alias("locality"),
        place["country"].alias("country"), number(place["lat"]).alias("lat"), number(place["long"]).alias("lon"), F.col("date").alias("race_date"), F.col("url").alias("wikipedia_url"),
    )
    rest = rows.columns[2:]
    return rows.groupBy("season", "round").agg(F.min(F.struct(*rest)).alias("_row")).select("season", "round", *[F.col("_row")[c].alias(c) for c in rest])


def session_schedule(races: DataFrame) -> DataFrame:
    """One row per session; the race is the payload's own date and time. The first block of a code counts."""
    block = lambda i, code, date, time: F.struct(F.lit(i).alias("_i"), F.lit(code).alias("session"), date.alias("date"), time.alias("time"))
    rows = [F.when(F.col(b).isNotNull(), block(i, code, F.col(b)["date"], F.col(b)["time"])) for i, (b, code) in enumerate(SESSION_BLOCKS)]
    rows.append(block(len(SESSION_BLOCKS), "R", F.col("date"), F.col("time")))
    flat = races.select(F.col("season").cast("int").alias("season"), F.col("round").cast("int").alias("round"), F.inline(F.array_compact(F.array(*rows))))
    body = F.struct(_start(F.col("date"), F.col("time")).alias("session_start_utc"), (F.col("date").isNotNull() & F.col("time").isNotNull()).alias("has_time"))
    return flat.groupBy("season", "round", "session").agg(F.min_by(body, "_i").alias("b")).select("season", "round", "session", "b.*")


def session_rank(session: str = "session") -> Column:
    rank = F.lit(len(SESSION_ORDER))
    for i, code in enumerate(SESSION_ORDER):
        rank = F.when(F.col(session) == code, F.lit(i)).otherwise(rank)
    return rank


def in_session_order(schedule: DataFrame) -> DataFrame:
    return schedule.orderBy("season", "round", session_rank())


def driver_table(drivers: DataFrame) -> DataFrame:
    """One row per driver that has a code. ``drivers``: season and the payload's fields."""
    given, family = F.coalesce("givenName", F.lit("")), F.coalesce("familyName", F.lit(""))
    return drivers.filter(F.coalesce("code", F.lit("")) != "").select(
        F.col("season").cast("int").alias("season"), "code", F.col("driverId").alias("driver_id"), F.col("permanentNumber").try_cast("int").alias("permanent_number"),
        given.alias("given_name"), family.alias("family_name"), F.trim(F.concat_ws(" ", given, family)).alias("full_name"),
        F.col("dateOfBirth").alias("date_of_birth"), "nationality", F.col("url").alias("wikipedia_url"),
    )


def constructor_table(constructors: DataFrame) -> DataFrame:
    return constructors.select(F.col("season").cast("int").alias("season"), F.col("constructorId").alias("constructor_id"), "name", "nationality", F.col("url").alias("wikipedia_url"))


def driver_entries(races: DataFrame, page: str = "page") -> DataFrame:
    """Who drove for whom per round: qualifying entries, else race results; an empty list counts as absent.

    A race may be split over pages; whether a round has qualifying entries is
    decided over all of them. A code entered twice keeps its first entry.
    """
    have = lambda c: F.when(F.size(c) > 0, F.col(c))
    races = races.withColumns({"season": F.col("season").cast("int"), "round": F.col("round").cast("int")})
    q = races.groupBy("season", "round").agg(F.max(F.when(F.size("QualifyingResults") > 0, 1)).alias("_q"))
    rows = races.join(q, ["season", "round"]).withColumn("_e", F.when(F.col("_q") == 1, have("QualifyingResults")).otherwise(have("Results")))
    entries = rows.select("season", "round", page, F.posexplode("_e").alias("_pos", "e")).filter(F.coalesce(F.col("e.Driver.code"), F.lit("")) != "")
    d, c = F.col("e.Driver"), F.col("e.Constructor")
    number = F.coalesce(F.nullif(F.col("e.number"), F.lit("")), F.nullif(d["permanentNumber"], F.lit(""))).try_cast("int")
    body = F.struct(d["driverId"].alias("driver_id"), c["constructorId"].alias("constructor_id"), c["name"].alias("constructor_name"), number.alias("car_number"))
    first = entries.groupBy("season", "round", d["code"].alias("code")).agg(F.min_by(body, F.struct(F.col(page), F.col("_pos"))).alias("b"))
    return first.select("season", "round", "code", "b.*")


def skipped_rounds(races: DataFrame, entries: DataFrame) -> DataFrame:
    """Rounds without any entry yet: reported, not an error."""
    rounds = races.select(F.col("season").cast("int").alias("season"), F.col("round").cast("int").alias("round")).distinct()
    return rounds.join(entries.select("season", "round").distinct(), ["season", "round"], "left_anti").withColumn("reason", F.lit("no qualifying or race result"))


def resolve_constructor(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Constructor of a driver code in a round; never matched by team name."""
    return rows.join(entries.select("season", "round", "code", "constructor_id"), ["season", "round", "code"], "left")


def load_reference(tables: dict[str, DataFrame], season: int) -> dict[str, DataFrame]:
    return {name: df.filter(F.col("season") == season) for name, df in tables.items()}


# ---------------------------------------------------------------- due sessions

def sessions_due(schedule: DataFrame, events: DataFrame, now: Column, codes: Sequence[str] = DEFAULT_CODES, settle_minutes: int = SETTLE_MINUTES) -> DataFrame:
    """Wanted sessions whose data should exist by ``now``; rounds without a name are left out."""
    cutoff = now - F.expr(f"INTERVAL {int(settle_minutes)} MINUTES")
    wanted = schedule.filter(F.col("session").isin(*codes) & F.col("session_start_utc").isNotNull() & (F.col("session_start_utc") <= cutoff))
    named = events.filter(F.col("event_name").isNotNull()).select("season", "round", "event_name")
    return wanted.join(named, ["season", "round"]).select("season", "round", F.col("session").alias("session_code"), "event_name", "session_start_utc")


def not_yet_loaded(due: DataFrame, loaded: DataFrame) -> DataFrame:
    return due.join(loaded.select(*SESSION).distinct(), list(SESSION), "left_anti")


def run_id() -> Column:
    return F.concat(F.lit("session__"), F.concat_ws("_", F.col("season").cast("string"), F.col("round").cast("string"), F.lower("session_code")))
