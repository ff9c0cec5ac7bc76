"""Overlays by driver with their refusals, wide pairings, reference data published by season."""

import pytest
from pyspark.sql import functions as F

from trackgrid.keys import SESSION
from trackgrid.operators import calendar as R
from trackgrid.operators import pairs as P
from trackgrid.plans import reference as N
from trackgrid.plans import warehouse as W

S = (2024, 1, "Q")


@pytest.fixture(scope="module")
def dim(spark):
    rows = [(*S, "A", 1, 11, 80.0), (*S, "A", 2, 12, 79.0), (*S, "B", 1, 21, 81.0), (*S, "C", 1, 31, None), (2024, 2, "Q", "D", 1, 41, 90.0)]
    df = spark.createDataFrame(rows, "season int, round int, session_code string, code string, lap_number int, lap_id long, lap_time_s double")
    return df.withColumns({"compound": F.lit("SOFT"), "stint": F.lit(1)})


@pytest.fixture(scope="module")
def fact(spark):
    points = [(lap, i) for lap, lo in ((11, 0), (12, 0), (21, 0), (31, 50), (41, 0)) for i in range(lo, lo + 5)]
    rows = [(*S, lap, i, i * 10.0, lap + i * 0.1, 200.0 + lap, 100.0, False, 7, 0) for lap, i in points]
    return spark.createDataFrame(rows, "season int, round int, session_code string, lap_id long, grid_index int, distance_m double, t_s double, speed double, throttle double, brake boolean, n_gear int, drs int")


def test_overlays_by_driver_and_refused_asks(spark, dim, fact):
    asks = [("best", "A", "B", None, None), ("chosen", "A", "B", 11, 21), ("same", "A", "A", None, None), ("other's lap", "A", "B", 21, None), ("elsewhere", "A", "D", None, None), ("nothing shared", "A", "C", None, None)]
    df = spark.createDataFrame([(*S, *a) for a in asks], "season int, round int, session_code string, ask string, driver_a string, driver_b string, lap_a long, lap_b long")
    shown, refused = W.overlay_drivers(fact, dim, df)
    delta = {r["ask"]: r["d"] for r in shown.groupBy("ask").agg(F.round(F.avg("delta_t_s"), 6).alias("d")).collect()}
    assert delta == {"best": 9.0, "chosen": 10.0} and shown.count() == 10
    assert {r["ask"]: r["reason"] for r in refused.collect()} == {
        "same": "pick two different drivers", "other's lap": "the lap asked for is not A's", "elsewhere": "D has no lap in the session", "nothing shared": "no shared grid points between A and C",
    }


def test_a_pair_keeps_every_event(spark):
    events = spark.createDataFrame([(*S, "x", float(e), e / 10) for e in (7, 0, 3, 40)], "season int, round int, session_code string, pair string, event_id double, delta_s double")
    row = P.pairings_wide({"events": events}).first()
    assert list(row["deltas"].items()) == [(0.0, 0.0), (3.0, 0.3), (7.0, 0.7), (40.0, 4.0)]


def race(season, round, lat="1.5", entries=("AAA", "BBB")):
    moment = {"date": f"{season}-03-0{round}", "time": "10:00:00Z"}
    driver = lambda c: {"driverId": c.lower(), "permanentNumber": "7", "code": c, "url": "u", "givenName": "G", "familyName": c, "dateOfBirth": "1990-01-01", "nationality": "n"}
    entry = [{"number": "7", "position": "1", "Driver": driver(c), "Constructor": {"constructorId": "k", "url": "u", "name": "K", "nationality": "n"}} for c in entries]
    return {
        "season": str(season), "round": str(round), "url": "u", "raceName": f"E{round}", "date": moment["date"], "time": moment["time"], "Qualifying": moment, "Results": entry,
        "Circuit": {"circuitId": "c", "url": "u", "circuitName": "C", "Location": {"lat": lat, "long": "2.0", "locality": "t", "country": "l"}},
    }


def test_a_broken_season_stays_as_it_was(spark, tmp_path):
    import json

    def given(*races):
        rows = R.parse_races(spark.createDataFrame([(json.dumps(r), 0) for r in races], "payload string, page int"))
        e = rows.select("season", F.explode("Results").alias("e"))
        return rows, e.select("season", "e.Driver.*").distinct(), e.select("season", "e.Constructor.*").distinct()

    root = str(tmp_path / "reference")
    first = N.ingest_reference(spark, root, *given(race(2023, 1), race(2024, 1), race(2024, 2, entries=())), "2024-01-01")
    assert first.refused.count() == 0 and [(r["season"], r["round"]) for r in first.skipped.collect()] == [(2024, 2)]
    assert {r["table"]: r["rows"] for r in first.tables.filter("season = 2024").collect()} == {"dim_event": 2, "dim_session_schedule": 4, "dim_driver": 2, "dim_constructor": 1, "driver_entry": 2}
    second = N.ingest_reference(spark, root, *given(race(2023, 1, lat="nowhere"), race(2024, 1), race(2025, 1, entries=())), "2024-02-01")
    reasons = {r["season"]: r["reason"] for r in second.refused.collect()}
    assert reasons[2023].startswith("dim_event: NotNull") and reasons[2025] == "no round has a driver entry"
    assert N.read_reference(spark, root, 2023)["dim_event"].first()["lat"] == 1.5
    assert N.read_reference(spark, root, 2024)["dim_event"].count() == 1 and N.read_reference(spark, root, 2025) == {}
