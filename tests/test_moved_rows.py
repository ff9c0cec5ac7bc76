"""Which rows of a grid move: lookups by lap and index, event windows, halves of a session."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trackgrid.operators import metrics as M
from trackgrid.operators import segment as E
from trackgrid.operators import series as S

LAP_TYPES = "season int, round int, session_code string, driver string, lap_number int"
S1 = (2024, 1, "Q")


def given(df):
    """The rows on their own, without the plan that made them."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def grid(spark):
    i = np.arange(120)
    dip = np.abs((i % 40) - 20)
    laps = [
        pd.DataFrame({
            "season": 2024, "round": 1, "session_code": "Q", "driver": d, "lap_number": n, "grid_index": i, "distance_m": i * 10.0, "elapsed_time": i * 0.2, "speed": 100.0 + 5.0 * dip,
            "throttle": np.where((i % 40 >= 8) & (i % 40 < 20), 20.0, 100.0), "brake": (i % 40 >= 10) & (i % 40 < 18), "source_gap_m": 1.0 + i,
        })
        for d in "ABCD" for n in (1, 2)
    ]
    return spark.createDataFrame(pd.concat(laps))


def test_a_half_session_is_searched_once_and_finds_the_same_events(spark, grid):
    traces = E.median_traces(grid)
    events = given(E.detect_events(traces))
    got = E.jackknife(grid, events, trials=3)
    assert "InPandas" not in plan(got)
    rows = got.toPandas()
    assert set(rows.trial) == {0, 1, 2} and rows.count_match.all()
    assert (rows[["apex_shift_m", "exit_end_shift_m"]].fillna(0.0) == 0.0).all().all()


def test_event_windows_leave_the_grid_where_it_lies(spark, grid):
    traces = E.median_traces(grid)
    events, lengths = given(E.detect_events(traces)), given(E.lap_length(traces))
    apex = E.per_lap_apex(grid, events, lengths)
    assert "SortMergeJoin" not in plan(apex)
    assert apex.count() == 8 * events.count() and apex.agg(F.max(F.abs("apex_dev_m"))).first()[0] == 0.0
    cm = E.corner_metrics(grid, events, lengths)
    assert cm.count() == 8 * events.count()
    assert all(r["brake_gap_m"] == 1.0 + r["brake_on_m"] / 10.0 for r in cm.filter("brake_on_m IS NOT NULL").collect())


def test_only_points_a_session_asks_for_meet_a_lookup_and_repeats_stay(spark):
    points = [(*S1, d, 1, i, i * 0.5) for d in "AB" for i in range(50)] + [(*S1, "A", 1, 7, 100.0), (2024, 2, "Q", "C", 1, 7, 1.0), (*S1, None, 1, 7, 2.0)]
    curves = spark.createDataFrame(points, LAP_TYPES + ", grid_index int, t_s double")
    asked = spark.createDataFrame([(*S1, 7), (*S1, 7), (*S1, None)], "season int, round int, session_code string, _i long")
    near = S.asked_points(curves, asked, "_i")
    assert sorted((r["driver"] or "", r["t_s"]) for r in near.collect()) == [("", 2.0), ("A", 3.5), ("A", 100.0), ("B", 3.5)]
    sectors = spark.createDataFrame([(*S1, "corner_phase", 0, 2, 7, 20.0, 70.0)], "season int, round int, session_code string, grain string, microsector_id int, start_index int, end_index int, start_m double, end_m double")
    times = M.sector_times(curves, sectors)
    assert "LeftSemi" in plan(times)
    assert sorted(r["time_s"] for r in times.filter("driver = 'A'").collect()) == [2.5, 99.0]
