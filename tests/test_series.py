import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trackgrid.functions.ordered import Axis, brackets, integrate, neighbours, running
from trackgrid.keys import LAP
from trackgrid.operators import gridchecks as G
from trackgrid.operators import metrics as M
from trackgrid.operators import series as S

CH = ["speed", "throttle", "rpm", "x", "y"]
KEY = dict(season=2024, round=1, session_code="Q")


def lap(driver="SYN", number=7, d=None, offset=0.0, t=None, **key):
    """One sample per 0.1 s, every 4 m, channels linear in distance."""
    d = np.arange(0.0, 1001.0, 4.0) if d is None else np.asarray(d, dtype=float)
    return pd.DataFrame({
        **{**KEY, **key}, "driver": driver, "lap_number": number, "session_time": 1000 + 0.1 * np.arange(len(d)) if t is None else t, "distance_aligned": d + offset,
        "speed": 100 + 0.2 * d, "throttle": 100 - 0.05 * d, "rpm": 8000 + 4 * d, "x": d, "y": 2 * d,
        "n_gear": np.minimum(np.floor(d / 100) + 1, 8).astype(int), "brake": ((d >= 200) & (d < 300)) | ((d >= 600) & (d < 650)), "drs": np.where(d >= 800, 12, 0),
    })


def expected(one: pd.DataFrame, spacing=10.0) -> pd.DataFrame:
    """Grid of one lap by table lookup."""
    d = one["distance_aligned"].to_numpy()
    keep = np.append(d[1:] != d[:-1], True)
    k, t0 = one[keep], one["session_time"].iloc[0]
    xs = np.arange(int(np.floor(d[-1] / spacing)) + 1) * spacing
    at = np.clip(np.searchsorted(k["distance_aligned"], xs, side="right") - 1, 0, None)
    out = {"grid_index": np.arange(len(xs)), "elapsed_time": np.interp(xs, k["distance_aligned"], k["session_time"] - t0)}
    out |= {c: np.interp(xs, k["distance_aligned"], k[c]) for c in CH}
    out |= {c: k[c].to_numpy()[at] for c in ("n_gear", "brake", "drs")}
    return pd.DataFrame(out)


def grid_of(spark, frames, **kw):
    return S.resample(spark.createDataFrame(pd.concat(frames)), **kw).toPandas().sort_values([*LAP, "grid_index"]).reset_index(drop=True)


def same(got, want, cols):
    for c in cols:
        np.testing.assert_array_equal(got[c].to_numpy(), want[c].to_numpy(), err_msg=c)


@pytest.mark.parametrize("span", [3.0, 500.0, 1e9])
def test_closed_form_lap_is_exact_for_any_chunk_width(spark, span):
    one = lap()
    got = grid_of(spark, [one], axis=Axis(LAP, "distance_aligned", span))
    assert len(got) == 101
    same(got, expected(one), ["grid_index", "n_gear", "brake", "drs", *CH])
    assert got["source_gap_m"].isin([0.0, 4.0]).all()


def test_axis_that_opens_late_holds_the_first_sample(spark):
    got = grid_of(spark, [lap(offset=25.0)])
    assert got["speed"][:3].tolist() == [100.0] * 3 and got["source_gap_m"][:3].isna().all() and got["elapsed_time"][0] == 0


def test_null_state_at_a_sample_is_carried(spark):
    one = lap()
    one["n_gear"] = one["n_gear"].astype(object)
    one.loc[one.distance_aligned == 100.0, "n_gear"] = None
    df = spark.createDataFrame(one.astype(object).where(one.notna(), None), schema=spark.createDataFrame(lap()).schema)
    got = S.resample(df).filter("grid_index = 10").first()
    assert got["n_gear"] is None


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_random_laps_with_flat_runs_match_table_lookup(spark, seed):
    rng = np.random.default_rng(seed)
    frames = []
    for n in range(6):
        d = np.cumsum(np.where(rng.random(120) < 0.3, 0.0, rng.random(120) * 30)) - rng.random() * 20
        frames.append(lap(number=n, d=d - d.min() + rng.random() * 5, t=np.cumsum(rng.random(120) + 0.01)))
    got = grid_of(spark, [f.sample(frac=1, random_state=seed) for f in frames], axis=Axis(LAP, "distance_aligned", 200.0))
    want = pd.concat([expected(f) for f in frames], ignore_index=True)
    same(got, want, ["grid_index", "elapsed_time", "n_gear", "brake", "drs", *CH])


def test_sessions_with_equal_lap_keys_stay_apart(spark):
    got = grid_of(spark, [lap(), lap(round=2, d=np.arange(0, 501.0, 5.0))])
    assert got.groupby("round").size().tolist() == [101, 51]


def test_bad_laps_are_refused_with_a_reason_and_the_rest_go_on(spark):
    down = lap(number=1, d=[0.0, 20.0, 10.0])
    nan = lap(number=2)
    nan.loc[3, "distance_aligned"] = np.nan
    frames = [lap(), down, nan, lap(number=3, d=[5.0]), lap(number=4, d=[7.0, 7.0])]
    good, bad = S.resample_session(spark.createDataFrame(pd.concat(frames)))
    why = {r["lap_number"]: r["reason"] for r in bad.collect()}
    assert good.select("lap_number").distinct().collect()[0][0] == 7 and set(why) == {1, 2, 3, 4}
    assert "non-decreasing" in why[1] and "non-finite" in why[2] and "at least 2" in why[3] and "single distance" in why[4]


def test_merge_uses_the_union_clipped_to_the_overlap(spark):
    base = dict(**KEY, driver="A", lap_number=1)
    car = pd.DataFrame([dict(base, session_time=t, speed=100.0 + 10 * t, throttle=t, rpm=t, n_gear=int(t) + 1, brake=t >= 1, drs=0) for t in (0.0, 1.0, 2.0)])
    pos = pd.DataFrame([dict(base, session_time=t, x=10 * t, y=0.0, z=0.0) for t in (0.0, 0.5, 1.5, 2.0)])
    for span in (0.4, 60.0):
        got = S.merge_channels(spark.createDataFrame(car), spark.createDataFrame(pos), Axis(LAP, "session_time", span)).toPandas().sort_values("session_time")
        assert got["session_time"].tolist() == [0, 0.5, 1, 1.5, 2] and got["speed"].tolist() == [100, 105, 110, 115, 120]
        assert got["n_gear"].tolist() == [1, 1, 2, 2, 3] and np.allclose(got["x"], got["session_time"])
    late = pos.assign(session_time=pos["session_time"] + 5)
    assert "overlap" in S.overlap(spark.createDataFrame(car), spark.createDataFrame(late)).first()["reason"]


def test_raw_distance_and_integrate_agree_with_trapezoids_for_any_chunk(spark):
    one = lap(t=np.sort(np.random.default_rng(1).random(251)) * 90)
    v, t = one["speed"] / 3.6, one["session_time"]
    want = np.concatenate([[0], np.cumsum(0.5 * (v.to_numpy()[1:] + v.to_numpy()[:-1]) * np.diff(t))])
    for span in (0.5, 7.0, 1e6):
        got = S.add_raw_distance(spark.createDataFrame(one), Axis(LAP, "session_time", span)).toPandas().sort_values("session_time")
        np.testing.assert_allclose(got["distance_raw"], want, atol=1e-9)


def test_ordered_primitives_across_chunks(spark):
    df = spark.createDataFrame([(1, float(i), i if i % 7 == 0 else None, float((i * 37) % 11)) for i in range(50)], "k int, t double, s int, v double")
    axis = Axis(("k",), "t", 4.0)
    got = running(neighbours(df, axis, ["v"]), axis, maxima={"m": F.col("v")}).toPandas().sort_values("t")
    v = got["v"].to_numpy()
    assert (got["m"].to_numpy() == np.maximum.accumulate(v)).all()
    assert [p["v"] if p else None for p in got["prev"]] == [None, *v[:-1]] and [p["v"] if p else None for p in got["next"]] == [*v[1:], None]
    marked = df.withColumn("obs", F.when(F.col("s").isNotNull(), F.struct("s"))).drop("s")
    seen = brackets(axis.cut(marked), axis, ["obs"]).toPandas().sort_values("t")
    assert [p["s"] for p in seen["obs_prev"]] == [i // 7 * 7 for i in range(50)] and seen["obs_next"].iloc[0]["s"] == 0 and seen["obs_next"].iloc[1]["s"] == 7
    total = integrate(df, axis, ["v"], lambda a, b: b["v"] - a["v"], "c").toPandas().sort_values("t")
    np.testing.assert_allclose(total["c"], v - v[0])


def test_one_lap_with_most_of_the_rows_is_spread_over_tasks(spark):
    rng = np.random.default_rng(0)
    hot = lap(number=1, d=np.sort(rng.random(20000)) * 9000, t=np.arange(20000) * 0.01)
    frames = [hot] + [lap(number=n) for n in range(2, 6)]
    df = spark.createDataFrame(pd.concat(frames))
    rows = S.DISTANCE.cut(df).filter("lap_number = 1").repartition(8, *S.DISTANCE.chunk_keys)
    assert max(r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) < 14000
    same(grid_of(spark, frames).query("lap_number == 1").reset_index(drop=True), expected(hot), ["grid_index", "speed", "n_gear"])


def test_axis_ends_continue_with_raw_distance(spark):
    d = [0.0, 0.0, 10.0, 20.0, 20.0, 30.0, 40.0, 40.0]
    one = lap(d=d)[[*LAP, "session_time", "distance_aligned"]].assign(distance_raw=[0.0, 6.0, 14.0, 25.0, 30.0, 38.0, 47.0, 55.0])
    line = spark.createDataFrame([(2024, 1, "Q", 40.0)], "season int, round int, session_code string, line_length_m double")
    got = S.extend_axis_ends(spark.createDataFrame(one), line).toPandas().sort_values("session_time")["distance_aligned"].tolist()
    assert got == [-4.0, 2.0, 10.0, 20.0, 20.0, 30.0, 39.0, 47.0]


def test_origin_moves_to_the_latest_opening_but_no_farther_than_the_cap(spark):
    df = spark.createDataFrame(pd.concat([lap(number=1, offset=3.0), lap(number=2, offset=12.0)]))
    moved = S.place_axis_origin(df).groupBy("lap_number").agg(F.min("distance_aligned")).toPandas().sort_values("lap_number")
    assert moved.iloc[:, 1].tolist() == [-9.0, 0.0]
    assert S.place_axis_origin(spark.createDataFrame(lap(offset=900.0))).first()["origin_shift_m"] == 150.0


def test_delta_is_zero_on_the_reference_and_null_past_its_end(spark):
    g = S.resample(spark.createDataFrame(pd.concat([lap(number=1), lap(number=2, d=np.arange(0, 1101.0, 5.0))])))
    laps = spark.createDataFrame([(2024, 1, "Q", "SYN", 1, 80.0, True), (2024, 1, "Q", "SYN", 2, 81.0, True)], "season int, round int, session_code string, driver string, lap_number int, lap_time double, is_accurate boolean")
    ref = M.resolve_reference(laps, S.lap_lengths(g))
    d = S.delta_t(S.time_curves(g), ref, "session_fastest").toPandas()
    assert (d[d.lap_number == 1].delta_t_s == 0).all() and d[(d.lap_number == 2) & (d.grid_index > 100)].delta_t_s.isna().all() and set(d.reference) == {"SYN L1"}


def test_reference_spec_and_missing_reference(spark):
    with pytest.raises(ValueError):
        M.ReferenceSpec("lap")
    with pytest.raises(ValueError):
        M.ReferenceSpec("best")
    laps = spark.createDataFrame([(2024, 1, "Q", "A", 1, 80.0, True), (2024, 1, "Q", "B", 1, None, True)], "season int, round int, session_code string, driver string, lap_number int, lap_time double, is_accurate boolean")
    with pytest.raises(Exception, match="driver_best reference"):
        M.resolve_reference(laps, laps, M.ReferenceSpec("driver_best")).collect()
    assert [r["driver"] for r in M.missing_references(laps, laps).collect()] == ["B"]


def test_grid_acceptance_on_an_exact_grid(spark):
    df = spark.createDataFrame(pd.concat([lap(number=1), lap(number=2)]))
    row = G.acceptance(df, S.resample(df)).first()
    assert row["laps"] == 2 and row["structure_ok"] and row["elapsed_ok"] and row["discrete_ok"] and row["ok"] and row["speed_p99"] < 1e-9


def test_time_curves_need_grid_index_zero(spark):
    g = S.resample(spark.createDataFrame(lap())).filter("grid_index > 0")
    with pytest.raises(Exception, match="grid index 0"):
        S.time_curves(g).collect()


def test_lap_without_a_time_is_refused(spark):
    one = lap(number=5)
    one.loc[4, "session_time"] = np.nan
    good, bad = S.resample_session(spark.createDataFrame(pd.concat([lap(), one])))
    assert [r["reason"] for r in bad.collect()] == ["time contains non-finite values"] and good.count() == 101


def test_result_does_not_depend_on_the_number_of_partitions(spark):
    frames = [lap(number=n, d=np.arange(0, 1000.0, 3.0 + n)) for n in range(1, 4)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        got = []
        for parts in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got.append(grid_of(spark, frames))
        pd.testing.assert_frame_equal(*got)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_grouped_resample_equals_the_spread_one_without_the_jvm(spark):
    import inspect

    from trackgrid.operators import grouped
    from trackgrid.operators.grouped import resample_arrow

    assert not any(name in inspect.getsource(grouped) for name in ("_jvm", "_jsc", "sparkContext", "_jdf"))

    rng = np.random.default_rng(5)
    frames = [lap(number=n, d=np.sort(rng.integers(-40, 400, 60)) * 1.0 + (n == 3) * 35.5) for n in range(1, 5)]
    df = spark.createDataFrame(pd.concat(frames))
    columns = [*LAP, "grid_index", "distance_m", "elapsed_time", *CH, "n_gear", "brake", "drs", "source_gap_m"]
    want = S.resample(df).select(*columns).toPandas().sort_values([*LAP, "grid_index"]).reset_index(drop=True)
    got = resample_arrow(df).select(*columns).toPandas().sort_values([*LAP, "grid_index"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, rtol=1e-12, check_dtype=False)


def samples_moved(df) -> int:
    """How often the final plan deals samples out by chunk."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    return sum("Exchange hashpartitioning(_piece" in line and "ReusedExchange" not in line for line in plan.splitlines())


def test_windows_and_summaries_share_one_exchange(spark):
    from trackgrid.functions.ordered import brackets, integrate, neighbours, running
    from trackgrid.session import cut

    df = cut(spark.createDataFrame(lap()).select(*LAP, "session_time", "distance_aligned", "speed", "throttle", "rpm", "x", "y", "n_gear", "brake", "drs"), "samples")
    few = df.select(*LAP, "session_time", "speed")
    assert samples_moved(neighbours(few, S.TIME, ["speed"])) == 1
    assert samples_moved(running(few, S.TIME, {"s": F.col("speed")}, {"m": F.col("speed")})) == 1
    assert samples_moved(integrate(few, S.TIME, ["speed"], lambda a, b: a["speed"] + b["speed"], "i")) == 1
    assert samples_moved(brackets(few.withColumn("obs", F.struct("speed")), S.TIME, ["obs"])) == 1
    assert samples_moved(S.resample(df)) == 1
    car, pos = df.select(*LAP, "session_time", "speed", "throttle", "rpm", "n_gear", "brake", "drs"), df.select(*LAP, "session_time", "x", "y", F.lit(0.0).alias("z"))
    assert samples_moved(S.merge_channels(car, pos)) == 1
