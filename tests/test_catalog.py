"""Registered queries against DuckDB on the smallest tables."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalog import load_all, warehouse
from trackgrid.keys import LAP

QUERIES = load_all()
CHECKED = (
    "ser01_union_timebase", "ser05_enforce_monotonic", "ser10_resample", "ser13_lap_rejects", "ser18_value_at_time", "ser22_rising_edges", "ser26_brake_edge_displacement", "agg01_median_traces",
    "agg05_microsector_times", "seg06b_detect_events", "seg13_corner_phases", "seg19_corner_metrics", "spa05_nearest_embedding", "spa13_map_distance", "val01_line_crossings", "qua02_unique", "qua05_allowed_values",
    "src02_coerce", "ref05_driver_entries", "flt05_sessions_due", "flt06_resolve_layout", "win08_top_n", "jon09_nearest_on_line", "set05_first_per_key", "qry02_drivers",
)


def test_every_query_has_a_spec_and_most_have_sql():
    assert len(QUERIES) > 200 and sum(q.sql is not None for q in QUERIES.values()) > 0.9 * len(QUERIES)
    assert all(q.out for q in QUERIES.values())


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    show = lambda v: "" if v is None or v is pd.NA or v != v else (repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v))
    return sorted(tuple(show(v) for v in r) for r in df[cols].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, sf, duck, name):
    q = QUERIES[name]
    assert rows(q.run(spark, sf).toPandas()) == rows(duck.execute(q.oracle()).df())


def test_flagship_runs(spark, sf):
    assert QUERIES["flagship_overlay"].run(spark, sf).count() > 0


def test_load_audit_lists_every_table_that_was_loaded(spark, tmp_path, monkeypatch):
    """Four drivers with samples of their own: a row per session and table, not of the laps alone."""
    samples = spark.range(400).select(
        F.col("id").alias("event_id"), (F.lit(1704067200) + F.col("id") * 6400).cast("timestamp").cast("timestamp_ntz").alias("ts"), (F.col("id") % 4 * 5).alias("user_id"), F.lit("view").alias("event_type"),
        (F.col("id") % 7).cast("double").alias("value"), F.concat(F.lit('{"k": '), (F.col("id") * 7 % 100).cast("string"), F.lit("}")).alias("props"),
    )
    samples.write.parquet(f"{tmp_path}/events.parquet")
    for name in ("fact_grid", "fact_micro", "dim_lap"):
        monkeypatch.setattr(warehouse, name, lambda b: b.tele().select(*LAP, "speed"))
    got = QUERIES["snk08_load_audit"].run(spark, str(tmp_path)).toPandas()
    loaded = {"laps", "fact_telemetry_grid", "fact_microsector", "dim_lap"}
    assert set(got.table) == loaded and len(got) == len(loaded) * len(got[["season", "round", "session_code"]].drop_duplicates())
    assert got.quality_ok.all() and got[got.table == "fact_telemetry_grid"].rows.sum() == 400
