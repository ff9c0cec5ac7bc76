import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from trackgrid import schemas as D
from trackgrid.operators import series as S
from trackgrid.plans import warehouse as W
from trackgrid.session import CLEANUP, cut
from trackgrid.sources import landing as I
from trackgrid.sources import tables as T
from trackgrid.streaming.incremental import load_new_snapshots

from test_series import lap


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_coerce_follows_the_declared_table(spark):
    src = spark.sql("""SELECT 'VER' _driver, 3.5D _lap_number, make_dt_interval(0, 0, 1, 2.25) SessionTime, '301.5' Speed, 'x' Throttle, ' True ' Brake, 9000 RPM, 2.5D nGear, 12 DRS, 'car' Source, 1 Extra""")
    row = I.coerce(src, D.CAR_TELEMETRY).first().asDict()
    assert row == dict(driver="VER", lap_number=4, session_time=62.25, speed=301.5, throttle=None, brake=True, rpm=9000.0, n_gear=2, drs=12, source="car")
    with pytest.raises(I.IngestError, match="Speed"):
        I.coerce(src.drop("Speed"), D.CAR_TELEMETRY)
    with pytest.raises(I.IngestError, match="entirely null"):
        I.require_valid(I.coerce(src.withColumn("Speed", F.lit("x")), D.CAR_TELEMETRY), D.CAR_TELEMETRY)
    with pytest.raises(I.IngestError, match="duplicate"):
        I.require_valid(I.coerce(src.union(src), D.CAR_TELEMETRY), D.CAR_TELEMETRY)


def test_a_snapshot_is_written_once(spark, root):
    df = spark.range(100).withColumn("v", F.col("id") * 0.5)
    assert I.write_snapshot(df, root, "t", "2024-01-01") == "written"
    assert I.write_snapshot(df.repartition(7), root, "t", "2024-01-01") == "unchanged" and I.verify_snapshot(spark, root, "t", "2024-01-01")
    with pytest.raises(I.IngestError, match="never overwritten"):
        I.write_snapshot(df.withColumn("v", F.lit(0.0)), root, "t", "2024-01-01")


def test_pages_must_be_complete(spark):
    page = lambda r, total, n: (r, total, [str(i) for i in range(n)])
    df = lambda *p: spark.createDataFrame([*p], "request string, total string, items array<string>")
    assert I.merge_pages(df(page("a", "5", 3), page("a", "5", 2)), "items").count() == 5
    with pytest.raises(Exception, match="incomplete payload"):
        I.merge_pages(df(page("a", "6", 3)), "items").collect()
    with pytest.raises(Exception, match="empty payload"):
        I.merge_pages(df(page("a", "0", 0)), "items").collect()


def shuffle_files(spark) -> set:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark, root):
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("round")).agg(F.count(F.lit(1)).alias("n")).withColumns({"season": F.lit(2024), "session_code": F.lit("Q")})
    before = shuffle_files(spark)
    kept = cut(df, "swept")
    T.write_sessions(kept, f"{root}/t")
    until = time.monotonic() + 20  # they go in the background
    while (left := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left and kept.count() == spark.read.parquet(f"{root}/t").count() == 10
    assert not spark.conf.get(CLEANUP, None) == "true"


def test_a_reload_replaces_only_its_own_session(spark, root):
    import pandas as pd

    df = spark.createDataFrame(pd.concat([lap(), lap(round=2), lap(round=3)]))
    T.write_sessions(df, f"{root}/t")
    T.write_sessions(df.filter("round = 2").limit(10), f"{root}/t")
    assert {r["round"]: r["count"] for r in spark.read.parquet(f"{root}/t").groupBy("round").count().collect()} == {1: 251, 2: 10, 3: 251}


def test_upsert_keeps_the_last_writer(spark, root):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    T.upsert_table(a, f"{root}/u", ["k"])
    T.upsert_table(spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string"), f"{root}/u", ["k"])
    assert sorted(map(tuple, T.read_table(spark, f"{root}/u").collect())) == [(1, "x"), (2, "z"), (3, "w")]


def test_stream_loads_new_files_and_replaces_late_sessions(spark, root):
    import pandas as pd

    src = spark.createDataFrame(pd.concat([lap(), lap(round=2)]))
    src.write.mode("append").parquet(f"{root}/in")
    run = lambda: load_new_snapshots(spark, f"{root}/in", src.schema, S.resample, f"{root}/grid", f"{root}/ck").awaitTermination()
    run()
    first = spark.read.parquet(f"{root}/grid").groupBy("round").count().collect()
    assert {r["round"]: r["count"] for r in first} == {1: 101, 2: 101}
    run()  # nothing new
    spark.createDataFrame(lap(round=2, number=8)).write.mode("append").parquet(f"{root}/in")
    run()
    assert {r["round"]: r["count"] for r in spark.read.parquet(f"{root}/grid").groupBy("round").count().collect()} == {1: 101, 2: 202}


def test_a_batch_reads_the_files_of_its_sessions_only(spark, root, monkeypatch):
    import pandas as pd

    from trackgrid.streaming import incremental

    read, plain = [], incremental.touched_files
    monkeypatch.setattr(incremental, "touched_files", lambda *a: read.append(plain(*a)) or read[-1])
    rows = spark.createDataFrame(pd.concat([lap(round=r) for r in (1, 2, 3, 4)])).withColumn("snapshot_date", F.lit("2024-01-01"))
    for r in (1, 2, 3, 4):
        rows.filter(F.col("round") == r).coalesce(1).write.mode("append").parquet(f"{root}/in")
    run = lambda: load_new_snapshots(spark, f"{root}/in", rows.schema, S.resample, f"{root}/grid", f"{root}/ck").awaitTermination()
    run()
    assert len(read[-1]) == 4
    rows.filter("round = 2").withColumn("snapshot_date", F.lit("2024-01-02")).withColumn("speed", F.col("speed") + 1).coalesce(1).write.mode("append").parquet(f"{root}/in")
    run()
    assert len(read[-1]) == 1  # the dated session counts by its last snapshot alone
    spark.createDataFrame(lap(round=3, number=9)).withColumn("snapshot_date", F.lit("2024-01-01")).coalesce(1).write.mode("append").parquet(f"{root}/in")
    run()
    assert len(read) == 3 and len(read[-1]) == 2
    got = {r["round"]: r["laps"] for r in spark.read.parquet(f"{root}/grid").groupBy("round").agg(F.countDistinct("lap_number").alias("laps")).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 1}


def test_keys_are_stable_and_unknown_laps_are_refused(spark):
    g = S.resample(spark.createDataFrame(lap()))
    laps = g.select("season", "round", "session_code", F.col("driver").alias("code"), "lap_number").distinct()
    fact = W.fact_grid(g, None, laps)
    again = W.fact_grid(g.repartition(5), None, laps)
    assert fact.select("lap_id").distinct().collect() == again.select("lap_id").distinct().collect() and fact.count() == 101
    with pytest.raises(Exception, match="without lap_id"):
        W.fact_grid(g, None, laps.withColumn("lap_number", F.lit(99))).collect()
    with pytest.raises(ValueError):
        W.overlay(fact, 2024, 1, "Q", 5, 5)


def test_overlay_reads_one_partition_only(spark, root):
    import pandas as pd

    g = S.resample(spark.createDataFrame(pd.concat([lap(), lap(number=8), lap(round=2)])))
    T.write_sessions(W.fact_grid(g, None), f"{root}/f")
    fact = spark.read.parquet(f"{root}/f")
    a, b = [r[0] for r in fact.filter("round = 1").select("lap_id").distinct().collect()]
    out = W.overlay(fact, 2024, 1, "Q", a, b)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 101 and "PartitionFilters" in plan and "round" in plan.split("PartitionFilters", 1)[1][:200]


def test_cut_writes_below_the_shared_folder(spark):
    df = cut(spark.range(5), "x")
    assert df.count() == 5 and spark.conf.get("spark.checkpoint.dir", None) is None or spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0]


def test_fingerprint_sees_repeats_and_null_places(spark):
    from trackgrid.sources.landing import fingerprint

    mark = lambda rows: tuple(fingerprint(spark.createDataFrame(rows, "a int, b int")).first())
    assert mark([(1, 1), (1, 1)]) != mark([(2, 2), (2, 2)]) and mark([(1, None)]) != mark([(None, 1)])
    assert mark([(1, 2), (3, 4)]) == mark([(3, 4), (1, 2)]) and mark([]) == mark([])


def test_a_crash_before_the_manifest_is_taken_up(spark, tmp_path):
    import shutil

    import pytest

    from trackgrid.sources.landing import IngestError, verify_snapshot, write_snapshot

    root, df = f"file://{tmp_path}", spark.createDataFrame([(1, None), (1, None), (2, 5)], "a int, b int")
    assert write_snapshot(df, root, "t", "2024-01-01") == "written" and write_snapshot(df, root, "t", "2024-01-01") == "unchanged"
    shutil.rmtree(tmp_path / "_manifest")
    assert write_snapshot(df, root, "t", "2024-01-01") == "written" and verify_snapshot(spark, root, "t", "2024-01-01")
    assert not [p for p in (tmp_path / "t" / "snapshot_date=2024-01-01").iterdir() if p.is_dir()]
    shutil.rmtree(tmp_path / "_manifest")
    with pytest.raises(IngestError):
        write_snapshot(df.filter("a = 2"), root, "t", "2024-01-01")
