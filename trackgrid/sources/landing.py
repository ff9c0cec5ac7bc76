"""Landing typed tables: coercion, tagging, quarantine, write-once snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackgrid.functions.columns import no_nan
from trackgrid.keys import LAP, SESSION
from trackgrid.schemas import SESSION_META, TYPES, TableSpec


class IngestError(ValueError):
    """A source does not have the declared shape."""


# ---------------------------------------------------------------- coercion

def to_seconds(column: str, dtype: T.DataType) -> Column:
    """Day-time interval to seconds; anything else to a number, null when it is none."""
    c = F.col(column)
    if isinstance(dtype, T.DayTimeIntervalType):
        return F.extract(F.lit("SECOND"), c).cast("double") + 60 * F.extract(F.lit("MINUTE"), c) + 3600 * F.extract(F.lit("HOUR"), c) + 86400 * F.extract(F.lit("DAY"), c)
    return c.try_cast("double")


def to_bool(column: str, dtype: T.DataType) -> Column:
    """true/1 and false/0/empty as text, truthiness for numbers; null and other text stay null."""
    c = F.col(column)
    if isinstance(dtype, T.StringType):
        text = F.lower(F.trim(c))
        return F.when(text.isin("true", "1"), F.lit(True)).when(text.isin("false", "0", ""), F.lit(False))
    if isinstance(dtype, T.BooleanType):
        return c
    number = c.cast("double")
    return F.when(~F.isnan(number), number != 0)


def to_integer(column: str, kind: str) -> Column:
    """Numeric, null when it is none, rounded half to even, then the integer type."""
    return F.rint(F.col(column).try_cast("double")).try_cast(TYPES[kind])


def coerce(df: DataFrame, spec: TableSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Project a source onto a declared table. Undeclared columns are dropped, a missing one is an error."""
    missing = [s for _, s, _ in spec.columns if s not in df.columns]
    if missing:
        raise IngestError(f"{spec.name}: source columns {missing} are missing")
    types = {f.name: f.dataType for f in df.schema}
    out = []
    for target, source, kind in spec.columns:
        if kind == "boolean":
            c = to_bool(source, types[source])
        elif kind in ("short", "byte", "int"):
            c = to_integer(source, kind)
        elif target.endswith("_time"):
            c = to_seconds(source, types[source])
        elif kind in ("float", "double"):
            c = F.col(source).try_cast("double").cast(TYPES[kind])
        else:
            c = F.col(source).cast(TYPES[kind])
        out.append(c.alias(target))
    return no_nan(df.select(*keep, *out))


def overflowed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Per integer column, how many numbers do not fit the declared type."""
    ints = [(t, s, k) for t, s, k in spec.columns if k in ("short", "byte", "int")]
    lost = [F.count_if(F.rint(F.col(s).try_cast("double")).isNotNull() & ~F.isnan(F.col(s).try_cast("double")) & to_integer(s, k).isNull()).alias(t) for t, s, k in ints]
    counts = df.agg(*lost)
    return counts.select(F.inline(F.array(*[F.struct(F.lit(t).alias("column"), F.col(t).alias("n")) for t, _, _ in ints]))).filter("n > 0")


def all_null(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Required columns that hold no value at all although the table has rows."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in spec.required])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in spec.required])
    return counts.filter("_rows > 0").select(F.inline(rows)).filter("n = 0").select("column")


def duplicate_keys(df: DataFrame, key: Sequence[str], limit: int = 5) -> DataFrame:
    """The first offenders of a business key."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy(*key).limit(limit)


def require_valid(df: DataFrame, spec: TableSpec, scope: Sequence[str] = ()) -> DataFrame:
    """The table itself, once its required columns and its key hold."""
    empty = [r["column"] for r in all_null(df, spec).collect()]  # at most one row per declared column
    if empty:
        raise IngestError(f"{spec.name}: required columns {empty} are entirely null")
    twice = duplicate_keys(df, [*scope, *spec.key]).collect()  # at most five rows
    if twice:
        raise IngestError(f"{spec.name}: duplicate keys, first {[tuple(r) for r in twice]}")
    return df


def orphans(samples: DataFrame, laps: DataFrame) -> DataFrame:
    """Laps that have samples but no row in the lap table."""
    return samples.select(*LAP).distinct().join(laps.select(*LAP).distinct(), list(LAP), "left_anti")


def tag_samples(rows: DataFrame, driver: Column, lap: Column) -> DataFrame:
    """Source rows of all laps, each tagged with its driver and lap; absent Source and Status are filled.

    The laps are one table, whose partition or file columns say whose a row is, so
    the plan does not grow with their number.
    """
    return with_defaults(rows.withColumn("_driver", driver).withColumn("_lap_number", lap))


def with_defaults(df: DataFrame) -> DataFrame:
    for name, default in (("Source", F.lit(None).cast("string")), ("Status", F.lit(None).cast("string"))):
        if name not in df.columns:
            df = df.withColumn(name, default)
    return df


def usable_laps(requested: DataFrame, samples: DataFrame, laps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(laps to ingest, what is skipped with its reason). A driver without a usable lap is skipped; none at all is an error.

    ``requested``: session and driver.
    """
    counts = samples.groupBy(*LAP).agg(F.count(F.lit(1)).alias("_n"), F.count("session_time").alias("_t"))
    judged = laps.select(*LAP).join(counts, list(LAP), "left")
    reason = F.when(F.coalesce(F.col("_n"), F.lit(0)) == 0, F.lit("lap has no telemetry")).when(F.col("_t") < F.col("_n"), F.lit("telemetry without a time"))
    judged = judged.withColumn("reason", reason)
    good = judged.filter("reason IS NULL").select(*LAP)
    if not good.take(1):
        raise IngestError("no requested driver has a usable lap")
    who = [*SESSION, "driver"]
    lost = requested.select(*who).join(good.select(*who).distinct(), who, "left_anti").select(*who, F.lit(None).cast("int").alias("lap_number"), F.lit("driver has no usable lap").alias("reason"))
    return good, judged.filter("reason IS NOT NULL").select(*LAP, "reason").unionByName(lost)


def corner_rows(df: DataFrame) -> DataFrame:
    return df.withColumn("Letter", F.coalesce("Letter", F.lit("")) if "Letter" in df.columns else F.lit(""))


# ---------------------------------------------------------------- snapshots

def read_tables(spark: SparkSession, root: str, specs: Mapping[str, TableSpec]) -> dict[str, DataFrame]:
    """Typed tables below a folder; an absent one is left out, not invented."""
    out = {}
    for name, spec in specs.items():
        path = f"{root}/{name}"
        if exists(spark, path):
            parts = T.StructType([T.StructField("season", T.IntegerType()), T.StructField("round", T.IntegerType()), T.StructField("session_code", T.StringType())])
            out[name] = no_nan(spark.read.schema(T.StructType(spec.struct.fields + parts.fields)).parquet(path))
    return out


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_session_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SESSION_META).json(path, multiLine=True)


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and two order-free hashes of a table's content.

    Sums of row hashes count equal rows, and every column is hashed with its
    null mark, so a value that moves to a null neighbour is seen.
    """
    marked = [x for c in sorted(df.columns) for x in (F.col(c), F.col(c).isNull())]
    total = lambda seed: F.coalesce(F.sum(F.xxhash64(F.lit(seed), *marked).cast("decimal(20,0)")), F.lit(0)).cast("string")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.concat_ws("/", total(1), total(2)).alias("content"))


def write_snapshot(df: DataFrame, root: str, table: str, snapshot_date: str, spec: TableSpec | None = None) -> str:
    """Write one dated table once. Writing the same content again is a no-op; other content is an error.

    The data is written to a staging folder and renamed, and only then the
    manifest row is added. A published folder without a manifest is what a crash
    between the two leaves: it is taken if it holds exactly this content.
    """
    spark = df.sparkSession
    path, manifest = f"{root}/{table}/snapshot_date={snapshot_date}", f"{root}/_manifest/{table}/snapshot_date={snapshot_date}"
    now = tuple(fingerprint(df).first())
    if exists(spark, manifest):
        if tuple(spark.read.parquet(manifest).select("rows", "content").first()) == now:
            return "unchanged"
        raise IngestError(f"{table} of {snapshot_date} exists with other content; a snapshot is never overwritten")
    if not exists(spark, path):
        staging = f"{root}/_staging/{table}/snapshot_date={snapshot_date}"
        df.write.mode("overwrite").parquet(staging)
        Path = spark._jvm.org.apache.hadoop.fs.Path
        fs = Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(Path(f"{root}/{table}"))
        if not fs.rename(Path(staging), Path(path)):
            raise IngestError(f"could not publish {path}")
    stored = fingerprint(spark.read.schema(df.schema).parquet(path))
    if tuple(stored.first()) != now:
        raise IngestError(f"{path} holds other content and no manifest; remove it and write again")
    stored.withColumn("table", F.lit(table)).write.mode("errorifexists").parquet(manifest)
    return "written"


def verify_snapshot(spark: SparkSession, root: str, table: str, snapshot_date: str) -> bool:
    """Does the stored table still have the content its manifest recorded?"""
    manifest = spark.read.parquet(f"{root}/_manifest/{table}/snapshot_date={snapshot_date}").first()
    now = fingerprint(spark.read.parquet(f"{root}/{table}/snapshot_date={snapshot_date}")).first()
    return (manifest["rows"], manifest["content"]) == (now["rows"], now["content"])


def manifest_stats(samples: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """Per session: rows and drivers ingested, and drivers skipped. Drivers are counted, not listed."""
    per_driver = samples.groupBy(*SESSION, "driver").agg(F.count(F.lit(1)).alias("rows"))
    out = per_driver.groupBy(*SESSION).agg(F.count(F.lit(1)).alias("drivers"), F.sum("rows").alias("rows"), F.min("rows").alias("least"), F.max("rows").alias("most"))
    if skipped is not None:
        lost = skipped.filter("lap_number IS NULL").groupBy(*SESSION).agg(F.count(F.lit(1)).alias("drivers_skipped"))
        out = out.join(lost, list(SESSION), "left").fillna(0, ["drivers_skipped"])
    return out


def latest_snapshot(snapshots: DataFrame, by: Sequence[str] = SESSION, date: str = "snapshot_date") -> DataFrame:
    """The rows of each session's latest dated snapshot."""
    last = snapshots.groupBy(*by).agg(F.max(date).alias(date))
    return snapshots.join(last, [*by, date], "left_semi")


# ---------------------------------------------------------------- paged payloads

def page_faults(pages: DataFrame, items: str, reported: str = "total") -> DataFrame:
    """Requests that report no items, or that yield another number of items than reported."""
    checks = pages.groupBy("request").agg(F.max(F.col(reported).cast("long")).alias("_t"), F.sum(F.size(items)).alias("_n"))
    fault = F.when(F.col("_t") == 0, F.lit("empty payload")).when(F.col("_n") != F.col("_t"), F.lit("incomplete payload"))
    return checks.select("request", fault.alias("fault")).filter("fault IS NOT NULL")


def merge_pages(pages: DataFrame, items: str, reported: str = "total") -> DataFrame:
    """Flat lists of a paged payload put together; a faulty request is an error.

    ``pages``: one row per page with ``request``, the list column and the reported total.
    """
    for bad in page_faults(pages, items, reported).take(1):
        raise IngestError(f"{bad['fault']}: {bad['request']}")
    return pages.select("request", F.explode(items).alias("item"))


def merge_nested(races: DataFrame, results: str, key: Sequence[str] = ("season", "round")) -> DataFrame:
    """A race split over pages has its nested results joined again: one row per race and entry."""
    return races.select(*key, F.explode(results).alias("entry"))
