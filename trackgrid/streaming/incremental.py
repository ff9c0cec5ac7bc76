"""Incremental load: new snapshots are picked up and replace their sessions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from trackgrid.keys import SESSION
from trackgrid.sources.landing import latest_snapshot
from trackgrid.sources.tables import write_sessions


FILE = "_file"


def touched_files(batch: DataFrame, notes: str, number: int, noted: list[str], date: str | None) -> list[str]:
    """Note the batch's files and name those that hold the rows that count of its sessions."""
    spark = batch.sparkSession
    batch.select(*noted).distinct().write.mode("overwrite").parquet(f"{notes}/batch={number}")
    known = spark.read.parquet(notes).join(batch.select(*SESSION).distinct(), list(SESSION), "left_semi")
    if date:
        known = latest_snapshot(known, SESSION, date)
    return [r[0] for r in known.select(FILE).distinct().collect()]  # files of the touched sessions


def load_new_snapshots(
    spark: SparkSession, source: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, files_per_batch: int | None = None, date: str = "snapshot_date"
) -> StreamingQuery:
    """Run every file that is new since the last call through ``transform`` and store the result.

    A batch names the sessions it touches; all landed rows of these sessions are
    read again, so a session that arrives in several files is still computed as
    a whole. Its partition is replaced, which makes a repeated batch harmless.
    Where rows are dated, a session is its latest snapshot: one published again
    replaces the earlier one instead of adding to it.
    Every batch notes which sessions (and dates) its files hold, below the
    checkpoint; what is read again are the files noted for the touched sessions
    and the dates that count, not the whole source. A repeated batch replaces its
    own notes. The query stops once it has caught up.
    """
    stream = spark.readStream.schema(schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)

    dated = date in schema.fieldNames()
    noted = [*SESSION, *([date] if dated else []), FILE]

    def store(batch: DataFrame, number: int) -> None:
        files = touched_files(batch, f"{checkpoint}/files", number, noted, date if dated else None)
        if not files:
            return
        landed = batch.sparkSession.read.schema(schema).parquet(*files).join(batch.select(*SESSION).distinct(), list(SESSION), "left_semi")
        if dated:
            landed = latest_snapshot(landed, SESSION, date).drop(date)
        write_sessions(transform(landed), target)

    return stream.parquet(source).select("*", F.col("_metadata.file_path").alias(FILE)).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
