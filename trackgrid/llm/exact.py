"""Exact deduplication by keyed streaming state.

A landed table of (digest, doc_id, place) feeds a Structured Streaming query
that keeps, per digest and without expiry, the largest doc_id, the place of its
row and the number of rows, in RocksDB on disk. The state is read back as a
table. A digest seen more than once is a hit: the whole normalised texts of its
rows are compared byte by byte, and rows whose texts differ are separated again.
All of it is DataFrame functions; no Python touches a row.

Defined results: a null text equals the empty text; a null doc_id ranks below
every other and gives a null keep_id only where the whole group has none;
of rows that repeat a doc_id and a text one is kept; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackgrid.llm.words import LOWER, UPPER
from trackgrid.session import cut, shared_dir

LEAST = -(2**63)
#: The state lies in RocksDB files; no space is set aside ahead, and an executor's stores share a bounded cache,
#: so many small stores stay small on disk and in memory.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
}


@contextmanager
def store_settings(spark: SparkSession) -> Iterator[None]:
    """The session's settings with STORE, put back at the end."""
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def normalised(text: Column) -> Column:
    """Text with A-Z in lower case; lower() is exact where every character is one byte."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class ExactDedup:
    """Keyed state in ``folder``; every ``ingest`` adds rows and runs the stream over what is new."""

    def __init__(self, spark: SparkSession, folder: str, digest: Callable[[Column], Column] = sha256):
        self.spark, self.folder, self.digest = spark, folder.rstrip("/"), digest

    def ingest(self, docs: DataFrame, files_per_trigger: int | None = None) -> None:
        place = F.concat_ws("#", F.lit(uuid.uuid4().hex), F.input_file_name(), F.monotonically_increasing_id().cast("string"))
        landed = docs.select(self.digest(normalised(F.col("text"))).alias("digest"), F.col("doc_id").cast("long").alias("doc_id"), place.alias("place"))
        landed.write.mode("append").parquet(f"{self.folder}/landed")
        source = self.spark.readStream.schema("digest binary, doc_id long, place string")
        if files_per_trigger:
            source = source.option("maxFilesPerTrigger", str(files_per_trigger))
        ordered = source.parquet(f"{self.folder}/landed").withColumn("ord", F.coalesce("doc_id", F.lit(LEAST)))
        kept = ordered.groupBy("digest").agg(F.max("ord").alias("ord"), F.max_by("place", "ord").alias("place"), F.count(F.lit(1)).alias("n"))
        with store_settings(self.spark):
            stream = kept.writeStream.format("noop").outputMode("update").option("checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).start()
            stream.awaitTermination()

    def landed(self) -> DataFrame:
        return self.spark.read.schema("digest binary, doc_id long, place string").parquet(f"{self.folder}/landed")

    def state(self) -> DataFrame:
        """What the state holds: digest, ord, place of the row that stays, n."""
        read = self.spark.read.format("statestore").load(f"{self.folder}/state")
        names = read.schema["value"].dataType.names
        pick = lambda i: F.col("value").getField(names[i])  # noqa: E731  max, then value and order of max_by, then count
        return read.select(F.col("key").getField("digest").alias("digest"), pick(0).alias("ord"), pick(1).alias("place"), pick(-1).alias("n"))

    def hits(self, docs: DataFrame, state: DataFrame) -> DataFrame:
        """Whole normalised texts of every row whose digest came more than once, as a written table."""
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("norm")).withColumn("digest", self.digest(F.col("norm")))
        return cut(texts.join(state.filter("n > 1").select("digest"), "digest"), "exact-hits")

    def result(self, docs: DataFrame) -> DataFrame:
        """doc_id, place, digest, keep_id, group_size, kept: a row per row of all that was ingested.

        ``docs`` are the same documents, read again for the byte check.
        """
        with store_settings(self.spark):
            state = cut(self.state(), "exact-state")
        hits = self.hits(docs, state)
        # equal digests with different bytes: minimum and maximum differ
        clash = cut(hits.groupBy("digest").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi")).filter("lo <> hi").select("digest"), "exact-clash")
        found = self.landed().join(state.withColumnRenamed("place", "keep_place"), "digest")
        out = found.select(
            "doc_id", "place", "digest", F.when(F.col("ord") != LEAST, F.col("ord")).alias("keep_id"),
            F.col("n").alias("group_size"), (F.col("place") == F.col("keep_place")).alias("kept"), F.lit("").alias("norm"),
        )
        if clash.isEmpty():
            return out
        return out.join(clash, "digest", "left_anti").unionByName(self.separated(hits.join(clash, "digest", "left_semi")))

    def separated(self, rows: DataFrame) -> DataFrame:
        """The same columns where a digest stands for several texts: grouped by the bytes themselves."""
        rows = rows.withColumn("ord", F.coalesce("doc_id", F.lit(LEAST))).withColumn("place", F.monotonically_increasing_id().cast("string"))
        rows = cut(rows, "exact-separated")
        best = rows.groupBy("digest", "norm").agg(F.max("ord").alias("keep_id"), F.max_by("place", "ord").alias("keep_place"), F.count(F.lit(1)).alias("group_size"))
        return rows.join(best, ["digest", "norm"]).select(
            "doc_id", "place", "digest", F.when(F.col("keep_id") != LEAST, F.col("keep_id")).alias("keep_id"), "group_size", (F.col("place") == F.col("keep_place")).alias("kept"), "norm"
        )


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Every document with the document that stays for it."""
    spark = docs.sparkSession
    run = ExactDedup(spark, f"{shared_dir(spark)}/exact-{uuid.uuid4().hex}", digest)
    run.ingest(docs)
    return run.result(docs)


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stay, with the columns they came with."""
    kept = exact_dedup(docs).filter("kept").select(F.col("digest").alias("__digest"), F.col("keep_id").alias("__keep"))
    marked = docs.withColumn("__digest", sha256(normalised(F.col("text"))))
    cond = (marked["__digest"] == kept["__digest"]) & marked["doc_id"].eqNullSafe(kept["__keep"])
    return marked.join(kept, cond, "left_semi").dropDuplicates(["__digest", "doc_id"]).drop("__digest")
