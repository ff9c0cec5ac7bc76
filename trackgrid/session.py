"""Spark session for local use, and lineage cuts that survive lost executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_FOLDERS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "20g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("trackgrid")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares, from spark.checkpoint.dir.

    Only a local master may fall back on a folder of its own; a cluster
    without the setting is an error, because a machine-local folder is lost
    with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="trackgrid-")
    return _LOCAL_FOLDERS[app]


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Around a write: Spark removes its shuffle files when it is done, as nothing reads them again.

    For writes only, which plan anew each time; a DataFrame that is collected twice would miss the files.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def cut(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write a table that several later steps read, and read it back.

    A written table ends the lineage: a lost executor costs a re-read, not a
    recomputation of everything before it, and the reader sees true file
    sizes, so Spark can choose its join strategy from them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with swept(spark):
        df.write.mode("errorifexists").option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers of all executors, once per application; Spark gives it to later ones too."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "trackgrid_modules.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in (n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
