"""Reference data of whole seasons: built, checked and published season by season."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackgrid.operators import calendar as R
from trackgrid.operators import contracts as K
from trackgrid.operators.quality import ERROR, contract_version, validate_tables
from trackgrid.session import cut
from trackgrid.sources.versions import Versions, new_version

SEASON = ("season",)


class Ingested(NamedTuple):
    """``tables``: rows published per season and table. ``refused``: seasons that stay as they were, with the reason.
    ``skipped``: rounds without an entry yet. ``findings``: of all seasons."""

    tables: DataFrame
    refused: DataFrame
    skipped: DataFrame
    findings: DataFrame


def build_reference(races: DataFrame, drivers: DataFrame, constructors: DataFrame) -> dict[str, DataFrame]:
    """The five reference tables from parsed races (pages of them), drivers and constructors."""
    return {
        "dim_event": R.event_table(races), "dim_session_schedule": R.session_schedule(races), "dim_driver": R.driver_table(drivers),
        "dim_constructor": R.constructor_table(constructors), "driver_entry": R.driver_entries(races),
    }


def ingest_reference(spark: SparkSession, root: str, races: DataFrame, drivers: DataFrame, constructors: DataFrame, snapshot_date: str) -> Ingested:
    """Build every reference table and publish the seasons that keep their contracts.

    A round without a result yet is reported and its season goes on. A season with an
    error finding, or without a single entry, is refused and what was published of it
    before stays; the tables of the others become visible together.
    """
    races = cut(races, "reference-races")
    tables = {name: cut(df, name) for name, df in build_reference(races, drivers, constructors).items()}
    rules = {name: K.CONTRACTS[name] for name in tables}
    findings = cut(validate_tables(spark, tables, rules), "reference-findings")
    what = F.concat(F.col("table"), F.lit(": "), F.col("rule"), F.lit(" ("), F.col("count").cast("string"), F.lit(" rows)"))
    broken = findings.filter((F.col("severity") == ERROR) & F.col("season").isNotNull()).groupBy(*SEASON).agg(F.min(what).alias("reason"))
    seasons = tables["dim_event"].select(*SEASON).distinct()
    empty = seasons.join(tables["driver_entry"].select(*SEASON).distinct(), list(SEASON), "left_anti").withColumn("reason", F.lit("no round has a driver entry"))
    refused = cut(broken.unionByName(empty).groupBy(*SEASON).agg(F.min("reason").alias("reason")), "reference-refused")
    store, version = Versions(spark, root), new_version()
    told = []
    for name, df in tables.items():
        stored = store.stage(version, name, df.join(refused, list(SEASON), "left_anti"), SEASON)
        told.append(stored.withColumn("table", F.lit(name)))
    entries = reduce(DataFrame.unionByName, told).withColumns({"snapshot_date": F.lit(snapshot_date), "contract_version": F.lit(contract_version(rules)), "gone": F.lit(False)})
    entries = cut(entries, "reference-entries")
    store.commit(version, entries)
    return Ingested(entries.select(*SEASON, "table", "rows"), refused, R.skipped_rounds(races, tables["driver_entry"]), findings)


def read_reference(spark: SparkSession, root: str, season: int) -> dict[str, DataFrame]:
    """The published tables of a season; one that was never published is left out."""
    store = Versions(spark, root)
    known = [r["table"] for r in store.current().filter(F.col("part") == f"season={season}").select("table").distinct().collect()]  # five names at most
    return {name: store.read(name).filter(F.col("season") == season) for name in known}
