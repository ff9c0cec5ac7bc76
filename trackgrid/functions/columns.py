"""Small column expressions used across the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """NaN and infinities to null: pandas skips them, Spark does not."""
    c = col(c).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def no_nan(df: DataFrame) -> DataFrame:
    """NaN to null in every floating column; the first thing done after a scan."""
    fixed = {f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)) for f in df.schema if f.dataType.typeName() in ("double", "float")}
    return df.withColumns(fixed) if fixed else df


def lerp(x: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """slope * (x - x0) + y0, the order of operations of a linear table lookup."""
    return ((y1 - y0) / (x1 - x0)) * (x - x0) + y0


def flag(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("boolean"), F.lit(False))


def lap_label(driver: Column | str = "driver", lap: Column | str = "lap_number") -> Column:
    return F.concat(col(driver).cast("string"), F.lit(" L"), col(lap).cast("int").cast("string"))


LAP_LABEL = r"^(\S+) L(\d+)$"  # fixed value: label format "VER L11"


def parse_lap_label(label: Column | str) -> Column:
    """struct(driver, lap_number); a label in another form is an error."""
    text = F.trim(col(label))
    return F.when(
        text.rlike(LAP_LABEL),
        F.struct(
            F.regexp_extract(text, LAP_LABEL, 1).alias("driver"),
            F.regexp_extract(text, LAP_LABEL, 2).cast("int").alias("lap_number"),
        ),
    ).otherwise(F.raise_error(F.concat(F.lit("not a lap label: "), text)))


def corner_label(corners: Column) -> Column:
    """array<struct<number, letter>> to "T1-T2a"; an empty array to null."""
    parts = F.transform(corners, lambda c: F.concat(F.lit("T"), c["number"].cast("string"), F.coalesce(c["letter"], F.lit(""))))
    return F.when(F.size(corners) > 0, F.array_join(parts, "-"))


CORNER_PART = r"^T(\d+)([A-Za-z]*)$"  # fixed value: label part "T12a"


def parse_corner_label(label: Column | str) -> Column:
    """"T1-T2a" to [1, 2]; null to an empty array; another form is an error."""
    parts = F.transform(F.split(col(label), "-"), lambda p: F.trim(p))
    return (
        F.when(col(label).isNull(), F.array().cast("array<int>"))
        .when(
            F.forall(parts, lambda p: p.rlike(CORNER_PART)),
            F.transform(parts, lambda p: F.regexp_extract(p, CORNER_PART, 1).cast("int")),
        )
        .otherwise(F.raise_error(F.concat(F.lit("not a corner label: "), col(label))))
    )


def in_closed_window(d: Column, start: Column, end: Column, length: Column) -> Column:
    """start <= d <= end on a circle of the given length."""
    s, e = F.pmod(start, length), F.pmod(end, length)
    return F.when(e >= s, (d >= s) & (d <= e)).otherwise((d >= s) | (d <= e))


def in_half_open_window(d: Column, start: Column, end: Column, length: Column) -> Column:
    """start <= d < end on a circle; the start may be negative."""
    s, e = F.pmod(start, length), F.pmod(end, length)
    return F.when(e > s, (d >= s) & (d < e)).otherwise((d >= s) | (d < e))


def circular_gap(a: Column, b: Column, length: Column) -> Column:
    """Signed a - b, brought into half a lap either way."""
    dev = a - b
    return dev - length * F.rint(dev / length)


def quadrature(sigma: Column | str) -> Column:
    """Aggregate: root of the sum of squares of the finite values, null if none."""
    s = clean(sigma)
    return F.sqrt(F.sum(s * s))


def session_slug(season: Column | str, event: Column | str, session: Column | str) -> Column:
    """season_event_session with everything but letters and digits as "-"."""
    safe = lambda c: F.trim(F.regexp_replace(col(c), r"[^\p{L}\p{N}]", "-"), F.lit("-"))
    return F.concat_ws("_", col(season).cast("string"), safe(event), safe(session))


def positions_to_metres(df: DataFrame, cols: Sequence[str] = ("x", "y")) -> DataFrame:
    from trackgrid.keys import POSITION_UNITS_PER_M

    return df.withColumns({c: F.col(c).cast("double") / POSITION_UNITS_PER_M for c in cols})
