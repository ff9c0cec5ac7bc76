"""Resampling as a grouped Arrow map: one call per lap, for sessions that offer nothing but DataFrames.

Uses no handle on the JVM, so it runs through Spark Connect as well. A lap is one
call's work and lies in one task; where a lap may hold a large share of the rows,
series.resample spreads it over its chunks and gives the same points.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trackgrid.keys import CONTINUOUS, DISCRETE, GRID_M, LAP


def resample_arrow(
    df: DataFrame, spacing: float = GRID_M, distance: str = "distance_aligned", time: str = "session_time", continuous: Sequence[str] = CONTINUOUS, discrete: Sequence[str] = DISCRETE, keys: Sequence[str] = LAP
) -> DataFrame:
    """Laps on a uniform distance grid: of equal distances the last sample counts, a state holds up to the next sample.

    Points before the first sample take its values and have no source gap.
    """
    kinds = dict(df.dtypes)
    columns = [*keys, distance, time, *continuous, *discrete]
    numbers = ["distance_m", "elapsed_time", *continuous]
    schema = ", ".join([f"{k} {kinds[k]}" for k in keys] + ["grid_index long"] + [f"{c} double" for c in numbers] + [f"{c} {kinds[c]}" for c in discrete] + ["source_gap_m double"])

    def one(lap: pa.Table) -> pa.Table:
        start = lap[time].to_numpy().min()
        lap = lap.sort_by([(c, "ascending") for c in (distance, time, *continuous, *discrete)])
        d = lap[distance].to_numpy().astype(float)
        lap = lap.take(np.flatnonzero(np.append(d[1:] != d[:-1], True)))
        d = lap[distance].to_numpy().astype(float)
        index = np.arange(max(0, int(np.floor(d[-1] / spacing)) + 1))
        x = index * float(spacing)
        at = np.maximum(np.searchsorted(d, x, side="right") - 1, 0)
        after = np.minimum(at + 1, len(d) - 1)
        held = (after == at) | (x <= d[at])

        def linear(y: np.ndarray) -> np.ndarray:
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.where(held, y[at], (y[after] - y[at]) / (d[after] - d[at]) * (x - d[at]) + y[at])

        values = {c: linear(lap[c].to_numpy().astype(float)) for c in continuous}
        gap = [None if v < lo else 0.0 if v == lo else hi - lo for v, lo, hi in zip(x.tolist(), d[at].tolist(), d[after].tolist(), strict=True)]
        arrays = [pa.array([lap[k][0].as_py()] * len(x), lap.schema.field(k).type) for k in keys]
        arrays += [pa.array(index), pa.array(x), pa.array(linear(lap[time].to_numpy().astype(float) - start)), *map(pa.array, values.values())]
        arrays += [lap[c].take(at).combine_chunks() for c in discrete] + [pa.array(gap, pa.float64())]
        return pa.table(arrays, names=[*keys, "grid_index", *numbers, *discrete, "source_gap_m"])

    return df.select(*columns).groupBy(*keys).applyInArrow(one, schema)
