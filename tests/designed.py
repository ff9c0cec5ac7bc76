"""Designed sessions whose every figure is known: a circle driven by a given speed profile."""

import numpy as np
import pandas as pd

R = 300.0
LENGTH = 2 * np.pi * R
CORNERS = (200.0, 500.0, 800.0, 1100.0, 1400.0, 1700.0)


def speed(s, pace):
    """m/s at a place of the lap: six dips on a straight-line speed."""
    v = 62.0 * pace * np.ones_like(s)
    for c in CORNERS:
        v = v * (1 - 0.45 * np.exp(-(((s - c + LENGTH / 2) % LENGTH - LENGTH / 2) ** 2) / (2 * 45.0**2)))
    return v


def drive(pace):
    """(time, place) on a fine grid over one lap."""
    s = np.linspace(0, LENGTH, 6001)
    v = speed(s, pace)
    t = np.concatenate([[0], np.cumsum(np.diff(s) * 2 / (v[1:] + v[:-1]))])
    return t, s


def session(round=1, code="Q", drivers=("AAA", "BBB", "CCC"), laps=3, seed=0):
    """laps, car, pos and corners of a session, as landed: positions in tenths of a metre."""
    rng = np.random.default_rng(seed + round)
    key = dict(season=2024, round=round, session_code=code)
    out = {"laps": [], "car": [], "pos": []}
    for d, driver in enumerate(drivers):
        clock = 100.0 + d
        for number in range(1, laps + 1):
            t, s = drive(1.0 - 0.004 * d + 0.002 * rng.standard_normal())
            lap = dict(**key, driver=driver, lap_number=number)
            ends = np.interp([LENGTH / 3, 2 * LENGTH / 3, LENGTH], s, t)
            out["laps"].append({
                **lap, "driver_number": str(d), "team": f"T{d}", "lap_time": float(t[-1]), "sector1_time": float(ends[0]), "sector2_time": float(ends[1] - ends[0]), "sector3_time": float(ends[2] - ends[1]),
                "lap_start_time": float(clock), "pit_in_time": np.nan, "pit_out_time": np.nan, "stint": 1, "compound": "SOFT", "tyre_life": number, "fresh_tyre": True, "track_status": "1", "is_accurate": True,
            })
            for name, first in (("car", 0.02), ("pos", 0.11)):
                at = np.arange(first, t[-1], 0.24)
                place = np.interp(at, t, s)
                v = speed(place, 1.0)
                slower = speed((place + 6) % LENGTH, 1.0) < v - 0.3
                rows = {**lap, "session_time": clock + at}
                if name == "car":
                    rows |= {"speed": np.gradient(place, at) * 3.6, "throttle": np.where(slower, 0.0, 100.0), "rpm": 9000 + 20 * v, "n_gear": np.clip(v // 9, 1, 8).astype(int), "brake": slower, "drs": 0}
                else:
                    a = place / R
                    rows |= {"x": 10 * R * np.cos(a), "y": 10 * R * np.sin(a), "z": 0.0}
                out[name].append(pd.DataFrame(rows))
            clock += t[-1]
    th = np.array(CORNERS) / R
    corners = pd.DataFrame({**key, "number": np.arange(1, len(CORNERS) + 1), "letter": "", "distance": CORNERS, "x": 10 * R * np.cos(th), "y": 10 * R * np.sin(th)})
    return {"laps": pd.DataFrame(out["laps"]), "car_telemetry": pd.concat(out["car"]), "pos_data": pd.concat(out["pos"]), "circuit_corners": corners}


def landed(spark, *sessions):
    """The sessions' tables as DataFrames, NaN as null."""
    from trackgrid.functions.columns import no_nan

    tables = {n: pd.concat([s[n] for s in sessions], ignore_index=True) for n in sessions[0]}
    return {n: no_nan(spark.createDataFrame(df)) for n, df in tables.items()}


def official(spark, rounds, code="Q"):
    return spark.createDataFrame([(2024, r, code, LENGTH) for r in rounds], "season int, round int, session_code string, official_m double")
