"""Troughs of a circular trace and the event boundaries around them, one trace at a time.

A trace is one session's median speed by grid index and holds at most 10,001
points (the grid's contract, checked where traces are made), so a task holds a
handful of arrays of that length. The nearest lower value of every point comes
from one pass with a stack, the highest value up to there from a sparse table of
range maxima; a trough is then a few numbers, however many candidates a noisy
trace has.
"""

from __future__ import annotations

import numpy as np
import pandas as pd


class RangeMax:
    """Largest value of any range of an array in constant time: maxima of blocks of 1, 2, 4, ..."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 ** len(self.levels) <= len(values):
            half = 2 ** (len(self.levels) - 1)
            self.levels.append(np.maximum(self.levels[-1][:-half], self.levels[-1][half:]))

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """max(values[lo:hi]) for each pair; ranges are not empty."""
        power = np.frexp(hi - lo)[1] - 1
        out = np.empty(len(lo))
        for k in np.unique(power):
            of = power == k
            out[of] = np.maximum(self.levels[k][lo[of]], self.levels[k][hi[of] - 2**k])
        return out


def lower_before(values: np.ndarray) -> np.ndarray:
    """For each place the last place before it with a lower value, -1 if there is none."""
    out, stack = np.full(len(values), -1, np.int64), []
    for i, v in enumerate(values.tolist()):
        while stack and stack[-1][1] >= v:
            stack.pop()
        if stack:
            out[i] = stack[-1][0]
        stack.append((i, v))
    return out


def find(speed: np.ndarray, min_prominence: float) -> tuple[np.ndarray, np.ndarray]:
    """(index, prominence) of the local minima that stand out; a flat floor counts at its first point.

    The prominence is the lower of the two sides' highest speeds, each side taken
    up to the first lower speed or once around.
    """
    n = len(speed)
    if n < 3 or not np.isfinite(speed).all():
        return np.zeros(0, np.int64), np.zeros(0)
    spots = np.flatnonzero((speed < np.roll(speed, 1)) & (speed <= np.roll(speed, -1)))
    if not len(spots):
        return spots, np.zeros(0)
    thrice = np.concatenate([speed] * 3)
    top, mid = RangeMax(thrice), spots + n
    left = np.maximum(lower_before(thrice)[mid], mid - n)
    right = np.minimum((3 * n - 1 - lower_before(thrice[::-1])[::-1])[mid], mid + n)
    prominence = np.minimum(top(left + 1, mid), top(mid + 1, right)) - speed[spots]
    keep = prominence >= min_prominence
    return spots[keep], prominence[keep]


def _first(mask: np.ndarray) -> int | None:
    return int(mask.argmax()) if mask.any() else None


def bounds(speed: np.ndarray, brake: np.ndarray, throttle: np.ndarray, spots: np.ndarray, prominence: np.ndarray, params) -> list[dict]:
    """Event boundaries around each trough, in indices that run on over the start line."""
    n, count, out = len(speed), len(spots), []
    part = lambda a, lo, hi: a[np.arange(lo, max(lo, hi)) % n]
    for k, (i, prom) in enumerate(zip(spots.tolist(), prominence.tolist(), strict=True)):
        v = float(speed[i])
        before = int(spots[k - 1]) - (n if k == 0 else 0)
        after = int(spots[(k + 1) % count]) + (n if k == count - 1 else 0)
        rise = part(speed, before + 1, i)
        peak = before + 1 + int(rise.argmax()) if len(rise) else i
        braked = np.flatnonzero(part(brake, peak, i + 1) >= params.brake_on_fraction)
        limit = v + params.apex_fraction * prom
        back = _first(rise[::-1] > limit)
        ahead = part(speed, i + 1, after)
        on = _first(ahead > limit)
        a0, a1 = i - (len(rise) if back is None else back), i + 1 + (len(ahead) if on is None else on)
        pedal = np.flatnonzero(part(throttle, peak, a0 + 1) >= params.throttle_lift_pct)
        lift = min(peak + int(pedal[-1]) + 1 if len(pedal) else peak, a0)
        brake_on = peak + int(braked[0]) if len(braked) else None
        hit = _first(part(speed, a1, after) >= v + params.exit_recovery_fraction * prom)
        out.append({
            "event_id": k, "n": n, "i": i, "v": v, "prominence": prom, "left_max": peak, "lift": lift, "brake_on": brake_on,
            "brake_off": peak + int(braked[-1]) + 1 if len(braked) else None, "a0": a0, "a1": a1,
            "start": min(x for x in (lift, brake_on, a0) if x is not None), "hit": None if hit is None else a1 + hit,
        })
    for k, event in enumerate(out):
        turn = n if k == count - 1 else 0
        following = out[(k + 1) % count]
        reached = following["left_max"] + turn if event["hit"] is None else event["hit"]
        event["exit_end"] = max(min(reached, following["start"] + turn), event["a1"])
    return out


EVENT_FIELDS = "event_id long, n long, i long, v double, prominence double, left_max long, lift long, brake_on long, brake_off long, a0 long, a1 long, start long, exit_end long"


def traces_of(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Speed, brake (null: none) and throttle of a trace in order of its grid."""
    pdf = pdf.sort_values("grid_index")
    speed, brake, throttle = (pdf[c].to_numpy(float, na_value=np.nan) if c in pdf else np.full(len(pdf), np.nan) for c in ("speed", "brake", "throttle"))
    return speed, np.nan_to_num(brake, nan=0.0), throttle
