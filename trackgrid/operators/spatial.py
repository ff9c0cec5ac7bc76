"""Reference lines, projection, registration of corner points, corner anchors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackgrid.functions.columns import clean, lerp, positions_to_metres
from trackgrid.functions.ordered import Axis, brackets, integrate, neighbours
from trackgrid.functions.quantiles import medians
from trackgrid.keys import GRID_M, LAP, SESSION
from trackgrid.operators import linesearch
from trackgrid.operators.celltree import CellTree, finite
from trackgrid.operators.metrics import flying_laps
from trackgrid.operators.series import TIME, enforce_monotonic, extend_axis_ends
from trackgrid.session import cut

# Line, projection, registration and anchor parameters.
LINE_SPACING_M = 2.0
LEAD_M = 60.0
HEADING_SPAN_M = 20.0
MIN_PATH_POINTS = 10
WINDOW_M = 150.0
MAX_PROJECTION_OFFSET_M = 10.0
ICP_ITERATIONS = 30
ICP_TOLERANCE_M = 1e-3
MAX_FRAME_RESIDUAL_M = 8.0
MIN_CORNERS = 3
MIN_CLOUD_POINTS = 100
MIN_ANCHORS = 8
MAX_ANCHOR_RESIDUAL_M = 50.0
MAX_SCALE_ERROR_PCT = 1.0
OFFICIAL_BAND_PCT = (-3.0, 0.2)

VERTEX = Axis(SESSION, "vertex", 512.0)
ARC = Axis(SESSION, "arc_m", 500.0)


# ---------------------------------------------------------------- reference line

def arc_length(path: DataFrame, axis: Axis = VERTEX) -> DataFrame:
    """Cumulative length at each vertex of a polyline."""
    return integrate(path, axis, ["x", "y"], lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"]), "arc_m")


def _heading(path: DataFrame, axis: Axis) -> DataFrame:
    """Per path its number of points, its first point and one HEADING_SPAN_M further on, or its last."""
    body = F.struct("vertex", "x", "y")
    return arc_length(path, axis).groupBy(*axis.keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(body).alias("a"), F.coalesce(F.min(F.when(F.col("arc_m") >= HEADING_SPAN_M, body)), F.max(body)).alias("b")
    )


def _line_fault() -> Column:
    span = F.hypot(F.col("b")["x"] - F.col("a")["x"], F.col("b")["y"] - F.col("a")["y"])
    return F.when(F.col("_n") < MIN_PATH_POINTS, F.lit("too few points for a reference line")).when(span == 0, F.lit("cannot take a heading from a zero-length span"))


def line_faults(path: DataFrame, axis: Axis = VERTEX) -> DataFrame:
    """Paths that give no reference line, with the reason."""
    return _heading(path, axis).select(*axis.keys, _line_fault().alias("reason")).filter(F.col("reason").isNotNull())


def lead_in(path: DataFrame, lead_m: float = LEAD_M, spacing: float = LINE_SPACING_M, axis: Axis = VERTEX) -> DataFrame:
    """The path continued straight backwards from its first vertex, which keeps number 0."""
    steps = max(2, int(round(lead_m / spacing)))
    ends = _heading(path, axis)
    dx, dy = F.col("b")["x"] - F.col("a")["x"], F.col("b")["y"] - F.col("a")["y"]
    norm = F.hypot(dx, dy)
    unit = F.when(norm == 0, F.raise_error(F.lit("cannot take a heading from a zero-length span")).cast("double")).otherwise(norm)
    k = ends.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    off = F.lit(lead_m) - F.col("_k") * F.lit(lead_m / steps)
    head = k.select(
        *axis.keys, (F.col("_k") - steps).cast("long").alias("vertex"), (F.col("a")["x"] - off * (dx / unit)).alias("x"), (F.col("a")["y"] - off * (dy / unit)).alias("y")
    )
    return head.unionByName(path.select(*axis.keys, F.col("vertex").cast("long").alias("vertex"), "x", "y"))


def reference_line(path: DataFrame, spacing: float = LINE_SPACING_M, lead_m: float = LEAD_M, axis: Axis = VERTEX) -> DataFrame:
    """One lap's path at uniform spacing with its lead-in; arc zero stays at the lap's own first sample."""
    keys = list(axis.keys)
    size = path.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    long_enough = F.when(F.col("_n") < MIN_PATH_POINTS, F.raise_error(F.lit("too few points for a reference line")).cast("boolean")).otherwise(F.lit(True))
    path = path.join(size.filter(long_enough).select(*keys), keys)
    # every step below reads its input several times, and each input is one lap per session
    whole = cut(arc_length(cut(lead_in(path, lead_m, spacing, axis), "path") if lead_m > 0 else path, axis), "path-arc")
    total = whole.groupBy(*keys).agg(F.max("arc_m").alias("_total"))
    total = total.withColumn("_points", F.greatest(F.lit(10), F.rint(F.col("_total") / spacing).cast("int") + 1)).withColumn("_sp", F.col("_total") / (F.col("_points") - 1))
    arc = Axis(axis.keys, "arc_m", 500.0)
    kept = whole.groupBy(*keys, "arc_m").agg(F.max(F.struct("vertex", "x", "y")).alias("_s")).select(*keys, "arc_m", "_s.x", "_s.y")
    seg = neighbours(kept, arc, ["arc_m", "x", "y"]).join(total, keys)
    lo = F.ceil(F.col("arc_m") / F.col("_sp"))
    hi = F.when(F.col("next").isNull(), F.col("_points") - 1).otherwise(F.least(F.ceil(F.col("next")["arc_m"] / F.col("_sp")) - 1, F.col("_points") - 2))
    lo = F.when(F.col("next").isNull(), F.col("_points") - 1).otherwise(lo)
    seg = seg.withColumn("_lo", lo.cast("long")).withColumn("_hi", hi.cast("long")).filter("_hi >= _lo")
    at = seg.withColumn("vertex", F.explode(F.sequence("_lo", "_hi")))
    target = F.col("vertex") * F.col("_sp")
    read = lambda c: F.when(F.col("next").isNull() | (target <= F.col("arc_m")), F.col(c)).otherwise(lerp(target, F.col("arc_m"), F.col(c), F.col("next")["arc_m"], F.col("next")[c]))
    at = cut(at.select(*keys, "vertex", read("x").alias("x"), read("y").alias("y")), "line-points")
    line = arc_length(at, Axis(axis.keys, "vertex", VERTEX.span))
    return line.withColumn("arc_m", F.col("arc_m") - F.lit(float(max(lead_m, 0.0))))


def line_lengths(line: DataFrame, keys: Sequence[str] = SESSION) -> DataFrame:
    return line.groupBy(*keys).agg(F.max("arc_m").alias("line_length_m"))


def line_seed(laps: DataFrame, merged: DataFrame) -> DataFrame:
    """Per session the lap whose path becomes the line: the fastest flying lap, or the first merged one.

    ``reference_line_lap`` names the fastest lap either way.
    """
    flying = flying_laps(laps)
    best = flying.groupBy(*SESSION).agg(F.min(F.struct("lap_time", "driver", "lap_number")).alias("_b"))
    have = merged.select(*LAP).distinct()
    first = have.groupBy(*SESSION).agg(F.min(F.struct("driver", "lap_number")).alias("_f"))
    named = best.select(*SESSION, F.struct(F.col("_b")["driver"].alias("driver"), F.col("_b")["lap_number"].alias("lap_number")).alias("_b"))
    hit = have.select(*SESSION, F.struct("driver", "lap_number").alias("_b"), F.lit(True).alias("_ok"))
    joined = named.join(hit, [*SESSION, "_b"], "left").join(first, list(SESSION))
    pick = F.when(F.col("_ok"), F.col("_b")).otherwise(F.col("_f"))
    label = F.concat(F.col("_b")["driver"], F.lit(" L"), F.col("_b")["lap_number"].cast("int").cast("string"))
    return joined.select(*SESSION, pick["driver"].alias("driver"), pick["lap_number"].alias("lap_number"), label.alias("reference_line_lap"))


def seed_path(merged: DataFrame, seeds: DataFrame, time: str = "session_time") -> DataFrame:
    """The seed laps' samples as paths; vertices are ordered by time."""
    rows = merged.join(seeds.select(*LAP), list(LAP), "left_semi")
    # one lap per session: its samples are numbered by their time in microseconds
    return rows.select(*SESSION, F.rint(F.col(time) * 1e6).cast("long").alias("_us"), "x", "y").join(
        rows.groupBy(*SESSION).agg(F.min(F.rint(F.col(time) * 1e6).cast("long")).alias("_us0")), list(SESSION)
    ).select(*SESSION, (F.col("_us") - F.col("_us0")).alias("vertex"), "x", "y")


PATH = Axis(SESSION, "vertex", 60e6)


# ---------------------------------------------------------------- nearest neighbour

def nearest(points: DataFrame, cloud: DataFrame, keys: Sequence[str], ids: Sequence[str], tie: str, few: bool = False) -> DataFrame:
    """Nearest cloud point of the same key for every point (px, py); ties go to the lowest ``tie`` (see celltree)."""
    return CellTree(cloud, keys, tie).nearest(points, ids, few)


# ---------------------------------------------------------------- projection

def without_line(samples: DataFrame, line: DataFrame) -> DataFrame:
    """Laps of sessions that have no line, with the reason."""
    return samples.select(*LAP).distinct().join(line.select(*SESSION).distinct(), list(SESSION), "left_anti").withColumn("reason", F.lit("no reference line"))


def ordered_nearest(samples: DataFrame, line: DataFrame, window_m: float = WINDOW_M, seed_span_m: float = LEAD_M, time: str = "session_time") -> DataFrame:
    """Nearest line vertex per sample, searched within a reach that moves forward along the lap (see linesearch)."""
    return linesearch.ordered_nearest(samples, line, window_m, seed_span_m + window_m, time, TIME.span)


def project_on_segments(nearest_vertex: DataFrame, line: DataFrame, point: Sequence[str] = ("x", "y"), keys: Sequence[str] = SESSION) -> DataFrame:
    """Foot of each point on the two segments next to its nearest vertex; the closer one counts.

    ``nearest_vertex`` carries the point and ``vertex``; adds distance_aligned and line_offset_m.
    """
    keys = list(keys)
    me = line.select(*keys, "vertex", F.struct("x", "y", "arc_m").alias("_c"))
    before = line.select(*keys, (F.col("vertex") + 1).alias("vertex"), F.struct("x", "y", "arc_m").alias("_a"))
    after = line.select(*keys, (F.col("vertex") - 1).alias("vertex"), F.struct("x", "y", "arc_m").alias("_b"))
    around = me.join(before, [*keys, "vertex"], "left").join(after, [*keys, "vertex"], "left")
    df = nearest_vertex.join(around, [*keys, "vertex"])
    px, py = (F.col(c).cast("double") for c in point)

    def foot(s: Column, e: Column) -> Column:
        vx, vy = e["x"] - s["x"], e["y"] - s["y"]
        length = vx * vx + vy * vy
        t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - s["x"]) * vx + (py - s["y"]) * vy) / F.nullif(length, F.lit(0.0))))
        off = F.hypot(px - (s["x"] + t * vx), py - (s["y"] + t * vy))
        return F.when(s.isNotNull() & e.isNotNull() & (length > 0), F.struct(off.alias("off"), (s["arc_m"] + t * (e["arc_m"] - s["arc_m"])).alias("d")))

    left, right = foot(F.col("_a"), F.col("_c")), foot(F.col("_c"), F.col("_b"))
    df = df.withColumn("_l", left).withColumn("_r", right)
    best = F.when(F.col("_l").isNull(), F.col("_r")).when(F.col("_r").isNotNull() & (F.col("_r")["off"] < F.col("_l")["off"]), F.col("_r")).otherwise(F.col("_l"))
    df = df.withColumn("_best", best)
    return df.withColumn("distance_aligned", F.coalesce(F.col("_best")["d"], F.col("_c")["arc_m"])).withColumn("line_offset_m", F.col("_best")["off"]).drop("_a", "_b", "_c", "_l", "_r", "_best", "vertex")


def project_laps(samples: DataFrame, line: DataFrame, time: str = "session_time", axis: Axis = TIME) -> DataFrame:
    """Distance along the line for every sample: ordered search, projection, monotonic guard, extended ends."""
    where = ordered_nearest(samples, line, time=time)
    placed = cut(project_on_segments(samples.join(where, [*LAP, time]), line), "projected-raw")
    guarded = cut(enforce_monotonic(placed, axis).drop("corrected"), "projected-guarded")
    return extend_axis_ends(guarded, line_lengths(line))


def misprojected(samples: DataFrame, limit: float = MAX_PROJECTION_OFFSET_M, keys: Sequence[str] = LAP) -> DataFrame:
    return samples.groupBy(*keys).agg(F.count_if(F.col("line_offset_m") > limit).alias("misprojected"))


# ---------------------------------------------------------------- registration

def first_laps(samples: DataFrame, n: int | None = None) -> DataFrame:
    """The samples of each session's first n laps in key order, of all laps if none is given."""
    if n is None:
        return samples
    # the limit on the rank lets Spark drop the other laps before they are shuffled
    order = Window.partitionBy(*SESSION).orderBy("driver", "lap_number")
    chosen = samples.select(*LAP).distinct().withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")
    return samples.join(chosen, list(LAP), "left_semi")


def split_corners(corners: DataFrame) -> DataFrame:
    """Odd corner numbers anchor, even ones validate."""
    return corners.filter(F.col("number").isNotNull()).withColumn("anchor", F.col("number") % 2 == 1)


def fit_frame(corners: DataFrame, cloud: DataFrame, iterations: int = ICP_ITERATIONS, tolerance: float = ICP_TOLERANCE_M, max_residual: float = MAX_FRAME_RESIDUAL_M) -> DataFrame:
    """Rotation and translation that bring corner points onto the driven points, for all sessions together.

    Each round matches every corner with its nearest point, moves the corners
    rigidly onto their matches, and stops a session once its median residual
    settles. Corners are few, so the state between rounds is small; it is
    written each round to keep the plan short.

    ``corners``: session, number, x, y in metres. ``cloud``: session, tie column ``pid``, x, y.
    One row per session with rotation_rad, tx, ty, median_residual_m, iterations and the
    reason a session has no frame (null when it has one).
    """
    keys = list(SESSION)
    cloud = cut(cloud.select(*keys, "pid", "x", "y"), "icp-cloud")
    sizes = corners.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nc")).join(cloud.groupBy(*keys).agg(F.count(F.lit(1)).alias("_np")), keys, "left")
    sizes = sizes.withColumn(
        "reason",
        F.when(F.col("_nc") < MIN_CORNERS, F.lit("fewer than 3 corners")).when(F.coalesce(F.col("_np"), F.lit(0)) < MIN_CLOUD_POINTS, F.lit("path too sparse to fit against")),
    )
    usable = sizes.filter("reason IS NULL").select(*keys)
    tree = CellTree(cloud.join(usable, keys, "left_semi"), keys, "pid")

    def match(state: DataFrame) -> DataFrame:
        pts = state.select(*keys, "corner_id", F.col("cx").alias("px"), F.col("cy").alias("py"))
        return tree.nearest(pts, ["corner_id"], few=True).select(*keys, "corner_id", F.col("nx").alias("mx"), F.col("ny").alias("my"), F.sqrt("d2").alias("gap"))

    start = corners.join(usable, keys, "left_semi").select(
        *keys, F.xxhash64("number", F.coalesce(F.col("letter"), F.lit("")) if "letter" in corners.columns else F.lit("")).alias("corner_id"),
        F.col("x").cast("double").alias("ox"), F.col("y").cast("double").alias("oy"),
    ).withColumn("cx", F.col("ox")).withColumn("cy", F.col("oy"))
    state = start.join(match(start), [*keys, "corner_id"]).withColumn("residual", F.lit(float("inf"))).withColumn("used", F.lit(0)).withColumn("settled", F.lit(False))
    state = cut(state, "icp")
    for _ in range(iterations):
        turn = _rigid(state, "cx", "cy", "mx", "my")
        c, s = F.cos("_a"), F.sin("_a")
        active = ~F.col("settled")
        moved = state.join(turn, keys).withColumns({
            "cx": F.when(active, c * F.col("cx") - s * F.col("cy") + F.col("_tx")).otherwise(F.col("cx")),
            "cy": F.when(active, s * F.col("cx") + c * F.col("cy") + F.col("_ty")).otherwise(F.col("cy")),
            "used": F.col("used") + active.cast("int"),
        }).drop("_a", "_tx", "_ty", "mx", "my", "gap")
        moved = cut(moved.join(match(moved), [*keys, "corner_id"]), "icp")
        now = moved.groupBy(*keys).agg(F.percentile("gap", F.lit(0.5)).alias("_now"))
        state = moved.join(now, keys).withColumn("settled", F.col("settled") | (F.abs(F.col("residual") - F.col("_now")) < tolerance)).withColumn("residual", F.col("_now")).drop("_now")
        if not state.filter("NOT settled").take(1):
            break
    total = _rigid(state, "ox", "oy", "cx", "cy").join(
        state.groupBy(*keys).agg(F.percentile("gap", F.lit(0.5)).alias("median_residual_m"), F.max("used").alias("iterations")), keys
    )
    out = sizes.select(*keys, "reason").join(total, keys, "left")
    late = F.when(F.col("median_residual_m") > max_residual, F.format_string("no rigid transform: median residual %.2f m", "median_residual_m"))
    return out.select(*keys, F.col("_a").alias("rotation_rad"), F.col("_tx").alias("tx"), F.col("_ty").alias("ty"), "median_residual_m", "iterations", F.coalesce("reason", late).alias("reason"))


def _rigid(df: DataFrame, x: str, y: str, mx: str, my: str) -> DataFrame:
    """Least-squares rotation and translation per session, from sums of products."""
    a, b, p, q = (F.col(c) for c in (x, y, mx, my))
    sums = df.groupBy(*SESSION).agg(
        F.avg(a).alias("_x"), F.avg(b).alias("_y"), F.avg(p).alias("_p"), F.avg(q).alias("_q"),
        F.avg(a * q - b * p).alias("_cross"), F.avg(a * p + b * q).alias("_dot"),
    )
    cross = F.col("_cross") - (F.col("_x") * F.col("_q") - F.col("_y") * F.col("_p"))
    dot = F.col("_dot") - (F.col("_x") * F.col("_p") + F.col("_y") * F.col("_q"))
    sums = sums.withColumn("_a", F.atan2(cross, dot))
    c, s = F.cos("_a"), F.sin("_a")
    return sums.select(*SESSION, "_a", (F.col("_p") - (c * F.col("_x") - s * F.col("_y"))).alias("_tx"), (F.col("_q") - (s * F.col("_x") + c * F.col("_y"))).alias("_ty"))


def apply_frame(df: DataFrame, frame: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Points rotated and shifted by their session's frame."""
    c, s = F.cos("rotation_rad"), F.sin("rotation_rad")
    moved = df.join(frame.select(*SESSION, "rotation_rad", "tx", "ty"), list(SESSION))
    return moved.withColumns({x: c * F.col(x) - s * F.col(y) + F.col("tx"), y: s * F.col(x) + c * F.col(y) + F.col("ty")}).drop("rotation_rad", "tx", "ty")


def calibrate(corners: DataFrame, merged: DataFrame, time: str = "session_time", laps: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(corners in the telemetry's frame, the frames). Fitted on anchor corners only, against all laps or the first few."""
    cloud = first_laps(merged, laps).select(*SESSION, F.struct("driver", "lap_number", time).alias("pid"), "x", "y")
    frame = fit_frame(split_corners(corners).filter("anchor"), cloud)
    return apply_frame(corners, frame.filter("reason IS NULL")), frame


def track_reference(corners: DataFrame, layouts: DataFrame, numbers: Sequence[int] | None = None) -> DataFrame:
    """Corners in metres with their session's official length; a session with fewer than two is an error."""
    out = positions_to_metres(corners).join(layouts.select(*SESSION, "length_m"), list(SESSION))
    few = out.groupBy(*SESSION).agg(F.count(F.lit(1)).alias("_n"))
    enough = F.when(F.col("_n") < 2, F.raise_error(F.lit("track reference needs at least 2 corners")).cast("boolean")).otherwise(F.lit(True))
    out = out.join(few.filter(enough).drop("_n"), list(SESSION))
    return out if numbers is None else out.filter(F.col("number").isin(list(numbers)))


# ---------------------------------------------------------------- corners against laps

def measure_registration(samples: DataFrame, corners: DataFrame, column: str, time: str = "session_time") -> DataFrame:
    """Where each lap's closest sample to each corner lies on an axis, against the corner's own distance."""
    wanted = samples.select(*LAP).distinct().join(corners.select(*SESSION, "number", F.col("distance").alias("d_ref"), F.col("x").alias("px"), F.col("y").alias("py")), list(SESSION))
    cloud = samples.withColumn("_at", F.struct(F.col(time), F.col(column).cast("double").alias("v")))
    hit = nearest(wanted, cloud, LAP, ["number", "d_ref"], "_at")
    seen = F.col("idx")["v"]
    return hit.select(
        *LAP, F.col("number").alias("corner_number"), "d_ref", seen.alias("observed"), (seen - F.col("d_ref")).alias("error_m"), F.sqrt("d2").alias("xy_residual_m")
    )


def registration_summary(observed: DataFrame) -> DataFrame:
    """Per corner: how far apart the laps place it."""
    return observed.groupBy(*SESSION, "corner_number").agg(
        F.count(F.lit(1)).alias("n_laps"), F.max(F.abs("error_m")).alias("max_abs_error_m"),
        (F.max("observed") - F.min("observed")).alias("spread_m"), F.stddev_pop("observed").alias("std_m"),
    )


def corner_positions(grid: DataFrame, corners: DataFrame, frame: DataFrame, reference_lap: DataFrame) -> DataFrame:
    """Corners (source units) moved into the frame and snapped to the reference lap's nearest grid point."""
    placed = apply_frame(positions_to_metres(corners), frame)
    pts = placed.select(*SESSION, "number", F.coalesce("letter", F.lit("")).alias("letter"), F.col("distance").cast("double").alias("raw_distance_m"), F.col("x").alias("px"), F.col("y").alias("py"))
    ref = grid.join(reference_lap.select(*LAP), list(LAP), "left_semi").select(*SESSION, "grid_index", "x", "y")
    hit = nearest(pts, ref, SESSION, ["number", "letter", "raw_distance_m"], "grid_index", few=True)
    return hit.select(*SESSION, "number", "letter", (F.col("idx") * F.lit(GRID_M)).alias("distance_m"), F.sqrt("d2").alias("line_offset_m"), "raw_distance_m")





def locate_anchors(samples: DataFrame, corners: DataFrame, max_residual: float = MAX_ANCHOR_RESIDUAL_M, time: str = "session_time") -> DataFrame:
    """Closest approach to each corner in track order, always after the last accepted one.

    A round finds the nearest sample after the lap's cursor for corners a lap still
    has to place. Walking the corners in order, a match that also lies after the
    cursor as it then stands is the match a step-by-step search would make; the
    walk stops at the first that does not. The next round keeps the matches after
    the new cursor, which are still the nearest, and searches the others again.
    Most laps take one round. A lap's samples lie in chunks of its time, a row
    each; a chunk answers for all corners, so a corner's answer moves and not the samples.
    """
    keys = list(LAP)
    axis = Axis(LAP, time, TIME.span)
    ranked = corners.select(
        *SESSION, "number", F.col("distance").cast("double").alias("d_ref"), F.col("x").cast("double").alias("px"), F.col("y").cast("double").alias("py"),
        (F.row_number().over(Window.partitionBy(*SESSION).orderBy("distance", "number")) - 1).alias("pos"),
    )
    asked = cut(ranked.filter(finite("px", "py")).groupBy(*SESSION).agg(F.collect_list(F.struct("pos", "number", "d_ref", "px", "py")).alias("ask")), "anchor-corners")
    base = neighbours(samples.select(*keys, time, "x", "y", "distance_raw"), axis, ["x", "y", "distance_raw"])
    for c in (*keys, time):
        base = base.filter(F.col(c).isNotNull())
    base = base.filter(finite("x", "y")).join(F.broadcast(asked.select(*SESSION)), list(SESSION), "left_semi")
    sample = F.struct(F.col(time).alias("t"), "distance_raw", "prev", "next", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    chunks = cut(axis.cut(base).groupBy(*axis.chunk_keys).agg(F.array_sort(F.collect_list(sample)).alias("_path")), "anchor-samples")
    never = F.lit(float("-inf"))
    walk = laps = kept = out = None
    while True:
        if walk is None:
            near = chunks.join(F.broadcast(asked), list(SESSION))
        else:
            near = chunks.join(laps.select(*keys, "cursor", "ask"), keys).withColumn("_path", F.filter("_path", lambda s: s["t"] > F.col("cursor")))
        hit = near.select(*keys, F.inline(F.transform("ask", lambda c: F.struct(c.alias("c"), _closest(F.col("_path"), c).alias("m")))))
        hit = hit.filter(F.col("m").isNotNull()).groupBy(*keys, "c").agg(F.min("m").alias("m"))
        seen = hit.groupBy(*keys).agg(F.collect_list(F.struct(
            "c.pos", "c.number", "m.t", "m.d_raw", "c.d_ref", "m.residual_m", "c.px", "c.py",
        )).alias("ms"))
        if walk is None:
            seen = seen.withColumns({"cursor": never, "last_d": F.lit(None).cast("double"), "done": F.lit(-1)})
        else:
            # a lap whose corners have no later sample still walks the matches that it kept
            seen = laps.select(*keys, "cursor", "last_d", "done", "kept").join(seen, keys, "left")
            seen = seen.withColumn("ms", F.concat("kept", F.coalesce("ms", F.array().cast(kept)))).drop("kept")
        seen = seen.withColumn("ms", F.array_sort("ms"))
        walk = cut(seen.withColumn("w", _walk(F.col("ms"), max_residual)), "anchor-round")
        kept = dict(walk.dtypes)["ms"]
        found = walk.select(*keys, F.explode("w.accepted").alias("a")).select(*keys, F.col("a.number").alias("corner_number"), F.col("a.t").alias(time), "a.d_raw", "a.d_ref", "a.residual_m")
        out = found if out is None else out.unionByName(found)
        rest = F.filter("ms", lambda m: m["pos"] > F.col("w.done"))
        laps = walk.filter(F.col("w.stopped")).select(
            *keys, F.col("w.cursor").alias("cursor"), F.col("w.last_d").alias("last_d"), F.col("w.done").alias("done"),
            F.filter(rest, lambda m: m["t"] > F.col("w.cursor")).alias("kept"),
            F.transform(F.filter(rest, lambda m: m["t"] <= F.col("w.cursor")), lambda m: F.struct(*[m[c].alias(c) for c in ("pos", "number", "d_ref", "px", "py")])).alias("ask"),
        )
        if not laps.take(1):
            return out


def _closest(path: Column, corner: Column) -> Column:
    """The sample of a sorted path nearest to a corner, ties to the earliest: squared distance, time, and the corner's foot there."""
    px, py = corner["px"], corner["py"]
    gap = lambda s: (px - s["x"]) * (px - s["x"]) + (py - s["y"]) * (py - s["y"])
    nearest_of = F.transform(F.array(F.transform(path, gap)), lambda g: F.element_at(path, F.array_position(g, F.array_min(g)).cast("int")))
    feet = F.transform(nearest_of, lambda s: F.when(s.isNotNull(), F.struct(gap(s).alias("d2"), s["t"].alias("t"), *_placed(s, px, py))))
    return feet[0]


def _placed(s: Column, px: Column, py: Column) -> tuple[Column, Column]:
    res, d = _anchor_foot(s, px, py, s["x"], s["y"])
    return d.alias("d_raw"), res.alias("residual_m")


def _anchor_foot(sample: Column, px: Column, py: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Perpendicular residual and raw distance of a corner on the path segments next to a sample."""

    def foot(ax, ay, ad, bx, by, bd):
        vx, vy = bx - ax, by - ay
        length = vx * vx + vy * vy
        t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - ax) * vx + (py - ay) * vy) / F.nullif(length, F.lit(0.0))))
        return F.when(length > 0, F.struct(F.hypot(px - (ax + t * vx), py - (ay + t * vy)).alias("r"), (ad + t * (bd - ad)).alias("d")))

    p, n, d = sample["prev"], sample["next"], sample["distance_raw"]
    left, right = foot(p["x"], p["y"], p["distance_raw"], x, y, d), foot(x, y, d, n["x"], n["y"], n["distance_raw"])
    best = F.when(left.isNull(), right).when(right.isNotNull() & (right["r"] < left["r"]), right).otherwise(left)
    return F.coalesce(best["r"], F.lit(float("inf"))), F.coalesce(best["d"], d)


def _walk(matches: Column, max_residual: float) -> Column:
    """Fold one lap's matches, in track order, until one needs a new search."""
    item = "struct<pos:int,number:int,t:double,d_raw:double,d_ref:double,residual_m:double>"
    start = F.struct(
        F.col("cursor").alias("cursor"), F.col("last_d").alias("last_d"), F.col("done").alias("done"), F.lit(False).alias("stopped"),
        F.array().cast(f"array<{item}>").alias("accepted"),
    )

    def step(s: Column, m: Column) -> Column:
        stale = m["t"] <= s["cursor"]
        refuse = (m["residual_m"] > max_residual) | (s["last_d"].isNotNull() & (m["d_raw"] <= s["last_d"]))
        halt = s["stopped"] | stale
        take = ~halt & ~refuse
        one = F.array(F.struct(
            m["pos"].cast("int").alias("pos"), m["number"].cast("int").alias("number"), m["t"].cast("double").alias("t"),
            m["d_raw"].alias("d_raw"), m["d_ref"].alias("d_ref"), m["residual_m"].alias("residual_m"),
        ))
        return F.struct(
            F.when(take, m["t"]).otherwise(s["cursor"]).alias("cursor"), F.when(take, m["d_raw"]).otherwise(s["last_d"]).alias("last_d"),
            F.when(halt, s["done"]).otherwise(m["pos"].cast("int")).alias("done"), halt.alias("stopped"),
            F.when(take, F.concat(s["accepted"], one)).otherwise(s["accepted"]).alias("accepted"),
        )

    return F.aggregate(matches, start, step)


def map_distance(samples: DataFrame, anchors: DataFrame, raw: str = "distance_raw") -> DataFrame:
    """Piecewise-linear map of raw distance through the anchors, with the end segments' scale beyond them."""
    axis = Axis(LAP, raw, 500.0)
    order = Window.partitionBy(*LAP).orderBy("d_raw")
    a = anchors.select(*LAP, "d_raw", "d_ref")
    up = (F.lead("d_ref").over(order) - F.col("d_ref")) / (F.lead("d_raw").over(order) - F.col("d_raw"))
    down = (F.col("d_ref") - F.lag("d_ref").over(order)) / (F.col("d_raw") - F.lag("d_raw").over(order))
    marks = a.withColumn("_m", F.struct(F.col("d_raw").alias("r"), F.col("d_ref").alias("f"), up.alias("up"), down.alias("down"))).select(*LAP, F.col("d_raw").alias(raw), "_m")
    rows = samples.select(*LAP, raw, F.struct(*[c for c in samples.columns if c not in LAP]).alias("_row"))
    both = brackets(axis.cut(rows.unionByName(marks, allowMissingColumns=True)), axis, ["_m"]).filter(F.col("_row").isNotNull())
    p, n, x = F.col("_m_prev"), F.col("_m_next"), F.col(raw)
    value = (
        F.when(p.isNull(), n["f"] + (x - n["r"]) * n["up"])
        .when(n.isNull(), p["f"] + (x - p["r"]) * p["down"])
        .when(p["r"] == n["r"], p["f"])
        .otherwise(lerp(x, p["r"], p["f"], n["r"], n["f"]))
    )
    return both.select(*LAP, "_row.*", value.alias("distance_aligned"))


def align_with_anchors(samples: DataFrame, anchors: DataFrame, corners_per_lap: int | None = None, min_anchors: int = MIN_ANCHORS, time: str = "session_time") -> tuple[DataFrame, DataFrame]:
    """(aligned samples, rejected laps with the reason)."""
    laps = samples.select(*LAP).distinct()
    count = laps.join(anchors.groupBy(*LAP).agg(F.count(F.lit(1)).alias("_n")), list(LAP), "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    of = F.lit("") if corners_per_lap is None else F.lit(f" of {corners_per_lap} corners")
    few = count.filter(F.col("_n") < min_anchors).select(
        *LAP, F.concat(F.lit("only "), F.col("_n").cast("string"), F.lit(" usable anchor(s)"), of, F.lit(f", minimum is {min_anchors}")).alias("reason")
    )
    mapped = map_distance(samples.join(few, list(LAP), "left_anti"), anchors)
    steps = neighbours(mapped.select(*LAP, time, "distance_aligned"), Axis(LAP, time, TIME.span), ["distance_aligned"])
    back = steps.groupBy(*LAP).agg(F.count_if(F.col("distance_aligned") <= F.col("prev")["distance_aligned"]).alias("_b")).filter("_b > 0")
    flat = back.select(*LAP, F.lit("aligned distance is not strictly increasing").alias("reason"))
    return mapped.join(flat, list(LAP), "left_anti"), few.unionByName(flat)


def length_checks(aligned: DataFrame, official: DataFrame, time: str = "session_time") -> DataFrame:
    """Median aligned length against median driven length and the official one (official_m per session)."""
    laps = aligned.groupBy(*LAP).agg(
        (F.max_by("distance_aligned", time) - F.min_by("distance_aligned", time)).alias("_a"), F.max_by("distance_raw", time).alias("_r")
    )
    both = medians(laps, SESSION, {"aligned_m": "_a", "driven_m": "_r"}).join(official, list(SESSION))
    scale = 100.0 * F.abs(F.col("aligned_m") - F.col("driven_m")) / F.col("driven_m")
    off = 100.0 * (F.col("aligned_m") - F.col("official_m")) / F.col("official_m")
    return both.select(
        *SESSION, "aligned_m", "driven_m", "official_m", scale.alias("scale_error_pct"), off.alias("official_error_pct"),
        (scale <= MAX_SCALE_ERROR_PCT).alias("scale_ok"), within_official_band(F.col("aligned_m"), F.col("official_m")).alias("official_ok"),
    )


def within_official_band(measured: Column, official: Column) -> Column:
    pct = (measured - official) / official * 100.0
    return pct.between(*OFFICIAL_BAND_PCT)
