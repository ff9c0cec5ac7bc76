"""Key columns shared by every table, and the constants that carry meaning.

Every table holds many sessions at once, so the session columns are part of
every key, window, join and grouping.
"""

SESSION = ("season", "round", "session_code")
LAP = SESSION + ("driver", "lap_number")

# Grid spacing, channel lists and unit factors.
GRID_M = 10.0
CONTINUOUS = ("speed", "throttle", "rpm", "x", "y")
DISCRETE = ("n_gear", "brake", "drs")
MERGE_CAR_LINEAR = ("speed", "throttle", "rpm")
MERGE_POS_LINEAR = ("x", "y", "z")
KMH_PER_MS = 3.6
POSITION_UNITS_PER_M = 10.0

# Proven size bound of one session's distance axis: the grid contract allows
# indices 0..10000, so a session trace never holds more points than this.
MAX_GRID_INDEX = 10000
