"""Fixed values of the ride jobs and the feed views. They must not be changed for equal results."""

from __future__ import annotations

# --- fixed values: box filter (degrees, all four tests strict) ---
BOX_SOUTH = 40.699
BOX_NORTH = 40.720
BOX_WEST = -74.747
BOX_EAST = -73.969

# --- fixed values: key prefix of the thinning job ---
DEBUG_PREFIX = "ab"

# --- fixed values: grid cell edge in degrees (about 500 m) ---
CELL_EDGE = 0.005

# --- fixed values: windows, sessions, lateness ---
SECOND_US = 1_000_000
MINUTE_US = 60 * SECOND_US
CLOCK_WINDOW_US = 1 * SECOND_US
COUNT_WINDOW_US = 1 * SECOND_US
RATE_WINDOW_US = 60 * SECOND_US
RATE_SLIDE_US = 3 * SECOND_US
TURNOVER_WINDOW_US = 1 * MINUTE_US
TURNOVER_LATENESS_US = 5 * MINUTE_US
LATEST_GAP_US = 60 * MINUTE_US
PICKUP_GAP_US = 1 * MINUTE_US
TURNOVER_EARLY_DELAY = "1 second"
PICKUP_EARLY_DELAY = "1 second"
LATEST_EARLY_DELAY = "2 seconds"

# --- fixed values: ride status words ---
STATUS_PICKUP = "pickup"
STATUS_DROPOFF = "dropoff"
STATUS_ENROUTE = "enroute"

# --- fixed values: pane labels ---
EARLY = "EARLY"
ON_TIME = "ON_TIME"
LATE = "LATE"
DROPPED = "DROPPED"

# --- fixed values: feed views (milliseconds, counts) ---
HEAD_WEIGHT = 5
TICK_MS = 250
FADEOUT_MS = 5000
GROUP_FADEOUT_MS = 5000
CULL_SHARE = 20
DUPLICATE_MEMORY_MS = 30_000
PULL_SIZE = 1000
HEALTH_BATCHES = 15
SATURATED_SHARE = 0.5
SILENT_AFTER_MS = 6000
BUNDLE_ROWS = 10_000
