"""Parameters of the encounter analysis.

Every operator takes its thresholds as keyword arguments; this module holds the
defaults in one place, and ``EncounterConfig`` bundles them for the stage chains.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values. These must equal the published analysis for identical results.
# ---------------------------------------------------------------------------
ZONE_CENTRE_LAT = 55.225
ZONE_CENTRE_LON = 14.245
ZONE_RADIUS_NM = 50.0
EARTH_RADIUS_NM = 3440.065
METRES_PER_NM = 1852.0
DENY_TOKENS = ("PILOT", "RESCUE", "SEARCH", "KBV")
MIN_PINGS = 10
MIN_SOG_KN = 2.0
MAX_SOG_KN = 45.0
BUCKET_SECONDS = 10
ENCOUNTER_NM = 0.054
TS_FORMAT = "dd/MM/yyyy HH:mm:ss"
REPORT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
EVENT_KEY_TS_FORMAT = "yyyyMMdd_HHmmss"
# danger score: proximity
NEAR_M = 20.0
NEAR_POINTS = 50
MID_M = 50.0
MID_POINTS = 30
FAR_POINTS = 10
# danger score: course change (only when both vessels make at least COURSE_MIN_SOG)
COURSE_MIN_SOG = 3.0
SHARP_TURN_DEG = 30.0
SHARP_TURN_POINTS = 40
TURN_DEG = 15.0
TURN_POINTS = 20
# danger score: speed change
SPEED_DROP_KN = -2.0
SPEED_DROP_POINTS = 30
SPEED_GAIN_KN = 2.0
SPEED_GAIN_POINTS = 15
# danger score: stale report of vessel A, lost signal of either vessel
STALE_S = 120
STALE_PENALTY = 30
LAST_SIGNAL_POINTS = 100
# event extraction
TOP_N = 5
HALF_WINDOW_MINUTES = 10
SEVERE_SCORE = 90
LEGEND_CHARS = 15
SEVERE_COLOUR = "red"
NORMAL_COLOUR = "purple"
# speed bands: upper edge (inclusive) -> colour; faster than the last edge is "green",
# a missing speed is "blue"
SPEED_BANDS = ((0.1, "blue"), (1.0, "red"), (5.0, "orange"), (12.0, "yellow"))
SPEED_BAND_ABOVE = "green"
SPEED_BAND_MISSING = "blue"
# ---------------------------------------------------------------------------

# Rows per hour-long slice of one vessel's history. Splitting a vessel's pings
# into time slices keeps a hot vessel id (shared or spoofed ids hold millions of
# pings) from landing in a single task; 0 or None means one window per vessel.
HISTORY_SLICE_SECONDS = 3600
# Pings of one vessel in one such slice beyond which the slice is cut further
# (``dense_slices``), and into how many parts.
DENSE_SLICE_PINGS = 500_000
DENSE_SLICE_PARTS = 64
# Pings of one grid cell and time bucket beyond which the cell is cut into
# quadrants (``crowded_cells``).
CROWDED_CELL_PINGS = 2_000
# Where pairs outnumber pings (``pair_blocks``): pairs that one task finds and orders (some
# hundred MB), and the fewest blocks of vessels, so that a day is work for several tasks.
PAIRS_PER_TASK = 1_000_000
MIN_PAIR_BLOCKS = 4
# Where no vessel has more pings in a group than the first, pairs aren't ordered, and
# blocks are made so that they hold about as many pings of a group as the second.
MAX_VISITS = 64
PINGS_PER_BLOCK = 1_000_000
# Length of the time cells that event windows are joined by (a window of the
# published half width), and points of one row of a long track.
EVENT_CELL_SECONDS = 2 * 60 * HALF_WINDOW_MINUTES
TRACK_CHUNK_POINTS = 10_000


@dataclass(frozen=True)
class ScoreWeights:
    near_m: float = NEAR_M
    near_points: int = NEAR_POINTS
    mid_m: float = MID_M
    mid_points: int = MID_POINTS
    far_points: int = FAR_POINTS
    course_min_sog: float = COURSE_MIN_SOG
    sharp_turn_deg: float = SHARP_TURN_DEG
    sharp_turn_points: int = SHARP_TURN_POINTS
    turn_deg: float = TURN_DEG
    turn_points: int = TURN_POINTS
    speed_drop_kn: float = SPEED_DROP_KN
    speed_drop_points: int = SPEED_DROP_POINTS
    speed_gain_kn: float = SPEED_GAIN_KN
    speed_gain_points: int = SPEED_GAIN_POINTS
    stale_s: int = STALE_S
    stale_penalty: int = STALE_PENALTY
    last_signal_points: int = LAST_SIGNAL_POINTS


@dataclass(frozen=True)
class EncounterConfig:
    """All stage parameters; ``replace(cfg, radius_nm=20)`` derives a variant."""

    centre_lat: float = ZONE_CENTRE_LAT
    centre_lon: float = ZONE_CENTRE_LON
    radius_nm: float = ZONE_RADIUS_NM
    earth_radius_nm: float = EARTH_RADIUS_NM
    deny_tokens: tuple[str, ...] = DENY_TOKENS
    keep_unnamed: bool = False
    min_pings: int = MIN_PINGS
    min_sog: float = MIN_SOG_KN
    max_sog: float = MAX_SOG_KN
    bucket_seconds: int = BUCKET_SECONDS
    # None: pings pair within the same tumbling bucket (as published); seconds:
    # pings pair when at most this far apart in time, whatever their bucket
    pair_tolerance_s: int | None = None
    dmax_nm: float = ENCOUNTER_NM
    group_key: str = "group_key"
    # grid cell side in pair distances (≥ 2): larger cells copy fewer pings
    # into neighbouring cells but compare more candidates per cell
    grid_cell_factor: float = 4.0
    order_by: tuple[str, ...] = ("ts", "lat", "lon", "sog", "cog")
    history_slice_seconds: int | None = HISTORY_SLICE_SECONDS
    # beyond these a slice of one vessel's history, or a grid cell, is cut further
    dense_slice_pings: int = DENSE_SLICE_PINGS
    crowded_cell_pings: int = CROWDED_CELL_PINGS
    weights: ScoreWeights = field(default_factory=ScoreWeights)
    top_n: int = TOP_N
    half_window_minutes: int = HALF_WINDOW_MINUTES
    ts_format: str = TS_FORMAT

    def with_(self, **changes) -> "EncounterConfig":
        return replace(self, **changes)
