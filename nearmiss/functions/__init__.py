"""Column-returning helpers (built-in Spark expressions only, no Python UDF)."""

from nearmiss.functions.display import event_key, severity, speed_band
from nearmiss.functions.geo import (
    GRID_CELL_FACTOR,
    grid_column,
    grid_columns,
    grid_reach_deg,
    grid_row,
    haversine_nm,
    lat_halfwidth_deg,
    lon_halfwidth_deg,
    zone_box,
)
from nearmiss.functions.motion import (
    course_change,
    epoch_seconds,
    speed_change,
    time_bucket,
    truncate_to_second,
)
from nearmiss.functions.scoring import (
    course_points,
    proximity_points,
    signal_points,
    speed_points,
    stale_penalty,
)

__all__ = [
    "GRID_CELL_FACTOR", "course_change", "course_points", "epoch_seconds", "event_key",
    "grid_column", "grid_columns", "grid_reach_deg", "grid_row", "haversine_nm", "lat_halfwidth_deg", "lon_halfwidth_deg",
    "proximity_points", "severity", "signal_points", "speed_band", "speed_change",
    "speed_points", "stale_penalty", "time_bucket", "truncate_to_second", "zone_box",
]
