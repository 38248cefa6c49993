"""DataFrame → DataFrame operators of the encounter analysis."""

from nearmiss.operators.events import (
    complete_events,
    event_targets,
    event_track_points,
    event_tracks,
    top_encounters,
    track_chunks,
    track_summary,
)
from nearmiss.operators.history import dense_slices, ping_history, with_changes
from nearmiss.operators.pairs import BLOCK_PAIR, close_pairs, closest_per_pair, crowded_cells, pair_blocks, with_time_bucket
from nearmiss.operators.quality import (
    exclude_named,
    moving_pings,
    pings_per_vessel,
    reliable_vessels,
)
from nearmiss.operators.report import incident_report, incident_summary
from nearmiss.operators.scoring import (
    REPORT_COLUMNS,
    SCORE_COMPONENTS,
    danger_score,
    encounter_report,
    report_order,
)
from nearmiss.operators.zone import geofence

__all__ = [
    "BLOCK_PAIR", "REPORT_COLUMNS", "SCORE_COMPONENTS", "close_pairs", "closest_per_pair",
    "complete_events", "crowded_cells", "danger_score", "dense_slices", "encounter_report", "event_targets",
    "event_track_points", "event_tracks", "exclude_named", "geofence", "incident_report",
    "incident_summary", "moving_pings", "pair_blocks", "ping_history", "pings_per_vessel",
    "reliable_vessels", "report_order", "top_encounters", "track_chunks", "track_summary",
    "with_changes", "with_time_bucket",
]
