"""Stage chains composed from the operators, and where their outputs live."""

from nearmiss.plans.incremental import update_report
from nearmiss.plans.stages import (
    crowded_pings,
    dense_pings,
    detect_encounters,
    extract_events,
    ingest,
    ingest_new_files,
    pair_tie_break,
    prepare_pings,
    run_pipeline,
    score_encounters,
    spread_pairs,
    zone_pings,
)
from nearmiss.plans.storage import materialize, run_dir, shared_dir

__all__ = [
    "crowded_pings", "dense_pings", "detect_encounters", "extract_events", "ingest", "ingest_new_files", "materialize",
    "pair_tie_break", "prepare_pings", "run_dir", "run_pipeline", "score_encounters", "shared_dir",
    "spread_pairs", "update_report", "zone_pings",
]
