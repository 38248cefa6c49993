"""Sources and sinks: AIS CSV, the Parquet ping lake, report CSV, test-table views."""

from nearmiss.sources.ais import (
    AIS_HEADERS,
    accepted,
    normalize_pings,
    parse_pings,
    read_pings_csv,
    rejected,
    rejected_pings,
)
from nearmiss.sources.driver_tables import (
    load_table,
    odd_ping_view,
    ping_view,
    raw_ping_text,
)
from nearmiss.sources.lake import (
    LAKE_PARTITIONS,
    compact_ping_lake,
    lake_files,
    read_ping_lake,
    with_calendar_parts,
    with_source,
    write_ping_lake,
)
from nearmiss.sources.reports import (
    REPORT_HEADERS,
    REPORT_SCHEMA,
    from_report_layout,
    read_report,
    rejected_report,
    to_report_layout,
    write_report,
)

__all__ = [
    "AIS_HEADERS", "LAKE_PARTITIONS", "REPORT_HEADERS", "REPORT_SCHEMA", "accepted",
    "compact_ping_lake", "from_report_layout", "lake_files", "load_table", "normalize_pings", "odd_ping_view", "parse_pings",
    "ping_view", "raw_ping_text", "read_ping_lake", "read_pings_csv", "read_report", "rejected",
    "rejected_pings", "rejected_report", "to_report_layout", "with_calendar_parts", "with_source",
    "write_ping_lake", "write_report",
]
