"""The analysis as stage chains: ingest → zone → encounters → events → report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearmiss.config import EncounterConfig
from nearmiss.operators import (
    close_pairs,
    closest_per_pair,
    crowded_cells,
    complete_events,
    danger_score,
    dense_slices,
    encounter_report,
    event_targets,
    event_track_points,
    event_tracks,
    exclude_named,
    geofence,
    incident_report,
    incident_summary,
    moving_pings,
    pair_blocks,
    ping_history,
    reliable_vessels,
    report_order,
    top_encounters,
    with_time_bucket,
)
from nearmiss.plans.storage import if_any, materialize, run_dir
from nearmiss.sources import (
    accepted,
    batches,
    parse_pings,
    read_ping_lake,
    read_pings_csv,
    rejected,
    with_source,
    write_ping_lake,
)


def _tie_columns(order_by) -> tuple[str, ...]:
    # Pings equal in all of ``order_by`` (exact duplicates are normal in AIS) can
    # still differ in what the history made of them, so that comes last.
    return (*order_by, "interval_s", "delta_sog", "delta_cog", "is_last_signal")


def pair_tie_break(order_by) -> tuple[str, ...]:
    """Tie-break of a pair's candidate moments, derived from the ping order."""
    names = _tie_columns(order_by)
    return tuple(f"{c}_a" for c in names) + tuple(f"{c}_b" for c in names)


def ingest(spark: SparkSession, csv_path, lake_path: str, *,
           rejected_path: str | None = None, cfg: EncounterConfig = EncounterConfig(),
           schema=None, mode: str = "append", replace_days=None) -> None:
    """CSV files → day-partitioned Parquet lake (+ rejected rows with reasons).

    By default a drop is added to the lake and its rejects to the rejects, so
    late pings of earlier days lose nothing. ``mode="overwrite"`` starts both
    anew; ``replace_days`` re-ingests just those days of the lake (and adds the
    rejects). The CSV is parsed once: with ``rejected_path`` the parsed rows are
    written to the shared folder and both outputs read them from there.
    """
    raw = read_pings_csv(spark, csv_path, schema)
    parsed = parse_pings(raw, cfg.ts_format)
    if rejected_path:
        parsed = materialize(parsed, f"{run_dir(spark, 'ingest')}/parsed")
        rejected(parsed, raw.columns).write.mode(mode).parquet(rejected_path)
    write_ping_lake(accepted(parsed), lake_path, mode, replace_days=replace_days)


def ingest_new_files(spark: SparkSession, csv_path, lake_path: str, journal_path: str, *,
                     rejected_path: str | None = None, **options) -> list[str]:
    """``ingest`` of the CSV files that no earlier call has ingested; returns them.

    Each file's rows enter the lake exactly once, also when a call breaks off at any point and is
    repeated: the new files are one batch (``sources.batches``), written aside and committed by
    one record, which also enters their names in the journal at ``journal_path``. What is new is
    found by an anti-join with the journal; only new names reach the driver. A call
    first finishes what an earlier one has committed. One call at a time for a lake.
    """
    batches.finish(spark, lake_path)
    files = batches.new_inputs(spark, csv_path, journal_path)
    if files:
        name, folder = batches.stage(lake_path)
        bad = f"{folder}/rejected" if rejected_path else None
        ingest(spark, files, f"{folder}/lake", rejected_path=bad, mode="overwrite", **options)
        into = {"lake": lake_path} | ({"rejected": rejected_path} if rejected_path else {})
        batches.commit(spark, lake_path, name, into=into, inputs=files, journal=journal_path)
        batches.finish(spark, lake_path)
    return files


# The columns that the zone table keeps of a ping, where they are there.
ZONE_COLUMNS = (
    "ts", "mmsi", "vessel_id", "lat", "lon", "nav_status", "rot", "sog", "cog", "heading", "imo",
    "callsign", "name", "ship_type", "cargo_type", "width", "length", "source_file",
)


def zone_pings(pings: DataFrame, cfg: EncounterConfig = EncounterConfig(), *,
               lineage: bool = False, keep=()) -> DataFrame:
    """Pings inside the zone, with ``group_key`` = the ping's date (pairs are
    formed within a day). ``lineage`` adds ``source_file`` (file-read input).

    Only ``ZONE_COLUMNS``, the columns that order and group pings and those
    named in ``keep`` are kept; no other column is read from the lake or written
    to the zone table."""
    out = geofence(pings, cfg.centre_lat, cfg.centre_lon, cfg.radius_nm,
                   earth_radius_nm=cfg.earth_radius_nm)
    if "group_key" not in out.columns:
        out = out.withColumn("group_key", F.to_date("ts"))
    if lineage:
        out = with_source(out)
    kept = dict.fromkeys((*ZONE_COLUMNS, "group_key", cfg.group_key, *cfg.order_by, *keep))
    return out.select(*[c for c in kept if c in out.columns])


def prepare_pings(pings: DataFrame, cfg: EncounterConfig = EncounterConfig(), *,
                  keep=(), dense: DataFrame | None = None) -> DataFrame:
    """In-zone pings → the pings that may pair: deny list, history, reliable
    vessels, moving pings, time bucket.

    Only the columns that later stages read (and ``keep``) go through the
    history's shuffle, the largest of the chain.

    Order matters and follows the analysis: the deny list applies before the
    history; history and the ping count are taken before the speed filter, so
    slow pings still count and still feed the previous-ping values. ``dense``
    (``dense_pings`` as a table) cuts the history of very frequent senders finer.
    """
    named = exclude_named(pings, cfg.deny_tokens, keep_null=cfg.keep_unnamed)
    needed = dict.fromkeys(("vessel_id", "ts", "lat", "lon", "sog", "cog", cfg.group_key,
                            *cfg.order_by, *keep))
    hist = ping_history(named.select(*needed), cfg.order_by, slice_seconds=cfg.history_slice_seconds,
                        dense=dense)
    moving = moving_pings(reliable_vessels(hist, cfg.min_pings), cfg.min_sog, cfg.max_sog)
    return with_time_bucket(moving, cfg.bucket_seconds)


def dense_pings(pings: DataFrame, cfg: EncounterConfig = EncounterConfig()) -> DataFrame:
    """``dense_slices`` of in-zone pings, as ``prepare_pings`` takes it."""
    named = exclude_named(pings, cfg.deny_tokens, keep_null=cfg.keep_unnamed)
    return dense_slices(named, slice_seconds=cfg.history_slice_seconds, max_pings=cfg.dense_slice_pings)


def crowded_pings(prepared: DataFrame, cfg: EncounterConfig = EncounterConfig()) -> DataFrame:
    """``crowded_cells`` of prepared pings, as ``score_encounters`` takes it."""
    return crowded_cells(prepared, cfg.dmax_nm, group_key=cfg.group_key, cell_factor=cfg.grid_cell_factor,
                         tolerance_s=cfg.pair_tolerance_s, earth_radius_nm=cfg.earth_radius_nm,
                         max_pings=cfg.crowded_cell_pings)


def spread_pairs(prepared: DataFrame, cfg: EncounterConfig = EncounterConfig()):
    """``pair_blocks`` of prepared pings, as ``score_encounters`` takes it."""
    return pair_blocks(prepared, cfg.dmax_nm, group_key=cfg.group_key, cell_factor=cfg.grid_cell_factor,
                       tolerance_s=cfg.pair_tolerance_s, earth_radius_nm=cfg.earth_radius_nm,
                       order_by=_tie_columns(cfg.order_by))


def score_encounters(prepared: DataFrame, cfg: EncounterConfig = EncounterConfig(), *,
                     sort: bool = True, crowded: DataFrame | None = None, blocks=None) -> DataFrame:
    """Prepared pings → encounter report: grid pair join, closest moment per
    pair and group, danger score. ``sort=False`` leaves out the final sort, for
    callers that aggregate or write the report. ``crowded`` (``crowded_pings`` as
    a table) cuts the busiest grid cells finer; ``blocks`` (``spread_pairs``) saves
    shuffling the pairs where these outnumber the pings."""
    pairs = close_pairs(prepared, cfg.dmax_nm, group_key=cfg.group_key,
                        cell_factor=cfg.grid_cell_factor, tolerance_s=cfg.pair_tolerance_s,
                        earth_radius_nm=cfg.earth_radius_nm, crowded=crowded, blocks=blocks)
    best = closest_per_pair(pairs, group_key=cfg.group_key,
                            tie_break=pair_tie_break(cfg.order_by), earth_radius_nm=cfg.earth_radius_nm)
    return encounter_report(danger_score(best, cfg.weights), group_key=cfg.group_key, sort=sort)


def detect_encounters(pings: DataFrame, cfg: EncounterConfig = EncounterConfig(), *,
                      sort: bool = True) -> DataFrame:
    """In-zone pings → encounter report (one row per pair and group). As in ``run_pipeline`` the
    prepared pings are written first (in the shared folder), so that their history is made once and
    the pair search and its counts (``spread_pairs``) scan a table."""
    prepared = materialize(prepare_pings(pings, cfg), f"{run_dir(pings.sparkSession, 'detect')}/prepared")
    return score_encounters(prepared, cfg, sort=sort, blocks=spread_pairs(prepared, cfg))


def extract_events(report: DataFrame, pings: DataFrame,
                   cfg: EncounterConfig = EncounterConfig(), *,
                   partition_days=None) -> dict[str, DataFrame]:
    """Top-N events and the tables behind their maps, charts and report cards.

    ``pings`` is the in-zone table before the quality filters, as drawn by the
    analysis (slow pings of the vessels appear in the tracks). The ``cfg.top_n`` rows of ``top``
    are written (in the shared folder), so that the report is made for them once, not for each table.
    """
    top = materialize(top_encounters(report, cfg.top_n), f"{run_dir(pings.sparkSession, 'events')}/top")
    targets = event_targets(top, cfg.half_window_minutes)
    tie = tuple(c for c in cfg.order_by if c != "ts")
    points = event_track_points(pings, targets, tie_break=tie, partition_days=partition_days,
                                cell_seconds=max(1, 2 * 60 * cfg.half_window_minutes))
    complete = complete_events(points)
    return {
        "top": top,
        "targets": targets,
        "points": points,
        "tracks": event_tracks(points).join(complete.select("event_rank"), "event_rank",
                                            "left_semi"),
        "complete": complete,
        "summary": incident_summary(report),
        "cards": incident_report(top, complete),
    }


def run_pipeline(spark: SparkSession, cfg: EncounterConfig = EncounterConfig(), *,
                 csv_path: str | None = None, lake_path: str | None = None,
                 start=None, end=None, workdir: str | None = None,
                 csv_schema=None, keep_rejected: bool = True) -> dict[str, DataFrame]:
    """All stages in order. Stage boundaries are written as Parquet tables
    under ``workdir`` (default: a fresh folder in ``spark.checkpoint.dir``), so
    each stage reads its input from shared storage, like the staged analysis,
    and a lost executor never forces a recompute across stages.

    With ``csv_path`` the CSV is ingested into ``lake_path`` (default inside
    ``workdir``) first, with the rejected rows in ``workdir/rejected`` unless
    ``keep_rejected`` is off (which saves writing the parsed rows down);
    ``start``/``end`` prune the lake to those days.
    """
    work = workdir or run_dir(spark, "stages")
    if csv_path:
        lake_path = lake_path or f"{work}/lake"
        ingest(spark, csv_path, lake_path,
               rejected_path=f"{work}/rejected" if keep_rejected else None, cfg=cfg,
               schema=csv_schema)
    if not lake_path:
        raise ValueError("run_pipeline needs csv_path or lake_path")
    lake = read_ping_lake(spark, lake_path, start, end)
    # group_key="source_file" pairs pings only within one lake file, as the
    # staged analysis did; the file name is captured before the zone table is
    # written.
    zone = materialize(zone_pings(lake, cfg, lineage=cfg.group_key == "source_file"),
                       f"{work}/zone", partition_by=("group_key",))
    # Where one id or one harbour sends very much, history and pairs are cut finer. The
    # tables are small (one row for each such place), and their size is known from
    # their files, so that Spark broadcasts them, or doesn't.
    dense = if_any(dense_pings(zone, cfg), f"{work}/dense") if cfg.history_slice_seconds else None
    # The prepared pings come hash-partitioned by vessel: written per day they
    # would make (tasks × days) small files, and the pair join reads all of them.
    prepared = materialize(prepare_pings(zone, cfg, dense=dense), f"{work}/prepared")
    crowded = if_any(crowded_pings(prepared, cfg), f"{work}/crowded")
    # A table has no order of its own, so the report is sorted when it is read.
    report = materialize(score_encounters(prepared, cfg, sort=False, crowded=crowded,
                                          blocks=spread_pairs(prepared, cfg)), f"{work}/report")
    out = {"zone": zone, "prepared": prepared, "report": report.orderBy(*report_order())}
    out.update(extract_events(report, zone, cfg, partition_days="group_key"))
    return out
