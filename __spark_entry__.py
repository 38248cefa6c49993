"""

``entry(spark)`` runs the flagship query (the encounter report) on sf0.001.
``queries()`` maps every implemented operator to a Spark query over the driver
tables and ``oracle_sql()`` gives the equivalent DuckDB SQL for each.

The driver tables hold no vessel data; ``nearmiss.sources.ping_view`` maps the
``events`` table onto pings (user = vessel) and the SQL below repeats that
mapping. Test parameters are scaled to that data (one-hour buckets, 3 NM
encounter distance, 20 NM zone) so that no branch is empty; every query runs
over the whole table.

Cross-engine value equality: every double that goes through trigonometry is
rounded (6 decimals for NM/degrees, 1 for metres), and the SQL rounds like
Spark does (half-up on the decimal text of the double) via ``_r``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from nearmiss import EncounterConfig, ScoreWeights  # noqa: E402
from nearmiss.config import EVENT_CELL_SECONDS, NORMAL_COLOUR, SEVERE_COLOUR, SEVERE_SCORE  # noqa: E402
from nearmiss.operators import (  # noqa: E402
    BLOCK_PAIR,
    close_pairs,
    closest_per_pair,
    complete_events,
    crowded_cells,
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
    pings_per_vessel,
    reliable_vessels,
    top_encounters,
    track_chunks,
    track_summary,
    with_time_bucket,
)
from nearmiss.plans import (  # noqa: E402
    detect_encounters,
    extract_events,
    ingest,
    ingest_new_files,
    materialize,
    pair_tie_break,
    run_dir,
    run_pipeline,
    spread_pairs,
    update_report,
    zone_pings,
)
from nearmiss.sources import (  # noqa: E402
    batches,
    compact_ping_lake,
    from_report_layout,
    normalize_pings,
    odd_ping_view,
    ping_view,
    raw_ping_text,
    read_ping_lake,
    read_pings_csv,
    read_report,
    rejected_pings,
    rejected_report,
    to_report_layout,
    with_calendar_parts,
    with_source,
    write_ping_lake,
    write_report,
)

SMOKE_DIR = "/root/testdata/sf0.001"

# Test parameters (scaled to the driver tables).
TEST_CFG = EncounterConfig(
    radius_nm=20.0,
    min_pings=20,
    dmax_nm=3.0,
    bucket_seconds=3600,
    deny_tokens=("ERR",),
    order_by=("ts", "event_id"),
    weights=ScoreWeights(near_m=1500.0, mid_m=3000.0, stale_s=36000),
    top_n=10,
    half_window_minutes=1440,
)
ALONE_MIN_PINGS = 65  # reliable_vessels on the whole view (vessels hold 49-86 pings)
FLAGSHIP_CFG = TEST_CFG.with_(dmax_nm=20.0)  # sf0.001 has only 15 vessels


def _r(c, n: int):
    return F.round(c, n)


# ---------------------------------------------------------------- Spark side
def _zone(spark, d, cfg=TEST_CFG):
    return zone_pings(ping_view(spark, d), cfg)


def _report(spark, d, cfg=TEST_CFG, sort=False):
    return detect_encounters(_zone(spark, d, cfg), cfg, sort=sort)


def _report_out(rep: DataFrame) -> DataFrame:
    return rep.select(
        "danger_score", "vessel_a", "vessel_b", _r("distance_nm", 6).alias("distance_nm"),
        "distance_m", "ts_a", "lat", "lon", "sog_a", "sog_b", "delta_sog_a", "delta_sog_b",
        "delta_cog_a", "delta_cog_b", "interval_a", "group_key", "ts_b", "interval_b",
        "is_last_signal_a", "is_last_signal_b", "proximity_points", "course_points",
        "speed_points", "stale_penalty", "signal_points",
    )


def q_normalize_pings(spark, d):
    out = normalize_pings(raw_ping_text(spark, d))
    return out.select(F.col("event_id").cast("long").alias("event_id"), "mmsi", "vessel_id",
                      "ts", _r("lat", 6).alias("lat"), _r("lon", 6).alias("lon"), "sog", "cog",
                      "name")


def q_rejected_pings(spark, d):
    out = rejected_pings(raw_ping_text(spark, d))
    return out.select(F.col("event_id").cast("long").alias("event_id"),
                      F.col("MMSI").alias("raw_mmsi"), F.col("# Timestamp").alias("raw_ts"),
                      "reject_reason")


def q_calendar_parts(spark, d):
    return with_calendar_parts(ping_view(spark, d)).select("event_id", "Year", "Month", "Day")


def q_geofence(spark, d):
    out = geofence(ping_view(spark, d), TEST_CFG.centre_lat, TEST_CFG.centre_lon,
                   TEST_CFG.radius_nm, distance_col="zone_distance_nm")
    return out.select("event_id", "vessel_id", _r("lat", 6).alias("lat"),
                      _r("lon", 6).alias("lon"), _r("zone_distance_nm", 6).alias("zone_distance_nm"))


def q_exclude_named(spark, d):
    return exclude_named(ping_view(spark, d), TEST_CFG.deny_tokens).select(
        "event_id", "vessel_id", "name")


def q_moving_pings(spark, d):
    return moving_pings(ping_view(spark, d), TEST_CFG.min_sog, TEST_CFG.max_sog).select(
        "event_id", "vessel_id", "sog")


def q_pings_per_vessel(spark, d):
    return pings_per_vessel(ping_view(spark, d))


def q_reliable_vessels(spark, d):
    return reliable_vessels(ping_view(spark, d), ALONE_MIN_PINGS).select("event_id", "vessel_id")


def q_ping_history(spark, d):
    h = ping_history(ping_view(spark, d), TEST_CFG.order_by)
    return h.select("event_id", "vessel_id", "ts", "prev_sog", "prev_cog", "prev_ts", "next_ts",
                    "interval_s", "delta_sog", "delta_cog", "is_last_signal", "vessel_pings")


def q_ping_history_dense(spark, d):
    """The history with slices of a week, cut in four where a vessel has over ten pings."""
    pings, week = ping_view(spark, d), 7 * 86400
    dense = materialize(dense_slices(pings, slice_seconds=week, max_pings=10, parts=4), f"{run_dir(spark, 'dense')}/cuts")
    h = ping_history(pings, TEST_CFG.order_by, slice_seconds=week, dense=dense)
    return h.select("event_id", "vessel_id", "ts", "prev_sog", "prev_cog", "prev_ts", "next_ts",
                    "interval_s", "delta_sog", "delta_cog", "is_last_signal", "vessel_pings")


def q_time_bucket(spark, d):
    return with_time_bucket(ping_view(spark, d), TEST_CFG.bucket_seconds).select(
        "event_id", "epoch", "bucket")


def _pair_input(spark, d):
    m = moving_pings(ping_view(spark, d), TEST_CFG.min_sog, TEST_CFG.max_sog)
    return with_time_bucket(m, TEST_CFG.bucket_seconds)


def _pairs_out(p: DataFrame) -> DataFrame:
    return p.select("group_key", "bucket", "vessel_id_a", "vessel_id_b", "event_id_a",
                    "event_id_b", _r("distance_nm", 6).alias("distance_nm"))


def q_close_pairs_grid(spark, d):
    return _pairs_out(close_pairs(_pair_input(spark, d), TEST_CFG.dmax_nm))


def q_close_pairs_wide_cells(spark, d):
    # grid cells twice as wide as by default (the comparison of all pairs is in the tests only)
    return _pairs_out(close_pairs(_pair_input(spark, d), TEST_CFG.dmax_nm, cell_factor=8))


def q_close_pairs_crowded(spark, d):
    """Every cell of more than one ping cut into quadrants, down to one reach."""
    pings = _pair_input(spark, d)
    cells = materialize(crowded_cells(pings, TEST_CFG.dmax_nm, max_pings=1), f"{run_dir(spark, 'crowded')}/cells")
    return _pairs_out(close_pairs(pings, TEST_CFG.dmax_nm, crowded=cells))


PAIR_TOLERANCE_S = 1800  # time tolerance instead of tumbling buckets (half a test bucket)


def q_close_pairs_tolerance(spark, d):
    p = close_pairs(_pair_input(spark, d), TEST_CFG.dmax_nm, tolerance_s=PAIR_TOLERANCE_S)
    return p.select("group_key", "vessel_id_a", "vessel_id_b", "event_id_a", "event_id_b",
                    _r("distance_nm", 6).alias("distance_nm"))


def q_closest_per_pair(spark, d):
    pings = _pair_input(spark, d)
    p = close_pairs(pings, TEST_CFG.dmax_nm, blocks=pair_blocks(pings, TEST_CFG.dmax_nm, order_by=("ts", "event_id")))
    best = closest_per_pair(p, tie_break=("ts_a", "event_id_a", "ts_b", "event_id_b"))
    return best.select("group_key", "vessel_id_a", "vessel_id_b", "event_id_a", "event_id_b",
                       _r("distance_nm", 6).alias("distance_nm"))


def _scored(spark, d, cfg=TEST_CFG):
    z = _zone(spark, d, cfg)
    h = ping_history(exclude_named(z, cfg.deny_tokens), cfg.order_by)
    m = with_time_bucket(moving_pings(reliable_vessels(h, cfg.min_pings)), cfg.bucket_seconds)
    m = materialize(m, f"{run_dir(spark, 'scored')}/prepared")  # counted, then searched
    best = closest_per_pair(close_pairs(m, cfg.dmax_nm, blocks=spread_pairs(m, cfg)),
                            tie_break=pair_tie_break(cfg.order_by))
    return danger_score(best, cfg.weights)


def q_danger_score(spark, d):
    s = _scored(spark, d)
    return s.select("group_key", F.col("vessel_id_a").alias("vessel_a"),
                    F.col("vessel_id_b").alias("vessel_b"), "event_id_a", "event_id_b",
                    "distance_m", "proximity_points", "course_points", "speed_points",
                    "stale_penalty", "signal_points", "danger_score")


def q_encounter_report(spark, d):
    return _report_out(encounter_report(_scored(spark, d)))


def _top(spark, d):
    return top_encounters(_report(spark, d), TEST_CFG.top_n)


def q_top_encounters(spark, d):
    t = _top(spark, d)
    return t.select("event_rank", "danger_score", "vessel_a", "vessel_b",
                    _r("distance_nm", 6).alias("distance_nm"), "distance_m", "ts_a", "ts_b")


def _targets(spark, d, top=None):
    top = _top(spark, d) if top is None else top
    return event_targets(top, TEST_CFG.half_window_minutes)


def q_event_targets(spark, d):
    return _targets(spark, d).select(
        "event_rank", "danger_score", "vessel_a", "vessel_b",
        _r("distance_nm", 6).alias("distance_nm"), "distance_m", "target_ts", "window_start",
        "window_end", "event_key")


def _points(spark, d, top=None):
    return event_track_points(_zone(spark, d), _targets(spark, d, top), tie_break=("event_id",),
                              partition_days="group_key")


def q_event_track_points(spark, d):
    return _points(spark, d).select(
        "event_rank", "side", "vessel_id", "point_no", "ts", _r("lat", 6).alias("lat"),
        _r("lon", 6).alias("lon"), "sog", "cog", "vessel_name", "speed_band", "target_ts")


def q_event_tracks(spark, d):
    t = event_tracks(_points(spark, d))
    return t.select(
        "event_rank", "side", "vessel_id", "vessel_label", "n_points", "severity",
        F.col("middle.ts").alias("mid_ts"), _r(F.col("middle.lat"), 6).alias("mid_lat"),
        _r(F.col("middle.lon"), 6).alias("mid_lon"),
        F.col("track")[0]["ts"].alias("first_ts"),
        F.element_at("track", -1)["ts"].alias("last_ts"),
        _r(F.aggregate(F.col("track.sog"), F.lit(0.0), lambda acc, x: acc + x), 6).alias("sum_sog"),
    )


def q_complete_events(spark, d):
    return complete_events(_points(spark, d)).select(
        "event_rank", "danger_score", "vessel_a", "vessel_b", "points_a", "points_b")


def q_incident_summary(spark, d):
    s = incident_summary(_report(spark, d))
    return s.select("total_incidents", "top_score", "top_vessel_a", "top_vessel_b", "top_ts",
                    _r("top_distance_nm", 6).alias("top_distance_nm"))


def q_incident_report(spark, d):
    top = _top(spark, d)
    return incident_report(top, complete_events(_points(spark, d, top)))


def _lake(spark, d):
    """Raw text → CSV files → typed pings → day-partitioned lake, in a fresh
    folder of the shared checkpoint area."""
    work = run_dir(spark, "lake")
    raw_ping_text(spark, d).write.mode("overwrite").option("header", "true").csv(f"{work}/csv")
    typed = normalize_pings(read_pings_csv(spark, f"{work}/csv"))
    write_ping_lake(typed, f"{work}/lake")
    return work


def q_lake_roundtrip(spark, d):
    work = _lake(spark, d)
    back = read_ping_lake(spark, f"{work}/lake")
    return back.select(F.col("event_id").cast("long").alias("event_id"), "vessel_id", "ts",
                       _r("lat", 6).alias("lat"), _r("lon", 6).alias("lon"), "sog", "cog",
                       "name", "Year", "Month", "Day")


RAW_CSV_SCHEMA = ("event_id long, `# Timestamp` string, MMSI string, Latitude string, "
                  "Longitude string, SOG string, COG string, Name string")


def _typed_out(df: DataFrame) -> DataFrame:
    return df.select(F.col("event_id").cast("long").alias("event_id"), "vessel_id", "ts",
                     _r("lat", 6).alias("lat"), _r("lon", 6).alias("lon"), "sog", "cog", "name",
                     "Year", "Month", "Day")


def q_ingest_new_files(spark, d):
    """Two CSV drops into one folder. Of the second, a first call breaks off before its batch is
    committed and a second one before the batch is published; a third call finishes it, and a
    fourth finds nothing new."""
    work = run_dir(spark, "ingest")
    lake, journal = f"{work}/lake", f"{work}/journal"
    raw = raw_ping_text(spark, d)
    go = lambda: ingest_new_files(spark, f"{work}/csv", lake, journal, schema=RAW_CSV_SCHEMA)
    for drop in (0, 1):
        raw.filter(f"event_id % 2 = {drop}").write.mode("append").option("header", "true").csv(f"{work}/csv")
        if drop == 0:
            go()
            continue
        files = batches.new_inputs(spark, f"{work}/csv", journal)
        for committed in (False, True):
            name, folder = batches.stage(lake)
            ingest(spark, files, f"{folder}/lake", schema=RAW_CSV_SCHEMA)
            if committed:
                batches.commit(spark, lake, name, into={"lake": lake}, inputs=files, journal=journal)
        go()
    go()
    return _typed_out(read_ping_lake(spark, lake))


def q_lake_compacted(spark, d):
    """A lake of many small drops, compacted: all rows, and how many files each day has."""
    work = run_dir(spark, "compact")
    typed = normalize_pings(raw_ping_text(spark, d))
    for k in range(4):
        write_ping_lake(typed.filter(f"event_id % 4 = {k}"), f"{work}/lake", "append")
    compact_ping_lake(spark, f"{work}/lake")
    back = with_source(read_ping_lake(spark, f"{work}/lake"))
    files = back.groupBy("Year", "Month", "Day").agg(F.count_distinct("source_file").alias("day_files"))
    return _typed_out(back).join(files, ["Year", "Month", "Day"])


def q_lake_two_drops(spark, d):
    """Two overlapping drops (the second has late pings of nearly all days) and their
    rejects: all rows of both, rejects with their reason."""
    work = run_dir(spark, "drops")
    raw = raw_ping_text(spark, d)
    for k in (0, 1):
        raw.filter(f"event_id % 7 {'<' if k else '>='} 2").write.option("header", "true").csv(f"{work}/csv{k}")
        ingest(spark, f"{work}/csv{k}", f"{work}/lake", rejected_path=f"{work}/rejected")
    kept = read_ping_lake(spark, f"{work}/lake").select("event_id", F.lit("").alias("reject_reason"), "Year", "Month", "Day")
    bad = spark.read.parquet(f"{work}/rejected").select(
        "event_id", "reject_reason", *(F.lit(None).cast("int").alias(c) for c in ("Year", "Month", "Day")))
    return kept.unionAll(bad).withColumn("event_id", F.col("event_id").cast("long"))


def q_lake_days(spark, d):
    """The lake pruned to days in its middle."""
    work = _lake(spark, d)
    return _typed_out(read_ping_lake(spark, f"{work}/lake", LAKE_DAYS[0], LAKE_DAYS[1]))


LAKE_DAYS = ("2024-01-04", "2024-01-20")


def q_rejected_malformed(spark, d):
    """CSV files of two column orders, and one with rows of too few or too many fields:
    every row read right or rejected with its reason."""
    work = run_dir(spark, "malformed")
    raw = raw_ping_text(spark, d)
    raw.filter("event_id % 3 = 0").write.option("header", "true").csv(f"{work}/csv/a")
    swapped = ["event_id", "# Timestamp", "MMSI", "Longitude", "Latitude", "COG", "SOG", "Name"]
    raw.filter("event_id % 3 = 1").select(*swapped).write.option("header", "true").csv(f"{work}/csv/b")
    fields = [F.col(f"`{c}`") for c in raw.columns]
    line = (F.when(F.expr("event_id % 5 = 0"), F.concat_ws(",", *fields[:6]))
            .when(F.expr("event_id % 7 = 0"), F.concat_ws(",", *fields, F.lit("x")))
            .otherwise(F.concat_ws(",", *fields)))
    text = raw.filter("event_id % 3 = 2").select(line.alias(",".join(raw.columns)))
    text.write.option("header", "true").option("sep", "\u0001").csv(f"{work}/csv/c")
    back = read_pings_csv(spark, f"{work}/csv/*")
    good = normalize_pings(back).select("event_id", "lat", "lon", "sog", "cog", F.lit("").alias("reject_reason"))
    nothing = [F.lit(None).cast("double").alias(c) for c in ("lat", "lon", "sog", "cog")]
    bad = rejected_pings(back).select("event_id", *nothing, "reject_reason")
    return good.unionAll(bad).select(
        F.col("event_id").cast("long").alias("event_id"), _r("lat", 6).alias("lat"), _r("lon", 6).alias("lon"),
        "sog", "cog", "reject_reason")


def q_with_source(spark, d):
    """Of every lake row: whether its file is one of Spark's part files, and the day folder."""
    work = _lake(spark, d)
    back = with_source(read_ping_lake(spark, f"{work}/lake"))
    folder = F.regexp_extract("_metadata.file_path", r"/(Year=\d+/Month=\d+/Day=\d+)/[^/]*$", 1)
    return back.select(F.col("event_id").cast("long").alias("event_id"),
                       F.col("source_file").rlike(r"^part-[-0-9a-zA-Z.]+\.parquet$").alias("part_file"),
                       folder.alias("day_folder"))


# ---- views with gaps
def q_exclude_named_nulls(spark, d):
    """Null and blank names: dropped and kept by default, kept with ``keep_null``, and a
    table without names."""
    odd = odd_ping_view(spark, d)
    parts = (("drop", exclude_named(odd, TEST_CFG.deny_tokens)),
             ("keep", exclude_named(odd, TEST_CFG.deny_tokens, keep_null=True)),
             ("none", exclude_named(odd.drop("name"), TEST_CFG.deny_tokens)))
    return reduce(DataFrame.unionAll, [p.select(F.lit(k).alias("variant"), "event_id") for k, p in parts])


ODD_TOP = 400  # so many events that some are not severe
ODD_HALF_WINDOW = 90  # minutes; short, so that many tracks are short and unnamed


def _odd_events(spark, d, pings):
    """Targets of ``ODD_TOP`` events of the usual report, with the points found in ``pings``."""
    targets = event_targets(top_encounters(_report(spark, d), ODD_TOP), ODD_HALF_WINDOW)
    return event_track_points(pings, targets, tie_break=("event_id",), partition_days="group_key")


def q_odd_tracks(spark, d):
    """Tracks over pings with gaps: first name that isn't blank or the vessel's number, null
    speeds and courses as 0, and both severity colours."""
    t = event_tracks(_odd_events(spark, d, odd_ping_view(spark, d)))
    total = lambda c: _r(F.aggregate(F.col(f"track.{c}"), F.lit(0.0), lambda acc, x: acc + x), 6)
    return t.select("event_rank", "side", "vessel_id", "vessel_label", "legend_label", "n_points", "severity",
                    total("sog").alias("sum_sog"), total("cog").alias("sum_cog"))


def q_event_series(spark, d):
    """The telemetry series of the event tracks, point by point."""
    t = event_tracks(_points(spark, d))
    return t.select("event_rank", "side", F.inline("track")).select(
        "event_rank", "side", "point_no", "ts", "sog", "cog", "speed_band")


def q_all_events(spark, d):
    """Every encounter as an event, windows of many time cells: points and vessels of each."""
    rep, zone = _report(spark, d), _zone(spark, d)
    within_day = Window.partitionBy("group_key").orderBy("distance_nm", "vessel_a", "vessel_b")
    targets = event_targets(rep.withColumn("event_rank", F.row_number().over(within_day)), ODD_HALF_WINDOW)
    blocks = pair_blocks(with_time_bucket(zone, TEST_CFG.bucket_seconds), TEST_CFG.dmax_nm, across_groups=True)
    p = event_track_points(zone, targets, tie_break=("event_id",), partition_days="group_key", blocks=blocks,
                           window_cells=2 * 60 * ODD_HALF_WINDOW // EVENT_CELL_SECONDS + 1)
    by = ("event_rank", "vessel_a", "vessel_b", "side")
    dealt = [c for c in BLOCK_PAIR if c in p.columns]  # the same for all points of two vessels
    return p.groupBy(*by, *dealt).agg(
        F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        _r(F.sum("sog"), 6).alias("sum_sog")).drop(*dealt)


def q_track_chunks(spark, d):
    """Tracks of long windows in chunks of two points, beside the summary of the whole track."""
    cfg_targets = event_targets(_top(spark, d), TEST_CFG.half_window_minutes)
    points = event_track_points(_zone(spark, d), cfg_targets, tie_break=("event_id",), partition_days="group_key")
    chunks = track_chunks(points, 2).select("event_rank", "side", "chunk", "vessel_id", "first_point",
                                            F.col("n_points").alias("chunk_points"), F.col("track")[0]["ts"].alias("chunk_ts"))
    whole = track_summary(points).select("event_rank", "side", "n_points", "legend_label", "severity",
                                         F.col("middle.ts").alias("mid_ts"))
    return chunks.join(whole, ["event_rank", "side"])


def q_nameless_points(spark, d):
    """Track points of a table without a name column."""
    p = _odd_events(spark, d, odd_ping_view(spark, d).drop("name"))
    return p.select("event_rank", "side", "point_no", "ts", "sog", "cog", "vessel_name", "speed_band")


def q_incomplete_events(spark, d):
    """Events of which a vessel has no points are left out."""
    pings = ping_view(spark, d).filter("vessel_id % 5 != 0")
    return complete_events(_odd_events(spark, d, pings)).select(
        "event_rank", "danger_score", "vessel_a", "vessel_b", "points_a", "points_b")


def q_events_from_report(spark, d):
    """The event stage from a report CSV, of which some times can't be read: those events
    are skipped, and their rank stays unused."""
    work = run_dir(spark, "report")
    write_report(_report(spark, d, sort=True), f"{work}/report")
    csv = read_report(spark, f"{work}/report")
    spoiled = F.when(F.col("MMSI_A").cast("int") % 3 == 0, F.lit("n/a")).otherwise(F.col("TS_A"))
    report = from_report_layout(csv.withColumn("TS_A", spoiled))
    return event_targets(top_encounters(report, 50), TEST_CFG.half_window_minutes).select(
        "event_rank", "danger_score", "vessel_a", "vessel_b",
        _r("distance_nm", 6).alias("distance_nm"), "target_ts", "window_start", "event_key")


def q_extract_events(spark, d):
    """The tables of the event stage of a whole run, as (table, rank, vessels, count)."""
    out = extract_events(_report(spark, d), _zone(spark, d), TEST_CFG, partition_days="group_key")
    parts = (
        out["top"].select(F.lit("top").alias("part"), "event_rank", "vessel_a", "vessel_b", F.lit(0).cast("long").alias("n")),
        out["targets"].select(F.lit("targets"), "event_rank", "vessel_a", "vessel_b", F.lit(0).cast("long")),
        out["points"].groupBy("event_rank", "vessel_a", "vessel_b").agg(F.count("*").alias("n"))
        .select(F.lit("points"), "event_rank", "vessel_a", "vessel_b", "n"),
        out["tracks"].select(F.lit("tracks"), "event_rank", "vessel_id", "side", "n_points"),
        out["complete"].select(F.lit("complete"), "event_rank", "vessel_a", "vessel_b", F.col("points_a") + F.col("points_b")),
        out["cards"].select(F.lit("cards"), "event_rank", "vessel_a", "vessel_b", F.lit(0).cast("long")),
        out["summary"].select(F.lit("summary"), F.lit(0), "top_vessel_a", "top_vessel_b", "total_incidents"),
    )
    return reduce(DataFrame.unionAll, parts)


def q_report_by_name(spark, d):
    """Report files of two column orders, one without a column and with one that isn't known; rows
    of too few fields and of a score that is no number are rejected with their text."""
    work = run_dir(spark, "report")
    rep = materialize(_report(spark, d), f"{work}/table")  # written out three times below
    plain = to_report_layout(rep).withColumns(
        {c: F.col(c).cast("string") for c in ("Danger_Score", "Distance_NM")})
    part = F.col("MMSI_A").cast("int") % 3
    plain.filter(part == 0).write.option("header", "true").csv(f"{work}/csv/a")
    other = plain.drop("File_Source", "Latitude").withColumn("Note", F.lit("x"))
    other.filter(part == 1).select(*reversed(other.columns)).write.option("header", "true").csv(f"{work}/csv/b")
    shorter = ("Danger_Score", "MMSI_A", "MMSI_B", "TS_A")
    fields = [F.col(c) for c in shorter]
    line = (F.when(F.col("MMSI_B").cast("int") % 4 == 0, F.concat_ws(",", *fields[:3]))
            .when(F.col("MMSI_B").cast("int") % 4 == 1, F.concat_ws(",", F.lit("?"), *fields[1:]))
            .otherwise(F.concat_ws(",", *fields)))
    text = plain.filter(part == 2).select(line.alias(",".join(shorter)))
    text.write.option("header", "true").option("sep", "\u0001").csv(f"{work}/csv/c")
    good = read_report(spark, f"{work}/csv/*").select(
        "Danger_Score", "MMSI_A", "MMSI_B", "TS_A", "SOG_A", "Latitude", "File_Source", F.lit("").alias("rejected"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (
        ("Danger_Score", "int"), ("MMSI_A", "string"), ("MMSI_B", "string"), ("TS_A", "string"), ("SOG_A", "double"),
        ("Latitude", "double"), ("File_Source", "string"))]
    return good.unionAll(rejected_report(spark, f"{work}/csv/*").select(*nothing, F.col("corrupt_record").alias("rejected")))


def q_zone_pings(spark, d):
    """The zone table: its own columns only, of pings with others beside them."""
    wide = with_calendar_parts(ping_view(spark, d)).withColumns({"Extra": F.lit("x"), "cog_raw": F.lit("y")})
    out = zone_pings(wide, TEST_CFG)
    return out.withColumns({c: _r(c, 6) for c in ("lat", "lon")})


def q_report_csv_roundtrip(spark, d):
    work = run_dir(spark, "report")
    write_report(_report(spark, d, sort=True), f"{work}/report", compression="gzip")
    back = read_report(spark, f"{work}/report")
    return back.select(
        "Danger_Score", "MMSI_A", "MMSI_B", _r("Distance_NM", 6).alias("Distance_NM"),
        "Distance_Meters", "TS_A", "Latitude", "Longitude", "SOG_A", "SOG_B", "Delta_SOG_1",
        "Delta_SOG_2", "Delta_COG_1", "Delta_COG_2", "Report_Interval_Sec_1", "File_Source")


def q_all_stages(spark, d):
    work = run_dir(spark, "stages")
    raw_ping_text(spark, d).write.mode("overwrite").option("header", "true").csv(f"{work}/csv")
    out = run_pipeline(spark, TEST_CFG, csv_path=f"{work}/csv", workdir=f"{work}/run",
                       csv_schema=RAW_CSV_SCHEMA)
    return _report_out(out["report"])


def q_incremental_report(spark, d):
    """The report kept up with a lake: two drops, the second with late pings of two days, and a
    call that finds nothing new."""
    work = run_dir(spark, "incremental")
    pings = ping_view(spark, d)
    late = "event_id % 3 = 0 AND group_key IN (DATE '2024-01-10', DATE '2024-01-20')"
    for rows in (f"NOT ({late})", late, "false"):
        write_ping_lake(pings.filter(rows), f"{work}/lake", "append")
        out = update_report(spark, f"{work}/lake", f"{work}/state", TEST_CFG)
    return _report_out(out["report"])


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the sorted encounter report on sf0.001 (geofence → deny list →
    history → reliable vessels → moving pings → grid pair join → closest
    moment → danger score)."""
    return _report_out(_report(spark, SMOKE_DIR, FLAGSHIP_CFG, sort=True))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalize_pings": q_normalize_pings,
    "rejected_pings": q_rejected_pings,
    "calendar_parts": q_calendar_parts,
    "geofence": q_geofence,
    "exclude_named": q_exclude_named,
    "moving_pings": q_moving_pings,
    "pings_per_vessel": q_pings_per_vessel,
    "reliable_vessels": q_reliable_vessels,
    "ping_history": q_ping_history,
    "ping_history_dense": q_ping_history_dense,
    "time_bucket": q_time_bucket,
    "close_pairs_grid": q_close_pairs_grid,
    "close_pairs_wide_cells": q_close_pairs_wide_cells,
    "close_pairs_crowded": q_close_pairs_crowded,
    "close_pairs_tolerance": q_close_pairs_tolerance,
    "closest_per_pair": q_closest_per_pair,
    "danger_score": q_danger_score,
    "encounter_report": q_encounter_report,
    "top_encounters": q_top_encounters,
    "event_targets": q_event_targets,
    "event_track_points": q_event_track_points,
    "event_tracks": q_event_tracks,
    "complete_events": q_complete_events,
    "incident_summary": q_incident_summary,
    "incident_report": q_incident_report,
    "lake_roundtrip": q_lake_roundtrip,
    "with_source": q_with_source,
    "ingest_new_files": q_ingest_new_files,
    "lake_compacted": q_lake_compacted,
    "report_by_name": q_report_by_name,
    "zone_pings": q_zone_pings,
    "report_csv_roundtrip": q_report_csv_roundtrip,
    "all_stages": q_all_stages,
    "incremental_report": q_incremental_report,
    "lake_two_drops": q_lake_two_drops,
    "lake_days": q_lake_days,
    "rejected_malformed": q_rejected_malformed,
    "exclude_named_nulls": q_exclude_named_nulls,
    "odd_tracks": q_odd_tracks,
    "event_series": q_event_series,
    "nameless_points": q_nameless_points,
    "all_events": q_all_events,
    "track_chunks": q_track_chunks,
    "incomplete_events": q_incomplete_events,
    "events_from_report": q_events_from_report,
    "extract_events": q_extract_events,
}


# The training-data operators and their pipeline are optional: without their folder
# and module the rest works alone.
_LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_LLM_ORACLE_SQL: dict[str, str] = {}
try:
    import corpus_pipeline
    from nearmiss.llm import queries as llm_queries
except ImportError:
    pass
else:
    _LLM_QUERIES = {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}
    _LLM_ORACLE_SQL = dict(llm_queries.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL is not None:
        _LLM_ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_LLM_QUERIES}


# ---------------------------------------------------------------- SQL side
def _sr(expr: str, n: int) -> str:
    """Round like Spark: half-up on the shortest decimal text of the double."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def _hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (f"(pow(sin(radians(({lat2}) - ({lat1})) / 2), 2) + cos(radians({lat1})) * "
         f"cos(radians({lat2})) * pow(sin(radians(({lon2}) - ({lon1})) / 2), 2))")
    return f"(2.0 * atan2(sqrt({h}), sqrt(1.0 - {h})) * {TEST_CFG.earth_radius_nm})"


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_PINGS = f"""pings AS (
  SELECT event_id,
         CAST(user_id AS VARCHAR) AS vessel_id,
         date_trunc('second', ts) AS ts,
         CAST(55.225 AS DOUBLE) + CAST((CAST(round(value * 100) AS BIGINT) * 37) % 1000 - 500 AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS lat,
         CAST(14.245 AS DOUBLE) + CAST({_K} - 50 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS lon,
         {_sr('value % 50', 1)} AS sog,
         {_sr(f'{_K} * 3.6', 1)} AS cog,
         event_type AS name,
         CAST(date_trunc('second', ts) AS DATE) AS group_key
  FROM events)"""

_RAW = """raw AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CASE WHEN event_id % 89 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
              ELSE strftime(ts, '%d/%m/%Y %H:%M:%S') END AS raw_ts,
         CASE WHEN event_id % 97 = 0 THEN '12x' ELSE vessel_id END AS raw_mmsi,
         lat, lon, sog, cog, name
  FROM pings)"""

_PARSED = """parsed AS (
  SELECT event_id, raw_ts, raw_mmsi,
         TRY_CAST(raw_mmsi AS INTEGER) AS mmsi,
         CAST(TRY_CAST(raw_mmsi AS INTEGER) AS VARCHAR) AS vessel_id,
         try_strptime(raw_ts, '%d/%m/%Y %H:%M:%S') AS ts,
         lat, lon, sog, cog, name
  FROM raw)"""

_ZONE = f"""zone AS (
  SELECT * FROM pings
  WHERE {_hav('55.225', '14.245', 'lat', 'lon')} <= {TEST_CFG.radius_nm})"""


def _history(src: str, name: str = "hist") -> str:
    d = "abs(cog - prev_cog)"
    return f"""{name}_w AS (
  SELECT *,
         lag(sog) OVER w AS prev_sog, lag(cog) OVER w AS prev_cog,
         lag(ts) OVER w AS prev_ts, lead(ts) OVER w AS next_ts,
         count(*) OVER (PARTITION BY vessel_id) AS vessel_pings
  FROM {src} WHERE vessel_id IS NOT NULL
  WINDOW w AS (PARTITION BY vessel_id ORDER BY ts ASC NULLS FIRST, event_id)),
{name} AS (
  SELECT *,
         CAST(epoch(ts) AS BIGINT) - CAST(epoch(prev_ts) AS BIGINT) AS interval_s,
         {_sr('sog - prev_sog', 2)} AS delta_sog,
         {_sr(f'CASE WHEN {d} IS NULL THEN 0.0 WHEN {d} > 180.0 THEN 360.0 - {d} ELSE {d} END', 2)} AS delta_cog,
         CAST(CASE WHEN next_ts IS NULL THEN 1 ELSE 0 END AS INTEGER) AS is_last_signal
  FROM {name}_w)"""


def _bucketed(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT *, CAST(epoch(ts) AS BIGINT) AS epoch,
         CAST(floor(CAST(epoch(ts) AS BIGINT) / {TEST_CFG.bucket_seconds}.0) AS BIGINT) AS bucket
  FROM {src})"""


def _pairs(src: str, name: str = "pairs", cols=("ts", "event_id", "sog", "lat", "lon")) -> str:
    sel = ", ".join(f"a.{c} AS {c}_a, b.{c} AS {c}_b" for c in cols)
    return f"""{name} AS (
  SELECT a.group_key, a.bucket, a.vessel_id AS vessel_id_a, b.vessel_id AS vessel_id_b, {sel},
         {_hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} AS distance_nm
  FROM {src} a JOIN {src} b
    ON a.group_key = b.group_key AND a.bucket = b.bucket AND a.vessel_id < b.vessel_id
  WHERE {_hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= {TEST_CFG.dmax_nm})"""


def _closest(src: str, name: str = "best") -> str:
    return f"""{name} AS (
  SELECT * FROM {src}
  QUALIFY row_number() OVER (PARTITION BY group_key, vessel_id_a, vessel_id_b
                             ORDER BY distance_nm, ts_a, event_id_a, ts_b, event_id_b) = 1)"""


_W = TEST_CFG.weights
_SCORED_CHAIN = ",\n".join([
    _PINGS,
    _ZONE,
    "named AS (SELECT * FROM zone WHERE NOT contains(upper(name), 'ERR'))",
    _history("named", "hist"),
    f"""moving AS (SELECT * FROM hist WHERE vessel_pings >= {TEST_CFG.min_pings}
  AND vessel_id IS NOT NULL AND ts IS NOT NULL AND sog >= 2.0 AND sog <= 45.0)""",
    _bucketed("moving", "bucketed"),
    _pairs("bucketed", "pairs", ("ts", "event_id", "sog", "lat", "lon", "delta_sog", "delta_cog",
                                 "interval_s", "is_last_signal")),
    _closest("pairs", "best"),
    f"""scored0 AS (SELECT *, {_sr('distance_nm * 1852.0', 1)} AS distance_m FROM best)""",
    f"""scored AS (
  SELECT *,
    CASE WHEN distance_m <= {_W.near_m} THEN {_W.near_points}
         WHEN distance_m <= {_W.mid_m} THEN {_W.mid_points} ELSE {_W.far_points} END AS proximity_points,
    CASE WHEN sog_a >= {_W.course_min_sog} AND sog_b >= {_W.course_min_sog} THEN
      CASE WHEN delta_cog_a > {_W.sharp_turn_deg} OR delta_cog_b > {_W.sharp_turn_deg} THEN {_W.sharp_turn_points}
           WHEN delta_cog_a > {_W.turn_deg} OR delta_cog_b > {_W.turn_deg} THEN {_W.turn_points}
           ELSE 0 END
    ELSE 0 END AS course_points,
    CASE WHEN delta_sog_a <= {_W.speed_drop_kn} OR delta_sog_b <= {_W.speed_drop_kn} THEN {_W.speed_drop_points}
         WHEN delta_sog_a >= {_W.speed_gain_kn} OR delta_sog_b >= {_W.speed_gain_kn} THEN {_W.speed_gain_points}
         ELSE 0 END AS speed_points,
    CASE WHEN interval_s_a > {_W.stale_s} THEN {_W.stale_penalty} ELSE 0 END AS stale_penalty,
    CASE WHEN is_last_signal_a = 1 OR is_last_signal_b = 1 THEN {_W.last_signal_points} ELSE 0 END AS signal_points
  FROM scored0)""",
    """report AS (
  SELECT proximity_points + course_points + speed_points - stale_penalty + signal_points AS danger_score,
         vessel_id_a AS vessel_a, vessel_id_b AS vessel_b, distance_nm, distance_m, ts_a,
         """ + _sr("(lat_a + lat_b) / 2", 6) + """ AS lat, """ + _sr("(lon_a + lon_b) / 2", 6) + """ AS lon,
         sog_a, sog_b, delta_sog_a, delta_sog_b, delta_cog_a, delta_cog_b,
         interval_s_a AS interval_a, group_key, ts_b, interval_s_b AS interval_b,
         is_last_signal_a, is_last_signal_b, proximity_points, course_points, speed_points,
         stale_penalty, signal_points, event_id_a, event_id_b
  FROM scored)""",
])

_REPORT_SELECT = f"""SELECT danger_score, vessel_a, vessel_b, {_sr('distance_nm', 6)} AS distance_nm,
       distance_m, ts_a, lat, lon, sog_a, sog_b, delta_sog_a, delta_sog_b, delta_cog_a,
       delta_cog_b, interval_a, group_key, ts_b, interval_b, is_last_signal_a,
       is_last_signal_b, proximity_points, course_points, speed_points, stale_penalty,
       signal_points
FROM report"""

_EVENTS_CHAIN = ",\n".join([
    _SCORED_CHAIN,
    f"""top AS (
  SELECT *, CAST(row_number() OVER (ORDER BY danger_score DESC, distance_nm, vessel_a, vessel_b, ts_a, ts_b) AS INTEGER) AS event_rank
  FROM report
  QUALIFY event_rank <= {TEST_CFG.top_n})""",
    f"""targets AS (
  SELECT event_rank, danger_score, vessel_a, vessel_b, distance_nm, distance_m,
         ts_a AS target_ts,
         ts_a - INTERVAL {TEST_CFG.half_window_minutes} MINUTE AS window_start,
         ts_a + INTERVAL {TEST_CFG.half_window_minutes} MINUTE AS window_end,
         'Top_' || event_rank || '_Score_' || danger_score || '_' ||
           coalesce(strftime(ts_a, '%Y%m%d_%H%M%S'), 'date_error') || '_' || vessel_a || '_' || vessel_b AS event_key
  FROM top WHERE ts_a IS NOT NULL)""",
    """sides AS (
  SELECT *, 'A' AS side, vessel_a AS v FROM targets
  UNION ALL
  SELECT *, 'B' AS side, vessel_b AS v FROM targets)""",
    """points AS (
  SELECT s.event_rank, s.danger_score, s.vessel_a, s.vessel_b, s.distance_nm, s.distance_m,
         s.target_ts, s.side, p.vessel_id, p.lat, p.lon, p.ts,
         coalesce(p.sog, 0.0) AS sog, coalesce(p.cog, 0.0) AS cog,
         coalesce(regexp_replace(p.name, '^\\s+|\\s+$', '', 'g'), '') AS vessel_name,
         CAST(row_number() OVER (PARTITION BY s.event_rank, s.side ORDER BY p.ts, p.event_id) AS INTEGER) AS point_no,
         CASE WHEN coalesce(p.sog, 0.0) <= 0.1 THEN 'blue' WHEN coalesce(p.sog, 0.0) <= 1.0 THEN 'red'
              WHEN coalesce(p.sog, 0.0) <= 5.0 THEN 'orange' WHEN coalesce(p.sog, 0.0) <= 12.0 THEN 'yellow'
              ELSE 'green' END AS speed_band
  FROM zone p JOIN sides s
    ON p.vessel_id = s.v AND p.ts >= s.window_start AND p.ts <= s.window_end)""",
    """complete AS (
  SELECT event_rank, danger_score, vessel_a, vessel_b,
         CAST(count_if(side = 'A') AS BIGINT) AS points_a,
         CAST(count_if(side = 'B') AS BIGINT) AS points_b
  FROM points GROUP BY event_rank, danger_score, vessel_a, vessel_b
  HAVING count_if(side = 'A') > 0 AND count_if(side = 'B') > 0)""",
])


_ODD = """odd AS (
  SELECT event_id, vessel_id, ts, lat, lon, group_key,
         CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN '  '
              WHEN event_id % 5 = 0 THEN ' ' || name || ' ' ELSE name END AS name,
         CASE WHEN event_id % 17 <> 0 THEN sog END AS sog,
         CASE WHEN event_id % 13 <> 0 THEN cog END AS cog
  FROM pings)"""


def _odd_chain(pings: str) -> str:
    """Points of ``ODD_TOP`` events found in another view of the pings."""
    chain = _EVENTS_CHAIN.replace(f"QUALIFY event_rank <= {TEST_CFG.top_n})", f"QUALIFY event_rank <= {ODD_TOP})")
    chain = chain.replace(f"INTERVAL {TEST_CFG.half_window_minutes} MINUTE", f"INTERVAL {ODD_HALF_WINDOW} MINUTE")
    return ",\n".join([chain.replace("FROM zone p JOIN sides s", f"FROM {pings} p JOIN sides s").replace(
        "targets AS (", f"{_ODD},\nfewer AS (SELECT * FROM pings WHERE CAST(vessel_id AS BIGINT) % 5 <> 0),\ntargets AS (", 1)])


def _with(chain: str, select: str) -> str:
    return f"WITH {chain}\n{select}"


def oracle_sql() -> dict[str, str]:
    hist_select = """SELECT event_id, vessel_id, ts, prev_sog, prev_cog, prev_ts, next_ts,
       interval_s, delta_sog, delta_cog, is_last_signal, vessel_pings FROM hist"""
    pairs_select = f"""SELECT group_key, bucket, vessel_id_a, vessel_id_b, event_id_a, event_id_b,
       {_sr('distance_nm', 6)} AS distance_nm FROM pairs"""
    pair_input = ",\n".join([
        _PINGS,
        "moving AS (SELECT * FROM pings WHERE vessel_id IS NOT NULL AND ts IS NOT NULL AND sog >= 2.0 AND sog <= 45.0)",
        _bucketed("moving", "bucketed"),
        _pairs("bucketed"),
    ])
    lake_select = f"""SELECT event_id, vessel_id, ts, {_sr('lat', 6)} AS lat, {_sr('lon', 6)} AS lon,
       sog, cog, name, CAST(year(ts) AS INTEGER) AS "Year", CAST(month(ts) AS INTEGER) AS "Month",
       CAST(day(ts) AS INTEGER) AS "Day"
FROM pings WHERE event_id % 97 <> 0 AND event_id % 89 <> 0"""
    tracks = """SELECT p.event_rank, p.side, p.vessel_id,
       coalesce(min_by(CASE WHEN length(p.vessel_name) > 0 THEN p.vessel_name END,
                       CASE WHEN length(p.vessel_name) > 0 THEN p.point_no END),
                'MMSI ' || p.vessel_id) AS vessel_label,
       count(*) AS n_points,
       CASE WHEN max(p.danger_score) >= 90 THEN 'red' ELSE 'purple' END AS severity,
       max(CASE WHEN p.point_no = CAST(floor(n.n / 2) AS INTEGER) + 1 THEN p.ts END) AS mid_ts,
       max(CASE WHEN p.point_no = CAST(floor(n.n / 2) AS INTEGER) + 1 THEN """ + _sr("p.lat", 6) + """ END) AS mid_lat,
       max(CASE WHEN p.point_no = CAST(floor(n.n / 2) AS INTEGER) + 1 THEN """ + _sr("p.lon", 6) + """ END) AS mid_lon,
       min(p.ts) AS first_ts, max(p.ts) AS last_ts,
       """ + _sr("sum(p.sog)", 6) + """ AS sum_sog
FROM points p JOIN (SELECT event_rank, side, count(*) AS n FROM points GROUP BY 1, 2) n
  ON p.event_rank = n.event_rank AND p.side = n.side
GROUP BY p.event_rank, p.side, p.vessel_id"""
    return {
        **_LLM_ORACLE_SQL,
        "normalize_pings": _with(",\n".join([_PINGS, _RAW, _PARSED]), f"""SELECT CAST(event_id AS BIGINT) AS event_id, mmsi, vessel_id, ts,
       {_sr('lat', 6)} AS lat, {_sr('lon', 6)} AS lon, sog, cog, name
FROM parsed WHERE mmsi IS NOT NULL AND ts IS NOT NULL"""),
        "rejected_pings": _with(",\n".join([_PINGS, _RAW, _PARSED]), """SELECT CAST(event_id AS BIGINT) AS event_id, raw_mmsi, raw_ts,
       CASE WHEN raw_mmsi IS NULL OR raw_mmsi = '' THEN 'missing_vessel_id'
            WHEN mmsi IS NULL THEN 'bad_vessel_id'
            WHEN raw_ts IS NULL OR raw_ts = '' THEN 'missing_time'
            ELSE 'bad_time' END AS reject_reason
FROM parsed WHERE mmsi IS NULL OR ts IS NULL"""),
        "calendar_parts": _with(_PINGS, """SELECT event_id, CAST(year(ts) AS INTEGER) AS "Year",
       CAST(month(ts) AS INTEGER) AS "Month", CAST(day(ts) AS INTEGER) AS "Day" FROM pings"""),
        "geofence": _with(_PINGS, f"""SELECT event_id, vessel_id, {_sr('lat', 6)} AS lat, {_sr('lon', 6)} AS lon,
       {_sr(_hav('55.225', '14.245', 'lat', 'lon'), 6)} AS zone_distance_nm
FROM pings WHERE {_hav('55.225', '14.245', 'lat', 'lon')} <= {TEST_CFG.radius_nm}"""),
        "exclude_named": _with(_PINGS, """SELECT event_id, vessel_id, name FROM pings
WHERE NOT contains(upper(name), 'ERR')"""),
        "moving_pings": _with(_PINGS, """SELECT event_id, vessel_id, sog FROM pings
WHERE vessel_id IS NOT NULL AND ts IS NOT NULL AND sog >= 2.0 AND sog <= 45.0"""),
        "pings_per_vessel": _with(_PINGS, """SELECT vessel_id, count(*) AS pings FROM pings
WHERE vessel_id IS NOT NULL GROUP BY vessel_id"""),
        "reliable_vessels": _with(_PINGS, f"""SELECT event_id, vessel_id FROM pings
WHERE vessel_id IN (SELECT vessel_id FROM pings GROUP BY vessel_id HAVING count(*) >= {ALONE_MIN_PINGS})"""),
        "ping_history": _with(",\n".join([_PINGS, _history("pings")]), hist_select),
        "ping_history_dense": _with(",\n".join([_PINGS, _history("pings")]), hist_select),
        "time_bucket": _with(",\n".join([_PINGS, _bucketed("pings", "b")]),
                             "SELECT event_id, epoch, bucket FROM b"),
        "close_pairs_grid": _with(pair_input, pairs_select),
        "close_pairs_wide_cells": _with(pair_input, pairs_select),
        "close_pairs_crowded": _with(pair_input, pairs_select),
        "close_pairs_tolerance": _with(",\n".join([
            _PINGS,
            "moving AS (SELECT * FROM pings WHERE vessel_id IS NOT NULL AND ts IS NOT NULL AND sog >= 2.0 AND sog <= 45.0)",
            _bucketed("moving", "bucketed")]), f"""SELECT a.group_key, a.vessel_id AS vessel_id_a, b.vessel_id AS vessel_id_b,
       a.event_id AS event_id_a, b.event_id AS event_id_b,
       {_sr(_hav('a.lat', 'a.lon', 'b.lat', 'b.lon'), 6)} AS distance_nm
FROM bucketed a JOIN bucketed b
  ON a.vessel_id < b.vessel_id AND abs(a.epoch - b.epoch) <= {PAIR_TOLERANCE_S}
WHERE {_hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= {TEST_CFG.dmax_nm}"""),
        "closest_per_pair": _with(",\n".join([pair_input, _closest("pairs")]), f"""SELECT group_key, vessel_id_a, vessel_id_b, event_id_a, event_id_b,
       {_sr('distance_nm', 6)} AS distance_nm FROM best"""),
        "danger_score": _with(_SCORED_CHAIN, """SELECT group_key, vessel_a, vessel_b, event_id_a, event_id_b, distance_m,
       proximity_points, course_points, speed_points, stale_penalty, signal_points, danger_score
FROM report"""),
        "encounter_report": _with(_SCORED_CHAIN, _REPORT_SELECT),
        "incremental_report": _with(_SCORED_CHAIN, _REPORT_SELECT),
        "top_encounters": _with(_EVENTS_CHAIN, f"""SELECT event_rank, danger_score, vessel_a, vessel_b,
       {_sr('distance_nm', 6)} AS distance_nm, distance_m, ts_a, ts_b FROM top"""),
        "event_targets": _with(_EVENTS_CHAIN, f"""SELECT event_rank, danger_score, vessel_a, vessel_b,
       {_sr('distance_nm', 6)} AS distance_nm, distance_m, target_ts, window_start, window_end,
       event_key FROM targets"""),
        "event_track_points": _with(_EVENTS_CHAIN, f"""SELECT event_rank, side, vessel_id, point_no, ts,
       {_sr('lat', 6)} AS lat, {_sr('lon', 6)} AS lon, sog, cog, vessel_name, speed_band, target_ts
FROM points"""),
        "event_tracks": _with(_EVENTS_CHAIN, tracks),
        "complete_events": _with(_EVENTS_CHAIN, """SELECT event_rank, danger_score, vessel_a, vessel_b,
       points_a, points_b FROM complete"""),
        "incident_summary": _with(_SCORED_CHAIN, f"""SELECT count(*) AS total_incidents,
       arg_min(danger_score, (-danger_score, distance_nm, vessel_a, vessel_b, ts_a, ts_b)) AS top_score,
       arg_min(vessel_a, (-danger_score, distance_nm, vessel_a, vessel_b, ts_a, ts_b)) AS top_vessel_a,
       arg_min(vessel_b, (-danger_score, distance_nm, vessel_a, vessel_b, ts_a, ts_b)) AS top_vessel_b,
       arg_min(ts_a, (-danger_score, distance_nm, vessel_a, vessel_b, ts_a, ts_b)) AS top_ts,
       {_sr('arg_min(distance_nm, (-danger_score, distance_nm, vessel_a, vessel_b, ts_a, ts_b))', 6)} AS top_distance_nm
FROM report"""),
        "incident_report": _with(_EVENTS_CHAIN, f"""SELECT event_rank, danger_score, vessel_a, vessel_b,
       strftime(ts_a, '%Y-%m-%d %H:%M:%S') AS ts_text,
       {_sr('distance_nm * 1852.0', 1)} AS distance_m, {_sr('distance_nm', 4)} AS distance_nm_4,
       sog_a, sog_b,
       'Top_' || event_rank || '_Score_' || danger_score || '_' ||
         coalesce(strftime(ts_a, '%Y%m%d_%H%M%S'), 'date_error') || '_' || vessel_a || '_' || vessel_b AS event_key
FROM top WHERE event_rank IN (SELECT event_rank FROM complete)"""),
        "lake_roundtrip": _with(_PINGS, lake_select),
        "ingest_new_files": _with(_PINGS, lake_select),
        "lake_compacted": _with(_PINGS, lake_select.replace("SELECT event_id", "SELECT CAST(1 AS BIGINT) AS day_files, event_id", 1)),
        "report_by_name": _with(_SCORED_CHAIN, f"""SELECT CASE WHEN reason = '' THEN danger_score END AS "Danger_Score",
       CASE WHEN reason = '' THEN vessel_a END AS "MMSI_A", CASE WHEN reason = '' THEN vessel_b END AS "MMSI_B",
       CASE WHEN reason = '' THEN strftime(ts_a, '%Y-%m-%d %H:%M:%S') END AS "TS_A",
       CASE WHEN k < 2 THEN sog_a END AS "SOG_A", CASE WHEN k = 0 THEN lat END AS "Latitude",
       CASE WHEN k = 0 THEN CAST(group_key AS VARCHAR) END AS "File_Source", reason AS rejected
FROM (SELECT *, CAST(vessel_a AS BIGINT) % 3 AS k,
        CASE WHEN CAST(vessel_a AS BIGINT) % 3 <> 2 OR CAST(vessel_b AS BIGINT) % 4 > 1 THEN ''
             WHEN CAST(vessel_b AS BIGINT) % 4 = 0 THEN danger_score || ',' || vessel_a || ',' || vessel_b
             ELSE '?,' || vessel_a || ',' || vessel_b || ',' || strftime(ts_a, '%Y-%m-%d %H:%M:%S') END AS reason
      FROM report)"""),
        "zone_pings": _with(f"{_PINGS},\n{_ZONE}", f"""SELECT ts, vessel_id, {_sr('lat', 6)} AS lat, {_sr('lon', 6)} AS lon,
       sog, cog, name, group_key, event_id FROM zone"""),
        "lake_days": _with(_PINGS, f"{lake_select} AND CAST(ts AS DATE) BETWEEN DATE '{LAKE_DAYS[0]}' AND DATE '{LAKE_DAYS[1]}'"),
        "lake_two_drops": _with(",\n".join([_PINGS, _RAW, _PARSED]), """SELECT CAST(event_id AS BIGINT) AS event_id,
       CASE WHEN mmsi IS NULL THEN 'bad_vessel_id' WHEN ts IS NULL THEN 'bad_time' ELSE '' END AS reject_reason,
       CASE WHEN mmsi IS NOT NULL THEN CAST(year(ts) AS INTEGER) END AS "Year",
       CASE WHEN mmsi IS NOT NULL THEN CAST(month(ts) AS INTEGER) END AS "Month",
       CASE WHEN mmsi IS NOT NULL THEN CAST(day(ts) AS INTEGER) END AS "Day"
FROM parsed"""),
        "rejected_malformed": _with(",\n".join([_PINGS, _RAW, _PARSED, """judged AS (
  SELECT *, CASE WHEN CAST(event_id AS BIGINT) % 3 = 2 AND (CAST(event_id AS BIGINT) % 5 = 0 OR CAST(event_id AS BIGINT) % 7 = 0)
                 THEN 'malformed_row' WHEN mmsi IS NULL THEN 'bad_vessel_id' WHEN ts IS NULL THEN 'bad_time' ELSE '' END AS reject_reason
  FROM parsed)"""]), f"""SELECT CAST(event_id AS BIGINT) AS event_id,
       CASE WHEN reject_reason = '' THEN {_sr('lat', 6)} END AS lat,
       CASE WHEN reject_reason = '' THEN {_sr('lon', 6)} END AS lon,
       CASE WHEN reject_reason = '' THEN sog END AS sog, CASE WHEN reject_reason = '' THEN cog END AS cog,
       reject_reason
FROM judged"""),
        "with_source": _with(_PINGS, """SELECT event_id, TRUE AS part_file,
       'Year=' || year(ts) || '/Month=' || month(ts) || '/Day=' || day(ts) AS day_folder
FROM pings WHERE event_id % 97 <> 0 AND event_id % 89 <> 0"""),
        "exclude_named_nulls": _with(f"{_PINGS},\n{_ODD}", """SELECT 'drop' AS variant, event_id FROM odd WHERE NOT contains(upper(name), 'ERR')
UNION ALL SELECT 'keep', event_id FROM odd WHERE name IS NULL OR NOT contains(upper(name), 'ERR')
UNION ALL SELECT 'none', event_id FROM odd"""),
        "odd_tracks": _with(_odd_chain("odd"), f"""SELECT *, substr(vessel_label, 1, 15) AS legend_label FROM (
SELECT event_rank, side, min(vessel_id) AS vessel_id,
       coalesce(arg_min(vessel_name, point_no) FILTER (length(vessel_name) > 0), 'MMSI ' || min(vessel_id)) AS vessel_label,
       count(*) AS n_points, CASE WHEN max(danger_score) >= {SEVERE_SCORE} THEN '{SEVERE_COLOUR}' ELSE '{NORMAL_COLOUR}' END AS severity,
       {_sr('sum(sog)', 6)} AS sum_sog, {_sr('sum(cog)', 6)} AS sum_cog
FROM points GROUP BY event_rank, side)"""),
        "event_series": _with(_EVENTS_CHAIN, "SELECT event_rank, side, point_no, ts, sog, cog, speed_band FROM points"),
        "all_events": _with(_SCORED_CHAIN, f"""SELECT event_rank, vessel_a, vessel_b, side, count(*) AS n, min(p.ts) AS first_ts,
       max(p.ts) AS last_ts, {_sr('sum(p.sog)', 6)} AS sum_sog
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY group_key ORDER BY distance_nm, vessel_a, vessel_b) AS INTEGER) AS event_rank,
        unnest(['A', 'B']) AS side, unnest([vessel_a, vessel_b]) AS v FROM report WHERE ts_a IS NOT NULL) e
  JOIN zone p ON p.vessel_id = e.v AND p.ts BETWEEN e.ts_a - INTERVAL {ODD_HALF_WINDOW} MINUTE AND e.ts_a + INTERVAL {ODD_HALF_WINDOW} MINUTE
GROUP BY event_rank, vessel_a, vessel_b, side"""),
        "track_chunks": _with(_EVENTS_CHAIN, f"""SELECT *, CASE WHEN label IS NULL THEN 'MMSI ' || vessel_id ELSE label END AS legend_label
FROM (SELECT event_rank, side, CAST((point_no - 1) // 2 AS INTEGER) AS chunk, min(vessel_id) AS vessel_id,
        min(point_no) AS first_point, count(*) AS chunk_points, min(ts) AS chunk_ts FROM points GROUP BY 1, 2, 3)
  JOIN (SELECT event_rank, side, count(*) AS n_points,
          substr(arg_min(vessel_name, point_no) FILTER (length(vessel_name) > 0), 1, 15) AS label,
          CASE WHEN max(danger_score) >= {SEVERE_SCORE} THEN '{SEVERE_COLOUR}' ELSE '{NORMAL_COLOUR}' END AS severity,
          max(ts) FILTER (point_no = n // 2 + 1) AS mid_ts
        FROM (SELECT *, count(*) OVER (PARTITION BY event_rank, side) AS n FROM points) GROUP BY event_rank, side)
  USING (event_rank, side)""").replace("SELECT *, CASE WHEN label IS NULL", "SELECT * EXCLUDE (label), CASE WHEN label IS NULL"),
        "nameless_points": _with(_odd_chain("odd"), """SELECT event_rank, side, point_no, ts, sog, cog, '' AS vessel_name, speed_band
FROM points"""),
        "incomplete_events": _with(_odd_chain("fewer"), """SELECT event_rank, danger_score, vessel_a, vessel_b, points_a, points_b
FROM complete"""),
        "events_from_report": _with(",\n".join([_SCORED_CHAIN, """spoiled AS (
  SELECT * REPLACE (CASE WHEN CAST(vessel_a AS BIGINT) % 3 = 0 THEN NULL ELSE ts_a END AS ts_a) FROM report)""",
            """ranked AS (
  SELECT *, CAST(row_number() OVER (ORDER BY danger_score DESC, distance_nm, vessel_a, vessel_b, ts_a NULLS FIRST) AS INTEGER) AS event_rank
  FROM spoiled)"""]), f"""SELECT event_rank, danger_score, vessel_a, vessel_b, {_sr('distance_nm', 6)} AS distance_nm,
       ts_a AS target_ts, ts_a - INTERVAL {TEST_CFG.half_window_minutes} MINUTE AS window_start,
       'Top_' || event_rank || '_Score_' || danger_score || '_' || strftime(ts_a, '%Y%m%d_%H%M%S') || '_' || vessel_a || '_' || vessel_b AS event_key
FROM ranked WHERE event_rank <= 50 AND ts_a IS NOT NULL"""),
        "extract_events": _with(_EVENTS_CHAIN, """SELECT 'top' AS part, event_rank, vessel_a, vessel_b, CAST(0 AS BIGINT) AS n FROM top
UNION ALL SELECT 'targets', event_rank, vessel_a, vessel_b, 0 FROM targets
UNION ALL SELECT 'points', event_rank, vessel_a, vessel_b, count(*) FROM points GROUP BY event_rank, vessel_a, vessel_b
UNION ALL SELECT 'tracks', event_rank, min(vessel_id), side, count(*) FROM points
  WHERE event_rank IN (SELECT event_rank FROM complete) GROUP BY event_rank, side
UNION ALL SELECT 'complete', event_rank, vessel_a, vessel_b, points_a + points_b FROM complete
UNION ALL SELECT 'cards', event_rank, vessel_a, vessel_b, 0 FROM top WHERE event_rank IN (SELECT event_rank FROM complete)
UNION ALL SELECT 'summary', 0, arg_min(vessel_a, (-danger_score, distance_nm, vessel_a, vessel_b, ts_a, ts_b)),
  arg_min(vessel_b, (-danger_score, distance_nm, vessel_a, vessel_b, ts_a, ts_b)), count(*) FROM report"""),
        "report_csv_roundtrip": _with(_SCORED_CHAIN, f"""SELECT danger_score AS "Danger_Score", vessel_a AS "MMSI_A",
       vessel_b AS "MMSI_B", {_sr('distance_nm', 6)} AS "Distance_NM", distance_m AS "Distance_Meters",
       strftime(ts_a, '%Y-%m-%d %H:%M:%S') AS "TS_A", lat AS "Latitude", lon AS "Longitude",
       sog_a AS "SOG_A", sog_b AS "SOG_B", delta_sog_a AS "Delta_SOG_1", delta_sog_b AS "Delta_SOG_2",
       delta_cog_a AS "Delta_COG_1", delta_cog_b AS "Delta_COG_2",
       interval_a AS "Report_Interval_Sec_1", CAST(group_key AS VARCHAR) AS "File_Source"
FROM report"""),
        "all_stages": _with(
            _SCORED_CHAIN.replace(
                "  FROM events)", "  FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0)", 1),
            _REPORT_SELECT),
    }
