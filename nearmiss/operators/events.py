"""The worst encounters as events: targets, track points, tracks, completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearmiss.config import EVENT_CELL_SECONDS, HALF_WINDOW_MINUTES, LEGEND_CHARS, SEVERE_SCORE, TOP_N, TRACK_CHUNK_POINTS
from nearmiss.functions.display import event_key, severity, speed_band
from nearmiss.functions.motion import epoch_seconds
from nearmiss.operators.pairs import BLOCK_PAIR, PairBlocks, by_block_pair, in_block_pairs
from nearmiss.operators.scoring import report_order


def top_encounters(report: DataFrame, n: int = TOP_N) -> DataFrame:
    """The ``n`` highest-scoring encounters with ``event_rank`` 1..n.

    ``orderBy().limit(n)`` plans as TakeOrderedAndProject: each task keeps its
    own top n, so only ``n × tasks`` rows reach the final merge. The rank is
    numbered over those ``n`` rows only (the one window without a partition
    key in the library, bounded by ``n``, a top-k report size).
    """
    order = report_order()
    top = report.orderBy(*order).limit(n)
    return top.withColumn("event_rank", F.row_number().over(Window.orderBy(*order)))


def event_targets(top: DataFrame, half_window_minutes: int = HALF_WINDOW_MINUTES) -> DataFrame:
    """One row per event: the two vessels, the closest moment and the time
    window ``[ts − half, ts + half]`` around it. Events without a time are
    skipped; their rank number stays unused."""
    half = F.make_dt_interval(mins=F.lit(half_window_minutes))
    return top.filter(F.col("ts_a").isNotNull()).select(
        "event_rank",
        "danger_score",
        "vessel_a",
        "vessel_b",
        "distance_nm",
        "distance_m",
        F.col("ts_a").alias("target_ts"),
        (F.col("ts_a") - half).alias("window_start"),
        (F.col("ts_a") + half).alias("window_end"),
        event_key("event_rank", "danger_score", "ts_a", "vessel_a", "vessel_b").alias("event_key"),
    )


def event_track_points(
    pings: DataFrame,
    targets: DataFrame,
    *,
    vessel: str = "vessel_id",
    ts: str = "ts",
    lat: str = "lat",
    lon: str = "lon",
    sog: str = "sog",
    cog: str = "cog",
    name: str = "name",
    tie_break=(),
    partition_days=None,
    cell_seconds: int = EVENT_CELL_SECONDS,
    window_cells: int = 1,
    blocks: PairBlocks | None = None,
) -> DataFrame:
    """Every ping of either event vessel inside the event's window (inclusive).

    Instead of the disjunctive ``id = A OR id = B`` condition (a nested-loop
    join), each target is exploded into one row per (event, vessel, time cell): an
    equi join on the vessel id and the ``cell_seconds``-long cells that the window touches.
    The time range itself is a residual condition on those cells' pings only, at most
    about twice the matches where a cell is as long as a window, also when every
    encounter is an event and a vessel has many in a day.

    ``partition_days`` names the pings' day partition column(s): a date column,
    or ``("Year", "Month", "Day")``. The targets are then also exploded over the
    days their window touches (a cell over midnight counts in both) and joined on
    them, which lets dynamic partition pruning skip every day without an event.

    Where every encounter is an event, targets far outnumber pings, and the pings are copied instead.
    ``window_cells`` (the most cells that a window touches; any number is right): a target has one
    row for so many cells of its window, and each ping is copied into as many cells. ``blocks``
    (``pair_blocks`` with ``across_groups``): targets are shuffled once, before their sides and cells
    are made, to the tasks of their vessels' block pair, and pings to each block pair of their
    vessel. The points get ``_block_lo`` and ``_block_hi``; grouped by these as well as by event or
    vessels, they aren't shuffled again. Both give the same points.

    Adds ``side`` (A/B), ``point_no`` (1.. in time order per event and vessel),
    ``speed_band``; a missing speed or course reads 0.0 and a missing name "".
    """
    dealt = () if blocks is None else BLOCK_PAIR
    t = targets if blocks is None else by_block_pair(targets, blocks, "vessel_a", "vessel_b")
    t = t.select(
        "event_rank", "danger_score", "vessel_a", "vessel_b", "distance_nm", "distance_m",
        "target_ts", "window_start", "window_end", *dealt,
        F.explode(F.array(
            F.struct(F.lit("A").alias("side"), F.col("vessel_a").alias("_vessel")),
            F.struct(F.lit("B").alias("side"), F.col("vessel_b").alias("_vessel")),
        )).alias("_s"),
    ).select("*", "_s.side", "_s._vessel").drop("_s")

    day_cols = [partition_days] if isinstance(partition_days, str) else list(partition_days or ())
    name_col = (
        F.coalesce(F.regexp_replace(F.col(name), r"^\s+|\s+$", ""), F.lit(""))
        if name in pings.columns else F.lit("")
    )
    src = pings.select(
        F.col(vessel).alias("vessel_id"), F.col(ts).alias("ts"), F.col(lat).alias("lat"),
        F.col(lon).alias("lon"), F.col(sog).alias("_sog"), F.col(cog).alias("_cog"),
        name_col.alias("vessel_name"), *tie_break, *day_cols,
    )

    cell = lambda c: F.floor(epoch_seconds(c) / F.lit(cell_seconds))
    if blocks is not None:
        src = in_block_pairs(src, blocks, "vessel_id").withColumnsRenamed({c: f"{c}_p" for c in BLOCK_PAIR})
    src = src.withColumn("_cell", cell("ts"))
    if window_cells > 1:
        # the cells that a target's row may start at to hold this ping's cell
        src = src.withColumn("_cell", F.explode(F.sequence(F.col("_cell") - (window_cells - 1), F.col("_cell"))))
    cond = ((F.col("vessel_id") == F.col("_vessel")) & (F.col("_cell") == F.col("_window_cell"))
            & (F.col("ts") >= F.col("window_start")) & (F.col("ts") <= F.col("window_end")))
    for c in dealt:
        cond = cond & (F.col(c) == F.col(f"{c}_p"))
    first, last = F.col("window_start"), F.col("window_end")
    if day_cols:
        t = t.withColumn("_day", F.explode(F.sequence(F.to_date("window_start"),
                                                      F.to_date("window_end"))))
        # The day range stated as a comparison: Spark inserts dynamic partition
        # pruning only when the pruning side carries such a predicate.
        t = t.filter(F.col("_day").between(F.to_date("window_start"), F.to_date("window_end")))
        if len(day_cols) == 1:
            cond = cond & (F.col(day_cols[0]) == F.col("_day"))
        else:
            y, m, d = day_cols
            t = (t.withColumn("_y", F.year("_day")).withColumn("_m", F.month("_day"))
                 .withColumn("_d", F.dayofmonth("_day")))
            cond = (cond & (F.col(y) == F.col("_y")) & (F.col(m) == F.col("_m"))
                    & (F.col(d) == F.col("_d")))
        # the cells of the window's part of that day
        midnight = F.col("_day").cast(targets.schema["window_start"].dataType)
        first = F.greatest(first, midnight)
        last = F.least(last, midnight + F.make_dt_interval(days=F.lit(1)))
    if window_cells > 1:
        cells = F.sequence(cell(first), F.greatest(cell(first), cell(last)), F.lit(window_cells).cast("long"))
    else:
        cells = F.sequence(cell(first), cell(last))
    t = t.withColumn("_window_cell", F.explode(cells))

    joined = src.join(t, on=cond, how="inner")
    w = Window.partitionBy("event_rank", "side").orderBy("ts", *tie_break)
    return joined.select(
        "event_rank", "danger_score", "vessel_a", "vessel_b", "distance_nm", "distance_m",
        "target_ts", "side", "vessel_id", "lat", "lon", "ts",
        F.coalesce(F.col("_sog"), F.lit(0.0)).alias("sog"),
        F.coalesce(F.col("_cog"), F.lit(0.0)).alias("cog"),
        "vessel_name",
        F.row_number().over(w).alias("point_no"),
        speed_band(F.coalesce(F.col("_sog"), F.lit(0.0))).alias("speed_band"),
        *dealt,
    )


def complete_events(points: DataFrame) -> DataFrame:
    """Events with at least one track point for each of the two vessels, with
    the point count per vessel."""
    return (
        points.groupBy("event_rank", "danger_score", "vessel_a", "vessel_b", "distance_nm",
                       "distance_m", "target_ts")
        .agg(F.count_if(F.col("side") == "A").alias("points_a"),
             F.count_if(F.col("side") == "B").alias("points_b"))
        .filter((F.col("points_a") > 0) & (F.col("points_b") > 0))
    )


def event_tracks(points: DataFrame, severe_score: int = SEVERE_SCORE) -> DataFrame:
    """One row per (event, vessel): the time-ordered track (telemetry series)
    as an array of structs, the point count, the display name (first non-empty
    name in time order, else ``MMSI <id>``), the middle point (index ``n // 2``
    from 0) and the event's severity colour. ``legend_label`` is the name cut to
    the legend's ``LEGEND_CHARS`` characters.

    A track holds the pings of one vessel inside one event window: its size is
    bounded by the caller's half window and how often a vessel reports (one to
    a few hundred points at the published ten minutes), not by the data. For windows of
    days use ``track_summary`` and ``track_chunks``, whose rows are bounded.
    """
    g = points.groupBy("event_rank", "side").agg(
        *_track_columns(),
        F.sort_array(F.collect_list(_point())).alias("track"),
    )
    middle = F.element_at("track", (F.floor(F.col("n_points") / 2) + 1).cast("int"))
    return _labelled(g, severe_score).withColumn("middle", middle)


def _point():
    return F.struct("point_no", "ts", "lat", "lon", "sog", "cog", "speed_band")


def _track_columns():
    named = F.when(F.length("vessel_name") > 0, F.col("vessel_name"))
    return (
        F.min("vessel_id").alias("vessel_id"),
        F.max("danger_score").alias("danger_score"),
        F.count(F.lit(1)).alias("n_points"),
        F.min_by(named, F.when(named.isNotNull(), F.col("point_no"))).alias("_name"),
    )


def _labelled(tracks: DataFrame, severe_score: int) -> DataFrame:
    label = F.coalesce(F.col("_name"), F.concat(F.lit("MMSI "), F.col("vessel_id")))
    return tracks.withColumns({
        "vessel_label": label,
        "legend_label": F.substring(label, 1, LEGEND_CHARS),
        "severity": severity("danger_score", severe_score),
    }).drop("_name")


def track_summary(points: DataFrame, severe_score: int = SEVERE_SCORE) -> DataFrame:
    """``event_tracks`` without its arrays, for tracks of any length: sums combine
    map-side, and the middle point is joined by its number."""
    g = points.groupBy("event_rank", "side").agg(*_track_columns())
    half = (F.floor(F.col("n_points") / 2) + 1).cast("int")
    at = points.select("event_rank", "side", "point_no", _point().alias("middle"))
    return _labelled(g, severe_score).withColumn("point_no", half).join(
        at, ["event_rank", "side", "point_no"]).drop("point_no")


def track_chunks(points: DataFrame, chunk_points: int = TRACK_CHUNK_POINTS) -> DataFrame:
    """Tracks in rows of at most ``chunk_points`` points: ``event_rank, side, chunk`` (from 0),
    ``vessel_id, first_point, n_points, track``. Chunks of a track in order are the track
    of ``event_tracks``; a point's chunk follows from its number, so chunks of one track are made in
    many tasks."""
    chunk = F.floor((F.col("point_no") - 1) / F.lit(chunk_points)).cast("int")
    return points.withColumn("chunk", chunk).groupBy("event_rank", "side", "chunk").agg(
        F.min("vessel_id").alias("vessel_id"),
        F.min("point_no").alias("first_point"),
        F.count(F.lit(1)).alias("n_points"),
        F.sort_array(F.collect_list(_point())).alias("track"),
    )
