"""Per-vessel ping history: previous speed/course/time, next time, last signal."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearmiss.config import DENSE_SLICE_PARTS, DENSE_SLICE_PINGS, HISTORY_SLICE_SECONDS
from nearmiss.functions.motion import course_change, epoch_seconds, speed_change

# Slice number given to pings without a time; sorts before every real slice,
# just as a null time sorts first in the vessel's order.
_NO_TIME_SLICE = -(2**62)


def with_changes(df: DataFrame, ts: str = "ts", sog: str = "sog", cog: str = "cog") -> DataFrame:
    """Add what follows from a ping's own and its neighbours' values: ``interval_s``, ``delta_sog``,
    ``delta_cog`` and ``is_last_signal``."""
    return df.withColumns({
        "interval_s": epoch_seconds(ts) - epoch_seconds("prev_ts"),
        "delta_sog": speed_change(sog, "prev_sog"),
        "delta_cog": course_change(cog, "prev_cog"),
        "is_last_signal": F.when(F.col("next_ts").isNull(), 1).otherwise(0),
    })


def _slice(ts: str, slice_seconds: int):
    return F.coalesce(F.floor(epoch_seconds(ts) / F.lit(slice_seconds)), F.lit(_NO_TIME_SLICE))


def _micros(ts: str):
    """Microseconds of a time, whatever its zone: of the same use within one vessel's pings."""
    return F.unix_micros(F.col(ts).cast("timestamp"))


def dense_slices(
    df: DataFrame,
    *,
    vessel: str = "vessel_id",
    ts: str = "ts",
    slice_seconds: int = HISTORY_SLICE_SECONDS,
    max_pings: int = DENSE_SLICE_PINGS,
    parts: int = DENSE_SLICE_PARTS,
) -> DataFrame:
    """``vessel, _slice, _bounds``: the (vessel, time slice) groups with over ``max_pings`` pings, and
    the times that cut each into ``parts`` parts of about equally many.

    One id can send without end (spoofed or shared ids), so a slice of fixed length bounds no
    task. Counts are combined map-side; the quantiles (a mergeable sketch) are taken of the dense
    groups only, at most one row for every ``max_pings`` pings. Pings of one vessel at one
    moment stay together, as do those without a time, which the ingest rejects.
    """
    pings = df.filter(F.col(vessel).isNotNull() & F.col(ts).isNotNull())
    pings = pings.select(vessel, _slice(ts, slice_seconds).alias("_slice"), _micros(ts).alias("_us"))
    crowded = pings.groupBy(vessel, "_slice").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_pings)
    hot = pings.join(crowded.select(vessel, "_slice"), [vessel, "_slice"], "left_semi")
    shares = [k / parts for k in range(1, parts)]
    return hot.groupBy(vessel, "_slice").agg(F.array_distinct(F.percentile_approx("_us", shares, 100 * parts)).alias("_bounds"))


def ping_history(
    df: DataFrame,
    order_by=("ts", "lat", "lon", "sog", "cog"),
    *,
    vessel: str = "vessel_id",
    ts: str = "ts",
    sog: str = "sog",
    cog: str = "cog",
    slice_seconds: int | None = HISTORY_SLICE_SECONDS,
    dense: DataFrame | None = None,
) -> DataFrame:
    """Add each ping's history within its vessel's time-ordered track.

    Adds ``prev_sog, prev_cog, prev_ts`` (previous ping), ``next_ts``,
    ``interval_s`` (seconds since the previous ping, null on the first),
    ``delta_sog`` (rounded to 2, null on the first), ``delta_cog`` (folded
    course change, 0.0 on the first), ``is_last_signal`` (1 when the vessel has
    no later ping in ``df``) and ``vessel_pings`` (the vessel's ping count).

    ``order_by`` must be a total order within a vessel (end it with a unique
    row id when one exists) so that results do not depend on partitioning.
    Pings without a vessel id have no history and are dropped.

    With ``slice_seconds`` the window runs per (vessel, time slice), so a
    vessel id with a huge share of the rows is spread over many tasks; the
    first and last ping of every slice are then stitched to the neighbouring
    slices through a per-slice summary (one row per vessel and slice). It is
    read off the window's own boundary rows, which lie where the window put
    them, and joined back on the same keys, so the pings are scanned and
    shuffled once. ``slice_seconds=None`` runs one window
    per vessel (one task holds each vessel's whole history): small data only.

    ``dense`` (``dense_slices`` of the same pings, written as a table so that its size
    is known) cuts the slices that hold very many pings further, at times
    between which about equally many lie. Any table gives the same result.
    """
    order = [F.col(c) for c in order_by]
    pings = df.filter(F.col(vessel).isNotNull())

    if not slice_seconds:
        w = Window.partitionBy(vessel).orderBy(*order)
        out = pings.withColumns({
            "prev_sog": F.lag(sog).over(w),
            "prev_cog": F.lag(cog).over(w),
            "prev_ts": F.lag(ts).over(w),
            "next_ts": F.lead(ts).over(w),
            "vessel_pings": F.count(F.lit(1)).over(Window.partitionBy(vessel)),
        })
        return with_changes(out, ts, sog, cog)

    pings = pings.withColumn("_slice", _slice(ts, slice_seconds))
    if dense is None:
        pings = pings.withColumn("_part", F.lit(0))
    else:
        cuts = dense.select(F.col(vessel).alias("_dense_vessel"), F.col("_slice").alias("_dense_slice"), "_bounds")
        found = (F.col(vessel) == F.col("_dense_vessel")) & (F.col("_slice") == F.col("_dense_slice"))
        before = F.size(F.filter("_bounds", lambda b: b <= _micros(ts)))
        pings = pings.join(cuts, found, "left").withColumn("_part", F.coalesce(before, F.lit(0)))
        pings = pings.drop("_dense_vessel", "_dense_slice", "_bounds")
    keys = (vessel, "_slice", "_part")
    w = Window.partitionBy(*keys).orderBy(*order)
    local = pings.withColumns({
        "_rn": F.row_number().over(w),
        "_more": F.lead(F.lit(1)).over(w),
        "prev_sog": F.lag(sog).over(w),
        "prev_cog": F.lag(cog).over(w),
        "prev_ts": F.lag(ts).over(w),
        "next_ts": F.lead(ts).over(w),
    })
    # One row per (vessel, slice) from the first and the last row of each; what
    # is summed up lies together already. ``_whole`` (never null) names every
    # column, so that this branch needs the same exchange as the other one and
    # Spark shuffles the pings once for both.
    plain = [f.name for f in pings.schema if not isinstance(f.dataType, T.MapType)]
    first, last = F.col("_rn") == 1, F.col("_more").isNull()
    per_slice = local.filter(first | last).groupBy(*keys).agg(
        F.max(F.when(last, F.col("_rn"))).cast("long").alias("_n"),
        F.max(F.when(last, F.col(sog))).alias("_last_sog"),
        F.max(F.when(last, F.col(cog))).alias("_last_cog"),
        F.max(F.when(last, F.col(ts))).alias("_last_ts"),
        F.min(F.when(first, F.col(ts))).alias("_first_ts"),
        F.max(F.when(last, F.hash(*[F.col(f"`{c}`") for c in plain]))).alias("_whole"),
    ).filter(F.col("_whole").isNotNull())
    sw = Window.partitionBy(vessel).orderBy("_slice", "_part")
    stitch = per_slice.select(
        *keys,
        F.lag("_last_sog").over(sw).alias("_before_sog"),
        F.lag("_last_cog").over(sw).alias("_before_cog"),
        F.lag("_last_ts").over(sw).alias("_before_ts"),
        F.lead("_first_ts").over(sw).alias("_after_ts"),
        F.sum("_n").over(Window.partitionBy(vessel)).alias("vessel_pings"),
    )
    # The stitch table grows with vessels × slices: keep it a shuffle join on
    # the window's own partitioning keys (the pings are not shuffled again).
    out = (
        local.join(stitch.hint("merge"), list(keys), "inner")
        .withColumns({
            "prev_sog": F.when(first, F.col("_before_sog")).otherwise(F.col("prev_sog")),
            "prev_cog": F.when(first, F.col("_before_cog")).otherwise(F.col("prev_cog")),
            "prev_ts": F.when(first, F.col("_before_ts")).otherwise(F.col("prev_ts")),
            "next_ts": F.when(last, F.col("_after_ts")).otherwise(F.col("next_ts")),
        })
        .drop("_slice", "_part", "_rn", "_more", "_before_sog", "_before_cog", "_before_ts", "_after_ts")
    )
    return with_changes(out, ts, sog, cog)
