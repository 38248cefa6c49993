"""Danger score of each encounter and the sorted encounter report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearmiss.config import METRES_PER_NM, ScoreWeights
from nearmiss.functions.scoring import (
    course_points,
    proximity_points,
    signal_points,
    speed_points,
    stale_penalty,
)

SCORE_COMPONENTS = (
    "proximity_points", "course_points", "speed_points", "stale_penalty", "signal_points",
)

REPORT_COLUMNS = (
    "danger_score", "vessel_a", "vessel_b", "distance_nm", "distance_m", "ts_a",
    "lat", "lon", "sog_a", "sog_b", "delta_sog_a", "delta_sog_b",
    "delta_cog_a", "delta_cog_b", "interval_a", "group_key",
    # beyond the published report: the other vessel's time and interval, the
    # last-signal flags and every score component, so a row can be re-scored
    "ts_b", "interval_b", "is_last_signal_a", "is_last_signal_b", *SCORE_COMPONENTS,
)



def report_order() -> list:
    """Total order of report rows: score first, then distance, vessels, times."""
    return [
        F.col("danger_score").desc(), F.col("distance_nm").asc(), F.col("vessel_a").asc(),
        F.col("vessel_b").asc(), F.col("ts_a").asc(), F.col("ts_b").asc(),
    ]


def danger_score(pairs: DataFrame, weights: ScoreWeights = ScoreWeights(), *,
                 metres_per_nm: float = METRES_PER_NM) -> DataFrame:
    """Add ``distance_m`` (rounded to 0.1 m), the five score components and
    ``danger_score`` = proximity + course + speed − stale + signal."""
    w = weights
    scored = pairs.withColumn(
        "distance_m", F.round(F.col("distance_nm") * metres_per_nm, 1)
    ).withColumns({
        "proximity_points": proximity_points("distance_m", w),
        "course_points": course_points("sog_a", "sog_b", "delta_cog_a", "delta_cog_b", w),
        "speed_points": speed_points("delta_sog_a", "delta_sog_b", w),
        "stale_penalty": stale_penalty("interval_s_a", w),
        "signal_points": signal_points("is_last_signal_a", "is_last_signal_b", w),
    })
    return scored.withColumn(
        "danger_score",
        F.col("proximity_points") + F.col("course_points") + F.col("speed_points")
        - F.col("stale_penalty") + F.col("signal_points"),
    )


def encounter_report(scored: DataFrame, *, group_key: str = "group_key",
                     sort: bool = True) -> DataFrame:
    """The report projection: one row per encounter, mid-point rounded to 6
    decimals, sorted by score (then distance, vessels, time for a total order).
    """
    out = scored.select(
        "danger_score", F.col("vessel_id_a").alias("vessel_a"),
        F.col("vessel_id_b").alias("vessel_b"), "distance_nm", "distance_m", "ts_a",
        F.round((F.col("lat_a") + F.col("lat_b")) / 2, 6).alias("lat"),
        F.round((F.col("lon_a") + F.col("lon_b")) / 2, 6).alias("lon"),
        "sog_a", "sog_b", "delta_sog_a", "delta_sog_b", "delta_cog_a", "delta_cog_b",
        F.col("interval_s_a").alias("interval_a"),
        F.col(group_key).alias("group_key"),
        "ts_b", F.col("interval_s_b").alias("interval_b"),
        "is_last_signal_a", "is_last_signal_b", *SCORE_COMPONENTS,
    )
    return out.orderBy(*report_order()) if sort else out
