"""Danger-score components as Spark Columns.

Every component is a ``when`` chain that falls through to 0 (or to the far-range
points) on nulls, so the total is never null. Column arguments are names or
Columns of the pair row; ``w`` holds the thresholds and points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nearmiss.config import ScoreWeights


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def proximity_points(metres, w: ScoreWeights = ScoreWeights()) -> Column:
    m = _col(metres)
    return (
        F.when(m <= w.near_m, F.lit(w.near_points))
        .when(m <= w.mid_m, F.lit(w.mid_points))
        .otherwise(F.lit(w.far_points))
    )


def course_points(sog_a, sog_b, dcog_a, dcog_b, w: ScoreWeights = ScoreWeights()) -> Column:
    a, b = _col(dcog_a), _col(dcog_b)
    turn = (
        F.when((a > w.sharp_turn_deg) | (b > w.sharp_turn_deg), F.lit(w.sharp_turn_points))
        .when((a > w.turn_deg) | (b > w.turn_deg), F.lit(w.turn_points))
        .otherwise(F.lit(0))
    )
    both_moving = (_col(sog_a) >= w.course_min_sog) & (_col(sog_b) >= w.course_min_sog)
    return F.when(both_moving, turn).otherwise(F.lit(0))


def speed_points(dsog_a, dsog_b, w: ScoreWeights = ScoreWeights()) -> Column:
    a, b = _col(dsog_a), _col(dsog_b)
    return (
        F.when((a <= w.speed_drop_kn) | (b <= w.speed_drop_kn), F.lit(w.speed_drop_points))
        .when((a >= w.speed_gain_kn) | (b >= w.speed_gain_kn), F.lit(w.speed_gain_points))
        .otherwise(F.lit(0))
    )


def stale_penalty(interval_a, w: ScoreWeights = ScoreWeights()) -> Column:
    """Points subtracted when vessel A's previous report is older than the limit."""
    return F.when(_col(interval_a) > w.stale_s, F.lit(w.stale_penalty)).otherwise(F.lit(0))


def signal_points(last_a, last_b, w: ScoreWeights = ScoreWeights()) -> Column:
    return F.when(
        (_col(last_a) == 1) | (_col(last_b) == 1), F.lit(w.last_signal_points)
    ).otherwise(F.lit(0))
