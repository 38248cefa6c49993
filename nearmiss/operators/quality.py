"""Ping-quality filters: deny list on names, moving pings, reliable vessels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearmiss.config import DENY_TOKENS, MAX_SOG_KN, MIN_PINGS, MIN_SOG_KN


def exclude_named(
    df: DataFrame,
    tokens=DENY_TOKENS,
    *,
    name: str = "name",
    keep_null: bool = False,
) -> DataFrame:
    """Drop pings whose upper-cased name contains any deny token.

    A ping without a name column is kept as is. A null name is dropped (the
    negated ``contains`` is null) unless ``keep_null``.
    """
    if name not in df.columns or not tokens:
        return df
    upper = F.upper(F.col(name))
    keep = reduce(lambda acc, t: acc & ~upper.contains(t.upper()), tokens[1:],
                  ~upper.contains(tokens[0].upper()))
    if keep_null:
        keep = F.col(name).isNull() | keep
    return df.filter(keep)


def moving_pings(
    df: DataFrame,
    min_sog: float = MIN_SOG_KN,
    max_sog: float = MAX_SOG_KN,
    *,
    vessel: str = "vessel_id",
    ts: str = "ts",
    sog: str = "sog",
) -> DataFrame:
    """Pings with an id, a time and a speed in ``[min_sog, max_sog]``."""
    return df.filter(
        F.col(vessel).isNotNull()
        & F.col(ts).isNotNull()
        & (F.col(sog) >= min_sog)
        & (F.col(sog) <= max_sog)
    )


def pings_per_vessel(df: DataFrame, *, vessel: str = "vessel_id") -> DataFrame:
    """``(vessel_id, pings)``; partial counts are combined map-side, so a hot
    vessel costs one row per map task in the shuffle."""
    return (
        df.filter(F.col(vessel).isNotNull())
        .groupBy(vessel)
        .agg(F.count(F.lit(1)).alias("pings"))
    )


def reliable_vessels(
    df: DataFrame,
    min_pings: int = MIN_PINGS,
    *,
    vessel: str = "vessel_id",
    count_col: str = "vessel_pings",
) -> DataFrame:
    """Pings of vessels with at least ``min_pings`` pings in ``df``.

    When ``df`` already carries the per-vessel count (``ping_history`` adds
    ``vessel_pings``) this is a plain filter; otherwise the counts are
    aggregated and semi-joined back, which AQE turns into a broadcast when the
    count table is small at run time.
    """
    if count_col in df.columns:
        return df.filter(F.col(count_col) >= min_pings)
    keep = pings_per_vessel(df, vessel=vessel).filter(F.col("pings") >= min_pings).select(vessel)
    return df.join(keep, on=vessel, how="left_semi")
