"""Geofence: keep pings within a great-circle radius of a centre."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearmiss.config import EARTH_RADIUS_NM, ZONE_CENTRE_LAT, ZONE_CENTRE_LON, ZONE_RADIUS_NM
from nearmiss.functions.geo import haversine_nm, zone_box


def geofence(
    df: DataFrame,
    centre_lat: float = ZONE_CENTRE_LAT,
    centre_lon: float = ZONE_CENTRE_LON,
    radius_nm: float = ZONE_RADIUS_NM,
    *,
    lat: str = "lat",
    lon: str = "lon",
    box: bool = True,
    distance_col: str | None = None,
    earth_radius_nm: float = EARTH_RADIUS_NM,
) -> DataFrame:
    """Rows whose position is at most ``radius_nm`` from the centre (inclusive).

    A null position is dropped. With ``box`` a latitude/longitude bounding box
    is AND-ed in front of the exact test: plain range comparisons reach the
    Parquet reader as pushed filters (row-group statistics skip whole blocks),
    which the trigonometric test alone cannot. ``distance_col`` keeps the
    distance from the centre in that column.
    """
    dist = haversine_nm(float(centre_lat), float(centre_lon), lat, lon, earth_radius_nm)
    cond = dist <= F.lit(radius_nm)
    if box:
        lat_lo, lat_hi, lon_lo, lon_hi = zone_box(centre_lat, centre_lon, radius_nm, earth_radius_nm)
        pre = (F.col(lat) >= lat_lo) & (F.col(lat) <= lat_hi)
        if lon_lo is not None:
            pre = pre & (F.col(lon) >= lon_lo) & (F.col(lon) <= lon_hi)
        df = df.filter(pre)
    if distance_col:
        return df.withColumn(distance_col, dist).filter(F.col(distance_col) <= F.lit(radius_nm))
    return df.filter(cond)
