"""Great-circle helpers as Spark Columns (JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from nearmiss.config import EARTH_RADIUS_NM

# Relative slack on every bound so that rounding (in the trig functions and in
# fractional cell coordinates far from the origin) can never push a true
# neighbour out of its cell or box. It only widens candidate sets; the exact
# distance test decides.
_SLACK = 1e-7


def _col(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(float(x))


def haversine_nm(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_NM) -> Column:
    """Great-circle distance in nautical miles, ``2·atan2(√h, √(1−h))·R``.

    Arguments are column names, Columns or numbers (degrees). A null coordinate
    gives a null distance.
    """
    args = (lat1, lon1, lat2, lon2)
    if all(isinstance(v, (str, int, float)) for v in args):
        # names and numbers: one parsed expression instead of a Column tree
        a1, o1, a2, o2 = (f"`{v}`" if isinstance(v, str) else f"{float(v)!r}D" for v in args)
        h = (f"(pow(sin(radians({a2} - {a1}) / 2.0D), 2.0D) + cos(radians({a1})) * "
             f"cos(radians({a2})) * pow(sin(radians({o2} - {o1}) / 2.0D), 2.0D))")
        return F.expr(f"2.0D * atan2(sqrt({h}), sqrt(1.0D - {h})) * {float(radius)!r}D")
    la1, lo1, la2, lo2 = (_col(v) for v in args)
    h = F.pow(F.sin(F.radians(la2 - la1) / 2), 2) + F.cos(F.radians(la1)) * F.cos(
        F.radians(la2)
    ) * F.pow(F.sin(F.radians(lo2 - lo1) / 2), 2)
    return F.lit(2.0) * F.atan2(F.sqrt(h), F.sqrt(F.lit(1.0) - h)) * F.lit(radius)


def lat_halfwidth_deg(distance_nm: float, radius: float = EARTH_RADIUS_NM) -> float:
    """Largest latitude difference of two points ``distance_nm`` apart."""
    return math.degrees(distance_nm / radius) * (1 + _SLACK)


def lon_halfwidth_deg(distance_nm: float, max_abs_lat: float, radius: float = EARTH_RADIUS_NM):
    """Largest longitude difference of two points at most ``distance_nm`` apart
    whose latitudes are both within ``±max_abs_lat``; None when unbounded."""
    if max_abs_lat >= 90.0:
        return None
    arg = math.sin(distance_nm / (2 * radius)) / math.cos(math.radians(max_abs_lat))
    if arg >= 1.0:
        return None
    return 2 * math.degrees(math.asin(arg)) * (1 + _SLACK)


def zone_box(centre_lat: float, centre_lon: float, radius_nm: float,
             radius: float = EARTH_RADIUS_NM):
    """Bounding box ``(lat_lo, lat_hi, lon_lo, lon_hi)`` of a circle; the longitude
    pair is None when the circle reaches a pole or crosses the ±180° seam."""
    dlat = lat_halfwidth_deg(radius_nm, radius)
    lat_lo, lat_hi = centre_lat - dlat, centre_lat + dlat
    if lat_lo <= -90.0 or lat_hi >= 90.0:
        return lat_lo, lat_hi, None, None
    dlon = lon_halfwidth_deg(radius_nm, max(abs(lat_lo), abs(lat_hi)), radius)
    if dlon is None or centre_lon - dlon < -180.0 or centre_lon + dlon > 180.0:
        return lat_lo, lat_hi, None, None
    return lat_lo, lat_hi, centre_lon - dlon, centre_lon + dlon


# Cell side of the pair grid in multiples of the pair distance. Larger cells
# copy fewer points into neighbouring cells (less shuffle) but compare more
# candidates per cell; 4 suits sparse traffic (about 2.25 copies per point).
GRID_CELL_FACTOR = 4.0


def grid_cell_height(distance_nm: float, radius: float = EARTH_RADIUS_NM,
                     cell_factor: float = GRID_CELL_FACTOR) -> float:
    """Height (degrees) of a grid row: ``cell_factor`` times the largest
    latitude difference of two points ``distance_nm`` apart."""
    return cell_factor * lat_halfwidth_deg(distance_nm, radius)


def grid_row(lat, distance_nm: float, radius: float = EARTH_RADIUS_NM,
             cell_factor: float = GRID_CELL_FACTOR) -> Column:
    """Fractional row coordinate ``lat / height`` (floor it for the row index)."""
    return _col(lat) / F.lit(grid_cell_height(distance_nm, radius, cell_factor))


def grid_reach_deg(row: Column, distance_nm: float, radius: float = EARTH_RADIUS_NM,
                   cell_factor: float = GRID_CELL_FACTOR) -> Column:
    """Largest longitude difference (degrees) of two points ``distance_nm``
    apart whose latitudes lie in rows ``row-1 .. row+1``; 360 near the poles,
    where longitude gives no bound."""
    height = grid_cell_height(distance_nm, radius, cell_factor)
    max_abs = F.greatest(F.abs(row - 1), F.abs(row + 2)) * F.lit(height)
    arg = F.lit(math.sin(distance_nm / (2 * radius))) / F.cos(F.radians(F.least(max_abs, F.lit(90.0))))
    reach = F.lit(2.0 * (1 + _SLACK)) * F.degrees(F.asin(F.least(arg, F.lit(1.0))))
    return F.when(arg < 1.0, reach).otherwise(F.lit(360.0))


def grid_columns(reach_deg: Column, cell_factor: float = GRID_CELL_FACTOR) -> Column:
    """Number of equal longitude columns of a row whose longitude reach is
    ``reach_deg``: each column is at least ``cell_factor`` reaches wide, so a
    point reaches at most its nearer neighbouring column (a long, at least 1)."""
    return F.greatest(F.floor(F.lit(360.0) / (F.lit(cell_factor) * reach_deg)), F.lit(1).cast("long"))


def grid_column(lon, ncols: Column) -> Column:
    """Fractional column coordinate of a longitude in a row of ``ncols`` equal
    columns, in ``[0, ncols)`` (floor it for the column index)."""
    x = (_col(lon) + F.lit(180.0)) / (F.lit(360.0) / ncols)
    return x - F.floor(x / ncols) * ncols
