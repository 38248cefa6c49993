"""Ping views over the driver's test tables.

The test tables hold no AIS data, so a deterministic view maps the ``events``
table onto pings: one user is one vessel, the value and the ``k`` property
place it in a 1°×1° box around the default zone centre, and the value also
gives speed. The same mapping is written in SQL for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearmiss.functions.motion import truncate_to_second

# Fixed values of the view (lat/lon base point = default zone centre).
VIEW_LAT0 = 55.225
VIEW_LON0 = 14.245


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def _ping_exprs() -> dict:
    """The view's columns as expressions over the ``events`` table."""
    k = F.get_json_object("props", "$.k").cast("int")
    step = (F.round(F.col("value") * 100).cast("long") * 37) % 1000 - 500
    ts = truncate_to_second("ts")
    return {
        "event_id": F.col("event_id"),
        "vessel_id": F.col("user_id").cast("string"),
        "ts": ts,
        "lat": F.lit(VIEW_LAT0) + step / F.lit(1000.0),
        "lon": F.lit(VIEW_LON0) + (k - 50) / F.lit(100.0),
        "sog": F.round(F.col("value") % 50, 1),
        "cog": F.round(k * 3.6, 1),
        "name": F.col("event_type"),
        "group_key": F.to_date(ts),
    }


def ping_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, vessel_id, ts, lat, lon, sog, cog, name, group_key`` from
    ``events``; ``ts`` is cut to whole seconds, ``group_key`` is its date."""
    ev = load_table(spark, sf_dir, "events")
    return ev.select(*[c.alias(n) for n, c in _ping_exprs().items()])


def odd_ping_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ping_view`` with gaps: by the event id some names are null, blank or padded,
    and some speeds and courses null."""
    e, eid = _ping_exprs(), F.col("event_id")
    odd = {
        "name": F.when(eid % 3 == 0, F.lit(None)).when(eid % 3 == 1, F.lit("  "))
        .when(eid % 5 == 0, F.concat(F.lit(" "), e["name"], F.lit(" "))).otherwise(e["name"]),
        "sog": F.when(eid % 17 != 0, e["sog"]),
        "cog": F.when(eid % 13 != 0, e["cog"]),
    }
    ev = load_table(spark, sf_dir, "events")
    return ev.select(*[c.alias(n) for n, c in (e | odd).items()])


def raw_ping_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ping view as raw AIS text (CSV-like, all strings), with a fixed share
    of rows spoiled so that the reject path has work: ids of events divisible
    by 97 read ``12x``, times of events divisible by 89 are in ISO form."""
    ev = load_table(spark, sf_dir, "events")
    e = _ping_exprs()
    eid = F.col("event_id")
    # the text patterns drop sub-seconds themselves, so the stored time is
    # formatted directly
    return ev.select(
        eid.cast("string").alias("event_id"),
        F.when(eid % 89 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm:ss")).alias("# Timestamp"),
        F.when(eid % 97 == 0, F.lit("12x")).otherwise(e["vessel_id"]).alias("MMSI"),
        e["lat"].cast("string").alias("Latitude"),
        e["lon"].cast("string").alias("Longitude"),
        e["sog"].cast("string").alias("SOG"),
        e["cog"].cast("string").alias("COG"),
        e["name"].alias("Name"),
    )
