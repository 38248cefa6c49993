"""Day-partitioned Parquet ping lake: calendar parts, writer, pruned reader,
row lineage."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearmiss.sources import batches
from nearmiss.sources.batches import read_consistently

LAKE_PARTITIONS = ("Year", "Month", "Day")


def with_calendar_parts(df: DataFrame, *, ts: str = "ts") -> DataFrame:
    """Add ``Year, Month, Day`` (ints) of the ping time."""
    return (
        df.withColumn("Year", F.year(ts))
        .withColumn("Month", F.month(ts))
        .withColumn("Day", F.dayofmonth(ts))
    )


def write_ping_lake(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    *,
    vessel: str = "vessel_id",
    ts: str = "ts",
    partitions: int | None = None,
    replace_days=None,
) -> None:
    """Write pings as Parquet partitioned by ``Year/Month/Day``.

    ``mode`` ``"overwrite"`` replaces the whole lake, ``"append"`` adds to it (a
    drop with late pings of earlier days loses nothing). ``replace_days`` (dates)
    replaces just those days that have rows in ``df``, whatever ``mode``, and
    fails if ``df`` has a row of any other day.

    Rows are rebalanced on the day (Spark's ``rebalance`` hint): a hash
    exchange on the partition columns whose partitions AQE sizes at run time,
    splitting a busy day over several tasks and merging small days, so files
    are few and of even size, and no sampling pass over the input is needed
    (range partitioning would read a CSV input one more time). Each task sorts
    by (day, vessel, time), so every file covers a narrow vessel/time range and
    Parquet min/max statistics prune row groups for vessel or time filters.
    """
    if "Year" not in df.columns:
        df = with_calendar_parts(df, ts=ts)
    if replace_days is not None:
        days = [F.lit(_as_date(d)) for d in replace_days]
        named = F.coalesce(F.make_date("Year", "Month", "Day").isin(days), F.lit(False))
        df = df.filter(F.assert_true(named, "a row of a day that is not to be replaced").isNull())
    hint = (partitions, *LAKE_PARTITIONS) if partitions else LAKE_PARTITIONS
    laid = df.hint("rebalance", *hint).sortWithinPartitions(*LAKE_PARTITIONS, vessel, ts)
    writer = laid.write.mode("overwrite" if replace_days is not None else mode)
    writer = writer.option("partitionOverwriteMode", "static" if replace_days is None else "dynamic")
    writer.partitionBy(*LAKE_PARTITIONS).parquet(path)


def _as_date(d) -> _dt.date | None:
    if d is None or isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d))


def read_ping_lake(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Read the lake; ``start``/``end`` (dates, inclusive) become a predicate on
    the partition columns only, so Spark reads just those days. Batches that are
    just being published or compacted are seen as a whole or not at all."""
    return _between(read_consistently(spark, path), start, end)


def _between(df: DataFrame, start, end) -> DataFrame:
    day = F.make_date("Year", "Month", "Day")
    start, end = _as_date(start), _as_date(end)
    if start is not None:
        df = df.filter(day >= F.lit(start))
    if end is not None:
        df = df.filter(day <= F.lit(end))
    return df


#: Size that lake files should have, and the share of it from which a file is left alone.
FILE_BYTES = 256 << 20
FULL = 0.75
#: Files that one batch of a compaction replaces, about.
BATCH_FILES = 20_000


def compact_ping_lake(spark: SparkSession, path: str, *, file_bytes: int = FILE_BYTES, start=None, end=None) -> int:
    """Rewrite the small files of days that have more of them than they need; returns how
    many files were replaced.

    Many drops leave many small files in a day. Of each day the files under three quarters of
    ``file_bytes`` are rewritten together if that makes them fewer; full ones are left alone, so
    a day that grows isn't rewritten as a whole each time. The rewrite has the layout of
    ``write_ping_lake``, and replaces the old files in one step for the readers of the lake
    (``batches``): no row is lost or read twice, whatever breaks off, and a broken-off
    compaction is finished by the next writer. The driver sees one number for each day, and the
    names of the files of one batch. ``start`` and ``end`` limit it to those days.
    """
    batches.finish(spark, path)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    listed = _between(listed, start, end).filter(F.col("length") < FULL * file_bytes)
    small = listed.select(*LAKE_PARTITIONS, "path", "length")
    days = small.groupBy(*LAKE_PARTITIONS).agg(F.count("*").alias("n"), F.sum("length").alias("bytes"))
    days = days.filter(F.make_date(*LAKE_PARTITIONS).isNotNull() & (F.col("n") > F.greatest(F.ceil(F.col("bytes") / F.lit(file_bytes)), F.lit(1))))
    rounds: list[list] = []
    for day in days.orderBy(*LAKE_PARTITIONS).collect():
        if not rounds or sum(d.n for d in rounds[-1]) + day.n > BATCH_FILES:
            rounds.append([])
        rounds[-1].append(day)
    done = 0
    for chosen in rounds:
        # a filter on the partition columns: files of days that an earlier round replaced aren't looked at
        dates = [F.lit(_dt.date(d.Year, d.Month, d.Day)) for d in chosen]
        names = sorted(r.path for r in small.filter(F.make_date(*LAKE_PARTITIONS).isin(dates)).collect())
        name, folder = batches.stage(path)
        rows = spark.read.option("basePath", path).parquet(*names)
        write_ping_lake(rows, f"{folder}/lake", "overwrite")
        batches.commit(spark, path, name, into={"lake": path}, gone=names)
        batches.finish(spark, path)
        done += len(names)
    return done


def lake_files(spark: SparkSession, path: str) -> DataFrame:
    """``group_key, file``: the day and name of every data file of the lake; none is opened. (One
    write gives its files the same name in every day.)"""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    name = F.regexp_extract("path", "[^/]*$", 0)
    return listed.select(F.make_date(*LAKE_PARTITIONS).alias("group_key"), name.alias("file"))


def with_source(df: DataFrame, out: str = "source_file") -> DataFrame:
    """Add the base name of the file each row was read from.

    Uses the ``_metadata.file_name`` column, which (unlike
    ``input_file_name()``) leaves filter and partition pushdown intact. Only
    for DataFrames read from files.
    """
    return df.withColumn(out, F.col("_metadata.file_name"))
