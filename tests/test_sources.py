import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from nearmiss.operators import event_targets, top_encounters
from nearmiss.plans import ingest, ingest_new_files, materialize
from nearmiss.sources.reports import REPORT_HEADERS
from nearmiss.sources import (
    REPORT_SCHEMA,
    accepted,
    from_report_layout,
    normalize_pings,
    parse_pings,
    read_ping_lake,
    read_pings_csv,
    read_report,
    rejected,
    rejected_pings,
    rejected_report,
    with_source,
    write_ping_lake,
    write_report,
)

from tests.conftest import pings, plan_text  # noqa: E402

RAW = [
    ("13/12/2021 02:27:29", "219021240", "55.223082", "14.244318", "10.3", "35.5", "A"),
    ("13/12/2021 02:27:30", "12x", "55.2", "14.2", "1", "2", "B"),
    ("13/12/2021 02:27:31", "9999999999", "55.2", "14.2", "1", "2", "C"),
    ("2021-12-13T02:27:32", "219021240", "55.2", "14.2", "1", "2", "D"),
    ("13/12/2021 02:27:33", "", "55.2", "14.2", "1", "2", "E"),
    ("13/12/2021 02:27:34", "219021240", "", "14.2", "", "2", None),
    ("14/12/2021 00:00:00", "0219021241", "55.3", "abc", "1", "2", "F"),
]
HEADER = ["# Timestamp", "MMSI", "Latitude", "Longitude", "SOG", "COG", "Name"]


def _raw(spark):
    return spark.createDataFrame(RAW, HEADER)


def test_normalize_and_reject(spark):
    ok = normalize_pings(_raw(spark)).orderBy("ts").collect()
    assert [(r.vessel_id, r.ts, r.lat, r.sog) for r in ok] == [
        ("219021240", dt.datetime(2021, 12, 13, 2, 27, 29), 55.223082, 10.3),
        ("219021240", dt.datetime(2021, 12, 13, 2, 27, 34), None, None),
    ]
    assert ok[0].name == "A" and ok[0].mmsi == 219021240
    bad = {r.Name: r.reject_reason for r in rejected_pings(_raw(spark)).collect()}
    assert bad == {"B": "bad_vessel_id", "C": "bad_vessel_id", "D": "bad_time",
                   "E": "missing_vessel_id", "F": "bad_lon"}
    assert normalize_pings(_raw(spark)).count() + rejected_pings(_raw(spark)).count() == len(RAW)


def test_csv_to_lake_roundtrip_and_pruning(spark, workdir):
    _raw(spark).write.option("header", "true").csv(f"{workdir}/csv")
    typed = normalize_pings(read_pings_csv(spark, f"{workdir}/csv"))
    write_ping_lake(typed, f"{workdir}/lake")
    back = read_ping_lake(spark, f"{workdir}/lake")
    assert back.count() == 2
    assert {(r.Year, r.Month, r.Day) for r in back.collect()} == {(2021, 12, 13)}
    one_day = read_ping_lake(spark, f"{workdir}/lake", "2021-12-14", "2021-12-31")
    assert one_day.count() == 0
    plan = plan_text(one_day)
    assert "PartitionFilters: [" in plan and "make_date" in plan.lower()
    src = with_source(read_ping_lake(spark, f"{workdir}/lake")).collect()
    assert all(r.source_file.endswith(".parquet") for r in src)


def _events_of(spark, path):
    return sorted(r.event_id for r in read_ping_lake(spark, path).collect())


def test_lake_modes(spark, workdir):
    p = pings(spark, [(1, "a", 0, 55.0, 14.0, 5.0, 0.0), (2, "a", 86400, 55.0, 14.0, 5.0, 0.0),
                      (3, "b", 10, 55.0, 14.0, 5.0, 0.0)])
    lake = f"{workdir}/lake"
    write_ping_lake(p.filter("event_id < 3"), lake)
    write_ping_lake(p.filter("event_id = 3"), lake, "append")  # a late ping of a stored day
    assert _events_of(spark, lake) == [1, 2, 3]
    write_ping_lake(p.filter("event_id = 1"), lake, replace_days=["2021-12-13"])
    assert _events_of(spark, lake) == [1, 2]
    with pytest.raises(Exception, match="not to be replaced"):
        write_ping_lake(p, lake, replace_days=["2021-12-13"])
    write_ping_lake(p.filter("event_id = 3"), lake)
    assert _events_of(spark, lake) == [3]


def _drop(spark, path, rows, header="Timestamp,MMSI,Latitude,Longitude,SOG,COG,Name"):
    text = spark.createDataFrame([(",".join(r),) for r in rows], [header])
    text.coalesce(1).write.mode("append").option("header", "true").option("sep", "\u0001").csv(path)


ROW = ("13/12/2021 02:27:29", "219", "55.2", "14.2", "10.3", "35.5", "A")


def test_two_drops_lose_nothing(spark, workdir):
    rows = [("13/12/2021 02:%02d:00" % m, *ROW[1:]) for m in range(20)]
    _drop(spark, f"{workdir}/one", [*rows, ("x", *ROW[1:])])
    _drop(spark, f"{workdir}/two", [("13/12/2021 01:00:00", *ROW[1:]), ("14/12/2021 01:00:00", *ROW[1:]),
                                    (ROW[0], "", *ROW[2:])])
    for drop in ("one", "two"):
        ingest(spark, f"{workdir}/{drop}", f"{workdir}/lake", rejected_path=f"{workdir}/bad")
    assert read_ping_lake(spark, f"{workdir}/lake").count() == 22
    assert sorted(r.reject_reason for r in spark.read.parquet(f"{workdir}/bad").collect()) == [
        "bad_time", "missing_vessel_id"]
    ingest(spark, f"{workdir}/two", f"{workdir}/lake", rejected_path=f"{workdir}/bad", mode="overwrite")
    assert read_ping_lake(spark, f"{workdir}/lake").count() == 2
    assert spark.read.parquet(f"{workdir}/bad").count() == 1


def test_new_files_are_ingested_once(spark, workdir):
    csv, lake, done = f"{workdir}/csv", f"{workdir}/lake", f"{workdir}/done"
    _drop(spark, csv, [ROW])
    assert len(ingest_new_files(spark, csv, lake, done)) == 1
    assert ingest_new_files(spark, csv, lake, done) == []
    _drop(spark, csv, [("14/12/2021 00:00:01", "220", *ROW[2:])])
    assert len(ingest_new_files(spark, csv, lake, done)) == 1
    got = sorted((r.Day, r.vessel_id) for r in read_ping_lake(spark, lake).collect())
    assert got == [(13, "219"), (14, "220")]


def test_csv_columns_by_name_and_malformed_rows(spark, workdir):
    _drop(spark, workdir, [ROW, ROW[:5], (*ROW, "more"), ("bad", *ROW[1:])])
    swapped = "MMSI,Timestamp,Longitude,Latitude,Name,Extra"
    _drop(spark, workdir, [("220", ROW[0], "14.2", "55.2", "B", "e")], swapped)
    raw = read_pings_csv(spark, workdir)
    good = {r.name: r for r in normalize_pings(raw).collect()}
    assert {(r.lat, r.lon) for r in good.values()} == {(55.2, 14.2)} and set(good) == {"A", "B"}
    assert good["B"].sog is None and good["B"].Extra == "e"
    assert "corrupt_record" not in normalize_pings(raw).columns
    bad = rejected_pings(raw).collect()
    assert sorted(r.reject_reason for r in bad) == ["bad_time", "malformed_row", "malformed_row"]
    assert sum(r.corrupt_record is not None for r in bad) == 2
    wanted = read_pings_csv(spark, workdir, "MMSI string, Latitude string, Nothing int")
    assert wanted.columns == ["MMSI", "Latitude", "Nothing", "corrupt_record"]


def test_ingest_parses_the_csv_once(spark, workdir):
    """Both outputs read the parsed rows that were written down."""
    _drop(spark, f"{workdir}/csv", [ROW, ("x", *ROW[1:])])
    raw = read_pings_csv(spark, f"{workdir}/csv")
    assert plan_text(raw, "simple").count("FileScan csv") == 1
    parsed = materialize(parse_pings(raw), f"{workdir}/parsed")
    for out in (accepted(parsed), rejected(parsed, raw.columns)):
        assert "Scan csv" not in plan_text(out) and out.count() == 1


def test_report_feeds_the_event_stage(spark, workdir):
    import __spark_entry__ as E

    rep = E._report(spark, "/root/testdata/sf0.001", E.FLAGSHIP_CFG, sort=True)
    write_report(rep, f"{workdir}/report")
    back = from_report_layout(read_report(spark, f"{workdir}/report"))
    key = lambda df: [(r.event_rank, r.vessel_a, r.vessel_b, r.ts_a) for r in df.orderBy("event_rank").collect()]
    assert key(top_encounters(back, 20)) == key(top_encounters(rep, 20))
    spoiled = from_report_layout(read_report(spark, f"{workdir}/report").withColumn("TS_A", F.lit("?")))
    assert event_targets(top_encounters(spoiled, 20)).count() == 0


def test_report_csv_roundtrip(spark, workdir):
    rep = spark.createDataFrame(
        [(165, "219", "220", 0.04, 74.7, dt.datetime(2021, 12, 1, 6, 1, 34), 55.1, 14.2, 10.3, 11.1,
          4.2, -0.7, 35.5, 0.9, 11, dt.date(2021, 12, 1))],
        "danger_score int, vessel_a string, vessel_b string, distance_nm double, distance_m double, "
        "ts_a timestamp_ntz, lat double, lon double, sog_a double, sog_b double, delta_sog_a double, "
        "delta_sog_b double, delta_cog_a double, delta_cog_b double, interval_a long, group_key date")
    write_report(rep, f"{workdir}/report")
    (r,) = read_report(spark, f"{workdir}/report").collect()
    assert (r.Danger_Score, r.MMSI_A, r.TS_A, r.Report_Interval_Sec_1, r.File_Source) == (
        165, "219", "2021-12-01 06:01:34", 11, "2021-12-01")


def test_report_may_be_written_compressed(spark, workdir):
    rep = spark.createDataFrame([(k, str(k), "9", 0.5, dt.datetime(2021, 12, 1)) for k in range(50)],
                                "danger_score int, vessel_a string, vessel_b string, distance_nm double, ts_a timestamp_ntz")
    for header, col in REPORT_HEADERS:
        if col not in rep.columns:
            rep = rep.withColumn(col, F.lit(None).cast(REPORT_SCHEMA[header].dataType))
    write_report(rep, f"{workdir}/plain")
    write_report(rep, f"{workdir}/small", compression="gzip")
    assert all(f.endswith(".csv") for f in os.listdir(f"{workdir}/plain") if f.startswith("part"))
    assert all(f.endswith(".csv.gz") for f in os.listdir(f"{workdir}/small") if f.startswith("part"))
    rows = lambda name: sorted(map(str, read_report(spark, f"{workdir}/{name}").collect()))
    assert len(rows("small")) == 50 and rows("small") == rows("plain")
    assert rejected_report(spark, f"{workdir}/small").count() == 0


def test_with_source_keeps_pushdown(spark, workdir):
    from pyspark.sql import functions as F

    p = pings(spark, [(1, "a", 0, 55.0, 14.0, 5.0, 0.0), (2, "a", 86400, 55.5, 14.0, 5.0, 0.0)])
    write_ping_lake(p, f"{workdir}/lake")
    lake = with_source(read_ping_lake(spark, f"{workdir}/lake", "2021-12-14", "2021-12-14"))
    q = lake.filter(F.col("lat") > 55.2)
    plan = plan_text(q)
    assert "GreaterThan(lat,55.2)" in plan.split("PushedFilters:")[1].split("\n")[0]
    assert "make_date" in plan.split("PartitionFilters:")[1].split("\n")[0].lower()
    assert [r.event_id for r in q.collect()] == [2]


def test_report_is_read_by_name_and_bad_rows_rejected(spark, workdir):
    _drop(spark, workdir, [("220", "7", "2021-12-01 06:01:34", "1.5"), ("220", "7", "x"), ("220", "7", "y", "far")],
          "MMSI_B,Danger_Score,TS_A,Distance_NM")
    (r,) = read_report(spark, workdir).collect()
    assert (r.Danger_Score, r.MMSI_B, r.TS_A, r.Distance_NM, r.MMSI_A) == (7, "220", "2021-12-01 06:01:34", 1.5, None)
    assert list(r.asDict()) == [f.name for f in REPORT_SCHEMA]
    assert sorted(x.corrupt_record for x in rejected_report(spark, workdir).collect()) == ["220,7,x", "220,7,y,far"]
    nothing = f"{workdir}/none"
    spark.range(0).select(F.lit("").alias("v")).write.text(nothing)
    assert read_report(spark, nothing).count() == 0 == rejected_report(spark, nothing).count()


def test_headers_are_found_in_one_job(spark, workdir):
    """However many files and headers there are; long files are read a block, empty ones skipped."""
    import os

    from nearmiss.sources.headers import LAST_BATCH, LINES, files_by_header

    for i in range(60):
        with open(f"{workdir}/f{i}.csv", "w") as f:
            f.write("\ufeffA,B\r\n1,2\r\n" if i % 2 else "B,A\n" + "2,1\n" * (LINES * (LAST_BATCH + 3) if i == 0 else 1))
    open(f"{workdir}/empty.csv", "w").close()
    spark.sparkContext.setJobGroup("headers", "")
    try:
        found = files_by_header(spark, workdir)
    finally:
        spark.sparkContext.setJobGroup(None, None)
    assert {h: len(f) for h, f in found.items()} == {"A,B": 30, "B,A": 30}
    assert all(os.path.exists(f.removeprefix("file:")) for files in found.values() for f in files)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) == 1


def test_report_parts_in_name_order_are_report_order(spark, workdir):
    import csv
    import glob

    import __spark_entry__ as E

    rep = E._report(spark, "/root/testdata/sf0.001", E.FLAGSHIP_CFG, sort=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_report(rep, f"{workdir}/report")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(glob.glob(f"{workdir}/report/part-*.csv"))
    assert len(parts) > 1
    rows = [r for p in parts for r in csv.DictReader(open(p))]
    want = [(r.danger_score, r.vessel_a, r.vessel_b) for r in rep.collect()]
    assert [(int(r["Danger_Score"]), r["MMSI_A"], r["MMSI_B"]) for r in rows] == want


def test_wall_clock_kept_in_a_daylight_saving_gap(spark):
    raw = spark.createDataFrame([("27/03/2022 02:30:00", "219")], ["# Timestamp", "MMSI"])
    spark.conf.set("spark.sql.session.timeZone", "Europe/Copenhagen")
    try:
        (r,) = normalize_pings(raw).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r.ts == dt.datetime(2022, 3, 27, 2, 30)
    (u,) = normalize_pings(raw).collect()
    assert u.ts == dt.datetime(2022, 3, 27, 2, 30)


def test_lake_writes_few_files_per_day(spark, workdir):
    import glob

    from nearmiss.sources import ping_view

    # 30 days of pings from an input spread over many tasks
    write_ping_lake(ping_view(spark, "/root/testdata/sf0.01").repartition(16), f"{workdir}/lake")
    days = glob.glob(f"{workdir}/lake/Year=*/Month=*/Day=*")
    files = glob.glob(f"{workdir}/lake/Year=*/Month=*/Day=*/*.parquet")
    assert len(days) == 30 and len(files) <= 2 * len(days)
