import datetime as dt

from nearmiss.operators import (
    complete_events,
    event_targets,
    event_track_points,
    event_tracks,
    incident_report,
    incident_summary,
    top_encounters,
)
from tests.conftest import T0, pings, plan_text, ts

REPORT = ("danger_score int, vessel_a string, vessel_b string, distance_nm double, "
          "distance_m double, ts_a timestamp_ntz, ts_b timestamp_ntz, sog_a double, sog_b double")


def _report(spark, rows):
    return spark.createDataFrame(rows, REPORT)


def test_top_encounters_total_order(spark):
    rep = _report(spark, [
        (50, "1", "2", 0.02, 37.0, ts(0), ts(1), 5.0, 5.0),
        (50, "1", "3", 0.01, 18.5, ts(0), ts(1), 5.0, 5.0),
        (90, "4", "5", 0.03, 55.6, ts(0), ts(1), 5.0, 5.0),
        (10, "6", "7", 0.03, 55.6, None, ts(1), 5.0, 5.0),
    ])
    top = top_encounters(rep, 3).orderBy("event_rank").collect()
    assert [(r.event_rank, r.vessel_a, r.vessel_b) for r in top] == [(1, "4", "5"), (2, "1", "3"), (3, "1", "2")]
    targets = event_targets(top_encounters(rep, 4)).collect()
    assert sorted(r.event_rank for r in targets) == [1, 2, 3]  # rank 4 has no time
    t = {r.event_rank: r for r in targets}[1]
    assert t.window_start == T0 - dt.timedelta(minutes=10) and t.window_end == T0 + dt.timedelta(minutes=10)
    assert t.event_key == "Top_1_Score_90_20211213_020000_4_5"


def _points(spark):
    rep = _report(spark, [(95, "a", "b", 0.02, 37.0, ts(0), ts(0), 5.0, 5.0),
                          (40, "c", "d", 0.02, 37.0, ts(0), ts(0), 5.0, 5.0)])
    zone = pings(spark, [
        (1, "a", -600, 55.0, 14.0, 1.0, 10.0, None),
        (2, "a", -300, 55.0, 14.0, None, None, " "),
        (3, "a", 0, 55.0, 14.0, 6.0, 30.0, "X"),
        (4, "a", 300, 55.0, 14.0, 13.0, 40.0, "Y"),
        (5, "a", 601, 55.0, 14.0, 13.0, 40.0, "Z"),
        (6, "b", 600, 55.0, 14.0, 0.05, 0.0, None),
        (7, "c", 0, 55.0, 14.0, 5.0, 0.0, "C"),
    ])
    targets = event_targets(top_encounters(rep, 5))
    return rep, zone, targets


def test_track_points_window_and_fills(spark):
    _, zone, targets = _points(spark)
    pts = event_track_points(zone, targets, tie_break=("event_id",))
    got = {(r.event_rank, r.ts): r for r in pts.collect()}
    assert sorted(k[1] for k in got if k[0] == 1) == [ts(-600), ts(-300), ts(0), ts(300), ts(600)]
    p = got[(1, ts(-300))]
    assert p.sog == 0.0 and p.cog == 0.0 and p.speed_band == "blue" and p.vessel_name == ""
    assert [got[(1, ts(s))].point_no for s in (-600, -300, 0, 300)] == [1, 2, 3, 4]
    plan = plan_text(pts)
    assert "NestedLoop" not in plan and "BroadcastHashJoin" in plan


def test_complete_events_and_tracks(spark):
    rep, zone, targets = _points(spark)
    pts = event_track_points(zone, targets, tie_break=("event_id",))
    complete = complete_events(pts).collect()
    assert [(r.event_rank, r.points_a, r.points_b) for r in complete] == [(1, 4, 1)]
    tracks = {(r.event_rank, r.side): r for r in event_tracks(pts).collect()}
    a = tracks[(1, "A")]
    assert a.vessel_label == "X" and a.n_points == 4 and a.middle.ts == ts(0)
    assert a.severity == "red" and [p.point_no for p in a.track] == [1, 2, 3, 4]
    assert tracks[(1, "B")].vessel_label == "MMSI b"
    cards = incident_report(top_encounters(rep, 5), complete_events(pts)).collect()
    assert [(c.event_rank, c.distance_m, c.distance_nm_4) for c in cards] == [(1, 37.0, 0.02)]


def test_track_points_prune_days(spark, workdir):
    _, zone, targets = _points(spark)
    zone.write.partitionBy("group_key").parquet(f"{workdir}/zone")
    lake = spark.read.parquet(f"{workdir}/zone")
    pts = event_track_points(lake, targets, tie_break=("event_id",), partition_days="group_key")
    assert pts.count() == 6
    plan = plan_text(pts)
    assert "dynamicpruning" in plan.lower()
    # joined by size, never by a nested loop
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def _many_events(spark):
    """A vessel of one ping a second for a day, with 40 events; another of one a minute."""
    import random

    rnd = random.Random(2)
    day = [(k, "a", k, 55.0, 14.0, 5.0, 0.0, "A" if k % 7 else None) for k in range(0, 80000, 20)]
    day += [(100000 + k, "b", k, 55.0, 14.0, 5.0, 0.0, "B") for k in range(0, 80000, 60)]
    rows = [(50, "a", "b", 0.01 * (k + 1), 18.5, ts(rnd.randrange(0, 80000)), ts(0), 5.0, 5.0) for k in range(40)]
    return pings(spark, day), event_targets(top_encounters(_report(spark, rows), 40))


def test_time_cells_bound_the_candidates(spark):
    """Equal to the plain range join, with at most about twice its rows compared."""
    from pyspark.sql import functions as F

    zone, targets = _many_events(spark)
    key = lambda d: sorted((r.event_rank, r.side, r.ts) for r in d.collect())
    t, p = targets.alias("t"), zone.alias("p")
    plain = p.join(t, F.col("p.ts").between(F.col("t.window_start"), F.col("t.window_end"))).select(
        "event_rank", "ts", F.when(F.col("vessel_id") == F.col("vessel_a"), "A").when(F.col("vessel_id") == F.col("vessel_b"), "B").alias("side"))
    want = key(plain)
    for kind in (None, "group_key"):
        for seconds in (1200, 7, 100_000):
            assert key(event_track_points(zone, targets, partition_days=kind, cell_seconds=seconds)) == want
    # rows of equal keys, without the residual range
    cell = F.floor(F.unix_timestamp("ts") / 1200)
    cells = targets.select("event_rank", F.explode(F.array("vessel_a", "vessel_b")).alias("vessel_id"), F.explode(F.sequence(
        F.floor(F.unix_timestamp("window_start") / 1200), F.floor(F.unix_timestamp("window_end") / 1200))).alias("cell"))
    compared = zone.withColumn("cell", cell).join(cells, ["vessel_id", "cell"]).count()
    assert len(want) <= compared <= 2.2 * len(want)
    assert zone.join(targets.select(F.explode(F.array("vessel_a", "vessel_b")).alias("vessel_id")), "vessel_id").count() > 10 * compared


def test_long_tracks_in_chunks(spark):
    from nearmiss.operators import track_chunks, track_summary

    zone, targets = _many_events(spark)
    pts = event_track_points(zone, targets, tie_break=("event_id",))
    whole = {(r.event_rank, r.side): r for r in event_tracks(pts).collect()}
    chunks = track_chunks(pts, 7).collect()
    assert max(len(r.track) for r in chunks) == 7
    for k, r in whole.items():
        mine = sorted((c for c in chunks if (c.event_rank, c.side) == k), key=lambda c: c.chunk)
        assert [p for c in mine for p in c.track] == r.track
        assert [c.first_point for c in mine] == list(range(1, r.n_points + 1, 7)) and sum(c.n_points for c in mine) == r.n_points
    columns = ("vessel_id", "vessel_label", "legend_label", "n_points", "severity", "middle")
    assert {(r.event_rank, r.side): tuple(r[c] for c in columns) for r in track_summary(pts).collect()} == {
        k: tuple(r[c] for c in columns) for k, r in whole.items()}


def test_legend_label_is_cut(spark):
    zone = pings(spark, [(1, "a", 0, 55.0, 14.0, 5.0, 0.0, "A name of many letters"), (2, "b", 0, 55.0, 14.0, 5.0, 0.0, None)])
    _, _, targets = _points(spark)
    got = {r.side: (r.vessel_label, r.legend_label) for r in event_tracks(event_track_points(zone, targets)).collect()}
    assert got == {"A": ("A name of many letters", "A name of many "), "B": ("MMSI b", "MMSI b")}


def test_incident_summary(spark):
    rep = _report(spark, [(50, "1", "2", 0.02, 37.0, ts(0), ts(1), 5.0, 5.0),
                          (90, "4", "5", 0.03, 55.6, ts(5), ts(1), 5.0, 5.0),
                          (90, "3", "5", 0.03, 55.6, ts(9), ts(1), 5.0, 5.0)])
    (s,) = incident_summary(rep).collect()
    assert (s.total_incidents, s.top_score, s.top_vessel_a, s.top_vessel_b) == (3, 90, "3", "5")


def test_track_points_without_name_column(spark):
    _, zone, targets = _points(spark)
    pts = event_track_points(zone.drop("name"), targets, tie_break=("event_id",))
    assert {r.vessel_name for r in pts.collect()} == {""}
    labels = {(r.event_rank, r.side): r.vessel_label for r in event_tracks(pts).collect()}
    assert labels[(1, "A")] == "MMSI a" and labels[(1, "B")] == "MMSI b"


def test_track_points_prune_year_month_day_lake(spark, workdir):
    from nearmiss.sources import read_ping_lake, write_ping_lake

    _, zone, targets = _points(spark)
    write_ping_lake(zone, f"{workdir}/lake")
    lake = read_ping_lake(spark, f"{workdir}/lake")
    plain = event_track_points(zone, targets, tie_break=("event_id",))
    pruned = event_track_points(lake, targets, tie_break=("event_id",),
                                partition_days=("Year", "Month", "Day"))
    key = lambda d: sorted((r.event_rank, r.side, r.point_no, r.ts) for r in d.collect())
    assert key(pruned) == key(plain)
    assert "dynamicpruning" in plan_text(pruned).lower()


def test_pings_go_to_the_targets_where_these_are_many(spark):
    """Blocks and cells of several pings: the same points, one row of a target, and no shuffle after the join."""
    from pyspark.sql import functions as F

    from nearmiss.operators import BLOCK_PAIR
    from nearmiss.operators.pairs import PairBlocks

    zone, targets = _many_events(spark)
    # an event over midnight, one of unknown vessels, one of an unnamed vessel, one twice
    extra = targets.limit(4).withColumns({
        "window_end": F.when(F.col("event_rank") % 4 == 1, F.col("window_end") + F.make_dt_interval(days=F.lit(1))).otherwise(F.col("window_end")),
        "vessel_a": F.when(F.col("event_rank") % 4 == 2, F.lit(None)).when(F.col("event_rank") % 4 == 3, F.lit("x")).otherwise(F.col("vessel_a")),
        "event_rank": F.col("event_rank") + 100})
    targets = targets.unionAll(extra).unionAll(targets.limit(1))
    columns = ("event_rank", "vessel_a", "vessel_b", "side", "vessel_id", "ts", "point_no", "sog", "vessel_name")
    key = lambda d: sorted(map(str, d.select(*columns).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for days in (None, "group_key"):
            want = key(event_track_points(zone, targets, tie_break=("event_id",), partition_days=days))
            assert len(want) > 2000
            for cells, blocks in ((2, None), (3, PairBlocks(1, 2)), (1, PairBlocks(3, 5)), (50, PairBlocks(4, 3))):
                got = event_track_points(zone, targets, tie_break=("event_id",), partition_days=days,
                                         window_cells=cells, blocks=blocks)
                assert key(got) == want
        counted = got.groupBy("event_rank", "vessel_a", "vessel_b", "side", *BLOCK_PAIR).count()
        plan = plan_text(counted, "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Exchange") == 2 and "Exchange" not in plan[:plan.index("SortMergeJoin")]


def test_every_encounter_as_an_event_moves_each_once(spark, tmp_path):
    """``all_events`` on crowded pings: its targets are dealt before their sides and cells are made."""
    import __spark_entry__ as E

    rows = [(k, ts(60 * (k % 240)).replace(year=2024), k % 25, "view", 5.0 + 10 * (k % 3), '{"k": 50}') for k in range(1500)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = E.q_all_events(spark, str(tmp_path))
        plan = plan_text(out, "simple")
        assert out.count() > 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "Exchange" not in plan[:plan.index("SortMergeJoin")]
