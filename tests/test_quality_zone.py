import random

from nearmiss.functions import haversine_nm
from nearmiss.operators import (
    exclude_named,
    geofence,
    moving_pings,
    pings_per_vessel,
    reliable_vessels,
)
from tests.conftest import plan_text, pings


def test_exclude_named(spark):
    df = pings(spark, [
        (1, "1", 0, 55.0, 14.0, 5.0, 0.0, None),
        (2, "1", 1, 55.0, 14.0, 5.0, 0.0, "pilot 1"),
        (3, "1", 2, 55.0, 14.0, 5.0, 0.0, "xKBVx"),
        (4, "1", 3, 55.0, 14.0, 5.0, 0.0, "Maersk"),
    ])
    ids = lambda d: sorted(r.event_id for r in d.collect())
    assert ids(exclude_named(df)) == [4]
    assert ids(exclude_named(df, keep_null=True)) == [1, 4]
    assert ids(exclude_named(df.drop("name"))) == [1, 2, 3, 4]


def test_moving_pings_inclusive_range(spark):
    df = pings(spark, [(i, "1", i, 55.0, 14.0, s, 0.0) for i, s in
                       enumerate([2.0, 45.0, 1.9, 45.1, None])])
    assert sorted(r.event_id for r in moving_pings(df).collect()) == [0, 1]


def test_reliable_vessels_counts_slow_pings(spark):
    rows = [(i, "9p", i, 55.0, 14.0, 5.0, 0.0) for i in range(9)]
    rows += [(100 + i, "10p", i, 55.0, 14.0, 0.5 if i % 2 else 5.0, 0.0) for i in range(10)]
    df = pings(spark, rows)
    kept = {r.vessel_id for r in reliable_vessels(df, 10).collect()}
    assert kept == {"10p"}
    counts = {r.vessel_id: r.pings for r in pings_per_vessel(df).collect()}
    assert counts == {"9p": 9, "10p": 10}


def test_geofence_edge_and_null(spark):
    # a point exactly on the radius: use the distance of a real point as radius
    df = pings(spark, [(1, "1", 0, 55.5, 14.6, 5.0, 0.0), (2, "1", 1, None, 14.6, 5.0, 0.0),
                       (3, "1", 2, 56.5, 14.6, 5.0, 0.0)])
    r = df.select(haversine_nm(55.225, 14.245, "lat", "lon").alias("d")).first().d
    kept = sorted(x.event_id for x in geofence(df, 55.225, 14.245, r).collect())
    assert kept == [1]


def test_geofence_box_loses_nothing(spark):
    rnd = random.Random(7)
    rows = [(i, "v", i, 55.225 + rnd.uniform(-2, 2), 14.245 + rnd.uniform(-3, 3), 1.0, 0.0)
            for i in range(3000)]
    df = pings(spark, rows)
    for radius in (10.0, 50.0, 100.0):
        boxed = {r.event_id for r in geofence(df, 55.225, 14.245, radius, box=True).collect()}
        exact = {r.event_id for r in geofence(df, 55.225, 14.245, radius, box=False).collect()}
        assert boxed == exact and exact


def test_geofence_box_reaches_parquet(spark, workdir):
    df = pings(spark, [(1, "1", 0, 55.5, 14.6, 5.0, 0.0)])
    df.write.parquet(f"{workdir}/p")
    plan = plan_text(geofence(spark.read.parquet(f"{workdir}/p")))
    assert "GreaterThanOrEqual(lat" in plan and "LessThanOrEqual(lon" in plan


def test_reliable_vessels_two_paths_agree(spark):
    from nearmiss.operators import ping_history
    from nearmiss.sources import ping_view

    view = ping_view(spark, "/root/testdata/sf0.01")
    by_join = {r.event_id for r in reliable_vessels(view, 65).collect()}
    by_history = {r.event_id for r in reliable_vessels(ping_history(view, ("ts", "event_id")), 65)
                  .collect()}
    assert by_join == by_history and by_join
