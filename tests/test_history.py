import random

from nearmiss.operators import ping_history
from tests.conftest import plan_text, pings

COLS = ["event_id", "prev_sog", "prev_cog", "prev_ts", "next_ts", "interval_s", "delta_sog",
        "delta_cog", "is_last_signal", "vessel_pings"]


def _rows(df):
    return sorted(tuple(r[c] for c in COLS) for r in df.collect())


def test_first_last_single(spark):
    df = pings(spark, [
        (1, "a", 0, 55.0, 14.0, 10.0, 350.0),
        (2, "a", 30, 55.0, 14.0, 12.5, 10.0),
        (3, "a", 90, 55.0, 14.0, 11.0, 40.0),
        (4, "b", 5, 55.0, 14.0, 3.0, 0.0),
    ])
    got = {r.event_id: r for r in ping_history(df, ("ts", "event_id")).collect()}
    first, mid, last, single = got[1], got[2], got[3], got[4]
    assert first.prev_sog is None and first.interval_s is None and first.delta_sog is None
    assert first.delta_cog == 0.0 and first.is_last_signal == 0
    assert mid.delta_sog == 2.5 and mid.delta_cog == 20.0 and mid.interval_s == 30
    assert last.is_last_signal == 1 and last.next_ts is None
    assert single.is_last_signal == 1 and single.prev_ts is None and single.delta_cog == 0.0
    assert {r.vessel_pings for r in got.values() if r.vessel_id == "a"} == {3}


def test_slices_equal_single_window(spark):
    rnd = random.Random(3)
    rows, eid = [], 0
    for v in range(6):
        t = rnd.randint(0, 500)
        for _ in range(rnd.randint(1, 60)):
            t += rnd.choice([0, 1, 30, 599, 600, 601, 3599, 3600, 7300])
            rows.append((eid, f"v{v}", t, 55.0, 14.0, round(rnd.uniform(0, 20), 1),
                         round(rnd.uniform(0, 359.9), 1)))
            eid += 1
    df = pings(spark, rows)
    order = ("ts", "event_id")
    base = _rows(ping_history(df, order, slice_seconds=None))
    for s in (600, 3600, 86400):
        assert _rows(ping_history(df, order, slice_seconds=s)) == base


def _hot_vessel(n):
    """A third of all pings are one vessel's, within a minute of one hour; the rest are spread."""
    rnd = random.Random(8)
    hot = [(i, "hot", 3600 + rnd.randint(0, 59), 55.0, 14.0, round(rnd.uniform(0, 20), 1), rnd.uniform(0, 359.9)) for i in range(n)]
    rest = [(n + i, f"v{rnd.randint(0, 40)}", rnd.randint(0, 9000), 55.0, 14.0, round(rnd.uniform(0, 20), 1), rnd.uniform(0, 359.9))
            for i in range(2 * n)]
    return hot + rest


def test_dense_slice_is_spread_and_equals_the_plain_window(spark, workdir):
    from nearmiss.operators import dense_slices
    from nearmiss.plans import materialize

    df = pings(spark, _hot_vessel(3000)).repartition(4)
    found = dense_slices(df, max_pings=500, parts=16)
    (cut,) = found.collect()
    assert cut.vessel_id == "hot" and 12 <= len(cut._bounds) <= 15
    dense = materialize(found, f"{workdir}/dense")
    out = ping_history(df, ("ts", "event_id"), dense=dense)
    assert _rows(out) == _rows(ping_history(df, ("ts", "event_id"), slice_seconds=None))
    assert set(out.columns) == set(ping_history(df, ("ts", "event_id")).columns)
    # the join with the cuts moves no pings, and both branches of the history share one exchange
    plan = plan_text(out)
    assert "BroadcastHashJoin LeftOuter" in plan
    # no window of the hot vessel is much over its share
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        from pyspark.sql import functions as F

        sizes = [r.n for r in ping_history(df, ("ts", "event_id"), dense=dense).filter("vessel_id = 'hot'")
                 .groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        fixed = [r.n for r in ping_history(df, ("ts", "event_id")).filter("vessel_id = 'hot'")
                 .groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert fixed == [3000] and len(sizes) >= 8 and max(sizes) < 1000


def test_no_slice_is_dense(spark):
    from nearmiss.operators import dense_slices

    df = pings(spark, _hot_vessel(30))
    none = dense_slices(df, max_pings=500)
    assert none.count() == 0
    assert _rows(ping_history(df, ("ts", "event_id"), dense=none)) == _rows(ping_history(df, ("ts", "event_id")))


def test_null_time_sorts_first_and_null_vessel_dropped(spark):
    df = pings(spark, [
        (1, "a", None, 55.0, 14.0, 7.0, 90.0),
        (2, "a", 10, 55.0, 14.0, 9.0, 100.0),
        (3, None, 20, 55.0, 14.0, 9.0, 100.0),
    ])
    for s in (None, 3600):
        got = {r.event_id: r for r in ping_history(df, ("ts", "event_id"), slice_seconds=s).collect()}
        assert set(got) == {1, 2}
        assert got[2].prev_sog == 7.0 and got[2].delta_cog == 10.0
        assert got[1].is_last_signal == 0 and got[2].is_last_signal == 1


def test_hot_vessel_is_spread_over_slices(spark):
    df = pings(spark, [(i, "hot", i * 60, 55.0, 14.0, 5.0, 0.0) for i in range(600)])
    h = ping_history(df, ("ts", "event_id"), slice_seconds=3600)
    plan = plan_text(h)
    assert "_slice" in plan
    rows = _rows(h)
    assert rows == _rows(ping_history(df, ("ts", "event_id"), slice_seconds=None))
    assert sum(r[8] for r in rows) == 1


def test_vessel_with_a_third_of_rows_spreads_over_tasks(spark):
    from pyspark.sql import functions as F

    from nearmiss.sources import ping_view

    view = ping_view(spark, "/root/testdata/sf0.01")
    # a third of all rows under one vessel id (shared or spoofed ids do this)
    hot = view.withColumn("vessel_id", F.when(F.col("event_id") % 3 == 0, F.lit("0"))
                          .otherwise(F.col("vessel_id")))
    sliced = ping_history(hot, ("ts", "event_id"), slice_seconds=3600)
    # small test data would be coalesced into one partition; look at the keys
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = (sliced.filter(F.col("vessel_id") == "0")
                 .select(F.spark_partition_id().alias("p")).distinct().count())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = ping_history(hot, ("ts", "event_id"), slice_seconds=None)
    cols = ["event_id", "prev_ts", "next_ts", "delta_sog", "delta_cog", "vessel_pings"]
    assert sorted(map(tuple, sliced.select(cols).collect())) == sorted(
        map(tuple, whole.select(cols).collect()))
