import random

import pytest
from pyspark.sql import functions as F

from nearmiss.functions import haversine_nm
from nearmiss.operators import close_pairs, closest_per_pair, crowded_cells, pairs, with_time_bucket
from tests.conftest import plan_text, pings

KEY = ("group_key", "bucket", "event_id_a", "event_id_b")


def _keys(df):
    return sorted(tuple(r[c] for c in KEY) for r in df.collect())


def brute(df, dmax, tolerance_s=None):
    """All pairs of a (group, bucket), or of two pings at most ``tolerance_s`` apart."""
    a = df.select(*[F.col(c).alias(f"{c}_a") for c in df.columns])
    b = df.select(*[F.col(c).alias(f"{c}_b") for c in df.columns])
    if tolerance_s is None:
        when = (F.col("group_key_a") == F.col("group_key_b")) & (F.col("bucket_a") == F.col("bucket_b"))
    else:
        when = F.abs(F.col("epoch_a") - F.col("epoch_b")) <= tolerance_s
    near = haversine_nm("lat_a", "lon_a", "lat_b", "lon_b") <= dmax
    out = a.join(b, when & (F.col("vessel_id_a") < F.col("vessel_id_b")) & near)
    return out.withColumnsRenamed({"group_key_a": "group_key", "bucket_a": "bucket"})


def _bucketed(spark, rows, seconds=10):
    return with_time_bucket(pings(spark, rows), seconds)


def test_no_self_pair_and_string_order(spark):
    df = _bucketed(spark, [
        (1, "9", 0, 55.0, 14.0, 5.0, 0.0),
        (2, "9", 3, 55.0001, 14.0, 5.0, 0.0),
        (3, "10", 5, 55.0002, 14.0, 5.0, 0.0),
    ])
    out = close_pairs(df, 0.054).collect()
    assert {(r.vessel_id_a, r.vessel_id_b) for r in out} == {("10", "9")}
    assert len(out) == 2


def test_bucket_edge_splits_pairs(spark):
    df = _bucketed(spark, [(1, "a", 9, 55.0, 14.0, 5.0, 0.0), (2, "b", 10, 55.0, 14.0, 5.0, 0.0)])
    assert close_pairs(df, 0.054).count() == 0


@pytest.mark.parametrize("centre_lat,centre_lon,spread,dmax", [
    (55.2, 14.2, 0.02, 0.054),
    (0.0, 179.99, 0.02, 0.054),     # over the date line
    (-0.01, -179.995, 0.05, 1.0),   # date line, both hemispheres
    (89.95, 0.0, 0.2, 3.0),         # polar cap
    (-75.0, 60.0, 1.0, 20.0),
    (70.0, -120.0, 2.0, 200.0),
    (0.0, 179.9995, 0.00002, 0.001),  # ~2 m pairs far from the grid origin
])
@pytest.mark.parametrize("cell_factor", [2.0, 4.0, 8.0])
def test_grid_equals_brute_force(spark, centre_lat, centre_lon, spread, dmax, cell_factor):
    rnd = random.Random(hash((centre_lat, centre_lon, dmax)) & 0xFFFF)
    rows = []
    for i in range(700):
        lat = max(-90.0, min(90.0, centre_lat + rnd.uniform(-spread, spread)))
        lon = centre_lon + rnd.uniform(-spread, spread) * 3
        lon = (lon + 180.0) % 360.0 - 180.0
        rows.append((i, f"v{rnd.randint(0, 60)}", rnd.randint(0, 29), lat, lon, 5.0, 0.0))
    df = _bucketed(spark, rows, 10)
    want = _keys(brute(df, dmax))
    assert want, "fixture must contain pairs"
    assert _keys(close_pairs(df, dmax, cell_factor=cell_factor)) == want


@pytest.mark.parametrize("centre_lat,centre_lon,spread,dmax", [
    (55.2, 14.2, 0.02, 0.054), (0.0, 179.99, 0.02, 0.054), (-0.01, -179.995, 0.05, 1.0),
    (89.95, 0.0, 0.2, 3.0), (89.5, 30.0, 2.0, 30.0), (-75.0, 60.0, 1.0, 20.0), (0.0, 179.9995, 0.00002, 0.001),
    (80.0, 0.0, 60.0, 600.0),  # rows of few columns around the pole
])
@pytest.mark.parametrize(("cell_factor", "max_pings"), [(4.0, 1), (9.0, 2)])
def test_crowded_cells_equal_brute_force(spark, centre_lat, centre_lon, spread, dmax, cell_factor, max_pings):
    rnd = random.Random(hash((centre_lat, dmax)) & 0xFFFF)
    rows = []
    for i in range(500):
        lat = max(-90.0, min(90.0, centre_lat + rnd.uniform(-spread, spread)))
        lon = (centre_lon + rnd.uniform(-spread, spread) * 3 + 180.0) % 360.0 - 180.0
        rows.append((i, f"v{rnd.randint(0, 60)}", rnd.randint(0, 29), lat, lon, 5.0, 0.0))
    df = _bucketed(spark, rows, 10)
    cells = crowded_cells(df, dmax, cell_factor=cell_factor, max_pings=max_pings)
    assert cells.count() > 0 or max_pings > 1
    assert _keys(close_pairs(df, dmax, cell_factor=cell_factor, crowded=cells)) == _keys(brute(df, dmax))


def test_crowded_cells_with_a_tolerance(spark):
    rnd = random.Random(5)
    rows = [(i, f"v{rnd.randint(0, 25)}", 79200 + rnd.randint(-60, 60), 55.0 + rnd.uniform(0, 0.002),
             14.0 + rnd.uniform(0, 0.003), 5.0, 0.0) for i in range(300)]
    df = _bucketed(spark, rows)
    cells = crowded_cells(df, 0.054, tolerance_s=5, max_pings=2)
    assert cells.count() > 0
    key = lambda p: sorted((r.event_id_a, r.event_id_b) for r in p.collect())
    assert key(close_pairs(df, 0.054, tolerance_s=5, crowded=cells)) == key(brute(df, 0.054, 5))


def _candidates(df, dmax, crowded=None):
    """Pairs that the join compares, and the largest number in one of its keys, by counts of the keys."""
    a, b, _, *_ = pairs._join_sides(df, dmax, "group_key", "bucket", "vessel_id", "lat", "lon", 4.0, None, "epoch", 3440.065, crowded)
    parts = (["_part"], ["_part_b"]) if crowded is not None else ([], [])
    na = a.groupBy("group_key", "bucket", "_cy", "_cx", *parts[0]).agg(F.count("*").alias("na"))
    nb = b.groupBy(F.col("_g").alias("group_key"), F.col("_k").alias("bucket"), F.col("_cy_b").alias("_cy"), F.col("_cx_b").alias("_cx"),
                   *[F.col(c).alias("_part") for c in parts[1]]).agg(F.count("*").alias("nb"))
    r = na.join(nb, ["group_key", "bucket", "_cy", "_cx", *parts[0]]).agg(
        F.sum(F.col("na") * F.col("nb")), F.max(F.col("na") * F.col("nb"))).first()
    return r[0], r[1]


def test_a_harbour_of_many_pings_in_one_cell(spark, workdir):
    """100,000 pings in one bucket of about one cell: under half the candidates (four cells in a row would give a
    quarter), and none of the join keys of the old size."""
    from nearmiss.plans import materialize

    lat0, lon0, side = 55.0, 14.0, 0.054 * 4 / 60  # about a cell
    ids = spark.range(100_000)
    df = ids.select(
        F.col("id").alias("event_id"), F.concat(F.lit("v"), F.col("id")).alias("vessel_id"),
        F.to_date(F.lit("2021-12-13")).alias("group_key"), F.lit(1).alias("bucket"), F.lit(0).alias("epoch"),
        (lat0 + side * F.pmod(F.xxhash64("id"), F.lit(99991)) / 99991).alias("lat"),
        (lon0 + 1.7 * side * F.pmod(F.xxhash64("id", F.lit(1)), F.lit(99991)) / 99991).alias("lon"))
    cells = materialize(crowded_cells(df, 0.054), f"{workdir}/cells")
    fixed, fixed_key = _candidates(df, 0.054)
    finer, finer_key = _candidates(df, 0.054, cells)
    assert fixed > 2 * finer and fixed_key > 10 * finer_key, (fixed, finer, fixed_key, finer_key)
    few = df.filter("event_id % 50 = 0")
    cells = materialize(crowded_cells(few, 0.054, max_pings=100), f"{workdir}/few")
    got = close_pairs(few, 0.054, crowded=cells)
    assert "BroadcastHashJoin" in plan_text(got) and "SortMergeJoin" in plan_text(got)
    assert _keys(got) == _keys(close_pairs(few, 0.054)) and got.count() > 10_000


def test_grid_pair_over_cell_corner_found_once(spark):
    # both points straddle row and column boundaries of the grid
    df = _bucketed(spark, [
        (1, "a", 0, -0.0001, -0.0003, 5.0, 0.0), (2, "b", 1, 0.0002, 0.0003, 5.0, 0.0),
        (3, "c", 2, 0.0, 179.9999, 5.0, 0.0), (4, "d", 3, 0.0, -179.9999, 5.0, 0.0),
    ])
    got = _keys(close_pairs(df, 0.054))
    assert got == _keys(brute(df, 0.054))
    assert len(got) == 2


def test_closest_per_pair_ties_and_groups(spark):
    df = _bucketed(spark, [
        (1, "a", 0, 55.0, 14.0, 5.0, 0.0), (2, "b", 1, 55.0, 14.0005, 5.0, 0.0),
        (3, "a", 20, 55.0, 14.0, 5.0, 0.0), (4, "b", 21, 55.0, 14.0005, 5.0, 0.0),
        (5, "a", 86400, 55.0, 14.0, 5.0, 0.0), (6, "b", 86401, 55.0, 14.0007, 5.0, 0.0),
    ])
    best = closest_per_pair(close_pairs(df, 0.054),
                            tie_break=("ts_a", "event_id_a", "ts_b", "event_id_b")).collect()
    assert sorted((r.group_key.day, r.event_id_a, r.event_id_b) for r in best) == [(13, 1, 2), (14, 5, 6)]


def test_result_independent_of_partitioning(spark):
    rnd = random.Random(11)
    rows = [(i, f"v{rnd.randint(0, 20)}", rnd.randint(0, 59), 55.0 + rnd.uniform(0, 0.003),
             14.0 + rnd.uniform(0, 0.005), 5.0, 0.0) for i in range(400)]
    df = _bucketed(spark, rows)
    tb = ("ts_a", "event_id_a", "ts_b", "event_id_b")
    base = _keys(closest_per_pair(close_pairs(df, 0.054), tie_break=tb))
    for n in (1, 3, 17):
        assert _keys(closest_per_pair(close_pairs(df.repartition(n), 0.054), tie_break=tb)) == base


def test_pair_join_is_a_shuffle_join(spark):
    df = _bucketed(spark, [(1, "a", 0, 55.0, 14.0, 5.0, 0.0), (2, "b", 1, 55.0, 14.0, 5.0, 0.0)])
    plan = plan_text(close_pairs(df, 0.054))
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("tol", [1, 5, 30])
def test_time_tolerance_equals_brute_force(spark, tol):
    rnd = random.Random(tol)
    midnight = 79200  # seconds from the fixture's time to the next day
    rows = [(i, f"v{rnd.randint(0, 25)}", midnight + rnd.randint(-60, 60), 55.0 + rnd.uniform(0, 0.002),
             14.0 + rnd.uniform(0, 0.003), 5.0, 0.0) for i in range(300)]
    df = _bucketed(spark, rows)
    found = brute(df, 0.054, tol).collect()
    want = sorted((r.event_id_a, r.event_id_b) for r in found)
    assert any(r.group_key != r.group_key_b for r in found)
    got = close_pairs(df, 0.054, tolerance_s=tol).collect()
    assert sorted((r.event_id_a, r.event_id_b) for r in got) == want
    assert {(r.event_id_a, r.group_key) for r in got} == {(r.event_id_a, r.group_key) for r in found}
    # one second apart across a bucket edge: missed by buckets, found by tolerance
    edge = _bucketed(spark, [(1, "a", 9, 55.0, 14.0, 5.0, 0.0), (2, "b", 10, 55.0, 14.0, 5.0, 0.0)])
    assert close_pairs(edge, 0.054).count() == 0
    assert close_pairs(edge, 0.054, tolerance_s=tol).count() == 1
    # a group that isn't a date parts pings in this mode too
    filed = df.withColumn("group_key", F.concat(F.lit("file"), F.col("event_id") % 2))
    pairs = close_pairs(filed, 0.054, tolerance_s=tol).collect()
    assert sorted((r.event_id_a, r.event_id_b) for r in pairs) == [
        (x, y) for x, y in want if x % 2 == y % 2]


def test_one_second_over_midnight(spark):
    df = _bucketed(spark, [(1, "a", 79199, 55.0, 14.0, 5.0, 0.0), (2, "b", 79200, 55.0, 14.0, 5.0, 0.0)])
    assert [r.group_key.day for r in close_pairs(df, 0.054, tolerance_s=5).collect()] == [13]


def test_hot_cell_is_split_by_aqe(spark):
    """One (day, bucket, cell) holds far more rows than the others: AQE's
    skew-join handling splits it (thresholds lowered to the test's size), and
    the pairs still equal brute force."""
    rnd = random.Random(5)
    rows = [(i, f"h{i % 150}", 3, 55.0 + rnd.uniform(0, 0.0002), 14.0 + rnd.uniform(0, 0.0003),
             5.0, 0.0) for i in range(300)]
    rows += [(1000 + i, f"v{i % 40}", rnd.randint(0, 7200), 55.0 + rnd.uniform(0, 0.05),
              14.0 + rnd.uniform(0, 0.08), 5.0, 0.0) for i in range(1000)]
    df = _bucketed(spark, rows)
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        pairs = close_pairs(df, 0.054)
        got = sorted((r.event_id_a, r.event_id_b) for r in pairs.collect())
        final = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert "isFinalPlan=true" in final and "skew" in final.lower()
    assert got == sorted((r.event_id_a, r.event_id_b) for r in brute(df, 0.054).collect())
    assert len(got) > 20000
