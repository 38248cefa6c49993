import random

import pytest
from pyspark.sql import functions as F

from nearmiss import EncounterConfig
from nearmiss.operators import close_pairs, closest_per_pair, pair_blocks, with_time_bucket
from nearmiss.operators.pairs import PairBlocks
from nearmiss.plans import detect_encounters, extract_events, materialize, stages
from tests.conftest import pings, plan_text

TIE = ("ts_a", "event_id_a", "ts_b", "event_id_b")


def _crowd(spark, n=300, vessels=40, seed=3):
    """Pings of few vessels near each other and around midnight, some of them twice or without an id."""
    rnd = random.Random(seed)
    rows = [(i, None if i % 50 == 0 else f"v{rnd.randint(0, vessels)}", 79200 + rnd.randint(-30, 30),
             55.0 + rnd.uniform(0, 0.003), 14.0 + rnd.uniform(0, 0.005), 5.0, 0.0) for i in range(n)]
    return with_time_bucket(pings(spark, rows + rows[:20]), 10)


def _rows(df):
    return sorted(tuple(r) for r in df.select(
        "group_key", "vessel_id_a", "vessel_id_b", "event_id_a", "event_id_b", "distance_nm").collect())


@pytest.mark.parametrize("tolerance_s", [None, 5])
def test_blocks_give_the_same_rows(spark, tolerance_s):
    df = _crowd(spark)
    for blocks in (PairBlocks(1, 3), PairBlocks(5, 7)):
        plain = close_pairs(df, 0.054, tolerance_s=tolerance_s)
        cut = close_pairs(df, 0.054, tolerance_s=tolerance_s, blocks=blocks)
        assert len(_rows(plain)) > 300 and _rows(cut) == _rows(plain)
        best = closest_per_pair(cut, tie_break=TIE)
        assert _rows(best) == _rows(closest_per_pair(plain, tie_break=TIE))
        assert set(best.columns) == set(plain.columns)


def test_pairs_found_by_blocks_are_not_shuffled(spark):
    df = _crowd(spark)

    def after_the_join(blocks):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            plan = plan_text(closest_per_pair(close_pairs(df, 0.054, blocks=blocks), tie_break=TIE), "simple")
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
        return plan[:plan.index("SortMergeJoin")].count("Exchange")

    assert after_the_join(None) == 1
    assert after_the_join(PairBlocks(4, 8)) == 0


def test_blocks_follow_the_number_of_pairs(spark):
    crowd = _crowd(spark, n=2000, vessels=500)
    few, many = (pair_blocks(crowd, 0.054, pairs_per_task=k) for k in (1_000_000, 100))
    assert few.blocks == 4 and few.partitions == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert many.blocks > 10 and many.partitions > few.partitions
    assert pair_blocks(crowd.filter("event_id % 100 = 1"), 0.054) is None  # pings outnumber pairs
    assert pair_blocks(crowd.filter(F.lit(False)), 0.054) is None


def test_far_candidates_are_dropped_before_the_distance(spark):
    plan = plan_text(close_pairs(_crowd(spark), 0.054))
    cond = next(line for line in plan.splitlines() if line.startswith("Join condition") and "ATAN2" in line)
    assert cond.index("abs((lat_a") < cond.index("ATAN2") and cond.index("abs((lon_a") < cond.index("ATAN2")


def test_both_sides_share_one_shuffle(spark, workdir):
    df = materialize(_crowd(spark), f"{workdir}/pings")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = close_pairs(df, 0.054, blocks=PairBlocks(4, 8))
        plan = plan_text(closest_per_pair(pairs, tie_break=TIE), "simple")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("ReusedExchange") == 1


def test_the_search_reads_prepared_pings_from_a_table(spark):
    plan = plan_text(detect_encounters(_crowd(spark), EncounterConfig(order_by=("ts", "event_id"))), "simple")
    # only the closest moment needs a window: the history is made before, once
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "vessel_id_b" in windows[0]


def test_the_report_is_made_once_for_the_top_events(spark):
    cfg = EncounterConfig(order_by=("ts", "event_id"), min_pings=1)
    pings = _crowd(spark)
    out = extract_events(detect_encounters(pings, cfg, sort=False), pings, cfg, partition_days="group_key")
    assert out["top"].count() == cfg.top_n
    for name in ("top", "targets", "points", "tracks", "complete", "cards"):
        assert "_block_lo" not in plan_text(out[name], "simple") and "_cx" not in plan_text(out[name], "simple")


def test_blocks_across_groups_count_all_pairs(spark):
    crowd = _crowd(spark, n=2000, vessels=500)
    days = crowd.unionAll(crowd.withColumn("group_key", F.date_add("group_key", 9)))
    one, all_days = (pair_blocks(days, 0.054, pairs_per_task=500, across_groups=k) for k in (False, True))
    assert one.blocks == pair_blocks(crowd, 0.054, pairs_per_task=500).blocks < all_days.blocks


ORDER = ("ts", "event_id")


@pytest.mark.parametrize("n, vessels", [(300, 40), (200, 8), (400, 300)])
def test_visits_give_the_closest_moments(spark, n, vessels):
    df = _crowd(spark, n=n, vessels=vessels)
    df = df.unionAll(df.withColumn("lat", F.col("lat") + 0.01))  # ties: the same distance by other pings
    best = closest_per_pair(close_pairs(df, 0.054), tie_break=TIE)
    for blocks in (PairBlocks(1, 3, ORDER), PairBlocks(5, 7, ORDER)):
        cut = close_pairs(df, 0.054, blocks=blocks)
        assert _rows(cut) == _rows(close_pairs(df, 0.054))
        closest = closest_per_pair(cut, tie_break=TIE)
        assert _rows(closest) == _rows(best) and set(closest.columns) == set(best.columns)


def test_other_radii_and_empty_pings(spark):
    df = _crowd(spark)
    wide = close_pairs(df, 0.1, earth_radius_nm=7000.0, blocks=PairBlocks(4, 8, ORDER))
    plain = closest_per_pair(close_pairs(df, 0.1, earth_radius_nm=7000.0), tie_break=TIE)
    assert _rows(closest_per_pair(wide, tie_break=TIE, earth_radius_nm=7000.0)) == _rows(plain)
    none = close_pairs(df.filter(F.lit(False)), 0.054, blocks=PairBlocks(4, 8, ORDER))
    assert _rows(closest_per_pair(none, tie_break=TIE)) == []


def test_blocks_follow_the_pings_where_vessels_have_few(spark):
    crowd = _crowd(spark, n=2000, vessels=500)

    def spread(**kw):
        return pair_blocks(crowd, 0.054, pairs_per_task=100, order_by=ORDER, **kw)

    many = pair_blocks(crowd, 0.054, pairs_per_task=100)
    assert spread() == PairBlocks(4, many.partitions, ORDER) and many.blocks > 10
    assert spread(pings_per_block=200).blocks == 6  # of about 1,000 pings of the larger day
    assert spread(max_visits=1) == many  # some vessel has more
    assert spread(tolerance_s=5).order_by == () and spread(across_groups=True).order_by == ()
    assert pair_blocks(crowd, 0.054, order_by=ORDER) == pair_blocks(crowd, 0.054)  # four blocks do


def test_pairs_of_visits_are_neither_shuffled_nor_sorted(spark, workdir):
    df = materialize(_crowd(spark), f"{workdir}/pings")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = close_pairs(df, 0.054, blocks=PairBlocks(4, 8, ORDER))
        plan = plan_text(closest_per_pair(pairs, tie_break=TIE), "simple")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    after = plan[:plan.index("SortMergeJoin")]
    assert "Exchange" not in after and "Sort " not in after and "Window" not in after and "Generate" in after
    assert "_visit" not in plan[plan.index("SortMergeJoin"):].splitlines()[0]  # tested after the join
    assert plan.count("ReusedExchange") == 1


def test_the_analysis_uses_visits_for_very_many_pairs(spark, monkeypatch):
    cfg = EncounterConfig(order_by=("ts", "event_id"), min_pings=1)
    pings = _crowd(spark, n=1500, vessels=400).drop("epoch", "bucket").filter("event_id is not null")

    def report():
        return sorted(detect_encounters(pings, cfg, sort=False).collect())

    blocks = []
    monkeypatch.setattr(stages, "pair_blocks", lambda *a, **kw: blocks.append(pair_blocks(*a, pairs_per_task=100, **kw)) or blocks[-1])
    many = report()
    assert blocks[0].blocks == 4 and blocks[0].order_by[:2] == cfg.order_by
    monkeypatch.undo()
    assert len(many) > 500 and report() == many
