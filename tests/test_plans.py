"""Plan shape checks: the properties the design relies on at scale."""

import re

from pyspark.sql import functions as F

from nearmiss.operators import incident_summary
from nearmiss.plans import prepare_pings, score_encounters, zone_pings
from nearmiss.sources import ping_view, read_ping_lake, write_ping_lake
from tests.conftest import plan_text
from tests.test_stages import CFG

SF = "/root/testdata/sf0.001"


def _tables(spark, workdir):
    write_ping_lake(ping_view(spark, SF), f"{workdir}/lake")
    lake = read_ping_lake(spark, f"{workdir}/lake")
    zone_pings(lake, CFG).write.partitionBy("group_key").parquet(f"{workdir}/zone")
    zone = spark.read.parquet(f"{workdir}/zone")
    prepare_pings(zone, CFG).write.parquet(f"{workdir}/prep")
    return lake, zone, spark.read.parquet(f"{workdir}/prep")


def _exchanges(df):
    return re.findall(r"Exchange (\w+)\(([^)]*)\)", plan_text(df, "simple"))


def test_stage_plans(spark, workdir):
    lake, zone, prep = _tables(spark, workdir)

    zplan = plan_text(zone_pings(lake, CFG), "simple")
    assert "Exchange" not in zplan
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(lat,", zplan)

    ex = _exchanges(prepare_pings(zone, CFG))
    # the pings are scanned once and shuffled once, on (vessel, slice), and the
    # summary reads the same exchange; the others move one row per slice
    full = [e for e in ex if e[0] == "hashpartitioning" and "vessel_id" in e[1] and "_slice" in e[1]]
    assert len(full) == 3  # pings (twice in the static plan); summary back to (vessel, slice)
    assert not any("Broadcast" in e[0] for e in ex)
    prepared = prepare_pings(zone, CFG)
    prepared.collect()
    final = prepared._jdf.queryExecution().executedPlan().toString()
    final = final[final.index("Final Plan"):final.index("Initial Plan")]
    assert "ReusedExchange" in final and final.count("FileScan parquet") == 1
    assert "SortAggregate" not in final

    splan = plan_text(score_encounters(prep, CFG), "simple")
    assert "SortMergeJoin" in splan and "WindowGroupLimit" in splan
    assert "BroadcastNestedLoopJoin" not in splan and "CartesianProduct" not in splan
    assert splan.count("rangepartitioning") == 1
    unsorted = plan_text(incident_summary(score_encounters(prep, CFG, sort=False)), "simple")
    assert "rangepartitioning" not in unsorted


def test_only_needed_columns_go_through_the_history(spark, workdir):
    """A lake with all AIS columns: the shuffle carries those that later stages read."""
    wide = ["nav_status", "rot", "heading", "imo", "callsign", "ship_type", "cargo_type", "width", "length"]
    pings = ping_view(spark, SF).select("*", *[F.lit("x").alias(c) for c in wide])
    write_ping_lake(pings, f"{workdir}/lake")
    zone = zone_pings(read_ping_lake(spark, f"{workdir}/lake"), CFG)
    assert set(wide) <= set(zone.columns)
    prepared = prepare_pings(zone, CFG)
    assert not set(wide) & set(prepared.columns)
    read = re.findall(r"ReadSchema: (.*)", plan_text(prepared))
    assert read and not any(c in r for r in read for c in (*wide, "Year"))
