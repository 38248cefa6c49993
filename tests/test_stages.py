from hypothesis import given, settings
from hypothesis import strategies as st

from nearmiss import EncounterConfig, ScoreWeights
from nearmiss.plans import detect_encounters, run_pipeline, zone_pings
from nearmiss.sources import ping_view

SF = "/root/testdata/sf0.001"
CFG = EncounterConfig(radius_nm=20.0, min_pings=20, dmax_nm=20.0, bucket_seconds=3600,
                      deny_tokens=("ERR",), order_by=("ts", "event_id"),
                      weights=ScoreWeights(near_m=1500.0, mid_m=3000.0, stale_s=36000))


def _report_rows(df):
    return sorted((r.vessel_a, r.vessel_b, str(r.group_key), r.danger_score, r.distance_m)
                  for r in df.collect())


def test_run_pipeline_from_lake_equals_lazy_chain(spark, workdir):
    from nearmiss.sources import write_ping_lake

    pings = ping_view(spark, SF)
    write_ping_lake(pings, f"{workdir}/lake")
    out = run_pipeline(spark, CFG, lake_path=f"{workdir}/lake", workdir=f"{workdir}/run")
    want = _report_rows(detect_encounters(zone_pings(pings, CFG), CFG))
    assert _report_rows(out["report"]) == want and want
    assert out["summary"].first().total_incidents == len(want)
    assert out["cards"].count() <= CFG.top_n
    # stage outputs are tables in the shared folder: lineage is cut
    from tests.conftest import plan_text
    rplan = plan_text(out["report"])
    assert "Scan parquet" in rplan and "/run/report" in rplan
    assert "Window" not in rplan and "Join" not in rplan and rplan.count("Exchange rangepartitioning") <= 1
    assert "Exchange" not in plan_text(out["zone"]) and "rangepartitioning" not in plan_text(out["summary"])


def test_zone_table_holds_and_reads_its_columns_only(spark, workdir):
    from pyspark.sql import functions as F

    from nearmiss.plans import materialize
    from tests.conftest import plan_text

    wide = ping_view(spark, SF).withColumns({"heading": F.lit(1), "Extra": F.lit("x"), "other": F.lit(2.0)})
    wide.write.parquet(f"{workdir}/wide")
    zone = zone_pings(spark.read.parquet(f"{workdir}/wide"), CFG)
    assert zone.columns == ["ts", "vessel_id", "lat", "lon", "sog", "cog", "heading", "name", "group_key", "event_id"]
    read = plan_text(zone).split("ReadSchema:")[1].split("\n")[0]
    assert "heading" in read and "Extra" not in read and "other" not in read
    assert "Extra" in zone_pings(wide, CFG, keep=("Extra",)).columns
    assert materialize(zone, f"{workdir}/zone").columns == zone.columns


def test_report_of_a_run_is_in_order(spark, workdir):
    """However many files the report is written to."""
    from nearmiss.sources import write_ping_lake

    write_ping_lake(ping_view(spark, SF), f"{workdir}/lake")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = run_pipeline(spark, CFG, lake_path=f"{workdir}/lake", workdir=f"{workdir}/run")
        rows = out["report"].collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    keys = [(-r.danger_score, r.distance_nm, r.vessel_a, r.vessel_b, r.ts_a, r.ts_b) for r in rows]
    assert keys == sorted(keys) and len(spark.read.parquet(f"{workdir}/run/report").inputFiles()) > 1


def test_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    import pytest

    from nearmiss.plans import shared_dir

    context = type("Context", (), {"master": "spark://host:7077", "getCheckpointDir": lambda self: None})()
    session = type("Session", (), {"conf": type("Conf", (), {"get": lambda self, *a: None})(), "sparkContext": context})()
    with pytest.raises(ValueError, match="shared folder"):
        shared_dir(session)


def test_group_by_source_file(spark, workdir):
    from nearmiss.sources import write_ping_lake

    write_ping_lake(ping_view(spark, SF), f"{workdir}/lake", partitions=3)
    cfg = CFG.with_(group_key="source_file")
    out = run_pipeline(spark, cfg, lake_path=f"{workdir}/lake", workdir=f"{workdir}/run")
    rows = out["report"].collect()
    assert rows and all(r.group_key.endswith(".parquet") for r in rows)
    # within one file a pair is reported once
    assert len({(r.vessel_a, r.vessel_b, r.group_key) for r in rows}) == len(rows)


@settings(max_examples=60, deadline=None)
@given(st.floats(0, 359.9), st.floats(0, 359.9))
def test_course_change_symmetric_and_bounded(spark, a, b):
    from tests.column_eval import course_change_value

    x, y = course_change_value(a, b), course_change_value(b, a)
    assert x == y and 0.0 <= x <= 180.0
