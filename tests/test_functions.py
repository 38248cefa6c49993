import math

from nearmiss.functions import (
    course_change,
    event_key,
    haversine_nm,
    speed_band,
    time_bucket,
)
from tests.conftest import ts


def test_haversine_known_distances(spark):
    df = spark.createDataFrame(
        [(55.0, 14.0, 55.0, 14.0), (0.0, 0.0, 1.0, 0.0), (55.225, 14.245, None, 14.0)],
        "a double, b double, c double, d double",
    )
    got = [r[0] for r in df.select(haversine_nm("a", "b", "c", "d")).collect()]
    assert got[0] == 0.0
    # one degree of latitude = R * pi / 180
    assert math.isclose(got[1], 3440.065 * math.pi / 180, rel_tol=1e-12)
    assert got[2] is None


def test_course_change_wraps_around_north(spark):
    df = spark.createDataFrame(
        [(10.0, 350.0), (180.0, 0.0), (350.0, 10.0), (35.5, None), (None, 10.0)],
        "c double, p double")
    got = [r[0] for r in df.select(course_change("c", "p")).collect()]
    assert got == [20.0, 180.0, 20.0, 0.0, 0.0]


def test_speed_band_edges(spark):
    df = spark.createDataFrame([(0.1,), (1.0,), (5.0,), (12.0,), (12.1,), (None,), (float("nan"),)],
                               "s double")
    got = [r[0] for r in df.select(speed_band("s")).collect()]
    assert got == ["blue", "red", "orange", "yellow", "green", "blue", "blue"]


def test_time_bucket_boundary(spark):
    df = spark.createDataFrame([(ts(9),), (ts(10),), (ts(19),)], "t timestamp_ntz")
    got = [r[0] for r in df.select(time_bucket("t", 10)).collect()]
    assert got[0] != got[1] and got[1] == got[2]


def test_event_key_format(spark):
    df = spark.createDataFrame([(1, 165, ts(0), "219", "220"), (2, 50, None, "1", "2")],
                               "r int, s int, t timestamp_ntz, a string, b string")
    got = [r[0] for r in df.select(event_key("r", "s", "t", "a", "b")).collect()]
    assert got == ["Top_1_Score_165_20211213_020000_219_220", "Top_2_Score_50_date_error_1_2"]


def test_no_python_udf_in_helpers(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    plan = df.select(haversine_nm("x", "y", "y", "x"), course_change("x", "y"),
                     speed_band("x"))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
