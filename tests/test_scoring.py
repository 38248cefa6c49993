"""Score rules: threshold edges and a replay of published report rows."""

import pytest

from nearmiss.operators import danger_score

PAIR = ("distance_nm double, sog_a double, sog_b double, delta_sog_a double, delta_sog_b double, "
        "delta_cog_a double, delta_cog_b double, interval_s_a long, interval_s_b long, "
        "is_last_signal_a int, is_last_signal_b int")


def _score(spark, rows):
    df = spark.createDataFrame(rows, PAIR)
    return [r.asDict() for r in danger_score(df).collect()]


def _row(metres, sog=(10.0, 10.0), dsog=(0.0, 0.0), dcog=(0.0, 0.0), interval=(10, 10),
         last=(0, 0)):
    return (metres / 1852.0, sog[0], sog[1], dsog[0], dsog[1], dcog[0], dcog[1],
            interval[0], interval[1], last[0], last[1])


def test_proximity_edges(spark):
    got = [r["proximity_points"] for r in _score(spark, [_row(m) for m in (20.0, 20.1, 50.0, 50.1)])]
    assert got == [50, 30, 30, 10]


def test_course_needs_both_moving(spark):
    rows = [_row(80, sog=(3.0, 2.9), dcog=(90.0, 0.0)), _row(80, dcog=(30.0, 0.0)),
            _row(80, dcog=(0.0, 30.1)), _row(80, dcog=(15.0, 15.0)), _row(80, dcog=(None, 16.0))]
    assert [r["course_points"] for r in _score(spark, rows)] == [0, 20, 40, 0, 20]


def test_speed_points(spark):
    rows = [_row(80, dsog=(-2.0, 0.0)), _row(80, dsog=(2.0, 0.0)), _row(80, dsog=(2.0, -3.0)),
            _row(80, dsog=(None, None))]
    assert [r["speed_points"] for r in _score(spark, rows)] == [30, 15, 30, 0]


def test_stale_only_vessel_a(spark):
    rows = [_row(80, interval=(120, 1)), _row(80, interval=(121, 1)), _row(80, interval=(None, 1)),
            _row(80, interval=(10, 121))]
    assert [r["stale_penalty"] for r in _score(spark, rows)] == [0, 30, 0, 0]


def test_signal_points_either_vessel(spark):
    rows = [_row(80, last=(0, 1)), _row(80, last=(1, 0)), _row(80, last=(0, 0))]
    assert [r["signal_points"] for r in _score(spark, rows)] == [100, 100, 0]


# Published report rows (score; metres; SOG A/B; speed change 1/2; course change 1/2; interval).
# The last-signal flag is not published; the first row carries it (+100).
REPLAY = [
    (165, 74.7, (10.3, 11.1), (4.2, -0.7), (35.5, 0.9), 11, (1, 0)),
    (65, 36.6, (4.0, 3.8), (1.3, 2.1), (30.0, 21.0), 5, (0, 0)),
    (55, 25.6, (3.0, 3.4), (2.1, 0.1), (144.1, 9.7), 124, (0, 0)),
    (40, 59.1, (2.1, 3.0), (-2.0, -0.2), (13.4, 0.4), 11, (0, 0)),
    (-5, 82.8, (2.2, 4.8), (2.1, 0.5), (41.4, 1.9), 146, (0, 0)),
]


@pytest.mark.parametrize("score,metres,sog,dsog,dcog,interval,last", REPLAY)
def test_score_replay(spark, score, metres, sog, dsog, dcog, interval, last):
    (got,) = _score(spark, [_row(metres, sog, dsog, dcog, (interval, 1), last)])
    assert got["distance_m"] == metres
    assert got["danger_score"] == score
