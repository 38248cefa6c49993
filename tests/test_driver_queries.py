"""The registered queries against their DuckDB oracles on the smallest tables,
and the stage chain against the same chain without grid and slices."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, duck, name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert res["status"] in ("OK", "rows-only"), res


def test_every_query_of_the_library_itself_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "danger_score" in df.columns


def test_chain_equals_plain_variant(spark):
    cfg = E.FLAGSHIP_CFG
    plain = cfg.with_(grid_cell_factor=8.0, history_slice_seconds=None)
    a = {tuple(r) for r in E._report_out(E._report(spark, SF, cfg)).collect()}
    b = {tuple(r) for r in E._report_out(E._report(spark, SF, plain)).collect()}
    assert a == b and a


def test_views_with_gaps_make_the_operators_act():
    """What the plain view never shows: both severities, unnamed vessels, null speeds, events
    of which a vessel has no points, and events without a time."""
    import duckdb

    con = duckdb.connect()
    con.sql("CREATE VIEW events AS SELECT * FROM '/root/testdata/sf0.01/events.parquet'")
    sql = E.oracle_sql()
    count = lambda name, where="true": con.sql(f"SELECT count(*) FROM ({sql[name]}) WHERE {where}").fetchall()[0][0]
    for where in ("severity = 'red'", "severity <> 'red'", "vessel_label LIKE 'MMSI %'", "vessel_label NOT LIKE 'MMSI %'"):
        assert count("odd_tracks", where), where
    assert count("nameless_points", "sog = 0.0") and count("nameless_points", "cog = 0.0")
    ranks = con.sql(f"SELECT count(DISTINCT event_rank) FROM ({sql['odd_tracks']})").fetchall()[0][0]
    assert 0 < count("incomplete_events") < ranks
    assert 0 < count("events_from_report") < 50
