from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="nearmiss-tests-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("nearmiss-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", scratch)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # use the configured shared checkpoint folder; set one only where unset
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    yield s
    s.stop()


@pytest.fixture
def workdir(spark):
    from nearmiss.plans import shared_dir

    base = shared_dir(spark)
    base = base[len("file:"):] if base.startswith("file:") else base
    os.makedirs(base, exist_ok=True)
    return tempfile.mkdtemp(prefix="case-", dir=base)


T0 = dt.datetime(2021, 12, 13, 2, 0, 0)


def ts(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


PING_SCHEMA = ("event_id long, vessel_id string, ts timestamp_ntz, lat double, lon double, "
               "sog double, cog double, name string, group_key date")


def pings(spark, rows):
    """rows: (event_id, vessel_id, seconds, lat, lon, sog, cog[, name])."""
    out = []
    for r in rows:
        eid, vid, sec, lat, lon, sog, cog = r[:7]
        name = r[7] if len(r) > 7 else "ship"
        t = ts(sec) if sec is not None else None
        out.append((eid, vid, t, lat, lon, sog, cog, name, t.date() if t else None))
    return spark.createDataFrame(out, PING_SCHEMA)


def plan_text(df, mode: str = "formatted") -> str:
    """The full physical plan text, as ``df.explain(mode)`` prints it."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
