"""Where stage outputs are materialised: the cluster's shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (set by the cluster).

    Where it is unset, a session within one process (``local`` master, as in
    tests) gets a folder of its own for its lifetime; any other must set it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set; stage outputs need a shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="nearmiss-"))
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


def run_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh sub-folder of the shared folder for one pipeline run."""
    return f"{shared_dir(spark)}/nearmiss-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, path: str, *, partition_by=None) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts the lineage, so a lost
    executor costs a re-read of this table rather than a recompute of every
    upstream stage, and later consumers scan instead of recomputing."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def if_any(df: DataFrame, path: str) -> DataFrame | None:
    """``df`` as a written table, None where it has no rows."""
    table = materialize(df, path)
    return None if table.isEmpty() else table
