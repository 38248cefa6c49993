"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from nearmiss.plans import shared_dir

#: Text bytes that one step of a numpy kernel works on at a time.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table by Spark's reader, so that any store Spark reads will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session (``nearmiss.plans.shared_dir``), set for checkpoints."""
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: lineage ends here."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def put_file(spark: SparkSession, data: bytes, stem: str) -> str:
    """Write ``data`` to the shared folder through Spark's file system and hand the
    file to every executor; returns the name for ``SparkFiles.get``.

    A new or restarted executor fetches the file again by itself.
    """
    sc = spark.sparkContext
    name = f"{stem}-{uuid.uuid4().hex}"
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/files/{name}")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    try:
        for at in range(0, len(data), 1 << 20):
            out.write(bytearray(data[at : at + (1 << 20)]))
    finally:
        out.close()
    sc.addFile(path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toString())
    return name


def text_slices(texts: list[str | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(from, to) runs of ``texts`` of about ``limit`` characters; a longer text is a run of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n + 1
    if start < len(texts):
        yield start, len(texts)


def arrow_batch(columns: dict[str, object], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    """A record batch of the given types, in their order."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], type=kind) for name, kind in types.items()], names=list(types)
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of unsigned 64-bit values (two multiply-xorshift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def segments(lengths: Iterable[int]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths as an array, and the start of each run laid end to end."""
    lengths = np.asarray(lengths, dtype=np.int64)
    starts = np.zeros(len(lengths), dtype=np.int64)
    np.cumsum(lengths[:-1], out=starts[1:])
    return lengths, starts


def dealt(rows: np.ndarray, bucket: np.ndarray) -> dict[str, list]:
    """Rows of an array as one packed row for each bucket: ``bucket``, ``packed``."""
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order].astype(np.int64)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]][: len(bucket)])
    ends = np.r_[starts[1:], len(rows)]
    return {"bucket": bucket[starts].tolist(), "packed": [rows[a:b].tobytes() for a, b in zip(starts, ends)]}
