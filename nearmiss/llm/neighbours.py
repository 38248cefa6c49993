"""Nearest neighbours by a block matrix join.

Queries and candidates are dealt into blocks of bounded size, and every pair of blocks
is one task's work, done tile by tile. In a tile the vectors are rounded to int8; the product
of the two int8 matrices gives all squared distances up to a proven error, so that a pair whose
lower bound is above the k-th smallest upper bound can be left out. What survives is
measured again in double precision and kept in a heap for each query; the heaps of a
query's tiles, then those of its blocks, are merged.

All pairs are compared, so a vector travels once for every block of the other side. Blocks are
large where there are many vectors: one of BLOCK_QUERIES by BLOCK_CANDIDATES costs minutes of
multiplication for some ten megabytes that travel.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearmiss.llm.common import cut

#: Rows of a tile: queries and candidates.
QUERY_ROWS, CANDIDATE_ROWS = 512, 4096
#: Rows of a block, and the number of blocks up to which a block is one tile, so that few vectors
#: are many tasks' work, too.
BLOCK_QUERIES, BLOCK_CANDIDATES = 8192, 65_536
FEW_BLOCKS = 32
#: float32 holds whole numbers up to this; it bounds the products of int8 rows of one length.
EXACT_FLOAT = 1 << 24

NEAR_SCHEMA = "query_id long, vec_id long, score double"


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, the scale of each row, and the length of what rounding took from it."""
    scale = np.abs(x).max(axis=1) / 127
    scale = np.where(scale > 0, scale, np.finfo(np.float64).tiny)
    codes = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
    return codes, scale, np.sqrt(((x - codes * scale[:, None]) ** 2).sum(axis=1))


def tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
    """Yields (query id, its k nearest as (distance, id)) over one tile; equal ids don't meet."""
    # a common power of two keeps squares of very large or small numbers in range
    largest = max(np.abs(queries).max(), np.abs(vectors).max())
    shift = 2.0 ** -math.frexp(largest)[1]
    q, v = queries * shift, vectors * shift
    q8, q_scale, q_lost = quantise(q)
    v8, v_scale, v_lost = quantise(v)
    kind = np.float32 if 127 * 127 * q.shape[1] < EXACT_FLOAT else np.float64
    dots = (q8.astype(kind) @ v8.astype(kind).T).astype(np.float64) * q_scale[:, None] * v_scale[None, :]
    q_length, v_length = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
    # |x.y - x'.y'| <= |x - x'| |y| + |x'| |y - y'|, and |x'| <= |x| + |x - x'|
    error = 2 * (q_lost[:, None] * v_length[None, :] + (q_length + q_lost)[:, None] * v_lost[None, :])
    near = q_length[:, None] ** 2 + v_length[None, :] ** 2 - 2 * dots
    error += 1e-9 * (q_length[:, None] + v_length[None, :]) ** 2
    own = query_ids[:, None] == ids[None, :]
    upper = np.where(own, np.inf, near + error)
    if upper.shape[1] > k:
        limit = np.partition(upper, k - 1, axis=1)[:, k - 1]
    else:
        limit = np.full(len(upper), np.inf)
    survives = (near - error <= limit[:, None]) & ~own
    for i, query_id in enumerate(query_ids):
        at = np.flatnonzero(survives[i])
        if len(at):
            yield query_id, heapq.nsmallest(k, zip(distances(queries[i], vectors[at]).tolist(), ids[at].tolist()))


def block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, rows: tuple[int, int]):
    """Yields (query id, its k nearest as (distance, id)) over two blocks, by tiles of ``rows``."""
    for a in range(0, len(queries), rows[0]):
        best: dict[int, list] = {}
        for b in range(0, len(vectors), rows[1]):
            part = slice(a, a + rows[0]), slice(b, b + rows[1])
            for query_id, found in tile(query_ids[part[0]], queries[part[0]], ids[part[1]], vectors[part[1]], k):
                held = best.get(query_id)
                # rows of one id and several vectors meet here: a neighbour counts once, the same distance too
                best[query_id] = found if held is None else heapq.nsmallest(k, {*held, *found})
        yield from best.items()


def n_blocks(n, tile_rows: int, block_rows: int):
    """How many blocks ``n`` (a column) rows are dealt into: tiles while they are few, else whole blocks."""
    tiles, blocks = F.ceil(n / F.lit(tile_rows)), F.ceil(n / F.lit(block_rows))
    return F.least(tiles, F.greatest(blocks, F.lit(FEW_BLOCKS))).cast("int")


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision; where squares leave the range, scaled."""
    d = np.abs(y - x)
    plain = np.sqrt(np.add.accumulate(d * d, axis=1)[:, -1])  # added in order, as SQL does
    odd = ~np.isfinite(plain) | (plain < 1e-140)
    if odd.any():
        top = d[odd].max(axis=1)
        safe = np.where(top > 0, top, 1.0)
        plain[odd] = safe * np.sqrt(((d[odd] / safe[:, None]) ** 2).sum(axis=1))
    return plain


def nearest_neighbours(
    embeddings: DataFrame, is_query, *, k: int = 10, id_col="vec_id", vector_col="embedding",
    query_rows: int = QUERY_ROWS, candidate_rows: int = CANDIDATE_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each query row its ``k`` nearest other vectors.

    ``is_query`` is a Boolean column expression over ``embeddings``. The result is exact:
    smallest Euclidean distance first, ties to the smaller id, all candidates if fewer.
    Null, empty, zero and non-finite vectors and those holding nulls take no part, nor do
    rows without id; a vector only meets others of its own length. Rows equal in id and
    vector count once; rows of one id with different vectors are all candidates and all
    queries, and none is a neighbour of its own id. Other columns are not read.
    """
    numbers = F.col(vector_col).cast("array<double>")
    usable = embeddings.select(
        F.col(id_col).cast("long").alias("vec_id"), numbers.alias("vector"), is_query.alias("is_query")
    ).filter(
        F.col("vec_id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("vector", lambda x: x != 0)
    )
    usable = cut(usable.withColumn("is_query", F.coalesce("is_query", F.lit(False))).distinct())
    usable = usable.withColumn("dims", F.size("vector")).withColumn("place", F.xxhash64("vec_id", "vector"))
    # blocks for each vector length, so that a block holds vectors of one length only
    sizes = usable.groupBy("dims").agg(F.count("*").alias("n"), F.count_if("is_query").alias("n_queries")).select(
        "dims",
        n_blocks(F.col("n"), candidate_rows, BLOCK_CANDIDATES).alias("rows"),
        n_blocks(F.col("n_queries"), query_rows, BLOCK_QUERIES).alias("columns"),
    ).filter("columns > 0")
    dealt = usable.join(sizes, "dims")
    slim = ["dims", "row", "column", "vec_id", "vector"]
    candidates = dealt.select(
        "dims", F.pmod("place", F.col("rows").cast("long")).cast("int").alias("row"),
        F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"), "vec_id", "vector",
    ).select(*slim)
    queries = dealt.filter("is_query").select(
        "dims", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"),
        F.pmod("place", F.col("columns").cast("long")).cast("int").alias("column"), "vec_id", "vector",
    ).select(*slim).toDF("q_dims", "q_row", "q_column", "query_id", "query")

    def near(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(left) and len(right):
            q, v = np.stack(left["query"]), np.stack(right["vector"])
            for query_id, found in block(left["query_id"].to_numpy(), q, right["vec_id"].to_numpy(), v, k, (query_rows, candidate_rows)):
                rows += [(query_id, i, s) for s, i in found]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    found = (
        queries.groupBy("q_dims", "q_row", "q_column")
        .cogroup(candidates.groupBy("dims", "row", "column"))
        .applyInPandas(near, NEAR_SCHEMA)
    )

    def merge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One query's heaps, batch by batch: never more than k and a batch at once."""
        best: list[tuple[float, int]] = []
        query_id = None
        for part in parts:
            if not len(part):
                continue
            query_id = part["query_id"].iloc[0]
            both = {*best, *zip(part["score"].tolist(), part["vec_id"].tolist())}
            best = heapq.nsmallest(k, both)
        if best:
            yield pd.DataFrame(
                {
                    "query_id": query_id, "rank": np.arange(1, len(best) + 1),
                    "vec_id": [i for _, i in best], "score": [s for s, _ in best],
                }
            )

    return found.groupBy("query_id").applyInPandas(merge, "query_id long, rank int, vec_id long, score double")
