from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearmiss.llm import neighbours
from nearmiss.llm.neighbours import distances, nearest_neighbours, quantise, tile


def brute(rows, k):
    usable = {(i, tuple(float(c) for c in v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = set()
    for q, x in usable:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((np.array(x) - np.array(y)) ** 2).sum())), i) for i, y in usable if i != q and len(y) == len(x))
            out |= {(q, rank, i, round(d, 9)) for rank, (d, i) in enumerate(near[:k], 1)}
    return out


@pytest.mark.parametrize("query_rows,candidate_rows,few", [(512, 4096, 32), (2, 37, 32), (2, 37, 1)])
def test_rows_match_brute_force(spark, crowded, monkeypatch, query_rows, candidate_rows, few):
    monkeypatch.setattr(neighbours, "FEW_BLOCKS", few)  # 1: a block of many tiles
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(600, 8)).round(1)  # rounded: many ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows[100] = (100, rows[7][1])
    rows += [(700, rows[3][1]), (701, rows[3][1]), (702, [0.0] * 8), (703, None), (704, [None] * 8), (705, [float("nan")] + [1.0] * 7),
             (706, [float("inf")] + [1.0] * 7), (800, [1.0, 2.0]), (801, [1.0, 2.5]), (802, []), (None, rows[0][1]), rows[5]]
    frame = crowded(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).repartition(4)
    got = nearest_neighbours(frame, F.col("vec_id") % 100 == 0, k=10, query_rows=query_rows, candidate_rows=candidate_rows)
    single = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    assert {(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got.collect()} == brute(single, 10)


def test_bounds_hold_for_any_scale():
    rng = np.random.default_rng(2)
    for scale in (1e-200, 1e-30, 1.0, 1e30, 1e150):
        x = rng.normal(size=(60, 16)) * scale
        found = dict(tile(np.arange(5), x[:5], np.arange(60), x, 3))
        for q in range(5):
            d = distances(x[q], x)
            assert [i for _, i in found[q]] == sorted((i for i in range(60) if i != q), key=lambda i: (d[i], i))[:3]


def test_codes_lose_what_they_say():
    x = np.random.default_rng(3).normal(size=(20, 9))
    codes, scale, lost = quantise(x)
    assert np.allclose(np.linalg.norm(x - codes * scale[:, None], axis=1), lost)


def test_vectors_travel_once_for_each_block(spark):
    """Blocks grow before their number does: few copies of a vector, and many tasks for few vectors."""
    sizes = [1000, 100_000, 1_000_000, 10_000_000, 100_000_000]
    rows = spark.createDataFrame([(n,) for n in sizes], "n long")
    got = rows.select(neighbours.n_blocks(F.col("n"), 4096, 65_536)).collect()
    assert [r[0] for r in got] == [1, 25, 32, 153, 1526]


def test_no_queries_and_empty_table(spark):
    frame = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert nearest_neighbours(frame, F.col("vec_id") % 100 == 0).count() == 0
    assert nearest_neighbours(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0
