from __future__ import annotations

import os

import pytest

import corpus_pipeline as cp
from nearmiss.llm import quality_lines as q
from nearmiss.llm import suffix_dedup as s
from nearmiss.llm.packing import byte_bpe
from nearmiss.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.test_jaccard_join import brute as brute_groups
from tests.llm.test_suffix_dedup import brute as brute_repeats

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = cp.quality_rules(spark, docs, SF).cache()
    field = q.train_field(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {i for i, r in rows.items() if q.judge([r.text], field, q.CONTENT_SHARE)["kept"][0]}
    assert {r.doc_id: r for r in first.collect()} == {i: rows[i] for i in kept} and first.columns == docs.columns

    second = cp.near_duplicate_groups(spark, first, SF).cache()
    groups = brute_groups([(i, rows[i].text) for i in sorted(kept)], 5, 80)
    stay = sorted(i for i, (_, head) in groups.items() if head == i)
    assert {r.doc_id: r for r in second.collect()} == {i: rows[i] for i in stay} and second.columns == docs.columns

    third = cp.repeated_passages(spark, second, SF).cache()
    found = {r.doc_id: r for r in third.collect()}
    assert third.columns == docs.columns and third.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    for i, (n, gone, spans, _) in zip(stay, brute_repeats([rows[i].text for i in stay])):
        left = len(found[i].text.encode())
        assert n - gone <= left <= n - gone + 6 * spans and found[i].n_chars == len(found[i].text)
        if not gone:
            assert found[i].text == rows[i].text

    fourth = cp.source_mixing(spark, third, SF).cache()
    assert fourth.columns == docs.columns
    got = fourth.collect()
    assert all(r == found[r.doc_id] for r in got) and len({r.doc_id for r in got}) > 0.7 * len(found)

    pieces = cp.packing(spark, fourth, SF).collect()
    encoder = byte_bpe(cp.public_tokenizers.path("byte_bpe_50k.tiktoken"), cp.public_tokenizers.PATTERN, {"<|endoftext|>": 50256})
    assert sum(r.length for r in pieces) == sum(len(encoder.encode(r.text, allowed_special="all")) + 1 for r in got)
    assert len({r.sequence_id for r in pieces}) <= 1.05 * sum(r.length for r in pieces) / 2048 + 1


def test_run_and_registration(spark):
    assert cp.ORACLE_SQL is None and set(ORACLE_SQL) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert cp.run(spark, SF).count() > 100


def test_stages_on_odd_rows(spark, docs, crowded):
    long = " ".join(f"word{i}" for i in range(80)) + "."
    rows = [(None, long), (1, None), (2, ""), (3, long), (3, long), (4, long + " tail"), (5, "junk&&& " * 90), (6, "ü" * 300)]
    frame = crowded(docs(rows))
    for name, stage in cp.STAGES:
        out = stage(spark, frame, SF)
        if name != cp.STAGES[-1][0]:
            assert out.columns == frame.columns, name
        out.collect()
        assert stage(spark, frame.limit(0), SF).count() == 0, name
    assert sorted(str(r.doc_id) for r in cp.near_duplicate_groups(spark, frame, SF).collect()) == ["1", "2", "3", "5", "6", "None"]


def test_near_duplicate_groups_of_repeated_and_null_ids(spark, docs):
    text = lambda stem: " ".join(f"{stem}{i}" for i in range(60))
    rows = [
        (3, text("a")), (5, text("a") + " tail"), (5, text("b")),  # one of 5 is near 3, the other near nothing
        (7, text("c")), (7, text("d")), (7, text("c")), (8, text("d")),  # 7 heads two groups
        (9, text("e")), (9, text("e").upper()), (9, text("e") + " tail"),  # one group, one id
        (None, text("f")), (None, text("f")), (None, text("g")), (None, text("a")), (None, ""), (None, ""),
        (10, ""), (10, " "), (10, ""),
    ]
    got = [(r.doc_id, r.text) for r in cp.near_duplicate_groups(spark, docs(rows), SF).collect()]
    nine = [r for r in got if r[0] == 9]
    assert len(nine) == 1 and nine[0] in rows
    want = [(3, "a"), (5, "b"), (7, "c"), (7, "d"), (None, "f"), (None, "g"), (None, "a")]
    want = [(i, text(stem)) for i, stem in want] + [(None, ""), (10, ""), (10, " ")]
    assert sorted(map(str, set(got) - set(nine))) == sorted(map(str, want)) and len(got) == len(want) + 1
