from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest

from nearmiss.llm import importance as m

BENCH = "item_id long, text string"


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def runs_of(text, least, most):
    w = words_of(text)
    return [" ".join(w[i : i + n]) for n in range(least, most + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, percent, least_words, least, most, buckets):
    bucket = lambda run: crc32(run.encode()) % buckets
    s = Counter(bucket(r) for _, x in docs for r in runs_of(x, least, most))
    t = Counter(bucket(r) for x in target for r in runs_of(x, least, most))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows = []
    for doc_id, x in docs:
        found = [gain(bucket(r)) for r in runs_of(x, least, most)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, len(words_of(x))])
    able = sorted((r for r in rows if r[4] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return Counter((r[0], r[1], r[2], r[3], rank.get(id(r))) for r in rows)


TEXTS = (
    [None, "", " \n!?", "Ünïcode ÀB word9 9word", "a" * 50, "x-y_z  A.B"]
    + [f"common word number {i} of the {'rare' if i % 7 else 'TARGET text'} kind " * (i % 9) for i in range(60)]
)
TARGET = ["target text of the kind", "rare target", None, "Ünïcode"]


@pytest.mark.parametrize(("least", "most", "buckets"), [(1, 1, 10_000), (1, 3, 97), (2, 2, 1000)])
def test_equals_brute_force(spark, docs, crowded, monkeypatch, least, most, buckets):
    monkeypatch.setattr(m, "REMEMBERED", 20)
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[20]), (3, TEXTS[20]), (None, TEXTS[30])]
    bench = spark.createDataFrame(list(enumerate(TARGET)), BENCH)
    got = m.resample(crowded(docs(rows)), bench, percent=30, least=least, most=most, buckets=buckets)
    found = Counter(tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect())
    assert found == brute(rows, TARGET, 30, 20, least, most, buckets)


def test_pieces_keep_words_and_runs_whole():
    text = ("some Wörds " * 50 + "x" * 300 + " tail end").encode()
    whole = Counter(x for _, f in m.features(m.word_pieces(text), 1, 3, m.WordCrc()) for x in f)
    for size in (1, 7, 64, 301):
        pieces = list(m.word_pieces(text, size))
        assert [w for p in pieces for w in p] == text.translate(m.WORD_BYTES).split()
        assert Counter(x for _, f in m.features(pieces, 1, 3, m.WordCrc()) for x in f) == whole
    assert list(m.word_pieces(None)) == list(m.word_pieces(b"")) == []


def test_draw_follows_the_target(spark, docs):
    """Documents in the target's words are drawn far more often than the rest."""
    near, far = "alpha beta gamma delta " * 10, "one two three four " * 10
    rows = [(i, near if i % 10 == 0 else far) for i in range(1000)]
    bench = spark.createDataFrame([(0, near)], BENCH)
    drawn = [r for r in m.resample(docs(rows), bench, percent=10).collect() if r.rank]
    assert sorted(r.rank for r in drawn) == list(range(1, 101))
    # the weights differ by ln(99) at least, so an odds ratio near 100 for each draw
    assert sum(r.doc_id % 10 == 0 for r in drawn) > 60


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([], BENCH)
    assert m.resample(docs([]), bench).count() == 0
    got = m.resample(docs(["w " * 30] * 10), bench, percent=10).collect()
    assert sum(r.rank == 1 for r in got) == 1 and {r.n_features for r in got} == {30}
