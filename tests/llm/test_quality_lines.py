from __future__ import annotations

import itertools
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nearmiss.llm import quality_lines as q

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FAST = settings(max_examples=150, deadline=None)


def brute(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            again += line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


ODD = ["", None, " \n\n", "a", "a a a a a", "x\x0by\x0cz", "é\xa0b c", "l\nl\n \nl\n\n", "  a\u0085b", "#*$ %&|<>"]
texts = st.lists(st.text(alphabet="ab #|\n\té\xa0.", max_size=60), min_size=1, max_size=6)


@FAST
@given(texts)
def test_counts_match_brute_force(some):
    some = some + ODD
    counts = q.describe(some)[0]
    got = list(zip(*(counts[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
    assert got == [brute(t) for t in some]


def test_many_different_words_use_wide_keys():
    words = [b"%d" % i for i in range((1 << 21) + 5)]
    words += words[:3]
    assert np.flatnonzero(q.repeated_words(words)).tolist() == [0, 1, 2, len(words) - 3, len(words) - 2, len(words) - 1]


@FAST
@given(st.lists(st.integers(0, 5), min_size=1, max_size=5), st.integers(0, 2**32 - 1))
def test_viterbi_is_the_best_sequence(lengths, seed):
    rng = np.random.default_rng(seed)
    field = q.Field(rng.normal(size=2), rng.normal(size=(2, 2)), rng.normal(size=(3, 2)))
    features = rng.normal(size=(sum(lengths), 3))
    labels = q.viterbi(field, np.array(lengths), features)
    emit = features @ field.emit

    def score(at, seq):
        s = field.start[seq[0]] + emit[at, seq[0]]
        return s + sum(field.step[a, b] + emit[at + k + 1, b] for k, (a, b) in enumerate(zip(seq, seq[1:])))

    at = 0
    for n in lengths:
        if n:
            best = max(score(at, seq) for seq in itertools.product((0, 1), repeat=n))
            assert score(at, labels[at : at + n].tolist()) == pytest.approx(best)
        at += n


def test_training_tells_marked_lines():
    rng = np.random.default_rng(3)
    n_lines = np.full(60, 4)
    bad = np.arange(60) % 3 == 0
    features = np.zeros((240, len(q.FEATURES)))
    features[:, 0] = 1
    features[:, 1] = np.where(np.repeat(bad, 4), 0.9, 0.0) + 0.01 * rng.random(240)
    field = q.fit(n_lines, features, bad)
    assert (q.viterbi(field, n_lines, features) == np.repeat(bad, 4)).all()


def good(k, n=60):
    return " ".join(f"word{k}x{i}" for i in range(n)) + "."


def test_query_rows(docs, crowded, spark):
    junk = " ".join(f"ab{i}&&&" for i in range(70))
    rows = [good(1), good(2), junk, None, "", "short text", "again and so " * 40, good(1)] + [good(k) for k in range(10, 40)]
    rows += [" ".join(f"cd{k}{i}###" for i in range(60)) for k in range(10)]
    frame = crowded(docs(rows))
    labels = spark.createDataFrame(
        [(i, 0 if "###" in (t or "") else 1, 0) for i, t in enumerate(rows) if i > 7] + [(None, 1, 0), (3, None, None)],
        "doc_id long, quality int, toxic int",
    )
    field = q.train_field(frame, labels)
    got = {r.doc_id: r for r in q.label_lines(frame, field).collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(rows):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert [got[i].kept for i in range(8)] == [True, True, False, False, False, False, False, True]
    kept = q.keep_content(frame, field)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_empty_tables_and_no_labels(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    field = q.train_field(docs([]), labels)
    assert q.label_lines(docs([]), field).count() == 0
    assert q.train_field(docs([good(1)]), labels).emit.tolist() == q.default_field().emit.tolist()
    assert [r.kept for r in q.label_lines(docs([good(1), " ".join(f"a{i}&&&" for i in range(70))]), field).orderBy("doc_id").collect()] == [True, False]


def test_training_takes_one_row_of_an_id_and_bounded_lines(spark, monkeypatch):
    """3,000 rows of one id are one document, and a long one gives TRAINING_LINES lines."""
    seen = []
    monkeypatch.setattr(q, "fit", lambda n_lines, features, bad: seen.append((n_lines.tolist(), len(features), bad.tolist())))
    monkeypatch.setattr(q, "TRAINING_LINES", 50)
    rows = [(1, f"some line number {k}") for k in range(3000)] + [(2, "a longer line of words\n" * 400)]
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    q.train_field(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), labels)
    assert seen == [([1, 50], 51, [True, False])]
