from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nearmiss.llm import divergence as d

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def terms_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(rows, top=200):
    docs = [(lang or "", source or "", terms_of(text)) for _, text, lang, source, _ in rows]
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    out = Counter()
    for lang in {x[0] for x in docs}:
        kept = [t for t, n in held[lang].items() if n >= 3]
        mine = {s: c for (la, s), c in counts.items() if la == lang}

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(c) for s, c in mine.items()}
        q = shares(sum(mine.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in mine:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in mine if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if mine[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out.update((lang, s, part, item, v, k + 1) for k, (item, v) in enumerate(items[:most]))
    return out


def rows_in(parts):
    return [r for g, t, n, m in parts for r in zip(g.tolist(), t.cast("binary").to_pylist(), n.tolist(), m.tolist())]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abAZéß日 0-_@[`{\x00"), max_size=60), max_size=6))
def test_terms_are_counted_as_by_a_plain_loop(texts):
    texts = [*texts, None, "x" * 16 + " " + "x" * 17, "É" * 8 + " " + "É" * 9]
    groups = np.arange(len(texts)) % 2
    want, docs = Counter(), Counter()
    for g, text in zip(groups.tolist(), texts):
        want.update((g, t.encode()) for t in terms_of(text))
        docs.update({(g, t.encode()) for t in terms_of(text)})
    got = rows_in(d.count_terms([None if t is None else t.encode() for t in texts], groups))
    assert {(g, t): (n, m) for g, t, n, m in got} == {k: (n, docs[k]) for k, n in want.items()}
    assert len(got) == len(want)


def test_long_texts_are_cut_between_terms():
    text = "one two ÀÉ " + "y" * 100 + " two one-two " * 20
    want = Counter(t.encode() for t in terms_of(text))
    for size in (1, 5, 64, 10_000):
        assert {t: n for _, t, n, m in rows_in(d.count_long_text(text.encode(), 0, size)) if m == 1} == want


def test_radix_order_is_stable_and_in_order():
    rng = np.random.default_rng(1)
    for words in (rng.integers(0, 1 << 64, 999, dtype=np.uint64), rng.integers(0, 3, 999, dtype=np.uint32), np.zeros(0, np.uint64)):
        assert (d.radix_order(words) == np.argsort(words, kind="stable")).all()


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**15), st.integers(0, 10**15), st.integers(1, 10**12))
def test_shares_are_exact(n, more, n_terms):
    assert d.shares(np.array([n]), n + more, n_terms)[0] == 1 + 1_000_000_000 * (n + 1) // (n + more + n_terms)


def rows_of(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.choice((1, 2, 3, 8, 9, 16, 17, 30)))) for _ in range(60)]
    rows = []
    for k in range(n):
        text = " ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.randrange(40)))
        rows.append((k, rng.choice([text, text, text.upper(), None, ""]), rng.choice(["en", "en", "fr", None]), rng.choice(["s0", "s0", "s1", "s2", None, "é"]), 0))
    return [*rows, (0, "only here", "xx", "s0", 0), (1, None, "xx", "s1", 0), (2, "alone " * 5, "yy", "s0", 0), *rows[:5]]


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, crowded, monkeypatch, small):
    if small:  # many packed rows and tiles, long texts in pieces, tables joined without broadcast
        for name, value in (("PACKED_TERMS", 3), ("MATRIX_CELLS", 8), ("BATCH_ROWS", 5), ("SORTED_BYTES", 64), ("BROADCAST_GROUPS", 0)):
            monkeypatch.setattr(d, name, value)
    rows = rows_of(4, 120)
    df = crowded(spark.createDataFrame(rows, DOCS).repartition(4))
    for top in (200, 2):
        got = d.source_divergence(df, top=top).select("lang", "source", "part", "item", "value", "rank")
        assert Counter(map(tuple, got.collect())) == brute(rows, top)


def test_empty_table(spark):
    assert d.source_divergence(spark.createDataFrame([], DOCS)).count() == 0
