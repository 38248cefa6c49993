from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nearmiss.llm import suffix_dedup as s
from nearmiss.llm.suffix_sort import blind_trie_order, sort_with_prefixes


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=30).map(lambda b: (b"ab" * 60 + b)[-150:]), min_size=1, max_size=30), st.booleans())
def test_deep_shallow_order(strings, same_start):
    strings = [(x if same_start else x[::-1]).ljust(150, b"\0") for x in strings]
    order, prefix = sort_with_prefixes(np.array([list(x) for x in strings], dtype=np.uint8))
    found = [strings[i] for i in order]
    assert found == sorted(strings) and sorted(order.tolist()) == list(range(len(strings)))
    for a, b, n in zip(found, found[1:], prefix[1:]):
        assert n == next((k for k in range(150) if a[k] != b[k]), 150)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=5, max_size=5), min_size=1, max_size=40))
def test_blind_trie_alone(strings):
    order = blind_trie_order(strings, np.arange(len(strings)))
    assert [strings[i] for i in order] == sorted(strings)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12))
def test_runs_of_a_sorted_order(shared):
    prefix = np.array([0, *shared])
    want = set()
    for a in range(len(prefix)):
        for b in range(a + 2, len(prefix) + 1):
            n = min(prefix[a + 1 : b])
            if (a == 0 or prefix[a] < n) and (b == len(prefix) or prefix[b] < n):
                want.add((a, b, int(n)))
    found = list(s.runs_of(prefix))
    assert set(found) == want and len(found) == len(want)


def brute(texts):
    encoded = [(t or "").encode() for t in texts]
    seen = Counter(e[i : i + s.WINDOW] for e in encoded for i in range(len(e) - s.WINDOW + 1))
    out = []
    for e in encoded:
        gone = np.zeros(len(e), dtype=bool)
        for i in range(len(e) - s.WINDOW + 1):
            if seen[e[i : i + s.WINDOW]] > 1:
                gone[i : i + s.WINDOW] = True
        rest = bytes(np.frombuffer(e, dtype=np.uint8)[~gone])
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(e), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("the of and é thing stone river zz".split()) + str(rng.randrange(99))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, line = prose(80), prose(18)
    out = [prose(rng.randrange(1, 200)) for _ in range(20)]
    for _ in range(25):  # passages cut at both ends, with an odd letter inside
        a, b = sorted(rng.sample(range(len(passage)), 2))
        piece = passage[a:b]
        if rng.random() < 0.4 and len(piece) > 10:
            k = rng.randrange(len(piece))
            piece = piece[:k] + "#" + piece[k + 1 :]
        out.append(prose(rng.randrange(0, 30)) + piece + prose(rng.randrange(0, 30)))
    out += [prose(10) + line + prose(10) for _ in range(10)]  # shared, but too short
    out += [out[0], out[0], out[30], "a" * 500, "ab" * 300, "x" + "a" * 230, "a" * 199, "a" * 200, "", None, "é" * 150, "\0" * 250 + "b"]
    out += [passage[:199], passage[5:205], passage + passage]
    return out


@pytest.mark.parametrize("seed,frequent", [(1, 2000), (2, 3), (3, 0)])
def test_rows_match_brute_force(docs, crowded, monkeypatch, seed, frequent):
    monkeypatch.setattr(s, "FREQUENT", frequent)
    texts = corpus(seed)
    got = s.remove_repeats(crowded(docs(texts))).collect()
    assert len(got) == len(texts)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got}
    assert [found[i] for i in range(len(texts))] == brute(texts)


def test_long_texts_are_searched_in_overlapping_pieces(monkeypatch):
    text = bytes(random.Random(1).choices(b"abcd efgh", k=5000))
    whole = s.anchors([text])
    monkeypatch.setattr(s, "PIECE", 300)
    monkeypatch.setattr(s, "SLICE", 700)
    parts = s.anchors([text])
    assert set(zip(parts[1].tolist(), parts[2].tolist())) == set(zip(whole[1].tolist(), whole[2].tolist()))


def test_null_ids_repeated_rows_and_kept_text(docs):
    long = "word éé " * 60
    rows = [(None, long), (4, long), (4, long), (5, None), (6, "é" * 99 + long[:199] + "x")]
    got = s.remove_repeats(docs(rows), with_text=True, whole_characters=True, carry=("lang",)).collect()
    assert len(got) == 5
    for r in got:
        assert r["_carry_lang"] == "en"
        text = r.kept.decode()
        assert (r.n_removed == r.n_bytes) == (text == "")
    assert s.remove_repeats(docs([])).count() == 0


@pytest.mark.parametrize("sure,gathered", [(1, 40), (3, 1 << 20)])
def test_anchors_frequent_in_one_task(docs, monkeypatch, sure, gathered):
    monkeypatch.setattr(s, "SURE", sure)
    monkeypatch.setattr(s, "GATHERED", gathered)
    texts = corpus(4)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in s.remove_repeats(docs(texts)).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts)


def test_passage_of_most_texts_is_not_gathered(docs, monkeypatch):
    monkeypatch.setattr(s, "FREQUENT", 50)
    rng = random.Random(5)
    prose = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    passage = prose(100)
    texts = [prose(40) + passage + prose(40) for _ in range(600)]
    anchors = s.anchor_rows(docs(texts).select("text"), 64).cache()
    rows = np.concatenate([np.frombuffer(r.packed, dtype=s.ANCHOR) for r in anchors.collect()])
    counted = Counter(rows["key"][rows["sure"] < 2].tolist())
    assert max(Counter(rows["key"].tolist()).values()) == 600 and max(counted.values()) <= 3 * s.SURE
    contexts = s.context_rows(s.repeated_anchors(anchors, 64), s.text_rows(docs(texts).select("text"), 64), 64)
    held = Counter()
    for r in contexts.collect():
        held[r.bucket] += len(r.packed)
    assert max(held.values()) < 600 * s.CONTEXT.itemsize / 2  # one anchor of all texts with its surroundings
