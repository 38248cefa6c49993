from __future__ import annotations

import os
import random
import zlib

import numpy as np
import public_tokenizers as tokens
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from nearmiss.llm import packing as p

RANKS, SPECIAL = tokens.path("byte_bpe_50k.tiktoken"), {"<|endoftext|>": 50256}


def fewest(items, size):
    best = [len(items)]
    items = sorted(items, reverse=True)

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for j in {r: k for k, r in enumerate(rooms) if r >= items[i]}.values():
            rooms[j] -= items[i]
            place(i + 1, rooms)
            rooms[j] += items[i]
        rooms.append(size - items[i])
        place(i + 1, rooms)
        rooms.pop()

    place(0, [])
    return best[0]


def test_fixed_sets_belong_to_a_best_packing():
    rng = random.Random(1)
    fixed_sets = 0
    for _ in range(800):
        size = rng.choice([10, 20, 30])
        items = [rng.randint(1, size) for _ in range(rng.randint(1, 8))]
        left = np.bincount(items, minlength=size + 1)
        patterns, fixed = p.reduce_and_fit(left, size)
        assert sorted(x for lengths, times in patterns for x in lengths * times) == sorted(items)
        assert all(sum(lengths) <= size and times > 0 for lengths, times in patterns)
        seen = 0
        for lengths, times in patterns:
            if seen == fixed:
                break
            seen += times
            for x in lengths:
                left[x] -= times
        rest = [x for x in range(size + 1) for _ in range(left[x])]
        assert fixed + fewest(rest, size) == fewest(items, size)
        fixed_sets += fixed
    assert fixed_sets > 1000


def test_large_instance_is_near_the_bound():
    counts = np.bincount(np.random.default_rng(2).integers(1, 2049, 10**6), minlength=2049)
    patterns, fixed = p.reduce_and_fit(counts, 2048)
    bound = -(-int((counts * np.arange(2049)).sum()) // 2048)
    assert sum(t for _, t in patterns) <= 1.001 * bound and fixed > 0.9 * bound
    assert len(patterns) < 3 * 2048


def _plain_best_fit(lengths, size):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else size) - x)
    return sorted(rooms)


@settings(max_examples=500, deadline=None)
@given(st.integers(3, 40).flatmap(lambda size: st.tuples(st.just(size), st.lists(st.integers(1, size), max_size=60))))
def test_best_fit_equals_a_plain_one(instance):
    """The same room is left in as many sequences, whatever is placed at once."""
    size, lengths = instance
    counts = np.bincount(lengths, minlength=size + 1)
    patterns = p.best_fit(counts, size)
    assert sorted(size - sum(x) for x, n in patterns for _ in range(n)) == _plain_best_fit(lengths, size)
    assert (sum(np.bincount(x, minlength=size + 1) * n for x, n in patterns) == counts).all() or not lengths


def test_best_fit_of_very_many_pieces():
    counts = np.random.default_rng(3).integers(0, 10**9, 2049)
    counts[0] = 0
    patterns = p.best_fit(counts, 2048)
    bound = -(-int((counts * np.arange(2049)).sum()) // 2048)
    assert len(patterns) < 4 * 2048 and sum(n for _, n in patterns) <= 1.01 * bound


def test_pieces_of_long_documents():
    assert p.cut_lengths(2048, 2048) == [2048]
    assert p.cut_lengths(2049, 2048) == [1, 2048]
    assert p.cut_lengths(4096, 2048) == [2048, 2048]


@pytest.mark.parametrize("size", [2048, 16])
def test_round_trip(docs, crowded, size):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    library = Tokenizer.from_file(tokens.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("the river stone zzq é 12 <|endoftext|>".split()) for _ in range(rng.randrange(60)))) for i in range(80)]
    rows += [(90, None), (91, ""), (92, "word " * 5000), (92, "other"), (93, "same"), (93, "same"), (None, "no id"), (94, "  \n\n x"), (95, "日本語")]
    got = p.pack_documents(crowded(docs(rows)), RANKS, tokens.PATTERN, SPECIAL, size=size, with_ids=True).collect()
    want = sorted(str([*library.encode(t or "", add_special_tokens=False).ids, 0]) for _, t in rows)
    places: dict[int, list] = {}
    texts: dict[tuple, list] = {}
    for r in got:
        assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length <= size
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        texts.setdefault((r.doc_id, r.piece, r.start), []).append(r.ids)
    for held in places.values():  # gapless from 0
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    # documents put together again; the repeated ones are told apart by their pieces
    by_doc: dict = {}
    for (doc_id, piece, start), ids in sorted(texts.items(), key=str):
        by_doc.setdefault((str(doc_id)), []).append((piece, start, ids))
    joined = []
    for doc_id, parts in by_doc.items():
        if doc_id in ("92", "93"):
            continue
        assert [x[0] for x in sorted(parts)] == list(range(len(parts)))
        whole, at = [], 0
        for _, start, ids in sorted(parts):
            assert len(ids) == 1 and start == at
            whole += ids[0]
            at += len(ids[0])
        joined.append(str(whole))
    again = [str([*library.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows if i in (92, 93)]
    assert sorted(joined + again) == want
    lengths = [r.length for r in got]
    assert len(places) <= 1.1 * -(-sum(lengths) // size) + 1


def test_empty_table(docs):
    assert p.pack_documents(docs([]), RANKS, tokens.PATTERN, SPECIAL).count() == 0
