from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from nearmiss.llm import token_count as t

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def tables():
    return t.load_tables(MODEL)


ODD = ["", None, " ", "  ", "a  b", " " * 40, "a" * 1000, "!" * 999, "▁▁x ▁ y", "\n\n \n", "\t\t", "日本語" * 50, "\x00a",
       "<s></s><0x0A>", "\r\n a", "abab" * 300, "==" * 50 + "-" * 77, "\U0001F600" * 9]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab theinos  ▁\n.!-=é日"), st.characters(codec="utf-8")), max_size=80)))
def test_counts_equal_the_library(tables, some):
    assert t.Counter(tables).count(some) == [len(LIBRARY.encode(x)) for x in some]


def test_odd_texts_and_joined_pieces(tables):
    rng = random.Random(5)
    pieces = [LIBRARY.id_to_piece(i).replace("▁", "") for i in range(300, 32000)]
    some = ODD + ["".join(rng.choice(pieces) for _ in range(400)) for _ in range(100)]
    assert t.Counter(tables).count(some) == [len(LIBRARY.encode(x or "")) for x in some]


def test_memory_of_pre_tokens_starts_anew(tables, monkeypatch):
    monkeypatch.setattr(t, "REMEMBERED", 3)
    counter = t.Counter(tables)
    for text in ("one two three four", "five six", "one seven"):
        assert counter.count([text]) == [len(LIBRARY.encode(text))]


def test_query_rows(docs, crowded, tables):
    rows = ["some words here", None, "", "é" * 10, "word " * 5000, "some words here"]
    got = t.token_counts(crowded(docs([*rows, (None, "x y")])), tables, 4096).collect()
    assert len(got) == 7
    for r in got:
        text = "x y" if r.doc_id is None else rows[r.doc_id] or ""
        n = len(LIBRARY.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 4096)
    assert t.token_counts(docs([]), tables, 1).count() == 0
