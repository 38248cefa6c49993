"""Token counts of a piece-wise BPE model by rank-synchronous array merging.

Texts are cut into pre-tokens that no piece of the vocabulary can span. The distinct
ones of a batch are laid end to end in one ragged numpy array of symbols. In each step
every pre-token finds its lowest-ranked pair and all of them merge theirs at once; what
has no pair left leaves the array, and its surviving symbols are its tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearmiss.llm.common import arrow_batch, text_slices

TYPES = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_tokens": pa.int64(), "over_limit": pa.bool_()}
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

NONE = np.int32(2**31 - 1)
#: Pre-tokens that a worker remembers before it starts anew.
REMEMBERED = 400_000
#: The mark that stands for a space, as the model's format has it.
SPACE = "▁"
#: Pre-tokens without any space or line break; a run of spaces belongs to the word behind it.
PRE_TOKEN = re.compile(r" *[^ \n]+| +|\n")


@dataclass
class PieceTables:
    """A vocabulary as arrays. Symbols are numbered: pieces, single characters that only
    occur inside pieces, and last one symbol for each UTF-8 length of foreign characters."""

    characters: np.ndarray  # code point -> symbol
    weights: np.ndarray  # symbol -> tokens it counts if it survives
    pairs: np.ndarray  # sorted left * len(weights) + right
    merged: np.ndarray  # the symbol a pair becomes
    ranks: np.ndarray  # and its rank
    alone: np.ndarray  # rank -> only the leftmost such pair may merge at a time
    bonds: np.ndarray  # sorted character pairs, numbered as pairs are, that some piece holds


def load_tables(model_file: str) -> PieceTables:
    """The tables of a sentencepiece BPE model with byte fallback, without normalisation."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = sp.get_piece_size()
    usual = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    if sum(sp.is_byte(i) for i in range(n)) != 256 or sp.encode("a  b ", out_type=str)[-1] != SPACE:
        raise ValueError("a model with byte fallback that keeps spaces is needed")
    symbol = {sp.id_to_piece(i): k for k, i in enumerate(usual)}
    scores = [sp.get_score(i) for i in usual]
    pieces = list(symbol)
    for piece in pieces:
        if len(piece) > 1 and (SPACE in piece.lstrip(SPACE) or "\n" in piece):
            raise ValueError("pieces that span words or lines can't be counted by pre-tokens")
        for c in piece:
            symbol.setdefault(c, len(symbol))
    size = len(symbol) + 4
    rank_of = {s: r for r, s in enumerate(sorted(set(scores), reverse=True))}
    found = sorted(
        (symbol[p[:k]] * size + symbol[p[k:]], symbol[p], rank_of[scores[symbol[p]]])
        for p in pieces
        for k in range(1, len(p))
        if p[:k] in symbol and p[k:] in symbol
    )
    pairs, merged, ranks = (np.array(x, dtype=d) for x, d in zip(zip(*found), (np.int64, np.int32, np.int32)))
    # A rank whose product can join at once in a pair of that rank or a lower one must be
    # merged one at a time, else the order of merges in a sequence would differ.
    least = np.full(size, NONE)
    np.minimum.at(least, pairs // size, ranks)
    np.minimum.at(least, pairs % size, ranks)
    alone = np.zeros(len(rank_of), dtype=bool)
    alone[ranks[least[merged] <= ranks]] = True
    weights = np.ones(size, dtype=np.int64)
    for c, k in symbol.items():
        if k >= len(pieces):
            weights[k] = len(c.encode())
    weights[len(symbol) :] = (1, 2, 3, 4)
    points = np.arange(0x110000)
    characters = (len(symbol) + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)).astype(np.int32)
    for c, k in symbol.items():
        if len(c) == 1:
            characters[ord(c)] = k
    characters[ord(" ")] = characters[ord(SPACE)]
    bonds = np.array(sorted({symbol[a] * size + symbol[b] for p in pieces for a, b in zip(p, p[1:])}), dtype=np.int64)
    return PieceTables(characters, weights, pairs, merged, ranks, alone, bonds)


def count_pieces(pre_tokens: list[str], t: PieceTables) -> np.ndarray:
    """Tokens of each pre-token (a space stands for the mark)."""
    out = np.zeros(len(pre_tokens), dtype=np.int64)
    lengths = np.fromiter(map(len, pre_tokens), dtype=np.int64, count=len(pre_tokens))
    points = np.frombuffer("".join(pre_tokens).encode("utf-32-le"), dtype="<u4")
    symbols = t.characters[points].astype(np.int64)
    size = len(t.weights)
    if not len(symbols):
        return out
    # No merge can cross two characters that stand together in no piece: cut there too,
    # which keeps runs without spaces short. ``owner`` numbers the cut parts.
    origin = np.repeat(np.arange(len(pre_tokens)), lengths)
    keys = symbols[:-1] * size + symbols[1:]
    k = np.minimum(np.searchsorted(t.bonds, keys), len(t.bonds) - 1)
    cuts = (t.bonds[k] != keys) | (origin[1:] != origin[:-1])
    owner = np.cumsum(np.r_[False, cuts])
    origin = origin[np.r_[True, cuts]]

    def look_up(at: np.ndarray) -> None:
        """Rank and product of the pairs that begin at these places."""
        at = at[at < len(symbols) - 1]
        at = at[owner[at] == owner[at + 1]]
        keys = symbols[at] * size + symbols[at + 1]
        k = np.minimum(np.searchsorted(t.pairs, keys), len(t.pairs) - 1)
        hit = t.pairs[k] == keys
        rank[at] = np.where(hit, t.ranks[k], NONE)
        product[at] = t.merged[k]

    rank = np.full(len(symbols), NONE)
    product = np.zeros(len(symbols), dtype=np.int64)
    look_up(np.arange(len(symbols)))
    while len(symbols):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        least = np.minimum.reduceat(rank, first)
        runs = np.diff(np.r_[first, len(symbols)])
        if (least == NONE).any():
            left = np.repeat(least == NONE, runs)
            np.add.at(out, origin[owner[left]], t.weights[symbols[left]])
            symbols, owner, rank, product = symbols[~left], owner[~left], rank[~left], product[~left]
            runs, least = runs[least != NONE], least[least != NONE]
            if not len(symbols):
                break
            first = np.cumsum(runs) - runs
        marked = np.flatnonzero(rank == np.repeat(least, runs))
        mine = owner[marked]
        fresh = np.r_[True, (marked[1:] != marked[:-1] + 1) | (mine[1:] != mine[:-1])]
        start = np.flatnonzero(fresh)
        in_run = np.arange(len(marked)) - np.repeat(start, np.diff(np.r_[start, len(marked)]))
        leftmost = np.r_[True, mine[1:] != mine[:-1]]
        marked = marked[np.where(t.alone[rank[marked]], leftmost, in_run % 2 == 0)]
        symbols[marked] = product[marked]
        stay = np.ones(len(symbols), dtype=bool)
        stay[marked + 1] = False
        moved = np.cumsum(stay) - 1
        symbols, owner, rank, product = symbols[stay], owner[stay], rank[stay], product[stay]
        at = moved[marked]
        rank[at] = NONE
        before = at[at > 0] - 1
        rank[before] = NONE
        changed = np.zeros(len(symbols), dtype=bool)
        changed[at] = changed[before] = True
        look_up(np.flatnonzero(changed))
    return out


class Counter:
    """Counts texts, with the pre-tokens seen so far remembered."""

    def __init__(self, tables: PieceTables):
        self.tables, self.known = tables, {}

    def count(self, texts: list[str | None]) -> list[int]:
        # the library puts one space before a text
        cut = [PRE_TOKEN.findall(" " + x.replace(SPACE, " ")) if x else [] for x in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = list(set().union(*cut).difference(self.known))
        self.known.update(zip(new, count_pieces(new, self.tables).tolist()))
        get = self.known.__getitem__
        return [sum(map(get, x)) for x in cut]


def token_counts(
    documents: DataFrame, tables: PieceTables, limit: int = 4096, *, id_col="doc_id", text_col="text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``documents``.

    A null text counts as empty: no bytes, no tokens. Repeated rows stay repeated, null
    ids stay null, an empty table gives no rows; other columns are not read. Of equally
    ranked pairs the leftmost merges first, as in the library.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vars(tables))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(PieceTables(**shared.value))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in text_slices(texts):
                part = batch.slice(lo, hi - lo)
                tokens = counter.count(texts[lo:hi])
                yield arrow_batch(
                    {
                        "doc_id": part.column(0),
                        "n_bytes": pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64()),
                        "n_tokens": tokens,
                        "over_limit": [n > limit for n in tokens],
                    },
                    TYPES,
                )

    slim = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, SCHEMA)
