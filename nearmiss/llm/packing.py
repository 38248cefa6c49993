"""Packing of token pieces into fixed-length sequences.

Documents are tokenised and cut into pieces on the executors. A packing only depends on
how many pieces there are of each length, and lengths go up to the sequence length, so
the instance is a histogram of bounded size. It is solved on that: by Martello and
Toth's reduction, sets of up to three lengths that dominate every other set with the
longest length are fixed as often as they can be, which shrinks the instance; the rest
is placed by best fit, on a histogram of the room in open sequences. The result is a short list of patterns (lengths of a sequence,
and how many such sequences). Executors number the pieces of each length and read their
place off the patterns.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearmiss.llm.common import arrow_batch, cut, text_slices

#: Pieces for each group that those of one length are numbered in, so that a frequent length
#: is no hot key, and the least and the most such groups.
SHARD_PIECES, SHARDS = 1_000_000, (16, 1 << 14)

PIECE_TYPES = {
    "doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
    "ids": pa.list_(pa.int32()),
}
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_bpe(rank_file: str, pattern: str, special: dict[str, int]):
    """The byte-level BPE encoder of a rank file; special texts become their ids."""
    import base64

    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def cut_lengths(n: int, size: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids: whole if it fits, else a first piece
    with what full pieces leave over."""
    if n <= size:
        return [n]
    first = n % size
    return [first] * (first > 0) + [size] * (n // size)


def token_pieces(
    documents: DataFrame, rank_file: str, pattern: str, special: dict[str, int], end_id: int, size: int,
    *, id_col="doc_id", text_col="text", with_ids=False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of the pieces of each document."""
    types = {k: v for k, v in PIECE_TYPES.items() if with_ids or k != "ids"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(rank_file, pattern, special)
        for batch in batches:
            texts, doc_ids = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for lo, hi in text_slices(texts):
                rows: dict[str, list] = {k: [] for k in types}
                for doc_id, text in zip(doc_ids[lo:hi], texts[lo:hi]):
                    ids = encoder.encode_to_numpy(text or "", allowed_special="all")
                    ids = np.append(ids, end_id).astype("<u4")
                    at = 0
                    for piece, length in enumerate(cut_lengths(len(ids), size)):
                        own = ids[at : at + length]
                        row = (doc_id, piece, at, length, zlib.crc32(own.tobytes()), own)
                        for held, value in zip(rows.values(), row):
                            held.append(value)
                        at += length
                yield arrow_batch(rows, types)

    slim = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, PIECE_SCHEMA + ", ids array<int>" * with_ids)


def dominating_set(left: np.ndarray, longest: int, room: int) -> tuple[int, ...] | None:
    """Other lengths that, with ``longest``, dominate every set that holds it; None if no
    set of up to three lengths is known to.

    ``left`` counts the pieces of each length without the one at hand; ``room`` is what it
    leaves free. A set dominates another if the lengths of the other can be dealt out into
    its own, several of them into one at most as long as that.
    """
    lengths = np.flatnonzero(left[: room + 1])
    if not len(lengths):
        return ()
    k = int(lengths[-1])
    short = int(lengths[0])
    second = short if left[short] > 1 else int(lengths[1]) if len(lengths) > 1 else None
    # the best partner fills the room, or no two others fit together
    if k == room or second is None or short + second > room:
        return (k,)
    # pairs that fit together, the longer one first
    counts = left[lengths]
    partner = np.searchsorted(lengths, room - lengths, side="right") - 1
    partner = np.minimum(partner, np.arange(len(lengths)))
    same = (partner == np.arange(len(lengths))) & (counts == 1)
    partner = partner - same
    fits = partner >= 0
    if not fits.any():
        return (k,)
    longer, shorter = lengths[fits], lengths[partner[fits]]
    sums = longer + shorter
    third = second if short * 2 > room else short
    triples = short + second + (short if left[short] > 2 else third) <= room
    if int(sums.max()) <= k and not triples:
        return (k,)
    # three others don't fit, and one pair is no shorter than any other in both places
    i = int(np.argmax(sums))
    if not triples and longer[i] == k and shorter[i] == shorter.max():
        return (int(longer[i]), int(shorter[i]))
    return None


def reduce_and_fit(counts: np.ndarray, size: int) -> tuple[list[tuple[tuple[int, ...], int]], int]:
    """Patterns (lengths, times) that place ``counts[length]`` pieces of each length up to
    ``size``, and how many sequences the reduction fixed.

    From the longest length down, a dominating set is fixed as often as its lengths last; a
    length without one is passed over, but may still be part of a later set. Best fit places
    the rest.
    """
    left = np.array(counts, dtype=np.int64)
    patterns: list[tuple[tuple[int, ...], int]] = []
    fixed = 0
    for longest in range(size, 0, -1):
        while left[longest]:
            left[longest] -= 1
            others = dominating_set(left, longest, size - longest)
            left[longest] += 1
            if others is None:
                break
            pattern = (longest, *others)
            times = repeats(pattern, left)
            for length in pattern:
                left[length] -= times
            patterns.append((pattern, times))
            fixed += times
    return patterns + best_fit(left, size), fixed


def best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns that place the pieces of each length by best fit, longest first: a piece goes into
    the open sequence with the least room that takes it, or opens one.

    Open sequences are kept by their room, equal ones as one pattern and a number. A sequence
    that takes a piece has even less room then, so it takes the next ones of that length, too, while
    they fit: whole groups are filled at once, and each length splits one group at most.
    """
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # room -> groups of that room
    open_ = np.zeros(size + 1, dtype=bool)

    def put(room: int, pattern: tuple[int, ...], times: int) -> None:
        if times:
            rooms.setdefault(room, []).append((pattern, times))
            open_[room] = True

    for length in range(size, 0, -1):
        n = int(left[length])
        while n:
            fits = np.flatnonzero(open_[length:])
            room = length + int(fits[0]) if len(fits) else size
            pattern, times = rooms[room].pop() if len(fits) else ((), n)
            if len(fits) and not rooms[room]:
                open_[room] = False
            each = room // length
            full = min(times, n // each)
            put(room - each * length, pattern + (length,) * each, full)
            n -= full * each
            times -= full
            if n and times and n < each:  # the last pieces of this length
                put(room - n * length, pattern + (length,) * n, 1)
                n, times = 0, times - 1
            if len(fits):
                put(room, pattern, times)
    return [group for groups in rooms.values() for group in groups]


def repeats(pattern: tuple[int, ...], left: np.ndarray) -> int:
    """How often a pattern can be laid with the pieces that are left."""
    lengths, needed = np.unique(pattern, return_counts=True)
    return int((left[lengths] // needed).min())


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The patterns as runs of equal-length pieces: of each run its length, the number of its
    first piece among those of that length, its first sequence and its offset there."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + times
            offset += length
        sequence += times
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "first", "sequence", "offset"), table.T.copy()))


def pack(pieces: DataFrame, size: int) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``size``) plus ``sequence_id`` and ``offset``.

    The only data the driver sees is the histogram: ``size`` rows at most. The table of
    runs sent back is bounded by ``size`` as well (a fixed pattern uses up a length, and best fit
    splits one group of equal sequences for each length at most).
    """
    spark = pieces.sparkSession
    pieces = cut(pieces)
    shards = min(max(pieces.count() // SHARD_PIECES, SHARDS[0]), SHARDS[1])
    pieces = pieces.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)).cast("int"))
    groups = cut(pieces.groupBy("length", "_shard").agg(F.count("*").alias("_n")))
    counts = np.zeros(size + 1, dtype=np.int64)
    for length, n in groups.groupBy("length").agg(F.sum("_n")).collect():
        counts[length] = n
    table = places(reduce_and_fit(counts, size)[0])
    shared = spark.sparkContext.broadcast(table)
    before = Window.partitionBy("length").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = Window.partitionBy("length", "_shard").orderBy("doc_id", "piece", "ids_crc32", "start")
    numbered = (
        pieces.withColumn("_k", F.row_number().over(own).cast("long") - 1)
        .join(groups.hint("merge"), ["length", "_shard"])
        .withColumn("_k", F.col("_k") + F.col("_before"))
        .drop("_before", "_shard")
    )
    names = [c for c in pieces.columns if c != "_shard"]
    schema = numbered.select(*names).schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        lengths, k_of = np.unique(runs["length"], return_index=True)
        ends = np.append(k_of[1:], len(runs["length"]))
        for batch in batches:
            length = batch.column("length").to_numpy()
            k = batch.column("_k").to_numpy()
            at = np.empty(len(k), dtype=np.int64)
            for one in np.unique(length):
                i = int(np.searchsorted(lengths, one))
                mine = length == one
                at[mine] = k_of[i] + np.searchsorted(runs["first"][k_of[i] : ends[i]], k[mine], side="right") - 1
            columns = [batch.column(c) for c in names]
            columns += [pa.array(runs["sequence"][at] + k - runs["first"][at]), pa.array(runs["offset"][at])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    return numbered.mapInArrow(run, schema)


def pack_documents(
    documents: DataFrame, rank_file: str, pattern: str, special: dict[str, int], *, end_id=0, size=2048,
    id_col="doc_id", text_col="text", with_ids=False,
) -> DataFrame:
    """Pieces of all documents with their place: ``doc_id, piece, start, length, ids_crc32,
    (ids,) sequence_id, offset``.

    A null text is empty and gives one piece with the end id alone. Repeated rows are
    documents of their own, null ids stay null, an empty table gives no rows; other
    columns are not read. Pieces of equal length are numbered by id, so ties don't matter
    for the number of sequences.
    """
    pieces = token_pieces(
        documents, rank_file, pattern, special, end_id, size, id_col=id_col, text_col=text_col, with_ids=with_ids
    )
    return pack(pieces, size)
