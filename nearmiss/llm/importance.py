"""Importance resampling towards a target distribution, over hashed word n-grams.

A 256-byte table lower-cases ASCII letters and blanks every separator of a text's UTF-8
bytes, and ``bytes.split`` gives the words. The crc32 of a run of words is chained: it
seeds the crc32 of the run that is one word longer. Counters of hash buckets are summed
over the corpus and over the target texts; the log ratio of both smoothed shares is a
bucket's gain, and a document's weight is the mean gain of its features. Gumbel noise
drawn from the id turns the highest scores into a sample without replacement.

Only bucket counts (at most ``buckets`` rows) and the sizes of the ranked parts reach the
driver; documents are ranked by a range partitioning and a prefix sum over its parts.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearmiss.llm.common import arrow_batch, cut

#: Lower-cases A-Z, keeps a-z, 0-9 and all bytes of other characters, blanks the rest.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Bytes of a text that are split into words at a time.
PIECE_BYTES = 1 << 20
#: Words whose value a task remembers before it starts anew.
REMEMBERED = 1 << 18
#: Rows of one Arrow batch that the ranking yields.
SCORED = {"doc_id": pa.int64(), "n_features": pa.int64(), "n_words": pa.int64(), "weight": pa.int64(), "score": pa.int64()}
SCORED_SCHEMA = ", ".join(f"{c} long" for c in SCORED)


class WordCrc(dict):
    """crc32 of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = crc32(word)
        return value


def word_pieces(data: bytes | None, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in lists, from about ``size`` bytes each; a word is never cut."""
    if not data:
        return
    data = data.translate(WORD_BYTES)
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            end = data.rfind(b" ", at, end) + 1 or data.find(b" ", end) + 1 or len(data)
        yield data[at:end].split()
        at = end


def features(pieces: Iterable[list[bytes]], least: int, most: int, crc: WordCrc) -> Iterator[tuple[int, list[int]]]:
    """For each piece its number of words and the crc32 of the runs of ``least`` to ``most``
    words that end in it; words of a run are joined by one space."""
    held: list[bytes] = []
    for piece in pieces:
        words = held + piece
        seeds = list(map(crc.__getitem__, words))
        found: list[int] = []
        for n in range(1, most + 1):
            if n > 1:
                seeds = [crc32(b" " + word, seed) for seed, word in zip(seeds, words[n - 1 :])]
            if n >= least:
                # a run of n words that begins at i ends at i + n - 1
                found += seeds[max(0, len(held) - n + 1) :]
        yield len(piece), found
        held = words[max(0, len(words) - most + 1) :] if most > 1 else []


def _binary(batch: pa.RecordBatch, k: int) -> Iterator[bytes | None]:
    """A text column's UTF-8 bytes, row by row."""
    column = batch.column(k).cast(pa.binary())
    return (x.as_py() for x in column)


def bucket_counts(df: DataFrame, *, least=1, most=1, buckets=10_000, text_col="text") -> DataFrame:
    """``bucket, n``: features of all texts by hash bucket, those that occur (at most ``buckets`` rows)."""

    def run(batches):
        total, crc = Counter(), WordCrc()
        for batch in batches:
            for data in _binary(batch, 0):
                for _, found in features(word_pieces(data), least, most, crc):
                    total.update(found)
                # crc32 values of longer runs hardly repeat: keep buckets only
                if len(total) > REMEMBERED:
                    total = _by_bucket(total, buckets)
        total = _by_bucket(total, buckets)
        yield arrow_batch({"bucket": list(total), "n": list(total.values())}, {"bucket": pa.int64(), "n": pa.int64()})

    texts = df.select(F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _by_bucket(counts: Counter, buckets: int) -> Counter:
    out = Counter()
    for value, n in counts.items():
        out[value % buckets] += n
    return out


def bucket_gains(raw: DataFrame, target: DataFrame, *, buckets=10_000, **how) -> list[int]:
    """Each bucket's gain: thousandths of the log ratio of its add-one smoothed share in the
    target to that in the raw corpus, floored."""
    counts = []
    for df in (raw, target):
        rows = bucket_counts(df, buckets=buckets, **how).collect()  # at most `buckets` rows
        found = dict(map(tuple, rows))
        counts.append([found.get(b, 0) for b in range(buckets)])
    s_of, t_of = counts
    s_all, t_all = float(sum(s_of) + buckets), float(sum(t_of) + buckets)
    return [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(s_of, t_of)]


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document in thousandths, from a hash of seed and id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(
    documents: DataFrame, gains: list[int], *, least=1, most=1, seed=2024, id_col="doc_id", text_col="text"
) -> DataFrame:
    """``doc_id, n_features, n_words, weight, score`` of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(gains)  # `buckets` numbers

    def run(batches):
        gain, crc = shared.value, WordCrc()
        size = len(gain)
        for batch in batches:
            rows = {name: [] for name in SCORED}
            for doc_id, data in zip(batch.column(0).to_pylist(), _binary(batch, 1)):
                n = words = total = 0
                for n_words, found in features(word_pieces(data), least, most, crc):
                    words += n_words
                    n += len(found)
                    total += sum([gain[value % size] for value in found])
                weight = total // n if n else 0
                for name, value in zip(SCORED, (doc_id, n, words, weight, weight + noise(doc_id, seed))):
                    rows[name].append(value)
            yield arrow_batch(rows, SCORED)

    slim = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, SCORED_SCHEMA)


def draw(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scored`` with ``rank``: of the N rows with ``least_words`` words or more the
    ``percent * N // 100`` highest scores, ties to smaller ids (null last); others null.

    Rows are range-partitioned in that order and written to the shared folder; a row's rank
    is its place in its part and the sizes of the parts before it. No part holds all rows,
    and the driver sees one number for each part.
    """
    fits = (F.col("n_words") >= least_words).alias("fits")
    order = [F.desc("fits"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features")]
    ranged = cut(scored.select("*", fits).repartitionByRange(*order[:3]).sortWithinPartitions(*order))
    parts = ranged.groupBy(F.spark_partition_id().alias("part")).agg(
        F.count("*").alias("n"), F.count_if("fits").alias("fits")
    )
    sizes = {r.part: (r.n, r.fits) for r in parts.collect()}  # one row for each part
    before, at = {}, 0
    for part in sorted(sizes):
        before[part] = at
        at += sizes[part][0]
    drawn = percent * sum(fits for _, fits in sizes.values()) // 100
    types = {**SCORED, "rank": pa.int64()}

    def run(batches):
        at = before.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            ranks = [k if k <= drawn else None for k in range(at + 1, at + 1 + batch.num_rows)]
            at += batch.num_rows
            yield arrow_batch({**{c: batch.column(c) for c in SCORED}, "rank": ranks}, types)

    return ranged.mapInArrow(run, f"{SCORED_SCHEMA}, rank long")


def resample(
    documents: DataFrame, target: DataFrame, *, percent=10, least_words=20, least=1, most=1,
    buckets=10_000, seed=2024, id_col="doc_id", text_col="text",
) -> DataFrame:
    """Every row of ``documents`` as ``doc_id, n_features, n_words, weight, score, rank``; the
    drawn ones, ``percent`` of those with ``least_words`` words, have a rank from 1 on.

    Null and empty texts have no features and weight 0, and can't be drawn while
    ``least_words`` is positive. Repeated rows count, are scored and drawn one by one; a null
    id hashes as no text and comes last among ties. With an empty target or corpus its counts
    are all 0 and smoothing alone gives the shares. Other columns are not read. Texts are
    split a piece of ``PIECE_BYTES`` at a time, runs over the edge of a piece included.
    """
    gains = bucket_gains(
        documents, target, buckets=buckets, least=least, most=most, text_col=text_col
    )
    scored = score_documents(documents, gains, least=least, most=most, seed=seed, id_col=id_col, text_col=text_col)
    return draw(scored, percent, least_words)
