"""Quality rules by line sequence labelling.

A linear-chain conditional random field labels the lines of a document as content or
boilerplate; Viterbi decoding finds the best sequence, and the share of words in content
lines decides whether the document is kept. The field is trained on weak line labels
that come from document labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearmiss.llm.common import arrow_batch, segments, text_slices

CONTENT, BOILERPLATE = 0, 1
#: Labelled documents that the field is fitted on, the first by a hash of the id.
TRAINING_DOCUMENTS = 2000
#: Lines of one of them that count.
TRAINING_LINES = 2000
#: A document is kept from this share of words in content lines on.
CONTENT_SHARE = 0.5

FEATURES = ("bias", "symbols", "capitals", "shouts", "digits", "repeated line", "repeated words", "short", "closed")

TYPES = {
    "doc_id": pa.int64(), "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(),
    "n_lines": pa.int64(), "n_content_lines": pa.int64(), "content_share": pa.float64(),
}
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_content_lines long, content_share double"
)

WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"


def flags(characters: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(characters)] = True
    return out


IS_WHITE = flags(WHITE)
IS_SYMBOL = flags(b"#*$%&|<>")
IS_UPPER = flags(bytes(range(65, 91)))
IS_LETTER = IS_UPPER | flags(bytes(range(97, 123)))
IS_DIGIT = flags(bytes(range(48, 58)))
IS_SHOUT = flags(b"!")
STARTS_CHARACTER = np.array([(b & 0xC0) != 0x80 for b in range(256)])


@dataclass
class Field:
    """A linear-chain field over two labels."""

    start: np.ndarray  # label
    step: np.ndarray  # label before, label
    emit: np.ndarray  # feature, label


def default_field() -> Field:
    """What stands in where no labelled documents of both kinds are at hand: many symbols,
    capitals, shouts or repetitions speak for boilerplate."""
    emit = np.zeros((len(FEATURES), 2))
    emit[:, BOILERPLATE] = (-3.0, 8.0, 6.0, 8.0, 2.0, 3.0, 4.0, 0.0, 0.0)
    return Field(np.zeros(2), np.array([[0.5, -0.5], [-0.5, 0.5]]), emit)


def repeated_words(words: list[bytes]) -> np.ndarray:
    """Which words stand in a 3-word window that occurs twice or more."""
    covered = np.zeros(len(words), dtype=bool)
    if len(words) < 4:
        return covered
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
    if len(known) < 1 << 21:
        keys = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:  # pairs are numbered first, so that no two windows share a key
        pairs = np.unique((ids[:-2] << 31) | ids[1:-1], return_inverse=True)[1]
        keys = (pairs << 31) | ids[2:]
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice):
        at = np.flatnonzero(np.isin(keys, twice))
        for k in range(3):
            covered[at + k] = True
    return covered


def describe(texts: list[str | None]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Counts of each text, and of its lines that have a word: how many there are in each
    text, their features and their words."""
    encoded = [t.encode() if t else b"" for t in texts]
    joined = np.frombuffer(b"".join(e + b"\n" for e in encoded), dtype=np.uint8)
    lengths, starts = segments([len(e) + 1 for e in encoded])
    white = IS_WHITE[joined]
    first = ~white & np.r_[True, white[:-1]]

    # lines; a text's last one ends at the line break put behind it
    ends = np.flatnonzero(joined == 10)
    line_starts = np.r_[0, ends[:-1] + 1]

    def by_line(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, line_starts, dtype=np.int64)

    words = by_line(first)
    symbols, letters = by_line(IS_SYMBOL[joined]), by_line(IS_LETTER[joined])
    characters = by_line(~white & STARTS_CHARACTER[joined])
    owner = np.searchsorted(starts, line_starts, side="right") - 1
    covered = np.concatenate([repeated_words(e.split()) for e in encoded])
    word_line = np.cumsum(joined == 10)[first]
    covered_in_line = np.bincount(word_line[covered], minlength=len(ends))
    again = np.zeros(len(ends), dtype=bool)
    k = 0
    for e in encoded:
        seen: set[bytes] = set()
        for line in e.split(b"\n"):
            if line in seen:
                again[k] = words[k] > 0
            seen.add(line)
            k += 1

    def by_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=values, minlength=len(texts)).astype(np.int64)

    counts = {
        "n_words": by_text(words), "word_chars": by_text(characters), "n_symbols": by_text(symbols),
        "n_dup_lines": by_text(again), "n_repeat_words": by_text(covered_in_line),
    }
    full = words > 0
    last = np.zeros(len(ends), dtype=np.int64)  # the last character before the white space that ends a line
    solid = np.flatnonzero(~white)
    if len(solid):
        last = joined[solid[np.maximum(np.searchsorted(solid, ends) - 1, 0)]]
    n = np.maximum(words, 1)
    features = np.stack(
        [
            np.ones(len(ends)),
            np.minimum(symbols / n, 1.0),
            by_line(IS_UPPER[joined]) / np.maximum(letters, 1),
            np.minimum(by_line(IS_SHOUT[joined]) / n, 1.0),
            by_line(IS_DIGIT[joined]) / np.maximum(characters, 1),
            again,
            covered_in_line / n,
            words < 4,
            np.isin(last, list(b".?!:;")),
        ],
        axis=1,
    ).astype(np.float64)
    return counts, np.bincount(owner[full], minlength=len(texts)), features[full], words[full]


def ladder(n_lines: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Walks all sequences at once: for each position the sequences that reach it and the
    places of their lines. The longest come first, so that the others drop off the end."""
    order = np.argsort(-n_lines, kind="stable")
    sizes = n_lines[order]
    begins = (np.cumsum(n_lines) - n_lines)[order]
    active = len(order)
    for t in range(int(sizes[0]) if len(sizes) else 0):
        active = int(np.searchsorted(-sizes[:active], -t, side="left"))
        yield order[:active], begins[:active] + t


def viterbi(field: Field, n_lines: np.ndarray, features: np.ndarray) -> np.ndarray:
    """The best labels; of equally good ones those with content."""
    emit = features @ field.emit
    best = np.zeros((len(n_lines), 2))
    came = np.zeros((len(features), 2), dtype=np.int8)
    labels = np.zeros(len(features), dtype=np.int8)
    walk = list(ladder(n_lines))
    for t, (who, at) in enumerate(walk):
        if t == 0:
            best[who] = field.start + emit[at]
            continue
        through = best[who][:, :, None] + field.step[None]
        came[at] = through.argmax(axis=1)
        best[who] = through.max(axis=1) + emit[at]
    now = best.argmax(axis=1).astype(np.int8)
    for t in range(len(walk) - 1, -1, -1):
        who, at = walk[t]
        labels[at] = now[who]
        now[who] = came[at, now[who]]
    return labels


def fit(n_lines: np.ndarray, features: np.ndarray, bad: np.ndarray, steps: int = 150) -> Field:
    """Trains the field by gradient ascent on the likelihood of weak line labels.

    Lines of good documents are content. In a bad document those lines are boilerplate
    that go beyond nearly all lines of good documents in some feature, or all its lines
    if none does.
    """
    owner = np.repeat(np.arange(len(n_lines)), n_lines)
    good_lines = ~bad[owner]
    if not good_lines.any() or good_lines.all():
        return default_field()
    beyond = np.quantile(features[good_lines], 0.999, axis=0)
    odd = (features[:, 1:7] > np.maximum(beyond[1:7], 0.05)).any(axis=1) & ~good_lines
    none_odd = np.bincount(owner, weights=odd, minlength=len(n_lines)) == 0
    labels = (odd | (~good_lines & none_odd[owner])).astype(np.int64)
    one = np.eye(2)[labels]
    walk = list(ladder(n_lines))
    m = len(features)
    seen_emit = features.T @ one
    first = (np.cumsum(n_lines) - n_lines)[n_lines > 0]
    seen_start = one[first].sum(axis=0)
    seen_step = np.zeros((2, 2))
    follows = np.flatnonzero(owner[1:] == owner[:-1])
    np.add.at(seen_step, (labels[follows], labels[follows + 1]), 1)

    theta = np.zeros(2 + 4 + features.shape[1] * 2)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)

    def parts(x: np.ndarray) -> Field:
        return Field(x[:2], x[2:6].reshape(2, 2), x[6:].reshape(-1, 2))

    for step in range(1, steps + 1):
        f = parts(theta)
        emit = features @ f.emit
        alpha, beta = np.zeros((m, 2)), np.zeros((m, 2))
        before = np.zeros((len(n_lines), 2))
        for t, (who, at) in enumerate(walk):
            if t == 0:
                a = f.start + emit[at]
            else:
                through = before[who][:, :, None] + f.step[None]
                a = np.logaddexp(through[:, 0], through[:, 1]) + emit[at]
            alpha[at] = before[who] = a
        total = np.logaddexp(before[:, 0], before[:, 1])
        pair = np.zeros((2, 2))
        after = np.zeros((len(n_lines), 2))
        for t in range(len(walk) - 1, -1, -1):
            who, at = walk[t]
            beta[at] = after[who]
            if t:
                ahead = beta[at] + emit[at]
                through = f.step[None] + ahead[:, None, :]
                p = alpha[at - 1][:, :, None] + through - total[who][:, None, None]
                pair += np.exp(p).sum(axis=0)
                after[who] = np.logaddexp(through[:, :, 0], through[:, :, 1])
        marginal = np.exp(alpha + beta - total[owner][:, None])
        gradient = np.r_[
            seen_start - marginal[first].sum(axis=0),
            (seen_step - pair).ravel(),
            (seen_emit - features.T @ marginal).ravel(),
        ] / m - 1e-4 * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta + 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return parts(theta)


def train_field(
    documents: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", quality_col="quality",
    n_documents: int = TRAINING_DOCUMENTS,
) -> Field:
    """The field fitted on ``n_documents`` labelled documents (the first by a hash of the id;
    quality 0 is bad; null labels and ids don't count, of contrary ones the lowest does; of
    several rows of one id that with the smallest hash of its text does).

    Only line features of that bounded sample reach the driver: of each document those of at
    most TRAINING_LINES lines, from its first.
    """
    chosen = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(quality_col).cast("int").alias("quality"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(n_documents)
    )
    slim = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"doc_id": pa.int64(), "bad": pa.bool_(), "features": pa.list_(pa.float64())}
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in text_slices(texts):
                _, n_lines, features, _ = describe(texts[lo:hi])
                ends = np.cumsum(n_lines)
                own = [features[e - n : e][:TRAINING_LINES].ravel() for n, e in zip(n_lines, ends)]
                part = batch.slice(lo, hi - lo)
                bad = [q == 0 for q in part.column("quality").to_pylist()]
                yield arrow_batch({"doc_id": part.column("doc_id"), "bad": bad, "features": own}, types)

    rows = (
        slim.join(F.broadcast(chosen), "doc_id")  # at most n_documents rows
        .groupBy("doc_id")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.min("quality").alias("quality"))
        .mapInArrow(run, "doc_id long, bad boolean, features array<double>")
        .collect()
    )
    rows = sorted((r for r in rows if r.features), key=lambda r: (r.doc_id, r.bad, r.features))
    if not rows:
        return default_field()
    features = np.concatenate([r.features for r in rows]).reshape(-1, len(FEATURES))
    n_lines = np.array([len(r.features) // len(FEATURES) for r in rows])
    return fit(n_lines, features, np.array([r.bad for r in rows]))


def label_lines(
    documents: DataFrame, field: Field, *, share: float = CONTENT_SHARE, id_col="doc_id", text_col="text"
) -> DataFrame:
    """One row for each row of ``documents``: word, symbol, line and repetition counts, the
    base rules, and whether enough words stand in lines that the field calls content.

    Null, empty and blank texts have no words and fail the base rules. Repeated rows stay
    repeated, null ids stay null, an empty table gives no rows; other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vars(field))  # a few numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(**shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in text_slices(texts):
                found = judge(texts[lo:hi], own, share)
                yield arrow_batch({"doc_id": batch.column(0).slice(lo, hi - lo)} | found, TYPES)

    slim = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, SCHEMA)


def keep_content(
    documents: DataFrame, field: Field, *, share: float = CONTENT_SHARE, text_col="text"
) -> DataFrame:
    """The rows of ``documents`` that ``label_lines`` keeps, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(vars(field))
    at = documents.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(**shared.value)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for lo, hi in text_slices(texts):
                yield batch.slice(lo, hi - lo).filter(pa.array(judge(texts[lo:hi], own, share)["kept"]))

    return documents.mapInArrow(run, documents.schema)


def judge(texts: list[str | None], field: Field, share: float) -> dict[str, np.ndarray]:
    counts, n_lines, features, words = describe(texts)
    labels = viterbi(field, n_lines, features)
    owner = np.repeat(np.arange(len(texts)), n_lines)
    content = np.bincount(owner, weights=words * (labels == CONTENT), minlength=len(texts))
    n = counts["n_words"]
    failed = (n < 50) | (100 * counts["n_repeat_words"] > 50 * n)
    content_share = content / np.maximum(n, 1)
    return counts | {
        "base_failed": failed, "kept": ~failed & (content_share >= share), "n_lines": n_lines,
        "n_content_lines": np.bincount(owner, weights=labels == CONTENT, minlength=len(texts)).astype(np.int64),
        "content_share": content_share,
    }
