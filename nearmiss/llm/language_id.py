"""Language identification with averaged hashed subword embeddings.

A text is the average of the embeddings of its hashed byte n-grams; a linear softmax
layer on top gives the language. Embeddings and layer are trained together by
stochastic gradient descent in numpy. Softmax scores are calibrated with a temperature,
and a score threshold for rejection is set, both on documents kept out of the training.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearmiss.llm.common import arrow_batch, mix64, segments, text_slices

#: Labelled documents the model is fitted on: of each language at most so many, the first by a
#: hash of the id, and fewer where all languages together would have more than the second number
#: (one at least; a language is never left out).
TRAINING_DOCUMENTS, TRAINING_TOTAL = 1000, 8000
#: Parts of a language that its first rows are sought in.
SALTS = 64
#: Bytes of a text whose n-grams are hashed at a time.
PIECE_BYTES = 1 << 20
BUCKETS, WIDTH = 1 << 15, 16
GRAMS = (2, 3, 4)
UNKNOWN = "und"

TYPES = {
    "doc_id": pa.int64(), "held_out": pa.bool_(), "lang_pred": pa.string(), "score": pa.float64(), "rejected": pa.bool_(),
}
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"

LETTER = re.compile(r"[^\W\d_]")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER[[9, 10, 11, 12, 13]] = 32


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # bucket -> embedding, or, for few languages, embedding times layer
    layer: np.ndarray | None  # embedding -> languages, None where the table holds the product
    bias: np.ndarray
    temperature: float
    threshold: float


def _hashed(joined: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Buckets of the n-grams that begin at each byte; 0 where ``room`` bytes are too few."""
    out = np.zeros((len(joined), len(GRAMS)), dtype=np.int32)
    code = joined.astype(np.uint64)
    for k, gram in enumerate(range(1, max(GRAMS) + 1)):
        if gram > 1:
            shifted = np.zeros_like(code)
            shifted[: -(gram - 1)] = joined[gram - 1 :]
            code = (code << np.uint64(8)) | shifted
        if gram in GRAMS:
            own = (mix64(code + np.uint64(gram << 40)) % np.uint64(BUCKETS - 1)).astype(np.int32) + 1
            out[:, GRAMS.index(gram)] = np.where(room >= gram, own, 0)  # bucket 0 is none
    return out


def buckets(encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, text by text, and how many each text has. A space
    is put before and behind each text; an n-gram never spans two."""
    lengths, starts = segments([len(e) + 2 for e in encoded])
    joined = LOWER[np.frombuffer(b"".join(b" " + e + b" " for e in encoded), dtype=np.uint8)]
    room = np.repeat(starts + lengths, lengths) - np.arange(len(joined))  # bytes left in the text
    return _hashed(joined, room), lengths


def bucket_pieces(encoded: bytes) -> Iterator[np.ndarray]:
    """``buckets`` of one text, PIECE_BYTES of it at a time."""
    joined = np.frombuffer(b" " + encoded + b" ", dtype=np.uint8)
    for at in range(0, len(joined), PIECE_BYTES):
        part = LOWER[joined[at : at + PIECE_BYTES + max(GRAMS) - 1]]
        room = len(joined) - at - np.arange(len(part))
        yield _hashed(part, room)[:PIECE_BYTES]


def train(bags: list[tuple], languages: list[str], *, epochs: int = 5, rate: float = 1.0, seed: int = 7) -> LanguageModel:
    """Trains on the bags of texts of known language; every fifth is kept out for the calibration."""
    names = sorted(set(languages))
    y = np.array([names.index(x) for x in languages])
    rng = np.random.default_rng(seed)
    grams, shares = zip(*bags)
    out = np.arange(len(bags)) % 5 == 4
    if len(bags) < 20:
        out[:] = False
    embed = rng.uniform(-1, 1, (BUCKETS, WIDTH)) / WIDTH
    layer, bias = np.zeros((WIDTH, len(names))), np.zeros(len(names))
    learn = np.flatnonzero(~out)
    steps, step = epochs * len(learn), 0
    for _ in range(epochs):
        for i in rng.permutation(learn):
            g, share = grams[i], shares[i]
            hidden = share @ embed[g]
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            now = rate * (1 - step / steps)
            back = layer @ p
            layer -= now * np.outer(hidden, p)
            bias -= now * p
            embed[g] -= now * 20 * share[:, None] * back
            step += 1
    embed[0] = 0
    kept_out = np.flatnonzero(out) if out.any() else learn
    z = np.stack([shares[i] @ embed[grams[i]] for i in kept_out]) @ layer + bias
    best, temperature = np.inf, 1.0
    for t in np.exp(np.linspace(-3, 3, 61)):
        s = z / t
        loss = (np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(s)), y[kept_out]]).mean()
        if loss < best - 1e-12:
            best, temperature = loss, float(t)
    p = softmax(z / temperature)
    right = p.argmax(1) == y[kept_out]
    # the lowest score at which 99 of 100 accepted texts of the kept-out part are right
    order = np.argsort(-p.max(1), kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= 0.99)
    threshold = float(p.max(1)[order[good[-1]]]) if len(good) else 1.0
    if len(names) <= WIDTH:
        return LanguageModel(names, embed @ layer, None, bias, temperature, threshold)
    return LanguageModel(names, embed, layer, bias, temperature, threshold)


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The different buckets of a text's n-grams, and the share of n-grams in each."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for own in bucket_pieces(text):
        counts += np.bincount(own.ravel(), minlength=BUCKETS)
    counts[0] = 0
    found = np.flatnonzero(counts)
    return found, counts[found] / max(counts.sum(), 1)


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def predict(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, calibrated score and rejection of each text; ``und`` with score 0 for a null
    text, one without a letter, and if no language was learned."""
    able = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if model.languages else []
    names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    rejected = np.ones(len(texts), dtype=bool)
    width = model.table.shape[1] if model.languages else 0
    for lo, hi in text_slices([texts[i] for i in able], PIECE_BYTES):
        encoded = [texts[i].encode() for i in able[lo:hi]]
        sums, grams = np.zeros((len(encoded), width)), np.zeros(len(encoded))
        if len(encoded) == 1:  # as long as it likes
            for own in bucket_pieces(encoded[0]):
                grams += (own > 0).sum()
                for k in range(width):
                    sums[0, k] += model.table[:, k][own].sum()
        else:
            own, n = buckets(encoded)
            starts = np.cumsum(n) - n
            for k in range(width):
                sums[:, k] = np.add.reduceat(model.table[:, k][own].sum(axis=1), starts)
            grams = np.add.reduceat((own > 0).sum(axis=1), starts)
        mean = sums / grams[:, None]
        p = softmax(((mean if model.layer is None else mean @ model.layer) + model.bias) / model.temperature)
        for i, best, s in zip(able[lo:hi], p.argmax(axis=1), p.max(axis=1)):
            names[i], score[i], rejected[i] = model.languages[best], min(float(s), 1.0), s < model.threshold
    return names, score, rejected


def first_rows(df: DataFrame, order: list, n: int, *, salt) -> DataFrame:
    """The first ``n`` rows of each ``lang``. A language is ranked in SALTS parts first, so that no
    task gets more than that many times ``n`` of its rows, however many tasks hand on theirs."""
    part = Window.partitionBy("lang", "_salt").orderBy(*order)
    firsts = df.withColumn("_salt", F.pmod(salt, F.lit(SALTS))).withColumn("_k", F.row_number().over(part))
    firsts = firsts.filter(F.col("_k") <= n).drop("_salt", "_k")
    whole = firsts.withColumn("_k", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return whole.filter(F.col("_k") <= n).drop("_k")


def train_languages(
    documents: DataFrame, *, id_col="doc_id", text_col="text", lang_col="lang",
    n_documents: int = TRAINING_DOCUMENTS, n_total: int = TRAINING_TOTAL,
) -> LanguageModel:
    """The model fitted on labelled documents, whole: of every language at most ``n_documents`` rows,
    the first by a hash of the id, then by a hash of the text, and at most its share of ``n_total``
    (one at least). Rows of one id count one by one. The driver gets the bags of those rows,
    each of at most BUCKETS numbers however long the text is.
    """
    nothing = LanguageModel([], np.zeros((BUCKETS, 0)), None, np.zeros(0), 1.0, 1.0)
    learnable = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).dropna()
    # ids first, so that no text is sorted; ties of the hash go to the smaller id
    ids = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang")).dropna()
    n_languages = ids.select("lang").distinct().count()
    if not n_languages:
        return nothing
    each = min(n_documents, max(1, n_total // n_languages))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = first_rows(ids, order, each, salt=F.xxhash64("doc_id", F.lit(1))).distinct()
    if n_languages <= n_total:
        chosen = F.broadcast(chosen)  # n_total rows at most
    # an id may have many rows: they are limited, too
    found = learnable.join(chosen, ["doc_id", "lang"])
    rows_of = first_rows(found, [*order, F.xxhash64("text")], each, salt=F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"doc_id": pa.int64(), "lang": pa.string(), "found": pa.binary(), "shares": pa.binary()}
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "lang", "text"))
            rows = [(i, lang, *bag(text.encode())) for i, lang, text in zip(*columns) if LETTER.search(text)]
            yield arrow_batch(
                {
                    "doc_id": [r[0] for r in rows], "lang": [r[1] for r in rows],
                    "found": [r[2].astype("<i4").tobytes() for r in rows],
                    "shares": [r[3].astype("<f4").tobytes() for r in rows],
                },
                types,
            )

    rows = (
        rows_of.select("doc_id", "lang", "text")
        .mapInArrow(run, "doc_id long, lang string, found binary, shares binary")
        .collect()
    )
    if not rows:
        return nothing
    rows.sort(key=lambda r: (hash_of(r.doc_id), r.doc_id, r.lang, bytes(r.found), bytes(r.shares)))
    bags = [(np.frombuffer(r.found, "<i4"), np.frombuffer(r.shares, "<f4").astype(np.float64)) for r in rows]
    return train(bags, [r.lang for r in rows])


def hash_of(doc_id: int) -> int:
    return int(mix64(np.array([doc_id & 0xFFFFFFFFFFFFFFFF], dtype=np.uint64))[0])


def identify_languages(
    documents: DataFrame, model: LanguageModel, held_out, *, id_col="doc_id", text_col="text"
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row, from its whole text alone.

    ``held_out`` is a Boolean column expression over ``documents``. Null and letter-free
    texts give ``und``, score 0. Repeated rows stay repeated, null ids stay null, an empty
    table gives no rows; of equally likely languages the first by name wins.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vars(model))  # BUCKETS x languages numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in text_slices(texts):
                names, score, rejected = predict(LanguageModel(**shared.value), texts[lo:hi])
                part = batch.slice(lo, hi - lo)
                yield arrow_batch(
                    {"doc_id": part.column(0), "held_out": part.column(1), "lang_pred": names, "score": score, "rejected": rejected},
                    TYPES,
                )

    slim = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("text")
    )
    return slim.mapInArrow(run, SCHEMA)
