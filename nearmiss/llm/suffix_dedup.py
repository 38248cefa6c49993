"""Removal of byte strings that occur more than once in a corpus.

Every window of WINDOW bytes holds an anchor: the place of its least GRAM-byte hash,
which only depends on the window's bytes, so that equal windows have equal anchors.
Anchors whose hash occurs once are done. The others are sent, with the bytes around
them, to where their hash is dealt, and sorted there as suffixes (``suffix_sort``), the
bytes before the anchor backwards in a second sort. The common prefixes of both sides
give the longest repeated string around each anchor; every repeated window lies in such
a string of WINDOW bytes or more.

Anchors of a hash that very many have aren't sorted: the windows around them are told
apart by their hashes, one row for each different window of a few dozen texts, so that
no task gets all occurrences of a passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearmiss.llm.common import arrow_batch, cut, dealt, mix64, text_slices
from nearmiss.llm.suffix_sort import common_length, sort_with_prefixes

WINDOW, GRAM = 200, 64
#: Grams of a window, and how many bytes of it can stand before its anchor.
GRAMS = WINDOW - GRAM + 1
BEFORE = WINDOW - GRAM
#: An anchor hash with more occurrences is frequent, and so is one with more than SURE among the
#: anchors that a task gathers: the task then sends one of them to be counted.
FREQUENT, SURE = 2000, 64
#: A text is cut at this length for the search of anchors (with overlap), as places are
#: kept in the low bits of the hashes.
PLACE_BITS = 26
PIECE = 1 << 24
SLICE = 2 << 20
#: Fills the place of bytes beyond a text; no UTF-8 text has it.
NO_BYTE = b"\xff"
#: Anchors that a task gathers before it deals them out.
GATHERED = 1 << 20

#: ``sure`` is 1 for the one anchor that stands for a frequent hash of its task, 2 for the others.
ANCHOR = np.dtype([("key", "<u8"), ("text", "<i8"), ("at", "<u4"), ("sure", "u1")])
FOUND = np.dtype([("text", "<i8"), ("key", "<u8"), ("at", "<u4"), ("frequent", "u1")])
CONTEXT = np.dtype(
    [("key", "<u8"), ("text", "<i8"), ("at", "<u4"), ("before", "<u2"), ("after", "<u2"), ("bytes", "u1", BEFORE + WINDOW)]
)
WINDOWED = np.dtype([("hash", "<u8"), ("text", "<i8"), ("at", "<u4")])
RANGE = np.dtype([("text", "<i8"), ("start", "<u4"), ("end", "<u4")])

PACKED = "bucket int, packed binary"
PACKED_TYPES = {"bucket": pa.int32(), "packed": pa.binary()}


def text_id(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def bucket_of(numbers: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(numbers.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)])
    return starts, np.diff(np.r_[starts, len(ordered)])


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, hash) of the anchors of all windows of the texts."""
    numbers, shifts, pieces = [], [], []
    for i, t in enumerate(texts):
        for at in range(0, max(len(t) - WINDOW + 1, 0), PIECE):
            numbers.append(i)
            shifts.append(at)
            pieces.append(t[at : at + PIECE + WINDOW - 1])
    out = []
    lo = 0
    while lo < len(pieces):
        hi, held = lo, 0
        while hi < len(pieces) and (hi == lo or held + len(pieces[hi]) <= SLICE):
            held += len(pieces[hi])
            hi += 1
        out.append(anchors_of(pieces[lo:hi], np.array(numbers[lo:hi]), np.array(shifts[lo:hi])))
        lo = hi
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    number, place, key = (np.concatenate(x) for x in zip(*out))
    return number, place, key


def anchors_of(pieces: list[bytes], numbers: np.ndarray, shifts: np.ndarray):
    lengths = np.array([len(p) for p in pieces])
    ends = np.cumsum(lengths)
    flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    grams = mix64(np.arange(1, 257, dtype=np.uint64))[flat]
    width = 1
    while width < GRAM:  # the hash of a gram from those of its halves
        grams = grams[:-width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + grams[width:]
        grams ^= grams >> np.uint64(29)
        width *= 2
    grams = mix64(grams)
    # the least hash of each window, the first of equals: places fill the low bits
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= GRAMS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < GRAMS:
        least = np.minimum(least[: -(GRAMS - width)], least[GRAMS - width :])
    inside = np.ones(len(least), dtype=bool)  # windows that lie in one piece
    for e in ends[:-1].tolist():
        inside[max(e - WINDOW + 1, 0) : e] = False
    at = (least[inside] & low).astype(np.int64)
    at = at[np.r_[True, at[1:] != at[:-1]][: len(at)]]
    owner = np.searchsorted(ends, at, side="right")
    return numbers[owner], at - (ends - lengths)[owner] + shifts[owner], grams[at]


def distinct_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """The texts of a task's column ``text`` by the slice, each text once."""
    seen: set[int] = set()
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for lo, hi in text_slices(texts, SLICE):
            out = []
            for t in texts[lo:hi]:
                e = (t or "").encode()
                if (own := text_id(e)) not in seen:
                    seen.add(own)
                    out.append(e)
            if out:
                yield out


def anchor_rows(documents: DataFrame, buckets: int) -> DataFrame:
    """Anchors of all distinct texts, dealt by hash; those known to be frequent by text, but for one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def deal() -> pa.RecordBatch:
            rows = np.concatenate(held)
            held.clear()
            rows = rows[np.argsort(rows["key"], kind="stable")]
            starts, counts = runs(rows["key"])
            rows["sure"] = np.repeat(np.where(counts > SURE, 2, 0), counts)
            rows["sure"][starts[counts > SURE]] = 1
            by = np.where(rows["sure"] == 2, rows["text"].view(np.uint64), rows["key"])
            return arrow_batch(dealt(rows, bucket_of(by, buckets)), PACKED_TYPES)

        for texts in distinct_texts(batches):
            number, place, key = anchors(texts)
            rows = np.zeros(len(key), dtype=ANCHOR)
            rows["key"], rows["at"] = key, place
            rows["text"] = np.array([text_id(t) for t in texts], dtype=np.int64)[number]
            held.append(rows)
            if sum(map(len, held)) >= GATHERED:
                yield deal()
        if sum(map(len, held)):
            yield deal()

    return documents.select("text").mapInArrow(run, PACKED)


def repeated_anchors(rows: DataFrame, buckets: int) -> DataFrame:
    """Anchors whose hash occurs twice or more, dealt by text."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        rows = np.frombuffer(b"".join(part["packed"]), dtype=ANCHOR)
        known, rows = rows[rows["sure"] == 2], rows[rows["sure"] < 2]
        rows = rows[np.lexsort((rows["at"], rows["text"], rows["key"]))]
        if len(rows):
            starts, counts = runs(rows["key"])
            sure = np.repeat(np.maximum.reduceat(rows["sure"], starts), counts) > 0
            place = rows[["key", "text", "at"]]
            once = np.r_[True, place[1:] != place[:-1]]  # a text can come from several tasks
            rows, sure = rows[once], sure[once]
            counts = runs(rows["key"])[1]
            count = np.repeat(counts, counts)
            keep, frequent = sure | (count > 1), sure | (count > FREQUENT)
            rows, frequent = rows[keep], frequent[keep]
        else:
            frequent = np.zeros(0, dtype=bool)
        out = np.zeros(len(rows) + len(known), dtype=FOUND)
        for name in ("text", "key", "at"):
            out[name] = np.r_[rows[name], known[name]]
        out["frequent"] = np.r_[frequent, np.ones(len(known), dtype=bool)]
        return pd.DataFrame(dealt(out, bucket_of(out["text"].copy(), buckets)))

    return rows.groupBy("bucket").applyInPandas(run, PACKED)


def text_rows(documents: DataFrame, buckets: int) -> DataFrame:
    """``place, text, body``: the distinct texts, compressed, dealt by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"place": pa.int32(), "text": pa.int64(), "body": pa.binary()}
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for texts in distinct_texts(batches):
            ids = np.array([text_id(t) for t in texts], dtype=np.int64)
            yield arrow_batch({"place": bucket_of(ids, buckets), "text": ids, "body": [squeeze(t) for t in texts]}, types)

    return documents.select("text").mapInArrow(run, "place int, text long, body binary")


def bodies(right: pd.DataFrame) -> dict[int, bytes]:
    unsqueeze = zstandard.ZstdDecompressor().decompress
    return {i: unsqueeze(b) for i, b in zip(right["text"].tolist(), right["body"])}


def context_rows(found: DataFrame, texts: DataFrame, buckets: int) -> DataFrame:
    """Repeated anchors with the bytes around them, dealt by hash; for frequent ones the windows
    they are in, one of each hash, dealt to ``buckets`` more, and to as many again the ranges of
    those that are repeated among these texts."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"bucket": [], "packed": []})
        rows = np.frombuffer(b"".join(left["packed"]), dtype=FOUND)
        rows = rows[np.lexsort((rows["at"], rows["text"]))]
        # a text can come from several tasks
        rows = rows[np.r_[True, (rows["text"][1:] != rows["text"][:-1]) | (rows["at"][1:] != rows["at"][:-1])]]
        known = bodies(right)
        frequent = rows["frequent"] > 0
        windows, repeated = frequent_windows(rows[frequent], known)
        rows = rows[~frequent]
        out = np.zeros(len(rows), dtype=CONTEXT)
        for name in ("key", "text", "at"):
            out[name] = rows[name]
        starts, counts = runs(rows["text"])
        for a, b in zip(starts.tolist(), (starts + counts).tolist()):
            body = known[int(rows["text"][a])]
            padded = np.frombuffer(NO_BYTE * BEFORE + body + NO_BYTE * WINDOW, dtype=np.uint8)
            at = rows["at"][a:b].astype(np.int64)
            out["bytes"][a:b] = padded[at[:, None] + np.arange(BEFORE + WINDOW)]
            out["before"][a:b] = np.minimum(at, BEFORE)
            out["after"][a:b] = np.minimum(len(body) - at, WINDOW)
        parts = (
            dealt(out, bucket_of(out["key"].copy(), buckets)),
            dealt(windows, bucket_of(windows["hash"].copy(), buckets) + buckets),
            dealt(repeated, bucket_of(repeated["text"].copy(), buckets) + 2 * buckets),
        )
        return pd.DataFrame({name: [x for part in parts for x in part[name]] for name in ("bucket", "packed")})

    return found.groupBy("bucket").cogroup(texts.groupBy("place")).applyInPandas(run, PACKED)


def frequent_windows(rows: np.ndarray, known: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The windows that hold one of these anchors (sorted by text and place): one for each hash
    (WINDOWED), and the ranges of all that several have."""
    pieces, texts, shifts = [], [], []
    starts, counts = runs(rows["text"])
    for a, b in zip(starts.tolist(), (starts + counts).tolist()):
        own = int(rows["text"][a])
        body = known[own]
        at = rows["at"][a:b].astype(np.int64)
        first, last = np.maximum(at - BEFORE, 0), np.minimum(at, len(body) - WINDOW)
        new = np.r_[True, first[1:] > last[:-1] + 1]
        for lo, hi in zip(first[new].tolist(), last[np.r_[new[1:], True]].tolist()):
            for x in range(lo, hi + 1, SLICE):
                pieces.append(body[x : min(x + SLICE, hi + 1) + WINDOW - 1])
                texts.append(own)
                shifts.append(x)
    found = [np.zeros(0, dtype=WINDOWED)]
    lo = 0
    while lo < len(pieces):
        hi, held = lo, 0
        while hi < len(pieces) and (hi == lo or held + len(pieces[hi]) <= SLICE):
            held += len(pieces[hi])
            hi += 1
        lengths = np.array([len(p) for p in pieces[lo:hi]])
        n = lengths - WINDOW + 1
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        part = np.zeros(len(within), dtype=WINDOWED)
        part["hash"] = window_hashes(b"".join(pieces[lo:hi]))[within + np.repeat(np.cumsum(lengths) - lengths, n)]
        part["text"] = np.repeat(np.array(texts[lo:hi], dtype=np.int64), n)
        part["at"] = within + np.repeat(np.array(shifts[lo:hi]), n)
        found.append(part)
        lo = hi
    windows = np.concatenate(found)
    windows = windows[np.argsort(windows["hash"], kind="stable")]
    starts, counts = runs(windows["hash"])
    several = windows[np.repeat(counts > 1, counts)]
    several = several[np.lexsort((several["at"], several["text"]))]
    new = np.r_[True, (several["text"][1:] != several["text"][:-1]) | (several["at"][1:] > several["at"][:-1] + 1)][: len(several)]
    ranges = np.zeros(int(new.sum()), dtype=RANGE)
    ranges["text"], ranges["start"] = several["text"][new], several["at"][new]
    ranges["end"] = several["at"][np.r_[new[1:], True][: len(several)]] + WINDOW
    return windows[starts], ranges


def window_hashes(body: bytes) -> np.ndarray:
    """A hash of every WINDOW bytes."""
    n = len(body) - WINDOW + 1
    grams = mix64(np.arange(1, 257, dtype=np.uint64))[np.frombuffer(body, dtype=np.uint8)]
    out, at, width = np.zeros(n, dtype=np.uint64), 0, 1
    while True:  # a window is made of grams of the lengths that its own length is a sum of
        if WINDOW & width:
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + grams[at : at + n])
            at += width
        if at == WINDOW:
            return out
        grams = grams[:-width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + grams[width:]
        grams ^= grams >> np.uint64(29)
        width *= 2


def repeated_ranges(contexts: DataFrame, buckets: int) -> DataFrame:
    """Ranges of bytes that repeated windows cover, dealt by text."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        kind = int(part["bucket"].iloc[0]) // buckets
        if kind == 2:  # ranges already
            return pd.DataFrame({"bucket": part["bucket"] - 2 * buckets, "packed": part["packed"]})
        if kind == 1:
            windows = np.frombuffer(b"".join(part["packed"]), dtype=WINDOWED)
            windows = windows[np.argsort(windows["hash"], kind="stable")]
            counts = runs(windows["hash"])[1]
            windows = windows[np.repeat(counts > 1, counts)]
            out = np.zeros(len(windows), dtype=RANGE)
            out["text"], out["start"], out["end"] = windows["text"], windows["at"], windows["at"] + WINDOW
            return pd.DataFrame(dealt(out, bucket_of(out["text"].copy(), buckets)))
        rows = np.frombuffer(b"".join(part["packed"]), dtype=CONTEXT)
        back, ahead = longest_repeats(rows)
        covered = back >= 0
        rows, back, ahead = rows[covered], back[covered], ahead[covered]
        out = np.zeros(len(rows), dtype=RANGE)
        out["text"], out["start"], out["end"] = rows["text"], rows["at"] - back, rows["at"] + ahead
        return pd.DataFrame(dealt(out, bucket_of(out["text"].copy(), buckets)))

    return contexts.groupBy("bucket").applyInPandas(run, PACKED)


def longest_repeats(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor, how far back and ahead of it strings of WINDOW bytes or more go that
    another anchor of its hash shares; -1 where there is none."""
    back, ahead = np.full(len(rows), -1, dtype=np.int64), np.full(len(rows), -1, dtype=np.int64)
    whole = rows["bytes"]
    looks = np.array(
        [xxhash.xxh3_64_intdigest(x.tobytes(), seed=int(b) << 16 | int(a)) for x, b, a in zip(whole, rows["before"], rows["after"])],
        dtype=np.uint64,
    )
    order = np.lexsort((looks, rows["key"]))
    key, look = rows["key"][order], looks[order]
    new_key = np.r_[True, key[1:] != key[:-1]]
    new_look = new_key | np.r_[True, look[1:] != look[:-1]]
    firsts = np.flatnonzero(new_look)
    copies = np.diff(np.r_[firsts, len(rows)])
    # equal surroundings: all of them is repeated
    same = np.repeat(copies > 1, copies)
    back[order[same]] = rows["before"][order[same]]
    ahead[order[same]] = rows["after"][order[same]]
    # the others meet all different surroundings of their hash
    groups = np.flatnonzero(new_key[firsts])
    sizes = np.diff(np.r_[groups, len(firsts)])
    pairs = groups[sizes == 2]
    if len(pairs):  # two members need one comparison
        one, two = order[firsts[pairs]], order[firsts[pairs + 1]]
        x, y = shared_around(rows[one], rows[two])
        found = x + y >= WINDOW
        for i in (one[found], two[found]):
            back[i], ahead[i] = np.maximum(back[i], x[found]), np.maximum(ahead[i], y[found])
    for a, b in zip(groups[sizes > 2].tolist(), (groups + sizes)[sizes > 2].tolist()):
        if (copies[a:b] == 1).any():
            members = order[firsts[a:b]]
            x, y = group_repeats(rows[members])
            better = (x >= 0) & (copies[a:b] == 1)
            back[members[better]], ahead[members[better]] = x[better], y[better]
    return back, ahead


def sides(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes before the anchors, backwards, and those from them on. What lies beyond a
    text is filled with a byte that UTF-8 never has, so it only equals the like."""
    return np.ascontiguousarray(rows["bytes"][:, :BEFORE][:, ::-1]), np.ascontiguousarray(rows["bytes"][:, BEFORE:])


def shared_around(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes before and from the anchor on that the members of pairs share."""
    (left, right), (other_left, other_right) = sides(one), sides(two)
    back = np.minimum(common_length(left, other_left), np.minimum(one["before"], two["before"]))
    ahead = np.minimum(common_length(right, other_right), np.minimum(one["after"], two["after"]))
    return back.astype(np.int64), ahead.astype(np.int64)


def group_repeats(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``longest_repeats`` for members of one hash with different surroundings.

    The sorted order of the bytes ahead is a tree: each run of members that share so many
    bytes, the longest such runs first. Within a run, the member that shares most bytes
    before the anchor stands next in the sorted order of the bytes before.
    """
    left, right = sides(rows)
    before, after = rows["before"].astype(np.int64), rows["after"].astype(np.int64)
    rank = np.empty(len(rows), dtype=np.int64)
    rank[sort_with_prefixes(left)[0]] = np.arange(len(rows))
    order, prefix = sort_with_prefixes(right)
    back, ahead = np.full(len(rows), -1, dtype=np.int64), np.full(len(rows), -1, dtype=np.int64)
    for a, b, shared in runs_of(prefix):
        if shared < WINDOW - BEFORE:
            continue
        members = order[a:b]
        members = members[np.argsort(rank[members])]
        near = common_length(left[members[1:]], left[members[:-1]])
        x = np.minimum(np.maximum(np.r_[near, 0], np.r_[0, near]), before[members])
        y = np.minimum(shared, after[members])
        found = x + y >= WINDOW
        members, x, y = members[found], x[found], y[found]
        back[members], ahead[members] = np.maximum(back[members], x), np.maximum(ahead[members], y)
    return back, ahead


def runs_of(prefix: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(from, to, bytes) of every longest run in a sorted order whose members share so many
    leading bytes, with two members or more; ``prefix`` as ``sort_with_prefixes`` gives it."""
    open_runs: list[tuple[int, int]] = []  # (bytes, from)
    for i, shared in enumerate([*prefix.tolist()[1:], -1], start=1):
        start = i - 1
        while open_runs and open_runs[-1][0] > shared:
            n, start = open_runs.pop()
            yield start, i, n
        if shared >= 0 and (not open_runs or open_runs[-1][0] < shared):
            open_runs.append((shared, start))


def whole_ranges(rows: DataFrame, buckets: int) -> DataFrame:
    """The whole of every text that several rows have, as a range dealt by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, dtype=RANGE)
            out["text"], out["end"] = batch.column("text").to_numpy(), batch.column("n_bytes").to_numpy()
            yield arrow_batch(dealt(out, bucket_of(out["text"].copy(), buckets)), PACKED_TYPES)

    repeated = rows.filter(F.col("n_bytes") >= WINDOW).groupBy("text").agg(
        F.count("*").alias("copies"), F.max("n_bytes").alias("n_bytes")
    )
    return repeated.filter("copies > 1").select("text", "n_bytes").mapInArrow(run, PACKED)


def cut_texts(ranges: DataFrame, texts: DataFrame, with_text: bool, whole_characters: bool) -> DataFrame:
    """``text, n_removed, n_spans, kept_sha256`` (and ``kept``) of every distinct text."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = np.frombuffer(b"".join(left["packed"]), dtype=RANGE) if len(left) else np.zeros(0, dtype=RANGE)
        rows = rows[np.lexsort((rows["start"], rows["text"]))]
        found = []
        for own, body in bodies(right).items():
            a, b = (int(np.searchsorted(rows["text"], own, side=side)) for side in ("left", "right"))
            spans: list[list[int]] = []
            for start, end in zip(rows["start"][a:b].tolist(), rows["end"][a:b].tolist()):
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([start, end])
            if whole_characters:
                spans = [within_characters(body, *span) for span in spans]
            kept, at = [], 0
            for start, end in spans:
                kept.append(body[at:start])
                at = end
            rest = b"".join(kept) + body[at:]
            row = (own, len(body) - len(rest), len(spans), hashlib.sha256(rest).hexdigest())
            found.append((*row, rest) if with_text else row)
        return pd.DataFrame(found, columns=["text", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text)

    schema = "text long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return ranges.groupBy("bucket").cogroup(texts.groupBy("place")).applyInPandas(run, schema)


def within_characters(body: bytes, start: int, end: int) -> list[int]:
    """A span without the characters that it only has a part of."""
    while start < end and body[start] & 0xC0 == 0x80:
        start += 1
    while end > start and end < len(body) and body[end] & 0xC0 == 0x80:
        end -= 1
    return [start, end]


def remove_repeats(
    documents: DataFrame, *, id_col="doc_id", text_col="text", with_text: bool = False,
    whole_characters: bool = False, carry: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row (with ``with_text`` also
    ``kept``, the bytes that are left, and the columns ``carry`` as ``_carry_<name>``).

    A byte goes if a string of WINDOW bytes covers it that starts elsewhere too, in any row;
    strings are judged on the texts as they come. A text that several rows have is repeated
    as a whole if it is long enough. With ``whole_characters`` a UTF-8 character stays unless
    all its bytes go, so that what is left is text. Null texts are empty; null ids stay null, repeated rows
    stay repeated, an empty table gives no rows; other columns are not read.
    """
    texts = documents.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoded = [t.encode() for t in batch.column("_text").to_pylist()]
            at = batch.schema.get_field_index("_text")
            rest = [c for i, c in enumerate(batch.columns) if i != at]
            names = [x for x in batch.schema.names if x != "_text"]
            new = [pa.array([text_id(e) for e in encoded], pa.int64()), pa.array([len(e) for e in encoded], pa.int64())]
            yield pa.RecordBatch.from_arrays([*rest, *new], names=[*names, "text", "n_bytes"])

    named = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), *(F.col(c).alias(f"_carry_{c}") for c in carry),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
    )
    schema = named.drop("_text").schema.add("text", "long").add("n_bytes", "long")
    rows = cut(named.mapInArrow(identify, schema))
    # buckets follow the data: the anchors, and the texts, of a few dozen documents in each
    buckets = int(min(max(rows.count() // 64, 64), 1 << 20))
    found = repeated_anchors(anchor_rows(texts, buckets), buckets)
    contexts = context_rows(found, text_rows(texts, buckets), buckets)
    ranges = repeated_ranges(contexts, buckets)
    ranges = ranges.unionAll(whole_ranges(rows, buckets))
    done = cut_texts(ranges, text_rows(texts, buckets), with_text, whole_characters)
    out = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text]
    return rows.join(done, "text").select(*out, *(f"_carry_{c}" for c in carry))

