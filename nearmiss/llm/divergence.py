"""Divergence of the sources of each language, by the terms they use.

Counting terms is the large part. A task takes the letters of a batch of texts in one array
of bytes. Terms of up to 8 bytes become one unsigned 64-bit word, those of up to 16 two, in
an order that is the order of their bytes; each kind is radix-sorted together with its
group and document, and equal neighbours are counted as runs. Longer terms are the few of a
third bucket, sorted as bytes. Only runs travel: (language, source, term) with its occurrences
and documents.

The kept terms of a language, a few thousand at a time, then meet the table of its sources: one
row for each language and part of the terms, not one for each term. All arithmetic is in
whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearmiss.llm.common import arrow_batch, cut, text_slices

#: Bytes of letters; A-Z are lower-cased, all other bytes end a term.
LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
#: Masks of the first 0 to 8 bytes of a big-endian word.
_FIRST_BYTES = np.array([(1 << 64) - (1 << 8 * (8 - k)) for k in range(9)], dtype=np.uint64)
#: Bytes of text that are sorted at a time, and rows of a batch that goes back to Spark.
SORTED_BYTES = 16 << 20
BATCH_ROWS = 1 << 16
#: Terms of one packed row, and cells (terms × sources) of one matrix.
PACKED_TERMS = 4096
MATRIX_CELLS = 1 << 20
#: Sources, over all languages, up to which their tables are broadcast (some 10 MB).
BROADCAST_GROUPS = 100_000
#: Groups that a source's terms are ranked in before they are ranked together.
TERM_SALTS = 64
SCALE = 1_000_000_000


def radix_order(words: np.ndarray, order: np.ndarray | None = None) -> np.ndarray:
    """The stable order of unsigned words, by 16-bit digits from the lowest; continues ``order``.
    (numpy's stable sort of 16-bit numbers is a radix sort.) Digits that are all equal cost no pass."""
    order = np.arange(len(words)) if order is None else order
    for shift in range(0, words.dtype.itemsize * 8, 16):
        digit = (words >> words.dtype.type(shift)).astype(np.uint16)
        if len(digit) and (digit != digit[0]).any():
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def packed_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, n_words: int) -> list[np.ndarray]:
    """Byte strings of up to ``8 * n_words`` bytes as big-endian words, zero-filled: in the order of
    their bytes, and different for different strings without zero bytes. ``data`` goes on
    for ``8 * n_words`` bytes behind the last string."""
    # the eight bytes from every place on, as one word
    wide = np.ndarray(len(data) - 7, dtype=">u8", buffer=data, strides=(1,))
    return [
        wide[starts + 8 * w].astype(np.uint64) & _FIRST_BYTES[np.clip(lengths - 8 * w, 0, 8)] for w in range(n_words)
    ]


def unpacked(words: list[np.ndarray]) -> pa.Array:
    """The byte strings of packed words, as text."""
    wide = np.stack(words, axis=1).astype(">u8").view(np.uint8)
    there = wide != 0
    return _strings(there.sum(axis=1), wide[there].tobytes())


def _strings(lengths: np.ndarray, data: bytes) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.string(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def _runs(keys: list[np.ndarray]) -> np.ndarray:
    """Where a new run of equal keys begins."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def count_terms(
    texts: list[bytes | None], groups: np.ndarray
) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """Groups, terms, occurrences and documents of some texts, each of a numbered group; arrays
    for each kind of term."""
    sizes = np.array([len(x) if x else 0 for x in texts], dtype=np.int64)
    # a zero byte ends each text, so that no term goes over it; 16 more for the packing
    data = np.frombuffer(b"\0".join(x or b"" for x in texts) + bytes(17), dtype=np.uint8)
    inside = LETTER[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.r_[0, edges]
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    data = LOWER[data]
    doc = np.searchsorted(np.cumsum(sizes + 1), starts, side="right")
    group = np.asarray(groups, dtype=np.int64)[doc] if len(doc) else np.zeros(0, dtype=np.int64)
    kind = np.minimum((lengths + 7) // 8, 3)
    for n_words in (1, 2):
        at = np.flatnonzero(kind == n_words)
        if not len(at):
            continue
        words = packed_words(data, starts[at], lengths[at], n_words)
        keys = [*reversed(words), group[at].astype(np.uint32)]
        order = None
        for k in keys:  # the last key counts most; terms come by document, and equal ones stay so
            order = radix_order(k, order)
        keys = [doc[at][order], *(k[order] for k in keys)]
        first = np.flatnonzero(_runs(keys))  # a run: one term of one document
        occurrences = np.diff(np.r_[first, len(order)])
        keys = [k[first] for k in keys[1:]]
        term = np.flatnonzero(_runs(keys))
        sums = np.add.reduceat(occurrences, term)
        documents = np.diff(np.r_[term, len(first)])
        yield keys[-1][term].astype(np.int64), unpacked([k[term] for k in reversed(keys[:-1])]), sums, documents
    # long terms: few, and sorted as bytes
    at = np.flatnonzero(kind == 3)
    raw = data.tobytes() if len(at) else b""
    found = sorted((int(g), raw[s : s + n], int(d)) for g, s, n, d in zip(group[at], starts[at], lengths[at], doc[at]))
    rows: list[list] = []
    for k, (g, term, d) in enumerate(found):
        if not rows or rows[-1][:2] != [g, term]:
            rows.append([g, term, 0, 0])
        rows[-1][2] += 1
        rows[-1][3] += rows[-1][2] == 1 or found[k - 1][2] != d
    if rows:
        g, terms, sums, documents = zip(*rows)
        yield np.array(g), _strings(np.array(list(map(len, terms))), b"".join(terms)), np.array(sums), np.array(documents)


_COUNT_TYPES = {"lang": pa.string(), "source": pa.string(), "term": pa.string(), "n": pa.int64(), "docs": pa.int64()}
_COUNT_SCHEMA = "lang string, source string, term string, n long, docs long"


def term_counts(named: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` of texts (``lang, source, text``), partly summed: a row may
    come once for every SORTED_BYTES of text."""

    def run(batches):
        for batch in batches:
            groups: dict[tuple, int] = {}
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            numbers = np.array([groups.setdefault(g, len(groups)) for g in pairs], dtype=np.int64)
            langs, sources = (pa.array(names, pa.string()) for names in list(zip(*groups)) or ((), ()))
            texts = batch.column(2).cast(pa.binary())
            lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for lo, hi in text_slices([range(n) for n in lengths], SORTED_BYTES):
                part = texts.slice(lo, hi - lo).to_pylist()
                # a text longer than a slice stands alone
                long = lengths[lo] > SORTED_BYTES
                for g, *rest in count_long_text(part[0], numbers[lo]) if long else count_terms(part, numbers[lo:hi]):
                    whole = arrow_batch(dict(zip(_COUNT_TYPES, (langs.take(g), sources.take(g), *rest))), _COUNT_TYPES)
                    for a in range(0, len(g), BATCH_ROWS):
                        yield whole.slice(a, BATCH_ROWS)

    return named.select("lang", "source", "text").mapInArrow(run, _COUNT_SCHEMA)


def count_long_text(text: bytes, group: int, size: int | None = None):
    """``count_terms`` of one text, cut between terms into pieces of about ``size`` bytes."""
    size = size or SORTED_BYTES
    found: dict[bytes, int] = {}
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text):
            ends = np.flatnonzero(~LETTER[np.frombuffer(text, dtype=np.uint8, count=end - at, offset=at)])
            if len(ends):
                end = at + int(ends[-1]) + 1
                break
            end += size  # one term fills the piece
        for _, terms, sums, _ in count_terms([text[at:end]], np.array([group])):
            for term, n in zip(terms.cast(pa.binary()).to_pylist(), sums.tolist()):
                found[term] = found.get(term, 0) + n
        at = end
    terms = _strings(np.fromiter(map(len, found), dtype=np.int64, count=len(found)), b"".join(found))
    yield np.full(len(found), group), terms, np.fromiter(found.values(), dtype=np.int64), np.ones(len(found), dtype=np.int64)


# ---------------------------------------------------------------- divergence


def shares(counts: np.ndarray, total: np.ndarray | int, n_terms: int) -> np.ndarray:
    """``1 + SCALE * (count + 1) // (total + n_terms)``, exact: three steps of a thousandth each,
    so that no product leaves 64 bits while a corpus has fewer than 9e15 terms."""
    out = np.zeros(np.broadcast_shapes(np.shape(counts), np.shape(total)), dtype=np.int64)
    whole = np.asarray(total, dtype=np.int64) + n_terms
    digit, rest = np.divmod(np.asarray(counts, dtype=np.int64) + 1, whole)
    out = out + digit
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``(p - q)^2 // q``, exact in 64 bits as shares are at most SCALE + 1."""
    return (p - q) ** 2 // q


_PACKED_SCHEMA = "lang string, terms array<string>, sizes array<int>, sources array<string>, counts array<long>"
_PACKED_TYPES = {
    "lang": pa.string(), "terms": pa.list_(pa.string()), "sizes": pa.list_(pa.int32()),
    "sources": pa.list_(pa.string()), "counts": pa.list_(pa.int64()),
}
_PART_TYPES = {"lang": pa.string(), "source": pa.string(), "part": pa.string(), "item": pa.string(), "value": pa.int64()}
_PART_SCHEMA = "lang string, source string, part string, item string, value long"


def _pack(batches):
    """Kept terms (``lang, term, found``), by language, as rows of up to PACKED_TERMS terms of one
    language; the terms of a row are in order."""

    def row(lang, terms):
        flat = [x for _, found in terms for x in found]
        values = (
            lang, [t for t, _ in terms], [len(found) for _, found in terms],
            [x["source"] for x in flat], [x["n"] for x in flat],
        )
        return arrow_batch({c: [v] for c, v in zip(_PACKED_TYPES, values)}, _PACKED_TYPES)

    last, terms = None, []
    for batch in batches:
        for lang, term, found in zip(*(c.to_pylist() for c in batch.columns)):
            if terms and (lang != last or len(terms) >= PACKED_TERMS):
                yield row(last, terms)
                terms = []
            last = lang
            terms.append((term, found))
    if terms:
        yield row(last, terms)


def _compare_terms(r: dict, limit: int) -> pa.RecordBatch:
    """The ``limit`` terms of highest value of each source, of one packed row."""
    names, terms = r["names"], r["terms"]
    column, row_of, counts = r["column"], r["row_of"], r["cells"]
    of_lang = np.zeros(len(terms), dtype=np.int64)
    np.add.at(of_lang, row_of, counts)
    p = shares(counts, r["totals"][column], r["n_terms"])
    q = shares(of_lang, r["total"], r["n_terms"])[row_of]
    more = np.flatnonzero(p > q)
    value = excess(p[more], q[more])
    order = np.lexsort((row_of[more], -value, column[more]))  # terms of a row are in order
    mine = column[more][order]
    first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]][: len(mine)])
    within = np.arange(len(mine)) - np.repeat(first, np.diff(np.r_[first, len(mine)]))
    top = order[within < limit]
    sources, items = [names[k] for k in column[more][top]], [terms[k] for k in row_of[more][top]]
    return _parts(r["lang"], sources, "term", items, value[top].tolist())


def _compare_pairs(r: dict) -> Iterator[pa.RecordBatch]:
    """Each pair of sources summed over the terms of one packed row, the absent ones included.

    Works on tiles of MATRIX_CELLS cells: some terms by all sources, and some sources by all."""
    names, terms, totals = r["names"], r["terms"], r["totals"]
    step = max(1, MATRIX_CELLS // len(names))
    for lo in range(0, len(names), step):
        sums = np.zeros((min(step, len(names) - lo), len(names)), dtype=np.int64)
        for a in range(0, len(terms), step):
            here = (a <= r["row_of"]) & (r["row_of"] < a + step)
            counts = np.zeros((min(step, len(terms) - a), len(names)), dtype=np.int64)
            counts[r["row_of"][here] - a, r["column"][here]] = r["cells"][here]
            p = shares(counts, totals, r["n_terms"])
            for g in range(len(sums)):
                sums[g] += excess(p[:, lo + g, None], p).sum(axis=0)
        for g, row in enumerate(sums.tolist()):
            others = [k for k in range(len(names)) if k != lo + g]
            yield _parts(
                r["lang"], [names[lo + g]] * len(others), "pair", [names[k] for k in others], [row[k] for k in others]
            )


def _parts(lang: str, sources: list[str], part: str, items: list[str], values: list[int]) -> pa.RecordBatch:
    n = len(sources)
    return arrow_batch(dict(zip(_PART_TYPES, ([lang] * n, sources, [part] * n, items, values))), _PART_TYPES)


def _compare(limit: int):
    """Packed terms beside their language's sources → parts of both kinds."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):  # one packed row at a time
                r = batch.slice(k, 1).to_pylist()[0]
                r["names"] = [s["source"] for s in r["groups"]]
                r["totals"] = np.array([s["total"] for s in r["groups"]], dtype=np.int64)
                place = {s: k for k, s in enumerate(r["names"])}
                r["column"] = np.array([place[s] for s in r["sources"]], dtype=np.int64)
                r["row_of"] = np.repeat(np.arange(len(r["terms"])), r["sizes"])
                r["cells"] = np.array(r["counts"], dtype=np.int64)
                yield _compare_terms(r, limit)
                yield from _compare_pairs(r)

    return run


def source_divergence(
    documents: DataFrame, *, least_docs=3, top=200, lang_col="lang", source_col="source", text_col="text"
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source of a language differs from each
    other one (part ``pair``), and the ``top`` terms it has more of than its language (``term``).

    A language keeps the terms that ``least_docs`` of its rows or more hold. A group's share of a
    kept term is ``1 + 10^9 * (n + 1) // (N + V)``, and a value is ``(p - q)^2 // q``, summed over all
    kept terms for a pair. Ranks go from 1 by value, highest first, then by item. Null
    language, source and text are empty. Groups without a kept term count, those of a
    language without any have pairs of value 0, and a language of one source has no pair. Repeated
    rows are documents of their own. Other columns are not read.

    A language's table of sources is joined to its terms, broadcast only if all tables together have
    at most BROADCAST_GROUPS sources. Pairs of S sources cost S^2 a kept term, in tiles.
    """
    named = documents.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))),
        F.col(text_col).cast("string").alias("text"),
    )
    # one exchange by (lang, term) serves both sums
    summed = (
        term_counts(named).repartition("lang", "term")
        .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    kept = (
        summed.groupBy("lang", "term")
        .agg(F.collect_list(F.struct("source", "n")).alias("found"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= least_docs)
        .select("lang", "term", "found")
        .sortWithinPartitions("lang", "term")
    )
    packed = cut(kept.mapInArrow(_pack, _PACKED_SCHEMA))
    cells = packed.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    found = cells.select("lang", F.col("x.sources").alias("source"), F.col("x.counts").alias("total"))
    there = named.select("lang", "source").distinct().withColumn("total", F.lit(0).cast("long"))
    totals = there.union(found).groupBy("lang", "source").agg(F.sum("total").alias("total"))
    sizes = packed.groupBy("lang").agg(F.sum(F.size("terms")).alias("n_terms"))
    tables = totals.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("source", "total"))).alias("groups"), F.sum("total").alias("total")
    )
    tables = cut(tables.join(sizes, "lang", "left").fillna(0, ["n_terms"]))
    n_groups = tables.agg(F.sum(F.size("groups"))).first()[0] or 0
    beside = packed.join(F.broadcast(tables) if n_groups <= BROADCAST_GROUPS else tables, "lang")
    parts = cut(beside.mapInArrow(_compare(top), _PART_SCHEMA))

    source = F.col("a.source").alias("source")
    zeros = tables.select("lang", "groups", F.explode("groups").alias("a")).select("lang", source, F.explode("groups").alias("b"))
    zeros = zeros.filter(F.col("source") != F.col("b.source")).select(
        "lang", "source", F.lit("pair").alias("part"), F.col("b.source").alias("item"), F.lit(0).cast("long").alias("value")
    )
    pairs = parts.filter("part = 'pair'").union(zeros)
    pairs = pairs.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    # every packed row hands on its top terms: a salt keeps one source's from meeting in one task
    salt = F.pmod(F.xxhash64("item"), F.lit(TERM_SALTS)).alias("salt")
    within = Window.partitionBy("lang", "source", "part", "salt").orderBy(F.desc("value"), "item")
    terms = parts.filter("part = 'term'").select("*", salt).withColumn("rank", F.row_number().over(within))
    terms = terms.filter(F.col("rank") <= top).drop("salt", "rank")
    terms = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms)
