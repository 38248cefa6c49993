"""Near-duplicate groups by a set similarity join with several global token orders.

Two sets as similar as asked share a token among the first few of each, whatever order
all tokens are put in. So candidates must share such a prefix token under every one of
several orders; only pairs that pass all these filters are verified on their full sets.
All orders put rare tokens first, by counts over the whole corpus, and differ in how
they order tokens about as frequent; a set whose prefix is filled with tokens that no
other set has is done without any pair.

Tokens are 64-bit hashes of word shingles; equal sets are one set from the start.
Tokens that many sets share in their prefix don't make pairs of rows: the sets of such
tokens are dealt into blocks, and a task links two blocks, giving back a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearmiss.llm.common import arrow_batch, cut, dealt, mix64, text_slices
from nearmiss.llm.graph import components

#: Similarity asked for, in hundredths.
PERCENT = 90
#: Tokens up to this value (a quarter of all) come first in every order, by their counts.
#: The others follow, uncounted; a set needs them only where the quarter is too few.
COUNTED = np.uint64(1 << 62)
#: Orders that candidates must pass.
ORDERS = 3
#: A prefix token that more sets share is linked by blocks of sets instead of pairs of rows.
PAIRED = 16
#: Sets of a block.
BLOCK = 2048
#: Tokens that a task gathers before it deals them out.
GATHERED = 1 << 20
#: Words that a worker remembers the hash of before it starts anew.
REMEMBERED = 400_000


class Shingler:
    """Distinct word shingles of texts as sorted 64-bit hashes."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        words = [t.encode().lower().split() if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        for w in set().union(*words).difference(self.known):
            self.known[w] = xxhash.xxh3_64_intdigest(w)
        get = self.known.__getitem__
        counts = [len(w) for w in words]
        flat = np.fromiter((get(w) for own in words for w in own), dtype=np.uint64, count=sum(counts))
        joined = mixed(flat, self.width)
        out, at = [], 0
        for n in counts:
            if n >= self.width:
                out.append(np.unique(joined[at : at + n - self.width + 1]))
            elif n:  # too short for a shingle: the whole sequence is one
                out.append(mixed(flat[at : at + n], n) ^ np.uint64(n))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
            at += n
        return out


def mixed(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` neighbours."""
    if len(hashes) < width:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
    for k in range(width):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(out)])
    return out


def prefix_length(n: int, percent: int) -> int:
    """How many tokens of a set of ``n`` come before any set this similar must have met one."""
    return n - -(-percent * n // 100) + 1


def emitted(tokens: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The tokens a prefix can be made of, and how many of them are of the counted quarter."""
    counted = int(np.searchsorted(tokens, COUNTED))
    return tokens[: max(counted, min(prefix_length(len(tokens), percent), len(tokens)))], counted


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def set_id(tokens: np.ndarray) -> int:
    """One number for a set, as a signed 64-bit integer."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def shingle_sets(documents: DataFrame, width: int, id_col: str, text_col: str, with_text: bool = False) -> DataFrame:
    """``doc_id, n, counted, set_id`` of every row (and ``text_hash``); no id for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"doc_id": pa.int64(), "n": pa.int64(), "counted": pa.int64(), "set_id": pa.int64()}
        if with_text:
            types["text_hash"] = pa.int64()
        shingler = Shingler(width)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in text_slices(texts):
                sets = shingler.sets(texts[lo:hi])
                yield arrow_batch(
                    {
                        "doc_id": batch.column(0).slice(lo, hi - lo), "n": [len(s) for s in sets],
                        "counted": [int(np.searchsorted(s, COUNTED)) for s in sets],
                        "set_id": [set_id(s) if len(s) else None for s in sets],
                        "text_hash": batch.column(2).slice(lo, hi - lo) if with_text else None,
                    },
                    types,
                )

    schema = "doc_id long, n long, counted long, set_id long" + ", text_hash long" * with_text
    rows = slim(documents, id_col, text_col)
    return (rows.withColumn("text_hash", F.xxhash64("text")) if with_text else rows).mapInArrow(run, schema)


def slim(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def token_rows(documents: DataFrame, width: int, percent: int, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """``bucket, packed``: (token, set) pairs, many to a row, dealt by token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"bucket": pa.int32(), "packed": pa.binary()}
        shingler, seen = Shingler(width), set()
        tokens: list[np.ndarray] = []
        owners: list[np.ndarray] = []

        def deal() -> pa.RecordBatch:
            t = np.concatenate(tokens)
            rows = np.stack([t, np.concatenate(owners).view(np.uint64)], axis=1)
            tokens.clear()
            owners.clear()
            return arrow_batch(dealt(rows, mix64(t) % np.uint64(buckets)), types)

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in text_slices(texts):
                for s in shingler.sets(texts[lo:hi]):
                    if len(s) and (own := set_id(s)) not in seen:
                        seen.add(own)
                        tokens.append(emitted(s, percent)[0])
                        owners.append(np.full(len(tokens[-1]), own, dtype=np.int64))
                if sum(map(len, tokens)) >= GATHERED:
                    yield deal()
        if tokens:
            yield deal()

    return slim(documents, id_col, text_col).mapInArrow(run, "bucket int, packed binary")


def shared_tokens(rows: DataFrame, buckets: int) -> DataFrame:
    """``bucket, packed``: (set, token, count) of the tokens that two sets or more have, dealt by set."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        pairs = np.frombuffer(b"".join(part["packed"]), dtype=np.uint64).reshape(-1, 2)
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        pairs = pairs[np.r_[True, (pairs[1:] != pairs[:-1]).any(axis=1)]]  # a set can come from several tasks
        starts = np.flatnonzero(np.r_[True, pairs[1:, 0] != pairs[:-1, 0]])
        counts = np.diff(np.r_[starts, len(pairs)])
        count = np.repeat(counts, counts)
        pairs, count = pairs[count > 1], count[count > 1]
        if not len(pairs):
            return pd.DataFrame({"bucket": [], "packed": []})
        found = np.stack([pairs[:, 1], pairs[:, 0], count.astype(np.uint64)], axis=1)
        return pd.DataFrame(dealt(found, mix64(pairs[:, 1]) % np.uint64(buckets)))

    return rows.groupBy("bucket").applyInPandas(run, "bucket int, packed binary")


def prefixes(shared: DataFrame, sets: DataFrame, percent: int, buckets: int) -> DataFrame:
    """``set_id, n, order0, order1, ...``: of every set that has shared tokens in its prefix
    under all orders, those tokens."""
    names = [f"order{k}" for k in range(ORDERS)]

    def one(n: int, counted: int, tokens: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
        early = tokens < COUNTED
        length = prefix_length(n, percent)
        alone = counted - int(early.sum())  # tokens no other set has; they come first
        late = tokens[~early] if length > counted else tokens[:0]
        tokens, count = tokens[early], count[early]
        level = np.frexp(count.astype(np.float64))[1]
        ranked = [np.lexsort((tokens, count))]
        ranked += [np.lexsort((mix64(tokens + np.uint64(k)), level)) for k in range(1, ORDERS)]
        return [signed(np.r_[tokens[r[: max(length - alone, 0)]], late]) for r in ranked]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            pairs = np.frombuffer(b"".join(left["packed"]), dtype=np.uint64).reshape(-1, 3)
            pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
            owners = np.ascontiguousarray(pairs[:, 0]).view(np.int64)
            starts = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
            ends = np.r_[starts[1:], len(pairs)]
            known = dict(zip(right["set_id"].tolist(), zip(right["n"].tolist(), right["counted"].tolist())))
            for a, b in zip(starts.tolist(), ends.tolist()):
                n, counted = known[int(owners[a])]
                orders = one(n, counted, pairs[a:b, 1], pairs[a:b, 2])
                if all(len(o) for o in orders):
                    out.append((int(owners[a]), n, *orders))
        return pd.DataFrame(out, columns=["set_id", "n", *names])

    def bucket_of(column: str):
        """The bucket that ``dealt`` put a set in."""

        @F.pandas_udf("int")
        def of(ids: pd.Series) -> pd.Series:
            return pd.Series((mix64(ids.to_numpy(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int32))

        return of(F.col(column))

    placed = sets.withColumn("place", bucket_of("set_id"))
    return (
        shared.groupBy("bucket").cogroup(placed.groupBy("place"))
        .applyInPandas(run, "set_id long, n long, " + ", ".join(f"{x} array<long>" for x in names))
    )


def full_sets(documents: DataFrame, chosen: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``set_id, tokens`` of the chosen sets, worked out again from one document of each
    (``chosen``: ``doc_id, set_id``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"set_id": pa.int64(), "tokens": pa.list_(pa.int64())}
        shingler = Shingler(width)
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("set_id").to_pylist()
            for lo, hi in text_slices(texts):
                sets = shingler.sets(texts[lo:hi])
                # a row that only shares the id with the document meant has another set
                same = [k for k, s in enumerate(sets) if len(s) and set_id(s) == ids[lo + k]]
                yield arrow_batch({"set_id": [ids[lo + k] for k in same], "tokens": [signed(sets[k]) for k in same]}, types)

    rows = slim(documents, id_col, text_col).join(chosen, "doc_id").select("set_id", "text")
    return rows.mapInArrow(run, "set_id long, tokens array<long>").dropDuplicates(["set_id"])


class Forest:
    """Union-find over places in a block."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = int(self.up[i])
        return i

    def roots(self) -> np.ndarray:
        while (self.up[self.up] != self.up).any():
            self.up = self.up[self.up]
        return self.up

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


def postings(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """An inverted index: start of each token's run, the owners run by run, and each list's tokens
    by number."""
    flat = np.concatenate(lists)
    number = np.unique(flat, return_inverse=True)[1]
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    order = np.argsort(number, kind="stable")
    starts = np.r_[0, np.cumsum(np.bincount(number))]
    return starts, owner[order], np.split(number, np.cumsum([len(x) for x in lists])[:-1])


def owners_of(index, i: int) -> np.ndarray:
    starts, owner, numbers = index
    lo, hi = starts[numbers[i]], starts[numbers[i] + 1]
    size = hi - lo
    if not len(size):
        return owner[:0]
    return owner[np.repeat(lo - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())]


def link_blocks(orders: list[list[np.ndarray]], sets: list[np.ndarray], first: np.ndarray, second: np.ndarray, percent: int):
    """Yields (i, j) of a spanning forest of all links between ``first`` and ``second`` (Boolean
    masks over the members). Each filter is an inverted index of one order's prefixes."""
    n = np.array([len(s) for s in sets])
    indexes = [postings(o) for o in orders]
    full = postings(sets)
    forest = Forest(len(sets))
    for i in np.flatnonzero(first):
        may = second & (forest.roots() != forest.root(int(i)))
        may &= 100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])
        for index in indexes:
            if not may.any():
                break
            shares = np.zeros(len(sets), dtype=bool)
            shares[owners_of(index, i)] = True
            may &= shares
        if not may.any():
            continue
        both = np.bincount(owners_of(full, i), minlength=len(sets))
        for j in np.flatnonzero(may & (100 * both >= percent * (n + n[i] - both))):
            if forest.join(int(i), int(j)):
                yield int(i), int(j)


def paired_links(candidates: DataFrame, prefix: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of sets that share a prefix token of the first order with few others."""
    right = prefix.select(F.col("token"), F.col("set_id").alias("other"), F.col("n").alias("m"))
    pairs = (
        prefix.join(right, "token")
        .filter("set_id < other AND 100 * least(n, m) >= {0} * greatest(n, m)".format(percent))
        .select("set_id", "other")
        .distinct()
    )
    names = [f"order{k}" for k in range(1, ORDERS)]
    theirs = candidates.select(F.col("set_id").alias("other"), *(F.col(x).alias(f"other_{x}") for x in names))
    passed = pairs.join(candidates.select("set_id", *names), "set_id").join(theirs, "other")
    for x in names:
        passed = passed.filter(F.arrays_overlap(x, f"other_{x}"))
    passed = passed.select("set_id", "other")
    verified = passed.join(sets, "set_id").join(
        sets.select(F.col("set_id").alias("other"), F.col("tokens").alias("other_tokens")), "other"
    )
    both = F.size(F.array_intersect("tokens", "other_tokens"))
    either = F.size("tokens") + F.size("other_tokens") - both
    return verified.filter(100 * both >= percent * either).select("set_id", "other")


def token_groups(prefix: DataFrame) -> DataFrame:
    """``set_id, group``: every two sets that share a token have a group in common.

    A token belongs to the least set that has it, so tokens of one passage, which the same sets
    have, belong together; its group has all sets of these tokens. Where half of a group's sets or more
    have another group as their first, as among near copies, the two are one.
    """
    least = cut(prefix.groupBy("token").agg(F.min("set_id").alias("least")))
    star = cut(prefix.join(least, "token").select("set_id", "least").distinct())
    first = cut(star.groupBy("set_id").agg(F.min("least").alias("first")))
    votes = star.join(first, "set_id").groupBy("least", "first").agg(F.count("*").alias("votes"))
    most = votes.groupBy("least").agg(F.sum("votes").alias("sets"), F.max(F.struct("votes", "first")).alias("most"))
    whole = F.when(2 * F.col("most.votes") >= F.col("sets"), F.col("most.first")).otherwise(F.col("least"))
    return cut(star.join(cut(most.select("least", whole.alias("group"))), "least").select("set_id", "group").distinct())


def block_links(candidates: DataFrame, prefix: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links of sets that share a prefix token of the first order with many others.

    Sets are grouped by such tokens (``token_groups``); a large group is cut into blocks, and each
    pair of blocks of a group is one task.
    """
    members = token_groups(prefix)
    sizes = members.groupBy("group").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = cut(
        members.join(sizes, "group").withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks").cast("long")).cast("int"))
    )
    # each set goes to the tiles of its block: (own, k) for k from own on, and (k, own) before
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "group", F.least("block", "other").alias("row"), F.greatest("block", "other").alias("column"), "block", "set_id",
    )
    names = [f"order{k}" for k in range(ORDERS)]
    filled = tiles.join(candidates.select("set_id", *names), "set_id").join(sets, "set_id")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("set_id", kind="stable")
        ids, own = part["set_id"].to_numpy(), part["block"].to_numpy()
        row, column = part["row"].iloc[0], part["column"].iloc[0]
        orders = [part[x].tolist() for x in names]
        links = [(ids[i], ids[j]) for i, j in link_blocks(orders, part["tokens"].tolist(), own == row, own == column, percent)]
        return pd.DataFrame(links, columns=["set_id", "other"])

    return filled.groupBy("group", "row", "column").applyInPandas(run, "set_id long, other long")


def near_duplicates(
    documents: DataFrame, *, width: int = 3, percent: int = PERCENT, id_col="doc_id", text_col="text",
    paired: int = PAIRED, block: int = BLOCK, with_sets: bool = False,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``documents`` (with ``with_sets`` also
    ``text_hash``, ``set_id`` and ``head_set_id``, the smallest set of those the component's
    smallest id has in it).

    A set holds the distinct shingles of ``width`` words of the whole text, A-Z in lower
    case; a shorter text is one shingle. Two rows link if their sets' intersection is at
    least ``percent`` hundredths of the union; ``component_id`` is the smallest id reachable.

    Null, empty and blank texts have no shingles, link with nothing and are their own
    component. Rows without id can't name a component: they link with nothing and theirs is
    null. Repeated rows stay repeated. An empty table gives no rows; other columns are not
    read.
    """
    rows = cut(shingle_sets(documents, width, id_col, text_col, with_sets))
    documents = documents.filter(F.col(id_col).isNotNull())
    able = F.col("set_id").isNotNull() & F.col("doc_id").isNotNull()
    full = rows.filter(able)
    sets = full.groupBy("set_id").agg(F.min("n").alias("n"), F.min("counted").alias("counted"), F.min("doc_id").alias("doc_id"))
    sets = cut(sets)
    # buckets follow the data: a few hundred documents' tokens in each
    buckets = int(min(max(sets.count() // 64, 64), 1 << 20))
    fewer = max(buckets // 16, 16)
    shared = shared_tokens(token_rows(documents, width, percent, id_col, text_col, buckets), fewer)
    candidates = cut(prefixes(shared, sets.select("set_id", "n", "counted"), percent, fewer))
    prefix = candidates.select("set_id", "n", F.explode("order0").alias("token"))
    # tables that are joined back to what they sum up are written down first: then Spark can
    # split the rows of a hot key
    counts = cut(prefix.groupBy("token").agg(F.count("*").alias("sharing")).filter("sharing > 1"))
    prefix = cut(prefix.join(counts, "token"))
    # only sets that share a prefix token with another one are looked at again
    meeting = prefix.select("set_id").distinct().join(sets.select("set_id", "doc_id"), "set_id")
    tokens = cut(full_sets(documents, meeting, width, id_col, text_col))
    few, many = prefix.filter(F.col("sharing") <= paired), prefix.filter(F.col("sharing") > paired)
    links = paired_links(candidates, few, tokens, percent).unionAll(block_links(candidates, many, tokens, percent, block))
    found = components(links, "set_id", "other")
    # the smallest document of every component, and of every set in one
    whole = sets.join(found, sets["set_id"] == found["node"], "left").select(
        "set_id", "doc_id", F.coalesce("component", "set_id").alias("component")
    )
    smallest = [F.min("doc_id").alias("component_id")]
    if with_sets:
        smallest.append(F.min(F.struct("doc_id", "set_id"))["set_id"].alias("head_set_id"))
    heads = whole.groupBy("component").agg(*smallest)
    more = ["text_hash", "set_id", "head_set_id"] if with_sets else []
    alone = ["text_hash", "set_id", F.col("set_id").alias("head_set_id")] if with_sets else []
    named = whole.join(heads, "component").select("set_id", "component_id", *["head_set_id"] * with_sets)
    linked = full.join(named, "set_id").select("doc_id", F.col("n").alias("n_shingles"), "component_id", *more)
    empty = rows.filter(~able).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), *alone)
    return linked.unionAll(empty)
