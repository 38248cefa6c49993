"""URL filter: rules and block lists as one sorted array of 64-bit digests.

All entries (``host/path`` texts) are hashed with xxhash64 and sorted. The array, the
full entry texts and their actions go into one file that every executor fetches once
and all its Python workers map into memory. A URL is looked up by hashing each host
suffix joined with each path prefix that an entry could have, a vectorised binary
search, and a comparison with the stored text, so equal digests of different texts
can't give a false hit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearmiss.llm.common import arrow_batch, put_file

RULE_BLOCK, RULE_ALLOW, LISTED = 0, 1, 2

TYPES = {
    "page_id": pa.int64(), "host": pa.string(), "path": pa.string(), "rule": pa.string(),
    "verdict": pa.string(), "listed": pa.string(),
}
SCHEMA = "page_id long, host string, path string, rule string, verdict string, listed string"


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path). Host: after the first ``://`` up to ``/ ? #``, A-Z lower-cased. Path:
    from there up to ``? #``. Both empty without ``://``."""
    if not url:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    slash = rest.find("/", 0, end)
    host = rest[: end if slash < 0 else slash]
    return host.encode().lower().decode(), "" if slash < 0 else rest[slash:end]


def pack_entries(entries: Iterable[tuple[str, int]]) -> bytes:
    """The file image: count, longest host, number of path lengths, these, digests (sorted), text
    ends, actions, texts. So a task opens it without a look at its entries."""
    found = {text: action for text, action in sorted(entries, key=lambda e: (e[0], -e[1]))}
    rows = sorted((xxhash.xxh64_intdigest(t.encode()), t.encode(), a) for t, a in found.items())
    hosts = [text.find("/") if "/" in text else len(text) for text in found]
    lengths = sorted({len(text) - host for text, host in zip(found, hosts)})
    keys = np.array([r[0] for r in rows], dtype="<u8")
    ends = np.cumsum([len(r[1]) for r in rows], dtype="<u8") if rows else np.zeros(0, "<u8")
    actions = np.array([r[2] for r in rows], dtype="u1")
    head = np.array([len(rows), max(hosts, default=0), len(lengths), *lengths], dtype="<u8")
    return b"".join([head.tobytes(), keys.tobytes(), ends.tobytes(), actions.tobytes(), *(r[1] for r in rows)])


class DigestArray:
    """Read side of ``pack_entries`` over a buffer of bytes (a memory map in tasks)."""

    def __init__(self, image: np.ndarray):
        n, self.longest_host, paths = image[:24].view("<u8").tolist()
        self.path_lengths: list[int] = image[24 : 24 + 8 * paths].view("<u8").tolist()
        image = image[24 + 8 * paths :]
        self.keys = image[: 8 * n].view("<u8")
        self.ends = image[8 * n : 16 * n].view("<u8")
        self.actions = image[16 * n : 17 * n]
        self.texts = image[17 * n :]

    def text(self, i: int) -> str:
        start = int(self.ends[i - 1]) if i else 0
        return self.texts[start : int(self.ends[i])].tobytes().decode()

    def probes(self, host: str, path: str) -> list[str]:
        """Every text an entry that fits this host and path could have."""
        if not host:
            return []
        at, suffixes = 0, []
        while True:
            if len(host) - at <= self.longest_host:
                suffixes.append(host[at:])
            dot = host.find(".", at)
            if dot < 0:
                break
            at = dot + 1
        return [s + path[:k] for s in suffixes if s for k in self.path_lengths if k <= len(path)]

    def find(self, texts: list[str]) -> np.ndarray:
        """Index of the entry equal to each text, or -1."""
        out = np.full(len(texts), -1, dtype=np.int64)
        if not texts or not len(self.keys):
            return out
        keys = np.fromiter((xxhash.xxh64_intdigest(t.encode()) for t in texts), dtype="<u8", count=len(texts))
        lo = np.searchsorted(self.keys, keys, side="left")
        hi = np.searchsorted(self.keys, keys, side="right")
        for i in np.flatnonzero(hi > lo):
            for j in range(int(lo[i]), int(hi[i])):
                if self.text(j) == texts[i]:
                    out[i] = j
                    break
        return out


def judge(urls: list[str | None], array: DigestArray) -> dict[str, list]:
    """Host, path, longest fitting rule, verdict and fitting list entry of each URL."""
    parts = [split_url(u) for u in urls]
    owner: list[int] = []
    texts: list[str] = []
    for i, (host, path) in enumerate(parts):
        own = array.probes(host, path)
        texts += own
        owner += [i] * len(own)
    best: dict[int, tuple] = {}
    listed: dict[int, str] = {}
    hits = array.find(texts)
    for k in np.flatnonzero(hits >= 0):
        i, text, action = owner[k], texts[k], int(array.actions[hits[k]])
        if action == LISTED:
            listed[i] = max(listed.get(i, ""), text, key=len)
        else:
            best[i] = max(best.get(i, (0, 0, "", 0)), (len(text), len(text.partition("/")[0]), text, action))
    n = len(urls)
    return {
        "host": [h for h, _ in parts],
        "path": [p for _, p in parts],
        "rule": [best[i][2] if i in best else None for i in range(n)],
        "verdict": [
            ("allow" if best[i][3] == RULE_ALLOW else "block") if i in best else ("block" if i in listed else "allow")
            for i in range(n)
        ],
        "listed": [listed.get(i) for i in range(n)],
    }


def filter_urls(
    pages: DataFrame, rules: Iterable[tuple[str, str]], blocked: Iterable[str] = (), *, id_col="page_id", url_col="url"
) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` of every row of ``pages``.

    ``rules``: (``host/path``, ``allow`` or ``block``); a rule fits its host and all
    subdomains if the URL's path starts with the rule's; the longest wins, then the one
    with the longer host. ``blocked``: entries of the block list, judged alike, where no
    rule fits. No list entry either: ``allow``.

    A null URL or one without ``://`` has empty host and path and is allowed. Repeated
    rows stay repeated, null ids stay null, an empty table gives no rows; other columns
    are not read. The same text given as a rule and as a list entry is a rule; as both
    kinds of rule, a ``block``.
    """
    spark = pages.sparkSession
    entries = [(t, RULE_ALLOW if kind == "allow" else RULE_BLOCK) for t, kind in rules]
    name = put_file(spark, pack_entries(entries + [(t, LISTED) for t in blocked]), "url-digests")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(np.memmap(SparkFiles.get(name), dtype=np.uint8, mode="r"))
        for batch in batches:
            out = judge(batch.column(1).to_pylist(), array)
            yield arrow_batch({"page_id": batch.column(0)} | out, TYPES)

    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    return slim.mapInArrow(run, SCHEMA)
