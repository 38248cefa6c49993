from __future__ import annotations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from nearmiss.llm import url_filter as u
from nearmiss.llm.queries import BLOCKED_HOSTS, URL_RULES


def array(entries):
    return u.DigestArray(np.frombuffer(u.pack_entries(entries), dtype=np.uint8))


ENTRIES = [(t, u.RULE_ALLOW if k == "allow" else u.RULE_BLOCK) for t, k in URL_RULES] + [(t, u.LISTED) for t in BLOCKED_HOSTS]


def brute(url):
    host, path = u.split_url(url)

    def fits(text):
        h, slash, p = text.partition("/")
        return bool(host) and (host == h or host.endswith("." + h)) and path.startswith(slash + p)

    rules = [(len(t), t, k) for t, k in URL_RULES if fits(t)]
    if rules:
        return host, path, max(rules)[1], max(rules)[2]
    return host, path, None, "block" if any(map(fits, BLOCKED_HOSTS)) else "allow"


URLS = [None, "", "no scheme", "http://", "http:///x", "http://A.Example.NET/en/x?y#z", "https://example.net/EN/", "x://org/fr/",
        "http://org/fr", "http://example.com/de/1", "http://sub.example.com/de/", "http://badexample.com/de/", "http://net",
        "http://net/", "http://a.net?x/y", "http://www.spam-farm.example.org/p", "http://spam-farm.example.org:80/p", "http://É.net/",
        "a://b://c.net/", "http://.net/", "http://x..org/fr/a"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aA.:/?#netorgfxd-", max_size=40).map(lambda s: "http://" + s), max_size=5))
def test_verdicts_match_brute_force(some):
    some = some + URLS
    found = u.judge(some, array(ENTRIES))
    assert list(zip(found["host"], found["path"], found["rule"], found["verdict"])) == [brute(x) for x in some]


def test_equal_digests_of_different_texts(monkeypatch):
    """All digests collide: the stored texts alone decide."""
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda b: 7)
    a = array([("a.b/", u.RULE_BLOCK), ("c.d/", u.RULE_ALLOW), ("e.f", u.LISTED)])
    assert a.find(["c.d/", "a.b/", "x", "e.f"]).tolist() != [-1] * 4
    assert [a.text(i) if i >= 0 else None for i in a.find(["c.d/", "a.b/", "x", "e.f"])] == ["c.d/", "a.b/", None, "e.f"]


def test_longest_rule_wins_and_long_hosts_are_bounded():
    a = array([("net/", u.RULE_BLOCK), ("x.net/", u.RULE_ALLOW), ("net/deep/er/", u.RULE_ALLOW)])
    host = "y." * 50_000 + "x.net"
    assert u.judge([f"http://{host}/", f"http://{host}/deep/er/z", "http://z.net/a"], a)["verdict"] == ["allow", "allow", "block"]
    assert len(a.probes(host, "/")) <= 3 * 3


def test_query_rows(spark, crowded):
    rows = [(i, x) for i, x in enumerate(URLS)] + [(None, "http://a.net/"), (5, URLS[5])]
    frame = crowded(spark.createDataFrame(rows, "page_id long, url string")).repartition(3)
    got = u.filter_urls(frame, URL_RULES, BLOCKED_HOSTS).collect()
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in got) == sorted(
        (str(i), h, p, str(rule), v) for i, x in rows for h, p, rule, v in [brute(x)]
    )
    assert u.filter_urls(frame.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in u.filter_urls(frame, [], []).collect()} == {"allow"}


def test_opening_a_large_list_reads_its_head_only(monkeypatch):
    entries = [(f"h{i}.example/{'p' * (i % 5)}", u.LISTED) for i in range(20_000)] + [("no-path.example.net", u.LISTED)]
    image = np.frombuffer(u.pack_entries(entries), dtype=np.uint8)
    monkeypatch.setattr(u.DigestArray, "text", lambda *a: pytest.fail("an entry was read"))
    array = u.DigestArray(image)
    assert array.path_lengths == [0, 1, 2, 3, 4, 5] and array.longest_host == len("no-path.example.net") and len(array.keys) == 20_001
    assert u.DigestArray(np.frombuffer(u.pack_entries([]), dtype=np.uint8)).path_lengths == []
