import random
import tempfile

import numpy as np
import pytest
import xxhash

from packetloom.llm import url_filter
from packetloom.llm.queries import URL_RULES
from packetloom.llm.url_filter import DigestArray, split_url

RULES = [*URL_RULES, ("org", "/e", "block"), ("b.org", "", "allow"), ("b.org", "/e", "allow"), ("b.org", "/e", "block")]
SCHEMA = "host string, path string, verdict string"


def brute(url, rules):
    host, path = split_url(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda f: (f[0], f[1], f[3] == "block"), default=None)
    return (host, path, best[2], best[3]) if best else (host, path, None, "allow")


def urls():
    pick = random.Random(4)
    hosts = ["com", "example.com", "www.example.com", "x.www.example.com", "EXAMPLE.com", "notexample.com", "a.net", "net", "b.org", "c.b.org", "é.org", "b.org:80", ".com", "com."]
    paths = ["", "/", "/en/", "/en", "/es/1", "/fr/?q=/en/", "?x=/en/", "#/en/", "/e", "/efg://x", "/en/é?a#b"]
    made = [f"{pick.choice(['http', 'https', 'HTTP', ''])}://{pick.choice(hosts)}{pick.choice(paths)}" for _ in range(400)]
    return made + [None, "", "no scheme/en/", "://", "a://b://c", "http://" + "a." * 300 + "com/" + "x" * 5000]


@pytest.mark.parametrize("group_bytes", [url_filter.GROUP_BYTES, 60])
def test_equals_brute_force(spark, group_bytes):
    rows = [(i, u, "old", 1) for i, u in enumerate(urls())]
    pages = spark.createDataFrame(rows + rows[:3], "page_id long, url string, verdict string, _key int")
    rules = spark.createDataFrame([*RULES, (None, "/", "block"), ("com", None, "block")], SCHEMA)
    judged = url_filter.judge_urls(pages, rules, group_bytes=group_bytes)
    found = judged.collect()
    assert len(found) == len(rows) + 3 and judged.columns == ["page_id", "url", "_key", "host", "path", "rule", "verdict"]
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == brute(r.url, RULES), r.url


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = spark.createDataFrame([], SCHEMA)
    assert [r.verdict for r in url_filter.judge_urls(pages, none, default="block").collect()] == ["block"]
    assert url_filter.judge_urls(pages.limit(0), spark.createDataFrame(RULES, SCHEMA)).count() == 0


def test_collisions_are_confirmed_by_the_string(monkeypatch):
    """With a digest of two bits most entries collide, and the answers stay right."""
    real = xxhash.xxh64_intdigest
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda b: real(b) & 3)
    with tempfile.NamedTemporaryFile() as f:
        f.write(DigestArray.pack(RULES))
        f.flush()
        index = DigestArray.mapped(f.name)
        assert np.all(index.digests[1:] >= index.digests[:-1])
        split = [split_url(u) for u in urls()]
        for (host, path), best in zip(split, url_filter.longest_rules(index, split)):
            expected = brute(f"x://{host}{path}", RULES)
            assert (best or (None, "allow")) == expected[2:] or not host


def test_a_url_of_many_dots_takes_little_memory():
    """A host of half a million labels, which would make as many candidates; only those as long as a rule's host are made."""
    import tracemalloc

    with tempfile.NamedTemporaryFile() as f:
        f.write(DigestArray.pack(RULES))
        f.flush()
        index = DigestArray.mapped(f.name)
    made = ["http://" + "a." * 500_000 + "example.com/en/" + "x" * 1_000_000, "http://" + "." * 1_000_000 + "net/es/", "http://" + "b" * 1_000_000 + "com/"]
    split = [split_url(u) for u in made]
    tracemalloc.start()
    found = url_filter.longest_rules(index, split)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [("example.com/en/", "block"), ("net/es/", "block"), None] and peak < 20 << 20
    for longest in range(1, 12):
        for host in ("a.b.c", "com", ".com", "com.", "..a", "x.example.com"):
            whole = list(url_filter.host_suffixes(host, 99))
            assert list(url_filter.host_suffixes(host, longest)) == [h for h in whole if len(h) <= longest]
