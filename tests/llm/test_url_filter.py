from __future__ import annotations

import itertools
import math
import re
from collections import Counter

from pricecube.llm.queries import QUERIES
from pricecube.llm.url_filter import CONFIDENCE, LEAST_PAGES, PARTS, RULES, SUPPORT, url_filter


def split(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = m[1].translate({c: c + 32 for c in range(65, 91)}) if m else ""
    return host, m[2] if m else ""


def rule_of(host, path):
    fits = []
    for verdict, rule in RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def tokens(url):
    host, path = split(url)
    out = {"scheme=" + url.split("://")[0], "fragment=" + (url.split("#", 1)[1] if "#" in url else "")}
    for name, parts in (("host", host.split(".")[::-1]), ("path", path.split("/"))):
        for i, p in enumerate([p for p in parts if p][:PARTS]):
            out.add(f"{name}{i}=" + re.sub("[0-9]+", "0", p))
    rest = url.split("#", 1)[0]
    query = rest.split("?", 1)[1] if "?" in rest else ""
    return out | {"query=" + p.split("=")[0] for p in query.split("&")[:PARTS]}


def plain(urls):
    """Counts all token sets of all labelled pages and applies every rule."""
    judged = [(u, *split(u), *rule_of(*split(u))) for u in urls]
    taught = [(tokens(u), v) for u, _, _, _, v in judged if v]
    single = Counter(t for ts, _ in taught for t in ts)
    least = min(len(taught), max(math.ceil(SUPPORT * sum(v == "block" for _, v in taught)), LEAST_PAGES))
    often = {t for t, n in single.items() if n >= least}
    total, block = Counter(), Counter()
    for ts, v in taught:
        ts = sorted(ts & often)
        for k in range(1, len(ts) + 1):
            for s in itertools.combinations(ts, k):
                total[s] += 1
                block[s] += v == "block"
    rules = {frozenset(s) for s, n in block.items() if n >= least and n >= CONFIDENCE * total[s]}
    out = []
    for u, h, p, r, v in judged:
        if v is None:
            v = "block" if h and any(s <= tokens(u) for s in rules) else "allow"
        out.append((h, p, r, v))
    return out


def test_query_equals_counting_all_combinations(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r.page_id: tuple(r[1:]) for r in QUERIES["op5_url_filter"](spark, sf_dir).collect()}
    want = dict(zip([r.page_id for r in pages], plain([r.url for r in pages]), strict=True))
    assert got == want


def test_the_share_of_the_blocked_pages_decides_on_larger_tables(spark, sf_dir):
    """Above 250 blocked pages the support is their share and not the least count."""
    larger = sf_dir.replace("0.001", "0.1")
    pages = spark.read.parquet(f"{larger}/pages.parquet").collect()
    blocked = sum(rule_of(*split(r.url))[1] == "block" for r in pages)
    assert SUPPORT * blocked > LEAST_PAGES
    got = {r.page_id: tuple(r[1:]) for r in QUERIES["op5_url_filter"](spark, larger).collect()}
    assert got == dict(zip([r.page_id for r in pages], plain([r.url for r in pages]), strict=True))


def test_awkward_urls(spark):
    urls = [None, "", "no scheme/at all", "://", "http://", "http://COM/", "http://com", "http://a.com?x", "http://net/es/1", "http://NET/es/", "http://xnet/es/", "http://www.example.com/en/a", "http://b.example.com/en/#f", "http://a/b://c/d", "http://net/fr/\nx", "http://é.net/fr/?a=1&b"]
    urls += [f"http://h{i}.net/fr/{i}" for i in range(30)] + [f"http://h{i}.org/fr/{i}" for i in range(5)]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)] + [(None, urls[9], "x", "y")], "page_id int, url string, host string, tokens string")
    got = sorted(str(tuple(r)) for r in url_filter(pages).collect())
    want = plain([*urls, urls[9]])
    assert got == sorted(str((i, *w)) for i, w in zip([*range(len(urls)), None], want, strict=True))


def test_nothing_to_learn(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id int, url string")
    assert {r.verdict for r in url_filter(pages).collect()} == {"allow"}
    assert url_filter(pages.limit(0)).collect() == []


def test_parts_of_any_depth(spark):
    """A token far behind in path, query or host is learnt and matched, and so is one of a long address that pages share."""
    deep, keys, labels = "/".join(f"d{i}" for i in "abcdefghijk"), "&".join(f"k{i}=1" for i in "abcdefghijk"), ".".join("lmnopqrstuv")
    many = "&".join(f"track{i}=1" for i in range(40))
    urls = [f"http://h{i}.com/x/{i}" for i in range(40)]
    for i in "abcdefgh":
        urls += [f"http://p{i}.net/es/{deep}/ad", f"http://q{i}.net/es/?{keys}&ad={i}", f"http://ad.{labels}.net/fr/{i}", f"http://r{i}.net/es/{i}?{many}"]
    blocked = ["http://s.org/" + "/".join("ABCDEFGHIJKL") + "/ad", "http://s.org/?" + "&".join("ABCDEFGHIJKL") + "&ad=9", "http://ad." + ".".join("ABCDEFGHIJK") + ".org/", "http://s.org/?track33=2"]
    allowed = ["http://s.org/" + "/".join("ABCDEFGHIJKL") + "/da", "http://s.org/ad", "http://s.org/?da=9", "http://ad.s.org/"]
    pages = spark.createDataFrame(list(enumerate([*urls, *blocked, *allowed])), "page_id int, url string")
    got = {r.page_id: r.verdict for r in url_filter(pages).collect()}
    assert [got[len(urls) + i] for i in range(8)] == ["block"] * 4 + ["allow"] * 4
    assert all(got[i] == ("allow" if i < 40 else "block") for i in range(len(urls)))


def test_a_hot_allowed_host_does_not_dilute(spark):
    """Ten blocked pages teach the same rule beside 30 and beside 900 allowed ones."""
    urls = [f"http://h{i}.net/es/x{'abcdefghij'[i]}/ad" for i in range(10)] + ["http://s.org/en/y/ad", "http://s.org/en/y/da"]
    for hot in (30, 900):
        pages = spark.createDataFrame(list(enumerate([*urls, *(f"http://hot.com/en/{i}" for i in range(hot))])), "page_id int, url string")
        got = {r.page_id: r.verdict for r in url_filter(pages).collect()}
        assert (got[10], got[11]) == ("block", "allow")


def test_many_parts_that_go_together_loosely(spark):
    """Twenty-four keys, each on most pages of a blocked site, make 24 rules and not 2**24 patterns."""
    urls = [f"http://x{'abcdefgh'[i % 8]}.net/es/?" + "&".join(f"k{j}=1" for j in range(24) if (i * 7 + j * 5) % 23) for i in range(120)]
    urls += [f"http://a.com/x/{i}" for i in range(120)] + ["http://s.org/?k17=0", "http://s.org/?l17=0"]
    got = {r.page_id: r.verdict for r in url_filter(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")).collect()}
    assert (got[240], got[241]) == ("block", "allow")
