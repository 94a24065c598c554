import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siftlake.llm import urlfilter
from siftlake.llm.urlfilter import ALLOW, BLOCK, RULES, Rule


def brute_parts(url):
    m = re.search(r"\A.*?://([^/?#]*)([^?#]*)", url or "", re.S)
    return (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")


def brute_rule(url, rules=RULES):
    host, path = brute_parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.place), default=None)
    return (best.place, best.verdict) if best else (None, None)


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.NET/x", "https://m.example.net/en/25#top", "https://example.net/en",
    "https://example.net/EN/1", "https://notexample.net/en/", "http://x.Example.com/de/1?x=://y.org/fr/", "http://example.com/de", "http://b.org/fr/?a=1",
    "http://org/fr/1", "http://xorg/fr/1", "http://a.b.c.d.net/q", "http://a..net/", "http://.net/", "http://x.net?q=/", "http://x.net#/", "a://b://c.net/",
    "http://é.net/ü/?ö", "http://x.org/fr/\nnext", "\nhttp://x.net/\n", "http://u:p@x.net:80/", "http://x.net/" + "a/" * 50_000, "http://" + "a." * 3000 + "net/z",
]


def test_host_path_and_rule(spark):
    rows = urlfilter.judged(spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id int, url string")).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        assert (r.host, r.path) == brute_parts(r.url), r.url
        assert (r.rule, r.rule_verdict) == brute_rule(r.url), r.url


def test_other_rules(spark):
    rules = (Rule("b.net/x", ALLOW), Rule("net/x/y", BLOCK), Rule("b.net/", BLOCK))
    urls = spark.createDataFrame([(u,) for u in URLS + ["http://b.net/x/y", "http://a.b.net/xx", "http://c.net/x/yz"]], "url string")
    for r in urlfilter.judged(urls, rules).collect():
        assert (r.rule, r.rule_verdict) == brute_rule(r.url, rules)
    assert {r.rule for r in urlfilter.judged(urls, ()).collect()} == {None}


def test_lexical_features(spark):
    rows = urlfilter.lexical(urlfilter.judged(spark.createDataFrame([(u,) for u in URLS], "url string"))).collect()
    for r in rows:
        data = (r.url or "").encode()
        steps = lambda n: math.floor(4 * math.log2(1 + n))
        counts = Counter(data).values()
        entropy = sum(-c / len(data) * math.log2(c / len(data)) for c in counts)
        assert r.f_length == steps(len(data)) and r.f_host == steps(len(r.host.encode())) and r.f_depth == steps(r.path.count("/"))
        assert r.f_parameters == steps((r.url or "").count("=")) and abs(r.f_entropy - 8 * entropy) <= 1
        assert r.f_digits == 32 * sum(48 <= b < 58 for b in data) // max(len(data), 1)


def labelled(spark, n, seed):
    """Blocked urls are long, with many digits and parameters, or lie in one domain."""
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        bad = r.random() < 0.4
        host = r.choice(["shop.pills.com", "x.pills.com"]) if bad and r.random() < 0.5 else r.choice(["a.news.com", "b.wiki.org", "c.home.net"])
        tail = "".join(r.choice("0123456789") for _ in range(30)) + "?a=1&b=2&c=3" if bad and "pills" not in host else r.choice(["about", "index", "story"])
        rows.append((f"http://{host}/{r.randrange(1000)}/{tail}", bad))
    return spark.createDataFrame(rows, "url string, blocked boolean")


def test_held_out_urls(spark):
    model = urlfilter.fit(labelled(spark, 1500, 1), trees=5)
    test = labelled(spark, 500, 2).withColumn("f_depth", F.lit("own")).withColumn("host", F.lit("old"))
    out = urlfilter.verdicts(test, model, ())
    assert "f_depth" in out.columns and out.where("f_depth = 'own'").count() == 500
    right = out.where((F.col("verdict") == BLOCK) == F.col("blocked")).count()
    assert right >= 490


def test_hot_domains_are_spread(spark, monkeypatch):
    model = urlfilter.fit(labelled(spark, 600, 3), trees=2)
    urls = labelled(spark, 200, 4)
    plain = Counter(tuple(r) for r in urlfilter.verdicts(urls, model).collect())
    monkeypatch.setattr("siftlake.operators.skew.HOT_ROWS", 10)
    assert Counter(tuple(r) for r in urlfilter.verdicts(urls, model).collect()) == plain


@pytest.mark.parametrize("known", [[], [("http://x.com/", True)], [(None, None)]])
def test_nothing_to_learn(spark, known):
    model = urlfilter.fit(spark.createDataFrame(known, "url string, blocked boolean"))
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id int, url string")
    for r in urlfilter.verdicts(pages, model).collect():
        assert r.verdict == (brute_rule(r.url)[1] or ALLOW)


def test_whole_table(spark):
    pages = spark.createDataFrame([(i, u, "<html>") for i, u in enumerate(URLS * 2)], "page_id int, url string, html string")
    out = urlfilter.url_table(pages, trees=3)
    assert out.columns[:3] == ["page_id", "host", "path"] and out.count() == 2 * len(URLS)
    for r in out.join(pages, "page_id").collect():
        assert r.rule == brute_rule(r.url)[0] and r.verdict == (brute_rule(r.url)[1] or r.verdict) and r.verdict in (ALLOW, BLOCK)
    assert urlfilter.url_table(pages.where("page_id < 0")).collect() == []
