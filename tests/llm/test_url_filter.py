import math
import re

import pytest

from propensity.llm import url_filter

URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.com", "https://example.com/en/", "http://www.example.com/en/1?x#y",
        "http://sub.www.example.com/en/1", "http://a.net/es/", "http://net/fr/x", "http://xnet/fr/x", "x://a://b/c",
        "http://example.com?/en/", "http://cheap-pills.example.org/buy", "http://a.example.org/é/漢", "http://a.net/esx",
        "http://casino-win.example.net/en/3", "http://example.com/en/\nrest#z", "http://h#/en/"] * 2


def by_hand(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in url_filter.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    bias, weights = url_filter.fitted()
    found = url_filter.grams(f"^{host}{path}$")
    score = bias + sum(weights[b] * n for b, n in found.items()) / math.sqrt(max(1, sum(found.values())))
    rule = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    verdict = rule[0] if rule else "block" if score >= 0 else "allow"
    return host, path, rule and rule[1] + rule[2], verdict, 1 / (1 + math.exp(-score))


def test_same_as_by_hand(spark):
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule, verdict, score = by_hand(url)
        assert tuple(got[i])[:5] and (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict)
        assert got[i].score == pytest.approx(score, abs=1e-4)


def test_unseen_urls():
    bias, weights = url_filter.fitted()
    assert by_hand("http://mega-casino.example.org/en/9")[3] == "block"
    assert by_hand("http://villagechoir.example.org/en/9")[3] == "allow"


def test_empty_table_and_own_rules(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(pages).count() == 0
    one = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert url_filter.judge(one, rules=(("block", "b", "/"),)).first().rule == "b/"
    assert url_filter.judge(one, rules=()).first().rule is None
