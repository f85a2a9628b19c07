"""URL filter: path and host rules first, then logistic regression on hashed character n-grams.

The model is fitted on the driver over the short labelled table below (plain Python, a fixed
number of rows). Scoring is SQL expressions only: n-grams by ``substring``, buckets by
``xxhash64`` and weights from one literal array of ``BUCKETS`` numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import cache

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.llm.texts import lower_ascii

# (verdict, host, start of the path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
BUCKETS = 4096
WIDTHS = (3, 4, 5)

# The labelled table: host and path, 1 to block.
WANTED = """news.example.org/en/812 www.theren.example.org/de/14 blog.gardenclub.example.net/2021/05/roses
library.example.org/en/catalogue/7 www.therat.example.net/en/231 m.cityguide.example.org/fr/49.html
docs.python-notes.example.org/tutorial/3 www.weather-report.example.org/de/925 ththan.example.net/en/960
research.university.example.org/papers/2019/44 blog.tionsh.example.org/es/533 kitchen.example.net/recipes/soup
history-museum.example.org/en/exhibits museum.example.net/de/612 therin.example.net/en/770 forum.cycling.example.org/t/88
therea.example.net/en/785.html www.ththwh.example.org/en/471 encyclopedia.example.org/wiki/river ththble.example.net/de/234
parliament.example.org/debates/2020 m.ththth.example.net/en/25 www.thering.example.org/en/328/ hospital.example.org/advice/sleep
ththed.example.org/en/453 blog.thertion.example.org/fr/10 school.example.net/science/lesson4 blog.ththly.example.org/en/777
travelnotes.example.org/islands/3 blog.ththon.example.net/de/180/ astronomy.example.net/moon erand.example.org/en/77
onthat.example.org/de/300 blog.ineror.example.net/en/61 www.edstor.example.org/es/9 m.handre.example.net/de/18.html""".split()
UNWANTED = """spam-farm.example.org/en/728 www.cheap-pills.example.org/en/450 free-bets.example.net/de/963
www.casino-win.example.org/en/14 ads-track.example.org/en/584 m.spam-farm.example.net/de/3 cheap-pills.example.net/fr/1
best-casino.example.org/bonus casino-bonus.example.net/de/88 click-ads.example.org/banner/5 ads-server.example.net/track?id=4
buy-viagra.example.org/cheap pills-online.example.net/order online-poker.example.org/win win-prizes.example.net/claim
free-money.example.org/now free-iphone.example.net/claim hot-singles.example.org/chat adult-cams.example.net/live
payday-loans.example.org/apply quick-loans.example.net/en/2 replica-watches.example.org/sale cheap-watches.example.net/de/71
track-clicks.example.org/r/9 adtracker.example.net/pixel slots-jackpot.example.org/spin bet-now.example.net/odds
lottery-winner.example.org/claim xxx-videos.example.net/1 link-farm.example.org/a/33 seo-spam.example.net/backlinks
m.free-bets.example.org/en/27 www.casino-win.example.net/de/660 blog.spam-farm.example.org/es/4 ads-track.example.net/de/71
www.cheap-pills.example.net/en/926/""".split()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host between the first ``://`` and ``/ ? #``, A-Z in lower case; path up to ``? #``.

    Null and texts without ``://`` give two empty texts.
    """
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, whole, 1)), F.regexp_extract(url, whole, 2)


def grams(text: str) -> Counter:
    """Counts of buckets; the SQL twin is ``_margin``."""
    found = (text[i:i + n] for n in WIDTHS for i in range(len(text) - n + 1))
    return Counter(xxhash.xxh64_intdigest(g.encode(), 42) % BUCKETS for g in found)


@cache
def fitted(rounds: int = 40, rate: float = 0.5, ridge: float = 0.002) -> tuple[float, tuple[float, ...]]:
    """Bias and weights by gradient steps over the labelled table; the same on every call."""
    rows = [(u, 0) for u in WANTED] + [(u, 1) for u in UNWANTED]
    rows = [(u.partition("?")[0], y) for u, y in rows]
    data = []
    for text, y in sorted(rows, key=lambda r: xxhash.xxh64_intdigest(r[0])):
        counts = grams(f"^{text}$")
        norm = math.sqrt(sum(counts.values()))
        data.append(([(b, c / norm) for b, c in counts.items()], y))
    bias, weights = 0.0, [0.0] * BUCKETS
    for _ in range(rounds):
        for features, y in data:
            margin = bias + sum(weights[b] * x for b, x in features)
            error = y - 1 / (1 + math.exp(-max(-30.0, min(30.0, margin))))
            bias += 0.1 * rate * error
            for b, x in features:
                weights[b] += rate * (error * x - ridge * weights[b])
    return round(bias, 6), tuple(round(w, 6) for w in weights)


def _grams(text: Column, n: int) -> Column:
    at = F.sequence(F.lit(1), F.length(text) - (n - 1))
    none = F.array().cast("array<string>")
    return F.when(F.length(text) >= n, F.transform(at, lambda i: F.substring(text, i, F.lit(n)))).otherwise(none)


def _margin(text: Column) -> Column:
    bias, weights = fitted()
    table = F.expr(f"cast(split('{','.join(f'{w:g}' for w in weights)}', ',') as array<double>)")
    found = F.concat(*(_grams(text, n) for n in WIDTHS))
    total = F.aggregate(found, F.lit(0.0),
                        lambda s, g: s + F.element_at(table, F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int") + 1))
    return F.lit(bias) + total / F.sqrt(F.greatest(F.size(found), F.lit(1)).cast("double"))


def _fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    _, at, start = rule
    return ((host == at) | host.endswith(f".{at}")) & path.startswith(start)


def judge(pages: DataFrame, url: str = "url", rules: tuple = RULES) -> DataFrame:
    """``pages`` with host, path, rule, score and verdict.

    The longest rule (host and path together) that fits decides; equally long ones in the
    order given. Without one, a score of 0.5 or more blocks. Null urls and urls without
    ``://`` have empty host and path and are judged by the score of the empty text. Columns
    of ``pages`` with one of the five names are replaced; repeated rows are judged alike.
    """
    host, path = host_and_path(F.col(url))
    df = pages.withColumns({"host": host, "path": path})
    host, path = F.col("host"), F.col("path")
    rule = verdict = None
    for r in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = _fits(host, path, r)
        rule = F.when(fits, f"{r[1]}{r[2]}") if rule is None else rule.when(fits, f"{r[1]}{r[2]}")
        verdict = F.when(fits, r[0]) if verdict is None else verdict.when(fits, r[0])
    margin = _margin(F.concat(F.lit("^"), host, path, F.lit("$")))
    df = df.withColumn("score", 1 / (1 + F.exp(-margin)))
    by_score = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    if rule is None:
        return df.withColumns({"rule": F.lit(None).cast("string"), "verdict": by_score})
    return df.withColumns({"rule": rule, "verdict": F.coalesce(verdict, by_score)})
