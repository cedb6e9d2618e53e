from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from opinio.llm import urls
from opinio.llm.common import table
from opinio.llm.queries import LISTED_LABELS, RULES, op4_url_filter

URLS = [
    None, "", "no scheme/en/", "http://", "HTTP://Example.NET/en/x?q=/de/", "http://a.example.net/EN/x",
    "https://example.com/de/#top", "https://notexample.com/de/", "x://y.org/fr/a://b", "https://net/x",
    "https://ne\u00c9T.net", "http://é.org/fr/", "http://www.bad.example/p/q//?utm=1", "https://BAD.example/p/q",
    "https://bad.example/p", "http://m.bad.example/p/q#x", "a\nb://bad.example/p/q",
]
LISTED = ["ftp://bad.example/p/q/", "ftp://bad.example/p/q", None, "nothing", "http://other.example/"]


def cut(url):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    lower = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)
    return (lower(found[1]), found[2]) if found else ("", "")


def canon(url):
    host, path = cut(url)
    return re.sub(r"^(?:www|m)\.", "", host) + path.rstrip("/")


def brute(url, listed):
    host, path = cut(url)
    fits = [
        r for r in RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    rule = max(fits, key=lambda r: len(r.name), default=None)
    hit = canon(url) != "" and canon(url) in {canon(u) for u in listed}
    return host, path, rule and rule.name, rule.verdict if rule else "block" if hit else "allow"


@pytest.mark.parametrize("most", [1, 1 << 17])
def test_verdicts_equal_brute_force_whatever_the_filter_lets_through(spark, monkeypatch, most):
    monkeypatch.setattr(urls, "FEWEST_BLOCKS", 1)
    monkeypatch.setattr(urls, "MOST_BLOCKS", most)
    listed = LISTED + [f"http://list{i}.example/x" for i in range(400)]
    rows = [(i, u, "mine", "yours", "old") for i, u in enumerate(URLS * 2)]
    pages = spark.createDataFrame(
        rows, "page_id bigint, url string, _key string, _listed string, verdict string"
    )
    frame = spark.createDataFrame([(u,) for u in listed], "url string")
    got = {r.page_id: r for r in urls.judge_urls(pages, RULES, frame).collect()}
    assert len(got) == len(rows)
    for i, u, *_ in rows:
        assert (got[i]._key, got[i]._listed) == ("mine", "yours")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == brute(u, listed), u


def test_nothing_listed_and_no_pages(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id bigint, url string")
    none = spark.createDataFrame([], "url string")
    got = urls.judge_urls(pages, RULES, none).collect()
    assert sorted((r.page_id, r.verdict) for r in got) == [
        (i, brute(u, [])[3]) for i, u in enumerate(URLS)
    ]
    assert urls.judge_urls(pages.limit(0), RULES, none).count() == 0


def test_the_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(5000).select(F.concat(F.lit("host/"), "id").alias("key"))
    n = urls.blocks_for(5000)
    bits = urls.bloom_filter(keys, n).scalar()
    assert keys.where(~urls.maybe_listed(F.col("key"), bits, n)).count() == 0
    others = spark.range(5000, 25_000).select(F.concat(F.lit("host/"), "id").alias("key"))
    assert others.where(urls.maybe_listed(F.col("key"), bits, n)).count() < 400


def test_query_over_the_table(spark, data):
    pages = {r.page_id: r.url for r in table(spark, data, "pages").collect()}
    listed = [u for u in pages.values() if re.split("[/.]", canon(u))[0] in LISTED_LABELS]
    assert listed
    rows = op4_url_filter(spark, data).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    assert {"allow", "block"} <= {r.verdict for r in rows if r.rule is None}
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == brute(pages[r.page_id], listed)


def test_possible_hits_are_true_and_false_ones(spark):
    listed = spark.range(300).select(F.concat(F.lit("http://list"), "id", F.lit(".example/x")).alias("url"))
    keys = listed.select(urls.canonical(F.col("url")).alias("key"))
    bits = urls.bloom_filter(keys, 8).scalar()
    others = spark.range(4000).select(F.concat(F.lit("other"), "id", F.lit(".example/x")).alias("key"))
    possible = others.where(urls.maybe_listed(F.col("key"), bits, 8)).count()
    assert 0 < possible < 4000
    assert keys.where(urls.maybe_listed(F.col("key"), bits, 8)).count() == 300
