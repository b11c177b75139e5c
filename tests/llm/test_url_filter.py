"""URL filter: contract columns against plain Python, and the Bloom filter's part."""

import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import url_filter as U

URLS = ["http://A.Example.NET/en/1", "https://x.example.net/fr", "http://example.com/de/9?x=1", "http://www.example.com/en/a/", "ftp://fr.org/fr/x#y",
        "http://org/fr/", "http://org", "http://net", "http://net/", "http://notnet/a", "no scheme", None, "", "x://y://z/p", "http://spam-farm.example.org/en/1",
        "http://www.spam-farm.example.org/en/1/?a#b", "http://spam-farm.example.org:80/en/1", "http://example.net/EN/1", "http://h?q/x", "http://h#f", "://", "http://\nhost/pa\nth"]


def plain(url, listed):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m.group(1).translate(str.maketrans(U.UPPER, U.LOWER)), m.group(2)) if m else ("", "")
    fits = [(h + p, a) for a, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, action = max(fits, key=lambda f: len(f[0])) if fits else (None, None)
    return host, path, rule, action or ("block" if canonical(host, path) in listed else "allow")


def canonical(host, path):
    return re.sub(r"^www\.|:[0-9]*$", "", host) + path.rstrip("/")


@pytest.mark.parametrize("blocks", [1, 64, 1 << 15])
def test_verdicts(spark, blocks):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(5, URLS[5]), (None, URLS[14])], "page_id long, url string") \
        .selectExpr("*", "1 as block", "'x' as canonical", "2 as w0", "true as possible")
    listed = {canonical(*plain(u, ())[:2]) for u in URLS if re.search(r"(^|[.-])spam($|[.-])", plain(u, ())[0])}
    assert listed
    got = U.filter_urls(pages, U.listed_by_host(pages), blocks=blocks)
    rows = sorted((r.page_id is None, r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in got.collect())
    want = sorted((i is None, i or 0, *plain(u, listed)) for i, u in [*enumerate(URLS), (5, URLS[5]), (None, URLS[14])])
    assert rows == want


def test_filter_has_no_false_negative_and_a_fixed_size(spark):
    listed = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("canonical"))
    bits = U.bloom(listed, 128)
    assert bits.count() <= 128
    probe = spark.range(9000).select(F.concat(F.lit("u"), "id").alias("key"))
    kept = U.maybe_in(probe, "key", U.bloom(listed, 1 << 12), 1 << 12).filter("possible")
    found = {r.key for r in kept.collect()}
    assert {f"u{i}" for i in range(3000)} <= found and len(found) < 3200


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert U.filter_urls(pages, U.listed_by_host(pages)).collect() == []
