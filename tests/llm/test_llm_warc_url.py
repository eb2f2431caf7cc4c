"""Operators 3 and 10 against brute force."""

from __future__ import annotations

import gzip
import hashlib
import math
import re
from collections import Counter

import pytest

from opsgrain.llm import registry, url_filter, warc
from opsgrain.llm.common import new_path

PAGES = "page_id long, url string, html string, digest string, bytes int, host int, rule int"


def pages(spark, rows):
    return spark.createDataFrame([r + (None,) * 4 for r in rows], PAGES)


BIG = "<p>" + "é" * 600 + "</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"


def test_warc_round_trip(spark):
    rows = [(1, "http://a/", BIG), (2, "http://b/", BIG), (3, None, BIG), (None, "http://n/", BIG), (5, "http://c/\r\nX: y", "small"), (6, "", "small"),
            (7, "http://e/", None), (8, "http://f/", ""), (9, "http://z/", "z" * 300_000), (3, None, BIG), (10, "u", "x" * 999), (11, "u", "x" * 999), (12, "u", "x" * 1000), (13, "u", "x" * 1000)]
    caps = warc.captures(pages(spark, rows))
    got = Counter(map(tuple, warc.resolve_revisits(caps).collect()))
    want = Counter()
    for i, _, html in rows:
        b = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == b and j is not None]
        original = max(same) if len(b) >= 1000 and same else None
        again = original is not None and (i is None or i < original)
        want[(i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", original if again else None)] += 1
    assert got == want
    for r in caps.collect():  # the three records of a capture found each other
        assert r["request"]["head"].startswith("GET ") and r["metadata"] is not None
        assert r["request"]["target_uri"] == r["response"]["target_uri"]
    assert warc.resolve_revisits(warc.captures(pages(spark, []))).count() == 0


def test_archives_are_readable_by_length_and_in_members(spark):
    path = new_path(spark, "warc-test")
    warc.write_archives(pages(spark, [(k, f"http://h/{k}", f"page {k}\r\n\r\n") for k in range(7)]).coalesce(1), path, captures_per_file=3)
    files = [r["content"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()]
    assert len(files) == 3
    records = [r for f in files for r in warc.parse_warc(bytes(f))]
    assert Counter(r[0] for r in records) == {"request": 7, "response": 7, "metadata": 7}
    plain = gzip.decompress(bytes(files[0]))
    cut = plain.index(b"\r\n\r\nWARC/1.1", 100) + 4
    members = gzip.compress(plain[:cut]) + gzip.compress(plain[cut:])
    assert list(warc.parse_warc(members)) == list(warc.parse_warc(bytes(files[0])))
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.parse_warc(gzip.compress(plain[:-30])))


def brute_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]


def brute_rule(host, path, rules):
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.host + r.path), r.verdict), default=None)
    return (best.host + best.path, best.verdict) if best else (None, None)


URLS = ["http://A.Example.ORG/es/1?x=1", "http://example.org/en/12", "http://example.org/en/2", "https://notexample.org/es/", "http://x.com/fr/", "http://x.com", "http://org", "http://org/",
        "http://com/de/a#b/c", "ftp://ÉX.com/fr/", "no scheme", "", None, "http://", "http://h?x://y/z", "a://b://c/d", "http://u.com/de/" + "q" * 20_000, "http://x.net/a-b/1?p=1&q=2&&r", "http://k.net/", "http://k.net/"]


def test_url_rules(spark):
    got = url_filter.judge_urls(pages(spark, [(k, u, None) for k, u in enumerate(URLS)]), trees=2, depth=2).collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path = brute_host_path(URLS[r["page_id"]])
        rule, verdict = brute_rule(host, path, url_filter.RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")


def test_url_features(spark):
    rows = url_filter.with_lexical_features(url_filter.with_host_path(pages(spark, [(k, u, None) for k, u in enumerate(URLS)]))).collect()
    for r in rows:
        u = URLS[r["page_id"]] or ""
        n = len(u)
        assert r["url_chars"] == n
        assert r["entropy"] == pytest.approx(-sum(c / n * math.log2(c / n) for c in Counter(u).values()) if n else 0, abs=1e-9)
        assert r["digit_ratio"] == pytest.approx(sum(c in "0123456789" for c in u) / n if n else 0)
        assert r["depth"] == len([x for x in brute_host_path(u)[1].split("/") if x])
        query = u.split("#")[0].partition("?")[2]
        assert r["n_params"] == len([x for x in query.split("&") if x])


@pytest.mark.parametrize(("rows", "want"), [([], []), ([(1, "http://x.net/", None)], ["allow"]), ([(1, "http://x.com/de/", None), (2, "http://x.net/", None)], ["block", "block"])])
def test_urls_without_two_kinds_of_labels(spark, rows, want):
    assert [r["verdict"] for r in url_filter.judge_urls(pages(spark, rows)).orderBy("page_id").collect()] == want


def test_trees_learn_the_labels(spark):
    rows = [(k, f"http://h{k}.com/{'de' if k % 2 else 'fr'}/{'1' * (20 if k % 2 else 1)}", None) for k in range(200)]
    rows += [(1000 + k, f"http://u{k}.com/xx/{'1' * (20 if k % 2 else 1)}", None) for k in range(20)]
    got = url_filter.judge_urls(pages(spark, rows)).where("rule is null").collect()
    assert all(r["verdict"] == ("block" if r["page_id"] % 2 else "allow") for r in got) and len(got) == 20


def test_registered_page_queries(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = registry.op10_url_filters(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = brute_host_path(rows[r["page_id"]]["url"])
        rule, verdict = brute_rule(host, path, url_filter.RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and (verdict is None or r["verdict"] == verdict)
