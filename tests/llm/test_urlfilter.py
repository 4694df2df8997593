"""Verdicts against a loop over the rules; odd URLs; repeated and null rows."""
import re

import pytest

from pagemill.llm.queries import URL_RULES
from pagemill.llm.urlfilter import filter_pages, rules_frame


def brute(url, rules, default="allow"):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    host, path = (low(m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), v == "block", h + p) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], ("block" if best[1] else "allow") if best else default


URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.com/en/1", "x://www.example.com/en/", "http://a.www.example.com/en/9?q#f",
        "http://example.com", "http://com/x", "http://notexample.com/en/a", "http://example.com:80/en/", "http://u@example.com/en/",
        "http://a.net/es/", "http://a.net/es", "http://net/fr/x?y=/es/", "ftp://b.net?x://c.com/en/", "http://É.COM/ü/x",
        "http://.com/", "http://a..com/x\ny", "http://www.example.com/en/\n", "http://x.org/en/", "http://a.b.c.d.e.f.net/fr/"]


@pytest.mark.parametrize("rules", [URL_RULES, [("block", "org", ""), ("allow", "x.org", "/e"), ("block", "x.org", "/e"),
                                               ("block", "f.net", "/fr/x/y"), ("allow", "é.com", "/ü")], []])
def test_against_a_loop(spark, rules):
    df = spark.createDataFrame([(i % 9, u, 1) for i, u in enumerate(URLS * 2)] + [(None, "http://a.net/es/", 1)],
                               "page_id long, url string, host int")
    got = sorted(str(tuple(r)) for r in filter_pages(df, rules_frame(spark, rules)).collect())
    assert got == sorted(str((r["page_id"], *brute(r["url"], rules))) for r in df.collect())
    assert filter_pages(df.limit(0), rules_frame(spark, rules)).collect() == []


def test_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = sorted(tuple(map(str, r)) for r in filter_pages(df, rules_frame(spark, URL_RULES)).collect())
    assert got == sorted(tuple(map(str, (r["page_id"], *brute(r["url"], URL_RULES)))) for r in df.select("page_id", "url").collect())
