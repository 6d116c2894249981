import itertools
from datetime import datetime, timedelta


from parley.llm.url_filters import filter_urls, patterns
from pyspark.sql import functions as F

START = datetime(2024, 1, 1)


def covers(url):
    import re

    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)(?::[0-9]*)?(/[^?#]*)?", url or "")
    if not m:
        return []
    labels = m[1].lower().split(".")
    folder = re.match("/([^/]+)", m[2] or "")
    path = [f"{m[1].lower()}/{folder[1]}"] if folder else []
    return path + [".".join(labels[i:]) for i in range(max(len(labels) - 1, 1))]


URLS = [
    "http://a.b.example.com/x/y?z#f", "https://Example.COM", "ftp://u:p@h.org:21/q", "http://localhost/", "no url", "", None,
    "http://example.com/en/1", "http://example.com/?a/b", "http://b.example.com/en",
]


def test_patterns(spark):
    rows = spark.createDataFrame([(u,) for u in URLS], "url string").select("url", patterns(F.col("url")).alias("p")).collect()
    assert [r.p for r in rows] == [covers(r.url) for r in rows]


def brute(captures, entries):
    out = []
    for page, url, fetched in captures:
        best = ("none", None, None)
        for pattern in covers(url) if fetched else []:
            mine = [e for e in entries if e[0] == pattern and e[1] in ("block", "allow", "remove") and e[2] and e[2] <= fetched]
            if mine:
                last = max(e[2] for e in mine)
                action = max((e[1] for e in mine if e[2] == last), key=["remove", "allow", "block"].index)
                if action != "remove":
                    best = (action, pattern, last)
                    break
        out.append((page, fetched, *best))
    return out


def test_against_every_entry(spark):
    pats = ["example.com", "a.b.example.com", "a.b.example.com/x", "b.example.com/en", "h.org", "localhost", None]
    steps = [0, 1, 3600, 86399, 86400, 86401, 2 * 86400, 5 * 86400 + 7]
    entries = [
        (p, a, START + timedelta(seconds=s))
        for k, (p, a, s) in enumerate(itertools.product(pats, ["block", "allow", "remove", "odd"], steps))
        if (k * 7) % 5 < 2
    ] + [("h.org", "block", None), ("h.org", "block", START), ("h.org", "block", START)]
    captures = [(i, u, START + timedelta(seconds=s)) for i, (u, s) in enumerate(itertools.product(URLS, [-5, *steps, 20 * 86400]))]
    captures += [(7, URLS[0], START), (None, URLS[0], START), (8, URLS[0], None)]
    left = spark.createDataFrame(captures, "page_id long, url string, fetched timestamp").withColumn("pattern", F.lit("x"))
    right = spark.createDataFrame(entries, "pattern string, action string, dated timestamp")
    got = [tuple(r) for r in filter_urls(left, right).collect()]
    assert sorted(got, key=str) == sorted(brute(captures, entries), key=str)


def test_empty_tables(spark):
    left = spark.createDataFrame([(1, "http://a.b/c", START)], "page_id long, url string, fetched timestamp")
    right = spark.createDataFrame([], "pattern string, action string, dated timestamp")
    assert [r.decision for r in filter_urls(left, right).collect()] == ["none"]
    assert filter_urls(left.limit(0), right).count() == 0
    some = spark.createDataFrame([("a.b", "block", START)], right.schema)
    assert filter_urls(left.limit(0), some).count() == 0
    assert [r.decision for r in filter_urls(left, some).collect()] == ["block"]
