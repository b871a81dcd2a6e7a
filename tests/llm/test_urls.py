import datetime as dt
import random

import duckdb

from cadence.llm import urls

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def keys(url):
    import re

    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    if not m:
        return "", []
    host = m[1].lower()
    p = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", url)
    segments = [s for s in p[1].split("/") if s] if p else []
    labels = host.split(".")
    out = [("prefix", host + "/" + "/".join(segments[:i])) for i in range(len(segments), 0, -1)]
    return host, out + [("host", host)] + [("domain", ".".join(labels[i:])) for i in range(len(labels))]


def verdict(url, fetched, entries):
    host, asked = keys(url)
    for k in asked if fetched is not None else []:
        dated = [(d, urls.ACTIONS.index(a), a) for kind, key, a, d in entries if (kind, key) == k and d is not None and d <= fetched and a in urls.ACTIONS]
        if dated and max(dated)[2] != "remove":
            return host, max(dated)[2], *k, max(dated)[0]
    return host, "unlisted", None, None, None


CAPTURES, ENTRIES = "page_id long, url string, fetched date", "kind string, key string, action string, effective_from date"


def test_random_lists_match_brute_force(spark):
    rng = random.Random(4)
    hosts = ["a.org", "b.a.org", "WWW.b.a.org", "c.net"]
    pages = [(i, f"http://{rng.choice(hosts)}{rng.choice([':80', ''])}{rng.choice(['', '/', '/x', '/x/y?q=1', '//x#f'])}", day(rng.randrange(400))) for i in range(400)]
    pages += [(1, None, day(3)), (2, "no url", day(3)), (3, "http://a.org/x", None), (None, "http://a.org/x", day(100)), (4, pages[0][1], pages[0][2])]
    names = [("domain", "a.org"), ("domain", "org"), ("host", "b.a.org"), ("prefix", "a.org/x"), ("prefix", "www.b.a.org/x/y"), ("host", "c.net")]
    entries = [(*rng.choice(names), rng.choice(urls.ACTIONS), day(rng.randrange(420))) for _ in range(60)]
    entries += [entries[0], (None, "a.org", "block", day(1)), ("host", None, "block", day(1)), ("host", "c.net", "odd", day(1)), ("host", "c.net", "block", None)]
    got = urls.filter_urls(spark.createDataFrame([(*p, 1) for p in pages], CAPTURES + ", period int"), spark.createDataFrame(entries, ENTRIES)).collect()
    want = sorted([(i, u, f, *verdict(u, f, entries)) for i, u, f in pages], key=str)
    assert sorted([tuple(r) for r in got], key=str) == want
    assert {w[4] for w in want} == {"block", "allow", "unlisted"}


def test_intervals(spark):
    entries = [("host", "h", "block", day(5)), ("host", "h", "remove", day(9)), ("host", "h", "allow", day(9)), ("host", "h", "remove", day(20))]
    got = sorted(tuple(r) for r in urls.validity_intervals(spark.createDataFrame(entries, ENTRIES)).collect())
    assert got == [("host", "h", day(5), "block", day(9)), ("host", "h", day(9), "allow", day(20))]


def test_empty_tables(spark):
    pages, entries = spark.createDataFrame([(1, "http://a.org", DAY)], CAPTURES), spark.createDataFrame([("host", "a.org", "block", DAY)], ENTRIES)
    assert urls.filter_urls(pages.limit(0), entries).collect() == []
    assert [r.verdict for r in urls.filter_urls(pages, entries.limit(0)).collect()] == ["unlisted"]


def test_query_matches_its_oracle(spark):
    path = "/root/testdata/sf0.01/pages.parquet"
    pages = spark.read.parquet(path)
    got = sorted((tuple(r) for r in urls.filter_urls(urls.captures_of(pages), urls.list_from(pages)).collect()), key=str)
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{path}'")
    cols = "page_id, url, fetched, host, verdict, entry_kind, entry_key, valid_from"
    assert sorted(con.execute(f"select {cols} from ({urls.ORACLE_SQL})").fetchall(), key=str) == got
