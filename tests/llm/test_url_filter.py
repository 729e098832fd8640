"""URL filter against brute force over all rules, also with the Bloom filter as a table."""

import random
import re

from pyspark.sql import functions as F

from tablekit.llm import url_filter as U

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.b.example.org", "/x", "block"), ("example.com", "/de/ok", "allow")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]


def brute(url, listed):
    host, path = parts(url)
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, *max(fits)[1:]
    canon = host.removeprefix("www.") if host.startswith("www.") else host.removeprefix("m.")
    p = path[:-5] if path.endswith(".html") else path[:-1] if path.endswith("/") else path
    return host, path, None, "block" if canon + p in listed and canon + p else "allow"


def urls():
    rnd = random.Random(2)
    out = [None, "", "no scheme", "http://", "://net", "HTTP://WWW.EXAMPLE.NET/EN/", "http://example.net/en/", "http://net/x", "http://evilnet/x",
           "http://x.org/fr/1?u=http://net/", "http://a.b.example.org/xyz", "http://example.com/de/ok/1", "http://example.com#/de/", "http://É.Net/"]
    for _ in range(200):
        host = ".".join(rnd.choice(["www", "m", "example", "net", "com", "org", "b", "a"]) for _ in range(rnd.randint(1, 4)))
        out.append(f"https://{host}/{rnd.choice(['en', 'de', 'fr', 'x', ''])}/{rnd.randint(1, 9)}{rnd.choice(['', '.html', '/', '?q=1', '#f'])}")
    return out + out[:20]


def test_equals_brute_force(spark, monkeypatch):
    rows = list(enumerate(urls()))
    listed = {"example.com/x/1", "b.com/en/2", "com/x/3", ""}
    frame = spark.createDataFrame([(*r, "own") for r in rows], "page_id int, url string, rank string")
    rules = spark.createDataFrame(RULES, "rule_host string, rule_path string, verdict string")
    known = spark.createDataFrame([(x,) for x in listed] + [(None,)], "canonical string")
    want = {i: brute(u, listed) for i, u in rows}
    for bound in (U.MAX_BLOOM_KEYS, 0):
        whole = U.possible_hits
        monkeypatch.setattr(U, "possible_hits", lambda *a, b=bound: whole(*a, max_bloom_keys=b))
        got = U.judge_urls(frame, rules, known).collect()
        assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == want and len(got) == len(rows)
        assert all(r["rank"] == "own" for r in got)
        monkeypatch.setattr(U, "possible_hits", whole)


def test_bloom_loses_no_key_and_drops_most_others(spark):
    listed = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"))
    asked = spark.range(6000).select(F.concat(F.lit("k"), "id").alias("q"), "id")
    for bound in (10**6, 0):
        hits = {r["id"] for r in U.possible_hits(asked, "q", listed, "k", bound).collect()}
        assert hits >= set(range(3000)) and len(hits) < 3600


def test_empty_tables(spark):
    rules = spark.createDataFrame([], "rule_host string, rule_path string, verdict string")
    known = spark.createDataFrame([], "canonical string")
    pages = spark.createDataFrame([("http://net/",), (None,)], "url string")
    assert [(r["host"], r["rule"], r["verdict"]) for r in U.judge_urls(pages, rules, known).orderBy("host").collect()] == [
        ("", None, "allow"), ("net", None, "allow")]
    assert U.judge_urls(pages.limit(0), rules, known).count() == 0


def test_the_list_tells_urls_of_one_host_apart(spark):
    pages = spark.range(4000).select(F.concat(F.lit("https://www.shop.info/item/"), "id", F.lit(".html?x=1")).alias("url"), "id")
    known = spark.range(0, 4000, 3).select(F.concat(F.lit("shop.info/item/"), "id").alias("canonical"))
    rules = spark.createDataFrame(RULES, "rule_host string, rule_path string, verdict string")
    got = {r["id"]: r["verdict"] for r in U.judge_urls(pages, rules, known).collect()}
    assert got == {i: "block" if i % 3 == 0 else "allow" for i in range(4000)}


def test_a_long_list_is_planned_at_once(spark):
    """A million keys: the filter is a value of the plan, not a million literals."""
    import time
    known = spark.range(1_000_000).select(F.concat(F.lit("k"), "id").alias("k"))
    asked = spark.range(100).select(F.concat(F.lit("k"), F.col("id") * 20_000).alias("q"))
    frame = U.possible_hits(asked, "q", known, "k", max_bloom_keys=2_000_000)
    t0 = time.perf_counter()
    frame.explain()
    assert time.perf_counter() - t0 < 2
    assert frame.where("q <> ''").count() >= 50


def test_words_of_spam_hosts_stand_alone():
    from tablekit.llm.queries import SPAM_HOST
    for host in ("free-bets.example.com", "www.spam-farm.example.com", "m.casino-win.com", "cheap-pills.org", "pill.com", "bet.net"):
        assert re.search(SPAM_HOST, host), host
    for host in ("alphabets.example.com", "antispamlab.org", "pillow-shop.com", "example.com", "beta.net", ""):
        assert not re.search(SPAM_HOST, host), host
