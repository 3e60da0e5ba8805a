import random

from hammerline.llm import url_cascade as U


def test_cascade_is_exact_over_its_universe(spark):
    random.seed(2)
    names = [f"{random.randrange(10**9)}.example.org" for _ in range(3000)]
    listed, universe = names[:400], names
    make = lambda keys: spark.createDataFrame([(k,) for k in keys], "key string").distinct()
    cascade = U.build_cascade(make(listed), make(universe))
    assert len(cascade.levels) > 1
    from pyspark.sql import functions as F

    got = {r["key"] for r in make(universe).filter(cascade.contains(F.col("key"))).collect()}
    assert got == set(listed)
    split = U.build_cascades(make(listed), make(universe), max_filter_bytes=400)
    assert len(split) > 1
    assert {r["key"] for r in make(universe).filter(U.in_any(split, F.col("key"))).collect()} == set(listed)


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    hits = []
    for rule, verdict in U.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            hits.append((len(rule), rule, verdict))
    if hits:
        return host, path, max(hits)[1], max(hits)[2]
    listed = any(host == h or host.endswith("." + h) for h in U.LISTED_HOSTS)
    return host, path, None, "block" if listed else "allow"


def test_odd_urls(spark):
    urls = [
        None, "", "nothing", "://", "http://", "http://A.Example.NET/en/x?y#z", "https://example.net/en", "https://net/", "https://notnet/",
        "http://x.example.com/de/1", "http://org/fr/", "http://www.spam-farm.example.org/en/1", "http://www.spam-farm.example.org/fr/1",
        "ftp://a://b/c", "http://É.NET/x", "http://" + "a." * 500 + "net/", "http://x.net?q", "http://x.net#f/", "http://.net/",
    ]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, verdict string").drop("verdict")
    rows = U.filter_urls(pages).collect()
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows} == dict(enumerate(map(brute, urls)))
    assert U.filter_urls(pages.limit(0)).count() == 0
    assert U.filter_urls(pages, rules=(), listed_hosts=()).filter("verdict = 'allow'").count() == len(urls)
