"""URL rules against a plain longest-match search."""

import random

from newsloom.llm import url_filter as op


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
        path = rest[:end]
    fits = [(len(h + p), v == "block", len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "https://EXAMPLE.com/en/1?x=1#y", "https://www.example.com/en/", "https://a.b.www.example.com/en/x/",
    "http://example.com/en", "http://x.net/es/1", "http://x.net/fr/", "http://net/es/", "http://xnet/es/", "http://é.com/É", "x://a.com?en/",
    "http://a..com/en/", "http://.com/", "http://user@x.com:80/en/", "http://com", "http://com/", "a://b://c.com/", "http://a.com#/x", "http://a.com/\n/z",
]


def test_contract_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS + URLS[:3])], "page_id long, url string, rule string")
    rules = spark.createDataFrame(op.RULES, "verdict string, host string, path string")
    for r in op.judge(pages, rules).collect():
        assert (r.host, r.path, r.rule, r.verdict) == plain(r.url, op.RULES), r.url


def test_many_rules_need_several_levels(spark, monkeypatch):
    monkeypatch.setattr(op, "BITS_PER_KEY", 1)
    rnd = random.Random(5)
    hosts = [f"{rnd.choice('abc')}{i % 60}.{rnd.choice(['com', 'net', 'org'])}" for i in range(600)]
    rules = list({(rnd.choice(["allow", "block"]), h.split(".", rnd.choice([0, 1]))[-1], rnd.choice(["/", "/en/", "", "/e"])) for h in rnd.sample(hosts, 150)})
    urls = [f"http://{rnd.choice(['', 'www.'])}{rnd.choice(hosts)}{rnd.choice(['/', '/en/x', '/ex', ''])}" for _ in range(600)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    given = spark.createDataFrame(rules, "verdict string, host string, path string")
    for r in op.judge(pages, given).collect():
        assert (r.rule, r.verdict) == plain(r.url, rules)[2:], r.url
    universe = spark.createDataFrame([(h,) for h in set(hosts)], "key string")
    listed = universe.orderBy("key").limit(40)
    cascade = op.build(listed, universe)
    assert len(cascade.levels) > 2
    got = {r.key for r in universe.where(cascade.lists(universe["key"])).collect()}
    assert got == {r.key for r in listed.collect()}


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(op.RULES, "verdict string, host string, path string")
    assert op.judge(pages, rules).count() == 0
    some = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert op.judge(some, rules.limit(0)).first().verdict == "allow"
