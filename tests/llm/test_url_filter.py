import duckdb
from pyspark.sql import functions as F

from basketry.llm import url_filter as uf
from conftest import SF_SMALL

URLS = ["http://a.com/", "http://COM/x", "https://www.example.com/en/1?x=//", "http://example.com/en", "http://x.example.com/en/#t",
        "http://w.www.example.com/en/2", "http://community/en/", "ftp://b.net/es/q", "http://net/fr/", "http://b.net/frx/",
        "no scheme", "", None, "://com/", "http://", "http://com", "http://com?x=/", "http://q.com:80/en/", "x://y.net/es/://com/",
        "http://www.example.com/EN/", "http://a..com/", "http://com./", "http://é.com/ü/\nz"]


def brute(url, rules, default="allow"):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def _rules(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _judged(spark, urls, rules, **kw):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r["page_id"]: tuple(r)[-4:] for r in uf.judge(pages, _rules(spark, rules), **kw).collect()}


def test_contract_rules(spark):
    got = _judged(spark, URLS, uf.RULES)
    assert got == {i: brute(u, uf.RULES) for i, u in enumerate(URLS)}


def test_nested_rules_over_many_ranges(spark):
    rules = [("com", "", "block"), ("com", "/", "allow"), ("b.com", "/a", "block"), ("b.com", "/a/b", "allow"),
             ("b.com", "/a/b/c", "block"), ("x.b.com", "/a", "allow"), ("net", "/a/b/c", "block")]
    urls = [f"http://{h}/{p}" for h in ("com", "b.com", "x.b.com", "y.x.b.com", "bb.com", "net", "z.net", "org")
            for p in ("", "a", "a/", "a/b", "a/b/", "a/b/c", "a/b/cd", "a/c", "b")] * 3
    for ranges in (1, 3, 50):
        got = _judged(spark, urls, rules, default="block", ranges=ranges)
        assert got == {i: brute(u, rules, "block") for i, u in enumerate(urls)}


def test_home_pages_of_one_domain_share_no_task(spark):
    """A third of all pages stand at the key com//: the sweep gets it ``salts``
    times at most, and the join back is dealt by (key, salt)."""
    urls = [f"http://h{i}.com/" for i in range(3000)] + [f"http://h{i}.net/es/{i % 50}" for i in range(3000)] + \
           [f"http://example.com/en/{i}" for i in range(3000)]
    assert _judged(spark, urls, uf.RULES, salts=8) == {i: brute(u, uf.RULES) for i, u in enumerate(urls)}
    pages = spark.createDataFrame([(u, 0) for u in urls], "__url string, __salt int")
    keys = uf._url_keys(pages, 3, 8)
    assert keys.where("key = 'com//'").count() == 3000
    swept = keys.select("key", "__deal").distinct()
    assert swept.where("key = 'com//'").count() == 8
    dealt = [r["count"] for r in keys.groupBy("key", "__deal").count().where("key = 'com//'").collect()]
    assert len(dealt) == 8 and max(dealt) < 2 * 3000 / 8


def test_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.com/", "x"), (1, "http://a.com/", "x"), (None, "http://b.net/es/1", None)],
                                  "page_id long, url string, verdict string").withColumn("range", F.lit(3))
    out = uf.judge(pages, _rules(spark, uf.RULES))
    assert out.columns == ["page_id", "url", "range", "host", "path", "rule", "verdict"]  # one verdict only
    assert sorted(r["verdict"] for r in out.collect()) == ["allow", "allow", "block"]
    assert uf.judge(pages.limit(0), _rules(spark, uf.RULES)).count() == 0
    assert {r["verdict"] for r in uf.judge(pages, _rules(spark, []), default="block").collect()} == {"block"}


def test_oracle(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{SF_SMALL}/pages.parquet'")
    assert sorted(map(tuple, uf.query(spark, SF_SMALL).collect()), key=repr) == sorted(duckdb.sql(uf.SQL).fetchall(), key=repr)


def test_no_python_in_the_plan(spark, capsys):
    uf.query(spark, SF_SMALL).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan
