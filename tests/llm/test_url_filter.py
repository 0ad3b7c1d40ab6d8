"""URL rules against plain Python."""
import re

from pyspark.sql import functions as F

from salesmart.llm import url_filter as u
from salesmart.llm.queries import URL_RULES


def brute(url, rules, default="allow"):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m.group(1).translate({c: c + 32 for c in range(65, 91)}), m.group(2)) if m else ("", "")
    fit = [(len(h) + len(p), len(h), h + p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


URLS = [None, "", "example.org/es/", "http://a.example.org/es/1?x#y", "HTTPS://WWW.Example.ORG/en/148.html", "http://example.org",
        "http://org/", "http://myorg/", "http://x.com/fr/2", "http://x.com/de/2#a", "http://x.com?/de/", "://", "http://example.org/EN/1",
        "http://badexample.org/es/1", "http://x.com/fr", "http://É.com/fr/\nzz", "a://b://com/fr/", "http://" + "a." * 300 + "com/de/" + "x" * 5000]


def test_rules_match_brute_force(spark):
    df = spark.createDataFrame([(i, x, "old", 1) for i, x in enumerate(URLS)] + [(3, URLS[3], "old", 1)],
                               "page_id long, url string, host string, s int")
    out = u.judge(df, u.rule_table(spark, URL_RULES))
    assert sorted(out.columns) == sorted(["page_id", "url", "host", "s", "path", "rule", "verdict"])
    got = sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in out.collect())
    want = sorted((i, *(x if x is not None else "" for x in brute(t, URL_RULES))) for i, t in [*enumerate(URLS), (3, URLS[3])])
    assert got == want


def test_rule_edges(spark):
    df = spark.createDataFrame([(1, "http://a.b.c/x/y"), (2, None)], "page_id long, url string")
    empty = u.judge(df, u.rule_table(spark, []))
    assert {(r.page_id, r.rule, r.verdict) for r in empty.collect()} == {(1, None, "allow"), (2, None, "allow")}
    both = u.rule_table(spark, [("allow", "b.c", "/x"), ("block", "b.c", "/x"), ("block", None, "/"), (None, "c", "/")])
    assert {(r.page_id, r.verdict) for r in u.judge(df, both).collect()} == {(1, "block"), (2, "allow")}
    assert u.judge(df.limit(0), both).count() == 0


def test_hot_urls_meet_their_verdict_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(u, "HOT_ROWS", 3)
    monkeypatch.setattr(u, "HOT_CHARS", 40)
    # a fitted, an unfitted, a null and an overlong URL with many rows, and the rest
    many = ["http://a.example.org/es/1", "http://x.net/", None, "http://x.com/de/" + "y" * 50]
    urls = [t for t in many for _ in range(20)] + URLS
    df = spark.createDataFrame([(i, t) for i, t in enumerate(urls)], "page_id long, url string")
    out = u.judge(df.select("page_id", "url", F.lit("same").alias("x"), F.lit("name").alias("x")), u.rule_table(spark, URL_RULES))
    assert out.columns.count("x") == 2
    got = sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in out.select("page_id", "host", "path", "rule", "verdict").collect())
    assert got == sorted((i, *(x if x is not None else "" for x in brute(t, URL_RULES))) for i, t in enumerate(urls))
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "Union" in plan


def test_query_matches_its_sql(spark):
    import duckdb

    from salesmart.llm.queries import ORACLE, QUERIES
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    cols = "page_id, host, path, rule, verdict"
    want = sorted(con.execute(f"SELECT {cols} FROM ({ORACLE['op3_url_filter']})").fetchall(), key=repr)
    got = sorted((tuple(r) for r in QUERIES["op3_url_filter"](spark, sf).select(*cols.split(", ")).collect()), key=repr)
    assert got == want
