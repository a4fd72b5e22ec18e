import re

from florapipe.llm.queries import URL_RULES
from florapipe.llm.url_filter import ALLOW, BLOCK, FEATURES, Rule, filter_urls, lexical
from pyspark.sql import functions as F

LITERAL = [(ALLOW, "org", "/"), (BLOCK, "example.org", "/es/"), (BLOCK, "example.org", "/en/1"), (ALLOW, "com", "/fr/"), (BLOCK, "com", "/de/")]


def by_hand(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", None, None
    rest = url[at + 3:]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in LITERAL if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_rules_by_hand_and_trees_on_labelled_urls(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r["page_id"]: r for r in filter_urls(pages, URL_RULES).collect()}
    right = labelled = 0
    for r in pages.collect():
        host, path, rule, verdict = by_hand(r["url"])
        f = found[r["page_id"]]
        assert (f["host"], f["path"], f["rule"]) == (host, path, rule) and f["verdict"] in (ALLOW, BLOCK)
        if verdict:
            assert f["verdict"] == verdict
            labelled, right = labelled + 1, right + ((f["score"] > 0.5) == (verdict == BLOCK))
    assert right / labelled > 0.95
    again = {r["page_id"]: r["verdict"] for r in filter_urls(pages, URL_RULES).collect()}
    assert again == {i: f["verdict"] for i, f in found.items()}


def test_held_out_accuracy(spark):
    """Trees and suffix statistics from the labelled URLs of even pages alone, judged on the URLs of odd pages that no
    even page has."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").filter("url rlike 'example[.](com/(de|fr)|org)/'")
    seen = {r["url"] for r in pages.filter("page_id % 2 = 0").select("url").collect()}
    scored = filter_urls(pages, URL_RULES, train_rows=400, learn_from=F.col("page_id") % 2 == 0)
    rows = [(r["score"] > 0.5, r["verdict"] == BLOCK) for r in scored.filter("page_id % 2 = 1").collect() if r["url"] not in seen]
    assert len(rows) > 100 and sum(a == b for a, b in rows) / len(rows) > 0.9
    none = filter_urls(pages.limit(50), URL_RULES, learn_from=F.lit(False))
    assert {r["score"] for r in none.collect()} == {0.0}


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "https://A.Example.ORG", "https://A.Example.ORG/", "x://y://org/z", "http://org/?a=1&b=2#c", "HTTP://É.com/de/\n?x",
            "http://a.com/fr/" + "x" * 50_000, "http://notorg/", "http://example.org/en/1?/es/", "http://example.org/en/1?/es/"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, "http://a.org/b", "h")], "page_id bigint, url string, host string")
    found = filter_urls(df, URL_RULES).collect()
    assert len(found) == len(urls) + 1
    for r in found:
        host, path, rule, verdict = by_hand(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and (verdict is None or r["verdict"] == verdict)
    assert filter_urls(df.limit(0), URL_RULES).count() == 0
    assert {r["verdict"] for r in filter_urls(df, []).collect()} == {ALLOW}
    assert {r["verdict"] for r in filter_urls(df, [Rule(BLOCK, "org/")]).collect()} == {BLOCK}


def test_features(spark):
    df = spark.createDataFrame([("https://a-b.x.org/p/q/77.html?u=1&v=2", "a-b.x.org", "/p/q/77.html", "?u=1&v=2")], "url string, host string, path string, rest string")
    r = lexical(df).first()
    assert (r["f_depth"], r["f_parameters"], r["f_labels"], r["f_hyphens"], r["f_https"], r["f_lead"]) == (3, 2, 3, 1, 1, 7)
    assert (r["suffix"], r["folder"], r["file"]) == ("x.org", "p", "html") and abs(r["f_digits"] - 4 / 37) < 1e-9 and 3 < r["f_entropy"] < 5
    assert set(FEATURES) >= {c for c in r.asDict() if c.startswith("f_")}
