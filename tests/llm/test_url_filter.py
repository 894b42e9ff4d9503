"""The cascade is exact over its universe; rules by a plain walk."""

from pyspark.sql import functions as F

from veilcount.llm import url_filter as uf

PAGES = "page_id long, url string, html string"


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(sign) for sign in "/?#" if sign in rest] or [len(rest)])
    host, path = rest[:cut], rest[cut:].split("?")[0].split("#")[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for name, start, verdict in uf.RULES:
        if (host == name or host.endswith("." + name)) and path.startswith(start):
            rule = (len(name + start), len(name), name + start, verdict)
            best = max(best or rule, rule)
    own = "block" if any(term in host for term in uf.TERMS) else "allow"
    return host, path, best and best[2], best[3] if best else own


URLS = [
    "https://a.example.net/en/1?x#y", "http://example.net/en", "http://net/", "http://net", "x://a.NET/Q", "://org/fr/", "http://b.org/fr/z",
    "http://example.com/de/", "http://notexample.com/de/", "ftp://casino.example.com/de", "http://my-SPAM.org?q", None, "", "nothing", "http://",
    "http://xnet/", "http://a..net/", "http://é.example.com/de/ü", "http://example.net/en/" + "x/" * 3000, "a://b://c.net/",
]


def test_rules_and_list(spark):
    rows = [(at, url, None) for at, url in enumerate(URLS + URLS[:3])]
    found = uf.report(spark.createDataFrame(rows, PAGES).repartition(3)).collect()
    assert len(found) == len(rows)
    for row in found:
        assert (row.host, row.path, row.rule, row.verdict) == plain(rows[row.page_id][1])


def test_cascade_is_exact(spark):
    universe = spark.range(30_000).select(F.concat(F.lit("key"), F.col("id").cast("string")).alias("key"), "id")
    listed = universe.where("id % 7 = 0").select("key").union(spark.createDataFrame([("elsewhere",), (None,)], "key string"))
    levels = uf.build_cascade(listed, universe)
    assert len(levels) > 1
    wrong = universe.where(uf.is_listed(levels, F.col("key")) != (F.col("id") % 7 == 0))
    assert wrong.count() == 0


def test_empty_tables_and_other_columns(spark):
    none = spark.createDataFrame([], PAGES)
    assert uf.report(none).collect() == []
    pages = spark.createDataFrame([(1, "http://a.net/", "old", 5)], "page_id long, url string, verdict string, key long")
    found = uf.filter_urls(pages, spark.createDataFrame([], "key string")).first()
    assert (found.verdict, found.key, found.rule) == ("block", 5, "net/")
