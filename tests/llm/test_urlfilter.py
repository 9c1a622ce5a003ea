from pyspark.sql import functions as F

from cleanlane.llm import urlfilter

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]


def test_rules_then_list(frame):
    urls = {
        1: ("http://A.Example.COM/en/x?q", "a.example.com", "/en/x", "example.com/en/", "block"),
        2: ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        3: ("http://example.com", "example.com", "", None, "allow"),
        4: ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        5: ("x://a.net/es/#f", "a.net", "/es/", "net/es/", "block"),
        6: ("http://bad.org/a/?utm_source=x&b=1#t", "bad.org", "/a/", None, "block"),
        7: ("http://bad.org/a?b=2", "bad.org", "/a", None, "allow"),
        8: (None, "", "", None, "allow"),
        9: ("no scheme.com/", "", "", None, "allow"),
        10: ("", "", "", None, "allow"),
        11: ("http://É.com/a\nb", "É.com", "/a\nb", "com/", "allow"),
    }
    pages = frame([(i, u[0], "x") for i, u in urls.items()], "page_id long, url string, Host string")
    listed = frame([("https://www.BAD.org:443/a?b=1",), (None,), ("https://bad.org/a/?b=1",)], "u string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(pages, listed, RULES).collect()}
    assert got == {i: u[1:] for i, u in urls.items()}
    assert urlfilter.judge(pages.limit(0), listed, RULES).count() == 0
    assert urlfilter.judge(pages, listed.limit(0), RULES).filter("listed").count() == 0


def test_exact_with_any_number_of_blocks(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.filter("cast(substr(key, 2) as long) % 3 = 0")
    for blocks in (1, 4, 1 << 10):
        out = urlfilter.mark_listed(keys, "key", listed, max_blocks=blocks)
        assert out.count() == 3000 and out.filter("listed").count() == 1000
        assert out.filter("listed <> (cast(substr(key, 2) as long) % 3 = 0)").isEmpty()


def test_filter_lets_few_others_through(spark):
    keys = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))
    out = urlfilter.mark_possible(keys, F.col("key"), keys.filter("cast(substr(key, 2) as long) < 10000"))
    assert out.filter("possible and cast(substr(key, 2) as long) < 10000").count() == 10000
    assert out.filter("possible and cast(substr(key, 2) as long) >= 10000").count() < 200
