from pyspark.sql import functions as F

from callcast.llm import url_filter as U

URLS = [
    (1, "https://www.Example.ORG/es/5?x#y"),
    (2, "http://a.b.example.org/en/17"),
    (3, "http://notexample.org/en/17"),
    (4, None),
    (5, "no scheme"),
    (6, ""),
    (7, "ftp://bad.net"),
    (8, "http://m.bad.net/index.html"),
    (9, "http://bad.net/other"),
    (10, "x://org"),
    (11, "http://ÀB.org/"),
    (12, "http://shop.com/fr/x"),
    (13, "http://h.net?u=http://b.org/"),
    (9, "http://bad.net/other"),
]
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def frame(spark):
    return spark.createDataFrame(URLS, "page_id long, url string")


def test_parts_rules_and_list(spark):
    listed = spark.createDataFrame([("http://www.bad.net/",), ("https://shop.com/fr/x.html",), (None,), ("http://www.bad.net/",)], "url string")
    rows = U.judge(frame(spark), "url", listed, RULES).collect()
    assert len(rows) == len(URLS)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.listed) for r in rows}
    assert got[1] == ("www.example.org", "/es/5", "example.org/es/", "block", False)
    assert got[2] == ("a.b.example.org", "/en/17", "example.org/en/1", "block", False)
    assert got[3] == ("notexample.org", "/en/17", "org/", "allow", False)
    for p in (4, 5, 6):
        assert got[p] == ("", "", None, "allow", False)
    assert got[7] == ("bad.net", "", None, "block", True)
    assert got[8] == ("m.bad.net", "/index.html", None, "block", True)
    assert got[9] == ("bad.net", "/other", None, "allow", False)
    assert got[10] == ("org", "", None, "allow", False)
    assert got[11][0] == "Àb.org"  # only A-Z are lower-cased
    assert got[12] == ("shop.com", "/fr/x", "com/fr/", "allow", True)
    assert got[13] == ("h.net", "", None, "allow", False)


def test_filter_has_no_false_negative_and_a_bounded_size(spark):
    urls = spark.range(5000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.col("id") % 50, F.lit(".net/p"), F.col("id")).alias("url"))
    listed = urls.where("page_id % 3 = 0").select("url")
    for blocks in (1, 64, U.BLOCKS):
        assert U.bloom(listed, "url", blocks).count() <= blocks
        out = U.listed_flag(urls, "url", listed, blocks)
        assert out.count() == 5000 and out.where("listed <> (page_id % 3 = 0)").count() == 0


def test_empty_tables_and_clashing_names(spark):
    pages = frame(spark).withColumns({"Host": F.lit("x"), "verdict": F.lit(1)})
    out = U.judge(pages, "url", spark.createDataFrame([], "url string"), RULES)
    assert out.count() == len(URLS) and out.columns.count("verdict") == 1 and out.where("listed").count() == 0
    assert U.judge(pages.limit(0), "url", frame(spark).select("url"), RULES).count() == 0
