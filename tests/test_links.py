"""B3, B4, B5, B10 on hand-made inputs."""

from pyspark.sql import functions as F

from corpusflow.operators.links import auto_batch, batch_report, filter_urls, robots_sitemaps, sitemap_locs


def test_800_pages_make_4_batches(spark):
    pages = spark.range(800).select(F.lit("https://s.example.com").alias("root"), F.col("id").alias("page_id"))
    rep = batch_report(auto_batch(pages, ["root"], ["page_id"], 200), ["root"]).collect()[0]
    assert (rep.total_pages, rep.batches, rep.batch_size) == (800, 4, 200)


def test_sitemaps(spark):
    docs = spark.createDataFrame(
        [("ok", '<?xml version="1.0"?>\n<urlset xmlns="x"><url><loc> https://a.com/1?x=1&amp;y=2 </loc></url><url><loc>https://a.com/2</loc></url></urlset>'),
         ("idx", '<sitemapindex xmlns="x"><sitemap><loc>https://a.com/s1.xml</loc></sitemap></sitemapindex>'),
         ("bad", "<urlset><url><loc> https://a.com/3 </loc><url><loc>https://a.com/4&amp;</loc>")],
        "name string, xml string",
    )
    got = {(r.name, r.pos): (r.kind, r.loc) for r in sitemap_locs(docs).collect()}
    assert got[("ok", 0)] == ("page", "https://a.com/1?x=1&y=2")
    assert got[("idx", 0)] == ("sitemap", "https://a.com/s1.xml")
    # malformed: regex fallback, values neither trimmed nor decoded
    assert got[("bad", 0)] == ("page", " https://a.com/3 ") and got[("bad", 1)] == ("page", "https://a.com/4&amp;")


def test_robots_first_working_sitemap(spark):
    robots = spark.createDataFrame([("a.com", "User-agent: *\nsitemap: https://a.com/dead.xml\r\nSITEMAP:  https://a.com/s.xml \nSitemap: https://a.com/t.xml")],
                                   "host string, robots string")
    live = spark.createDataFrame([("https://a.com/s.xml",), ("https://a.com/t.xml",)], "sitemap_url string")
    assert robots_sitemaps(robots, live).collect()[0].sitemap_url == "https://a.com/s.xml"


def test_filter_urls_order_and_rules(spark):
    urls = ["https://a.com/x", "", "https://a.com/x", "https://b.com/y", "https://a.com/doc.PDF", "https://a.com/keep?utm=1",
            "https://a.com/z", "https://a.com/w"]
    df = spark.createDataFrame([("https://a.com", i, u) for i, u in enumerate(urls)], "root string, pos int, url string")
    got = [r.url for r in filter_urls(df, exclude="utm", max_pages=2).orderBy("pos").collect()]
    assert got == ["https://a.com/x", "https://a.com/z"]
