from pyspark.sql import functions as F

from prospectra.operators import collect
from prospectra.sources import schemas


def test_schemas_round_trip(spark, tmp_path):
    schemas.create(spark, str(tmp_path / "t"))
    for name in schemas.SCHEMAS:
        assert schemas.read(spark, str(tmp_path / "t"), name).count() == 0


def test_links_and_unions(spark):
    rows = [("s", f"https://s.example/{p}", "") for p in ("contact", "contact", "zz", "events", "a.pdf", "x.css")]
    got = collect.ranked_links(spark.createDataFrame(rows, "site string, url string, anchor string"), 2).orderBy("kind", "rank").collect()
    assert [(r.kind, r.url[18:]) for r in got] == [("page", "events"), ("page", "contact"), ("pdf", "a.pdf")]
    part = lambda *r: spark.createDataFrame(r, "name string, pos int")
    both = collect.union_distinct(part(("a", 1), ("b", 2), ("a", 3)), part(("c", 1), ("b", 1)), key="name", order="pos")
    assert {(r.name, r.pos) for r in both.collect()} == {("a", 1), ("b", 2), ("c", 1)}
    names = collect.all_names(part(("B ", 1), ("a", 2)), part(("b", 1)).withColumnRenamed("name", "venue_name"))
    assert [r.name for r in names.collect()] == ["a", "b"]


def test_precedence_and_forms(spark):
    rows = [("v", "fb", "crawl", "u2"), ("v", "fb", "homepage", "u1"), ("v", "ig", "search", "u3"), ("v", "ig", "odd", "u0")]
    got = {r.platform: r.url for r in collect.by_precedence(spark.createDataFrame(rows, "venue_id string, platform string, source string, url string")).collect()}
    assert got == {"fb": "u1", "ig": "u3"}
    urls = spark.createDataFrame([("https://a.example/contact", False), ("https://a.example/x", True), ("https://a.example/x", False)], "url string, f boolean")
    assert [r[0] for r in urls.select(collect.form_kept("url", F.col("f"))).collect()] == [True, True, False]


def test_mailboxes_and_reservations(spark):
    pages = spark.createDataFrame([("ann@group.example info@site.example jobs@group.example", "group.example", "site.example"), ("ann@site.example", "site.example", "site.example")], "html string, v string, s string")
    assert [r[0] for r in pages.select(collect.other_domain_mailboxes("html", "v", "s")).collect()] == [["ann@group.example"], []]
    fetched = spark.createDataFrame([("https://s.example/contact", "ann@s.example.org"), ("https://s.example/team", "ann@s.example.org bo@s.example.org"), ("https://s.example/zz", "no@s.example.org")], "url string, html string")
    sites = spark.createDataFrame([("v", "https://www.s.example/")], "venue_id string, website string")
    assert {(r.email, r.n_sources) for r in collect.swept_mailboxes(fetched, sites, ("/contact",)).collect()} == {("ann@s.example.org", 2), ("bo@s.example.org", 1)}
    held = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:04:00")], "email string, t string").withColumn("reserved_at", F.col("t").cast("timestamp"))
    assert [r.email for r in collect.live_reservations(held, "2024-01-01 00:06:00").collect()] == ["b"]
    tries = spark.createDataFrame([("r", k, k == 2) for k in range(9)], "run string, k int, hit boolean")
    assert [r.k for r in collect.misses_in_a_row(tries, "run", "k", "hit", 3).orderBy("k").collect()] == [0, 1, 2, 3, 4, 5]
