"""What the queries over the web of the lines make once, read at all, or sort."""

import pytest

from prospectra.functions import text
from prospectra.operators import graph
from prospectra.plans import service
from prospectra.sources import sitemaps

from .conftest import SF

TAILS = ["", "/", "//", "/a", "/a/", "/a//", "/a#", "/a#b", "/a#b#c?d", "/a?", "/a?x=1", "/a?ref=1&x=2#y", "/a b", "/a&amp;b", "/é", "/a#é", ":80/a", "/a:b@c/~d", "/a\n", "/a#b\n", "/(a)[b]{c}|d"]


def test_plain_addresses_are_normalised_as_others(spark):
    """an address that is normal as it stands is not taken apart; one with an upper-case scheme is, to the same."""
    df = spark.createDataFrame([(f"https://h.example{x}", f"HTTPS://h.example{x}") for x in TAILS], "a string, b string")
    for keep in (True, False):
        rows = df.select("a", text.normalize_url("a", keep).alias("x"), text.normalize_url("b", keep).alias("y")).collect()
        assert [r.a for r in rows if r.x != r.y] == [] and all(r.x for r in rows)


def test_a_text_is_made_once(spark):
    """what keywords are looked for in was made again for each of them."""
    plan = spark.createDataFrame([("https://h.example/x",)], "u string").select(text.url_score("u").alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1


@pytest.mark.parametrize(("depth", "most"), [(1, 1), (2, 4), (3, 7)])
def test_only_pages_that_can_be_entered_are_read(spark, monkeypatch, depth, most):
    """a chain of 300 pages from the front page, and a seed in its midst; all pages' links were read."""
    rows = [("https://h.example/", '<a href="/p0">x</a>')] + [(f"https://h.example/p{k}", f'<a href="/p{k + 1}">x</a>') for k in range(300)]
    seeds = [("https://h.example", 0, -1, 0), ("https://h.example/p100", 1, 1, 1), ("https://h.example/p102", 2, 1, 2)]
    read, ranked = [], graph.ranked_links
    monkeypatch.setattr(graph, "ranked_links", lambda pages, *more: read.append(pages.count()) or ranked(pages, *more))
    found = graph.frontier(spark.createDataFrame(rows, "url string, html string"), spark.createDataFrame(seeds, "url string, depth int, score int, ord int"), 25, depth).collect()
    assert sum(read) <= most
    assert {(r.url, r.ok) for r in found} >= {(f"https://h.example/{p}", True) for p in ("p0", "p100", "p102", *(["p101"] if depth > 1 else []))}


def test_web_is_found_once(spark):
    """the lines were sorted twice for their links, for the pages and for the front pages, each time that pages were read."""
    assert "Window" not in service.web_coverage(spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_files_are_joined_by_row(spark):
    """levels of sitemaps are joined with files' rows, whose addresses come out once, after the last level."""
    sites = spark.createDataFrame([("https://h.example/",)], "url string")
    robots = spark.createDataFrame([], "url string, body string")
    urls = "".join(f"<url><loc>https://h.example/events/{k}</loc></url>" for k in range(50))
    maps = [("https://h.example/sitemap.xml", "<sitemapindex><sitemap><loc>https://h.example/m.xml</loc></sitemap></sitemapindex>"), ("https://h.example/m.xml", f"<urlset>{urls}</urlset>"), ("https://h.example/none.xml", None)]
    df = sitemaps.discover_seeds(sites, robots, spark.createDataFrame(maps, "url string, xml string"))
    assert df.where("url like '%/events/%'").count() == 50
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode(page") == 1 and "min(struct(" not in plan
