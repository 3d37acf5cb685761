import json

import pytest
from pyspark.sql import functions as F

from prospectra.operators import reports, screening
from prospectra.plans import actions
from prospectra.plans.queries import contacts, gigs, outreach, venues
from prospectra.sources import files, pdf

from .conftest import SF


def one(spark, column, value, schema="x string"):
    return spark.createDataFrame([value if isinstance(value, tuple) else (value,)], schema).select(column).first()[0]


def test_dump_and_sinks(spark, tmp_path):
    (tmp_path / "dump.json").write_text(json.dumps({"status": "ok", "venues": [{"venue_id": "a", "upscale_score": 4}, {"venue_id": "b", "extra": 1}]}, indent=1))
    rows = files.read_dump(spark, str(tmp_path / "dump.json"), "venues")
    assert [(r.venue_id, r.upscale_score) for r in rows.collect()] == [("a", 4.0), ("b", None)]
    for _ in range(2):
        files.write_rows(rows, str(tmp_path / "out"), append=True)
    assert spark.read.json(str(tmp_path / "out")).count() == 4
    files.write_issues(rows.select("venue_id"), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    (tmp_path / "done.txt").write_text("A b\n\n a B \nc\n")
    assert {r.item for r in files.read_list(spark, str(tmp_path / "done.txt")).collect()} == {"a b", "c"}


def test_sitemaps(spark):
    maps = [("https://s.example.org/sitemap.xml", "<sitemapindex><sitemap><loc>https://s.example.org/b.xml</loc></sitemap></sitemapindex>"), ("https://s.example.org/b.xml", "<urlset><url><loc> https://s.example.org/events?a=1&amp;b=2 </loc></url><url><loc>https://s.example.org/x</loc>")]
    pages = spark.createDataFrame([("https://s.example.org/", "")], "url string, html string")
    got = {r.url: r.score for r in files.site_seeds(pages, spark.createDataFrame(maps, "url string, xml string")).collect()}
    assert got == {"https://s.example.org/events?a=1&b=2": 3, "https://s.example.org/x": 34}
    assert one(spark, files.robots_sitemaps("x"), "User-agent: *\nSitemap: https://a.example/s.xml\nsitemap:https://b.example/t.xml") == ["https://a.example/s.xml", "https://b.example/t.xml"]


def test_documents_and_cards(spark):
    import zlib

    raw = b"%PDF\nstream\n" + zlib.compress(b"BT (mail ann@v.example.org) Tj ET") + b"\nendstream"
    rows = spark.createDataFrame([("a", bytearray(raw)), ("b", bytearray(b"raw bob@v.example.org")), ("c", None)], "path string, content binary")
    assert {r.path: r.text for r in pdf.pdf_texts(rows).collect()} == {"a": "mail ann@v.example.org", "b": "raw bob@v.example.org", "c": ""}
    card = files.cards(spark.createDataFrame([("Oak", "4.6 (2,001) $$ 1 Main St, Easton, MD")], "name string, text string")).first()
    assert (card.rating, card.reviews, card.price, card.place.city, card.place.state) == (4.6, 2001, 2, "Easton", "MD")
    assert one(spark, files.attributes("x"), (["Fireplace ", "fireplace", "ok", "Photos of it", "x" * 50],), "x array<string>") == ["fireplace"]
    assert one(spark, files.first_external("h", "p"), ('<a href="/a">a</a><a href="https://www.s.example.org/b">b</a><a href="https://o.example.org/">o</a>', "https://s.example.org/"), "h string, p string") == "https://o.example.org/"
    assert one(spark, files.snippet_emails("x"), "info@a.example.org ann@a.example.org") == ["ann@a.example.org"]
    page = one(spark, files.directory_page("x"), '<title>Oak | List</title><address>1 Main</address><a href="https://oak.example.org">Visit website</a> https://facebook.com/oak.inn')
    assert (page.name, page.address, page.website, page.socials) == ("Oak", "1 Main", "https://oak.example.org", ["https://www.facebook.com/oak.inn/"])
    links = one(spark, files.listing_links("h", "p", ("^/venue/", "^/place/")), ('<a href="/venue/b/?x=1"></a><a href="/venue/b"></a><a href="/place/a/"></a><a href="/no"></a>', "https://s.example.org/"), "h string, p string")
    assert links == ["https://s.example.org/place/a/", "https://s.example.org/venue/b/"]
    urls = spark.createDataFrame([("q", k, u) for k, u in enumerate(["https://a.example/1", "https://a.example/2", "https://skip.example/", *(f"https://h{j}.example/" for j in range(9))])], "query string, place int, url string")
    got = [r.url for r in files.candidate_urls(urls, F.col("host") == "skip.example").orderBy("place").collect()]
    assert got == ["https://a.example/1", *(f"https://h{j}.example/" for j in range(4))]


def test_screens(spark):
    pair = "a string, b string"
    assert one(spark, screening.near_state("a", "b"), ("Baltimore, Maryland", "DC"), pair) is True
    assert one(spark, screening.near_state("a", "b"), ("Austin, Texas", "DC"), pair) is False
    assert one(spark, screening.near_state("a", "b"), ("Austin, Texas", ""), pair) is True
    reject = lambda u, k: one(spark, screening.social_reject("x", k), u)
    assert [reject(u, "facebook") for u in ("https://facebook.com/", "https://www.facebook.com/tr", "https://facebook.com/Wix/", "https://facebook.com/12345", "https://x.example/", "https://facebook.com/oak")] == ["bare", "junk", "template", "numeric", "other platform", None]
    assert reject("https://instagram.com/p/", "instagram") == "junk"
    flags = one(spark, screening.mailbox_flags("a", "b"), ("Info@other.example", "venue.example"), pair)
    assert (flags.hard_reject, flags.generic, flags.off_domain) == (False, True, True)
    assert not one(spark, screening.mailbox_flags("a", "b"), ("ann@gmail.com", "venue.example"), pair).off_domain
    assert one(spark, screening.other_location("a", "b"), ("https://s.example/locations/reston-va/", "easton-md"), pair) is True
    assert one(spark, screening.other_location("a", "b"), ("https://s.example/locations/easton-md/", "easton-md"), pair) is False
    assert one(spark, screening.asset_path("x"), "https://s.example/a.PNG?x") is True
    assert one(spark, screening.title_route("x", F.lit(False)), "General Manager") == "pending"
    assert one(spark, screening.social_evidence("a", "b", F.lit("https://oak.example/")), ("https://facebook.com/oakroom/", "The Grand"), pair) is True
    orgs = spark.createDataFrame([("v", "1", "Hilton Worldwide", 1, 60), ("v", "2", "Oak Inn", 2, 15), ("v", "2", "Oak Inn", 3, 15), ("w", "3", "Accor", 1, 5)], "venue_id string, org_id string, org_name string, phase int, score int")
    assert {r.venue_id: r.org_id for r in screening.best_org(orgs).collect()} == {"v": "2", "w": "3"}
    sites = spark.createDataFrame([("v", "La Ferme", "https://other.example/", 1), ("v", "La Ferme", "https://laferme.example/", 2), ("w", "Quiet", "https://x.example/", 1)], "venue_id string, name string, url string, place int")
    assert [(r.venue_id, r.url) for r in screening.best_website(sites).collect()] == [("v", "https://laferme.example/")]
    pages = spark.createDataFrame([("https://s.example/menu/easton",), ("https://s.example/locations/easton/",), ("https://o.example/easton",)], "url string")
    v = spark.createDataFrame([("v", "https://www.s.example", "Easton")], "venue_id string, website string, city string")
    assert screening.location_pages(pages, v).first().url == "https://s.example/locations/easton/"
    assert {r.url for r in screening.probes(pages.select("url"), spark.createDataFrame([("https://o.example/",)], "site string"), ("/easton", "/about")).collect()} == {"https://o.example/easton"}


def test_reports(spark):
    line = one(spark, reports.log_contact("x"), "10:00:00 Added (Owner): Ann Lee <ann@v.example> catch-all")
    assert (line.name, line.email, line.status) == ("Ann Lee", "ann@v.example", "catch-all")
    assert one(spark, reports.log_flags("x"), "[WARN] No website") == ["warning", "no site"]
    times = "a string, b string"
    assert one(spark, reports.runtime_minutes("a", "b"), ("23:50:00", "00:10:30"), times) == 20
    assert one(spark, reports.runtime_minutes("a", "b", "ref"), ("23:50:00", "00:10:30"), times) < 0
    lines = spark.createDataFrame([("l", k, t) for k, t in enumerate(["Ann", "* marker", "Owner", "Bo", "* marker", "Chef"])], "log string, n int, line string")
    assert [(r.name, r.title) for r in reports.paired(lines, "log", "n", "line", r"^\* ").orderBy("n").collect()] == [("Ann", "Owner"), ("Bo", "Chef")]
    old = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-02-01")], "file string, date string")
    assert [r.file for r in reports.manifest(old, spark.createDataFrame([("c", "2024-03-01")], "file string, date string")).orderBy("place").collect()] == ["c", "b", "a"]
    assert [r.file for r in reports.retained(old, "2024-02-20").collect()] == ["b"]


@pytest.fixture(scope="module")
def tables(spark):
    config = spark.createDataFrame([("Skip_Words", "a,b", 1), ("skip_words", "later", 2)], "key string, value string, _ord long")
    templates = spark.createDataFrame([("Winery", "s1", "b1", 1), ("winery", "s2", "b2", 2)], "category string, subject string, body string, _ord long")
    taste = spark.createDataFrame([("tier", "winery", "1")], "type string, key string, value string")
    distances = spark.createDataFrame([("V-0", 12.0)], "venue_id string, miles double")
    return {"venues": venues(spark, SF), "contacts": contacts(spark, SF), "outreach": outreach(spark, SF), "gigs": gigs(spark, SF), "config": config, "templates": templates, "taste": taste, "distances": distances}


def test_every_action_runs(spark, tables):
    contact = tables["contacts"].limit(1)
    parameters = {
        "update_venue": {"venue_id": "V-1", "field": "Facebook", "value": "https://www.facebook.com/blueridge"},
        "update_contact": {"contact_id": "C-1", "field": "title", "value": "Owner"},
        "update_contact_email": {"rows": contact},
        "log_outreach": {"rows": tables["outreach"].limit(1)},
        "add_venue": {"rows": tables["venues"].limit(3)},
        "add_contact": {"rows": contact},
        "add_gig": {"rows": tables["gigs"].limit(1)},
        "update_gig": {"rows": tables["gigs"].limit(1).select("gig_id", F.lit(9).alias("rating_tips"))},
        "delete_gig": {"gig_id": "g-7"},
        "delete_contact": {"contact_id": "C-1"},
        "delete_venue": {"venue_id": "V-1"},
        "update_taste": {"rows": tables["taste"]},
        "remap_contact_venue": {"old": "V-1", "new": "V-2"},
        "save_step": {"venue_id": "V-1", "step": "emails", "status": "DONE"},
        "save_check": {"venue_id": "V-1", "evidence": "emails:DONE"},
        "venue_detail": {"venue_id": "V-1"},
        "find_by_domain": {"domain": "none.example"},
    }
    counts = {}
    for name in actions.ACTIONS:
        out = actions.run(name, tables, **parameters.get(name, {}))
        counts[name] = out.count() if not isinstance(out, dict) else {k: v.count() for k, v in out.items()}
    n = tables["venues"].count()
    assert counts["venues"] == counts["update_venue"] == counts["add_venue"] == counts["save_step"] == counts["fix_venue_ids"] == n
    assert counts["delete_venue"]["venues"] == n - 1 and counts["delete_venue"]["contacts"] < counts["add_contact"]
    assert set(counts["audit_pipeline"]) == {"venues", "summary", "pending"} and counts["dashboard"] == 1
    stats = {(r.kind, r.key): r.n for r in actions.run("stats", tables).collect()}
    assert stats["total", ""] == tables["outreach"].count() == sum(v for (k, _), v in stats.items() if k == "channel")
    assert counts["update_gig"] == tables["gigs"].count() and counts["dashboard"] == 1 and counts["load_discovery"] == 0
    assert actions.run("get_skip_words", tables).first().value == "a,b"
    assert actions.run("templates", tables).first().subject == "s2"
    changed = actions.run("save_step", tables, venue_id="V-1", step="emails", status="DONE").where("venue_id = 'V-1'").first().check_status
    assert "emails:DONE" in changed.split("|")
    with pytest.raises(ValueError, match="unknown field"):
        actions.run("update_venue", tables, venue_id="V-1", field="nonexistent", value="x")
    with pytest.raises(ValueError, match="unknown action"):
        actions.run("nonsense", tables)


def test_names_are_found(spark, tables):
    first = tables["venues"].orderBy("_ord").first()
    assert actions.find_by_name(tables, name=first.name.upper()).first()._ord == first._ord
    assert actions.find_by_name(tables, name=" ".join(reversed(first.name.split()))).first() is not None


def test_inserts_follow_the_rules(spark):
    """Duplicates by name with city or domain, ids, defaults; a row that is not inserted makes no other a duplicate."""
    from prospectra.operators import crud

    schema = "venue_id string, name string, category string, website string, city string, state string, zone_priority string, status string, upscale_score double, _ord long"
    old = spark.createDataFrame([("MD-WINE-020", "La Ferme", "winery", "https://www.laferme.example/x", "Easton", "MD", "green", "untouched", 4.0, 1), ("MD-WINE-7", "Oak", "winery", "", "", "MD", "green", "untouched", 4.0, 2)], schema)
    new = [("", "la ferme ", "Winery", "", "EASTON", "md"), ("", "La Ferme", "Winery", "laferme.example", "Reston", "md"), ("", "La Ferme", "Winery", "https://b.example", "Reston", "md"), ("", "La Ferme", "Winery", "b.example/menu", "Bowie", "md"), ("", "Oak", "", "", "", ""), ("", "Elm", "", "", "", ""), ("X-1", "Elm", "", "", "Bowie", "")]
    rows = spark.createDataFrame([(*r, "", "", None, k) for k, r in enumerate(new)], schema)
    got = {r._ord: (r.venue_id, r.state, r.zone_priority, r.status, r.upscale_score) for r in crud.insert_venues(old, rows).collect()}
    assert got == {2: ("MD-WINE-021", "MD", "default", "untouched", 3.0), 5: ("XX-OTHE-001", "", "default", "untouched", 3.0), 6: ("X-1", "", "default", "untouched", 3.0)}


def test_updates_are_validated(spark, tables):
    for field, value in (("website", "https://www.yelp.com/biz/x"), ("website", "https://a.example/x.png"), ("Website", "a|b"), ("facebook", "blueridge"), ("instagram", "https://instagram.com/zzzz")):
        with pytest.raises(ValueError, match="not accepted"):
            actions.run("update_venue", tables, venue_id="V-1", field=field, value=value)
    out = actions.run("update_venue", tables, venue_id="V-1", field="instagram", value="https://instagram.com/zzzz", force=True)
    assert out.where("venue_id = 'V-1'").first().instagram == "https://instagram.com/zzzz"


def test_sites_without_a_scheme(spark):
    from prospectra.functions import rules, text

    rows = spark.createDataFrame([("Salamander Resort", "salamanderresort.example"), ("Salamander Resort", "https://www.salamanderresort.example/x"), ("X", "yelp.com/biz"), ("X", "")], "n string, u string")
    got = rows.select(rules.website_score("n", "u").alias("s"), rules.blocked_domain("u").alias("b"), text.site_host("u").alias("h")).collect()
    assert got[0].s == got[1].s > 6 and [r.b for r in got] == [False, False, True, True] and [r.h for r in got] == ["salamanderresort.example", "salamanderresort.example", "yelp.com", ""]


def test_crawl_budget(spark):
    from prospectra.operators import graph

    pages = spark.createDataFrame([("https://s.example/", "".join(f'<a href="/{p}">x</a>' for p in ("zz", "events", "contact", "private-events")))], "url string, html string")
    got = {r.url for r in graph.crawl(pages, pages.select("url"), max_pages=3).collect()}
    assert got == {"https://s.example/", "https://s.example/private-events", "https://s.example/events"}
