"""Venues, contacts, outreach and gigs from the star-schema tables.

The engine's operators take these tables whatever their source. Here each is a projection, whose
expressions are plain SQL that Spark and DuckDB read alike; `_ord` stands for the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import spread


def pick(key: str, *values: str) -> str:
    quoted = [v.replace("'", "''") for v in values]
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(quoted)) + " END"


NAME = f"""concat({pick("c_custkey", "La Ferme", "Blue Ridge", "Harbor", "Old Town", "Chez Paris", "Cedar Grove", "Falls Church", "Stone Tower", "Army Navy", "Riverside", "Grand", "Spanish Gate")}, ' ',
 {pick("c_custkey", "Bistro", "Winery", "Country Club", "Hotel", "Museum", "Wine Bar", "Yacht Club", "Gallery", "Spa", "Library", "Brewery", "Tavern", "Theater", "Steakhouse", "Church", "Inn", "Market")})"""
RAW_CATEGORY = pick("c_custkey", "restaurant", "Winery", "country_club", "hotel", "museum", "wine bar", "event venue", "spa", "", "Spanish restaurant", "art gallery", "private club", "Gym")
CITY = pick("(c_nationkey + c_custkey % 2)", "Annapolis", "Baltimore", "Reston", "", "best prices in DC", "Easton", "McLean", "Gaithersburg 20878", "Leesburg", "Alexandria", "Bethesda")
STATE = pick("c_nationkey", "DC", "MD", "VA", "PA", "DE", "WV", "")

VENUES = {
    "venue_id": "concat('V-', cast(c_custkey AS varchar(20)))",
    "name": NAME,
    "category": RAW_CATEGORY,
    "website": f"CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 9 = 1 THEN concat('https://www.facebook.com/v', cast(c_custkey AS varchar(20))) ELSE concat(CASE WHEN c_custkey % 5 = 2 THEN 'www.' ELSE 'https://www.' END, lower(replace({NAME}, ' ', '')), cast(c_custkey % 40 AS varchar(20)), '.example.org/', CASE WHEN c_custkey % 4 = 0 THEN 'a/b/c' ELSE '' END) END",
    "city": CITY,
    "county": "r_name",
    "state": STATE,
    "facebook": "CASE WHEN c_custkey % 3 = 0 THEN concat('https://www.facebook.com/v', cast(c_custkey AS varchar(20))) ELSE '' END",
    "instagram": "CASE WHEN c_custkey % 4 = 1 THEN concat('https://www.instagram.com/v', cast(c_custkey AS varchar(20))) ELSE '' END",
    "raw_upscale": "CASE WHEN c_custkey % 17 = 3 THEN 'abc' ELSE cast(c_custkey % 6 AS varchar(20)) END",
    "zone_priority": pick("c_custkey", "green", "yellow", "", "default"),
    "status": pick("c_custkey", "untouched", "pipelined", "contacted", "needs_review", "closed", "pipelined", "untouched"),
    "distance_miles": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE round(abs(c_acctbal) / 50, 1) END",
    "venue_vote": pick("c_custkey", "up", "down", "", "", "", "", "", "", "", ""),
    "check_status": "concat('website:DONE|emails:', CASE c_custkey % 4 WHEN 0 THEN 'DONE:3 found' WHEN 1 THEN 'FAILED:x:y' WHEN 2 THEN 'vendor:3' ELSE 'SKIPPED' END, '|CHECKED:old', CASE WHEN c_custkey % 3 = 0 THEN '|social:DONE|form:DONE|people:DONE|location:DONE' ELSE '|social:DONE' END)",
    "_ord": "c_custkey",
}
CONTACTS = {
    "contact_id": "concat('C-', cast(o_orderkey AS varchar(20)))",
    "venue_id": "concat('V-', cast(o_custkey AS varchar(20)))",
    "name": f"CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE concat({pick('o_orderkey', 'Ann', 'Bo', 'Cy', 'Di', 'Ed')}, ' ', {pick('o_orderkey', 'Lee', 'Moss', 'Nash', 'Oak', 'Page', 'Quill', 'Ray')}) END",
    "title": f"{pick('o_orderkey', 'Events Manager', 'Intern', 'Owner', '', 'Line Cook', 'Director of Sales', 'Engineer')}",
    "email": f"CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 11 = 1 THEN 'undefined' ELSE concat({pick('o_orderkey', 'info', 'Ann.Lee', 'bo_moss', 'noreply', 'events', 'cy-nash')}, '@v', cast(o_custkey AS varchar(20)), '.example.org') END",
    "verified": f"CASE o_orderstatus WHEN 'F' THEN {pick('o_orderkey', 'valid', 'catch-all', 'valid', 'invalid')} WHEN 'O' THEN 'pending' ELSE {pick('o_orderkey', 'unknown', 'deferred', 'do_not_mail')} END",
    "email_sent": pick("o_orderkey", "", "true", "skipped", "", "", "false", "TRUE"),
    "added": "o_orderdate",
    "_ord": "o_orderkey",
}
OUTREACH = {
    "sent_at": "CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END",
    "venue_id": "concat('V-', cast(user_id AS varchar(20)))",
    "channel": "CASE event_type WHEN 'view' THEN 'email' WHEN 'click' THEN 'instagram' WHEN 'signup' THEN 'contact_form' WHEN 'purchase' THEN 'facebook' ELSE CASE WHEN event_id % 2 = 0 THEN '' ELSE 'email_skip' END END",
    "value": "value",
    "_ord": "event_id",
}
GIGS = {
    "gig_id": "concat('g-', cast(o_orderkey AS varchar(20)))",
    "venue_id": "concat('V-', cast(o_custkey AS varchar(20)))",
    "venue_name": "concat('Gig ', cast(o_custkey AS varchar(20)))",
    "category": pick("o_custkey", "restaurant", "winery", "hotel", "museum", "country_club"),
    "rating_tips": "o_orderkey % 11",
    "rating_rebooked": "o_orderkey % 7 + 2",
    "rating_audience": "o_custkey % 10",
    "rating_venue_quality": "o_custkey % 6",
    "distance_miles": "CASE WHEN o_custkey % 8 = 0 THEN NULL ELSE cast(o_custkey % 120 AS double) + 0.5 END",
    "_ord": "o_orderkey",
}
#: Fetched pages of the venues' sites: one a customer.
SLUG = f"concat(lower(replace({NAME}, ' ', '')), cast(c_custkey % 40 AS varchar(20)))"
MAILS = """CASE c_custkey % 6 WHEN 0 THEN 'Write <b>Ann.Lee@H</b>, ann.lee@H.' WHEN 1 THEN 'bo [at] H and cy (at) H' WHEN 2 THEN 'di at mail dot org; noreply@H' WHEN 3 THEN 'info@H sales@H x@example.com logo@2x.png'
 WHEN 4 THEN '<a data-cfemail="3d5e5b7d4b58534858135845505a">x</a>' ELSE '' END"""
SOCIALS = """CASE c_custkey % 7 WHEN 0 THEN '<a href="https://www.facebook.com/TheSlug/">f</a>' WHEN 1 THEN '"https:\\/\\/instagram.com\\/the_slug\\/"' WHEN 2 THEN '<a href="//m.facebook.com/sharer">s</a> https://www.facebook.com/12345'
 WHEN 3 THEN 'https://www.facebook.com/profile.php?id=77&amp;x=1' WHEN 4 THEN 'https://www.instagram.com/p/ https://instagram.com/Slug.two' WHEN 5 THEN 'https%3A%2F%2Ffacebook.com%2Fcoded' ELSE '' END"""
PATH = pick("c_custkey", "/Events/?utm_source=a&id=3#Form", "", "/contact-us/", "/menu.PDF?x=1", "/wp-content/logo.png", "/locations/reston-va/", "/private_events/index.html", "/book-a-table?ref=x", "/" + "z" * 90)
FORM = "CASE WHEN c_custkey % 4 = 1 THEN '<form action=\"/send\"><p>x</p><textarea></textarea></form>' WHEN c_custkey % 4 = 2 THEN '<form class=\"contact\">' ELSE '' END"
SITES = {
    "page_id": "c_custkey",
    "venue_id": "concat('V-', cast(c_custkey AS varchar(20)))",
    "url": f"concat(CASE WHEN c_custkey % 3 = 0 THEN 'https://www.' WHEN c_custkey % 3 = 1 THEN 'HTTP://' ELSE 'https://' END, {SLUG}, '.example.org', {PATH})",
    "html": f"""concat('<title>', {NAME}, ' | ', {CITY}, '</title><h1>', {NAME}, '</h1><a href="/events#cta">Events</a><a href="contact.html?x=1&amp;utm_campaign=z">c</a><a href="?p=2">n</a><a href="tel:1">t</a><a href="https://other',
 cast(c_custkey % 7 AS varchar(20)), '.example.net/p">o</a>', replace({MAILS}, 'H', concat({SLUG}, '.example.org')), ' ', {SOCIALS}, ' ', {FORM})""",
}
FROM = {
    "venues": ("customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey", VENUES),
    "contacts": ("orders", CONTACTS),
    "outreach": ("events", OUTREACH),
    "sites": ("customer", SITES),
    "gigs": ("orders WHERE o_totalprice > 490000", GIGS),
}


def sql(*names: str) -> str:
    """WITH clause of the named tables, in SQL that both engines read."""
    body = lambda n: ",\n ".join(f"{e} AS {c}" for c, e in FROM[n][1].items())
    return "WITH " + ",\n".join(f"{n} AS (SELECT {body(n)} FROM {FROM[n][0]})" for n in names) + "\n"


def entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    if name == "venues":
        nations = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        base = read("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    elif name == "gigs":
        base = read("orders").where("o_totalprice > 490000")
    elif name == "sites":
        # Pages are hundreds of patterns' work each, customers a few bytes.
        base = spread(read("customer"))
    else:
        base = read({"contacts": "orders", "outreach": "events"}[name])
    return base.selectExpr(*(f"{e} AS {c}" for c, e in FROM[name][1].items()))
