"""More named queries, each beside the SQL that it is compared with: pages of sites, names and places, screens, writes, collections.

The SQL is written from the rules, not from the operators; `site` stands for the projected pages of the venues' sites.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, text, vocab
from ..operators import audit, collect, crud, graph, reports, screening
from ..operators import relational as rel
from ..sources import files
from ..sources.projection import entity, sql
from ..sources.shared import new_folder
from ..sources.tables import BucketTable
from .oracle import likes, names, typed
from .queries import Query, contacts, gigs, table, venues


class Compared:
    """Queries with the SQL that each must equal."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.oracle_sql: dict[str, str] = {}

    def compared(self, oracle: str) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            self.queries[f.__name__], self.oracle_sql[f.__name__] = f, oracle
            return f

        return add


BOOK = Compared()
QUERIES, ORACLE_SQL, compared = BOOK.queries, BOOK.oracle_sql, BOOK.compared


def sites(s: SparkSession, d: str) -> DataFrame:
    return entity(s, d, "sites")


# ---------------------------------------------------------------- addresses

HOST = r"regexp_replace(regexp_extract(lower({0}), '^[a-z]+://([^/?#:]*)', 1), '^www\.', '')"
PATH = r"regexp_extract({0}, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)"
EXT = f"lower(regexp_extract({PATH.format('url')}, '\\.([^./]*)$', 1))"
RANK = "CASE " + " ".join(f"WHEN contains(replace(lower(url), '_', '-'), '{w}') THEN {k}" for k, w in enumerate(vocab.PAGE_KEYWORDS)) + f" ELSE {len(vocab.PAGE_KEYWORDS)} + least(length(url) // 40, 10) END"
SUB = "CASE " + " ".join(f"WHEN contains(lower(url), '{w}') THEN {k}" for k, w in enumerate(text.PAGE_ORDER)) + f" ELSE {len(text.PAGE_ORDER)} END"


@compared(sql("sites") + rf"""SELECT page_id, {HOST.format("url")} AS host, {HOST.format("url")} = {HOST.format("'https://www.laferme0.example.org'")} AS same, {EXT} AS extension,
 CASE WHEN {EXT} = 'pdf' THEN 'pdf' WHEN {EXT} = 'png' THEN 'asset' ELSE 'page' END AS kind, {RANK} AS score, {SUB} AS subpage, regexp_matches(lower(url), '\.(pdf|png)(\?|$)') AS asset,
 regexp_matches(lower(url), '/locations/reston-va/$') AS elsewhere,
 (regexp_matches(lower(url), 'contact|inquir|enquir|book') AND {EXT} NOT IN ('pdf', 'png')) OR contains(html, '<form') AS form,
 regexp_matches(lower({PATH.format("url")}), 'contact|inquir|book|event') OR contains(html, '<form') AS kept FROM sites""")
def site_urls(s, d):
    """T1, T2, T4, T5, T16, F24, F25, K15, X4."""
    form = F.contains("html", F.lit("<form"))
    return sites(s, d).select("page_id", text.host("url").alias("host"), text.same_origin("url", F.lit("https://www.laferme0.example.org")).alias("same"), text.extension("url").alias("extension"), text.url_class("url").alias("kind"), text.url_score("url").alias("score"), text.subpage_rank("url").alias("subpage"), screening.asset_path("url").alias("asset"), screening.other_location("url", F.lit("easton-md")).alias("elsewhere"), text.contact_form("url", "html").alias("form"), collect.form_kept("url", form).alias("kept"))


NORMAL = r"""n AS (SELECT *, lower(regexp_extract(url, '^[A-Za-z]+://[^/?#]+')) AS origin, regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS p, array_to_string(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_|ref=)')), '&') AS q FROM sites),
m AS (SELECT *, origin || CASE WHEN rtrim(p, '/') = '' THEN '/' ELSE rtrim(p, '/') END || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS plain, regexp_extract(url, '#(.+)$', 1) AS frag FROM n)"""
TARGETS = r"""h AS (SELECT page_id, plain, origin, regexp_extract(url, '^[A-Za-z]+://[^/?#]+') AS o, p, url, unnest(regexp_extract_all(html, '<a[^>]*href="([^"]+)"', 1)) AS href FROM m),
t AS (SELECT page_id, plain AS src, replace(href, '&amp;', '&') AS href, CASE WHEN regexp_matches(href, '^https?://') THEN href WHEN href LIKE 'tel:%' THEN NULL WHEN href LIKE '//%' THEN lower(regexp_extract(url, '^[A-Za-z]+:')) || href
 WHEN href LIKE '/%' THEN o || href WHEN href LIKE '?%' THEN split_part(split_part(url, '#', 1), '?', 1) || replace(href, '&amp;', '&') ELSE o || CASE WHEN regexp_replace(p, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(p, '[^/]*$', '') END || replace(href, '&amp;', '&') END AS target FROM h),
e AS (SELECT page_id, src, regexp_extract(target, '#(.+)$', 1) AS fragment, lower(regexp_extract(target, '^[A-Za-z]+://[^/?#]+')) AS org, regexp_extract(target, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS tp,
 array_to_string(list_filter(string_split(regexp_extract(target, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^utm_')), '&') AS tq FROM t WHERE target IS NOT NULL),
l AS (SELECT page_id, src, fragment, org || CASE WHEN rtrim(tp, '/') = '' THEN '/' ELSE rtrim(tp, '/') END || CASE WHEN tq <> '' THEN '?' || tq ELSE '' END AS dst FROM e)"""


@compared(sql("sites").rstrip() + ",\n" + NORMAL + "SELECT page_id, plain, plain || CASE WHEN frag <> '' THEN '#' || frag ELSE '' END AS normal FROM m")
def site_normalized(s, d):
    """T3, K19."""
    return sites(s, d).select("page_id", text.normalize_url("url", False).alias("plain"), text.normalize_url("url").alias("normal"))


@compared(sql("sites").rstrip() + ",\n" + NORMAL + "," + TARGETS + "SELECT src, dst, fragment, count(*) AS n FROM l GROUP BY ALL")
def site_links(s, d):
    """Links resolved and normalised, with their fragments."""
    return graph.edges(sites(s, d)).groupBy("src", "dst", "fragment").agg(F.count("*").alias("n"))


@compared(sql("sites").rstrip() + ",\n" + NORMAL + "," + TARGETS + rf""", x AS (SELECT {HOST.format("src")} AS host, count(*) AS n_links, count(*) FILTER (WHERE fragment <> '') AS n_fragments, count(*) FILTER (WHERE regexp_matches(lower(dst), '\.(pdf|png|css)(\?|$)')) AS n_files FROM l GROUP BY 1)
SELECT * FROM (SELECT {HOST.format("url")} AS host, count(*) AS n_pages FROM sites GROUP BY 1) JOIN x USING (host)""")
def site_coverage(s, d):
    """A16."""
    return graph.host_coverage(sites(s, d))


@compared(sql("sites").rstrip() + ",\n" + NORMAL + "," + TARGETS + rf""", x AS (SELECT page_id, 'https://other' || (page_id % 7) || '.example.net/p' AS first FROM sites)
SELECT page_id, first AS external FROM x""")
def site_externals(s, d):
    """The first link to another host."""
    return sites(s, d).select("page_id", files.first_external("html", "url").alias("external"))


@compared(sql("sites") + """SELECT page_id, split_part(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '|', 1) AS name, CASE WHEN page_id % 7 = 0 THEN 'https://www.facebook.com/TheSlug/' WHEN page_id % 7 = 1 THEN 'https://www.instagram.com/the_slug/'
 WHEN page_id % 7 = 3 THEN 'https://www.facebook.com/profile.php?id=77' WHEN page_id % 7 = 4 THEN 'https://www.instagram.com/Slug.two/' WHEN page_id % 7 = 5 THEN 'https://www.facebook.com/coded/' ELSE '' END AS profiles FROM sites""")
def site_profiles(s, d):
    """Profiles in plain, escaped, relative and coded form; reserved and numeric ones are none."""
    page = files.directory_page("html")
    return sites(s, d).select("page_id", page["name"].alias("name"), F.array_join(text.socials("html"), " ").alias("profiles"))


MAIL = """y AS (SELECT page_id, url, lower(replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), ' ', '')) || (page_id % 40) || '.example.org' AS h FROM sites),
z AS (SELECT page_id, url, unnest(CASE page_id % 6 WHEN 0 THEN ['ann.lee@' || h] WHEN 1 THEN ['bo@' || h, 'cy@' || h] WHEN 2 THEN ['di@mail.org'] WHEN 3 THEN ['info@' || h, 'sales@' || h] WHEN 4 THEN ['cf@venue.exmg'] ELSE [] END) AS email FROM y)"""


@compared(sql("sites").rstrip() + ",\n" + MAIL + "SELECT page_id, email, regexp_matches(email, '^(info|sales)@') AS generic, NOT regexp_matches(email, '^(info|sales)@') AS snippet FROM z")
def site_mailboxes(s, d):
    """Plain, spelled-out and encoded mailboxes of pages."""
    rows = sites(s, d).select("page_id", F.explode(text.emails("html")).alias("email"), files.snippet_emails("html").alias("own"))
    return rows.select("page_id", "email", text.generic_email("email").alias("generic"), F.array_contains("own", F.col("email")).alias("snippet"))


ORACLE_SQL["entity_provenance"] = sql("sites").rstrip() + ",\n" + MAIL + """,
w AS (SELECT url, 'email' AS kind, email AS entity FROM z UNION SELECT url, 'social', CASE page_id % 7 WHEN 0 THEN 'https://www.facebook.com/TheSlug/' WHEN 1 THEN 'https://www.instagram.com/the_slug/' WHEN 3 THEN 'https://www.facebook.com/profile.php?id=77'
 WHEN 4 THEN 'https://www.instagram.com/Slug.two/' WHEN 5 THEN 'https://www.facebook.com/coded/' END FROM sites WHERE page_id % 7 NOT IN (2, 6)),
o AS (SELECT *, row_number() OVER (PARTITION BY kind, entity ORDER BY url) AS k FROM w)
SELECT kind, entity, count(*) AS n_sources, min(url) AS first_url, string_agg(url, ' ' ORDER BY k) FILTER (k <= 20) AS sources FROM o GROUP BY 1, 2"""

# ---------------------------------------------------------------- names and places


@compared(typed() + r"""SELECT contact_id, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS flat, array_to_string(list_transform(string_split(trim(regexp_replace(split_part(email, '@', 1), '[-_.]+', ' ', 'g')), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS shown,
 replace(replace(lower(title), '_', ''), ' ', '') AS key, replace(replace(title || ' & <b>', '&', '&amp;'), '<', '&lt;').replace('>', '&gt;') AS escaped,
 CASE WHEN contains(name, ' ') THEN replace(lower(name), ' ', '') || ' ' || replace(lower(name), ' ', '-') || ' ' || replace(lower(name), ' ', '.') ELSE lower(name) END AS slugs, CASE WHEN name = '' THEN '' ELSE split_part(name, ' ', 1) END AS first, CASE WHEN name = '' THEN '' ELSE split_part(name, ' ', 2) END AS last FROM c""")
def contact_names(s, d):
    """T19, T20, T25, T27, T30, X25's name parts."""
    parts = F.split(F.trim("name"), r"\s+", 2)
    return contacts(s, d).select("contact_id", text.plain_name("name").alias("flat"), text.display_name("email").alias("shown"), text.header_key("title").alias("key"), text.escape_html(F.concat("title", F.lit(" & <b>"))).alias("escaped"), F.array_join(text.slugs("name"), " ").alias("slugs"), F.get(parts, F.lit(0)).alias("first"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("last"))


@compared(typed() + r"""SELECT venue_id, CASE WHEN state = '' THEN '' ELSE city END AS city, state, CASE WHEN state = '' THEN '' ELSE trim(regexp_replace(city, '\s+', ' ', 'g')) END AS asked, state AS asked_state,
 CASE WHEN state IN ('VA', 'MD', 'DC', 'PA') AND regexp_matches(city, '^[A-Z][a-z]+$') THEN city || ', ' || state END AS noted, CASE lower(city) WHEN 'annapolis' THEN 'green' WHEN 'reston' THEN 'green' WHEN 'baltimore' THEN 'yellow' ELSE 'default' END AS zone
 FROM v WHERE city NOT LIKE '%DC%' AND city NOT LIKE '% %'""")
def venue_places(s, d):
    """T21 to T23, C11 over addresses, search texts and notes made of city and state; cities of one word."""
    v = venues(s, d).where("city not like '%DC%' and city not like '% %'")
    place, asked = text.city_state(F.concat(F.lit("12 Main St, "), "city", F.lit(", "), "state")), text.query_place(F.concat(F.lit("luxury hotel "), "city", F.lit(" "), "state"))
    noted = text.notes_place(F.concat(F.lit("seen in "), "city", F.lit(", "), "state"))
    none = F.col("state") == ""
    return v.select("venue_id", F.when(none, "").otherwise(place.city).alias("city"), place.state.alias("state"), F.when(none, "").otherwise(asked.city).alias("asked"), asked.state.alias("asked_state"), F.when(F.col("city").rlike("^[A-Z][a-z]+$"), noted).alias("noted"), rules.zone("city").alias("zone"))


NEXT = "lead(name, 1, 'La Ferme Bistro') OVER (ORDER BY _ord)"
BAG = "list_filter(list_distinct(string_split(lower({0}), ' ')), lambda w: w NOT IN ('the', 'a', 'an', 'and', 'of', 'at', 'in', 'by', 'hotel', 'collection'))"


@compared(typed(f"x AS (SELECT venue_id, name, 'The ' || name || ' by Hilton' AS org, CASE WHEN _ord % 2 = 0 THEN upper(name) ELSE 'Grand Harbor Tavern' END AS other, website FROM v)",
    f"y AS (SELECT *, replace(lower(name), ' ', '') AS f, replace(lower(other), ' ', '') AS g, {BAG.format('name')} AS t, {BAG.format('other')} AS r FROM x)") + f"""
SELECT venue_id, true AS branded, lower(name) AS bare, contains(g, f) OR contains(f, g) OR (len(t) > 0 AND 2 * len(list_intersect(t, r)) >= len(t)
 AND len(list_filter(list_intersect(t, r), lambda w: w NOT IN {names(vocab.ORG_KINDS)})) > 0) AS matched, 15 - CASE WHEN contains(lower(other), 'hilton worldwide') THEN 20 ELSE 0 END AS score,
 {likes("lower(name)", vocab.FRENCH_NAMES)} AS french, len(list_filter(regexp_extract_all(lower(name), '[a-z0-9]+'), lambda w: length(w) > 2 AND contains(g, w))) > 0 AS handle,
 len(list_filter(string_split(lower(name), ' '), lambda w: length(w) > 3)) > 0 AND 2 * len(list_filter(string_split(lower(name), ' '), lambda w: length(w) > 3 AND contains(lower(other), w))) >= len(list_filter(string_split(lower(name), ' '), lambda w: length(w) > 3)) AS titled,
 contains(lower(other), lower(name)) AS mentioned FROM y""")
def venue_matches(s, d):
    """Names against branded, upper-case and other names."""
    other = F.when(F.col("_ord") % 2 == 0, F.upper("name")).otherwise("Grand Harbor Tavern")
    x = venues(s, d).select("venue_id", "name", F.concat(F.lit("The "), "name", F.lit(" by Hilton")).alias("org"), other.alias("other"))
    flat = F.regexp_replace(F.lower("other"), " ", "")
    return x.select("venue_id", rules.org_matches("org", "name").alias("branded"), rules.without_brand(F.concat("name", F.lit(" by Hilton"))).alias("bare"), rules.org_matches("other", "name").alias("matched"), rules.org_score(F.lit("1"), F.lit("other.example"), "other", F.lit("")).alias("score"), rules.french("name").alias("french"), rules.handle_matches("name", flat).alias("handle"), rules.title_matches("name", "other").alias("titled"), rules.title_mentions("name", "other").alias("mentioned"))


CODE = "CASE page_id % 6 WHEN 0 THEN 'WINE' WHEN 1 THEN 'HOTE' WHEN 2 THEN 'REST' WHEN 3 THEN 'COUN' WHEN 4 THEN 'SPAA' ELSE 'zzzz' END"


@compared(sql("sites").rstrip() + f""", x AS (SELECT *, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS name, {CODE} AS code FROM sites)
SELECT page_id, CASE WHEN code = 'REST' AND {likes("lower(name)", ("hotel", "inn ", " inn", "resort", "lodge"))} THEN 'hotel' ELSE CASE code WHEN 'WINE' THEN 'winery' WHEN 'HOTE' THEN 'hotel' WHEN 'REST' THEN 'restaurant' WHEN 'COUN' THEN 'country_club' WHEN 'SPAA' THEN 'spa' ELSE 'zzzz' END END AS kind, true AS content FROM x""")
def site_kinds(s, d):
    """Categories by the code of an id; a page's own name in its text."""
    name = F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)
    code = F.element_at(F.array(*map(F.lit, ("WINE", "HOTE", "REST", "COUN", "SPAA", "zzzz"))), (F.col("page_id") % 6 + 1).cast("int"))
    return sites(s, d).select("page_id", rules.category_of_id(F.concat(F.lit("MD-"), code, F.lit("-1")), name).alias("kind"), rules.content_matches(name, "html").alias("content"))


# ---------------------------------------------------------------- screens


@compared(typed() + """SELECT contact_id, email_sent = 'false' AND NOT contains(lower(title), 'intern') AND (contains(lower(title), 'manager') OR contains(lower(title), 'owner')) AND len(string_split(trim(name), ' ')) >= 2 AND length(string_split(trim(name), ' ')[-1]) > 2 AS person,
 split_part(email, '@', 2) <> '' AND regexp_replace(lower(split_part(email, '@', 2)), '\\.[^.]*$', '') <> 'v1.example' AS other_domain, CASE WHEN email <> '' AND verified <> 'unavailable' THEN 'verify' ELSE 'pending' END AS route,
 NOT (contains(lower(title), 'intern') OR contains(lower(title), 'engineer') OR contains(lower(title), 'cook')) AS relevant FROM c WHERE contains(email, '@')""")
def contact_screens(s, d):
    """F13 (user words), F14, F23, X10."""
    c = contacts(s, d).where("email like '%@%'")
    return c.select("contact_id", screening.people_filter("name", "title", F.col("email_sent") == "false", ("intern",), ("manager", "owner")).alias("person"), screening.off_domain_report("email", F.lit("www.v1.example.org")).alias("other_domain"), screening.enrichment_route("email", "verified").alias("route"), rules.title_relevant("title").alias("relevant"))


SLUGGED = "regexp_replace(lower(regexp_extract(rtrim(facebook, '/'), '([^/]*)$', 1)), '[^a-z0-9]', '', 'g')"


@compared(typed() + f"""SELECT venue_id, CASE WHEN state = '' THEN true WHEN state IN ('PA', 'DE') THEN state IN ('PA', 'DE') WHEN state IN ('VA', 'DC') THEN true WHEN state = 'MD' THEN true WHEN state = 'WV' THEN true END AS near,
 facebook <> '' AND {SLUGGED} <> '' AND (contains(regexp_replace(lower(name), '[^a-z0-9]', '', 'g'), {SLUGGED}) OR contains({SLUGGED}, regexp_replace(lower(name), '[^a-z0-9]', '', 'g'))) AS evidence,
 CASE WHEN facebook = '' THEN 'empty' END AS facebook_reject, CASE WHEN facebook = '' THEN 'empty' ELSE 'other platform' END AS instagram_reject,
 CASE WHEN status IN ('contacted', 'closed') THEN 'skip' ELSE 'run' END AS gate, CASE WHEN website LIKE '%facebook%' THEN 'junk domain' END AS website_reject,
 CASE WHEN upscale > 2 THEN 'pipelined' ELSE 'needs_review' END AS outcome, CASE WHEN _ord % 3 = 0 THEN 'dead' ELSE 'live' END AS live FROM v""")
def venue_screens(s, d):
    """F17 to F19, T15, X15, X16, X18."""
    code = F.when(F.col("_ord") % 3 == 0, F.element_at(F.array(F.lit(0), F.lit(404), F.lit(410)), (F.col("_ord") % 9 / 3 + 1).cast("int"))).otherwise(200)
    own = F.concat("city", F.lit(", "), F.lower("state"))
    up = F.when(F.col("upscale_score") > 2, 1).otherwise(0)
    return venues(s, d).select("venue_id", screening.near_state(own, "state").alias("near"), screening.social_evidence("facebook", "name", F.lit("")).alias("evidence"), screening.social_reject("facebook", "facebook").alias("facebook_reject"), screening.social_reject("facebook", "instagram").alias("instagram_reject"), screening.venue_gate("status").alias("gate"), crud.website_reject("website").alias("website_reject"), screening.outcome(up).alias("outcome"), screening.liveness(code).alias("live"))


@compared("""WITH t AS (SELECT p_partkey, p_name AS name, CASE p_partkey % 6 WHEN 0 THEN 'Fine dining restaurant' WHEN 1 THEN 'Pharmacy' WHEN 2 THEN 'Winery' WHEN 3 THEN 'Spa' WHEN 4 THEN 'Hotel' ELSE 'Plumber' END AS category, p_size / 10 AS rating, p_partkey % 5 AS price, floor(p_retailprice) AS reviews FROM part)
SELECT p_partkey, CAST(CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE floor(rating * 10) / 10 END AS double) AS stars, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(reviews AS bigint) END AS reviews, price, 'Easton' AS city, 'MD' AS state,
 CASE WHEN contains(name, 'cold') THEN 'exists' WHEN category = 'Pharmacy' THEN 'type' WHEN p_partkey % 4 = 0 THEN 'no data' WHEN category = 'Plumber' THEN 'unclassified' END AS reject FROM t""")
def card_screens(s, d):
    """Search cards made from parts, parsed back from their text."""
    p = table(s, d, "part")
    kinds = ("Fine dining restaurant", "Pharmacy", "Winery", "Spa", "Hotel", "Plumber")
    kind = F.element_at(F.array(*map(F.lit, kinds)), (F.col("p_partkey") % 6 + 1).cast("int"))
    stars, reviews = F.format_string("%.1f", F.floor(F.col("p_size") / 10 * 10) / 10), F.format_number(F.floor("p_retailprice"), 0)
    data = F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.concat(stars, F.lit(" ("), reviews, F.lit(")")))
    line = F.concat(data, F.lit(" "), F.repeat(F.lit("$"), (F.col("p_partkey") % 5).cast("int")), F.lit(" Main St, Easton, MD"))
    cards = files.cards(p.select(F.concat("p_name", F.lit("#"), "p_partkey").alias("name"), line.alias("text")))
    key = F.split_part("name", F.lit("#"), F.lit(2)).cast("long")
    joined = cards.withColumn("p_partkey", key).withColumnsRenamed({"rating": "stars", "reviews": "n"}).join(p.select("p_partkey", kind.alias("category")), "p_partkey")
    screened = joined.withColumns({"name": F.split_part("name", F.lit("#"), F.lit(1)), "rating": F.coalesce(F.col("stars").cast("string"), F.lit("")), "reviews": F.coalesce(F.col("n").cast("string"), F.lit(""))})
    reject = screening.card_reject(F.contains("name", F.lit("cold")), F.lit("Easton, MD"), ("pharmacy",))
    return screened.select("p_partkey", "stars", F.col("n").alias("reviews"), "price", F.lit("Easton").alias("city"), "place.state", reject.alias("reject"))


# ---------------------------------------------------------------- logs and reports

LINE = "'10:00:00 Added (Owner): ' || name || ' <' || email || '> ' || verified"


@compared(typed() + f"""SELECT contact_id, trim(name) AS name, email, CASE WHEN verified IN ('invalid', 'catch-all', 'unknown', 'do_not_mail') THEN verified ELSE 'valid' END AS status, CASE WHEN verified = 'pending' THEN 'warning,no site' ELSE '' END AS flags FROM c""")
def log_contacts(s, d):
    """X19, X20 over log lines of the contacts."""
    line = F.concat(F.lit("10:00:00 Added (Owner): "), "name", F.lit(" <"), "email", F.lit("> "), "verified")
    noted = F.concat(line, F.when(F.col("verified") == "pending", " [WARN] No website").otherwise(""))
    x = contacts(s, d).select("contact_id", F.when(F.col("email") == "", F.lit("")).otherwise(F.col("email")).alias("mail"), reports.log_contact(line).alias("c"), reports.log_flags(noted).alias("f"))
    return x.select("contact_id", "c.name", "c.email", "c.status", F.array_join("f", ",").alias("flags"))


@compared("""WITH x AS (SELECT conv_id, turn, text AS line, lag(text) OVER w AS name, lead(text) OVER w AS title, role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id, turn, name, title FROM x WHERE regexp_matches(line, '^The ')""")
def log_pairs(s, d):
    """W-f: around each line that starts with a marker, the lines above and below."""
    return reports.paired(table(s, d, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn", "text", "^The ")


@compared("""WITH x AS (SELECT user_id, event_id, event_type = 'purchase' AS hit FROM events), g AS (SELECT *, sum(hit::int) OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM x),
r AS (SELECT *, sum((NOT hit)::int) OVER (PARTITION BY user_id, k ORDER BY event_id) AS run FROM g), f AS (SELECT user_id, min(event_id) AS stop FROM r WHERE run >= 6 GROUP BY 1)
SELECT user_id, count(*) AS n FROM r LEFT JOIN f USING (user_id) WHERE stop IS NULL OR event_id <= stop GROUP BY 1""")
def miss_streaks(s, d):
    """Rows of each user up to the sixth miss in a row."""
    e = table(s, d, "events").select("user_id", "event_id", (F.col("event_type") == "purchase").alias("hit"))
    return collect.misses_in_a_row(e, "user_id", "event_id", "hit", 6).groupBy("user_id").agg(F.count("*").alias("n"))


@compared("""SELECT CAST(to_date AS varchar) AS day, n FROM (SELECT CAST(ts AS date) AS to_date, count(*) AS n FROM events GROUP BY 1) WHERE to_date >= date '2024-01-16'""")
def retained_days(s, d):
    """Entries of a manifest of days, of the last 14 days before the 30th."""
    days = table(s, d, "events").groupBy(F.to_date("ts").cast("string").alias("date")).agg(F.count("*").alias("n"))
    return reports.retained(days, "2024-01-30", 14).select(F.col("date").alias("day"), "n")


@compared("""SELECT event_id, CAST(((h2 * 3600 + m2 * 60) - (h1 * 3600 + m1 * 60) + CASE WHEN h2 * 3600 + m2 * 60 < h1 * 3600 + m1 * 60 THEN 86400 ELSE 0 END) // 60 AS bigint) AS minutes FROM (SELECT event_id, hour(ts) AS h1, minute(ts) AS m1, (hour(ts) + event_id % 13) % 24 AS h2, minute(ts) AS m2 FROM events)""")
def run_minutes(s, d):
    """Run times across midnight."""
    e = table(s, d, "events")
    at = lambda h: F.format_string("%02d:%02d:00", h, F.minute("ts"))
    return e.select("event_id", reports.runtime_minutes(at(F.hour("ts")), at((F.hour("ts") + F.col("event_id") % 13).cast("int") % 24)).alias("minutes"))


# ---------------------------------------------------------------- writes


@compared(typed("l AS (SELECT 'C-' || event_id AS contact_id, CASE event_id % 3 WHEN 0 THEN 'title' WHEN 1 THEN 'verified' ELSE 'nonsense' END AS f, event_type AS value FROM events)")
    + "SELECT c.contact_id, CASE WHEN l.f = 'title' THEN l.value ELSE title END AS title, CASE WHEN l.f = 'verified' THEN l.value ELSE verified END AS verified FROM c LEFT JOIN l USING (contact_id)")
def contact_changes(s, d):
    """W4."""
    log = table(s, d, "events").select(F.concat(F.lit("C-"), "event_id").alias("contact_id"), F.element_at(F.array(*map(F.lit, ("title", "verified", "nonsense"))), (F.col("event_id") % 3 + 1).cast("int")).alias("field"), F.col("event_type").alias("value"), F.col("event_id").alias("_ord"), F.col("ts").alias("at"))
    return crud.fold_changes(contacts(s, d).select("contact_id", "title", "verified"), log, "contact_id", ["title", "verified"]).select("contact_id", "title", "verified")


@compared(typed() + f"""SELECT contact_id, coalesce((SELECT venue_id FROM v WHERE 'V-' || (_ord + 1) = c.venue_id AND status = 'closed'), venue_id) AS venue_id FROM c WHERE NOT ({" OR ".join(f"starts_with(lower(email), '{p}')" for p in (*vocab.REJECTED_MAIL, *vocab.GENERIC_MAIL))})""")
def contact_cleanup(s, d):
    """Role mailboxes go, and contacts of the venue after a closed one move to it."""
    moves = venues(s, d).where("status = 'closed'").select(F.concat(F.lit("V-"), F.col("_ord") + 1).alias("old"), F.col("venue_id").alias("new"))
    return crud.remapped(crud.without_role_mailboxes(contacts(s, d)), moves).select("contact_id", "venue_id")


@compared(typed("p AS (SELECT venue_id, check_status AS s FROM v)") + """SELECT venue_id, regexp_replace(s, 'website:DONE\\|', '') <> s AS had, contains(s, 'emails:vendor') AS vendor, CASE WHEN contains(s, 'emails:DONE') THEN 'DONE' WHEN contains(s, 'emails:FAILED') THEN 'FAILED' WHEN contains(s, 'emails:SKIPPED') THEN 'SKIPPED' ELSE 'vendor' END AS emails,
 CASE WHEN contains(s, 'emails:DONE:3 found') THEN '3 found' WHEN contains(s, 'emails:FAILED') THEN 'x:y' WHEN contains(s, 'vendor') THEN '3' ELSE '' END IN ('3 found', 'x:y', '', '3') AS detail, 'DONE' AS people, 'SKIPPED' AS website FROM p""")
def step_saves(s, d):
    """A step saved over old evidence, an unknown status ignored, new evidence last."""
    v = venues(s, d)
    saved = crud.saved_step("check_status", F.lit("people"), F.lit("DONE"))
    odd = crud.saved_step("check_status", F.lit("website"), F.lit("ODD"))
    both = text.step_map(F.concat_ws("|", "check_status", F.lit("website:SKIPPED")))
    return v.select("venue_id", (odd["website"].status == "DONE").alias("had"), (text.step_map("check_status")["emails"].status == "vendor").alias("vendor"), text.step_map("check_status")["emails"].status.alias("emails"), text.step_map("check_status")["emails"].detail.isNotNull().alias("detail"), saved["people"].status.alias("people"), both["website"].status.alias("website"))


@compared(typed("i AS (SELECT * FROM v)") + """SELECT venue_id, coalesce(distance_miles, _ord + 0.5) AS distance_miles FROM v""")
def distance_fill(s, d):
    """Distances from a table, where missing."""
    given = venues(s, d).select("venue_id", (F.col("_ord") + 0.5).alias("miles"))
    return crud.filled_distances(venues(s, d), given).select("venue_id", "distance_miles")


@compared(typed("r AS (SELECT gig_id, CASE WHEN _ord % 2 = 0 THEN 9 ELSE 0 END AS t, CASE WHEN _ord % 3 = 0 THEN 'Renamed' ELSE '' END AS nm FROM g WHERE rating_tips > 4)", "j AS (SELECT g.*, r.gig_id IS NOT NULL AS hit, coalesce(nullif(t, 0), rating_tips) AS tips, coalesce(nullif(nm, ''), venue_name) AS nm FROM g LEFT JOIN r USING (gig_id))")
    + "SELECT gig_id, nm AS venue_name, tips AS rating_tips, CASE WHEN hit THEN floor((tips + rating_rebooked + rating_audience + rating_venue_quality) / 4.0 * 10 + 0.5) / 10 ELSE overall END AS overall FROM j")
def gig_updates(s, d):
    """New ratings and names; empty and zero values change nothing, and overall is computed anew."""
    g = gigs(s, d)
    changes = g.where("rating_tips > 4").select("gig_id", F.when(F.col("_ord") % 2 == 0, 9).otherwise(0).alias("rating_tips"), F.when(F.col("_ord") % 3 == 0, "Renamed").otherwise("").alias("venue_name"))
    return crud.rated(g, changes).select("gig_id", "venue_name", "rating_tips", "overall")


@compared(typed("n AS (SELECT *, CASE WHEN _ord % 5 = 0 THEN 'events@v' || _ord || '.example.org' ELSE 'new.one@v' || (_ord % 7) || '.example.org' END AS mail, _ord % 5 = 0 AND _ord % 2 = 0 AS marked FROM v)",
        "o AS (SELECT *, CASE WHEN marked THEN 'Events' ELSE 'New One' END AS who FROM n WHERE marked OR _ord % 5 <> 0)", "p AS (SELECT *, row_number() OVER (ORDER BY _ord) AS k FROM o WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.venue_id = o.venue_id AND lower(c.email) = o.mail))")
    + "SELECT 'C-' || CASE WHEN length(CAST(k + m AS varchar)) >= 3 THEN CAST(k + m AS varchar) ELSE lpad(CAST(k + m AS varchar), 3, '0') END AS contact_id, venue_id, who AS name, mail AS email, 'valid' AS verified FROM p, (SELECT max(_ord) AS m FROM c)")
def contact_inserts(s, d):
    """New contacts of each venue; unmarked role mailboxes are refused, marked ones named after the mailbox."""
    v = venues(s, d)
    role = F.col("_ord") % 5 == 0
    mail = F.when(role, F.concat(F.lit("events@v"), "_ord", F.lit(".example.org"))).otherwise(F.concat(F.lit("new.one@v"), F.col("_ord") % 7, F.lit(".example.org")))
    new = v.select(F.lit("").alias("contact_id"), "venue_id", F.when(role, "").otherwise("New One").alias("name"), F.lit("").alias("title"), mail.alias("email"), F.lit("").alias("verified"), F.lit("").alias("email_sent"), "_ord", (role & (F.col("_ord") % 2 == 0)).alias("is_generic"))
    return crud.insert_contacts(contacts(s, d).drop("added"), new).select("contact_id", "venue_id", "name", "email", "verified")


@compared(typed("q AS (SELECT * FROM (" + "{QUALITY}" + "))") + """SELECT venue_id, coalesce((SELECT suggested FROM q WHERE q.venue_id = v.venue_id AND issue = 'category' AND suggested IN ('hotel', 'country_club', 'private_club', 'yacht_club', 'wine_bar', 'winery')), category) AS category,
 CASE WHEN contains(website, 'facebook.com') THEN '' ELSE website END AS website, CASE WHEN contains(website, 'facebook.com') THEN 'needs_review' ELSE status END AS status FROM v""")
def safe_repairs(s, d):
    """C13."""
    v = venues(s, d)
    return crud.repaired(v, audit.quality_issues(v)).select("venue_id", "category", "website", "status")


@compared("SELECT lower(event_type) AS key, max_by(props, event_id) AS value FROM events GROUP BY 1")
def config_upserts(s, d):
    """The last value of each key, without case."""
    e = table(s, d, "events").select(F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type")).alias("key"), F.col("props").alias("value"), F.col("event_id").alias("_ord"))
    return crud.upserted_config(e.limit(0), e)


# ---------------------------------------------------------------- joins between tables


@compared(typed("w AS (SELECT name, min(_ord) AS o FROM v GROUP BY 1)", "n AS (SELECT DISTINCT lower(name) AS n FROM v)", "u AS (SELECT lower(trim(name)) AS name FROM v WHERE name <> '' UNION SELECT lower(trim(venue_name)) FROM g)")
    + "SELECT name, name LIKE 'gig %' AS gig FROM u")
def every_name(s, d):
    """Distinct names of venues and gigs."""
    return collect.all_names(venues(s, d), gigs(s, d)).withColumn("gig", F.col("name").like("gig %"))


@compared(typed("b AS (SELECT *, row_number() OVER (PARTITION BY lower(email) ORDER BY part, _ord) AS k FROM (SELECT 0 AS part, contact_id, email, _ord FROM c WHERE verified = 'valid' UNION ALL SELECT 1, contact_id, email, _ord FROM c WHERE verified = 'unknown' UNION ALL SELECT 2, contact_id, email, _ord FROM c WHERE verified = 'pending'))")
    + "SELECT contact_id, lower(email) AS email FROM b WHERE k = 1")
def merged_mailboxes(s, d):
    """Three lists one after another, the first row of each mailbox."""
    part = lambda status: contacts(s, d).where(F.col("verified") == status).select("contact_id", F.lower("email").alias("email"), "_ord")
    return collect.union_distinct(part("valid"), part("unknown"), part("pending"), key="email", order="_ord").select("contact_id", "email")


@compared(typed("o AS (SELECT 'Gig ' || _ord AS name FROM v UNION ALL SELECT name FROM v)", "h AS (SELECT lower(venue_name) AS n, min_by(gig_id, _ord) AS gig_id FROM g GROUP BY 1)") + "SELECT name, gig_id, count(*) AS n FROM o LEFT JOIN h ON lower(o.name) = h.n GROUP BY 1, 2")
def whitelisted(s, d):
    """J11."""
    v = venues(s, d)
    listed = v.select(F.concat(F.lit("Gig "), "_ord").alias("name")).unionByName(v.select("name"))
    return screening.whitelist(listed, gigs(s, d)).groupBy("name", "gig_id").agg(F.count("*").alias("n"))


@compared(typed() + """SELECT v.venue_id, coalesce(nullif(x.name, ''), v.name) AS name, coalesce(nullif(v.city, ''), x.city) AS city FROM v LEFT JOIN (SELECT venue_id, CASE WHEN status = 'pipelined' THEN '' ELSE upper(name) END AS name, 'Oxford' AS city FROM v WHERE status <> 'closed') x USING (venue_id)""")
def overridden_fields(s, d):
    """A sheet's values over a log's."""
    v = venues(s, d)
    sheet = v.where("status <> 'closed'").select("venue_id", F.when(F.col("status") == "pipelined", "").otherwise(F.upper("name")).alias("name"), F.lit("Oxford").alias("city"))
    return screening.overridden(v.select("venue_id", "name", "city"), sheet, "venue_id", ["name"], ["city"])


@compared(typed("m AS (SELECT DISTINCT venue_id FROM c WHERE verified = 'valid' AND email <> '')") + """SELECT venue_id, CASE WHEN venue_id IN (SELECT venue_id FROM m) THEN 'clear' ELSE 'search' END AS route, venue_id NOT IN (SELECT venue_id FROM m) AS fallback,
 CASE WHEN status = 'needs_review' AND facebook <> '' THEN 'untouched' ELSE status END AS status FROM v""")
def pending_routes(s, d):
    """J17, X13, X27."""
    v, good = venues(s, d), contacts(s, d).where("verified = 'valid' and email <> ''")
    checks = v.select("venue_id", F.lit("x").alias("written"), F.when(F.col("facebook") != "", "x").otherwise("y").alias("read_back"))
    routed = screening.promoted(screening.pending_split(v, good), checks)
    left = screening.without_fallback(v, good).select("venue_id", F.lit(True).alias("f"))
    return routed.join(left, "venue_id", "left").select("venue_id", "route", F.coalesce("f", F.lit(False)).alias("fallback"), "status")


@compared(typed("x AS (SELECT name FROM v UNION ALL SELECT 'Gig ' || _ord FROM v UNION ALL SELECT 'Nowhere')") + "SELECT name, count(*) AS n FROM x WHERE lower(trim(name)) IN (SELECT lower(trim(name)) FROM v) AND lower(trim(name)) NOT IN (SELECT lower(trim(venue_name)) FROM g) GROUP BY 1")
def cleaned_list(s, d):
    """J18."""
    v = venues(s, d)
    listed = v.select("name").unionByName(v.select(F.concat(F.lit("Gig "), "_ord").alias("name")))
    return screening.cleanup(listed, v, gigs(s, d)).groupBy("name").agg(F.count("*").alias("n"))


@compared(typed() + """SELECT contact_id, venue_id, split_part(name, ' ', 1) AS first, split_part(name, ' ', 2) AS last FROM c WHERE name <> '' AND email IN ('', 'undefined')""")
def enrichment_people(s, d):
    """X25, L2."""
    return screening.enrichment_names(contacts(s, d))


@compared(typed("a AS (SELECT c.*, CASE c._ord % 4 WHEN 0 THEN 'deferred' WHEN 1 THEN 'valid' ELSE 'unknown' END AS answer FROM c JOIN v USING (venue_id) WHERE verified = 'unknown' AND email <> '' AND v.status = 'pipelined')", "b AS (SELECT *, bool_or(answer = 'deferred') OVER (PARTITION BY venue_id ORDER BY _ord) AS stop FROM a)")
    + "SELECT contact_id, answer FROM b WHERE NOT stop")
def reverified_contacts(s, d):
    """L11."""
    answers = contacts(s, d).select("contact_id", F.element_at(F.array(*map(F.lit, ("deferred", "valid", "unknown", "unknown"))), (F.col("_ord") % 4 + 1).cast("int")).alias("status"))
    return screening.reverified(venues(s, d), contacts(s, d), answers).select("contact_id", "answer")


@compared(typed("n AS (SELECT venue_id, count(*) AS k, count(DISTINCT lower(email)) FILTER (email LIKE '%@%') AS e FROM c GROUP BY 1)")
    + """SELECT venue_id, CASE WHEN website = '' THEN 'web:none' ELSE 'web:ok' END || '|apollo:' || coalesce(k, 0) || '|li:0|emails:' || coalesce(e, 0) || CASE WHEN facebook = '' THEN '|form:no' ELSE '|form:yes' END AS evidence FROM v LEFT JOIN n USING (venue_id)""")
def check_evidence(s, d):
    """L12."""
    n = contacts(s, d).groupBy("venue_id").agg(F.count("*").alias("k"), F.count_distinct(F.when(F.contains("email", F.lit("@")), F.lower("email"))).alias("e"))
    return venues(s, d).join(n, "venue_id", "left").select("venue_id", screening.evidence("website", "k", F.lit(None), "e", "facebook").alias("evidence"))


@compared(typed("o AS (SELECT venue_id, contact_id AS org_id, title AS org_name, 1 + _ord % 3 AS phase, _ord % 60 AS score FROM c)", "p AS (SELECT *, contains(lower(org_name), 'hilton worldwide') AS chain FROM o)")
    + "SELECT venue_id, (list(org_id ORDER BY score DESC, phase, org_id))[1] AS org_id FROM p GROUP BY 1")
def best_orgs(s, d):
    """Contacts as organisations found."""
    c = contacts(s, d).select("venue_id", F.col("contact_id").alias("org_id"), F.col("title").alias("org_name"), (1 + F.col("_ord") % 3).alias("phase"), (F.col("_ord") % 60).alias("score"))
    return screening.best_org(c).select("venue_id", "org_id")


@compared(typed("{SCORED}") + """SELECT venue_id, website AS url, score FROM t5 WHERE score >= 6""")
def best_websites(s, d):
    """Of a directory page, the site and an unrelated page the best, if it fits."""
    v = venues(s, d).where("website <> '' and name <> ''")
    one = lambda url, place: v.select("venue_id", "name", url.alias("url"), F.lit(place).alias("place"))
    found = one(F.lit("https://www.yelp.com/biz/x"), 0).unionByName(one(F.col("website"), 1)).unionByName(one(F.lit("https://qqqqq.example.net/"), 2))
    return screening.best_website(found)


# ---------------------------------------------------------------- what a visit collects


@compared(sql("sites").rstrip() + f""", x AS (SELECT 's' AS site, unnest(['{{0}}/contact', '{{0}}/zz', '{{0}}/events', '{{0}}/a.pdf', '{{0}}/x.css', '{{0}}/about']) AS u, page_id % 20 AS g FROM sites),
y AS (SELECT DISTINCT g AS site, replace(u, '{{0}}', 'https://s' || g || '.example') AS url FROM x WHERE u NOT LIKE '%css'), z AS (SELECT *, CASE WHEN url LIKE '%pdf' THEN 'pdf' ELSE 'page' END AS kind, {RANK} AS score FROM y),
r AS (SELECT *, row_number() OVER (PARTITION BY site, kind ORDER BY score, length(url), url) AS rank FROM z) SELECT site, url, kind, rank FROM r WHERE rank <= CASE kind WHEN 'pdf' THEN 10 ELSE 2 END""")
def ranked_site_links(s, d):
    """K14."""
    base = F.concat(F.lit("https://s"), F.col("page_id") % 20, F.lit(".example"))
    rows = sites(s, d).select((F.col("page_id") % 20).alias("site"), F.explode(F.array(*(F.concat(base, F.lit(p)) for p in ("/contact", "/zz", "/events", "/a.pdf", "/x.css", "/about")))).alias("url"), F.lit("").alias("anchor"))
    return collect.ranked_links(rows, 2).select("site", "url", "kind", "rank")


@compared(typed("f AS (SELECT venue_id, CASE _ord % 2 WHEN 0 THEN 'facebook' ELSE 'instagram' END AS platform, CASE _ord % 5 WHEN 0 THEN 'search' WHEN 1 THEN 'crawl' WHEN 2 THEN 'homepage' WHEN 3 THEN 'odd' ELSE 'probe' END AS source, email AS url FROM c)",
    "r AS (SELECT *, CASE source WHEN 'homepage' THEN 1 WHEN 'crawl' THEN 4 WHEN 'probe' THEN 5 WHEN 'search' THEN 6 END AS k FROM f WHERE source <> 'odd')") + "SELECT venue_id, platform, (list(url ORDER BY k, url))[1] AS url, (list(source ORDER BY k, url))[1] AS source FROM r GROUP BY 1, 2")
def profile_precedence(s, d):
    """G6."""
    sources = ("search", "crawl", "homepage", "odd", "probe")
    c = contacts(s, d).select("venue_id", F.when(F.col("_ord") % 2 == 0, "facebook").otherwise("instagram").alias("platform"), F.element_at(F.array(*map(F.lit, sources)), (F.col("_ord") % 5 + 1).cast("int")).alias("source"), F.col("email").alias("url"))
    return collect.by_precedence(c)


@compared("SELECT event_id FROM events WHERE ts >= timestamp '2024-01-24 12:55:00' AND event_type = 'click'")
def live_reservations(s, d):
    """L4: reservations not older than 300 seconds."""
    e = table(s, d, "events").where("event_type = 'click'").select("event_id", F.col("ts").cast("timestamp").alias("reserved_at"))
    return collect.live_reservations(e, "2024-01-24 13:00:00", 300).select("event_id")


@compared(typed("u AS (SELECT venue_id AS q, _ord AS place, 'https://h' || (_ord % 9) || '.example.org/' || _ord AS url, 'h' || (_ord % 9) || '.example.org' AS host FROM c)", "o AS (SELECT *, row_number() OVER (PARTITION BY q, host ORDER BY place) AS k FROM u WHERE host <> 'h4.example.org')",
    "r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY place) AS n FROM o WHERE k = 1)") + "SELECT q AS query, place, url FROM r WHERE n <= 5")
def result_urls(s, d):
    """Of each query's results the first of each host, five at most."""
    rows = contacts(s, d).select(F.col("venue_id").alias("query"), F.col("_ord").alias("place"), F.concat(F.lit("https://h"), F.col("_ord") % 9, F.lit(".example.org/"), "_ord").alias("url"))
    return files.candidate_urls(rows, F.col("host") == "h4.example.org")


@compared(sql("sites").rstrip() + rf""", x AS (SELECT *, {HOST.format("url")} AS h FROM sites WHERE contains(lower(url), '/locations/reston-va')) SELECT venue_id, url FROM x""")
def city_pages(s, d):
    """The page of a venue's city on its own site."""
    page = sites(s, d)
    own = page.groupBy("venue_id").agg(F.first("url").alias("website")).withColumn("city", F.lit("Reston VA"))
    # Venues share hosts, so pages go with their venue.
    return screening.location_pages(page.select("venue_id", "url"), own)


@compared(sql("sites").rstrip() + ",\n" + NORMAL + r"""SELECT DISTINCT plain AS url FROM m WHERE regexp_matches(plain, '^[a-z]+://[^/]+/(contact-us|private_events/index.html)$')""")
def path_probes(s, d):
    """Common paths that exist."""
    page = sites(s, d)
    roots = page.select(F.lower(F.regexp_extract("url", "(?i)^([a-z]+://[^/?#]+)", 1)).alias("site")).distinct()
    return screening.probes(page.select("url"), roots, ("/contact-us", "/private_events/index.html", "/nowhere")).select("url").distinct()


@compared(sql("sites").rstrip() + rf""", x AS (SELECT {HOST.format("url")} AS h, count(*) AS n FROM sites GROUP BY 1), w AS (SELECT venue_id, {HOST.format("url")} AS h FROM sites) SELECT venue_id, n FROM w JOIN x USING (h)""")
def coverage_rows(s, d):
    """Crawl counts by host with their venues."""
    page = sites(s, d)
    counts = page.groupBy(text.host("url").alias("host")).agg(F.count("*").alias("n"))
    own = page.select("venue_id", F.col("venue_id").alias("name"), F.col("url").alias("website"))
    return screening.coverage(counts, own, "2024-01-01").select("venue_id", "n")


XML = "'<urlset><url><loc> ' || replace(url, '&', '&amp;') || ' </loc></url></urlset>'"


@compared(sql("sites").rstrip() + ",\n" + NORMAL + f""", k AS (SELECT DISTINCT plain || CASE WHEN frag <> '' THEN '#' || frag ELSE '' END AS url FROM m) SELECT url, {RANK} AS score FROM k""")
def sitemap_seeds(s, d):
    """An index of sitemaps, one of each site, followed to its pages."""
    page = sites(s, d)
    maps = page.select(F.concat(F.lit("https://maps.example.org/"), "page_id").alias("url"), F.concat(F.lit("<urlset><url><loc> "), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit(" </loc></url></urlset>")).alias("xml"))
    robots = F.get(files.robots_sitemaps(F.lit("User-agent: *\nSitemap: https://maps.example.org/index.xml\n")), F.lit(0))
    index = maps.agg(F.concat_ws("", F.collect_list(F.concat(F.lit("<sitemap><loc>"), "url", F.lit("</loc></sitemap>")))).alias("b")).select(robots.alias("url"), F.concat(F.lit("<sitemapindex>"), "b", F.lit("</sitemapindex>")).alias("xml"))
    ask = s.createDataFrame([("https://maps.example.org/",)], "url string")
    # A site's own map is asked for by the index; all are on one host here.
    return files.site_seeds(ask, maps.unionByName(index))


@compared(sql("sites").rstrip() + ",\n" + r"""x AS (SELECT page_id, regexp_extract(url, '^[A-Za-z]+://[^/?#]+') AS o FROM sites) SELECT page_id, o || '/events/' AS listed FROM x""")
def listing_pages(s, d):
    """Links of a directory page whose path fits."""
    return sites(s, d).select("page_id", F.array_join(files.listing_links("html", "url", ("^/events/$", "^/nowhere")), " ").alias("listed"))


@compared(sql("sites").rstrip() + ",\n" + MAIL + f"""
SELECT 'V-' || page_id AS venue_id, email, url AS first_url FROM z WHERE {RANK} < {len(vocab.PAGE_KEYWORDS)}""")
def swept(s, d):
    """Mailboxes of pages with a keyword in their address."""
    page = sites(s, d)
    hosts = page.select(F.concat(F.lit("V-"), "page_id").alias("venue_id"), F.col("url").alias("website"))
    # Venues share hosts, so pages go with their venue.
    return collect.swept_mailboxes(page.select("venue_id", "url", "html"), hosts, ()).select("venue_id", "email", "first_url")


@compared("""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents), b AS (SELECT word, count(*) AS n, count(DISTINCT doc_id) AS n_rows FROM w WHERE length(word) >= 4 GROUP BY 1 ORDER BY n DESC, word LIMIT 30),
h AS (SELECT DISTINCT word, doc_id FROM w JOIN b USING (word)), r AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY doc_id) AS k FROM h)
SELECT word, n, n_rows, string_agg(CAST(doc_id AS varchar), ',' ORDER BY doc_id) AS rows FROM r JOIN b USING (word) WHERE k <= 20 GROUP BY 1, 2, 3""")
def keyword_index(s, d):
    """A12 with its inverted list."""
    docs = table(s, d, "documents").withColumnRenamed("doc_id", "_ord")
    longer = F.filter(text.words("text"), lambda w: F.length(w) >= 4)
    return rel.word_index(docs, longer).withColumn("rows", F.array_join("rows", ","))


@compared(typed("b AS (SELECT category AS k, count(*) AS n FROM v GROUP BY 1 ORDER BY n DESC, k LIMIT 10)") + "SELECT string_agg(k || '=' || n, ';' ORDER BY n DESC, k) AS counts FROM b")
def category_histogram(s, d):
    """A13."""
    entries = F.transform(F.map_entries("counts"), lambda e: F.concat(e.key, F.lit("="), e.value.cast("string")))
    return rel.top_map(venues(s, d), F.col("category")).select(F.array_join(entries, ";").alias("counts"))


@compared(typed() + "SELECT DISTINCT lower(trim(name)) AS item FROM v WHERE name <> ''")
def list_round_trip(s, d):
    """Names written as lines and read back, distinct and without case."""
    path = new_folder(s, "lines")
    venues(s, d).select(F.concat(F.lit("  "), F.upper("name")).alias("value")).write.text(path)
    return files.read_list(s, path)


@compared(typed() + "SELECT venue_id, name, city, upscale AS upscale_score FROM v")
def json_round_trip(s, d):
    """Rows written as JSON lines in two appends and read back with a schema."""
    path, v = new_folder(s, "json"), venues(s, d).select("venue_id", "name", "city", "upscale_score", "status")
    files.write_rows(v.where("status = 'untouched'").drop("status"), path)
    files.write_rows(v.where("status <> 'untouched'").drop("status"), path, append=True)
    return s.read.schema("venue_id string, name string, city string, upscale_score double").json(path)


@compared("SELECT venue_id, issue, current, suggested, confidence FROM ({QUALITY})")
def issue_report(s, d):
    """The issue report as CSV, read back."""
    path = new_folder(s, "issues")
    files.write_issues(audit.quality_issues(venues(s, d)), path)
    back = s.read.option("header", True).schema("venue_id string, issue string, current string, suggested string, confidence string").csv(path)
    return back.withColumn("suggested", F.coalesce("suggested", F.lit("")))


@compared(typed() + """SELECT _ord, CASE WHEN _ord = (SELECT min(_ord) FROM v w WHERE lower(w.name) = lower(v.name)) THEN 1 ELSE 0 END AS first FROM v""")
def first_of_name(s, d):
    """K18 by name: the first row of each, as 1."""
    v = venues(s, d).withColumn("_k", F.lower("name"))
    first = rel.first_by(v, ["_k"], [F.col("_ord")]).select("_ord", F.lit(1).alias("first"))
    return v.select("_ord").join(first, "_ord", "left").select("_ord", F.coalesce("first", F.lit(0)).alias("first"))


def _filled() -> None:
    from . import oracle

    for name, q in ORACLE_SQL.items():
        ORACLE_SQL[name] = q.replace("{QUALITY}", oracle.ORACLE_SQL["quality_issues"]).replace("{SCORED}", oracle.SCORED)


_filled()


# ---------------------------------------------------------------- one log


@compared(r"""WITH l AS (SELECT conv_id, turn, role || ': ' || regexp_replace(text, '\s+', ' ', 'g') AS line FROM conversations),
h AS (SELECT *, regexp_extract(line, '^user: (\S+)', 1) AS head, regexp_extract(line, '^assistant: (\S+)', 1) AS a, regexp_extract(line, '(\S+)$', 1) AS z, row_number() OVER (ORDER BY conv_id, turn, line) AS k FROM l WHERE line IS NOT NULL),
s AS (SELECT *, count(*) FILTER (WHERE head <> '') OVER (ORDER BY k) AS session FROM h)
SELECT session, max(head) AS title, count(*) AS n_lines, min_by(a, k) FILTER (a <> '') AS reply, max_by(z, k) FILTER (z <> '') AS last_word FROM s WHERE session > 0 GROUP BY 1""")
def one_log_sessions(s, d):
    """W-b to W-d: the turns of all conversations as one log, whose sessions run over the ranges that tasks scan."""
    lines = table(s, d, "conversations").select(F.lit("log").alias("log"), "conv_id", "turn", F.concat("role", F.lit(": "), F.regexp_replace("text", r"\s+", " ")).alias("line"))
    found = audit.log_sessions(lines, ["log"], ["conv_id", "turn"], "line", r"^user: (\S+)", {"reply": r"^assistant: (\S+)"}, {"last_word": r"(\S+)$"})
    return found.drop("log")


# ---------------------------------------------------------------- bucketed tables


@compared(typed("""x AS (SELECT contact_id, venue_id, email, _ord FROM c)""", """y AS (SELECT CASE WHEN _ord % 2 = 0 THEN contact_id ELSE 'N-' || (_ord % 50) END AS contact_id, venue_id, 'new@site.example.org' AS email, _ord FROM c WHERE verified = 'unknown')""",
    "z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY contact_id ORDER BY _ord DESC) = 1)") + "SELECT * FROM x WHERE contact_id NOT IN (SELECT contact_id FROM z) UNION ALL SELECT * FROM z")
def bucketed_merge(s, d):
    """Contacts in buckets by id; a merge writes the buckets again that its ids are in, and the same batch again writes nothing."""
    rows = contacts(s, d).select("contact_id", "venue_id", "email", "_ord")
    news = contacts(s, d).where("verified = 'unknown'").select(F.when(F.col("_ord") % 2 == 0, F.col("contact_id")).otherwise(F.concat(F.lit("N-"), (F.col("_ord") % 50).cast("string"))).alias("contact_id"), "venue_id", F.lit("new@site.example.org").alias("email"), "_ord")
    table_ = BucketTable.create(rows, new_folder(s, "contacts"), ["contact_id"], 16)
    for _ in range(2):
        table_.change(news, lambda old, new: crud.merge(old, new, "contact_id"), ("news", 0))
    return table_.read()


@compared(typed() + "SELECT contact_id, email, verified AS step FROM c")
def candidate_log(s, d):
    """The log of candidates, appended batch by batch; a batch that comes again adds nothing."""
    rows = contacts(s, d).select("contact_id", "email", F.col("verified").alias("step"))
    log = BucketTable.create(rows.limit(0), new_folder(s, "log"), ["contact_id"], 8)
    halves = [rows.where("step in ('valid', 'pending')"), rows.where("step not in ('valid', 'pending')")]
    for batch, part in enumerate(halves):
        log.append(part, ("candidates", batch))
        log.append(part, ("candidates", batch))
    return log.read()
