"""Named queries that run the service's actions and small rules over whole tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators import collect, crud, graph, reports, screening
from ..sources.files import write_rows
from ..sources.projection import pick
from ..sources.shared import new_folder
from . import actions
from .catalog import Compared
from .oracle import ORACLE_SQL as NAMED_SQL
from .oracle import typed
from .queries import contacts, outreach, table, venues
from .webs import LINKS, web

BOOK = Compared()
QUERIES, ORACLE_SQL = BOOK.queries, BOOK.oracle_sql


def asked_names() -> str:
    """Names as people ask for them: as they are, in capitals, with words turned round, in part, wrong, or none."""
    forms = ["name", "upper(name)", "concat(split_part(name, ' ', 2), ' ', split_part(name, ' ', 1))", "substr(name, 2, 6)", "'no such place'", "concat(substr(name, 1, 4), ' zz')", "''"]
    return "CASE _ord % 7 " + " ".join(f"WHEN {k} THEN {f}" for k, f in enumerate(forms)) + " END"


@BOOK.compared(typed(f"""a AS (SELECT DISTINCT lower(trim({asked_names()})) AS name FROM v), b AS (SELECT lower(trim(name)) AS own, arg_min(venue_id, _ord) AS venue_id, min(_ord) AS o FROM v WHERE trim(name) <> '' GROUP BY 1)""")
    + """SELECT a.name, coalesce(min(CASE WHEN own = a.name THEN venue_id END), arg_min(venue_id, o)) AS venue_id FROM a JOIN b ON own = a.name OR len(list_filter(string_split(a.name, ' '), lambda w: w <> '' AND NOT contains(own, w))) = 0 WHERE a.name <> '' GROUP BY 1""")
def found_by_name(s, d):
    """Exact, else all words held; the first of the table."""
    v = venues(s, d)
    return screening.found_by_name(v.select(F.expr(asked_names()).alias("name")), v)


@BOOK.compared(typed() + """SELECT channel, count(*) AS n, count(DISTINCT venue_id) AS n_venues FROM (SELECT channel, venue_id FROM outreach UNION ALL SELECT 'phone', venue_id FROM v WHERE status = 'contacted') GROUP BY 1""")
def outreach_logged(s, d):
    """Events appended to the log of outreach, by channel."""
    rows = venues(s, d).where("status = 'contacted'").select(F.current_timestamp().alias("sent_at"), "venue_id", F.lit("phone").alias("channel"))
    log = actions.run("log_outreach", {"outreach": outreach(s, d)}, rows=rows)
    return log.groupBy("channel").agg(F.count("*").alias("n"), F.count_distinct("venue_id").alias("n_venues"))


@BOOK.compared("""SELECT 'append' AS mode, n_name AS venue, CAST(n_regionkey AS bigint) AS tier FROM nation UNION ALL SELECT 'append', r_name, 9 FROM region UNION ALL SELECT 'replace', r_name, 9 FROM region""")
def taste_updated(s, d):
    """Tastes appended to those there, or in their place."""
    old = table(s, d, "nation").select(F.col("n_name").alias("venue"), F.col("n_regionkey").cast("long").alias("tier"))
    new = table(s, d, "region").select(F.col("r_name").alias("venue"), F.lit(9).cast("long").alias("tier"))
    both = [actions.run("update_taste", {"taste": old}, rows=new, mode=m).select(F.lit(m).alias("mode"), "venue", "tier") for m in ("append", "replace")]
    return both[0].unionByName(both[1])


@BOOK.compared(NAMED_SQL["insert_absent"])
def bulk_loaded(s, d):
    """Discovered venues as a file of JSON rows, loaded into the table as new rows."""
    v = venues(s, d)
    new = v.where("status = 'untouched'").withColumn("venue_id", F.lit("")).withColumn("name", F.upper("name"))
    path = new_folder(s, "discovered")
    write_rows(new, path)
    old = v.where("status <> 'untouched'").withColumn("venue_id", F.concat(F.upper("state"), F.lit("-"), F.substring(F.upper("category"), 1, 4), F.lit("-"), "_ord"))
    read = s.read.schema(new.schema).json(path)
    return crud.insert_venues(old, read).select("venue_id", "name", "city", "state", "zone_priority", "_ord")


@BOOK.compared("""SELECT lower(kind) AS category, 'subject ' || k AS subject, 'body ' || k AS body FROM (SELECT CASE WHEN o_orderkey % 2 = 0 THEN upper(o_orderpriority) ELSE o_orderpriority END AS kind, o_orderkey AS k FROM orders) QUALIFY row_number() OVER (PARTITION BY lower(kind) ORDER BY k DESC) = 1""")
def templates_listed(s, d):
    """Of the templates of a category, whatever its case, the last."""
    kind = F.when(F.col("o_orderkey") % 2 == 0, F.upper("o_orderpriority")).otherwise(F.col("o_orderpriority"))
    rows = table(s, d, "orders").select(kind.alias("category"), F.concat(F.lit("subject "), "o_orderkey").alias("subject"), F.concat(F.lit("body "), "o_orderkey").alias("body"), F.col("o_orderkey").alias("_ord"))
    return actions.run("templates", {"templates": rows})


SCORE = "CASE WHEN c_custkey % 4 = 0 THEN 39 ELSE c_custkey % 60 + 30 END"


@BOOK.compared("""WITH x AS (SELECT c_custkey AS _ord, lower(trim(CASE c_custkey % 6 WHEN 0 THEN 'Oak Inn - King Suite' WHEN 1 THEN 'Grand Brewery Hall' WHEN 2 THEN ' X ' WHEN 3 THEN 'Blue Inn ' WHEN 4 THEN 'Cabin Fever' ELSE 'Hill - House' END)) AS n, CASE WHEN c_custkey % 4 = 0 THEN 39 ELSE c_custkey % 60 + 30 END AS score FROM customer)
SELECT _ord, coalesce(CASE WHEN length(n) < 3 THEN 'short' WHEN contains(n, 'brewery') OR contains(n, 'casino') THEN 'kind' WHEN n = 'blue inn' AND _ord % 2 = 1 THEN 'exists' WHEN contains(n, ' - ') AND contains(n, 'suite') THEN 'room listing' WHEN score < 40 THEN 'score' END, 'kept') AS reason FROM x""")
def taste_rejects(s, d):
    """X29."""
    name = F.element_at(F.array(*map(F.lit, ("Oak Inn - King Suite", "Grand Brewery Hall", " X ", "Blue Inn ", "Cabin Fever", "Hill - House"))), (F.col("c_custkey") % 6 + 1).cast("int"))
    rows = table(s, d, "customer").select(F.col("c_custkey").alias("_ord"), name.alias("name"), F.expr(SCORE).alias("score"))
    known = (F.trim("name") == "Blue Inn") & (F.col("_ord") % 2 == 1)
    return rows.select("_ord", F.coalesce(screening.taste_reject(known, F.col("score"), ("brewery", "casino")), F.lit("kept")).alias("reason"))


@BOOK.compared("""SELECT c_custkey AS _ord, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN 'ann@vendor.example bo@vendor.example' ELSE 'ann@vendor.example' END AS found FROM customer""")
def vendor_mailboxes(s, d):
    """Mailboxes of a vendor's domain on a page, unless the site is the vendor's own; roles and other domains are none."""
    page = F.when(F.col("c_custkey") % 2 == 0, "ann@vendor.example, noreply@vendor.example, bo@vendor.example").otherwise("Ann@Vendor.example x@other.example careers@vendor.example")
    rows = table(s, d, "customer").select(F.col("c_custkey").alias("_ord"), page.alias("page"), F.lit("vendor.example").alias("vendor"), F.when(F.col("c_custkey") % 3 == 0, "vendor.example").otherwise("venue.example").alias("site"))
    return rows.select("_ord", F.array_join(collect.other_domain_mailboxes("page", "vendor", "site"), " ").alias("found"))


@BOOK.compared("""SELECT c_custkey AS _ord, CASE c_custkey % 5 WHEN 0 THEN 'wine_bar' WHEN 1 THEN 'hotel' WHEN 2 THEN 'restaurant' WHEN 3 THEN 'museum' ELSE 'spa' END AS category FROM customer""")
def rechecked_categories(s, d):
    """Only restaurants are looked at again."""
    pair = F.element_at(F.array(*[F.struct(F.lit(c).alias("c"), F.lit(n).alias("n")) for c, n in (("Restaurant", "Hill Wine Bar"), ("hotel", "Hill Winery"), ("restaurant", "Chez Paris"), ("museum", "Oak Hotel"), ("spa", "Oak"))]), (F.col("c_custkey") % 5 + 1).cast("int"))
    rows = table(s, d, "customer").select(F.col("c_custkey").alias("_ord"), pair.alias("p"))
    return rows.select("_ord", screening.rechecked_category(F.col("p.c"), F.col("p.n")).alias("category"))


@BOOK.compared(typed() + "SELECT venue_id FROM v WHERE contains(lower(city), 'easton') OR contains(lower(city), 'mclean')")
def cities_filtered(s, d):
    """X30."""
    return reports.city_filter(venues(s, d), ("Easton", "McLean")).select("venue_id")


@BOOK.compared("SELECT r_name AS region, unnest(['gig', 'live music', 'band wanted']) AS word FROM region")
def search_plans(s, d):
    """A short list of words for each region."""
    return reports.search_plan(table(s, d, "region").select(F.col("r_name").alias("region")), ("gig", "live music", "band wanted"))


@BOOK.compared(typed() + """SELECT contact_id, CASE WHEN _ord % 3 = 0 THEN NULL ELSE 'm-' || _ord END AS match_id FROM c""")
def recovered_matches(s, d):
    """X11: answers by place in a batch go back to their requests, empty ones too."""
    rows = contacts(s, d).select("contact_id", F.floor(F.col("_ord") / 10).alias("batch"), (F.col("_ord") % 10).alias("place"), "_ord")
    matches = rows.select("batch", "place", F.when(F.col("_ord") % 3 != 0, F.concat(F.lit("m-"), "_ord")).alias("match_id"))
    return screening.recovered(rows.drop("_ord"), matches).select("contact_id", "match_id")


# ---------------------------------------------------------------- rules over varied inputs

STATE_WORD = r"\b(DC|MD|VA|PA|DE|WV)\b"
KINDS = "('luxury', 'hotel', 'fine', 'dining', 'restaurant', 'french', 'european', 'historic', 'bistro', 'private', 'club', 'wine', 'bar', 'country', 'winery', 'yacht', 'upscale', 'italian', 'boutique', 'inn', 'museum', 'event', 'space', 'art', 'gallery')"


@BOOK.compared(typed(r"""a AS (SELECT venue_id, city AS raw, '12 Main St, ' || city || ', ' || state AS t, CASE _ord % 3 WHEN 0 THEN 'luxury Hotel ' WHEN 1 THEN '' ELSE 'wine bar in ' END || city || ' ' || state AS q, CASE WHEN _ord % 2 = 0 THEN 'seen in ' ELSE 'plays at ' END || city || ', ' || state || ' often' AS n FROM v)""",
    rf"""b AS (SELECT *, regexp_extract(t, '{STATE_WORD}', 1) AS s1, regexp_replace(regexp_extract(t, '^(.*?)\b(DC|MD|VA|PA|DE|WV)\b', 1), '[\s,]+$', '') AS p1, regexp_extract(q, '{STATE_WORD}', 1) AS s2, regexp_replace(regexp_extract(q, '^(.*?)\b(DC|MD|VA|PA|DE|WV)\b', 1), '[\s,]+$', '') AS p2,
  trim(regexp_extract(n, '((in |at )?[A-Z][a-z]+(\s[A-Z][a-z]+)*,?\s*(VA|MD|DC|PA))', 1)) AS x FROM a)""")
    + f"""SELECT venue_id, CASE WHEN regexp_matches(trim(string_split(p1, ',')[-1]), '^[0-9]') THEN '' ELSE trim(string_split(p1, ',')[-1]) END AS city, s1 AS state, array_to_string(list_filter(regexp_split_to_array(p2, '\\s+'), lambda w: w <> '' AND lower(w) NOT IN {KINDS}), ' ') AS asked, s2 AS asked_state,
 nullif(regexp_replace(x, '^(in|at) ', ''), '') AS noted, CASE WHEN contains(lower(raw), 'annapolis') OR contains(lower(raw), 'reston') THEN 'green' WHEN contains(lower(raw), 'baltimore') THEN 'yellow' ELSE 'default' END AS zone FROM b""")
def every_place(s, d):
    """T21 to T23, C11 over every venue: cities of several words, none, numbers, and ones with a state in them."""
    v = venues(s, d)
    place = text.city_state(F.concat(F.lit("12 Main St, "), "city", F.lit(", "), "state"))
    head = F.when(F.col("_ord") % 3 == 0, "luxury Hotel ").when(F.col("_ord") % 3 == 1, "").otherwise("wine bar in ")
    asked = text.query_place(F.concat(head, "city", F.lit(" "), "state"))
    noted = text.notes_place(F.concat(F.when(F.col("_ord") % 2 == 0, "seen in ").otherwise("plays at "), "city", F.lit(", "), "state", F.lit(" often")))
    return v.select("venue_id", place.city.alias("city"), place.state.alias("state"), asked.city.alias("asked"), asked.state.alias("asked_state"), noted.alias("noted"), rules.zone("city").alias("zone"))


@BOOK.compared("""WITH x AS (SELECT c_custkey AS _ord, CASE WHEN c_custkey % 2 = 0 THEN 'id' ELSE '' END AS id, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'www.V' || c_custkey || '.example' ELSE 'other.example' END AS d, CASE c_custkey % 5 WHEN 0 THEN '' ELSE 'v' || c_custkey || '.example' END AS site FROM customer)
SELECT _ord, CASE WHEN id <> '' THEN 10 ELSE 0 END + CASE WHEN d <> '' THEN 5 ELSE 0 END - CASE WHEN _ord % 7 = 0 THEN 20 ELSE 0 END + CASE WHEN site <> '' AND replace(lower(d), 'www.', '') = site THEN 50 ELSE 0 END AS score,
 CASE _ord % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true ELSE false END AS content, _ord % 4 <> 3 AS branded FROM x""")
def org_details(s, d):
    """Scores by id, domain and chain; names in a page's text, in half of their words, or not; brands."""
    k = F.col("c_custkey")
    own = F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("www.V"), k.cast("string"), F.lit(".example"))).otherwise("other.example")
    site = F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("v"), k.cast("string"), F.lit(".example")))
    score = rules.org_score(F.when(k % 2 == 0, "id").otherwise(""), own, F.when(k % 7 == 0, "Hilton Worldwide Holdings").otherwise("Oak Tavern"), site)
    body = F.element_at(F.array(*map(F.lit, ("<p>Welcome to Blue Ridge Winery</p>", "<p>Nothing here</p>", "the ridge <b>blue</b>", "<a href='blueridgewinery'>x</a>"))), (k % 4 + 1).cast("int"))
    org = F.element_at(F.array(*map(F.lit, ("Blue Ridge Winery by Hilton", "The Blue Ridge Estate", "Blue Ridge", "Harbor Winery"))), (k % 4 + 1).cast("int"))
    return table(s, d, "customer").select(k.alias("_ord"), score.alias("score"), rules.content_matches(F.lit("Blue Ridge Winery"), body).alias("content"), rules.org_matches(org, F.lit("Blue Ridge Winery")).alias("branded"))


NEW_STEP, NEW_STATUS = pick("_ord", "emails", "people", "website", "form", "press"), pick("_ord", "DONE", "FAILED", "ODD", "SKIPPED", "done", "")


@BOOK.compared(typed(f"sa AS (SELECT venue_id, _ord, {NEW_STEP} AS step, {NEW_STATUS} AS st, check_status AS s FROM v)",
    r"sb AS (SELECT *, unnest(['website', 'emails', 'social', 'form', 'people', 'location', 'press']) AS k FROM sa)",
    r"""sc AS (SELECT *, regexp_extract('|' || s, '\|' || k || ':([^|:]*)', 1) AS old, regexp_extract('|' || s, '\|' || k || ':[^|:]*:([^|]*)', 1) AS told FROM sb)""")
    + """SELECT venue_id, k AS step, CASE WHEN k = step AND st IN ('DONE', 'FAILED', 'SKIPPED') THEN st ELSE old END AS status, CASE WHEN k = step AND st IN ('DONE', 'FAILED', 'SKIPPED') THEN '' ELSE told END AS detail FROM sc WHERE old <> '' OR (k = step AND st IN ('DONE', 'FAILED', 'SKIPPED'))""")
def step_merges(s, d):
    """Every step of every venue after one of them is saved, with statuses that are known and ones that are not."""
    saved = crud.saved_step("check_status", F.expr(NEW_STEP), F.expr(NEW_STATUS))
    return venues(s, d).select("venue_id", F.explode(saved).alias("step", "v")).select("venue_id", "step", "v.status", "v.detail")


@BOOK.compared(f"""WITH {LINKS}, rows AS (SELECT s, p, q FROM hops WHERE p % 7 <> 3 UNION ALL SELECT s, NULL, q FROM (SELECT DISTINCT s, q FROM hops) QUALIFY row_number() OVER (PARTITION BY s ORDER BY q) <= 6)
SELECT 's' || s || '.example.org' AS host, count(DISTINCT coalesce(p, -1)) AS n_pages, count(*) AS n_links, count(*) FILTER (WHERE q % 5 = 1) AS n_fragments, count(*) FILTER (WHERE q % 23 = 5) AS n_files FROM rows GROUP BY s""")
def web_coverage(s, d):
    """A16 over the web of the lines: links, fragments and files of each host."""
    return graph.host_coverage(web(s, d))
