"""Named queries over a web of pages that the tables' lines make, each beside its SQL.

A supplier is a host and each of its parts a page; a page links to the parts that follow it among the supplier's lines.
The SQL never reads a page: it has the links from the lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, vocab
from ..operators import graph
from ..sources import sitemaps
from ..sources.projection import pick
from ..sources.shared import cut
from .catalog import Compared
from .queries import table

BOOK = Compared()
QUERIES, ORACLE_SQL = BOOK.queries, BOOK.oracle_sql

TOPIC = pick("{0}", "private-events", "menu", "contact-us", "a", "gallery", "Team", "press_room", "weddings", "story", "careers/list", "about")
LABEL = pick("{0}", "Read more", "Book a room", "", "Our <b>staff</b>", "Map", "Host an event", "More")


def address(part: str, host: str = "s") -> str:
    """The address of a part's page, in SQL that both engines read."""
    return f"concat('https://', CASE WHEN {host} % 2 = 0 THEN 'www.' ELSE '' END, 's', cast({host} AS varchar(20)), '.example.org/', {TOPIC.format(part)}, '-', cast({part} AS varchar(20)), CASE WHEN {part} % 23 = 5 THEN '.pdf' ELSE '' END)"


LINKS = """steps AS (SELECT l_suppkey AS s, l_partkey AS p, lead(l_partkey) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS q FROM lineitem),
hops AS (SELECT DISTINCT s, p, q FROM steps WHERE q IS NOT NULL)"""
HREF = f"concat({address('q')}, CASE WHEN q % 5 = 1 THEN '#cta' ELSE '' END)"


def web(s: SparkSession, d: str) -> DataFrame:
    """s, p, url, html of the pages that can be fetched: each host's front page (p null) links to its first six parts, and of the parts' pages a seventh is missing."""
    table(s, d, "lineitem").createOrReplaceTempView("_lines")
    # The links are narrow and found once; texts are made where they are read.
    steps = s.sql(f"WITH {LINKS.replace('lineitem', '_lines')} SELECT * FROM steps WHERE q IS NOT NULL")
    hops = cut(steps.groupBy("s", "p").agg(F.sort_array(F.collect_set("q")).alias("found")), "hops")
    listed = lambda rows: rows.select("s", "p", F.expr(f"""array_join(transform(found, q -> concat('<a class="n" href="', {HREF}, '">', {LABEL.format('q')}, '</a>\\n')), '')""").alias("html"))
    parts = listed(hops.where("p % 7 <> 3")).withColumn("url", F.expr(address("p")))
    first = hops.groupBy("s").agg(F.flatten(F.collect_list(F.slice("found", 1, 6))).alias("found"))
    first = first.select("s", F.lit(None).cast("long").alias("p"), F.slice(F.sort_array(F.array_distinct("found")), 1, 6).alias("found"))
    front = listed(first).withColumn("url", F.expr("concat('https://', CASE WHEN s % 2 = 0 THEN 'www.' ELSE '' END, 's', cast(s AS string), '.example.org/')"))
    return parts.unionByName(front)


def starts(s: SparkSession, d: str) -> DataFrame:
    """Each host's front page, and as if from a sitemap every nineteenth part."""
    parts = table(s, d, "lineitem").select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p")).distinct()
    front = parts.select("s").distinct().select(F.expr("concat('https://', CASE WHEN s % 2 = 0 THEN 'www.' ELSE '' END, 's', cast(s AS string), '.example.org')").alias("url"), F.lit(0).alias("depth"), F.lit(-1).alias("score"), F.lit(-1).cast("long").alias("ord"))
    listed = parts.where("p % 19 = 0").withColumn("url", F.expr(address("p"))).select("url", F.lit(1).alias("depth"), text.url_score("url").alias("score"), F.col("p").alias("ord"))
    return front.unionByName(listed)


def rank(url: str, label: str = "''") -> str:
    hay = f"replace(lower({url} || ' ' || {label}), '_', '-')"
    return "CASE " + " ".join(f"WHEN contains({hay}, '{w}') THEN {k}" for k, w in enumerate(vocab.PAGE_KEYWORDS)) + f" ELSE {len(vocab.PAGE_KEYWORDS)} + least(length({url}) // 40, 10) END"


FRONTIER = f"""WITH RECURSIVE {LINKS},
rows AS (SELECT s, p, q FROM hops WHERE p % 7 <> 3 UNION ALL SELECT s, NULL, q FROM (SELECT DISTINCT s, q FROM hops) QUALIFY row_number() OVER (PARTITION BY s ORDER BY q) <= 6),
kids AS (SELECT s, coalesce(p, -1) AS p, list({{'score': score, 'len': length(href), 'q': q, 'key': key}} ORDER BY q) FILTER (WHERE q % 23 <> 5) AS kids, true AS here FROM
 (SELECT s, p, q, {HREF} AS href, {address('q')} AS key, {rank(HREF, "regexp_replace(" + LABEL.format('q') + ", '<[^>]*>', ' ', 'g')")} AS score FROM rows) GROUP BY s, p),
begins AS (SELECT s, list({{'score': score, 'depth': depth, 'len': length(url), 'n': p, 'p': p, 'key': url}}) AS queue FROM
 (SELECT DISTINCT l_suppkey AS s, -1 AS p, 0 AS depth, -1 AS score, 'https://' || CASE WHEN l_suppkey % 2 = 0 THEN 'www.' ELSE '' END || 's' || l_suppkey || '.example.org/' AS url FROM lineitem
  UNION ALL SELECT DISTINCT s, p, 1, {rank(address('p'))}, {address('p')} FROM (SELECT l_suppkey AS s, l_partkey AS p FROM lineitem WHERE l_partkey % 19 = 0 AND l_partkey % 23 <> 5)) GROUP BY s),
walk AS (SELECT s, CAST(0 AS bigint) AS tries, CAST(0 AS bigint) AS got, CAST([] AS varchar[]) AS seen, CAST(1000000000 AS bigint) AS n, CAST(queue AS struct(score integer, depth integer, len bigint, n bigint, p bigint, key varchar)[]) AS queue,
  CAST(NULL AS struct(score integer, depth integer, len bigint, n bigint, p bigint, key varchar)) AS x, false AS ok FROM begins
 UNION ALL SELECT s, tries + 1, got + CASE WHEN here THEN 1 ELSE 0 END, list_append(seen, top.key), n + 1000000000,
  list_filter(list_concat(queue, CASE WHEN here AND top.depth < 2 THEN list_transform(coalesce(kids, []), lambda k: {{'score': k.score, 'depth': top.depth + 1, 'len': k.len, 'n': n + k.q, 'p': k.q, 'key': k.key}}) ELSE [] END), lambda y: y.key <> top.key AND NOT list_contains(seen, y.key)), top, here
 FROM (SELECT w.*, kids, coalesce(kids.here, false) AS here FROM (SELECT *, list_sort(queue)[1] AS top FROM walk WHERE len(queue) > 0 AND got < 8 AND tries < 32) w LEFT JOIN kids ON kids.s = w.s AND kids.p = w.top.p))
"""


@BOOK.compared(FRONTIER + "SELECT 's' || s || '.example.org' AS site, tries - 1 AS step, x.key AS url, x.depth AS depth, x.score AS score, ok FROM walk WHERE tries > 0")
def crawl_frontier(s, d):
    """Each host's crawl of at most 8 pages and 32 attempts, best first."""
    return graph.frontier(web(s, d), starts(s, d), max_pages=8)


# ---------------------------------------------------------------- sitemaps

ORIGIN = "concat('https://', CASE WHEN s % 2 = 0 THEN 'www.' ELSE '' END, 's', cast(s AS varchar(20)), '.example.org')"
DEEP = f"concat({ORIGIN}, CASE WHEN p % 2 = 1 THEN '/a/b/c-' ELSE '/x/y/contact-' END, cast(p AS varchar(20)))"


def sitemap_files(parts: DataFrame) -> DataFrame:
    """url, xml of hosts' parts (s, p): an index with three parts, a file with prefixes, a broken file, or none, by host; and another file that robots name."""
    parts = parts.withColumns({"a": F.expr(address("p")), "deep": F.expr(DEEP), "o": F.expr(ORIGIN)})
    entry = lambda tag, u: F.concat(F.lit(f"<{tag}url>\n <{tag}loc> "), u, F.lit(f" </{tag}loc></{tag}url>"))
    body = lambda rows, entry, by=("s", "o"): rows.groupBy(*by).agg(F.array_join(F.sort_array(F.collect_list(entry)), "").alias("b"))
    file = lambda rows, name, head, tail: rows.select(F.concat("o", F.lit(name) if isinstance(name, str) else name).alias("url"), F.concat(F.lit(head), "b", F.lit(tail)).alias("xml"))
    index = parts.where("s % 4 = 0").select("s", "o").distinct().withColumn("b", F.array_join(F.transform(F.array(*map(F.lit, "012")), lambda j: F.concat(F.lit("<sitemap><loc>"), F.col("o"), F.lit("/maps/"), j, F.lit(".xml</loc></sitemap>"))), ""))
    third = body(parts.where("s % 4 = 0").withColumn("j", (F.col("p") % 3).cast("string")), entry("", F.col("a")), ("s", "o", "j"))
    return (
        file(index, "/sitemap.xml", '<?xml version="1.0"?><sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">', "</sitemapindex>")
        .unionByName(file(third, F.concat(F.lit("/maps/"), "j", F.lit(".xml")), "<urlset>", "</urlset>"))
        .unionByName(file(body(parts.where("s % 4 = 1 and p % 5 < 3"), F.concat(entry("sm:", F.col("a")), entry("sm:", F.col("deep")))), "/sitemap.xml", '<sm:urlset xmlns:sm="http://x">', "</sm:urlset>"))
        .unionByName(file(body(parts.where("s % 4 = 2 and p % 5 < 3"), entry("", F.col("a"))), "/sitemap.xml", "<urlset>", "<url><loc>"))
        .unionByName(file(body(parts.where("p % 2 = 0"), entry("", F.concat("a", F.lit("#top")))), "/extra.xml", "<urlset>", "</urlset>"))
    )


@BOOK.compared(f"""WITH parts AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem),
k AS (SELECT unnest(['contact', 'contact-us', 'get-in-touch', 'inquiry', 'enquiry', 'events', 'private-events', 'special-events', 'book-an-event', 'book-event', 'private-dining', 'group-dining', 'groups', 'catering', 'weddings', 'meetings', 'corporate-events', 'banquets', 'team', 'staff', 'leadership', 'about', 'press']) AS path),
u AS (SELECT s, {address('p')} AS url FROM parts WHERE s % 4 = 0 OR (s % 4 IN (1, 2) AND p % 5 < 3) UNION SELECT s, {DEEP} FROM parts WHERE s % 4 = 1 AND p % 5 < 3 AND p % 2 = 0
 UNION SELECT s, {address('p')} || '#top' FROM parts WHERE p % 2 = 0 AND s % 3 <> 0 UNION SELECT s, {ORIGIN} || '/' || path FROM (SELECT DISTINCT s FROM parts), k)
SELECT 's' || s || '.example.org' AS site, url, CASE WHEN url LIKE '%.pdf' OR url LIKE '%.pdf#top' THEN 'pdf' ELSE 'page' END AS kind, {rank('url')} AS score FROM u""")
def site_seeds(s, d):
    """Seeds from known paths, indexes, files with prefixes, broken files, and files that robots name."""
    parts = cut(table(s, d, "lineitem").select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p")).distinct(), "parts")
    hosts = parts.select("s").distinct()
    ask = hosts.select(F.expr(f"concat({ORIGIN}, '/welcome')").alias("url"))
    robots = hosts.where("s % 3 <> 0").select(F.expr(f"concat({ORIGIN}, '/robots.txt')").alias("url"), F.concat(F.lit("User-agent: *\nSitemap: https://other.example.org/extra.xml\n  SITEMAP:"), F.expr(ORIGIN), F.lit("/extra.xml\n")).alias("body"))
    return sitemaps.discover_seeds(ask, robots, sitemap_files(parts), limit=100_000).drop("place")
