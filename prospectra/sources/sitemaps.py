"""Sitemaps as XML, and the seeds of a crawl that they give.

Spark's XML parser reads each file, whatever its prefixes; what it reports as broken is read by pattern instead. Indexes are
followed in the order in which a site's crawler would meet them, level by level, within the limits that the protocol's users
keep: so many files a site, so many nested files an index, so many addresses a file. These bound what a site can bring, so
that a window over one site's addresses is small however large the table of files is.

Defined cases: a null or empty file lists nothing; entries without an address, addresses of other sites and files that are
not there are passed over (a file that is not there counts as tried); files that share an address count as the first by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import host, normalize_url, path, unescape_html, url_class, url_score
from .files import robots_sitemaps
from .shared import cut, settled

# Paths that sites use for what is looked for.
KNOWN_PATHS = ("/contact", "/contact-us", "/get-in-touch", "/inquiry", "/enquiry", "/events", "/private-events", "/special-events", "/book-an-event", "/book-event", "/private-dining", "/group-dining", "/groups", "/catering", "/weddings", "/meetings", "/corporate-events", "/banquets", "/team", "/staff", "/leadership", "/about", "/press")
XML = "url array<struct<loc:array<string>>>, sitemap array<struct<loc:array<string>>>, _corrupt_record string"


def listed_by_file(maps: DataFrame, most_nested: int = 50, most_urls: int = 5000) -> DataFrame:
    """url, map, page: the nested files and the addresses that each sitemap file (url, xml) lists, in order."""
    parsed = maps.where("xml is not null").select("url", "xml", F.from_xml("xml", XML, {"ignoreNamespace": "true", "mode": "PERMISSIVE"}).alias("x"))
    # What is broken is read again; the text of other files is done with.
    bad = F.col("x._corrupt_record").isNotNull()
    parsed = cut(parsed.select("url", F.when(bad, F.col("xml")).alias("xml"), F.col("x.url").alias("own"), F.col("x.sitemap").alias("nested"), bad.alias("bad")), "parsed")
    locs = lambda c: F.flatten(F.transform(F.coalesce(F.filter(c, lambda u: u.isNotNull() & u["loc"].isNotNull()), F.array().cast("array<struct<loc:array<string>>>")), lambda u: u["loc"]))
    plain = F.transform(F.regexp_extract_all("xml", F.lit(r"(?is)<(?:[a-z0-9_.-]+:)?loc>\s*(.*?)\s*</(?:[a-z0-9_.-]+:)?loc>"), 1), lambda u: unescape_html(F.trim(u)))
    # Of a broken file only the names tell indexes from pages.
    is_map = lambda u: F.contains(F.lower(u), F.lit("sitemap")) & F.endswith(F.split_part(F.lower(u), F.lit("?"), F.lit(1)), F.lit(".xml"))
    broken = F.col("bad")
    clean = lambda a, most: F.slice(F.filter(F.transform(a, lambda u: F.trim(F.regexp_replace(u, r"^\s+|\s+$", ""))), lambda u: u != ""), 1, most)
    nested = clean(F.when(broken, F.filter(plain, is_map)).otherwise(locs("nested")), most_nested)
    pages = clean(F.when(broken, F.filter(plain, lambda u: ~is_map(u))).otherwise(locs("own")), most_urls)
    return parsed.select("url", nested.alias("map"), pages.alias("page"))


def sitemap_entries(maps: DataFrame, most_nested: int = 50, most_urls: int = 5000) -> DataFrame:
    """url, kind (`page` or `map`), pos, loc of the entries of sitemap files (url, xml), in order; pos counts from 0 within a kind."""
    rows = listed_by_file(maps, most_nested, most_urls)
    one = lambda kind: rows.select("url", F.lit(kind).alias("kind"), F.posexplode(kind).alias("pos", "loc"))
    return one("page").unionByName(one("map"))


def _listed(sites: DataFrame, robots: DataFrame, maps: DataFrame, most_maps: int, most_nested: int, most_urls: int) -> DataFrame:
    """h, file, pos, loc: the addresses that each site's sitemaps list, with the place of the file among the site's."""
    own = maps.withColumn("url", normalize_url("url", False)).where("url is not null").groupBy("url").agg(F.min("xml").alias("xml"))
    entries = cut(listed_by_file(own, most_nested, most_urls), "entries")
    said = robots.where(F.lower(path("url")) == "/robots.txt").select(host("url").alias("h"), F.posexplode(robots_sitemaps("body")).alias("pos", "loc"))
    said = said.join(sites.select("h"), "h", "left_semi").select("h", F.lit(0).alias("parent"), (F.col("pos") + 1).alias("pos"), "loc")
    asked = sites.select("h", F.lit(0).alias("parent"), F.lit(0).alias("pos"), F.concat("origin", F.lit("/sitemap.xml")).alias("loc")).unionByName(said)
    seen = None
    for _ in range(most_maps):
        level = settled(asked.withColumn("url", normalize_url("loc", False))).where(host("url") == F.col("h"))
        level = level.groupBy("h", "url").agg(F.min(F.struct("parent", "pos")).alias("o"))
        used = F.lit(0)
        if seen is not None:
            level = level.join(seen.select("h", "url"), ["h", "url"], "left_anti").join(seen.groupBy("h").agg(F.count("*").alias("used")), "h", "left")
            used = F.coalesce("used", F.lit(0))
        place = F.row_number().over(Window.partitionBy("h").orderBy("o", "url"))
        level = cut(level.withColumn("file", (place + used).cast("int")).where(F.col("file") <= most_maps).select("h", "url", "file"), "level")
        if level.isEmpty():
            break
        seen = level if seen is None else seen.unionByName(level)
        asked = level.join(entries.select("url", "map"), "url").select("h", F.col("file").alias("parent"), F.posexplode("map").alias("pos", "loc"))
    if seen is None:
        return asked.select("h", F.col("parent").alias("file"), "pos", "loc").limit(0)
    # A file's row has its addresses: files are joined, not addresses.
    return seen.join(entries.select("url", "page"), "url").select("h", "file", F.posexplode("page").alias("pos", "loc"))


def discover_seeds(sites: DataFrame, robots: DataFrame, maps: DataFrame, limit: int = 80, most_maps: int = 12, most_nested: int = 50, most_urls: int = 5000) -> DataFrame:
    """G1: site, url, kind, score, place of what a crawl of each of sites (url) starts with.

    Known paths, and of the addresses in the site's sitemaps (that of its root, those that robots (url, body) names, and what
    these nest) those with a keyword, of at most two segments, or that are documents. Of pages the best `limit` stay and of documents
    a third as many, ten at least, by score, length and place.
    """
    own = sites.select(F.lower(F.regexp_extract("url", r"(?i)^(https?://[^/?#]+)", 1)).alias("origin"), host("url").alias("h")).where("h <> ''")
    own = cut(own.groupBy("h").agg(F.min("origin").alias("origin")), "sites")
    listed = settled(_listed(own, robots, maps, most_maps, most_nested, most_urls).select("h", normalize_url("loc").alias("url"), "file", "pos"))
    listed = settled(listed.where(host("url") == F.col("h")).select("h", "url", "file", "pos", url_score("url").alias("score")))
    segments = F.size(F.filter(F.split(path("url"), "/"), lambda x: x != ""))
    wanted: Column = (F.col("score") < len(vocab.PAGE_KEYWORDS)) | (segments <= 2) | (url_class("url") == "pdf")
    known = own.select("h", F.posexplode(F.array(*map(F.lit, KNOWN_PATHS))).alias("pos", "p"), "origin")
    known = known.select("h", normalize_url(F.concat("origin", "p")).alias("url"), F.lit(0).alias("file"), "pos")
    known = known.withColumn("score", url_score("url"))
    # File and place as one number, which is added up without sorting.
    order = F.shiftleft(F.col("file").cast("long"), 32) + F.col("pos")
    once = known.unionByName(listed.where(wanted)).groupBy("h", "url").agg(F.min(order).alias("o"), F.min("score").alias("score"))
    scored = settled(once.withColumn("kind", url_class("url"))).where("kind <> 'asset'")
    place = F.row_number().over(Window.partitionBy("h", "kind").orderBy("score", F.length("url"), "o"))
    most = F.when(F.col("kind") == "pdf", max(10, limit // 3)).otherwise(limit)
    return scored.withColumn("place", place).where(F.col("place") <= most).select(F.col("h").alias("site"), "url", "kind", "score", "place")
