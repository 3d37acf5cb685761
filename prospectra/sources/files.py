"""Sources and sinks: dumps, logs, sitemaps, robots files, documents, cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.text import col

VENUE_DUMP = "venue_id string, name string, category string, website string, city string, county string, state string, facebook string, instagram string, upscale_score double, zone_priority string, status string, distance_miles double"


def read_dump(spark: SparkSession, path: str, field: str, schema: str = VENUE_DUMP) -> DataFrame:
    """An API dump, one object with the array `field`, as rows. The schema is given: nothing is inferred."""
    return spark.read.schema(f"{field} array<struct<{schema}>>").option("multiLine", True).json(path).select(F.inline(field))


def write_rows(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines; appended ones are never deleted."""
    df.write.mode("append" if append else "overwrite").json(path)


def write_issues(issues: DataFrame, path: str) -> None:
    """The issue report."""
    issues.write.mode("overwrite").option("header", True).csv(path)


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """One item a line, lower-cased and distinct; blank lines are none."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("item")).where("item <> ''").distinct()


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of logs with what orders them: file, offset of the split that read the line, row within the split, line.

    A log of any size is read in splits by many tasks; rows of a split are numbered as they are read.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("offset"), F.col("value").alias("line"))
    return lines.withColumn("row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))


def sitemap_urls(xml: Column | str) -> Column:
    """The addresses of a sitemap; the tags are found by pattern, so broken files give what they have."""
    return F.transform(F.regexp_extract_all(col(xml), F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), 1), lambda u: text.unescape_html(F.trim(u)))


def sitemap_is_index(xml: Column | str) -> Column:
    return F.lower(col(xml)).contains("<sitemapindex")


def robots_sitemaps(body: Column | str) -> Column:
    """S13."""
    return F.regexp_extract_all(col(body), F.lit(r"(?im)^[ \t]*sitemap:[ \t]*(\S+)"), 1)


def site_seeds(spark_pages: DataFrame, sitemaps: DataFrame, depth: int = 3) -> DataFrame:
    """G1: addresses of sitemaps (url, xml), indexes followed to `depth`, with their scores; pages are the hosts asked for."""
    hosts = spark_pages.select(text.host("url").alias("h")).distinct()
    level = sitemaps.select("url", "xml").join(hosts, text.host("url") == F.col("h"), "left_semi")
    out = None
    for _ in range(depth):
        found = level.select(sitemap_is_index("xml").alias("index"), F.explode(sitemap_urls("xml")).alias("url"))
        leaves = found.where("not index").select("url")
        out = leaves if out is None else out.unionByName(leaves)
        level = sitemaps.join(found.where("index").select("url").distinct(), "url", "left_semi").select("url", "xml")
    return out.select(text.normalize_url("url").alias("url")).where("url is not null").distinct().withColumn("score", text.url_score("url"))


def cards(lines: DataFrame) -> DataFrame:
    """S15, S16, W-g: search cards (name, text) with rating, reviews, price and state."""
    r = text.rating("text")
    return lines.select("name", r.rating.alias("rating"), r.reviews.alias("reviews"), r.price.alias("price"), text.city_state("text").alias("place"))


def attributes(values: Column | str) -> Column:
    """Attributes of a place: 3 to 40 characters, lower-cased, none of the page's own words, distinct."""
    clean = F.transform(col(values), lambda v: F.lower(F.trim(v)))
    return F.array_distinct(F.filter(clean, lambda v: F.length(v).between(3, 40) & ~v.rlike("^(photos|reviews|about|overview|directions|save|share|suggest|more)")))


def candidate_urls(rows: DataFrame, skip: Column, limit: int = 5) -> DataFrame:
    """Of the result addresses of each query (query, place, url), the first of each host that is not skipped, `limit` at most."""
    from ..operators.relational import first_by

    once = first_by(rows.withColumn("host", text.host("url")).where((F.col("host") != "") & ~skip), ["query", "host"], [F.col("place")])
    ranked = once.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(F.struct("place", "url"))), 1, limit).alias("u"))
    return ranked.select("query", F.inline("u"))


def first_external(html: Column | str, page: Column | str) -> Column:
    """The first link to another host."""
    resolved = F.transform(text.links(html), lambda h: text.resolve(h, page))
    return F.try_element_at(F.filter(resolved, lambda u: u.isNotNull() & (text.host(u) != text.host(page))), F.lit(1))


def directory_page(html: Column | str) -> Column:
    """Name, address, website and profiles of a directory page, each by the first pattern that finds one."""
    h = col(html)
    got = lambda *p: F.coalesce(*(F.nullif(F.trim(F.regexp_extract(h, x, 1)), F.lit("")) for x in p))
    return F.struct(got(r"(?is)<h1[^>]*>([^<]+)</h1>", r"(?is)<title>([^<|]+)").alias("name"), got(r"(?is)<address[^>]*>([^<]+)", r'(?is)itemprop="streetAddress"[^>]*>([^<]+)').alias("address"), got(r'(?is)<a[^>]*href="(https?://[^"]+)"[^>]*>\s*(?:visit )?website').alias("website"), text.socials(h).alias("socials"))


def listing_links(html: Column | str, page: Column | str, patterns: tuple[str, ...]) -> Column:
    """Links of a page whose path fits one of the patterns, with one slash at the end, sorted."""
    resolved = F.transform(text.links(html), lambda h: F.concat(F.regexp_replace(text.resolve(h, page), r"[/]*([?#].*)?$", ""), F.lit("/")))
    return F.array_sort(F.array_distinct(F.filter(resolved, lambda u: u.isNotNull() & text.path(u).rlike("|".join(patterns)))))


def snippet_emails(c: Column | str) -> Column:
    """Short personal mailboxes of a snippet."""
    return F.filter(text.emails(c), lambda e: (F.length(e) < 60) & ~text.generic_email(e))
