"""What a visit to a site collects: ranked links, forms, profiles by precedence, mailboxes of other domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, vocab
from ..functions.text import col
from ..sources.shared import settled


def ranked_links(links: DataFrame, limit: int) -> DataFrame:
    """Of each site's links (site, url, anchor), pages up to `limit` and documents up to max(10, limit // 3), best keyword first; assets go."""
    rows = links.withColumns({"kind": text.url_class("url"), "score": text.url_score("url", "anchor")}).where("kind <> 'asset'")
    best = rows.groupBy("site", "url", "kind").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("site", "kind").orderBy("score", F.length("url"), "url"))
    return best.withColumn("rank", rank).where(F.col("rank") <= F.when(F.col("kind") == "pdf", max(10, limit // 3)).otherwise(limit))


def union_distinct(*parts: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of the parts one after another, the first of each key."""
    from .relational import first_by

    both = None
    for k, p in enumerate(parts):
        p = p.withColumn("_part", F.lit(k))
        both = p if both is None else both.unionByName(p, allowMissingColumns=True)
    return first_by(both, [key], [F.col("_part"), F.col(order)]).drop("_part")


def all_names(venues: DataFrame, gigs: DataFrame) -> DataFrame:
    """Distinct names of venues and gigs, sorted."""
    own = lambda d, c: d.select(F.lower(F.trim(c)).alias("name")).where("name <> ''")
    return own(venues, "name").union(own(gigs, "venue_name")).distinct().orderBy("name")


def form_kept(url: Column | str, has_form: Column) -> Column:
    """A contact page is kept if a form is there, or if its address says so."""
    return has_form | F.lower(text.path(url)).rlike("contact|inquir|book|event")


def by_precedence(found: DataFrame, order: tuple[str, ...] = ("homepage", "contact", "location", "crawl", "probe", "search")) -> DataFrame:
    """Of the profiles found (venue_id, platform, source, url), that of the first source in order."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("source"))
    known = found.where(rank > 0)
    return known.groupBy("venue_id", "platform").agg(F.min_by(F.struct("url", "source"), F.struct(rank.alias("r"), "url")).alias("b")).select("venue_id", "platform", "b.*")


def other_domain_mailboxes(pages: DataFrame, vendor_domain: str, site_domain: str, roles: tuple[str, ...] = ("noreply@", "no-reply@", "webmaster@", "privacy@", "careers@", "jobs@")) -> Column:
    """Mailboxes of a vendor's domain, only if it is not the site's, less a few roles."""
    found = F.filter(text.emails(pages), lambda e: F.endswith(e, F.concat(F.lit("@"), col(vendor_domain))) & ~e.rlike("^(" + vocab.pattern(roles) + ")"))
    return F.when(col(vendor_domain) != col(site_domain), found).otherwise(F.array().cast("array<string>"))


def swept_mailboxes(pages: DataFrame, sites: DataFrame, paths: tuple[str, ...]) -> DataFrame:
    """Mailboxes of the fetched pages of each site that are a fixed path or have a keyword in their address.

    Sites may share a host: pages that name their venue (venue_id) are that venue's only, others are of all venues on their host.
    """
    keys = ["_h", "venue_id"] if "venue_id" in pages.columns else ["_h"]
    own = sites.select("venue_id", text.site_host("website").alias("_h"))
    chosen = pages.where(text.path("url").isin(*paths) | (text.url_score("url") < len(vocab.PAGE_KEYWORDS)))
    # Read once a page, however many venues its host has.
    read = settled(chosen.select(*keys[1:], "url", text.host("url").alias("_h"), text.emails("html").alias("_e")))
    rows = read.join(own, keys).select("venue_id", "url", F.explode("_e").alias("email"))
    return rows.groupBy("venue_id", "email").agg(F.min("url").alias("first_url"), F.count_distinct("url").alias("n_sources"))


def live_reservations(inflight: DataFrame, now: str, seconds: int = 300) -> DataFrame:
    """L4: reservations that have not run out."""
    age = F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros("reserved_at")
    return inflight.where(age <= seconds * 1_000_000)


def misses_in_a_row(rows: DataFrame, by: str, order: str, found: str, stop: int = 10) -> DataFrame:
    """Rows up to and with the one at which `stop` misses in a row are full."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumn("_hits", F.sum(F.col(found).cast("int")).over(w))
    run = run.withColumn("_run", F.sum(1 - F.col(found).cast("int")).over(Window.partitionBy(by, "_hits").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
    full = F.sum((F.col("_run") >= stop).cast("int")).over(w) - (F.col("_run") >= stop).cast("int")
    return run.withColumn("_full", full).where("_full = 0").drop("_hits", "_run", "_full")
