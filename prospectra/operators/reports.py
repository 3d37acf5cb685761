"""Report rows from logs and contacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import col, hms_seconds


def log_contact(line: Column | str) -> Column:
    """Name, mailbox and status of a line about a contact."""
    t = col(line)
    status = F.when(F.contains(t, F.lit("invalid")), "invalid").when(F.contains(t, F.lit("catch-all")), "catch-all").when(F.contains(t, F.lit("unknown")), "unknown").when(F.contains(t, F.lit("do_not_mail")), "do_not_mail").otherwise("valid")
    return F.struct(F.trim(F.regexp_extract(t, r"Added(?: \([^)]*\))?: ([^<]*)<", 1)).alias("name"), F.regexp_extract(t, r"<([^>]+)>", 1).alias("email"), status.alias("status"))


def log_flags(line: Column | str) -> Column:
    """X20."""
    t = col(line)
    one = lambda test, name: F.when(test, F.lit(name))
    return F.filter(F.array(one(t.rlike(r"\[WARN\]"), "warning"), one(t.rlike(r"\[LOOKUP\] Found: \S*(facebook|yelp|tripadvisor)"), "bad lookup"), one(t.rlike(r"No website"), "no site")), lambda x: x.isNotNull())


def venue_flags(venues: DataFrame, contacts: DataFrame) -> DataFrame:
    """Of each venue what a reader should look at, joined in order: no contacts, none verified, mailboxes of other domains."""
    site = F.when(F.contains("website", F.lit("//")), F.lower(F.replace(F.split_part(F.split_part("website", F.lit("//"), F.lit(2)), F.lit("/"), F.lit(1)), F.lit("www."), F.lit("")))).otherwise("")
    less = lambda c: F.regexp_replace(c, r"\.[^.]*$", "")
    rows = contacts.join(venues.select("venue_id", site.alias("_site")), "venue_id")
    own = F.when(F.contains("email", F.lit("@")), F.lower(F.split_part("email", F.lit("@"), F.lit(2)))).otherwise("")
    off = (F.col("_site") != "") & (own != "") & (own != F.col("_site")) & (less(own) != less(F.col("_site"))) & ~own.isin(*vocab.REPORT_FREE_MAIL)
    odd = F.sort_array(F.collect_list(F.when(off, F.struct("_ord", F.concat(F.lit("Off-domain email: "), "email", F.lit(" (venue: "), "_site", F.lit(")")).alias("x")))))
    found = rows.groupBy("venue_id").agg(F.array_sort(F.collect_set("verified")).alias("statuses"), odd.alias("odd"))
    none = F.when(~F.array_contains("statuses", "valid"), F.array(F.concat(F.lit("No verified emails — only "), F.array_join("statuses", ", ")))).otherwise(F.array().cast("array<string>"))
    flags = F.when(F.col("statuses").isNull(), "No contacts found").otherwise(F.array_join(F.concat(none, F.col("odd.x")), "; "))
    return venues.select("venue_id").join(found, "venue_id", "left").select("venue_id", flags.alias("flags")).where("flags <> ''")


def report_totals(contacts: DataFrame, credits: DataFrame) -> DataFrame:
    """A17. Credits are the highest running total of each run, not the sum of running totals."""
    c = contacts.agg(F.count_distinct("venue_id").alias("venues"), F.count("*").alias("contacts"), F.count_if(F.col("verified") == "valid").alias("valid"))
    return c.join(credits.groupBy("run_id").agg(F.max("used").alias("u")).agg(F.sum("u").alias("credits")))  # one row each


def runtime_minutes(start: Column | str, end: Column | str, compat: str = "fixed") -> Column:
    """Minutes between two times of day; `fixed` takes an earlier end as one of the next day, `ref` gives a negative number."""
    d = hms_seconds(end) - hms_seconds(start)
    return F.floor((F.when((d < 0) & (compat == "fixed"), d + 86400).otherwise(d)) / 60)


def section(lines: DataFrame, by: str, order: str, text: str, start: str, end: str) -> DataFrame:
    """Lines strictly between a start and an end marker, by a running flag."""
    w = Window.partitionBy(by).orderBy(order)
    mark = F.when(F.col(text).rlike(start), 1).when(F.col(text).rlike(end), 0)
    rows = lines.withColumn("_m", mark).withColumn("_on", F.last("_m", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.where("_on = 1 and _m is null").drop("_m", "_on")


def paired(lines: DataFrame, by: str, order: str, text: str, marker: str) -> DataFrame:
    """W-f: around each marker line, the name above and the title below."""
    w = Window.partitionBy(by).orderBy(order)
    rows = lines.withColumns({"name": F.lag(text).over(w), "title": F.lead(text).over(w)})
    return rows.where(F.col(text).rlike(marker)).select(by, order, "name", "title")


def retained(manifest: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """X34."""
    return manifest.where(F.to_date("date") >= F.date_sub(F.lit(as_of).cast("date"), days))


def manifest(old: DataFrame, new: DataFrame) -> DataFrame:
    """Entries, newest first in `place`; an entry replaces one of the same file."""
    both = old.join(new.select("file"), "file", "left_anti").unionByName(new)
    return both.withColumn("place", F.row_number().over(Window.orderBy(F.desc("date"), "file")))  # one entry a run


def channel_totals(outreach: DataFrame) -> DataFrame:
    """The stored counters, derived from the log."""
    return outreach.where("channel <> ''").groupBy(F.concat(F.lit("count_"), "channel").alias("key")).agg(F.count("*").alias("value"))


def region_progress(cities: DataFrame) -> DataFrame:
    """Swept and all cities of each region, their venues and a rounded share, with the grand total."""
    share = F.floor(100 * F.count_if("swept") / F.count("*") + 0.5)
    return cities.rollup("region").agg(F.count_if("swept").alias("swept"), F.count("*").alias("cities"), F.sum("n_venues").alias("venues"), share.alias("percent"))


def search_plan(regions: DataFrame, words: tuple[str, ...]) -> DataFrame:
    """A few words for each region."""
    return regions.select("region", F.explode(F.array(*map(F.lit, words))).alias("word"))


def city_filter(rows: DataFrame, cities: tuple[str, ...]) -> DataFrame:
    """X30."""
    return rows.where(F.lower("city").rlike(vocab.pattern(c.lower() for c in cities))) if cities else rows
