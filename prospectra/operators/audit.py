"""Audits, log sessions, cache lookups and usage counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.coerce import text
from ..functions.rules import blocked_domain, canonical_category, website_score
from ..functions.text import step_map
from .ranges import running

STEPS = ("website", "emails", "social", "form", "people", "location")
DONE, FAILED = ("DONE", "SKIPPED"), ("FAILED",)


def step_audit(venues: DataFrame) -> DataFrame:
    """L1: steps done, failed and missing of each pipelined venue; an unknown status is missing."""
    rows = venues.where("status = 'pipelined'").select("venue_id", step_map("check_status").alias("m"))
    status = lambda s: F.col("m")[s].status
    steps = F.array(*map(F.lit, STEPS))
    held = lambda *names: F.filter(steps, lambda s: F.coalesce(status(s).isin(*names), F.lit(False)))
    out = rows.select("venue_id", held(*DONE).alias("done"), held(*FAILED).alias("failed"), F.filter(steps, lambda s: ~F.coalesce(status(s).isin(*DONE, *FAILED), F.lit(False))).alias("missing"))
    return out.withColumn("complete", F.size("done") == len(STEPS))


def step_summary(audit: DataFrame) -> DataFrame:
    """A10: missing and failed from incomplete venues, done from complete ones only."""
    part = lambda c, when: F.transform(F.when(when, F.col(c)).otherwise(F.array().cast("array<string>")), lambda s: F.struct(s.alias("step"), F.lit(c).alias("kind")))
    rows = audit.select(F.inline(F.concat(part("done", F.col("complete")), part("failed", ~F.col("complete")), part("missing", ~F.col("complete")))))
    return rows.groupBy("step").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in ("done", "failed", "missing")))


def pending_enrichment(contacts: DataFrame) -> DataFrame:
    """L2."""
    return contacts.where((F.col("name") != "") & F.col("email").isin("", "undefined"))


def quality_issues(venues: DataFrame) -> DataFrame:
    """One row an issue: issue, current, suggested, confidence."""
    now = F.replace(F.lower(text("category", "other")), F.lit(" "), F.lit("_"))
    rows = venues.select("venue_id", now.alias("now"), canonical_category("category", "name").alias("canon"), F.trim("website").alias("site"), website_score("name", F.trim("website")).alias("score"), blocked_domain(F.trim("website")).alias("listed"))
    one = lambda test, *x: F.when(test, F.struct(*(F.col(v).alias(k) if v in ("now", "canon", "site") else F.lit(v).alias(k) for k, v in zip(("issue", "current", "suggested", "confidence"), x, strict=True))))
    wrong = (F.col("canon") != "other") & (F.col("canon") != F.col("now")) & (F.col("now").isin("restaurant", "rest", "other", "recreation") | F.col("canon").isin(*vocab.SAFE_CATEGORIES))
    site = F.col("site") != ""
    found = F.array(one(wrong, "category", "now", "canon", "high"), one(site & F.col("listed"), "website_directory", "site", "", "high"), one(site & ~F.col("listed") & (F.col("score") < 6), "website_mismatch", "site", "recheck", "review"))
    return rows.select("venue_id", F.inline(F.filter(found, lambda x: x.isNotNull())))


def sessions(lines: DataFrame, by: str, order: str, text: str, header: str, attributes: dict[str, str]) -> DataFrame:
    """W-b to W-d: lines of a log grouped under the latest header; the first value of each attribute and the last header text.

    header and attributes are patterns with one group: the grammar is a parameter.
    """
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    head = F.regexp_extract(text, header, 1)
    rows = lines.withColumn("_head", head).withColumn("session", F.count_if(F.col("_head") != "").over(w)).where("session > 0")
    first = lambda p: F.min_by(F.regexp_extract(text, p, 1), F.when(F.regexp_extract(text, p, 1) != "", F.col(order)))
    return rows.groupBy(by, "session").agg(F.max_by("_head", F.when(F.col("_head") != "", F.col(order))).alias("title"), F.count("*").alias("n_lines"), *(first(p).alias(a) for a, p in attributes.items()))


def log_sessions(lines: DataFrame, by: list[str], order: list[str], text: str, header: str, first: dict[str, str], last: dict[str, str] | None = None) -> DataFrame:
    """W-b to W-d over logs of any size: `by`, session, title, n_lines, the first value of each attribute of `first` and the last of `last`.

    Headers open sessions, as in `sessions`; the grammar is a parameter. A log is cut into ranges of its lines, in each of
    which headers are counted alone; the session that is open where a range begins is the number of headers in all ranges
    before. Sessions are then folded by partial aggregation, so neither a log nor a session has to fit a task.

    Lines before the first header, and null lines, are in no session; a log without a header has none; values are not
    empty; lines of equal order are taken by their text.
    """
    rows = lines.where(F.col(text).isNotNull()).withColumn("_head", F.regexp_extract(text, header, 1)).withColumn("_opens", (F.col("_head") != "").cast("long"))
    placed = running(rows, by, [*order, text], {"session": "_opens"}, "log").where("session > 0")
    at = F.struct(*order, text)
    value = lambda p: F.regexp_extract(text, p, 1)
    held = lambda p: F.when(value(p) != "", at)
    firsts = [F.min_by(value(p), held(p)).alias(a) for a, p in first.items()]
    lasts = [F.max_by(value(p), held(p)).alias(a) for a, p in (last or {}).items()]
    return placed.groupBy(*by, "session").agg(F.max("_head").alias("title"), F.count("*").alias("n_lines"), *firsts, *lasts)


def streaks(rows: DataFrame, by: str, order: str, value: Column) -> DataFrame:
    """W-e, X26: runs of equal values in order, as gaps and islands."""
    w = Window.partitionBy(by).orderBy(order)
    marked = rows.withColumn("_v", value).withColumn("_new", F.coalesce((F.lag("_v").over(w) != F.col("_v")).cast("int"), F.lit(1)))
    return marked.withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(by, "island").agg(F.first("_v").alias("value"), F.count("*").alias("length"), F.min(order).alias("from_ord"))


# ---------------------------------------------------------------- ledger


def cache_lookup(requests: DataFrame, cache: DataFrame, days: int = 180, unknown_days: int = 30) -> DataFrame:
    """L3: whether each request (email, ts, retry_unknown) is answered by the cache (email, status, verified_at)."""
    c = cache.select(F.lower("email").alias("email"), F.col("status").alias("cached_status"), "verified_at")
    age = (F.unix_micros("ts") - F.unix_micros("verified_at")) / 86_400_000_000
    hit = F.col("verified_at").isNotNull() & (age <= F.when(F.col("cached_status") == "unknown", unknown_days).otherwise(days)) & ~((F.col("cached_status") == "unknown") & F.col("retry_unknown"))
    return requests.withColumn("email", F.lower(F.trim("email"))).join(c, "email", "left").withColumn("hit", F.coalesce(hit, F.lit(False)))


def latest_results(results: DataFrame) -> DataFrame:
    """The last result of each mailbox."""
    return results.groupBy(F.lower("email").alias("email")).agg(F.max_by("status", F.struct("ts", "seq")).alias("status"), F.max("ts").alias("verified_at"))


def budget_view(usage: DataFrame, per_run: int, per_day: int) -> DataFrame:
    """Charges of each run and day against the limits, and which binds; `ledger.budgets` is the view at a time, with reservations and balance."""
    runs = usage.groupBy("day", "run_id").agg(F.count("*").alias("run_used"))
    w = Window.partitionBy("day")
    seen = runs.withColumn("day_used", F.sum("run_used").over(w))
    return seen.withColumn("reason", F.when(F.col("run_used") >= per_run, "run_budget_reached").when(F.col("day_used") >= per_day, "day_budget_reached").otherwise("ok"))
