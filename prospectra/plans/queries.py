"""Named queries over the star-schema tables, each an application of the engine's operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, text
from ..functions.coerce import number_or, number_or_null, round_half_up
from ..operators import audit, crud, graph, ledger, reports, scoring, screening, selection
from ..operators import relational as rel
from ..sources.projection import entity
from ..streaming import events as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AS_OF = "2024-01-24 13:00:00"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def venues(s: SparkSession, d: str) -> DataFrame:
    return rel.typed_venues(entity(s, d, "venues"))


def contacts(s: SparkSession, d: str) -> DataFrame:
    return rel.typed_contacts(entity(s, d, "contacts"))


def outreach(s: SparkSession, d: str) -> DataFrame:
    return entity(s, d, "outreach")


def gigs(s: SparkSession, d: str) -> DataFrame:
    return entity(s, d, "gigs").withColumn("overall", rel.gig_overall("rating_tips", "rating_rebooked", "rating_audience", "rating_venue_quality"))


def table(s: SparkSession, d: str, name: str) -> DataFrame:
    return s.read.parquet(f"{d}/{name}.parquet")


@query
def breakdown_by_state(s, d):
    return rel.breakdown(venues(s, d), "state", "Unknown")


@query
def breakdown_by_category(s, d):
    return rel.breakdown(venues(s, d), "category", "other")


@query
def dashboard_stats(s, d):
    return rel.stats(venues(s, d), contacts(s, d), outreach(s, d))


@query
def outreach_by_channel(s, d):
    return rel.by_channel(outreach(s, d))


@query
def outreach_by_day(s, d):
    return rel.by_day(outreach(s, d))


@query
def outreach_week_to_date(s, d):
    return rel.to_date_counts(outreach(s, d), AS_OF)


@query
def sent_flags(s, d):
    return rel.sent_flags(outreach(s, d))


@query
def recent_outreach(s, d):
    return rel.recent(outreach(s, d)).select("venue_id", "channel", "_ord")


@query
def venue_contacts_summary(s, d):
    return rel.with_contacts(venues(s, d), contacts(s, d)).select("venue_id", "n_contacts", "n_sendable", "has_valid")


@query
def venue_detail(s, d):
    """S26 for one key: the filter reaches both scans."""
    one = rel.contacts_of(venues(s, d).where("venue_id = 'V-7'"), contacts(s, d).where("venue_id = 'V-7'"))
    return one.select("venue_id", F.col("name").alias("venue"), F.inline_outer("contacts")).select("venue_id", "venue", "contact_id", "email", "verified", "email_sent")


@query
def venue_filter_params(s, d):
    return rel.filtered(venues(s, d), state="md", city="es", status="untouched").select("venue_id", "name", "city", "state")


@query
def venue_coercions(s, d):
    raw = entity(s, d, "venues")
    return raw.select("venue_id", number_or("raw_upscale", 3).alias("upscale"), number_or_null("raw_upscale").alias("upscale_or_null"), round_half_up(F.col("distance_miles") - 60).alias("rounded"))


@query
def action_needed(s, d):
    return rel.action_needed(venues(s, d), contacts(s, d), outreach(s, d), gigs(s, d)).select("venue_id", "n_sendable", "ig_pending", "fb_pending")


@query
def top_picks(s, d):
    picks = scoring.top_picks(rel.action_needed(venues(s, d), contacts(s, d), outreach(s, d), gigs(s, d)))
    return picks.select("venue_id", "taste_rank", "score")


@query
def gig_profile(s, d):
    p = rel.gig_profile(gigs(s, d)).join(rel.best_category(gigs(s, d)))  # one row each
    return p.select("n_gigs", F.round("avg_overall", 6).alias("avg_overall"), "median_distance", "spread", F.round("avg_upscale", 6).alias("avg_upscale"), "best_category")


@query
def gig_category_scores(s, d):
    return rel.category_scores(gigs(s, d)).select("category", F.round("cat_avg", 6).alias("cat_avg"), "cat_gigs")


@query
def recommendations(s, d):
    return scoring.recommendations(venues(s, d), contacts(s, d), gigs(s, d)).drop("_ord", "name", "category", "state")


@query
def recommendations_top(s, d):
    return scoring.recommendations(venues(s, d), contacts(s, d), gigs(s, d)).orderBy(F.desc("score"), "_ord").limit(25).select("venue_id", "score")


@query
def taste_report(s, d):
    return scoring.taste_report(scoring.recommendations(venues(s, d), contacts(s, d), gigs(s, d)))


@query
def actionability(s, d):
    return venues(s, d).select("venue_id", scoring.actionability().alias("score"))


@query
def backfill_candidates(s, d):
    return scoring.backfill_candidates(venues(s, d)).select("venue_id", "name")


@query
def candidate_prescore(s, d):
    """R5, R6 over parts as search cards: sizes as ratings, prices as reviews."""
    p = table(s, d, "part").withColumns({"stars": F.col("p_size") / 10, "reviews": F.floor("p_retailprice"), "price": F.col("p_partkey") % 5})
    cat = F.element_at(F.array(*map(F.lit, ("restaurant", "winery", "hotel", "museum", "other", "private_club"))), (F.col("p_partkey") % 6 + 1).cast("int"))
    state, city = F.when(F.col("p_partkey") % 3 != 1, "MD").otherwise("NY"), F.when(F.col("p_partkey") % 7 == 0, "Easton").otherwise("Elkton")
    signs = F.repeat(F.lit("$"), F.col("price").cast("int"))
    score = scoring.prescore(cat, F.col("stars"), F.col("reviews"), F.col("price"), state, city, {"winery": 1, "private_club": 1, "restaurant": 2, "hotel": 2, "museum": 3}, ("easton",))
    return p.select("p_partkey", score.alias("score"), rules.price_level(signs, F.col("stars"), cat).alias("upscale"))


@query
def batch_funnel(s, d):
    return funnel(s, d).select("venue_id", "reason")


def funnel(s: SparkSession, d: str) -> DataFrame:
    """Contacts that must not be mailed and were skipped stand for those on file, undated form entries for earlier reports."""
    reported = outreach(s, d).where("sent_at is null and channel = 'contact_form'").select("venue_id")
    return selection.funnel(venues(s, d), gigs(s, d), contacts(s, d).where("verified = 'do_not_mail' and email_sent = 'skipped'"), reported)


@query
def skip_reason_histogram(s, d):
    return selection.skip_counts(funnel(s, d))


@query
def batch_pool(s, d):
    pool = selection.scored_pool(funnel(s, d))
    return pool.select("venue_id", "confidence", "composite", "state_rank")


@query
def batch_selected(s, d):
    """K4 to K8, W-h."""
    return selection.batch(selection.scored_pool(funnel(s, d)), 20).drop("composite", "confidence")


@query
def category_canonical(s, d):
    v = venues(s, d)
    return v.select("venue_id", rules.canonical_category("category", "name").alias("canonical"))


@query
def category_disagreement(s, d):
    """C1 against C2."""
    v = venues(s, d).select(rules.canonical_category("category", "name").alias("a"), rules.legacy_category("category", "name").alias("b"))
    return v.groupBy("a", "b").agg(F.count("*").alias("n"))


@query
def website_match(s, d):
    v = venues(s, d)
    return v.select("venue_id", rules.website_score("name", "website").alias("score"), rules.website_fits("name", text.bare_domain("website")).alias("fits"), rules.blocked_domain("website").alias("blocked"))


@query
def quality_issues(s, d):
    return audit.quality_issues(venues(s, d))


@query
def quality_issue_counts(s, d):
    return audit.quality_issues(venues(s, d)).groupBy("issue").agg(F.count("*").alias("n"))


@query
def venue_duplicates(s, d):
    return rel.duplicates(venues(s, d), text.bare_domain("website"))


@query
def contact_duplicates(s, d):
    return rel.contact_duplicates(contacts(s, d))


@query
def mailboxes_named_first(s, d):
    return rel.named_first(contacts(s, d))


@query
def renumber_duplicates(s, d):
    """W-a over orders whose keys are made to repeat."""
    o = table(s, d, "orders").select((F.col("o_orderkey") - F.when(F.col("o_orderkey") % 10 == 3, 1).otherwise(0)).alias("id"), F.col("o_orderkey").alias("_ord"))
    return rel.renumbered(o, "id", "_ord")


@query
def keyword_profile(s, d):
    docs = table(s, d, "documents").withColumnRenamed("doc_id", "_ord")
    longer = F.filter(text.words("text"), lambda w: F.length(w) >= 4)
    return rel.word_counts(docs, longer).select("word", "n", "n_rows")


@query
def url_normalized(s, d):
    p = table(s, d, "pages")
    return p.select("page_id", text.host("url").alias("host"), text.normalize_url("url").alias("normal"), text.normalize_url("url", False).alias("plain"), text.extension("url").alias("extension"), text.url_class("url").alias("kind"))


@query
def url_scores(s, d):
    return table(s, d, "pages").select("page_id", text.url_score("url").alias("score"))


@query
def page_links(s, d):
    return table(s, d, "pages").select("page_id", F.explode(text.links("html")).alias("href")).groupBy("page_id").agg(F.count("*").alias("n"), F.count_distinct("href").alias("n_distinct"))


@query
def host_coverage(s, d):
    return graph.host_coverage(table(s, d, "pages"))


@query
def crawl_reachable(s, d):
    p = table(s, d, "pages")
    return graph.crawl(p, p.where("url like 'https:%' and url not like '%?%'").select("url")).groupBy("depth").agg(F.count("*").alias("n"))


@query
def crawl_unvisited(s, d):
    return graph.unvisited(table(s, d, "pages"))


@query
def entity_provenance(s, d):
    """A15, G3 over the venues' pages."""
    found = graph.provenance(entity(s, d, "sites"))
    return found.withColumn("sources", F.array_join("sources", " "))


@query
def emails_in_documents(s, d):
    """Every address in a text and whether it is usable."""
    found = F.regexp_extract_all("text", F.lit(r"(?i)([A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,})"), 1)
    rows = table(s, d, "documents").select("doc_id", F.explode(F.array_distinct(F.transform(found, F.lower))).alias("email"))
    return rows.withColumns({"usable": text.clean_email("email").isNotNull(), "generic": text.generic_email("email")})


@query
def website_fits(s, d):
    v = venues(s, d)
    return v.select("venue_id", rules.website_fits("name", text.bare_domain("website")).alias("fits"), rules.blocked_domain("website").alias("blocked"))


@query
def step_audit(s, d):
    a = audit.step_audit(venues(s, d))
    return a.select("venue_id", *(F.array_join(c, ",").alias(c) for c in ("done", "failed", "missing")), "complete")


@query
def step_summary(s, d):
    return audit.step_summary(audit.step_audit(venues(s, d)))


@query
def pending_enrichment(s, d):
    return audit.pending_enrichment(contacts(s, d)).select("contact_id", "venue_id")


@query
def log_sessions(s, d):
    """W-b to W-d: a user's turn opens a session, and of the lines after it the first words count."""
    lines = table(s, d, "conversations").select("conv_id", "turn", F.concat(F.upper("role"), F.lit(": "), F.regexp_replace("text", r"\s+", " ")).alias("line"))
    return audit.sessions(lines, "conv_id", "turn", "line", r"^USER: (\S+)", {"reply": r"^ASSISTANT: (\S+)", "system": r"^SYSTEM: (\S+)"})


@query
def event_streaks(s, d):
    """W-e: runs of one event type of each user."""
    e = table(s, d, "events").select("user_id", "event_id", "event_type")
    return audit.streaks(e, "user_id", "event_id", F.col("event_type")).where("length >= 2").select("user_id", "from_ord", "value", "length")


def requests(s: SparkSession, d: str) -> DataFrame:
    """Verification requests from events."""
    e = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select((F.col("user_id") % 8).cast("string").alias("account"), F.col("event_id").alias("seq"), "ts", F.concat(F.lit("u"), (F.col("event_id") % 700).cast("string"), F.lit("@Example.org")).alias("email"), F.concat(F.lit("run"), F.floor(F.col("event_id") / 500).cast("string")).alias("run_id"), F.element_at(F.array(*map(F.lit, ("valid", "invalid", "timeout", "catch-all"))), (F.col("event_id") % 4 + 1).cast("int")).alias("outcome"), (F.col("event_id") % 9 == 0).alias("retry_unknown"))


@query
def ledger_cache_hits(s, d):
    r = requests(s, d)
    early = r.where(f"ts < timestamp '{AS_OF}'").select("email", F.when(F.col("outcome") == "timeout", "unknown").otherwise(F.col("outcome")).alias("status"), "ts", "seq")
    hits = audit.cache_lookup(r.where(f"ts >= timestamp '{AS_OF}'"), audit.latest_results(early), days=10, unknown_days=3)
    return hits.select("seq", "hit", F.when(F.col("hit"), F.col("cached_status")).alias("status"))


@query
def ledger_budget(s, d):
    r = requests(s, d).select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "run_id")
    return audit.budget_view(r, 200, 320)


#: Rules of the ledgers that the queries keep: short lives and a long hold, so that every step decides something.
LEDGER_RULES = ledger.Rules(per_run=3, per_day=2, days=10, unknown_days=3, hold=86400, reserve=100, per_venue=2)


def ledger_requests(s: SparkSession, d: str) -> DataFrame:
    """Every event as a request to its user's ledger."""
    e = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    k = F.col("event_id")
    email = F.when(k % 29 == 0, "nobody").otherwise(F.concat(F.lit("U"), (k % 7).cast("string"), F.lit("@Example.org ")))
    outcome = F.element_at(F.array(*map(F.lit, ("valid", "invalid", "timeout", "catch-all", "open"))), (k % 5 + 1).cast("int"))
    return e.select(F.col("user_id").cast("string").alias("account"), k.alias("seq"), "ts", email.alias("email"), F.concat(F.lit("run"), F.floor(F.dayofmonth("ts") / 5).cast("string")).alias("run_id"), outcome.alias("outcome"), (k % 9 == 0).alias("retry_unknown"), (k % 31 != 0).alias("enabled"), (k % 37 != 0).alias("has_key"), F.when(k % 13 != 0, F.floor(F.col("value") * 20)).alias("balance"), F.concat(F.lit("V"), (k % 2).cast("string")).alias("venue_id"))


@query
def ledger_decisions(s, d):
    """All ten steps, sequential by account."""
    return ledger.decisions(ledger_requests(s, d), LEDGER_RULES).select("account", "seq", "status", "cached", "charged", "reason")


@query
def ledger_budgets(s, d):
    """What each run has used and reserved at a time, and what would stop it; accounts of odd number ask with a low or unknown balance."""
    account = F.col("account").cast("long")
    balance = F.when(account % 4 == 1, 50.0).when(account % 4 != 3, 500.0)
    return ledger.budgets(ledger.decisions(ledger_requests(s, d), LEDGER_RULES), LEDGER_RULES, F.lit(AS_OF).cast("timestamp"), balance)


@query
def snapshot_merge(s, d):
    c = contacts(s, d).select("contact_id", "venue_id", "email", "_ord")
    news = contacts(s, d).where("verified = 'unknown'").select(*c.columns).withColumns({"contact_id": F.when(F.col("_ord") % 2 == 0, F.col("contact_id")).otherwise(F.concat(F.lit("N-"), (F.col("_ord") % 50).cast("string"))), "email": F.lit("new@site.example.org")})
    return crud.merge(c, news, "contact_id")


@query
def insert_absent(s, d):
    """Untouched venues, their ids taken away, as new rows beside the others."""
    v = venues(s, d)
    new = v.where("status = 'untouched'").withColumn("venue_id", F.lit("")).withColumn("name", F.upper("name"))
    old = v.where("status <> 'untouched'").withColumn("venue_id", F.concat(F.upper("state"), F.lit("-"), F.substring(F.upper("category"), 1, 4), F.lit("-"), "_ord"))
    return crud.insert_venues(old, new).select("venue_id", "name", "city", "state", "zone_priority", "_ord")


@query
def cascade_delete(s, d):
    v, c = crud.cascade_delete(venues(s, d), contacts(s, d), venues(s, d).where("status = 'closed'").select("venue_id"))
    return v.agg(F.count("*").alias("n_venues")).join(c.agg(F.count("*").alias("n_contacts"), F.sum("_ord").alias("ord_sum")))  # one row each


@query
def change_log_fold(s, d):
    o = table(s, d, "events").select(F.concat(F.lit("V-"), F.col("user_id").cast("string")).alias("venue_id"), F.when(F.col("event_id") % 3 == 0, "status").when(F.col("event_id") % 3 == 1, "city").otherwise("nonsense").alias("field"), F.when(F.col("event_id") % 2 == 0, "contacted").otherwise("pipelined").alias("value"), F.col("event_id").alias("_ord"), F.col("ts").alias("at"))
    return crud.fold_changes(venues(s, d).select("venue_id", "status", "city"), o, "venue_id", ["status", "city"]).select("venue_id", "status", "city", F.col("contacted_at").isNotNull().alias("stamped"))


@query
def contact_rejects(s, d):
    marked = F.col("email_sent") == "skipped"
    reason = F.coalesce(crud.contact_reject("name", "email", marked), F.lit("accepted"))
    return contacts(s, d).groupBy(marked.alias("marked"), reason.alias("reason")).agg(F.count("*").alias("n"))


@query
def next_ids(s, d):
    return crud.next_ids(venues(s, d).select("venue_id").unionByName(contacts(s, d).select(F.col("contact_id").alias("venue_id"))), "venue_id")


@query
def taste_query_plan(s, d):
    """Types by places, less what is done already. The product is the feature: both lists are short vocabularies."""
    types = s.createDataFrame([(t,) for t in ("winery", "hotel", "museum")], "kind string")
    places = table(s, d, "nation").select(F.col("n_name").alias("place"))
    done = table(s, d, "region").select(F.lower(F.concat(F.lit("winery in NATION_"), F.col("r_regionkey").cast("string"))).alias("q"))
    plan = types.join(F.broadcast(places)).withColumn("q", F.concat("kind", F.lit(" in "), "place"))
    return plan.join(done, F.lower(plan.q) == done.q, "left_anti").select("q")


@query
def ext_rollup_region(s, d):
    return venues(s, d).rollup("county", "state").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "contacted").alias("contacted"))


@query
def ext_outreach_grouping_sets(s, d):
    o = outreach(s, d).where("sent_at is not null").select("channel", F.date_format("sent_at", "yyyy-MM-dd").alias("day"))
    return o.groupingSets([["channel"], ["day"]], "channel", "day").agg(F.count("*").alias("n"))


@query
def ext_tumbling(s, d):
    e = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.tumbling(e).select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.col("total").cast("double").alias("total"))


@query
def ext_session(s, d):
    e = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.user_sessions(e, "2 hours").groupBy("user_id").agg(F.count("*").alias("n_sessions"), F.max("n").alias("longest"))


SIGNALS = {"restaurant": ("bistro", "steakhouse", "brasserie"), "hotel": ("grand", "inn"), "wine_bar": ("wine",), "winery": ("ridge", "estate")}


@query
def ranked_recommendations(s, d):
    """F12, F26, K9."""
    recs = scoring.recommendations(venues(s, d), contacts(s, d), gigs(s, d)).select("venue_id", "score")
    ranked = screening.ranked_recommendations(recs.join(venues(s, d), "venue_id"), SIGNALS)
    return ranked.select("venue_id", "taste_rank", "score")


@query
def contact_routes(s, d):
    """F13 to F16, X10."""
    c = contacts(s, d)
    route = screening.title_route("title", F.col("email").contains("@"))
    return c.groupBy(route.alias("route"), screening.low_value("title", F.contains("email", F.lit("@"))).alias("value")).agg(F.count("*").alias("n"))


@query
def candidate_dispositions(s, d):
    """Mailboxes not yet written to as candidates, against the other contacts as those on file and a ledger."""
    c = contacts(s, d)
    found = c.where("email_sent = 'false' and email <> ''").select("contact_id", "email", F.concat(F.lit("v"), F.expr("_ord % 5"), F.lit(".example.org")).alias("domain"))
    ledger = c.where("verified <> 'pending'").groupBy(F.lower("email").alias("email")).agg(F.min("verified").alias("status"))
    out = screening.disposition(found, c.where("email_sent <> 'false' and verified = 'valid'"), ledger, owners=("ann.lee@v1.example.org",))
    return out.select("contact_id", "disposition", F.col("flags.generic").alias("generic"), F.col("flags.off_domain").alias("off_domain"))


@query
def resolved_ids(s, d):
    """Every venue is asked for by its website alone."""
    asked = venues(s, d).where("website <> ''").select(F.concat(F.lit("?"), "venue_id").alias("venue_id"), "website", "_ord")
    return screening.resolved_ids(asked, venues(s, d)).select("_ord", "venue_id")


@query
def gig_distances(s, d):
    return screening.gig_distances(gigs(s, d), venues(s, d)).select("gig_id", "distance_miles")


@query
def attached_titles(s, d):
    c = contacts(s, d)
    return screening.attached_titles(c, c.where("verified = 'valid'").select("venue_id", "email", "title", "_ord")).select("contact_id", "full_title")


@query
def venue_flags(s, d):
    return reports.venue_flags(venues(s, d), contacts(s, d))


@query
def report_totals(s, d):
    credits = table(s, d, "events").select((F.col("event_id") % 40).alias("run_id"), F.floor("value").alias("used"))
    return reports.report_totals(contacts(s, d), credits)


@query
def region_progress(s, d):
    v = venues(s, d).groupBy(F.col("county").alias("region"), "city").agg(F.bool_or(F.col("status") == "contacted").alias("swept"), F.count("*").alias("n_venues"))
    return reports.region_progress(v)


@query
def channel_totals(s, d):
    return reports.channel_totals(outreach(s, d))


@query
def within_credits(s, d):
    """X3."""
    e = table(s, d, "events").select((F.col("user_id") % 50).alias("run_id"), "event_id", F.floor("value").alias("cost"))
    return screening.within_credits(e, "run_id", "event_id", "cost", 300).groupBy("run_id").agg(F.count("*").alias("n"))


@query
def log_sections(s, d):
    """Lines between a first and a third turn."""
    lines = table(s, d, "conversations").select("conv_id", "turn", F.concat(F.lit("turn "), "turn").alias("line"))
    return reports.section(lines, "conv_id", "turn", "line", "^turn [0]$", "^turn 3$").select("conv_id", "turn")
