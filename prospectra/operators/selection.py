"""Batch selection: a filter cascade, scores, quotas, a top-up and a cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.rules import city_malformed, french, website_fits
from ..functions.text import bare_domain
from ..sources.shared import cut
from .scoring import confidence

TARGET_STATES = ("DC", "MD", "VA", "PA", "DE", "WV")
TARGET_CATEGORIES = ("restaurant", "winery", "hotel", "museum", "wine_bar", "event_venue", "art_gallery", "private_club", "country_club")
CITIES = ("annapolis", "baltimore", "reston", "easton", "mclean", "leesburg", "alexandria", "bethesda")
FAR = ("leesburg",)
SKIP_NAMES = ("church", "library", "market")
CHAINS = ("spanish gate",)
JUNK_SITES = ("facebook.com", "instagram.com", "yelp.com")
STATE_RANK = {"DC": 0, "VA": 1, "MD": 2, "DE": 3, "WV": 4, "PA": 5}


def funnel(venues: DataFrame, gigs: DataFrame, contacts: DataFrame, reported: DataFrame | None = None) -> DataFrame:
    """every venue with the first rule that rejects it (`reason`), or null. Each venue is counted once.

    Membership in other tables comes by left joins on distinct keys; a site's first claimant is taken before the later rules, so
    a venue that they reject has claimed its site all the same. `reported` lists venue_ids of earlier reports (J6).
    """
    own = lambda t, c, name: t.select(F.col(c).alias(f"_{name}")).distinct().withColumn(name, F.lit(True))
    domain = bare_domain("website")
    rows = venues.withColumn("domain", domain)
    rows = rows.join(own(gigs.select(F.lower(F.trim("venue_name")).alias("g")), "g", "in_gigs"), F.lower(F.trim("name")) == F.col("_in_gigs"), "left")
    rows = rows.join(own(contacts, "venue_id", "in_contacts"), F.col("venue_id") == F.col("_in_contacts"), "left")
    told = reported if reported is not None else venues.select("venue_id").limit(0)
    rows = rows.join(own(told, "venue_id", "in_reports"), F.col("venue_id") == F.col("_in_reports"), "left")
    done = own(venues.where("status in ('pipelined', 'contacted')").select(domain.alias("d")).where("length(d) > 3"), "d", "in_pipeline")
    rows = rows.join(done, F.col("domain") == F.col("_in_pipeline"), "left")
    has = lambda c: F.coalesce(F.col(c), F.lit(False))
    name, city = F.lower("name"), F.lower(F.trim("city"))
    early = vocab.first_match(
        [
            (F.col("status") != "untouched", "status"),
            (has("in_gigs"), "past_gig"),
            (has("in_reports"), "in_report"),
            (has("in_contacts"), "has_contacts"),
            (F.col("website") == "", "no_site"),
            (vocab.any_of("domain", JUNK_SITES) | F.col("domain").rlike(r"\.(edu|gov|mil)$"), "junk_site"),
            (has("in_pipeline"), "already_reported"),
        ],
        "",
    )
    rows = rows.withColumn("early", early).withColumn("site", F.split_part(F.col("domain"), F.lit("."), F.lit(1)))
    # Venues that are out already claim nothing, so they need no common task.
    claimant = F.when(F.col("early") == "", F.concat(F.lit("s"), "site")).otherwise(F.concat(F.lit("v"), "venue_id"))
    claim = F.row_number().over(Window.partitionBy(claimant).orderBy("_ord"))
    leak = F.exists(F.filter(F.split(name, r"\s+"), lambda w: (F.length(w) > 3) & ~w.isin("club", "farm")), lambda w: F.contains(city, w))
    late = vocab.first_match(
        [
            (F.col("early") != "", "early"),
            (F.col("claim") > 1, "duplicate_site"),
            ((F.col("state") != "") & ~F.col("state").isin(*TARGET_STATES), "state"),
            ((city == "") | (F.col("state") == ""), "blank_city"),
            (city_malformed(F.trim("city")), "malformed_city"),
            (~city.isin(*CITIES) & ((F.length("city") > 25) | (city == name) | leak), "blank_city"),
            (city.isin(*FAR), "too_far"),
            (~F.replace(F.lower("category"), F.lit(" "), F.lit("_")).isin(*TARGET_CATEGORIES), "category"),
            (vocab.any_of(name, SKIP_NAMES), "junk_name"),
            (vocab.any_of(name, CHAINS), "chain"),
            (~website_fits("name", "domain"), "website_mismatch"),
        ],
        "",
    )
    rows = rows.withColumn("claim", claim).withColumn("late", late)
    reason = F.nullif(F.when(F.col("late") == "early", F.col("early")).otherwise(F.col("late")), F.lit(""))
    return rows.withColumn("reason", reason).select(*venues.columns, "domain", "reason")


def skip_counts(cascade: DataFrame) -> DataFrame:
    """A11."""
    return cascade.groupBy(F.coalesce("reason", F.lit("selected")).alias("reason")).agg(F.count("*").alias("n"))


def scored_pool(cascade: DataFrame) -> DataFrame:
    """What is left, with confidence and composite scores."""
    pool = cascade.where("reason is null").withColumn("confidence", confidence(CITIES))
    rank = F.coalesce(F.create_map(*[F.lit(x) for kv in STATE_RANK.items() for x in kv])[F.col("state")], F.lit(9))
    return pool.withColumns({"composite": F.round(F.col("confidence") * F.col("upscale_score"), 6), "state_rank": rank})



def order() -> list[Column]:
    """K4, with the row order last."""
    return [F.desc("composite"), F.desc("upscale_score"), F.col("state_rank").asc(), F.lower("name").asc(), F.col("_ord").asc()]


def quotas(n: int) -> dict[str, int]:
    """K5: shares of a batch of n by bucket; the last takes what is left, below 0 for tiny n."""
    q = {name: max(1, n * share // 100) for name, share in (("french", 30), ("clubs", 20), ("hotels", 20), ("wine", 15))}
    return q | {"wild": n - sum(q.values())}


def batch(pool: DataFrame, n: int = 20) -> DataFrame:
    """K5 to K8: quota picks by bucket, topped up to n, with at most max(2, n // 10) venues outside the home states, filled up with home ones.

    Ranks need the best n of each bucket only, so each pass takes a top-n before it orders anything globally.
    """
    cat = F.regexp_replace(F.lower(F.trim("category")), "[ -]", "_")
    bucket = (
        F.when((cat == "restaurant") & french("name"), "french")
        .when(cat.isin("country_club", "private_club", "yacht_club", "golf_club"), "clubs")
        .when(cat.isin("hotel", "hotel_restaurant", "luxury_hotel_restaurant", "boutique_hotel_restaurant", "historic_inn_restaurant"), "hotels")
        .when(cat.isin("winery", "wine_bar"), "wine")
        .when(cat.isin("art_gallery", "museum", "event", "event_venue"), "wild")
    )
    q = quotas(n)
    limit = F.coalesce(F.create_map(*[F.lit(x) for kv in q.items() for x in kv])[F.col("bucket")], F.lit(0))
    core = F.col("state").isin("DC", "VA", "MD")
    # Beyond n of a bucket and 2 n of the home states nothing can be chosen: two top-n, each of which combines before it shuffles.
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(*order()))
    pool = cut(pool.withColumn("bucket", bucket), "pool")  # read twice: the cascade before it runs once
    best = pool.withColumn("rank", rank).where(F.col("rank") <= n).drop("rank")
    few = best.unionByName(pool.where(core).orderBy(*order()).limit(2 * n)).dropDuplicates(["venue_id"]).coalesce(1).withColumn("rank", rank)  # at most 7 n rows: one task orders them
    everywhere = Window.orderBy(*order())
    few = few.withColumn("picked", F.col("bucket").isNotNull() & (F.col("rank") <= limit))
    few = few.withColumn("have", F.count_if("picked").over(Window.partitionBy(F.lit(1))))
    spare = F.row_number().over(Window.partitionBy("picked").orderBy(*order()))
    few = few.withColumn("spare", spare).withColumn("used", F.col("picked") | (~F.col("picked") & (F.col("spare") <= n - F.col("have"))))
    edge = F.row_number().over(Window.partitionBy(F.col("used") & ~core).orderBy(*order()))
    few = few.withColumn("edge", edge).withColumn("kept", F.col("used") & (core | (F.col("edge") <= max(2, n // 10))))
    few = few.withColumn("n_kept", F.count_if("kept").over(Window.partitionBy(F.lit(1)))).withColumn("dropped", F.col("used") & ~F.col("kept")).withColumn("capped", F.max("dropped").over(Window.partitionBy(F.lit(1))))
    fill = F.row_number().over(Window.partitionBy(~F.col("used") & core).orderBy(*order()))
    few = few.withColumn("fill", fill)
    chosen = few.where(F.col("kept") | (F.col("capped") & ~F.col("used") & core & (F.col("fill") <= n - F.col("n_kept"))))
    return chosen.withColumn("place", F.row_number().over(everywhere)).withColumn("suspicious", F.col("confidence") < 0.8).select("venue_id", "name", "state", "bucket", "composite", "confidence", "suspicious", "place")
