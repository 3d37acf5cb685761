"""Scores as column arithmetic; a profile is a row or two that are broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.coerce import round_half_up
from ..functions.rules import city_malformed, website_fits
from ..functions.text import bare_domain
from .relational import anti_by_id, anti_by_name, category_scores, gig_profile

HOME_STATES = ("DC", "MD", "VA")
#: Taste tables of the examples: tiers by category, favoured cities, words that rule a venue out.
TIERS = {"winery": 1, "wine bar": 1, "hotel": 2, "restaurant": 2, "Gym".lower(): 4, "spa": 4}
CITIES = ("annapolis", "easton", "mclean")
JUNK = ("market", "theater")


def lookup(c: Column, table: dict[str, int], default: int) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[c], F.lit(default))


def recommendations(venues: DataFrame, contacts: DataFrame, gigs: DataFrame, tiers: dict[str, int] = TIERS, cities: tuple[str, ...] = CITIES, junk: tuple[str, ...] = JUNK) -> DataFrame:
    """Venues not played yet, scored 0 to 100 against the profile of past gigs."""
    rows = anti_by_name(anti_by_id(venues, gigs), gigs).where((F.col("status") != "needs_review") & (F.col("venue_vote") != "down"))
    rows = rows.where(F.col("distance_miles").isNull() | (F.col("distance_miles") <= 150)).where(~vocab.any_of(F.lower("name"), junk))
    title = vocab.any_of(F.lower(F.coalesce("title", F.lit(""))), vocab.GOOD_TITLES)
    quality = contacts.groupBy("venue_id").agg(F.count("*").alias("n_contacts"), (F.lit(3) + F.max(F.when(F.col("verified") == "valid", 4).otherwise(0)) + F.max(F.when(title, 3).otherwise(0))).alias("contact_pts"))
    cat = F.lower("category")
    scored = rows.withColumn("_cat", cat).join(F.broadcast(category_scores(gigs).select(F.col("category").alias("_cat"), "cat_avg")), "_cat", "left")  # as many rows as categories
    scored = scored.join(F.broadcast(gig_profile(gigs).select("avg_overall", "avg_upscale"))).join(quality, "venue_id", "left")  # one row
    d = F.col("distance_miles")
    points = {
        "category_pts": F.when(F.col("cat_avg").isNotNull(), round_half_up(F.col("cat_avg") / 10 * 40)).otherwise(round_half_up(F.col("avg_overall") / 10 * 20)),
        "upscale_pts": round_half_up(F.greatest(F.lit(0.0), 30 * (1 - F.abs(F.col("upscale_score") - F.col("avg_upscale")) / 5))),
        "zone_pts": F.when(F.col("zone_priority") == "green", 10).when(F.col("zone_priority") == "yellow", 5).otherwise(0),
        "distance_pts": F.when(d.isNull(), 10).when(d <= 30, 25).when(d <= 60, 20).when(d <= 90, 15).when(d <= 120, 10).otherwise(round_half_up(F.greatest(F.lit(0.0), 5 * (1 - (d - 120) / 30)))),
        "contact_pts": F.coalesce("contact_pts", F.lit(0)),
        "vote_pts": F.when(F.col("venue_vote") == "up", 20).otherwise(0),
        "taste_pts": F.element_at(F.array(F.lit(20), F.lit(10), F.lit(0), F.lit(-20)), lookup(F.col("_cat"), tiers, 3)),
        "location_pts": F.when(F.lower(F.trim("city")).isin(*cities), 15).otherwise(0),
        "state_pts": F.when(F.upper("state").isin(*HOME_STATES), 20).otherwise(0),
    }
    scored = scored.withColumns({k: v.cast("long") for k, v in points.items()})
    total = sum((F.col(k) for k in points), F.lit(0))
    scored = scored.withColumn("score", F.greatest(F.lit(0), F.least(F.lit(100), total)).cast("long"))
    return scored.select("venue_id", "name", "category", "state", "score", *points, F.coalesce("n_contacts", F.lit(0).cast("long")).alias("n_contacts"), "_ord")


def taste_report(scored: DataFrame) -> DataFrame:
    """A9."""
    t = F.col("taste_pts")
    return scored.agg(F.count_if(t >= 15).alias("tier1"), F.count_if((t >= 5) & (t < 15)).alias("tier2"), F.count_if((t < 5) & (t > -10)).alias("tier3"), F.count_if(t <= -10).alias("tier4"), F.count_if(F.col("location_pts") > 0).alias("location_matches"))


def taste_rank() -> Column:
    """R2, first part: 1 is best, 99 unknown; an up-vote improves it by two."""
    cat, name, up = F.lower("category"), F.lower("name"), F.col("upscale_score")
    rank = (
        F.when(vocab.any_of(name, vocab.JUNK_NAMES) | (F.col("venue_vote") == "down"), 99)
        .when(cat.isin("restaurant", "rest", "fine_dining"), F.when(vocab.any_of(name, vocab.BOOST_NAMES) & (up >= 4), 1).when(vocab.any_of(name, vocab.GOOD_NAMES) & (up >= 4), 5).otherwise(99))
        .when(cat == "private_club", 2)
        .when(cat.isin("country_club", "yacht_club"), 3)
        .when(cat.isin("hotel", "resort", "wine_bar"), F.when(up >= 4, 3).otherwise(99))
        .when(cat == "winery", F.when(up >= 4, 5).otherwise(99))
        .when(cat.isin("art_gallery", "museum"), 5)
        .when(cat.isin("event", "event_venue"), 7)
        .otherwise(99)
    )
    return F.when((F.col("venue_vote") == "up") & (rank > 1), F.greatest(F.lit(1), rank - 2)).otherwise(rank)


def top_picks(action: DataFrame, n: int = 10) -> DataFrame:
    """R2, K1, K2: taste, nearness and home states; the best n, ties in row order."""
    rank = F.col("taste_rank")
    taste = F.when(rank >= 99, 0.0).otherwise(F.greatest(F.lit(0.0), (8 - rank) / 7 * 100))
    near = F.greatest(F.lit(0.0), 100 - F.coalesce(F.nullif("distance_miles", F.lit(0.0)), F.lit(50.0)))
    home = F.when(F.upper("state").isin(*HOME_STATES), 50.0).otherwise(0.0)
    scored = action.withColumn("taste_rank", taste_rank()).withColumn("score", F.round(taste + near + home, 6))
    return scored.orderBy(F.desc("score"), "_ord").limit(n)


def confidence(known_cities: tuple[str, ...]) -> Column:
    """How far a record can be trusted, 0 to 1."""
    domain = bare_domain("website")
    plain = F.regexp_replace(F.lower("website"), "https://|http://|www\\.", "")
    slashes = F.length(plain) - F.length(F.replace(plain, F.lit("/"), F.lit("")))
    name, city = F.col("name"), F.col("city")
    score = F.lit(1.0)
    for test, less in (
        (~website_fits(name, domain), 0.5),
        ((city != "") & ~F.lower(city).isin(*known_cities), 0.1),
        (F.length(name) < 4, 0.2),
        (F.length(name) > 60, 0.1),
        (F.col("state") == "", 0.3),
        (slashes > 2, 0.1),
    ):
        score = score - F.when(test, less).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 6)


def prescore(category: Column, stars: Column, reviews: Column, price: Column, state: Column, city: Column, tiers: dict[str, int], cities: tuple[str, ...], raw: Column | None = None, skip: tuple[str, ...] = ()) -> Column:
    """Of a search card; 40 or more is worth a look. price: number of signs."""
    tier = lookup(category, tiers, 4)
    score = F.element_at(F.array(F.lit(30), F.lit(20), F.lit(10), F.lit(-60)), tier)
    score = score + F.when(state.isin("MD", "VA", "DC", "WV", "PA", "DE"), 10).otherwise(-50) + F.when(vocab.any_of(F.lower(city), cities), 10).otherwise(0)
    score = score + F.when(stars >= 4.7, 20).when(stars >= 4.4, 15).when(stars >= 4.0, 10).when(stars >= 3.5, 5).otherwise(0)
    score = score + F.when(reviews > 1000, 5).when(reviews > 500, 3).otherwise(0)
    score = score + F.when(price >= 4, 15).when(price == 3, 10).when(price == 1, -5).otherwise(0)
    if skip and raw is not None:
        score = score - F.when(vocab.any_of(F.lower(raw), skip), 50).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), score))


def actionability() -> Column:
    """Kind, quality, place, and what is on file already."""
    cat = F.lower("category")
    score = F.when(cat.isin("private_club", "yacht_club"), 40).when(cat == "country_club", 35).when(cat == "wine_bar", 20).when(cat.isin("hotel", "restaurant", "winery", "museum"), 15).otherwise(0)
    score = score + 8 * F.floor("upscale_score") + F.when(vocab.any_of(F.lower("city"), vocab.SWEET_CITIES), 10).otherwise(0) + F.when(F.upper("state") == "DC", 10).otherwise(0)
    for name, points in (("instagram", 3), ("website", 2)):
        score = score + F.when(F.length(name) > 5, points).otherwise(0)
    for name in ("state", "city"):
        score = score + F.when(F.trim(name) != "", 1).otherwise(0)
    return score.cast("double")


def backfill_candidates(venues: DataFrame, n: int = 100) -> DataFrame:
    """Live venues without a website and with a sane city, best first, 1 to 100 of them."""
    rows = venues.where(F.col("status").isin("untouched", "needs_review") & (F.col("website") == "") & (F.col("state") != "") & (F.col("category") != "") & ~city_malformed("city"))
    return rows.orderBy(F.desc("upscale_score"), F.lower("name"), "_ord").limit(max(1, min(100, n)))
