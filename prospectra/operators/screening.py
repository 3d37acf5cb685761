"""Per-record gates, routes and reject reasons: each is one column expression or one join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules, text, vocab
from ..functions.text import col

CLUBS = ("private_club", "country_club", "yacht_club")
CLUSTERS = (("DC", "MD", "VA"), ("PA", "DE", "MD"), ("WV", "VA", "MD"))
STATE_NAMES = {"DC": "district of columbia", "MD": "maryland", "VA": "virginia", "PA": "pennsylvania", "DE": "delaware", "WV": "west virginia"}
LATE_STATES = "md|va|dc|pa|de|wv|ny|ca|fl|tx|nc|sc|ga|oh|il|ma|nj|ct|ri|nh|vt|me|mi|wi|mn|ia|mo|ks|ne|sd|nd|mt|wy|co|ut|nv|id|or|wa|ak|hi|al|ms|tn|ky|in|ar|la|ok|nm|az"


def title_route(title: Column | str, has_email: Column, skip: tuple[str, ...] = ()) -> Column:
    """`skip` for irrelevant titles, `enrich` with a mailbox, `pending` for those who decide, else `none`. `skip` adds user words."""
    t = F.lower(F.coalesce(col(title), F.lit("")))
    return F.when(vocab.any_of(t, (*vocab.BAD_TITLES, *skip)), "skip").when(has_email, "enrich").when(vocab.any_of(t, vocab.DECISION_WORDS), "pending").otherwise("none")


def people_filter(name: Column | str, title: Column | str, current: Column, skip: tuple[str, ...], keep: tuple[str, ...]) -> Column:
    """current, with no skip word and some keep word, and a readable first and last name."""
    t, n = F.lower(F.coalesce(col(title), F.lit(""))), F.trim(F.coalesce(col(name), F.lit("")))
    parts = F.split(n, r"\s+")
    return current & ~vocab.any_of(t, skip) & vocab.any_of(t, keep) & (F.size(parts) >= 2) & (F.length(F.element_at(parts, -1)) > 2) & ~n.contains("***")


def low_value(title: Column | str, has_email: Column, listed: tuple[str, ...] = vocab.LOW_TITLES) -> Column:
    """F16: titles that are exactly one of a list are skipped, others enriched if there is a mailbox, else logged."""
    return F.when(F.lower(F.coalesce(col(title), F.lit(""))).isin(*listed), "SKIP").when(has_email, "ENRICH").otherwise("LOG")


def near_state(location: Column | str, state: Column | str) -> Column:
    """whether a location names the state or one of its cluster; any location passes where the state is unknown."""
    s, where = F.upper(F.trim(col(state))), F.lower(F.coalesce(col(location), F.lit("")))
    allowed = {x: sorted({x, *(y for c in CLUSTERS if x in c for y in c)}) for x in STATE_NAMES}
    out = None
    for x, near in allowed.items():
        names = where.rlike(r"\b(" + "|".join([*(n.lower() for n in near), *(STATE_NAMES[n] for n in near)]) + r")\b")
        out = F.when(s == x, names) if out is None else out.when(s == x, names)
    return out.when(s == "", F.lit(True)).otherwise(F.contains(where, F.lower(s)))


def social_evidence(value: Column | str, name: Column | str, site: Column | str, force: Column | bool = False) -> Column:
    """a full address whose slug holds a word of the name or the site's domain, or holds or is held in the name; or any if forced."""
    flat = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")
    v, n = F.coalesce(col(value), F.lit("")), F.coalesce(col(name), F.lit(""))
    slug = flat(F.regexp_extract(F.regexp_replace(v, "/+$", ""), "([^/]*)$", 1))
    base = F.split_part(text.bare_domain(site), F.lit("."), F.lit(1))
    own = F.filter(F.split(F.regexp_replace(F.lower(n), "[^a-z0-9 ]", ""), " "), lambda w: (F.length(w) > 2) & ~w.isin(*vocab.SLUG_STOP_WORDS))
    whole = (flat(n) != "") & (slug != "") & (F.contains(flat(n), slug) | F.contains(slug, flat(n)))
    fits = F.exists(own, lambda w: F.contains(slug, w)) | ((base != "") & F.contains(slug, base)) | whole
    return (F.startswith(v, F.lit("http")) | F.startswith(v, F.lit("//"))) & (F.lit(force) | fits)


def social_reject(value: Column | str, kind: str) -> Column:
    """Why a profile link is not one of `facebook` or `instagram`, or null."""
    u = F.lower(F.coalesce(col(value), F.lit("")))
    host, reserved = {"facebook": (r"facebook\.com", "tr|pages|sharer|dialog|plugins|ads|business"), "instagram": (r"instagram\.com", "p|reel|reels|explore|stories|accounts|developer|embed")}[kind]
    return F.when(u == "", "empty").when(u.rlike(rf"^https?://(www\.)?{host}/?$"), "bare").when(u.rlike(rf"{host}/({reserved})/?$"), "junk").when(u.rlike(rf"{host}/(wixstudio|wix)/?"), "template").when(u.rlike(rf"{host}/[0-9]+/?$"), "numeric").when(~u.rlike(host), "other platform")


def mailbox_flags(email: Column | str, site_domain: Column | str) -> Column:
    """hard_reject, generic and off_domain of a mailbox; the last two are kept and flagged."""
    e, d = F.lower(F.trim(col(email))), F.lower(F.coalesce(col(site_domain), F.lit("")))
    own = F.split_part(e, F.lit("@"), F.lit(2))
    a, b = F.split_part(own, F.lit("."), F.lit(1)), F.split_part(d, F.lit("."), F.lit(1))
    off = (d != "") & (own != "") & ~own.isin(*vocab.FREE_MAIL) & (own != d) & ~F.contains(a, b) & ~F.contains(b, a)
    return F.struct(e.rlike("^(" + vocab.pattern(vocab.HARD_REJECT_MAIL) + ")").alias("hard_reject"), e.rlike("^(" + vocab.pattern(vocab.GENERIC_MAIL) + ")").alias("generic"), off.alias("off_domain"))


def off_domain_report(email: Column | str, site_domain: Column | str) -> Column:
    """the report's rule: hosts less their last label differ."""
    less = lambda c: F.regexp_replace(F.lower(c), r"\.[^.]*$", "")
    return less(F.split_part(col(email), F.lit("@"), F.lit(2))) != less(F.regexp_replace(col(site_domain), r"^www\.", ""))


def other_location(url: Column | str, own_slug: Column | str) -> Column:
    """pages of other places of a chain: a last path part that ends with a state and is not the own one."""
    slug = F.regexp_extract(F.lower(text.path(url)), r"/([a-z][a-z\-]+(?:-[a-z]{2})?)/?$", 1)
    return (F.coalesce(col(own_slug), F.lit("")) != "") & (slug != "") & (slug != F.lower(col(own_slug))) & slug.rlike(f"-({LATE_STATES})$")


def asset_path(url: Column | str) -> Column:
    """F25."""
    return F.lower(col(url)).rlike(r"\.(css|js|png|jpg|jpeg|gif|svg|ico|woff|woff2|ttf|eot|pdf|zip|mp3|mp4|json|xml|txt|map)(\?|$)|/wp-content/(plugins|themes)/.*\.(css|js|png|jpg|ico|json)")


def luxury_fit(signals: dict[str, tuple[str, ...]]) -> Column:
    """whether a venue is high-end enough for its category; signals by category are vocabularies of the name."""
    cat, name, up = F.lower("category"), F.lower("name"), F.floor("upscale_score")
    has = lambda k: vocab.any_of(name, signals[k]) if signals.get(k) else F.lit(False)
    fit = (
        F.when(F.col("venue_vote") == "up", True)
        .when(cat.isin(*CLUBS), True)
        .when(cat.isin("restaurant", "rest", "fine_dining"), (up >= 4) & has("restaurant"))
        .when(cat.isin("hotel", "resort"), (up >= 5) | ((up >= 4) & has("hotel")))
        .when(cat == "wine_bar", (up >= 4) | has("wine_bar"))
        .when(cat == "winery", (up >= 4) & has("winery"))
        .otherwise(False)
    )
    return fit & (F.col("status") != "needs_review") & (F.col("venue_vote") != "down")


def ranked_recommendations(recs: DataFrame, signals: dict[str, tuple[str, ...]]) -> DataFrame:
    """Recommendations past the gate in order of taste, then score."""
    cat, name = F.lower("category"), F.lower("name")
    rank = F.when(F.col("venue_vote") == "up", 0).when(cat.isin(*CLUBS), 1).when(cat.isin("hotel", "resort") & vocab.any_of(name, signals["hotel"]), 2).when(cat == "wine_bar", 2).when(cat.isin("restaurant", "rest", "fine_dining") & vocab.any_of(name, signals["restaurant"]), 3).when(cat == "winery", 4).otherwise(9)
    left = recs.where(~F.col("status").isin("pipelined", "contacted", "needs_review") & ~vocab.any_of(name, vocab.JUNK_NAMES) & luxury_fit(signals))
    return left.withColumn("taste_rank", rank)


def card_reject(known: Column, location: Column, skip_types: tuple[str, ...]) -> Column:
    """Why a search card (name, category, rating, reviews) is not a candidate, or null; `known`: the name is on file."""
    n, c = F.lower(F.trim("name")), F.lower("category")
    state = F.regexp_extract(location, r"\b([A-Z]{2})\b", 1)
    room = F.contains("name", F.lit(" - ")) & vocab.any_of(n, ("room", "suite", "cottage", "cabin"))
    return (
        F.when(F.length(n) < 3, "short")
        .when(vocab.any_of(n, vocab.ROOM_NAMES), "rental")
        .when(room, "room listing")
        .when(known, "exists")
        .when(vocab.any_of(c, skip_types), "type")
        .when((F.coalesce("rating", F.lit("")) == "") & (F.coalesce("reviews", F.lit("")) == ""), "no data")
        .when((state != "") & ~state.isin(*STATE_NAMES), "out of area")
        .when(rules.legacy_category("category", "name") == "other", "unclassified")
    )


def taste_reject(known: Column, score: Column, skip_names: tuple[str, ...], least: int = 40) -> Column:
    """Why a card (name) of a taste search is left out, or null: short, of a skipped kind, on file, a room, or below the score."""
    n = F.lower(F.trim(F.coalesce("name", F.lit(""))))
    room = F.contains(n, F.lit(" - ")) & vocab.any_of(n, ("room", "suite", "cottage", "cabin"))
    return F.when(F.length(n) < 3, "short").when(vocab.any_of(n, skip_names), "kind").when(known, "exists").when(room, "room listing").when(score < least, "score")


def found_by_name(asked: DataFrame, venues: DataFrame) -> DataFrame:
    """S28 for many names at once: of each asked (name) the venue_id of the first venue of that name, else of the first whose name holds all of its words.

    Equal names are joined; the others by the word of theirs that fewest venues' names hold, and are then verified.
    """
    own, want = F.lower(F.trim("name")), F.lower(F.trim("name"))
    rows = venues.select(own.alias("own"), "venue_id", "_ord").where("own <> ''")
    first = rows.groupBy("own").agg(F.min("_ord").alias("_ord"), F.min_by("venue_id", "_ord").alias("venue_id"))
    ask = asked.select(want.alias("want")).where("want <> ''").distinct()
    same = ask.join(first, F.col("want") == F.col("own"), "left")
    hit = same.where("own is not null").select("want", "venue_id")
    rest = same.where("own is null").select("want")
    words = first.select("own", "venue_id", "_ord", F.explode(F.array_distinct(F.filter(F.split("own", r"\s+"), lambda w: w != ""))).alias("word"))
    often = words.groupBy("word").agg(F.count("*").alias("n"))
    # A word may stand inside a longer one, so the words asked for are looked up among those that hold them.
    asks = rest.select("want", F.explode(F.array_distinct(F.split("want", r"\s+"))).alias("part"))
    inside = contained_in(asks.select("part").distinct(), often.select("word"))
    cost = asks.join(inside, "part", "left").join(often, "word", "left").groupBy("want", "part").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    rarest = cost.groupBy("want").agg(F.min_by("part", F.struct("n", "part")).alias("part"))
    near = rarest.join(inside, "part").join(words, "word")
    fits = F.forall(F.split("want", r"\s+"), lambda w: F.contains(F.col("own"), w))
    found = near.where(fits).groupBy("want").agg(F.min_by("venue_id", F.struct("_ord", "venue_id")).alias("venue_id"))
    return hit.unionByName(found).withColumnRenamed("want", "name")


def contained_in(parts: DataFrame, words: DataFrame) -> DataFrame:
    """part, word: in which of the distinct words each distinct part occurs."""
    longer = words.withColumn("k", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.substr("word", i, F.lit(3))))))
    asked = parts.withColumn("k", F.substring("part", 1, 3))
    exact = asked.where(F.length("part") >= 3).join(longer.where(F.length("k") == 3), "k")
    tiny = parts.where(F.length("part") < 3).withColumn("k", F.col("part"))
    starts = words.withColumn("k", F.explode(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.array(F.substr("word", i, F.lit(1)), F.substr("word", i, F.lit(2))))))))
    both = exact.unionByName(tiny.join(starts, "k"))
    return both.where(F.contains("word", F.col("part"))).select("part", "word").distinct()


def known_mailboxes(candidates: DataFrame, contacts: DataFrame) -> DataFrame:
    """Candidates whose mailbox is not on file; deferred ones are tried again."""
    known = contacts.where("verified <> 'deferred' and email <> ''").select(F.lower("email").alias("_e")).distinct()
    return candidates.join(known, F.lower("email") == F.col("_e"), "left_anti")


def disposition(candidates: DataFrame, contacts: DataFrame, ledger: DataFrame, owners: tuple[str, ...] = ()) -> DataFrame:
    """The chain of a candidate mailbox: known, owner's own (X2), hard reject, else the ledger's status, with flags."""
    known = contacts.where("verified <> 'deferred' and email <> ''").select(F.lower("email").alias("email"), F.lit(True).alias("_known")).distinct()
    status = ledger.select(F.lower("email").alias("email"), F.col("status").alias("_status"))
    rows = candidates.withColumn("email", F.lower(F.trim("email"))).join(known, "email", "left").join(status, "email", "left").withColumn("flags", mailbox_flags("email", "domain"))
    route = F.when(F.col("_known"), "known").when(F.col("email").isin(*owners) if owners else F.lit(False), "owner").when(F.col("flags.hard_reject"), "hard_reject").otherwise(F.coalesce("_status", F.lit("unverified")))
    return rows.withColumn("disposition", route).drop("_known", "_status")


def within_credits(rows: DataFrame, run: str, order: str, cost: str, cap: int = 300) -> DataFrame:
    """Rows of a run until its running cost has reached the cap."""
    w = Window.partitionBy(run).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_used", F.coalesce(F.sum(cost).over(w), F.lit(0))).where(F.col("_used") < cap).drop("_used")


def liveness(code: Column | str) -> Column:
    """X16."""
    return F.when(col(code).isin(0, 404, 410), "dead").otherwise("live")


def venue_gate(status: Column | str) -> Column:
    """Contacts on file do not matter."""
    return F.when(col(status).isin("contacted", "closed"), "skip").otherwise("run")


def rechecked_category(raw: Column | str, name: Column | str) -> Column:
    """A restaurant only if the name and type still say so."""
    return F.when(F.lower(col(raw)) == "restaurant", rules.canonical_category(raw, name)).otherwise(col(raw))


def outcome(saved: Column | str) -> Column:
    """X18."""
    return F.when(col(saved) > 0, "pipelined").otherwise("needs_review")


def enrichment_route(email: Column | str, status: Column | str) -> Column:
    """X10."""
    return F.when((F.coalesce(col(email), F.lit("")) != "") & (col(status) != "unavailable"), "verify").otherwise("pending")


def without_fallback(venues: DataFrame, saved: DataFrame) -> DataFrame:
    """Venues with no saved mailbox, for which the fallback runs."""
    return venues.join(saved.select("venue_id").distinct(), "venue_id", "left_anti")


def resolved_ids(requests: DataFrame, venues: DataFrame) -> DataFrame:
    """Unknown ids by the first venue of the same host."""
    by_host = venues.where("website <> ''").groupBy(text.site_host("website").alias("_h")).agg(F.min_by("venue_id", "_ord").alias("_id"))
    known = venues.select(F.col("venue_id").alias("_v"))
    rows = requests.join(known, F.col("venue_id") == F.col("_v"), "left").join(by_host, text.site_host("website") == F.col("_h"), "left")
    return rows.withColumn("venue_id", F.coalesce("_v", "_id", "venue_id")).drop("_v", "_h", "_id")


def recovered(requests: DataFrame, matches: DataFrame) -> DataFrame:
    """X11: results given by place, joined with their requests by place (null matches included)."""
    return requests.join(matches, ["batch", "place"], "left")


def location_pages(pages: DataFrame, venues: DataFrame) -> DataFrame:
    """Of each venue's site, the page of its city: four address patterns in order, else the first page with the city's slug.

    Venues may share a host: pages that name their venue (venue_id) are that venue's only, others are of all venues on their host.
    """
    slug = F.regexp_replace(F.lower(F.trim("city")), r"[^a-z]+", "-")
    sites = venues.where("website <> '' and city <> ''").select("venue_id", text.site_host("website").alias("_h"), slug.alias("_s"))
    keys = ["_h", "venue_id"] if "venue_id" in pages.columns else ["_h"]
    found = pages.withColumns({"_p": F.lower(text.path("url")), "_h": text.host("url")}).join(sites, keys).where(F.contains("_p", "_s"))
    tail = lambda lead: F.regexp_replace("_p", "/+$", "") == F.concat(F.lit(lead), F.col("_s"))
    rank = F.when(tail("/locations/"), 1).when(tail("/location/"), 2).when(tail("/"), 3).when(tail("/restaurants/"), 4).otherwise(5)
    return found.groupBy("venue_id").agg(F.min_by("url", F.struct(rank.alias("r"), F.length("url").alias("n"), F.col("url").alias("u"))).alias("url"))


def probes(pages: DataFrame, sites: DataFrame, paths: tuple[str, ...]) -> DataFrame:
    """Common paths of sites that exist and are not known yet: a short list of paths times sites, by a semi join."""
    asked = sites.select("site", F.explode(F.array(*map(F.lit, paths))).alias("p")).withColumn("url", F.concat(F.regexp_replace("site", "/+$", ""), F.col("p")))
    return asked.join(pages.select(text.normalize_url("url", False).alias("url")).distinct(), "url", "left_semi")


def best_org(candidates: DataFrame) -> DataFrame:
    """Of the matches of each venue (venue_id, org_id, org_name, phase, score), the best that is no chain, else the best; an organisation counts in its first phase."""
    first = Window.partitionBy("venue_id", "org_id").orderBy("phase")
    once = candidates.withColumn("_f", F.row_number().over(first)).where("_f = 1").drop("_f")
    order = F.struct(F.when(rules.chain("org_name"), 1).otherwise(0).alias("c"), (-F.col("score")).alias("s"), "phase", "org_id")
    return once.groupBy("venue_id").agg(F.min_by(F.struct("org_id", "org_name", "score"), order).alias("best")).select("venue_id", "best.*")


def best_website(candidates: DataFrame) -> DataFrame:
    """The best-scoring address of each venue (venue_id, name, url, place), if it scores 6 or more; ties go to the first."""
    scored = candidates.withColumn("score", rules.website_score("name", "url"))
    best = scored.groupBy("venue_id").agg(F.min_by(F.struct("url", "score"), F.struct((-F.col("score")).alias("s"), "place")).alias("b"))
    return best.where("b.score >= 6").select("venue_id", "b.url", "b.score")


def attached_titles(contacts: DataFrame, people: DataFrame) -> DataFrame:
    """Blank titles filled by mailbox within a venue, the first one."""
    first = people.where("title <> ''").groupBy("venue_id", F.lower("email").alias("_e")).agg(F.min_by("title", "_ord").alias("_t"))
    return contacts.join(first, (contacts.venue_id == first.venue_id) & (F.lower(contacts.email) == F.col("_e")), "left").select(contacts["*"], F.coalesce(F.nullif(contacts.title, F.lit("")), "_t").alias("full_title"))


def overridden(log: DataFrame, sheet: DataFrame, key: str, fields: list[str], only_blank: list[str]) -> DataFrame:
    """The sheet's non-empty values win over the log's; those of `only_blank` only where the log has none."""
    right = sheet.select(key, *(F.col(c).alias(f"_s_{c}") for c in (*fields, *only_blank)))
    out = log.join(right, key, "left")
    for c in fields:
        out = out.withColumn(c, F.coalesce(F.nullif(f"_s_{c}", F.lit("")), c))
    for c in only_blank:
        out = out.withColumn(c, F.coalesce(F.nullif(c, F.lit("")), f"_s_{c}"))
    return out.drop(*(f"_s_{c}" for c in (*fields, *only_blank)))


def pending_split(venues: DataFrame, contacts: DataFrame) -> DataFrame:
    """Whether each pending venue has a mailbox already."""
    have = contacts.where("email <> ''").select("venue_id", F.lit(True).alias("_e")).distinct()
    return venues.join(have, "venue_id", "left").withColumn("route", F.when(F.col("_e"), "clear").otherwise("search")).drop("_e")


def whitelist(names: DataFrame, gigs: DataFrame) -> DataFrame:
    """Listed names with their gig if there is one; the others stay."""
    played = gigs.groupBy(F.lower("venue_name").alias("_n")).agg(F.min_by("gig_id", "_ord").alias("gig_id"))
    return names.join(played, F.lower("name") == F.col("_n"), "left").drop("_n")


def cleanup(discovered: DataFrame, venues: DataFrame, gigs: DataFrame) -> DataFrame:
    """Discovered names that are venues and no past gigs."""
    key = lambda t, c: t.select(F.lower(F.trim(c)).alias("_n")).distinct()
    own = F.lower(F.trim("name"))
    return discovered.join(key(venues, "name"), own == F.col("_n"), "left_semi").join(key(gigs, "venue_name"), own == F.col("_n"), "left_anti")


def gig_distances(gigs: DataFrame, venues: DataFrame) -> DataFrame:
    """A gig's distance from its venue where it has none."""
    known = venues.select("venue_id", F.col("distance_miles").alias("_d"))
    return gigs.join(known, "venue_id", "left").withColumn("distance_miles", F.coalesce("distance_miles", "_d")).drop("_d")


def backfilled(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """C10, trap 20: of the candidate addresses of each venue (venue_id, name, url, place), the first that fits by host or content among three, else the first.

    `verified` tells the two apart.
    """
    ranked = candidates.withColumn("_rn", F.row_number().over(Window.partitionBy("venue_id").orderBy("place")))
    seen = ranked.join(pages.select(F.col("url").alias("_u"), "html"), F.col("url") == F.col("_u"), "left")
    base = F.regexp_replace(F.split_part(text.host("url"), F.lit("."), F.lit(1)), "[^a-z0-9]", "")
    fits = F.exists(F.filter(text.words("name"), lambda w: F.length(w) >= 4), lambda w: F.contains(base, w)) | (F.col("html").isNotNull() & rules.content_matches("name", "html"))
    good = (F.col("_rn") <= 3) & fits
    best = seen.groupBy("venue_id").agg(F.min_by(F.struct("url", good.alias("verified")), F.struct((~good).alias("x"), "_rn")).alias("b"))
    return best.select("venue_id", "b.url", "b.verified")


def enrichment_names(contacts: DataFrame) -> DataFrame:
    """The people whose mailbox is wanted, with first and last name apart."""
    from .audit import pending_enrichment

    parts = F.split(F.trim("name"), r"\s+", 2)
    return pending_enrichment(contacts).select("contact_id", "venue_id", F.get(parts, F.lit(0)).alias("first"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("last"))


def promoted(statuses: DataFrame, checks: DataFrame) -> DataFrame:
    """Venues in review become untouched where a later read shows the value that was written."""
    good = checks.where("written = read_back").select("venue_id", F.lit(True).alias("_ok")).distinct()
    rows = statuses.join(good, "venue_id", "left")
    return rows.withColumn("status", F.when((F.col("status") == "needs_review") & F.col("_ok"), "untouched").otherwise(F.col("status"))).drop("_ok")


def coverage(crawl: DataFrame, venues: DataFrame, at: str) -> DataFrame:
    """Crawl counts by host with the venue they belong to."""
    own = venues.where("website <> ''").select("venue_id", "name", text.site_host("website").alias("host"))
    return crawl.join(own, "host").withColumn("collected_at", F.lit(at).cast("timestamp"))


def reverified(venues: DataFrame, contacts: DataFrame, answers: DataFrame) -> DataFrame:
    """Unknown mailboxes of pipelined venues with their new status (answers: contact_id, status), up to the first deferral of each venue."""
    asked = contacts.where("verified = 'unknown' and email <> ''").join(venues.where("status = 'pipelined'").select("venue_id"), "venue_id", "left_semi")
    rows = asked.join(answers.select("contact_id", F.col("status").alias("answer")), "contact_id", "left").withColumn("answer", F.coalesce("answer", F.lit("deferred")))
    w = Window.partitionBy("venue_id").orderBy("_ord").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_stop", F.bool_or(F.col("answer") == "deferred").over(w)).where("not _stop").drop("_stop")


def evidence(website: Column | str, people: Column | str, profiles: Column | str, mailboxes: Column | str, form: Column | str) -> Column:
    """What a check found, as one text."""
    count = lambda c: F.coalesce(col(c), F.lit(0)).cast("string")
    web = F.when(F.coalesce(col(website), F.lit("")).isin("", "None"), "web:none").otherwise("web:ok")
    said = F.when(F.coalesce(col(form), F.lit("")) == "", "form:no").otherwise("form:yes")
    return F.concat_ws("|", web, F.concat(F.lit("apollo:"), count(people)), F.concat(F.lit("li:"), count(profiles)), F.concat(F.lit("emails:"), count(mailboxes)), said)
