"""Joins, aggregates, dedup and top-k over venues, contacts, outreach and gigs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import number_or, round_half_up, sent_state, text
from ..sources.shared import cut

SENDABLE = ("valid", "catch-all", "unknown")


def typed_venues(raw: DataFrame) -> DataFrame:
    """defaults and types of venue rows; rows without an id go."""
    return raw.where(F.coalesce(F.col("venue_id"), F.lit("")) != "").withColumns({"upscale_score": number_or("raw_upscale", 3), "zone_priority": text("zone_priority", "default"), "status": text("status", "untouched")}).drop("raw_upscale")


def typed_contacts(raw: DataFrame) -> DataFrame:
    return raw.withColumn("email_sent", sent_state("email_sent"))


def filtered(venues: DataFrame, state: str | None = None, category: str | None = None, city: str | None = None, status: str | None = None) -> DataFrame:
    """only the parameters given; the city matches as a substring."""
    if state:
        venues = venues.where(F.upper("state") == state.upper())
    if category:
        venues = venues.where(F.lower("category") == category.lower())
    if city:
        venues = venues.where(F.contains(F.lower("city"), F.lit(city.lower())))
    if status:
        venues = venues.where(F.col("status") == status)
    return venues


def sent_flags(outreach: DataFrame) -> DataFrame:
    """A5: for each venue, whether each channel was used or skipped; one shuffle."""
    used = lambda *names: F.bool_or(F.col("channel").isin(*names, *(f"{n}_skip" for n in names)))
    return outreach.groupBy("venue_id").agg(used("contact_form").alias("contact_form_sent"), used("instagram").alias("ig_dm_sent"), used("facebook").alias("fb_msg_sent"))


def with_flags(venues: DataFrame, outreach: DataFrame) -> DataFrame:
    """J2."""
    flags = ("contact_form_sent", "ig_dm_sent", "fb_msg_sent")
    return venues.join(sent_flags(outreach), "venue_id", "left").withColumns({f: F.coalesce(f, F.lit(False)) for f in flags})


def contact_summary(contacts: DataFrame) -> DataFrame:
    """J1 without listing contacts: counts by venue combine before the shuffle."""
    sendable = F.col("verified").isin(*SENDABLE) & (F.col("email_sent") == "false")
    return contacts.groupBy("venue_id").agg(F.count("*").alias("n_contacts"), F.count_if(sendable).alias("n_sendable"), F.bool_or(F.col("verified") == "valid").alias("has_valid"))


def with_contacts(venues: DataFrame, contacts: DataFrame) -> DataFrame:
    zero = {"n_contacts": F.coalesce("n_contacts", F.lit(0).cast("long")), "n_sendable": F.coalesce("n_sendable", F.lit(0).cast("long")), "has_valid": F.coalesce("has_valid", F.lit(False))}
    return venues.join(contact_summary(contacts), "venue_id", "left").withColumns(zero)


def contacts_of(venues: DataFrame, contacts: DataFrame) -> DataFrame:
    """Venues with their contacts as an array in row order."""
    one = F.struct("_ord", "contact_id", "name", "title", "email", "verified", "email_sent")
    held = contacts.groupBy("venue_id").agg(F.sort_array(F.collect_list(one)).alias("contacts"))
    return venues.join(held, "venue_id", "left")


def stats(venues: DataFrame, contacts: DataFrame, outreach: DataFrame) -> DataFrame:
    """A1: eight counts in one row. A skipped mailbox counts as sent."""
    c = contacts.agg(F.count("*").alias("total_contacts"), F.count_if(F.col("email_sent") != "false").alias("emails_sent"), F.count_if((F.col("verified") == "valid") & (F.col("email_sent") == "false")).alias("pending_emails"), F.count_if(F.col("verified") == "pending").alias("pending_verify"))
    v = with_flags(venues, outreach).agg(F.count("*").alias("total_venues"), F.count_if("ig_dm_sent").alias("ig_dms_sent"), F.count_if("fb_msg_sent").alias("fb_msgs_sent"))
    return v.join(c).withColumn("total_outreach", F.col("emails_sent") + F.col("ig_dms_sent") + F.col("fb_msgs_sent"))  # two rows of one row each


def breakdown(venues: DataFrame, by: str, default: str) -> DataFrame:
    """A2."""
    done = F.count_if(F.col("status") == "contacted")
    return venues.groupBy(text(by, default).alias(by)).agg(F.count("*").alias("total"), done.alias("contacted"), (F.count("*") - done).alias("pending"))


def by_channel(outreach: DataFrame) -> DataFrame:
    """A3: a blank channel is `unknown`."""
    return outreach.groupBy(text("channel", "unknown").alias("channel")).agg(F.count("*").alias("n"))


def by_day(outreach: DataFrame) -> DataFrame:
    return outreach.where("sent_at is not null").groupBy(F.date_format("sent_at", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


def to_date_counts(outreach: DataFrame, as_of: str) -> DataFrame:
    """A4: counts since Monday and since midnight of as_of."""
    kind = F.when(F.col("channel").isin("email", "contact_form"), "email").when(F.col("channel") == "instagram", "ig").when(F.col("channel") == "facebook", "fb")
    now, sent = F.lit(as_of).cast("timestamp"), F.col("sent_at")
    week, day = sent >= F.date_trunc("week", now), sent >= F.date_trunc("day", now)
    rows = outreach.where(week & kind.isNotNull())  # one filter that reaches the scan bounds both counts
    return rows.groupBy(kind.alias("kind")).agg(F.count("*").alias("weekly"), F.count_if(day).alias("daily"))


def recent(outreach: DataFrame, n: int = 20) -> DataFrame:
    """K3: of the last n rows, those with a date."""
    return outreach.orderBy(F.col("_ord").desc()).limit(n).where("sent_at is not null")


def anti_by_id(venues: DataFrame, gigs: DataFrame) -> DataFrame:
    """J3."""
    return venues.join(gigs.select("venue_id").distinct(), "venue_id", "left_anti")


#: Bytes of distinct names that one side may have to be sent to every task.
NAMES_BYTES = 4 << 20


def contained_names(own: DataFrame, other: DataFrame, most: int = NAMES_BYTES) -> DataFrame:
    """The names of `own` (name) that hold, or are held in, a name of `other` (name): distinct, not empty.

    While the names of one side have at most `most` bytes (added up first), they go to every task, and the other side
    is read once against an automaton of all of them; else names are joined by their rarest three letters.
    """
    sized = lambda t: t.agg(F.sum(F.octet_length("name")).alias("n")).first().n or 0
    if sized(other) <= most:
        return _hits(own, [r.name for r in other.where("name <> ''").collect()], "own")  # at most NAMES_BYTES
    if sized(own) <= most:
        return _hits(other, [r.name for r in own.where("name <> ''").collect()], "few")  # at most NAMES_BYTES
    x, y = own.select(F.col("name").alias("x")), other.select(F.col("name").alias("y"))
    holds = _held(y, "y", x, "x").select(F.col("x").alias("name"))
    return holds.unionByName(_held(x, "x", y, "y").select(F.col("x").alias("name"))).distinct()


def _automaton(names: list[str]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for k, name in enumerate(names):
        found.add_word(name, k)
    found.make_automaton()
    return found


def _hits(rows: DataFrame, few: list[str], wanted: str) -> DataFrame:
    """name: of rows (name) those that hold or are held in one of few (`own`), or the names of few that do so (`few`).

    One automaton of few reads every row; one of a batch of rows reads few, for rows that are held in them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        patterns = _automaton(few) if few else None
        for batch in batches:
            names, hit, seen = list(dict.fromkeys(batch["name"])), set(), set()
            if patterns is not None and names:
                for k, name in enumerate(names):
                    inside = {v for _, v in patterns.iter(name)}
                    if inside:
                        hit.add(k)
                        seen |= inside
                reverse = _automaton(names)
                for v, name in enumerate(few):
                    inside = {k for _, k in reverse.iter(name)}
                    if inside:
                        seen.add(v)
                        hit |= inside
            yield pd.DataFrame({"name": [names[k] for k in sorted(hit)] if wanted == "own" else [few[v] for v in sorted(seen)]}, dtype=object)

    return rows.select("name").where("name <> ''").mapInPandas(run, "name string").distinct()


def _held(short: DataFrame, s: str, long: DataFrame, t: str) -> DataFrame:
    """Pairs (s, t) of distinct names where s occurs in t.

    Every run of three characters of s must occur in t, so that the rarest of them is the key; names of one or two
    characters are their own key. Matches by key are verified.
    """
    grams = lambda c, n: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.col(c).substr(i, F.lit(n))))
    runs = long.where(F.length(t) >= 3).select(t, F.explode(grams(t, 3)).alias("k"))
    often = runs.groupBy("k").agg(F.count("*").alias("often"))
    asked = short.where(F.length(s) >= 3).select(s, F.explode(grams(s, 3)).alias("k")).join(often, "k", "left")
    # A run that no long name has leaves nothing to find, and is the rarest.
    rarest = asked.groupBy(s).agg(F.min_by("k", F.struct(F.coalesce("often", F.lit(0)).alias("n"), "k")).alias("k"))
    found = rarest.join(runs, "k").where(F.contains(t, F.col(s)))
    both = found.select(s, t)
    for n in (1, 2):
        tiny = short.where(F.length(s) == n).select(s, F.col(s).alias("k"))
        both = both.unionByName(tiny.join(long.where(F.length(t) >= n).select(t, F.explode(grams(t, n)).alias("k")), "k").select(s, t))
    return both


def anti_by_name(venues: DataFrame, gigs: DataFrame) -> DataFrame:
    """Without venues whose name holds, or is held in, a past gig's name; an empty name is held in any.

    Distinct names are matched first; venues then lose the matches by an equi anti join.
    """
    names = lambda t, c: t.select(F.lower(F.trim(c)).alias("name")).where("name <> ''").distinct()
    played = names(gigs, "venue_name")
    hits = contained_names(names(venues, "name"), played)
    blank = played.limit(1).select(F.lit("").alias("name"))
    return venues.withColumn("_own", F.coalesce(F.lower(F.trim("name")), F.lit(""))).join(hits.unionByName(blank).select(F.col("name").alias("_own")), "_own", "left_anti").drop("_own")


def anti_pipelined_domains(venues: DataFrame, domain: Column) -> DataFrame:
    """A self anti join on the domain of venues that are past `untouched`."""
    done = venues.where("status in ('pipelined', 'contacted')").select(domain.alias("_d")).where("length(_d) > 3").distinct()
    return venues.join(done, domain == F.col("_d"), "left_anti")


def action_needed(venues: DataFrame, contacts: DataFrame, outreach: DataFrame, gigs: DataFrame) -> DataFrame:
    """Venues with something left to send."""
    live = anti_by_name(anti_by_id(venues.where(~F.col("status").isin("contacted", "untouched", "needs_review")), gigs), gigs)
    full = with_contacts(with_flags(live, outreach), contacts)
    ig, fb = (F.length("instagram") > 5) & ~F.col("ig_dm_sent"), (F.length("facebook") > 5) & ~F.col("fb_msg_sent")
    return full.withColumns({"ig_pending": ig, "fb_pending": fb}).where((F.col("n_sendable") > 0) | F.col("ig_pending") | F.col("fb_pending"))


def gig_profile(gigs: DataFrame) -> DataFrame:
    """Mean, upper median distance, half range (15 at least), mean quality in one row."""
    # The upper median is the lower one of the negated values; counts of values are what is held, not rows.
    d = -F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY -distance_miles)")
    half = F.when(F.count("distance_miles") > 1, (F.max("distance_miles") - F.min("distance_miles")) / 2).otherwise(30.0)
    return gigs.agg(F.count("*").alias("n_gigs"), F.avg("overall").alias("avg_overall"), F.coalesce(d, F.lit(50.0)).alias("median_distance"), F.greatest(half, F.lit(15.0)).alias("spread"), F.avg(number_or("rating_venue_quality", 3)).alias("avg_upscale"))


def category_scores(gigs: DataFrame) -> DataFrame:
    """A6."""
    return gigs.groupBy(F.lower("category").alias("category")).agg(F.avg("overall").alias("cat_avg"), F.count("*").alias("cat_gigs"), F.min("_ord").alias("first_seen"))


def best_category(gigs: DataFrame) -> DataFrame:
    """Ties go to the category seen first."""
    best = F.max_by("category", F.struct("cat_avg", (-F.col("first_seen")).alias("o")))
    return category_scores(gigs).agg(F.coalesce(best, F.lit("none")).alias("best_category"))


def gig_overall(*ratings: str, on_insert: bool = True) -> Column:
    """Mean of the ratings to one decimal; on insert a missing or zero rating counts as 5."""
    values = [number_or(r, 5) if on_insert else F.coalesce(F.col(r).cast("double"), F.lit(0.0)) for r in ratings]
    total = values[0]
    for v in values[1:]:
        total = total + v
    return round_half_up(total / len(values), 1)


def word_counts(rows: DataFrame, words: Column, top: int = 30) -> DataFrame:
    """The most frequent words and in how many rows each occurs; ties by the word."""
    # Every word counts once for itself, and every distinct word of a row once for the row: one exchange, of a row a word and task.
    one = lambda n, row: lambda w: F.struct(w.alias("word"), F.lit(n).alias("n"), F.lit(row).alias("row"))
    marked = F.concat(F.transform(words, one(1, 0)), F.transform(F.array_distinct(words), one(0, 1)))
    counts = rows.select(F.inline(marked)).groupBy("word").agg(F.sum("n").alias("n"), F.sum("row").alias("n_rows"))
    return counts.orderBy(F.desc("n"), "word").limit(top)


def first_by(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def duplicates(venues: DataFrame, domain: Column) -> DataFrame:
    """C14: later rows of the same name whose city or domain an earlier row has, or that have no city like an earlier one.

    Each reason is a window over its own key, so that equal names are not paired with each other.
    """
    name, city = F.lower(F.trim("name")), F.lower(F.trim("city"))
    before = lambda *keys: F.min("_ord").over(Window.partitionBy(*keys))
    rows = venues.withColumns({"_n": name, "_c": city, "_d": domain})
    same_city, same_site = before("_n", "_c"), F.when(F.col("_d") != "", before("_n", "_d"))
    return rows.withColumn("first_ord", F.least(same_city, F.coalesce(same_site, same_city))).where("first_ord < _ord").select("venue_id", "name", "first_ord")


def contact_duplicates(contacts: DataFrame) -> DataFrame:
    """Later contacts with a mailbox that the venue has already."""
    first = F.min("_ord").over(Window.partitionBy("venue_id", F.lower("email")))
    return contacts.withColumn("first_ord", first).where("first_ord < _ord").select("contact_id", "venue_id", "first_ord")


def named_first(contacts: DataFrame) -> DataFrame:
    """One contact a mailbox, with a name if any has one."""
    best = F.min_by("contact_id", F.struct((F.col("name") == "").alias("x"), "_ord"))
    return contacts.where("email <> ''").groupBy(F.lower("email").alias("email")).agg(best.alias("contact_id"), F.count("*").alias("n"))


def renumbered(rows: DataFrame, key: str, order: str) -> DataFrame:
    """W-a, A14: later rows of a repeated id get numbers after the highest.

    Repeated ids are few next to all rows; their running number is the only thing that needs one order.
    """
    nth = F.row_number().over(Window.partitionBy(key).orderBy(order))
    marked = rows.withColumn("_nth", nth)
    top = rows.agg(F.max(key).alias("_top"))
    # Ranges of the order are numbered apart and shifted by the rows of the ranges before, one row a range.
    fresh = cut(marked.where("_nth > 1").repartitionByRange(order, key, "_nth").withColumn("_part", F.spark_partition_id()), "repeated")
    sizes = fresh.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(order, key, "_nth"))
    fixed = fresh.withColumn("_in", inside).join(before, "_part").join(F.broadcast(top)).withColumn(f"new_{key}", F.col("_top") + F.col("_before") + F.col("_in"))  # one row
    return marked.where("_nth = 1").withColumn(f"new_{key}", F.col(key)).drop("_nth").unionByName(fixed.drop("_nth", "_part", "_in", "_before", "_top"))


def word_index(rows: DataFrame, words: Column, top: int = 30, listed: int = 20) -> DataFrame:
    """A12 in full: the most frequent words with the first `listed` rows that hold each, in order."""
    best = word_counts(rows, words, top)
    holders = rows.select("_ord", F.explode(F.array_distinct(words)).alias("word")).join(F.broadcast(best), "word")  # top rows
    nth = F.row_number().over(Window.partitionBy("word").orderBy("_ord"))
    first = holders.withColumn("_rn", nth).where(F.col("_rn") <= listed)
    return first.groupBy("word", "n", "n_rows").agg(F.sort_array(F.collect_list("_ord")).alias("rows"))


def top_map(rows: DataFrame, by: Column, top: int = 10) -> DataFrame:
    """The most frequent values as one map from value to count; ties by the value."""
    best = rows.groupBy(by.alias("k")).agg(F.count("*").alias("n")).where("k is not null").orderBy(F.desc("n"), "k").limit(top)
    return best.agg(F.map_from_entries(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "k", "n"))), lambda x: F.struct(x.k, x.n))).alias("counts"))
