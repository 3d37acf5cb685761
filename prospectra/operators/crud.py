"""Writes as new snapshots of tables: anti joins, folds of change logs and merges."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.coerce import number_or, text
from ..functions.rules import role_mailbox
from ..functions.text import col, step_map
from ..sources.shared import cut
from .ranges import running


def insert_absent(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new whose keys are not in the table; of equal new rows the first by _ord."""
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*new.columns), "_ord").alias("_row")).select("_row.*")
    return first.join(table.select(*keys).distinct(), keys, "left_anti")


def _site(c: str) -> Column:
    """The domain that W1 compares: less scheme, one leading `www.` and path."""
    return F.lower(F.split_part(F.regexp_replace(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), "^https?://", ""), r"^www\.", ""), F.lit("/"), F.lit(1)))


def numbered_ids(table: DataFrame, new: DataFrame, id_: str, prefix: Column, order: str) -> DataFrame:
    """new with ids of a prefix and the next numbers after the highest that the table has for it, three digits at least; ids given stay."""
    top = table.select(F.regexp_extract(id_, r"^(.*-)([0-9]+)[^-]*$", 1).alias("_p"), F.regexp_extract(id_, r"^(.*-)([0-9]+)[^-]*$", 2).try_cast("long").alias("_n")).where("_p <> ''").groupBy("_p").agg(F.max("_n").alias("_top"))
    rows = new.withColumn("_prefix", prefix).withColumn("_blank", F.coalesce(F.col(id_), F.lit("")) == "")
    rows = running(rows.withColumn("_one", F.col("_blank").cast("long")), ["_prefix"], [order], {"_rank": "_one"}, "ids").drop("_one").join(top, F.col("_prefix") == F.col("_p"), "left")
    number = (F.coalesce("_top", F.lit(0)) + F.col("_rank")).cast("string")
    padded = F.when(F.length(number) >= 3, number).otherwise(F.lpad(number, 3, "0"))
    return rows.withColumn(id_, F.when(F.col("_blank"), F.concat("_prefix", padded)).otherwise(F.col(id_))).drop("_prefix", "_blank", "_rank", "_p", "_top")


#: Rounds of `first_of_each` before what is left is folded in order.
ROUNDS = 6


def first_of_each(rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """_name, _city, _domain, _ord of the rows that stay when rows are taken in order of _ord and one goes if a row that stayed has its name and its city, or its name and its domain (if it has one).

    Of rows equal in all three only the first can stay. In a round, rows that are first in both of their groups stay, and
    rows that share a group with one of them go; groups are aggregated and joined, so one of any size is spread over tasks.
    Chains that are longer than the rounds are folded in order of a name, of which a task holds the cities and domains.
    """
    city, domain = ["_name", "_city"], ["_name", "_domain"]
    open_ = cut(rows.groupBy("_name", "_city", "_domain").agg(F.min("_ord").alias("_ord")), "open")
    stayed = None
    for _ in range(rounds):
        if open_.isEmpty():
            break
        heads = [open_.groupBy(*city).agg(F.min("_ord").alias("_first_city")), open_.where("_domain <> ''").groupBy(*domain).agg(F.min("_ord").alias("_first_domain"))]
        marked = open_.join(heads[0], city).join(heads[1], domain, "left")
        marked = cut(marked.withColumn("_stays", (F.col("_ord") == F.col("_first_city")) & (F.col("_ord") == F.coalesce("_first_domain", "_ord"))).drop("_first_city", "_first_domain"), "marked")
        new = marked.where("_stays").drop("_stays")
        stayed = new if stayed is None else stayed.unionByName(new)
        left = marked.where("not _stays").drop("_stays").join(new.select(*city), city, "left_anti")
        open_ = cut(left.join(new.where("_domain <> ''").select(*domain), domain, "left_anti"), "open")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, cities, domains = None, set(), set()
        for batch in batches:
            keep = []
            for n, c, d in zip(batch["_name"], batch["_city"], batch["_domain"], strict=True):
                if n != name:
                    name, cities, domains = n, set(), set()
                keep.append(c not in cities and (not d or d not in domains))
                if keep[-1]:
                    cities.add(c)
                    domains.add(d)
            yield batch[keep]

    rest = open_.repartition("_name").sortWithinPartitions("_name", "_ord").mapInPandas(fold, open_.schema)
    return rest if stayed is None else stayed.unionByName(rest)


def insert_venues(venues: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of new, in order of _ord, that are no duplicates of venues on file or of earlier rows, with ids and defaults.

    A duplicate has the same name (lower-cased, trimmed) and the same city, or the same domain; a row that is not inserted
    makes no other a duplicate.
    """
    name, city = F.lower(F.trim(F.coalesce("name", F.lit("")))), F.lower(F.trim(F.coalesce("city", F.lit(""))))
    keys = lambda d: d.select(name.alias("_name"), city.alias("_city"), _site("website").alias("_domain"), F.col("_ord").cast("long").alias("_ord") if "_ord" in d.columns else F.lit(0))
    known, asked = keys(venues), keys(new)
    fresh = asked.join(known.select("_name", "_city").distinct(), ["_name", "_city"], "left_anti")
    fresh = fresh.join(known.where("_domain <> ''").select("_name", "_domain").distinct(), ["_name", "_domain"], "left_anti")
    kept = first_of_each(fresh).select("_ord")
    rows = new.join(kept, "_ord", "left_semi")
    state, category = text("state", "XX"), text("category", "OTHER")
    prefix = F.concat(F.upper(state), F.lit("-"), F.substring(F.upper(category), 1, 4), F.lit("-"))
    typed = {"state": F.upper(F.coalesce("state", F.lit(""))), "zone_priority": text("zone_priority", "default"), "status": text("status", "untouched"), "upscale_score": number_or("upscale_score", 3)}
    return numbered_ids(venues, rows, "venue_id", prefix, "_ord").withColumns({k: c for k, c in typed.items() if k in new.columns})


def insert_contacts(contacts: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of new (with is_generic) that pass F20 and whose mailbox the venue does not have yet, with ids and defaults; a role's mailbox gets a name from it."""
    passed = new.where(contact_reject("name", "email", "is_generic").isNull())
    label = F.initcap(F.regexp_replace(F.split_part("email", F.lit("@"), F.lit(1)), "[._-]+", " "))
    named = passed.withColumn("name", F.when(F.trim("name") == "", F.coalesce(F.nullif(F.trim(label), F.lit("")), F.lit("Venue Contact"))).otherwise(F.col("name")))
    mail = lambda d: d.withColumn("_mail", F.lower(F.coalesce("email", F.lit(""))))
    fresh = insert_absent(mail(contacts), mail(named), ["venue_id", "_mail"]).drop("_mail", "is_generic")
    return numbered_ids(contacts, fresh, "contact_id", F.lit("C-"), "_ord").withColumns({"verified": text("verified", "valid"), "email_sent": F.lit("false")})


def merge(table: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates replace rows of the same key, others are added; the last update of a key wins."""
    last = updates.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_ord")))).where("_rn = 1").drop("_rn")
    return table.join(last.select(key), key, "left_anti").unionByName(last)


def fold_changes(table: DataFrame, changes: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """The latest value of each field of each key in a log (key, field, value, _ord); unknown fields are ignored.

    A change to status `contacted` also stamps `contacted_at`, one to `untouched` clears it; other statuses leave it.
    """
    latest = lambda f: F.max_by("value", F.when(F.col("field") == f, F.col("_ord")))
    seen = lambda f: F.bool_or(F.col("field") == f)
    folded = changes.where(F.col("field").isin(*fields)).groupBy(key).agg(*(latest(f).alias(f"_new_{f}") for f in fields), *(seen(f).alias(f"_set_{f}") for f in fields), F.max_by(F.struct("value", "at"), F.when((F.col("field") == "status") & F.col("value").isin("contacted", "untouched"), F.col("_ord"))).alias("_new_at"))
    out = table.join(folded, key, "left")
    for f in fields:
        out = out.withColumn(f, F.when(F.col(f"_set_{f}"), F.col(f"_new_{f}")).otherwise(F.col(f)))
    if "status" in fields:
        before = F.col("contacted_at") if "contacted_at" in table.columns else F.lit(None)
        out = out.withColumn("contacted_at", F.when(F.col("_new_at").isNull(), before).when(F.col("_new_at.value") == "contacted", F.col("_new_at.at")))
    return out.drop(*[c for c in out.columns if c.startswith(("_new_", "_set_"))])


def cascade_delete(venues: DataFrame, contacts: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Without the venues of `gone` (venue_id) and their contacts."""
    ids = gone.select("venue_id").distinct()
    return venues.join(ids, "venue_id", "left_anti"), contacts.join(ids, "venue_id", "left_anti")


def without_role_mailboxes(contacts: DataFrame) -> DataFrame:
    """W7."""
    return contacts.where(~role_mailbox("email"))


def remapped(contacts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Venue ids replaced by a table (old, new)."""
    return contacts.join(mapping, F.col("venue_id") == F.col("old"), "left").withColumn("venue_id", F.coalesce("new", "venue_id")).drop("old", "new")


def next_ids(table: DataFrame, id_: str) -> DataFrame:
    """The highest number of each id prefix."""
    return table.groupBy(F.regexp_extract(id_, r"^(.*?)[0-9]*$", 1).alias("prefix")).agg(F.coalesce(F.max(F.regexp_extract(id_, r"([0-9]+)$", 1).try_cast("long")), F.lit(0)).alias("top"))


def website_reject(url: Column | str) -> Column:
    """why a website is not accepted, or null; an empty one is."""
    u = col(url)
    return F.when(u.rlike(r"(?i)\.(ico|png|jpg|jpeg|gif|svg|css|js)(\?|$)"), "asset").when(F.contains(u, F.lit("|")), "several").when(vocab.any_of(F.lower(u), vocab.JUNK_WEBSITES), "junk domain")


def contact_reject(name: Column | str, email: Column | str, is_generic: Column | str | None = None) -> Column:
    """why a contact is not accepted, or null; a role's mailbox must be marked as generic, and then needs no person's name."""
    n, marked = F.trim(F.coalesce(col(name), F.lit(""))), F.coalesce(col(is_generic), F.lit(False)) if is_generic is not None else F.lit(False)
    local = F.lower(F.split_part(F.coalesce(col(email), F.lit("")), F.lit("@"), F.lit(1)))
    return F.when(~marked & local.isin(*vocab.ROLE_LOCALS), "role mailbox").when(~marked & (n == ""), "no name").when(~marked & F.lower(n).isin(*vocab.ROLE_NAMES), "role as name")


def repaired(venues: DataFrame, issues: DataFrame) -> DataFrame:
    """The safe part of the issues of C12 applied: sure categories, and directory pages as websites taken out for review."""
    sure = issues.where("confidence = 'high'")
    kinds = sure.where((F.col("issue") == "category") & F.col("suggested").isin(*vocab.SAFE_CATEGORIES)).select("venue_id", F.col("suggested").alias("_kind"))
    pages = sure.where("issue = 'website_directory'").select("venue_id", F.lit(True).alias("_page"))
    out = venues.join(kinds, "venue_id", "left").join(pages, "venue_id", "left")
    changed = {"category": F.coalesce("_kind", "category"), "website": F.when(F.col("_page"), "").otherwise(F.col("website")), "status": F.when(F.col("_page"), "needs_review").otherwise(F.col("status"))}
    return out.withColumns(changed).drop("_kind", "_page")


def rated(gigs: DataFrame, changes: DataFrame) -> DataFrame:
    """Gigs with the values that changes (gig_id and any of their columns) give; empty and zero ones leave what is there, and overall is the mean of what results."""
    from .relational import gig_overall

    given = [c for c in changes.columns if c != "gig_id" and c in gigs.columns]
    new = changes.select("gig_id", *(F.col(c).alias(f"_new_{c}") for c in given))
    kinds, out = dict(gigs.dtypes), gigs.join(new, "gig_id", "left")
    for c in given:
        value = F.nullif(F.col(f"_new_{c}"), F.lit("") if kinds[c] == "string" else F.lit(0))
        out = out.withColumn(c, F.coalesce(value.cast(kinds[c]), c))
    mean = gig_overall("rating_tips", "rating_rebooked", "rating_audience", "rating_venue_quality", on_insert=False)
    touched = changes.select(F.col("gig_id").alias("_g")).distinct()
    out = out.join(touched, F.col("gig_id") == F.col("_g"), "left")
    return out.withColumn("overall", F.when(F.col("_g").isNotNull(), mean).otherwise(F.col("overall"))).drop("_g", *(f"_new_{c}" for c in given))


def saved_step(check_status: Column | str, step: Column, status: Column) -> Column:
    """The step map with one step set; an unknown status leaves it as it is."""
    found = step_map(check_status)
    one = F.map_from_arrays(F.array(step), F.array(F.struct(status.alias("status"), F.lit("").alias("detail"))))
    rest = F.map_filter(found, lambda k, _: k != step)
    return F.when(status.isin("DONE", "FAILED", "SKIPPED"), F.map_concat(rest, one)).otherwise(found)


def filled_distances(venues: DataFrame, distances: DataFrame) -> DataFrame:
    """From a supplied table (venue_id, miles), where missing."""
    return venues.join(distances, "venue_id", "left").withColumn("distance_miles", F.coalesce("distance_miles", "miles")).drop("miles")


def upserted_config(config: DataFrame, new: DataFrame) -> DataFrame:
    """Keys without case; the last value of a key wins."""
    both = config.select("key", "value", F.lit(0).alias("_new"), "_ord").unionByName(new.select("key", "value", F.lit(1).alias("_new"), "_ord"))
    return both.groupBy(F.lower("key").alias("key")).agg(F.max_by("value", F.struct("_new", "_ord")).alias("value"))
