"""The service's actions by name: each takes tables and parameters and returns a DataFrame.

Reads return rows; writes return the new snapshot of the table that they change. Those with several results return them by name.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import audit, crud, scoring, screening
from ..operators import relational as rel

Tables = dict[str, DataFrame]


def dashboard(t: Tables, **_: Any) -> DataFrame:
    return rel.stats(t["venues"], t["contacts"], t["outreach"])


def venues(t: Tables, **p: Any) -> DataFrame:
    return rel.filtered(t["venues"], **{k: p.get(k) for k in ("state", "category", "city", "status")})


def venue_detail(t: Tables, venue_id: str = "", **_: Any) -> DataFrame:
    one = F.col("venue_id") == venue_id
    return rel.contacts_of(rel.with_flags(t["venues"].where(one), t["outreach"].where(one)), t["contacts"].where(one))


def find_by_domain(t: Tables, domain: str = "", **_: Any) -> DataFrame:
    """The first venue whose host is the argument."""
    return t["venues"].where(text.site_host("website") == domain.lower().removeprefix("www.")).orderBy("_ord").limit(1)


def find_by_name(t: Tables, name: str = "", **_: Any) -> DataFrame:
    """The name itself, else all of its words; the first hit."""
    own, words = F.lower(F.trim("name")), name.lower().split()
    held = F.lit(bool(words))
    for w in words:
        held = held & F.contains(own, F.lit(w))
    rank = F.when(own == name.lower().strip(), 0).when(held, 1)
    return t["venues"].withColumn("_rank", rank).where("_rank is not null").orderBy("_rank", "_ord").limit(1).drop("_rank")


def setting(key: str) -> Callable[..., DataFrame]:
    """One value of the config table, by name without case; the first."""
    return lambda t, **_: t["config"].where(F.lower("key") == key.lower()).orderBy("_ord").limit(1)


def save_setting(key: str) -> Callable[..., DataFrame]:
    """W14."""

    def run(t: Tables, value: str = "", **_: Any) -> DataFrame:
        new = t["config"].sparkSession.createDataFrame([(key, value, 0)], "key string, value string, _ord long")
        return crud.upserted_config(t["config"], new)

    return run


def change(table: str, key: str, fields: tuple[str, ...]) -> Callable[..., DataFrame]:
    """One field of one row."""

    def run(t: Tables, field: str = "", value: str = "", at: str = "", **p: Any) -> DataFrame:
        named = {f.replace("_", ""): f for f in fields}.get(field.lower().replace("_", "").replace(" ", ""))
        if named is None:
            raise ValueError(f"unknown field {field!r}")
        log = t[table].sparkSession.createDataFrame([(p[key], named, value, 1, at)], f"{key} string, field string, value string, _ord long, at string")
        return crud.fold_changes(t[table], log, key, [named])

    return run


def delete(table: str, key: str) -> Callable[..., DataFrame]:
    return lambda t, **p: t[table].where(F.col(key) != p[key])


def delete_venue(t: Tables, venue_id: str = "", **_: Any) -> Tables:
    """Both tables that change."""
    venues_, contacts = crud.cascade_delete(t["venues"], t["contacts"], t["venues"].where(F.col("venue_id") == venue_id))
    return {"venues": venues_, "contacts": contacts}


def update_venue(t: Tables, venue_id: str = "", field: str = "", value: str = "", force: bool = False, **p: Any) -> DataFrame:
    """W3 with F18 and F19: a website or profile that is not accepted is an error that says why."""
    key = field.lower().replace("_", "").replace(" ", "")
    one = t["venues"].where(F.col("venue_id") == venue_id)
    if value and key == "website":
        why = one.limit(1).select(crud.website_reject(F.lit(value))).first()
        if why and why[0]:
            raise ValueError(f"website not accepted: {why[0]}")
    if value and key in ("facebook", "instagram"):
        fits = one.limit(1).select(screening.social_evidence(F.lit(value), "name", "website", force)).first()
        if fits and not fits[0]:
            raise ValueError(f"{key} not accepted: no full address, or it fits neither name nor domain")
    return change("venues", "venue_id", VENUE_FIELDS)(t, field=field, value=value, venue_id=venue_id, **p)


def stats(t: Tables, **_: Any) -> DataFrame:
    """A3: the total, and counts by channel and by day."""
    total = t["outreach"].agg(F.count("*").alias("n")).select(F.lit("total").alias("kind"), F.lit("").alias("key"), "n")
    part = lambda d, kind, key: d.select(F.lit(kind).alias("kind"), F.col(key).alias("key"), "n")
    return total.unionByName(part(rel.by_channel(t["outreach"]), "channel", "channel")).unionByName(part(rel.by_day(t["outreach"]), "day", "day"))


def audit_pipeline(t: Tables, **_: Any) -> Tables:
    """L1, A10, L2: the audit of each venue, its summary, and contacts whose mailbox is pending."""
    found = audit.step_audit(t["venues"])
    return {"venues": found, "summary": audit.step_summary(found), "pending": audit.pending_enrichment(t["contacts"])}


def update_gig(t: Tables, rows: DataFrame | None = None, **_: Any) -> DataFrame:
    return crud.rated(t["gigs"], rows)


def add(table: str, keys: list[str]) -> Callable[..., DataFrame]:
    """Rows of `rows` that are not there yet."""
    return lambda t, rows=None, **_: t[table].unionByName(crud.insert_absent(t[table], rows, keys), allowMissingColumns=True)


def add_venue(t: Tables, rows: DataFrame | None = None, **_: Any) -> DataFrame:
    """W1."""
    return t["venues"].unionByName(crud.insert_venues(t["venues"], rows), allowMissingColumns=True)


def add_contact(t: Tables, rows: DataFrame | None = None, **_: Any) -> DataFrame:
    """W2."""
    marked = rows if "is_generic" in rows.columns else rows.withColumn("is_generic", F.lit(False))
    return t["contacts"].unionByName(crud.insert_contacts(t["contacts"], marked), allowMissingColumns=True)


def append(table: str) -> Callable[..., DataFrame]:
    return lambda t, rows=None, **_: t[table].unionByName(rows, allowMissingColumns=True)


def listing(table: str) -> Callable[..., DataFrame]:
    """S30."""
    return lambda t, **_: t[table]


def templates(t: Tables, **_: Any) -> DataFrame:
    """The last row of a category wins."""
    return t["templates"].groupBy(F.lower("category").alias("category")).agg(F.max_by(F.struct("subject", "body"), "_ord").alias("t")).select("category", "t.*")


def update_taste(t: Tables, rows: DataFrame | None = None, mode: str = "append", **_: Any) -> DataFrame:
    """W11."""
    return rows if mode == "replace" else t["taste"].unionByName(rows)


def save_step(t: Tables, venue_id: str = "", step: str = "", status: str = "", **_: Any) -> DataFrame:
    """W12."""
    saved = text.step_text(crud.saved_step("check_status", F.lit(step), F.lit(status)))
    return t["venues"].withColumn("check_status", F.when(F.col("venue_id") == venue_id, saved).otherwise(F.col("check_status")))


def save_check(t: Tables, venue_id: str = "", evidence: str = "", **_: Any) -> DataFrame:
    """Old evidence merged with new, the new one last."""
    both = text.step_text(text.step_map(F.concat_ws("|", F.nullif("check_status", F.lit("")), F.lit(evidence))))
    return t["venues"].withColumn("check_status", F.when(F.col("venue_id") == venue_id, both).otherwise(F.col("check_status")))


def remap_contact_venue(t: Tables, old: str = "", new: str = "", **_: Any) -> DataFrame:
    return t["contacts"].withColumn("venue_id", F.when(F.col("venue_id") == old, new).otherwise(F.col("venue_id")))


def contact_upsert(t: Tables, rows: DataFrame | None = None, **_: Any) -> DataFrame:
    """By venue and name without case."""
    key = lambda d: d.withColumn("_k", F.concat_ws("\t", "venue_id", F.lower(F.trim("name"))))
    return crud.merge(key(t["contacts"]), key(rows), "_k").drop("_k")


VENUE_FIELDS = ("name", "category", "website", "city", "state", "facebook", "instagram", "status", "check_status")

ACTIONS: dict[str, Callable[..., DataFrame | Tables]] = {
    "dashboard": dashboard,
    "venues": venues,
    "venue_detail": venue_detail,
    "update_venue": update_venue,
    "update_contact": change("contacts", "contact_id", ("name", "title", "email", "verified", "email_sent")),
    "update_contact_email": contact_upsert,
    "log_outreach": append("outreach"),
    "add_venue": add_venue,
    "add_contact": add_contact,
    "templates": templates,
    "config": listing("config"),
    "stats": stats,
    "calc_distances": lambda t, **_: crud.filled_distances(t["venues"], t["distances"]),
    "add_gig": add("gigs", ["gig_id"]),
    "update_gig": update_gig,
    "delete_gig": delete("gigs", "gig_id"),
    "get_gigs": listing("gigs"),
    "get_recommendations": lambda t, **_: scoring.recommendations(t["venues"], t["contacts"], t["gigs"]).orderBy(F.desc("score"), "_ord"),
    "save_monthly": save_setting("monthly"),
    "load_monthly": setting("monthly"),
    "save_skip_words": save_setting("skip_words"),
    "get_skip_words": setting("skip_words"),
    "save_reviewed_reports": save_setting("reviewed_reports"),
    "get_reviewed_reports": setting("reviewed_reports"),
    "save_discovery": save_setting("discovery"),
    "load_discovery": setting("discovery"),
    "delete_contact": delete("contacts", "contact_id"),
    "delete_venue": delete_venue,
    "cleanup_generic": lambda t, **_: crud.without_role_mailboxes(t["contacts"]),
    "update_taste": update_taste,
    "remap_contact_venue": remap_contact_venue,
    "find_by_domain": find_by_domain,
    "save_check": save_check,
    "save_step": save_step,
    "audit_pipeline": audit_pipeline,
    "fix_venue_ids": lambda t, **_: rel.renumbered(t["venues"].withColumn("number", F.regexp_extract("venue_id", "([0-9]+)$", 1).try_cast("long")), "number", "_ord"),
}


def run(action: str, tables: Tables, **parameters: Any) -> DataFrame | Tables:
    """The action's result; an unknown one is an error that names those there are."""
    if action not in ACTIONS:
        raise ValueError(f"unknown action {action!r}; there are {', '.join(ACTIONS)}")
    return ACTIONS[action](tables, **parameters)
