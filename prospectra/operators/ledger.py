"""The ledger of paid mailbox checks: cache, caps, reservations, balance.

A request is decided by ten steps in order: the venue's cap, if there is one, input, cache, switch, key, the run's cap, the
day's cap, a reservation of the same mailbox, balance, charge. The charge comes before the call, so failed calls count. Decisions of one ledger
(account) depend on all before them; ledgers are independent. `Decider` is the fold's step; `decisions` folds a batch,
`prospectra.streaming.ledger` a stream, with the same steps over keyed state.

What a ledger has to remember is bounded by its rules: results of `days` days, of which there are at most `per_day` a
day; at most `per_day` open reservations; counts of runs that charged within `run_days`.

Defined cases: a null or odd mailbox is invalid; null run_ids are one run; a null outcome is an unknown status; a null
switch or key is on; requests without a column `balance` ask for none, a null balance is one that could not be had; rows
of equal seq are taken in order of time and mailbox; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, MutableMapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86400.0


@dataclass(frozen=True)
class Rules:
    """Caps, lives in days, and the life of a reservation in seconds."""

    per_run: int = 5
    per_day: int = 10
    days: float = 180
    unknown_days: float = 30
    hold: float = 300
    reserve: float = 500
    fail_closed: bool = True
    #: A run's count, and a venue's, lapses so many days after its last charge.
    run_days: float = 180
    #: Charges for one venue within a run (L9); none if there is no cap.
    per_venue: int | None = None


def date_of(ts: float) -> str:
    return str(int(ts // DAY))


class Decider:
    """The step of the fold. State: `cache` mailbox to (status, time), `runs` run to (count, time), `day` day to count, `inflight` mailbox to (time, run), `venues` run and venue to (count, time).

    The state's maps may be dictionaries or anything else with `get` and item assignment, but `inflight` is a dictionary.
    """

    def __init__(self, rules: Rules, cache: MutableMapping | None = None, runs: MutableMapping | None = None, day: MutableMapping | None = None, inflight: dict | None = None, venues: MutableMapping | None = None):
        self.rules = rules
        self.cache, self.runs, self.day, self.inflight, self.venues = ({} if m is None else m for m in (cache, runs, day, inflight, venues))

    def live(self, status: str, age: float) -> bool:
        return age <= DAY * (self.rules.unknown_days if status == "unknown" else self.rules.days)

    def used(self, counts: MutableMapping, key: str, ts: float) -> int:
        n, last = counts.get(key) or (0, ts)
        return n if ts - last <= DAY * self.rules.run_days else 0

    def decide(self, ts: float, email: str | None, run: str | None, outcome: str | None, retry: bool = False, balance: float | None = None, known_balance: bool = False, enabled: bool = True, key: bool = True, venue: str | None = None) -> tuple[str, bool, bool, str]:
        """status, cached, charged, reason. The balance counts if `known_balance`. An outcome `open` leaves a reservation."""
        rules, email, run = self.rules, (email or "").strip().lower(), run or ""
        at_venue, charged_there = f"{run}\t{venue}", 0
        if rules.per_venue is not None and venue is not None:
            charged_there = self.used(self.venues, at_venue, ts)
            if charged_there >= rules.per_venue:
                return "deferred", False, False, "venue_cap_reached"
        if "@" not in email:
            return "deferred", False, False, "invalid_email_input"
        known = self.cache.get(email)
        if known and self.live(known[0], ts - known[1]) and not (known[0] == "unknown" and retry):
            return known[0], True, False, "cached"
        if not enabled:
            return "deferred", False, False, "disabled"
        if not key:
            return "deferred", False, False, "no_api_key"
        held = [e for e, (t, _) in self.inflight.items() if ts - t > rules.hold]
        for e in held:
            del self.inflight[e]
        used = self.used(self.runs, run, ts)
        if used + sum(r == run for _, r in self.inflight.values()) >= rules.per_run:
            return "deferred", False, False, "run_budget_reached"
        spent = self.day.get(date_of(ts)) or 0
        if spent + len(self.inflight) >= rules.per_day:
            return "deferred", False, False, "day_budget_reached"
        if email in self.inflight:
            return "deferred", False, False, "already_inflight"
        if known_balance and balance is None and rules.fail_closed:
            return "deferred", False, False, "credit_check_failed"
        if known_balance and balance is not None and balance <= rules.reserve:
            return "deferred", False, False, "reserve_reached"
        if outcome == "open":
            self.inflight[email] = (ts, run)
            return "deferred", False, False, "reserved"
        self.runs[run], self.day[date_of(ts)] = (used + 1, ts), spent + 1
        if rules.per_venue is not None and venue is not None:
            self.venues[at_venue] = (charged_there + 1, ts)
        failed = outcome in ("timeout", "error")
        self.cache[email] = ("unknown" if failed or not outcome else outcome, ts)
        return ("deferred", False, True, "call_failed") if failed else (outcome or "unknown", False, True, "charged")

    def tidy(self, ts: float) -> None:
        """Drops what no decision from ts on can ask for; for states that are dictionaries."""
        self.cache = {e: v for e, v in self.cache.items() if self.live(v[0], ts - v[1])}
        self.runs = {r: v for r, v in self.runs.items() if ts - v[1] <= DAY * self.rules.run_days}
        self.venues = {k: v for k, v in self.venues.items() if ts - v[1] <= DAY * self.rules.run_days}
        self.day = {d: n for d, n in self.day.items() if int(d) >= int(ts // DAY)}


#: Columns of `requests`; `at` is the time in seconds.
REQUEST = ["account", "seq", "ts", "email", "run_id", "outcome", "retry_unknown", "enabled", "has_key", "balance", "asked", "at", "venue_id"]
DECISION = "account string, seq long, ts timestamp, email string, run_id string, status string, cached boolean, charged boolean, reason string"


def requests(rows: DataFrame) -> DataFrame:
    """Requests (account, seq, ts, email, run_id, outcome, and if they are there retry_unknown, enabled, has_key, balance, venue_id) with all columns of REQUEST."""
    has = set(rows.columns)
    flag = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in has else F.lit(default)
    balance = F.col("balance").cast("double") if "balance" in has else F.lit(None).cast("double")
    return rows.select(F.col("account").cast("string").alias("account"), F.col("seq").cast("long").alias("seq"), "ts", F.lower(F.trim(F.coalesce("email", F.lit("")))).alias("email"), F.coalesce("run_id", F.lit("")).alias("run_id"), "outcome", flag("retry_unknown", False).alias("retry_unknown"), flag("enabled", True).alias("enabled"), flag("has_key", True).alias("has_key"), balance.alias("balance"), F.lit("balance" in has).alias("asked"), (F.unix_micros("ts") / 1_000_000).alias("at"), (F.col("venue_id").cast("string") if "venue_id" in has else F.lit(None).cast("string")).alias("venue_id"))


def decided(decider_of: Callable[[str | None], Decider], rows: pd.DataFrame) -> pd.DataFrame:
    """Rows (columns of REQUEST), in order, as rows of DECISION; each is decided by the decider of its account."""
    plain = lambda c: rows[c].astype(object).where(rows[c].notna(), None).tolist()
    columns = (rows["at"].tolist(), rows["email"].tolist(), rows["run_id"].tolist(), plain("outcome"), rows["retry_unknown"].tolist(), plain("balance"), rows["asked"].tolist(), rows["enabled"].tolist(), rows["has_key"].tolist(), plain("venue_id"))
    found = [decider_of(account).decide(*x) for account, *x in zip(plain("account"), *columns, strict=True)]
    out = rows[["account", "seq", "ts", "email", "run_id"]].reset_index(drop=True)
    return pd.concat([out, pd.DataFrame(found, columns=["status", "cached", "charged", "reason"])], axis=1)


def decisions(rows: DataFrame, rules: Rules) -> DataFrame:
    """Rows of DECISION, one a request, each ledger's in order of seq.

    Rows stream through tasks; a task holds the state of one ledger, which the rules bound.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = [object(), Decider(rules)]

        def decider_of(account: str | None) -> Decider:
            if account != held[0]:
                held[:] = account, Decider(rules)
            return held[1]

        for batch in batches:
            if len(batch):
                yield decided(decider_of, batch)
                held[1].tidy(batch["at"].iloc[-1])

    ordered = requests(rows).repartition("account").sortWithinPartitions("account", "seq", "ts", "email")
    return ordered.mapInPandas(run, DECISION)


def budgets(made: DataFrame, rules: Rules, at: Column, balance: Column | None = None) -> DataFrame:
    """Account, run_id, run_used, run_reserved, day_used, day_reserved, reason at a time, of decisions made before it.

    A run's count is of all its charges within `run_days`; the day's is of the day of `at`. Reservations count for `hold` seconds,
    until the mailbox is charged. With a balance, one that is null or not above the reserve overrides the caps.
    """
    rows = made.where(F.col("ts") <= at)
    age = lambda c: F.unix_micros(at) - F.unix_micros(c)
    last = Window.partitionBy("account", "email").orderBy("seq").rowsBetween(1, Window.unboundedFollowing)
    later = F.max(F.when(F.col("charged") | (F.col("reason") == "reserved"), 1)).over(last).isNotNull()
    held = (F.col("reason") == "reserved") & (age(F.col("ts")) <= int(rules.hold * 1e6)) & ~later
    today = F.col("charged") & (F.floor(F.unix_micros("ts") / int(DAY * 1e6)) == F.floor(F.unix_micros(at) / int(DAY * 1e6)))
    runs = rows.withColumns({"held": held, "today": today}).groupBy("account", "run_id").agg(F.count_if("charged").alias("run_used"), F.max(F.when(F.col("charged"), F.col("ts"))).alias("last"), F.count_if("held").alias("run_reserved"), F.count_if("today").alias("today"))
    w = Window.partitionBy("account")
    seen = runs.withColumn("run_used", F.when(age(F.col("last")) <= int(DAY * rules.run_days * 1e6), F.col("run_used")).otherwise(0)).withColumns({"day_used": F.sum("today").over(w), "day_reserved": F.sum("run_reserved").over(w)})
    cap = F.when(F.col("run_used") + F.col("run_reserved") >= rules.per_run, "run_budget_reached").when(F.col("day_used") + F.col("day_reserved") >= rules.per_day, "day_budget_reached").otherwise("ok")
    if balance is not None:
        failed = balance.isNull() if rules.fail_closed else F.lit(False)
        cap = F.when(failed, "credit_check_failed").when(balance <= rules.reserve, "reserve_reached").otherwise(cap)
    return seen.select("account", "run_id", "run_used", "run_reserved", "day_used", "day_reserved", cap.alias("reason"))
