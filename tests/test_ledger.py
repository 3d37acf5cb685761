"""The ledger: goldens of its steps, a batch against a plain fold, streams of several batches against the batch."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from prospectra.operators import ledger
from prospectra.operators.ledger import DAY, Decider, Rules
from prospectra.plans import queries
from prospectra.streaming.events import drained
from prospectra.streaming.ledger import ledger_stream, with_state_store

from .conftest import SF


def decider(per_run, per_day, **more):
    return Decider(Rules(per_run, per_day, **more))


def test_goldens():
    d = decider(10, 10)
    assert d.decide(0, "Ann@v.example", "r", "valid") == ("valid", False, True, "charged")
    assert d.decide(1, "ann@V.example ", "r", "valid") == ("valid", True, False, "cached")
    d = decider(2, 10)
    assert [d.decide(0, f"{x}@v.example", "r", "valid")[3] for x in "abc"] == ["charged", "charged", "run_budget_reached"]
    d = decider(10, 2)
    assert [d.decide(0, f"{x}@v.example", x, "valid")[3] for x in "abc"] == ["charged", "charged", "day_budget_reached"]
    assert d.decide(DAY, "c@v.example", "c", "valid")[3] == "charged"
    d = decider(1, 10)
    assert d.decide(0, "a@v.example", "r", "timeout") == ("deferred", False, True, "call_failed")
    assert d.decide(0, "b@v.example", "r", "valid")[3] == "run_budget_reached"
    d = decider(9, 9)
    d.decide(0, "a@v.example", "r", "timeout")
    assert d.decide(DAY, "a@v.example", "r", "valid")[3] == "cached"
    assert d.decide(DAY, "a@v.example", "r", "valid", retry=True)[3] == "charged"
    assert d.decide(200 * DAY, "a@v.example", "r", "invalid")[3] == "charged"
    assert d.decide(0, None, "r", "valid") == ("deferred", False, False, "invalid_email_input")


def test_switch_key_and_balance():
    d = decider(1, 1)
    assert d.decide(0, "a@v.example", "r", "valid", enabled=False) == ("deferred", False, False, "disabled")
    assert d.decide(0, "a@v.example", "r", "valid", key=False)[3] == "no_api_key"
    d = decider(9, 9, reserve=100)
    assert d.decide(0, "a@v.example", "r", "valid", known_balance=True)[3] == "credit_check_failed"
    assert d.decide(0, "a@v.example", "r", "valid", balance=100, known_balance=True)[3] == "reserve_reached"
    assert d.decide(0, "a@v.example", "r", "open", balance=101, known_balance=True)[3] == "reserved"
    assert d.decide(1, "a@v.example", "r", "valid")[3] == "already_inflight"
    assert d.decide(301, "a@v.example", "r", "valid")[3] == "charged"
    assert d.decide(302, "a@v.example", "r", "valid", enabled=False)[3] == "cached"
    assert decider(9, 9, fail_closed=False).decide(0, "a@v.example", "r", "valid", known_balance=True)[3] == "charged"


def test_reservations_count_for_their_run_and_the_day():
    d = decider(1, 3)
    d.decide(0, "a@v.example", "r", "open")
    assert d.decide(0, "b@v.example", "r", "valid")[3] == "run_budget_reached"
    assert d.decide(0, "b@v.example", "other", "valid")[3] == "charged"
    d.decide(0, "c@v.example", "third", "open")
    assert d.decide(0, "d@v.example", "fourth", "valid")[3] == "day_budget_reached"
    assert d.decide(300.5, "d@v.example", "r", "valid")[3] == "charged"
    d = decider(1, 9, run_days=2)
    d.decide(0, "a@v.example", "r", "valid")
    assert d.decide(2 * DAY, "b@v.example", "r", "valid")[3] == "run_budget_reached"
    assert d.decide(2 * DAY + 1, "b@v.example", "r", "valid")[3] == "charged"


def test_cap_of_a_venue():
    d = decider(9, 9, per_venue=2, run_days=3)
    ask = lambda x, ts=0, run="r", venue="v1": d.decide(ts, f"{x}@v.example", run, "valid", venue=venue)[3]
    assert [ask(x) for x in "abca"] == ["charged", "charged", "venue_cap_reached", "venue_cap_reached"]
    assert ask("a", venue="v2") == "cached" and ask("c", venue="v2") == "charged" and ask("d", venue=None) == "charged"
    assert ask("e", run="other") == "charged" and ask("f", 4 * DAY) == "charged"
    assert decider(9, 9).decide(0, "a@v.example", "r", "valid", venue="v1")[3] == "charged"


SCHEMA = "account string, seq long, ts timestamp, email string, run_id string, outcome string, retry_unknown boolean, enabled boolean, has_key boolean, balance double, venue_id string"
RULES = Rules(3, 4, days=3, unknown_days=1, hold=4000, reserve=10, run_days=2, per_venue=2)


def request_rows(n=400, step=timedelta(minutes=20)):
    rng, start = random.Random(1), datetime(2024, 1, 1)
    one = lambda k: (str(k % 3), k, start + k * step, rng.choice(["", "nobody", *[f" U{x}@v.example" for x in range(12)]]), rng.choice(["", *[f"r{k // 60 + x}" for x in range(2)]]), rng.choice(["valid", "timeout", "invalid", "open", None]), rng.random() < 0.2, rng.random() < 0.95, rng.random() < 0.95, rng.choice([None, 5.0, 50.0, 50.0, 50.0]), rng.choice([None, "v1", "v2", "v3"]))
    return [one(k) for k in range(n)]


def folded(rows, rules=RULES):
    out, deciders = set(), {}
    for a, seq, ts, email, run, outcome, retry, enabled, key, balance, venue in rows:
        at = (ts - datetime(1970, 1, 1)).total_seconds()
        out.add((a, seq, *deciders.setdefault(a, Decider(rules)).decide(at, email, run, outcome, retry, balance, True, enabled, key, venue)))
    return out


def taken(df):
    return {(r.account, r.seq, r.status, r.cached, r.charged, r.reason) for r in df.collect()}


def test_batch_is_the_fold(spark):
    rows = request_rows()
    want = folded(rows)
    reasons = {x[-1] for x in want}
    assert reasons == {"invalid_email_input", "cached", "disabled", "no_api_key", "run_budget_reached", "day_budget_reached", "already_inflight", "credit_check_failed", "reserve_reached", "reserved", "charged", "call_failed", "venue_cap_reached"}
    df = spark.createDataFrame(rows, SCHEMA)
    assert taken(ledger.decisions(df, RULES)) == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    assert taken(ledger.decisions(df, RULES)) == want
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_batch_awkward(spark):
    assert ledger.decisions(spark.createDataFrame([], SCHEMA), RULES).collect() == []
    rows = [(None, 1, datetime(2024, 1, 1), "a@v.example", None, None, None, None, None, 50.0, None), (None, 2, datetime(2024, 1, 2), "A@v.example", None, "valid", None, None, None, None, None), ("x", 1, datetime(2024, 1, 1), None, "r", "valid", False, True, True, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert taken(ledger.decisions(df, RULES)) == {(None, 1, "unknown", False, True, "charged"), (None, 2, "unknown", True, False, "cached"), ("x", 1, "deferred", False, False, "invalid_email_input")}
    bare = df.select("account", "seq", "ts", "email", "run_id", "outcome")
    assert Counter(x[-1] for x in taken(ledger.decisions(bare, RULES))) == Counter(["charged", "cached", "invalid_email_input"])


def stream_of(spark, path, parts):
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(path / f"in/part={k}"))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(path / "in/*"))


@pytest.fixture
def store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    with_state_store(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_stream_of_many_batches_is_the_batch(spark, tmp_path, store):
    rows = request_rows()
    cuts = [0, 3, 60, 61, 150, 290, 400]
    stream = stream_of(spark, tmp_path, [rows[a:b] for a, b in zip(cuts, cuts[1:])])
    assert taken(drained(ledger_stream(stream, RULES), "ledger")) == folded(rows)


def test_reservation_outlives_its_batch_and_expires(spark, tmp_path, store):
    at = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    ask = lambda seq, s, email, outcome="valid", balance=50.0, key=True: ("x", seq, at(s), email, "r", outcome, False, True, key, balance, None)
    parts = [[ask(1, 0, "a@v.example", "open"), ask(2, 1, "a@v.example")], [ask(3, 200, "a@v.example"), ask(4, 201, "b@v.example", key=False), ask(5, 202, "b@v.example", balance=None), ask(6, 203, "b@v.example", balance=10.0)], [ask(7, 301, "a@v.example")]]
    rules = Rules(5, 5, reserve=10)
    got = taken(drained(ledger_stream(stream_of(spark, tmp_path, parts), rules), "holds"))
    reasons = [x[-1] for x in sorted(got)]
    assert reasons == ["reserved", "already_inflight", "already_inflight", "no_api_key", "credit_check_failed", "reserve_reached", "charged"]
    assert got == folded([r for p in parts for r in p], rules)


def test_timers_leave_no_state(spark, tmp_path, store):
    """An account that doesn't come again is forgotten: its entries are gone from the store once all have lapsed."""
    at = lambda d: datetime(2024, 1, 1) + timedelta(days=d)
    ask = lambda seq, d, account, outcome="valid": (account, seq, at(d), f"u{seq}@v.example", "r", outcome, False, True, True, 50.0, "v1")
    parts = [[ask(1, 0, "gone"), ask(2, 0, "gone", "timeout"), ask(3, 0, "gone", "open")], [ask(4, 1, "other")], [ask(5, 9, "other")], [ask(6, 10, "other")], [ask(7, 11, "other")]]
    stream = stream_of(spark, tmp_path, parts)
    q = ledger_stream(stream, RULES).writeStream.format("memory").queryName("tidy").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    q.awaitTermination()
    read = lambda name: spark.read.format("statestore").option("stateVarName", name).load(str(tmp_path / "check"))
    for name in ("cache", "runs", "day", "inflight", "venues", "due"):
        accounts = {r[0] for r in read(name).select(F.col("key.account") if "account" in str(read(name).schema["key"].dataType) else F.col("key.groupingKey.account")).collect()}
        assert "gone" not in accounts, name


def test_budgets_at_a_time(spark):
    at = lambda s: datetime(2024, 1, 2) + timedelta(seconds=s)
    row = lambda seq, s, email, run, outcome: ("x", seq, at(s), email, run, outcome, False, True, True, 50.0, None)
    rows = [row(1, -50000, "a@v.example", "r", "valid"), row(2, 0, "b@v.example", "r", "timeout"), row(3, 5, "c@v.example", "r", "open"), row(4, 10, "d@v.example", "s", "open"), row(5, 400, "c@v.example", "s", "valid")]
    made = ledger.decisions(spark.createDataFrame(rows, SCHEMA), Rules(3, 9, reserve=10))

    def view(s, **more):
        return {r.run_id: tuple(r)[2:] for r in ledger.budgets(made, Rules(3, 9, reserve=10), F.lit(at(s)), **more).collect()}

    assert view(20) == {"r": (2, 1, 1, 2, "run_budget_reached"), "s": (0, 1, 1, 2, "ok")}
    assert view(306) == {"r": (2, 0, 1, 1, "ok"), "s": (0, 1, 1, 1, "ok")}
    assert view(400) == {"r": (2, 0, 2, 0, "ok"), "s": (1, 0, 2, 0, "ok")}
    assert view(20, balance=F.lit(10.0))["r"][-1] == "reserve_reached" and view(20, balance=F.lit(None).cast("double"))["s"][-1] == "credit_check_failed"


def test_every_step_decides_something_in_the_query(spark):
    reasons = {r.reason for r in queries.QUERIES["ledger_decisions"](spark, SF).select("reason").distinct().collect()}
    assert len(reasons) == 13
