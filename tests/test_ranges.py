"""Sums, sessions and inserts over groups that are far larger than a task's share, against plain Python."""

import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from prospectra.operators import audit, crud
from prospectra.operators.ranges import running
from prospectra.sources.files import log_lines


@pytest.fixture
def many_parts(spark):
    """Small tables stay in as many ranges as large ones."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_running_sums(spark, many_parts):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "a", "a", "b"]), k, rng.randrange(5)) for k in range(3000)]
    got = {r.k: r.total for r in running(spark.createDataFrame(rows, "g string, k long, v long"), ["g"], ["k"], {"total": "v"}).collect()}
    for g in (None, "a", "b"):
        mine = [(k, v) for x, k, v in rows if x == g]
        assert [got[k] for k, _ in mine] == list(accumulate(v for _, v in mine))
    assert running(spark.createDataFrame([], "g string, k long, v long"), ["g"], ["k"], {"total": "v"}).collect() == []


def log(rng, n):
    for k in range(n):
        yield rng.choices([f"== venue {k} ==", "email: a@b.example", f"email: x{k}@b.example", f"site: s{k}", "site: ", "noise"], [1, 2, 4, 4, 1, 20])[0]


def plain_sessions(lines):
    out = {}
    session = 0
    for line in lines:
        if line is None:
            continue
        if line.startswith("== "):
            session += 1
            out[session] = [line[3:-3], 0, None, None]
        if session:
            s = out[session]
            s[1] += 1
            if line.startswith("email: "):
                s[2] = s[2] or line[7:]
            if line.startswith("site: ") and line[6:]:
                s[3] = line[6:]
    return out


GRAMMAR = {"header": "^== (.*) ==$", "first": {"email": r"^email: (\S+)"}, "last": {"site": r"^site: (\S+)"}}


def test_sessions_of_one_log_in_many_parts(spark, many_parts):
    lines = list(log(random.Random(2), 20000))
    lines[500] = None
    rows = spark.createDataFrame([("one", k, x) for k, x in enumerate(lines)] + [("none", k, "noise") for k in range(50)], "log string, at long, line string")
    found = audit.log_sessions(rows, ["log"], ["at"], "line", **GRAMMAR)
    got = {r.session: [r.title, r.n_lines, r.email, r.site] for r in found.collect()}
    assert got == plain_sessions(lines) and len(got) > 300
    # The window form takes a log to one task and says the same.
    window = audit.sessions(rows.where("line is not null"), "log", "at", "line", "^== (.*) ==$", GRAMMAR["first"])
    assert {(r.session, r.title, r.n_lines, r.email) for r in window.collect()} == {(k, *v[:3]) for k, v in got.items()}


def test_sessions_of_a_file_in_many_splits(spark, many_parts, tmp_path):
    lines = list(log(random.Random(3), 30000))
    (tmp_path / "a.log").write_text("\n".join(lines))
    (tmp_path / "b.log").write_text("\n".join(reversed(lines)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    read = log_lines(spark, str(tmp_path))
    assert read.rdd.getNumPartitions() > 20
    got = {(r.file[-5], r.session): [r.title, r.n_lines, r.email, r.site] for r in audit.log_sessions(read, ["file"], ["offset", "row"], "line", **GRAMMAR).collect()}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {(name, k): v for name, x in (("a", lines), ("b", lines[::-1])) for k, v in plain_sessions(x).items()}


def test_sessions_of_nothing(spark):
    rows = spark.createDataFrame([], "log string, at long, line string")
    assert audit.log_sessions(rows, ["log"], ["at"], "line", **GRAMMAR).collect() == []


# ---------------------------------------------------------------- inserts

VENUE = "venue_id string, name string, city string, website string, state string, category string, _ord long"


def plain_inserts(old, new):
    """Rows in order: one that shares name and city, or name and domain, with what is there already is left out."""
    site = lambda w: (w or "").split("/")[0].lower()
    have = [((r[1] or "").strip().lower(), (r[2] or "").strip().lower(), site(r[3])) for r in old]
    cities, domains = {(n, c) for n, c, _ in have}, {(n, d) for n, _, d in have if d}
    kept = []
    for r in sorted(new, key=lambda r: r[-1]):
        n, c, d = (r[1] or "").strip().lower(), (r[2] or "").strip().lower(), site(r[3])
        if (n, c) in cities or (d and (n, d) in domains):
            continue
        cities.add((n, c))
        domains.add((n, d))
        domains.discard((n, ""))
        kept.append(r[-1])
    return kept


@pytest.mark.parametrize("rounds", [0, 1, 6])
def test_inserts_match_the_loop(spark, monkeypatch, rounds):
    monkeypatch.setattr(crud, "ROUNDS", rounds)
    monkeypatch.setattr(crud.first_of_each, "__defaults__", (rounds,))
    rng = random.Random(rounds)
    row = lambda k: ("", rng.choice([None, "", "Inn", " inn ", "Oak"]), rng.choice([None, "", *[f"c{x}" for x in range(9)]]), rng.choice([None, "", *[f"d{x}.example/x" for x in range(9)]]), "md", "hotel", k)
    old, new = [row(k) for k in range(6)], [row(k) for k in range(100, 400)]
    got = crud.insert_venues(spark.createDataFrame(old, VENUE), spark.createDataFrame(new, VENUE)).collect()
    want = plain_inserts(old, new)
    assert sorted(r._ord for r in got) == want
    assert [r.venue_id for r in sorted(got, key=lambda r: r._ord)] == [f"MD-HOTE-{k:03}" for k in range(1, len(want) + 1)]


def test_chain_longer_than_the_rounds(spark):
    """Neighbours share a city and a domain by turns, so that each decision waits for the one before."""
    new = [("", "Inn", f"c{k // 2}", f"d{(k + 1) // 2}.example", "md", "hotel", k) for k in range(60)]
    got = crud.insert_venues(spark.createDataFrame([], VENUE), spark.createDataFrame(new, VENUE)).collect()
    assert sorted(r._ord for r in got) == plain_inserts([], new) == list(range(0, 60, 2))


def test_a_hundred_thousand_rows_of_one_name_and_prefix(spark, many_parts):
    new = spark.range(100_000).select(F.lit("").alias("venue_id"), F.lit("Inn").alias("name"), F.concat(F.lit("c"), F.col("id") % 40_000).alias("city"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("d"), F.col("id") % 70_000)).otherwise("").alias("website"), F.lit("MD").alias("state"), F.lit("hotel").alias("category"), F.col("id").alias("_ord"))
    out = crud.insert_venues(spark.createDataFrame([("MD-HOTE-007", "x", "y", "", "MD", "hotel", -1)], VENUE), new)
    rows = out.select("venue_id", "_ord", F.spark_partition_id().alias("part")).collect()
    assert sorted(r._ord for r in rows) == list(range(40_000))
    assert [r.venue_id for r in sorted(rows, key=lambda r: r._ord)] == [f"MD-HOTE-{k:03}" for k in range(8, 40_008)]
    sizes = {}
    for r in rows:
        sizes[r.part] = sizes.get(r.part, 0) + 1
    assert len(sizes) > 5 and max(sizes.values()) < 20_000


def test_contacts_of_one_prefix(spark, many_parts):
    schema = "contact_id string, venue_id string, name string, title string, email string, verified string, is_generic boolean, _ord long"
    new = spark.range(20_000).select(F.lit("").alias("contact_id"), F.lit("V-1").alias("venue_id"), F.lit("Ann").alias("name"), F.lit("").alias("title"), F.concat(F.lit("a"), F.col("id") % 15_000, F.lit("@v.example")).alias("email"), F.lit("valid").alias("verified"), F.lit(False).alias("is_generic"), F.col("id").alias("_ord"))
    old = spark.createDataFrame([("C-120", "V-1", "Ann", "", "A3@v.example", "valid", False, 0)], schema).drop("is_generic")
    rows = crud.insert_contacts(old, new).collect()
    assert sorted(r._ord for r in rows) == [k for k in range(15_000) if k != 3]
    assert {r.contact_id for r in rows} == {f"C-{k}" for k in range(121, 121 + 14_999)}
