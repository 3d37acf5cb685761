import random

import pytest
from pyspark.sql import functions as F

from prospectra.operators import crud, graph, selection
from prospectra.operators import relational as rel
from prospectra.streaming import events

from .conftest import SF


# ---------------------------------------------------------------- crawl fixture

SITE = "https://site.example.org"
PAGES = [
    (f"{SITE}/", '<a href="/events#events-cta">Events</a> <a href=\'/about.html\'>About</a>'),
    (f"{SITE}/events/", '<a href="/deep/team.html">t</a> <a href="/private-events.pdf">p</a> person [at] venue [dot] example'),
    (f"{SITE}/about.html", '<a href="https://www.instagram.com/the.site/">ig</a> <a href="https://other.example.org/">o</a>'),
    (f"{SITE}/deep/team.html", '<a href="https://facebook.com/TheSite">fb</a> ann@site.example.org'),
    (f"{SITE}/hidden/private-events.html", "hidden@site.example.org"),
]


def test_crawl(spark):
    pages = spark.createDataFrame(PAGES, "url string, html string")
    got = {r.url: r.depth for r in graph.crawl(pages, pages.limit(1).select("url")).collect()}
    assert got == {f"{SITE}/": 0, f"{SITE}/events": 1, f"{SITE}/about.html": 1, f"{SITE}/deep/team.html": 2, f"{SITE}/private-events.pdf": 2}
    assert {r.dst: r.kind for r in graph.unvisited(pages).collect()} == {f"{SITE}/private-events.pdf": "pdf", "https://other.example.org/": "page", "https://www.instagram.com/the.site": "page", "https://facebook.com/TheSite": "page"}
    assert {r.fragment for r in graph.edges(pages).collect()} == {"", "events-cta"}
    assert {r.entity for r in graph.provenance(pages).collect()} == {"person@venue.example", "ann@site.example.org", "hidden@site.example.org", "https://www.instagram.com/the.site/", "https://www.facebook.com/TheSite/"}


def test_streams_equal_batches(spark):
    batch = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    # Windows still open when a stream ends are not written.
    want = {tuple(r) for r in events.tumbling(batch).collect()}
    got = {tuple(r) for r in events.drained(events.tumbling(events.event_stream(spark, f"{SF}/events.parquet*")), "hours").collect()}
    assert got <= want and len(got) > 0.9 * len(want)
    assert events.drained(events.first_seen(events.event_stream(spark, f"{SF}/events.parquet*")), "seen").count() == batch.count()
    assert events.drained(events.user_sessions(events.event_stream(spark, f"{SF}/events.parquet*")), "sess").count() > 0


# ---------------------------------------------------------------- writes


def test_fold_and_merge(spark):
    table = spark.createDataFrame([("a", "untouched", "X"), ("b", "pipelined", "Y")], "venue_id string, status string, city string")
    log = spark.createDataFrame([("a", "status", "contacted", 1, "t1"), ("a", "nonsense", "z", 2, "t2"), ("b", "status", "contacted", 3, "t3"), ("b", "status", "closed", 4, "t4"), ("b", "city", None, 5, "t5")], "venue_id string, field string, value string, _ord long, at string")
    got = {r.venue_id: tuple(r)[1:] for r in crud.fold_changes(table, log, "venue_id", ["status", "city"]).collect()}
    assert got == {"a": ("contacted", "X", "t1"), "b": ("closed", None, "t3")}
    rows = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], "k string, v int, _ord long")
    new = spark.createDataFrame([("b", 3, 3), ("b", 4, 4), ("c", 5, 5)], "k string, v int, _ord long")
    assert {tuple(r)[:2] for r in crud.merge(rows, new, "k").collect()} == {("a", 1), ("b", 4), ("c", 5)}
    assert {r.k for r in crud.insert_absent(rows, new, ["k"]).collect()} == {"c"}
    config = spark.createDataFrame([("Skip", "x", 1)], "key string, value string, _ord long")
    assert [tuple(r) for r in crud.upserted_config(config, config.withColumn("value", F.lit("y"))).collect()] == [("skip", "y")]
    one = table.withColumn("check_status", F.lit("a:DONE|b:FAILED")).select(crud.saved_step("check_status", F.lit("b"), F.lit("DONE")).alias("x"), crud.saved_step("check_status", F.lit("b"), F.lit("odd")).alias("y")).first()
    assert one.x["b"].status == "DONE" and one.y["b"].status == "FAILED"


def test_rejects(spark):
    df = spark.createDataFrame([("", "a@b.example", False), ("Ann", "Info@b.example", False), ("Front Desk ", "a@b.example", False), ("Ann", "ann@b.example", False), ("Ann", "", None), ("", "info@b.example", True), ("Owner", "owner@b.example", True)], "name string, email string, g boolean")
    assert [r[0] for r in df.select(crud.contact_reject("name", "email", "g")).collect()] == ["no name", "role mailbox", "role as name", None, None, None, None]
    urls = spark.createDataFrame([("https://a.example/x.PNG?v=1",), ("https://a|b",), ("https://sites.google.com/x",), ("https://a.example/",), ("a.fandom.com",)], "u string")
    assert [r[0] for r in urls.select(crud.website_reject("u")).collect()] == ["asset", "several", "junk domain", None, "junk domain"]


def test_gig_overall(spark):
    df = spark.createDataFrame([(8, 7, 9, 8), (10, 7, 9, 8), (0, None, 9, 8)], "a int, b int, c int, d int")
    assert [r[0] for r in df.select(rel.gig_overall(*"abcd")).collect()] == [8.0, 8.5, 6.8]
    assert df.select(rel.gig_overall(*"abcd", on_insert=False)).collect()[2][0] == 4.3


# ---------------------------------------------------------------- batches


def picked(pool, n):
    """The batch rules as loops over a sorted list."""
    pool = sorted(pool, key=lambda v: (-v["composite"], -v["upscale_score"], v["state_rank"], v["name"].lower(), v["_ord"]))
    sets = {"french": ["restaurant"], "clubs": ["country_club", "private_club"], "hotels": ["hotel"], "wine": ["winery", "wine_bar"], "wild": ["art_gallery", "museum", "event"]}
    batch, used = [], set()
    for bucket, limit in selection.quotas(n).items():
        for v in [v for v in pool if v["category"] in sets[bucket] and (bucket != "french" or "bistro" in v["name"])][: max(0, limit)]:
            batch.append(v)
            used.add(v["venue_id"])
    batch += [v for v in pool if v["venue_id"] not in used][: max(0, n - len(batch))]
    used = {v["venue_id"] for v in batch}
    home, cap = ("DC", "VA", "MD"), max(2, n // 10)
    edge = sorted((v for v in batch if v["state"] not in home), key=pool.index)
    if len(edge) > cap:
        gone = {v["venue_id"] for v in edge[cap:]}
        batch = [v for v in batch if v["venue_id"] not in gone]
        batch += [v for v in pool if v["venue_id"] not in used and v["state"] in home][: max(0, n - len(batch))]
    return [v["venue_id"] for v in sorted(batch, key=pool.index)]


@pytest.mark.parametrize("n", [1, 5, 10, 20, 60])
def test_batch(spark, n):
    rng = random.Random(n)
    pool = [{"venue_id": f"v{k}", "name": rng.choice(["bistro a", "b", "c"]), "category": rng.choice(["restaurant", "country_club", "hotel", "winery", "museum", "other"]), "state": rng.choice(["DC", "MD", "VA", "PA", "DE"]), "composite": rng.randrange(12) / 2, "confidence": 0.9, "upscale_score": float(rng.randrange(6)), "state_rank": rng.randrange(6), "_ord": k} for k in range(80)]
    got = selection.batch(spark.createDataFrame(pool), n).orderBy("place").collect()
    assert [r.venue_id for r in got] == picked(pool, n)


def test_funnel_counts_every_row(spark):
    from prospectra.plans.queries import QUERIES

    counts = QUERIES["skip_reason_histogram"](spark, SF).agg(F.sum("n")).first()[0]
    assert counts == spark.read.parquet(f"{SF}/customer.parquet").count()


def test_traps(spark):
    """A venue without a name is held in every gig's name, and a rejected venue has claimed its site."""
    venues = spark.createDataFrame([("1", ""), ("2", "Blue Inn"), ("3", "Inn"), ("4", "Oak")], "venue_id string, name string")
    gigs = spark.createDataFrame([("9", "The Blue Inn")], "venue_id string, venue_name string")
    assert {r.venue_id for r in rel.anti_by_name(venues, gigs).collect()} == {"4"}


@pytest.mark.parametrize("most", [1 << 20, 150, 0])
def test_contained_names_by_every_way(spark, most):
    """Automaton of the others, automaton of the own names, or the rarest three letters: the same names."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefg é") for _ in range(rng.randrange(3, n)))
    own, other = {word(9) for _ in range(60 if most == 150 else 300)} - {""}, {word(14) for _ in range(300)} - {""}
    if most == 150:
        own = set(sorted(own)[:20])
    want = {x for x in own if any(x in y or y in x for y in other)}
    df = lambda names: spark.createDataFrame([(x,) for x in sorted(names)], "name string")
    got = [r.name for r in rel.contained_names(df(own), df(other), most).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want != own
    assert rel.contained_names(df(own), df([]), most).collect() == [] == rel.contained_names(df([]), df(other), most).collect()
