"""Mixing against plain Python: targets by rounds of resharing, positions by bisection of the integral."""

import hashlib
import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from prospectra.llm.common import table
from prospectra.llm.mixing import OP12_SQL, SCHEDULES, integral, mix, n_words, op12_source_mixing, training_order

from ..conftest import SF
from .helpers import awkward, empty

COUNT = lambda t: len((t or "").encode().split())


def slow_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Shares the words out by weight, stops what is above, and shares the excess again until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    fixed, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in open_)
        part = {s: left * weight[s] / total for s in open_} if open_ else {}
        above = [s for s in open_ if part[s] > most * sizes[s]]
        if not above:
            return {**fixed, **part}
        for s in above:
            fixed[s] = most * sizes[s]
            left -= fixed[s]


def slow_time(knots, part):
    def given(t):
        total = 0.0
        for (t1, w1), (t2, w2) in zip(knots, knots[1:]):
            if t > t1:
                end = min(t, t2)
                total += (end - t1) * (w1 + w1 + (w2 - w1) * (end - t1) / (t2 - t1)) / 2
        return total

    lo, hi, asked = 0.0, 1.0, part * integral(knots)
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if given(mid) > asked else (mid, hi)
    return hi


def rows_of(df):
    return [(r.doc_id, r.source, r.text) for r in df.collect()]


def check(spark, docs, schedules=SCHEDULES, share=1.5, most=2.0):
    rows = rows_of(docs)
    sizes = defaultdict(int)
    for _, source, text in rows:
        sizes[source] += COUNT(text)
    wanted = slow_targets(sizes, [integral(k) for k in schedules], share, most)
    rank = {s: k for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    got = mix(docs, schedules, share, most).collect()
    assert len(got) == len(rows)
    assert sorted((str(r.doc_id), str(r.source), r.size) for r in got) == sorted((str(i), str(s), COUNT(t)) for i, s, t in rows)
    by_source = defaultdict(list)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, wanted[r.source], rel_tol=1e-12, abs_tol=1e-9)
        by_source[r.source].append(r)
    for source, found in by_source.items():
        demand = math.floor(found[0].target + 0.5)
        assert sum(c.words for r in found for c in r.copies) == min(demand, math.ceil(most) * sizes[source])
        found.sort(key=lambda r: (hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest(), r.doc_id is not None, r.doc_id or 0, r.size, [c.position for c in r.copies]))
        at = 0
        for r in found:
            starts = [at + k * sizes[source] for k in range(math.ceil(most))]
            expect = [(k, min(r.size, demand - s), slow_time(schedules[rank[source] % len(schedules)], s / demand)) for k, s in enumerate(starts) if min(r.size, demand - s) > 0]
            assert [(c["pass"], c.words) for c in r.copies] == [x[:2] for x in expect]
            assert all(abs(c.position - x[2]) < 1e-9 for c, x in zip(r.copies, expect))
            at += r.size
    return got


def test_words_are_counted():
    import re

    for t in ["", " ", "a", " a ", "a b", "\ta\r\nb\x0b", "\x1ca\x1d b", "日 本\x00", " x y z"]:
        assert COUNT(t) == len(re.findall(r"[^\x20\x09-\x0D]+", t))


def test_native_word_count(spark):
    texts = ["", " ", "a", " a ", "a  b", "\ta\r\nb\x0b", "\x1ca\x1d b", "日 本\x00", " x y z", "🙂 🙂\n", "x " * 50000, None]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", n_words(F.coalesce("t", F.lit(""))).alias("n")).collect()
    assert {r.k: r.n for r in got} == {k: COUNT(t) for k, t in enumerate(texts)}


def test_mix_matches_brute_force(spark):
    docs = table(spark, SF, "documents")
    check(spark, docs)
    skewed = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).when(F.col("doc_id") % 7 == 0, "ß").when(F.col("doc_id") % 2 == 0, "Z").otherwise("a"))
    check(spark, skewed)
    check(spark, skewed, [[(0.0, 0.0), (0.25, 0.0), (0.5, 4.0), (1.0, 0.0)], [(0.0, 1.0), (1.0, 1.0)]], 2.5, 3.0)


def test_targets_that_stop(spark):
    texts = {"a": 1, "b": 40, "c": 400, "d": 3, "e": 50, "f": 7, "g": 0}
    rows = [(k, s, "w " * n) for k, (s, n) in enumerate(texts.items())]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.source: r.target for r in check(spark, docs)}
    assert got["a"] == 2 and got["d"] == 6 and got["g"] == 0 and 400 < got["c"] < 800


@pytest.fixture
def many_parts(spark):
    """Small tables stay in as many ranges as large ones."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_mix_over_many_ranges(spark, many_parts):
    check(spark, table(spark, SF, "documents").withColumn("source", F.when(F.col("doc_id") % 5 > 0, "hot").when(F.col("doc_id") % 3 == 0, "cold")))


def test_order_is_a_training_run(spark, many_parts):
    mixed = mix(table(spark, SF, "documents"))
    parts = training_order(mixed).rdd.glom().collect()
    rows = [r for part in parts for r in part]
    assert len(parts) > 1 and [r.position for r in rows] == sorted(r.position for r in rows)
    at = 0
    for r in rows:
        assert r.first_word == at
        at += r.words
    by_time = defaultdict(lambda: [0, 0])
    for r in rows:
        by_time[r.source][r.position >= 0.5] += r.words
    early, late = by_time["src0"], by_time["src10"]  # first and third by name: falling and rising schedules
    assert early[0] > early[1] and late[0] < late[1]


def test_op12_is_its_sql(spark):
    import duckdb

    docs = table(spark, SF, "documents")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(OP12_SQL)
    names = ["doc_id", "size", "source_size", "target", "taken"]
    assert want.columns == names and op12_source_mixing(docs).columns == names
    got = sorted(map(tuple, op12_source_mixing(docs).collect()))
    assert got == sorted(want.fetchall()) and got == sorted(map(tuple, op12_source_mixing(docs.repartition(7)).collect()))
    assert all(r[4] <= 2 * r[1] for r in got)


def test_mixing_awkward(spark):
    docs = awkward(spark).withColumn("source", F.when(F.col("doc_id") > 7, "x"))
    got = check(spark, docs)
    assert len(got) == docs.count()
    assert sorted(r.taken for r in op12_source_mixing(docs).collect())[-1] > 0
    assert op12_source_mixing(empty(spark)).collect() == []
    nothing = spark.createDataFrame([(1, None, None), (2, "x", " ")], "doc_id long, source string, text string")
    assert sorted(tuple(r) for r in op12_source_mixing(nothing).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_schedules_are_checked():
    assert [integral(k) for k in SCHEDULES] == [5, 2, 1]
    for bad in ([(0.0, 1.0)], [(0.0, 1.0), (0.5, 1.0)], [(0.0, -1.0), (1.0, 2.0)], [(0.0, 0.0), (1.0, 0.0)], [(0.0, 1.0), (0.6, 1.0), (0.5, 1.0), (1.0, 1.0)]):
        with pytest.raises(ValueError):
            integral(bad)
