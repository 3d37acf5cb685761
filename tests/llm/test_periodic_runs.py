"""Runs against their definition, tried on every stretch."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from prospectra.llm.common import table
from prospectra.llm.periodic_runs import collapse, collapsed, op13_periodic_runs, runs_of, runs_of_documents, woven

from ..conftest import SF
from .helpers import AWKWARD, LONG, awkward, empty, texts


def slow_runs(words, power=4, least=6):
    """For each period, the maximal stretches of words that equal those one period before; of equal stretches the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, power * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def slow_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = slow_runs(words)
    runs.sort(key=lambda r: (r[0], r[2]))
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    top = None
    for r in runs:
        if top is None or r[1] * top[2] > top[1] * r[2]:
            top = r
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = b" ".join(w for k, w in enumerate(words) if k not in gone)
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def strings(rng, count):
    for _ in range(count):
        kind, n = rng.randrange(4), rng.randrange(1, 90)
        x = [rng.randrange(rng.choice((1, 2, 3, 50))) for _ in range(n)]
        if kind:
            p, a = rng.randrange(1, 12), rng.randrange(n)
            x = x[:a] + [x[a + k % p] if a + k % p < n else 7 for k in range(rng.randrange(80))] + x[a:]
        if kind == 3:
            x = x + x + x + x
        yield x


@pytest.mark.parametrize(("power", "least"), [(4, 6), (3, 1), (5, 12)])
def test_runs_are_those_of_the_definition(power, least):
    for x in strings(random.Random(power), 400):
        assert [tuple(r) for r in runs_of(np.array(x), power, least).tolist()] == sorted(slow_runs(x, power, least), key=lambda r: (r[0], r[2])), x


def test_candidates_in_slices(monkeypatch):
    from prospectra.llm import periodic_runs

    monkeypatch.setattr(periodic_runs, "SLICE_CANDIDATES", 3)
    for x in strings(random.Random(9), 100):
        assert [tuple(r) for r in runs_of(np.array(x)).tolist()] == sorted(slow_runs(x), key=lambda r: (r[0], r[2]))


def test_documents_share_no_block(monkeypatch):
    from prospectra.llm import periodic_runs

    docs = [[b"a"] * 4, [b"a"] * 4, [], [b"a"] * 8, [b"b", b"a"] * 6]
    for words in (1, 10, 1000):
        monkeypatch.setattr(periodic_runs, "SLICE_WORDS", words)
        assert [r.tolist() for r in runs_of_documents(docs)] == [[], [], [], [[0, 8, 1]], [[0, 12, 2]]]


def test_power_below_three_is_refused():
    with pytest.raises(ValueError):
        runs_of(np.arange(3), 2)


def test_weave_and_collapse():
    assert collapsed([b"x", *[b"a", b"b"] * 5, b"y"], np.array([[1, 10, 2]])) == [b"x", b"a", b"b", b"y"]
    k = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    words = [str(i).encode() for i in range(200)]
    assert woven(k, words) != words and len(woven(k, words)) == 200 and woven(k, []) == [] and woven(None, words) == words


def test_op13_is_brute_force(spark):
    got = {tuple(r) for r in op13_periodic_runs(table(spark, SF, "documents")).collect()}
    assert got == {slow_row(i, t) for i, t in texts(SF)}
    assert sum(r[1] > 0 for r in got) > 10


def test_op13_awkward(spark):
    got = sorted(map(tuple, op13_periodic_runs(awkward(spark)).collect()), key=str)
    assert got == sorted((slow_row(i, t) if t != LONG else row_of_long(i) for i, t in AWKWARD), key=str)
    assert op13_periodic_runs(empty(spark)).collect() == []


def row_of_long(doc_id):
    listed = hashlib.sha256(b"0,30000,1\n").hexdigest()
    return (doc_id, 1, 0, 30000, 1, 30_000_000, listed, hashlib.sha256(b"lang").hexdigest())


def test_collapse_gives_texts(spark):
    rows = {r.doc_id: r for r in collapse(awkward(spark).where("doc_id is not null")).collect()}
    assert rows[8].text == "lang" and [tuple(x) for x in rows[8].runs] == [(0, 30000, 1)]
    assert rows[1].text == "" and rows[1].runs == [] and rows[11].text == "tab here and there"
