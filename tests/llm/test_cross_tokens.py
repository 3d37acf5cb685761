"""Alignment against whole texts, encoded by the libraries and compared pair by pair."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from prospectra.llm import cross_tokens
from prospectra.llm.common import table
from prospectra.llm.cross_tokens import Aligner, ByteVocabulary, PieceVocabulary, alignments, default_vocabularies, op11_cross_tokens, overlaps

from ..conftest import SF
from .helpers import AWKWARD, awkward, empty, texts

PIECES = [" ", " ", " ", "  ", "   ", "\n", " \n", "\n ", "\t", "\r\n", "\x1c", "\x85", " ", "　", "a", "the", "worthless", "It's", "'LL", "é", "123", "...", "日本", "🙂", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "<unk>", "x" * 70, "\x00", "ﬁ", "́"]


def fuzz(n, seed, more=()):
    rng = random.Random(seed)
    return ["".join(rng.choice([*PIECES, *more]) for _ in range(rng.randrange(1, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def vocabularies():
    a, b = default_vocabularies()
    return ByteVocabulary(a), PieceVocabulary(b)


def slow(vocabularies, text):
    """Token ids of both, groups and linked pairs with how often, by the ranges of the whole text; None without tokens."""
    if not text:
        return None
    a, b = vocabularies[0].encode([" " + text])[0], vocabularies[1].encode([text])[0]
    ends = []
    for v, ids in zip(vocabularies, (a, b)):
        if b"".join(v.bytes[i] for i in ids) != (" " + text).encode():
            return None
        ends.append(np.cumsum([len(v.bytes[i]) for i in ids]).tolist())
    place = [{e: k + 1 for k, e in enumerate(x)} for x in ends]
    groups, done = [], [0, 0]
    for e in sorted({*ends[0]} & {*ends[1]}):
        upto = [x[e] for x in place]
        groups.append("|".join(",".join(map(str, ids[d:u])) for ids, d, u in zip((a, b), done, upto)))
        done = upto
    owner = [[k for k, i in enumerate(ids) for _ in v.bytes[i]] for v, ids in zip(vocabularies, (a, b))]
    links = Counter((a[i], b[j]) for i, j in set(zip(*owner)))
    return len(a), len(b), groups, links


def slow_rows(vocabularies, rows):
    found = [(i, slow(vocabularies, t)) for i, t in rows]
    count = Counter(p for _, x in found if x for p in x[3])
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for i, x in found:
        if not x:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        best = sum(n for p, n in x[3].items() if count[p] == top[p[0]])
        out.append((i, x[0], x[1], len(x[2]), sum(x[3].values()), best, sum(n * count[p] for p, n in x[3].items()), hashlib.sha256(";".join(x[2]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_overlaps():
    first, last = overlaps(np.array([2, 3, 9, 10]), np.array([1, 5, 9, 10]))
    assert list(zip(first, last)) == [(0, 1), (1, 1), (1, 2), (3, 3)]


def test_chunks_are_tokens_of_the_whole(vocabularies):
    aligner = Aligner(*default_vocabularies())
    rows = fuzz(3000, 1) + ["▁", "a ▁b", "x  ▁ y"] + fuzz(300, 2, ["▁"])
    for text, (chunks, said) in zip(rows, aligner.align(rows)):
        want = slow(vocabularies, text)
        assert (said != b"") == (want is not None), text
        if want:
            sizes = aligner.tables()
            assert [int(sizes[k][chunks].sum()) for k in range(4)] == [want[0], want[1], len(want[2]), sum(want[3].values())], text
            assert said.decode() == ";".join(want[2]), text


def test_op11_is_brute_force(spark, vocabularies):
    got = sorted((tuple(r) for r in op11_cross_tokens(table(spark, SF, "documents")).collect()), key=str)
    assert got == slow_rows(vocabularies, texts(SF))


def test_small_units_and_memory(spark, vocabularies, monkeypatch):
    """Workers are forked from the driver's settings only in functions that are shipped, so units are made here."""
    import pyarrow as pa

    rows = list(enumerate(fuzz(400, 3, ["▁"])))
    aligner = Aligner(*default_vocabularies())
    made = []
    for number, lo in enumerate(range(0, len(rows), 37)):
        part = rows[lo : lo + 37]
        made.append(cross_tokens.unit_of(number, aligner, [i for i, _ in part], [(x, hashlib.sha256(said).hexdigest() if said else "") for x, said in aligner.align([t for _, t in part])]))
        if number % 3 == 2:
            aligner.clear()
    count, top = Counter(), defaultdict(int)
    pairs = [x.column("pairs")[0].as_py() for x in made]
    for p in (p for unit in pairs for p in unit):
        count[p["a"], p["b"]] += p["n"]
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    got = []
    for unit, own in zip(made, pairs):
        random.Random(1).shuffle(own)
        told = pa.table({"k": pa.array([p["k"] for p in own], pa.int32()), "docs": pa.array([count[p["a"], p["b"]] for p in own], pa.int64()), "best": pa.array([count[p["a"], p["b"]] == top[p["a"]] for p in own], pa.bool_())})
        got += [tuple(r.values()) for r in cross_tokens.summed(pa.Table.from_batches([unit]), told).to_pylist()]
    assert sorted(got, key=str) == slow_rows(vocabularies, rows)


def test_op11_awkward(spark, vocabularies):
    got = sorted((tuple(r) for r in op11_cross_tokens(awkward(spark)).collect()), key=str)
    assert got == slow_rows(vocabularies, AWKWARD)
    assert op11_cross_tokens(empty(spark)).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string")
    assert sorted(map(tuple, op11_cross_tokens(nothing).collect())) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2, 3)]


def test_groups_are_given_back(spark, vocabularies):
    from prospectra.llm.cross_tokens import token_groups

    rows = [(k, t) for k, t in enumerate(fuzz(80, 5, ["▁"])) ] + [(None, "no id"), (900, None), (901, "")]
    got = {(r.doc_id, ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in r.groups)) for r in token_groups(spark.createDataFrame(rows, "doc_id long, text string"), *default_vocabularies()).collect()}
    assert got == {(k, ";".join(x[2]) if (x := slow(vocabularies, t)) else "") for k, t in rows}


def test_pair_counts_are_whole(spark, vocabularies):
    docs = spark.createDataFrame([(1, "the cat"), (2, "the cat"), (3, "the dog's")], "doc_id long, text string")
    counts = {(r.a, r.b): (r.docs, r.best) for r in alignments(docs, *default_vocabularies())[1].collect()}
    want = Counter(p for t in ("the cat", "the cat", "the dog's") for p in slow(vocabularies, t)[3])
    assert {p: n for p, (n, _) in counts.items()} == want
