import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from prospectra.llm import exact_dedup, hyperminhash, line_dedup
from prospectra.llm.common import new_path, table
from prospectra.llm.components import components

from ..conftest import SF
from .helpers import AWKWARD, awkward, empty, fold, texts


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def exact_want(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[fold(t)].append(i)
    return {i: (max(g), len(g), i == max(g), hashlib.sha256(k).hexdigest()) for k, g in groups.items() for i in g}


def test_exact_groups(spark):
    got = by_id(exact_dedup.op5_exact_dedup(table(spark, SF, "documents")))
    assert {i: tuple(r)[1:] for i, r in got.items()} == exact_want(texts(SF))


def test_exact_awkward_and_weak_digest(spark):
    want = exact_want([r for r in AWKWARD if r[0] is not None])
    for digest in (exact_dedup.digest_of, lambda t: F.unhex(F.lit("00")), lambda t: F.unhex(F.substring(F.sha2(t.cast("binary"), 256), 1, 2))):
        got = exact_dedup.exact_groups(awkward(spark), digest=digest).collect()
        assert len(got) == len(AWKWARD) - 1
        assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got} == {i: w[:3] for i, w in want.items()}
    assert exact_dedup.exact_groups(empty(spark)).count() == 0
    assert exact_dedup.exact_dedup(awkward(spark)).columns == awkward(spark).columns


def test_hot_group_is_verified_in_parts(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.exact_groups(docs)
    assert got.where("keep_id = 2997").count() == 1000 and got.where("kept").count() == 2001


def repeated_ids(seed=2):
    """Rows whose doc_id repeats with equal, near and other texts."""
    rng, rows = random.Random(seed), []
    base = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(12)]
    for _ in range(160):
        text = rng.choice(base).split()
        for _ in range(rng.randrange(3)):
            text[rng.randrange(60)] = f"x{rng.randrange(5)}"
        rows.append((rng.randrange(40), rng.choice([str, str.upper, str.title])(" ".join(text))))
    return [(3, "A"), (5, "A"), (5, "B"), (7, "B"), (9, "same text"), (5, "same text"), (5, "only here"), (6, "twin"), (6, "twin"), (6, "Twin"), (8, None), (8, ""), *rows]


def test_exact_dedup_with_repeated_ids(spark):
    rows = repeated_ids()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = defaultdict(list)
    for i, t in rows:
        groups[fold(t)].append(i)
    got = exact_dedup.exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(map(tuple, got)) == sorted((i, max(g), len(g), i == max(g)) for g in groups.values() for i in g)
    for keep, best in (("largest", max), ("smallest", min)):
        left = exact_dedup.exact_dedup(docs, keep).collect()
        assert sorted((fold(r.text), r.doc_id) for r in left) == sorted((k, best(g)) for k, g in groups.items())


def test_index_has_levels_and_filters_and_reopens(spark):
    path, batches = new_path(spark, "index"), [range(k * 700, k * 700 + 1000) for k in range(6)]
    keyed = lambda ids: spark.createDataFrame([(str(i // 2).encode(), i) for i in ids], "digest binary, id long")
    index = exact_dedup.DigestIndex(spark, path, memtable_rows=100, fanout=3)
    assert index.probe(keyed([1])).count() == 0
    want = defaultdict(list)
    for k, ids in enumerate(batches):
        if k == 4:
            index = exact_dedup.DigestIndex(spark, path, memtable_rows=100, fanout=3)
        index.flush(keyed(ids))
        for i in ids:
            want[str(i // 2).encode()].append(i)
        assert {bytes(r.digest): (r.id, r.members) for r in index.read().collect()} == {d: (min(x), len(x)) for d, x in want.items()}
    assert sorted(level for level, _ in index.runs) == [1, 1]
    again = exact_dedup.DigestIndex(spark, path)
    assert sorted(again.runs) == sorted(index.runs)
    asked = keyed(range(4000, 6000))
    got = {(bytes(r.digest), r.id): (r.first_id, r.members) for r in again.probe(asked).collect()}
    assert got == {(d, i): (min(want[d]), len(want[d])) for i in range(4000, 6000) if (d := str(i // 2).encode()) in want}
    # The filter alone stops nearly all others.
    assert exact_dedup.let_through(asked, exact_dedup.filter_of(again.read())).count() <= len(got) + 20
    # One sorted file a memtable.
    index.flush(keyed(range(950)))
    run = next(r for level, r in index.runs if level == 0)
    files = spark.read.parquet(f"{path}/{run}/rows").groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.collect_list("digest").alias("d")).collect()
    assert len(files) >= 10 and all(r.n <= 100 and r.d == sorted(r.d) for r in files)


def sets_of(rows):
    out = {}
    for i, t in rows:
        w = fold(t).split()
        out.setdefault(i, set()).update({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return out


def near_want(sets):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_near_duplicates_match_brute_force(spark):
    got = by_id(hyperminhash.op10_minhash_near_dedup(table(spark, SF, "documents")))
    assert {i: tuple(r)[1:] for i, r in got.items()} == near_want(sets_of(texts(SF)))


def test_near_duplicates_around_the_threshold(spark):
    rng, rows = random.Random(3), []
    for base in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([1, 3, 6, 9, 40, 150]))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(25):
            other = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 12)):
                other[rng.randrange(len(other))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(other)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(hyperminhash.near_duplicates(docs))
    assert {i: tuple(r)[1:] for i, r in got.items()} == near_want(sets_of(rows))


def test_near_awkward(spark):
    got = hyperminhash.near_duplicates(awkward(spark))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (2, 6), 7: (2, 6), 8: (1, 8), 9: (1, 8), 10: (1, 10), 11: (1, 11)}
    assert hyperminhash.near_duplicates(empty(spark)).count() == 0
    assert hyperminhash.near_dedup(awkward(spark)).columns == awkward(spark).columns


def test_near_duplicates_with_repeated_ids(spark):
    rows = repeated_ids()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # Brute force over rows, numbered in order of doc_id, so that a component's first row has its smallest doc_id.
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    want = near_want(sets_of([(n, rows[k][1]) for n, k in enumerate(order)]))
    component = {n: rows[order[w[1]]][0] for n, w in want.items()}
    got = hyperminhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted((rows[order[n]][0], w[0], component[n], rows[order[n]][0] == component[n]) for n, w in want.items())
    left = hyperminhash.near_dedup(docs).collect()
    of = {rows[order[n]]: w[1] for n, w in want.items() if w[0]}
    assert sorted(of[tuple(r)] for r in left if r.text) == sorted({w[1] for w in want.values() if w[0]})
    assert all(r.doc_id == component[of[tuple(r)]] for r in left if r.text) and sum(not r.text for r in left) == 2


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}


def line_want(rows, shortest=20):
    first, seen = {}, []
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for k, line in enumerate((t or "").split("\n")):
            line = re.sub(r"[\t\r]", " ", line).strip(" ")
            if line:
                seen.append((i, k, line))
                first.setdefault(line, (i, k))
    parent = {x: x for x in first}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    groups = defaultdict(list)
    for x in first:
        for k in range(len(x)) if len(x) >= shortest else ():
            cut = x[:k] + x[k + 1 :]
            groups[k, cut].append(x)
            if cut in first and len(cut) >= shortest:
                groups[k, cut].append(cut)
    for g in groups.values():
        for x in g[1:]:
            a, b = sorted((find(g[0]), find(x)), key=first.get)
            parent[b] = a if a != b else b
    gone = defaultdict(set)
    for i, k, x in seen:
        if first[find(x)] != (i, k):
            gone[i].add(k)
    return gone


def test_lines_match_brute_force(spark):
    rng, rows = random.Random(5), texts(SF)[:60]
    lines = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(15, 45))) for _ in range(40)]
    for i in range(100):
        out = []
        for _ in range(5):
            x = rng.choice(lines)
            k = rng.randrange(len(x))
            out.append(rng.choice([x, x[:k] + x[k + 1 :], x[:k] + "q" + x[k:], x[:k] + "q" + x[k + 1 :], x[:k] + "qq" + x[k:]]))
        rows.append((10000 + i, "\n".join(out)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, got = line_want(rows), by_id(line_dedup.op6_line_dedup(docs))
    assert {i: set(map(int, filter(None, r.dropped.split(",")))) for i, r in got.items()} == {i: want[i] for i, _ in rows}
    cleaned = by_id(line_dedup.dedup_lines(docs))
    assert all(cleaned[i].text == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[i]) for i, t in rows)


def test_links_of_lines_are_counted_whole(spark):
    base, other = "the same template line 0 of page 1", "aaaaaaaaaaaaaaaaaaaaaaaa"
    lines = [base.replace("0", c) for c in "0123456789"] + [base.replace("0", ""), base.replace("0", "55"), base.replace("1", "2"), base.replace("1", "3").replace("0", "7")]
    lines += [other, other[1:], other[2:], "b" + other[1:], other[:-1] + "b", "c" + other[1:], "a line that has no partner at all"]
    short = ["short 1", "short 2", "short 3"]
    rows = [(k, x) for k, x in enumerate([*lines, *short])] + [(900, base + "\n" + other), (901, None)]
    n = dict.fromkeys([*lines, *short], 0)
    cuts = lambda x: {x[:k] + x[k + 1 :] for k in range(len(x))}
    for x in lines:
        for y in lines:
            if x != y and (len(x) == len(y) and sum(c != d for c, d in zip(x, y, strict=True)) == 1 or x in cuts(y) or y in cuts(x)):
                n[x] += 1
    got = {r.doc_id: r.n_links for r in line_dedup.op6_line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: sum(n[x] for x in (t or "").split("\n") if x) for i, t in rows}
    assert n[base] == 11


def test_lines_with_repeated_ids(spark):
    line = "the quick brown fox jumps over the dog number {}"
    rows = [(3, "A"), (5, "A"), (5, "B"), (7, "B\nC")]
    rows += [(10 + k % 5, line.format(chr(97 + k)) + f"\nonly in {k}") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.op6_line_dedup(docs).collect()
    assert len(got) == len(rows) and sum(r.n_links for r in got) == 20 * 19
    left = line_dedup.dedup_lines(docs).collect()
    kept = sorted(x for r in left for x in r.text.split("\n") if x)
    assert [x for x in kept if x in ("A", "B", "C")] == ["A", "B", "C"]
    assert sum(x.startswith("the quick") for x in kept) == 1 and sum(x.startswith("only in") for x in kept) == 20


def sql_rows(sql, **tables):
    import duckdb

    with duckdb.connect() as db:
        for name, rows in tables.items():
            db.execute(f"CREATE TABLE {name} (doc_id bigint, text varchar)")
            db.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
        found = db.sql(sql)
        return sorted(tuple(r) for r in found.project(", ".join(sorted(found.columns))).fetchall())


def test_lines_match_their_sql_on_neighbourhoods(spark):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdef ") for _ in range(30)).strip() + "." for _ in range(6)]
    change = lambda x, k, c: rng.choice([x[:k] + c + x[k + 1 :], x[:k] + x[k + 1 :], x[:k] + c + x[k:], x])
    rows = [(i, "\n".join(change(rng.choice(base), rng.randrange(30), rng.choice("xyz")) for _ in range(4))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "short\nshort\nshorx")]
    got = line_dedup.op6_line_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.select(*sorted(got.columns)).collect())) == sql_rows(line_dedup.OP6_SQL, documents=rows)
    assert max(r.n_links for r in got.collect()) > 20


def test_lines_awkward(spark):
    got = {r.doc_id: r.dropped for r in line_dedup.op6_line_dedup(awkward(spark)).collect()}
    assert got[1] == "" and got[9] == "0" and len(got) == 11
    assert line_dedup.op6_line_dedup(empty(spark)).count() == 0
    assert line_dedup.dedup_lines(awkward(spark)).columns == awkward(spark).columns
