import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from prospectra.llm import chat_format, decontamination, pitman_yor, sharding, token_records, toxicity, word_bpe
from prospectra.llm.common import Words, new_path, pack, table, unpack

from ..conftest import SF
from .helpers import AWKWARD, awkward, empty, fold, texts

PIECES = [" ", " ", " ", "  ", "\n", "\n", " \n", "\t", "\r\n", " ", " ", "\x1c", "\x85", "a", "the", "worthless", "It's", "'LL", "Σ", "ΑΣ", "İ", "é", "é", "123", "...", "日本", "🙂", "ß", "<|endoftext|>", "<|startoftext|>", "<|", "x" * 90, "\x00", "ﬁ", "ẛ̣"]


def fuzz(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(14))) for _ in range(n)]


def tokenizer(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def test_words_are_those_of_the_pattern():
    import pyarrow as pa

    rows = [t.encode() for t in [*fuzz(200), "", " ", "A b"]]
    w = Words(pa.array(rows, pa.binary()))
    found = [[] for _ in rows]
    for k, d in enumerate(w.doc):
        found[d].append(w.word(k))
    assert found == [r.lower().split() for r in rows]
    same = {}
    for k in range(len(w.hash)):
        assert same.setdefault(w.word(k), w.hash[k]) == w.hash[k]
    assert len(set(same.values())) == len(same)


def test_pack_round_trip():
    arrays = [np.arange(5, dtype=np.uint64), np.zeros(0, np.uint32), np.array([-1.5, 2.0]), np.array([3], np.int64)]
    assert all(a.dtype == b.dtype and (a == b).all() for a, b in zip(arrays, unpack(pack(*arrays)), strict=True))


# ---------------------------------------------------------------- 1


def test_encoder_is_the_library():
    path = token_records.default_tokenizer()
    t, e = tokenizer(path), token_records.Encoder(path, 4)
    rows = fuzz(1500)
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(rows)] == [t.encode(r, add_special_tokens=False).ids for r in rows]


def test_letters_go_to_the_model_itself(monkeypatch):
    """op1_token_records: new words of letters went through the library's pipeline for texts, which takes longer than its model does."""
    path = token_records.default_tokenizer()
    t, e = tokenizer(path), token_records.Encoder(path, 2)
    whole, ids = [], e._ids
    monkeypatch.setattr(e, "_ids", lambda text: whole.append(text) or ids(text))
    latin = "naïve Straße\nélan oferedeation thonanhe " + "lang" * 60
    texts_ = [latin, f"{latin}, {latin}!", "ªº ǅ words", "日本語 и ʰ a1 don't (x) ***"]
    assert [np.frombuffer(x, "<u2").tolist() for x in e.encode(texts_[:1])] == [t.encode(latin, add_special_tokens=False).ids] and not whole
    for _ in range(2):
        assert [np.frombuffer(x, "<u2").tolist() for x in e.encode(texts_)] == [t.encode(x, add_special_tokens=False).ids for x in texts_]


def test_records_round_trip(spark):
    folder, path = new_path(spark, "records"), token_records.default_tokenizer()
    manifest = token_records.write_records(awkward(spark), path, 2, folder)
    entries = token_records.read_index(manifest)
    got = sorted(token_records.read_records(entries).collect(), key=lambda r: (r.doc_id, r.start))
    t, start = tokenizer(path), 0
    rows = sorted(((i, x or "") for i, x in AWKWARD if i is not None), key=lambda r: r[0])
    assert len(got) == len(rows)
    for r, (i, x) in zip(got, rows, strict=True):
        ids = [*t.encode(x, add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids, r.ids_crc32) == (i, start, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    mixed = token_records.read_records(token_records.shuffled(entries, 7)).collect()
    assert sorted(map(str, mixed)) == sorted(map(str, got))
    assert token_records.op1_token_records(empty(spark)).count() == 0


def test_damaged_records_are_found():
    record = token_records.framed(b"12345678payload")
    assert token_records.unframed(record)[0] == b"12345678payload"
    for at in range(len(record)):
        with pytest.raises(ValueError):
            token_records.unframed(record[:at] + bytes([record[at] ^ 1]) + record[at + 1 :])


def test_op1_over_documents(spark):
    got = token_records.op1_token_records(table(spark, SF, "documents"))
    assert got.count() == len(texts(SF)) and got.where("start = 0").count() == 1


# ---------------------------------------------------------------- 7


def test_word_bpe_is_the_library():
    path = word_bpe.default_vocabulary()
    t, b = tokenizer(path), word_bpe.WordBpe(path)
    for r in [*fuzz(1500, 2), *(x[:3000] for _, x in texts(SF)[:40])]:
        ids = t.encode(r, add_special_tokens=False).ids
        raw, decoded = b.encode(r)
        assert np.frombuffer(raw, "<u4").tolist() == ids
        assert decoded == b.decode(np.array(ids)) == t.decode(ids, skip_special_tokens=False)


def test_scan_and_heap_agree():
    b, rng = word_bpe.WordBpe(word_bpe.default_vocabulary()), random.Random(2)
    for _ in range(300):
        w = "".join(rng.choice("theinger") for _ in range(rng.randrange(1, 80))).encode()
        ids = [*map(b.inner.__getitem__, w[:-1]), b.last[w[-1]]]
        assert b._scan(list(ids)) == b._heap(list(ids))


def test_op7_rows(spark):
    got = word_bpe.op7_bpe_codec(awkward(spark)).collect()
    assert len(got) == len(AWKWARD)
    blank = hashlib.sha256(b"").hexdigest()
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == (0, blank, blank) for r in got if r.doc_id in (1, 2, 3))
    assert word_bpe.op7_bpe_codec(empty(spark)).count() == 0
    full = word_bpe.encoded(awkward(spark), word_bpe.default_vocabulary()).where("doc_id = 4").first()
    assert full.decoded == "one</w>" and len(full.ids) == 1


# ---------------------------------------------------------------- 2


def test_toxicity_learns_and_scores(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("aeionrst") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    rows = []
    for i in range(900):
        w = [rng.choice(words) for _ in range(60)]
        if i % 4 == 0:
            w[rng.randrange(60)] = rng.choice(["stupidish", "morons", "idiotic"])
        rows.append((i, " ".join(w), int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    labels = docs.select("doc_id", F.col("label").alias("toxic")).where("doc_id < 700")
    got = {r.doc_id: r for r in toxicity.op2_toxicity(docs, labels).collect()}
    fresh = [got[i] for i in range(700, 900)]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in fresh) >= 190
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, labels).collect()}
    assert len([i for i in kept if i % 4 == 0]) < 30 and len(kept) > 640


def grams_want(text):
    t = " " + "".join(c if ord(c) > 0xFFFF or c.isalnum() else " " for c in text.lower()) + " "
    out = set()
    for n in range(3, 7):
        for i in range(len(t) - n + 1):
            g = t[i : i + n]
            if " " not in g[1:-1] and not (g[0] == " " and g[-1] == " "):
                h = 0
                for c in g:
                    h = (h * 0x100000001B3 + ord(c)) % 2**64
                out.add((h * 0x9E3779B97F4A7C15 % 2**64) >> (64 - toxicity.HASH_BITS))
    return out


def test_features_are_those_of_the_definition(monkeypatch):
    rows = ["", "a", "ab", "one two", "İstanbul ÉTÉ naïve", "🙂🙂 x", "a.b,c  d", "x" * 50, *fuzz(60)]
    for limit in (1 << 18, 40):
        monkeypatch.setattr(toxicity, "PASS_CHARS", limit)
        assert [set(k.tolist()) for k in toxicity.features(rows)] == [grams_want(r) for r in rows]
        assert all(len(k) == len(set(k.tolist())) for k in toxicity.features(rows))


def test_fit_and_scores_match_brute_force(spark):
    rng, rows = random.Random(3), []
    for i in range(60):
        w = [rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(6)] + (["rotten"] if i % 3 == 0 else [])
        rows.append((i, " ".join(w), int(i % 3 == 0 or i == 7)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    weights, bias = toxicity.fit(docs, docs.select("doc_id", F.col("label").alias("toxic")), steps=200)
    n, sets, y = 1 << toxicity.HASH_BITS, [grams_want(t) for _, t, _ in rows], np.array([c for *_, c in rows])
    seen = np.zeros((2, n))
    for keys, c in zip(sets, y, strict=True):
        seen[c, list(keys)] += 1
    ratio = np.log((seen[1] + 1) / (seen[1].sum() + n)) - np.log((seen[0] + 1) / (seen[0].sum() + n))
    assert np.allclose(toxicity.log_ratios(seen[0], seen[1]), ratio)
    used = sorted(set().union(*sets))
    x = np.array([[ratio[k] if k in s else 0 for k in used] for s in sets])
    w = weights[used] / ratio[used]
    want = 1 / (1 + np.exp(-(x @ w + bias)))
    got = {r.doc_id: r.score for r in toxicity.scores(docs, weights, bias).collect()}
    assert np.allclose([got[i] for i, *_ in rows], want, atol=1e-5)
    # The loss is convex: its gradient vanishes at the optimum alone.
    slope = np.append((x.T @ (want - y) + w) / len(y), (want - y).mean())
    assert np.abs(slope).max() < 1e-4 and not weights[np.setdiff1d(np.arange(n), used)].any()
    fewer, _ = toxicity.fit(docs, docs.select("doc_id", F.col("label").alias("toxic")), least_docs=10, steps=5)
    assert not fewer[(seen.sum(axis=0) < 10)].any() and fewer.any()


def test_toxicity_with_repeated_ids(spark):
    docs = spark.createDataFrame([(i % 7, f"good words {i}" if i % 7 else f"vile rotten {i}", 1) for i in range(70)] + [(None, "vile", 1)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, int(i == 0)) for i in range(7)] + [(3, 0)], "doc_id long, toxic int")
    assert toxicity.sampled(docs, labels, 100).count() == 7
    got = toxicity.op2_toxicity(docs, labels).collect()
    assert len(got) == 71 and {r.predicted for r in got if r.doc_id == 0} == {1} and {r.predicted for r in got if r.doc_id} == {0}


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumn("toxic", F.when(toxicity.fold() == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(toxicity.op2_toxicity(docs, labels).collect()) == sorted(toxicity.op2_toxicity(docs, turned).collect())


def test_toxicity_awkward(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    nulls = spark.createDataFrame([(None, 1, 1), (4, 1, None), (5, None, 0), (99, 1, 1), (6, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, nulls):
        got = toxicity.op2_toxicity(awkward(spark), labels)
        assert got.count() == len(AWKWARD) and got.where("score between 0 and 1").count() == len(AWKWARD)
        assert toxicity.op2_toxicity(empty(spark), labels).count() == 0


# ---------------------------------------------------------------- 3


def lm_want(rows):
    count, tokens = Counter(), {}
    for i, t in rows:
        tokens[i] = [*fold(t).split(), None]
        if zlib.crc32(str(i).encode()) % 10:
            count.update(tokens[i])
    n, v = sum(count.values()), len(count)
    return {i: (zlib.crc32(str(i).encode()) % 10 == 0, len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for i, w in tokens.items()}


def test_lm_counts_and_scores(spark):
    want = lm_want(texts(SF))
    got = {r.doc_id: r for r in pitman_yor.op3_lm_scoring(table(spark, SF, "documents")).collect()}
    assert set(got) == set(want)
    for i, (held, n, known, total, base) in want.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert abs(r.base_score - base) < 1e-6 and r.score < 0
    fresh = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in fresh) > sum(r.base_score for r in fresh)


TWO = ["a b c a b d e f g h a b a b a b", "a c d c a b a a b b"]


def lm_state(model):
    """The model as plain dicts: customers and tables of each sample by (word, context), root tables by word."""
    n, c, t, seats = len(model.totals.tables), {}, [{} for _ in model.totals.tables], [{} for _ in model.totals.tables]
    for r in model.state.select("blob").collect():
        b = pitman_yor.Bucket.read(bytes(r.blob))
        assert (b.own.customers() == b.count[b.several]).all() and (b.own.size > 0).all() and len(b.kept) == 2 * n
        for k in range(len(b.count)):
            pair = (int(b.word[b.at[k]]), int(b.context[k]))
            assert pair not in c
            c[pair] = int(b.count[k])
            for s in range(n):
                t[s][pair] = int(b.kept[2 * s][k])
        for s in range(n):
            seats[s].update({int(w): int(x) for w, x in zip(b.word, b.kept[2 * s + 1], strict=True) if x})
    return c, t, seats


@pytest.mark.parametrize("head", [pitman_yor.HEAD, 6])
def test_model_matches_brute_force(spark, monkeypatch, head):
    """With the second, only words of a sixth of the tokens have restaurants of their own: the others' roots and pooled contexts are checked."""
    monkeypatch.setattr(pitman_yor, "HEAD", head)
    model = pitman_yor.train(spark.createDataFrame(list(enumerate(TWO)), "doc_id long, text string"))
    totals, (c, t, seats) = model.totals, lm_state(model)
    import pyarrow as pa

    words = dict(zip("a b c d e f g h".split(), map(int, Words(pa.array([b"a b c d e f g h"], pa.binary())).hash), strict=True))
    end, count = int(pitman_yor.END), Counter(w for x in TWO for w in [*x.split(), None])
    assert totals.types == 9 and totals.tokens == sum(count.values()) == sum(c.values())
    place = {int(h): k for k, h in enumerate(totals.head)}
    begin = len(totals.head)
    assert begin == (9 if head > 6 else 3)
    restaurant = lambda code: place.get(code, begin + 1 + (code >> 20) % pitman_yor.CLASSES)
    of = {None: end, **words}
    pairs = Counter()
    for x in TWO:
        before = begin
        for w in [*x.split(), None]:
            pairs[of[w], before] += 1
            before = restaurant(of[w])
    assert pairs == Counter(c)

    def chance(word, context):
        """From customers and tables alone."""
        total = 0
        for s in range(len(t)):
            root_c = {w: sum(x for (v, _), x in t[s].items() if v == w) for w in of.values()}
            root_t = {w: seats[s].get(w, 0) for w in of.values()}
            if word in place and not root_t[word]:  # a frequent word: its root tables are not in a bucket, so take its share as given
                root = totals.head_root[s][place[word]]
            else:
                all_c, all_t = totals.root[s]
                assert all_c == sum(root_c.values())
                root = (max(root_c.get(word, 0) - totals.root_discount * root_t.get(word, 0), 0) + (pitman_yor.ROOT_STRENGTH + totals.root_discount * all_t) / (totals.types + 1)) / (pitman_yor.ROOT_STRENGTH + all_c)
            size = sum(x for (_, v), x in c.items() if v == context)
            tables = sum(x for (_, v), x in t[s].items() if v == context)
            total += (max(c.get((word, context), 0) - totals.discount * t[s].get((word, context), 0), 0) + (pitman_yor.STRENGTH + totals.discount * tables) * root) / (pitman_yor.STRENGTH + size)
        return total / len(t)

    for context in {v for _, v in c} | {begin + 7}:
        assert abs(sum(chance(w, context) for w in [*of.values(), 12345]) - 1) < 1e-9
    asked = ["", "a", "b", "a b", "h h h", "zzz", "a zzz a", *TWO]
    got = {r.doc_id: r.score for r in model.scores(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")).collect()}
    for i, x in enumerate(asked):
        want, before = 0, begin
        for w in [*x.split(), None]:
            if w == "zzz":
                code = int(Words(pa.array([b"zzz"], pa.binary())).hash[0])
            else:
                code = of[w]
            want += math.log10(chance(code, before))
            before = restaurant(code)
        assert abs(got[i] - want) < 1e-9


def test_lm_scores_do_not_depend_on_partitions(spark):
    docs = table(spark, SF, "documents").limit(150)
    docs = spark.createDataFrame(docs.select("doc_id", "text").collect(), "doc_id long, text string")
    found, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    for n in (2, 6):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append({r.doc_id: r.score for r in pitman_yor.op3_lm_scoring(docs.repartition(n)).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(abs(x - found[1][i]) < 1e-9 * abs(x) for i, x in found[0].items())


def partitions_of(n):
    """All ways for n customers to sit, as sorted table sizes, with how many ways there are."""
    ways = Counter({(1,): 1})
    for _ in range(n - 1):
        more = Counter()
        for sizes, k in ways.items():
            more[tuple(sorted([*sizes, 1]))] += k
            for j in range(len(sizes)):
                more[tuple(sorted([*sizes[:j], sizes[j] + 1, *sizes[j + 1 :]]))] += k
        ways = more
    return ways


def test_sweeps_keep_the_exact_distribution():
    strength, d, p, n = 1.5, 0.4, 0.3, 20000
    key = pitman_yor.keyed(np.arange(n, dtype=np.uint64), 5)
    weight = {}
    for sizes, k in partitions_of(5).items():
        w = 1.0
        for j, x in enumerate(sizes):
            w *= (strength + d * j) * p * math.prod(i - d for i in range(1, x))
        weight[sizes] = k * w
    seats = pitman_yor.Seating(np.ones(n), np.full(n, 5))
    for turn in range(12):
        seats.sweep(strength + d * seats.count, np.full(n, p), d, key, turn)
    ends = np.cumsum(seats.count)
    got = Counter(tuple(sorted(seats.size[a:b].tolist())) for a, b in zip(ends - seats.count, ends, strict=True))
    for sizes, w in weight.items():
        assert abs(got[sizes] / n - w / sum(weight.values())) < 0.015


def test_seating():
    rng = np.random.default_rng(0)
    c = np.array([1, 2, 5, 1000, 50000])
    key = pitman_yor.keyed(np.arange(5, dtype=np.uint64), 1)
    s = pitman_yor.Seating.first(c, np.full(5, 0.5), 0.5, key)
    assert (s.count >= 1).all() and (s.count <= c).all() and (s.customers() == c).all() and s.count[4] > 1 and (s.size > 0).all()
    assert (pitman_yor.Seating.first(c, np.zeros(5), 0.5, key).count == 1).all()
    # The mean number of tables of n customers, against sitting down one by one.
    for size in (20, 300):
        one = [1] * 4000
        for i in range(1, size):
            one = [k + (rng.random() < 0.6 / (0.6 + i - 0.5 * k)) for k in one]
        many = pitman_yor.Seating.first(np.full(4000, size), np.full(4000, 0.6), 0.5, pitman_yor.keyed(np.arange(4000, dtype=np.uint64), 2))
        assert abs(np.mean(one) - many.count.mean()) < 0.15
    want = np.array([1, 5, 4, 1500, 50003])
    after = s.adapt(want, np.full(5, 0.5), 0.5, key, 0)
    assert (after.customers() == want).all() and (after.size > 0).all()
    none = pitman_yor.Seating(np.zeros(0), np.zeros(0))
    none.sweep(np.zeros(0), np.zeros(0), 0.5, np.zeros(0, np.uint64), 0)
    assert len(none.customers()) == 0


def test_lm_awkward(spark):
    got = pitman_yor.op3_lm_scoring(awkward(spark)).collect()
    assert len(got) == len(AWKWARD) - 1 and {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert pitman_yor.op3_lm_scoring(empty(spark)).count() == 0


# ---------------------------------------------------------------- 4


def chat_want(rows):
    rows = [*rows, (-7, 0, "user", chat_format.PROBE), (-7, 1, "assistant", chat_format.PROBE)]
    talks = {}
    for c, t, r, x in rows:
        talks.setdefault(c, []).append((t or 0, r or "", x or ""))
    out = {}
    for c, turns in talks.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_over_conversations(spark):
    import pyarrow.parquet as pq

    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in pq.read_table(f"{SF}/conversations.parquet").to_pylist()]
    got = {r.conv_id: tuple(r)[1:5] for r in chat_format.op4_chat_format(table(spark, SF, "conversations")).collect()}
    assert got == chat_want(rows)


def test_chat_awkward(spark):
    hard = ["", None, "</turn>", "### User: ", "\\", "\\\\</turn>\\n", "##", "###", "####\n</turn", "a: b", "\\/", "🙂 ##\\#", "x" * 5000, "</turn>\n### Assistant: hi"]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(hard * 45)]
    rows += [(2, 0, "system", "be kind"), *((2, k, ["user", "assistant"][k % 2], f"word {k} " * 20) for k in range(1, 300))]
    rows += [(3, 0, None, None), (3, 0, "odd: role</turn>", "x"), (3, 1, "Ünï", "y"), (4, None, "assistant", "z"), (5, 3, "assistant", "tie"), (5, 3, "assistant", "tie")]
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], "conv_id long, turn long, role string, text string, window string, segment int")
    got = {r.conv_id: tuple(r)[1:5] for r in chat_format.op4_chat_format(df).collect()}
    assert got == chat_want(rows)
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.windows(none).count() == 0


def windows_want(turns, budget, history, turn_tokens, span):
    """(block, window, repeated turns, new turns) of one conversation, from the definition: turns are (role, text) in order."""
    cost = [max(1, turn_tokens + len((x or "").split())) for _, x in turns]
    at = [sum(cost[:k]) for k in range(len(turns))]
    fixed, out, k = (cost[0] if turns[0][0] == "system" else 0), [], 0
    while k < len(turns):
        block, past = at[k] // (span * budget), 0
        room = min(history, budget - fixed - cost[k])
        while k - past > 0 and at[k] - at[k - past - 1] <= room:
            past += 1
        held = (fixed if k else 0) + at[k] - at[k - past]
        again = list(range(k - past, k))
        if k and fixed and 0 not in again:
            again = [0, *again]
        stop, end = k + 1, at[k] + budget - held
        while stop < len(turns) and at[stop] // (span * budget) == block and at[stop] + cost[stop] <= end:
            stop += 1
        number = out[-1][1] + 1 if out and out[-1][0] == block else 0
        out.append((block, number, [turns[j] for j in again], [turns[j] for j in range(k, stop)], sum(cost[j] for j in [*again, *range(k, stop)])))
        k = stop
    return out


def test_chat_windows_match_brute_force(spark):
    rng, talks = random.Random(12), {}
    for c in range(40):
        n, big = rng.choice([1, 2, 5, 30, 120]), rng.choice([3, 12, 24, 40])
        turns = [(["user", "assistant"][k % 2], f"{c} {k} " + "w## \\ " * rng.randrange(big)) for k in range(n)]
        talks[c] = [("system", "be very kind"), *turns] if c % 2 else turns
    talks[90] = [("user", "a " * 15), ("assistant", "b " * 16), ("assistant", "c " * 16), ("user", "d " * 90)]  # turns of 19, 20, 20 tokens
    rows = [(c, k, *t, "w", 1) for c, turns in talks.items() for k, t in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string, segment int")
    esc = lambda x: x.replace("\\", "\\\\").replace("</turn>", "<\\/turn>").replace("##", "#\\#")
    for budget, history, span in ((24, 20, 1), (40, 10, 2), (120, 30, 16), (64, 0, 4)):
        got = {}
        for w in chat_format.windows(df, budget=budget, history=history, turn_tokens=4, span=span).collect():
            got.setdefault(w.conv_id, []).append((w.block, w.window, w.formatted, [(m.start, m.length) for m in w.mask], w["first"]))
        for c, turns in talks.items():
            want = []
            for block, window, again, new, tokens in windows_want(turns, budget, history, 4, span):
                assert tokens <= budget or len(new) == 1 and len(again) <= 1
                text, mask, first = "", [], 0
                for k, (role, x) in enumerate([*again, *new]):
                    first = len(text) if k == len(again) else first
                    text += f"### {role}: "
                    if k >= len(again) and role == "assistant":
                        mask.append((len(text), len(esc(x))))
                    text += esc(x) + "</turn>\n"
                want.append((block, window, text, mask, first))
            assert sorted(got[c]) == want, (c, budget)


def test_chat_parts_of_hot_conversations(spark):
    """Rows without conv_id or turn, equal rows and one long conversation."""
    rows = [(None, None, "user", "x y z")] * 300 + [(5, k, ["user", "assistant"][k % 2], f"t {k}") for k in range(2000)] + [(6, 1, "assistant", "w " * 5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.placed(df, 4, chat_format.word_tokens)
    got = sorted(r["at"] for r in out.where("conv_id is null").collect())
    assert got == [7 * k for k in range(300)]
    assert {r.conv_id: tuple(r)[1:5] for r in chat_format.op4_chat_format(df).collect()} == chat_want(rows)
    assert chat_format.windows(df, budget=100, history=50, span=2).where("conv_id = 5").count() > 100


# ---------------------------------------------------------------- 8


def test_dealing_is_a_heap():
    import heapq

    rng = random.Random(1)
    for _ in range(200):
        load = [rng.randrange(50) for _ in range(rng.randrange(1, 9))]
        size, count = rng.randrange(1, 9), rng.randrange(200)
        heap, given = [(x, k) for k, x in enumerate(load)], [0] * len(load)
        heapq.heapify(heap)
        for _ in range(count):
            x, k = heapq.heappop(heap)
            given[k] += 1
            heapq.heappush(heap, (x + size, k))
        assert sharding.deal(load, size, count) == given


def test_shards(spark):
    rows = texts(SF)
    got = sharding.op8_sharding(table(spark, SF, "documents")).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    text, load, slots, home = dict(rows), [0] * 40, {}, {}
    for r in got:
        raw = text[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        load[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
        assert home.setdefault(raw, r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Longest processing time over whole groups.
    groups = Counter()
    for _, t in rows:
        groups[t] += len(t.encode()) + 16
    want = [0] * 40
    for size in sorted(groups.values(), reverse=True):
        want[want.index(min(want))] += size
    assert sorted(load) == sorted(want)


def test_shards_awkward(spark):
    got = sharding.op8_sharding(awkward(spark)).collect()
    assert len(got) == len(AWKWARD)
    assert len({r.shard for r in got if r.doc_id in (1, 2)}) == 1
    assert sharding.op8_sharding(empty(spark)).count() == 0


# ---------------------------------------------------------------- 9


def align_want(a, b):
    best, h = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (1 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 25))] for _ in range(2))
        assert decontamination.align(np.array(a, np.uint64), np.array(b, np.uint64))[0] == align_want(a, b)


def test_contamination_finds_edited_copies(spark):
    rng = random.Random(6)
    make = lambda n: [f"v{rng.randrange(400)}" for _ in range(n)]
    items = [(k, make(rng.randrange(12, 60))) for k in range(30)]
    rows, want = [], set()
    for i in range(400):
        w = make(rng.randrange(0, 300))
        if i % 3 == 0:
            k, item = rng.choice(items)
            item = [rng.choice(["changed", x]) if rng.random() < 0.3 else x for x in item]
            at = rng.randrange(len(w) + 1)
            w[at:at] = item
            want.add((i, k))
        text = " ".join(w)
        rows.append((i, text.title() + "." if i % 2 else text.replace(" ", ", ", 5)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.op9_decontamination(docs, bench).collect()}
    # Brute force: every item against every text.
    for i, t in rows:
        w = "".join(c if c.isalnum() or c.isspace() else " " for c in t).lower().split()
        for k, item in items:
            score = align_want(item, w) if set(w) & set(item) else 0
            reached = score >= min(0.4 * len(item), 32)
            assert ((i, k) in got) == reached, (i, k, score, len(item))
            if reached:
                assert got[i, k] == score
    assert len(want & set(got)) >= 0.95 * len(want) and len(set(got) - want) <= 2
    left = {r.doc_id for r in decontamination.decontaminate(docs, bench).collect()}
    assert left == {i for i, _ in rows} - {i for i, _ in got}


def test_contamination_awkward(spark):
    bench = spark.createDataFrame([(1, "one two three four five six"), (2, None), (None, "x"), (3, ""), (4, "naïve"), (5, "one two three four five six")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.op9_decontamination(awkward(spark), bench).collect()}
    assert got == {(6, 1), (7, 1), (6, 5), (7, 5), (10, 4)}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.op9_decontamination(awkward(spark), none).count() == 0
    assert decontamination.op9_decontamination(empty(spark), bench).count() == 0


def test_parts_and_edits_of_hot_items_are_found(spark):
    rng = random.Random(9)
    items = {k: [f"{k}q{j}" for j in range(50)] for k in "ab"}
    edited = lambda w: ["changed" if j % 8 == 7 else x for j, x in enumerate(w)]
    a, b = items["a"], items["b"]
    # Heads of an item that is seldom whole, and parts without the head of one that mostly is.
    kinds = [(a[:30], 1000), (a, 10), (edited(a[:30]), 50), (a[:15], 90), (b, 1000), (b[20:], 50), (edited(b[15:]), 50), (b[40:], 50), ([], 700)]
    rows, kind_of = [], []
    for w, n in kinds:
        for _ in range(n):
            filler = lambda: [f"z{rng.randrange(999)}" for _ in range(rng.randrange(9))]
            kind_of.append(w)
            rows.append((len(rows), " ".join([*filler(), *w, *filler()])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(items[x])) for k, x in enumerate("ab")], "item_id long, text string")
    score = {(tuple(w), x): align_want(items[x], w) for w, _ in kinds for x in "ab"}
    want = {(i, k): s for i, w in enumerate(kind_of) for k, x in enumerate("ab") if (s := score[tuple(w), x]) >= 20}
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.op9_decontamination(docs, bench).collect()}
    assert got == want
    assert {r.doc_id for r in decontamination.decontaminate(docs, bench).collect()} == {i for i, _ in rows} - {i for i, _ in want}


def everywhere(rows, items, share=0.4, most=32):
    """Every item against every text, whole."""
    out = {}
    for i, t in rows:
        for k, item in items:
            need = max(min(share * len(item), most), min(len(item), 3))
            if len(set(t) & set(item)) and (s := align_want(item, t)) >= need:
                out[i, k] = s
    return out


def worn(rng, item):
    """An item with a third to a half of it changed, put in or left out."""
    rate, out = rng.uniform(0.15, 0.6), []
    for x in item:
        kind = rng.random()
        if kind < rate:
            out += rng.choice([["changed"], [], [x, "extra"], ["extra", "more", x]])
        else:
            out.append(x)
    return out


def test_worn_copies_are_all_found(spark, monkeypatch):
    """Also those without three words in a row as they were, beside common words and a phrase that many items and texts share."""
    rng = random.Random(12)
    phrase = [f"p{k}" for k in range(5)]
    items = [(k, phrase + [rng.choice([f"i{k}w{j}", f"common{rng.randrange(12)}"]) for j in range(n)]) for k, n in enumerate([3, 7, 12, 25, 30, 45, 90, 115] * 2)]
    every_second = [w for j, x in enumerate(items[4][1][:30]) for w in ([x, "in"] if j % 2 else [x])]
    every_third = ["out" if j % 3 == 2 else x for j, x in enumerate(items[7][1])]
    texts_ = [every_second, every_third, *(worn(rng, rng.choice(items)[1]) for _ in range(150)), *(phrase[: rng.randrange(6)] for _ in range(60))]
    pad = lambda: [rng.choice([f"z{rng.randrange(99)}", f"common{rng.randrange(12)}"]) for _ in range(rng.randrange(25))]
    rows = [(i, [*pad(), *t, *pad()]) for i, t in enumerate(texts_)]
    want = everywhere(rows, items)
    assert (0, 4) in want and (1, 7) in want and len(want) > 100
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in items], "item_id long, text string")
    clean = {i for i, _ in rows} - {i for i, _ in want}
    for words in (decontamination.BLOCK_WORDS, 200):  # one block, and several
        monkeypatch.setattr(decontamination, "BLOCK_WORDS", words)
        assert {(r.doc_id, r.item_id): r.score for r in decontamination.contaminated(docs, bench).collect()} == want
        left = decontamination.decontaminate(docs.unionByName(docs.limit(3)), bench)
        assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == clean


def test_seeds_leave_out_what_is_common():
    item = [b"a b c d e f g h i j"]
    items = decontamination.Items([(1, item[0])], 0.4, 32)
    assert items.need[0] == 4 and len(items.distinct) == 9
    counts = np.zeros(9)
    counts[np.searchsorted(items.distinct, items.key[:3])] = [5, 9, 7]
    items.keep_rare(counts)
    assert len(items.distinct) == 7 and set(items.key[[1, 2]]).isdisjoint(items.distinct)


def test_bound_is_never_below_the_alignment():
    rng = random.Random(10)
    pairs = [[[rng.randrange(9) for _ in range(rng.randrange(1, 30))] for _ in range(2)] for _ in range(300)]
    hit = np.concatenate([np.isin(b, a) for a, b in pairs])
    start = np.cumsum([0, *(len(b) for _, b in pairs[:-1])])
    for (a, b), bound in zip(pairs, decontamination.best_runs(hit, start), strict=True):
        runs = [0] + [sum(1 if x in a else -1 for x in b[i:j]) for i in range(len(b)) for j in range(i + 1, len(b) + 1)]
        assert max(bound, 0) == max(runs) >= align_want(a, b)


def test_hot_item_is_found_everywhere(spark):
    rng = random.Random(8)
    item = [f"q{k}" for k in range(30)]
    rows = [(i, " ".join([*(f"z{rng.randrange(999)}" for _ in range(20)), *(item if i % 3 else [])])) for i in range(600)]
    got = decontamination.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert {r.doc_id for r in got.collect()} == {i for i, _ in rows if i % 3}
