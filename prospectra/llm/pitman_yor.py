"""Language-model scoring by a hierarchical Pitman-Yor process over words.

Every word is a customer who dines in the restaurant of its context and orders a
dish, the word. Context restaurants share one parent, the root, whose base is
uniform over the known words and one unknown. A context is the word before: each
frequent word (a share of 1 / HEAD of the training tokens or more by an exact count,
so at most HEAD words) has a restaurant of its own, all others share CLASSES by their
hash, and a text's beginning has its own. So the restaurants' totals have a fixed size
and go to every task, while dishes grow with the corpus.

Seating is sampled by Gibbs sweeps. Dishes hold the sizes of their tables. In a sweep
every dish takes out MOVES customers, one after the other and drawn evenly, and seats
each again given all others of the dish: at a new table with weight (strength +
discount * tables) * parent probability, or at one of the dish's tables with weight
size - discount. A new table is a customer of the parent, one that is empty leaves it;
the root's words are swept likewise. Restaurants are swept in parallel: the parent's
probabilities and the tables of a restaurant's other dishes are those of the last sweep.
First seats are drawn as customers arrive. After BURN sweeps, the predictive
probabilities of SAMPLES states are averaged; they add up to 1 in every context.
Discounts come from the numbers of dishes seen once and twice. Random numbers are
hashes of word, context and sweep, so that scores don't depend on partitions.

Training pairs (word, context) and the pairs of every text are dealt by word; a
frequent word's are dealt by word and context, as its root totals go with the
tasks. What is dealt is packed: one compressed value for each unit of texts and
bucket. A second exchange adds up the buckets' shares of each text.

Defined cases: a null text is empty and has the end token alone; without training
texts all words are unknown; rows without a doc_id are left out, repeated ones are
scored each as one text; a very long text is one unit with others or alone; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, add_up, binary_text, even_keys, in_parts, materialize, mix, pack, partitions, release, slices, unpack

HEAD, CLASSES = 1 << 16, 1 << 16
BURN, SAMPLES, MOVES = 2, 3, 4
STRENGTH, ROOT_STRENGTH = 2.0, 10.0
END = np.uint64(0x5BD1E9955BD1E995)
#: Tokens of a unit: what is packed together.
UNIT = 600_000
#: Customers that first sit down one by one; after that, from one new table to the next.
ONE_BY_ONE = 24
#: Root customers by which a word may grow or shrink in a sweep one by one; beyond, it is seated as at first.
FEW = 16


@dataclass
class Totals:
    """What all tasks know of the model; every array has a fixed bound."""

    tokens: int
    types: int
    head: np.ndarray  # sorted hashes of frequent words
    head_count: np.ndarray
    customers: np.ndarray  # by context
    discount: float = 0.8
    root_discount: float = 0.8
    tables: list[np.ndarray] = field(default_factory=list)  # by context, of each sample
    head_root: list[np.ndarray] = field(default_factory=list)  # root probability of frequent words
    root: list[tuple[float, float]] = field(default_factory=list)  # root customers and tables
    head_seats: Seating | None = None

    def root_weight(self) -> float:
        return ROOT_STRENGTH + self.root_discount * (self.root[-1][1] if self.root else self.types)

    def root_chance(self, customers: np.ndarray, tables: np.ndarray, sample: int) -> np.ndarray:
        all_customers, all_tables = self.root[sample]
        base = (ROOT_STRENGTH + self.root_discount * all_tables) / (self.types + 1)
        return (np.maximum(customers - self.root_discount * tables, 0) + base) / (ROOT_STRENGTH + all_customers)


def tokens_of(words: Words, head: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hash, context and row of every token of the rows, ends included."""
    n, d = len(words.hash), words.doc
    total = n + words.n
    at = np.arange(n) + d
    word, row, context = np.full(total, END), np.zeros(total, np.int64), np.zeros(total, np.uint32)
    word[at], row[at] = words.hash, d
    ends = np.cumsum(np.bincount(d, minlength=words.n)) + np.arange(words.n)
    row[ends] = np.arange(words.n)
    own = np.minimum(np.searchsorted(head, words.hash), len(head) - 1)
    kind = np.where(head[own] == words.hash, own, len(head) + 1 + (words.hash >> np.uint64(20)).astype(np.int64) % CLASSES).astype(np.uint32)
    context[at + 1] = kind
    context[np.concatenate([[0], ends[:-1] + 1])[: words.n]] = len(head)  # a text begins
    return word, context, row


def bucket_of(word: np.ndarray, context: np.ndarray, head: np.ndarray, n: int) -> np.ndarray:
    own = np.minimum(np.searchsorted(head, word), len(head) - 1)
    frequent = head[own] == word
    return (mix(np.where(frequent, word + context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), word)) % np.uint64(n)).astype(np.int64)


def merged(word: np.ndarray, context: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (word, context), sorted, with summed counts."""
    order = np.lexsort((context, word))
    word, context, count = word[order], context[order], count[order]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (context[1:] != context[:-1])
    first = np.flatnonzero(new)
    return word[first], context[first], np.add.reduceat(count, first) if len(first) else count[:0]


def runs(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted words as their distinct values and how often each stands."""
    new = np.ones(len(word), bool)
    new[1:] = word[1:] != word[:-1]
    first = np.flatnonzero(new)
    return word[first], np.diff(np.append(first, len(word))).astype(np.uint32)


def gaps(word: np.ndarray) -> np.ndarray:
    return np.diff(word, prepend=np.uint64(0))


def keyed(word: np.ndarray, context: np.ndarray | int) -> np.ndarray:
    return mix(word + (np.atleast_1d(context).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def uniform(key: np.ndarray, draw: int) -> np.ndarray:
    """Numbers between 0 and 1 that the key and the draw fix."""
    x = mix(key ^ np.uint64(draw * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Seating:
    """Tables of many dishes: `count` of each dish, and their sizes, those of the first dish first."""

    def __init__(self, count: np.ndarray, size: np.ndarray):
        self.count, self.size = count.astype(np.int64), size.astype(np.int64)

    @staticmethod
    def first(customers: np.ndarray, new: np.ndarray, discount: float, key: np.ndarray) -> Seating:
        """Customers as they arrive; `new`: weight of a new table. An earlier table has more of those who don't open one."""
        n = len(customers)
        dish, when = [np.arange(n)], [np.ones(n)]
        live, sat, tables, draw = np.flatnonzero(customers > 1), 1, np.ones(n), 1
        while len(live) and sat < ONE_BY_ONE:
            old = np.maximum(sat - discount * tables[live], 1e-9)
            opens = live[uniform(key[live], draw) * (new[live] + old) < new[live]]
            tables[opens] += 1
            dish.append(opens)
            when.append(np.full(len(opens), sat + 1.0))
            sat, draw = sat + 1, draw + 1
            live = live[customers[live] > sat]
        at = np.full(len(live), float(sat))
        while len(live):
            # No table opens from s to s' with a chance of about ((s - d t) / (s' - d t)) ** new.
            rest = np.maximum(at - discount * tables[live], 1e-9)
            with np.errstate(over="ignore"):
                at = at + np.maximum(rest * (uniform(key[live], draw) ** (-1 / np.maximum(new[live], 1e-12)) - 1), 1)
            within = at <= customers[live]
            live, at, draw = live[within], at[within], draw + 1
            tables[live] += 1
            dish.append(live)
            when.append(at)
        dish, when = np.concatenate(dish), np.concatenate(when)
        order = np.argsort(dish, kind="stable")
        dish, share = dish[order], 1 / when[order]
        count = np.bincount(dish, minlength=n)
        start = np.cumsum(count) - count
        spare = customers - count
        size = 1 + np.floor(spare[dish] * share / np.bincount(dish, share, n)[dish]).astype(np.int64)
        if n:
            size[start] += customers - np.bincount(dish, size, n).astype(np.int64)
        return Seating(count, size)

    def customers(self) -> np.ndarray:
        total, ends = np.append(0, np.cumsum(self.size)), np.cumsum(self.count)
        return total[ends] - total[ends - self.count]

    def leave(self, dish: np.ndarray, draw: np.ndarray) -> None:
        """One customer of each of these dishes, drawn evenly, goes."""
        total, start = np.append(0, np.cumsum(self.size)), (np.cumsum(self.count) - self.count)[dish]
        n = total[start + self.count[dish]] - total[start]
        k = np.searchsorted(total, total[start] + np.minimum((draw * n).astype(np.int64), n - 1), "right") - 1
        self.size[k] -= 1
        empty = self.size[k] == 0
        self.count[dish[empty]] -= 1
        self.size = np.delete(self.size, k[empty])

    def sit(self, dish: np.ndarray, new: np.ndarray, discount: float, draw: np.ndarray) -> None:
        """One customer more of each of these dishes sits down; `new`: weight of a new table."""
        total = np.append(0.0, np.cumsum(self.size - discount))
        start, count = (np.cumsum(self.count) - self.count)[dish], self.count[dish]
        x = draw * (new + total[start + count] - total[start])
        opens = (x < new) | (count == 0)
        k = np.searchsorted(total, total[start] + x - new, "right") - 1
        self.size[np.clip(k, start, start + count - 1)[~opens]] += 1
        self.size = np.insert(self.size, (start + count)[opens], 1)
        self.count[dish[opens]] += 1

    def sweep(self, weight: np.ndarray, parent: np.ndarray, discount: float, key: np.ndarray, turn: int) -> None:
        """MOVES customers of each dish are taken out and seated again. weight: strength plus discount times the restaurant's tables."""
        every, before = np.arange(len(self.count)), self.count.copy()
        for k in range(MOVES):
            draw = 1000 * (turn + 1) + 2 * k
            self.leave(every, uniform(key, draw))
            self.sit(every, (weight + discount * (self.count - before)) * parent, discount, uniform(key, draw + 1))

    def adapt(self, customers: np.ndarray, new: np.ndarray, discount: float, key: np.ndarray, turn: int) -> Seating:
        """With these numbers of customers: a few come or go one by one; dishes with many more or less are seated as at first."""
        gap = customers - self.customers()
        for k in range(FEW):
            draw = 1000 * (turn + 1) + 500 + k
            go, come = np.flatnonzero((gap < -k) & (gap >= -FEW)), np.flatnonzero((gap > k) & (gap <= FEW))
            self.leave(go, uniform(key[go], draw))
            self.sit(come, new[come], discount, uniform(key[come], draw))
        far = np.abs(gap) > FEW
        if not far.any():
            return self
        fresh = Seating.first(customers[far], new[far], discount, key[far] ^ np.uint64(turn + 1))
        count = self.count.copy()
        count[far] = fresh.count
        size, of = np.zeros(count.sum(), np.int64), np.repeat(far, count)
        size[of], size[~of] = fresh.size, self.size[np.repeat(~far, self.count)]
        return Seating(count, size)


def frequent_words(texts: DataFrame) -> tuple[np.ndarray, int, int]:
    """Hashes of words with a share of 1 / HEAD or more, the number of tokens, and that of distinct ones; counts are exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, ends = [], 0, 0

        def fold() -> pa.RecordBatch:
            nonlocal held, size
            word, count = np.unique(np.concatenate(held), return_counts=True)
            held, size = [], 0
            return pa.record_batch([pa.array(word.view(np.int64)), pa.array(count)], names=["word", "n"])

        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                words = Words(batch.column(1).slice(lo, hi - lo))
                held.append(words.hash)
                size, ends = size + len(words.hash), ends + words.n
                if size >= 8 * UNIT:
                    yield fold()
        if held:
            yield fold()
        yield pa.record_batch([pa.array([END.view(np.int64)]), pa.array([ends])], names=["word", "n"])

    found = materialize(texts.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    total, types = found.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    rows = found.where(F.col("n") >= total / HEAD).collect()  # at most HEAD
    release(found)
    return np.unique(np.array([END.view(np.int64), *(r.word for r in rows)], np.int64).view(np.uint64)), total, types


def dealt(texts: DataFrame, head: np.ndarray, keys: list[int], by_text: bool) -> DataFrame:
    """bucket, unit, blob: the pairs of texts (doc_id, text), packed; with `by_text` those of each text apart."""
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, unit, held, size, base = TaskContext.get().partitionId(), 0, [], 0, 0
        docs: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal unit, held, size, base, docs
            word, context, row = (np.concatenate([h[k] for h in held]) for k in range(3))
            if by_text:
                # Distinct (word, context, row): rows of one unit fit in 32 bits.
                order = np.lexsort((row, context, word))
                word, context, row = word[order], context[order], row[order]
                new = np.ones(len(word), bool)
                new[1:] = (word[1:] != word[:-1]) | (context[1:] != context[:-1]) | (row[1:] != row[:-1])
                first = np.flatnonzero(new)
                count = np.diff(np.append(first, len(word)))
                word, context, row = word[first], context[first], row[first]
            else:
                word, context, count = merged(word, context, np.ones(len(word), np.uint32))
            bucket = bucket_of(word, context, head, n)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(n + 1))
            rows, ids = [], np.concatenate(docs)
            held, docs = [], []
            for b in np.flatnonzero(ends[1:] > ends[:-1]):
                x = order[ends[b] : ends[b + 1]]
                values, length = runs(word[x])
                blob = [gaps(values), length, context[x], count[x].astype(np.uint32)]
                if by_text:
                    present, at = np.unique(row[x], return_inverse=True)
                    blob += [at.astype(np.uint32), ids[present], present.astype(np.uint32)]
                rows.append((keys[b], pack(*blob)))
            number = part << 32 | unit
            unit, held, size, base, docs = unit + 1, [], 0, 0, []
            return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([number] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "unit", "blob"])

        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                word, context, row = tokens_of(Words(batch.column(1).slice(lo, hi - lo)), head)
                held.append((word, context, (row + base).astype(np.int32)))
                docs.append(batch.column(0).slice(lo, hi - lo).to_numpy())
                base, size = base + hi - lo, size + len(word)
                if size >= UNIT:
                    yield flush()
        if held:
            yield flush()

    return texts.mapInArrow(run, "bucket int, unit long, blob binary")


def pairs_of(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [unpack(b) for b in blobs]
    word = [np.repeat(np.cumsum(p[0], dtype=np.uint64), p[1]) for p in parts]
    return merged(np.concatenate(word), np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts]).astype(np.int64))


STATE = "bucket int, blob binary, context binary, head binary, tail array<double>"


@dataclass
class Bucket:
    """Dishes of one bucket: distinct (word, context), their customers, and how these sit."""

    word: np.ndarray  # distinct words, sorted
    length: np.ndarray  # dishes of each word
    context: np.ndarray  # of each dish
    count: np.ndarray
    own: Seating | None = None  # dishes of two customers or more; the others sit at one table each
    root: Seating | None = None  # words that are not frequent, as root customers
    kept: list[np.ndarray] = field(default_factory=list)  # of each sample: tables of dishes, root tables of words

    def __post_init__(self) -> None:
        self.at = np.repeat(np.arange(len(self.word)), self.length)
        self.several = np.flatnonzero(self.count > 1)

    def blob(self) -> bytes:
        small = (self.own.count, self.own.size, self.root.count, self.root.size)
        return pack(gaps(self.word), self.length, self.context, self.count.astype(np.uint32), *(x.astype(np.uint32) for x in small), *self.kept)

    @staticmethod
    def read(blob: bytes | None, samples: int = 0) -> Bucket:
        empty = np.zeros(0, np.uint32)
        gap, length, context, count, c, s, rc, rs, *kept = unpack(blob) if blob else [np.zeros(0, np.uint64), *[empty] * (7 + 2 * samples)]
        return Bucket(np.cumsum(gap, dtype=np.uint64), length, context, count.astype(np.int64), Seating(c, s), Seating(rc, rs), kept)

    def tables(self) -> np.ndarray:
        out = np.ones(len(self.count), np.int64)
        out[self.several] = self.own.count
        return out

    def frequent(self, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(head, self.word), len(head) - 1)
        return place, head[place] == self.word


def seated(b: Bucket, totals: Totals, turn: int) -> None:
    """One sweep of a bucket's dishes and of its words in the root; the first one seats them."""
    place, frequent = b.frequent(totals.head)
    several, key = b.several, keyed(b.word[b.at[b.several]], b.context[b.several])
    last = b.tables() if b.own else None
    if turn < 0:  # as nothing is known yet: the parent's probabilities are even, and a restaurant has a table a dish
        parent, weight = 1 / (totals.types + 1), np.full(len(several), STRENGTH)
        b.own = Seating.first(b.count[several], weight * parent, totals.discount, key)
    else:
        rare = np.zeros(len(b.word), np.int64)
        rare[~frequent] = b.root.count
        chance = totals.root_chance(np.bincount(b.at, last, len(b.word)), rare, -1)
        chance = np.where(frequent, totals.head_root[-1][place], chance)
        weight = STRENGTH + totals.discount * totals.tables[-1][b.context[several]]
        b.own.sweep(weight, chance[b.at[several]], totals.discount, key, turn)
    customers = np.bincount(b.at, b.tables(), len(b.word)).astype(np.int64)[~frequent]
    root_key = keyed(b.word[~frequent], 1 << 40)
    weight, base = np.full(len(customers), totals.root_weight()), np.full(len(customers), 1 / (totals.types + 1))
    if turn < 0:
        b.root = Seating.first(customers, weight * base, totals.root_discount, root_key)
    else:
        b.root = b.root.adapt(customers, weight * base, totals.root_discount, root_key, turn)
        b.root.sweep(weight, base, totals.root_discount, root_key, turn)


def state_row(bucket: int, b: Bucket, head: np.ndarray, contexts: int, keep: bool) -> pa.RecordBatch:
    """A bucket's state, and its shares of the totals: tables and customers by context, root customers and count by frequent word, root customers and tables of the others."""
    place, frequent = b.frequent(head)
    tables = b.tables()
    root, seen = np.bincount(b.at, tables, len(b.word)), np.bincount(b.at, b.count, len(b.word))
    of_head = np.stack([np.bincount(place[frequent], x[frequent], len(head)) for x in (root, seen)])
    rest, seats = root[~frequent], np.zeros(len(b.word), np.int64)
    seats[~frequent] = b.root.count
    by_context = np.stack([np.bincount(b.context, x, contexts) for x in (tables, b.count)]).astype(np.int64)
    tail = [float(x) for x in (len(rest), rest.sum(), b.root.count.sum(), (rest == 1).sum(), (rest == 2).sum(), (b.count == 1).sum(), (b.count == 2).sum())]
    if keep:
        b.kept += [tables.astype(np.uint32), seats.astype(np.uint32)]
    return pa.record_batch([pa.array([bucket], pa.int32()), pa.array([b.blob()], pa.binary()), pa.array([pack(*by_context)], pa.binary()), pa.array([pack(*of_head.astype(np.int64))], pa.binary()), pa.array([tail], pa.list_(pa.float64()))], names=["bucket", "blob", "context", "head", "tail"])


def summed(state: DataFrame, contexts: int, heads: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adds up the buckets' shares; the driver gets arrays of a fixed size once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {"context": np.zeros((2, contexts), np.int64), "head": np.zeros((2, heads), np.int64), "tail": np.zeros((1, 7))}
        for batch in batches:
            for c, h, t in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                total["context"] += np.stack(unpack(c))
                total["head"] += np.stack(unpack(h))
                total["tail"] += t
        yield in_parts(np.concatenate([x.ravel() for x in total.values()]).astype(np.float64))

    flat = add_up(state.select("context", "head", "tail").mapInArrow(run, "part int, blob binary"), 2 * contexts + 2 * heads + 7)
    return flat[: 2 * contexts].reshape(2, -1), flat[2 * contexts : 2 * (contexts + heads)].reshape(2, -1), flat[2 * (contexts + heads) :]


def learned(totals: Totals, by_context: np.ndarray, by_head: np.ndarray, tail: np.ndarray, turn: int) -> None:
    """Takes a sweep's sums into the totals; frequent words are seated in the root here, as there are few."""
    share = lambda once, twice: float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.95))
    root = by_head[0].astype(np.int64)
    seen = root > 0
    totals.discount, totals.root_discount = share(tail[5], tail[6]), share(tail[3], tail[4])
    base, key = np.full(seen.sum(), 1 / (totals.types + 1)), keyed(totals.head[seen], 1 << 40)
    weight = np.full(seen.sum(), totals.root_weight())
    if totals.head_seats is None:
        totals.head_seats = Seating.first(root[seen], weight * base, totals.root_discount, key)
    else:
        totals.head_seats = totals.head_seats.adapt(root[seen], weight * base, totals.root_discount, key, turn)
        totals.head_seats.sweep(weight, base, totals.root_discount, key, turn)
    tables = np.zeros(len(root), np.int64)
    tables[seen] = totals.head_seats.count
    totals.root.append((float(tail[1] + root.sum()), float(tail[2] + tables.sum())))
    totals.tables.append(by_context[0])
    totals.head_root.append(totals.root_chance(root, tables, -1))


class Model:
    """The trained model: totals, and one row of dishes a bucket in the shared folder."""

    def __init__(self, totals: Totals, state: DataFrame, keys: list[int]):
        self.totals, self.state, self.keys = totals, state, keys

    def scores(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_tokens, n_known, base_score, score of docs (doc_id, text), rows apart."""
        totals, n = self.totals, len(self.keys)
        rows = dealt(rows_of(docs), totals.head, self.keys, by_text=True)
        both = self.state.select("bucket", F.lit(-1).cast("long").alias("unit"), "blob").unionByName(rows)
        met = both.repartition(n, "bucket").sortWithinPartitions("bucket", "unit")
        sent = docs.sparkSession.sparkContext.broadcast(totals)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals, dishes, of = sent.value, None, None
            for batch in batches:
                for b, unit, blob in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                    if unit < 0:
                        dishes, of = Dishes(blob, totals), b
                        continue
                    known = dishes if of == b else Dishes(None, totals)
                    gap, length, context, count, at, ids, present = unpack(blob)
                    word = np.repeat(np.cumsum(gap, dtype=np.uint64), length)
                    chance, seen = known.chance(word, context)
                    base = np.log10((seen + 0.1) / (totals.tokens + 0.1 * (totals.types + 1)))
                    add = lambda x, a=at, p=ids: np.bincount(a, x, len(p))
                    out = pack(present, ids, add(count).astype(np.uint32), add(count * (seen > 0)).astype(np.uint32), add(count * base), add(count * np.log10(chance)))
                    yield pa.record_batch([pa.array([unit], pa.int64()), pa.array([out], pa.binary())], names=["unit", "blob"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            unit, held = None, []
            for batch in batches:
                for u, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if u != unit and held:
                        yield total(held)
                        held = []
                    unit = u
                    held.append(unpack(blob))
            if held:
                yield total(held)

        def total(held: list[list[np.ndarray]]) -> pa.RecordBatch:
            size = 1 + max(int(h[0].max()) for h in held)
            ids, sums = np.zeros(size, np.int64), np.zeros((4, size))
            for present, doc, *x in held:
                ids[present] = doc
                for k in range(4):
                    sums[k, present] += x[k]
            return pa.record_batch([pa.array(ids), pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)), pa.array(sums[2]), pa.array(sums[3])], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

        shares = met.mapInArrow(run, "unit long, blob binary").repartition("unit").sortWithinPartitions("unit", F.xxhash64("blob"))
        return shares.mapInArrow(add, "doc_id long, n_tokens long, n_known long, base_score double, score double")


class Dishes:
    """A bucket's dishes, for lookups."""

    def __init__(self, blob: bytes | None, totals: Totals):
        self.totals, b = totals, Bucket.read(blob, len(totals.tables))
        self.samples, seats = b.kept[::2], b.kept[1::2]
        self.word, self.key, self.context_count = b.word, b.at << 18 | b.context.astype(np.int64), b.count
        self.seen = np.bincount(b.at, b.count, len(b.word))
        self.root = [totals.root_chance(np.bincount(b.at, x, len(b.word)), y, s) for s, (x, y) in enumerate(zip(self.samples, seats, strict=True))]

    def chance(self, word: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Averaged predictive probability of word in context, and the word's training count."""
        t = self.totals
        k = np.searchsorted(self.word, word)
        k[k == len(self.word)] = 0
        known = self.word[k] == word if len(self.word) else np.zeros(len(word), bool)
        own = np.minimum(np.searchsorted(t.head, word), len(t.head) - 1)
        frequent = t.head[own] == word
        seen = np.where(frequent, t.head_count[own], 0).astype(np.float64)
        if len(self.word):
            seen = np.where(known & ~frequent, self.seen[k], seen)
        pair = k.astype(np.int64) << 18 | context.astype(np.int64)
        p = np.searchsorted(self.key, pair)
        p[p == len(self.key)] = 0
        dined = known & (self.key[p] == pair) if len(self.key) else known
        total = np.zeros(len(word))
        size = STRENGTH + t.customers[context]
        n = len(t.tables)
        for s in range(n):
            new = t.root_chance(np.zeros(1), np.zeros(1), s)[0]
            root = np.where(frequent, t.head_root[s][own], new)
            if len(self.word):
                root = np.where(known & ~frequent, self.root[s][k], root)
            own_share = np.where(dined, np.maximum(self.context_count[p] - t.discount * self.samples[s][p], 0), 0) if len(self.key) else 0
            total += (own_share + (STRENGTH + t.discount * t.tables[s][context]) * root) / size
        return total / n, seen


def rows_of(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), binary_text())


def train(docs: DataFrame, burn: int = BURN, samples: int = SAMPLES) -> Model:
    """Samples a model from all of docs (doc_id, text)."""
    spark, texts = docs.sparkSession, rows_of(docs)
    keys = even_keys(spark, partitions(spark))
    head, tokens, types = frequent_words(texts)
    contexts = len(head) + 1 + CLASSES
    packed = dealt(texts, head, keys, by_text=False).repartition(len(keys), "bucket").sortWithinPartitions("bucket")
    first = Totals(tokens, types, head, np.zeros(len(head)), np.zeros(contexts))

    def first_row(bucket: int, held: list[bytes]) -> pa.RecordBatch:
        word, context, count = pairs_of(held)
        b = Bucket(*runs(word), context, count)
        seated(b, first, -1)
        return state_row(bucket, b, head, contexts, False)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for b, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if b != bucket and held:
                    yield first_row(bucket, held)
                    held = []
                bucket = b
                held.append(blob)
        if held:
            yield first_row(bucket, held)

    state = materialize(packed.mapInArrow(gather, STATE), "seats")
    by_context, by_head, tail = summed(state, contexts, len(head))
    totals = Totals(tokens, types, head, by_head[1], by_context[1])
    learned(totals, by_context, by_head, tail, -1)
    for turn in range(burn + samples):
        sent = spark.sparkContext.broadcast(totals)

        def sweep(batches: Iterator[pa.RecordBatch], sent=sent, turn=turn) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    b = Bucket.read(blob)
                    seated(b, sent.value, turn)
                    yield state_row(bucket, b, head, contexts, turn >= burn)

        following = materialize(state.select("bucket", "blob").mapInArrow(sweep, STATE), "seats")
        release(state)
        state = following
        sums = summed(state, contexts, len(head))
        sent.destroy()
        learned(totals, *sums, turn)
    for states in (totals.tables, totals.head_root, totals.root):
        del states[:-samples]
    return Model(totals, state, keys)


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0


def op3_lm_scoring(docs: DataFrame) -> DataFrame:
    model = train(docs.where(~held_out()))
    rows = model.scores(docs)
    return rows.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.totals.tokens).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
