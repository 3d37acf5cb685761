"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Words are compared without case and without punctuation at their ends. A scan joins documents with items by
seeds; each seed fixes a diagonal, and the words around it are aligned with the item (match 1, mismatch and gap -1).
A pair is reported if the score reaches `share` of the item's words or `words`, but three at least, or all of a shorter item.

Seeds lose nothing over that threshold. An alignment of score T has M matches and at most M - T errors, which cut the
matches into at most M - T + 1 runs, so at least T - 1 of the item's pairs of neighbouring words stand in the passage as they
are. So of an item's pairs, the T - 2 that are most frequent in the documents may be left out (exact counts, added up over
all documents first): one of the rest, the rarest, is in every such passage. The errors also bound how far the passage reaches
to both sides of the seed. Before aligning, two bounds decide: no run of words of a passage, or of an item, scores
more than its words that the other has less those that the other lacks.

Test items are read in blocks of BLOCK_WORDS words; one block at a time goes to every task, is counted, scanned with and
freed. Documents are not shuffled, a document is a task's unit, and copies of an item in many documents cost each of them
alone. `decontaminate` filters the documents in the scan itself if there is one block; with more, what each finds is
kept by doc_id and hashes of the text, and the documents lose it by an anti join.

Defined cases: null and empty texts and items match nothing; repeated items are reported each;
an empty table gives no rows; rows without doc_id or item_id are left out, and stay in
`decontaminate`; rows that repeat a doc_id are one document in `contaminated`, which has its
best passage, and each its own in `decontaminate`; a very long text is compared as a whole;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, add_up, binary_text, in_parts, marks, materialize, mix, slices

WIDTH = 2
BLOCK_WORDS = 400_000
SHARE, WORDS = 0.4, 32
#: Seeds found, or words of passages, in one numpy pass.
PASS = 1 << 19
#: Places of the screen for each word of the items, and its size at most, as powers of two.
SCREEN_ROOM, SCREEN_BITS = 6, 24


def bare(text: str) -> Column:
    """Punctuation SQL-side: everything but letters, marks, digits and blanks becomes a blank."""
    return F.regexp_replace(F.col(text), r"[^\p{L}\p{M}\p{N}\s]+", " ")


def grams(h: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the runs of `width` words within a document."""
    n = max(0, len(h) - width + 1)
    acc = np.full(n, width, np.uint64)
    for j in range(width):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + h[j : j + n]
    at = np.flatnonzero(doc[:n] == doc[width - 1 : width - 1 + n]) if n else np.zeros(0, np.int64)
    return at, mix(acc[at])


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of word hashes a and b: score, and the range of b that it ends in and begins at."""
    n = len(b)
    row, origin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best, span, slope = 0, (0, 0), np.arange(n + 1)
    for x in a:
        diagonal = row[:-1] + np.where(b == x, 1, -1)
        fresh, begin = np.zeros(n + 1, np.int64), slope.copy()
        take = diagonal > fresh[1:]
        fresh[1:][take], begin[1:][take] = diagonal[take], origin[:-1][take]
        take = row - 1 > fresh
        fresh[take], begin[take] = row[take] - 1, origin[take]
        # A gap in a: the best value to the left less its distance.
        lifted = fresh + slope
        top = np.maximum.accumulate(lifted)
        lead = np.maximum.accumulate(np.where(lifted == top, slope, 0))
        take = top - slope > fresh
        fresh[take], begin[take] = (top - slope)[take], begin[lead][take]
        row, origin = fresh, begin
        k = int(row.argmax())
        if row[k] > best:
            best, span = int(row[k]), (int(origin[k]), k)
    return best, *span


class Items:
    """Test items as word hashes, with their pairs of neighbouring words (an item of one word has that word)."""

    def __init__(self, rows: list[tuple[int, bytes]], share: float, most: int):
        words = Words(pa.array([t for _, t in rows], pa.binary()))
        self.ids = [i for i, _ in rows]
        ends = np.searchsorted(words.doc, np.arange(len(rows) + 1))
        self.words = [words.hash[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        item, place, key, width = [], [], [], []
        for k, w in enumerate(self.words):
            if len(w):
                size = min(WIDTH, len(w))
                at, h = grams(w, np.zeros(len(w), np.int64), size)
                item += [k] * len(at)
                place += at.tolist()
                key += h.tolist()
                width += [size] * len(at)
        self.item, self.place, self.width = np.array(item, np.int64), np.array(place, np.int64), np.array(width, np.int64)
        self.key = np.array(key, np.uint64)
        self.size = np.array([len(w) for w in self.words], np.int64)
        #: The score that each item's passages must reach.
        self.need = np.maximum(np.ceil(np.minimum(share * self.size, most) - 1e-9).astype(np.int64), np.minimum(self.size, 3))
        self.bits = min(len(words.hash).bit_length() + SCREEN_ROOM, SCREEN_BITS)
        self.screen = np.zeros(1 << self.bits, bool)
        self.screen[belongs(words.doc, words.hash, self.bits)] = True
        self.seeds(np.ones(len(self.key), bool))

    def seeds(self, taken: np.ndarray) -> None:
        self.order = np.flatnonzero(taken)[np.argsort(self.key[taken], kind="stable")]
        self.keys = self.key[self.order]
        self.distinct, self.widths = np.unique(self.keys), np.unique(self.width[taken])

    def keep_rare(self, counts: np.ndarray) -> None:
        """Leaves out, of each item, the need - 2 pairs of the largest counts; counts are those of the distinct keys."""
        count = counts[np.searchsorted(np.unique(self.key), self.key)]
        order = np.lexsort((self.place, -count, self.item))
        rank = np.arange(len(order)) - np.searchsorted(self.item[order], self.item[order])
        taken = np.zeros(len(order), bool)
        taken[order] = rank >= np.maximum(self.need[self.item[order]] - 2, 0)
        self.seeds(taken)


def belongs(item: np.ndarray, word: np.ndarray, bits: int) -> np.ndarray:
    """Where the screen has whether an item holds a word; what shares a place by chance only loosens the bound."""
    return (mix(word + (item.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def found(words: Words, keys: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in words and their hashes among the sorted keys."""
    spots, hits = [], []
    screen = np.zeros(1 << 20, bool)
    screen[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    for width in widths:
        at, h = grams(words.hash, words.doc, int(width))
        near = screen[(h & np.uint64((1 << 20) - 1)).astype(np.int64)]
        at, h = at[near], h[near]
        k = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        ok = keys[k] == h
        spots.append(at[ok])
        hits.append(h[ok])
    return np.concatenate(spots), np.concatenate(hits)


def best_runs(hit: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The largest sum of a run in each segment of hit, where True counts 1 and False -1."""
    size = np.diff(np.append(start, len(hit)))
    total = np.cumsum(np.where(hit, 1, -1))
    # Each segment lies lower than all before it, so that a running minimum begins anew.
    drop = np.repeat(np.arange(len(start)) * (2 * int(size.max()) + 2) + np.append(0, total)[start], size)
    before = np.append(0, total[:-1]) - drop
    return np.maximum.reduceat(total - drop - np.minimum.accumulate(before), start)


def pieces(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges [from, to) of elements whose sizes add up to PASS or little more."""
    total = np.cumsum(size)
    cut = np.searchsorted(total, np.arange(PASS, (total[-1] if len(total) else 0) + PASS, PASS), "left") + 1
    ends = np.unique(np.minimum(cut, len(size)))
    yield from zip([0, *ends[:-1].tolist()], ends.tolist(), strict=False)


def matches(words: Words, items: Items) -> list[tuple[int, int, int, int, int]]:
    """row, item, score, first and last word (within the row) of each pair that reaches the threshold."""
    at, h = found(words, items.distinct, items.widths)
    if not len(at):
        return []
    by_row = np.argsort(words.doc[at], kind="stable")
    at, h = at[by_row], h[by_row]
    low, high = np.searchsorted(items.keys, h, "left"), np.searchsorted(items.keys, h, "right")
    begin = np.flatnonzero(np.append(True, words.doc[at[1:]] != words.doc[at[:-1]]))
    begin_of, out = np.searchsorted(words.doc, np.arange(words.n + 1)), []
    for a, b in pieces(np.add.reduceat(high - low, begin)):
        lo, hi = begin[a], begin[b] if b < len(begin) else len(at)
        out += aligned(words, items, begin_of, at[lo:hi], low[lo:hi], high[lo:hi])
    return out


def aligned(words: Words, items: Items, begin_of: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """What `matches` finds by the seeds low to high (in order of the keys) at the words `at`, all seeds of some rows."""
    reps = high - low
    spot = np.repeat(at, reps)
    which = items.order[np.repeat(low, reps) + np.arange(len(spot)) - np.repeat(np.cumsum(reps) - reps, reps)]
    item, row, base = items.item[which], words.doc[spot], spot - items.place[which]
    sort = np.lexsort((base, item, row))
    item, row, base = item[sort], row[sort], base[sort]
    # An alignment over the threshold has at most size - need errors, by which its ends may be off the diagonal.
    size, slack = items.size[item], (items.size - items.need)[item]
    # Seeds whose passages overlap are one passage.
    first = np.flatnonzero(np.append(True, (item[1:] != item[:-1]) | (row[1:] != row[:-1]) | (base[1:] - base[:-1] > (size + 2 * slack)[1:])))
    last = np.append(first[1:], len(item)) - 1
    item, row, size, slack = item[first], row[first], size[first], slack[first]
    lo, hi = np.maximum(base[first] - slack, begin_of[row]), np.minimum(base[last] + size + slack, begin_of[row + 1])
    need, out = items.need[item], []
    for a, b in pieces(hi - lo):
        length = (hi - lo)[a:b]
        start = np.cumsum(length) - length
        place = np.repeat(lo[a:b] - start, length) + np.arange(length.sum())
        shared = items.screen[belongs(np.repeat(item[a:b], length), words.hash[place], items.bits)]
        for k in a + np.flatnonzero(best_runs(shared, start) >= need[a:b]):
            own, part = items.words[item[k]], words.hash[lo[k] : hi[k]]
            if best_runs(np.isin(own, part), np.zeros(1, np.int64))[0] >= need[k]:
                score, x, y = align(own, part)
                if score >= need[k]:
                    out.append((int(row[k]), int(item[k]), score, int(lo[k] + x - begin_of[row[k]]), int(lo[k] + y - begin_of[row[k]])))
    return out


def prepared(docs: DataFrame, benchmark: DataFrame, share: float, words: int) -> Iterator[tuple[Items, int]]:
    """The test items in blocks, their seeds chosen by the counts of their word pairs in docs (doc_id, text, bared); and how many blocks there are."""
    tests = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), bare("text").alias("text")).select("item_id", binary_text())
    total = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (4 * BLOCK_WORDS)))
    for block in range(blocks):
        rows = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()  # bounded by BLOCK_WORDS
        items = Items([(r.item_id, bytes(r.text)) for r in rows], share, words)
        if len(items.key):
            items.keep_rare(counted(docs, items.distinct, items.widths))
            yield items, blocks


def counted(docs: DataFrame, keys: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """How often each of the sorted keys, of runs of some widths, occurs in docs (doc_id, text): a task's sums are added up in Spark."""
    sent = docs.sparkSession.sparkContext.broadcast((keys, widths))  # bounded by BLOCK_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, widths = sent.value
        total = np.zeros(len(keys))
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                _, h = found(Words(batch.column(1).slice(lo, hi - lo)), keys, widths)
                total += np.bincount(np.searchsorted(keys, h), minlength=len(keys))
        yield in_parts(total)

    out = add_up(docs.mapInArrow(run, "part int, blob binary"), len(keys))
    sent.destroy()
    return out


def bared(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), bare("text").alias("text")).select("doc_id", binary_text())


SCHEMA = "doc_id long, item_id long, score int, item_words int, from_word int, to_word int"


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, words: int = WORDS) -> DataFrame:
    """doc_id, item_id, score, item_words, from_word, to_word of each passage of docs that copies or edits an item."""
    results, own = [], bared(docs)
    for items, _ in prepared(own, benchmark, share, words):
        sent = docs.sparkSession.sparkContext.broadcast(items)  # one block, freed before the next

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for batch in batches:
                for lo, hi in slices(batch.column(1)):
                    part = matches(Words(batch.column(1).slice(lo, hi - lo)), items)
                    ids = batch.column(0)
                    columns = [[ids[lo + r].as_py() for r, *_ in part], [items.ids[i] for _, i, *_ in part], [s for _, _, s, *_ in part], [len(items.words[i]) for _, i, *_ in part], [a for *_, a, _ in part], [b for *_, b in part]]
                    yield pa.record_batch([pa.array(c, pa.int64() if k < 2 else pa.int32()) for k, c in enumerate(columns)], names=["doc_id", "item_id", "score", "item_words", "from_word", "to_word"])

        results.append(materialize(own.mapInArrow(run, SCHEMA), "passages"))
        sent.destroy()
    if not results:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    every = reduce(DataFrame.unionByName, results)
    # The best passage of a document and item; ties: the first.
    best = F.max(F.struct("score", (-F.col("from_word")).alias("x"), "item_words", "to_word")).alias("m")
    return every.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.score", "m.item_words", (-F.col("m.x")).alias("from_word"), "m.to_word")


def sifted(docs: DataFrame, sent: Broadcast, hit: bool) -> DataFrame:
    """The rows of docs (the last column of which is bared text) that hold a passage of the broadcast items, or those that don't; without that column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        for batch in batches:
            text, rest = batch.column(batch.num_columns - 1), batch.select(batch.schema.names[:-1])
            for lo, hi in slices(text):
                rows = {r for r, *_ in matches(Words(text.slice(lo, hi - lo)), items)}
                yield rest.slice(lo, hi - lo).filter(pa.array([(k in rows) == hit for k in range(hi - lo)], pa.bool_()))

    return docs.mapInArrow(run, docs.drop(docs.columns[-1]).schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, words: int = WORDS) -> DataFrame:
    """docs without those that hold a passage of the benchmark; all columns are kept."""
    # Rows without a doc_id stay whatever they hold.
    text = F.coalesce(F.when(F.col("doc_id").isNotNull(), bare("text")).cast("binary"), F.lit(b""))
    keys, gone = {"_doc_id_": F.col("doc_id").cast("long"), **{f"_{k}_": c for k, c in marks().items()}}, []
    for items, blocks in prepared(bared(docs), benchmark, share, words):
        sent = docs.sparkSession.sparkContext.broadcast(items)
        if blocks == 1:
            return sifted(docs.withColumn("_bare_text", text), sent, hit=False)  # one block: stays until the plan has run
        gone.append(materialize(sifted(docs.select(*[c.alias(k) for k, c in keys.items()], text.alias("_bare_text")), sent, hit=True), "passages"))
        sent.destroy()
    if not gone:
        return docs
    every = reduce(DataFrame.unionByName, gone).distinct()
    return docs.withColumns(keys).join(every, list(keys), "left_anti").select(*docs.columns)


def op9_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark)
