"""Alignment of two tokenizations of the same bytes.

A static interval index holds the byte ranges of a text's B tokens, in order: their starts and their ends.
Each A token is a stabbing query: bisection for its start among the ends and for its end among the starts gives
the first and the last B token that overlaps it, and so its links. A gap between A tokens that no B token spans is
a byte at which tokens of both end: these cut the tokens into groups.

A blank after a character that isn't white space is such a byte always: the split pattern of the byte-level
vocabulary starts a part there, and no piece of the other has a blank after another character (checked as the
model is loaded). So texts are cut there, each new chunk is encoded and aligned once, and chunks are kept in a
bounded memory of a worker. A text in which a chunk's bytes differ from its tokens' is aligned again as a whole.

Counts over the corpus: a task makes units of some megabytes of texts, each with its distinct id pairs, the number
of its documents that hold each, and its documents as lists of chunks. Spark adds the pairs up and finds each A
id's highest, joins the counts to the units' pairs, and gives each unit its own back, from which its documents
are summed. What moves is a unit's distinct pairs, never the links of a text; a hot document or pair is a
row of its unit like any other. The pairs of one A id are at most B's vocabulary.

Defined cases: a null or empty text, and one whose bytes can't be had back from its tokens (it has U+2581), has no
tokens: zeros and an empty digest; strings of special tokens are plain text; rows that repeat a doc_id, or have none,
are documents of their own; a very long text is a unit of its own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, pack, unpack
from .word_bpe import byte_symbols

#: Bytes of text in a unit, and in a slice of it whose new chunks are encoded together.
UNIT_BYTES, SLICE_BYTES = 8 << 20, 1 << 20
#: Chunks that a worker keeps from one unit to the next.
MEMORY = 200_000
BLANK = "▁"


class ByteVocabulary:
    """Ids and token bytes of a byte-level vocabulary file; strings of special tokens are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.model.no_truncation()
        self.model.no_padding()
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for name, i in vocab.items():
            if all(c in byte_of for c in name):
                self.bytes[i] = bytes(byte_of[c] for c in name)

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(chunks, add_special_tokens=False)]


class PieceVocabulary:
    """Ids and token bytes of a piece model that puts a blank before each text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces):
            raise ValueError("a piece of this model has a blank after another character, so texts can't be cut at blanks")
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return self.model.encode(chunks, num_threads=1)


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last B token that each A token overlaps, of tokens that cover the same bytes from 0 on.

    `b_ends`, and the starts that go with it, are the index; both have no empty token.
    """
    b_starts = np.append(0, b_ends[:-1])
    a_starts = np.append(0, a_ends[:-1])
    return np.searchsorted(b_ends, a_starts, "right"), np.searchsorted(b_starts, a_ends, "left") - 1


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... count[0] numbers, then those of first[1], and so on."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)


def ids_as_text(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal ids below size, each followed by `,`, then each by `|`, then each by `;`, and how long they are."""
    texts = np.array([f"{i}{mark}" for mark in ",|;" for i in range(size)], "S")
    return texts, np.char.str_len(texts)


def texts_of(texts: np.ndarray) -> np.ndarray:
    """Fixed-width texts run together as bytes."""
    return np.frombuffer(texts.tobytes().translate(None, b"\0"), np.uint8)


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all lists, and how many each has."""
    return np.array(list(chain.from_iterable(lists)), np.int64), np.array(list(map(len, lists)), np.int64)


class Aligner:
    """Chunks of texts, aligned: numbers of tokens, groups and links by chunk, links' pairs, and groups as text."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteVocabulary(a_path), PieceVocabulary(b_path)
        self.a_size, self.b_size = (np.array([len(x) for x in v.bytes]) for v in (self.a, self.b))
        self.texts, self.text_size = ids_as_text(max(len(self.a.bytes), len(self.b.bytes)))
        self.clear()

    def clear(self) -> None:
        #: The number of a chunk; -1 if its bytes differ from its tokens'.
        self.known: dict[str, int] = {}
        self.n = 0
        self.rows: list[tuple[np.ndarray, ...]] = []

    @staticmethod
    def cut(text: str) -> list[str]:
        """The chunks of a text, each without its first blank, which the text's first chunk has too."""
        if "  " not in text and text[0] != " " and text[-1] != " " and not re.search(r"[^\S ] ", text):
            return text.split(" ")
        # A last blank alone stays with what is before it, as no chunk may be empty.
        return [c[1:] for c in re.split(r"(?s)(?<=\S)(?= .)", " " + text)]

    def _same(self, a: np.ndarray, b: np.ndarray, whole: bytes) -> bool:
        return all(b"".join(map(v.bytes.__getitem__, ids.tolist())) == whole for v, ids in ((self.a, a), (self.b, b)))

    def learn(self, chunks: list[str]) -> None:
        if not chunks:
            return
        spaced = [" " + c for c in chunks]
        a, b = self.a.encode(spaced), self.b.encode(chunks)
        (a_ids, n_a), (b_ids, n_b) = flat(a), flat(b)
        if not self._same(a_ids, b_ids, "".join(spaced).encode()) or (np.add.reduceat(self.a_size[a_ids], np.cumsum(n_a) - n_a) != np.add.reduceat(self.b_size[b_ids], np.cumsum(n_b) - n_b)).any():
            good = [self._same(np.array(x), np.array(y), w.encode()) for x, y, w in zip(a, b, spaced, strict=True)]
            self.known.update((c, -1) for c, ok in zip(chunks, good, strict=True) if not ok)
            chunks, a, b = ([x for x, ok in zip(xs, good, strict=True) if ok] for xs in (chunks, a, b))
            if not chunks:
                return
            (a_ids, n_a), (b_ids, n_b) = flat(a), flat(b)
        a_ends, b_ends = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
        first, last = overlaps(a_ends, b_ends)
        links = last - first + 1
        pairs = a_ids.repeat(links).astype(np.uint64) << np.uint64(32) | b_ids[spread(first, links)].astype(np.uint64)
        # Groups end with the A tokens after which no B token spans the gap.
        ends = b_ends[last] == a_ends
        a_cut, b_cut = np.flatnonzero(ends) + 1, last[ends] + 1
        at = np.cumsum(n_a)
        n_groups = np.diff(np.searchsorted(a_cut, at, "right"), prepend=0)
        n_links = np.diff(np.append(0, np.cumsum(links))[at], prepend=0)
        # Each group's A ids, the last with a bar, then its B ids, the last with a semicolon.
        size = len(self.a_size) if len(self.a_size) > len(self.b_size) else len(self.b_size)
        marks = []
        for ids, cut, last_mark in ((a_ids, a_cut, 1), (b_ids, b_cut, 2)):
            mark = np.zeros(len(ids), np.int64)
            mark[cut - 1] = last_mark * size
            marks.append(ids + mark)
        a_in, b_in = np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0)
        order = np.empty(len(a_ids) + len(b_ids), np.int64)
        order[np.arange(len(a_ids)) + (b_cut - b_in).repeat(a_in)] = marks[0]
        order[np.arange(len(b_ids)) + a_cut.repeat(b_in)] = marks[1]
        text = texts_of(self.texts[order])
        upto = np.cumsum(self.text_size[order])[at + np.cumsum(n_b) - 1]
        self.known.update(zip(chunks, range(self.n, self.n + len(chunks)), strict=True))
        self.n += len(chunks)
        self.rows.append((n_a, n_b, n_groups, n_links, np.diff(upto, prepend=0), pairs, text))

    def align(self, texts: list[str]) -> list[tuple[np.ndarray, bytes]]:
        """The chunk numbers and the groups of each text, as `a1,a2|b1;a3|b2`; nothing of a text without tokens."""
        cuts = [self.cut(t) if t else [] for t in texts]
        self.learn(list(set().union(*cuts).difference(self.known)))
        numbers = np.array([self.known[c] for c in chain.from_iterable(cuts)], np.int64)
        ends = np.cumsum([len(c) for c in cuts])
        found = [numbers[e - len(c) : e] for c, e in zip(cuts, ends, strict=True)]
        if len(numbers) and numbers.min() < 0:
            for k, text in enumerate(texts):
                if len(found[k]) and found[k].min() < 0:
                    if text not in self.known:
                        self.learn([text])
                    found[k] = np.array([self.known[text]] if self.known[text] >= 0 else [], np.int64)
        *_, width, _, text = self.tables()
        all_ = np.concatenate([np.zeros(0, np.int64), *found])
        said = text[spread((np.cumsum(width) - width)[all_], width[all_])].tobytes()
        upto = np.append(0, np.cumsum(width[all_]))
        out, k = [], 0
        for x in found:
            out.append((x, said[upto[k] : upto[k + len(x)] - 1] if len(x) else b""))
            k += len(x)
        return out

    def tables(self) -> tuple[np.ndarray, ...]:
        """n_a, n_b, n_groups, n_links and the size of the groups' text by chunk number, and all chunks' pairs and texts."""
        if len(self.rows) > 1:
            self.rows = [tuple(map(np.concatenate, zip(*self.rows, strict=True)))]
        return self.rows[0] if self.rows else (np.zeros(0, np.int64),) * 5 + (np.zeros(0, np.uint64), np.zeros(0, np.uint8))


_LOADED: dict[tuple[str, str, int], Aligner] = {}


def loaded(a_path: str, b_path: str) -> Aligner:
    key = (a_path, b_path, os.getpid())
    if key not in _LOADED:
        _LOADED[key] = Aligner(a_path, b_path)
    return _LOADED[key]


DOCS = [("doc_id", pa.int64()), *[(k, pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string())]
PAIRS = [(k, pa.int32()) for k in ("k", "a", "b", "n")]
UNIT_SCHEMA = "unit long, docs array<struct<doc_id:long,n_a:long,n_b:long,n_groups:long,n_links:long,groups_sha256:string>>, pairs array<struct<k:int,a:int,b:int,n:int>>, inside binary"


def unit_of(number: int, aligner: Aligner, ids: list[int | None], found: list[tuple[np.ndarray, str]]) -> pa.RecordBatch:
    """One row: the documents, the distinct pairs with how many of the documents hold each, and what links them.

    `inside` packs the chunks of each document and the pairs of each chunk's links.
    """
    *sizes, _, pairs, _ = aligner.tables()
    n_links = sizes[3]
    n_chunks = np.array([len(x) for x, _ in found])
    ends = np.cumsum(n_chunks)
    all_ = np.concatenate([x for x, _ in found])
    # The chunks that the unit has, numbered anew.
    has = np.zeros(aligner.n, bool)
    has[all_] = True
    used = np.flatnonzero(has)
    chunk = (np.cumsum(has) - 1)[all_]
    totals = []
    for size in sizes:
        upto = np.append(0, np.cumsum(size[all_]))
        totals.append(upto[ends] - upto[ends - n_chunks])
    width = n_links[used]
    distinct, pair = np.unique(pairs[spread((np.cumsum(n_links) - n_links)[used], width)], return_inverse=True)
    # How many documents hold each pair: those of a document's chunks, each once.
    starts, n = np.cumsum(width) - width, np.zeros(len(distinct), np.int64)
    for x, e in zip(n_chunks.tolist(), ends.tolist(), strict=True):
        mine = chunk[e - x : e]
        held = np.sort(pair[spread(starts[mine], width[mine])])
        n[held[np.append(held[1:] != held[:-1], True)] if len(held) else held] += 1
    columns = [ids, *totals, [d for _, d in found]]
    docs = pa.StructArray.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, DOCS, strict=True)], [k for k, _ in DOCS])
    values = [np.arange(len(distinct)), distinct >> np.uint64(32), distinct & np.uint64(0xFFFFFFFF), n]
    told = pa.StructArray.from_arrays([pa.array(v.astype(np.int32)) for v in values], [k for k, _ in PAIRS])
    inside = pack(n_chunks.astype(np.uint32), chunk.astype(np.uint32), width.astype(np.uint32), pair.astype(np.uint32))
    listed = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (docs, told)]
    return pa.record_batch([pa.array([number], pa.int64()), *listed, pa.array([inside], pa.binary())], names=["unit", "docs", "pairs", "inside"])


def units(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of UNIT_SCHEMA of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = loaded(a_path, b_path), TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        found: list[tuple[np.ndarray, str]] = []
        waiting: list[str] = []
        size = waits = 0

        def settle() -> None:
            found.extend((x, hashlib.sha256(said).hexdigest() if said else "") for x, said in aligner.align(waiting))
            waiting.clear()

        def unit() -> pa.RecordBatch:
            settle()
            out = unit_of(number, aligner, ids, found)
            ids.clear()
            found.clear()
            if aligner.n > MEMORY:
                aligner.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc_id)
                waiting.append(text.as_py() or "")
                size += len(waiting[-1])
                waits += len(waiting[-1])
                if size >= UNIT_BYTES:
                    yield unit()
                    number, size, waits = number + 1, 0, 0
                elif waits >= SLICE_BYTES:
                    settle()
                    waits = 0
        if ids:
            yield unit()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, UNIT_SCHEMA)


def token_groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, groups: the token ids of both vocabularies of each of docs (doc_id, text), cut where tokens of both end; empty for a text without tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = loaded(a_path, b_path)
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        ids_of = lambda part: list(map(int, part.split(",")))
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                found = [said.decode() for _, said in aligner.align([t or "" for t in part.column(1).to_pylist()])]
                groups = [[{"a": ids_of(a), "b": ids_of(b)} for a, b in (g.split("|") for g in said.split(";"))] if said else [] for said in found]
                yield pa.record_batch([part.column(0), pa.array(groups, kind)], names=["doc_id", "groups"])
                if aligner.n > MEMORY:
                    aligner.clear()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, groups array<struct<a:array<int>,b:array<int>>>")


def pair_counts(made: DataFrame) -> DataFrame:
    """a, b, docs, best: how many documents hold each id pair linked, and whether that is the highest of its A id."""
    counts = made.select(F.inline("pairs")).groupBy("a", "b").agg(F.sum("n").alias("docs"))
    return counts.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("a")))


def summed(unit: pa.Table, told: pa.Table) -> pa.Table:
    """The documents of one unit, with the links of each that are best and the sum of their counts; told: k, docs, best of its pairs."""
    docs = unit.column("docs").combine_chunks().values
    n_chunks, chunk, width, pair = unpack(unit.column("inside")[0].as_py())
    order = told.column("k").to_numpy()
    columns = []
    for name in ("best", "docs"):
        by_pair = np.zeros(len(order), np.int64)
        by_pair[order] = told.column(name).cast(pa.int64()).to_numpy()
        upto = np.append(0, np.cumsum(by_pair[pair]))
        ends = np.cumsum(width)
        by_chunk = upto[ends] - upto[ends - width]
        upto = np.append(0, np.cumsum(by_chunk[chunk]))
        ends = np.cumsum(n_chunks)
        columns.append(pa.array(upto[ends] - upto[ends - n_chunks], pa.int64()))
    kept = dict(zip([k for k, _ in DOCS], docs.flatten(), strict=True))
    digest = kept.pop("groups_sha256")
    return pa.table([*kept.values(), *columns, digest], names=[*kept, "n_best", "count_sum", "groups_sha256"])


def alignments(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """A row a document (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), and `pair_counts` of docs (doc_id, text)."""
    made = materialize(units(docs, a_path, b_path), "units")
    counts = pair_counts(made)
    told = made.select(F.col("unit").alias("owner"), F.inline("pairs")).join(counts.hint("merge"), ["a", "b"]).select("owner", "k", "docs", "best")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return made.select("unit", "docs", "inside").groupBy("unit").cogroup(told.groupBy("owner")).applyInArrow(summed, schema), counts


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op11_cross_tokens(docs: DataFrame) -> DataFrame:
    return alignments(docs, *default_vocabularies())[0]
