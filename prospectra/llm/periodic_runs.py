"""Periodic runs of words by Karp-Miller-Rosenberg naming.

A run is a stretch of consecutive words with smallest period q and a length of at least
max(`least_length`, `least_power` * q) that no neighbouring word extends.

Names: two positions have one name at level k if the 2^k words from them on are equal; the
names of level k + 1 number the pairs of level-k names that stand 2^k apart. A position whose
block occurs nowhere else in its document is dropped from all further levels, and naming ends
with the level at which no block occurs twice. So common prose has few names, and all levels
take n log n numbers at most. Words are numbered exactly, by a table of a document's words; no
hash of a block and no suffix order is used.

Candidates: a run of period p has at least (least_power - 1) * p consecutive positions that equal
the ones p later, so for any power of 3 and more a multiple of p * (least_power - 2) is among
them with a whole period of the run after it. These grid points are compared at the level of the
largest power of two within p; where names agree, the longest common extension to both sides,
by descending levels, gives the run. A stretch found with several periods has the smallest.

Documents are dealt by Spark and never shuffled; a task names slices of some documents at once,
whose words are numbered apart, so that no block is shared between documents.

Defined cases: a null or empty text has no words and no runs; rows that repeat a doc_id, or have
none, are rows like others; a very long text is named as a whole; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_text

#: Words that are named at once, unless one document alone has more.
SLICE_WORDS = 1 << 16
#: Candidates that are extended at once.
SLICE_CANDIDATES = 1 << 18

Runs = list[tuple[int, int, int]]
Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def levels_of(codes: np.ndarray) -> list[np.ndarray]:
    """Names by level: the array of level k has a number at each position whose block of 2^k occurs again, else -1."""
    n, out, names, width = len(codes), [], codes, 1
    live = np.arange(n)
    while True:
        _, place, count = np.unique(names, return_inverse=True, return_counts=True)
        again = count[place] > 1
        if not again.any():
            return out
        live, name = live[again], place[again]
        level = np.full(n, -1, np.int32)
        level[live] = name
        out.append(level)
        live = live[live + width < n]
        live = live[level[live + width] >= 0]
        names = level[live].astype(np.int64) << 32 | level[live + width]
        width *= 2


def extension(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
    """For each pair i < j, how many words from them on (with `back`: before them) are equal."""
    n, i, j = len(levels[0]), i.copy(), j.copy()
    begin = i.copy()
    for k in reversed(range(len(levels))):
        width, names = 1 << k, levels[k]
        if back:
            left, right = i - width, j - width
            inside = left >= 0
        else:
            left, right = i, j
            inside = right + width <= n
        found = names[np.where(inside, left, 0)]
        same = inside & (found >= 0) & (found == names[np.where(inside, right, 0)])
        step = np.where(same, -width if back else width, 0)
        i, j = i + step, j + step
    return begin - i if back else i - begin


def runs_of(codes: np.ndarray, least_power: int = 4, least_length: int = 6) -> np.ndarray:
    """Rows (start, length, period) of the runs of some numbers, by start, then period."""
    if least_power < 3:
        raise ValueError("the grid needs a power of at least 3")
    levels, n, found = levels_of(codes), len(codes), []
    held_i, held_p, held = [], [], 0

    def extend() -> None:
        i, p = np.concatenate(held_i), np.concatenate(held_p)
        before, after = extension(levels, i, i + p, back=True), extension(levels, i, i + p)
        long = (length := before + after + p) >= np.maximum(least_length, least_power * p)
        found.append(np.unique(np.stack([i - before, length, p], 1)[long], axis=0))

    # A block of 2^levels words occurs once, but a run repeats (least_power - 1) periods.
    longest = min(n // least_power, (1 << len(levels)) // (least_power - 1))
    for p in range(1, longest + 1):
        names = levels[p.bit_length() - 1]
        step = p * (least_power - 2)
        here = names[: n - p : step]
        at = np.flatnonzero((here >= 0) & (here == names[p::step]))
        if len(at):
            held_i.append(at * step)
            held_p.append(np.full(len(at), p))
            held += len(at)
            if held >= SLICE_CANDIDATES:
                extend()
                held_i, held_p, held = [], [], 0
    if held:
        extend()
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def runs_of_documents(documents: list[list[bytes]], least_power: int = 4, least_length: int = 6) -> list[np.ndarray]:
    """`runs_of` for each list of words, named together in slices."""
    out: list[np.ndarray] = []
    codes: list[int] = []
    ends: list[int] = []

    def flush() -> None:
        rows = runs_of(np.array(codes, np.int64), least_power, least_length)
        cut = np.searchsorted(rows[:, 0], [0, *ends])
        starts = [0, *ends]
        out.extend(rows[a:b] - np.array([s, 0, 0]) for s, a, b in zip(starts, cut, cut[1:], strict=False))
        codes.clear()
        ends.clear()

    base = 0
    for words in documents:
        numbers: dict[bytes, int] = {}
        for w in words:
            codes.append(numbers.setdefault(w, base + len(numbers)))
        base += len(numbers)
        ends.append(len(codes))
        if len(codes) >= SLICE_WORDS:
            flush()
    if ends:
        flush()
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that are left when every run keeps its first period only."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run of the greatest exact length / period; of equal ones the first by start, then period."""
    best = None
    for run in map(tuple, runs.tolist()):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def per_document(docs: DataFrame, finish: Callable, schema: str, kinds: list[pa.DataType], prepare: Prepare | None = None, least_power: int = 4, least_length: int = 6) -> DataFrame:
    """One row of `schema`, in Arrow `kinds`, for each of docs (doc_id, text): `finish(doc_id, words, runs)`; `prepare` may change a document's words first."""
    names = [x.split()[0] for x in schema.split(", ")]  # commas within a type have no blank

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(ids: list[int | None], words: list[list[bytes]]) -> pa.RecordBatch:
            found = [finish(*x) for x in zip(ids, words, runs_of_documents(words, least_power, least_length), strict=True)]
            return pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            ids, words, held = [], [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                split = text.as_py().split()  # bytes split on x20 and x09 to x0D
                ids.append(doc_id.as_py())
                words.append(prepare(ids[-1], split) if prepare else split)
                held += len(split)
                if held >= SLICE_WORDS:
                    yield rows(ids, words)
                    ids, words, held = [], [], 0
            if ids:
                yield rows(ids, words)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), binary_text()).mapInArrow(run, schema)


def collapse(docs: DataFrame, least_power: int = 4, least_length: int = 6) -> DataFrame:
    """doc_id, runs (start, length, period), text with every run cut down to its first period, words joined by one blank."""

    def finish(doc_id: int | None, words: list[bytes], runs: np.ndarray) -> tuple:
        listed = [{"start": s, "length": n, "period": p} for s, n, p in runs.tolist()]
        return doc_id, listed, b" ".join(collapsed(words, runs)).decode()

    listed = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))
    schema = "doc_id long, runs array<struct<start:long,length:long,period:long>>, text string"
    return per_document(docs, finish, schema, [pa.int64(), listed, pa.string()], None, least_power, least_length)


def woven(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words that the contract's query looks at: every tenth document, by checksum of its id, becomes periodic from some word on."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op13_periodic_runs(docs: DataFrame) -> DataFrame:
    def finish(doc_id: int | None, words: list[bytes], runs: np.ndarray) -> tuple:
        start, length, period = strongest(runs) or (None, None, None)
        power = None if period is None else 1000 * length // period
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist())
        left = b" ".join(collapsed(words, runs))
        return doc_id, len(runs), start, length, period, power, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest()

    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return per_document(docs, finish, schema, [pa.int64()] * 6 + [pa.string()] * 2, woven)
