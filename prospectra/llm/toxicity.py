"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct character n-grams (FEW to MANY characters, hashed to
2 ** HASH_BITS) of a text, lower-cased, within words and up to one boundary on
either side. From labelled texts come the log-count ratios r of a feature in toxic
and other texts; a logistic regression is fitted on features of value r, and its
weights times r score every text. All features take part, unless `least_ratio` or
`least_docs` is given.

The fit uses at most `max_rows` labelled documents, those with the smallest hash of
doc_id (FIT_ROWS by default). Counts, losses and gradients are summed by tasks over
that sample, and the driver takes the steps of the fit on arrays of 2 ** HASH_BITS.
Scoring streams over all documents; the model has a fixed size.

Defined cases: a null text is empty, and an empty text gets the score of the bias
alone; labels without a value or a document are ignored, and of several labels of a
document the largest counts; of labelled rows that repeat a doc_id the smallest text
is learned from, and every row is scored by its own text; rows without a doc_id are
scored, and stay out of the fit; without labelled rows of both classes every score is
0 or 1, as the class there is (0 without any); very long texts are cut at blanks, which
changes no feature; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_up, in_parts, materialize, pack, release, unpack

HASH_BITS, FEW, MANY = 18, 3, 6
FIT_ROWS = 20_000
#: A text is toxic from this score on.
THRESHOLD = 0.3
#: Characters handed to one numpy pass.
PASS_CHARS = 1 << 18
PARTS = 12

_HELD: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    if "letters" not in _HELD:
        _HELD["letters"] = np.array([chr(c).isalnum() for c in range(0x10000)])
    return _HELD["letters"]


def distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys, without sorting: each is written to a board with its place, and the last place wins."""
    if "board" not in _HELD:
        _HELD["board"] = np.zeros(1 << HASH_BITS, np.int32)
    place, board = np.arange(len(keys), dtype=np.int32), _HELD["board"]
    board[keys] = place
    return keys[board[keys] == place]


def pieces(text: str) -> Iterator[str]:
    """A text in parts of PASS_CHARS or less, if it has blanks to cut at."""
    at = 0
    while len(text) - at > PASS_CHARS:
        cut = text.rfind(" ", at, at + PASS_CHARS)
        cut = cut if cut >= 0 else text.find(" ", at + PASS_CHARS)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def features(texts: list[str]) -> list[np.ndarray]:
    """The distinct hashed features of each text."""
    parts = [(k, p) for k, t in enumerate(texts) for p in pieces(t)]
    out: list[list[np.ndarray]] = [[] for _ in texts]
    at = 0
    while at < len(parts):
        stop, size = at, 0
        while stop < len(parts) and stop - at < 1 << 15 and (stop == at or size + len(parts[stop][1]) <= PASS_CHARS):
            size += len(parts[stop][1])
            stop += 1
        for (k, _), keys in zip(parts[at:stop], _features([p.lower() for _, p in parts[at:stop]]), strict=True):
            out[k].append(keys)
        at = stop
    return [x[0] if len(x) == 1 else distinct(np.concatenate(x)) for x in out]


def _features(texts: list[str]) -> list[np.ndarray]:
    x = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "replace"), np.uint32)
    of = np.repeat(np.arange(len(texts) + 1, dtype=np.uint16), [1, *(len(t) + 1 for t in texts)])  # the blank before a text counts to the one before
    space = ~(_letters()[np.minimum(x, 0xFFFF)] | (x > 0xFFFF))
    x = np.where(space, np.uint32(32), x).astype(np.uint64)
    spaces = np.concatenate([[0], np.cumsum(space)])
    h, n, rows, found = np.zeros(len(x), np.uint64), len(x), [], []
    for k in range(MANY):
        h = h[: n - k] * np.uint64(0x100000001B3) + x[k:]
        if k + 1 < FEW:
            continue
        m = n - k
        # Inner characters are of one word, and the first or the last is as well.
        inner = spaces[k : k + m] - spaces[1 : 1 + m] == 0
        where = np.flatnonzero(inner & ~(space[:m] & space[k:]))
        rows.append(of[where + 1])  # the second character is of the text
        found.append(((h[where] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)).astype(np.int32))
    rows, found = np.concatenate(rows), np.concatenate(found)
    found = found[np.argsort(rows, kind="stable")]
    ends = np.cumsum(np.bincount(rows, minlength=len(texts) + 1))
    return [distinct(found[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def _texts(batch: pa.RecordBatch, column: int, step: int = 256) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for lo in range(0, batch.num_rows, step):
        part = batch.slice(lo, step)
        yield part, [t or "" for t in part.column(column).to_pylist()]


def sampled(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """doc_id, toxic, text of the labelled documents to fit on."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))  # at most max_rows rows


def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (doc_id, toxic, text): classes, numbers of features and features of some documents, packed."""
    for batch in batches:
        for part, texts in _texts(batch, 2):
            keys = [np.sort(k) for k in features(texts)]
            toxic = part.column(1).to_numpy().astype(np.int64) > 0
            blob = pack(toxic.astype(np.uint8), np.array([len(k) for k in keys], np.uint32), np.concatenate(keys).astype(np.uint32))
            yield pa.record_batch([pa.array([blob], pa.binary())], names=["blob"])


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            toxic, size, keys = unpack(blob)
            yield toxic.astype(np.float64), size.astype(np.int64), keys.astype(np.int64)


def summed(table: DataFrame, add: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], None], width: int) -> np.ndarray:
    """What `add` makes of all blocks, in an array of `width` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for toxic, size, keys in blocks(batches):
            add(total, toxic, size, keys)
        yield in_parts(total)

    return add_up(table.mapInArrow(run, "part int, blob binary"), width)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = FIT_ROWS, least_ratio: float = 0.0, least_docs: int = 1, strength: float = 1.0, steps: int = 25) -> tuple[np.ndarray, float]:
    """Weights by feature and bias from docs (doc_id, text) and labels (doc_id, toxic).

    `least_ratio`, `least_docs`: features whose log-count ratio is nearer to 0, or that fewer documents have, are left out.
    """
    n = 1 << HASH_BITS
    rows = sampled(docs, labels, max_rows).repartition(PARTS, "doc_id").sortWithinPartitions("doc_id")
    table = materialize(rows.mapInArrow(listed, "blob binary"), "features")

    def count(total: np.ndarray, toxic: np.ndarray, size: np.ndarray, keys: np.ndarray) -> None:
        of = np.repeat(toxic, size)
        total[:n] += np.bincount(keys, 1 - of, n)
        total[n : 2 * n] += np.bincount(keys, of, n)
        total[2 * n :] += (len(toxic) - toxic.sum(), toxic.sum())

    seen = summed(table, count, 2 * n + 2)
    other, toxic = seen[2 * n :]
    if not other or not toxic:
        return np.zeros(n, np.float32), 40.0 if toxic else -40.0
    ratio = log_ratios(seen[:n], seen[n : 2 * n])
    ratio[(np.abs(ratio) < least_ratio) | (seen[:n] + seen[n : 2 * n] < max(least_docs, 1))] = 0
    all_rows, session = other + toxic, docs.sparkSession.sparkContext

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        """Penalised mean log loss and its gradient by weights, the bias last."""
        sent = session.broadcast(np.append(w[:-1] * ratio, w[-1]).astype(np.float32))

        def add(total: np.ndarray, toxic: np.ndarray, size: np.ndarray, keys: np.ndarray) -> None:
            x = sent.value.astype(np.float64)
            z = sums(x[keys], size) + x[-1]
            error = 1 / (1 + np.exp(-np.clip(z, -700, 700))) - toxic
            total[:n] += np.bincount(keys, np.repeat(error, size), n)
            total[n:] += (error.sum(), np.sum(np.logaddexp(0, z) - toxic * z))

        total = summed(table, add, n + 2) / all_rows
        sent.destroy()  # else the driver keeps one of each step
        penalty = strength / all_rows
        return total[n + 1] + penalty / 2 * np.sum(w[:-1] ** 2), np.append(total[:n] * ratio + penalty * w[:-1], total[n])

    w = descent(loss, np.append(np.zeros(n), np.log(toxic / other)), steps)
    release(table)
    return (w[:-1] * ratio).astype(np.float32), float(w[-1])


def log_ratios(other: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Of numbers of documents by feature, one added to each."""
    return np.log((toxic + 1) / (toxic.sum() + len(toxic))) - np.log((other + 1) / (other.sum() + len(other)))


def sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of runs of these sizes."""
    return np.bincount(np.repeat(np.arange(len(size)), size), values, len(size))


def descent(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], w: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Minimises a smooth loss by limited-memory quasi-Newton steps, halved until the loss goes down."""
    value, slope = loss(w)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        if np.abs(slope).max() < 1e-6:
            break
        d, held = slope.copy(), []
        for s, y, rho in reversed(moves):
            held.append(rho * (s @ d))
            d -= held[-1] * y
        if moves:
            s, y, _ = moves[-1]
            d *= (s @ y) / (y @ y)
        else:
            d /= max(np.abs(slope).sum(), 1e-12)
        for (s, y, rho), a in zip(moves, reversed(held), strict=True):
            d += (a - rho * (y @ d)) * s
        rate, down = 1.0, slope @ d
        for _ in range(12):
            following = w - rate * d
            value2, slope2 = loss(following)
            if value2 <= value - 1e-4 * rate * down:
                break
            rate /= 2
        else:
            break
        s, y = following - w, slope2 - slope
        if s @ y > 1e-12:
            moves = [*moves, (s, y, 1 / (s @ y))][-memory:]
        w, value, slope = following, value2, slope2
    return w


def chances(texts: list[str], w: np.ndarray, bias: float) -> np.ndarray:
    z = np.array([w[k].sum(dtype=np.float64) for k in features(texts)]) + bias
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def scores(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """doc_id, score of each row of docs (doc_id, text). The model has a fixed size and goes with the tasks."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _texts(batch, 1):
                yield pa.record_batch([part.column(0), pa.array(chances(texts, sent.value, bias))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def fold(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.where(fold() != 2)


def op2_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    weights, bias = fit(docs, training_labels(labels))
    scored = scores(docs, weights, bias)
    return scored.select("doc_id", (fold() == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without those whose score reaches the threshold; all columns are kept, and no row is moved."""
    weights, bias = fit(docs, training_labels(labels))
    sent, at = docs.sparkSession.sparkContext.broadcast(weights), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _texts(batch, at):
                yield part.filter(pa.array(chances(texts, sent.value, bias) < threshold))

    return docs.mapInArrow(run, docs.schema)
