"""Near-duplicate detection with HyperMinHash sketches.

A document's set is its distinct word shingles, as 64-bit hashes. The sketch
splits them over BUCKETS by their leading bits; a bucket keeps, of the smallest
remainder, the count of leading zeros and MANTISSA bits after the first one.
Bands of registers are join keys. Candidates pass a Jaccard estimate that is
corrected for register collisions; what passes is confirmed on full sets.

No step lists all pairs of a group. Equal sets are one class, and only its
smallest doc_id goes on. In a band group every document is compared with one
leader, the one whose bands have the most company, such as the original of many
copies. Jaccard distance is a metric: a document near enough to its leader (CLOSED)
can have partners at 0.75 only among those at LOOSE or more, so these become one
cluster and the document is done with that group. What is left of the groups gets
a new leader, ROUNDS times; the rest is compared by sketches in tiles. At last
each cluster's full sets are intersected, in tiles of at most TILE documents on a
side; a tile gives the links of a spanning forest, not all of its pairs.

A pair at similarity 0.75 is missed by all bands with a probability of about
(1 - 0.75 ** BAND) ** (BUCKETS // BAND), some 1e-6. A partner is missed by a closed document's
cluster if two estimates are wrong by 0.2 together: with 256 registers their standard errors
add up to 0.04, so that is five of them, some 1e-6 too. Sets much smaller than 256 fill a register
each, and their estimates are nearly exact.

Sets and sketches belong to nodes: a node is a class of equal sets, and has the text of one row.

Defined cases: null, empty and blank texts have an empty set and are linked with
nothing; fewer words than `width` are one shingle; rows that repeat a doc_id are documents
of their own, each linked by its own text; rows equal in doc_id and text get the same
result; rows without a doc_id are left out, and stay in `near_dedup`, which leaves one row
of each component; very long texts are hashed in one piece; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, binary_text, leave_one, marks, materialize, mix, release, shingles, slices
from .components import components

INDEX_BITS, MANTISSA, BAND = 8, 10, 5
BUCKETS = 1 << INDEX_BITS
#: Estimates at which documents form a cluster, and at which a document is done with a group: with errors of 0.1
#: allowed for, 1 - LOOSE is the sum of 1 - 0.75 and 1 - CLOSED at least.
LOOSE, CLOSED, ROUNDS = 0.3, 0.75, 3
#: Of a tile, the documents on one side, and the shingles that they have together.
TILE, TILE_LOAD = 256, 300_000


def sketch(rows: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """Registers of n rows from their sorted distinct hashes: 0 if empty, else 1 + (zeros << MANTISSA) + mantissa."""
    out = np.zeros((n, BUCKETS), np.uint16)
    bucket = (keys >> np.uint64(64 - INDEX_BITS)).astype(np.int64)
    cell = rows * BUCKETS + bucket
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]  # the hashes are sorted, so a bucket's first is its smallest
    rest = (keys[first] << np.uint64(INDEX_BITS)) >> np.uint64(12)  # 52 bits: exact as a float
    bits = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    zeros = np.minimum(52 - bits, 52 - MANTISSA - 1)
    shift = 52 - zeros - 1 - MANTISSA
    mantissa = (rest >> shift.astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
    out.reshape(-1)[cell[first]] = (1 + (zeros << MANTISSA) + mantissa.astype(np.int64)).astype(np.uint16)
    return out


#: For each bucket, in which order it looks for one that is not empty.
ROUTES = np.argsort(mix(np.arange(BUCKETS * BUCKETS, dtype=np.uint64) + np.uint64(12345)).reshape(BUCKETS, BUCKETS), axis=1)


def filled(registers: np.ndarray) -> np.ndarray:
    """Registers for banding: each empty bucket takes over that of the first other one on its route that is not empty.

    So a short document's bands rest on as many of its shingles as a long one's, and one common shingle makes no company.
    """
    out = registers.copy()
    row, bucket = np.nonzero(registers == 0)
    for step in range(BUCKETS):
        if not len(row):
            break
        value = registers[row, ROUTES[bucket, step]]
        out[row, bucket] = value
        row, bucket = row[value == 0], bucket[value == 0]
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A key for each row and band; 0 where the document has no shingles."""
    n, registers = BUCKETS // BAND, filled(registers)
    cut = registers[:, : n * BAND].reshape(len(registers), n, BAND).astype(np.uint64)
    acc = np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64), cut.shape[:2]).copy()
    for j in range(BAND):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, j] + np.uint64(1)
    return np.where(cut.any(axis=2), mix(acc) | np.uint64(1), np.uint64(0))


@lru_cache(maxsize=4096)
def _chance(n_class: int, m_class: int) -> float:
    """Chance that a bucket's registers agree for unrelated sets of about 1.2 ** class elements."""
    n, m = 1.2**n_class / BUCKETS, 1.2**m_class / BUCKETS
    zeros = np.arange(0, 24)[:, None]
    step = np.arange(0, 1 << MANTISSA)[None, :]
    low = (1 + step / (1 << MANTISSA)) / 2.0 ** (zeros + 1)
    high = low + 2.0 ** -(zeros + 1 + MANTISSA)
    cell = lambda x: np.exp(-x * low) - np.exp(-x * high)
    return float((cell(n) * cell(m)).sum())


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of register rows a and b of sets of n and m elements, and the buckets they rest on."""
    used = ((a | b) != 0).sum(axis=-1)
    equal = ((a == b) & (a != 0)).sum(axis=-1).astype(float)
    kind = lambda x: np.round(np.log(np.maximum(x, 1)) / np.log(1.2)).astype(int)
    kn, km = np.broadcast_arrays(kind(n), kind(m))
    pairs, at = np.unique(np.stack([kn.ravel(), km.ravel()]), axis=1, return_inverse=True)
    chance = np.array([_chance(int(x), int(y)) for x, y in pairs.T] or [0.0])[at].reshape(kn.shape)
    disjoint = np.maximum(used - equal, 0)
    return np.clip((equal - chance * disjoint) / np.maximum(used, 1), 0, 1), used


def rows_of(docs: DataFrame) -> DataFrame:
    """doc_id, mark_a, mark_b, text as bytes."""
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), *(c.alias(k) for k, c in marks().items()), binary_text())


def sketches(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, mark_a, mark_b, n_shingles, digest (128 bits of the set), registers of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(3)):
                text = batch.column(3).slice(lo, hi - lo)
                rows, keys = shingles(Words(text), width)
                n = hi - lo
                total = np.zeros((n, 2), np.uint64)
                first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(rows) else np.zeros(0, np.int64)
                if len(rows):
                    total[rows[first], 0] = np.add.reduceat(keys, first)
                    total[rows[first], 1] = np.add.reduceat(mix(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first)
                registers = sketch(rows, keys, n)
                yield pa.record_batch(
                    [*(batch.column(k).slice(lo, n) for k in range(3)), pa.array(np.bincount(rows, minlength=n).astype(np.int64)), pa.array([x.tobytes() for x in total], pa.binary()), pa.array([x.tobytes() for x in registers], pa.binary())],
                    names=["doc_id", "mark_a", "mark_b", "n_shingles", "digest", "registers"],
                )

    return rows_of(docs).mapInArrow(run, "doc_id long, mark_a long, mark_b long, n_shingles long, digest binary, registers binary")


def registers_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def bands(reps: DataFrame) -> DataFrame:
    """key, node: the band keys of reps (node, registers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                keys = band_keys(registers_of(part.column(1)))
                nodes = np.broadcast_to(part.column(0).to_numpy()[:, None], keys.shape)
                yield pa.record_batch([pa.array(keys[keys != 0].view(np.int64)), pa.array(nodes[keys != 0])], names=["key", "node"])

    return reps.select("node", "registers").mapInArrow(run, "key long, node long")


def forest(ids: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (smallest id, other) of each connected class of a symmetric matrix of links."""
    out, free = [], np.ones(len(ids), bool)
    for i in np.argsort(ids, kind="stable"):
        if not free[i]:
            continue
        held = np.zeros(len(ids), bool)
        held[i] = True
        front = held.copy()
        while front.any():
            front = linked[front].any(axis=0) & ~held
            held |= front
        free &= ~held
        out += [(int(ids[i]), int(j)) for j in ids[held] if j != ids[i]]
    return out


def tiles(rows: DataFrame, load: str | None = None) -> DataFrame:
    """Deals the rows (key, node, ...) of each key into chunks and repeats them for each pair of chunks: x <= y, chunk.

    A key of s rows has ceil(s / TILE) chunks, or more if `load` adds up to more than TILE_LOAD a chunk; a row is repeated once a chunk.
    """
    chunks = F.ceil(F.count("*") / TILE)
    if load:
        chunks = F.greatest(chunks, F.ceil(F.sum(load) / TILE_LOAD))
    sizes = rows.groupBy("key").agg(chunks.cast("int").alias("chunks"))
    dealt = rows.join(sizes, "key").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    repeated = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return repeated.withColumn("x", F.least("chunk", "other")).withColumn("y", F.greatest("chunk", "other")).drop("other", "chunks")


def by_tile(rows: DataFrame, compare, *columns: str) -> DataFrame:
    """a, b of compare(table of one tile) for every tile of rows; tiles stream through a task, one in memory at a time."""
    names = ["key", "x", "y", *columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []

        def done() -> pa.RecordBatch:
            found = compare(pa.Table.from_batches(held).combine_chunks())
            return pa.record_batch([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            k = np.stack([batch.column(c).to_numpy() for c in range(3)])
            cuts = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1), batch.num_rows] if batch.num_rows else [0]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if tuple(k[:, lo]) != tile and held:
                    yield done()
                    held = []
                tile = tuple(k[:, lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield done()

    dealt = rows.select(*names).repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return dealt.mapInArrow(run, "a long, b long")


def led(rows: DataFrame, reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over band groups (key, node): weak links (a, b), and the rows that are not done.

    The leader of a group is the node whose groups are largest in sum, then the smallest.
    """
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"))
    company = rows.join(sizes, "key").groupBy("node").agg(F.sum("n").alias("company"))
    first = rows.join(company, "node").groupBy("key").agg(F.max(F.struct("company", (-F.col("node")).alias("d"))).alias("m")).select("key", (-F.col("m.d")).alias("lead"))
    seated = materialize(rows.join(first, "key"), "led")
    half = lambda c: reps.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("registers").alias(f"r_{c}"))
    pairs = seated.where("lead <> node").select("lead", "node").distinct().join(half("lead"), "lead").join(half("node"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                x = batch.slice(lo, 4096)
                j, _ = estimate(registers_of(x.column(4)), registers_of(x.column(5)), x.column(2).to_numpy(), x.column(3).to_numpy())
                some = pa.array(j >= LOOSE)
                yield pa.record_batch([x.column(0).filter(some), x.column(1).filter(some), pa.array(j).filter(some)], names=["lead", "node", "j"])

    near = materialize(pairs.select("lead", "node", "n_lead", "n_node", "r_lead", "r_node").mapInArrow(run, "lead long, node long, j double"), "near")
    left = seated.where("lead <> node").join(near.where(F.col("j") >= CLOSED).select("lead", "node"), ["lead", "node"], "left_anti").select("key", "node")
    several = left.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    following = materialize(left.join(several, "key"), "left")
    release(seated)
    return near.select(F.col("lead").alias("a"), F.col("node").alias("b")), following


def by_sketch(percent: int):
    def compare(t: pa.Table) -> list[tuple[int, int]]:
        ids, n = t.column("node").to_numpy(), t.column("n_shingles").to_numpy()
        regs = registers_of(t.column("registers"))
        linked = np.zeros((len(ids), len(ids)), bool)
        for i in range(len(ids)):
            j, used = estimate(regs, regs[i], n, n[i : i + 1])
            linked[i] = j >= percent / 100 - 5 * np.sqrt(0.1875 / np.maximum(used, 1)) - 1 / np.maximum(used, 1)
        return forest(ids, linked | linked.T)

    return compare


def by_set(width: int, percent: int):
    def compare(t: pa.Table) -> list[tuple[int, int]]:
        ids, first = np.unique(t.column("node").to_numpy(), return_index=True)  # rows equal in doc_id and text are one
        text = t.column("text").combine_chunks().take(pa.array(first))
        rows, keys = [], []
        for lo, hi in slices(text):
            r, k = shingles(Words(text.slice(lo, hi - lo)), width)
            rows.append(r + lo)
            keys.append(k)
        rows, keys = np.concatenate(rows), np.concatenate(keys)
        size = np.bincount(rows, minlength=len(ids))
        # Columns are the shingles that two documents or more have; products of their incidence add up to intersections.
        _, column, times = np.unique(keys, return_inverse=True, return_counts=True)
        place = np.cumsum(times > 1) - 1
        some = times[column] > 1
        rows, column = rows[some], place[column[some]]
        order = np.argsort(column, kind="stable")
        rows, column = rows[order], column[order]
        inter = np.zeros((len(ids), len(ids)), np.float32)
        for lo in range(0, int(place[-1]) + 1 if len(place) else 0, 4096):
            p, q = np.searchsorted(column, (lo, lo + 4096))
            block = np.zeros((len(ids), 4096), np.float32)
            block[rows[p:q], column[p:q] - lo] = 1
            inter += block @ block.T
        inter = inter.astype(np.int64)
        uni = size[:, None] + size[None, :] - inter
        return forest(ids, (100 * inter >= percent * uni) & (uni > 0))

    return compare


def _placed(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, mark_a, mark_b, n_shingles, component_id of rows with shingles, and of those without.

    The former have a number of their component too: `component_id` tells components apart only if doc_ids don't repeat.
    """
    all_docs = materialize(sketches(docs, width), "sketches")
    some = all_docs.where("n_shingles > 0")
    # Equal sets are one class, a node; its number only tells it from others.
    best = some.groupBy("n_shingles", "digest").agg(F.min(F.struct("doc_id", "mark_a", "mark_b", "registers")).alias("m"))
    reps = materialize(best.select(F.monotonically_increasing_id().alias("node"), "n_shingles", "digest", "m.*"), "classes")
    # Band groups of two or more.
    keyed = bands(reps)
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    left = materialize(keyed.join(shared, "key"), "groups")
    weak: list[DataFrame] = []
    for _ in range(ROUNDS):
        if left.isEmpty():
            break
        links, rest = led(left, reps)
        release(left)
        left = rest
        weak.append(links)
    if not left.isEmpty():
        rest = tiles(left).join(reps.select("node", "n_shingles", "registers"), "node")
        weak.append(by_tile(rest, by_sketch(percent), "node", "n_shingles", "registers"))
    if weak:
        cluster = components(reduce(DataFrame.unionByName, weak)).withColumnRenamed("component", "key")
        # Both sides of the join with texts grow with the corpus: never broadcast.
        dealt = materialize(tiles(cluster.join(reps.select("node", "n_shingles", "doc_id", "mark_a", "mark_b"), "node"), "n_shingles"), "tiles")
        full = rows_of(docs).join(dealt.hint("merge"), ["doc_id", "mark_a", "mark_b"])
        tree = materialize(components(by_tile(full, by_set(width, percent), "node", "text")).join(reps.select("node", "doc_id"), "node"), "tree")
        release(dealt)
        least = tree.groupBy("component").agg(F.min("doc_id").alias("least"))
        held = reps.join(tree.join(least, "component").select("node", "component", "least"), "node", "left")
        reps = held.withColumns({"component_id": F.coalesce("least", "doc_id"), "component": F.coalesce("component", "node")})
    else:
        reps = reps.withColumns({"component_id": F.col("doc_id"), "component": F.col("node")})
    placed = some.drop("registers").join(reps.select("n_shingles", "digest", "component_id", "component"), ["n_shingles", "digest"])
    columns = ("doc_id", "mark_a", "mark_b", "n_shingles")
    return placed.select(*columns, "component_id", "component"), all_docs.where("n_shingles = 0").select(*columns, F.col("doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs (doc_id, text)."""
    placed, blank = _placed(docs, width, percent)
    return placed.drop("component").unionByName(blank).select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def near_dedup(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """docs with the smallest doc_id of each component only, and rows without words; all columns are kept."""
    placed = _placed(docs, width, percent)[0].withColumn("kept", F.col("doc_id") == F.col("component_id"))
    return leave_one(docs, materialize(placed, "placed"), "component")


def op10_minhash_near_dedup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM g x JOIN g y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 75 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
"""
