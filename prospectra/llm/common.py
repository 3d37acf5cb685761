"""What the training-data operators share: tables, shared folders, word hashing."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Text handed to one numpy pass at most, unless one document alone is longer.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_case(text: Column | str) -> Column:
    """Lower-cases A-Z and nothing else; null counts as empty."""
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), UPPER, LOWER)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors and the driver see.

    Read from `spark.checkpoint.dir`. Where that is unset a temporary folder is made once a session, on one machine
    only: elsewhere it would be lost or unreadable, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='prospectra-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes the rows to the shared folder and reads them again."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Removes what `materialize` wrote for tables that no plan reads any more."""
    for df in tables:
        drop_path(df.sparkSession, df._shared_path)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes a table of the shared folder that no plan reads any more."""
    store, where = _file_system(spark, path)
    store.delete(where, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    store, where = _file_system(spark, path)
    return store.exists(where)


# ---------------------------------------------------------------- rows


def marks(text: str = "text") -> dict[str, Column]:
    """Two 64-bit hashes of a text, null as empty: with doc_id they tell rows apart whose doc_id repeats."""
    plain = F.coalesce(F.col(text), F.lit(""))
    return {"mark_a": F.xxhash64(plain), "mark_b": F.xxhash64(F.lit(7), plain)}


def leave_one(docs: DataFrame, decided: DataFrame, group: str) -> DataFrame:
    """docs (doc_id, text, ...) with one row of each group of decided (doc_id, mark_a, mark_b, kept, group).

    Of a group's kept rows, which are several only if their doc_id repeats, the one with the smallest marks stays; rows
    equal in doc_id and text to it count as one, any of which stays. Rows that are not decided on stay.
    """
    key = ["doc_id", "mark_a", "mark_b"]
    kept, gone, twins = decided.where("kept"), decided.where("not kept").select(*key), None
    several = kept.groupBy(group).agg(F.count("*").alias("n"), F.min(F.struct("mark_a", "mark_b")).alias("first")).where("n > 1")
    if not several.isEmpty():
        held = materialize(kept.join(several.select(group, "first"), group).select(*key, (F.struct("mark_a", "mark_b") == F.col("first")).alias("first")), "repeated-ids")
        gone = gone.unionByName(held.where("not first").select(*key))
        twins = held.where("first").groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
    named = {k: f"_{k}_" for k in key}
    marked = docs.withColumns({"_doc_id_": F.col("doc_id").cast("long"), **{f"_{k}_": c for k, c in marks().items()}})
    out = marked.join(gone.withColumnsRenamed(named), list(named.values()), "left_anti")
    if twins is not None:
        twins = twins.withColumnsRenamed(named)
        one = out.join(twins, list(named.values()), "left_semi").dropDuplicates(list(named.values()))
        out = out.join(twins, list(named.values()), "left_anti").unionByName(one)
    return out.select(*docs.columns)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- word hashing

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        m = max(n, SLICE_BYTES + 1)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(m, base, np.uint64)
            steps[0] = 1
            _POWERS[key] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def slices(texts: pa.Array) -> list[tuple[int, int]]:
    """Row ranges [from, to) of about SLICE_BYTES of text each."""
    if len(texts) == 0:
        return []
    ends = np.asarray(offsets_of(texts)[1:], dtype=np.int64)
    ends = ends - offsets_of(texts)[0]
    cut, at = [0], 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        at = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        cut.append(min(at, len(texts)))
    return list(zip(cut, cut[1:], strict=False))


def offsets_of(texts: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_binary(texts.type)
    raw = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    return raw[texts.offset : texts.offset + len(texts) + 1]


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of some binary texts, A-Z lower-cased.

    `doc`: row of each word; `start`, `end`: bytes in `data`; `hash`: 64 bits.
    Null texts must be made empty before.
    """

    def __init__(self, texts: pa.Array):
        off = offsets_of(texts).astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None else np.zeros(0, np.uint8)
        off = off - off[0]
        self.n, self.data = len(texts), _FOLD[data]
        inside = ~_SPACE[data]
        first = np.ones(len(data) + 1, bool)
        first[1:-1] = ~inside[:-1]
        first[off] = True
        self.start = np.flatnonzero(inside & first[:-1])
        self.end = np.flatnonzero(inside & (first[1:] | ~np.append(inside[1:], False))) + 1
        self.doc = np.searchsorted(off, self.start, "right") - 1
        up, down = _powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
        size = (self.end - self.start).astype(np.uint64)
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start] + size * _STEP)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles of each row as 64-bit hashes: rows and hashes, sorted by both.

    A row with fewer words than `width` has its whole sequence as one shingle; one without words has none.
    """
    h, d = words.hash, words.doc
    n = max(0, len(h) - width + 1)
    acc = np.zeros(n, np.uint64)
    for j in range(width):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + h[j : j + n]
    full = d[:n] == d[width - 1 : width - 1 + n] if n else np.zeros(0, bool)
    rows, keys = d[:n][full], mix(acc[full])
    count = np.bincount(d, minlength=words.n)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        at = np.concatenate([[0], np.cumsum(count)])
        extra = np.zeros(len(short), np.uint64)
        for k, row in enumerate(short):
            x = np.uint64(count[row])
            for v in h[at[row] : at[row + 1]]:
                x = np.uint64((int(x) * 0xD6E8FEB86659FD93 + int(v)) & 0xFFFFFFFFFFFFFFFF)
            extra[k] = x
        rows, keys = np.concatenate([rows, short]), np.concatenate([keys, mix(extra)])
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
    return rows[new], keys[new]


def binary_text(text: str = "text") -> Column:
    """The text's UTF-8 bytes for Arrow functions; null counts as empty."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias(text)


# ---------------------------------------------------------------- packed shuffles


def even_keys(spark: SparkSession, n: int) -> list[int]:
    """n integers that `repartition(n, key)` deals to n different partitions."""
    ids = spark.range(32 * n + 64).select(F.col("id").cast("int").alias("k"))
    found = ids.groupBy(F.pmod(F.hash("k"), F.lit(n)).alias("p")).agg(F.min("k").alias("k")).orderBy("p").collect()
    taken = [r.k for r in found]
    return taken + [-1 - k for k in range(n - len(taken))]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value: bytes of like weight stand together, so small numbers cost little."""
    codec, out = pa.Codec("zstd", 1), []
    for a in arrays:
        a = np.ascontiguousarray(a)
        raw = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()
        data = codec.compress(raw, asbytes=True) if raw else b""
        out.append(len(a).to_bytes(6, "little") + a.dtype.str[1:].encode() + len(data).to_bytes(6, "little") + data)
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    codec, out, at = pa.Codec("zstd", 1), [], 0
    while at < len(data):
        n, kind, size = int.from_bytes(data[at : at + 6], "little"), np.dtype("<" + data[at + 6 : at + 8].decode()), int.from_bytes(data[at + 8 : at + 14], "little")
        raw = codec.decompress(data[at + 14 : at + 14 + size], n * kind.itemsize, asbytes=True) if n else b""
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, n).T).reshape(-1).view(kind))
        at += 14 + size
    return out


ARRAY_PARTS = 16


def in_parts(total: np.ndarray) -> pa.RecordBatch:
    """A task's array as rows (part, blob) for `add_up`."""
    flat = np.array_split(total, ARRAY_PARTS)
    return pa.record_batch([pa.array(range(ARRAY_PARTS), pa.int32()), pa.array([pack(x) for x in flat], pa.binary())], names=["part", "blob"])


def add_up(shares: DataFrame, width: int) -> np.ndarray:
    """The sum of the tasks' arrays of `width` numbers: added by part in Spark, so that the driver gets one array however many tasks there are.

    Equal arrays in another order of tasks add up to the same: blobs are sorted first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[part] = held.get(part, 0) + unpack(blob)[0]
        yield pa.record_batch([pa.array(list(held), pa.int32()), pa.array([pack(x) for x in held.values()], pa.binary())], names=["part", "blob"])

    dealt = shares.repartition(ARRAY_PARTS, "part").sortWithinPartitions("part", F.xxhash64("blob"))
    rows = sorted(dealt.mapInArrow(run, "part int, blob binary").collect())  # ARRAY_PARTS rows
    return np.concatenate([unpack(bytes(r.blob))[0] for r in rows]) if rows else np.zeros(width)
