"""Sharding by longest-processing-time scheduling.

Groups (documents of equal text) stay together. Sorted by size, largest
first, each group goes to the least-loaded shard. Groups of one size are
interchangeable, so the heap works on size classes (size, how many groups):
one class row holds what its groups give to each shard, and a group finds its
shard by its place in its class. The classes stream through one task in order
of size, which holds the shards' loads and nothing else; the driver sees none.

The law is `bytes`: shard sizes are as near equal as the groups allow. A group
larger than a fair share stays whole and has a shard of its own as far as the
schedule allows.

Defined cases: a null text has no bytes and is equal to the empty text; rows
that repeat a doc_id are all placed; rows without a doc_id are placed like others;
a shard's slots follow hashes, not doc_ids; a very long text is a group of its size;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: What a record takes besides its text.
OVERHEAD = 16
#: Rows that are numbered in one window partition, on average.
BLOCK_ROWS = 4096


def deal(load: list[int], size: int, count: int) -> list[int]:
    """How many of `count` groups of `size` each shard takes when one by one goes to the least-loaded (then lowest) shard.

    Equal to popping a heap of (load, shard) `count` times; long runs skip ahead in whole rounds.
    """
    given, left = [0] * len(load), count
    if left > 4 * len(load):
        # The level that all shards reach before the last groups: each takes what stays at or below it.
        low, high = min(load), max(load) + size * count
        while low < high:
            level = (low + high + 1) // 2
            if sum(max(0, (level - x) // size) for x in load) <= left:
                low = level
            else:
                high = level - 1
        given = [max(0, (low - x) // size) for x in load]
        left -= sum(given)
    heap = [(x + size * n, k) for k, (x, n) in enumerate(zip(load, given, strict=True))]
    heapq.heapify(heap)
    for _ in range(left):
        x, k = heap[0]
        heapq.heapreplace(heap, (x + size, k))
        given[k] += 1
    return given


def schedule(classes: DataFrame, shards: int) -> DataFrame:
    """size, upto: array of running counts by shard, from (size, n_groups) in descending size.

    Size classes are as many as there are distinct group sizes, far fewer than groups.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = [0] * shards
        for batch in batches:
            sizes, upto = batch.column(0).to_pylist(), []
            for size, count in zip(sizes, batch.column(1).to_pylist(), strict=True):
                given = deal(load, size, count)
                load = [x + size * n for x, n in zip(load, given, strict=True)]
                upto.append(list(accumulate(given)))
            yield pa.record_batch([pa.array(sizes, pa.int64()), pa.array(upto, pa.list_(pa.int64()))], names=["size", "upto"])

    ordered = classes.select("size", "n_groups").repartition(1).sortWithinPartitions(F.desc("size"))
    return ordered.mapInArrow(run, "size long, upto array<long>")


def numbered(df: DataFrame, n_rows: int, by: list[str], order: list[Column], out: str) -> DataFrame:
    """Adds `out` to the n_rows of df: 0, 1, 2, ... within each value of `by`, however many rows it has.

    Each value is cut into blocks by hash, as many as all rows need, numbered inside, and shifted by the rows of the blocks before.
    Equal rows are dealt over blocks too: the hash takes in the place of a row in its task, which the written table fixes.
    """
    blocks = max(1, -(-n_rows // BLOCK_ROWS))
    blocked = materialize(df.withColumn("_block", F.pmod(F.xxhash64(*order, F.monotonically_increasing_id()), F.lit(blocks)).cast("long")), "blocks")
    sizes = blocked.groupBy(*by, "_block").agg(F.count("*").alias("_n"))
    before = sizes.select(*by, "_block", (F.sum("_n").over(Window.partitionBy(*by).orderBy("_block")) - F.col("_n")).alias("_before"))
    inside = blocked.withColumn("_in", F.row_number().over(Window.partitionBy(*by, "_block").orderBy(*order)) - 1)
    return inside.join(before, [*by, "_block"]).withColumn(out, F.col("_before") + F.col("_in")).drop("_block", "_before", "_in")


def shard_by_bytes(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of docs (doc_id, text)."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + OVERHEAD).cast("long").alias("row_size"), F.crc32(raw).alias("text_crc32"), F.unhex(F.sha2(raw, 256)).alias("digest"))
    sized = materialize(sized, "sizes")
    groups = materialize(sized.groupBy("digest").agg(F.sum("row_size").alias("size")), "groups")
    classes = groups.groupBy("size").agg(F.count("*").alias("n_groups"))
    plan = materialize(schedule(classes, shards), "plan")
    placed = numbered(groups, groups.count(), ["size"], [F.col("digest")], "place").join(plan.hint("merge"), "size")  # classes grow with the corpus: never broadcast
    placed = placed.select("digest", F.size(F.filter("upto", lambda n: n <= F.col("place"))).alias("shard"))
    rows = sized.join(placed, "digest").select("doc_id", F.col("row_size").alias("size"), "text_crc32", "shard")
    return numbered(rows, sized.count(), ["shard"], [F.col("doc_id"), F.col("text_crc32")], "slot")


def op8_sharding(docs: DataFrame) -> DataFrame:
    rows = shard_by_bytes(docs)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
