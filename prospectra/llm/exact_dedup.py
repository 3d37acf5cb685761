"""Exact deduplication by a log-structured merge index of text digests.

Rows of (digest, identifier) fill memtables of at most `memtable_rows` rows; each is sorted and flushed as a run of
its own, without a shuffle. Runs stand in levels: when a level has `fanout` flushes they are merged by digest into one
sorted run of the next level, which keeps the smallest identifier of each digest. Every run has a filter: a hashed
set of its digests in FILTER_BITS bits. A probe asks the filters first, and only what they let through is joined with
the runs. An index can be reopened from its folder, and later batches flushed and probed.

Deduplication flushes all documents, compacts, and makes a filter of the digests that repeat. Only documents that it
lets through are hits; their bytes are verified against the text of the document that stays, and what only shares a
digest is grouped again by its text. Filters have a fixed size and go to every task: where very many digests
repeat they let more through, and results are the same.

Identifiers: `keep="largest"` stores -doc_id, so the smallest identifier is the largest doc_id.

Defined cases: rows without a doc_id are left out of groups, and stay in `exact_dedup`; a null text is empty; all
empty texts are equal; every row counts in group_size, and rows that repeat doc_id and text get the same result;
rows that repeat a doc_id with other texts are told apart by text; `exact_dedup` leaves one row of each group even so;
very long texts are hashed as a whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_path, fold_case, leave_one, marks, materialize, new_path, path_exists

#: Members of a group that one task verifies against one copy of the kept text.
HITS_A_TASK = 512
MEMTABLE_ROWS, FANOUT, FILTER_BITS = 1 << 20, 4, 24


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _place() -> Column:
    return F.xxhash64("digest").bitwiseAND((1 << FILTER_BITS) - 1)


def filter_of(digests: DataFrame) -> DataFrame:
    """word, bits: at most 2 ** (FILTER_BITS - 6) rows, whatever the number of digests."""
    bits = F.call_function("shiftleft", F.lit(1).cast("long"), _place().bitwiseAND(63).cast("int"))
    return digests.select(F.shiftright(_place(), 6).alias("word"), bits.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def let_through(rows: DataFrame, filters: DataFrame) -> DataFrame:
    """The rows whose digest a filter may hold: all that it holds, and few others."""
    asked = rows.withColumns({"_word": F.shiftright(_place(), 6), "_bit": _place().bitwiseAND(63).cast("int")})
    found = asked.join(F.broadcast(filters.withColumnsRenamed({"word": "_word", "bits": "_bits"})), "_word")  # of a fixed size
    return found.where("(shiftrightunsigned(_bits, _bit) & 1) = 1").drop("_word", "_bit", "_bits")


class DigestIndex:
    """Sorted digest runs in levels under one folder of the shared store; opening a folder that has an index resumes it."""

    RUN = "digest binary, id long, members long"
    FILTER = "word long, bits long"
    MANIFEST = "version long, level int, run string"

    def __init__(self, spark: SparkSession, path: str, memtable_rows: int = MEMTABLE_ROWS, fanout: int = FANOUT):
        self.spark, self.path, self.memtable_rows, self.fanout = spark, path, memtable_rows, fanout
        self.runs: list[tuple[int, str]] = []  # level and name
        self.version = 0
        if path_exists(spark, f"{path}/manifest"):
            held = spark.read.schema(self.MANIFEST).parquet(f"{path}/manifest")
            self.version = held.agg(F.max("version")).first()[0]
            self.runs = sorted((r.level, r.run) for r in held.where(F.col("version") == self.version).collect())  # a few runs a level

    def flush(self, keyed: DataFrame) -> None:
        """Adds (digest, id): memtables of each task become sorted runs of level 0. Map-side only."""
        memtable = F.floor(F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) / self.memtable_rows)
        rows = keyed.select("digest", "id", F.lit(1).cast("long").alias("members"), memtable.alias("memtable"))
        self._add(0, rows.sortWithinPartitions("memtable", "digest", "id"), [], "memtable")
        while full := [level for level in {k for k, _ in self.runs} if sum(k == level for k, _ in self.runs) >= self.fanout]:
            self.compact(min(full))

    def compact(self, level: int = 0) -> None:
        """Merges the runs of a level into one of the next: of each digest the smallest id, and the number of ids."""
        merged = [run for k, run in self.runs if k == level]
        if merged:
            rows = self._read(merged).groupBy("digest").agg(F.min("id").alias("id"), F.sum("members").alias("members"))
            self._add(level + 1, rows.sortWithinPartitions("digest"), merged)

    def read(self) -> DataFrame:
        """digest, id, members of all digests of the index."""
        rows = self._read([run for _, run in self.runs])
        if len(self.runs) == 1 and self.runs[0][0] > 0:
            return rows
        return rows.groupBy("digest").agg(F.min("id").alias("id"), F.sum("members").alias("members"))

    def probe(self, keyed: DataFrame) -> DataFrame:
        """The rows of keyed (digest, ...) whose digest is in the index, with its id and members as first_id, members."""
        if not self.runs:
            return keyed.limit(0).withColumns({"first_id": F.lit(0).cast("long"), "members": F.lit(0).cast("long")})
        parts = self.spark.read.schema(self.FILTER).parquet(*(f"{self.path}/{run}/filter" for _, run in self.runs))
        filters = parts.groupBy("word").agg(F.bit_or("bits").alias("bits"))
        found = self.read().withColumnRenamed("id", "first_id")
        return let_through(keyed, filters).join(found.hint("merge"), "digest")

    def drop(self) -> None:
        drop_path(self.spark, self.path)

    def _read(self, runs: list[str]) -> DataFrame:
        return reduce(DataFrame.unionByName, (self.spark.read.schema(self.RUN).parquet(f"{self.path}/{run}/rows").select("digest", "id", "members") for run in runs))

    def _add(self, level: int, rows: DataFrame, replaced: list[str], *by: str) -> None:
        run = f"level{level}-{uuid.uuid4().hex[:12]}"
        rows.write.partitionBy(*by).parquet(f"{self.path}/{run}/rows")
        filter_of(self._read([run])).write.parquet(f"{self.path}/{run}/filter")
        self.runs, self.version = [r for r in self.runs if r[1] not in replaced] + [(level, run)], self.version + 1
        # The new version counts once it is written; until then a reopened index sees the one before.
        state = self.spark.createDataFrame([(self.version, *r) for r in self.runs], self.MANIFEST)
        state.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        for old in replaced:
            drop_path(self.spark, f"{self.path}/{old}")


def _groups(docs: DataFrame, keep: str, digest) -> tuple[DataFrame, DataFrame]:
    """Rows whose digest is theirs alone (doc_id, digest), and the others: doc_id, keep_id, group_size, kept, digest, mark_a, mark_b."""
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be largest or smallest, not {keep!r}")
    spark, sign = docs.sparkSession, -1 if keep == "largest" else 1
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns(marks()).withColumn("text", fold_case("text"))
    keyed = rows.select("doc_id", digest(F.col("text")).alias("digest"), (F.col("doc_id") * sign).alias("id"), "mark_a", "mark_b", "text")
    index = DigestIndex(spark, new_path(spark, "digests"))
    index.flush(keyed.select("digest", "id"))
    index.compact()
    merged = index.read()
    alone = merged.where("members = 1").select((F.col("id") * sign).alias("doc_id"), "digest")

    # Hits: the filter of repeated digests decides which texts are moved at all. Both sides of the join are sorted, so that a digest of many rows is split.
    multi = merged.where("members > 1").select("digest", (F.col("id") * sign).alias("keep_id"), "members")
    asked = let_through(keyed.drop("id"), filter_of(multi.select("digest")))
    hits = materialize(asked.join(multi.hint("merge"), "digest"), "hits")
    # Every HITS_A_TASK of them are verified against a copy of the kept text.
    parts = F.ceil(F.col("members") / HITS_A_TASK).cast("int")
    leaders = hits.where("doc_id = keep_id").groupBy("digest").agg(F.max("text").alias("kept_text"), F.max(parts).alias("parts"))
    leaders = leaders.select("digest", "kept_text", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    spread = hits.withColumn("part", F.pmod(F.xxhash64("doc_id", "mark_a"), parts).cast("int"))
    same = F.col("text") == F.col("kept_text")
    checked = materialize(spread.join(leaders, ["digest", "part"]).select("digest", "doc_id", "keep_id", "members", "mark_a", "mark_b", same.alias("same"), F.when(~same, F.col("text")).alias("other")), "verified")

    kept = (F.col("doc_id") == F.col("keep_id")).alias("kept")
    columns = ("doc_id", "keep_id", "group_size", kept, "digest", "mark_a", "mark_b")
    rest = checked.where("not same")
    if rest.isEmpty():  # always so with SHA-256
        return alone, checked.withColumnRenamed("members", "group_size").select(*columns)
    # Same digest, other bytes: grouped by the bytes themselves.
    odd = rest.groupBy("digest").agg(F.count("*").alias("odd"))
    equal = checked.where("same").join(odd, "digest", "left").withColumn("group_size", F.col("members") - F.coalesce("odd", F.lit(0))).select(*columns)
    best = rest.groupBy("digest", "other").agg((F.min(F.col("doc_id") * sign) * sign).alias("keep_id"), F.count("*").alias("group_size"))
    return alone, equal.unionByName(rest.drop("keep_id").join(best, ["digest", "other"]).select(*columns))


def exact_groups(docs: DataFrame, keep: str = "largest", digest=digest_of) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest of every row of docs (doc_id, text).

    `digest` may be any function of the text: verification makes weak ones exact too.
    """
    alone, repeated = _groups(docs, keep, digest)
    lone = alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    return lone.unionByName(repeated.drop("mark_a", "mark_b"))


def exact_dedup(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """docs without the rows whose text is equal to that of a row that stays; all columns are kept."""
    return leave_one(docs, _groups(docs, keep, digest_of)[1], "digest")


def op5_exact_dedup(docs: DataFrame) -> DataFrame:
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
