"""Line deduplication by a deletion-neighbourhood join, edit bound 1.

Lines are the parts of a text between line feeds, without blanks at their ends.
A line repeats an earlier one if it is equal, or if both have at least `shortest`
characters and one insertion, deletion or replacement apart. Chains count: of each
connected class of lines the earliest, by doc_id and line number, stays.

Every distinct line that can have a partner emits all its variants, itself and each
deletion of one character, as hashed keys with the place of the deletion; lines
meet by equal keys. Two lines are one replacement apart if they have a variant in
common with the deletion at one place, and one insertion apart if one's deletion is
the other itself, so a star in each such group keeps all classes whole without
listing pairs. Links are verified by edit distance on the lines. Lines a replacement
apart share one group and no other, so the verified sizes of its groups, less itself,
and its partners by insertion and deletion are the number of a line's links.

A line can only have a partner if it shares its first or last half with it: an edit
leaves one half as it is. Lines whose halves are unique emit nothing; the halves are
counted first, for all lines. Variants travel packed, a row for each task and bucket.

Defined cases: null texts have no lines; blank lines are no lines and stay; rows
without a doc_id are left out, and keep their texts in `dedup_lines`; rows that repeat a
doc_id with other texts are documents of their own, ordered by a hash of the text; rows equal
in doc_id and text are one document, whose lines count as often as they stand; very long
lines are hashed as a whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix, partitions, release
from .components import components

SHORTEST = 20
#: Variants of a bucket on average, and lines whose variants a task packs at once.
BUCKET_VARIANTS, EMIT_LINES = 1 << 20, 8192
_P = 0x100000001B3
_P_INVERSE = np.uint64(pow(_P, -1, 1 << 64))


def variants(line: str) -> np.ndarray:
    """Hashes of the line and of each deletion of one character, in order of the place."""
    c = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    up = np.full(len(c) + 1, _P, np.uint64)
    up[0] = 1
    up = np.multiply.accumulate(up)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(c) * up[:-1], dtype=np.uint64)])
    gone = sums[:-1] + (sums[-1] - sums[1:]) * _P_INVERSE
    size = np.full(len(c) + 1, len(c) - 1, np.uint64)
    size[0] += np.uint64(1)
    return mix(np.concatenate([sums[-1:], gone]) + size * np.uint64(0x9E3779B97F4A7C15))


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, row (a hash of the text), line_no, line of each line that is not blank."""
    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return rows.select("doc_id", "row", "line_no", F.trim(F.regexp_replace("line", r"[\t\r]", " ")).alias("line")).where("line <> ''")


def half_keys(shortest: int):
    """Hashes of the halves of a line that a partner one edit away can share."""
    n, line = F.length("line"), F.col("line")
    cut = lambda h: (F.xxhash64(F.lit(1), h, line.substr(F.lit(1), h)), F.xxhash64(F.lit(2), n - h, line.substr(h + 1, n - h)), F.xxhash64(F.lit(2), n - 1 - h, line.substr(h + 2, n - 1 - h)))
    even, odd = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    return F.when(n >= shortest, F.array_distinct(F.array(*cut(even), *cut(odd))))


def linked(suspects: DataFrame) -> DataFrame:
    """a, b, place: hashes of distinct lines with a variant in common, from suspects (id, line).

    Variants are dealt to buckets of BUCKET_VARIANTS on average, one of which is in a task's memory at a time.

    With a place, a is the first line of those that are equal but for that place, and b another one; place -1 links a
    line with one that has a character more.
    """
    spark = suspects.sparkSession
    total = suspects.agg(F.sum(F.length("line") + 1)).first()[0] or 0
    buckets = max(4 * partitions(spark), -(-total // BUCKET_VARIANTS))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, EMIT_LINES):
                part = batch.slice(lo, EMIT_LINES)
                ids, keys, place = part.column(0).to_numpy(), [], []
                for line in part.column(1).to_pylist():
                    keys.append(variants(line))
                    place.append(np.arange(-1, len(keys[-1]) - 1, dtype=np.int32))
                size = [len(k) for k in keys]
                keys, place, ids = np.concatenate(keys), np.concatenate(place), np.repeat(ids, size)
                bucket = (keys % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
                some = np.flatnonzero(ends[1:] > ends[:-1])
                packed = lambda x, o=order, e=ends, s=some: pa.array([x[o[e[b] : e[b + 1]]].tobytes() for b in s], pa.binary())
                yield pa.record_batch([pa.array(some.astype(np.int32)), packed(keys), packed(place), packed(ids)], names=["bucket", "keys", "places", "ids"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for b, *x in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if b != bucket and held:
                    yield join(held)
                    held = []
                bucket = b
                held.append(x)
        if held:
            yield join(held)

    def join(rows: list[tuple[bytes, bytes, bytes]]) -> pa.RecordBatch:
        key, place, ids = (np.concatenate([np.frombuffer(r[k], t) for r in rows]) for k, t in enumerate((np.uint64, np.int32, np.int64)))
        order = np.lexsort((ids, place, key))
        key, place, ids = key[order], place[order], ids[order]
        first = np.searchsorted(key, key, "left")
        # In a group of one key, place -1 comes first: it is linked with every deletion that equals it.
        whole = (place[first] == -1) & (place != -1)
        a, b, at = [ids[first][whole]], [ids[whole]], [np.full(whole.sum(), -1, np.int32)]
        # Equal key and place: each is linked with the first of them.
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (place[1:] != place[:-1])
        start = np.flatnonzero(new)[np.cumsum(new) - 1] if len(key) else np.zeros(0, np.int64)
        rest = ~new
        a.append(ids[start][rest])
        b.append(ids[rest])
        at.append(place[rest])
        a, b, at = np.concatenate(a), np.concatenate(b), np.concatenate(at).astype(np.int64)
        # Groups are in order of ids, so that their first line is the smaller one.
        pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b), at])[:, a != b], axis=1)
        return pa.record_batch([pa.array(pair[0]), pa.array(pair[1]), pa.array(pair[2].astype(np.int32))], names=["a", "b", "place"])

    packed = suspects.select("id", "line").mapInArrow(emit, "bucket int, keys binary, places binary, ids binary")
    dealt = packed.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(meet, "a long, b long, place int").distinct()


def degrees(links: DataFrame) -> DataFrame:
    """id, links: with how many lines each is linked, from verified links (a, b, place) of `linked`."""
    stars = links.where("place >= 0")
    others = stars.groupBy("a", "place").agg(F.count("*").alias("n"))
    members = stars.select("a", "place", F.col("b").alias("id")).join(others, ["a", "place"]).select("id", "n")
    single = links.where("place < 0").select(F.explode(F.array("a", "b")).alias("id"), F.lit(1).cast("long").alias("n"))
    every = others.select(F.col("a").alias("id"), "n").unionByName(members).unionByName(single)
    return every.groupBy("id").agg(F.sum("n").alias("links"))


def line_classes(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, row, line_no, first_doc, first_line, gone, same, links of every line that is not blank.

    `first_*` is the earliest line of its class, `gone` whether that is another one, `same` whether an equal line comes
    first within all rows, `links` how many distinct lines it is linked with.
    """
    place = F.struct("doc_id", "row", "line_no")
    rows = lines_of(docs).select(place.alias("place"), F.xxhash64("line").alias("id"), F.xxhash64(F.lit(7), F.reverse("line")).alias("id2"), half_keys(shortest).alias("halves"))
    distinct = materialize(rows.groupBy("id", "id2").agg(F.min("place").alias("first"), F.first("halves").alias("halves")), "lines")
    halves = distinct.where("halves is not null").select("id", "first", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    wanted = materialize(halves.join(shared, "half").groupBy("id").agg(F.min("first").alias("first")).select("id", "first.*"), "suspects")
    numbers = wanted.groupBy("doc_id", "row").agg(F.collect_list(F.struct("line_no", "id")).alias("l"))
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    texts = texts.join(numbers.hint("merge"), ["doc_id", "row"])  # suspects grow with the corpus: never broadcast
    texts = texts.select(F.split("text", "\n").alias("t"), "l").select(F.inline(F.transform("l", lambda x: F.struct(x.id.alias("id"), F.try_element_at("t", x.line_no + 1).alias("line")))))
    suspects = materialize(texts.select("id", F.trim(F.regexp_replace("line", r"[\t\r]", " ")).alias("line")).where("line is not null").dropDuplicates(["id"]), "texts")
    release(wanted)
    pairs = linked(suspects)
    side = lambda c: suspects.select(F.col("id").alias(c), F.col("line").alias(f"line_{c}"))
    close = pairs.join(side("a"), "a").join(side("b"), "b").where(F.levenshtein("line_a", "line_b", 1) == 1).select("a", "b", "place")
    links = materialize(close, "links")
    release(suspects)
    tree = components(links.select("a", "b"))
    degree = degrees(links)
    named = distinct.select("id", "id2", "first").join(tree.withColumnRenamed("node", "id"), "id", "left").join(degree, "id", "left")
    named = materialize(named.select("id", "id2", "first", "component", F.coalesce("links", F.lit(0).cast("long")).alias("links")), "classes")
    release(distinct, links)
    earliest = named.where("component is not null").groupBy("component").agg(F.min("first").alias("earliest"))
    kept = ("id", "id2", "first")
    lone = named.where("component is null").select(*kept, F.col("first").alias("earliest"), "links")
    classes = named.where("component is not null").join(earliest, "component").select(*kept, "earliest", "links").unionByName(lone)
    found = rows.drop("halves").join(classes, ["id", "id2"])
    return found.select("place.*", F.col("earliest.doc_id").alias("first_doc"), F.col("earliest.line_no").alias("first_line"), (F.col("place") != F.col("earliest")).alias("gone"), (F.col("place") != F.col("first")).alias("same"), "links")


def dropped_lines(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, row, n_lines, dropped (sorted line numbers), n_equal, n_near, n_links of each document with lines."""
    lines, gone, same = line_classes(docs, shortest), F.col("gone"), F.col("same")
    return lines.groupBy("doc_id", "row").agg(F.count("*").alias("n_lines"), F.sort_array(F.collect_set(F.when(gone, F.col("line_no")))).alias("dropped"), F.count_if(gone & same).alias("n_equal"), F.count_if(gone & ~same).alias("n_near"), F.sum("links").alias("n_links"))


def dedup_lines(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """docs with the repeated lines taken out of their texts; all columns are kept."""
    gone = dropped_lines(docs, shortest).where("size(dropped) > 0").select(F.col("doc_id").alias("_lines_doc"), F.col("row").alias("_lines_row"), F.col("dropped").alias("_lines_gone"))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("_lines_gone", i)), "\n")
    joined = docs.join(gone, (F.col("doc_id") == F.col("_lines_doc")) & (F.xxhash64("text") == F.col("_lines_row")), "left")
    return joined.withColumn("text", F.when(F.col("_lines_gone").isNull(), F.col("text")).otherwise(kept)).select(*docs.columns)


def op6_line_dedup(docs: DataFrame) -> DataFrame:
    """One row a document, those without lines too; dropped line numbers are joined by commas."""
    every = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row")).distinct()
    rows = every.join(dropped_lines(docs), ["doc_id", "row"], "left")
    counts = (F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_lines", "n_equal", "n_near", "n_links"))
    return rows.select("doc_id", *counts, F.coalesce(F.array_join("dropped", ","), F.lit("")).alias("dropped"))


OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, string_split(text, chr(10)) AS t FROM documents WHERE text IS NOT NULL),
o AS (SELECT doc_id, i - 1 AS line_no, trim(regexp_replace(t[i], '[\t\r]', ' ', 'g'), ' ') AS line FROM (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS i FROM d)),
k AS (SELECT * FROM o WHERE line <> ''),
f AS (SELECT line, min({'d': doc_id, 'l': line_no}) AS first FROM k GROUP BY 1),
u AS (SELECT line, first, row_number() OVER (ORDER BY first) AS id FROM f),
v AS (SELECT id, i, substr(line, 1, i - 1) || substr(line, i + 1) AS cut FROM (SELECT id, line, unnest(range(1, length(line) + 1)) AS i FROM u WHERE length(line) >= 20)),
s AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.i = y.i AND x.cut = y.cut AND x.id < y.id UNION SELECT least(v.id, u.id), greatest(v.id, u.id) FROM v JOIN u ON v.cut = u.line AND length(u.line) >= 20),
e AS (SELECT a, b FROM s UNION ALL SELECT b, a FROM s),
g AS (SELECT a AS id, count(*) AS links FROM e GROUP BY 1),
r AS (SELECT id, id AS c FROM u UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id WHERE r.c < e.b),
m AS (SELECT id, min(c) AS c FROM r GROUP BY 1),
n AS (SELECT k.doc_id, k.line_no, coalesce(links, 0) AS links, own.first = {'d': k.doc_id, 'l': k.line_no} AS is_first, best.first <> {'d': k.doc_id, 'l': k.line_no} AS gone
 FROM k JOIN u own USING (line) JOIN m USING (id) JOIN u best ON best.id = m.c LEFT JOIN g ON g.id = own.id),
q AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone AND NOT is_first) AS n_equal, count(*) FILTER (WHERE gone AND is_first) AS n_near, CAST(sum(links) AS bigint) AS n_links, string_agg(CAST(line_no AS varchar), ',' ORDER BY line_no) FILTER (gone) AS dropped FROM n GROUP BY 1)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_equal, 0) AS n_equal, coalesce(n_near, 0) AS n_near, coalesce(n_links, 0) AS n_links, coalesce(dropped, '') AS dropped FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN q USING (doc_id)
"""
