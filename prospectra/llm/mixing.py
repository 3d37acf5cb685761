"""Mixing of sources to target weights along a curriculum, with native functions only.

Each source has a weight schedule: a weight that changes over training time, from 0 to 1, along
straight lines between knots. Its integral is the source's weight in the mix; integrals share
`share` times the words of all documents. A source whose part would be over `most` times its own
words stops there, and what is over goes to the others by weight until none is above. That fixpoint
is one level for all sources, min(cap, weight * level): with sources in order of cap / weight, each
gives the level that holds if the sources before it stop at their caps, and the largest is the one.

A source's documents, in an order by checksum of their ids, are its stream of words, taken again from
the start for a second pass. Cumulative demand at time t is the integral of the schedule up to t, scaled
to the target; inverting it at the place where a document starts in the stream gives the time at which
the document is due. Documents are then sorted by that position over ranges, and prefix sums of
their words number the words of the training run. The document in which a demand ends is taken as
far as the demand goes, so each source's taken words are its target, rounded.

Running sums go over ranges of the whole order, each shifted by the sums of the ranges before, so a
source of any size is split over many tasks, and so is the list of sources. The driver gets
three totals.

Defined cases: a null text has no words; a null source is a source, the last one; documents without
words are never due, and a source of such documents has a target of 0; rows that repeat a doc_id, or
have none, are documents of their own, in an order of their sizes and texts; a very long text is one document;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

Knots = list[tuple[float, float]]
#: Schedules of the sources, in order of their names, repeating: (time, weight). They integrate to 5, 2 and 1.
SCHEDULES: list[Knots] = [[(0.0, 7.5), (1.0, 2.5)], [(0.0, 1.0), (0.5, 3.0), (1.0, 1.0)], [(0.0, 0.5), (1.0, 1.5)]]
SPACE = r"\x20\x09-\x0D"


def n_words(text: Column) -> Column:
    """How many `[^\\x20\\x09-\\x0D]+` a text has: each with the space around it becomes one character, which are counted."""
    ones = F.length(F.regexp_replace(text, f"[{SPACE}]*+[^{SPACE}]++[{SPACE}]*+", "x"))
    return F.when(text.rlike(f"[^{SPACE}]"), ones).otherwise(0).cast("long")


def integral(knots: Knots) -> float:
    """The weight of a schedule, which must run from 0 to 1 and be above 0 somewhere."""
    times, weights = [t for t, _ in knots], [w for _, w in knots]
    if times != sorted(set(times)) or times[0] != 0 or times[-1] != 1 or min(weights) < 0:
        raise ValueError(f"a schedule has ascending times from 0 to 1 and no weight below 0: {knots}")
    total = sum((t2 - t1) * (w1 + w2) / 2 for (t1, w1), (t2, w2) in zip(knots, knots[1:], strict=False))
    if total <= 0:
        raise ValueError(f"a schedule needs some weight: {knots}")
    return total


def running(rows: DataFrame, by: list[str], order: list[str], sums: dict[str, str]) -> DataFrame:
    """rows with `out`, for each out: column of sums, the column's sum over the rows before, of equal `by`, in this order."""
    dealt = materialize(rows.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    parts = dealt.groupBy(*by, "_part").agg(*[F.sum(c).alias(f"_{out}") for out, c in sums.items()])
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select(*[F.col(c).alias(f"_{c}_") for c in by], F.col("_part").alias("_part_"), *[F.coalesce(F.sum(f"_{out}").over(earlier), F.lit(0)).alias(f"_{out}") for out in sums])
    inside = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumns({out: F.coalesce(F.sum(c).over(inside), F.lit(0)) for out, c in sums.items()})
    same = F.col("_part") == F.col("_part_")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}_"))
    return placed.join(shift, same).withColumns({out: F.col(out) + F.col(f"_{out}") for out in sums}).select(*rows.columns, *sums)


def targets(sized: DataFrame, schedules: list[Knots], share: float, most: float) -> DataFrame:
    """source, source_size, tier, target of each source of sized (source, size)."""
    weights = F.array(*[F.lit(integral(k)) for k in schedules])
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumns({"one": F.lit(1).cast("long"), "last": F.col("source").isNull()})
    ranked = running(sources, [], ["last", "source"], {"rank": "one"}).withColumn("tier", (F.col("rank") % len(schedules)).cast("int"))
    ranked = ranked.withColumns({"weight": F.get(weights, F.col("tier")), "cap": F.col("source_size") * F.lit(float(most))})
    stops = running(ranked.withColumn("level", F.col("cap") / F.col("weight")), [], ["level", "last", "source"], {"caps": "cap", "weights": "weight"})
    stops = materialize(stops.select("source", "source_size", "tier", "weight", "cap", "caps", "weights"), "stops")
    total = stops.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words, weight = float(total.words or 0) * share, total.weight or 0.0
    level = stops.agg(F.max((F.lit(words) - F.col("caps")) / (F.lit(weight) - F.col("weights")))).first()[0] or 0.0
    return stops.select("source", "source_size", "tier", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def due(schedules: list[Knots], tier: Column, part: Column) -> Column:
    """The time by which a schedule has given `part`, from 0 to below 1, of its integral."""
    tables = []
    for knots in schedules:
        total, done, lines = integral(knots), 0.0, []
        for (t1, w1), (t2, w2) in zip(knots, knots[1:], strict=False):
            upto = done + (t2 - t1) * (w1 + w2) / 2
            lines.append(F.struct(F.lit(t1).alias("time"), F.lit(w1).alias("weight"), F.lit((w2 - w1) / (t2 - t1)).alias("slope"), F.lit(done).alias("done"), F.lit(upto).alias("upto")))
            done = upto
        tables.append(F.struct(F.lit(total).alias("total"), F.array(*lines).alias("lines")))
    table = F.get(F.array(*tables), tier)
    asked = part * table["total"]
    line = F.get(F.filter(table["lines"], lambda x: x.upto > asked), F.lit(0))
    # The root of weight * x + slope * x * x / 2 = y that loses no digits.
    y = asked - line["done"]
    x = 2 * y / (line["weight"] + F.sqrt(F.greatest(line["weight"] * line["weight"] + 2 * line["slope"] * y, F.lit(0.0))))
    return F.coalesce(line["time"] + F.when(y > 0, x).otherwise(0.0), F.lit(1.0))


def mix(docs: DataFrame, schedules: list[Knots] = SCHEDULES, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """row, doc_id, source, size, source_size, target, copies of every row of docs (doc_id, source, text).

    `row` numbers the rows of docs; `copies` lists the passes in which the document is due: pass, words (all but in the
    document where the demand ends), position (training time from 0 to 1).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(text).alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key"), F.xxhash64(text).alias("mark"))
    sized = materialize(sized, "sizes")
    wanted = targets(sized, schedules, share, most).withColumnRenamed("source", "_source")
    placed = running(sized, ["source"], ["key", "doc_id", "size", "mark", "row"], {"at": "size"})
    rows = placed.join(wanted.hint("merge"), F.col("source").eqNullSafe(F.col("_source")))  # sources may be many: never broadcast
    demand = F.floor(F.col("target") + 0.5)
    starts = F.transform(F.sequence(F.lit(0), F.lit(math.ceil(most) - 1)), lambda k: F.struct(k.alias("pass"), (k * F.col("source_size") + F.col("at")).alias("from")))
    rows = rows.withColumns({"demand": demand.cast("long"), "starts": starts})
    words = lambda x: F.least(F.col("size"), F.col("demand") - x["from"])
    copies = F.transform(F.filter("starts", lambda x: words(x) > 0), lambda x: F.struct(x["pass"].alias("pass"), words(x).alias("words"), due(schedules, F.col("tier"), x["from"] / F.col("demand")).alias("position")))
    return rows.select("row", "doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def training_order(mixed: DataFrame) -> DataFrame:
    """row, doc_id, source, pass, words, position, first_word: what `mix` takes, in order of position within and over the parts.

    `first_word` is the number of the copy's first word in the training run.
    """
    due_rows = mixed.select("row", "doc_id", "source", F.inline("copies"))
    order = ["position", "source", "doc_id", "pass", "row"]
    numbered = running(due_rows, [], order, {"first_word": "words"})
    return numbered.repartitionByRange("first_word").sortWithinPartitions("first_word")


def op12_source_mixing(docs: DataFrame) -> DataFrame:
    mixed = materialize(mix(docs), "mixed")
    order = materialize(training_order(mixed), "training-order")
    taken = mixed.select("row", "doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("words")).unionByName(order.select("row", "words"), allowMissingColumns=True)
    one = taken.groupBy("row").agg(*[F.max(c).alias(c) for c in ("doc_id", "size", "source_size", "target")], F.sum("words").alias("taken"))
    return one.drop("row")


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM d GROUP BY source
), c AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
    coalesce(sum(2.0::DOUBLE * source_size) OVER w, 0) AS caps, coalesce(sum(weight) OVER w, 0) AS weights
  FROM s WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT max((1.5::DOUBLE * (SELECT sum(source_size)::DOUBLE FROM s) - caps) / ((SELECT sum(weight) FROM s) - weights)) AS level FROM c
), t AS (
  SELECT source, source_size, least(cap, weight * (SELECT level FROM l)) AS target FROM c
), p AS (
  SELECT d.doc_id, d.size::BIGINT AS size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS demand,
    (sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size)::BIGINT AS begins
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(size, demand - begins)) + greatest(0, least(size, demand - begins - source_size)))::BIGINT AS taken
FROM p
"""
