"""Sums in order over groups of any size: ranges of the order are summed apart, each shifted by the ranges before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import cut


def running(rows: DataFrame, by: list[str], order: list[str], sums: dict[str, str], name: str = "ranges") -> DataFrame:
    """rows with `out`, for each out: column of sums, the column's sum up to and with each row, in this order, over rows of equal `by`.

    No task holds a group: rows are dealt by range of (by, order), so a group of any size is in many parts. What has one
    row a group and part is summed in a window of its own. Nulls in `by` are equal, and so are nulls in the order; rows of
    equal order are taken in some order.
    """
    dealt = cut(rows.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()), name)
    parts = dealt.groupBy(*by, "_part").agg(*[F.sum(c).alias(f"_{out}") for out, c in sums.items()])
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select(*[F.col(c).alias(f"_{c}_") for c in by], F.col("_part").alias("_part_"), *[F.coalesce(F.sum(f"_{out}").over(earlier), F.lit(0)).alias(f"_{out}") for out in sums])
    inside = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumns({out: F.sum(c).over(inside) for out, c in sums.items()})
    same = F.col("_part") == F.col("_part_")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}_"))
    return placed.join(shift, same).withColumns({out: F.col(out) + F.col(f"_{out}") for out in sums}).select(*rows.columns, *sums)
