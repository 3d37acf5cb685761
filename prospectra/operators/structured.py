"""Structured data in pages: JSON-LD scripts walked as VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, emails
from ..sources.shared import cut


def ld_scripts(html: Column | str) -> Column:
    """The bodies of a page's JSON-LD scripts, in order."""
    return F.regexp_extract_all(col(html), F.lit(r"(?is)<script\b[^>]*\btype\s*=\s*[\"']?application/ld\+json\b[^>]*>(.*?)</script\s*>"), 1)


def json_strings(rows: DataFrame, json: str, deepest: int = 64) -> DataFrame:
    """The other columns of rows, and key, depth, value of every string in the JSON text of a column, however deep.

    Texts are parsed once; each level of arrays and objects is then exploded, until no value holds others. `key` is that
    of the innermost object entry (null in none). Broken JSON, or JSON with a key twice in one object, and null have no
    strings. A text nested deeper than `deepest` raises ValueError.
    """
    spark, own = rows.sparkSession, [c for c in rows.columns if c != json]
    level = rows.select(*own, F.lit(None).cast("string").alias("key"), F.try_parse_json(json).alias("v")).where("v is not null")
    found = None
    for depth in range(deepest + 1):
        level = cut(level.withColumn("kind", F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)).where("kind in ('STRING', 'OBJECT', 'ARRAY')"), "level")
        leaves = level.where("kind = 'STRING'").select(*own, "key", F.lit(depth).alias("depth"), F.try_variant_get("v", "$", "string").alias("value"))
        found = leaves if found is None else found.unionByName(leaves)
        holders = level.where("kind <> 'STRING'").select(*own, F.col("key").alias("outer_key"), "v")
        if holders.isEmpty():
            return found
        level = holders.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(*own, F.coalesce("key", "outer_key").alias("key"), F.col("value").alias("v"))
    raise ValueError(f"JSON is nested deeper than {deepest} levels")


def structured_mailboxes(pages: DataFrame, id_: str, html: str = "html") -> DataFrame:
    """Id, email of every mailbox in a string of a page's JSON-LD, whatever holds it: distinct, cleaned like others."""
    scripts = pages.select(id_, F.explode(ld_scripts(html)).alias("json"))
    return json_strings(scripts, "json").select(id_, F.explode(emails(F.replace(F.lower("value"), F.lit("mailto:"), F.lit(" ")))).alias("email")).distinct()
