"""Documents of every awkward kind, and whole-Python versions of what the operators share."""

import pyarrow.parquet as pq

LONG = "lang " * 30000
AWKWARD = [(1, None), (2, ""), (3, "  \n\t"), (4, "One"), (5, "one"), (6, "one two three four five six"), (6, "one two three four five six"), (7, "ONE two three four five six"), (8, LONG), (9, LONG), (10, "naïve Ünïcode 日本語 🙂 á"), (None, "no id"), (11, "tab\there\r\nand\x0bthere")]


def awkward(spark):
    """With columns whose names clash with those that operators make."""
    rows = [(i, t, "x", "y", 1, 2, True, "z", 0.5) for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, digest string, key string, part int, component int, kept boolean, toxic string, score double")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


def texts(sf, table="documents"):
    t = pq.read_table(f"{sf}/{table}.parquet").to_pylist()
    return [(r.get("doc_id", r.get("item_id")), r["text"] or "") for r in t]


def fold(text):
    return (text or "").encode().lower()
