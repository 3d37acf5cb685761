"""Loose values of spreadsheets and scripts as typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(c: Column | str, default: str = "") -> Column:
    """A string; null and empty become the default."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit(default))


def number_or(c: Column | str, default: float) -> Column:
    """A number; empty, zero, null and non-numbers become the default."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(F.trim(c.cast("string")).try_cast("double"), F.lit(0.0)), F.lit(float(default)))


def number_or_null(c: Column | str) -> Column:
    """A number; empty, zero and non-numbers become null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.trim(c.cast("string")).try_cast("double"), F.lit(0.0))


def round_half_up(c: Column, digits: int = 0) -> Column:
    """floor(x + 0.5), so that halves go up for negative numbers too."""
    scale = 10**digits
    return F.floor(c * scale + 0.5) / scale if digits else F.floor(c + 0.5)


def flag(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.coalesce(c.cast("string"), F.lit(""))) == "true"


def sent_state(c: Column | str) -> Column:
    """'true', 'skipped' or 'false'."""
    c = F.lower(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")))
    return F.when(c.isin("true", "skipped"), c).otherwise("false")


def upper_median(values: Column) -> Column:
    """Of an array: the element at floor(n / 2) in order; null if there is none."""
    return F.try_element_at(F.sort_array(values), (F.floor(F.size(values) / 2) + 1).cast("int"))
