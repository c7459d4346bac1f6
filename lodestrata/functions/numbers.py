"""Counts, durations and percentages out of display strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions.text import as_column, strip_space


def parse_view_count(text: Column | str, suffix: bool = False) -> Column:
    """``'138,106,461 views'`` -> 138106461; no digits -> 0.

    Plain mode keeps the digits only, so ``'1.2M views'`` is 12. With
    ``suffix=True`` a K, M or B after the number scales it (1200000).
    """
    c = as_column(text)
    plain = F.regexp_replace(c, "[^0-9]", "").try_cast("bigint")
    if not suffix:
        return F.coalesce(plain, F.lit(0).cast("bigint"))
    number = F.regexp_extract(c, r"([0-9][0-9,]*\.?[0-9]*)\s*[KMBkmb]\b", 1)
    unit = F.upper(F.regexp_extract(c, r"[0-9]\s*([KMBkmb])\b", 1))
    scale = (
        F.when(unit == "K", F.lit(1_000))
        .when(unit == "M", F.lit(1_000_000))
        .when(unit == "B", F.lit(1_000_000_000))
    )
    scaled = F.regexp_replace(number, ",", "").try_cast("decimal(20,6)") * scale
    return F.coalesce(scaled.cast("bigint"), plain, F.lit(0).cast("bigint"))


def parse_duration(text: Column | str, hms: bool = False) -> Column:
    """``'4:05'`` -> 245 seconds; anything but two numeric parts -> 0.

    With ``hms=True`` an ``H:MM:SS`` length is understood as well.
    """
    parts = F.split(as_column(text), ":")
    n = F.transform(parts, lambda p: strip_space(p).try_cast("int"))
    seconds = F.when(
        F.size(parts) == 2, F.try_element_at(n, F.lit(1)) * 60 + F.try_element_at(n, F.lit(2))
    )
    if hms:
        seconds = seconds.when(
            F.size(parts) == 3,
            F.try_element_at(n, F.lit(1)) * 3600
            + F.try_element_at(n, F.lit(2)) * 60
            + F.try_element_at(n, F.lit(3)),
        )
    return F.coalesce(seconds, F.lit(0))


def success_rate(good: Column | str, total: Column | str) -> Column:
    """Percentage with two decimals, 0 where there is nothing to divide by.

    Divides exact decimals: the result does not depend on summation order.
    """
    g, t = as_column(good).cast("decimal(20,0)"), as_column(total).cast("decimal(20,0)")
    pct = F.round(F.lit(100).cast("decimal(3,0)") * g / F.nullif(t, F.lit(0)), 2)
    return F.when(t > 0, pct).otherwise(F.lit(0)).cast("decimal(12,2)")
