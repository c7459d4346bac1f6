"""One row per key out of several versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_version(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    keep: str = "newest",
) -> DataFrame:
    """The newest (or oldest) row per key.

    A rank filter of one: Spark cuts every key to its first row on the map side
    already (WindowGroupLimit), so a key that holds a third of the input sends
    one row per map task, and columns nobody reads are pruned.
    """
    if keep not in ("newest", "oldest"):
        raise ValueError(f"keep must be 'newest' or 'oldest', not {keep!r}")
    ranked = [c.desc() if keep == "newest" else c.asc() for c in order]
    window = Window.partitionBy(*keys).orderBy(*ranked)
    first = df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1")
    return first.drop("_rank")


def version_order(keep: str) -> list[Column]:
    """Order of versions by document, then by place inside the document.

    Inside one document the last occurrence wins either way, so for ``oldest``
    the position counts backwards.
    """
    pos = F.col("pos") if keep == "newest" else -F.col("pos")
    return [F.col("ingested_at"), F.col("raw_id"), pos]


def newest_rows(df: DataFrame, n: int, by: str, tie: str) -> DataFrame:
    """The newest ``n`` rows, ties broken by a key (a TakeOrdered, no full sort)."""
    return df.orderBy(F.col(by).desc(), F.col(tie).desc()).limit(n)
