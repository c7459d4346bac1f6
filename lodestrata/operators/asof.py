"""As-of join: for every row of one side the newest row of the other that is not later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a time range. Rows of one key and range are ordered in one task.
RANGE_SECONDS = 3_600


def asof_join(
    rows: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    since: str,
    tie: Sequence[str] = (),
    range_seconds: int = RANGE_SECONDS,
) -> DataFrame:
    """`rows` with a column `entry`: the last `history` row of the key with `since` <= `at`.

    Both sides lie side by side in one order, and the last entry seen is carried along; no
    pairs arise. A key that holds most rows is split by time range: each range is ordered
    by itself, and what it starts with is the last entry of the ranges before, one row a
    range. Of entries of one time the greatest by `tie` counts. A null key or time has
    no entry (null); no row is lost.
    """
    width = range_seconds * 1_000_000
    entry = F.struct(*[F.col(c) for c in history.columns])
    asked = rows.select(
        F.struct("*").alias("_row"),
        F.lit(None).cast(history.schema).alias("entry"),
        F.col(key).alias("_key"),
        F.col(at).alias("_time"),
        F.lit(1).alias("_side"),
        F.lit(None).cast(history.select(F.struct(since, *tie).alias("o")).schema["o"].dataType).alias("_order"),
    )
    given = history.filter(F.col(key).isNotNull() & F.col(since).isNotNull()).select(
        F.lit(None).cast(rows.schema).alias("_row"),
        entry.alias("entry"),
        F.col(key).alias("_key"),
        F.col(since).alias("_time"),
        F.lit(0).alias("_side"),
        F.struct(since, *tie).alias("_order"),
    )
    instant = F.unix_micros(F.col("_time").cast("timestamp"))
    both = asked.unionByName(given).withColumn("_range", F.floor(instant / width))
    # what a range starts with
    ends = both.groupBy("_key", "_range").agg(F.max_by("entry", "_order").alias("_last"))
    ranges = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.filter("_key IS NOT NULL").select(
        "_key", "_range", F.last("_last", ignorenulls=True).over(ranges).alias("_before")
    )
    within = (
        Window.partitionBy("_key", "_range")
        .orderBy("_time", "_side", F.col("_order").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = both.withColumn("_seen", F.last("entry", ignorenulls=True).over(within)).filter("_side = 1")
    carried = seen.join(ends, ["_key", "_range"], "left")
    known = F.col("_key").isNotNull() & F.col("_time").isNotNull()
    return carried.select("_row.*", F.when(known, F.coalesce("_seen", "_before")).alias("entry"))
