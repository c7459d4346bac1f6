"""Keyed upserts and daily totals from a stream.

A batch appends its changes, already reduced to one row per key; readers merge
them. Nothing that is being read is overwritten, and the cost of a batch follows
the batch, not the table. ``compact`` folds the changes into one batch, so reads
follow the keys, not the history.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import utc_wall
from lodestrata.session import delete_path
from lodestrata.streaming.epochs import batch_label, run_available, write_epoch


def stream_upsert(
    stream: DataFrame, keys: Sequence[str], order: Sequence[Column], path: str, checkpoint: str
) -> None:
    """Append each batch's newest and oldest row per key."""

    def each(batch: DataFrame, epoch: int) -> None:
        rest = [c for c in batch.columns if c not in keys]
        changes = batch.groupBy(*keys).agg(
            F.max_by(F.struct(*rest), F.struct(*order)).alias("last"),
            F.max(F.struct(*order)).alias("last_order"),
            F.min_by(F.struct(*rest), F.struct(*order)).alias("first"),
            F.min(F.struct(*order)).alias("first_order"),
        )
        write_epoch(changes, batch_label(batch, epoch), path)

    run_available(stream, checkpoint, each)


def read_upserted(
    spark: SparkSession, path: str, keys: Sequence[str], update_cols: Sequence[str]
) -> DataFrame:
    """State of the table: update columns from the newest row, others from the first."""
    merged = (
        spark.read.parquet(path)
        .groupBy(*keys)
        .agg(
            F.max_by("last", "last_order").alias("last"),
            F.min_by("first", "first_order").alias("first"),
        )
    )
    names = merged.schema["first"].dataType.fieldNames()
    values = [
        (F.col("last") if n in update_cols else F.col("first"))[n].alias(n) for n in names
    ]
    return merged.select(*keys, *values)


def compact(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Fold all batches so far into one and retire them; readers see the same state.

    Folding is idempotent: a base beside the batches it holds changes no result. So the
    base is written first, the batches go last, and a run that dies in between does no harm.
    """
    rows = spark.read.parquet(path)
    folded = [r.epoch for r in rows.select("epoch").distinct().collect()]
    base = rows.groupBy(*keys).agg(
        F.max_by("last", "last_order").alias("last"),
        F.max("last_order").alias("last_order"),
        F.min_by("first", "first_order").alias("first"),
        F.min("first_order").alias("first_order"),
    )
    write_epoch(base, f"base-{uuid.uuid4().hex}", path)
    for label in folded:
        delete_path(spark, f"{path}/epoch={label}")


def stream_daily(stream: DataFrame, path: str, checkpoint: str, day: str = "ts") -> None:
    """Rows per UTC day and source from a stream, however late a row comes.

    Each batch writes its own counts under its label, so nothing waits for a watermark
    and no state is kept; a repeated batch replaces its counts. ``day`` is an instant;
    make one of a zone-less time with ``utc_instant``.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        counts = batch.groupBy(F.to_date(utc_wall(day)).alias("date"), "source").agg(
            F.count("*").alias("row_count")
        )
        write_epoch(counts, batch_label(batch, epoch), path)

    run_available(stream, checkpoint, each)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """Total per day and source: the sum over all batches."""
    rows = spark.read.parquet(path)
    return rows.groupBy("date", "source").agg(F.sum("row_count").alias("row_count"))
