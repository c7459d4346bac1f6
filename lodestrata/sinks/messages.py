"""Message and bulk-file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import is_blank

# Fixed value: largest message the broker takes.
MAX_MESSAGE_BYTES = 10 * 1024 * 1024


def message_rows(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as one JSON message in ``value``."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def split_oversize(rows: DataFrame, limit: int = MAX_MESSAGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """(messages the broker takes, messages beyond its limit)."""
    large = F.octet_length("value") > limit
    return rows.filter(F.coalesce(~large, F.lit(True))), rows.filter(large)


def publish(df: DataFrame, destination: str, rejects: str | None = None, **options: str) -> None:
    """Send rows as messages. ``kafka:<topic>`` needs the connector, ``files:<path>`` does not.

    With ``rejects``, rows beyond the broker's limit are appended there as JSON lines
    and do not fail the others.
    """
    kind, _, target = destination.partition(":")
    if kind not in ("kafka", "files"):
        raise ValueError(f"unknown destination {destination!r}")
    rows = message_rows(df)
    if rejects:
        rows, large = split_oversize(rows)
        large.write.mode("append").text(rejects)
    if kind == "kafka":
        (
            rows.write.format("kafka")
            .option("topic", target)
            .option("kafka.max.request.size", str(MAX_MESSAGE_BYTES))
            .options(**options)
            .save()
        )
    else:
        rows.write.mode("append").options(**options).text(target)


def bulk_rows(df: DataFrame, key: str, index: str) -> DataFrame:
    """Search-index bulk format: an action line, then the document line.

    Documents without a key are left out. ``line`` 0 is the action, 1 the
    document; both come from one input row and stay next to each other.
    """
    action = F.to_json(
        F.struct(
            F.struct(F.lit(index).alias("_index"), F.col(key).cast("string").alias("_id")).alias(
                "index"
            )
        )
    )
    document = F.to_json(F.struct("*"))
    present = df.filter(~is_blank(F.col(key).cast("string")))
    return present.select(
        F.col(key).cast("string").alias("doc_id"),
        F.posexplode(F.array(action, document)).alias("line", "value"),
    )


def write_bulk(df: DataFrame, path: str, key: str, index: str) -> None:
    bulk_rows(df, key, index).select("value").write.mode("append").text(path)
