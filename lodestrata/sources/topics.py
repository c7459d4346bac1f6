"""Topic sources, with files as the way out when there is no broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.plans.bronze import as_messages, from_topic
from lodestrata.sources.files import read_document_stream, read_documents


def kafka_options(
    servers: str, topics: list[str], start: str = "earliest", **extra: str
) -> dict[str, str]:
    """Reader options; ``start`` is ``earliest`` (drain) or ``latest`` (listen)."""
    if start not in ("earliest", "latest"):
        raise ValueError(f"start must be earliest or latest, not {start!r}")
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": start,
        **extra,
    }


def read_topics(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Message stream of one or more topics (needs the Kafka connector)."""
    return from_topic(spark.readStream.format("kafka").options(**options).load())


def read_messages(
    spark: SparkSession,
    platform: str,
    kafka: dict[str, str] | None = None,
    path: str | None = None,
    stream: bool = False,
) -> DataFrame:
    """Messages of one platform from its topic if one is set, else from files."""
    if kafka:
        return read_topics(spark, kafka)
    if path is None:
        raise ValueError(f"no topic and no path given for {platform}")
    read = read_document_stream if stream else read_documents
    rows = as_messages(read(spark, path, timed=True), ingested_at=F.col("file_time"))
    return rows.withColumn("topic", F.lit(f"raw_{platform}"))
