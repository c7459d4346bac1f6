"""Bronze: responses as they came, with header columns and audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.functions import blank_to_null, is_json, natural_key, or_default, wall_clock
from lodestrata.operators.documents import json_objects

# The `source` audit value per platform.
SOURCE_NAMES = {"spotify": "spotify_api", "youtube": "youtube_api"}
BRONZE_TABLES = {"spotify": "bronze_spotify_raw", "youtube": "bronze_youtube_raw"}


def as_messages(
    df: DataFrame, value: str = "value", ingested_at: Column | None = None
) -> DataFrame:
    """(value) -> (raw_id, value, ingested_at).

    The key is the digest of the payload, so the same response read twice, on one day
    or two, is the same row. Without ``ingested_at`` the clock is taken; readers of
    files pass the file's time.
    """
    stamp = wall_clock() if ingested_at is None else ingested_at
    text = F.col(value).cast("string")
    return df.select(
        natural_key(text).alias("raw_id"), text.alias("value"), stamp.alias("ingested_at")
    )


def from_topic(df: DataFrame) -> DataFrame:
    """Topic rows -> messages keyed by topic, partition and offset."""
    return df.select(
        "topic",
        natural_key("topic", "partition", "offset").alias("raw_id"),
        F.col("value").cast("string").alias("value"),
        wall_clock(F.col("timestamp")).alias("ingested_at"),
    )


def split_undecodable(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): one bad message does not end the read."""
    good = is_json("value")
    bad = messages.filter(~good)
    return messages.filter(good), bad.withColumn("reason", F.lit("undecodable"))


def _first_item(items: Column, field: str) -> Column:
    return F.get_json_object(F.get(json_objects(items), F.lit(0)), field)


def bronze_spotify(messages: DataFrame, batch_id: str) -> DataFrame:
    parsed = messages.withColumn(
        "_t", F.from_json("value", schemas.AUDIO_RESPONSE)["tracks"]
    )
    t = F.col("_t")
    return parsed.select(
        "raw_id",
        F.lit(batch_id).alias("batch_id"),
        or_default(_first_item(t["items"], "$.name"), "").alias("search_query"),
        or_default(t["offset"], 0).alias("search_offset"),
        or_default(t["limit"], 0).alias("search_limit"),
        or_default(t["total"], 0).alias("search_total"),
        or_default(t["href"], "").alias("search_href"),
        t["next"].alias("search_next"),
        F.col("value").alias("raw_json"),
        "ingested_at",
        F.lit(SOURCE_NAMES["spotify"]).alias("source"),
    )


def bronze_youtube(messages: DataFrame, batch_id: str) -> DataFrame:
    parsed = messages.withColumn("_items", F.from_json("value", schemas.VIDEO_RESPONSE)["items"])
    items = F.col("_items")
    video_id = F.coalesce(
        blank_to_null(_first_item(items, "$.id.videoId")),
        _first_item(items, "$.videoId"),
        F.lit(""),
    )
    return parsed.select(
        "raw_id",
        F.lit(batch_id).alias("batch_id"),
        or_default(_first_item(items, "$.snippet.title"), "").alias("search_query"),
        video_id.alias("video_id"),
        F.col("value").alias("raw_json"),
        "ingested_at",
        F.lit(SOURCE_NAMES["youtube"]).alias("source"),
    )


ENVELOPES = {"spotify": bronze_spotify, "youtube": bronze_youtube}


def route_topics(
    messages: DataFrame, topics: dict[str, str], batch_id: str
) -> dict[str, DataFrame]:
    """Messages of several topics -> one bronze DataFrame per platform.

    ``topics`` names each platform's topic, e.g. ``{"spotify": "raw_spotify"}``.
    """
    unknown = set(topics) - set(ENVELOPES)
    if unknown:
        raise ValueError(f"unknown platform: {sorted(unknown)}")
    return {
        platform: ENVELOPES[platform](messages.filter(F.col("topic") == topic), batch_id)
        for platform, topic in topics.items()
    }
