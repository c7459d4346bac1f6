"""Working off a song catalogue against responses already fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.functions import cache_key, or_default
from lodestrata.operators.asof import asof_join
from lodestrata.operators.documents import has_item_list, has_items, json_objects

# How long a finished song and a cached response count.
DONE_DAYS = 7
CACHE_HOURS = 24


def done_flags(done: DataFrame, as_of: Column, key: str = "song", days: int = DONE_DAYS) -> DataFrame:
    """Flags that have not run out: one row a key with its newest ``done_at``.

    Setting a flag again prolongs it; a flag whose time is over is as if never set.
    """
    newest = done.groupBy(key).agg(F.max("done_at").alias("done_at"))
    return newest.filter(F.col("done_at") > as_of - F.make_dt_interval(F.lit(days)))


def skip_done(
    catalogue: DataFrame, done: DataFrame, as_of: Column, key: str = "song", days: int = DONE_DAYS
) -> DataFrame:
    """Catalogue rows whose song was not finished within the last days."""
    return catalogue.join(done_flags(done, as_of, key, days).select(key), key, "left_anti")


def done_rows(songs: DataFrame, as_of: Column, key: str = "song") -> DataFrame:
    return songs.select(key, as_of.alias("done_at")).distinct()


def cache_status(
    requests: DataFrame,
    cache: DataFrame,
    as_of: Column,
    prefix: str,
    query: str = "query",
    hours: int = CACHE_HOURS,
) -> DataFrame:
    """Requests with HIT, STALE or MISS and the response of a hit.

    ``cache`` has (cache_key, response_items, stored_at), one row per key. An
    expired entry is a miss; one that is there but holds no items is stale.
    """
    live = cache.filter(F.col("stored_at") > as_of - F.make_dt_interval(F.lit(0), F.lit(hours)))
    # The audio side also takes a single object for a valid item list.
    valid = has_items if prefix == "spotify" else has_item_list
    entries = live.select(
        "cache_key",
        "response_items",
        valid("response_items").alias("valid"),
        F.lit(True).alias("found"),
    )
    status = (
        F.when(F.col("found").isNull(), "MISS").when(F.col("valid"), "HIT").otherwise("STALE")
    )
    return (
        requests.withColumn("cache_key", cache_key(prefix, query))
        .join(entries, "cache_key", "left")
        .withColumn("status", status)
        .withColumn("response_items", F.when(F.col("status") == "HIT", F.col("response_items")))
        .drop("valid", "found")
    )


def cache_status_at(
    requests: DataFrame, cache: DataFrame, prefix: str, at: str, query: str = "query", hours: int = CACHE_HOURS
) -> DataFrame:
    """Requests with the status that the cache gave them at their own time.

    ``cache`` has all entries that were ever stored, (cache_key, response_items, stored_at);
    the newest one that was there counts, see :func:`cache_status`.
    """
    valid = has_items if prefix == "spotify" else has_item_list
    asked = requests.withColumn("cache_key", cache_key(prefix, query))
    entries = cache.select("cache_key", "response_items", "stored_at")
    met = asof_join(asked, entries, "cache_key", at, "stored_at", ["response_items"])
    live = F.col("entry.stored_at") > F.col(at) - F.make_dt_interval(F.lit(0), F.lit(hours))
    items = F.col("entry.response_items")
    status = F.when(live, F.when(valid(items), "HIT").otherwise("STALE")).otherwise("MISS")
    return met.withColumn("status", status).withColumn(
        "response_items", F.when(F.col("status") == "HIT", items)
    ).drop("entry")


def enrich_catalogue(
    catalogue: DataFrame, audio: DataFrame, video: DataFrame
) -> DataFrame:
    """Catalogue songs with the first hit of either platform.

    ``audio`` and ``video`` are (query, items): one response per query, items as
    JSON text. A song asks the audio side by its title, and the video side by
    title and the artist found. ``status`` tells how far a song got; the message
    columns are filled for ``success`` only. No song is lost: rejects stay as
    rows.
    """
    first = F.get(json_objects("items"), F.lit(0))
    audio_hit = audio.select(
        F.col("query").alias("song"), F.from_json(first, schemas.TRACK_DOC).alias("track")
    )
    video_hit = video.select(
        F.col("query").alias("video_query"), F.from_json(first, schemas.VIDEO_DOC).alias("video")
    )
    artist = F.try_element_at("track.album.artists", F.lit(1))["name"]
    asked = catalogue.join(audio_hit, "song", "left").withColumn("artist", artist)
    found = asked.withColumn("video_query", F.concat_ws(" ", "song", "artist")).join(
        video_hit, "video_query", "left"
    )
    status = (
        F.when(F.col("track").isNull(), "no_audio")
        .when(F.col("video").isNull(), "no_video")
        .otherwise("success")
    )
    track = F.col("track").withField("song_code", F.col("song_code"))
    snippet = (
        F.col("video.snippet")
        .withField("artist", F.col("artist"))
        .withField("song_name", F.col("song"))
        .withField("song_code", F.col("song_code"))
        .withField("original_artist", or_default("original_artist", ""))
        .withField("song_writers", F.col("artist"))
        .withField("recordings_title", F.col("song"))
    )
    done = F.col("status") == "success"
    audio_message = F.to_json(F.struct(F.struct(track.alias("items")).alias("tracks")))
    video_message = F.to_json(F.struct(F.col("video").withField("snippet", snippet).alias("items")))
    return found.withColumn("status", status).select(
        "song",
        "song_code",
        "original_artist",
        "artist",
        "status",
        F.when(done, audio_message).alias("spotify_message"),
        F.when(done, video_message).alias("youtube_message"),
    )


def run_counters(outcomes: DataFrame, skipped: DataFrame) -> DataFrame:
    """Songs per outcome. A skipped song counts as success too, as in a full run."""
    tagged = outcomes.select(
        F.when(F.col("status") == "success", "success").otherwise("fail").alias("counter")
    ).unionByName(
        skipped.select(F.explode(F.array(F.lit("skipped"), F.lit("success"))).alias("counter"))
    )
    return tagged.groupBy("counter").agg(F.count("*").alias("songs"))
