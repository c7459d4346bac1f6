"""Silver: bronze documents flattened into one table per entity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.functions import (
    is_blank,
    or_default,
    parse_duration,
    parse_published,
    parse_view_count,
    release_date,
    strip_space,
)
from lodestrata.operators.documents import explode_response
from lodestrata.operators.latest import newest_rows, pick_version, version_order


def spotify_items(
    bronze: DataFrame, newest: int | None = None, doc: str = schemas.TRACK_DOC
) -> DataFrame:
    """One row per track document. All of bronze unless ``newest`` limits the scan.

    ``doc`` may declare fewer fields, for readers that need no others.
    """
    if newest is not None:
        bronze = newest_rows(bronze, newest, "ingested_at", "raw_id")
    return explode_response(bronze, ("tracks", "items"), doc)


def youtube_items(bronze: DataFrame, newest: int | None = None) -> DataFrame:
    if newest is not None:
        bronze = newest_rows(bronze, newest, "ingested_at", "raw_id")
    return explode_response(bronze, ("items",), schemas.VIDEO_DOC)


def _dedupe(rows: DataFrame, keys: list[str], keep: str) -> DataFrame:
    present = rows.filter(~is_blank(keys[0]))
    return pick_version(present, keys, version_order(keep), keep).drop("raw_id", "pos")


def _text(value: Column, name: str) -> Column:
    return or_default(value, "").alias(name)


def artists(items: DataFrame, keep: str = "newest") -> DataFrame:
    """From the tracks' artists; an album's own artists do not count here."""
    rows = items.select(
        "raw_id",
        "ingested_at",
        F.col("pos").alias("item_pos"),
        F.posexplode("item.artists").alias("artist_pos", "a"),
    )
    a = F.col("a")
    flat = rows.select(
        "raw_id",
        a["id"].alias("artist_id"),
        _text(a["name"], "artist_name"),
        _text(a["uri"], "artist_uri"),
        _text(a["href"], "artist_href"),
        _text(a["external_urls"]["spotify"], "spotify_url"),
        "ingested_at",
        F.col("ingested_at").alias("deduplicated_at"),
        "item_pos",
        "artist_pos",
    )
    # Two positions order the versions inside a document: track, then artist.
    sign = 1 if keep == "newest" else -1
    order = [
        F.col("ingested_at"),
        F.col("raw_id"),
        F.col("item_pos") * sign,
        F.col("artist_pos") * sign,
    ]
    best = pick_version(flat.filter(~is_blank("artist_id")), ["artist_id"], order, keep)
    return schemas.conform(best, "silver_spotify_artist")


def albums(items: DataFrame, keep: str = "newest") -> DataFrame:
    b = F.col("item.album")
    precision = or_default(b["release_date_precision"], "")
    flat = items.select(
        "raw_id",
        "pos",
        "ingested_at",
        b["id"].alias("album_id"),
        _text(b["name"], "album_name"),
        _text(b["album_type"], "album_type"),
        release_date(b["release_date"], precision).alias("release_date"),
        precision.alias("release_date_precision"),
        or_default(b["total_tracks"], 0).alias("total_tracks"),
        _text(b["uri"], "album_uri"),
        _text(b["href"], "album_href"),
        _text(b["external_urls"]["spotify"], "spotify_url"),
        or_default(b["is_playable"], False).alias("is_playable"),
        _text(F.try_element_at(b["images"], F.lit(1))["url"], "image_url"),
    )
    return schemas.conform(_dedupe(flat, ["album_id"], keep), "silver_spotify_album")


def album_artists(items: DataFrame) -> DataFrame:
    pairs = items.select(
        F.col("item.album.id").alias("album_id"), F.explode("item.album.artists.id").alias("artist_id")
    )
    return pairs.filter(~is_blank("album_id") & ~is_blank("artist_id")).distinct()


def tracks(items: DataFrame, keep: str = "newest") -> DataFrame:
    t = F.col("item")
    flat = items.select(
        "raw_id",
        "pos",
        "ingested_at",
        t["id"].alias("track_id"),
        _text(t["name"], "track_name"),
        _text(t["external_ids"]["isrc"], "isrc_code"),
        _text(t["album"]["id"], "album_id"),
        or_default(t["disc_number"], 1).alias("disc_number"),
        or_default(t["track_number"], 1).alias("track_number"),
        or_default(t["duration_ms"], 0).alias("duration_ms"),
        or_default(t["explicit"], False).alias("explicit"),
        or_default(t["is_local"], False).alias("is_local"),
        or_default(t["is_playable"], False).alias("is_playable"),
        _text(t["uri"], "track_uri"),
        _text(t["href"], "track_href"),
        _text(t["external_urls"]["spotify"], "spotify_url"),
        _text(t["song_code"], "song_code"),
    )
    return schemas.conform(_dedupe(flat, ["track_id"], keep), "silver_spotify_track")


def track_artists(items: DataFrame, keep: str = "newest") -> DataFrame:
    """Every (track, artist) pair once; the first artist of a track is primary."""
    pairs = items.select(
        "raw_id",
        "pos",
        "ingested_at",
        F.col("item.id").alias("track_id"),
        F.posexplode("item.artists.id").alias("artist_pos", "artist_id"),
    ).filter(~is_blank("artist_id"))
    flat = pairs.withColumn("is_primary", F.col("artist_pos") == 0)
    # An artist listed twice on one track keeps the first listing.
    first = -F.col("artist_pos") if keep == "newest" else F.col("artist_pos")
    order = [*version_order(keep), first]
    best = pick_version(flat.filter(~is_blank("track_id")), ["track_id", "artist_id"], order, keep)
    return schemas.conform(best, "silver_spotify_track_artist")


def channels(items: DataFrame, keep: str = "newest") -> DataFrame:
    """One row per channel; ``first_seen_at`` is the earliest sighting of all."""
    s = F.col("item.snippet")
    flat = items.select(
        s["channelId"].alias("channel_id"),
        strip_space(or_default(s["channelTitle"], "")).alias("channel_name"),
        "ingested_at",
        "raw_id",
        "pos",
    ).filter(~is_blank("channel_id"))
    pick = F.max_by if keep == "newest" else F.min_by
    return (
        flat.groupBy("channel_id")
        .agg(
            pick(
                F.struct("channel_name", "ingested_at"), F.struct(*version_order(keep))
            ).alias("v"),
            F.min("ingested_at").alias("first_seen_at"),
        )
        .select("channel_id", "v.channel_name", "v.ingested_at", "first_seen_at")
    )


def videos(
    items: DataFrame, keep: str = "newest", suffix: bool = False, hms: bool = False
) -> DataFrame:
    """``suffix`` and ``hms`` widen the number and duration formats understood."""
    v, s = F.col("item"), F.col("item.snippet")
    flat = items.select(
        "raw_id",
        "pos",
        "ingested_at",
        F.coalesce(F.nullif(v["id"]["videoId"], F.lit("")), v["videoId"]).alias("video_id"),
        _text(s["channelId"], "channel_id"),
        _text(s["title"], "title"),
        _text(s["artist"], "title_artist_name"),
        _text(s["song_name"], "title_song_name"),
        _text(s["publishedAt"], "published_at_raw"),
        parse_published(s["publishedAt"], "ingested_at").alias("published_at_parsed"),
        _text(v["contentDetails"]["duration"], "duration_raw"),
        parse_duration(v["contentDetails"]["duration"], hms).alias("duration_seconds"),
        parse_view_count(v["statistics"]["viewCount"], suffix).alias("view_count"),
        _text(s["thumbnails"]["default"]["url"], "thumbnail_url"),
        _text(s["song_code"], "song_code"),
        _text(s["original_artist"], "original_artist"),
        _text(s["song_writers"], "song_writers"),
        _text(s["recordings_title"], "recordings_title"),
        F.col("ingested_at").alias("updated_at"),
    )
    return schemas.conform(_dedupe(flat, ["video_id"], keep), "silver_youtube_video")


@dataclass(frozen=True)
class Silver:
    """The seven entity tables."""

    artist: DataFrame
    album: DataFrame
    album_artist: DataFrame
    track: DataFrame
    track_artist: DataFrame
    channel: DataFrame
    video: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "silver_spotify_artist": self.artist,
            "silver_spotify_album": self.album,
            "silver_spotify_album_artist": self.album_artist,
            "silver_spotify_track": self.track,
            "silver_spotify_track_artist": self.track_artist,
            "silver_youtube_channel": self.channel,
            "silver_youtube_video": self.video,
        }


def build_silver(
    bronze_spotify: DataFrame,
    bronze_youtube: DataFrame,
    keep: str = "newest",
    newest: int | None = None,
) -> Silver:
    """``newest=100, keep="oldest"`` is what the source system does."""
    audio = spotify_items(bronze_spotify, newest)
    video = youtube_items(bronze_youtube, newest)
    return Silver(
        artist=artists(audio, keep),
        album=albums(audio, keep),
        album_artist=album_artists(audio),
        track=tracks(audio, keep),
        track_artist=track_artists(audio, keep),
        channel=channels(video, keep),
        video=videos(video, keep),
    )
