"""Table and document schemas.

Table schemas are the union of the relational and the warehouse column sets,
written as DDL so that the same text serves readers, ``from_json`` and
``CREATE TABLE``. Nothing is ever inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Documents -----------------------------------------------------------------

ARTIST_DOC = (
    "STRUCT<id STRING, name STRING, uri STRING, href STRING, type STRING,"
    " external_urls STRUCT<spotify STRING>>"
)
ALBUM_DOC = (
    "STRUCT<id STRING, name STRING, album_type STRING, release_date STRING,"
    " release_date_precision STRING, total_tracks INT, uri STRING, href STRING,"
    " type STRING, is_playable BOOLEAN, external_urls STRUCT<spotify STRING>,"
    f" artists ARRAY<{ARTIST_DOC}>,"
    " images ARRAY<STRUCT<height INT, width INT, url STRING>>>"
)
_TRACK_FIELDS = (
    "id STRING, name STRING, uri STRING, href STRING, type STRING,"
    " disc_number INT, track_number INT, duration_ms INT, explicit BOOLEAN,"
    " is_local BOOLEAN, is_playable BOOLEAN, external_ids STRUCT<isrc STRING>,"
    " external_urls STRUCT<spotify STRING>, song_code STRING"
)
TRACK_DOC = f"STRUCT<{_TRACK_FIELDS}, artists ARRAY<{ARTIST_DOC}>, album {ALBUM_DOC}>"
# Parts of a track document for readers that need no more: what is not declared is not parsed.
TRACK_ONLY_DOC = f"STRUCT<{_TRACK_FIELDS}, album STRUCT<id STRING>>"
ARTISTS_DOC = f"STRUCT<artists ARRAY<{ARTIST_DOC}>>"
ALBUM_ONLY_DOC = f"STRUCT<album {ALBUM_DOC}>"
TRACK_ARTIST_DOC = "STRUCT<id STRING, artists ARRAY<STRUCT<id STRING>>>"
ALBUM_ARTIST_DOC = "STRUCT<album STRUCT<id STRING, artists ARRAY<STRUCT<id STRING>>>>"
MAPPING_DOC = (
    "STRUCT<id STRING, name STRING, external_ids STRUCT<isrc STRING>,"
    " artists ARRAY<STRUCT<id STRING, name STRING>>>"
)
GOLD_DOC = (
    "STRUCT<id STRING, name STRING, external_ids STRUCT<isrc STRING>, song_code STRING,"
    " artists ARRAY<STRUCT<id STRING, name STRING, external_urls STRUCT<spotify STRING>>>,"
    " album STRUCT<id STRING, name STRING, album_type STRING, release_date STRING,"
    " release_date_precision STRING, total_tracks INT, artists ARRAY<STRUCT<id STRING>>,"
    " images ARRAY<STRUCT<url STRING>>>>"
)
VIDEO_DOC = (
    "STRUCT<id STRUCT<videoId STRING>, videoId STRING,"
    " snippet STRUCT<title STRING, channelTitle STRING, channelId STRING,"
    " publishedAt STRING, thumbnails STRUCT<default STRUCT<url STRING>>,"
    " artist STRING, song_name STRING, song_code STRING, original_artist STRING,"
    " song_writers STRING, recordings_title STRING>,"
    " statistics STRUCT<viewCount STRING>, contentDetails STRUCT<duration STRING>>"
)

# `items` is an object in some responses and an array in others. Declared as
# STRING it arrives as its own JSON text, which operators.documents unpacks.
AUDIO_RESPONSE = (
    "STRUCT<tracks STRUCT<href STRING, limit INT, next STRING, offset INT,"
    " previous STRING, total INT, items STRING>>"
)
VIDEO_RESPONSE = "STRUCT<items STRING>"

_RUNS = "STRUCT<runs ARRAY<STRUCT<text STRING>>>"
_SIMPLE = "STRUCT<simpleText STRING>"
VIDEO_RENDERER = (
    f"STRUCT<videoId STRING, title {_RUNS},"
    " ownerText STRUCT<runs ARRAY<STRUCT<text STRING, navigationEndpoint"
    " STRUCT<browseEndpoint STRUCT<browseId STRING>>>>>,"
    " thumbnail STRUCT<thumbnails ARRAY<STRUCT<url STRING>>>,"
    f" publishedTimeText {_SIMPLE}, viewCountText {_SIMPLE}, lengthText {_SIMPLE}>"
)
CHANNEL_RENDERER = f"STRUCT<channelId STRING, title {_SIMPLE}>"
_WRAPPED = f"STRUCT<content STRUCT<videoRenderer {VIDEO_RENDERER}>>"
_ENTRY = (
    f"STRUCT<videoRenderer {VIDEO_RENDERER}, channelRenderer {CHANNEL_RENDERER},"
    f" richItemRenderer {_WRAPPED}>"
)
_SECTION = (
    f"STRUCT<itemSectionRenderer STRUCT<contents ARRAY<{_ENTRY}>>,"
    f" richItemRenderer STRUCT<content {_ENTRY}>>"
)
SEARCH_PAGE = (
    "STRUCT<contents STRUCT<twoColumnSearchResultsRenderer STRUCT<primaryContents"
    f" STRUCT<sectionListRenderer STRUCT<contents ARRAY<{_SECTION}>>,"
    f" richGridRenderer STRUCT<contents ARRAY<{_SECTION}>>>>>,"
    " metadata STRUCT<channelMetadataRenderer STRUCT<externalId STRING>>>"
)

# Tables --------------------------------------------------------------------

TABLES: dict[str, str] = {
    "bronze_spotify_raw": """
        raw_id STRING, batch_id STRING, search_query STRING, search_offset INT,
        search_limit INT, search_total INT, search_href STRING, search_next STRING,
        raw_json STRING, ingested_at TIMESTAMP_NTZ, source STRING""",
    "bronze_youtube_raw": """
        raw_id STRING, batch_id STRING, search_query STRING, video_id STRING,
        raw_json STRING, ingested_at TIMESTAMP_NTZ, source STRING""",
    "silver_spotify_artist": """
        artist_id STRING, artist_name STRING, artist_uri STRING, artist_href STRING,
        spotify_url STRING, ingested_at TIMESTAMP_NTZ, deduplicated_at TIMESTAMP_NTZ""",
    "silver_spotify_album": """
        album_id STRING, album_name STRING, album_type STRING, release_date DATE,
        release_date_precision STRING, total_tracks INT, album_uri STRING,
        album_href STRING, spotify_url STRING, is_playable BOOLEAN, image_url STRING,
        ingested_at TIMESTAMP_NTZ""",
    "silver_spotify_album_artist": "album_id STRING, artist_id STRING",
    "silver_spotify_track": """
        track_id STRING, track_name STRING, isrc_code STRING, album_id STRING,
        disc_number INT, track_number INT, duration_ms INT, explicit BOOLEAN,
        is_local BOOLEAN, is_playable BOOLEAN, track_uri STRING, track_href STRING,
        spotify_url STRING, song_code STRING, ingested_at TIMESTAMP_NTZ""",
    "silver_spotify_track_artist": "track_id STRING, artist_id STRING, is_primary BOOLEAN",
    "silver_youtube_channel": """
        channel_id STRING, channel_name STRING, ingested_at TIMESTAMP_NTZ,
        first_seen_at TIMESTAMP_NTZ""",
    "silver_youtube_video": """
        video_id STRING, channel_id STRING, title STRING, title_artist_name STRING,
        title_song_name STRING, published_at_raw STRING,
        published_at_parsed TIMESTAMP_NTZ, duration_raw STRING, duration_seconds INT,
        view_count BIGINT, thumbnail_url STRING, song_code STRING,
        original_artist STRING, song_writers STRING, recordings_title STRING,
        ingested_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "silver_song_mapping": """
        mapping_id STRING, song_id STRING, song_title_normalized STRING,
        artist_name_normalized STRING, spotify_track_id STRING,
        spotify_isrc_code STRING, spotify_track_name STRING, youtube_video_id STRING,
        youtube_video_title STRING, youtube_channel_id STRING,
        youtube_view_count BIGINT, match_confidence DECIMAL(3,2), match_method STRING,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "silver_data_quality_log": """
        check_id STRING, table_name STRING, check_type STRING, status STRING,
        affected_rows BIGINT, details STRING, checked_at TIMESTAMP_NTZ""",
    "silver_ingestion_log": """
        log_id STRING, batch_id STRING, source STRING, status STRING, records_raw BIGINT,
        records_silver BIGINT, records_rejected BIGINT, error_message STRING,
        started_at TIMESTAMP_NTZ, finished_at TIMESTAMP_NTZ, duration_seconds BIGINT""",
    "gold_dim_song": """
        song_id STRING, song_title STRING, artist_name STRING, album_name STRING,
        release_date STRING, cover_image_url STRING, song_code STRING,
        original_artist STRING, song_writers STRING, recordings_title STRING,
        isrc_list STRING, youtube_video_count BIGINT, spotify_isrc_count BIGINT,
        has_spotify BOOLEAN, has_youtube BOOLEAN, total_youtube_views BIGINT,
        total_spotify_tracks BIGINT, unique_youtube_channels BIGINT,
        total_platforms INT, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "gold_dim_artist": """
        artist_id STRING, artist_name STRING, spotify_url STRING,
        youtube_channel_id STRING, youtube_channel_name STRING, total_songs BIGINT,
        total_youtube_videos BIGINT, total_youtube_views BIGINT""",
    "gold_dim_album": """
        album_id STRING, album_name STRING, album_type STRING, release_date STRING,
        total_tracks INT, cover_image_url STRING, artist_name STRING,
        songs_with_youtube BIGINT, total_youtube_views BIGINT""",
    "gold_dim_date": """
        date_id DATE, year INT, quarter INT, month INT, month_name STRING,
        week_of_year INT, day_of_week INT, day_name STRING, is_weekend BOOLEAN""",
    "gold_fact_song_daily_snapshot": """
        snapshot_id STRING, song_id STRING, date_id DATE, youtube_video_count BIGINT,
        spotify_isrc_count BIGINT, total_youtube_views BIGINT,
        unique_youtube_channels BIGINT, youtube_video_count_change BIGINT,
        spotify_isrc_count_change BIGINT, youtube_views_change BIGINT,
        captured_at TIMESTAMP_NTZ""",
    "gold_fact_ingestion_summary": """
        summary_id STRING, date_id DATE, source STRING, total_raw_records BIGINT,
        total_silver_records BIGINT, total_rejected BIGINT,
        success_rate_pct DECIMAL(12,2), avg_ingestion_duration_seconds INT,
        total_checks_run BIGINT, checks_passed BIGINT, checks_failed BIGINT,
        last_updated_at TIMESTAMP_NTZ""",
}

# Declared keys, checked by operators.quality rather than enforced.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "bronze_spotify_raw": ("raw_id",),
    "bronze_youtube_raw": ("raw_id",),
    "silver_spotify_artist": ("artist_id",),
    "silver_spotify_album": ("album_id",),
    "silver_spotify_album_artist": ("album_id", "artist_id"),
    "silver_spotify_track": ("track_id",),
    "silver_spotify_track_artist": ("track_id", "artist_id"),
    "silver_youtube_channel": ("channel_id",),
    "silver_youtube_video": ("video_id",),
    "silver_song_mapping": ("mapping_id",),
    "gold_dim_song": ("song_id",),
    "gold_dim_artist": ("artist_id",),
    "gold_dim_album": ("album_id",),
    "gold_dim_date": ("date_id",),
    "gold_fact_song_daily_snapshot": ("song_id", "date_id"),
    "gold_fact_ingestion_summary": ("date_id", "source"),
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("silver_spotify_album_artist", "album_id", "silver_spotify_album", "album_id"),
    ("silver_spotify_album_artist", "artist_id", "silver_spotify_artist", "artist_id"),
    ("silver_spotify_track", "album_id", "silver_spotify_album", "album_id"),
    ("silver_spotify_track_artist", "track_id", "silver_spotify_track", "track_id"),
    ("silver_spotify_track_artist", "artist_id", "silver_spotify_artist", "artist_id"),
    ("silver_youtube_video", "channel_id", "silver_youtube_channel", "channel_id"),
    ("silver_song_mapping", "spotify_track_id", "silver_spotify_track", "track_id"),
    ("silver_song_mapping", "youtube_video_id", "silver_youtube_video", "video_id"),
    ("silver_song_mapping", "youtube_channel_id", "silver_youtube_channel", "channel_id"),
)

# Days a layer is kept; None is forever.
RETENTION_DAYS: dict[str, int | None] = {"bronze": 30, "silver": 90, "gold": None}

# Declared lengths of text columns. A longer text cannot be stored as it is.
TEXT_LIMITS: dict[str, dict[str, int]] = {
    "silver_spotify_artist": {"artist_id": 64, "artist_name": 512, "artist_uri": 256},
    "silver_spotify_album": {"album_id": 64, "album_name": 512, "album_type": 32, "image_url": 1024},
    "silver_spotify_track": {"track_id": 64, "track_name": 512, "isrc_code": 32, "track_uri": 256},
    "silver_youtube_channel": {"channel_id": 64, "channel_name": 512},
    "silver_youtube_video": {"video_id": 32, "title": 1024, "duration_raw": 16, "thumbnail_url": 1024},
}

# Entities whose rows are refreshed in place, and the columns an update replaces.
UPDATED_COLUMNS: dict[str, tuple[str, ...]] = {
    "silver_spotify_artist": ("artist_name",),
    "silver_spotify_album": ("album_name",),
    "silver_spotify_track": ("isrc_code", "track_name"),
    "silver_youtube_channel": ("channel_name",),
    "silver_youtube_video": ("view_count", "updated_at"),
}


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Columns of a table in declared order and type; absent ones become null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table_schema(name).fields
        ]
    )
