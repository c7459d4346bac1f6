"""Linking the two platforms: which track and which video is which song.

One row is one song and one track, or one song and one video, never both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.functions import is_blank, natural_key, normalize, song_id
from lodestrata.operators.containment import contains_match
from lodestrata.operators.identity import same_by_code
from lodestrata.session import stage

# Method names and their confidence.
DIRECT, MATCHED, BY_ISRC, MANUAL = "direct_spotify", "title_artist_fuzzy", "isrc", "manual"
CONFIDENCE = {DIRECT: 1.0, MATCHED: 0.8, BY_ISRC: 1.0, MANUAL: 1.0}


def primary_artist_inner(
    track: DataFrame, track_artist: DataFrame, artist: DataFrame
) -> DataFrame:
    """Tracks with their primary artist; a track without one is left out."""
    primary = track_artist.filter("is_primary").select("track_id", "artist_id")
    return (
        track.join(primary, "track_id")
        .join(artist.select("artist_id", "artist_name"), "artist_id")
        .select("track_id", "track_name", "isrc_code", "artist_name")
        .distinct()
    )


def primary_artist_left(
    track: DataFrame, track_artist: DataFrame, artist: DataFrame, also: Sequence[str] = ()
) -> DataFrame:
    """Every track once, with the name of its first primary artist or ''; with further columns of it."""
    first = (
        track_artist.filter("is_primary")
        .groupBy("track_id")
        .agg(F.min("artist_id").alias("artist_id"))
    )
    # Written before the tracks are chosen, so that the shuffles of the two do not lie on disk together.
    first = stage(first, "first_artists")
    named = first.join(artist.select("artist_id", "artist_name"), "artist_id").drop("artist_id")
    return track.join(named, "track_id", "left").select(
        "track_id",
        "track_name",
        "isrc_code",
        *also,
        F.coalesce("artist_name", F.lit("")).alias("artist_name"),
    )


def song_tracks(named_tracks: DataFrame) -> DataFrame:
    """Tracks with the song they belong to."""
    normalized = named_tracks.withColumns(
        {
            "song_title_normalized": normalize("track_name"),
            "artist_name_normalized": normalize("artist_name"),
        }
    )
    return normalized.withColumn(
        "song_id", song_id("song_title_normalized", "artist_name_normalized")
    )


SONG = ["song_id", "song_title_normalized", "artist_name_normalized"]


def matchable_videos(video: DataFrame, channel: DataFrame | None = None) -> DataFrame:
    """Videos in matching form. With ``channel``, only those of a known channel."""
    columns = ["video_id", "title", "channel_id", "view_count"]
    rows = video.select(*columns)
    if channel is not None:
        rows = rows.join(channel.select("channel_id").distinct(), "channel_id", "left_semi")
    return rows.select(*columns, normalize("title").alias("title_normalized"))


def videos_with_channel(video: DataFrame, channel: DataFrame) -> DataFrame:
    """Videos with the name of their channel; those of no known channel are left out."""
    names = channel.select("channel_id", "channel_name")
    rows = video.select("video_id", "title", "channel_id", "view_count").join(names, "channel_id")
    return rows.distinct()


def match_videos(
    songs: DataFrame, videos: DataFrame, allow_empty: bool = False, strategy: str = "auto"
) -> DataFrame:
    """(song, video) pairs: title and artist both occur in the video's title.

    Songs, not tracks, are the needles, so a song with many tracks is compared
    once.
    """
    return contains_match(
        songs.select(*SONG),
        videos,
        parts=["song_title_normalized", "artist_name_normalized"],
        text="title_normalized",
        allow_empty=allow_empty,
        strategy=strategy,
    )


def _audited(rows: DataFrame, method: str, as_of) -> DataFrame:
    stamped = rows.withColumns(
        {
            "match_confidence": F.lit(CONFIDENCE[method]),
            "match_method": F.lit(method),
            "created_at": as_of,
            "updated_at": as_of,
        }
    )
    return schemas.conform(stamped, "silver_song_mapping")


def _keyed(mapping: DataFrame) -> DataFrame:
    key = natural_key("song_id", "spotify_track_id", "youtube_video_id", "match_method")
    return mapping.withColumn("mapping_id", key)


def _direct_rows(tracks: DataFrame) -> DataFrame:
    return tracks.select(
        *SONG,
        F.col("track_id").alias("spotify_track_id"),
        F.col("isrc_code").alias("spotify_isrc_code"),
        F.col("track_name").alias("spotify_track_name"),
        F.lit(0).cast("bigint").alias("youtube_view_count"),
    )


def isrc_links(tracks: DataFrame) -> DataFrame:
    """Tracks of songs that share an ISRC, directly or through others, under one song.

    The lowest song_id that is reachable over shared codes stands for all of them.
    """
    coded = tracks.filter(~is_blank("isrc_code"))
    same = same_by_code(coded, "song_id", "isrc_code").filter("song_id <> least")
    names = coded.groupBy(F.col("song_id").alias("least")).agg(F.min(F.struct(*SONG)).alias("_song"))
    moved = coded.join(same, "song_id").join(names, "least")
    return _direct_rows(moved.drop(*SONG).select("*", "_song.*"))


def track_copies(mapping: DataFrame) -> DataFrame:
    """(song_id, youtube_video_id, copies): how often a match stands in the source system.

    That writes a match once per track of the song; here the tracks are counted.
    """
    direct = F.col("match_method") == DIRECT
    tracks = mapping.filter(direct).groupBy("song_id").agg(F.count("*").alias("copies"))
    matched = mapping.filter(~direct & F.col("youtube_video_id").isNotNull())
    return matched.join(tracks, "song_id").select("song_id", "youtube_video_id", "copies")


def song_mapping(
    tracks: DataFrame,
    videos: DataFrame,
    as_of,
    allow_empty: bool = False,
    strategy: str = "auto",
    isrc: bool = False,
    manual: DataFrame | None = None,
) -> DataFrame:
    """The mapping table.

    ``tracks`` comes from :func:`song_tracks`, ``videos`` from
    :func:`matchable_videos`. A (song, video) pair is one row; the source system
    repeats it for every track of the song, see :func:`track_copies`.
    ``isrc`` adds links by shared ISRC, ``manual`` rows of a hand-made table.
    """
    # Read as needles, as direct rows and by the options below: computed once.
    tracks = stage(tracks, "song_tracks")
    pairs = match_videos(tracks, videos, allow_empty, strategy)
    return assemble(tracks, pairs, as_of, isrc, manual)


def assemble(
    tracks: DataFrame, pairs: DataFrame, as_of, isrc: bool = False, manual: DataFrame | None = None
) -> DataFrame:
    """The mapping table of tracks and of the (song, video) pairs found."""
    matched = pairs.select(
        *SONG,
        F.col("video_id").alias("youtube_video_id"),
        F.col("title").alias("youtube_video_title"),
        F.col("channel_id").alias("youtube_channel_id"),
        F.col("view_count").alias("youtube_view_count"),
    )
    mapping = _audited(_direct_rows(tracks), DIRECT, as_of).unionByName(
        _audited(matched, MATCHED, as_of)
    )
    if isrc:
        mapping = mapping.unionByName(_audited(isrc_links(tracks), BY_ISRC, as_of))
    if manual is not None:
        mapping = mapping.unionByName(_audited(manual, MANUAL, as_of))
    return schemas.conform(_keyed(mapping), "silver_song_mapping")
