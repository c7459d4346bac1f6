"""Gold: dimensions and facts.

The default tables count every video of a song once. ``faithful`` variants keep
the source system's figures, which sum after joining all tracks of a song with
all its videos. They are computed from per-side totals: the sum over such a
product is the row count of one side times the sum of the other, so the product
itself is never formed.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lodestrata import schemas
from lodestrata.functions import blank_to_null, is_blank, natural_key, success_rate

SONG_NAMES = ["song_title_normalized", "artist_name_normalized"]


def joined_distinct(value: Column | str, separator: str = ", ") -> Column:
    """Aggregate: distinct values, sorted and joined; null over no values.

    Sets are built on the map side already. (``listagg distinct`` with an order
    cannot stand next to other distinct aggregates in this Spark version.)
    """
    c = F.col(value) if isinstance(value, str) else value
    return F.when(F.count(c) > 0, F.array_join(F.array_sort(F.collect_set(c)), separator))


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("bigint")


def presence(rows: DataFrame, owner: str, flags: dict[str, Column]) -> DataFrame:
    """Per owner whether any row has each flag, and `kinds`, how many flags it has."""
    found = rows.groupBy(owner).agg(
        *[F.coalesce(F.bool_or(flag), F.lit(False)).alias(name) for name, flag in flags.items()]
    )
    kinds = reduce(add, [F.col(name).cast("int") for name in flags])
    return found.withColumn("kinds", kinds)


def song_videos(mapping: DataFrame) -> DataFrame:
    """Distinct (song, video) pairs with the video's channel and views.

    Grouping by the pair spreads a song with very many videos over all tasks.
    """
    return (
        mapping.filter(F.col("youtube_video_id").isNotNull())
        .groupBy("song_id", "youtube_video_id")
        .agg(
            F.max("youtube_channel_id").alias("youtube_channel_id"),
            F.max("youtube_view_count").alias("youtube_view_count"),
            *[F.max(c).alias(c) for c in SONG_NAMES],
        )
    )


def song_isrcs(mapping: DataFrame) -> DataFrame:
    """(song_id, isrc): one row a code, for songs with more codes than a cell should hold."""
    rows = mapping.select("song_id", F.col("spotify_isrc_code").alias("isrc"))
    return rows.filter(~is_blank("isrc")).distinct()


def _track_side(
    mapping: DataFrame,
    track: DataFrame,
    album: DataFrame,
    count_empty_isrc: bool,
    isrc_list: bool = True,
) -> DataFrame:
    """Per song: what its tracks and their albums say.

    The rows are made distinct by (song, track) grouping, which spreads a song
    with very many tracks over all tasks. They are dealt by track alone, once for the
    grouping and the join.
    """
    isrc = F.col("spotify_isrc_code") if count_empty_isrc else blank_to_null("spotify_isrc_code")
    rows = (
        mapping.filter(F.col("spotify_track_id").isNotNull())
        .select(F.col("spotify_track_id").alias("track_id"), "song_id", *SONG_NAMES, isrc.alias("isrc"))
        .repartition("track_id")
        .groupBy("track_id", "song_id")
        .agg(*[F.max(c).alias(c) for c in SONG_NAMES], F.max("isrc").alias("isrc"))
    )
    releases = track.select("track_id", "album_id", "song_code").join(
        album.select("album_id", "album_name", "release_date", "image_url"), "album_id", "left"
    )
    codes = F.size(F.collect_set("isrc")) if isrc_list else F.countDistinct("isrc")
    return (
        rows.join(releases, "track_id", "left")
        .groupBy("song_id")
        .agg(
            *[F.max(c).alias(c) for c in SONG_NAMES],
            F.max("album_name").alias("album_name"),
            F.max("release_date").alias("release_date"),
            F.max("image_url").alias("image_url"),
            F.max("song_code").alias("track_song_code"),
            (joined_distinct("isrc") if isrc_list else F.lit(None).cast("string")).alias("isrc_list"),
            codes.alias("isrcs"),
            F.count("*").alias("tracks"),
        )
    )


def _video_side(pairs: DataFrame, video: DataFrame) -> DataFrame:
    """Per song: what its videos say."""
    facts = video.select(
        F.col("video_id").alias("youtube_video_id"), "song_code", "song_writers", "recordings_title"
    )
    joined = pairs.join(facts, "youtube_video_id", "left")
    return joined.groupBy("song_id").agg(
        *[F.max(c).alias(f"video_{c}") for c in SONG_NAMES],
        F.max("song_code").alias("video_song_code"),
        F.max("song_writers").alias("song_writers"),
        F.max("recordings_title").alias("recordings_title"),
        F.count("*").alias("videos"),
        F.countDistinct("youtube_channel_id").alias("channels"),
        F.sum("youtube_view_count").alias("views"),
    )


def dim_song(
    mapping: DataFrame,
    track: DataFrame,
    album: DataFrame,
    video: DataFrame,
    as_of: Column,
    faithful: bool = False,
    count_empty_isrc: bool = False,
    isrc_list: bool = True,
) -> DataFrame:
    """One row per song of the mapping: how many videos, how many ISRCs.

    Both sides are reduced to one row per song before they meet, so the join
    neither fans out nor skews, and it reuses the grouping's partitioning.
    ``faithful`` starts from the track side only and multiplies views by the
    song's tracks. ``isrc_list=False`` leaves the list of codes null, for data
    where one song may have more codes than fit a cell; the count is exact
    either way.
    """
    tracks = _track_side(mapping, track, album, count_empty_isrc, isrc_list)
    videos = _video_side(song_videos(mapping), video)
    joined = tracks.join(videos, "song_id", "left" if faithful else "full_outer")
    views = F.col("views") * F.col("tracks") if faithful else F.col("views")
    has_a, has_b = F.col("tracks") > 0, F.col("videos") > 0
    has_a, has_b = F.coalesce(has_a, F.lit(False)), F.coalesce(has_b, F.lit(False))
    title = F.coalesce("song_title_normalized", "video_song_title_normalized")
    artist = F.coalesce("artist_name_normalized", "video_artist_name_normalized")
    rows = joined.select(
        "song_id",
        title.alias("song_title"),
        artist.alias("artist_name"),
        F.coalesce("album_name", F.lit("")).alias("album_name"),
        F.col("release_date").cast("string").alias("release_date"),
        F.coalesce("image_url", F.lit("")).alias("cover_image_url"),
        F.coalesce(
            blank_to_null("video_song_code"), blank_to_null("track_song_code"), F.lit("")
        ).alias("song_code"),
        artist.alias("original_artist"),
        F.coalesce("song_writers", F.lit("")).alias("song_writers"),
        F.coalesce("recordings_title", F.lit("")).alias("recordings_title"),
        "isrc_list",
        _zero(F.col("videos")).alias("youtube_video_count"),
        _zero(F.col("isrcs")).alias("spotify_isrc_count"),
        has_a.alias("has_spotify"),
        has_b.alias("has_youtube"),
        _zero(views).alias("total_youtube_views"),
        _zero(F.col("tracks")).alias("total_spotify_tracks"),
        _zero(F.col("channels")).alias("unique_youtube_channels"),
        (has_a.cast("int") + has_b.cast("int")).alias("total_platforms"),
        as_of.alias("created_at"),
        as_of.alias("updated_at"),
    )
    return schemas.conform(rows, "gold_dim_song")


def _artist_songs(track_artist: DataFrame, mapping: DataFrame) -> DataFrame:
    direct = mapping.filter(F.col("spotify_track_id").isNotNull()).select(
        "song_id", F.col("spotify_track_id").alias("track_id")
    )
    return (
        track_artist.select("artist_id", "track_id")
        .join(direct, "track_id")
        .select("artist_id", "song_id")
        .distinct()
    )


def _video_classes(pairs: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Videos of the very same songs as one class: a row per class and song.

    `less` is what a song's row of a video says below the video's most views, the same for all
    videos of a class; so are the columns of ``by``. One of the videos names the class.
    """
    rows = pairs.groupBy("youtube_video_id").agg(
        F.max("youtube_view_count").alias("most"),
        F.collect_list(F.struct("song_id", "youtube_view_count", *by)).alias("rows"),
    )
    songs = F.transform(
        "rows",
        lambda r: F.struct(
            r["song_id"].alias("song_id"),
            (r["youtube_view_count"] - F.col("most")).alias("less"),
            *[r[c].alias(c) for c in by],
        ),
    )
    classes = rows.groupBy(F.array_sort(songs).alias("songs")).agg(
        F.min("youtube_video_id").alias("class"),
        F.count("*").alias("videos"),
        F.count("most").alias("viewed"),
        F.sum("most").alias("most"),
    )
    return classes.select("class", "videos", "viewed", "most", F.inline("songs"))


def _class_totals(
    owner_songs: DataFrame, owner: str, pairs: DataFrame, by: tuple[str, ...] = ()
) -> DataFrame:
    """Per owner, and by further columns of its videos: distinct videos and their views.

    A video of two songs of one owner counts once, with the most views and the greatest values that
    its rows give. Owners meet classes of videos, not videos: (owner, video) rows would be
    the product of a song's owners and its videos.
    """
    met = owner_songs.join(_video_classes(pairs, by), "song_id").groupBy(owner, "class").agg(
        *[F.max(c).alias(c) for c in ("videos", "viewed", "most", "less", *by)]
    )
    return met.groupBy(owner, *by).agg(
        F.sum("videos").alias("videos"),
        F.sum(F.col("most") + F.col("viewed") * F.col("less")).alias("views"),
    )


def _video_totals(owner_songs: DataFrame, owner: str, pairs: DataFrame) -> DataFrame:
    """Per owner (artist or album): songs, distinct videos and their views."""
    videos = _class_totals(owner_songs, owner, pairs)
    songs = owner_songs.groupBy(owner).agg(F.count("*").alias("songs"))
    return songs.join(videos, owner, "left")


def _direct_totals(owner_tracks: DataFrame, owner: str, mapping: DataFrame) -> DataFrame:
    """The source system's totals: mapping rows reached through the track id.

    Those rows carry no video, so videos and views come out as zero.
    """
    rows = owner_tracks.join(
        mapping.select(
            "song_id",
            F.col("spotify_track_id").alias("track_id"),
            "youtube_video_id",
            "youtube_view_count",
        ),
        "track_id",
    )
    return rows.groupBy(owner).agg(
        F.countDistinct("song_id").alias("songs"),
        F.countDistinct("youtube_video_id").alias("videos"),
        F.sum("youtube_view_count").alias("views"),
    )


def dim_artist(
    artist: DataFrame,
    track_artist: DataFrame,
    channel: DataFrame,
    mapping: DataFrame,
    faithful: bool = False,
) -> DataFrame:
    """Artists with their songs, videos and views; channel matched by name.

    Two channels of the same name give two rows.
    """
    if faithful:
        totals = _direct_totals(track_artist.select("artist_id", "track_id"), "artist_id", mapping)
    else:
        owned = _artist_songs(track_artist, mapping)
        totals = _video_totals(owned, "artist_id", song_videos(mapping))

    def name(column: str) -> Column:
        # An empty name is no name: it would pair every nameless artist with
        # every nameless channel.
        lowered = F.lower(column)
        return (lowered if faithful else blank_to_null(lowered)).alias("_name")

    named = channel.select(
        F.col("channel_id").alias("youtube_channel_id"),
        F.col("channel_name").alias("youtube_channel_name"),
        name("channel_name"),
    )
    rows = (
        artist.join(totals, "artist_id", "left")
        .withColumn("_name", name("artist_name"))
        .join(named, "_name", "left")
        .withColumns(
            {
                "total_songs": _zero(F.col("songs")),
                "total_youtube_videos": _zero(F.col("videos")),
                "total_youtube_views": _zero(F.col("views")),
            }
        )
    )
    return schemas.conform(rows, "gold_dim_artist")


def dim_artist_by_mapping(
    artist: DataFrame,
    track_artist: DataFrame,
    channel: DataFrame,
    mapping: DataFrame,
    songs: DataFrame,
) -> DataFrame:
    """Artists per channel their songs' videos appear on.

    One row per (artist, channel); an artist without videos keeps one row with
    no channel. ``total_songs`` counts songs by the artist's exact name.
    """
    by_name = songs.groupBy("artist_name").agg(F.countDistinct("song_id").alias("total_songs"))
    totals = _class_totals(
        _artist_songs(track_artist, mapping), "artist_id", song_videos(mapping), ("youtube_channel_id",)
    ).withColumnsRenamed(
        {"youtube_channel_id": "channel_id", "videos": "total_youtube_videos", "views": "total_youtube_views"}
    )
    rows = (
        artist.join(totals, "artist_id", "left")
        .join(channel.select("channel_id", "channel_name"), "channel_id", "left")
        .join(by_name, "artist_name", "left")
        .withColumns(
            {
                "youtube_channel_id": F.col("channel_id"),
                "youtube_channel_name": F.col("channel_name"),
                "total_songs": _zero(F.col("total_songs")),
                "total_youtube_videos": _zero(F.col("total_youtube_videos")),
                "total_youtube_views": _zero(F.col("total_youtube_views")),
            }
        )
    )
    return schemas.conform(rows, "gold_dim_artist")


def dim_album(
    album: DataFrame,
    album_artist: DataFrame,
    artist: DataFrame,
    track: DataFrame,
    mapping: DataFrame,
    faithful: bool = False,
    per_artist: bool = False,
) -> DataFrame:
    """Albums with artist and video metrics.

    ``per_artist`` gives one row per album artist instead of the greatest name.
    ``faithful`` reaches videos through the track id, which finds none.
    """
    if faithful:
        totals = _direct_totals(track.select("album_id", "track_id"), "album_id", mapping)
    else:
        direct = mapping.filter(F.col("spotify_track_id").isNotNull()).select(
            "song_id", F.col("spotify_track_id").alias("track_id")
        )
        owned = (
            track.filter(~is_blank("album_id"))
            .select("album_id", "track_id")
            .join(direct, "track_id")
            .select("album_id", "song_id")
            .distinct()
        )
        totals = _video_totals(owned, "album_id", song_videos(mapping))
    names = album_artist.join(artist.select("artist_id", "artist_name"), "artist_id", "left")
    if per_artist:
        names = names.select("album_id", "artist_name").distinct()
    else:
        names = names.groupBy("album_id").agg(F.max("artist_name").alias("artist_name"))
    rows = (
        album.join(names, "album_id", "left")
        .join(totals, "album_id", "left")
        .withColumns(
            {
                "cover_image_url": F.col("image_url"),
                "songs_with_youtube": _zero(F.col("videos")),
                "total_youtube_views": _zero(F.col("views")),
            }
        )
    )
    return schemas.conform(rows, "gold_dim_album")


def dim_date(spark, base: str, back: int = 90, ahead: int = 30) -> DataFrame:
    """Calendar around a base date (``yyyy-MM-dd``), 121 days by default."""
    day = F.to_date(F.lit(base))
    days = spark.range(1).select(
        F.explode(F.sequence(F.date_sub(day, back), F.date_add(day, ahead))).alias("date_id")
    )
    return calendar(days)


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of a column of dates."""
    d = F.col("date_id")
    weekday = F.weekday(d) + 1
    rows = days.select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
    )
    return schemas.conform(rows, "gold_dim_date")


_METRICS = {
    "youtube_video_count": "youtube_video_count_change",
    "spotify_isrc_count": "spotify_isrc_count_change",
    "total_youtube_views": "youtube_views_change",
}


def song_daily_snapshot(songs: DataFrame, date_id: Column, captured_at: Column) -> DataFrame:
    """Today's metrics per song; the changes start at 0, see :func:`snapshot_change`."""
    stamped = songs.withColumns(
        {
            "date_id": date_id,
            "snapshot_id": natural_key("song_id", date_id),
            "captured_at": captured_at,
            **{change: F.lit(0) for change in _METRICS.values()},
        }
    )
    return schemas.conform(stamped, "gold_fact_song_daily_snapshot")


def snapshot_change(snapshots: DataFrame) -> DataFrame:
    """Fill the change columns from the day before.

    A song's first day, and a day after a gap, has change 0: only the snapshot
    of exactly one day earlier counts. Written as a self equi-join on
    (song, day), so a song with a long history is spread over tasks.
    """
    before = snapshots.select(
        "song_id",
        F.date_add("date_id", 1).alias("date_id"),
        *[F.col(m).alias(f"_{m}") for m in _METRICS],
    )
    joined = snapshots.join(before, ["song_id", "date_id"], "left")
    changes = {
        change: F.coalesce(F.col(m) - F.col(f"_{m}"), F.lit(0)).cast("bigint")
        for m, change in _METRICS.items()
    }
    return schemas.conform(joined.withColumns(changes), "gold_fact_song_daily_snapshot")


def snapshot_change_window(snapshots: DataFrame) -> DataFrame:
    """The same with ``lag``: one shuffle instead of two, a song per task."""
    w = Window.partitionBy("song_id").orderBy("date_id")
    consecutive = F.lag("date_id").over(w) == F.date_sub("date_id", 1)
    changes = {
        change: F.when(consecutive, F.col(m) - F.lag(m).over(w)).otherwise(F.lit(0)).cast("bigint")
        for m, change in _METRICS.items()
    }
    return schemas.conform(snapshots.withColumns(changes), "gold_fact_song_daily_snapshot")


def ingestion_summary(runs: DataFrame, checks: DataFrame, as_of: Column) -> DataFrame:
    """Per day and source: record sums, success rate and check results.

    Checks name their run by ``batch_id`` inside the JSON details. They are
    reduced per (batch, check) before the join, so a run with many checks does
    not count its records more than once.
    """
    outcome = checks.select(
        F.get_json_object("details", "$.batch_id").alias("batch_id"), "check_id", "status"
    ).filter(F.col("batch_id").isNotNull())
    day = F.to_date("started_at")
    # A check counts once per (day, source), however many of the batch's runs
    # fall into that day.
    batches = runs.select(day.alias("date_id"), "source", "batch_id").distinct()
    distinct_checks = (
        batches.join(outcome, "batch_id")
        .groupBy("date_id", "source", "check_id")
        .agg(
            F.max((F.col("status") == "pass").cast("int")).alias("passed"),
            F.max(F.col("status").isin("fail", "warn").cast("int")).alias("failed"),
        )
    )
    check_totals = distinct_checks.groupBy("date_id", "source").agg(
        F.count("*").alias("total_checks_run"),
        F.sum("passed").alias("checks_passed"),
        F.sum("failed").alias("checks_failed"),
    )
    run_totals = runs.groupBy(day.alias("date_id"), "source").agg(
        F.sum("records_raw").alias("total_raw_records"),
        F.sum("records_silver").alias("total_silver_records"),
        F.sum("records_rejected").alias("total_rejected"),
        F.round(F.avg("duration_seconds")).cast("int").alias("avg_ingestion_duration_seconds"),
    )
    rows = run_totals.join(check_totals, ["date_id", "source"], "left")
    filled = rows.withColumns(
        {
            "summary_id": natural_key("date_id", "source"),
            "success_rate_pct": success_rate("total_silver_records", "total_raw_records"),
            "last_updated_at": as_of,
            **{
                c: _zero(F.col(c))
                for c in (
                    "total_raw_records",
                    "total_silver_records",
                    "total_rejected",
                    "total_checks_run",
                    "checks_passed",
                    "checks_failed",
                )
            },
        }
    )
    return schemas.conform(filled, "gold_fact_ingestion_summary")
