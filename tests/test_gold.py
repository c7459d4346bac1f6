from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.plans import dashboards, gold, mapping

def as_of():
    return F.lit("2024-01-31 08:00:00").cast("timestamp_ntz")


def frame(spark, table, *rows):
    names = [f.name for f in schemas.table_schema(table).fields]
    kinds = {f.name: f.dataType.simpleString() for f in schemas.table_schema(table).fields}
    used = [n for n in names if n in rows[0]]
    ddl = ", ".join(f"{n} {kinds[n]}" for n in used)
    return schemas.conform(spark.createDataFrame([tuple(r[n] for n in used) for r in rows], ddl), table)


@pytest.fixture(scope="module")
def layer(spark):
    track = frame(
        spark,
        "silver_spotify_track",
        *[
            {"track_id": f"t{i}", "track_name": n, "isrc_code": c, "album_id": b, "song_code": s}
            for i, (n, c, b, s) in enumerate(
                [("Love", "I1", "b1", "S1"), ("Love", "I2", "b2", "S2"), ("Love", "", "b1", ""), ("Alone", "I9", "b2", "")]
            )
        ],
    )
    artist = frame(
        spark,
        "silver_spotify_artist",
        {"artist_id": "a1", "artist_name": "Art", "spotify_url": "u"},
        {"artist_id": "a2", "artist_name": "Solo", "spotify_url": "u"},
        {"artist_id": "a3", "artist_name": "Idle", "spotify_url": "u"},
    )
    links = frame(
        spark,
        "silver_spotify_track_artist",
        *[
            {"track_id": t, "artist_id": a, "is_primary": p}
            for t, a, p in [("t0", "a1", True), ("t1", "a1", True), ("t2", "a1", True), ("t0", "a2", False), ("t3", "a2", True)]
        ],
    )
    album = frame(
        spark,
        "silver_spotify_album",
        {"album_id": "b1", "album_name": "One", "release_date": date(2001, 1, 1), "image_url": "x", "album_type": "album", "total_tracks": 3},
        {"album_id": "b2", "album_name": "Two", "release_date": None, "image_url": "", "album_type": "single", "total_tracks": 1},
    )
    album_artist = frame(
        spark,
        "silver_spotify_album_artist",
        {"album_id": "b1", "artist_id": "a1"},
        {"album_id": "b1", "artist_id": "a2"},
        {"album_id": "b2", "artist_id": "a1"},
    )
    channel = frame(
        spark, "silver_youtube_channel", {"channel_id": "c1", "channel_name": "ART"}, {"channel_id": "c2", "channel_name": "art"}
    )
    video = frame(
        spark,
        "silver_youtube_video",
        {"video_id": "v1", "channel_id": "c1", "title": "art love", "view_count": 10, "song_code": "VS", "song_writers": "W"},
        {"video_id": "v2", "channel_id": "c1", "title": "Love, by Art", "view_count": 5, "song_code": "", "song_writers": ""},
        {"video_id": "v3", "channel_id": "", "title": "glove cartel", "view_count": 1, "song_code": "", "song_writers": ""},
    )
    tracks = mapping.song_tracks(mapping.primary_artist_left(track, links, artist))
    link = mapping.song_mapping(tracks, mapping.matchable_videos(video), as_of())
    return dict(track=track, artist=artist, links=links, album=album, album_artist=album_artist, channel=channel, video=video, link=link.cache())


def songs(layer, **options):
    df = gold.dim_song(layer["link"], layer["track"], layer["album"], layer["video"], as_of(), **options)
    return {r.song_title: r for r in df.collect()}


def test_dim_song(layer):
    love = songs(layer)["love"]
    assert (love.youtube_video_count, love.spotify_isrc_count, love.isrc_list) == (3, 2, "I1, I2")
    assert (love.total_youtube_views, love.total_spotify_tracks, love.unique_youtube_channels) == (16, 3, 2)
    assert (love.has_spotify, love.has_youtube, love.total_platforms) == (True, True, 2)
    assert (love.album_name, love.release_date, love.cover_image_url) == ("Two", "2001-01-01", "x")
    assert (love.song_code, love.song_writers) == ("VS", "W")
    alone = songs(layer)["alone"]
    assert (alone.youtube_video_count, alone.total_youtube_views, alone.has_youtube) == (0, 0, False)
    assert (alone.release_date, alone.total_platforms) == (None, 1)


def test_dim_song_faithful_is_the_fan_out(layer, spark):
    love = songs(layer, faithful=True, count_empty_isrc=True)["love"]
    assert (love.total_youtube_views, love.spotify_isrc_count, love.isrc_list) == (16 * 3, 3, ", I1, I2")
    layer["link"].createOrReplaceTempView("link")
    joined = spark.sql(
        """SELECT sum(y.youtube_view_count) AS v FROM link s JOIN link y ON s.song_id = y.song_id
        WHERE s.spotify_track_id IS NOT NULL AND y.youtube_video_id IS NOT NULL
        AND s.song_title_normalized = 'love'"""
    ).first()
    assert joined.v == love.total_youtube_views


def test_isrc_count_without_list(layer):
    love = songs(layer, isrc_list=False)["love"]
    assert (love.spotify_isrc_count, love.isrc_list) == (2, None)


def test_video_only_song(layer):
    only = layer["link"].filter("youtube_video_id is not null")
    rows = gold.dim_song(only, layer["track"], layer["album"], layer["video"], as_of()).collect()
    assert [(r.song_title, r.has_spotify, r.total_platforms) for r in rows] == [("love", False, 1)]
    assert not gold.dim_song(only, layer["track"], layer["album"], layer["video"], as_of(), faithful=True).collect()


def test_dim_artist(layer):
    df = gold.dim_artist(layer["artist"], layer["links"], layer["channel"], layer["link"])
    got = sorted(
        (r.artist_id, r.youtube_channel_id or "", r.total_songs, r.total_youtube_videos, r.total_youtube_views)
        for r in df.collect()
    )
    assert got == [("a1", "c1", 1, 3, 16), ("a1", "c2", 1, 3, 16), ("a2", "", 2, 3, 16), ("a3", "", 0, 0, 0)]
    faithful = gold.dim_artist(layer["artist"], layer["links"], layer["channel"], layer["link"], faithful=True)
    assert {(r.total_songs, r.total_youtube_videos) for r in faithful.filter("artist_id = 'a1'").collect()} == {(1, 0)}


def test_dim_artist_by_mapping(layer):
    dim = gold.dim_song(layer["link"], layer["track"], layer["album"], layer["video"], as_of())
    df = gold.dim_artist_by_mapping(layer["artist"], layer["links"], layer["channel"], layer["link"], dim)
    got = {(r.artist_id, r.youtube_channel_id): r.total_youtube_views for r in df.collect()}
    assert got == {("a1", "c1"): 15, ("a1", ""): 1, ("a2", "c1"): 15, ("a2", ""): 1, ("a3", None): 0}


def test_dim_album(layer):
    args = (layer["album"], layer["album_artist"], layer["artist"], layer["track"], layer["link"])
    got = {r.album_id: (r.artist_name, r.songs_with_youtube, r.total_youtube_views) for r in gold.dim_album(*args).collect()}
    assert got == {"b1": ("Solo", 3, 16), "b2": ("Art", 3, 16)}
    assert gold.dim_album(*args, per_artist=True).count() == 3
    assert {r.songs_with_youtube for r in gold.dim_album(*args, faithful=True).collect()} == {0}


def test_dim_date(spark):
    rows = {r.date_id: r for r in gold.dim_date(spark, "2024-01-31").collect()}
    assert len(rows) == 121 and min(rows) == date(2023, 11, 2) and max(rows) == date(2024, 3, 1)
    day = rows[date(2024, 1, 1)]
    assert (day.month_name, day.week_of_year, day.day_of_week, day.day_name, day.is_weekend) == ("January", 1, 1, "Monday", False)
    assert rows[date(2023, 12, 31)].week_of_year == 52 and rows[date(2023, 12, 31)].is_weekend


@pytest.mark.parametrize("fill", [gold.snapshot_change, gold.snapshot_change_window])
def test_snapshot_change(spark, fill):
    rows = [("s", 1, 10), ("s", 2, 15), ("s", 4, 40), ("s", 5, 30), ("q", 2, 1)]
    df = spark.createDataFrame(rows, "song_id string, d int, total_youtube_views bigint").withColumn(
        "date_id", F.make_date(F.lit(2024), F.lit(1), "d")
    )
    zero = {c: F.lit(0) for c in ("youtube_video_count", "spotify_isrc_count", "unique_youtube_channels")}
    snaps = gold.song_daily_snapshot(df.withColumns(zero), F.col("date_id"), as_of())
    got = {(r.song_id, r.date_id.day): r.youtube_views_change for r in fill(snaps).collect()}
    assert got == {("s", 1): 0, ("s", 2): 5, ("s", 4): 0, ("s", 5): -10, ("q", 2): 0}


def test_ingestion_summary(spark):
    def run(batch, source, raw, silver, rejected, seconds):
        return {
            "log_id": batch + source, "batch_id": batch, "source": source, "status": "success", "records_raw": raw,
            "records_silver": silver, "records_rejected": rejected, "started_at": datetime(2024, 1, 1, 5), "duration_seconds": seconds,
        }

    runs = frame(spark, "silver_ingestion_log", run("b1", "x", 10, 9, 1, 2), run("b2", "x", 0, 0, 0, 3), run("b3", "y", 0, 0, 0, 1))
    checks = frame(
        spark,
        "silver_data_quality_log",
        {"check_id": "k1", "status": "pass", "details": '{"batch_id":"b1"}'},
        {"check_id": "k2", "status": "warn", "details": '{"batch_id":"b1"}'},
        {"check_id": "k3", "status": "fail", "details": "{}"},
    )
    got = {r.source: r for r in gold.ingestion_summary(runs, checks, as_of()).collect()}
    x, y = got["x"], got["y"]
    assert (x.total_raw_records, x.total_silver_records, float(x.success_rate_pct)) == (10, 9, 90.0)
    assert (x.avg_ingestion_duration_seconds, x.total_checks_run, x.checks_passed, x.checks_failed) == (3, 2, 1, 1)
    assert (float(y.success_rate_pct), y.total_checks_run) == (0.0, 0)


def test_dashboards_agree_with_mapping(layer):
    dim = gold.dim_song(layer["link"], layer["track"], layer["album"], layer["video"], as_of(), count_empty_isrc=True)
    q1 = {r.song_id: r.youtube_video_count for r in dashboards.q1_videos_per_song(dim).collect()}
    assert q1 == {r.song_id: r.videos for r in dashboards.q1_from_mapping(layer["link"]).collect()}
    q2 = {r.song_id: r.spotify_isrc_count for r in dashboards.q2_isrcs_per_song(dim).collect()}
    assert q2 == {r.song_id: r.isrcs for r in dashboards.q2_from_mapping(layer["link"], layer["track"]).collect()}
    stats = dashboards.summary_stats(dim).first()
    assert (stats.total_songs, stats.total_videos, stats.total_views) == (2, 3, 16)
    assert {r.platform: r.song_count for r in dashboards.platform_presence(dim).collect()} == {"Both": 1, "Spotify Only": 1}
    assert dashboards.song_detail(dim, 1).first().song_title == "love"
    assert dashboards.drill_videos(dim, layer["link"], layer["video"]).count() == 3
    assert dashboards.drill_isrcs(dim, layer["link"], layer["track"]).count() == 4
