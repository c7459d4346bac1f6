"""Gold dimensions, facts and the dashboard queries over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.catalog import roles
from lodestrata.catalog.registry import query
from lodestrata.catalog.roles import CHECKS, DIM_SONG, LINKED, RUNS, TODAY, as_of, table, today
from lodestrata.plans import dashboards, gold

_AUDIT = ["created_at", "updated_at"]


def _dim_song(spark, sf_dir, **options):
    s, link = roles.song_tables(spark, sf_dir)
    return gold.dim_song(link, s.track, s.album, s.video, as_of(), **options)


@query(f"WITH {DIM_SONG} SELECT *, artist_name AS original_artist FROM dim_song")
def dim_song(spark, sf_dir):
    return _dim_song(spark, sf_dir).drop(*_AUDIT)


@query(
    f"""WITH {LINKED}, side AS (
      SELECT song_id, count(*) AS n FROM songs GROUP BY 1),
    vid AS (SELECT song_id, count(*) AS videos, sum(view_count) AS views FROM pairs GROUP BY 1)
    SELECT song_id, any_value(title_norm) AS song_title, coalesce(any_value(videos), 0) AS youtube_video_count,
      coalesce(any_value(views) * any_value(n), 0)::BIGINT AS total_youtube_views,
      count(DISTINCT isrc_code) AS spotify_isrc_count,
      string_agg(DISTINCT isrc_code, ', ' ORDER BY isrc_code) AS isrc_list
    FROM songs LEFT JOIN side USING (song_id) LEFT JOIN vid USING (song_id) GROUP BY 1"""
)
def dim_song_faithful(spark, sf_dir):
    """Views multiplied by the song's tracks, an empty ISRC counted, as in the source system."""
    rows = _dim_song(spark, sf_dir, faithful=True, count_empty_isrc=True)
    return rows.select(
        "song_id",
        "song_title",
        "youtube_video_count",
        "total_youtube_views",
        "spotify_isrc_count",
        "isrc_list",
    )


@query(
    f"""WITH {LINKED}, owned AS (
      SELECT DISTINCT artist_id, song_id FROM track_artist JOIN songs USING (track_id)),
    vids AS (SELECT artist_id, count(DISTINCT video_id) AS videos, sum(view_count) AS views FROM (
      SELECT DISTINCT artist_id, video_id, view_count FROM owned JOIN pairs USING (song_id)) GROUP BY 1),
    n AS (SELECT artist_id, count(*) AS songs FROM owned GROUP BY 1)
    SELECT artist_id, artist_name, channel_id AS youtube_channel_id, channel_name AS youtube_channel_name,
      coalesce(n.songs, 0) AS total_songs, coalesce(videos, 0) AS total_youtube_videos,
      coalesce(views, 0)::BIGINT AS total_youtube_views
    FROM artist LEFT JOIN n USING (artist_id) LEFT JOIN vids USING (artist_id)
    LEFT JOIN channel ON lower(channel_name) = lower(artist_name)"""
)
def dim_artist(spark, sf_dir):
    s = roles.silver_tables(spark, sf_dir)
    rows = gold.dim_artist(s.artist, s.track_artist, s.channel, roles.song_mapping(s))
    return rows.drop("spotify_url")


@query(
    f"""WITH {LINKED} SELECT artist_id, artist_name, channel_id AS youtube_channel_id,
      channel_name AS youtube_channel_name, count(DISTINCT song_id) AS total_songs,
      0::BIGINT AS total_youtube_videos, 0::BIGINT AS total_youtube_views
    FROM artist LEFT JOIN track_artist USING (artist_id) LEFT JOIN (SELECT track_id, song_id FROM songs) USING (track_id)
    LEFT JOIN channel ON lower(channel_name) = lower(artist_name) GROUP BY 1, 2, 3, 4"""
)
def dim_artist_faithful(spark, sf_dir):
    """Videos reached through the track id: always zero, as in the source system."""
    s = roles.silver_tables(spark, sf_dir)
    rows = gold.dim_artist(s.artist, s.track_artist, s.channel, roles.song_mapping(s), faithful=True)
    return rows.drop("spotify_url")


@query(
    f"""WITH {DIM_SONG}, owned AS (
      SELECT DISTINCT artist_id, song_id FROM track_artist JOIN songs USING (track_id)),
    per AS (SELECT artist_id, channel_id, count(*) AS videos, sum(view_count) AS views FROM (
      SELECT DISTINCT artist_id, video_id, channel_id, view_count FROM owned JOIN pairs USING (song_id))
      GROUP BY 1, 2),
    by_name AS (SELECT artist_name, count(DISTINCT song_id) AS n FROM dim_song GROUP BY 1)
    SELECT artist_id, a.artist_name, per.channel_id AS youtube_channel_id, channel_name AS youtube_channel_name,
      coalesce(n, 0) AS total_songs, coalesce(videos, 0) AS total_youtube_videos,
      coalesce(views, 0)::BIGINT AS total_youtube_views
    FROM artist a LEFT JOIN per USING (artist_id) LEFT JOIN channel ON channel.channel_id = per.channel_id
    LEFT JOIN by_name ON by_name.artist_name = a.artist_name"""
)
def dim_artist_by_mapping(spark, sf_dir):
    s, link = roles.song_tables(spark, sf_dir)
    songs = gold.dim_song(link, s.track, s.album, s.video, as_of())
    return gold.dim_artist_by_mapping(s.artist, s.track_artist, s.channel, link, songs).drop("spotify_url")


_ALBUM = f"""WITH {LINKED}, owned AS (SELECT DISTINCT album_id, song_id FROM songs),
    vids AS (SELECT album_id, count(*) AS videos, sum(view_count) AS views FROM (
      SELECT DISTINCT album_id, video_id, view_count FROM owned JOIN pairs USING (song_id)) GROUP BY 1),
    """


@query(
    _ALBUM
    + """names AS (SELECT album_id, max(artist_name) AS artist_name FROM album_artist JOIN artist USING (artist_id)
      GROUP BY 1)
    SELECT album_id, album_name, album_type, release_date::VARCHAR AS release_date, total_tracks,
      image_url AS cover_image_url, artist_name, coalesce(videos, 0) AS songs_with_youtube,
      coalesce(views, 0)::BIGINT AS total_youtube_views
    FROM album LEFT JOIN names USING (album_id) LEFT JOIN vids USING (album_id)"""
)
def dim_album(spark, sf_dir):
    s = roles.silver_tables(spark, sf_dir)
    return gold.dim_album(s.album, s.album_artist, s.artist, s.track, roles.song_mapping(s))


@query(
    _ALBUM
    + """names AS (SELECT DISTINCT album_id, artist_name FROM album_artist JOIN artist USING (artist_id))
    SELECT album_id, album_name, album_type, release_date::VARCHAR AS release_date, total_tracks,
      image_url AS cover_image_url, artist_name, 0::BIGINT AS songs_with_youtube, 0::BIGINT AS total_youtube_views
    FROM album LEFT JOIN names USING (album_id)"""
)
def dim_album_per_artist(spark, sf_dir):
    """One row per album artist, videos reached through the track id (none)."""
    s = roles.silver_tables(spark, sf_dir)
    return gold.dim_album(
        s.album, s.album_artist, s.artist, s.track, roles.song_mapping(s), faithful=True, per_artist=True
    )


@query(
    """SELECT d::DATE AS date_id, year(d)::INT AS year, quarter(d)::INT AS quarter, month(d)::INT AS month,
      monthname(d) AS month_name, week(d)::INT AS week_of_year, isodow(d)::INT AS day_of_week,
      dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend, count(o_orderkey) AS orders
    FROM (SELECT unnest(generate_series(mx - INTERVAL 90 DAY, mx + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS d
          FROM (SELECT TIMESTAMP '1997-06-15 00:00:00' AS mx))
    LEFT JOIN orders ON o_orderdate::DATE = d::DATE GROUP BY ALL"""
)
def dim_date(spark, sf_dir):
    """The calendar around a base date, with the orders of each day."""
    per_day = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date_id")).agg(
        F.count("*").alias("orders")
    )
    days = gold.dim_date(spark, "1997-06-15")
    return days.join(per_day, "date_id", "left").fillna(0, ["orders"])


_SNAPSHOTS = """snaps AS (
  SELECT 'U' || user_id AS song_id, ts::DATE AS date_id, count(*) AS youtube_video_count,
    count(DISTINCT props) AS spotify_isrc_count, sum(round(value * 100)::BIGINT)::BIGINT AS total_youtube_views,
    count(DISTINCT event_type) AS unique_youtube_channels FROM events GROUP BY 1, 2)"""


def _snapshots(spark, sf_dir):
    """Daily metrics of users in the role of songs."""
    rows = table(spark, sf_dir, "events").groupBy(
        roles.text("U", F.col("user_id")).alias("song_id"), F.to_date("ts").alias("date_id")
    )
    daily = rows.agg(
        F.count("*").alias("youtube_video_count"),
        F.countDistinct("props").alias("spotify_isrc_count"),
        F.sum(roles.cents()).alias("total_youtube_views"),
        F.countDistinct("event_type").alias("unique_youtube_channels"),
    )
    return gold.song_daily_snapshot(daily, F.col("date_id"), as_of())


_CHANGES = ["youtube_video_count_change", "spotify_isrc_count_change", "youtube_views_change"]


@query(
    f"""WITH {DIM_SONG} SELECT md5(song_id || '|{TODAY}') AS snapshot_id, song_id, DATE '{TODAY}' AS date_id,
      youtube_video_count, spotify_isrc_count, total_youtube_views, unique_youtube_channels,
      0::BIGINT AS youtube_video_count_change, 0::BIGINT AS spotify_isrc_count_change,
      0::BIGINT AS youtube_views_change FROM dim_song"""
)
def song_daily_snapshot(spark, sf_dir):
    return gold.song_daily_snapshot(_dim_song(spark, sf_dir), today(), as_of()).drop("captured_at")


_CHANGE_SQL = f"""WITH {_SNAPSHOTS} SELECT s.song_id, s.date_id, s.youtube_video_count,
      coalesce(s.youtube_video_count - p.youtube_video_count, 0) AS youtube_video_count_change,
      coalesce(s.spotify_isrc_count - p.spotify_isrc_count, 0) AS spotify_isrc_count_change,
      coalesce(s.total_youtube_views - p.total_youtube_views, 0) AS youtube_views_change
    FROM snaps s LEFT JOIN snaps p ON p.song_id = s.song_id AND p.date_id = s.date_id - 1"""


@query(_CHANGE_SQL)
def snapshot_change(spark, sf_dir):
    rows = gold.snapshot_change(_snapshots(spark, sf_dir))
    return rows.select("song_id", "date_id", "youtube_video_count", *_CHANGES)


@query(_CHANGE_SQL)
def snapshot_change_window(spark, sf_dir):
    rows = gold.snapshot_change_window(_snapshots(spark, sf_dir))
    return rows.select("song_id", "date_id", "youtube_video_count", *_CHANGES)


SUMMARY = f"""{RUNS}, {CHECKS}, summary AS (
  SELECT started_at::DATE AS date_id, source, sum(records_raw)::BIGINT AS total_raw_records,
    sum(records_silver)::BIGINT AS total_silver_records, sum(records_rejected)::BIGINT AS total_rejected,
    CASE WHEN sum(records_raw) > 0 THEN round(100.0 * sum(records_silver) / sum(records_raw), 2) ELSE 0 END::DOUBLE
      AS success_rate_pct,
    round(avg(duration_seconds))::INT AS avg_ingestion_duration_seconds FROM runs GROUP BY 1, 2),
check_totals AS (
  SELECT started_at::DATE AS date_id, source, count(DISTINCT check_id) AS total_checks_run,
    count(DISTINCT check_id) FILTER (c.status = 'pass') AS checks_passed,
    count(DISTINCT check_id) FILTER (c.status <> 'pass') AS checks_failed
  FROM runs JOIN checks c USING (batch_id) GROUP BY 1, 2)"""


def _summary(spark, sf_dir):
    rows = gold.ingestion_summary(
        roles.run_log(spark, sf_dir), roles.check_rows_log(spark, sf_dir), as_of()
    )
    return rows.withColumn("success_rate_pct", F.col("success_rate_pct").cast("double"))


@query(
    f"""WITH {SUMMARY} SELECT md5(date_id::VARCHAR || '|' || source) AS summary_id, s.*,
      coalesce(total_checks_run, 0) AS total_checks_run, coalesce(checks_passed, 0) AS checks_passed,
      coalesce(checks_failed, 0) AS checks_failed
    FROM summary s LEFT JOIN check_totals USING (date_id, source)"""
)
def ingestion_summary(spark, sf_dir):
    return _summary(spark, sf_dir).drop("last_updated_at")


@query(
    f"""WITH {SUMMARY} SELECT * FROM summary WHERE date_id >= DATE '{TODAY}' - 7"""
)
def health_7d(spark, sf_dir):
    from lodestrata.operators.monitoring import pipeline_health

    return pipeline_health(_summary(spark, sf_dir), today())


_Q1 = f"""WITH {DIM_SONG} SELECT song_id, song_title, artist_name, youtube_video_count FROM dim_song
    WHERE has_youtube ORDER BY youtube_video_count DESC, song_id"""
_Q2 = f"""WITH {DIM_SONG} SELECT song_id, song_title, artist_name, spotify_isrc_count FROM dim_song
    WHERE has_spotify ORDER BY spotify_isrc_count DESC, song_id"""


@query(_Q1 + " LIMIT 20")
def q1_top(spark, sf_dir):
    return dashboards.q1_videos_per_song(_dim_song(spark, sf_dir), 20)


@query(_Q2 + " LIMIT 20")
def q2_top(spark, sf_dir):
    return dashboards.q2_isrcs_per_song(_dim_song(spark, sf_dir), 20)


@query(f"WITH {LINKED} SELECT song_id, count(DISTINCT video_id) AS videos FROM pairs GROUP BY 1")
def q1_from_mapping(spark, sf_dir):
    return dashboards.q1_from_mapping(roles.song_mapping(roles.mapping_tables(spark, sf_dir)))


@query(f"WITH {LINKED} SELECT song_id, count(DISTINCT isrc_code) AS isrcs FROM songs GROUP BY 1")
def q2_from_mapping(spark, sf_dir):
    s = roles.mapping_tables(spark, sf_dir)
    return dashboards.q2_from_mapping(roles.song_mapping(s), s.track)


@query(
    f"""WITH {DIM_SONG} SELECT count(*) AS total_songs, sum(youtube_video_count)::BIGINT AS total_videos,
      sum(spotify_isrc_count)::BIGINT AS total_isrcs, sum(total_youtube_views)::BIGINT AS total_views FROM dim_song"""
)
def summary_stats(spark, sf_dir):
    return dashboards.summary_stats(_dim_song(spark, sf_dir))


@query(
    f"""WITH {DIM_SONG}, label(isrcs, videos, platform) AS (
      VALUES (true, true, 'Both'), (true, false, 'Spotify Only'), (false, true, 'YouTube Only'))
    SELECT platform, count(*) AS song_count FROM dim_song
    JOIN label ON isrcs = has_spotify AND videos = has_youtube GROUP BY 1"""
)
def platform_presence(spark, sf_dir):
    return dashboards.platform_presence(_dim_song(spark, sf_dir))


@query(
    f"""WITH {DIM_SONG} SELECT song_id, song_title, artist_name, youtube_video_count, spotify_isrc_count,
      total_youtube_views, unique_youtube_channels FROM dim_song
    ORDER BY total_youtube_views DESC, song_id LIMIT 50"""
)
def song_detail(spark, sf_dir):
    return dashboards.song_detail(_dim_song(spark, sf_dir))


@query(
    f"""WITH {LINKED} SELECT song_id, title_norm AS song_title, video_id, title, view_count FROM pairs"""
)
def drilldown_videos(spark, sf_dir):
    s, link = roles.song_tables(spark, sf_dir)
    songs = gold.dim_song(link, s.track, s.album, s.video, as_of())
    return dashboards.drill_videos(songs, link, s.video)


@query(
    f"""WITH {LINKED} SELECT song_id, title_norm AS song_title, track_id, track_name, isrc_code, album_id FROM songs"""
)
def drilldown_isrcs(spark, sf_dir):
    s, link = roles.song_tables(spark, sf_dir)
    songs = gold.dim_song(link, s.track, s.album, s.video, as_of())
    return dashboards.drill_isrcs(songs, link, s.track)


@query(
    """SELECT l_suppkey, l_linenumber, string_agg(DISTINCT l_partkey::VARCHAR, ', ' ORDER BY l_partkey::VARCHAR)
      AS parts, count(DISTINCT l_partkey) AS part_count FROM lineitem GROUP BY 1, 2"""
)
def isrc_list(spark, sf_dir):
    """Distinct, sorted list aggregate."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_linenumber", F.col("l_partkey").cast("string").alias("x")
    )
    return rows.groupBy("l_suppkey", "l_linenumber").agg(
        gold.joined_distinct("x").alias("parts"),
        F.countDistinct("x").alias("part_count"),
    )


@query(
    """SELECT o_custkey, bool_or(o_orderstatus = 'F') AS has_f, bool_or(o_orderstatus = 'O') AS has_o,
      count(DISTINCT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderkey END) AS pressing,
      bool_or(o_orderstatus = 'F')::INT + bool_or(o_orderstatus = 'O')::INT AS kinds
    FROM orders GROUP BY 1"""
)
def bool_or_flags(spark, sf_dir):
    status = F.col("o_orderstatus")
    pressing = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderkey"))
    rows = gold.presence(
        table(spark, sf_dir, "orders"), "o_custkey", {"has_f": status == "F", "has_o": status == "O"}
    )
    counted = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.countDistinct(pressing).alias("pressing"))
    return rows.join(counted, "o_custkey")


@query(f"""WITH {LINKED} SELECT DISTINCT song_id, isrc_code AS isrc FROM songs WHERE isrc_code <> ''""")
def song_isrc(spark, sf_dir):
    """The codes of a song, a row each."""
    return gold.song_isrcs(roles.song_mapping(roles.mapping_tables(spark, sf_dir)))
