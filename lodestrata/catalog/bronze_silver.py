"""Bronze envelopes and the silver entities, by a round trip through JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.catalog import roles
from lodestrata.catalog.registry import query
from lodestrata.catalog.roles import ALBUM, ARTIST, BATCH, DOCS, TRACK, VIDEO, table, text
from lodestrata.functions import utc_instant
from lodestrata.operators.documents import explode_items, has_item_list, has_items
from lodestrata.operators.latest import newest_rows, pick_version
from lodestrata.plans import bronze, mapping, silver
from lodestrata.session import stage


@query(
    f"""WITH {VIDEO} SELECT md5('youtube|' || substr(video_id, 2)) AS raw_id, 'batch-1' AS batch_id,
      title AS search_query, video_id, ingested_at, 'youtube_api' AS source FROM video"""
)
def bronze_envelope(spark, sf_dir):
    """Video responses under their audit columns."""
    rows = bronze.bronze_youtube(roles.youtube_messages(spark, sf_dir), BATCH)
    return rows.drop("raw_json")


@query(
    f"""WITH {DOCS} SELECT raw_id, 'batch-1' AS batch_id, p_name AS search_query,
      l_linenumber AS search_offset, 5 AS search_limit, 7 AS search_total,
      'https://audio.example/search' AS search_href,
      CASE WHEN l_linenumber < 4 THEN 'https://audio.example/more' END AS search_next,
      l_shipdate AS ingested_at, 'spotify_api' AS source FROM docs"""
)
def bronze_envelope_audio(spark, sf_dir):
    """Audio responses; the query is found in object and array items alike."""
    messages = roles.spotify_messages(spark, sf_dir).drop("l_partkey")
    return bronze.bronze_spotify(messages, BATCH).drop("raw_json")


@query(
    """SELECT event_id, event_type, ts AS ingested_at FROM events ORDER BY ts DESC, event_id DESC LIMIT 100"""
)
def bronze_newest_n(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").alias("ingested_at"))
    return newest_rows(rows, 100, "ingested_at", "event_id")


@query(
    """SELECT topic, count(*) AS messages, count(DISTINCT raw_id) AS keys FROM (
      SELECT CASE WHEN event_type = 'click' THEN 'raw_youtube' ELSE 'raw_spotify' END AS topic,
        md5(event_type || '|0|' || event_id) AS raw_id FROM events) GROUP BY 1"""
)
def topic_routing(spark, sf_dir):
    """Rows of two topics sent to their bronze tables."""
    topic = F.when(F.col("event_type") == "click", "raw_youtube").otherwise("raw_spotify")
    rows = table(spark, sf_dir, "events").select(
        topic.alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.encode("props", "UTF-8").alias("value"),
        utc_instant("ts").alias("timestamp"),
    )
    routed = bronze.route_topics(
        bronze.from_topic(rows), {"spotify": "raw_spotify", "youtube": "raw_youtube"}, BATCH
    )
    counts = [
        df.groupBy(F.lit(f"raw_{platform}").alias("topic")).agg(
            F.count("*").alias("messages"), F.countDistinct("raw_id").alias("keys")
        )
        for platform, df in routed.items()
    ]
    return counts[0].unionByName(counts[1])


@query(
    """SELECT event_id, pos, 'V' || event_id || '-' || pos AS video_id FROM (
      SELECT event_id, unnest(CASE WHEN event_type = 'click' THEN [0] WHEN event_type = 'error' THEN []::INT[]
        WHEN event_type = 'view' THEN [0, 1] ELSE [0] END) AS pos FROM events)"""
)
def object_or_array(spark, sf_dir):
    """Items as object, array, empty array and array with stray values."""

    def item(n: int):
        return F.to_json(F.struct(F.struct(text("V", F.col("event_id"), f"-{n}").alias("videoId")).alias("id")))

    kind = F.col("event_type")
    items = (
        F.when(kind == "click", item(0))
        .when(kind == "error", F.lit("[]"))
        .when(kind == "view", F.concat(F.lit('["x", '), item(0), F.lit(", null, 7, "), item(1), F.lit("]")))
        .otherwise(F.concat(F.lit(" ["), item(0), F.lit("] ")))
    )
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("raw_id"), F.col("ts").alias("ingested_at"), items.alias("items")
    )
    exploded = explode_items(rows, F.col("items"), schemas.VIDEO_DOC)
    return exploded.select(
        F.col("raw_id").alias("event_id"), "pos", F.col("item.id.videoId").alias("video_id")
    )


@query(
    """SELECT event_type, count(*) AS responses, count_if(event_type NOT IN ('error', 'signup'))::BIGINT AS valid,
      count_if(event_type IN ('view', 'purchase'))::BIGINT AS valid_list FROM events GROUP BY 1"""
)
def response_validity(spark, sf_dir):
    """Which responses hold items: object and list forms, empty and missing ones."""
    kind = F.col("event_type")
    items = (
        F.when(kind == "click", F.col("props"))
        .when(kind == "error", F.lit("[]"))
        .when(kind.isin("view", "purchase"), F.concat(F.lit("["), F.col("props"), F.lit("]")))
    )
    rows = table(spark, sf_dir, "events").withColumn("items", items)
    return rows.groupBy("event_type").agg(
        F.count("*").alias("responses"),
        F.count_if(has_items("items")).alias("valid"),
        F.count_if(has_item_list("items")).alias("valid_list"),
    )


@query(f"WITH {DOCS}, {ARTIST} SELECT artist_id, artist_name, ingested_at FROM artist")
def silver_artist(spark, sf_dir):
    rows = silver.artists(roles.audio_items(spark, sf_dir, schemas.ARTISTS_DOC))
    return rows.select("artist_id", "artist_name", "ingested_at")


@query(
    f"""WITH {DOCS}, {ARTIST} SELECT artist_id, artist_name, l_shipdate AS ingested_at FROM artist_rows
    QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY l_shipdate, raw_id, pos DESC) = 1"""
)
def silver_artist_oldest(spark, sf_dir):
    """Version choice of the source system: the oldest document wins."""
    rows = silver.artists(roles.audio_items(spark, sf_dir, schemas.ARTISTS_DOC), keep="oldest")
    return rows.select("artist_id", "artist_name", "ingested_at")


@query(f"WITH {DOCS}, {ALBUM} SELECT * FROM album")
def silver_album(spark, sf_dir):
    rows = silver.albums(roles.audio_items(spark, sf_dir, schemas.ALBUM_ONLY_DOC))
    return rows.select(
        "album_id",
        "album_name",
        "album_type",
        "release_date",
        "total_tracks",
        "image_url",
        "is_playable",
    )


@query(f"WITH {TRACK} SELECT * FROM track")
def silver_track(spark, sf_dir):
    rows = silver.tracks(roles.audio_items(spark, sf_dir, schemas.TRACK_ONLY_DOC))
    return rows.select(
        "track_id",
        "track_name",
        "isrc_code",
        "album_id",
        "disc_number",
        "track_number",
        "duration_ms",
        "explicit",
        "is_playable",
        "song_code",
        "ingested_at",
    )


@query(f"WITH {DOCS}, {ARTIST} SELECT * FROM track_artist")
def silver_track_artist(spark, sf_dir):
    return silver.track_artists(roles.audio_items(spark, sf_dir, schemas.TRACK_ARTIST_DOC))


@query(f"WITH {DOCS}, {ARTIST} SELECT * FROM album_artist")
def silver_album_artist(spark, sf_dir):
    return silver.album_artists(roles.audio_items(spark, sf_dir, schemas.ALBUM_ARTIST_DOC))


@query(f"WITH {VIDEO} SELECT * FROM channel")
def silver_channel(spark, sf_dir):
    return silver.channels(roles.video_items(spark, sf_dir))


@query(f"WITH {VIDEO} SELECT * EXCLUDE (user_id) FROM video")
def silver_video(spark, sf_dir):
    rows = silver.videos(roles.video_items(spark, sf_dir))
    return rows.select(
        "video_id",
        "channel_id",
        "title",
        "view_count",
        "duration_seconds",
        "published_at_parsed",
        "song_code",
        "song_writers",
        "recordings_title",
        "ingested_at",
    )


@query(
    """SELECT l_partkey, arg_max(l_suppkey, (l_shipdate, l_orderkey, l_linenumber, l_suppkey)) AS newest,
      arg_min(l_suppkey, (l_shipdate, l_orderkey, l_linenumber, l_suppkey)) AS oldest FROM lineitem GROUP BY 1"""
)
def version_choice(spark, sf_dir):
    """Newest and oldest row per key."""
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber")
    order = [F.col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey")]
    newest = pick_version(rows, ["l_partkey"], order, "newest")
    oldest = pick_version(rows, ["l_partkey"], order, "oldest")
    return newest.select("l_partkey", F.col("l_suppkey").alias("newest")).join(
        oldest.select("l_partkey", F.col("l_suppkey").alias("oldest")), "l_partkey"
    )


@query(
    f"""WITH {TRACK}, {ARTIST} SELECT DISTINCT track_id, track_name, isrc_code, artist_name
    FROM track JOIN track_artist USING (track_id) JOIN artist USING (artist_id) WHERE is_primary"""
)
def primary_artist_inner(spark, sf_dir):
    items = roles.staged_audio(spark, sf_dir, schemas.MAPPING_DOC)
    return mapping.primary_artist_inner(
        silver.tracks(items), silver.track_artists(items), silver.artists(items)
    )


@query(
    f"""WITH {TRACK}, {ARTIST} SELECT track_id, track_name, isrc_code, coalesce(artist_name, '') AS artist_name
    FROM track LEFT JOIN (SELECT track_id, min(artist_id) AS artist_id FROM track_artist
      WHERE is_primary GROUP BY 1) USING (track_id) LEFT JOIN artist USING (artist_id)"""
)
def primary_artist_left(spark, sf_dir):
    items = roles.staged_audio(spark, sf_dir, schemas.MAPPING_DOC)
    return mapping.primary_artist_left(
        silver.tracks(items), silver.track_artists(items), silver.artists(items)
    )


@query(
    f"""WITH {VIDEO} SELECT DISTINCT video_id, title, channel_id, channel_name, view_count
    FROM video JOIN channel USING (channel_id)"""
)
def video_with_channel(spark, sf_dir):
    """Videos of known channels; those without a channel are left out."""
    items = stage(roles.video_items(spark, sf_dir), "items")
    return mapping.videos_with_channel(silver.videos(items), silver.channels(items))
