"""The driver tables in the roles of the music model.

Track documents come from lineitem with part, orders and supplier; repeated
(order, line) pairs are versions of one track. Video documents come from events
with part. Both are rendered to JSON text and take the whole way through bronze
and silver, while the SQL that checks a query works on the tables directly.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.functions import natural_key
from lodestrata.plans import bronze, mapping, silver
from lodestrata.session import shared_folder, spread, spread_tasks, stage

AS_OF = "2024-01-31 00:00:00"
TODAY = "2024-01-30"
BATCH = "batch-1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, batches: int = 4) -> DataFrame:
    """A driver table as a file stream of about `batches` micro-batches."""
    rows = table(spark, sf_dir, name)
    files = max(batches, rows.rdd.getNumPartitions())
    path = f"{shared_folder(spark)}/{name}"
    rows.repartition(files).write.parquet(path)
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-files // batches))
    return reader.parquet(path)


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def today() -> Column:
    return F.lit(TODAY).cast("date")


def text(*parts: Column | str) -> Column:
    """Concatenation; plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def padded(number: Column) -> Column:
    return F.lpad(number.cast("string"), 9, "0")


# Documents -------------------------------------------------------------------


#: Rows of a table up to which its names are sent to all executors instead of dealing out the lines by its key.
BROADCAST_NAMES = 500_000


def track_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    if supplier.count() <= BROADCAST_NAMES:
        supplier = F.broadcast(supplier)
    lines = table(spark, sf_dir, "lineitem")
    tasks = spread_tasks(lines)
    lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    # Dealt by order last: the join with orders takes that up, and the lines of an order, so the versions of
    # a track and the tracks of an album, are staged side by side and cut down before they are shuffled.
    # The supplier's name is put in behind it, so it is not dealt with the lines.
    lines = lines.repartition(tasks, "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))


def _artist(artist_id: Column, name: Column) -> Column:
    return F.struct(
        artist_id.alias("id"),
        name.alias("name"),
        text("artist:", artist_id).alias("uri"),
        text("https://audio.example/artists/", artist_id).alias("href"),
        F.struct(text("https://audio.example/a/", artist_id).alias("spotify")).alias("external_urls"),
    )


def track_raw_id() -> Column:
    return natural_key(
        F.lit("spotify"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("int"),
        F.date_format("l_shipdate", "yyyy-MM-dd"),
    )


def spotify_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(raw_id, value, ingested_at): one search response per lineitem row."""
    return as_responses(track_rows(spark, sf_dir))


def as_responses(rows: DataFrame) -> DataFrame:
    """Rows of `track_rows` as search responses."""
    c = F.col
    line = c("l_linenumber")
    track_id = text("T", c("l_orderkey"), "-", line)
    lead = _artist(text("S", c("l_suppkey")), c("s_name"))
    guest = _artist(text("G", line), text("Guest ", line, " ", c("l_linestatus")))
    artists = F.when(c("l_returnflag") == "A", F.array(lead, guest)).otherwise(F.array(lead))
    style = c("o_orderkey") % 3
    image = [
        F.struct(text("https://img.example/", c("o_orderkey"), f"/{n}").alias("url")) for n in (0, 1)
    ]
    album = F.struct(
        text("A", c("o_orderkey")).alias("id"),
        text(c("o_orderpriority"), " ", c("o_orderkey")).alias("name"),
        c("o_orderstatus").alias("album_type"),
        F.when(style == 0, F.date_format("o_orderdate", "yyyy"))
        .when(style == 1, F.date_format("o_orderdate", "yyyy-MM"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("release_date"),
        F.when(style == 0, "year").when(style == 1, "month").otherwise("day").alias("release_date_precision"),
        (c("o_orderkey") % 20).cast("int").alias("total_tracks"),
        F.when(c("o_orderstatus") != "P", True).alias("is_playable"),
        F.array(lead).alias("artists"),
        F.when(c("o_orderstatus") == "F", F.array()).otherwise(F.array(*image)).alias("images"),
    )
    item = F.to_json(
        F.struct(
            track_id.alias("id"),
            c("p_name").alias("name"),
            F.struct(
                F.when(line == 6, "").when(line < 6, text("ISRC", c("l_partkey"))).alias("isrc")
            ).alias("external_ids"),
            F.when(line > 1, 2).alias("disc_number"),
            line.alias("track_number"),
            (c("l_quantity") * 1000).cast("int").alias("duration_ms"),
            (c("l_returnflag") == "R").alias("explicit"),
            (c("l_linestatus") == "O").alias("is_playable"),
            text("track:", track_id).alias("uri"),
            text("SC", c("l_partkey")).alias("song_code"),
            artists.alias("artists"),
            album.alias("album"),
        )
    )
    # Odd lines hold an object; even ones an array with stray values in it.
    bare = line % 2 == 1
    opened, closed = F.when(bare, "").otherwise("["), F.when(bare, "").otherwise(', "junk", 5]')
    value = F.concat(
        F.lit('{"tracks":{"href":"https://audio.example/search","limit":5,"offset":'),
        line.cast("string"),
        F.lit(',"total":7,"next":'),
        F.when(line < 4, F.lit('"https://audio.example/more"')).otherwise(F.lit("null")),
        F.lit(',"items":'),
        opened,
        item,
        closed,
        F.lit("}}"),
    )
    return rows.select(
        track_raw_id().alias("raw_id"), value.alias("value"), c("l_shipdate").alias("ingested_at"), "l_partkey"
    )


def event_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def cents() -> Column:
    return F.round(F.col("value") * 100).cast("bigint")


def video_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(table(spark, sf_dir, "events")).withColumn("k", event_k())
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return events.join(part, F.col("user_id") == F.col("p_partkey"), "left")


def video_title() -> Column:
    return text(
        F.coalesce("p_name", F.lit("untitled")),
        " – Supplier#",
        padded(F.col("k")),
        " (",
        F.col("event_type"),
        ")",
    )


def video_item() -> Column:
    c = F.col
    kind, video_id = c("event_type"), text("V", c("event_id"))
    published = F.when(c("k") % 2 == 0, text(c("k"), " days ago")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    return F.struct(
        F.when(kind != "click", F.struct(video_id.alias("videoId"))).alias("id"),
        F.when(kind == "click", video_id).alias("videoId"),
        F.struct(
            video_title().alias("title"),
            text("  SUPPLIER#", padded(c("user_id")), " ").alias("channelTitle"),
            F.when(kind != "error", text("C", c("user_id"))).alias("channelId"),
            published.alias("publishedAt"),
            F.struct(F.struct(text("https://img.example/v/", c("event_id")).alias("url")).alias("default")).alias(
                "thumbnails"
            ),
            text("VC", c("user_id")).alias("song_code"),
            c("p_name").alias("recordings_title"),
            text("Writer ", c("k")).alias("song_writers"),
        ).alias("snippet"),
        F.struct(
            F.when(kind == "signup", "No views").otherwise(
                F.concat(F.format_number(cents(), 0), F.lit(" views"))
            ).alias("viewCount")
        ).alias("statistics"),
        F.struct(
            F.when(kind == "view", "1:02:03")
            .otherwise(F.concat(c("k").cast("string"), F.lit(":"), F.lpad((c("k") % 60).cast("string"), 2, "0")))
            .alias("duration")
        ).alias("contentDetails"),
    )


def youtube_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return video_rows(spark, sf_dir).select(
        natural_key(F.lit("youtube"), "event_id").alias("raw_id"),
        F.to_json(F.struct(video_item().alias("items"))).alias("value"),
        F.col("ts").alias("ingested_at"),
    )


def audio_items(spark: SparkSession, sf_dir: str, doc: str = schemas.TRACK_DOC) -> DataFrame:
    messages = spotify_messages(spark, sf_dir).drop("l_partkey")
    return silver.spotify_items(bronze.bronze_spotify(messages, BATCH), doc=doc)


def staged_audio(spark: SparkSession, sf_dir: str, doc: str) -> DataFrame:
    """Track documents, parsed once and staged, with the fields of ``doc``; others read as null."""
    kind = f"raw_id STRING, ingested_at TIMESTAMP_NTZ, pos INT, item {schemas.TRACK_DOC}"
    return stage(audio_items(spark, sf_dir, doc), "items_spotify", kind)


def video_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.youtube_items(bronze.bronze_youtube(youtube_messages(spark, sf_dir), BATCH))


# Columns of tables whose fields are in no document as GOLD_DOC or MAPPING_DOC declares it.
_NOT_GOLD = {
    "track": (
        *("disc_number", "track_number", "duration_ms", "explicit", "is_local", "is_playable"),
        *("track_uri", "track_href", "spotify_url"),
    ),
    "artist": ("artist_uri", "artist_href"),
    "album": ("album_uri", "album_href", "spotify_url", "is_playable"),
}


def silver_tables(spark: SparkSession, sf_dir: str) -> silver.Silver:
    """The silver tables with what the gold tables read; the documents are parsed once and staged as items."""
    audio = staged_audio(spark, sf_dir, schemas.GOLD_DOC)
    return _with_videos(
        spark,
        sf_dir,
        artist=silver.artists(audio).drop(*_NOT_GOLD["artist"]),
        album=silver.albums(audio).drop(*_NOT_GOLD["album"]),
        album_artist=silver.album_artists(audio),
        track=silver.tracks(audio).drop(*_NOT_GOLD["track"]),
        track_artist=silver.track_artists(audio),
    )


def mapping_tables(spark: SparkSession, sf_dir: str) -> silver.Silver:
    """The same with what the mapping reads: no albums, and tracks without them."""
    audio = staged_audio(spark, sf_dir, schemas.MAPPING_DOC)
    return _with_videos(
        spark,
        sf_dir,
        artist=silver.artists(audio).drop(*_NOT_GOLD["artist"], "spotify_url"),
        album=None,
        album_artist=None,
        track=silver.tracks(audio).drop(*_NOT_GOLD["track"], "album_id", "song_code"),
        track_artist=silver.track_artists(audio),
    )


def _with_videos(spark: SparkSession, sf_dir: str, **audio_tables: DataFrame | None) -> silver.Silver:
    video = stage(video_items(spark, sf_dir), "items_youtube")
    return silver.Silver(
        **audio_tables,
        channel=silver.channels(video),
        video=silver.videos(video),
    )


def song_mapping(s: silver.Silver, **options) -> DataFrame:
    tracks = mapping.song_tracks(mapping.primary_artist_left(s.track, s.track_artist, s.artist))
    return mapping.song_mapping(tracks, mapping.matchable_videos(s.video), as_of(), **options)


def song_tables(spark: SparkSession, sf_dir: str) -> tuple[silver.Silver, DataFrame]:
    """`silver_tables` and their mapping, for readers of both.

    The tracks are chosen once and staged with their songs; later reads do not choose them again.
    """
    s = silver_tables(spark, sf_dir)
    named = mapping.primary_artist_left(s.track, s.track_artist, s.artist, ("album_id", "song_code"))
    tracks = stage(mapping.song_tracks(named), "song_tracks")
    pairs = mapping.match_videos(tracks, mapping.matchable_videos(s.video))
    return replace(s, track=tracks), mapping.assemble(tracks, pairs, as_of())


# Logs ------------------------------------------------------------------------


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ingestion runs."""
    k = F.col("k")
    seconds = F.floor("value").cast("bigint")
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", event_k())
        .select(
            F.md5(F.col("event_id").cast("string")).alias("log_id"),
            text("run-", F.col("event_id")).alias("batch_id"),
            F.when(F.col("event_type") == "click", "youtube").otherwise("spotify").alias("source"),
            F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
            k.cast("bigint").alias("records_raw"),
            (k - k % 7).cast("bigint").alias("records_silver"),
            (k % 7).cast("bigint").alias("records_rejected"),
            F.col("ts").alias("started_at"),
            seconds.alias("duration_seconds"),
        )
    )


RUNS = """runs AS (
  SELECT md5(event_id::VARCHAR) AS log_id, 'run-' || event_id AS batch_id,
    CASE WHEN event_type = 'click' THEN 'youtube' ELSE 'spotify' END AS source,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
    k AS records_raw, k - k % 7 AS records_silver, k % 7 AS records_rejected,
    ts AS started_at, floor(value)::BIGINT AS duration_seconds
  FROM (SELECT *, (props::JSON->>'k')::BIGINT AS k FROM events))"""


def check_rows_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as quality checks; three in a row belong to one run, some to none."""
    k = F.col("k")
    batch = text("run-", F.col("event_id") - F.col("event_id") % 3)
    details = F.when(F.col("event_type") == "signup", F.lit("{}")).otherwise(
        F.to_json(F.struct(batch.alias("batch_id")))
    )
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", event_k())
        .select(
            F.md5(text("check-", F.col("event_id"))).alias("check_id"),
            F.col("event_type").alias("table_name"),
            F.lit("missing").alias("check_type"),
            F.when(k < 70, "pass").when(k < 90, "warn").otherwise("fail").alias("status"),
            k.cast("bigint").alias("affected_rows"),
            details.alias("details"),
            F.col("ts").alias("checked_at"),
        )
    )


CHECKS = """checks AS (
  SELECT md5('check-' || event_id) AS check_id, event_type AS table_name,
    'missing' AS check_type,
    CASE WHEN k < 70 THEN 'pass' WHEN k < 90 THEN 'warn' ELSE 'fail' END AS status,
    k AS affected_rows,
    CASE WHEN event_type <> 'signup' THEN 'run-' || (event_id - event_id % 3) END AS batch_id,
    ts AS checked_at
  FROM (SELECT *, (props::JSON->>'k')::BIGINT AS k FROM events))"""


# The same roles in SQL ---------------------------------------------------------

DOCS = """docs AS (
  SELECT *, 'T' || l_orderkey || '-' || l_linenumber AS track_id,
    'A' || o_orderkey AS album_id,
    md5('spotify|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey
        || '|' || l_quantity::INT || '|' || strftime(l_shipdate, '%Y-%m-%d')) AS raw_id
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey)"""

TRACK = DOCS + """, track AS (
  SELECT track_id, p_name AS track_name,
    CASE WHEN l_linenumber < 6 THEN 'ISRC' || l_partkey ELSE '' END AS isrc_code, album_id,
    CASE WHEN l_linenumber > 1 THEN 2 ELSE 1 END AS disc_number, l_linenumber AS track_number,
    (l_quantity * 1000)::INT AS duration_ms, l_returnflag = 'R' AS explicit,
    l_linestatus = 'O' AS is_playable, 'SC' || l_partkey AS song_code, l_shipdate AS ingested_at
  FROM docs
  QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY l_shipdate DESC, raw_id DESC) = 1)"""

ARTIST_ROWS = """artist_rows AS (
  SELECT track_id, album_id, raw_id, l_shipdate, 'S' || l_suppkey AS artist_id,
    s_name AS artist_name, 0 AS pos FROM docs
  UNION ALL
  SELECT track_id, album_id, raw_id, l_shipdate, 'G' || l_linenumber,
    'Guest ' || l_linenumber || ' ' || l_linestatus, 1 FROM docs WHERE l_returnflag = 'A')"""

ARTIST = ARTIST_ROWS + """, artist AS (
  SELECT artist_id, artist_name, l_shipdate AS ingested_at FROM artist_rows
  QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY l_shipdate DESC, raw_id DESC, pos DESC) = 1),
track_artist AS (
  SELECT track_id, artist_id, bool_or(pos = 0) AS is_primary FROM artist_rows GROUP BY 1, 2),
album_artist AS (SELECT DISTINCT album_id, artist_id FROM artist_rows WHERE pos = 0)"""

ALBUM = """album AS (
  SELECT 'A' || o_orderkey AS album_id, o_orderpriority || ' ' || o_orderkey AS album_name,
    o_orderstatus AS album_type,
    CASE o_orderkey % 3 WHEN 0 THEN date_trunc('year', o_orderdate)
      WHEN 1 THEN date_trunc('month', o_orderdate) ELSE o_orderdate END::DATE AS release_date,
    (o_orderkey % 20)::INT AS total_tracks,
    CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'https://img.example/' || o_orderkey || '/0' END AS image_url,
    o_orderstatus <> 'P' AS is_playable
  FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM docs))"""

VIDEO = """video AS (
  SELECT 'V' || event_id AS video_id, CASE WHEN event_type = 'error' THEN '' ELSE 'C' || user_id END AS channel_id,
    coalesce(p_name, 'untitled') || ' – Supplier#' || lpad(k::VARCHAR, 9, '0') || ' (' || event_type || ')' AS title,
    CASE WHEN event_type = 'signup' THEN 0 ELSE round(value * 100)::BIGINT END AS view_count,
    CASE WHEN event_type = 'view' THEN 0 ELSE k * 60 + k % 60 END::INT AS duration_seconds,
    CASE WHEN k % 2 = 0 THEN ts - to_days(k::INT) ELSE date_trunc('second', ts) END AS published_at_parsed,
    'VC' || user_id AS song_code, 'Writer ' || k AS song_writers, coalesce(p_name, '') AS recordings_title,
    ts AS ingested_at, user_id
  FROM (SELECT *, (props::JSON->>'k')::BIGINT AS k FROM events) LEFT JOIN part ON p_partkey = user_id),
channel AS (
  SELECT channel_id, 'SUPPLIER#' || lpad(min(user_id)::VARCHAR, 9, '0') AS channel_name,
    max(ingested_at) AS ingested_at, min(ingested_at) AS first_seen_at
  FROM video WHERE channel_id <> '' GROUP BY 1)"""


def sql_norm(expression: str) -> str:
    """Normaliser for the ASCII names of the driver tables."""
    return (
        rf"regexp_replace(regexp_replace(trim(lower({expression})), '[^\w\s]', '', 'g'), '\s+', ' ', 'g')"
    )


# RE2's \s is ASCII, so the oracle lists the spaces it means.
_SPACE = (
    r"\t\n\v\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def unicode_norm(column: str) -> str:
    """Normaliser for texts in any script."""
    stripped = f"regexp_replace(lower({column}), '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')"
    words = rf"regexp_replace({stripped}, '[^\p{{L}}\p{{N}}_{_SPACE}]', '', 'g')"
    return f"regexp_replace({words}, '[{_SPACE}]+', ' ', 'g')"


NAMED = f"""named AS (
  SELECT t.track_id, track_name, isrc_code, album_id, song_code, coalesce(artist_name, '') AS artist_name
  FROM track t LEFT JOIN (
    SELECT track_id, min(artist_id) AS artist_id FROM track_artist WHERE is_primary GROUP BY 1) p
    USING (track_id) LEFT JOIN artist USING (artist_id)),
songs AS (
  SELECT *, md5(title_norm || '|' || artist_norm)[1:16] AS song_id FROM (
    SELECT *, {sql_norm("track_name")} AS title_norm, {sql_norm("artist_name")} AS artist_norm FROM named))"""

PAIRS = f"""pairs AS (
  SELECT s.*, video_id, title, channel_id, view_count, v.song_code, song_writers, recordings_title
  FROM (SELECT DISTINCT song_id, title_norm, artist_norm FROM songs
        WHERE title_norm <> '' AND artist_norm <> '') s
  JOIN (SELECT *, {sql_norm("title")} AS video_norm FROM video) v
    ON contains(video_norm, title_norm) AND contains(video_norm, artist_norm))"""

SILVER = ",\n".join([TRACK, ARTIST, ALBUM, VIDEO])
LINKED = ",\n".join([SILVER, NAMED, PAIRS])

DIM_SONG = LINKED + """,
dim_song AS (
  SELECT coalesce(a.song_id, b.song_id) AS song_id, coalesce(a.title_norm, b.title_norm) AS song_title,
    coalesce(a.artist_norm, b.artist_norm) AS artist_name, coalesce(album_name, '') AS album_name,
    release_date::VARCHAR AS release_date, coalesce(image_url, '') AS cover_image_url,
    coalesce(b.song_code, a.song_code, '') AS song_code, coalesce(song_writers, '') AS song_writers,
    coalesce(recordings_title, '') AS recordings_title, isrc_list,
    coalesce(videos, 0) AS youtube_video_count, coalesce(isrcs, 0) AS spotify_isrc_count,
    coalesce(tracks, 0) > 0 AS has_spotify, coalesce(videos, 0) > 0 AS has_youtube,
    coalesce(views, 0)::BIGINT AS total_youtube_views, coalesce(tracks, 0) AS total_spotify_tracks,
    coalesce(channels, 0) AS unique_youtube_channels,
    (coalesce(tracks, 0) > 0)::INT + (coalesce(videos, 0) > 0)::INT AS total_platforms
  FROM (SELECT song_id, min(title_norm) AS title_norm, min(artist_norm) AS artist_norm,
          max(album_name) AS album_name, max(release_date) AS release_date, max(image_url) AS image_url,
          max(song_code) AS song_code, count(DISTINCT nullif(isrc_code, '')) AS isrcs,
          string_agg(DISTINCT nullif(isrc_code, ''), ', ' ORDER BY nullif(isrc_code, '')) AS isrc_list,
          count(DISTINCT track_id) AS tracks
        FROM songs LEFT JOIN album USING (album_id) GROUP BY 1) a
  FULL JOIN (SELECT song_id, min(title_norm) AS title_norm, min(artist_norm) AS artist_norm,
          count(*) AS videos, sum(view_count) AS views, count(DISTINCT channel_id) AS channels,
          max(song_code) AS song_code, max(song_writers) AS song_writers,
          max(recordings_title) AS recordings_title FROM pairs GROUP BY 1) b USING (song_id))"""
