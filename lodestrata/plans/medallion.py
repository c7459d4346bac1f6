"""The whole run: bronze, silver, mapping, checks, gold, logs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.functions import is_blank
from lodestrata.operators import monitoring, quality
from lodestrata.plans import bronze, gold, mapping, silver
from lodestrata.plans.matching import Matcher
from lodestrata.session import delete_path, folder_names, path_exists, rename_path, stage
from lodestrata.sinks.store import Store, Table
from lodestrata.sinks.tables import append_new, drop_days, write_partitions
from lodestrata.sources.tables import register


# Names of the bronze runs in the run log.
BRONZE_SOURCES = {"spotify": "spotify_api", "youtube": "youtube_api"}


@dataclass(frozen=True)
class Paths:
    """Where the tables of a deployment live."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def run_bronze(messages: dict[str, DataFrame], paths: Paths, batch_id: str) -> None:
    """Land messages per platform; undecodable ones go to the quarantine table.

    Each platform gets a run-log row of its own: messages, those landed, those put aside; a
    platform that fails is logged as ``failed`` with its error, before the error goes on.
    """
    for platform, rows in messages.items():
        spark, begun = rows.sparkSession, utc_now()
        source = BRONZE_SOURCES[platform]
        try:
            good, bad = bronze.split_undecodable(rows)
            table = bronze.BRONZE_TABLES[platform]
            append_new(bronze.ENVELOPES[platform](good, batch_id), paths.table(table))
            aside = bad.select("raw_id", "value", "ingested_at", "reason")
            append_new(aside, paths.table(f"{table}_quarantine"))
            counts = {source: (rows.count(), bad.count())}
        except Exception as error:
            _log(spark, paths, batch_id, "failed", {source: (0, 0)}, begun, str(error)[:1000])
            raise
        _log(spark, paths, batch_id, "success", counts, begun)


def _stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write a work table and go on from the file: later steps do not redo the work."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _replaced(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Replace a table by a plan that may read it.

    The new version is complete beside the old one before that is touched, and
    takes its place by renaming; ``recover`` ends what a lost run began.
    """
    recover(spark, path)
    df.write.mode("overwrite").parquet(f"{path}__new")
    delete_path(spark, f"{path}__old")
    if path_exists(spark, path):
        rename_path(spark, path, f"{path}__old")
    rename_path(spark, f"{path}__new", path)
    delete_path(spark, f"{path}__old")
    return spark.read.schema(df.schema).parquet(path)


def recover(spark: SparkSession, path: str) -> None:
    """Put a table in place whose replacement was cut off between two renames."""
    if path_exists(spark, path):
        return
    if path_exists(spark, f"{path}__new/_SUCCESS"):
        rename_path(spark, f"{path}__new", path)
    elif path_exists(spark, f"{path}__old"):
        rename_path(spark, f"{path}__old", path)


#: Buckets of the silver tables: so many that a bucket suits a task at the tables' full size.
BUCKETS = 64
#: Tables whose bucket is not picked by the whole key: rows of one owner lie together.
_OWNERS = {
    "silver_spotify_album_artist": ("album_id",),
    "silver_spotify_track_artist": ("track_id",),
}
ENTITIES = (
    "silver_spotify_artist",
    "silver_spotify_album",
    "silver_spotify_album_artist",
    "silver_spotify_track",
    "silver_spotify_track_artist",
    "silver_youtube_channel",
    "silver_youtube_video",
)


def silver_store(spark: SparkSession, paths: Paths) -> Store:
    """The silver entities, which change together."""
    tables = {
        name: Table(
            schemas.TABLES[name],
            schemas.PRIMARY_KEYS[name],
            _OWNERS.get(name, ()),
            schemas.UPDATED_COLUMNS.get(name),
        )
        for name in ENTITIES
    }
    return Store(spark, paths.table("silver"), tables, BUCKETS)


#: Tables by song, of which a batch replaces the songs it touches.
BY_SONG = ("silver_song_mapping", "gold_dim_song")


def song_store(spark: SparkSession, paths: Paths) -> Store:
    """Mapping and song dimension; `pending` has songs whose dimension rows are behind the mapping."""
    tables = {
        "silver_song_mapping": Table(schemas.TABLES["silver_song_mapping"], ("mapping_id",), ("song_id",)),
        "gold_dim_song": Table(schemas.TABLES["gold_dim_song"], ("song_id",)),
        "pending": Table("song_id STRING", ("song_id",)),
    }
    return Store(spark, paths.table("songs"), tables, BUCKETS)


def read_table(spark: SparkSession, paths: Paths, name: str) -> DataFrame:
    """A table of the deployment, wherever it lies; ends a replacement that was cut off."""
    if name in ENTITIES:
        return silver_store(spark, paths).read(name)
    if name in BY_SONG:
        return song_store(spark, paths).read(name)
    recover(spark, paths.table(name))
    return spark.read.parquet(paths.table(name))


def run_silver(
    spark: SparkSession,
    paths: Paths,
    batch_id: str,
    as_of: datetime,
    keep: str = "newest",
    only_batch: bool = False,
) -> dict[str, DataFrame]:
    """Silver tables, mapping, checks and run log.

    By default rebuilt from all of bronze. ``only_batch`` parses the documents
    of this batch alone, merges them into the buckets they fall into, and compares only new
    songs and new videos; see `sinks.store` and `matching`. Both ways end in the same tables.

    The run log gets one row a platform for the batch, ``failed`` with the error if the
    run fails; a repeated run replaces them.
    """
    begun = utc_now()
    try:
        tables, counts = _silver(spark, paths, batch_id, as_of, keep, only_batch)
    except Exception as error:
        counts = {platform: (0, 0) for platform in bronze.BRONZE_TABLES}
        _log(spark, paths, batch_id, "failed", counts, begun, str(error)[:1000])
        raise
    _log(spark, paths, batch_id, "success", counts, begun)
    delete_path(spark, paths.table(f"_work/{batch_id}"))
    return tables


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _log(
    spark: SparkSession,
    paths: Paths,
    batch_id: str,
    status: str,
    counts: dict[str, tuple[int, int]],
    begun: datetime,
    error: str | None = None,
) -> None:
    """Run-log rows of a batch, by one clock; rows of an earlier try of a source are replaced."""
    ended = utc_now()
    rows = None
    for platform, (n, bad) in counts.items():
        row = monitoring.run_log_row(
            spark, batch_id, platform, status, n, n - bad, bad, begun, ended, error
        )
        rows = row if rows is None else rows.unionAll(row)
    rows = rows.withColumn("run", F.col("source"))
    write_partitions(rows, paths.table("silver_ingestion_log"), "batch_id", "run")


def _silver(
    spark: SparkSession, paths: Paths, batch_id: str, as_of: datetime, keep: str, only_batch: bool
) -> tuple[dict[str, DataFrame], dict[str, tuple[int, int]]]:
    """Silver tables, and per platform the records seen and those without an id."""
    work = paths.table(f"_work/{batch_id}")
    audio_bronze = spark.read.parquet(paths.table("bronze_spotify_raw"))
    video_bronze = spark.read.parquet(paths.table("bronze_youtube_raw"))
    if only_batch:
        audio_bronze = audio_bronze.filter(F.col("batch_id") == batch_id)
        video_bronze = video_bronze.filter(F.col("batch_id") == batch_id)
    seen = {"spotify": Observation("spotify"), "youtube": Observation("youtube")}
    # Documents are parsed once, into a nested table of items; each entity then
    # reads only the fields it needs of it. The counts come along for free.
    audio = silver.spotify_items(audio_bronze).observe(
        seen["spotify"], F.count("*").alias("n"), F.count_if(is_blank("item.id")).alias("bad")
    )
    no_id = is_blank("item.id.videoId") & is_blank("item.videoId")
    video = silver.youtube_items(video_bronze).observe(
        seen["youtube"], F.count("*").alias("n"), F.count_if(no_id).alias("bad")
    )
    audio = _stored(spark, audio, f"{work}/items_spotify")
    video = _stored(spark, video, f"{work}/items_youtube")

    entities = silver.Silver(
        artist=silver.artists(audio, keep),
        album=silver.albums(audio, keep),
        album_artist=silver.album_artists(audio),
        track=silver.tracks(audio, keep),
        track_artist=silver.track_artists(audio, keep),
        channel=silver.channels(video, keep),
        video=silver.videos(video, keep),
    )
    store = silver_store(spark, paths)
    touched = stage(_touched_tracks(store, entities), "touched") if only_batch else None
    accepted, rejects = _split_rejects(entities.tables())
    rejects = rejects.withColumn("batch_id", F.lit(batch_id))
    write_partitions(rejects, paths.table("silver_rejects"))
    change = store.change()
    for name, df in accepted.items():
        if only_batch:
            change.merge(name, df)
        else:
            change.replace(name, df)
    change.commit()
    tables = {name: store.read(name) for name in ENTITIES}
    matcher = Matcher(spark, paths.table("silver_matching"), BUCKETS)
    named = _named_tracks(store, touched)
    new_videos = _kept(entities.video, tables["silver_youtube_video"]) if only_batch else tables["silver_youtube_video"]
    songs = matcher.update(
        mapping.song_tracks(named), mapping.matchable_videos(new_videos), afresh=not only_batch
    )
    stamp = F.lit(as_of).cast("timestamp_ntz")
    by_song = song_store(spark, paths)
    change = by_song.change()
    if only_batch:
        linked = stage(matcher.mapping_of(songs, stamp), "mapping")
        change.rewrite("silver_song_mapping", songs, _songs_replaced(songs, linked))
        change.append("pending", songs)
    else:
        # songs that are no more are behind as well
        before = by_song.read("gold_dim_song").select("song_id")
        change.replace("silver_song_mapping", matcher.mapping(stamp))
        change.replace("pending", songs.unionByName(before).distinct())
    change.commit()
    tables["silver_song_mapping"] = by_song.read("silver_song_mapping")

    rejects = spark.read.schema(rejects.schema).parquet(paths.table("silver_rejects"))
    rejects = rejects.filter(F.col("batch_id") == batch_id)
    checks = quality.silver_checks(tables, batch_id, stamp).unionByName(
        quality.check_rejects(rejects, schemas.TEXT_LIMITS, batch_id, stamp)
    )
    checks = checks.withColumn("batch_id", F.lit(batch_id))
    write_partitions(checks, paths.table("silver_data_quality_log"))
    # items are read to the end by now, so the counts are there
    return tables, {p: (o.get["n"], o.get["bad"]) for p, o in seen.items()}


def _split_rejects(entities: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Rows that fit their declared columns by table, and the others as JSON with their table."""
    accepted, rejects = dict(entities), None
    for name, limits in schemas.TEXT_LIMITS.items():
        accepted[name], bad = quality.split_rejects(entities[name], quality.violates(quality.too_long(limits)))
        data = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
        rows = bad.select(F.lit(name).alias("table_name"), data.alias("data"))
        rejects = rows if rejects is None else rejects.unionByName(rows)
    return accepted, rejects


def run_retention(spark: SparkSession, paths: Paths, as_of: datetime) -> dict[str, list[date]]:
    """Drop the bronze days that are older than bronze is kept; the days by table.

    Whole day folders go, rows are not read. Keys of dropped messages stay known, so an old
    message that comes again is not landed again. Silver holds one row an entity and gold
    is kept for good; queries over them ask for their own period.
    """
    first = as_of.date() - timedelta(days=schemas.RETENTION_DAYS["bronze"])
    dropped = {}
    for table in bronze.BRONZE_TABLES.values():
        for name in (table, f"{table}_quarantine"):
            if folder_names(spark, f"{paths.table(name)}/ingest_date=*"):
                dropped[name] = drop_days(spark, paths.table(name), first)
    return dropped


def _songs_replaced(songs: DataFrame, rows: DataFrame):
    """For `Change.rewrite`: the rows take the place of all old rows of the songs."""
    return lambda old, _: old.join(songs, "song_id", "left_anti").unionByName(rows)


def _touched_tracks(store: Store, batch: silver.Silver) -> DataFrame:
    """Ids of the tracks whose song a batch may change: its own, and those of renamed artists and albums."""
    known = store.read("silver_spotify_artist", store.touched("silver_spotify_artist", batch.artist))
    known = known.select("artist_id", F.col("artist_name").alias("old_name"))
    renamed = batch.artist.join(known, "artist_id").filter("old_name <> artist_name")
    theirs = store.read("silver_spotify_track_artist").join(renamed, "artist_id", "left_semi")
    albums = store.read("silver_spotify_album", store.touched("silver_spotify_album", batch.album))
    albums = batch.album.join(albums.select("album_id", F.col("album_name").alias("old_name")), "album_id")
    on_them = store.read("silver_spotify_track").join(albums.filter("old_name <> album_name"), "album_id", "left_semi")
    theirs = theirs.select("track_id").unionByName(on_them.select("track_id"))
    own = batch.track.select("track_id").unionByName(batch.track_artist.select("track_id"))
    return own.unionByName(theirs.select("track_id")).distinct()


def _named_tracks(store: Store, touched: DataFrame | None) -> DataFrame:
    """Tracks with their primary artist, all or those touched."""
    if touched is None:
        parts = [store.read(n) for n in ("silver_spotify_track", "silver_spotify_track_artist")]
    else:
        buckets = store.touched("silver_spotify_track", touched)
        parts = [
            store.read(n, buckets).join(touched, "track_id", "left_semi")
            for n in ("silver_spotify_track", "silver_spotify_track_artist")
        ]
    return mapping.primary_artist_left(*parts, store.read("silver_spotify_artist"))


def _kept(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """The stored rows of a batch's videos: their first title, their newest views."""
    return stored.join(batch.select("video_id"), "video_id", "left_semi")


def run_gold(
    spark: SparkSession, paths: Paths, as_of: datetime, faithful: bool = False
) -> dict[str, DataFrame]:
    """Bring gold up to silver; the day's snapshot replaces only its own day.

    Of the song dimension only the songs are made anew that the mapping has touched since, or all
    for ``faithful``. The other dimensions are rebuilt from silver and the stored mapping.
    """

    def read(name: str) -> DataFrame:
        return read_table(spark, paths, name)

    stamp = F.lit(as_of).cast("timestamp_ntz")
    link = read("silver_song_mapping")
    track, album = read("silver_spotify_track"), read("silver_spotify_album")
    artist, channel = read("silver_spotify_artist"), read("silver_youtube_channel")
    tables = {"gold_dim_song": song_dimension(spark, paths, stamp, faithful)}
    plans = {
        "gold_dim_artist": gold.dim_artist(
            artist, read("silver_spotify_track_artist"), channel, link, faithful
        ),
        "gold_dim_album": gold.dim_album(
            album, read("silver_spotify_album_artist"), artist, track, link, faithful
        ),
        "gold_dim_date": gold.dim_date(spark, as_of.strftime("%Y-%m-%d")),
        "gold_fact_ingestion_summary": gold.ingestion_summary(
            read("silver_ingestion_log"), read("silver_data_quality_log"), stamp
        ),
    }
    for name, df in plans.items():
        tables[name] = _replaced(spark, df, paths.table(name))
    snapshot = gold.song_daily_snapshot(tables["gold_dim_song"], F.to_date(stamp), stamp)
    name = "gold_fact_song_daily_snapshot"
    write_partitions(snapshot, paths.table(name), "date_id")
    tables[name] = gold.snapshot_change(read(name))
    register(tables)
    return tables


def song_dimension(spark: SparkSession, paths: Paths, stamp: Column, faithful: bool = False) -> DataFrame:
    """The song dimension after the songs that are behind were made anew."""
    by_song, silver_tables = song_store(spark, paths), silver_store(spark, paths)
    change = by_song.change()
    if faithful:
        link = by_song.read("silver_song_mapping")
        parts = [silver_tables.read(f"silver_{n}") for n in ("spotify_track", "spotify_album", "youtube_video")]
        change.replace("gold_dim_song", gold.dim_song(link, *parts, stamp, faithful))
        # a later default run has all of them to make anew
        change.replace("pending", link.select("song_id").distinct())
    else:
        pending = stage(by_song.read("pending").distinct(), "pending")
        link = by_song.read("silver_song_mapping", by_song.touched("silver_song_mapping", pending))
        link = stage(link.join(pending, "song_id", "left_semi"), "their_mapping")

        def near(name: str, ids: DataFrame) -> DataFrame:
            return silver_tables.read(name, silver_tables.touched(name, ids))

        track = near("silver_spotify_track", link.select(F.col("spotify_track_id").alias("track_id")))
        album = near("silver_spotify_album", track)
        video = near("silver_youtube_video", link.select(F.col("youtube_video_id").alias("video_id")))
        rows = gold.dim_song(link, track, album, video, stamp)
        change.rewrite("gold_dim_song", pending, _songs_replaced(pending, rows))
        change.replace("pending", pending.limit(0))
    change.commit()
    return by_song.read("gold_dim_song")


def run_all(
    spark: SparkSession,
    messages: dict[str, DataFrame],
    root: str,
    batch_id: str,
    as_of: datetime,
    only_batch: bool = False,
    retain: bool = False,
) -> dict[str, DataFrame]:
    """Bronze, silver and gold in one go; returns silver and gold tables.

    ``only_batch`` takes in this batch alone, see :func:`run_silver`. ``retain`` then drops bronze
    days beyond their time; a later full rebuild of silver knows only what is left.
    """
    paths = Paths(root)
    run_bronze(messages, paths, batch_id)
    tables = run_silver(spark, paths, batch_id, as_of, only_batch=only_batch)
    tables |= run_gold(spark, paths, as_of)
    if retain:
        run_retention(spark, paths, as_of)
    return tables
