"""Whole runs: batches against one run, failures in the log, rejects, retention."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import monitoring
from lodestrata.plans import medallion
from lodestrata.sources.topics import as_messages

AT = datetime(2024, 3, 1, 12)


def track(i, name, artist, artist_name, isrc="", album="b1", album_name="One"):
    return {
        "id": f"t{i}", "name": name, "external_ids": {"isrc": isrc}, "artists": [{"id": artist, "name": artist_name}],
        "album": {"id": album, "name": album_name, "release_date": "2001", "release_date_precision": "year", "artists": [{"id": artist}]},
    }


def video(i, title, views, channel="c1"):
    snippet = {"title": title, "channelId": channel, "channelTitle": "art"}
    return {"id": {"videoId": f"v{i}"}, "snippet": snippet, "statistics": {"viewCount": f"{views} views"}}


def messages(spark, tracks, videos, at):
    texts = {
        "spotify": [json.dumps({"tracks": {"items": t}}) for t in tracks],
        "youtube": [json.dumps({"items": v}) for v in videos],
    }
    when = F.lit(at).cast("timestamp_ntz")
    return {k: as_messages(spark.createDataFrame([(x,) for x in v], "value string"), ingested_at=when) for k, v in texts.items()}


BATCHES = [
    (
        [track(1, "Love Song", "a1", "Art", "I1"), track(2, "Other", "a2", "Solo", "I2", "b2", "Two")],
        [video(1, "ART - love song", 10), video(2, "solo other live", 20, "c2")],
    ),
    # a track is renamed, an artist too (of a track that is not in the batch), views grow
    (
        [track(1, "Love Song II", "a1", "Art", "I1"), track(3, "Third", "a2", "Solist", "I3", "b2", "Two")],
        [video(1, "ART - love song", 15), video(3, "solist other third", 5)],
    ),
]
GOLD = ("gold_dim_song", "gold_dim_artist", "gold_dim_album")


def plain(tables):
    audit = ("created_at", "updated_at", "ingested_at", "deduplicated_at", "first_seen_at")
    return {n: sorted((str(r) for r in tables[n].drop(*audit).collect())) for n in (*GOLD, "silver_song_mapping")}


def test_batches_equal_a_full_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(medallion, "BUCKETS", 4)
    root = str(tmp_path / "batches")
    for n, (tracks, videos) in enumerate(BATCHES):
        day = datetime(2024, 2, 1 + n)
        built = medallion.run_all(spark, messages(spark, tracks, videos, day), root, f"b{n}", AT, only_batch=True)
        assert medallion.song_store(spark, medallion.Paths(root)).read("pending").isEmpty()
    songs = {r.song_title: r.youtube_video_count for r in built["gold_dim_song"].collect()}
    assert songs == {"love song ii": 0, "other": 1, "third": 1}
    by_batch = plain(built)
    whole = plain(medallion.run_all(spark, {}, root, "again", AT))
    # columns that only the first sighting sets are alike here; everything else has to be
    assert by_batch == whole
    log = spark.read.parquet(f"{root}/silver_ingestion_log")
    assert log.filter("source = 'spotify_api'").count() == 2


def test_a_failed_landing_is_logged_and_fires(spark, tmp_path):
    paths = medallion.Paths(str(tmp_path / "lake"))
    good = messages(spark, [], [video(1, "t", 1)], AT)
    broken = as_messages(
        spark.range(1).select(F.raise_error(F.lit("no connection")).cast("string").alias("value")),
        ingested_at=F.lit(AT).cast("timestamp_ntz"),
    )
    with pytest.raises(Exception, match="no connection"):
        medallion.run_bronze({"youtube": good["youtube"], "spotify": broken}, paths, "b1")
    log = spark.read.parquet(paths.table("silver_ingestion_log"))
    assert sorted((r.source, r.status, r.records_raw) for r in log.collect()) == [("spotify_api", "failed", 0), ("youtube_api", "success", 1)]
    fired = monitoring.alerts(log, F.current_date()).filter("rule = 'job_failed'").collect()
    assert [r.source for r in fired] == ["spotify_api"]


def test_rejects_and_checks(spark, tmp_path):
    paths = medallion.Paths(str(tmp_path / "lake"))
    long = "x" * 600
    bad = as_messages(spark.createDataFrame([("{broken",)], "value string"), ingested_at=F.lit(AT).cast("timestamp_ntz"))
    given = messages(spark, [track(1, long, "a1", "Art"), track(2, "ok", "a1", "Art")], [video(1, "t", 1)], AT)
    given["spotify"] = given["spotify"].unionByName(bad)
    medallion.run_bronze(given, paths, "b1")
    tables = medallion.run_silver(spark, paths, "b1", AT)
    assert [r.track_id for r in tables["silver_spotify_track"].collect()] == ["t2"]
    rejects = spark.read.parquet(paths.table("silver_rejects")).collect()
    assert [(r.table_name, json.loads(r.data)["track_id"]) for r in rejects] == [("silver_spotify_track", "t1")]
    checks = spark.read.parquet(paths.table("silver_data_quality_log"))
    warned = {(r.table_name, json.loads(r.details)["check"]) for r in checks.filter("status = 'warn'").collect()}
    assert ("silver_spotify_track", "too_long") in warned
    assert {"anomaly", "schema", "missing", "duplicate", "consistency"} == {r.check_type for r in checks.collect()}
    log = spark.read.parquet(paths.table("silver_ingestion_log")).filter("source = 'spotify_api'").first()
    assert (log.records_raw, log.records_silver, log.records_rejected) == (3, 2, 1)


def test_retention_drops_old_bronze_days(spark, tmp_path):
    paths = medallion.Paths(str(tmp_path / "lake"))
    for n, day in enumerate((datetime(2024, 1, 1), datetime(2024, 2, 20))):
        medallion.run_bronze(messages(spark, [track(n, "a", "a1", "x")], [video(n, "t", 1)], day), paths, f"b{n}")
    dropped = medallion.run_retention(spark, paths, AT)
    assert [d.day for d in dropped["bronze_spotify_raw"]] == [1]
    assert spark.read.parquet(paths.table("bronze_spotify_raw")).count() == 1
    # a dropped message that comes again stays out
    medallion.run_bronze(messages(spark, [track(0, "a", "a1", "x")], [], datetime(2024, 1, 1)), paths, "b2")
    assert spark.read.parquet(paths.table("bronze_spotify_raw")).count() == 1
