import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lodestrata import session
from lodestrata.plans import medallion
from lodestrata.plans.bronze import as_messages, bronze_youtube
from lodestrata.session import shared_folder, spread
from lodestrata.sinks import messages as out
from lodestrata.sinks import tables as sink
from lodestrata.sources import files, tables, topics
from lodestrata.streaming import epochs, ingest, upsert


def put(path, name, text):
    path.mkdir(exist_ok=True)
    (path / name).write_text(text, encoding="utf-8")


def now(text="2024-01-05"):
    return F.lit(text).cast("timestamp_ntz")


def test_documents_and_fallback(spark, tmp_path):
    put(tmp_path / "raw", "a.json", '{\n "items": {}\n}')
    assert files.read_documents(spark, str(tmp_path / "raw")).first().value == '{\n "items": {}\n}'
    assert files.read_documents(spark, str(tmp_path / "absent")).count() == 0
    rows = topics.read_messages(spark, "youtube", path=str(tmp_path / "raw"))
    assert rows.first().topic == "raw_youtube"
    with pytest.raises(ValueError):
        topics.read_messages(spark, "youtube")


def test_kafka_options():
    assert topics.kafka_options("h:1", ["a", "b"])["subscribe"] == "a,b"
    assert topics.kafka_options("h:1", ["a"], "latest")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        topics.kafka_options("h:1", ["a"], "middle")


def test_catalogue(spark, tmp_path):
    put(tmp_path, "c.csv", 'CODE,SONG TITLE,EXTRA\n007,"A, song",x\n8,,y\n')
    sheet = files.read_catalogue(spark, str(tmp_path / "c.csv"))
    assert sheet.columns == ["CODE", "SONG TITLE", "EXTRA"]
    assert [tuple(r) for r in files.catalogue_songs(sheet).collect()] == [("A, song", "007", ""), ("", "8", "")]


def test_delimited_json(spark, tmp_path):
    header = "id_asesmen;id_kunjungan;nama;asmed;jenis_asmed;waktu_input;user_input;waktu_hapus"
    rows = [
        '1;2;x;"{""subjective"":""text"",""kategori"":""k""}";j;2024-01-01 10:00:00.123;u;',
        '2;2;y;"{""subjective"":{""keluhan"":""z""}}";j;2024-01-01 10:00:00;u;2024-01-02 00:00:00',
    ]
    put(tmp_path, "t.csv", "﻿" + "\n".join([header, *rows]) + "\n")
    df = files.read_delimited(spark, str(tmp_path / "t.csv"))
    text, obj = files.string_or_object("asmed", "$.subjective")
    got = df.select("id_asesmen", text.alias("t"), F.to_json(obj).alias("o"), "waktu_input", "waktu_hapus").collect()
    assert [tuple(r)[:3] for r in got] == [("1", "text", None), ("2", None, '{"keluhan":"z"}')]
    assert got[0].waktu_input == datetime(2024, 1, 1, 10, 0, 0, 123000) and got[0].waktu_hapus is None


def test_column_subset(spark):
    df = spark.createDataFrame([(float("nan"), 1.0, "a")], "x double, y double, z string")
    assert tuple(files.column_subset(df, ["z", "x", "y"]).first()) == ("a", None, 1.0)


def test_sql_and_lookup(spark):
    df = spark.range(5).withColumnRenamed("id", "n")
    tables.register({"numbers_view": df})
    assert tables.run_query(spark, "SELECT sum(n) AS s FROM numbers_view WHERE n > :low", {"low": 2}).first().s == 7
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        tables.run_query(spark, "SELECT * FROM no_such_table")
    assert tables.find_one(df, F.col("n") > 1).count() == 1


def test_create_tables(spark):
    spark.sql("DROP DATABASE IF EXISTS ddl_test CASCADE")
    names = sink.create_tables(spark, "ddl_test", ("gold",))
    assert sink.create_tables(spark, "ddl_test", ("gold",)) == names
    made = {r.tableName for r in spark.sql("SHOW TABLES IN ddl_test").collect() if not r.isTemporary}
    assert made == set(names) and "gold_dim_song" in made
    spark.sql("DROP DATABASE ddl_test CASCADE")


def test_append_new(spark, scratch):
    rows = spark.createDataFrame([("a", datetime(2024, 1, 1)), ("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 2))], "raw_id string, ingested_at timestamp_ntz")
    for _ in range(2):
        sink.append_new(rows, f"{scratch}/t")
    assert spark.read.parquet(f"{scratch}/t").count() == 2


def test_append_new_on_another_day(spark, scratch):
    kind = "raw_id string, ingested_at timestamp_ntz"
    for day in (1, 2, 2):
        rows = [("a", datetime(2024, 1, day)), ("a", datetime(2024, 1, day + 3)), (f"d{day}", datetime(2024, 1, day))]
        sink.append_new(spark.createDataFrame(rows, kind), f"{scratch}/t")
        epochs.append_once(spark.createDataFrame(rows, kind), f"q-{day}", f"{scratch}/s")
    for table in "ts":
        keys = sorted(r.raw_id for r in spark.read.parquet(f"{scratch}/{table}").collect())
        assert keys == ["a", "d1", "d2"]


def test_files_keep_their_time(spark, tmp_path):
    put(tmp_path / "in", "1.json", video_text(1))
    os.utime(tmp_path / "in" / "1.json", (1_700_000_000, 1_700_000_000))
    first, again = (topics.read_messages(spark, "youtube", path=str(tmp_path / "in")).first() for _ in range(2))
    assert first == again and first.ingested_at == datetime(2023, 11, 15, 5, 13, 20)


def test_oversize_messages_go_aside(spark, scratch, monkeypatch):
    df = spark.createDataFrame([("1", "a" * 50), ("2", "b"), (None, None)], "id string, v string")
    small, large = out.split_oversize(out.message_rows(df), 30)
    assert (small.count(), large.count()) == (2, 1)
    out.publish(df, f"files:{scratch}/m", rejects=f"{scratch}/r")
    assert spark.read.text(f"{scratch}/m").count() == 3 and spark.read.text(f"{scratch}/r").count() == 0


def test_stages_can_be_dropped(spark, scratch):
    staged = session.stage(spark.range(3), "x")
    folder = os.path.dirname(staged.inputFiles()[0].removeprefix("file://").removeprefix("file:"))
    assert os.path.isdir(folder)
    assert session.drop_stages(spark) >= 1
    assert not os.path.isdir(folder)


def test_table_is_whole_after_a_lost_replacement(spark, scratch):
    path = f"{scratch}/t"
    medallion._replaced(spark, spark.range(2), path)
    assert medallion._replaced(spark, spark.read.parquet(path).unionAll(spark.range(1)), path).count() == 3
    # lost after the old version was put aside: the new one is complete
    os.rename(path, f"{path}__old")
    spark.range(5).write.parquet(f"{path}__new")
    medallion.recover(spark, path)
    assert spark.read.parquet(path).count() == 5
    # lost with a new version that is not complete: the old one comes back
    os.rename(path, f"{path}__mine")
    medallion.recover(spark, path)
    assert spark.read.parquet(path).count() == 3


def test_failed_and_repeated_runs_are_logged_once(spark, tmp_path):
    paths = medallion.Paths(str(tmp_path / "lake"))
    with pytest.raises(Exception):
        medallion.run_silver(spark, paths, "b1", datetime(2024, 1, 1))
    log = spark.read.parquet(paths.table("silver_ingestion_log"))
    assert sorted((r.source, r.status) for r in log.collect()) == [("spotify", "failed"), ("youtube", "failed")]
    assert all(r.error_message and 0 <= r.duration_seconds < 300 for r in log.collect())
    track = json.dumps({"tracks": {"items": {"id": "t1", "name": "N"}}})
    video = json.dumps({"items": {"id": {"videoId": "v1"}, "snippet": {"title": "t"}}})
    rows = {
        k: as_messages(spark.createDataFrame([(v,)], "value string"), ingested_at=now())
        for k, v in {"spotify": track, "youtube": video}.items()
    }
    medallion.run_bronze(rows, paths, "b1")
    for _ in range(2):
        medallion.run_silver(spark, paths, "b1", datetime(2020, 1, 1))
    log = spark.read.parquet(paths.table("silver_ingestion_log")).collect()
    names = ("spotify", "spotify_api", "youtube", "youtube_api")
    assert sorted((r.source, r.status, r.records_raw) for r in log) == [(n, "success", 1) for n in names]
    assert all(r.duration_seconds < 300 for r in log)


def test_write_tables_skips_empty(spark, scratch):
    written = sink.write_tables({"full": spark.range(2), "empty": spark.range(0)}, scratch)
    assert written == ["full"]
    staged = sink.write_staging({"full": spark.range(2)}, scratch, now())
    assert staged == ["full_staging"]
    data = spark.read.parquet(f"{scratch}/full_staging").orderBy("data").first()
    assert json.loads(data.data) == {"id": 0}


def test_partition_overwrite(spark, scratch):
    rows = spark.createDataFrame([("x", 1), ("y", 2)], "batch_id string, v int")
    sink.write_partitions(rows, f"{scratch}/p")
    sink.write_partitions(spark.createDataFrame([("x", 9)], "batch_id string, v int"), f"{scratch}/p")
    assert sorted((r.batch_id, r.v) for r in spark.read.parquet(f"{scratch}/p").collect()) == [("x", 9), ("y", 2)]


def test_messages_and_bulk(spark, scratch):
    df = spark.createDataFrame([("1", "a"), ("", "b"), (None, "c")], "id string, v string")
    out.publish(df, f"files:{scratch}/m")
    assert spark.read.text(f"{scratch}/m").count() == 3
    with pytest.raises(ValueError):
        out.publish(df, "pigeon:x")
    lines = [r.value for r in out.bulk_rows(df, "id", "idx").orderBy("line").collect()]
    assert [json.loads(x) for x in lines] == [{"index": {"_index": "idx", "_id": "1"}}, {"id": "1", "v": "a"}]
    out.write_bulk(df, f"{scratch}/bulk", "id", "idx")
    assert [r.value for r in spark.read.text(f"{scratch}/bulk").collect()] == lines


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder != shared_folder(spark)
    if root:
        assert folder.startswith(root)


# Streaming --------------------------------------------------------------------------


def video_text(n):
    return json.dumps({"items": {"id": {"videoId": f"v{n}"}, "snippet": {"title": f"T{n}"}}})


def test_stream_bronze_goes_on_where_it_stopped(spark, tmp_path):
    inbox, table, mark = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "mark")

    def drain(checkpoint=mark):
        stream = as_messages(files.read_document_stream(spark, str(inbox), whole=False), ingested_at=now())
        ingest.stream_bronze(stream, "youtube", "b", table, checkpoint)
        return spark.read.parquet(f"{table}/rows")

    put(inbox, "1.json", f"{video_text(1)}\n{video_text(2)}\n{video_text(1)}\n{{broken\n")
    assert {r.video_id for r in drain().collect()} == {"v1", "v2"}
    assert drain().count() == 2
    put(inbox, "2.json", f"{video_text(2)}\n{video_text(3)}\n")
    assert sorted(r.video_id for r in drain().collect()) == ["v1", "v2", "v3"]
    assert drain(str(tmp_path / "mark2")).count() == 3
    assert spark.read.parquet(f"{table}/quarantine").count() == 1
    batch = as_messages(spark.read.text(str(inbox)), ingested_at=now()).filter("value <> '{broken'")
    assert bronze_youtube(batch, "b").select("raw_id").distinct().count() == 3


def test_repeated_epoch_replaces_itself(spark, scratch):
    rows = spark.createDataFrame([("a", datetime(2024, 1, 1))], "raw_id string, ingested_at timestamp_ntz")
    for _ in range(2):
        epochs.append_once(rows, "q-1", f"{scratch}/t")
    assert spark.read.parquet(f"{scratch}/t").count() == 1
    epochs.append_once(rows, "q-2", f"{scratch}/t")
    assert spark.read.parquet(f"{scratch}/t").count() == 1


def test_stream_upsert(spark, tmp_path):
    inbox = tmp_path / "in"

    def drain():
        schema = "video_id string, title string, views bigint, ts timestamp_ntz"
        parsed = files.read_jobs(spark, str(inbox)).select(F.from_json("value", schema).alias("r")).select("r.*")
        upsert.stream_upsert(parsed, ["video_id"], [F.col("ts")], str(tmp_path / "c"), str(tmp_path / "m"))
        state = upsert.read_upserted(spark, str(tmp_path / "c"), ["video_id"], ["views"])
        return {r.video_id: (r.title, r.views) for r in state.collect()}

    def row(v, t, n, d):
        return json.dumps({"video_id": v, "title": t, "views": n, "ts": f"2024-01-0{d}T00:00:00"}) + "\n"

    put(inbox, "1", row("v1", "old", 1, 1) + row("v1", "mid", 5, 3) + "\n" + row("v2", "x", 2, 1))
    assert drain() == {"v1": ("old", 5), "v2": ("x", 2)}
    # A late row changes nothing that is newer; a newer one does.
    put(inbox, "2", row("v1", "late", 3, 2) + row("v2", "y", 9, 4))
    assert drain() == {"v1": ("old", 5), "v2": ("x", 9)}
    upsert.compact(spark, str(tmp_path / "c"), ["video_id"])
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2
    assert drain() == {"v1": ("old", 5), "v2": ("x", 9)}
    # the base counts like any batch
    put(inbox, "3", row("v1", "later", 7, 5))
    assert drain() == {"v1": ("old", 7), "v2": ("x", 9)}
    upsert.compact(spark, str(tmp_path / "c"), ["video_id"])
    assert drain() == {"v1": ("old", 7), "v2": ("x", 9)}


def test_stream_daily_and_outcomes(spark, tmp_path):
    inbox = tmp_path / "in"
    put(inbox, "1", "\n".join(json.dumps({"ts": f"2024-01-0{d}T05:00:00Z", "source": s}) for d, s in [(1, "a"), (1, "a"), (2, "b")]))

    def rows():
        parsed = files.read_jobs(spark, str(inbox)).select(F.from_json("value", "ts timestamp, source string").alias("r"))
        return parsed.select("r.*")

    def daily():
        upsert.stream_daily(rows(), str(tmp_path / "d"), str(tmp_path / "m"))
        return {(r.date.day, r.source): r.row_count for r in upsert.read_daily(spark, str(tmp_path / "d")).collect()}

    assert daily() == {(1, "a"): 2, (2, "b"): 1}
    put(inbox, "2", json.dumps({"ts": "2024-01-01T09:00:00Z", "source": "a"}))
    assert daily() == {(1, "a"): 3, (2, "b"): 1}
    # days late by any measure, and a new checkpoint that sees only what is new
    put(inbox, "3", json.dumps({"ts": "2024-03-30T09:00:00Z", "source": "a"}))
    daily()
    late = tmp_path / "late"
    put(late, "4", json.dumps({"ts": "2024-01-02T09:00:00Z", "source": "b"}))
    parsed = files.read_jobs(spark, str(late)).select(F.from_json("value", "ts timestamp, source string").alias("r"))
    upsert.stream_daily(parsed.select("r.*"), str(tmp_path / "d"), str(tmp_path / "m-new"))
    assert daily() == {(1, "a"): 3, (2, "b"): 2, (30, "a"): 1}
    ingest.stream_outcomes(rows(), F.col("source") == "a", F.lit(False), str(tmp_path / "o"), str(tmp_path / "m2"))
    counts = spark.read.parquet(str(tmp_path / "o")).groupBy("outcome").count().collect()
    assert {r.outcome: r["count"] for r in counts} == {"ok": 4, "quarantine": 1}


# The whole run --------------------------------------------------------------------------


def test_medallion_run_is_idempotent(spark, tmp_path):
    track = {
        "id": "t1", "name": "Love Song", "external_ids": {"isrc": "I1"}, "artists": [{"id": "a1", "name": "Art"}],
        "album": {"id": "b1", "name": "One", "release_date": "2001", "release_date_precision": "year", "artists": [{"id": "a1"}]},
    }
    put(tmp_path / "audio", "1.json", json.dumps({"tracks": {"items": track}}))
    put(tmp_path / "audio", "2.json", "{broken")
    for n in (1, 2):
        video = {"items": {"id": {"videoId": f"v{n}"}, "snippet": {"title": "ART - love song", "channelId": "c1", "channelTitle": "art"}, "statistics": {"viewCount": "10 views"}}}
        put(tmp_path / "video", f"{n}.json", json.dumps(video))
    root, at = str(tmp_path / "lake"), datetime(2024, 1, 5, 12)

    def run(as_of):
        sources = {
            "spotify": as_messages(files.read_documents(spark, str(tmp_path / "audio")), ingested_at=now()),
            "youtube": as_messages(files.read_documents(spark, str(tmp_path / "video")), ingested_at=now()),
        }
        return medallion.run_all(spark, sources, root, "b1", as_of)

    run(at)
    built = run(datetime(2024, 1, 6, 12))
    song = built["gold_dim_song"].collect()
    assert [(r.song_title, r.youtube_video_count, r.spotify_isrc_count, r.total_youtube_views) for r in song] == [("love song", 2, 1, 20)]
    days = sorted((r.date_id.day, r.youtube_video_count, r.youtube_video_count_change) for r in built["gold_fact_song_daily_snapshot"].collect())
    assert days == [(5, 2, 0), (6, 2, 0)]
    artist = built["gold_dim_artist"].first()
    assert (artist.youtube_channel_id, artist.total_youtube_videos) == ("c1", 2)
    assert spark.sql("SELECT count(*) AS n FROM gold_dim_song WHERE has_youtube").first().n == 1
    assert spark.read.parquet(f"{root}/bronze_spotify_raw").count() == 1
    assert spark.read.parquet(f"{root}/bronze_spotify_raw_quarantine").count() == 1
    failed = spark.read.parquet(f"{root}/silver_data_quality_log").filter("status = 'fail'")
    assert failed.count() == 0


def test_batch_merge_follows_the_update_rules(spark, tmp_path):
    paths = medallion.Paths(str(tmp_path / "lake"))

    def land(batch, day, name, views):
        track = {"id": "t1", "name": name, "disc_number": day, "external_ids": {"isrc": f"I{day}"}}
        video = {"id": {"videoId": "v1"}, "snippet": {"title": f"title {day}"}, "statistics": {"viewCount": views}}
        texts = {"spotify": json.dumps({"tracks": {"items": track}}), "youtube": json.dumps({"items": video})}
        rows = {
            k: as_messages(spark.createDataFrame([(v,)], "value string"), ingested_at=now(f"2024-01-0{day}"))
            for k, v in texts.items()
        }
        medallion.run_bronze(rows, paths, batch)
        return medallion.run_silver(spark, paths, batch, datetime(2024, 1, day), only_batch=True)

    land("b1", 1, "Old", "10 views")
    tables = land("b2", 2, "New", "20 views")
    track, video = tables["silver_spotify_track"].first(), tables["silver_youtube_video"].first()
    assert (track.track_name, track.isrc_code, track.disc_number) == ("New", "I2", 1)
    assert (video.title, video.view_count) == ("title 1", 20)
    assert tables["silver_song_mapping"].count() == 1


def test_spread_gives_a_task_a_bounded_number_of_rows(spark, scratch, monkeypatch):
    monkeypatch.setattr("lodestrata.session.SPREAD_ROWS", 10)
    spark.range(0, 300, numPartitions=1).write.parquet(f"{scratch}/t")
    rows = spread(spark.read.parquet(f"{scratch}/t"))
    assert rows.rdd.getNumPartitions() == 30
    assert sorted(r.id for r in rows.collect()) == list(range(300))
