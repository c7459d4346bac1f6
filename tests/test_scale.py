"""Steps whose cost must not grow faster than their input; same rows as the plain forms."""

import random

from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.catalog import operations, roles
from lodestrata.operators.latest import pick_version
from lodestrata.plans import gold


def little_tables(spark, path):
    """Lines that come twice or thrice, and events, of a few parts."""
    rnd = random.Random(3)
    stamp = "CAST('2024-01-%02d 00:00:00' AS TIMESTAMP_NTZ)"

    def write(name, rows):
        spark.sql(" UNION ALL ".join(f"SELECT {r}" for r in rows)).write.parquet(f"{path}/{name}.parquet")

    write("part", [f"{i}L p_partkey, 'red rod {i % 2}' p_name, 'Brand#{i}' p_brand" for i in range(5)])
    write("supplier", [f"{i}L s_suppkey, 'Supplier#{i % 2:09d}' s_name" for i in range(4)])
    write(
        "orders",
        [f"{i}L o_orderkey, 'F' o_orderstatus, {stamp % (i + 1)} o_orderdate, '5-LOW' o_orderpriority" for i in range(6)],
    )
    write(
        "lineitem",
        [
            f"{rnd.randrange(6)}L l_orderkey, {rnd.randrange(4)}L l_partkey, {rnd.randrange(4)}L l_suppkey,"
            f" {rnd.randrange(1, 8)} l_linenumber, {float(rnd.randrange(1, 50))}D l_quantity, '{rnd.choice('AN')}' l_returnflag,"
            f" 'O' l_linestatus, {stamp % rnd.randrange(1, 29)} l_shipdate"
            for _ in range(40)
        ],
    )
    write(
        "events",
        [
            f"{i}L event_id, {stamp % rnd.randrange(1, 29)} ts, {rnd.randrange(6)}L user_id, 'view' event_type,"
            f" 2.5D value, '{{\"k\": {rnd.randrange(3)}}}' props"
            for i in range(30)
        ],
    )
    return path


def rows(df):
    return sorted(map(str, df.collect()))


def test_versions_are_chosen_before_documents_are_rendered(spark, scratch):
    d = little_tables(spark, f"{scratch}/t")
    chosen = pick_version(roles.track_rows(spark, d), ["l_partkey"], [F.col("l_shipdate"), roles.track_raw_id()])
    order = [F.col("ingested_at"), F.col("raw_id")]
    assert rows(roles.as_responses(chosen)) == rows(pick_version(roles.spotify_messages(spark, d), ["l_partkey"], order))
    plan = operations.catalogue_enrich(spark, d)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    for i, line in enumerate(plan):
        if line.lstrip(" :+-").startswith("Window "):
            below = next((j for j in range(i + 1, len(plan)) if depth[j] <= depth[i]), len(plan))
            assert not any("StructsToJson" in x for x in plan[i:below])



def plain_totals(owned, pairs, by):
    """(owner, video) rows, then their totals."""
    met = owned.join(pairs, "song_id").groupBy("owner", "youtube_video_id")
    met = met.agg(F.max("youtube_view_count").alias("v"), *[F.max(c).alias(c) for c in by])
    return met.groupBy("owner", *by).agg(F.count("*").alias("videos"), F.sum("v").alias("views"))


def test_owners_meet_classes_of_videos(spark):
    rnd = random.Random(5)
    owned = spark.createDataFrame(
        sorted({(f"a{rnd.randrange(8)}", f"s{rnd.randrange(6)}") for _ in range(25)}), "owner string, song_id string"
    )
    found = {(f"s{rnd.randrange(6)}", f"v{rnd.randrange(30)}") for _ in range(60)}
    pairs = spark.createDataFrame(
        [(s, v, rnd.choice(["c1", "c2", None]), rnd.choice([None, 5, 7, 1000])) for s, v in sorted(found)],
        "song_id string, youtube_video_id string, youtube_channel_id string, youtube_view_count long",
    )
    for by in ((), ("youtube_channel_id",)):
        assert rows(gold._class_totals(owned, "owner", pairs, by)) == rows(plain_totals(owned, pairs, by))


def test_a_song_of_many_owners_and_videos_is_no_product(spark):
    many = spark.range(300)
    owned = many.select(F.concat(F.lit("a"), "id").alias("owner"), F.lit("s").alias("song_id"))
    pairs = many.select(
        F.lit("s").alias("song_id"), F.concat(F.lit("v"), "id").alias("youtube_video_id"), F.col("id").alias("youtube_view_count")
    )
    assert gold._video_classes(pairs, ()).count() == 1
    got = gold._class_totals(owned, "owner", pairs).collect()
    assert {(r.videos, r.views) for r in got} == {(300, 299 * 150)} and len(got) == 300


def test_documents_parsed_in_part_give_the_same_tables(spark):
    """Odd documents too: a field of the wrong type or a broken one costs the same rows."""
    from lodestrata.plans import bronze, silver

    album = '{"id": "b", "name": 5, "total_tracks": "many", "images": [{"url": "u"}, 3], "artists": [{"id": "x"}, "y"]}'
    items = [
        f'{{"id": "t1", "name": "n", "uri": 7, "disc_number": "two", "artists": [{{"id": "x", "name": "X", "uri": 1}}], "album": {album}}}',
        f'[{{"id": "t2", "duration_ms": 1.5, "artists": [{{"id": "x"}}, 5, {{"id": "z", "name": []}}], "album": {album}}}, "junk"]',
        '{"id": "t3", "explicit": "maybe", "external_ids": 3, "artists": "none", "album": [1]}',
        '[{"id": "t4", "artists": [{"id": "q", "href": {}}], "album": null}, {"id": ""}, {}]',
        '{"id": "t5", "artists": [{"id": "w"}], "type": }',
    ]
    messages = spark.createDataFrame(
        [(f"r{i}", f'{{"tracks": {{"limit": "x", "items": {x}}}}}') for i, x in enumerate(items)], "raw_id string, value string"
    ).withColumn("ingested_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    raw = bronze.bronze_spotify(messages, "b")
    full = silver.spotify_items(raw)
    for make, doc in (
        (silver.artists, schemas.ARTISTS_DOC),
        (silver.albums, schemas.ALBUM_ONLY_DOC),
        (silver.tracks, schemas.TRACK_ONLY_DOC),
        (silver.track_artists, schemas.TRACK_ARTIST_DOC),
        (silver.album_artists, schemas.ALBUM_ARTIST_DOC),
    ):
        assert rows(make(silver.spotify_items(raw, doc=doc))) == rows(make(full)), doc


def test_staged_documents_hold_what_the_mapping_reads(spark, scratch):
    d = little_tables(spark, f"{scratch}/t")
    whole, part = roles.audio_items(spark, d), roles.staged_audio(spark, d, schemas.MAPPING_DOC)
    fields = ["raw_id", "pos", "item.id", "item.name", "item.external_ids.isrc", "item.artists.id", "item.artists.name"]
    assert rows(part.select(*fields)) == rows(whole.select(*fields))
    written = spark.read.parquet(*{f.rpartition("/")[0] for f in part.inputFiles()}).schema["item"].dataType
    assert written.fieldNames() == ["id", "name", "external_ids", "artists"]


def test_lines_are_dealt_once_and_by_order(spark, scratch):
    d = little_tables(spark, f"{scratch}/t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = roles.track_rows(spark, d)
        plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [x for x in plan.split("\n") if "Exchange" in x and "l_orderkey" in x]
    assert len(dealt) == 1 and "RoundRobin" not in plan
    tables = {t: spark.read.parquet(f"{d}/{t}.parquet").count() for t in ("lineitem", "orders")}
    assert tables["orders"] == 6 and lines.count() == tables["lineitem"]


def test_tracks_are_chosen_once_and_dealt_by_track(spark, scratch):
    d = little_tables(spark, f"{scratch}/t")
    s, link = roles.song_tables(spark, d)
    plain = roles.silver_tables(spark, d)
    fields = ["track_id", "track_name", "isrc_code", "album_id", "song_code"]
    assert rows(s.track.select(*fields)) == rows(plain.track.select(*fields))
    assert rows(link) == rows(roles.song_mapping(plain))
    songs = gold.dim_song(link, s.track, s.album, s.video, roles.as_of())
    assert rows(songs) == rows(gold.dim_song(link, plain.track, s.album, s.video, roles.as_of()))
    plan = songs._jdf.queryExecution().executedPlan().toString().split("\n")
    assert not any("Window" in x and "track_id" in x for x in plan)
    assert not any("Exchange" in x and "track_id" in x and ", song_id" in x for x in plan)


def test_stages_are_packed(spark, scratch):
    from lodestrata.session import stage

    digests = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("raw_id"))
    digests.write.option("compression", "snappy").parquet(f"{scratch}/plain")
    staged = stage(digests.coalesce(1))

    def size(files):
        from pathlib import Path

        return sum(Path(f.removeprefix("file:")).stat().st_size for f in files)

    assert staged.count() == 20_000
    assert size(staged.inputFiles()) < 0.7 * size(spark.read.parquet(f"{scratch}/plain").inputFiles())


def test_shuffles_of_a_stage_go_when_it_is_written(spark):
    import time

    from lodestrata.session import stage

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        names = {files.apply(i).getName() for i in range(files.size())}
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffles()
    staged = stage(spark.range(1_000).repartition(3, "id"))
    deadline = time.time() + 20
    while shuffles() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffles() - before
    assert staged.count() == 1_000


def test_names_of_suppliers_are_not_dealt_with_the_lines(spark, scratch):
    d = little_tables(spark, f"{scratch}/t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = roles.track_rows(spark, d)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not any("Exchange hash" in x and "suppkey" in x for x in plan.split("\n"))


def test_a_manual_mapping_is_made_in_parts_and_not_staged(spark):
    from lodestrata.catalog import link

    rnd = random.Random(3)
    left = spark.createDataFrame([(rnd.choice("ab"), f"s{i}") for i in range(40)] + [(None, "n")], "k string, song_id string")
    right = spark.createDataFrame([(rnd.choice("abc"), i) for i in range(30)] + [(None, 99)], "k string, v int")
    made, link.MADE_ROWS = link.MADE_ROWS, 50
    try:
        joined = link._all_of(left, right, "k", "song_id")
    finally:
        link.MADE_ROWS = made
    plain = left.join(right, "k")
    assert rows(joined.select(*plain.columns)) == rows(plain)
    assert joined.select(F.spark_partition_id()).distinct().count() > 2
