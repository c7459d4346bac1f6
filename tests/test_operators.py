from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.functions import cache_key
from lodestrata.operators import backlog, monitoring, pages, quality
from lodestrata.operators.latest import pick_version
from lodestrata.operators.merge import insert_if_absent, merge_patch, merge_upsert


def at(text):
    return F.lit(text).cast("timestamp_ntz")


# Merge -----------------------------------------------------------------------


def test_upsert_columns(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", None)], "id int, name string, n int")
    new = spark.createDataFrame([(2, "B", 20), (3, "C", None)], "id int, name string, n int")
    some = merge_upsert(old, new, ["id"], ["n"])
    assert sorted(map(tuple, some.collect())) == [(1, "a", 10), (2, "b", 20), (3, "C", None)]
    full = merge_upsert(old, new, ["id"])
    assert sorted(map(tuple, full.collect())) == [(1, "a", 10), (2, "B", 20), (3, "C", None)]
    assert sorted(map(tuple, merge_upsert(full, new, ["id"]).collect())) == sorted(map(tuple, full.collect()))
    with pytest.raises(ValueError):
        merge_upsert(old, new, ["id"], ["nope"])


def test_insert_if_absent(spark):
    old = spark.createDataFrame([(1, 1)], "a int, b int")
    new = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "a int, b int")
    assert sorted(map(tuple, insert_if_absent(old, new, ["a", "b"]).collect())) == [(1, 1), (1, 2)]


def test_patch_keeps_other_fields(spark):
    old = spark.createDataFrame([(1, {"a": "1", "b": "2"}), (2, {"a": "9"})], "id int, document map<string,string>")
    new = spark.createDataFrame([(1, {"b": None, "c": "3"}), (3, {"x": "y"})], "id int, document map<string,string>")
    got = {r.id: r.document for r in merge_patch(old, new, "id").collect()}
    assert got == {1: {"a": "1", "b": None, "c": "3"}, 2: {"a": "9"}, 3: {"x": "y"}}


def test_pick_version(spark):
    rows = spark.createDataFrame([("k", 1, "a"), ("k", 3, "c"), ("k", 2, "b"), ("m", 5, None)], "k string, n int, v string")
    assert dict((r.k, r.v) for r in pick_version(rows, ["k"], [F.col("n")]).collect()) == {"k": "c", "m": None}
    assert dict((r.k, r.v) for r in pick_version(rows, ["k"], [F.col("n")], "oldest").collect()) == {"k": "a", "m": None}
    with pytest.raises(ValueError):
        pick_version(rows, ["k"], [F.col("n")], "latest")


def test_pick_version_combines_before_the_shuffle(spark):
    plan = pick_version(spark.range(10).selectExpr("id % 2 AS k", "id AS v"), ["k"], [F.col("v")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


# Quality ------------------------------------------------------------------------


def outcome(df):
    details = F.get_json_object("details", "$.check").alias("check")
    return {r.check: (r.check_type, r.status, r.affected_rows) for r in df.select("*", details).collect()}


def test_row_rules_in_one_pass(spark):
    df = spark.createDataFrame([("a", "xx"), ("", "x"), (None, "xxxx")], "isrc string, name string")
    rules = {**quality.missing("isrc", "name"), **quality.too_long({"name": 3}, quality.FAIL)}
    log = quality.check_rows(df, "t", rules, "b1", at("2024-01-01"))
    assert outcome(log) == {
        "isrc_missing": ("missing", "warn", 2),
        "name_missing": ("missing", "pass", 0),
        "name_length_3": ("schema", "fail", 1),
    }
    assert log.columns == [f.name for f in schemas.table_schema("silver_data_quality_log").fields]
    with pytest.raises(ValueError):
        quality.check_rows(df, "t", {"r": ("vague", F.lit(True), "warn")}, "b1", at("2024-01-01"))


def test_decimal_rule(spark):
    df = spark.createDataFrame([(9.994,), (9.996,), (-12.0,)], "v double")
    log = quality.check_rows(df, "t", quality.out_of_decimal("v", 3, 2), "b", at("2024-01-01"))
    assert outcome(log)["v_decimal_3_2"][2] == 2


def test_unique_and_reference(spark):
    df = spark.createDataFrame([(1, "p"), (1, "p"), (1, "q"), (2, None), (3, "")], "k int, fk string")
    parent = spark.createDataFrame([("p",), ("p",)], "id string")
    unique = quality.check_unique(df, "t", ["k"], "b", at("2024-01-01"))
    assert outcome(unique) == {"k_unique": ("duplicate", "fail", 2)}
    reference = quality.check_reference(df, "t", "fk", parent, "id", "b", at("2024-01-01"))
    assert outcome(reference) == {"fk_reference": ("consistency", "fail", 1)}
    good, bad = quality.split_rejects(df, F.col("fk") == "q")
    assert (good.count(), bad.count()) == (4, 1)


# Monitoring ----------------------------------------------------------------------


@pytest.fixture
def runs(spark):
    rows = [
        ("a", datetime(2024, 1, 1, 1), 10, 9, 1, "success", 301),
        ("a", datetime(2024, 1, 2, 1), 0, 0, 0, "failed", 5),
        ("a", datetime(2024, 1, 3, 1), 0, 0, 0, "success", 5),
        ("b", datetime(2024, 1, 1, 1), 10, 10, 0, "success", 300),
    ]
    return spark.createDataFrame(
        rows,
        "source string, started_at timestamp_ntz, records_raw bigint, records_silver bigint,"
        " records_rejected bigint, status string, duration_seconds bigint",
    )


def test_alerts(runs):
    got = {(r.date_id.day, r.source, r.rule, r.severity) for r in monitoring.alerts(runs, F.lit("2024-01-03").cast("date")).collect()}
    assert got == {
        (1, "a", "low_success_rate", "warning"),
        (1, "a", "records_rejected", "warning"),
        (1, "a", "slow_run", "warning"),
        (2, "a", "job_failed", "critical"),
        (3, "a", "no_records_two_days", "critical"),
        # b has no runs at all on the 2nd and 3rd
        (3, "b", "no_records_two_days", "critical"),
    }


def test_no_silent_days_before_a_source_starts(spark):
    rows = [("late", date(2024, 2, 5), 0), ("early", date(2024, 1, 28), 0)]
    totals = spark.createDataFrame(rows, "source string, date_id date, raw bigint")
    got = monitoring.zero_streaks(totals, F.lit("2024-01-30").cast("date")).collect()
    assert sorted((r.source, r.date_id.day) for r in got) == [("early", 29), ("early", 30)]


def test_retention_and_ranges(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in (1, 2, 3)], "t timestamp_ntz")
    assert monitoring.retained(df, "bronze", "t", at("2024-02-01")).count() == 2
    assert monitoring.retained(df, "gold", "t", at("2034-02-01")).count() == 3
    assert df.filter(monitoring.on_day("t", F.lit("2024-01-02").cast("date"))).count() == 1


def test_day_filters_reach_the_scan(spark, scratch):
    df = spark.createDataFrame([(datetime(2024, 1, 1), "a", 1)], "ingested_at timestamp_ntz, source string, x int")
    df.write.parquet(f"{scratch}/b")
    plan = monitoring.daily_by_source(spark.read.parquet(f"{scratch}/b"), at("2024-01-05"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ingested_at" in text and "x:int" not in text


def test_run_log_row(spark):
    row = monitoring.run_log_row(spark, "b", "spotify", "success", 5, 4, 1, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 2)).first()
    assert (row.duration_seconds, row.records_rejected, row.error_message) == (120, 1, None)


# Backlog ---------------------------------------------------------------------------


def test_skip_done(spark):
    songs = spark.createDataFrame([("a",), ("b",), ("c",)], "song string")
    done = spark.createDataFrame([("a", datetime(2024, 1, 9)), ("b", datetime(2024, 1, 1))], "song string, done_at timestamp_ntz")
    assert {r.song for r in backlog.skip_done(songs, done, at("2024-01-10")).collect()} == {"b", "c"}


@pytest.mark.parametrize("prefix, object_counts", [("spotify", "HIT"), ("youtube", "STALE")])
def test_cache_status(spark, prefix, object_counts):
    requests = spark.createDataFrame([("full",), ("object",), ("empty",), ("old",), ("none",)], "query string")
    cache = spark.createDataFrame(
        [("full", '[{"id":1}]', 9), ("object", '{"id":1}', 9), ("empty", "[]", 9), ("old", '[{"id":1}]', 1)],
        "q string, response_items string, d int",
    ).select(cache_key(prefix, "q").alias("cache_key"), "response_items", F.make_timestamp_ntz(F.lit(2024), F.lit(1), "d", F.lit(0), F.lit(0), F.lit(0)).alias("stored_at"))
    got = {r.query: r for r in backlog.cache_status(requests, cache, at("2024-01-09 12:00:00"), prefix).collect()}
    assert {q: r.status for q, r in got.items()} == {
        "full": "HIT", "object": object_counts, "empty": "STALE", "old": "MISS", "none": "MISS",
    }
    assert got["full"].response_items and got["empty"].response_items is None


def test_enrich_and_count(spark):
    catalogue = spark.createDataFrame([("s1", "C1", "O"), ("s2", "C2", None), ("s3", "C3", "")], "song string, song_code string, original_artist string")
    audio = spark.createDataFrame(
        [("s1", '[{"id":"t1","name":"S1","album":{"artists":[{"name":"Art"}]}},{"id":"t2"}]'), ("s2", '{"id":"t9","album":{"artists":[{"name":"B"}]}}')],
        "query string, items string",
    )
    video = spark.createDataFrame([("s1 Art", '[{"id":{"videoId":"v1"},"snippet":{"title":"x"}}]')], "query string, items string")
    rows = backlog.enrich_catalogue(catalogue, audio, video)
    got = {r.song: r for r in rows.collect()}
    assert {s: r.status for s, r in got.items()} == {"s1": "success", "s2": "no_video", "s3": "no_audio"}
    import json

    sent = json.loads(got["s1"].spotify_message)["tracks"]["items"]
    assert (sent["id"], sent["song_code"]) == ("t1", "C1")
    snippet = json.loads(got["s1"].youtube_message)["items"]["snippet"]
    assert snippet == {
        "title": "x", "artist": "Art", "song_name": "s1", "song_code": "C1", "original_artist": "O",
        "song_writers": "Art", "recordings_title": "s1",
    }
    assert got["s2"].youtube_message is None
    counters = backlog.run_counters(rows, spark.createDataFrame([("z",)], "song string"))
    assert {r.counter: r.songs for r in counters.collect()} == {"success": 2, "fail": 2, "skipped": 1}


# Pages --------------------------------------------------------------------------------


def page(kind, *entries):
    video = ",".join(entries)
    if kind == "classic":
        body = '{"sectionListRenderer":{"contents":[{"itemSectionRenderer":{"contents":[%s]}}]}}' % video
    else:
        wrapped = ",".join('{"richItemRenderer":{"content":%s}}' % e for e in entries)
        body = '{"richGridRenderer":{"contents":[%s]}}' % wrapped
    return (
        '<script>var ytInitialData = {"contents":{"twoColumnSearchResultsRenderer":{"primaryContents":%s}}};</script>' % body
    )


def renderer(n, channel="C1"):
    owner = '{"text":"Name"%s}' % (',"navigationEndpoint":{"browseEndpoint":{"browseId":"%s"}}' % channel if channel else "")
    return (
        '{"videoRenderer":{"videoId":"v%d","title":{"runs":[{"text":"a "},{"text":"b"}]},"ownerText":{"runs":[%s]},'
        '"thumbnail":{"thumbnails":[{"url":"s"},{"url":"l"}]},"viewCountText":{"simpleText":"7 views"}}}' % (n, owner)
    )


def test_pages(spark):
    channel = '{"channelRenderer":{"channelId":"C9","title":{"simpleText":"name"}}}'
    html = [
        page("classic", '{"adSlot":{}}', renderer(1), channel, renderer(2, None)),
        page("grid", renderer(3), '{"continuation":{}}'),
        page("classic"),
        "<p>nothing</p>",
    ]
    df = pages.with_document(spark.createDataFrame(list(enumerate(html)), "page_id int, html string"))
    assert df.filter("document is null").count() == 1
    items = pages.search_items(df)
    got = {r.video_id: r for r in items.collect()}
    assert set(got) == {"v1", "v2", "v3"}
    v = got["v1"]
    assert (v.title, v.channel_title, v.channel_id, v.thumbnail_url, v.view_count, v.duration) == ("a b", "Name", "C1", "l", "7 views", "")
    channels = pages.search_channels(df)
    assert [(r.page_id, r.channel_id) for r in channels.collect()] == [(0, "C9")]
    filled = {r.video_id: r.channel_id for r in pages.fill_channel(items, channels).collect()}
    assert filled == {"v1": "C1", "v2": "C9", "v3": "C1"}


def test_date_type_of_alerts(runs):
    assert isinstance(monitoring.daily_totals(runs).first().date_id, date)
