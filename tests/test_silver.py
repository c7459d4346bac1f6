import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lodestrata.plans import bronze, silver


def track(n, **more):
    base = {
        "id": f"t{n}",
        "name": f"Song {n}",
        "external_ids": {"isrc": f"ISRC{n}"},
        "artists": [{"id": "a1", "name": "Lead"}, {"id": "a2", "name": "Guest"}],
        "album": {
            "id": "b1",
            "name": "Album",
            "release_date": "2001-05",
            "release_date_precision": "month",
            "artists": [{"id": "a1"}, {"id": "a9"}],
            "images": [{"url": "big"}, {"url": "small"}],
        },
        "unknown": {"field": [1, 2]},
    }
    base.update(more)
    return base


def messages(spark, rows):
    data = [
        (f"r{i}", v if isinstance(v, str) else json.dumps(v), datetime(2024, 1, 1 + i))
        for i, v in enumerate(rows)
    ]
    return spark.createDataFrame(data, "raw_id string, value string, ingested_at timestamp_ntz")


def audio(spark, *items):
    docs = messages(spark, [{"tracks": {"items": i, "offset": 3}} for i in items])
    return bronze.bronze_spotify(docs, "b")


def video(spark, *items):
    return bronze.bronze_youtube(messages(spark, [{"items": i} for i in items]), "b")


def test_headers(spark):
    rows = {r.raw_id: r for r in audio(spark, track(1), [track(2), track(3)], [], {}).collect()}
    assert [rows[f"r{i}"].search_query for i in range(4)] == ["Song 1", "Song 2", "", ""]
    assert (rows["r0"].search_offset, rows["r0"].search_limit, rows["r0"].search_next) == (3, 0, None)
    assert rows["r0"].source == "spotify_api"
    got = video(
        spark,
        {"id": {"videoId": "v1"}, "snippet": {"title": "T"}},
        {"id": {"videoId": ""}, "videoId": "v2"},
        {"videoId": "v3"},
        {"snippet": {}},
    )
    rows = sorted(got.collect(), key=lambda r: r.raw_id)
    assert [r.video_id for r in rows] == ["v1", "v2", "v3", ""]
    assert [r.search_query for r in rows] == ["T", "", "", ""]


def test_items_shapes(spark):
    items = silver.spotify_items(audio(spark, track(1), [track(2), "x", None, 4, track(3)], [], None))
    assert sorted((r.raw_id, r.pos, r.item.id) for r in items.collect()) == [
        ("r0", 0, "t1"),
        ("r1", 0, "t2"),
        ("r1", 1, "t3"),
    ]


def test_entities(spark):
    items = silver.spotify_items(
        audio(spark, track(1), track(2, external_ids={}, id="t2"), track(3, id=""), track(4, artists=[]))
    )
    tracks = {r.track_id: r for r in silver.tracks(items).collect()}
    assert set(tracks) == {"t1", "t2", "t4"}
    assert tracks["t2"].isrc_code == ""
    assert (tracks["t1"].disc_number, tracks["t1"].duration_ms, tracks["t1"].explicit) == (1, 0, False)
    album = silver.albums(items).collect()
    assert [(r.album_id, r.release_date, r.image_url) for r in album] == [("b1", date(2001, 5, 1), "big")]
    assert {r.artist_id for r in silver.artists(items).collect()} == {"a1", "a2"}
    links = {(r.track_id, r.artist_id): r.is_primary for r in silver.track_artists(items).collect()}
    assert links == {("t1", "a1"): True, ("t1", "a2"): False, ("t2", "a1"): True, ("t2", "a2"): False}
    pairs = {(r.album_id, r.artist_id) for r in silver.album_artists(items).collect()}
    assert pairs == {("b1", "a1"), ("b1", "a9")}


@pytest.mark.parametrize("keep, name", [("newest", "C"), ("oldest", "B")])
def test_versions(spark, keep, name):
    first = [track(1, name="A"), track(1, name="B")]
    items = silver.spotify_items(audio(spark, first, track(1, name="C")))
    assert [r.track_name for r in silver.tracks(items, keep).collect()] == [name]


def test_newest_documents_only(spark):
    rows = audio(spark, track(1), track(2), track(3))
    got = silver.tracks(silver.spotify_items(rows, newest=2)).collect()
    assert {r.track_id for r in got} == {"t2", "t3"}


def test_videos_and_channels(spark):
    def hit(n, channel, name, **more):
        return {
            "id": {"videoId": f"v{n}"},
            "snippet": {"channelId": channel, "channelTitle": name, "title": f"T{n}", "publishedAt": "2 days ago"},
            "statistics": {"viewCount": more.get("views", "1,000 views")},
            "contentDetails": {"duration": more.get("length", "4:05")},
        }

    items = silver.youtube_items(
        video(
            spark,
            hit(1, "c1", " Old "),
            [hit(2, "c1", "New"), hit(3, "", "None", views=77, length="1:00:00")],
            hit(1, "c1", "New ", views="2,000 views"),
            {"id": {"videoId": ""}},
        )
    )
    got = {r.video_id: r for r in silver.videos(items).collect()}
    assert set(got) == {"v1", "v2", "v3"}
    assert (got["v1"].view_count, got["v1"].duration_seconds) == (2000, 245)
    assert got["v1"].published_at_parsed == datetime(2024, 1, 1)
    assert (got["v3"].view_count, got["v3"].duration_seconds, got["v3"].channel_id) == (77, 0, "")
    channels = silver.channels(items).collect()
    assert [(r.channel_id, r.channel_name, r.first_seen_at) for r in channels] == [
        ("c1", "New", datetime(2024, 1, 1))
    ]
    assert silver.channels(items, "oldest").first().channel_name == "Old"


def test_undecodable_messages(spark):
    rows = messages(spark, ['{"a":1}', "{broken", "", '{"b":2}'])
    good, bad = bronze.split_undecodable(rows)
    assert {r.raw_id for r in good.collect()} == {"r0", "r3"}
    assert {r.raw_id for r in bad.collect()} == {"r1", "r2"}


def test_message_keys(spark):
    rows = spark.createDataFrame([("x",), ("x",), ("y",)], "value string")
    assert bronze.as_messages(rows).select("raw_id").distinct().count() == 2
    with pytest.raises(ValueError):
        bronze.route_topics(rows, {"radio": "t"}, "b")


def test_responses_parsed_once_give_what_the_whole_way_gives(spark):
    """Object, array and odd responses: the items of explode_response and explode_items are the same."""
    from lodestrata.operators.documents import explode_items, explode_response

    doc = "STRUCT<id STRING, n INT, artists ARRAY<STRUCT<id STRING>>>"
    one, two = '{"id":"a","n":1,"artists":[{"id":"x"},null]}', '{"id":"b","n":"no","artists":{}}'
    items = [
        *(one, two, f"[{one},{two}]", f'["junk",5,null,[{one}],{two},{{}}]', "[]", "{}", "null", "5"),
        *('"text"', '"{\\"id\\":\\"s\\"}"', f'{{"id":"c","items":{one}}}', f'[{{"items":[{one}]}}]'),
    ]
    texts = [f'{{"tracks":{{"limit":"x","items"{gap}{i},"total":2}}}}' for i in items for gap in (":", " : \n ")]
    texts += [f'{{"items":{one}}}', f'{{"tracks":{{"items":{one}', f'{{"tracks":{{"items":[{one}', "{}", "", None, "["]
    texts += [f'{{"tracks":{{"items":{one},"items":[{two}]}}}}', f'{{"tracks":{{"items":{one}}},"q":"\\"items\\":[1]"}}']
    texts += [f"{{'tracks':{{'items':{one}}}}}", f'{{"tracks":[{{"items":{one}}}]}}', f'{{"tracks":{{"items":[{one}]}}}} x']
    bronze = spark.createDataFrame(
        [(str(i), None, t) for i, t in enumerate(texts)], "raw_id string, ingested_at timestamp_ntz, raw_json string"
    )
    whole = F.from_json("raw_json", "STRUCT<tracks STRUCT<items STRING>>")["tracks"]["items"]
    plain = sorted(map(str, explode_items(bronze, whole, doc).collect()))
    assert sorted(map(str, explode_response(bronze, ("tracks", "items"), doc).collect())) == plain
    assert len(plain) > 20
