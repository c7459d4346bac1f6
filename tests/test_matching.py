import random

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import song_id
from lodestrata.operators import containment
from lodestrata.operators.containment import contains_match
from lodestrata.plans import mapping

NEEDLES = [
    ("love", "art"),
    ("love", "u2"),
    ("a b c", "x"),
    ("carto", "oon"),
    ("señor", "日本"),
    ("日本", "の"),
    ("long winding title", "the band"),
    ("", "solo"),
    ("only title", ""),
    ("", ""),
    (" ", "u2"),
    ("𝒳𝒴𝒵𝒲", "art"),
    ("zzzz", "never"),
]
TEXTS = [
    "love art official",
    "glove cartoon artist",
    "my love by u2",
    "a b c x",
    "xa b cx",
    "el señor 日本の歌",
    "the long winding title by the band live",
    "solo only title",
    "",
    " ",
    "𝒳𝒴𝒵𝒲𝒱 art",
    "u2",
    "art love love art",
]


def brute(needles, texts, allow_empty):
    return sorted(
        (i, j)
        for i, (a, b) in enumerate(needles)
        for j, t in enumerate(texts)
        if (allow_empty or (a and b)) and a in t and b in t
    )


def frames(spark, needles, texts):
    n = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(needles)], "i int, a string, b string")
    t = spark.createDataFrame(list(enumerate(texts)), "j int, t string")
    return n, t


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "shuffle"])
@pytest.mark.parametrize("allow_empty", [False, True])
def test_equals_brute_force(spark, strategy, allow_empty):
    n, t = frames(spark, NEEDLES, TEXTS)
    got = contains_match(n, t, ["a", "b"], "t", allow_empty, strategy).select("i", "j").collect()
    assert sorted((r.i, r.j) for r in got) == brute(NEEDLES, TEXTS, allow_empty)


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, strategy, seed, monkeypatch):
    # Few letters give many hits; tiny salts put every gram in several tasks.
    monkeypatch.setattr(containment, "ROWS_PER_SALT", 3)
    rnd = random.Random(seed)

    def words(k, n):
        return " ".join("".join(rnd.choice("abc") for _ in range(rnd.randint(1, n))) for _ in range(k))

    needles = sorted({(words(rnd.randint(1, 2), 5), words(1, 3)) for _ in range(60)})
    texts = [words(rnd.randint(1, 8), 9) for _ in range(200)]
    n, t = frames(spark, needles, texts)
    got = contains_match(n, t, ["a", "b"], "t", strategy=strategy).select("i", "j").collect()
    assert sorted((r.i, r.j) for r in got) == brute(needles, texts, False)


def test_one_text_fills_most_rows(spark, monkeypatch):
    monkeypatch.setattr(containment, "ROWS_PER_SALT", 10)
    texts = ["same old love song by the art band"] * 300 + ["other thing"] * 100
    n, t = frames(spark, [("love song", "art"), ("thing", "other")], texts)
    pairs = contains_match(n, t, ["a", "b"], "t", strategy="shuffle")
    assert {r.i: r["count"] for r in pairs.groupBy("i").count().collect()} == {0: 300, 1: 100}


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_every_text_row_counts(spark, strategy):
    n = spark.createDataFrame([(0, "love", "art"), (0, "love", "art")], "i int, a string, b string")
    texts = [(None, "art love"), (None, "art love"), (1, "art love"), (1, "love art"), (2, None), (3, "")]
    t = spark.createDataFrame(texts, "j int, t string")
    got = contains_match(n, t, ["a", "b"], "t", strategy=strategy).select("j", "t").collect()
    assert sorted(map(str, got)) == sorted(map(str, t.limit(4).collect()))


def test_broadcast_stays_within_its_bounds(spark, monkeypatch):
    monkeypatch.setattr(containment, "BROADCAST_CHARS", 20)
    n, t = frames(spark, NEEDLES, TEXTS)
    wide = n.withColumn("note", F.repeat(F.lit("x"), 100))
    plan = plan_of(contains_match(wide, t, ["a", "b"], "t", strategy="broadcast"))
    assert "_salts" in plan  # the keys of the shuffle join


def test_blocked_join_shuffles_needle_grams_only(spark, scratch):
    n, t = frames(spark, [("same", "old")], ["same old thing"] + ["nothing alike here"] * 50)
    t.write.parquet(f"{scratch}/t")
    found = contains_match(n, spark.read.parquet(f"{scratch}/t"), ["a", "b"], "t", strategy="shuffle")
    assert found.count() == 1
    # the texts themselves are read once, when they are staged; the join reads what was staged
    files = found.inputFiles()
    assert not any(f.startswith(f"file://{scratch}/t/") for f in files)
    grams = [f for f in files if "/text_grams/" in f]
    assert spark.read.parquet(*grams).select("_row").distinct().count() == 1


def test_parts_are_keyed_not_needles(spark):
    titles = ["cold bolt", "old bolt", "hot bolt", "blue bolt"]
    artists = [f"supplier0000{i}0076" for i in range(5)]
    needles = [(a, b) for a in titles for b in artists]
    n, t = frames(spark, needles, [f"{a} {b} live" for a, b in needles])
    found = contains_match(n, t, ["a", "b"], "t", strategy="shuffle")
    files = found.inputFiles()
    keys = spark.read.parquet(*[f for f in files if "/part_keys/" in f])
    grams = spark.read.parquet(*[f for f in files if "/text_grams/" in f])
    # a key for every title and artist, and texts are met for these alone: 25 title and 20 artist occurrences
    assert keys.count() == 9
    assert keys.join(grams, "_gram").count() == 45
    got = found.select("i", "j").collect()
    assert sorted((r.i, r.j) for r in got) == brute(needles, [f"{a} {b} live" for a, b in needles], False)


def test_no_needles(spark):
    n, t = frames(spark, [("x", "y")], TEXTS)
    assert contains_match(n.filter("i > 5"), t, ["a", "b"], "t").count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_compare_no_pairs(spark):
    n, t = frames(spark, NEEDLES, TEXTS)
    for strategy in ("broadcast", "shuffle"):
        plan = plan_of(contains_match(n, t, ["a", "b"], "t", strategy=strategy))
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_probe_does_not_shuffle_texts(spark, scratch):
    n, t = frames(spark, NEEDLES, TEXTS)
    t.write.parquet(f"{scratch}/t")
    plan = plan_of(
        contains_match(n, spark.read.parquet(f"{scratch}/t"), ["a", "b"], "t", strategy="broadcast")
    )
    left = plan[: plan.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in left and "Exchange hashpartitioning" not in left


@pytest.fixture
def linked(spark):
    tracks = mapping.song_tracks(
        spark.createDataFrame(
            [
                ("t1", "Love!", "I1", "Art Band"),
                ("t2", "love", "I2", "art band"),
                ("t3", "Other", "I2", "Solo"),
                ("t4", "!!!", "", "Solo"),
            ],
            "track_id string, track_name string, isrc_code string, artist_name string",
        )
    )
    videos = mapping.matchable_videos(
        spark.createDataFrame(
            [
                ("v1", "LOVE - Art Band (live)", "c1", 5),
                ("v2", "glove / art bandits", "c2", 7),
                ("v3", "Other love: Solo art band", "", 11),
                ("v4", "nothing", "c1", 13),
            ],
            "video_id string, title string, channel_id string, view_count bigint",
        )
    )
    return tracks, videos


def pairs_of(rows):
    hits = rows.filter("youtube_video_id is not null").collect()
    return sorted((r.song_title_normalized, r.youtube_video_id) for r in hits)


def as_of():
    return F.lit("2024-01-01").cast("timestamp_ntz")


def test_mapping_grain(linked):
    tracks, videos = linked
    rows = mapping.song_mapping(tracks, videos, as_of())
    assert pairs_of(rows) == [("love", "v1"), ("love", "v2"), ("love", "v3"), ("other", "v3")]
    direct = rows.filter("spotify_track_id is not null")
    assert direct.count() == 4
    assert direct.filter("youtube_video_id is not null").count() == 0
    assert rows.select("mapping_id").distinct().count() == rows.count() == 8


def test_mapping_variants(linked):
    tracks, videos = linked
    copies = mapping.track_copies(mapping.song_mapping(tracks, videos, as_of())).collect()
    assert sum(r.copies for r in copies) == 3 * 2 + 1
    faithful = mapping.song_mapping(tracks, videos, as_of(), allow_empty=True)
    assert ("", "v3") in pairs_of(faithful)
    by_isrc = mapping.song_mapping(tracks, videos, as_of(), isrc=True).filter("match_method = 'isrc'").collect()
    assert [r.spotify_track_id for r in by_isrc] in (["t2"], ["t3"])
    manual = tracks.limit(1).select(
        *mapping.SONG, F.lit("v4").alias("youtube_video_id"), F.lit(13).alias("youtube_view_count")
    )
    added = mapping.song_mapping(tracks, videos, as_of(), manual=manual)
    assert added.filter("match_method = 'manual' and youtube_video_id = 'v4'").count() == 1


def test_song_id_joins_spellings(linked):
    tracks, _ = linked
    ids = {r.track_id: r.song_id for r in tracks.collect()}
    assert ids["t1"] == ids["t2"] != ids["t3"]
    expected = tracks.limit(1).select(song_id(F.lit("love"), F.lit("art band")).alias("s")).first().s
    assert ids["t1"] == expected


def test_grams_of_titles_are_made_once_and_over_all_cores(spark, scratch, monkeypatch):
    """A batch of titles in one file is dealt out, and later steps read the grams that were filed."""
    from lodestrata.plans import matching

    made, dealt = [], []
    plain, spread = matching.text_grams_of, matching.spread
    monkeypatch.setattr(matching, "text_grams_of", lambda *a: made.append(len(a)) or plain(*a))
    monkeypatch.setattr(matching, "spread", lambda df: dealt.append(1) or spread(df))
    tracks = spark.createDataFrame(
        [(f"t{i}", f"Song {i}", "", f"s{i}", f"song {i}", "band") for i in range(3)],
        "track_id string, track_name string, isrc_code string, " + matching._SONG,
    )
    tracks = tracks.withColumn("song_id", matching.song_id(*matching.PARTS))
    videos = spark.createDataFrame(
        [(f"v{i}", "T", "C", 1, f"band song {i % 4} live") for i in range(8)], matching._VIDEO
    )
    m = matching.Matcher(spark, f"{scratch}/m", buckets=2)
    m.update(tracks, videos.filter("video_id < 'v4'"))
    m.update(tracks, videos.filter("video_id >= 'v4'"))
    # Of all levels where they are filed, of the names' levels where new names are looked for.
    assert made == [1, 2] * 2 and len(dealt) == 4
    pairs = {(r.song_id, r.video_id) for r in m.store.read("pairs").collect()}
    ids = {r.song_title_normalized: r.song_id for r in tracks.collect()}
    assert pairs == {(ids[f"song {i % 4}"], f"v{i}") for i in range(8) if i % 4 < 3}
