"""Mapping, batch by batch, against the mapping of all at once."""

import random

from pyspark.sql import functions as F

from lodestrata.plans import mapping
from lodestrata.plans.matching import Matcher

TRACK = "track_id string, track_name string, isrc_code string, artist_name string"
VIDEO = "video_id string, title string, channel_id string, view_count bigint"


def as_of():
    return F.lit("2024-01-01").cast("timestamp_ntz")


def tracks(spark, rows):
    return mapping.song_tracks(spark.createDataFrame(rows, TRACK))


def videos(spark, rows):
    return mapping.matchable_videos(spark.createDataFrame(rows, VIDEO))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def whole(spark, track_rows, video_rows):
    """Mapping of the newest version of every row."""
    t, v = ({r[0]: r for r in x} for x in (track_rows, video_rows))
    full = mapping.song_mapping(tracks(spark, list(t.values())), videos(spark, list(v.values())), as_of())
    return rows(full)


BATCHES = [
    (
        [("t1", "Love!", "I1", "Art Band"), ("t2", "love", "I2", "art band"), ("t3", "Other", "", "Solo"), ("t4", "!!!", "", "Solo")],
        [("v1", "LOVE - Art Band (live)", "c1", 5), ("v2", "glove / art bandits", "c2", 7), ("v3", "Other love: Solo art band", "", 11)],
    ),
    # new songs meet old titles, old songs meet new titles, a video's views change
    ([("t5", "u", "", "x"), ("t6", "live", "", "art")], [("v4", "solo other", "c1", 1), ("v1", "LOVE - Art Band (live)", "c1", 50)]),
    # a track moves to another song, its old song has another track; a title changes; nothing else new
    ([("t1", "Solo", "I1", "Art Band")], [("v3", "no words in common", "", 11), ("v5", "uxu solo", None, 3)]),
    # the last tracks of a song leave it, and one comes back later
    ([("t2", "Renamed", "I2", "Nobody")], [("v6", "another art band love", "c", 2)]),
    ([("t7", "love", "", "Art Band")], []),
    ([], []),
]


def test_batches_equal_one_run(spark, scratch, monkeypatch, buckets=4):
    monkeypatch.setattr("lodestrata.plans.matching.MOST_FOLDERS", 2)
    seen_t, seen_v = [], []
    for t, v in BATCHES:
        seen_t, seen_v = seen_t + t, seen_v + v
        matcher = Matcher(spark, scratch, buckets)
        matcher.update(tracks(spark, t), videos(spark, v))
        assert rows(matcher.mapping(as_of())) == whole(spark, seen_t, seen_v)
    assert rows(Matcher(spark, scratch, buckets).mapping(as_of())) == whole(spark, seen_t, seen_v)


def test_a_repeated_batch_changes_nothing(spark, scratch):
    t, v = BATCHES[0]
    for _ in range(2):
        Matcher(spark, scratch, 8).update(tracks(spark, t), videos(spark, v))
    matcher = Matcher(spark, scratch, 8)
    assert rows(matcher.mapping(as_of())) == whole(spark, t, v)
    assert {r.tracks for r in matcher.store.read("songs").collect()} == {1, 2}
    assert matcher.store.read("pairs").count() == matcher.store.read("pairs").distinct().count()


def test_random_batches(spark, scratch):
    rnd = random.Random(9)

    def words(k, n):
        return " ".join("".join(rnd.choice("abc") for _ in range(rnd.randint(1, n))) for _ in range(k))

    seen_t, seen_v = [], []
    for batch in range(3):
        t = [(f"t{rnd.randint(0, 60)}", words(rnd.randint(1, 2), 5), "", words(1, 3)) for _ in range(30)]
        v = [(f"v{batch}-{i}", words(rnd.randint(1, 6), 9), "c", i) for i in range(40)]
        t = list({r[0]: r for r in t}.values())
        seen_t, seen_v = seen_t + t, seen_v + v
        Matcher(spark, scratch, 8).update(tracks(spark, t), videos(spark, v))
    assert rows(Matcher(spark, scratch, 8).mapping(as_of())) == whole(spark, seen_t, seen_v)


def test_only_touched_index_files_are_read(spark, scratch):
    rnd = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rnd.choice(letters) for _ in range(7))
    matcher = Matcher(spark, scratch, 256)
    matcher.update(
        tracks(spark, [(f"t{i}", word(), "", word()) for i in range(300)]),
        videos(spark, [(f"v{i}", f"{word()} {word()}", "c", 1) for i in range(300)]),
    )
    stored = {name: len(matcher.store.files(name)) for name in ("title_grams", "song_grams")}
    matcher = Matcher(spark, scratch, 256)
    title = matcher.store.read("videos").first().title.split()
    matcher.update(tracks(spark, [("n1", title[0], "", title[1])]), videos(spark, [("w1", "brand new", "c", 1)]))
    assert stored["title_grams"] > 250 and stored["song_grams"] > 150
    # one gram for the new song, and the few grams of the new title
    assert 1 <= len(matcher.opened["title_grams"]) <= 2
    assert len(matcher.opened["song_grams"]) < stored["song_grams"] / 4
    assert matcher.mapping(as_of()).filter("song_title_normalized = '%s' AND youtube_video_id IS NOT NULL" % title[0]).count() == 1


# --- records that are one thing ---


def plain_least(pairs):
    least = {g: g for g, _ in pairs}
    while True:
        codes = {}
        for g, c in pairs:
            codes[c] = min(codes.get(c, least[g]), least[g])
        new = {g: min([least[g], *(codes[c] for h, c in pairs if h == g)]) for g in least}
        if new == least:
            return sorted(least.items())
        least = new


def test_same_by_code(spark):
    from lodestrata.operators.identity import same_by_code

    rnd = random.Random(1)
    chain = list(range(100, 140))
    rnd.shuffle(chain)
    pairs = [(g, f"c{i}") for i, (a, b) in enumerate(zip(chain, chain[1:])) for g in (a, b)]
    pairs += [(g, f"r{i}") for i in range(7) for g in (200 + i, 200 + (i + 1) % 7)]  # a ring
    pairs += [(300 + i, "hot") for i in range(50)] + [(1, "alone"), (2, "x"), (2, "x")]
    pairs += [(rnd.randint(400, 460), f"q{rnd.randint(0, 45)}") for _ in range(80)]
    df = spark.createDataFrame([*pairs, (None, "hot"), (5, None)], "r long, c string")
    assert rows(same_by_code(df, "r", "c")) == sorted(plain_least(pairs), key=str)
    assert same_by_code(df.limit(0), "r", "c").count() == 0


def test_isrc_links_are_transitive(spark):
    given = [("t1", "A", "I1", "x"), ("t2", "B", "I1", "x"), ("t3", "B", "I2", "x"), ("t4", "C", "I2", "x"), ("t5", "D", "", "x")]
    linked = mapping.isrc_links(tracks(spark, given)).collect()
    assert len({r.song_id for r in linked}) == 1
    ids = {r.track_id: r.song_id for r in tracks(spark, given).collect()}
    least = min(ids[t] for t in ("t1", "t2", "t4"))
    assert {r.spotify_track_id for r in linked} == {t for t in ("t1", "t2", "t3", "t4") if ids[t] != least}
