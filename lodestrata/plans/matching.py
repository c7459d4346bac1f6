"""Song mapping kept up to date batch by batch.

A song matches a video if its title and artist both occur in the video's title. A batch
brings new songs and new videos, and only these are compared:

* new songs with all titles, through a stored inverted index: the grams of every title, in
  buckets by gram. Each name of a song, its title and its artist, is looked up by its rarest
  gram, so a batch opens the buckets of as many grams as its new songs have names;
* known songs with new titles, through the same for names: every name is filed under its gram,
  and the titles' grams open the buckets they fall into.

Names are found one by one; a video that holds a title and an artist is then looked up among the
songs by their song_id. So a title of very many songs costs its own occurrences only.

What is stored: tracks with their song, songs with their tracks, their names, videos, both indexes,
how often titles use a gram, and the matched pairs by song and by video. All of it changes by one commit (see
`sinks.store`), so a batch that is lost half-way can simply be run again.

A track that moves to another song (new name, new artist) takes its direct row along; a
song without tracks keeps its pairs but is not part of the mapping. A title that changes is
filed again, and pairs that it no longer holds drop out when the mapping is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import song_id
from lodestrata.operators.containment import (
    LEVELS,
    holds,
    level_of,
    of_used_grams,
    part_grams,
    parts_of,
    text_grams_of,
    together,
)
from lodestrata.plans import mapping
from lodestrata.plans.mapping import SONG
from lodestrata.session import spread, stage
from lodestrata.sinks.store import Change, Store, Table

PARTS = ["song_title_normalized", "artist_name_normalized"]
_SONG = "song_id STRING, song_title_normalized STRING, artist_name_normalized STRING"
_TRACK = f"track_id STRING, track_name STRING, isrc_code STRING, {_SONG}"
_VIDEO = "video_id STRING, title STRING, channel_id STRING, view_count BIGINT, title_normalized STRING"

TABLES = {
    "tracks": Table(_TRACK, ("track_id",), updates=("track_name", "isrc_code", *SONG)),
    "songs": Table(f"{_SONG}, tracks BIGINT", ("song_id",)),
    "videos": Table(_VIDEO, ("video_id",), updates=("title", "channel_id", "view_count", "title_normalized")),
    "title_grams": Table("gram BIGINT, video_id STRING", by=("gram",)),
    "gram_counts": Table("gram BIGINT, n BIGINT", by=("gram",)),
    "song_names": Table("_part STRING, _use INT", by=("_part",)),
    "song_grams": Table("gram BIGINT, _part STRING, _use INT", by=("gram",)),
    "song_tracks": Table("song_id STRING, track_id STRING", ("song_id", "track_id"), by=("song_id",)),
    "pairs": Table("song_id STRING, video_id STRING", ("song_id", "video_id"), by=("song_id",)),
    "video_songs": Table("song_id STRING, video_id STRING", by=("video_id",)),
}
#: Folders of a bucket of an index above which `update` joins them.
MOST_FOLDERS = 16


class Matcher:
    """The stored mapping below one folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64) -> None:
        self.store = Store(spark, root, TABLES, buckets)
        #: Folders of the indexes that the last update has opened.
        self.opened: dict[str, list[str]] = {}

    def update(self, tracks: DataFrame, videos: DataFrame, afresh: bool = False) -> DataFrame:
        """Take in tracks and videos, one row each: new ones and such as may have changed.

        ``tracks`` as from `mapping.song_tracks`, ``videos`` from `mapping.matchable_videos`.
        ``afresh`` forgets what is stored, in the same commit. Returns the songs (song_id) whose
        rows of the mapping may differ from before.
        """
        change = self.store.change()
        if afresh:
            change.clear()
        tracks = stage(tracks.select(*self.store.tables["tracks"].struct().names), "tracks")
        videos = stage(videos.select(*self.store.tables["videos"].struct().names), "videos")
        fresh, left = self._take_tracks(change, tracks)
        known = self._known_songs(change, *self._take_videos(change, videos))
        found = self._all_titles(change, fresh).unionByName(known).distinct()
        found = stage(found, "found")
        old = change.read("pairs", self.store.touched("pairs", found))
        more = stage(found.join(old, ["song_id", "video_id"], "left_anti"), "more_pairs")
        change.append("pairs", more)
        change.append("video_songs", more)
        theirs = change.read("video_songs", self.store.touched("video_songs", videos))
        theirs = theirs.join(videos, "video_id", "left_semi").select("song_id")
        touched = tracks.select("song_id").unionByName(left).unionByName(theirs).distinct()
        touched = stage(touched, "touched_songs")
        for name in ("title_grams", "gram_counts", "song_names", "song_grams", "pairs", "video_songs"):
            if any(len(f) > MOST_FOLDERS for f in change.folders(name).values()):
                change.compact(name)
        change.commit()
        return touched

    def _take_tracks(self, change: Change, tracks: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Store the tracks and file them under their songs; new songs, and songs that lost tracks."""
        store = self.store
        buckets = store.touched("tracks", tracks)
        before = change.read("tracks", buckets).select("track_id", F.struct(*SONG).alias("old"))
        moved = tracks.select("track_id", F.struct(*SONG).alias("new")).join(before, "track_id", "left")
        moved = moved.filter(F.col("old").isNull() | (F.col("old.song_id") != F.col("new.song_id")))
        moved = stage(moved, "moved_tracks")
        steps = F.array(
            F.struct(F.col("new").alias("song"), F.lit(1).alias("step")),
            F.struct(F.col("old").alias("song"), F.lit(-1).alias("step")),
        )
        counts = moved.select(F.explode(steps).alias("s")).filter("s.song IS NOT NULL")
        counts = counts.groupBy("s.song").agg(F.sum("s.step").alias("tracks")).select("song.*", "tracks")
        counts = stage(counts, "song_counts")
        seen = change.read("songs", store.touched("songs", counts)).select("song_id")
        fresh = counts.join(seen, "song_id", "left_anti").select(*SONG)
        fresh = stage(fresh, "songs")

        def summed(old: DataFrame, new: DataFrame) -> DataFrame:
            both = old.unionByName(new)
            first = [F.first(c).alias(c) for c in PARTS]
            return both.groupBy("song_id").agg(*first, F.sum("tracks").alias("tracks"))

        change.rewrite("songs", counts, summed)
        left = moved.filter("old IS NOT NULL").select("old.song_id", "track_id")
        joined = moved.select("new.song_id", "track_id")
        change.rewrite(
            "song_tracks",
            joined.unionByName(left),
            lambda old, _: old.join(left, ["song_id", "track_id"], "left_anti").unionByName(joined),
        )
        change.merge("tracks", tracks)
        return fresh, left.select("song_id")

    def _take_videos(self, change: Change, videos: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Store the videos and file the grams of new titles.

        (video_id, title_normalized) of these, their (gram, video_id) and (gram, n). The grams are made
        once, over all cores: the titles of a batch may fit a single split of a file.
        """
        before = change.read("videos", self.store.touched("videos", videos))
        before = before.select("video_id", "title_normalized")
        titles = videos.select("video_id", "title_normalized")
        titles = stage(titles.join(before, ["video_id", "title_normalized"], "left_anti"), "titles")
        change.merge("videos", videos)
        grams = spread(titles).select("video_id", F.explode(text_grams_of(F.col("title_normalized"))).alias("gram"))
        grams = change.append("title_grams", grams)
        counts = change.append("gram_counts", grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
        return titles, grams, counts

    def _known_songs(
        self, change: Change, titles: DataFrame, grams: DataFrame, counts: DataFrame
    ) -> DataFrame:
        """Pairs of new titles and songs that are known already."""
        buckets = self.store.touched("song_grams", counts) if change.folders("song_grams") else []
        self.opened["song_grams"] = change.files("song_grams", buckets)
        if not self.opened["song_grams"]:
            return titles.sparkSession.createDataFrame([], "song_id STRING, video_id STRING")
        names = change.read("song_grams", buckets)
        met = self._met(self._near(grams, names), titles)
        songs = change.read("songs", self.store.touched("songs", met)).select(*SONG)
        return met.join(songs, SONG).select("song_id", "video_id")

    def _all_titles(self, change: Change, fresh: DataFrame) -> DataFrame:
        """Pairs of new songs and all titles; files the songs' names under their grams."""
        store = self.store
        some = fresh.filter("song_title_normalized <> '' AND artist_name_normalized <> ''")
        names = stage(parts_of(some, PARTS), "names")
        each = names.select("*", F.explode(part_grams(F.col("_part"))).alias("gram"))
        counts = change.read("gram_counts", store.touched("gram_counts", each))
        counts = counts.groupBy("gram").agg(F.sum("n").alias("n"))
        rated = each.join(counts, "gram", "left")
        rated = rated.select("_part", "_use", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram").alias("key"))
        rarest = rated.groupBy("_part", "_use").agg(F.min("key").alias("key"))
        filed = stage(rarest.select(F.col("key.gram").alias("gram"), "_part", "_use", "key.n"), "filed")
        known = change.read("song_names", store.touched("song_names", filed))
        new = stage(filed.drop("n").join(known, ["_part", "_use"], "left_anti"), "new_names")
        change.append("song_names", new)
        change.append("song_grams", new)
        # A song is looked up by the rarer of its names; its other name is looked for in what that finds.
        both = some.select("song_id", F.explode(F.array(*PARTS)).alias("_part")).join(filed, "_part")
        both = both.groupBy("song_id").agg(F.min(F.struct("n", "_part", "gram")).alias("key"))
        asked = stage(both.select("key._part", "key.gram").distinct(), "asked")
        buckets = store.touched("title_grams", asked)
        self.opened["title_grams"] = change.files("title_grams", buckets)
        near = change.read("title_grams", buckets).join(asked, "gram").drop("gram").distinct()
        near = stage(near, "candidates")
        texts = change.read("videos", store.touched("videos", near)).select("video_id", "title_normalized")
        held = near.join(texts, "video_id").filter(F.contains("title_normalized", "_part")).drop("_part")
        held = stage(held.distinct(), "held")
        # Only grams of the lengths that the new names are filed under are asked for.
        levels = filed.agg(F.collect_set(level_of(F.col("_part")))).first()[0] or LEVELS[:1]
        probes = text_grams_of(F.col("title_normalized"), levels)
        probes = spread(held).select("video_id", F.explode(probes).alias("gram"))
        return self._met(self._near(probes, filed.drop("n")), held).join(some, SONG).select("song_id", "video_id")

    def _near(self, grams: DataFrame, names: DataFrame) -> DataFrame:
        """(video_id, _part, _use): names whose gram a title has, of (video_id, gram)."""
        return of_used_grams(grams, names, "gram").join(names, "gram").drop("gram").distinct()

    def _met(self, near: DataFrame, titles: DataFrame) -> DataFrame:
        """Candidates (video_id, _part, _use) -> the songs that a title would match, and the video."""
        found = near.join(titles, "video_id").filter(F.contains("title_normalized", "_part"))
        found = together(found.select("video_id", "_part", "_use"), "video_id", PARTS)
        return stage(found.withColumn("song_id", song_id(*PARTS)), "met")

    def tracks(self) -> DataFrame:
        return self.store.read("tracks")

    def mapping(self, as_of: Column, **options) -> DataFrame:
        """The mapping table as `mapping.song_mapping` makes it of all tracks and videos."""
        songs = self.store.read("songs").filter("tracks > 0").drop("tracks")
        pairs = self.store.read("pairs").join(songs, "song_id").join(self.store.read("videos"), "video_id")
        pairs = pairs.filter(holds(F.col("title_normalized"), PARTS))
        return mapping.assemble(self.tracks(), pairs, as_of, **options)


    def mapping_of(self, touched: DataFrame, as_of: Column, **options) -> DataFrame:
        """Rows of the mapping of some songs (song_id); reads the buckets they need."""
        store = self.store

        def near(name: str, rows: DataFrame, key: str) -> DataFrame:
            return store.read(name, store.touched(name, rows)).join(rows.select(key), key, "left_semi")

        ids = stage(near("song_tracks", touched, "song_id"), "their_tracks")
        pairs = stage(near("pairs", touched, "song_id"), "their_pairs")
        songs = near("songs", touched, "song_id").filter("tracks > 0").drop("tracks")
        met = pairs.join(songs, "song_id").join(near("videos", pairs, "video_id"), "video_id")
        met = met.filter(holds(F.col("title_normalized"), PARTS))
        return mapping.assemble(near("tracks", ids, "track_id"), met, as_of, **options)

