"""Search pages to item rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.functions import is_blank, normalize, or_default
from lodestrata.functions.html import embedded_json, joined_runs


def with_document(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with the JSON document they embed, as text; null if there is none."""
    return pages.withColumn("document", embedded_json(html))


def _entries(document: Column) -> Column:
    """All entries of a search page, in order, whichever layout it uses."""
    primary = document["contents"]["twoColumnSearchResultsRenderer"]["primaryContents"]
    classic = primary["sectionListRenderer"]["contents"]
    grid = primary["richGridRenderer"]["contents"]
    sections = F.when(F.size(classic) > 0, classic).otherwise(grid)

    def of_section(section: Column) -> Column:
        listed = section["itemSectionRenderer"]["contents"]
        single = section["richItemRenderer"]["content"]
        return (
            F.when(F.size(listed) > 0, listed)
            .when(single.isNotNull(), F.array(single))
            .otherwise(F.slice(listed, 1, 0))
        )

    return F.flatten(F.filter(F.transform(sections, of_section), lambda s: s.isNotNull()))


def _exploded(pages: DataFrame, page_id: str) -> DataFrame:
    parsed = pages.select(page_id, F.from_json("document", schemas.SEARCH_PAGE).alias("d"))
    return parsed.select(page_id, F.posexplode(_entries(F.col("d"))).alias("entry_pos", "entry"))


def search_items(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Videos of search pages; entries that are no videos are left out."""
    e = F.col("entry")
    video = F.coalesce(e["videoRenderer"], e["richItemRenderer"]["content"]["videoRenderer"])
    rows = _exploded(pages, page_id).select(page_id, "entry_pos", video.alias("v"))
    v = F.col("v")
    owner = F.try_element_at(v["ownerText"]["runs"], F.lit(1))
    thumbnail = F.try_element_at(v["thumbnail"]["thumbnails"], F.lit(-1))["url"]
    return rows.filter(v.isNotNull()).select(
        page_id,
        "entry_pos",
        or_default(v["videoId"], "").alias("video_id"),
        joined_runs(v["title"]["runs"]).alias("title"),
        or_default(owner["text"], "").alias("channel_title"),
        or_default(owner["navigationEndpoint"]["browseEndpoint"]["browseId"], "").alias("channel_id"),
        or_default(v["publishedTimeText"]["simpleText"], "").alias("published_at"),
        or_default(thumbnail, "").alias("thumbnail_url"),
        or_default(v["viewCountText"]["simpleText"], "").alias("view_count"),
        or_default(v["lengthText"]["simpleText"], "").alias("duration"),
    )


def item_documents(items: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Items in the response shape bronze takes, one message per item."""
    item = F.struct(
        F.struct(F.col("video_id").alias("videoId")).alias("id"),
        F.struct(
            "title",
            F.col("channel_title").alias("channelTitle"),
            F.col("channel_id").alias("channelId"),
            F.col("published_at").alias("publishedAt"),
            F.struct(F.struct(F.col("thumbnail_url").alias("url")).alias("default")).alias(
                "thumbnails"
            ),
        ).alias("snippet"),
        F.struct(F.col("view_count").alias("viewCount")).alias("statistics"),
        F.struct("duration").alias("contentDetails"),
    )
    return items.select(page_id, "entry_pos", F.to_json(F.struct(item.alias("items"))).alias("value"))


def search_channels(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Channels listed on search pages."""
    c = F.col("entry.channelRenderer")
    return (
        _exploded(pages, page_id)
        .filter(c.isNotNull())
        .select(
            page_id,
            "entry_pos",
            c["channelId"].alias("channel_id"),
            c["title"]["simpleText"].alias("channel_name"),
        )
    )


def channel_page_id(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """The channel a channel page is about."""
    return pages.select(
        page_id,
        F.from_json("document", schemas.SEARCH_PAGE)["metadata"]["channelMetadataRenderer"][
            "externalId"
        ].alias("channel_id"),
    )


def fill_channel(items: DataFrame, channels: DataFrame) -> DataFrame:
    """Give items without a channel id the first channel of that name."""
    by_name = channels.groupBy(normalize("channel_name").alias("_name")).agg(
        F.min("channel_id").alias("_channel")
    )
    keyed = items.withColumn("_name", normalize("channel_title"))
    joined = keyed.join(by_name.filter("_name <> ''"), "_name", "left")
    filled = F.when(is_blank("channel_id"), F.coalesce("_channel", F.lit(""))).otherwise(
        F.col("channel_id")
    )
    return joined.withColumn("channel_id", filled).drop("_name", "_channel")
