"""Page extraction; search pages are events wrapped in the two page layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.catalog import roles
from lodestrata.catalog.registry import query
from lodestrata.catalog.roles import cents, event_k, padded, table, text
from lodestrata.functions import parse_view_count
from lodestrata.functions.html import elements, elements_containing
from lodestrata.operators import pages
from lodestrata.plans import bronze, silver
from lodestrata.session import spread, stage


@query(
    r"""SELECT page_id, pos, script, contains(script, 'track(') AS tracking FROM (
      SELECT page_id, unnest(s) AS script, (generate_subscripts(s, 1) - 1)::INT AS pos FROM (
        SELECT page_id, regexp_extract_all(html, '(?is)<script\b[^>]*>(.*?)</script\s*>', 1) AS s FROM pages))"""
)
def page_scripts(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select(
        "page_id", F.posexplode(elements("html", "script")).alias("pos", "script")
    )
    return rows.withColumn("tracking", F.contains("script", F.lit("track(")))


@query(
    r"""SELECT page_id, len(list_filter(regexp_extract_all(html, '(?is)<a\b[^>]*>(.*?)</a\s*>', 1),
        lambda x: contains(x, 'the')))::INT AS links,
      nullif(regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1), '') AS title FROM pages"""
)
def page_elements(spark, sf_dir):
    """Elements chosen by tag and by the text they hold."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.size(elements_containing("html", "a", "the")).alias("links"),
        F.nullif(F.get(elements("html", "title"), F.lit(0)), F.lit("")).alias("title"),
    )


@query(
    """SELECT page_id, u.pos::INT AS pos, u.tag, u.inner FROM (SELECT page_id, unnest([
      {'pos': 0, 'tag': 'div', 'inner': page_id || '<div>' || coalesce(url, '') || '</div>!<!-- <div>no</div> -->'},
      {'pos': 1, 'tag': 'div', 'inner': coalesce(url, '')},
      {'pos': 2, 'tag': 'div', 'inner': 'open <DIV id=2>' || page_id},
      {'pos': 3, 'tag': 'div', 'inner': page_id::VARCHAR},
      {'pos': 0, 'tag': 'p', 'inner': 'one'}, {'pos': 1, 'tag': 'p', 'inner': coalesce(url, '')}]) AS u FROM pages)"""
)
def page_nested(spark, sf_dir):
    """Elements within their own kind, unclosed, closed too often, and such in comments and scripts."""
    source = text(
        '<div class="x">', F.col("page_id"), "<div>", F.coalesce("url", F.lit("")),
        "</div>!<!-- <div>no</div> --></div></div><p>one<p>", F.coalesce("url", F.lit("")),
        '</p><script>"<div>"</script><div>open <DIV id=2>', F.col("page_id"),
    )
    rows = table(spark, sf_dir, "pages").select("page_id", source.alias("html"))
    found = [
        rows.select("page_id", F.posexplode(elements("html", tag)).alias("pos", "inner")).withColumn("tag", F.lit(tag))
        for tag in ("div", "p")
    ]
    return found[0].unionByName(found[1])


def _video_renderer():
    c = F.col
    run = F.struct(
        text("Supplier#", padded(c("user_id"))).alias("text"),
        F.when(
            c("event_type") != "error",
            F.struct(F.struct(text("C", c("user_id")).alias("browseId")).alias("browseEndpoint")),
        ).alias("navigationEndpoint"),
    )
    return F.struct(
        text("V", c("event_id")).alias("videoId"),
        F.struct(
            F.array(
                F.struct(text(c("event_type"), " ").alias("text")), F.struct(c("k").cast("string").alias("text"))
            ).alias("runs")
        ).alias("title"),
        F.struct(F.array(run).alias("runs")).alias("ownerText"),
        F.struct(
            F.array(F.struct(F.lit("small").alias("url")), F.struct(text("large-", c("event_id")).alias("url"))).alias(
                "thumbnails"
            )
        ).alias("thumbnail"),
        F.struct(text(c("k"), " days ago").alias("simpleText")).alias("publishedTimeText"),
        F.struct(F.concat(F.format_number(cents(), 0), F.lit(" views")).alias("simpleText")).alias("viewCountText"),
        F.struct(text(c("k"), ":07").alias("simpleText")).alias("lengthText"),
    )


def _search_pages(spark, sf_dir):
    """One search page per event: classic or grid layout, three ways to assign."""
    events = spread(table(spark, sf_dir, "events")).withColumn("k", event_k())
    c = F.col
    video = F.to_json(F.struct(_video_renderer().alias("videoRenderer")))
    channel = F.to_json(
        F.struct(
            F.struct(
                text("C", c("user_id")).alias("channelId"),
                F.struct(text("Supplier#", padded(c("user_id"))).alias("simpleText")).alias("title"),
            ).alias("channelRenderer")
        )
    )
    advert = F.lit('{"adSlotRenderer":{"id":1}}')
    wrapped = F.concat(F.lit('{"richItemRenderer":{"content":'), video, F.lit("}}"))
    inner = F.when(c("event_type") == "view", wrapped).otherwise(video)
    classic = F.concat(
        F.lit('{"sectionListRenderer":{"contents":[{"itemSectionRenderer":{"contents":['),
        F.concat_ws(",", advert, inner, channel),
        F.lit("]}}]}}"),
    )
    grid = F.concat(
        F.lit('{"richGridRenderer":{"contents":['),
        wrapped,
        F.lit(',{"continuationItemRenderer":{}}]}}'),
    )
    data = F.concat(
        F.lit('{"contents":{"twoColumnSearchResultsRenderer":{"primaryContents":'),
        F.when(c("event_type") == "click", grid).otherwise(classic),
        F.lit('}},"metadata":{"channelMetadataRenderer":{"externalId":"'),
        text("C", c("user_id")),
        F.lit('"}}}'),
    )
    prefix = (
        F.when(c("event_type") == "purchase", 'window["ytInitialData"] = ')
        .when(c("event_type") == "signup", "ytInitialData=")
        .otherwise("var ytInitialData = ")
    )
    html = F.concat(
        F.lit('<html><head><script>var a = "ytInitialData";</script></head><body><script nonce="x">'),
        prefix,
        data,
        F.lit(";</script><p>text</p></body></html>"),
    )
    rows = events.select(F.col("event_id").alias("page_id"), "ts", html.alias("html"))
    return pages.with_document(rows)


@query(
    """SELECT event_id AS page_id, CASE event_type WHEN 'click' THEN 0 ELSE 1 END AS entry_pos,
      'V' || event_id AS video_id, event_type || ' ' || k AS title,
      'Supplier#' || lpad(user_id::VARCHAR, 9, '0') AS channel_title,
      CASE WHEN event_type = 'error' THEN '' ELSE 'C' || user_id END AS channel_id,
      k || ' days ago' AS published_at, 'large-' || event_id AS thumbnail_url,
      round(value * 100)::BIGINT AS views, k || ':07' AS duration
    FROM (SELECT *, props::JSON->>'k' AS k FROM events)"""
)
def page_items(spark, sf_dir):
    rows = pages.search_items(_search_pages(spark, sf_dir))
    return rows.withColumn("views", parse_view_count("view_count")).drop("view_count")


@query(
    """SELECT event_id AS page_id, 2 AS entry_pos, 'C' || user_id AS channel_id,
      'Supplier#' || lpad(user_id::VARCHAR, 9, '0') AS channel_name FROM events WHERE event_type <> 'click'"""
)
def page_channels(spark, sf_dir):
    return pages.search_channels(_search_pages(spark, sf_dir))


@query("""SELECT event_id AS page_id, 'C' || user_id AS channel_id FROM events""")
def page_channel_id(spark, sf_dir):
    return pages.channel_page_id(_search_pages(spark, sf_dir))


@query("""SELECT 'V' || event_id AS video_id, 'C' || user_id AS channel_id FROM events""")
def channel_fallback(spark, sf_dir):
    """Items without a channel id get the channel of that name."""
    found = stage(_search_pages(spark, sf_dir), "pages")
    items = pages.search_items(found)
    return pages.fill_channel(items, pages.search_channels(found)).select("video_id", "channel_id")


@query(
    """SELECT 'V' || event_id AS video_id, event_type || ' ' || k AS title, round(value * 100)::BIGINT AS view_count,
      k::INT * 60 + 7 AS duration_seconds, ts - to_days(k::INT) AS published_at_parsed
    FROM (SELECT *, props::JSON->>'k' AS k FROM events)"""
)
def page_to_silver(spark, sf_dir):
    """Search pages all the way to silver videos."""
    found = stage(_search_pages(spark, sf_dir).drop("html"), "pages")
    documents = pages.item_documents(pages.search_items(found))
    messages = documents.join(found.select("page_id", "ts"), "page_id").select(
        roles.text("P", F.col("page_id")).alias("raw_id"), "value", F.col("ts").alias("ingested_at")
    )
    rows = silver.videos(silver.youtube_items(bronze.bronze_youtube(messages, roles.BATCH)))
    return rows.select("video_id", "title", "view_count", "duration_seconds", "published_at_parsed")
