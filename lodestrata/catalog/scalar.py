"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.catalog.registry import query
from lodestrata.catalog.roles import cents, event_k, padded, table, text, unicode_norm
from lodestrata.functions import (
    ascii_fold,
    build_url,
    cache_key,
    clamp,
    elapsed_seconds,
    generate_id,
    normalize,
    parse_duration,
    parse_published,
    parse_view_count,
    query_map,
    query_string,
    release_date,
    song_id,
    strip_at,
    utc_instant,
    wall_clock_stamp,
)
from lodestrata.session import spread

_NORM = unicode_norm("text")


@query(
    f"""SELECT 'documents' AS origin, doc_id AS id, {_NORM} AS normalized FROM documents
    UNION ALL SELECT 'benchmark', item_id, {_NORM} FROM benchmark
    UNION ALL SELECT 'conversations', conv_id * 1000 + turn, {_NORM} FROM conversations"""
)
def normalize_text(spark, sf_dir):
    sources = {
        "documents": F.col("doc_id"),
        "benchmark": F.col("item_id"),
        "conversations": F.col("conv_id") * 1000 + F.col("turn"),
    }
    parts = [
        spread(table(spark, sf_dir, name)).select(
            F.lit(name).alias("origin"), key.alias("id"), normalize("text").alias("normalized")
        )
        for name, key in sources.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    r"""SELECT p_partkey, md5(title || '|' || brand)[1:16] AS song_id, md5(p_partkey::VARCHAR) AS part_id,
      'crawler:spotify:' || md5(p_name) AS key
    FROM (SELECT *, regexp_replace(lower(p_name), '[^\w\s]', '', 'g') AS title,
            regexp_replace(lower(p_brand), '[^\w\s]', '', 'g') AS brand FROM part)""",
    name="song_id",
)
def song_id_query(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        song_id(normalize("p_name"), normalize("p_brand")).alias("song_id"),
        generate_id("p_partkey").alias("part_id"),
        cache_key("spotify", "p_name").alias("key"),
    )


@query(
    """SELECT event_id, CASE event_type WHEN 'signup' THEN 0 ELSE c END AS views,
      CASE event_type WHEN 'signup' THEN 0 WHEN 'error' THEN k * 1000 + k % 10 * 100 WHEN 'view' THEN k * 1000000
        ELSE c END AS views_scaled,
      CASE event_type WHEN 'error' THEN (k::VARCHAR || (k % 10)::VARCHAR)::BIGINT
        WHEN 'view' THEN k WHEN 'signup' THEN 0 ELSE c END AS views_plain
    FROM (SELECT *, (props::JSON->>'k')::BIGINT AS k, round(value * 100)::BIGINT AS c FROM events)"""
)
def parse_views(spark, sf_dir):
    k = F.col("k")
    grouped = F.concat(F.format_number(cents(), 0), F.lit(" views"))
    shown = F.when(F.col("event_type") == "signup", "No views").otherwise(grouped)
    short = (
        F.when(F.col("event_type") == "signup", "")
        .when(F.col("event_type") == "error", text(k, ".", k % 10, "K views"))
        .when(F.col("event_type") == "view", text(k, "M views"))
        .otherwise(grouped)
    )
    events = table(spark, sf_dir, "events").withColumn("k", event_k())
    return events.select(
        "event_id",
        parse_view_count(shown).alias("views"),
        parse_view_count(short, suffix=True).alias("views_scaled"),
        parse_view_count(short).alias("views_plain"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
      CASE WHEN l_returnflag = 'R' THEN 0 WHEN l_returnflag = 'N' THEN 0 ELSE q * 60 + l_linenumber END AS seconds,
      CASE WHEN l_returnflag = 'R' THEN 3600 * l_linenumber + q * 60 + l_linenumber
        WHEN l_returnflag = 'N' THEN 0 ELSE q * 60 + l_linenumber END AS seconds_hms
    FROM (SELECT *, l_quantity::INT AS q FROM lineitem)"""
)
def parse_durations(spark, sf_dir):
    q, n = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    two = text(q, ":", F.lpad(n.cast("string"), 2, "0"))
    shown = (
        F.when(F.col("l_returnflag") == "R", text(n, ":", two))
        .when(F.col("l_returnflag") == "N", q.cast("string"))
        .otherwise(two)
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        parse_duration(shown).alias("seconds"),
        parse_duration(shown, hms=True).alias("seconds_hms"),
    )


@query(
    """SELECT event_id, CASE event_type
        WHEN 'click' THEN ts - to_years(k::INT) WHEN 'view' THEN ts - to_months(k::INT)
        WHEN 'error' THEN ts - to_days(7 * k::INT) WHEN 'signup' THEN ts - to_hours(k)
        ELSE date_trunc('second', ts) END AS published
    FROM (SELECT *, (props::JSON->>'k')::BIGINT AS k FROM events)"""
)
def relative_date(spark, sf_dir):
    k, kind = F.col("k"), F.col("event_type")
    shown = (
        F.when(kind == "click", text(k, " years ago"))
        .when(kind == "view", text("Streamed ", k, " months ago"))
        .when(kind == "error", text(k, " weeks ago"))
        .when(kind == "signup", text(k, " hours ago"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    events = table(spark, sf_dir, "events").withColumn("k", event_k())
    return events.select("event_id", parse_published(shown, "ts").alias("published"))


@query(
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN date_trunc('year', o_orderdate)
      WHEN 'F' THEN date_trunc('month', o_orderdate) ELSE o_orderdate END::DATE AS release_date FROM orders"""
)
def release_date_precision(spark, sf_dir):
    status = F.col("o_orderstatus")
    shown = (
        F.when(status == "O", F.date_format("o_orderdate", "yyyy"))
        .when(status == "F", F.date_format("o_orderdate", "yyyy-MM"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    precision = F.when(status == "O", "year").when(status == "F", "month").otherwise("day")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", release_date(shown, precision).alias("release_date")
    )


@query(
    """SELECT event_id, strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') AS stamp,
      floor(epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(ts))::BIGINT AS seconds_left FROM events"""
)
def audit_stamp(spark, sf_dir):
    end = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        "event_id",
        wall_clock_stamp(utc_instant("ts")).alias("stamp"),
        elapsed_seconds("ts", end).alias("seconds_left"),
    )


@query(
    """SELECT page_id, split_part(kv, '=', 1) AS key, split_part(kv, '=', 2) AS value FROM (
      SELECT page_id, unnest(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&')) AS kv FROM pages)
    WHERE split_part(kv, '=', 2) <> ''"""
)
def url_query_map(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(query_map("url")))


@query(
    """SELECT s_suppkey, 'https://api.example/search?q=Supplier%23' || lpad(s_suppkey::VARCHAR, 9, '0')
      || '&maxResults=' || CASE WHEN s_nationkey < 1 OR s_nationkey > 20 THEN 20 ELSE s_nationkey END
      || '&type=channel' AS url, 3::INT AS parameters FROM supplier"""
)
def url_build(spark, sf_dir):
    url = build_url(
        "https://api.example",
        "/search",
        {"q": F.col("s_name"), "maxResults": clamp("s_nationkey", 1, 20), "type": F.lit("channel")},
    )
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", url.alias("url"))
    # Reading the query back and writing it again must give the same URL.
    again = F.concat(F.regexp_extract("url", r"^([^?]*\?)", 1), query_string(query_map("url")))
    return rows.select("s_suppkey", again.alias("url"), F.size(query_map("url")).alias("parameters"))


@query("""SELECT user_id, event_id, 'supplier' || lpad(user_id::VARCHAR, 9, '0') AS handle FROM events""")
def channel_handle(spark, sf_dir):
    shown = text("@@Supplier", padded(F.col("user_id")))
    return table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.lower(strip_at(shown)).alias("handle")
    )


@query(
    r"""SELECT doc_id, regexp_replace(strip_accents(text), '[^\x{00}-\x{7f}]', '', 'g') AS folded FROM documents""",
    name="ascii_fold",
)
def ascii_fold_query(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents")).select("doc_id", ascii_fold("text").alias("folded"))
