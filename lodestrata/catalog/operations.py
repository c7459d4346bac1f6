"""Merges, data quality, monitoring, backlog and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.catalog import roles
from lodestrata.catalog.registry import query
from lodestrata.catalog.roles import (
    ARTIST,
    AS_OF,
    BATCH,
    CHECKS,
    DOCS,
    RUNS,
    TODAY,
    as_of,
    event_k,
    table,
    text,
    today,
)
from lodestrata.operators import backlog, monitoring, profile, quality
from lodestrata.operators.latest import pick_version
from lodestrata.operators.merge import insert_if_absent, merge_patch, merge_upsert
from lodestrata.plans import silver
from lodestrata.session import shared_folder
from lodestrata.sinks.messages import bulk_rows, message_rows
from lodestrata.sinks.tables import write_partitions, write_staging
from lodestrata.sources.tables import find_one, register, run_query

# Merges ------------------------------------------------------------------------

_COLS = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]


def _old_and_new(spark, sf_dir):
    """Customers of all but one segment as the target; that one and some nations as updates."""
    c = table(spark, sf_dir, "customer")
    old = c.filter("c_mktsegment <> 'BUILDING'").select(*_COLS)
    new = c.filter("c_nationkey >= 10 OR c_mktsegment = 'BUILDING'").select(
        "c_custkey",
        F.concat("c_name", F.lit(" *")).alias("c_name"),
        (-F.col("c_acctbal")).alias("c_acctbal"),
        "c_mktsegment",
    )
    return old, new


_MERGE = """WITH old AS (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'),
    new AS (SELECT * FROM customer WHERE c_nationkey >= 10 OR c_mktsegment = 'BUILDING') """


@query(
    _MERGE
    + """SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
      CASE WHEN o.c_custkey IS NOT NULL THEN o.c_name ELSE n.c_name || ' *' END AS c_name,
      CASE WHEN n.c_custkey IS NOT NULL THEN -n.c_acctbal ELSE o.c_acctbal END AS c_acctbal,
      coalesce(o.c_mktsegment, n.c_mktsegment) AS c_mktsegment
    FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey"""
)
def upsert_merge(spark, sf_dir):
    old, new = _old_and_new(spark, sf_dir)
    return merge_upsert(old, new, ["c_custkey"], ["c_acctbal"])


@query(
    _MERGE
    + """SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
      CASE WHEN n.c_custkey IS NOT NULL THEN n.c_name || ' *' ELSE o.c_name END AS c_name,
      CASE WHEN n.c_custkey IS NOT NULL THEN -n.c_acctbal ELSE o.c_acctbal END AS c_acctbal,
      coalesce(o.c_mktsegment, n.c_mktsegment) AS c_mktsegment
    FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey"""
)
def upsert_all_columns(spark, sf_dir):
    old, new = _old_and_new(spark, sf_dir)
    return merge_upsert(old, new, ["c_custkey"])


@query(
    """SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem"""
)
def insert_absent(spark, sf_dir):
    """Junction rows: returned lines first, then all lines where the pair is new."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    pair = ["l_orderkey", "l_suppkey"]
    first = lines.filter("l_returnflag = 'R'").select(*pair).distinct()
    return insert_if_absent(first, lines.select(*pair), pair)


@query(
    """SELECT c_custkey, key, value FROM (
      SELECT c_custkey, 'name' AS key, c_name AS value FROM customer WHERE c_mktsegment <> 'BUILDING'
      UNION ALL SELECT c_custkey, 'segment',
        CASE WHEN c_nationkey >= 10 OR c_mktsegment = 'BUILDING' THEN lower(c_mktsegment) ELSE c_mktsegment END
        FROM customer
      UNION ALL SELECT c_custkey, 'nation', c_nationkey::VARCHAR FROM customer
        WHERE c_nationkey >= 10 OR c_mktsegment = 'BUILDING')"""
)
def patch_merge(spark, sf_dir):
    """Patches set one known and one new field; other fields stay."""
    c = table(spark, sf_dir, "customer")
    old = c.filter("c_mktsegment <> 'BUILDING'").select(
        "c_custkey",
        F.create_map(F.lit("name"), "c_name", F.lit("segment"), "c_mktsegment").alias("document"),
    )
    patch = c.filter("c_nationkey >= 10 OR c_mktsegment = 'BUILDING'").select(
        "c_custkey",
        F.create_map(
            F.lit("segment"), F.lower("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string")
        ).alias("document"),
    )
    merged = merge_patch(old, patch, "c_custkey")
    return merged.select("c_custkey", F.explode("document"))


# Sinks and sources -----------------------------------------------------------------


@query(
    """SELECT 'customers' AS staged, c_custkey AS id, c_name AS name, c_acctbal AS amount,
      TIMESTAMP '2024-01-31 00:00:00' AS created_at FROM customer
    UNION ALL SELECT 'orders', o_orderkey, o_orderstatus, o_totalprice, TIMESTAMP '2024-01-31 00:00:00' FROM orders"""
)
def json_staging(spark, sf_dir):
    """Staging tables with rows as one JSON value, the empty one left out, read back by field."""
    root = shared_folder(spark)
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("name"), F.col("o_totalprice").alias("amount")
    )
    tables = {"customers": customers, "orders": orders, "nobody": customers.filter("id < 0")}
    staged = write_staging(tables, root, as_of())
    read = [spark.read.parquet(f"{root}/{name}").withColumn("staged", F.lit(name[: -len("_staging")])) for name in staged]
    fields = F.from_json("data", "id BIGINT, name STRING, amount DOUBLE")
    rows = read[0].unionByName(read[1]) if len(read) > 1 else read[0]
    return rows.select("staged", fields.alias("d"), "created_at").select("staged", "d.*", "created_at")


@query(
    """SELECT c_custkey::VARCHAR AS doc_id, 0 AS line, 'customers' AS index_name, c_custkey::VARCHAR AS id,
      NULL AS name FROM customer
    UNION ALL SELECT c_custkey::VARCHAR, 1, NULL, NULL, c_name FROM customer"""
)
def bulk_ndjson(spark, sf_dir):
    """Action and document lines, parsed back."""
    rows = bulk_rows(table(spark, sf_dir, "customer"), "c_custkey", "customers")
    return rows.select(
        "doc_id",
        "line",
        F.get_json_object("value", "$.index._index").alias("index_name"),
        F.get_json_object("value", "$.index._id").alias("id"),
        F.get_json_object("value", "$.c_name").alias("name"),
    )


@query("""SELECT o_orderkey::VARCHAR AS key, o_custkey, o_totalprice FROM orders""")
def publish_messages(spark, sf_dir):
    """Rows as JSON messages with a key, parsed back."""
    rows = message_rows(table(spark, sf_dir, "orders"), key="o_orderkey")
    parsed = F.from_json("value", "o_custkey BIGINT, o_totalprice DOUBLE")
    return rows.select("key", parsed.alias("d")).select("key", "d.*")


@query("""SELECT o_orderpriority, count(*) AS orders, sum(o_totalprice > 100000)::BIGINT AS large
    FROM orders WHERE o_orderdate >= DATE '1996-01-01' GROUP BY 1""")
def sql_query(spark, sf_dir):
    """SQL text over registered tables with bound parameters."""
    register({"orders": table(spark, sf_dir, "orders")})
    return run_query(
        spark,
        """SELECT o_orderpriority, count(*) AS orders, count_if(o_totalprice > :price) AS large
        FROM orders WHERE o_orderdate >= :start GROUP BY ALL""",
        {"price": 100000, "start": "1996-01-01"},
    )


@query("""SELECT * FROM supplier WHERE s_name = 'Supplier#000000003'""")
def point_lookup(spark, sf_dir):
    return find_one(table(spark, sf_dir, "supplier"), F.col("s_name") == "Supplier#000000003")


# Data quality ------------------------------------------------------------------------


def _log(df):
    """Check rows without the run's own stamps."""
    return df.select("table_name", "check_type", "status", "affected_rows", F.get_json_object("details", "$.batch_id").alias("batch_id"), F.get_json_object("details", "$.check").alias("name"))


def _sql_check(table_name: str, kind: str, bad: str, severity: str, name: str, source: str) -> str:
    return f"""SELECT '{table_name}' AS table_name, '{kind}' AS check_type,
      CASE WHEN n = 0 THEN 'pass' ELSE '{severity}' END AS status, n::BIGINT AS affected_rows,
      'batch-1' AS batch_id, '{name}' AS name FROM (SELECT {bad} AS n FROM {source})"""


_MISSING = " UNION ALL ".join(
    [
        _sql_check(
            "lineitem", "missing", "count_if(l_returnflag = 'N')", "warn", "isrc_missing", "lineitem"
        ),
        _sql_check("lineitem", "missing", "count_if(l_partkey IS NULL)", "warn", "l_partkey_missing", "lineitem"),
    ]
)
_LENGTH = " UNION ALL ".join(
    [
        _sql_check("documents", "schema", "count_if(length(text) > 255)", "warn", "text_length_255", "documents"),
        _sql_check("documents", "schema", "count_if(length(lang) > 2)", "warn", "lang_length_2", "documents"),
        _sql_check(
            "orders", "schema", "count_if(abs(round(o_totalprice, 2)) >= 100000)", "warn", "o_totalprice_decimal_7_2", "orders"
        ),
    ]
)
_UNIQUE = " UNION ALL ".join(
    [
        _sql_check(
            "lineitem", "duplicate", "count(*) - count(DISTINCT (l_orderkey, l_linenumber))", "fail", "l_orderkey_l_linenumber_unique", "lineitem"
        ),
        _sql_check("orders", "duplicate", "count(*) - count(DISTINCT o_orderkey)", "fail", "o_orderkey_unique", "orders"),
    ]
)
_FK = " UNION ALL ".join(
    [
        _sql_check(
            "documents", "consistency", "count(*)", "fail", "doc_id_reference",
            "(SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))",
        ),
        _sql_check(
            "orders", "consistency", "count(*)", "fail", "o_custkey_reference",
            "(SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))",
        ),
    ]
)


def _missing(spark, sf_dir):
    code = F.when(F.col("l_returnflag") != "N", text("ISRC", F.col("l_partkey"))).otherwise(F.lit(""))
    lines = table(spark, sf_dir, "lineitem").withColumn("isrc", code)
    lines = lines.withColumn("l_partkey", F.col("l_partkey").cast("string"))
    return quality.check_rows(lines, "lineitem", quality.missing("isrc", "l_partkey"), BATCH, as_of())


def _length(spark, sf_dir):
    docs = quality.check_rows(
        table(spark, sf_dir, "documents"), "documents", quality.too_long({"text": 255, "lang": 2}), BATCH, as_of()
    )
    rules = quality.out_of_decimal("o_totalprice", 7, 2)
    return docs.unionByName(quality.check_rows(table(spark, sf_dir, "orders"), "orders", rules, BATCH, as_of()))


def _unique(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return quality.check_log(
        [
            quality.check_unique(lines, "lineitem", ["l_orderkey", "l_linenumber"], BATCH, as_of()),
            quality.check_unique(orders, "orders", ["o_orderkey"], BATCH, as_of()),
        ]
    )


def _references(spark, sf_dir):
    def t(name):
        return table(spark, sf_dir, name)

    return quality.check_log(
        [
            quality.check_reference(t("documents"), "documents", "doc_id", t("labels"), "doc_id", BATCH, as_of()),
            quality.check_reference(t("orders"), "orders", "o_custkey", t("customer"), "c_custkey", BATCH, as_of()),
        ]
    )


@query(_MISSING)
def dq_missing(spark, sf_dir):
    return _log(_missing(spark, sf_dir))


@query(_LENGTH)
def dq_length(spark, sf_dir):
    return _log(_length(spark, sf_dir))


@query(_UNIQUE)
def dq_unique(spark, sf_dir):
    return _log(_unique(spark, sf_dir))


@query(_FK)
def dq_fk(spark, sf_dir):
    return _log(_references(spark, sf_dir))


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
)
def dq_duplicates(spark, sf_dir):
    return quality.duplicate_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(" UNION ALL ".join([_MISSING, _LENGTH, _UNIQUE, _FK]))
def dq_log(spark, sf_dir):
    """All checks of a run as one log."""
    parts = [f(spark, sf_dir) for f in (_missing, _length, _unique, _references)]
    return _log(quality.check_log(parts))


@query(
    """SELECT l_returnflag, count_if(l_quantity > 45)::BIGINT AS rejected,
      count_if(NOT l_quantity > 45)::BIGINT AS accepted
    FROM lineitem GROUP BY 1"""
)
def dq_reject_split(spark, sf_dir):
    good, bad = quality.split_rejects(table(spark, sf_dir, "lineitem"), F.col("l_quantity") > 45)
    tagged = good.select("l_returnflag", F.lit(0).alias("bad")).unionByName(
        bad.select("l_returnflag", F.lit(1).alias("bad"))
    )
    return tagged.groupBy("l_returnflag").agg(
        F.sum("bad").alias("rejected"), F.sum(1 - F.col("bad")).alias("accepted")
    )


@query(
    f"""WITH {DOCS}, {ARTIST} SELECT 'track_artist' AS child, count(*) AS orphan_rows FROM track_artist
      WHERE artist_id NOT IN (SELECT artist_id FROM artist)
    UNION ALL SELECT 'event_user', count(*) FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)"""
)
def referential_orphans(spark, sf_dir):
    audio = roles.staged_audio(spark, sf_dir, schemas.MAPPING_DOC)
    links = quality.orphans(silver.track_artists(audio), "artist_id", silver.artists(audio), "artist_id")
    users = quality.orphans(table(spark, sf_dir, "events"), "user_id", table(spark, sf_dir, "supplier"), "s_suppkey")

    def total(df, name):
        return df.agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("orphan_rows")).select(
            F.lit(name).alias("child"), "orphan_rows"
        )

    return total(links, "track_artist").unionByName(total(users, "event_user"))


# Monitoring --------------------------------------------------------------------------


def _bronze(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("raw_id"), F.col("ts").alias("ingested_at"), F.col("event_type").alias("source")
    )


@query(f"SELECT count(*) AS row_count FROM events WHERE ts::DATE = DATE '{TODAY}'")
def bronze_today(spark, sf_dir):
    return monitoring.rows_today(_bronze(spark, sf_dir), today())


@query("SELECT count(*) AS row_count FROM events")
def bronze_total(spark, sf_dir):
    return monitoring.total_rows(_bronze(spark, sf_dir))


@query(f"WITH {RUNS} SELECT count(*) AS failed_count FROM runs WHERE status = 'failed'")
def failed_runs(spark, sf_dir):
    return monitoring.failed_runs(roles.run_log(spark, sf_dir))


@query(
    f"""SELECT ts::DATE AS date, event_type AS source, count(*) AS row_count FROM events
    WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1, 2"""
)
def daily_by_source(spark, sf_dir):
    return monitoring.daily_by_source(_bronze(spark, sf_dir), as_of())


@query(
    f"""WITH {RUNS} SELECT started_at::DATE AS date, source, duration_seconds FROM runs
    WHERE started_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY"""
)
def duration_series(spark, sf_dir):
    return monitoring.duration_series(roles.run_log(spark, sf_dir), as_of())


@query(
    f"""WITH {RUNS} SELECT batch_id, source, status, records_raw, records_silver, records_rejected,
      duration_seconds, started_at FROM runs ORDER BY started_at DESC, log_id LIMIT 50"""
)
def latest_runs(spark, sf_dir):
    rows = monitoring.latest(roles.run_log(spark, sf_dir), "started_at", "log_id", 50)
    return rows.drop("log_id")


@query(
    f"""WITH {CHECKS} SELECT table_name, check_type, status, affected_rows, checked_at FROM checks
    ORDER BY checked_at DESC, check_id LIMIT 50"""
)
def latest_checks(spark, sf_dir):
    rows = monitoring.latest(roles.check_rows_log(spark, sf_dir), "checked_at", "check_id", 50)
    return rows.drop("check_id", "details")


@query(
    f"""WITH {CHECKS} SELECT table_name, check_type, status, checked_at, check_id FROM checks
    WHERE checked_at >= TIMESTAMP '{TODAY} 00:00:00'"""
)
def recent_checks(spark, sf_dir):
    start = F.lit(f"{TODAY} 00:00:00").cast("timestamp_ntz")
    return monitoring.recent_checks(roles.check_rows_log(spark, sf_dir), start)


@query(
    f"""WITH {RUNS} SELECT started_at::DATE AS date, sum(records_raw)::BIGINT AS raw,
      sum(records_silver)::BIGINT AS silver FROM runs
    WHERE started_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY GROUP BY 1"""
)
def flow_30d(spark, sf_dir):
    return monitoring.records_flow(roles.run_log(spark, sf_dir), as_of())


_SPARSE = """runs AS (
  SELECT 'S' || user_id AS source, ts AS started_at,
    CASE WHEN event_type = 'purchase' THEN k ELSE 0 END AS records_raw,
    CASE WHEN event_type = 'purchase' THEN k - k % 7 ELSE 0 END AS records_silver,
    CASE WHEN event_type = 'purchase' THEN k % 7 ELSE 0 END AS records_rejected,
    CASE WHEN event_type = 'error' AND k > 90 THEN 'failed' ELSE 'success' END AS status,
    floor(value)::BIGINT AS duration_seconds
  FROM (SELECT *, (props::JSON->>'k')::BIGINT AS k FROM events))"""
_TOTALS = """totals AS (
  SELECT started_at::DATE AS date_id, source, sum(records_raw) AS raw, sum(records_silver) AS silver,
    sum(records_rejected) AS rejected, count_if(status = 'failed') AS failed, max(duration_seconds) AS longest
  FROM runs GROUP BY 1, 2)"""
_ZERO = f"""filled AS (
  SELECT source, unnest(generate_series(a, DATE '{TODAY}', INTERVAL 1 DAY))::DATE AS date_id
  FROM (SELECT source, min(date_id) AS a FROM totals GROUP BY 1)),
silent AS (SELECT date_id, source FROM (
  SELECT source, date_id, coalesce(raw, 0) AS raw,
    lag(coalesce(raw, 0)) OVER (PARTITION BY source ORDER BY date_id) AS before
  FROM filled LEFT JOIN totals USING (source, date_id)) WHERE raw = 0 AND before = 0)"""


def _sparse_runs(spark, sf_dir):
    """Events as runs of many sources; only purchases carry records."""
    k = F.col("k").cast("bigint")
    paid = F.col("event_type") == "purchase"
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", event_k())
        .select(
            text("S", F.col("user_id")).alias("source"),
            F.col("ts").alias("started_at"),
            F.when(paid, k).otherwise(0).alias("records_raw"),
            F.when(paid, k - k % 7).otherwise(0).alias("records_silver"),
            F.when(paid, k % 7).otherwise(0).alias("records_rejected"),
            F.when((F.col("event_type") == "error") & (k > 90), "failed").otherwise("success").alias("status"),
            F.floor("value").cast("bigint").alias("duration_seconds"),
        )
    )


@query(f"WITH {_SPARSE}, {_TOTALS}, {_ZERO} SELECT * FROM silent")
def zero_two_days(spark, sf_dir):
    return monitoring.zero_streaks(monitoring.daily_totals(_sparse_runs(spark, sf_dir)), today())


@query(
    f"""WITH {_SPARSE}, {_TOTALS}, {_ZERO}, none AS (
      SELECT source, date_id, date_id - row_number() OVER (PARTITION BY source ORDER BY date_id)::INT AS island
      FROM filled LEFT JOIN totals USING (source, date_id) WHERE coalesce(raw, 0) = 0)
    SELECT source, min(date_id) AS first_day, max(date_id) AS last_day, count(*)::INT AS days
    FROM none GROUP BY source, island"""
)
def silent_runs(spark, sf_dir):
    """Runs of days on which a source had no records."""
    return monitoring.silent_runs(monitoring.daily_totals(_sparse_runs(spark, sf_dir)), today())


@query(
    f"""WITH {_SPARSE}, {_TOTALS}, {_ZERO}
    SELECT date_id, source, 'low_success_rate' AS rule, 'warning' AS severity FROM totals
      WHERE raw > 0 AND 100.0 * silver / raw < 95
    UNION ALL SELECT date_id, source, 'records_rejected', 'warning' FROM totals WHERE rejected > 0
    UNION ALL SELECT date_id, source, 'slow_run', 'warning' FROM totals WHERE longest > 300
    UNION ALL SELECT date_id, source, 'job_failed', 'critical' FROM totals WHERE failed > 0
    UNION ALL SELECT date_id, source, 'no_records_two_days', 'critical' FROM silent"""
)
def alerts(spark, sf_dir):
    return monitoring.alerts(_sparse_runs(spark, sf_dir), today())


@query(
    """SELECT raw_id, layer FROM (
      SELECT event_id AS raw_id, 'bronze' AS layer FROM events WHERE ts >= TIMESTAMP '2024-02-15 00:00:00' - INTERVAL 30 DAY
      UNION ALL SELECT event_id, 'silver' FROM events WHERE ts >= TIMESTAMP '2024-04-15 00:00:00' - INTERVAL 90 DAY
      UNION ALL SELECT event_id, 'gold' FROM events)"""
)
def retention(spark, sf_dir):
    """What each layer keeps on some later day."""
    rows = _bronze(spark, sf_dir)
    days = {"bronze": "2024-02-15 00:00:00", "silver": "2024-04-15 00:00:00", "gold": "2034-01-01 00:00:00"}
    kept = [
        monitoring.retained(rows, layer, "ingested_at", F.lit(day).cast("timestamp_ntz")).select(
            "raw_id", F.lit(layer).alias("layer")
        )
        for layer, day in days.items()
    ]
    return kept[0].unionByName(kept[1]).unionByName(kept[2])


@query(
    """SELECT event_id, event_type AS batch_id, CASE WHEN event_type = 'error' THEN -1 ELSE user_id END AS user_id
    FROM events"""
)
def backfill_overwrite(spark, sf_dir):
    """All batches written, one of them written again; the others stay."""
    path = f"{shared_folder(spark)}/backfill"
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("batch_id"), "user_id")
    write_partitions(rows, path)
    again = rows.filter("batch_id = 'error'").withColumn("user_id", F.lit(-1).cast("bigint"))
    write_partitions(again, path)
    return spark.read.parquet(path)


# Backlog -------------------------------------------------------------------------------

_DONE_AS_OF = "1998-06-01 00:00:00"


def _catalogue(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        text(F.col("p_name"), " #", F.col("p_partkey")).alias("song"),
        text("SC", F.col("p_partkey")).alias("song_code"),
        F.col("p_brand").alias("original_artist"),
    )


@query(
    f"""SELECT p_name || ' #' || p_partkey AS song, 'SC' || p_partkey AS song_code FROM part
    WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem
      WHERE l_shipdate > TIMESTAMP '{_DONE_AS_OF}' - INTERVAL 7 DAY AND l_shipdate <= TIMESTAMP '{_DONE_AS_OF}')"""
)
def skip_done(spark, sf_dir):
    """Catalogue songs without a completion in the last seven days."""
    now = F.lit(_DONE_AS_OF).cast("timestamp_ntz")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    done = (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_shipdate") <= now)
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(text(F.col("p_name"), " #", F.col("p_partkey")).alias("song"), F.col("l_shipdate").alias("done_at"))
    )
    return backlog.skip_done(_catalogue(spark, sf_dir), done, now).select("song", "song_code")


@query(
    f"""SELECT p_partkey, 'crawler:spotify:' || md5(p_name || ' #' || p_partkey) AS cache_key,
      CASE WHEN e.user_id IS NULL THEN 'MISS' WHEN event_type = 'error' THEN 'STALE' ELSE 'HIT' END AS status
    FROM part LEFT JOIN (SELECT * FROM (SELECT * FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
      WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR) e ON user_id = p_partkey"""
)
def cache_status(spark, sf_dir):
    """Requests against responses fetched within a day, empty ones stale."""
    requests = table(spark, sf_dir, "part").select(
        "p_partkey", text(F.col("p_name"), " #", F.col("p_partkey")).alias("query")
    )
    fetched = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    newest = pick_version(fetched, ["user_id"], [F.col("ts"), F.col("event_id")])
    cache = newest.join(requests, F.col("user_id") == F.col("p_partkey")).select(
        text("crawler:spotify:", F.md5("query")).alias("cache_key"),
        F.when(F.col("event_type") == "error", "[]").otherwise('[{"id":"x"}]').alias("response_items"),
        F.col("ts").alias("stored_at"),
    )
    rows = backlog.cache_status(requests, cache, as_of(), "spotify")
    return rows.select("p_partkey", "cache_key", "status")


@query(
    """WITH cache AS (SELECT user_id, ts AS stored_at, event_type FROM events WHERE event_type <> 'view'
      QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_type <> 'error' DESC) = 1)
    SELECT r.event_id, r.ts, CASE WHEN stored_at IS NULL OR stored_at <= r.ts - INTERVAL 24 HOUR THEN 'MISS'
      WHEN c.event_type = 'error' THEN 'STALE' ELSE 'HIT' END AS status
    FROM (SELECT * FROM events WHERE event_type = 'view') r
    ASOF LEFT JOIN cache c ON r.user_id = c.user_id AND r.ts >= c.stored_at"""
)
def cache_status_as_of(spark, sf_dir):
    """Views as requests, all other events as responses stored before or after."""
    events = table(spark, sf_dir, "events")
    query = text("user ", F.col("user_id"))
    cache = events.filter("event_type <> 'view'").select(
        text("crawler:spotify:", F.md5(query)).alias("cache_key"),
        F.when(F.col("event_type") == "error", "[]").otherwise('[{"id":"x"}]').alias("response_items"),
        F.col("ts").alias("stored_at"),
    )
    requests = events.filter("event_type = 'view'").select("event_id", "ts", query.alias("query"))
    return backlog.cache_status_at(requests, cache, "spotify", "ts").select("event_id", "ts", "status")


_ENRICHED = f"""{DOCS},
audio AS (SELECT l_partkey, s_name AS artist, track_id, p_name FROM docs
  QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, raw_id DESC) = 1),
video AS (SELECT DISTINCT user_id, 'Supplier#' || lpad(props::JSON->>'k', 9, '0') AS artist FROM events),
outcome AS (SELECT p.p_name || ' #' || p_partkey AS song, 'SC' || p_partkey AS song_code, audio.artist, track_id,
  CASE WHEN audio.l_partkey IS NULL THEN 'no_audio' WHEN video.user_id IS NULL THEN 'no_video' ELSE 'success' END AS status
  FROM part p LEFT JOIN audio ON audio.l_partkey = p_partkey
  LEFT JOIN video ON video.user_id = p_partkey AND video.artist = audio.artist)"""


def _enriched(spark, sf_dir):
    """Parts as catalogue songs, lineitem and events as fetched responses."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    song = text(F.col("p_name"), " #", F.col("p_partkey"))
    # Versions are chosen among the rows, so that only the chosen ones travel and are rendered.
    newest = [F.col("l_shipdate"), roles.track_raw_id()]
    documents = roles.as_responses(pick_version(roles.track_rows(spark, sf_dir), ["l_partkey"], newest))
    audio = documents.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        song.alias("query"), F.get_json_object("value", "$.tracks.items").alias("items")
    )
    found = roles.video_rows(spark, sf_dir).filter(F.col("p_name").isNotNull()).withColumn(
        "query", F.concat(song, F.lit(" Supplier#"), roles.padded(F.col("k")))
    )
    video = pick_version(found, ["query"], [F.col("event_id")]).select(
        "query", F.to_json(F.array(roles.video_item())).alias("items")
    )
    return backlog.enrich_catalogue(_catalogue(spark, sf_dir), audio, video)


@query(
    f"""WITH {_ENRICHED} SELECT song, artist, status, CASE WHEN status = 'success' THEN song_code END AS track_code,
      CASE WHEN status = 'success' THEN track_id END AS track_id,
      CASE WHEN status = 'success' THEN song END AS recordings_title,
      CASE WHEN status = 'success' THEN artist END AS song_writers FROM outcome"""
)
def catalogue_enrich(spark, sf_dir):
    rows = _enriched(spark, sf_dir)
    track, snippet = "$.tracks.items", "$.items.snippet"
    return rows.select(
        "song",
        "artist",
        "status",
        F.get_json_object("spotify_message", f"{track}.song_code").alias("track_code"),
        F.get_json_object("spotify_message", f"{track}.id").alias("track_id"),
        F.get_json_object("youtube_message", f"{snippet}.recordings_title").alias("recordings_title"),
        F.get_json_object("youtube_message", f"{snippet}.song_writers").alias("song_writers"),
    )


@query(
    f"""WITH {_ENRICHED}, done AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_shipdate > TIMESTAMP '2001-06-01 00:00:00'),
    tagged AS (SELECT o.*, d.l_partkey IS NOT NULL AS skipped FROM outcome o
      LEFT JOIN done d ON o.song_code = 'SC' || d.l_partkey)
    SELECT counter, count(*) AS songs FROM (
      SELECT CASE WHEN skipped OR status = 'success' THEN 'success' ELSE 'fail' END AS counter FROM tagged
      UNION ALL SELECT 'skipped' FROM tagged WHERE skipped) GROUP BY 1"""
)
def run_counters(spark, sf_dir):
    """Success, fail and skipped songs of a run."""
    finished = table(spark, sf_dir, "lineitem").filter(
        F.col("l_shipdate") > F.lit("2001-06-01 00:00:00").cast("timestamp_ntz")
    )
    done = finished.select(text("SC", F.col("l_partkey")).alias("song_code")).distinct()
    outcomes = _enriched(spark, sf_dir).select("song_code", "status")
    return backlog.run_counters(
        outcomes.join(done, "song_code", "left_anti"), outcomes.join(done, "song_code", "left_semi")
    )


@query(
    """SELECT 'orders' AS table_name, 'missing' AS check_type,
      CASE WHEN count(*) = 0 THEN 'pass' ELSE 'warn' END AS status, count(*) AS affected_rows,
      'batch-1' AS batch_id, 'title_missing' AS name
    FROM orders WHERE o_orderpriority = '5-LOW' OR o_orderstatus = 'P'"""
)
def blank_count(spark, sf_dir):
    """Titles that are empty or not there, found by the standing rule."""
    title = (
        F.when(F.col("o_orderpriority") == "5-LOW", "")
        .when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    )
    rows = table(spark, sf_dir, "orders").select(title.alias("title"))
    return _log(quality.check_rows(rows, "orders", quality.missing("title"), BATCH, as_of()))


# A day with values three times as high, and one on which half of the payloads are missing.
@query(
    f"""WITH e AS (SELECT ts::DATE AS day, CASE WHEN ts::DATE = DATE '{TODAY}' THEN value * 3 ELSE value END AS value,
      CASE WHEN ts::DATE = DATE '2024-01-20' AND event_id % 2 = 0 THEN NULL ELSE props END AS props FROM events),
    stepped AS (SELECT day, substring(u, 1, 2) || repeat('0', greatest(length(u) - 2, 0)) AS step FROM (
      SELECT day, floor(abs(value) * 100 + 0.5)::HUGEINT::VARCHAR AS u FROM e)),
    counted AS (SELECT day, step::HUGEINT AS step, count(*) AS n FROM stepped GROUP BY ALL),
    upto AS (SELECT *, sum(n) OVER (PARTITION BY day ORDER BY step) AS c, sum(n) OVER (PARTITION BY day) AS total FROM counted),
    m AS (SELECT day, '*' AS "column", 'rows' AS metric, count(*)::DOUBLE AS value FROM e GROUP BY 1
      UNION ALL SELECT day, 'props', 'null_share', round(count_if(props IS NULL) / count(*), 6) FROM e GROUP BY 1
      UNION ALL SELECT day, 'value', 'null_share', round(count_if(value IS NULL) / count(*), 6) FROM e GROUP BY 1
      UNION ALL SELECT day, 'value', 'p' || q, min(step)::DOUBLE / 100 FROM upto, (VALUES (50), (90)) t(q)
        WHERE c * 100 >= total * q GROUP BY day, q),
    held AS (SELECT *, avg(value) OVER w AS expected, count(value) OVER w AS days FROM m
      WINDOW w AS (PARTITION BY "column", metric ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
    SELECT day, "column", metric, value, round(expected, 6) AS expected, days, CASE WHEN days < 3 THEN 'new'
      WHEN metric = 'null_share' AND abs(value - expected) > 0.1 THEN 'warn'
      WHEN metric <> 'null_share' AND abs(value - expected) > abs(expected) * 0.5 THEN 'warn' ELSE 'pass' END AS status FROM held"""
)
def dq_anomaly(spark, sf_dir):
    """Profiles of two loads a day, added up, and each day held against the seven before."""
    day = F.to_date("ts")
    events = table(spark, sf_dir, "events").select(
        "ts",
        "event_id",
        F.when(day == today(), F.col("value") * 3).otherwise(F.col("value")).alias("value"),
        F.when((day != F.lit("2024-01-20").cast("date")) | (F.col("event_id") % 2 != 0), F.col("props")).alias("props"),
    )
    loads = [profile.profile(events.filter(F.col("event_id") % 2 == k), "ts", ["props"], ["value"]) for k in (0, 1)]
    return profile.anomalies(loads[0].unionByName(loads[1]))
