"""Runs over the driver tables and the log they leave."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lodestrata.catalog.registry import query
from lodestrata.catalog.roles import table
from lodestrata.functions import natural_key
from lodestrata.operators import monitoring
from lodestrata.plans import medallion
from lodestrata.session import shared_folder


@query(
    """SELECT 'youtube_api' AS source, 'success' AS status, count(*) AS records_raw,
      count_if(event_type <> 'click')::BIGINT AS records_silver, count_if(event_type = 'click')::BIGINT AS records_rejected,
      'low_success_rate,records_rejected' AS rules FROM events
    UNION ALL SELECT 'spotify_api', 'failed', 0, 0, 0, 'job_failed'"""
)
def run_log_written(spark, sf_dir):
    """Run log of a landing with broken messages and of one that failed, and the alerts it fires."""
    paths = medallion.Paths(shared_folder(spark))
    document = F.concat(F.lit('{"items":{"id":{"videoId":"V'), F.col("event_id"), F.lit('"}}}'))
    value = F.when(F.col("event_type") == "click", F.concat(F.lit("{broken "), F.col("props"))).otherwise(document)
    events = table(spark, sf_dir, "events").select(
        natural_key("event_id").alias("raw_id"), value.alias("value"), F.col("ts").alias("ingested_at")
    )
    medallion.run_bronze({"youtube": events}, paths, "batch-1")
    try:
        medallion.run_bronze({"spotify": events.drop("value")}, paths, "batch-1")
    except AnalysisException:
        pass  # it is in the log
    log = medallion.read_table(spark, paths, "silver_ingestion_log")
    fired = monitoring.alerts(log, F.current_date()).filter("rule <> 'slow_run'")
    rules = fired.groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("rule")), ",").alias("rules"))
    counts = ["records_raw", "records_silver", "records_rejected"]
    return log.select("source", "status", *counts).join(rules, "source", "left")
