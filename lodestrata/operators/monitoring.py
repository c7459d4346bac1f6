"""Run log, dashboard queries, alert rules and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.functions import elapsed_seconds, natural_key

# Alert thresholds.
MIN_SUCCESS_PCT = 95
MAX_DURATION_SECONDS = 300


def run_log_row(
    spark: SparkSession,
    batch_id: str,
    source: str,
    status: str,
    records_raw: int,
    records_silver: int,
    records_rejected: int,
    started_at,
    finished_at,
    error_message: str | None = None,
) -> DataFrame:
    """One ingestion-log row. Counts come from ``df.observe``, not extra scans."""
    row = spark.createDataFrame(
        [(batch_id, source, status, records_raw, records_silver, records_rejected, error_message, started_at, finished_at)],
        "batch_id string, source string, status string, records_raw bigint, records_silver bigint,"
        " records_rejected bigint, error_message string, started_at timestamp_ntz,"
        " finished_at timestamp_ntz",
    ).withColumns(
        {
            "log_id": natural_key("batch_id", "source", "started_at"),
            "duration_seconds": elapsed_seconds("started_at", "finished_at"),
        }
    )
    return schemas.conform(row, "silver_ingestion_log")


def since(column: str, as_of: Column, days: int) -> Column:
    """Not older than a number of days, as a range on the bare column.

    The column is not wrapped, so the bound reaches the parquet reader and
    prunes day partitions.
    """
    return F.col(column) >= as_of - F.make_dt_interval(F.lit(days))


def on_day(column: str, day: Column) -> Column:
    start = day.cast("timestamp_ntz")
    return (F.col(column) >= start) & (F.col(column) < start + F.make_dt_interval(F.lit(1)))


def rows_today(bronze: DataFrame, day: Column) -> DataFrame:
    return bronze.filter(on_day("ingested_at", day)).agg(F.count("*").alias("row_count"))


def total_rows(bronze: DataFrame) -> DataFrame:
    return bronze.agg(F.count("*").alias("row_count"))


def failed_runs(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status") == "failed").agg(F.count("*").alias("failed_count"))


def daily_by_source(bronze: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    recent = bronze.filter(since("ingested_at", as_of, days))
    return recent.groupBy(F.to_date("ingested_at").alias("date"), "source").agg(
        F.count("*").alias("row_count")
    )


def duration_series(runs: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Unsorted; the panel orders by date."""
    return runs.filter(since("started_at", as_of, days)).select(
        F.to_date("started_at").alias("date"), "source", "duration_seconds"
    )


def latest(df: DataFrame, by: str, tie: str, n: int) -> DataFrame:
    """Latest ``n`` log rows; the key breaks ties."""
    return df.orderBy(F.col(by).desc(), F.col(tie)).limit(n)


def records_flow(runs: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    recent = runs.filter(since("started_at", as_of, days))
    return recent.groupBy(F.to_date("started_at").alias("date")).agg(
        F.sum("records_raw").alias("raw"), F.sum("records_silver").alias("silver")
    )


HEALTH_COLUMNS = [
    "date_id",
    "source",
    "total_raw_records",
    "total_silver_records",
    "total_rejected",
    "success_rate_pct",
    "avg_ingestion_duration_seconds",
]


def pipeline_health(summary: DataFrame, as_of_day: Column, days: int = 7) -> DataFrame:
    recent = summary.filter(F.col("date_id") >= F.date_sub(as_of_day, days))
    return recent.select(*HEALTH_COLUMNS).orderBy(F.col("date_id").desc(), "source")


def recent_checks(checks: DataFrame, start: Column, n: int | None = None) -> DataFrame:
    rows = checks.filter(F.col("checked_at") >= start).select(
        "table_name", "check_type", "status", "checked_at", "check_id"
    )
    ordered = rows.orderBy(F.col("checked_at").desc(), "check_id")
    return ordered if n is None else ordered.limit(n)


def daily_totals(runs: DataFrame) -> DataFrame:
    """Per source and day: raw records, rejects, silver records, failed runs, longest run."""
    return runs.groupBy(F.to_date("started_at").alias("date_id"), "source").agg(
        F.sum("records_raw").alias("raw"),
        F.sum("records_silver").alias("silver"),
        F.sum("records_rejected").alias("rejected"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.max("duration_seconds").alias("longest"),
    )


def silent_runs(totals: DataFrame, last_day: Column) -> DataFrame:
    """Runs of days without records: (source, first_day, last_day, days), one row a run.

    A day without any run is a day with zero records, from the source's first day on up to
    ``last_day``. The gaps between days with records are the runs; no calendar is made, so
    a source silent for years is one row. ``totals`` has one row per source and day.
    """
    known = totals.filter(F.col("date_id") <= last_day)
    alive = known.filter("raw > 0").select("source", "date_id")
    # the day before the first one ends nothing, but a run may start after it
    begin = known.groupBy("source").agg(F.date_sub(F.min("date_id"), 1).alias("date_id"))
    marks = alive.unionByName(begin)
    w = Window.partitionBy("source").orderBy("date_id")
    gaps = marks.select(
        "source",
        F.date_add("date_id", 1).alias("first_day"),
        F.coalesce(F.date_sub(F.lead("date_id").over(w), 1), last_day).alias("last_day"),
    ).filter("first_day <= last_day")
    return gaps.withColumn("days", F.date_diff("last_day", "first_day") + 1)


def zero_streaks(totals: DataFrame, last_day: Column) -> DataFrame:
    """Days on which a source had no records for the second day running."""
    runs = silent_runs(totals, last_day).filter("days > 1")
    days = F.sequence(F.date_add("first_day", 1), "last_day")
    return runs.select(F.explode(days).alias("date_id"), "source")


def alerts(runs: DataFrame, last_day: Column) -> DataFrame:
    """Triggered rules: (date_id, source, rule, severity)."""
    totals = daily_totals(runs)

    def rule(condition: Column, name: str, severity: str) -> Column:
        entry = F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity"))
        return F.when(condition, entry)

    low = (F.col("raw") > 0) & (F.col("silver") * 100 < F.col("raw") * MIN_SUCCESS_PCT)
    rules = F.array(
        rule(low, "low_success_rate", "warning"),
        rule(F.col("rejected") > 0, "records_rejected", "warning"),
        rule(F.col("longest") > MAX_DURATION_SECONDS, "slow_run", "warning"),
        rule(F.col("failed") > 0, "job_failed", "critical"),
    )
    daily = totals.select(
        "date_id", "source", F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("r")
    ).select("date_id", "source", "r.rule", "r.severity")
    silent = zero_streaks(totals, last_day).select(
        "date_id",
        "source",
        F.lit("no_records_two_days").alias("rule"),
        F.lit("critical").alias("severity"),
    )
    return daily.unionByName(silent)


def retained(df: DataFrame, layer: str, column: str, as_of: Column) -> DataFrame:
    """Rows of a layer that are still within its keeping time."""
    days = schemas.RETENTION_DAYS[layer]
    return df if days is None else df.filter(since(column, as_of, days))
