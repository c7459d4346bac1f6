"""Table sinks."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.session import delete_path
from lodestrata.sinks.keyindex import KeyIndex


def create_tables(
    spark: SparkSession,
    database: str,
    layers: tuple[str, ...] = ("bronze", "silver", "gold"),
    location: str | None = None,
) -> list[str]:
    """Create the database, at ``location`` if given, and the layers' tables where they are missing."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    names = [n for n in schemas.TABLES if n.split("_")[0] in layers]
    for name in names:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({schemas.TABLES[name]}) USING parquet"
        )
    return names


def by_folder(df: DataFrame, *columns: str) -> DataFrame:
    """Gather the rows of a partition folder before they are written.

    Without it every task writes a file into every folder. AQE splits a folder
    that holds most of the rows and packs small ones together, so file sizes
    stay even whatever the distribution.
    """
    return df.hint("rebalance", *columns)


def append_new(df: DataFrame, path: str, key: str = "raw_id", day: str = "ingested_at") -> None:
    """Append the rows whose key is not there yet, on whatever day it came before.

    The table is partitioned by day and load. Its key index is asked, see `sinks.keyindex`; the
    first load and later ones follow the same rule: each key once, also the null key.
    """
    load = f"load-{uuid.uuid4().hex}"
    index = KeyIndex(df.sparkSession, path, key)
    index.fold(load)
    rows = index.new_rows(df.withColumn("ingest_date", F.to_date(day)), load)
    index.begin(load)
    rows = by_folder(rows, "ingest_date").withColumn("epoch", F.lit(load))
    rows.write.mode("append").partitionBy("ingest_date", "epoch").parquet(path)
    index.record(load, df.schema[key].dataType)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    rows = by_folder(df, *partition_by) if partition_by else df
    rows.write.mode("append").partitionBy(*(partition_by or [])).parquet(path)


def write_tables(tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> list[str]:
    """Write a set of tables below one folder, leaving out the empty ones.

    Each DataFrame is written once; emptiness is asked of the first row only.
    """
    written = []
    for name, df in tables.items():
        if df.isEmpty():
            continue
        df.write.mode(mode).parquet(f"{root}/{name}")
        written.append(name)
    return written


def drop_days(
    spark: SparkSession, path: str, first_kept: date, column: str = "ingest_date"
) -> list[date]:
    """Remove the day folders before a day; the days removed.

    Which days there are is read from the folder names alone.
    """
    days = spark.read.parquet(path).select(column).distinct()
    old = [r[0] for r in days.filter(F.col(column) < F.lit(first_kept)).collect()]
    for day in old:
        delete_path(spark, f"{path}/{column}={day.isoformat()}")
    return sorted(old)


def write_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace just the partitions the rows belong to: backfill of one batch."""
    by = by or ("batch_id",)
    (
        by_folder(df, *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def staging_rows(df: DataFrame, created_at: Column) -> DataFrame:
    """Each row as one JSON value with a timestamp; nulls are kept as fields."""
    data = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return df.select(data.alias("data"), created_at.alias("created_at"))


def write_staging(tables: dict[str, DataFrame], root: str, created_at: Column) -> list[str]:
    staged = {f"{name}_staging": staging_rows(df, created_at) for name, df in tables.items()}
    return write_tables(staged, root, mode="append")
