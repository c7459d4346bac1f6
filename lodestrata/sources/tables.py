"""SQL and lookups over registered tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession


def register(tables: dict[str, DataFrame]) -> None:
    """Make DataFrames known to SQL under their table names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_query(spark: SparkSession, query: str, params: dict | None = None) -> DataFrame:
    """Rows of a query; parameters are bound, never spliced into the text."""
    return spark.sql(query, args=params) if params else spark.sql(query)


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Rows of a query another database runs (needs its JDBC driver)."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    return reader.options(**options).load()


def find_one(df: DataFrame, condition: Column) -> DataFrame:
    """First row that meets a condition, as a DataFrame of at most one row."""
    return df.filter(condition).limit(1)
