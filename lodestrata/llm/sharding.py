"""Operator 6: shards by proportional stratified interleaving.

Within each source the rows are ranked in a seeded random order (md5 of seed and
doc_id). Row r of a source with n rows stands at the fraction (r - u) / n of the
whole, u being the source's own seeded offset in [0, 1). Rows sorted by fraction
mix all sources evenly, and cutting that order into runs of equal length gives
every shard the mixture of the whole. Law: `rows`, counts at most one apart.

No rank needs a source, or the whole, in one task: rows are ranked within buckets
of the random order, or of the fraction, and the counts of the buckets before
are added. A source that holds most rows has as many more buckets.

A null source is a source of its own; a null text has no bytes (size 1, CRC 0); null
doc_ids are ordered by their text. Rows that are equal in all of it
are interchangeable. An empty table gives no rows. Only DataFrame functions run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.session import stage

#: Mean rows of a bucket of the fractions, once there are so many.
BUCKET_ROWS = 5_000


def _random(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _before(counts: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows in the buckets before each one, as `before`."""
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(window), F.lit(0)))


def shard(docs: DataFrame, shards: int = 16, seed: int = 17) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, source."""
    rows = docs.select(
        "doc_id",
        "source",
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("stratum"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
        _random(F.lit(seed), F.col("doc_id")).alias("draw"),
    )
    total = docs.count()
    digits = min(8, max(2, math.ceil(math.log(max(total, 1) / 50_000 + 1e-9, 16))))
    rows = rows.withColumn("bucket", F.substring("draw", 1, digits))
    strata = rows.groupBy("stratum", "bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes = strata.groupBy("stratum").agg(F.sum("n").alias("in_stratum"))
    strata = _before(strata, ["stratum"], "bucket").join(sizes, "stratum").drop("n")
    inside = Window.partitionBy("stratum", "bucket").orderBy("draw", "doc_id", "text_crc32", "size")
    buckets = max(256, total // BUCKET_ROWS)
    offset = F.conv(F.substring(_random(F.lit(seed), F.col("stratum")), 1, 8), 16, 10)
    place = (
        F.col("before") + F.row_number().over(inside) - offset.cast("double") / 2.0**32
    ) / F.col("in_stratum")
    mixed = stage(
        rows.join(strata, ["stratum", "bucket"])
        .withColumn("place", place)
        .withColumn("part", F.least(F.floor(F.col("place") * buckets), F.lit(buckets - 1)))
        .select("doc_id", "source", "stratum", "size", "text_crc32", "draw", "place", "part"),
        "mixed",
    )
    counts = mixed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # few rows, one for each BUCKET_ROWS rows of the input, and only two numbers in each
    parts = _before(counts, [], "part").drop("n")
    along = Window.partitionBy("part").orderBy("place", "stratum", "draw", "doc_id", "text_crc32")
    position = F.col("before") + F.row_number().over(along) - 1
    cut = mixed.join(parts, "part").withColumn("position", position)
    cut = cut.withColumn("shard", F.expr(f"(position * {shards}) div {max(total, 1)}"))
    begin = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("position") - begin).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


#: The same rows in DuckDB, by plain ranks; CRC by its definition, byte by byte.
ORACLE_SQL = """
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS t
), hexed AS MATERIALIZED (
  SELECT doc_id, source, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bytes
  FROM documents
), base AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS stratum, len(bytes) + 1 AS size,
    md5('17:' || coalesce(doc_id::VARCHAR, '')) AS draw,
    CASE WHEN len(bytes) = 0 THEN 0 ELSE xor(4294967295, list_reduce(
      list_transform(bytes, lambda b: ('0x' || b)::BIGINT),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295)) END AS text_crc32
  FROM hexed, crc_table
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY draw, doc_id)
    - ('0x' || md5('17:' || stratum)[1:8])::BIGINT::DOUBLE / 4294967296.0)
    / count(*) OVER (PARTITION BY stratum) AS place
  FROM base
), placed AS (
  SELECT *, row_number() OVER (ORDER BY place, stratum, draw, doc_id) - 1 AS position,
    count(*) OVER () AS total
  FROM ranked
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law,
  (position * 16 // total)::INTEGER AS shard,
  (position - ((position * 16 // total) * total + 15) // 16)::BIGINT AS slot,
  NULL::INTEGER AS grown_shard, source
FROM placed
"""
