"""Data-quality checks. Each check is one row of the quality log."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.functions import is_blank, natural_key
from lodestrata.operators import profile

# Kinds of check and outcomes.
CHECK_TYPES = ("schema", "missing", "duplicate", "anomaly", "consistency")
PASS, WARN, FAIL = "pass", "warn", "fail"


def _log_rows(counts: DataFrame, table: str, batch_id: str, as_of: Column) -> DataFrame:
    """(name, check_type, severity, affected_rows) -> quality-log rows."""
    details = F.to_json(F.struct(F.lit(batch_id).alias("batch_id"), F.col("name").alias("check")))
    rows = counts.withColumns(
        {
            "check_id": natural_key(F.lit(batch_id), F.lit(table), "check_type", "name"),
            "table_name": F.lit(table),
            "status": F.when(F.col("affected_rows") == 0, PASS).otherwise(F.col("severity")),
            "details": details,
            "checked_at": as_of,
        }
    )
    return schemas.conform(rows, "silver_data_quality_log")


def check_rows(
    df: DataFrame,
    table: str,
    rules: dict[str, tuple[str, Column, str]],
    batch_id: str,
    as_of: Column,
) -> DataFrame:
    """Row rules ``{name: (check_type, violated, severity)}``, all in one pass."""
    for name, (kind, _, severity) in rules.items():
        if kind not in CHECK_TYPES or severity not in (WARN, FAIL):
            raise ValueError(f"rule {name!r}: {kind!r}, {severity!r}")
    names = list(rules)
    counts = df.agg(*[F.count_if(rules[n][1]).alias(f"c{i}") for i, n in enumerate(names)])
    outcome = F.array(
        *[
            F.struct(
                F.lit(n).alias("name"),
                F.lit(rules[n][0]).alias("check_type"),
                F.lit(rules[n][2]).alias("severity"),
                F.col(f"c{i}").alias("affected_rows"),
            )
            for i, n in enumerate(names)
        ]
    )
    return _log_rows(counts.select(F.inline(outcome)), table, batch_id, as_of)


def missing(*columns: str, severity: str = WARN) -> dict[str, tuple[str, Column, str]]:
    """Rules: column is null or empty."""
    return {f"{c}_missing": ("missing", is_blank(c), severity) for c in columns}


def too_long(limits: dict[str, int], severity: str = WARN) -> dict[str, tuple[str, Column, str]]:
    """Rules: text longer than the declared VARCHAR. Nothing is cut off."""
    return {
        f"{c}_length_{n}": ("schema", F.length(c) > n, severity) for c, n in limits.items()
    }


def out_of_decimal(column: str, precision: int, scale: int, severity: str = WARN):
    """Rule: value does not fit DECIMAL(precision, scale)."""
    limit = 10 ** (precision - scale)
    return {
        f"{column}_decimal_{precision}_{scale}": (
            "schema",
            F.abs(F.round(F.col(column), scale)) >= limit,
            severity,
        )
    }


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def _one(
    counts: DataFrame, name: str, kind: str, severity: str
) -> DataFrame:
    return counts.select(
        F.lit(name).alias("name"),
        F.lit(kind).alias("check_type"),
        F.lit(severity).alias("severity"),
        "affected_rows",
    )


def check_unique(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    batch_id: str,
    as_of: Column,
    severity: str = FAIL,
) -> DataFrame:
    """Surplus rows beyond one per key."""
    surplus = duplicate_rows(df, keys).agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("affected_rows")
    )
    name = "_".join(keys) + "_unique"
    return _log_rows(_one(surplus, name, "duplicate", severity), table, batch_id, as_of)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows that name a parent that does not exist. Null names none.

    The child is reduced to (value, rows) first, so a value that fills a third
    of it meets the parent as one row.
    """
    values = child.filter(~is_blank(F.col(column).cast("string"))).groupBy(
        F.col(column).alias("value")
    ).agg(F.count("*").alias("child_rows"))
    keys = parent.select(F.col(parent_column).alias("value"))
    return values.join(keys, "value", "left_anti")


def check_reference(
    child: DataFrame,
    table: str,
    column: str,
    parent: DataFrame,
    parent_column: str,
    batch_id: str,
    as_of: Column,
    severity: str = FAIL,
) -> DataFrame:
    lost = orphans(child, column, parent, parent_column).agg(
        F.coalesce(F.sum("child_rows"), F.lit(0)).alias("affected_rows")
    )
    counts = _one(lost, f"{column}_reference", "consistency", severity)
    return _log_rows(counts, table, batch_id, as_of)


def check_log(checks: Iterable[DataFrame]) -> DataFrame:
    """All checks of a run as one log."""
    return reduce(DataFrame.unionByName, checks)


def split_rejects(df: DataFrame, violated: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); a rule that cannot be decided does not reject."""
    bad = F.coalesce(violated, F.lit(False))
    return df.filter(~bad), df.filter(bad)


def violates(rules: dict[str, tuple[str, Column, str]]) -> Column:
    """Whether a row breaks any of the rules; one that cannot be decided does not count."""
    return reduce(or_, [F.coalesce(violated, F.lit(False)) for _, violated, _ in rules.values()])


def check_rejects(
    rejects: DataFrame, tables: Iterable[str], batch_id: str, as_of: Column, severity: str = WARN
) -> DataFrame:
    """One row a table: how many rows of a batch were put aside for their length."""
    checks = []
    for name in tables:
        counts = rejects.filter(F.col("table_name") == name).agg(F.count(F.lit(1)).alias("affected_rows"))
        checks.append(_log_rows(_one(counts, "too_long", "schema", severity), name, batch_id, as_of))
    return check_log(checks)


def check_anomalies(
    df: DataFrame,
    table: str,
    day: str,
    columns: Sequence[str],
    numeric: Sequence[str],
    batch_id: str,
    as_of: Column,
    severity: str = WARN,
) -> DataFrame:
    """Measures of the last day that are far from the days before, see `operators.profile`."""
    measured = profile.anomalies(profile.profile(df, day, columns, numeric))
    last = measured.agg(F.max(F.struct("day")).alias("m")).select(F.col("m.day").alias("day"))
    off = measured.join(last, "day").agg(F.count_if(F.col("status") == WARN).alias("affected_rows"))
    return _log_rows(_one(off, f"{day}_profile", "anomaly", severity), table, batch_id, as_of)


def silver_checks(tables: dict[str, DataFrame], batch_id: str, as_of: Column) -> DataFrame:
    """The standing checks of the silver layer, with the declared keys."""
    t = tables
    checks = [
        check_anomalies(
            t["silver_spotify_track"], "silver_spotify_track", "ingested_at", ["isrc_code"], ["duration_ms"], batch_id, as_of
        ),
        check_anomalies(
            t["silver_youtube_video"], "silver_youtube_video", "ingested_at", ["channel_id"], ["view_count"], batch_id, as_of
        ),
        check_rows(t["silver_spotify_track"], "silver_spotify_track", missing("isrc_code"), batch_id, as_of),
        check_rows(
            t["silver_youtube_video"], "silver_youtube_video", missing("channel_id", "title"), batch_id, as_of
        ),
    ]
    if "silver_song_mapping" in t:
        rules = out_of_decimal("match_confidence", 3, 2)
        checks.append(check_rows(t["silver_song_mapping"], "silver_song_mapping", rules, batch_id, as_of))
        checks.append(
            check_unique(
                t["silver_song_mapping"],
                "silver_song_mapping",
                ["song_id", "spotify_track_id", "youtube_video_id"],
                batch_id,
                as_of,
                WARN,
            )
        )
    for name, df in t.items():
        checks.append(check_unique(df, name, schemas.PRIMARY_KEYS[name], batch_id, as_of))
    for child, column, parent, parent_column in schemas.FOREIGN_KEYS:
        if child in t and parent in t:
            checks.append(
                check_reference(
                    t[child], child, column, t[parent], parent_column, batch_id, as_of, WARN
                )
            )
    return check_log(checks)
