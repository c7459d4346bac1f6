"""Keyed merges on plain tables: the new version is a DataFrame, never in place."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Insert new keys; on known keys replace only ``update_cols`` (default: all).

    ``updates`` holds one row per key; reduce it with ``pick_version`` first.
    """
    rest = [c for c in target.columns if c not in keys]
    replaced = set(rest if update_cols is None else update_cols)
    unknown = replaced - set(rest)
    if unknown:
        raise ValueError(f"not columns of the target: {sorted(unknown)}")
    old = target.select(*keys, F.struct(*rest).alias("_old"))
    new = updates.select(*keys, F.struct(*rest).alias("_new"))

    def merged(name: str):
        known, fresh = F.col("_old").isNotNull(), F.col("_new").isNotNull()
        if name in replaced:
            value = F.when(fresh, F.col("_new")[name]).otherwise(F.col("_old")[name])
        else:
            value = F.when(known, F.col("_old")[name]).otherwise(F.col("_new")[name])
        return value.alias(name)

    joined = old.join(new, list(keys), "full_outer")
    values = {c: merged(c) for c in rest}
    return joined.select(*[values.get(c, F.col(c)) for c in target.columns])


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the rows whose key it does not have yet."""
    return target.unionByName(new_rows(target, rows, keys))


def new_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key the target does not have, each key once; null is a key too."""
    fresh = rows.dropDuplicates(list(keys))
    known = target.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys]
    return fresh.join(known, reduce(and_, same), "left_anti")


def merge_patch(
    target: DataFrame, patches: DataFrame, key: str, document: str = "document"
) -> DataFrame:
    """Partial update of MAP documents: only fields present in the patch change.

    A field set to null by the patch becomes null; a field the patch does not
    mention stays. An unknown key is inserted.
    """
    old = target.select(key, F.col(document).alias("_old"))
    new = patches.select(key, F.col(document).alias("_new"))
    kept = F.map_filter(F.col("_old"), lambda k, _: ~F.map_contains_key(F.col("_new"), k))
    patched = (
        F.when(F.col("_new").isNull(), F.col("_old"))
        .when(F.col("_old").isNull(), F.col("_new"))
        .otherwise(F.map_concat(kept, F.col("_new")))
    )
    return old.join(new, key, "full_outer").select(key, patched.alias(document))
