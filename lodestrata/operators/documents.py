"""Unpacking response documents into one row per item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.text import as_column


def json_objects(text: Column | str) -> Column:
    """JSON text of an object or an array -> ARRAY<STRING> of its objects.

    An object counts as an array of one. Elements that are no objects are left
    out one by one, so a stray value does not cost its neighbours.
    """
    c = F.trim(as_column(text))
    elements = F.when(F.startswith(c, F.lit("[")), F.from_json(c, "array<string>")).when(
        F.startswith(c, F.lit("{")), F.array(c)
    )
    return F.filter(elements, lambda e: F.startswith(F.ltrim(e), F.lit("{")))


def explode_items(bronze: DataFrame, items: Column, item_schema: str) -> DataFrame:
    """Bronze rows -> (raw_id, ingested_at, pos, item), the item parsed.

    The items text is a column of its own before it is taken apart, so the
    response is parsed once. The items are parsed inside the generator: a filter
    on a field of the item then cannot slip below it and parse them again.
    """
    texts = bronze.select("raw_id", "ingested_at", items.alias("_items"))
    parsed = F.transform(json_objects("_items"), lambda e: F.from_json(e, item_schema))
    return texts.select("raw_id", "ingested_at", F.posexplode(parsed).alias("pos", "item"))


def explode_response(bronze: DataFrame, path: Sequence[str], item_schema: str) -> DataFrame:
    """Like :func:`explode_items` of the response field at ``path``, parsing most responses once.

    Where the text names the field once, what stands behind the name tells an object from an array:
    an object is read as the item at once, an array as the texts of its elements. Any
    other response goes the whole way.
    """
    raw = F.col("raw_json")

    def field(kind: str) -> Column:
        nested = kind
        for name in reversed(path):
            nested = f"STRUCT<{name}: {nested}>"
        value = F.from_json(raw, nested)
        for name in path:
            value = value[name]
        return value

    def parsed(texts: Column) -> Column:
        return F.transform(texts, lambda e: F.from_json(e, item_schema))

    is_object = lambda e: F.startswith(F.ltrim(e), F.lit("{"))
    around = F.split(raw, rf'"{path[-1]}"\s*:\s*', 3)
    kind = F.when(F.size("_around") == 2, F.substring(F.get("_around", F.lit(1)), 1, 1))
    items = (
        F.when(F.col("_kind") == "{", F.array_compact(F.array(field(item_schema))))
        .when(F.col("_kind") == "[", parsed(F.filter(field("ARRAY<STRING>"), is_object)))
        .otherwise(parsed(json_objects(field("STRING"))))
    )
    rows = bronze.select("raw_id", "ingested_at", "raw_json", around.alias("_around"))
    rows = rows.select("raw_id", "ingested_at", "raw_json", kind.alias("_kind"))
    return rows.select("raw_id", "ingested_at", F.posexplode(items).alias("pos", "item"))


def has_items(items: Column | str) -> Column:
    """Whether a response holds at least one item; never null."""
    c = F.trim(as_column(items))
    many = F.when(F.startswith(c, F.lit("[")), F.size(F.from_json(c, "array<string>")) > 0)
    return F.coalesce(many.otherwise(F.startswith(c, F.lit("{"))), F.lit(False))


def has_item_list(items: Column | str) -> Column:
    """Like :func:`has_items`, but a bare object does not count."""
    c = F.trim(as_column(items))
    return F.coalesce(
        F.startswith(c, F.lit("[")) & (F.size(F.from_json(c, "array<string>")) > 0), F.lit(False)
    )
