"""URL query strings as maps and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions.text import as_column


def _decode(text: Column) -> Column:
    # A broken escape such as '%%' is kept as written.
    return F.coalesce(F.try_url_decode(text), text)


def query_map(url: Column | str) -> Column:
    """Query string as MAP<STRING,STRING>: decoded, blanks dropped, last key wins."""
    query = F.regexp_extract(as_column(url), r"\?([^#]*)", 1)
    pairs = F.transform(
        F.split(query, "&"),
        lambda p: F.struct(
            _decode(F.regexp_extract(p, "^([^=]*)", 1)).alias("key"),
            _decode(F.regexp_extract(p, "^[^=]*=(.*)$", 1)).alias("value"),
        ),
    )
    filled = F.filter(pairs, lambda p: p["value"] != "")

    def no_later_twin(pair: Column, position: Column) -> Column:
        later = F.slice(filled, position + 2, F.size(filled))
        return ~F.exists(later, lambda other: other["key"] == pair["key"])

    return F.map_from_entries(F.filter(filled, no_later_twin))


def query_string(params: Column | str) -> Column:
    """Encoded query string of a map, in the map's own order."""
    encoded = F.transform(
        F.map_entries(as_column(params)),
        lambda e: F.concat(F.url_encode(e["key"]), F.lit("="), F.url_encode(e["value"])),
    )
    return F.array_join(encoded, "&")


def clamp(value: Column | str, low: int, high: int) -> Column:
    """The value itself, or ``high`` when it is outside the allowed range."""
    c = as_column(value)
    return F.when((c < low) | (c > high), F.lit(high)).otherwise(c)


def build_url(base: str, path: str, params: dict[str, Column]) -> Column:
    """Request URL from a base, a path and named parameter columns."""
    entries: list[Column] = []
    for name, value in params.items():
        entries += [F.lit(name), F.coalesce(value.cast("string"), F.lit(""))]
    return F.concat(F.lit(f"{base}{path}?"), query_string(F.create_map(*entries)))
