"""Scalar functions, each a plain Column expression unless it says otherwise."""

from lodestrata.functions.dates import (
    elapsed_seconds,
    parse_published,
    release_date,
    utc_instant,
    utc_wall,
    wall_clock,
    wall_clock_stamp,
)
from lodestrata.functions.numbers import parse_duration, parse_view_count, success_rate
from lodestrata.functions.text import (
    ascii_fold,
    blank_to_null,
    cache_key,
    generate_id,
    is_blank,
    is_json,
    natural_key,
    normalize,
    or_default,
    song_id,
    strip_at,
    strip_space,
)
from lodestrata.functions.urls import build_url, clamp, query_map, query_string

__all__ = [
    "ascii_fold",
    "blank_to_null",
    "build_url",
    "cache_key",
    "clamp",
    "elapsed_seconds",
    "generate_id",
    "is_blank",
    "is_json",
    "natural_key",
    "normalize",
    "or_default",
    "parse_duration",
    "parse_published",
    "parse_view_count",
    "query_map",
    "query_string",
    "release_date",
    "song_id",
    "strip_at",
    "strip_space",
    "success_rate",
    "utc_instant",
    "utc_wall",
    "wall_clock",
    "wall_clock_stamp",
]
