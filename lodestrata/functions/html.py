"""Pulling scripts, elements and embedded JSON out of page source."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions.text import as_column, is_json

# The variable that holds a page's data, and how it may be named.
MARKER = "ytInitialData"
TARGETS = (f"var {MARKER}", f'window["{MARKER}"]', MARKER)


# Fixed values of HTML: elements without content, with text alone, and not within their own kind.
NO_CONTENT = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
TEXT_ONLY = ("script", "style", "title", "textarea")
NOT_NESTED = ("a", "button", "option", "p")


def _assignment() -> str:
    """A script that is one assignment to a target; group 1 is the right-hand side."""
    names = [re.escape(t).replace(r"\ ", r"\s+").replace('"', "[\"']") for t in TARGETS]
    return rf"(?s)^\s*(?:{'|'.join(names)})\s*=\s*(.*?)[\s;]*$"


def elements(html: Column | str, tag: str) -> Column:
    """Inner text of every ``<tag>`` element, in page order, with the elements inside of it.

    Opening and closing tags are counted: an element ends at the closing tag that brings
    the depth back, or at the end of the page. Tags in comments, scripts and style
    sheets do not count; the text of a script, style sheet or title is
    not looked into. Closing tags without an opening one are skipped. Elements that
    cannot hold their own kind end where the next one starts; such without content have none.
    """
    page, name = as_column(html), tag.lower()
    if name in NO_CONTENT:
        return F.when(page.isNotNull(), F.array().cast("array<string>"))
    if name in TEXT_ONLY:
        return F.regexp_extract_all(page, F.lit(rf"(?is)<{name}(?=[\s/>])[^>]*>(.*?)</{name}\s*>"), 1)
    opaque = "|".join(rf"<{t}(?=[\s/>])[^>]*>.*?(?:</{t}\s*>|\z)" for t in ("script", "style"))
    token = rf"(?is)<!--.*?(?:-->|\z)|{opaque}|</?{re.escape(name)}(?=[\s/>])[^>]*>"
    texts = F.split(page, token, -1)
    tokens = F.regexp_extract_all(page, F.lit(token), 0)
    opening, closing = rf"(?i)^<{re.escape(name)}[\s/>]", rf"(?i)^</{re.escape(name)}[\s/>]"
    up = F.lit(1)

    def deeper(depths: Column, t: Column) -> Column:
        now = F.element_at(depths, -1)
        step = F.when(F.regexp_like(t, F.lit(opening)), up if name in NOT_NESTED else now + 1)
        step = step.when(F.regexp_like(t, F.lit(closing)), F.greatest(now - 1, F.lit(0)))
        return F.concat(depths, F.array(step.otherwise(now)))

    depths = F.aggregate(tokens, F.array(F.lit(0)), deeper)
    pieces = F.zip_with(texts, tokens, lambda x, t: F.concat(x, F.coalesce(t, F.lit(""))))
    count = F.size(tokens)

    def inner(t: Column, i: Column) -> Column:
        # depths[i + 1] is the depth after token i, counted from 0
        own = F.get(depths, i + 1)
        rest = F.slice(depths, i + 3, F.greatest(count - i, F.lit(1)))
        if name in NOT_NESTED:
            later = F.slice(tokens, i + 2, F.greatest(count - i, F.lit(1)))
            ends = F.transform(later, lambda x: F.regexp_like(x, F.lit(f"{opening}|{closing}")).cast("int"))
            away = F.array_position(ends, F.lit(1))
        else:
            away = F.array_position(rest, own - 1)
        end = F.when(away > 0, (i + away).cast("int")).otherwise(count)
        held = F.array_join(F.slice(pieces, i + 2, end - i - 1), "")
        return F.when(F.regexp_like(t, F.lit(opening)), F.concat(held, F.get(texts, end)))

    return F.array_compact(F.transform(tokens, inner))


def elements_containing(html: Column | str, tag: str, text: str) -> Column:
    return F.filter(elements(html, tag), lambda e: F.contains(e, F.lit(text)))


def embedded_json(html: Column | str) -> Column:
    """Text of the JSON document a page assigns in a script, null if there is none.

    The first script counts that is an assignment from its first character on, with
    a JSON value and nothing else on its right. The value is taken as it stands: what
    looks like the assignment inside of it stays.
    """
    values = F.transform(
        elements_containing(html, "script", MARKER),
        lambda script: F.regexp_extract(script, _assignment(), 1),
    )
    return F.get(F.filter(values, is_json), F.lit(0))


def joined_runs(runs: Column) -> Column:
    """Text of a run list: its pieces one after the other."""
    return F.coalesce(F.array_join(F.transform(runs, lambda r: r["text"]), ""), F.lit(""))
