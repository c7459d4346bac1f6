"""Text normalisation, identifiers and small string helpers."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's Unicode whitespace class lacks the four ASCII separators \x1c-\x1f that
# the source data's own normaliser treats as space, so they are listed by hand.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_NOT_WORD_OR_SPACE = r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f]"
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip_space(text: Column | str) -> Column:
    """Remove Unicode whitespace from both ends."""
    return F.regexp_replace(as_column(text), _EDGE_SPACE, "")


def normalize(text: Column | str) -> Column:
    """Matching form of a title or name; null becomes the empty string.

    Lower-cased, stripped, punctuation deleted, whitespace runs made one space.
    The result is not stripped again: ``'foo !'`` gives ``'foo '``.
    """
    stripped = strip_space(F.lower(as_column(text)))
    words = F.regexp_replace(stripped, _NOT_WORD_OR_SPACE, "")
    return F.coalesce(F.regexp_replace(words, _SPACE_RUN, " "), F.lit(""))


def song_id(title_norm: Column | str, artist_norm: Column | str) -> Column:
    """Surrogate key of a normalised (title, artist) pair: 16 hex digits."""
    pair = F.concat(as_column(title_norm), F.lit("|"), as_column(artist_norm))
    return F.substring(F.md5(pair), 1, 16)


def generate_id(value: Column | str) -> Column:
    return F.md5(as_column(value).cast("string"))


def is_json(value: Column | str) -> Column:
    """Whether a text is one JSON value and nothing else; false for null.

    The text is put into an object with a seal behind it. The seal, its own digest, is
    read back only if the parser came to the end of the value and found just the seal
    there. Further fields of the object would pass that, and further elements of an array the
    same test in an array, but nothing passes both but one value. Repeated keys are JSON; there
    is no limit on the size.
    """
    c = as_column(value)
    seal = F.md5(c)
    limits = {
        "allowSingleQuotes": "false",
        "maxStringLen": str(2**31 - 1),
        "maxNestingDepth": "100000",
    }

    def sealed(before: str, after: str) -> Column:
        whole = F.concat(F.lit(before), c, F.lit(after + ',"seal":"'), seal, F.lit('"}'))
        return F.coalesce(F.from_json(whole, "seal STRING", limits)["seal"] == seal, F.lit(False))

    return sealed('{"value":', "") & sealed('{"value":[', "]")


def cache_key(prefix: str, identifier: Column | str) -> Column:
    return F.concat(F.lit(f"crawler:{prefix}:"), generate_id(identifier))


def natural_key(*parts: Column | str) -> Column:
    """Deterministic row key from the columns that identify the row.

    Takes the place of a random UUID, so that a rerun gives the same keys.
    A null part is told apart from an empty one.
    """
    marked = [F.coalesce(as_column(p).cast("string"), F.lit("\\N")) for p in parts]
    return F.md5(F.concat_ws("|", *marked))


def is_blank(value: Column | str) -> Column:
    c = as_column(value)
    return c.isNull() | (c == "")


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(as_column(value), F.lit(""))


def or_default(value: Column | str, default) -> Column:
    """Value of an optional JSON field; a missing field and a null are alike."""
    return F.coalesce(as_column(value), F.lit(default))


def strip_at(handle: Column | str) -> Column:
    """Drop the leading ``@`` signs of a channel handle."""
    return F.regexp_replace(as_column(handle), "^@+", "")


@cache
def _ascii_forms() -> tuple[str, str, dict[str, str]]:
    """Characters with a one-letter ASCII form, these letters, and longer forms.

    By rule: the ASCII part of the compatibility decomposition of every character.
    """
    single, letters, longer = [], [], {}
    for point in range(0x80, sys.maxunicode + 1):
        form = unicodedata.normalize("NFKD", chr(point)).encode("ascii", "ignore").decode()
        if len(form) == 1:
            single.append(chr(point))
            letters.append(form)
        elif form:
            longer[chr(point)] = form
    return "".join(single), "".join(letters), longer


def ascii_fold(text: Column | str) -> Column:
    """Every character replaced by the ASCII part of its decomposition (NFKD).

    Characters without such a part are dropped. Texts with characters of longer forms,
    such as ligatures and fractions, are taken apart; all others are translated whole.
    """
    single, letters, longer = _ascii_forms()
    c = as_column(text)
    many = "".join(longer)
    # What is left besides ASCII is short in most texts; only there are the longer forms looked for, by a
    # table of characters: a class of thousands of them is tried one after the other.
    plain = F.translate(c, single, letters)
    rest = F.regexp_replace(plain, r"[\x00-\x7F]+", "")
    special = F.char_length(F.translate(rest, many, "")) < F.char_length(rest)
    forms = F.create_map(*[F.lit(x) for pair in longer.items() for x in pair])
    apart = F.transform(F.split(plain, ""), lambda x: F.when(x > "\x7f", F.element_at(forms, x)).otherwise(x))
    spelt = F.when(special, F.array_join(apart, "")).otherwise(plain)
    dropped = F.regexp_replace(spelt, r"[^\x00-\x7F]+", "")
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(dropped)
