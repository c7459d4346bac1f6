"""Operator 5: personal data by a character BiLSTM-CRF beside fixed rules.

Fixed rules find the base spans of four kinds in the whole text (`base_spans`). They
are also the labelled spans on which the tagger is trained: windows around them and
around other numbers, from at most SAMPLE_DOCS documents chosen by hash of doc_id, of
which at most WINDOWS windows are taken; each telephone window is repeated
with its plus sign left out.

The tagger reads overlapping windows (WIDTH characters, half of them in common) around every
digit and @ of every text; text without either cannot hold any of the four kinds.
Windows are decoded one by one and reconciled over the document: a character's tag is that
of the window in whose middle it stands, spans are joined across windows, trimmed
to their first and last letter or digit, and kept if they overlap no base span and
hold what their kind needs (`_likely`). All base spans stay.

Null and empty texts have no spans. Repeated documents are searched each. Without
any base span there is nothing to train on, and only the rules speak.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm import bilstm
from lodestrata.llm.textscan import bounded_batches

KINDS = ("email", "ip", "card", "phone")
WIDTH = 48
SAMPLE_DOCS = 20_000
WINDOWS = 3_000

Span = tuple[int, int, int]  # start, kind, end

# A match cannot begin inside a run of digits: it would have begun at the run's start.
_AT = re.compile(r"@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _AT.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = at = found.end()
        else:
            at += 1


def _luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """All spans of the fixed rules, by start, then kind."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _tags(length: int, spans: list[Span]) -> np.ndarray:
    out = np.zeros(length, np.int64)
    for a, kind, b in sorted(spans, key=lambda s: -s[1]):
        out[a:b] = kind + 1
    return out


def _window_starts(text: str) -> np.ndarray:
    """Starts of the windows, every WIDTH / 2 characters, near a digit or @."""
    half = WIDTH // 2
    wanted = set()
    for m in _TRIGGER.finditer(text):
        # the characters of the match, and half a window on both sides, stand in windows
        first, last = m.start() // half - 2, (m.end() - 1) // half + 1
        wanted.update(range(first, last + 1))
    return np.array(sorted(wanted), np.int64) * half


def _cut(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Windows at `starts`, which may begin before and end after the text; 0 outside."""
    at = starts[:, None] + np.arange(WIDTH)
    inside = (at >= 0) & (at < len(codes))
    return np.where(inside, codes[np.clip(at, 0, max(len(codes) - 1, 0))], 0)


def _likely(kind: int, text: str) -> bool:
    digits = sum(c.isdigit() and c.isascii() for c in text)
    if kind == 0:
        return bool(re.fullmatch(r"[^\s@]+ ?@ ?[^\s@]+[. ][^\s@]+", text))
    if kind == 1:
        return bool(re.fullmatch(r"(?:[0-9]{1,3} ?\. ?){3}[0-9]{1,3}", text))
    if not re.fullmatch(r"[ ().0-9-]+", text):
        return False
    return 14 <= digits <= 19 and _luhn(re.sub(r"\D", "", text)) if kind == 2 else 10 <= digits <= 15


def added_spans(text: str, base: list[Span], tagger: bilstm.Tagger, at_once: int = 4096) -> list[Span]:
    starts = _window_starts(text)
    if not len(starts):
        return []
    codes = bilstm.codes_of(text)
    quarter, half = WIDTH // 4, WIDTH // 2
    tags = np.zeros(len(codes), np.int64)
    for lo in range(0, len(starts), at_once):
        part = starts[lo : lo + at_once]
        found = tagger.decode(_cut(codes, part))[:, quarter : quarter + half]
        at = part[:, None] + quarter + np.arange(half)
        inside = (at >= 0) & (at < len(codes))
        tags[at[inside]] = found[inside]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], tags, [0]])))
    taken = np.zeros(len(codes) + 1, bool)
    for a, _, b in base:
        taken[a:b] = True
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if not tags[a]:
            continue
        kind = int(tags[a]) - 1
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while a < b and not text[b - 1].isalnum():
            b -= 1
        if a < b and not taken[a:b].any() and _likely(kind, text[a:b]):
            out.append((a, kind, b))
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in sorted(spans))


def _sample(docs: DataFrame) -> DataFrame:
    """Labelled windows (text and tags) of the sampled documents."""
    total = max(docs.count(), 1)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, SAMPLE_DOCS / total))

    def windows(text):
        tags = _tags(len(text), base_spans(text))
        starts = _window_starts(text)
        starts = starts[(starts > -WIDTH) & (starts < len(text))]
        if len(starts) > 8:  # of one document; this is a training sample
            starts = starts[np.linspace(0, len(starts) - 1, 8).astype(int)]
        for at in starts.tolist():
            lo, hi = max(at, 0), min(at + WIDTH, len(text))
            before, after = max(-at, 0), at + WIDTH - hi
            own = "\0" * before + text[lo:hi] + "\0" * after
            marks = np.pad(tags[lo:hi], (before, after))
            yield own, marks
            # the same without the plus sign, while the digits keep their tag
            plus = [i for i in np.flatnonzero(marks == 4) if own[i] == "+"]
            if plus:
                i = plus[0]
                yield own[:i] + own[i + 1 :] + "\0", np.append(np.delete(marks, i), 0)

    def run(batches):
        for batch in batches:
            rows = [w for t in batch.column(0).to_pylist() if t for w in windows(t)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([t for t, _ in rows], pa.string()),
                    pa.array(["".join(map(str, m)) for _, m in rows], pa.string()),
                ],
                ["text", "tags"],
            )

    rows = docs.where(part).select("text").mapInArrow(run, "text string, tags string")
    # windows without personal data teach as well, but need not outnumber the others
    plain = ~F.col("tags").rlike("[1-4]")
    return rows.distinct().orderBy(plain & (F.pmod(F.xxhash64("text"), F.lit(4)) > 0), F.xxhash64("text"), "text")


def train(docs: DataFrame) -> bilstm.Tagger | None:
    bounded_batches(docs.sparkSession)
    rows = _sample(docs).limit(WINDOWS).collect()
    if not any(set(r.tags) - {"0"} for r in rows):
        return None
    codes = np.zeros((len(rows), WIDTH), np.int64)
    tags = np.zeros((len(rows), WIDTH), np.int64)
    for i, r in enumerate(rows):
        codes[i, : len(r.text)] = bilstm.codes_of(r.text)
        tags[i, : len(r.tags)] = [int(c) for c in r.tags]
    return bilstm.train(codes, tags, len(KINDS) + 1)


def _found(text: str | None, tagger: bilstm.Tagger | None) -> tuple[list[Span], list[Span]]:
    text = text or ""
    if not _TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    return base, base + (added_spans(text, base, tagger) if tagger else [])


def find(docs: DataFrame, tagger: bilstm.Tagger | None) -> DataFrame:
    """doc_id, base spans by kind, digest of the base spans, all spans, added spans."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            rows = [_found(t, tagger) for t in batch.column(1).to_pylist()]
            count = [
                pa.array([sum(s[1] == k for s in base) for base, _ in rows], pa.int64())
                for k in range(len(KINDS))
            ]
            digest = [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *count,
                    pa.array(digest, pa.string()),
                    pa.array([_joined(every) for _, every in rows], pa.string()),
                    pa.array([len(every) - len(base) for base, every in rows], pa.int64()),
                ],
                names,
            )

    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long"
    )


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span, or run of overlapping spans, as [KIND] of its first."""
    out, done, last = [], 0, -1
    for a, kind, b in sorted(spans):
        if a < last:
            last = max(last, b)
            done = last
            continue
        out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = last = b
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, tagger: bilstm.Tagger | None) -> DataFrame:
    """The documents with their personal data masked; `n_chars`, if there, follows."""
    bounded_batches(docs.sparkSession)
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = [
                None if t is None else masked(t, _found(t, tagger)[1])
                for t in batch.column(place).to_pylist()
            ]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns and isinstance(docs.schema["n_chars"].dataType, T.IntegralType):
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out
