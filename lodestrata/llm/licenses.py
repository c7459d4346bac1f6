"""Operator 9: licence scan with a positional index on rare licence words.

A template is a licence's wording with mandatory key phrases. The index holds the
postings (template, position) of every template word. Over all documents the
document frequency of the templates' words is counted first; every key phrase is
then anchored at its word of highest IDF. A document's anchor words are looked up,
each posting gives a template and an offset (position in the text minus position
in the template), postings that agree on the offset are intersected, and a key
phrase counts only where all its words stand at their relative positions. The
score of such a place is the IDF-weighted share of the template's words that
stand at their places; a document's score is its best place.

Base phrases are templates like any other, so every place of theirs is found.

Null and empty texts have no words, no labels and score 0. Repeated documents are
judged each for itself. Broadcast: the index, whose size is that of TEMPLATES.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.textscan import ALNUM, Words, bounded_batches, scan_column, word_key

# Phrases of the base and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Wording of public licences (lower case, words only), label, and
# the phrases that must be present, word for word, for the label to count.
TEMPLATES = [
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files",
        ["permission is hereby granted free of charge"],
    ),
    ("mit", "spdx license identifier mit", ["license identifier mit"]),
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file"
        " except in compliance with the license",
        ["apache license version 2"],
    ),
    ("apache-2", "spdx license identifier apache 2 0", ["license identifier apache 2 0"]),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
        ["redistribution and use in source and binary forms"],
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted",
        ["use copy modify and or distribute this software for any purpose"],
    ),
    ("gpl-3", "gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-2", "gnu general public license version 2", ["gnu general public license version 2"]),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms"
        " of the gnu general public license as published by the free software foundation",
        ["gnu general public license as published by the free software foundation"],
    ),
    ("lgpl", "gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl", "gnu affero general public license", ["gnu affero general public license"]),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ["mozilla public license v 2 0"],
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ["free and unencumbered software released into the public domain"],
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    (
        "cc-by",
        "licensed under a creative commons attribution 4 0 international license",
        ["creative commons attribution 4 0 international license"],
    ),
    ("cc0", "cc0 1 0 universal public domain dedication", ["cc0 1 0 universal"]),
    ("all-rights-reserved", "all rights reserved", ["all rights reserved"]),
]


@dataclass
class Template:
    label: str
    base: bool
    words: np.ndarray
    phrases: list[tuple[int, int]]


@dataclass
class Index:
    """Sorted keys of all template words, the templates, and the words' IDF."""

    key: np.ndarray
    templates: list[Template]
    idf: np.ndarray

    def anchors(self) -> list[tuple[int, int, int]]:
        """(word, template, position) of the rarest word of every key phrase."""
        out = []
        for number, t in enumerate(self.templates):
            for begin, size in t.phrases:
                own = t.words[begin : begin + size]
                at = begin + int(np.argmax(self.idf[own]))
                out.append((int(t.words[at]), number, at))
        return out


def build_index(templates=None, base=None) -> Index:
    templates = TEMPLATES if templates is None else templates
    base = BASE if base is None else base
    rows = [(label, False, words.split(), phrases) for label, words, phrases in templates]
    rows += [(label, True, phrase.split(), [phrase]) for phrase, label in base.items()]
    names = sorted({w for _, _, words, _ in rows for w in words})
    keys = np.array([word_key(w) for w in names], np.uint64)
    order = np.argsort(keys)
    number = {names[k]: i for i, k in enumerate(order)}
    out = []
    for label, is_base, words, phrases in rows:
        places = []
        for phrase in phrases:
            wanted = phrase.split()
            places += [
                (i, len(wanted))
                for i in range(len(words))
                if words[i : i + len(wanted)] == wanted
            ][:1]
        out.append(Template(label, is_base, np.array([number[w] for w in words]), places))
    return Index(keys[order], out, np.ones(len(names)))


def _terms(index: Index, words: Words) -> np.ndarray:
    """Number of each word among the template words, else -1."""
    at = np.minimum(np.searchsorted(index.key, words.key), len(index.key) - 1)
    return np.where(index.key[at] == words.key, at, -1)


def with_frequencies(docs: DataFrame, index: Index) -> Index:
    """The index with the IDF of its words over all documents."""

    def count(batches):
        total = np.zeros(len(index.key) + 1, np.int64)
        for batch in batches:
            total[-1] += batch.num_rows
            for _lo, _hi, words in scan_column(batch.column(0), ALNUM):
                term = _terms(index, words)
                known = np.flatnonzero(term >= 0)
                pair = np.unique(words.owner()[known] * len(index.key) + term[known])
                total[:-1] += np.bincount(pair % len(index.key), minlength=len(index.key))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.array(total)], ["term", "n"]
        )

    counted = docs.select("text").mapInArrow(count, "term long, n long")
    df = {r.term: r.n for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    rows = df.get(len(index.key), 0)
    idf = [math.log((rows + 1) / (df.get(k, 0) + 1)) + 1 for k in range(len(index.key))]
    return Index(index.key, index.templates, np.array(idf))


def _places(index: Index, anchors, words: Words):
    """Verified places: text, start word, template, score of each."""
    term = _terms(index, words)
    owner = words.owner()
    out = []
    if not len(term):
        return out
    for word in sorted({a[0] for a in anchors}):
        here = np.flatnonzero(term == word)
        if not len(here):
            continue
        for _, number, at in (a for a in anchors if a[0] == word):
            t = index.templates[number]
            begin = here - at
            spot = begin[:, None] + np.arange(len(t.words))
            low = words.first[owner[here]][:, None]
            high = words.first[owner[here] + 1][:, None]
            inside = (spot >= low) & (spot < high)
            same = inside & (term[np.clip(spot, 0, len(term) - 1)] == t.words)
            whole = np.zeros(len(here), dtype=bool)
            for p, size in t.phrases:
                # the phrase that this anchor belongs to must be there, word for word
                if p <= at < p + size:
                    whole |= same[:, p : p + size].all(axis=1)
            score = (same * index.idf[t.words]).sum(axis=1) / index.idf[t.words].sum()
            for k in np.flatnonzero(whole):
                out.append((int(owner[here[k]]), int(begin[k]), number, float(score[k])))
    return out


def scan_licenses(docs: DataFrame, index: Index | None = None) -> DataFrame:
    """Per document: base places, labels of verified templates, and the best score."""
    bounded_batches(docs.sparkSession)
    index = with_frequencies(docs, build_index() if index is None else index)
    anchors = index.anchors()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("n_words", "n_base", "first", "last", "base", "all", "score")}
            for lo, hi, words in scan_column(batch.column(1), ALNUM):
                by_text: dict[int, list] = {}
                for text, begin, number, score in _places(index, anchors, words):
                    by_text.setdefault(text, []).append((begin, number, score))
                count = np.diff(words.first)
                for text in range(hi - lo):
                    found = by_text.get(text, [])
                    head = int(words.first[text])
                    base = {
                        (b - head, n) for b, n, _ in found if index.templates[n].base
                    }
                    own = {index.templates[n].label for _, n in base}
                    every = own | {index.templates[n].label for _, n, _ in found}
                    out["n_words"].append(int(count[text]))
                    out["n_base"].append(len(base))
                    out["first"].append(min((b for b, _ in base), default=None))
                    out["last"].append(max((b for b, _ in base), default=None))
                    out["base"].append(",".join(sorted(own)))
                    out["all"].append(",".join(sorted(every)))
                    out["score"].append(min(1.0, max((s for _, _, s in found), default=0.0)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            columns = [pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    names = "doc_id n_words n_base first_word last_word base_labels labels score".split()
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long,"
        " base_labels string, labels string, score double",
    )
