"""Operator 7: benchmark decontamination by suffix arrays over the training texts.

Every task cuts its documents into shards of about SHARD_BYTES and sorts all word
suffixes of a shard: first by one word, then by pairs of sorted halves, 2, 4, 8
and 16 words deep; only suffixes that still tie are sorted again. Every suffix of
every benchmark item is then looked up by binary search. Windows of `window` words
give all places of verbatim matches; for the longest match of an item its suffixes
are compared with their neighbours in the array, word by word to the end.

The benchmark is sent to the tasks in blocks of BLOCK_BYTES, which a task searches
one after another, holding one at a time. Documents never move: no shuffle.

Null and empty texts have no words and are never contaminated; benchmark items
without words take no part. An item of fewer than `window` words is one window.
Equal item ids count as one item; a null item_id is written as an empty string. An empty benchmark
leaves everything clean. Repeated documents are judged each for itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.textscan import ALNUM, bounded_batches, mix, scan, slices, text_buffer

WINDOW = 10
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20
_DEPTH = 16


@dataclass
class Suffixes:
    """Words of a shard, one 0 after each text, and their sorted suffixes."""

    key: np.ndarray
    order: np.ndarray


def suffix_array(key: np.ndarray, first: np.ndarray) -> Suffixes:
    texts = len(first) - 1
    owner = np.repeat(np.arange(texts), np.diff(first))
    words = np.zeros(len(key) + texts + _DEPTH, np.uint64)
    words[np.arange(len(key)) + owner] = np.maximum(key, np.uint64(1))
    n = len(key) + texts
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    places = np.arange(n)
    order = np.argsort(rank[:n], kind="stable")
    sorted_by = rank[order]
    depth = 1
    while True:
        new = np.ones(len(places), dtype=bool)
        new[1:] = sorted_by[1:] != sorted_by[:-1]
        last = np.ones(len(places), dtype=bool)
        last[:-1] = new[1:]
        head = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        rank[order[places]] = head + 1
        rank[n:] = 0
        places = places[~(new & last)]
        if depth >= _DEPTH or not len(places):
            return Suffixes(words, order)
        at = order[places]
        pair = (rank[at] << 32) | rank[at + depth]
        by = np.argsort(pair, kind="stable")
        order[places] = at[by]
        sorted_by = pair[by]
        depth *= 2


def _bound(array: Suffixes, wanted: np.ndarray, after: bool) -> np.ndarray:
    """First place in the order whose suffix is >= (after: >) each row of `wanted`."""
    low = np.zeros(len(wanted), np.int64)
    high = np.full(len(wanted), len(array.order), np.int64)
    depth = wanted.shape[1]
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) >> 1
        at = array.order[middle]
        right = np.full(len(open_), after)
        undecided = np.arange(len(open_))
        for k in range(depth):
            here = array.key[np.minimum(at[undecided] + k, len(array.key) - 1)]
            there = wanted[open_[undecided], k]
            right[undecided[here < there]] = True
            right[undecided[here > there]] = False
            undecided = undecided[here == there]
            if not len(undecided):
                break
        low[open_[right]] = middle[right] + 1
        high[open_[~right]] = middle[~right]


@dataclass
class Bench:
    """Words of a block of items, and its distinct windows by length."""

    items: list[str]
    item: np.ndarray
    key: np.ndarray
    first: np.ndarray
    windows: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]


def _prepare(ids: list, texts: list, window: int) -> Bench:
    column = pa.array(["" if t is None else t for t in texts], pa.large_string())
    buf, bounds = text_buffer(column)
    words = scan(buf, bounds, ALNUM)
    key = np.maximum(words.key, np.uint64(1))
    names = sorted({"" if i is None else str(i) for i in ids})
    number = {name: k for k, name in enumerate(names)}
    item = np.array([number["" if i is None else str(i)] for i in ids], np.int64)
    count = np.diff(words.first)
    windows = []
    for size in sorted({min(int(c), window) for c in count if c}):
        own = np.flatnonzero(count >= window if size == window else count == size)
        at = [np.arange(words.first[i], words.first[i + 1] - size + 1) for i in own]
        owner = np.repeat(item[own], [len(a) for a in at])
        at = np.concatenate(at)
        rows = key[at[:, None] + np.arange(size)]
        digest = np.zeros(len(rows), np.uint64)
        for k in range(size):
            digest = mix(digest + rows[:, k])
        _, one, which = np.unique(digest, return_index=True, return_inverse=True)
        pairs = np.unique(np.stack([which, owner], 1), axis=0)
        starts = np.searchsorted(pairs[:, 0], np.arange(len(one) + 1))
        windows.append((size, rows[one], starts, pairs[:, 1]))
    return Bench(names, item, key, words.first, windows)


def _blocks(spark: SparkSession, benchmark: DataFrame, window: int) -> list:
    """Broadcasts of the prepared items, BLOCK_BYTES of text each."""
    out, ids, texts, size = [], [], [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1] or "")
        if size >= BLOCK_BYTES:
            out.append(spark.sparkContext.broadcast(_prepare(ids, texts, window)))
            ids, texts, size = [], [], 0
    if ids:
        out.append(spark.sparkContext.broadcast(_prepare(ids, texts, window)))
    return out


def _each(blocks: list) -> Iterator[Bench]:
    for block in blocks:
        yield block.value
        if len(blocks) > 1:
            block.__dict__.pop("_value", None)  # one block in memory at a time


def _match(array: Suffixes, bench: Bench, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cover steps along the words, and the (text, item) pairs found."""
    step = np.zeros(len(array.key) + 1, np.int64)
    pairs = []
    present = np.unique(array.key)
    for size, rows, starts, items in bench.windows:
        spot = np.minimum(np.searchsorted(present, rows[:, 0]), len(present) - 1)
        there = np.flatnonzero(present[spot] == rows[:, 0])
        low = _bound(array, rows[there], False)
        high = _bound(array, rows[there], True)
        some = high > low
        which, low, count = there[some], low[some], (high - low)[some]
        if not len(which):
            continue
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = array.order[np.repeat(low, count) + inner]
        np.add.at(step, at, 1)
        np.add.at(step, at + size, -1)
        seen = np.unique(np.stack([text_of[at], np.repeat(which, count)], 1), axis=0)
        per = np.diff(starts)[seen[:, 1]]
        inner = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        found = items[np.repeat(starts[seen[:, 1]], per) + inner]
        pairs.append(np.unique(np.stack([np.repeat(seen[:, 0], per), found], 1), axis=0))
    both = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
    return step, np.unique(both, axis=0)


def _shard(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, Suffixes, np.ndarray]]:
    buf, bounds = text_buffer(column)
    for lo, hi in slices(bounds, SHARD_BYTES):
        own = bounds[lo : hi + 1]
        words = scan(buf[own[0] : own[-1]], own - own[0], ALNUM)
        text_of = np.repeat(np.arange(hi - lo), np.diff(words.first) + 1)
        text_of = np.concatenate([text_of, np.full(_DEPTH, hi - lo)])
        yield lo, hi, np.diff(words.first), suffix_array(words.key, words.first), text_of


def judge(column: pa.Array, blocks: list) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in ("n_words", "n_hit", "n_items", "items_sha256")}
    for lo, hi, count, array, text_of in _shard(column):
        cover = np.zeros(len(array.key) + 1, np.int64)
        names: dict[int, set] = {}
        for bench in _each(blocks):
            step, pairs = _match(array, bench, text_of)
            cover += step
            for text, item in pairs.tolist():
                names.setdefault(text, set()).add(bench.items[item])
        hit = np.cumsum(cover)[: len(array.key)] > 0
        hits = np.bincount(text_of[hit], minlength=hi - lo + 1)[: hi - lo]
        out["n_words"] += count.tolist()
        out["n_hit"] += hits.tolist()
        for text in range(hi - lo):
            own = sorted(names.get(text, ()))
            out["n_items"].append(len(own))
            out["items_sha256"].append(hashlib.sha256(",".join(own).encode()).hexdigest())
    return out


def _gathered(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """Batches joined up to a shard's size."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(batch.schema.get_field_index(name)).nbytes
        if size >= SHARD_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    table = pa.Table.from_batches(held).combine_chunks() if held else None
    if table is not None and table.num_rows:
        yield table.to_batches()[0]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, words inside matches, items found, and the verdict."""
    bounded_batches(docs.sparkSession)
    blocks = _blocks(docs.sparkSession, benchmark, window)

    def run(batches):
        for batch in _gathered(batches, "text"):
            found = judge(batch.column(1), blocks)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(found["n_words"], pa.int64()),
                    pa.array(found["n_hit"], pa.int64()),
                    pa.array(found["n_items"], pa.int64()),
                    pa.array(found["items_sha256"], pa.string()),
                    pa.array([n > 0 for n in found["n_hit"]], pa.bool_()),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string,"
        " contaminated boolean",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without verbatim benchmark passages, all columns as they are."""
    bounded_batches(docs.sparkSession)
    blocks = _blocks(docs.sparkSession, benchmark, window)
    place = docs.columns.index("text")

    def run(batches):
        for batch in _gathered(batches, "text"):
            clean = [n == 0 for n in judge(batch.column(place), blocks)["n_hit"]]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _longest(array: Suffixes, bench: Bench) -> tuple[np.ndarray, np.ndarray]:
    """For every suffix of every item: words of its longest match, and a place of it."""
    at = np.arange(len(bench.key))
    owner = np.searchsorted(bench.first, at, side="right") - 1
    limit = bench.first[owner + 1] - at
    rows = np.concatenate([bench.key, np.zeros(_DEPTH, np.uint64)])[at[:, None] + np.arange(_DEPTH)]
    rows[np.arange(_DEPTH) >= limit[:, None]] = 0
    low, high = _bound(array, rows, False), _bound(array, rows, True)
    best, where = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    # the neighbours on both sides, and all suffixes that tie _DEPTH words deep
    offset = -1
    while True:
        place = low + offset
        some = np.flatnonzero((place >= 0) & (place < len(array.order)) & (place <= high))
        if offset > 0 and not len(some):
            return best, where
        begin = array.order[place[some]]
        length = np.zeros(len(some), np.int64)
        live = np.arange(len(some))
        while len(live):
            live = live[length[live] < limit[some[live]]]
            here = array.key[np.minimum(begin[live] + length[live], len(array.key) - 1)]
            live = live[here == bench.key[at[some[live]] + length[live]]]
            length[live] += 1
        better = length > best[some]
        best[some[better]], where[some[better]] = length[better], begin[better]
        offset += 1


def longest_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per item its longest verbatim match in the documents, and where one lies.

    Columns item_id (string), words, item_start, doc_id, doc_start; starts count
    words from 0. Items that share no word with the documents are absent. Among
    equal lengths the smallest doc_id of the shards' own choices is named.
    """
    bounded_batches(docs.sparkSession)
    blocks = _blocks(docs.sparkSession, benchmark, WINDOW)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in _gathered(batches, "text"):
            for lo, _hi, count, array, text_of in _shard(batch.column(1)):
                begin_of = np.concatenate([[0], np.cumsum(count + 1)])
                for bench in _each(blocks):
                    best, where = _longest(array, bench)
                    heads = bench.first[:-1][np.diff(bench.first) > 0]
                    if not len(heads):
                        continue
                    owner = np.searchsorted(bench.first, np.arange(len(best)), side="right") - 1
                    top = np.lexsort((np.arange(len(best)), -best, owner))
                    top = top[np.searchsorted(owner[top], np.unique(owner))]
                    top = top[best[top] > 0]
                    text = text_of[where[top]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([bench.items[k] for k in bench.item[owner[top]]], pa.string()),
                            pa.array(best[top]),
                            pa.array(top - bench.first[owner[top]]),
                            batch.column(0).take(pa.array(lo + text)),
                            pa.array(where[top] - begin_of[text]),
                        ],
                        ["item_id", "words", "item_start", "doc_id", "doc_start"],
                    )

    found = docs.select("doc_id", "text").mapInArrow(
        run, f"item_id string, words long, item_start long, doc_id {kind}, doc_start long"
    )
    order = F.struct(F.col("words"), -F.col("doc_id"), -F.col("doc_start"), -F.col("item_start"))
    best = F.max_by(F.struct("words", "item_start", "doc_id", "doc_start"), order)
    return found.groupBy("item_id").agg(best.alias("b")).select("item_id", "b.*")
