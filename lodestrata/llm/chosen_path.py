"""Operator 12: near copies by a chosen-path set similarity join.

A document's set holds its distinct shingles (runs of `size` words; a shorter text is one
shingle). Documents with equal sets form a class; classes are searched for similar ones:

1. Trees. At the root of each of TREES independent trees a class goes to a child for
   every shingle whose hash, by tree, is below 1 / (t n), and for its least
   one: about one and a half of them, and a similar class chooses one of the same with a
   probability near 0.87. So 1 - 0.13 ** 8 of the similar pairs meet in a node at least.
2. Small nodes (up to SMALL classes) are compared exhaustively by sketches: the least
   shingle of each of BINS bins, one byte each. The cut is 4.5 standard deviations below t.
3. In a larger node every class is first compared with one hub, the class with most
   copies. Confirmed links are joined to components; what is in one component needs
   no more comparison. Nodes of up to MIDDLE classes outside their largest component are
   compared chunk by chunk: one-bit sketches first, all pairs of two chunks by one matrix
   product, then the sketches; the sets of what is near follow. Larger nodes branch again, by
   hashes of their path; at DEPTH all are compared.
4. Every link is confirmed on the full sets: in chunks at once; of the candidates of 2 and the
   hubs those for the nearest and for the most copied partner of each class first, and of
   the others only those that join two components.

Within a node, candidates that are almost surely alike are reported as a chain, not as all
pairs. Links and equal sets are joined to components.

Texts without words, and null, have an empty set and no links; repeated documents are
copies. Component ids are the least doc_id; a component of null ids only has none, and
keeps its documents. Shingles are 64-bit keys. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.textscan import SPACED, bounded_batches, mix, scan_column, window_keys
from lodestrata.session import stage

SIZE = 4
PERCENT = 80
TREES = 8
DEPTH = 6
#: Bytes of a sketch; the bin of a shingle is the first byte of its key.
BINS = 256
#: Classes of a node that are compared exhaustively.
SMALL = 64
#: Classes outside a node's largest component beyond which it branches again.
MIDDLE = 1 << 13
#: Classes of one chunk of a larger node, compared by sketches.
CHUNK = 1 << 12
#: Shingles of one chunk of what is left, besides single sets that are larger.
CHUNK_TOKENS = 1 << 19
#: Slots of the filter that picks texts to read again: its size is fixed.
FILTER_SLOTS = 1 << 20
#: Bytes of text whose sets are made at once.
SLICE = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ALL = float(2**64)
_K = np.uint64(0x9E3779B97F4A7C15)


def _cut(percent: int) -> float:
    """Estimate below which a pair of sets that are similar enough hardly falls."""
    t = percent / 100
    return t - 4.5 * (t * (1 - t) / BINS) ** 0.5


def _sure(percent: int) -> float:
    t = percent / 100
    return t + 3.5 * (t * (1 - t) / BINS) ** 0.5


def _sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, texts, sorted distinct keys, bounds) of slices of a column."""
    for lo, _hi, words in scan_column(column, SPACED, SLICE):
        key, at = window_keys(words.key, words.first, size)
        text = np.searchsorted(words.first, at, side="right") - 1
        order = np.lexsort((key, text))
        key, text = key[order], text[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
        n = len(words.first) - 1
        yield lo, n, key[new], np.searchsorted(text[new], np.arange(n + 1))


def _class_of(key: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name of every set (0: empty)."""
    own = np.diff(first)
    out = np.zeros(len(own), np.int64)
    some = np.flatnonzero(own)
    if len(some):
        total = np.add.reduceat(mix(key), first[:-1][some]) + own[some].astype(np.uint64)
        out[some] = mix(total).view(np.int64)
    return out


def _sketches(key: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each set and bin a byte of its least key, 1 to 255; 0 where there is none."""
    out = np.zeros((len(first) - 1, BINS), np.uint8)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = owner * BINS + (key >> np.uint64(56)).astype(np.int64)
    least = np.ones(len(place), dtype=bool)
    least[1:] = place[1:] != place[:-1]
    out.ravel()[place[least]] = (mix(key[least]) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    return out


def _chosen(key: np.ndarray, first: np.ndarray, path: np.ndarray, percent: int, least: bool):
    """(set, child) for the keys that each set chooses in a node; `path` has its node."""
    own = np.diff(first)
    owner = np.repeat(np.arange(len(own)), own)
    draw = mix(key ^ (path[owner] * _K))
    bar = _ALL * 100 / percent / np.maximum(own, 1)
    chosen = draw < bar[owner]
    some = np.flatnonzero(own)
    if least and len(some):
        lowest = np.zeros(len(own), np.uint64)
        lowest[some] = np.minimum.reduceat(draw, first[:-1][some])
        chosen |= draw == lowest[owner]
    at = owner[chosen]
    return at, mix(mix(path[at] + np.uint64(1)) + key[chosen] * _K)


def _digests(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per document: class (node), size of the set, sketch, and children of the roots."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = batch.num_rows
            count, node = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            sketch: list = [None] * rows
            at, child = [], []
            for lo, n, key, first in _sets(batch.column(2), size):
                count[lo : lo + n] = np.diff(first)
                node[lo : lo + n] = _class_of(key, first)
                for i, own in enumerate(_sketches(key, first)):
                    sketch[lo + i] = own.tobytes()
                for tree in range(TREES):
                    own, path = _chosen(key, first, np.full(n, tree, np.uint64), percent, True)
                    at.append(lo + own)
                    child.append(path)
            place = np.concatenate(at) if at else np.zeros(0, np.int64)
            order = np.argsort(place, kind="stable")
            paths = np.concatenate(child)[order] if child else np.zeros(0, np.uint64)
            bounds = np.searchsorted(place[order], np.arange(rows + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(count),
                    pa.array(node),
                    pa.array(sketch, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(paths.view(np.int64))),
                ],
                ["doc_id", "text_key", "n", "node", "sketch", "paths"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(
        run, f"doc_id {kind}, text_key long, n long, node long, sketch binary, paths array<long>"
    )


def _bytes(column: pa.Array) -> np.ndarray:
    """Sketches of a binary column as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BINS)


def _estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of pairs of sketches, along the last axis."""
    same = a == b
    same &= a > 0
    return _trues(same) / np.maximum(_trues((a | b) > 0), 1)


def _trues(flags: np.ndarray) -> np.ndarray:
    """How many of the BINS flags along the last axis are set, eight at once."""
    return np.bitwise_count(flags.view(np.uint64)).sum(-1, dtype=np.int64)


_PAIR = "a long, b long, copies_a long, copies_b long, est double"


def _pairs(node_a, node_b, copies_a, copies_b, est) -> pa.RecordBatch:
    arrays = [pa.array(np.asarray(x, np.int64)) for x in (node_a, node_b, copies_a, copies_b)]
    names = ["a", "b", "copies_a", "copies_b", "est"]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(np.asarray(est, np.float64))], names)


def _within(nodes: DataFrame, percent: int) -> DataFrame:
    """Candidates of small nodes: rows with `members`, an array of (node, copies, sketch)."""
    cut, sure = _cut(percent), _sure(percent)

    def run(batches):
        for batch in batches:
            members = batch.column(0)
            flat = members.flatten()
            node, copies = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            sketch = _bytes(flat.field(2))
            first = members.offsets.to_numpy() - members.offsets[0].as_py()
            size = np.diff(first)
            out = []
            for m in np.unique(size):
                start = first[:-1][size == m]
                found = []
                for i in range(m - 1):
                    own = sketch[start + i][:, None]
                    others = start[:, None] + np.arange(i + 1, m)
                    est = _estimates(own, sketch[others])
                    k, j = np.nonzero(est >= cut)
                    found.append((k, np.full(len(k), i), i + 1 + j, est[k, j]))
                if not found:
                    continue
                k, i, j, est = (np.concatenate(x) for x in zip(*found, strict=True))
                keep = _sparse(k * m + i, k * m + j, est, sure)
                a, b = start[k[keep]] + i[keep], start[k[keep]] + j[keep]
                out.append((node[a], node[b], copies[a], copies[b], est[keep]))
            for found in out:
                yield _pairs(*found)

    return nodes.select("members").mapInArrow(run, _PAIR)


def _sparse(a: np.ndarray, b: np.ndarray, est: np.ndarray, sure: float) -> np.ndarray:
    """Places of the pairs to report: sure ones as a forest, others between its trees."""
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    keep = []
    for p in np.argsort(-est, kind="stable").tolist():
        x, y = find(int(a[p])), find(int(b[p]))
        if x == y:
            continue
        if est[p] >= sure:
            root[max(x, y)] = min(x, y)
        keep.append(p)
    return np.array(keep, np.int64)


def _with_hub(rows: DataFrame, percent: int) -> DataFrame:
    """Candidates of (node, copies, sketch, hub, hub_copies, hub_sketch)."""
    cut = _cut(percent)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            node, copies, _, hub, hub_copies, _ = batch.columns
            est = _estimates(_bytes(batch.column(2)), _bytes(batch.column(5)))
            at = np.flatnonzero(est >= cut)
            columns = [x.to_numpy()[at] for x in (node, hub, copies, hub_copies)]
            yield _pairs(*columns, est[at])

    columns = ("node", "copies", "sketch", "hub", "hub_copies", "hub_sketch")
    return rows.select(*columns).mapInArrow(run, _PAIR)


def _chunk_pairs(rows: DataFrame, chunks: Column, *columns: str) -> DataFrame:
    """(path, few, many): all pairs of chunks of a node; `many` is null for a chunk with itself.

    A node is dealt out by chunk, of which it has `chunks`; most have one.
    """
    dealt = rows.withColumn("_chunks", chunks.cast("long"))
    dealt = dealt.withColumn("_chunk", F.pmod(F.xxhash64("node"), F.col("_chunks"))).repartition("path", "_chunk")
    member = F.collect_list(F.struct(*columns)).alias("few")
    groups = dealt.groupBy("path", "_chunk", "_chunks").agg(member)
    own = groups.select("path", "few", F.lit(None).cast(groups.schema["few"].dataType).alias("many"))
    several = stage(groups.where("_chunks > 1").select("path", "_chunk", "few"), "chunks")
    other = several.select("path", F.col("_chunk").alias("_part"), F.col("few").alias("many"))
    across = several.join(other, "path").where("_part < _chunk").select("path", "few", "many")
    return own.unionAll(across)


def _nearby(rows: DataFrame, percent: int) -> DataFrame:
    """(path, node) of the members (node, comp, sketch) that are near one of another component."""

    def run(batches):
        for batch in batches:
            for path, few, many in zip(*batch.columns, strict=True):
                own = few.values
                other = own if many.values is None else many.values
                sketch, theirs = _bytes(own.field(2)), _bytes(other.field(2))
                comp, their_comp = own.field(1).to_numpy(), other.field(1).to_numpy()
                is_near, they_are = np.zeros(len(sketch), dtype=bool), np.zeros(len(theirs), dtype=bool)
                for i, j in _near(sketch, theirs, comp, their_comp, percent):
                    is_near[i], they_are[j] = True, True
                near = np.union1d(own.field(0).to_numpy()[is_near], other.field(0).to_numpy()[they_are])
                paths = pa.array(np.full(len(near), path.as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([paths, pa.array(near.astype(np.int64))], ["path", "node"])

    return rows.select("path", "few", "many").mapInArrow(run, "path long, node long").distinct()


def _opened(rows: DataFrame, percent: int) -> DataFrame:
    """Links between members (node, comp, tokens) of different components, as few as join them."""

    def sets(members):
        blobs = [np.frombuffer(x.as_py(), np.uint64) for x in members.field(2)]
        first = np.concatenate([[0], np.cumsum([len(x) for x in blobs])]).astype(np.int64)
        key = np.concatenate(blobs)
        return members.field(0).to_numpy(), members.field(1).to_numpy(), key, first, _sketches(key, first)

    def run(batches):
        for batch in batches:
            for few, many in zip(*batch.columns, strict=True):
                node, comp, own, first, sketch = sets(few.values)
                if many.values is None:
                    others, their_comp, their, their_first, their_sketch = node, comp, own, first, sketch
                else:
                    others, their_comp, their, their_first, their_sketch = sets(many.values)
                number, root = np.unique(np.concatenate([comp, their_comp]), return_inverse=True)
                root, their_root, label = root[: len(comp)], root[-len(their_comp) :], np.arange(len(number))
                shared, out = _Shared(own, first, their, their_first), []
                for a, b in _near(sketch, their_sketch, comp, their_comp, percent):
                    cut = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else []
                    for i, j in zip(a[cut].tolist(), np.split(b, cut[1:]), strict=True):
                        j = j[label[their_root[j]] != label[root[i]]]
                        for other in j[shared.similar(i, j, percent)].tolist() if len(j) else ():
                            x, y = label[root[i]], label[their_root[other]]
                            if x != y:
                                label[label == x] = y
                                out.append((int(node[i]), int(others[other])))
                a, b = (pa.array([p[k] for p in out], pa.int64()) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([a, b, pa.array([True] * len(out), pa.bool_())], ["a", "b", "linked"])

    return rows.select("few", "many").mapInArrow(run, "a long, b long, linked boolean")


def _near(a: np.ndarray, b: np.ndarray, comp_a: np.ndarray, comp_b: np.ndarray, percent: int):
    """Pairs of sketches of different components that may be similar enough.

    With one bit a bin, what two sets do not share agrees half the time: the product of
    signs estimates the similarity by itself, with a larger error.
    """
    t = percent / 100
    low, cut = t - 4.5 * ((1 - t * t) / BINS) ** 0.5, _cut(percent)
    signs = [np.where(x > 0, (x & 1).astype(np.float32) * 2 - 1, 0).astype(np.float32) for x in (a, b)]
    filled_a, filled_b = (a > 0).sum(1), (b > 0).sum(1)
    for lo in range(0, len(a), 256):
        rows = slice(lo, lo + 256)
        near = signs[0][rows] @ signs[1].T >= low * np.maximum(filled_a[rows, None], filled_b)
        near &= comp_a[rows, None] != comp_b
        i, j = np.nonzero(near)
        for at in range(0, len(i), 4096):
            own, other = lo + i[at : at + 4096], j[at : at + 4096]
            some = _estimates(a[own], b[other]) >= cut
            yield own[some], other[some]


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


class _Shared:
    """Exact tests of one set of a chunk against several of another.

    Shingles are numbered once; a set is marked over these numbers, and the marks that
    the other sets meet are summed.
    """

    def __init__(self, own: np.ndarray, first: np.ndarray, their: np.ndarray, their_first: np.ndarray):
        number, at = np.unique(np.concatenate([own, their]), return_inverse=True)
        self.own, self.their = at[: len(own)], at[len(at) - len(their) :]
        self.first, self.their_first = first, their_first
        self.mark = np.zeros(len(number), np.uint8)

    def similar(self, i: int, j: np.ndarray, percent: int) -> np.ndarray:
        """Which of the sets j (rising) are similar enough to set i."""
        own = self.own[self.first[i] : self.first[i + 1]]
        start, size = self.their_first[j], self.their_first[j + 1] - self.their_first[j]
        self.mark[own] = 1
        if 4 * size.sum() < len(self.their):
            head = np.cumsum(size) - size
            met = self.mark.take(self.their.take(np.arange(size.sum()) + np.repeat(start - head, size)))
            both = np.add.reduceat(met, head, dtype=np.int64)
        else:
            both = np.add.reduceat(self.mark.take(self.their), self.their_first[:-1], dtype=np.int64)[j]
        self.mark[own] = 0
        return 100 * both >= percent * (len(own) + size - both)


def _written(df: DataFrame, name: str, rows: int) -> DataFrame:
    """Stage with Arrow batches of `rows` rows, for rows that hold whole nodes or sets."""
    conf = df.sparkSession.conf
    before = conf.get(_BATCH)
    conf.set(_BATCH, str(rows))
    try:
        return stage(df.select("*"), name)
    finally:
        conf.set(_BATCH, before)


def _once(pairs: DataFrame) -> DataFrame:
    """Each pair once, a < b."""
    turned = F.col("a") > F.col("b")

    def side(one: str, other: str) -> Column:
        return F.when(turned, F.col(other)).otherwise(F.col(one))

    rows = pairs.select(
        side("a", "b").alias("a"),
        side("b", "a").alias("b"),
        side("copies_a", "copies_b").alias("copies_a"),
        side("copies_b", "copies_a").alias("copies_b"),
        "est",
    ).where("a <> b")
    return rows.groupBy("a", "b").agg(
        F.first("copies_a").alias("copies_a"), F.first("copies_b").alias("copies_b"), F.max("est").alias("est")
    )


def _picks(pairs: DataFrame, percent: int) -> DataFrame:
    """For every class its nearest partner, and the most copied of those that look similar."""
    both = pairs.select("a", "b", "copies_b", "est").unionAll(
        pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("copies_a").alias("copies_b"), "est")
    )
    alike = F.when(F.col("est") * 100 >= percent, F.struct("copies_b", "b"))
    of = both.groupBy("a").agg(F.max(F.struct("est", "b")).alias("near"), F.max(alike).alias("top"))
    out = of.select("a", F.col("near.b").alias("b")).unionAll(of.select("a", F.col("top.b").alias("b")))
    out = out.where("b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return out.distinct()


def _sets_of(
    docs: DataFrame, classes: DataFrame, wanted: DataFrame, size: int, repeated: bool
) -> DataFrame:
    """(node, tokens): the sets of the wanted classes, from one text of each.

    `repeated` tells that equal texts may have equal ids.
    """

    def run(batches):
        for batch in batches:
            asked, found, blobs = batch.column(0).to_numpy(), [], []
            for lo, n, key, first in _sets(batch.column(1), size):
                right = np.flatnonzero(_class_of(key, first) == asked[lo : lo + n])
                found.append(asked[lo + right])
                blobs += [key[first[i] : first[i + 1]].tobytes() for i in right]
            nodes = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(blobs, pa.binary())], ["node", "tokens"])

    one = classes.join(wanted, "node", "left_semi")
    one = one.select("node", F.col("least.doc_id").alias("_id"), F.col("least.text_key").alias("_key"))
    one = stage(one, "representatives")
    texts = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_text_key"), "text")
    texts = _thinned(texts, "_text_key", one, "_key")
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    met = texts.join(one.hint("shuffle_merge"), same)  # grows with the documents: not broadcast at any size
    found = met.select("node", "text").mapInArrow(run, "node long, tokens binary")
    return found.dropDuplicates(["node"]) if repeated else found


def _thinned(rows: DataFrame, key: str, wanted: DataFrame, by: str) -> DataFrame:
    """Rows without most of those whose key is not wanted, before they are shuffled.

    The filter holds the hash slots of the wanted keys, FILTER_SLOTS numbers at most.
    """
    slots = wanted.select(F.pmod(F.xxhash64(by), F.lit(FILTER_SLOTS)).alias("_slot")).distinct()
    slotted = rows.withColumn("_slot", F.pmod(F.xxhash64(key), F.lit(FILTER_SLOTS)))
    return slotted.join(F.broadcast(slots), "_slot", "left_semi").drop("_slot")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with `linked`, by their full sets."""

    def run(batches):
        for batch in batches:
            linked = [
                _similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"]
            )

    pairs = stage(pairs.select("a", "b"), "pairs")
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b"))
    sets = _thinned(sets, "node", ends, "node")
    one = sets.select(F.col("node").alias("a"), F.col("tokens").alias("tokens_a"))
    other = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tokens_b"))
    met = pairs.join(one, "a").join(other, "b")
    met = met.select("a", "b", "tokens_a", "tokens_b")
    return _written(met.mapInArrow(run, "a long, b long, linked boolean"), "confirmed", 64)


def _children(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(path, node) one level down."""

    def run(batches):
        for batch in batches:
            node = batch.column(1).to_numpy()
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column(2)]
            first = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
            key = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            path = batch.column(0).to_numpy().view(np.uint64)
            at, child = _chosen(key, first, path, percent, False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(child.view(np.int64)), pa.array(node[at])], ["path", "node"]
            )

    members = stage(members.select("path", "node"), "branched")
    rows = members.join(_thinned(sets, "node", members, "node"), "node").select("path", "node", "tokens")
    return _written(rows.mapInArrow(run, "path long, node long").distinct(), "entries", 64)


def _met(entries: DataFrame, classes: DataFrame) -> DataFrame:
    """(path, m, hub, node, copies, sketch) of the nodes with two classes or more."""
    nodes = entries.groupBy("path").agg(F.count(F.lit(1)).alias("m"))
    rows = stage(entries.join(nodes.where("m > 1"), "path"), "shared")
    known = _thinned(classes.select("node", "n", "copies", "sketch"), "node", rows, "node")
    return rows.join(known, "node")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionAll(more)
    return out


def linked(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(documents with their class, component (node, root) of the classes that have links)."""
    bounded_batches(docs.sparkSession)
    digests = stage(_digests(docs, size, percent), "digests")
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    classes = stage(
        digests.where("n > 0").groupBy("node").agg(
            F.min(least).alias("least"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("paths").alias("paths"),
        ),
        "classes",
    )
    entries = classes.select(F.explode(F.array_distinct("paths")).alias("path"), "node")
    same = digests.groupBy("doc_id", "text_key").count().where("count > 1")
    repeated = not same.isEmpty()
    sets, roots, checked, waiting, fresh = None, None, [], [], []
    for depth in range(1, DEPTH + 1):
        met = stage(_met(entries, classes), "met")
        member = F.collect_list(F.struct("node", "copies", "sketch")).alias("members")
        small = met.where(F.col("m") <= SMALL).groupBy("path").agg(member)
        large = met.where(F.col("m") > SMALL)
        hub = F.max(F.struct("copies", "node", "sketch")).alias("hub")
        hubs = large.groupBy("path").agg(hub)
        hubs = hubs.select(
            "path",
            F.col("hub.node").alias("hub"),
            F.col("hub.copies").alias("hub_copies"),
            F.col("hub.sketch").alias("hub_sketch"),
        )
        found = _within(small, percent).unionAll(_with_hub(large.join(hubs, "path"), percent))
        found = _written(_once(found), "candidates", 64)
        if sets is None:
            wanted = found.select(F.col("a").alias("node")).unionAll(found.select("b"))
            sets = stage(_sets_of(docs, classes, wanted.unionAll(large.select("node")).distinct(), size, repeated), "sets")
        waiting.append(found)
        checked.append(_confirmed(_picks(found, percent), sets, percent))
        fresh.append(checked[-1])
        if large.isEmpty():
            break
        roots, fresh = _joined(roots, _union(fresh)), []
        opened, branched = _open_large(large, sets, roots, percent, depth)
        fresh.append(opened)
        if branched is None or branched.isEmpty():
            break
        entries = _children(branched, sets, percent)
    if roots is None:
        roots, fresh = _joined(None, _union(fresh)), []
    rest = _once(_union(waiting)).select("a", "b")
    rest = rest.join(_union(checked).select("a", "b").distinct(), ["a", "b"], "left_anti")
    rest = stage(_rooted(rest, roots).where("root_a <> root_b").select("a", "b"), "rest")
    return digests, _joined(roots, _union([*fresh, _confirmed(rest, sets, percent)]))


def _rooted(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs with the components of both sides."""
    for side in ("a", "b"):
        own = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        pairs = pairs.join(own, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    return pairs


def _joined(roots: DataFrame | None, pairs: DataFrame) -> DataFrame:
    """(node, root) of all linked classes, after further pairs; only what these join is touched."""
    pairs = pairs.where("linked").select("a", "b")
    if roots is None:
        return _reached(stage(pairs, "links"))
    links = _rooted(pairs, roots).where("root_a <> root_b")
    links = stage(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), "links")
    if links.isEmpty():
        return roots
    more = _reached(links)
    moved = roots.join(more.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    moved = moved.select("node", F.coalesce("to", "root").alias("root"))
    # classes that were in no component before
    return stage(moved.unionAll(more.join(roots, "node", "left_anti")), "roots")


def _reached(links: DataFrame) -> DataFrame:
    """(node, root): the least node that every node of the links (a, b) reaches.

    In each round a node chooses its least neighbour, or itself; chains of choices go down
    and are followed by doubling. Links within one root are done, the others go on between
    roots, of which each round leaves half at most.
    """
    home = None
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("b"))
        choice = stage(low.select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "choice")
        while True:
            further = choice.select(F.col("node").alias("root"), F.col("root").alias("end"))
            choice = stage(choice.join(further, "root").select("node", "root", "end"), "choice")
            done = choice.where("end <> root").isEmpty()
            choice = choice.select("node", F.col("end").alias("root"))
            if done:
                break
        if home is None:
            home = choice
        else:
            to = choice.select(F.col("node").alias("root"), F.col("root").alias("to"))
            # a root that has no link left stays
            home = home.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
            home = stage(home, "home")
        links = _rooted(links, choice).where("root_a <> root_b")
        links = stage(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(), "links")
        if links.isEmpty():
            return home


def _open_large(
    large: DataFrame, sets: DataFrame, roots: DataFrame, percent: int, depth: int
) -> tuple[DataFrame, DataFrame | None]:
    """Links of the large nodes that can be compared now, and members of the others."""
    known = roots.select("node", F.col("root").alias("comp"))
    members = large.select("path", "node", "n", "sketch").join(known, "node", "left")
    members = stage(members.withColumn("comp", F.coalesce("comp", "node")), "members")
    counts = members.groupBy("path", "comp").agg(F.count(F.lit(1)).alias("k"))
    main = counts.groupBy("path").agg(F.max("k").alias("main"), F.sum("k").alias("all"))
    main = main.select("path", "all", (F.col("all") - F.col("main")).alias("others")).where("others > 0")
    members = members.join(main, "path")
    last = depth == DEPTH
    ready = members if last else members.where(F.col("others") <= MIDDLE)
    near = _nearby(_chunk_pairs(ready, F.ceil(F.col("all") / CHUNK), "node", "comp", "sketch"), percent)
    near = _written(near, "near", 8)
    ready = stage(ready.select("path", "node", "n", "comp").join(near, ["path", "node"], "left_semi"), "ready")
    total = ready.groupBy("path").agg(F.sum("n").alias("tokens_in"))
    ready = ready.join(_thinned(sets, "node", ready, "node"), "node").join(total, "path")
    pairs = _chunk_pairs(ready, F.ceil(F.col("tokens_in") / CHUNK_TOKENS), "node", "comp", "tokens")
    opened = _written(_opened(pairs, percent), "opened", 2)
    return opened, None if last else members.where(F.col("others") > MIDDLE).select("path", "node")


def near_copies(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document, and its text_key."""
    digests, roots = linked(docs, size, percent)
    rows = digests.select("doc_id", "text_key", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    classes = rows.where("n > 0").groupBy("node").agg(F.min(least).alias("least"))
    classes = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = classes.groupBy("root").agg(F.min("least").alias("least"))
    named = classes.select("node", "root").join(first, "root")
    named = named.select("node", F.col("least.doc_id").alias("component_id"))
    out = rows.join(named, "node", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "text_key",
    )
