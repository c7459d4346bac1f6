"""Operator 4: n-gram Jaccard join over a token-group matrix.

A document's set holds its distinct shingles (runs of `size` words; a shorter text is
one shingle). Documents with equal sets form a class, and classes are compared:

1. A fixed number of counters over all sets tells frequent shingles. It fixes one
   order of all shingles, rare ones first. Two sets that are similar enough share at
   least L of the first |A| - ceil(t|A|) + L shingles of this order, for any L up to the
   overlap; L grows with the set (`_share`). Only these shingles are shuffled, and
   only those that two classes hold go on.
2. Classes are partitioned into groups by the shingle they share with most others,
   each of about GROUP_TOKENS shingles. In a large partition every class is first
   compared with one hub, the class with most copies; groups never mix classes that are
   linked to the hub with others.
3. The token-group matrix holds (shingle, group) for the union of each group's
   shingles. Groups that share fewer than L of them cannot hold similar sets and are not
   opened against each other, nor are groups whose members are linked to one hub.
4. Opening two groups: members' overlaps with the other group's whole union bound what
   they can reach; those that qualify are compared exactly, through the product of
   membership matrices. A group's links among what is already connected are not
   repeated: links that join components stay.

Links and equal sets are joined to components, see `components`.

Texts without words, and null, have an empty set and no links; repeated documents are
copies. Component ids are the least doc_id; a component of null ids only has none.
Shingles are 64-bit keys. An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.components import components
from lodestrata.llm.textscan import (
    SPACED,
    bounded_batches,
    mix,
    scan_column,
    window_keys,
)
from lodestrata.session import stage

SIZE = 4
PERCENT = 85
COUNTERS = 1 << 22
_PARTS = 64
#: Shingles of a group, besides single sets that are larger.
GROUP_TOKENS = 50_000
#: Classes of a partition above which they are compared with a hub first.
HUB_FROM = 64
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _needed(n, percent):
    """Least overlap of a set of n with a set that is similar enough."""
    return -(-n * percent // 100)


def _share(n):
    """L: shingles that the beginnings of similar sets have in common."""
    return 1 + n // 20


def _sets(column: pa.Array, size: int):
    """(text, sorted distinct shingle keys) of the texts that have words, in order."""
    for lo, _hi, words in scan_column(column, SPACED):
        key, at = window_keys(words.key, words.first, size)
        text = np.searchsorted(words.first, at, side="right") - 1
        order = np.lexsort((key, text))
        key, text = key[order], text[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
        yield lo, key[new], text[new], len(words.first) - 1


def frequency_levels(docs: DataFrame, size: int) -> np.ndarray:
    """For each counter how far, in powers of two, it is above twice the mean."""

    def count(batches):
        total = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for _lo, key, _text, _n in _sets(batch.column(0), size):
                slot = (key >> np.uint64(42)).astype(np.int64)
                total += np.bincount(slot, minlength=COUNTERS).astype(np.uint32)
        yield packed(total.reshape(_PARTS, -1), np.arange(_PARTS))

    def packed(rows, parts):
        blobs = [zlib.compress(r.astype(np.uint64).tobytes(), 1) for r in rows]
        salt = TaskContext.get().partitionId() % 32
        return pa.RecordBatch.from_arrays(
            [pa.array(parts), pa.array([salt] * len(rows)), pa.array(blobs, pa.binary())],
            ["part", "salt", "counts"],
        )

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0), batch.column(2), strict=True):
                own = np.frombuffer(zlib.decompress(blob.as_py()), np.uint64)
                k = part.as_py()
                held[k] = held[k] + own if k in held else own
        if held:
            yield packed(list(held.values()), list(held))

    schema = "part long, salt long, counts binary"
    partial = docs.select("text").mapInArrow(count, schema)
    summed = partial.repartition("part", "salt").mapInArrow(add, schema)
    whole = summed.repartition("part").mapInArrow(add, schema).collect()
    total = np.zeros((_PARTS, COUNTERS // _PARTS))
    for row in whole:
        total[row.part] += np.frombuffer(zlib.decompress(row.counts), np.uint64)
    total = total.ravel()
    mean = max(total.mean(), 1.0)
    return np.clip(np.ceil(np.log2(np.maximum(total, 1) / (2 * mean))), 0, 60).astype(np.uint8)


def _digest(docs: DataFrame, size: int, percent: int, levels) -> DataFrame:
    """Per document: class (node), set size, and the beginning of the set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = batch.num_rows
            count, node = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            begins: list = [None] * rows
            for lo, key, text, n in _sets(batch.column(2), size):
                first = np.searchsorted(text, np.arange(n + 1))
                own = np.diff(first)
                count[lo : lo + n] = own
                some = np.flatnonzero(own)
                if not len(some):
                    continue
                hashed = np.add.reduceat(mix(key), first[some])
                node[lo + some] = mix(hashed + own[some].astype(np.uint64)).view(np.int64)
                level = levels.value[(key >> np.uint64(42)).astype(np.int64)]
                order = np.lexsort((key, level, text))
                key = key[order]
                length = own - _needed(own, percent) + _share(own)
                for i in some:
                    begins[lo + i] = key[first[i] : first[i] + min(length[i], own[i])].tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(count),
                    pa.array(node),
                    pa.array(begins, pa.binary()),
                ],
                ["doc_id", "text_key", "n", "node", "begin"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, n long, node long, begin binary")


def _shared(classes: DataFrame, levels) -> DataFrame:
    """(token, node, level) of the beginnings' shingles that two classes hold."""

    def explode(batches):
        for batch in batches:
            tokens = [np.frombuffer(b.as_py(), np.uint64) for b in batch.column(1)]
            node = batch.column(0).to_numpy()
            token = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
            level = levels.value[(token >> np.uint64(42)).astype(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(token.view(np.int64)),
                    pa.array(np.repeat(node, [len(t) for t in tokens])),
                    pa.array(level.astype(np.int8)),
                ],
                ["token", "node", "level"],
            )

    def repeated(batches):
        # a token of level 0 has at most twice the mean count, so a partition stays bounded
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not held:
            return
        token, node = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(token, kind="stable")
        token, node = token[order], node[order]
        same = token[1:] == token[:-1]
        keep = np.zeros(len(token), dtype=bool)
        keep[1:] |= same
        keep[:-1] |= same
        yield pa.RecordBatch.from_arrays(
            [pa.array(token[keep]), pa.array(node[keep]), pa.array(np.zeros(keep.sum(), np.int8))],
            ["token", "node", "level"],
        )

    schema = "token long, node long, level byte"
    rows = classes.select("node", "begin").mapInArrow(explode, schema)
    rare = rows.where("level = 0").select("token", "node").repartition("token")
    return rare.mapInArrow(repeated, schema).unionAll(rows.where("level > 0"))


def _enough(shared: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Rows of classes that share as many shingles with others as one partner would need.

    The smallest partner of a set of n has `_needed(n)` shingles. Classes that fall out
    may leave others alone with their shingles, so a second round finds more.
    """
    held = shared.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    left = shared.join(held.select("token"), "token", "left_semi")
    least = F.floor((F.floor((F.col("n") * percent + 99) / 100)) / 20) + 1
    enough = left.groupBy("node").agg(F.count(F.lit(1)).alias("tokens"))
    enough = enough.join(classes.select("node", "n"), "node").where(F.col("tokens") >= least)
    return left.join(enough.select("node"), "node", "left_semi")


def _with_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The sets (binary) of the wanted classes, from one text of each."""

    def run(batches):
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            blobs, kept = [], []
            for lo, key, text, n in _sets(batch.column(1), size):
                first = np.searchsorted(text, np.arange(n + 1))
                for i in range(n):
                    own = key[first[i] : first[i + 1]]
                    if not len(own):
                        continue
                    total = np.add.reduce(mix(own)) + np.uint64(len(own))
                    if mix(np.array([total]))[0].view(np.int64) == nodes[lo + i]:
                        blobs.append(own.tobytes())
                        kept.append(lo + i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[kept]), pa.array(blobs, pa.binary())], ["node", "tokens"]
            )

    wanted = wanted.select("node", F.col("least.doc_id").alias("_id"), F.col("least.text_key").alias("_key"))
    texts = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_text_key"), "text")
    found = texts.join(
        wanted, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    )
    sets = found.select("node", "text").mapInArrow(run, "node long, tokens binary")
    return sets.dropDuplicates(["node"])


def _similar(overlap, a, b, percent):
    return 100 * overlap >= percent * (a + b - overlap)


def _hub_links(members: DataFrame, percent: int) -> DataFrame:
    """(node, hub) of the members of large partitions that are similar to their hub."""

    def run(batches):
        for batch in batches:
            node, hub = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            linked = []
            for own, other in zip(batch.column(2), batch.column(3), strict=True):
                a = np.frombuffer(own.as_py(), np.uint64)
                b = np.frombuffer(other.as_py(), np.uint64)
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                linked.append(_similar(int((b[at] == a).sum()), len(a), len(b), percent))
            linked = np.array(linked, dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[linked]), pa.array(hub[linked])], ["node", "hub"]
            )

    best = F.max(F.struct("copies", "node")).alias("best")
    hubs = members.groupBy("home").agg(F.count(F.lit(1)).alias("m"), best)
    hubs = hubs.where(F.col("m") > HUB_FROM).select("home", F.col("best.node").alias("hub"))
    sets = members.select(F.col("node").alias("hub"), F.col("tokens").alias("hub_tokens"))
    hubs = hubs.join(sets, "hub")
    rows = members.join(hubs, "home").select("node", "hub", "tokens", "hub_tokens")
    return rows.mapInArrow(run, "node long, hub long")


def _open(a: list, b: list, same: bool, percent: int) -> list[tuple[int, int]]:
    """Links between two groups of (node, tokens), as few as keep their components."""
    left = [np.frombuffer(t, np.uint64) for _, t in a]
    right = left if same else [np.frombuffer(t, np.uint64) for _, t in b]
    sizes_l = np.array([len(t) for t in left])
    sizes_r = np.array([len(t) for t in right])
    token_l, token_r = np.concatenate(left), np.concatenate(right)
    owner_l, owner_r = np.repeat(np.arange(len(left)), sizes_l), np.repeat(np.arange(len(right)), sizes_r)
    union_l, count_l = np.unique(token_l, return_counts=True)
    if same:
        union = union_l[count_l > 1]
    else:
        union = np.intersect1d(union_l, np.unique(token_r), assume_unique=True)
    if not len(union):
        return []

    def inside(token, owner, sizes):
        at = np.minimum(np.searchsorted(union, token), len(union) - 1)
        hit = union[at] == token
        at, owner = at[hit], owner[hit]
        # overlap with the other group's union bounds the overlap with any member
        reach = np.bincount(owner, minlength=len(sizes)) >= _needed(sizes, percent)
        return at[reach[owner]], owner[reach[owner]], np.flatnonzero(reach)

    at_l, own_l, rows_l = inside(token_l, owner_l, sizes_l)
    at_r, own_r, rows_r = inside(token_r, owner_r, sizes_r)
    if not len(rows_l) or not len(rows_r):
        return []
    place_l, place_r = np.searchsorted(rows_l, own_l), np.searchsorted(rows_r, own_r)
    overlap = np.zeros((len(rows_l), len(rows_r)), np.float32)
    order_l, order_r = np.argsort(at_l), np.argsort(at_r)
    at_l, place_l, at_r, place_r = at_l[order_l], place_l[order_l], at_r[order_r], place_r[order_r]
    for lo in range(0, len(union), 4096):
        i = slice(*np.searchsorted(at_l, (lo, lo + 4096)))
        j = slice(*np.searchsorted(at_r, (lo, lo + 4096)))
        if i.start == i.stop or j.start == j.stop:
            continue
        columns = np.intersect1d(at_l[i], at_r[j])
        m_l = np.zeros((len(rows_l), 4096), np.float32)
        m_r = np.zeros((len(rows_r), 4096), np.float32)
        m_l[place_l[i], at_l[i] - lo] = 1
        m_r[place_r[j], at_r[j] - lo] = 1
        overlap += m_l[:, columns - lo] @ m_r[:, columns - lo].T
    links = _similar(overlap, sizes_l[rows_l][:, None], sizes_r[rows_r][None, :], percent)
    if same:
        links = np.triu(links, 1)
    root = list(range(len(a) + len(b)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out, shift = [], 0 if same else len(a)
    for i, j in zip(*np.nonzero(links), strict=True):
        i, j = int(rows_l[i]), int(rows_r[j])
        x, y = find(i), find(j + shift)
        if x != y:
            root[x] = y
            out.append((a[i][0], b[j][0]))
    return out


def _group_links(groups: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                a = [(m["node"], m["tokens"]) for m in row["one"]]
                b = a if row["other"] is None else [(m["node"], m["tokens"]) for m in row["other"]]
                out += _open(a, b, row["other"] is None, percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())],
                ["a", "b"],
            )

    none = F.lit(None).cast(groups.schema["members"].dataType)
    own = groups.where((F.size("members") > 1) & F.col("label").isNull())
    own = own.select(F.col("members").alias("one"), none.alias("other"))
    first = groups.select(F.col("group").alias("g"), F.col("members").alias("one"))
    second = groups.select(F.col("group").alias("h"), F.col("members").alias("other"))
    across = pairs.join(first, "g").join(second, "h").select("one", "other")
    return own.unionAll(across).mapInArrow(run, "a long, b long")


def _written(df: DataFrame, name: str, rows: int) -> DataFrame:
    """Stage with Arrow batches of `rows` rows, for rows that hold whole groups."""
    conf = df.sparkSession.conf
    before = conf.get(_BATCH)
    conf.set(_BATCH, str(rows))
    try:
        return stage(df.select("*"), name)
    finally:
        conf.set(_BATCH, before)


def links(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(documents with their class, links between classes that keep all components)."""
    spark: SparkSession = docs.sparkSession
    bounded_batches(spark)
    levels = spark.sparkContext.broadcast(frequency_levels(docs, size))
    digests = stage(_digest(docs, size, percent, levels), "digests")
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    filled = digests.where("n > 0")
    classes = filled.groupBy("node").agg(
        F.min(least).alias("least"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n")
    )
    classes = stage(classes, "classes")
    begins = filled.groupBy("node").agg(F.first("begin").alias("begin"))
    shared = stage(_shared(begins, levels), "shared")
    for _ in range(2):
        shared = stage(_enough(shared, classes, percent), "shared")
    held = shared.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    home = F.max(F.struct("m", "token"))
    wanted = shared.join(held, "token").groupBy("node").agg(home.alias("top"))
    wanted = wanted.select("node", F.col("top.token").alias("home"))
    wanted = wanted.join(classes, "node")
    members = stage(
        wanted.join(_with_sets(docs, wanted, size), "node").select(
            "node", "home", "copies", "n", "tokens"
        ),
        "members",
    )
    hub_links = stage(_hub_links(members, percent), "hub_links")
    labelled = members.join(hub_links.withColumnRenamed("hub", "label"), "node", "left")
    weight = labelled.groupBy("home", "label").agg(F.sum("n").alias("tokens_in"))
    weight = weight.withColumnRenamed("label", "_label").withColumnRenamed("home", "_home")
    same = (F.col("home") == F.col("_home")) & F.col("label").eqNullSafe(F.col("_label"))
    chunk = F.pmod(F.xxhash64("node"), F.ceil(F.col("tokens_in") / GROUP_TOKENS))
    grouped = labelled.join(weight, same).withColumn("group", F.xxhash64("home", "label", chunk))
    grouped = grouped.select("node", "n", "label", "group", "tokens")
    groups = _written(
        grouped.groupBy("group").agg(
            F.first("label").alias("label"),
            F.min("n").alias("n_min"),
            F.max("n").alias("n_max"),
            F.collect_list(F.struct("node", "tokens")).alias("members"),
        ),
        "groups",
        64,
    )
    of_node = groups.select("group", F.explode("members.node").alias("node"))
    matrix = shared.join(of_node, "node").select("token", "group").distinct()
    facts = groups.select("group", "label", "n_min", "n_max")
    matrix = stage(matrix.join(facts, "group"), "matrix")
    one = matrix.select(*[F.col(c).alias(f"{c}_1") for c in matrix.columns])
    two = matrix.select(*[F.col(c).alias(f"{c}_2") for c in matrix.columns])
    apart = F.col("label_1").isNull() | F.col("label_2").isNull() | (F.col("label_1") != F.col("label_2"))
    sizes = (F.col("n_min_1") * percent <= F.col("n_max_2") * 100) & (
        F.col("n_min_2") * percent <= F.col("n_max_1") * 100
    )
    met = one.join(two, (F.col("token_1") == F.col("token_2")) & (F.col("group_1") < F.col("group_2")) & apart & sizes)
    least_n = F.least(F.min("n_min_1"), F.min("n_min_2"))
    pairs = (
        met.groupBy(F.col("group_1").alias("g"), F.col("group_2").alias("h"))
        .agg(F.count(F.lit(1)).alias("common"), least_n.alias("n_min"))
        .where(F.col("common") >= 1 + F.floor(F.col("n_min") / 20))
        .select("g", "h")
    )
    opened = _written(_group_links(groups, pairs, percent), "opened", 8)
    every = opened.unionAll(hub_links.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    return digests, every


def join_components(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document, and its text_key and survivor."""
    digests, every = links(docs, size, percent)
    roots = components(every)
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    rows = digests.drop("begin")
    classes = rows.where("n > 0").groupBy("node").agg(F.min(least).alias("least"))
    classes = classes.join(roots, "node", "left")
    classes = classes.withColumn("root", F.coalesce("root", "node"))
    firsts = classes.groupBy("root").agg(F.min("least").alias("survivor"))
    named = classes.join(firsts, "root").select("node", "survivor")
    empty = F.col("n") == 0
    own = F.when(empty, F.lit(None)).otherwise(F.col("node"))
    return (
        rows.withColumn("_node", own)
        .drop("node")
        .join(named.withColumnRenamed("node", "_node"), "_node", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(empty, F.col("doc_id")).otherwise(F.col("survivor.doc_id")).alias("component_id"),
            "text_key",
            "survivor",
        )
    )


def keep_one(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, and all without words; all columns as they are.

    The one with the least doc_id stays; of repeated rows one stays.
    """
    found = join_components(docs, size, percent).where("n_shingles > 0")
    stay = found.select(
        F.col("survivor.doc_id").alias("_id"), F.col("survivor.text_key").alias("_key")
    ).distinct()
    # whole rows in one column, so that no column of the documents can clash
    marked = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("_doc"),
        F.xxhash64("text").alias("_text_key"),
        F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("_words"),
    )
    one = marked.where("_words").join(
        stay,
        F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")),
        "left_semi",
    )
    one = one.dropDuplicates(["_doc", "_text_key"])
    return one.select("row.*").unionAll(marked.where("NOT _words").select("row.*"))
