"""Operator 8: language-model scores of whole documents.

Word counts come from all training documents. Tasks turn their documents into blocks:
the block's distinct words, their training counts, and each text as numbers of
these words. Words meet over all blocks in one window by word, which gives every
block the corpus count of each of its words; no table of all words is broadcast, collected
or held by one task.

The model is a gated recurrent network (`gru`) over a shortlist of the SHORTLIST most
frequent words. Its classes carry all other words as one tail class, within which a word
has (count + 1) / (tokens + words + 1) of the tail, from the counts of all training
documents; one share is kept for words never seen. The network's weights, the shortlist,
its counts and the tail come from all training documents: tasks train on their own blocks
and their weights are averaged, ROUNDS times; no text goes to the driver. The weights
depend on how the table is split into tasks. The state runs through a document from its
first word to its end mark, so a score is the log10 probability of the whole text.

Null and empty texts are an end mark alone. Null doc_ids are not trained on. Repeated
documents are scored each, and count each. Without training documents every count is 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.llm import gru
from lodestrata.llm.textscan import SPACED, bounded_batches, scan_column
from lodestrata.session import stage

SHORTLIST = 1_000
#: Averages of the tasks' weights; each document is trained on before one of them.
ROUNDS = 4
#: How often a round goes through its documents, whatever their number.
EPOCHS = 1
#: Streams of a block: one for so many of its words, within gru.STREAMS and this bound.
STREAM_TOKENS = 1_024
MOST_STREAMS = 256
#: Weights averaged by one task.
FAN = 16
#: Text of a block.
BLOCK_BYTES = 8 << 20
#: Key of the end mark; no word has it but by a chance of 2**-64.
END = np.uint64(0x0E0D0E0D0E0D0E0D)


def _texts_with_ends(column: pa.Array):
    """Word keys of consecutive texts, an end mark after each, and the texts' bounds."""
    for lo, hi, words in scan_column(column, SPACED):
        n = hi - lo
        first = words.first + np.arange(n + 1)
        key = np.full(len(words.key) + n, END)
        key[np.arange(len(words.key)) + words.owner()] = words.key
        yield key, first


def _numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, and the place of each key among them; only the distinct ones are sorted."""
    found = pa.array(key).dictionary_encode()
    distinct = found.dictionary.to_numpy(zero_copy_only=False)
    order = np.argsort(distinct)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return distinct[order], place.take(found.indices.to_numpy())


def _blocks(docs: DataFrame, training: Column) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        number, ids, used, keys, lengths, size = 0, [], [], [], [], 0
        for batch in batches:
            ids += batch.column(0).to_pylist()
            used += batch.column(1).to_pylist()
            for key, first in _texts_with_ends(batch.column(2)):
                keys.append(key)
                lengths.append(np.diff(first))
            size += batch.column(2).nbytes
            if size >= BLOCK_BYTES:
                yield one(number, ids, used, keys, lengths)
                number, ids, used, keys, lengths, size = number + 1, [], [], [], [], 0
        if ids:
            yield one(number, ids, used, keys, lengths)

    def one(number, ids, used, keys, lengths):
        key, length = np.concatenate(keys), np.concatenate(lengths)
        vocabulary, at = _numbered(key)
        mine = np.repeat(np.array(used, dtype=bool), length)
        counts = np.bincount(at[mine], minlength=len(vocabulary)).astype(np.uint32)
        block = (TaskContext.get().partitionId() << 32) | number
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()),
                pa.array([ids], schema_ids),
                pa.array([used], pa.list_(pa.bool_())),
                pa.array([length.tolist()], pa.list_(pa.int64())),
                pa.array([pa.compress(at.astype(np.uint32).tobytes(), "zstd", asbytes=True)], pa.binary()),
                pa.array([vocabulary.tobytes()], pa.binary()),
                pa.array([counts.tobytes()], pa.binary()),
                pa.array([int(counts.sum())], pa.int64()),
            ],
            ["block", "ids", "used", "length", "words", "vocabulary", "counts", "tokens"],
        )

    from pyspark.sql.pandas.types import to_arrow_type

    schema_ids = pa.list_(to_arrow_type(docs.schema["doc_id"].dataType))
    rows = docs.select("doc_id", F.coalesce(training, F.lit(False)).alias("used"), "text")
    return rows.mapInArrow(
        run,
        f"block long, ids array<{kind}>, used array<boolean>, length array<long>, words binary,"
        " vocabulary binary, counts binary, tokens long",
    )


def _unpacked(words: bytes, length) -> np.ndarray:
    """The words of a block as numbers of its vocabulary; the texts' lengths tell how many."""
    size = 4 * int(np.sum(np.asarray(length)))
    return np.frombuffer(pa.decompress(words, size, "zstd"), np.uint32)


def _counts(blocks: DataFrame, keep) -> DataFrame:
    """(word, n) summed over the blocks, for the words that `keep` picks in a block."""

    def run(batches):
        for batch in batches:
            for v, c in zip(batch.column(0), batch.column(1), strict=True):
                key = np.frombuffer(v.as_py(), np.uint64)
                count = np.frombuffer(c.as_py(), np.uint32)
                some = keep(key, count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[some].view(np.int64)), pa.array(count[some].astype(np.int64))],
                    ["word", "n"],
                )

    rows = blocks.select("vocabulary", "counts").mapInArrow(run, "word long, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _shortlist(blocks: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and corpus counts of the most frequent words, the most frequent first."""

    def frequent(key, count):
        # a word of the shortlist is at least this frequent in some block
        return count * np.uint64(50 * size) >= max(int(count.sum()), 1)

    found = _counts(blocks, frequent).orderBy(F.desc("n"), "word").limit(size).collect()
    wanted = np.sort(np.append(np.array([r.word for r in found], np.int64).view(np.uint64), END))

    def chosen(key, count):
        return np.isin(key, wanted)

    rows = _counts(blocks, chosen).where("n > 0").collect()
    rows = sorted(rows, key=lambda r: (-r.n, r.word))
    key = np.array([r.word for r in rows], np.int64).view(np.uint64)
    return key, np.array([r.n for r in rows], np.float64)


class Numbers:
    """Word keys to numbers of the shortlist; all others get its length."""

    def __init__(self, key: np.ndarray):
        self.order = np.argsort(key)
        self.key = key[self.order]

    def __call__(self, key: np.ndarray) -> np.ndarray:
        if not len(self.key):
            return np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.order[at], len(self.key))


def _mean(found: pa.Table) -> tuple[float, np.ndarray]:
    """Tokens of all rows, and the mean of their weights by tokens."""
    found = found.sort_by("part")
    total, whole = 0.0, 0.0
    for n, flat in zip(found.column("n"), found.column("flat"), strict=True):
        whole = whole + n.as_py() * np.frombuffer(flat.as_py(), np.float32).astype(float)
        total += n.as_py()
    return total, (whole / total).astype(np.float32)


def _averaged(found: DataFrame, parts: int) -> DataFrame:
    """At most FAN rows of the same mean, no task reading more than FAN."""

    def level(parts):
        def merge(rows: pa.Table) -> pa.Table:
            total, flat = _mean(rows)
            part = rows.column("part")[0].as_py() % parts
            return pa.table({"part": [part], "n": [total], "flat": [flat.tobytes()]})

        return merge

    while parts > FAN:
        parts = -(-parts // FAN)
        found = found.groupBy(F.col("part") % parts).applyInArrow(level(parts), found.schema)
    return found


def fit(blocks: DataFrame, key, counts, tokens: int) -> gru.Gru:
    """The network, fitted on all training documents of the blocks.

    In each of ROUNDS rounds every task takes its share of the documents of its own
    blocks, starting from the weights of the round before; the weights of all tasks are averaged by tokens.
    """
    context = blocks.sparkSession.sparkContext
    model, number = gru.create(counts, max(tokens - counts.sum(), 0)), Numbers(key)
    if not tokens:
        return model
    flat = gru.packed(model, gru.fresh(model))
    rows = blocks.select("words", "vocabulary", "used", "length")
    parts = rows.rdd.getNumPartitions()

    def learner(sent, turn):
        def run(batches):
            start, flat, number = sent.value
            model, memory = gru.unpacked(start, flat)
            seen = 0
            for batch in batches:
                for w, v, used, length in zip(*batch.columns, strict=True):
                    at = _unpacked(w.as_py(), length.values)
                    word = number(np.frombuffer(v.as_py(), np.uint64))
                    first = np.concatenate([[0], np.cumsum(length.values.to_numpy())])
                    own = np.flatnonzero(used.values.to_numpy(zero_copy_only=False))[turn::ROUNDS]
                    texts = [word.take(at[first[i] : first[i + 1]]) for i in own]
                    n = sum(map(len, texts))
                    at_once = min(max(n // STREAM_TOKENS, gru.STREAMS), MOST_STREAMS)
                    gru.train(model, texts, EPOCHS, memory=memory, at_once=at_once)
                    seen += n
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([TaskContext.get().partitionId()], pa.int64()),
                        pa.array([float(seen)]),
                        pa.array([gru.packed(model, memory).tobytes()], pa.binary()),
                    ],
                    ["part", "n", "flat"],
                )

        return run

    for turn in range(ROUNDS):
        sent = context.broadcast((model, flat, number))
        found = rows.mapInArrow(learner(sent, turn), "part long, n double, flat binary")
        found = _averaged(found, parts).toArrow()
        if found.num_rows:
            flat = _mean(found)[1]
        sent.unpersist()
    return gru.unpacked(model, flat)[0]


def score(docs: DataFrame, training: Column, shortlist: int = SHORTLIST) -> DataFrame:
    """doc_id, used (trained on), n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    bounded_batches(spark)
    blocks = stage(_blocks(docs, training), "blocks")
    tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
    key, counts = _shortlist(blocks, shortlist)
    sent = spark.sparkContext.broadcast((fit(blocks, key, counts, tokens), Numbers(key)))

    def listed(batches):
        for batch in batches:
            for block, v, c in zip(*batch.columns, strict=True):
                word = np.frombuffer(v.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(word),
                        pa.array(np.full(len(word), block.as_py())),
                        pa.array(np.arange(len(word), dtype=np.int32)),
                        pa.array(np.frombuffer(c.as_py(), np.uint32).astype(np.int64)),
                    ],
                    ["word", "block", "place", "n"],
                )

    rows = blocks.select("block", "vocabulary", "counts")
    rows = rows.mapInArrow(listed, "word long, block long, place int, n long")
    by_word = Window.partitionBy("word")
    counted = rows.select(
        "block",
        "place",
        F.sum("n").over(by_word).alias("c"),
        (F.min("block").over(by_word) == F.col("block")).alias("head"),
    )
    kind = docs.schema["doc_id"].dataType.simpleString()

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        model, number = sent.value
        outs = []
        place = right.column("place").to_numpy()
        c = np.zeros(len(place), np.int64)
        c[place] = right.column("c").to_numpy()
        heads = right.column("head").to_numpy()
        known_words = int((heads & (right.column("c").to_numpy() > 0)).sum())
        for row in left.to_pylist():
            length = np.array(row["length"], np.int64)
            at = _unpacked(row["words"], length)
            vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
            first = np.concatenate([[0], np.cumsum(length)])
            word = number(vocabulary)[at]
            found = model.score(word, first) / math.log(10)
            tail = word == len(number.key)
            del word
            log = np.log10(c + 1.0).take(at)
            base = np.add.reduceat(log, first[:-1])
            log[~tail] = 0
            found += np.add.reduceat(log, first[:-1])
            del log
            outs.append(
                pa.table(
                    {
                        "doc_id": pa.array(row["ids"], left.schema.field("ids").type.value_type),
                        "used": pa.array(row["used"], pa.bool_()),
                        "n_tokens": pa.array(length),
                        "n_known": pa.array(np.add.reduceat((c > 0)[at], first[:-1], dtype=np.int64)),
                        "n_tail": pa.array(np.add.reduceat(tail, first[:-1], dtype=np.int64)),
                        "base": pa.array(base),
                        "found": pa.array(found),
                        "new_words": pa.array([known_words] + [0] * (len(length) - 1), pa.int64()),
                    }
                )
            )
        return pa.concat_tables(outs)

    judged = (
        blocks.groupBy("block")
        .cogroup(counted.groupBy("block"))
        .applyInArrow(
            judge,
            f"doc_id {kind}, used boolean, n_tokens long, n_known long, n_tail long, base double,"
            " found double, new_words long",
        )
    )
    judged = stage(judged, "judged")
    words = judged.agg(F.sum("new_words")).first()[0] or 0
    whole = math.log10(tokens + words + 1)
    rest = math.log10(tokens - counts.sum() + words - len(counts) + 1)
    return judged.select(
        "doc_id",
        "used",
        "n_tokens",
        "n_known",
        F.lit(int(tokens)).alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("found") - F.col("n_tail") * rest).alias("score"),
    )
