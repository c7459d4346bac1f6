"""Operator 2: SentencePiece encoding and decoding by a batched Viterbi search.

The pieces come from a SentencePiece model file, which is read on the driver; its arrays
(their size is the vocabulary's) are sent to the tasks. Texts are cut where a
space follows another character, as no piece goes on there; the distinct parts
("words") of a block of texts are encoded once. Words of equal length advance together:
for every start and length the hash of the substring is probed among the sorted hashes of the
pieces and their beginnings, and for every end the best of all pieces that end there is
taken by one vectorised maximum, whose length is the backpointer. A character
that no piece covers costs more than any piece and becomes its UTF-8 bytes.

Scores: a unigram model's own. The pieces of a BPE model are scored by merge rank r,
which is no log-probability; for them log(1 / (r + 1)) takes its place. Such a model's own encoder
merges pairs instead, so its ids can differ; both decode to the same text.

Decoding gives back every text exactly, also spaces, line ends and the character
U+2581, which is written as bytes. Null texts give null; empty ones no pieces. Repeated texts
get equal pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodestrata.llm.textscan import bounded_batches, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_BYTES = 4 << 20
#: Characters of words of one length that are encoded at a time.
AT_ONCE = 1 << 17
_SPACE, _MARK = 32, 0x2581
_WORD = re.compile(r" +[^ ]*|[^ ]+")
_K = np.uint64(0x9E3779B97F4A7C15)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _longer(key: np.ndarray, point: np.ndarray) -> np.ndarray:
    return mix(key * _K + point.astype(np.uint64) + np.uint64(1))


@dataclass
class Pieces:
    """Sorted hashes of pieces and their beginnings; id of each (-1: a beginning only)."""

    key: np.ndarray
    id: np.ndarray
    score: np.ndarray
    unknown: float
    longest: int
    raw: list[bytes]
    byte_id: np.ndarray
    prefix: bool

    def probe(self, key: np.ndarray) -> np.ndarray:
        """Place among the hashes, or -1."""
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, at, -1)


def load(path: str = MODEL) -> Pieces:
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as model_format

    processor = SentencePieceProcessor(model_file=path)
    proto = model_format.ModelProto()
    proto.ParseFromString(processor.serialized_model_proto())
    if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("only models that leave the text as it is can be decoded exactly")
    names = [proto.pieces[i] for i in range(len(proto.pieces))]
    merges = proto.trainer_spec.model_type == 2
    scores, raw, byte_id = np.full(len(names), -np.inf), [], np.full(256, -1)
    table: dict[int, int] = {}
    longest, texts = 1, {}
    for i, piece in enumerate(names):
        if piece.type == 6:
            value = int(piece.piece[1:-1], 16)
            byte_id[value] = i
            raw.append(bytes([value]))
            continue
        plain = piece.piece.replace(chr(_MARK), " ")
        raw.append(plain.encode() if piece.type in (1, 4) else b"")
        if piece.type not in (1, 4):
            continue
        if re.search(r"[^ ] ", plain):
            raise ValueError(f"piece {piece.piece!r} goes on beyond a space")
        scores[i] = -np.log1p(max(-piece.score, 0)) if merges else piece.score
        texts[plain] = i
        longest = max(longest, len(plain))
    for plain, i in texts.items():
        key = np.zeros(1, np.uint64)
        for n, point in enumerate(_points(plain)):
            key = _longer(key, np.array([point]))
            own = int(key[0])
            table[own] = i if n == len(plain) - 1 else table.get(own, -1)
    keys = np.array(sorted(table), np.uint64)
    ids = np.array([table[int(k)] for k in keys], np.int64)
    worst = float(scores[np.isfinite(scores)].min())
    return Pieces(
        keys, ids, scores, worst - 10, longest, raw, byte_id, proto.normalizer_spec.add_dummy_prefix
    )


def _search(points: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Viterbi over words of one length (rows of code points): lengths and ids by end."""
    n, size = points.shape
    reach = min(pieces.longest, size)
    # gain[e, l - 1]: score of the piece of length l that ends before e, by word
    gain = np.full((size + 1, reach, n), -np.inf)
    which = np.full((size + 1, reach, n), -1, np.int32)
    gain[1:, 0] = pieces.unknown
    row, start = np.repeat(np.arange(n), size), np.tile(np.arange(size), n)
    key = np.zeros(n * size, np.uint64)
    for length in range(1, reach + 1):
        inside = start + length <= size
        row, start, key = row[inside], start[inside], key[inside]
        if not len(row):
            break
        key = _longer(key, points[row, start + length - 1])
        at = pieces.probe(key)
        live = at >= 0
        row, start, key, at = row[live], start[live], key[live], at[live]
        own = pieces.id[at]
        whole = own >= 0
        gain[start[whole] + length, length - 1, row[whole]] = pieces.score[own[whole]]
        which[start[whole] + length, length - 1, row[whole]] = own[whole]
    best = np.full((size + 1, n), -np.inf)
    best[0] = 0
    length_of = np.zeros((size + 1, n), np.int64)
    id_of = np.full((size + 1, n), -1, np.int64)
    words = np.arange(n)
    for end in range(1, size + 1):
        span = min(reach, end)
        total = best[end - span : end][::-1] + gain[end, :span]
        top = total.argmax(axis=0)
        best[end] = total[top, words]
        length_of[end] = top + 1
        id_of[end] = which[end, top, words]
    return length_of, id_of


def _walk(points, length_of, id_of) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words one after the other, and their number a word.

    All words go back one piece a step. A character without a piece gives minus its
    code point, less one.
    """
    size, n = len(length_of) - 1, length_of.shape[1]
    end, words = np.full(n, size), np.arange(n)
    steps, count = [], np.zeros(n, np.int64)
    while len(words):
        at = end[words]
        own = id_of[at, words]
        bare = own < 0
        own[bare] = -1 - points[words[bare], at[bare] - 1].astype(np.int64)
        steps.append((words, own))
        count[words] += 1
        end[words] = at - length_of[at, words]
        words = words[end[words] > 0]
    last = np.cumsum(count) - 1
    out = np.empty(count.sum(), np.int64)
    for back, (own, ids) in enumerate(steps):
        out[last[own] - back] = ids
    return out, count


def encode_words(words: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words one after the other, and the words' bounds."""
    if not words:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    lengths = np.array([len(w) for w in words], np.int64)
    order = np.argsort(lengths, kind="stable")
    points = _points("".join([words[i] for i in order]))
    begin = np.concatenate([[0], np.cumsum(lengths[order])])
    ids, count = [np.zeros(0, np.int64)], np.zeros(len(words), np.int64)
    sizes, heads = np.unique(lengths[order], return_index=True)
    for size, head, tail in zip(sizes, heads, [*heads[1:], len(words)], strict=True):
        step = max(1, AT_ONCE // int(size))
        for lo in range(int(head), int(tail), step):
            hi = min(lo + step, int(tail))
            block = points[begin[lo] : begin[hi]].reshape(hi - lo, size)
            found, per = _walk(block, *_search(block, pieces))
            ids.append(found)
            count[order[lo:hi]] = per
    flat, per = np.concatenate(ids), count[order]
    # back to the words' own order
    old = np.cumsum(per) - per
    place = np.empty(len(words), np.int64)
    place[order] = old
    done = np.concatenate([[0], np.cumsum(count)])
    flat = flat[np.repeat(place - done[:-1], count) + np.arange(done[-1])]
    bare = np.flatnonzero(flat < 0)
    if len(bare):
        raw = [pieces.byte_id[list(chr(-1 - p).encode())] for p in flat[bare].tolist()]
        size = np.ones(len(flat), np.int64)
        size[bare] = [len(r) for r in raw]
        wide = np.repeat(flat, size)
        first = np.cumsum(size) - size
        spots = np.concatenate([f + np.arange(len(r)) for f, r in zip(first[bare], raw, strict=True)])
        wide[spots] = np.concatenate(raw)
        done = np.concatenate([first, [len(wide)]])[done]
        flat = wide
    return flat.astype(np.int32), done


def encode(texts: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and the texts' bounds."""
    number: dict[str, int] = {}
    rows, count = [], []
    for text in texts:
        whole = " " + text if pieces.prefix and text else text
        own = _WORD.findall(whole)
        for w in own:
            if w not in number:
                number[w] = len(number)
        rows.append(np.array([number[w] for w in own], np.int64))
        count.append(len(own))
    flat, own_bounds = encode_words(list(number), pieces)
    begin, size = own_bounds[:-1], np.diff(own_bounds)
    word = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    per = size[word]
    done = np.concatenate([[0], np.cumsum(per)])
    at = np.repeat(begin[word] - done[:-1], per) + np.arange(done[-1])
    return flat[at], done[np.concatenate([[0], np.cumsum(count)]).astype(np.int64)]


def decode(ids: np.ndarray, bounds: np.ndarray, pieces: Pieces) -> list[str]:
    size = np.array([len(r) for r in pieces.raw], np.int64)
    begin = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(pieces.raw), np.uint8)
    done = np.concatenate([[0], np.cumsum(size[ids])])
    at = np.repeat(begin[ids] - done[:-1], size[ids]) + np.arange(done[-1])
    raw = flat[at].tobytes()
    out = []
    for a, b in zip(done[bounds[:-1]].tolist(), done[bounds[1:]].tolist(), strict=True):
        skip = 1 if pieces.prefix and raw[a : a + 1] == b" " else 0
        out.append(raw[a + skip : b].decode())
    return out


def _gathered(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(place).nbytes
        if size >= BLOCK_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    rows = pa.Table.from_batches(held).combine_chunks().to_batches() if held else []
    yield from rows


def add_pieces(docs: DataFrame, pieces: Pieces, ids_name: str = "piece_ids") -> DataFrame:
    """The documents with their piece ids, their number, and whether decoding gives the text.

    A name that the documents already have gets an underscore more.
    """
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(pieces)
    place = docs.columns.index("text")
    names = [ids_name, "n_pieces", "round_trip"]
    for i in range(len(names)):
        while names[i] in docs.columns:
            names[i] += "_"

    def run(batches):
        for batch in _gathered(batches, place):
            given = batch.column(place).to_pylist()
            texts = [t or "" for t in given]
            ids, bounds = encode(texts, sent.value)
            back = decode(ids, bounds, sent.value)
            null = np.array([t is None for t in given], dtype=bool)
            offsets = pa.array(bounds.astype(np.int32), mask=np.append(null, False))
            same = [a == b for a, b in zip(texts, back, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                    pa.array(np.diff(bounds), pa.int64(), mask=null),
                    pa.array(same, pa.bool_(), mask=null),
                ],
                [*batch.schema.names, *names],
            )

    schema = T.StructType(list(docs.schema.fields))
    kinds = (T.ArrayType(T.IntegerType()), T.LongType(), T.BooleanType())
    for name, kind in zip(names, kinds, strict=True):
        schema = schema.add(name, kind)
    return docs.mapInArrow(run, schema)
