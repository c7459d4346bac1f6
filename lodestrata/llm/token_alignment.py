"""Operator 13: two tokenizers aligned over a corpus, each distinct text once.

Rows are shuffled by their full text, so every distinct text is tokenised and aligned
once, with the number of its copies. Byte offsets at which a token of A and one of B both
end cut their tokens into groups; the two tokens that end there are a link. How often an
id pair is linked, counted over all copies, is summed within tasks first. To judge the links of
a text, texts are held in blocks of about BLOCK_LINKS links: a block asks once for each of its
pairs, so a frequent pair is one row a block, and the answers meet the block's texts.
The measures of a text join its documents by SHA-256.

Within a task texts are cut at single spaces between other characters. There neither
tokenizer joins what stands on both sides (A begins a new word with the space; `load`
refuses a B that has a piece with a space after another character), so parts line up by
themselves, and a task tokenises a part once and keeps the last MEMO_PARTS or so.
What a task holds grows with the longest part without such a space.

A's text is a space and the text, B adds the space itself. Texts that are null or empty, or
that the tokens' bytes do not give back (such as those with U+2581, B's sign for
a space), have no tokens: zeros and empty groups. Strings of special tokens are plain text.
Repeated rows are copies, also with null ids. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.textscan import bounded_batches
from lodestrata.session import stage

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of texts whose new parts are tokenised together.
AT_ONCE = 4 << 20
#: Parts, and their characters, that a task keeps aligned; beyond, it starts over.
MEMO_PARTS, MEMO_CHARS = 300_000, 8 << 20
#: Links of a block, besides single texts that have more.
BLOCK_LINKS = 1 << 20
#: Characters up to which a part goes the quicker of two equal ways.
SHORT = 256
#: Fixed value: the words that a byte-level BPE of this kind is made on.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class Pair:
    """Contents of the two tokenizer files, as tasks get them."""

    a: bytes
    b: bytes

    def opened(self) -> Aligner:
        return Aligner(self)


def load(a: str = A_FILE, b: str = B_FILE) -> Pair:
    """Read a byte-level BPE (JSON) and a SentencePiece model on the driver."""
    with open(a, "rb") as one, open(b, "rb") as other:
        pair = Pair(one.read(), other.read())
    kind = (json.loads(pair.a).get("pre_tokenizer") or {}).get("type")
    if kind != "ByteLevel":
        raise ValueError("A has to be a byte-level BPE")
    if any(re.search("[^ ] ", p.decode(errors="ignore")) for p in pair.opened().bytes_b):
        raise ValueError("B has a piece that goes on beyond a space")
    return pair


def _byte_of_sign() -> dict[str, int]:
    """Bytes by their sign in a byte-level vocabulary: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the alignment of parts of texts."""

    def __init__(self, pair: Pair) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(pair.a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=pair.b)
        signs = _byte_of_sign()
        content = json.loads(pair.a)
        special = {t["id"] for t in content.get("added_tokens", ())}
        vocabulary = content["model"]["vocab"]
        self.size_a = max([*vocabulary.values(), *special]) + 1
        self.size_b = self.b.get_piece_size()
        self.bytes_a = [b""] * self.size_a
        for token, i in vocabulary.items():
            if i not in special:
                self.bytes_a[i] = bytes(signs[c] for c in token)
        self.bytes_b = [b""] * self.size_b
        for i in range(self.size_b):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.bytes_b[i] = bytes([int(piece[3:5], 16)])
            elif not (self.b.is_control(i) or self.b.is_unknown(i)):
                self.bytes_b[i] = piece.replace("▁", " ").encode()
        self.length_a = np.array([len(x) for x in self.bytes_a])
        self.length_b = np.array([len(x) for x in self.bytes_b])
        self.sign_a = np.array([[f"{i}{end}" for i in range(self.size_a)] for end in ",|"], object)
        self.sign_b = np.array([[f"{i}{end}" for i in range(self.size_b)] for end in ",;"], object)
        self.quick = None
        merges = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        ids = [vocabulary["".join(m)] for m in merges]
        if ids == list(range(256, 256 + len(ids))):
            # merges in the order of ids: the ids are ranks, and the same tokens come out
            from tiktoken import Encoding

            ranks = {raw: i for i, raw in enumerate(self.bytes_a) if raw}
            self.quick = Encoding("a", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})

    def code_type(self) -> type:
        return np.int32 if self.size_a * self.size_b < 2**31 else np.int64

    def ids_a(self, text: str) -> list[int]:
        """A's tokens of a space and the text."""
        if self.quick is None or len(text) > SHORT:
            return self.a.encode(" " + text, add_special_tokens=False).ids
        return self.quick.encode_ordinary(" " + text)

    def parts(self, texts: list[str]) -> Parts:
        """Tokens, groups and links of every part, and whether the bytes are the part's."""
        ids_a, ids_b = list(map(self.ids_a, texts)), self.b.encode(texts, num_threads=1)
        raw = [b" " + t.encode() for t in texts]
        whole = np.array([r == b"".join(map(self.bytes_a.__getitem__, x)) for r, x in zip(raw, ids_a, strict=True)], bool)
        whole &= np.array([r == b"".join(map(self.bytes_b.__getitem__, x)) for r, x in zip(raw, ids_b, strict=True)], bool)
        for i in np.flatnonzero(~whole):
            ids_a[i] = ids_b[i] = []
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(texts)) for ids in (ids_a, ids_b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (ids_a, ids_b))
        # the whole parts laid end to end, so that one place is one end of a token at most
        end_a, end_b = np.cumsum(self.length_a[flat_a]), np.cumsum(self.length_b[flat_b])
        at_b = np.searchsorted(end_b, end_a)
        met = end_b[np.minimum(at_b, max(len(end_b) - 1, 0))] == end_a if len(end_a) else np.zeros(0, bool)
        at_a, at_b = np.flatnonzero(met), at_b[met]
        common = end_a[at_a]
        links = (flat_a[at_a] * self.size_b + flat_b[at_b]).astype(self.code_type())
        n_links = np.bincount(np.repeat(np.arange(len(texts)), n_a)[at_a], minlength=len(texts))

        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        last_a, last_b = np.zeros(len(flat_a), np.int64), np.zeros(len(flat_b), np.int64)
        last_a[at_a], last_b[at_b] = 1, 1
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        signs = np.concatenate([self.sign_a[last_a, flat_a], self.sign_b[last_b, flat_b]])[order].tolist()
        bound = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        groups = ["".join(signs[lo:hi])[:-1] for lo, hi in zip(bound, bound[1:], strict=False)]
        return Parts(whole, n_a, n_b, n_links, links, groups)


@dataclass
class Parts:
    whole: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_links: np.ndarray
    links: np.ndarray
    groups: list[str]

    def joined(self, more: Parts) -> Parts:
        both = zip(self.arrays(), more.arrays(), strict=True)
        return Parts(*[np.concatenate(x) for x in both], self.groups + more.groups)

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.whole, self.n_a, self.n_b, self.n_links, self.links


class Memo:
    """Alignments of the parts that a task has met."""

    def __init__(self, aligner: Aligner) -> None:
        self.aligner = aligner
        self._empty()

    def _empty(self) -> None:
        self.number: dict[str, int] = {}
        self.parts, self.chars = self.aligner.parts([]), 0

    def align(self, texts: list[str]):
        """(n_a, n_b, groups, links) of every text."""
        if len(self.number) > MEMO_PARTS or self.chars > MEMO_CHARS:
            self._empty()
        number, known = self.number, len(self.number)
        cut = [[number.setdefault(p, len(number)) for p in _CUT.split(t)] for t in texts]
        fresh = list(islice(number, known, None))
        self.chars += sum(map(len, fresh))
        if fresh:
            self.parts = self.parts.joined(self.aligner.parts(fresh))
        parts = self.parts
        start = np.cumsum(parts.n_links) - parts.n_links
        for own in cut:
            at = np.array(own)
            if not parts.whole[at].all():
                yield 0, 0, "", parts.links[:0]
                continue
            n = parts.n_links[at]
            last = np.cumsum(n)
            links = parts.links[np.arange(last[-1]) + np.repeat(start[at] - last + n, n)]
            groups = ";".join(map(parts.groups.__getitem__, own))
            yield int(parts.n_a[at].sum()), int(parts.n_b[at].sum()), groups, links


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(text, copies) of the texts that are neither null nor empty."""
    return docs.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))


def align(texts: DataFrame, pair: Pair) -> DataFrame:
    """Per distinct text: text_key, copies, block, n_a, n_b, n_groups, groups, links.

    `groups` is `a1,a2|b1;a3|b2,b3`: ids of A and of B, group by group. `links` holds
    id of A * size of B + id of B, in 32 bits if the vocabularies allow it.
    """
    sent = texts.sparkSession.sparkContext.broadcast(pair)

    def run(batches):
        memo, block, filled = Memo(sent.value.opened()), TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            column = batch.column(0).to_pylist()
            copies, lo = batch.column(1).to_pylist(), 0
            while lo < len(column):
                hi, size = lo, 0
                while hi < len(column) and (hi == lo or size + len(column[hi]) <= AT_ONCE):
                    size += len(column[hi])
                    hi += 1
                keys = [hashlib.sha256(t.encode()).hexdigest() for t in column[lo:hi]]
                rows = []
                for key, n, found in zip(keys, copies[lo:hi], memo.align(column[lo:hi]), strict=True):
                    n_a, n_b, groups, links = found
                    if filled and filled + len(links) > BLOCK_LINKS:
                        block, filled = block + 1, 0
                    filled += len(links)
                    n_groups = groups.count(";") + 1 if groups else 0
                    rows.append((key, n, block, n_a, n_b, n_groups, groups, links.tobytes()))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(names, r, strict=True)) for r in rows], schema=layout
                )
                lo = hi

    layout = pa.schema(
        [("text_key", pa.string()), ("copies", pa.int64()), ("block", pa.int64()), ("n_a", pa.int64())]
        + [("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups", pa.large_string()), ("links", pa.large_binary())]
    )
    names = layout.names
    schema = (
        "text_key string, copies long, block long, n_a long, n_b long, n_groups long,"
        " groups string, links binary"
    )
    return texts.select("text", "copies").mapInArrow(run, schema)


def _block_pairs(aligned: DataFrame, kind: type) -> DataFrame:
    """(block, link, n): how often a block's texts link a pair, over all copies."""

    def run(batches):
        for batch in batches:
            codes = [np.frombuffer(x.as_py(), kind) for x in batch.column(2)]
            size = [len(x) for x in codes]
            block = np.repeat(batch.column(0).to_numpy(), size)
            copies = np.repeat(batch.column(1).to_numpy(), size)
            code = np.concatenate(codes) if codes else np.zeros(0, kind)
            for own in np.unique(block):
                here = block == own
                links, at = np.unique(code[here], return_inverse=True)
                n = np.bincount(at, copies[here]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(links), own)), pa.array(links.astype(np.int64)), pa.array(n)], ["block", "link", "n"]
                )

    rows = aligned.select("block", "copies", "links").mapInArrow(run, "block long, link long, n long")
    return rows.groupBy("block", "link").agg(F.sum("n").alias("n"))


def pair_counts(block_pairs: DataFrame, size_b: int) -> DataFrame:
    """(link, a, b, n, best): links over the corpus; best: no pair of b has more."""
    totals = block_pairs.groupBy("link").agg(F.sum("n").alias("n"))
    totals = totals.withColumn("a", F.expr(f"link div {size_b}")).withColumn("b", F.col("link") % size_b)
    most = totals.groupBy("b").agg(F.max("n").alias("most"))
    return totals.join(most, "b").select("link", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def measures(docs: DataFrame, pair: Pair) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    bounded_batches(docs.sparkSession)
    found = align(distinct_texts(docs), pair)
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    found = stage(found.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    opened = pair.opened()
    kind = opened.code_type()
    pairs = stage(_block_pairs(found, kind), "block_pairs")
    counts = pair_counts(pairs, opened.size_b)
    known = pairs.select("block", "link").join(counts.select("link", "n", "best"), "link")

    def judge(texts: pa.Table, answers: pa.Table) -> pa.Table:
        link = answers.column("link").to_numpy()
        order = np.argsort(link)
        link = link[order]
        count, best = answers.column("n").to_numpy()[order], answers.column("best").to_numpy()[order]
        n_links, n_best, total = [], [], []
        for blob in texts.column("links"):
            at = np.searchsorted(link, np.frombuffer(blob.as_py(), kind))
            n_links.append(len(at))
            n_best.append(int(best[at].sum()))
            total.append(int(count[at].sum()))
        kept = texts.select(["text_key", "n_a", "n_b", "n_groups"])
        for name, values in (("n_links", n_links), ("n_best", n_best), ("count_sum", total)):
            kept = kept.append_column(name, pa.array(values, pa.int64()))
        return kept.append_column("groups_sha256", texts.column("groups_sha256"))

    judged = (
        found.drop("copies")
        .groupBy("block")
        .cogroup(known.groupBy("block"))
        .applyInArrow(
            judge,
            "text_key string, n_a long, n_b long, n_groups long, n_links long, n_best long,"
            " count_sum long, groups_sha256 string",
        )
    )
    rows = docs.select("doc_id", F.sha2("text", 256).alias("text_key")).join(judged, "text_key", "left")
    numbers = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return rows.select(
        "doc_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
