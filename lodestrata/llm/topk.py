"""Operator 3: exact top-k by inner product, from sorted lists without random access.

Vectors are cut into blocks. For a block there is one list a dimension: its vectors
by falling component (read from the other end where a query's component is
negative). Lists are read in step, a stretch of READ entries at a time. After each
stretch a vector's score is known up to its unread components, which lie between the
list's last value read and its end: that gives an upper bound
    sum of q_d * (x_d if read, else last value read)
and, with the end of the list in place of the last value, a lower bound. A vector
whose upper bound is below the query's k-th best lower bound (of this block, or of
exact scores of earlier blocks) is out for good. Reading stops when at most
RESOLVE vectors a query are left, or the lists end; the scores of those that are
left are then resolved in integers.

Because a read component is simply one not beyond the last value read, a stretch for
all queries and all vectors of a block is a matrix product with the clamped block.

Queries: every row whose id is divisible by `every`; candidates: every other row.
Queries are sent to the tasks in chunks of at most CHUNK, one pass over the vectors
each; a task answers a chunk from its own blocks, and a ranked window merges the k
best of all tasks.

Components become floor(scale * x). Vectors that are null, empty or hold a null or
non-finite component take no part, nor do rows without id. Shorter vectors count as padded with zeros.
Equal scores: the smaller id first. Repeated ids are rows of their own, but a
query's own id is never its answer. Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.llm.textscan import bounded_batches

BLOCK = 4_096
#: Queries of one broadcast, and of one matrix product.
CHUNK = 65_536
AT_ONCE = 1_024
#: Parts of the lists that are read at a time, as fractions of their length.
READ = (0.5, 0.75, 0.9, 1.0)
#: Candidates a query that are resolved rather than read on.
RESOLVE = 64


def lists_of(block: np.ndarray) -> np.ndarray:
    """The sorted lists of a block: column d holds the values of dimension d, falling."""
    return -np.sort(-block, axis=0)


def nra(
    queries: np.ndarray, block: np.ndarray, k: int, floor: np.ndarray, own: np.ndarray
) -> np.ndarray:
    """Whether vector j may be among the k best of query i; no other vector can be.

    `floor`: for each query a score that its k-th best has at least.
    `own`: whether vector j has the id of query i; it is no answer and sets no bound.
    """
    n = len(block)
    if n <= k:
        return ~own
    lists = lists_of(block)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    open_ = ~own
    floor = floor.copy()
    for part in READ:
        last = min(n, int(np.ceil(part * n))) - 1
        high, low = lists[last], lists[n - 1 - last]
        upper = up @ np.maximum(block, high).T
        upper += down @ np.minimum(block, low).T
        lower = up @ np.where(block >= high, block, lists[-1]).T
        lower += down @ np.where(block <= low, block, lists[0]).T
        lower[own] = -np.inf
        kth = np.partition(lower, n - k, axis=1)[:, n - k]
        floor = np.maximum(floor, kth)
        open_ &= upper >= floor[:, None]
        if part == 1.0 or open_.sum(axis=1).max() <= max(RESOLVE, k):
            break
    return open_


def _best(queries, q_ids, block, ids, k, floor):
    """Rows (query, id, score) of the k best of this block, resolved in integers."""
    # sums in float64 are exact up to 2**53; for larger components bounds get some slack
    slack = 0.0
    largest = max(np.abs(queries).max(initial=0), np.abs(block).max(initial=0))
    if largest**2 * queries.shape[1] >= 2.0**52:
        slack = largest**2 * queries.shape[1] * 2.0**-48
    open_ = nra(queries, block, k, floor - slack, q_ids[:, None] == ids)
    qi, vi = np.nonzero(open_)
    if slack:
        whole = [[int(x) for x in row] for row in queries], [[int(x) for x in row] for row in block]
        score = [
            sum(a * b for a, b in zip(whole[0][i], whole[1][j], strict=True))
            for i, j in zip(qi, vi, strict=True)
        ]
        score = np.array([max(min(s, 2**63 - 1), -(2**63)) for s in score], np.int64)
    else:
        score = np.empty(len(qi), np.int64)
        q_int, v_int = queries.astype(np.int64), block.astype(np.int64)
        for lo in range(0, len(qi), 1 << 18):
            part = slice(lo, lo + (1 << 18))
            score[part] = np.einsum("ij,ij->i", q_int[qi[part]], v_int[vi[part]])
    order = np.lexsort((ids[vi], -score, qi))
    qi, vi, score = qi[order], vi[order], score[order]
    begin = np.searchsorted(qi, np.arange(len(queries)))
    rank = np.arange(len(qi)) - begin[qi]
    top = rank < k
    kth = np.flatnonzero(rank == k - 1)
    floor[qi[kth]] = np.maximum(floor[qi[kth]], score[kth])
    return qi[top], vi[top], score[top]


class _Best:
    """The k best of every query over the blocks read so far."""

    def __init__(self, q_ids: np.ndarray, queries: np.ndarray, k: int):
        self.q_ids, self.queries, self.k = q_ids, queries, k
        self.floor = np.full(len(q_ids), -np.inf)
        self.rows = [np.zeros(0, np.int64)] * 3

    def read(self, ids: np.ndarray, block: np.ndarray) -> None:
        wide = max(block.shape[1], self.queries.shape[1])
        block = np.pad(block, ((0, 0), (0, wide - block.shape[1])))
        queries = np.pad(self.queries, ((0, 0), (0, wide - self.queries.shape[1])))
        found = [self.rows]
        for lo in range(0, len(queries), AT_ONCE):
            own = slice(lo, lo + AT_ONCE)
            qi, vi, score = _best(
                queries[own], self.q_ids[own], block, ids, self.k, self.floor[own]
            )
            found.append([qi + lo, ids[vi], score])
        qi, vec, score = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((vec, -score, qi))
        qi, vec, score = qi[order], vec[order], score[order]
        rank = np.arange(len(qi)) - np.searchsorted(qi, qi)
        self.rows = [x[rank < self.k] for x in (qi, vec, score)]
        full = rank == self.k - 1
        self.floor[qi[full]] = score[full]


def _matrix(column: pa.Array) -> np.ndarray:
    length = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(length), int(length.max(initial=0))))
    out[np.arange(out.shape[1]) < length[:, None]] = column.flatten().to_numpy()
    return out


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every query."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    x = F.col(vector_col)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("double"))
    rows = vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & fine)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), whole.alias("x"))
    asked = rows.where(F.col("id") % every == 0)
    chunks = -(-asked.count() // CHUNK)
    part = F.pmod(F.xxhash64("id"), F.lit(max(chunks, 1)))
    found = None
    for number in range(chunks):
        chunk = asked.where(part == number).toArrow()
        ids = chunk.column(0).to_numpy()
        block = _matrix(chunk.column(1).combine_chunks())
        sent = spark.sparkContext.broadcast((ids, block))
        own = _answered(rows, sent, k, number)
        found = own if found is None else found.unionAll(own)
    if found is None:
        found = spark.createDataFrame([], "query long, query_id long, vec_id long, score long")
    # a query is a row of its own, also where others have its id
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _answered(rows: DataFrame, sent, k: int, chunk: int) -> DataFrame:
    """The k best of each query in every partition of `rows`."""

    def run(batches):
        q_ids, queries = sent.value
        best = _Best(q_ids, queries, k)
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK:
                read(best, held)
                held, size = [], 0
        if size:
            read(best, held)
        qi, vec, score = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array((chunk << 32) + qi), pa.array(q_ids[qi]), pa.array(vec), pa.array(score)],
            ["query", "query_id", "vec_id", "score"],
        )

    def read(best, held):
        table = pa.Table.from_batches(held).combine_chunks()
        best.read(table.column(0).to_numpy(), _matrix(table.column(1).combine_chunks()))

    return rows.mapInArrow(run, "query long, query_id long, vec_id long, score long")


#: The same rows in DuckDB: all scores, ranked.
ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x:
    x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    list_inner_product(q.x, v.x)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id
)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""
