"""Exact top-k search by inner product with Fagin's threshold algorithm.

Vectors become whole numbers, floor(scale * x) of each component. Queries and
candidates are dealt into blocks of bounded size, and each block of queries meets
each block of candidates once. In a block every dimension has its list of candidates,
sorted by component. A query walks all its lists together, from the end that its own
component favours; what the lists show at a depth is scored in full, and the scores
the lists could still give bound everything unseen. The walk stops when that bound
cannot beat the k-th best score so far; on a tie it goes on, as a smaller id wins.
The k best of a query's blocks are then merged.

Vectors that are null or hold null or non-finite components take no part, nor do
rows without an id. A query does not find its own row: candidates of its id are left
out. Missing dimensions count as 0. Equal scores go by smaller id; repeated rows are candidates of
their own. Empty tables give an empty one; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

K = 5
SCALE = 256
CANDIDATE_BLOCK, QUERY_BLOCK = 8192, 2048
FIRST_DEPTH = 8


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), width), np.int64)
    row = np.repeat(np.arange(len(vectors)), lengths)
    column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, column] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


class Lists:
    """A block of candidates with one list per dimension, sorted by component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]  # by id, so that an earlier row wins a tie
        self.rising = np.argsort(self.vectors, axis=0, kind="stable").T
        self.values = np.take_along_axis(self.vectors.T, self.rising, axis=1)
        # magnitudes decide whether doubles hold every inner product exactly
        self.exact = self.vectors.astype(np.float64)
        self.largest = int(np.abs(self.vectors).max(initial=0))

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best candidates, best first."""
        n, dims = self.vectors.shape
        used = np.flatnonzero(query)
        fits = self.largest * int(np.abs(query).max(initial=0)) * max(1, dims) < 1 << 53
        table, asked = (self.exact, query.astype(np.float64)) if fits else (self.vectors, query)
        weights = query[used]
        falls = weights > 0
        seen = np.zeros(n, bool)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        done, depth = 0, FIRST_DEPTH if len(used) else n
        while True:
            depth = min(depth, n)
            # the same stretch of all lists: from the back where the component is positive
            stretch = np.arange(done, depth)
            at = np.where(falls[:, None], n - 1 - stretch, stretch) if len(used) else stretch[None, :]
            shown = self.rising[used[:, None], at] if len(used) else self.rising[:1, done:depth]
            met = seen.copy()
            met[shown.ravel()] = True
            fresh = np.flatnonzero(met & ~seen)
            seen = met
            fresh = fresh[self.ids[fresh] != own]
            rows = np.concatenate((rows, fresh))
            scores = np.concatenate((scores, (table[fresh] @ asked).astype(np.int64)))
            if len(rows) > k:
                best = np.lexsort((rows, -scores))[:k]
                rows, scores = rows[best], scores[best]
            if depth == n or seen.all():
                break
            bound = int((self.values[used, np.where(falls, n - depth, depth - 1)] * weights).sum())
            if len(rows) == k and bound < scores.min():
                break
            done, depth = depth, depth * 4
        order = np.lexsort((rows, -scores))
        return rows[order], scores[order]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for queries and candidates of (vec_id, vector of long)."""
    n_queries, n_rows = queries.count(), candidates.count()
    across, down = max(1, -(-n_rows // candidate_block)), max(1, -(-n_queries // query_block))
    c = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(across)).cast("int")
    q = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(down)).cast("int")
    asked = queries.select("vec_id", "vector", F.lit(True).alias("asks"), q.alias("q"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("c"))
    offered = candidates.select("vec_id", "vector", F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("q"), c.alias("c"))

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        vectors = table.column("vector").combine_chunks()
        vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors
        asks = table.column("asks").to_numpy().astype(bool)
        width = max(1, int(vectors.value_lengths().to_numpy(zero_copy_only=False).max(initial=1)))
        matrix = _matrix(vectors, width)
        lists = Lists(ids[~asks], matrix[~asks])
        out: list[list[np.ndarray]] = [[], [], []]
        for own, vector in zip(ids[asks].tolist(), matrix[asks], strict=True):
            rows, scores = lists.search(vector, own, k) if len(lists.ids) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            for column, values in zip(out, (np.full(len(rows), own), lists.ids[rows], scores), strict=True):
                column.append(values)
        columns = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out]
        return pa.Table.from_arrays(columns, ["query_id", "vec_id", "score"])

    found = asked.union(offered).groupBy("q", "c").applyInArrow(run, "query_id long, vec_id long, score long")
    best = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def prepared(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, vector of long) of the rows that take part."""
    fit = vectors.filter(F.col(key).isNotNull() & usable(F.col(vector)))
    return fit.select(F.col(key).cast("long").alias("vec_id"), whole_numbers(F.col(vector), scale).alias("vector"))
