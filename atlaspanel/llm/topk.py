"""Exact top-k inner products by the threshold algorithm.

The candidates are dealt into shards and a shard sorts, for every dimension, its
vectors by that coordinate. A query reads the lists of its non-zero dimensions
from the end its sign favours, a stretch at a time. A vector met for the first
time is scored in full; the coordinates at the present depth bound the score of
every vector not met yet, and the search of the shard stops when that bound is
below the k-th best score found (a bound equal to it could still win by its
smaller id). The shards' best are merged per query.

A task reads a shard's candidates, builds its lists once, and then reads the
queries as a stream: what it holds is one shard and one batch.

Defined results: vectors that are null, empty, or hold a null or non-finite
component take no part, nor do rows without an id; a query is compared with
vectors of its own length only; rows that share the query's id are its own and
no candidates; repeated candidates are candidates each; equal query rows are one
query, rows with one id and different vectors are queries each; ties go to the
smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlaspanel.llm.common import stored

SCALE = 64
TOP = 20
#: Candidates of a shard.
SHARD = 8_192
#: First stretch of the lists; stretches double.
STRETCH = 128

FOUND = "query long, query_id long, vec_id long, score long"


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v array<long>) of the vectors that take part."""
    v = F.col(vector_col)
    fine = F.col(id_col).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return rows.filter(F.coalesce(fine, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")
    )


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    v = table["v"].combine_chunks()
    ids = table["id"].to_numpy()
    return ids, v.flatten().to_numpy().reshape(len(ids), -1)


class Lists:
    """A shard's vectors with their sorted per-dimension lists."""

    def __init__(self, ids: np.ndarray, v: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, exact = ids[order], v[order]
        reach = int(np.abs(exact).max(initial=0)) ** 2 * exact.shape[1]
        # sums of products are whole numbers; the narrowest type that holds them all exactly
        self.kind = np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64
        self.v = exact.astype(self.kind)
        up = np.argsort(exact, axis=0, kind="stable").T
        self.up, self.down = up.astype(np.int32), up[:, ::-1].astype(np.int32)
        self.low, self.high = np.take_along_axis(exact.T, up, 1), np.take_along_axis(exact.T, up[:, ::-1], 1)

    def search(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, score) of the best ``k`` vectors for ``q``, by score and then smaller id."""
        n, up, down = len(self.ids), np.flatnonzero(q < 0), np.flatnonzero(q > 0)
        qk = q.astype(self.kind)
        best_rows, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(up) + len(down):  # every score is zero: the smallest ids win
            rows = np.flatnonzero(self.ids != query_id)[:k]
            return rows, np.zeros(len(rows), np.int64)
        met = self.ids == query_id
        at, width = 0, STRETCH
        while at < n:
            to = min(n, at + width)
            new = np.zeros(n, bool)
            new[self.down[down, at:to]] = True
            new[self.up[up, at:to]] = True
            new &= ~met
            met |= new
            rows = np.flatnonzero(new)
            if len(rows):
                score = (self.v[rows] @ qk).astype(np.int64)
                if len(best) == k:  # a tie may still win by its smaller id
                    near = score >= best[-1]
                    rows, score = rows[near], score[near]
                rows, score = np.r_[best_rows, rows], np.r_[best, score]
                order = np.lexsort((rows, -score))[:k]  # rows are in the order of their ids
                best_rows, best = rows[order], score[order]
            bound = int(q[down] @ self.high[down, to - 1] + q[up] @ self.low[up, to - 1])
            if len(best) == k and bound < best[-1]:
                break
            at, width = to, 2 * width
        return best_rows, best


def _search(k: int):
    """Rows sorted by shard, candidates before queries, to (query, query_id, vec_id, score)."""

    def run(batches):
        key, held, lists = None, [], None
        for b in batches:
            t = pa.Table.from_batches([b])
            marks = np.stack([t[c].to_numpy() for c in ("dims", "shard", "asks")], 1).astype(np.int64)
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1).tolist(), len(marks)]
            for at, to in zip(cuts, cuts[1:]):
                here, asks, some = tuple(marks[at, :2]), marks[at, 2], t.slice(at, to - at)
                if here != key:
                    key, held, lists = here, [], None
                if not asks:
                    held.append(some)
                    continue
                if lists is None and held:
                    lists, held = Lists(*_matrix(pa.concat_tables(held))), []
                if lists is None:  # no candidate of this length in the shard
                    continue
                out: list[list[np.ndarray]] = [[], [], [], []]
                for query, query_id, q in zip(some["query"].to_numpy(), *_matrix(some)):
                    rows, score = lists.search(int(query_id), q, k)
                    for column, values in zip(out, (np.full(len(rows), query), np.full(len(rows), query_id), lists.ids[rows], score)):
                        column.append(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out], ["query", "query_id", "vec_id", "score"])

    return run


def top_k(
    spark: SparkSession, candidates: DataFrame, queries: DataFrame, k: int = TOP, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding",
    shard: int = SHARD,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of every query."""
    c = stored(integer_vectors(candidates, id_col, vector_col, scale).withColumn("dims", F.size("v")), "topk-candidates")
    asked = integer_vectors(queries, id_col, vector_col, scale).withColumn("dims", F.size("v")).distinct()
    q = stored(asked.withColumn("query", F.monotonically_increasing_id()), "topk-queries")
    shards = max(1, -(-c.count() // shard))
    # candidates go by a hash of id and vector, so that many equal vectors spread; every query meets every shard
    dealt = c.select("dims", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("asks"), F.lit(None).cast("long").alias("query"), "id", "v")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    asking = q.select("dims", every, F.lit(1).alias("asks"), "query", "id", "v")
    met = dealt.unionByName(asking).repartition(shards, "dims", "shard").sortWithinPartitions("dims", "shard", "asks")
    found = met.mapInArrow(_search(k), FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
