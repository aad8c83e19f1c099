"""Exact top-k inner products over an impact-ordered index, score at a time.

Components become whole numbers ``floor(256 x)``.  Vectors are dealt into
candidate blocks of bounded size by row hash.  A block is sorted before the
queries that are streamed past it, so its index is built once: per dimension,
posting segments of the vectors whose component lies in the same quantised range.

For a query the segments of all dimensions are ordered by impact (query
component times the range's better end, an upper bound) and processed from
the highest down: a segment adds its impact to the accumulators of its vectors.
A vector not yet met in a dimension has at most the next segment's impact
there, so accumulator + open dimensions * next impact bounds its score.  The
threshold is the k-th best exact score of the leading vectors.  Processing
stops only when the vectors whose bound reaches the threshold are few enough to
rescore exactly (or all segments are done); every one of them is rescored, so
ties at the threshold are seen and the result is exact.

A block yields k rows a query; the final order is a window over those.

Cases: vectors that are null, or hold a null or non-finite component, take no
part; shorter vectors count as padded with zeros; rows that repeat an id, or a
whole row, are candidates each and, where the id is a query's, queries each with
a ranking of their own; only the query's own row is no candidate; a null vec_id
is no query and no candidate; ties go to the smaller vec_id; fewer candidates than k give all of them; an
empty table gives no rows; other columns are ignored.  Scores outside 64 bits
are held at their border.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import stored, table

K = 5
SCALE = 256
#: Query rows: ids divisible by this.
QUERY_EVERY = 50
#: Vectors of a candidate block, on average (dealt by hash).
CANDIDATES = 8192
#: Ranges a dimension is cut into.
LEVELS = 32
#: Rescoring is cheaper than another segment from so many vectors on, as a share of the block.
FEW = 1 / 4
#: Steps in which a query's segments are processed, with a proof attempt between.
STEPS = 16
#: Largest quantised impact, and what an accumulator counts a met dimension as: sums stay exact up to 2 ** 10 dimensions.
IMPACT, COUNT = 1 << 28, float(1 << 40)
#: Components up to this size have exact scores in doubles; larger ones are summed as Python integers.
LIMIT = 1 << 20


class ImpactIndex:
    """Posting segments of a block: per dimension, vectors by quantised component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None, levels: int = LEVELS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.rows = self.ids if rows is None else rows[order]
        n, dims = self.vectors.shape
        width = max(1, -(-n // levels))
        levels = -(-n // width)
        # (dimension, level, member): equal lengths; the last segment is filled up with n, which nobody is.
        ranked = np.full((dims, levels * width), n, np.int32)
        ranked[:, :n] = np.argsort(self.vectors, axis=0, kind="stable").T
        cuts = np.minimum(np.arange(levels + 1) * width, n)
        sorted_ = np.sort(self.vectors, axis=0)
        self.members = ranked.reshape(dims * levels, width)
        self.low = sorted_[cuts[:-1]].T.ravel()
        self.high = sorted_[cuts[1:] - 1].T.ravel()
        self.dimension = np.repeat(np.arange(dims), levels)
        self.few = max(4 * K, int(n * FEW))
        self.largest = np.abs(self.vectors).max(initial=0)

    def search(self, query: np.ndarray, own: int, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best vectors of the block other than row ``own``, ties to the smaller id."""
        n, dims = self.vectors.shape
        if n == 0:
            return self.ids[:0], self.ids[:0]
        weight = query[self.dimension]
        impact = np.maximum(weight * self.low, weight * self.high)
        # Whole quantised impacts, rounded up, small enough to be summed beside a count of dimensions.
        scale = max(1.0, np.abs(impact).max(initial=0) / IMPACT)
        impact = np.ceil(impact / scale)
        order = np.argsort(-impact, kind="stable")
        impact = impact[order]
        gathered = np.zeros(n + 1)
        other = self.rows != own
        possible = np.flatnonzero(other)
        per_step = max(1, len(order) // STEPS)
        for at in range(0, len(order), per_step):
            if at and impact[at] * 8 <= impact[0] and len(possible) > self.few:
                met = np.rint(gathered[:n] / COUNT)
                reach = gathered[:n] - met * COUNT + (dims - met) * impact[at]
                lead = possible[np.argpartition(-reach[possible], min(4 * k, len(possible) - 1))[:4 * k]]
                exact = np.sort(self._scores(lead, query))
                if len(exact) >= k:
                    left = np.flatnonzero(other & ((reach + 1) * scale >= exact[-k]))  # a unit against rounding
                    if len(left) <= self.few:  # proof: no other vector can reach the threshold
                        possible = left
                        break
            segments = order[at:at + per_step]
            gathered += np.bincount(self.members[segments].ravel(), minlength=n + 1,
                                    weights=np.repeat(impact[at:at + per_step] + COUNT, self.members.shape[1]))
        scores = self._scores(possible, query)
        best = np.lexsort((self.ids[possible], -scores))[:k]
        return self.ids[possible][best], scores[best]

    def _scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact whole-number scores."""
        found = self.vectors[rows] @ query
        if self.largest <= LIMIT and np.abs(query).max(initial=0) <= LIMIT:
            return found
        whole = [sum(int(a) * int(b) for a, b in zip(v, query)) for v in self.vectors[rows]]
        return np.array([min(max(x, -(1 << 63)), (1 << 63) - 1) for x in whole], object)


def quantised(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(row, vec_id, q): floor(scale * x) of the vectors that take part; ``row`` tells rows apart once it is written down."""
    x = F.col(column)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    q = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(scale))).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), q.alias("q"))


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of doubles: lists padded with zeros, or cut, to ``width`` (their own largest length)."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    own = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), own))
    out[np.arange(own) < lengths[:, None]] = flat
    if width is None or width == own:
        return out
    return out[:, :width] if width < own else np.pad(out, ((0, 0), (0, width - own)))


def _streamed(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rankings of the queries of every block; rows come by block, its candidates before the queries."""
    block, held, index = None, [], None
    for batch in batches:
        blocks, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("c", "asks"))
        edges = np.flatnonzero((blocks[1:] != blocks[:-1]) | (asks[1:] != asks[:-1])) + 1
        for lo, hi in zip([0, *edges], [*edges, len(blocks)]):
            if hi == lo:
                continue
            if blocks[lo] != block:
                block, held, index = blocks[lo], [], None
            part = batch.slice(lo, hi - lo)
            if not asks[lo]:
                held.append(part)
                continue
            if index is None:
                whole = pa.Table.from_batches(held, batch.schema).combine_chunks()
                ids, rows = (whole.column(c).to_numpy() for c in ("vec_id", "row"))
                vectors = whole.column("q").combine_chunks() if len(whole) else pa.array([], pa.list_(pa.int64()))
                index, held = ImpactIndex(ids, _matrix(vectors), rows), []
            out: list[list] = [[], [], [], []]
            asked, own = (part.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "row"))
            for query, row, vector in zip(asked, own, _matrix(part.column("q"), index.vectors.shape[1])):
                found, scores = index.search(vector, row, k)
                out[0] += [row] * len(found)
                out[1] += [query] * len(found)
                out[2] += found.tolist()
                out[3] += [int(x) for x in scores]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["row", "query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, candidates_per_block: int = CANDIDATES) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``queries`` against ``vectors``, both (row, vec_id, q); one ranking a query row."""
    n_c = max(1, -(-vectors.count() // candidates_per_block))
    # The stated queries against all rows, in blocks: a query is sent to every block.
    left = vectors.select(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n_c)).cast("int").alias("c"), F.lit(False).alias("asks"), "row", "vec_id", "q")
    right = queries.select(F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))).alias("c"), F.lit(True).alias("asks"), "row", "vec_id", "q")
    blocks = left.unionByName(right).repartitionById(n_c, F.col("c")).sortWithinPartitions("c", "asks", "row")
    found = blocks.mapInArrow(lambda batches: _streamed(batches, k), "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op10_topk(spark, sf_dir) -> DataFrame:
    """The 5 best other rows of every row of ``embeddings`` whose id is divisible by 50."""
    vectors = stored(quantised(table(spark, sf_dir, "embeddings")), "topk-vectors")
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))


OP10_SQL = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
           FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.r, a.vec_id AS query_id, b.vec_id,
             CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.q, b.q)]) AS BIGINT) AS score
      FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM s WINDOW w AS (PARTITION BY r ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""
