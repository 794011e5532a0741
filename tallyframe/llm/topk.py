"""Exact top-k inner products through an impact-ordered index."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Components are whole numbers: floor(SCALE * x).
SCALE = 1024
#: Rows of one index, at least and at most. It grows with the root of the table, as every
#: query is copied to every shard.
SHARD_ROWS, MOST_ROWS = 4096, 1 << 17
#: Impact levels of a component: each gets its own posting segment.
LEVELS = 16
#: The proof is tried after every so many segments, and accepted once it leaves at most
#: so many rows to be scored exactly.
STEP, LEFT = 64, 64


class ImpactIndex:
    """Posting segments of one shard, by component and quantised impact.

    ``vectors`` are whole numbers, one row each; ``ids`` break ties, least first.
    """

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors, self.ids = vectors, ids
        self.low, high = vectors.min(0), vectors.max(0)
        self.width = np.maximum(1, -(-(high - self.low + 1) // LEVELS))
        level = (vectors - self.low) // self.width
        self.dims, self.levels, self.rows = [], [], []
        for dim in range(vectors.shape[1]):
            order = np.argsort(level[:, dim], kind="stable")
            cuts = np.flatnonzero(np.diff(level[order, dim])) + 1
            for part in np.split(order, cuts):
                self.dims.append(dim)
                self.levels.append(int(level[part[0], dim]))
                self.rows.append(part)
        self.dims, self.levels = np.array(self.dims), np.array(self.levels)

    def top(self, query: np.ndarray, k: int, own: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best, without the row ``own``.

        Each posting adds the least that its segment can contribute, over the least that
        any row gets from that component. The largest impacts come first. What a row may
        still gain is bounded by the largest impact left in each component, and by the
        width of the levels for what it has gained. Once few enough rows can reach the
        k-th sum by that bound, only they are scored, exactly; the others are proven to
        be outside. Without such a proof all segments are processed.
        """
        query = query.astype(np.int64)
        weight = query[self.dims]
        edge = self.low[self.dims] + self.levels * self.width[self.dims]
        last = edge + self.width[self.dims] - 1
        least = np.minimum(weight * edge, weight * last)
        most = np.maximum(weight * edge, weight * last)
        floor = np.full(len(query), np.iinfo(np.int64).max)
        np.minimum.at(floor, self.dims, least)
        gain, reach = least - floor[self.dims], most - floor[self.dims]
        order = np.argsort(-reach, kind="stable")
        order = order[query[self.dims[order]] != 0]
        sums = np.zeros(len(self.vectors), np.int64)
        alive = np.ones(len(sums), dtype=bool)
        if own >= 0:
            alive[own] = False
        error = int((np.abs(query) * (self.width - 1)).sum())
        possible = np.flatnonzero(alive)
        for at in range(0, len(order), STEP):
            part = order[at : at + STEP]
            for segment in part[gain[part] > 0].tolist():
                sums[self.rows[segment]] += gain[segment]
            rest = np.zeros(len(query), np.int64)
            np.maximum.at(rest, self.dims[order[at + STEP :]], reach[order[at + STEP :]])
            open_ = sums[possible]
            if len(possible) > k:
                bar = np.partition(open_, len(open_) - k)[len(open_) - k]
                possible = possible[open_ + int(rest.sum()) + error >= bar]
            if len(possible) <= max(k, LEFT):
                break
        scores = self.vectors[possible] @ query
        best = np.lexsort((self.ids[possible], -scores))[:k]
        return possible[best], scores[best]


def whole(vectors: list[list[float]]) -> np.ndarray:
    """floor(1024 * x) of all components, as rows; shorter vectors end in zeros.

    Components beyond whole numbers of 64 bits raise OverflowError before they are cast.
    """
    longest = max(map(len, vectors), default=0)
    rows = np.zeros((len(vectors), longest))
    for row, vector in zip(rows, vectors, strict=True):
        row[: len(vector)] = vector
    with np.errstate(over="ignore"):
        floors = np.floor(SCALE * rows)
    if not (np.abs(floors) < 2.0**62).all():
        raise OverflowError("components are too large for whole-number scores of 64 bits")
    return floors.astype(np.int64)


def _fits(a: np.ndarray, b: np.ndarray) -> None:
    largest = [float(np.abs(x).max(initial=0)) + 2 * LEVELS for x in (a, b)]
    if largest[0] * largest[1] * a.shape[1] >= 2.0**62:
        raise OverflowError("components are too large for whole-number scores of 64 bits")


def exact_top_k(
    table: DataFrame,
    is_query: Column,
    k: int = 10,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows for each query row.

    Queries are the rows of ``table`` for which ``is_query`` holds, candidates all rows
    but the query's own. Scores are inner products of the whole-number components, ties
    go to the smaller id. Rows without an id or a vector, or whose vector holds a null,
    a NaN or an infinity, take no part. Missing components of shorter vectors count as 0.
    Other rows with the query's id are candidates, and rows repeat if a query does.
    Scores beyond 64 bits raise OverflowError.

    Rows are dealt to shards of SHARD_ROWS or more by a hash of the row, so copies do not
    gather. Each shard indexes its rows once; then all queries stream past it in blocks,
    and leave their k best of the shard. A second step merges those per query.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.where(F.col(id).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id).cast("bigint").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    total = table.count()
    shards = max(1, -(-total // min(max(SHARD_ROWS, 4 * isqrt(total)), MOST_ROWS)))
    candidates = rows.select(
        F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "row", "id", "vector"
    )
    queries = rows.where("asks").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "row", "id", "vector"
    )

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, kept, index, members = None, [], None, None
        for batch in batches:
            shard, kind = (batch.column(i).to_numpy() for i in (0, 1))
            if not len(shard):
                continue
            change = np.flatnonzero((np.diff(shard) != 0) | (np.diff(kind) != 0)) + 1
            for start, end in zip([0, *change.tolist()], [*change.tolist(), len(shard)], strict=True):
                part = batch.slice(start, end - start)
                if shard[start] != current:
                    current, kept, index = shard[start], [], None
                if kind[start] == 0:
                    kept.append(part)
                elif kept:
                    if index is None:
                        ids = np.concatenate([p.column(3).to_numpy() for p in kept])
                        index = ImpactIndex(whole([v for p in kept for v in p.column(4).to_pylist()]), ids)
                        members = {r: i for i, r in enumerate(r for p in kept for r in p.column(2).to_pylist())}
                    yield answers(index, members, part)

    def answers(index: ImpactIndex, members: dict[int, int], part: pa.RecordBatch) -> pa.RecordBatch:
        asked = whole(part.column(4).to_pylist())
        size = index.vectors.shape[1]
        asked = np.pad(asked, ((0, 0), (0, max(0, size - asked.shape[1]))))[:, :size]
        _fits(index.vectors, asked)
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for row, query_id, query in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), asked, strict=True):
            best, scores = index.top(query, k, members.get(row, -1))
            found = (np.full(len(best), row), np.full(len(best), query_id), index.ids[best], scores)
            for column, values in zip(columns, found, strict=True):
                column.append(values)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c).astype(np.int64)) for c in columns], ["row", "query_id", "vec_id", "score"]
        )

    dealt = candidates.unionByName(queries).repartition("shard").sortWithinPartitions("shard", "kind")
    found = dealt.mapInArrow(search, "row bigint, query_id bigint, vec_id bigint, score bigint")
    ranked = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return (
        found.withColumn("rank", ranked)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
