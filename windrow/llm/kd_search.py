"""Exact top-k by inner product over KD-trees, one for each shard.

Vectors become integers, floor(scale * component). A shard (a bounded number of vectors) is split at
medians of its widest components down to leaves; every node has a tight bounding box, and the tree is written once. Queries come
in blocks of bounded size. A query's bound for a box is the largest inner product any point in it could have;
each query goes from the root through a queue of nodes, the best bound first, and stops where no bound reaches its kth score. That score
starts from a pilot shard and goes on from leaf to leaf and from shard to shard of a task. Queries that stand before the same leaf are
scored together. Scores are integers throughout: bounds only are floating point, widened by what rounding can take off.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm._common import materialize

SHARD, LEAF, BLOCK = 8192, 256, 16384
#: Products and sums below these are exact as doubles, as longs.
_DOUBLE, _LONG = float(2**53), float(2**62)
_LEAST, _MOST, _NONE = -(2**63), 2**63 - 1, np.iinfo(np.int64).max
_SHARD_SCHEMA = "shard long, dim int, ids binary, vectors binary, nodes binary, low binary, high binary"


def whole_numbers(scale: int, x: np.ndarray) -> np.ndarray:
    """floor(scale * x) as doubles; what lies beyond the doubles is held at the largest of its sign."""
    most = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x), -most, most)


def build_tree(x: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows and the nodes of a KD-tree, the root first: begin and end in that order, and both children (-1: a leaf).

    The widest component is cut at its median until a leaf is small.
    """
    order, nodes, todo = np.arange(len(x)), [[0, len(x), -1, -1]], [0]
    while todo:
        k = todo.pop()
        begin, end = nodes[k][:2]
        if end - begin <= leaf or not x.shape[1]:
            continue
        part = x[order[begin:end]]
        axis, half = int((part.max(0) / 2 - part.min(0) / 2).argmax()), (end - begin) // 2  # halved, as a width may pass the doubles
        order[begin:end] = order[begin:end][np.argpartition(part[:, axis], half)]
        nodes[k][2:] = len(nodes), len(nodes) + 1
        todo += nodes[k][2:]
        nodes += [[begin, begin + half, -1, -1], [begin + half, end, -1, -1]]
    return order, np.array(nodes, np.int64)


def build_shards(vectors: DataFrame, scale: int, shard: int = SHARD) -> DataFrame:
    """The trees of (vec_id, embedding), written to the shared folder."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        held: dict[int, int] = {}

        def tree(dim: int) -> pa.RecordBatch:
            nonlocal number
            parts = waiting.pop(dim)
            held[dim] = 0
            ids, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order, nodes = build_tree(x)
            ids, x = ids[order], x[order]
            low, high = (np.stack([f(x[a:b], 0) for a, b in nodes[:, :2].tolist()]) for f in (np.min, np.max))
            number += 1
            row = [number, dim, *(a.tobytes() for a in (ids, x, nodes, low, high))]
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=["shard", "dim", "ids", "vectors", "nodes", "low", "high"])

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = whole_numbers(scale, lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            sizes = np.diff(at)
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                x = flat[at[rows][:, None] + np.arange(dim)[None, :]].reshape(len(rows), dim)
                for k in range(0, len(rows), shard):
                    waiting.setdefault(dim, []).append((ids[rows[k : k + shard]].astype(np.int64), x[k : k + shard]))
                    held[dim] = held.get(dim, 0) + len(rows[k : k + shard])
                    if held[dim] >= shard:
                        yield tree(dim)
        for dim in list(waiting):
            yield tree(dim)

    return materialize(vectors.mapInArrow(build, _SHARD_SCHEMA), "kd-shards")


def scores_of(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The inner products of two tables of whole numbers (as doubles), exact, and held within a long."""
    with np.errstate(over="ignore"):
        most = max(np.abs(q).max(initial=0), 1) * max(np.abs(x).max(initial=0), 1) * max(x.shape[1], 1)
    if most < _DOUBLE:
        return (q @ x.T).astype(np.int64)
    if most < _LONG:
        return q.astype(np.int64) @ x.T.astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(q) @ whole(x.T), _LEAST, _MOST).astype(np.int64)


class Best:
    """The k best scores of each query of one dimension so far, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, kth: np.ndarray | None = None):
        self.ids, self.x, self.k = ids, x, k
        self.up, self.down = np.maximum(x, 0), np.minimum(x, 0)
        self.score = np.full((len(ids), k), _LEAST, np.int64)
        self.found = np.full((len(ids), k), _NONE, np.int64)
        self.floor = np.full(len(ids), _LEAST, np.int64) if kth is None else kth
        #: Leaves scored for queries, and leaves there were.
        self.visited = self.leaves = 0

    def kth(self) -> np.ndarray:
        return np.maximum(self.score[:, -1], self.floor)

    def leaf(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        scores = scores_of(self.x[rows], x)
        other = ids[None, :] != self.ids[rows][:, None]
        hit = ((scores >= self.kth()[rows][:, None]) & other).any(1)
        if not hit.any():
            return
        rows, scores = rows[hit], scores[hit]
        found = np.where(other[hit], ids, _NONE)  # an absent candidate sorts behind all others
        all_scores = np.concatenate([self.score[rows], np.where(found == _NONE, _LEAST, scores)], 1)
        all_ids = np.concatenate([self.found[rows], found], 1)
        order = np.lexsort((all_ids, ~all_scores), axis=1)[:, : self.k]
        self.score[rows] = np.take_along_axis(all_scores, order, 1)
        self.found[rows] = np.take_along_axis(all_ids, order, 1)

    def shard(self, ids: np.ndarray, x: np.ndarray, nodes: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        with np.errstate(over="ignore", invalid="ignore"):
            bound = self.up @ high.T + self.down @ low.T
            # what rounding may have taken off: of the sum, and of the kth score as a double
            bound += (x.shape[1] + 4) * 2.0**-52 * (self.up @ np.abs(high).T - self.down @ np.abs(low).T) + 1e-9
        bound[~np.isfinite(bound)] = np.inf  # a sum that passed the doubles bounds nothing
        left, right = nodes[:, 2].tolist(), nodes[:, 3].tolist()
        queues = {q: [(-b, 0)] for q, b in enumerate(bound[:, 0].tolist())}
        self.leaves += len(queues) * (len(nodes) + 1) // 2
        while queues:
            kth = self.kth().astype(np.float64)
            kth -= np.abs(kth) * 2.0**-52
            wanted: dict[int, list[int]] = {}
            for q, queue in list(queues.items()):
                least, own = kth[q], bound[q]
                while queue:
                    b, node = heapq.heappop(queue)
                    if -b < least:
                        queue.clear()
                    elif left[node] < 0:
                        wanted.setdefault(node, []).append(q)
                        break
                    else:
                        for child in (left[node], right[node]):
                            if own[child] >= least:
                                heapq.heappush(queue, (-own[child], child))
                if not queue:
                    del queues[q]
            for node, rows in wanted.items():
                a, b = nodes[node, :2]
                self.visited += len(rows)
                self.leaf(np.array(rows), ids[a:b], x[a:b])


def _search(queries: dict[int, tuple], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {dim: Best(*q[:2], k, q[2]) for dim, q in queries.value.items()}
        for batch in batches:
            for r in range(batch.num_rows):
                dim, ids, x, nodes, low, high = (batch.column(c)[r].as_py() for c in range(1, 7))
                if dim in best:
                    shape = np.frombuffer(nodes, np.int64).reshape(-1, 4)
                    shaped = [np.frombuffer(b).reshape(-1, dim) if dim else np.zeros((n, 0)) for b, n in ((x, len(ids) // 8), (low, len(shape)), (high, len(shape)))]
                    best[dim].shard(np.frombuffer(ids, np.int64), shaped[0], shape, *shaped[1:])
        for b in best.values():
            there = b.found < _NONE
            query = np.broadcast_to(b.ids[:, None], there.shape)[there]
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(b.found[there]), pa.array(b.score[there])], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest integer inner products of each query with other rows.

    ``is_query`` is a condition on ``vec_id``. Ties go to the smaller id. Vectors that are null, hold a null or a
    non-finite component, or whose id is null take no part. Vectors of other lengths than the query's are no candidates.
    Repeated rows are candidates each; a query id that repeats is asked once, with the smallest of its vectors.
    Fewer than k candidates give fewer rows, empty tables none. Scores are exact; one beyond a long counts as the nearest long. A component whose
    product with ``scale`` passes the doubles counts as the largest double of its sign.
    An id of 2^63 - 1 takes no part as a candidate.
    A block of queries, at most about ``block`` vectors, is what the driver holds and broadcasts at a time.
    """
    spark = vectors.sparkSession
    known = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    known = known.where(F.col("vec_id").isNotNull() & F.coalesce(whole, F.lit(False)))
    shards = build_shards(known, scale)
    asked = materialize(known.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "kd-queries")
    blocks = -(-asked.count() // block)
    pilot = shards.groupBy("dim").agg(F.min("shard").alias("shard")).limit(1000).collect()  # the first shard of each length of vector
    results = []
    for number in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).toArrow()
        ids, lists = rows.column(0).to_numpy(), rows.column(1).to_pylist()
        queries = {}
        for dim in {len(v) for v in lists}:
            own = [i for i, v in enumerate(lists) if len(v) == dim]
            x = whole_numbers(scale, np.array([lists[i] for i in own], np.float64).reshape(len(own), dim))
            queries[dim] = (ids[own].astype(np.int64), x, None)
        first = shards.where(F.col("shard").isin([r["shard"] for r in pilot])).mapInArrow(_search(spark.sparkContext.broadcast(queries), k), "query_id long, vec_id long, score long")
        kth = dict(first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k).select("query_id", "kth").toLocalIterator())
        for dim, (q, x, _) in queries.items():
            queries[dim] = (q, x, np.array([kth.get(i, _LEAST) for i in q.tolist()], np.int64))
        results.append(shards.mapInArrow(_search(spark.sparkContext.broadcast(queries), k), "query_id long, vec_id long, score long"))
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = results[0]
    for r in results[1:]:
        found = found.unionByName(r)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
