"""Exact search for the largest inner products, with a KD-tree in each shard.

Vectors are dealt to shards by a hash of their id, queries to blocks. A shard splits its vectors
at the median of the widest dimension until leaves are small, and keeps the tight bounding box of
each leaf. For a query q, no vector in a box [lo, hi] scores more than the sum of the larger of
q*lo and q*hi over the dimensions. Each query visits leaves in the order of their bounds until no
bound reaches its kth score; queries that visit the same leaf do so together. Queries first search
the shard they lie in; the kth score found there goes with them to all other shards.

A pair of a shard and a block of queries is a group of bounded size; a shard is sent to each block
of queries, and each query to every shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import checkpointed, column

SHARD = 16_384  # vectors of a shard, about
BLOCK = 4_096  # queries of a block, about
LEAF = 256
_FOUND = "query_id long, score long, vec_id long"


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v``, floor(256 x) of every component as longs. Vectors that are NULL, empty, or
    hold a NULL or non-finite component are left out; so are rows without an id."""
    v = F.transform(column(embedding).cast("array<double>"), lambda x: F.floor(x * 256))
    finite = F.forall(
        column(embedding).cast("array<double>"),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    rows = vectors.filter(column(vec_id).isNotNull() & finite & (F.size(column(embedding)) > 0))
    return rows.select(column(vec_id).cast("long").alias("vec_id"), v.alias("v"))


def best(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The k highest scores of each query among all vectors but its own id: ``query_id``, ``rank``,
    ``vec_id``, ``score``. Both inputs have ``vec_id`` and ``v``; equal scores go to the smaller id;
    vectors of another length than the query's are no candidates. Of repeated ids, each row counts
    as a candidate. A query id with several vectors is searched with each of them and has the k
    highest of all these scores; equal vectors of an id are one query."""
    vectors = checkpointed(vectors)
    shards = max(1, -(-vectors.count() // SHARD))
    blocks = max(1, -(-queries.count() // BLOCK))
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    of = vectors.withColumn("shard", own(shards)).withColumn("n", F.size("v"))
    asked = (
        queries.select("vec_id", "v").distinct()
        .withColumn("block", F.pmod(F.xxhash64("vec_id", "v", F.lit(1)), F.lit(blocks)).cast("int"))
        .withColumn("n", F.size("v"))
        .withColumn("home", own(shards))
        .select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "block", "n", "home")
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    sent = of.select("vec_id", "v", "shard", "n", every.alias("block"))
    key = ["shard", "block", "n"]

    def searched(rows: DataFrame) -> DataFrame:
        return (
            sent.groupBy(*key).cogroup(rows.groupBy(*key))
            .applyInArrow(lambda v, q: _search(v, q, k), _FOUND)
        )

    at_home = asked.select(
        F.col("home").alias("shard"), "block", "n", "query_id", "q", F.lit(None).cast("long").alias("kth")
    )
    found = checkpointed(searched(at_home))
    kth = (
        found.groupBy("query_id")
        .agg(F.count("*").alias("c"), F.min("score").alias("least"))
        .select("query_id", F.when(F.col("c") >= k, F.col("least")).alias("kth"))
    )
    if shards > 1:
        away = (
            asked.join(kth, "query_id", "left")
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
            .filter("shard <> home")
            .select(*key, "query_id", "q", "kth")
        )
        found = found.union(searched(away))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _leaves(points: np.ndarray) -> list[np.ndarray]:
    """The points of each leaf: median splits of the dimension in which a node is widest."""
    done, open_ = [], [np.arange(len(points))]
    while open_:
        rows = open_.pop()
        if len(rows) <= LEAF:
            done.append(rows)
            continue
        here = points[rows]
        axis = np.argmax(here.max(axis=0) - here.min(axis=0))
        order = np.argpartition(here[:, axis], len(rows) // 2)
        open_ += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return done


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    flat = table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(table), -1)


def _search(vectors: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    if not len(vectors) or not len(queries):
        return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "score", "vec_id")})
    points, q = _matrix(vectors, "v"), _matrix(queries, "q")
    largest = float(np.abs(points).max()) * float(np.abs(q).max()) * points.shape[1]
    kind = np.float64 if largest < 2**53 else np.int64  # both exact; the former is much faster
    points, q = points.astype(kind), q.astype(kind)
    ids = vectors.column("vec_id").to_numpy()
    asking = queries.column("query_id").to_numpy()
    leaves = _leaves(points)
    low = np.stack([points[rows].min(axis=0) for rows in leaves])
    high = np.stack([points[rows].max(axis=0) for rows in leaves])
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    nothing = -np.inf if kind is np.float64 else np.iinfo(np.int64).min + 1  # can be negated
    scores = np.full((len(q), k), nothing, kind)
    best_ids = np.full((len(q), k), np.iinfo(np.int64).max)
    given = np.array([nothing if x is None else x for x in queries.column("kth").to_pylist()], kind)
    order = np.argsort(-bounds, axis=1, kind="stable")
    rows = np.arange(len(q))
    for step in range(len(leaves)):
        leaf = order[rows, step]
        kth = np.maximum(given[rows], scores[rows, -1])
        going = bounds[rows, leaf] >= kth
        rows, leaf, kth = rows[going], leaf[going], kth[going]
        if not len(rows):
            break
        for one in np.unique(leaf):
            at = rows[leaf == one]
            members = leaves[one]
            s = q[at] @ points[members].T
            own = asking[at][:, None] == ids[members][None, :]
            s[own] = nothing
            hit = (s >= kth[leaf == one][:, None]) & (s > nothing)
            better = np.flatnonzero(hit.any(axis=1))
            if not len(better):
                continue
            at, s = at[better], s[better]
            all_scores = np.concatenate([scores[at], s], axis=1)
            all_ids = np.concatenate(
                [best_ids[at], np.broadcast_to(ids[members], s.shape)], axis=1
            )
            all_ids[all_scores == nothing] = np.iinfo(np.int64).max
            first = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            scores[at] = np.take_along_axis(all_scores, first, axis=1)
            best_ids[at] = np.take_along_axis(all_ids, first, axis=1)
    real = scores > nothing
    who = np.broadcast_to(asking[:, None], scores.shape)[real]
    return pa.table(
        {
            "query_id": pa.array(who, pa.int64()),
            "score": pa.array(scores[real].astype(np.int64), pa.int64()),
            "vec_id": pa.array(best_ids[real], pa.int64()),
        }
    )
