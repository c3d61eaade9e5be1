"""Exact search for the highest inner products by ball trees, one tree a shard.

Rows are dealt into shards by a hash of their id, queries into blocks; a task joins one shard with
one block, so neither side of a task grows with the table. In a shard a ball tree bounds the
product of a query with all rows of a node: ``q . centre + |q| * radius``. A query visits leaves by
falling bound and stops where the bound falls below its current k-th score. Queries that are at the
same leaf are multiplied with it together.

The k-th score is shared: each query first searches the shard that it is in itself, and the k-th score found
there is the bound it takes to all other shards, so those return few rows or none.

Components are integers, products are exact: in double precision as long as they stay below 2**53,
else in 64-bit integers.

Defined cases: null vectors, and those with a null or non-finite component, take no part, nor do
rows without an id; an id names one row, so a repeated row counts once; only vectors of one length are
compared; ties go to the smaller id; a query with fewer candidates than k has fewer rows; an empty
table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .textkit import ship

TOP = 20
SHARD = 4096
BLOCK = 4096
LEAF = 64
FOUND = "query_id long, vec_id long, score long"
NAMES = ["query_id", "vec_id", "score"]


class BallTree:
    """Nodes over rows in an order that keeps every node's rows together."""

    def __init__(self, rows: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(rows))
        self.bounds: list[tuple[int, int]] = []
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.parents: list[int] = []
        self.leaves: list[int] = []
        waiting = [(0, len(rows), -1)] if len(rows) else []
        while waiting:
            a, b, parent = waiting.pop()
            own = rows[self.order[a:b]]
            centre = own.mean(axis=0)
            distance = np.sqrt(((own - centre) ** 2).sum(axis=1))
            node = len(self.bounds)
            self.bounds.append((a, b))
            self.centres.append(centre)
            self.radii.append(float(distance.max()))
            self.parents.append(parent)
            if b - a <= leaf or not distance.max():
                # Equal rows need no further split, however many they are.
                self.leaves += [node]
                continue
            # Along the line between two far rows, halves are as compact as one split makes them.
            far = own[distance.argmax()]
            other = own[((own - far) ** 2).sum(axis=1).argmax()]
            half = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(own @ (other - far), half)]
            waiting += [(a, a + half, node), (a + half, b, node)]

    def upper(self, queries: np.ndarray) -> np.ndarray:
        """For each query and leaf, a bound on the products with the leaf's rows."""
        length = np.sqrt((queries**2).sum(axis=1))
        bound = queries @ np.array(self.centres).T + length[:, None] * np.array(self.radii)
        bound += 1e-6 + 1e-9 * np.abs(bound)
        for node, parent in enumerate(self.parents):
            if parent >= 0:
                np.minimum(bound[:, node], bound[:, parent], out=bound[:, node])
        return bound[:, self.leaves]


def search(ids, rows, query_ids, queries, floor, top: int):
    """Of each query, the ``top`` best rows that score ``floor`` or more: query, row and score."""
    if not len(ids) or not len(query_ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    largest = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0))
    exact = np.float64 if largest * max(rows.shape[1], 1) < 2**53 else np.int64
    tree = BallTree(rows.astype(np.float64))
    bound = tree.upper(queries.astype(np.float64))
    order = np.argsort(-bound, axis=1, kind="stable")
    rows, ids, queries = rows.astype(exact)[tree.order], ids[tree.order], queries.astype(exact)
    lowest = -(2**63) + 1
    best = np.full((len(query_ids), top), lowest, np.int64)
    who = np.full((len(query_ids), top), np.iinfo(np.int64).max, np.int64)
    current = floor.copy()
    for turn in range(order.shape[1]):
        leaf = order[:, turn]
        active = np.flatnonzero(bound[np.arange(len(leaf)), leaf] >= current)
        if not len(active):
            break
        active = active[np.argsort(leaf[active], kind="stable")]
        at = leaf[active]
        edges = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        for a, b in zip(edges, [*edges[1:], len(at)]):
            mine = active[a:b]
            begin, end = tree.bounds[tree.leaves[at[a]]]
            for start in range(begin, end, 4 * LEAF):
                part = slice(start, min(end, start + 4 * LEAF))
                scores = (queries[mine] @ rows[part].T).astype(np.int64)
                scores[query_ids[mine][:, None] == ids[part]] = lowest
                better = scores.max(axis=1) >= np.maximum(current[mine], lowest + 1)
                if not better.any():
                    continue
                into = mine[better]
                s = np.concatenate([best[into], scores[better]], axis=1)
                w = np.concatenate(
                    [who[into], np.broadcast_to(ids[part], (len(into), part.stop - part.start))], axis=1
                )
                first = np.lexsort((w, -s), axis=1)[:, :top]
                best[into] = np.take_along_axis(s, first, 1)
                who[into] = np.take_along_axis(w, first, 1)
                current[into] = np.maximum(current[into], best[into, -1])
    good = (best > lowest) & (best >= floor[:, None])
    return np.repeat(query_ids, good.sum(axis=1)), who[good], best[good]


def vectors(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def searcher(top: int):
    def run(items: pa.Table, asked: pa.Table) -> pa.Table:
        found = search(
            items.column("vec_id").to_numpy(),
            vectors(items, "v"),
            asked.column("query_id").to_numpy(),
            vectors(asked, "w"),
            asked.column("floor").to_numpy(),
            top,
        )
        return pa.table([pa.array(x) for x in found], names=NAMES)

    return run


def ranked(found: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def top_products(
    items: DataFrame, queries: DataFrame, top: int = TOP, shard: int = SHARD, block: int = BLOCK
) -> DataFrame:
    """``query_id, rank, vec_id, score``: both frames have ``vec_id`` and ``v``, an array of longs.

    A query's own id is not among its candidates.
    """
    ship(items.sparkSession)
    shards = max(1, -(-items.count() // shard))
    blocks = max(1, -(-queries.count() // block))
    key = ["dim", "shard", "block"]

    def dealt(name: str, salt: int, n: int):
        return F.pmod(F.xxhash64(name, F.lit(salt)), F.lit(n)).cast("int")

    def all_of(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    stored = items.select(
        "vec_id", "v", F.size("v").alias("dim"), dealt("vec_id", 0, shards).alias("shard")
    ).select("*", all_of(blocks).alias("block"))
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("w")).select(
        "query_id",
        "w",
        F.size("w").alias("dim"),
        dealt("query_id", 0, shards).alias("shard"),
        dealt("query_id", 1, blocks).alias("block"),
    )
    lowest = F.lit(-(2**63) + 1).cast("long")
    first = durable(
        stored.groupBy(key)
        .cogroup(asked.withColumn("floor", lowest).groupBy(key))
        .applyInArrow(searcher(top), FOUND),
        "first",
    )
    kth = first.groupBy("query_id").agg(
        F.when(F.count("*") >= top, F.min("score")).otherwise(lowest).alias("floor")
    )
    travelling = (
        asked.join(kth, "query_id", "left")
        .withColumn("floor", F.coalesce("floor", lowest))
        .withColumnRenamed("shard", "home")
        .select("*", all_of(shards).alias("shard"))
        .filter("shard <> home")
    )
    others = (
        stored.groupBy(key)
        .cogroup(travelling.groupBy(key))
        .applyInArrow(searcher(top), FOUND)
    )
    return ranked(first.unionByName(others), top).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def op8_ball_tree(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    whole = table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    v = F.transform("embedding", lambda x: F.floor(64 * x.cast("double"))).alias("v")
    items = durable(whole.select("vec_id", v).dropDuplicates(["vec_id"]), "vectors")
    return top_products(items, items.filter("vec_id % 20 = 0"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, vec_id, score,
    row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
