"""Hard negatives by vertical scans: dimensions one after the other, each anchor in its own order.

Rows lie in shards, one array for each dimension. An anchor reads the dimensions by falling size of its
own component, ``STEP`` at a time, and adds up products for the rows that its bitmap still holds. What the
dimensions not yet read can add to a row is bounded by the least and the largest value that the shard
has in each of them. A row goes as soon as its bounds leave the anchor's window of scores, or its upper bound falls
below the k-th lower bound of rows that are sure to be inside. When the last dimension is read, scores
are exact.

First every anchor looks for its positives, the best rows of its own label; then for negatives, in one window
for each of its positives. A window is a pair of whole numbers, so its ends are exact. The scan of one anchor
serves all its windows: the bitmap holds the rows that any of them still needs.

How it runs. Rows are dealt into shards by a hash of their id, anchors into blocks; a task joins one shard
with one block, so neither side of a task grows with the table, and no label has to be in one place. An
anchor first visits the shard that it is in itself. The k-th score found there is the floor that it
takes to the others, so those return few rows or none.

Sums are whole numbers, in 64 bits where a shard's and a block's largest values allow it, else in Python's own
integers. A score that does not fit 64 bits is outside every window.

Defined cases: rows without an id, a label or a vector, or with a null or non-finite component take no
part; an id names one row, so a repeated id counts once, with the row that comes first by its values; only vectors
of one length are compared; ties go to the smaller id; an anchor without positives has no rows, and so has a positive whose
window is empty, as all of a negative score are; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .textkit import ship

SHARD = 16_384
BLOCK = 1024
STEP = 8
LOWEST = -(2**63) + 1
HIGHEST = 2**63 - 1
FOUND = "anchor_id long, slot int, vec_id long, score long"
NAMES = ["anchor_id", "slot", "vec_id", "score"]


def kth(values: np.ndarray, k: int):
    """The k-th largest, or None where there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def scan(columns, low, high, anchor, rows, windows, floors, k: int, step: int = STEP):
    """Rows that are among the ``k`` best of a window, and their scores.

    ``columns[d]`` are all rows' values of dimension d, ``low`` and ``high`` their ends, ``rows`` the
    candidates; ``windows`` are pairs of least and largest scores, ``floors`` a score for each
    below which nothing is wanted. Returns for each window its rows, best first by score alone;
    rows that tie with the last are all returned.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = np.stack([anchor * low, anchor * high])
    least, most = ends.min(axis=0)[order], ends.max(axis=0)[order]
    # What is still to come after so many dimensions.
    rest_least = np.append(np.cumsum(least[::-1])[::-1], 0)
    rest_most = np.append(np.cumsum(most[::-1])[::-1], 0)
    bottoms = [max(w[0], f) for w, f in zip(windows, floors)]
    sums = np.zeros(len(rows), columns.dtype)
    for at in range(0, len(order), step):
        read = order[at : at + step]
        for d in read:
            sums += columns[d][rows] * anchor[d]
        done = min(at + step, len(order))
        lower, upper = sums + rest_least[done], sums + rest_most[done]
        needed = np.zeros(len(rows), bool)
        for i, (_, top) in enumerate(windows):
            inside = lower[(lower >= bottoms[i]) & (upper <= top)]
            sure = kth(inside, k)
            if sure is not None and sure > bottoms[i]:
                bottoms[i] = sure
            needed |= (upper >= bottoms[i]) & (lower <= top)
        if not needed.all():
            rows, sums = rows[needed], sums[needed]
        if not len(rows):
            break
    found = []
    for bottom, (_, top) in zip(bottoms, windows):
        mine = np.flatnonzero((sums >= bottom) & (sums <= top)) if len(rows) else np.zeros(0, int)
        mine = mine[np.argsort(-sums[mine], kind="stable")]
        found.append((rows[mine], sums[mine]))
    return found


def matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def scanner(k: int, same_label: bool):
    """Scans of one shard for the anchors of one block, each with its windows."""

    def run(items: pa.Table, asked: pa.Table) -> pa.Table:
        anchors, slots, ids, scores = [], [], [], []
        if items.num_rows and asked.num_rows:
            rows, queries = matrix(items, "v"), matrix(asked, "w")
            size = np.abs(rows.astype(float)).max(initial=0) * np.abs(queries.astype(float)).max(initial=0)
            if size * max(rows.shape[1], 1) >= 2**62:
                rows, queries = rows.astype(object), queries.astype(object)
            columns = np.ascontiguousarray(rows.T)
            low, high = columns.min(axis=1), columns.max(axis=1)
            labels, own = items.column("label").to_numpy(), items.column("vec_id").to_numpy()
            by_label = {x: np.flatnonzero((labels == x) == same_label) for x in np.unique(labels)}
            every = np.arange(len(own))
            windows, slot = asked.column("windows").to_pylist(), asked.column("slots").to_pylist()
            names, label = asked.column("anchor_id").to_numpy(), asked.column("own").to_numpy()
            for i in range(len(names)):
                rows_of = by_label.get(label[i], every[:0] if same_label else every)
                if same_label:
                    rows_of = rows_of[own[rows_of] != names[i]]
                if not len(rows_of):
                    continue
                pairs = [(w["least"], w["most"]) for w in windows[i]]
                floors = [w["floor"] for w in windows[i]]
                for s, (found, score) in zip(
                    slot[i], scan(columns, low, high, queries[i], rows_of, pairs, floors, k)
                ):
                    if len(found) > k:  # of those that tie with the last, the smallest ids
                        first = np.lexsort((own[found], -score))[:k]
                        found, score = found[first], score[first]
                    anchors += [names[i]] * len(found)
                    slots += [s] * len(found)
                    ids += own[found].tolist()
                    scores += score.tolist()
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.table(
            [pa.array(x, kind) for x, kind in zip((anchors, slots, ids, scores), kinds)], names=NAMES
        )

    return run


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.filter(F.col("rank") <= k)


def windows_search(
    items: DataFrame, asked: DataFrame, k: int, same_label: bool, shard: int, block: int
) -> DataFrame:
    """``anchor_id, slot, vec_id, score, rank``: the ``k`` best rows of each window of each anchor.

    ``items`` has ``vec_id, label, v``; ``asked`` has ``anchor_id, own`` (its label), ``w`` and
    ``windows``, an array of ``slot, least, most``.
    """
    shards = max(1, -(-items.count() // shard))
    blocks = max(1, -(-asked.count() // block))
    key = ["dim", "shard", "block"]

    def dealt(name: str, salt: int, n: int):
        return F.pmod(F.xxhash64(name, F.lit(salt)), F.lit(n)).cast("int")

    def all_of(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    stored = items.select(
        "vec_id", "label", "v", F.size("v").alias("dim"), dealt("vec_id", 0, shards).alias("shard")
    ).select("*", all_of(blocks).alias("block"))
    blocked = asked.select(
        "anchor_id",
        "own",
        "w",
        F.size("w").alias("dim"),
        dealt("anchor_id", 0, shards).alias("home"),
        dealt("anchor_id", 1, blocks).alias("block"),
        "windows",
    )
    fields = [F.col(f"x.{n}") for n in ("slot", "least", "most")]
    open_ = blocked.select("anchor_id", F.explode("windows").alias("x")).select("anchor_id", *fields)

    def ask(rows: DataFrame) -> DataFrame:
        return rows.withColumn("slots", F.expr("transform(windows, x -> x.slot)")).withColumn(
            "windows",
            F.expr("transform(windows, x -> struct(x.least AS least, x.most AS most, x.floor AS floor))"),
        )

    def searched(rows: DataFrame) -> DataFrame:
        return (
            stored.groupBy(key)
            .cogroup(ask(rows).groupBy(key))
            .applyInArrow(scanner(k, same_label), FOUND)
        )

    none = F.lit(LOWEST).cast("long")
    fresh = F.transform(
        "windows", lambda x: F.struct(x.slot.alias("slot"), x.least.alias("least"), x.most.alias("most"), none.alias("floor"))
    )
    first = durable(searched(blocked.withColumn("windows", fresh).withColumn("shard", F.col("home"))), "bond")
    floors = first.groupBy("anchor_id", "slot").agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(none).alias("floor")
    )
    told = (
        open_.join(floors, ["anchor_id", "slot"], "left")
        .groupBy("anchor_id")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("slot", "least", "most", F.coalesce("floor", none).alias("floor"))
                )
            ).alias("windows")
        )
    )
    travelling = (
        blocked.drop("windows")
        .join(told, "anchor_id")
        .select("*", all_of(shards).alias("shard"))
        .filter("shard <> home")
    )
    return best(first.unionByName(searched(travelling)), k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor,
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id``, ``label`` and ``v``, an array of longs. A negative's score is between
    ``least`` and ``most`` per cent of the positive's.
    """
    ship(vectors.sparkSession)
    items = durable(
        vectors.select("vec_id", "label", "v")
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "v")).alias("first"))
        .select("vec_id", "first.label", "first.v"),
        "vectors",
    )
    anchors = items.filter(is_anchor).select(
        F.col("vec_id").alias("anchor_id"), F.col("label").alias("own"), F.col("v").alias("w")
    )
    everything = F.array(
        F.struct(
            F.lit(0).alias("slot"),
            F.lit(LOWEST).cast("long").alias("least"),
            F.lit(HIGHEST).cast("long").alias("most"),
        )
    )
    near = durable(
        windows_search(
            items, anchors.withColumn("windows", everything), positives, True, shard, block
        ).select("anchor_id", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), "score"),
        "positives",
    )
    # 100 * score >= least * positive, and <= most * positive, in whole numbers; nothing fits a negative one.
    score = F.col("score").cast("decimal(38,0)")
    lower = F.ceil(score * least / 100).cast("long")
    upper = F.floor(score * most / 100).cast("long")
    windows = (
        near.filter("score >= 0")
        .groupBy("anchor_id")
        .agg(F.collect_list(F.struct("slot", lower.alias("least"), upper.alias("most"))).alias("windows"))
    )
    far = windows_search(
        items, anchors.join(windows, "anchor_id"), negatives, False, shard, block
    ).select(
        "anchor_id", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return far.join(near, ["anchor_id", "slot"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        "negative_id",
        F.col("score").alias("positive_score"),
        "negative_score",
    )


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    whole = table.dropna(subset=["vec_id", "label", "embedding"]).filter(finite)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    v = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    vectors = whole.select("vec_id", label.cast("long").alias("label"), v.alias("v"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_dot_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n
  FROM scored WHERE same
), negatives AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score,
    s.score AS negative_score,
    row_number() OVER (
      PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
  WHERE p.n <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 10
"""
