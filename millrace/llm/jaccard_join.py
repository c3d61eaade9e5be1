r"""Exact Jaccard join of word n-gram sets, size-aware: small sets by subsets, large ones by lists.

Two sets of s and t elements link when they share at least ``o(s, t)`` elements, the least integer
with ``o / (s + t - o)`` at or over the threshold.

Light sets, up to a boundary size: each set enumerates its subsets of exactly ``o(s, t)`` elements
for every partner size t. Two sets with a common subset link, and none that link are missed, so no
candidate has to be verified. Heavy sets, over the boundary: an inverted list for each of a set's
rarest elements; two sets that link meet in the list of the first element they share, where
positions bound how many more they can share. The boundary is where the rows made by both together
are fewest, from the histogram of small sizes.

Rarity comes from a counting sketch of fixed size over all elements of all texts. It only fixes one
global order, so its errors cost time, never results.

What keeps groups of copies cheap: equal sets are one set from the start. Every list is first
compared with one hub only, the member with the fewest rarer elements. Members that turn out to be
connected by then need no comparison with each other, and only pairs of different components that
still can link are compared in the second pass. Elements that a third of all texts share come last
in the order and so stand in no list but those of texts that consist of little else. An element can
hold at most one of the ``0.15 s`` postings of each set.

Nothing is collected but the histogram of sizes below 64 and the sketch (1 MB). Hashes have 64 bits
for elements and 128 for whole sets. Stages are deleted once what follows from them is written; only
the rows returned stay.

Defined cases: a null or empty text has an empty set, links with nothing and is its own component;
a text with fewer words than n has one element, its whole sequence; repeated rows share a
component; an id names one text; other columns take no part; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, durable
from .components import components
from .textkit import (
    U,
    chunks,
    filled,
    mixed,
    rested,
    ship,
    text_bytes,
    window_hashes,
    words_of,
)

SIZE = 4
PER_CENT = 85
SKETCH_BITS = 18
SLICES = 16
MOST_LIGHT = 24
HISTOGRAM = 64
TWIST = U(0xC2B2AE3D27D4EB4F)


def overlap(s: int, t: int, per_cent: int) -> int:
    """Fewest common elements with which sets of s and t elements link."""
    return -(-per_cent * (s + t) // (100 + per_cent))


def least_partner(s: int, per_cent: int) -> int:
    return -(-per_cent * s // 100)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's set begins, and the sets' elements, ascending within each."""
    words = words_of(data, offsets, lower=True)
    at, hashes = window_hashes(words, size)
    text = words.text[at]
    for short in range(1, size):
        # Only texts of just so many words: their whole sequence is the one element.
        begin, whole = window_hashes(words, short)
        alone = words.counts[words.text[begin]] == short
        if alone.any():
            text = np.concatenate([text, words.text[begin[alone]]])
            hashes = np.concatenate([hashes, whole[alone]])
    order = np.argsort(text, kind="stable")
    text, hashes = text[order], hashes[order]
    edges = np.searchsorted(text, np.arange(len(offsets)))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        hashes[a:b].sort()
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return np.r_[0, np.cumsum(fresh)][edges], hashes[fresh]


def sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[U(0), np.cumsum(values, dtype=U)][edges])


PROFILES = pa.schema(
    [
        ("kind", pa.int32()),
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("h1", pa.int64()),
        ("h2", pa.int64()),
        ("blob", pa.binary()),
    ]
)
PROFILE_ROWS = "kind int, doc_id long, n long, h1 long, h2 long, blob binary"


def profiles(size: int):
    """Texts -> size and hash of each set, small sets whole; and each task's part of the sketch."""

    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            column = filled(batch.column("text"))
            for at, stop in chunks(column):
                edges, elements = shingle_sets(*text_bytes(column[at:stop]), size)
                n = np.diff(edges)
                sketch += np.bincount(
                    (elements >> U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch)
                )
                blobs = [
                    elements[edges[i] : edges[i + 1]].tobytes() if 0 < n[i] <= MOST_LIGHT else None
                    for i in range(len(n))
                ]
                yield pa.record_batch(
                    [
                        pa.array(np.zeros(len(n), np.int32)),
                        batch.column("doc_id")[at:stop],
                        pa.array(n.astype(np.int64)),
                        pa.array(sums(mixed(elements), edges).view(np.int64)),
                        pa.array(sums(mixed(elements ^ TWIST), edges).view(np.int64)),
                        pa.array(blobs, pa.binary()),
                    ],
                    schema=PROFILES,
                )
        parts = sketch.astype(np.uint32).reshape(SLICES, -1)
        yield pa.record_batch(
            [
                pa.array(np.ones(SLICES, np.int32)),
                pa.array(np.arange(SLICES)),
                *[pa.array(np.zeros(SLICES, np.int64))] * 3,
                pa.array([p.tobytes() for p in parts], pa.binary()),
            ],
            schema=PROFILES,
        )

    return run


def add_slices(table: pa.Table) -> pa.Table:
    """One slice of the sketch from all tasks."""
    total = 0
    for blob in table.column("blob").to_pylist():
        total = total + np.frombuffer(blob, np.uint32).astype(np.uint64)
    # Only the order of magnitude is used: sixteenths of a power of two.
    ranks = np.minimum(16 * np.log2(total + 1.0), 1023).astype(np.uint16)
    return pa.table({"slice": table.column("doc_id")[:1], "ranks": pa.array([ranks.tobytes()])})


def boundary(histogram: dict[int, int], per_cent: int) -> int:
    """The largest light size for which subsets and postings together are fewest."""

    def subsets(s: int, most: int) -> int:
        return sum(
            comb(s, overlap(s, t, per_cent))
            for t in range(least_partner(s, per_cent), most + 1)
            if least_partner(t, per_cent) <= s
        )

    def cost(most: int) -> int:
        light = sum(n * subsets(s, most) for s, n in histogram.items() if s <= most)
        # A posting is dealt out, counted, and met again in the candidate passes.
        heavy = sum(
            3 * n * (s - least_partner(s, per_cent) + 1)
            for s, n in histogram.items()
            if s >= least_partner(most + 1, per_cent)
        )
        return light + heavy

    return min(range(MOST_LIGHT + 1), key=cost)


def subset_keys(most: int, per_cent: int):
    """Light sets -> a key for each subset that makes a link with a partner of one size."""

    def run(batches):
        for batch in batches:
            keys, sids, sizes, alike = [], [], [], []
            for sid, blob in zip(batch.column("sid").to_pylist(), batch.column("blob").to_pylist()):
                elements = mixed(np.frombuffer(blob, "<u8").astype(U))
                s, whole = len(elements), elements.sum(dtype=U)
                for t in range(least_partner(s, per_cent), most + 1):
                    if least_partner(t, per_cent) > s:
                        break
                    left_out = s - overlap(s, t, per_cent)
                    if left_out < 0 or (s == t and not left_out):
                        continue
                    rest = np.array([whole])
                    if left_out:
                        out = np.array(list(combinations(range(s), left_out)), np.int64)
                        rest = rest - elements[out].sum(axis=1, dtype=U)
                    pair = np.array([min(s, t) * 1000 + max(s, t)], U) * TWIST
                    keys.append(mixed(rest + pair))
                    sids += [sid] * len(rest)
                    sizes += [s] * len(rest)
                    alike += [s == t] * len(rest)
            if keys:
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate(keys).view(np.int64)),
                        pa.array(sids, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(alike, pa.bool_()),
                    ],
                    names=["key", "sid", "n", "alike"],
                )

    return run


def light_edges(sets: DataFrame, most: int, per_cent: int) -> tuple[DataFrame, DataFrame]:
    """Edges that connect the sets of a key, and the stage they are read from.

    A key stands for one pair of sizes.

    Of two different sizes both must be there: then every set of one links with every set of the
    other, and an edge from each set to the first connects just those.
    """
    keys = durable(
        sets.filter(F.col("n") <= most)
        .select("sid", "blob")
        .mapInArrow(subset_keys(most, per_cent), "key long, sid long, n long, alike boolean"),
        "subsets",
    )
    meets = (
        keys.groupBy("key")
        .agg(
            F.min("sid").alias("root"),
            F.max("sid").alias("last"),
            (F.first("alike") | (F.min("n") < F.max("n"))).alias("links"),
        )
        .filter("root <> last AND links")
        .select("key", "root")
    )
    found = (
        keys.join(meets, "key")
        .filter("sid <> root")
        .select(F.col("root").alias("a"), F.col("sid").alias("b"))
    )
    return found, keys


def rare_prefixes(size: int, per_cent: int, least: int, ranks):
    """Texts -> their sets' rarest elements, as many as a link can do without, plus one."""

    def run(batches):
        rank = ranks.value
        for batch in batches:
            column = filled(batch.column("text"))
            for at, stop in chunks(column):
                edges, elements = shingle_sets(*text_bytes(column[at:stop]), size)
                order = (rank[elements >> U(64 - SKETCH_BITS)].astype(U) << U(53)) | (
                    elements >> U(11)
                )
                docs, sizes, blobs = [], [], []
                ids = batch.column("doc_id")[at:stop].to_pylist()
                for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                    n = b - a
                    if n >= max(least, 1):
                        take = n - least_partner(n, per_cent) + 1
                        # Elements ascend, so a stable sort settles equal keys the same everywhere.
                        first = np.argsort(order[a:b], kind="stable")[:take]
                        docs.append(ids[i])
                        sizes.append(n)
                        blobs.append(elements[a:b][first].tobytes())
                yield pa.record_batch(
                    [
                        pa.array(docs, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(blobs, pa.binary()),
                    ],
                    names=["sid", "n", "blob"],
                )

    return run


def postings(batches):
    for batch in batches:
        blobs = batch.column("blob").to_pylist()
        elements = np.frombuffer(b"".join(blobs), "<i8")
        lengths = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 8
        ends = np.cumsum(lengths)
        yield pa.record_batch(
            [
                pa.array(elements),
                pa.array(np.repeat(batch.column("sid").to_numpy(), lengths)),
                pa.array(np.repeat(batch.column("n").to_numpy(), lengths).astype(np.int32)),
                pa.array((np.arange(len(elements)) - np.repeat(ends - lengths, lengths)).astype(np.int32)),
            ],
            names=["token", "sid", "n", "pos"],
        )


def can_link(n, pos, m, at, per_cent: int):
    """Whether sets of n and m elements that meet first at these positions can link."""
    need = F.ceil(F.lit(per_cent) * (n + m) / F.lit(100 + per_cent))
    return (100 * F.least(n, m) >= per_cent * F.greatest(n, m)) & (
        F.least(n - pos, m - at) >= need
    )


def verified(pairs: DataFrame, texts: DataFrame, size: int, per_cent: int) -> DataFrame:
    """Of pairs ``a, b``, those whose sets link."""

    def run(batches):
        for batch in batches:
            sides = []
            for name in ("x", "y"):
                column = filled(batch.column(name))
                made = []
                for at, stop in chunks(column):
                    edges, elements = shingle_sets(*text_bytes(column[at:stop]), size)
                    made += np.split(elements, edges[1:-1])
                sides.append(made)
            good = []
            for x, y in zip(*sides):
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= per_cent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    side = lambda id_, text: texts.select(
        F.col("doc_id").alias(id_), F.col("text").alias(text)
    )
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select(
        "a", "b", "x", "y"
    ).mapInArrow(rested(run), "a long, b long")


def near_duplicates(
    documents: DataFrame, size: int = SIZE, per_cent: int = PER_CENT, light: int | None = None
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``documents``.

    ``light`` sets the boundary, up to ``MOST_LIGHT``; without it cost decides.
    """
    spark = documents.sparkSession
    ship(spark)
    texts = documents.select("doc_id", "text")
    profile = durable(texts.mapInArrow(rested(profiles(size)), PROFILE_ROWS), "profiles")
    of_docs = profile.filter("kind = 0").drop("kind")
    sets = durable(
        of_docs.filter("n > 0")
        .groupBy("h1", "h2", "n")
        .agg(F.min("doc_id").alias("sid"), F.first("blob").alias("blob")),
        "sets",
    )
    slices = (
        profile.filter("kind = 1")
        .groupBy("doc_id")
        .applyInArrow(add_slices, "slice long, ranks binary")
        .collect()
    )
    by_slice = {r["slice"]: np.frombuffer(bytes(r["ranks"]), np.uint16) for r in slices}
    ranks = spark.sparkContext.broadcast(
        np.concatenate([by_slice[i] for i in range(SLICES)])
        if by_slice
        else np.zeros(1 << SKETCH_BITS, np.uint16)
    )
    histogram = sets.filter(F.col("n") < HISTOGRAM).groupBy("n").count().collect()
    most = light
    if most is None:
        most = boundary({r["n"]: r["count"] for r in histogram}, per_cent)

    rare = texts.mapInArrow(
        rested(rare_prefixes(size, per_cent, least_partner(most + 1, per_cent), ranks)),
        "sid long, n long, blob binary",
    )
    listed = (
        rare.join(sets.select("sid"), "sid", "left_semi")
        .mapInArrow(rested(postings), "token long, sid long, n int, pos int")
        .withColumn("members", F.count("*").over(Window.partitionBy("token")))
        .filter("members > 1")
        .drop("members")
    )
    listed = durable(listed, "lists")
    wanted = listed.select(F.col("sid").alias("doc_id")).distinct()
    own = durable(texts.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")

    hubs = listed.groupBy("token").agg(F.min(F.struct("pos", "sid", "n")).alias("hub"))
    first = (
        listed.join(hubs, "token")
        .filter(
            (F.col("sid") != F.col("hub.sid"))
            & can_link(F.col("n"), F.col("pos"), F.col("hub.n"), F.col("hub.pos"), per_cent)
        )
        .select(
            F.least("sid", "hub.sid").alias("a"), F.greatest("sid", "hub.sid").alias("b")
        )
        .distinct()
    )
    first = durable(first, "pairs")
    light_links, keys = light_edges(sets, most, per_cent)
    edges = durable(verified(first, own, size, per_cent).unionByName(light_links), "links")
    discard(keys)
    labels = components(edges)

    placed = durable(
        listed.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
            "root", F.coalesce("root", "sid")
        ),
        "placed",
    )
    discard(listed, labels)
    mixed_lists = (
        placed.groupBy("token")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .filter("low <> high")
        .select("token")
    )
    open_ = placed.join(mixed_lists, "token", "left_semi")
    x, y = open_.alias("x"), open_.alias("y")
    second = (
        x.join(
            y,
            (F.col("x.token") == F.col("y.token"))
            & (F.col("x.sid") < F.col("y.sid"))
            & (F.col("x.root") != F.col("y.root"))
            & can_link(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"), per_cent),
        )
        .select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b"))
        .distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    second = durable(second, "pairs")
    discard(first, placed)
    more = durable(verified(second, own, size, per_cent), "links")
    discard(second, own)
    labels = components(edges.unionByName(more))

    smallest = labels.groupBy("root").agg(F.min("node").alias("component_id"))
    found = (
        sets.select("h1", "h2", "n", "sid")
        .join(labels.join(smallest, "root").withColumnRenamed("node", "sid"), "sid", "left")
        .select("h1", "h2", "n", F.coalesce("component_id", "sid").alias("component_id"))
    )
    found = durable(
        of_docs.join(found, ["h1", "h2", "n"], "left").select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        ),
        "near",
    )
    discard(profile, sets, edges, more, labels)
    return found


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle
  FROM texts, unnest(range(1, greatest(len(words) - 3, least(len(words), 1)) + 1)) t(i)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * common >= 85 * (s.n + t.n - common)
), steps AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT y, other FROM reached JOIN steps ON x = doc_id
)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""
