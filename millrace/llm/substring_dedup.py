r"""Removal of long word passages that occur more than once, by fixed-block anchors.

A passage is a window of ``length`` consecutive words (35 by default). Every text is cut into
non-overlapping reference blocks of ``(length + 1) // 2`` words: any window holds one of its own
text's blocks whole. The blocks are the index. Every rolling window of block size, in every text,
probes it. A block that is found elsewhere is an anchor; it is extended to the left and the right,
by up to ``length`` words in all, and an extension that occurs twice is an exact repeat.
Overlapping repeats join to maximal ones.

How the work is dealt out: texts go to batches by a hash of their id, once; all later passes reuse
that exchange. A batch sends each different hash once, however often it has it, packed with the
others that go to the same bucket. So a passage that a third of all rows share costs a bucket one
key for each batch. Buckets hold hashes only, texts never leave their batch, and no pair of places is ever
formed. Nothing is collected.

Probes carry 40 bits of their hash besides the bucket; a false hit there only costs an extension
that finds nothing. Repeats are decided on 96 bits of hash of the whole window.

Defined cases: a null text has no words; repeated rows are rows of their own, so their passages
repeat; columns other than id and text are kept as they are; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textkit import (
    U,
    bits,
    chunks,
    filled,
    flags_of,
    packed,
    rested,
    ship,
    text_bytes,
    unpacked,
    window_hashes,
    words_of,
)

LENGTH = 35
BATCHES_PER_PARTITION = 4
PROBE_BYTES = 5
BATCH = "__batch"


def spread(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash, from its high bits."""
    return ((hashes >> U(40)) % U(buckets)).astype(np.int32)


def hashed_texts(column: pa.Array):
    """Chunk by chunk: the row it begins at, its bytes and its words."""
    column = filled(column)
    for at, end in chunks(column):
        data, offsets = text_bytes(column[at:end])
        yield at, data, words_of(data, offsets)


def by_bucket(bucket: np.ndarray, buckets: int):
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), order[edges[b] : edges[b + 1]]


def merged(kept: list[tuple], fresh: tuple) -> list[tuple]:
    """Each hash once: ``(hashes, tail, block, multiple)`` arrays, joined when they have grown."""
    kept.append(fresh)
    if len(kept) < 16:
        return kept
    return [joined(kept)]


def joined(parts: list[tuple]) -> tuple:
    """Parts as one, each hash once: a block if any is, multiple if it came more than once."""
    hashes, tails, block, many = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    edges = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else []
    if not len(edges):
        return hashes, tails, block, many
    sizes = np.diff(np.r_[edges, len(hashes)])
    return (
        hashes[edges],
        tails[order][edges],
        np.logical_or.reduceat(block[order], edges),
        np.logical_or.reduceat(many[order], edges) | (sizes > 1),
    )


def probes(length: int, buckets: int):
    """Batch -> its block and rolling hashes, one packed row for each bucket."""
    size = (length + 1) // 2

    def run(table: pa.Table) -> pa.Table:
        parts: list[tuple] = []
        for batch in table.combine_chunks().to_batches():
            for _, _, words in hashed_texts(batch.column("text")):
                at, hashes = window_hashes(words, size)
                long = (words.counts >= length)[words.text[at]]
                at, hashes = at[long], hashes[long]
                block = (at - words.first[:-1][words.text[at]]) % size == 0
                parts = merged(
                    parts, (hashes, np.zeros(len(hashes), np.uint32), block, np.zeros(len(at), bool))
                )
        rows: dict[str, list] = {k: [] for k in ("bucket", BATCH, "keys", "block", "many")}
        if parts:
            hashes, _, block, many = joined(parts)
            for b, i in by_bucket(spread(hashes, buckets), buckets):
                rows["bucket"].append(b)
                rows["keys"].append(packed(hashes[i], PROBE_BYTES))
                rows["block"].append(bits(block[i]))
                rows["many"].append(bits(many[i]))
            rows[BATCH] = [table.column(BATCH)[0].as_py()] * len(rows["bucket"])
        return pa.table(rows, schema=PROBES)

    return run


PROBES = pa.schema(
    [
        ("bucket", pa.int32()),
        (BATCH, pa.int64()),
        ("keys", pa.binary()),
        ("block", pa.binary()),
        ("many", pa.binary()),
    ]
)
PROBE_ROWS = f"bucket int, {BATCH} long, keys binary, block binary, many binary"
HIT_ROWS = f"{BATCH} long, bucket int, keys binary"


def anchors(batches):
    """A bucket's packed rows -> the blocks of each batch that also stand somewhere else."""
    rows = pa.Table.from_batches(batches).to_pydict() if (batches := list(batches)) else {}
    if not rows or not rows["bucket"]:
        return
    for bucket, of in groups(rows["bucket"]):
        keys = [unpacked(rows["keys"][i], PROBE_BYTES) for i in of]
        block = np.concatenate(
            [flags_of(rows["block"][i], len(k)) for i, k in zip(of, keys)]
        )
        many = np.concatenate([flags_of(rows["many"][i], len(k)) for i, k in zip(of, keys)])
        edges = np.cumsum([0, *map(len, keys)])
        keys = np.concatenate(keys)
        order = np.argsort(keys)
        first = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
        times = np.add.reduceat(1 + many[order].astype(np.int64), first)
        found = np.logical_or.reduceat(block[order], first) & (times > 1)
        hit = np.zeros(len(keys), bool)
        hit[order] = np.repeat(found, np.diff(np.r_[first, len(keys)]))
        hit &= block
        out: dict[str, list] = {BATCH: [], "bucket": [], "keys": []}
        for k, i in enumerate(of):
            mine = slice(edges[k], edges[k + 1])
            if hit[mine].any():
                out[BATCH].append(rows[BATCH][i])
                out["bucket"].append(bucket)
                out["keys"].append(packed(keys[mine][hit[mine]], PROBE_BYTES))
        yield pa.record_batch(
            [pa.array(out[BATCH], pa.int64()), pa.array(out["bucket"], pa.int32()), pa.array(out["keys"], pa.binary())],
            names=[BATCH, "bucket", "keys"],
        )


def groups(buckets: list[int]):
    found: dict[int, list[int]] = {}
    for i, b in enumerate(buckets):
        found.setdefault(b, []).append(i)
    return found.items()


def extensions(length: int, buckets: int):
    """Batch and its anchors -> hashes of all windows around an anchor, packed by bucket."""
    size = (length + 1) // 2

    def run(table: pa.Table, hits: pa.Table) -> pa.Table:
        rows: dict[str, list] = {k: [] for k in ("bucket", BATCH, "keys", "tails", "many")}
        found = [
            (unpacked(k, PROBE_BYTES), b)
            for b, k in zip(hits.column("bucket").to_pylist(), hits.column("keys").to_pylist())
        ]
        if found and table.num_rows:
            low = U((1 << (8 * PROBE_BYTES)) - 1)
            places = np.sort(
                np.concatenate([mix_place(k, np.full(len(k), b, np.int64)) for k, b in found])
            )
            parts: list[tuple] = []
            for batch in table.combine_chunks().to_batches():
                for _, _, words in hashed_texts(batch.column("text")):
                    at, hashes = window_hashes(words, size)
                    begin = words.first[:-1][words.text[at]]
                    own = (at - begin) % size == 0
                    at, hashes = at[own], hashes[own]
                    anchor = at[isin(mix_place(hashes & low, spread(hashes, buckets)), places)]
                    near = np.zeros(len(words.hashes) + 1, np.int32)
                    np.add.at(near, np.maximum(anchor - size + 1, 0), 1)
                    np.add.at(near, anchor + 1, -1)
                    near = np.cumsum(near) > 0
                    at, hashes = window_hashes(words, length)
                    tails = window_hashes(words, length, kind=2)[1]
                    around = near[at]
                    hashes, tails = hashes[around], tails[around]
                    none = np.zeros(len(hashes), bool)
                    parts = merged(parts, (hashes, tails.astype(np.uint32), none, none))
            if parts:
                hashes, tails, _, many = joined(parts)
                for b, i in by_bucket(spread(hashes, buckets), buckets):
                    rows["bucket"].append(b)
                    rows["keys"].append(packed(hashes[i], 8))
                    rows["tails"].append(tails[i].tobytes())
                    rows["many"].append(bits(many[i]))
                rows[BATCH] = [table.column(BATCH)[0].as_py()] * len(rows["bucket"])
        return pa.table(rows, schema=EXTENSIONS)

    return run


EXTENSIONS = pa.schema(
    [
        ("bucket", pa.int32()),
        (BATCH, pa.int64()),
        ("keys", pa.binary()),
        ("tails", pa.binary()),
        ("many", pa.binary()),
    ]
)
EXTENSION_ROWS = f"bucket int, {BATCH} long, keys binary, tails binary, many binary"
REPEAT_ROWS = f"{BATCH} long, keys binary"


def mix_place(low: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return low.astype(U) | (bucket.astype(U) << U(8 * PROBE_BYTES))


def isin(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Membership in a sorted array."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def repeats(batches):
    """A bucket's window hashes -> for each batch, those that occur more than once anywhere."""
    rows = pa.Table.from_batches(batches).to_pydict() if (batches := list(batches)) else {}
    if not rows or not rows["bucket"]:
        return
    for _, of in groups(rows["bucket"]):
        keys = [unpacked(rows["keys"][i], 8) for i in of]
        many = np.concatenate([flags_of(rows["many"][i], len(k)) for i, k in zip(of, keys)])
        tails = np.concatenate([np.frombuffer(rows["tails"][i], np.uint32) for i in of])
        edges = np.cumsum([0, *map(len, keys)])
        keys = np.concatenate(keys)
        order = np.lexsort((tails, keys))
        k, t = keys[order], tails[order]
        first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (t[1:] != t[:-1])])
        times = np.add.reduceat(1 + many[order].astype(np.int64), first)
        hit = np.zeros(len(keys), bool)
        hit[order] = np.repeat(times > 1, np.diff(np.r_[first, len(keys)]))
        out: dict[str, list] = {BATCH: [], "keys": []}
        for j, i in enumerate(of):
            mine = slice(edges[j], edges[j + 1])
            if hit[mine].any():
                out[BATCH].append(rows[BATCH][i])
                out["keys"].append(packed(keys[mine][hit[mine]], 8))
        yield pa.record_batch(
            [pa.array(out[BATCH], pa.int64()), pa.array(out["keys"], pa.binary())],
            names=[BATCH, "keys"],
        )


def cut(length: int, separator: str | None, names: list[str], schema: pa.Schema):
    """Batch and its repeats -> its rows without the words that any repeat covers."""

    def run(table: pa.Table, hits: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        found = [unpacked(k, 8) for k in hits.column("keys").to_pylist()]
        repeated = np.unique(np.concatenate(found)) if found else np.zeros(0, U)
        done = []
        for batch in table.combine_chunks().to_batches():
            texts, counts, removed = [], [], []
            column = batch.column("text")
            for at, data, words in hashed_texts(column):
                begin, hashes = window_hashes(words, length)
                begin = begin[isin(hashes, repeated)]
                cover = np.zeros(len(words.hashes) + 1, np.int32)
                cover[begin] += 1
                cover[begin + length] -= 1
                gone = np.cumsum(cover)[:-1] > 0
                total = np.r_[0, np.cumsum(gone)]
                lost = total[words.first[1:]] - total[words.first[:-1]]
                counts.append(words.counts)
                removed.append(lost)
                for i in range(len(lost)):
                    text = column[at + i].as_py()
                    if separator is None and not lost[i]:
                        texts.append(text)
                        continue
                    own = slice(words.first[i], words.first[i + 1])
                    keep = ~gone[own]
                    if separator is None:
                        texts.append(without(text, keep))
                    else:
                        split = (text or "").encode().split()
                        kept = compress(split, keep) if lost[i] else split
                        texts.append(separator.encode().join(kept).decode())
            kept = {n: batch.column(n) for n in names if n != "text"}
            kept |= {
                "text": pa.array(texts, pa.string()),
                "n_words": pa.array(np.concatenate(counts).astype(np.int64)),
                "n_removed": pa.array(np.concatenate(removed).astype(np.int64)),
            }
            done.append(pa.table({f.name: kept[f.name] for f in schema}).cast(schema))
        return pa.concat_tables(done)

    return run


def without(text: str, keep: np.ndarray) -> str:
    """The text with only the kept words, each with the white space that stood before it."""
    data = text.encode()
    words = words_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    before = np.r_[0, words.ends[:-1]]
    parts = [data[a:b] for a, b in zip(before[keep], words.ends[keep])]
    return b"".join(parts).decode().strip()


def remove_repeats(
    documents: DataFrame, length: int = LENGTH, separator: str | None = None
) -> DataFrame:
    """Rows of ``documents`` with repeated passages cut from ``text``, and two more columns.

    ``n_words`` and ``n_removed`` count words before and words cut. With a ``separator`` the kept
    words are joined by it; without one they keep the white space before them, and texts that lose
    nothing stay as they are.
    """
    spark = documents.sparkSession
    ship(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    batches, buckets = BATCHES_PER_PARTITION * partitions, partitions
    named = documents.drop("n_words", "n_removed")
    names = named.columns
    texts = named.withColumn(BATCH, F.pmod(F.xxhash64("doc_id"), F.lit(batches)))
    by_batch = texts.groupBy(BATCH)
    probed = by_batch.applyInArrow(rested(probes(length, buckets)), PROBE_ROWS)
    hits = probed.repartitionById(buckets, F.col("bucket")).mapInArrow(rested(anchors), HIT_ROWS)
    around = by_batch.cogroup(hits.groupBy(BATCH)).applyInArrow(
        rested(extensions(length, buckets)), EXTENSION_ROWS
    )
    found = around.repartitionById(buckets, F.col("bucket")).mapInArrow(rested(repeats), REPEAT_ROWS)
    fields = [f for f in named.schema.fields]
    out = T.StructType(
        [*fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    return by_batch.cogroup(found.groupBy(BATCH)).applyInArrow(
        rested(cut(length, separator, names, to_arrow_schema(out))), out
    )


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """The digest columns of ``remove_repeats`` over all documents."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept = remove_repeats(documents, separator=" ")
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT row, i, array_to_string(words[i:i + 34], ' ') AS passage
  FROM texts, unnest(range(1, len(words) - 33)) t(i)
), repeated AS (
  SELECT passage FROM windows GROUP BY passage HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT row, i + k AS place
  FROM windows SEMI JOIN repeated USING (passage), range(35) r(k)
), placed AS (
  SELECT row, i AS place, words[i] AS word FROM texts, unnest(range(1, len(words) + 1)) t(i)
), kept AS (
  SELECT row, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
  FROM placed ANTI JOIN gone USING (row, place) GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (row)
"""
