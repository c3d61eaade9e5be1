r"""Katz back-off: Good-Turing discounted word pairs over discounted words, exactly normalised.

The tokens of a text are its words and one end. A token's context is the token before it, or the
start. With c the counts of the training texts, a pair that they have keeps ``d * c(v, w) / c(v)``; what
the discounts spare goes to the words that never followed v, in proportion to their own probability:

    P(w | v) = d[c(v, w)] * c(v, w) / (c(v) + b)   where the pair has been seen
             = alpha(v) * P(w)                     else, alpha(v) = 1 where v has not been seen
    P(w)     = d[c(w)] * c(w) / (N + b)            and one unknown word has what that leaves

``d[r]`` is Good-Turing's for r up to ``CUTOFF``, as far as the counts of counts give shares between 0
and 1; 1 above. Where no continuation of a context is discounted, b = 1 leaves one count to back off with;
else b = 0. Both sides of alpha are sums of positive terms over whole numbers - how many
continuations have count r in the pairs, how many have count r as words - so weights
do not depend on how the pairs are dealt out, and each context's probabilities add up to 1.

How it runs. Training words are counted first; that tells which contexts hold over ``1 / SPLIT`` of the
tokens. A task then writes its texts' tokens as sorted runs, one binary row for each bucket: contexts,
words, and the texts that have the pair. A pair that many texts of a task have is written once. Pairs are
dealt by context; contexts above that share are dealt by pair, so none has to fit one task. The runs
are shuffled once and read from there three times: each bucket asks for the counts of its different
words; it adds up what it has of split contexts, whose sums (``SPLIT`` rows at most) go to all buckets;
and it adds up what each text gains in it, a row for each run, and these are added up by run. What is gathered - words,
runs, asked words, sums - grows with the corpus; the driver holds split contexts and counts of
counts only.

Words and contexts are 64-bit hashes of their bytes.

Defined cases: a null text is empty and has only its end; without training texts every token is unknown, with
probability 1; a null id is in training; repeated rows are scored, and counted, each; other columns take
no part; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .textkit import U, chunks, filled, mixed, rested, ship, text_bytes, words_of

CUTOFF = 5
#: Contexts with at least this share of all training tokens are split; so there are no more of them.
SPLIT = 1024
#: Text bytes of a bucket, and of the rows that a task writes together.
BUCKET = 24_000_000
RUN = 12_000_000
START, END = U(0x5BD1E995A5A5A5A5), U(0x2545F4914F6CDD1D)
BLOBS = ["ids", "marks", "trains", "contexts", "sizes", "lexicon", "words", "counts", "places"]
RUNS = "bucket int, run long, " + ", ".join(f"{x} binary" for x in BLOBS)
WIDTH = 2 * CUTOFF + 4  # of the sums of a context: tokens, pairs by count, words by count
SUMS = "id long, mark int, n_tokens long, n_known long, base_score double, score double"
GAINS = {"ids": "<i8", "marks": "<i4", "tokens": "<i4", "known": "<i4", "base": "<f8", "gain": "<f8"}


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, context and word of each token of some texts, in reading order."""
    texts, contexts, words = [], [], []
    for at, stop in chunks(column, 1_000_000):
        found = words_of(*text_bytes(column[at:stop]), lower=True)
        ends = found.first[1:] + np.arange(stop - at)
        word = np.empty(len(found.hashes) + stop - at, U)
        inside = np.ones(len(word), bool)
        inside[ends] = False
        word[inside], word[ends] = found.hashes, END
        context = np.empty(len(word), U)
        context[1:] = word[:-1]
        context[np.r_[0, ends[:-1] + 1]] = START
        texts.append(np.repeat(np.arange(at, stop, dtype=np.int32), found.counts + 1))
        contexts.append(context)
        words.append(word)
    return np.concatenate(texts), np.concatenate(contexts), np.concatenate(words)


def pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(mixed(context) + word)


def count_words(batches):
    """Training words and contexts of a task's texts; the start counts as a word of its own."""
    seen: list = []

    def added():
        word, n = (np.concatenate(x) for x in zip(*seen))
        order = np.argsort(word)
        at = begins(word[order])
        return word[order][at], np.add.reduceat(n[order], at) if len(at) else n

    for batch in batches:
        column = filled(batch.column("text"))
        for at, stop in chunks(column, RUN):
            _, _, word = tokens_of(column[at:stop])
            seen.append(np.unique(word, return_counts=True))
            if len(seen) > 7:
                seen = [added()]
    if seen:
        word, n = added()
        for at in range(0, len(word), 100_000):
            part = slice(at, at + 100_000)
            yield pa.record_batch(
                [pa.array(word[part].view(np.int64)), pa.array(n[part].astype(np.int64))],
                names=["word", "n"],
            )


def narrow(n: int) -> str:
    """The type of places in an array of n."""
    return "<u2" if n <= 1 << 16 else "<u4"


def contained(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def begins(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def runs(buckets: int, split: np.ndarray):
    """The task that writes its tokens as sorted runs for each bucket."""

    bits = (64 - max(buckets - 1, 1).bit_length()) // 2

    def written(ids, marks, trains, column):
        text, context, word = tokens_of(column)
        of_context, of_pair = mixed(context), pair_key(context, word)
        bucket = (np.where(contained(split, context), of_pair, of_context) % U(buckets)).astype(U)
        # One sort brings equal pairs together. Contexts that are alike in these bits are mixed, and
        # then written in more than one run.
        of_context >>= U(64 - bits)
        of_pair >>= U(64 - bits)
        order = np.argsort((((bucket << U(bits)) | of_context) << U(bits)) | of_pair)
        del of_context, of_pair
        bucket, context, word, text = bucket[order], context[order], word[order], text[order]
        del order
        edges = begins(bucket)
        for a, b in zip(edges, [*edges[1:], len(bucket)]):
            mine, place = np.unique(text[a:b], return_inverse=True)
            pairs = begins(context[a:b], word[a:b])
            first = begins(context[a:b][pairs])
            lexicon, words = np.unique(word[a:b][pairs], return_inverse=True)
            yield {
                "bucket": int(bucket[a]),
                "run": int(ids[0]),
                "ids": ids[mine].tobytes(),
                "marks": marks[mine].tobytes(),
                "trains": trains[mine].tobytes(),
                "contexts": context[a:b][pairs][first].tobytes(),
                "sizes": np.diff(np.r_[first, len(pairs)]).astype("<u4").tobytes(),
                "lexicon": lexicon.tobytes(),
                "words": words.astype(narrow(len(lexicon))).tobytes(),
                "counts": np.diff(np.r_[pairs, b - a]).astype("<u4").tobytes(),
                "places": place.astype(narrow(len(mine))).tobytes(),
            }

    def run(batches):
        kinds = [("bucket", pa.int32()), ("run", pa.int64()), *[(x, pa.binary()) for x in BLOBS]]
        schema = pa.schema(kinds)
        for batch in batches:
            column = filled(batch.column("text"))
            ids, marks = (batch.column(x).to_numpy() for x in ("id", "mark"))
            trains = batch.column("train").to_numpy(zero_copy_only=False)
            for at, stop in chunks(column, RUN):
                rows = written(ids[at:stop], marks[at:stop], trains[at:stop], column[at:stop])
                yield pa.RecordBatch.from_pylist(list(rows), schema)

    return run


class Bucket:
    """All runs of one bucket: its different pairs and which texts have them how often."""

    def __init__(self, table: pa.Table):
        def column(name, kind):
            return [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]

        def looked_up(name, of):
            """Places in each of the arrays ``of``."""
            return [
                np.frombuffer(x, narrow(len(own)))
                for x, own in zip(table.column(name).to_pylist(), of)
            ]

        ids, lexica = column("ids", np.int64), column("lexicon", U)
        self.runs = table.column("run").to_pylist()
        self.edges = starts = np.cumsum([0, *[len(own) for own in ids]])
        self.ids, self.marks = np.concatenate(ids), np.concatenate(column("marks", np.int32))
        trains = np.concatenate(column("trains", bool))
        self.text = np.concatenate(
            [p.astype(np.int32) + np.int32(s) for p, s in zip(looked_up("places", ids), starts)]
        )
        sizes = np.concatenate(column("sizes", "<u4"))
        context = np.repeat(np.concatenate(column("contexts", U)), sizes)
        word = np.concatenate([x[p] for x, p in zip(lexica, looked_up("words", lexica))])
        counts = np.concatenate(column("counts", "<u4"))
        # What several runs have of a pair belongs together, and so do the pairs of a context.
        key = pair_key(context, word)
        order = np.argsort(key)
        first = begins(key[order])
        pair = np.empty(len(order), np.int32)
        times = np.diff(np.r_[first, len(order)])
        pair[order] = np.repeat(np.arange(len(first), dtype=np.int32), times)
        context, word = context[order[first]], word[order[first]]
        del key, times, order
        order = np.argsort(context)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.context, self.word = context[order], word[order]
        self.pair = np.repeat(place[pair], counts)
        del pair, counts
        self.count = np.bincount(self.pair[trains[self.text]], minlength=len(order))
        self.starts = begins(self.context)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """By context."""
        return np.add.reduceat(values, self.starts)


def ask(table: pa.Table) -> pa.Table:
    """A bucket's different words."""
    word = np.unique(np.concatenate([np.frombuffer(x, U) for x in table.column("lexicon").to_pylist()]))
    own = np.full(len(word), table.column("bucket")[0].as_py(), np.int32)
    return pa.table([pa.array(own), pa.array(word.view(np.int64))], names=["bucket", "word"])


def discounts(counts: np.ndarray, cutoff: int = CUTOFF) -> np.ndarray:
    """Good-Turing's share that a count of r keeps, for r from 0 to ``cutoff``; 1 where it gives none.

    ``counts[r]`` is how many things have been counted r times. The cutoff falls until all shares up to it
    are between 0 and 1.
    """
    kept = np.ones(cutoff + 1)
    for top in range(cutoff, 0, -1):
        n = [float(x) for x in counts[: top + 2]]
        if min(n[1 : top + 1]) <= 0:
            continue
        spare = (top + 1) * n[top + 1] / n[1]
        if spare >= 1:
            continue
        found = [((r + 1) * n[r + 1] / (r * n[r]) - spare) / (1 - spare) for r in range(1, top + 1)]
        if all(0 < x < 1 for x in found):
            kept[1 : top + 1] = found
            return kept
    return kept


class Words:
    """Probabilities of words by their count: P(w) for the known, and for the unknown one."""

    def __init__(self, total: int, counts: list[int], above: int, cutoff: int = CUTOFF):
        """``counts[r]`` words have r tokens, for r up to cutoff + 1; ``above`` tokens are in words with more
        than ``cutoff``."""
        self.total, self.cutoff = total, cutoff
        self.counts, self.above = np.array(counts[: cutoff + 1], np.float64), float(above)
        self.kept = discounts(np.array(counts), cutoff)
        r = np.arange(cutoff + 1)
        spared = float((self.counts * r * (1 - self.kept))[1:].sum())
        self.size = total if spared > 0 else total + 1
        self.unknown = (spared if spared > 0 else 1.0) / self.size

    def probability(self, count: np.ndarray) -> np.ndarray:
        kept = self.kept[np.minimum(count, self.cutoff)]
        kept = np.where(count > self.cutoff, 1.0, kept)
        return np.where(count > 0, kept * count / self.size, self.unknown)

    def others(self, below: np.ndarray) -> np.ndarray:
        """What all words but the given have together: ``below`` has, for each context, how many of its
        words have count r, and in the last column the tokens of those with more than ``cutoff``."""
        r = np.arange(1, self.cutoff + 1)
        left = (self.counts[1:] - below[:, 1:-1]) * r * self.kept[1:]
        return self.unknown + (left.sum(axis=1) + (self.above - below[:, -1])) / self.size


def tallies(bucket: Bucket, known: np.ndarray):
    """For each context: tokens, how many pairs have count r, and ``below`` of the words seen after it."""
    n = bucket.sums(bucket.count)
    seen = np.zeros((len(bucket.starts), CUTOFF + 1), np.int64)
    below = np.zeros((len(bucket.starts), CUTOFF + 2), np.int64)
    pair = bucket.count > 0
    for r in range(1, CUTOFF + 1):
        seen[:, r] = bucket.sums((bucket.count == r).astype(np.int64))
        below[:, r] = bucket.sums((pair & (known == r)).astype(np.int64))
    below[:, -1] = bucket.sums(np.where(pair & (known > CUTOFF), known, 0))
    return n, seen, below


def known_counts(bucket: Bucket, answers: pa.Table) -> np.ndarray:
    answers = answers.filter(pc.is_valid(answers.column("n")))
    word = answers.column("word").to_numpy().view(U)
    order = np.argsort(word)
    return answers.column("n").to_numpy()[order][np.searchsorted(word[order], bucket.word)]


def parts(split: np.ndarray):
    """What one bucket has of split contexts, and its pairs' counts of counts (``kind`` 0)."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = np.zeros((0, WIDTH), np.int64)
        context = np.zeros(0, U)
        if table.num_rows:
            bucket = Bucket(table)
            n, seen, below = tallies(bucket, known_counts(bucket, answers))
            context = bucket.context[bucket.starts]
            mine = np.flatnonzero(contained(split, context))
            by_count = np.bincount(np.minimum(bucket.count, CUTOFF + 2), minlength=CUTOFF + 3)
            by_count = np.r_[by_count[: CUTOFF + 2], np.zeros(WIDTH - CUTOFF - 2, np.int64)]
            rows = np.vstack([by_count, np.column_stack([n, seen, below])[mine]])
            context = np.r_[U(0), context[mine]]
        kind = (np.arange(len(context)) > 0).astype(np.int32)
        columns = [pa.array(kind), pa.array(context.view(np.int64)), *map(pa.array, rows.T.copy())]
        return pa.table(columns, names=["kind", "context", *[f"s{i}" for i in range(WIDTH)]])

    return run


def weights(n, seen, below, kept: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each context the denominator of its pairs and its back-off weight."""
    spared = (seen * np.arange(CUTOFF + 1) * (1 - kept)).sum(axis=1)
    extra = (spared <= 0).astype(np.float64)
    size = n + extra
    alpha = np.where(n > 0, (spared + extra) / np.maximum(size, 1) / words.others(below), 1.0)
    return size, alpha


def scorer(words: Words, distinct: int):
    """What each text gains from the tokens of one bucket, a row for each run."""
    schema = pa.schema([("run", pa.int64()), *[(x, pa.binary()) for x in GAINS]])

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        told = answers.column("told").drop_null()[0].as_py()
        told = np.array([row.split(",") for row in told.split(";")], np.int64)
        kept = discounts(told[told[:, 0] == 0, 2:].sum(axis=0)[: CUTOFF + 2])
        whole = told[told[:, 0] == 1, 1:]
        whole = whole[np.argsort(whole[:, 0].copy().view(U))]
        bucket = Bucket(table)
        known = known_counts(bucket, answers)
        n, seen, below = tallies(bucket, known)
        context = bucket.context[bucket.starts]
        if len(whole):
            those = whole[:, 0].copy().view(U)
            at = np.minimum(np.searchsorted(those, context), len(those) - 1)
            found = np.flatnonzero(those[at] == context)
            n[found] = whole[at[found], 1]
            seen[found] = whole[at[found], 2 : CUTOFF + 3]
            below[found] = whole[at[found], CUTOFF + 3 :]
        size, alpha = weights(n, seen, below, kept, words)
        of = np.repeat(np.arange(len(context)), np.diff(np.r_[bucket.starts, len(bucket.word)]))
        count = bucket.count
        share = np.where(count > CUTOFF, 1.0, kept[np.minimum(count, CUTOFF)]) * count / size[of]
        p = np.log10(np.where(count > 0, share, alpha[of] * words.probability(known)))
        del of, share
        base = np.log10((known + 0.5) / (words.total + 0.5 * (distinct + 1)))
        rows = len(bucket.ids)

        def added(values):
            return np.bincount(bucket.text, values[bucket.pair], minlength=rows)

        gains = dict(
            ids=bucket.ids,
            marks=bucket.marks,
            tokens=np.bincount(bucket.text, minlength=rows),
            known=added((known > 0).astype(np.float64)),
            base=added(base),
            gain=added(p),
        )
        gains = {name: gains[name].astype(kind) for name, kind in GAINS.items()}
        made = [
            {"run": own} | {name: values[a:b].tobytes() for name, values in gains.items()}
            for own, a, b in zip(bucket.runs, bucket.edges, bucket.edges[1:])
        ]
        return pa.Table.from_pylist(made, schema)

    return run


def total(table: pa.Table) -> pa.Table:
    """What the texts of one run gain in all buckets."""
    parts = {
        name: np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])
        for name, kind in GAINS.items()
    }
    order = np.lexsort((parts["marks"], parts["ids"]))
    parts = {name: values[order] for name, values in parts.items()}
    first = begins(parts["ids"], parts["marks"])
    sums = [
        np.add.reduceat(parts[name].astype(kind), first)
        for name, kind in (("tokens", "i8"), ("known", "i8"), ("base", "f8"), ("gain", "f8"))
    ]
    return pa.table(
        [pa.array(parts["ids"][first]), pa.array(parts["marks"][first]), *map(pa.array, sums)],
        names=[x.split()[0] for x in SUMS.split(", ")],
    )


def katz_scores(documents: DataFrame, train, bucket: int = BUCKET, share: int = SPLIT) -> DataFrame:
    """``doc_id, trains, n_tokens, n_known, train_tokens, base_score, score`` of each row.

    ``train`` is a condition on ``doc_id``: the rows that the model learns from.
    """
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select("doc_id", "text", F.coalesce(train, F.lit(True)).alias("train"))
    # Rows of one id and one text are one to the sums, which are shared out again below.
    rows = rows.select(
        "*",
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("id"),
        F.hash("text", F.col("doc_id").isNull()).alias("mark"),
    )
    counted = (
        rows.filter("train")
        .select("text")
        .mapInArrow(rested(count_words), "word long, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    counted = durable(counted, "katz-words")
    n = F.col("n")
    told = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count("*").alias("distinct"),
        F.coalesce(F.sum(F.when(n > CUTOFF, n)), F.lit(0)).alias("above"),
        *[F.count(F.when(n == r, 1)).alias(f"n{r}") for r in range(1, CUTOFF + 2)],
    ).first()
    words = Words(told.total, [0, *told[3:]], told.above)
    # The end is a word but no context; it stands for the start, which is as frequent.
    often = counted.filter(n * share >= told.total).select("word").collect()
    split = np.array([r.word for r in often], np.int64).view(U)
    split = np.sort(np.where(split == END, START, split))

    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // bucket))
    pairs = (
        rows.select("id", "mark", "train", "text")
        .mapInArrow(rested(runs(buckets, split)), RUNS)
        .repartition("bucket")
    )
    asked = pairs.groupBy("bucket").applyInArrow(rested(ask), "bucket int, word long")
    marker = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    answers = (
        asked.join(counted, "word", "left")
        .select("bucket", "word", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
        .unionByName(marker, allowMissingColumns=True)
        .repartition("bucket")
    )
    sums = ["kind", "context", *[f"s{i}" for i in range(WIDTH)]]
    summed = (
        pairs.groupBy("bucket")
        .cogroup(answers.groupBy("bucket"))
        .applyInArrow(rested(parts(split)), "kind int, " + ", ".join(f"{x} long" for x in sums[1:]))
        .groupBy("kind", "context")
        .agg(*[F.sum(x).alias(x) for x in sums[2:]])
        .agg(F.array_join(F.collect_list(F.concat_ws(",", *[F.col(x).cast("string") for x in sums])), ";"))
    )
    full = answers.withColumn("told", F.when(F.col("n").isNull(), summed.scalar()))
    scores = (
        pairs.groupBy("bucket")
        .cogroup(full.groupBy("bucket"))
        .applyInArrow(
            rested(scorer(words, told.distinct)),
            "run long, " + ", ".join(f"{x} binary" for x in GAINS),
        )
        .groupBy("run")
        .applyInArrow(rested(total), SUMS)
        .groupBy("id", "mark")
        .agg(*[F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base_score", "score")])
    )
    times = rows.groupBy("id", "mark").agg(F.count("*").alias("times"))
    scores = scores.join(times, ["id", "mark"]).select(
        "id",
        "mark",
        *[F.expr(f"{c} div times").alias(c) for c in ("n_tokens", "n_known")],
        *[(F.col(c) / F.col("times")).alias(c) for c in ("base_score", "score")],
    )
    return (
        rows.select("doc_id", F.col("train").alias("trains"), "id", "mark")
        .join(scores, ["id", "mark"])
        .select(
            "doc_id",
            "trains",
            "n_tokens",
            "n_known",
            F.lit(told.total).cast("long").alias("train_tokens"),
            "base_score",
            "score",
        )
    )


def op11_katz_backoff(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 5
    return katz_scores(documents, remainder != 1).select(
        "doc_id",
        (~F.col("trains")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )
