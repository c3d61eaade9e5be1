r"""Quality rules: counts of each text, and a perplexity band for each language.

The language model is an interpolated modified Kneser-Ney model of order 4 over code points as they
are: nothing is folded, so what is counted grows with the corpus. It is never in one place. Each
different text is counted once, by Spark: tasks count their own n-grams, one shuffle adds them up,
and continuation counts, discounts and back-off weights are grouped and joined from those. The model
learns from plain texts only, those whose share of ``MARKS`` is at most ``FEW_MARKS`` or ``MEDIANS`` times
their language's median; grams that no plain text has are there, with a count of zero, and are scored by backing off.

Every gram carries the smallest and the largest number of a text that has it. Where both are one, only
that text has shown the gram, and its score is that of a gram never seen: the context's back-off
weight and the score of the next shorter gram, for which the same holds. So the score of a gram is
one number, the same for every text that asks for it, and no text is scored by what only it has shown,
however many copies it has.

Texts are not dealt out to be counted. A bitmap of ``BITS`` bits, whatever the input, marks the hashes
of texts that stand in several rows, and of a few others; only marked texts travel, so that one of each is
counted, and all others are counted where they are read.

For the scores, rows that stand together in a file are a chunk of about ``CHUNK`` bytes. Rows of 16, 256, ...
times the mean length have chunks of fewer rows, so none has more than 16 times that. A chunk asks for
each of its grams once; scores are joined to those by gram and come back to the chunk's rows, which travel
once, compressed, and look them up in arrays sorted by hash. Discounts and bands, a row for each
language, limits of marks and the bitmap are the only things broadcast. Stages are deleted once the next is written.

A text's score is the logarithm of its perplexity. In each language the quartiles of all different
scores of plain texts (copies count once, so no group of copies can move them) set the band: ``SPREAD`` times the
distance from median to quartile, ``LEAST`` at least, on either side. What lies above is noise, what
lies below repeats itself.

Defined cases: a null text has no words and fails the base rules; a null language is a language of
its own; a text without a symbol has no score and is judged by the base rules alone, as is one of a
language without plain texts; repeated rows are judged each; other columns take no part; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import discard, durable
from .textkit import (
    SPACES,
    U,
    chunks,
    filled,
    mixed,
    rested,
    ship,
    small_batches,
    text_bytes,
    window_hashes,
    words_of,
)

ORDER = 4
SPREAD = 8.0
LEAST = 0.9
NO_LANGUAGE = ""
#: Text bytes of a chunk, bits of a code point, and code points there are.
CHUNK = 16_000_000
WIDE = 21
POINTS = 0x110000
#: Bits of the map of copied texts, and grams that a task holds before it passes them on.
BITS = 1 << 24
HELD = 2_000_000
MIN_WORDS = 10
REPEAT_WINDOW = 5
MOST_REPEATED = 20  # per cent of all words
MARKS = b"#*$%&|<>"
FEW_MARKS = 0.01
MEDIANS = 2.0
IS_MARK = np.zeros(256, bool)
IS_MARK[list(MARKS)] = True


def by_language(batch: pa.RecordBatch):
    languages = batch.column("lang").fill_null(NO_LANGUAGE)
    for language in pc.unique(languages).to_pylist():
        yield language, batch.filter(pc.equal(languages, language))


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(flags, dtype=np.int64)][offsets])


def duplicate_lines(text: str) -> int:
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    lines = [x for x in lines if x.strip(" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def repeated_words(words) -> np.ndarray:
    """Words of each text inside a 5-word window that the same text has twice or more."""
    at, hashes = window_hashes(words, REPEAT_WINDOW)
    keys = mixed(hashes + words.text[at].astype(np.uint64) * U(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    begins = at[order][twice]
    cover = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(cover, begins, 1)
    np.add.at(cover, begins + REPEAT_WINDOW, -1)
    covered = np.r_[0, np.cumsum(np.cumsum(cover)[:-1] > 0)]
    return covered[words.first[1:]] - covered[words.first[:-1]]


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars")


def measures(column: pa.Array) -> list[np.ndarray]:
    """``MEASURES`` of each text."""
    data, offsets = text_bytes(column)
    words = words_of(data, offsets)
    chars = ~SPACES[data] & ((data & 0xC0) != 0x80)
    return [
        words.counts.astype(np.int64),
        per_text(chars, offsets),
        per_text(IS_MARK[data], offsets),
        np.array([duplicate_lines(t) for t in column.to_pylist()], np.int64),
        repeated_words(words).astype(np.int64),
        per_text((data & 0xC0) != 0x80, offsets),
    ]


def mark_share() -> Column:
    """The share of ``MARKS`` among the code points of a text that is not empty."""
    marks = F.regexp_replace("text", f"[^{MARKS.decode()}]+", "")
    return F.length(marks) / F.length("text")


def most_marks(texts: DataFrame) -> DataFrame:
    """``lang, limit``: the share of marks that a plain text has at most."""
    median = F.percentile_approx("share", 0.5)
    return (
        texts.groupBy("lang", "owner", "g")
        .agg(F.min("share").alias("share"))
        .groupBy("lang")
        .agg(F.greatest(F.lit(FEW_MARKS), MEDIANS * median).alias("limit"))
    )


def copied(texts: DataFrame) -> bytes:
    """A bitmap with the bit of every text that stands in more than one row; texts may share bits."""
    # Spark's buckets of 32,768 bits are numbered from one, and so are their places.
    place = F.pmod("owner", F.lit(BITS)) + 1
    several = texts.groupBy("owner", "g").agg(F.count("*").alias("rows")).filter("rows > 1")
    maps = (
        several.select(place.alias("place"))
        .groupBy((F.expr("bitmap_bucket_number(place)") - 1).alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits"))
    )
    found, size = bytearray(BITS // 8), 4096
    # At most BITS / 32,768 rows of 4096 bytes.
    for row in maps.collect():
        found[row["bucket"] * size : (row["bucket"] + 1) * size] = row["bits"]
    return bytes(found)


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes % BITS
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def some_rows(bits: bytes, wanted: bool):
    """Rows whose text is marked, one for each text of the task; or all others."""
    table = np.frombuffer(bits, np.uint8)

    def run(batches):
        seen: set = set()
        for batch in batches:
            is_marked = marked(table, batch.column("owner").to_numpy())
            batch = batch.filter(pa.array(is_marked == wanted))
            if wanted:
                keep = []
                for key in zip(batch.column("owner").to_pylist(), batch.column("g").to_pylist()):
                    keep.append(key not in seen)
                    seen.add(key)
                batch = batch.filter(pa.array(keep, pa.bool_()))
            yield batch

    return run


def numbered(keys: np.ndarray) -> np.ndarray:
    """A number from 0 for each key, equal for equal keys; a hash table, not a sort."""
    return pa.array(keys).dictionary_encode().indices.to_numpy().astype(np.int64)


def wide_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text and gram of each place of some texts; context (three code points) and code point of each gram.

    Grams are numbered from 0, each different one once. Code points count from 1; 0 stands before a text.
    They are told apart by numbers that only the code points of these texts have, 16 bits each where
    those suffice.
    """
    texts = column.to_pylist()
    sizes = np.array([len(t) for t in texts], np.int64)
    before = "\0" * (ORDER - 1)
    whole = (before + before.join(texts)).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(whole, "<u4")
    known = np.zeros(POINTS, bool)
    known[points] = True
    alphabet = np.flatnonzero(known)
    number = np.zeros(POINTS, "<u2" if len(alphabet) < 1 << 16 else "<u4")
    number[alphabet] = np.arange(1, len(alphabet) + 1)
    own = number[points]
    begin = np.cumsum(sizes) - sizes + (ORDER - 1) * np.arange(len(sizes))
    own[begin[:, None] + np.arange(ORDER - 1)] = 0
    place = np.flatnonzero(own[ORDER - 1 :])
    step = own.itemsize
    if step == 2:
        keys = np.ndarray(len(own) - ORDER + 1, "<u8", own, 0, (step,))[place]
    else:
        pairs = numbered(np.ndarray(len(own) - 1, "<u8", own, 0, (step,)).copy())
        keys = (pairs[place] << 32) | pairs[place + 2]
    gram = numbered(keys)
    at = np.zeros(gram.max() + 1 if len(gram) else 0, np.int64)
    at[gram] = place
    context = np.zeros(len(at), np.int64)
    for back in range(1, ORDER):
        there = at + ORDER - 1 - back
        code = np.where(own[there] > 0, points[there].astype(np.int64) + 1, 0)
        context |= code << (WIDE * (back - 1))
    symbol = points[at + ORDER - 1].astype(np.int64) + 1
    return np.repeat(np.arange(len(sizes)), sizes), gram, context, symbol


def gram_key(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return mixed(mixed(context.astype(U)) + symbol.astype(U))


class Grams:
    """Different grams of some texts, with sums of ``n`` and the range of ``owner``."""

    def __init__(self):
        self.parts: list[list[np.ndarray]] = []

    @property
    def held(self) -> int:
        return sum(len(part[0]) for part in self.parts)

    def add(self, context, symbol, n, low, high) -> None:
        self.parts.append([context, symbol, n, low, high])
        if len(self.parts) > 15:
            self.parts = [self.merged()]

    def merged(self) -> list[np.ndarray]:
        context, symbol, n, low, high = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(gram_key(context, symbol), kind="stable")
        context, symbol = context[order], symbol[order]
        new = np.ones(len(order), bool)
        new[1:] = (context[1:] != context[:-1]) | (symbol[1:] != symbol[:-1])
        at = np.flatnonzero(new)
        if not len(at):
            return [context, symbol, n, low, high]
        return [
            context[at],
            symbol[at],
            np.add.reduceat(n[order], at),
            np.minimum.reduceat(low[order], at),
            np.maximum.reduceat(high[order], at),
        ]

    def batches(self, *labels):
        columns = self.merged()
        for at in range(0, len(columns[0]), 100_000):
            part = [c[at : at + 100_000] for c in columns]
            yield [*([x] * len(part[0]) for x in labels), *part]


def crowded(groups: dict) -> bool:
    """Whether a task holds too many grams, also once equal ones of a group are one.

    Half of ``HELD`` has to be new before they are put together again.
    """
    if sum(g.held for g in groups.values()) <= HELD:
        return False
    for grams in groups.values():
        grams.parts = [grams.merged()]
    return sum(g.held for g in groups.values()) > HELD // 2


GRAMS = "lang string, context long, symbol long, n long, low long, high long"


def count_wide(batches):
    """Language, gram, how often this task has seen it, and the range of texts that have it."""
    seen: dict[str, Grams] = {}

    def drained():
        for language, grams in seen.items():
            for columns in grams.batches(language):
                yield pa.record_batch(
                    [pa.array(c) for c in columns], names=[x.split()[0] for x in GRAMS.split(", ")]
                )
        seen.clear()

    for batch in batches:
        for language, rows in by_language(batch):
            column, owner = filled(rows.column("text")), rows.column("owner").to_numpy()
            counts = rows.column("counts").to_numpy(zero_copy_only=False).astype(np.int64)
            for at, stop in chunks(column):
                text, gram, context, symbol = wide_grams(column[at:stop])
                whose, size = owner[at:stop][text], len(context)
                n = np.bincount(gram, counts[at:stop][text], size).astype(np.int64)
                low = np.full(size, np.iinfo(np.int64).max)
                high = np.full(size, np.iinfo(np.int64).min)
                np.minimum.at(low, gram, whose)
                np.maximum.at(high, gram, whose)
                seen.setdefault(language, Grams()).add(context, symbol, n, low, high)
        if crowded(seen):
            yield from drained()
    yield from drained()


def count_others(bits: bytes):
    """The same of the rows that are not marked, in one worker: two in a row would each hold memory."""
    others = some_rows(bits, False)

    def run(batches):
        return count_wide(others(batches))

    return run


def task_counts(told: DataFrame, bits: bytes) -> DataFrame:
    """``GRAMS`` of every task: unmarked texts where they are read, one of each marked text."""
    several = told.mapInArrow(rested(some_rows(bits, True)), told.schema)
    return told.mapInArrow(rested(count_others(bits)), GRAMS).unionByName(
        several.dropDuplicates(["owner", "g"]).mapInArrow(rested(count_wide), GRAMS)
    )


def ask(batches):
    """Chunk, language and gram, once or a few times for each task that reads the chunk."""
    open_: dict[tuple, Grams] = {}

    def asked():
        for (chunk, language), own in open_.items():
            for columns in own.batches(chunk, language):
                yield pa.record_batch(
                    [pa.array(c) for c in columns[:4]], names=["chunk", "lang", "context", "symbol"]
                )
        open_.clear()

    for batch in batches:
        chunk_of = batch.column("chunk")
        for chunk in pc.unique(chunk_of).to_pylist():
            for language, rows in by_language(batch.filter(pc.equal(chunk_of, chunk))):
                column = filled(rows.column("text"))
                for at, stop in chunks(column):
                    _, _, context, symbol = wide_grams(column[at:stop])
                    n = np.ones(len(context), np.int64)
                    open_.setdefault((chunk, language), Grams()).add(context, symbol, n, n, n)
        if crowded(open_):
            yield from asked()
    yield from asked()


def shut(batches):
    """Rows of each chunk as one compressed Arrow stream, or as a few."""
    open_: dict[int, list] = {}
    held = 0

    def streams():
        for chunk, parts in open_.items():
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
            # One block, so that all its texts are compressed together.
            table = pa.Table.from_batches(parts).combine_chunks()
            with pa.ipc.new_stream(sink, table.schema, options=options) as to:
                to.write_table(table)
            yield pa.record_batch(
                [pa.array([chunk]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                names=["chunk", "rows"],
            )
        open_.clear()

    for batch in batches:
        chunk_of = batch.column("chunk")
        for chunk in pc.unique(chunk_of).to_pylist():
            rows = batch.filter(pc.equal(chunk_of, chunk)).drop_columns(["chunk"])
            open_.setdefault(chunk, []).append(rows)
            held += rows.nbytes
        if held > CHUNK:
            yield from streams()
            held = 0
    yield from streams()


def answer(carried: list[str]):
    """Chunks and the scores of their grams -> measures and score of each row."""

    def scored(language: str, column: pa.Array, scores: pa.Table) -> np.ndarray:
        own = scores.filter(pc.equal(scores.column("lang"), language))
        keys = gram_key(own.column("context").to_numpy(), own.column("symbol").to_numpy())
        order = np.argsort(keys)
        keys, score = keys[order], own.column("score").to_numpy()[order]
        found = np.full(len(column), np.nan)
        for at, stop in chunks(column):
            text, gram, context, symbol = wide_grams(column[at:stop])
            if not len(text):
                continue
            wanted = gram_key(context, symbol)
            place = np.searchsorted(keys, wanted)
            if not len(keys) or not (keys[np.minimum(place, len(keys) - 1)] == wanted).all():
                raise RuntimeError("a chunk holds a gram that it has not asked for")
            n = np.bincount(text, minlength=stop - at)
            sums = np.bincount(text, score[place][gram], minlength=stop - at)
            found[at:stop] = np.where(n > 0, -sums / np.maximum(n, 1), np.nan)
        return found

    def run(streams: pa.Table, scores: pa.Table) -> pa.Table:
        made = []
        for stream in streams.column("rows").to_pylist():
            batches = pa.ipc.open_stream(stream)
            for batch in batches:
                for language, rows in by_language(batch):
                    column = filled(rows.column("text"))
                    counted = [
                        np.concatenate(x)
                        for x in zip(*(measures(column[a:b]) for a, b in chunks(column)))
                    ]
                    own = [rows.column(n) for n in carried]
                    made.append(
                        pa.table(
                            [
                                pa.StructArray.from_arrays(own, names=carried),
                                pa.array([language] * len(rows)),
                                *map(pa.array, counted),
                                pa.array(scored(language, column, scores), from_pandas=True),
                            ],
                            names=["row", "lang", *MEASURES, "log_perplexity"],
                        )
                    )
        return pa.concat_tables(made)

    return run


def gram_scores(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts of 4-grams -> ``lang, context, symbol, score``: log probabilities without own grams.

    ``counts`` is discarded. Also the stage that holds the scores.
    """
    levels = {ORDER: counts}
    for level in range(ORDER - 1, 0, -1):
        shorter = F.col("context").bitwiseAND(F.lit((1 << (WIDE * (level - 1))) - 1))
        levels[level] = durable(
            levels[level + 1]
            .groupBy("lang", shorter.alias("context"), "symbol")
            .agg(
                F.sum((F.col("n") > 0).cast("long")).alias("n"),
                F.min("low").alias("low"),
                F.max("high").alias("high"),
            ),
            f"grams{level}",
        )
    # All symbols that a language has are alike at first, and so is one that it has not.
    lower, consumed = None, []
    sizes = levels[1].groupBy("lang").agg((1 / (F.count("*") + 1.0)).alias("q"))
    for level in range(1, ORDER + 1):
        times = [F.sum((F.col("n") == k).cast("double")).alias(f"t{k}") for k in (1, 2, 3, 4)]
        y = F.expr("CASE WHEN t1 + 2 * t2 > 0 THEN t1 / (t1 + 2 * t2) ELSE 0.5 END")
        discount = [
            F.when(F.col(f"t{k}") > 0, k - (k + 1) * y * F.col(f"t{k + 1}") / F.col(f"t{k}"))
            for k in (1, 2, 3)
        ]
        discounts = levels[level].groupBy("lang").agg(*times).select(
            "lang",
            *[
                F.greatest(F.lit(0.1), F.least(F.coalesce(d, F.lit(k / 2)), F.lit(k - 0.1))).alias(
                    f"d{k}"
                )
                for k, d in zip((1, 2, 3), discount)
            ],
        )
        n = F.col("n")
        d = (
            F.when(n == 0, 0.0)
            .when(n == 1, F.col("d1"))
            .when(n == 2, F.col("d2"))
            .otherwise(F.col("d3"))
        )
        grams = levels[level].join(F.broadcast(discounts), "lang").select(
            "lang", "context", "symbol", "n", "low", "high", d.alias("d")
        )
        contexts = grams.groupBy("lang", "context").agg(
            F.sum("n").alias("total"),
            F.sum("d").alias("spared"),
            (F.min("low") == F.max("high")).alias("own_context"),
        )
        grams = grams.join(contexts, ["lang", "context"])
        if level == 1:
            below = grams.join(F.broadcast(sizes), "lang").withColumn("s", F.log("q"))
        else:
            rest = F.col("context").bitwiseAND(F.lit((1 << (WIDE * (level - 2))) - 1))
            below = grams.withColumn("rest", rest).join(lower, ["lang", "rest", "symbol"])
        # A context of no counted text, or of one text alone, passes all its weight on.
        share = F.when(F.col("total") > 0, F.col("spared") / F.col("total")).otherwise(1.0)
        seen = F.when(F.col("total") > 0, (n - F.col("d")) / F.col("total")).otherwise(0.0)
        p = seen + share * F.col("q")
        weight = F.when(F.col("own_context"), 0.0).otherwise(F.log(share))
        score = F.when(F.col("low") == F.col("high"), weight + F.col("s")).otherwise(F.log(p))
        made = durable(
            below.select("lang", "context", "symbol", p.alias("q"), score.alias("s")), f"level{level}"
        )
        discard(levels[level], *consumed)
        consumed = [made]
        lower = made.withColumnRenamed("context", "rest")
    return made.select("lang", "context", "symbol", F.col("s").alias("score")), made


def with_chunks(rows: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``rows`` with the ``chunk`` that each is in, and a stage that has been written for it, if any.

    A row is told by its file and place, so every scan finds the same chunks, however files are split.
    """
    written = []
    try:
        place = rows.select("*", "_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        # These rows are not read straight from Parquet.
        written = [durable(rows, "rows")]
        place = written[0].select("*", "_metadata.file_path", "_metadata.row_index")
    size = F.octet_length("text")
    total = place.agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).first()
    mean = max(1.0, (total["bytes"] or 0) / max(1, total["n"]))
    longer = F.greatest(F.lit(0), F.floor(F.log(16.0, F.coalesce(size, F.lit(0)) / mean + 1e-9)))
    step = F.greatest(F.lit(1), F.floor(F.lit(CHUNK / mean) / F.pow(F.lit(16.0), longer)))
    chunk = F.xxhash64("file_path", longer, F.floor(F.col("row_index") / step))
    return place.select(*rows.columns, chunk.alias("chunk")), written


def with_scores(documents: DataFrame, carried: list[str]):
    """``row`` (a struct of ``carried``), language, measures and log perplexity of each row.

    Also the limits of marks, and the stages to discard once the rows are written.
    """
    needed = list(dict.fromkeys([*carried, "text", "lang"]))
    rows, written = with_chunks(documents.select(needed))
    language = F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang")
    texts = rows.filter("text <> ''").select("text", "chunk", language)
    numbered = texts.select(
        "lang",
        "text",
        F.xxhash64("lang", "text").alias("owner"),
        F.xxhash64("text", "lang").alias("g"),
        mark_share().alias("share"),
    )
    limits = durable(most_marks(numbered), "limits")
    bits = copied(numbered)
    told = numbered.join(limits, "lang").select(
        "lang", "text", "owner", "g", (F.col("share") <= F.col("limit")).alias("counts")
    )
    counts = durable(
        task_counts(told, bits)
        .groupBy("lang", "context", "symbol")
        .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")),
        "ngrams",
    )
    scored, last = gram_scores(counts)
    asked = texts.mapInArrow(
        rested(ask), "chunk long, lang string, context long, symbol long"
    )
    scores = asked.join(scored, ["lang", "context", "symbol"])
    fields = [T.StructField("row", T.StructType([documents.schema[n] for n in carried]))]
    fields += [T.StructField("lang", T.StringType())]
    fields += [T.StructField(n, T.LongType()) for n in MEASURES]
    fields += [T.StructField("log_perplexity", T.DoubleType())]
    found = (
        rows.mapInArrow(rested(shut), "chunk long, rows binary")
        .groupBy("chunk")
        .cogroup(scores.groupBy("chunk"))
        .applyInArrow(rested(answer(carried)), T.StructType(fields))
    )
    return found, limits, [last, *written]


def judged_rows(
    documents: DataFrame, carried: list[str], spread: float = SPREAD, least: float = LEAST
) -> DataFrame:
    """``row`` (a struct of ``carried``), measures, score and verdict for each row of ``documents``."""
    ship(documents.sparkSession)
    small_batches(documents.sparkSession)
    scores, limits, consumed = with_scores(documents, carried)
    judged = durable(scores, "judged")
    discard(*consumed)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    judged = judged.withColumn("base_failed", failed)
    few = F.col("n_symbols") <= F.col("limit") * F.col("n_chars")
    different = (
        judged.filter(~failed & F.col("log_perplexity").isNotNull())
        .join(limits, "lang")
        .filter(few)
        .select("lang", "n_words", "log_perplexity")
        .distinct()
    )
    at = F.percentile_approx("log_perplexity", F.array(*map(F.lit, (0.25, 0.5, 0.75))), 10_000)
    bands = different.groupBy("lang").agg(at.alias("at")).select(
        "lang",
        (
            F.col("at")[1] - F.greatest(F.lit(least), spread * (F.col("at")[1] - F.col("at")[0]))
        ).alias("lower"),
        (
            F.col("at")[1] + F.greatest(F.lit(least), spread * (F.col("at")[2] - F.col("at")[1]))
        ).alias("upper"),
    )
    inside = F.col("log_perplexity").between(F.col("lower"), F.col("upper"))
    return judged.join(F.broadcast(bands), "lang", "left").withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    )


def quality(documents: DataFrame, spread: float = SPREAD, least: float = LEAST) -> DataFrame:
    """``doc_id``, language, measures, score and verdict for each row of ``documents``."""
    return judged_rows(documents, ["doc_id"], spread, least).select(
        "row.doc_id", "lang", *MEASURES, "log_perplexity", "base_failed", "kept"
    )


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    judged = quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.exp("log_perplexity").alias("perplexity"),
    )
