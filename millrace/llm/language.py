"""Language identification by a small convolutional network over bytes.

Each byte has a learned vector; filters of two, three and four bytes run over a window of ``WINDOW``
bytes; each filter keeps its largest response, and a softmax turns those into languages. A text is
cut into consecutive windows over its whole length, and its languages' probabilities are the means
of its windows', weighted by their bytes.

Training is numpy on the driver, on a bounded sample: about ``SAMPLE`` different texts of each
language, two windows each. The sample is drawn by a hash of the text, so a group of copies counts
as one text. The gradient of a maximum reaches one place of each filter only, so a pass costs little
more than the forward one. Prediction runs in tasks, on Arrow batches; byte vectors and filters
are multiplied out into tables of byte pairs once a model, so a response is one or two rows added.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; where no row has a
language every text is; repeated rows are predicted each; other columns take no part; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textkit import chunks, filled, rested, ship, small_batches, text_bytes

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 24
DEPTH = 8
SAMPLE = 1500
#: Counts of different texts are estimates, and so few as the sample are all taken.
MARGIN = 1.1
EPOCHS = 6
RATE = 0.01
SEED = 7
UNKNOWN = "und"


def fold():
    """Which of four parts of the rows a document is in."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))


class Network:
    def __init__(self, languages: list[str], rng: np.random.Generator):
        self.languages = languages
        scale = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.weights = {"bytes": rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32)}
        for w in WIDTHS:
            self.weights[f"filter{w}"] = scale(w * DEPTH, FILTERS).reshape(w, DEPTH, FILTERS)
            self.weights[f"bias{w}"] = np.zeros(FILTERS, np.float32)
        self.weights["out"] = scale(len(WIDTHS) * FILTERS, len(languages))
        self.weights["bias"] = np.zeros(len(languages), np.float32)

    def step(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy of windows ``x`` of languages ``y``."""
        weights, rows = self.weights, np.arange(len(x))
        grads = {k: np.zeros_like(v) for k, v in weights.items()}
        pooled, places = [], []
        for w in WIDTHS:
            tables = weights["bytes"] @ weights[f"filter{w}"]
            n = x.shape[1] - w + 1
            response = tables[0][x[:, :n]]
            for j in range(1, w):
                response += tables[j][x[:, j : j + n]]
            place = response.argmax(axis=1)
            best = np.take_along_axis(response, place[:, None], 1)[:, 0] + weights[f"bias{w}"]
            pooled.append(np.maximum(best, 0))
            places.append(place)
        hidden = np.concatenate(pooled, axis=1)
        error = softmax(hidden @ weights["out"] + weights["bias"])
        error[rows, y] -= 1
        error /= len(x)
        grads["out"], grads["bias"] = hidden.T @ error, error.sum(axis=0)
        back = (error @ weights["out"].T) * (hidden > 0)
        for k, w in enumerate(WIDTHS):
            own = back[:, k * FILTERS : (k + 1) * FILTERS]
            grads[f"bias{w}"] = own.sum(axis=0)
            for j in range(w):
                table = np.zeros((256, FILTERS), np.float32)
                np.add.at(table, (x[rows[:, None], places[k] + j], np.arange(FILTERS)), own)
                grads["bytes"] += table @ weights[f"filter{w}"][j].T
                grads[f"filter{w}"][j] = weights["bytes"].T @ table
        return grads

    def train(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        """Adam over shuffled batches, languages weighted alike."""
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        done, size = 0, 64
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = rng.permutation(len(x))
            for at in range(0, len(x), size):
                part = order[at : at + size]
                done += 1
                for k, g in self.step(x[part], y[part]).items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    move = first[k] / (1 - 0.9**done)
                    self.weights[k] -= rate * move / (np.sqrt(second[k] / (1 - 0.999**done)) + 1e-8)


class Tables:
    """A trained network as sums over tables of byte pairs and bytes."""

    def __init__(self, network: Network):
        self.languages = network.languages
        self.weights = network.weights
        self.made: list | None = None

    def __getstate__(self):
        return self.__dict__ | {"made": None}

    def tables(self) -> list:
        if self.made is None:
            self.made = []
            for w in WIDTHS:
                single = self.weights["bytes"] @ self.weights[f"filter{w}"]
                parts = []
                for j in range(0, w - 1, 2):
                    pair = single[j][:, None, :] + single[j + 1][None, :, :]
                    parts.append((j, True, pair.reshape(-1, FILTERS)))
                if w % 2:
                    parts.append((w - 1, False, single[w - 1]))
                self.made.append((w, parts, self.weights[f"bias{w}"]))
        return self.made

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        found = []
        for at in range(0, len(x), 128):
            part = x[at : at + 128]
            pairs = (part[:, :-1].astype(np.uint16) << 8) | part[:, 1:]
            pooled = []
            for w, parts, bias in self.tables():
                n = x.shape[1] - w + 1
                response = 0
                for j, paired, table in parts:
                    rows = table[(pairs if paired else part)[:, j : j + n]]
                    response = rows if isinstance(response, int) else np.add(response, rows, out=rows)
                pooled.append(np.maximum(response.max(axis=1) + bias, 0))
            hidden = np.concatenate(pooled, axis=1)
            found.append(softmax(hidden @ self.weights["out"] + self.weights["bias"]))
        return np.concatenate(found) if found else np.zeros((0, len(self.languages)), np.float32)

    def of_texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities of each text over its windows, weighted by their bytes."""
        sizes = np.diff(offsets)
        count = -(-sizes // WINDOW)
        text = np.repeat(np.arange(len(sizes)), count)
        begin = offsets[:-1][text] + WINDOW * (np.arange(len(text)) - (np.cumsum(count) - count)[text])
        length = np.minimum(offsets[1:][text] - begin, WINDOW)
        x = np.zeros((len(text), WINDOW), np.uint8)
        inside = np.arange(WINDOW) < length[:, None]
        x[inside] = data[(begin[:, None] + np.arange(WINDOW))[inside]]
        p = self.probabilities(x) * length[:, None]
        total = np.zeros((len(sizes), len(self.languages)))
        np.add.at(total, text, p)
        return total / np.maximum(sizes, 1)[:, None]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def training_windows(labelled: DataFrame, sample: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, and windows of about ``sample`` texts of each: ``labelled`` has text and lang."""
    named = labelled.filter("text IS NOT NULL AND lang IS NOT NULL AND length(text) > 0")
    # A row for each language tag; the texts themselves stay where they are until few are left.
    different = F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("n")
    counts = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(different).collect()}
    languages = sorted(counts)
    if not languages:
        return [], np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64)
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, MARGIN * sample / counts[k])])
    drawn = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000
    room = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    piece = lambda salt: F.substr("text", 1 + F.pmod(F.xxhash64("text", F.lit(salt)), room).cast("int"), F.lit(WINDOW))
    rows = (
        named.filter(drawn)
        .select("lang", F.xxhash64("text").alias("h"), piece(1).alias("a"), piece(2).alias("b"))
        .dropDuplicates(["lang", "h"])
        .orderBy("h", "lang")
        .limit(4 * sample * len(languages))
        .collect()
    )
    x = np.zeros((2 * len(rows), WINDOW), np.uint8)
    y = np.zeros(2 * len(rows), np.int64)
    for i, r in enumerate(rows):
        for k, text in enumerate((r["a"], r["b"])):
            data = text.encode()[:WINDOW]
            # Every fourth window is short, as texts and their last windows are.
            data = data[: 16 + r["h"] % 200] if (i + k) % 4 == 0 else data
            x[2 * i + k, : len(data)] = np.frombuffer(data, np.uint8)
            y[2 * i + k] = languages.index(r["lang"])
    return languages, x, y


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Tables | None:
    languages, x, y = training_windows(labelled, sample)
    if not languages:
        return None
    rng = np.random.Generator(np.random.PCG64(SEED))
    network = Network(languages, rng)
    network.train(x, y, rng)
    return Tables(network)


def predict(
    documents: DataFrame, model: Tables | None, columns: tuple[str, ...] | list[str] = ("doc_id",)
) -> DataFrame:
    """``columns`` of each row of ``documents``, with ``lang_pred`` and ``score``."""
    spark = documents.sparkSession
    ship(spark)
    names = [c for c in columns if c not in ("lang_pred", "score")]
    if model is None:
        return documents.select(
            *names, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")
        )
    small_batches(spark)
    # A text that is carried along is the one that is read: it goes to the worker once.
    at_text = names.index("text") if "text" in names else len(names)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = documents.select(
        F.struct(*names).alias("__row"),
        *([] if "text" in names else [F.col("text").alias("__text")]),
        letters.alias("__letters"),
    )
    kinds = T.StructType(
        [
            *documents.select(*names).schema.fields,
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        network = shared.value
        tags = np.array([*network.languages, UNKNOWN], dtype=object)
        for batch in batches:
            carried = batch.column("__row").flatten()
            column = filled([*carried, batch.column(1)][at_text])
            for at, stop in chunks(column):
                p = network.of_texts(*text_bytes(column[at:stop]))
                known = batch.column("__letters")[at:stop].to_numpy(zero_copy_only=False)
                known = known.astype(bool)
                best = np.where(known, p.argmax(axis=1), len(network.languages))
                score = np.where(known, np.clip(p.max(axis=1), 0, 1), 0.0)
                yield pa.record_batch(
                    [
                        *[c[at:stop] for c in carried],
                        pa.array(tags[best], pa.string()),
                        pa.array(score),
                    ],
                    names=[*names, "lang_pred", "score"],
                )
        network.made = None  # the worker may go on to other tasks

    return rows.mapInArrow(rested(run), kinds)


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    """Learned from three parts of the labelled rows, predicted for all; the fourth is held out."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(documents.filter(F.coalesce(fold() != 2, F.lit(True))).select("text", "lang"))
    return predict(documents, model).select(
        "doc_id",
        F.coalesce(fold() == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )
