"""Katz back-off against plain dictionaries, and the sums of its probabilities."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import katz

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, score string, id string, bucket string, n string"


def texts_of(n, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé中") for _ in range(rng.randint(1, 4))) for _ in range(250)]
    weights = [1 / (i + 1) for i in range(len(words))]
    made = [" ".join(rng.choices(words, weights, k=rng.randint(0, 60))) for _ in range(n)]
    made += [made[0], made[0].upper(), "", None, " \n\t ", "neverseen alone", "a", "x" * 5000]
    made.append(" ".join(rng.choices(words, weights, k=5000)))
    return made


def tokens(text):
    lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return [*WORD.findall(lowered), None]


class Plain:
    def __init__(self, texts, cutoff=katz.CUTOFF):
        self.words, self.pairs = Counter(), defaultdict(Counter)
        for text in texts:
            own = tokens(text)
            self.words.update(own)
            for v, w in zip(["start", *own[:-1]], own):
                self.pairs[v if v == "start" and w is own[0] else v][w] += 1
        self.cutoff = cutoff
        self.of_words = self.shares(Counter(self.words.values()))
        self.of_pairs = self.shares(Counter(c for x in self.pairs.values() for c in x.values()))

    def shares(self, n):
        for top in range(self.cutoff, 0, -1):
            if all(n[r] for r in range(1, top + 1)) and (top + 1) * n[top + 1] < n[1]:
                a = (top + 1) * n[top + 1] / n[1]
                d = {r: ((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, top + 1)}
                if all(0 < x < 1 for x in d.values()):
                    return d
        return {}

    def word(self, w):
        total = sum(self.words.values())
        spared = sum(c * (1 - self.of_words.get(c, 1)) for c in self.words.values())
        size = total + (not spared)
        if w not in self.words:
            return (spared or 1) / size
        return self.of_words.get(self.words[w], 1) * self.words[w] / size

    def pair(self, v, w):
        after = self.pairs.get(v)
        if not after:
            return self.word(w)
        spared = sum(c * (1 - self.of_pairs.get(c, 1)) for c in after.values())
        size = sum(after.values()) + (not spared)
        if w in after:
            return self.of_pairs.get(after[w], 1) * after[w] / size
        others = 1 - math.fsum(self.word(x) for x in after)
        return (spared or 1) / size / others * self.word(w)


def train(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 != 1


@pytest.mark.parametrize("share, size", [(katz.SPLIT, katz.BUCKET), (20, 3000), (4, 500)])
def test_scores_equal_plain_ones(spark, share, size):
    rows = [(i, t) for i, t in enumerate(texts_of(60))]
    rows += [rows[0], (1, "another text of one id"), (None, "no id at all"), (None, None)]
    docs = spark.createDataFrame([(*r, "l", "s", "i", "b", "n") for r in rows], DOCS).repartition(3)
    learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    found = katz.katz_scores(docs, learn, bucket=size, share=share).collect()
    model = Plain([t for i, t in rows if train(i)])
    total, distinct = sum(model.words.values()), len(model.words)
    expected = []
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((model.words[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        score = sum(math.log10(model.pair(v, w)) for v, w in zip(["start", *own[:-1]], own))
        known = sum(w in model.words for w in own)
        expected.append((i, train(i), len(own), known, total, base, score))

    def order(row):
        return (-1 if row[0] is None else row[0], row[2], row[5])

    assert len(found) == len(rows)
    for a, b in zip(sorted(found, key=order), sorted(expected, key=order)):
        assert tuple(a)[:5] == b[:5]
        assert a.base_score == pytest.approx(b[5], rel=1e-9)
        assert a.score == pytest.approx(b[6], rel=1e-9, abs=1e-12)


def test_plain_probabilities_add_up():
    model = Plain(texts_of(60))
    everything = [*model.words, "of no text"]
    assert sum(map(model.word, everything)) == pytest.approx(1, abs=1e-12)
    for v in model.pairs:
        assert sum(model.pair(v, w) for w in everything) == pytest.approx(1, abs=1e-9)


def test_no_training_texts_and_no_texts(spark):
    rows = [(1, "some words here", "l", "s", "i", "b", "n"), (2, None, "l", "s", "i", "b", "n")]
    docs = spark.createDataFrame(rows, DOCS)
    found = sorted(katz.katz_scores(docs, F.lit(False)).collect())
    assert [tuple(r) for r in found] == [(1, False, 4, 0, 0, 0.0, 0.0), (2, False, 1, 0, 0, 0.0, 0.0)]
    assert katz.katz_scores(docs.limit(0), F.lit(True)).count() == 0
    ends = sorted(katz.katz_scores(docs.filter("text IS NULL"), F.lit(True)).collect())
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in ends] == [(1, 1, 1)]


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    scored = katz.katz_scores(docs, learn).filter("NOT trains")
    sums = scored.agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_discounts_stay_between_nothing_and_all():
    for counts in ([0] * 7, [0, 5, 0, 0, 0, 0, 0], [0, 100, 40, 20, 12, 8, 6], [0, 1, 100, 1, 1, 1, 1]):
        kept = katz.discounts(np.array(counts))
        assert len(kept) == katz.CUTOFF + 1 and ((kept > 0) & (kept <= 1)).all()
