r"""License scan: fixed phrases, and an exact containment join of text blocks with notice templates.

Blocks are stretches of ``STRETCH`` times a template's words, anywhere in a text and across its lines, as
sets of lower-case words. A block contains a template if it has at least ``CONTAINMENT`` of the
template's different words. The join is a prefix-filtered one: words are ordered by the number of
documents that have them, over the whole corpus, rarest first. A block that reaches the threshold has
one of a template's first few words in that order (``|T| - need + 1`` of them), so only the words around
such a word are looked at; where too few of them are the template's it is out by position, and then
the blocks around are counted out one by one. Templates of up to ``SHORT`` words have to stand on one
line. Every template that a block contains counts, also one whose words are all among another's.

Only counts of template words travel: their frequencies are summed up by Spark, and the templates,
a parameter, are the only thing that is broadcast.

Defined cases: a null text has no words; repeated rows are scanned each; other columns take no part;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import LOWER, chunks, filled, ship, text_bytes, words_of

#: Label and words of each base phrase.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
#: Notices in common use, by label.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files to deal in the software without restriction",
    ),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    (
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ),
    (
        "cc-by-nc",
        "this work is licensed under a creative commons attribution noncommercial 4 0 "
        "international license",
    ),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    ("all-rights-reserved", "all rights reserved"),
]
CONTAINMENT = 0.9
STRETCH = 1.25
SHORT = 3

#: Bytes outside ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` once A-Z are lower-cased.
BREAKS = np.zeros(256, bool)
BREAKS[:128] = True
for _first, _last in ((48, 57), (65, 90), (97, 122)):
    BREAKS[_first : _last + 1] = False


class Vocabulary:
    """Words of phrases and templates, found in texts by hash and confirmed by their letters."""

    def __init__(self, phrases, templates):
        self.words = sorted({w for _, t in [*phrases, *templates] for w in t.split()})
        number = {w: i for i, w in enumerate(self.words)}
        data = np.frombuffer(" ".join(self.words).encode(), np.uint8)
        hashes = words_of(data, np.array([0, len(data)]), BREAKS, lower=True).hashes
        order = np.argsort(hashes)
        self.hashes, self.number = hashes[order], order
        self.phrases = [(x, [number[w] for w in t.split()]) for x, t in phrases]
        self.templates = [(x, sorted({number[w] for w in t.split()})) for x, t in templates]
        self.sizes = [len(t.split()) for _, t in templates]

    def find(self, data, words) -> np.ndarray:
        """The number of each word of a text, -1 for those in no phrase or template."""
        at = np.minimum(np.searchsorted(self.hashes, words.hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words.hashes, self.number[at], -1)

    def is_word(self, data, start: int, end: int, number: int) -> bool:
        return LOWER[data[start:end]].tobytes().decode("utf-8", "replace") == self.words[number]


def document_frequencies(vocabulary: Vocabulary):
    """Texts -> number of a word, and how many of the task's texts have it."""

    def run(batches):
        total = np.zeros(len(vocabulary.words), np.int64)
        for batch in batches:
            column = filled(batch.column("text"))
            for at, stop in chunks(column):
                data, offsets = text_bytes(column[at:stop])
                words = words_of(data, offsets, BREAKS, lower=True)
                number = vocabulary.find(data, words)
                known = number >= 0
                pairs = np.unique(words.text[known] * len(total) + number[known])
                total += np.bincount(pairs % len(total), minlength=len(total))
        yield pa.record_batch(
            [pa.array(np.arange(len(total))), pa.array(total)], names=["word", "texts"]
        )

    return run


class Join:
    """Templates with their words in global frequency order and the filters of the join."""

    def __init__(self, vocabulary: Vocabulary, texts: dict[int, int], containment: float):
        self.vocabulary = vocabulary
        self.templates = []
        self.sizes = [int(np.ceil(STRETCH * n)) for n in vocabulary.sizes]
        # The last place is that of the words of no template, which have the number -1.
        self.is_start = np.zeros(len(vocabulary.words) + 1, bool)
        for label, words in vocabulary.templates:
            ordered = sorted(words, key=lambda w: (texts.get(w, 0), w))
            need = int(np.ceil(containment * len(ordered) - 1e-9))
            self.templates.append((label, ordered, need))
            self.is_start[ordered[: len(ordered) - need + 1]] = True

    def of_words(self, number, text_bounds, line_bounds):
        """Template, containment, first and last word of each stretch that contains a template.

        ``number`` has the words of some texts; the bounds are those of each word's text and line.
        """
        starts = np.flatnonzero(self.is_start[number])
        for i, (label, ordered, need) in enumerate(self.templates):
            own = np.zeros(len(self.is_start), bool)
            own[ordered] = True
            inside = own[number]
            first = np.zeros(len(self.is_start), bool)
            first[ordered[: len(ordered) - need + 1]] = True
            at = starts[first[number[starts]]]
            if not len(at):
                continue
            size = self.sizes[i]
            low, high = line_bounds if len(ordered) <= SHORT else text_bounds
            begin, end = np.maximum(at - size + 1, low[at]), np.minimum(at + size, high[at])
            before = np.r_[0, np.cumsum(inside)]
            able = before[end] - before[begin] >= need
            for a, b in zip(begin[able].tolist(), end[able].tolist()):
                places = (a + np.flatnonzero(inside[a:b])).tolist()
                best = self.best(places, number[places].tolist(), size)
                if best[0] >= need:
                    yield label, best[0] / len(ordered), best[1], best[2]

    @staticmethod
    def best(places: list[int], words: list[int], size: int) -> tuple[int, int, int]:
        """The most different words in ``size`` places in a row, and the first and last of those."""
        counts: dict[int, int] = {}
        most, left = (0, 0, 0), 0
        for right, word in enumerate(words):
            counts[word] = counts.get(word, 0) + 1
            while places[right] - places[left] >= size:
                counts[words[left]] -= 1
                if not counts[words[left]]:
                    del counts[words[left]]
                left += 1
            if len(counts) > most[0]:
                most = len(counts), places[left], places[right]
        return most


SCANNED = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, blocks array<string>"
)
NAMES = [x.split()[0] for x in SCANNED.split(", ")]
TYPES = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64(), pa.list_(pa.string())]


def scan(join: Join):
    vocabulary = join.vocabulary

    def base(data, words, number):
        """Text, label and first word of every place of a phrase."""
        for label, phrase in vocabulary.phrases:
            last = len(number) - len(phrase) + 1
            if last <= 0:
                continue
            here = np.ones(last, bool)
            for k, word in enumerate(phrase):
                here &= number[k : k + last] == word
            for i in np.flatnonzero(here).tolist():
                text = int(np.searchsorted(words.first, i, "right")) - 1
                inside = i + len(phrase) <= words.first[text + 1]
                if inside and all(
                    vocabulary.is_word(data, words.starts[i + k], words.ends[i + k], w)
                    for k, w in enumerate(phrase)
                ):
                    yield text, label, i - int(words.first[text])

    def run(batches):
        for batch in batches:
            column = filled(batch.column("text"))
            for at, stop in chunks(column):
                data, offsets = text_bytes(column[at:stop])
                words = words_of(data, offsets, BREAKS, lower=True)
                number = vocabulary.find(data, words)
                n = stop - at
                places: list[list[int]] = [[] for _ in range(n)]
                labels: list[set] = [set() for _ in range(n)]
                own: list[set] = [set() for _ in range(n)]
                score = [0.0] * n
                blocks: list[list[str]] = [[] for _ in range(n)]
                for text, label, place in base(data, words, number):
                    places[text].append(place)
                    labels[text].add(label)
                    score[text] = 1.0
                text = words.text
                edges = np.union1d(np.flatnonzero(data == 10), offsets)
                line = np.searchsorted(edges, words.starts, "right")
                bounds = [
                    (np.searchsorted(x, x), np.searchsorted(x, x, "right")) for x in (text, line)
                ]
                stretches: list[set] = [set() for _ in range(n)]
                for label, share, a, b in join.of_words(number, *bounds):
                    own[text[a]].add(label)
                    score[text[a]] = max(score[text[a]], share)
                    stretches[text[a]].add((int(words.starts[a]), int(words.ends[b])))
                for of, parts in zip(blocks, stretches):
                    of += [data[a:b].tobytes().decode("utf-8", "replace") for a, b in sorted(parts)]
                columns = [
                    batch.column("doc_id")[at:stop],
                    words.counts.astype(np.int64),
                    [len(p) for p in places],
                    [min(p, default=None) for p in places],
                    [max(p, default=None) for p in places],
                    [",".join(sorted(x)) for x in labels],
                    [",".join(sorted(x | y)) for x, y in zip(labels, own)],
                    score,
                    blocks,
                ]
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(columns, TYPES)], names=NAMES
                )

    return run


def scan_licenses(
    documents: DataFrame,
    phrases: list[tuple[str, str]] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Places of phrases, labels and the blocks that contain a template, for each row."""
    ship(documents.sparkSession)
    texts = documents.select("doc_id", "text")
    vocabulary = Vocabulary(phrases, templates)
    counted = (
        texts.mapInArrow(document_frequencies(vocabulary), "word long, texts long")
        .groupBy("word")
        .agg(F.sum("texts").alias("texts"))
    )
    # One row for each word of the templates.
    frequencies = {r["word"]: r["texts"] for r in counted.collect()}
    return texts.mapInArrow(scan(Join(vocabulary, frequencies, containment)), SCANNED)


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("blocks")
