"""Counting tasks of the quality rules."""

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import quality


def test_a_task_that_counts_needs_one_worker(spark):
    told = spark.createDataFrame(
        [("en", "abcd", 5, 1, True), ("en", "abcd", 5, 1, True), ("en", "bcde", 6, 2, True)],
        "lang string, text string, owner long, g long, counts boolean",
    )
    bits = bytearray(quality.BITS // 8)
    bits[5 >> 3] |= 1 << 5
    found = quality.task_counts(told, bytes(bits))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 3
    assert {r.owner for r in found.selectExpr("explode(array(low, high)) AS owner").collect()} == {5, 6}
    assert found.agg({"n": "sum"}).first()[0] == 8


def test_equal_grams_of_many_small_batches_do_not_crowd_a_task(monkeypatch):
    monkeypatch.setattr(quality, "HELD", 100)
    context, one = np.arange(10), np.ones(10, np.int64)
    grams = quality.Grams()
    for _ in range(14):
        grams.add(context, context, one, one, one)
    assert not quality.crowded({"en": grams})
    assert grams.held == 10 and (grams.parts[0][2] == 14).all()
    many = np.arange(101)
    grams.add(many, many, many, many, many)
    assert quality.crowded({"en": grams})


@pytest.mark.parametrize("wide", [0, 70_000])
def test_each_gram_of_some_texts_is_there_once(wide):
    many = "".join(map(chr, range(0x10000, 0x10000 + wide)))
    texts = ["abab", "", "\0\0\0a", "\U0010ffffabab" + many, "b\0a" + many[:9], ""]
    text, gram, context, symbol = quality.wide_grams(pa.array(texts, pa.large_string()))
    assert len(set(zip(context.tolist(), symbol.tolist()))) == len(context)
    expected = []
    for i, t in enumerate(texts):
        codes = [0, 0, 0, *[ord(c) + 1 for c in t]]
        for at in range(len(t)):
            a, b, c, d = codes[at : at + 4]
            expected.append((i, a << 42 | b << 21 | c, d))
    assert [*zip(text.tolist(), context[gram].tolist(), symbol[gram].tolist())] == expected


def test_no_text_has_no_gram():
    for texts in ([], [""], ["", ""]):
        found = quality.wide_grams(pa.array(texts, pa.large_string()))
        assert [len(x) for x in found] == [0, 0, 0, 0]
