"""Cases in which an operator once did less than its whole job."""

import random
import re
import time
from collections import Counter

import corpus_pipeline
from millrace.llm import html_text, language, licenses, quality

TEXTS = "doc_id long, text string, lang string"


def plain_texts(n=200):
    rng = random.Random(1)
    words = ["".join(rng.choice("aeiou") + rng.choice("bdt") for _ in range(3)) for _ in range(80)]
    return [" ".join(rng.choice(words) + "#" for _ in range(60)) for _ in range(n)]


def test_language_model_counts_code_points_as_they_are(spark):
    """Marks, digits and scripts that were folded to one symbol are told apart."""
    texts = plain_texts()
    rng = random.Random(2)
    texts.append(texts[0] + " 1")
    texts.append("".join(rng.choice("*$%&|<>") if c == "#" else c for c in texts[0]) + " 1")
    rows = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], TEXTS)
    found = {r.doc_id: r.log_perplexity for r in quality.quality(rows).collect()}
    assert found[201] > found[200] + 0.3

    table = spark.createDataFrame(
        [(t, "en", i, True) for i, t in enumerate(["aб中#1", "Aб中*2", "б\x00"])],
        "text string, lang string, owner long, counts boolean",
    )
    counted = table.mapInArrow(
        quality.count_wide, "lang string, context long, symbol long, n long, low long, high long"
    )
    got = Counter()
    for r in counted.collect():
        back = [(r.context >> (quality.WIDE * k)) & ((1 << quality.WIDE) - 1) for k in (2, 1, 0)]
        got[*back, r.symbol] += r.n
    expected = Counter()
    for text in ("aб中#1", "Aб中*2", "б\x00"):
        codes = [0, 0, 0, *(ord(c) + 1 for c in text)]
        expected.update(tuple(codes[k : k + 4]) for k in range(len(text)))
    assert got == expected


def test_every_template_that_a_notice_contains_is_found(spark):
    notices = [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY 4.0",
        "Licensed under CC BY-SA 4.0",
        "Licensed under CC BY-NC 4.0",
    ]
    rows = spark.createDataFrame(list(enumerate(notices)), "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan_licenses(rows, phrases=[("none", "no such phrase")]).collect()}
    for i, notice in enumerate(notices):
        own = set(re.findall("[a-z0-9]+", notice.lower()))
        shares = {}
        for label, template in licenses.TEMPLATES:
            words = set(template.split())
            share = len(words & own) / len(words)
            if share >= licenses.CONTAINMENT:
                shares[label] = max(share, shares.get(label, 0))
        assert found[i].labels == ",".join(sorted(shares))
        assert abs(found[i].score - max(shares.values())) < 1e-9
    assert "cc-by" in found[0].labels.split(",") and found[0].score == 1.0


def test_notices_over_lines_are_found_and_scattered_words_are_not(spark):
    rng = random.Random(3)
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this\n"
        "software and associated documentation files (the \"Software\"), to deal in the\n"
        "Software without restriction, including without limitation the rights to use"
    )
    texts, expected = [mit, "word " * 40 + mit + " and" * 40], ["mit", "mit"]
    for label, template in licenses.TEMPLATES:
        words = template.split()
        if len(words) > licenses.SHORT:
            texts.append("\n".join(["it", "was", *words, "so", "far"]))
            expected.append(label)
            spread = [w for x in words for w in (x, *["other"] * 30)]
            texts.append(" ".join(rng.sample(spread, len(spread)) if len(words) > 9 else spread))
            expected.append("")
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan_licenses(rows, phrases=[("none", "no such phrase")]).collect()}
    for i, label in enumerate(expected):
        assert (label in found[i].labels.split(",")) and (label != "" or not found[i].blocks), texts[i]
    assert "obtaining a copy of this\nsoftware" in found[0].blocks[0]


def test_names_that_only_mention_a_part_around_do_not_cut_the_text():
    body = "<p>" + "A sentence of the main text, with some words in it. " * 8 + "</p>"
    for name in ("content has-sidebar", "with-sidebar", "no-comments", "layout-header-fixed",
                 "elementor-widget", "header", "comments"):
        page = f'<nav><a href="/">Home</a></nav><div class="{name}"><h1>Title</h1>{body * 2}</div>'
        assert html_text.extract(page).count("main text") == 16, name
    widgets = "".join(f'<div class="elementor-widget">{body}</div>' for _ in range(4))
    assert html_text.extract(f"<div>{widgets}</div>").count("main text") == 32
    for title in ('<header class="entry-header"><h1>Title</h1></header>', '<h1 class="page-header">Title</h1>'):
        page = f'<article>{title}{body}<div class="cookie-notice">We use cookies.</div></article>'
        text = html_text.extract(page)
        assert text.startswith("Title") and "cookies" not in text


def test_a_long_advert_beside_a_short_article_is_cut():
    page = f'<div class="ad">{"Buy this. " * 20}</div><article><h1>Title</h1><p>Few words.</p></article>'
    assert html_text.extract(page) == "Title\nFew words."


def test_copies_of_noise_are_scored_as_one(spark):
    rng = random.Random(4)
    noise = lambda: "".join(chr(rng.randrange(33, 0x2000)) if rng.random() < 0.8 else " " for _ in range(300))
    texts = plain_texts()
    for copies in (1, 2, 10, 100):
        texts += [noise() + " end of it all"] * copies
    rows = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], TEXTS)
    dropped = {r.doc_id for r in quality.quality(rows).filter("not kept").collect()}
    assert dropped == set(range(200, 313))


def test_language_sample_is_a_share_of_different_texts(spark):
    rows = [(i, f"text number {i % 20} of a few", "en") for i in range(4000)]
    docs = spark.createDataFrame(rows, TEXTS)
    languages, x, y = language.training_windows(docs.select("text", "lang"), 100)
    assert languages == ["en"] and len(x) == len(y) == 40
    unnamed = spark.createDataFrame([(1, "a text", None), (2, "12 !", None), (3, None, None)], TEXTS)
    assert [r.doc_id for r in corpus_pipeline.language_id(spark, unnamed, "").collect()] == [1]


PARAGRAPH = "<p>" + "Words of a main text that go on for a while, and then some more of them. " * 4 + "</p>"


def test_main_text_beside_and_inside_of_parts_around_it():
    own = html_text.extract(PARAGRAPH)
    comments = '<div id="comments"><p>' + "Says a reader of this page. " * 90 + "</p></div>"
    notice = '<div class="cookie-notice"><p>' + "We use cookies. " * 90 + "</p></div>"
    for extra in (comments, notice, '<form class="login-form"><p>Log in</p></form>'):
        assert html_text.extract(f"<body><div class=post>{PARAGRAPH}</div>{extra}</body>") == own
    wrapped = f'<body><form id="page"><input name=q><div class=c>{PARAGRAPH}</div></form></body>'
    assert html_text.extract(wrapped) == own
    assert html_text.extract(f"<body><div class=modal>{PARAGRAPH}</div></body>") == own
    titled = (
        f"<div class=post><header><h1>T</h1><p>By X</p></header><div class=b>{PARAGRAPH}</div></div>",
        f"<h1>T</h1><div class=b>{PARAGRAPH}</div>",
    )
    for page in titled:
        assert html_text.extract(f"<body>{page}</body>").split("\n")[0] == "T"


def test_only_a_page_whose_title_stands_in_its_comments_keeps_them():
    comments = f'<div class="comments">{PARAGRAPH}</div>'
    assert html_text.extract(f"<h1>T</h1>{comments}") == "T"
    titled = f'<div class="comments"><h1>T</h1>{PARAGRAPH}<div class="comment">{PARAGRAPH}</div></div>'
    own = html_text.extract(PARAGRAPH)
    assert html_text.extract(titled) == f"T\n{own}"
    assert html_text.extract(f"<div>{PARAGRAPH}</div>{titled}") == own
    assert html_text.extract(f"<div><h1>U</h1></div>{titled}") == "U"


def test_malformed_pages_take_linear_time():
    for page in ("<a ", '<a "', "<a x='", "<!--", "<![CDATA[", "<b></i>", "<div></span>", "<p>x"):
        begun = time.process_time()
        html_text.extract(page * (400_000 // len(page)) + ">")
        assert time.process_time() - begun < 8
