"""The operators against brute force on small tables with nulls, ties, repeats and clashing names."""

import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from public_tokenizers import path as vocabulary_file
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import ball_tree, byte_pairs, html_text, language, licenses, packing, quality
from millrace.llm import url_filter
from millrace.llm.components import components
from millrace.llm.jaccard_join import near_duplicates
from millrace.llm.substring_dedup import remove_repeats
from millrace.llm.textkit import words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, n_words string, score string, batch string"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def some_documents():
    rng = random.Random(5)
    words = [("" .join(rng.choice("abcdeéß中") for _ in range(rng.randint(1, 7)))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 120))) for _ in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(50))
    texts += [f"{a}\n{passage}\t{b}" for a, b in zip(texts[:8], texts[8:16])]
    texts += [passage, passage + " " + passage, texts[0], texts[0], texts[0].upper(), "", None, " \n\t "]
    for text in texts[20:30]:
        own = text.split()
        if own:
            own[rng.randrange(len(own))] = "other"
        texts.append("  ".join(own))
    texts += ["a b c", "A  b c", "word", "x y   z", "line\nline\nline\n\nend", "#*$ %&| <>"]
    texts.append(" ".join(rng.choice(words) for _ in range(20_000)))
    texts.append("a" * 10_000)
    return list(enumerate(texts)) + [(0, texts[0])]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, "en" if i % 3 else None, "x", "y", "z") for i, t in some_documents()]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(documents):
    return documents.limit(0)


def test_words_are_those_of_the_pattern():
    for text in ["", "a", " a", "a ", "é ü", "a b\x0bc\x1cd", "\n\n", "中 文"]:
        data = np.frombuffer(text.encode(), np.uint8)
        words = words_of(data, np.array([0, len(data)]))
        found = [data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends)]
        assert found == WORD.findall(text)


def test_packing_places_every_token(documents, nothing):
    tokenizer = Tokenizer.from_file(vocabulary_file("word_bpe_49k.json"))
    found = packing.pack(documents, group=40, most_open=16).collect()
    expected = Counter()
    for i, text in some_documents():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            expected[i, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(nothing).count() == 0


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    fit = packing.BestFit(10, 2)
    assert [fit.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    fit = packing.BestFit(10, 2)
    for size in (6, 7, 8):
        fit.place(size)
    assert fit.closed == [(1, 3)]
    assert fit.place(4) == (0, 6)


def test_quality_counts(documents, nothing):
    found = {r.doc_id: r for r in quality.quality(documents).collect()}
    for i, text in some_documents():
        text = text or ""
        words = WORD.findall(text)
        windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        covered = [False] * len(words)
        for k in range(len(words) - 4):
            if windows[tuple(words[k : k + 5])] > 1:
                covered[k : k + 5] = [True] * 5
        lines = [x for x in text.split("\n") if WORD.search(x)]
        row = found[i]
        assert (
            row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words
        ) == (
            len(words),
            sum(map(len, words)),
            sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)),
            sum(covered),
        )
        assert row.base_failed == (len(words) < 10 or 100 * sum(covered) > 20 * len(words))
        assert not (row.base_failed and row.kept)
    assert quality.quality(nothing).count() == 0


def brute_force_scores(texts, plain):
    """Interpolated modified Kneser-Ney over code points, by dictionaries; own grams are unseen."""
    tables = [Counter()]
    owners = [{}]
    for i, text in enumerate(texts):
        codes = (0, 0, 0, *(ord(c) + 1 for c in text))
        for k in range(len(text)):
            gram = codes[k : k + 4]
            tables[0][gram] += plain[i]
            owners[0].setdefault(gram, set()).add(i)
    for _ in range(3):
        shorter, whose = Counter(), {}
        for gram, n in tables[-1].items():
            shorter[gram[1:]] += n > 0
            whose.setdefault(gram[1:], set()).update(owners[-1][gram])
        tables.append(shorter)
        owners.append(whose)
    q, s = {(): 1 / (len(tables[3]) + 1)}, {(): math.log(1 / (len(tables[3]) + 1))}
    for table, whose in zip(tables[::-1], owners[::-1]):
        times = [sum(n == k for n in table.values()) for k in range(5)]
        y = times[1] / (times[1] + 2 * times[2]) if times[1] + times[2] else 0.5
        spare = [0.0] + [
            min(max(k - (k + 1) * y * times[k + 1] / times[k] if times[k] else k / 2, 0.1), k - 0.1)
            for k in (1, 2, 3)
        ]
        contexts: dict = {}
        for gram, n in table.items():
            own = contexts.setdefault(gram[:-1], [0, 0.0, set()])
            own[0] += n
            own[1] += spare[min(n, 3)]
            own[2] |= whose[gram]
        lower_q, lower_s, q, s = q, s, {}, {}
        for gram, n in table.items():
            total, spared, of = contexts[gram[:-1]]
            share = spared / total if total else 1.0
            below = gram[1:] if len(gram) > 1 else ()
            q[gram] = (n - spare[min(n, 3)]) / total * (total > 0) + share * lower_q[below] if total else lower_q[below]
            weight = 0.0 if len(of) == 1 else math.log(share)
            s[gram] = weight + lower_s[below] if len(whose[gram]) == 1 else math.log(q[gram])
    found = []
    for text in texts:
        codes = (0, 0, 0, *(ord(c) + 1 for c in text))
        found.append(-sum(s[codes[k : k + 4]] for k in range(len(text))) / len(text))
    return found


def test_perplexities_equal_brute_force(spark, tmp_path):
    rng = random.Random(8)
    words = ["ab", "ba", "cab", "中b", "é", "#a"]
    texts = sorted({" ".join(rng.choice(words[:5]) for _ in range(rng.randint(1, 30))) for _ in range(20)})
    texts += ["## ab $$ cab ##", "ab #a ba #a", "ab"]
    plain = [sum(c in "#$" for c in t) <= 0.01 * len(t) for t in texts]
    expected = brute_force_scores(texts, plain)
    # Every third text in three rows, in one file and in many.
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    rows += [(100 * k + i, t, "en") for k in (1, 2) for i, t, _ in rows[::3]]
    rows += [(1000, "", "en"), (1001, None, None)]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for files in (1, 5):
        path = str(tmp_path / f"docs{files}")
        made.repartition(files).write.parquet(path)
        got = {r.doc_id: r.log_perplexity for r in quality.quality(spark.read.parquet(path)).collect()}
        assert len(got) == len(rows) and got[1000] is None and got[1001] is None
        for i, _, _ in rows[:-2]:
            assert abs(got[i] - expected[i % 100]) < 1e-9


def test_texts_that_share_a_bit_with_a_copied_one_are_counted_once(spark, monkeypatch):
    rows = [(i, f"text {i % 40}", "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    wide = {r.doc_id: r.log_perplexity for r in quality.quality(docs).collect()}
    monkeypatch.setattr(quality, "copied", lambda texts: b"\xff" * (quality.BITS // 8))
    assert wide == pytest.approx({r.doc_id: r.log_perplexity for r in quality.quality(docs).collect()})


def test_quality_on_one_short_text_null_texts_and_a_short_one_before_a_long(spark):
    for texts in (["short"], [None, None], ["short", "a long text of words " * 15_000]):
        docs = spark.createDataFrame(
            [(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string"
        )
        assert quality.quality(docs).count() == len(texts)
        assert corpus_pipeline.quality_rules(spark, docs, "").columns == docs.columns


def test_perplexity_rejects_noise(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("aeiou") + rng.choice("bdt") for _ in range(3)) for _ in range(80)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(60)), "en") for i in range(300)]
    noise = "".join(chr(rng.randrange(33, 0x2000)) if rng.random() < 0.8 else " " for _ in range(300))
    rows.append((999, noise + " end of it all", "en"))
    judged = quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [r.doc_id for r in judged.filter("not kept").collect()] == [999]


def test_language_network_learns_and_knows_what_it_cannot(spark):
    rng = random.Random(2)
    made = {"aa": "abcdefg", "bb": "tuvwxyzé", "cc": "klmnop中"}
    rows = [
        (i, " ".join("".join(rng.choice(made[k]) for _ in range(5)) for _ in range(30)), k)
        for i, k in enumerate(list(made) * 60)
    ]
    rows += [(900, None, "aa"), (901, "", None), (902, "12 34 ?!", "bb"), (903, rows[1][1], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs.filter(language.fold() != 2), sample=50)
    found = {r.doc_id: r for r in language.predict(docs, model).collect()}
    right = [found[i].lang_pred == k for i, _, k in rows if i < 900 and zlib.crc32(b"%d" % i) % 4 == 2]
    assert np.mean(right) > 0.95
    assert [found[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "bb"]
    assert all(0 <= r.score <= 1 for r in found.values())
    clash = docs.withColumnRenamed("lang", "lang_pred")
    assert language.predict(clash, model, clash.columns).columns == ["doc_id", "text", "lang_pred", "score"]
    assert language.fit(docs.limit(0)) is None
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0


def shingles(text, size):
    words = WORD.findall(lower(text or ""))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def linked(rows, size, per_cent):
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= per_cent * (len(sets[a] | sets[b])):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("size,per_cent", [(4, 85), (5, 80)])
def test_jaccard_join_of_texts(documents, nothing, size, per_cent):
    found = near_duplicates(documents, size, per_cent).collect()
    assert len(found) == len(some_documents())
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert got == linked(some_documents(), size, per_cent)
    assert near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("light", [0, 14, 20, None])
def test_jaccard_join_on_either_side_of_the_boundary(spark, light):
    rng = random.Random(3)
    base = [[rng.choice("abcdefghij") for _ in range(rng.randint(3, 26))] for _ in range(25)]
    rows = []
    for i in range(250):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            how = rng.random()
            if how < 0.4:
                words.append(rng.choice("klmnop"))
            elif how < 0.7 and len(words) > 1:
                words.pop()
            else:
                words[rng.choice([0, -1])] = rng.choice("xyz")
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, light=light).collect()}
    assert got == linked(rows, 4, 85)


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(10, 60)] + [(3, 3)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(min, groups.values())) == [7, 100]
    assert sorted(map(len, groups.values())) == [51, 61]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_substring_dedup(documents, nothing):
    rows = some_documents()
    texts = [WORD.findall(t or "") for _, t in rows]
    windows = Counter(tuple(w[k : k + 35]) for w in texts for k in range(len(w) - 34))
    expected = Counter()
    for (i, _), words in zip(rows, texts):
        gone = [False] * len(words)
        for k in range(len(words) - 34):
            if windows[tuple(words[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        expected[i, len(words), sum(gone), " ".join(w for w, x in zip(words, gone) if not x)] += 1
    found = remove_repeats(documents, separator=" ")
    assert found.columns[-2:] == ["n_words", "n_removed"]
    assert Counter((r.doc_id, int(r.n_words), r.n_removed, r.text) for r in found.collect()) == expected
    assert sum(n for (_, _, n, _) in expected) > 200
    kept = remove_repeats(documents)
    originals = dict(rows)
    for r in kept.collect():
        if not r.n_removed:
            assert r.text == originals[r.doc_id]
    assert remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("shard,block", [(4096, 4096), (40, 7)])
def test_ball_tree(spark, shard, block):
    rng = np.random.default_rng(4)
    rows = rng.integers(-20, 20, (300, 6))
    rows[100:200] = rows[100]
    items = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, v array<long>")
    found = ball_tree.top_products(items, items.filter("vec_id % 20 = 0"), 5, shard, block).collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    for q in range(0, 300, 20):
        scores = rows @ rows[q]
        best = sorted((i for i in range(300) if i != q), key=lambda i: (-scores[i], i))[:5]
        assert got[q] == {k + 1: (i, scores[i]) for k, i in enumerate(best)}


def test_ball_tree_query_leaves_out_broken_vectors(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [0.5, -0.01]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0])]
    rows += [(5, [3.0]), (20, [0.5, -0.01]), (None, [1.0, 1.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(
        str(tmp_path / "embeddings.parquet")
    )
    found = ball_tree.op8_ball_tree(spark, str(tmp_path)).collect()
    assert {tuple(r) for r in found} == {(0, 1, 20, 64 * 32 - 128), (20, 1, 0, 64 * 32 - 128)}


def test_license_scan(documents, nothing, spark):
    assert licenses.scan_licenses(documents).filter("n_base > 0").count() == 0
    assert licenses.scan_licenses(nothing).count() == 0
    rows = [
        (1, "Under the MIT-License!\nunder the mit\nlicense"),
        (2, "Licensed under the Apache License, Version 2.0."),
        (3, "mit der mit license the under"),
        (4, None),
        (5, "cc by nc CC BY-NC"),
        (6, "This work is licensed under the GNU General Public License, version 3."),
        (7, "All rights\nreserved"),
        (8, "under the mitt license"),
    ]
    found = {
        r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)
        for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    }
    assert found[1] == (8, 2, 0, 4, "mit", "mit", 1.0)
    assert found[2] == (8, 1, 3, 3, "apache-2", "apache-2", 1.0)
    assert found[3] == (6, 0, None, None, "", "", 0.0)
    assert found[4] == (0, 0, None, None, "", "", 0.0)
    assert found[5][1:6] == (2, 0, 3, "cc-by-nc", "cc-by-nc")
    assert found[6][4:] == ("", "gpl-3", 1.0)
    assert found[7][5] == found[8][5] == ""


def test_byte_pairs_equal_the_library(documents, nothing, spark):
    tokenizer = Tokenizer.from_file(vocabulary_file("byte_bpe_50k.json"))
    rng = random.Random(6)
    letters = "abcXYZ ÉéßÀÿ ³½'’s'll've 12٣ \t\n   \x1c\x85\x00 ΣςİıǅDŽ ﬁ 한국 漢字 😀👍🏽 !?.#$ aaaa"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["a<|endoftext|>b <|endoftext|> c", "a" * 1000, " " * 50, "\n\n a\n", None]
    odd = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for docs, rows in ((documents, some_documents()), (odd, list(enumerate(texts)))):
        found = {r.doc_id: r for r in byte_pairs.encode(docs).collect()}
        for i, text in rows:
            ids = tokenizer.encode(text or "", add_special_tokens=False).ids
            row = found[i]
            assert (row.n_tokens, row.ids) == (len(ids), ",".join(map(str, ids)))
            assert row.decoded == tokenizer.decode(ids, skip_special_tokens=False)
    assert byte_pairs.encode(nothing).count() == 0
    assert byte_pairs.as_digests("1,2", "é") == tuple(
        hashlib.sha256(x.encode()).hexdigest() for x in ("1,2", "é")
    )


PAGE = """<!DOCTYPE html><html><head><title>no</title><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="cookie-notice">We use cookies, many of them, to make this site better for you.</div>
<article><h1>The  title</h1><p><b>First &amp; foremost,<br>a paragraph that says a few things.
<p>Second one, with a <a href="x">link</a> in it.</p><!-- not this --><ul><li>one<li>two</ul>
<div class="advert">Buy now</div></article>
<div id="comments"><p>A long comment by a reader who has much to say about all of this.</p></div>
<aside>More</aside><form>Name <input></form><footer>&copy; us</footer></body></html>"""


@pytest.mark.parametrize(
    "page,text",
    [
        (PAGE, "The title\nFirst & foremost, a paragraph that says a few things.\n"
               "Second one, with a link in it.\none\ntwo"),
        (None, ""), ("", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>a<p>b", "a\nb"),
        ("<script>x", ""), ("<div>" * 3000 + "deep", "deep"), ("<p>" + "<b>" * 3000 + "x", "x"),
    ],
)
def test_main_text_of_a_page(page, text):
    assert html_text.extract(page) == text


def test_main_text_of_pages(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.main_text(pages).collect()
    assert sorted(r.page_id for r in found) == [1, 1, 2]
    assert all(r.n_chars == len(r.text) and bool(r.text) == (r.page_id == 1) for r in found)
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_url_rules_and_templates(spark):
    urls = [None, "", "x.com/a", "HTTP://WWW.Example.COM/en/1?x#y", "http://a.com", "http://a.net/fr/x",
            "http://example.com/en/", "http://xnet/es/1", "http://q/" + "/".join("abcdefghijkl")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()}
    assert found == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("", "", None, "allow"),
        3: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        4: ("a.com", "", None, "allow"), 5: ("a.net", "/fr/x", "net/fr/", "block"),
        6: ("example.com", "/en/", "example.com/en/", "block"), 7: ("xnet", "/es/1", None, "allow"),
        8: ("q", "/a/b/c/d/e/f/g/h/i/j/k/l", None, "allow"),
    }
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_templates_learn_from_labelled_pages(spark):
    rules = [(f"h/spam/{100 + i}", "block") for i in range(40)]
    rules += [(f"h/news/{100 + i}", "allow") for i in range(40)]
    urls = [f"http://h/{kind}/{100 + i}" for kind in ("spam", "news") for i in range(60)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: r for r in url_filter.judge_urls(pages, rules).collect()}
    assert {found[i].template for i in range(60)} == {"/spam/#"}
    assert [found[i].rule for i in (50, 110)] == [None, None]
    assert [found[i].verdict for i in (50, 110)] == ["block", "allow"]


def test_url_filter_runs_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    plan = url_filter.judge_urls(pages)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_decoded_references_are_the_standard_ones():
    assert html_text.extract("<p>&eacute;&#x4e2d;&#20013;&nbsp;x</p>") == html.unescape(
        "&eacute;&#x4e2d;&#20013; x"
    )
