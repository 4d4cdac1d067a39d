"""Odd rows, empty tables and planted cases for every operator."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("cyclemart.llm")
import corpus_pipeline  # noqa: E402
from cyclemart.llm.components import connected_components  # noqa: E402
from cyclemart.llm.decontamination import Decontamination, align, contaminated_pairs, decontaminated, hashed_words  # noqa: E402
from cyclemart.llm.html_text import extracted, main_text  # noqa: E402
from cyclemart.llm.licenses import PHRASES, TEMPLATES, license_scan  # noqa: E402
from cyclemart.llm.mixing import Mixing, meet, mixed, taken_rows  # noqa: E402
from cyclemart.llm.near_duplicates import NearDuplicates, deduplicated, near_duplicate_components  # noqa: E402
from cyclemart.llm.preferences import preference_pairs  # noqa: E402
from cyclemart.llm.quality_rules import quality_rules  # noqa: E402
from cyclemart.llm.ring import Ring, assign, sharded  # noqa: E402
from cyclemart.llm.token_counts import Unigram, token_counts, trie_counts  # noqa: E402
from cyclemart.llm.url_filters import UrlRule, filtered, host_rule  # noqa: E402
from tests.llm.helpers import empty_documents, odd_documents, prose, words  # noqa: E402


def items(spark):
    rows = [(1, prose(12, 40)), (2, None), (3, ""), (None, prose(77, 30)), (1, prose(12, 40)), (4, "two words")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_quality_rules_on_odd_documents(spark):
    found = quality_rules(odd_documents(spark)).collect()
    assert len(found) == 15
    for r in found:
        own = words(r.text)
        assert (r.n_words, r.word_chars) == (len(own), sum(map(len, own)))
        fives = [tuple(own[i:i + 5]) for i in range(len(own) - 4)]
        twice = {f for f in set(fives) if fives.count(f) > 1} if len(own) < 1000 else set()
        if len(own) < 1000:
            assert r.n_repeat_words == len({i + k for i, f in enumerate(fives) if f in twice for k in range(5)})
        lines = [x for x in (r.text or "").split("\n") if words(x)]
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.kept == (not r.broken_rules)
    assert quality_rules(empty_documents(spark)).count() == 0


def brute_classes(docs, n, percent):
    sets = []
    for d, t in docs:
        own = [w.encode().lower() for w in words(t)]
        sets.append(({tuple(own[i:i + n]) for i in range(len(own) - n + 1)} or {tuple(own)}) if own else set())
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    smallest = {}
    for (d, _), x in zip(docs, label, strict=True):
        smallest[x] = d if smallest.get(x) is None else min(d, smallest[x]) if d is not None else smallest[x]
    return sorted(((d, len(s), smallest[x]) for (d, _), s, x in zip(docs, sets, label, strict=True)), key=str)


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_match_brute_force(spark, n):
    base = prose(3, 120).split()
    edited = [" ".join(w if (i * 37 + k * 11) % (9 + k) else f"x{k}" for i, w in enumerate(base)) for k in range(14)]
    chain = [" ".join(base[k * 6:k * 6 + 80]) for k in range(6)]
    texts = edited + chain + [f"{k} b c d e f g h i" for k in range(4)] + ["one", "One", "two"]
    plain = [(100 + i, t) for i, t in enumerate(texts)]
    odd = [(r.doc_id, r.text) for r in odd_documents(spark).collect()]
    docs = spark.createDataFrame(plain + odd, "doc_id long, text string")
    found = near_duplicate_components(docs, NearDuplicates(shingle=n)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute_classes(plain + odd, n, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_deduplicated_keeps_one_of_each_class(spark):
    docs = odd_documents(spark)
    left = deduplicated(docs, NearDuplicates(shingle=5)).collect()
    ids = [r.doc_id for r in left]
    assert ids.count(6) == 1 and 7 not in ids and 11 not in ids and ids.count(8) == 1 and {1, 2, 3, 4, 5, 9, 10, 12} <= set(ids)
    assert set(left[0].asDict()) == set(docs.columns)
    assert deduplicated(empty_documents(spark)).count() == 0


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(200, 200), (7, 3), (3, 7)]
    found = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[100 + i] == 100 for i in range(30)) and found[200] == 200


def test_decontamination_of_edited_copies(spark):
    item = prose(77, 30).split()
    edited = [w if i % 5 else "changed" for i, w in enumerate(item)]
    shorter = item[:12] + item[14:]
    rows = [(1, " ".join(["start"] * 50 + edited + ["end"] * 9)), (2, "x " * 200 + " ".join(shorter)), (3, prose(5, 3000)),
            (4, ("~ ".join(item)).upper()), (5, None), (None, " ".join(item)), (6, " ".join(item[:6])), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tests = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in contaminated_pairs(docs, tests).collect()}
    assert set(found) == {(1, 9), (2, 9), (4, 9), (None, 9)}
    assert (found[4, 9].first_word, found[4, 9].last_word) == (0, 29) and found[2, 9].last_word == 200 + 27
    assert {r.doc_id for r in decontaminated(docs, tests).collect()} == {3, 5, 6, 7}


def test_decontamination_finds_every_edited_copy_beside_exact_ones(spark):
    p = Decontamination()
    item = prose(77, 40).split()
    texts = [item] * 12
    for every in (3, 4, 5, 6):  # words replaced, left out and put in, at every offset
        for offset in range(every):
            texts.append([w if i % every != offset else f"new{i}" for i, w in enumerate(item)])
            texts.append([w for i, w in enumerate(item) if i % every != offset])
            texts.append([x for i, w in enumerate(item) for x in ([w] if i % every != offset else [w, f"new{i}"])])
    numbers = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    as_numbers = [np.array([numbers[w] for w in t], np.uint64) for t in (item, *texts)]
    close = {i for i, t in enumerate(as_numbers[1:]) if align(as_numbers[0], t, p)[0] >= p.match * p.share * len(item)}
    before, after = prose(3, 90), prose(4, 90)
    docs = spark.createDataFrame([(i, f"{before} {' '.join(t)} {after}") for i, t in enumerate(texts)], "doc_id long, text string")
    found = contaminated_pairs(docs, spark.createDataFrame([(9, " ".join(item))], "item_id long, text string"))
    assert {r.doc_id for r in found.collect()} == close and len(close) > 50


def test_decontamination_of_short_items(spark):
    question = "what is the capital of france and spain".split()
    items = [(n, " ".join(question[:n])) for n in range(2, 9)] + [(1, "Lutetia"), (20, "which of these rivers flows through the old town of Bern")]
    docs = [(100 + n, f"We asked {' '.join(question[:n])}, zero") for n in range(2, 9)]
    docs += [(1, "Old Lutetia!"), (2, "see what is the matter; what was the capital city"), (3, "the capital of Peru is what we mean"),
             (4, "through the old town of the north"), (5, "Which of those rivers flows through the old town of Bern"), (6, prose(5, 300)), (7, "what")]
    found = contaminated_pairs(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    expected = {(100 + n, k) for n in range(2, 9) for k in range(2, n + 1)} | {(1, 1), (5, 20), (2, 2), (2, 3)}
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected


def test_decontamination_of_odd_rows(spark):
    docs = odd_documents(spark)
    assert {r.doc_id for r in contaminated_pairs(docs, items(spark)).collect()} == {12}
    clean = decontaminated(docs, items(spark))
    assert clean.columns == docs.columns and clean.count() == 14
    assert contaminated_pairs(empty_documents(spark), items(spark)).count() == 0
    assert contaminated_pairs(docs, items(spark).limit(0)).count() == 0


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 4), max_size=9), st.lists(st.integers(0, 4), max_size=12))
def test_alignment_matches_the_plain_table(a, b):
    p = Decontamination()
    h, best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            step = p.match if a[i - 1] == b[j - 1] else p.mismatch
            h[i][j] = max(0, h[i - 1][j - 1] + step, h[i - 1][j] + p.gap, h[i][j - 1] + p.gap)
            best = max(best, h[i][j])
    if b:
        assert align(np.array(a, np.uint64), np.array(b, np.uint64), p)[0] == best


def test_mixing_of_odd_documents(spark):
    docs = odd_documents(spark)
    found = mixed(docs).collect()
    assert len(found) == 15 and all(0 <= r.copies <= 3 and (r["size"] or not r.copies) for r in found)
    by = {}
    for r in found:
        s = by.setdefault(r.source, [0, r.target, 0])
        s[0] += r.copies * r["size"]
        s[2] = max(s[2], r["size"])
    assert len(by) == 3 and all(abs(taken - target) <= largest for taken, target, largest in by.values())
    assert taken_rows(docs).columns == docs.columns
    assert taken_rows(docs).count() == sum(r.copies for r in found)
    assert mixed(empty_documents(spark)).count() == 0


def test_mixing_does_not_depend_on_batches_and_takes_more_buckets_for_more_rows(spark):
    docs = [(i, "w " * (1 + i % 7), "ab"[i % 3 == 0]) for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")

    def copies(p):
        return {r.doc_id: (r.copies, r.source, r["size"], r.target) for r in mixed(frame, p).collect()}

    whole = copies(Mixing(buckets=4, fan_in=4))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert copies(Mixing(buckets=4, fan_in=4)) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert copies(Mixing(buckets=1, fan_in=4, bucket_rows=150)) == whole  # 600 rows in four buckets
    for found in (whole, copies(Mixing(buckets=1, fan_in=4, bucket_rows=10))):
        assert len(found) == len(docs)
        for source in "ab":
            rows = [r for r in found.values() if r[1] == source]
            assert abs(sum(c * n for c, _, n, _ in rows) - rows[0][3]) <= 7


@settings(deadline=None, max_examples=100)
@given(st.floats(0.01, 0.99), st.integers(1, 500), st.floats(0.01, 0.99), st.integers(1, 500))
def test_a_meeting_keeps_words_and_expectations(a, m, b, n):
    up = min((1 - a) * m, b * n)
    down = min(a * m, (1 - b) * n)
    first, second = meet(a, m, b, n, 0.0), meet(a, m, b, n, 0.9999999)
    for x, y in (first, second):
        assert (x in (0.0, 1.0) or y in (0.0, 1.0)) and abs(x * m + y * n - a * m - b * n) < 1e-6
    chance = down / (up + down)
    assert abs(chance * first[0] + (1 - chance) * second[0] - a) < 1e-9


def test_sharding_of_odd_documents(spark):
    docs = odd_documents(spark)
    found = sharded(docs, Ring(shards=4)).collect()
    counts = [sum(r.shard == s for r in found) for s in range(4)]
    assert len(found) == 15 and max(counts) - min(counts) <= 1
    assert sorted((r.shard, r.slot) for r in found) == [(s, i) for s in range(4) for i in range(counts[s])]
    assert sharded(empty_documents(spark)).count() == 0


def test_one_more_shard_moves_a_small_part():
    counts = np.random.default_rng(1).poisson(30, (8192, 8))

    def place(shards):
        out = {}
        for cell, lane, first, end, shard, _ in assign(counts, Ring(shards=shards)):
            for i in range(first, end):
                out[cell, lane, i] = shard
        return out

    before, after = place(24), place(25)
    moved = sum(after[k] != s for k, s in before.items()) / len(before)
    assert len(before) == counts.sum() and moved < 0.35  # dealing out by number would move 96 %


def test_token_counts_of_odd_documents(spark):
    vocabulary = Unigram({"▁": -3.0, "a": -2.0, "ab": -2.5, "▁a": -2.2, "b": -4.0, "abc": -9.0}, -20.0)
    docs = odd_documents(spark).selectExpr("doc_id", "text", "n_words", "n_chars AS n_tokens")
    found = token_counts(docs, vocabulary).collect()
    assert len(found) == 15 and all(r.n_tokens == 0 for r in found if r.doc_id in (1, 2, 3))
    assert next(r.n_tokens for r in found if r.doc_id == 9) == 1 + 2 * 3000
    assert token_counts(docs.limit(0), vocabulary).count() == 0


@settings(deadline=None, max_examples=80)
@given(st.lists(st.text("abc▁é", min_size=1, max_size=9), max_size=12))
def test_trie_counts_match_every_segmentation(texts):
    known = Unigram({"▁": -3.1, "a": -2.03, "ab": -2.57, "▁a": -2.2, "b": -4.4, "bca": -5.7, "abc": -9.9}, -20.0)

    def plain(word):
        best = [(0.0, 0)]
        for i in range(1, len(word) + 1):
            n = len(word[i - 1].encode())
            ways = [(best[i - 1][0] - 20.0 * n, -best[i - 1][1] - n)]
            ways += [(best[j][0] + known.scores[word[j:i]], -best[j][1] - 1) for j in range(i) if word[j:i] in known.scores]
            score, pieces = max(ways)
            best.append((score, -pieces))
        return best[-1][1]

    distinct = sorted(set(texts))
    assert trie_counts(distinct, known, known.longest) == [plain(w) for w in distinct]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="menu-page">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies.</div>
<div id="wrap"><article><header><h1>Head &amp; line</h1></header><p>First  para<b>graph</b>\n here.<p>Short.
<div class="ad">Buy!</div><aside>Aside</aside><form><input><p>Mail</p></form><ul><li>One</li><li>Two</li></ul>
<script>var a="</p><p>no";</script><p>Last &lt;one&gt; &#233;&nbsp;x.</p></article>
<section id="comments"><p>Nice article, I liked every single word of this very long comment.</p></section></div>
<footer>&copy; Site</footer></body></html>"""


def test_main_text_of_a_full_page():
    assert main_text(PAGE) == "Head & line\nFirst paragraph here.\nShort.\nOne\nTwo\nLast <one> é x."


@pytest.mark.parametrize("page", [
    "<html><head><title>T</title><body><article><p>Text.</p></article>", "<html><head><title>T</title><article><p>Text.</article>",
    "<head><meta charset=x><noscript><img src=x></noscript><script>1</script><p>Text.", "<title>T</title><head><base>Text.", "<html><head>\n<style>p</style>\n<main>Text.</main>",
])
def test_main_text_when_head_and_body_tags_are_left_out(page):
    assert main_text(page) == "Text."


@pytest.mark.parametrize("inner,text", [
    ('<section id="discussion"><h2 id="cookies">Cookies</h2><p>We ate.</p></section>', "Cookies\nWe ate."),
    ('<h2 class="related">Related work</h2><p id="notice">Note.</p>', "Related work\nNote."),
    ("<p>Energy <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation>E=m</annotation></math> done.", "Energy E=m done."),
    ('<p>One.</p><div id="comments"><p>First!</p></div><div class="ad">Buy</div><p>Two.', "One.\nTwo."),
    ("<ul><li>One<li>Two<ul><li>Deep</ul><li>Three</ul>", "One\nTwo\nDeep\nThree"), ("<dl><dt>A<dd>B<dt>C<dd>D</dl>", "A\nB\nC\nD"),
    ("<table><tr><td>A<td>B<tr><td><table><tr><td>C</table><td>D</table>", "A\nB\nC\nD"),
])
def test_main_text_keeps_what_an_article_holds(inner, text):
    assert main_text(f"<body><article>{inner}</article><footer>F</footer></body>") == text


@pytest.mark.parametrize("tag", ["<li>x", "<div>x", "<a href=y>x", "<td>x", "<p><b>x", "<span>x</i>", "<!-- a --!>x", "<h2><a>x"])
def test_main_text_is_linear_in_tags(tag):
    import time

    main_text(tag * 1000)
    start = time.process_time()
    assert main_text("<body>" + tag * 30_000).count("x") > 0
    assert time.process_time() - start < 15


def test_main_text_without_an_article():
    page = "<body><div class='sidebar'><p>Links</p></div><div><h2>Title</h2><p>" + "Long text. " * 30 + "</p><p>End.</p></div><div><a href=x>more</a></div></body>"
    assert main_text(page) == "Title\n" + " ".join(["Long text."] * 30) + "\nEnd."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &am", "plain &am"), ("<p>a<p>b<", "a\nb"), ("<p>a</p><scr", "a"), ("<p>a</p><!-- b", "a"),
    ("<script>x", ""), ("<p>1 < 2</p>", "1 < 2"), ("<p>" + "x " * 100_000 + "</p>", "x " * 99_999 + "x"),
])
def test_main_text_of_odd_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page", [
    "<script><!-- var a=1; </script><article><p>Text.</p></article>", "<script>var a='<!--';</script><article><p>Text.</p></article>",
    "<!-- a --!><article><p>Text.</p></article>", "<article><p>Text.</p></article><!-- b <p>c</p>", "<style><!-- p{} </style><article>Text.</article><di",
    "<!-- a --><article><p>Text.</p></article><script>var b='<!--'; c<",
])
def test_main_text_leaves_comments_to_the_parser(page):
    assert main_text(page) == "Text."


@pytest.mark.parametrize("open_tag, close_tag", [
    ("<div class='content no-sidebar'><article>", "</article></div>"), ("<main class='has-sidebar'>", "</main>"), ("<main id=comments>", "</main>"),
    ("<div id='content-with-sidebar'>", "</div>"), ("<article class='post comments-open'>", "</article>"), ("<article class='share'>", "</article>"),
    ("<div class='sidebar'><div><article>", "</article></div></div>"),
])
def test_main_text_keeps_wrappers_and_articles(open_tag, close_tag):
    text = " ".join(["Long text."] * 30)
    marked = "<div class='cookie-notice'>Yes?</div><div class='ad-slot-3'>Buy!</div><ul id='share-buttons'><li>Share</li></ul>"
    assert main_text(f"<body>{marked}{open_tag}<p>{text}</p>{marked}<p>End.</p>{close_tag}</body>") == f"{text}\nEnd."


def test_main_text_leaves_out_listed_articles_and_comments():
    page = ("<main><p>" + "Long text. " * 30 + "</p><ol class='comment-list'><li><article class='comment'><p>I liked it.</p></article></li></ol></main>"
            "<div class='related-posts'><article><p>" + "Other text. " * 30 + "</p></article></div>")
    assert main_text(page) == " ".join(["Long text."] * 30)


def test_extracted_keeps_rows_and_columns(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 5), (1, "u", PAGE, 5), (None, None, None, None)], "page_id long, url string, html string, text int")
    found = extracted(pages).collect()
    assert sorted(r.n_chars for r in found) == [0, 64, 64] and found[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    assert extracted(pages.limit(0)).count() == 0


def test_license_scan_of_odd_documents(spark):
    found = license_scan(odd_documents(spark)).collect()
    assert len(found) == 15 and all((r.n_base, r.labels, r.score) == (0, "", 0.0) for r in found)
    assert license_scan(empty_documents(spark)).count() == 0


def test_license_scan_finds_edited_templates(spark):
    grant = ("Permission is hereby granted, free of charge, to any person obtaining one copy of this software "
             "and of associated documentation files (the \"Software\")")
    rows = [(1, "mit license MIT LICENSE"), (2, prose(4, 300) + " " + grant), (3, "the general public\n\nlicense"), (4, "mitlicense mit licenses"),
            (5, "Released under the MIT License. " + prose(1, 40) + " Licensed under the Apache License, Version 2.0.")]
    found = {r.doc_id: r for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (found[1].n_base, found[1].first_word, found[1].last_word, found[1].base_labels) == (2, 0, 2, "mit")
    assert (found[2].base_labels, found[2].labels) == ("", "mit") and 0.6 <= found[2].score < 1
    assert found[3].labels == "gpl" and found[4].labels == ""
    assert found[5].labels == "apache,mit" and found[5].score == 1.0 and found[5].n_words == 53


@pytest.mark.parametrize("lines", [(
    ("Licensed under CC BY-NC 4.0.", "cc"), ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
    ("Released under the MIT License.", "mit"), ("Licensed under the Apache License, Version 2.0.", "apache"),
    ("Photos: CC BY 2.5", "cc"), ("text is under CC-BY-SA 3.0", "cc"), ("(CC BY-NC-ND)", "cc"), ("Licensed under CC BY.", "cc"), ("CC0 1.0 Universal", "cc"),
    ("licensed under a Creative Commons Attribution-ShareAlike License", "cc"), ("SPDX-License-Identifier: MIT", "mit"),
    ("// SPDX-License-Identifier: Apache-2.0", "apache"), ("SPDX-License-Identifier: GPL-3.0-only", "gpl"), ("SPDX-License-Identifier: CC0-1.0", "cc"),
)])
def test_license_scan_finds_each_license_line(spark, lines):
    docs = [(i, f"{prose(i, 30)}\n{line}\n{prose(i + 50, 30)}") for i, (line, _) in enumerate(lines)]
    found = license_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert all(lines[r.doc_id][1] in r.labels.split(",") and r.score >= 0.6 for r in found)


def test_license_scan_takes_no_license_for_another(spark):
    lines = [
        ("The album was released under the band's own label", ""), ("released under the terms of the truce", ""), ("released under the title Mit", ""),
        ("Licensed under the Mozilla Public License, Version 2.0", "mpl"), ("This work is licensed under the Mozilla Public License version 2", "mpl"),
        ("This work is licensed under a commercial license", ""), ("Licensed under the Open Software License version 3.0", ""),
        ("You may not use this file except in compliance with the License. You can obtain a copy of the license at opensource.org/licenses/CDDL-1.0", ""),
        ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation", ""),
        ("SPDX-License-Identifier: ISC", ""), ("SPDX-License-Identifier: MPL-2.0", "mpl"),
    ]
    own = [(t[1], t[0]) for t in TEMPLATES]
    docs = [(i, f"{prose(i, 30)}\n{line}\n{prose(i + 50, 30)}") for i, (line, _) in enumerate(lines + own)]
    found = {r.doc_id: r.labels for r in license_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    named = [{label} | {base for phrase, base in PHRASES if phrase in line.lower()} for line, label in own]  # LGPL and AGPL name the GPL
    assert [found[i] for i in range(len(docs))] == [label for _, label in lines] + [",".join(sorted(x)) for x in named]


def test_license_scan_of_a_text_full_of_license_lines(spark):
    """Spans of one passage are verified in one go; where a template's ends stand, its score is the best alignment with the whole text."""
    lists = {
        1: [f"pkg{i} Licensed under the Apache License, Version 2.0" for i in range(20_000)],
        2: [f"{i} SPDX-License-Identifier: MIT" for i in range(5_000)],
        3: [f"p{i} Licensed under the Apache License, our Version 2.0" for i in range(300)],
        4: ["This program and accompanying materials are made available under the Eclipse Public License terms"] * 50,
    }
    docs = [(i, "\n".join(lines)) for i, lines in lists.items()]
    found = {r.doc_id: r for r in license_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, text in docs:
        words = hashed_words(pa.array([text if i > 2 else text[-20_000:]]))[0]  # one stretch of equal lines is as good as all
        best = {}
        for t in TEMPLATES:
            item, needed = hashed_words(pa.array([t[1], t[2]]))
            if " ".join(map(str, needed)) in " ".join(map(str, words)):
                best[t[0]] = max(best.get(t[0], 0.0), align(item, words, Decontamination(gap=-1))[0] / (2 * len(item)))
        own = {label: share for label, share in best.items() if share >= 0.6}
        assert set(found[i].labels.split(",")) == set(own) | set(filter(None, found[i].base_labels.split(",")))
        assert found[i].score == max(own.values())


def test_url_filter_of_odd_urls(spark):
    urls = [None, "", "no scheme.com/", "http://A.COM/x?q#f", "http://com", "http://b.com?x=/", "ftp://x.example.com/en/", "http://notcom/",
            "http://www.example.com/en/1", "http://example.com/en", "x://y://z.com/"]
    rules = (host_rule("allow", "com", "/"), host_rule("block", "example.com", "/en/"), host_rule("allow", "www.example.com", "/en/"))
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate([*urls, urls[3]])], "page_id long, url string, rule string")
    found = {r.page_id: (r.host, r.path, r.rule, r.rule_verdict) for r in filtered(pages, rules).collect()}
    none = (None, None)
    assert [found[i] for i in range(12)] == [
        ("", "", *none), ("", "", *none), ("", "", *none), ("a.com", "/x", "com/", "allow"), ("com", "", *none), ("b.com", "", *none),
        ("x.example.com", "/en/", "example.com/en/", "block"), ("notcom", "/", *none),
        ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("example.com", "/en", "com/", "allow"), ("y:", "//z.com/", *none),
        ("a.com", "/x", "com/", "allow"),
    ]
    assert filtered(pages.limit(0), rules).count() == 0 and filtered(pages, ()).count() == 12


def test_preference_pairs_of_odd_conversations(spark):
    schema = "pair_id long, turn long, role string, text string, prompt string"
    chosen = [(1, 0, "user", "q", "z"), (1, 0, "user", "q", "z"), (1, 1, "assistant", "a <|end|>", "z"), (2, 0, None, None, "z"), (3, 0, "user", "same", "z"),
              (3, 1, "assistant", "same", "z"), (None, 0, "user", "n", "z"), (4, None, "user", "m", "z"), (4, 2, "assistant", "é" * 50_000, "z")]
    rejected = [(1, 0, "user", "q", "z"), (1, 1, "assistant", "b", "z"), (1, 2, "user", "more", "z"), (3, 0, "user", "same", "z"), (3, 1, "assistant", "same", "z"),
                (4, None, "user", "m", "z")]
    found = {r.pair_id: r for r in preference_pairs(spark.createDataFrame(chosen, schema), spark.createDataFrame(rejected, schema)).collect()}
    assert found[1].prompt == "<|user|>\nq<|end|>\n" and found[1].prompt_turns == 1
    assert found[1].chosen == "<|assistant|>\na < |end|><|end|>\n" and found[1].rejected == "<|assistant|>\nb<|end|>\n<|user|>\nmore<|end|>\n"
    span = found[1].rejected_spans[0]
    assert len(found[1].rejected_spans) == 1 and found[1].rejected[span.start:span.end] == "b<|end|>\n"
    assert found[2].chosen == "<||>\n<|end|>\n" and found[2].rejected == "" and found[2].chosen_spans == []
    assert found[3].chosen == found[3].rejected == "" and found[3].prompt_turns == 2
    assert found[None].chosen == "<|user|>\nn<|end|>\n"
    assert found[4].prompt_turns == 1 and found[4].chosen_spans[0].end == len(found[4].chosen)
    none = spark.createDataFrame([], schema)
    assert preference_pairs(none, none).count() == 0


def test_pipeline_stages_on_odd_documents(spark, tmp_path):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    odd = odd_documents(spark)
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        after = function(spark, docs, str(tmp_path))
        assert after.columns == odd.columns if k < 4 else {"shard", "slot", *odd.columns} == set(after.columns)
        after.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert function(spark, spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0), str(tmp_path)).count() == 0
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert ids <= {5, 6, 8, None} and not ids & {7, 11, 12}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_rules_without_literal_tokens_are_fetched_for_every_url(spark):
    rules = (UrlRule("ads", "block", "/ads", (), 4), UrlRule("deep", "block", "^[^/]*(/[^/]*){4}", (), 5), host_rule("allow", "ok.com", "/"), host_rule("block", "--", "/"))
    urls = [None, "", "http://x.com/ads", "http://x.com/a", "http://ok.com/ads", "http://y.org/1/2/3/4", "no scheme/ads", "http://--/x", "http://ads.com/"]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    for asked in (rules, rules[:1], rules[2:]):
        for r in filtered(frame, asked).collect():
            fitting = [(x.weight, x.verdict == "block", x.name) for x in asked if re.search(x.pattern, r.host + r.path)]
            assert r.rule == (max(fitting)[2] if fitting else None), (r, asked)
