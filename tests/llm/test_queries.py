"""Queries against their SQL, or against brute force where SQL cannot express them."""

import os
import zlib

import pytest

duckdb = pytest.importorskip("duckdb")
pytest.importorskip("cyclemart.llm")
from cyclemart.llm.registered import QUERIES, SQL  # noqa: E402
from tests.llm.helpers import alphanumeric, words  # noqa: E402
from tests.test_queries import table  # noqa: E402

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="benchmark tables not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "pages", "conversations", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


def rows(spark, name):
    found = QUERIES[name](spark, DATA)
    return [r.asDict() for r in found.collect()]


def test_all_operators_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {"pipeline", *(f"op{i}" for i in range(1, 14))}
    assert set(SQL) == {"op1_quality_rules", "op2_chat_formatting", "op9_url_filters", "op10_near_duplicates", "op12_prefix_trie", "op13_ranked_search"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, DATA)
    ours = table(found.columns, found.collect())
    result = duck.execute(SQL[name])
    theirs = table([d[0] for d in result.description], result.fetchall())
    assert ours == theirs and ours[1]


def test_mixing_meets_targets_and_reruns_agree(spark, documents):
    found = rows(spark, "op3_source_mixing")
    again = rows(spark, "op3_source_mixing")
    by_id = {r["doc_id"]: r for r in found}
    assert {r["doc_id"]: r["taken"] for r in again} == {r["doc_id"]: r["taken"] for r in found}
    sizes = {d: len(words(t)) for d, t, _ in documents}
    assert {d: r["size"] for d, r in by_id.items()} == sizes
    sources = sorted({s for *_, s in documents})
    own = {s: sum(sizes[d] for d, _, x in documents if x == s) for s in sources}
    share = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sources)}
    full, total = set(), sum(own.values())
    while True:
        unit = (total - sum(3 * own[s] for s in full)) / sum(w for s, w in share.items() if s not in full)
        over = {s for s in sources if s not in full and unit * share[s] > 3 * own[s]}
        if not over:
            break
        full |= over
    for s in sources:
        mine = [by_id[d] for d, _, x in documents if x == s]
        target = 3 * own[s] if s in full else unit * share[s]
        assert all(abs(r["target"] - target) < 1e-6 and r["source_size"] == own[s] for r in mine)
        assert all(r["taken"] == r["copies"] * r["size"] <= 3 * r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target) <= max(r["size"] for r in mine)


def test_decontamination_finds_every_copy_and_nothing_else(spark, duck, documents):
    found = rows(spark, "op4_benchmark_decontamination")
    items = [(i, f" {' '.join(alphanumeric(t))} ") for i, t in duck.execute("SELECT item_id, text FROM benchmark").fetchall()]
    held = {(d, i) for d, t, _ in documents for i, item in items if item in f" {' '.join(alphanumeric(t))} "}
    assert {(r["doc_id"], r["item_id"]) for r in found} == held
    assert all(r["share"] == 1.0 for r in found)


def test_token_counts_match_the_public_library(spark, documents):
    from tokenizers import Tokenizer, models

    from cyclemart.llm.op05 import VOCABULARY
    from cyclemart.llm.token_counts import MARK, zipf_vocabulary

    known = zipf_vocabulary(VOCABULARY)
    public = Tokenizer(models.Unigram([("<unk>", -100.0), *known.scores.items()], unk_id=0, byte_fallback=False))
    letters = {c for p in known.scores for c in p}
    found = {r["doc_id"]: r for r in rows(spark, "op5_token_counts")}
    memory, compared = {}, 0
    for doc_id, text, _ in documents:
        own = words(text)
        assert found[doc_id]["n_words"] == len(own)
        if set("".join(own)) <= letters:
            for w in own:
                if w not in memory:
                    memory[w] = len(public.encode(MARK + w, add_special_tokens=False).ids)
            assert found[doc_id]["n_tokens"] == sum(memory[w] for w in own)
            compared += 1
    assert compared > 900


def test_html_extraction_returns_the_article(spark, duck):
    import html
    import re

    pages = dict(duck.execute("SELECT page_id, html FROM pages").fetchall())
    found = rows(spark, "op6_html_extraction")
    assert {r["page_id"] for r in found} == set(pages)
    for r in found:
        inner, _, closed = pages[r["page_id"]].partition("<article>")[2].partition("</article>")
        inner = inner if closed or "</article>" in pages[r["page_id"]] else re.sub(r"<[^<>]*$", "", inner)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_sharding_is_gapless_and_even(spark, documents):
    found = rows(spark, "op7_ring_sharding")
    texts = {d: t.encode() for d, t, _ in documents}
    assert all(r["size"] == len(texts[r["doc_id"]]) + 8 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) for r in found)
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(24)) and sorted(r["doc_id"] for r in found) == sorted(texts)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_license_scan_matches_phrases(spark, documents):
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    found = {r["doc_id"]: r for r in rows(spark, "op8_license_scan")}
    for doc_id, text, _ in documents:
        own, r = alphanumeric(text), found[doc_id]
        places = sorted((i, label) for p, label in phrases.items() for i in range(len(own)) if tuple(own[i:i + len(p)]) == p)
        labels = sorted({label for _, label in places})
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(own), len(places), ",".join(labels))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert set(labels) <= set(r["labels"].split(",")) - {""} or not labels
        assert 0 <= r["score"] <= 1
