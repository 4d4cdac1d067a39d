"""Ranked search against scoring every document."""

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("cyclemart.llm")
from cyclemart.llm import ranked_search  # noqa: E402
from cyclemart.llm.ranked_search import Shard, ranked  # noqa: E402
from tests.llm.helpers import alphanumeric, empty_documents, odd_documents, prose  # noqa: E402

NAMED = "item_id long, text string"


def brute(docs, items, k):
    """(item, rank, doc, score), item by item, every document scored."""
    held = [(d, Counter(alphanumeric(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    asked, out = {}, []
    for i, t in items:
        asked.setdefault(i, set()).update(alphanumeric(t))
    for i, terms in asked.items():
        scores = []
        for (d, c), n in zip(held, sizes, strict=True):
            score = 0
            for t in terms & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + 50 * n * n_docs // n_terms
                score += w * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, d is None, d if d is not None else 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(docs, items, **options):
    return sorted((tuple(r) for r in ranked(docs, items, **options).collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(
    postings=st.dictionaries(st.tuples(st.integers(0, 5), st.integers(0, 300)), st.integers(1, 40), max_size=900),
    k=st.integers(1, 8), floor=st.integers(0, 300), weights=st.lists(st.integers(0, 9), min_size=7, max_size=7),
)
def test_reading_down_the_lists_finds_all_of_the_best(postings, k, floor, weights):
    flat = np.array([(t, d, i) for (t, d), i in postings.items()], np.int64).reshape(-1, 3)
    shard = Shard(flat[:, 0], flat[:, 1], flat[:, 2])
    docs, scores, _ = shard.top(np.arange(7), np.array(weights), k, floor)
    true = Counter()
    for (t, d), i in postings.items():
        true[d] += weights[t] * i
    kth = max([floor, *sorted(true.values(), reverse=True)[k - 1:k]])
    assert dict(zip(docs.tolist(), scores.tolist(), strict=True)) == {d: s for d, s in true.items() if s >= kth and s > 0}


def test_best_positions_stop_before_the_ends():
    r = np.random.default_rng(4)
    impacts = np.sort(r.integers(1, 1000, 20_000))[::-1]
    # both lists order the documents alike, so what one list meets is marked in the other
    shard = Shard(np.repeat([1, 2], 20_000), np.tile(np.arange(20_000), 2), np.concatenate([impacts, impacts]))
    docs, scores, n_read = shard.top(np.array([1, 2]), np.array([3, 5]), 50, 0)
    assert n_read < 1000 and len(docs) >= 50 and scores.max() == 8 * impacts[0]
    assert shard.top(np.array([1, 2]), np.array([3, 5]), 50, 8 * int(impacts[0]) + 1)[2] <= 2 * ranked_search.FIRST_STEP


@pytest.mark.parametrize("shard,block", [(1_000_000, 100_000), (40, 7)])
def test_odd_documents_against_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", block)
    docs = odd_documents(spark).selectExpr("*", "1 AS doc", "'z' AS terms", "0L AS n_terms", "3 AS rank", "'s' AS score")
    items = [(1, prose(6, 20)), (2, None), (3, ""), (None, "the CAT"), (1, "éé ß word"), (4, prose(6, 20)), (5, "nowhere"), (None, "house")]
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    frame = spark.createDataFrame(items, NAMED)
    for k in (2, 50):
        assert found(docs.repartition(3), frame, k=k) == brute(plain, items, k)


def test_ties_go_by_key_and_repeated_rows_count(spark):
    rows = [(d, "alpha beta gamma") for d in (9, 3, 7, 3, None, 5)] + [(100 + i, f"filler{i} words") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = [(1, "alpha alpha BETA"), (2, "words")]
    assert found(docs, spark.createDataFrame(items, NAMED), k=4) == brute(rows, items, 4)
    assert [r[2] for r in found(docs, spark.createDataFrame(items[:1], NAMED), k=6)] == [3, 3, 5, 7, 9, None]


def test_terms_that_all_documents_hold_weigh_nothing(spark):
    rows = [(i, "same words here") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs, spark.createDataFrame([(1, "same words")], NAMED)) == brute(rows, [(1, "same words")], 50) == []


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "the cat")], NAMED)
    assert found(empty_documents(spark), items) == [] == found(odd_documents(spark), items.limit(0))
    assert ranked(empty_documents(spark), items).columns == ["item_id", "rank", "doc_id", "score"]
    blank = spark.createDataFrame([(1, None), (2, " - ")], "doc_id long, text string")
    assert found(blank, items) == []


def test_lengths_beyond_64_bits_are_exact():
    scoring = ranked_search.Scoring(4 * 10**11, 10**15)
    n = np.array([10**9, 3], np.int64)
    assert scoring.lengths(n).tolist() == [50 + 50 * 10**9 * 4 * 10**11 // 10**15, 50]
