"""Tries in double arrays, alone and merged over shards, against plain dictionaries."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("cyclemart.llm")
from cyclemart.llm import prefix_trie  # noqa: E402
from cyclemart.llm.op12 import rebuilt  # noqa: E402
from cyclemart.llm.prefix_trie import TURNS, DoubleArray, conversation_turns, member_lists, prefix_nodes  # noqa: E402

PATHS = st.lists(st.lists(st.integers(0, 6), max_size=7), max_size=40)
SPARSE = st.lists(st.lists(st.integers(0, 4000), max_size=4), max_size=30)
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_chars")


@settings(max_examples=300, deadline=None)
@given(paths=PATHS | SPARSE)
def test_double_array_holds_just_the_paths(paths):
    known = sorted(set(map(tuple, paths)))
    trie = DoubleArray([list(p) for p in known])
    prefixes = {p[:d] for p in known for d in range(len(p) + 1)} | {()}
    slots = {}
    for p in sorted(prefixes):
        *_, slots[p] = trie.walk(list(p))
    assert len(set(slots.values())) == len(prefixes) == len(trie.nodes) and set(trie.nodes) == set(slots.values())
    for p, slot in slots.items():
        assert p == () or trie.check[slot] == slots[p[:-1]]
        for code in range(8):
            assert (trie.child(slot, code) >= 0) == ((*p, code) in prefixes)
    with pytest.raises(KeyError):
        list(trie.walk([9999]))


def test_wide_and_crowded_nodes_are_packed():
    r = random.Random(2)
    paths = sorted({tuple(r.randrange(500) for _ in range(r.randrange(1, 5))) for _ in range(3000)})
    trie = DoubleArray([list(p) for p in paths])
    assert len(trie.nodes) == len({p[:d] for p in paths for d in range(len(p) + 1)})
    assert len(trie.check) < 3 * len(trie.nodes) + 500
    for p in paths:
        assert len(list(trie.walk(list(p)))) == len(p) + 1


def brute(convs):
    """Nodes by (smallest member, depth), and who ends there; ``convs`` has (id, turns as (name, chars))."""
    nodes = {}
    for c, turns in convs:
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    ends = {tuple(t): sorted(c for c, x in convs if list(x) == list(t)) for _, t in convs}
    out = {}
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        childless = [q for q in below if not any(len(x) == len(q) + 1 and x[:len(q)] == q for x in nodes)]
        row = (
            min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), sum(len(q) == len(p) + 1 for q in below), len(childless),
            sum((len(nodes[q]) - 1) * q[-1][1] for q in below if q),
        )
        out[row[:2]] = (row, ends.get(p))
    return out


def check(spark, convs):
    rows = [(c, [(hashlib.md5(str(t).encode()).hexdigest(), t[1]) for t in turns]) for c, turns in convs]
    sequences = spark.createDataFrame(rows, f"conv_id long, turns {TURNS}").repartition(3)
    found = prefix_nodes(sequences).join(member_lists(sequences), "path", "left").collect()
    want = brute(convs)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in found), key=str) == sorted((row for row, _ in want.values()), key=str)
    for r in found:
        ends = want[r.conv_id, r.depth][1]
        assert r.ends_sha256 == (hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest() if ends else None)


@pytest.mark.parametrize("limit", [1, 4, 25, 200_000])
def test_shards_of_any_size_give_the_same_nodes(spark, monkeypatch, limit):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", limit)
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 12)
    r = random.Random(limit)
    name = lambda: (r.choice("abc"), r.randrange(1, 3))
    convs = [(i, [("hot", 5)] * r.randrange(3) + [name() for _ in range(r.randrange(5))]) for i in range(60)]
    convs += [(1000 + i, [("hot", 5), ("same", 3), ("end", 1)]) for i in range(40)] + [(-7, []), (5000, [("hot", 5)] * 30)]
    check(spark, convs)


def test_a_path_that_ends_where_the_next_shard_goes_on(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 1)
    a, b, c = ("a", 2), ("b", 3), ("c", 4)
    check(spark, [(1, [a]), (2, [a, b]), (3, [a, b, c]), (4, [a, b, c, a]), (5, [a, c]), (6, [a, c, b])])
    check(spark, [(1, [a, b]), (2, [a, b, c]), (3, [b])])
    check(spark, [(9, [])])


def test_no_conversations(spark):
    empty = spark.createDataFrame([], f"conv_id long, turns {TURNS}")
    assert prefix_nodes(empty).count() == 0 == member_lists(empty).count()
    turns = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert prefix_nodes(rebuilt(turns)).count() == 0


def test_turns_with_nulls_ties_repeated_rows_and_extra_columns(spark):
    rows = [
        (1, 2, "user", "second"), (1, None, "user", "first"), (1, 2, "user", "second"), (1, 3, None, "x"), (2, 1, "", None), (2, None, None, ""),
        (None, 1, "user", "nobody"), (3, 1, "ab", "c"), (4, 1, "a", "bc"), (5, 1, "a", "日本" * 40_000),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "'d' AS digest", "1 AS path", "2 AS chars")
    found = {r.conv_id: r.turns for r in conversation_turns(turns).collect()}
    assert set(found) == {1, 2, 3, 4, 5}
    assert [t.chars for t in found[1]] == [5, 6, 6, 1] and [t.chars for t in found[2]] == [0, 0] and found[5][0].chars == 80_000
    assert found[2][0].digest == found[2][1].digest and found[3][0].digest != found[4][0].digest and found[1][1] == found[1][2]
    tied = spark.createDataFrame([(1, 1, "r", t) for t in "abcdef"], "conv_id long, turn int, role string, text string")
    assert conversation_turns(tied).first() == conversation_turns(tied.repartition(4)).first()


def test_rebuilding(spark):
    sizes = {0: 3, 5: 8, 17: 1, 99: 0, 100: 7, 123: 4, 250: 6, 251: 1, -3: 2, -103: 5}
    rows = [(c, i, "user", f"{c}/{i}") for c, n in sizes.items() for i in range(n)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    texts = {hashlib.md5(f"4:user{t}".encode()).hexdigest(): t for *_, t in rows}
    found = {r.conv_id: [texts[t.digest] for t in r.turns] for r in rebuilt(turns).collect()}
    for c, n in sizes.items():
        if n:
            h = zlib.crc32(str(c).encode()) % 6
            base = c - (c % 100 if c >= 0 else -(-c % 100))
            own = [f"{c}/{i}" for i in range(n)]
            assert found[c] == [f"{base}/{i}" for i in range(sizes.get(base, 0))][:h] + own[h:]
