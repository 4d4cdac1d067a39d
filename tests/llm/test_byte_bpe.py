"""Prefix encoding against the public library, merging by hand, and full encoding after changes."""

import base64
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("cyclemart.llm")
public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
from cyclemart.llm.byte_bpe import Encoder, Prefixes, Vocabulary, decoded, encoded, load_vocabulary, re_encoded  # noqa: E402
from cyclemart.llm.registered import QUERIES  # noqa: E402
from tests.llm.helpers import empty_documents, odd_documents  # noqa: E402

DATA = "/root/testdata/sf0.01"
FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABETS = st.sampled_from(["ab", "a b\n", "é日本ß x", "'srelvd 12", "=-*# \t", "aeioustn ", "\u0085 　a"])
TEXTS = ALPHABETS.flatmap(lambda letters: st.text(alphabet=letters, max_size=60)) | st.text(max_size=30)


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary(FILE)


@pytest.fixture(scope="module")
def public(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return Encoder(vocabulary, public_tokenizers.PATTERN)


def numbers(packed):
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(text=TEXTS)
def test_any_text_as_the_public_library(encoder, public, text):
    assert numbers(encoder.packed(text)) == public.encode_ordinary(text)
    assert encoder.decoded(encoder.packed(text)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(text=TEXTS, new=TEXTS, cut=st.tuples(st.integers(0, 60), st.integers(0, 60)))
def test_edits_and_appends_equal_encoding_anew(encoder, text, new, cut):
    start, stop = min(cut), max(cut)
    for after in (text + new, text[:start] + new + text[stop:], new + text, text[:start]):
        assert encoder.updated(text, encoder.packed(text), after)[0] == encoder.packed(after)


@settings(max_examples=200, deadline=None)
@given(data=st.binary(max_size=80), new=st.binary(max_size=10), cut=st.tuples(st.integers(0, 80), st.integers(0, 80)))
def test_prefixes_have_one_last_token(vocabulary, data, new, cut):
    start, stop = min(*cut, len(data)), min(max(cut), len(data))
    walk = Prefixes(vocabulary)
    walk.append(data)
    for end in range(1, len(data) + 1):
        fitting = [
            data[end - n:end] for n in range(1, min(end, vocabulary.longest) + 1)
            if data[end - n:end] in vocabulary.left and (n == end or vocabulary.fits(walk.last[end - n], data[end - n:end]))
        ]
        assert fitting == [walk.last[end]]
    walk.replace(start, stop, new)
    again = Prefixes(vocabulary)
    again.append(data[:start] + new + data[stop:])
    assert (walk.data, walk.last) == (again.data, again.last)


def test_edit_of_a_long_run_stays_near(vocabulary):
    walk = Prefixes(vocabulary)
    walk.append(b"qwertyuiop" * 3000)
    assert walk.replace(15000, 15003, b"xx") < 300
    again = Prefixes(vocabulary)
    again.append(walk.data)
    assert walk.last == again.last


def test_vocabularies_that_cannot_work_are_refused():
    bytes_only = {bytes([b]): b for b in range(256)}
    Vocabulary(bytes_only)
    with pytest.raises(ValueError, match="single bytes"):
        Vocabulary({b"a": 0})
    with pytest.raises(ValueError, match="share"):
        Vocabulary({**bytes_only, b"ab": 5})
    odd = Vocabulary({**bytes_only, b"ab": 300, b"bc": 299, b"abcd": 301})  # merging never gives abcd
    assert b"abcd" not in odd.left
    assert Encoder(odd, r".+").packed("abcd") == np.array([301], "<u4").tobytes()
    assert numbers(Encoder(odd, r".+").packed("abcde")) == [97, 299, 100, 101]


def test_odd_documents(spark, vocabulary, public):
    docs = odd_documents(spark).selectExpr("*", "7 AS ids", "'p' AS _order")
    found = encoded(docs, vocabulary, public_tokenizers.PATTERN, outputs=("ids", "packed", "decoded"))
    assert set(found.columns) == set(docs.columns) - {"text"} | {"ids", "packed", "decoded"}
    assert sorted(r.decoded for r in found.collect()) == sorted((r.text or "").encode() for r in docs.collect())
    back = decoded(found.drop("decoded"), vocabulary)
    assert all(public.encode_ordinary(r.decoded.decode()) == r.ids == numbers(r.packed) for r in back.collect())
    assert {r._order for r in back.collect()} == {"p"}
    assert encoded(empty_documents(spark), vocabulary, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError, match="no such output"):
        encoded(docs, vocabulary, public_tokenizers.PATTERN, outputs=("words",))


def test_changed_texts(spark, vocabulary, public):
    long = "several words of a text that is long enough " * 400
    pairs = [("", "new"), (None, "x"), ("old", None), (long, long + "and more"), (long, long[:9000] + "!!" + long[9001:]), ("a  b", "a   b"), ("it'", "it're")]
    rows = [(i, a, public.encode_ordinary(a or ""), b, "kept") for i, (a, b) in enumerate(pairs)]
    frame = spark.createDataFrame(rows, "n int, before string, ids array<int>, after string, decoded string")
    found = {r.n: r for r in re_encoded(frame, vocabulary, public_tokenizers.PATTERN).collect()}
    assert all(found[i].ids == public.encode_ordinary(b or "") for i, (_, b) in enumerate(pairs))
    assert found[3].n_encoded < 40 and found[4].n_encoded < 40 and found[0].decoded == "kept"


def test_query_against_the_public_library(spark, public):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    found = {r.doc_id: r for r in QUERIES["op11_byte_bpe"](spark, DATA).collect()}
    assert len(found) == len(docs)
    for d in docs:
        ids = public.encode_ordinary(d.text or "")
        packed = np.array(ids, "<u4").tobytes()
        assert tuple(found[d.doc_id]) == (
            d.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((d.text or "").encode()).hexdigest()
        )


def test_file_is_read_as_written():
    first = open(FILE, "rb").readline().split()
    assert load_vocabulary(FILE).pieces[int(first[1])] == base64.b64decode(first[0])
