"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

1. The word n-grams of all test items set bits in a map of fixed size (1 MB). One
   pass over the corpus counts the documents of the n-grams whose bits are set.
2. Any alignment that can match shares at least ``least_grams`` n-grams with the item. So
   all n-grams of an item but its ``least_grams - 1`` most frequent ones are seeds: whichever
   words an edited copy lost, it holds a seed.
3. A second pass keeps the passages around seeds; seeds join them to items on the n-gram's
   hash (an ordinary Spark join).
4. Candidates that share ``least_grams`` n-grams are aligned locally, word by word, which also
   scores edited copies.

Words are runs of letters and digits (and of all non-ASCII characters), A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclemart.llm import wordhash
from cyclemart.llm.tables import written

MAP_LONGS = 1 << 17


@dataclass(frozen=True)
class Decontamination:
    """``seed_words``: length of seeds; items with fewer words match where they stand whole, word after word.
    A pair matches if its score reaches ``share`` of the item's own score, or that of ``long_run``
    words copied in full (a long item of which a part is copied), and at least ``least_words`` words
    of the item align, or all words of a shorter item.

    With seeds of two words no such pair is missed, unless an item has 197 words or more and a document
    holds about every other word of it but no two in a row."""

    seed_words: int = 2
    match: int = 2
    mismatch: int = -1
    gap: int = -2
    share: float = 0.5
    long_run: int = 50
    least_words: int = 8


@lru_cache(maxsize=4096)
def least_grams(n_words: int, p: Decontamination) -> int:
    """The least number of an item's n-grams, by place, that lie in an alignment which matches (1 at least).

    Words that align in r runs hold all n-grams but ``n - 1`` a run, and each break between runs costs a mismatch,
    which takes a word of the item too, or a gap."""
    wanted = p.match * min(p.share * n_words, p.long_run)
    least = n_words
    for m in range(1, n_words + 1):
        spare = p.match * m - wanted
        if spare >= 0:
            swaps = min(n_words - m, m - 1, int(spare // -p.mismatch)) if p.mismatch > p.gap else 0
            gaps = min(m - 1 - swaps, int((spare + swaps * p.mismatch) // -p.gap))
            least = min(least, m - (min(p.seed_words, n_words) - 1) * (1 + swaps + gaps))
    return max(1, least)


def _widest(n_words: int, p: Decontamination) -> int:
    """The most words of a document that an alignment which matches can take."""
    return n_words + int(p.match * (n_words - min(p.share * n_words, p.long_run)) // -p.gap)


def _bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(64 * MAP_LONGS - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def _sized_grams(words: wordhash.Words, sizes: Iterable[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first word, size) of the n-grams of all ``sizes``, in the order of their first words."""
    each = [wordhash.gram_hashes(words, n) for n in sizes]
    hashes, at = (np.concatenate(x) for x in zip(*each, strict=True))
    size = np.repeat(list(sizes), [len(x) for x, _ in each])
    if len(each) == 1:
        return hashes, at, size
    order = np.argsort(at, kind="stable")
    return hashes[order], at[order], size[order]


def item_grams(n: int):
    """A map over batches of (item, text): n-grams of the texts; a text of fewer words is one shorter n-gram."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for batch in batches:
            for words in wordhash.blocks(batch.column(1), wordhash.ALPHANUMERIC):
                hashes, at, size = _sized_grams(words, range(1, n + 1))
                texts = words.texts[at]
                whole = size == np.minimum(words.counts[texts], n)
                hashes, at, texts = hashes[whole], at[whole], texts[whole]
                first = np.cumsum(words.counts) - words.counts
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(texts + words.first)), pa.array(at - first[texts]),
                     pa.array(words.counts[texts].astype(np.int64)), pa.array(hashes.view(np.int64))],
                    ["item", "place", "n_words", "gram"],
                )

    return grams


def hit_map(grams: DataFrame) -> np.ndarray:
    """At most ``MAP_LONGS`` rows reach the driver, whatever the number of n-grams."""
    mask = 64 * MAP_LONGS - 1
    bits = grams.select(F.explode(F.array(
        F.col("gram").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("gram", 32).bitwiseAND(F.lit(mask))
    )).alias("bit"))
    longs = bits.groupBy(F.shiftright("bit", 6).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits")
    )
    out = np.zeros(MAP_LONGS, np.int64)
    for row in longs.toLocalIterator():
        out[row.slot] = row.bits
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def seed_passages(sizes: tuple[int, ...], margin: int, shared_map):
    """A map over batches of (id, text): passages around n-grams of the shared bit map, with these n-grams and their places."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        hit = shared_map.value
        for batch in batches:
            for words in wordhash.blocks(batch.column(1), wordhash.ALPHANUMERIC):
                hashes, at, _ = _sized_grams(words, sizes)
                one, two = _bits(hashes)
                found = np.flatnonzero(hit[one] & hit[two])
                if len(found):
                    yield _cut_block(batch, words, hashes[found], at[found], max(sizes), margin)

    return cut


def gram_counts(sizes: tuple[int, ...], shared_map):
    """A map over batches of texts: n-grams of the shared bit map, with the number of texts (so far) that hold them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        hit = shared_map.value
        for batch in batches:
            for words in wordhash.blocks(batch.column(0), wordhash.ALPHANUMERIC):
                hashes, at, _ = _sized_grams(words, sizes)
                one, two = _bits(hashes)
                found = np.flatnonzero(hit[one] & hit[two])
                hashes, texts = hashes[found], words.texts[at[found]]
                order = np.lexsort((hashes, texts))
                hashes, texts = hashes[order], texts[order]
                new = np.ones(len(order), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
                grams, counts = np.unique(hashes[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(counts.astype(np.int64))], ["gram", "n"])

    return count


def _cut_block(batch, words: wordhash.Words, hashes, at, n: int, margin: int) -> pa.RecordBatch:
    text_of = words.texts[at]
    breaks = np.flatnonzero((np.diff(at) > 2 * margin) | (np.diff(text_of) > 0)) + 1
    rows, starts, texts, grams, places = [], [], [], [], []
    last_word = np.cumsum(words.counts)
    for part in np.split(np.arange(len(at)), breaks):
        t = text_of[part[0]]
        base = last_word[t] - words.counts[t]
        low, high = max(base, at[part[0]] - margin), min(last_word[t], at[part[-1]] + n + margin)
        rows.append(t + words.first)
        starts.append(low - base)
        texts.append(b" ".join([words.word(i) for i in range(low, high)]).decode())
        grams.append(hashes[part].view(np.int64))
        places.append(at[part] - base)
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(texts),
         pa.array(grams, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int64()))],
        ["doc_id", "start", "passage", "grams", "places"],
    )


def align(item: np.ndarray, passage: np.ndarray, p: Decontamination) -> tuple[int, int]:
    """(best local score, passage word after the end of that alignment); linear gaps."""
    slope = -p.gap * np.arange(len(passage))
    row = np.zeros(len(passage), np.int64)
    best, end = 0, 0
    for word in item:
        step = np.where(passage == word, p.match, p.mismatch)
        step[1:] += row[:-1]
        np.maximum(step, row + p.gap, out=step)
        np.maximum(step, 0, out=step)
        row = np.maximum.accumulate(step + slope) - slope
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top + 1
    return best, end


def aligned_words(item: np.ndarray, passage: np.ndarray, p: Decontamination) -> int:
    """The most words that are equal in an alignment of the best score."""
    unit = len(item) + 1
    fine = replace(p, match=p.match * unit + 1, mismatch=p.mismatch * unit, gap=p.gap * unit)
    return align(item, passage, fine)[0] % unit


def hashed_words(texts: pa.Array) -> list[np.ndarray]:
    """The hashes of each text's words."""
    out = []
    for words in wordhash.blocks(texts, wordhash.ALPHANUMERIC):
        out += np.split(words.hashes, np.cumsum(words.counts)[:-1])
    return out


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = wordhash.mix(out + words[i:len(words) - n + 1 + i])
    return out


def _aligned(p: Decontamination):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for batch in batches:
            items, passages = hashed_words(batch.column(3)), hashed_words(batch.column(4))
            starts = batch.column(2).to_pylist()
            rows = []
            for k, (item, passage) in enumerate(zip(items, passages, strict=True)):
                n = min(p.seed_words, len(item))
                if np.isin(_grams(item, n), _grams(passage, n)).sum() < least_grams(len(item), p):
                    continue
                best, end = align(item, passage, p)
                if best < p.match * min(p.share * len(item), p.long_run):
                    continue
                if aligned_words(item, passage, p) < min(len(item), p.least_words):
                    continue
                _, back = align(item[::-1], passage[:end][::-1], p)
                rows.append((k, best, best / (p.match * len(item)), starts[k] + end - back, starts[k] + end - 1))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            taken = pa.array(columns[0], pa.int64())
            kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), *[pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True)]],
                ["doc_id", "item_id", "score", "share", "first_word", "last_word"],
            )

    return score


def contaminated_pairs(docs: DataFrame, items: DataFrame, p: Decontamination = Decontamination()) -> DataFrame:
    """Documents that hold a test item, or an edited copy of it.

    ``docs``: doc_id, text; ``items``: item_id, text (other columns are ignored; ids are longs).
    Returns one row for each (doc_id, item_id) that matches: score, share (of the
    item's own score), first_word and last_word (words of the document, from 0) of the
    best alignment, the first one on ties. Null and empty texts hold nothing and match nothing;
    repeated rows of a document or an item give one row. The result is a written table.
    """
    spark = docs.sparkSession
    items = written(
        items.select("item_id", F.col("text").alias("item_text")).filter("item_text IS NOT NULL").distinct()
        .withColumn("item", F.monotonically_increasing_id()), "items",
    )
    grams = written(
        items.select("item", "item_text").mapInArrow(item_grams(p.seed_words), "item long, place long, n_words long, gram long"),
        "item-grams",
    )
    longest, shortest = grams.agg(F.max("n_words"), F.min("n_words")).first()
    longest, shortest = longest or 0, shortest or p.seed_words
    sizes = tuple(range(min(shortest, p.seed_words), p.seed_words + 1))
    item_map = spark.sparkContext.broadcast(hit_map(grams))
    counts = docs.select("text").mapInArrow(gram_counts(sizes, item_map), "gram long, n long").groupBy("gram").agg(
        F.sum("n").alias("n_docs")
    )
    commonest = Window.partitionBy("item").orderBy(F.desc("n_docs"), "gram", "place")
    least = F.udf(lambda n_words: least_grams(n_words, p), "int")
    lengths = grams.select("n_words").distinct().withColumn("least", least("n_words"))
    ranked = grams.join(counts, "gram").join(lengths, "n_words")  # an n-gram that no document has cannot be met
    seeds = written(
        ranked.withColumn("_rank", F.row_number().over(commonest)).filter(F.col("_rank") >= F.col("least"))
        .select("item", "gram").distinct(), "seeds",
    )
    seed_map = spark.sparkContext.broadcast(hit_map(seeds))
    passages = written(
        docs.select("doc_id", "text").mapInArrow(
            seed_passages(sizes, _widest(longest, p), seed_map), "doc_id long, start long, passage string, grams array<long>, places array<long>"
        ).withColumn("passage_id", F.monotonically_increasing_id()), "passages",
    )

    hits = passages.select("passage_id", F.explode(F.array_distinct("grams")).alias("gram"))
    candidates = hits.join(seeds, "gram").select("passage_id", "item").distinct()
    pairs = (
        candidates.join(passages.select("passage_id", "doc_id", "start", "passage"), "passage_id").join(items, "item")
        .select("doc_id", "item_id", "start", "item_text", "passage")
    )
    scored = pairs.mapInArrow(
        _aligned(p), "doc_id long, item_id long, score long, share double, first_word long, last_word long"
    )
    best = F.max(F.struct("score", "share", (-F.col("first_word")).alias("_first"), (-F.col("last_word")).alias("_last"))).alias("_best")
    return written(
        scored.groupBy("doc_id", "item_id").agg(best).select(
            "doc_id", "item_id", "_best.score", "_best.share", (-F.col("_best._first")).alias("first_word"),
            (-F.col("_best._last")).alias("last_word"),
        ), "contaminated",
    )


def decontaminated(docs: DataFrame, items: DataFrame, p: Decontamination = Decontamination()) -> DataFrame:
    """Rows of ``docs`` that hold no test item, with all their columns; a null doc_id is an id too."""
    bad = contaminated_pairs(docs, items, p).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs.doc_id.eqNullSafe(bad._bad), "left_anti")
